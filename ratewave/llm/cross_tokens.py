"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A (a byte-level BPE file) encodes a space and the text, tokenizer B (a SentencePiece
BPE model) the text, to which it adds that space.  Byte places where tokens of both end cut a
text into groups; tokens of A and B whose byte ranges overlap are linked.

Divide and conquer at shared cuts.  The first cuts are places where both are sure to cut: a
space after any other than a white-space character, which no token of either crosses.  What lies between (an interval, a
word as a rule) depends on its own bytes alone, so a task aligns each distinct interval once:
it looks for a common end near the middle of A's tokens, finds it among B's ends by bisection,
moves outward until one is common, and goes on in both halves; an interval without a common end
is a group.  All intervals of a slice of texts take each step of the recursion at once.

A link's pair of ids is counted over the corpus.  Documents' distinct pairs are written in a
packed form; their counts are partly summed in each task, then grouped.  The most frequent
pairs (at most ``HEAD``, a fixed bound) go to all tasks as a broadcast; the others are joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewave.llm.bpe import encoder
from ratewave.llm.common import column, materialize, slices

#: The most frequent pairs that travel as a broadcast: 17 bytes each.
HEAD = 1 << 20
#: Distinct pairs that a task sums before it passes them on.
HELD = 1 << 21
#: Text whose intervals are aligned together, in bytes; one longer text goes alone.
TEXT_SLICE = 6 << 20
#: An interval: a space, then all up to the next space that follows a character that isn't white space.
INTERVAL = re.compile(r" (?:[^ ]|(?<=\s) )*")
UNSURE = re.compile(r"\s ")
_LOW = np.int64(0xFFFFFFFF)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers (of A, of B) whose ends are common, inside intervals whose own ends are.

    Interval i has A's tokens ``first_a[i] .. first_a[i + 1] - 1``, of ends that grow from
    interval to interval; likewise B."""
    lo_a, hi_a, lo_b, hi_b = first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]
    cuts_a, cuts_b = [], []
    while True:
        open_ = (hi_a - lo_a > 1) & (hi_b - lo_b > 1)
        lo_a, hi_a, lo_b, hi_b = lo_a[open_], hi_a[open_], lo_b[open_], hi_b[open_]
        if not len(lo_a):
            break
        mid = (lo_a + hi_a - 1) // 2
        at_a = np.full(len(mid), -1, dtype=np.int64)
        at_b = at_a.copy()
        todo, away = np.arange(len(mid)), 0
        while len(todo):
            for probe in sorted({-away, away}):
                at = mid[todo] + probe
                fit = (at >= lo_a[todo]) & (at <= hi_a[todo] - 2) & (at_a[todo] < 0)
                own, at = todo[fit], at[fit]
                found = np.searchsorted(ends_b, ends_a[at])  # bisection among B's ends
                hit = ends_b[found] == ends_a[at]
                at_a[own[hit]], at_b[own[hit]] = at[hit], found[hit]
            away += 1
            left = (at_a[todo] < 0) & ((mid[todo] - away >= lo_a[todo]) | (mid[todo] + away <= hi_a[todo] - 2))
            todo = todo[left]
        cut = at_a >= 0
        lo_a, hi_a, lo_b, hi_b, at_a, at_b = (x[cut] for x in (lo_a, hi_a, lo_b, hi_b, at_a, at_b))
        cuts_a.append(at_a)
        cuts_b.append(at_b)
        lo_a, hi_a = np.concatenate([lo_a, at_a + 1]), np.concatenate([at_a + 1, hi_a])
        lo_b, hi_b = np.concatenate([lo_b, at_b + 1]), np.concatenate([at_b + 1, hi_b])
    none = np.zeros(0, dtype=np.int64)
    return np.sort(np.concatenate([*cuts_a, none])), np.sort(np.concatenate([*cuts_b, none]))


def intervals_of(text: str) -> list[str]:
    """The intervals of a space and the text, each without the space that it begins with."""
    if not text:
        return []
    if text[0] == " " or UNSURE.search(text):
        return [s[1:] for s in INTERVAL.findall(" " + text)]
    return text.split(" ")


class Alignment(NamedTuple):
    """Of intervals; one whose tokens don't give its bytes is not ``good`` and has nothing."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    texts: list[str]  # groups as ``a1,a2|b1;a3|b2,b3;``
    first_link: np.ndarray  # interval i has links first_link[i] .. first_link[i + 1] - 1
    pairs: np.ndarray  # of the links: A's id << 32 | B's id


def _from_zero(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(counts, dtype=np.int64)])


class CrossTokens:
    """Two tokenizers; one object per Python worker."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece

        self.a = encoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError(f"{path_b}: pieces that reach over a space")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.space_b = self.b.piece_to_id("▁")
        size = max(len(pieces), len(self.a.tokens))
        self.names = {x: np.array([f"{i}{x}" for i in range(size)], dtype=object) for x in ",|;"}
        self.digits = np.array([len(x) for x in self.names[","]], dtype=np.int64)

    def encode_a(self, intervals: list[str], raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each interval).  Those that end in white space must come last;
        the others stay apart when they are encoded as one text."""
        n = len(intervals)
        while n and (" " + intervals[n - 1])[-1].isspace():
            n -= 1
        ids = self.a.plain(b"".join(raws[:n])).astype(np.int64)
        ends = np.cumsum(self.a.lengths[ids])
        due = np.cumsum([len(r) for r in raws[:n]], dtype=np.int64)
        at = np.searchsorted(ends, due)
        if not (ends[at] == due).all():
            raise ValueError("a token of A reaches over a sure cut")
        parts = [self.a.plain(r).astype(np.int64) for r in raws[n:]]
        counts = np.concatenate([np.diff(at + 1, prepend=0), np.array([len(p) for p in parts], dtype=np.int64)])
        return np.concatenate([ids, *parts]), counts

    def encode_b(self, intervals: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.b.encode(intervals, out_type=int, num_threads=1)
        found = [x or [self.space_b] for x in found]  # the added space alone
        return np.fromiter(chain.from_iterable(found), dtype=np.int64), np.array([len(x) for x in found], dtype=np.int64)

    def align(self, intervals: list[str]) -> Alignment:
        """Of one or more intervals, given without the space that each begins with; those that end
        in white space last."""
        raws = [b" " + s.encode() for s in intervals]
        size = np.array([len(r) for r in raws], dtype=np.int64)
        ids_a, n_a = self.encode_a(intervals, raws)
        ids_b, n_b = self.encode_b(intervals)
        first_b = _from_zero(n_b)
        good = np.add.reduceat(self.length_b[ids_b], first_b[:-1]) == size
        pieces = list(map(self.bytes_b.__getitem__, ids_b.tolist()))
        if not good.all() or b"".join(pieces) != b"".join(raws):
            for i, r in enumerate(raws):
                good[i] = good[i] and b"".join(pieces[first_b[i] : first_b[i + 1]]) == r
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        n_a, n_b, size = n_a * good, n_b * good, size * good
        first_a, first_b = _from_zero(n_a), _from_zero(n_b)
        ends_a, ends_b = np.cumsum(self.a.lengths[ids_a]), np.cumsum(self.length_b[ids_b])
        cut_a, cut_b = shared_cuts(ends_a, ends_b, first_a, first_b)
        last_a = np.sort(np.concatenate([cut_a, first_a[1:][good] - 1]))  # the last tokens of the groups
        last_b = np.sort(np.concatenate([cut_b, first_b[1:][good] - 1]))

        # groups as text: each group's A ids, then its B ids, with what follows each
        b_before = np.concatenate([[0], last_b + 1])[np.searchsorted(last_a, np.arange(len(ids_a)))]
        a_before = (last_a + 1)[np.searchsorted(last_b, np.arange(len(ids_b)))]
        at_a, at_b = np.arange(len(ids_a)) + b_before, np.arange(len(ids_b)) + a_before
        words, width = np.empty(len(ids_a) + len(ids_b), dtype=object), np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        for at, ids, last, x in ((at_a, ids_a, last_a, "|"), (at_b, ids_b, last_b, ";")):
            words[at], width[at] = self.names[","][ids], self.digits[ids]
            words[at[last]] = self.names[x][ids[last]]
        text = "".join(words.tolist())
        upto = _from_zero(width)[first_a + first_b].tolist()
        texts = [text[i:j] for i, j in zip(upto[:-1], upto[1:], strict=True)]

        # a link is a stretch between neighbouring ends of either: it lies in one token of each
        marks = np.zeros(int(size.sum()) + 1, dtype=bool)
        marks[ends_a] = marks[ends_b] = True
        ends = np.flatnonzero(marks)
        pairs = ids_a[np.searchsorted(ends_a, ends)] << np.int64(32) | ids_b[np.searchsorted(ends_b, ends)]
        first_link = np.searchsorted(ends, _from_zero(size), side="right")
        return Alignment(good, n_a, n_b, np.diff(np.searchsorted(last_a, first_a)), texts, first_link, pairs)


@lru_cache(maxsize=2)
def cross_tokens(path_a: str, path_b: str) -> CrossTokens:
    return CrossTokens(path_a, path_b)


def pack(pairs: np.ndarray) -> bytes:
    """Distinct pairs and how often each occurs, compressed."""
    codes = np.sort(pairs)
    at = np.flatnonzero(np.diff(codes, prepend=-1))
    codes, n = codes[at], np.diff(at, append=len(codes))
    steps = np.diff(codes, prepend=0)
    return zstandard.compress(steps.astype("<i8").tobytes() + n.astype("<i8").tobytes(), 1)


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.decompress(raw), dtype="<i8").reshape(2, -1)
    return np.cumsum(both[0]), both[1]


class _Numbers(dict):
    """What is asked for gets the next number."""

    def __missing__(self, key: str) -> int:
        i = self[key] = len(self)
        return i


def align_texts(tool: CrossTokens, texts: list[bytes]) -> Iterator[tuple[int, int, int, np.ndarray, str]]:
    """(tokens of A, of B, groups, pairs of the links, groups as text) of each text."""
    index = _Numbers()
    split = [intervals_of(t.decode("utf-8")) for t in texts]
    of_text = [np.fromiter(map(index.__getitem__, x), dtype=np.int64, count=len(x)) for x in split]
    if not index:
        yield from ((0, 0, 0, np.zeros(0, dtype=np.int64), "") for _ in texts)
        return
    intervals = list(index)
    late = np.array([not s or s[-1].isspace() for s in intervals])
    order = np.argsort(late, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    found = tool.align([intervals[i] for i in order])
    for own in of_text:
        own = place[own]
        if not len(own) or not found.good[own].all():
            yield 0, 0, 0, np.zeros(0, dtype=np.int64), ""
            continue
        lo, n = found.first_link[own], found.first_link[own + 1] - found.first_link[own]
        pairs = found.pairs[np.repeat(lo - _from_zero(n)[:-1], n) + np.arange(n.sum())]
        groups = "".join(map(found.texts.__getitem__, own.tolist()))[:-1]
        yield int(found.n_a[own].sum()), int(found.n_b[own].sum()), int(found.n_groups[own].sum()), pairs, groups


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, pairs of every row: A's and B's tokens, groups
    and links, the groups as ``a1,a2|b1;a3|b2,b3`` (with ``digest`` their SHA-256 in hex), and
    the distinct linked id pairs with their numbers, packed (``unpack``).

    NULL and empty texts, and those whose tokens of B don't give the text's bytes back, have
    zeros, empty groups ('' also with ``digest``) and no pairs.  Rows are independent, so
    repeated rows and ids give repeated results; an empty table none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = cross_tokens(path_a, path_b)
        for part, texts in slices(batches, "text", TEXT_SLICE):
            counts, groups, packed = [], [], []
            for n_a, n_b, n_groups, pairs, text in align_texts(tool, texts):
                counts.append((n_a, n_b, n_groups, len(pairs)))
                groups.append(hashlib.sha256(text.encode()).hexdigest() if digest and n_a else text)
                packed.append(pack(pairs))
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "doc_id"),
                    *[pa.array(x, pa.int64()) for x in zip(*counts, strict=True)],
                    pa.array(groups, pa.string()),
                    pa.array(packed, pa.binary()),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary"
    )


def _partial_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair, n: summed in the task as long as ``HELD`` different pairs last."""

    def merged(held: list) -> tuple[np.ndarray, np.ndarray]:
        codes, where = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
        return codes, np.bincount(where, weights=np.concatenate([n for _, n in held]), minlength=len(codes)).astype(np.int64)

    def out(codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(codes), 1 << 16):
            cut = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(codes[cut]), pa.array(n[cut])], names=["pair", "n"])

    held, size = [], 0
    for batch in batches:
        for raw in column(batch, "pairs"):
            held.append(unpack(raw.as_py()))
            size += len(held[-1][0])
            if size > HELD:
                held = [merged(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from out(*held[0])
                    held, size = [], 0
    if held:
        yield from out(*merged(held))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n, best: the links of each id pair in the corpus, and whether no other pair of its
    B id has more."""
    n = aligned.select("pairs").mapInArrow(_partial_sums, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    n = materialize(n.withColumn("b", F.col("pair").bitwiseAND(F.lit(int(_LOW)))), "cross_token_pairs")
    most = n.groupBy("b").agg(F.max("n").alias("most"))  # one row per id of B's vocabulary, so small
    return n.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> Column:
    """Condition that holds for at most ``most`` pairs: the count reaches a step of a geometric scale."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = sorted(((r.step, r.k) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect()), reverse=True)
    total, least = 0, None
    for s, k in sizes:  # at most 8 * 63 steps
        total += k
        if total > most:
            break
        least = s
    return step >= F.lit(least if least is not None else 1 << 30)


def corpus_links(aligned: DataFrame, head: int | None = None) -> DataFrame:
    """The rows of ``align_documents`` without their pairs, with n_best (links whose pair is the
    most frequent of its B id, ties included) and count_sum (the pairs' counts over all links).
    At most ``head`` pairs (``HEAD``) are broadcast."""
    rows = materialize(aligned.withColumn("row", F.monotonically_increasing_id()), "cross_token_rows")
    counts = materialize(pair_counts(rows), "cross_token_counts")
    often = _frequent(counts, HEAD if head is None else head)
    known = counts.where(often).orderBy("pair").toArrow()
    spark = aligned.sparkSession
    shared = spark.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("pair", "n", "best")))
    kept = [c for c in rows.columns if c != "pairs"]

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counted, best = shared.value
        for batch in batches:
            sums, bests, rest = [], [], []
            for raw in column(batch, "pairs"):
                pairs, n = unpack(raw.as_py())
                at = np.minimum(np.searchsorted(codes, pairs), max(len(codes) - 1, 0))
                have = codes[at] == pairs if len(codes) else np.zeros(len(pairs), dtype=bool)
                sums.append(int((counted[at[have]] * n[have]).sum()))
                bests.append(int(n[have][best[at[have]]].sum()))
                rest.append((pairs[~have], n[~have]))
            offsets = pa.array(_from_zero(np.array([len(p) for p, _ in rest])).astype(np.int32))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*rest, strict=True)]
            other = pa.StructArray.from_arrays([pa.array(x) for x in flat], names=["pair", "k"])
            yield pa.RecordBatch.from_arrays(
                [*[column(batch, c) for c in kept], pa.array(sums, pa.int64()), pa.array(bests, pa.int64()), pa.ListArray.from_arrays(offsets, other)],
                names=[*kept, "head_sum", "head_best", "rest"],
            )

    own = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    looked = rows.mapInArrow(look_up, own + ", head_sum long, head_best long, rest array<struct<pair: long, k: long>>")
    looked = materialize(looked, "cross_token_head")
    rest = looked.select("row", F.explode("rest").alias("r")).select("row", "r.pair", "r.k").join(counts.where(~often), "pair")
    rest = rest.groupBy("row").agg(F.sum(F.col("n") * F.col("k")).alias("s"), F.sum(F.when(F.col("best"), F.col("k"))).alias("t"))
    zero = F.lit(0).cast("long")
    return looked.join(rest, "row", "left").select(
        *[c for c in kept if c != "row"],
        (F.col("head_best") + F.coalesce("t", zero)).alias("n_best"),
        (F.col("head_sum") + F.coalesce("s", zero)).alias("count_sum"),
    )
