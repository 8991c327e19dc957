"""Language model scores by a hierarchical Pitman-Yor model with Gibbs-sampled seating.

Every token of the training is a context, and has a restaurant of its own over all words
that follow it.  Its base measure draws a word in two steps.  First its dish: one of the
DISHES most frequent tokens, or "another word"; there is one restaurant per class of
contexts (each of the CONTEXTS most frequent ones, and one for all others), and they share
a parent restaurant, whose base is uniform.  Then, for another word, the word: a restaurant
whose base measure spells words byte by byte.  The spelling is a hierarchy again: a
restaurant per context of two bytes, whose parent is the context of the last byte, whose
parent is the empty context, whose base is uniform.  A table in a restaurant is a customer
in its parent.  As in the add-one model beside it, all words that the training didn't see
are one event: the mass that its words leave.

Seating is sampled by Gibbs: the number of tables of a dish is drawn from its conditional
given all other tables, p(t) ~ S(c, t) * prod (theta + d * T + i * d) * base^t, with the
generalised Stirling numbers S; beyond STIRLING customers by their limit, t - 1 ~
Poisson((theta / d + T) * base).  The pairs' tables begin with one for each pair; each of
PAIR_SWEEPS sweeps fits the levels above with these tables as customers and draws them
anew, the pairs' in parallel over a written table (a pair that was seen once has one
table).  Words' tables are drawn in parallel over the vocabulary with the spelling held
fixed, then the spelling's with the words' tables as customers.  Draws are functions of the
word or pair and the sweep, so a task that runs again draws the same.  Probabilities of the
levels above the pairs are averaged over the sampled sweeps of their fit.  Scores use all
PAIR_SWEEPS draws of the pairs' tables: tables of pairs and contexts, and the probabilities of the
levels fitted to each draw, enter with their means, which keeps every context's probabilities a
distribution; only the fit to the first seating, of one table for each pair, is left out as burn-in.

What is gathered grows with the corpus: the counts of all words, and of all pairs of
consecutive tokens, both distributed.  Documents are kept in blocks; each sends its distinct
pairs to buckets, and meets their tables again where it is scored.  A pair that was seen once
has one table, and a word is a context as often as it is a token, so only the pairs seen more
often are written: what the levels above need of the others is a difference of totals.
HEAD_WORDS only says which words travel as a broadcast; the others are joined.  The driver
holds the cells of the classes, at most (CONTEXTS + 1) * (DISHES + 1), and the spelling's, at
most 257^3.  Words outside the head are named by 63-bit hashes of their bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewave.llm.common import LOWER, MIX_C, U64, column, crc_of, hash_words, materialize, mix64, slices
from ratewave.session import remove_folder

SYMBOLS, STOP = 257, 256  # bytes and the end mark, which also stands before a word's first byte
STIRLING = 64
BURN_IN, SAMPLES = 1, 2
STRENGTH = 1.0
DISHES, CONTEXTS = 1_024, 256
#: Distinct words a task holds while it counts.
MOST_WORDS = 200_000
#: The most frequent words travel as a broadcast: at most so many, of at most so many bytes.
HEAD_WORDS, HEAD_BYTES = 100_000, 32
#: Tokens of the training for each bucket of pairs.
BUCKET_TOKENS = 400_000
PAIR_SWEEPS = 3
#: Text of a block, in bytes.
TEXT_SLICE = 4 << 20


# -- seating -------------------------------------------------------------------------------


def stirling(d: float, most: int = STIRLING) -> np.ndarray:
    """log S(c, t) for 0 <= t <= c <= most: S(c + 1, t) = S(c, t - 1) + (c - d t) S(c, t)."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[0, 0] = 0.0
    t = np.arange(1, most + 1)
    for c in range(most):
        grow = np.where(c - d * t > 0, np.log(np.maximum(c - d * t, 1e-300)), -np.inf)
        s[c + 1, 1:] = np.logaddexp(s[c, :-1], grow + s[c, 1:])
    return s


def _poisson(mean: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Poisson numbers by inversion; by the normal limit beyond 30."""
    out = np.zeros(len(mean), dtype=np.int64)
    small = mean <= 30
    p = np.exp(-mean[small])
    total, k, left = p.copy(), 0, u[small]
    found = np.zeros(small.sum(), dtype=np.int64)
    while (more := left > total).any() and k < 150:
        k += 1
        p = p * mean[small] / k
        total += p
        found += more
    out[small] = found
    for i in np.flatnonzero(~small):
        z = NormalDist().inv_cdf(min(max(float(u[i]), 1e-12), 1 - 1e-12))
        out[i] = max(0, round(mean[i] + z * mean[i] ** 0.5))
    return out


def draw_tables(
    customers: np.ndarray, base: np.ndarray, others: np.ndarray, d: float, strength: float, u: np.ndarray, table: np.ndarray
) -> np.ndarray:
    """Tables of dishes with so many ``customers``, base probabilities, and ``others`` tables
    in their restaurants; ``u`` uniform in (0, 1); ``table`` = stirling(d)."""
    out = np.minimum(customers, 1).astype(np.int64)
    weight = (strength + d * others) * base
    for c in range(2, STIRLING + 1):
        at = np.flatnonzero(customers == c)
        if not len(at):
            continue
        steps = np.log(weight[at, None] + d * base[at, None] * np.arange(c)[None, :])
        logs = table[c, 1 : c + 1][None, :] + np.cumsum(steps, axis=1)
        p = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
        out[at] = 1 + (p < u[at, None] * p[:, -1:]).sum(axis=1)
    at = np.flatnonzero(customers > STIRLING)
    out[at] = np.minimum(1 + _poisson(weight[at] / d, u[at]), customers[at])
    return out


def discount(counts: np.ndarray) -> float:
    """n1 / (n1 + 2 n2), from the numbers of dishes with one and two customers."""
    n1, n2 = int((counts == 1).sum()), int((counts == 2).sum())
    return _discount(n1, n2)


def _discount(n1: int, n2: int) -> float:
    return min(0.95, max(0.05, (n1 + 0.5) / (n1 + 2 * n2 + 1.0)))


# -- spelling ------------------------------------------------------------------------------


@dataclass
class Spelling:
    """Predictive probabilities: ``rows[index[previous two]]`` over the next symbol."""

    index: np.ndarray  # int32, SYMBOLS^2
    rows: np.ndarray  # float32, the SYMBOLS one-symbol contexts, then the seen two-symbol ones

    def log_base(self, words: list[bytes]) -> np.ndarray:
        """Natural log probability of spelling each word and its end."""
        return self.log_at(*positions(words))

    def log_at(self, context: np.ndarray, symbol: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.log(self.rows[self.index[context], symbol].astype(np.float64)), starts)


def positions(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(two-symbol context, symbol) at every place of the words and their end marks; starts."""
    lens = np.array([len(w) + 1 for w in words], dtype=np.int64)
    starts = np.cumsum(lens) - lens
    ends = starts + lens - 1
    symbol = np.full(int(lens.sum()), STOP, dtype=np.int64)
    inner = np.ones(len(symbol), dtype=bool)
    inner[ends] = False
    symbol[inner] = np.frombuffer(b"".join(words), dtype=np.uint8)
    one = np.concatenate([[STOP], symbol[:-1]])
    two = np.concatenate([[STOP], one[:-1]])
    one[starts] = STOP
    two[starts] = STOP
    second = starts[lens > 1] + 1
    two[second] = STOP
    return two * SYMBOLS + one, symbol, starts


def fit_spelling(cells: np.ndarray, counts: np.ndarray, seed: int, sweeps: int = 3) -> Spelling:
    """Gibbs over the spelling's restaurants; ``cells`` = context * SYMBOLS + symbol, distinct."""
    rng = np.random.default_rng(seed)
    context, symbol = cells // SYMBOLS, cells % SYMBOLS
    lower = (context % SYMBOLS) * SYMBOLS + symbol  # the parent's cell
    low_cells, low_of = np.unique(lower, return_inverse=True)
    low_context, low_symbol = low_cells // SYMBOLS, low_cells % SYMBOLS
    tables2 = np.minimum(counts, 1)
    tables1 = np.ones(len(low_cells), dtype=np.int64)
    d2 = discount(counts)
    p1 = p0 = None
    for _ in range(sweeps + 1):
        if p1 is not None:
            total = np.bincount(context, weights=tables2, minlength=SYMBOLS**2)
            tables2 = draw_tables(
                counts, p1[context % SYMBOLS, symbol], total[context] - tables2, d2, STRENGTH, rng.random(len(cells)), stirling(d2)
            )
        c1 = np.bincount(low_of, weights=tables2, minlength=len(low_cells)).astype(np.int64)
        d1 = discount(c1)
        if p0 is not None:
            total = np.bincount(low_context, weights=tables1, minlength=SYMBOLS)
            tables1 = draw_tables(
                c1, p0[low_symbol], total[low_context] - np.minimum(tables1, c1), d1, STRENGTH, rng.random(len(c1)), stirling(d1)
            )
        tables1 = np.minimum(tables1, c1)
        c0 = np.bincount(low_symbol, weights=tables1, minlength=SYMBOLS).astype(np.int64)
        d0 = discount(c0)
        tables0 = draw_tables(
            c0, np.full(SYMBOLS, 1 / SYMBOLS), np.full(SYMBOLS, float((c0 > 0).sum())), d0, STRENGTH, rng.random(SYMBOLS), stirling(d0)
        )
        p0 = (c0 - d0 * tables0 + (STRENGTH + d0 * tables0.sum()) / SYMBOLS) / (STRENGTH + c0.sum())
        p1 = _predict(low_context, low_symbol, c1, tables1, d1, np.arange(SYMBOLS), p0[None, :].repeat(SYMBOLS, axis=0))
    seen = np.unique(context)
    rows2 = _predict(np.searchsorted(seen, context), symbol, counts, tables2, d2, np.arange(len(seen)), p1[seen % SYMBOLS])
    index = np.tile(np.arange(SYMBOLS, dtype=np.int32), SYMBOLS)
    index[seen] = SYMBOLS + np.arange(len(seen), dtype=np.int32)
    return Spelling(index, np.concatenate([p1, rows2]).astype(np.float32))


def _predict(
    context: np.ndarray, symbol: np.ndarray, c: np.ndarray, t: np.ndarray, d: float, all_contexts: np.ndarray, parent: np.ndarray
) -> np.ndarray:
    n = len(all_contexts)
    customers = np.bincount(context, weights=c, minlength=n)
    tables = np.bincount(context, weights=t, minlength=n)
    rows = parent * ((STRENGTH + d * tables) / (STRENGTH + customers))[:, None]
    rows[context, symbol] += (c - d * t) / (STRENGTH + customers[context])
    return rows


# -- words ---------------------------------------------------------------------------------


def word_seeds(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=U64)


@dataclass
class Sweep:
    """What a sweep's draws depend on: the spelling before it, and all words' tables."""

    number: int
    spelling: Spelling
    tables: float


@dataclass
class Model:
    tokens: int
    d: float
    sweeps: list[Sweep]

    def tables(self, sweep: Sweep, hashes: np.ndarray, counts: np.ndarray, log_base: np.ndarray, stir: np.ndarray) -> np.ndarray:
        u = (mix64(hashes ^ mix64(np.array([sweep.number], dtype=U64))) >> U64(11)).astype(np.float64) / 2.0**53
        base = np.exp(np.maximum(log_base, -700))
        return draw_tables(counts, base, np.full(len(counts), max(sweep.tables - 1, 0.0)), self.d, STRENGTH, np.clip(u, 1e-12, 1 - 1e-12), stir)

    def probabilities(
        self, words: list[bytes], counts: np.ndarray, hashes: np.ndarray, stir: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The known words' probabilities, and the parts of them at new tables, averaged over
        the sampled sweeps; in each the words' own tables are the sweep's draw."""
        whole, new = np.zeros(len(words)), np.zeros(len(words))
        at = positions(words)
        for s in self.sweeps:
            log_base = s.spelling.log_at(*at)
            fresh = (STRENGTH + self.d * s.tables) * np.exp(np.maximum(log_base, -700))
            new += fresh
            whole += fresh + counts - self.d * self.tables(s, hashes, counts, log_base, stir)
        scale = len(self.sweeps) * (STRENGTH + self.tokens)
        return whole / scale, new / scale

    def new_mass(self) -> float:
        """Probability of a new table, averaged over the sampled sweeps."""
        return sum((STRENGTH + self.d * s.tables) / (STRENGTH + self.tokens) for s in self.sweeps) / len(self.sweeps)


def tokens_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def count_words(docs: DataFrame) -> DataFrame:
    """word, c over all rows of ``docs`` (text); the end token of a row is the empty word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(out, names=["word", "c"])

        for _, texts in slices(batches, "text", TEXT_SLICE):
            for t in texts:
                held.update(tokens_of(t))
                held[b""] += 1
                if len(held) > MOST_WORDS:
                    yield flush()
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _cell_counts(words: DataFrame, model: Model | None, sweep: Sweep | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(cells, customers, tables): the spellings of all words' tables, drawn in ``sweep``;
    one table a word without it.  At most SYMBOLS^3 rows reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stir = stirling(model.d) if model else None
        cells: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        total = 0
        for batch, texts in slices(batches, "word", TEXT_SLICE // 8):
            context, symbol, starts = positions(texts)
            cell = context * SYMBOLS + symbol
            total += len(texts)
            found, n = np.unique(cell.astype(np.int32), return_counts=True)  # one table each
            cells.append(found.astype(np.int64))
            counts.append(n)
            if sweep is not None:
                c = column(batch, "c").to_numpy()
                t = model.tables(sweep, word_seeds(texts), c, sweep.spelling.log_at(context, symbol, starts), stir)
                more = np.repeat(t - 1, np.diff(np.append(starts, len(cell))))
                at = np.flatnonzero(more)
                found, which = np.unique(cell[at], return_inverse=True)
                cells.append(found)
                counts.append(np.bincount(which, weights=more[at], minlength=len(found)).astype(np.int64))
                total += int(t.sum()) - len(texts)
            if len(cells) > 200:
                found, which = np.unique(np.concatenate(cells), return_inverse=True)
                counts = [np.bincount(which, weights=np.concatenate(counts)).astype(np.int64)]
                cells = [found]
        if cells:
            found, which = np.unique(np.concatenate([*cells, [-1]]), return_inverse=True)
            sums = np.bincount(which, weights=np.concatenate([*counts, [total]])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums)], names=["cell", "n"])

    got = words.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = got["cell"].to_numpy(), got["n"].to_numpy()
    order = np.argsort(cell)
    cell, n = cell[order], n[order]
    if not len(cell):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    return cell[1:], n[1:], int(n[0])


def frequent(words: DataFrame, most: int = HEAD_WORDS) -> pa.Table:
    """The most frequent rows of a table with word and c, as many as ``most`` allows.

    A histogram of the counts (a few hundred buckets, partly summed in every task) gives the
    count from which on at most ``most`` words are; only these are collected, and nothing
    is sorted.  Words of more than HEAD_BYTES bytes stay out."""
    short = words.where(F.length("word") <= HEAD_BYTES)
    bucket = F.floor(F.log2("c") * 16).cast("int")
    cut, total = None, 0
    sizes = short.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()
    for r in sorted(sizes, key=lambda r: -r.b):
        total += r.n
        if total > most:
            break
        cut = r.b
    return (short.where(bucket >= cut) if cut is not None else short.limit(0)).toArrow()


def train(words: DataFrame, first: tuple[np.ndarray, np.ndarray, int], samples: int = SAMPLES, burn_in: int = BURN_IN) -> Model:
    """The model of a written table (word, c); ``first``: the cells of one table a word."""
    r = words.agg(
        F.sum("c").alias("n"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")
    ).first()
    model = Model(r.n or 0, _discount(r.n1 or 0, r.n2 or 0), [])
    cells, counts, tables = first
    for number in range(burn_in + samples):
        spelling = fit_spelling(cells, counts, number)
        sweep = Sweep(number, spelling, float(tables))
        if number >= burn_in:
            model.sweeps.append(sweep)
        if number + 1 < burn_in + samples:
            cells, counts, tables = _cell_counts(words, model, sweep)
    return model


def word_probabilities(words: DataFrame, model: Model) -> DataFrame:
    """code, n, tu, logp (log10), new (the part of the probability at new tables); sum_tu, sum_p: with
    tu and the probability added."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stir = stirling(model.d)
        for batch, texts in slices(batches, "word", TEXT_SLICE // 8):
            c = column(batch, "c").to_numpy()
            p, new = model.probabilities(texts, c, word_seeds(texts), stir)
            yield pa.RecordBatch.from_arrays(
                [
                    *(column(batch, k) for k in ("code", "n", "tu")),
                    pa.array(np.log10(p)),
                    pa.array(new),
                    pc.add(column(batch, "sum_tu"), column(batch, "tu")),
                    pc.add(column(batch, "sum_p"), pa.array(p)),
                ],
                names=["code", "n", "tu", "logp", "new", "sum_tu", "sum_p"],
            )

    return words.mapInArrow(run, "code long, n long, tu long, logp double, new double, sum_tu long, sum_p double")


# -- contexts ------------------------------------------------------------------------------


@dataclass
class Codes:
    """Numbers of words: the rank of a head word, a negative hash of any other."""

    hashes: np.ndarray  # uint64, sorted
    ranks: np.ndarray
    end: int

    @classmethod
    def of(cls, head: list[bytes]) -> Codes:
        hashes = _hashes(head)
        order = np.argsort(hashes)
        return cls(hashes[order], order.astype(np.int64), head.index(b"") if b"" in head else int(_hashes([b""]).view(np.int64)[0]))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = hashes.view(np.int64).copy()
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            out[hit] = self.ranks[at[hit]]
        return out

    def pairs(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, token before, token) at every token of the texts; before the first stands an end."""
        found = hash_words([t.translate(LOWER) for t in texts])
        lens = np.array([len(h) + 1 for h in found], dtype=np.int64)
        ends = np.cumsum(lens) - 1
        token = np.full(int(lens.sum()), self.end, dtype=np.int64)
        inner = np.ones(len(token), dtype=bool)
        inner[ends] = False
        token[inner] = self(np.concatenate(found) | _TAIL)
        before = np.concatenate([[self.end], token[:-1]])
        return np.repeat(np.arange(len(texts)), lens), before, token


_TAIL = U64(1 << 63)


def _hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of words without blanks, with the highest bit set; the empty word's is its own."""
    out = np.full(len(words), np.iinfo(np.uint64).max, dtype=U64)
    some = [i for i, w in enumerate(words) if w]
    if some:
        out[some] = hash_words([b" ".join(words[i] for i in some)])[0]
    return out | _TAIL


def with_codes(words: DataFrame, codes: Codes) -> DataFrame:
    """word, n, code of a table with word and c."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "word", TEXT_SLICE // 8):
            yield pa.RecordBatch.from_arrays(
                [column(batch, "word"), column(batch, "c"), pa.array(codes(_hashes(texts)))], names=["word", "n", "code"]
            )

    return words.select("word", "c").mapInArrow(run, "word binary, n long, code long")


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers, compressed; in four bytes each where they fit."""
    small = not len(x) or (int(x.min()) >= 0 and int(x.max()) < 1 << 32)
    data = x.astype(np.uint32 if small else np.int64).tobytes()
    return len(data).to_bytes(8, "little") + bytes([small]) + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[9:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(raw, dtype=np.uint32 if data[8] else np.int64).astype(np.int64)


@dataclass
class Block:
    """Some whole documents as numbers of words."""

    vocabulary: np.ndarray  # distinct codes
    tokens: np.ndarray  # places in the vocabulary, an end after each document
    lens: np.ndarray  # tokens of each document
    end: int

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(token before, token) at every token; before the first stands an end."""
        token = self.vocabulary[self.tokens]
        return np.concatenate([[self.end], token[:-1]]), token

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(u, w, key) of the distinct pairs by key, and every token's place among them."""
        u, w = self.pairs()
        key, first, place = np.unique(_pair_key(u, w), return_index=True, return_inverse=True)
        return u[first], w[first], key, place


_BLOCK = "block long, docs long, end long, tokens binary, words binary, lens binary, ids binary, named binary, held binary"


def blocks_of(docs: DataFrame, codes: Codes) -> DataFrame:
    """Blocks of whole documents (doc_id, text, held); a longer text is one alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part, texts in slices(batches, "text", TEXT_SLICE):
            row, _, token = codes.pairs(texts)
            words, tokens = np.unique(token, return_inverse=True)
            ids, held = column(part, "doc_id"), column(part, "held")
            data = (
                _packed(tokens),
                _packed(words),
                _packed(np.bincount(row, minlength=len(texts))),
                _packed(ids.fill_null(0).to_numpy()),
                ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
                held.to_numpy(zero_copy_only=False).tobytes(),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(texts)]), pa.array([codes.end]), *(pa.array([x], pa.binary()) for x in data)],
                names=[k.split()[0] for k in _BLOCK.split(", ")],
            )
            number += 1

    return docs.select("doc_id", "text", "held").mapInArrow(run, _BLOCK)


def _read(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[dict, Block]]:
    for i in range(batch.num_rows):
        r = batch.slice(i, 1).to_pylist()[0]
        yield r, Block(*(_unpacked(r[k]) for k in ("words", "tokens", "lens")), r["end"])


def _seen(r: dict, block: Block) -> np.ndarray:
    """Whether each token is one of the training."""
    return np.repeat(~np.frombuffer(r["held"], dtype=bool), block.lens)


def cell_totals(blocks: DataFrame) -> np.ndarray:
    """How often each cell (class of u, dish of w) occurs in the training."""
    n_cells = (CONTEXTS + 1) * (DISHES + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_cells, dtype=np.int64)
        for batch in batches:
            for r, block in _read(batch):
                u, w = block.pairs()
                cell = _class(u, CONTEXTS) * (DISHES + 1) + _class(w, DISHES)
                sums += np.bincount(cell[_seen(r, block)], minlength=n_cells)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["cell", "n"])

    got = blocks.select("end", "tokens", "words", "lens", "held").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_cells, dtype=np.int64)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out


def _bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a pair's key; it grows with the key."""
    return ((key >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def count_pairs(blocks: DataFrame, buckets: int) -> DataFrame:
    """bucket, block, at; u, w, c: the pairs that the training holds twice or more, by bucket,
    and for each block and bucket which pairs its own are.

    A block sends each of its pairs once, with its count in the training's documents, to the
    pair's bucket.  Rows with a block hold one number for each of its pairs, by key: 0 for
    one that the training does not hold, 1 for one that it holds once, 2 + i for the bucket's
    i-th pair by key."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, block in _read(batch):
                u, w, key, place = block.distinct()
                c = np.bincount(place[_seen(r, block)], minlength=len(key))
                cuts = np.searchsorted(_bucket_of(key, buckets), np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int32()),
                        pa.array(np.full(len(some), r["block"])),
                        *(pa.array([_packed(x[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()) for x in (u, w, c)),
                    ],
                    names=["bucket", "block", "u", "w", "c"],
                )

    def count(rows: pa.Table) -> pa.Table:
        bucket, block = rows["bucket"].to_pylist(), rows["block"].to_pylist()
        us, ws, cs = ([_unpacked(x) for x in rows[k].to_pylist()] for k in ("u", "w", "c"))
        u, w, c = (np.concatenate(x) for x in (us, ws, cs))
        _, first, place = np.unique(_pair_key(u, w), return_index=True, return_inverse=True)
        total = np.bincount(place, weights=c).astype(np.int64)
        many = np.flatnonzero(total > 1)
        number = total.copy()
        number[many] = np.arange(len(many)) + 2
        cuts = np.cumsum([len(x) for x in us])[:-1]
        at = [_packed(x) for x in np.split(number[place], cuts)]
        n = len(many)
        return pa.table(
            {
                "bucket": pa.array([*bucket, *bucket[:1] * n], pa.int32()),
                "block": pa.array([*block, *[None] * n], pa.int64()),
                "at": pa.array([*at, *[None] * n], pa.binary()),
                **{
                    k: pa.concat_arrays([pa.nulls(len(at), pa.int64()), pa.array(x[many])])
                    for k, x in (("u", u[first]), ("w", w[first]), ("c", total))
                },
            }
        )

    dealt = blocks.select("block", "end", "tokens", "words", "lens", "held").mapInArrow(
        deal, "bucket int, block long, u binary, w binary, c binary"
    )
    return dealt.groupBy("bucket").applyInArrow(count, "bucket int, block long, at binary, u long, w long, c long")


def _pair_key(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(mix64(u.view(U64)) * MIX_C + w.view(U64))


def _class(code, most: int):
    """Head words of rank below ``most`` are their own class; all others are class ``most``."""
    return np.where((code >= 0) & (code < most), code, most)


def class_cells(many: DataFrame, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cells, customers) of the classes' restaurants: the pairs' tables; cell = class * (DISHES + 1)
    + dish.  ``totals``: the cells' occurrences, of which the pairs seen once are a table each."""
    number = lambda c, most: F.when(F.col(c).between(0, most - 1), F.col(c)).otherwise(F.lit(most))
    cell = number("u", CONTEXTS) * (DISHES + 1) + number("w", DISHES)
    got = many.groupBy(cell.cast("long").alias("cell")).agg(F.sum(F.col("c") - F.col("t")).alias("n")).toArrow()
    counts = totals.copy()
    counts[got["cell"].to_numpy()] -= got["n"].to_numpy()
    cells = np.flatnonzero(counts)
    return cells, counts[cells]


def fit_contexts(cells: np.ndarray, counts: np.ndarray, samples: int = SAMPLES, burn_in: int = 2, seed: int = 1) -> np.ndarray:
    """Probabilities (context, dish), averaged over Gibbs sweeps of both levels' tables."""
    rng = np.random.default_rng(seed)
    n_dish = DISHES + 1
    context, dish = cells // n_dish, cells % n_dish
    tables = np.minimum(counts, 1)
    d, out = discount(counts), np.zeros((CONTEXTS + 1, n_dish))
    uniform = np.full(n_dish, 1 / n_dish)
    top = np.zeros(n_dish, dtype=np.int64)
    parent = None
    for sweep in range(burn_in + samples):
        if parent is not None:
            others = np.bincount(context, weights=tables, minlength=CONTEXTS + 1)[context] - tables
            tables = draw_tables(counts, parent[dish], others, d, STRENGTH, rng.random(len(cells)), stirling(d))
        c = np.bincount(dish, weights=tables, minlength=n_dish).astype(np.int64)
        d_top = discount(c)
        top = draw_tables(c, uniform, np.full(n_dish, max(top.sum() - 1.0, 0.0)), d_top, STRENGTH, rng.random(n_dish), stirling(d_top))
        parent = (c - d_top * top + (STRENGTH + d_top * top.sum()) / n_dish) / (STRENGTH + c.sum())
        if sweep >= burn_in:
            rows = parent[None, :].repeat(CONTEXTS + 1, axis=0)
            out += _predict(context, dish, counts, tables, d, np.arange(CONTEXTS + 1), rows) / samples
    return out


# -- scores --------------------------------------------------------------------------------

@dataclass
class Scorer:
    """What every task needs: bounded tables, by rank for the head."""

    end: int
    d: float
    counts: np.ndarray  # customers of the head words as contexts
    tables: np.ndarray  # and their tables
    classes: np.ndarray  # probabilities (class, dish)
    log_count: np.ndarray  # log10(count + 1) of the head words
    word: np.ndarray  # probabilities among other words; 1 for dishes
    unknown: float  # log10 probability of all unknown words among other words
    draws: int = 1  # of the pairs' tables, whose sums are given

    @classmethod
    def mean(cls, scorers: list[Scorer]) -> Scorer:
        """Of the levels fitted to several draws."""
        tables, classes, word = (np.mean([getattr(s, k) for s in scorers], axis=0) for k in ("tables", "classes", "word"))
        unknown = float(np.log10(np.mean([10.0**s.unknown for s in scorers])))
        one = scorers[0]
        return cls(one.end, one.d, one.counts, tables, classes, one.log_count, word, unknown, len(scorers))

    def base(self, u: np.ndarray, w: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Base probability of w in u's restaurant; ``p`` among other words, for those outside the head."""
        to = np.flatnonzero(w >= 0)
        p[to] = self.word[w[to]]
        return p * self.classes[_class(u, CONTEXTS), _class(w, DISHES)]

    def probability(self, c: np.ndarray, t: np.ndarray, cu: np.ndarray, tu: np.ndarray, base: np.ndarray) -> np.ndarray:
        return (c - self.d * t + (STRENGTH + self.d * tu) * base) / (STRENGTH + cu)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` materialized; the shuffle files of its writing go with it, as nothing reads them again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return materialize(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def _forget(*tables: DataFrame) -> None:
    """Delete the files of materialized tables that nothing reads any more."""
    for t in tables:
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            remove_folder(t.sparkSession, folder)


def fit_levels(
    words: DataFrame, many: DataFrame, totals: np.ndarray, first: tuple[np.ndarray, np.ndarray, int], codes: Codes, d: float, log_count: np.ndarray,
    earlier: DataFrame | None = None,
) -> tuple[Scorer, DataFrame]:
    """The levels above the pairs, whose tables are their customers, and the words' table:
    code, n, tu, logp (NULL for dishes), and the sums of tu and the probability over ``earlier`` draws and this one.

    A word is as often a context as a token, and a pair seen once has one table: a word's
    tables and customers are its occurrences, less what the pairs seen more often have fewer."""
    less = F.col("c") - F.col("t")
    sides = many.where("c > t").select(F.explode(F.array(*(F.struct(F.col(k).alias("code"), *(F.when(F.lit(k == x), less).otherwise(0).alias(f"d{x}") for x in "uw")) for k in "uw"))).alias("x"))
    fewer = sides.groupBy("x.code").agg(F.sum("x.du").alias("du"), F.sum("x.dw").alias("dw"))
    fewer = words.join(fewer, "code", "left")
    for k, x in (("c", "dw"), ("tu", "du")):
        fewer = fewer.withColumn(k, F.col("n") - F.coalesce(F.col(x), F.lit(0)))
    others = _kept(fewer.select("word", "code", "n", "c", "tu"), "lm_customers")
    tail = others.where(f"code < 0 or code >= {DISHES}")
    model = train(tail, first)
    sums = [F.lit(0).cast("long").alias("sum_tu"), F.lit(0.0).alias("sum_p")]
    summed = tail.select("word", "code", "n", "c", "tu", *sums) if earlier is None else tail.join(earlier.select("code", "sum_tu", "sum_p"), "code")
    known = _kept(word_probabilities(summed, model), "lm_probabilities")
    seen = known.agg(F.sum("new").alias("new")).first().new or 0.0
    n = len(log_count)
    counts, tables, word = np.zeros(n), np.zeros(n), np.ones(n)
    got = others.where("code >= 0").select("code", "n", "tu").toArrow()
    counts[got["code"].to_numpy()], tables[got["code"].to_numpy()] = got["n"].to_numpy(), got["tu"].to_numpy()
    _forget(others)
    got = known.where("code >= 0").select("code", "logp").toArrow()
    word[got["code"].to_numpy()] = 10.0 ** got["logp"].to_numpy()
    unknown = float(np.log10(max(model.new_mass() - seen, 1e-300)))
    return Scorer(codes.end, d, counts, tables, fit_contexts(*class_cells(many, totals)), log_count, word, unknown), known


def with_levels(rows: DataFrame, contexts: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` (u, w) with tu, logp of the words outside the head; NULL elsewhere.
    Head words get keys of their own that match nothing, so no key is common."""
    apart = F.shiftrightunsigned(F.xxhash64("u", "w"), 1)
    rows = rows.withColumn("_u", F.when(F.col("u") < 0, F.col("u")).otherwise(apart))
    rows = rows.withColumn("_w", F.when(F.col("w") < 0, F.col("w")).otherwise(apart))
    far = contexts.where("u < 0").select(F.col("u").alias("_u"), "tu")
    words = known.where("code < 0").select(F.col("code").alias("_w"), "logp")
    return rows.join(far, "_u", "left").join(words, "_w", "left").drop("_u", "_w")


def draw_pairs(many: DataFrame, contexts: DataFrame, known: DataFrame, scorer: Scorer, sweep: int) -> DataFrame:
    """bucket, u, w, c, t, sum_t: ``many`` with its tables drawn, given the tables of all other pairs, and
    the sum of all draws."""
    sent = many.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        stir = stirling(own.d)
        for batch in batches:
            u, w, c, t = (column(batch, k).to_numpy() for k in ("u", "w", "c", "t"))
            tu = column(batch, "tu").fill_null(0).to_numpy().astype(np.float64)
            at = np.flatnonzero(u >= 0)
            tu[at] = own.tables[u[at]]
            base = own.base(u, w, 10.0 ** column(batch, "logp").fill_null(own.unknown).to_numpy())
            seed = _pair_key(u, w) ^ mix64(np.array([sweep + 1], dtype=U64))
            x = np.clip((mix64(seed) >> U64(11)).astype(np.float64) / 2.0**53, 1e-12, 1 - 1e-12)
            drawn = draw_tables(c, base, np.maximum(tu - t, 0.0), own.d, STRENGTH, x, stir)
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, k) for k in ("bucket", "u", "w", "c")), pa.array(drawn), pc.add(column(batch, "sum_t"), pa.array(drawn))],
                names=["bucket", "u", "w", "c", "t", "sum_t"],
            )

    nothing = {"tu": F.lit(None).cast("long"), "logp": F.lit(None).cast("double")}
    near = many.where("u >= 0 and w >= 0").withColumns(nothing)
    rows = near.unionByName(with_levels(many.where("u < 0 or w < 0"), contexts, known))
    return rows.mapInArrow(run, "bucket int, u long, w long, c long, t long, sum_t long")


def pair_tables(pairs: DataFrame, many: DataFrame, once: int = 1) -> DataFrame:
    """block, bucket, c, t: customers and tables of a block's pairs, by key; ``once``: the tables of a pair seen once."""

    def look(own: pa.Table, many: pa.Table) -> pa.Table:
        order = np.argsort(_pair_key(many["u"].to_numpy(), many["w"].to_numpy()))
        c, t = (np.concatenate([[0, one], many[k].to_numpy()[order]]) for k, one in (("c", 1), ("t", once)))
        found = []
        for x in own["at"].to_pylist():
            at = _unpacked(x)
            found.append((_packed(c[at]), _packed(t[at])))
        data = [pa.array(x, pa.binary()) for x in zip(*found, strict=True)] or [pa.array([], pa.binary())] * 2
        return pa.table([own["block"].combine_chunks(), own["bucket"].combine_chunks(), *data], names=["block", "bucket", "c", "t"])

    own = pairs.where("block is not null").select("bucket", "block", "at")
    many = many.select("bucket", "u", "w", "c", "t")
    return own.groupBy("bucket").cogroup(many.groupBy("bucket")).applyInArrow(look, "block long, bucket int, c binary, t binary")


def levels_of_blocks(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """block, code, n, tu, logp of a block's words outside the head, but for unknown ones."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in zip(column(batch, "block").to_pylist(), column(batch, "words").to_pylist(), strict=True):
                code = _unpacked(x)
                code = code[code < 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), i)), pa.array(code)], names=["block", "code"])

    asked = blocks.select("block", "words").mapInArrow(ask, "block long, code long")
    return asked.join(known.where("code < 0").select("code", "n", "tu", "logp"), "code")


def score_blocks(blocks: DataFrame, found: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, held, n_tokens, n_known, base (sum of log10(c + 1)), score of every document.

    ``found``: the tables of the blocks' pairs and the levels of their words outside the head."""
    sent = blocks.sparkSession.sparkContext.broadcast(scorer)

    def score(own: pa.Table, found: pa.Table) -> pa.Table:
        scorer, parts = sent.value, []
        levels = found.filter(pc.is_null(found["bucket"]))
        tables = found.filter(pc.is_valid(found["bucket"])).sort_by("bucket")
        code = levels["code"].to_numpy()
        order = np.argsort(code)
        code = code[order]
        for r, block in _read(own):
            words = block.vocabulary
            n, tu, p = np.zeros(len(words)), np.zeros(len(words)), np.full(len(words), 10.0**scorer.unknown)
            at = np.flatnonzero(words >= 0)
            n[at], tu[at] = scorer.counts[words[at]], scorer.tables[words[at]]
            log_count = np.zeros(len(words))
            log_count[at] = scorer.log_count[words[at]]
            if len(code):
                at = np.minimum(np.searchsorted(code, words), len(code) - 1)
                hit = np.flatnonzero(code[at] == words)
                at = order[at[hit]]
                n[hit], tu[hit] = levels["n"].to_numpy()[at], levels["tu"].to_numpy()[at]
                p[hit] = 10.0 ** levels["logp"].to_numpy()[at]
                log_count[hit] = np.log10(n[hit] + 1.0)
            u, w, key, place = block.distinct()
            c, t = (np.concatenate([_unpacked(x) for x in tables[k].to_pylist()]) for k in ("c", "t"))
            if len(c) != len(key):
                raise RuntimeError(f"block {r['block']}: tables of {len(c)} of {len(key)} pairs")
            before = np.searchsorted(words, u)
            to = np.searchsorted(words, w)
            value = np.log10(scorer.probability(c, t / scorer.draws, n[before], tu[before], scorer.base(u, w, p[to])))
            row = np.repeat(np.arange(len(block.lens)), block.lens)
            of = lambda x, token: np.bincount(row, x[token], len(block.lens))
            named = np.frombuffer(r["named"], dtype=bool)
            parts.append(
                pa.table(
                    {
                        "doc_id": pa.array(_unpacked(r["ids"]), mask=~named),
                        "held": pa.array(np.frombuffer(r["held"], dtype=bool)),
                        "n_tokens": pa.array(block.lens),
                        "n_known": pa.array(of(n > 0, block.tokens).astype(np.int64)),
                        "base": pa.array(of(log_count, block.tokens)),
                        "score": pa.array(of(value, place)),
                    }
                )
            )
        return pa.concat_tables(parts)

    kind = "doc_id long, held boolean, n_tokens long, n_known long, base double, score double"
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, kind)


def language_model_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Rows whose crc32(id) mod ``modulus`` is ``held`` are held out of the training; rows
    without an id count as remainder 0.  Tokens are the words, A-Z lower-cased, and one end;
    a NULL or blank text is its end alone.  ``base_score`` is the add-one unigram model's,
    ``score`` this model's log10 probability, over the same events: the training's tokens, and
    one for all others.  Repeated rows count, and are scored, each.  An empty table gives no
    rows; without training rows, all words are unknown to both models.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("held", crc_of(F.col("doc_id"), modulus) == held)
    counted = _kept(count_words(rows.where("not held")), "lm_words")
    top = frequent(counted)
    by_count = sorted(zip(top["c"].to_pylist(), top["word"].to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    codes = Codes.of([w for _, w in by_count])
    words = _kept(with_codes(counted, codes), "lm_codes")
    _forget(counted)
    totals = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    blocks = _kept(blocks_of(rows, codes), "lm_blocks")
    pairs = _kept(count_pairs(blocks, (totals.n or 0) // BUCKET_TOKENS + 1), "lm_pairs")
    many = pairs.where("block is null").select("bucket", "u", "w", "c", F.lit(1).cast("long").alias("t"), F.lit(0).cast("long").alias("sum_t"))
    sums = many.agg(F.sum("c").alias("n"), F.count_if(F.col("c") == 2).alias("n2")).first()
    d = _discount((totals.n or 0) - (sums.n or 0), sums.n2 or 0)
    cells = cell_totals(blocks)
    spelled = _cell_counts(words.where(f"code < 0 or code >= {DISHES}"), None, None)
    log_count = np.log10(np.array([c for c, _ in by_count], dtype=np.float64) + 1.0)
    scorers, known = [], None
    for sweep in range(PAIR_SWEEPS + 1):
        scorer, fitted = fit_levels(words, many, cells, spelled, codes, d, log_count, known if sweep > 1 else None)
        if known is not None:
            _forget(known)
        known = fitted
        if sweep:  # fitted to a draw
            scorers.append(scorer)
        if sweep < PAIR_SWEEPS:
            contexts = known.select(F.col("code").alias("u"), "tu")
            drawn = _kept(draw_pairs(many, contexts, known, scorer, sweep), "lm_tables")
            if sweep:  # the first ``many`` is part of ``pairs``
                _forget(many)
            many = drawn
    _forget(words)
    scorer, draws = Scorer.mean(scorers), len(scorers)
    mean = known.select("code", "n", (F.col("sum_tu") / draws).alias("tu"), F.log10(F.col("sum_p") / draws).alias("logp"))
    tables = pair_tables(pairs, many.withColumn("t", F.col("sum_t")), draws)
    found = tables.unionByName(levels_of_blocks(blocks, mean), allowMissingColumns=True)
    found = _kept(found, "lm_found")
    _forget(pairs, many, known)
    out = score_blocks(blocks, found, scorer)
    floor = float(np.log10((totals.n or 0) + totals.v + 1.0))
    return out.select(
        "doc_id",
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(totals.n or 0).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        "score",
    )
