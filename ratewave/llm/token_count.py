"""Token counts by a compiled finite-state transducer of a byte-level BPE vocabulary.

Two machines.  The pretokeniser's classes (letter, number, white space, other) mark
where pretokens begin; class tests run over whole arrays of code points.  Inside a
pretoken a deterministic transducer reads bytes.  Its state after a prefix p holds,
for every place from which a token could still reach beyond p, the last token of the
BPE encoding up to there and the number of tokens up to there less that of p.  That
is enough to find the last token of p + byte: the one token that ends there whose
pair with the last token before it does not merge or split (for a vocabulary in
merge order a sequence is the BPE encoding exactly if each neighbouring pair is its
own encoding).  Each transition is annotated with the count of tokens it emits (it
may be 0 or negative, when tokens fuse), so the count of a pretoken is the sum over
its path.  Transitions are compiled when first met and kept in a dense table; all
pretokens of a slice step through the table together.

The two form one machine over bytes: a byte that begins a pretoken leaves from the
first state, whatever the state was.  The pretokeniser's own memory is bounded (whether
a character begins a pretoken depends on its neighbours alone), that inside a pretoken
is the transducer's state.

A long text is cut into chunks at any bytes.  A chunk's state map gives, for the states
in which it may be entered, the state after it and the tokens emitted in it.  The states
to expect are those after the chunk before it: where a pretoken begins there, its exit
is the same for all entries; else they come from warm-ups over its last bytes.  All
chunks of a window step together; neighbouring maps compose tree-wise, and a map that
meets a state it has not been tabled for is extended by it, so that the scan is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewave.llm.common import column, read_byte_bpe, slices

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 255
#: The endings that this vocabulary family splits off after an apostrophe (fixed values of the format).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Bytes of a chunk; of a window, whose chunks step together; of the warm-ups before a chunk.
CHUNK, WINDOW, WARM = 2_048, 1 << 20, (32, 64)
#: Bytes up to which a piece is counted with the others of its slice, not by the scan.
WHOLE = 16_384
#: Bytes on each side of a window that decide where its pretokens begin (8 characters or more).
MARGIN = 32
#: Compiled states that a worker keeps before it starts anew.
MOST_STATES = 160_000
DELTA0 = 32  # stored transition: next state * 64 + emitted count + DELTA0
TEXT_SLICE = 1 << 20


class Transitions:
    """state * 256 + byte -> transition: an open-addressing table that whole arrays probe at once."""

    def __init__(self, bits: int = 14) -> None:
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.vals = np.zeros(1 << bits, dtype=np.int32)

    def _home(self, slots: np.ndarray) -> np.ndarray:
        return ((slots.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, slots: np.ndarray) -> np.ndarray:
        """The transitions of ``slots``, -1 where there is none yet."""
        at = self._home(slots)
        keys = self.keys[at]
        out = np.where(keys == slots, self.vals[at], -1)
        left = np.flatnonzero((keys != slots) & (keys >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            keys = self.keys[at[left]]
            hit = keys == slots[left]
            out[left[hit]] = self.vals[at[left[hit]]]
            left = left[~hit & (keys >= 0)]
        return out

    def one(self, slot: int) -> int:
        """The same for one slot."""
        at, mask = ((slot * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> (64 - self.bits), len(self.keys) - 1
        while (key := int(self.keys[at])) >= 0:
            if key == slot:
                return int(self.vals[at])
            at = (at + 1) & mask
        return -1

    def put(self, slot: int, value: int) -> None:
        if 2 * self.used >= len(self.keys):
            full = self.keys >= 0
            keys, vals = self.keys[full].tolist(), self.vals[full].tolist()
            self.__init__(self.bits + 2)
            for k, v in zip(keys, vals, strict=True):
                self.put(k, v)
        at, mask = ((slot * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> (64 - self.bits), len(self.keys) - 1
        while self.keys[at] >= 0:
            at = (at + 1) & mask
        self.keys[at], self.vals[at] = slot, value
        self.used += 1


class Transducer:
    """The compiled machine of one vocabulary; grows as new transitions are met."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokens, self.special, self.parts = read_byte_bpe(path)
        self.rank = {t: i for i, t in enumerate(self.tokens) if t}
        self.merged = {pair: i for i, pair in self.parts.items()}
        self.prefixes = {t[:i] for t in self.rank for i in range(len(t))}
        self._split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.kinds = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self._reset()

    # -- the machine inside a pretoken ---------------------------------------------

    def _reset(self) -> None:
        self._pairs: dict[tuple[int, int], bool] = {}
        start = ((b"", -1, 0),)
        self.states = [start]
        self._entries: dict[tuple, tuple] = {}  # equal parts of states are held once
        self.number = {start: 0}
        self.next = Transitions()

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(piece, rank at which it is used up) along the right (1) or left (0) edge of a token."""
        out, until = [], 1 << 30
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out
            token, until = self.parts[token][side], token

    def stays(self, a: int, b: int) -> bool:
        """Whether token a followed by token b is the encoding of their bytes.

        It isn't if, while both are built, a piece at the right edge of a and one at
        the left edge of b merge before either is used up; of equal pairs the left goes first.
        """
        if a < 0:
            return True
        got = self._pairs.get((a, b))
        if got is None:
            right = self._spine(b, 0)
            got = not any(
                (r := self.merged.get((x, y), 1 << 30)) < x_end and r <= y_end and r < 1 << 30
                for x, x_end in self._spine(a, 1)
                for y, y_end in right
            )
            if len(self._pairs) > 300_000:
                self._pairs.clear()
            self._pairs[a, b] = got
        return got

    def _number(self, key: tuple) -> int:
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        return to

    def bounded(self, state: int = 0) -> int:
        """Forget all states if they are too many; the number of ``state`` from now on."""
        if len(self.states) <= MOST_STATES:
            return state
        key = self.states[state]
        self._reset()
        return self._number(key)

    def compile(self, slot: int) -> int:
        """Make the transition of ``slot`` = state * 256 + byte."""
        state, byte = self.states[slot >> 8], bytes([slot & 255])
        grown, found = [], None
        for suffix, last, rel in state:
            s = suffix + byte
            if found is None and (token := self.rank.get(s)) is not None and self.stays(last, token):
                found = (token, rel + 1)
            if s in self.prefixes:
                grown.append((s, last, rel))
        token, emitted = found
        once = self._entries.setdefault
        if not -DELTA0 <= emitted < DELTA0:
            raise ValueError(f"a transition emits {emitted} tokens")
        to = self._number(tuple(once(e, e) for e in (*((s, last, rel - emitted) for s, last, rel in grown), (b"", token, 0))))
        value = to * 64 + emitted + DELTA0
        self.next.put(slot, value)
        return value

    def run(
        self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, entry: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(state after, tokens emitted) of each run raw[start : start + length], entered in the
        states ``entry`` (the first state without it); all step together."""
        order = np.argsort(-lengths, kind="stable")
        at, lens = starts[order], lengths[order]
        state = np.zeros(len(at), dtype=np.int64) if entry is None else entry[order].astype(np.int64)
        count = np.zeros(len(at), dtype=np.int64)
        # live[k]: pretokens longer than k
        live = len(lens) - np.cumsum(np.bincount(lens))[:-1] if len(lens) else ()
        for k, n in enumerate(live):
            n = int(n)
            if n < 4:  # the few longest: on their own
                for i in range(n):
                    state[i], more = self.walk(int(state[i]), raw[at[i] + k : at[i] + lens[i]].tobytes())
                    count[i] += more
                break
            slots = state[:n] * 256 + raw[at[:n] + k]
            got = self.next.get(slots)
            if got.min() < 0:
                new = np.flatnonzero(got < 0)
                unique, which = np.unique(slots[new], return_inverse=True)
                got[new] = np.array([self.compile(s) for s in unique.tolist()])[which]
            state[:n] = got >> 6
            count[:n] += (got & 63) - DELTA0
        exits, out = np.empty_like(state), np.empty_like(count)
        exits[order], out[order] = state, count
        return exits, out

    def walk(self, state: int, raw: bytes) -> tuple[int, int]:
        """The same for one run, byte by byte."""
        total = 0
        for byte in raw:
            slot = state * 256 + byte
            got = self.next.one(slot)
            if got < 0:
                got = self.compile(slot)
            state = got >> 6
            total += (got & 63) - DELTA0
        return state, total

    # -- pretoken starts --------------------------------------------------------------

    def classes(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        if (kinds == UNKNOWN).any():
            for c in np.unique(points[kinds == UNKNOWN]).tolist():
                alone = [len(self._split(before + chr(c))) == 1 for before in "a1!"]
                self.kinds[c] = alone.index(True) if any(alone) else SPACE
            kinds = self.kinds[points]
        return kinds

    def pretoken_starts(self, points: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Whether a pretoken begins at each character; ``edge``: where a piece does, and the end."""
        n = len(points)
        kind = self.classes(points)
        run = edge[:-1].copy()
        run[1:] |= kind[1:] != kind[:-1]
        blank = points == 0x20
        space = kind == SPACE
        after_blank = np.zeros(n, dtype=bool)  # a blank of the same piece stands before it
        after_blank[1:] = blank[:-1] & ~edge[1:-1]
        start = run & (space | ~after_blank)
        last = np.zeros(n, dtype=bool)  # the last white space before other characters
        last[:-1] = space[:-1] & ~space[1:] & ~edge[1:-1]
        start |= last
        # endings after an apostrophe that begins its pretoken and stands alone
        tick = np.flatnonzero((points[:-1] == 0x27) & start[:-1] & run[:-1] & ~edge[1:-1] & (kind[1:] == LETTER))
        if len(tick):
            tail = np.concatenate([points, np.zeros(2, dtype=np.uint32)])
            broken = np.concatenate([edge, [True]])
            size = np.zeros(len(tick), dtype=np.int64)
            for e in ENDINGS:
                hit = tail[tick + 1] == ord(e[0])
                if len(e) == 2:
                    hit &= (tail[tick + 2] == ord(e[1])) & ~broken[tick + 2]
                size[hit & (size == 0)] = len(e)
            tick, size = tick[size > 0], size[size > 0]
            start[tick + 1] = False
            rest = tick + 1 + size
            rest = rest[rest < n]
            start[rest] |= (kind[rest] == LETTER) & ~run[rest]
        return start

    def count_pieces(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece (text without special strings), pieces apart from each other."""
        out = np.zeros(len(pieces), dtype=np.int64)
        full = [i for i, p in enumerate(pieces) if p]
        if not full:
            return out
        joined = b"".join(pieces[i] for i in full)
        points, offset = characters(joined)
        edge = np.zeros(len(points) + 1, dtype=bool)
        ends = np.cumsum([len(pieces[i]) for i in full])
        edge[np.searchsorted(offset, np.concatenate([[0], ends]))] = True
        first = offset[:-1][self.pretoken_starts(points, edge)]
        lens = np.diff(np.append(first, len(joined)))
        _, counts = self.run(np.frombuffer(joined, dtype=np.uint8), first, lens)
        sums = np.concatenate([[0], np.cumsum(counts)])
        at = np.searchsorted(first, np.concatenate([[0], ends]))
        out[full] = np.diff(sums[at])
        return out


def characters(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(code points, their places in bytes and the end) of a UTF-8 text."""
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    return points, np.concatenate([[0], np.cumsum(width)])


# -- chunks ------------------------------------------------------------------------------


class ChunkMap:
    """What a chunk does to the state before it: ``known`` tables entry -> (exit, tokens).

    Of a single chunk, ``head`` is what still depends on the entry; after it, if a pretoken
    begins in the chunk, ``rest`` = (exit, tokens) does not.  Of a composed one, ``parts``
    are the maps that it was made of.  An entry that is not tabled yet is run, and tabled."""

    __slots__ = ("head", "known", "parts", "rest")

    def __init__(self, head: bytes = b"", rest: tuple[int, int] | None = None, parts: tuple[ChunkMap, ...] = ()) -> None:
        self.head, self.rest, self.parts = head, rest, parts
        self.known: dict[int, tuple[int, int]] = {}

    def table(self, entry: int, to: int, n: int) -> None:
        """``head``, entered in ``entry``, was left in ``to`` with ``n`` tokens."""
        self.known[entry] = (to, n) if self.rest is None else (self.rest[0], n + self.rest[1])

    def __call__(self, machine: Transducer, entry: int) -> tuple[int, int]:
        if entry not in self.known:
            if self.parts:
                to, total = entry, 0
                for part in self.parts:
                    to, n = part(machine, to)
                    total += n
                self.known[entry] = to, total
            else:
                self.table(entry, *machine.walk(entry, self.head))
        return self.known[entry]


def compose(machine: Transducer, x: ChunkMap, y: ChunkMap) -> ChunkMap:
    """The map of ``x`` and then ``y``, tabled for the entries of ``x``."""
    out = ChunkMap(parts=(x, y))
    for entry in x.known:
        out(machine, entry)
    return out


def window_starts(machine: Transducer, raw: bytes, lo: int, hi: int) -> np.ndarray:
    """Places in raw[lo:hi] where a pretoken begins; ``lo`` and ``hi`` begin characters."""
    a, b = max(lo - MARGIN, 0), min(hi + MARGIN, len(raw))
    while a and (raw[a] & 0xC0) == 0x80:
        a -= 1
    while b < len(raw) and (raw[b] & 0xC0) == 0x80:
        b += 1
    points, offset = characters(raw[a:b])
    edge = np.zeros(len(points) + 1, dtype=bool)
    edge[[0, -1]] = True
    at = a + offset[:-1][machine.pretoken_starts(points, edge)]
    return at[(at >= lo) & (at < hi)]


def chunk_maps(machine: Transducer, raw: bytes, lo: int, hi: int, chunk: int = CHUNK) -> list[ChunkMap]:
    """The maps of the chunks of raw[lo:hi], tabled for the states in which they are expected
    to be entered; the first one, whose entry is the caller's, for none."""
    data = np.frombuffer(raw, dtype=np.uint8)
    first = window_starts(machine, raw, lo, hi)
    begins = np.arange(lo, hi, chunk)
    ends = np.minimum(begins + chunk, hi)
    # pretokens, and the parts of them before a chunk's end, from the first state
    stop = np.minimum(np.append(first[1:], hi), ends[(first - lo) // chunk])
    exits, counts = machine.run(data, first, stop - first)
    sums = np.concatenate([[0], np.cumsum(counts)])
    i, j = np.searchsorted(first, begins), np.searchsorted(first, ends)
    begun = i < j
    head_ends = ends.copy()
    head_ends[begun] = first[i[begun]]
    maps = [
        ChunkMap(raw[a:b], (int(exits[y - 1]), int(sums[y] - sums[x])) if x < y else None)
        for a, b, x, y in zip(begins.tolist(), head_ends.tolist(), i.tolist(), j.tolist(), strict=True)
    ]
    # expected entries: the exit of the chunk before if a pretoken begins there, else warm-ups
    after = np.flatnonzero(begun[:-1]) + 1
    which, entry = [after], [exits[j[after - 1] - 1]]
    unsure = np.flatnonzero(~begun[:-1]) + 1
    for warm in WARM:
        length = np.minimum(begins[unsure] - lo, warm)
        state, _ = machine.run(data, begins[unsure] - length, length)
        which.append(unsure)
        entry.append(state)
    which, entry = np.concatenate(which), np.concatenate(entry)
    to, n = machine.run(data, begins[which], head_ends[which] - begins[which], entry)
    for k, e, x, m in zip(which.tolist(), entry.tolist(), to.tolist(), n.tolist(), strict=True):
        maps[k].table(e, x, m)
    return maps


def scan(machine: Transducer, raw: bytes, chunk: int = CHUNK, window: int = WINDOW) -> int:
    """Tokens of a long piece, by the tree-wise composition of its chunks' maps, window by window."""
    state = total = lo = 0
    while lo < len(raw):
        hi = min(lo + window, len(raw))
        while hi < len(raw) and (raw[hi] & 0xC0) == 0x80:
            hi += 1
        state = machine.bounded(state)
        maps = chunk_maps(machine, raw, lo, hi, chunk)
        while len(maps) > 1:
            made = [compose(machine, x, y) for x, y in zip(maps[::2], maps[1::2], strict=False)]
            maps = made + (maps[-1:] if len(maps) % 2 else [])
        state, n = maps[0](machine, state)
        total += n
        lo = hi
    return total


def count_texts(
    machine: Transducer, texts: list[bytes], chunk: int = CHUNK, window: int = WINDOW, whole: int = WHOLE
) -> np.ndarray:
    """Tokens of each whole text; a special string in it is one token, and what stands between
    such strings goes through the scan of its chunks' maps if it is longer than ``whole``."""
    out = np.zeros(len(texts), dtype=np.int64)
    pieces, owner = texts, np.arange(len(texts))
    for s in machine.special:
        mark = s.encode()
        if any(mark in p for p in pieces):
            split = [p.split(mark) for p in pieces]
            np.add.at(out, owner, [len(x) - 1 for x in split])
            owner = np.repeat(owner, [len(x) for x in split])
            pieces = [p for x in split for p in x]
    machine.bounded()
    is_long = np.array([len(p) > whole for p in pieces], dtype=bool)
    short = np.flatnonzero(~is_long)
    np.add.at(out, owner[short], machine.count_pieces([pieces[i] for i in short]))
    for i in np.flatnonzero(is_long).tolist():
        out[owner[i]] += scan(machine, pieces[i], chunk, window)
    return out


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, whole texts.

    NULL counts as the empty text (0 bytes, 0 tokens).  Rows are independent: repeated
    rows and ids give repeated results; an empty table gives none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for part, texts in slices(batches, "text", TEXT_SLICE):
            n = count_texts(machine, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(n > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
