"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A text is cut into chunks where a rolling hash of the last 16 bytes meets a
pattern, so equal passages of different documents are cut alike.  A task encodes
each distinct chunk once (a cache of bounded size, looked up by the chunk's whole
content).  A chunk's first and last tokens may differ from the whole text's, so
each join is repaired: the span between the nearest places left and right of it
where tokens can't join is encoded anew.  Such a place is an ASCII word or
punctuation character followed by a space or line feed: no pretoken of the
vocabulary's pattern crosses it, and what stands left of it has no influence on
what follows.  The repair is accepted where both chunks have a token boundary at
the ends of the span; else the span grows.

Nothing is shuffled: a row is read, encoded, decoded and digested in one task.
Chunks repeated in other tasks are encoded there again; sharing them would move
every text and every id list through a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewave.llm.common import column, read_byte_bpe, slices

#: Chunks have at least MIN_CHUNK bytes, and about 1 / MASK of the places after that are cut.
MIN_CHUNK, MASK = 192, 0x1FF
WINDOW = 16
#: Chunk bytes that a task's cache holds before it starts anew.
CACHE_BYTES = 3 << 20
TEXT_SLICE = 1 << 20
#: The pretoken pattern of this vocabulary family (a fixed value of the format).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _gear() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**32, 256, dtype=np.uint32)


def rolling_hash(raw: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes that end at each place: sum of gear[byte] << distance."""
    h = _GEAR[raw]
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


_GEAR = _gear()


class ChunkedBPE:
    """Encoder of one vocabulary with its chunk cache; one per Python worker."""

    def __init__(self, path: str) -> None:
        import tiktoken

        self.tokens, self.special, _ = read_byte_bpe(path)
        ranks = {t: i for i, t in enumerate(self.tokens) if t}
        self.bpe = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max([len(self.tokens), *(i + 1 for i in self.special.values())])
        self.tokens += [b""] * (size - len(self.tokens))
        for s, i in self.special.items():
            self.tokens[i] = s.encode()
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.cache: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self.cached = 0
        self.encoded = self.reused = 0

    def plain(self, raw: bytes) -> np.ndarray:
        """Ids of a text without special strings, encoded as a whole."""
        return self.bpe.encode_to_numpy(raw.decode("utf-8"), disallowed_special=())

    def chunk(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(ids, end of each token in bytes) of a chunk, from the cache if it is there."""
        got = self.cache.get(raw)
        if got is None:
            ids = self.plain(raw)
            got = ids, np.cumsum(self.lengths[ids])
            self.encoded += 1
            if self.cached > CACHE_BYTES:
                self.cache.clear()
                self.cached = 0
            self.cache[raw] = got
            self.cached += len(raw) + 10 * len(ids)
        else:
            self.reused += 1
        return got

    def cuts(self, raw: bytes) -> list[int]:
        """Chunk ends: content-defined, at character starts, MIN_CHUNK apart."""
        if len(raw) <= MIN_CHUNK:
            return [len(raw)]
        b = np.frombuffer(raw, dtype=np.uint8)
        at = np.flatnonzero((rolling_hash(b)[:-1] & np.uint32(MASK)) == 0) + 1
        at = at[(b[at] & 0xC0) != 0x80].tolist()
        out, last = [], 0
        for p in at:
            if p - last >= MIN_CHUNK and len(raw) - p > 0:
                out.append(p)
                last = p
        return [*out, len(raw)]

    @staticmethod
    def _break_before(raw: bytes, p: int, least: int) -> int:
        """The last place in [least, p] where no token can join, or ``least``."""
        while (p := max(raw.rfind(b" ", least, p + 1), raw.rfind(b"\n", least, p + 1))) > least:
            if 32 < raw[p - 1] < 127:
                return p
            p -= 1
        return least

    @staticmethod
    def _break_after(raw: bytes, p: int) -> int:
        """The first such place at or after ``p``, or the end."""
        n = len(raw)
        while p < n:
            a, b = raw.find(b" ", p), raw.find(b"\n", p)
            p = min(x if x >= 0 else n for x in (a, b))
            if p < n and p > 0 and 32 < raw[p - 1] < 127:
                return p
            p += 1
        return n

    def ordinary(self, raw: bytes) -> np.ndarray:
        """Ids of a text without special strings, through its chunks."""
        ends = self.cuts(raw)
        if len(ends) == 1:
            return self.chunk(raw)[0]
        parts: list[np.ndarray] = []
        done = 0  # ids of raw[:done] are in parts
        start = 0
        for end in ends:
            if start < done:  # a repair reached into this chunk, or past it
                if done < end:
                    ids, at = self.chunk(raw[start:end])
                    first = int(np.searchsorted(at, done - start))
                    if at[first] == done - start:  # agreement: the chunk has this boundary too
                        keep, skip = end - start, first + 1
                    else:
                        ids, at = self.chunk(raw[done:end])
                        start, keep, skip = done, end - done, 0
                else:
                    start = end
                    continue
            else:
                ids, at = self.chunk(raw[start:end])
                keep, skip = end - start, 0
            if end < len(raw):
                left = self._break_before(raw, end, done)
                upto = int(np.searchsorted(at, left - start, side="right")) if left > start else 0
                if left > done and (not upto or at[upto - 1] != left - start):
                    left, upto = done, skip  # no agreement here: encode all since the last one
                parts.append(ids[skip : max(upto, skip)])
                right = self._break_after(raw, end)
                parts.append(self.plain(raw[left:right]))
                done = right
            else:
                parts.append(ids[skip:])
                done = start + keep
            start = end
        return np.concatenate(parts)

    def encode(self, raw: bytes) -> np.ndarray:
        """Ids of a whole text; special strings inside it are their one id."""
        for s, i in self.special.items():
            if s.encode() in raw:
                pieces = [self.encode(p) for p in raw.split(s.encode())]
                own = np.array([i], dtype=np.uint32)
                return np.concatenate([x for p in pieces for x in (own, p)][1:])
        return self.ordinary(raw) if raw else np.zeros(0, dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, special ones included; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkedBPE:
    return ChunkedBPE(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int), decoded: the ids of every whole text and their decoding.

    NULL counts as the empty text: no ids, an empty decoding.  Each row is handled
    by itself, so repeated rows and ids give repeated results; an empty table none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for part, texts in slices(batches, "text", TEXT_SLICE):
            ids = [bpe.encode(t) for t in texts]
            decoded = [bpe.decode(x) for x in ids]
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"]
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ``encode_documents``, with the
    digests taken in the task, so that no id list leaves it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for part, texts in slices(batches, "text", TEXT_SLICE):
            counts, of_ids, of_text = [], [], []
            for t in texts:
                ids = bpe.encode(t)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
