"""Helpers shared by the operators: reading batches, words, hashes, tables."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewave.session import materialize

__all__ = ["materialize"]

#: A word is a longest run without space, tab, LF, VT, FF, CR; ``bytes.split()``
#: splits UTF-8 text at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

#: Text handled at once inside a task, in bytes; one longer text goes alone.
SLICE_BYTES = 4 << 20

U64 = np.uint64
MIX_A, MIX_B, MIX_C = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text column (NULL counts as empty)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a document row: rows are one only if id and text agree."""
    return F.concat_ws(
        ":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(F.hex(F.xxhash64(text)), F.lit("-"))
    )


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """(record batch slice, its texts as bytes; NULL as b"") of about ``limit`` bytes each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
        ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = before = 0
        while lo < len(ends):  # only the texts of one slice become Python objects
            hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = batch.slice(lo, hi - lo)
            yield part, [b or b"" for b in col.slice(lo, hi - lo).cast(kind).to_pylist()]
            lo, before = hi, int(ends[hi - 1])
    pa.default_memory_pool().release_unused()  # the worker may stay


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix finaliser)."""
    x = x + MIX_A  # a copy; the rest in place
    x ^= x >> U64(30)
    x *= MIX_B
    x ^= x >> U64(27)
    x *= MIX_C
    x ^= x >> U64(31)
    return x


_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
#: Words up to so many bytes are hashed by table; a value for each place in a word and byte.
_WIDTH = 64
_VALUES = mix64(np.arange(_WIDTH * 256, dtype=U64))
_PIECE = 1 << 18


def hash_words(texts: list[bytes]) -> list[np.ndarray]:
    """The 64-bit hash of every word of each text, in order; words as ``bytes.split()`` gives them.

    Tabulation: a word's hash is the sum of one scrambled value for each (place, byte), scrambled
    together with its length, so that unlike words clash by chance only, whatever their pattern.
    The sums are differences of running sums: no Python object is made for a word, but for those
    longer than the table, which go to xxHash."""
    raw = b"\n".join(texts)
    b = np.frombuffer(raw, dtype=np.uint8)
    edge = np.diff(_GAP[b].view(np.int8), prepend=np.int8(1), append=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    out = np.zeros(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + _PIECE, side="right")))
        if ends[i] - lo <= _PIECE:
            part, at = b[lo : ends[j - 1]], starts[i:j] - lo
            cell = np.arange(len(part), dtype=np.int32)
            cell -= np.repeat(at.astype(np.int32), np.diff(np.append(at, len(part))))
            np.minimum(cell, _WIDTH - 1, out=cell)  # further on are blanks, and words hashed below
            cell <<= 8
            cell |= part
            sums = np.zeros(len(part) + 1, dtype=U64)
            np.cumsum(_VALUES[cell], dtype=U64, out=sums[1:])
            out[i:j] = sums[ends[i:j] - lo] - sums[at]
        i = j
    for k in np.flatnonzero(ends - starts > _WIDTH):
        out[k] = xxhash.xxh64_intdigest(raw[starts[k] : ends[k]])
    out = mix64(out ^ mix64((ends - starts).astype(U64)))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.split(out, np.searchsorted(starts, begins[1:-1])) if texts else []


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` consecutive word hashes."""
    m = len(words) - n + 1
    out = np.zeros(max(m, 0), dtype=U64)
    for k in range(n):
        out = mix64(out * MIX_C + words[k : k + m]) if m > 0 else out
    return out


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than ``n`` words are one shingle, none give none."""
    if not len(words):
        return np.zeros(0, dtype=U64)
    return np.unique(grams(words, min(n, len(words))) + U64(0 if len(words) >= n else len(words)))


def crc_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL ids count as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself,
    the other bytes, in order, for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_byte_bpe(path: str) -> tuple[list[bytes], dict[str, int], dict[int, tuple[int, int]]]:
    """(token bytes by id, special strings, merged id -> its two parts) of a byte-level BPE file.

    The merges must be in the order of the ids, so that a token's id is its rank.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, chars = spec["model"]["vocab"], byte_alphabet()
    tokens = [b""] * len(vocab)
    for s, i in vocab.items():
        if i < len(tokens):
            tokens[i] = bytes(map(chars.__getitem__, s))
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ranks = [vocab[a + b] for a, b in pairs]
    if ranks != sorted(ranks):
        raise ValueError(f"{path}: merges are not in the order of their ids")
    parts = {r: (vocab[a], vocab[b]) for r, (a, b) in zip(ranks, pairs, strict=True)}
    return tokens, {t["content"]: t["id"] for t in spec.get("added_tokens", ()) if t.get("special")}, parts
