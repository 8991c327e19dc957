"""Document fingerprints: bottom-k sketches of word shingle hashes.

The sketch of a text holds the k smallest of its distinct shingle hashes.  The
sketch of several parts is the k smallest of their sketches, so sketches merge in
any order.  From two sketches follow the resemblance (share of common shingles in
the k smallest of the union) and the containment; from one the number of distinct
shingles ((k - 1) / the k-th smallest hash, as a part of the hash range).  Texts
with at most k distinct shingles are held whole, and the answers are exact.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewave.llm.common import LOWER, U64, column, hash_words, shingle_set, slices

#: Hashes of a sketch, and the bits kept of each.
K = 128
BITS = 48
SHINGLE = 5
LEAST_LONG = -(2**63)


def sketches(texts: list[bytes], k: int = K) -> list[np.ndarray]:
    """Ascending sketches of texts: words split at white space, A-Z lower-cased."""
    words = hash_words([t.translate(LOWER) for t in texts])
    return [np.unique(shingle_set(w, SHINGLE) >> U64(64 - BITS))[:k] for w in words]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated shared part of the union; two empty sketches are alike (1.0)."""
    if not len(a) and not len(b):
        return 1.0
    union = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) + 1) * 2.0**BITS


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated part of a's shingles that b has; 1.0 for an empty a."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    return min(1.0, r * distinct(merge(a, b, k), k) / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    """The sketch as text: base64 of its hashes in ascending order, six bytes each."""
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(s), dtype=np.uint8).reshape(-1, BITS // 8)
    return np.pad(raw, ((0, 0), (2, 0))).copy().view(">u8").ravel().astype(U64)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """doc_id, fingerprint, n_shingles (estimate) of every row; NULL counts as empty
    (fingerprint "", 0 shingles).  An empty table gives no rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            found = sketches(texts, k)
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "doc_id"),
                    pa.array([to_text(s) for s in found], pa.string()),
                    pa.array([distinct(s, k) for s in found], pa.float64()),
                ],
                names=["doc_id", "fingerprint", "n_shingles"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fingerprint string, n_shingles double")


def group_sketches(docs: DataFrame, group_col: str, text_col: str = "text", k: int = K) -> DataFrame:
    """group, hashes (array of long), n_shingles: one merged sketch per group.

    A task merges what it reads, so at most k hashes a group and task are shuffled.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}

        def flush() -> pa.RecordBatch:
            cols = [pa.array(list(held), pa.string()), pa.array([v.astype(np.int64).tolist() for v in held.values()], pa.list_(pa.int64()))]
            held.clear()
            return pa.RecordBatch.from_arrays(cols, names=["group", "hashes"])

        for part, texts in slices(batches, "text"):
            for g, own in zip(column(part, "group").to_pylist(), sketches(texts, k), strict=True):
                held[g] = merge(held[g], own, k) if g in held else own
            if len(held) > 20_000:
                yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col(group_col).cast("string").alias("group"), F.col(text_col).alias("text"))
    parts = rows.mapInArrow(run, "group string, hashes array<long>").select("group", F.explode("hashes").alias("hash")).distinct()
    # the k smallest of each group: hashes are bucketed so that no task sees a group whole
    parts = parts.withColumn("bucket", F.pmod(F.xxhash64("hash"), F.lit(64)))
    merged = (
        parts.groupBy("group", "bucket")
        .agg(F.slice(F.array_sort(F.collect_list("hash")), 1, k).alias("hashes"))
        .groupBy("group")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("hashes"))), 1, k).alias("hashes"))
    )
    estimate = F.when(F.size("hashes") < k, F.size("hashes").cast("double")).otherwise(
        (k - 1) / (F.element_at("hashes", k) + 1) * F.lit(2.0**BITS)
    )
    groups = rows.select("group").distinct()
    merged = groups.join(merged, groups["group"].eqNullSafe(merged["group"]), "left").select(groups["group"], "hashes")
    return merged.select("group", F.coalesce("hashes", F.array().cast("array<long>")).alias("hashes")).withColumn("n_shingles", estimate)


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of the text, replaced by as much of the start of the next."""
    m = len(text) // 2
    return text[: len(text) - m] + following[:m]


def _bounds(rows: DataFrame, parts: int) -> list[int]:
    """Largest id of each range of a division of the ids into at most ``parts`` ranges, descending."""
    ranges = rows.select("k").repartitionByRange(parts, F.desc("k"))
    found = ranges.groupBy(F.spark_partition_id().alias("p")).agg(F.max("k").alias("hi")).collect()  # one row a range
    return sorted({r.hi for r in found}, reverse=True)


def compare_neighbours(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, partitions: int | None = None
) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document has the next smaller id; that of the last is the first.  Rows of
    one id follow each other by text (NULL first), rows without an id come last.  NULL
    texts count as empty.  A single row is its own next.  An empty table gives no rows.

    The ids alone are divided into as many ranges as the session has shuffle partitions;
    the texts are shuffled once, to their range, and the first rows of each range also
    to the range before, whose last row needs them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "k", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_LONG))
    )
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = _bounds(rows, parts)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        highs = -np.array(firsts, dtype=object) if LEAST_LONG in firsts else -np.array(firsts, dtype=np.int64)
        edge_of = {first: (i - 1) % len(firsts) for i, first in enumerate(firsts)}
        for batch in batches:
            keys = column(batch, "k").to_numpy()
            own = np.searchsorted(highs, -keys if highs.dtype != object else -keys.astype(object), side="right") - 1
            edges = np.flatnonzero(np.isin(keys, np.array(firsts, dtype=np.int64)))
            take = np.concatenate([np.arange(len(keys)), edges])
            target = np.concatenate([own, [edge_of[int(x)] for x in keys[edges]]]).astype(np.int32)
            edge = np.concatenate([np.zeros(len(keys), bool), np.ones(len(edges), bool)])
            out = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(target), pa.array(edge)], names=[*out.schema.names, "part", "edge"]
            )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose next one has not come yet
        closed = None  # the range whose last row has met the next range's first
        for batch, texts in slices(batches, "text"):
            pairs: list[tuple] = []  # rows with their next ones
            cols = [column(batch, c).to_pylist() for c in ("part", "edge", "doc_id")]
            for part, edge, doc_id, raw, mark in zip(*cols, texts, sketches(texts, k), strict=True):
                if edge and part == closed:
                    continue
                now = (part, doc_id, raw.decode(), mark)
                if held is not None and held[0] == part:
                    pairs.append((held, now))
                held, closed = (None, part) if edge else (now, closed)
            new = [edited(own[2], following[2]).encode() for own, following in pairs]
            out = [
                (
                    own_id,
                    len(own),
                    hashlib.sha256(raw).hexdigest(),
                    to_text(mark),
                    to_text(new_mark),
                    resemblance(mark, new_mark, k),
                    resemblance(mark, following[3], k),
                )
                for ((_, own_id, own, mark), following), raw, new_mark in zip(pairs, new, sketches(new, k), strict=True)
            ]
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, out_types, strict=True)], names=names
            )

    out_types = [
        pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string(),
        pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(),
    ]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    dealt = rows.mapInArrow(assign, f"doc_id {kind}, text string, k long, part int, edge boolean")
    placed = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "edge", F.desc("k"), "text")
    return placed.mapInArrow(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
