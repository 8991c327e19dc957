"""Seeded sampling and splitting that are stable under re-partitioning.

``rand(seed)`` depends on partition layout, so a recomputed or re-read input
can sample differently.  Here a row's fate depends on a 64-bit hash of its
own key columns and the seed only, so every recomputation (after a lost
executor, or in another job) agrees, and no input has to be cached.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TWO53 = float(1 << 53)


def row_hash(key_cols: Sequence[str], seed: int) -> Column:
    return F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed))


def unit_hash(key_cols: Sequence[str], seed: int) -> Column:
    """A uniform value in [0, 1) from the row's key columns and the seed."""
    return row_hash(key_cols, seed).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(_TWO53)


# Fixed values of the portable hash: a prime modulus and LCG multipliers,
# all below 2^31 so every product fits in a signed 64-bit integer.  They serve the
# key columns in turn, for any number of columns.
MOD_PRIME = 2147483647
MOD_MULTIPLIERS = (1103515245, 22695477, 134775813, 1664525, 69069)


def modular_unit_hash(key_cols: Sequence[str], seed: int) -> Column:
    """A value in [0, 1) from integer key columns, using only 64-bit integer
    ``%``, ``*`` and ``+`` (so any SQL engine reproduces it exactly).

    ``xxhash64`` (:func:`unit_hash`) mixes better and is the default; this
    one is for samples and splits that another engine must re-derive.
    """
    p = F.lit(MOD_PRIME)
    acc = F.lit(seed % MOD_PRIME).cast("long")
    for i, c in enumerate(key_cols):
        a = MOD_MULTIPLIERS[i % len(MOD_MULTIPLIERS)] + i // len(MOD_MULTIPLIERS)
        acc = (acc + (F.pmod(F.col(c).cast("long"), p) * F.lit(a)) % p) % p
    return acc / p


#: Columns that name a row after :func:`numbered_copies`: its content, and its number among equal rows.
SPLIT_KEYS = ["_content", "_copy"]
#: Equal rows that one task writes out.
COPIES_AT_ONCE = 100_000


def numbered_copies(df: DataFrame) -> DataFrame:
    """``df`` with ``_content`` (a hash of the row) and ``_copy`` (1, 2, ... among equal rows).

    Both depend on what the table holds, not on how it is laid out, so a split on
    them is the same after a repartition or a rewrite, and still divides a large
    group of equal rows in proportion.  Equal rows are counted (partly before the
    shuffle) and written out again from their number, in runs that several tasks
    share, so no task gathers a group.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_times"))
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / COPIES_AT_ONCE))
    run = counted.withColumn("_run", F.explode(runs))
    first = F.col("_run") * COPIES_AT_ONCE + 1
    last = F.least(first + COPIES_AT_ONCE - 1, F.col("_times"))
    spread = run.repartition("_run", *cols)
    return spread.withColumn("_copy", F.explode(F.sequence(first, last))).select(
        *cols, F.xxhash64(*cols).alias("_content"), "_copy"
    )


# Hash histogram resolution: buckets at 2^(-b/4), so a threshold is never
# more than 2^(1/4) (19%) wider than needed.
_STEPS_PER_HALVING = 4
_MAX_BUCKET = 54 * _STEPS_PER_HALVING


def _bucket(u: Column) -> Column:
    """``floor(-4 log2 u)``: bucket ``b`` holds ``2^-(b+1)/4 < u <= 2^-b/4``.
    ``u = 0`` goes to the deepest bucket; a NULL ``u`` (a NULL key under a
    custom ``unit``) to bucket 0, so such rows come last."""
    b = F.least(F.floor(-F.log2(u) * F.lit(_STEPS_PER_HALVING)), F.lit(_MAX_BUCKET))
    return (
        F.when(u.isNull(), F.lit(0)).when(u <= F.lit(0.0), F.lit(_MAX_BUCKET)).otherwise(b).cast("int")
    )


def sample_n(
    df: DataFrame,
    n: int,
    seed: int,
    key_cols: Sequence[str] | None = None,
    unit: Column | None = None,
    cut_rows: int = 50_000,
) -> DataFrame:
    """Exactly ``min(n, count)`` rows: the ``n`` with the smallest key hash.

    A histogram of the hash (a few hundred buckets, partially aggregated) finds
    the bucket that holds the n-th row; it is refined inside that bucket until the
    bucket has at most ``cut_rows`` rows, or one hash.  Rows below the bucket are
    taken by a plain filter, whatever ``n`` is; only the bucket's own rows are
    ordered, by the hash and then by all keys, for the rest.
    """
    keys = list(key_cols or df.columns)
    u = F.coalesce(unit_hash(keys, seed) if unit is None else unit, F.lit(1.0))  # a NULL sorts last
    low, high, need = 0.0, math.inf, n
    bucket, steps = F.lit(_MAX_BUCKET) - _bucket(u), None
    while True:
        inside = df.where((u >= F.lit(low)) & (u < F.lit(high)))
        hist = (
            inside.groupBy(bucket.alias("b"))
            .agg(F.count(F.lit(1)).alias("c"), F.min(u).alias("lo"), F.max(u).alias("hi"))
            .collect()
        )
        at = None
        for r in sorted(hist, key=lambda r: r["b"]):
            if r["c"] > need:
                at = r
                break
            need -= r["c"]
        if at is None:  # all rows of the range are wanted
            low = high
            break
        low, high = at["lo"], math.nextafter(at["hi"], math.inf)
        if at["c"] <= cut_rows or at["lo"] == at["hi"]:
            break
        steps = (high - low) / 256
        bucket = F.least(F.floor((u - F.lit(low)) / F.lit(steps)), F.lit(255))
    taken = df.where(u < F.lit(low))
    last = df.where((u >= F.lit(low)) & (u < F.lit(high)))
    return taken.unionByName(last.orderBy(u.asc(), *[F.col(c) for c in keys]).limit(max(need, 0)))


def split_part(weights: Sequence[float], u: Column) -> Column:
    """The number of the part, of sizes in proportion to ``weights``, that ``u`` falls into.

    A NULL ``u`` (possible only with a custom unit) falls into the first part."""
    total, bound, part = float(sum(weights)), 0.0, F.lit(len(weights) - 1)
    cuts = []
    for w in weights[:-1]:
        bound += w / total
        cuts.append(bound)
    for i in reversed(range(len(cuts))):
        part = F.when(F.coalesce(u, F.lit(0.0)) < F.lit(cuts[i]), F.lit(i)).otherwise(part)
    return part


def hash_split(
    df: DataFrame,
    weights: Sequence[float],
    seed: int,
    key_cols: Sequence[str] | None = None,
    unit: Column | None = None,
) -> list[DataFrame]:
    """Split by a per-row hash into parts proportional to ``weights``.

    The parts are disjoint and cover the input exactly, whatever the
    partitioning, and recomputing any part gives the same rows.
    """
    keys = list(key_cols or df.columns)
    part = split_part(weights, unit_hash(keys, seed) if unit is None else unit)
    return [df.where(part == i) for i in range(len(weights))]


def random_split(
    df: DataFrame, weights: Sequence[float], seed: int, persist: bool = True
) -> list[DataFrame]:
    """``randomSplit`` over a persisted input (so every part sees one draw)."""
    src = df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df
    return src.randomSplit(list(weights), seed)
