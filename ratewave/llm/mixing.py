"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order that depends only
on a seed and each document's id, text and number among equal rows.  A document's virtual finish time is the number
of its source's words up to and including it, over the source's target; the
second pass over a source continues where the first ended.  Reading all queues
by virtual finish time and stopping at the total budget gives every source its
target, up to one document.

Only DataFrame operations.  The running sums are taken in blocks (a source's
queue is cut into blocks by its shuffle key, in proportion to its size, so a
source with a third of all rows is many blocks); the cut at the total budget is
found by refining a histogram of finish times until the bucket that holds the
cut is small, and only that bucket is sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewave.llm.common import materialize, word_count
from ratewave.operators.sampling import numbered_copies

#: Weights by the rank of the source, repeating.
WEIGHTS = (5, 2, 1)
BUDGET_RATIO = 1.5
MAX_REPEATS = 2
SEED = "mix-42"
#: Documents of one block of a queue, buckets of a histogram, rows that one task sorts at the cut.
BLOCK_DOCS = 2_000
BUCKETS = 4096
CUT_ROWS = 20_000


def source_key(source: Column) -> Column:
    """Text that sorts as the source by code point, NULL last."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("z"))


def row_name(doc_id: Column, text: Column, seed: str) -> Column:
    """A digest of id and text: rows of one name and source are copies, taken in any order."""
    digest = F.coalesce(F.md5(text.cast("binary")), F.lit("-"))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), digest).cast("binary"))


def queue_key(name: Column, copy: Column) -> Column:
    """The shuffled order of a queue: a digest of the row's name and its number among copies (from 1)."""
    return F.md5(F.concat(name, F.lit(":"), copy.cast("string")).cast("binary"))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], budget_ratio: float, max_repeats: int
) -> DataFrame:
    """skey, source_size, n_docs, target of each source, from rows (skey, size).

    Water filling: a target is the source's weight times a common level, at most
    ``max_repeats`` times its size; the level makes the targets sum to the budget.
    One row per source.  With the sources in the order in which they reach their
    ceilings, the level is the largest of (budget - ceilings before) / weights left.
    """
    per = sizes.groupBy("skey").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("n_docs"),
    )
    rank = F.row_number().over(Window.orderBy("skey")) - 1
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights)) + 1))
    per = per.withColumn("ceiling", F.col("source_size") * max_repeats)
    fill = Window.orderBy(F.col("ceiling") / F.col("weight"), "skey")
    everything = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(everything) * F.lit(float(budget_ratio))
        - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    per = per.withColumn("level", level)
    target = F.least(F.col("ceiling").cast("double"), F.max("level").over(everything) * F.col("weight"))
    return per.select("skey", "source_size", "n_docs", target.alias("target"))


def _queues(slim: DataFrame, per: DataFrame) -> DataFrame:
    """Rows (skey, key, size, upto): ``upto`` is the source's words up to and including the row."""
    blocks = F.ceil(F.col("n_docs") / BLOCK_DOCS)
    part = F.conv(F.substring("key", 1, 7), 16, 10).cast("long")
    rows = slim.where("size > 0").join(per.select("skey", "n_docs"), "skey")
    rows = rows.select("skey", "key", "size", F.floor(part * blocks / F.lit(16**7)).alias("block"))
    totals = rows.groupBy("skey", "block").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("skey").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("skey", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("skey", "block").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("inside", F.sum("size").over(inside)).join(starts, ["skey", "block"])
    return rows.select("skey", "key", "size", (F.col("start") + F.col("inside")).alias("upto"))


def _cuts(queue: DataFrame, budget: float) -> DataFrame:
    """skey, pass, cut: the last key of each source and pass before the total budget."""
    low, high, left = 0.0, None, budget
    top = queue.agg(F.max("finish").alias("m")).first().m
    if top is None:
        return queue.select("skey", "pass", F.col("key").alias("cut")).limit(0)
    high = math.nextafter(top, math.inf)
    while True:
        width = (high - low) / BUCKETS
        inside = queue.where((F.col("finish") >= low) & (F.col("finish") < high))
        bucket = F.least(F.floor((F.col("finish") - low) / F.lit(width)), F.lit(BUCKETS - 1))
        sums = sorted(
            inside.groupBy(bucket.alias("b"))
            .agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.min("finish").alias("lo"), F.max("finish").alias("hi"))
            .collect()  # at most BUCKETS rows
        )
        at = None
        for r in sums:
            if r.s > left:
                at = r
                break
            left -= r.s
        if at is None:  # the budget covers everything
            low = high
            break
        low, high = at.lo, math.nextafter(at.hi, math.inf)
        if at.n <= CUT_ROWS or at.lo == at.hi:
            break
    whole = queue.where(F.col("finish") < low)
    last = queue.where((F.col("finish") >= low) & (F.col("finish") < high))
    running = F.sum("size").over(Window.orderBy("finish", "key", "pass").rowsBetween(Window.unboundedPreceding, 0))
    last = last.withColumn("running", running).where(F.col("running") <= left).drop("running")
    return whole.unionByName(last).groupBy("skey", "pass").agg(F.max("key").alias("cut"))


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    budget_ratio: float = BUDGET_RATIO,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan): a row (doc_id, skey, name, key, size) per document, and a row
    (skey, source_size, target, cuts) per source; ``cuts`` has the last key taken
    in each pass over the source (NULL where a pass takes nothing)."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        source_key(F.col(source_col)).alias("skey"),
        row_name(F.col(id_col), F.col(text_col), seed).alias("name"),
        word_count(F.col(text_col)).alias("size"),
    )
    key = queue_key(F.col("name"), F.col("_copy")).alias("key")
    slim = materialize(numbered_copies(rows).select("doc_id", "skey", "name", key, "size"), "mix_sizes")
    per = materialize(source_targets(slim, weights, budget_ratio, max_repeats), "mix_sources")
    rows = materialize(_queues(slim, per), "mix_queues").join(per, "skey")
    passes = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))
    queue = rows.withColumn("pass", passes).select(
        "skey",
        "pass",
        "key",
        "size",
        ((F.col("pass") * F.col("source_size") + F.col("upto")) / F.col("target")).alias("finish"),
    )
    total = per.agg(F.sum("source_size").alias("t")).first().t or 0
    cuts = _cuts(queue, total * float(budget_ratio)).groupBy("skey").agg(
        *[F.max(F.when(F.col("pass") == p, F.col("cut"))).alias(f"cut{p}") for p in range(max_repeats)]
    )
    plan = per.join(cuts, "skey", "left").select(
        "skey", "source_size", "target", F.array(*[f"cut{p}" for p in range(max_repeats)]).alias("cuts")
    )
    return slim, materialize(plan, "mix_plan")


def _times(key: Column, cuts: Column) -> Column:
    return F.coalesce(F.size(F.filter(cuts, lambda c: c.isNotNull() & (key <= c))), F.lit(0))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs``.

    ``taken`` is the number of words the mix takes from the row, repeats counted.
    A NULL or empty text has size 0 and takes nothing; a source without words has
    target 0; NULL is a source of its own (the last).  Repeated rows and ids, and rows
    without an id, are queued each for itself.  An empty table gives no rows.
    """
    slim, plan = plan_mix(docs, **options)
    rows = slim.join(plan, "skey")
    return rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * _times(F.col("key"), F.col("cuts"))).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **options
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it.

    Rows without words cost nothing, so they are in no queue and in no mix.  Which of several
    rows of one source, id and text is taken may depend on their layout where they differ in
    other columns.
    """
    slim, plan = plan_mix(docs, id_col, text_col, source_col, seed=seed, **options)
    plan = plan.select(F.struct("skey", "cuts").alias("_mix_plan"))
    has_words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.where(has_words).join(plan, source_key(F.col(source_col)) == F.col("_mix_plan.skey"))
    rows = rows.withColumn("_mix_name", row_name(F.col(id_col), F.col(text_col), seed))
    copies = slim.where("size > 0").groupBy("skey", "name").agg(F.count("*").alias("n")).where("n > 1")
    copies = materialize(copies.select(F.struct("skey", "name").alias("_mix_many")), "mix_copies")
    one = F.lit(1)
    if not copies.isEmpty():
        of_many = (F.col("_mix_plan.skey") == F.col("_mix_many.skey")) & (F.col("_mix_name") == F.col("_mix_many.name"))
        many = rows.join(copies, of_many, "left_semi")
        rows = rows.join(copies, of_many, "left_anti").withColumn("_mix_number", one).unionByName(_numbered(many))
        one = F.col("_mix_number")
    times = _times(queue_key(F.col("_mix_name"), one), F.col("_mix_plan.cuts"))
    rows = rows.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), times)))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with _mix_number: 1, 2, ... among those of one source and name.

    Counted in each of the written table's partitions, then offset, so that no task numbers a
    group as a whole."""
    rows = materialize(rows.withColumn("_mix_row", F.monotonically_increasing_id()), "mix_repeated")
    rows = rows.withColumn("_mix_part", F.shiftright("_mix_row", 33))
    group = [F.col("_mix_plan.skey"), F.col("_mix_name")]
    inside = F.row_number().over(Window.partitionBy(*group, "_mix_part").orderBy("_mix_row"))
    counts = rows.groupBy(group[0].alias("s"), group[1].alias("m"), F.col("_mix_part").alias("p")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("s", "m").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.struct("s", "m", "p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).alias("_mix_start"))
    at = (group[0] == F.col("_mix_start.s")) & (group[1] == F.col("_mix_start.m")) & (F.col("_mix_part") == F.col("_mix_start.p"))
    rows = rows.withColumn("_mix_inside", inside).join(starts, at)
    rows = rows.withColumn("_mix_number", F.col("_mix_start.start") + F.col("_mix_inside"))
    return rows.drop("_mix_row", "_mix_part", "_mix_inside", "_mix_start")
