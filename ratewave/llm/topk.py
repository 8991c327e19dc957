"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of (dimension, weight) terms.  For a block of
candidates the postings of a dimension are its weights by candidate; each term
of a query adds its weight times these postings to a dense array of scores.
The k best of a block come from a partition of that array, and the blocks'
answers are merged.  The stated queries meet every block of candidates once:
blocks hold a bounded number of rows, and a pair of blocks is one task's group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest blocks, in rows; smaller tables are cut into up to SPREAD blocks of at least LEAST rows.
BLOCK_ROWS = 65_536
QUERY_ROWS = 4_096
SPREAD, LEAST = 64, 1_024


def _dense(tab: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, a matrix of integer weights (a missing component is 0), and row lengths."""
    tab = tab.combine_chunks()
    ids = tab.column("vec_id").to_numpy()
    lists = tab.column("weights").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
    lens = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    out = np.zeros((len(ids), int(lens.max(initial=0))), dtype=np.int64)
    row = np.repeat(np.arange(len(ids)), lens)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    out[row, col] = flat
    return ids, out, lens


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id; ``ids`` ascend."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > floor)
        at = np.concatenate([above, np.flatnonzero(scores == floor)[: k - len(above)]])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))]


def _score_block(k: int):
    def run(cands: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if cands.num_rows and queries.num_rows:
            ids, weights, _ = _dense(cands)
            order = np.argsort(ids, kind="stable")
            ids, postings = ids[order], np.ascontiguousarray(weights[order].T)
            q_ids, q_weights, _ = _dense(queries)
            most = [np.abs(x.astype(np.float64)).max(initial=0) for x in (postings, q_weights)]
            if most[0] * most[1] * max(q_weights.shape[1], 1) >= 2.0**63:
                raise OverflowError("scores may be beyond 64 bits")
            for q, row in zip(q_ids, q_weights, strict=True):
                scores = np.zeros(len(ids), dtype=np.int64)
                for term in np.flatnonzero(row[: len(postings)]):
                    scores += row[term] * postings[term]
                own = slice(*np.searchsorted(ids, [q, q + 1]))
                keep = np.ones(len(ids), dtype=bool)
                keep[own] = False
                at = np.flatnonzero(keep) if own.start != own.stop else np.arange(len(ids))
                best = at[_best(scores[at], ids[at], k)]
                out[0].append(np.full(len(best), q))
                out[1].append(ids[best])
                out[2].append(scores[best])
        cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table([pa.array(c.astype(np.int64)) for c in cols], names=["query_id", "vec_id", "score"])

    return run


def _whole(x: Column) -> Column:
    fits = F.abs(x) < F.lit(2.0**63)
    return F.when(fits, F.floor(x).cast("long")).otherwise(F.raise_error(F.lit("a component beyond 64 bits")).cast("long"))


def quantized(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id, weights: floor(scale * component) of every usable vector."""
    finite = F.forall(
        F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
        .select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.transform(F.col(vec_col), lambda x: _whole(x.cast("double") * scale)).alias("weights"),
        )
    )


def exact_topk(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 10,
    scale: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query.

    ``is_query`` is a condition on ``vec_id``.  Vectors that are NULL or hold a
    NULL or non-finite component, and rows without an id, take no part.  A shorter
    vector has weight 0 in its missing dimensions; the empty vector scores 0.  Rows
    with the query's own id are not its candidates; other repeated rows are all
    candidates, and a query row given twice is answered once.  Ties go to the smaller
    id.  An empty table gives no rows.  Scores are 64-bit integers; vectors whose scores might be
    beyond that raise an error.
    """
    rows = quantized(vectors, id_col, vec_col, scale)
    queries = rows.where(is_query).distinct()
    n, nq = rows.count(), queries.count()
    blocks = max(math.ceil(n / BLOCK_ROWS), min(SPREAD, math.ceil(n / LEAST)), 1)
    q_blocks = max(math.ceil(nq / QUERY_ROWS), 1)
    cands = rows.select(
        F.expr(f"pmod(xxhash64(vec_id, weights), {blocks}L)").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block"),
        "vec_id",
        "weights",
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.expr(f"cast(pmod(xxhash64(vec_id, 7), {q_blocks}) as int)").alias("q_block"),
        "vec_id",
        "weights",
    )
    found = (
        cands.groupBy("block", "q_block")
        .cogroup(asked.groupBy("block", "q_block"))
        .applyInArrow(_score_block(k), "query_id long, vec_id long, score long")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
