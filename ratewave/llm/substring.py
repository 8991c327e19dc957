"""Substring dedup: removes words covered by a window of words that occurs elsewhere too.

Every word of the corpus begins a suffix, and a repeat of WINDOW words is an internal
node at that depth, or below, of the tree of all suffixes with two leaves or more.  The
tree is never built whole: it is split by prefixes into groups that fit a task.

* Anchors.  Of the WINDOW - GRAM + 1 word groups of GRAM words in a window, the one with
  the smallest hash (the leftmost of equals) is its anchor: equal windows have equal
  anchors at equal offsets, and a document has few anchors.  Anchors are counted over the
  corpus; a window whose anchor occurs once can't be repeated.  The suffixes that are left
  are those of windows with a shared anchor.
* Groups.  Suffixes are partitioned by their anchor's words.  A group that fits into
  memory becomes a subtree: its leaves, sorted by offset and window content, are the
  suffixes, and a run of equal ones is an internal node of full depth.  A group beyond
  HEAVY occurrences is split by a longer prefix, the whole window: such nodes are only
  counted (occurrences with the same windows first, partly before they move, so thousands
  of copies travel as one row) and joined back, so no task holds the group.
* Runs of repeated windows of a document unite to its maximal repeated spans.

A window stands as a 64-bit hash of its words beside its anchor's own 64-bit hash and
offset; the texts move only to the few operators that need them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewave.llm.common import MIX_C, U64, column, hash_words, mix64, slices

WINDOW = 35
GRAM = 5
#: Occurrences of an anchor beyond which its group is split by whole windows; so many take
#: about 3 MB, with the hashes of their windows.
HEAVY = 20_000
#: Suffixes that a task sorts at once.
SUBTREE_LEAVES = 1_000_000
#: Bits for a word's place in its document while anchors are chosen; a text of Arrow's 2 GB
#: has fewer words.  The hash keeps the others: a clash there only moves the anchor.
PLACE_BITS = 31
TEXT_SLICE = 2 << 20


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * MIX_C + b)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words, put together from runs of powers of two."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U64)
    out, at, size, power = None, 0, 1, words
    while True:
        if n & size:
            part = power[at : at + m]
            out = part.copy() if out is None else _pair(out, part)
            at += size
        if size * 2 > n:
            return out
        power = _pair(power[: len(power) - size], power[size:])
        size *= 2


def anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, their hashes, first window, number of windows) of a document's anchors, in order."""
    m = len(words) - window + 1
    if m <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(U64), none, none
    grams = run_hashes(words, gram)
    best = grams >> U64(PLACE_BITS)
    best <<= U64(PLACE_BITS)
    best |= np.arange(len(grams), dtype=U64)
    width, have = window - gram + 1, 1
    while have * 2 <= width:
        best = np.minimum(best[: len(best) - have], best[have:])
        have *= 2
    best = np.minimum(best[:m], best[width - have : width - have + m])
    place = (best & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[first], grams[place[first]], first, np.diff(np.append(first, m))


def _anchor_rows(window: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text", TEXT_SLICE):
            marks, places, counts = [], [], []
            for words in hash_words(texts):
                at, mark, _, _ = anchors(words, window, gram)
                marks.append(mark)
                places.append(at)
                counts.append(len(at))
            row = pa.array(np.repeat(np.arange(len(texts)), counts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(marks).astype(np.int64)),
                    column(part, "doc_id").take(row),
                    column(part, "tie").take(row),
                    pa.array(np.concatenate(places).astype(np.int32)),
                ],
                names=["anchor", "doc_id", "tie", "place"],
            )

    return run


def _window_rows(window: int, gram: int):
    """The windows of the anchors at the listed ``places`` of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text", TEXT_SLICE):
            cols: list[list[np.ndarray]] = [[] for _ in range(4)]
            rows, lens = [], []
            for r, (words, places) in enumerate(zip(hash_words(texts), column(part, "places").to_pylist(), strict=True)):
                at, mark, first, number = anchors(words, window, gram)
                keep = np.flatnonzero(np.isin(at, places))
                if not len(keep):
                    continue
                content = run_hashes(words, window)
                rows.append(np.full(len(keep), r))
                cols[0].append(mark[keep])
                cols[1].append(first[keep])
                cols[2].append(at[keep] - first[keep])  # offset of the anchor in the first window
                which = np.repeat(first[keep], number[keep])
                inside = np.arange(len(which)) - np.repeat(np.cumsum(number[keep]) - number[keep], number[keep])
                cols[3].append(content[which + inside])
                lens.append(number[keep])
            if not rows:
                continue
            row = pa.array(np.concatenate(rows))
            anchor, first, offset, content = (np.concatenate(c) for c in cols)
            ends = np.concatenate([[0], np.cumsum(np.concatenate(lens))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.astype(np.int64)),
                    column(part, "doc_id").take(row),
                    column(part, "tie").take(row),
                    pa.array(first.astype(np.int32)),
                    pa.array(offset.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(content.astype(np.int64))),
                ],
                names=["anchor", "doc_id", "tie", "first", "offset", "windows"],
            )

    return run


WINDOW_ROW = "anchor long, doc_id long, tie int, first int, offset int, windows array<long>"
SPAN = "doc_id long, tie int, lo int, hi int"


def _subtrees(window: int):
    """Rows sorted by anchor -> spans of repeated windows, from subtrees of whole groups."""

    def spans(held: pa.Table) -> pa.RecordBatch:
        held = held.combine_chunks()
        lists = held.column("windows").chunk(0)
        lens = np.diff(lists.offsets.to_numpy())
        leaf = np.repeat(np.arange(len(lens)), lens)
        inside = np.arange(len(leaf)) - np.repeat(np.cumsum(lens) - lens, lens)
        anchor, first, offset = (held.column(c).to_numpy() for c in ("anchor", "first", "offset"))
        content = lists.flatten().to_numpy()
        depth = offset[leaf] - inside  # of the anchor in this window
        order = np.lexsort((content, depth, anchor[leaf]))
        a, d, c = anchor[leaf][order], depth[order], content[order]
        same = (a[1:] == a[:-1]) & (d[1:] == d[:-1]) & (c[1:] == c[:-1])
        node = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        repeated = np.zeros(len(leaf), dtype=bool)
        repeated[order[node]] = True
        # consecutive windows of one occurrence unite
        begin = repeated & ~np.concatenate([[False], repeated[:-1] & (leaf[1:] == leaf[:-1])])
        end = repeated & ~np.concatenate([repeated[1:] & (leaf[1:] == leaf[:-1]), [False]])
        at, to = np.flatnonzero(begin), np.flatnonzero(end)
        row = pa.array(leaf[at])
        place = first[leaf]
        return pa.RecordBatch.from_arrays(
            [
                held.column("doc_id").chunk(0).take(row),
                held.column("tie").chunk(0).take(row),
                pa.array((place[at] + inside[at]).astype(np.int32)),
                pa.array((place[to] + inside[to] + window).astype(np.int32)),
            ],
            names=["doc_id", "tie", "lo", "hi"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        leaves = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            leaves += len(column(batch, "windows").flatten())
            if leaves < SUBTREE_LEAVES:
                continue
            whole = pa.Table.from_batches(held)
            keys = whole.column("anchor").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            if cut:
                yield spans(whole.slice(0, cut))
                rest = whole.slice(cut)
                held = rest.to_batches()
                leaves = sum(len(column(b, "windows").flatten()) for b in held)
        if held:
            yield spans(pa.Table.from_batches(held))

    return run


def _heavy_spans(rows: DataFrame, window: int) -> DataFrame:
    """The same for groups beyond HEAVY: nodes are whole windows.

    Occurrences with the same windows are one kind, counted before anything is expanded, so
    copies cost one row a task; the nodes are counted over the kinds' windows, and each
    kind's repeated windows go back to its occurrences."""
    same = F.xxhash64("windows")
    rows = rows.withColumn("same", same)
    kind = ["anchor", "offset", "same"]
    kinds = rows.groupBy(*kind).agg(F.count("*").alias("times"), F.first("windows").alias("windows"))
    each = kinds.select(*kind, "times", F.posexplode("windows").alias("step", "content"))
    each = each.withColumn("depth", F.col("offset") - F.col("step"))
    node = ["anchor", "depth", "content"]
    nodes = each.groupBy(*node).agg(F.sum("times").alias("leaves")).where("leaves > 1").select(*node)
    steps = each.join(nodes, node).groupBy(*kind).agg(F.collect_list("step").alias("steps"))
    found = rows.select(*kind, "doc_id", "tie", "first").join(steps, kind)
    spans = F.transform(F.array_sort("steps"), lambda s: F.struct((F.col("first") + s).alias("lo"), (F.col("first") + s + window).alias("hi")))
    return found.select("doc_id", "tie", F.explode(_united(spans)).alias("span")).select("doc_id", "tie", "span.lo", "span.hi")


def _united(spans: Column) -> Column:
    """Sorted spans, those that touch put together."""
    empty = F.array().cast("array<struct<lo:int,hi:int>>")

    def step(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["lo"].alias("lo"), x["hi"].alias("hi"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["hi"] >= x["lo"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans, empty, step)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, heavy: int = HEAVY) -> DataFrame:
    """doc_id, tie, found: the spans (lo, hi) of words that repeated windows cover, unordered.

    ``docs``: (doc_id, tie, text), where (doc_id, tie) names a text; rows may repeat, and their
    places and spans are then gathered once, not for each copy.  Documents without such spans
    have no row.  The anchors are
    made twice, for their counts (partly summed before they move) and for the join with them."""
    found = docs.mapInArrow(_anchor_rows(window, gram), "anchor long, doc_id long, tie int, place int")
    counts = found.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1")
    places = (
        found.join(counts, "anchor")
        .groupBy("doc_id", "tie")
        .agg(
            F.collect_set(F.when(F.col("times") <= heavy, F.col("place"))).alias("light"),
            F.collect_set(F.when(F.col("times") > heavy, F.col("place"))).alias("heavy"),
        )
    )
    texts = docs.join(places, ["doc_id", "tie"])
    windows = _window_rows(window, gram)
    light, deep = (
        texts.where(F.size(kind) > 0).select("doc_id", "tie", "text", F.col(kind).alias("places")).mapInArrow(windows, WINDOW_ROW)
        for kind in ("light", "heavy")
    )
    light = light.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_subtrees(window), SPAN)
    spans = light.unionByName(_heavy_spans(deep, window))
    return spans.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("lo", "hi")).alias("found"))


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    heavy: int = HEAVY,
) -> DataFrame:
    """doc_id, n_words, spans (array of (lo, hi), word places), kept (text) of every row.

    A word goes if a window of ``window`` consecutive words that covers it has the same words
    as a window that begins elsewhere, in the same document or another; all are judged on the
    input.  Words are split at ASCII white space, unchanged; the kept ones are joined by one
    space.  NULL and blank texts have no words.  Repeated rows are elsewhere to each other; an
    empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # a row is named by 96 bits of its id and text: ids may be missing or repeat with other texts
    keyed = rows.withColumn("tie", F.coalesce(F.hash("text"), F.lit(0))).withColumn("own", F.xxhash64("doc_id", "text"))
    basis = keyed.where(F.col("text").isNotNull()).select(F.col("own").alias("doc_id"), "tie", "text")
    spans = repeated_spans(basis, window, gram, heavy)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text", TEXT_SLICE):
            counts, lists, kept = [], [], []
            for t, found in zip(texts, column(part, "found").to_pylist(), strict=True):
                words = t.split()
                spans = []
                for lo, hi in sorted((f["lo"], f["hi"]) for f in found or ()):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(hi, spans[-1][1])
                    else:
                        spans.append([lo, hi])
                left, at = [], 0
                for lo, hi in spans:
                    left += words[at:lo]
                    at = hi
                left += words[at:]
                counts.append(len(words))
                lists.append([{"lo": lo, "hi": hi} for lo, hi in spans])
                kept.append(b" ".join(left).decode())
            span = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(counts, pa.int64()), pa.array(lists, span), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "spans", "kept"],
            )

    out = keyed.join(spans, (keyed["own"] == spans["doc_id"]) & (keyed["tie"] == spans["tie"]), "left")
    out = out.select(keyed["doc_id"], keyed["text"], "found")
    return out.mapInArrow(run, "doc_id long, n_words long, spans array<struct<lo:int,hi:int>>, kept string")
