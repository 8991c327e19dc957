"""Toxicity: a convolutional text classifier trained in numpy, in shards.

A word's embedding is the sum of two rows of one hashed table.  Filters of widths 1, 2
and 3 run over the words, the largest response of each filter over the whole text is
kept, and a logistic layer turns the responses into a score.  The table starts from the
words' class evidence in the training rows; everything is then trained by gradient
descent (only the windows that won the pooling receive gradients).  Thresholds for a
decision are calibrated by language on all training rows, by cross-fitting: the rows are dealt into
two folds, and each fold is scored by a net that was fitted on the other one alone.  The net that
scores documents is fitted on both.

All labelled rows take part, a text that occurs more than once once.  They are dealt by a hash into
shards of about SHARD_WORDS words.  In each of ROUNDS rounds every shard is trained on by
one task, from the same model, and what the tasks return is averaged: the layers over all shards,
a row of the table over the shards that changed it.  What fits into one shard needs one round.  Word
evidence and the errors of thresholds are counted by Spark over all shards.  The model is a few MB,
whatever the input's size.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewave.llm.common import column, crc_of, materialize, slices

WIDTHS = (1, 2, 3)
FILTERS = 6  # of each width
DIM = 4
BUCKETS = 1 << 20
EPOCHS = 12
BATCH = 32
SEED = 7
#: Words of a shard (8 bytes each), about, and the rounds in which more than one is trained.
SHARD_WORDS = 1_250_000
ROUNDS = 4
#: Up to so many ids are broadcast to the scan of the texts; with more, Spark chooses the join.
FEW_IDS = 1 << 20
GRID = np.linspace(0.3, 0.7, 41)
TEXT_SLICE = 1 << 20

#: A-Z to a-z; other ASCII but letters and digits separates words.
_CLEAN = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


class _Index(dict):
    """word -> running number."""

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


def hashed(words: Iterable[bytes]) -> np.ndarray:
    """The two table rows of each word."""
    h = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    return np.stack([h % BUCKETS, (h >> np.uint64(32)) % BUCKETS], axis=1).astype(np.int64)


@dataclass
class ConvNet:
    table: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    shifts: list[np.ndarray]  # per width: FILTERS
    out: np.ndarray  # len(WIDTHS) * FILTERS
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def responses(
        self, rows: np.ndarray, which: np.ndarray, starts: np.ndarray, winners: bool = False
    ) -> tuple[np.ndarray, np.ndarray | None]:
        """Pooled responses of each document, and the first winning places if asked for.

        ``rows``: table rows of the distinct words; ``which``: distinct word of each place;
        documents begin at ``starts``.  Windows that reach past the end of a document see
        nothing there.  Documents must have words.
        """
        n, gap = len(which), WIDTHS[-1] - 1
        ends = np.append(starts[1:], n)
        vecs = self.table.take(rows[:, 0], axis=0) + self.table.take(rows[:, 1], axis=0)
        # gap empty places follow each document, so that no window reaches into the next one
        lo = starts + gap * np.arange(len(starts))
        hi = lo + (ends - starts)
        place = np.full(n + gap * len(starts), len(vecs))
        place[np.arange(n) + np.repeat(lo - starts, ends - starts)] = which
        padded = np.concatenate([vecs, np.zeros((1, DIM), dtype=np.float32)]).take(place, axis=0)
        spans = list(zip(lo.tolist(), hi.tolist(), strict=True))
        pooled, won = [], []
        for width, w, b in zip(WIDTHS, self.filters, self.shifts, strict=True):
            total = w[0].T @ padded.T  # filters x places
            total += b.astype(np.float32)[:, None]
            for k in range(1, width):
                total[:, :-k] += (w[k].T @ padded.T)[:, k:]
            first = np.stack([total[:, x:y].argmax(axis=1) for x, y in spans])
            pooled.append(total[np.arange(FILTERS)[None, :], first + lo[:, None]])
            won.append(first + starts[:, None])
        return np.concatenate(pooled, axis=1), np.concatenate(won, axis=1) if winners else None

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Scores in 0..1; a text without words has no responses, and the score of the bias."""
        index = _Index()
        places = [np.fromiter(map(index.__getitem__, ws), dtype=np.int64, count=len(ws)) for ws in map(words_of, texts)]
        logit = np.full(len(texts), self.bias, dtype=np.float64)
        full = np.flatnonzero([len(p) for p in places])
        if len(full):
            lens = np.array([len(places[i]) for i in full])
            which = np.concatenate([places[i] for i in full])
            pooled, _ = self.responses(hashed(index), which, np.cumsum(lens) - lens)
            logit[full] += np.maximum(pooled, 0).astype(np.float64) @ self.out
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


@dataclass
class Training:
    """A net and what its optimisers remember (Adam for the layers, AdaGrad for the table): where a round starts and ends."""

    net: ConvNet
    rng: np.random.Generator
    first: list[np.ndarray]
    second: list[np.ndarray]
    bias_m: list[float]
    table_g: np.ndarray  # squared gradients by row
    step: int = 0

    @property
    def params(self) -> list[np.ndarray]:
        return [*self.net.filters, *self.net.shifts, self.net.out]

    def layers(self) -> np.ndarray:
        """All but the table as one vector."""
        parts = [p.ravel() for p in (*self.params, *self.first, *self.second)]
        return np.concatenate([*parts, [self.net.bias, *self.bias_m, self.step]]).astype(np.float64)

    def set_layers(self, flat: np.ndarray) -> None:
        at = 0
        for p in (*self.params, *self.first, *self.second):
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
        self.net.bias, self.bias_m, self.step = float(flat[at]), [float(x) for x in flat[at + 1 : at + 3]], round(flat[at + 3])


def start(seen: np.ndarray, sizes: tuple[int, int], seed: int = SEED) -> Training:
    """An untrained net whose first embedding component is the words' class evidence.  ``seen``: in how
    many documents of each class a table row occurs (2 x BUCKETS); ``sizes``: the documents of each class."""
    rng = np.random.default_rng(seed)
    seen = seen.astype(np.float32)
    n0, n1 = (np.int64(max(n, 1)) for n in sizes)
    odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
    both = seen.sum(axis=0)
    table = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    table[both == 0] = 0
    table[:, 0] = np.where(both > 0, np.clip(odds, -3, 3) / 3 * np.minimum(1, both / 16), 0)
    filters = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, :] = np.abs(f[:, 0, :]) + 0.3
    out = np.full(len(WIDTHS) * FILTERS, 0.3, dtype=np.float64)
    net = ConvNet(table, filters, [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS], out, -2.0)
    params = [*net.filters, *net.shifts, net.out]
    zeros = lambda: [np.zeros(p.shape) for p in params]
    return Training(net, rng, zeros(), zeros(), [0.0, 0.0], np.full(BUCKETS, 1e-3, dtype=np.float32))


def descend(
    state: Training, docs: list[np.ndarray], labels: np.ndarray, by_class: np.ndarray, epochs: Iterable[int], total: int = EPOCHS
) -> None:
    """The given ones of ``total`` epochs over documents given as arrays (places x 2) of table rows; none
    may be empty.  ``by_class``: the weights of the two classes."""
    net, rng, table_g, bias_m = state.net, state.rng, state.table_g, state.bias_m
    weight = by_class[labels]
    params, m1, m2 = state.params, state.first, state.second
    step = state.step
    for epoch in epochs:
        slow = 1 - 0.9 * epoch / max(total - 1, 1)
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            step += 1
            batch = order[lo : lo + BATCH]
            lens = np.array([len(docs[i]) for i in batch])
            rows = np.concatenate([docs[i] for i in batch])
            starts = np.cumsum(lens) - lens
            pooled, won = net.responses(rows, np.arange(len(rows)), starts, winners=True)
            active = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ net.out + net.bias, -40, 40)))
            err = (p - labels[batch]) * weight[batch] / len(batch)
            grads = [np.zeros(q.shape) for q in params]
            grads[-1] = active.T @ err + 1e-4 * net.out
            back = np.outer(err, net.out) * (pooled > 0)  # documents x features
            ends = starts + lens
            touched, shares = [], []
            for j, width in enumerate(WIDTHS):
                cols = slice(j * FILTERS, (j + 1) * FILTERS)
                g, at = back[:, cols], won[:, cols]
                grads[len(WIDTHS) + j] = g.sum(axis=0)
                for k in range(width):
                    inside = at + k < ends[:, None]
                    place = np.where(inside, at + k, 0)
                    r = rows[place]  # documents x filters x 2
                    vec = net.table[r[..., 0]] + net.table[r[..., 1]]
                    gk = np.where(inside, g, 0.0)
                    grads[j][k] = np.einsum("df,dfe->ef", gk, vec)
                    share = gk[..., None] * net.filters[j][k].T[None]  # documents x filters x DIM
                    used = gk != 0
                    touched.append(r[used])
                    shares.append(share[used])
            rate = 0.01 * slow
            for q, g, a, b in zip(params, grads, m1, m2, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                q -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(q.dtype)
            g = float(err.sum())
            bias_m = [bias_m[0] + 0.1 * (g - bias_m[0]), bias_m[1] + 0.001 * (g * g - bias_m[1])]
            net.bias -= rate * bias_m[0] / (1 - 0.9**step) / (np.sqrt(bias_m[1] / (1 - 0.999**step)) + 1e-8)
            hit, part = np.concatenate(touched), np.concatenate(shares)
            if len(hit):
                ids, where = np.unique(hit.ravel(), return_inverse=True)
                g = np.zeros((len(ids), DIM))
                np.add.at(g, where, np.repeat(part, 2, axis=0))
                table_g[ids] += (g * g).sum(axis=1)
                net.table[ids] -= (0.05 * slow * g / np.sqrt(table_g[ids])[:, None]).astype(np.float32)
    state.bias_m, state.step = bias_m, step


def calibrate(counts: dict[str, np.ndarray]) -> dict[str, float]:
    """Per language the threshold in [0.3, 0.7] with the fewest errors (the middle of the
    best range; 0.5 where a class is missing).  ``counts``: by class and number of GRID's
    values that a score reaches (2 x len(GRID) + 1)."""
    out = {}
    for lang, (zero, one) in sorted(counts.items()):
        if not one.any() or not zero.any():
            out[lang] = 0.5
            continue
        errors = np.cumsum(one)[:-1] + np.cumsum(zero[::-1])[::-1][1:]
        out[lang] = float(np.median(GRID[errors == errors.min()]))
    return out


def _digest(raw: bytes) -> bytes:
    return xxhash.xxh128_digest(raw)


def _raw_words(texts: list[bytes]) -> list[bytes]:
    """The table rows (int32 pairs) of each text's words."""
    index = _Index()
    places = [[index[w] for w in words_of(t)] for t in texts]
    table = hashed(index).astype(np.int32) if index else np.zeros((0, 2), np.int32)
    return [table[p].tobytes() if p else b"" for p in places]


def _named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, y, lang, text -> rank (an order by a hash), held (the fold, by another), digest and number of the words; texts without words go."""
    for part, texts in slices(batches, "text", TEXT_SLICE):
        raw = _raw_words(texts)
        ids = column(part, "doc_id").to_pylist()
        rank = [xxhash.xxh64_intdigest(f"{i}:{len(w)}") - 2**63 for i, w in zip(ids, raw, strict=True)]
        held = [xxhash.xxh64_intdigest(f"calibrate {i}") % 2 == 1 for i in ids]
        out = pa.RecordBatch.from_arrays(
            [
                *(column(part, c) for c in ("doc_id", "y", "lang")),
                pa.array(rank, pa.int64()),
                pa.array(held, pa.bool_()),
                pa.array([_digest(w) for w in raw], pa.binary()),
                pa.array([len(w) // 8 for w in raw], pa.int64()),
            ],
            names=["doc_id", "y", "lang", "rank", "held", "digest", "n"],
        )
        yield out.filter(pa.array([bool(w) for w in raw], pa.bool_()))


def _worded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the words of ``digest``, with the words."""
    names = ["held", "shard", "y", "lang", "last", "digest"]
    for part, texts in slices(batches, "text", TEXT_SLICE):
        raw, digest = _raw_words(texts), column(part, "digest")
        out = pa.RecordBatch.from_arrays([*(column(part, c) for c in names), pa.array(raw, pa.binary())], names=[*names, "words"])
        yield out.filter(pa.array([_digest(w) == d for w, d in zip(raw, digest.to_pylist(), strict=True)], pa.bool_()))


SHARD_ROW = "held boolean, shard int, words binary, sizes binary, ys binary, langs array<string>"


def _packed(rows: pa.Table) -> pa.Table:
    """One row of all documents of a shard, from the last rank to the first; of a row that is there twice, one."""
    order = sorted(zip(rows["last"].to_pylist(), rows["digest"].to_pylist(), range(rows.num_rows), strict=True), reverse=True)
    use = [i for k, (_, d, i) in enumerate(order) if not k or d != order[k - 1][1]]
    words, ys, langs = (rows[c].take(pa.array(use)).to_pylist() for c in ("words", "y", "lang"))
    return pa.table(
        {
            "held": pa.array([rows["held"][0].as_py()], pa.bool_()),
            "shard": pa.array([rows["shard"][0].as_py()], pa.int32()),
            "words": pa.array([b"".join(words)], pa.binary()),
            "sizes": pa.array([np.array([len(w) // 8 for w in words], dtype=np.int64).tobytes()], pa.binary()),
            "ys": pa.array([np.array(ys, dtype=np.int64).tobytes()], pa.binary()),
            "langs": pa.array([langs], pa.list_(pa.string())),
        }
    )


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, int, list[np.ndarray], np.ndarray, list[str | None]]]:
    """(fold, number, documents, labels, languages) of each packed row."""
    for batch in batches:
        for i in range(batch.num_rows):
            words, sizes, ys = (np.frombuffer(column(batch, c)[i].as_buffer(), dtype=t) for c, t in (("words", np.int32), ("sizes", np.int64), ("ys", np.int64)))
            docs = np.split(words.reshape(-1, 2), np.cumsum(sizes)[:-1])
            yield column(batch, "held")[i].as_py(), column(batch, "shard")[i].as_py(), docs, ys, column(batch, "langs")[i].as_py()


def _evidence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of each class a table row occurs: one row for each table row of the task."""
    seen = np.zeros((2, BUCKETS), dtype=np.int32)
    for _, _, docs, ys, _ in _shards(batches):
        for d, y in zip(docs, ys.tolist(), strict=True):
            seen[y, np.unique(d)] += 1
    ids = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), *(pa.array(x[ids]) for x in seen)], names=["row", "n0", "n1"])


#: What a shard returns.
ROUND_ROW = f"row int, {', '.join(f'c{k} float' for k in range(DIM))}, squares float, layer double"


def _trained(shared: Broadcast, by_class: np.ndarray, epochs: range, alone: bool):
    """Each shard trained on from the shared state (``alone``: a task's shards as one): the changed rows of
    the table, and the layers' values as rows -1, -2, ..."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old = shared.value
        names = ["row", *(f"c{k}" for k in range(DIM)), "squares", "layer"]
        shards = ((held, number, docs, ys) for held, number, docs, ys, _ in _shards(batches))
        if alone:
            parts = sorted(shards, key=lambda x: x[:2])
            shards = [(False, 0, [d for x in parts for d in x[2]], np.concatenate([x[3] for x in parts]))] if parts else []
        for held, number, docs, ys in shards:
            new = copy.deepcopy(old)
            if not alone:
                new.rng = np.random.default_rng([SEED, epochs.start, number, int(held)])
            descend(new, docs, ys, by_class, epochs)
            ids = np.flatnonzero((new.net.table != old.net.table).any(axis=1) | (new.table_g != old.table_g))
            columns = [ids.astype(np.int32), *new.net.table[ids].T, new.table_g[ids]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(ids), pa.float64())], names=names)
            flat = new.layers()
            row = pa.array(-1 - np.arange(len(flat), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([row, *[pa.nulls(len(flat), pa.float32())] * (DIM + 1), pa.array(flat)], names=names)

    return run


def _reached(shared: Broadcast):
    """Scores of documents that the net was not fitted on, counted by language, class and the number of GRID's values they reach."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for _, _, docs, ys, langs in _shards(batches):
            pooled = [net.responses(d, np.arange(len(d)), np.zeros(1, dtype=np.int64))[0][0] for d in docs]
            s = np.array([1 / (1 + np.exp(-np.clip(np.maximum(x, 0) @ net.out + net.bias, -40, 40))) for x in pooled])
            k = np.searchsorted(GRID, s, side="right")
            yield pa.RecordBatch.from_arrays(
                [pa.array([x or "" for x in langs], pa.string()), pa.array(ys.astype(np.int32)), pa.array(k.astype(np.int32))], names=["lang", "y", "k"]
            )

    return run


def labelled_shards(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, lang_col: str, label_col: str, shard_words: int
) -> tuple[DataFrame, dict[tuple[bool, int], int]] | float:
    """(the packed shards of all labelled rows with words, the documents by (held, label)); ``held`` tells
    the folds apart.  Without rows of both classes: the share of label 1 (0.0 without any)."""
    y = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    y = y.where(usable & F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    found = {r.y: r.n for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(found) < 2:
        return float(max(found, default=0))
    few = lambda df, n: F.broadcast(df) if n <= FEW_IDS else df
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    labelled = rows.join(few(y, sum(found.values())), "doc_id").select("doc_id", "y", "lang", "text")
    kind = labelled.schema["doc_id"].dataType.simpleString()
    named = labelled.mapInArrow(_named, f"doc_id {kind}, y int, lang string, rank long, held boolean, digest binary, n long")
    # copies would weigh their rare words: of equal word lists the first by rank
    first = F.min(F.struct("rank", "doc_id", "y", "lang", "held", "n")).alias("first")
    chosen = named.groupBy("digest").agg(first, F.max("rank").alias("last")).select("digest", "last", "first.*")
    chosen = materialize(chosen, "toxicity_rows")
    sums = chosen.groupBy("held", "y").agg(F.count("*").alias("docs"), F.sum("n").alias("words")).collect()
    if len({(r.held, r.y) for r in sums}) < 4:  # a fold has no rows of a class: too few to tell them apart
        chosen = chosen.withColumn("held", F.lit(False))
        sums = chosen.groupBy("held", "y").agg(F.count("*").alias("docs"), F.sum("n").alias("words")).collect()
    sizes = {(r.held, r.y): r.docs for r in sums}
    if len({k for h, k in sizes if not h}) < 2:
        return float(max((k for _, k in sizes), default=0))
    count = [math.ceil(sum(r.words for r in sums if r.held == h) / shard_words) or 1 for h in (False, True)]
    shard = F.pmod(F.xxhash64("digest"), F.when(F.col("held"), count[1]).otherwise(count[0])).cast("int").alias("shard")
    chosen = chosen.select("doc_id", "y", "lang", "last", "held", "digest", shard)
    words = rows.select("doc_id", "text").join(few(chosen, sum(sizes.values())), "doc_id").mapInArrow(
        _worded, "held boolean, shard int, y int, lang string, last long, digest binary, words binary"
    )
    return materialize(words.groupBy("held", "shard").applyInArrow(_packed, SHARD_ROW), "toxicity_shards"), sizes


def _fit(packed: DataFrame, n: tuple[int, int], shard_words: int) -> ConvNet:
    """A net fitted on packed shards that hold ``n`` documents of each class."""
    by_class = np.array([sum(n) / (2 * max(k, 1)) for k in n])
    counted = packed.mapInArrow(_evidence, "row int, n0 int, n1 int").groupBy("row").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    seen = np.zeros((2, BUCKETS))
    seen[:, counted["row"].to_numpy()] = counted["n0"].to_numpy(), counted["n1"].to_numpy()
    del counted
    state = start(seen, n)
    del seen
    size = packed.agg(F.count("*").alias("shards"), F.sum(F.length("words")).alias("bytes")).first()
    alone = size.shards == 1 or size.bytes <= 8 * shard_words
    if alone:  # at most one shard's words, in both folds
        packed = packed.coalesce(1)
    rounds = 1 if alone else ROUNDS
    means = [F.avg(c).cast("float").alias(c) for c in (*(f"c{k}" for k in range(DIM)), "squares")]
    for r in range(rounds):
        shared = packed.sparkSession.sparkContext.broadcast(state)  # 21 MB
        epochs = range(r * EPOCHS // rounds, (r + 1) * EPOCHS // rounds)
        got = packed.mapInArrow(_trained(shared, by_class, epochs, alone), ROUND_ROW)
        got = got.groupBy("row").agg(*means, F.avg("layer").alias("layer")).toArrow()
        row = got["row"].to_numpy()
        at, layers = row[row >= 0], row < 0
        for k in range(DIM):
            state.net.table[at, k] = got[f"c{k}"].to_numpy()[row >= 0]
        state.table_g[at] = got["squares"].to_numpy()[row >= 0]
        state.set_layers(got["layer"].to_numpy()[layers][np.argsort(-row[layers])])
        shared.destroy()
    return state.net


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "toxic",
    shard_words: int = SHARD_WORDS,
) -> ConvNet | float:
    """A net fitted on all rows of ``labels`` (id, label 0 / 1) that meet ``usable``, a condition
    on their ``doc_id``, with thresholds from the cross-fitted scores of the same rows.  Without rows of both classes: the share of label 1 (0.0 without any).

    Texts stay in tasks; the driver receives at most the table (BUCKETS rows) in each round.
    """
    found = labelled_shards(docs, labels, usable, id_col, text_col, lang_col, label_col, shard_words)
    if isinstance(found, float):
        return found
    packed, sizes = found
    net = _fit(packed, tuple(sum(sizes.get((h, k), 0) for h in (False, True)) for k in (0, 1)), shard_words)
    if any(h for h, _ in sizes):
        spark = docs.sparkSession
        counts: dict[str, np.ndarray] = {}
        for fold in (False, True):
            own, other = (packed.where(F.col("held") == h) for h in (fold, not fold))
            shared = spark.sparkContext.broadcast(_fit(own, tuple(sizes[fold, k] for k in (0, 1)), shard_words))
            reached = other.mapInArrow(_reached(shared), "lang string, y int, k int").groupBy("lang", "y", "k").agg(F.count("*").alias("n"))
            for x in reached.collect():  # at most 84 rows for each language
                counts.setdefault(x.lang, np.zeros((2, len(GRID) + 1), dtype=np.int64))[x.y, x.k] += x.n
            shared.destroy()
        net.thresholds = calibrate(counts)
    return net


def _shared(docs: DataFrame, model: ConvNet | float) -> tuple[Broadcast, dict[str, float]]:
    """(the model as a broadcast, at most 17 MB; its thresholds)."""
    return docs.sparkSession.sparkContext.broadcast(model), {} if isinstance(model, float) else model.thresholds


def score_documents(
    docs: DataFrame, model: ConvNet | float, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """doc_id, lang, score, rejected of every row.

    The score depends on the text alone; ``rejected`` is whether it reaches the threshold
    of the row's language (0.5 for languages without one).  NULL counts as the empty text,
    which has a score too.  Rows are independent; an empty table gives none.
    """

    shared, cut = _shared(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for part, texts in slices(batches, "text", TEXT_SLICE):
            s = np.full(len(texts), net) if isinstance(net, float) else net.score(texts)
            limit = np.array([cut.get(x or "", 0.5) for x in column(part, "lang").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), column(part, "lang"), pa.array(s.astype(np.float64)), pa.array(s >= limit)],
                names=["doc_id", "lang", "score", "rejected"],
            )

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang string, score double, rejected boolean")


def drop_rejected(docs: DataFrame, model: ConvNet | float, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, that the model doesn't reject."""
    shared, limits = _shared(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for part, texts in slices(batches, text_col, TEXT_SLICE):
            s = np.full(len(texts), net) if isinstance(net, float) else net.score(texts)
            limit = np.array([limits.get(str(x or ""), 0.5) for x in column(part, lang_col).to_pylist()])
            yield part.filter(pa.array(s < limit))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, rejected: rows whose crc32(id) mod ``modulus`` is 0
    are held out of all learning; ``predicted`` is 1 from a score of 0.5 on."""
    model = train(docs, labels, crc_of(F.col("doc_id"), modulus) != 0, **options)
    out = score_documents(docs, model)
    return out.select(
        "doc_id",
        (crc_of(F.col("doc_id"), modulus) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "rejected",
    )
