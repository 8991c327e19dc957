"""Quality: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of ``PASSAGE`` words; only the document has a label.  A
passage is encoded from the mean of its words' embeddings (a word's is the sum of two rows of
a hashed table, one for its letters and one for its shape, and one of a few more rows that
stand for how far back the same word was) by a dense layer.  Gated attention,
``softmax(w . (tanh(V h) * sigmoid(U h)))`` over a document's passages, weighs the passages'
representations; a logistic layer scores the weighted sum.  All of it is trained together in
numpy from document labels.  A last shift of the scores is calibrated on training rows kept
apart from the fit, so that the score ``THRESHOLD`` is where the classes part best.

The fit uses a bounded sample of the labelled rows: at most ``most_docs`` documents of each
class and ``most_words`` words together, in the order of a hash of the id.  All rows are
scored, over all their passages.  The model is 9 MB, whatever the input's size.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewave.llm.common import column, crc_of, slices

PASSAGE = 64
DIM, HIDDEN, GATES = 8, 16, 8
BUCKETS, DISTANCES = 1 << 18, 12
EPOCHS, BATCH, SEED = 8, 32, 11
MOST_DOCS, MOST_WORDS = 4_000, 6_000_000
#: Every CALIBRATE-th training document (by hash) is kept from the fit, for the shift.
CALIBRATE = 4
THRESHOLD = 0.7
TEXT_SLICE = 1 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Byte classes: lower a, upper A, digit 0, any byte of a non-ASCII character x; others stand for themselves.
_SHAPE = bytes(
    97 if 97 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 120 if b >= 128 else b for b in range(256)
)
_RUN = re.compile(rb"(.)\1{2,}", re.S)


def rows_of(word: bytes) -> tuple[int, int]:
    """The two table rows of a word: its letters in lower case; its shape, runs shortened to two."""
    shape = _RUN.sub(rb"\1\1", word.translate(_SHAPE))
    return xxhash.xxh64_intdigest(word.translate(_LOWER), 1) % BUCKETS, xxhash.xxh64_intdigest(shape, 2) % BUCKETS


class _Index(dict):
    """word -> running number."""

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i


def last_seen(places: np.ndarray) -> np.ndarray:
    """For each word of a text, given as numbers, the bits of the distance to the same word before; 0 for a new one."""
    order = np.argsort(places, kind="stable")
    back = np.zeros(len(places), dtype=np.int64)
    back[order[1:]] = np.where(places[order[1:]] == places[order[:-1]], np.diff(order), 0)
    return np.minimum(np.frexp(back.astype(np.float64))[1], DISTANCES - 1)


def hashed(texts: list[bytes]) -> list[np.ndarray]:
    """The table rows (words x 3) of each text's words."""
    index = _Index()
    places = [np.fromiter(map(index.__getitem__, ws), dtype=np.int64, count=len(ws)) for ws in map(bytes.split, texts)]
    table = np.array([rows_of(w) for w in index], dtype=np.int32).reshape(-1, 2)
    return [np.column_stack([table[p], BUCKETS + last_seen(p)]).astype(np.int32) for p in places]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Bags:
    """Documents' words end to end, with the first word of each passage and the first passage of each document."""

    rows: np.ndarray
    passage: np.ndarray
    doc: np.ndarray

    @staticmethod
    def of(docs: list[np.ndarray]) -> Bags:
        """None may be empty."""
        lens = np.array([len(d) for d in docs], dtype=np.int64)
        count = -(-lens // PASSAGE)
        doc = np.cumsum(count) - count
        inside = np.arange(count.sum()) - np.repeat(doc, count)
        return Bags(np.concatenate(docs), np.repeat(np.cumsum(lens) - lens, count) + inside * PASSAGE, doc)

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.passage, append=len(self.rows))

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc)), np.diff(self.doc, append=len(self.passage)))


@dataclass
class GatedAttention:
    table: np.ndarray  # BUCKETS + DISTANCES x DIM
    dense: np.ndarray  # DIM x HIDDEN
    shift: np.ndarray  # HIDDEN
    tanh_gate: np.ndarray  # HIDDEN x GATES
    sigmoid_gate: np.ndarray  # HIDDEN x GATES
    attend: np.ndarray  # GATES
    out: np.ndarray  # HIDDEN
    bias: np.ndarray  # 1
    calibration: float = 0.0

    @property
    def layers(self) -> list[np.ndarray]:
        return [self.dense, self.shift, self.tanh_gate, self.sigmoid_gate, self.attend, self.out, self.bias]

    def forward(self, bags: Bags) -> dict[str, np.ndarray]:
        x = np.add.reduceat(sum(self.table[bags.rows[:, k]] for k in range(3)), bags.passage, axis=0)
        x = x.astype(np.float64) / bags.sizes[:, None]
        h = np.tanh(x @ self.dense + self.shift)
        t, s = np.tanh(h @ self.tanh_gate), _sigmoid(h @ self.sigmoid_gate)
        e = (t * s) @ self.attend
        e = np.exp(e - np.maximum.reduceat(e, bags.doc)[bags.owner])
        a = e / np.add.reduceat(e, bags.doc)[bags.owner]
        z = np.add.reduceat(a[:, None] * h, bags.doc, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "logit": z @ self.out + self.bias[0]}

    def backward(self, bags: Bags, f: dict[str, np.ndarray], err: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Gradients of the layers, and of each passage's mean, from those of the logits."""
        own, h, t, s, a = bags.owner, f["h"], f["t"], f["s"], f["a"]
        dz = (err[:, None] * self.out)[own]
        da = (dz * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, bags.doc)[own])
        gate = de[:, None] * self.attend
        dt, ds = gate * s * (1 - t * t), gate * t * s * (1 - s)
        dh = a[:, None] * dz + dt @ self.tanh_gate.T + ds @ self.sigmoid_gate.T
        pre = dh * (1 - h * h)
        grads = [f["x"].T @ pre, pre.sum(axis=0), h.T @ dt, h.T @ ds, (t * s).T @ de, f["z"].T @ err, err.sum(keepdims=True)]
        return grads, pre @ self.dense.T

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        """Of documents as table rows; one without words has the empty representation's."""
        out = np.full(len(docs), self.bias[0], dtype=np.float64)
        full = [i for i, d in enumerate(docs) if len(d)]
        if full:
            out[full] = self.forward(Bags.of([docs[i] for i in full]))["logit"]
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        return _sigmoid(self.logits(hashed(texts)) + self.calibration)


def _start(docs: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> GatedAttention:
    """An untrained net; the first component of an embedding is its row's class evidence."""
    size = BUCKETS + DISTANCES
    seen = np.zeros((2, size), dtype=np.float64)
    for d, y in zip(docs, labels, strict=True):
        seen[int(y), np.unique(d)] += 1
    n = np.array([max((labels == y).sum(), 1) for y in (0, 1)])
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    both = seen.sum(axis=0)
    table = rng.normal(0, 0.05, (size, DIM)).astype(np.float32)
    table[both == 0] = 0
    table[:, 0] = np.where(both > 0, np.clip(odds, -3, 3) / 3 * np.minimum(1, both / 8), 0)
    draw = lambda *shape: rng.normal(0, 0.4, shape)
    return GatedAttention(
        table, draw(DIM, HIDDEN), np.zeros(HIDDEN), draw(HIDDEN, GATES), draw(HIDDEN, GATES), draw(GATES), draw(HIDDEN), np.zeros(1)
    )


def fit(docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> GatedAttention:
    """Trained on documents given as table rows (words x 3); none may be empty.  Layers by Adam,
    table rows by AdaGrad; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    net = _start(docs, labels, rng)
    weight = np.array([len(labels) / (2 * max((labels == y).sum(), 1)) for y in (0, 1)])[labels]
    m1, m2 = [np.zeros(p.shape) for p in net.layers], [np.zeros(p.shape) for p in net.layers]
    squares = np.full(BUCKETS + DISTANCES, 1e-3)
    step = 0
    for epoch in range(epochs):
        slow = 1 - 0.9 * epoch / max(epochs - 1, 1)
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            step += 1
            batch = order[lo : lo + BATCH]
            bags = Bags.of([docs[i] for i in batch])
            f = net.forward(bags)
            err = (_sigmoid(f["logit"]) - labels[batch]) * weight[batch] / len(batch)
            grads, dx = net.backward(bags, f, err)
            for p, g, a, b in zip(net.layers, grads, m1, m2, strict=True):
                g = g + 1e-4 * p
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= 0.02 * slow * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
            share = np.repeat(np.repeat(dx / bags.sizes[:, None], bags.sizes, axis=0), 3, axis=0)
            ids, where = np.unique(bags.rows.ravel(), return_inverse=True)
            g = np.stack([np.bincount(where, weights=share[:, k], minlength=len(ids)) for k in range(DIM)], axis=1)
            squares[ids] += (g * g).sum(axis=1)
            net.table[ids] -= (0.05 * slow * g / np.sqrt(squares[ids])[:, None]).astype(np.float32)
    return net


def calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """The shift with which a score of ``THRESHOLD`` parts the classes with the fewest errors (the
    middle of the best gap; 0 where a class is missing)."""
    if len(set(labels.tolist())) < 2:
        return 0.0
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    # errors if the first i are taken for class 0
    errors = np.concatenate([[0], np.cumsum(y == 1)]) + np.concatenate([np.cumsum((y == 0)[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    apart = np.concatenate([[True], x[1:] > x[:-1], [True]])  # equal scores fall on one side
    best = np.flatnonzero(apart & (errors == errors[apart].min()))
    return float(np.log(THRESHOLD / (1 - THRESHOLD)) - edges[best[len(best) // 2]])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, label_col: str, most_docs: int, most_words: int
) -> DataFrame | float:
    """doc_id, y, text of at most ``most_docs`` labelled documents of each class, one for each id
    (its greatest text), and about ``most_words`` words (a word counts as six bytes) together.
    Without ids of both classes: the share of label 1 (0.0 without any)."""
    y = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    y = y.where(usable & F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    rank = F.xxhash64(F.lit(SEED), "doc_id")
    picked: dict[int, list] = {0: [], 1: []}
    for r in y.groupBy("y").agg(F.count("*").alias("n")).collect():
        # a share of the hash range holds somewhat more than the bound; the order cuts it there
        low = F.lit(int(-(2**63) + 2**64 * min(1.0, 1.2 * most_docs / r.n)) - 1)
        own = y.where((F.col("y") == r.y) & (rank <= low)).orderBy(rank, "doc_id").limit(most_docs)
        picked[r.y] = [x.doc_id for x in own.collect()]
    if not (picked[0] and picked[1]):
        return 1.0 if picked[1] else 0.0
    spark = docs.sparkSession
    kind = y.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.octet_length("text") > 0)
    listed = spark.createDataFrame([(i, k) for k in (0, 1) for i in picked[k]], f"doc_id {kind}, y int")
    one = lambda ids: rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y")
    size = {r.doc_id: r.n for r in one(listed).agg(F.max(F.octet_length("text")).alias("n")).collect()}
    kept, total = [], 0
    turns = sorted((j, k, i) for k in (0, 1) for j, i in enumerate(picked[k]))  # the classes by turns
    for _, k, i in turns:
        words = size.get(i, 0) // 6 + 1
        if i in size and total + words <= most_words:
            kept.append((i, k))
            total += words
    return one(spark.createDataFrame(kept, f"doc_id {kind}, y int")).agg(F.max("text").alias("text"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most_docs: int = MOST_DOCS,
    most_words: int = MOST_WORDS,
) -> GatedAttention | float:
    """A net fitted on the rows of ``labels`` (id, label 0 / 1) that meet ``usable``, a condition
    on their ``doc_id``; without texts of both classes the share of label 1.

    The sampled ids (at most 2 * ``most_docs``) are broadcast to the scan of ``docs``; the
    driver receives the sampled documents' hashed words, about ``most_words``.
    """
    sample = labelled_sample(docs, labels, usable, id_col, text_col, label_col, most_docs, most_words)
    if isinstance(sample, float):
        return sample

    def to_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text", TEXT_SLICE):
            raw = pa.array([x.tobytes() for x in hashed(texts)], pa.binary())
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "y"), raw], names=["doc_id", "y", "words"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(to_rows, f"doc_id {kind}, y int, words binary").toArrow()
    found = zip(got["doc_id"].to_pylist(), got["y"].to_pylist(), got["words"].to_pylist(), strict=True)
    # in the order of a hash, whatever order the tasks came in; of equal word lists one
    found = sorted(((xxhash.xxh64_intdigest(str(i)), str(i), y, w) for i, y, w in found if w))
    found = list({w: (h, i, y, w) for h, i, y, w in found}.values())
    held = [x for x in found if x[0] % CALIBRATE == 0]
    main = [x for x in found if x[0] % CALIBRATE]
    if len({x[2] for x in main}) < 2:
        held, main = [], found
    if len({x[2] for x in main}) < 2:
        return float(np.mean([x[2] for x in main])) if main else 0.0
    bags = lambda part: [np.frombuffer(x[3], dtype=np.int32).reshape(-1, 3) for x in part]
    classes = lambda part: np.array([x[2] for x in part], dtype=np.int64)
    net = fit(bags(main), classes(main))
    if held:
        logits = np.concatenate([net.logits([b]) for b in bags(held)])
        net.calibration = calibrated(logits, classes(held))
    return net


def score_documents(docs: DataFrame, model: GatedAttention | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row: of its text alone.  NULL counts as the empty text, which has
    the score of no passages.  Rows are independent; an empty table gives none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 9 MB

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for part, texts in slices(batches, "text", TEXT_SLICE):
            s = np.full(len(texts), net) if isinstance(net, float) else net.score(texts)
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), pa.array(s.astype(np.float64))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def quality(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, **options) -> DataFrame:
    """doc_id, held_out, score, predicted: rows whose crc32(id) mod ``modulus`` is ``remainder``
    are held out of all learning; ``predicted`` is 1 from a score of ``THRESHOLD`` on."""
    held = crc_of(F.col("doc_id"), modulus) == remainder
    out = score_documents(docs, train(docs, labels, ~held, **options))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
