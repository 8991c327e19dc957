"""The quality net against plain loops and numeric gradients; held-out rows; odd rows."""

import math

import numpy as np
import pytest

from ratewave.llm import quality as Q
from ratewave.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


def net_and_docs(seed=1):
    rng = np.random.default_rng(seed)
    docs = Q.hashed([f"a B{i}c 12 a a ## word{i % 7} ".encode() * k for i, k in enumerate([1, 2, 9, 30, 61])])
    net = Q._start(docs, np.array([0, 1, 0, 1, 1]), rng)
    net.table = rng.normal(0, 0.3, net.table.shape)
    net.shift, net.bias = rng.normal(0, 0.2, Q.HIDDEN), rng.normal(0, 0.2, 1)
    return net, docs


def plain_logit(net, doc):
    passages = [doc[i : i + Q.PASSAGE] for i in range(0, len(doc), Q.PASSAGE)]
    hs, es = [], []
    for p in passages:
        x = np.mean([net.table[w[0]] + net.table[w[1]] + net.table[w[2]] for w in p], axis=0)
        h = np.tanh(x @ net.dense + net.shift)
        gate = [math.tanh(t) / (1 + math.exp(-s)) for t, s in zip(h @ net.tanh_gate, h @ net.sigmoid_gate)]
        hs.append(h)
        es.append(math.exp(np.dot(gate, net.attend)))
    z = sum(e * h for e, h in zip(es, hs)) / sum(es)
    return float(z @ net.out + net.bias[0])


def test_forward_is_gated_attention_over_passages():
    net, docs = net_and_docs()
    assert {len(range(0, len(d), Q.PASSAGE)) for d in docs} >= {1, 4, 7}
    assert np.allclose(net.logits(docs), [plain_logit(net, d) for d in docs])
    assert np.allclose([net.logits([d])[0] for d in docs], net.logits(docs))


def test_gradients_are_the_numeric_ones():
    net, docs = net_and_docs(2)
    bags, y = Q.Bags.of(docs), np.array([0, 1, 0, 1, 1])

    def loss():
        p = 1 / (1 + np.exp(-net.forward(bags)["logit"]))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    f = net.forward(bags)
    grads, dx = net.backward(bags, f, 1 / (1 + np.exp(-f["logit"])) - y)
    rng = np.random.default_rng(3)
    for layer, grad in zip(net.layers, grads, strict=True):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in layer.shape)
            was, step = layer[at], 1e-5
            layer[at] = was + step
            up = loss()
            layer[at] = was - step
            down = loss()
            layer[at] = was
            assert math.isclose((up - down) / (2 * step), grad[at], rel_tol=1e-4, abs_tol=1e-7)
    share = np.repeat(dx / bags.sizes[:, None], bags.sizes, axis=0)
    for row in bags.rows[[0, 70], [0, 1]]:
        grad = sum(share[bags.rows[:, k] == row].sum(axis=0) for k in range(3))
        was = net.table[row].copy()
        net.table[row, 2] = was[2] + 1e-5
        up = loss()
        net.table[row, 2] = was[2] - 1e-5
        down = loss()
        net.table[row] = was
        assert math.isclose((up - down) / 2e-5, grad[2], rel_tol=1e-4, abs_tol=1e-7)


def test_words_shapes_and_distances():
    (got,) = Q.hashed([b"Ab ab AB ab. ab x\xc3\xa9"])
    assert got[0, 0] == got[1, 0] == got[2, 0] != got[3, 0]
    assert len({int(got[i, 1]) for i in (0, 1, 2, 3)}) == 4
    assert Q.last_seen(np.array([5, 5, 7, 5, 8, 8, 5, 7])).tolist() == [0, 1, 0, 2, 0, 1, 2, 3]
    assert Q.hashed([b"", b" \n"])[1].shape == (0, 3)


def test_calibration_parts_the_classes():
    logits, y = np.array([-3.0, -1, 0, 0.5, 2, 3]), np.array([0, 0, 0, 1, 1, 1])
    shift = Q.calibrated(logits, y)
    assert ((1 / (1 + np.exp(-(logits + shift))) >= Q.THRESHOLD) == y).all()
    assert Q.calibrated(logits, np.ones(6, dtype=int)) == 0


def test_held_out_rows(spark):
    got = QUERIES["op11_quality"](spark, SF01).toPandas()
    docs = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "quality").toPandas()
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == got.predicted).all()
    held = got[got.held_out].merge(docs, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.97
    again = QUERIES["op11_quality"](spark, SF01).toPandas()
    assert got.sort_values("doc_id").score.tolist() == again.sort_values("doc_id").score.tolist()


@pytest.mark.parametrize("part", [1, 4])
def test_odd_rows(spark, part):
    texts = [None, "", " \n", "good words here", "bad ## !!", "bad ## !!", "x" * 5000, "漢 é 한", "a " * 30_000]
    rows = [(i, t, "q", "q") for i, t in enumerate(texts)] + [(None, "good words here", "q", "q"), (3, "other text", "q", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y string, score string").repartition(part)
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (5, None), (99, 1), (4, 0)], "doc_id long, quality int")
    for y in (labels, labels.limit(0), labels.where("quality = 1")):
        got = Q.quality(docs, y, modulus=1, remainder=1).toPandas()
        assert len(got) == len(rows) and got.score.between(0, 1).all()
        same = got[got.doc_id.isin([4, 5])].score.tolist()
        assert same[0] == pytest.approx(same[1])
    assert Q.quality(docs.limit(0), labels).count() == 0
