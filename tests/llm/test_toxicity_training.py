"""The toxicity classifier learns from all labelled rows, in one shard or in several."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewave.llm import toxicity as X

TOXIC = 5_000


def test_words_of_every_labelled_row_count(spark):
    """Toxic rows carry one word in the first 4,000 by the hash of the id, another in the rest."""
    ids = spark.range(TOXIC + 300).select(F.col("id").alias("doc_id"), F.xxhash64(F.lit(X.SEED), "id").alias("h")).collect()
    toxic = sorted((r.h, r.doc_id) for r in ids if r.doc_id < TOXIC)
    late = {d for _, d in toxic[4_000:]}
    word = lambda d: "plain" if d >= TOXIC else "grol" if d in late else "brak"
    docs = spark.createDataFrame([(r.doc_id, f"w{r.doc_id} {word(r.doc_id)} w{r.doc_id % 7}", "en") for r in ids], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r.doc_id, int(r.doc_id < TOXIC)) for r in ids], "doc_id long, toxic int")
    net = X.train(docs, labels, F.lit(True))
    brak, grol, plain = net.score([b"brak", b"grol", b"plain"])
    assert plain < 0.5 < min(brak, grol)
    assert net.table[X.hashed([b"grol"])[0], 0].min() > 0.5  # counted as evidence


def test_shards_hold_every_row_once(spark):
    rows = [(i, f"words of number {i // 2} and more", "en") for i in range(200)]  # each text twice
    docs = spark.createDataFrame([*rows, rows[0], (None, "no id", "en"), (500, None, "en"), (501, " ", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i // 2 % 2) for i in [*range(200), 500, 501]], "doc_id long, toxic int")
    packed, sizes = X.labelled_shards(docs, labels, F.lit(True), "doc_id", "text", "lang", "toxic", shard_words=100)
    shards = packed.collect()
    held = sum(n for (h, _), n in sizes.items() if h)
    assert sum(sizes.values()) == 100 and 0 < held < 50 and len(shards) > 4
    got = [(s.held, y, lang) for s in shards for y, lang in zip(np.frombuffer(s.ys, np.int64).tolist(), s.langs, strict=True)]
    assert len(got) == 100 and sum(h for h, _, _ in got) == held and sum(y for _, y, _ in got) == 50
    for s in shards:
        assert np.frombuffer(s.sizes, np.int64).sum() * 8 == len(s.words)


def test_shards_learn_what_one_shard_learns(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = X.crc_of(F.col("doc_id"), 5) == 0
    net = X.train(docs, labels, ~held, shard_words=250_000)
    got = X.score_documents(docs.where(held), net).join(labels, "doc_id").select("toxic", "score").collect()
    caught = [r.score >= 0.5 for r in got if r.toxic == 1]
    wrong = [r.score >= 0.5 for r in got if r.toxic == 0]
    assert sum(caught) > 0.85 * len(caught) and sum(wrong) < 0.02 * len(wrong)
    assert set(net.thresholds) >= {"en"}


def test_thresholds_from_counts():
    zero, one = np.zeros(42, dtype=np.int64), np.zeros(42, dtype=np.int64)
    zero[0], zero[21], one[31], one[41] = 5, 2, 3, 9  # scores below 0.3, 0.5, 0.6, from 0.7 on
    cut = X.calibrate({"en": np.array([zero, one]), "de": np.array([zero, one * 0])})
    scores = np.repeat([0.1, 0.5001, 0.6001, 0.9], [5, 2, 3, 9])
    labels = np.repeat([0, 0, 1, 1], [5, 2, 3, 9])
    errors = [((scores >= t) != (labels == 1)).sum() for t in X.GRID]
    assert cut["de"] == 0.5 and cut["en"] == pytest.approx(np.median(X.GRID[np.array(errors) == min(errors)]))
    assert not ((scores >= cut["en"]) != (labels == 1)).any()


def test_thresholds_count_every_row_by_a_net_fitted_without_it(spark, monkeypatch):
    rows = [(i, f"w{i} {'vile' if i % 2 else 'nice'} w{i % 7}", "en" if i % 3 else "de") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i, _, _ in rows], "doc_id long, toxic int")
    fit, counts, fitted = X._fit, [], []

    def watched(packed, n, shard_words):
        fitted.append((n, {r.held for r in packed.collect()}))
        return fit(packed, n, shard_words)

    monkeypatch.setattr(X, "_fit", watched)
    monkeypatch.setattr(X, "calibrate", lambda c: counts.append(c) or {})
    for shard_words in (X.SHARD_WORDS, 200):
        counts.clear(), fitted.clear()
        X.train(docs, labels, F.lit(True), shard_words=shard_words)
        assert {lang: c.sum(axis=1).tolist() for lang, c in counts[0].items()} == {"de": [50, 50], "en": [100, 100]}
        (whole, both), (zero, first), (one, second) = fitted
        assert whole == (150, 150) and both == {False, True}  # the net that scores: fitted on all rows
        assert (first, second) == ({False}, {True}) and tuple(np.add(zero, one)) == whole


def test_responses_are_those_of_plain_loops():
    rng = np.random.default_rng(3)
    net = X.start(rng.integers(0, 9, (2, X.BUCKETS)), (5, 5)).net
    docs = [rng.integers(0, X.BUCKETS, (n, 2)) for n in (1, 2, 3, 40)]
    docs[3][20:] = docs[3][:20]  # equal windows: the first one wins
    lens = np.array([len(d) for d in docs])
    starts = np.cumsum(lens) - lens
    pooled, won = net.responses(np.concatenate(docs), np.arange(lens.sum()), starts, winners=True)
    for i, d in enumerate(docs):
        vecs = net.table[d].sum(axis=1)
        for j, (width, w, b) in enumerate(zip(X.WIDTHS, net.filters, net.shifts, strict=True)):
            windows = np.array([sum(vecs[p + k] @ w[k] for k in range(width) if p + k < len(d)) + b for p in range(len(d))])
            cols = slice(j * X.FILTERS, (j + 1) * X.FILTERS)
            np.testing.assert_allclose(pooled[i, cols], windows.max(axis=0), rtol=1e-4, atol=1e-6)
            np.testing.assert_allclose(windows[won[i, cols] - starts[i], np.arange(X.FILTERS)], windows.max(axis=0), rtol=1e-4, atol=1e-6)
