"""Rows without ids, repeated ids with other texts, and clashing hashes."""

import math

import pytest
from pyspark.sql import functions as F

import ratewave.llm.substring as substring
from ratewave.llm.language_model import language_model_scores
from ratewave.llm.mixing import mix_sources, mixed_documents
from ratewave.llm.neardup import near_duplicates, one_of_each
from ratewave.llm.substring import remove_repeats, repeated_spans
from ratewave.llm.topk import exact_topk

DOC = "doc_id long, text string, source string"


def test_mix_without_ids_comes_near_its_targets(spark):
    rows = [(None, f"w{i} " * 10, "a") for i in range(1000)] + [(None, "copy " * 10, "a")] * 500 + [(7, "b " * 10, "b")] * 300
    docs = spark.createDataFrame(rows, DOC).repartition(5)
    got = mix_sources(docs).withColumn("b", F.col("source_size") == 3000).groupBy("b").agg(F.max("target").alias("t"), F.sum("taken").alias("n")).collect()
    assert len(got) == 2 and all(abs(r.t - r.n) <= 20 for r in got)
    mixed = mixed_documents(docs).groupBy("source").count().collect()
    assert {r["source"]: 10 * r["count"] for r in mixed} == {"ab"[r.b]: r.n for r in got}


A = " ".join(f"a{i}" for i in range(200))
B = " ".join(f"b{i}" for i in range(200))


def near(text):
    return text.replace("0", "x", 1)


def test_two_texts_of_one_id_keep_their_links(spark):
    rows = [(1, A, "s"), (1, B, "s"), (2, near(B), "s"), (3, near(A), "s"), (4, "c " + A[5:50], "s"), (1, A, "s"), (None, A, "s"), (5, None, "s")]
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    got = sorted(near_duplicates(docs).select("doc_id", "component_id").distinct().collect(), key=str)
    assert [tuple(r) for r in got if r.doc_id] == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5)]
    kept = sorted((r.doc_id or 0, (r.text or "")[:2]) for r in one_of_each(docs).collect())
    assert kept == [(0, "a0"), (1, "a0"), (1, "b0"), (4, "c "), (5, "")]


def test_a_unique_text_stays_where_its_id_has_a_near_copy(spark):
    docs = spark.createDataFrame([(1, A, "s"), (2, near(A), "s"), (2, B, "s")], DOC)
    assert sorted((r.doc_id, r.text[:2]) for r in one_of_each(docs).collect()) == [(1, "a0"), (2, "b0")]


def same_hash_texts(spark, n=200_000):
    """Two texts that differ and have the same 32-bit hash."""
    texts = spark.range(n).select(F.concat(F.lit("w"), F.col("id")).alias("w")).withColumn("h", F.hash("w"))
    a, b = texts.alias("a"), texts.alias("b")
    found = a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.w") < F.col("b.w"))).select("a.w", "b.w").first()
    return tuple(found)


def test_rows_without_ids_are_told_apart(spark):
    one, other = same_hash_texts(spark)
    tie = spark.createDataFrame([(one,), (other,)], "t string").select(F.hash("t")).distinct().count()
    assert tie == 1
    rows = [(None, one, "s"), (None, other, "s"), (None, one, "s"), (9, "x y z", "s")]
    got = [(r.doc_id, r.n_tokens) for r in language_model_scores(spark.createDataFrame(rows, DOC)).collect()]
    assert sorted(got, key=str) == [(9, 4), (None, 2), (None, 2), (None, 2)]
    long = [(None, A, "s"), (None, A, "s"), (None, B, "s"), (None, "short", "s")]
    got = sorted(r.n_words - sum(s.hi - s.lo for s in r.spans) for r in remove_repeats(spark.createDataFrame(long, DOC)).collect())
    assert got == [0, 0, 1, 200]


def test_texts_of_one_id_with_the_same_hash(spark):
    one, other = same_hash_texts(spark)
    rows = [(7, one, "s"), (7, f"{other} {other}", "s"), (7, other, "s"), (7, one, "s"), (None, one, "s"), (None, None, "s"), (8, "q", "s")]
    got = [(r.doc_id, r.n_tokens) for r in language_model_scores(spark.createDataFrame(rows, DOC).repartition(3)).collect()]
    assert sorted(got, key=str) == sorted([(7, 2), (7, 3), (7, 2), (7, 2), (None, 2), (None, 1), (8, 2)], key=str)


def test_spans_of_other_texts_with_the_same_id_and_hash(spark, monkeypatch):
    # every text with the same tie: only the 64 bits of id and text are left to tell rows apart
    monkeypatch.setattr(substring.F, "hash", lambda *c: F.lit(5))
    rows = [(7, A, "s"), (8, A, "s"), (7, B, "s"), (None, B + " end", "s"), (7, "c " * 10 + B[:500].upper(), "s")]
    got = remove_repeats(spark.createDataFrame(rows, DOC).repartition(3)).collect()
    assert sorted(r.n_words - sum(s.hi - s.lo for s in r.spans) for r in got)[:4] == [0, 0, 0, 1] and len(got) == 5


def test_copies_gather_their_spans_once(spark):
    rows = [(7, A, "s")] * 50 + [(None, A, "s")] * 50 + [(1, B, "s")]
    docs = spark.createDataFrame(rows, DOC).repartition(4)
    found = repeated_spans(docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.lit(0).alias("tie"), "text")).collect()
    assert sorted(r.doc_id for r in found) == [0, 7] and all(len(r.found) <= 200 for r in found)
    for heavy in (2, 10**6):
        got = remove_repeats(docs, heavy=heavy).collect()
        assert sorted(sum(s.hi - s.lo for s in r.spans) for r in got) == [0] + [200] * 100


def test_scores_beyond_64_bits_are_refused(spark):
    for big in (1e17, 1e15):
        rows = spark.createDataFrame([(0, [big, 1.0]), (1, [2e4, 0.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="64 bits"):
            exact_topk(rows, F.col("vec_id") == 0).collect()
    fine = spark.createDataFrame([(0, [1e6, 1.0]), (1, [2e4, 0.0])], "vec_id long, embedding array<double>")
    assert exact_topk(fine, F.col("vec_id") == 0).first().score == math.floor(1024e6) * 2048 * 10_000
