"""Hash-stable sampling and splitting."""

from pyspark.sql import functions as F

from ratewave.operators.sampling import (
    SPLIT_KEYS,
    hash_split,
    modular_unit_hash,
    numbered_copies,
    random_split,
    sample_n,
)


def test_sample_exact_and_stable(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    a = sorted(r.k for r in sample_n(df, 500, 7, ["k"]).collect())
    b = sorted(r.k for r in sample_n(df.repartition(7), 500, 7, ["k"]).collect())
    assert len(a) == 500 and a == b


def test_sample_smaller_than_n_returns_all(spark):
    df = spark.range(0, 30).withColumnRenamed("id", "k")
    assert sample_n(df, 500, 1, ["k"]).count() == 30


def test_hash_split_disjoint_cover_stable(spark):
    df = spark.range(0, 10000).withColumnRenamed("id", "k")
    train, test = hash_split(df, [0.8, 0.2], 42, ["k"])
    a, b = {r.k for r in train.collect()}, {r.k for r in test.collect()}
    assert not (a & b) and len(a | b) == 10000
    assert 7700 < len(a) < 8300
    train2, _ = hash_split(df.repartition(5), [0.8, 0.2], 42, ["k"])
    assert {r.k for r in train2.collect()} == a


def test_random_split_parts_sum(spark):
    df = spark.range(0, 1000)
    parts = random_split(df, [0.8, 0.2], 42)
    assert sum(p.count() for p in parts) == 1000


def test_split_by_content_divides_a_hot_group_and_ignores_the_layout(spark, tmp_dir):
    from pyspark.sql import functions as F

    # a third of all rows are one identical record
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"), F.lit("x").alias("w")
    )
    df.repartition(3, "v").write.parquet(f"{tmp_dir}/other")
    parts = []
    for layout in (df, df.repartition(11), spark.read.parquet(f"{tmp_dir}/other")):
        numbered = numbered_copies(layout)
        assert numbered.count() == 6000
        train, test = hash_split(numbered, [0.8, 0.2], 42, SPLIT_KEYS)
        parts.append(sorted(tuple(r) for r in train.collect()))
        assert 370 < test.filter("v = -1").count() < 430
    assert parts[0] == parts[1] == parts[2]


def test_numbered_copies_in_several_runs(spark, monkeypatch):
    import ratewave.operators.sampling as sampling

    monkeypatch.setattr(sampling, "COPIES_AT_ONCE", 7)
    df = spark.createDataFrame([(1, None)] * 30 + [(2, "b")], "a int, b string")
    rows = numbered_copies(df).collect()
    assert sorted(r._copy for r in rows if r.a == 1) == list(range(1, 31)) and len(rows) == 31


def test_any_number_of_key_columns(spark):
    df = spark.range(0, 4000).select(*[(F.col("id") * (i + 3) % 101).alias(f"c{i}") for i in range(9)])
    u = modular_unit_hash([f"c{i}" for i in range(9)], 3)
    train, test = hash_split(df, [0.5, 0.5], 3, unit=u)
    assert 1200 < train.count() < 2800 and train.count() + test.count() == 4000


def test_sample_refines_a_crowded_cut(spark):
    df = spark.range(0, 30000).withColumnRenamed("id", "k")
    want = sorted(r.k for r in sample_n(df, 9000, 7, ["k"]).collect())
    got = sorted(r.k for r in sample_n(df.repartition(5), 9000, 7, ["k"], cut_rows=5).collect())
    assert len(got) == 9000 and got == want


def test_sample_exact_with_a_hot_group_of_copies(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v")
    )
    for n in (10, 500, 4000):
        assert sample_n(df, n, 3, ["v"]).count() == n


def test_modular_hash_in_unit_interval_and_portable_sample_exact(spark):
    from pyspark.sql import functions as F

    from ratewave.operators.sampling import modular_unit_hash

    df = spark.range(0, 5000).select(
        (F.col("id") * 3_000_000_017).alias("a"), (F.col("id") % 97).alias("b")
    )
    u = modular_unit_hash(["a", "b"], 7)
    lo, hi = df.agg(F.min(u), F.max(u)).first()
    assert 0.0 <= lo and hi < 1.0
    s1 = sorted(r.a for r in sample_n(df, 300, 7, ["a", "b"], unit=u).collect())
    s2 = sorted(r.a for r in sample_n(df.repartition(4), 300, 7, ["a", "b"], unit=u).collect())
    assert len(s1) == 300 and s1 == s2


def test_null_keys_never_dropped_with_custom_unit(spark):
    from pyspark.sql import functions as F

    from ratewave.operators.sampling import modular_unit_hash

    df = spark.range(0, 1000).select(F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"))
    u = modular_unit_hash(["k"], 5)
    parts = hash_split(df, [0.5, 0.5], 5, ["k"], unit=u)
    assert sum(p.count() for p in parts) == 1000
    s = sample_n(df, 50, 5, ["k"], unit=u).collect()
    assert len(s) == 50 and all(r.k is not None for r in s)  # NULL-key rows sort last
