"""Every operator on odd rows: NULLs, empty and long texts, ties, repeated rows, clashing columns, no rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratewave.llm.bpe import encode_documents
from ratewave.llm.fingerprint import compare_neighbours, fingerprint_documents, group_sketches
from ratewave.llm.language_model import language_model_scores
from ratewave.llm.mixing import mix_sources, mixed_documents
from ratewave.llm.neardup import near_duplicates, one_of_each
from ratewave.llm.queries import vocabulary
from ratewave.llm.secrets import redact_secrets, scan_secrets
from ratewave.llm.substring import remove_repeats
from ratewave.llm.token_count import count_tokens
from ratewave.llm.topk import exact_topk
from ratewave.llm.toxicity import score_documents, toxicity, train

LONG = " ".join(f"w{i % 701} x{i}" for i in range(20_000))
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \n\t ", None, None),
    (4, LONG, "en", "b"),
    (5, "the same text of more than five words here", "de", "b"),
    (5, "the same text of more than five words here", "de", "b"),
    (6, "the same text of more than five words here", "de", None),
    (None, "a row without an id but with some words", "en", "c"),
    (7, 'token = "0123456789abcdef0123456789abcdef" é漢 <|endoftext|>', "fr", "c"),
    (8, "x" * 3000, "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "size taken key rep comp tie found spans n s1 s2 bands y part edge k word c score copies anchor place".split()


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], SCHEMA)
    for c in CLASHING:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 0), (5, 1), (None, 1), (6, None), (99, 0)], "doc_id long, toxic int")


OPERATORS = {
    "mix": lambda d, y: mix_sources(d),
    "encode": lambda d, y: encode_documents(d, vocabulary()),
    "neardup": lambda d, y: near_duplicates(d),
    "substring": lambda d, y: remove_repeats(d),
    "count": lambda d, y: count_tokens(d, vocabulary()),
    "toxicity": lambda d, y: toxicity(d, y),
    "secrets": lambda d, y: scan_secrets(d),
    "lm": lambda d, y: language_model_scores(d),
    "neighbours": lambda d, y: compare_neighbours(d),
    "fingerprint": lambda d, y: fingerprint_documents(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_odd_row(odd, labels, name):
    got = OPERATORS[name](odd, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows_for_an_empty_table(none, labels, name):
    assert OPERATORS[name](none, labels).collect() == []


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, r)
    return out


def test_mix_of_odd_rows(odd):
    got = by_id(mix_sources(odd))
    assert got[1].size == got[2].size == got[3].size == 0 and got[1].taken == 0
    assert got[1].target == 0.0  # a source without words
    assert all(0 <= r.taken <= 2 * r.size for r in got.values())
    mixed = mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert not {r.doc_id for r in mixed.collect()} & {1, 2, 3}  # no words, no place in the mix


def test_neardup_of_odd_rows(odd):
    got = by_id(near_duplicates(odd))
    assert [got[i].component_id for i in (1, 2, 3)] == [1, 2, 3] and got[1].n_shingles == 0
    assert got[6].component_id == 5 and not got[6].kept and got[5].kept
    assert got[None].component_id is None and got[None].kept
    assert got[8].n_shingles == 1  # fewer than five words are one shingle
    kept = one_of_each(odd).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "2", "3", "4", "5", "7", "8", "None"])
    assert kept[0].asDict().keys() == set(odd.columns)


def test_neighbours_of_odd_rows(odd, spark):
    got = by_id(compare_neighbours(odd))
    assert got[1].n_chars == 0 and got[1].fingerprint == "" and got[2].near_edited == 1.0
    one = compare_neighbours(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.n_chars == 4


def test_language_model_of_odd_rows(odd):
    got = by_id(language_model_scores(odd))
    assert got[1].n_tokens == got[2].n_tokens == got[3].n_tokens == 1  # the end
    assert all(r.score < 0 for r in got.values())
    assert got[1].score == pytest.approx(got[2].score)


def test_language_model_without_training_rows(spark):
    # crc32("12") mod 7 is 2, so the only row is held out
    rows = [(i, "some words") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").where("crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")
    got = language_model_scores(df).collect()
    assert got and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in got)


def test_toxicity_without_labels(odd, spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity(odd, empty).collect()} == {0.0}
    model = train(odd, spark.createDataFrame([(4, 0), (6, 0)], "doc_id long, toxic int"), F.lit(True))
    assert {r.score for r in score_documents(odd, model).collect()} == {0.0}


def test_substring_of_odd_rows(odd, spark):
    got = by_id(remove_repeats(odd))
    assert got[1].n_words == got[3].n_words == 0 and got[1].kept == ""
    text = " ".join(f"a{i}" for i in range(40))
    twice = spark.createDataFrame([(1, text), (1, text), (None, "z " + text)], "doc_id long, text string")
    assert [r.kept for r in remove_repeats(twice).orderBy("doc_id").collect()] == ["z", "", ""]


def test_redacted_rows_keep_their_columns(odd):
    out = redact_secrets(odd, length_col="n_chars")
    assert out.columns == odd.columns
    got = by_id(out)
    assert got[7].text.startswith('token = "[SECRET]" é') and got[7].n_chars == len(got[7].text)
    assert got[1].text is None and got[5].text == ROWS[4][1]


def test_group_sketches_of_odd_rows(odd, none):
    got = {r.group: r.n_shingles for r in group_sketches(odd, "source").collect()}
    assert got["a"] == 0 and set(got) == {"a", "b", "c", None}
    assert group_sketches(none, "source").count() == 0


@pytest.mark.parametrize("rows", [0, 1])
def test_pipeline_stages_on_odd_rows(odd, none, labels, spark, tmp_dir, rows):
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    docs = (odd if rows else none).select(*SCHEMA.replace(" long", "").replace(" string", "").split(", "))
    for name, stage in corpus_pipeline.STAGES:
        docs.write.parquet(f"{tmp_dir}/{name}")
        out = stage(spark, spark.read.parquet(f"{tmp_dir}/{name}"), tmp_dir)
        if name != "bpe":
            assert out.dtypes == docs.dtypes
        docs = out
    assert (docs.count() > 0) == bool(rows)


def test_topk_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0]), (3, []), (4, None), (5, [None, 1.0]),
        (6, [nan, 1.0]), (7, [inf, 0.0]), (8, [-1.0, 0.25]), (8, [-1.0, 0.25]), (None, [1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in exact_topk(df, F.col("vec_id") % 100 == 0, k=4).orderBy("rank").collect()]
    own = 1024 * 1024 + 512 * 512
    assert got == [(0, 1, 1, own), (0, 2, 2, 1024 * 1024), (0, 3, 3, 0), (0, 4, 8, -1024 * 1024 + 512 * 256)]
    assert exact_topk(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
