"""The pipeline on a whole small table: each written stage against a brute-force version of it."""

import collections
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ratewave.llm.queries import QUERIES, vocabulary
from ratewave.llm.toxicity import toxicity
from test_oracles import brute_components, brute_secrets

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WEIGHTS = (5, 2, 1)


@pytest.fixture(scope="module")
def written(spark):
    """Stage -> rows, as run() wrote them; "documents" is the input, "bpe" the result."""
    stages = {"documents": corpus_pipeline.table(spark, SF, "documents")}
    write = corpus_pipeline.materialize

    def keep(df, name):
        assert df.columns == COLUMNS
        stages[name.removeprefix("pipeline_")] = write(df, name)
        return stages[name.removeprefix("pipeline_")]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "materialize", keep)
        stages["bpe"] = corpus_pipeline.run(spark, SF)
    assert list(stages) == ["documents", *(name for name, _ in corpus_pipeline.STAGES)]
    return {name: df.collect() for name, df in stages.items()}


def by_id(rows):
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_toxic_documents_go(spark, written):
    scored = toxicity(corpus_pipeline.table(spark, SF, "documents"), corpus_pipeline.table(spark, SF, "labels")).collect()
    rejected = {r.doc_id for r in scored if r.rejected}
    before, after = by_id(written["documents"]), by_id(written["toxicity"])
    assert rejected and set(after) == set(before) - rejected
    assert all(before[d] == r for d, r in after.items())


def test_what_the_toxicity_stage_rejects_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (corpus_pipeline.table(spark, sf, t) for t in ("documents", "labels"))
    kept = corpus_pipeline.toxicity(spark, docs, sf).select("doc_id", F.lit(True).alias("kept"))
    held = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    n = {(r.toxic, r.kept): r["count"] for r in held.join(docs, "doc_id", "left_semi").join(kept, "doc_id", "left").groupBy("toxic", "kept").count().collect()}
    caught, missed = n.get((1, None), 0), n.get((1, True), 0)
    wrong, right = n.get((0, None), 0), n.get((0, True), 0)
    print(f"held out: {caught} of {caught + missed} toxic rejected, {wrong} of {wrong + right} clean rejected")
    assert caught >= 0.85 * (caught + missed) > 0 and wrong <= 0.02 * (wrong + right)


def test_one_document_of_each_group_stays(written):
    before, after = by_id(written["toxicity"]), by_id(written["near_duplicates"])
    sets, comp = brute_components([(d, r.text) for d, r in before.items()])
    assert set(after) == {d for d in before if comp[d] == d}
    assert len(after) < len(before) and all(before[d] == r for d, r in after.items())


def test_secrets_are_masked_and_nothing_else(written):
    before, after = by_id(written["near_duplicates"]), by_id(written["secrets"])
    assert set(after) == set(before)
    found = 0
    for d, r in after.items():
        was = before[d]
        assert (r.lang, r.source) == (was.lang, was.source)
        secrets = brute_secrets(was.text)
        found += len(secrets)
        if r.text == was.text:
            assert not secrets and r == was
            continue
        assert r.n_chars == len(r.text) and brute_secrets(r.text) == []
        assert re.fullmatch(".+?".join(map(re.escape, r.text.split("[SECRET]"))), was.text, re.S)
    assert found


def targets(sizes):
    """Source -> words: shares of 150 % of all by weight, none above twice its source's size."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order) if sizes[s]}
    left, out = 1.5 * sum(sizes.values()), {s: 0.0 for s in order}
    while weight:
        share = {s: left * w / sum(weight.values()) for s, w in weight.items()}
        full = [s for s in share if share[s] >= 2 * sizes[s]]
        if not full:
            return out | share
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            del weight[s]
    return out


def test_the_mix_comes_near_its_targets(written):
    before = by_id(written["secrets"])
    size = {d: len(WORD.findall(r.text or "")) for d, r in before.items()}
    sizes = collections.Counter()
    for d, r in before.items():
        sizes[r.source] += size[d]
    times = collections.Counter(r.doc_id for r in written["mix"])
    assert all(before[r.doc_id] == r for r in written["mix"]) and max(times.values()) <= 2
    taken = collections.Counter()
    for d, n in times.items():
        taken[before[d].source] += n * size[d]
    for source, want in targets(sizes).items():
        assert abs(taken[source] - want) <= 2 * max(size[d] for d, r in before.items() if r.source == source)


def test_ids_of_every_document_of_the_mix(written):
    library, ids = Tokenizer.from_file(vocabulary()), {}
    for r in written["mix"]:
        ids[r.doc_id] = library.encode(r.text or "", add_special_tokens=False).ids
    assert collections.Counter(r.doc_id for r in written["bpe"]) == collections.Counter(r.doc_id for r in written["mix"])
    for r in written["bpe"]:
        assert list(r.ids) == ids[r.doc_id] and r.n_tokens == len(ids[r.doc_id])


SHINGLES = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(w[i : i + least(len(w), 5) - 1], 'string_agg', ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0))
SELECT d.doc_id, count(x) AS n_shingles FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
"""


def test_set_sizes_of_near_duplicates_in_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = QUERIES["op4_near_duplicates"](spark, SF).select("doc_id", "n_shingles").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(SHINGLES).fetchall())
