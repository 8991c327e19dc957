"""One registered query per operator, over its whole table, and the SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewave.llm.bpe import encode_digests
from ratewave.llm.common import table
from ratewave.llm.conversations import damage, repair_conversations
from ratewave.llm.cross_tokens import align_documents, corpus_links
from ratewave.llm.fingerprint import compare_neighbours
from ratewave.llm.language_model import language_model_scores
from ratewave.llm.mixing import mix_sources
from ratewave.llm.neardup import near_duplicates
from ratewave.llm.quality import quality
from ratewave.llm.secrets import joined, scan_secrets
from ratewave.llm.substring import remove_repeats
from ratewave.llm.token_count import count_tokens
from ratewave.llm.topk import exact_topk
from ratewave.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


ORACLES["op1_mix_sources"] = r"""
WITH r AS (
  SELECT doc_id, coalesce('s' || source, 'z') AS skey,
         md5('mix-42:' || coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(md5(text), '-')) AS name,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
d AS (
  SELECT doc_id, skey, size, md5(name || ':' || row_number() OVER (PARTITION BY skey, name)) AS key FROM r),
s AS (SELECT skey, sum(size)::BIGINT AS source_size FROM d GROUP BY skey),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY skey) - 1) % 3) + 1] AS weight,
             source_size * 2 AS ceiling FROM s),
v AS (
  SELECT *,
    (sum(source_size) OVER ()::BIGINT * 1.5::DOUBLE
      - coalesce(sum(ceiling) OVER f, 0)::BIGINT)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0))::BIGINT AS level
  FROM w
  WINDOW f AS (ORDER BY ceiling / weight::DOUBLE, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT skey, source_size, least(ceiling::DOUBLE, max(level) OVER () * weight) AS target FROM v),
q AS (
  SELECT d.skey, d.key, d.size, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.skey ORDER BY d.key ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM d JOIN t ON d.skey = t.skey WHERE d.size > 0),
p AS (SELECT skey, key, size, pass, (pass * source_size + upto) / target AS finish FROM q, (VALUES (0), (1)) e(pass)),
c AS (SELECT *, sum(size) OVER (ORDER BY finish, key, pass ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM p),
k AS (
  SELECT skey, pass, max(key) AS cut FROM c
  WHERE running <= (SELECT sum(source_size) FROM s) * 1.5::DOUBLE GROUP BY skey, pass)
SELECT d.doc_id, d.size, t.source_size, t.target,
       d.size * (coalesce(d.key <= k0.cut, false)::BIGINT + coalesce(d.key <= k1.cut, false)::BIGINT) AS taken
FROM d JOIN t ON d.skey = t.skey
LEFT JOIN k k0 ON k0.skey = d.skey AND k0.pass = 0
LEFT JOIN k k1 ON k1.skey = d.skey AND k1.pass = 1
"""


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), vocabulary())


@query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op3_exact_topk"] = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT r, vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM e),
bad AS (SELECT DISTINCT r FROM u WHERE x IS NULL OR NOT isfinite(x)),
w AS (SELECT r, vec_id, dim, floor(1024 * x)::BIGINT AS v FROM u WHERE r NOT IN (SELECT r FROM bad)),
s AS (
  SELECT a.vec_id AS query_id, b.r, b.vec_id, sum(a.v * b.v)::BIGINT AS score
  FROM w a JOIN w b ON a.dim = b.dim
  WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.r, b.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM k WHERE rank <= 10
"""


@query
def op6_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary())


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(table(spark, sf_dir, "documents"))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "extra"))).alias("spans"),
    )


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op4_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS b FROM d),
s AS (SELECT DISTINCT doc_id, array_to_string(w[b:b + 4], ' ') AS shingle FROM i),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
linked AS (
  SELECT x, y FROM shared JOIN n m ON m.doc_id = x JOIN n o ON o.doc_id = y
  WHERE 100 * common >= 85 * (m.size + o.size - common)),
edge AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT r.doc_id, e.y FROM reach r JOIN edge e ON e.x = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.size, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


ORACLES["op5_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
i AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS b FROM d),
p AS (SELECT r, b, array_to_string(w[b:b + 34], ' ') AS words FROM i),
twice AS (SELECT r, b FROM p QUALIFY count(*) OVER (PARTITION BY words) > 1),
t AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
g AS (
  SELECT t.r, t.word, t.j,
         coalesce(max(twice.b) OVER (PARTITION BY t.r ORDER BY t.j) > t.j - 35, false) AS gone
  FROM t LEFT JOIN twice ON twice.r = t.r AND twice.b = t.j),
k AS (
  SELECT r, count(*) AS n_words, count_if(gone) AS n_removed,
         string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept
  FROM g GROUP BY r)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.r = d.r
"""


@query
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair_conversations(damage(table(spark, sf_dir, "conversations")), digest=True)
    return found.withColumnRenamed("repaired", "repaired_sha256")


@query
def op13_cross_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    aligned = align_documents(
        table(spark, sf_dir, "documents"), vocabulary(), public_tokenizers.path("piece_bpe_32k.model"), digest=True
    )
    return corpus_links(aligned).withColumnRenamed("groups", "groups_sha256")


@query
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
