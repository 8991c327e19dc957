"""A training-data pipeline over ``documents``: five stages, each over all that the one before kept.

1. toxicity: documents that the classifier rejects go.
2. near_duplicates: one document of each group of near copies stays.
3. secrets: found secrets are replaced by a mark; every document stays.
4. mix: documents are taken as often as the mix of their sources takes them.
5. bpe: token ids of every document, and a digest of their decoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read
again as the next one's input.  A lost executor costs the running stage's tasks.

The stages that run Python bound the Arrow batches of their session by ARROW_BYTES: a batch of
texts stands in the JVM and in the Python worker of every running task, and workers stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewave.llm.bpe import encode_documents
from ratewave.llm.common import crc_of, materialize, table
from ratewave.llm.mixing import mixed_documents
from ratewave.llm.neardup import one_of_each
from ratewave.llm.queries import vocabulary
from ratewave.llm.secrets import redact_secrets
from ratewave.llm.toxicity import drop_rejected, train

#: Bytes of an Arrow batch; one longer text goes alone.
ARROW_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labels, but for those whose crc32(doc_id) mod 5 is 0."""
    small_batches(spark)
    model = train(docs, table(spark, sf_dir, "labels"), crc_of(F.col("doc_id"), 5) != 0)
    return drop_rejected(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs, length_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = encode_documents(docs, vocabulary())
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("bpe", bpe),
]

#: A trained classifier can't be stated in SQL; tests/llm/test_pipeline.py checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline_{name}")
    return docs
