"""A corpus from documents to token ids: language, near duplicates, benchmark passages, personal data, BPE.

Each stage works on all that its predecessor kept and returns the columns of ``documents``, the last
one the tokens. Between stages the rows are written to the shared folder and read again.

Null and empty texts, and texts without a letter, have no language and go in the first stage. Of rows
with one id, one stays if its text is that of its group's smallest id; rows without an id all stay.
Other columns of the documents pass through all stages but the last. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstpour import storage
from firstpour.llm import bpe, decontaminate, langid, minhash, pii


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language, by the profiles of the documents' own languages."""
    return langid.identified(docs, langid.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group."""
    return minhash.deduplicate(docs, words=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; the number of characters follows."""
    out = pii.redact(docs, pii.learn(docs))
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the text they decode to."""
    coded = bpe.encode(docs.select("doc_id", "text"), bpe.public(), decoded="decoded", keep=["doc_id"])
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: SQL cannot express these stages; the tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs
