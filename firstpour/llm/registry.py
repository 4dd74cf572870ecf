"""The queries of this package, each over its whole table, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstpour import storage
from firstpour.llm import align, bpe, decontaminate, extract, fim, langid, minhash, pii, ppm, quality, simhash, toxicity, unigram
from firstpour.llm.tasks import remainder


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ppm.scored(_documents(spark, sf_dir), remainder("doc_id", 5) != 1)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = extract.extract(pages, extract.learn(pages), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    rules = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judged(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang", (remainder("doc_id", 3) == 1).alias("held_out"))
    ranks = langid.learn(docs.where("not held_out"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), ranks, keep=["doc_id", "held_out"])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.overlaps(_documents(spark, sf_dir).select("doc_id", "text"), benchmark, keep=["doc_id"])
    return found.select("doc_id", F.explode("overlaps").alias("o")).groupBy("doc_id", "o.item_id").agg(
        F.max("o.n_equal").cast("long").alias("n_equal"), F.max("o.n_tokens").cast("long").alias("n_tokens")
    )


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return unigram.token_counts(docs, unigram.public(), keep=["doc_id"])


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find(docs, pii.learn(docs), keep=["doc_id"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.fixed)
    number = lambda kind: F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[number(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", (remainder("doc_id", 4) == 2).alias("held_out"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder("doc_id", 4) != 2)
    scorer = toxicity.learn(docs.where("not held_out"), labels)
    found = toxicity.score(docs, scorer, keep=["doc_id", "held_out"])
    return found.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir), words=3, percent=85)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    coded = bpe.encode(docs, bpe.public(), decoded="decoded", keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), words=3, differ=3)


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair, folder = align.public(), storage.scratch(spark, "align")
    found = align.aligned(_documents(spark, sf_dir), pair, folder=folder)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    found = found.select("id", "key", "n_a", "n_b", "n_groups", "n_links", "pairs", "times", digest)
    return align.scored(align.saved(found, folder, "found"), pair.size_b, folder).withColumnRenamed("id", "doc_id")


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(_documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"])
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {q.__name__: q for q in (op1_ppm, op2_extract, op3_quality, op4_langid, op5_decontaminate, op6_tokens, op7_pii, op8_toxicity, op9_minhash, op10_bpe, op11_simhash, op12_align, op13_fim)}
SQL: dict[str, str] = {
    "op13_fim": """
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents),
        cut AS (
            SELECT *, CAST('0x' || substr(h, 17, 8) AS UBIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 AS h4,
                   CAST(least(CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (n + 1), CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (n + 1)) AS BIGINT) AS a,
                   CAST(greatest(CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (n + 1), CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (n + 1)) AS BIGINT) AS b
            FROM drawn),
        formed AS (
            SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                           WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
                   substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix
            FROM cut)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM formed
    """,
}
