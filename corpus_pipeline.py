"""The training-corpus pipeline over `documents`: each stage reads what its predecessor wrote.

toxicity: documents that the classifier rejects go. near_dedup: of each class of near-duplicates the document with the
smallest doc_id stays (null after all others; of several texts with that id the one with the smallest key).
decontaminate: documents that contain a benchmark item go. secrets: every reported span is replaced by a placeholder
and n_chars follows. tokenize: the token ids of what is left, with their digest and that of the decoded text.

Rows with equal doc_id (null too) and equal text are one document, and near_dedup leaves one of them. Rows that share a
doc_id, or have none, but differ in text are decided upon one by one. The key of a document is 64 bits of hash of both:
two of n documents share one with a probability below n*n / 2^65.

Every stage takes null ids and texts, empty and very long texts, repeated rows and empty tables, and keeps columns that
it does not know; tokenize alone replaces columns that are named like its results. A null text is an empty one: it is
scored as such, is no copy, holds no item and no secret, and has no ids.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.llm import dart_minhash, decontamination, secret_scan, sentencepiece_codec, toxicity
from creaseline.llm.blocks import cut, row_key, shared_folder, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.score(docs, model, score_col="__score", predicted_col="__toxic", keep_text=True)
    return scored.where("__toxic = 0").select(*columns(docs))


def columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def keyed(docs: DataFrame) -> DataFrame:
    """docs with __key, equal for equal (doc_id, text) and computed anew from them wherever it is needed."""
    return docs.withColumn("__key", row_key("doc_id", "text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decisions are made on keys; the text is met once by the operator and once here, where the keys that go are joined."""
    found = cut(dart_minhash.classes(docs.select("doc_id", "text")).withColumnRenamed("row_key", "__key"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__key")
    first = found.where("label is not null").groupBy("label").agg(F.min(order).alias("first")).select("label", F.col("first.__key").alias("stays"))
    copies = found.join(first, "label").where("__key <> stays").select("__key").distinct()
    repeated = found.groupBy("__key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__key")
    gone = cut(copies.withColumn("copy", F.lit(True)).unionByName(repeated.withColumn("copy", F.lit(False))).groupBy("__key").agg(F.max("copy").alias("copy")))
    rows = keyed(docs)
    kept = rows.join(gone, "__key", "left_anti").select(*columns(docs))
    several = cut(gone.where("not copy").select("__key"))  # of repeated rows that stay, one is left
    if several.isEmpty():
        return kept
    whole = F.struct(*columns(docs))  # compared as text: maps have no order
    merged = rows.join(several, "__key").groupBy("__key").agg(F.min_by(whole, F.to_json(whole)).alias("row"))
    return kept.unionByName(merged.select("row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = keyed(docs)
    leaks = decontamination.contaminated(rows, table(spark, sf_dir, "benchmark"), id_col="__key").select(F.col("doc_id").alias("__key")).distinct()
    return rows.join(written(leaks), "__key", "left_anti").select(*columns(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else clean


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What training reads: all columns but the text, its token ids, and the digests of ids and decoded text."""
    return sentencepiece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True, with_decoded=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", redact_secrets),
    ("tokenize", tokenize),
]
#: The classifier, the shingle similarities and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each written as Parquet to the shared folder and read again.

    Two places take turns, so a stage's output is replaced when its successor's has been written.
    """
    folder = (shared_folder(spark) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    docs = table(spark, sf_dir, "documents")
    at = f"{folder}/corpus_pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        place = f"{at}/{number % 2}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(place)
        docs = spark.read.parquet(place)
    return docs
