"""Grain checks that cost what changed: digests of keys by bucket of a keyed table, kept and renewed only where a bucket has other files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.sinks import tables

DIGESTS = "stamp long, n_rows long, n_keys long, keys_digest long, rows_digest long, bucket int"


def stamps(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, stamp): what tells a bucket's files from those that it had before. Names of files only are read."""
    files = tables.with_void(spark, path).groupBy(F.col("__bucket").alias("bucket"), F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy("bucket").agg(F.sum(F.xxhash64("file", "n").cast("decimal(38,0)")).alias("s")).select("bucket", F.xxhash64("s").alias("stamp"))


def digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Of each bucket: its rows, its distinct keys (null being equal to null), and digests of keys and of whole rows that no order changes.

    Keys are counted first, so a key that repeats without end is one row of the shuffle for each task.
    """
    whole = [F.col(f"`{c}`") for c, kind in rows.dtypes if c not in ("__void", "__bucket") and not kind.startswith("map")]
    key, row = F.xxhash64(*columns), F.xxhash64(*whole).cast("decimal(38,0)")
    each = rows.where("not __void").groupBy("__bucket", *columns).agg(F.count(F.lit(1)).alias("__n"), F.sum(row).alias("__r"), F.max(key).alias("__k"))
    return each.groupBy(F.col("__bucket").alias("bucket")).agg(F.sum("__n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.bit_xor("__k").alias("keys_digest"), F.xxhash64(F.sum("__r")).alias("rows_digest"))


def refresh(spark: SparkSession, path: str, keys: list[str], columns: list[str], store: str) -> int:
    """Bring the digests at store to the table at path, which lies in buckets by keys; returns how many buckets were read.

    Rows of one grain key lie in one bucket only if the grain has the bucket's keys among its columns.
    """
    if not set(keys) <= set(columns):
        raise ValueError(f"the grain {columns} lacks {sorted(set(keys) - set(columns))}")
    now = stamps(spark, path)
    known = stored(spark, store)
    due = now if known is None else now.join(known.select("bucket", F.col("stamp").alias("was")), "bucket", "left").where(~F.col("stamp").eqNullSafe(F.col("was"))).drop("was")
    hit = {r["bucket"]: r["stamp"] for r in due.collect()}  # at most a row a bucket
    if not hit:
        return 0
    rows = tables.in_buckets(tables.with_void(spark, path), sorted(hit))
    marks = spark.createDataFrame(list(hit.items()), "bucket int, stamp long")
    fresh = marks.join(digests(rows, columns), "bucket", "left").na.fill(0)
    tables.overwrite_partitions(fresh.select("stamp", "n_rows", "n_keys", "keys_digest", "rows_digest", "bucket"), store, ["bucket"])
    return len(hit)


def stored(spark: SparkSession, store: str) -> DataFrame | None:
    try:
        return spark.read.schema(DIGESTS).parquet(store)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def surplus(spark: SparkSession, store: str) -> DataFrame:
    """failed (rows beyond one for each key) and total, out of the digests: what a full check counts."""
    return stored(spark, store).agg(F.coalesce(F.sum(F.col("n_rows") - F.col("n_keys")), F.lit(0)).cast("long").alias("failed"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total"))


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets whose rows differ between two states of digests: none after a re-run that changes nothing, whatever files it wrote."""
    a = before.select("bucket", F.col("rows_digest").alias("was"), F.col("n_rows").alias("had"))
    return after.join(a, "bucket", "full").where(~(F.col("rows_digest").eqNullSafe(F.col("was")) & F.col("n_rows").eqNullSafe(F.col("had")))).select("bucket")
