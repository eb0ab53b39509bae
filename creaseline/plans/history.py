"""Slowly changing dimensions as a stored table that snapshots are merged into, in whatever order they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.operators.control import one_each
from creaseline.plans.build import put
from creaseline.sinks import tables


def first_history(observed: DataFrame, key: str) -> DataFrame:
    """Versions out of observations (key, at, v): consecutive ones with equal values are one version, which keeps its `seen` snapshots."""
    return versions_of(observed.select(key, F.col("at").alias("from"), F.array("at").alias("seen"), "v"), key)


def versions_of(runs: DataFrame, key: str) -> DataFrame:
    """Versions out of runs (key, from, seen, v) that do not overlap: neighbours with equal values become one."""
    line = W.partitionBy(key).orderBy("from")
    starts = F.when(F.row_number().over(line) == 1, 1).otherwise(F.when(F.col("v").eqNullSafe(F.lag("v").over(line)), 0).otherwise(1))
    numbered = runs.withColumn("__starts", starts).withColumn("__version", F.sum("__starts").over(line.rowsBetween(W.unboundedPreceding, 0)))
    merged = numbered.groupBy(key, "__version").agg(F.min("from").alias("valid_from"), F.array_sort(F.flatten(F.collect_list("seen"))).alias("seen"), F.min_by("v", "from").alias("v"))
    ahead = F.lead("valid_from").over(W.partitionBy(key).orderBy("valid_from"))
    return merged.select(key, "v.*", "valid_from", ahead.alias("valid_to"), ahead.isNull().alias("is_current"), "seen")


def with_snapshots(stored: DataFrame, observed: DataFrame, key: str, tracked: tuple[str, ...]) -> DataFrame:
    """The versions of the observed keys after new observations (key, at, v).

    A version that no new observation falls into stays whole, so a snapshot in its order touches current versions only. One that
    is hit is taken apart into its snapshots: a late observation may split it. An observation of a known snapshot replaces the old one.
    """
    hits = observed.groupBy(F.col(key).alias("__key")).agg(F.collect_list("at").alias("__at"))
    old = stored.join(hits, F.col(key).eqNullSafe(F.col("__key"))).withColumn("v", F.struct(*tracked))
    hit = F.exists("__at", lambda t: (t >= F.array_min("seen")) & (t <= F.array_max("seen")))
    apart = F.transform(F.array_except("seen", "__at"), lambda t: F.struct(t.alias("from"), F.array(t).alias("seen")))
    whole = F.array(F.struct(F.col("valid_from").alias("from"), F.col("seen").alias("seen")))
    runs = old.select(key, "v", F.explode(F.when(hit, apart).otherwise(whole)).alias("r")).select(key, "r.from", "r.seen", "v")
    return versions_of(runs.unionByName(observed.select(key, F.col("at").alias("from"), F.array("at").alias("seen"), "v")), key)


def merge_snapshot(rows: DataFrame, path: str, key: str, snapshot: str, *tracked: str) -> int:
    """Merge rows of one snapshot or several into the history at path; returns the versions written.

    Whatever the order of arrival, the table is what control.scd2 makes of all rows. Only the buckets of the keys that rows hold are
    read and written. A repeated delivery of a snapshot replaces its earlier values; of rows that tie within one the largest values count.
    """
    spark, observed = rows.sparkSession, one_each(rows, key, snapshot, tracked)
    if not tables.keyed_exists(spark, path):
        return put(first_history(observed, key), path, [key], None)
    stored = tables.for_key_buckets(spark, path, [key], observed.select(key).distinct())
    return put(with_snapshots(stored, observed, key, tracked), path, [key], None)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Validity intervals: key, tracked columns, valid_from, valid_to, is_current."""
    return tables.read_keyed(spark, path).drop("seen")


def as_of(spark: SparkSession, path: str, moment) -> DataFrame:
    """The versions that were valid at a moment."""
    when = F.lit(moment)
    return history(spark, path).where((F.col("valid_from") <= when) & (F.col("valid_to").isNull() | (F.col("valid_to") > when)))
