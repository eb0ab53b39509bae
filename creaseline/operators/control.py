"""Control state as DataFrames: the file audit with its stage stamps, load logs, drift and change logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.functions.metrics import rounded
from creaseline.sinks.tables import overwrite_partitions

AUDIT_KEY = ["file_name", "content_hash"]
ANOMALY_PCT = 5.0
LEAST_ROWS = 5000
MESSAGE = 2000


def land(audit: DataFrame, landed: DataFrame) -> DataFrame:
    """The audit with one row for each file revision that it did not know."""
    new = landed.dropDuplicates(AUDIT_KEY).join(audit.select(*AUDIT_KEY), AUDIT_KEY, "left_anti")
    return audit.unionByName(new, allowMissingColumns=True)


def stamp_bronze(audit: DataFrame, loaded: DataFrame, value: Column) -> DataFrame:
    """bronze_loaded_at and the revision of file revisions that reached Bronze (loaded: AUDIT_KEY, revision)."""
    return stamp(audit, loaded, AUDIT_KEY, "bronze_loaded_at", value, revision="revision")


def stamp_archive(audit: DataFrame, moved: DataFrame) -> DataFrame:
    """Where archived files lie now (moved: AUDIT_KEY, archive_path)."""
    return stamp(audit, moved.withColumnRenamed("archive_path", "__to"), AUDIT_KEY, "archive_path", F.col("__archive_path"), archive_path="__to")


def stamp(audit: DataFrame, keys: DataFrame, on: list[str], column: str, value: Column, only_empty: bool = False, **more: str) -> DataFrame:
    """Set column (and copy `more` columns from keys) on the rows whose key is given."""
    marks = keys.dropDuplicates(on).select(*on, *[F.col(src).alias(f"__{dst}") for dst, src in more.items()], F.lit(True).alias("__hit"))
    joined = audit.join(marks, on, "left")
    hit = F.coalesce("__hit", F.lit(False)) & (F.col(column).isNull() if only_empty else F.lit(True))
    out = joined.withColumn("__do", hit).withColumn(column, F.when(F.col("__do"), value).otherwise(F.col(column)))
    for dst in more:
        out = out.withColumn(dst, F.when(F.col("__do"), F.col(f"__{dst}")).otherwise(F.col(dst)))
    return out.select(*audit.columns)


def pending_silver(audit: DataFrame) -> DataFrame:
    return audit.where("bronze_loaded_at is not null and silver_loaded_at is null").select("match_id").distinct()


def pending_gold(audit: DataFrame) -> DataFrame:
    return audit.where("silver_loaded_at is not null and gold_loaded_at is null").select("match_id").distinct()


def stamp_gold(audit: DataFrame, value: Column, ids: DataFrame | None = None) -> DataFrame:
    """Stamp the given matches, or every row that Silver has loaded."""
    if ids is None:
        return audit.withColumn("gold_loaded_at", F.when(F.col("silver_loaded_at").isNotNull(), value).otherwise(F.col("gold_loaded_at")))
    return stamp(audit, ids, ["match_id"], "gold_loaded_at", value, only_empty=True)


def seed_from_bronze(bronze: DataFrame, inventory: DataFrame) -> DataFrame:
    """Audit rows for what Bronze holds already; Silver counts as done, Gold as open."""
    b = bronze.select("match_id", "revision", F.sha2("raw_json", 256).alias("content_hash"), F.col("_ingested_at").alias("bronze_loaded_at"))
    out = b.join(inventory.select("match_id", "file_name"), "match_id", "left")
    return out.select(F.coalesce("file_name", F.concat("match_id", F.lit(".json"))).alias("file_name"), "content_hash", "match_id", "revision", "bronze_loaded_at", F.col("bronze_loaded_at").alias("silver_loaded_at"), F.lit(None).cast("timestamp").alias("gold_loaded_at"))


CATALOG_DDL = "table_name string, snapshot int, column_name string, column_type string"


def catalog_of(tables: dict[str, DataFrame], snapshot: int) -> list[tuple[str, int, str, str]]:
    return [(t, snapshot, c, kind) for t, df in tables.items() for c, kind in df.dtypes]


def append_catalog(spark: SparkSession, path: str, tables: dict[str, DataFrame], snapshot: int) -> None:
    """The columns of each table as rows of a catalogue table, by snapshot; a second run replaces its own snapshot."""
    overwrite_partitions(spark.createDataFrame(catalog_of(tables, snapshot), CATALOG_DDL), path, ["snapshot"])


def column_drift(catalog: DataFrame) -> DataFrame:
    """New and removed columns of each table between a snapshot and the one before, with a hash of the sorted names."""
    names = catalog.groupBy("table_name", "snapshot").agg(F.sort_array(F.collect_set("column_name")).alias("names"))
    before = F.lag("names").over(W.partitionBy("table_name").orderBy("snapshot"))
    out = names.withColumn("before", before)
    added = F.when(F.col("before").isNull(), F.array().cast("array<string>")).otherwise(F.array_except("names", "before"))
    removed = F.coalesce(F.array_except("before", "names"), F.array().cast("array<string>"))
    out = out.withColumns({"added": added, "removed": removed, "names_hash": F.sha2(F.array_join("names", ","), 256)})
    return out.withColumn("changed", (F.size("added") + F.size("removed")) > 0).drop("names", "before")


def schema_drift(catalog: DataFrame) -> DataFrame:
    """INITIAL, NO_CHANGE, ADD, DROP or TYPE_CHANGE of each table and snapshot; mixed changes count as ADD."""
    kinds = catalog.groupBy("table_name", "snapshot").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("column_name", "column_type")))).alias("m"))
    out = kinds.withColumn("b", F.lag("m").over(W.partitionBy("table_name").orderBy("snapshot")))
    added, dropped = F.size(F.array_except(F.map_keys("m"), F.map_keys("b"))), F.size(F.array_except(F.map_keys("b"), F.map_keys("m")))
    retyped = F.size(F.filter(F.array_intersect(F.map_keys("m"), F.map_keys("b")), lambda c: F.try_element_at("m", c) != F.try_element_at("b", c)))
    out = out.select("table_name", "snapshot", F.col("b").isNull().alias("first"), added.alias("a"), dropped.alias("d"), retyped.alias("t"))
    change = F.when(F.col("first"), "INITIAL").when(F.col("a") > 0, "ADD").when((F.col("d") > 0) & (F.col("t") > 0), "ADD").when(F.col("d") > 0, "DROP").when(F.col("t") > 0, "TYPE_CHANGE").otherwise("NO_CHANGE")
    return out.select("table_name", "snapshot", change.alias("change"))


def row_count_log(counts: DataFrame, series: str = "table_name", order: str = "snapshot", n: str = "n_rows") -> DataFrame:
    """Delta and percent against the snapshot before; an anomaly beyond ANOMALY_PCT."""
    before = F.lag(n).over(W.partitionBy(series).orderBy(order))
    out = counts.withColumn("before", before).withColumn("delta", F.col(n) - F.col("before"))
    share = rounded(F.col("delta").cast("double") * 100 / F.when(F.col("before") != 0, F.col("before").cast("double")), 4)
    return out.withColumn("delta_pct", share).withColumn("anomaly", F.coalesce(F.abs("delta_pct") > ANOMALY_PCT, F.lit(False)))


def enough_rows(df: DataFrame, least: int = LEAST_ROWS) -> None:
    n = df.limit(least).count()
    if n < least:
        raise ValueError(f"{n} rows; at least {least} are expected")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, hash_col: str) -> DataFrame:
    """new, removed or changed keys between two snapshots."""
    a, b = old.select(key, F.col(hash_col).alias("h1")), new.select(key, F.col(hash_col).alias("h2"))
    out = a.join(b, key, "full")
    change = F.when(F.col("h1").isNull(), "new").when(F.col("h2").isNull(), "removed").when(F.col("h1") != F.col("h2"), "changed")
    return out.withColumn("change", change).where("change is not null").select(key, "change")


def latest_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def failures(results: DataFrame) -> DataFrame:
    return results.where("status = 'FAILED'").orderBy("check_id", "table_name")


def latest_archives(log: DataFrame) -> DataFrame:
    return log.groupBy("archive").agg(F.max("loaded_at").alias("loaded_at"), F.sum("n_files").alias("n_files"))


LOG_DDL = "run_id string, snapshot_date date, status string, at timestamp, attempted long, succeeded long, failed long, rows_written long, message string"


def log_started(runs: DataFrame) -> DataFrame:
    """RUNNING rows of a load log for runs (run_id, snapshot_date, at)."""
    return log_rows(runs, "RUNNING")


def log_rows(runs: DataFrame, status: str, message: Column | None = None) -> DataFrame:
    """Log rows for runs; counts that runs lack are null, and a message is cut to MESSAGE characters."""
    text = F.substring((F.lit(None) if message is None else message).cast("string"), 1, MESSAGE)
    out = runs.withColumns({"status": F.lit(status), "message": text})
    counts = ("attempted", "succeeded", "failed", "rows_written")
    return out.select("run_id", "snapshot_date", "status", "at", *[F.col(c).cast("long").alias(c) if c in runs.columns else F.lit(None).cast("long").alias(c) for c in counts], "message")


def latest_log(log: DataFrame) -> DataFrame:
    """The last state of each run, with its duration: log rows are appended, never changed."""
    started = log.where("status = 'RUNNING'").groupBy("run_id").agg(F.min("at").alias("started_at"))
    rank = F.when(F.col("status") == "RUNNING", 0).otherwise(1)
    last = latest_by(log, ["run_id"], rank.desc(), F.col("at").desc(), F.col("status"))
    seconds = (F.unix_seconds("at") - F.unix_seconds("started_at")).cast("long")
    return last.join(started, "run_id", "left").withColumn("duration_seconds", F.when(F.col("status") != "RUNNING", seconds))


def landed_counts(log: DataFrame, snapshot_date: Column, series: str = "source_file", n: str = "row_count", order: str = "id") -> DataFrame:
    """The row count that the last successful load of each file reported for that snapshot."""
    done = log.where((F.col("snapshot_date") == snapshot_date) & (F.col("status") == "SUCCESS") & F.col(n).isNotNull())
    return latest_by(done, [series], F.col(order).desc()).select(series, n)


def daily_runs(log: DataFrame) -> DataFrame:
    """Runs, failures and seconds a day: the operations mart."""
    return log.groupBy(F.to_date("started_at").alias("day")).agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "FAILED").alias("failed"), rounded(F.sum("seconds")).alias("seconds"))


def top_tasks(log: DataFrame, n: int = 10) -> DataFrame:
    """The tasks that took longest in all, with their share."""
    by_task = log.groupBy("task").agg(F.count(F.lit(1)).alias("runs"), F.sum("seconds").alias("s"))
    out = by_task.crossJoin(by_task.agg(F.sum("s").alias("whole")))  # one row
    share = rounded(F.col("s") * 100 / F.when(F.col("whole") != 0, F.col("whole")))
    return out.select("task", "runs", rounded(F.col("s")).alias("seconds"), share.alias("pct")).orderBy(F.col("seconds").desc(), "task").limit(n)


def data_freshness(log: DataFrame, today: Column) -> DataFrame:
    """Days since the last successful run of each task."""
    done = log.where("status = 'SUCCESS'").groupBy("task").agg(F.max(F.to_date("started_at")).alias("last_success"))
    return done.withColumn("days_old", F.date_diff(today, "last_success").cast("long"))


def one_each(rows: DataFrame, key: str, snapshot: str, tracked: tuple[str, ...]) -> DataFrame:
    """(key, at, v): the values of each key in each snapshot; of rows that tie the largest count, nulls being smallest."""
    return rows.groupBy(key, F.col(snapshot).alias("at")).agg(F.max(F.struct(*tracked)).alias("v"))


def scd2(rows: DataFrame, key: str, snapshot: str, *tracked: str) -> DataFrame:
    """Validity intervals of each key: consecutive snapshots with equal tracked values are one version."""
    order = W.partitionBy(key).orderBy("at")
    same = F.col("v").eqNullSafe(F.lag("v").over(order))
    starts = one_each(rows, key, snapshot, tracked).withColumn("__start", (F.row_number().over(order) == 1) | ~same).where("__start")
    ahead = F.lead("at").over(order)
    return starts.select(key, "v.*", F.col("at").alias("valid_from"), ahead.alias("valid_to"), ahead.isNull().alias("is_current"))
