"""Readers of landing files and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def landing_json(spark: SparkSession, folder: str, glob: str = "*.json", name: str = r"([^/]+)$") -> DataFrame:
    """One row a file (names that start with _ are skipped): file_name, match_id, raw_json, content_hash, size.

    name: what of a path is the file's name.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    rows = files.withColumn("file_name", F.regexp_extract("path", name, 1)).where(~F.col("file_name").startswith("_"))
    return rows.select("file_name", F.regexp_replace("file_name", r"\.json$", "").alias("match_id"), F.decode("content", "UTF-8").alias("raw_json"), F.sha2("content", 256).alias("content_hash"), F.col("length").alias("size"))


def inventory(spark: SparkSession, folder: str, glob: str = "*.json", name: str = r"([^/]+)$") -> DataFrame:
    """The manifest; the scan's content is hashed where it is read and travels no further."""
    return landing_json(spark, folder, glob, name).select("file_name", "match_id", "size", "content_hash")


def register_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns strings, empty is null, ragged lines are cut; an empty file is an error."""
    df = spark.read.csv(path, header=True, inferSchema=False, nullValue="", mode="PERMISSIVE", enforceSchema=False)
    if df.isEmpty():
        raise ValueError(f"{path} holds no rows")
    return df


def seed_csv(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A seed file; its key may not repeat."""
    df = register_csv(spark, path)
    if not df.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"{key} repeats in {path}")
    return df


def ball_csv(spark: SparkSession, path: str, key: str = "match_id") -> DataFrame:
    """Ball-by-ball files, all columns strings, sorted by match (numerically) and, within one, by ball."""
    balls = spark.read.csv(path, header=True, inferSchema=False)
    number = lambda c: F.col(c).try_cast("long")
    return balls.orderBy(number(key), *[number(c) for c in ("innings_number", "over_number", "delivery_number") if c in balls.columns])


def read(df: DataFrame, columns: list[str] | None = None, where: str | Column | None = None) -> DataFrame:
    """Filter first, then project: both reach the scan."""
    out = df if where is None else df.where(where)
    return out if columns is None else out.select(*columns)


def since(df: DataFrame, watermark: str, value) -> DataFrame:
    return df.where(F.col(watermark) >= F.lit(value))


def between_versions(df: DataFrame, start, end, column: str = "_snapshot_date") -> DataFrame:
    """Start exclusive, end inclusive."""
    return df.where((F.col(column) > F.lit(start)) & (F.col(column) <= F.lit(end)))


def as_of(df: DataFrame, day, column: str = "_snapshot_date") -> DataFrame:
    return df.where(F.col(column) <= F.lit(day))


def latest_snapshot(df: DataFrame, column: str = "_snapshot_date") -> DataFrame:
    newest = df.agg(F.max(column).alias(column))
    return df.join(F.broadcast(newest), column)  # one row


def exact_snapshot(df: DataFrame, day, column: str = "_snapshot_date") -> DataFrame:
    return df.where(F.col(column) == F.lit(day))


def for_keys(df: DataFrame, ids: DataFrame, key: str = "match_id") -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def ready(df: DataFrame, day, column: str = "_snapshot_date") -> None:
    if as_of(df, day, column).isEmpty():
        raise ValueError(f"nothing is loaded up to {day}")


def staging_views(tables: dict[str, DataFrame], prefix: str = "stg_silver_") -> list[str]:
    """A view that passes through each table, as later models name them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in tables]


def sql(spark: SparkSession, tables: dict[str, DataFrame], query: str) -> DataFrame:
    """Run a query over named tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)


def info_wide(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Key/value rows (match_id, key, value, line) to one wide row a match; a repeated key gets suffix _1, _2, ..."""
    place = F.row_number().over(W.partitionBy("match_id", "key").orderBy("line")) - 1
    named = rows.withColumn("__k", F.when(place == 0, F.col("key")).otherwise(F.concat("key", F.lit("_"), place.cast("string"))))
    return named.groupBy("match_id").pivot("__k", keys).agg(F.first("value"))


#: New names, and the order of the columns of a cleaned match row.
INFO_NAMES = {"team": "team1", "team_1": "team2", "umpire": "umpire1", "umpire_1": "umpire2"}
INFO_COLUMNS = (
    "match_id", "season", "date", "city", "venue", "team1", "team2", "toss_winner", "toss_decision", "player_of_match", "winner", "winner_wickets", "winner_runs", "outcome", "result_type",
    "results", "gender", "event", "match_number", "umpire1", "umpire2", "reserve_umpire", "tv_umpire", "match_referee", "eliminator", "method", "date_1",
)


def info_clean(wide: DataFrame) -> DataFrame:
    """Renamed, typed and ordered; result type (the last rule wins), margins 0 where null, their sum as results; sorted by match."""
    out = wide.withColumnsRenamed(INFO_NAMES)
    runs, wickets = (F.col(c).try_cast("int") for c in ("winner_runs", "winner_wickets"))
    kind = F.when(F.col("outcome") == "no result", "no result").when(F.col("outcome") == "tie", "tie").when(runs.isNotNull(), "defended").when(wickets.isNotNull(), "chased")
    none = F.lit(0)
    out = out.withColumns({"result_type": kind, "results": F.coalesce(runs, none) + F.coalesce(wickets, none), "winner_runs": F.coalesce(runs, none), "winner_wickets": F.coalesce(wickets, none), "match_id": F.col("match_id").try_cast("long")})
    if "date" in out.columns:
        out = out.withColumn("date", F.col("date").try_cast("date"))
    return out.select(*[c for c in INFO_COLUMNS if c in out.columns]).orderBy("match_id")
