"""Bronze: match documents as text revisions, and the control tables' incremental rules around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.schema import HEADER_DDL
from creaseline.sinks.tables import append


def with_metadata(df: DataFrame, **values) -> DataFrame:
    """Add metadata columns, each only where the frame has none of that name."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items() if k not in df.columns})


def header(raw: DataFrame, text_col: str = "raw_json") -> DataFrame:
    """raw plus the header of each document, all strings, blanks where the document says nothing; `ok` tells valid JSON objects."""
    info = F.from_json(F.col(text_col), HEADER_DDL)["info"]
    parsed = raw.withColumn("__info", info)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    i = F.col("__info")
    return parsed.withColumns({
        "ok": i.isNotNull(),
        "match_type": text(i["match_type"]), "gender": text(i["gender"]), "season": text(i["season"]),
        "match_date": text(F.get(i["dates"], 0)), "team_a": text(F.get(i["teams"], 0)), "team_b": text(F.get(i["teams"], 1)),
        "venue": text(i["venue"]), "city": text(i["city"]),
    }).drop("__info")


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parsed.where("ok").drop("ok"), parsed.where("not ok").drop("ok")


def new_content(landed: DataFrame, audit: DataFrame) -> DataFrame:
    """Landed files whose content hash no audit row has."""
    return landed.join(audit.select("content_hash").distinct(), "content_hash", "left_anti")


def max_revision(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("match_id").agg(F.max(F.col("revision").try_cast("int")).alias("max_revision"))


def assign_revisions(landed: DataFrame, bronze: DataFrame, order_col: str = "file_name") -> DataFrame:
    """The next revisions of each match, in order of file when a batch holds several."""
    place = F.row_number().over(W.partitionBy("match_id").orderBy(order_col))
    joined = landed.withColumn("__place", place).join(max_revision(bronze), "match_id", "left")
    return joined.withColumn("revision", (F.coalesce("max_revision", F.lit(0)) + F.col("__place")).cast("string")).drop("__place", "max_revision")


def latest_revision(bronze: DataFrame, ties: tuple[str, ...] = ("_source_file", "raw_json")) -> DataFrame:
    """The newest row of each match: by revision, then load time, then the largest of the tie columns that there are."""
    last = [F.col(c).desc_nulls_last() for c in ties if c in bronze.columns]
    newest = W.partitionBy("match_id").orderBy(F.col("revision").try_cast("int").desc_nulls_last(), F.col("_ingested_at").desc(), *last)
    return bronze.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")


def already_loaded(log: DataFrame, snapshot_date: str, force: bool = False) -> bool:
    """Whether the load of that snapshot has succeeded before (never with force)."""
    return not force and not log.where((F.col("snapshot_date") == F.lit(snapshot_date)) & (F.col("status") == "SUCCESS")).isEmpty()


def load_matches(landed: DataFrame, known: DataFrame, bronze: DataFrame, snapshot_date: str, run_id: str) -> tuple[DataFrame, DataFrame]:
    """Landed files (file_name, match_id, raw_json, content_hash) that are new, as Bronze rows and rejects."""
    good, bad = split_rejects(header(new_content(landed, known)))
    return bronze_rows(good, bronze, snapshot_date, run_id), bad


def bronze_rows(good: DataFrame, bronze: DataFrame, snapshot_date: str, run_id: str) -> DataFrame:
    return with_metadata(assign_revisions(good, bronze), _snapshot_date=F.lit(snapshot_date).cast("date"), _pipeline_run_id=run_id, _source_file=F.col("file_name"))


def ingest(landed: DataFrame, known: DataFrame, bronze: DataFrame, folder: str, snapshot_date: str, run_id: str) -> dict[str, int]:
    """Load landed files into folder/match_data, rejects into folder/match_rejects.

    The files are read and parsed once, into folder/staging; counts are observed on the way. Returns how many files
    were attempted, skipped (their content is known), succeeded and failed, and rows written.
    """
    spark, seen, parsed = landed.sparkSession, Observation(), Observation()
    n = F.count(F.lit(1))
    fresh = header(new_content(landed.observe(seen, n.alias("attempted")), known))
    fresh.observe(parsed, n.alias("fresh"), F.count_if(~F.col("ok")).alias("failed")).write.mode("overwrite").parquet(f"{folder}/staging")
    good, bad = split_rejects(spark.read.schema(fresh.schema).parquet(f"{folder}/staging"))
    rows = append(bronze_rows(good, bronze, snapshot_date, run_id), f"{folder}/match_data", ["_snapshot_date"])
    append(bad.withColumn("_pipeline_run_id", F.lit(run_id)), f"{folder}/match_rejects")
    attempted, got = seen.get["attempted"], parsed.get
    return {"attempted": attempted, "skipped": attempted - got["fresh"], "succeeded": got["fresh"] - got["failed"], "failed": got["failed"], "rows_written": rows}
