"""The person register: two CSVs to typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.functions.metrics import row_hash
from creaseline.sinks.tables import overwrite_partitions

CORE = ("identifier", "name", "unique_name")


def with_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("_row_hash", row_hash(*[F.col(f"`{c}`") for c in df.columns]))


def people(register: DataFrame) -> DataFrame:
    """Core columns; one that the snapshot lacks is a null string."""
    return register.select(*[F.col(c).cast("string") if c in register.columns else F.lit(None).cast("string").alias(c) for c in CORE])


def identifiers(register: DataFrame) -> DataFrame:
    """Every key_* column as rows (identifier, key_source, key_value), nulls and blanks dropped."""
    keys = [c for c in register.columns if c.startswith("key_")]
    if not keys:
        return register.sparkSession.createDataFrame([], "identifier string, key_source string, key_value string")
    rows = register.unpivot(["identifier"], keys, "key_source", "key_value")
    return rows.withColumn("key_source", F.regexp_replace("key_source", "^key_", "")).where("key_value is not null and key_value <> ''")


def name_variations(names: DataFrame) -> DataFrame:
    return names.select("identifier", "name").dropna().dropDuplicates(["identifier", "name"])


def silver_persons(people_rows: DataFrame) -> DataFrame:
    """One row of the snapshot for each person. Of repeated ids the row that sorts first stays, whole, with values before nulls."""
    rest = [c for c in people_rows.columns if c != "identifier"]
    order = F.struct(*[part for c in rest for part in (F.col(c).isNull(), F.col(c))])
    row = F.min_by(F.struct(*rest), order).alias("row")
    return people_rows.where("identifier is not null").groupBy(F.col("identifier").alias("person_id")).agg(row).select("person_id", "row.*")


def silver_identifiers(identifier_rows: DataFrame) -> DataFrame:
    return identifier_rows.withColumnsRenamed({"key_source": "source_system", "key_value": "source_identifier"}).dropDuplicates(["identifier", "source_system", "source_identifier"])


def parse_register(people_raw: DataFrame, names_raw: DataFrame) -> dict[str, DataFrame]:
    """Both register files to the three Bronze tables, each with its row hash."""
    frames = {"people": people(people_raw), "people_identifiers": identifiers(people_raw), "name_variations": name_variations(names_raw)}
    return {name: with_row_hash(df) for name, df in frames.items()}


def load_register(frames: dict[str, DataFrame], folder: str, day: str) -> dict[str, int]:
    """Replace that day's snapshot of each table; frames without rows are left out. Returns rows written by table."""
    written = {}
    for name, df in frames.items():
        if not df.isEmpty():
            written[name] = overwrite_partitions(df.withColumn("_snapshot_date", F.lit(day).cast("date")), f"{folder}/{name}", ["_snapshot_date"])
    return written
