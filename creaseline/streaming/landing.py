"""A streaming front end: new landing files go to Bronze in one availableNow run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.plans.landing import Landing

FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_available(spark: SparkSession, folder: str, bronze_path: str, rejects_path: str, checkpoint: str, snapshot_date: str = "2024-01-01", state: str | None = None, glob: str = "*.json", name: str = r"([^/]+)$") -> None:
    """Load files that landed in folder: content that Bronze has is skipped, revisions are numbered on, rejects are kept.

    What is known is read from the index beside Bronze (`state`, by default beside bronze_path), never inferred from the number of a micro-batch. So a
    retried batch, a lost checkpoint or a second stream neither repeats nor replaces what is there, and a lost index is made anew
    from Bronze. Of several files of equal content in a micro-batch the first by name is loaded.
    """
    landing = Landing(spark, state or f"{bronze_path.rstrip('/')}_state", bronze_path, rejects_path)
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    file_name = F.regexp_extract("path", name, 1)
    rows = files.where(~file_name.startswith("_")).select(
        file_name.alias("file_name"), F.regexp_replace(file_name, r"\.json$", "").alias("match_id"),
        F.decode("content", "UTF-8").alias("raw_json"), F.sha2("content", 256).alias("content_hash"),
    )

    def batch(df: DataFrame, number: int) -> None:
        first = df.groupBy("content_hash").agg(F.min_by(F.struct("file_name", "match_id", "raw_json"), "file_name").alias("f"))
        landing.load(first.select("f.*", "content_hash"), f"batch-{number}", snapshot_date)

    rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
