"""Loads of landed files into Bronze that cost what they bring: known content is looked up in an index, and a load that breaks off is finished by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.operators.bronze import bronze_rows, header, split_rejects
from creaseline.plans.pending import Pending
from creaseline.sinks import content_index
from creaseline.sinks.tables import overwrite_partitions

#: The column that partitions Bronze and its rejects: which load brought a row.
LOAD = "_load"


class Landing:
    """Bronze and rejects under folder, each partitioned by load, with the index of what they hold.

    A load puts down whole what it will write, then writes Bronze, rejects and the index, each of which may be written again. The next load, of
    whatever run, first finishes one that broke off. So content arrives once, whatever is repeated and whichever
    checkpoint or run id is lost: what is known is what Bronze holds.
    """

    def __init__(self, spark: SparkSession, folder: str, bronze_path: str | None = None, rejects_path: str | None = None):
        self.spark, self.folder = spark, folder
        self.bronze_path, self.rejects_path, self.index = bronze_path or f"{folder}/match_data", rejects_path or f"{folder}/match_rejects", f"{folder}/_index"
        self.pending = Pending(spark, f"{folder}/_pending_load")

    def bronze(self) -> DataFrame:
        return self.spark.read.parquet(self.bronze_path)

    def prepare(self) -> None:
        """Finish what broke off; make the index where there is none, out of Bronze if that has rows."""
        if self.pending.ready():
            self.apply()
        if not content_index.exists(self.spark, self.index):
            try:
                # rejects are known content too: no revision, so no match is numbered by them
                held = [self.bronze().select("match_id", "revision", "content_hash"), self.spark.read.parquet(self.rejects_path).select("match_id", F.lit(None).cast("string").alias("revision"), "content_hash")]
                known = held[0].unionByName(held[1])
            except Exception as missing:
                if "PATH_NOT_FOUND" not in str(missing):
                    raise
                known = self.spark.createDataFrame([], "match_id string, revision string, content_hash string")
            content_index.create(known, self.index)

    def load(self, landed: DataFrame, load: str, snapshot_date: str) -> dict[str, int]:
        """Load files (file_name, match_id, raw_json, content_hash); returns how many files were attempted, skipped (known content), succeeded and failed.

        Files of equal content in one load are files of their own, as revisions in the order of their names. A load is repeated
        under its own name; a name that has brought rows before does not replace them by other content.
        """
        self.prepare()
        self.pending.put("landed", landed.select("file_name", "match_id", "raw_json", "content_hash"))  # files are read once
        landed = self.pending["landed"]
        attempted = landed.count()
        self.pending.put("fresh", header(content_index.unknown(landed, self.index)))
        good, bad = split_rejects(self.pending["fresh"])
        numbered = bronze_rows(good, content_index.heads(good, self.index), snapshot_date, load)
        own = F.concat(F.lit(f"{load}-"), F.lit(self.pending.stamp()))
        self.pending.put("bronze", numbered.withColumn(LOAD, own))
        self.pending.put("rejects", bad.withColumn("_pipeline_run_id", F.lit(load)).withColumn(LOAD, own))
        self.pending.mark(True)
        done = self.apply()
        return {"attempted": attempted, "skipped": attempted - done["succeeded"] - done["failed"]} | done

    def apply(self) -> dict[str, int]:
        rows, bad = self.pending["bronze"], self.pending["rejects"]
        out = {"succeeded": overwrite_partitions(rows, self.bronze_path, [LOAD]), "failed": overwrite_partitions(bad, self.rejects_path, [LOAD])}
        arrived = rows.select("match_id", "revision", "content_hash").unionByName(bad.select("match_id", F.lit(None).cast("string").alias("revision"), "content_hash"))
        content_index.remember(arrived, self.index)
        self.pending.mark(False)
        return out
