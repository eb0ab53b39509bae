"""Write-ahead folders: what a run is about to write is put down whole before any table changes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Pending:
    """Named frames in a folder, and a mark that all of them are there. Spark jobs replace whole folders, so the mark is set last and taken away last."""

    def __init__(self, spark: SparkSession, place: str):
        self.spark, self.place = spark, place

    def put(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.place}/{name}")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.place}/{name}")

    def stamp(self) -> str:
        """A part of names that no two runs share."""
        return uuid.uuid4().hex[:12]

    def mark(self, ready: bool) -> None:
        self.spark.createDataFrame([(ready,)], "ready boolean").coalesce(1).write.mode("overwrite").parquet(f"{self.place}/state")

    def ready(self) -> bool:
        try:
            return self.spark.read.schema("ready boolean").parquet(f"{self.place}/state").first()["ready"]
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return False
