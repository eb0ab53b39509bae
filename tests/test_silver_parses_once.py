"""A Silver run computes and parses each document once, and leaves no table of the session behind."""

from pyspark.sql import functions as F

from creaseline.plans import build
from creaseline.sinks import tables
from tests.test_tables_that_grow import as_bronze, ball, document


def test_a_run_reads_each_document_once(spark, tmp_path):
    innings = [{"team": "T1", "overs": [{"over": 0, "deliveries": [ball("A", "X"), ball("B", "X")]}]}]
    docs = {str(k): document(players={"T1": ["A", "B"], "T2": ["X"]}, innings=innings, registry={"people": {"A": "r-A"}}) for k in range(20)}
    read = spark.sparkContext.accumulator(0)

    def met(text):
        read.add(1)
        return text

    bronze = as_bronze(spark, docs).localCheckpoint()
    bronze = bronze.withColumn("raw_json", F.udf(met, "string")("raw_json"))
    ids = spark.createDataFrame([("i1", "cricsheet", "r-A")], "identifier string, source_system string, source_identifier string")
    names = spark.createDataFrame([("i2", "X")], "identifier string, name string")
    before = {t.name for t in spark.catalog.listTables()}
    written = build.build_silver(bronze, ids, names, str(tmp_path))
    assert read.value == len(docs)
    assert (written["deliveries"], written["match_players"], written["unmatched_persons_audit"]) == (40, 60, 20)
    players = tables.read_keyed(spark, f"{tmp_path}/match_players")
    assert {(r.player_name, r.person_id) for r in players.collect()} == {("A", "i1"), ("B", None), ("X", "i2")}
    assert {t.name for t in spark.catalog.listTables()} == before
