"""A Gold run meets the audit once, and a kept batch is not written a second time."""

import os

from pyspark.sql import functions as F

from creaseline.operators import silver
from creaseline.plans import build
from creaseline.sinks import tables
from tests.test_tables_that_grow import as_bronze, ball, document


def test_the_audit_is_met_once(spark, tmp_path):
    innings = [{"team": "T1", "overs": [{"over": 0, "deliveries": [ball("A", "X"), ball("B", "X")]}]}]
    parsed = silver.parse(as_bronze(spark, {str(k): document(players={"T1": ["A", "B"], "T2": ["X"]}, innings=innings, venue=f"V{k % 2}", event={"name": f"Cup {k}"}) for k in range(4)})).localCheckpoint()
    t = {n: getattr(silver, n)(parsed) for n in ("matches", "innings", "deliveries", "wickets", "teams", "venues", "competitions")}
    t["match_players"] = silver.players(parsed).withColumn("person_id", F.lit(None).cast("string"))
    read = spark.sparkContext.accumulator(0)

    def met(key):
        read.add(1)
        return key

    def audit(done):
        rows = spark.createDataFrame([(str(k), "2024-01-01" if (k in done) else None) for k in range(4)], "match_id string, gold_loaded_at string").localCheckpoint()
        return rows.withColumn("match_id", F.udf(met, "string").asNondeterministic()("match_id"))

    folder = str(tmp_path)
    build.build_gold(t, audit({2, 3}), folder)
    assert read.value == 4
    own = lambda n: {r[0] for r in tables.read_keyed(spark, f"{folder}/{n}").collect()}
    assert (own("dim_team"), own("dim_venue"), own("dim_competition")) == ({"T1", "T2"}, {"V0", "V1"}, {"Cup 0", "Cup 1"})
    build.build_gold(t, audit({0, 1}), folder)
    assert own("dim_competition") == {f"Cup {k}" for k in range(4)}
    assert tables.read_keyed(spark, f"{folder}/fact_delivery").count() == 8
    assert not os.path.exists(f"{folder}/fact_delivery/_staged")
