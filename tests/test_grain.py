"""Digests by bucket give what full grain checks give, and read what changed."""

import random

import pytest
from pyspark.sql import functions as F

from creaseline.operators import grain, quality
from creaseline.sinks import tables


def test_same_failures_as_the_full_check(spark, tmp_path):
    rng, path, store = random.Random(2), str(tmp_path / "t"), str(tmp_path / "d")
    ddl, cols = "m string, n int, v double", ["m", "n"]
    rows = [(rng.choice(["a", "b", None, *map(str, range(40))]), rng.choice([1, 2, None]), rng.random()) for _ in range(400)] + [("hot", 1, 0.5)] * 300
    tables.create_keyed(spark.createDataFrame(rows, ddl), path, ["m"], 32)
    assert grain.refresh(spark, path, ["m"], cols, store) == 32
    full = lambda: (lambda r: (r.failed, r.total))(quality.run(tables.read_keyed(spark, path), "silver", "t", [quality.Check("G", quality.surplus(*cols))]).first())
    assert tuple(grain.surplus(spark, store).first()) == full() and full()[0] > 300
    assert grain.refresh(spark, path, ["m"], cols, store) == 0  # nothing changed, nothing is read
    before = spark.createDataFrame(grain.stored(spark, store).collect(), grain.DIGESTS)
    for delta, most in (([("7", 1, 1.0), ("7", 1, 2.0)], 1), ([("new", None, 1.0), (None, None, 2.0), (None, None, 3.0)], 2)):
        tables.keyed_replace(spark.createDataFrame(delta, ddl), path, ["m"])
        assert 0 < grain.refresh(spark, path, ["m"], cols, store) <= most
        assert tuple(grain.surplus(spark, store).first()) == full()
    assert 1 <= grain.changed(before, grain.stored(spark, store)).count() <= 3


def test_a_rerun_changes_files_but_no_rows(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "d")
    df = spark.range(200).withColumn("v", F.col("id") * 2)
    tables.create_keyed(df, path, ["id"], 8)
    grain.refresh(spark, path, ["id"], ["id"], store)
    before = spark.createDataFrame(grain.stored(spark, store).collect(), grain.DIGESTS)
    tables.keyed_replace(df, path, ["id"])
    assert grain.refresh(spark, path, ["id"], ["id"], store) == 8 and grain.changed(before, grain.stored(spark, store)).count() == 0
    tables.upsert(df.where("id = 5").withColumn("v", F.lit(-1).cast("long")), path, ["id"])
    assert grain.refresh(spark, path, ["id"], ["id"], store) == 1 and grain.changed(before, grain.stored(spark, store)).count() == 1


def test_grain_without_the_bucket_key(spark, tmp_path):
    with pytest.raises(ValueError, match="lacks"):
        grain.refresh(spark, str(tmp_path), ["a"], ["b"], "")


def test_a_last_day_of_more_orders_than_buckets(spark, tmp_path):
    from creaseline.queries import queries

    key = F.col("o_orderkey")
    orders = spark.range(4000).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") % 4 > 0, "2024-01-02").otherwise("2024-01-01").cast("timestamp").alias("o_orderdate"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    orders.select(key.alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (key % 7).alias("l_partkey"), F.lit(2.0).alias("l_quantity")).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {tuple(r) for r in queries()["i07_grain_by_bucket"](spark, str(tmp_path)).collect()}
    assert got == {("before", 0, 4000, False), ("after", 3000, 7000, True)}
