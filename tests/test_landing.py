"""Loads and streams that repeat nothing and lose nothing, whatever breaks off or is lost; and that read what they touch."""

import itertools
import json
import re

import pytest
from pyspark.sql import functions as F

from creaseline.plans.landing import Landing
from creaseline.sinks import content_index, tables
from creaseline.streaming.landing import ingest_available


def doc(season):
    return json.dumps({"info": {"season": season, "match_type": "T20"}})


def landed(spark, files):
    rows = spark.createDataFrame([(f"{m}.json", m, text) for m, text in files], "file_name string, match_id string, raw_json string")
    return rows.withColumn("content_hash", F.sha2("raw_json", 256))


def held(df):
    return sorted((r.match_id, r.revision, r.season) for r in df.collect())


def test_lost_checkpoint_loses_and_repeats_nothing(spark, tmp_path):
    place = lambda x: str(tmp_path / x)
    (tmp_path / "in").mkdir()
    run = lambda checkpoint, **more: ingest_available(spark, *(place(x) for x in ("in", "bronze", "rejects")), place(checkpoint), **more)
    bronze = lambda: held(spark.read.parquet(place("bronze")))
    (tmp_path / "in" / "m1.json").write_text(doc("1"))
    (tmp_path / "in" / "bad.json").write_text("nope")
    run("a")
    (tmp_path / "in" / "m2.json").write_text(doc("2"))
    run("a")
    (tmp_path / "in" / "m1.json").unlink()  # archived
    (tmp_path / "in" / "m3.json").write_text(doc("3"))
    run("fresh")
    want = [("m1", "1", "1"), ("m2", "1", "2"), ("m3", "1", "3")]
    assert bronze() == want and spark.read.parquet(place("rejects")).count() == 1
    run("fresh")
    (tmp_path / "in" / "m2.json").write_text(doc("2 corrected"))
    (tmp_path / "in" / "copy.json").write_text(doc("3"))
    run("third", state=place("state anew"))  # the index is lost too, and made anew from Bronze
    assert bronze() == sorted([*want, ("m2", "2", "2 corrected")]) and spark.read.parquet(place("rejects")).count() == 1


def test_a_load_that_breaks_off_anywhere(spark, tmp_path, monkeypatch):
    first = landed(spark, [("a", doc("1")), ("b", doc("2")), ("x", "nope")])
    second = landed(spark, [("a", doc("1 corrected")), ("b", doc("2")), ("c", doc("3")), ("y", "nope either")])
    want = [("a", "1", "1"), ("a", "2", "1 corrected"), ("b", "1", "2"), ("c", "1", "3")]
    import creaseline.plans.landing as module

    real_write, real_remember = module.overwrite_partitions, content_index.remember
    for at in (0, 2):  # in Bronze's write, in the index's
        place = Landing(spark, str(tmp_path / f"at{at}"))
        assert place.load(first, "one", "2024-01-01") == {"attempted": 3, "skipped": 0, "succeeded": 2, "failed": 1}
        calls = itertools.count()

        def breaks(real, *args, calls=calls, at=at):
            if next(calls) == at:
                raise RuntimeError("lost")
            return real(*args)

        monkeypatch.setattr(module, "overwrite_partitions", lambda *a: breaks(real_write, *a))
        monkeypatch.setattr(content_index, "remember", lambda *a: breaks(real_remember, *a))
        with pytest.raises(RuntimeError):
            place.load(second, "two", "2024-01-02")
        monkeypatch.setattr(module, "overwrite_partitions", real_write)
        monkeypatch.setattr(content_index, "remember", real_remember)
        assert place.load(second, "two", "2024-01-02") == {"attempted": 4, "skipped": 4, "succeeded": 0, "failed": 0}  # finished before it looked
        assert held(place.bronze()) == want and spark.read.parquet(place.rejects_path).count() == 2
    # another load of the same name does not replace what the first brought
    place.load(landed(spark, [("d", doc("4"))]), "two", "2024-01-02")
    assert held(place.bronze()) == [*want, ("d", "1", "4")]


def test_files_read_grow_with_the_load(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 200)
    folder = str(tmp_path / "i")
    rows = spark.range(6000).select(F.col("id").cast("string").alias("match_id"), F.lit("1").alias("revision"), F.sha2(F.col("id").cast("string"), 256).alias("content_hash"))
    content_index.create(rows.where("match_id < 100"), folder)
    content_index.remember(rows.where("match_id >= 100"), folder)
    assert tables.layout(spark, f"{folder}/hashes") >= 30
    few = rows.where("match_id in ('7', '4000')").unionByName(spark.createDataFrame([("new", "1", "no hash")], "match_id string, revision string, content_hash string"))
    plan = content_index.known_hashes(few, folder)._jdf.queryExecution().executedPlan().toString()
    named = re.search(r"PartitionFilters: \[[^\]]*__bucket#\d+ IN \(([\d,]+)\)", plan)
    assert named and len(named[1].split(",")) <= 3  # a bucket for each hash at most
    assert [r.match_id for r in content_index.unknown(few, folder).collect()] == ["new"]
    assert "In(content_hash" in plan  # what Bloom filters are asked
    assert content_index.unknown(rows, folder).count() == 0  # more hashes than are named
    content_index.remember(rows.where("match_id = '7'").withColumn("revision", F.lit("12")), folder)
    assert {(r.match_id, r.revision) for r in content_index.heads(few, folder).collect()} == {("7", 12), ("4000", 1)}
