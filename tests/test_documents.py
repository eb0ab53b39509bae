"""Documents are parsed by what is read, kept as files or not at all, and dealt out by how many balls there are."""

import pytest

from creaseline import queries as Q
from creaseline import standin as S
from creaseline.operators import silver

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark):
    t = Q.Lake.of(spark, SMALL)
    t.forget()
    yield t
    t.forget()


def cached(spark) -> int:
    return len(spark.sparkContext._jsc.getPersistentRDDs())


def rows(df) -> list[str]:
    return sorted(map(str, df.collect()))


def test_nothing_of_the_documents_is_cached(spark, lake):
    """What is cached lies in the executors' memory: whole nested documents would."""
    before = cached(spark)
    Q.queries()["f05_dim_competition"](spark, SMALL).collect()
    Q.queries()["h11_format_split"](spark, SMALL).collect()
    assert cached(spark) == before


def test_a_table_by_match_parses_no_balls(spark, lake):
    assert "deliveries" not in lake["info"].schema.simpleString()
    assert "deliveries" not in lake["competitions"]._jdf.queryExecution().optimizedPlan().toString().split("from_json")[1].split("raw_json")[0]


@pytest.mark.parametrize("stored", [False, True])
def test_parts_of_a_document_give_what_the_whole_gives(spark, lake, stored):
    """Tables out of the split documents, read in one pass or from files, are those out of whole ones."""
    whole = silver.parse(S.documents(spark, SMALL)).localCheckpoint()
    if stored:
        lake.store()
    for name in ("matches", "innings", "deliveries", "wickets", "replacements", "powerplays", "registry", "teams", "venues", "competitions"):
        expected, got = getattr(silver, name)(whole), lake[name]
        assert got.columns == expected.columns
        assert rows(got) == rows(expected)


def test_parts_follow_the_number_of_balls(spark, lake, monkeypatch):
    """Adaptive execution must not join parts by the size of what is shuffled: the texts are many times as large."""
    monkeypatch.setattr(S, "PART_BALLS", 100)
    n = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert S.ball_rows(spark, SMALL).rdd.getNumPartitions() == -(-n // 100)


def test_stored_parts_come_of_one_parse(spark, lake):
    """A stored run builds and parses documents once: both parts read the same files, each its own columns."""
    lake.store()
    assert set(lake["info"].inputFiles()) == set(lake["balls"].inputFiles())
    read = lake["info"]._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in read and "deliveries" not in read


def test_queries_that_read_documents_twice_store_them(spark, lake):
    lake.forget()
    Q.queries()["h07_highest_score"](spark, SMALL)
    assert lake.stored


def test_documents_are_texts_of_their_nested_form(spark, lake):
    """Documents put together out of texts are valid, and written again from their nested form they are the same text."""
    from pyspark.sql import functions as F

    from creaseline.schema import MATCH_DDL

    again = F.to_json(F.from_json("raw_json", MATCH_DDL))
    flat = lambda c: F.length(F.regexp_replace(c, "\\s", ""))
    d = lake["bronze"].where("raw_json not like '%replacements%'")
    assert d.where(F.from_json("raw_json", MATCH_DDL).isNull() | (flat(again) != flat(F.col("raw_json")))).isEmpty()
    assert not d.isEmpty()


def test_stored_tables_by_match_are_joined_where_they_lie(spark, lake):
    """Documents and players lie in buckets by match: putting facts together and grouping them by match and more keys sends no row over the network."""
    lake.store()
    assert lake["match_players"].columns
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if all were large
    try:
        for name in ("fact_delivery", "fact_player_match"):
            plan = lake[name]._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "hashpartitioning(match_id" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_facts_are_put_together_once(spark, lake):
    """Both sides of fact_player_match read the files of fact_delivery, and buckets stay those of the first write whatever the session says later."""
    from creaseline.plans import gold

    expected = rows(gold.fact_player_match(lake))
    Q.queries()["f11_fact_player_match"](spark, SMALL)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert "posexplode" not in lake["fact_player_match"]._jdf.queryExecution().executedPlan().toString()
        assert rows(lake["fact_player_match"]) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("stored", [False, True])
def test_players_are_resolved_by_what_matches_mention(spark, lake, stored):
    from creaseline.operators import identity

    if stored:
        lake.store()
    expected = identity.resolve(silver.players(lake["info"]), "player_name", lake["registry"], lake["person_identifiers"], lake["name_variations"])
    assert rows(lake["resolved_players"]) == rows(expected.select(*lake["resolved_players"].columns))
