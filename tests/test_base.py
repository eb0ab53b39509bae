"""Operators on hand-built documents, each with exact expected rows."""

import json

import pytest
from pyspark.sql import functions as F

from creaseline.functions import metrics as M
from creaseline.operators import bronze, control, identity, quality, register, silver
from creaseline.plans import build, gold, marts
from creaseline.sinks import tables
from creaseline.sources import files

BALLS = [
    {"batter": "A", "bowler": "X", "non_striker": "B", "runs": {"batter": 4, "extras": 0, "total": 4}, "wickets": [{"player_out": "A", "kind": "caught", "fielders": [{"name": "Y", "substitute": True}]}, {"player_out": "B", "kind": "run out"}]},
    {"batter": "B", "bowler": "X", "non_striker": "C", "runs": {"batter": 0, "extras": 1, "total": 1}, "extras": {"wides": 1}},
]
M5 = {"info": {"teams": ["T1", "T2"], "dates": ["2020-01-02"], "season": 2007, "match_type": "T20", "gender": "male", "players": {"T1": ["A", "B"], "T2": ["X"]}, "registry": {"people": {"A": "r1", "X": "r2"}}, "officials": {"umpires": ["U"], "tv_umpires": ["U"]}, "outcome": {"winner": "T1", "by": {"runs": 3}}, "player_of_match": ["A", "A", "X"]}, "innings": [{"team": "T1", "overs": [{"over": 0, "deliveries": BALLS}], "powerplays": [{"from": 0.1, "to": 5.6, "type": "mandatory"}]}]}
M8 = {"info": {"teams": ["T1"], "match_type": "Test"}}


@pytest.fixture()
def parsed(spark):
    rows = [("m5", "1", "old"), ("m5", "2", json.dumps(M5)), ("m8", "1", json.dumps(M8)), ("bad", "1", "not json"), ("empty", "x", "")]
    df = spark.createDataFrame(rows, "match_id string, revision string, raw_json string")
    df = bronze.header(df).drop("ok").withColumns({"_snapshot_date": F.lit("2024-01-01").cast("date"), "_ingested_at": F.lit("2024-01-01").cast("timestamp")})
    return silver.parse(df).persist()


def test_header_and_rejects(spark):
    df = spark.createDataFrame([("m5", json.dumps(M5)), ("bad", "not json"), ("empty", "")], "match_id string, raw_json string")
    good, bad = bronze.split_rejects(bronze.header(df))
    assert [(r.match_id, r.season, r.match_date, r.team_b, r.city) for r in good.collect()] == [("m5", "2007", "2020-01-02", "T2", "")]
    assert {r.match_id for r in bad.collect()} == {"bad", "empty"}


def test_deliveries_and_wickets(parsed):
    got = {(r.delivery_number, r.runs_batter, r.extra_wides, r.is_wicket) for r in silver.deliveries(parsed).collect()}
    assert got == {(1, 4, None, True), (2, 0, 1, False)}
    assert {(r.player_out, r.kind, tuple(r.fielders or ())) for r in silver.wickets(parsed).collect()} == {("A", "caught", ("Y",)), ("B", "run out", ())}


def test_matches_blanks_are_null(parsed):
    by = {r.match_id: r for r in silver.matches(parsed).collect()}
    assert (by["m5"].season, str(by["m5"].match_date), by["m5"].winner) == ("2007", "2020-01-02", "T1")
    assert by["m8"].team_b is None and by["m8"].match_date is None and by["bad"].match_type is None


def test_other_silver_tables(parsed):
    assert silver.innings(parsed).count() == 1 and silver.powerplays(parsed).first().to_over == 5.6
    assert {r.official_name + r.role for r in silver.officials(parsed).collect()} == {"Uumpire", "Utv_umpire"}
    assert silver.competitions(parsed).count() == 0 and silver.players(parsed).count() == 3
    checks = {r.match_id: r for r in silver.document_checks(parsed).collect()}
    assert not checks["m5"].registry_complete and checks["m5"].has_innings and not checks["m8"].has_innings


def test_identity(spark, parsed):
    ids = spark.createDataFrame([("p1", "cricsheet", "r1"), ("p0", "cricsheet", "r1")], "identifier string, source_system string, source_identifier string")
    names = spark.createDataFrame([("p9", "B"), ("p8", "B")], "identifier string, name string")
    got = identity.resolve(silver.players(parsed), "player_name", silver.registry(parsed), ids, names)
    assert {(r.player_name, r.person_id) for r in got.collect()} == {("A", "p0"), ("B", "p8"), ("X", None)}
    off = identity.resolve(silver.officials(parsed), "official_name", silver.registry(parsed), ids, names)
    assert {(r.display_name, r.reason) for r in identity.audit(got, off).collect()} == {("X", "NO_REGISTER_MATCH"), ("U", "NO_REGISTRY_MAPPING")}


def test_gold_one_wicket_a_ball(spark, parsed):
    none = spark.createDataFrame([], "identifier string, source_system string, source_identifier string")
    names = spark.createDataFrame([("pA", "A"), ("pX", "X")], "identifier string, name string")
    t = {n: getattr(silver, n)(parsed) for n in ("matches", "innings", "deliveries", "wickets")}
    t["match_players"] = identity.resolve(silver.players(parsed), "player_name", silver.registry(parsed), none, names)
    t["fact_delivery"] = gold.fact_delivery(t)
    first = t["fact_delivery"].where("delivery_number = 1").first()
    assert (first.dismissal_kind, first.is_bowler_wicket, first.batter_person_id) == ("caught", True, "pA")
    inn = gold.fact_innings(t).first()
    assert (inn.total_runs, inn.legal_balls, inn.overs_faced, inn.run_rate) == (5, 1, 0.2, 30.0)
    bowler = gold.fact_player_match(t).where("player_name = 'X'").first()
    assert (bowler.balls_bowled, bowler.runs_conceded, bowler.wickets_taken, bowler.balls_faced) == (1, 5, 1, 0)
    assert gold.fact_player_of_match(t).count() == 2 and gold.fact_match_result(t).where("match_id = 'm5'").first().loser == "T2"
    lost = {r.team: r.losses for r in marts.team_performance(t).where("match_type = 'T20'").collect()}
    fixed = {r.team: r.losses for r in marts.team_performance(t, fix=True).where("match_type = 'T20'").collect()}
    assert lost == {"T1": 0, "T2": 0} and fixed == {"T1": 0, "T2": 1}


def test_dates(spark):
    d = gold.dim_date(spark)
    assert d.count() == 24106
    r = d.where("date = date '2024-02-29'").first()
    assert (r.date_id, r.quarter, r.week_of_year, r.day_of_week, r.day_name, r.is_weekend) == (20240229, 1, 9, 4, "Thursday", False)


def test_register(spark):
    df = spark.createDataFrame([("p1", "One", "253802", None), ("p2", "Two", "34102", "77"), ("p3", None, None, "")], "identifier string, name string, key_cricinfo string, key_opta string")
    assert {tuple(r) for r in register.identifiers(df).collect()} == {("p1", "cricinfo", "253802"), ("p2", "cricinfo", "34102"), ("p2", "opta", "77")}
    assert register.people(df).where("identifier = 'p1'").first().unique_name is None
    assert register.identifiers(df.select("identifier")).count() == 0
    assert len({r._row_hash for r in register.with_row_hash(df).collect()}) == 3


def test_revisions_and_latest(spark):
    old = spark.createDataFrame([("A", "3"), ("A", "x")], "match_id string, revision string")
    new = spark.createDataFrame([("A", "f2"), ("A", "f1"), ("B", "f3")], "match_id string, file_name string")
    assert {(r.file_name, r.revision) for r in bronze.assign_revisions(new, old).collect()} == {("f1", "4"), ("f2", "5"), ("f3", "1")}


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("c", None), ("c", None)], "id string, v int")
    got = {r.check_id: (r.status, r.failed) for r in quality.run(df, "silver", "x", [quality.Check("N", quality.missing("id")), quality.Check("U", quality.surplus("id", "v"), "WARN"), quality.Check("L", quality.missing("id"), "WARN", 30.0)]).collect()}
    assert got == {"N": ("FAILED", 1), "U": ("WARNING", 1), "L": ("PASSED", 1)}
    pct = spark.range(1).select(*[quality.pct(F.lit(a), F.lit(b)).alias(f"{a}_{b}") for a, b in ((5, 0), (50, 100), (100, 100), (1, 3))]).first()
    assert tuple(pct) == (0.0, 50.0, 99.9999, 33.3333)
    stored = []
    with pytest.raises(quality.BlockedError):
        quality.gate(quality.run(df, "silver", "x", [quality.Check("N", quality.missing("id"))]), stored.append)
    assert len(stored) == 1
    w = spark.createDataFrame([("caught", None), ("caught", []), ("caught", ["F"]), ("bowled", None)], "kind string, fielders array<string>")
    assert quality.run(w, "silver", "w", [quality.Check("F", quality.unfielded(), "WARN")]).first().failed == 2


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.create_keyed(spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), (None, 4)], "k string, v int"), path, ["k"], 8)
    rows = lambda: sorted((tuple(r) for r in tables.read_keyed(spark, path).collect()), key=str)
    assert tables.layout(spark, path) == 8
    assert tables.keyed_replace(spark.createDataFrame([("A", 7), ("A", 8), ("A", 9)], "k string, v int"), path, ["k"]) == 3
    assert rows() == [("A", 7), ("A", 8), ("A", 9), ("B", 1), (None, 4)]
    gone = spark.createDataFrame([("A",), (None,)], "k string")
    assert tables.keyed_replace(spark.createDataFrame([], "k string, v int"), path, ["k"], scope=gone) == 0  # processed, nothing left
    assert rows() == [("B", 1)]
    tables.upsert(spark.createDataFrame([("B", None), ("C", 3)], "k string, v int"), path, ["k"])
    assert rows() == [("B", None), ("C", 3)]
    with pytest.raises(ValueError):
        tables.keyed_replace(gone, path, [])
    many = str(tmp_path / "m")
    tables.create_keyed(spark.range(10), many, ["id"])
    assert tables.layout(spark, many) == 1
    days = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "_snapshot_date string, v int")
    p2 = str(tmp_path / "d")
    tables.full_refresh(days, p2, ["_snapshot_date"])
    assert tables.overwrite_partitions(days.where("v = 2").withColumn("v", F.lit(5)), p2, ["_snapshot_date"]) == 1
    assert sorted(r.v for r in spark.read.parquet(p2).collect()) == [1, 5]
    tables.delete_snapshot(spark, p2, "2024-01-02")
    assert [r.v for r in spark.read.parquet(p2).collect()] == [1]


def test_landing_files(spark, tmp_path):
    for name, text in (("m1.json", json.dumps(M5)), ("m1copy.json", json.dumps(M5)), ("_manifest.json", "{}"), ("bad.json", "nope")):
        (tmp_path / name).write_text(text)
    landed = files.landing_json(spark, str(tmp_path))
    assert {r.match_id for r in landed.collect()} == {"m1", "m1copy", "bad"}
    known = landed.where("match_id = 'm1'").select("content_hash")
    none = spark.createDataFrame([], "match_id string, revision string")
    rows, bad = bronze.load_matches(landed, known, none, "2024-01-01", "run")
    assert rows.count() == 0 and [r.match_id for r in bad.collect()] == ["bad"]
    out = str(tmp_path / "out")
    assert bronze.ingest(landed, known, none, out, "2024-01-01", "run") == {"attempted": 3, "skipped": 2, "succeeded": 0, "failed": 1, "rows_written": 0}
    assert bronze.ingest(landed, known.where("false"), none, out, "2024-01-01", "run") == {"attempted": 3, "skipped": 0, "succeeded": 2, "failed": 1, "rows_written": 2}
    assert {(r.match_id, r.revision, r._source_file) for r in spark.read.parquet(f"{out}/match_data").collect()} == {("m1", "1", "m1.json"), ("m1copy", "1", "m1copy.json")}
    assert spark.read.parquet(f"{out}/match_rejects").count() == 2


def test_control(spark):
    a = spark.createDataFrame([("f1", "h1", "m1", None), ("f2", "h2", "m2", "s")], "file_name string, content_hash string, match_id string, silver_loaded_at string")
    new = spark.createDataFrame([("f1", "h1", "m1"), ("f3", "h3", "m3")], "file_name string, content_hash string, match_id string")
    assert control.land(a, new).count() == 3
    got = {r.match_id: r.silver_loaded_at for r in control.stamp(a, a.select("match_id"), ["match_id"], "silver_loaded_at", F.lit("now"), only_empty=True).collect()}
    assert got == {"m1": "now", "m2": "s"}
    with pytest.raises(ValueError):
        control.enough_rows(a)


def test_metrics(spark):
    r = spark.range(1).select(M.season_year(F.lit("2002/03")).alias("s"), M.ratio(F.lit(1), F.lit(0)).alias("n"), M.phase(F.lit("T20"), F.lit(5)).alias("p"), M.phase(F.lit("ODI"), F.lit(40)).alias("d"), M.phase(F.lit("Test"), F.lit(1)).alias("t")).first()
    assert tuple(r) == (2002, None, "powerplay", "death", None)


def test_stream_front_end(spark, tmp_path):
    from creaseline.streaming.landing import ingest_available

    (tmp_path / "in").mkdir()
    run = lambda: ingest_available(spark, *(str(tmp_path / x) for x in ("in", "bronze", "rejects", "check")))
    (tmp_path / "in" / "m1.json").write_text(json.dumps(M5))
    (tmp_path / "in" / "bad.json").write_text("nope")
    for _ in range(2):  # the second run finds nothing new
        run()
    (tmp_path / "in" / "sub.json").write_text(json.dumps(M5))  # known content
    (tmp_path / "in" / "m2.json").write_text(json.dumps(M8))
    run()
    assert {(r.match_id, r.revision) for r in spark.read.parquet(str(tmp_path / "bronze")).collect()} == {("m1", "1"), ("m2", "1")}
    assert [r.match_id for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["bad"]


def test_persons_are_whole_rows_and_latest(spark):
    rows = spark.createDataFrame([("p1", "Bob", "zed"), ("p1", "Zoe", "amy"), ("p2", None, "only"), ("p2", "Named", None), (None, "x", "y")], "identifier string, name string, unique_name string")
    got = register.silver_persons(rows)
    assert {tuple(r) for r in got.collect()} == {("p1", "Bob", "zed"), ("p2", "Named", None)}
    both = got.withColumn("_snapshot_date", F.lit("2024-01-01").cast("date")).unionByName(spark.createDataFrame([("p1", "Older", "old"), ("p3", "Gone", "gone")], "person_id string, name string, unique_name string").withColumn("_snapshot_date", F.lit("2023-01-01").cast("date")))
    t = {"persons": both, "person_identifiers": spark.createDataFrame([("p1", "espn", "9")], "identifier string, source_system string, source_identifier string")}
    assert {(r.person_id, r.full_name, r.espn_id) for r in gold.dim_player(t).collect()} == {("p1", "Bob", "9"), ("p2", "Named", None), ("p3", "Gone", None)}


def test_rounding_and_skips(spark):
    r = spark.range(1).select(*[M.rounded(F.lit(x), 1).alias(str(i)) for i, x in enumerate((-0.25, 0.25, -0.04, 2.0))]).first()
    assert tuple(r) == (-0.3, 0.3, 0.0, 2.0) and str(r[2]) == "0.0"
    w = spark.createDataFrame([("bowled", None)], "kind string, fielders array<string>")
    check = next(c for c in quality.silver_checks()["wickets"] if c.check_id == "MAT-SLV-006")
    assert quality.run(w, "silver", "wickets", [check]).first().status == "SKIPPED"
    some = spark.createDataFrame([("caught", None), ("caught", ["F"]), ("bowled", None)], "kind string, fielders array<string>")
    assert (lambda x: (x.status, x.failed, x.total, x.pct))(quality.run(some, "silver", "wickets", [check]).first()) == ("WARNING", 1, 2, 50.0)


def test_register_load_replaces_its_snapshot(spark, tmp_path):
    people = spark.createDataFrame([("p1", "One", "1")], "identifier string, name string, key_espn string")
    names = spark.createDataFrame([], "identifier string, name string")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        assert register.load_register(register.parse_register(people, names), str(tmp_path), day) == {"people": 1, "people_identifiers": 1}
    assert spark.read.parquet(str(tmp_path / "people")).count() == 2


def test_silver_build_by_scope(spark, tmp_path):
    rows = [("m5", "1", json.dumps(M5)), ("m8", "1", json.dumps(M8))]
    df = bronze.header(spark.createDataFrame(rows, "match_id string, revision string, raw_json string")).drop("ok")
    df = df.withColumns({"_snapshot_date": F.lit("2024-01-01").cast("date"), "_ingested_at": F.lit("2024-01-01").cast("timestamp")})
    ids = spark.createDataFrame([], "identifier string, source_system string, source_identifier string")
    names = spark.createDataFrame([("pA", "A")], "identifier string, name string")
    folder = str(tmp_path / "silver")
    first = build.build_silver(df, ids, names, folder, df.where("match_id = 'm5'").select("match_id"))
    assert first["matches"] == 1 and first["deliveries"] == 2 and first["teams"] == 2 and build.build_silver(df, ids, names, folder, df.where("false").select("match_id")) == {}
    again = build.build_silver(df, ids, names, folder)
    own = build.silver_tables(spark, folder)
    assert again["matches"] == 2 and own["matches"].count() == 2 and own["deliveries"].count() == 2 and own["teams"].count() == 2
    audit = spark.createDataFrame([("m5", None), ("m8", "done")], "match_id string, gold_loaded_at string")
    written = build.build_gold(own, audit, str(tmp_path / "gold"))
    assert written["fact_delivery"] == 2 and written["dim_match"] == 1 and written["dim_team"] == 2 and build.build_gold(own, audit.where("match_id = 'm8'"), str(tmp_path / "gold")) == {}
    assert build.build_gold(own, audit.withColumn("gold_loaded_at", F.lit(None).cast("string")), str(tmp_path / "gold"))["dim_match"] == 2
    assert tables.read_keyed(spark, str(tmp_path / "gold" / "fact_delivery")).count() == 2
