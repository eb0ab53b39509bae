"""Replacements and elevens, keyed tables that grow, layouts by range, histories in any order, Silver that costs its scope."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from creaseline.operators import bronze, control, lineup, silver
from creaseline.plans import build, history
from creaseline.sinks import tables


def ball(batter, bowler, non_striker="N", **more):
    return {"batter": batter, "bowler": bowler, "non_striker": non_striker, "runs": {"batter": 0, "extras": 0, "total": 0}} | more


def document(teams=("T1", "T2"), venue="V", city="C", event=None, innings=(), players=None, **info):
    return {"info": {"teams": list(teams), "team_type": "club", "venue": venue, "city": city, "event": event, "players": players or {}, **info}, "innings": list(innings)}


def as_bronze(spark, docs, revision="1", day="2024-01-01"):
    rows = [(m, revision, json.dumps(d)) for m, d in docs.items()]
    df = bronze.header(spark.createDataFrame(rows, "match_id string, revision string, raw_json string")).drop("ok")
    return df.withColumns({"_snapshot_date": F.lit(day).cast("date"), "_ingested_at": F.lit(f"{day} 0{revision}:00:00").cast("timestamp")})


# -- replacements ---------------------------------------------------------------------------------

SWAPPED = document(
    players={"T1": ["A", "B", "Sub"], "T2": ["X", "Y"]}, event={"name": "Cup", "group": "A"}, missing=["umpires"],
    innings=[{"team": "T1", "overs": [
        {"over": 0, "deliveries": [
            ball("A", "X"),
            ball("A", "X", replacements={"match": [{"team": "T1", "in": "Sub", "out": "A", "reason": "concussion"}], "role": [{"in": "Y", "out": "X", "reason": "injury", "role": "bowler"}]}),
            ball("Sub", "Y", wickets=[{"player_out": "Sub", "kind": "caught", "fielders": [{"name": "F", "substitute": True}, {"name": "G"}]}, {"player_out": "B", "kind": "run out"}]),
        ]},
        {"over": 1, "deliveries": [
            ball("B", "Y", replacements={"match": [{"in": "Z", "out": "Y", "reason": "injury"}]}),  # no team named: the fielding side, as Y is not at the crease
            ball("A", "Y", replacements={"match": [{"team": "T1", "in": "A", "out": "Sub", "reason": "injury"}]}),  # and back
        ]},
    ]}],
)


def test_replacement_columns(spark):
    parsed = silver.parse(as_bronze(spark, {"m": SWAPPED, "plain": document()}))
    m = {r.match_id: r for r in silver.matches(parsed).collect()}
    assert (m["m"].group_label, m["m"].has_missing_data, m["plain"].group_label, m["plain"].has_missing_data) == ("A", True, None, False)
    swaps = {(r.over_number, r.delivery_number): (r.replacement_in, r.replacement_out, r.replacement_reason) for r in silver.deliveries(parsed).collect()}
    assert swaps == {(0, 1): (None,) * 3, (0, 2): ("Y", "X", "injury"), (0, 3): (None,) * 3, (1, 1): ("Z", "Y", "injury"), (1, 2): ("A", "Sub", "injury")}
    assert {(r.player_out, r.fielder_is_substitute) for r in silver.wickets(parsed).collect()} == {("Sub", True), ("B", False)}
    assert [tuple(r)[:2] for r in silver.competitions(parsed).collect()] == [("Cup", "A")]
    rows = {(r.over_number, r.delivery_number, r.replacement_number, r.scope, r.team, r.player_in, r.player_out, r.role) for r in silver.replacements(parsed).collect()}
    assert rows == {(0, 2, 1, "role", "T2", "Y", "X", "bowler"), (0, 2, 2, "match", "T1", "Sub", "A", None), (1, 1, 1, "match", "T2", "Z", "Y", None), (1, 2, 1, "match", "T1", "A", "Sub", None)}


def test_elevens_at_each_ball(spark):
    parsed = silver.parse(as_bronze(spark, {"m": SWAPPED, "plain": document(players={"T1": ["A"]}, innings=[{"team": "T1", "overs": [{"over": 0, "deliveries": [ball("A", "X")]}]}])}))
    versions = lineup.elevens(lineup.stints(silver.players(parsed), silver.replacements(parsed)))
    balls = lineup.sides(silver.deliveries(parsed), silver.innings(parsed), silver.matches(parsed))
    got = {(r.match_id, r.over_number, r.delivery_number): (r.batting_version, r.batting_eleven, r.fielding_version, r.fielding_eleven, r.batter_in_eleven, r.bowler_in_eleven) for r in lineup.active(balls, versions).collect()}
    assert got == {
        ("m", 0, 1): (0, ["A", "B"], 0, ["X", "Y"], True, True), ("m", 0, 2): (1, ["B", "Sub"], 0, ["X", "Y"], False, True), ("m", 0, 3): (1, ["B", "Sub"], 0, ["X", "Y"], True, True),
        ("m", 1, 1): (1, ["B", "Sub"], 1, ["X", "Z"], True, False), ("m", 1, 2): (2, ["A", "B"], 1, ["X", "Z"], True, False),
        ("plain", 0, 1): (0, ["A"], None, None, True, False),
    }


def test_stints_against_a_walk_through_the_balls(spark):
    rng = random.Random(7)
    people, events = "ABCDEF", []
    for m in range(30):
        for k in sorted(rng.sample(range(40), 8)):
            events.append((str(m), 1, k // 6, k % 6 + 1, 1, "match", "T", rng.choice(people), rng.choice([*people, None])))
    named = [(str(m), "T", p) for m in range(30) for p in "ABCD"]
    swaps = spark.createDataFrame(events, "match_id string, innings_number int, over_number int, delivery_number int, replacement_number int, scope string, team string, player_in string, player_out string")
    versions = lineup.elevens(lineup.stints(spark.createDataFrame(named, "match_id string, team string, player_name string"), swaps)).collect()
    for m in map(str, range(30)):
        own = [e for e in events if e[0] == m]
        first = {}
        for e in own:
            for p, enters in ((e[8], False), (e[7], True)):
                if p and (p not in first or first[p][0] == e[2:4]):
                    first[p] = (e[2:4], max(enters, first[p][1]) if p in first else enters)
        now = {p for p in {*"ABCD", *[p for p, (_, enters) in first.items() if not enters]} if not first.get(p, (0, False))[1]}
        walked = [(None, sorted(now))]
        for e in own:
            after = (now - {e[8]}) | {e[7]}  # of one player's two events of a ball, coming in counts
            if after != now:
                walked.append(((1, *e[2:4]), sorted(after)))
            now = after
        assert [(r.from_ball and tuple(r.from_ball), r.players) for r in sorted((r for r in versions if r.match_id == m), key=lambda r: r.version)] == walked


# -- keyed tables ---------------------------------------------------------------------------------


def test_linear_hashing_splits_one_bucket_at_a_time(spark):
    for n in (1, 2, 3, 4, 7, 12, 16):
        a, b = (tables.bucket_of(["id"], k).alias(name) for k, name in ((n, "a"), (n + 1, "b")))
        moved = {(r.a, r.b) for r in spark.range(3000).select(a, b).where("a <> b").distinct().collect()}
        assert moved == {(tables.split_from(n, n), n)}  # only the new bucket is entered, and from one other
    assert [tables.split_from(b, 3) for b in range(3, 9)] == [1, 0, 1, 2, 1, 0]


def test_table_that_grows_a_hundred_times(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    path, rows = str(tmp_path / "t"), {}
    frame = lambda d: spark.createDataFrame(sorted(d.items()), "k long, v string")
    read = lambda: {r.k: r.v for r in tables.read_keyed(spark, path).collect()}
    rows |= {k: "first" for k in range(60)}
    tables.create_keyed(frame(rows), path, ["k"])
    assert tables.layout(spark, path) == 1 and read() == rows
    for step, (lo, hi) in enumerate(((40, 500), (450, 1500), (0, 10), (1400, 6000))):
        new = {k: f"step {step}" for k in range(lo, hi)}
        assert tables.keyed_replace(frame(new), path, ["k"]) == len(new)
        rows |= new
        assert read() == rows and tables.rows_about(spark, path) == len(rows)
    n = tables.layout(spark, path)
    assert 60 <= n <= 90
    sizes = [r["count"] for r in spark.read.parquet(path).where("not __void").groupBy("__bucket").count().collect()]
    assert len(sizes) == n and max(sizes) < 400
    tables.keyed_replace(frame({}), path, ["k"], scope=spark.range(3000).withColumnRenamed("id", "k"))
    assert read() == {k: v for k, v in rows.items() if k >= 3000} and tables.layout(spark, path) == n
    some = spark.createDataFrame([(3001,), (5999,), (7,)], "k long")
    assert {r.k for r in tables.for_key_buckets(spark, path, ["k"], some).collect()} == {3001, 5999}


def test_many_buckets_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "NAMED_BUCKETS", 2)
    path = str(tmp_path / "t")
    tables.create_keyed(spark.range(100).withColumn("v", F.lit(1)), path, ["id"], 16)
    tables.upsert(spark.range(50, 120).withColumn("v", F.lit(2)), path, ["id"])
    assert tables.read_keyed(spark, path).groupBy("v").count().orderBy("v").collect() == [(1, 50), (2, 70)]


def test_a_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(20_000).select(F.when(F.col("id") < 10_000, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 40)).alias("part"), (F.col("id") * 7919 % 20_000).alias("k"), F.lit("2024-02-03").cast("date").alias("day"))
    path = str(tmp_path / "t")
    assert tables.write_laid_out(df, path, tables.by("part", order=("k",)), file_rows=1000) == 20_000
    files = spark.read.parquet(path).groupBy("part", F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).collect()
    hot = sorted((r.low, r.high) for r in files if r.part == "hot")
    assert 8 <= len(hot) <= 13 and all(a[1] < b[0] for a, b in zip(hot, hot[1:], strict=False))
    assert sum(r.part != "hot" for r in files) < 60  # small partitions share tasks and are not cut to pieces
    spec = tables.Layout((("month", "month", "day", None), ("b", "bucket", "k", 4), ("p", "truncate", "part", 1), ("d", "day", "day", None), ("y", "year", "day", None)), ("k",))
    out = spec.with_partitions(df)
    assert {(r.month, r.p, str(r.d), r.y) for r in out.select("month", "p", "d", "y").distinct().collect()} == {("2024-02", "h", "2024-02-03", 2024), ("2024-02", "p", "2024-02-03", 2024)}
    tables.write_laid_out(df.where("part = 'p1'").withColumn("k", F.lit(-1)), path, tables.by("part", order=("k",)), overwrite_touched=True)
    assert spark.read.parquet(path).where("part = 'p1'").agg(F.max("k")).first()[0] == -1 and spark.read.parquet(path).count() == 20_000


# -- histories ------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_history_in_any_order_of_arrival(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(k, day, rng.choice(["a", "b", None]), rng.choice([1, 1, 2])) for k in ("p", "q", None, "r") for day in range(12) if rng.random() < 0.7]
    rows += [("p", 3, "tie", 9), ("p", 3, "tie", 1)]
    ddl, path = "k string, day int, name string, kind int", str(tmp_path / "h")
    days = list(range(12))
    rng.shuffle(days)
    for part in (days[:4], days[4:5], days[5:9], days[9:]):
        batch = [r for r in rows if r[1] in part]
        if batch:
            history.merge_snapshot(spark.createDataFrame(batch, ddl), path, "k", "day", "name", "kind")
    show = lambda df: sorted((tuple(r) for r in df.select("k", "name", "kind", "valid_from", "valid_to", "is_current").collect()), key=str)
    want = show(control.scd2(spark.createDataFrame(rows, ddl), "k", "day", "name", "kind"))
    assert show(history.history(spark, path)) == want
    again = spark.createDataFrame([r for r in rows if r[1] == days[0]], ddl)
    history.merge_snapshot(again, path, "k", "day", "name", "kind")  # delivered once more
    assert show(history.history(spark, path)) == want
    by_hand = {}
    for k, day, name, kind in sorted(rows, key=lambda r: (r[1], r[2] or "", r[3])):
        if day <= 6:
            by_hand[k] = (name, kind)
    assert {r.k: (r.name, r.kind) for r in history.as_of(spark, path, 6).collect()} == by_hand


def test_corrected_snapshot_joins_versions(spark, tmp_path):
    path = str(tmp_path / "h")
    for day, v in ((1, "a"), (2, "b"), (3, "a"), (2, "a")):
        history.merge_snapshot(spark.createDataFrame([("k", day, v)], "k string, day int, v string"), path, "k", "day", "v")
    assert [tuple(r) for r in history.history(spark, path).collect()] == [("k", "a", 1, None, True)]


# -- Silver by scope --------------------------------------------------------------------------------

NONE = "identifier string, source_system string, source_identifier string"


def whole(spark, folder):
    t = build.silver_tables(spark, folder)
    return {n: sorted((tuple(map(str, r)) for r in t[n].collect())) for n in build.WHOLE}


def expected(df):
    parsed = silver.parse(df)
    return {n: sorted(tuple(map(str, r)) for r in getattr(silver, n)(parsed).collect()) for n in build.WHOLE}


def test_scoped_runs_equal_a_full_one(spark, tmp_path):
    ids, names = spark.createDataFrame([], NONE), spark.createDataFrame([], "identifier string, name string")
    event = lambda g: {"name": "Cup", "group": g}
    docs = {f"m{i}": document(teams=(f"T{i % 3}", f"T{i % 3 + 1}"), venue=f"V{i % 2}", city=None if i % 4 else "C", event=event("AB"[i % 2]) if i % 3 else None) for i in range(8)}
    folder, df = str(tmp_path / "s"), as_bronze(spark, docs)
    run = lambda df, *m: build.build_silver(df, ids, names, folder, df.where(F.col("match_id").isin(*m)).select("match_id").distinct() if m else None)
    run(df, "m0", "m1")
    assert whole(spark, folder) == expected(df)  # all of Bronze, though two matches are in scope
    assert build.silver_tables(spark, folder)["matches"].count() == 2
    # a corrected match drops a team, a venue and a group; a new one adds some
    df = df.unionByName(as_bronze(spark, {"m1": document(teams=("T9", "T8"), venue="V9", city="Z"), "m8": document(venue="V0", city="New", event=event("C"))}, "2", "2024-01-05"))
    written = run(df, "m1")
    assert whole(spark, folder) == expected(df) and 0 < written["teams"] < 8
    assert dict.fromkeys(build.WHOLE, 0) == {n: x for n, x in run(df, "m1").items() if n in build.WHOLE}  # nothing changed: nothing is written
    run(df)
    assert whole(spark, folder) == expected(df) and build.silver_tables(spark, folder)["matches"].count() == 9
    df = df.where("match_id <> 'm8'")  # gone from Bronze
    run(df, "m2")
    assert whole(spark, folder) == expected(df)


def test_names_are_parsed_without_innings(spark):
    df = as_bronze(spark, {"m": document()})
    plan = silver.mentions(silver.parse_names(df))._jdf.queryExecution().optimizedPlan().toString()
    assert "deliveries" not in plan and "team_type" in plan


def test_a_run_that_breaks_off_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    docs = {f"m{i}": document(teams=("A", f"B{i}"), event={"name": "Cup", "group": "A"}) for i in range(4)}
    df, folder = as_bronze(spark, {k: docs[k] for k in ("m0", "m1")}), str(tmp_path / "s")
    build.update_whole(df, folder)
    df = df.unionByName(as_bronze(spark, {"m2": docs["m2"], "m3": docs["m3"]})).unionByName(as_bronze(spark, {"m0": document(teams=("A", "New"))}, "2"))
    put, calls = build.put, itertools.count()

    def breaks(*args):
        if next(calls) == 2:
            raise RuntimeError("lost")
        return put(*args)

    monkeypatch.setattr(build, "put", breaks)
    with pytest.raises(RuntimeError):
        build.update_whole(df, folder)
    monkeypatch.setattr(build, "put", put)
    build.update_whole(df, folder)
    got = {n: sorted(tuple(map(str, r)) for r in tables.read_keyed(spark, f"{folder}/{n}").collect()) for n in build.WHOLE}
    assert got == expected(df)
    counts = {(r.kind, r.name): r.n for r in tables.read_keyed(spark, f"{folder}/mention_counts").groupBy("kind", "name").agg(F.sum("n").alias("n")).collect()}
    assert counts[("teams", "A")] == 4 and ("teams", "B0") not in counts
