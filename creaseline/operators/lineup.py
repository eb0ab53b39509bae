"""Who is in the eleven at each ball: a timeline of replacements for each match and side, and the as-of join of balls to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.operators.silver import BALL_KEY, both_teams, changed_team, changes

SIDE = ("match_id", "team")


def moment(innings: str = "innings_number", over: str = "over_number", ball: str = "delivery_number") -> Column:
    """A ball's place in its match; structs compare field by field."""
    return F.struct(F.col(innings).alias("innings_number"), F.col(over).alias("over_number"), F.col(ball).alias("delivery_number"))


def stints(players: DataFrame, replacements: DataFrame) -> DataFrame:
    """When each player of a side is in the eleven: one row a stint, from a ball (null: from the start) until before a ball (null: to the end).

    players (match_id, team, player_name) are all that a side names, replacements as Silver has them; those of roles change no eleven.
    A player whose first event is to come in was not in the eleven at the start, named or not. Events that change nothing
    (in while in, out while out) are left out; of the events of one ball the last counts.
    """
    both = F.array(F.struct(F.lit(True).alias("enters"), F.col("player_in").alias("player_name")), F.struct(F.lit(False).alias("enters"), F.col("player_out").alias("player_name")))
    swaps = replacements.where("scope = 'match' and team is not null")
    events = swaps.select(*SIDE, moment().alias("at"), "replacement_number", F.explode(both).alias("e")).select(*SIDE, "at", "replacement_number", "e.*").where("player_name is not null")
    last = events.groupBy(*SIDE, "player_name", "at").agg(F.max_by("enters", F.struct("replacement_number", "enters")).alias("enters"))
    # the start: in, unless the first event is to come in
    first = last.groupBy(*SIDE, "player_name").agg(F.min_by("enters", "at").alias("enters")).where("enters").drop("enters")
    named = players.select(*SIDE, "player_name").distinct().unionByName(last.where("not enters").select(*SIDE, "player_name")).distinct()
    start = named.join(first, [*SIDE, "player_name"], "left_anti").withColumn("at", F.lit(None).cast(last.schema["at"].dataType)).withColumn("enters", F.lit(True))
    line = W.partitionBy(*SIDE, "player_name").orderBy(F.col("at").asc_nulls_first())
    turns = start.unionByName(last).withColumn("before", F.lag("enters").over(line)).where("before is null or before <> enters").withColumn("until", F.lead("at").over(line))
    return turns.where("enters").select(*SIDE, "player_name", F.col("at").alias("from_ball"), F.col("until").alias("until_ball"))


def elevens(stint_rows: DataFrame) -> DataFrame:
    """The versions of each side's eleven: from_ball (null: the start), version from 0, players. One row for each ball that changes it, so the rows of a side stay few."""
    edges = F.array_distinct(F.array(F.lit(None).cast(stint_rows.schema["from_ball"].dataType), F.col("from_ball"), F.col("until_ball")))
    side = stint_rows.withColumn("edge", F.explode(edges)).groupBy(*SIDE).agg(F.sort_array(F.collect_set("edge")).alias("edges"), F.collect_list(F.struct("player_name", "from_ball", "until_ball")).alias("stints"))
    start = F.array(F.lit(None).cast(stint_rows.schema["from_ball"].dataType))
    versions = side.select(*SIDE, "stints", F.posexplode(F.concat(start, "edges")).alias("version", "from_ball"))
    here = lambda s: (s["from_ball"].isNull() | (s["from_ball"] <= F.col("from_ball"))) & (s["until_ball"].isNull() | F.coalesce(s["until_ball"] > F.col("from_ball"), F.lit(True)))
    in_it = F.filter("stints", lambda s: F.coalesce(here(s), s["from_ball"].isNull()))
    return versions.select(*SIDE, "version", "from_ball", F.array_sort(F.array_distinct(F.transform(in_it, lambda s: s["player_name"]))).alias("players"))


def active(balls: DataFrame, versions: DataFrame) -> DataFrame:
    """Balls with the elevens in force: version, size and players of both sides, and whether batter and bowler belong to them.

    balls (the ball key, batter, bowler, batting_team, fielding_team) meet the versions of their match once: a side's versions are one
    array, of which the last that began at or before the ball counts.
    """
    held = versions.groupBy(*SIDE).agg(F.sort_array(F.collect_list(F.struct("version", "from_ball", "players"))).alias("versions"))
    out = balls
    for side in ("batting", "fielding"):
        own = held.select("match_id", F.col("team").alias(f"{side}_team"), F.col("versions").alias(f"{side}_versions"))
        out = out.join(own, ["match_id", f"{side}_team"], "left")
    return in_force(out)


def in_force(balls: DataFrame) -> DataFrame:
    """Balls that hold the versions of both sides, with those that stand at them."""
    out = balls
    now = moment()
    for side in ("batting", "fielding"):
        versions = F.col(f"{side}_versions")
        began = F.filter(versions, lambda v: v["from_ball"].isNull() | (v["from_ball"] <= now))
        alone = (F.size(versions) == 1) & F.get(versions, 0)["from_ball"].isNull()  # most sides never change
        out = out.withColumn(f"{side}_now", F.when(alone, F.get(versions, 0)).otherwise(F.try_element_at(began, F.lit(-1))))
    belongs = lambda name, side: F.coalesce(F.array_contains(F.col(f"{side}_now.players"), F.col(name)), F.lit(False))
    return out.select(
        *BALL_KEY, "batting_team", "fielding_team", "batter", "bowler",
        *[c for side in ("batting", "fielding") for c in (F.col(f"{side}_now.version").alias(f"{side}_version"), F.col(f"{side}_now.players").alias(f"{side}_eleven"))],
        belongs("batter", "batting").alias("batter_in_eleven"), belongs("bowler", "fielding").alias("bowler_in_eleven"),
    )


def sides(deliveries: DataFrame, innings: DataFrame, matches: DataFrame) -> DataFrame:
    """Deliveries with batting_team and fielding_team."""
    two = innings.select("match_id", "innings_number", F.col("team").alias("batting_team")).join(matches.select("match_id", "team_a", "team_b"), "match_id")
    other = F.when(F.col("batting_team") == F.col("team_a"), F.col("team_b")).when(F.col("batting_team") == F.col("team_b"), F.col("team_a"))
    return deliveries.join(two.withColumn("fielding_team", other).drop("team_a", "team_b"), ["match_id", "innings_number"])


# -- the same out of whole documents, match by match: no join and no shuffle -------------------------

MOMENT = "struct<innings_number:int,over_number:int,delivery_number:int>"


def active_in_documents(parsed: DataFrame) -> DataFrame:
    """active(sides(deliveries, innings, matches), elevens(stints(players, replacements))) of the parsed documents, in one pass over them.

    A match is one row, so its replacements are one array; what stints() and elevens() say of a side is worked out for each innings
    on arrays, before balls become rows.
    """
    none = F.array().cast("array<string>")
    squads = F.transform(F.map_entries("doc.info.players"), lambda e: F.struct(e["key"].alias("team"), F.array_sort(F.array_distinct(F.coalesce(e["value"], none))).alias("named")))
    rows = parsed.select("match_id", squads.alias("squads"), *both_teams(), "doc.innings", document_swaps().alias("swaps"))
    # outer, because Spark would filter by the size of innings first, and parse a document anew for each mention of it in the filter
    rows = rows.select("match_id", "squads", "team_a", "team_b", "swaps", F.posexplode_outer("innings").alias("place", "inn")).where("place is not null")
    other = F.when(F.col("inn.team") == F.col("team_a"), F.col("team_b")).when(F.col("inn.team") == F.col("team_b"), F.col("team_a"))
    rows = rows.select("match_id", (F.col("place") + 1).alias("innings_number"), F.col("inn.team").alias("batting_team"), other.alias("fielding_team"), "squads", "swaps", "inn.overs")
    for side in ("batting", "fielding"):
        rows = with_versions(rows, side)
    held = ("match_id", "innings_number", "batting_team", "fielding_team", "batting_versions", "fielding_versions")
    over = rows.select(*held, F.explode("overs").alias("o"))
    ball = over.select(*held, F.col("o.over").alias("over_number"), F.posexplode("o.deliveries").alias("ball", "d"))
    return in_force(ball.select(*held, "over_number", (F.col("ball") + 1).alias("delivery_number"), "d.batter", "d.bowler"))


def document_swaps() -> Column:
    """The replacements in the elevens of a whole document, as (team, at, replacement_number, player_in, player_out)."""
    kind = f"array<struct<team:string,at:{MOMENT},replacement_number:int,player_in:string,player_out:string>>"
    none = F.array().cast(kind)

    def of_ball(inn: Column, i: Column, over: Column, d: Column, k: Column) -> Column:
        every = F.concat(*changes(d))
        at = F.struct((i + 1).alias("innings_number"), over["over"].alias("over_number"), (k + 1).alias("delivery_number"))
        one = lambda r, n: F.struct(changed_team(r, d["batter"], d["non_striker"], inn["team"], F.col("doc.info.teams")).alias("team"), at.alias("at"), (n + 1).alias("replacement_number"), r["in"].alias("player_in"), r["out"].alias("player_out"), r["scope"].alias("scope"))
        kept = F.filter(F.transform(every, one), lambda s: (s["scope"] == "match") & s["team"].isNotNull())
        return F.when(d["replacements"].isNotNull(), F.transform(kept, lambda s: s.dropFields("scope")).cast(kind)).otherwise(none)

    of_over = lambda inn, i: lambda o: F.coalesce(F.flatten(F.transform(o["deliveries"], lambda d, k: of_ball(inn, i, o, d, k))), none)
    of_innings = lambda inn, i: F.coalesce(F.flatten(F.transform(inn["overs"], of_over(inn, i))), none)
    return F.coalesce(F.flatten(F.transform("doc.innings", of_innings)), none)


def with_versions(rows: DataFrame, side: str) -> DataFrame:
    """rows (a side's name as <side>_team, squads, swaps) with <side>_versions, null if nobody belongs to the side."""
    team, own, named, turns, stays = F.col(f"{side}_team"), f"__{side}_own", f"__{side}_named", f"__{side}_turns", f"__{side}_stints"
    none, null, start = F.array().cast("array<string>"), F.lit(None), F.array(F.lit(None).cast(MOMENT))
    squad = F.filter("squads", lambda e: e["team"] == team)
    changes = F.filter("swaps", lambda s: s["team"] == team)
    rows = rows.withColumns({named: squad, own: F.when(F.size("swaps") > 0, changes)})
    several = F.array_sort(F.array_distinct(F.flatten(F.transform(named, lambda e: e["named"]))))
    rows = rows.withColumns({named: F.when(F.size(named) <= 1, F.coalesce(F.get(named, 0)["named"], none)).otherwise(F.coalesce(several, none)), own: F.when(F.size(own) > 0, F.col(own))})
    # from here on null where nothing changes, so that nothing is worked out for most sides
    both = lambda s: F.array(*[F.struct(name.alias("player_name"), s["at"].alias("at"), s["replacement_number"].alias("n"), F.lit(enters).alias("enters")) for name, enters in ((s["player_in"], True), (s["player_out"], False))])
    rows = rows.withColumn(turns, F.array_sort(F.filter(F.flatten(F.transform(own, both)), lambda e: e["player_name"].isNotNull())))
    near = lambda i, by: F.get(F.col(turns), i + by)
    # of the events of one ball the last counts, and those that change nothing are left out
    rows = rows.withColumn(turns, F.filter(turns, lambda e, i: ~F.coalesce((near(i, 1)["player_name"] == e["player_name"]) & (near(i, 1)["at"] == e["at"]), F.lit(False))))
    rows = rows.withColumn(turns, F.filter(turns, lambda e, i: ~F.coalesce((near(i, -1)["player_name"] == e["player_name"]) & (near(i, -1)["enters"] == e["enters"]), F.lit(False))))
    same = lambda e, i, by: F.coalesce(near(i, by)["player_name"] == e["player_name"], F.lit(False))
    stint = lambda name, since, end: F.struct(name.alias("player_name"), since.cast(MOMENT).alias("from_ball"), end.cast(MOMENT).alias("until_ball"))
    # in from the start: who is named and has no event, and whose first event is to go out
    always = F.transform(F.array_except(F.col(named), F.transform(turns, lambda e: e["player_name"])), lambda n: stint(n, null, null))
    later = F.transform(turns, lambda e, i: F.when(e["enters"], stint(e["player_name"], e["at"], F.when(same(e, i, 1), near(i, 1)["at"]))).when(~same(e, i, -1), stint(e["player_name"], null, e["at"])))
    rows = rows.withColumn(stays, F.concat(always, F.filter(later, lambda s: s.isNotNull())))
    edges = F.filter(F.array_sort(F.array_distinct(F.flatten(F.transform(stays, lambda s: F.array(s["from_ball"], s["until_ball"]))))), lambda b: b.isNotNull())
    inside = lambda s, b: F.when(b.isNull(), s["from_ball"].isNull()).otherwise((s["from_ball"].isNull() | (s["from_ball"] <= b)) & (s["until_ball"].isNull() | (s["until_ball"] > b)))
    players = lambda b: F.array_sort(F.array_distinct(F.transform(F.filter(stays, lambda s: inside(s, b)), lambda s: s["player_name"])))
    version = lambda v, b, names: F.struct(v.alias("version"), b.cast(MOMENT).alias("from_ball"), names.alias("players"))
    told = F.transform(F.concat(start, edges), lambda b, v: version(v, b, players(b)))
    whole = F.array(version(F.lit(0), null, F.col(named)))
    return rows.withColumn(f"{side}_versions", F.when(F.size(stays) > 0, told).when(F.size(named) > 0, whole)).drop(own, named, turns, stays)
