"""Gold: dimensions and facts over the Silver tables (`t` maps table names to DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.functions import metrics as M
from creaseline.operators.silver import BALL_KEY

Tables = dict[str, DataFrame]
CONTEXT = ("match_id", "match_type", "season", "gender")
#: Identifier sources that the player dimension shows.
SOURCES = {"cricinfo": "cricinfo_id", "espn": "espn_id", "cricbuzz": "cricbuzz_id", "wikidata": "wikidata_id", "twitter": "twitter_handle", "instagram": "instagram_handle"}


def first_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def dim_match(t: Tables) -> DataFrame:
    return t["matches"].drop("player_of_match", "group_label", "has_missing_data")


def dim_player(t: Tables) -> DataFrame:
    """Each person as its latest snapshot shows it, with the identifiers of six sources."""
    ids = t["person_identifiers"].groupBy(F.col("identifier").alias("person_id")).agg(*[F.max(F.when(F.col("source_system") == s, F.col("source_identifier"))).alias(c) for s, c in SOURCES.items()])
    persons = t["persons"]
    if "_snapshot_date" in persons.columns:
        persons = first_by(persons, ["person_id"], F.col("_snapshot_date").desc())
    stamp = [c for c in ("_snapshot_date",) if c in persons.columns]
    return persons.withColumnRenamed("name", "full_name").join(ids, "person_id", "left").select("person_id", "full_name", "unique_name", *SOURCES.values(), *stamp)


def dim_team(t: Tables) -> DataFrame:
    return first_by(t["teams"].where("team_name is not null"), ["team_name"], F.col("_snapshot_date").desc()).select("team_name", "team_type")


def dim_venue(t: Tables) -> DataFrame:
    latest = first_by(t["venues"].where("venue_name is not null"), ["venue_name"], F.col("_snapshot_date").desc(), F.col("city").asc_nulls_last())
    return latest.select("venue_name", "city")


def dim_competition(t: Tables) -> DataFrame:
    return t["competitions"].where("competition_name is not null").select("competition_name").distinct()


def dim_date(spark: SparkSession, first: str = "1970-01-01", last: str = "2035-12-31") -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))).alias("d"))
    return days.select(*[c.alias(n) for n, c in M.date_parts(F.col("d")).items()])


def player_display_names(t: Tables) -> DataFrame:
    names = t["match_players"].where("player_name is not null").groupBy(F.col("player_name").alias("cricsheet_name")).agg(F.min("person_id").alias("person_id"))
    out = names.join(t["aliases"], "cricsheet_name", "left").join(dim_player(t).select("person_id", "full_name", "unique_name"), "person_id", "left")
    return out.select("cricsheet_name", F.coalesce("display_name", "full_name", "cricsheet_name").alias("display_name"), F.coalesce("unique_name", "cricsheet_name").alias("unique_name"), "person_id")


def fact_delivery(t: Tables) -> DataFrame:
    """One row a ball. The joined sides are unique by construction, so Catalyst drops those whose columns a reader does not take."""
    people = t["match_players"].groupBy("match_id", "player_name").agg(F.min("person_id").alias("person_id"))
    rank = F.when(F.col("kind").isin(*M.BOWLER_KINDS), 0).otherwise(1)
    fell = t["wickets"].groupBy(*BALL_KEY).agg(F.min(F.struct(rank.alias("rank"), "kind", "player_out")).alias("w"))
    fell = fell.select(*BALL_KEY, F.col("w.kind").alias("dismissal_kind"), F.col("w.player_out").alias("player_out"))
    who = lambda role: people.select("match_id", F.col("player_name").alias(role), F.col("person_id").alias(f"{role}_person_id"))
    d = t["deliveries"].join(dim_match(t).select(*CONTEXT), "match_id").join(fell, list(BALL_KEY), "left")
    d = d.join(who("batter"), ["match_id", "batter"], "left").join(who("bowler"), ["match_id", "bowler"], "left")
    return d.select(
        *BALL_KEY, "batter", "batter_person_id", "bowler", "bowler_person_id", "non_striker", "runs_batter", "runs_extras", "runs_total", "runs_non_boundary",
        *[f"extra_{e}" for e in ("wides", "noballs", "byes", "legbyes", "penalty")], "is_wicket", "dismissal_kind", "player_out",
        F.coalesce(F.col("dismissal_kind").isin(*M.BOWLER_KINDS), F.lit(False)).alias("is_bowler_wicket"),
        (F.col("extra_wides").isNull() & F.col("extra_noballs").isNull()).alias("is_legal_ball"),
        ((F.col("runs_batter") == 0) & F.col("extra_wides").isNull()).alias("is_dot_ball"), "match_type", "season", "gender", "_snapshot_date",
    )


def fact_innings(t: Tables, by_format: bool = False) -> DataFrame:
    """by_format divides by the match's balls per over; without it every over has six."""
    totals = t["fact_delivery"].groupBy("match_id", "innings_number").agg(
        F.sum("runs_total").alias("total_runs"), M.total(F.col("is_legal_ball")).alias("legal_balls"), M.total(F.col("is_wicket")).alias("wickets_fallen"),
        M.total(F.col("runs_batter").isin(4, 6)).alias("boundaries"), M.total(F.col("runs_batter") == 6).alias("sixes"),
    )
    out = t["innings"].join(dim_match(t).select(*CONTEXT, "venue", "balls_per_over"), "match_id").join(totals, ["match_id", "innings_number"], "left")
    per = F.coalesce("balls_per_over", F.lit(6)).cast("double") if by_format else F.lit(6.0)
    balls = F.col("legal_balls").cast("double")
    return out.withColumns({"overs_faced": M.rounded(balls / per, 1), "run_rate": M.rounded(F.col("total_runs") * per / F.when(balls != 0, balls), 2)}).drop("balls_per_over")


def fact_match_result(t: Tables) -> DataFrame:
    loser = F.when(F.col("winner") == F.col("team_a"), F.col("team_b")).when(F.col("winner") == F.col("team_b"), F.col("team_a"))
    return dim_match(t).drop("balls_per_over", "limit_overs", "event_number").withColumns({"toss_winner_won": F.col("toss_winner") == F.col("winner"), "loser": loser})


def fact_player_match(t: Tables) -> DataFrame:
    f = t["fact_delivery"]
    bat = f.where("batter_person_id is not null").groupBy("match_id", F.col("batter_person_id").alias("person_id")).agg(
        F.sum("runs_batter").alias("runs_scored"), M.total(F.col("is_legal_ball")).alias("balls_faced"), M.total(F.col("runs_batter") == 4).alias("fours"),
        M.total(F.col("runs_batter") == 6).alias("sixes"), F.bool_or("is_wicket").alias("was_dismissed"),
    )
    bowl = f.where("bowler_person_id is not null").groupBy("match_id", F.col("bowler_person_id").alias("person_id")).agg(
        M.total(F.col("is_legal_ball")).alias("balls_bowled"), F.sum("runs_total").alias("runs_conceded"), M.total(F.col("is_bowler_wicket")).alias("wickets_taken"),
    )
    out = t["match_players"].select("match_id", "person_id", "player_name", "team", "_snapshot_date").join(dim_match(t).select(*CONTEXT, "venue"), "match_id")
    out = out.join(bat, ["match_id", "person_id"], "left").join(bowl, ["match_id", "person_id"], "left")
    out = out.withColumns({"batting_strike_rate": M.strike_rate("runs_scored", "balls_faced"), "economy_rate": M.economy("runs_conceded", "balls_bowled")})
    out = out.na.fill(0, ["runs_scored", "balls_faced", "fours", "sixes", "balls_bowled", "runs_conceded", "wickets_taken"]).na.fill(False, ["was_dismissed"])
    return out.withColumn("overs_bowled", M.overs("balls_bowled"))


def fact_player_of_match(t: Tables) -> DataFrame:
    return t["matches"].select("match_id", F.explode("player_of_match").alias("player_name"), "_snapshot_date").groupBy("match_id", "player_name").agg(F.min("_snapshot_date").alias("_snapshot_date"))


def pending(df: DataFrame, audit: DataFrame, key: str = "match_id") -> DataFrame:
    """Incremental scope: rows of matches that no Gold run has stamped."""
    return df.join(open_matches(audit, key), key, "left_semi")


def open_matches(audit: DataFrame, key: str = "match_id") -> DataFrame:
    return audit.where("gold_loaded_at is null").select(key).distinct()


def names_in_scope(matches: DataFrame, audit: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    """The values (teams of both sides, venues, competitions) that open matches mention."""
    return names_of(pending(matches, audit), columns, name)


def names_of(matches: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    return matches.select(F.explode(F.array(*columns)).alias(name)).where(F.col(name).isNotNull()).distinct()


#: Models that are built for open matches only, with the key by which they are replaced or updated.
INCREMENTAL = {
    "dim_match": (dim_match, ["match_id"]), "dim_team": (dim_team, ["team_name"]), "dim_venue": (dim_venue, ["venue_name"]), "dim_competition": (dim_competition, ["competition_name"]),
    "fact_delivery": (fact_delivery, list(BALL_KEY)), "fact_innings": (fact_innings, ["match_id", "innings_number"]), "fact_match_result": (fact_match_result, ["match_id"]),
    "fact_player_match": (fact_player_match, ["match_id", "player_name", "team"]), "fact_player_of_match": (fact_player_of_match, ["match_id", "player_name"]),
}
