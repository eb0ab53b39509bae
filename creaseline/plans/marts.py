"""Marts over Gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.functions import metrics as M
from creaseline.plans.gold import Tables

LEGAL, DOT, OUT, CREDIT = "is_legal_ball", "is_dot_ball", "is_wicket", "is_bowler_wicket"


def count(flag: str | Column, name: str) -> Column:
    return M.total(F.col(flag) if isinstance(flag, str) else flag).alias(name)


def hits(runs: int) -> Column:
    return F.col("runs_batter") == runs


def batting_innings(f: DataFrame, *keys: str) -> DataFrame:
    """Runs, balls and hits of each batter's innings."""
    return f.groupBy(*keys).agg(F.sum("runs_batter").alias("innings_runs"), count(LEGAL, "balls_faced"), count(hits(4), "fours"), count(hits(6), "sixes"), F.bool_or("is_wicket").alias("was_dismissed"))


def player_batting(t: Tables) -> DataFrame:
    one = batting_innings(t["fact_delivery"].where("batter_person_id is not null"), "batter_person_id", "batter", "match_id", "innings_number", "match_type", "season")
    out = one.groupBy(F.col("batter_person_id").alias("person_id"), F.col("batter").alias("player_name"), "match_type", "season").agg(
        F.count(F.lit(1)).alias("innings"), F.sum("innings_runs").alias("total_runs"), F.sum("balls_faced").alias("total_balls"), F.sum("fours").alias("total_fours"), F.sum("sixes").alias("total_sixes"),
        F.max("innings_runs").alias("highest_score"), count(F.col("innings_runs") >= 50, "fifties"), count(F.col("innings_runs") >= 100, "hundreds"), count("was_dismissed", "dismissals"),
    )
    return out.withColumns({"batting_average": M.average("total_runs", "dismissals"), "strike_rate": M.strike_rate("total_runs", "total_balls")})


def player_bowling(t: Tables) -> DataFrame:
    spell = t["fact_delivery"].where("bowler_person_id is not null").groupBy("bowler_person_id", "bowler", "match_id", "innings_number", "match_type", "season").agg(count(LEGAL, "balls"), F.sum("runs_total").alias("runs"), count(CREDIT, "won"))
    out = spell.groupBy(F.col("bowler_person_id").alias("person_id"), F.col("bowler").alias("player_name"), "match_type", "season").agg(
        F.count(F.lit(1)).alias("innings_bowled"), F.sum("balls").alias("total_balls"), F.sum("runs").alias("total_runs"), F.sum("won").alias("total_wickets"), F.max("won").alias("best_innings_wickets"),
    )
    return out.withColumns({"overs_bowled": M.overs("total_balls"), "economy_rate": M.economy("total_runs", "total_balls"), "bowling_average": M.average("total_runs", "total_wickets"), "bowling_strike_rate": M.ratio("total_balls", "total_wickets")})


def team_performance(t: Tables, fix: bool = False) -> DataFrame:
    """fix counts ordinary wins of the other side as losses; without it a null result leaves losses at 0, as the source's rule does."""
    sides = t["matches"].select("match_type", "season", F.explode(F.array("team_a", "team_b")).alias("team"), "winner", "outcome_result", "toss_winner").where("team is not null")
    result = F.coalesce("outcome_result", F.lit("")) if fix else F.col("outcome_result")
    lost = F.col("winner").isNotNull() & (F.col("winner") != F.col("team")) & ~result.isin("tie", "no result")
    out = sides.groupBy("team", "match_type", "season").agg(
        F.count(F.lit(1)).alias("matches_played"), count(F.col("winner") == F.col("team"), "wins"), count(lost, "losses"), count(F.col("outcome_result") == "tie", "ties"),
        count(F.col("outcome_result") == "no result", "no_results"), count(F.col("toss_winner") == F.col("team"), "toss_wins"),
    )
    return out.withColumn("win_pct", M.percentage("wins", "matches_played"))


def venue_dna(t: Tables, fix: bool = False) -> DataFrame:
    """fix takes every match with a winner as decided; without it only results named `win`, which the source never emits."""
    m = t["matches"].where("venue is not null")
    scored = t["fact_innings"].drop("match_type", "season", "gender", "venue").join(m.select("match_id", "venue", "match_type"), "match_id")
    mean = lambda i: M.rounded(F.avg(F.when(F.col("innings_number") == i, F.col("total_runs"))), 1)
    a = scored.groupBy("venue", "match_type").agg(F.count_distinct("match_id").alias("matches"), mean(1).alias("avg_first_innings_score"), mean(2).alias("avg_second_innings_score"), *[F.sum(c).alias(c) for c in ("total_runs", "legal_balls", "boundaries", "sixes")])
    a = a.withColumns({"overall_run_rate": M.run_rate("total_runs", "legal_balls"), "boundary_pct": M.percentage("boundaries", "legal_balls"), "six_pct": M.percentage("sixes", "legal_balls")}).drop("total_runs", "legal_balls", "boundaries", "sixes")
    decided = m.where("winner is not null") if fix else m.where("winner is not null and outcome_result = 'win'")
    second = t["innings"].where("innings_number = 2").select("match_id", "team")
    c = decided.join(second, "match_id").groupBy("venue", "match_type").agg(F.count(F.lit(1)).alias("chasing_matches"), count(F.col("team") == F.col("winner"), "chasing_wins"))
    return a.join(c, ["venue", "match_type"], "left").withColumn("chasing_win_pct", M.percentage("chasing_wins", "chasing_matches"))


def phase_scoring(t: Tables) -> DataFrame:
    f = t["fact_delivery"].withColumn("phase", M.phase(F.col("match_type"), F.col("over_number"))).where("phase is not null")
    out = f.groupBy("match_type", "season", "phase").agg(
        F.count(F.lit(1)).alias("total_deliveries"), count(LEGAL, "legal_balls"), F.sum("runs_total").alias("total_runs"), count(F.col("runs_batter").isin(4, 6), "b"), count(DOT, "d"), count(OUT, "wickets"),
    )
    share = {"run_rate": M.run_rate("total_runs", "legal_balls"), "boundary_pct": M.percentage("b", "legal_balls"), "dot_ball_pct": M.percentage("d", "legal_balls"), "wicket_pct": M.percentage("wickets", "legal_balls")}
    return out.withColumns(share).drop("b", "d")


def toss_outcome(t: Tables) -> DataFrame:
    m = t["matches"].where("toss_winner is not null and toss_decision is not null")
    won = F.col("toss_winner") == F.col("winner")
    chose = lambda x: F.col("toss_decision") == x
    out = m.groupBy("match_type", "season", "toss_decision").agg(
        F.count(F.lit(1)).alias("matches"), count(won, "toss_winner_won"), count(chose("bat"), "chose_bat"), count(chose("field"), "chose_field"), count(chose("bat") & won, "bat_first_and_won"), count(chose("field") & won, "field_first_and_won"),
    )
    return out.withColumn("toss_win_match_win_pct", M.percentage("toss_winner_won", "matches"))


def matchup_analysis(t: Tables, least: int = 6) -> DataFrame:
    f = t["fact_delivery"].where("batter_person_id is not null and bowler_person_id is not null")
    out = f.groupBy("batter_person_id", F.col("batter").alias("batter_name"), "bowler_person_id", F.col("bowler").alias("bowler_name"), "match_type").agg(
        F.count(F.lit(1)).alias("balls_faced"), count(LEGAL, "legal_balls"), F.sum("runs_batter").alias("runs_scored"), count(DOT, "dot_balls"), count(hits(4), "fours"), count(hits(6), "sixes"), count(OUT, "dismissals"),
    )
    return out.where(F.col("balls_faced") >= least).withColumns({"strike_rate": M.strike_rate("runs_scored", "legal_balls"), "dot_ball_pct": M.percentage("dot_balls", "legal_balls")})
