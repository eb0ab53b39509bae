"""Report queries over Gold: functions of the tables and their parameters. Leaderboards have total orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.functions import metrics as M
from creaseline.plans.gold import Tables, dim_match, dim_player
from creaseline.plans.marts import CREDIT, LEGAL, count

def top(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def down(c: str):
    return F.col(c).desc_nulls_last()


def total_runs(name: str = "runs"):
    return F.sum("runs_batter").alias(name)


def counters(t: Tables) -> DataFrame:
    m = dim_match(t).agg(F.count(F.lit(1)).alias("total_matches"), F.count_distinct("season").alias("total_seasons"))
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return m.crossJoin(one(t["fact_delivery"], "total_deliveries")).crossJoin(one(dim_player(t), "total_players"))  # one row each


def matches_per_year(t: Tables) -> DataFrame:
    return dim_match(t).where("match_date is not null").groupBy(F.year("match_date").alias("year")).agg(F.count(F.lit(1)).alias("matches")).orderBy("year")


def format_breakdown(t: Tables) -> DataFrame:
    return dim_match(t).groupBy(F.col("match_type").alias("format")).agg(F.count(F.lit(1)).alias("matches")).orderBy(down("matches"), "format")


def top_venues(t: Tables, n: int = 10) -> DataFrame:
    return top(dim_match(t).where("venue is not null").groupBy("venue").agg(F.count(F.lit(1)).alias("matches")), n, down("matches"), "venue")


def top_run_scorers(t: Tables, n: int = 10) -> DataFrame:
    f = t["fact_delivery"].where("batter is not null").groupBy(F.col("batter").alias("player"))
    return top(f.agg(total_runs(), count(LEGAL, "balls"), F.count_distinct("match_id").alias("matches")), n, down("runs"), "player")


def top_wicket_takers(t: Tables, n: int = 10) -> DataFrame:
    f = t["fact_delivery"].where("bowler is not null").groupBy(F.col("bowler").alias("player"))
    return top(f.agg(count(CREDIT, "wickets"), F.count_distinct("match_id").alias("matches")), n, down("wickets"), "player")


def highest_score(t: Tables) -> DataFrame:
    one = t["fact_delivery"].where("batter is not null").groupBy(F.col("batter").alias("player"), "match_id", "innings_number", "match_type").agg(total_runs("score"))
    return top(one, 1, down("score"), "player", "match_id", "innings_number").select("player", "score", "match_type")


def highest_score_mart(t: Tables) -> DataFrame:
    return top(t["mart_player_batting"], 1, down("highest_score"), "player_name", "match_type", "season").select("player_name", "highest_score", "match_type")


def season_leader(mart: DataFrame, measure: str) -> DataFrame:
    latest = mart.agg(F.max("season").alias("season"))
    return top(mart.join(F.broadcast(latest), "season"), 1, down(measure), "player_name", "match_type").select("player_name", measure)  # latest is one row


def top_matchups(t: Tables, n: int = 25, least: int = 30) -> DataFrame:
    g = t["fact_delivery"].where("batter is not null and bowler is not null").groupBy("batter", "bowler", "match_type")
    out = g.agg(count(LEGAL, "balls"), total_runs(), count(CREDIT, "dismissals")).where(F.col("balls") >= least)
    return top(out.withColumn("strike_rate", M.strike_rate("runs", "balls")), n, down("balls"), "batter", "bowler", "match_type")


def top_matchups_mart(t: Tables, n: int = 25) -> DataFrame:
    g = t["mart_matchup"].groupBy("batter_name", "bowler_name", "match_type")
    out = g.agg(F.sum("balls_faced").alias("balls"), F.sum("runs_scored").alias("runs"), F.sum("dismissals").alias("dismissals"), M.rounded(F.avg("strike_rate")).alias("strike_rate"))
    return top(out, n, down("balls"), "batter_name", "bowler_name", "match_type")


def names_of(t: Tables, player: str, column: str) -> DataFrame:
    """The names in the source under which a displayed player appears."""
    return t["player_display_names"].where(F.col("display_name") == player).select(F.col("cricsheet_name").alias(column)).distinct()


def player_headline(t: Tables, player: str) -> DataFrame:
    """Dismissed only if the player is the one who is out."""
    names = names_of(t, player, "batter")
    f = t["fact_delivery"].join(names, "batter", "left_semi").join(names.select(F.col("batter").alias("out_name"), F.lit(True).alias("own")), F.col("player_out") == F.col("out_name"), "left")
    one = f.groupBy("match_id", "innings_number", "match_type").agg(total_runs("r"), count(LEGAL, "b"), F.max((F.col("is_wicket") & F.coalesce("own", F.lit(False))).cast("int")).alias("o"))
    out = one.agg(F.sum("r").alias("runs"), F.count(F.lit(1)).alias("innings"), F.sum("b").alias("balls"), count(F.col("r") >= 50, "fifties"), count(F.col("r") >= 100, "hundreds"), F.max("r").alias("highest_score"), F.sum("o").alias("o"))
    return out.withColumns({"batting_avg": M.average("runs", "o"), "strike_rate": M.strike_rate("runs", "balls")}).drop("o")


def player_headline_mart(t: Tables, player: str) -> DataFrame:
    b = t["mart_player_batting"].where(F.col("player_name") == player)
    out = b.agg(F.sum("total_runs").alias("runs"), F.sum("innings").alias("innings"), F.sum("total_balls").alias("balls"), F.sum("fifties").alias("fifties"), F.sum("hundreds").alias("hundreds"), F.max("highest_score").alias("highest_score"), F.sum("dismissals").alias("o"))
    return out.withColumns({"batting_avg": M.average("runs", "o"), "strike_rate": M.strike_rate("runs", "balls")}).drop("o")


def player_by(t: Tables, player: str, key: str) -> DataFrame:
    """Runs by format or season."""
    return t["fact_delivery"].join(names_of(t, player, "batter"), "batter", "left_semi").groupBy(key).agg(total_runs()).orderBy(down("runs") if key == "match_type" else key, key)


def player_by_mart(t: Tables, player: str, key: str) -> DataFrame:
    """Runs and wickets by format or season; the wickets join once for each batting row, as the source's report does."""
    w = t["mart_player_bowling"].groupBy("player_name", key).agg(F.sum("total_wickets").alias("won"))
    b = t["mart_player_batting"].where(F.col("player_name") == player).join(w, ["player_name", key], "left")
    return b.groupBy(key).agg(F.sum("total_runs").alias("runs"), F.sum("won").alias("wickets")).orderBy(key)


def player_bowling_card(t: Tables, player: str) -> DataFrame:
    f = t["fact_delivery"].join(names_of(t, player, "bowler"), "bowler", "left_semi")
    out = f.agg(count(CREDIT, "wickets"), F.count_distinct(F.concat_ws("-", "match_id", "innings_number")).alias("innings"), count(LEGAL, "balls_bowled"), F.sum("runs_total").alias("r"))
    return out.withColumns({"economy": M.economy("r", "balls_bowled"), "bowling_avg": M.average("r", "wickets")}).drop("r")


def player_last_innings(t: Tables, player: str, n: int = 10) -> DataFrame:
    one = t["fact_delivery"].where(F.col("batter") == player).groupBy("match_id", "innings_number").agg(total_runs(), count(LEGAL, "balls"))
    out = one.join(dim_match(t), "match_id").withColumn("fixture", F.concat("team_a", F.lit(" vs "), "team_b"))
    return top(out, n, down("match_date"), "match_id", "innings_number").select("match_date", "match_type", "venue", "fixture", "runs", "balls")


def player_last_matches(t: Tables, player: str, n: int = 10) -> DataFrame:
    p = t["fact_player_match"].where(F.col("player_name") == player).drop("match_type", "season", "gender")
    out = p.join(dim_match(t).drop("venue", "season", "gender"), "match_id").withColumn("opponent", F.when(F.col("team") == F.col("team_a"), F.col("team_b")).otherwise(F.col("team_a")))
    return top(out, n, down("match_date"), "match_id", "team").select("match_date", "match_type", "venue", "opponent", "runs_scored", "balls_faced", "wickets_taken", "overs_bowled")


def match_summary(t: Tables, match_id: str | None = None) -> DataFrame:
    """With the result as a sentence; all matches without an id."""
    m = dim_match(t) if match_id is None else dim_match(t).where(F.col("match_id") == match_id)
    by = lambda c, unit: F.concat("winner", F.lit(" won by "), F.col(c).cast("string"), F.lit(unit))
    result = F.when(F.col("win_by_runs") > 0, by("win_by_runs", " runs")).when(F.col("win_by_wickets") > 0, by("win_by_wickets", " wickets")).otherwise(F.col("outcome_result"))
    return m.select("match_id", "match_date", "match_type", "venue", F.concat("team_a", F.lit(" vs "), "team_b").alias("fixture"), "winner", F.concat("toss_winner", F.lit(" chose to "), "toss_decision").alias("toss"), result.alias("result"))


def _of(t: Tables, match_id: str | None) -> DataFrame:
    f = t["fact_delivery"]
    return f if match_id is None else f.where(F.col("match_id") == match_id)


def manhattan(t: Tables, match_id: str | None = None) -> DataFrame:
    f = _of(t, match_id).join(t["innings"].select("match_id", "innings_number", "team"), ["match_id", "innings_number"])
    return f.groupBy("match_id", "team", (F.col("over_number") + 1).alias("over_no")).agg(F.sum("runs_total").alias("runs"), count("is_wicket", "wickets"))


def worm(t: Tables, match_id: str | None = None) -> DataFrame:
    order = W.partitionBy("match_id", "innings_number").orderBy("over_number", "delivery_number")
    f = _of(t, match_id).join(t["innings"].select("match_id", "innings_number", "team"), ["match_id", "innings_number"])
    return f.select("match_id", "innings_number", "team", F.row_number().over(order).alias("ball_index"), F.sum("runs_total").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("cumulative_runs"))


def over_features(t: Tables) -> DataFrame:
    """What is known at the end of each over: the over's own figures and the innings' totals so far."""
    over = t["fact_delivery"].groupBy("match_id", "innings_number", "over_number").agg(
        F.sum("runs_total").alias("over_runs"), count(LEGAL, "over_balls"), count("is_wicket", "over_wickets"),
    )
    so_far = W.partitionBy("match_id", "innings_number").orderBy("over_number").rowsBetween(W.unboundedPreceding, 0)
    out = over.withColumns({name: F.sum(of).over(so_far) for name, of in (("runs", "over_runs"), ("legal_balls", "over_balls"), ("wickets", "over_wickets"))})
    return out.withColumn("run_rate", M.run_rate("runs", "legal_balls"))


def best_of_match(t: Tables, what: str, match_id: str | None = None, n: int = 5) -> DataFrame:
    """Top batters or bowlers of a match, or of every match."""
    p = t["fact_player_match"] if match_id is None else t["fact_player_match"].where(F.col("match_id") == match_id)
    if what == "batting":
        p, order, shown = p.where("balls_faced > 0"), [down("runs_scored")], ("runs_scored", "balls_faced", "fours", "sixes", "batting_strike_rate")
    else:
        p, order, shown = p.where("balls_bowled > 0"), [down("wickets_taken"), F.col("economy_rate").asc_nulls_last()], ("overs_bowled", "runs_conceded", "wickets_taken", "economy_rate")
    place = F.row_number().over(W.partitionBy("match_id").orderBy(*order, "player_name", "team"))
    return p.withColumn("place", place).where(F.col("place") <= n).select("match_id", "place", "player_name", "team", *shown)


def fall_of_wickets(t: Tables, match_id: str | None = None) -> DataFrame:
    f = _of(t, match_id).where("is_wicket")
    return f.select("match_id", F.col("innings_number").alias("innings"), (F.col("over_number") + 1).alias("over_no"), F.col("delivery_number").alias("ball"), F.col("player_out").alias("dismissed"), F.col("dismissal_kind").alias("how"), "bowler")


def latest_matches(t: Tables, n: int = 20) -> DataFrame:
    return top(dim_match(t), n, down("match_date"), "match_id").select("match_id", "match_date", "team_a", "team_b", "venue")


def matchup_card(t: Tables, batter: str, bowler: str) -> DataFrame:
    m = t["mart_matchup"].where((F.col("batter_name") == batter) & (F.col("bowler_name") == bowler))
    mean = lambda c, name: M.rounded(F.avg(c)).alias(name)
    return m.agg(F.sum("balls_faced").alias("balls"), F.sum("runs_scored").alias("runs"), F.sum("dismissals").alias("dismissals"), mean("strike_rate", "strike_rate"), mean("dot_ball_pct", "dot_pct"), F.sum("fours").alias("fours"), F.sum("sixes").alias("sixes"))


def nemesis(t: Tables, player: str, own: str = "batter_name", n: int = 10) -> DataFrame:
    """Who dismissed a batter most, or whom a bowler dismissed most."""
    other = "bowler_name" if own == "batter_name" else "batter_name"
    g = t["mart_matchup"].where(F.col(own) == player).groupBy(other).agg(F.sum("dismissals").alias("times_dismissed"))
    return top(g.where("times_dismissed > 0"), n, down("times_dismissed"), other)


def resolver(t: Tables, part: str) -> DataFrame:
    shown = F.lower("display_name").contains(part.lower()) | F.lower("cricsheet_name").contains(part.lower())
    return t["player_display_names"].where(shown).select("display_name", "cricsheet_name").orderBy("display_name", "cricsheet_name")


def _own_innings(f: DataFrame, *more: str) -> DataFrame:
    out = F.max((F.col("is_wicket") & F.coalesce(F.col("player_out") == F.col("batter"), F.lit(False))).cast("int"))
    return f.groupBy("batter", "match_type", "match_id", "innings_number", *more).agg(total_runs("r"), count(LEGAL, "b"), out.alias("o"))


def _career(one: DataFrame, *keys: str) -> DataFrame:
    out = one.groupBy(*keys).agg(
        F.count_distinct("match_id").alias("matches"), F.count(F.lit(1)).alias("innings"), F.sum("r").alias("runs"), F.sum("b").alias("b"), F.sum("o").alias("o"),
        count(F.col("r") >= 100, "hundreds"), count((F.col("r") >= 50) & (F.col("r") < 100), "fifties"), F.max("r").alias("high_score"),
    )
    return out.withColumns({"average": M.average("runs", "o"), "strike_rate": M.strike_rate("runs", "b")}).drop("b", "o")


def career_summary(t: Tables, player: str | None = None) -> DataFrame:
    f = t["fact_delivery"] if player is None else t["fact_delivery"].where(F.col("batter") == player)
    return _career(_own_innings(f), "batter", "match_type")


def year_by_year(t: Tables, player: str | None = None) -> DataFrame:
    f = t["fact_delivery"] if player is None else t["fact_delivery"].where(F.col("batter") == player)
    f = f.drop("season").join(dim_match(t).select("match_id", F.year("match_date").alias("year")), "match_id")
    return _career(_own_innings(f, "year"), "batter", "year", "match_type")


def opponents(t: Tables, player: str | None = None) -> DataFrame:
    f = t["fact_delivery"] if player is None else t["fact_delivery"].where(F.col("batter") == player)
    side = t["match_players"].select("match_id", F.col("player_name").alias("batter"), F.col("team").alias("own_team"))
    other = F.when(F.col("own_team") == F.col("team_a"), F.col("team_b")).otherwise(F.col("team_a"))
    f = f.join(side, ["match_id", "batter"]).join(dim_match(t).select("match_id", "team_a", "team_b"), "match_id").withColumn("opponent", other)
    return _career(_own_innings(f, "own_team", "opponent"), "batter", "opponent", "match_type")


def dismissal_modes(t: Tables, player: str | None = None) -> DataFrame:
    f = t["fact_delivery"].where("is_wicket and dismissal_kind is not null and player_out is not null")
    f = f if player is None else f.where(F.col("player_out") == player)
    keys = ["player_out", "match_type", "dismissal_kind"]
    by_bowler = f.groupBy(*keys, "bowler").agg(F.count(F.lit(1)).alias("n"))
    best = by_bowler.withColumn("k", F.row_number().over(W.partitionBy(*keys).orderBy(F.col("n").desc(), "bowler"))).where("k = 1").select(*keys, F.col("bowler").alias("top_bowler"))
    kind = by_bowler.groupBy(*keys).agg(F.sum("n").alias("count"))
    whole = kind.groupBy("player_out", "match_type").agg(F.sum("count").alias("total"))
    out = kind.join(whole, ["player_out", "match_type"]).join(best, keys, "left")
    return out.withColumn("pct_of_dismissals", M.percentage("count", "total", 1)).drop("total")


def innings_context(t: Tables, home_cities: tuple[str, ...]) -> DataFrame:
    """Batting first or chasing, at home (by city) or away."""
    f = t["fact_delivery"].drop("match_type").join(dim_match(t).select("match_id", "match_type", "city"), "match_id")
    f = f.withColumns({"setting": F.when(F.col("innings_number") % 2 == 1, "setting").otherwise("chasing"), "place": F.when(F.col("city").isin(*home_cities), "home").otherwise("away")})
    return _career(_own_innings(f, "setting", "place"), "batter", "setting", "place")


def editions(t: Tables, pattern: str) -> DataFrame:
    f = t["fact_delivery"].join(dim_match(t).where(F.col("event_name").like(pattern)).select("match_id", "event_name"), "match_id")
    return _career(_own_innings(f, "event_name", "season"), "batter", "event_name", "season")


def recent_scorers(t: Tables, match_type: str = "ODI", since: int = 2000, n: int = 15) -> DataFrame:
    m = dim_match(t).where((F.col("match_type") == match_type) & (F.year("match_date") >= since)).select("match_id")
    f = t["fact_delivery"].join(m, "match_id", "left_semi").join(t["player_display_names"].select(F.col("cricsheet_name").alias("batter"), "display_name"), "batter", "left")
    return top(f.groupBy(F.coalesce("display_name", "batter").alias("player")).agg(total_runs(), F.count_distinct("match_id").alias("matches")), n, down("runs"), "player")


def best_economy(t: Tables, least_overs: float = 100.0, n: int = 10) -> DataFrame:
    g = t["mart_player_bowling"].groupBy("player_name").agg(F.sum("total_balls").alias("balls"), F.sum("total_runs").alias("runs"), F.sum("total_wickets").alias("wickets"))
    out = g.withColumns({"overs": M.overs("balls"), "economy": M.economy("runs", "balls")}).where(F.col("overs") >= least_overs)
    return top(out, n, F.col("economy").asc_nulls_last(), "player_name")


def team_formats(t: Tables, team: str) -> DataFrame:
    g = t["mart_team_performance"].where(F.col("team") == team).groupBy("match_type").agg(F.sum("matches_played").alias("played"), F.sum("wins").alias("wins"))
    return g.withColumn("win_pct", M.percentage("wins", "played")).orderBy("match_type")


def head_to_head(t: Tables) -> DataFrame:
    """Each pair of teams once, in order of name."""
    m = dim_match(t).where("team_a is not null and team_b is not null")
    first, second = F.least("team_a", "team_b"), F.greatest("team_a", "team_b")
    g = m.groupBy(first.alias("team"), second.alias("other"))
    return g.agg(F.count(F.lit(1)).alias("matches"), count(F.col("winner") == first, "won"), count(F.col("winner") == second, "lost"))


def chasing_venues(t: Tables, least: int = 10, n: int = 10) -> DataFrame:
    v = t["mart_venue_dna_fixed"].where(F.col("chasing_matches") >= least)
    return top(v, n, down("chasing_win_pct"), "venue", "match_type").select("venue", "match_type", "chasing_matches", "chasing_win_pct")


def sample(df: DataFrame, n: int = 10, width: int = 200) -> DataFrame:
    """A look at a table: n rows, long texts cut for display."""
    return df.select(*[F.substring(c, 1, width).alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes]).limit(n)
