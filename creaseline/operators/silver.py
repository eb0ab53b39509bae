"""Silver: typed tables out of the latest revision of each match document. Every function is DataFrame -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.operators.bronze import latest_revision
from creaseline.schema import BALLS_DDL, INFO_DDL, LINEUP_DDL, MATCH_DDL, NAMES_DDL


def parse(bronze: DataFrame, latest: bool = True, schema: str = MATCH_DDL) -> DataFrame:
    """Bronze rows with the document as nested `doc`; the text goes. The JSON reader skips what the schema leaves out."""
    rows = latest_revision(bronze) if latest else bronze
    return rows.withColumn("doc", F.from_json("raw_json", schema)).drop("raw_json")


def parse_names(bronze: DataFrame) -> DataFrame:
    """As parse, with what mentions() reads only: the JSON reader skips innings."""
    return parse(bronze, schema=NAMES_DDL)


def parse_info(bronze: DataFrame) -> DataFrame:
    """As parse, without the balls: what every table reads that is by match or innings."""
    return parse(bronze, schema=INFO_DDL)


def parse_balls(bronze: DataFrame) -> DataFrame:
    """What deliveries, wickets and replacements read, a row for each ball."""
    return balls(parse(bronze, schema=BALLS_DDL))


def parse_lineup(bronze: DataFrame) -> DataFrame:
    """As parse, with what lineup.active_in_documents() reads only."""
    return parse(bronze, schema=LINEUP_DDL)


def _info(path: str) -> Column:
    return F.col(f"doc.info.{path}")


def _blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def both_teams() -> list[Column]:
    return [F.coalesce(F.get(_info("teams"), F.lit(i)), _blank(F.col(c))).alias(c) for i, c in enumerate(("team_a", "team_b"))]


def matches(parsed: DataFrame) -> DataFrame:
    """One row a match; what the document leaves out comes from the Bronze header, blanks are null."""
    of = lambda path, header: F.coalesce(_info(path), _blank(F.col(header)))
    outcome = "outcome.by."
    return parsed.select(
        "match_id", of("season", "season").alias("season"), of("match_type", "match_type").alias("match_type"), of("gender", "gender").alias("gender"),
        F.coalesce(F.get(_info("dates"), F.lit(0)), F.col("match_date")).try_cast("date").alias("match_date"),
        *both_teams(),
        of("venue", "venue").alias("venue"), of("city", "city").alias("city"),
        _info("balls_per_over").alias("balls_per_over"), _info("overs").alias("limit_overs"),
        _info("event.name").alias("event_name"), _info("event.match_number").alias("event_number"),
        _info("toss.winner").alias("toss_winner"), _info("toss.decision").alias("toss_decision"),
        _info("outcome.winner").alias("winner"), _info("outcome.result").alias("outcome_result"), _info("outcome.method").alias("outcome_method"),
        _info(outcome + "runs").alias("win_by_runs"), _info(outcome + "wickets").alias("win_by_wickets"), _info(outcome + "innings").alias("win_by_innings"),
        _info("player_of_match").alias("player_of_match"), _info("event.`group`").alias("group_label"), (F.coalesce(F.size(_info("missing")), F.lit(0)) > 0).alias("has_missing_data"), "_snapshot_date",
    )


def _innings(parsed: DataFrame, *more: Column) -> DataFrame:
    return parsed.select("match_id", "_snapshot_date", *more, F.posexplode("doc.innings").alias("place", "inn")).withColumn("innings_number", F.col("place") + 1)


def innings(parsed: DataFrame) -> DataFrame:
    flag = lambda name: F.coalesce(F.col(f"inn.{name}"), F.lit(False)).alias(name)
    return _innings(parsed).select("match_id", "innings_number", F.col("inn.team").alias("team"), flag("super_over"), flag("declared"), flag("forfeited"), F.col("inn.target.runs").alias("target_runs"), F.col("inn.target.overs").alias("target_overs"), "_snapshot_date")


def balls(parsed: DataFrame) -> DataFrame:
    """Balls as nested `d`, with the batting side and both teams; what is not read is pruned. Rows that are balls already stay."""
    if "d" in parsed.columns:
        return parsed
    over = _innings(parsed, _info("teams").alias("teams")).select("match_id", "_snapshot_date", "teams", F.col("inn.team").alias("batting"), "innings_number", F.explode("inn.overs").alias("o"))
    return over.select("match_id", "_snapshot_date", "teams", "batting", "innings_number", F.col("o.over").alias("over_number"), F.posexplode("o.deliveries").alias("ball", "d")).withColumn("delivery_number", F.col("ball") + 1).drop("ball")


BALL_KEY = ("match_id", "innings_number", "over_number", "delivery_number")


def deliveries(parsed: DataFrame) -> DataFrame:
    runs = lambda name: F.coalesce(F.col(f"d.runs.{name}"), F.lit(0)).alias(f"runs_{name}")
    swap = F.get(F.concat(*changes()), 0)
    extras = [F.col(f"d.extras.{x}").alias(f"extra_{x}") for x in ("wides", "noballs", "byes", "legbyes", "penalty")]
    return balls(parsed).select(*BALL_KEY, "d.batter", "d.bowler", "d.non_striker", runs("batter"), runs("extras"), runs("total"), runs("non_boundary"), *extras, (F.coalesce(F.size("d.wickets"), F.lit(0)) > 0).alias("is_wicket"), *[swap[x].alias(f"replacement_{x}") for x in ("in", "out", "reason")], "_snapshot_date")


def changes(ball: Column | None = None) -> tuple[Column, Column]:
    """The replacements of a ball (d) as two arrays of one type: of roles (team unknown), then in the eleven."""
    kind = "array<struct<scope:string,team:string,`in`:string,`out`:string,role:string,reason:string>>"
    none = F.array().cast(kind)
    one = lambda scope, team, r, role: F.struct(F.lit(scope).alias("scope"), team.alias("team"), r["in"].alias("in"), r["out"].alias("out"), role.alias("role"), r["reason"].alias("reason"))
    null, d = F.lit(None).cast("string"), F.col("d") if ball is None else ball
    roles = F.transform(d["replacements"]["role"], lambda r: one("role", null, r, r["role"]))
    eleven = F.transform(d["replacements"]["match"], lambda r: one("match", r["team"], r, null))
    return F.coalesce(roles.cast(kind), none), F.coalesce(eleven.cast(kind), none)


def replacements(parsed: DataFrame) -> DataFrame:
    """One row for each replacement that a ball records. A team that is not named is the batting side if the one who goes is at the crease, else the fielding side."""
    rows = balls(parsed).select(*BALL_KEY, "batting", "teams", "d.batter", "d.non_striker", F.posexplode(F.concat(*changes())).alias("place", "r"), "_snapshot_date")
    team = changed_team(F.col("r"), F.col("batter"), F.col("non_striker"), F.col("batting"), F.col("teams"))
    return rows.select(*BALL_KEY, (F.col("place") + 1).alias("replacement_number"), "r.scope", team.alias("team"), F.col("r.in").alias("player_in"), F.col("r.out").alias("player_out"), "r.role", "r.reason", "_snapshot_date")


def changed_team(r: Column, batter: Column, non_striker: Column, batting: Column, teams: Column) -> Column:
    """The side of a replacement, named or not."""
    fielding = F.get(F.filter(teams, lambda t: t != batting), 0)
    at_crease = F.coalesce((r["out"] == batter) | (r["out"] == non_striker), F.lit(False))
    return F.coalesce(r["team"], F.when(at_crease, batting).otherwise(fielding))


def wickets(parsed: DataFrame) -> DataFrame:
    out = balls(parsed).select(*BALL_KEY, "_snapshot_date", F.explode("d.wickets").alias("w"))
    substitute = F.coalesce(F.exists("w.fielders", lambda f: f["substitute"]), F.lit(False)).alias("fielder_is_substitute")
    return out.select(*BALL_KEY, "w.player_out", "w.kind", F.transform("w.fielders", lambda f: f["name"]).alias("fielders"), substitute, "_snapshot_date")


def powerplays(parsed: DataFrame) -> DataFrame:
    rows = _innings(parsed).where(F.size("inn.powerplays") > 0).select("match_id", "innings_number", F.explode("inn.powerplays").alias("p"), "_snapshot_date")
    return rows.select("match_id", "innings_number", F.col("p.from").alias("from_over"), F.col("p.to").alias("to_over"), F.col("p.type").alias("type"), "_snapshot_date")


def registry(parsed: DataFrame) -> DataFrame:
    rows = parsed.select("match_id", F.explode(F.map_entries("doc.info.registry.people")).alias("e"), "_snapshot_date")
    return rows.select("match_id", F.col("e.key").alias("display_name"), F.col("e.value").alias("cricsheet_id"), "_snapshot_date").dropDuplicates(["match_id", "display_name"])


def players(parsed: DataFrame) -> DataFrame:
    rows = parsed.select("match_id", F.explode(F.map_entries("doc.info.players")).alias("e"), "_snapshot_date")
    return rows.select("match_id", F.col("e.key").alias("team"), F.explode("e.value").alias("player_name"), "_snapshot_date").dropDuplicates(["match_id", "team", "player_name"])


#: Role tag of each list of officials.
ROLES = {"umpires": "umpire", "tv_umpires": "tv_umpire", "reserve_umpires": "reserve_umpire", "match_referees": "match_referee"}


def officials(parsed: DataFrame) -> DataFrame:
    """The four lists in one pass: an array of (role, name) is exploded once."""
    def tag(field: str, role: str) -> Column:
        names = F.coalesce(_info(f"officials.{field}"), F.array().cast("array<string>"))
        return F.transform(names, lambda n: F.struct(F.lit(role).alias("role"), n.alias("name")))

    tagged = [tag(field, role) for field, role in ROLES.items()]
    rows = parsed.select("match_id", F.explode(F.concat(*tagged)).alias("o"), "_snapshot_date")
    return rows.select("match_id", "o.role", F.col("o.name").alias("official_name"), "_snapshot_date").dropDuplicates(["match_id", "role", "official_name"])


def teams(parsed: DataFrame) -> DataFrame:
    rows = parsed.select(F.explode("doc.info.teams").alias("team_name"), _info("team_type").alias("team_type"), "_snapshot_date")
    return rows.groupBy("team_name").agg(F.max("team_type").alias("team_type"), F.max("_snapshot_date").alias("_snapshot_date"))


def venues(parsed: DataFrame) -> DataFrame:
    return matches(parsed).groupBy(F.col("venue").alias("venue_name"), "city").agg(F.max("_snapshot_date").alias("_snapshot_date"))


def competitions(parsed: DataFrame) -> DataFrame:
    """One row a competition; group_label lists the groups of its group stages."""
    rows = parsed.select(_info("event.name").alias("competition_name"), _info("event.`group`").alias("g"), "_snapshot_date").where("competition_name is not null")
    return rows.groupBy("competition_name").agg(labels(F.collect_set("g")), F.max("_snapshot_date").alias("_snapshot_date"))


def mentions(parsed: DataFrame) -> DataFrame:
    """What each match says of teams, venues and competitions: (match_id, kind, name, detail, _snapshot_date); one row of nulls if nothing."""
    one = lambda kind, name, detail: F.struct(F.lit(kind).alias("kind"), name.alias("name"), detail.alias("detail"))
    sides = F.transform(_info("teams"), lambda t: one("teams", t, _info("team_type")))
    venue = one("venues", F.coalesce(_info("venue"), _blank(F.col("venue"))), F.coalesce(_info("city"), _blank(F.col("city"))))
    event = F.when(_info("event.name").isNotNull(), one("competitions", _info("event.name"), _info("event.`group`")))
    every = F.filter(F.concat(F.coalesce(sides, F.array().cast("array<struct<kind:string,name:string,detail:string>>")), F.array(venue, event)), lambda x: x.isNotNull())
    return parsed.select("match_id", "_snapshot_date", F.explode_outer(every).alias("m")).select("match_id", "m.*", "_snapshot_date")


def from_mentions(table: str, counts: DataFrame) -> DataFrame:
    """The rows of a table out of distinct mentions (kind, name, detail, _snapshot_date)."""
    own, last = counts.where(F.col("kind") == table), F.max("_snapshot_date").alias("_snapshot_date")
    if table == "teams":
        return own.groupBy(F.col("name").alias("team_name")).agg(F.max("detail").alias("team_type"), last)
    if table == "venues":
        return own.groupBy(F.col("name").alias("venue_name"), F.col("detail").alias("city")).agg(last)
    return own.groupBy(F.col("name").alias("competition_name")).agg(labels(F.collect_set("detail")), last)


def labels(groups: Column) -> Column:
    return _blank(F.array_join(F.array_sort(groups), ", ")).alias("group_label")


def document_checks(parsed: DataFrame, versions: tuple[str, ...] = ("1.0.0", "1.1.0")) -> DataFrame:
    """Per match: registry covers all players, version supported, innings not empty, and whether data is marked missing."""
    named = F.flatten(F.map_values("doc.info.players"))
    return parsed.select(
        "match_id",
        F.coalesce(F.size(F.array_except(named, F.map_keys("doc.info.registry.people"))) == 0, F.lit(False)).alias("registry_complete"),
        F.coalesce(F.col("doc.meta.data_version").isin(*versions), F.lit(False)).alias("version_supported"),
        (F.coalesce(F.size("doc.innings"), F.lit(0)) > 0).alias("has_innings"),
        (F.coalesce(F.size(_info("missing")), F.lit(0)) > 0).alias("has_missing_data"),
    )
