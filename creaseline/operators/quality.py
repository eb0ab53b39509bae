"""Data-quality checks. A table's checks are one aggregate; results are rows of RESULT."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.functions.metrics import rounded
from creaseline.sinks.tables import append

RESULT = "check_id string, layer string, table_name string, severity string, status string, failed long, total long, pct double"
#: Dismissals that a fielder takes part in.
FIELDED = ("caught", "run out", "stumped", "caught and bowled")
BALL = ("match_id", "innings_number", "over_number", "delivery_number")


class BlockedError(RuntimeError):
    """A check of severity BLOCK failed."""


@dataclass(frozen=True)
class Check:
    """failed counts offending rows over one table; limit is the share (percent) that still passes."""

    check_id: str
    failed: Column
    severity: str = "BLOCK"
    limit: float = 0.0
    total: Column | None = None
    #: Nothing to check is SKIPPED.
    skip_empty: bool = False


def missing(*columns: str) -> Column:
    """Rows with a null in any of the columns."""
    return F.count_if(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns)))


def blank(*columns: str) -> Column:
    return F.count_if(reduce(lambda a, b: a | b, (F.trim(F.coalesce(F.col(c), F.lit(""))) == "" for c in columns)))


def surplus(*columns: str) -> Column:
    """Rows beyond the first of each key; keys with nulls count."""
    return F.count(F.lit(1)) - F.count_distinct(F.struct(*columns))


def outside(column: str, *values) -> Column:
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def unfielded() -> Column:
    return F.count_if(F.col("kind").isin(*FIELDED) & (F.coalesce(F.size("fielders"), F.lit(0)) <= 0))


def pct(part: Column, whole: Column) -> Column:
    """Percent with four decimals, at most 99.9999; 0 of 0 is 0."""
    share = rounded(part.cast("double") * 100 / F.when(whole != 0, whole.cast("double")), 4)
    return F.least(F.lit(99.9999), F.coalesce(share, F.lit(0.0)))


def status(failed: Column, total: Column, severity: Column, limit: Column, skip_empty: Column | None = None) -> Column:
    over = F.when(limit == 0, failed > 0).otherwise(failed.cast("double") * 100 > limit * total.cast("double"))
    skips = limit > 0 if skip_empty is None else (limit > 0) | skip_empty
    return F.when((total == 0) & skips, "SKIPPED").when(~over, "PASSED").when(severity == "BLOCK", "FAILED").otherwise("WARNING")


def run(df: DataFrame, layer: str, table_name: str, checks: list[Check]) -> DataFrame:
    """All checks of a table in one pass over it."""
    row = df.agg(*[F.struct(c.failed.cast("long").alias("failed"), (F.count(F.lit(1)) if c.total is None else c.total).cast("long").alias("total")).alias(f"c{i}") for i, c in enumerate(checks)])
    items = F.array(*[F.struct(F.lit(c.check_id).alias("check_id"), F.lit(c.severity).alias("severity"), F.lit(float(c.limit)).alias("limit"), F.lit(c.skip_empty).alias("skip"), F.col(f"c{i}.failed").alias("failed"), F.col(f"c{i}.total").alias("total")) for i, c in enumerate(checks)])
    out = row.select(F.explode(items).alias("x")).select("x.*")
    return out.select("check_id", F.lit(layer).alias("layer"), F.lit(table_name).alias("table_name"), "severity", status(F.col("failed"), F.col("total"), F.col("severity"), F.col("limit"), F.col("skip")).alias("status"), "failed", "total", pct(F.col("failed"), F.col("total")).alias("pct"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key (not null) no parent has."""
    keys = parent.select(F.col(parent_key or child_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def orphan_check(check_id: str, child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None, severity: str = "WARN", layer: str = "silver", table_name: str = "", limit: float = 0.0) -> DataFrame:
    bad = orphans(child, parent, child_key, parent_key).agg(F.count(F.lit(1)).alias("failed"))
    both = bad.crossJoin(child.agg(F.count(F.lit(1)).alias("total")))  # one row each
    s, li = F.lit(severity), F.lit(float(limit))
    return both.select(F.lit(check_id).alias("check_id"), F.lit(layer).alias("layer"), F.lit(table_name).alias("table_name"), s.alias("severity"), status(F.col("failed"), F.col("total"), s, li).alias("status"), "failed", "total", pct(F.col("failed"), F.col("total")).alias("pct"))


def orphan_names(names: DataFrame, persons: DataFrame) -> DataFrame:
    """Orphan identifiers of name variations: FAILED above 5 percent, else WARNING; never blocks. With a sample of ten."""
    ids = names.select("identifier").distinct()
    bad = ids.join(persons.select(F.col("person_id").alias("identifier")).distinct(), "identifier", "left_anti")
    some = bad.orderBy("identifier").limit(10).agg(F.sort_array(F.collect_list("identifier")).alias("sample"))
    out = bad.agg(F.count(F.lit(1)).alias("failed")).crossJoin(ids.agg(F.count(F.lit(1)).alias("total"))).crossJoin(some)  # one row each
    share = pct(F.col("failed"), F.col("total"))
    return out.select("failed", "total", share.alias("pct"), F.when(F.col("failed") == 0, "PASSED").when(share > 5, "FAILED").otherwise("WARNING").alias("status"), "sample")


def log_check(check_id: str, log: DataFrame, failed: Column, total: Column, skipped: Column) -> DataFrame:
    """A blocking check over the one log row of a load; no row, or one for which skipped holds, is SKIPPED."""
    one = log.agg(F.count(F.lit(1)).alias("n"), F.max(skipped).alias("skip"), F.max(failed).cast("long").alias("failed"), F.max(total).cast("long").alias("total"))
    off = (F.col("n") == 0) | F.coalesce("skip", F.lit(False))
    state = F.when(off, "SKIPPED").when(F.col("failed") == 0, "PASSED").otherwise("FAILED")
    return one.select(F.lit(check_id).alias("check_id"), state.alias("status"), F.when(~off, F.col("failed")).alias("failed"), F.when(~off, F.col("total")).alias("total"))


def failed_files(log: DataFrame) -> DataFrame:
    """MAT-BRZ-001: no file of the load failed."""
    return log_check("MAT-BRZ-001", log, F.coalesce("failed", F.lit(0)), F.col("attempted"), F.lit(False))


def audit_coherence(log: DataFrame, audit: DataFrame, run_id: str) -> DataFrame:
    """MAT-BRZ-003: the run stamped as many audit rows as it wrote; a log of another run says nothing."""
    stamped = audit.where(F.col("pipeline_run_id") == run_id).agg(F.count(F.lit(1)).alias("stamped"))
    both = log.crossJoin(stamped)  # one row each
    wrote = F.coalesce("rows_written", F.lit(0))
    return log_check("MAT-BRZ-003", both, F.abs(F.col("stamped") - wrote), wrote, F.col("run_id") != run_id)


def arrived(check_id: str, loaded: DataFrame, landed: DataFrame, n: str = "row_count", share: float = 0.99) -> DataFrame:
    """REG-SLV-005/006: rows in Bronze against rows that landed (a frame of at most one count); SKIPPED if nothing is logged."""
    both = loaded.agg(F.count(F.lit(1)).alias("actual")).crossJoin(landed.agg(F.max(n).cast("long").alias("expected")))  # one row each
    enough = F.col("actual") >= F.floor(F.col("expected") * share)
    return both.select(F.lit(check_id).alias("check_id"), F.when(F.col("expected").isNull(), "SKIPPED").when(enough, "PASSED").otherwise("FAILED").alias("status"), "actual", "expected")


def gate(results: DataFrame, store: Callable[[DataFrame], None] | None = None) -> None:
    """Store the results first, then stop if a blocking check failed."""
    if store:
        store(results)
    bad = [r["check_id"] for r in results.where("status = 'FAILED' and severity = 'BLOCK'").select("check_id").collect()]  # one row a check
    if bad:
        raise BlockedError(", ".join(sorted(bad)))


def store(results: DataFrame, path: str, run_id: str) -> int:
    """Append results to the table of results, with their run."""
    return append(results.withColumn("run_id", F.lit(run_id)), path, ["run_id"])


def table_or_empty(spark: SparkSession, name: str, ddl: str) -> DataFrame:
    """A table, or an empty frame of that shape if it does not exist yet."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], ddl)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def snapshot_histogram(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy("_snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"))


def not_all_strings(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind != "string" and not c.startswith("_")]


def one_snapshot(tables: dict[str, DataFrame], wanted: tuple[str, ...] = ("_snapshot_date", "_pipeline_run_id", "_row_hash")) -> DataFrame:
    """Per Bronze table: snapshots, rows, and rows that have every metadata column (those that the table lacks don't count)."""
    parts = []
    for name, df in tables.items():
        full = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in wanted if c in df.columns))
        parts.append(df.agg(F.lit(name).alias("table_name"), F.count_distinct("_snapshot_date").alias("snapshots"), F.count(F.lit(1)).alias("n_rows"), F.count_if(full).alias("with_metadata")))
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class ModelTest:
    """One declared test of a model's column. values: what it may hold; parent: `table.column` that it must refer to."""

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    parent: str = ""


def _tests(declared: str) -> list[ModelTest]:
    """`table: column column!, ...`; ! also asks for unique values."""
    out = []
    for line in declared.strip().splitlines():
        table, columns = line.split(":")
        for c in columns.split():
            out.append(ModelTest(table.strip(), c.rstrip("!"), "not_null"))
            if c.endswith("!"):
                out.append(ModelTest(table.strip(), c.rstrip("!"), "unique"))
    return out


#: What each model's columns must hold.
MODEL_TESTS = [
    *_tests("""
        dim_player: person_id!
        dim_team: team_name!
        dim_venue: venue_name!
        dim_competition: competition_name!
        dim_date: date_id! date
        player_display_names: cricsheet_name! display_name
        dim_match: match_id! match_type
        fact_delivery: match_id innings_number over_number delivery_number match_type
        fact_innings: match_id innings_number team
        fact_match_result: match_id!
        fact_player_match: match_id
        fact_player_of_match: match_id player_name
        mart_player_batting: person_id match_type
        mart_player_bowling: person_id match_type
        mart_team_performance: team match_type
        mart_venue_dna: venue match_type
        mart_phase_scoring: phase
        mart_toss_outcome: toss_decision
        mart_matchup: batter_person_id bowler_person_id
    """),
    ModelTest("dim_match", "match_type", "accepted_values", ("T20", "ODI", "Test", "IT20", "ODM", "MDM", "T20B", "hundred")),
    ModelTest("mart_phase_scoring", "phase", "accepted_values", ("powerplay", "middle", "death")),
    ModelTest("mart_toss_outcome", "toss_decision", "accepted_values", ("bat", "field")),
    ModelTest("fact_player_of_match", "match_id", "relationships", parent="dim_match.match_id"),
]


def run_model_tests(t: dict[str, DataFrame], tests: list[ModelTest] | None = None) -> DataFrame:
    """table_name, column_name, test, failures: nulls, surplus rows of repeated values, rows with other values, rows without parent.

    All tests of one table but those with a parent are one aggregate over it.
    """
    tests = MODEL_TESTS if tests is None else tests
    row = lambda x, n: F.struct(F.lit(x.table).alias("table_name"), F.lit(x.column).alias("column_name"), F.lit(x.kind).alias("test"), n.cast("long").alias("failures"))
    count = {"not_null": lambda x: missing(x.column), "unique": lambda x: F.count(x.column) - F.count_distinct(x.column), "accepted_values": lambda x: outside(x.column, *x.values)}
    parts = []
    for table in dict.fromkeys(x.table for x in tests):
        own = [x for x in tests if x.table == table and x.kind in count]
        if own:
            sums = t[table].agg(*[count[x.kind](x).alias(f"c{i}") for i, x in enumerate(own)])
            parts.append(sums.select(F.explode(F.array(*[row(x, F.col(f"c{i}")) for i, x in enumerate(own)])).alias("r")).select("r.*"))
    for x in tests:
        if x.kind == "relationships":
            table, key = x.parent.split(".")
            parts.append(orphans(t[x.table], t[table], x.column, key).agg(row(x, F.count(F.lit(1))).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def repeated_grain(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def figures(values: dict[str, DataFrame]) -> DataFrame:
    """what, n: one row for each one-row frame of one number."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("what"), F.col(df.columns[0]).cast("long").alias("n")) for name, df in values.items()])


def _n(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def dimension_integrity(t: dict[str, DataFrame]) -> DataFrame:
    """Surplus rows of each dimension's key, the date spine's range, and match dates outside it."""
    keys = {"dim_match": "match_id", "dim_player": "person_id", "dim_team": "team_name", "dim_venue": "venue_name", "dim_competition": "competition_name", "dim_date": "date_id"}
    out = {f"{name}.{key}": t[name].agg(F.count(F.lit(1)) - F.count_distinct(key)) for name, key in keys.items()}
    spine, dates = t["dim_date"], t["dim_match"].select(F.col("match_date").alias("date"))
    out |= {"spine_first": spine.agg(F.date_format(F.min("date"), "yyyyMMdd")), "spine_last": spine.agg(F.date_format(F.max("date"), "yyyyMMdd")), "spine_days": _n(spine)}
    return figures(out | {"dates_outside_spine": _n(orphans(dates, spine, "date"))})


def fact_integrity(t: dict[str, DataFrame]) -> DataFrame:
    """Facts without their dimension, the one-to-one result table, and the award bridge."""
    m, award = t["dim_match"], t["fact_player_of_match"]
    gap = _n(m).withColumnRenamed("n", "a").crossJoin(_n(t["fact_match_result"])).select(F.col("a") - F.col("n"))  # one row each
    return figures({
        "orphan_deliveries": _n(orphans(t["fact_delivery"], m, "match_id")), "orphan_innings": _n(orphans(t["fact_innings"], m, "match_id")), "result_rows_missing": gap,
        "award_rows": _n(award), "award_matches": award.agg(F.count_distinct("match_id")), "award_surplus": award.agg(surplus("match_id", "player_name")),
        "award_orphans": _n(orphans(award, m, "match_id")), "award_ties": _n(repeated_grain(award, "match_id")),
    })


def reconciliation(t: dict[str, DataFrame], bronze: DataFrame, people: DataFrame) -> DataFrame:
    """Rows of the same thing in each layer."""
    layers = {
        "matches": (bronze.select("match_id").distinct(), t["matches"], t["dim_match"]), "people": (people, t["persons"], t["dim_player"]),
        "deliveries": (None, t["deliveries"], t["fact_delivery"]), "innings": (None, t["innings"], t["fact_innings"]),
    }
    return figures({f"{what}.{layer}": _n(df) for what, own in layers.items() for layer, df in zip(("bronze", "silver", "gold"), own, strict=True) if df is not None})


def mart_coverage(t: dict[str, DataFrame]) -> DataFrame:
    """Mart rows whose dimension row is missing, and rows of the phase mart by format."""
    formats = t["mart_phase_scoring"].groupBy("match_type").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("phase_rows."), "match_type").alias("what"), "n")
    missing_rows = figures({
        "batting_players": _n(orphans(t["mart_player_batting"], t["dim_player"], "person_id")),
        "venues": _n(orphans(t["mart_venue_dna"], t["dim_venue"], "venue", "venue_name")),
    })
    return missing_rows.unionByName(formats)


def silver_checks() -> dict[str, list[Check]]:
    """Checks bound to each Silver table (built when a session exists)."""
    ball = BALL
    return {
        "matches": [Check("MAT-SLV-001", missing("match_id")), Check("MAT-SLV-002", surplus("match_id"))],
        "innings": [Check("MAT-SLV-003", surplus("match_id", "innings_number"))],
        "deliveries": [Check("MAT-SLV-004", surplus(*ball)), Check("MAT-SLV-012", missing("batter", "bowler"), "WARN", 1.0)],
        "wickets": [Check("MAT-SLV-006", unfielded(), "WARN", total=F.count_if(F.col("kind").isin(*FIELDED)), skip_empty=True), Check("MAT-SLV-008", surplus(*ball, "player_out"))],
        "match_players": [Check("MAT-SLV-009", surplus("match_id", "team", "player_name"))],
        "match_officials": [Check("MAT-SLV-010", surplus("match_id", "role", "official_name"))],
        "match_registry": [Check("MAT-SLV-011", surplus("match_id", "display_name"))],
        "persons": [Check("REG-SLV-001", missing("person_id")), Check("REG-SLV-002", surplus("person_id"))],
        "person_identifiers": [Check("REG-SLV-003", missing("identifier", "source_system", "source_identifier")), Check("REG-SLV-004", surplus("identifier", "source_system", "source_identifier"), "WARN")],
    }


def unmatched_rate(players: DataFrame, officials: DataFrame, audit: DataFrame, limit: float = 5.0) -> DataFrame:
    n = F.count(F.lit(1))
    total = players.agg(n.alias("p")).crossJoin(officials.agg(n.alias("o")))  # one row each
    out = audit.agg(n.alias("failed")).crossJoin(total).withColumn("total", F.col("p") + F.col("o"))
    s = F.lit("WARN")
    return out.select(F.lit("MAT-SLV-005").alias("check_id"), status(F.col("failed"), F.col("total"), s, F.lit(limit)).alias("status"), "failed", "total", pct(F.col("failed"), F.col("total")).alias("pct"))


def business_rules(t: dict[str, DataFrame]) -> DataFrame:
    """Offending rows of each rule over matches, innings and deliveries."""
    n = F.count(F.lit(1))
    m, f, i = t["matches"], t["fact_delivery"], t["fact_innings"]
    by_balls = f.groupBy("match_id", "innings_number").agg(F.sum(F.col("runs_batter") + F.col("runs_extras")).alias("balls_total"))
    rules = {
        "two_teams": m.where("team_a is null or team_b is null or team_a = team_b"),
        "winner_is_a_team": m.where("winner is not null and winner not in (team_a, team_b)"),
        "innings_total_is_sum_of_balls": i.join(by_balls, ["match_id", "innings_number"]).where("total_runs <> balls_total"),
        "innings_number_range": i.where("innings_number not between 1 and 6"),
        "run_rate_range": i.where("run_rate < 0 or run_rate > 36"),
        "matches_without_innings": m.join(t["innings"].select("match_id").distinct(), "match_id", "left_anti"),
    }
    found = [df.agg(F.lit(r).alias("rule"), n.alias("offending")) for r, df in rules.items()]
    return reduce(DataFrame.unionByName, [*found, wicket_balance(t)])


def wicket_balance(t: dict[str, DataFrame]) -> DataFrame:
    """The fact has one row a ball: Silver's wickets less its wicket balls must be the wickets beyond the first of a ball."""
    n = F.count(F.lit(1))
    silver_side = t["wickets"].groupBy(*BALL).agg(n.alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("more"))
    both = silver_side.crossJoin(t["fact_delivery"].where("is_wicket").agg(n.alias("balls")))  # one row each
    return both.select(F.lit("wicket_balance").alias("rule"), F.abs(F.col("all") - F.col("balls") - F.col("more")).alias("offending"))


def freshness(t: dict[str, DataFrame]) -> DataFrame:
    """Latest match of each format."""
    return t["matches"].groupBy("match_type").agg(F.max("match_date").alias("latest"))


def last_ingest(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.lit(name).alias("table_name"), F.max("_ingested_at").alias("last_ingested")) for name, df in tables.items()])
