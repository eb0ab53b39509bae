"""The same queries as SQL over the flat tables. Documents, explodes and resolution have no part here: Silver is written flat."""

from __future__ import annotations

BASE = """
WITH m AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id, o_orderkey AS k, CAST(year(o_orderdate) AS VARCHAR) AS season,
    list_extract(['T20','ODI','Test','IT20','ODM','T20B'], CAST(o_orderkey % 6 + 1 AS INTEGER)) AS match_type,
    CASE WHEN o_orderkey % 3 = 0 THEN 'female' ELSE 'male' END AS gender, CAST(o_orderdate AS DATE) AS match_date,
    na.n_name AS team_a, nb.n_name AS team_b, 'Ground ' || (o_custkey % 37) AS venue, CASE WHEN o_orderkey % 13 <> 0 THEN 'City ' || (o_custkey % 11) END AS city,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'Cup ' || (o_custkey % 7) END AS event_name, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 50 AS VARCHAR) END AS event_number,
    CASE WHEN o_orderkey % 2 = 0 THEN na.n_name ELSE nb.n_name END AS toss_winner, CASE WHEN o_orderkey % 5 < 2 THEN 'bat' ELSE 'field' END AS toss_decision,
    CASE o_orderstatus WHEN 'F' THEN na.n_name WHEN 'O' THEN nb.n_name END AS winner,
    CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'tie' ELSE 'no result' END END AS outcome_result,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 17 = 0 THEN 'D/L' END AS outcome_method,
    CASE WHEN o_orderstatus = 'F' THEN 1 + o_orderkey % 97 END AS win_by_runs, CASE WHEN o_orderstatus = 'O' THEN 1 + o_orderkey % 9 END AS win_by_wickets,
    CASE WHEN o_orderkey % 4 = 0 THEN 'club' ELSE 'international' END AS team_type,
    CASE WHEN o_orderkey % 2 = 0 THEN ['P' || (o_orderkey % 300), 'P' || (o_orderkey % 7)] END AS player_of_match, o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation na ON na.n_nationkey = c_nationkey JOIN nation nb ON nb.n_nationkey = (c_nationkey + 1 + o_orderkey % 24) % 25),
lim AS (SELECT *, CASE WHEN match_type IN ('T20','IT20','T20B') THEN 20 WHEN match_type IN ('ODI','ODM') THEN 50 END AS limit_overs FROM m),
b AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS innings_number, CAST((l_linenumber * 7 + l_partkey) % 50 AS BIGINT) AS over_number,
    'P' || (l_partkey % 300) AS batter, 'Q' || (l_suppkey % 60) AS bowler, 'P' || ((l_partkey + 1) % 300) AS non_striker, CAST(l_quantity AS BIGINT) % 7 AS runs_batter,
    CASE WHEN l_returnflag = 'A' THEN l_partkey % 4 END AS x, l_returnflag = 'R' AS is_wicket, l_partkey, l_suppkey,
    row_number() OVER (PARTITION BY l_orderkey, l_linestatus = 'F', (l_linenumber * 7 + l_partkey) % 50 ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS delivery_number
  FROM lineitem),
deliveries AS (
  SELECT match_id, innings_number, over_number, delivery_number, batter, bowler, non_striker, runs_batter, CAST(CASE WHEN x IS NULL THEN 0 ELSE 1 END AS BIGINT) AS runs_extras,
    runs_batter + CASE WHEN x IS NULL THEN 0 ELSE 1 END AS runs_total, CAST(0 AS BIGINT) AS runs_non_boundary, CASE WHEN x = 0 THEN 1 END AS extra_wides, CASE WHEN x = 1 THEN 1 END AS extra_noballs,
    CASE WHEN x = 2 THEN 1 END AS extra_byes, CASE WHEN x = 3 THEN 1 END AS extra_legbyes, CAST(NULL AS BIGINT) AS extra_penalty, is_wicket,
    CASE WHEN l_partkey % 37 = 0 THEN 'Q' || (l_suppkey % 9) WHEN l_partkey % 41 = 0 THEN 'S' || (l_suppkey % 3) WHEN l_partkey % 53 = 0 THEN 'F' || (l_suppkey % 2) END AS replacement_in,
    CASE WHEN l_partkey % 37 = 0 THEN bowler WHEN l_partkey % 41 = 0 THEN batter WHEN l_partkey % 53 = 0 THEN bowler END AS replacement_out,
    CASE WHEN l_partkey % 37 = 0 OR l_partkey % 41 = 0 OR l_partkey % 53 = 0 THEN CASE WHEN l_partkey % 2 = 0 THEN 'concussion_substitute' ELSE 'injury' END END AS replacement_reason
  FROM b WHERE match_id IN (SELECT match_id FROM m)),
fell AS (SELECT *, CASE WHEN l_partkey % 7 IN (0, 3) THEN 'F' || (l_suppkey % 20) END AS fielders FROM b WHERE is_wicket AND match_id IN (SELECT match_id FROM m)),
wickets AS (
  SELECT match_id, innings_number, over_number, delivery_number, batter AS player_out, list_extract(['caught','bowled','lbw','run out','stumped','caught and bowled','hit wicket'], CAST(l_partkey % 7 + 1 AS INTEGER)) AS kind, fielders, fielders IS NOT NULL AND l_partkey % 11 = 0 AS fielder_is_substitute FROM fell
  UNION ALL SELECT match_id, innings_number, over_number, delivery_number, non_striker, 'run out', fielders, fielders IS NOT NULL AND l_partkey % 11 = 0 FROM fell WHERE l_partkey % 7 = 0 AND l_suppkey % 5 = 0),
innings AS (
  SELECT match_id, i AS innings_number, CASE WHEN i = 1 THEN team_a ELSE team_b END AS team, false AS super_over, k % 19 = 0 AS declared, false AS forfeited,
    CASE WHEN i = 2 THEN 100 + k % 200 END AS target_runs, CASE WHEN i = 2 THEN CAST(limit_overs AS DOUBLE) END AS target_overs, limit_overs
  FROM lim, (VALUES (1), (2)) v(i)),
squads AS (
  SELECT DISTINCT d.match_id, CASE WHEN innings_number = 1 THEN team_a ELSE team_b END AS team, batter AS player_name FROM deliveries d JOIN m USING (match_id)
  UNION SELECT DISTINCT d.match_id, CASE WHEN innings_number = 2 THEN team_a ELSE team_b END, bowler FROM deliveries d JOIN m USING (match_id)),
registry AS (SELECT DISTINCT match_id, player_name AS display_name, 'r-' || player_name AS cricsheet_id FROM squads WHERE CAST(substr(player_name, 2) AS INTEGER) % 4 <> 0),
people_rows AS (
  SELECT 'id' || c_custkey AS identifier, CASE WHEN c_custkey % 10 <> 0 THEN 'Person ' || c_custkey END AS name, 'person-' || c_custkey AS unique_name, c_custkey AS k FROM customer
  UNION ALL SELECT 'id' || c_custkey, 'Aaron ' || c_custkey, 'zed-' || c_custkey, c_custkey FROM customer WHERE c_custkey % 50 = 7),
people AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY name NULLS LAST, unique_name) AS n FROM people_rows) WHERE n = 1),
gone AS (SELECT 'gone' || c_custkey AS identifier, 'Gone ' || c_custkey AS name, 'gone-' || c_custkey AS unique_name FROM customer WHERE c_custkey % 20 = 0),
persons AS (
  SELECT identifier AS person_id, name, unique_name, DATE '2024-01-01' AS _snapshot_date FROM people
  UNION ALL SELECT identifier, name, unique_name, DATE '2023-12-01' FROM gone UNION ALL SELECT 'id' || c_custkey, 'Old ' || c_custkey, 'old-' || c_custkey, DATE '2023-12-01' FROM customer WHERE c_custkey % 4 = 0),
identifiers AS (
  SELECT identifier, 'cricsheet' AS source_system, 'r-P' || k AS source_identifier FROM people WHERE k % 3 <> 0
  UNION ALL SELECT identifier, 'cricinfo', CAST(k * 7 AS VARCHAR) FROM people WHERE k % 2 = 0
  UNION ALL SELECT identifier, 'cricbuzz', CAST(k * 3 AS VARCHAR) FROM people WHERE k % 5 = 0),
variations AS (SELECT DISTINCT 'id' || c_custkey AS identifier, 'P' || (c_custkey % 290) AS name FROM customer UNION SELECT DISTINCT 'sup' || s_suppkey, 'Q' || (s_suppkey % 50) FROM supplier),
by_id AS (SELECT source_identifier AS cricsheet_id, min(identifier) AS pa FROM identifiers WHERE source_system = 'cricsheet' GROUP BY 1),
by_name AS (SELECT name, min(identifier) AS pb FROM variations GROUP BY 1),
players AS (
  SELECT s.match_id, s.team, s.player_name, r.cricsheet_id, coalesce(pa, pb) AS person_id
  FROM squads s LEFT JOIN registry r ON r.match_id = s.match_id AND r.display_name = s.player_name LEFT JOIN by_id ON by_id.cricsheet_id = r.cricsheet_id LEFT JOIN by_name n ON n.name = s.player_name),
tagged AS (
  SELECT match_id, 'umpire' AS role, 'U' || (k % 23) AS official_name FROM m UNION ALL SELECT match_id, 'tv_umpire', 'U' || (k % 29) FROM m UNION ALL SELECT match_id, 'match_referee', 'R' || (k % 5) FROM m),
officials AS (
  SELECT t.match_id, role, official_name, r.cricsheet_id, coalesce(pa, pb) AS person_id
  FROM tagged t LEFT JOIN registry r ON r.match_id = t.match_id AND r.display_name = t.official_name LEFT JOIN by_id ON by_id.cricsheet_id = r.cricsheet_id LEFT JOIN by_name n ON n.name = t.official_name),
unmatched AS (
  SELECT match_id, 'player' AS role, player_name AS display_name, cricsheet_id, CASE WHEN cricsheet_id IS NULL THEN 'NO_REGISTRY_MAPPING' ELSE 'NO_REGISTER_MATCH' END AS reason FROM players WHERE person_id IS NULL
  UNION ALL SELECT match_id, role, official_name, cricsheet_id, CASE WHEN cricsheet_id IS NULL THEN 'NO_REGISTRY_MAPPING' ELSE 'NO_REGISTER_MATCH' END FROM officials WHERE person_id IS NULL),
audit AS (
  SELECT o_orderkey || '.json' AS file_name, sha256(o_orderkey || '|' || o_orderstatus) AS content_hash, CAST(o_orderkey AS VARCHAR) AS match_id, o_orderkey AS k, o_orderdate AS bronze_loaded_at,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS silver_loaded_at, CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 3 = 0 THEN o_orderdate END AS gold_loaded_at FROM orders),
dim_player AS (
  SELECT p.person_id, p.name AS full_name, p.unique_name, max(CASE WHEN source_system = 'cricinfo' THEN source_identifier END) AS cricinfo_id, CAST(NULL AS VARCHAR) AS espn_id,
    max(CASE WHEN source_system = 'cricbuzz' THEN source_identifier END) AS cricbuzz_id, CAST(NULL AS VARCHAR) AS wikidata_id, CAST(NULL AS VARCHAR) AS twitter_handle, CAST(NULL AS VARCHAR) AS instagram_handle, p._snapshot_date
  FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY _snapshot_date DESC) AS n FROM persons) p LEFT JOIN identifiers i ON i.identifier = p.person_id WHERE n = 1 GROUP BY ALL),
aliases AS (SELECT DISTINCT 'P' || (p_partkey * 2 % 300) AS cricsheet_name, 'Star ' || (p_partkey * 2 % 300) AS display_name FROM part),
shown AS (
  SELECT n.cricsheet_name, coalesce(a.display_name, d.full_name, n.cricsheet_name) AS display_name, coalesce(d.unique_name, n.cricsheet_name) AS unique_name, n.person_id
  FROM (SELECT player_name AS cricsheet_name, min(person_id) AS person_id FROM players GROUP BY 1) n LEFT JOIN aliases a USING (cricsheet_name) LEFT JOIN dim_player d ON d.person_id = n.person_id),
one_id AS (SELECT match_id, player_name, min(person_id) AS person_id FROM players GROUP BY 1, 2),
one_wicket AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY match_id, innings_number, over_number, delivery_number ORDER BY CASE WHEN kind = 'run out' THEN 1 ELSE 0 END, kind) AS n FROM wickets) WHERE n = 1),
f AS (
  SELECT d.match_id, d.innings_number, d.over_number, d.delivery_number, d.batter, p.person_id AS batter_person_id, d.bowler, q.person_id AS bowler_person_id, d.non_striker, d.runs_batter, d.runs_extras, d.runs_total, d.runs_non_boundary,
    d.extra_wides, d.extra_noballs, d.extra_byes, d.extra_legbyes, d.extra_penalty, d.is_wicket, w.kind AS dismissal_kind, w.player_out, coalesce(w.kind <> 'run out', false) AS is_bowler_wicket,
    d.extra_wides IS NULL AND d.extra_noballs IS NULL AS is_legal_ball, d.runs_batter = 0 AND d.extra_wides IS NULL AS is_dot_ball, m.match_type, m.season, m.gender
  FROM deliveries d JOIN m USING (match_id) LEFT JOIN one_id p ON p.match_id = d.match_id AND p.player_name = d.batter LEFT JOIN one_id q ON q.match_id = d.match_id AND q.player_name = d.bowler
  LEFT JOIN one_wicket w ON w.match_id = d.match_id AND w.innings_number = d.innings_number AND w.over_number = d.over_number AND w.delivery_number = d.delivery_number),
dim_match AS (SELECT match_id, season, match_type, gender, match_date, team_a, team_b, venue, city, 6 AS balls_per_over, limit_overs, event_name, event_number, toss_winner, toss_decision, winner, outcome_result, outcome_method, win_by_runs, win_by_wickets, CAST(NULL AS BIGINT) AS win_by_innings FROM lim),
fi AS (
  SELECT i.match_id, i.innings_number, i.team, i.super_over, i.declared, i.forfeited, i.target_runs, i.target_overs, m.match_type, m.season, m.gender, m.venue, total_runs, legal_balls, floor(legal_balls / 6.0::DOUBLE * 10 + 0.5) / 10 AS overs_faced,
    wickets_fallen, boundaries, sixes, floor(total_runs * 6.0::DOUBLE / nullif(legal_balls, 0) * 100 + 0.5) / 100 AS run_rate
  FROM innings i JOIN m USING (match_id) LEFT JOIN (
    SELECT match_id, innings_number, CAST(sum(runs_total) AS BIGINT) AS total_runs, count(*) FILTER (is_legal_ball) AS legal_balls, count(*) FILTER (is_wicket) AS wickets_fallen, count(*) FILTER (runs_batter IN (4, 6)) AS boundaries, count(*) FILTER (runs_batter = 6) AS sixes
    FROM f GROUP BY 1, 2) t ON t.match_id = i.match_id AND t.innings_number = i.innings_number),
fp AS (
  SELECT p.match_id, p.person_id, p.player_name, p.team, m.match_type, m.season, m.gender, m.venue, coalesce(runs_scored, 0) AS runs_scored, coalesce(balls_faced, 0) AS balls_faced, coalesce(fours, 0) AS fours, coalesce(sixes, 0) AS sixes,
    coalesce(was_dismissed, false) AS was_dismissed, floor(runs_scored * 100.0::DOUBLE / nullif(balls_faced, 0) * 100 + 0.5) / 100 AS batting_strike_rate, coalesce(balls_bowled, 0) AS balls_bowled, floor(coalesce(balls_bowled, 0) / 6.0::DOUBLE * 10 + 0.5) / 10 AS overs_bowled,
    coalesce(runs_conceded, 0) AS runs_conceded, coalesce(wickets_taken, 0) AS wickets_taken, floor(runs_conceded * 6.0::DOUBLE / nullif(balls_bowled, 0) * 100 + 0.5) / 100 AS economy_rate
  FROM players p JOIN m USING (match_id)
  LEFT JOIN (SELECT match_id, batter_person_id AS person_id, CAST(sum(runs_batter) AS BIGINT) AS runs_scored, count(*) FILTER (is_legal_ball) AS balls_faced, count(*) FILTER (runs_batter = 4) AS fours, count(*) FILTER (runs_batter = 6) AS sixes, bool_or(is_wicket) AS was_dismissed FROM f WHERE batter_person_id IS NOT NULL GROUP BY 1, 2) b ON b.match_id = p.match_id AND b.person_id = p.person_id
  LEFT JOIN (SELECT match_id, bowler_person_id AS person_id, count(*) FILTER (is_legal_ball) AS balls_bowled, CAST(sum(runs_total) AS BIGINT) AS runs_conceded, count(*) FILTER (is_bowler_wicket) AS wickets_taken FROM f WHERE bowler_person_id IS NOT NULL GROUP BY 1, 2) w ON w.match_id = p.match_id AND w.person_id = p.person_id),
bat AS (
  SELECT batter_person_id AS person_id, batter AS player_name, match_type, season, count(*) AS innings, CAST(sum(r) AS BIGINT) AS total_runs, CAST(sum(l) AS BIGINT) AS total_balls, CAST(sum(a) AS BIGINT) AS total_fours, CAST(sum(s) AS BIGINT) AS total_sixes, max(r) AS highest_score,
    count(*) FILTER (r >= 50) AS fifties, count(*) FILTER (r >= 100) AS hundreds, count(*) FILTER (o) AS dismissals, floor(sum(r)::DOUBLE / nullif(count(*) FILTER (o), 0) * 100 + 0.5) / 100 AS batting_average, floor(sum(r) * 100.0::DOUBLE / nullif(sum(l), 0) * 100 + 0.5) / 100 AS strike_rate
  FROM (SELECT batter_person_id, batter, match_id, innings_number, match_type, season, CAST(sum(runs_batter) AS BIGINT) AS r, count(*) FILTER (is_legal_ball) AS l, count(*) FILTER (runs_batter = 4) AS a, count(*) FILTER (runs_batter = 6) AS s, bool_or(is_wicket) AS o FROM f WHERE batter_person_id IS NOT NULL GROUP BY ALL) GROUP BY 1, 2, 3, 4),
bowl AS (
  SELECT bowler_person_id AS person_id, bowler AS player_name, match_type, season, count(*) AS innings_bowled, CAST(sum(l) AS BIGINT) AS total_balls, CAST(sum(r) AS BIGINT) AS total_runs, CAST(sum(w) AS BIGINT) AS total_wickets, max(w) AS best_innings_wickets,
    floor(sum(l) / 6.0::DOUBLE * 10 + 0.5) / 10 AS overs_bowled, floor(sum(r) * 6.0::DOUBLE / nullif(sum(l), 0) * 100 + 0.5) / 100 AS economy_rate, floor(sum(r)::DOUBLE / nullif(sum(w), 0) * 100 + 0.5) / 100 AS bowling_average, floor(sum(l)::DOUBLE / nullif(sum(w), 0) * 100 + 0.5) / 100 AS bowling_strike_rate
  FROM (SELECT bowler_person_id, bowler, match_id, innings_number, match_type, season, count(*) FILTER (is_legal_ball) AS l, CAST(sum(runs_total) AS BIGINT) AS r, count(*) FILTER (is_bowler_wicket) AS w FROM f WHERE bowler_person_id IS NOT NULL GROUP BY ALL) GROUP BY 1, 2, 3, 4),
duel AS (
  SELECT batter_person_id, batter AS batter_name, bowler_person_id, bowler AS bowler_name, match_type, count(*) AS balls_faced, count(*) FILTER (is_legal_ball) AS legal_balls, CAST(sum(runs_batter) AS BIGINT) AS runs_scored, count(*) FILTER (is_dot_ball) AS dot_balls,
    count(*) FILTER (runs_batter = 4) AS fours, count(*) FILTER (runs_batter = 6) AS sixes, count(*) FILTER (is_wicket) AS dismissals, floor(sum(runs_batter) * 100.0::DOUBLE / nullif(count(*) FILTER (is_legal_ball), 0) * 100 + 0.5) / 100 AS strike_rate,
    floor(count(*) FILTER (is_dot_ball) * 100.0::DOUBLE / nullif(count(*) FILTER (is_legal_ball), 0) * 100 + 0.5) / 100 AS dot_ball_pct
  FROM f WHERE batter_person_id IS NOT NULL AND bowler_person_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= 6),
own AS (
  SELECT batter, f.match_type, f.season, f.match_id, innings_number, year(match_date) AS year, city, event_name, CAST(sum(runs_batter) AS BIGINT) AS r, count(*) FILTER (is_legal_ball) AS l, max(CASE WHEN is_wicket AND player_out = batter THEN 1 ELSE 0 END) AS o
  FROM f JOIN m USING (match_id) GROUP BY ALL),
e AS (SELECT *, CAST(ts AS DATE) AS day FROM events)
"""


def r(x: str, digits: int = 2) -> str:
    """Rounded half away from zero on the scaled double."""
    return f"(sign({x}) * floor(abs({x}) * {10**digits} + 0.5) / {10**digits} + 0.0::DOUBLE)"


CAREER = f"""count(DISTINCT match_id) AS matches, count(*) AS innings, CAST(sum(r) AS BIGINT) AS runs, count(*) FILTER (r >= 100) AS hundreds, count(*) FILTER (r >= 50 AND r < 100) AS fifties, max(r) AS high_score,
  {r("sum(r)::DOUBLE / nullif(sum(o), 0)")} AS average, {r("sum(r) * 100.0::DOUBLE / nullif(sum(l), 0)")} AS strike_rate"""
TEAM = f"""SELECT team, match_type, season, count(*) AS matches_played, count(*) FILTER (winner = team) AS wins, count(*) FILTER (winner IS NOT NULL AND winner <> team AND %s NOT IN ('tie', 'no result')) AS losses,
  count(*) FILTER (outcome_result = 'tie') AS ties, count(*) FILTER (outcome_result = 'no result') AS no_results, count(*) FILTER (toss_winner = team) AS toss_wins, {r("count(*) FILTER (winner = team) * 100.0::DOUBLE / count(*)")} AS win_pct
  FROM (SELECT *, team_a AS team FROM m UNION ALL SELECT *, team_b AS team FROM m) GROUP BY 1, 2, 3"""
VENUE = f"""SELECT a.*, chasing_matches, chasing_wins, {r("chasing_wins * 100.0::DOUBLE / nullif(chasing_matches, 0)")} AS chasing_win_pct FROM (
  SELECT venue, match_type, count(DISTINCT match_id) AS matches, {r("avg(CASE WHEN innings_number = 1 THEN total_runs END)", 1)} AS avg_first_innings_score, {r("avg(CASE WHEN innings_number = 2 THEN total_runs END)", 1)} AS avg_second_innings_score,
    {r("sum(total_runs) * 6.0::DOUBLE / nullif(sum(legal_balls), 0)")} AS overall_run_rate, {r("sum(boundaries) * 100.0::DOUBLE / nullif(sum(legal_balls), 0)")} AS boundary_pct, {r("sum(sixes) * 100.0::DOUBLE / nullif(sum(legal_balls), 0)")} AS six_pct FROM fi GROUP BY 1, 2) a
  LEFT JOIN (SELECT venue, match_type, count(*) AS chasing_matches, count(*) FILTER (team = winner) AS chasing_wins FROM m JOIN innings i USING (match_id) WHERE i.innings_number = 2 AND winner IS NOT NULL %s GROUP BY 1, 2) c USING (venue, match_type)"""
PHASE = "CASE WHEN match_type IN ('T20','IT20','T20B') THEN CASE WHEN over_number < 6 THEN 'powerplay' WHEN over_number < 15 THEN 'middle' ELSE 'death' END WHEN match_type IN ('ODI','ODM') THEN CASE WHEN over_number < 10 THEN 'powerplay' WHEN over_number < 40 THEN 'middle' ELSE 'death' END END"
PCT = lambda a, b: f"least(99.9999, coalesce({r(f'CAST({a} AS DOUBLE) * 100 / nullif({b}, 0)', 4)}, 0))"
STATUS = "CASE WHEN total = 0 AND lim > 0 THEN 'SKIPPED' WHEN NOT (CASE WHEN lim = 0 THEN failed > 0 ELSE failed * 100.0 > lim * total END) THEN 'PASSED' WHEN severity = 'BLOCK' THEN 'FAILED' ELSE 'WARNING' END"


def checks(*rows: tuple[str, str, str, str, float, str]) -> str:
    """(check, layer, table, severity, limit, `select failed, total from ...`)."""
    parts = " UNION ALL ".join(f"SELECT '{c}' AS check_id, '{la}' AS layer, '{t}' AS table_name, '{s}' AS severity, {li} AS lim, CAST(failed AS BIGINT) AS failed, CAST(total AS BIGINT) AS total FROM ({q}) z" for c, la, t, s, li, q in rows)
    return f"SELECT check_id, layer, table_name, severity, {STATUS} AS status, failed, total, {PCT('failed', 'total')} AS pct FROM ({parts})"


def surplus(table: str, *cols: str) -> str:
    return f"SELECT count(*) - count(DISTINCT ({', '.join(cols)})) AS failed, count(*) AS total FROM {table}"


def nulls(table: str, *cols: str) -> str:
    return f"SELECT count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in cols)}) AS failed, count(*) AS total FROM {table}"


GROUP = "CASE WHEN event_name IS NOT NULL AND k % 4 = 1 THEN list_extract(['A', 'B', 'C'], CAST(k % 3 + 1 AS INTEGER)) END"
BALL = ("match_id", "innings_number", "over_number", "delivery_number")
OLD = "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 7 <> 0"
NEW = f"SELECT c_custkey, 'NEW' AS c_mktsegment, round(c_acctbal + 1, 2) AS c_acctbal FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 7 = 0"
LANDED = "SELECT *, user_id || '-' || event_type AS match_id, CAST(event_id % 9 AS VARCHAR) AS revision FROM e"
CATALOG = "SELECT event_type AS table_name, day(day) AS snapshot, 'c' || (user_id % 4) AS column_name, CASE WHEN count(*) > 2 THEN 'long' ELSE 'int' END AS column_type FROM e GROUP BY 1, 2, 3"
MONTHS = """SELECT month AS file_name, sha256(content) AS content_hash, CAST(strlen(content) AS BIGINT) AS size
    FROM (SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month, string_agg(o_orderkey || ':' || o_custkey || ':' || o_orderstatus || chr(10), '' ORDER BY o_orderkey) AS content FROM orders GROUP BY 1)"""
AWARD = "SELECT DISTINCT match_id, unnest(player_of_match) AS player_name FROM m WHERE player_of_match IS NOT NULL"
RUN_LOG = "SELECT count(*) AS attempted, count(*) FILTER (o_orderstatus = 'P') AS failed FROM orders"
SILVER_ROWS = (
    ("matches", "m"), ("innings", "innings"), ("powerplays", "(SELECT * FROM innings WHERE limit_overs IS NOT NULL)"), ("deliveries", "deliveries"), ("wickets", "wickets"), ("registry", "registry"), ("replacements", "(SELECT * FROM b WHERE l_partkey % 37 = 0 UNION ALL SELECT * FROM b WHERE l_partkey % 41 = 0 OR l_partkey % 53 = 0)"),
    ("match_players", "players"), ("match_officials", "officials"), ("unmatched_persons_audit", "(SELECT DISTINCT match_id, role, display_name FROM unmatched)"),
    ("teams", "(SELECT team_a FROM m UNION SELECT team_b FROM m)"), ("venues", "(SELECT DISTINCT venue, city FROM m)"), ("competitions", "(SELECT DISTINCT event_name FROM m WHERE event_name IS NOT NULL)"),
)
GRAIN = checks(
    ("GRAIN", "driver", "lineitem", "BLOCK", 0, surplus("lineitem", "l_orderkey", "l_linenumber")), ("NULLS", "driver", "lineitem", "BLOCK", 0, nulls("lineitem", "l_orderkey", "l_shipdate")), ("VALUES", "driver", "lineitem", "WARN", 0, "SELECT count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS failed, count(*) AS total FROM lineitem"),
    ("LABELS", "driver", "labels", "WARN", 0, "SELECT (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS failed, (SELECT count(*) FROM labels) AS total"),
    ("UNLABELLED", "driver", "documents", "WARN", 0, "SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS failed, (SELECT count(*) FROM documents) AS total"),
    ("MAT-SLV-007", "silver", "match_players", "WARN", 0, "SELECT (SELECT count(*) FROM players WHERE person_id IS NOT NULL AND person_id NOT IN (SELECT identifier FROM people)) AS failed, (SELECT count(*) FROM players) AS total"),
)


def model_test(table: str, source: str, column: str, test: str, failures: str) -> str:
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test, CAST({failures} AS BIGINT) AS failures FROM {source}"


def model_tests() -> list[tuple[str, str, str, str, str]]:
    """(table, source, column, test, failures) for each model: columns that may not be null, then those that are unique, then values."""
    phases = f"(SELECT DISTINCT match_type, season, {PHASE} AS phase FROM f WHERE {PHASE} IS NOT NULL)"
    spine = "(SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, d AS date FROM range(TIMESTAMP '1970-01-01', TIMESTAMP '2036-01-01', INTERVAL 1 DAY) t(d))"
    duel = "(SELECT * FROM duel WHERE balls_faced >= 6)"
    declared = {
        "dim_player": ("dim_player", "person_id", "person_id"), "dim_team": ("(SELECT team_a AS team_name FROM m UNION SELECT team_b FROM m)", "team_name", "team_name"), "dim_venue": ("(SELECT DISTINCT venue AS venue_name FROM m)", "venue_name", "venue_name"),
        "dim_competition": ("(SELECT DISTINCT event_name AS competition_name FROM m WHERE event_name IS NOT NULL)", "competition_name", "competition_name"), "dim_date": (spine, "date_id date", "date_id"), "player_display_names": ("shown", "cricsheet_name display_name", "cricsheet_name"),
        "dim_match": ("dim_match", "match_id match_type", "match_id"), "fact_delivery": ("f", "match_id innings_number over_number delivery_number match_type", ""), "fact_innings": ("fi", "match_id innings_number team", ""), "fact_match_result": ("dim_match", "match_id", "match_id"),
        "fact_player_match": ("fp", "match_id", ""), "fact_player_of_match": (f"({AWARD})", "match_id player_name", ""), "mart_player_batting": ("bat", "person_id match_type", ""), "mart_player_bowling": ("bowl", "person_id match_type", ""),
        "mart_team_performance": ("(SELECT team_a AS team, match_type FROM m UNION SELECT team_b, match_type FROM m)", "team match_type", ""), "mart_venue_dna": ("(SELECT DISTINCT venue, match_type FROM fi)", "venue match_type", ""), "mart_phase_scoring": (phases, "phase", ""),
        "mart_toss_outcome": ("m", "toss_decision", ""), "mart_matchup": (duel, "batter_person_id bowler_person_id", ""),
    }
    out = [(t, source, c, "not_null", f"count(*) FILTER ({c} IS NULL)") for t, (source, columns, _) in declared.items() for c in columns.split()]
    out += [(t, source, c, "unique", f"count({c}) - count(DISTINCT {c})") for t, (source, _, columns) in declared.items() for c in columns.split()]
    out += [("dim_match", "dim_match", "match_type", "accepted_values", "count(*) FILTER (match_type NOT IN ('T20', 'ODI', 'Test', 'IT20', 'ODM', 'MDM', 'T20B', 'hundred'))")]
    out += [("mart_phase_scoring", phases, "phase", "accepted_values", "count(*) FILTER (phase NOT IN ('powerplay', 'middle', 'death'))"), ("mart_toss_outcome", "m", "toss_decision", "accepted_values", "count(*) FILTER (toss_decision NOT IN ('bat', 'field'))")]
    return [*out, ("fact_player_of_match", f"({AWARD})", "match_id", "relationships", "count(*) FILTER (match_id NOT IN (SELECT match_id FROM dim_match))")]


LINES = """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS k, l_orderkey % 3 AS third, CAST(CASE WHEN l_orderkey % 3 = 2 THEN l_quantity ELSE CAST(l_quantity AS INTEGER) END AS DOUBLE) AS n,
    CASE WHEN l_orderkey % 3 = 1 THEN l_tax END AS tax, l_partkey AS part, CASE WHEN l_orderkey % 3 = 1 THEN l_suppkey END AS supplier, CASE WHEN l_orderkey % 3 = 1 THEN l_returnflag END AS flag FROM lineitem"""
SWAPS = """SELECT * EXCLUDE (n), CASE WHEN l_partkey % 2 = 0 THEN 'concussion_substitute' ELSE 'injury' END AS reason FROM (
    SELECT x.match_id, innings_number, over_number, delivery_number, l_partkey, 'role' AS scope, CASE WHEN innings_number = 1 THEN team_b ELSE team_a END AS team, 'Q' || (l_suppkey % 9) AS player_in, bowler AS player_out, 'bowler' AS role, 1 AS n FROM b x JOIN m USING (match_id) WHERE l_partkey % 37 = 0
    UNION ALL SELECT x.match_id, innings_number, over_number, delivery_number, l_partkey, 'match', CASE WHEN (innings_number = 1) = (l_partkey % 41 = 0) THEN team_a ELSE team_b END, CASE WHEN l_partkey % 41 = 0 THEN 'S' || (l_suppkey % 3) ELSE 'F' || (l_suppkey % 2) END, CASE WHEN l_partkey % 41 = 0 THEN batter ELSE bowler END, NULL, 2
      FROM b x JOIN m USING (match_id) WHERE l_partkey % 41 = 0 OR l_partkey % 53 = 0)"""
ELEVENS = f"""WITH swap AS (SELECT match_id, team, innings_number * 1000000 + over_number * 1000 + delivery_number AS pos, player_in, player_out FROM ({SWAPS}) WHERE scope = 'match'),
    ev AS (SELECT match_id, team, pos, player_in AS player, true AS enters FROM swap UNION ALL SELECT match_id, team, pos, player_out, false FROM swap),
    who AS (SELECT match_id, team, player_name AS player FROM players UNION SELECT match_id, team, player FROM ev),
    cand AS (SELECT w.*, coalesce(NOT arg_min(e.enters, e.pos), true) AS starts FROM who w LEFT JOIN ev e ON e.match_id = w.match_id AND e.team = w.team AND e.player = w.player GROUP BY ALL),
    eff AS (SELECT match_id, team, pos FROM (SELECT e.*, coalesce(lag(e.enters) OVER (PARTITION BY e.match_id, e.team, e.player ORDER BY e.pos), c.starts) AS before FROM ev e JOIN cand c ON c.match_id = e.match_id AND c.team = e.team AND c.player = e.player) WHERE before <> enters),
    ball AS (SELECT d.*, innings_number * 1000000 + over_number * 1000 + delivery_number AS pos, CASE WHEN innings_number = 1 THEN team_a ELSE team_b END AS bt, CASE WHEN innings_number = 1 THEN team_b ELSE team_a END AS ft FROM deliveries d JOIN m USING (match_id)),
    sided AS (SELECT *, bt AS team, 'bat' AS side FROM ball UNION ALL SELECT *, ft, 'field' FROM ball),
    state AS (
      SELECT s.match_id, s.innings_number, s.over_number, s.delivery_number, s.bt, s.ft, s.batter, s.bowler, s.side, s.team, s.pos, c.player, coalesce(arg_max(e.enters, e.pos), any_value(c.starts)) AS present
      FROM sided s JOIN cand c ON c.match_id = s.match_id AND c.team = s.team LEFT JOIN ev e ON e.match_id = c.match_id AND e.team = c.team AND e.player = c.player AND e.pos <= s.pos GROUP BY ALL),
    told AS (SELECT match_id, innings_number, over_number, delivery_number, bt, ft, batter, bowler, side, team, pos, coalesce(string_agg(player, ',' ORDER BY player) FILTER (present), '') AS eleven, bool_or(present AND player = batter) AS has_batter, bool_or(present AND player = bowler) AS has_bowler FROM state GROUP BY ALL)
    SELECT t.*, (SELECT count(DISTINCT pos) FROM eff WHERE eff.match_id = t.match_id AND eff.team = t.team AND eff.pos <= t.pos) AS version FROM told t"""

MODEL_TESTS = model_tests()
NAMED = "(SELECT cricsheet_name FROM shown WHERE display_name = 'Star 8')"

SQL: dict[str, str] = {
    "a01_landing_scan": f"SELECT file_name, content_hash, size FROM ({MONTHS})",
    "a01_stream_restart": "SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS match_id, '1' AS revision, CAST(count(*) AS VARCHAR) AS season FROM orders GROUP BY 1",
    "a02_header_projection": "SELECT match_id, true AS ok, match_type, gender, season, CAST(match_date AS VARCHAR) AS match_date, team_a, team_b, venue, coalesce(city, '') AS city FROM m",
    "a03_register_csv": "SELECT identifier, name, unique_name FROM people_rows",
    "a04_filtered_projection": "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45",
    "a05_watermark_read": "SELECT event_type, count(*) AS n FROM e WHERE day >= DATE '2024-01-15' GROUP BY 1",
    "a06_between_versions": "SELECT day, count(*) AS n FROM e WHERE day > DATE '2024-01-05' AND day <= DATE '2024-01-10' GROUP BY 1",
    "a07_as_of_read": "SELECT user_id, count(*) AS n FROM e WHERE day <= DATE '2024-01-10' GROUP BY 1",
    "a08_latest_snapshot": "SELECT event_id, event_type FROM e WHERE day = (SELECT max(day) FROM e)",
    "a09_exact_snapshot": "SELECT event_id, event_type FROM e WHERE day = DATE '2024-01-07'",
    "a10_key_scoped_read": "SELECT match_id, count(*) AS n FROM deliveries WHERE match_id IN (SELECT match_id FROM audit WHERE silver_loaded_at IS NULL) GROUP BY 1",
    "a11_readiness": "SELECT count(*) AS n, max(day) AS newest FROM e WHERE day <= DATE '2024-01-10'",
    "a12_sql_entry": "SELECT match_type, count(*) AS n FROM m WHERE winner IS NOT NULL GROUP BY 1",
    "a13_schema_listing": "SELECT table_name, 1 AS snapshot, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' ELSE 'timestamp_ntz' END AS column_type FROM information_schema.columns WHERE table_name IN ('customer', 'documents', 'lineitem', 'orders')",
    "a14_alias_seed": "SELECT * FROM aliases",
    "a15_inventory": f"SELECT file_name, file_name AS match_id, content_hash, size FROM ({MONTHS})",
    "a16_staging_views": " UNION ALL ".join(f"SELECT 'stg_silver_{n}' AS view_name, count(*) AS n FROM {t}" for n, t in (("matches", "m"), ("innings", "innings"), ("deliveries", "deliveries"), ("wickets", "wickets"), ("registry", "registry"), ("teams", "(SELECT team_a FROM m UNION SELECT team_b FROM m)"), ("venues", "(SELECT DISTINCT venue, city FROM m)"), ("competitions", "(SELECT DISTINCT event_name FROM m WHERE event_name IS NOT NULL)"), ("persons", "persons"), ("person_identifiers", "identifiers"), ("name_variations", "variations"), ("match_players", "players"))),
    "a17_info_pivot_and_clean": """SELECT match_id, team1, team2, outcome, wr AS winner_runs, ww AS winner_wickets, wr + ww AS results,
        CASE WHEN outcome IS NOT NULL THEN outcome WHEN o_orderstatus = 'F' THEN 'defended' WHEN o_orderstatus = 'O' THEN 'chased' END AS result_type FROM (
        SELECT o_orderkey AS match_id, o_orderstatus, CAST(o_custkey AS VARCHAR) AS team1, CAST(o_custkey + 1 AS VARCHAR) AS team2, CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'tie' ELSE 'no result' END END AS outcome,
        CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 97 ELSE 0 END AS wr, CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 10 ELSE 0 END AS ww FROM orders)""",
    "a19_ball_csv": "SELECT match_id, CAST(innings_number AS VARCHAR) AS innings_number, CAST(over_number AS VARCHAR) AS over_number, CAST(delivery_number AS VARCHAR) AS delivery_number, batter, bowler, CAST(runs_total AS VARCHAR) AS runs_total FROM deliveries",
    "b01_append": f"{OLD} UNION ALL {NEW}",
    "b02_create_if_missing": f"{OLD} UNION ALL {NEW}",
    "b03_partition_overwrite": "SELECT event_id, event_type, day, 1 AS version FROM e WHERE day < DATE '2024-01-20' UNION ALL SELECT event_id, event_type, day, CASE WHEN changed THEN 2 ELSE 1 END FROM (SELECT *, bool_or(event_id % 2 = 0) OVER (PARTITION BY day) AS changed FROM e WHERE day >= DATE '2024-01-20') WHERE NOT changed OR event_id % 2 = 0",
    "b04_keyed_replace": f"SELECT * FROM ({OLD}) WHERE c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 UNION ALL {NEW}",
    "b05_upsert_table": f"SELECT * FROM ({OLD}) WHERE c_custkey % 3 <> 0 UNION ALL {NEW}",
    "b06_delete_snapshot": "SELECT day, count(*) AS n FROM e WHERE day <> DATE '2024-01-10' GROUP BY 1",
    "b05_upsert": f"SELECT * FROM ({OLD}) WHERE c_custkey % 3 <> 0 UNION ALL {NEW}",
    "b05_upsert_subset": f"SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(o.c_mktsegment, n.c_mktsegment) AS c_mktsegment, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal FROM ({OLD}) o FULL JOIN ({NEW}) n ON o.c_custkey = n.c_custkey",
    "b07_purge": "SELECT t AS table_name, day, count(*) AS n FROM e, (VALUES ('first'), ('second')) v(t) WHERE day >= DATE '2024-01-20' GROUP BY 1, 2",
    "b08_metadata_columns": "SELECT n_nationkey, n_name, 'run-1' AS _pipeline_run_id FROM nation",
    "b09_layout": "SELECT l_orderkey, l_linenumber, l_quantity, year(l_shipdate) AS year FROM lineitem",
    "b09_range_layout": "SELECT year(l_shipdate) AS year, count(*) AS n_rows, count(*) > (SELECT count(*) FROM lineitem) / 20 AS split, true AS in_order FROM lineitem GROUP BY 1",
    "b05_growing_table": """SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey > size * 8 THEN round(c_acctbal + 64, 2) WHEN c_custkey > size THEN round(c_acctbal + 8, 2) ELSE round(c_acctbal + 2, 2) END AS c_acctbal, true AS enough_buckets
        FROM customer, (SELECT greatest(1, count(*) // 64) AS size FROM customer)""",
    "b10_export": f"SELECT 'dim_match' AS table_name, count(*) AS n_rows FROM m UNION ALL SELECT 'dim_team', count(*) FROM (SELECT team_a FROM m UNION SELECT team_b FROM m) UNION ALL SELECT 'fact_innings', count(*) FROM innings UNION ALL SELECT 'mart_toss_outcome', count(*) FROM (SELECT DISTINCT match_type, season, toss_decision FROM m)",
    "b11_report_csv": "SELECT match_type AS format, CAST(count(*) AS VARCHAR) AS matches FROM m GROUP BY 1",
    "b12_incremental_scope": "SELECT match_id, count(*) AS balls FROM f WHERE match_id IN (SELECT match_id FROM audit WHERE gold_loaded_at IS NULL) GROUP BY 1",
    "b12_incremental_gold": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}" for n, t in (("dim_match", "m"), ("dim_team", "(SELECT team_a FROM m UNION SELECT team_b FROM m)"), ("dim_venue", "(SELECT DISTINCT venue FROM m)"), ("dim_competition", "(SELECT DISTINCT event_name FROM m WHERE event_name IS NOT NULL)"), ("fact_delivery", "f"), ("fact_innings", "innings"), ("fact_match_result", "m"), ("fact_player_match", "fp"), ("fact_player_of_match", f"({AWARD})"))),
    "b13_full_refresh": NEW,
    "c01_content_skip": "SELECT doc_id, sha256(text) AS content_hash FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 3 = 0)",
    "c01_indexed_skip": """SELECT doc_id, content_hash, load FROM (SELECT *, min(load) OVER (PARTITION BY content_hash) AS first FROM (SELECT doc_id, sha256(coalesce(text, '')) AS content_hash, CASE doc_id % 8 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS load FROM documents)) WHERE load = first""",
    "c11_indexed_loads": """SELECT match_id, CASE WHEN k % 10 = 3 THEN 'rejected' ELSE '1' END AS revision, '' AS venue, CASE WHEN k % 10 <> 3 THEN DATE '2023-12-01' END AS _snapshot_date FROM m
        UNION ALL SELECT match_id, '2', 'new', DATE '2024-01-01' FROM m WHERE k % 5 = 0""",
    "c02_max_revision": f"SELECT match_id, max(CAST(revision AS BIGINT)) AS max_revision FROM ({LANDED}) GROUP BY 1",
    "c03_revision_assignment": f"SELECT n.match_id, n.file_name, CAST(coalesce(x, 0) + row_number() OVER (PARTITION BY n.match_id ORDER BY n.file_name) AS VARCHAR) AS revision FROM (SELECT match_id, lpad(CAST(event_id AS VARCHAR), 12, '0') AS file_name FROM ({LANDED}) WHERE event_id % 2 = 1) n LEFT JOIN (SELECT match_id, max(CAST(revision AS BIGINT)) AS x FROM ({LANDED}) WHERE event_id % 2 = 0 GROUP BY 1) o USING (match_id)",
    "c04_idempotency": "SELECT d AS snapshot_date, exists(SELECT 1 FROM e WHERE CAST(day AS VARCHAR) = d AND event_type <> 'error') AS loaded, false AS loaded_with_force FROM (VALUES ('2024-01-05'), ('2024-01-06'), ('2031-01-01')) v(d)",
    "c05_row_hash": "SELECT doc_id, sha256(doc_id || '|' || coalesce(lang, '__NULL__') || '|' || coalesce(source, '__NULL__') || '|' || coalesce(CASE WHEN doc_id % 5 <> 0 THEN CAST(n_chars AS VARCHAR) END, '__NULL__')) AS row_hash FROM documents",
    "c07_identifier_unpivot": "SELECT identifier, source_system AS key_source, source_identifier AS key_value FROM identifiers UNION ALL SELECT identifier, 'cricsheet', 'r-P' || k FROM people_rows WHERE name LIKE 'Aaron%' AND k % 3 <> 0",
    "c08_name_variations": "SELECT * FROM variations",
    "c10_register_load": """SELECT 'people' AS table_name, DATE '2024-01-01' AS _snapshot_date, count(*) AS n_rows, count(DISTINCT (identifier, name, unique_name)) AS n_hashes FROM people_rows
        UNION ALL SELECT 'people', DATE '2023-12-01', count(*), count(DISTINCT person_id) FROM persons WHERE _snapshot_date = DATE '2023-12-01'
        UNION ALL SELECT 'people_identifiers', DATE '2024-01-01', (SELECT count(*) FROM identifiers) + (SELECT count(*) FROM people_rows WHERE name LIKE 'Aaron%' AND k % 3 <> 0), (SELECT count(*) FROM identifiers)
        UNION ALL SELECT 'name_variations', d, count(*), count(*) FROM variations, (VALUES (DATE '2024-01-01'), (DATE '2023-12-01')) v(d) GROUP BY 2""",
    "c11_bronze_load_counts": "SELECT count(*) AS attempted, count(*) FILTER (k % 4 = 0) AS skipped, count(*) FILTER (k % 4 <> 0 AND k % 10 <> 0) AS succeeded, count(*) FILTER (k % 4 <> 0 AND k % 10 = 0) AS failed, count(*) FILTER (k % 4 <> 0 AND k % 10 <> 0) AS rows_written FROM m",
    "d01_latest_revision": f"SELECT match_id, revision, event_id FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY CAST(revision AS BIGINT) DESC, ts DESC, event_id DESC) AS n FROM ({LANDED})) WHERE n = 1",
    "d02_json_parse": "SELECT match_id, '1.1.0' AS data_version, 2 AS n_innings, 2 AS n_teams, CAST(match_date AS VARCHAR) AS dates, season FROM m",
    "d04_matches": f"SELECT d.*, array_to_string(player_of_match, ',') AS player_of_match, {GROUP.replace('event_name', 'm.event_name')} AS group_label, k % 23 = 0 AS has_missing_data FROM dim_match d JOIN m USING (match_id)",
    "d05_innings": "SELECT match_id, innings_number, team, super_over, declared, forfeited, target_runs, target_overs FROM innings",
    "d06_deliveries": "SELECT * FROM deliveries",
    "d07_wickets": "SELECT * FROM wickets",
    "d08_powerplays": "SELECT match_id, innings_number, 0.1::DOUBLE AS from_over, CASE WHEN limit_overs = 20 THEN 5.6::DOUBLE ELSE 9.6::DOUBLE END AS to_over, 'mandatory' AS type FROM innings WHERE limit_overs IS NOT NULL",
    "d09_registry": "SELECT * FROM registry",
    "d10_teams": "SELECT team_name, max(team_type) AS team_type FROM (SELECT team_a AS team_name, team_type FROM m UNION ALL SELECT team_b, team_type FROM m) GROUP BY 1",
    "d11_venues": "SELECT DISTINCT venue AS venue_name, city FROM m",
    "d12_competitions": f"SELECT event_name AS competition_name, string_agg(DISTINCT {GROUP}, ', ' ORDER BY {GROUP}) AS group_label FROM m WHERE event_name IS NOT NULL GROUP BY 1",
    "d13_match_players": "SELECT match_id, team, player_name, person_id FROM players",
    "d14_match_officials": "SELECT match_id, role, official_name, person_id FROM officials",
    "d15_unmatched_audit": "SELECT DISTINCT ON (match_id, role, display_name) * FROM unmatched",
    "d16_persons": "SELECT * FROM persons",
    "d17_person_identifiers": "SELECT * FROM identifiers",
    "d19_silver_build": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}" for n, t in SILVER_ROWS),
    "e01_resolution_paths": "SELECT * FROM players",
    "s06_document_checks": "SELECT match_id, coalesce(bool_and(registered), true) AS registry_complete, true AS version_supported, true AS has_innings, bool_or(k % 23 = 0) AS has_missing_data FROM (SELECT m.match_id, m.k, CAST(substr(player_name, 2) AS INTEGER) % 4 <> 0 AS registered FROM m LEFT JOIN squads USING (match_id)) GROUP BY 1",
    "f01_dim_match": "SELECT * FROM dim_match",
    "f02_dim_player": "SELECT * FROM dim_player",
    "f03_dim_team": "SELECT team_name, max(team_type) AS team_type FROM (SELECT team_a AS team_name, team_type FROM m UNION ALL SELECT team_b, team_type FROM m) GROUP BY 1",
    "f03_team_scope": "SELECT team_a AS team_name FROM m JOIN audit USING (match_id) WHERE gold_loaded_at IS NULL UNION SELECT team_b FROM m JOIN audit USING (match_id) WHERE gold_loaded_at IS NULL",
    "f04_dim_venue": "SELECT venue AS venue_name, min(city) AS city FROM m GROUP BY 1",
    "f05_dim_competition": "SELECT DISTINCT event_name AS competition_name FROM m WHERE event_name IS NOT NULL",
    "f06_dim_date": """SELECT DISTINCT d AS date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, year(d) AS year, month(d) AS month, day(d) AS day, dayofyear(d) AS day_of_year, quarter(d) AS quarter, CAST(strftime(d, '%W') AS BIGINT) AS week_of_year,
        CAST(strftime(d, '%w') AS BIGINT) AS day_of_week, strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month, CAST(strftime(d, '%w') AS BIGINT) IN (0, 6) AS is_weekend FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "f07_player_display_names": "SELECT * FROM shown",
    "f08_fact_delivery": "SELECT * FROM f",
    "f09_fact_innings": "SELECT * FROM fi",
    "f10_fact_match_result": "SELECT match_id, season, match_type, gender, match_date, team_a, team_b, venue, city, event_name, toss_winner, toss_decision, winner, outcome_result, outcome_method, win_by_runs, win_by_wickets, win_by_innings, toss_winner = winner AS toss_winner_won, CASE winner WHEN team_a THEN team_b WHEN team_b THEN team_a END AS loser FROM dim_match",
    "f11_fact_player_match": "SELECT * FROM fp",
    "f12_fact_player_of_match": "SELECT DISTINCT match_id, unnest(player_of_match) AS player_name FROM m WHERE player_of_match IS NOT NULL",
    "g01_player_batting": "SELECT * FROM bat",
    "g02_player_bowling": "SELECT * FROM bowl",
    "g03_team_performance": TEAM % "outcome_result",
    "g03_team_performance_fixed": TEAM % "coalesce(outcome_result, '')",
    "g04_venue_dna": VENUE % "AND outcome_result = 'win'",
    "g04_venue_dna_fixed": VENUE % "",
    "g05_phase_scoring": f"""SELECT match_type, season, phase, count(*) AS total_deliveries, count(*) FILTER (is_legal_ball) AS legal_balls, CAST(sum(runs_total) AS BIGINT) AS total_runs, count(*) FILTER (is_wicket) AS wickets,
        {r("sum(runs_total) * 6.0::DOUBLE / nullif(count(*) FILTER (is_legal_ball), 0)")} AS run_rate, {r("count(*) FILTER (runs_batter IN (4, 6)) * 100.0::DOUBLE / nullif(count(*) FILTER (is_legal_ball), 0)")} AS boundary_pct,
        {r("count(*) FILTER (is_dot_ball) * 100.0::DOUBLE / nullif(count(*) FILTER (is_legal_ball), 0)")} AS dot_ball_pct, {r("count(*) FILTER (is_wicket) * 100.0::DOUBLE / nullif(count(*) FILTER (is_legal_ball), 0)")} AS wicket_pct
        FROM (SELECT *, {PHASE} AS phase FROM f) WHERE phase IS NOT NULL GROUP BY 1, 2, 3""",
    "g06_toss_outcome": f"""SELECT match_type, season, toss_decision, count(*) AS matches, count(*) FILTER (toss_winner = winner) AS toss_winner_won, count(*) FILTER (toss_decision = 'bat') AS chose_bat, count(*) FILTER (toss_decision = 'field') AS chose_field,
        count(*) FILTER (toss_decision = 'bat' AND toss_winner = winner) AS bat_first_and_won, count(*) FILTER (toss_decision = 'field' AND toss_winner = winner) AS field_first_and_won, {r("count(*) FILTER (toss_winner = winner) * 100.0::DOUBLE / count(*)")} AS toss_win_match_win_pct FROM m GROUP BY 1, 2, 3""",
    "g07_matchup_analysis": "SELECT * FROM duel",
    "h01_counters": "SELECT (SELECT count(*) FROM m) AS total_matches, (SELECT count(DISTINCT season) FROM m) AS total_seasons, (SELECT count(*) FROM f) AS total_deliveries, (SELECT count(*) FROM dim_player) AS total_players",
    "h02_matches_per_year": "SELECT year(match_date) AS year, count(*) AS matches FROM m GROUP BY 1",
    "h03_format_breakdown": "SELECT match_type AS format, count(*) AS matches FROM m GROUP BY 1",
    "h04_top_venues": "SELECT venue, count(*) AS matches FROM m GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "h05_top_run_scorers": "SELECT batter AS player, CAST(sum(runs_batter) AS BIGINT) AS runs, count(*) FILTER (is_legal_ball) AS balls, count(DISTINCT match_id) AS matches FROM f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "h06_top_wicket_takers": "SELECT bowler AS player, count(*) FILTER (is_bowler_wicket) AS wickets, count(DISTINCT match_id) AS matches FROM f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "h07_highest_score": "SELECT player, score, match_type FROM (SELECT batter AS player, match_id, innings_number, match_type, CAST(sum(runs_batter) AS BIGINT) AS score FROM f GROUP BY ALL ORDER BY score DESC, player, match_id, innings_number LIMIT 1)",
    "h07_highest_score_mart": "SELECT player_name, highest_score, match_type FROM bat ORDER BY highest_score DESC, player_name, match_type, season LIMIT 1",
    "h08_season_leader_runs": "SELECT player_name, total_runs FROM bat WHERE season = (SELECT max(season) FROM bat) ORDER BY total_runs DESC, player_name, match_type LIMIT 1",
    "h08_season_leader_wickets": "SELECT player_name, total_wickets FROM bowl WHERE season = (SELECT max(season) FROM bowl) ORDER BY total_wickets DESC, player_name, match_type LIMIT 1",
    "h09_top_matchups": f"SELECT batter, bowler, match_type, count(*) FILTER (is_legal_ball) AS balls, CAST(sum(runs_batter) AS BIGINT) AS runs, count(*) FILTER (is_bowler_wicket) AS dismissals, {r('sum(runs_batter) * 100.0::DOUBLE / nullif(count(*) FILTER (is_legal_ball), 0)')} AS strike_rate FROM f GROUP BY 1, 2, 3 HAVING count(*) FILTER (is_legal_ball) >= 2 ORDER BY 4 DESC, 1, 2, 3 LIMIT 25",
    "h09_top_matchups_mart": f"SELECT batter_name, bowler_name, match_type, CAST(sum(balls_faced) AS BIGINT) AS balls, CAST(sum(runs_scored) AS BIGINT) AS runs, CAST(sum(dismissals) AS BIGINT) AS dismissals, {r('avg(strike_rate)')} AS strike_rate FROM duel GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 25",
    "h10_player_headline": f"SELECT CAST(sum(r) AS BIGINT) AS runs, count(*) AS innings, CAST(sum(l) AS BIGINT) AS balls, count(*) FILTER (r >= 50) AS fifties, count(*) FILTER (r >= 100) AS hundreds, max(r) AS highest_score, {r('sum(r)::DOUBLE / nullif(sum(o), 0)')} AS batting_avg, {r('sum(r) * 100.0::DOUBLE / nullif(sum(l), 0)')} AS strike_rate FROM (SELECT match_id, innings_number, match_type, CAST(sum(runs_batter) AS BIGINT) AS r, count(*) FILTER (is_legal_ball) AS l, max(CASE WHEN is_wicket AND player_out IN {NAMED} THEN 1 ELSE 0 END) AS o FROM f WHERE batter IN {NAMED} GROUP BY 1, 2, 3)",
    "h10_player_headline_mart": f"SELECT CAST(sum(total_runs) AS BIGINT) AS runs, CAST(sum(innings) AS BIGINT) AS innings, CAST(sum(total_balls) AS BIGINT) AS balls, CAST(sum(fifties) AS BIGINT) AS fifties, CAST(sum(hundreds) AS BIGINT) AS hundreds, max(highest_score) AS highest_score, {r('sum(total_runs)::DOUBLE / nullif(sum(dismissals), 0)')} AS batting_avg, {r('sum(total_runs) * 100.0::DOUBLE / nullif(sum(total_balls), 0)')} AS strike_rate FROM bat WHERE player_name = 'P7'",
    "h11_format_split": f"SELECT match_type, CAST(sum(runs_batter) AS BIGINT) AS runs FROM f WHERE batter IN {NAMED} GROUP BY 1",
    "h11_format_split_mart": "SELECT match_type, CAST(sum(total_runs) AS BIGINT) AS runs, CAST(sum(w) AS BIGINT) AS wickets FROM bat LEFT JOIN (SELECT player_name, match_type, sum(total_wickets) AS w FROM bowl GROUP BY 1, 2) USING (player_name, match_type) WHERE player_name = 'P7' GROUP BY 1",
    "h12_season_trend": f"SELECT season, CAST(sum(runs_batter) AS BIGINT) AS runs FROM f WHERE batter IN {NAMED} GROUP BY 1",
    "h12_season_trend_mart": "SELECT season, CAST(sum(total_runs) AS BIGINT) AS runs, CAST(sum(w) AS BIGINT) AS wickets FROM bat LEFT JOIN (SELECT player_name, season, sum(total_wickets) AS w FROM bowl GROUP BY 1, 2) USING (player_name, season) WHERE player_name = 'P7' GROUP BY 1",
    "h13_bowling_card": f"SELECT count(*) FILTER (is_bowler_wicket) AS wickets, count(DISTINCT match_id || '-' || innings_number) AS innings, count(*) FILTER (is_legal_ball) AS balls_bowled, {r('sum(runs_total) * 6.0::DOUBLE / nullif(count(*) FILTER (is_legal_ball), 0)')} AS economy, {r('sum(runs_total)::DOUBLE / nullif(count(*) FILTER (is_bowler_wicket), 0)')} AS bowling_avg FROM f WHERE bowler IN (SELECT cricsheet_name FROM shown WHERE display_name = 'Q7')",
    "h14_last_innings": "SELECT match_date, match_type, venue, team_a || ' vs ' || team_b AS fixture, r AS runs, l AS balls FROM (SELECT match_id, innings_number, CAST(sum(runs_batter) AS BIGINT) AS r, count(*) FILTER (is_legal_ball) AS l FROM f WHERE batter = 'P7' GROUP BY 1, 2) JOIN m USING (match_id) ORDER BY match_date DESC, match_id, innings_number LIMIT 10",
    "h14_last_matches": "SELECT match_date, m.match_type, p.venue, CASE WHEN team = team_a THEN team_b ELSE team_a END AS opponent, runs_scored, balls_faced, wickets_taken, overs_bowled FROM fp p JOIN m USING (match_id) WHERE player_name = 'P7' ORDER BY match_date DESC, match_id, team LIMIT 10",
    "h15_match_summary": "SELECT match_id, match_date, match_type, venue, team_a || ' vs ' || team_b AS fixture, winner, toss_winner || ' chose to ' || toss_decision AS toss, CASE WHEN win_by_runs > 0 THEN winner || ' won by ' || win_by_runs || ' runs' WHEN win_by_wickets > 0 THEN winner || ' won by ' || win_by_wickets || ' wickets' ELSE outcome_result END AS result FROM m",
    "h16_manhattan": "SELECT match_id, team, over_number + 1 AS over_no, CAST(sum(runs_total) AS BIGINT) AS runs, count(*) FILTER (is_wicket) AS wickets FROM f JOIN innings USING (match_id, innings_number) GROUP BY 1, 2, 3",
    "h17_worm": "SELECT match_id, innings_number, team, row_number() OVER w AS ball_index, CAST(sum(runs_total) OVER (PARTITION BY match_id, innings_number ORDER BY over_number, delivery_number ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_runs FROM f JOIN innings USING (match_id, innings_number) WINDOW w AS (PARTITION BY match_id, innings_number ORDER BY over_number, delivery_number)",
    "h18_top_batters": "SELECT match_id, place, player_name, team, runs_scored, balls_faced, fours, sixes, batting_strike_rate FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY runs_scored DESC, player_name, team) AS place FROM fp WHERE balls_faced > 0) WHERE place <= 5",
    "h18_top_bowlers": "SELECT match_id, place, player_name, team, overs_bowled, runs_conceded, wickets_taken, economy_rate FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY wickets_taken DESC, economy_rate, player_name, team) AS place FROM fp WHERE balls_bowled > 0) WHERE place <= 5",
    "h19_fall_of_wickets": "SELECT match_id, innings_number AS innings, over_number + 1 AS over_no, delivery_number AS ball, player_out AS dismissed, dismissal_kind AS how, bowler FROM f WHERE is_wicket",
    "h20_latest_matches": "SELECT match_id, match_date, team_a, team_b, venue FROM m ORDER BY match_date DESC, match_id LIMIT 20",
    "h21_matchup_card": f"SELECT CAST(sum(balls_faced) AS BIGINT) AS balls, CAST(sum(runs_scored) AS BIGINT) AS runs, CAST(sum(dismissals) AS BIGINT) AS dismissals, {r('avg(strike_rate)')} AS strike_rate, {r('avg(dot_ball_pct)')} AS dot_pct, CAST(sum(fours) AS BIGINT) AS fours, CAST(sum(sixes) AS BIGINT) AS sixes FROM duel WHERE batter_name = 'P7' AND bowler_name = 'Q7'",
    "h22_nemesis": "SELECT bowler_name, CAST(sum(dismissals) AS BIGINT) AS times_dismissed FROM duel WHERE batter_name = 'P7' GROUP BY 1 HAVING sum(dismissals) > 0 ORDER BY 2 DESC, 1 LIMIT 10",
    "h22_victims": "SELECT batter_name, CAST(sum(dismissals) AS BIGINT) AS times_dismissed FROM duel WHERE bowler_name = 'Q7' GROUP BY 1 HAVING sum(dismissals) > 0 ORDER BY 2 DESC, 1 LIMIT 10",
    "h23_resolver": "SELECT display_name, cricsheet_name FROM shown WHERE contains(lower(display_name), 'star') OR contains(lower(cricsheet_name), 'star')",
    "h24_career_summary": f"SELECT batter, match_type, {CAREER} FROM own GROUP BY 1, 2",
    "h25_year_by_year": f"SELECT batter, year, match_type, {CAREER} FROM own GROUP BY 1, 2, 3",
    "h26_opponents": f"SELECT batter, opponent, match_type, {CAREER} FROM (SELECT o.*, CASE WHEN p.team = m.team_a THEN m.team_b ELSE m.team_a END AS opponent FROM own o JOIN players p ON p.match_id = o.match_id AND p.player_name = o.batter JOIN m ON m.match_id = o.match_id) GROUP BY 1, 2, 3",
    "h27_dismissal_modes": f"SELECT k.player_out, k.match_type, k.dismissal_kind, k.n AS count, top_bowler, {r('k.n * 100.0::DOUBLE / t.n', 1)} AS pct_of_dismissals FROM (SELECT player_out, match_type, dismissal_kind, count(*) AS n FROM f WHERE is_wicket AND player_out IS NOT NULL GROUP BY 1, 2, 3) k JOIN (SELECT player_out, match_type, count(*) AS n FROM f WHERE is_wicket GROUP BY 1, 2) t USING (player_out, match_type) JOIN (SELECT player_out, match_type, dismissal_kind, bowler AS top_bowler, row_number() OVER (PARTITION BY player_out, match_type, dismissal_kind ORDER BY count(*) DESC, bowler) AS i FROM f WHERE is_wicket GROUP BY 1, 2, 3, 4) b ON b.player_out = k.player_out AND b.match_type = k.match_type AND b.dismissal_kind = k.dismissal_kind AND i = 1",
    "h28_innings_context": f"SELECT batter, CASE WHEN innings_number % 2 = 1 THEN 'setting' ELSE 'chasing' END AS setting, CASE WHEN city IN ('City 1', 'City 2', 'City 3') THEN 'home' ELSE 'away' END AS place, {CAREER} FROM own GROUP BY 1, 2, 3",
    "h29_editions": f"SELECT batter, event_name, season, {CAREER} FROM own WHERE event_name LIKE 'Cup%' GROUP BY 1, 2, 3",
    "h30_recent_scorers": "SELECT coalesce(display_name, batter) AS player, CAST(sum(runs_batter) AS BIGINT) AS runs, count(DISTINCT match_id) AS matches FROM f JOIN m USING (match_id) LEFT JOIN shown ON cricsheet_name = batter WHERE m.match_type = 'ODI' AND year(match_date) >= 2000 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "h32_sample": "SELECT substr(match_id, 1, 6) AS match_id, match_date, substr(team_a, 1, 6) AS team_a, substr(team_b, 1, 6) AS team_b, substr(venue, 1, 6) AS venue FROM m ORDER BY m.match_date DESC, m.match_id LIMIT 20",
    "h31_best_economy": f"SELECT * FROM (SELECT player_name, CAST(sum(total_balls) AS BIGINT) AS balls, CAST(sum(total_runs) AS BIGINT) AS runs, CAST(sum(total_wickets) AS BIGINT) AS wickets, {r('sum(total_balls) / 6.0::DOUBLE', 1)} AS overs, {r('sum(total_runs) * 6.0::DOUBLE / nullif(sum(total_balls), 0)')} AS economy FROM bowl GROUP BY 1) WHERE overs >= 5 ORDER BY economy, player_name LIMIT 10",
    "h31_team_formats": f"SELECT match_type, count(*) AS played, count(*) FILTER (winner = 'NATION_6') AS wins, {r('count(*) FILTER (winner = ' + chr(39) + 'NATION_6' + chr(39) + ') * 100.0::DOUBLE / count(*)')} AS win_pct FROM m WHERE team_a = 'NATION_6' OR team_b = 'NATION_6' GROUP BY 1",
    "h31_head_to_head": "SELECT least(team_a, team_b) AS team, greatest(team_a, team_b) AS other, count(*) AS matches, count(*) FILTER (winner = least(team_a, team_b)) AS won, count(*) FILTER (winner = greatest(team_a, team_b)) AS lost FROM m GROUP BY 1, 2",
    "h31_chasing_venues": f"SELECT venue, match_type, chasing_matches, chasing_win_pct FROM ({VENUE % ''}) WHERE chasing_matches >= 2 ORDER BY chasing_win_pct DESC, venue, match_type LIMIT 10",
    "i02_bronze_checks": checks(("MAT-BRZ-002", "bronze", "match_data", "BLOCK", 0, surplus("m", "match_id")), ("MAT-BRZ-004", "bronze", "match_data", "WARN", 1, nulls("m", "match_type", "city", "venue", "season"))),
    "i05_silver_checks": checks(
        ("MAT-SLV-001", "silver", "matches", "BLOCK", 0, nulls("m", "match_id")), ("MAT-SLV-002", "silver", "matches", "BLOCK", 0, surplus("m", "match_id")), ("MAT-SLV-003", "silver", "innings", "BLOCK", 0, surplus("innings", "match_id", "innings_number")),
        ("MAT-SLV-004", "silver", "deliveries", "BLOCK", 0, surplus("deliveries", *BALL)), ("MAT-SLV-012", "silver", "deliveries", "WARN", 1, nulls("deliveries", "batter", "bowler")),
        ("MAT-SLV-006", "silver", "wickets", "WARN", 0, "SELECT count(*) FILTER (fielders IS NULL) AS failed, count(*) AS total FROM wickets WHERE kind IN ('caught', 'run out', 'stumped', 'caught and bowled')"),
        ("MAT-SLV-008", "silver", "wickets", "BLOCK", 0, surplus("wickets", *BALL, "player_out")), ("MAT-SLV-009", "silver", "match_players", "BLOCK", 0, surplus("players", "match_id", "team", "player_name")),
        ("MAT-SLV-010", "silver", "match_officials", "BLOCK", 0, surplus("officials", "match_id", "role", "official_name")), ("MAT-SLV-011", "silver", "match_registry", "BLOCK", 0, surplus("registry", "match_id", "display_name")),
        ("REG-SLV-001", "silver", "persons", "BLOCK", 0, nulls("persons", "person_id")), ("REG-SLV-002", "silver", "persons", "BLOCK", 0, surplus("persons", "person_id")),
        ("REG-SLV-003", "silver", "person_identifiers", "BLOCK", 0, nulls("identifiers", "identifier", "source_system", "source_identifier")), ("REG-SLV-004", "silver", "person_identifiers", "WARN", 0, surplus("identifiers", "identifier", "source_system", "source_identifier")),
    ),
    "i08_unmatched_rate": f"SELECT 'MAT-SLV-005' AS check_id, CASE WHEN total = 0 THEN 'SKIPPED' WHEN failed * 100.0 > 5 * total THEN 'WARNING' ELSE 'PASSED' END AS status, failed, total, {PCT('failed', 'total')} AS pct FROM (SELECT (SELECT count(DISTINCT (match_id, role, display_name)) FROM unmatched) AS failed, (SELECT count(*) FROM players) + (SELECT count(*) FROM officials) AS total)",
    "i10_grain_and_orphans": GRAIN,
    "i16_orphan_names": f"SELECT failed, total, pct, CASE WHEN failed = 0 THEN 'PASSED' WHEN pct > 5 THEN 'FAILED' ELSE 'WARNING' END AS status, sample FROM (SELECT failed, total, {PCT('failed', 'total')} AS pct, sample FROM (SELECT (SELECT count(DISTINCT identifier) FROM variations WHERE identifier NOT IN (SELECT identifier FROM people)) AS failed, (SELECT count(DISTINCT identifier) FROM variations) AS total, (SELECT string_agg(identifier, ',' ORDER BY identifier) FROM (SELECT DISTINCT identifier FROM variations WHERE identifier NOT IN (SELECT identifier FROM people) ORDER BY 1 LIMIT 10)) AS sample))",
    "i21_row_counts": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}" for n, t in (("matches", "m"), ("innings", "innings"), ("deliveries", "deliveries"), ("wickets", "wickets"), ("match_players", "players"), ("persons", "persons"))),
    "i29_business_rules": """SELECT 'two_teams' AS rule, count(*) AS offending FROM m WHERE team_a = team_b UNION ALL SELECT 'winner_is_a_team', count(*) FROM m WHERE winner NOT IN (team_a, team_b)
        UNION ALL SELECT 'innings_total_is_sum_of_balls', count(*) FROM fi JOIN (SELECT match_id, innings_number, sum(runs_batter + runs_extras) AS s FROM f GROUP BY 1, 2) USING (match_id, innings_number) WHERE total_runs <> s
        UNION ALL SELECT 'innings_number_range', count(*) FROM fi WHERE innings_number NOT BETWEEN 1 AND 6 UNION ALL SELECT 'run_rate_range', count(*) FROM fi WHERE run_rate < 0 OR run_rate > 36
        UNION ALL SELECT 'matches_without_innings', count(*) FROM m WHERE match_id NOT IN (SELECT match_id FROM innings)
        UNION ALL SELECT 'wicket_balance', abs((SELECT count(*) FROM wickets) - (SELECT count(*) FROM f WHERE is_wicket) - (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM wickets GROUP BY match_id, innings_number, over_number, delivery_number)))""",
    "i31_freshness": "SELECT match_type, max(match_date) AS latest FROM m GROUP BY 1",
    "i01_failed_files": f"SELECT 'MAT-BRZ-001' AS check_id, CASE WHEN failed = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, failed, attempted AS total FROM ({RUN_LOG})",
    "i03_audit_coherence": f"""SELECT 'MAT-BRZ-003' AS check_id, 'PASSED' AS status, 0 AS failed, attempted - failed AS total, 'own' AS "case" FROM ({RUN_LOG})
        UNION ALL SELECT 'MAT-BRZ-003', 'SKIPPED', NULL, NULL, c FROM (VALUES ('other'), ('none')) v(c)""",
    "i15_rows_arrived": """SELECT 'REG-SLV-005' AS check_id, status, n AS actual, n * f AS expected, "case" FROM (SELECT count(*) AS n FROM people_rows), (VALUES ('all', 'PASSED', 1), ('half', 'FAILED', 2), ('none', 'SKIPPED', NULL)) v("case", status, f)""",
    "i17_missing_table": "SELECT 'missing' AS state, 0 AS n UNION ALL SELECT 'present', count(*) FROM orders",
    "i18_stored_results": f"SELECT x.*, run_id FROM ({GRAIN}) x, (VALUES ('run-1'), ('run-2')) v(run_id)",
    "i19_model_tests": " UNION ALL ".join(model_test(*x) for x in MODEL_TESTS),
    "i20_award_ties": f"SELECT match_id, count(*) AS n_rows FROM ({AWARD}) GROUP BY 1 HAVING count(*) > 1",
    "i22_bronze_types": "SELECT table_name, column_name FROM information_schema.columns WHERE table_name = 'orders' AND data_type <> 'VARCHAR'",
    "i23_one_snapshot": """SELECT 'match_data' AS table_name, 1 AS snapshots, count(*) AS n_rows, count(*) AS with_metadata FROM m UNION ALL SELECT 'people', 1, count(*), count(*) FROM people_rows
        UNION ALL SELECT 'people_identifiers', 1, n, n FROM (SELECT (SELECT count(*) FROM identifiers) + (SELECT count(*) FROM people_rows WHERE name LIKE 'Aaron%' AND k % 3 <> 0) AS n)
        UNION ALL SELECT 'name_variations', 1, count(*), count(*) FROM variations UNION ALL SELECT 'events', count(DISTINCT day), count(*), count(*) FROM e""",
    "i26_dimension_integrity": f"""SELECT what, 0 AS n FROM (VALUES ('dim_match.match_id'), ('dim_player.person_id'), ('dim_team.team_name'), ('dim_venue.venue_name'), ('dim_competition.competition_name'), ('dim_date.date_id'), ('dates_outside_spine')) v(what)
        UNION ALL SELECT * FROM (VALUES ('spine_first', 19700101), ('spine_last', 20351231), ('spine_days', DATE '2035-12-31' - DATE '1970-01-01' + 1)) w(what, n)""",
    "i27_fact_integrity": f"""SELECT what, 0 AS n FROM (VALUES ('orphan_deliveries'), ('orphan_innings'), ('result_rows_missing'), ('award_surplus'), ('award_orphans')) v(what)
        UNION ALL SELECT 'award_rows', count(*) FROM ({AWARD}) UNION ALL SELECT 'award_matches', count(DISTINCT match_id) FROM ({AWARD})
        UNION ALL SELECT 'award_ties', count(*) FROM (SELECT match_id FROM ({AWARD}) GROUP BY 1 HAVING count(*) > 1)""",
    "i07_grain_by_bucket": """SELECT 'before' AS step, count(*) - count(DISTINCT (l_orderkey, l_linenumber, l_partkey)) AS failed, count(*) AS total, false AS partly FROM lineitem
        UNION ALL SELECT 'after', count(*) - count(DISTINCT (l_orderkey, l_linenumber, l_partkey)), count(*), true FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)))""",
    "i28_reconciliation": """SELECT what, n FROM (SELECT count(*) AS n FROM m), (VALUES ('matches.bronze'), ('matches.silver'), ('matches.gold')) v(what)
        UNION ALL SELECT 'people.bronze', count(*) FROM people_rows UNION ALL SELECT 'people.silver', count(*) FROM persons UNION ALL SELECT 'people.gold', count(*) FROM dim_player
        UNION ALL SELECT what, n FROM (SELECT count(*) AS n FROM deliveries), (VALUES ('deliveries.silver'), ('deliveries.gold')) v(what) UNION ALL SELECT what, n FROM (SELECT count(*) AS n FROM innings), (VALUES ('innings.silver'), ('innings.gold')) v(what)""",
    "i30_mart_coverage": f"""SELECT 'batting_players' AS what, count(*) AS n FROM bat WHERE person_id NOT IN (SELECT person_id FROM dim_player) UNION ALL SELECT 'venues', 0
        UNION ALL SELECT 'phase_rows.' || match_type, count(*) FROM (SELECT DISTINCT match_type, season, {PHASE} AS phase FROM f) WHERE phase IS NOT NULL GROUP BY match_type""",
    "i31_last_ingest": "SELECT 'bronze.match_data' AS table_name, TIMESTAMP '2024-01-01 00:00:00' AS last_ingested UNION ALL SELECT 'events', max(ts) FROM events",
    "i33_rerun": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows_before, count(*) AS rows_after FROM {t}" for n, t in SILVER_ROWS),
    "j02_stamp_bronze": "SELECT match_id, CASE WHEN k % 2 = 0 THEN '2' ELSE '1' END AS revision, k % 2 = 0 AS loaded FROM audit",
    "j03_stamp_archive": "SELECT match_id, CASE WHEN k % 3 = 0 THEN 'archive/' || file_name END AS archive_path FROM audit",
    "j08_seed_audit": "SELECT match_id, CASE WHEN k % 3 <> 0 THEN 'listed-' ELSE '' END || match_id || '.json' AS file_name, '1' AS revision, 64 AS hash_length, true AS silver_done, true AS gold_open FROM m",
    "j12_row_guard": "SELECT count(*) AS n_rows FROM lineitem",
    "j15_failures": f"SELECT check_id, table_name, failed FROM ({GRAIN}) WHERE failed > 0",
    "j17_landed_counts": "SELECT event_type AS source_file, arg_max(n, day) AS row_count FROM (SELECT event_type, day, count(*) AS n FROM e WHERE day(day) % 5 <> 0 GROUP BY 1, 2) GROUP BY 1",
    "j18_load_log": """SELECT 'run-' || event_id AS run_id, CASE WHEN event_id % 7 = 0 THEN 'RUNNING' WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN event_id % 7 <> 0 AND event_type <> 'error' THEN event_id % 50 END AS attempted,
        CASE WHEN event_id % 7 <> 0 AND event_type <> 'error' THEN event_id % 50 END AS rows_written, CASE WHEN event_id % 7 <> 0 THEN event_id % 600 END AS duration_seconds, CASE WHEN event_id % 7 <> 0 AND event_type = 'error' THEN 2000 END AS message_length FROM e""",
    "s05_top_tasks": f"SELECT task, runs, {r('s')} AS seconds, {r('s * 100 / whole')} AS pct FROM (SELECT 'task-' || (user_id % 25) AS task, count(*) AS runs, sum(value) AS s FROM e GROUP BY 1), (SELECT sum(value) AS whole FROM e) ORDER BY 3 DESC, 1 LIMIT 10",
    "s05_data_freshness": "SELECT 'task-' || (user_id % 25) AS task, max(day) AS last_success, DATE '2024-02-01' - max(day) AS days_old FROM e WHERE event_type <> 'error' GROUP BY 1",
    "i32_snapshot_histogram": "SELECT day, count(*) AS n_rows, count(DISTINCT user_id) AS n_keys FROM e GROUP BY 1",
    "j01_land_new_files": "SELECT file_name, content_hash FROM audit",
    "j04_pending_silver": "SELECT DISTINCT match_id FROM audit WHERE silver_loaded_at IS NULL",
    "j05_stamp_silver": "SELECT silver_loaded_at IS NULL AND k % 2 <> 0 AS open, count(*) AS n FROM audit GROUP BY 1",
    "j06_pending_gold": "SELECT DISTINCT match_id FROM audit WHERE silver_loaded_at IS NOT NULL AND gold_loaded_at IS NULL",
    "j07_stamp_gold": "SELECT silver_loaded_at IS NULL AS open, count(*) AS n FROM audit GROUP BY 1",
    "j09_column_drift": f"SELECT table_name, snapshot, array_to_string(added, ',') AS added, array_to_string(removed, ',') AS removed, len(added) + len(removed) > 0 AS changed, sha256(array_to_string(list_sort(c), ',')) AS names_hash FROM (SELECT table_name, snapshot, c, CASE WHEN p IS NULL THEN [] ELSE list_sort(list_filter(c, lambda x: NOT list_contains(p, x))) END AS added, CASE WHEN p IS NULL THEN [] ELSE list_sort(list_filter(p, lambda x: NOT list_contains(c, x))) END AS removed FROM (SELECT *, lag(c) OVER (PARTITION BY table_name ORDER BY snapshot) AS p FROM (SELECT table_name, snapshot, list(column_name) AS c FROM ({CATALOG}) GROUP BY 1, 2)))",
    "j10_schema_drift": f"""SELECT table_name, snapshot, CASE WHEN first THEN 'INITIAL' WHEN a > 0 THEN 'ADD' WHEN d > 0 AND t > 0 THEN 'ADD' WHEN d > 0 THEN 'DROP' WHEN t > 0 THEN 'TYPE_CHANGE' ELSE 'NO_CHANGE' END AS change FROM (
        SELECT table_name, snapshot, p IS NULL AS first, len(list_filter(c, lambda x: NOT list_contains(p, x))) AS a, len(list_filter(p, lambda x: NOT list_contains(c, x))) AS d, len(list_filter(ct, lambda x: list_contains(p, split_part(x, ':', 1)) AND NOT list_contains(pt, x))) AS t FROM (
        SELECT *, lag(c) OVER w AS p, lag(ct) OVER w AS pt FROM (SELECT table_name, snapshot, list(column_name) AS c, list(column_name || ':' || column_type) AS ct FROM ({CATALOG}) GROUP BY 1, 2) WINDOW w AS (PARTITION BY table_name ORDER BY snapshot)))""",
    "j10_evolving_append": f"SELECT k, n, tax, part, supplier, flag FROM ({LINES})",
    "j10_evolving_replace": f"SELECT k, n, tax, part, supplier, CASE WHEN third = 0 AND n % 2 = 0 THEN 'again' ELSE flag END AS flag FROM ({LINES})",
    "j11_row_count_log": f"SELECT *, n_rows - before AS delta, {r('(n_rows - before) * 100.0::DOUBLE / before', 4)} AS delta_pct, coalesce(abs({r('(n_rows - before) * 100.0::DOUBLE / before', 4)}) > 5, false) AS anomaly FROM (SELECT event_type, day, n_rows, lag(n_rows) OVER (PARTITION BY event_type ORDER BY day) AS before FROM (SELECT event_type, day, count(*) AS n_rows FROM e GROUP BY 1, 2))",
    "j13_snapshot_diff": "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'new' WHEN c_custkey % 5 = 0 THEN 'removed' ELSE 'changed' END AS change FROM customer WHERE (c_custkey % 7 = 0) <> (c_custkey % 5 = 0) OR (c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 4 = 0 AND round(c_acctbal, 2) <> 0.5)",
    "j14_latest_per_key": "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM e) WHERE n = 1",
    "j16_latest_archives": "SELECT event_type AS archive, max(day) AS loaded_at, count(*) AS n_files FROM e GROUP BY 1",
    "s01_scd2": "SELECT user_id, event_type, event_id AS valid_from, lead(event_id) OVER w AS valid_to, lead(event_id) OVER w IS NULL AS is_current FROM (SELECT * FROM (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM e) WHERE p IS NULL OR p <> event_type) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)",
    "s01_scd2_stored": "SELECT user_id, event_type, event_id AS valid_from, lead(event_id) OVER w AS valid_to, lead(event_id) OVER w IS NULL AS is_current FROM (SELECT * FROM (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM e) WHERE p IS NULL OR p <> event_type) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)",
    "s03_season_year": "SELECT o_orderkey, year(o_orderdate) AS season_year FROM orders",
    "s05_daily_runs": f"SELECT day, count(*) AS runs, count(*) FILTER (event_type = 'error') AS failed, {r('sum(value)')} AS seconds FROM e GROUP BY 1",
    "s07_replacements": f"SELECT match_id, innings_number, over_number, delivery_number, row_number() OVER (PARTITION BY match_id, innings_number, over_number, delivery_number ORDER BY scope DESC) AS replacement_number, scope, team, player_in, player_out, role, reason, DATE '2024-01-01' AS _snapshot_date FROM ({SWAPS})",
    "s07_active_eleven": f"""SELECT match_id, innings_number, over_number, delivery_number, bt AS batting_team, ft AS fielding_team, batter, bowler,
        max(version) FILTER (side = 'bat') AS batting_version, max(version) FILTER (side = 'field') AS fielding_version, max(eleven) FILTER (side = 'bat') AS batting_eleven, max(eleven) FILTER (side = 'field') AS fielding_eleven,
        bool_or(has_batter) FILTER (side = 'bat') AS batter_in_eleven, bool_or(has_bowler) FILTER (side = 'field') AS bowler_in_eleven FROM ({ELEVENS}) GROUP BY ALL""",
    "s08_over_features": f"""SELECT *, {r("runs * 6.0::DOUBLE / nullif(legal_balls, 0)")} AS run_rate FROM (
        SELECT *, CAST(sum(over_runs) OVER w AS BIGINT) AS runs, CAST(sum(over_balls) OVER w AS BIGINT) AS legal_balls, CAST(sum(over_wickets) OVER w AS BIGINT) AS wickets FROM (
            SELECT match_id, innings_number, over_number, CAST(sum(runs_total) AS BIGINT) AS over_runs, count(*) FILTER (is_legal_ball) AS over_balls, count(*) FILTER (is_wicket) AS over_wickets FROM f GROUP BY 1, 2, 3)
        WINDOW w AS (PARTITION BY match_id, innings_number ORDER BY over_number ROWS UNBOUNDED PRECEDING))""",
}


DUELS = ("h09_top_matchups_mart", "h21_matchup_card", "h22_nemesis", "h22_victims")
#: Tables that carry their snapshot.
DATED = {n for n in SQL if n[:3] in {"d04", "d05", "d06", "d07", "d08", "d09", "d10", "d11", "d12", "d13", "d14", "f01", "f08", "f09", "f10", "f11", "f12"}}


def oracle_sql() -> dict[str, str]:
    every = BASE.replace("HAVING count(*) >= 6", "")  # the matchup mart without its minimum
    dated = {n: f"SELECT *, DATE '2024-01-01' AS _snapshot_date FROM ({sql})" if n in DATED else sql for n, sql in SQL.items()}
    return {name: (every if name in DUELS else BASE) + sql for name, sql in dated.items()}
