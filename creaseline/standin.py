"""Match inputs derived from order tables, so that every operator runs on data that grows with its tables.

Each order is a match and each of its lines a ball; nested documents are built from them, and Silver reads only those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SNAPSHOT = "2024-01-01"
#: An older snapshot of the register.
BEFORE = "2023-12-01"
#: Fixed values of the stand-in.
TYPES = ("T20", "ODI", "Test", "IT20", "ODM", "T20B")
KINDS = ("caught", "bowled", "lbw", "run out", "stumped", "caught and bowled", "hit wicket")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], by: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(by, F.lit(len(values))) + 1).cast("int"))


def match_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a match: the fields of its info block."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    key = F.col("o_orderkey")
    home = c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_a"))
    names = lambda suffix: n.select(F.col("n_nationkey").alias(f"nation_{suffix}"), F.col("n_name").alias(f"team_{suffix}"))
    rows = o.join(home, "o_custkey").withColumn("nation_b", ((F.col("nation_a") + 1 + key % 24) % 25).cast("int"))
    rows = rows.join(F.broadcast(names("a")), "nation_a").join(F.broadcast(names("b")), "nation_b")
    kind = pick(TYPES, key)
    decided = F.when(F.col("o_orderstatus") == "F", F.col("team_a")).when(F.col("o_orderstatus") == "O", F.col("team_b"))
    return rows.select(
        key.cast("string").alias("match_id"), F.year("o_orderdate").cast("string").alias("season"), kind.alias("match_type"),
        F.when(key % 3 == 0, "female").otherwise("male").alias("gender"), F.to_date("o_orderdate").alias("match_date"), "team_a", "team_b",
        F.concat(F.lit("Ground "), (F.col("o_custkey") % 37).cast("string")).alias("venue"),
        F.when(key % 13 != 0, F.concat(F.lit("City "), (F.col("o_custkey") % 11).cast("string"))).alias("city"),
        F.lit(6).alias("balls_per_over"), F.when(kind.isin("T20", "IT20", "T20B"), 20).when(kind.isin("ODI", "ODM"), 50).alias("limit_overs"),
        F.when(key % 9 != 0, F.concat(F.lit("Cup "), (F.col("o_custkey") % 7).cast("string"))).alias("event_name"),
        F.when(key % 9 != 0, (key % 50).cast("string")).alias("event_number"),
        F.when(key % 2 == 0, F.col("team_a")).otherwise(F.col("team_b")).alias("toss_winner"),
        F.when(key % 5 < 2, "bat").otherwise("field").alias("toss_decision"), decided.alias("winner"),
        F.when(F.col("o_orderstatus") == "P", F.when(key % 2 == 0, "tie").otherwise("no result")).alias("outcome_result"),
        F.when((F.col("o_orderstatus") == "F") & (key % 17 == 0), "D/L").alias("outcome_method"),
        F.when(F.col("o_orderstatus") == "F", (1 + key % 97).cast("int")).alias("win_by_runs"),
        F.when(F.col("o_orderstatus") == "O", (1 + key % 9).cast("int")).alias("win_by_wickets"),
        F.when(key % 2 == 0, F.array(F.concat(F.lit("P"), (key % 300).cast("string")), F.concat(F.lit("P"), (key % 7).cast("string")))).alias("player_of_match"),
    )


#: Columns that order the balls of an over.
BALL_ORDER = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
#: Balls in a part: about 40 MB of documents.
PART_BALLS = 100_000
EXTRAS = ("wides", "noballs", "byes", "legbyes")


def parts(spark: SparkSession, sf_dir: str) -> int:
    """How many parts matches are dealt over. Texts are many times as large as what is shuffled, so it follows the balls (a count reads no rows), and is not left to sizes seen on the way."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table(spark, sf_dir, "lineitem").count() // PART_BALLS))


def ball_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a ball: `line` sorts by place (innings, over, order in the over) and holds the ball as the document shows it."""
    x = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("match_id"), "l_linenumber", "l_linestatus", "l_returnflag", *BALL_ORDER)
    # the one shuffle of balls, as narrow as they are: every later grouping includes the match
    x = x.repartition(parts(spark, sf_dir), "match_id")
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    name = lambda prefix, e: F.concat(F.lit(prefix), e.cast("string"))
    batter, bowler, non_striker = name("P", part % 300), name("Q", supp % 60), name("P", (part + 1) % 300)
    extra = {e: F.when((F.col("l_returnflag") == "A") & (part % 4 == i), 1) for i, e in enumerate(EXTRAS)}
    more = F.when(F.col("l_returnflag") == "A", 1).otherwise(0)
    hit = F.col("l_quantity").cast("int") % 7
    caught = part % 7 == 0
    fielders = F.when(caught | (part % 7 == 3), F.array(F.struct(name("F", supp % 20).alias("name"), (part % 11 == 0).alias("substitute"))))
    wicket = lambda who, kind: F.struct(who.alias("player_out"), kind.alias("kind"), fielders.alias("fielders"))
    first = wicket(batter, pick(KINDS, part))
    fell = F.when(F.col("l_returnflag") == "R", F.when(caught & (supp % 5 == 0), F.array(wicket(non_striker, F.lit("run out")), first)).otherwise(F.array(first)))
    reason = F.when(part % 2 == 0, "concussion_substitute").otherwise("injury").alias("reason")
    swap = lambda prefix, by, out, *role: F.array(F.struct(name(prefix, supp % by).alias("in"), out.alias("out"), reason, *role))
    eleven = F.when(part % 41 == 0, swap("S", 3, batter)).when(part % 53 == 0, swap("F", 2, bowler))
    role = F.when(part % 37 == 0, swap("Q", 9, bowler, F.lit("bowler").alias("role")))
    ball = F.struct(
        batter.alias("batter"), bowler.alias("bowler"), non_striker.alias("non_striker"), F.struct(hit.alias("batter"), more.alias("extras"), (hit + more).alias("total")).alias("runs"),
        F.struct(*[e.alias(n) for n, e in extra.items()]).alias("extras"), fell.alias("wickets"), F.when(eleven.isNotNull() | role.isNotNull(), F.struct(eleven.alias("match"), role.alias("role"))).alias("replacements"),
    )
    innings = F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("innings_number")
    place = (innings, ((F.col("l_linenumber") * 7 + part) % 50).cast("int").alias("over_number"), *BALL_ORDER)
    # of balls that are equal so far, those without extras come first, and of these those without wickets
    last = F.when(F.col("l_returnflag") == "A", 2).when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("last")
    return x.select("match_id", F.struct(*place, last, batter.alias("batter"), bowler.alias("bowler"), F.to_json(ball).alias("ball")).alias("line"))


def opened(whole: Column) -> Column:
    """A JSON object in text without its closing brace, for more to follow."""
    return F.left(whole, F.length(whole) - 1)


def overs_text(lines: str) -> Column:
    """The sorted lines of an innings as the array of its overs in text; null if there are none. One pass: a line opens an over if the line before is of another."""
    opens = lambda x: F.concat(F.lit('{"over":'), x["over_number"].cast("string"), F.lit(',"deliveries":['))
    before = lambda k: F.col(lines)[k - 1]["over_number"]
    start = lambda x, k: F.when(k == 0, opens(x)).when(before(k) == x["over_number"], F.lit(",")).otherwise(F.concat(F.lit("]},"), opens(x)))
    parts = F.transform(lines, lambda x, k: F.concat(start(x, k), x["ball"]))
    return F.when(F.size(lines) > 0, F.concat(F.lit("["), F.array_join(parts, ""), F.lit("]}]")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows: one nested match document (text) for each order, revision 1. Balls become text one by one, are grouped once, and the document is put
    together out of texts: grouping and sorting nested balls costs several times as much.
    """
    played = ball_rows(spark, sf_dir).groupBy("match_id").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    nobody = F.array().cast("array<string>")
    own = lambda i: F.filter("lines", lambda x: x["innings_number"] == i).alias(f"lines_{i}")
    squad = lambda bats, bowls: F.sort_array(F.array_distinct(F.concat(F.col(f"lines_{bats}.batter"), F.col(f"lines_{bowls}.bowler"))))
    played = played.select("match_id", own(1), own(2)).select("match_id", overs_text("lines_1").alias("overs_1"), overs_text("lines_2").alias("overs_2"), squad(1, 2).alias("squad_a"), squad(2, 1).alias("squad_b"))
    m = match_rows(spark, sf_dir).join(played, "match_id", "left").withColumns({f"squad_{x}": F.coalesce(f"squad_{x}", nobody) for x in "ab"})
    registered = F.filter(F.array_union("squad_a", "squad_b"), lambda n: F.substring(n, 2, 9).cast("int") % 4 != 0)
    m = m.withColumn("registered", registered)
    key = F.col("match_id").cast("long")
    windows = F.when(F.col("limit_overs").isNotNull(), F.array(F.struct(F.lit(0.1).alias("from"), F.when(F.col("limit_overs") == 20, 5.6).otherwise(9.6).alias("to"), F.lit("mandatory").alias("type"))))

    def innings(i: int, team: str) -> Column:
        rest = F.to_json(F.struct(
            F.when(key % 19 == 0, True).alias("declared"), F.when(F.lit(i == 2), F.struct((100 + key % 200).cast("int").alias("runs"), F.col("limit_overs").cast("double").alias("overs"))).alias("target"), windows.alias("powerplays"),
        ))
        overs = F.coalesce(F.concat(F.lit(',"overs":'), F.col(f"overs_{i}")), F.lit(""))
        return F.concat(opened(F.to_json(F.struct(F.col(team).alias("team")))), overs, F.when(rest == "{}", "}").otherwise(F.concat(F.lit(","), F.substr(rest, F.lit(2)))))

    people = F.map_from_arrays("registered", F.transform("registered", lambda n: F.concat(F.lit("r-"), n)))
    umpire = lambda prefix, by: F.array(F.concat(F.lit(prefix), (key % by).cast("string")))
    info = F.struct(
        "balls_per_over", "city", F.array(F.col("match_date").cast("string")).alias("dates"), F.when(F.col("event_name").isNotNull(), F.struct(F.col("event_name").alias("name"), F.col("event_number").alias("match_number"), F.when(key % 4 == 1, pick(("A", "B", "C"), key)).alias("group"))).alias("event"),
        "gender", "match_type", F.when(key % 23 == 0, F.array(F.lit("umpires"))).alias("missing"), F.struct(umpire("U", 23).alias("umpires"), umpire("U", 29).alias("tv_umpires"), umpire("R", 5).alias("match_referees")).alias("officials"),
        F.struct(F.struct(F.col("win_by_runs").alias("runs"), F.col("win_by_wickets").alias("wickets")).alias("by"), "winner", F.col("outcome_result").alias("result"), F.col("outcome_method").alias("method")).alias("outcome"),
        F.col("limit_overs").alias("overs"), "player_of_match", F.map_from_arrays(F.array("team_a", "team_b"), F.array("squad_a", "squad_b")).alias("players"),
        F.struct(people.alias("people")).alias("registry"), "season", F.array("team_a", "team_b").alias("teams"), F.when(key % 4 == 0, "club").otherwise("international").alias("team_type"),
        F.struct(F.col("toss_decision").alias("decision"), F.col("toss_winner").alias("winner")).alias("toss"), "venue",
    )
    head = F.to_json(F.struct(F.struct(F.lit("1.1.0").alias("data_version"), F.lit(1).alias("revision")).alias("meta"), info.alias("info")))
    doc = F.concat(opened(head), F.lit(',"innings":['), innings(1, "team_a"), F.lit(","), innings(2, "team_b"), F.lit("]}"))
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return m.select("match_id", F.lit("1").alias("revision"), *[blank(c) for c in ("match_type", "gender", "season", "match_date", "team_a", "team_b", "venue", "city")], doc.alias("raw_json"), F.lit(SNAPSHOT).cast("date").alias("_snapshot_date"), F.lit(f"{SNAPSHOT} 00:00:00").cast("timestamp").alias("_ingested_at"))


def people_csv(spark: SparkSession, sf_dir: str, day: str = SNAPSHOT) -> DataFrame:
    """The register's people file of a day: wide, all strings, with key_* columns. Some ids repeat with other names; the older file has ids that are gone."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    text = lambda prefix, e=key: F.concat(F.lit(prefix), e.cast("string"))
    none = F.lit(None).cast("string")
    crick = F.when(key % 3 != 0, F.concat(F.lit("r-"), text("P")))

    def rows(where: Column, identifier: Column, name: Column, unique_name: Column, cricsheet: Column = none, cricinfo: Column = none, cricbuzz: Column = none) -> DataFrame:
        return c.where(where).select(identifier.alias("identifier"), name.alias("name"), unique_name.alias("unique_name"), cricsheet.alias("key_cricsheet"), cricinfo.alias("key_cricinfo"), cricbuzz.alias("key_cricbuzz"))

    if day == BEFORE:
        return rows(key % 4 == 0, text("id"), text("Old "), text("old-")).unionByName(rows(key % 20 == 0, text("gone"), text("Gone "), text("gone-")))
    all_rows = rows(F.lit(True), text("id"), F.when(key % 10 != 0, text("Person ")), text("person-"), crick, F.when(key % 2 == 0, (key * 7).cast("string")), F.when(key % 5 == 0, (key * 3).cast("string")))
    return all_rows.unionByName(rows(key % 50 == 7, text("id"), text("Aaron "), text("zed-"), crick))


def names_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    key, supp = F.col("c_custkey"), F.col("s_suppkey")
    text = lambda prefix, e: F.concat(F.lit(prefix), e.cast("string"))
    a = c.select(text("id", key).alias("identifier"), text("P", key % 290).alias("name"))
    b = s.select(text("sup", supp).alias("identifier"), text("Q", supp % 50).alias("name"))
    return a.unionByName(b).unionByName(b.where("identifier like '%1'"))


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every even player number that the parts yield has an alias."""
    number = (F.col("p_partkey") * 2 % 300).cast("string")
    return table(spark, sf_dir, "part").select(F.concat(F.lit("P"), number).alias("cricsheet_name"), F.concat(F.lit("Star "), number).alias("display_name")).distinct()
