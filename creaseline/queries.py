"""Every registered query of the library: the operators on tables derived from the given ones (standin)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline import standin as S
from creaseline.functions import metrics as M
from creaseline.operators import bronze, control, grain, identity, lineup, quality, register, silver
from creaseline.plans import build, gold, history, marts, reports
from creaseline.plans.landing import Landing
from creaseline.schema import BALLS_DDL, INFO_DDL, LINEUP_DDL
from creaseline.sinks import content_index, evolving, tables
from creaseline.sources import files
from creaseline.streaming.landing import ingest_available

Query = Callable[[SparkSession, str], DataFrame]
HOME = ("City 1", "City 2", "City 3")
PLAYER, BOWLER = "P7", "Q7"
SHOWN = "Star 8"


#: What every Silver table is made of: documents without balls, and balls; and what elevens at each ball are made of; with the shape of document that each reads. The queries named in
#: STORED read them several times; for them whole documents are parsed and written as Parquet once, in buckets by match, and the parts
#: read their columns of it, without a shuffle where they are joined or grouped by match. Others parse what they read in one pass and keep nothing.
SPLIT = {"info": (silver.parse_info, INFO_DDL), "balls": (silver.parse_balls, BALLS_DDL), "lineup": (silver.parse_lineup, LINEUP_DDL)}


class Lake(dict):
    """Tables of a folder by name, each built when first asked for. Nothing is computed before an action, unless `stored`
    is set: then the documents are parsed and written by the first query that asks for them, and later ones read the files.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir, self.stored, self.facts, self.place, self.kept, self.parts = spark, sf_dir, False, False, None, [], 0
        # tables of matches are dealt out by match_id alone: joins by match_id and more keys leave them where they are
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")

    @staticmethod
    def of(spark: SparkSession, sf_dir: str) -> Lake:
        found = _lakes.get(spark)
        if found is None or found.sf_dir != sf_dir:
            if found is not None:
                found.forget()
            found = _lakes[spark] = Lake(spark, sf_dir)
        return found

    def forget(self) -> None:
        """Tables are built anew when asked for."""
        self.stored = self.facts = False
        self.clear()
        for name in self.kept:
            self.spark.sql(f"drop table if exists {name}")
        self.kept.clear()

    def store(self, facts: bool = False) -> None:
        """From now on, documents are parsed into files once; with facts, so is fact_delivery put together."""
        if not self.stored:
            self.clear()
            self.stored, self.parts = True, S.parts(self.spark, self.sf_dir)
        if facts and not self.facts:
            for name in [n for n in self if n.startswith(("fact_", "mart_")) or n == "duels"]:
                del self[name]
            self.facts = True

    def __missing__(self, name: str) -> DataFrame:
        self[name] = df = self.build(name)
        return df

    def split(self, name: str) -> DataFrame:
        parse, shape = SPLIT[name]
        if not self.stored:
            return parse(self["bronze"])
        columns = ", ".join(f"`{c}` {shape if c == 'doc' else kind}" for c, kind in self["parsed"].dtypes)
        part = self.keep(build.bucketed_part(self.spark, columns, self.place, "match_id", self.parts))
        return silver.balls(part) if name == "balls" else part

    def keep(self, table: str) -> DataFrame:
        self.kept.append(table)
        return self.spark.table(table)

    def by_match(self, df: DataFrame) -> DataFrame:
        """df, written in buckets by match."""
        return self.keep(build.bucketed(df, self.scratch(), "match_id", self.parts))

    def landed(self) -> DataFrame:
        """Bronze as files in buckets by match, as a load leaves it: runs that read it several times put its documents together once."""
        self.parts = self.parts or S.parts(self.spark, self.sf_dir)
        return self.by_match(self["bronze"])

    def known(self) -> tuple[DataFrame, DataFrame]:
        """Identifiers and names for identity.resolve. Stored, they are those that matches mention, as files: rows of matches keep their
        buckets if these are small enough to be sent to them, which Spark tells by their size.
        """
        return (self["known_identifiers"], self["known_names"]) if self.stored else (self["person_identifiers"], self["name_variations"])

    def scratch(self) -> str:
        """A new folder that driver and executors share."""
        spark = self.spark
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        return f"{shared.rstrip('/')}/creaseline/{uuid.uuid4().hex}"

    def build(self, name: str) -> DataFrame:
        spark, d = self.spark, self.sf_dir
        if name == "bronze":
            return S.documents(spark, d)
        if name == "parsed":
            df = silver.parse(self["bronze"])
            if not self.stored:
                return df
            self.place = self.scratch()
            return self.keep(build.bucketed(df, self.place, "match_id", self.parts))
        if name in SPLIT:
            return self.split(name)
        if name in build.BY_BALL:
            return getattr(silver, name)(self["balls"])
        if name in ("matches", "innings", "powerplays", "registry", "teams", "venues", "competitions"):
            return getattr(silver, name)(self["info"])
        if name == "people":
            return S.people_csv(spark, d)
        if name == "persons":
            return tables.union([register.silver_persons(register.people(S.people_csv(spark, d, day))).withColumn("_snapshot_date", F.lit(day).cast("date")) for day in (S.BEFORE, S.SNAPSHOT)])
        if name == "person_identifiers":
            return register.silver_identifiers(register.identifiers(self["people"]))
        if name == "name_variations":
            return register.name_variations(S.names_csv(spark, d))
        if name == "known_identifiers":
            return build.once(identity.mentioned(self["person_identifiers"], self["registry"]), self.scratch())
        if name == "known_names":
            return build.once(identity.named(self["name_variations"]), self.scratch())
        if name == "resolved_players":
            df = identity.resolve(silver.players(self["info"]), "player_name", self["registry"], *self.known())
            return self.by_match(df) if self.stored else df
        if name == "resolved_officials":
            return identity.resolve(silver.officials(self["info"]), "official_name", self["registry"], *self.known())
        if name == "match_players":
            return self["resolved_players"].drop("cricsheet_id")
        if name == "match_officials":
            return self["resolved_officials"].drop("cricsheet_id")
        if name == "aliases":
            return S.aliases(spark, d)
        if name == "fact_delivery" and self.facts:
            return self.by_match(gold.fact_delivery(self))
        if name in ("fact_delivery", "fact_innings", "fact_player_match", "player_display_names"):
            return getattr(gold, name)(self)
        if name == "duels":  # the matchup mart without its minimum
            return marts.matchup_analysis(self, least=1)
        if name.startswith("dim_"):
            return gold.dim_date(spark) if name == "dim_date" else getattr(gold, name)(self)
        if name in ("fact_match_result", "fact_player_of_match"):
            return getattr(gold, name)(self)
        if name.startswith("mart_"):
            short = {"mart_matchup": marts.matchup_analysis, "mart_venue_dna_fixed": lambda t: marts.venue_dna(t, fix=True)}
            return (short.get(name) or getattr(marts, name.removeprefix("mart_")))(self)
        if name == "audit":
            return audit_log(self)
        raise KeyError(name)


_lakes: WeakKeyDictionary[SparkSession, Lake] = WeakKeyDictionary()


def plain(df: DataFrame) -> DataFrame:
    """Without the load time; long counts."""
    out = df.drop("_ingested_at")
    return out.select(*[F.col(c).cast("long").alias(c) if kind == "int" else F.col(c) for c, kind in out.dtypes])


def audit_log(t: Lake) -> DataFrame:
    """The file audit as the orders' states suggest it: all in Bronze, open ones not in Silver, some not in Gold."""
    o = S.table(t.spark, t.sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    return o.select(
        F.concat(key.cast("string"), F.lit(".json")).alias("file_name"), F.sha2(F.concat_ws("|", key.cast("string"), "o_orderstatus"), 256).alias("content_hash"), key.cast("string").alias("match_id"), F.lit("1").alias("revision"),
        day.alias("bronze_loaded_at"), F.when(F.col("o_orderstatus") != "O", day).alias("silver_loaded_at"), F.when((F.col("o_orderstatus") != "O") & (key % 3 == 0), day).alias("gold_loaded_at"),
    )


def lake(f: Callable[[Lake], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(f(Lake.of(spark, sf_dir)))


def of(name: str) -> Query:
    return lake(lambda t: t[name])


# -- sources ------------------------------------------------------------------------------------


def events_as(t: Lake) -> DataFrame:
    """Events as dated rows: the snapshot is the day."""
    e = S.table(t.spark, t.sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "value", "props", "ts", F.to_date("ts").alias("day"))


def landing(t: Lake) -> str:
    """A folder with one file for each month of orders."""
    o, folder = S.table(t.spark, t.sf_dir, "orders"), t.scratch()
    line = F.concat_ws(":", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")
    rows = o.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", line.alias("line")).repartition("month").sortWithinPartitions("month", "o_orderkey")
    rows.select("month", "line").write.partitionBy("month").text(folder)
    return folder


def a01_stream_restart(t: Lake) -> DataFrame:
    """A document for each month of orders: odd months land and are streamed in, then all do, under a checkpoint that knows nothing of the first run."""
    folder, out = t.scratch(), t.scratch()
    month, key = F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.month("o_orderdate") % 2
    o = S.table(t.spark, t.sf_dir, "orders").groupBy(month, key.alias("odd")).agg(F.count(F.lit(1)).cast("string").alias("n"))
    text = o.select("month", "odd", F.to_json(F.struct(F.struct(F.col("n").alias("season"), F.lit("T20").alias("match_type"), F.col("month").alias("venue")).alias("info"))).alias("line"))
    for odd, checkpoint in ((1, "first"), (0, "second")):
        text.where(F.col("odd") == odd).select("month", "line").repartition("month").write.mode("append").partitionBy("month").text(folder)
        ingest_available(t.spark, folder, f"{out}/bronze", f"{out}/rejects", f"{out}/{checkpoint}", glob="*.txt", name=MONTHS["name"])
    return t.spark.read.parquet(f"{out}/bronze").select("match_id", "revision", "season")


MONTHS = {"glob": "*.txt", "name": r"month=([^/]+)/"}


def csv_of(t: Lake, df: DataFrame) -> str:
    path = t.scratch()
    tables.to_csv(df, path)
    return path


def a11_readiness(t: Lake) -> DataFrame:
    e = events_as(t)
    files.ready(e, "2024-01-10", "day")
    return files.as_of(e, "2024-01-10", "day").agg(F.count(F.lit(1)).alias("n"), F.max("day").alias("newest"))


def a13_schema_listing(t: Lake) -> DataFrame:
    path = t.scratch()
    own = {n: S.table(t.spark, t.sf_dir, n) for n in ("customer", "documents", "lineitem", "orders")}
    control.append_catalog(t.spark, path, own, 1)
    control.append_catalog(t.spark, path, own, 1)  # again: nothing changes
    return t.spark.read.parquet(path)


def a16_staging_views(t: Lake) -> DataFrame:
    views = files.staging_views({n: t[n] for n in ("matches", "innings", "deliveries", "wickets", "registry", "teams", "venues", "competitions", "persons", "person_identifiers", "name_variations", "match_players")})
    return tables.union([t.spark.sql(f"select '{v}' as view_name, count(*) as n from {v}") for v in views])


def a19_ball_csv(t: Lake) -> DataFrame:
    balls = t["deliveries"].select("match_id", "innings_number", "over_number", "delivery_number", "batter", "bowler", "runs_total")
    return files.ball_csv(t.spark, csv_of(t, balls))


def a17_info_pivot(t: Lake) -> DataFrame:
    o = S.table(t.spark, t.sf_dir, "orders")
    m = F.col("o_orderkey").cast("string").alias("match_id")
    part = lambda line, key, value: o.select(m, F.lit(line).alias("line"), F.lit(key).alias("key"), value.cast("string").alias("value"))
    rows = tables.union([part(1, "team", F.col("o_custkey")), part(2, "team", F.col("o_custkey") + 1), part(3, "winner_runs", F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 97)), part(4, "winner_wickets", F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") % 10)), part(5, "outcome", F.when(F.col("o_orderstatus") == "P", F.when(F.col("o_orderkey") % 2 == 0, F.lit("tie")).otherwise("no result")))])
    wide = files.info_wide(rows, ["team", "team_1", "winner_runs", "winner_wickets", "outcome"])
    return files.info_clean(wide)


SOURCES: dict[str, Query] = {
    "a01_landing_scan": lake(lambda t: files.landing_json(t.spark, landing(t), **MONTHS).select("file_name", "content_hash", "size")),
    "a01_stream_restart": lake(a01_stream_restart),
    "a02_header_projection": lake(lambda t: bronze.header(t["bronze"].select("match_id", "raw_json")).drop("raw_json")),
    "a03_register_csv": lake(lambda t: register.people(files.register_csv(t.spark, csv_of(t, t["people"])))),
    "a04_filtered_projection": lake(lambda t: files.read(S.table(t.spark, t.sf_dir, "lineitem"), ["l_orderkey", "l_quantity"], "l_returnflag = 'R' and l_quantity > 45")),
    "a05_watermark_read": lake(lambda t: files.since(events_as(t), "day", "2024-01-15").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))),
    "a06_between_versions": lake(lambda t: files.between_versions(events_as(t), "2024-01-05", "2024-01-10", "day").groupBy("day").agg(F.count(F.lit(1)).alias("n"))),
    "a07_as_of_read": lake(lambda t: files.as_of(events_as(t), "2024-01-10", "day").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))),
    "a08_latest_snapshot": lake(lambda t: files.latest_snapshot(events_as(t), "day").select("event_id", "event_type")),
    "a09_exact_snapshot": lake(lambda t: files.exact_snapshot(events_as(t), "2024-01-07", "day").select("event_id", "event_type")),
    "a10_key_scoped_read": lake(lambda t: files.for_keys(t["deliveries"], control.pending_silver(t["audit"])).groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))),
    "a11_readiness": lake(a11_readiness),
    "a12_sql_entry": lake(lambda t: files.sql(t.spark, {"m_view": t["matches"]}, "select match_type, count(*) as n from m_view where winner is not null group by match_type")),
    "a13_schema_listing": lake(a13_schema_listing),
    "a14_alias_seed": lake(lambda t: files.seed_csv(t.spark, csv_of(t, t["aliases"]), "cricsheet_name")),
    "a15_inventory": lake(lambda t: files.inventory(t.spark, landing(t), **MONTHS)),
    "a16_staging_views": lake(a16_staging_views),
    "a17_info_pivot_and_clean": lake(a17_info_pivot),
    "a19_ball_csv": lake(a19_ball_csv),
}

# -- write modes, as the frames that they write ---------------------------------------------------


def old_new(t: Lake) -> tuple[DataFrame, DataFrame]:
    """Customers before and after: every seventh is new, every third of the others changes."""
    c = S.table(t.spark, t.sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    old = c.where("c_custkey % 7 <> 0")
    return old, c.where("c_custkey % 3 = 0 or c_custkey % 7 = 0").withColumns({"c_acctbal": F.round(F.col("c_acctbal") + 1, 2), "c_mktsegment": F.lit("NEW")})


def b01_append(t: Lake) -> DataFrame:
    path = t.scratch()
    for part in old_new(t):
        tables.append(part, path)
    return t.spark.read.parquet(path)


def b02_create_if_missing(t: Lake) -> DataFrame:
    path = t.scratch()
    for part in old_new(t):
        tables.create_if_missing(part, path, ["c_mktsegment"], compression="zstd")
    return t.spark.read.parquet(path)


def days_table(t: Lake, path: str) -> DataFrame:
    e = events_as(t).select("event_id", "event_type", "day")
    tables.full_refresh(e.withColumn("version", F.lit(1)), path, ["day"])
    return e


def b03_partition_overwrite(t: Lake) -> DataFrame:
    path = t.scratch()
    e = days_table(t, path)
    tables.overwrite_partitions(e.where("day >= date '2024-01-20' and event_id % 2 = 0").withColumn("version", F.lit(2)), path, ["day"])
    return t.spark.read.parquet(path)


def keyed_customers(t: Lake) -> tuple[str, DataFrame]:
    path, (old, new) = t.scratch(), old_new(t)
    tables.create_keyed(old, path, ["c_custkey"], 8)
    return path, new


def b04_keyed_replace(t: Lake) -> DataFrame:
    """Keys that were processed (every fifth) and have no new row go."""
    path, new = keyed_customers(t)
    done = S.table(t.spark, t.sf_dir, "customer").where("c_custkey % 5 = 0").select("c_custkey")
    tables.keyed_replace(new, path, ["c_custkey"], done)
    return tables.read_keyed(t.spark, path)


def b05_upsert_table(t: Lake) -> DataFrame:
    path, new = keyed_customers(t)
    tables.upsert(new, path, ["c_custkey"])
    return tables.read_keyed(t.spark, path)


def b06_delete_snapshot(t: Lake) -> DataFrame:
    path = t.scratch()
    days_table(t, path)
    tables.delete_snapshot(t.spark, path, "2024-01-10", "day")
    return t.spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


def b07_purge(t: Lake) -> DataFrame:
    folder, out = t.scratch(), t.scratch()
    for name in ("first", "second"):
        days_table(t, f"{folder}/{name}")
    tables.purge_before(t.spark, folder, ["first", "second"], "2024-01-20", out, "day")
    return tables.union([t.spark.read.parquet(f"{out}/{n}").groupBy(F.lit(n).alias("table_name"), "day").agg(F.count(F.lit(1)).alias("n")) for n in ("first", "second")])


def b09_layout(t: Lake) -> DataFrame:
    path = t.scratch()
    li = S.table(t.spark, t.sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.year("l_shipdate").alias("year"))
    tables.full_refresh(tables.laid_out(li, ["year"], ["l_orderkey", "l_linenumber"]), path, ["year"])
    return t.spark.read.parquet(path)


def b09_range_layout(t: Lake) -> DataFrame:
    """Files of about a fortieth of all lines, by year: whether a year has several, and whether their key ranges follow each other."""
    path, li = t.scratch(), S.table(t.spark, t.sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    yearly = tables.Layout((("year", "year", "l_shipdate", None),), ("l_orderkey", "l_linenumber"))
    tables.write_laid_out(li, path, yearly, max(1, li.count() // 40))
    key = F.struct("l_orderkey", "l_linenumber")
    each = t.spark.read.parquet(path).groupBy("year", F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
    follows = F.coalesce(F.col("low") > F.lag("high").over(W.partitionBy("year").orderBy("low")), F.lit(True))
    return each.withColumn("follows", follows).groupBy("year").agg(F.sum("n").alias("n_rows"), (F.count(F.lit(1)) > 1).alias("split"), F.bool_and("follows").alias("in_order"))


def b05_growing_table(t: Lake) -> DataFrame:
    """Customers come in batches of growing size, each with some that are known; buckets are added on the way. Rows, and whether there are as many buckets as they ask for."""
    path, c = t.scratch(), S.table(t.spark, t.sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    n, key = c.count(), F.col("c_custkey")
    size = max(1, n // 64)
    tables.create_keyed(c.where(key <= size), path, ["c_custkey"], 1, bucket_rows=size)
    for part in (2, 8, 64):
        batch = c.where((key > (size * (part // 8) if part > 2 else -1)) & ((key <= size * part) | F.lit(part == 64)))
        tables.upsert(batch.withColumn("c_acctbal", F.round(F.col("c_acctbal") + part, 2)), path, ["c_custkey"], bucket_rows=size)
    enough = tables.layout(t.spark, path) >= n // size
    return tables.read_keyed(t.spark, path).withColumn("enough_buckets", F.lit(enough))


def b10_export(t: Lake) -> DataFrame:
    n = tables.export({name: t[name] for name in ("dim_match", "dim_team", "fact_innings", "mart_toss_outcome")}, t.scratch())
    return t.spark.createDataFrame(list(n.items()), "table_name string, n_rows long")


def b11_report_csv(t: Lake) -> DataFrame:
    return t.spark.read.csv(csv_of(t, reports.format_breakdown(t)), header=True)


def b13_full_refresh(t: Lake) -> DataFrame:
    path, (old, new) = t.scratch(), old_new(t)
    tables.full_refresh(old, path)
    tables.full_refresh(new, path)
    return t.spark.read.parquet(path)


def b12_incremental_gold(t: Lake) -> DataFrame:
    """Gold for the matches that the audit leaves open, then, all others open too, for the rest: all of Gold."""
    folder = t.scratch()
    for audit in (t["audit"], t["audit"].withColumn("gold_loaded_at", F.when(F.col("gold_loaded_at").isNull(), F.col("bronze_loaded_at")))):
        build.build_gold(t, audit, folder)
    return quality.row_counts({n: tables.read_keyed(t.spark, f"{folder}/{n}") for n in gold.INCREMENTAL})


SINKS: dict[str, Query] = {
    "b01_append": lake(b01_append),
    "b02_create_if_missing": lake(b02_create_if_missing),
    "b03_partition_overwrite": lake(b03_partition_overwrite),
    "b04_keyed_replace": lake(b04_keyed_replace),
    "b05_upsert": lake(lambda t: tables.merged(*old_new(t), ["c_custkey"])),
    "b05_upsert_subset": lake(lambda t: tables.merged(*old_new(t), ["c_custkey"], ["c_acctbal"])),
    "b05_upsert_table": lake(b05_upsert_table),
    "b06_delete_snapshot": lake(b06_delete_snapshot),
    "b07_purge": lake(b07_purge),
    "b08_metadata_columns": lake(lambda t: bronze.with_metadata(S.table(t.spark, t.sf_dir, "nation"), _pipeline_run_id="run-1", n_name="never").select("n_nationkey", "n_name", "_pipeline_run_id")),
    "b09_layout": lake(b09_layout),
    "b09_range_layout": lake(b09_range_layout),
    "b05_growing_table": lake(b05_growing_table),
    "b10_export": lake(b10_export),
    "b11_report_csv": lake(b11_report_csv),
    "b12_incremental_scope": lake(lambda t: gold.pending(t["fact_delivery"], t["audit"]).groupBy("match_id").agg(F.count(F.lit(1)).alias("balls"))),
    "b12_incremental_gold": lake(b12_incremental_gold),
    "b13_full_refresh": lake(b13_full_refresh),
}

# -- Bronze and register ----------------------------------------------------------------------------


def revised(t: Lake) -> DataFrame:
    """Revisions of documents: events are versions of (user, type)."""
    e = events_as(t)
    return e.select(F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("match_id"), (F.col("event_id") % 9).cast("string").alias("revision"), F.col("ts").alias("_ingested_at"), "event_id", "props")


def landed_new(t: Lake) -> DataFrame:
    d = S.table(t.spark, t.sf_dir, "documents")
    known = d.where("doc_id % 3 = 0").select(F.sha2("text", 256).alias("content_hash"))
    return bronze.new_content(d.select("doc_id", F.sha2("text", 256).alias("content_hash")), known)


def c01_indexed_skip(t: Lake) -> DataFrame:
    """Documents in three loads of growing size, each looked up in the index of what came before."""
    d, folder = S.table(t.spark, t.sf_dir, "documents"), t.scratch()
    rows = d.select("doc_id", F.col("doc_id").cast("string").alias("match_id"), F.lit("1").alias("revision"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"))
    parts = [rows.where(F.col("doc_id") % 8 == 0), rows.where(F.col("doc_id") % 8 == 1), rows.where(F.col("doc_id") % 8 > 1)]
    content_index.create(rows.limit(0), folder)
    found = []
    for number, part in enumerate(parts):
        fresh = content_index.unknown(part, folder).select("doc_id", "content_hash", F.lit(number).alias("load"), "match_id", "revision")
        place = t.scratch()
        fresh.write.parquet(place)
        found.append(t.spark.read.parquet(place))
        content_index.remember(found[-1], folder)
    return tables.union(found).select("doc_id", "content_hash", "load")


def c11_indexed_loads(t: Lake) -> DataFrame:
    """Two loads of match files, of which the second brings all files again and corrected texts for every fifth match: (match_id, revision) in Bronze and rejects."""
    key, place = F.col("match_id").cast("long"), Landing(t.spark, t.scratch())
    files_of = lambda text, df: df.select(F.concat("match_id", F.lit(".json")).alias("file_name"), "match_id", text.alias("raw_json"), F.sha2(text, 256).alias("content_hash"))
    text = F.when(key % 10 == 3, F.concat(F.lit("not json "), "match_id")).otherwise(F.to_json(F.struct(F.struct(F.col("match_id").alias("season")).alias("info"))))
    fixed = F.to_json(F.struct(F.struct(F.col("match_id").alias("season"), F.lit("new").alias("venue")).alias("info")))
    ids = t["bronze"].select("match_id")
    place.load(files_of(text, ids), "first", S.BEFORE)
    place.load(files_of(text, ids).unionByName(files_of(fixed, ids.where(key % 5 == 0))), "second", S.SNAPSHOT)
    return place.bronze().select("match_id", "revision", "venue", "_snapshot_date").unionByName(t.spark.read.parquet(place.rejects_path).select("match_id", F.lit("rejected").alias("revision"), "venue", F.lit(None).cast("date").alias("_snapshot_date")))


def assigned(t: Lake) -> DataFrame:
    e = events_as(t)
    old = revised(t).where("event_id % 2 = 0")
    key = F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("match_id")
    new = e.where("event_id % 2 = 1").select(key, F.lpad(F.col("event_id").cast("string"), 12, "0").alias("file_name"))
    return bronze.assign_revisions(new, old)


def c04_idempotency(t: Lake) -> DataFrame:
    """Whether three snapshots' loads would be left out, with and without force; the event log stands for the load log."""
    log = events_as(t).select(F.col("day").cast("string").alias("snapshot_date"), F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"))
    rows = [(day, bronze.already_loaded(log, day), bronze.already_loaded(log, day, force=True)) for day in ("2024-01-05", "2024-01-06", "2031-01-01")]
    return t.spark.createDataFrame(rows, "snapshot_date string, loaded boolean, loaded_with_force boolean")


def c10_register_load(t: Lake) -> DataFrame:
    """Two snapshots, the newer one twice: a load replaces its own snapshot only."""
    folder, names = t.scratch(), S.names_csv(t.spark, t.sf_dir)
    for day in (S.BEFORE, S.SNAPSHOT, S.SNAPSHOT):
        register.load_register(register.parse_register(S.people_csv(t.spark, t.sf_dir, day), names), folder, day)
    return tables.union([t.spark.read.parquet(f"{folder}/{n}").groupBy(F.lit(n).alias("table_name"), "_snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_row_hash").alias("n_hashes")) for n in ("people", "people_identifiers", "name_variations")])


def c11_bronze_load(t: Lake) -> DataFrame:
    """A load of files, a fourth of which Bronze has and a tenth of which are no documents."""
    key = F.col("match_id").cast("long")
    landed = t["bronze"].select(F.concat("match_id", F.lit(".json")).alias("file_name"), "match_id", F.when(key % 10 == 0, "not json").otherwise(F.col("raw_json")).alias("raw_json"), F.sha2("match_id", 256).alias("content_hash"))
    known = t["bronze"].where(key % 4 == 0).select(F.sha2("match_id", 256).alias("content_hash"))
    counts = bronze.ingest(landed, known, t["bronze"].select("match_id", "revision"), t.scratch(), S.SNAPSHOT, "run")
    return t.spark.createDataFrame([counts], "attempted long, skipped long, succeeded long, failed long, rows_written long")


def d19_silver_build(t: Lake) -> DataFrame:
    """Silver in two runs, even matches and then the others; an empty scope writes nothing."""
    folder, bronze = t.scratch(), t.landed()
    ids, key = bronze.select("match_id"), F.col("match_id").cast("long")
    for scope in (ids.where(key % 2 == 0), ids.where("false"), ids.where(key % 2 == 1)):
        build.build_silver(bronze, t["person_identifiers"], t["name_variations"], folder, scope, t.parts)
    return quality.row_counts(build.silver_tables(t.spark, folder))


def i33_rerun(t: Lake) -> DataFrame:
    """Rows of each Silver table before and after a run over everything is repeated."""
    folder, bronze = t.scratch(), t.landed()
    seen = []
    for _ in range(2):
        build.build_silver(bronze, t["person_identifiers"], t["name_variations"], folder, parts=t.parts)
        own = build.silver_tables(t.spark, folder)
        seen.append({r["table_name"]: r["n_rows"] for r in quality.row_counts(own).collect()})  # a row for each table
    return t.spark.createDataFrame([(n, seen[0][n], seen[1][n]) for n in sorted(seen[0])], "table_name string, rows_before long, rows_after long")


BRONZE: dict[str, Query] = {
    "c01_content_skip": lake(landed_new),
    "c01_indexed_skip": lake(c01_indexed_skip),
    "c11_indexed_loads": lake(c11_indexed_loads),
    "c02_max_revision": lake(lambda t: bronze.max_revision(revised(t))),
    "c03_revision_assignment": lake(assigned),
    "c04_idempotency": lake(c04_idempotency),
    "c05_row_hash": lake(lambda t: S.table(t.spark, t.sf_dir, "documents").select("doc_id", M.row_hash(F.col("doc_id"), F.col("lang"), F.col("source"), F.when(F.col("doc_id") % 5 != 0, F.col("n_chars"))).alias("row_hash"))),
    "c07_identifier_unpivot": lake(lambda t: register.identifiers(t["people"])),
    "c08_name_variations": of("name_variations"),
    "c10_register_load": lake(c10_register_load),
    "c11_bronze_load_counts": lake(c11_bronze_load),
}

SILVER: dict[str, Query] = {
    "d01_latest_revision": lake(lambda t: bronze.latest_revision(revised(t), ties=("event_id",)).select("match_id", "revision", "event_id")),
    "d02_json_parse": lake(lambda t: t["parsed"].select("match_id", F.col("doc.meta.data_version").alias("data_version"), F.size("doc.innings").alias("n_innings"), F.size("doc.info.teams").alias("n_teams"), F.array_join("doc.info.dates", ",").alias("dates"), F.col("doc.info.season").alias("season"))),
    "d04_matches": lake(lambda t: t["matches"].withColumn("player_of_match", F.array_join("player_of_match", ","))),
    "d05_innings": of("innings"),
    "d06_deliveries": of("deliveries"),
    "d07_wickets": lake(lambda t: t["wickets"].withColumn("fielders", F.array_join("fielders", ","))),
    "d08_powerplays": of("powerplays"),
    "d09_registry": of("registry"),
    "d10_teams": of("teams"),
    "d11_venues": of("venues"),
    "d12_competitions": of("competitions"),
    "d13_match_players": of("match_players"),
    "d14_match_officials": of("match_officials"),
    "d15_unmatched_audit": lake(lambda t: identity.audit(t["resolved_players"], t["resolved_officials"])),
    "d16_persons": of("persons"),
    "d17_person_identifiers": of("person_identifiers"),
    "d19_silver_build": lake(d19_silver_build),
    "e01_resolution_paths": lake(lambda t: t["resolved_players"].select("match_id", "team", "player_name", "cricsheet_id", "person_id")),
    "s06_document_checks": lake(lambda t: silver.document_checks(t["info"])),
}

GOLD: dict[str, Query] = {
    "f01_dim_match": lake(gold.dim_match),
    "f02_dim_player": lake(gold.dim_player),
    "f03_dim_team": lake(gold.dim_team),
    "f03_team_scope": lake(lambda t: gold.names_in_scope(t["matches"], t["audit"], ("team_a", "team_b"), "team_name")),
    "f04_dim_venue": lake(gold.dim_venue),
    "f05_dim_competition": lake(gold.dim_competition),
    "f06_dim_date": lake(lambda t: S.table(t.spark, t.sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct().join(gold.dim_date(t.spark), "date")),
    "f07_player_display_names": of("player_display_names"),
    "f08_fact_delivery": of("fact_delivery"),
    "f09_fact_innings": of("fact_innings"),
    "f10_fact_match_result": lake(gold.fact_match_result),
    "f11_fact_player_match": of("fact_player_match"),
    "f12_fact_player_of_match": lake(gold.fact_player_of_match),
    "g01_player_batting": of("mart_player_batting"),
    "g02_player_bowling": of("mart_player_bowling"),
    "g03_team_performance": of("mart_team_performance"),
    "g03_team_performance_fixed": lake(lambda t: marts.team_performance(t, fix=True)),
    "g04_venue_dna": of("mart_venue_dna"),
    "g04_venue_dna_fixed": of("mart_venue_dna_fixed"),
    "g05_phase_scoring": of("mart_phase_scoring"),
    "g06_toss_outcome": of("mart_toss_outcome"),
    "g07_matchup_analysis": of("mart_matchup"),
}

R = reports
REPORTS: dict[str, Query] = {
    "h01_counters": lake(R.counters), "h02_matches_per_year": lake(R.matches_per_year), "h03_format_breakdown": lake(R.format_breakdown), "h04_top_venues": lake(R.top_venues),
    "h05_top_run_scorers": lake(R.top_run_scorers), "h06_top_wicket_takers": lake(R.top_wicket_takers), "h07_highest_score": lake(R.highest_score), "h07_highest_score_mart": lake(R.highest_score_mart),
    "h08_season_leader_runs": lake(lambda t: R.season_leader(t["mart_player_batting"], "total_runs")), "h08_season_leader_wickets": lake(lambda t: R.season_leader(t["mart_player_bowling"], "total_wickets")),
    "h09_top_matchups": lake(lambda t: R.top_matchups(t, least=2)), "h09_top_matchups_mart": lake(lambda t: R.top_matchups_mart({"mart_matchup": t["duels"]})),
    "h10_player_headline": lake(lambda t: R.player_headline(t, SHOWN)), "h10_player_headline_mart": lake(lambda t: R.player_headline_mart(t, PLAYER)),
    "h11_format_split": lake(lambda t: R.player_by(t, SHOWN, "match_type")), "h11_format_split_mart": lake(lambda t: R.player_by_mart(t, PLAYER, "match_type")),
    "h12_season_trend": lake(lambda t: R.player_by(t, SHOWN, "season")), "h12_season_trend_mart": lake(lambda t: R.player_by_mart(t, PLAYER, "season")),
    "h13_bowling_card": lake(lambda t: R.player_bowling_card(t, BOWLER)), "h14_last_innings": lake(lambda t: R.player_last_innings(t, PLAYER)), "h14_last_matches": lake(lambda t: R.player_last_matches(t, PLAYER)),
    "h15_match_summary": lake(R.match_summary), "h16_manhattan": lake(R.manhattan), "h17_worm": lake(R.worm), "h18_top_batters": lake(lambda t: R.best_of_match(t, "batting")), "h18_top_bowlers": lake(lambda t: R.best_of_match(t, "bowling")),
    "h19_fall_of_wickets": lake(R.fall_of_wickets), "h20_latest_matches": lake(R.latest_matches), "h21_matchup_card": lake(lambda t: R.matchup_card({"mart_matchup": t["duels"]}, PLAYER, BOWLER)),
    "h22_nemesis": lake(lambda t: R.nemesis({"mart_matchup": t["duels"]}, PLAYER)), "h22_victims": lake(lambda t: R.nemesis({"mart_matchup": t["duels"]}, BOWLER, "bowler_name")), "h23_resolver": lake(lambda t: R.resolver(t, "star")),
    "h24_career_summary": lake(R.career_summary), "h25_year_by_year": lake(R.year_by_year), "h26_opponents": lake(R.opponents), "h27_dismissal_modes": lake(R.dismissal_modes),
    "h28_innings_context": lake(lambda t: R.innings_context(t, HOME)), "h29_editions": lake(lambda t: R.editions(t, "Cup%")), "h30_recent_scorers": lake(R.recent_scorers),
    "h32_sample": lake(lambda t: R.sample(R.latest_matches(t), 20, 6)),
    "h31_best_economy": lake(lambda t: R.best_economy(t, 5.0)), "h31_team_formats": lake(lambda t: R.team_formats(t, "NATION_6")), "h31_head_to_head": lake(R.head_to_head), "h31_chasing_venues": lake(lambda t: R.chasing_venues(t, 2)),
}


def silver_quality(t: Lake) -> DataFrame:
    names = {"match_registry": "registry"}
    return tables.union([quality.run(t[names.get(n, n)], "silver", n, checks) for n, checks in quality.silver_checks().items()])


def bronze_quality(t: Lake) -> DataFrame:
    b = t["bronze"].withColumn("city", F.when(F.col("city") != "", F.col("city")))
    return quality.run(b, "bronze", "match_data", [quality.Check("MAT-BRZ-002", quality.surplus("match_id", "revision")), quality.Check("MAT-BRZ-004", quality.blank("match_type", "city", "venue", "season"), "WARN", 1.0)])


def grain_and_orphans(t: Lake) -> DataFrame:
    li = S.table(t.spark, t.sf_dir, "lineitem")
    lab, doc = S.table(t.spark, t.sf_dir, "labels"), S.table(t.spark, t.sf_dir, "documents")
    parts = [quality.run(li, "driver", "lineitem", [quality.Check("GRAIN", quality.surplus("l_orderkey", "l_linenumber")), quality.Check("NULLS", quality.missing("l_orderkey", "l_shipdate")), quality.Check("VALUES", quality.outside("l_returnflag", "A", "N"), "WARN")])]
    parts.append(quality.orphan_check("LABELS", lab, doc, "doc_id", table_name="labels", layer="driver"))
    parts.append(quality.orphan_check("UNLABELLED", doc, lab, "doc_id", table_name="documents", layer="driver"))
    parts.append(quality.orphan_check("MAT-SLV-007", t["match_players"], t["persons"], "person_id", table_name="match_players"))
    return tables.union(parts)


def active_eleven(t: Lake) -> DataFrame:
    """Every ball with the elevens that stood on the field."""
    out = lineup.active_in_documents(t["lineup"])
    return out.withColumns({f"{side}_eleven": F.array_join(f"{side}_eleven", ",") for side in ("batting", "fielding")})


RUN = "run-1"


def load_log(t: Lake) -> DataFrame:
    """The log row of one load of all orders, of which the pending ones failed."""
    o = S.table(t.spark, t.sf_dir, "orders")
    bad = F.count_if(F.col("o_orderstatus") == "P")
    n = F.count(F.lit(1))
    return o.agg(F.lit(RUN).alias("run_id"), n.alias("attempted"), bad.alias("failed"), (n - bad).alias("rows_written"))


def run_audit(t: Lake) -> DataFrame:
    o = S.table(t.spark, t.sf_dir, "orders")
    return o.select(F.when(F.col("o_orderstatus") == "P", "run-0").otherwise(RUN).alias("pipeline_run_id"))


def i03_coherence(t: Lake) -> DataFrame:
    """Of the run itself, of another run, and without a log."""
    log, audit = load_log(t), run_audit(t)
    return tables.union([quality.audit_coherence(x, audit, run).withColumn("case", F.lit(c)) for c, x, run in (("own", log, RUN), ("other", log, "run-2"), ("none", log.where("attempted < 0"), RUN))])


def register_log(t: Lake) -> DataFrame:
    """Rows that landed, by file: one count a day and type of event."""
    return daily_counts(t).select(F.col("event_type").alias("source_file"), F.lit(S.SNAPSHOT).cast("date").alias("snapshot_date"), F.when(F.dayofmonth("day") % 5 == 0, "FAILED").otherwise("SUCCESS").alias("status"), F.col("n_rows").alias("row_count"), F.dayofyear("day").alias("id"))


def i15_arrived(t: Lake) -> DataFrame:
    """People in Bronze against as many landed rows, twice as many, and no log."""
    people = t["people"]
    landed = people.agg(F.count(F.lit(1)).alias("row_count"))
    cases = (("all", landed), ("half", landed.select((F.col("row_count") * 2).alias("row_count"))), ("none", landed.where("row_count < 0")))
    return tables.union([quality.arrived("REG-SLV-005", people, x).withColumn("case", F.lit(c)) for c, x in cases])


def i17_missing_table(t: Lake) -> DataFrame:
    name = f"orders_{uuid.uuid4().hex}"
    ddl = "o_orderkey long"
    before = quality.table_or_empty(t.spark, name, ddl).agg(F.lit("missing").alias("state"), F.count(F.lit(1)).alias("n"))
    S.table(t.spark, t.sf_dir, "orders").createOrReplaceTempView(name)
    return before.unionByName(quality.table_or_empty(t.spark, name, ddl).agg(F.lit("present").alias("state"), F.count(F.lit(1)).alias("n")))


def i18_stored_results(t: Lake) -> DataFrame:
    path = t.scratch()
    for run in ("run-1", "run-2"):
        quality.store(grain_and_orphans(t), path, run)
    return t.spark.read.parquet(path)


def i07_grain_by_bucket(t: Lake) -> DataFrame:
    """Lines in a table keyed by the day of their order; then the last day comes in with every line twice. Digests of touched buckets are renewed, and the check is the full one's.

    A day lies in one bucket, so however many orders it has, the others are not read. An order has one day: it adds nothing to the grain.
    """
    path, store = t.scratch(), t.scratch()
    li, orders = S.table(t.spark, t.sf_dir, "lineitem"), S.table(t.spark, t.sf_dir, "orders")
    days = orders.groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(F.max("o_orderdate").alias("o_orderdate"))
    tables.create_keyed(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(days, "l_orderkey", "left"), path, ["o_orderdate"], 256)
    last = tables.for_key_buckets(t.spark, path, ["o_orderdate"], orders.agg(F.max("o_orderdate").alias("o_orderdate")))
    found = []
    for step in ("before", "after"):
        if step == "after":
            tables.keyed_replace(last.unionByName(last), path, ["o_orderdate"])
        read = grain.refresh(t.spark, path, ["o_orderdate"], ["o_orderdate", "l_orderkey", "l_linenumber", "l_partkey"], store)
        r = grain.surplus(t.spark, store).first()
        found.append((step, r["failed"], r["total"], read < 256))
    return t.spark.createDataFrame(found, "step string, failed long, total long, partly boolean")


def i22_bronze_types(t: Lake) -> DataFrame:
    found = {n: quality.not_all_strings(df) for n, df in (("match_data", t["bronze"]), ("orders", S.table(t.spark, t.sf_dir, "orders")))}
    return t.spark.createDataFrame([(n, c) for n, cols in found.items() for c in cols], "table_name string, column_name string")


def i23_one_snapshot(t: Lake) -> DataFrame:
    register_rows = register.parse_register(t["people"], S.names_csv(t.spark, t.sf_dir))
    dated = {n: df.withColumn("_snapshot_date", F.lit(S.SNAPSHOT).cast("date")) for n, df in register_rows.items()}
    return quality.one_snapshot({"match_data": t["bronze"]} | dated | {"events": events_as(t).withColumnRenamed("day", "_snapshot_date")})


QUALITY: dict[str, Query] = {
    "i01_failed_files": lake(lambda t: quality.failed_files(load_log(t))),
    "i03_audit_coherence": lake(i03_coherence),
    "i15_rows_arrived": lake(i15_arrived),
    "i17_missing_table": lake(i17_missing_table),
    "i18_stored_results": lake(i18_stored_results),
    "i19_model_tests": lake(lambda t: quality.run_model_tests(t)),
    "i20_award_ties": lake(lambda t: quality.repeated_grain(t["fact_player_of_match"], "match_id")),
    "i07_grain_by_bucket": lake(i07_grain_by_bucket),
    "i22_bronze_types": lake(i22_bronze_types),
    "i23_one_snapshot": lake(i23_one_snapshot),
    "i26_dimension_integrity": lake(lambda t: quality.dimension_integrity(t)),
    "i27_fact_integrity": lake(lambda t: quality.fact_integrity(t)),
    "i28_reconciliation": lake(lambda t: quality.reconciliation(t, t["bronze"], t["people"])),
    "i30_mart_coverage": lake(lambda t: quality.mart_coverage(t)),
    "i31_last_ingest": lake(lambda t: quality.last_ingest({"bronze.match_data": t["bronze"], "events": events_as(t).withColumnRenamed("ts", "_ingested_at")})),
    "i33_rerun": lake(i33_rerun),
    "i02_bronze_checks": lake(bronze_quality),
    "i05_silver_checks": lake(silver_quality),
    "i08_unmatched_rate": lake(lambda t: quality.unmatched_rate(t["match_players"], t["match_officials"], identity.audit(t["resolved_players"], t["resolved_officials"]))),
    "i10_grain_and_orphans": lake(grain_and_orphans),
    "i16_orphan_names": lake(lambda t: quality.orphan_names(t["name_variations"], t["persons"]).withColumn("sample", F.array_join("sample", ","))),
    "i21_row_counts": lake(lambda t: quality.row_counts({n: t[n] for n in ("matches", "innings", "deliveries", "wickets", "match_players", "persons")})),
    "i29_business_rules": lake(quality.business_rules),
    "i31_freshness": lake(quality.freshness),
    "i32_snapshot_histogram": lake(lambda t: quality.snapshot_histogram(events_as(t).withColumnRenamed("day", "_snapshot_date"), "user_id").withColumnRenamed("_snapshot_date", "day")),
}


def stamped(t: Lake) -> DataFrame:
    ids = control.pending_silver(t["audit"]).where("cast(match_id as long) % 2 = 0")
    out = control.stamp(t["audit"], ids, ["match_id"], "silver_loaded_at", F.lit("2024-01-01 00:00:00").cast("timestamp"), only_empty=True)
    return out.groupBy(F.col("silver_loaded_at").isNull().alias("open")).agg(F.count(F.lit(1)).alias("n"))


def daily_counts(t: Lake) -> DataFrame:
    return events_as(t).groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n_rows"))


def landed_audit(t: Lake) -> DataFrame:
    a = t["audit"]
    key = F.col("match_id").cast("long")
    return control.land(a.where(key % 2 == 0), a.where((key % 2 == 1) | (key % 3 == 0))).select("file_name", "content_hash")


def column_catalog(t: Lake) -> DataFrame:
    """Columns of each event type's payload by day, as a growing catalogue: the value's size class stands for its type."""
    e = events_as(t)
    col = F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string"))
    return e.groupBy(F.col("event_type").alias("table_name"), F.dayofmonth("day").alias("snapshot"), col.alias("column_name")).agg(F.when(F.count(F.lit(1)) > 2, "long").otherwise("int").alias("column_type"))


def versions(t: Lake) -> tuple[DataFrame, DataFrame]:
    c = S.table(t.spark, t.sf_dir, "customer")
    h = lambda bal: M.row_hash(F.col("c_mktsegment"), F.round(bal, 2)).alias("h")
    return c.where("c_custkey % 7 <> 0").select("c_custkey", h(F.col("c_acctbal"))), c.where("c_custkey % 5 <> 0").select("c_custkey", h(F.when(F.col("c_custkey") % 4 == 0, F.lit(0.5)).otherwise(F.col("c_acctbal"))))


def j02_stamp_bronze(t: Lake) -> DataFrame:
    """Even matches reach Bronze as revision 2."""
    a = t["audit"].withColumn("bronze_loaded_at", F.lit(None).cast("timestamp"))
    loaded = a.where(F.col("match_id").cast("long") % 2 == 0).select("file_name", "content_hash", F.lit("2").alias("revision"))
    out = control.stamp_bronze(a, loaded, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return out.select("match_id", "revision", F.col("bronze_loaded_at").isNotNull().alias("loaded"))


def j03_stamp_archive(t: Lake) -> DataFrame:
    a = t["audit"].withColumn("archive_path", F.lit(None).cast("string"))
    moved = a.where(F.col("match_id").cast("long") % 3 == 0).select("file_name", "content_hash", F.concat(F.lit("archive/"), "file_name").alias("archive_path"))
    return control.stamp_archive(a, moved).select("match_id", "archive_path")


def j08_seed_audit(t: Lake) -> DataFrame:
    """Files are listed for two of three matches; the others get the name that their id suggests."""
    listed = t["bronze"].where(F.col("match_id").cast("long") % 3 != 0).select("match_id", F.concat(F.lit("listed-"), "match_id", F.lit(".json")).alias("file_name"))
    out = control.seed_from_bronze(t["bronze"], listed)
    return out.select("match_id", "file_name", "revision", F.length("content_hash").alias("hash_length"), (F.col("silver_loaded_at") == F.col("bronze_loaded_at")).alias("silver_done"), F.col("gold_loaded_at").isNull().alias("gold_open"))


def j12_row_guard(t: Lake) -> DataFrame:
    """A table that has enough rows passes."""
    li = S.table(t.spark, t.sf_dir, "lineitem")
    control.enough_rows(li)
    return li.agg(F.count(F.lit(1)).alias("n_rows"))


def run_log(t: Lake) -> DataFrame:
    """A load log: every event is a run that starts; most end up to ten minutes later."""
    e, key = S.table(t.spark, t.sf_dir, "events"), F.col("event_id")
    runs = e.select(F.concat(F.lit("run-"), key.cast("string")).alias("run_id"), F.to_date("ts").alias("snapshot_date"), F.col("ts").cast("timestamp").alias("at"), key, "event_type")
    ended = runs.where(key % 7 != 0).withColumn("at", F.timestamp_seconds(F.unix_seconds("at") + key % 600))
    good = ended.where("event_type <> 'error'").withColumns({"attempted": key % 50, "succeeded": key % 50, "failed": F.lit(0), "rows_written": key % 50})
    bad = control.log_rows(ended.where("event_type = 'error'"), "FAILED", F.concat(F.lit("failed: "), F.repeat(F.lit("ab"), 1500)))
    return tables.union([control.log_started(runs), control.log_rows(good, "SUCCESS"), bad])


def timed_runs(t: Lake) -> DataFrame:
    return events_as(t).select(F.col("ts").alias("started_at"), F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"), F.col("value").alias("seconds"), F.concat(F.lit("task-"), (F.col("user_id") % 25).cast("string")).alias("task"))


def lines_by_type(t: Lake) -> list[DataFrame]:
    """Lines in three batches, each of another type: narrow; with a nested field more and wider numbers; without it again and in doubles."""
    li = S.table(t.spark, t.sf_dir, "lineitem")
    key, third = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("k"), F.col("l_orderkey") % 3
    item = lambda kind, *more: F.array(F.struct(F.col("l_partkey").cast(kind).alias("part"), *more)).alias("items")
    return [
        li.where(third == 0).select(key, F.struct(F.col("l_quantity").cast("int").alias("n")).alias("amount"), item("int")),
        li.where(third == 1).select(key, F.struct(F.col("l_quantity").cast("int").alias("n"), F.col("l_tax").alias("tax")).alias("amount"), item("bigint", F.col("l_suppkey").alias("supplier")), F.col("l_returnflag").alias("flag")),
        li.where(third == 2).select(key, F.struct(F.col("l_quantity").cast("double").alias("n")).alias("amount"), item("int")),
    ]


def flat_lines(df: DataFrame) -> DataFrame:
    return df.select("k", "amount.n", "amount.tax", F.col("items")[0]["part"].alias("part"), F.col("items")[0]["supplier"].alias("supplier"), "flag")


def j10_evolving_append(t: Lake) -> DataFrame:
    path = t.scratch()
    for batch in lines_by_type(t):
        evolving.append(batch, path)
    return flat_lines(evolving.read(t.spark, path))


def j10_evolving_replace(t: Lake) -> DataFrame:
    """A keyed table of the narrow type; the other batches come in, and half of the first one again under the second's type."""
    path, (narrow, wide, doubles) = t.scratch(), lines_by_type(t)
    evolving.keyed_replace(narrow, path, ["k"], buckets=16)
    again = narrow.where(F.col("amount.n") % 2 == 0).withColumn("flag", F.lit("again"))
    for batch in (wide, doubles, again):
        evolving.keyed_replace(batch, path, ["k"])
    return flat_lines(evolving.read_keyed(t.spark, path))


def s01_scd2_stored(t: Lake) -> DataFrame:
    """The same history, merged from three deliveries of which the last two are late."""
    e, path = events_as(t).select("user_id", "event_id", "event_type"), t.scratch()
    for third in (2, 0, 1):
        history.merge_snapshot(e.where(F.col("event_id") % 3 == third), path, "user_id", "event_id", "event_type")
    return history.history(t.spark, path)


CONTROL: dict[str, Query] = {
    "j02_stamp_bronze": lake(j02_stamp_bronze),
    "j03_stamp_archive": lake(j03_stamp_archive),
    "j08_seed_audit": lake(j08_seed_audit),
    "j12_row_guard": lake(j12_row_guard),
    "j15_failures": lake(lambda t: control.failures(grain_and_orphans(t).withColumn("status", F.when(F.col("failed") > 0, "FAILED").otherwise(F.col("status")))).select("check_id", "table_name", "failed")),
    "j17_landed_counts": lake(lambda t: control.landed_counts(register_log(t), F.lit(S.SNAPSHOT).cast("date"))),
    "j18_load_log": lake(lambda t: control.latest_log(run_log(t)).select("run_id", "status", "attempted", "rows_written", "duration_seconds", F.length("message").alias("message_length"))),
    "j01_land_new_files": lake(landed_audit),
    "j04_pending_silver": lake(lambda t: control.pending_silver(t["audit"])),
    "j05_stamp_silver": lake(stamped),
    "j06_pending_gold": lake(lambda t: control.pending_gold(t["audit"])),
    "j07_stamp_gold": lake(lambda t: control.stamp_gold(t["audit"], F.lit("2024-01-01 00:00:00").cast("timestamp")).groupBy(F.col("gold_loaded_at").isNull().alias("open")).agg(F.count(F.lit(1)).alias("n"))),
    "j09_column_drift": lake(lambda t: control.column_drift(column_catalog(t)).withColumns({"added": F.array_join(F.array_sort("added"), ","), "removed": F.array_join(F.array_sort("removed"), ",")})),
    "j10_schema_drift": lake(lambda t: control.schema_drift(column_catalog(t))),
    "j10_evolving_append": lake(j10_evolving_append),
    "j10_evolving_replace": lake(j10_evolving_replace),
    "j11_row_count_log": lake(lambda t: control.row_count_log(daily_counts(t), "event_type", "day")),
    "j13_snapshot_diff": lake(lambda t: control.snapshot_diff(*versions(t), "c_custkey", "h")),
    "j14_latest_per_key": lake(lambda t: control.latest_by(events_as(t), ["user_id", "event_type"], F.col("ts").desc(), F.col("event_id").desc()).select("user_id", "event_type", "event_id")),
    "j16_latest_archives": lake(lambda t: control.latest_archives(events_as(t).select(F.col("event_type").alias("archive"), F.col("day").alias("loaded_at"), F.lit(1).alias("n_files")))),
    "s01_scd2": lake(lambda t: control.scd2(events_as(t).select(F.col("user_id"), F.col("event_id"), F.col("event_type")), "user_id", "event_id", "event_type")),
    "s01_scd2_stored": lake(s01_scd2_stored),
    "s03_season_year": lake(lambda t: S.table(t.spark, t.sf_dir, "orders").select("o_orderkey", M.season_year(F.concat(F.year("o_orderdate").cast("string"), F.lit("/03"))).alias("season_year"))),
    "s05_daily_runs": lake(lambda t: control.daily_runs(timed_runs(t))),
    "s05_top_tasks": lake(lambda t: control.top_tasks(timed_runs(t))),
    "s05_data_freshness": lake(lambda t: control.data_freshness(timed_runs(t), F.lit("2024-02-01").cast("date"))),
    "s07_replacements": of("replacements"),
    "s07_active_eleven": lake(active_eleven),
    "s08_over_features": lake(R.over_features),
}


#: Queries that read documents twice and more: parsing them into files once costs less.
STORED = (
    "b12_incremental_scope", "d13_match_players", "d14_match_officials", "d15_unmatched_audit", "e01_resolution_paths", "f07_player_display_names", "g05_phase_scoring", "h05_top_run_scorers", "h06_top_wicket_takers", "h07_highest_score",
    "h09_top_matchups", "h16_manhattan", "h17_worm", "h19_fall_of_wickets", "h23_resolver", "h24_career_summary", "h25_year_by_year", "h28_innings_context", "h29_editions", "i10_grain_and_orphans", "j15_failures", "s08_over_features",
    "a16_staging_views", "b10_export", "b12_incremental_gold", "f08_fact_delivery", "f09_fact_innings", "f11_fact_player_match", "g01_player_batting", "g02_player_bowling", "g04_venue_dna", "g04_venue_dna_fixed", "g07_matchup_analysis",
    "h01_counters", "h07_highest_score_mart", "h08_season_leader_runs", "h08_season_leader_wickets", "h09_top_matchups_mart", "h10_player_headline", "h10_player_headline_mart", "h11_format_split", "h11_format_split_mart",
    "h12_season_trend", "h12_season_trend_mart", "h13_bowling_card", "h14_last_innings", "h14_last_matches", "h18_top_batters", "h18_top_bowlers", "h21_matchup_card", "h22_nemesis", "h22_victims", "h26_opponents", "h27_dismissal_modes",
    "h30_recent_scorers", "h31_best_economy", "h31_chasing_venues", "i05_silver_checks", "i08_unmatched_rate", "i18_stored_results", "i19_model_tests", "i21_row_counts", "i26_dimension_integrity", "i27_fact_integrity",
    "i28_reconciliation", "i29_business_rules", "i30_mart_coverage",
)


#: Of these, the ones that read most of fact_delivery twice and more.
FACTS = ("f11_fact_player_match", "h14_last_matches", "h18_top_batters", "h18_top_bowlers", "i19_model_tests", "i27_fact_integrity")


def storing(query: Query, facts: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        Lake.of(spark, sf_dir).store(facts)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = SOURCES | SINKS | BRONZE | SILVER | GOLD | REPORTS | QUALITY | CONTROL
    return found | {name: storing(found[name], name in FACTS) for name in STORED}
