"""Whole runs: Silver from Bronze and Gold from Silver, for all matches or for those that are pending, written as tables."""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.operators import identity, silver
from creaseline.plans import gold
from creaseline.plans.pending import Pending
from creaseline.schema import BALLS_DDL, INFO_DDL
from creaseline.sinks import tables
from creaseline.sources import files

#: Silver tables by match, in order of building.
BY_MATCH = ("matches", "innings", "powerplays", "deliveries", "wickets", "replacements", "registry", "match_players", "match_officials", "unmatched_persons_audit")
#: Those of them that come from balls.
BY_BALL = ("deliveries", "wickets", "replacements")
#: Tables over all matches, with their keys.
WHOLE = {"teams": ["team_name"], "venues": ["venue_name", "city"], "competitions": ["competition_name"]}


#: A table of matches starts with one bucket for so many matches.
BUCKET_MATCHES = 10_000


def put(df: DataFrame, path: str, keys: list[str], scope: DataFrame | None, matches: int | None = None, stored: bool = False) -> int:
    """Replace the rows of the keys in scope, which holds all keys of df if it is given; the first call makes the table, for that many matches or, uncounted, for its rows. It grows with later ones. stored: df is kept already."""
    if tables.keyed_exists(df.sparkSession, path):
        return tables.keyed_replace(df, path, keys, scope, covers=scope is not None, stored=stored)
    return tables.create_keyed(df, path, keys, None if matches is None else max(1, -(-matches // BUCKET_MATCHES)))


def build_silver(bronze: DataFrame, identifiers: DataFrame, names: DataFrame, folder: str, match_ids: DataFrame | None = None, parts: int | None = None) -> dict[str, int]:
    """Write every Silver table under folder; returns rows written by table.

    match_ids restricts the tables by match, which are replaced match by match: only documents in scope are parsed. Teams, venues and
    competitions always stand for all of Bronze (update_whole). Nothing is read or written if match_ids is empty.

    Documents are parsed once, whole, into buckets by match; every table reads its columns of them, and persons are resolved where they lie.
    parts: the number of buckets by match that Bronze lies in, if it does; its documents are then parsed where they lie.
    """
    if match_ids is not None and match_ids.isEmpty():
        return {}
    spark = bronze.sparkSession
    rows = bronze if match_ids is None else files.for_keys(bronze, match_ids)
    n = rows.select("match_id").distinct().count()
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_MATCHES))
    parsed, place, written = silver.parse(rows.repartition(parts, "match_id")), f"{folder}/_documents/parsed", {}
    kept = [bucketed(parsed, place, "match_id", parts)]

    def part(shape: str) -> DataFrame:
        columns = ", ".join(f"`{c}` {shape if c == 'doc' else kind}" for c, kind in parsed.dtypes)
        kept.append(bucketed_part(spark, columns, place, "match_id", parts))
        return spark.table(kept[-1])

    try:
        own, balls = part(INFO_DDL), silver.balls(part(BALLS_DDL))
        scope = own.select("match_id")
        registry = silver.registry(own)

        def by_match(name: str, df: DataFrame, stored: bool = False) -> None:
            written[name] = put(df, f"{folder}/{name}", ["match_id"], scope, n, stored)

        written |= update_whole(bronze, folder, own if match_ids is None else None)
        for name in ("matches", "innings", "powerplays", "deliveries", "wickets", "replacements", "registry"):
            by_match(name, getattr(silver, name)(balls if name in BY_BALL else own))
        known = once(identity.mentioned(identifiers, registry), f"{folder}/_documents/identifiers"), once(identity.named(names), f"{folder}/_documents/names")
        people = lambda rows, name: once(identity.resolve(rows, name, registry, *known), f"{folder}/_documents/{name}")
        players, officials = people(silver.players(own), "player_name"), people(silver.officials(own), "official_name")
        by_match("match_players", players.drop("cricsheet_id"), True)
        by_match("match_officials", officials.drop("cricsheet_id"), True)
        by_match("unmatched_persons_audit", identity.audit(players, officials))
    finally:
        for table in kept:
            spark.sql(f"drop table if exists {table}")
    return written


def once(df: DataFrame, path: str) -> DataFrame:
    """df, written to path in place of what an earlier run left there, so that many readers compute it once."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, path: str, key: str, n: int) -> str:
    """df, written to path in n buckets by key, as a table of the session, in place of what an earlier run left there; returns its name. Readers join and group by the key without a shuffle."""
    name = f"creaseline_{uuid.uuid4().hex}"
    df.write.format("parquet").mode("overwrite").bucketBy(n, key).option("compression", "zstd").option("path", path).saveAsTable(name)
    return name


def bucketed_part(spark: SparkSession, columns: str, path: str, key: str, n: int) -> str:
    """A table over the files that bucketed() wrote, of the columns and nested fields that columns (DDL) names."""
    name = f"creaseline_{uuid.uuid4().hex}"
    spark.sql(f"create table {name} ({columns}) using parquet clustered by ({key}) into {n} buckets location '{path}'")
    return name


# -- tables over all matches ------------------------------------------------------------------------

MENTION = ["kind", "name", "detail"]


def stale(heads: DataFrame, known: DataFrame) -> DataFrame:
    """Matches whose mentions are not those of Bronze's latest revision: new, changed or gone ones. Only ids and revisions are read."""
    return heads.join(known.select("match_id", F.col("head").alias("known")).distinct(), "match_id", "full").where(~F.col("head").eqNullSafe(F.col("known"))).select("match_id")


def update_whole(bronze: DataFrame, folder: str, parsed: DataFrame | None = None) -> dict[str, int]:
    """Bring teams, venues and competitions to what all of Bronze mentions; returns the rows that were written by table.

    `mentions` keeps what each match mentions, `mention_counts` how many matches mention a name with the same particulars. A match that is
    new or has another latest revision is parsed by a schema without innings; what it mentioned before is counted down, what
    it mentions now up, and only names whose counts change are written again. So a run costs what changed, and a name
    that no document mentions any more goes. parsed: all documents, if they are parsed anyway.

    What a run will write is put down whole before any table changes. A run that breaks off is finished by the next one, and writing
    the same rows twice changes nothing.
    """
    spark, pending = bronze.sparkSession, Pending(bronze.sparkSession, f"{folder}/_pending_mentions")
    written = Counter(finish(pending, folder))
    heads = bronze.groupBy("match_id").agg(F.max(head()).alias("head"))
    place, tally = f"{folder}/mentions", f"{folder}/mention_counts"
    known = tables.keyed_exists(spark, place)
    ids = (stale(heads, tables.read_keyed(spark, place)) if known else heads.select("match_id")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not ids.isEmpty():
            docs = parsed if not known and parsed is not None else silver.parse_names(files.for_keys(bronze, ids) if known else bronze)
            pending.put("mentions", silver.mentions(docs).join(heads, "match_id"))
            pending.put("matches", ids)
            count = lambda df, sign: df.where("kind is not null").groupBy(*MENTION, "_snapshot_date").agg((F.count(F.lit(1)) * sign).alias("n"))
            delta = count(pending["mentions"], 1)
            if known:
                delta = delta.unionByName(count(tables.for_key_buckets(spark, place, ["match_id"], ids), -1))
            pending.put("delta", delta.groupBy(*MENTION, "_snapshot_date").agg(F.sum("n").alias("n")).where("n <> 0"))
            pending.put("names", pending["delta"].select("kind", "name").distinct())
            counts = pending["delta"]
            if known:
                counts = tables.for_key_buckets(spark, tally, ["kind", "name"], pending["names"]).unionByName(counts)
            pending.put("counts", counts.groupBy(*MENTION, "_snapshot_date").agg(F.sum("n").alias("n")).where("n > 0"))
            pending.mark(True)
            written.update(finish(pending, folder))
    finally:
        ids.unpersist()
    return {table: written[table] for table in WHOLE}


def finish(pending: Pending, folder: str) -> dict[str, int]:
    """Write what is pending, if it was put down whole; any number of times."""
    if not pending.ready():
        return {}
    names, counts = pending["names"], pending["counts"]
    put(counts, f"{folder}/mention_counts", ["kind", "name"], names)
    written = {}
    for table, keys in WHOLE.items():
        # by name, not by key: a venue's city is a part of its key, and may have gone
        gone = names.where(F.col("kind") == table).select(F.col("name").alias(keys[0]))
        written[table] = put(silver.from_mentions(table, counts), f"{folder}/{table}", keys[:1], gone)
    matches = pending["matches"]
    put(pending["mentions"], f"{folder}/mentions", ["match_id"], matches)
    pending.mark(False)
    return written


def head() -> Column:
    """What tells a match's latest revision from others, comparable by size."""
    return F.struct(F.col("revision").try_cast("int").alias("revision"), F.col("_ingested_at").alias("at"))


def silver_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: tables.read_keyed(spark, f"{folder}/{n}") for n in (*BY_MATCH, *WHOLE)}


def build_gold(t: dict[str, DataFrame], audit: DataFrame, folder: str) -> dict[str, int]:
    """Build the incremental models for the matches that audit leaves open and write them; returns rows written by model."""
    matches, written = t["matches"], {}
    ids = gold.open_matches(audit).join(matches.select("match_id"), "match_id", "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
    n = ids.count()
    if not n:
        return {}
    own = {n: files.for_keys(t[n], ids) for n in ("matches", "innings", "deliveries", "wickets", "match_players")}
    # what open matches mention is read from their rows: the audit is met once
    for table, column, of in (("teams", "team_name", ("team_a", "team_b")), ("venues", "venue_name", ("venue",)), ("competitions", "competition_name", ("event_name",))):
        own[table] = t[table].join(gold.names_of(own["matches"], of, column), column, "left_semi")
    for name, (model, keys) in gold.INCREMENTAL.items():
        df = model(own)
        by_match = "match_id" in keys
        if name == "fact_delivery":
            df = own[name] = df.persist(StorageLevel.MEMORY_AND_DISK)
        if name == "fact_innings":
            own[name] = df
        written[name] = put(df, f"{folder}/{name}", ["match_id"] if by_match else keys, ids if by_match else None, n if by_match else None, name == "fact_delivery")
    own["fact_delivery"].unpersist()
    ids.unpersist()
    return written
