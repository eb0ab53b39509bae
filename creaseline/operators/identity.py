"""Identity resolution: names of a match to persons, and an audit of what could not be resolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_MAPPING, NO_MATCH = "NO_REGISTRY_MAPPING", "NO_REGISTER_MATCH"


def resolve(rows: DataFrame, name_col: str, registry: DataFrame, identifiers: DataFrame, names: DataFrame, direct: bool = False, persons: DataFrame | None = None) -> DataFrame:
    """rows with cricsheet_id (path A1) and person_id: by the registered identifier (A2), else by a name variation (B).

    A name or identifier of several persons gives the smallest person_id. direct: a registry id that is itself a person's id counts too.
    """
    by_registry = registry.select("match_id", F.col("display_name").alias(name_col), "cricsheet_id").dropDuplicates(["match_id", name_col])
    by_id = identifiers.where("source_system = 'cricsheet'").groupBy(F.col("source_identifier").alias("cricsheet_id")).agg(F.min("identifier").alias("person_a"))
    by_name = names.groupBy(F.col("name").alias(name_col)).agg(F.min("identifier").alias("person_b"))
    out = rows.join(by_registry, ["match_id", name_col], "left").join(by_id, "cricsheet_id", "left").join(by_name, name_col, "left")
    found = [F.col("person_a"), F.col("person_b")]
    if direct and persons is not None:
        out = out.join(persons.select(F.col("person_id").alias("person_c")).distinct(), F.col("cricsheet_id") == F.col("person_c"), "left")
        found.insert(1, F.col("person_c"))
    return out.withColumn("person_id", F.coalesce(*found)).select(*rows.columns, "cricsheet_id", "person_id")


def mentioned(identifiers: DataFrame, registry: DataFrame) -> DataFrame:
    """The identifiers that resolve() reads for these registries: one row for each registry id that some match has."""
    own = identifiers.where("source_system = 'cricsheet'").groupBy("source_system", "source_identifier").agg(F.min("identifier").alias("identifier"))
    return own.join(registry.select(F.col("cricsheet_id").alias("source_identifier")).distinct(), "source_identifier", "left_semi")


def named(names: DataFrame) -> DataFrame:
    """The name variations that resolve() reads: one row for each name."""
    return names.groupBy("name").agg(F.min("identifier").alias("identifier"))


def unresolved(resolved: DataFrame, name_col: str, role) -> DataFrame:
    reason = F.when(F.col("cricsheet_id").isNull(), NO_MAPPING).otherwise(NO_MATCH)
    return resolved.where("person_id is null").select("match_id", (role if not isinstance(role, str) else F.lit(role)).alias("role"), F.col(name_col).alias("display_name"), "cricsheet_id", reason.alias("reason"))


def audit(players: DataFrame, officials: DataFrame) -> DataFrame:
    both = unresolved(players, "player_name", "player").unionByName(unresolved(officials, "official_name", F.col("role")))
    return both.dropDuplicates(["match_id", "role", "display_name"])
