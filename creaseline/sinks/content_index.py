"""What Bronze holds already, as small keyed tables: content hashes, and the newest revision of each match.

A load reads only the buckets that its own hashes and matches fall into, and of those, while its hashes are few enough to be named,
only row groups whose Bloom filters may hold one of them. So the cost of a load grows with the load, not with Bronze.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.sinks import tables

HASH, MATCH = "content_hash", "match_id"
#: Up to so many hashes of a load are named in the filter, which the readers hold against the Bloom filters of row groups.
NAMED_HASHES = 1_000


def bloom(rows: int) -> dict[str, str]:
    """Writer options: a Bloom filter of hashes in each row group."""
    return {f"parquet.bloom.filter.enabled#{HASH}": "true", f"parquet.bloom.filter.expected.ndv#{HASH}": str(max(1, rows))}


def create(known: DataFrame, folder: str) -> None:
    """The index of what known (match_id, revision, content_hash) holds; it may be empty."""
    tables.create_keyed(known.select(HASH).distinct(), f"{folder}/hashes", [HASH], options=bloom(tables.BUCKET_ROWS))
    heads = known.groupBy(MATCH).agg(F.max(F.col("revision").try_cast("int")).alias("revision"))
    tables.create_keyed(heads, f"{folder}/heads", [MATCH])  # last: what tells that there is an index


def exists(spark: SparkSession, folder: str) -> bool:
    return tables.keyed_exists(spark, f"{folder}/heads")


def known_hashes(landed: DataFrame, folder: str) -> DataFrame:
    """Those hashes of landed that the index has."""
    wanted = landed.select(HASH).distinct()
    few = [r[0] for r in wanted.limit(NAMED_HASHES + 1).collect()]
    named = F.col(HASH).isin(few) if len(few) <= NAMED_HASHES else None
    return tables.for_key_buckets(landed.sparkSession, f"{folder}/hashes", [HASH], wanted, named)


def unknown(landed: DataFrame, folder: str) -> DataFrame:
    """Landed rows whose content is not in the index."""
    return landed.join(known_hashes(landed, folder), HASH, "left_anti")


def heads(landed: DataFrame, folder: str) -> DataFrame:
    """(match_id, revision) of the matches of landed that Bronze has."""
    return tables.for_key_buckets(landed.sparkSession, f"{folder}/heads", [MATCH], landed.select(MATCH).distinct())


def remember(rows: DataFrame, folder: str) -> None:
    """Add Bronze rows (match_id, revision, content_hash); adding them again changes nothing that is read."""
    tables.append_keyed(rows.select(HASH).distinct(), f"{folder}/hashes", [HASH], options=bloom(tables.BUCKET_ROWS))
    new = rows.groupBy(MATCH).agg(F.max(F.col("revision").try_cast("int")).alias("revision"))
    both = new.unionByName(heads(rows, folder)).groupBy(MATCH).agg(F.max("revision").alias("revision"))
    tables.upsert(both, f"{folder}/heads", [MATCH])
