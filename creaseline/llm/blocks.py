"""Helpers shared by the text operators: word hashing and flat numpy blocks.

A block is a list of documents laid end to end: one array of word hashes and one array of
document offsets. All per-word work runs on these flat arrays inside Spark tasks.
"""

from __future__ import annotations

import gc
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Distinct words of a generation that a Python worker remembers. Bounds memory only.
WORDS_KEPT = 100_000


class Remembered(dict):
    """What is computed for each word, remembered for two generations: a full one becomes the older one, and words that are met again move on."""

    def __init__(self) -> None:
        self.older: dict = {}

    def compute(self, word):
        raise NotImplementedError

    def __missing__(self, word):
        if len(self) >= WORDS_KEPT:
            self.older = dict(self)
            dict.clear(self)
        value = self.older.get(word)
        if value is None:
            value = self.compute(word)
        self[word] = value
        return value

    def clear(self) -> None:
        self.older = {}
        dict.clear(self)


class WordHashes(Remembered):
    """bytes word -> 64-bit hash."""

    def compute(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)


def tidy(*caches: dict) -> None:
    """At the end of a task: its worker also serves later stages, which should find its memory free."""
    for c in caches:
        c.clear()
    pa.default_memory_pool().release_unused()


def modest_batches(df: DataFrame) -> None:
    """Arrow batches of 1,000 rows where the session has Spark's default of 10,000: rows here are texts, and every copy of a batch counts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(name, "10000") == "10000":
        df.sparkSession.conf.set(name, "1000")


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    big = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return [x or b"" for x in column.cast(pa.large_binary() if big else pa.binary()).to_pylist()]


def hash_words(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), U64, len(words))


def offsets(lengths) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A second, independent-looking 64-bit value for each hash (the public splitmix64 finaliser)."""
    h = h + U64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def scaled(i: int, odd: np.uint64) -> np.uint64:
    return U64(i * int(odd) % (1 << 64))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def rabin_karp(h: np.ndarray, width: int, base: int = 0x5851F42D4C957F2D) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every run of `width` hashes, by prefix sums.

    The window that starts at i is (P[i+width] - P[i]) * base**-i; the base is odd, so its inverse exists.
    """
    n = len(h)
    if n < width:
        return np.zeros(0, U64)
    prefix = np.zeros(n + 1, U64)
    np.cumsum(h * powers(base, n), out=prefix[1:])
    return (prefix[width:] - prefix[:-width]) * powers(pow(base, -1, 1 << 64), n - width + 1)


def starts_inside(doc_offsets: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask over window starts 0..n-width of those that stay in one document."""
    ok = np.ones(max(0, n - width + 1), bool)
    for b in doc_offsets[1:-1]:
        ok[max(0, b - width + 1) : b] = False
    return ok


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that driver and executors share: spark.checkpoint.dir, or what a test has set."""
    return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder.

    spark.checkpoint.dir names it; only where that is unset (tests, one machine) a folder under the
    warehouse is used.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    done = df.checkpoint()
    release(spark)
    return done


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what was cut off.

    Its cleaner does so when the driver's JVM has collected the objects, which a large driver heap puts off for long; iterations
    of many small exchanges fill disks meanwhile. Where a session has no JVM at hand, that is all that is lost.
    """
    gc.collect()
    jvm = getattr(spark.sparkContext, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder.

    Unlike a checkpoint the table has a known size, by which Spark chooses how to join it: below
    spark.sql.autoBroadcastJoinThreshold the other side stays where it is, above both are shuffled.
    """
    spark = df.sparkSession
    folder = (shared_folder(spark) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    path = f"{folder}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def row_key(id_col: str, text_col: str) -> F.Column:
    """64 bits of hash of a row's id and text, nulls included. Two of n different rows share one with a probability below n*n / 2^65."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))


def once_each(docs: DataFrame, most_bytes: int) -> DataFrame:
    """docs (doc_id, text) with n, for how many equal rows a row stands: 1 but for rows whose copies exceed most_bytes, which become one.

    A hot row can't be dealt to several groups by anything that it holds; collapsed, it need not.
    """
    docs = docs.withColumn("__key", row_key("doc_id", "text"))
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(64))
    heavy = written(docs.groupBy("__key").agg(size.alias("bytes"), F.count(F.lit(1)).alias("n")).where((F.col("bytes") > most_bytes) & (F.col("n") > 1)).select("__key"))
    if heavy.isEmpty():
        return docs.select("doc_id", "text", F.lit(1).cast("long").alias("n"))
    merged = docs.join(heavy, "__key", "left_semi").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n"))
    return docs.join(heavy, "__key", "left_anti").select("doc_id", "text", F.lit(1).cast("long").alias("n")).unionByName(merged)


def all_copies(rows: DataFrame) -> DataFrame:
    """rows with n, each as often as n says."""
    return rows.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")


def bit_remainder(column: str, n: int) -> F.Column:
    """crc32(column as text) mod n."""
    return F.crc32(F.col(column).cast("string")) % n
