"""Write modes over Parquet folders: append, partition overwrite, keyed replace, upsert, purge, export."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

#: A keyed table has about one bucket for so many rows.
BUCKET_ROWS = 1_000_000


def observed_write(df: DataFrame, path: str, mode: str, partition_by: list[str] | None = None, **options) -> int:
    """Write once and return the number of rows, counted while writing."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get["n"]


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    return observed_write(df, path, "append", partition_by)


def full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    return observed_write(df, path, "overwrite", partition_by, partitionOverwriteMode="static")


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], **options) -> int:
    """Replace only the partitions that df holds; others stay."""
    return observed_write(df, path, "overwrite", partition_by, partitionOverwriteMode="dynamic", **options)


def create_if_missing(df: DataFrame, path: str, partition_by: list[str] | None = None, **properties) -> int:
    """Append; the first write makes the table, with its partition columns and writer properties."""
    return observed_write(df, path, "append", partition_by, **properties)


def delete_snapshot(spark: SparkSession, path: str, day: str, column: str = "_snapshot_date") -> None:
    """Empty one snapshot's partition before it is loaded again; the others stay as they are."""
    void = spark.read.parquet(path).drop(column).limit(0)
    void.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={day}")


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a key among so many, by linear hashing: when one more bucket is added, the rows of one other are split and no others move."""
    level = buckets.bit_length() - 1
    h = F.xxhash64(*keys)
    low, high = h.bitwiseAND(F.lit((1 << level) - 1)), h.bitwiseAND(F.lit((2 << level) - 1))
    return F.when(low < F.lit(buckets - (1 << level)), high).otherwise(low).cast("int")


def split_from(bucket: int, buckets: int) -> int:
    """The one of the first `buckets` buckets whose rows a later bucket takes over."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def layout(spark: SparkSession, path: str) -> int:
    """The number of buckets of a keyed table. Every bucket has a row at all times, so the table itself tells."""
    return spark.read.parquet(path).agg(F.max("__bucket")).first()[0] + 1


def rows_about(spark: SparkSession, path: str) -> int:
    """How many rows the table has, as noted at the last change. Only the number of buckets follows from it."""
    return noted(spark, path).first()["n_rows"]


def keyed_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a keyed table, whole: its rows are noted last."""
    try:
        noted(spark, path)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return False
    return True


def noted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("n_rows long").parquet(f"{path.rstrip('/')}/_layout")


def note_rows(spark: SparkSession, path: str, n: int) -> None:
    spark.createDataFrame([(n,)], "n_rows long").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/_layout")


def create_keyed(df: DataFrame, path: str, keys: list[str], buckets: int | None = None, bucket_rows: int | None = None, options: dict[str, str] | None = None) -> int:
    """A table that keyed_replace and upsert can change: rows lie in buckets by a hash of their key, about one for BUCKET_ROWS rows.

    buckets saves counting df first, where the caller knows about how many it needs; later changes add buckets as the table grows.
    """
    if buckets is None:
        buckets = max(1, -(-df.count() // (bucket_rows or BUCKET_ROWS)))
    rows = df.withColumns({"__void": F.lit(False), "__bucket": bucket_of(keys, buckets)})
    rows = rows.unionByName(void_rows(df, range(buckets)))
    n = observed_write(rows.repartition(buckets, "__bucket"), path, "overwrite", ["__bucket"], partitionOverwriteMode="static", **(options or {})) - buckets
    note_rows(df.sparkSession, path, n)
    return n


def void_rows(df: DataFrame, buckets) -> DataFrame:
    """A row of nulls for each bucket, so that none is ever without a file."""
    rows = df.sparkSession.createDataFrame([(b,) for b in buckets], "__bucket int")
    return rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields], F.lit(True).alias("__void"), "__bucket")


def with_void(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows of a keyed table, void ones too; under a given type, where its files differ in theirs."""
    reader = spark.read if schema is None else spark.read.schema(StructType([*schema.fields, StructField("__void", BooleanType()), StructField("__bucket", IntegerType())]))
    return reader.parquet(path)


def read_keyed(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return with_void(spark, path, schema).where("not __void").drop("__bucket", "__void")


#: Up to so many buckets are named one by one in the filter that a scan prunes by; more are joined, which prunes at run time.
NAMED_BUCKETS = 1_000


def in_buckets(table: DataFrame, hit: list[int]) -> DataFrame:
    if len(hit) <= NAMED_BUCKETS:
        return table.where(F.col("__bucket").isin(hit))
    return table.join(F.broadcast(table.sparkSession.createDataFrame([(b,) for b in hit], "__bucket int")), "__bucket", "left_semi")  # at most a number a bucket


def staged(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """df written once beside the table, and its rows: what a change reads several times is computed once. The next change replaces it."""
    place = f"{path.rstrip('/')}/_staged"
    n = observed_write(df, place, "overwrite")
    return df.sparkSession.read.schema(df.schema).parquet(place), n


def _rewrite(spark: SparkSession, path: str, keys: list[str], touched: DataFrame, added: int, change, bucket_rows: int | None = None, options: dict[str, str] | None = None, schema: StructType | None = None) -> None:
    """Rewrite the buckets of the touched keys in one dynamic overwrite: change(old rows) gives their new rows, at most `added` more.

    The table gets as many buckets as its rows ask for. Those that are split are rewritten with the touched ones; no other is read.
    A dynamic overwrite leaves partitions alone that the new rows don't reach, so every bucket gets one void row, which read_keyed
    leaves out.
    """
    buckets, rows = layout(spark, path), rows_about(spark, path)
    hit = {r[0] for r in touched.select(bucket_of(keys, buckets).alias("b")).distinct().collect()}  # at most `buckets` numbers
    grown = max(buckets, -(-(rows + added) // (bucket_rows or BUCKET_ROWS)))
    if not hit and grown == buckets:
        return
    new = range(buckets, grown)
    hit |= {split_from(b, buckets) for b in new}
    old = in_buckets(with_void(spark, path, schema), sorted(hit)).where(~F.col("__void")).drop("__bucket", "__void")
    before = old.count()  # one Boolean column of the buckets
    out = change(old).withColumns({"__void": F.lit(False), "__bucket": bucket_of(keys, grown)})
    written = sorted(hit | set(new))
    kept = overwrite_partitions(out.unionByName(void_rows(old, written)).repartition(len(written), "__bucket"), path, ["__bucket"], **(options or {})) - len(written)
    note_rows(spark, path, rows + kept - before)


def named_as(keys: list[str], wanted: DataFrame) -> tuple[DataFrame, Column]:
    """The keys under other names, and the condition that a row has one of them, null being equal to null."""
    other = wanted.select(*[F.col(k).alias(f"__gone_{k}") for k in keys])
    return other, reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__gone_{k}")) for k in keys))


def append_keyed(df: DataFrame, path: str, keys: list[str], options: dict[str, str] | None = None) -> int:
    """Add rows without reading any. Buckets that are due are split afterwards, which also makes one file of each one's."""
    spark, buckets = df.sparkSession, layout(df.sparkSession, path)
    df, n = staged(df, path)
    rows = df.withColumns({"__void": F.lit(False), "__bucket": bucket_of(keys, buckets)})
    observed_write(rows.repartition("__bucket"), path, "append", ["__bucket"], **(options or {}))
    note_rows(spark, path, rows_about(spark, path) + n)
    _rewrite(spark, path, keys, df.limit(0), 0, lambda old: old, options=options)
    return n


def for_key_buckets(spark: SparkSession, path: str, keys: list[str], wanted: DataFrame, also: Column | None = None) -> DataFrame:
    """The rows of the wanted keys; only their buckets are read, and of those what a further filter leaves."""
    buckets = layout(spark, path)
    hit = sorted(r[0] for r in wanted.select(bucket_of(keys, buckets).alias("b")).distinct().collect())  # at most `buckets` numbers
    named, same = named_as(keys, wanted)
    rows = in_buckets(spark.read.parquet(path), hit).where("not __void")
    rows = rows if also is None else rows.where(also)
    return rows.drop("__bucket", "__void").join(named, same, "left_semi")


def keyed_replace(df: DataFrame, path: str, keys: list[str], scope: DataFrame | None = None, bucket_rows: int | None = None, schema: StructType | None = None, covers: bool = False, stored: bool = False) -> int:
    """Delete the keys in df (and in scope: keys that were processed even if no row is left), then insert df. Returns the rows of df. covers: scope holds all keys of df, which are not looked for again. stored: df lies in files of its own or in a cache, and is not written once more beside the table."""
    if not keys:
        raise ValueError("keys are needed")
    df, n = (df, df.count()) if stored else staged(df, path)
    gone = df.select(*keys) if scope is None else scope.select(*keys) if covers else df.select(*keys).unionByName(scope.select(*keys))
    gone = gone.distinct()
    named, same = named_as(keys, gone)
    _rewrite(df.sparkSession, path, keys, gone, n, lambda old: old.join(named, same, "left_anti").unionByName(df), bucket_rows, schema=schema)
    return n


def upsert(df: DataFrame, path: str, keys: list[str], update_cols: list[str] | None = None, bucket_rows: int | None = None) -> None:
    """Rows with a known key update the given columns (all by default), others are inserted."""
    df, n = staged(df, path)
    _rewrite(df.sparkSession, path, keys, df, n, lambda old: merged(old, df, keys, update_cols), bucket_rows)


def merged(old: DataFrame, new: DataFrame, keys: list[str], update_cols: list[str] | None = None) -> DataFrame:
    """The result of an upsert as a frame: a full join in which new values win, nulls included."""
    if not keys:
        raise ValueError("keys are needed")
    rest = [c for c in old.columns if c not in keys]
    update = set(rest if update_cols is None else update_cols)
    a = old.select(*keys, F.lit(True).alias("__old"), *[F.col(c).alias(f"__a_{c}") for c in rest])
    b = new.select(*keys, F.lit(True).alias("__new"), *[F.col(c).alias(f"__b_{c}") for c in rest if c in new.columns])
    value = lambda c: F.when(F.col("__new") & (F.col("__old").isNull() | F.lit(c in update)), F.col(f"__b_{c}")).otherwise(F.col(f"__a_{c}")) if c in new.columns else F.col(f"__a_{c}")
    return a.join(b, keys, "full").select(*[F.col(c) if c in keys else value(c).alias(c) for c in old.columns])


def purge_before(spark: SparkSession, folder: str, names: list[str], day: str, out: str, column: str = "_snapshot_date") -> dict[str, int]:
    """Rows of each table from that day on, written as a new version of it."""
    return {n: full_refresh(spark.read.parquet(f"{folder}/{n}").where(F.col(column) >= F.lit(day)), f"{out}/{n}", [column]) for n in names}


#: Rows of a file of a laid-out table.
FILE_ROWS = 1_000_000
#: Partition columns out of others: the transforms that a layout can name.
TRANSFORMS = {
    "identity": lambda c, _: c,
    "year": lambda c, _: F.year(c),
    "month": lambda c, _: F.date_format(c, "yyyy-MM"),
    "day": lambda c, _: c.cast("date"),
    "bucket": lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int"),
    "truncate": lambda c, n: F.substring(c.cast("string"), 1, n),
}


@dataclass(frozen=True)
class Layout:
    """How a table lies: partition columns as (name, transform, source column, width), and the order of rows in and over the files of a partition."""

    partition: tuple[tuple[str, str, str, int | None], ...]
    order: tuple[str, ...] = ()

    def names(self) -> list[str]:
        return [name for name, *_ in self.partition]

    def with_partitions(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: TRANSFORMS[kind](F.col(source), width) for name, kind, source, width in self.partition})


def by(*columns: str, order: tuple[str, ...] = ()) -> Layout:
    """Identity partitions."""
    return Layout(tuple((c, "identity", c, None) for c in columns), order)


def laid_out(df: DataFrame, partition_by: list[str], order_by: list[str], file_rows: int = FILE_ROWS) -> DataFrame:
    """df dealt to files of about file_rows rows: ranges of (partition, order) that Spark cuts at sampled quantiles.

    A partition value with many rows is cut into many ranges, each a task and a file of its own, which follow each other in order, so
    their statistics prune; small values share a task. One value never waits for a single writer.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*partition_by, *order_by)]
    ranges = max(1, -(-df.count() // file_rows))
    return df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)


def write_laid_out(df: DataFrame, path: str, layout: Layout, file_rows: int = FILE_ROWS, overwrite_touched: bool = False) -> int:
    """Write df as its layout says: all of the table, or only the partitions that df holds."""
    rows = laid_out(layout.with_partitions(df), layout.names(), list(layout.order), file_rows)
    return (overwrite_partitions if overwrite_touched else full_refresh)(rows, path, layout.names())


def export(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    return {n: full_refresh(df, f"{folder.rstrip('/')}/{n}") for n, df in tables.items()}


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
