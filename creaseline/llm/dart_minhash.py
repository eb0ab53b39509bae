"""Operator 9: MinHash near-dedup with DartMinHash signatures.

A document is the weighted set of its five-word shingles (weight: number of occurrences). Each element owns a plane
of weight x rank in which darts lie with unit density; where they lie depends only on the element. The plane is cut
into unit cells; a hash of (element, weight cell, rank cell) says how many darts a cell holds (Poisson, mean 1) and
others give each dart's rank and coordinate. A document of total weight W throws the darts below its weights and
below rank t / W, about t in all, and keeps the earliest of each coordinate: two documents agree in a coordinate
with the probability of their weighted Jaccard similarity. If a coordinate stays empty, t is doubled.

Then, all in Spark: documents with equal weighted sets collapse into one node; bands of the signatures are joined;
every node of a band bucket is verified exactly against the bucket's pivot (the node met most often in buckets);
links give components. In buckets that hold more than one component, nodes that cannot have a further link go: a
node shares with any other at most those of its elements that occur in a second open node, which bounds the size of
a partner. Then every pair from different components is verified that the bounds admit: two nodes share at most the
smaller of their overlaps with the pivot, and the smaller number of further elements that others hold. So no link is
lost to the choice of pivots. Pairs within a component are never needed, and copies are never expanded.

With `bands` x `rows` = 28 x 4, a pair of similarity 0.8 shares no bucket with probability 4e-7.

The text of each node that shares a bucket is looked up once, by a hash of its row, and written for all that follows;
rows without a doc_id have hashes of their own, so no key is common to them.

Defined results: texts of one to four words are one shingle; null texts and texts without words are alone in their
class; repeated rows are exact copies; a null doc_id can be in a class but gives it no id unless all its ids are
null (then the id is null, but `classes` still tells such classes apart); other columns do not matter; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.llm.blocks import U64, WordHashes, as_bytes, cut, hash_words, mix, modest_batches, rabin_karp, row_key, scaled, tidy
from creaseline.llm.components import spread_labels

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 4
LAST = np.iinfo(np.int64).max
NO_DART = np.iinfo(np.uint64).max
#: Members verified against one copy of a pivot's text.
MEMBERS = 200
#: Cumulative Poisson(1) probabilities as 64-bit thresholds.
POISSON = np.array([min(int(sum(np.exp(-1.0) / np.prod(range(1, i + 1), initial=1.0) for i in range(n + 1)) * 2**64), 2**64 - 1) for n in range(12)], U64)
CELL, RANK_CELL, DART = U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB)

cache = WordHashes()


def elements(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """One sorted 64-bit id for each (shingle, occurrence): the unit weight cells of the weighted set."""
    h = hash_words(text.split(), cache)
    if not len(h):
        return h
    s = np.sort(rabin_karp(h, min(width, len(h))))
    first = np.concatenate([[True], s[1:] != s[:-1]])
    at = np.arange(len(s))
    occurrence = at - np.maximum.accumulate(np.where(first, at, 0))
    return np.sort(mix(s + occurrence.astype(U64) * CELL))


def signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """DartMinHash signatures (documents x k): of each coordinate the rank of its earliest dart, as 20.44 fixed point."""
    out = np.full((len(sets), k), NO_DART, U64)
    throw = float(k) * (np.log(k) + 2)
    todo = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    while len(todo):
        weight = np.array([len(sets[i]) for i in todo])
        limit = np.minimum(throw / weight, 1e6)
        columns = np.ceil(limit).astype(np.int64)
        flat, doc = np.concatenate([sets[i] for i in todo]), np.repeat(np.arange(len(todo)), weight)
        bound = (limit * 2.0**44).astype(U64)
        own = np.full(len(todo) * k, NO_DART, U64)
        for j in range(int(columns.max())):
            if j:
                stay = columns[doc] > j
                flat, doc = flat[stay], doc[stay]
            cell = mix(flat + scaled(j + 1, RANK_CELL))
            count = np.searchsorted(POISSON, cell, "right")
            for i in range(int(count.max(initial=0))):
                at = np.flatnonzero(count > i)
                dart = mix(cell[at] + scaled(i + 1, DART))
                rank = (dart >> U64(20)) + (U64(j) << U64(44))
                near = rank < bound[doc[at]]
                dart, rank, at = dart[near], rank[near], at[near]
                np.minimum.at(own, doc[at] * k + (mix(dart) % U64(k)).astype(np.int64), rank)
        own = own.reshape(-1, k)
        out[todo] = own
        todo = todo[(own == NO_DART).any(axis=1)]
        throw *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(signature), bands), U64)
    for r in range(rows):
        out = mix(out + signature[:, r::rows][:, :bands] + scaled(r + 1, CELL))
    return mix(out + np.arange(1, bands + 1, dtype=U64) * DART).view(np.int64)


def fingerprint(cells: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(cells.tobytes())


def sketch(docs: DataFrame, bands: int, rows: int, width: int) -> DataFrame:
    """doc_id, row_key, fp (equal for equal weighted sets, null without words), size (total weight), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                sets = [elements(t, width) for t in as_bytes(b.column(2))]
                keys = band_keys(signatures(sets, bands * rows), bands, rows)
                fps = [fingerprint(s) if len(s) else None for s in sets]
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), listed], names=["doc_id", "row_key", "fp", "size", "bands"])
        tidy(cache)

    return docs.select("doc_id", "row_key", "text").mapInArrow(run, "doc_id long, row_key long, fp binary, size long, bands array<long>")


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """fp, text of the given nodes (fp, row_key), each at most once a task."""
    rows = docs.select("row_key", "text").join(nodes.select("row_key", "fp"), "row_key").select("fp", "text")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[bytes, int]] = set()
        for b in batches:
            fresh = []
            for i, both in enumerate(zip(b.column(0).to_pylist(), map(xxhash.xxh3_64_intdigest, as_bytes(b.column(1))), strict=True)):
                if both not in seen:
                    seen.add(both)
                    fresh.append(i)
            yield b if len(fresh) == b.num_rows else b.take(pa.array(fresh, pa.int64()))

    return cut(rows.mapInArrow(once, "fp binary, text string"))


def overlaps(texts: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """For each pair (pivot, fp): both, the weight that the two whole texts share, and joint, the weight of their union.

    The members of a pivot are dealt to groups of about MEMBERS, each with its own copy of the pivot's text.
    """
    large = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("deals")).where("deals > 1")
    dealt = pairs.join(cut(large), "pivot", "left").withColumn("deal", F.pmod(F.xxhash64("fp"), F.coalesce("deals", F.lit(1))))
    role = lambda who, member: F.struct(F.col(who).alias("fp"), F.lit(member).alias("member"))
    roles = dealt.select("pivot", "deal", F.explode(F.array(role("pivot", 0), role("fp", 1))).alias("r")).distinct()
    rows = roles.select("pivot", "deal", "r.fp", "r.member").join(texts, "fp").select("pivot", "deal", "member", "fp", "text")
    rows = rows.repartition("pivot", "deal").sortWithinPartitions("pivot", "deal", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cells = None, np.zeros(0, U64)
        for b in batches:
            out: list[tuple] = []
            for pivot, deal, member, fp, text in zip(*(b.column(i).to_pylist() for i in range(4)), as_bytes(b.column(4)), strict=True):
                own = elements(text, width)
                if fingerprint(own) != fp:  # another row whose row_key is equal by chance
                    continue
                if not member:
                    now, cells = (pivot, deal), own
                elif now == (pivot, deal):
                    at = np.minimum(np.searchsorted(cells, own), len(cells) - 1)
                    both = int((cells[at] == own).sum())
                    out.append((pivot, fp, both, len(cells) + len(own) - both))
            columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.binary(), pa.binary(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["pivot", "fp", "both", "joint"])
        tidy(cache)

    return rows.mapInArrow(run, "pivot binary, fp binary, both long, joint long").distinct()


def partner_limits(texts: DataFrame, nodes: DataFrame, open_: DataFrame, similarity: float, width: int) -> DataFrame:
    """fp, size, shared (the weight that a second open node or pivot holds too) and reach: the largest size of a partner.

    A pair of sizes x and y and similarity s needs an overlap of (x + y) * s / (1 + s).
    """
    wanted = cut(open_.select("fp").unionByName(open_.select(F.col("pivot").alias("fp"))).distinct().join(nodes.select("fp", "size"), "fp"))
    rows = texts.join(wanted.select("fp"), "fp", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                sets = [elements(t, width) for t in as_bytes(b.column(1))]
                right = [len(s) > 0 and fingerprint(s) == fp for s, fp in zip(sets, b.column(0).to_pylist(), strict=True)]
                sets = [s if r else s[:0] for s, r in zip(sets, right, strict=True)]
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), b.column(0).take(pa.array(owner))], names=["element", "fp"])
        tidy(cache)

    held = rows.mapInArrow(run, "element long, fp binary").groupBy("element")
    alone = held.agg(F.min("fp").alias("fp"), F.max("fp").alias("other")).where("fp = other").groupBy("fp").agg(F.count(F.lit(1)).alias("alone"))
    shared = F.col("size") - F.coalesce("alone", F.lit(0))
    return cut(wanted.join(alone, "fp", "left").select("fp", "size", shared.alias("shared"), (F.floor(shared * (1 + similarity) / similarity + 1e-6) - F.col("size")).alias("reach")))


def several_labels(open_: DataFrame) -> DataFrame:
    """Rows of buckets that hold nodes of more than one component."""
    keys = open_.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    return cut(open_.join(cut(keys), "key"))


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row_key (see blocks.row_key) and label of each row of docs: label is the same for all rows of a class, null without words."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    modest_batches(docs)
    docs = docs.withColumn("row_key", row_key("doc_id", "text"))
    sketched = cut(sketch(docs, bands, rows, width))
    nodes = sketched.where(F.col("fp").isNotNull()).groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(LAST))).alias("least"), F.min("row_key").alias("row_key"), F.max("size").alias("size"), F.first("bands").alias("bands"))
    nodes = cut(nodes)
    placed = nodes.select("fp", F.explode("bands").alias("key"))
    sizes = cut(placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    open_ = placed.join(sizes, "key")  # buckets of several nodes
    open_ = cut(open_.select("key", "fp", F.sum("n").over(W.partitionBy("fp")).alias("met")))
    labels = nodes.select("fp", F.struct("least", "fp").alias("label"))
    texts = texts_of(docs, open_.select("fp").distinct().join(nodes.select("fp", "row_key"), "fp"))

    def linked(found: DataFrame) -> DataFrame:
        return found.where(F.col("both") >= similarity * F.col("joint")).select(F.col("pivot").alias("a"), F.col("fp").alias("b"))

    best = open_.groupBy("key").agg(F.max(F.struct("met", "fp")).alias("best"))
    met = cut(open_.join(cut(best.select("key", F.col("best.fp").alias("pivot"))), "key").where("pivot != fp").select("key", "fp", "pivot"))
    found = cut(overlaps(texts, met.select("pivot", "fp").distinct(), width))
    links = linked(found)
    labels = spread_labels(labels, links, "fp")
    open_ = several_labels(met.join(labels, "fp"))  # without the pivots: each has met its whole bucket
    if not open_.isEmpty():
        limits = partner_limits(texts, nodes, open_, similarity, width)
        open_ = cut(open_.join(limits, "fp").join(found.select("pivot", "fp", F.col("both").alias("near")), ["pivot", "fp"]).drop("pivot"))
        least = cut(open_.groupBy("key").agg(F.min("size").alias("smallest")))
        open_ = several_labels(open_.join(least, "key").where("reach >= smallest").drop("smallest"))  # the rest needs a smaller partner than there is
        ends = ("fp", "label", "size", "shared", "near", "keys")
        open_ = open_.withColumn("keys", F.collect_set("key").over(W.partitionBy("fp")))  # at most one a band
        other = open_.select(F.col("key").alias("key2"), *(F.col(c).alias(f"{c}_") for c in ends))
        bound = F.least("near", "near_") + F.least(F.col("shared") - F.col("near"), F.col("shared_") - F.col("near_"))
        admits = bound * (1 + similarity) + 1e-6 >= similarity * (F.col("size") + F.col("size_"))
        once = F.array_min(F.array_intersect("keys", "keys_")) == F.col("key")  # of the buckets that a pair shares
        pairs = open_.join(other, (F.col("key") == F.col("key2")) & (F.col("fp_") < F.col("fp")) & (F.col("label_") != F.col("label")) & admits & once)
        found = cut(overlaps(texts, cut(pairs.select(F.col("fp_").alias("pivot"), "fp")), width))
        labels = spread_labels(labels, links.unionByName(linked(found)), "fp")
    return sketched.select("doc_id", "row_key", "fp").join(labels, "fp", "left").select("doc_id", "row_key", "label")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id; class_id, the smallest doc_id of its class of near-duplicates; row_key, and class_key, equal for all rows of a class.

    Rows without a doc_id are told apart by row_key and their classes by class_key (a row without words is its own class); class_id is null if no
    row of the class has a doc_id.
    """
    out = classes(docs, similarity, bands, rows, width, id_col, text_col)
    own = F.when(F.col("label.least") != LAST, F.col("label.least"))
    return out.select("doc_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(own).alias("class_id"), "row_key", F.when(F.col("label").isNull(), F.hex("row_key")).otherwise(F.hex("label.fp")).alias("class_key"))
