"""Operator 1: substring dedup by Rabin-Karp hashes of every fixed-length word window.

Documents are dealt to chunks in order of doc_id, so that "a smaller doc_id" means a chunk of lower rank or an earlier
document of the same chunk. Each chunk hashes all its windows (rolling polynomial hashes, flat numpy arrays) and
sends each distinct hash once to the bucket that a second, independent hash names: a repeated window costs one
entry per chunk, however often the chunk holds it. Buckets count hashes over chunks and send back one bit per entry:
set if a chunk of lower rank has the hash. Chunks then merge covered windows into maximal removal intervals.

Chunks: at most INTERVALS quantiles of doc_id divide it; each interval gets as many chunks as its bytes need, at
places interpolated between its ends. A doc_id whose rows alone exceed a chunk (or all rows without one) is an interval of
its own, whose chunks share a rank and are dealt by text: rows of one doc_id do not remove each other's words. Equal
rows that exceed a chunk are handled once and returned as often as they occur.

Shuffled: the text once (the plan reuses that exchange), 8 bytes per distinct window of a chunk, and bits; a row goes
only to a bucket for which the chunk has windows, so rows never outnumber windows. Buckets and chunks grow in number with
the input, not in size. Two windows count as equal if 64 bits of one hash and the bucket bits of another agree; for n
windows in B buckets false matches are expected below n*n / (B * 2**65).

Defined results: null and empty texts have no words; texts of fewer than `width` words lose nothing; rows that
share a doc_id do not remove each other's words; a null doc_id counts as larger than all others; an empty table
gives an empty result; other columns of docs do not matter.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.blocks import U64, WordHashes, all_copies, as_bytes, cut, hash_words, mix, offsets, once_each, rabin_karp, starts_inside, tidy

WIDTH = 13
CHUNK_BYTES = 6_000_000
#: A row counts as so many bytes more, for its arrays.
ROW_BYTES = 1_500
#: Quantiles of doc_id that are asked for; a fixed bound.
INTERVALS = 2_000
BUCKET_WINDOWS = 1_500_000
LAST = np.iinfo(np.int64).max
SECOND_BASE = 0x2545F4914F6CDD1D

cache = WordHashes()


class Chunk:
    """The documents of one chunk, in order of doc_id, as flat arrays."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        ids = table.column("doc_id").to_numpy(zero_copy_only=False) if not table.column("doc_id").null_count else np.array([LAST if x is None else x for x in table.column("doc_id").to_pylist()])
        order = np.argsort(ids, kind="stable")
        table = table.take(pa.array(order))
        self.ids, self.real_ids, self.copies = ids[order].astype(np.int64), table.column("doc_id"), table.column("n")
        self.words = [t.split() for t in as_bytes(table.column("text"))]
        self.doc = offsets([len(w) for w in self.words])
        flat = np.concatenate([hash_words(w, cache) for w in self.words]) if self.words else np.zeros(0, U64)
        inside = starts_inside(self.doc, width, len(flat))
        self.start = np.flatnonzero(inside)
        self.hash = rabin_karp(flat, width)[inside]
        self.distinct, first, self.inverse = np.unique(self.hash, return_index=True, return_inverse=True)
        second = rabin_karp(mix(flat), width, SECOND_BASE)[inside]
        self.bucket = (second[first] >> U64(64 - buckets.bit_length() + 1)).astype(np.int64) if buckets > 1 else np.zeros(len(first), np.int64)
        # entries sorted by bucket, then hash: the order in which buckets answer
        self.sent = np.argsort(self.bucket, kind="stable")
        self.of = np.repeat(self.ids, np.diff(self.doc))[self.start] if len(self.start) else np.zeros(0, np.int64)


@dataclass
class Plan:
    """Chunks of each interval (edges[i - 1], edges[i]] of doc_id, from number first[i] on."""

    edges: np.ndarray
    deals: np.ndarray
    first: np.ndarray
    alone: np.ndarray  # the interval is one doc_id
    chunks: int
    buckets: int

    def of(self, ids: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """The chunk of each row."""
        at = np.searchsorted(self.edges, ids, "left")
        low = np.concatenate([[self.edges[0] - 1], self.edges])[at].astype(np.float64)
        high = np.concatenate([self.edges, [LAST]])[at].astype(np.float64)
        share = np.clip((ids - low) / np.maximum(high - low, 1), 0, 1 - 1e-9)
        ordered = np.minimum((share * self.deals[at]).astype(np.int64), self.deals[at] - 1)
        return self.first[at] + np.where(self.alone[at], (salt % self.deals[at].astype(U64)).astype(np.int64), ordered)

    def rank(self, chunks: np.ndarray) -> np.ndarray:
        """What orders chunks: their number, but the first number of its interval for one doc_id."""
        at = np.searchsorted(self.first, chunks, "right") - 1
        return np.where(self.alone[at], self.first[at], chunks)


def plan_chunks(docs: DataFrame) -> Plan:
    """The chunks for docs (id, bytes), from three aggregates; what comes to the driver is bounded by INTERVALS and by ids that exceed a chunk."""
    size = F.col("bytes") + ROW_BYTES
    real = F.when(F.col("id") < LAST, F.col("id"))
    n, whole, text, least, most = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0)), F.min(real), F.max(real)).first()
    buckets = 1 << max(6, int(text // 6 // BUCKET_WINDOWS).bit_length())
    wanted = min(INTERVALS, -(-whole // CHUNK_BYTES))
    heavy = [r["id"] for r in docs.groupBy("id").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > CHUNK_BYTES).select("id").collect()]
    edges = {e for h in heavy for e in (h - 1, h)} | ({least - 1, most} if n and least is not None else {0})
    if wanted > 1:
        edges |= set(docs.agg(F.percentile_approx("id", F.array(*[F.lit(k / wanted) for k in range(1, wanted)]), 10 * wanted)).first()[0] or [])
    edges = np.array(sorted(edges), np.int64)
    alone = np.isin(np.append(edges, LAST), heavy)

    @F.pandas_udf("int")
    def interval(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(np.int64), "left").astype(np.int32))

    deals = np.ones(len(edges) + 1, np.int64)
    for r in docs.groupBy(interval("id").alias("i")).agg(F.sum(size).alias("bytes")).collect():  # a row for each interval
        deals[r["i"]] = max(1, -(-r["bytes"] // CHUNK_BYTES))
    return Plan(edges, deals, np.cumsum(deals) - deals, alone, int(deals.sum()), buckets)


def substring_dedup(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans; with_text adds kept_text and spans (word intervals, end exclusive)."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = once_each(docs, CHUNK_BYTES)
    order = F.coalesce("doc_id", F.lit(LAST))
    plan = plan_chunks(cut(docs.select(order.alias("id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))))
    buckets = plan.buckets

    @F.pandas_udf("long")
    def chunk_of(ids: pd.Series, salt: pd.Series) -> pd.Series:
        return pd.Series(plan.of(ids.to_numpy(np.int64), salt.to_numpy(np.int64).view(U64)))

    def send(key: tuple, table: pa.Table) -> pa.Table:
        c = Chunk(table, width, buckets)
        h, b = c.distinct[c.sent], c.bucket[c.sent]
        own = np.unique(b)
        at = np.append(np.searchsorted(b, own), len(b))
        tidy(cache)
        return pa.table({"bucket": pa.array(own, pa.int64()), "chunk": pa.array([key[0].as_py()] * len(own), pa.int64()), "hashes": pa.array([h[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())})

    def count(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        parts = [np.frombuffer(x, U64) for x in table.column("hashes").to_pylist()]
        h = np.concatenate(parts)
        rank = np.repeat(plan.rank(table.column("chunk").to_numpy()), [len(p) for p in parts])
        order = np.argsort(h, kind="stable")  # runs are sorted already, and earlier chunks stay in front
        h, rank = h[order], rank[order]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        seen = np.zeros(len(h), bool)
        seen[order] = rank > rank[np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))]
        at = offsets([len(p) for p in parts])
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "seen": pa.array([np.packbits(seen[i:j]).tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())})

    def remove(key: tuple, table: pa.Table, marks: pa.Table) -> pa.Table:
        c = Chunk(table, width, buckets)
        sizes = np.bincount(c.bucket, minlength=buckets)
        seen = np.zeros(len(c.distinct), bool)
        bits = {b: x for b, x in zip(marks.column("bucket").to_pylist(), marks.column("seen").to_pylist(), strict=True)}
        if len(c.distinct):
            seen[c.sent] = np.concatenate([np.unpackbits(np.frombuffer(bits[b], np.uint8), count=int(sizes[b])) for b in np.flatnonzero(sizes).tolist()]).astype(bool)
        least = np.full(len(c.distinct), LAST, np.int64)
        np.minimum.at(least, c.inverse, c.of)
        start = c.start[seen[c.inverse] | (least[c.inverse] < c.of)]
        edge = np.zeros(c.doc[-1] + width + 1, np.int32)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + width, -1)
        covered = np.cumsum(edge)[: c.doc[-1]] > 0
        out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "n_spans", "kept_text", "spans")}
        for words, a, z in zip(c.words, c.doc[:-1], c.doc[1:], strict=True):
            gone = covered[a:z]
            n = int(gone.sum())
            text = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if n else words)
            turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            values = (z - a, n, hashlib.sha256(text).hexdigest(), len(turn) // 2, text.decode("utf-8", "replace") if with_text else None, turn.reshape(-1, 2).tolist() if with_text else None)
            for k, x in zip(out, values, strict=True):
                out[k].append(x)
        tidy(cache)
        kept = ["n_words", "n_removed", "kept_sha256", "n_spans", *(("kept_text", "spans") if with_text else ())]
        return pa.table({"doc_id": c.real_ids, "n": c.copies, **{k: pa.array(out[k], kinds[k]) for k in kept}})

    kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "n_spans": pa.int64(), "kept_text": pa.string(), "spans": pa.list_(pa.list_(pa.int64()))}
    dealt = docs.withColumn("chunk", chunk_of(order, F.xxhash64("text"))).repartition(plan.chunks, "chunk")
    sent = dealt.groupBy("chunk").applyInArrow(send, "bucket long, chunk long, hashes binary")
    marks = sent.groupBy("bucket").applyInArrow(count, "chunk long, bucket long, seen binary")
    schema = "doc_id long, n long, n_words long, n_removed long, kept_sha256 string, n_spans long" + ", kept_text string, spans array<array<long>>" * with_text
    return all_copies(dealt.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(remove, schema))
