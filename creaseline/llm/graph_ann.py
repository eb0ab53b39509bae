"""Operator 4: approximate nearest neighbours on robust-pruned directed graphs, one for each shard.

Equal vectors are one point with its smallest ids, so no vector can be hot. Points are dealt to shards by length (bands
of 5 %, which inner products need: long points would hide short ones in one graph) and then by a hash of the id, about
SHARD_POINTS in each. A shard inserts its points in growing batches: a greedy beam search from the entry
point proposes neighbours, relaxed distance pruning (a candidate goes if a kept one is closer to it by the factor
RELAX) keeps diverse edges, and reverse edges are pruned the same way. Largest inner product becomes smallest
distance by one more coordinate that makes all points equally long. Each block of queries then searches each shard's
graph with a beam; the blocks' results meet in a top-k window, which Spark limits before the shuffle. Scores are
computed again in double precision on the original vectors.

All rows are indexed and nothing is sampled. All shards are searched, since vectors without clusters leave no shard
out; the work for a query grows with the number of shards, not of vectors.

Defined results: a vector takes no part if it or its id is null, if it is zero, holds null or non-finite components or
has not the most frequent length (ties: the smaller one); of rows that share an id the smallest vector counts;
fewer than k candidates give fewer rows; equal scores rank by smaller vec_id; other columns do not matter; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.llm.blocks import cut

SHARD_POINTS = 8_000
QUERY_BLOCK = 4_096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 144
RELAX = 1.2
BATCH = 256
#: Beam members that one round expands.
EXPAND = 4


def beam_search(points: np.ndarray, graph: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the best points met and their scores (inner products), best first; -1 where there are fewer."""
    n, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((n, len(points) + 1), bool)
    seen[:, -1] = True  # the place of missing edges
    ids = np.full((n, beam), -1, np.int64)
    score = np.full((n, beam), -np.inf, np.float32)
    open_ = np.zeros((n, beam), bool)
    first = min(beam, len(entry))
    begin = queries @ points[entry].T
    top = np.argpartition(-begin, first - 1, axis=1)[:, :first] if first else np.zeros((n, 0), np.int64)
    ids[:, :first] = entry[top]
    score[:, :first] = np.take_along_axis(begin, top, 1)
    open_[:, :first] = True
    seen[:, entry] = True
    active = np.arange(n)
    while len(active):
        waiting = np.where(open_[active], score[active], -np.inf)
        pick = np.argpartition(-waiting, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND]
        good = np.take_along_axis(waiting, pick, 1) > -np.inf
        live = good.any(1)
        active, pick, good = active[live], pick[live], good[live]
        if not len(active):
            break
        own = np.where(good, np.take_along_axis(ids[active], pick, 1), len(points))
        open_[active[:, None], pick] = False
        near = graph[own].reshape(len(active), -1)
        fresh = ~seen[active[:, None], near]
        near = np.where(fresh, near, len(points))
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = len(points)
        seen[active[:, None], near] = True
        real = near < len(points)
        where = np.flatnonzero(real)
        s = np.full(near.size, -np.inf, np.float32)
        s[where] = np.einsum("ij,ij->i", points[near.ravel()[where]], queries[active[where // near.shape[1]]])
        all_s = np.concatenate([score[active], s.reshape(near.shape)], 1)
        all_i = np.concatenate([ids[active], near], 1)
        all_o = np.concatenate([open_[active], real], 1)
        keep = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
        score[active], ids[active], open_[active] = (np.take_along_axis(x, keep, 1) for x in (all_s, all_i, all_o))
    order = np.argsort(-score, axis=1, kind="stable")
    score, ids = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)
    return np.where(score > -np.inf, ids, -1), score


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Edges of each point of `own` out of its candidates (-1: none), at most DEGREE, missing ones as len(points)."""
    none = len(points)
    c = np.where(candidates == own[:, None], -1, candidates)
    valid = c >= 0
    vectors = points[np.where(valid, c, 0)]
    away = np.where(valid, ((vectors - points[own][:, None]) ** 2).sum(2), np.inf)
    order = np.argsort(away, axis=1, kind="stable")
    c, away, vectors = np.take_along_axis(c, order, 1), np.take_along_axis(away, order, 1), np.take_along_axis(vectors, order[:, :, None], 1)
    between = 2 * points[own][0] @ points[own][0] - 2 * np.einsum("bij,bkj->bik", vectors, vectors)  # all points have one length
    alive = np.isfinite(away)
    out = np.full((len(own), DEGREE), none, np.int64)
    rows = np.arange(len(own))
    for k in range(DEGREE):
        at = alive.argmax(1)
        live = alive[rows, at]
        if not live.any():
            break
        out[live, k] = c[rows, at][live]
        alive &= ~((RELAX * between[rows, at] <= away) & live[:, None])
        alive[rows, at] = False
    return out


def build(points: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Graph (points + 1 rows, the last one without edges) and entry points. Points are equally long."""
    n = len(points)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    graph = np.full((n + 1, DEGREE), n, np.int64)
    entry = order[: min(n, 8)]
    done = min(n, DEGREE)
    start = order[:done]
    graph[start] = robust_prune(points, start, np.tile(start, (done, 1))) if done else graph[start]
    while done < n:
        own = order[done : done + min(BATCH, done)]
        met, _ = beam_search(points, graph, points[own], entry, BUILD_BEAM)
        graph[own] = robust_prune(points, own, met)
        source, target = np.repeat(own, DEGREE), graph[own].ravel()
        source, target = source[target < n], target[target < n]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        ends, first, count = np.unique(target, return_index=True, return_counts=True)
        more = np.full((len(ends), int(count.max(initial=0))), -1, np.int64)
        more[np.repeat(np.arange(len(ends)), count), np.arange(len(target)) - np.repeat(first, count)] = source
        free = DEGREE - (graph[ends] < n).sum(1)
        for roomy in (True, False):
            some = (count <= free) == roomy
            if not some.any():
                continue
            both = np.concatenate([np.where(graph[ends[some]] < n, graph[ends[some]], -1), more[some]], 1)
            if roomy:
                both = -np.sort(-both, axis=1)[:, :DEGREE]
                graph[ends[some]] = np.where(both >= 0, both, n)
            else:
                for part in np.array_split(np.arange(len(both)), max(1, len(both) // 512)):
                    graph[ends[some][part]] = robust_prune(points, ends[some][part], both[part])
        done += len(own)
    reached = np.bincount(graph.ravel(), minlength=n + 1)[:n] > 0
    return graph, np.union1d(entry, np.flatnonzero(~reached))  # points that lost all edges to them are entries


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """One more coordinate that makes all vectors as long as the longest."""
    square = (vectors.astype(np.float64) ** 2).sum(1)
    more = np.sqrt(np.maximum(square.max(initial=0) - square, 0))
    return np.concatenate([vectors, more[:, None]], 1).astype(np.float32)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in column.chunks]).reshape(-1, width).astype(np.float64) if len(column) else np.zeros((0, width))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Rows (id, v) that take part, one for each id, and their length."""
    v = F.col("v")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    sizes = sorted(rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: (-r["n"], r["d"]))
    width = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("v") == width).groupBy("id").agg(F.min("v").alias("v")), width


def no_hits(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: F.Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for each row that is_query (an expression on `id`) admits."""
    rows, width = usable(vectors, id_col, vector_col)
    rows = cut(rows)
    place = F.row_number().over(W.partitionBy("v").orderBy("id"))
    few = rows.withColumn("place", place).where(F.col("place") <= k + 1)  # k others than the query itself
    points = cut(few.groupBy("v").agg(F.min("id").alias("point"), F.sort_array(F.collect_list("id")).alias("ids")))
    band = F.round(F.log(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))) / np.log(1.05)).cast("int")
    points = points.withColumn("band", band)
    # bands are bounded by the range of exponents, so this small table can be broadcast
    bands, shards = [], 0
    for r in points.groupBy("band").agg(F.count(F.lit(1)).alias("n")).orderBy("band").collect():
        bands.append((r["band"], shards, max(1, round(r["n"] / SHARD_POINTS))))
        shards += bands[-1][2]
    if not bands:
        return no_hits(rows)
    bands = rows.sparkSession.createDataFrame(bands, "band int, first int, deals int")
    queries = rows.where(is_query)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    dealt = (F.col("first") + F.pmod(F.xxhash64("point"), F.col("deals"))).cast("long")
    placed = points.join(F.broadcast(bands), "band").select(dealt.alias("shard"), "point", "v")

    def index(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("point")
        original = matrix(table.column("v"), width)
        graph, entry = build(lengthened(original), int(key[0].as_py()))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "points": pa.array([table.column("point").to_numpy().tobytes()], pa.binary()), "vectors": pa.array([original.tobytes()], pa.binary()), "graph": pa.array([graph.astype(np.int32).tobytes()], pa.binary()), "entry": pa.array([entry.tobytes()], pa.binary())})

    built = cut(placed.repartition(shards, "shard").groupBy("shard").applyInArrow(index, "shard long, points binary, vectors binary, graph binary, entry binary"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asked = queries.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), "id", "v").withColumn("shard", every(shards))
    copies = built.withColumn("block", every(blocks))

    def search(key: tuple, asking: pa.Table, graphs: pa.Table) -> pa.Table:
        q = matrix(asking.column("v"), width)
        out_q, out_p, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(q) and graphs.num_rows:
            row = {c: graphs.column(c)[0].as_py() for c in graphs.column_names}
            ids = np.frombuffer(row["points"], np.int64)
            original = np.frombuffer(row["vectors"]).reshape(-1, width)
            graph = np.frombuffer(row["graph"], np.int32).reshape(-1, DEGREE).astype(np.int64)
            longer, entry, asked_by = lengthened(original), np.frombuffer(row["entry"], np.int64), asking.column("id").to_numpy()
            take = k + 1
            for part in np.array_split(np.arange(len(q)), max(1, len(q) // 512)):
                flat = np.concatenate([q[part], np.zeros((len(part), 1))], 1).astype(np.float32)
                met, _ = beam_search(longer, graph, flat, entry, max(SEARCH_BEAM, 2 * take))
                exact = np.where(met >= 0, np.einsum("bkj,bj->bk", original[met], q[part]), -np.inf)
                by = np.lexsort((np.where(met >= 0, ids[met], 0), -exact), axis=1)[:, :take]
                met, exact = np.take_along_axis(met, by, 1), np.take_along_axis(exact, by, 1)
                found = met >= 0
                out_q.append(np.repeat(asked_by[part], found.sum(1)))
                out_p.append(ids[met[found]])
                out_s.append(exact[found])
        return pa.table({"query_id": np.concatenate(out_q), "point": np.concatenate(out_p), "score": np.concatenate(out_s)})

    tasks = shards * blocks  # as many as there are pairs: a small table would leave them to a few
    spread = lambda df: df.repartition(tasks, "shard", "block").groupBy("shard", "block")
    found = spread(asked).cogroup(spread(copies)).applyInArrow(search, "query_id long, point long, score double")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "point")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    hits = found.join(points.select("point", "ids"), "point").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
    rank = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
