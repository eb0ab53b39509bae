"""Operator 11: k-means in integers, filtered by PCA-rotated coordinates.

Vectors become integers floor(SCALE * x). One pass gathers their second moments, whose principal axes give a rotation; a second
one writes each vector with its LEAD leading rotated coordinates and the norm of the rest. For a vector x and a centroid c the squared distance
is at least |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2, the norms of the rests being no further apart than the rests. An assignment takes
the exact distance to the centroid with the least bound and verifies, in 64-bit integers, every other one whose bound, less what rounding can
have added (SLACK), does not exceed it. The rotation thus never decides a result, only how many distances are computed.

A round is one pass over the stored vectors: each task sums up its vectors by cluster, Spark adds the sums (clusters x components rows, whatever
the corpus), and the driver floors the means. Equal vectors need no care, since no vector is shuffled.

Defined results: vectors of another length or with a null or non-finite component take no part, nor does a null vector; a row without an id takes
part, and its hash is that of the empty id; of centroid candidates with equal hashes (rows that share an id) the smaller vector comes first; fewer than k vectors are
all centroids; ties go to the smaller centroid number; empty clusters keep their centroid; other columns do not matter; an empty table gives an empty
result. Components beyond +-LARGEST / SCALE raise an error: squared distances would not fit 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.blocks import written

SCALE = 64
LARGEST = 1 << 27
#: Leading rotated coordinates that are stored.
LEAD = 12
#: Relative error of the bounds in doubles, generously.
SLACK = 1e-9


def quantised(vectors: DataFrame, dim: int, id_col: str, vector_col: str) -> DataFrame:
    """id and v: integer vectors of dim finite components."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where((F.size("v") == dim) & finite)
    whole = F.transform("v", lambda x: F.floor(x * SCALE))
    large = F.exists("v", lambda x: F.abs(x * SCALE) >= LARGEST)
    return rows.select("id", F.when(large, F.raise_error(F.lit(f"a component of {LARGEST // SCALE} or more has no 64-bit squared distance"))).otherwise(whole).cast("array<bigint>").alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def summed(df: DataFrame) -> list[tuple[int, int, int]]:
    """The sums of values by (cluster, place): at most as many rows as there are clusters x components."""
    rows = df.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    return [(r[0], r[1], int(r[2])) for r in rows]


def rotation(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and principal axes (columns, most variance first) of the integer vectors."""
    upper = np.triu_indices(dim)

    def moments(batches):
        first, second, n = np.zeros(dim), np.zeros((dim, dim)), 0
        for batch in batches:
            x = matrix(batch.column(0), dim).astype(float)
            first, second, n = first + x.sum(0), second + x.T @ x, n + len(x)
        if n:
            values = np.concatenate([[n], first, second[upper]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["place", "value"])

    sums = rows.select("v").mapInArrow(moments, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()  # one row a moment
    values = np.zeros(1 + dim + len(upper[0]))
    for r in sums:
        values[r[0]] = r[1]
    n = max(values[0], 1.0)
    mean, second = values[1 : dim + 1] / n, np.zeros((dim, dim))
    second[upper] = values[dim + 1 :] / n
    spread = second + np.triu(second, 1).T - np.outer(mean, mean)
    if not np.isfinite(spread).all():
        return mean, np.eye(dim)
    return mean, np.linalg.eigh(spread)[1][:, ::-1].copy()


def rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates and the norm of the others."""
    y = (x - mean) @ axes
    return y[:, :lead], np.sqrt((y[:, lead:] ** 2).sum(1))


def assign(v: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and exact squared distance of each vector, and how many distances were computed."""
    size = (lead**2).sum(1) + rest**2
    c_size = (c_lead**2).sum(1) + c_rest**2
    bound = (lead**2).sum(1)[:, None] - 2 * lead @ c_lead.T + (c_lead**2).sum(1) + (rest[:, None] - c_rest) ** 2
    bound -= SLACK * (size[:, None] + c_size) + 1e-6
    seed = bound.argmin(1)
    nearest, best, tried = seed.copy(), ((v - centroids[seed]) ** 2).sum(1), len(v)
    for c in range(len(centroids)):
        who = np.flatnonzero((bound[:, c] <= best) & (seed != c))
        d = ((v[who] - centroids[c]) ** 2).sum(1)
        better = (d < best[who]) | ((d == best[who]) & (c < nearest[who]))
        best[who[better]], nearest[who[better]] = d[better], c
        tried += len(who)
    return nearest, best, tried


class Clusters:
    """Centroids (integers) on stored, rotated vectors."""

    def __init__(self, stored: DataFrame, mean: np.ndarray, axes: np.ndarray, lead: int, centroids: list[list[int]]):
        self.stored, self.mean, self.axes, self.lead = stored, mean, axes, lead
        self.centroids = np.array(centroids, np.int64).reshape(-1, len(mean))

    def assigned(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        dim = len(self.mean)
        v = matrix(batch.column(1), dim)
        c_lead, c_rest = rotated(self.centroids.astype(float), self.mean, self.axes, self.lead)
        return v, *assign(v, matrix(batch.column(2), self.lead), batch.column(3).to_numpy(zero_copy_only=False), self.centroids, c_lead, c_rest)

    def sums(self, inertia_only: bool = False) -> DataFrame:
        """(cluster, place, value): place -1 counts vectors, -2 is the inertia, -3 counts distances, others are components."""
        k, dim = self.centroids.shape
        work = self.light()

        def partial(batches):
            total, places = [[0] * (dim + 3) for _ in range(k)], [*range(dim), -1, -2, -3]
            for batch in (b for b in batches if b.num_rows):
                v, cluster, distance, tried = work.assigned(batch)
                total[0][-1] += tried
                for c in np.unique(cluster):
                    own = cluster == c
                    if not inertia_only:
                        total[c][:dim] = [a + int(b) for a, b in zip(total[c], v[own].sum(0), strict=False)]
                    total[c][dim] += int(own.sum())
                    total[c][dim + 1] += sum(distance[own].tolist())
            rows = [(c, p, str(x)) for c in range(k) for p, x in zip(places, total[c], strict=True) if x]
            if rows:
                cluster, place, value = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(value)], names=["cluster", "place", "value"])

        return self.stored.mapInArrow(partial, "cluster int, place int, value string")

    def light(self) -> Clusters:
        """Without the frame, as tasks need it."""
        return Clusters(None, self.mean, self.axes, self.lead, self.centroids.tolist())

    def moved(self) -> Clusters:
        """After a round: non-empty centroids at the floor of their vectors' mean."""
        values = {(c, p): x for c, p, x in summed(self.sums())}
        new = self.centroids.tolist()
        for c in range(len(new)):
            if n := values.get((c, -1), 0):
                new[c] = [values.get((c, p), 0) // n for p in range(len(new[c]))]
        return Clusters(self.stored, self.mean, self.axes, self.lead, new)

    def members(self) -> DataFrame:
        """id, cluster, distance (squared) of every vector."""
        work = self.light()

        def rows(batches):
            for batch in (b for b in batches if b.num_rows):
                _, cluster, distance, _ = work.assigned(batch)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

        kind = self.stored.schema["id"].dataType.simpleString()
        return self.stored.mapInArrow(rows, f"id {kind}, cluster int, distance long")


def first_centroids(rows: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the smallest hashes of salt and id, in their order."""
    h = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in rows.select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()]


def cluster(vectors: DataFrame, dim: int, k: int, rounds: int, salt: str, id_col: str = "vec_id", vector_col: str = "embedding", lead: int = LEAD) -> Clusters:
    """k-means on integer vectors from the k vectors with the smallest hashes; the vectors are written once, rotated."""
    lead = min(lead, dim)
    rows = quantised(vectors, dim, id_col, vector_col)
    mean, axes = rotation(rows, dim)

    def rotate(batches):
        for batch in batches:
            first, rest = rotated(matrix(batch.column(1), dim).astype(float), mean, axes, lead)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, first.size + 1, lead, dtype=np.int32)), pa.array(np.ascontiguousarray(first).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), flat, pa.array(rest)], names=["id", "v", "lead", "rest"])

    kind = rows.schema["id"].dataType.simpleString()
    stored = written(rows.mapInArrow(rotate, f"id {kind}, v array<bigint>, lead array<double>, rest double"))
    found = Clusters(stored, mean, axes, lead, first_centroids(stored, k, salt))
    for _ in range(rounds if len(found.centroids) else 0):
        found = found.moved()
    return found


def digests(found: Clusters) -> list[str]:
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]


def members_with_inertia(found: Clusters) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector. Inertias beyond 64 bits are null."""
    own = {c: x for c, p, x in summed(found.sums(inertia_only=True)) if p == -2}
    spark, fits = found.stored.sparkSession, lambda x: x if x < 1 << 63 else None
    total = fits(sum(own.values()))
    about = spark.createDataFrame([(c, fits(own.get(c, 0)), total, h) for c, h in enumerate(digests(found))], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.members().join(F.broadcast(about), "cluster")  # a row for each centroid
