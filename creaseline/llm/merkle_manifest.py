"""Operator 12: a Merkle manifest of a dataset that keeps few levels and recomputes the others for proofs.

Leaves are digests of rows. In each group they ascend by an order column; every FAN consecutive nodes become one node until one
is left, the group's subroot; subroots, ordered by group, become the root in the same way. Rows are placed by one range
shuffle on (group, order, digest): counts of each partition and group are summed up, so a group of any size is spread over tasks.

Only every LEVELS-th level is written. A stored row is an aligned subtree: FAN ** LEVELS neighbours of a stored level, in one
array. `Manifest.proofs` goes from the root down: each stored subtree regenerates its missing interior nodes from what is stored, gives each
of its members the siblings on the way up, behind those that its own root has from above, and discards the nodes. A leaf's siblings are
pairs (left, right) of concatenated digests, lowest level first.

Defined results: null fields count as `-`; rows without a group are a group, the first; rows without an order value come first in
their group; equal order values ascend by leaf digest, so repeated rows are leaves of their own with their own proofs; the siblings of a lone leaf in
a lone group are none (the digest of no bytes); other columns do not matter; an empty table has no leaves and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.llm.blocks import modest_batches, written

FAN = 3
#: Levels from one stored level to the next.
LEVELS = 5
#: Stored subtrees that a task holds as Python objects at a time.
SUBTREES = 32
PATH = "array<struct<left:string,right:string>>"


def digest(*fields: Column) -> Column:
    """Hex sha256 of length-prefixed fields, `-` for null."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with __idx (place in their group, from 0) and __size (rows of their group)."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    at = F.monotonically_increasing_id()
    # equal rows are dealt out by where they come from, so they can be split over partitions too
    spread = rows.withColumn("__from", at).repartitionByRange(*keys, "__from").sortWithinPartitions(*keys)
    placed = written(spread.drop("__from").withColumn("__at", at).withColumn("__part", F.shiftright("__at", 33)))
    piles = placed.groupBy("__part", F.col(group).alias("__pile")).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    own = W.partitionBy("__pile")
    before = F.coalesce(F.sum("__n").over(own.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    piles = piles.select(F.col("__part").alias("__p"), "__pile", (before - F.col("__first")).alias("__shift"), F.sum("__n").over(own).alias("__size"))
    same = (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__pile"))
    return placed.join(piles, same).select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("__idx"), "__size")


def depth_of(size: Column) -> Column:
    """How often FAN nodes become one until one of `size` is left."""
    powers = [FAN**i for i in range(60) if FAN**i < 1 << 63]
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < size))


def interior(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a subtree by level, from the given ones up."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([hashlib.sha256("".join(below[i : i + FAN]).encode()).hexdigest() for i in range(0, len(below), FAN)])
    return out


def siblings(tree: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of a member's way up through a subtree, lowest level first."""
    out = []
    for nodes in tree[:-1]:
        run = at - at % FAN
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + FAN])))
        at //= FAN
    return out


def folded(node: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        node = hashlib.sha256((left + node + right).encode()).hexdigest()
    return node


PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


@dataclass
class Tree:
    """Stored levels of the trees of all groups: (level, rows __group, __depth, __block, nodes), lowest first, and each group's end (__group, __depth, subroot)."""

    levels: list[tuple[int, DataFrame]]
    tops: DataFrame


def grow(leaves: DataFrame, payload: list[str]) -> Tree:
    """Trees over leaves (__group, __depth, __idx, h and payload, which only the lowest stored level carries)."""
    wide, level, levels, tops = FAN**LEVELS, 0, [], []
    deepest = leaves.agg(F.max("__depth")).first()[0] or 0
    nodes = leaves
    while True:
        member = F.struct(F.expr(f"cast(__idx % {wide} as int)").alias("i"), "h", *(payload if not level else ()))
        blocks = written(nodes.groupBy("__group", "__depth", F.expr(f"__idx div {wide}").alias("__block")).agg(F.array_sort(F.collect_list(member)).alias("nodes")))
        levels.append((level, blocks))

        def climb(batches, level=level):
            for batch in batches:
                members, depths = batch.column(3), batch.column(1).to_pylist()
                roots = [interior(members[i].as_py(), min(LEVELS, d - level))[-1][0] for i, d in enumerate(depths)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(roots, pa.string())], names=["__group", "__depth", "__idx", "h"])

        kind = blocks.schema["__group"].dataType.simpleString()
        up = blocks.select("__group", "__depth", "__block", F.col("nodes.h").alias("nodes")).mapInArrow(climb, f"__group {kind}, __depth int, __idx long, h string")
        up = written(up)
        tops.append(up.where(F.col("__depth") <= level + LEVELS).select("__group", "__depth", F.col("h").alias("subroot")))
        level += LEVELS
        if deepest <= level:
            return Tree(levels, reduce(DataFrame.unionByName, tops))
        nodes = up.where(F.col("__depth") > level)


def regenerated(rows: DataFrame, level: int, row_of: Callable, fields: Callable[[pa.Schema], list], ddl: str) -> DataFrame:
    """row_of(subtree, place, member, path) for each member of each stored subtree: path are its siblings up to the root."""

    def run(batches):
        for batch in batches:
            schema = pa.schema(fields(batch.schema))
            for lo in range(0, batch.num_rows, SUBTREES):
                out = []
                for r in batch.slice(lo, SUBTREES).to_pylist():
                    above = [(s["left"], s["right"]) for s in r["path"]]
                    tree = interior([x["h"] for x in r["nodes"]], min(LEVELS, r["__depth"] - level))
                    out += [row_of(r, at, x, siblings(tree, at) + above) for at, x in enumerate(r["nodes"])]
                yield pa.RecordBatch.from_pylist(out, schema)

    return rows.mapInArrow(run, ddl)


def pairs(path: list[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"left": a, "right": b} for a, b in path]


def descend(tree: Tree, above: DataFrame) -> DataFrame:
    """The subtrees of the lowest stored level with subroot, root and path, what they inherit. above: (__group, subroot, root, path) of each group."""
    inherited, wide = None, FAN**LEVELS
    base = above.select(F.col("__group").alias("__g"), "subroot", "root", "path")
    same = F.col("__group").eqNullSafe(F.col("__g"))
    for level, blocks in reversed(tree.levels):
        last = F.col("__depth") <= level + LEVELS
        ready = blocks.where(last).join(base, same).drop("__g")
        if inherited is not None:
            ready = ready.unionByName(blocks.where(~last).join(inherited, same & (F.col("__block") == F.col("__b"))).drop("__g", "__b"))
        if not level:
            return ready
        kind = blocks.schema["__group"].dataType.simpleString()
        row_of = lambda r, at, x, path: {"__g": r["__group"], "__b": r["__block"] * wide + at, "subroot": r["subroot"], "root": r["root"], "path": pairs(path)}
        fields = lambda s: [("__g", s.field("__group").type), ("__b", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("path", PATH_TYPE)]
        inherited = written(regenerated(ready, level, row_of, fields, f"__g {kind}, __b long, subroot string, root string, path {PATH}"))
    raise ValueError("level 0 is always stored")


@dataclass
class Manifest:
    """Stored levels of a dataset's Merkle trees: those of its groups, and the one over the groups' subroots."""

    groups: Tree
    top: Tree
    order: str

    def roots(self) -> DataFrame:
        """One row (root), none for an empty dataset."""
        return self.top.tops.select(F.col("subroot").alias("root"))

    def group_paths(self) -> DataFrame:
        """(__group, subroot, root, path) of each group."""
        base = self.top.tops.select("__group", "subroot", F.col("subroot").alias("root"), F.array().cast(PATH).alias("path"))
        kind = self.groups.tops.schema["__group"].dataType.simpleString()
        row_of = lambda r, at, x, path: {"__group": x["name"], "subroot": x["h"], "root": r["root"], "path": pairs(path)}
        fields = lambda s: [("__group", member(s, "name")), ("subroot", pa.string()), ("root", pa.string()), ("path", PATH_TYPE)]
        return written(regenerated(descend(self.top, base), 0, row_of, fields, f"__group {kind}, subroot string, root string, path {PATH}"))

    def proofs(self) -> DataFrame:
        """A row for each leaf: its order value, leaf, subroot, root, path (its siblings), proof_sha256, folded_root and verified.

        folded_root is recomputed from the leaf's `altered` where that is not null, else from the leaf, and the original siblings.
        """
        order = self.order
        digests = ("leaf", "subroot", "root", "proof_sha256", "folded_root")

        def row_of(r, at, x, path):
            proof = hashlib.sha256("".join(a + b for a, b in path).encode()).hexdigest()
            return {"order": x["order"], "leaf": x["h"], "subroot": r["subroot"], "root": r["root"], "proof_sha256": proof, "folded_root": folded(x["altered"] or x["h"], path), "path": pairs(path)}

        rows = descend(self.groups, self.group_paths())
        kind = rows.select(F.col("nodes.order")).schema[0].dataType.elementType.simpleString()
        fields = lambda s: [("order", member(s, "order")), *[(k, pa.string()) for k in digests], ("path", PATH_TYPE)]
        done = regenerated(rows, 0, row_of, fields, ", ".join([f"order {kind}", *[f"{k} string" for k in digests], f"path {PATH}"]))
        return done.withColumnRenamed("order", order).withColumn("verified", F.col("folded_root") == F.col("root"))


def member(schema: pa.Schema, name: str) -> pa.DataType:
    return schema.field("nodes").type.value_type.field(name).type


def manifest(leaves: DataFrame, group: str, order: str) -> Manifest:
    """Trees over leaves: group, order, leaf (hex digest), altered (hex digest or null: what to verify in place of the leaf)."""
    modest_batches(leaves)
    own = written(leaves.select(F.col(group).alias("__group"), F.col(order).alias("order"), F.col("leaf").alias("h"), "altered"))
    rows = numbered(own, "__group", ["order", "h"])
    groups = grow(written(rows.withColumn("__depth", depth_of(F.col("__size")))), ["order", "altered"])
    names = numbered(groups.tops.select(F.lit(0).alias("__all"), F.col("__group").alias("name"), F.col("subroot").alias("h")), "__all", ["name"])
    top = grow(written(names.withColumn("__depth", depth_of(F.col("__size"))).withColumnRenamed("__all", "__group")), ["name"])
    return Manifest(groups, top, order)


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, source, leaf of each document, and altered: the leaf with the line ends of its text deleted where tampered holds."""
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    return docs.select("doc_id", "source", digest(*rest, F.col("text")).alias("leaf"), F.when(tampered, digest(*rest, bare)).alias("altered"))
