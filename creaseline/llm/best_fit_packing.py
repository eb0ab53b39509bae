"""Operator 13: documents packed into sequences of a fixed length by the linear grouping scheme.

Token ids are cut into pieces of at most `capacity`; only longer documents are cut, and the first piece is the shorter one.
What a plan needs of the pieces is how many there are of each length: at most `capacity` counts, whatever the corpus. The
plan (packing_plan, on the driver, bounded by the capacity alone) rounds large lengths up to the largest of their group,
groups holding equally many pieces; solves the configuration problem of these few sizes by column generation, with a
knapsack for each new configuration; puts actual lengths into its slots, the longest that fit; and fills what is left with the rest of the large and then all
small ones, longest first, each where it fits best. Sequences that stay loose are dissolved and filled once more. Equal
sequences are one entry with a multiplicity throughout. Spark then numbers the pieces of each length (counts of each partition and length
are summed up, so no length meets in one task) and each piece finds its slot by binary search among the plan's slot ranges.

The same vocabulary runs in tiktoken, which is four times as fast as tokenizers; vocabulary files that are no byte-level
BPE in order of merges run in tokenizers.

Defined results: a null text is empty and yields the closing id alone; rows that share a doc_id, or have none, are documents
of their own; a length of `capacity` is a sequence of its own; the text of a special token is that token, as in the
library; other columns do not matter; an empty table gives no pieces. Which of several pieces of one length gets which
slot depends on how the table is partitioned; their number and the number of sequences don't.
"""

from __future__ import annotations

import bisect
import json
from collections import Counter
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from creaseline.llm.blocks import as_bytes, modest_batches, tidy, written

CAPACITY = 2_048
CLOSING_ID = 0
#: Lengths over capacity / SMALL are large.
SMALL = 4
#: Groups of large lengths. More of them waste less by rounding and make the configuration problem larger.
GROUPS = 160
#: Configurations that are tried at most; the solution at hand is used then.
COLUMNS = 4_000
#: How far from its optimum, relatively, the linear programme may end.
GAP = 1e-4
#: Characters that are encoded at a time at most, but for single longer texts.
SLICE_CHARS = 4_000_000


# -- tokens ---------------------------------------------------------------------------------------


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> ids of the vocabulary file, special tokens recognised, none added."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    special = {x["content"]: x["id"] for x in spec.get("added_tokens", ())}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", ())]
    vocab = model.get("vocab", {})
    ranked = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not model.get("ignore_merges")
    if ranked and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs)):
        import tiktoken
        from public_tokenizers import PATTERN

        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in word): i for word, i in vocab.items() if word not in special}
        fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: fast.encode_to_numpy(text, allowed_special="all")
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)


def tokenize(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", closing: int = CLOSING_ID) -> DataFrame:
    """doc_id and ids: the token ids and the closing id, little-endian unsigned 32-bit."""
    modest_batches(docs)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tail = np.array([closing], "<u4").tobytes()

    def encode(batches):
        ids_of = encoder(vocabulary)
        for batch in batches:
            doc_ids, texts = batch.column(0), as_bytes(batch.column(1))
            for lo, hi in slices([len(t) for t in texts], SLICE_CHARS):
                ids = [ids_of(t.decode("utf-8", "replace")).astype("<u4", copy=False).tobytes() + tail for t in texts[lo:hi]]
                yield pa.RecordBatch.from_arrays([doc_ids.slice(lo, hi - lo), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
        tidy()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids binary")


def slices(sizes: list[int], most: int):
    """(from, to) of runs of neighbours that hold at most `most` together, or one."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def cut_pieces(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids of each piece."""
    n = F.octet_length("ids") / 4
    rows = tokens.withColumn("n", n.cast("long")).where("n > 0").withColumn("first", F.when(F.col("n") % capacity == 0, F.least("n", F.lit(capacity).cast("long"))).otherwise(F.col("n") % capacity))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - first) div {capacity}"))))
    start = F.when(F.col("piece") == 0, F.lit(0).cast("long")).otherwise(F.col("first") + (F.col("piece") - 1) * capacity)
    rows = rows.withColumn("start", start).withColumn("length", F.when(F.col("piece") == 0, F.col("first")).otherwise(F.lit(capacity).cast("long")))
    return rows.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))").alias("ids"))


# -- the plan -------------------------------------------------------------------------------------


def equal_groups(counts: list[tuple[int, int]], groups: int) -> list[tuple[int, int]]:
    """(length, how many), longest first, dealt to groups of equally many pieces: (size to round up to, how many). Groups of one size are one."""
    most, out, room = -(-sum(n for _, n in counts) // groups), [], 0
    for length, n in counts:
        while n:
            if not room:
                room = most
                if not out or out[-1][0] != length:
                    out.append((length, 0))
            take = min(n, room)
            out[-1] = (out[-1][0], out[-1][1] + take)
            n, room = n - take, room - take
    return out


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits: its value and how many of each."""
    best, taken = np.zeros(capacity + 1), []
    for i, (size, value) in enumerate(zip(sizes.tolist(), values.tolist(), strict=True)):
        for _ in range(capacity // size if value > 0 else 0):
            gain = np.zeros(capacity + 1)
            gain[size:] = best[:-size] + value
            better = gain > best + 1e-12
            if not better.any():
                break
            best = np.where(better, gain, best)
            taken.append((i, size, better))
    counts, c = np.zeros(len(sizes), np.int64), capacity
    for i, size, better in reversed(taken):
        if better[c]:
            counts[i] += 1
            c -= size
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """The configuration problem as a linear programme: (how many of each size, how often), by column generation.

    If the best new configuration is worth v, the solution is at most v times the optimum: it ends at v <= 1 + GAP.
    """
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(COLUMNS):
        inverse = np.linalg.inv(basis)
        value, counts = knapsack(sizes, inverse.sum(0), capacity)
        if value <= 1 + GAP:
            break
        x, step = inverse @ demand, inverse @ counts
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, np.maximum(x, 0) / step, np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = counts
    x = np.linalg.solve(basis, demand)
    return [(basis[:, j].round().astype(np.int64), float(max(0.0, x[j]))) for j in range(m)]


Run = tuple[tuple[tuple[int, int], ...], int]
"""Equal sequences: (length, how many of it) in order, and how many such sequences there are."""


def substituted(sizes: np.ndarray, chosen: list[tuple[np.ndarray, int]], counts: dict[int, int], capacity: int) -> tuple[list[Run], Counter]:
    """Actual lengths in the slots of the chosen configurations (how many of each size, how often); and what is left of counts.

    A slot gets the longest piece of at most its size that is left. The last slot of a sequence gets the longest that fits at all,
    so that what rounding up has left free in the others is used.
    """
    left, lengths = Counter(counts), sorted(counts)
    runs: list[Run] = []

    def longest(most: int, taken: Counter) -> int | None:
        for at in range(bisect.bisect_right(lengths, most) - 1, -1, -1):
            if left[lengths[at]] > taken[lengths[at]]:
                return lengths[at]
        return None

    for config, times in chosen:
        wanted = [int(s) for s, n in zip(sizes, config, strict=True) for _ in range(n)]  # longest first
        while times and lengths:
            taken, room = Counter(), capacity
            for k, size in enumerate(wanted):
                length = longest(room if k + 1 == len(wanted) else min(size, room), taken)
                if length is not None:
                    taken[length] += 1
                    room -= length
            if not taken:
                break
            many = min(times, *(left[length] // n for length, n in taken.items()))
            for length, n in taken.items():
                left[length] -= n * many
                if not left[length]:
                    lengths.pop(bisect.bisect_left(lengths, length))
            runs.append((tuple(sorted(taken.items(), reverse=True)), many))
            times -= many
    return runs, +left


def fill(runs: list[Run], rest: Counter, capacity: int) -> list[Run]:
    """Best fit, longest first: each piece goes where the least room is left that holds it, else to a new sequence.

    A sequence that is chosen keeps being the best one until it holds no more of that length, so equal sequences are filled at once.
    """
    room: dict[int, list[Run]] = {}
    for items, times in runs:
        room.setdefault(capacity - sum(a * b for a, b in items), []).append((items, times))
    sizes = sorted(room)

    def put(items: tuple, times: int, space: int) -> None:
        if not times:
            return
        if space not in room:
            bisect.insort(sizes, space)
            room[space] = []
        room[space].append((items, times))

    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                many = capacity // length
                full, n = divmod(n, many)
                put(((length, many),), full, capacity - many * length)
                put(((length, n),), 1 if n else 0, capacity - n * length)
                break
            space = sizes[at]
            items, times = room[space].pop()
            if not room[space]:
                del room[space]
                sizes.pop(at)
            many = space // length
            full = min(times, n // many)
            put((*items, (length, many)), full, space - many * length)
            n -= full * many
            times -= full
            if times and n:
                put((*items, (length, n)), 1, space - n * length)
                times, n = times - 1, 0
            put(items, times, space)
    return [r for held in room.values() for r in held]


def tightened(plan: list[Run], capacity: int) -> list[Run]:
    """Sequences with much room, which rounding up leaves where small pieces are rare, are dissolved and filled again, if that saves any."""
    tried = [plan]
    for room in (capacity // 8, capacity // 32, capacity // 128):
        kept, rest = [], Counter()
        for items, times in plan:
            if capacity - sum(a * b for a, b in items) <= room:
                kept.append((items, times))
                continue
            for length, n in items:
                rest[length] += n * times
        tried.append(fill(kept, rest, capacity))
    return min(tried, key=lambda p: sum(times for _, times in p))


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Sequences for so many pieces of each length (1 to capacity)."""
    counts = {int(k): int(v) for k, v in counts.items() if v}
    large = sorted(((k, v) for k, v in counts.items() if capacity // SMALL < k < capacity), reverse=True)
    small = Counter({k: v for k, v in counts.items() if k <= capacity // SMALL})
    runs: list[Run] = [(((capacity, 1),), counts[capacity])] if counts.get(capacity) else []
    if large:
        groups = equal_groups(large, GROUPS)
        sizes = np.array([s for s, _ in groups])
        demand = np.array([n for _, n in groups], float)
        chosen = [(c, int(x + 1e-6)) for c, x in configurations(sizes, demand, capacity)]
        own, rest = substituted(sizes, chosen, dict(large), capacity)
        return runs + tightened(fill(own, rest + small, capacity), capacity)
    return runs + fill([], small, capacity)


def slots(plan: list[Run]) -> dict[str, np.ndarray]:
    """The plan as ranges of slots, by length and first slot: `each` slots a sequence from sequence `base` on, the first of them at `offset`."""
    used: Counter = Counter()
    rows, base = [], 0
    for items, times in plan:
        offset = 0
        for length, each in items:
            rows.append((length, used[length], each, base, offset))
            used[length] += each * times
            offset += each * length
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "each", "base", "offset"), table.T, strict=True))


# -- pieces to slots ------------------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """pieces with sequence_id and offset; lengths are 1 to capacity. pieces is written once to the shared folder."""
    spark = pieces.sparkSession
    stored = written(pieces.withColumn("__part", F.spark_partition_id()))
    n = F.col(length_col).cast("long")
    piles = written(stored.groupBy("__part", n.alias("__length")).agg(F.count(F.lit(1)).alias("__n")))
    counts = {r[0]: r[1] for r in piles.groupBy("__length").agg(F.sum("__n")).collect()}  # a row for each length up to the capacity
    if not counts:
        return stored.drop("__part").select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError(f"lengths from {min(counts)} to {max(counts)}; 1 to {capacity} fit")
    before = F.sum("__n").over(W.partitionBy("__length").orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    starts = piles.withColumn("__before", F.coalesce(before, F.lit(0).cast("long"))).drop("__n")
    order = [F.col(c) for c, kind in pieces.dtypes if kind in ("bigint", "int", "string")]
    place = F.row_number().over(W.partitionBy("__part", "__length").orderBy(*(order or [F.lit(0)])))
    ranked = stored.withColumn("__length", n).withColumn("__place", place).join(starts, ["__part", "__length"])
    ranked = ranked.select(*[F.col(c) for c in pieces.columns], "__length", (F.col("__before") + F.col("__place") - 1).alias("__rank"))
    where = slots(packing_plan(counts, capacity))
    starts_of = {int(k): np.flatnonzero(where["length"] == k) for k in np.unique(where["length"])}
    width = len(pieces.columns)

    def place_all(batches):
        for batch in batches:
            length = batch.column(width).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(width + 1).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.zeros(len(length), np.int64)
            for k in np.unique(length):
                own, mine = starts_of[int(k)], length == k
                at[mine] = own[np.searchsorted(where["first"][own], rank[mine], side="right") - 1]
            turn = rank - where["first"][at]
            sequence = where["base"][at] + turn // where["each"][at]
            offset = where["offset"][at] + turn % where["each"][at] * length
            columns = [batch.column(i) for i in range(width)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:width], "sequence_id", "offset"])

    schema = ranked.select(*pieces.columns).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place_all, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset."""
    pieces = cut_pieces(tokenize(docs, vocabulary), capacity).withColumn("ids_crc32", F.crc32("ids"))
    return pack(pieces.select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences out of packed pieces with ids: sequence_id, ids (little-endian unsigned 32-bit), n_pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("p"), F.count(F.lit(1)).alias("n_pieces"))
    return rows.select("sequence_id", F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "")).alias("ids"), "n_pieces")
