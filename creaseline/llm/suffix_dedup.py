"""Operator 5: removal of every byte that a repeated WIDTH-byte string covers, by suffix arrays of shards.

Every WIDTH-byte window names its anchor: the GRAM-byte string in it with the least hash (leftmost of equals). Equal
windows have equal anchors at equal places, so only windows of one anchor can be equal. The windows of one anchor
occurrence are neighbours; together they are a context of at most 2 * WIDTH - GRAM bytes.

Documents are dealt to chunks. A chunk sends (anchor hash, context hash) once for each distinct pair to the bucket of
the anchor. The bucket answers with two bits: whether the context occurs elsewhere (then all its windows are repeated)
and whether its text is needed, that is if contexts of its anchor differ and this chunk is the first to hold it. Only
such texts travel, once each, to the anchor's shard, which sorts their suffixes by induction (induced_sort) and marks
windows whose common prefix with a neighbour reaches WIDTH. So a passage that very many documents share costs one text,
and shards hold only what hashes of whole contexts can't decide. Chunks merge the marked windows into spans.

An anchor with more than HOT_CONTEXTS different contexts (a line that very many documents hold in different places) would
fill a shard on its own. Its windows are dealt out instead, by their hashes: equal windows meet, whatever their number.

The text is shuffled once (the plan reuses the exchange). Equality of contexts rests on two independent 64-bit hashes.
Equal rows that exceed a chunk are handled once, as repeated, and returned as often as they occur. A chunk writes a row
only for a bucket that it has contexts for.

Defined results: null and empty texts have no bytes; texts under WIDTH bytes lose nothing; repeated rows repeat each
other; matches never cross documents; a null doc_id is kept; an empty table gives an empty result; other columns do
not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.blocks import U64, all_copies, as_bytes, mix, offsets, once_each, powers, tidy
from creaseline.llm.induced_sort import suffix_order

WIDTH = 200
GRAM = 32
CHUNK_BYTES = 3_000_000
CHUNK_ROWS = 20_000
HOT_CONTEXTS = 8_000
BUCKET_BYTES = 6_000_000
BASE = 0x5851F42D4C957F2D
BYTE_HASH = mix(np.arange(256, dtype=U64) + U64(77))


def sliding_argmin(v: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value of each run of `width` values, leftmost of equals: block-wise running minima from both sides."""
    n = len(v) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    blocks = -(-len(v) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, U64)
    padded[: len(v)] = v
    grid = padded.reshape(blocks, width)
    place = np.arange(blocks * width).reshape(blocks, width)

    def running(g: np.ndarray, p: np.ndarray, ties: bool) -> np.ndarray:
        least = np.minimum.accumulate(g, axis=1)
        new = np.ones(g.shape, bool)
        new[:, 1:] = g[:, 1:] <= least[:, :-1] if ties else g[:, 1:] < least[:, :-1]
        return np.take_along_axis(p, np.maximum.accumulate(np.where(new, np.arange(width), 0), axis=1), 1)

    ahead = running(grid, place, False).ravel()  # from the block's start to here
    behind = running(grid[:, ::-1], place[:, ::-1], True)[:, ::-1].ravel()  # from here to the block's end
    left, right = behind[:n], ahead[width - 1 : width - 1 + n]
    return np.where(padded[left] <= padded[right], left, right)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of `width` values, by running minima of blocks from both sides."""
    n = len(v) - width + 1
    if n <= 0:
        return v[:0]
    padded = np.full(-(-len(v) // width) * width, np.iinfo(np.uint64).max, U64)
    padded[: len(v)] = v
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchor_runs(v: np.ndarray, doc: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of the neighbouring windows that share an anchor, and the anchor. v: hashes of grams."""
    span = width - gram + 1
    least = sliding_min(v, span)
    changes = np.flatnonzero(least[1:] != least[:-1]) + 1
    low = np.union1d(doc[:-1][doc[:-1] < len(least)], changes)
    owner = np.searchsorted(doc, low, "right") - 1
    high = np.minimum(np.concatenate([low[1:], [len(least)]]) - 1, doc[owner + 1] - width)
    inside = high >= low
    low, high = low[inside], high[inside]
    at = low + span - 1
    came = (low > 0) & (v[at] == least[low])  # the window's last gram is less than all before it ...
    came &= least[np.maximum(low - 1, 0)] > least[low]
    for part in np.array_split(np.flatnonzero(~came), max(1, (~came).sum() // 4096)):  # ... or it is looked for
        at[part] = low[part] + v[low[part][:, None] + np.arange(span)].argmin(1)
    tied = at < high  # the anchor leaves, but an equal gram follows
    if not tied.any():
        return low, high, at
    lows, highs, ats = [low[~tied]], [high[~tied]], [at[~tied]]
    for i, j in zip(low[tied].tolist(), high[tied].tolist(), strict=True):
        a = i + sliding_argmin(v[i : j + span], span)
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        lows.append(i + first)
        highs.append(i + np.concatenate([first[1:], [len(a)]]) - 1)
        ats.append(a[first])
    return np.concatenate(lows), np.concatenate(highs), np.concatenate(ats)


_powers: dict[str, np.ndarray] = {}


def base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * CHUNK_BYTES)
        _powers.update(up=powers(BASE, size), down=powers(pow(BASE, -1, 1 << 64), size))
    return _powers["up"][:n], _powers["down"][:n]


class ByteChunk:
    """Documents end to end, their anchors' contexts, and the distinct (anchor hash, context hash) pairs in a fixed order."""

    def __init__(self, table: pa.Table, buckets: int, width: int, gram: int):
        texts = as_bytes(table.column("text"))
        self.ids, self.doc = table.column("doc_id"), offsets([len(t) for t in texts])
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        n = len(self.bytes)
        up, down = base_powers(n + 1)
        prefix = np.zeros(n + 1, U64)
        np.cumsum(BYTE_HASH[self.bytes] * up[:n], out=prefix[1:])
        hashed = self.hashed = lambda a, z: (prefix[z] - prefix[a]) * down[a]
        grams = mix((prefix[gram:] - prefix[:-gram]) * down[: n - gram + 1]) if n >= gram else np.zeros(0, U64)
        self.low, self.high, a = anchor_runs(grams, self.doc, width, gram) if n >= width else (np.zeros(0, np.int64),) * 3
        hash_a = grams[a]
        hash_c = mix(hashed(self.low, self.high + width) + mix((a - self.low).astype(U64) * U64(1 << 20) + (self.high - self.low).astype(U64)))
        bucket = (mix(hash_a ^ U64(0x5555)) >> U64(32)).astype(np.int64) % buckets
        order = np.lexsort((hash_c, hash_a, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (hash_a[order][1:] != hash_a[order][:-1]) | (hash_c[order][1:] != hash_c[order][:-1])
        self.entry = np.empty(len(order), np.int64)  # of each context
        self.entry[order] = np.cumsum(new) - 1
        self.a, self.c, self.bucket = hash_a[order][new], hash_c[order][new], bucket[order][new]
        self.sample = order[new]  # a context of each entry
        self.several = np.bincount(self.entry, minlength=len(self.a)) > 1
        self.copies = table.column("n")
        many = np.repeat(self.copies.to_numpy() > 1, np.diff(self.doc))
        if many.any():
            self.several |= np.bincount(self.entry, many[self.low], minlength=len(self.a)) > 0
        self.buckets = np.unique(self.bucket)
        self.at = np.append(np.searchsorted(self.bucket, self.buckets), len(self.bucket))
        self.range = dict(zip(self.buckets.tolist(), zip(self.at[:-1].tolist(), self.at[1:].tolist(), strict=True), strict=True))


def words(column: pa.ChunkedArray, kind=U64) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def suffix_dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_text adds kept (binary) and spans (byte intervals, end exclusive)."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    chunks = max(1, -(-size // CHUNK_BYTES), -(-n // CHUNK_ROWS))
    buckets = max(64, size // BUCKET_BYTES)
    docs = once_each(docs, CHUNK_BYTES)
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks).cast("long"))).repartition(chunks, "chunk")

    def send(key: tuple, table: pa.Table) -> pa.Table:
        k = ByteChunk(table, buckets, width, gram)
        cut = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(k.at[:-1], k.at[1:], strict=True)], pa.binary())
        tidy()
        return pa.table({"bucket": pa.array(k.buckets, pa.int64()), "chunk": pa.array([key[0].as_py()] * len(k.buckets), pa.int64()), "a": cut(k.a), "c": cut(k.c), "several": cut(k.several)})

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        parts = words(table.column("a"))
        a, c, several = np.concatenate(parts), np.concatenate(words(table.column("c"))), np.concatenate(words(table.column("several"), bool))
        at = offsets([len(p) for p in parts])
        order = np.lexsort((np.arange(len(a)), c, a))
        new_a, new = np.ones(len(a), bool), np.ones(len(a), bool)
        new_a[1:] = a[order][1:] != a[order][:-1]
        new[1:] = new_a[1:] | (c[order][1:] != c[order][:-1])
        group, group_a = np.cumsum(new) - 1, np.cumsum(new_a) - 1
        often = (np.bincount(group) > 1) | (np.bincount(group, several[order]) > 0)
        open_a = np.bincount(group_a, new & ~often[group]) > 0  # has a context that occurs once
        contexts = np.bincount(group_a, new)
        repeated, ship, split = (np.zeros(len(a), bool) for _ in range(3))
        repeated[order] = often[group]
        ship[order] = new & (open_a & (contexts > 1) & (contexts <= HOT_CONTEXTS))[group_a]
        split[order] = new & (open_a & (contexts > HOT_CONTEXTS))[group_a]
        bits = lambda x: pa.array([np.packbits(x[i:j]).tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "repeated": bits(repeated), "ship": bits(ship), "split": bits(split)})

    def flags(k: ByteChunk, answers: pa.Table, name: str) -> np.ndarray:
        out = np.zeros(len(k.a), bool)
        for b, x in zip(answers.column("bucket").to_pylist(), answers.column(name).to_pylist(), strict=True):
            if x is not None:
                i, j = k.range[b]
                out[i:j] = np.unpackbits(np.frombuffer(x, np.uint8), count=j - i)
        return out

    def deliver(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        """Texts of contexts for shards (by_window 0), and hashes and places of the windows of hot anchors (by_window 1)."""
        k = ByteChunk(table, buckets, width, gram)
        repeated, entries = flags(k, answers, "repeated"), np.flatnonzero(flags(k, answers, "ship"))
        rows: dict[str, list] = {x: [] for x in ("by_window", "bucket", "chunk", "a", "c", "repeated", "sizes", "text")}

        def put(*values) -> None:
            for name, v in zip(rows, values, strict=True):
                rows[name].append(v)

        chunk = key[0].as_py()
        for b, own in zip(*grouped(k.bucket[entries], entries), strict=True):
            low, high = k.low[k.sample[own]], k.high[k.sample[own]] + width
            put(0, b, chunk, k.a[own].tobytes(), k.c[own].tobytes(), repeated[own].tobytes(), (high - low).astype(np.int32).tobytes(), b"".join([k.bytes[x:y].tobytes() for x, y in zip(low.tolist(), high.tolist(), strict=True)]))
        entries = np.flatnonzero(flags(k, answers, "split"))
        if len(entries):
            low, count = k.low[k.sample[entries]], (k.high - k.low)[k.sample[entries]] + 1
            start = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            a, w = np.repeat(k.a[entries], count), mix(k.hashed(start, start + width))
            bucket = (mix(w) >> U64(32)).astype(np.int64) % buckets
            by = np.argsort(bucket, kind="stable")
            for b, own in zip(*grouped(bucket[by], by), strict=True):
                put(1, b, chunk, a[own].tobytes(), w[own].tobytes(), None, start[own].tobytes(), None)
        tidy()
        return pa.table({x: pa.array(v, pa.int64() if x in ("by_window", "bucket", "chunk") else pa.binary()) for x, v in rows.items()})

    def decide(key: tuple, table: pa.Table) -> pa.Table:
        return order(key[1:], table) if key[0].as_py() == 0 else tally(key[1:], table)

    def tally(key: tuple, table: pa.Table) -> pa.Table:
        """Windows of hot anchors that occur more than once; places go back to the chunks that sent them."""
        parts = words(table.column("a"))
        a, w = np.concatenate(parts), np.concatenate(words(table.column("c")))
        by = np.lexsort((w, a))
        same = (a[by][1:] == a[by][:-1]) & (w[by][1:] == w[by][:-1])
        hit = np.zeros(len(a), bool)
        hit[by[1:]] |= same
        hit[by[:-1]] |= same
        at = offsets([len(p) for p in parts])
        starts = [s[hit[i:j]].tobytes() for s, i, j in zip(words(table.column("sizes"), np.int64), at[:-1], at[1:], strict=True)]
        none = pa.array([None] * len(starts), pa.binary())
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "a": none, "c": none, "starts": pa.array(starts, pa.binary()), "marks": none})

    def order(key: tuple, table: pa.Table) -> pa.Table:
        sizes = [np.frombuffer(x, np.int32).astype(np.int64) for x in table.column("sizes").to_pylist()]
        size = np.concatenate(sizes)
        text = np.frombuffer(b"".join(table.column("text").to_pylist()), np.uint8)
        begin = offsets(size + 1)  # a zero after each context
        symbols = np.zeros(int(begin[-1]), np.uint16)
        place = np.arange(len(text)) + np.repeat(np.arange(len(size)), size)
        symbols[place] = text.astype(np.uint16) + 1
        suffix, common = suffix_order(symbols, width)
        hit = np.zeros(len(symbols), bool)
        at = np.flatnonzero(common >= width)
        hit[suffix[at]] = True
        hit[suffix[at - 1]] = True
        repeated = np.concatenate([np.frombuffer(x, bool) for x in table.column("repeated").to_pylist()])
        out: dict[str, list] = {x: [] for x in ("chunk", "bucket", "a", "c", "starts", "marks")}
        row_at = offsets([len(s) for s in sizes])
        for r, (i, j) in enumerate(zip(row_at[:-1], row_at[1:], strict=True)):
            own = np.array([e for e in range(i, j) if not repeated[e] and hit[begin[e] : begin[e + 1]].any()], np.int64)
            if not len(own):
                continue
            a, c = (np.frombuffer(table.column(x)[r].as_py(), U64)[own - i] for x in ("a", "c"))
            starts = (size[own] - width + 1).astype(np.int32)
            marks = np.concatenate([hit[begin[e] : begin[e] + m] for e, m in zip(own, starts, strict=True)])
            for name, v in zip(out, (table.column("chunk")[r].as_py(), key[0].as_py(), a.tobytes(), c.tobytes(), starts.tobytes(), marks.tobytes()), strict=True):
                out[name].append(v)
        return pa.table({x: pa.array(v, pa.int64() if x in ("bucket", "chunk") else pa.binary()) for x, v in out.items()})

    def remove(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        k = ByteChunk(table, buckets, width, gram)
        marked = np.zeros(len(k.bytes) + 1, np.int32)
        whole = np.flatnonzero(flags(k, told, "repeated")[k.entry]) if len(k.entry) else np.zeros(0, np.int64)
        np.add.at(marked, k.low[whole], 1)
        np.add.at(marked, k.high[whole] + width, -1)
        context = np.zeros(len(k.a), np.int64)
        context[k.entry] = np.arange(len(k.entry))  # of entries that occur once
        for b, a, c, starts, marks in zip(*(told.column(x).to_pylist() for x in ("bucket", "a", "c", "starts", "marks")), strict=True):
            if starts is None:
                continue
            if a is None:  # windows of hot anchors
                s = np.frombuffer(starts, np.int64)
                np.add.at(marked, s, 1)
                np.add.at(marked, s + width, -1)
                continue
            i, j = k.range[b]
            keys = {x: i + e for e, x in enumerate(zip(k.a[i:j].tolist(), k.c[i:j].tolist(), strict=True))}
            sizes, m, at = np.frombuffer(starts, np.int32), np.frombuffer(marks, bool), 0
            for x, n_starts in zip(zip(np.frombuffer(a, U64).tolist(), np.frombuffer(c, U64).tolist(), strict=True), sizes.tolist(), strict=True):
                s = k.low[context[keys[x]]] + np.flatnonzero(m[at : at + n_starts])
                np.add.at(marked, s, 1)
                np.add.at(marked, s + width, -1)
                at += n_starts
        covered = np.cumsum(marked[:-1]) > 0
        out: dict[str, list] = {x: [] for x in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans")}
        for i, j in zip(k.doc[:-1], k.doc[1:], strict=True):
            gone = covered[i:j]
            kept = k.bytes[i:j][~gone].tobytes()
            turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            for name, v in zip(out, (j - i, int(gone.sum()), len(turn) // 2, hashlib.sha256(kept).hexdigest(), kept, turn.reshape(-1, 2).tolist()), strict=True):
                out[name].append(v if with_text or name not in ("kept", "spans") else None)
        kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()} | ({"kept": pa.binary(), "spans": pa.list_(pa.list_(pa.int64()))} if with_text else {})
        tidy()
        return pa.table({"doc_id": k.ids, "n": k.copies, **{x: pa.array(out[x], kind) for x, kind in kinds.items()}})

    sent = dealt.groupBy("chunk").applyInArrow(send, "bucket long, chunk long, a binary, c binary, several binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, repeated binary, ship binary, split binary")
    texts = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(deliver, "by_window long, bucket long, chunk long, a binary, c binary, repeated binary, sizes binary, text binary")
    results = texts.groupBy("by_window", "bucket").applyInArrow(decide, "chunk long, bucket long, a binary, c binary, starts binary, marks binary")
    told = answers.drop("ship", "split").unionByName(results, allowMissingColumns=True)
    schema = "doc_id long, n long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<array<long>>" * with_text
    return all_copies(dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(remove, schema))


def grouped(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values by key; keys do not fall."""
    distinct, at = np.unique(keys, return_index=True)
    return distinct.tolist(), np.split(values, at[1:]) if len(distinct) else []
