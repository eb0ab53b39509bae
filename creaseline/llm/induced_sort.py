"""Suffix sorting of one shard by induction, with capped common-prefix values.

The shard is an array of small symbols. Suffixes that begin a rise after a fall (seeds) are sorted first: induction
from their first symbols sorts the strings between them, equal strings get equal names, and the shorter text of names is
sorted in turn (by doubling, until names are distinct or reach DEPTH). Then the sorted seeds induce all
other suffixes: once upwards, once downwards. The queue is monotone, so it is one first-in-first-out queue for each
symbol; a whole run of equal symbols leaves it as one numpy block. Tuples (suffix, common prefix with the tuple before)
travel through the queues; the common prefix of two induced suffixes is one more than the minimum between the
suffixes that induced them. Queues over IN_MEMORY entries continue in files of the task's scratch folder, which are
removed when the shard is done.
"""

from __future__ import annotations

import tempfile
from pathlib import Path

import numpy as np

from creaseline.llm.blocks import U64, mix, powers

DEPTH = 200
#: Queue entries that stay in memory; the rest goes to scratch files.
IN_MEMORY = 1_000_000


class Queues:
    """One first-in-first-out queue of (suffix, common prefix) for each symbol."""

    def __init__(self, symbols: int, folder: Path | None):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.folder, self.held, self.files = folder, 0, 0

    def push(self, symbol: int, suffix: np.ndarray, common: np.ndarray) -> None:
        if self.folder is not None and self.held + len(suffix) > IN_MEMORY:
            name = self.folder / f"{id(self)}-{self.files}.npy"
            self.files += 1
            both = np.empty(len(suffix), [("s", suffix.dtype), ("c", common.dtype)])
            both["s"], both["c"] = suffix, common
            np.save(name, both)
            self.parts[symbol].append(name)
        else:
            self.held += len(suffix)
            self.parts[symbol].append((suffix, common))

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        parts, self.parts[symbol] = self.parts[symbol], []
        if not parts:
            return None
        loaded = []
        for p in parts:
            if isinstance(p, tuple):
                self.held -= len(p[0])
                loaded.append(p)
            else:
                both = np.load(p)
                p.unlink()
                loaded.append((both["s"], both["c"]))
        return np.concatenate([x for x, _ in loaded]), np.concatenate([x for _, x in loaded])


class Shard:
    """symbols: small integers; the last one is 0 and the one before it is not."""

    def __init__(self, symbols: np.ndarray, depth: int = DEPTH, folder: Path | None = None):
        self.t, self.depth, self.folder = symbols, depth, folder
        self.n, self.count = len(symbols), int(symbols.max(initial=0)) + 1
        h = mix(symbols.astype(U64) + U64(1))
        self.inverse = powers(pow(0x5851F42D4C957F2D, -1, 1 << 64), self.n + 1)
        self.prefix = np.zeros(self.n + 1, U64)
        np.cumsum(h * powers(0x5851F42D4C957F2D, self.n), out=self.prefix[1:])
        edge = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        of_run = np.concatenate([symbols[edge[:-1]] < symbols[edge[1:]], [True]])
        self.rises = np.repeat(of_run, np.diff(np.concatenate([edge, [self.n]])))
        self.seeds = np.flatnonzero(self.rises & np.concatenate([[False], ~self.rises[:-1]]))

    def hashed(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of suffixes, up to depth, by binary search on prefix hashes."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.depth, self.n - np.maximum(a, b))
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.hashed(a, mid) == self.hashed(b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low.astype(np.uint8)

    def sweep(self, blocks, upwards: bool) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Induce falling suffixes upwards, or rising ones downwards. blocks(symbol): the sorted tuples that join after the queue's."""
        queues = Queues(self.count, self.folder)
        since = np.full(self.count, self.depth, np.uint8)  # least common prefix since the last push to a symbol
        pushed = np.zeros(self.count, bool)
        out: list[list] = [[] for _ in range(self.count)]

        def feed(suffix: np.ndarray, common: np.ndarray) -> None:
            before = suffix - 1
            ok = (before >= 0) & (self.rises[before] != upwards)
            at = np.flatnonzero(ok)
            if len(common):
                whole = common.min()
            if not len(at):
                np.minimum(since, whole, out=since)
                return
            target = self.t[before[at]]
            order = np.argsort(target, kind="stable")
            ends = np.flatnonzero(np.diff(target[order])) + 1
            touched = []
            for own in np.split(order, ends):
                d, k = int(target[own[0]]), at[own]
                starts = np.concatenate([[0], k[:-1] + 1])
                least = np.minimum.reduceat(common, np.concatenate([starts, [k[-1] + 1]]) if k[-1] + 1 < len(common) else starts)
                after = least[len(k)] if len(least) > len(k) else self.depth
                least = least[: len(k)].copy()
                least[0] = min(least[0], since[d])
                value = np.minimum(least, self.depth - 1) + np.uint8(1)
                if not pushed[d]:
                    value[0], pushed[d] = 0, True
                queues.push(d, before[k], value)
                touched.append((d, after))
            np.minimum(since, whole, out=since)
            for d, after in touched:
                since[d] = after

        for c in range(self.count) if upwards else range(self.count - 1, -1, -1):
            while (block := queues.pop(c)) is not None:
                out[c].append(block)
                feed(*block)
            last = out[c][-1][0][-1:] if out[c] else np.zeros(0, np.int64)
            suffix, common = blocks(c, last)
            if len(suffix):
                feed(suffix, common)
        return out

    def induce(self, seeds: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
        """Suffix order and common prefixes with the suffix before, from seeds sorted (at least by first symbol)."""
        first = self.t[seeds]
        bounds = np.searchsorted(first, np.arange(self.count + 1))
        common = np.zeros(len(seeds), np.uint8)
        if exact and len(seeds):
            common[1:] = self.common(seeds[:-1], seeds[1:])

        def own_seeds(c: int, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            s, v = seeds[bounds[c] : bounds[c + 1]], common[bounds[c] : bounds[c + 1]].copy()
            if len(s):
                v[0] = self.common(last, s[:1])[0] if len(last) and exact else 0
            return s, v

        falls = [self.joined(x) for x in self.sweep(own_seeds, True)]

        def own_falls(c: int, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            s, v = falls[c]
            if not len(s):
                return s, v
            v = np.concatenate([[0], v[:0:-1]]).astype(np.uint8)  # in descending order: with the larger neighbour
            v[0] = self.common(last, s[-1:])[0] if len(last) and exact else 0
            return s[::-1], v

        end = seeds[:1] if len(seeds) and seeds[0] == self.n - 1 else np.array([self.n - 1])
        rises = [self.joined(x) for x in self.sweep(own_falls, False)]
        order, values = [end], [np.zeros(1, np.uint8)]
        for c in range(self.count):
            s, v = falls[c]
            order.append(s)
            values.append(v)
            r, w = rises[c]
            if len(r):
                up = np.concatenate([[0], w[:0:-1]]).astype(np.uint8)
                up[0] = self.common(s[-1:], r[-1:])[0] if len(s) and exact else 0
                order.append(r[::-1])
                values.append(up)
        return np.concatenate(order), np.concatenate(values)

    @staticmethod
    def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])

    def sorted_seeds(self) -> np.ndarray:
        if len(self.seeds) < 2:
            return self.seeds
        rough, _ = self.induce(self.seeds[np.argsort(self.t[self.seeds], kind="stable")], False)
        is_seed = np.zeros(self.n, bool)
        is_seed[self.seeds] = True
        by_string = rough[is_seed[rough]]
        # names: equal strings from one seed through the next get equal ones
        place = np.zeros(self.n, np.int64)
        place[self.seeds] = np.arange(len(self.seeds))
        length = np.diff(np.concatenate([self.seeds, [self.n - 1]])) + 1
        string = self.hashed(self.seeds, np.minimum(length, self.n - self.seeds)) ^ mix(length.astype(U64))
        s = string[place[by_string]]
        name = np.zeros(len(self.seeds), np.int64)
        name[place[by_string]] = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        # the text of names, sorted by doubling; a name stands for two symbols at least
        step = 1
        while name.max() + 1 < len(name) and 2 * step <= 2 * self.depth:
            nexts = np.concatenate([name[step:] + 1, np.zeros(min(step, len(name)), np.int64)])[: len(name)]
            key = name * (len(name) + 1) + nexts
            distinct, name = np.unique(key, return_inverse=True)
            step *= 2
        return self.seeds[np.argsort(name, kind="stable")]

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        return self.induce(self.sorted_seeds(), True)


def suffix_order(symbols: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order (to depth) and common prefixes with the one before, capped at depth. The last symbol is 0."""
    if len(symbols) <= IN_MEMORY:
        return Shard(symbols, depth).sort()
    with tempfile.TemporaryDirectory() as folder:
        return Shard(symbols, depth, Path(folder)).sort()
