"""Operator 2: SentencePiece (BPE, byte fallback) encoding and decoding by vectorised merge rounds.

Words of a batch that the worker has not met lie end to end in flat numpy symbol arrays. A round looks up the
rank of every adjacent pair, takes the minimum rank of each word (a segmented reduction), merges its leftmost
occurrences at once and compacts the arrays; words without a pair leave. No piece of the model spans the boundary
between a letter and a following space mark, so words can be merged on their own; the loader checks that.

Rounds over whole arrays suit short words. In words of LONG symbols and more (data without spaces) a round looks only at
the places of the least rank: places lie in a list for each rank, symbols are linked, and after a merge only the pairs
beside it are looked up again. So a word of a million symbols costs its merges, not its length for each rank.

Exactness: the library merges the best pair, leftmost first. Merging all its occurrences at once gives the same
result unless the merged piece opens or closes a piece of no worse rank; for such pieces only occurrences further
apart than any piece can reach are merged in one round.

Defined results: null and empty text give no ids; a literal space mark (U+2581) is a space, as in the library;
repeated rows repeat; other columns do not matter. Work is per row: no shuffle, memory bounded by a batch.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creaseline.llm.blocks import modest_batches, tidy

MARK = "▁"
NONE = np.iinfo(np.int32).max
#: Words of a generation that a worker remembers, of two; bounds memory only.
WORDS_KEPT = 100_000
#: Rows and bytes of text that a worker encodes at once; a longer text is one piece. Bounds memory only.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1_000, 2_000_000
#: Words of so many symbols are merged by lists of places, see merge_places.
LONG = 256


@dataclass
class Vocabulary:
    """What encoding needs of a model; fixed by the model file. Only the first fields travel to tasks, about 2 MB; a worker makes the tables once."""

    size: int
    chars: np.ndarray  # code points of pieces of one character
    char_pieces: np.ndarray
    keys: np.ndarray  # pairs of symbols that make a piece
    made: np.ndarray
    rank: np.ndarray  # of each piece; equal scores share a rank
    risky: np.ndarray  # pieces that open or close a piece of no worse rank
    byte_id: np.ndarray
    piece_bytes: list[bytes]  # what decoding emits, marks as spaces
    reach: int  # longest piece
    breaks_at_newline: bool
    longest_run: int  # of marks that is one piece

    WIDE = 1 << 22

    def tables(self) -> Vocabulary:
        """Fill char_symbol (code point -> symbol; size + code point if it is no piece) and the open-addressed pair table."""
        self.char_symbol = np.arange(0x110000, dtype=np.int32) + self.size
        self.char_symbol[self.chars] = self.char_pieces
        self.table_key, self.table_piece = np.full(1 << 20, -1, np.int64), np.full(1 << 20, -1, np.int32)
        at, todo = self.slot(self.keys), np.arange(len(self.keys))
        while len(todo):
            place, first = np.unique(at[todo], return_index=True)
            free = self.table_key[place] == -1
            self.table_key[place[free]], self.table_piece[place[free]] = self.keys[todo[first[free]]], self.made[todo[first[free]]]
            todo = np.delete(todo, first[free])
            at[todo] = np.where(self.table_key[at[todo]] == -1, at[todo], (at[todo] + 1) & (len(self.table_key) - 1))
        return self

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        key = left.astype(np.int64) * self.WIDE + right
        at = self.slot(key)
        found = self.table_key[at]
        out = np.where(found == key, self.table_piece[at], -1)
        todo = np.flatnonzero((found != key) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.table_key) - 1)
            found = self.table_key[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.table_piece[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


def load(path: str) -> Vocabulary:
    """Read the vocabulary of a model file (with the sentencepiece library, on the driver)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    text = {sp.id_to_piece(i): i for i in plain}
    if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) for p in text):
        raise ValueError("a piece spans words; this model cannot be split at spaces")
    scores = {p: sp.get_score(i) for p, i in text.items()}
    order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
    rank = np.full(n, NONE, np.int32)
    for p, i in text.items():
        rank[i] = order[scores[p]]
    chars = np.arange(0x110000, dtype=np.int32) + n
    for p, i in text.items():
        if len(p) == 1:
            chars[ord(p)] = i
    symbol = lambda p: text.get(p) if len(p) > 1 else int(chars[ord(p)])
    keys, made, risky = [], [], np.zeros(n, bool)
    for p, i in text.items():
        for cut in range(1, len(p)):
            a, b = symbol(p[:cut]), symbol(p[cut:])
            if a is not None and b is not None:
                keys.append(a * Vocabulary.WIDE + b)
                made.append(i)
            for part in (p[:cut], p[cut:]):
                if (j := text.get(part)) is not None and rank[i] <= rank[j]:
                    risky[j] = True
    single = {ord(p): i for p, i in text.items() if len(p) == 1}
    return Vocabulary(
        n, np.array(list(single), np.int32), np.array(list(single.values()), np.int32), np.array(keys, np.int64), np.array(made, np.int32), rank, risky,
        np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32),
        [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)],
        max(map(len, text)), not any("\n" in p and len(p) > 1 for p in text), max(len(p) for p in text if not p.strip(MARK)),
    )


def merge_rounds(v: Vocabulary, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge until no pair remains. word: of each symbol, not falling. Returns the symbols and their words, in order of words."""
    done_sym, done_word = [], []
    while len(sym):
        new = np.concatenate([v.pairs(sym[:-1], sym[1:]), [-1]]).astype(np.int32)
        new[:-1][word[1:] != word[:-1]] = -1
        rank = np.where(new >= 0, v.rank[new], NONE)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        lengths = np.diff(np.concatenate([first, [len(sym)]]))
        best = np.repeat(np.minimum.reduceat(rank, first), lengths)
        over = best == NONE
        if over.any():
            done_sym.append(sym[over])
            done_word.append(word[over])
            sym, word, new, rank, best = (x[~over] for x in (sym, word, new, rank, best))
            if not len(sym):
                break
        at = np.flatnonzero(rank == best)
        # of pairs that overlap, every second one from the left
        fresh = np.concatenate([[True], (np.diff(at) != 1) | (word[at[1:]] != word[at[:-1]])])
        start = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        take = (at - start) % 2 == 0
        risky = v.risky[new[at]]
        if risky.any():
            far = np.concatenate([[True], (np.diff(at) > 4 * v.reach) | (word[at[1:]] != word[at[:-1]])])
            take = np.where(risky, far, take)
        at = at[take]
        sym[at] = new[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym, word = sym[keep], word[keep]
    if not done_sym:
        return sym, word
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


def merge_places(v: Vocabulary, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As merge_rounds, for long words: rounds in order of rank over all words at once (words do not meet)."""
    n = len(sym)
    sym, ahead, behind, alive = sym.copy(), np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
    made = np.full(n, -1, np.int64)
    waiting: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def look_up(at: np.ndarray) -> None:
        """The pairs that begin at these places, into the lists of their ranks."""
        made[at] = -1
        at = at[ahead[at] < n]
        at = at[word[at] == word[ahead[at]]]
        made[at] = v.pairs(sym[at], sym[ahead[at]])
        at = at[made[at] >= 0]
        rank = v.rank[made[at]]
        order = np.argsort(rank, kind="stable")
        rank = rank[order]
        ends = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for own, r in zip(np.split(at[order], ends), rank[np.concatenate([[0], ends])].tolist() if len(rank) else [], strict=False):
            put(r, own)

    def put(r: int, own: np.ndarray) -> None:
        if r not in waiting:
            waiting[r] = []
            heapq.heappush(ranks, r)
        waiting[r].append(own)

    look_up(np.arange(n))
    while ranks:
        r = heapq.heappop(ranks)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[alive[at] & (made[at] >= 0)]
        at = at[v.rank[made[at]] == r]
        if not len(at):
            continue
        # of pairs that overlap, every second one from the left
        place = np.arange(len(at))
        fresh = np.concatenate([[True], ahead[at[:-1]] != at[1:]])
        take = (place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0
        risky = v.risky[made[at]]
        if risky.any():
            far = np.concatenate([[True], (np.diff(at) > 4 * v.reach) | (word[at[1:]] != word[at[:-1]])])
            take = np.where(risky, far, take)
            if not take.all():
                put(r, at[~take])
        at = at[take]
        gone = ahead[at]
        sym[at], alive[gone], made[gone] = made[at], False, -1
        ahead[at] = ahead[gone]
        inner = ahead[at] < n
        behind[ahead[at[inner]]] = at[inner]
        left = behind[at]
        look_up(np.unique(np.concatenate([left[left >= 0], at])))
    return sym[alive], word[alive]


def merged(v: Vocabulary, sym: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after all merges and their words, in order of words. lengths: symbols of each word."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    long = np.repeat(lengths >= LONG, lengths)
    if not long.any():
        return merge_rounds(v, sym, word)
    parts = (merge_rounds(v, sym[~long], word[~long]), merge_places(v, sym[long], word[long]))
    sym, word = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


def to_ids(v: Vocabulary, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that are no piece become the bytes of their character."""
    odd = np.flatnonzero(sym >= v.size)
    if not len(odd):
        return sym, word
    bytes_of = [chr(c).encode("utf-8", "surrogatepass") for c in (sym[odd] - v.size).tolist()]
    count = np.ones(len(sym), np.int64)
    count[odd] = [len(b) for b in bytes_of]
    out, at = np.repeat(sym, count), np.cumsum(count) - count
    for k, b in zip(at[odd], bytes_of, strict=True):
        out[k : k + len(b)] = v.byte_id[list(b)]
    return out, np.repeat(word, count)


class Codec:
    """Encodes and decodes texts in one worker; remembers words."""

    def __init__(self, v: Vocabulary):
        self.v, self.words, self.older = v.tables(), {}, {}
        self.decimal, self.number = [str(i) for i in range(v.size)], list(range(v.size))
        self.mark = int(v.char_symbol[ord(MARK)])
        self.runs: dict[int, list[int]] = {}

    def split(self, text: str) -> list[str]:
        """Words; each stands for a space mark and its characters, or begins with a newline and has no mark."""
        text = text.replace(MARK, " ")
        return (text.replace("\n", " \n") if self.v.breaks_at_newline else text).split(" ")

    def learn(self, words: list[str]) -> None:
        """Encode the words of a batch that are new; equal ids are one object."""
        if not words:
            return
        lines = [w if self.v.breaks_at_newline and w[:1] == "\n" else MARK + w for w in words]
        flat = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        ids, word = to_ids(self.v, *merged(self.v, self.v.char_symbol[flat], np.array([len(x) for x in lines])))
        ends = np.searchsorted(word, np.arange(len(lines)), "right").tolist()
        ids, a = [self.number[i] for i in ids.tolist()], 0
        for w, b in zip(words, ends, strict=True):
            self.words[w] = tuple(ids[a:b])
            a = b

    def run(self, n: int) -> list[int]:
        """The ids of n marks on their own: full runs from the left, then the rest."""
        if n not in self.runs:
            most = self.v.longest_run
            rest = merge_rounds(self.v, np.full(n % most, self.mark, np.int32), np.zeros(n % most, np.int64))[0].tolist()
            full = merge_rounds(self.v, np.full(most, self.mark, np.int32), np.zeros(most, np.int64))[0].tolist()
            self.runs[n] = full * (n // most) + rest
        return self.runs[n]

    def spaced(self, words: list[str]) -> list[int]:
        """The ids of a text with runs of spaces."""
        out: list[int] = []
        marks = 0
        for empty, group in groupby(words, lambda w: w == ""):
            if empty:
                marks = sum(1 for _ in group)
                continue
            for w in group:
                own = self.words[w]
                if marks and w[:1] != "\n" and own[0] == self.mark:
                    out += self.run(marks + 1)
                    own = own[1:]
                elif marks:
                    out += self.run(marks)
                marks = 0
                out += own
        return out + (self.run(marks) if marks else [])

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids; the mark that encoding put in front goes."""
        piece = self.v.piece_bytes
        return b"".join([piece[i] for i in ids]).removeprefix(b" ")

    def batch(self, texts: list[str]) -> Iterator[tuple[str, list[int], bytes]]:
        """For each text: ids joined by commas, the ids, the decoded text."""
        split = [self.split(t) if t else [] for t in texts]
        new = {w for s in split for w in s if w not in self.words} - {""}
        if len(self.words) + len(new) > WORDS_KEPT:  # one generation is full; words of this batch move on
            self.older, self.words = self.words, {}
            new = {w for s in split for w in s} - {""}
        self.words |= {w: self.older[w] for w in new if w in self.older}
        self.learn(list(new.difference(self.words)))
        known = self.words
        for words in split:
            ids = self.spaced(words) if "" in words else list(chain.from_iterable([known[w] for w in words]))
            yield ",".join([self.decimal[i] for i in ids]), ids, self.decode(ids)


#: A worker's codecs by model file: tables stay, words are forgotten at the end of a task.
_codecs: dict[str, Codec] = {}


def pieces(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Runs (from, rows) of consecutive texts within ROWS_AT_ONCE and BYTES_AT_ONCE."""
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and (held + n > BYTES_AT_ONCE or i - start == ROWS_AT_ONCE):
            yield start, i - start
            start, held = i, 0
        held += n
    if len(lengths) > start:
        yield start, len(lengths) - start


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text", with_ids: bool = False, with_decoded: bool | None = None) -> DataFrame:
    """All columns of docs but the text, and n_tokens, ids_sha256, decoded_sha256; with_ids adds ids (array<int>), with_decoded (as with_ids if not given) decoded (string)."""
    with_decoded = with_ids if with_decoded is None else with_decoded
    modest_batches(docs)
    v = load(model_path)
    rest = [f for f in docs.schema.fields if f.name != text_col and f.name not in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")]
    kept = [F.col(f"`{f.name}`") for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _codecs:
            _codecs[model_path] = Codec(v)
        codec = _codecs[model_path]
        for big in batches:
            for at, n in pieces(pc.fill_null(pc.binary_length(big.column(big.num_columns - 1)), 0).to_pylist()):
                b = big.slice(at, n)
                counts, listed, digests, decoded = [], [], [], []
                for joined, ids, text in codec.batch([x or "" for x in b.column(b.num_columns - 1).to_pylist()]):
                    counts.append(len(ids))
                    digests.append((hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))
                    if with_ids:
                        listed.append(np.array(ids, np.int32))
                    if with_decoded:
                        decoded.append(text.decode("utf-8", "replace"))
                columns = [*b.columns[:-1], pa.array(counts, pa.int64()), *(pa.array([d[k] for d in digests], pa.string()) for k in (0, 1))]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    flat = np.concatenate([np.zeros(0, np.int32), *listed])
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                if with_decoded:
                    columns.append(pa.array(decoded, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        tidy(codec.words, codec.older)

    schema = docs.select(*kept).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    if with_decoded:
        schema = schema.add("decoded", "string")
    names = schema.names
    return docs.select(*kept, F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, schema)
