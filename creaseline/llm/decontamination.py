"""Operator 6: benchmark decontamination by template canonicalisation.

Words become a template: numbers, units and names give typed placeholders, other words their lower-case form without
outer punctuation. Numbers may be written out (twenty, twenty-five); slots hold their value, so that seven and 7 are the
same one, and a match is verbatim if no slot's value was exchanged. A unit that is glued to its number (60km) is split
off. A word with a capital is a name inside a
sentence; at the start of one it is a name unless the benchmark also writes it in lower case (The, What). Windows of WIDTH
template words are hashed; document windows are hash-joined in Spark with those of the benchmark. Joined windows of one
document and item that lie on one diagonal make a match; its slots must be consistent: one value of the item always
stands for one value of the document, and the other way round. So a copied question is found although its numbers and
names were exchanged, and a text that only shares a form is not.

A template window needs at least half of its words not to be placeholders. The first word of an item is tried both as
a plain word and as a name, because a document may hold it inside a sentence. Beside the template windows all windows
of the literal words (lower case, no outer punctuation) are joined, so that verbatim copies match however many
placeholders they have. A third form makes one placeholder of neighbouring name words, and of neighbouring numbers, with
no punctuation between them, so that a name or number may be exchanged for one of another number of words (two hundred
is 200; a number with "and" in it is two numbers). Each form is
a match of its own. It counts from half of the item's usable windows of that form on, if they also cover half of the item;
of the literal form a run of RUN_WORDS words is enough, as benchmarks are commonly checked by n-grams of that length.
Items shorter than WIDTH are one window of their own length; under SHORTEST words they match literally only.

Scans hash words once per task and distinct word. What the benchmark holds travels to them as two bitmaps of fixed
size: FILTER_BITS bits of the hashes of its windows, so that few other windows are shuffled, and WORD_BITS bits of the
hashes of its lower-case words. A window that passes by chance finds nothing in the join.

Defined results: only contaminated (document, item) pairs are returned, once each; item_windows are the usable windows
of the form that matched best; null and empty texts and items without a letter or digit match nothing;
repeated rows of one doc_id count once; rows without a doc_id are told apart by their texts and returned one by one
with a null id, and so are items without an item_id; windows of different rows never add up; empty tables give an empty
result; other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.blocks import U64, Remembered, as_bytes, cut, modest_batches, offsets, rabin_karp, row_key, scaled, tidy

WIDTH = 8
SHORTEST = 4
COVERAGE = 0.5
RUN_WORDS = 13
#: Sizes of the bitmaps, as powers of two; a segment of 2^15 bits is put together in one group.
FILTER_BITS, WORD_BITS, SEGMENT_BITS = 26, 20, 15
BLOCK_BYTES = 1_200_000
#: Words read as units.
UNITS = frozenset("mm cm m km in ft yd mi mile miles mg g kg t lb lbs oz ml cl l s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kmh kph hz khz mhz ghz w kw mw v kv a c f k pa bar j kj cal kcal b kb mb gb tb usd eur gbp dollar dollars cent cents euro euros pound pounds percent pct degree degrees".split())
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?(st|nd|rd|th)?$")
GLUED = re.compile(rb"(?<![A-Za-z0-9])(\d[\d.,]*)(" + b"|".join(sorted((u.encode() for u in UNITS), key=lambda u: (-len(u), u))) + rb")(?![A-Za-z0-9])", re.IGNORECASE)
#: Numbers that are written out.
SPOKEN = {w: n for n, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
SPOKEN |= {w: 10 * n for n, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)} | {"hundred": 100, "thousand": 10**3, "million": 10**6, "billion": 10**9}
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…¿¡—–·"
ENDS = b".!?:"
# a remembered word is 60 bits of hash, its kind, whether it ends a sentence and whether no punctuation follows it
PLAIN, NUMBER_WORD, UNIT, NAME_LIKE = range(4)
KIND, ENDS_SENTENCE, OPEN, FLAGS = U64(3), U64(4), U64(8), U64(15)
PLACEHOLDERS = np.array([0, 16, 32, 48], U64)
WORDLESS = U64(xxhash.xxh3_64_intdigest("")) & ~FLAGS
WIDTH_SALT = U64(0x9FB21C651E98DF25)
# forms of windows: the hashes of different forms never meet
LITERAL, TEMPLATE, COLLAPSED = range(3)
FORM_SALT = U64(0xD6E8FEB86659FD93)
FIRST_IS_NAME = 10


def spoken(words: list[str]) -> int | None:
    """The number that words spell (two hundred, twenty-five), None if they spell none or several."""
    whole = part = 0
    scale = 10**12
    for word in (p for w in words for p in w.lower().split("-")):
        n = SPOKEN.get(word)
        if n is None:
            return None
        if n >= 1000:
            if n >= scale:
                return None
            whole, part, scale = whole + max(part, 1) * n, 0, n
        elif n == 100:
            if part >= 100:
                return None
            part = max(part, 1) * 100
        elif part % 100 and not (part % 100 >= 20 and part % 10 == 0 and 0 < n < 10):
            return None
        else:
            part += n
    return whole + part if words else None


class Templates(Remembered):
    """bytes word -> template hash with flags."""

    def compute(self, word: bytes) -> int:
        shown = word.decode("utf-8", "replace").strip(PUNCTUATION)
        plain = shown.lower()
        ends = int(ENDS_SENTENCE) if word.rstrip(b"\"')]}")[-1:] in ENDS and word else 0
        if shown and (NUMBER.match(shown) or spoken([plain]) is not None):
            kind = NUMBER_WORD
        elif plain in UNITS and len(plain) > 1:
            kind = UNIT
        else:
            kind = NAME_LIKE if shown[:1].isupper() and not shown.isupper() else PLAIN
        open_ = int(OPEN) if shown and word.decode("utf-8", "replace").endswith(shown) else 0
        return xxhash.xxh3_64_intdigest(plain) & ~int(FLAGS) | kind | ends | open_


cache = Templates()


class Form(NamedTuple):
    """Texts as hashes laid end to end: which are slots, where the texts begin, and the first word of each hash."""

    number: int
    hashes: np.ndarray
    slot: np.ndarray
    doc: np.ndarray
    word: np.ndarray


def bits_at(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & np.uint8(1) > 0


def templates(h: np.ndarray, doc: np.ndarray, plain_words: np.ndarray, first_is_name: bool | None) -> tuple[np.ndarray, np.ndarray]:
    """Template words and whether they are slots. first_is_name decides on the first word of a text; None leaves it to the rule."""
    kind = (h & KIND).astype(np.int64)
    begins = np.ones(len(h), bool)
    begins[1:] = (h[:-1] & ENDS_SENTENCE) > 0
    first = doc[:-1][doc[:-1] < len(h)]
    begins[first] = True
    name = (kind == NAME_LIKE) & ~(begins & bits_at(plain_words, (h >> U64(64 - WORD_BITS)).astype(np.int64)))
    if first_is_name is not None:
        name[first] = (kind[first] == NAME_LIKE) & first_is_name
    slot = (kind == NUMBER_WORD) | (kind == UNIT) | name
    return np.where(slot, PLACEHOLDERS[kind], h & ~FLAGS), slot


def forms(h: np.ndarray, doc: np.ndarray, plain_words: np.ndarray, whole: bool) -> Iterator[Form]:
    word = np.arange(len(h) + 1)
    yield Form(LITERAL, h & ~FLAGS, np.zeros(len(h), bool), doc, word)
    for first_is_name in (False, True) if whole else (None,):
        template, slot = templates(h, doc, plain_words, first_is_name)
        yield Form(TEMPLATE + FIRST_IS_NAME * bool(first_is_name), template, slot, doc, word)
        joins = np.zeros(len(h), bool)
        joins[1:] = (template[1:] == template[:-1]) & slot[1:] & slot[:-1] & (template[1:] != PLACEHOLDERS[UNIT]) & ((h[:-1] & OPEN) > 0)
        joins[doc[:-1][doc[:-1] < len(h)]] = False
        first = np.flatnonzero(~joins)
        yield Form(COLLAPSED + FIRST_IS_NAME * bool(first_is_name), template[first], slot[first], np.searchsorted(first, doc), np.append(first, len(h)))


def windows(form: Form, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows that stay in a document and have enough words that are no slots."""
    n = len(form.hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    kind = form.number % FIRST_IS_NAME
    unfit = np.concatenate([[0], np.cumsum(form.hashes == WORDLESS if kind == LITERAL else form.slot)])
    unfit = unfit[width:] - unfit[:-width]
    ok = unfit < width if kind == LITERAL else 2 * unfit <= width
    last = np.repeat(form.doc[1:], np.diff(form.doc))[:n]
    ok &= np.arange(n) + width <= last
    return np.flatnonzero(ok), (rabin_karp(form.hashes, width) + scaled(width, WIDTH_SALT) + scaled(kind, FORM_SALT))[ok]


def shown(words: list[bytes]) -> str:
    """What a slot holds: its words, or the value of a number that is written out."""
    plain = [w.decode("utf-8", "replace").strip(PUNCTUATION) for w in words]
    number = spoken(plain)
    return " ".join(plain) if number is None else str(number)


def window_rows(keys: list[pa.Array], texts: list[bytes], widths: dict[int, list[int]], held: np.ndarray | None, plain_words: np.ndarray, whole: bool) -> pa.RecordBatch:
    """Rows of the windows of a block of texts. widths: by form; held: the bitmap of windows; whole: a text shorter than WIDTH is one window."""
    words = [GLUED.sub(rb"\1 \2", t).split() for t in texts]
    doc = offsets([len(w) for w in words])
    flat = [w for own in words for w in own]
    h = np.fromiter(map(cache.__getitem__, flat), U64, len(flat))
    owner, number, usable, length, wide, pos, hash_, slots = [], [], [], [], [], [], [], []
    for form in forms(h, doc, plain_words, whole):
        kind = form.number % FIRST_IS_NAME
        lengths = np.diff(form.doc)
        found = []
        for width in widths.get(kind, []) if not whole else sorted({WIDTH, *(int(n) for n in lengths if (1 if kind == LITERAL else SHORTEST) <= n < WIDTH)}):
            at, hashes = windows(form, width)
            if held is not None:
                hit = bits_at(held, (hashes >> U64(64 - FILTER_BITS)).astype(np.int64))
                at, hashes = at[hit], hashes[hit]
            d = np.searchsorted(form.doc, at, "right") - 1
            if whole:
                fits = lengths[d] == width if width < WIDTH else np.ones(len(d), bool)
                if form.number >= FIRST_IS_NAME:
                    fits &= (h[doc[d]] & KIND) == NAME_LIKE  # else as without it
                at, hashes, d = at[fits], hashes[fits], d[fits]
            elif kind == LITERAL and width < WIDTH and len(d):
                # a whole item: one place in a document is enough
                first = np.unique(np.stack([d.view(U64), hashes], 1), axis=0, return_index=True)[1]
                at, hashes, d = at[first], hashes[first], d[first]
            found.append((at, hashes, d, width))
        count = sum(np.bincount(d, minlength=len(texts)) for _, _, d, _ in found)
        for at, hashes, d, width in found:
            for x, i, v in zip(d.tolist(), at.tolist(), hashes.view(np.int64).tolist(), strict=True):
                owner.append(x)
                number.append(form.number)
                usable.append(int(count[x]))
                length.append(int(lengths[x]))
                wide.append(width)
                pos.append(i - int(form.doc[x]))
                hash_.append(v)
                slots.append([shown(flat[form.word[j] : form.word[j + 1]]) for j in (np.flatnonzero(form.slot[i : i + width]) + i).tolist()])
    numbers = [pa.array(x, pa.int64()) for x in (number, usable, length, wide, pos, hash_)]
    owners = pa.array(owner, pa.int64())
    return pa.RecordBatch.from_arrays([*(k.take(owners) for k in keys), *numbers, pa.array(slots, pa.list_(pa.string()))], names=["id", "row", "form", "n_windows", "length", "width", "pos", "hash", "slots"])


def scan(df: DataFrame, widths: dict[int, list[int]], held: np.ndarray | None, plain_words: np.ndarray, whole: bool) -> DataFrame:
    """Rows of windows of df (id, row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = as_bytes(b.column(2))
            at, size = 0, 0
            for z, t in enumerate(texts, 1):
                size += len(t)
                if size >= BLOCK_BYTES or z == len(texts):
                    yield window_rows([b.column(k).slice(at, z - at) for k in (0, 1)], texts[at:z], widths, held, plain_words, whole)
                    at, size = z, 0
        tidy(cache)

    return df.mapInArrow(run, "id long, row long, form long, n_windows long, length long, width long, pos long, hash long, slots array<string>")


def bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2^bits bits in which the given places (a column `place`) are set, put together in segments of fixed size."""

    def segment(key: tuple, table: pa.Table) -> pa.Table:
        own = np.zeros(1 << SEGMENT_BITS, bool)
        own[table.column("place").to_numpy() & ((1 << SEGMENT_BITS) - 1)] = True
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (SEGMENT_BITS - 3)
    found = places.distinct().withColumn("segment", F.shiftright("place", SEGMENT_BITS)).groupBy("segment").applyInArrow(segment, "segment long, bits binary")
    for r in found.toLocalIterator():  # at most 2^(bits - SEGMENT_BITS) rows of `size` bytes
        out[r["segment"] * size : (r["segment"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def lower_words(items: DataFrame) -> np.ndarray:
    """The bitmap of the words that the benchmark writes in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = {w for t in as_bytes(b.column(0)) for w in GLUED.sub(rb"\1 \2", t).split()}
            h = np.array([cache[w] for w in words], U64)
            h = h[(h & KIND) == PLAIN]
            yield pa.RecordBatch.from_arrays([pa.array((h >> U64(64 - WORD_BITS)).astype(np.int64))], names=["place"])
        tidy(cache)

    return bitmap(items.select("text").mapInArrow(run, "place long"), WORD_BITS)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, matched_windows, item_windows, verbatim: contaminated pairs."""
    modest_batches(docs)
    own = lambda df, key: df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).select("id", row_key("id", "text").alias("row"), "text")
    docs, items = own(docs, id_col), own(benchmark, item_col)
    plain_words = lower_words(items)
    names = {"id": "item_id", "row": "item_row", "pos": "item_pos", "slots": "item_slots", "n_windows": "item_windows"}
    items = cut(scan(items, {}, None, plain_words, True).withColumnsRenamed(names))
    widths: dict[int, list[int]] = {}
    for r in items.select((F.col("form") % FIRST_IS_NAME).alias("form"), "width").distinct().orderBy("form", "width").collect():
        widths.setdefault(r["form"], []).append(r["width"])  # three forms, WIDTH widths
    held = bitmap(items.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("place")), FILTER_BITS)
    found = scan(docs, widths, held, plain_words, False).select(F.col("id").alias("doc_id"), F.col("row").alias("doc_row"), "pos", "hash", "slots")
    joined = found.join(items, "hash")
    match = joined.groupBy("doc_id", "doc_row", "item_id", "item_row", "form", (F.col("pos") - F.col("item_pos")).alias("diagonal")).agg(
        F.count_distinct("item_pos").alias("matched_windows"),
        F.max("item_windows").alias("item_windows"),
        F.max("length").alias("length"),
        F.max("width").alias("width"),
        F.sort_array(F.collect_set("item_pos")).alias("at"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "slots")))).alias("pairs"),
    )
    pairs = F.size("pairs")
    consistent = (F.size(F.array_distinct("pairs.item_slots")) == pairs) & (F.size(F.array_distinct("pairs.slots")) == pairs)
    steps = F.transform("at", lambda p, i: F.when(i == 0, F.col("width")).otherwise(F.least(F.col("width"), p - F.get("at", i - 1))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, n: a + n)
    run = (F.col("form") == LITERAL) & (F.col("matched_windows") > RUN_WORDS - WIDTH)
    enough = ((F.col("matched_windows") >= coverage * F.col("item_windows")) & (covered >= coverage * F.col("length"))) | run
    best = F.max(F.struct("matched_windows", F.forall("pairs", lambda p: p["item_slots"] == p["slots"]).alias("verbatim"), "item_windows")).alias("best")
    apart = lambda key, row: F.when(F.col(key).isNull(), F.col(row))
    whole = match.where(consistent & enough).groupBy("doc_id", apart("doc_id", "doc_row").alias("r"), "item_id", apart("item_id", "item_row").alias("i")).agg(best)
    return whole.select("doc_id", "item_id", "best.matched_windows", "best.item_windows", "best.verbatim")
