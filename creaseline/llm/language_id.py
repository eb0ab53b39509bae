"""Operator 3: language identification of mixed-language text.

The script of a word (Unicode ranges) narrows the candidate languages to those that training showed in that script.
Each distinct word gets a score per candidate: the clipped log posterior under hashed character n-grams and the
whole word. Viterbi over the words of a document, with a penalty for each switch, labels spans; neighbouring words
that prefer one language are one step, which changes no optimal path (a path never gains by switching inside such a
run). The document's language is the one whose spans hold most letters; the score is their share.

The model is fitted in numpy on a bounded sample (MAX_PER_LANGUAGE documents a language in expectation, MAX_DOCS in
all, none over MAX_CHARS characters); prediction is one pass over whole texts without a shuffle.

Defined results: null texts and texts without a letter are `und` with score 0; so is everything if nothing could be
learned; words in scripts that training never showed say nothing, and a text of such words only gets the most frequent
language with score 0; ties go to the language that sorts first; repeated rows repeat; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creaseline.llm.blocks import U64, bit_remainder, mix, modest_batches, offsets

MAX_PER_LANGUAGE = 400
MAX_DOCS = 4_000
#: Texts over MAX_CHARS are taken for fitting after all shorter ones of their language, and ALL_CHARS bounds the sample.
MAX_CHARS = 30_000
ALL_CHARS = 40_000_000
TABLE = 1 << 16
NGRAMS = (1, 2, 3, 4)
SWITCH = 8.0
CLIP = 4.0
WORDS_KEPT = 150_000
BLOCK_WORDS = 400_000
#: First and last code point of script ranges.
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF), ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = sorted({s for s, _, _ in SCRIPTS}) + ["other"]
LOWS = np.array([a for _, a, _ in SCRIPTS])
HIGHS = np.array([b for _, _, b in SCRIPTS])
OF_RANGE = np.array([SCRIPT_NAMES.index(s) for s, _, _ in SCRIPTS])
BOUNDARY = 0x7C


def letters(token: str) -> str:
    return token.lower() if token.isalpha() else "".join(c for c in token.lower() if c.isalpha())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of all n-grams and of the whole words, laid end to end; starts of words; scripts of words. No word is empty."""
    flat = np.frombuffer("".join(f"|{w}|" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.array([len(w) + 2 for w in words])
    at = offsets(sizes)
    word = np.repeat(np.arange(len(words)), sizes)
    first = flat[at[:-1] + 1]
    r = np.minimum(np.searchsorted(LOWS, first, "right") - 1, len(LOWS) - 1)
    script = np.where((r >= 0) & (first <= HIGHS[r]), OF_RANGE[r], len(SCRIPT_NAMES) - 1)
    h = mix(flat.astype(U64))
    rows, owner = [], []
    rolling = np.zeros(len(h), U64)
    for n in range(1, max(NGRAMS) + 1):
        rolling = mix(rolling[: len(h) - n + 1] * U64(3) + h[n - 1 :]) if n > 1 else mix(h + U64(1))
        same = word[: len(h) - n + 1] == word[n - 1 :]
        if n == 1:
            same = same & (flat != BOUNDARY)
        rows.append((rolling[same] % U64(TABLE)).astype(np.int64))
        owner.append(word[: len(h) - n + 1][same])
    whole = np.add.reduceat(h * (np.arange(len(h)) - at[word] + 1).astype(U64) ** U64(5), at[:-1])
    rows.append((mix(whole) % U64(TABLE)).astype(np.int64))
    owner.append(np.arange(len(words)))
    rows, owner = np.concatenate(rows), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return rows[order], np.searchsorted(owner[order], np.arange(len(words))), script


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # TABLE x languages: log probabilities of n-grams
    candidate: np.ndarray  # scripts x languages
    usual: int  # the most frequent language

    def scores(self, words: list[str]) -> np.ndarray:
        """Clipped log posteriors (words x languages), 0 where the script says nothing."""
        if not words:
            return np.zeros((0, len(self.languages)), np.float32)
        rows, starts, script = features(words)
        sums = np.add.reduceat(self.table[rows], starts, axis=0)
        may = self.candidate[script]
        sums = np.where(may, sums, -1e9)
        best = np.maximum(sums - sums.max(1, keepdims=True), -CLIP)
        best = np.where(may, best, -2 * CLIP)
        return np.where(may.any(1, keepdims=True), best, 0).astype(np.float32)


def train(texts: list[str], langs: list[str]) -> Model:
    languages = sorted(set(langs))
    counts = np.full((TABLE, len(languages)), 0.0)
    by_script = np.zeros((len(SCRIPT_NAMES), len(languages)))
    for k, lang in enumerate(languages):
        words = [w for t, x in zip(texts, langs, strict=True) if x == lang for token in t.split() if (w := letters(token))]
        if words:
            rows, _, script = features(words)
            counts[:, k] = np.bincount(rows, minlength=TABLE)
            by_script[:, k] = np.bincount(script, minlength=len(SCRIPT_NAMES))
    table = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * TABLE)).astype(np.float32)
    table -= table.max(1, keepdims=True)
    share = by_script / np.maximum(1, by_script.sum(0))
    return Model(languages, table, share >= 0.01, int(np.argmax([langs.count(x) for x in languages])) if languages else 0)


def viterbi(steps: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Best label of each step. steps: steps of all documents x languages; at: document offsets. All documents advance together."""
    lengths = np.diff(at)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = at[:-1][order], lengths[order]
    longest = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    came = np.zeros(steps.shape, np.int16)
    value = np.zeros((len(order), steps.shape[1]), np.float32)
    own = np.arange(steps.shape[1], dtype=np.int16)
    for t in range(longest):
        n = active[t]
        now = starts[:n] + t
        v = value[:n]
        if t:
            top = v.argmax(1)
            change = v[np.arange(n), top] - SWITCH
            switch = change[:, None] > v
            came[now] = np.where(switch, top[:, None].astype(np.int16), own)
            v = np.where(switch, change[:, None], v)
        value[:n] = v + steps[now]
    label = np.zeros(len(steps), np.int16)
    state = value.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        now = starts[:n] + t
        label[now] = state[:n]
        state[:n] = came[now, state[:n]]
    return label


class Reader:
    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.score = np.zeros((1, len(model.languages)), np.float32)
        self.size = [0]

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """Word numbers of each text; words without a letter are 0."""
        if len(self.known) > WORDS_KEPT:
            self.__init__(self.model)
        split = [t.split() for t in texts]
        fresh = list({w for s in split for w in s if w not in self.known})
        plain = [letters(w) for w in fresh]
        self.score = np.concatenate([self.score, self.model.scores([p for p in plain if p])])
        for w, p in zip(fresh, plain, strict=True):
            self.known[w] = len(self.size) if p else 0
            if p:
                self.size.append(len(p))
        get = self.known.__getitem__
        return [np.fromiter(map(get, s), np.int64, len(s)) for s in split]


def predict(reader: Reader, texts: list[str]) -> tuple[list[str], list[float], list[str]]:
    """Language, score and spans (lang:first word:end, comma-joined) of each text."""
    model, k = reader.model, len(reader.model.languages)
    lang, score, spans = ["und"] * len(texts), [0.0] * len(texts), [""] * len(texts)
    if not k:
        return lang, score, spans
    numbers = reader.numbers(texts)
    keep = [np.flatnonzero(n) for n in numbers]
    words = np.concatenate([n[i] for n, i in zip(numbers, keep, strict=True)]) if texts else np.zeros(0, np.int64)
    place = np.concatenate(keep) if texts else words
    at = offsets([len(i) for i in keep])
    if not len(words):
        return lang, score, spans
    e = reader.score[words]
    best = e.argmax(1)
    begins = np.ones(len(words), bool)
    begins[1:] = best[1:] != best[:-1]
    begins[at[:-1][np.diff(at) > 0]] = True
    runs = np.flatnonzero(begins)
    run_at = np.searchsorted(runs, at)
    label = viterbi(np.add.reduceat(e, runs, axis=0), run_at)
    label = np.repeat(label, np.diff(np.concatenate([runs, [len(words)]])))
    size = np.array(reader.size)[words]
    informed = (e != 0).any(1)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    total = np.bincount(doc, size, len(texts))
    held = np.bincount(doc * k + label, size * informed, len(texts) * k).reshape(-1, k)
    top = np.where(held.max(1) > 0, held.argmax(1), model.usual)
    edge = np.ones(len(words), bool)
    edge[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
    edge = np.flatnonzero(edge)
    ends = np.concatenate([edge[1:], [len(words)]]) - 1
    told: list[list[str]] = [[] for _ in texts]
    for d, x, a, z in zip(doc[edge].tolist(), label[edge].tolist(), place[edge].tolist(), place[ends].tolist(), strict=True):
        told[d].append(f"{model.languages[x]}:{a}:{z + 1}")
    for d in np.flatnonzero(total > 0).tolist():
        lang[d], score[d], spans[d] = model.languages[top[d]], float(held[d, top[d]] / total[d]), ",".join(told[d])
    return lang, score, spans


def fit(docs: DataFrame, may_learn: F.Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on a sample by hash of the id, with a rate for each language that bounds its expected size.

    Of several rows of one id and language the text that sorts first counts, and each language has its own bound; a
    language gives at least one text, however long its texts are.
    """
    usable = docs.where(may_learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in usable.select(id_col, lang_col).distinct().groupBy(lang_col).agg(F.count(F.lit(1))).collect()}
    if not counts:
        return Model([], np.zeros((TABLE, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool), 0)
    each = min(MAX_PER_LANGUAGE, max(1, MAX_DOCS // len(counts)))
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1_000_000))
    drawn = F.lit(False)
    for lang, n in counts.items():
        drawn = drawn | ((F.col(lang_col) == lang) & (part < int(1_000_000 * min(1.0, each / n))))
    one = usable.where(drawn).groupBy(id_col, lang_col).agg(F.min(text_col).alias(text_col)).withColumn("__chars", F.length(text_col))
    order = Window.partitionBy(lang_col).orderBy(F.greatest(F.col("__chars"), F.lit(MAX_CHARS)), F.xxhash64(text_col), text_col)
    ranked = one.withColumns({"__rank": F.row_number().over(order), "__sum": F.sum("__chars").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    fits = (F.col("__rank") == 1) | ((F.col("__rank") <= 2 * each) & (F.col("__sum") <= ALL_CHARS // len(counts)))
    sample = ranked.where(fits).select(text_col, lang_col).orderBy(F.xxhash64(text_col), text_col).collect()
    return train([r[0] for r in sample], [r[1] for r in sample])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of docs but the text, and lang_pred, score, spans."""
    modest_batches(docs)
    rest = [f.name for f in docs.schema.fields if f.name not in (text_col, "lang_pred", "score", "spans")]
    kept = [F.col(f"`{n}`") for n in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            found: tuple[list, list, list] = ([], [], [])
            at, size = 0, 0
            for z, t in enumerate(texts, 1):
                size += len(t)
                if size >= 6 * BLOCK_WORDS or z == len(texts):
                    for a, x in zip(found, predict(reader, texts[at:z]), strict=True):
                        a.extend(x)
                    at, size = z, 0
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()), pa.array(found[2], pa.string())], names=names)

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("spans", "string")
    names = schema.names
    return docs.select(*kept, F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> F.Column:
    return bit_remainder(id_col, 3) == 1
