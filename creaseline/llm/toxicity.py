"""Operator 10: toxicity by a convolutional text classifier in numpy.

Words become sums of hashed embedding rows (the word and its first three, four and five letters). Filters of widths
one to three run over every position of the whole text, max pooling keeps each filter's best position, and a logistic
layer scores the document. Training is plain numpy on a bounded sample: the MAX_PER_CLASS labelled documents of each
class with the smallest hash of doc_id, none over MAX_CHARS characters; of several texts of one doc_id the one that
sorts first. Embeddings start from how much more often a
row occurs in toxic documents of the sample; gradients then flow through the pooled positions.

Thresholds are calibrated by language on a part of the sample held back from fitting, with classes weighted to their
share among all labels. Which language a text is in is guessed from its words, by how often the sample's documents of
each language hold them; only the sample's own lang values teach that, and no lang is read when texts are scored. The
score is shifted so that 0.5 is that threshold.

Scoring is one pass without a shuffle: each distinct word's filter responses are computed once while a worker
remembers it.

Defined results: null, empty and wordless texts get the score of a text without any word; repeated rows get equal
scores; labels that are null are no labels, and if rows of one doc_id disagree the document counts as toxic;
without any usable label, or with one class only, every score is 0 (or 1 if all labels are toxic); other columns do
not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.blocks import bit_remainder, modest_batches, offsets, tidy

MAX_PER_CLASS = 1500
MAX_CHARS = 40_000
ROWS = 1 << 16
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 6
PADS = 3
WORDS_KEPT = 150_000
BLOCK_CHARS = 300_000
#: Languages that a threshold may be learned for: the most frequent of the sample.
MAX_LANGUAGES = 16
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…¿¡—–·"


def word_rows(word: str) -> tuple[int, int, int, int]:
    """Embedding rows of a lower-case word; row 0 stays zero."""
    hashed = lambda x, seed: 1 + xxhash.xxh3_64_intdigest(x, seed) % (ROWS - 1)
    return hashed(word, 1), hashed(word[:3], 2), hashed(word[:4], 3), hashed(word[:5], 4)


@dataclass
class Model:
    embedding: np.ndarray  # ROWS x DIM
    filters: list[np.ndarray]  # for each width: width x DIM x FILTERS
    bias: np.ndarray  # of the filters
    dense: np.ndarray
    constant: float
    languages: list[str]
    speaks: np.ndarray  # ROWS x languages: how much a word (by its own row) speaks for each
    threshold: dict[str, float]  # logit by language, "" for the rest
    fixed: float | None = None  # the score of a model that has seen one class

    def responses(self, rows: np.ndarray) -> np.ndarray:
        """What a word with these embedding rows adds to each filter at each offset: words x (sum of widths * FILTERS)."""
        x = self.embedding[rows].sum(axis=1)
        return np.concatenate([x @ w[j] for w in self.filters for j in range(len(w))], axis=1).astype(np.float32)


class Reader:
    """Turns texts into word numbers; remembers words and their embedding rows."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.rows: list[tuple[int, int, int, int]] = [(0, 0, 0, 0)]

    def numbers(self, text: str) -> np.ndarray:
        words, known = text.split(), self.known
        for w in set(words).difference(known):
            plain = w.strip(PUNCTUATION).lower()
            known[w] = len(self.rows)
            self.rows.append(word_rows(plain) if plain else (0, 0, 0, 0))
        return np.fromiter(map(known.__getitem__, words), np.int32, len(words))


class Scorer:
    """Scores texts in one task; what a word adds is computed once while the word is remembered."""

    def __init__(self, model: Model):
        self.model, self.reader, self.done = model, Reader(), 0
        self.response = np.zeros((0, sum(WIDTHS) * FILTERS), np.float32)
        self.speaks = np.zeros((0, len(model.languages)), np.float32)

    def learn(self) -> None:
        new = np.array(self.reader.rows[self.done :])
        if not len(new):
            return
        self.response, self.speaks = (grown(table, self.done, own) for table, own in ((self.response, self.model.responses(new)), (self.speaks, self.model.speaks[new[:, 0]])))
        self.done += len(new)

    def logits(self, texts: list[str]) -> np.ndarray:
        """Logits above the threshold of each text's language."""
        if len(self.reader.known) > WORDS_KEPT:
            self.__init__(self.model)
        flat, at = lay_out([self.reader.numbers(t) for t in texts])
        self.learn()
        cut = [self.model.threshold.get(lang, self.model.threshold[""]) for lang in guessed(self.model.languages, self.speaks[flat], at)]
        return logits(self.model, pooled(self.response, flat, at)) - np.array(cut)


def grown(table: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """table with more rows behind the used ones; its room doubles when it is full."""
    if used + len(more) > len(table):
        table = np.concatenate([table[:used], np.zeros((used + len(more), table.shape[1]), table.dtype)])
    table[used : used + len(more)] = more
    return table


def guessed(languages: list[str], speaks: np.ndarray, at: np.ndarray) -> list[str]:
    """The language that the words of each document speak for, "" if none does. speaks: of each word laid out."""
    if not languages:
        return [""] * (len(at) - 1)
    total = np.add.reduceat(speaks, at[:-1], axis=0) if len(at) > 1 else speaks[:0]
    return [languages[k] if c > 0 else "" for k, c in zip(total.argmax(1).tolist(), np.abs(total).max(1).tolist(), strict=True)]


def language_words(rows: np.ndarray, numbers: list[np.ndarray], langs: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Languages, and for each embedding row the log share of documents with it by language, above the mean; at most 3 a word."""
    named = [x for x in langs if x]
    languages = sorted(set(named), key=lambda x: (-named.count(x), x))[:MAX_LANGUAGES]
    seen, docs = np.zeros((ROWS, len(languages)), np.float32), np.zeros(len(languages))
    for own, lang in zip(numbers, langs, strict=True):
        if lang in languages:
            k = languages.index(lang)
            seen[np.unique(rows[np.unique(own), 0]), k] += 1
            docs[k] += 1
    share = np.log((seen + 0.5) / (docs + 1).astype(np.float32)) if languages else seen
    speaks = np.clip(share - share.mean(1, keepdims=True), -3, 3).astype(np.float32) if languages else seen
    speaks[seen.sum(1) == 0] = 0
    speaks[0] = 0
    return languages, speaks


def lay_out(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents end to end, PADS zero words after each; starts of documents (and the end)."""
    at = offsets([len(x) + PADS for x in numbers])
    flat = np.zeros(at[-1], np.int32)
    for x, a in zip(numbers, at, strict=False):
        flat[a : a + len(x)] = x
    return flat, at


def pooled(response: np.ndarray, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Max over positions of each filter: documents x filters. A filter looks at the position and those after it."""
    g = response[flat]
    bounds = np.stack([at[:-1], at[1:] - PADS + 1], 1).ravel()  # the first pad counts: texts may be empty
    out, column = [], 0
    for width in WIDTHS:
        z = g[:, column : column + FILTERS]
        for j in range(1, width):
            z = z[: len(g) - width + 1] + g[j : len(g) - width + 1 + j, column + j * FILTERS : column + (j + 1) * FILTERS] if j == 1 else z + g[j : len(g) - width + 1 + j, column + j * FILTERS : column + (j + 1) * FILTERS]
        out.append(np.maximum.reduceat(z, np.minimum(bounds, len(z) - 1), axis=0)[::2])
        column += width * FILTERS
    return np.concatenate(out, axis=1)


def logits(model: Model, features: np.ndarray) -> np.ndarray:
    return np.maximum(features + model.bias, 0) @ model.dense + model.constant


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(texts: list[str], toxic: list[int], share: float, langs: list[str | None] | None = None, seed: int = 7) -> Model:
    """Fit on four fifths of the sample, set thresholds on the rest. share: of toxic among all labels; langs: of the texts."""
    y = np.array(toxic, np.float32)
    empty = Model(np.zeros((ROWS, DIM), np.float32), [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS], np.zeros(len(WIDTHS) * FILTERS, np.float32), np.zeros(len(WIDTHS) * FILTERS, np.float32), 0.0, [], np.zeros((ROWS, 0), np.float32), {"": 0.0})
    if len(set(toxic)) < 2:
        empty.fixed = float(y[0]) if len(y) else 0.0
        return empty
    rng, reader = np.random.default_rng(seed), Reader()
    numbers = [reader.numbers(t) for t in texts]
    rows = np.array(reader.rows)
    held = np.zeros(len(y), bool)
    for label in (0, 1):  # every fifth of each class
        held[np.flatnonzero(y == label)[4::5]] = True
    # how much more often an embedding row occurs in toxic documents
    seen = np.zeros((2, ROWS))
    for i in np.flatnonzero(~held):
        seen[int(y[i]), np.unique(rows[np.unique(numbers[i])])] += 1
    n0, n1 = (~held & (y == 0)).sum(), (~held & (y == 1)).sum()
    odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
    total = seen.sum(0)
    model = empty
    model.embedding = (rng.standard_normal((ROWS, DIM)) * 0.01).astype(np.float32)
    model.embedding[:, 0] = 0.25 * odds * total / (total + 3)
    model.embedding[0] = 0
    model.filters = [(rng.standard_normal((w, DIM, FILTERS)) * 0.05).astype(np.float32) for w in WIDTHS]
    for w in model.filters:
        w[:, 0, :] += rng.uniform(0.5, 1.0, (len(w), FILTERS)) / len(w)
    model.dense = np.full(len(WIDTHS) * FILTERS, 1.5 / len(WIDTHS) / FILTERS, np.float32)
    model.constant = -1.0
    column_of = [(k, f) for k in range(len(WIDTHS)) for f in range(FILTERS)]
    fit = np.flatnonzero(~held)
    weight = np.where(y == 1, len(fit) / 2 / n1, len(fit) / 2 / n0)
    for epoch in range(EPOCHS):
        rate = 0.5 / (1 + epoch)
        rng.shuffle(fit)
        for own in np.array_split(fit, max(1, len(fit) // 32)):
            flat, at = lay_out([numbers[i] for i in own])
            distinct, back = np.unique(flat, return_inverse=True)
            x = model.embedding[rows[distinct]].sum(1)[back]
            best, value = [], []
            for k, width in enumerate(WIDTHS):
                z = sum(x[j : len(x) - width + 1 + j] @ model.filters[k][j] for j in range(width))
                for a, b in zip(at[:-1], at[1:] - PADS + 1, strict=True):
                    p = z[a:b].argmax(0)
                    best.append(a + p)
                    value.append(z[a:b].max(0))
            n = len(own)
            best = np.concatenate([np.array(best[k * n : (k + 1) * n]) for k in range(len(WIDTHS))], 1)
            feature = np.concatenate([np.array(value[k * n : (k + 1) * n]) for k in range(len(WIDTHS))], 1) + model.bias
            active = np.maximum(feature, 0)
            error = ((sigmoid(active @ model.dense + model.constant) - y[own]) * weight[own] / n).astype(np.float32)
            back_to = error[:, None] * model.dense * (feature > 0)
            model.dense = model.dense - rate * (active.T @ error + 1e-4 * model.dense)
            model.constant -= rate * float(error.sum())
            model.bias = model.bias - rate * back_to.sum(0)
            for c, (k, f) in enumerate(column_of):
                for j in range(WIDTHS[k]):
                    places = best[:, c] + j
                    step = rate * back_to[:, c]
                    down = model.filters[k][j][:, f].copy()
                    model.filters[k][j][:, f] -= x[places].T @ step
                    np.add.at(model.embedding, rows[flat[places]], -(step[:, None] * down)[:, None, :])
            model.embedding[0] = 0
    response = model.responses(rows)
    known = [None if h else x for x, h in zip(langs or [None] * len(y), held.tolist(), strict=True)]
    model.languages, model.speaks = language_words(rows, numbers, known)
    test = np.flatnonzero(held)
    if len(test):
        flat, at = lay_out([numbers[i] for i in test])
        z = logits(model, pooled(response, flat, at))
        speech = np.array(guessed(model.languages, model.speaks[rows[flat, 0]], at))
        model.threshold[""] = threshold(z, y[test], share)
        for lang in model.languages:
            own = speech == lang
            if (y[test][own] == 1).sum() >= 10 and (y[test][own] == 0).sum() >= 10:
                model.threshold[lang] = threshold(z[own], y[test][own], share)
    return model


def threshold(z: np.ndarray, y: np.ndarray, share: float) -> float:
    """The cut with fewest weighted errors; of equal cuts the middle."""
    w = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    order = np.argsort(z)
    z, y, w = z[order], y[order], w[order]
    errors = np.concatenate([[0], np.cumsum(np.where(y == 1, w, 0))]) + np.concatenate([np.cumsum(np.where(y == 0, w, 0)[::-1])[::-1], [0]])
    cuts = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
    good = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(cuts[good[len(good) // 2]])


def fit(docs: DataFrame, labels: DataFrame, may_learn: F.Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang") -> Model:
    """Train on the bounded sample of labelled documents that may_learn admits. Without a lang column there is one threshold."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & may_learn).groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picks = None
    for label in (0, 1):
        own = known.where(F.col("y") == label).orderBy(F.xxhash64(id_col), id_col).limit(MAX_PER_CLASS)
        picks = own if picks is None else picks.unionByName(own)
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    texts = docs.where(F.coalesce(F.length(text_col), F.lit(0)).between(1, MAX_CHARS)).select(id_col, F.struct(F.col(text_col).alias("text"), lang.alias("lang")).alias("t"))
    # at most 2 * MAX_PER_CLASS ids: a proven bound for the broadcast, and with one row for each id for the sample
    one = texts.join(F.broadcast(picks), id_col).groupBy(id_col).agg(F.max("y").alias("y"), F.min("t").alias("t"))
    sample = one.orderBy(F.xxhash64(id_col), id_col).collect()
    return train([r["t"]["text"] for r in sample], [r["y"] for r in sample], counts.get(1, 0) / max(1, sum(counts.values())), [r["t"]["lang"] for r in sample])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score", predicted_col: str = "predicted", keep_text: bool = False) -> DataFrame:
    """All columns of docs (the text only with keep_text), and score (0 to 1) and predicted (1 from 0.5)."""
    modest_batches(docs)
    rest = [f.name for f in docs.schema.fields if f.name not in (text_col, score_col, predicted_col)]
    kept = [F.col(f"`{n}`") for n in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for big in batches:
            for b in (big.slice(at, 1000) for at in range(0, big.num_rows, 1000)):
                texts, z = [t or "" for t in b.column(b.num_columns - 1).to_pylist()], []
                at = 0
                while at < len(texts):
                    own: list[str] = []
                    size = 0
                    while at < len(texts) and (not own or size < BLOCK_CHARS):
                        own.append(texts[at])
                        size += len(texts[at])
                        at += 1
                    z.append(scorer.logits(own))
                p = sigmoid(np.concatenate(z)) if z else np.zeros(0)
                if model.fixed is not None:
                    p = np.full(len(texts), model.fixed)
                yield pa.RecordBatch.from_arrays([*(b.columns if keep_text else b.columns[:-1]), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=names)
        tidy()

    text = F.col(f"`{text_col}`").cast("string").alias(text_col)
    schema = docs.select(*kept, *([text] if keep_text else [])).schema.add(score_col, "double").add(predicted_col, "integer")
    names = schema.names
    return docs.select(*kept, text).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> F.Column:
    return bit_remainder(id_col, 5) == 0
