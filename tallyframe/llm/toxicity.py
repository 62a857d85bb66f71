"""Toxicity: a small convolutional text classifier, trained in numpy and applied to whole texts in Spark tasks.

Words are lower-cased runs of letters. Each word has two hashed embeddings, from ``BUCKETS`` buckets each, so two
words are mixed up only if they meet in both. Filters of widths 1, 2 and 3 slide over the words, each filter keeps
its maximum over the text, and a logistic layer turns the maxima into a score.

Training rows are the labelled documents whose crc32(doc_id as text) mod 4 is not 2, at most ``SAMPLE`` different
texts of each label in the order of a hash, and at most ``SAMPLE_WORDS`` words in all: that sample is all the driver
sees, whatever the tables' size. Only buckets seen in at least ``LEAST_TEXTS`` training texts, and in ``LEAST_SHARE`` of
them, carry an embedding, so that a rare word of few texts cannot stand for their label; all others are one unknown word. A fifth of the sample is left out
of the fit. It moves the scores so that ``THRESHOLD`` is their best cut, and then gives each language with at least 20
toxic texts in it a threshold of its own. Where it would have under 5 toxic texts, the whole sample moves the scores. The score never sees
language, source, id or label. The model has a fixed size and is broadcast.

Edge cases: a null, empty or wordless text has the score of an empty text; a label table without rows of both labels
gives a score of 0 everywhere; rows with a null doc_id are never trained on; a null language has the plain threshold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, cut, unused

BUCKETS = 1 << 22
SIZE = 8  # numbers per embedding; a word has two
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
PAD = max(WIDTHS)
SAMPLE, SAMPLE_WORDS = 2000, 4_000_000
LEAST_TEXTS, LEAST_SHARE = 5, 1 / 400
EPOCHS, BATCH, RATE, DECAY = 6, 32, 0.05, 1e-4
THRESHOLD = 0.3
CHUNK_WORDS = 1 << 17
CACHE = 400_000

_WORD = re.compile(r"[^\W\d_]+")


def buckets(word: str) -> tuple[int, int]:
    h = xxhash.xxh64_intdigest(word)
    return h % BUCKETS, (h >> 32) % BUCKETS


class Numbers(dict):
    """Word -> rows of its two embeddings in one number, 0 for an unknown word; emptied at CACHE words."""

    def __init__(self, rows: tuple[dict[int, int], dict[int, int]]):
        super().__init__()
        self.rows = rows

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        one, two = (self.rows[k].get(b, 0) for k, b in enumerate(buckets(word)))
        self[word] = out = one << 32 | two if one and two else 0
        return out


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def numbers(text: str | None, known: Numbers) -> np.ndarray:
    """The words' numbers. Of more than PAD unknown words on end the first PAD are kept: no window sees a difference."""
    words = words_of(text)
    out = np.fromiter((known[w] for w in words), np.int64, len(words))
    unknown = out == 0
    gone = unknown.copy()
    gone[:PAD] = False
    for k in range(1, PAD + 1):
        gone[k:] &= unknown[:-k]
    return out[~gone]


def _both(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return packed >> 32, packed & 0xFFFFFFFF  # row 0 of each table is the unknown word and the padding


@dataclass
class Model:
    rows: tuple[dict[int, int], dict[int, int]]  # bucket -> row of its table
    tables: list[np.ndarray]  # two of (rows, SIZE)
    filters: dict[int, np.ndarray]  # width -> (width, 2 * SIZE, FILTERS)
    bias: np.ndarray  # of all filters
    weights: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts behind each other, each with PAD pads; first word and number of window starts of each."""
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes + PAD)))[:-1]
    out = np.zeros(int((sizes + PAD).sum()), np.int64)
    for b, t in zip(first, texts, strict=True):
        out[b : b + len(t)] = t
    return out, first, np.maximum(sizes, 1)


def _segments(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.stack([first, first + sizes], axis=1).ravel()


def ready(model: Model) -> dict[int, list[list[np.ndarray]]]:
    """Tables times filters: for each width and place, what a bucket adds to each filter."""
    return {
        w: [[model.tables[h] @ f[j, h * SIZE : (h + 1) * SIZE] for h in (0, 1)] for j in range(w)] for w, f in model.filters.items()
    }


def maxima(packed: np.ndarray, first: np.ndarray, sizes: np.ndarray, model: Model, parts: dict) -> np.ndarray:
    """(texts, filters) maxima before the rectifier."""
    one, two = _both(packed)
    out = []
    for w in WIDTHS:
        rows = len(packed) - w + 1
        total = np.zeros((len(packed), FILTERS), np.float32)
        for j in range(w):
            total[:rows] += parts[w][j][0][one[j : rows + j]]
            total[:rows] += parts[w][j][1][two[j : rows + j]]
        out.append(np.maximum.reduceat(total, _segments(first, sizes), axis=0)[::2])
    return np.concatenate(out, axis=1) + model.bias


def scores(texts: list[np.ndarray], model: Model, parts: dict) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    top = np.maximum(maxima(*laid_out(texts), model, parts), 0)
    return 1 / (1 + np.exp(-np.clip(top @ model.weights + model.offset, -30, 30).astype(np.float64)))


def _start(texts: list[list[str]], labels: np.ndarray, rng: np.random.Generator) -> Model:
    """A first model. One direction of the embeddings starts as the smoothed log odds of a bucket, the others as noise."""
    totals = np.bincount(labels, minlength=2)
    seen: tuple[dict, dict] = ({}, {})
    for t, y in zip(texts, labels.tolist(), strict=True):
        for k, found in enumerate(zip(*map(buckets, set(t)), strict=True)):
            for b in set(found):
                seen[k].setdefault(b, [0, 0])[y] += 1
    least = max(LEAST_TEXTS, int(LEAST_SHARE * len(texts)))
    rows, tables = [], []
    for counts in seen:
        known = sorted(b for b, n in counts.items() if sum(n) >= least)
        rows.append({b: k + 1 for k, b in enumerate(known)})
        n = np.array([counts[b] for b in known], np.float64).reshape(-1, 2)
        odds = np.log((n[:, 1] + 1) / (totals[1] + 2)) - np.log((n[:, 0] + 1) / (totals[0] + 2))
        table = rng.normal(0, 0.01, (len(known) + 1, SIZE))
        table[0] = 0
        table[1:, 0] += odds / 4
        tables.append(table.astype(np.float32))
    filters = {w: rng.normal(0, 0.1, (w, 2 * SIZE, FILTERS)) for w in WIDTHS}
    for f in filters.values():
        f[0, [0, SIZE]] += 0.5
    n = FILTERS * len(WIDTHS)
    return Model(
        (rows[0], rows[1]), tables, {w: f.astype(np.float32) for w, f in filters.items()}, np.zeros(n, np.float32),
        rng.normal(0.2, 0.02, n).astype(np.float32), -1.0,
    )


def fit(texts: list[list[str]], labels: np.ndarray, seed: int = 0) -> Model:
    """Adagrad on the logistic loss; a filter's gradient goes to the window that gave its maximum."""
    rng = np.random.default_rng(seed)
    model = _start(texts, labels, rng)
    known = Numbers(model.rows)
    rows = [numbers(" ".join(t), known) for t in texts]
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))
    weight = np.minimum(weight, 4.0)  # rare labels count more, so a score of THRESHOLD stays meaningful
    past = {
        "bias": np.full_like(model.bias, 1e-6), "weights": np.full_like(model.weights, 1e-6), "offset": 1e-6,
        "tables": [np.full_like(t, 1e-6) for t in model.tables], "filters": {w: np.full_like(f, 1e-6) for w, f in model.filters.items()},
    }
    for _ in range(EPOCHS):
        for pick in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
            _step(model, past, [rows[k] for k in pick], labels[pick], weight[pick])
    return model


def _step(model: Model, past: dict, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> None:
    packed, first, sizes = laid_out(texts)
    halves = _both(packed)
    x = np.concatenate([model.tables[h][halves[h]] for h in (0, 1)], axis=1)
    tops, where = [], []
    for w, f in model.filters.items():
        rows = len(packed) - w + 1
        total = sum(x[j : rows + j] @ f[j] for j in range(w))
        at = np.stack([b + total[b : b + n].argmax(0) for b, n in zip(first.tolist(), sizes.tolist(), strict=True)])
        tops.append(np.take_along_axis(total, at, 0))
        where.append(at)
    top = np.concatenate(tops, axis=1) + model.bias
    on = np.maximum(top, 0)
    p = 1 / (1 + np.exp(-np.clip(on @ model.weights + model.offset, -30, 30)))
    error = ((p - labels) * weight / len(texts)).astype(np.float32)
    back = np.where(top > 0, error[:, None] * model.weights, 0).astype(np.float32)  # (texts, filters)

    def move(value, gradient, seen):
        seen += gradient**2
        value -= RATE * gradient / np.sqrt(seen)

    grads = [np.zeros((len(packed), SIZE), np.float32) for _ in (0, 1)]
    for k, (w, f) in enumerate(model.filters.items()):
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        g = np.zeros_like(f)
        for j in range(w):
            at = where[k] + j
            for c in range(FILTERS):
                rows = x[at[:, c]]
                g[j, :, c] = own[:, c] @ rows + DECAY * f[j, :, c]
                for h in (0, 1):
                    np.add.at(grads[h], at[:, c], own[:, c, None] * f[j, h * SIZE : (h + 1) * SIZE, c])
        move(f, g, past["filters"][w])
    move(model.weights, on.T @ error + DECAY * model.weights, past["weights"])
    move(model.bias, back.sum(0), past["bias"])
    past["offset"] += float(error.sum()) ** 2
    model.offset -= RATE * float(error.sum()) / np.sqrt(past["offset"])
    for h in (0, 1):
        touched = np.flatnonzero(np.abs(grads[h]).sum(1))
        rows, back_to = np.unique(halves[h][touched], return_inverse=True)
        g = np.zeros((len(rows), SIZE), np.float32)
        np.add.at(g, back_to, grads[h][touched])
        g[rows == 0] = 0
        past["tables"][h][rows] += g**2
        model.tables[h][rows] -= RATE * g / np.sqrt(past["tables"][h][rows])


def _logit(p):
    return np.log(p) - np.log1p(-p)


def best_shift(values: np.ndarray, labels: np.ndarray, rate: float) -> float:
    """What moves the logits so that THRESHOLD cuts best: by F1 at ``rate`` toxic texts, in the middle of the best gap.

    A cut under which most are not toxic is not taken: where nothing tells the labels apart, nothing is called toxic.
    """
    order = np.argsort(values)
    x, y = _logit(np.clip(values[order], 1e-9, 1 - 1e-9)), labels[order]
    weight = np.where(y == 1, rate / max(1, (y == 1).sum()), (1 - rate) / max(1, (y == 0).sum()))
    above = lambda of: np.append(np.cumsum((of * weight)[::-1])[::-1], 0)  # noqa: E731  from each place up
    hit, false = above(y == 1), above(y == 0)
    f1 = np.where(hit >= false, 2 * hit / (hit + false + rate), 0)
    edges = np.concatenate(([x[0] - 1], x, [x[-1] + 1]))
    gap = np.where((f1 >= f1.max() - 1e-9) & (hit >= false), edges[1:] - edges[:-1], -1)
    k = int(gap.argmax())
    return float(_logit(THRESHOLD) - (edges[k] + edges[k + 1]) / 2)


def best_threshold(values: np.ndarray, labels: np.ndarray) -> float:
    """The threshold of a coarse grid with the best F1; of equals the nearest to THRESHOLD."""
    grid = np.round(np.arange(0.2, 0.65, 0.05), 2)
    f1 = [2 * (hit := ((values >= t) & (labels == 1)).sum()) / max(1, (values >= t).sum() + (labels == 1).sum()) for t in grid]
    best = [t for t, f in zip(grid, f1, strict=True) if f >= max(f1) - 1e-9]
    return float(min(best, key=lambda t: abs(t - THRESHOLD)))


def held_out(key: Column) -> Column:
    """Rows that are never trained on."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, lang: str | None, limit: int = SAMPLE) -> tuple[list, float]:
    """At most ``limit`` different texts of each label (0 and 1), in the order of a hash, as (label, text, language), and the
    share of toxic rows among all that may be trained on."""
    own = docs.select(column(docs, key).alias("id"), column(docs, text).alias("text"), (column(docs, lang) if lang else F.lit(None).cast("string")).alias("lang"))
    own = own.where(F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("text").isNotNull())
    mark = F.xxhash64("text")
    # texts stay where they are until those wanted are known
    slim = own.select("id", F.octet_length("text").alias("size"), mark.alias("mark"))
    rows = cut(slim.join(labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("toxic")), "id"))
    out = []
    for label in (1, 0):
        # whole texts; those over a hundredth of the sample's words would crowd out the others
        fit_in = rows.where((F.col("toxic") == label) & (F.col("size") <= 6 * SAMPLE_WORDS // 100))
        names = fit_in.groupBy("mark").agg(F.min("id").alias("id")).orderBy("mark").limit(limit)
        chosen = own.join(F.broadcast(names), "id").where(mark == F.col("mark"))  # at most `limit` ids
        out += [(r["mark"], label, r["text"], r["lang"]) for r in chosen.select("mark", "text", "lang").dropDuplicates(["mark"]).collect()]
    toxic, every = rows.where(F.col("toxic").isin(0, 1)).agg(F.count_if(F.col("toxic") == 1), F.count("*")).first()
    return [x[1:] for x in sorted(out, key=lambda x: (x[0], x[1]))], (toxic + 1) / (every + 2)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang", seed: int = 0) -> Model | None:
    """The model, or None where the sample has one label only."""
    texts, marks, langs, left = [], [], [], SAMPLE_WORDS
    rows, rate = sample(docs, labels, key, text, lang)
    for mark, body, language in rows:
        found = words_of(body)
        left -= len(found)
        if left < 0:
            break
        texts.append(found)
        marks.append(mark)
        langs.append(language)
    marks = np.array(marks, np.int64)
    if len(set(marks.tolist())) < 2:
        return None
    test = np.arange(len(texts)) % 5 == 4
    if marks[test].sum() < 5 or (marks[~test] == 1).sum() < 20:
        test[:] = False
    model = fit([t for t, out in zip(texts, test, strict=True) if not out], marks[~test], seed)
    known = Numbers(model.rows)
    judged = [numbers(" ".join(t), known) for t, out in zip(texts, test, strict=True) if out or not test.any()]
    model.offset += best_shift(scores(judged, model, ready(model)), marks[test] if test.any() else marks, rate)
    if test.any():
        found, of = scores(judged, model, ready(model)), np.array([str(x) for x in langs])[test]
        for language in sorted(set(of.tolist())):
            own = of == language
            if marks[test][own].sum() >= 20 and language != "None":
                model.thresholds[language] = best_threshold(found[own], marks[test][own])
    return model


def score(text: Column, model: Model | None, spark) -> Column:
    """The score of whole texts, 0 to 1."""
    if model is None:
        return F.lit(0.0)
    sent, state = spark.sparkContext.broadcast(model), []

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not state:
            state.extend((sent.value, ready(sent.value), Numbers(sent.value.rows)))
        model, parts, known = state
        for texts in batches:
            out, chunk, size = [], [], 0
            for t in texts:
                chunk.append(numbers(t, known))
                size += len(chunk[-1])
                if size >= CHUNK_WORDS:
                    out.append(scores(chunk, model, parts))
                    chunk, size = [], 0
            yield pd.Series(np.concatenate([*out, scores(chunk, model, parts)]))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(text)


def threshold(lang: Column, model: Model | None) -> Column:
    out = F.lit(THRESHOLD)
    for language, value in sorted((model.thresholds if model else {}).items()):
        out = F.when(lang == language, value).otherwise(out)
    return out


def remove(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """The documents whose score stays under their language's threshold, columns unchanged."""
    model = train(docs, labels, key, text, lang)
    (name,) = unused(docs, "score")
    limit = threshold(column(docs, lang), model) if lang else F.lit(THRESHOLD)
    scored = docs.withColumn(name, score(column(docs, text), model, docs.sparkSession))
    return scored.where(F.col(name) < limit).select(*[column(docs, c) for c in docs.columns])


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score >= 0.3), and rejected by its language's threshold."""
    model = train(docs, labels)
    scored = docs.select("doc_id", "lang", score(F.col("text"), model, docs.sparkSession).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        (F.col("score") >= threshold(F.col("lang"), model)).alias("rejected"),
    )
