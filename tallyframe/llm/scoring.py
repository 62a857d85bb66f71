"""Language-model scoring: a log-bilinear model, trained in numpy by noise-contrastive estimation.

The model predicts a class from the classes of the two tokens before: each context class has a vector, each place a
diagonal, the sum of the scaled vectors is multiplied with every class's output vector. Frequent words are classes
of their own, the next ones share classes by rank, all others are one class. Inside a class a word has its share of
the class's counts, with the same smoothing as the base, so that the probabilities of all known words and of the one
unseen event add up to one.

Counts of words and of class triples cover every training document and are taken by Spark; the size of the triple
table follows from the number of classes alone. Training draws its batches from that table, and the normalised
log-probabilities of all contexts come from one batched matrix product.

Defined results: a null text is empty and has one token, the end; repeated rows are scored each; a null key belongs
to the held-out rows if crc32 gives nothing for it; very long texts go whole through one row; without training rows
all counts are zero and the model falls back to equal classes; an empty table gives no row. The operator reads key
and text only, so extra columns cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, column, written

#: Words that are classes of their own, classes that share the next words by rank, and all words that are sent to the
#: tasks with their counts. All bounds are fixed; words beyond are joined by Spark.
OWN, BANDS, FREQUENT = 71, 24, 50_000
#: Training: length of the vectors, batches, rows a batch, noise samples a batch, step width.
WIDTH, BATCHES, BATCH, NOISE, RATE = 24, 4000, 512, 64, 0.15
#: Fixed values of the contract: smoothing of the base.
ADD = 0.1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = {ord(u): lo for u, lo in zip(_UPPER, _LOWER, strict=True)}
_WORD = re.compile(f"[^{SPACES}]+")
#: The end token. No word holds a space, so none is equal to it.
END = " end"


def words(text: str | None) -> list[str]:
    """The tokens of a text without its end."""
    return _WORD.findall(text.translate(_FOLD)) if text else []


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """word, n over all rows, end tokens included. One row per different word and task is shuffled."""
    folded = F.translate(column(texts, text), _UPPER, _LOWER)
    split = F.explode(F.split(F.coalesce(folded, F.lit("")), r"[\x20\x09-\x0D]+"))
    counted = texts.select(split.alias("word")).where("word != ''").groupBy("word").agg(F.count("*").alias("n"))
    ends = texts.agg(F.lit(END).alias("word"), F.count("*").alias("n")).where("n > 0")
    return counted.unionByName(ends)


def classes_of(size: int) -> np.ndarray:
    """Class of each of the ``size`` most frequent words: the first ones alone, then bands of equal width in log rank."""
    rank = np.arange(size)
    band = np.floor(np.log((rank + 1) / (OWN + 1)) / np.log((FREQUENT + 1) / (OWN + 1)) * BANDS)
    return np.where(rank < OWN, rank, OWN + np.clip(band, 0, BANDS - 1)).astype(np.int64)


class Vocabulary:
    """Frequent words with count and class; sizes of the classes. ``classes - 1`` is the class of all other words."""

    def __init__(self, frequent: list[tuple[str, int]], total: int, different: int) -> None:
        self.total, self.different, self.classes = total, different, OWN + BANDS + 1
        kinds = classes_of(len(frequent))
        self.known = {w: (int(k), int(n)) for (w, n), k in zip(frequent, kinds, strict=True)}
        counts = np.array([n for _, n in frequent], np.float64)
        self.members = np.bincount(kinds, minlength=self.classes).astype(np.float64)
        self.sums = np.bincount(kinds, weights=counts, minlength=self.classes)
        rest = self.classes - 1
        self.members[rest], self.sums[rest] = different - len(frequent), total - counts.sum()

    def of(self, token: str) -> int:
        found = self.known.get(token)
        return self.classes - 1 if found is None else found[0]

    @property
    def some(self) -> np.ndarray:
        """Classes that have words; the last one always holds the unseen event."""
        return (self.members > 0) | (np.arange(self.classes) == self.classes - 1)

    @property
    def base_norm(self) -> float:
        """Denominator of the base: all counts, smoothed, with one unseen event."""
        return self.total + ADD * (self.different + 1)

    def inside_norm(self, kind: int) -> float:
        """The same inside a class; the unseen event belongs to the last class."""
        return self.sums[kind] + ADD * (self.members[kind] + (kind == self.classes - 1))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """At most ``FREQUENT`` words reach the driver, and two totals."""
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    rows = counts.where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(FREQUENT - 1).collect()
    rows += counts.where(F.col("word") == END).collect()  # always among the frequent ones
    frequent = sorted(((r["word"], r["n"]) for r in rows), key=lambda r: (-r[1], r[0]))
    return Vocabulary(frequent, totals["n"] or 0, totals["v"])


def triples(texts: DataFrame, text: str, vocab: Vocabulary) -> np.ndarray:
    """How often class c follows the classes a and b, as an array [a, b, c]; a text starts after two ends."""
    size = vocab.classes
    sent = texts.sparkSession.sparkContext.broadcast(vocab.known)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total = sent.value, np.zeros(size**3, np.int64)
        get, rest = {w: k for w, (k, _) in known.items()}.get, size - 1
        end = get(END, rest)
        for batch in batches:
            flow, lengths = [], []
            for value in batch["text"]:
                tokens = words(value)
                flow += [end, end, *[get(w, rest) for w in tokens], end]
                lengths.append(len(tokens) + 3)
                if len(flow) > 1 << 20:
                    total += _codes(flow, lengths, size)
                    flow, lengths = [], []
            if flow:
                total += _codes(flow, lengths, size)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 1 << 16):
            yield pd.DataFrame({"code": at[k : k + (1 << 16)].astype(np.int32), "n": total[at[k : k + (1 << 16)]]})

    counted = texts.select(column(texts, text).alias("text")).mapInPandas(run, "code int, n bigint")
    found = counted.groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size**3, np.float64)
    out[found["code"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    return out.reshape(size, size, size)


def _codes(flow: list[int], lengths: list[int], size: int) -> np.ndarray:
    """Triple counts of texts laid end to end, each after two ends. What would predict such an opening end is left out."""
    k = np.array(flow, np.int64)
    starts = np.cumsum([0, *lengths])[:-1]
    predicted = np.ones(len(k), bool)
    predicted[starts] = predicted[starts + 1] = False
    code = (k[:-2] * size + k[1:-1]) * size + k[2:]
    return np.bincount(code[predicted[2:]], minlength=size**3)


def train(counts: np.ndarray, seed: int = 12) -> dict[str, np.ndarray]:
    """Log-bilinear model by noise-contrastive estimation; batches are drawn by the triples' counts.

    The noise is the smoothed distribution of single classes; each batch shares its noise samples, so that scores and
    gradients are matrix products. Steps are scaled by the root of the squared gradients so far.
    """
    size, rng = len(counts), np.random.default_rng(seed)
    flat = counts.ravel()
    at = np.flatnonzero(flat)
    single = counts.sum((0, 1)) + 1.0
    noise = single / single.sum()
    model = {
        "context": rng.normal(0, 0.1, (size, WIDTH)), "places": np.ones((2, WIDTH)), "output": rng.normal(0, 0.1, (size, WIDTH)),
        "bias": np.log(noise),
    }
    if not len(at):
        return model
    grown = {k: np.full(v.shape, 1e-2) for k, v in model.items()}
    upto, shift = np.cumsum(flat[at]), np.log(NOISE * noise)
    for step in range(BATCHES):
        code = at[np.searchsorted(upto, rng.random(BATCH) * upto[-1], side="right").clip(max=len(at) - 1)]
        before = np.stack([code // (size * size), code // size % size])
        target = code % size
        sample = rng.choice(size, NOISE, p=noise)
        vectors = model["context"][before]
        hidden = (vectors * model["places"][:, None]).sum(0)
        own = (hidden * model["output"][target]).sum(1) + model["bias"][target] - shift[target]
        other = hidden @ model["output"][sample].T + model["bias"][sample] - shift[sample]
        # derivative of the log-likelihood that data are told from noise
        up, down = 1 / (1 + np.exp(own)), -1 / (1 + np.exp(-other))
        one, some = np.eye(size)[target] * up[:, None], np.eye(size)[sample]
        toward = one + down @ some
        grad = {"output": toward.T @ hidden, "bias": toward.sum(0)}
        back = toward @ model["output"]
        spread = back[None] * model["places"][:, None]
        grad["places"] = (vectors * back[None]).sum(1)
        grad["context"] = np.eye(size)[before[0]].T @ spread[0] + np.eye(size)[before[1]].T @ spread[1]
        rate = RATE * (1 - step / BATCHES)
        for k, g in grad.items():
            grown[k] += (g / BATCH) ** 2
            model[k] += rate * (g / BATCH) / np.sqrt(grown[k])
    return model


def log_table(model: dict[str, np.ndarray], some: np.ndarray) -> np.ndarray:
    """Normalised log10 probability [a, b, c] of class c after a and b: batched matrix products over all contexts.

    ``some`` says which classes have words; the others get no probability.
    """
    context, places = model["context"], model["places"]
    hidden = (context * places[0])[:, None] + (context * places[1])[None]
    scores = hidden @ model["output"].T + model["bias"]
    scores[..., ~some] = -np.inf
    scores -= scores.max(-1, keepdims=True)
    return ((scores - np.log(np.exp(scores).sum(-1, keepdims=True))) / np.log(10)).astype(np.float32)


class Model:
    """Vocabulary and table of class log-probabilities; small enough for every task."""

    def __init__(self, vocab: Vocabulary, table: np.ndarray) -> None:
        self.vocab, self.table = vocab, table

    @staticmethod
    def fit(texts: DataFrame, text: str) -> tuple[Model, DataFrame]:
        """The model of all rows of ``texts``, and their word counts as a written table."""
        counts = written(word_counts(texts, text), "words")
        vocab = vocabulary(counts)
        return Model(vocab, log_table(train(triples(texts, text, vocab)), vocab.some)), counts


def scores(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score, score.

    Frequent words are looked up in the task. The others, and how often the text has them, go to the counts by a
    join on the word; a text's few sums come back by the number its row was given when it was written.
    """
    vocab = model.vocab
    sent = docs.sparkSession.sparkContext.broadcast((vocab, model.table))
    kinds = "n_tokens bigint, known bigint, base double, model double, rare array<string>, times array<int>"

    @F.pandas_udf(kinds)
    def local(texts: pd.Series) -> pd.DataFrame:
        vocab, table = sent.value
        get, rest, norm = vocab.known.get, vocab.classes - 1, vocab.base_norm or 1.0
        inside = np.array([vocab.inside_norm(k) or 1.0 for k in range(vocab.classes)])
        nothing = (rest, 0)
        end, none = get(END, nothing), vocab.total == 0
        out = []
        for value in texts:
            tokens = words(value)
            found = [get(w) for w in tokens]
            rare = Counter(w for w, f in zip(tokens, found, strict=True) if f is None)
            pairs = np.array([end, end, *[f or nothing for f in found], end], np.int64)
            kind, n = pairs[:, 0], pairs[2:, 1].astype(np.float64)
            seen = n > 0
            score = float(table[kind[:-2], kind[1:-1], kind[2:]].sum(dtype=np.float64))
            c = n[seen] + ADD
            out.append((
                len(tokens) + 1, int(seen.sum()), float(np.log10(c / norm).sum()) + (np.log10(ADD / norm) if none else 0.0),
                score + float(np.log10(c / inside[kind[2:][seen]]).sum()) + (np.log10(ADD / inside[rest]) if none else 0.0),
                list(rare), list(rare.values()),
            ))
        return pd.DataFrame(out, columns=["n_tokens", "known", "base", "model", "rare", "times"])

    names = docs.columns
    first = written(docs.select("*", local(column(docs, text)).alias("_s")).withColumn("_row", F.monotonically_increasing_id()), "scores")
    rare = first.select("_row", F.inline(F.arrays_zip(F.col("_s.rare").alias("word"), F.col("_s.times").alias("times"))))
    met = rare.join(counts.select("word", F.col("n").alias("_c")), "word", "left")
    c = F.coalesce("_c", F.lit(0))
    log = F.log10(c + ADD)
    rest = vocab.inside_norm(vocab.classes - 1) or 1.0
    late = met.groupBy("_row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * (log - F.log10(F.lit(float(vocab.base_norm or 1.0))))).alias("_base"),
        F.sum(F.col("times") * (log - F.log10(F.lit(float(rest))))).alias("_model"),
    )
    zero = F.lit(0.0)
    return first.join(late, "_row", "left").select(
        *[column(first, n) for n in names], F.col("_s.n_tokens").alias("n_tokens"),
        (F.col("_s.known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        (F.col("_s.base") + F.coalesce("_base", zero)).alias("base_score"), (F.col("_s.model") + F.coalesce("_model", zero)).alias("score"),
    )


def held_out(key: Column) -> Column:
    """Fixed rule of the registered query: one document of ten, by the checksum of its id as text, is never learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 10 == 0, F.lit(True))


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and the model's score."""
    slim = docs.select("doc_id", "text")
    learned = slim.where(~held_out(F.col("doc_id")))
    model, counts = Model.fit(learned, "text")
    return scores(slim, model, counts).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.vocab.total).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
