"""Language-model scores against plain counts and token-by-token products, and their sums over all events."""

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from tallyframe.llm import scoring

SCHEMA = "doc_id bigint, text string, score int, _row string"
WORD = re.compile("[^ \t\n\x0b\x0c\r]+")


def texts(n=160, seed=2):
    rng = np.random.default_rng(seed)
    stock = {"en": "the of and to in is that it".split(), "de": "der die und in den von zu das".split()}
    rows = []
    for i in range(n):
        kind = stock["en" if i % 2 else "de"]
        tokens = [str(rng.choice(kind)) if rng.random() < 0.7 else f"{'ab'[i % 2]}{rng.integers(0, 400)}" for _ in range(rng.integers(0, 60))]
        rows.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(tokens).replace("the", "The")))
    rows += [(1000, None), (1001, ""), (None, "lost The key"), (1002, "é É x  y"), (1003, "w " * 30000), (5, rows[5][1]), (5, rows[5][1])]
    return rows


@pytest.fixture(scope="module")
def small():
    old = scoring.OWN, scoring.BANDS, scoring.FREQUENT, scoring.BATCHES
    scoring.OWN, scoring.BANDS, scoring.FREQUENT, scoring.BATCHES = 12, 5, 60, 1500
    yield
    scoring.OWN, scoring.BANDS, scoring.FREQUENT, scoring.BATCHES = old


def tokens(text):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(fold), " end"]


def out(doc):
    return doc is None or zlib.crc32(str(doc).encode()) % 10 == 0


def test_scores_are_those_of_a_plain_walk(spark, small):
    rows = texts()
    df = spark.createDataFrame([(d, t, 1, "clash") for d, t in rows], SCHEMA).repartition(5)
    learned = df.where(~scoring.held_out(df["doc_id"]))
    model, counts = scoring.Model.fit(learned, "text")
    c = Counter(w for d, t in rows if not out(d) for w in tokens(t))
    assert {r.word: r.n for r in counts.collect()} == dict(c)
    total, different = sum(c.values()), len(c)
    assert model.vocab.total == total and model.vocab.different == different and " end" in model.vocab.known
    vocab, table = model.vocab, model.table
    want = []
    for d, t in rows:
        seq, kinds = tokens(t), [vocab.of(" end")] * 2
        base = score = 0.0
        for w in seq:
            k = vocab.of(w)
            base += log10((c[w] + 0.1) / (total + 0.1 * (different + 1)))
            score += float(table[kinds[-2], kinds[-1], k]) + log10((c[w] + 0.1) / vocab.inside_norm(k))
            kinds.append(k)
        want.append((d, out(d), len(seq), sum(c[w] > 0 for w in seq), total, base, score))
    got = sorted((tuple(r) for r in scoring.report(df).collect()), key=repr)
    want.sort(key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9, atol=1e-9)
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=1e-4, atol=1e-4)
    # every context's words and the one unseen event add up to one
    for a, b in ((0, 0), (3, 7), (vocab.classes - 1, vocab.of(" end"))):
        each = sum(10.0 ** table[a, b, vocab.of(w)] * (n + 0.1) / vocab.inside_norm(vocab.of(w)) for w, n in c.items())
        assert each + 10.0 ** table[a, b, vocab.classes - 1] * 0.1 / vocab.inside_norm(vocab.classes - 1) == pytest.approx(1, abs=1e-5)
    held = [w for w in want if w[1] and w[2] > 5]
    assert sum(w[6] for w in held) > sum(w[5] for w in held)


def test_triples_are_counted_inside_texts(spark, small):
    rows = [(0, "a b a"), (1, None), (2, "b")]
    vocab = scoring.Vocabulary([(" end", 3), ("a", 2), ("b", 2)], 7, 3)
    got = scoring.triples(spark.createDataFrame(rows, "doc_id int, text string").coalesce(1), "text", vocab)
    want = Counter()
    for _, t in rows:
        k = [vocab.of(w) for w in [" end", " end", *tokens(t)]]
        want.update(zip(k, k[1:], k[2:], strict=False))
    assert {tuple(map(int, i)): int(got[tuple(i)]) for i in np.argwhere(got)} == dict(want)


def test_contrastive_training_finds_the_conditional_distribution():
    rng = np.random.default_rng(0)
    size = 6
    truth = rng.dirichlet(np.ones(size) * 0.3, size)
    counts = np.round(1e5 * truth[None] * np.ones((size, 1, 1)))
    table = 10.0 ** scoring.log_table(scoring.train(counts), np.ones(size, bool))
    assert np.abs(table[0] - truth).max() < 0.08 and np.allclose(table.sum(-1), 1, atol=1e-5)


def test_nothing_and_nothing_to_learn_from(spark, small):
    assert scoring.report(spark.createDataFrame([], SCHEMA)).count() == 0
    only = next(i for i in range(100) if out(i))
    got = scoring.report(spark.createDataFrame([(only, "x y", 1, "")], SCHEMA)).first()
    assert (got.n_tokens, got.n_known, got.train_tokens) == (3, 0, 0) and np.isfinite(got.score) and got.base_score == pytest.approx(0)
