"""The vote model against the same estimation in numpy, and what its posterior decides."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import quality

RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdeéß") for _ in range(RNG.randint(3, 7))) for _ in range(4000)]


def sentences(n, mark=""):
    return " ".join(" ".join(RNG.choice(WORDS) + mark for _ in range(12)) + "." for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    good = [sentences(RNG.randint(6, 30)) for _ in range(120)]
    marked = [sentences(RNG.randint(10, 20), "###") for _ in range(30)]
    menus = [" | ".join(RNG.choice(WORDS) for _ in range(90)) for _ in range(20)]
    # two of five lines repeat an earlier short one, all else is good
    lists = ["\n".join([a := " ".join(RNG.sample(WORDS, 3)) + ".", sentences(3), a, sentences(3), a]) for _ in range(4)]
    return good + marked + menus + lists + ["", None, "a " * 300]


@pytest.fixture(scope="module")
def judged(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows, name = quality.judge(docs)
    return {r["doc_id"]: r[name] for r in rows.collect()}


def estimate(votes, rounds):
    """Expectation-maximisation over single documents."""
    good = ((votes == 1).sum(1) + 1) / ((votes != 0).sum(1) + 2)
    for _ in range(rounds + 1):
        total = np.log((good.sum() + quality.SMOOTH) / ((1 - good).sum() + quality.SMOOTH)) * np.ones(len(votes))
        model = [total[0]]
        for rule in votes.T:
            for vote in (1, -1):
                share = [(w[rule == vote].sum() + quality.SMOOTH) / (w[rule != 0].sum() + 2 * quality.SMOOTH) for w in (good, 1 - good)]
                model.append(share)
                total = total + np.where(rule == vote, np.log(share[0] / share[1]), 0)
        good = 1 / (1 + np.exp(-total))
    return good


def test_posterior(judged):
    rows = [r for r in judged.values() if not r["base_failed"]]
    want = estimate(np.array([r["votes"] for r in rows]), quality.ROUNDS)
    assert np.allclose([r["good"] for r in rows], want, atol=1e-9)


def test_decides(judged, texts):
    """Rules that confirm each other decide; a bad vote that stands alone does not."""
    kept = {i for i, r in judged.items() if r["kept"]}
    assert kept >= set(range(120)) and not kept & set(range(120, 170))
    alone = range(170, 174)
    assert all(-1 in judged[i]["votes"] for i in alone) and kept >= set(alone)
    assert not kept & set(range(174, len(texts)))


def test_new_figures(judged, texts):
    for i, r in judged.items():
        words = re.findall("[^\x20\x09-\x0d]+", texts[i] or "")
        assert r["n_plain"] == sum(any(c.isalpha() for c in w) and not set(w) & set(quality.SYMBOLS) for w in words)
        assert r["n_ends"] == len(re.findall("[.!?…](?![^\x20\x09-\x0d])", texts[i] or ""))


def test_hard_cases(spark):
    """Very long words, no document that passes the base rule, columns named like the added ones."""
    long = "a" * 300_000 + "#"
    docs = spark.createDataFrame([(1, long, 1, 2, 3), (2, "#" + long, 1, 2, 3), (None, None, None, None, None)],
                                 "doc_id long, text string, quality int, figures int, votes int")
    rows, name = quality.judge(docs)
    assert name not in docs.columns and set(docs.columns) < set(rows.columns)
    got = rows.select(F.col(name)["kept"], F.col(name)["n_plain"], F.col(name)["good"], "quality").collect()
    assert [(r[0], r[1]) for r in got] == [(False, 0)] * 3 and all(0 <= r[2] <= 1 for r in got)
    assert quality.keep_good(docs).collect() == [] and quality.keep_good(docs).columns == docs.columns
