"""One document of each group of near copies stays, whatever ids the others have."""

import random

from tallyframe.llm import simhash


def test_unrelated_texts_under_one_id_or_none_all_stay(spark):
    rng = random.Random(9)
    one, two, three, four, five = (" ".join(f"v{rng.randrange(9999)}" for _ in range(60)) for _ in range(5))
    rows = [(None, one), (None, two), (None, two), (7, three), (7, four), (7, four.upper()), (8, four), (9, five), (None, five)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"], r["text"].lower()) for r in simhash.dedup(docs).collect()]
    assert sorted(got, key=str) == sorted([(None, one), (None, two), (7, three), (7, four), (9, five)], key=str)
