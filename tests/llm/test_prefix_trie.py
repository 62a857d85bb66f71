"""The prefix trie against a walk over all beginnings, with hot turns, ties, nulls, copies and a very long conversation."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallyframe.llm import prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, a string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        yield p
        for k in children[p]:
            yield from below(k)

    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(p))
        out.append((
            min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children[p]),
            sum(not children[q] for q in below(p)), sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below(p) if q),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def told(rows):
    return sorted((tuple(r)[:8] for r in rows), key=repr)


def made(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(200), convs):
        for t in range(rng.randint(1, 12)):
            text = rng.choice(["", None, "hi", "größe", "x" * 3000]) if rng.random() < 0.6 else f"{c} {t}"
            rows.append((c, rng.choice([t, t, None, 3]), rng.choice(["user", None]), text, 7, "clash"))
    rows += [(None, 1, "user", "lost", 0, None), (10**12, None, None, None, 0, None)]
    return rows + rows[:40]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_is_the_brute_force_one(spark, seed, monkeypatch):
    rows = made(seed)
    # distinct turns decide ties by hash: keep only ties of equal turns
    seen, kept = {}, []
    for r in rows:
        if seen.setdefault((r[0], r[1]), r[2:4]) == r[2:4]:
            kept.append(r)
    monkeypatch.setattr(prefixtrie, "TAIL", 16)
    monkeypatch.setattr(prefixtrie.ranked, "__defaults__", (16,))
    monkeypatch.setattr(prefixtrie.subtrees, "__defaults__", (16,))
    monkeypatch.setattr(prefixtrie.trie, "__defaults__", (16,))
    monkeypatch.setattr(prefixtrie, "FAMILY", 4)
    monkeypatch.setattr(prefixtrie, "IDS", 3)
    df = spark.createDataFrame(kept, SCHEMA).repartition(5)
    assert told(prefixtrie.report(df).collect()) == told(brute(kept))


def test_hot_turn_copies_and_a_long_conversation(spark):
    rows = [(c, t, "user", "same") for c in range(0, 400) for t in range(2)]
    rows += [(1000, t, "user", f"turn {t % 7}") for t in range(900)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    import sys

    sys.setrecursionlimit(5000)
    assert told(prefixtrie.report(df).collect()) == told(brute(rows))


def test_nothing(spark):
    assert prefixtrie.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_list_ranking(spark):
    rng = random.Random(4)
    ids = [0, *rng.sample(range(1, 5000), 700)]
    df = spark.createDataFrame([(a, b) for a, b in zip(ids, [*ids[1:], None], strict=True)], "id bigint, next bigint").repartition(6)
    got = {r.id: r.place for r in prefixtrie.ranked(df, 8).collect()}
    assert got == {x: i for i, x in enumerate(ids)}
