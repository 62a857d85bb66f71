"""Prefix trie of conversations: subtree figures of every shared beginning, by an Euler tour.

Turns are hashed where they stand; a beginning is known by the sums of its turns' hashes, each taken with its place,
so that prefix sums over the turns name every beginning of every conversation, however long. Each node of the trie
gets an enter and an exit arc. The tour's successor links are ranked without following them one by one: in each
round a random quarter of the arcs is spliced out, the rest of at most ``TAIL`` arcs is walked, and the spliced arcs
get their places back in reverse order. What lies in a subtree is then the difference of two prefix sums at the
places of its enter and exit arc.

Defined results: a null role or text is empty; turns are taken in order of turn, null first, equal turns by their
hash; rows without a conv_id belong to no conversation; repeated rows are turns of their own; an empty table has no
node. Extra columns are not read, so their names cannot clash. Beginnings are told apart by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import running_totals
from .common import column, written

#: Arcs that are walked in one task when all others are spliced out: a fixed bound, 24 bytes each.
TAIL = 1 << 15
#: Children of one node that meet their parent's row under one key.
FAMILY = 1024
#: Ids of ended conversations joined into one string before they are hashed.
IDS = 4096
NODE = ["depth", "a", "b"]


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, place (from 1), x, y (hashes of the turn), bytes of its text: one slim row per turn."""
    role_, text_ = F.coalesce(column(df, role), F.lit("")), F.coalesce(column(df, text), F.lit(""))
    slim = written(df.where(column(df, conv).isNotNull()).select(
        column(df, conv).cast("bigint").alias("conv"), column(df, turn).alias("turn"),
        F.xxhash64(F.lit(1), role_, text_).alias("x"), F.xxhash64(text_, F.lit(2), role_).alias("y"),
        F.octet_length(text_).cast("bigint").alias("bytes"),
    ), "turns")
    placed = running_totals(slim, ["turn", "x", "y"], {"place": F.lit(1).cast("bigint")}, ["conv"])
    return placed.drop("turn")


def replayed(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """Conversations whose first turns are taken from another one.

    ``heads`` has one row per conversation: conv, base, h. The result starts with the first h turns of ``base`` and
    goes on with the conversation's own turns after its first h. At most max(h) rows of a base go to each of those
    that start from it.
    """
    own = turns.join(heads.select("conv", "h"), "conv").where("place > h")
    most = heads.agg(F.max("h").alias("most")).scalar()
    first = turns.where(F.col("place") <= most).withColumnRenamed("conv", "base")
    taken = first.join(heads, "base").where("place <= h")
    known = taken.groupBy("conv").agg(F.count("*").alias("shift"))
    moved = own.join(known, "conv", "left").withColumn("place", F.col("place") - F.col("h") + F.coalesce("shift", F.lit(0)))
    names = ["conv", "place", "x", "y", "bytes"]
    return taken.select(names).unionByName(moved.select(names))


def nodes(turns: DataFrame, everyone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes (depth, a, b, its parent's a and b, least member, members, bytes of the last turn), and where each conversation ends.

    ``everyone`` lists all conversations, so that those without turns end at the root.
    """
    part = F.lit(1 << 32)
    halves = {}
    for i, (turn, seed) in enumerate((("x", 1), ("y", 2))):
        mixed = F.xxhash64("place", turn, F.lit(seed))  # each half is summed on its own and cannot overflow
        halves[f"h{2 * i}"], halves[f"h{2 * i + 1}"] = F.shiftrightunsigned(mixed, 32), F.pmod(mixed, part)
    sums = {f"s{k}": F.col(k) for k in halves}
    ran = running_totals(turns.withColumns(halves), ["place"], sums | {"n": F.lit(1).cast("bigint")}, ["conv"], totals=True)

    def digest(high: Column, low: Column) -> Column:
        """Two 32-bit sums as one number."""
        return F.shiftleft(F.pmod(high, part), 32).bitwiseOR(F.pmod(low, part))

    def before(k: str) -> Column:
        return F.col(f"s{k}") - F.col(k)

    own = written(ran.select(
        "conv", F.col("place").alias("depth"), (F.col("place") == F.col("n_total")).alias("last"), "bytes",
        digest(F.col("sh0"), F.col("sh1")).alias("a"), digest(F.col("sh2"), F.col("sh3")).alias("b"),
        digest(before("h0"), before("h1")).alias("up_a"), digest(before("h2"), before("h3")).alias("up_b"),
    ), "beginnings")
    zero = F.lit(0).cast("bigint")
    inner = own.groupBy(*NODE).agg(
        F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"), F.min("conv").alias("conv"),
        F.count("*").alias("members"), F.max("bytes").alias("bytes"),
    )
    root = everyone.agg(F.min("conv").alias("conv"), F.count("*").alias("members")).where("members > 0").select(
        *[zero.alias(c) for c in (*NODE, "up_a", "up_b")], "conv", "members", zero.alias("bytes")
    )
    silent = everyone.join(own.where("depth = 1").select("conv"), "conv", "left_anti")
    ends = own.where("last").select(*NODE, "conv").unionByName(silent.select(*[zero.alias(c) for c in NODE], "conv"))
    return inner.unionByName(root), ends


def numbered(nodes: DataFrame) -> DataFrame:
    """Nodes with a number (root 0; siblings in a row), their parent's, their first child's, and whether they are the last child."""
    inner = nodes.where("depth > 0")
    order = ["up_a", "up_b", "a"]  # siblings in a row; which of two equal in all three comes first is open
    given = running_totals(inner, order, {"number": F.lit(1).cast("bigint")})
    given = written(given.unionByName(nodes.where("depth = 0").withColumn("number", F.lit(0).cast("bigint"))), "nodes")
    family = given.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.min("number").alias("first"), F.max("number").alias("last"), F.count("*").alias("children")
    )
    grown = given.join(family, NODE, "left")
    # a parent's row is repeated for every FAMILY numbers its children take up: no child key gets hot
    part = F.floor(F.col("number") / FAMILY)
    parents = grown.where("children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("number").alias("up"),
        F.col("conv").alias("up_conv"), F.col("last").alias("youngest"),
        F.explode(F.sequence(F.floor(F.col("first") / FAMILY), F.floor(F.col("last") / FAMILY))).alias("part"),
    )
    placed = grown.drop("last").withColumn("part", part).join(parents, ["depth", "up_a", "up_b", "part"], "left")
    return written(placed.drop("part"), "family")


def arcs(numbered: DataFrame) -> DataFrame:
    """The Euler tour as links: id, next (null at its end). Node v enters at 2 v and exits at 2 v + 1."""
    v = F.col("number")
    enter = F.when(F.col("children") > 0, F.col("first") * 2).otherwise(v * 2 + 1)
    leave = F.when(v == 0, F.lit(None).cast("bigint")).when(v < F.col("youngest"), (v + 1) * 2).otherwise(F.col("up") * 2 + 1)
    return numbered.select(F.inline(F.array(
        F.struct((v * 2).alias("id"), enter.alias("next")), F.struct((v * 2 + 1).alias("id"), leave.alias("next"))
    )))


def ranked(links: DataFrame, tail: int = TAIL) -> DataFrame:
    """id, place (from 0) of every arc of one list (id, next), whose first arc has the id 0.

    A round tosses a coin for each arc: one that shows tails and follows one that shows heads is spliced out and
    remembers it. Every arc takes part in one shuffle a round and a quarter goes, so all rounds together move about
    four times the arcs.
    """
    now = written(links.withColumn("step", F.lit(1).cast("bigint")).withColumn("gone", F.lit(None).cast("struct<id:bigint,step:bigint>")), "arcs")
    gone, turn = [], 0
    while now.count() > tail:
        def heads(c: str, seed: int = turn) -> Column:
            return (F.xxhash64(F.lit(seed), c) > 0) | (F.col(c) == 0)

        taker = F.col("next").isNotNull() & heads("id") & ~heads("next")
        me = F.struct("id", "next", "step")
        met = now.groupBy(F.when(taker, F.col("next")).otherwise(F.col("id")).alias("at")).agg(
            F.max(F.when(~F.coalesce(taker, F.lit(False)), me)).alias("own"), F.max(F.when(taker, me)).alias("taker")
        )
        free = F.col("taker").isNull()
        now = written(met.select(
            F.when(free, F.col("own.id")).otherwise(F.col("taker.id")).alias("id"), F.col("own.next").alias("next"),
            F.when(free, F.col("own.step")).otherwise(F.col("own.step") + F.col("taker.step")).alias("step"),
            F.when(~free, F.struct(F.col("own.id").alias("id"), F.col("taker.step").alias("step"))).alias("gone"),
        ), "arcs")
        gone.append(now.where("gone is not null").select("id", "gone"))
        turn += 1
    found = now.select("id", "next", "step").repartition(1).mapInPandas(_walk, "id bigint, place bigint")
    for back in reversed(gone):
        both = F.array(F.struct("id", "place"), F.struct(F.col("gone.id").alias("id"), (F.col("place") + F.col("gone.step")).alias("place")))
        one = F.array(F.struct("id", "place"))
        found = found.join(back, "id", "left").select(F.inline(F.when(F.col("gone").isNull(), one).otherwise(both)))
    return found


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Places along what is left of the list: at most ``TAIL`` arcs."""
    rest = pd.concat(list(batches) or [pd.DataFrame({"id": [], "next": [], "step": []})])
    if len(rest):
        step = dict(zip(rest["id"].to_numpy(), zip(rest["next"].to_numpy(), rest["step"].to_numpy(), strict=True), strict=True))
        at, place, ids, places = 0, 0, [], []
        while True:
            ids.append(at)
            places.append(place)
            following, width = step[at]
            if pd.isna(following):
                break
            at, place = int(following), place + int(width)
        yield pd.DataFrame({"id": np.array(ids, np.int64), "place": np.array(places, np.int64)})


def subtrees(numbered: DataFrame, measures: dict[str, Column], tail: int = TAIL) -> DataFrame:
    """number, and the sum of each measure over the node's subtree, itself included."""
    at = written(ranked(arcs(numbered), tail), "places")
    weights = numbered.select((F.col("number") * 2).alias("id"), *[m.alias(n) for n, m in measures.items()])
    weighed = at.join(weights, "id", "left").select("id", "place", *[F.coalesce(n, F.lit(0).cast("bigint")).alias(f"own_{n}") for n in measures])
    ran = running_totals(weighed, ["place"], {n: F.col(f"own_{n}") for n in measures})
    entering = F.col("id") % 2 == 0
    return ran.groupBy(F.floor(F.col("id") / 2).alias("number")).agg(*[
        (F.max(F.when(~entering, F.col(n))) - F.max(F.when(entering, F.col(n) - F.col(f"own_{n}")))).alias(n) for n in measures
    ])


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ended conversations' ids per node, ascending, comma-joined.

    Ids are joined in pieces of ``IDS``, over as many tasks as there are; the hash then goes through a node's pieces
    one after the other, which it has to, and keeps nothing else.
    """
    placed = running_totals(ends, ["conv"], {"nth": F.lit(1).cast("bigint")}, NODE)
    pieces = placed.withColumn("piece", F.floor((F.col("nth") - 1) / IDS)).groupBy(*NODE, "piece").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            done = []
            for depth, a, b, ids in batch[[*NODE, "ids"]].itertuples(index=False):
                if (depth, a, b) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (depth, a, b), hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=[*NODE, "sha"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "sha"])

    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return dealt.mapInPandas(run, "depth bigint, a bigint, b bigint, sha string")


def trie(turns: DataFrame, everyone: DataFrame, tail: int = TAIL) -> DataFrame:
    """One row per node of the trie over ``turns`` (conv, place, x, y, bytes); see the module for the method."""
    found, ends = nodes(turns, everyone)
    known = numbered(found)
    sums = subtrees(known, {
        "leaves": (F.col("children").isNull()).cast("bigint"), "saved": (F.col("members") - 1) * F.col("bytes"),
    }, tail)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return known.join(sums, "number").join(end_digests(ends), NODE, "left").select(
        "conv", "depth", "up_conv", "members", F.coalesce("children", F.lit(0).cast("bigint")).alias("children"),
        "leaves", "saved", F.coalesce("sha", none).alias("ends_sha256"),
    )


#: Fixed values of the registered query: conversations start with turns of the least id of their five, at most eight.
BASES, HEADS = 5, 9


def report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations: conversation c starts with the first crc32(c) % 9 turns of c - c % 5."""
    own = turns(conversations)
    c = F.col("conv")
    everyone = written(conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv")).distinct(), "everyone")
    heads = everyone.select("conv", (c - c % BASES).alias("base"), (F.crc32(c.cast("string")) % HEADS).alias("h"))
    built = written(replayed(written(own, "own"), heads), "replayed")
    return trie(built, everyone).select(
        F.col("conv").alias("conv_id"), "depth", F.col("up_conv").alias("parent_conv_id"), F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256",
    )
