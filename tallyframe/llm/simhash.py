"""SimHash near-dedup with a bit-sliced comparison.

Fingerprint: 64 majority bits of the XXH64 (seed 42) of all word shingles, repeats included. Texts with equal
fingerprints are one from the start. Different fingerprints within ``RADIUS`` bits are linked:

* The 64 bits are four quarters; two differing bits leave at least two quarters alone, so every pair within
  the radius shares one of six 32-bit keys. Fingerprints alone on a key are dropped before anything is compared.
* A key with more than ``REFINE`` fingerprints is cut again the same way by its other 32 bits. What is left shares
  48 bits, so no bucket is ever larger than 2^16 fingerprints, however many rows there are. Nothing is capped.
* Buckets are streamed through tasks in sorted order. In a bucket the fingerprints are stored as bit planes, 64 of
  them side by side in a word; distances to all lanes are counted with carry-save bitwise adders, and words whose
  lanes all exceed the radius are abandoned after every eighth plane.
* A bucket gives back a spanning forest of its links, never its pairs; components are joined up afterwards.

Edge cases: a null or wordless text has fingerprint zero and links like any other; fewer words than a shingle are
one shingle; a null id never names a component unless all its ids are null; rows equal in id and text are the
same document, of which ``dedup`` keeps one row; different texts under one id, or without one, are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, cut, unused
from .components import components

SHINGLE = 3
RADIUS = 2
REFINE = 512
#: (row, word) entries compared at once.
ENTRIES = 1 << 19
SEED = 42


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; fewer words than a shingle are one."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - shingle + 1)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[b:e], seed=SEED) for b, e in zip(begins[:n].tolist(), last.tolist(), strict=True)), np.uint64, n
    )


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes, as a signed 64-bit number; 0 for none."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[k : k + 4096].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    return majority(shingle_hashes(text, shingle))


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "bigint")(text)


def _keys(bits: Column, width: int, shift: int = 0) -> Column:
    """(pair of quarters, their bits) for the six pairs of quarters of ``width`` bits above ``shift``."""
    quarter = ((1 << width) - 1)
    out = []
    for k, (a, b) in enumerate(combinations(range(4), 2)):
        mask = (quarter << (shift + a * width)) | (quarter << (shift + b * width))
        out.append(F.struct(F.lit(k).alias("pair"), bits.bitwiseAND(F.lit(_signed(mask))).alias("bits")))
    return F.array(*out)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _rest(fp: Column) -> Column:
    """The 32 bits outside the first key, moved together (lower quarter first)."""
    out = None
    for k, (a, b) in enumerate(combinations(range(4), 2)):
        c, d = [q for q in range(4) if q not in (a, b)]
        low = F.shiftrightunsigned(fp, 16 * c).bitwiseAND(F.lit(0xFFFF))
        high = F.shiftleft(F.shiftrightunsigned(fp, 16 * d).bitwiseAND(F.lit(0xFFFF)), 16)
        both = low.bitwiseOR(high)
        out = F.when(F.col("pair") == k, both) if out is None else out.when(F.col("pair") == k, both)
    return out


def buckets(fingerprints: DataFrame, refine: int = REFINE) -> DataFrame:
    """(pair, bits, pair2, bits2, fp): fingerprints that share a bucket with another; ``fp`` must be distinct."""
    first = fingerprints.select("fp", F.inline(_keys(F.col("fp"), 16)))
    sizes = first.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1")
    met = first.join(sizes, ["pair", "bits"])
    small = met.where(F.col("n") <= refine).select("pair", "bits", F.lit(-1).alias("pair2"), F.lit(0).cast("bigint").alias("bits2"), "fp")
    large = met.where(F.col("n") > refine).withColumn("rest", _rest(F.col("fp")))
    finer = F.transform(_keys(F.col("rest"), 8), lambda k: F.struct(k["pair"].alias("pair2"), k["bits"].alias("bits2")))
    return small.unionByName(large.select("pair", "bits", "fp", F.inline(finer)))


def spread(fps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of buckets of fingerprints: (64, words) planes, lanes in use, first word of each bucket."""
    sizes = np.diff(starts)
    words = -(-sizes // 64)
    first = np.concatenate(([0], np.cumsum(words)))
    lane = np.arange(len(fps)) - np.repeat(starts[:-1], sizes) + 64 * np.repeat(first[:-1], sizes)
    bits = np.zeros((64, 64 * first[-1]), np.uint8)
    bits[:, lane] = np.unpackbits(fps.view(np.uint8), bitorder="little").reshape(-1, 64).T
    used = np.zeros(64 * first[-1], np.uint8)
    used[lane] = 1
    pack = lambda x: np.packbits(x, axis=-1, bitorder="little").view(np.uint64)
    return pack(bits), pack(used), first


def within(planes: np.ndarray, used: np.ndarray, queries: np.ndarray, words: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For (query, word) entries: which entries have lanes within the radius, those lanes as bits, and the counters.

    Every lane has as many counter bits as the radius needs and one that stays set on overflow; planes are added with carries.
    """
    live = np.arange(len(queries))
    counters = [np.zeros(len(queries), np.uint64) for _ in range(max(1, radius.bit_length()))]
    over = np.zeros(len(queries), np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)

    def beyond() -> np.ndarray:
        more, same = over, np.full(len(over), full)
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                same = same & counters[k]
            else:
                more, same = more | (same & counters[k]), same & ~counters[k]
        return more

    for bit in range(64):
        carry = planes[bit, words] ^ np.where((queries >> np.uint64(bit)) & np.uint64(1), full, np.uint64(0))
        for k, ones in enumerate(counters):
            counters[k], carry = ones ^ carry, ones & carry
        over = over | carry
        if bit % 8 == 7:
            stay = (~beyond() & used[words]) != 0
            if not stay.all():
                live, words, queries, over = (x[stay] for x in (live, words, queries, over))
                counters = [x[stay] for x in counters]
    return live, ~beyond() & used[words], counters


def forest(fps: np.ndarray, starts: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """(member, root) row numbers: a spanning forest of all links inside the buckets."""
    planes, used, first = spread(fps, starts)
    sizes = np.diff(starts)
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    entries = (first[1:] - first[:-1])[bucket]
    root = np.arange(len(fps))
    begin = 0
    total = np.concatenate(([0], np.cumsum(entries)))
    while begin < len(fps):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + ENTRIES, side="right")) - 1)
        rows = np.repeat(np.arange(begin, end), entries[begin:end])
        words = first[bucket[rows]] + np.arange(len(rows)) - np.repeat(total[begin:end] - total[begin], entries[begin:end])
        live, near, _ = within(planes, used, fps[rows], words, radius)
        hit = np.flatnonzero(near)
        lanes = np.unpackbits(near[hit].view(np.uint8), bitorder="little").reshape(-1, 64)
        at, lane = np.nonzero(lanes)
        row = rows[live[hit[at]]]
        other = starts[bucket[row]] + 64 * (words[live[hit[at]]] - first[bucket[row]]) + lane
        root = _unite(root, row[other < row], other[other < row])
        begin = end
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return np.stack([moved, root[moved]], axis=1)


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while len(a):
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            higher = root[root]
            if (higher == root).all():
                break
            root = higher
    return root


def links(fingerprints: DataFrame, radius: int = RADIUS, refine: int = REFINE) -> DataFrame:
    """Links (u, v) that connect all different fingerprints within the radius; ``fp`` must be distinct."""
    if radius > 2:
        raise ValueError("the quarters find pairs within two bits only")
    names = ["pair", "bits", "pair2", "bits2"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            edge = np.flatnonzero((rows[names].to_numpy()[1:] != rows[names].to_numpy()[:-1]).any(1)) + 1
            if not len(edge):
                kept = rows
                continue
            yield _linked(rows["fp"].to_numpy()[: edge[-1]], np.concatenate(([0], edge)), radius)
            kept = rows.iloc[edge[-1] :]
        if kept is not None and len(kept):
            yield _linked(kept["fp"].to_numpy(), np.array([0, len(kept)]), radius)

    dealt = buckets(fingerprints, refine).repartition(*names).sortWithinPartitions(*names, "fp")
    return dealt.mapInPandas(run, "u bigint, v bigint").distinct()


def _linked(fps: np.ndarray, starts: np.ndarray, radius: int) -> pd.DataFrame:
    out, begin = [], 0
    fps = np.ascontiguousarray(fps)
    while begin < len(starts) - 1:  # a bounded number of buckets' planes at once
        end = max(begin + 1, int(np.searchsorted(np.cumsum(-(-np.diff(starts[begin:]) // 64)), 8192, side="right")) + begin)
        part = fps[starts[begin] : starts[end]]
        found = forest(part.view(np.uint64), starts[begin : end + 1] - starts[begin], radius)
        out.append(part[found])
        begin = end
    pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
    return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """id, text_hash, fp, root (one number a component), component (least id reachable) of every document, from a written table of fingerprints."""
    marked = cut(docs.select(
        column(docs, key).alias("id"), F.xxhash64(column(docs, text)).alias("text_hash"), fingerprint(column(docs, text), shingle).alias("fp")
    ))
    different = marked.groupBy("fp").agg(F.min("id").alias("least"))
    joined = components(links(different.select("fp"), radius))
    rooted = different.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return marked.join(rooted.join(least, "root").select("fp", "root", "component"), "fp")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    found = classes(docs.select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, columns unchanged: the least id; of several rows with it, the least text hash.

    Rows equal in id and text are told apart by nothing, so one of them is taken.
    """
    return one_of_each(docs, classes(docs, key, text, **options), key, text)


def one_of_each(docs: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """One row of ``docs`` for each root in ``found`` (id, text_hash, root): the least id, null last, then the least text hash."""
    id_, hash_, first = unused(docs, "id_", "hash_", "first_hash_")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    one = found.groupBy("root").agg(F.min(place).alias("first")).select(F.col("first.id").alias(id_), F.col("first.text_hash").alias(first))
    hashed = docs.withColumn(hash_, F.xxhash64(column(docs, text)))
    kept = hashed.join(one, column(docs, key).eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(first)), "left_semi")
    return kept.dropDuplicates([key, hash_]).drop(hash_)  # rows equal in id and text
