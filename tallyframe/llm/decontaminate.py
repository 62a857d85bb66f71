"""Benchmark decontamination: a broadcast set of test word windows, scanned over whole training texts.

Words are runs of digits, letters a-z (A-Z lower-cased) and all characters above ASCII. A window is
``ngram`` consecutive words of an item; a shorter item is one window. Each window is kept as a 64-bit
hash for the probe and as its words for the check of every hit, so a collision never marks a text.

The broadcast is bounded: items come in blocks whose size is measured before they are collected
(``block_bytes`` of item text). One block is the usual case. Items beyond it are scanned block after
block over the same rows, with the rows written to the shared folder between two blocks; no item is
left out. Training texts are never shuffled.

Edge cases: a null or wordless text has no words and no hit; a null or wordless item has no window; a
null item_id is reported as ``null``; equal items with different ids are all reported; repeated rows
are each judged; any other column of the input passes through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, column, cut, unused

NGRAM = 10
BLOCK_BYTES = 16 << 20
CHUNK_WORDS = 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # on UTF-8 bytes: every byte above ASCII belongs to a word
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash

HITS = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<begin: int, end: int>>"


def words(text: str | None) -> list[bytes]:
    return _WORD.findall(text.encode().lower()) if text else []


class Windows:
    """Windows of a block of items: probe by hash, confirm by words."""

    def __init__(self, items: list[tuple[str, str | None]], ngram: int = NGRAM):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, set[str]]] = {}
        for item, text in items:
            found = words(text)
            if not found:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found], np.int32)
            n = min(ngram, len(ids))
            kept = self.windows.setdefault(n, {})
            for k in range(len(ids) - n + 1):
                kept.setdefault(ids[k : k + n].tobytes(), set()).add(item)
        self.hashes = {
            n: np.sort(_rolled(np.frombuffer(b"".join(kept), np.int32).reshape(-1, n)))
            for n, kept in self.windows.items()
        }

    def numbers(self, found: list[bytes]) -> np.ndarray:
        """Word numbers; 0 for words that no item has."""
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in found), np.int32, len(found))

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[set[str]]]]:
        """For each window length: starts of confirmed occurrences and the items that have them.

        ``ids`` may hold many texts, parted by zeros.
        """
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        for n, kept in self.windows.items():
            if len(ids) < n:
                continue
            starts = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(starts):
                continue
            rows = ids[starts[:, None] + np.arange(n)]
            probe, there = _rolled(rows), self.hashes[n]
            at = np.minimum(np.searchsorted(there, probe), len(there) - 1)
            maybe = there[at] == probe
            found = [(s, kept.get(r.tobytes())) for s, r in zip(starts[maybe], rows[maybe], strict=True)]
            found = [x for x in found if x[1]]
            yield n, np.array([s for s, _ in found], np.int64), [items for _, items in found]


def _rolled(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        out = out * _STEP + rows[:, k].astype(np.uint64)
    return out


def judge(texts: list[str | None], windows: Windows) -> list[tuple[int, np.ndarray, set[str]]]:
    """For each text: number of words, positions of hit words, items found. Texts share one scan."""
    found = [words(t) for t in texts]
    counts = np.array([len(f) for f in found], np.int64)
    begins = np.concatenate(([0], np.cumsum(counts + 1)))  # a zero after each text
    ids = np.zeros(begins[-1], np.int32)
    for b, f in zip(begins, found, strict=False):
        ids[b : b + len(f)] = windows.numbers(f)
    hit, items = np.zeros(len(ids), bool), {}
    for n, starts, names in windows.occurrences(ids):
        hit[(starts[:, None] + np.arange(n)).ravel()] = True
        for text, name in zip(np.searchsorted(begins, starts, side="right") - 1, names, strict=True):
            items.setdefault(int(text), set()).update(name)
    return [
        (int(c), np.flatnonzero(hit[b : b + c]), items.get(k, set()))
        for k, (b, c) in enumerate(zip(begins, counts, strict=False))
    ]


def spans(text: str, positions: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges of runs of hit words, from the first to the end of the last word of each."""
    raw = text.encode()
    bounds = [m.span() for m in _WORD.finditer(raw.lower())]
    out, at, behind = [], 0, 0  # characters before the byte `behind`
    runs = np.split(positions, np.flatnonzero(np.diff(positions) > 1) + 1)
    for run in runs if len(positions) else []:
        edges = []
        for byte in (bounds[run[0]][0], bounds[run[-1]][1]):
            at, behind = at + len(raw[behind:byte].decode()), byte
            edges.append(at)
        out.append((edges[0], edges[1]))
    return out


def _in_chunks(texts: pd.Series) -> Iterator[list[str | None]]:
    chunk, size = [], 0
    for t in texts:
        chunk.append(t)
        size += len(t or "")
        if size > CHUNK_WORDS * 4:
            yield chunk
            chunk, size = [], 0
    yield chunk


def scanner(text: Column, items: list[tuple[str, str | None]], spark, ngram: int) -> Column:
    """A column of HITS for one block of items, which are broadcast as their texts."""
    sent = spark.sparkContext.broadcast(items)
    ready: list[Windows] = []  # built once per Python worker

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not ready:
            ready.append(Windows(sent.value, ngram))
        for batch in batches:
            rows = []
            for chunk in _in_chunks(batch):
                for t, (n, at, names) in zip(chunk, judge(chunk, ready[0]), strict=True):
                    rows.append((n, len(at), sorted(names), [{"begin": b, "end": e} for b, e in spans(t, at)] if len(at) else []))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    scan.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(scan, HITS)(text)


def find(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    ngram: int = NGRAM, block_bytes: int = BLOCK_BYTES, name: str = "hits",
) -> tuple[DataFrame, str]:
    """``docs`` with one more column of HITS, and that column's name (``name`` unless taken).

    ``spans`` are character ranges of the text; with several blocks they may touch or overlap.
    """
    spark = docs.sparkSession
    (name,) = unused(docs, name)
    tests = items.select(
        F.coalesce(column(items, item_id).cast("string"), F.lit("null")).alias("id"), column(items, item_text).alias("text")
    )
    out = None
    for rows in blocks(tests, F.octet_length("text"), block_bytes):
        block = [(r["id"], r["text"]) for r in rows]
        if out is None:
            out = docs.withColumn(name, scanner(column(docs, text), block, spark, ngram))
            continue
        (more,) = unused(out, "more")
        both = cut(out).withColumn(more, scanner(column(docs, text), block, spark, ngram))
        old, new = column(both, name), column(both, more)
        merged = F.sort_array(F.array_union(old["spans"], new["spans"]))
        out = both.withColumn(name, F.struct(
            old["n_words"].alias("n_words"),
            hit_words(column(docs, text), merged).alias("n_hit"),
            F.sort_array(F.array_union(old["items"], new["items"])).alias("items"),
            merged.alias("spans"),
        )).drop(more)
    return out, name


def hit_words(text: Column, ranges: Column) -> Column:
    """Words inside any of the sorted character ranges; ranges of several blocks may overlap."""

    def count(texts: pd.Series, spans_of: pd.Series) -> pd.Series:
        out = []
        for t, found in zip(texts, spans_of, strict=True):
            inside, behind = 0, 0
            for s in found if found is not None else []:
                begin = max(s["begin"], behind)
                if s["end"] > begin:
                    inside += len(words(t[begin : s["end"]]))
                    behind = s["end"]
            out.append(inside)
        return pd.Series(out, dtype="int64")

    count.__annotations__ = {"texts": pd.Series, "spans_of": pd.Series, "return": pd.Series}
    return F.pandas_udf(count, "bigint")(text, ranges)


def without_spans(text: Column, ranges: Column) -> Column:
    """The text with the hit ranges taken out; overlapping ranges count once."""

    def strip(texts: pd.Series, spans_of: pd.Series) -> pd.Series:
        out = []
        for t, found in zip(texts, spans_of, strict=True):
            if t is None or found is None or not len(found):
                out.append(t)
                continue
            kept, behind = [], 0
            for s in sorted(found, key=lambda s: (s["begin"], s["end"])):
                kept.append(t[behind : max(behind, s["begin"])])
                behind = max(behind, s["end"])
            out.append("".join([*kept, t[behind:]]))
        return pd.Series(out, dtype="object")

    strip.__annotations__ = {"texts": pd.Series, "spans_of": pd.Series, "return": pd.Series}
    return F.pandas_udf(strip, "string")(text, ranges)


def remove_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without any hit, columns unchanged."""
    found, name = find(docs, items, **options)
    return found.where(F.size(column(found, name)["items"]) == 0).select(*[column(docs, c) for c in docs.columns])


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, with hit passages taken out of the text; columns unchanged."""
    found, name = find(docs, items, text=text, **options)
    clean = without_spans(column(docs, text), column(found, name)["spans"])
    return found.select(*[(clean.alias(c) if c == text else column(docs, c)) for c in docs.columns])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, name = find(docs.select("doc_id", "text"), items)
    hits = column(found, name)
    return found.select(
        "doc_id", hits["n_words"].alias("n_words"), hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        (hits["n_hit"] > 0).alias("contaminated"),
    )
