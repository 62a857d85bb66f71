"""URL filter: a memory-mapped, sorted array of 64-bit digests with the rules' own strings behind it.

A rule is ``host/path``: it fits its host and all subdomains when the url's path starts with the rule's
path. The longest fitting rule (in characters; then the longer host, then block) decides; a url that no
rule fits is allowed. Host and path of a url are cut as a column expression; the probe is vectorised:
every (host suffix, path start of a length some rule has) is hashed, looked up by binary search over the
whole batch, and confirmed against the stored string, so colliding digests never decide a url.

Rules reach the tasks as bytes of measured size: a rule table is taken in blocks of ``block_bytes``, and
each Python worker maps a block from its own temporary file, which it unlinks at once. Rules beyond a block
are probed block after block, the best rule so far being carried along; no rule is left out.

Edge cases: a null url, or one without ``://``, has empty host and path and fits no rule; a rule that is null
or has no ``/`` is refused; equal rules with both verdicts block; repeated rows are each judged.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, column, cut, unused

BLOCK_BYTES = 16 << 20
CHUNK = 1 << 18  # probes held at once
FOUND = "rule string, verdict string"

#: The rules of the registered query.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def pack(rules: Sequence[tuple[str, str]]) -> bytes:
    """The index file: counts, sorted digests, string offsets, verdicts, path lengths, strings."""
    verdicts: dict[str, str] = {}
    for rule, verdict in rules:
        if rule is None or "/" not in rule or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {rule!r} {verdict!r}")
        verdicts[rule] = "block" if "block" in (verdict, verdicts.get(rule)) else "allow"
    texts = sorted(verdicts, key=lambda r: (xxhash.xxh64_intdigest(r), r))
    raw = [r.encode() for r in texts]
    digests = np.array([xxhash.xxh64_intdigest(r) for r in raw], np.uint64)
    ends = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.uint64)
    lengths = np.array(sorted({len(r) - r.index("/") for r in texts}), np.uint64)
    block = np.array([verdicts[r] == "block" for r in texts], np.uint64)
    head = np.array([len(texts), len(lengths)], np.uint64)
    return b"".join(x.tobytes() for x in (head, digests, ends, block, lengths)) + b"".join(raw)


class Index:
    """A mapped index file."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as file:  # has no name: gone with the mapping
            file.write(data)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n, k = np.frombuffer(self.map, np.uint64, 2).astype(int)
        at = 16
        parts = []
        for count in (n, n + 1, n, k):
            parts.append(np.frombuffer(self.map, np.uint64, count, at))
            at += 8 * count
        self.digests, self.ends, self.block, lengths = parts
        self.lengths, self.strings = [int(x) for x in lengths], at

    def string(self, k: int) -> bytes:
        return self.map[self.strings + int(self.ends[k]) : self.strings + int(self.ends[k + 1])]

    def probe(self, keys: list[bytes]) -> np.ndarray:
        """Rule number of each key, -1 where it is no rule."""
        found = np.full(len(keys), -1, np.int64)
        if not len(self.digests) or not keys:
            return found
        digests = np.fromiter((xxhash.xxh64_intdigest(x) for x in keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, digests)
        maybe = np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == digests)
        for k in maybe:
            for r in range(at[k], len(self.digests)):  # equal digests stand together
                if self.digests[r] != digests[k]:
                    break
                if self.string(r) == keys[k]:
                    found[k] = r
                    break
        return found

    def best(self, hosts: Sequence[str], paths: Sequence[str]) -> list[tuple[str | None, str | None]]:
        """The longest fitting rule of each (host, path) and its verdict."""
        out: list[tuple[str | None, str | None]] = [(None, None)] * len(hosts)
        keys: list[bytes] = []
        owners: list[tuple[int, int]] = []

        def settle() -> None:
            for (row, size), r in zip(owners, self.probe(keys), strict=True):
                if r >= 0 and better((rule := self.string(int(r)).decode()), out[row][0]):
                    out[row] = (rule, "block" if self.block[r] else "allow")
            keys.clear(), owners.clear()

        for row, (h, p) in enumerate(zip(hosts, paths, strict=True)):
            for suffix in suffixes(h):
                for n in self.lengths:
                    if n <= len(p):
                        keys.append((suffix + p[:n]).encode())
                        owners.append((row, n))
            if len(keys) > CHUNK:
                settle()
        settle()
        return out


def suffixes(name: str) -> Iterator[str]:
    """A host and its parents, longest first."""
    while name:
        yield name
        _, _, name = name.partition(".")


def better(rule: str, than: str | None) -> bool:
    return than is None or (len(rule), rule.index("/")) > (len(than), than.index("/"))


def decide(host_of: Column, path_of: Column, rules: list[tuple[str, str]], spark) -> Column:
    """A column of FOUND for one block of rules."""
    sent = spark.sparkContext.broadcast(pack(rules))
    ready: list[Index] = []

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        if not ready:
            ready.append(Index(sent.value))
        for hosts, paths in batches:
            yield pd.DataFrame(ready[0].best(hosts, paths), columns=["rule", "verdict"], dtype="object")

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, FOUND)(host_of, path_of)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", block_bytes: int = BLOCK_BYTES, name: str = "found") -> tuple[DataFrame, str]:
    """``pages`` with one more column (rule, verdict), and that column's name. ``rules`` has rule and verdict.

    Rules that differ only in the verdict must be one block: they are merged to block here.
    """
    spark = pages.sparkSession
    (name,) = unused(pages, name)
    one = rules.groupBy("rule").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
    out = None
    for rows in blocks(one, F.octet_length("rule") + 32, block_bytes):
        found = decide(host(column(pages, url)), path(column(pages, url)), [(r["rule"], r["verdict"]) for r in rows], spark)
        if out is None:
            out = pages.withColumn(name, found)
            continue
        (more,) = unused(out, "more")
        both = cut(out).withColumn(more, found)
        old, new = column(both, name), column(both, more)
        longer = F.struct(F.length(new["rule"]), F.locate("/", new["rule"])) > F.struct(F.length(old["rule"]), F.locate("/", old["rule"]))
        out = both.withColumn(name, F.when(new["rule"].isNotNull() & (old["rule"].isNull() | longer), new).otherwise(old)).drop(more)
    return out, name


def report(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow where no rule fits)."""
    found, name = judge(pages.select("page_id", "url"), rules)
    hit = column(found, name)
    return found.select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), hit["rule"].alias("rule"),
        F.coalesce(hit["verdict"], F.lit("allow")).alias("verdict"),
    )


def keep_allowed(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The pages whose url is not blocked, columns unchanged."""
    found, name = judge(pages, rules, url)
    return found.where(F.coalesce(column(found, name)["verdict"], F.lit("allow")) == "allow").select(*[column(pages, c) for c in pages.columns])
