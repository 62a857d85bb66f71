"""Substring dedup by hashed units: passages of whole sentences and lines that stand elsewhere before.

A text is cut into units: lines, and inside a line sentences, so a passage is found wherever it stands in a line.
Units are normalised (lower case, white space collapsed) and hashed to 128 bits. Digests that occur once are
dropped first; the others are grouped with their earliest place in the order (doc_id, text, unit number), nulls
last. A unit whose digest has an earlier place is repeated. Repeated units that follow each other make a passage,
and a passage of at least ``min_words`` words is removed; its character range in the original text is kept.

Equal digests are joined, never collected. The rows of a hot digest stream through one task, unless adaptive
execution finds its partition large enough to split. Only a document's own repeated units meet in one window.

Edge cases: a null or blank text has no unit; punctuation alone is a unit; rows equal in id and text are one
document (none of them is a repeat of the other); repeats inside one text count like others. An empty table has no
passage. A text of any length is cut whole, in one task. Other columns are never looked at, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, unused, written

MIN_WORDS = 20
_UNIT = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+")  # units tile the text


def units_of(text: str | None) -> list[tuple[int, int, int, int, int, int]]:
    """(number, begin, end, words, digest, digest) of every unit with a word; end is after the last non-blank."""
    out = []
    for m in _UNIT.finditer(text or ""):
        words = m[0].lower().split()
        if words:
            digest = xxhash.xxh3_128_digest(" ".join(words).encode())
            d1, d2 = np.frombuffer(digest, np.int64).tolist()
            begin = m.start() + len(m[0]) - len(m[0].lstrip())
            out.append((len(out), begin, m.start() + len(m[0].rstrip()), len(words), d1, d2))
    return out


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, text_hash, d1, d2, and two packed numbers of every unit: ``what`` (unit, words) and ``where`` (begin, end)."""
    slim = docs.select(column(docs, key).alias("id"), F.xxhash64(column(docs, text)).alias("text_hash"), column(docs, text).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.iloc[k : k + 256]
                found = [units_of(t) for t in part["text"]]
                counts = [len(f) for f in found]
                flat = np.array([u for f in found for u in f], np.int64).reshape(-1, 6)
                out = part[["id", "text_hash"]].loc[part.index.repeat(counts)].reset_index(drop=True)
                out["what"], out["where"] = flat[:, 0] << 32 | flat[:, 3], flat[:, 1] << 32 | flat[:, 2]
                out["d1"], out["d2"] = flat[:, 4], flat[:, 5]
                yield out

    return slim.mapInPandas(run, f"id {kind}, text_hash bigint, what bigint, where bigint, d1 bigint, d2 bigint")


def _parts(packed: str) -> tuple[Column, Column]:
    return F.shiftright(packed, 32), F.col(packed).bitwiseAND(F.lit((1 << 32) - 1))


def passages(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """id, text_hash, begin, end (characters), n_words, and first_id: where the passage's first unit stands first."""
    rows = _rows(docs, key, text)
    often = rows.groupBy("d1").agg(F.count("*").alias("n")).where("n > 1").select("d1")
    met = written(rows.join(often, "d1", "left_semi"), "units")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "what")
    firsts = met.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = met.join(firsts, ["d1", "d2"]).where(F.col("first") != place).withColumns(
        dict(zip(("unit", "n_words", "begin", "end"), (*_parts("what"), *_parts("where")), strict=True))
    )
    own = Window.partitionBy("id", "text_hash").orderBy("unit")
    once = repeated.withColumn("before", F.lag("unit").over(own)).where("before is null or before != unit")  # rows equal in id and text
    runs = once.withColumn("run", F.col("unit") - F.row_number().over(own))
    return runs.groupBy("id", "text_hash", "run").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"),
        F.min_by("first.id", "unit").alias("first_id"),
    ).where(F.col("n_words") >= min_words).drop("run")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All documents with repeated passages taken out of the text; columns unchanged."""
    id_, hash_, gone = unused(docs, "id_", "hash_", "gone_")
    found = passages(docs, key, text, min_words).groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("gone")
    ).select(F.col("id").alias(id_), F.col("text_hash").alias(hash_), F.col("gone").alias(gone))  # of one document
    same = column(docs, key).eqNullSafe(F.col(id_)) & (F.xxhash64(column(docs, text)) == F.col(hash_))
    joined = docs.join(found, same, "left")
    ranges, body = F.col(gone), column(docs, text)
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(ranges, lambda r: r["end"]))
    begins = F.concat(F.transform(ranges, lambda r: r["begin"]), F.array(F.length(body).cast("bigint")))
    left = F.array_join(F.zip_with(ends, begins, lambda e, b: F.substring(body, (e + 1).cast("int"), (b - e).cast("int"))), "")
    return joined.select(*[
        (F.when(ranges.isNull(), body).otherwise(left).alias(c) if c == text else column(docs, c)) for c in docs.columns
    ])


def report(docs: DataFrame) -> DataFrame:
    """One row per removed passage: doc_id, begin_char, end_char, n_words, first_doc_id. Equal rows of a table appear once."""
    return passages(docs).select(
        F.col("id").alias("doc_id"), F.col("begin").alias("begin_char"), F.col("end").alias("end_char"),
        "n_words", F.col("first_id").alias("first_doc_id"),
    )
