"""Line dedup by a deletion neighbourhood: lines equal or one edit apart are kept once, the earliest.

Lines are cut at ``\\n`` and compared trimmed. A line goes if an equal line, or one within ``max_edits`` (0 or 1)
inserted, deleted or changed characters, stands earlier in the order (doc_id, text, line number), nulls last.
Equal lines go at any length; blank ones are layout and stay. One edit counts only between lines of ``min_chars``
characters or more, because in a shorter one it makes another word.

Only DataFrame functions are used. The steps, each of them linear in the lines:

1. Every line becomes a slim row in a table written to the shared folder: place, 128-bit digest, hashes of halves.
2. One edit leaves the first or the last half of the shorter line as it is. One grouped count finds the digests that occur
   twice and the halves that two different lines share. All other lines have no partner and stop here, by rule.
3. Lines that share a half emit a key for themselves and one for every deletion of a character outside it. A key is the exclusive or
   of (character, position) hashes, so all deletions of a line cost one running pass, however long it is.
4. Keys are joined on equality, without forming pairs inside a group: lines with the same deletion at the same
   place differ there only, so comparing each with the group's earliest line is enough; a line that equals
   another's deletion is compared with the earliest such line, and the other way round.
5. Every candidate is checked by ``levenshtein`` on the two texts. Lines whose check fails stay.
6. Removed line numbers are gathered per document and the text is put together from what stays.

Edge cases: a null text stays null; a text whose lines all go becomes null (``dedup`` drops that row, but
never a row that was empty before); rows equal in id and text are treated alike, as one document. An empty table
gives an empty one. Other columns are handed on, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, cut, unused

#: Least length of lines that one edit may set apart; equal lines have no least length.
MIN_CHARS = 20
#: Rows of a few numbers that are broadcast at most, after counting them; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
_TRIM = " \t\r\x0b\x0c"


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "line_no")


def _if_few(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if a count shows that it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def slim_lines(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """id, text_hash, line_no, digest (d1, d2) of every line that is not blank, and half hashes from ``min_chars`` on."""
    rows = docs.select(column(docs, key).alias("id"), F.xxhash64(column(docs, text)).alias("text_hash"), F.split(column(docs, text), "\n", -1).alias("lines"))
    cut_up = rows.select("id", "text_hash", F.posexplode("lines").alias("line_no", "raw")).withColumn("line", F.btrim("raw", F.lit(_TRIM)))
    sized = cut_up.withColumn("n", F.length("line")).where("n > 0")
    return sized.select(
        "id", "text_hash", "line_no", F.xxhash64("line").alias("d1"), F.xxhash64(F.lit(1), F.col("line")).alias("d2"),
        F.when(F.col("n") >= min_chars, halves(F.col("line"), F.col("n"))).otherwise(F.array().cast("array<bigint>")).alias("halves"),
    )


def halves(line: Column, n: Column) -> Column:
    """Hashes of the first and last h characters, for each h a partner within one edit has as its half."""

    def both(h: Column) -> list[Column]:
        return [F.xxhash64(F.lit(0), h, F.substring(line, F.lit(1), h)), F.xxhash64(F.lit(1), h, F.substring(line, n - h + 1, h))]

    own, less = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    return F.when(own == less, F.array(*both(own))).otherwise(F.array(*both(own), *both(less)))


def met(lines: DataFrame, near: bool) -> DataFrame:
    """Keys that matter, as (key, half): digests of lines that occur twice, and halves that two different lines share."""
    own = F.array(F.struct(F.col("d1").alias("key"), F.lit(False).alias("half")))
    shared = F.transform("halves", lambda h: F.struct(h.alias("key"), F.lit(True).alias("half")))
    keyed = lines.select("d1", F.inline(F.concat(own, shared) if near else own))
    groups = keyed.groupBy("key", "half").agg(F.count("*").alias("n"), F.min("d1").alias("a"), F.max("d1").alias("b"))
    return groups.where("n > 1 and (not half or a != b)").select("key", "half")


def occurrences(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """Places of lines whose digest is among ``keys`` (d1)."""
    return lines.select("id", "text_hash", "line_no", "d1", "d2").join(keys, "d1", "left_semi")


def texts_of(docs: DataFrame, key: str, text: str, firsts: DataFrame) -> DataFrame:
    """The line of every digest, from the document of its earliest place."""
    at = firsts.select(
        "first", "d1", "d2", "front", "back", F.col("first.id").alias("first_id"), F.col("first.text_hash").alias("first_hash"), F.col("first.line_no").alias("line_no")
    )
    own = docs.select(column(docs, key).alias("id"), column(docs, text).alias("text"))
    found = own.join(_if_few(at), F.col("id").eqNullSafe(F.col("first_id"))).where(F.xxhash64("text") == F.col("first_hash"))
    line = F.btrim(F.get(F.split("text", "\n", -1), F.col("line_no")), F.lit(_TRIM))
    return found.select("d1", "d2", "first", "front", "back", line.alias("line")).dropDuplicates(["d1", "d2"])  # rows equal in id and text


def deletions(texts: DataFrame) -> DataFrame:
    """Every line's own key (``at`` 0) and the key of each deletion at position ``at``, outside the half that is shared."""
    here = Window.partitionBy("d1", "d2").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("d1", "d2")
    chars = texts.select("d1", "d2", "front", "back", F.length("line").alias("n"), F.posexplode(F.split("line", "")).alias("pos", "char"))
    least = F.floor((F.col("n") - 1) / 2)  # characters of the smaller half
    open_ = (F.col("front") & (F.col("pos") >= least)) | (F.col("back") & (F.col("pos") < F.col("n") - least))
    hashed = chars.select("d1", "d2", "n", "pos", open_.alias("open"), F.xxhash64("char", F.col("pos")).alias("stays"), F.xxhash64("char", F.col("pos") - 1).alias("moves"))
    sums = hashed.withColumns({
        "left": F.bit_xor("stays").over(here), "passed": F.bit_xor("moves").over(here), "moved": F.bit_xor("moves").over(whole),
    })
    without = F.col("left").bitwiseXOR(F.col("stays")).bitwiseXOR(F.col("moved")).bitwiseXOR(F.col("passed"))
    cut_off = F.when(F.col("open"), F.struct(without.alias("key"), (F.col("n") - 1).alias("length"), (F.col("pos") + 1).alias("at")))
    own = F.when(F.col("pos") + 1 == F.col("n"), F.struct(F.col("left").alias("key"), F.col("n").alias("length"), F.lit(0).alias("at")))
    return sums.select("d1", "d2", F.inline(F.array_compact(F.array(cut_off, own))))


def near_pairs(keys: DataFrame, firsts: DataFrame) -> DataFrame:
    """(line, earlier line) candidates: at most two per key and line, never all pairs of a group."""
    several = keys.groupBy("key", "length").agg(F.min("d1").alias("a"), F.max("d1").alias("b")).where("a != b").select("key", "length")
    placed = cut(keys.join(several, ["key", "length"], "left_semi").join(firsts.select("d1", "d2", "first"), ["d1", "d2"]))
    line = F.struct("first", "d1", "d2")
    same_place = placed.groupBy("key", "length", "at").agg(F.min(line).alias("earliest")).where("at > 0")
    same_key = placed.groupBy("key", "length").agg(F.min(F.when(F.col("at") == 0, line)).alias("whole"), F.min(F.when(F.col("at") > 0, line)).alias("cut"))
    by_place = placed.join(same_place, ["key", "length", "at"]).select("d1", "d2", "first", "earliest")
    by_key = placed.join(same_key, ["key", "length"]).select(
        "d1", "d2", "first", F.when(F.col("at") > 0, F.col("whole")).otherwise(F.col("cut")).alias("earliest")
    )
    return by_place.unionByName(by_key).where(F.col("earliest.first") < F.col("first")).select(
        "d1", "d2", F.col("earliest.d1").alias("e1"), F.col("earliest.d2").alias("e2")
    ).distinct()


def near_repeats(docs: DataFrame, key: str, text: str, firsts: DataFrame) -> DataFrame:
    """Digests of lines that have an earlier line within one edit, of lines (d1, d2, first)."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes now, many rows once exploded
    texts = cut(texts_of(docs, key, text, firsts).repartition(tasks, "d1", "d2"))
    pairs = near_pairs(deletions(texts), texts)
    later = texts.select("d1", "d2", F.col("line").alias("later"))
    earlier = texts.select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.col("line").alias("earlier"))
    checked = pairs.join(later, ["d1", "d2"]).join(earlier, ["e1", "e2"])
    return checked.where(F.levenshtein(F.col("later"), F.col("earlier"), 1) >= 0).select("d1", "d2").distinct()


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, max_edits: int = 1) -> DataFrame:
    """id, text_hash, and the sorted numbers (from 0) of lines to remove: ``equal`` and ``near``."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    lines = cut(slim_lines(docs, key, text, min_chars))
    keys = cut(met(lines, near=max_edits > 0))
    often = _if_few(keys.where("not half").select(F.col("key").alias("d1")))
    repeated = occurrences(lines, often)
    # the earliest place is found with map-side combine; rows of a hot line meet in one task only where ``firsts`` is too large to broadcast
    firsts = repeated.groupBy("d1", "d2").agg(F.min(_place()).alias("first"))
    equal = repeated.join(firsts, ["d1", "d2"]).where(_place() != F.col("first")).select("id", "text_hash", "line_no", F.lit(False).alias("near"))
    gone = equal
    if max_edits:
        shared = _if_few(keys.where("half").select(F.col("key").alias("share")))
        own = lines.select("d1", F.posexplode("halves").alias("which", "share")).join(shared, "share", "left_semi")
        digests = cut(own.groupBy("d1").agg((F.min(F.col("which") % 2) == 0).alias("front"), (F.max(F.col("which") % 2) == 1).alias("back")))
        partners = cut(occurrences(lines, _if_few(digests)))
        firsts = partners.groupBy("d1", "d2").agg(F.min(_place()).alias("first")).join(digests, "d1")
        close = near_repeats(docs, key, text, cut(firsts))
        gone = equal.unionByName(partners.join(close, ["d1", "d2"]).select("id", "text_hash", "line_no", F.lit(True).alias("near")))
    no = lambda kind: F.sort_array(F.collect_set(F.when(F.col("near") == kind, F.col("line_no"))))
    found = gone.groupBy("id", "text_hash").agg(no(False).alias("equal"), no(True).alias("near"))  # a document's own lines
    return found.withColumn("equal", F.array_except("equal", "near"))


def kept(lines: Column, gone: Column) -> Column:
    """``lines`` without the sorted positions ``gone``: the runs between them, put together."""
    bounds = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(bounds) - 1),
        lambda i: F.slice(lines, F.get(bounds, i - 1) + 2, F.get(bounds, i) - F.get(bounds, i - 1) - 1),
    )
    return F.flatten(runs)


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "lines", **options) -> tuple[DataFrame, str]:
    """``docs`` with its text cleaned and a struct column ``name`` (all, equal, near, gone), whose name is returned."""
    name, id_, hash_, equal, near, parts = unused(docs, name, "id_", "hash_", "equal_", "near_", "parts_")
    gone = removals(docs, key, text, **options).select(
        F.col("id").alias(id_), F.col("text_hash").alias(hash_), F.col("equal").alias(equal), F.col("near").alias(near)
    )
    joined = docs.join(gone, column(docs, key).eqNullSafe(F.col(id_)) & (F.xxhash64(column(docs, text)) == F.col(hash_)), "left")
    none = F.array().cast("array<int>")
    cut_up = joined.withColumns({
        equal: F.coalesce(F.col(equal), none), near: F.coalesce(F.col(near), none), parts: F.split(column(docs, text), "\n", -1),
    })
    left = cut_up.withColumn(id_, F.sort_array(F.concat(F.col(equal), F.col(near)))).withColumn(hash_, kept(F.col(parts), F.col(id_)))
    all_gone = (F.size(F.col(hash_)) == 0) & column(docs, text).isNotNull()
    new_text = F.when(F.size(F.col(id_)) == 0, column(docs, text)).when(~all_gone, F.array_join(F.col(hash_), "\n"))
    facts = F.struct(
        F.when(column(docs, text).isNull(), 0).otherwise(F.size(F.col(parts))).alias("all"), F.col(equal).alias("equal"),
        F.col(near).alias("near"), F.coalesce(all_gone, F.lit(False)).alias("gone"),
    )
    return left.select(*[(new_text.alias(c) if c == text else column(docs, c)) for c in docs.columns], facts.alias(name)), name


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with repeated lines taken out, columns unchanged; those left without any line go."""
    cleaned, name = clean(docs, key, text, **options)
    return cleaned.where(~column(cleaned, name)["gone"]).select(*[column(docs, c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, removed line numbers (equal and near) and the clean text's digest and size."""
    cleaned, name = clean(docs.select("doc_id", "text"))
    facts = column(cleaned, name)
    return cleaned.select(
        "doc_id", facts["all"].cast("bigint").alias("n_lines"), facts["equal"].alias("equal_lines"), facts["near"].alias("near_lines"),
        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("kept_chars"), F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"),
    )
