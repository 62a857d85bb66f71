"""Quality by weak supervision: rules vote good or bad or abstain, and their accuracies are estimated without labels.

Only column expressions and one grouped count are used. The base figures come from whole texts. Each rule looks at one
figure and votes both ways on it: +1 (good) on its usual side, -1 (bad) far from it, 0 (abstains) between. The base
rule has settled the documents that fail it, so the model is that of the others: they are counted by their vote
pattern, at most 3^rules rows whatever the data. On those counts expectation-maximisation runs inside one expression.
The model is the share of good documents and, for each rule and class, how often it votes good when it votes; an
abstention tells nothing. The first guess is the share of good among a document's votes. No accuracy is bounded: a rule whose bad
votes stand alone is found to be wrong and loses its say, rules that confirm each other gain it. A document's
posterior follows from its own votes; it is kept at ``KEEP`` or more.

The figures are written once to the shared folder, as the counts and the verdicts both read them. Windows of three
words are compared by a 64-bit hash inside one text.

Edge cases: a null, empty or blank text has no word, zero figures, and fails the base rule; an empty table gives
an empty result; repeated rows are each judged and each counted; a rule that never votes tells nothing; where every
document fails the base rule the posterior is that of no evidence; columns of ``docs`` named like the added ones stay,
the added ones take another name. Patterns run in time linear in the text, however long a word is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, cut, unused

SYMBOLS = "#*$%&|<>"
KEEP = 0.5
ROUNDS = 25
#: Added to each count, as if so many more documents had voted that way.
SMOOTH = 1.0
_BLANK = r"\x20\x09-\x0D"
_SPACE = f"[{_BLANK}]+"
#: A word with a letter and none of SYMBOLS, and a mark that ends a sentence.
_PLAIN = rf"(?<![^{_BLANK}])(?=[^{_BLANK}\p{{L}}]*+\p{{L}})[^{_BLANK}{SYMBOLS}]++(?![^{_BLANK}])"
_END = rf"[.!?…](?![^{_BLANK}])"

FIGURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclaims", "n_plain", "n_ends"]


def figures(docs: DataFrame, text: str = "text", name: str = "figures") -> tuple[DataFrame, str]:
    """``docs`` with a struct column of FIGURES, whose name is returned. Steps are apart so that each is computed once."""
    name, body, words, lines, hashes, places = unused(docs, name, "body_", "words_", "lines_", "hashes_", "places_")
    out = docs.withColumn(body, F.coalesce(column(docs, text), F.lit("")))
    out = out.withColumns({
        words: F.array_remove(F.split(F.col(body), _SPACE, -1), ""),
        lines: F.filter(F.split(F.col(body), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    w = F.col(words)
    out = out.withColumn(hashes, _windows(w))
    h = F.col(hashes)
    out = out.withColumn(places, F.when(F.size(F.array_distinct(h)) == F.size(h), F.array().cast("array<int>")).otherwise(_repeated(h)))
    covered = _covered(F.col(places))
    length = F.length(F.col(body))
    counted = {
        "n_words": F.size(w), "word_chars": F.length(F.array_join(w, "")), "n_symbols": F.regexp_count(F.col(body), F.lit(f"[{SYMBOLS}]")),
        "n_lines": F.size(F.col(lines)), "n_dup_lines": F.size(F.col(lines)) - F.size(F.array_distinct(F.col(lines))),
        "n_repeat_words": covered, "n_capitals": F.regexp_count(F.col(body), F.lit("[A-Z]")),
        "n_exclaims": length - F.length(F.replace(F.col(body), F.lit("!"), F.lit(""))),
        "n_plain": F.regexp_count(F.col(body), F.lit(_PLAIN)), "n_ends": F.regexp_count(F.col(body), F.lit(_END)),
    }
    struct = F.struct(*[counted[c].cast("bigint").alias(c) for c in FIGURES])
    return out.select(*[column(docs, c) for c in docs.columns], struct.alias(name)), name


def _windows(words: Column) -> Column:
    """A hash of every three consecutive words."""
    from_second, from_third = F.slice(words, F.lit(2), F.size(words)), F.slice(words, F.lit(3), F.size(words))
    pairs = F.zip_with(words, from_second, lambda a, b: F.xxhash64(a, b))
    hashed = F.zip_with(pairs, from_third, lambda p, c: F.when(c.isNotNull(), F.xxhash64(p, c)))
    return F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(F.slice(hashed, F.lit(1), F.greatest(F.size(words) - 2, F.lit(1))))


def _repeated(hashes: Column) -> Column:
    """Sorted positions of the hashes that stand in the array twice or more."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    n = F.size(hashes)

    def pick(s: Column) -> Column:
        before = F.concat(F.array(F.lit(None).cast("struct<h: bigint, i: int>")), F.slice(s, F.lit(1), F.greatest(n - 1, F.lit(0))))
        after = F.concat(F.slice(s, F.lit(2), n), F.array(F.lit(None).cast("struct<h: bigint, i: int>")))
        same = lambda a, b: F.when(a["h"] == b["h"], b["i"])
        with_before, with_after = F.zip_with(before, s, same), F.zip_with(after, s, same)
        return F.sort_array(F.array_compact(F.zip_with(with_before, with_after, lambda a, b: F.coalesce(a, b))))

    return F.get(F.transform(F.array(placed), pick), F.lit(0))


def _covered(places: Column) -> Column:
    """Words inside the three-word windows at the sorted places: each adds up to three, less what the next shares."""
    gaps = F.zip_with(places, F.slice(places, F.lit(2), F.size(places)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    return F.when(F.size(places) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(0), lambda s, x: s + x))


def votes(f: Column) -> dict[str, Column]:
    """The rules' votes on a struct of FIGURES. A text without words is only called too short."""
    words, chars, lines, ends = (F.greatest(f[c], F.lit(1)) for c in ("n_words", "word_chars", "n_lines", "n_ends"))
    mean, sentence = f["word_chars"] / words, f["n_words"] / ends

    def vote(bad: Column, good: Column) -> Column:
        return F.when(f["n_words"] == 0, 0).when(bad, -1).when(good, 1).otherwise(0)

    def little(share: Column, good: float, bad: float) -> Column:
        return vote(share > bad, share <= good)

    return {
        "length": F.when(f["n_words"] < 20, -1).when(f["n_words"] >= 100, 1).otherwise(0),
        "word_length": vote(~mean.between(3, 10), mean.between(4, 7)),
        "sentence_length": vote(~sentence.between(3, 40), sentence.between(5, 25)),
        "plain_words": vote(f["n_plain"] / words < 0.8, f["n_plain"] / words >= 0.95),
        "symbols": little(f["n_symbols"] / words, 0.02, 0.1),
        "repeated_lines": little(f["n_dup_lines"] / lines, 0.1, 0.3),
        "repeated_words": little(f["n_repeat_words"] / words, 0.05, 0.2),
        "capitals": little(f["n_capitals"] / chars, 0.1, 0.3),
        "exclaims": little(f["n_exclaims"] / words, 0.02, 0.1),
    }


def posterior(votes_: Column, model: Column, rules: int) -> Column:
    """Probability of good, from an array of votes and a model (odds, seen: log share of each vote by rule and class)."""
    total = model["odds"]
    for rule in range(rules):
        bad = F.lit(6 * rule + 1) + F.get(votes_, F.lit(rule))  # the place of the vote among the bad class's
        total = total + F.get(model["seen"], bad + 3) - F.get(model["seen"], bad)
    return 1 / (1 + F.exp(-total))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _estimate(rows: Column, rules: int) -> Column:
    """The model of patterns (v, n, good), where good is the expected number of good documents."""

    def counted(weight) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda s, x: s + weight(x))

    def by_cell(both: Column) -> Column:
        def share(cell: Column) -> Column:
            rule, good, vote = F.floor(cell / 6).cast("int"), F.floor(cell / 3).cast("int") % 2, cell % 3 - 1
            own = lambda x: F.when(good == 1, x["good"]).otherwise(x["n"] - x["good"])
            this = counted(lambda x: F.when(F.get(x["v"], rule) == vote, own(x)).otherwise(0.0))
            other = counted(lambda x: F.when(F.get(x["v"], rule) == -vote, own(x)).otherwise(0.0))
            return F.when(vote == 0, F.lit(0.0)).otherwise(F.log((this + SMOOTH) / (this + other + 2 * SMOOTH)))

        odds = F.log((both["good"] + SMOOTH) / (both["bad"] + SMOOTH))
        return F.struct(odds.alias("odds"), F.transform(F.sequence(F.lit(0), F.lit(6 * rules - 1)), share).alias("seen"))

    return _bind(F.struct(counted(lambda x: x["good"]).alias("good"), counted(lambda x: x["n"] - x["good"]).alias("bad")), by_cell)


def fit(patterns: DataFrame, rules: int, rounds: int = ROUNDS) -> Column:
    """The model estimated on a table (votes, n) of at most 3^rules rows, as one scalar subquery."""

    def row(x: Column, good: Column) -> Column:
        return F.struct(x["v"].alias("v"), x["n"].alias("n"), (x["n"] * good).alias("good"))

    def step(rows: Column, _: Column) -> Column:
        return _bind(_estimate(rows, rules), lambda m: F.transform(rows, lambda x: row(x, posterior(x["v"], m, rules))))

    counts = patterns.agg(F.sort_array(F.collect_list(F.struct(F.col("votes").alias("v"), F.col("n").cast("double").alias("n")))).alias("rows"))
    cast = lambda v, vote: F.size(F.filter(v, lambda y: y == vote))
    first = F.transform("rows", lambda x: row(x, (cast(x["v"], 1) + 1) / (cast(x["v"], 1) + cast(x["v"], -1) + 2)))
    started = counts.select(first.alias("rows"))
    return started.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.col("rows"), step, lambda rows: _estimate(rows, rules)).alias("model")).scalar()


def verdicts(measured: DataFrame, figures_of: str, name: str = "quality") -> tuple[DataFrame, str]:
    """``measured`` with its struct of FIGURES replaced by one with votes, base_failed, good and kept besides."""
    written = cut(measured)
    name, v = unused(written, name, "votes")
    fig = column(written, figures_of)
    cast = written.withColumn(v, F.array(*votes(fig).values()))
    rules = len(votes(fig))
    failed = (fig["n_words"] < 50) | (100 * fig["n_repeat_words"] > 50 * fig["n_words"])
    patterns = cast.where(~failed).groupBy(F.col(v).alias("votes")).agg(F.count("*").alias("n"))
    good = posterior(F.col(v), fit(patterns, rules), rules)
    rows = cast.withColumn(name, F.struct(*[fig[c].alias(c) for c in FIGURES], F.col(v).alias("votes"), failed.alias("base_failed"), good.alias("good")))
    q = F.col(name)
    return rows.withColumn(name, q.withField("kept", ~q["base_failed"] & (q["good"] >= KEEP))).drop(v, figures_of), name


def judge(docs: DataFrame, text: str = "text", name: str = "quality") -> tuple[DataFrame, str]:
    """``docs`` with a struct column (FIGURES, votes, base_failed, good, kept), whose name is returned."""
    return verdicts(*figures(docs, text), name)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, columns unchanged."""
    judged, name = judge(docs, text)
    return judged.where(column(judged, name)["kept"]).select(*[column(docs, c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base figures, base_failed, kept, and the posterior."""
    measured, f = figures(docs.select("doc_id", "text"))
    judged, name = verdicts(measured.drop("text"), f)
    q = column(judged, name)
    wanted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "good"]
    return judged.select("doc_id", *[q[c].alias(c) for c in wanted])
