"""SentencePiece encoding and decoding with a suffix array, for BPE models with byte fallback.

A text becomes units that no merge can cross: runs of the space mark with what follows up to the next one, and
characters that no piece has. A batch's different units are put behind each other and indexed by a suffix array
(sorted to the depth of the longest piece). Every piece is found by binary search as one range of it. The ranges
give all edges (start, length, piece), which a counting sort lays out by position. Relaxing a unit takes, again and
again, its best-scored edge over two neighbouring symbols (the leftmost of equals), until none is left: what the
model's own merge order gives. All units of a batch relax side by side; one of over ``LONG`` characters uses a heap.
Characters without a piece become their UTF-8 bytes' pieces. Decoding puts pieces together again.

The vocabulary is read from a model file on the driver (its path is a parameter) and broadcast; it has a fixed size.
Whole texts are encoded; units met before are kept per worker, up to ``CACHE`` of them.

Edge cases: a null text has null ids; an empty text has none; the space mark U+2581 in a text counts as a space,
as the model has it; control characters and characters without a piece go by bytes; repeated rows are each encoded.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LONG = 256
CACHE = 250_000
CHUNK_BYTES = 1 << 19
ENCODED = "struct<ids: array<int>, exact: boolean>"
_END = 0x110000  # stands after each unit; no character has this number


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]  # that text can match
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray  # by byte
    texts: list[bytes]  # of every id, for decoding
    prefix: bool  # a space mark is put before a text

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces))


def load(path: str = MODEL) -> Vocabulary:
    """Read a model file. Only BPE models with byte fallback and without text normalisation are taken."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    shape = sentencepiece.SentencePieceNormalizer(model_file=path)
    probe = "ﬁ  Ａ "
    seen = shape.normalize(probe)
    if seen.removeprefix(MARK) != probe.replace(" ", MARK):
        raise ValueError("the model normalises its text")
    kinds = [(model.is_control(i) or model.is_unknown(i), model.is_byte(i), model.id_to_piece(i)) for i in range(model.get_piece_size())]
    byte_ids = {int(p[3:5], 16): i for i, (_, byte, p) in enumerate(kinds) if byte}
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte pieces")
    plain = [i for i, (special, byte, _) in enumerate(kinds) if not special and not byte]
    texts = [b"" if special else bytes([int(p[3:5], 16)]) if byte else p.replace(MARK, " ").encode() for special, byte, p in kinds]
    return Vocabulary(
        [kinds[i][2] for i in plain], np.array(plain, np.int32), np.array([model.get_score(i) for i in plain], np.float64),
        np.array([byte_ids[b] for b in range(256)], np.int32), texts, seen.startswith(MARK),
    )


class SuffixArray:
    """Starts of a text of numbers, sorted by their first ``depth`` numbers.

    Several numbers are packed into one sort key; deeper levels sort by the rank so far and what follows. The sorted
    keys of each level are kept for searching.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.alphabet, codes = np.unique(text, return_inverse=True)
        codes = codes.astype(np.int64) + 1  # 0 is before every number, and behind the end
        self.bits = int(len(self.alphabet)).bit_length()
        n = len(codes)
        codes = np.concatenate((codes, np.zeros(depth + 64, np.int64)))
        self.levels: list[tuple[int, int, np.ndarray]] = []  # (numbers covered before, numbers packed, sorted keys)
        rank, rank_bits, covered = np.zeros(n, np.int64), 0, 0
        while covered < depth:
            take = min((63 - rank_bits) // self.bits, depth - covered)
            keys = rank.copy()
            for k in range(take):
                keys = (keys << self.bits) | codes[covered + k : covered + k + n]
            self.order = np.argsort(keys)
            ordered = keys[self.order]
            self.levels.append((covered, take, ordered))
            step = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            rank = np.empty(n, np.int64)
            rank[self.order] = step
            rank_bits, covered = int(step[-1]).bit_length() if n else 1, covered + take

    def ranges(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece (not longer than the depth) the range of the array whose suffixes begin with it.

        Pieces stand behind each other in ``flat``.
        """
        longest = int(sizes.max())
        known = np.full((len(sizes), longest), -1, np.int64)
        at = np.searchsorted(self.alphabet, flat)
        code = np.where(self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == flat, at + 1, -1)
        known[np.arange(longest) < sizes[:, None]] = code
        possible = ((known >= 0) | (np.arange(longest) >= sizes[:, None])).all(1)
        begin, end = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        open_, rank = np.flatnonzero(possible), np.zeros(int(possible.sum()), np.int64)
        for covered, take, ordered in self.levels:
            if not len(open_):
                break
            low = rank.copy()
            high = rank.copy()
            for k in range(take):
                inside = sizes[open_] > covered + k
                digit = known[open_, covered + k] if covered + k < longest else np.full(len(open_), -1)
                low = (low << self.bits) | np.where(inside, digit, 0)
                high = (high << self.bits) | np.where(inside, digit, (1 << self.bits) - 1)
            a, b = np.searchsorted(ordered, low), np.searchsorted(ordered, high, side="right")
            begin[open_], end[open_] = a, b
            deeper = (sizes[open_] > covered + take) & (b > a)
            closed = (sizes[open_] > covered + take) & (b <= a)
            end[open_[closed]] = begin[open_[closed]]
            step = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            open_, rank = open_[deeper], step[a[deeper]]
        return begin, end


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.wide = vocabulary.longest + 1
        self.codes = np.frombuffer("".join(vocabulary.pieces).encode("utf-32-le"), np.uint32)
        self.sizes = np.array([len(p) for p in vocabulary.pieces])
        lonely = "" if any("\n" in p for p in vocabulary.pieces) else "\n"  # no merge crosses it
        self.unit = re.compile(f"{MARK}*[^{MARK}{lonely}]+|{MARK}+|\n")
        self.known: dict[str, bytes] = {}

    def units(self, text: str) -> list[str]:
        marked = text.replace(" ", MARK)
        return self.unit.findall(MARK + marked if self.v.prefix and text else marked)

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        cut_up = [None if t is None else self.units(t) for t in texts]
        fresh = {u for units in cut_up if units for u in units} - self.known.keys()
        if len(self.known) + len(fresh) > CACHE:
            self.known.clear()
            fresh = {u for units in cut_up if units for u in units}
        if fresh:
            fresh = sorted(fresh)
            self.known.update(zip(fresh, self.solve(fresh), strict=True))
        get = self.known.__getitem__
        return [None if u is None else np.frombuffer(b"".join(map(get, u)), np.int32) for u in cut_up]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.v.texts.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.v.prefix and text.startswith(" ") else text

    def edges(self, text: np.ndarray) -> np.ndarray:
        """Piece numbers by (start, length), -1 where there is none: all matches, in order of position."""
        index = SuffixArray(text, self.wide - 1)
        begin, end = index.ranges(self.codes, self.sizes)
        found = np.flatnonzero(end > begin)
        counts = end[found] - begin[found]
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = index.order[np.repeat(begin[found], counts) + inside]
        out = np.full(len(text) * self.wide, -1, np.int32)
        out[starts * self.wide + np.repeat(self.sizes[found], counts)] = np.repeat(found, counts)
        return out

    def solve(self, units: list[str]) -> list[bytes]:
        """The ids of each unit, as bytes of 32-bit numbers."""
        lengths = np.array([len(u) for u in units], np.int64)
        text = np.frombuffer("\U0010ffff".join(units).encode("utf-32-le") + b"\0\0\0\0", np.uint32).copy()
        firsts = np.concatenate(([0], np.cumsum(lengths + 1)))
        text[firsts[1:] - 1] = _END
        table = self.edges(text)
        begin, end, owner = self._relax(table, firsts[:-1], lengths)
        number = table[begin * self.wide + np.minimum(end - begin, self.wide - 1)]
        ids = np.where(number >= 0, self.v.ids[number], -1)
        if (ids < 0).any():
            ids, owner = self._bytes(text, begin, ids, owner)
        bounds = np.searchsorted(owner, np.arange(len(units) + 1))
        raw = ids.astype(np.int32).tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _bytes(self, text: np.ndarray, begin: np.ndarray, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without a piece are single characters; each becomes its bytes."""
        lost = np.flatnonzero(ids < 0)
        spelled = [chr(c).encode("utf-8", "surrogatepass") for c in text[begin[lost]].tolist()]
        counts = np.ones(len(ids), np.int64)
        counts[lost] = [len(s) for s in spelled]
        at = np.repeat(np.arange(len(ids)), counts)
        out = ids[at]
        out[out < 0] = self.v.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return out, owner[at]

    def _relax(self, table: np.ndarray, firsts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, unit) of the symbols that are left, in order."""
        owner = np.repeat(np.arange(len(lengths)), np.where(lengths <= LONG, lengths, 0))
        begin = firsts[owner] + np.arange(len(owner)) - np.searchsorted(owner, owner)
        end = begin + 1
        done = []
        for k in np.flatnonzero(lengths > LONG).tolist():
            b = self._relax_long(table, int(firsts[k]), int(lengths[k]))
            done.append((b, np.append(b[1:], firsts[k] + lengths[k]), np.full(len(b), k)))
        while len(owner):
            score = self._pair_scores(table, begin, end, owner)
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.maximum.reduceat(score, starts)
            sizes = np.diff(np.append(starts, len(owner)))
            at = np.where(score == np.repeat(best, sizes), np.arange(len(owner)), len(owner))
            pick = np.minimum.reduceat(at, starts)[best > -np.inf]  # leftmost of equals
            still = np.repeat(best > -np.inf, sizes)
            done.append((begin[~still], end[~still], owner[~still]))
            end[pick] = end[pick + 1]
            still[pick + 1] = False
            begin, end, owner = begin[still], end[still], owner[still]
        begin, end, owner = (np.concatenate([d[k] for d in done] or [np.zeros(0, np.int64)]) for k in range(3))
        order = np.argsort(begin)
        return begin[order], end[order], owner[order]

    def _pair_scores(self, table: np.ndarray, begin: np.ndarray, end: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Of each symbol and the next of its unit: the score of the piece they make, -inf if none."""
        score = np.full(len(begin), -np.inf)
        size = end[1:] - begin[:-1]
        pair = np.flatnonzero((owner[1:] == owner[:-1]) & (size < self.wide))
        number = table[begin[pair] * self.wide + size[pair]]
        score[pair] = np.where(number >= 0, self.v.scores[number], -np.inf)
        return score

    def _relax_long(self, table: np.ndarray, first: int, length: int) -> np.ndarray:
        """The same for one unit, with a heap of edges; returns the starts of the symbols left."""
        last = first + length
        after = {p: p + 1 for p in range(first, last)}  # end of the symbol that begins here
        before = {p: p - 1 for p in range(first + 1, last)}
        heap: list[tuple[float, int, int]] = []

        def offer(p: int) -> None:
            q = after[p]
            if q < last and after[q] - p < self.wide and (k := table[p * self.wide + after[q] - p]) >= 0:
                heapq.heappush(heap, (-self.v.scores[k], p, after[q]))

        for p in range(first, last - 1):
            offer(p)
        while heap:
            _, p, e = heapq.heappop(heap)
            q = after.get(p, e)
            if q >= e or after.get(q) != e:
                continue  # one of the two has changed since
            after[p] = e
            del after[q]
            if e < last:
                before[e] = p
            offer(p)
            if p > first:
                offer(before[p])
        return np.array(sorted(after), np.int64)


def encode(text: Column, vocabulary: Vocabulary, spark) -> Column:
    """A column of ENCODED: the ids, and whether decoding them gives the text back (space marks read as spaces)."""
    sent, state = spark.sparkContext.broadcast(vocabulary), []

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not state:
            state.append(Encoder(sent.value))
        for texts in batches:
            for chunk in _chunks(texts):
                yield _coded(chunk, state[0])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, ENCODED)(text)


def _coded(texts: list[str | None], coder: Encoder) -> pa.Array:
    """ENCODED of a chunk, as Arrow arrays: no Python object outlives its chunk."""
    ids = coder.encode(texts)
    none = np.array([x is None for x in ids], bool)
    exact = [None if t is None else coder.decode(x) == t.replace(MARK, " ") for t, x in zip(texts, ids, strict=True)]
    ends = np.cumsum([0 if x is None else len(x) for x in ids], dtype=np.int32)
    offsets = pa.array(np.concatenate((np.zeros(1, np.int32), ends)), mask=np.append(none, False))
    flat = np.concatenate([np.zeros(0, np.int32), *[x for x in ids if x is not None]])
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(exact, pa.bool_())], names=["ids", "exact"])


def decode(ids: Column, vocabulary: Vocabulary, spark) -> Column:
    """The text of an array of ids; null for null."""
    sent, state = spark.sparkContext.broadcast(vocabulary), []

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not state:
            state.append(Encoder(sent.value))
        for rows in batches:
            yield pd.Series([None if r is None else state[0].decode(np.asarray(r, np.int32)) for r in rows], dtype="object")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(ids)


def _chunks(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts in runs of about CHUNK_BYTES; a longer text is a run of its own."""
    total = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)))
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + CHUNK_BYTES, side="right")) - 1)
        yield texts.slice(begin, end - begin).to_pylist()
        begin = end


def tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """The key, n_tokens, token_ids and exact of every document."""
    coded = docs.select(column(docs, key).alias(key), encode(column(docs, text), load(model), docs.sparkSession).alias("coded"))
    return coded.select(
        F.col(key), F.coalesce(F.array_size("coded.ids"), F.lit(0)).cast("bigint").alias("n_tokens"), F.col("coded.ids").alias("token_ids"),
        F.col("coded.exact").alias("exact"),
    )


def report(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 (ids joined by commas), exact (the round trip holds)."""
    return tokens(docs, model=model).select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.coalesce("token_ids", F.array().cast("array<int>")), ","), 256).alias("ids_sha256"), "exact"
    )
