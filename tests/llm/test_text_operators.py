"""Text operators against brute force on small tables, with nulls, empty and long texts, repeated rows and clashing names."""

import base64
import hashlib
import random
import re
import tempfile
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from tallyframe.llm import (
    components, decontaminate, lines, passages, pieces, quality, shards, simhash, toxicity, urlfilter, warc,
)

RNG = random.Random(7)
VOCABULARY = ["".join(RNG.choice("abcdeéß") for _ in range(RNG.randint(2, 7))) for _ in range(300)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = [prose(60) + ".\n" + prose(40) + "." for _ in range(12)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(20, base[0]), (21, base[0].replace(" ", "  ", 1)), (22, base[1] + " x"), (23, None), (24, ""), (25, " \n\t "), (26, "a"), (27, "A b")]
    rows += [(28, prose(5000)), (29, "Und " * 200), (30, base[2] + "\n" + base[3]), (31, "*** ### %%% " * 40), (None, base[4]), (None, None)]
    return rows + [(2, base[2]), (20, base[0])]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "x", 7) for i, t in texts], "doc_id long, text string, lang string, size string, n_words int").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_decontamination(spark, docs, texts, block):
    full = [t for _, t in texts if t]
    items = [(1, " ".join(plain_words(full[0])[5:30]).upper()), (2, "a"), (3, None), (4, ""), (5, prose(30)), (6, " ".join(plain_words(full[3])[:12])), (6, "a")]
    table = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = plain_words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(str(i))
    want = Counter()
    for d, t in texts:
        w, hit, names = plain_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names |= windows[tuple(w[k : k + n])]
        want[d, len(w), len(hit), ",".join(sorted(names))] += 1
    found, name = decontaminate.find(docs, table, block_bytes=block)
    got = Counter((r["doc_id"], r[name]["n_words"], r[name]["n_hit"], ",".join(r[name]["items"])) for r in found.collect())
    assert got == want
    clean = decontaminate.remove_documents(docs, table, block_bytes=block)
    assert clean.columns == docs.columns and clean.count() == sum(n for k, n in want.items() if not k[2])
    left, again = decontaminate.find(decontaminate.remove_spans(docs, table, block_bytes=block), table)
    assert left.where(F.col(again)["n_hit"] > 0).count() == 0


def test_decontamination_contract_columns(spark, docs, empty):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    rows = {r["doc_id"]: r for r in decontaminate.report(docs, items).collect()}
    assert rows[26]["contaminated"] and rows[26]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    assert rows[24]["items_sha256"] == hashlib.sha256(b"").hexdigest() and rows[24]["n_words"] == 0
    assert decontaminate.report(empty, items).count() == 0 and decontaminate.report(docs, items.limit(0)).where("contaminated").count() == 0


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * shards.MULTIPLIER + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(RNG.getrandbits(63) for _ in range(200))]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 16, 17, 100):
        got = {r["k"]: r["s"] for r in frame.select("k", shards.jump(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k % 2**64, n) for k in keys}


def test_shards(spark, docs, texts, empty, monkeypatch):
    monkeypatch.setattr(shards, "RUN", 3)
    many = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(5, "same")] * 50, "doc_id long, text string"))
    rows = shards.assign(many, shards=4, pieces=3).collect()
    assert len(rows) == len(texts) + 50
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (d, size(t), zlib.crc32((t or "").encode())) for d, t in [*texts, *[(5, "same")] * 50]
    )
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 4) and r["law"] == "key"
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})
    assert shards.assign(empty).count() == 0
    out = tempfile.mkdtemp()
    shards.write(docs, out, shards=4, files=2)
    assert spark.read.parquet(out).count() == len(texts)


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_url_filter(spark, block, monkeypatch):
    urls = ["http://a.NET/x", "http://b.example.net/en/1", "https://example.com/de/?q", "http://net", "http://notnet/", None, "", "mailto:x", "http://x.org/fr/#a",
            "http://example.net/en", "x://y://net/", "http://a.net/\nfoo", "http://a.net/x"]
    frame = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame([*urlfilter.RULES, ("net/", "allow")], "rule string, verdict string")

    def best(u):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        h, p = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(r), r, v) for r, v in urlfilter.RULES if (h == r.split("/")[0] or h.endswith("." + r.split("/")[0])) and p.startswith(r[r.index("/"):])]
        return (h, p, max(fit)[1], max(fit)[2]) if fit else (h, p, None, "allow")

    real = urlfilter.judge
    monkeypatch.setattr(urlfilter, "judge", lambda pages, table: real(pages, table, block_bytes=block))
    got = {r["page_id"]: tuple(r)[1:] for r in urlfilter.report(frame, rules).collect()}
    assert got == {k: best(u) for k, u in enumerate(urls)}
    assert urlfilter.report(frame.limit(0), rules).count() == 0


def test_url_index_confirms_strings(monkeypatch):
    monkeypatch.setattr(urlfilter.xxhash, "xxh64_intdigest", lambda x: 5)  # every digest collides
    index = urlfilter.Index(urlfilter.pack(urlfilter.RULES))
    assert index.best(["a.net", "example.net", "q"], ["/x", "/en/", "/"]) == [("net/", "block"), ("example.net/en/", "allow"), (None, None)]


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def test_line_dedup(spark):
    rng, base = random.Random(3), [prose(8, random.Random(k)) for k in range(10)]
    rows = []
    for k in range(60):
        own = []
        for _ in range(rng.randint(1, 4)):
            t = rng.choice(base)
            at = rng.randrange(len(t))
            own.append(rng.choice([t, t[:at] + t[at + 1 :], t[:at] + "z" + t[at + 1 :], t[:at] + "q" + t[at:], "short", "shorn", "  " + t + " ", "a" * 30, "a" * 31, "ab" * 20]))
        rows.append((k, "\n".join(own)))
    rows += [(70, None), (71, ""), (72, "\n\n"), (None, base[0]), (73, prose(2000, rng)), (74, rows[0][1])]
    frame = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, line_no int, first string")
    key = {t: xxhash.xxh64_intdigest(t.encode(), seed=42) for _, t in rows if t is not None}
    signed = lambda x: x - 2**64 if x >> 63 else x
    places = sorted(((i is None, i or 0, signed(key[t]), n), l.strip(" \t\r")) for i, t in rows if t is not None for n, l in enumerate(t.split("\n")))
    places = [(p, l) for p, l in places if l]
    equal, near = defaultdict(list), defaultdict(list)
    first = {}
    for p, l in places:
        first.setdefault(l, p)
    long = [l for l in first if len(l) >= lines.MIN_CHARS]
    close = {l for l in long if any(first[m] < first[l] and l != m and one_edit(l, m) for m in long)}
    assert "short" in first and "shorn" in first  # equal short lines go, one edit does not join them
    for p, l in places:
        if l in close:
            near[p[:2]].append(p[3])
        elif first[l] != p:
            equal[p[:2]].append(p[3])
    got = {(r["doc_id"] is None, r["doc_id"] or 0): r for r in lines.report(frame).collect()}
    assert len(got) == len(rows) and close and equal
    for k, r in got.items():
        assert (r["equal_lines"], r["near_lines"]) == (sorted(equal[k]), sorted(near[k])), k
    for i, t in rows:
        k = (i is None, i or 0)
        left = [l for n, l in enumerate((t or "").split("\n")) if n not in equal[k] + near[k]]
        assert got[k]["kept_md5"] == hashlib.md5("\n".join(left).encode()).hexdigest()
    kept = lines.dedup(frame)
    assert kept.columns == frame.columns and {70, 71, 72} <= {r["doc_id"] for r in kept.collect()} and 74 not in {r["doc_id"] for r in kept.collect()}
    assert lines.report(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        lines.removals(frame, max_edits=2)


def test_pieces_match_the_library(spark, docs, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    odd = ["", None, "  a  b ", "tab\there\n\nnl", "é́ ﬁ Ａ", "日本語 \u3000x", "<s> <0x41>", "a\x00b\r\n", "🙂🙂 x", " " * 50, "x" * 700, "ab" * 400 + "日" * 300, "▁x", *(t for _, t in texts)]
    coder = pieces.Encoder(pieces.load())
    for t, ids in zip(odd, coder.encode(odd), strict=True):
        if t is None:
            assert ids is None
        else:
            assert ids.tolist() == model.encode(t), repr(t[:40])
            assert coder.decode(ids) == t.replace("▁", " ")
    rows = pieces.tokens(docs).collect()
    assert Counter((r["doc_id"], tuple(r["token_ids"] or ())) for r in rows) == Counter((i, tuple(model.encode(t or ""))) for i, t in texts)
    back = pieces.tokens(docs).select(pieces.decode(F.col("token_ids"), pieces.load(), spark).alias("t")).collect()
    assert Counter(r["t"] for r in back) == Counter(t for _, t in texts)
    assert pieces.report(docs.limit(0)).count() == 0


def plain_fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs, texts, empty):
    prints = [(i, plain_fingerprint(t)) for i, t in texts]
    root = {f: f for _, f in prints}
    for _ in root:
        for a, b in combinations(list(root), 2):
            if bin(a ^ b).count("1") <= 2:
                root[a] = root[b] = min(root[a], root[b])
    least = {r: min((i for i, f in prints if root[f] == r and i is not None), default=None) for r in root.values()}
    got = Counter(tuple(r) for r in simhash.report(docs).collect())
    assert got == Counter((i, f"{f:016x}", least[root[f]]) for i, f in prints)
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter(set(least.values()))
    assert simhash.report(empty).count() == 0


@pytest.mark.parametrize("refine", [1, 512])
def test_links_find_all_within_the_radius(spark, refine):
    rng, fps = random.Random(5), set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(8):
            fps.add(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64)
    signed = lambda x: x - 2**64 if x >> 63 else x
    root = {signed(f): signed(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(root, 2):
        if bin((a ^ b) % 2**64).count("1") <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = components.components(simhash.links(spark.createDataFrame([(x,) for x in root], "fp long"), refine=refine))
    got = {r["node"]: r["root"] for r in found.collect()}
    assert {x: got.get(x, x) for x in root} == {x: find(x) for x in root}


def test_warc(spark, docs, texts):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://x/ä \n"), "lang").alias("url"), F.col("text").alias("html"), F.lit(1).alias("file"))
    folder = f"file://{tempfile.mkdtemp()}/w"
    leaders = {}
    for i, t in texts:
        leaders[t or ""] = max(leaders.get(t or "", -1), -1 if i is None else i)
    got = Counter(tuple(r) for r in warc.report(pages, folder).collect())
    want = Counter()
    for i, t in texts:
        raw, lead = (t or "").encode(), leaders[t or ""]
        revisit = lead >= 0 and lead != i
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want[i, len(raw), digest, "revisit" if revisit else "response", lead if revisit else None] += 1
    assert got == want
    index = spark.read.parquet(f"{folder}/index")
    some = warc.read(index.where("record_type = 'response' and offset > 0"), folder).collect()
    assert some and all(hashlib.sha1(r["payload"]).digest() == base64.b32decode(r["payload_digest"]) for r in some)
    assert warc.report(pages.limit(0), f"file://{tempfile.mkdtemp()}/w").count() == 0


def test_passages(spark):
    rng = random.Random(11)
    shared = ". ".join(prose(12, rng) for _ in range(5)) + "."
    rows = [(1, prose(30, rng) + ".\n" + shared + "\n" + prose(30, rng) + "."), (2, "Intro here. " + "".join(c.upper() if c.isascii() else c for c in shared) + " " + prose(20, rng)), (3, prose(40, rng) + "."),
            (4, shared.replace(" ", "  ")), (5, None), (6, ""), (7, "Yes. No."), (8, "Yes. No."), (9, prose(50, rng) + "."), (9, prose(51, rng) + ".")]
    rows += [(10, rows[2][1]), (3, rows[2][1]), (None, shared)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, unit int")
    got = {(r["doc_id"], r["first_doc_id"]): (r["begin_char"], r["end_char"], r["n_words"]) for r in passages.report(frame).collect()}
    two = rows[1][1]
    assert got == {(2, 1): (12, 12 + len(shared), 60), (4, 1): (0, len(rows[3][1]), 60), (10, 3): (0, len(rows[2][1]), 40), (None, 1): (0, len(shared), 60)}
    left = Counter((r["doc_id"], r["text"]) for r in passages.dedup(frame).collect())
    want = Counter((i, t) for i, t in rows if i not in (2, 4, 10, None))
    assert left == want + Counter([(2, two[:12] + two[12 + len(shared):]), (4, ""), (10, ""), (None, "")])
    assert passages.report(frame.limit(0)).count() == 0


def test_toxicity(spark):
    rng = random.Random(2)
    bad, rows, labels = ["zzbad", "zzugly"], [], []
    for k in range(600):
        toxic = k % 3 == 0
        body = prose(rng.randint(5, 80), rng).split()
        if toxic:
            body.insert(rng.randrange(len(body)), rng.choice(bad).upper() + ",")
        rows.append((k, " ".join(body), rng.choice(["en", "de", None]), 1.0))
        labels.append((k, 1, int(toxic)))
    rows += [(1000, None, "en", 1.0), (1001, "", None, 1.0), (None, "zzbad", "en", 1.0), (3, rows[3][1], "en", 1.0), (1002, "x " * 5000 + "zzugly", "de", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5000, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.report(docs, marks).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"]]
    assert held and all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in got if r["doc_id"] is not None)
    wrong = [r["doc_id"] for r in held if r["doc_id"] < 600 and r["predicted"] != labels[r["doc_id"]][2]]
    assert len(wrong) <= 0.02 * len(held)
    by = {r["doc_id"]: r for r in got}
    assert by[1000]["score"] == by[1001]["score"] and by[1000]["predicted"] == 0 and by[1002]["predicted"] == 1
    kept = toxicity.remove(docs, marks)
    assert kept.columns == docs.columns and 1002 not in {r["doc_id"] for r in kept.collect()}
    assert {r["score"] for r in toxicity.report(docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.report(docs.limit(0), marks).count() == 0


def test_quality(spark, docs, texts, empty):
    def figures(text):
        text = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", text)
        seen = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
        full = [l for l in text.split("\n") if re.search("[^\x20\x09-\x0d]", l)]
        return len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in text), len(full) - len(set(full)), len(covered)

    more = [(40, "x y z x y z q x y z x y"), (41, "a b\na b\n\nc\n a b"), (42, "é\x0bß\x0c𝄞 \u00a0w"), (43, "Und Und Und"), (44, "one two"), (45, "SHOUT!! " * 60)]
    frame = docs.select("doc_id", "text", "size").unionByName(spark.createDataFrame([(i, t, "s") for i, t in more], "doc_id long, text string, size string"))
    got = quality.report(frame).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r["doc_id"], *(r[c] for c in names)) for r in got) == Counter((i, *figures(t)) for i, t in [*texts, *more])
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert set(range(12)) <= kept and not kept & {29, 31, 45, 24}
    good = quality.keep_good(frame)
    assert good.columns == frame.columns and good.count() == sum(r["kept"] for r in got)
    assert quality.report(empty.select("doc_id", "text")).count() == 0
