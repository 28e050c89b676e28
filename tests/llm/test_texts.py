"""Operators that judge each text by itself, against plain Python and the tokenizer libraries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from deskflow.llm import bpe, decontaminate, language, licence, tokencount
from deskflow.llm.queries import op1_decontaminate, op2_licences, op7_language, op9_bpe

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def brute_hits(texts, items, window=10):
    wins = []
    for item, text in items:
        w = words(text)
        if w:
            n = min(window, len(w))
            wins += [(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1)]
    by = {}
    for item, w in wins:
        by.setdefault(w, set()).add(item)
    sizes = {len(w) for w in by}
    out = []
    for doc, text in texts:
        w, hit, items_met = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (found := by.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    items_met |= {str(x) for x in found if x is not None}
        out.append((doc, len(w), hit, sorted(items_met)))
    return out


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, "one two three four five six seven eight nine ten eleven"), (2, "short item"), (3, ""), (4, None),
            (10, "hello hello hello hello hello hello hello hello hello hello"), (2, "short item"), (None, "a"),
            (7, "two three four five six seven eight nine ten eleven and more"), (8, "ein")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("id", F.lit("z"))


def brute_longest(texts, items, window=10):
    """Longest match of a text with an item that begins with a window of the item: words and first word."""
    items = [words(t) for _, t in items]
    out = {}
    for doc, text in texts:
        w, best = words(text), (0, None)
        for i in range(len(w)):
            for x in items:
                for g in range(max(1, len(x) - window + 1) if x else 0):
                    n = 0
                    while i + n < len(w) and g + n < len(x) and w[i + n] == x[g + n]:
                        n += 1
                    if n >= min(window, len(x)) and n > best[0]:
                        best = (n, i)
        out.setdefault(doc, set()).add(best)
    return out


@pytest.mark.parametrize("block_bytes", [1 << 23, 120])
def test_contamination_of_odd_rows(spark, odd, bench, block_bytes):
    more = spark.createDataFrame(
        [(100, "x One two THREE four five six seven eight nine ten eleven, and more short"), (101, "a short item here a"),
         (102, "two three four five six seven eight nine ten"), (103, "short\nitem short item")], "doc_id long, text string")
    texts = odd.select("doc_id", "text").union(more).where("length(text) < 10000 OR text IS NULL")
    got = decontaminate.contamination(texts, bench, block_bytes=block_bytes).collect()
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    same([(r["id"], r["n_words"], sorted(i for s in r["spans"] for i in range(s["first"], s["first"] + s["words"])),
           r["items"]) for r in got], [(d, n, sorted(h), i) for d, n, h, i in brute_hits(rows_of(texts), items)])
    want = brute_longest(rows_of(texts), items)
    assert all((r["longest"], r["longest_at"]) in want[r["id"]] for r in got) and want[100] == {(12, 2)}
    kept = decontaminate.without_contaminated(texts.withColumn("x", F.lit(1)), bench, block_bytes=block_bytes)
    assert kept.columns == ["doc_id", "text", "x"]
    same(rows_of(kept), [r for r, h in zip(rows_of(texts), brute_hits(rows_of(texts), items)) if not h[2]])


@pytest.mark.parametrize("block_bytes", [1 << 23, 400])
def test_longest_match_over_all_items(spark, block_bytes):
    """Items that share windows and run on differently, in few words; ties; an item twice and under two ids."""
    dice = random.Random(5)

    def some(n):
        return " ".join(dice.choice("ab") for _ in range(n))

    base = [some(40) for _ in range(3)]
    items = [(i, " ".join(dice.choice(base).split()[dice.randint(0, 9):dice.randint(14, 40)])) for i in range(12)]
    items += [(20, base[0]), (21, base[0]), (21, base[0]), (22, "a b"), (23, some(9))]
    texts = [(i, f"{some(dice.randint(0, 12))} {dice.choice(base)[dice.randint(0, 9) * 2:]} {some(dice.randint(0, 30))}")
             for i in range(20)] + [(50, ""), (51, None), (52, base[0]), (53, "unknown " + base[1] + " words here")]
    found = decontaminate.contamination(
        spark.createDataFrame(texts, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes).collect()
    want = brute_longest(texts, items)
    assert {r["id"]: {(r["longest"], r["longest_at"])} for r in found} == want
    assert max(n for x in want.values() for n, _ in x) >= 40


def test_contamination_query(spark, docs):
    got = op1_decontaminate(spark, "/root/testdata/sf0.001").collect()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    want = brute_hits(rows_of(docs), items)
    same([(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got],
         [(d, n, len(h), len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), bool(h)) for d, n, h, i in want])
    assert any(r["contaminated"] for r in got)


def test_contamination_empty(spark, odd, bench):
    assert decontaminate.contamination(odd.limit(0), bench).count() == 0
    assert {r["longest"] for r in decontaminate.contamination(odd, bench.limit(0)).collect()} == {0}


def brute_notices(text, weight, least=0.8):
    """Every beginning of every template, compared word by word."""
    w, out = words(text), []
    for label, key, t in licence.TEMPLATES:
        t, key = words(t), words(key)
        at = next(i for i in range(len(t)) if t[i:i + len(key)] == key)
        total = sum(weight[x] for x in t)
        for start in range(-len(t), len(w)):
            same = [0 <= start + j < len(w) and w[start + j] == x for j, x in enumerate(t)]
            share = sum(weight[x] for x, ok in zip(t, same) if ok) / total
            if all(same[at:at + len(key)]) and share >= least:
                out.append((label, start, len(t), round(share, 9)))
    return out


def test_notices_against_all_beginnings(spark):
    """Whole notices with words changed, lost at the head or the end, doubled, and one inside another."""
    dice = random.Random(3)
    rows = [None, "", "the of to and", "copy " * 300]
    for label, key, t in licence.TEMPLATES:
        w = words(t)
        rows += [t, " ".join(w[3:]), " ".join(w[:-2]), f"x {t} y {t}", " ".join(w + w[len(w) // 2:])]
        for share in (0.05, 0.15, 0.3):
            rows.append(" ".join(dice.choice([*w, "other"]) if dice.random() < share else x for x in w))
    both = words(licence.TEMPLATES[-1][2]) + words(licence.TEMPLATES[0][2])
    rows.append(" ".join(both))
    texts = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = licence.licences(texts).collect()
    seen = Counter(x for r in rows for x in set(words(r)))
    weight = {x: max(math.log((len(rows) + 1) / (seen[x] + 0.5)) + 1e-9, 1e-9) for x in licence.vocabulary()}
    found = 0
    for r in got:
        places = [(p["label"], p["first"], p["words"], round(p["share"], 9)) for p in r["places"] if not p["base"]]
        same(places, brute_notices(rows[r["id"]], weight))
        found += len(places)
    assert found > len(rows) / 2


def test_licences(spark, odd):
    more = spark.createDataFrame([(200, "mit mit license license mit license"), (201, "Licensed under CC BY-NC 4.0."),
                                  (202, "general public license " * 500), (203, "licensed under the apache licence version")],
                                 "doc_id long, text string")
    texts = odd.select("doc_id", "text").union(more)
    got = licence.licences(texts).collect()
    want = []
    for doc, text in rows_of(texts):
        w = words(text)
        for phrase, label in licence.PHRASES:
            p = phrase.split()
            want += [(doc, len(w), label, i) for i in range(len(w)) if w[i:i + len(p)] == p]
    same([(r["id"], r["n_words"], p["label"], p["first"]) for r in got for p in r["places"] if p["base"]], want)
    found = {r["id"]: {p["label"] for p in r["places"]} for r in got}
    assert found[201] == {"cc-by-nc"} and found[8] == {"mit"} and found[203] == set() and len(want) > 500
    assert licence.licences(odd.limit(0)).count() == 0


def test_licence_query(spark, docs):
    got = {r["doc_id"]: r for r in op2_licences(spark, "/root/testdata/sf0.001").collect()}
    for doc, text in rows_of(docs):
        w, r = words(text), got[doc]
        at = sorted((i, label) for phrase, label in licence.PHRASES for i in range(len(w))
                    if w[i:i + len(phrase.split())] == phrase.split())
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert (r["first_word"], r["last_word"]) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_token_counts(odd, docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for table in (odd, docs):
        want = [(d, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t in rows_of(table)]
        for cache in (1 << 19, 50):
            same([tuple(r) for r in tokencount.token_counts(table, path, cache_rows=cache).collect()], want)
    assert tokencount.token_counts(odd.limit(0), path).count() == 0


def test_merges_whose_result_ranks_lower():
    """Merged pairs that come before the pair that made them, overlaps and ties, against one merge at a time."""
    pieces = [(c, -99.0 - i) for i, c in enumerate("abc")] + [
        ("ab", -5.0), ("abc", -1.0), ("bc", -4.0), ("aa", -6.0), ("aaa", -2.0), ("aab", -6.0), ("ca", -6.0), ("cab", -3.0)]
    score = dict(pieces)

    def slow(word):
        s = list(word)
        while True:
            best = min(((-score[s[i] + s[i + 1]], i) for i in range(len(s) - 1) if s[i] + s[i + 1] in score), default=None)
            if best is None:
                return len(s)
            s[best[1]:best[1] + 2] = [s[best[1]] + s[best[1] + 1]]

    rnd = np.random.default_rng(3)
    texts = ["".join(rnd.choice(list("abc"), n)) for n in rnd.integers(1, 40, 400)]
    assert tokencount.Merger(pieces).count(texts).tolist() == [slow(t) for t in texts]


def test_bpe(spark, odd, docs):
    import tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    lib = tokenizers.Tokenizer.from_file(path)
    for table in (odd, docs):
        got = bpe.encode_decode(table, path, cache_rows=1000).collect()
        want = []
        for d, t in rows_of(table):
            ids = lib.encode(t or "", add_special_tokens=False).ids
            want.append((d, len(ids), np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)))
        same([(r["id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in got], want)
    assert bpe.encode_decode(odd.limit(0), path).count() == 0
    r = op9_bpe(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    t = docs.where("doc_id = 0").first()["text"]
    ids = lib.encode(t, add_special_tokens=False).ids
    assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def brute_grams(text):
    low = " " + text.lower() + " "
    a = [c if c.isalpha() else " " for c in low]
    out = Counter(c for c in a if c != " ")
    out.update(x + y for x, y in zip(a, a[1:]) if x + y != "  ")
    out.update(x + y + z for x, y, z in zip(a, a[1:], a[2:]) if y != " ")
    return out


def code(gram):
    out = (len(gram) - 1) * 0x110000 ** 3 if len(gram) > 1 else 0
    for i, c in enumerate(reversed(gram)):
        out += (0 if c == " " else ord(c)) * 0x110000 ** i
    return out


def test_grams(monkeypatch):
    texts = ["Hello, wörld's end", "a", "x1y", "日本 語", "abc " * 50]
    for chunk in (1 << 20, 7):
        monkeypatch.setattr(language, "_CHUNK", chunk)
        for t in texts:
            g, n = language.grams_of(t)
            assert dict(zip(g.tolist(), n.tolist())) == {code(x): c for x, c in brute_grams(t).items()}, (t, chunk)


def test_language(spark, docs, odd):
    got = {r["doc_id"]: r for r in op7_language(spark, "/root/testdata/sf0.001").collect()}
    rows = docs.collect()
    ranked = {}
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] is not None:
            ranked.setdefault(r["lang"], Counter()).update(brute_grams(r["text"]))
    order = {lang: {g: k for k, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:300])}
             for lang, c in ranked.items()}
    for r in rows[:60]:
        mine = sorted(brute_grams(r["text"]).items(), key=lambda x: (-x[1], code(x[0])))[:300]
        off = {lang: sum(abs(p[g] - k) if g in p else 300 for k, (g, _) in enumerate(mine)) for lang, p in order.items()}
        best = min(sorted(off), key=off.get)
        assert got[r["doc_id"]]["lang_pred"] == best
        assert math.isclose(got[r["doc_id"]]["score"], 1 - off[best] / (300 * len(mine)))
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    out = [r["doc_id"] for r in rows if got[r["doc_id"]]["held_out"] and r["lang"]]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows if r["doc_id"] in set(out))
    assert right >= 0.95 * len(out)
    strange = {r["id"]: r["lang_pred"] for r in language.identify(odd).collect()}
    assert [strange[i] for i in (0, 1, 2, 5)] == ["und"] * 4 and strange[None] in ("en", "de")
    assert language.identify(odd.limit(0)).count() == 0
