"""Suffix arrays and repeated byte strings against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskflow.llm import repeats, suffix
from deskflow.llm.queries import op10_repeats


@pytest.mark.parametrize("wide", [4096, 2])
def test_suffix_array(monkeypatch, wide):
    monkeypatch.setattr(suffix, "_WIDE", wide)
    rnd = np.random.default_rng(1)
    for t in range(200):
        s = rnd.integers(1, rnd.integers(2, 6), rnd.integers(1, 200))
        if t % 5 == 0:
            s = np.resize(s[:7], len(s))
        s = np.append(s, 0).astype(np.uint8)
        b, sa = s.tobytes(), suffix.suffix_array(s)
        assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        want = np.zeros(len(b), int)
        for i, j in zip(sa[1:].tolist(), sa[:-1].tolist()):
            while b[i + want[i]] == b[j + want[i]]:
                want[i] += 1
        assert suffix.permuted_common_prefixes(s, sa).tolist() == want.tolist()


def brute(texts, least=200):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for i in range(len(b) - least + 1):
            seen[b[i:i + least]] = seen.get(b[i:i + least], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - least + 1):
            if seen[b[i:i + least]] > 1:
                gone[i] += 1
                if i + least < len(b):
                    gone[i + least] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~mask])
        n_spans = int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum())
        out.append((len(b), int(mask.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return out


def mixed_texts():
    rnd = random.Random(11)
    word = ["ab", "é", "the ", "of ", "日本", "zz\n", "qu", "x. "]
    make = lambda n: "".join(rnd.choice(word) + rnd.choice("abcdefgh") for _ in range(n))
    shared, other = make(150), make(90)
    out = [make(rnd.randrange(1, 300)) for _ in range(30)]
    for i in range(40):
        # Near copies of one passage, each with an edit of its own.
        at = rnd.randrange(0, len(shared) - 5)
        out.append(make(rnd.randrange(0, 30)) + shared[:at] + rnd.choice(["", "##", "@"]) + shared[at + i % 3:] + make(5))
    out += [shared, shared, other * 3, "a" * 5000, "a" * 199, "a" * 200, "ab" * 400, other[:70] + "a" * 300, "é" * 100,
            "x" + "é" * 99 + "y", "\0" * 250, "", None, make(2000) + other + make(2000)]
    return out


@pytest.mark.parametrize("crowd", [8192, 3])
def test_repeats(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "_BUFFER", 1 << 12)
    texts = mixed_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = repeats.repeats(docs, crowd=crowd).orderBy("id").collect()
    assert [(r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got] == brute(texts)


def test_cut_texts(spark):
    texts = mixed_texts()
    docs = spark.createDataFrame([(i, t, -1, "s") for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_chars long, spans string")
    spans = {r["id"]: [(s["first"], s["bytes"]) for s in r["spans"]] for r in repeats.repeats(docs).collect()}
    got = {r["doc_id"]: r for r in repeats.without_repeats(docs).collect()}
    for i, t in enumerate(texts):
        want, at = "", 0
        for c in t or "":
            size = len(c.encode())
            if not all(any(f <= x < f + n for f, n in spans[i]) for x in range(at, at + size)):
                want += c
            at += size
        assert got[i]["text"] == (None if t is None else want)
        assert got[i]["n_chars"] == (len(want) if spans[i] else -1) and got[i]["spans"] == "s"


def test_odd_rows(spark, odd):
    rows = odd.select("doc_id", "text").collect()
    got = repeats.repeats(odd).collect()
    want = [(r["doc_id"], *x) for r, x in zip(rows, brute([r["text"] for r in rows]))]
    assert sorted([(r["id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got], key=repr) == \
        sorted(want, key=repr)
    assert repeats.repeats(odd.limit(0)).count() == 0
    assert repeats.without_repeats(odd).columns == odd.columns


def test_query(spark, docs):
    got = op10_repeats(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    rows = docs.orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute([r["text"] for r in rows])
    assert sum(r["n_removed"] for r in got) > 0
    assert repeats.without_repeats(docs).select(F.sum("n_chars")).first()[0] > 0


def test_small_batches_only_lowers(spark):
    from deskflow.llm.common import small_batches

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for start, want in (("10000", "1024"), ("0", "1024"), ("100", "100")):
            spark.conf.set(key, start)
            small_batches(spark)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)
