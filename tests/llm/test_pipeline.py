"""The pipeline against its stages in plain Python."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from test_simhash import brute_components, brute_fingerprint
from test_texts import brute_hits

SF = "/root/testdata/sf0.001"


def cut(texts, least=200):
    data = [t.encode() for t in texts]
    seen = Counter(b[i:i + least] for b in data for i in range(len(b) - least + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - least + 1):
            if seen[b[i:i + least]] > 1:
                gone[i:i + least] = True
        text, at = "", 0
        for c in b.decode():
            n = len(c.encode())
            if not gone[at:at + n].all():
                text += c
            at += n
        out.append(text)
    return out


def brute(rows, items):
    """doc_id and ids of what the pipeline leaves."""
    import tokenizers

    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    parts = brute_components([(i, brute_fingerprint(t)) for i, (_, t) in enumerate(rows)])
    groups = {}
    for row, c in zip(rows, parts):
        groups.setdefault(c, []).append(row)
    rows = [min(g) for g in groups.values()]
    rows = list(zip([d for d, _ in rows], cut([t for _, t in rows])))
    hit = {d for d, _, h, _ in brute_hits(rows, items) if h}
    return sorted((d, np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()) for d, t in rows if d not in hit)


def test_run(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = corpus_pipeline.run(spark, SF).collect()
    want = brute(rows, items)
    assert sorted((r["doc_id"], bytes(r["ids"])) for r in got) == want and 0 < len(want) < len(rows)
    assert all(r["ids_sha256"] == hashlib.sha256(r["ids"]).hexdigest() and r["n_tokens"] * 4 == len(r["ids"]) for r in got)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_rows(spark, odd, k):
    name, function = corpus_pipeline.STAGES[k]
    table = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (table, table.limit(0)):
        got = function(spark, rows, SF)
        assert k == 4 or got.columns == table.columns
        n = got.count()
        assert n == 0 if rows is not table else 0 < n <= table.count()
