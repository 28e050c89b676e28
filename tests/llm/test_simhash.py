"""SimHash links and components against all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from deskflow.llm import simhash
from deskflow.llm.queries import op4_simhash


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(rows):
    """Rows (id, fingerprint) to the smallest id reachable."""
    prints = sorted({f for _, f in rows})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [least.get(find(f)) for _, f in rows]


def signed(f):
    return f - (1 << 64) if f >> 63 else f


@pytest.mark.parametrize("bucket", [256, 2, 0])
def test_links(spark, bucket):
    rnd = random.Random(5)
    prints = {0, 1, 3, 7, (1 << 64) - 1, 1 << 63}
    for _ in range(40):
        f = rnd.getrandbits(64)
        for _ in range(8):
            prints.add(f)
            f ^= 1 << rnd.randrange(64)
            if rnd.random() < 0.6:
                f ^= 1 << rnd.randrange(64)
            if rnd.random() < 0.2:
                f ^= 1 << rnd.randrange(64)
    prints = sorted(prints)
    edges = simhash.links(spark.createDataFrame([(signed(f),) for f in prints], "f long"), bucket)
    got = {(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in edges.distinct().collect()}
    assert all((a ^ b).bit_count() <= 2 for a, b in got)
    roots = simhash.components(edges)
    by = {r["node"]: r["root"] for r in roots.collect()}
    want = brute_components([(i, f) for i, f in enumerate(prints)])
    groups = {}
    for i, f in enumerate(prints):
        groups.setdefault(by.get(signed(f), signed(f)), []).append(i)
    assert sorted(min(g) for g in groups.values() for _ in g) == sorted(want)
    assert {i: min(g) for g in groups.values() for i in g} == dict(enumerate(want))
    if bucket == 256:
        assert {frozenset(p) for p in got} == {frozenset((a, b)) for i, a in enumerate(prints) for b in prints[:i]
                                               if (a ^ b).bit_count() <= 2}


def test_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = sorted(((r["id"], r["f"] & (1 << 64) - 1, r["component"]) for r in simhash.near_duplicates(odd).collect()), key=repr)
    prints = [(d, brute_fingerprint(t)) for d, t in rows]
    assert got == sorted(((d, f, c) for (d, f), c in zip(prints, brute_components(prints))), key=repr)
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_query_and_keep_one(spark, docs):
    got = op4_simhash(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    rows = sorted((r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect())
    want = brute_components(rows)
    assert [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got] == [
        (d, f"{f:016x}", c) for (d, f), c in zip(rows, want)]
    kept = simhash.keep_one(docs.union(docs.limit(20)).withColumn("component", F.lit(1)))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))
    assert kept.columns == [*docs.columns, "component"]


def test_keep_one_of_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    prints = [(i, brute_fingerprint(t)) for i, (_, t) in enumerate(rows)]
    groups = {}
    for (d, _), c in zip(rows, brute_components(prints)):
        groups.setdefault(c, []).append(d)
    want = [min((d for d in g if d is not None), default=None) for g in groups.values()]
    kept = simhash.keep_one(odd)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert kept.columns == odd.columns and simhash.keep_one(odd.limit(0)).count() == 0
