"""The agent of the queries against an exact search over all threads that are not held out."""

import numpy as np

from deskflow import queries
from deskflow.plans import datasets

SF = "/root/testdata/sf0.001"


def test_past_cases_beyond_the_caps(spark, monkeypatch):
    build = datasets.build_splits
    monkeypatch.setattr(datasets, "build_splits", lambda table: build(table, totals=(60, 12, 12)))
    agent, splits = queries.fitted(spark, SF)
    past = datasets.index_rows(queries.thread_table(spark, SF), splits.filter("split <> 'train'"))
    rows = agent.encoder.encode(past).collect()
    assert len(rows) > splits.filter("split = 'train'").count()
    assert {r["id"] for r in agent.index.collect()} == {r["tweet_id"] for r in rows}

    monkeypatch.setattr(queries, "fitted", lambda *_: (agent, splits))
    got = queries.batch_predictions(spark, SF).limit(200).collect()
    asked = spark.createDataFrame([(r["tweet_id"], r["tweet"]) for r in got], "tweet_id string, tweet string")
    vectors = {r["tweet_id"]: np.array(r["embedding"]) for r in agent.encoder.encode(asked).collect()}

    def unit(a):
        n = np.linalg.norm(a, axis=-1, keepdims=True)
        return a / np.where(n > 0, n, 1)

    index = unit(np.array([r["embedding"] for r in rows]))
    known = {}
    for k, r in enumerate(rows):
        known.setdefault((r["tweet"], r["gold_reply"]), k)
    for r in got:
        exact = index @ unit(vectors[r["tweet_id"]])
        shown = [c["similarity"] for c in r["retrieved_context"]]
        assert np.allclose(shown, np.sort(exact)[::-1][:5], atol=2e-6)
        assert np.allclose(shown, [exact[known[c["tweet"], c["apple_reply"]]] for c in r["retrieved_context"]], atol=2e-6)
