"""Registered queries leave out no row of their tables."""

import pyarrow.parquet as pq

from deskflow import queries
from deskflow.plans import evaluate

SF = "/root/testdata/sf0.001"


def test_turn_pairs_of_the_whole_table(spark):
    rows = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in pq.read_table(
        f"{SF}/conversations.parquet").to_pylist())
    want = [(a[0], a[1], a[3], b[3]) for a, b in zip(rows, rows[1:])
            if a[0] == b[0] and a[2] == "user" and b[2] == "assistant"]
    got = queries.turn_pairs(spark, SF).select("conv_id", "turn", "tweet", "gold_reply").collect()
    assert sorted(map(tuple, got)) == want


def test_attach_truth_of_every_thread(spark):
    got = {r["tweet_id"]: r["ground_truth_intent"] for r in queries.attach_truth(spark, SF).collect()}
    want = {r["tweet_id"]: "general_inquiry" if int(r["tweet_id"]) % 3 == 0 else r["intent"]
            for r in queries.thread_rows(spark, SF).collect()}
    assert got == want and any(int(i) % 11 == 0 for i in got)


def test_predictions_without_truth(spark):
    predictions = spark.createDataFrame([("1", "a"), ("2", "b"), ("11", "c")], "tweet_id string, intent string")
    truth = spark.createDataFrame([("11", "x"), ("1", "y"), ("4", "z")], "tweet_id string, intent string")
    got = evaluate.attach_truth(predictions, truth).select("tweet_id", "intent", "ground_truth_intent").collect()
    assert sorted(map(tuple, got)) == [("1", "a", "y"), ("11", "c", "x")]
