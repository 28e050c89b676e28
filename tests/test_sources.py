"""Readers by name, stages, and data sets of other classes."""

import pytest
from pyspark.sql import functions as F

from deskflow import fixed, schemas
from deskflow.functions.judging import parse_judge_answer
from deskflow.functions.routing import weak_intent, whole_words
from deskflow.operators import sampling, threads
from deskflow.plans import datasets
from deskflow.sources import sinks, stage, tables


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_columns_by_name(spark, fmt):
    row = {"tweet": "a, b\nc", "gold_reply": 'say "x"', "intent": "battery_issue", "escalate": "AUTO", "reason": "r", "more": "1"}
    one, two = stage.new_path(spark, "one"), stage.new_path(spark, "two")
    for path, names in ((one, ["tweet", "gold_reply", "intent", "escalate", "reason", "more"]),
                        (two, ["more", "reason", "escalate", "intent", "tweet", "gold_reply"])):
        sinks.write(spark.createDataFrame([tuple(row[n] for n in names)], names), path, fmt)
        got = tables.scan_evaluation(spark, path, fmt).first().asDict()
        assert got == {n: row[n] for n in schemas.EVALUATION.names}
        assert tables.scan_labelled(spark, path, fmt).first()["intent"] == "battery_issue"
    with pytest.raises(ValueError, match="human_correctness"):
        tables.scan_human_review(spark, one, fmt)


def test_scratch_and_exists(spark):
    path = stage.new_path(spark, "table")
    assert not stage.exists(spark, path)
    with stage.scratch(spark) as folder:
        kept = stage.stage(spark.range(3), "inside")
        assert kept.count() == 3 and all(folder in f for f in kept.inputFiles())
        kept.write.parquet(path)
    assert stage.exists(spark, path) and not stage.exists(spark, folder)
    with pytest.raises(Exception, match="nosuch"):
        stage.exists(spark, "nosuch://host/table")


def test_other_classes_stay(spark):
    rows = spark.range(100).selectExpr("id AS tweet_id", "CASE WHEN id % 2 = 0 THEN 'billing_refund' ELSE 'own class' END AS intent")
    splits = sampling.stratified_split(rows)
    assert splits.groupBy("intent").count().collect() and {r["intent"] for r in splits.collect()} == {"billing_refund", "own class"}
    assert splits.count() == 100
    kept = {r["split"]: r["count"] for r in sampling.cap_splits(splits, totals={"train": 10}).groupBy("split").count().collect()}
    assert kept == {"train": 10, "validation": 20, "test": 20}
    assert sampling.cap_splits(splits, totals={}).count() == 100


def test_other_rules(spark):
    posts = spark.createDataFrame(
        [x for i in range(60) for x in (
            (f"{i}", "u", "True", "1", f"the printer number {i} has {'no ink' if i % 2 else 'a paper jam'} today", None, None),
            (f"r{i}", "Shop", "False", "2", f"please open the lid, case number {i}", None, f"{i}"))], schemas.POSTS)
    rules = [("ink", "no ink|toner"), ("paper", r"paper jam|tray \d+")]
    table = datasets.thread_table(posts, "Shop", rules)
    splits = datasets.build_splits(table, totals=(30, 8, 8))
    assert {(r["split"], r["intent"]) for r in splits.collect()} == {
        (s, i) for s in fixed.SPLITS for i in ("ink", "paper")}
    assert {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()} == {"train": 30, "validation": 8, "test": 8}
    past = datasets.index_rows(table, splits.filter("split <> 'train'"))
    assert past.count() == 60 - 16


def test_rules_with_a_guard(spark):
    texts = ["my ios 11 froze", "iOS update", "2fa code", "cannot login", "relogin", "can't sign in!", "shut down at 20% now", "", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.when(F.lower("t").rlike(rf"\b({p})\b"), F.lit(n)) for n, p in fixed.INTENT_RULES])
    got = df.select(weak_intent(F.col("t")).alias("a"), plain.alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] and got[0]["a"] == "software_update"
    assert "(?=[it])" in whole_words("ink|toner|inks") and "(?=" not in whole_words("(a|b)c|d")


def test_turns_across_gaps(spark):
    rows = [(1, t, "user" if t % 10 == 0 else "assistant", f"t{t}") for t in (0, 3, 10, 20, 29, 40, 55)]
    rows += [(2, 0, "user", "alone"), (3, -5, "user", "q"), (3, 9000, "assistant", "far away")]
    rows += [(4, 1, "user", "q"), (4, 1, "assistant", "z"), (4, 1, "user", None), (4, 2, "assistant", "a"), (4, 2, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for span in (1, 4, 4096):
        got = sorted(map(tuple, threads.turn_pairs(df, span).collect()))
        assert got == [(1, 0, "t0", "t3"), (1, 20, "t20", "t29"), (1, 40, "t40", "t55"), (3, -5, "q", "far away"),
                       (4, 1, "q", "a")]


def test_null_scores_are_no_scores(spark):
    answers = ['{"correctness": null, "helpfulness": 2}', '{"helpfulness": 2}', "null", None]
    df = spark.createDataFrame([(a, "Please see Settings") for a in answers], "a string, r string")
    got = [r["s"]["helpfulness"] for r in df.select(parse_judge_answer(F.col("a"), F.col("r")).alias("s")).collect()]
    assert got == [5, 2, 5, 5]


def test_samples_read_their_input_once_or_twice(spark):
    rows = spark.createDataFrame([(i, f"c{i % 3}") for i in range(50)], "tweet_id long, intent string")
    plan = sampling.stratified_sample(rows, 20, 2000)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
    got = sampling.topped_up_sample(rows, 2, 30).collect()
    assert len(got) == 30 and len({r["tweet_id"] for r in got}) == 30
