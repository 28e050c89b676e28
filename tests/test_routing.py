import pytest
from pyspark.sql import functions as F

from deskflow import fixed
from deskflow.functions.judging import heuristic_scores, parse_judge_answer
from deskflow.functions.routing import baseline_route, match_keyword, route, weak_intent
from deskflow.operators.rubric import human_agreement, score_replies
from deskflow.plans.datasets import review_mean, with_truth_route
from reviewed import REVIEWED

CASES = [
    ("account_security", 0.95, "Can you help me with my account?", "ESCALATE", "account_security"),
    ("billing_refund", 0.92, "I need assistance with an invoice.", "ESCALATE", "billing_refund"),
    ("battery_issue", 0.90, "My iPhone was stolen at the gym yesterday!", "ESCALATE", "'stolen'"),
    ("battery_issue", 0.90, "My iPhone was STOLEN phone", "ESCALATE", "'STOLEN'"),
    ("app_store", 0.88, "I suspect there is fraud on my Apple Card.", "ESCALATE", "'fraud'"),
    ("app_store", 0.88, "defrauded me", "AUTO", "High confidence app store (0.88)"),
    ("software_update", 0.45, "The thing on my screen looks weird.", "ESCALATE", "(0.45 < 0.6)"),
    ("battery_issue", 0.92, "My iPhone battery health is at 76%.", "AUTO", "High confidence battery issue (0.92)"),
    ("device_setup", 0.75, "How do I setup Quick Start for my new phone?", "AUTO", "Standard device setup query (0.75)"),
    ("app_store", 0.60, "x", "AUTO", "Standard app store query (0.60)"),
    ("app_store", 0.85, "x", "AUTO", "High confidence app store (0.85)"),
    ("app_store", float("nan"), "x", "ESCALATE", "Low intent classifier confidence"),
    ("app_store", None, "x", "ESCALATE", "Low intent classifier confidence (unknown < 0.6)"),
    (None, 0.9, None, "AUTO", "High confidence"),
]


@pytest.mark.parametrize("intent, confidence, text, decision, part", CASES)
def test_route(spark, intent, confidence, text, decision, part):
    df = spark.createDataFrame([(text, intent, confidence)], "t string, i string, c double")
    got = df.select(route(F.col("t"), F.col("i"), F.col("c")).alias("r")).first()["r"]
    assert got["decision"] == decision
    assert part in got["reason"]


def test_route_with_own_lists(spark):
    df = spark.createDataFrame([("a C++ leak", "b", 0.7), ("fine", "a", 0.7), ("fine", "b", 0.7)], "t string, i string, c double")
    r = route(F.col("t"), F.col("i"), F.col("c"), ["a"], ["leak"], auto=0.7, escalate=0.5)
    assert [x[0]["decision"] for x in df.select(r).collect()] == ["ESCALATE", "ESCALATE", "AUTO"]


def test_weak_intent_priority(spark):
    texts = ["refund for hacked account", "charged for icloud", "iOS 11 is bad", "hackathon", "hello"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(weak_intent(F.col("t"))).collect()] == [
        "account_security", "billing_refund", "software_update", None, None]


def test_keyword_word_bounds(spark):
    df = spark.createDataFrame([(t,) for t in ("stolen phone", "lostx", "élost", "it is lost", "")], "t string")
    assert [r[0] for r in df.select(match_keyword(F.col("t"))).collect()] == ["stolen", None, None, "lost", None]


def test_baseline_route(spark):
    df = spark.createDataFrame([("Hackathon", "app_store"), ("x", "billing_refund"), ("x", None)], "t string, i string")
    assert [r[0] for r in df.select(baseline_route(F.col("t"), F.col("i"))).collect()] == ["ESCALATE", "ESCALATE", "AUTO"]


@pytest.fixture(scope="module")
def reviewed(spark):
    rows = [(i, t, intent, esc, reply, *s) for i, (t, intent, esc, reply, s) in enumerate(REVIEWED)]
    names = ", ".join(f"human_{n} int" for n in fixed.RUBRIC)
    return spark.createDataFrame(rows, f"i int, tweet string, truth string, truth_route string, gold_reply string, {names}")


def test_rules_on_reviewed_rows(reviewed):
    labelled = with_truth_route(reviewed.withColumn("intent", weak_intent(F.col("tweet"))))
    rows = labelled.collect()
    assert len(rows) == 30
    for r in rows:
        assert (r["intent"], r["escalate"]) == (r["truth"], r["truth_route"])
        if r["escalate"] == "AUTO":
            words = r["intent"].replace("_", " ")
            assert r["reason"] == f"High confidence {words} (0.90) with standard resolution path"


def test_agreement_on_reviewed_rows(reviewed):
    scored = score_replies(review_mean(reviewed), "gold_reply")
    got = human_agreement(scored, "human_average_score", "average_score").first()
    assert got["sample_size"] == 30
    assert got["pearson_correlation"] == pytest.approx(0.01359, abs=1e-5)
    assert got["mean_absolute_error"] == pytest.approx(0.3)
    assert got["agreement_within_1_point_pct"] == 100.0
    assert got["human_mean_score"] == pytest.approx(4.6667, abs=1e-4)
    assert got["judge_mean_score"] == pytest.approx(4.8833, abs=1e-4)


def test_constant_side_has_no_correlation(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 5.0)], "h double, j double")
    assert human_agreement(df, "h", "j").first()["pearson_correlation"] is None
    assert human_agreement(df, "h", "j", 0.85).first()["pearson_correlation"] == 0.85


def test_heuristic_scores(spark):
    df = spark.createDataFrame([("did it",), ("please go",), (" ".join(["help"] * 71),), (None,)], "r string")
    rows = [tuple(r[0])[:5] for r in df.select(heuristic_scores(F.col("r"))).collect()]
    assert rows == [(5, 5, 4, 3, 4.25), (5, 4, 5, 3, 4.25), (4, 4, 5, 5, 4.5), (5, 4, 4, 3, 4.0)]


def test_parse_judge_answer(spark):
    answers = [
        '{"correctness": 5, "helpfulness": "3", "brand_tone": 4.9, "groundedness": 2, "explanation": "e"}',
        '{}', '{"correctness": ', '{"correctness": "good"}', None,
    ]
    df = spark.createDataFrame([(a, "did it") for a in answers], "a string, r string")
    rows = [tuple(x[0]) for x in df.select(parse_judge_answer(F.col("a"), F.col("r"))).collect()]
    assert rows[0] == (5, 3, 4, 2, 3.5, "e")
    assert rows[1] == (4, 4, 4, 4, 4.0, None)
    fallback = (5, 5, 4, 3, 4.25, fixed.HEURISTIC_EXPLANATION)
    assert rows[2:] == [fallback] * 3
