import pytest
from pyspark.sql import functions as F

from deskflow.operators import metrics
from deskflow.operators.models import class_weights
from deskflow.operators.terms import term_stats, term_stats_large
from deskflow.plans.evaluate import evaluate_predictions


def cells(spark, tp, fp, fn, tn):
    rows = [("ESCALATE", "ESCALATE", tp), ("AUTO", "ESCALATE", fp), ("ESCALATE", "AUTO", fn), ("AUTO", "AUTO", tn)]
    df = spark.createDataFrame(rows, "t string, p string, n int")
    return df.select("t", "p", F.explode(F.array_repeat(F.lit(1), F.col("n"))))


@pytest.mark.parametrize("counts, scores", [
    ((46, 30, 0, 124), (0.85, 0.6053, 1.0, 0.7541)),
    ((268, 310, 6, 1154), (0.8182, 0.4637, 0.9781, 0.6291)),
    ((0, 0, 0, 3), (1.0, 0.0, 0.0, 0.0)),
])
def test_binary(spark, counts, scores):
    got = metrics.escalation_scores(cells(spark, *counts), "t", "p").first()
    assert tuple(round(x, 4) for x in got[:4]) == scores
    assert got["eval_samples"] == sum(counts)


def pairs(spark):
    return spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("a", "d")], "t string, p string")


def test_macro_counts_labels_of_both_sides(spark):
    got = metrics.macro_prf(pairs(spark), "t", "p").first()
    # a: p 1/2 r 1/3, b: p 1/2 r 1, c: 0, d: 0
    assert got["precision_macro"] == pytest.approx(0.25)
    assert got["recall_macro"] == pytest.approx((1 / 3 + 1) / 4)
    assert got["macro_f1"] == pytest.approx((0.4 + 2 / 3) / 4)
    assert [r[0] for r in metrics.sorted_labels(pairs(spark), "t", "p").collect()] == ["a", "b", "c", "d"]


def test_confusion_matrix_has_all_cells(spark):
    df = metrics.confusion_matrix(pairs(spark), "t", "p")
    rows = {(r["truth"], r["predicted"]): (r["n"], r["share"]) for r in df.collect()}
    assert len(rows) == 16
    assert rows["a", "a"] == (1, pytest.approx(1 / 3))
    assert rows["c", "c"] == (0, 0.0) and rows["d", "d"] == (0, 0.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_report_and_weights(spark):
    rows = {r["label"]: r for r in metrics.class_report(pairs(spark), "t", "p").collect()}
    assert rows["accuracy"]["f1"] == pytest.approx(0.4)
    assert rows["weighted avg"]["recall"] == pytest.approx(0.4)
    assert rows["macro avg"]["support"] == 5
    weights = {r["intent"]: r["weight"] for r in class_weights(pairs(spark).withColumnRenamed("t", "intent")).collect()}
    assert weights == {"a": pytest.approx(5 / 9), "b": pytest.approx(5 / 3), "c": pytest.approx(5 / 3)}


def test_majority_tie_goes_to_the_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "intent string")
    assert metrics.majority_class(df).first()["intent"] == "a"


def test_document(spark):
    df = spark.createDataFrame(
        [("a", "a", "AUTO", "AUTO", "Please see Settings now"), ("b", "a", "ESCALATE", "AUTO", "no")],
        "ground_truth_intent string, intent string, ground_truth_escalate string, decision string, generated_reply string")
    plain = evaluate_predictions(df, "d").first()
    assert plain["intent_classification"]["accuracy"] == 0.5
    assert plain["escalation_decision"]["recall"] == 0.0
    assert plain["reply_quality_judge"]["status"].startswith("Skipped")
    review = df.select(F.col("generated_reply").alias("gold_reply"), F.lit(5.0).alias("human_average_score"))
    judged = evaluate_predictions(df, "d", True, review).first()["reply_quality_judge"]
    assert judged["total_evaluated"] == 2 and judged["human_agreement"]["sample_size"] == 2


def test_term_stats(spark):
    df = spark.createDataFrame([("The cat the CAT a",), ("cat",), ("",)], "text string")
    got = {r["term"]: (r["tf"], r["df"]) for r in term_stats(df, "text").collect()}
    assert got == {"cat": (3, 2), "the": (2, 1), "the cat": (2, 1), "cat the": (1, 1)}


def test_term_stats_without_a_shuffle_of_all_terms(spark):
    # Twenty frequent words, ties among them, a tail that is all different, a very long word, nulls and empty texts.
    df = spark.range(4000).select(
        F.when(F.col("id") % 97 == 0, None).when(F.col("id") % 89 == 0, "").otherwise(F.concat_ws(
            " ", F.concat(F.lit("hot"), F.col("id") % 20), F.lit("all all"), F.concat(F.lit("tail"), F.col("id")),
            F.when(F.col("id") % 9 == 0, F.repeat(F.lit("x"), 3000)))).alias("text"))
    for top in (3, 25, 60, 20000):
        want = sorted(map(tuple, term_stats(df, "text", top).collect()))
        for size in ({}, {"buckets": 3}, {"buckets": 256}):
            assert sorted(map(tuple, term_stats_large(df, "text", top, **size).collect())) == want
    assert term_stats_large(df.limit(0), "text").count() == 0


def test_rare_terms_are_not_read_again(spark):
    """The last pass ends before it reads a text when no other bucket reaches the bound."""
    df = spark.range(20000).select(F.concat_ws(
        " ", F.lit("all"), F.concat(F.lit("hot"), F.col("id") % 4), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    got = term_stats_large(df, "text", 5, buckets=1 << 16)
    assert [r["tf"] for r in got.collect()] == [20000, 5000, 5000, 5000, 5000]
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Generate" not in final


def test_words_and_pairs_are_counted_by_batches(spark, monkeypatch):
    """No row per occurrence leaves a task, whatever the size of the pieces; odd characters, nulls and one text of many words."""
    from deskflow.functions import counting
    from deskflow.operators import terms

    texts = [("\u00c4pfel \u00e4pfel \u0130x x_1 \u4e2d\u6587 \U00010400\U00010401 a b",), (None,), ("",), ("ab cd " * 500,), ("cd ab",), ("ab",), ("cd",)] * 9
    df = spark.createDataFrame(texts, "text string").repartition(3)
    want = sorted(map(tuple, term_stats(df, "text", 1000).collect()))
    plans, write = [], terms.stage

    def seen(rows, name):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(rows, name)

    monkeypatch.setattr(terms, "stage", seen)
    for at_once in (1, 7, counting.WORDS_AT_ONCE):
        monkeypatch.setattr(terms, "bucket_totals", lambda n: counting.bucket_totals(n, at_once))
        monkeypatch.setattr(terms, "chosen_terms", lambda s, n: counting.chosen_terms(s, n, at_once))
        for buckets in (2, 1 << 12):
            assert sorted(map(tuple, term_stats_large(df, "text", 1000, buckets).collect())) == want
            assert sorted(map(tuple, term_stats_large(df, "text", 2, buckets).collect())) == sorted(
                map(tuple, term_stats(df, "text", 2).collect()))
    assert not any("Generate" in p for p in plans)
