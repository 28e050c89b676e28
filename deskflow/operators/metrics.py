"""Classification and routing metrics.

Every metric starts from counts by (truth, prediction): one pass with map-side combine over the data, then
a table of at most labels x labels rows.
"""

from pyspark.sql import Column, DataFrame, functions as F

from deskflow import fixed
from deskflow.functions.routing import is_escalated
from deskflow.functions.text import round_binary


def _ratio(num: Column, den: Column) -> Column:
    """Quotient, 0 where the divisor is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def label_counts(df: DataFrame, label: str = "intent") -> DataFrame:
    """Rows per label, most frequent first."""
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)


def majority_class(df: DataFrame, label: str = "intent") -> DataFrame:
    """Most frequent label; a tie goes to the first in sorted order."""
    return label_counts(df.filter(F.col(label).isNotNull()), label).limit(1)


def pair_counts(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """Rows (or summed ``weight``) by truth and prediction."""
    rows = F.sum(weight) if weight else F.count("*")
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(rows.alias("n"))


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.agg(F.avg(F.coalesce((F.col(truth) == F.col(predicted)).cast("double"), F.lit(0.0))).alias("accuracy"))


def label_union(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Distinct labels of either column, from one pass over the rows."""
    pairs = pair_counts(df, truth, predicted)
    return pairs.select(F.explode(F.array("truth", "predicted")).alias("label")).distinct()


def sorted_labels(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """``label_union`` in order."""
    return label_union(df, truth, predicted).orderBy("label")


def per_label(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every label that occurs as truth or prediction."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("truth").alias("label"), hit.cast("long").alias("tp"), F.col("n").alias("support"),
                 zero.alias("selected")),
        F.struct(F.col("predicted").alias("label"), zero.alias("tp"), zero.alias("support"),
                 F.col("n").alias("selected")),
    )
    totals = pairs.select(F.inline(sides)).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("tp", "support", "selected")]
    )
    return totals.select(
        "label",
        _ratio(F.col("tp"), F.col("selected")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("selected")).alias("f1"),
        "support",
    )


def macro_prf(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Unweighted means over the union of true and predicted labels."""
    return per_label(pair_counts(df, truth, predicted)).agg(
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("macro_f1"),
    )


def intent_scores(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """Accuracy, macro precision / recall / F1 and row count in one row."""
    pairs = pair_counts(df, truth, predicted, weight)
    hits = pairs.agg(
        _ratio(F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)),
               F.sum("n")).alias("accuracy"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("eval_samples"),
    )
    macro = per_label(pairs).agg(
        F.struct(F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
                 F.avg("f1").alias("macro_f1")).alias("m")
    )
    return hits.select("accuracy", macro.scalar().alias("m"), "eval_samples").select(
        "accuracy", "m.precision_macro", "m.recall_macro", "m.macro_f1", "eval_samples"
    )


def binary_counts(truth: Column, predicted: Column, n: Column | None = None) -> list[Column]:
    """Sums tp, fp, fn, tn of 0/1 columns."""
    n = F.lit(1) if n is None else n
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    return [
        F.coalesce(F.sum(F.when((truth == t) & (predicted == p), n).otherwise(F.lit(0))), F.lit(0)).alias(name)
        for name, (t, p) in cells.items()
    ]


def _binary_ratios() -> list[Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return [
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        (tp + fp + fn + tn).alias("eval_samples"),
    ]


def binary_prf(df: DataFrame, truth: Column, predicted: Column, n: Column | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 of 0/1 columns, one row."""
    return df.agg(*binary_counts(truth, predicted, n)).select(*_binary_ratios())


def escalation_scores(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    n = F.col(weight) if weight else None
    return binary_prf(df, is_escalated(F.col(truth)), is_escalated(F.col(predicted)), n)


def class_report(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """Per label scores, then the rows accuracy, macro avg and weighted avg."""
    pairs = pair_counts(df, truth, predicted, weight)
    labels = per_label(pairs)
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    overall = pairs.agg(_ratio(F.sum(hit), F.sum("n")).alias("s"), F.sum("n").alias("support")).select(
        F.lit("accuracy").alias("label"), F.col("s").alias("precision"), F.col("s").alias("recall"),
        F.col("s").alias("f1"), "support",
    )
    scores = ("precision", "recall", "f1")
    macro = labels.agg(*[F.avg(c).alias(c) for c in scores], F.sum("support").alias("support"))
    weighted = labels.agg(
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in scores],
        F.sum("support").alias("support"),
    )
    return (
        labels.unionByName(overall)
        .unionByName(macro.withColumn("label", F.lit("macro avg")))
        .unionByName(weighted.withColumn("label", F.lit("weighted avg")))
    )


def confusion_matrix(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Count and row share of every (truth, predicted) cell over all labels present, zeros included.

    The labels are gathered from the pair counts, not from the data, and spread out from one row.
    """
    pairs = pair_counts(df, truth, predicted)
    labels = pairs.select(F.explode(F.array("truth", "predicted")).alias("label")).agg(
        F.collect_set("label").alias("labels")
    )
    cells = labels.select("labels", F.explode("labels").alias("truth")).select(
        "truth", F.explode("labels").alias("predicted")
    )
    rows = pairs.groupBy("truth").agg(F.sum("n").alias("row_total"))
    filled = cells.join(pairs, ["truth", "predicted"], "left").join(rows, "truth", "left")
    n, total = F.coalesce("n", F.lit(0)), F.coalesce("row_total", F.lit(0))
    return filled.select("truth", "predicted", n.alias("n"), _ratio(n, total).alias("share"))


def compare_models(predictions: DataFrame) -> DataFrame:
    """One row per model from a long table (model, truth, predicted, truth_route, route), in one pass."""
    counts = predictions.groupBy(
        "model", "truth", "predicted",
        is_escalated(F.col("truth_route")).alias("e_truth"), is_escalated(F.col("route")).alias("e_route"),
    ).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("long")

    def rows_where(condition: Column) -> Column:
        return F.when(condition, F.col("n")).otherwise(zero)

    e_truth, e_route = F.col("e_truth") == 1, F.col("e_route") == 1
    # The truth side carries what is counted once per row.
    once = {"hits": rows_where(F.col("truth") == F.col("predicted")), "rows": F.col("n"),
            "tp": rows_where(e_truth & e_route), "fp": rows_where(~e_truth & e_route),
            "fn": rows_where(e_truth & ~e_route)}
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("both"), *[c.alias(k) for k, c in once.items()]),
        F.struct(F.col("predicted").alias("label"), F.col("n").alias("both"), *[zero.alias(k) for k in once]),
    )
    per_class = counts.select("model", F.inline(sides)).groupBy("model", "label").agg(
        *[F.sum(c).alias(c) for c in ("both", *once)]
    )
    total = per_class.groupBy("model").agg(
        F.avg(_ratio(2 * F.col("hits"), F.col("both"))).alias("intent_macro_f1"), *[F.sum(c).alias(c) for c in once]
    )
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    return total.select(
        "model",
        _ratio(F.col("hits"), F.col("rows")).alias("intent_accuracy"),
        "intent_macro_f1",
        _ratio(tp, tp + fn).alias("escalation_recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("escalation_f1"),
    )


def majority_predictions(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """The majority baseline: the most frequent training intent for every row, never escalated."""
    majority = majority_class(train).select("intent")
    return evaluation.select(
        F.col("intent").alias("truth"), majority.scalar().alias("predicted"),
        F.col("escalate").alias("truth_route"), F.lit("AUTO").alias("route"),
    )


def majority_baseline(train: DataFrame, evaluation: DataFrame, model: str = "majority") -> DataFrame:
    return compare_models(majority_predictions(train, evaluation).withColumn("model", F.lit(model)))


def score_distribution(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def metrics_document(
    dataset: str,
    intents: DataFrame,
    escalation: DataFrame,
    judge: DataFrame | None = None,
    agreement: DataFrame | None = None,
) -> DataFrame:
    """One nested row of all metrics, rounded; the inputs are one-row frames."""
    scores = intents.select(
        *[round_binary(F.col(c), 4).alias(c) for c in ("accuracy", "precision_macro", "recall_macro", "macro_f1")],
        "eval_samples",
    )
    routing = escalation.select(
        *[round_binary(F.col(c), 4).alias(c) for c in ("accuracy", "precision", "recall", "f1_score")],
        "eval_samples",
    )
    if judge is None:
        quality = F.struct(F.lit(fixed.JUDGE_SKIPPED).alias("status"))
    else:
        parts = [F.col(f"judge.{c}").alias(c) for c in judge.columns]
        judge_row = judge.select(F.struct(*judge.columns).alias("judge"))
        if agreement is not None:
            row = agreement.select(F.struct(*agreement.columns))
            judge_row = judge_row.withColumn("human_agreement", row.scalar())
            parts.append(F.col("human_agreement"))
        quality = judge_row.select(F.struct(*parts)).scalar()
    routing_row = routing.select(F.struct(*routing.columns))
    return scores.select(
        F.lit(dataset).alias("dataset"),
        F.struct(*scores.columns).alias("intent_classification"),
        routing_row.scalar().alias("escalation_decision"),
        quality.alias("reply_quality_judge"),
    )
