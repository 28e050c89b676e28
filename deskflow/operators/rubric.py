"""Summaries of rubric scores and agreement with people."""

from pyspark.sql import Column, DataFrame, functions as F

from deskflow import fixed
from deskflow.functions.judging import heuristic_scores
from deskflow.functions.text import round_binary


def score_replies(df: DataFrame, reply: str = "generated_reply") -> DataFrame:
    """Adds the four scores, their mean and the explanation."""
    scored = df.withColumn("_s", heuristic_scores(F.col(reply)))
    return scored.select(*df.columns, "_s.*")


def judge_summary(scored: DataFrame) -> DataFrame:
    """Means of the four scores and of the row means, rounded to 2, and the number of rows."""
    means = [round_binary(F.avg(n), 2).alias(f"mean_{n}") for n in fixed.RUBRIC]
    return scored.agg(
        *means, round_binary(F.avg("average_score"), 2).alias("mean_composite_score"),
        F.count("*").alias("total_evaluated"),
    )


def human_agreement(df: DataFrame, human: str, judge: str, degenerate_corr: float | None = None) -> DataFrame:
    """Pearson r, mean absolute error and share within one point of two score columns, unrounded.

    A constant side has no correlation; ``degenerate_corr`` is given for it.
    """
    h, j = F.col(human).cast("double"), F.col(judge).cast("double")
    gap = F.abs(h - j)
    constant = (F.min(h) == F.max(h)) | (F.min(j) == F.max(j))
    # ``corr`` itself fails on a constant side when ANSI mode is on.
    pearson = F.try_divide(F.covar_pop(h, j), F.stddev_pop(h) * F.stddev_pop(j))
    return df.agg(
        F.count("*").alias("sample_size"),
        F.when(constant, F.lit(degenerate_corr).cast("double")).otherwise(pearson).alias("pearson_correlation"),
        F.avg(gap).alias("mean_absolute_error"),
        (F.avg((gap <= 1).cast("double")) * 100.0).alias("agreement_within_1_point_pct"),
        F.avg(h).alias("human_mean_score"),
        F.avg(j).alias("judge_mean_score"),
    )


def rounded_agreement(agreement: DataFrame) -> DataFrame:
    """Agreement as shown in the metrics document."""
    digits = {"pearson_correlation": 3, "mean_absolute_error": 3, "agreement_within_1_point_pct": 1,
              "human_mean_score": 2, "judge_mean_score": 2}

    def shown(name: str) -> Column:
        return round_binary(F.col(name), digits[name]).alias(name) if name in digits else F.col(name)

    return agreement.select(*[shown(c) for c in agreement.columns])
