"""Building the labelled data sets."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from deskflow import fixed
from deskflow.functions.columns import compute_once
from deskflow.functions.judging import human_mean
from deskflow.functions.routing import label_escalation, weak_intent
from deskflow.operators.holdout import used_keys, without_used
from deskflow.operators.sampling import cap_splits, random_rows, stratified_sample, stratified_split, topped_up_sample
from deskflow.operators.threads import thread_levels, threads_at
from deskflow.sources.stage import stage

EVALUATION_COLUMNS = ("tweet_id", "tweet", "intent", "gold_reply", "escalate", "reason")


def label_intents(threads: DataFrame, rules: Sequence[tuple[str, str]] = fixed.INTENT_RULES) -> DataFrame:
    """Adds the rule intent and drops threads no rule matches."""
    return compute_once(threads, intent=weak_intent(F.col("tweet"), rules)).filter(F.col("intent").isNotNull())


def with_truth_route(df: DataFrame) -> DataFrame:
    """Adds escalate and reason, the routing at label confidence."""
    routed = compute_once(df, _r=label_escalation(F.col("tweet"), F.col("intent")))
    return routed.withColumn("escalate", F.col("_r.decision")).withColumn("reason", F.col("_r.reason")).drop("_r")


def thread_table(posts: DataFrame, brand: str = fixed.BRAND,
                 rules: Sequence[tuple[str, str]] = fixed.INTENT_RULES) -> DataFrame:
    """Labelled threads for all data sets, built and written once: posts are cleaned, joined and grouped one time."""
    levels = thread_levels(posts, brand, (fixed.MIN_CHARS, fixed.GOLDEN_MIN_CHARS))
    return stage(label_intents(levels, rules), "threads")


def build_splits(
    threads: DataFrame, totals: Sequence[int] = fixed.SPLIT_TOTALS, seed: int = fixed.SEED,
    caps: Sequence[int] = fixed.SPLIT_CLASS_CAPS,
) -> DataFrame:
    """Train, validation and test rows of a thread table, with column ``split``; test rows carry their routing.

    The sizes are the caller's: ``caps`` rows per class and ``totals`` rows in all, for each split.  Threads beyond
    them are in no split; the index of past cases has them all (``index_rows``).
    """
    labelled = threads_at(threads, fixed.MIN_CHARS).drop("created_at")
    splits = stratified_split(labelled, caps=caps, seed=seed)
    capped = cap_splits(splits, totals=dict(zip(fixed.SPLITS, totals)), seed=seed)
    test = F.col("split") == "test"
    return with_truth_route(capped).select(
        "split", "tweet_id", "tweet", "gold_reply", "intent",
        F.when(test, F.col("escalate")).alias("escalate"), F.when(test, F.col("reason")).alias("reason"),
    )


def split_of(splits: DataFrame, name: str) -> DataFrame:
    return splits.filter(F.col("split") == name).drop("split")


def _unused(threads: DataFrame, used: Sequence[DataFrame], chars: int) -> DataFrame:
    pool = threads_at(threads, chars)
    return without_used(pool, used_keys(*used)) if used else pool


def index_rows(threads: DataFrame, *held_out: DataFrame) -> DataFrame:
    """All threads that can be past cases: those whose text is in none of the held-out frames."""
    return _unused(threads, held_out, fixed.MIN_CHARS).select("tweet_id", "tweet", "gold_reply", "intent")


def build_golden(
    threads: DataFrame,
    *used: DataFrame,
    per_class: int = fixed.GOLDEN_PER_CLASS,
    total: int = fixed.GOLDEN_TOTAL,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Balanced holdout sample of the longer threads of a thread table, none of them in the ``used`` frames."""
    sample = topped_up_sample(_unused(threads, used, fixed.GOLDEN_MIN_CHARS), per_class, total, seed=seed)
    return with_truth_route(sample).select(*EVALUATION_COLUMNS)


def build_fresh_test(
    threads: DataFrame, *used: DataFrame, total: int = fixed.FRESH_TOTAL, seed: int = fixed.SEED,
    classes: int = len(fixed.INTENTS),
) -> DataFrame:
    """Second balanced test sample of a thread table, none of it in the ``used`` frames."""
    per_class = total // classes + 5
    sample = stratified_sample(_unused(threads, used, fixed.MIN_CHARS), per_class, total, seed=seed)
    return with_truth_route(sample).select(*EVALUATION_COLUMNS)


def review_mean(df: DataFrame) -> DataFrame:
    """Adds the mean of the four human scores."""
    scores = [F.col(f"human_{n}") for n in fixed.RUBRIC]
    return df.withColumn("human_average_score", human_mean(*scores))


def build_review(
    golden: DataFrame, human_scores: DataFrame, rows: int = fixed.REVIEW_TOTAL, seed: int = fixed.SEED
) -> DataFrame:
    """Random golden rows with the scores people gave them (by ``tweet_id``) and their mean."""
    return review_mean(random_rows(golden, rows, seed=f"{seed}:review").join(human_scores, "tweet_id"))
