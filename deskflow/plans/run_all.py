"""The whole run: data sets, model, index, evaluation."""

from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from deskflow import fixed
from deskflow.operators.holdout import used_keys, without_used
from deskflow.plans.datasets import build_golden, build_review, build_splits, index_rows, split_of, thread_table
from deskflow.plans.evaluate import evaluate_agent, training_report
from deskflow.plans.predict import SupportAgent
from deskflow.plans.refresh import refresh_threads
from deskflow.sources.sinks import sink_metrics, sink_predictions, write
from deskflow.sources.stage import exists, scratch, stage_skip
from deskflow.sources.tables import import_csv, scan_metrics, scan_posts


def _mark(rows: DataFrame) -> str:
    """Rows and the sum of their hashes, by which a changed input is known."""
    n, total = rows.agg(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()
    return f"{n}:{total}"


def run_all(
    posts: DataFrame, folder: str, brand: str = fixed.BRAND, overwrite: bool = False, judge: bool = False,
    human_scores: DataFrame | None = None, rules: Sequence[tuple[str, str]] = fixed.INTENT_RULES, keep: Sequence[str] = (),
) -> DataFrame:
    """Write splits, golden set, model, reports, predictions and metrics under ``folder``; return the metrics document.

    The splits come first and the golden set avoids them, so that no evaluated text was trained on.  The index has
    every thread whose text is not evaluated.  Tables that are there already are reused, unless ``overwrite``
    or the posts have changed; the model is only reused with the splits it was trained on.  ``keep`` names those of
    "splits" and "golden" that stay as they are when the posts change, so that runs over growing posts are compared on
    the same rows; new splits avoid a golden set that is kept, and the index always follows the posts.  ``human_scores`` (by
    ``tweet_id``) give a review set, and its agreement with the scores when ``judge``.
    """
    return _run(posts, lambda: thread_table(posts, brand, rules), folder, overwrite, judge, human_scores, keep)


def run_all_parts(
    spark: SparkSession, path: str, folder: str, brand: str = fixed.BRAND, overwrite: bool = False, judge: bool = False,
    human_scores: DataFrame | None = None, rules: Sequence[tuple[str, str]] = fixed.INTENT_RULES, keep: Sequence[str] = (),
) -> DataFrame:
    """``run_all`` over a folder of Parquet posts that grows: only parts that are new are read (``refresh_threads``).

    What follows the thread table is built again when the thread table has changed, not when any post has come.
    """
    threads = refresh_threads(spark, path, f"{folder}/state", brand, rules)
    return _run(threads, lambda: threads, folder, overwrite, judge, human_scores, keep)


def _run(source_rows: DataFrame, build: Callable[[], DataFrame], folder: str, overwrite: bool, judge: bool,
         human_scores: DataFrame | None, keep: Sequence[str]) -> DataFrame:
    if unknown := set(keep) - {"splits", "golden"}:
        raise ValueError(f"cannot keep {sorted(unknown)}")
    spark = source_rows.sparkSession
    with scratch(spark):
        mark, source = _mark(source_rows), f"{folder}/source"
        known = exists(spark, source) and spark.read.text(source).first()[0] == mark
        stays = {name for name in keep if not overwrite and exists(spark, f"{folder}/{name}")}
        overwrite = overwrite or not known
        reused = not overwrite and exists(spark, f"{folder}/splits")
        threads = cache(build)

        def pool():
            return without_used(threads(), used_keys(scan_golden())) if "golden" in stays else threads()

        def scan_golden():
            return spark.read.parquet(f"{folder}/golden")

        splits = stage_skip(spark, f"{folder}/splits", lambda: build_splits(pool()), overwrite and "splits" not in stays)
        train, validation = split_of(splits, "train"), split_of(splits, "validation")
        golden = stage_skip(spark, f"{folder}/golden", lambda: build_golden(threads(), train, validation),
                            not reused and "golden" not in stays)
        model = f"{folder}/model"
        # The index is written last, so it stands for the whole model.
        if not (reused and exists(spark, f"{model}/index")):
            held_out = [validation, split_of(splits, "test"), golden]
            SupportAgent.fit(train, index_rows(threads(), *held_out)).save(model)
        agent = SupportAgent.load(spark, model)
        summary, by_class = training_report(agent, validation)
        write(summary.coalesce(1), f"{folder}/training", "json")
        write(by_class, f"{folder}/training_classes")
        review = None
        if human_scores is not None:
            review = stage_skip(spark, f"{folder}/review", lambda: build_review(golden, human_scores), not reused)
        predictions, document = evaluate_agent(agent, golden, f"{folder}/golden", judge, review)
        sink_predictions(predictions, f"{folder}/predictions", message_id="tweet_id")
        sink_metrics(document, f"{folder}/metrics")
        spark.createDataFrame([(mark,)], "value string").coalesce(1).write.mode("overwrite").text(source)
    return scan_metrics(spark, f"{folder}/metrics")


def run_all_csv(spark: SparkSession, path: str, folder: str, **options) -> DataFrame:
    """``run_all`` on a CSV table of posts, which is parsed once."""
    import_csv(spark, path, f"{folder}/posts")
    return run_all(scan_posts(spark, f"{folder}/posts", "parquet"), folder, **options)
