"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``queries`` are first runs.  ``warm`` are second runs of the queries that took up to WARM_BELOW seconds.  Fitting the
agent and predicting with the fitted one are timed apart.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from deskflow.operators import threads  # noqa: E402
from deskflow.plans.predict import SupportAgent  # noqa: E402
from deskflow.queries import QUERIES, fitted, posts  # noqa: E402
from deskflow.session import local_session  # noqa: E402
from deskflow.sources import stage  # noqa: E402

HEADLINE = [
    "score_distribution", "clean_text", "weak_intent", "route", "cap_words", "heuristic_judge", "thread_pairs",
    "build_threads", "build_splits", "build_golden", "stratified_split", "stratified_sample", "dedupe_text", "holdout_anti",
    "turn_pairs", "macro_prf", "confusion_matrix", "compare_models", "human_agreement", "term_stats", "topk_retrieve",
    "topk_retrieve_large", "context_block", "predict_intent", "evaluate_agent", "route_stream", "baseline_tfidf_svm",
    "compare_baselines", "run_all",
]
WARM_BELOW = 12.0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    times: dict[str, float] = {}
    warm: dict[str, float] = {}

    def timed(into: dict[str, float], name: str, work) -> None:
        start = time.perf_counter()
        work()
        into[name] = round(time.perf_counter() - start, 3)
        print(name, into[name], file=sys.stderr, flush=True)

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    # Start the JVM's code paths before the clock; the headline queries themselves run once, cold.
    spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().collect()
    start_all = time.perf_counter()
    for name in HEADLINE:
        timed(times, name, lambda: run(name))

    model = stage.new_path(spark, "bench-model")
    timed(times, "agent_fit", lambda: fitted(spark, folder)[0].save(model))
    agent = SupportAgent.load(spark, model)
    asked = threads.customer_posts(posts(spark, folder)).select("tweet_id", "text")
    timed(times, "agent_predict",
          lambda: agent.predict(asked, message_id="tweet_id").write.format("noop").mode("overwrite").save())
    total = round(time.perf_counter() - start_all, 3)
    for name in HEADLINE:
        if times[name] <= WARM_BELOW:
            timed(warm, name, lambda: run(name))
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "warm": warm,
                      "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
