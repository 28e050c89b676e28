"""One query per operator over the test tables: name -> f(spark, folder)."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from deskflow import fixed, schemas
from deskflow.functions import judging, replies, routing, text as tx, vectors as vec
from deskflow.functions.columns import compute_once
from deskflow.operators import holdout, metrics, models, retrieval, rubric, sampling, terms, threads
from deskflow.plans import datasets, evaluate, predict, refresh, run_all
from deskflow.sources import buckets, derived, sinks, stage, tables
from deskflow.sources.derived import BRAND
from deskflow.streaming.routing import route_messages, route_stream
from deskflow.streaming.threads import count_stream, latest_counts, thread_pairs_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def posts(spark: SparkSession, sf: str) -> DataFrame:
    return derived.view(spark, sf, derived.POSTS, spread_rows=True)


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return derived.view(spark, sf, derived.TEXTS, spread_rows=True)


def judged(spark: SparkSession, sf: str) -> DataFrame:
    return derived.view(spark, sf, derived.JUDGED)


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customer posts with cleaned text, rule intent and a confidence off rounding ties."""
    asked = threads.customer_posts(posts(spark, sf)).select("tweet_id", "text")
    cleaned = compute_once(asked, tweet=tx.clean_text(F.col("text")))
    return compute_once(cleaned, intent=routing.weak_intent(F.col("tweet"))).withColumn(
        "confidence", (F.col("tweet_id").cast("long") % 97) / F.lit(97.0))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on their order in the last bits: compare 9 decimals."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


# ---- sources and sinks ----------------------------------------------------------------------------------

@query
def scan_posts(spark, sf):
    path = stage.new_path(spark, "posts")
    raw = posts(spark, sf).withColumn("created_at", F.substring(F.col("created_at").cast("string"), 1, 19))
    sinks.write(raw.withColumn("extra", F.lit("not read")), path, "csv")
    return tables.scan_posts(spark, path)


@query
def scan_labelled(spark, sf):
    path = stage.new_path(spark, "labelled")
    sinks.write(thread_rows(spark, sf).select("tweet_id", "intent", "tweet", "gold_reply"), path, "csv")
    return tables.scan_labelled(spark, path, "csv")


@query
def scan_evaluation(spark, sf):
    path = stage.new_path(spark, "evaluation")
    rows = datasets.with_truth_route(thread_rows(spark, sf))
    sinks.write(rows.select("reason", "tweet", "gold_reply", "tweet_id", "intent", "escalate"), path, "csv")
    return tables.scan_evaluation(spark, path, "csv")


@query
def scan_human_review(spark, sf):
    path = stage.new_path(spark, "review")
    rows = datasets.review_mean(derived.view(spark, sf, derived.HUMAN))
    rows = rows.select(
        F.col("text").alias("tweet"), F.lit("app_store").alias("intent"), F.col("text").alias("gold_reply"),
        F.lit("AUTO").alias("escalate"), F.lit("none").alias("reason"),
        *[f"human_{n}" for n in fixed.RUBRIC], "human_average_score", "doc_id")
    sinks.write(rows.select(*reversed(rows.columns)), path, "csv")
    return tables.scan_human_review(spark, path)


@query
def scan_messages(spark, sf):
    docs = derived.table(spark, sf, "documents").withColumnRenamed("text", "customer_message")
    return tables.scan_messages(docs).select("doc_id", "text")


@query
def sink_predictions(spark, sf):
    path = stage.new_path(spark, "predictions")
    sinks.sink_predictions(rule_predictions(spark, sf), path, "csv", "tweet_id")
    return tables.read(spark, path, T.StructType([T.StructField("tweet_id", T.StringType()), *schemas.PREDICTIONS.fields]), "csv")


@query
def predict_file(spark, sf):
    """Messages of a Parquet table without ids, named by file and row; their texts in, their texts and ids out."""
    agent, _ = fitted(spark, sf)
    source, path = stage.new_path(spark, "messages"), stage.new_path(spark, "predictions")
    asked = threads.customer_posts(posts(spark, sf)).select(F.col("text").alias("query"), "author_id")
    asked.write.parquet(source)
    predict.predict_file(agent, source, path)
    saved = spark.read.parquet(path)
    return saved.groupBy("tweet").agg(F.count("*").alias("n"), F.countDistinct("message_id").alias("n_ids"))


@query
def sink_splits(spark, sf):
    path = stage.new_path(spark, "splits")
    sinks.sink_splits(datasets.build_splits(thread_table(spark, sf)), path)
    return spark.read.parquet(path).select("split", "tweet_id", "tweet", "gold_reply", "intent")


@query
def sink_metrics(spark, sf):
    path = stage.new_path(spark, "metrics")
    sinks.sink_metrics(document(spark, sf), path)
    saved = spark.read.json(path)
    return saved.select("dataset", "intent_classification.accuracy", "escalation_decision.f1_score")


@query
def scan_metrics(spark, sf):
    path = stage.new_path(spark, "metrics")
    sinks.sink_metrics(document(spark, sf), path)
    return flat_document(tables.scan_metrics(spark, path))


@query
def sink_vector_table(spark, sf):
    path = stage.new_path(spark, "vectors")
    sinks.sink_vector_table(derived.view(spark, sf, derived.INDEX), path)
    saved = tables.read(spark, path, schemas.VECTOR_TABLE)
    return saved.select("id", "tweet", "apple_reply", "intent", F.size("embedding").alias("width"))


@query
def model_save_load(spark, sf):
    path = stage.new_path(spark, "model")
    rows = vector_rows(spark, sf)
    fitted_here = models.IntentClassifier.fit(rows)
    fitted_here.save(path)
    loaded = models.IntentClassifier.load(spark, path)
    once, again = (m.predict(rows.drop("intent")).select("vec_id", F.struct("intent", "confidence").alias(name))
                   for m, name in ((fitted_here, "once"), (loaded, "again")))
    return once.join(again, "vec_id").select("vec_id", (F.col("once") == F.col("again")).alias("same"))


@query
def stage_skip(spark, sf):
    path = stage.new_path(spark, "counts")
    counts = metrics.label_counts(customers(spark, sf).filter("intent is not null"))
    stage.stage_skip(spark, path, lambda: counts)
    # The second call must read the table: its own computation would give no rows.
    return stage.stage_skip(spark, path, lambda: counts.filter("false"))


# ---- projections and filters ----------------------------------------------------------------------------

@query
def parse_inbound(spark, sf):
    return posts(spark, sf).select("tweet_id", tx.parse_flag(F.col("inbound")).alias("inbound"))


@query
def brand_replies(spark, sf):
    return threads.brand_posts(posts(spark, sf), BRAND).select("tweet_id", "text", "in_response_to_tweet_id")


@query
def drop_nulls(spark, sf):
    answered = threads.drop_nulls(posts(spark, sf), ["tweet_id", "text", "in_response_to_tweet_id"])
    return answered.select("tweet_id", "in_response_to_tweet_id")


@query
def min_length(spark, sf):
    return threads.long_enough(texts(spark, sf), ["text"]).select("text_id", F.length("text").alias("n_chars"))


@query
def mostly_ascii(spark, sf):
    return texts(spark, sf).select("text_id", tx.mostly_ascii(F.col("text")).alias("ascii"))


@query
def inbound_only(spark, sf):
    return threads.customer_posts(posts(spark, sf)).select("tweet_id", "author_id")


def thread_rows(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.label_intents(threads.build_threads(posts(spark, sf), BRAND))


def thread_table(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.thread_table(posts(spark, sf), BRAND)


@query
def project_thread(spark, sf):
    return thread_rows(spark, sf).select("tweet", "gold_reply", "intent")


@query
def default_column(spark, sf):
    df = derived.table(spark, sf, "conversations").select("conv_id", "turn", "role")
    for name, value in (("role", "nobody"), ("escalate", "AUTO"), ("gold_reply", ""), ("intent", "general_inquiry")):
        df = tables.default_column(df, name, value)
    return df


@query
def sanitize_text(spark, sf):
    padded = F.concat(F.lit(" \u00a0\t"), F.col("text"), F.lit(" \n\u2003"))
    return texts(spark, sf).select(
        "text_id", tx.strip(padded).alias("query"), tx.embed_input(F.left(padded, F.lit(4))).alias("encoded"))


@query
def escalated_flag(spark, sf):
    return judged(spark, sf).select("event_id", routing.is_escalated(F.col("route")).alias("escalated"))


# ---- joins ----------------------------------------------------------------------------------------------

@query
def thread_pairs(spark, sf):
    return threads.thread_pairs(posts(spark, sf), BRAND).select("tweet_id", "text", "gold_reply")


@query
def turn_pairs(spark, sf):
    return threads.turn_pairs(derived.table(spark, sf, "conversations"))


def poor_or_benchmark(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All documents, and the frame of texts that are not to be used again."""
    docs = derived.table(spark, sf, "documents").select("doc_id", "text")
    poor = docs.join(derived.table(spark, sf, "labels").filter("quality = 0"), "doc_id")
    return docs, derived.table(spark, sf, "benchmark").select("text").unionByName(poor.select("text"))


@query
def holdout_anti(spark, sf):
    docs, used = poor_or_benchmark(spark, sf)
    return holdout.without_used(docs, holdout.used_texts(used, column="text"), "text").select("doc_id")


@query
def holdout_anti_filtered(spark, sf):
    """The plan for sets beyond a broadcast: a filter of the used texts where the pool is read."""
    docs = derived.table(spark, sf, "documents").select("doc_id", "text")
    # Labels are joined to digests, so no text is shuffled.
    keyed = compute_once(docs.filter("text IS NOT NULL"), _key=tx.text_key(F.col("text"))).select("doc_id", "_key")
    poor = keyed.join(derived.table(spark, sf, "labels").filter("quality = 0"), "doc_id").select("_key")
    used = holdout.used_keys(derived.table(spark, sf, "benchmark"), column="text").unionByName(poor)
    return holdout.without_used_filtered(docs, used, "text").select("doc_id")


@query
def topup_anti(spark, sf):
    rows = customers(spark, sf).filter("intent is not null")
    sampled = sampling.first_per_class(rows, fixed.GOLDEN_PER_CLASS)
    return rows.join(sampled.select("tweet_id"), "tweet_id", "left_anti").select("tweet_id", "intent")


@query
def topk_retrieve(spark, sf):
    e = derived.table(spark, sf, "embeddings")
    return retrieval.topk_retrieve(e, e, query_id="vec_id", index_id="vec_id")


@query
def topk_retrieve_large(spark, sf):
    """The plan for an index of any size."""
    e = derived.table(spark, sf, "embeddings")
    return retrieval.topk_large(
        e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q_vector")),
        e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("i_vector")),
        fixed.TOP_K)


@query
def topk_retrieve_lsh(spark, sf):
    """Approximate search over cells: every fiftieth vector asks, all rows are in the index."""
    e = derived.table(spark, sf, "embeddings")
    return retrieval.topk_cells(
        e.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q_vector")),
        e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("i_vector")), fixed.TOP_K)


@query
def attach_metadata(spark, sf):
    index = derived.view(spark, sf, derived.INDEX)
    hits = retrieval.topk_retrieve(derived.table(spark, sf, "embeddings"), index, query_id="vec_id")
    return retrieval.attach_metadata(hits, index)


@query
def attach_metadata_buckets(spark, sf):
    """The texts come from a persisted table in buckets of ids, of which nothing is shuffled."""
    index, path = derived.view(spark, sf, derived.INDEX), stage.new_path(spark, "vectors")
    buckets.sink_vector_buckets(index, path, buckets=16)
    hits = retrieval.topk_retrieve(derived.table(spark, sf, "embeddings"), index, query_id="vec_id")
    return retrieval.attach_metadata(hits, buckets.scan_buckets(spark, path))


@query
def attach_truth(spark, sf):
    rows = rule_predictions(spark, sf)
    # Every third label was corrected by a person.
    corrected = F.when(F.col("tweet_id").cast("long") % 3 == 0, "general_inquiry").otherwise(F.col("intent"))
    truth = thread_rows(spark, sf).select("tweet_id", corrected.alias("intent"))
    return evaluate.attach_truth(rows, truth).select(
        "tweet_id", "intent", "ground_truth_intent", "ground_truth_escalate", "gold_reply")


@query
def label_decode(spark, sf):
    rows = customers(spark, sf).filter("intent is not null").select("tweet_id", "intent")
    coded = models.encode_labels(rows, fixed.INTENTS)
    return models.decode_labels(coded, fixed.INTENTS).select("tweet_id", "label_index", "decoded")


# ---- aggregations ---------------------------------------------------------------------------------------

@query
def intent_counts(spark, sf):
    return metrics.label_counts(customers(spark, sf).filter("intent is not null"))


@query
def majority_class(spark, sf):
    return metrics.majority_class(customers(spark, sf))


@query
def accuracy(spark, sf):
    return rounded(metrics.accuracy(judged(spark, sf), "truth", "predicted"), "accuracy")


@query
def macro_prf(spark, sf):
    scores = metrics.macro_prf(judged(spark, sf), "truth", "predicted")
    return rounded(scores, "precision_macro", "recall_macro", "macro_f1")


@query
def binary_prf(spark, sf):
    return metrics.escalation_scores(judged(spark, sf), "truth_route", "route")


@query
def class_report(spark, sf):
    return rounded(metrics.class_report(judged(spark, sf), "truth", "predicted"), "precision", "recall", "f1")


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(judged(spark, sf), "truth", "predicted")


def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    return rubric.score_replies(datasets.review_mean(derived.view(spark, sf, derived.HUMAN)), "text")


@query
def judge_summary(spark, sf):
    return rubric.judge_summary(scored_documents(spark, sf))


@query
def human_agreement(spark, sf):
    found = rubric.human_agreement(scored_documents(spark, sf), "human_average_score", "average_score")
    return rounded(found, *[c for c in found.columns if c != "sample_size"])


@query
def baseline_majority(spark, sf):
    splits = stage.stage(datasets.build_splits(thread_table(spark, sf)), "splits")
    return rounded(metrics.majority_baseline(datasets.split_of(splits, "train"), datasets.split_of(splits, "test")),
                   "intent_macro_f1")


@query
def class_weights(spark, sf):
    return rounded(models.class_weights(customers(spark, sf).filter("intent is not null")), "weight")


@query
def term_stats(spark, sf):
    return terms.term_stats(tables.spread(derived.table(spark, sf, "documents")), "text")


@query
def term_stats_large(spark, sf):
    """The plan for any number of distinct terms."""
    return terms.term_stats_large(tables.spread(derived.table(spark, sf, "documents")), "text")


@query
def compare_models(spark, sf):
    rows = judged(spark, sf)
    named = [
        rows.withColumn("model", F.lit("by_value")),
        rows.withColumn("model", F.lit("always_view")).withColumn("predicted", F.lit("view")).withColumn(
            "route", F.lit("AUTO")),
        rows.withColumn("model", F.lit("perfect")).withColumn("predicted", F.col("truth")).withColumn(
            "route", F.col("truth_route")),
    ]
    return rounded(metrics.compare_models(named[0].unionByName(named[1]).unionByName(named[2])), "intent_macro_f1")


@query
def human_mean(spark, sf):
    return datasets.review_mean(derived.view(spark, sf, derived.HUMAN)).select("doc_id", "human_average_score")


@query
def split_overlap(spark, sf):
    docs = derived.table(spark, sf, "documents")
    labelled = docs.join(derived.table(spark, sf, "labels"), "doc_id")
    return holdout.split_overlap({
        "documents": docs, "good": labelled.filter("quality = 1"), "poor": labelled.filter("quality = 0"),
        "benchmark": derived.table(spark, sf, "benchmark"),
    }, "text", large="documents")


def document(spark: SparkSession, sf: str) -> DataFrame:
    rows = judged(spark, sf)
    scored = scored_documents(spark, sf)
    return metrics.metrics_document(
        "events",
        metrics.intent_scores(rows, "truth", "predicted"),
        metrics.escalation_scores(rows, "truth_route", "route"),
        rubric.judge_summary(scored),
        rubric.rounded_agreement(rubric.human_agreement(scored, "human_average_score", "average_score")),
    )


def flat_document(df: DataFrame) -> DataFrame:
    return df.select(
        "dataset", "intent_classification.accuracy", "intent_classification.precision_macro",
        "intent_classification.recall_macro", "intent_classification.macro_f1", "intent_classification.eval_samples",
        F.col("escalation_decision.accuracy").alias("escalation_accuracy"), "escalation_decision.precision",
        "escalation_decision.recall", "escalation_decision.f1_score", "reply_quality_judge.mean_correctness",
        "reply_quality_judge.mean_composite_score", "reply_quality_judge.total_evaluated",
        "reply_quality_judge.human_agreement.sample_size", "reply_quality_judge.human_agreement.mean_absolute_error",
    )


@query
def metrics_document(spark, sf):
    return flat_document(document(spark, sf))


@query
def score_distribution(spark, sf):
    """Posts by intent and decision: clean, label, route, count."""
    routed = route_messages(customers(spark, sf).drop("tweet", "intent"), confidence="confidence")
    return metrics.score_distribution(routed.withColumn("intent", F.coalesce("intent", F.lit("none"))),
                                      "intent", "decision")


# ---- de-duplication, samples, top-k ---------------------------------------------------------------------

@query
def dedupe_reply_target(spark, sf):
    return threads.first_replies(posts(spark, sf), BRAND)


@query
def dedupe_text(spark, sf):
    docs = derived.table(spark, sf, "documents").select("text", "doc_id", "lang", "source")
    return threads.dedupe_text(docs, "text", ["doc_id"], keep_text=False)


@query
def stratified_split(spark, sf):
    docs = derived.table(spark, sf, "documents").select("doc_id", "lang")
    return sampling.stratified_split(docs, "doc_id", "lang")


@query
def cap_split(spark, sf):
    docs = derived.table(spark, sf, "documents").select("doc_id", "lang")
    return sampling.cap_splits(
        sampling.stratified_split(docs, "doc_id", "lang"), "doc_id", {"train": 300, "validation": 90, "test": 80})


@query
def stratified_sample(spark, sf):
    rows = customers(spark, sf).select("tweet_id", "intent")
    return sampling.stratified_sample(rows, fixed.FRESH_TOTAL // len(fixed.INTENTS) + 5, fixed.FRESH_TOTAL)


@query
def topup_sample(spark, sf):
    rows = customers(spark, sf).select("tweet_id", "intent")
    return sampling.topped_up_sample(rows, 20, fixed.GOLDEN_TOTAL)


@query
def review_sample(spark, sf):
    return sampling.random_rows(customers(spark, sf).select("tweet_id", "tweet"), fixed.REVIEW_TOTAL)


@query
def topk_per_query(spark, sf):
    """The k best rows per group by a score, the ranking step on its own: dearest orders per customer."""
    orders = derived.table(spark, sf, "orders")
    rank = F.row_number().over(W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return orders.select("o_custkey", "o_orderkey", "o_totalprice", rank.alias("rank")).filter(
        F.col("rank") <= fixed.TOP_K)


@query
def argmax_class(spark, sf):
    rows = derived.table(spark, sf, "embeddings").select("vec_id", "embedding")
    names = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.concat(F.lit("class_"), i.cast("string")))
    best = models.best_class(rows, "embedding", names)
    return best.select("vec_id", "intent", F.round(F.col("confidence").cast("double"), 6).alias("confidence"))


@query
def sorted_labels(spark, sf):
    return metrics.sorted_labels(judged(spark, sf), "truth", "predicted")


@query
def preview(spark, sf):
    return predict.preview(derived.table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")


# ---- set operations -------------------------------------------------------------------------------------

@query
def concat_groups(spark, sf):
    rows = judged(spark, sf).select("event_id", F.nullif("truth", F.lit("error")).alias("truth"))
    return sampling.concat_groups(
        rows.filter("truth = 'view'"), rows.filter("truth <> 'view'").withColumn("other", F.lit(True)),
        rows.filter("truth IS NULL").drop("truth"))


@query
def used_texts(spark, sf):
    return holdout.used_texts(
        derived.table(spark, sf, "documents"), derived.table(spark, sf, "benchmark"),
        derived.table(spark, sf, "conversations"), column="text")


@query
def label_union(spark, sf):
    return metrics.label_union(judged(spark, sf), "truth", "predicted")


# ---- text -----------------------------------------------------------------------------------------------

@query
def clean_text(spark, sf):
    return texts(spark, sf).select("text_id", tx.clean_text(F.col("text")).alias("cleaned"))


@query
def weak_intent(spark, sf):
    return texts(spark, sf).select("text_id", routing.weak_intent(tx.clean_text(F.col("text"))).alias("intent"))


@query
def match_keyword(spark, sf):
    return texts(spark, sf).select("text_id", routing.match_keyword(F.col("text")).alias("keyword"))


@query
def keyword_contains(spark, sf):
    rows = customers(spark, sf)
    return rows.select("tweet_id", routing.baseline_route(F.col("tweet"), F.col("intent")).alias("decision"))


@query
def readable_intent(spark, sf):
    return customers(spark, sf).select("tweet_id", routing.readable(F.col("intent")).alias("intent"))


@query
def word_count(spark, sf):
    return texts(spark, sf).select("text_id", tx.word_count(F.col("text")).alias("n_words"))


@query
def cap_words(spark, sf):
    return texts(spark, sf).select("text_id", replies.cap_words(F.col("text")).alias("capped"))


def with_context(spark: SparkSession, sf: str) -> DataFrame:
    index = derived.view(spark, sf, derived.INDEX)
    found = retrieval.retrieve_context(index.select("id", "embedding", "tweet", "intent"), index)
    return found.drop("embedding")


@query
def context_block(spark, sf):
    return with_context(spark, sf).select("id", replies.context_block(F.col("retrieved_context")).alias("context"))


@query
def prompt_examples(spark, sf):
    return with_context(spark, sf).select("id", replies.prompt_examples(F.col("retrieved_context")).alias("examples"))


@query
def build_prompts(spark, sf):
    context = replies.prompt_examples(F.col("retrieved_context"))
    draft = replies.draft_reply(F.col("retrieved_context"))
    return with_context(spark, sf).select(
        "id", replies.reply_prompt(F.col("tweet"), F.col("intent"), context).alias("reply_prompt"),
        replies.judge_prompt(F.col("tweet"), F.col("intent"), F.lit("none"), draft).alias("judge_prompt"))


@query
def parse_judge_json(spark, sf):
    rows = derived.view(spark, sf, derived.ANSWERS)
    scored = rows.withColumn("_s", judging.parse_judge_answer(F.col("answer"), F.col("generated_reply")))
    return scored.select("event_id", *[f"_s.{n}" for n in fixed.RUBRIC], "_s.average_score", "_s.explanation")


# ---- numbers and vectors --------------------------------------------------------------------------------

def _long_vector() -> Column:
    return F.transform("embedding", lambda x: x * (F.col("label") + 1))


@query
def l2_normalize(spark, sf):
    unit = derived.table(spark, sf, "embeddings").select("vec_id", vec.l2_normalize(_long_vector()).alias("unit"))
    return unit.select("vec_id", F.posexplode("unit").alias("pos", "x")).select("vec_id", "pos", F.round("x", 6).alias("x"))


@query
def cosine(spark, sf):
    e = derived.table(spark, sf, "embeddings")
    following = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    similarity = vec.cosine(_long_vector(), F.col("other"))
    return e.join(following, "vec_id").select("vec_id", F.round(similarity, 6).alias("similarity"))


def vector_rows(spark: SparkSession, sf: str) -> DataFrame:
    return derived.table(spark, sf, "embeddings").select(
        "vec_id", "embedding", F.concat(F.lit("class_"), F.col("label").cast("string")).alias("intent"))


def recomputed(spark: SparkSession, sf: str) -> tuple[DataFrame, Column]:
    """Predictions with ``own``, the class probabilities worked out from coefficients and vector by plain expressions, and
    the class names in that order."""
    rows = vector_rows(spark, sf)
    classifier = models.IntentClassifier.fit(rows)
    weights, start = classifier.model.coefficientMatrix.toArray(), classifier.model.interceptVector.toArray()
    scores = F.array(*[F.lit(float(b)) + F.aggregate(
        F.zip_with("embedding", F.array(*[F.lit(float(x)) for x in w]), lambda a, x: a * x), F.lit(0.0), lambda a, x: a + x)
        for w, b in zip(weights, start)])
    scored = compute_once(classifier.predict(rows.drop("intent")), _scores=scores)
    powers = F.transform("_scores", lambda s: F.exp(s - F.array_max("_scores")))
    scored = compute_once(scored, _powers=powers)
    total = F.aggregate("_powers", F.lit(0.0), lambda a, x: a + x)
    return scored.withColumn("own", F.transform("_powers", lambda x: x / total)), F.array(
        *[F.lit(n) for n in classifier.labels.labels])


@query
def prob_map(spark, sf):
    """Every probability, against the same worked out from the coefficients."""
    scored, names = recomputed(spark, sf)
    gap = F.array_max(F.transform(F.arrays_zip(names.alias("name"), F.col("own").alias("p")), lambda x: F.abs(
        x["p"] - F.col("class_probabilities")[x["name"]])))
    return scored.select("vec_id", F.size("class_probabilities").alias("classes"), (gap < 1e-9).alias("agrees"))


@query
def confidence(spark, sf):
    scored, _ = recomputed(spark, sf)
    return scored.select("vec_id", (F.abs(F.col("confidence") - F.array_max("own")) < 1e-9).alias("agrees"))


@query
def row_share(spark, sf):
    return metrics.confusion_matrix(judged(spark, sf), "truth_route", "route").select("truth", "predicted", "share")


@query
def abs_error(spark, sf):
    gap = F.abs(F.col("human_average_score") - F.col("average_score"))
    return scored_documents(spark, sf).select("doc_id", gap.alias("gap"), (gap <= 1).alias("within_one"))


@query
def normalize_check(spark, sf):
    return retrieval.vector_audit(derived.table(spark, sf, "embeddings"))


# ---- decisions and scores -------------------------------------------------------------------------------

@query
def route(spark, sf):
    routed = customers(spark, sf).withColumn(
        "_r", routing.route(F.col("tweet"), F.col("intent"), F.col("confidence")))
    return routed.select("tweet_id", "_r.decision", "_r.reason")


@query
def label_escalation(spark, sf):
    labelled = datasets.with_truth_route(customers(spark, sf).filter("intent is not null"))
    return labelled.select("tweet_id", "escalate", "reason")


@query
def draft_reply(spark, sf):
    return with_context(spark, sf).select("id", replies.draft_reply(F.col("retrieved_context"), 4).alias("reply"))


@query
def heuristic_judge(spark, sf):
    scored = rubric.score_replies(texts(spark, sf), "text")
    return scored.select("text_id", *fixed.RUBRIC, "average_score")


def rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Contract columns from the rules, for the joins and sinks of predictions."""
    rows = datasets.with_truth_route(thread_rows(spark, sf))
    return rows.select(
        "tweet_id", "tweet", "intent", F.lit(fixed.LABEL_CONFIDENCE).alias("confidence"),
        replies.cap_words(F.col("gold_reply"), 6).alias("generated_reply"), F.col("escalate").alias("decision"), "reason")


# ---- models ---------------------------------------------------------------------------------------------

def fitted(spark: SparkSession, sf: str) -> tuple[predict.SupportAgent, DataFrame]:
    """Agent fitted on the training split, with every thread that is not held out as a past case, and the splits."""
    table = thread_table(spark, sf)
    splits = stage.stage(datasets.build_splits(table), "splits")
    past = datasets.index_rows(table, splits.filter("split <> 'train'"))
    return predict.SupportAgent.fit(datasets.split_of(splits, "train"), past), splits


@query
def embed(spark, sf):
    docs = derived.table(spark, sf, "documents").select("doc_id", "text")
    encoded = models.TextEncoder.fit(docs, "text").encode(docs, "text")
    # A word fills one bucket, which it may share; so no more buckets are filled than there are words.
    filled = F.size(F.filter("embedding", lambda x: x != 0))
    n_words = F.size(F.array_distinct(tx.tokens(F.col("text"))))
    return encoded.select("doc_id", F.size("embedding").alias("width"), F.round(vec.norm(F.col("embedding")), 4).alias("norm"),
                          n_words.alias("n_words"), ((filled <= n_words) & ((filled > 0) == (n_words > 0))).alias("filled"))


@query
def train_intent(spark, sf):
    """Training rows and classes, whether the fit is at its optimum, and the rows and class rows of the report."""
    agent, splits = fitted(spark, sf)
    train, validation = datasets.split_of(splits, "train"), datasets.split_of(splits, "validation")
    summary, by_class = evaluate.training_report(agent, validation)
    slope = agent.classifier.slope(agent.encoder.encode(train.select("tweet", "intent")))
    return train.agg(F.count("*").alias("n_train"), F.countDistinct("intent").alias("n_classes")).select(
        "*", F.lit(slope < 2e-2).alias("optimal"), summary.select("eval_samples").scalar().alias("n_validation"),
        by_class.filter("label NOT IN ('accuracy', 'macro avg', 'weighted avg')").agg(F.sum("support")).scalar().alias(
            "n_reported"))


@query
def predict_intent(spark, sf):
    rows = vector_rows(spark, sf)
    scored, names = recomputed(spark, sf)
    best = F.get(names, F.array_position("own", F.array_max("own")).cast("int") - 1)
    return scored.select("vec_id", (F.col("intent") == best).alias("agrees"))


@query
def baseline_tfidf_svm(spark, sf):
    splits = stage.stage(datasets.build_splits(thread_table(spark, sf)), "splits")
    train, test = datasets.split_of(splits, "train"), datasets.split_of(splits, "test")
    model = models.SvmBaseline.fit(train)
    rows = model.predict(test.select("tweet_id", "tweet", F.col("intent").alias("truth")), output="predicted")
    # On the rows it was fitted on, the rule labels are learned almost without fault.
    learned = model.predict(train.select("tweet", F.col("intent").alias("truth")), output="predicted").agg(
        F.avg((F.col("truth") == F.col("predicted")).cast("double"))).scalar()
    return rows.select("tweet_id", "truth", F.col("predicted").isin(fixed.INTENTS).alias("known"),
                       F.lit(round(model.model.slope, 6)).alias("slope"), (learned > 0.95).alias("learned"))


@query
def baseline_majority_fit(spark, sf):
    splits = stage.stage(datasets.build_splits(thread_table(spark, sf)), "splits")
    rows = metrics.majority_predictions(datasets.split_of(splits, "train"), datasets.split_of(splits, "test"))
    return metrics.score_distribution(rows, "truth", "predicted", "truth_route", "route")


@query
def fit_index(spark, sf):
    """Every thread whose text is not held out, however many the training split has."""
    table = thread_table(spark, sf)
    splits = stage.stage(datasets.build_splits(table), "splits")
    past = datasets.index_rows(table, splits.filter("split <> 'train'"))
    index = predict.vector_table(models.TextEncoder.fit(datasets.split_of(splits, "train")), past)
    return index.select("id", "tweet", "apple_reply", "intent", F.size("embedding").alias("width"))


@query
def batch_predict(spark, sf):
    """Facts of every prediction: decision and reason follow from what is shown, five neighbours, a short reply of one."""
    return facts(batch_predictions(spark, sf))


def batch_predictions(spark: SparkSession, sf: str) -> DataFrame:
    agent, _ = fitted(spark, sf)
    asked = threads.customer_posts(posts(spark, sf)).select("tweet_id", "text")
    return agent.predict(asked, message_id="tweet_id")


def facts(predictions: DataFrame) -> DataFrame:
    shown = compute_once(predictions, _r=routing.route(F.col("tweet"), F.col("intent"), F.col("confidence")))
    # Shown confidences have four decimals: at a bound, or at half a hundredth, routing may have seen the other side.
    near = F.lit(False)
    for bound in (fixed.ESCALATE_CONFIDENCE, fixed.AUTO_CONFIDENCE):
        near = near | (F.abs(F.col("confidence") - bound) < 1e-4)
    cents = F.abs(F.col("confidence") * 100 - F.floor(F.col("confidence") * 100) - 0.5) < 0.02
    routed = (F.col("decision") == F.col("_r.decision")) & ((F.col("reason") == F.col("_r.reason")) | cents)
    best = F.get("retrieved_context", F.lit(0))["apple_reply"]
    return shown.select(
        "tweet_id", (near | routed).alias("routed"), F.size("retrieved_context").alias("neighbours"),
        (tx.word_count(F.col("generated_reply")) <= fixed.MAX_REPLY_WORDS).alias("short"),
        (F.col("generated_reply") == replies.cap_words(best, fixed.MAX_REPLY_WORDS)).alias("grounded"))


def scores_agree(predictions: DataFrame, found: DataFrame) -> DataFrame:
    """Whether a metrics document has the accuracies that staged predictions give when counted plainly."""
    plain = predictions.agg(
        F.count("*").alias("n"), F.avg((F.col("intent") == F.col("ground_truth_intent")).cast("double")).alias("a"),
        F.avg((F.col("decision") == F.col("ground_truth_escalate")).cast("double")).alias("b"))
    shown = found.select("intent_classification.eval_samples", F.col("intent_classification.accuracy").alias("ia"),
                         F.col("escalation_decision.accuracy").alias("ea"))
    one = plain.select(F.struct("*").alias("p")).scalar()
    return shown.select("eval_samples", (F.col("eval_samples") == one["n"]).alias("all_rows"),
                        (F.abs(F.col("ia") - one["a"]) < 1e-4).alias("intents_agree"),
                        (F.abs(F.col("ea") - one["b"]) < 1e-4).alias("routes_agree"))


@query
def evaluate_agent(spark, sf):
    agent, splits = fitted(spark, sf)
    return scores_agree(*evaluate.evaluate_agent(agent, datasets.split_of(splits, "test"), "test", judge=True))


@query
def evaluate_model(spark, sf):
    """One comparison row from predictions, against accuracy and recall counted plainly."""
    agent, splits = fitted(spark, sf)
    rows = stage.stage(evaluate.agent_predictions(agent, datasets.split_of(splits, "test")), "model-rows")
    row = metrics.compare_models(rows.withColumn("model", F.lit("agent")))
    hit, escalated = F.col("truth") == F.col("predicted"), F.col("truth_route") == "ESCALATE"
    plain = rows.agg(F.count("*").alias("n"), F.avg(hit.cast("double")).alias("a"), F.avg(F.when(
        escalated, (F.col("route") == "ESCALATE").cast("double"))).alias("r")).select(F.struct("*").alias("p")).scalar()
    return row.select("model", plain["n"].alias("n"), (F.abs(F.col("intent_accuracy") - plain["a"]) < 1e-9).alias("accurate"),
                      (F.abs(F.col("escalation_recall") - plain["r"]) < 1e-9).alias("recalled"))


# ---- composed jobs --------------------------------------------------------------------------------------

@query
def build_threads(spark, sf):
    return threads.build_threads(posts(spark, sf), BRAND).select("tweet_id", "tweet", "gold_reply")


@query
def build_splits(spark, sf):
    return datasets.build_splits(thread_table(spark, sf))


def golden_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Thread table, splits, golden set."""
    table = thread_table(spark, sf)
    splits = stage.stage(datasets.build_splits(table), "splits")
    return table, splits, datasets.build_golden(table, splits.filter("split <> 'test'"))


@query
def build_golden(spark, sf):
    return golden_rows(spark, sf)[2]


@query
def build_review(spark, sf):
    n = F.col("event_id")
    scores = derived.table(spark, sf, "events").select(
        n.cast("string").alias("tweet_id"),
        *[(4 + (n + i) % 2).cast("int").alias(f"human_{name}") for i, name in enumerate(fixed.RUBRIC)])
    return datasets.build_review(golden_rows(spark, sf)[2], scores).select(
        "tweet_id", *[f"human_{name}" for name in fixed.RUBRIC], "human_average_score")


@query
def build_test(spark, sf):
    table, splits, golden = golden_rows(spark, sf)
    return datasets.build_fresh_test(table, splits.filter("split <> 'test'"), golden)


@query
def run_all_jobs(spark, sf):
    """The document of a whole run, against its predictions, and the rows it wrote."""
    folder = stage.new_path(spark, "run")
    found = run_all.run_all(posts(spark, sf), folder, BRAND, judge=True)
    rows = scores_agree(spark.read.parquet(f"{folder}/predictions"), found)
    index = spark.read.parquet(f"{folder}/model/index").agg(F.count("*")).scalar()
    report = spark.read.json(f"{folder}/training").select("eval_samples").scalar()
    return rows.select("*", index.alias("n_index"), report.alias("n_validation"))


@query
def compare_baselines(spark, sf):
    """The majority row as it is; of the learned models, that they know more intents than it does."""
    agent, splits = fitted(spark, sf)
    rows = evaluate.compare_baselines(datasets.split_of(splits, "train"), datasets.split_of(splits, "test"), agent)
    plain = F.col("model") == "majority"
    best = F.col("intent_accuracy") > 0.5
    return rows.select("model", F.when(plain, F.col("intent_accuracy")).alias("majority_accuracy"), F.when(plain, F.round(
        "intent_macro_f1", 9)).alias("majority_f1"), best.alias("above_half"))


@query
def route_stream_messages(spark, sf):
    """The posts as an arriving set of files, routed by the stream, read back."""
    source, target = stage.new_path(spark, "arriving"), stage.new_path(spark, "routed")
    asked = threads.customer_posts(posts(spark, sf)).select("tweet_id", "text")
    asked.write.parquet(source)
    arriving = spark.readStream.schema(asked.schema).parquet(source)
    route_stream(arriving, target, stage.new_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(target).select("tweet_id", "intent", "decision", "reason")


def arrivals(rows: DataFrame, parts: int = 4) -> tuple[list[DataFrame], int, int]:
    """Posts by time in several parts, a fifth of them one part late; the length of a part and the last time, in seconds."""
    rows = rows.withColumn("created_at", F.col("created_at").cast("timestamp"))
    seconds = F.unix_timestamp("created_at")
    ends = rows.agg(F.min(seconds).alias("first"), F.max(seconds).alias("last")).first()
    first, last = (ends["first"] or 0, ends["last"] or 0)
    length = (last - first) // parts + 1
    late = F.when(F.crc32(F.col("tweet_id").cast("binary")) % 5 == 0, 1).otherwise(0)
    marked = rows.withColumn("_part", F.floor((seconds - first) / length) + late)
    return [marked.filter(F.col("_part") == i).drop("_part") for i in range(parts + 1)], length, last


@query
def thread_pairs_arriving(spark, sf):
    """The posts in several parts and out of order; the stream is started again for each, then read back."""
    rows = stage.stage(posts(spark, sf), "posts")
    parts, length, last = arrivals(rows)
    source, target, state = (stage.new_path(spark, n) for n in ("arriving", "pairs", "stream-state"))
    # A later post of nobody lets the clock run on.
    after = spark.range(1).select(*[
        F.timestamp_seconds(F.lit(last + 4 * length + 7200)).alias(f.name) if f.name == "created_at"
        else F.lit(None).cast(f.dataType).alias(f.name) for f in parts[0].schema])
    for part in [*parts, after]:
        part.write.mode("append").parquet(source)
        arriving = spark.readStream.schema(part.schema).parquet(source)
        thread_pairs_stream(arriving, target, state, brand=BRAND, delay=f"{2 * length + 120} seconds",
                            keep="3650 days").awaitTermination()
    return spark.read.parquet(target)


@query
def score_distribution_arriving(spark, sf):
    """Running counts of the posts, that arrive in several parts."""
    rows = stage.stage(customers(spark, sf).join(posts(spark, sf).select("tweet_id", "created_at"), "tweet_id"), "posts")
    source, target, state = (stage.new_path(spark, n) for n in ("arriving", "counts", "stream-state"))
    for part in arrivals(rows.select("tweet_id", "text", "confidence", "created_at"), 2)[0]:
        part.write.mode("append").parquet(source)
        arriving = spark.readStream.schema(part.schema).parquet(source)
        count_stream(arriving, target, state, confidence="confidence").awaitTermination()
    return latest_counts(spark, target)


@query
def refresh_threads(spark, sf):
    """The thread table after the posts have come in several parts and out of order, each merged by a run of its own."""
    source, folder = stage.new_path(spark, "arriving"), stage.new_path(spark, "state")
    found = None
    for part in arrivals(stage.stage(posts(spark, sf), "posts"), 2)[0]:
        part.write.mode("append").parquet(source)
        found = refresh.refresh_threads(spark, source, folder, BRAND)
    return threads.threads_at(found, fixed.MIN_CHARS).select("tweet_id", "tweet", "gold_reply", "intent")


QUERIES["run_all"] = QUERIES.pop("run_all_jobs")
QUERIES["route_stream"] = QUERIES.pop("route_stream_messages")
