"""Pinned schemas of every table read from or written to storage."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


POSTS = _strings(
    "tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "in_response_to_tweet_id"
)
LABELLED = _strings("tweet", "gold_reply", "intent")
EVALUATION = _strings("tweet", "intent", "gold_reply", "escalate", "reason")
HUMAN_REVIEW = T.StructType(
    EVALUATION.fields
    + [T.StructField(f"human_{n}", T.IntegerType())
       for n in ("correctness", "helpfulness", "brand_tone", "groundedness")]
    + _doubles("human_average_score")
)
PREDICTIONS = T.StructType([
    T.StructField("tweet", T.StringType()),
    T.StructField("intent", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("generated_reply", T.StringType()),
    T.StructField("decision", T.StringType()),
    T.StructField("reason", T.StringType()),
])
VECTOR_TABLE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("tweet", T.StringType()),
    T.StructField("apple_reply", T.StringType()),
    T.StructField("intent", T.StringType()),
])
METRICS = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("intent_classification", T.StructType(
        _doubles("accuracy", "precision_macro", "recall_macro", "macro_f1")
        + [T.StructField("eval_samples", T.LongType())])),
    T.StructField("escalation_decision", T.StructType(
        _doubles("accuracy", "precision", "recall", "f1_score")
        + [T.StructField("eval_samples", T.LongType())])),
    T.StructField("reply_quality_judge", T.StructType(
        [T.StructField("status", T.StringType())]
        + _doubles("mean_correctness", "mean_helpfulness", "mean_brand_tone", "mean_groundedness",
                   "mean_composite_score")
        + [T.StructField("total_evaluated", T.LongType()),
           T.StructField("human_agreement", T.StructType(
               [T.StructField("sample_size", T.LongType())]
               + _doubles("pearson_correlation", "mean_absolute_error", "agreement_within_1_point_pct",
                          "human_mean_score", "judge_mean_score")))])),
])
JUDGE_ANSWER = _strings("correctness", "helpfulness", "brand_tone", "groundedness", "explanation")
