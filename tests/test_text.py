import random

import pytest
from pyspark.sql import functions as F

from deskflow.functions import text as tx
from deskflow.functions.columns import compute_once
from deskflow.functions.replies import cap_words, context_block, draft_reply, prompt_examples
from deskflow import fixed


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


@pytest.mark.parametrize("raw, cleaned", [
    (None, ""),
    ("@support  my phone\nis broken https://a.b/c?d=1 now", "my phone is broken now"),
    ("see www.example.com/x and http://y", "see and"),
    ("@joséx hello", "hello"),
    ("a&amp;lt;b &quot;q&quot; &gt;", 'a<b "q" >'),
    ("ok \U0001F600\U0001F600 café", "ok caf"),
    ("http://x y", "y"),
    ("tab\there   end ", "tab here end"),
])
def test_clean_text(spark, raw, cleaned):
    assert apply(spark, [raw], tx.clean_text) == [cleaned]


def test_words_follow_unicode_spaces(spark):
    rng = random.Random(7)
    alphabet = "ab,.é\U0001F600" + tx.SPACES
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    assert apply(spark, values, tx.word_count) == [len(v.split()) for v in values]
    assert apply(spark, values, tx.strip) == [v.strip() for v in values]


def test_numbers_round_like_binary_values(spark):
    rng = random.Random(7)
    values = [0.125, 0.375, 0.595, 0.605, 0.6, 1.0, 0.005, 2.675, 1234.565, -0.001] + [rng.random() for _ in range(500)]
    assert apply(spark, values, lambda c: tx.fixed_point(c, 2), "double") == [f"{v:.2f}" for v in values]
    assert apply(spark, values, lambda c: tx.round_binary(c, 4), "double") == [round(v, 4) for v in values]


def test_mostly_ascii(spark):
    values = [None, "", "abcd", "abcde", "  abcd  ", "abcdeé", "abcdefgé"]
    assert apply(spark, values, tx.mostly_ascii) == [False, False, False, True, False, False, True]


def test_parse_flag(spark):
    assert apply(spark, ["True", "1", "T", "false", "yes", "", None], tx.parse_flag) == [True] * 3 + [False] * 4


def test_embed_input(spark):
    assert apply(spark, [None, "", " \t", " a "], tx.embed_input) == [" ", " ", " ", " a "]


def test_cap_words(spark):
    exact = " ".join(["w"] * 70)
    cases = {
        exact: exact,
        "  two   words ": "  two   words ",
        " ".join(["w"] * 69 + ["last,", "more"]): " ".join(["w"] * 69 + ["last."]),
        " ".join(["w"] * 69 + ["done!", "more"]): " ".join(["w"] * 69 + ["done!"]),
        " ".join(["w"] * 68 + ["a", "-", "more"]): " ".join(["w"] * 68 + ["a."]),
        "": "",
    }
    assert apply(spark, list(cases), cap_words) == list(cases.values())


def test_context_and_draft(spark):
    df = spark.createDataFrame(
        [(1, [(0.987, "q1", "a1 b c", "app_store"), (0.5, "q2", "a2", None)]), (2, []), (3, None)],
        "i int, n array<struct<similarity: double, tweet: string, apple_reply: string, intent: string>>")
    rows = df.orderBy("i").select(context_block(F.col("n")), prompt_examples(F.col("n")), draft_reply(F.col("n"), 2)).collect()
    assert rows[0][0] == ("[Example 1] (Intent: app_store, Relevance: 0.99)\nCustomer: q1\nApple Support Reply: a1 b c\n\n"
                          "[Example 2] (Intent: unknown, Relevance: 0.50)\nCustomer: q2\nApple Support Reply: a2")
    assert rows[0][1] == "Example 1:\nQ: q1\nA: a1 b c\n\nExample 2:\nQ: q2\nA: a2"
    assert rows[0][2] == "a1 b."
    for r in rows[1:]:
        assert tuple(r) == (fixed.NO_CONTEXT, fixed.NO_EXAMPLES, fixed.DEFAULT_REPLY)


def test_compute_once_keeps_one_expression(spark):
    df = spark.createDataFrame([("a@b  c",)], "text string")
    once = compute_once(df, tweet=tx.clean_text(F.col("text"))).filter((F.length("tweet") > 1) & F.col("tweet").contains("a"))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("https?://") == 1
    assert once.first()["tweet"] == "a c"
