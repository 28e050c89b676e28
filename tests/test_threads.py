from pyspark.sql import functions as F

from deskflow.operators.holdout import split_overlap, used_keys, used_texts, without_used, without_used_filtered
from deskflow.operators.seen import Seen
from deskflow.operators.sampling import cap_splits, first_per_class, random_rows, stratified_split, topped_up_sample
from deskflow.operators.threads import build_threads, dedupe_text, first_replies, keep_first, thread_levels, thread_pairs, threads_at, turn_pairs
from deskflow.schemas import POSTS


def posts(spark, rows):
    full = [(i, author, inbound, at, text, None, to) for i, author, inbound, at, text, to in rows]
    return spark.createDataFrame(full, POSTS)


LONG = "my battery is draining so very fast"
REPLY = "We can help with that, please see Settings"


def test_pairs(spark):
    p = posts(spark, [
        ("1", "u1", "True", "a", LONG, None),
        ("2", "u2", "1", "b", LONG + " again", None),
        ("3", "u3", "t", "c", "unanswered question of some length", None),
        ("4", "u4", "no", "d", "not a customer post at all, no", None),
        ("10", "AppleSupport", "False", "z", "later answer to the first post", "1"),
        ("11", "AppleSupport", "False", "y", REPLY, "1"),
        ("12", "AppleSupport", "False", "y", REPLY + "!", "2"),
        ("13", "Other", "False", "a", "another brand answered sooner here", "2"),
        ("14", "AppleSupport", "False", "y", "answer to nothing that is here", None),
        ("15", "AppleSupport", "False", "y", REPLY, "4"),
    ])
    got = {r["tweet_id"]: r["gold_reply"] for r in thread_pairs(p).collect()}
    assert got == {"1": REPLY, "2": REPLY + "!"}
    assert first_replies(p).count() == 3


def test_threads_filter_and_first(spark):
    p = posts(spark, [
        ("1", "u", "true", "b", "@x " + LONG, None), ("2", "u", "true", "a", LONG + " http://t.co/1", None),
        ("3", "u", "true", "a", "too short", None), ("4", "u", "true", "a", "long enough to be kept but bad reply", None),
        ("5", "u", "true", "a", "@a @b @c @d @e @f @g short", None),
        *[(f"r{i}", "AppleSupport", "f", "z", REPLY if i != 4 else "ok", str(i)) for i in range(1, 6)],
    ])
    rows = build_threads(p).collect()
    # The earlier of two posts that clean to the same text stays.
    assert [(r["tweet_id"], r["tweet"], r["gold_reply"]) for r in rows] == [("2", LONG, REPLY)]


def test_levels_in_one_pass(spark):
    p = posts(spark, [
        ("1", "u", "true", "a", LONG, None), ("2", "u", "true", "b", LONG, None), ("3", "u", "true", "a", "just twenty one chars", None),
        ("r1", "AppleSupport", "f", "z", "only twenty-one chars", "1"), ("r2", "AppleSupport", "f", "z", REPLY, "2"),
        ("r3", "AppleSupport", "f", "z", REPLY, "3"),
    ])
    table = thread_levels(p, levels=(20, 25))
    at = lambda n: sorted((r["tweet_id"], r["gold_reply"]) for r in threads_at(table, n).collect())
    assert at(20) == [("1", "only twenty-one chars"), ("3", REPLY)]
    assert at(25) == [("2", REPLY)]
    for n in (20, 25):
        assert at(n) == sorted((r["tweet_id"], r["gold_reply"]) for r in build_threads(p, min_chars=n).collect())


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (30000 - F.col("id")).alias("o"), F.col("id").alias("v")).repartition(8)
    first = keep_first(df, "k", ["o"])
    assert first.count() == 20001
    assert first.filter("k = 'hot'").first()["v"] == 29997
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(k")


def test_turn_pairs(spark):
    df = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", "q2"), (1, 4, "user", "q3"),
         (2, 0, "assistant", "x")], "conv_id long, turn long, role string, text string")
    assert [(r["turn"], r["tweet"], r["gold_reply"]) for r in turn_pairs(df).collect()] == [(1, "q", "a")]


def test_holdout(spark):
    pool = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "b")], "i int, tweet string")
    used = used_texts(spark.createDataFrame([("b",), (None,)], "tweet string"), spark.createDataFrame([("b",)], "tweet string"))
    assert used.count() == 1
    assert sorted(r["i"] for r in without_used(pool, used).collect()) == [1, 3]
    got = split_overlap({"x": pool, "y": used, "z": pool.filter("i = 1")}).collect()
    assert [tuple(r) for r in got] == [("x", "y", 1), ("x", "z", 1), ("y", "z", 0)]


def test_filter_of_used_texts(spark):
    pool = spark.range(6000).select("id", F.when(F.col("id") % 50 > 0, F.concat(F.lit("t"), F.col("id") % 4000)).alias("tweet"))
    used = spark.range(300).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), F.col("id") * 17)).alias("tweet"))
    want = sorted(r["id"] for r in without_used(pool, used).collect())
    # Usual size, several arrays, and a filter far too small, which finds everything.
    for size in ({}, {"part_words": 16}, {"part_words": 1, "max_parts": 2}):
        got = without_used_filtered(pool, used_keys(used), **size)
        assert sorted(r["id"] for r in got.collect()) == want
        assert got.columns == pool.columns
    nothing = without_used_filtered(pool, used.limit(0))
    assert nothing.count() == 6000
    assert without_used_filtered(pool.limit(0), used).count() == 0
    names = {"x": pool, "y": used, "z": pool.filter("id < 40")}
    pairs = sorted(map(tuple, split_overlap(names).collect()))
    for large in names:
        assert sorted(map(tuple, split_overlap(names, large=large, part_words=16).collect())) == pairs


def test_clean_rows_of_the_pool_are_not_shuffled(spark, tmp_path):
    spark.range(20000).select(F.col("id").cast("string").alias("tweet")).write.parquet(str(tmp_path / "pool"))
    pool = spark.read.parquet(str(tmp_path / "pool"))
    used = spark.range(19000, 25000).select(F.col("id").cast("string").alias("tweet"))
    seen = Seen(used)
    found = pool.filter(seen.may_hold(F.col("tweet"))).count()
    assert 1000 <= found < 1000 + 19000 * 0.02
    plan = without_used_filtered(pool, used)._jdf.queryExecution().sparkPlan().toString()
    clean, verified = plan.split("\n:- ", 1)[1].split("\n+- ", 1)
    assert "Join" not in clean and "Join" in verified


def classes(spark, n=20000):
    # Class a holds a third, b half of the rest.
    kind = F.expr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN 'b' ELSE concat('c', id % 4) END")
    return spark.range(n).select(F.col("id").cast("string").alias("tweet_id"), kind.alias("intent"))


def test_split_sizes_and_stability(spark):
    df = classes(spark)
    got = {}
    for parts in (1, 7):
        split = stratified_split(df.repartition(parts))
        got[parts] = sorted((r["split"], r["intent"], r["tweet_id"]) for r in split.collect())
    assert got[1] == got[7]
    assert got[1] == sorted((r["split"], r["intent"], r["tweet_id"]) for r in stratified_split(df).collect())
    assert len({t for _, _, t in got[1]}) == len(got[1])
    counts = {}
    for s, c, _ in got[1]:
        counts[s, c] = counts.get((s, c), 0) + 1
    assert (counts["train", "a"], counts["validation", "a"], counts["test", "a"]) == (900, 225, 225)
    n = df.filter("intent = 'c1'").count()
    assert counts["train", "c1"] == min(int(n * 0.6), 900)
    assert counts["test", "c1"] == min(int(n * 0.2), 225)
    capped = cap_splits(stratified_split(df), totals={"train": 1000, "validation": 10, "test": 5000})
    sizes = {r["split"]: r["count"] for r in capped.groupBy("split").count().collect()}
    assert sizes["train"] == 1000 and sizes["validation"] == 10 and sizes["test"] == sum(
        v for (s, _), v in counts.items() if s == "test")


def test_first_per_class_two_ways(spark):
    df = classes(spark, 6000)
    direct = sorted(r["tweet_id"] for r in first_per_class(df, 40).collect())
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        assert sorted(r["tweet_id"] for r in first_per_class(df, 40).collect()) == direct
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_group_limit_runs_before_the_shuffle(spark):
    plan = first_per_class(classes(spark), 40)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_random_rows_two_ways(spark):
    df = classes(spark, 5000)
    want = [r["tweet_id"] for r in random_rows(df, 900).collect()]
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        assert [r["tweet_id"] for r in random_rows(df, 900).collect()] == want
        assert random_rows(df, 9000).count() == 5000
        assert random_rows(df.filter("false"), 900).count() == 0
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_dedupe_text(spark):
    df = spark.createDataFrame([("x", 3, "c"), ("x", 1, "a"), ("y", 2, "b")], "t string, i int, v string")
    assert sorted(map(tuple, dedupe_text(df, "t", ["i"]).collect())) == [("x", 1, "a"), ("y", 2, "b")]
    assert dedupe_text(df, "t", ["i"], keep_text=False).columns == ["i", "v"]


def test_topped_up(spark):
    df = classes(spark, 3000)
    rows = topped_up_sample(df, 5, 100).collect()
    assert len(rows) == len({r["tweet_id"] for r in rows}) == 100
    picked = {r["tweet_id"] for r in first_per_class(df, 5).collect()}
    assert picked <= {r["tweet_id"] for r in rows}
    assert topped_up_sample(df, 50, 100).count() == 100
    assert topped_up_sample(df, 5, 5000).count() == 3000
