"""Pairs and counts from arriving posts."""

import pytest

from deskflow.operators.threads import thread_pairs
from deskflow.sources.stage import new_path, remove
from deskflow.streaming.threads import count_stream, latest_counts, thread_pairs_stream

SCHEMA = "tweet_id string, author_id string, inbound string, created_at timestamp, text string, in_response_to_tweet_id string"
DAY = "2024-03-01 "


def post(name, time, text, extra=""):
    return f"('{name}', 'u', 'True', timestamp'{DAY}{time}', {text}, NULL)"


def reply(name, time, text, to):
    return f"('{name}', 'B', 'False', timestamp'{DAY}{time}', {text}, '{to}')"


def clock(time):
    return f"('x', 'nobody', 'False', timestamp'{DAY}{time}', NULL, NULL)"


def frame(spark, rows):
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)}").toDF(*[c.split()[0] for c in SCHEMA.split(", ")]).to(
        spark.createDataFrame([], SCHEMA).schema)


@pytest.fixture
def run(spark):
    """Lets parts arrive one after another; gives the pairs after each."""
    source, target, state = (new_path(spark, n) for n in ("in", "out", "state"))

    def arrive(rows, **options):
        frame(spark, rows).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(SCHEMA).parquet(source)
        thread_pairs_stream(arriving, target, state, brand="B", delay="10 minutes", **options).awaitTermination()
        return sorted(map(tuple, spark.read.parquet(target).collect()))

    return arrive


def test_an_earlier_reply_that_arrives_later_wins(run):
    assert run([post("1", "10:00", "'q'"), reply("8", "10:05", "'second'", "1")]) == []
    # Out of order, the reply before the question, a tie in time, ids that repeat.
    assert run([reply("7", "10:03", "'first'", "1"), reply("9", "10:03", "'tie'", "1"), reply("5", "10:06", "'early'", "2"),
                reply("5", "10:06", "'early'", "2")]) == []
    # The clock passes 10:03 but not 10:06; the question of the second reply comes when that is settled.
    assert run([clock("10:14")]) == [("1", "q", "first")]
    assert run([clock("10:40")]) == [("1", "q", "first")]
    assert run([post("2", "10:35", "'late question'"), clock("11:30")]) == [
        ("1", "q", "first"), ("2", "late question", "early")]
    # Done posts stay done.
    assert len(run([reply("10", "11:40", "'again'", "1"), clock("13:00")])) == 2


def test_late_posts_nulls_and_waiting_time(run):
    assert run([post("1", "10:00", "NULL"), post("2", "10:00", "''"), post("3", "10:00", "'q'"), clock("10:30")],
               keep="30 minutes") == []
    # Behind the watermark (10:20): left out, though a reply on time in the same batch counts.
    assert run([reply("a", "10:10", "'late'", "1"), reply("b", "10:25", "'on time'", "1"), reply("c", "10:25", "NULL", "2"),
                reply("d", "10:26", "'second'", "2"), clock("11:00")], keep="30 minutes") == [("1", None, "on time")]
    # Post 3 has waited 30 minutes; its state is gone.
    assert run([reply("e", "11:05", "'too late'", "3"), clock("12:00")], keep="30 minutes") == [("1", None, "on time")]


def test_hot_post_and_many_parts_like_the_batch(spark, run):
    """All times within ten minutes, so nothing is late; post 7 has two thirds of the replies."""
    rows = [post(str(i), f"10:0{i % 3}:{i % 60:02d}", f"'q{i}'") for i in range(120)]
    rows += [reply(f"r{i}", f"10:0{4 + i % 5}:{i * 7 % 60:02d}", f"'a{i}'", i % 3 and 7 or i % 120) for i in range(900)]
    for part in range(3):
        run(rows[part::3])
    got = run([clock("12:00")])
    want = thread_pairs(frame(spark, rows), "B").select("tweet_id", "text", "gold_reply")
    assert got == sorted(map(tuple, want.collect())) and len(got) > 40


def test_running_counts(spark):
    source, target, state = (new_path(spark, n) for n in ("in", "out", "state"))
    seen = []
    for texts in (["My phone was hacked", "hello there you"], ["my phone was hacked again", None, ""]):
        spark.createDataFrame([(t,) for t in texts], "text string").write.mode("append").parquet(source)
        count_stream(spark.readStream.schema("text string").parquet(source), target, state).awaitTermination()
        seen.append(sum(r["n"] for r in latest_counts(spark, target).collect()))
    assert seen == [2, 5]


def test_the_state_is_one_native_grouping(spark, monkeypatch, run):
    """No Python per post: each post of a batch costs a row of a grouping, and a repeated batch replaces its pairs."""
    from deskflow.streaming import threads

    plans, settle = [], threads.settle

    def seen(*args):
        rows = settle(*args)
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows

    monkeypatch.setattr(threads, "settle", seen)
    run([post("1", "10:00", "'q'"), reply("8", "10:05", "'a'", "1")])
    assert run([clock("11:00")]) == [("1", "q", "a")]
    assert len(plans) == 2 and not any("Pandas" in p or "Python" in p for p in plans)


def test_a_repeated_batch_gives_its_pairs_once(spark):
    source, target, state = (new_path(spark, n) for n in ("in", "out", "state"))
    for rows in ([post("1", "10:00", "'q'"), reply("8", "10:05", "'a'", "1")], [clock("11:00")]):
        frame(spark, rows).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(SCHEMA).parquet(source)
        thread_pairs_stream(arriving, target, state, brand="B", delay="10 minutes").awaitTermination()
    # As if the driver was lost before the batch was marked.
    for name in ("1", ".1.crc"):
        remove(spark, f"{state}/commits/{name}")
    arriving = spark.readStream.schema(SCHEMA).parquet(source)
    thread_pairs_stream(arriving, target, state, brand="B", delay="10 minutes").awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [("1", "q", "a")]
