"""Threads merged part by part against the thread table built at once."""

import random

import pytest
from pyspark.sql import functions as F

from deskflow.plans import refresh
from deskflow.plans.datasets import thread_table
from deskflow.plans.refresh import refresh_threads
from deskflow.plans.run_all import run_all_parts
from deskflow.queries import posts
from deskflow.sources.stage import folders, new_path

SF = "/root/testdata/sf0.001"
KINDS = ("tweet_id string, author_id string, inbound string, created_at string, text string, response_tweet_id string, "
         "in_response_to_tweet_id string")


def some_posts(seed, n=120):
    """Few texts and few posts, so that texts meet, replies come late, and rows repeat; nulls in every column."""
    dice = random.Random(seed)
    out = []
    for i in range(n):
        now, post = f"2024-01-{dice.randint(1, 28):02d}", str(dice.randint(0, 25))
        text = dice.choice(["my battery drain is very bad", "please refund me, charged twice", "hello to all of you there",
                            "icloud sync is stuck again today", "short", "", None, "é" * 30])
        if dice.random() < 0.5:
            out.append((dice.choice([post, None]) if dice.random() < 0.1 else post, f"u{i}", "True", now, text, None, None))
        else:
            reply = dice.choice(["Please check Settings first", "no", f"We are looking into this case {i % 3}", None,
                                 "Restart it, please."])
            out.append((f"r{dice.randint(0, 40)}", "Support", "False", dice.choice([now, None]), reply, None,
                        dice.choice([post, None]) if dice.random() < 0.1 else post))
    return out + out[:5]


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("seed, fold", [(1, 16), (2, 2)])
def test_parts_equal_the_whole(spark, seed, fold):
    data = some_posts(seed)
    random.Random(seed).shuffle(data)
    source, folder = new_path(spark, "source"), new_path(spark, "state")
    begin = 0
    for end in (40, 80, len(data)):
        spark.createDataFrame(data[begin:end], KINDS).coalesce(1).write.mode("append").parquet(source)
        found = refresh_threads(spark, source, folder, "Support", fold=fold)
        want = thread_table(spark.createDataFrame(data[:end], KINDS), "Support")
        assert rows(found) == rows(want)
        begin = end
    assert len(folders(spark, folder, "asked-")) <= fold + 1 and len(folders(spark, folder, "threads-")) == 1


def test_only_new_parts_are_read(spark, monkeypatch, tmp_path):
    source, folder = tmp_path / "source", str(tmp_path / "state")
    data, read = some_posts(7, 200), []
    merge = refresh._merge
    monkeypatch.setattr(refresh, "_merge", lambda state, out, new, *rest: (
        read.append((state is None, new.count(), len(new.inputFiles()))), merge(state, out, new, *rest)))

    def add(part):
        spark.createDataFrame(part, KINDS).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        return rows(refresh_threads(spark, str(source), folder, "Support"))

    def whole():
        return rows(thread_table(spark.read.schema(KINDS).parquet(str(source)), "Support"))

    add(data[:195])
    assert run() == whole() and read.pop() == (True, 195, 1)
    assert run() == whole() and not read
    add(data[195:])
    assert run() == whole() and read.pop() == (False, 10, 1)
    # A part under another name brings nothing new; with the same rows twice, one of them is new.
    first = min(source.glob("part-*.parquet"), key=lambda f: f.stat().st_size)
    first.rename(source / "part-other.parquet")
    assert run() == whole() and read.pop()[:2] == (False, 0)
    add(data[195:])
    assert run() == whole() and read.pop() == (False, 10, 1)
    # A part that is gone means a new start.
    (source / "part-other.parquet").unlink()
    assert run() == whole() and read.pop()[0]
    # A run that fails half-way is made up for by the next.
    add(data[:3])
    monkeypatch.setattr(refresh, "_clear", lambda *_: 1 / 0)
    monkeypatch.setattr(refresh, "label_intents", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.undo()
    assert run() == whole()


def test_other_settings_and_no_posts(spark, tmp_path):
    source, folder = str(tmp_path / "source"), str(tmp_path / "state")
    with pytest.raises(ValueError):
        (tmp_path / "source").mkdir()
        refresh_threads(spark, source, folder, "Support")
    spark.createDataFrame([], KINDS).coalesce(1).write.mode("append").parquet(source)
    assert refresh_threads(spark, source, folder, "Support").count() == 0
    spark.createDataFrame(some_posts(9), KINDS).write.mode("append").parquet(source)
    mine = [("any", "settings|battery")]
    want = thread_table(spark.read.parquet(source), "Support", mine)
    assert rows(refresh_threads(spark, source, folder, "Support")) != rows(want)
    assert rows(refresh_threads(spark, source, folder, "Support", mine)) == rows(want)


def test_no_state_is_shuffled_for_a_small_part(spark, tmp_path):
    """What is joined with the state is sent to it."""
    source, folder = str(tmp_path / "source"), str(tmp_path / "state")
    posts(spark, SF).write.parquet(source)
    refresh_threads(spark, source, folder, "Support")
    state = refresh._State(spark, folder, 1, 1)
    few = state.read("replies").limit(3)
    plan = refresh._only(state.read("asked"), few, "tweet_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_run_over_parts(spark):
    source, folder = new_path(spark, "source"), new_path(spark, "run")
    data = posts(spark, SF)
    data.write.parquet(source)
    run_all_parts(spark, source, folder, "Support")
    splits = spark.read.parquet(f"{folder}/splits").inputFiles()
    # Posts nobody answered change no thread: nothing after it is built again.
    data.filter("author_id <> 'Support'").orderBy("tweet_id").limit(2).withColumns(
        {"tweet_id": F.concat(F.lit("new"), "tweet_id")}).write.mode("append").parquet(source)
    run_all_parts(spark, source, folder, "Support")
    assert spark.read.parquet(f"{folder}/splits").inputFiles() == splits
    # Posts that were answered do, but what is kept stays; the index has the new threads.
    again = data.filter("author_id <> 'Support' AND text LIKE '%charger%case%'").orderBy("tweet_id").limit(3)
    new = again.withColumns({"tweet_id": F.concat(F.lit("more"), "tweet_id"), "text": F.concat("text", F.lit(" once more"))})
    answers = new.select(*[F.lit("Support").alias(c) if c == "author_id" else F.lit("False").alias(c) if c == "inbound"
                           else F.col("tweet_id").alias(c) if c == "in_response_to_tweet_id"
                           else F.concat(F.lit("r"), "tweet_id").alias(c) if c == "tweet_id"
                           else F.lit("Please check Settings, it helps").alias(c) if c == "text" else F.col(c)
                           for c in data.columns])
    golden, index = spark.read.parquet(f"{folder}/golden").inputFiles(), spark.read.parquet(f"{folder}/model/index").count()
    new.unionByName(answers).write.mode("append").parquet(source)
    run_all_parts(spark, source, folder, "Support", keep=["golden", "splits"])
    assert spark.read.parquet(f"{folder}/splits").inputFiles() == splits
    assert spark.read.parquet(f"{folder}/golden").inputFiles() == golden
    assert spark.read.parquet(f"{folder}/model/index").count() > index
    # New splits avoid the golden set that stays.
    run_all_parts(spark, source, folder, "Support", keep=["golden"], rules=[("any", "case|settings")])
    assert spark.read.parquet(f"{folder}/golden").inputFiles() == golden
    assert spark.read.parquet(f"{folder}/splits").inputFiles() != splits
    assert spark.read.parquet(f"{folder}/splits").join(spark.read.parquet(f"{folder}/golden"), "tweet").count() == 0
    with pytest.raises(ValueError):
        run_all_parts(spark, source, folder, "Support", keep=["model"])
