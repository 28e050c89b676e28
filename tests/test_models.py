from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskflow import fixed, schemas
from deskflow.operators.linear import SquaredHinge
from deskflow.operators.models import IntentClassifier, SvmBaseline, TextEncoder
from deskflow.plans.evaluate import training_report
from deskflow.plans.predict import SupportAgent, predict_file, predict_table
from deskflow.plans.run_all import run_all
from deskflow.queries import posts
from deskflow.sources.derived import BRAND
from deskflow.sources.stage import new_path, shared_folder
from deskflow.sources.tables import scan_messages, scan_metrics, scan_posts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def train(spark):
    rows = []
    for i in range(270):
        intent = fixed.INTENTS[i % 9]
        rows.append((str(i), f"{intent.replace('_', ' ')} trouble number {i % 30}", f"Please check {intent} number {i}", intent))
    return spark.createDataFrame(rows, "tweet_id string, tweet string, gold_reply string, intent string")


@pytest.fixture(scope="module")
def agent(train):
    return SupportAgent.fit(train)


def test_probabilities(spark, train, agent):
    rows = agent.classifier.predict(agent.encoder.encode(train.drop("intent"))).collect()
    for r in rows:
        assert r["intent"] in fixed.INTENTS
        assert 0 <= r["confidence"] <= 1
        assert len(r["class_probabilities"]) == 9
        assert sum(r["class_probabilities"].values()) == pytest.approx(1)
        assert max(r["class_probabilities"], key=r["class_probabilities"].get) == r["intent"]


def test_contract(spark, agent):
    long = " ".join(["word"] * 200)
    messages = spark.createDataFrame([(1, "battery issue trouble"), (2, None), (3, "  my phone was stolen "), (4, long)],
                                     "message_id long, text string")
    rows = {r["message_id"]: r for r in agent.predict(messages, k=3).collect()}
    assert len(rows) == 4
    for r in rows.values():
        assert len(r["retrieved_context"]) == 3
        assert len(r["generated_reply"].split()) <= 70
        assert r["decision"] in ("AUTO", "ESCALATE") and r["reason"]
    assert rows[1]["intent"] == "battery_issue"
    assert rows[1]["generated_reply"].startswith("Please check battery_issue")
    assert rows[2]["tweet"] == "" and rows[3]["tweet"] == "my phone was stolen"


def test_predict_texts(agent):
    rows = agent.predict_texts(["app store trouble", None], k=2).collect()
    assert [(r["message_id"], len(r["retrieved_context"])) for r in rows] == [(0, 2), (1, 2)]


def test_prediction_needs_no_shuffle(spark, agent):
    messages = spark.createDataFrame([(1, "battery issue trouble")], "message_id long, text string")
    plan = agent.predict(messages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython") == 1


def test_save_and_load(spark, train, agent):
    path = new_path(spark, "agent")
    agent.save(path)
    loaded = SupportAgent.load(spark, path)
    messages = train.select("tweet_id", F.col("tweet").alias("text"))
    same = lambda a: sorted(map(str, a.predict(messages, message_id="tweet_id").collect()))
    assert same(agent) == same(loaded)
    with pytest.raises(FileNotFoundError, match="fit and save"):
        IntentClassifier.load(spark, path + "/nowhere")


def test_own_encoder(spark, train):
    def lengths(texts):
        return np.array([[len(t), 3.0, 4.0] for t in texts])

    rows = TextEncoder(vectorize=lengths).encode(train).collect()
    for r in rows:
        n = len(r["tweet"])
        assert r["embedding"] == pytest.approx([x / (n * n + 25) ** 0.5 for x in (n, 3, 4)], abs=1e-6)


def test_agent_with_own_encoder(spark, train):
    def counts(texts):
        return np.array([[t.count(c) for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts])

    own = TextEncoder(vectorize=counts)
    more = train.withColumn("tweet_id", F.concat(F.lit("x"), "tweet_id"))
    fitted = SupportAgent.fit(train, train.unionByName(more), encoder=own)
    assert fitted.index.count() == 2 * train.count()
    path = new_path(spark, "own")
    fitted.save(path)
    loaded = SupportAgent.load(spark, path, encoder=own)
    messages = train.select("tweet_id", F.col("tweet").alias("text"))
    once, again = (sorted(map(str, a.predict(messages, message_id="tweet_id").collect())) for a in (fitted, loaded))
    assert once == again
    # The same vectors, worked out beforehand.
    vectors = own.encode(train, output="v")
    given = SupportAgent.fit(vectors, own.encode(train.unionByName(more), output="v"), vector="v")
    given.save(path + "-given")
    plain = SupportAgent.load(spark, path + "-given")
    assert plain.encoder is None
    rows = plain.predict(own.encode(messages, "text", output="v"), message_id="tweet_id", vector="v")
    shown = ["tweet_id", "intent", "decision", "generated_reply"]
    assert sorted(map(str, rows.select(shown).collect())) == sorted(map(str, fitted.predict(
        messages, message_id="tweet_id").select(shown).collect()))


def test_training_report(train, agent):
    summary, by_class = training_report(agent, train)
    assert summary.first()["eval_samples"] == 270
    assert {r["label"] for r in by_class.collect()} == {*fixed.INTENTS, "accuracy", "macro avg", "weighted avg"}


def test_svm_baseline(spark, train):
    first = SvmBaseline.fit(train)
    rows = first.predict(train.withColumnRenamed("intent", "truth")).collect()
    assert np.mean([r["intent"] == r["truth"] for r in rows]) > 0.9
    assert first.model.slope <= 1e-7
    second = SvmBaseline.fit(train.repartition(5))
    assert (first.model.coefficients == second.model.coefficients).all()
    # Several blocks come to the same optimum.
    third = SvmBaseline.fit(train, rows_per_block=100, tol=1e-5)
    assert third.model.slope <= 1e-5
    assert third.model.coefficients == pytest.approx(first.model.coefficients, abs=1e-2)


def test_squared_hinge_against_dense_newton(spark):
    """The optimum by full Newton steps on dense matrices, class by class."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 12)) * (rng.random((400, 12)) < 0.4)
    y = (x[:, :3] + 0.5 * rng.normal(size=(400, 3))).argmax(axis=1)
    rows = [(int(k), np.flatnonzero(v).tolist(), v[v != 0].tolist(), i) for i, (k, v) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "label int, columns array<int>, cells array<double>, _order long")
    wide = np.hstack([x, np.ones((400, 1))])
    for c, per_block in ((1.0, 8192), (0.05, 20), (20.0, 60)):
        got = SquaredHinge.fit(df.repartition(3), 12, 3, c, rows_per_block=per_block)
        for k in range(3):
            sign, w = np.where(y == k, 1.0, -1.0), np.zeros(13)
            for _ in range(200):
                short = np.maximum(0, 1 - sign * (wide @ w))
                g = w - 2 * c * wide.T @ (sign * short)
                a = wide[short > 0]
                w = w - (1.0 if _ < 20 else 0.5) * np.linalg.solve(np.eye(13) + 2 * c * a.T @ a, g)
            assert np.abs(g).max() < 1e-6
            assert got.coefficients[:, k] == pytest.approx(w, abs=1e-4)
    assert SquaredHinge.fit(df.limit(0), 12, 3).steps == 0


def test_predict_table(spark, train, agent):
    path, source = new_path(spark, "out"), new_path(spark, "in")
    asked = train.select("intent", F.col("tweet").alias("query"))
    asked.write.parquet(source)
    predict_file(agent, source, path, fmt="csv")
    saved = spark.read.option("header", True).csv(path)
    assert saved.columns == ["message_id", *schemas.PREDICTIONS.names]
    assert saved.count() == saved.select("message_id").distinct().count() == 270
    asked.coalesce(1).write.option("header", True).csv(source + ".csv")
    predict_file(agent, source + ".csv", path)
    assert spark.read.parquet(path).select("message_id").distinct().count() == 270
    predict_table(agent, train.withColumnRenamed("tweet_id", "message_id"), path)
    assert spark.read.parquet(path).join(train, F.col("message_id") == F.col("tweet_id")).count() == 270
    with pytest.raises(ValueError, match="message_id"):
        predict_table(agent, asked, path)
    with pytest.raises(ValueError, match="Found columns"):
        scan_messages(train.select("gold_reply"))


def test_scan_posts_reads_line_breaks(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        'x,tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n'
        '9,001,u,True,now,"a ""quoted""\ntext, here",,\n')
    rows = scan_posts(spark, str(tmp_path / "p.csv")).collect()
    assert [tuple(r) for r in rows] == [("001", "u", "True", "now", 'a "quoted"\ntext, here', None, None)]


def test_run_all_writes_and_reuses(spark):
    folder = new_path(spark, "run")
    p = posts(spark, SF)
    before = len(list(Path(shared_folder(spark)).glob("deskflow/scratch-*")))
    first = run_all(p, folder, BRAND, judge=True).first()
    assert len(list(Path(shared_folder(spark)).glob("deskflow/scratch-*"))) == before
    assert first["intent_classification"]["eval_samples"] > 0
    stamp = spark.read.parquet(f"{folder}/splits").inputFiles()
    trained = spark.read.parquet(f"{folder}/model/index").inputFiles()
    run_all(p, folder, BRAND)
    assert spark.read.parquet(f"{folder}/splits").inputFiles() == stamp
    assert spark.read.parquet(f"{folder}/model/index").inputFiles() == trained
    assert spark.read.json(f"{folder}/training").first()["eval_samples"] > 0
    saved = scan_metrics(spark, f"{folder}/metrics").first()
    assert saved["reply_quality_judge"]["status"].startswith("Skipped")
    splits = spark.read.parquet(f"{folder}/splits")
    golden = spark.read.parquet(f"{folder}/golden")
    used = splits.filter("split <> 'test'").select("tweet")
    assert golden.join(used, "tweet").count() == 0
    # Other posts: everything is built again, the model too.
    scores = golden.select("tweet_id", *[F.lit(4).alias(f"human_{n}") for n in fixed.RUBRIC]).cache()
    scores.count()
    again = run_all(p.filter("tweet_id % 7 <> 1 OR author_id = 'Support'"), folder, BRAND, judge=True, human_scores=scores).first()
    assert spark.read.parquet(f"{folder}/splits").inputFiles() != stamp
    assert spark.read.parquet(f"{folder}/model/index").inputFiles() != trained
    assert again["reply_quality_judge"]["human_agreement"]["sample_size"] > 0
