import numpy as np
import pytest
from pyspark.sql import functions as F

from deskflow.functions import kernels
from deskflow.operators import retrieval
from deskflow.queries import QUERIES


def frame(spark, m, id_name, vec_name):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, f"{id_name} long, {vec_name} array<float>")


def brute_force(q, m, k):
    unit = lambda a: a / np.where(np.linalg.norm(a, axis=1, keepdims=True) > 0, np.linalg.norm(a, axis=1, keepdims=True), 1)
    s = np.round(unit(q.astype("f8")) @ unit(m.astype("f8")).T, 6)
    out = set()
    for i, row in enumerate(s):
        for rank, j in enumerate(sorted(range(len(m)), key=lambda j: (-row[j], j))[:k], 1):
            out.add((i, rank, j, round(float(row[j]), 5)))
    return out


def rows(df):
    return {(r["query_id"], r["rank"], r["id"], round(r["similarity"], 5)) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    m = np.vstack([c + 0.05 * rng.normal(size=(40, 16)) for c in centres]).astype("f4")
    # A third of the index is copies of one vector.
    m = np.vstack([m, np.repeat(m[:1], 240, axis=0)]).astype("f4")
    q = np.vstack([centres + 0.05 * rng.normal(size=(12, 16)), np.zeros((1, 16)), rng.normal(size=(20, 16))]).astype("f4")
    return q, m


@pytest.mark.parametrize("k", [1, 5, 1000])
@pytest.mark.parametrize("block_bytes", [1 << 26, 4000])
def test_small_and_large_equal_brute_force(spark, data, k, block_bytes):
    q, m = data
    queries, index = frame(spark, q, "query_id", "q_vector"), frame(spark, m, "id", "i_vector")
    expected = brute_force(q, m, k)
    assert rows(retrieval.topk_small(queries, index, k)) == expected
    assert rows(retrieval.topk_large(queries.repartition(2), index.repartition(3), k, block_bytes)) == expected
    back = retrieval.topk_large(
        index.withColumnsRenamed({"id": "query_id", "i_vector": "q_vector"}),
        queries.withColumnsRenamed({"query_id": "id", "q_vector": "i_vector"}), k, 3 * block_bytes)
    assert rows(back) == brute_force(m, q, k)


def test_nothing_passes_through_the_driver(spark, data, monkeypatch):
    """Blocks meet in a join on their number, whatever their size; all the driver sees is two measured sizes."""
    q, m = data
    queries, index = frame(spark, q, "query_id", "q_vector"), frame(spark, m, "id", "i_vector").repartition(4)
    fetched = []
    collect = type(queries).collect
    monkeypatch.setattr(type(queries), "toArrow", None)
    monkeypatch.setattr(type(queries), "collect", lambda df: fetched.append(collect(df)) or fetched[-1])
    # Spark's own choice for small joins is put aside.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = retrieval.topk_large(queries, index, 2, 4000)
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.undo()
    assert max(len(r) for r in fetched) == 1
    assert "FlatMapCoGroupsInArrow" in text and "Broadcast" not in text and "Cartesian" not in text
    assert found.count() == 2 * len(q)


def test_cells(spark, data):
    """All cells probed: exact, also with hot cells split on both sides.  A few: what is found is scored exactly."""
    q, m = data
    queries, index = frame(spark, q, "query_id", "q_vector"), frame(spark, m, "id", "i_vector")
    exact = brute_force(q, m, 5)
    for block_bytes in (1 << 20, 1500):
        assert rows(retrieval.topk_cells(queries, index, 5, cells=6, probes=6, block_bytes=block_bytes)) == exact
    near = rows(retrieval.topk_cells(queries.filter("query_id < 12"), index, 5, cells=24, probes=3, sample=100))
    right = {(a, c, d) for a, _, c, d in exact if a < 12}
    assert len({(a, c, d) for a, _, c, d in near} & right) >= 0.9 * len(right)
    similar = {(a, c): d for a, _, c, d in brute_force(q, m, len(m))}
    assert all(abs(similar[a, c] - d) < 1e-9 for a, _, c, d in near)
    assert retrieval.topk_cells(queries, index.filter("false"), 5).count() == 0


def test_recall_on_the_given_vectors(spark):
    """At least 0.9 of the true neighbours of every fiftieth vector, with the settings of the query."""
    sf = "/root/testdata/sf0.1"
    got = {(r["query_id"], r["id"]) for r in QUERIES["topk_retrieve_lsh"](spark, sf).collect()}
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    exact = retrieval.topk_retrieve(e.filter("vec_id % 50 = 0"), e, query_id="vec_id", index_id="vec_id")
    want = {(r["query_id"], r["id"]) for r in exact.collect()}
    print("recall", len(got & want) / len(want), len(want))
    assert len(want) > 100 and len(got & want) >= 0.9 * len(want)


def test_rows_of_one_vector(spark):
    """Two thirds of the index and of the queries have one id and vector."""
    same = spark.range(600).selectExpr("if(id < 400, 7, id) AS id", "if(id < 400, array(1f, 0f), array(1f, float(id))) AS i_vector")
    queries = same.selectExpr("id AS query_id", "i_vector AS q_vector").filter("query_id IN (7, 500)")
    got = retrieval.topk_large(queries, same.repartition(3), 3, 200).groupBy("query_id", "rank", "id").count().collect()
    assert {tuple(r) for r in got if r["query_id"] == 7} == {(7, 1, 7, 400), (7, 2, 7, 400), (7, 3, 7, 400)}
    assert {r["rank"]: r["count"] for r in got if r["query_id"] == 500} == {1: 1, 2: 1, 3: 1}


@pytest.mark.parametrize("n, dim, k", [(1, 3, 5), (50, 8, 1), (9000, 6, 7), (5000, 300, 5), (300, 1, 4)])
def test_kernel_equals_double_precision(n, dim, k):
    """Many near ties: vectors of small whole numbers, in copies, and nearly equal ones."""
    rng = np.random.default_rng(n)
    index = rng.integers(-1, 2, (n, dim)).astype(float) + 1e-7 * rng.normal(size=(n, dim)) * (rng.random((n, 1)) < 0.3)
    index[n // 3:2 * n // 3] = index[0]
    queries = np.vstack([index[rng.integers(0, n, 300)], rng.normal(size=(30, dim)), np.zeros((1, dim))])
    queries, index = kernels.unit_rows(queries), kernels.unit_rows(index)
    places, scores = kernels.best_rows(queries, index, k)
    all_scores = np.rint(queries @ index.T * 1e6)
    want = np.argsort(-all_scores, axis=1, kind="stable")[:, :k]
    mine = np.take_along_axis(all_scores, places, axis=1)
    assert (np.abs(mine - np.take_along_axis(all_scores, want, axis=1)) <= 1).all()
    # Where no product lies at a half, places are equal.
    clear = (np.abs(np.abs(queries @ index.T * 1e6 % 1) - 0.5) > 1e-3).all(axis=1)
    assert (places[clear] == want[clear]).all() and clear.any()
    assert np.allclose(scores * 1e6, mine, atol=1.1)


@pytest.mark.parametrize("kind", ["string", "double", "date"])
def test_ids_of_any_type(spark, data, kind):
    q, m = data
    queries, index = frame(spark, q, "query_id", "q_vector"), frame(spark, m, "id", "i_vector")
    as_kind = {"string": F.format_string("n%06d", "id"), "double": F.col("id") / 2.0,
               "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))}[kind]
    named = index.withColumn("id", as_kind)
    names = {r[0]: r[1] for r in index.select(F.col("id").alias("number"), as_kind.alias("id")).collect()}
    want = {(a, b, names[c], d) for a, b, c, d in brute_force(q, m, 3)}
    assert rows(retrieval.topk_small(queries, named, 3)) == want
    assert rows(retrieval.topk_large(queries, named.repartition(3), 3, 2000)) == want


def test_empty_index(spark, data):
    queries = frame(spark, data[0], "query_id", "q_vector")
    index = frame(spark, data[1], "id", "i_vector").filter("false")
    assert retrieval.topk_small(queries, index, 5).count() == 0
    assert retrieval.topk_large(queries, index, 5).count() == 0


def test_choice_by_measured_size(spark, data):
    q, m = data
    queries = frame(spark, q, "query_id", "embedding")
    index = frame(spark, m, "id", "embedding")
    small = retrieval.topk_retrieve(queries, index, 3)
    large = retrieval.topk_retrieve(queries, index, 3, small_bytes=1000)
    assert rows(small) == rows(large)
    assert "ArrowEvalPython" in small._jdf.queryExecution().executedPlan().toString()
    assert "Window" in large._jdf.queryExecution().executedPlan().toString()


def test_context_lists_agree(spark, data):
    q, m = data
    messages = frame(spark, q, "message_id", "embedding")
    index = frame(spark, m, "id", "embedding").withColumns({
        "tweet": F.concat(F.lit("t"), F.col("id")), "apple_reply": F.lit("r"), "intent": F.lit("i")})
    # Messages that share an id, and one without: each is searched by itself.
    messages = messages.withColumn("message_id", F.nullif(F.col("message_id") % 5, F.lit(3)))
    found = [sorted(((r["message_id"], [tuple(x) for x in r["retrieved_context"]]) for r in df.collect()), key=repr) for df in (
        retrieval.retrieve_context(messages, index, 4),
        retrieval.retrieve_context(messages, index.repartition(3), 4, small_bytes=1000))]
    assert found[0] == found[1] and len(found[0]) == len(q)
    assert all(len(v) == 4 for _, v in found[0])
    # Index rows that share an id stay rows of their own.
    shared = index.withColumn("id", F.floor(F.col("id") / 2))
    a, b = ({str(r) for r in retrieval.retrieve_context(messages, shared, 1000, small_bytes=n).select(
        F.size("retrieved_context")).collect()} for n in (1 << 26, 1000))
    assert a == b == {f"Row(size(retrieved_context)={len(m)})"}


def test_context_writes_vectors_once_and_lists_once_per_vector(spark, monkeypatch):
    """Beyond the bound: one table with vectors a side; texts are listed for the four distinct vectors; repeated and null ids."""
    index = spark.range(300).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") / 2).cast("long")).alias("id"),
        F.array(*[((F.col("id") * p) % 7 + 1).cast("float") for p in (1, 3, 5)]).alias("embedding"),
        F.concat(F.lit("q"), "id").alias("tweet"), F.lit("a").alias("apple_reply"), F.lit("i").alias("intent"))
    index = index.dropDuplicates(["id"]).filter("id IS NOT NULL")
    asked = spark.range(400).select(
        F.when(F.col("id") % 9 != 0, F.col("id") % 20).alias("m"),
        F.array(*[((F.col("id") % 5 * p) % 4 + 1).cast("float") for p in (1, 2, 3)]).alias("embedding")).repartition(5)
    want = sorted(map(str, retrieval.retrieve_context(asked, index, 3).collect()))
    written, lists, write, listed = [], [], retrieval.stage, retrieval.neighbour_lists

    def seen(rows, name):
        written.extend([name] if any(t.startswith("array<float") for _, t in rows.dtypes) else [])
        return write(rows, name)

    def counted(hits):
        lists.append(hits.count())
        return listed(hits)

    monkeypatch.setattr(retrieval, "stage", seen)
    monkeypatch.setattr(retrieval, "neighbour_lists", counted)
    got = retrieval.retrieve_context(asked, index, 3, small_bytes=0)
    assert sorted(map(str, got.collect())) == want and got.columns == ["m", "embedding", "retrieved_context"]
    assert sorted(written) == ["entries", "messages"] and lists == [3 * 4]
    assert [r["retrieved_context"] for r in retrieval.retrieve_context(asked.limit(2), index.limit(0), 3, small_bytes=-1).collect()] == [[], []]
