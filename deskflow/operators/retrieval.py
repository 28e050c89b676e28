"""Exact top-k search by cosine similarity.

Similarities are inner products of unit vectors, rounded to 6 decimals; equal ones rank by id.

Two plans with the same result, and one that may miss neighbours:

* ``topk_small``  The index fits a checked number of bytes: it is sent to all tasks once and the queries are
  scored where they are read.  No shuffle.
* ``topk_cells``  Approximate: an inverted file of cells, what is fetched being scored exactly.
* ``topk_large``  Any size of both sides.  The distinct vectors of queries and index are dealt to blocks of a bounded number of bytes, and every
  query block meets every index block in a task of its own, by a join on the number of the pair.  The k best per query
  of each meeting are merged.  Nothing passes through the driver and nothing is broadcast.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type

from deskflow import fixed
from deskflow.functions.kernels import best_rows, list_array, matrix_of, unit_rows
from deskflow.functions.vectors import norm
from deskflow.sources.stage import stage

SMALL_INDEX_BYTES = 64 * 1024 * 1024
BLOCK_BYTES = 16 * 1024 * 1024
_META = ("tweet", "apple_reply", "intent")


def index_bytes(index: DataFrame, vector: str, texts: tuple[str, ...] = ()) -> int:
    """Bytes of an index as doubles plus its texts, measured on the data."""
    text_bytes = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    measured = index.agg(F.sum(F.size(vector).cast("long") * 8 + 8 + text_bytes)).first()[0]
    return measured or 0


def topk_retrieve(
    queries: DataFrame,
    index: DataFrame,
    k: int = fixed.TOP_K,
    query_id: str = "query_id",
    index_id: str = "id",
    vector: str = "embedding",
    small_bytes: int = SMALL_INDEX_BYTES,
) -> DataFrame:
    """(query_id, rank, id, similarity): the k nearest index rows of each query, or all when fewer."""
    narrow_q = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("q_vector"))
    narrow_i = index.select(F.col(index_id).alias("id"), F.col(vector).alias("i_vector"))
    if index_bytes(narrow_i, "i_vector") <= small_bytes:
        return topk_small(narrow_q, narrow_i, k)
    return topk_large(narrow_q, narrow_i, k)


def _in_order(index: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """Ids and unit vectors of a table of checked size, by id."""
    table = index.toArrow().sort_by("id")
    return table.column("id").combine_chunks(), unit_rows(matrix_of(table.column("i_vector")))


def _nearest(shared, k: int, id_type: pa.DataType):
    """Arrow function from vectors to lists of their nearest index rows."""
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, rows = shared.value
        for batch in batches:
            places, scores = best_rows(unit_rows(matrix_of(batch)), rows, k)
            found = pa.StructArray.from_arrays(
                [ids.take(pa.array(places.ravel(), pa.int64())).cast(id_type), pa.array(scores.ravel(), pa.float64())],
                ["id", "similarity"])
            yield list_array(found, places.shape[1], len(batch))

    return nearest


def topk_small(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """Search in an index of checked size."""
    kind = index.schema["id"].dataType
    shared = index.sparkSession.sparkContext.broadcast(_in_order(index))
    nearest = arrow_udf(_nearest(shared, k, to_arrow_type(kind)), f"array<struct<id: {kind.simpleString()}, similarity: double>>")
    hits = queries.select("query_id", F.posexplode(nearest("q_vector")).alias("rank", "hit"))
    return hits.select("query_id", (F.col("rank") + 1).alias("rank"), "hit.id", "hit.similarity")


def _written(rows: DataFrame, vector: str, name: str = "search") -> DataFrame:
    """Rows with a number, in their order, and 128 bits of hash of their vector, which know equal vectors."""
    return stage(rows.select(
        "*", F.monotonically_increasing_id().alias("_row"), F.xxhash64(vector).alias("_h1"),
        F.xxhash64(F.lit(1), vector).alias("_h2")), name)


def _blocks(written: DataFrame, distinct: DataFrame, vector: str, block_bytes: int) -> int:
    """Number of blocks for the distinct vectors, whose width is that of any of them."""
    width = written.select(F.size(vector)).first()
    wide = 4 if written.schema[vector].dataType.elementType.typeName() == "float" else 8
    return max(1, math.ceil(distinct.count() * (wide * (width[0] if width else 0) + 16) / block_bytes))


class _Search:
    """Distinct vectors of both sides of a search, as ``_written``, scoring of pairs of blocks, and merging.

    Equal vectors are searched once, and of equal vectors of the index only the k lowest ids matter; both are grouped by
    narrow rows, limited before their shuffle, so a vector that most rows have is no heavier than others.
    """

    def __init__(self, asked: DataFrame, entries: DataFrame, k: int):
        self.k, self.kind, self.asked = k, entries.schema["id"].dataType, asked
        self.speakers = stage(self.asked.groupBy("_h1", "_h2").agg(F.min("_row").alias("asked")), "speakers")
        by_id = W.partitionBy("_h1", "_h2").orderBy(F.col("id").asc_nulls_last(), "_row")
        low = entries.select("_h1", "_h2", "id", "_row").withColumn("_n", F.row_number().over(by_id)).filter(F.col("_n") <= k)
        named = stage(low.groupBy("_h1", "_h2").agg(F.array_sort(F.collect_list(F.struct("_n", "_row", "id"))).alias("_all")).select(
            F.col("_all")[0]["_row"].alias("_row"), F.transform("_all", lambda e: e["id"]).alias("ids")), "named")
        self.sizes = (self.asked, self.speakers, "q_vector"), (entries, named, "i_vector")
        # (_row, q_vector) and (_row, i_vector, ids) of distinct vectors.
        self.left = self.asked.select("_row", "q_vector").join(self.speakers.select(F.col("asked").alias("_row")), "_row")
        self.right = entries.select("_row", "i_vector").join(named, "_row")

    def blocks(self, block_bytes: int) -> list[int]:
        return [_blocks(*side, block_bytes) for side in self.sizes]

    def found(self, left: DataFrame, right: DataFrame, tasks: int) -> DataFrame:
        """Hits of queries and index rows that have the same number ``pair``, which stands for a pair of blocks."""
        k, types, names = self.k, [pa.int64(), pa.list_(to_arrow_type(self.kind)), pa.float64()], ["asked", "ids", "similarity"]

        def meet(q: pa.Table, i: pa.Table) -> pa.Table:
            if not len(q) or not len(i):
                return pa.table([pa.array([], t) for t in types], names=names)
            i = i.append_column("first", pc.list_element(i.column("ids"), 0)).sort_by("first")
            places, scores = best_rows(unit_rows(matrix_of(q.column("q_vector"))), unit_rows(matrix_of(i.column("i_vector"))), k)
            taken = q.column("_row").take(pa.array(np.repeat(np.arange(len(q)), places.shape[1])))
            return pa.table([taken, i.column("ids").take(pa.array(places.ravel())).cast(types[1]), pa.array(scores.ravel())], names=names)

        # One task per pair of blocks, as far as hashing deals them out.
        left, right = (side.repartition(tasks, "pair").groupBy("pair") for side in (left, right))
        return left.cogroup(right).applyInArrow(meet, f"asked long, ids array<{self.kind.simpleString()}>, similarity double")

    def exact(self, block_bytes: int) -> DataFrame:
        """Hits of every block of queries in every block of the index."""
        n_asked, n_entries = self.blocks(block_bytes)

        def dealt(rows: DataFrame, own: int, other: int, pair) -> DataFrame:
            every = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("_other")
            block = F.pmod(F.xxhash64("_row"), F.lit(own)).cast("int").alias("_block")
            return rows.select("*", block, every).withColumn("pair", pair).drop("_block", "_other")

        left = dealt(self.left, n_asked, n_entries, F.col("_block") * n_entries + F.col("_other"))
        right = dealt(self.right, n_entries, n_asked, F.col("_other") * n_entries + F.col("_block"))
        return self.found(left, right, n_asked * n_entries)

    def ranked(self, found: DataFrame) -> DataFrame:
        """Of each distinct vector asked, the k best vectors, the one with the lower id first, then the k best of their ids."""
        best_first = W.partitionBy("asked").orderBy(F.desc("similarity"), F.col("ids")[0].asc_nulls_last())
        vectors = found.withColumn("_n", F.row_number().over(best_first)).filter(F.col("_n") <= self.k)
        one = vectors.select("asked", "similarity", F.explode("ids").alias("id"))
        return one.withColumn("rank", F.row_number().over(W.partitionBy("asked").orderBy(
            F.desc("similarity"), F.col("id").asc_nulls_last()))).filter(F.col("rank") <= self.k)

    def merged(self, found: DataFrame) -> DataFrame:
        """The hits of each query."""
        back = self.asked.select("query_id", "_h1", "_h2").join(self.speakers, ["_h1", "_h2"]).select("query_id", "asked")
        return back.join(self.ranked(found), "asked").select("query_id", "rank", "id", "similarity")


def _search(queries: DataFrame, index: DataFrame, k: int) -> _Search:
    return _Search(_written(queries.select("query_id", "q_vector"), "q_vector"),
                   _written(index.select("id", "i_vector"), "i_vector"), k)


def topk_large(queries: DataFrame, index: DataFrame, k: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Search in an index of any size; ``query_id`` names a query and is not null.

    Distinct vectors are dealt to blocks by a hash of their number.  Each side is sent once per block of the other, so
    bytes shuffled are those of a side times the blocks of the other.
    """
    search = _search(queries, index, k)
    return search.merged(search.exact(block_bytes))


def centres(rows: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of at most ``cells`` cells of unit rows."""
    found = rows[:cells].copy()
    for _ in range(rounds if len(rows) else 0):
        nearest = best_rows(rows, found, 1)[0][:, 0]
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, rows)
        found = unit_rows(np.where(np.any(sums, axis=1, keepdims=True), sums, found))
    return found


def probes_for(rows: np.ndarray, middles: np.ndarray, k: int, recall: float, asked: int = 256) -> int:
    """Cells to look into so that the ``asked`` first rows find that share of their k nearest among the others."""
    if len(rows) <= k:
        return len(middles)
    home = best_rows(rows, middles, 1)[0][:, 0]
    near = best_rows(rows[:asked], rows, k + 1)[0]
    turn = np.argsort(best_rows(rows[:asked], middles, len(middles))[0], axis=1)
    # When each true neighbour's cell has its turn; a row is no neighbour of its own.
    others = near != np.arange(len(near))[:, None]
    when = np.sort(np.take_along_axis(turn, home[near], axis=1)[others])
    return int(when[max(0, math.ceil(recall * len(when)) - 1)]) + 1


def topk_cells(queries: DataFrame, index: DataFrame, k: int, cells: int | None = None, probes: int | None = None,
               recall: float = 0.95, sample: int = 16384, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Approximate search: an inverted file of cells, of which each query looks into the ``probes`` nearest.

    What is fetched is scored exactly, so similarities and order are those of the exact plans; only neighbours in other
    cells are missed.  There are about as many cells as the root of the distinct vectors, at most 4,096.  Centres are fitted
    on a sample of ``sample`` rows, which is all that reaches the driver, and ``probes`` is what its first rows need to find
    the share ``recall`` of their neighbours in it: few cells where vectors lie in groups, most where they do not.  Every row
    of the index is put into a cell.  A cell of more than ``block_bytes`` on either side is split, and every part of its
    queries meets every part of its rows, so a hot cell is many tasks.
    """
    search = _search(queries, index, k)
    distinct = search.sizes[1][1].count()
    cells = cells or max(1, min(4096, math.isqrt(distinct)))
    few = search.right.orderBy(F.xxhash64("_row"), "_row").limit(sample).select("i_vector").toArrow()
    rows = unit_rows(matrix_of(few.column("i_vector")))
    middles = centres(rows, cells)
    cells = max(1, len(middles))
    probes = min(cells, probes or probes_for(rows, middles, k, recall))
    shared = queries.sparkSession.sparkContext.broadcast(middles)

    def nearest(n: int):
        @arrow_udf("array<int>")
        def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                places, _ = best_rows(unit_rows(matrix_of(batch)), shared.value, n)
                yield list_array(pa.array(places.ravel(), pa.int32()), places.shape[1], len(batch))

        return of

    left = stage(search.left.select("*", F.explode(nearest(probes)("q_vector")).alias("cell")), "asked-cells")
    right = stage(search.right.select("*", nearest(1)("i_vector")[0].alias("cell")), "index-cells")

    def parts(rows: DataFrame, vector: str, name: str) -> DataFrame:
        """How many parts each cell has on one side: one row a cell."""
        size = F.sum(F.size(vector).cast("long") * 8 + 16)
        return rows.groupBy("cell").agg(F.ceil(size / block_bytes).cast("int").alias(name))

    split = stage(parts(left, "q_vector", "n_q").join(parts(right, "i_vector", "n_i"), "cell"), "cell-parts")

    def dealt(rows: DataFrame, own: str, other: str, pair) -> DataFrame:
        block = F.pmod(F.xxhash64("_row"), own).cast("int").alias("_block")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("_other")
        return rows.join(split, "cell").select("*", block, every).withColumn("pair", F.struct("cell", *pair)).drop(
            "cell", "n_q", "n_i", "_block", "_other")

    found = search.found(dealt(left, "n_q", "n_i", ("_block", "_other")), dealt(right, "n_i", "n_q", (
        F.col("_other").alias("_block"), F.col("_block").alias("_other"))), max(1, cells))
    return search.merged(found)


def attach_metadata(hits: DataFrame, index: DataFrame, index_id: str = "id") -> DataFrame:
    """Add the texts of the neighbours to narrow search results."""
    meta = index.select(F.col(index_id).alias("id"), *_META)
    return hits.join(meta, "id").select("query_id", "rank", "id", "similarity", *_META)


def neighbour_lists(hits: DataFrame) -> DataFrame:
    """One row per query with its neighbours, best first (k rows per query)."""
    row = F.struct("rank", "similarity", *_META)
    listed = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    return listed.select("query_id", F.transform(
        "_rows", lambda r: F.struct(r["similarity"].alias("similarity"), *[r[c].alias(c) for c in _META])
    ).alias("retrieved_context"))


def retrieve_context(
    messages: DataFrame,
    index: DataFrame,
    k: int = fixed.TOP_K,
    vector: str = "embedding",
    small_bytes: int = SMALL_INDEX_BYTES,
) -> DataFrame:
    """Adds ``retrieved_context`` to each row, whatever its id: rows with equal ids, or none, are searched one by one."""
    texts = index.select(F.col("id"), F.col("embedding").alias("i_vector"), *_META)
    if index_bytes(texts, "i_vector", _META) > small_bytes:
        # Both are read several times from here on, and vectors are dear to write: once each.  Row numbers are written, so they
        # stay what they are; those of the index are in the order of the ids, which decides between equal similarities.
        numbered = _written(messages, vector, "messages")
        entries = _written(texts.orderBy(F.col("id").asc_nulls_last()), "i_vector", "entries")
        search = _Search(numbered.select(F.col("_row").alias("query_id"), F.col(vector).alias("q_vector"), "_row", "_h1", "_h2"),
                         entries.select(F.col("_row").alias("id"), "i_vector", "_row", "_h1", "_h2"), k)
        # Texts are gathered once per distinct vector; messages meet the list of theirs.
        hits = attach_metadata(search.ranked(search.exact(BLOCK_BYTES)).withColumnRenamed("asked", "query_id"), entries, "_row")
        lists = neighbour_lists(hits).withColumnRenamed("query_id", "asked").join(search.speakers, "asked").drop("asked")
        joined = numbered.join(lists, ["_h1", "_h2"], "left").drop("_h1", "_h2", "_row")
        return joined.withColumn("retrieved_context", F.coalesce("retrieved_context", F.array()))

    table = texts.toArrow().sort_by("id")
    meta = [table.column(c).combine_chunks() for c in _META]
    shared = messages.sparkSession.sparkContext.broadcast((unit_rows(matrix_of(table.column("i_vector"))), meta))

    @arrow_udf("array<struct<similarity: double, tweet: string, apple_reply: string, intent: string>>")
    def neighbours(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows, columns = shared.value
        for batch in batches:
            places, scores = best_rows(unit_rows(matrix_of(batch)), rows, k)
            taken = pa.array(places.ravel(), pa.int64())
            found = pa.StructArray.from_arrays(
                [pa.array(scores.ravel())] + [c.take(taken) for c in columns], ["similarity", *_META])
            yield list_array(found, places.shape[1], len(batch))

    return messages.withColumn("retrieved_context", neighbours(F.col(vector)))


def vector_audit(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows by vector width, and how many are of unit length within 1e-3."""
    unit = (F.abs(norm(F.col(vector)) - 1.0) < 1e-3).cast("int")
    return vectors.groupBy(F.size(vector).alias("width")).agg(
        F.count("*").alias("n"), F.sum(unit).alias("n_unit")
    )
