"""Document fingerprints: bottom-k sketches of shingle hashes (operator 5), with DataFrame functions only.

A shingle is five consecutive words (split at white space), hashed to 64 bits; a text of fewer words is one shingle, one
of none has no shingle.  The sketch of a text is the ``k`` smallest of its distinct hashes, in order.  The sketch of
several parts is that of their union, so sketches merge.  Two sketches estimate the resemblance of their texts (shared
among all shingles), the containment of one in the other, and each its number of distinct shingles.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

K = 128
_BLANK = " \t\n\x0b\f\r"


def sketch(text: Column, k: int = K, words: int = 5) -> Column:
    """Sketch of a text column; that of a null text is empty."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANK))
    parts = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"\s+"))

    def shingles(w: Column) -> Column:
        # A word beyond the end is null, and hashing passes over it: so a short text is one shingle.
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - words, F.lit(0))),
                           lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(words)]))

    # A one-element array holds the words, so that they are split once.
    hashes = F.flatten(F.transform(F.filter(F.array(parts), lambda w: F.size(w) > 0), shingles))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(rows: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """Sketch of all rows of each key: the k smallest distinct hashes, found by a limit per key and task first."""
    one = rows.select(*keys, F.explode(column).alias("_h"))
    order = Window.partitionBy(*keys).orderBy("_h")
    least = one.distinct().withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the k smallest hashes of both that are in both; 1 for two empty sketches, 0 for one."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        F.coalesce(F.try_divide(shared.cast("double"), F.size(both)), F.lit(0.0)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from how densely the hashes lie."""
    space = F.lit(float(1 << 64))
    share = (F.element_at(a, k).cast("double") + F.lit(float(1 << 63))) / space
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too: resemblance times union over a, at most 1."""
    union = distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as one string, 16 hexadecimal digits a hash."""
    return F.concat_ws("", F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))))


def with_next(docs: DataFrame, id_col: str, text_col: str, buckets: int | None = None) -> DataFrame:
    """(id, text, sketch, next_text, next_sketch): every row with the next one by falling id, the first after the last.

    Rows of one id follow each other by digest of the text, so the next of a repeated row is its copy; rows without id come
    last.  Rows are dealt to buckets of ids between quantiles, and the first row of a bucket is also sent to the bucket
    before it.  Texts are shuffled once; a bucket is ordered by itself, never the whole table.
    """
    spark = docs.sparkSession
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(
        "text"))
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n)).first()[0] if n > 1 else None
    cuts = sorted(set(cuts or []), reverse=True)
    # Bounds in two levels: first which group of them, then which of the group.
    width = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    key = F.md5("text")
    place = F.lit(0)
    if cuts:
        outer = F.array(*[F.lit(g[0]).cast("long") for g in groups])
        inner = F.array(*[F.array(*[F.lit(c).cast("long") for c in g]) for g in groups])
        past = F.size(F.filter(outer, lambda c: F.col("id").cast("long") <= c))
        place = F.when(past == 0, F.lit(0)).otherwise((past - 1) * width + F.size(
            F.filter(F.get(inner, past - 1), lambda c: F.col("id").cast("long") <= c)))
    # Rows without an id are spread by digest, in order.
    nowhere = F.lit(len(cuts) + 1) + F.conv(F.substring(key, 1, 2), 16, 10).cast("int")
    rows = rows.withColumn("key", key).withColumn("bucket", F.when(F.col("id").isNull(), nowhere).otherwise(place))

    # One row per bucket: at most a few times the number of partitions.
    falling = F.struct((-F.col("id") if dict(rows.dtypes)["id"] in ("double", "float") else F.expr("~id")).alias("o"), F.col(
        "key").alias("key"))
    heads = rows.groupBy("bucket").agg(F.min(F.struct(falling.alias("at"), F.col("id"))).alias("head"))
    around = Window.orderBy("bucket")
    heads = heads.select(
        F.col("head.id").alias("head_id"), F.col("head.at.key").alias("head_key"),
        F.coalesce(F.lag("bucket").over(around), F.max("bucket").over(
            around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("guarded"))
    sent = rows.join(F.broadcast(heads), rows["id"].eqNullSafe(F.col("head_id")) & (F.col("key") == F.col("head_key")), "left")
    sent = sent.select("id", "text", "key", F.explode(F.filter(F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guard")),
        F.struct(F.col("guarded").alias("bucket"), F.lit(True).alias("guard"))), lambda x: x["bucket"].isNotNull())).alias("x"))
    dealt = sent.select("id", "text", "key", "x.bucket", "x.guard").repartition("bucket")
    order = Window.partitionBy("bucket").orderBy("guard", F.col("id").desc_nulls_last(), "key")
    return dealt.withColumn("sketch", sketch(F.col("text"))).withColumn("next_text", F.lead("text").over(order)).withColumn(
        "next_sketch", F.lead("sketch").over(order)).where("NOT guard").select(
        "id", "text", "sketch", "next_text", "next_sketch")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        buckets: int | None = None) -> DataFrame:
    """(id, n_chars, edited, sketch, edited_sketch, near_edited, near_next, ...) of every row.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many (or all) of the next
    document.  A null text is an empty one.  An empty table gives no rows.
    """
    rows = with_next(docs, id_col, text_col, buckets).withColumn("n_chars", F.length("text").cast("long"))
    edited = rows.select("id", "n_chars", "sketch", "next_sketch", F.expr(
        "concat(substring(text, 1, int(n_chars - n_chars div 2)), substring(next_text, 1, int(n_chars div 2)))").alias(
        "edited"))
    edited = edited.withColumn("edited_sketch", sketch(F.col("edited")))
    return edited.select(
        "id", "n_chars", "edited", "sketch", "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("kept_share"),
        distinct_shingles(F.col("sketch")).alias("n_shingles"))
