"""One query per operator over its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from deskflow.functions.columns import compute_once
from deskflow.llm import (
    bpe, chat, decontaminate, language, licence, middle, periodic, pieces, repeats, simhash, sketch, tokencount, warc,
)
from deskflow.llm.common import table
from deskflow.sources.stage import stage


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op2_licences(spark: SparkSession, sf: str) -> DataFrame:
    found = licence.licences(table(spark, sf, "documents"))
    base = F.filter("places", lambda p: p["base"])

    def labels(places):
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))))

    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["first"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"))


def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    found = warc.archive(table(spark, sf, "pages"))
    return found.select(
        F.col("page").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest",
        F.col("type").alias("record_type"), "refers_to")


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op5_sketch(spark: SparkSession, sf: str) -> DataFrame:
    found = sketch.edited_fingerprints(table(spark, sf, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        sketch.as_text(F.col("sketch")).alias("fingerprint"),
        sketch.as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next", "kept_share",
        "n_shingles")


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    found = tokencount.token_counts(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


def op8_chat(spark: SparkSession, sf: str) -> DataFrame:
    spoken = "</s>[INST] ok [/INST]"
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(
        [(-1, 0, "user", spoken), (-1, 1, "assistant", spoken)], "conv_id long, turn long, role string, text string"))
    written = stage(chat.formatted(chat.turns_from_rows(rows)), "chat")
    return chat.read_back(written).withColumnRenamed("conv", "conv_id")


def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    found = bpe.encode_decode(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def op10_repeats(spark: SparkSession, sf: str) -> DataFrame:
    found = repeats.repeats(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed",
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op11_pieces(spark: SparkSession, sf: str) -> DataFrame:
    found = pieces.encode_decode(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op12_middle(spark: SparkSession, sf: str) -> DataFrame:
    found = middle.fill_in_middle(table(spark, sf, "documents"))
    back = middle.restored(F.col("form"), F.col("output"))
    return found.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
                        F.sha2(F.encode(back, "UTF-8"), 256).alias("restored_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents the words from one on repeat a stretch of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    split = compute_once(docs.select("doc_id", "text"), _words=words, _g=F.floor(h / 10))
    n, g = F.size("_words").cast("long"), F.col("_g")
    begin = g % n
    sized = compute_once(split, _a=F.when(n > 0, begin), _p=F.when(n > 0, 1 + F.floor((n - begin) / (3 + g % 8))))
    a, p = F.col("_a"), F.col("_p")
    repeated = F.transform("_words", lambda w, i: F.when(i < a, w).otherwise(F.get("_words", (a + (i - a) % p).cast("int"))))
    return sized.select("doc_id", F.when(a.isNull(), F.col("text")).otherwise(F.array_join(repeated, " ")).alias("text"))


def op13_periods(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.repeated_periods(with_planted_periods(table(spark, sf, "documents")))
    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # Runs come by start, then period, so the first of equal ones stays.
    best = F.aggregate("runs", nothing, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    named = compute_once(found, b=best)
    return named.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "b.start", "b.length", "b.period",
        F.expr("b.length * 1000 div b.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))


QUERIES = {"op1_decontaminate": op1_decontaminate, "op2_licences": op2_licences, "op3_warc": op3_warc,
           "op4_simhash": op4_simhash, "op5_sketch": op5_sketch, "op6_token_counts": op6_token_counts,
           "op7_language": op7_language, "op8_chat": op8_chat, "op9_bpe": op9_bpe, "op10_repeats": op10_repeats, "op11_pieces": op11_pieces,
           "op12_middle": op12_middle, "op13_periods": op13_periods}
