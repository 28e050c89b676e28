"""A training corpus from the documents table: each stage is written as Parquet and read by the next one."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from deskflow.functions.columns import compute_once
from deskflow.llm import bpe, decontaminate, language, repeats, simhash
from deskflow.llm.common import table
from deskflow.sources.stage import new_path, scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; those without text or without a letter go.

    A missing language is filled in.  Profiles are learned from the labelled documents that are not held out; where these
    teach none, a missing language stays missing.
    """
    learned = language.profiles(docs.where(~language.held_out(F.col("doc_id"))))
    if not learned:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    # Once for the filter and the column.
    named = compute_once(docs, _language=language.predicted(F.col("text").cast("string"), learned)["lang"])
    told = named.where(F.col("_language") != language.UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", "_language")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints (three-word shingles) are linked by two differing bits or fewer."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long passages that stand elsewhere too."""
    return repeats.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have no window of a benchmark item; one without text or words has none, so it stays."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every document, and the digest of what they decode to."""
    import public_tokenizers

    # Python workers live on through the stages, so they remember fewer words than by default.
    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), cache_rows=1 << 17)
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("language", identify_language), ("near_duplicates", drop_near_duplicates), ("repeats", cut_repeats),
          ("decontaminate", drop_contaminated), ("tokenize", tokenize)]

# SQL can express neither the hashes of the fingerprints nor the merges of the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, one after another; what a stage writes for itself goes when it is done."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return run(spark, sf)


QUERIES = {"pipeline": pipeline}
