"""From raw documents to packed training sequences, in five stages.

1. language: documents whose language cannot be told go (no letter, or no clear language); a missing
   ``lang`` is filled with the prediction.
2. near copies: of each component of five-word shingle sets with similarity 0.8 or more, one row stays: of
   the smallest id (a null id only if there is no other), then of the smallest text hash.
3. repeated passages: windows of 13 words that an earlier document holds are cut out; a document with no
   word left goes; ``n_chars`` follows the text.
4. benchmark: documents that leak a test item go.
5. packing: what is left is tokenised and packed into sequences of 4096 ids; a piece's row holds its ids (four bytes
   each, lowest first), so a sequence is its pieces' ids by ``offset``.

A stage takes (spark, docs, sf_dir) and returns a frame; :func:`run` writes each one as Parquet in the
shared scratch folder and rereads it as the next stage's ``docs``, so a lost executor costs one stage at
most.  All stages but the last return the columns of ``documents``; other columns are left behind.
An id may repeat and be null: rows are judged by id and text.  Of rows equal in both, the one with the
smallest ``lang``, ``source`` and ``n_chars`` (nulls first) stands for all.  Texts without a word stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairsketch.llm import blocks, decontam, jaccard, langid, packing, substrings
from fairsketch.llm.queries import table, vocabulary
from fairsketch.session import remove_path, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_LANGUAGE_SCORE = 0.3
WORDS, PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    blocks.small_batches(spark)
    docs = docs.select(*COLUMNS)
    scored = langid.identify(docs, langid.train(docs), others=("lang", "source", "n_chars"))
    return scored.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)) \
        .withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    blocks.small_batches(spark)
    docs = docs.select(*COLUMNS)
    found = jaccard.jaccard_components(docs, WORDS, PERCENT, keyed=True).where("component is not null") \
        .groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("n")).checkpoint()
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    least = found.groupBy("component").agg(F.min(key).alias("least"))
    # null-safe: a null id is a key like others
    found = found.join(least, "component").withColumn("stays", key.eqNullSafe(F.col("least")))
    others = found.where("not stays or n > 1").select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_text"))
    repeated = found.where("stays and n > 1").select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_text"))
    hashed = docs.withColumn("text_hash", F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_text"))
    once = hashed.join(repeated, same, "left_semi").groupBy("doc_id", "text").agg(
        F.min(F.struct("lang", "source", "n_chars")).alias("rest")).select("doc_id", "text", "rest.*")
    return hashed.join(others, same, "left_anti").select(*COLUMNS).unionByName(once.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.substring_dedup(docs.select(*COLUMNS), others=("lang", "source"))
    return cut.where("n_removed < n_words or n_words = 0").withColumnRenamed("kept_text", "text") \
        .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, vocabulary(), payload=True))


STAGES = [("language", language), ("near copies", near_copies), ("repeated passages", repeated_passages),
          ("benchmark", benchmark), ("packing", packed)]

#: Trained networks, components and packing cannot be stated in SQL; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` with their ids; every stage's files are removed once the next stage is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    out = STAGES[-1][1](spark, docs, sf_dir)  # its pieces are checkpointed, so the files are read by now
    remove_path(spark, before)
    return out
