"""A corpus pipeline of five stages over documents; each stage works on what its predecessor kept.

1. toxicity: documents that the classifier rejects go.
2. simhash_near_dedup: one document of each group of near copies stays (the one with the smallest doc_id): those whose
   fingerprints link as in operator 3, and those of 0.8 similarity or more in five-word shingles.
3. substring_dedup: words of 50-word windows that an earlier document has go; a document left without words goes too.
4. decontamination: documents with phrases of two or more benchmark items go; hit words of others are cut out.
5. bpe: the texts' ids and what they decode to.

Every stage's rows are written as Parquet to the shared scratch folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.llm import bpe, decontam, simhash, substring, toxicity
from foliograph.llm.common import discard_since, fresh, keep, mark, table
from foliograph.llm.queries import tokenizer_file


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_similar(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # a text that loses all its words becomes empty; one that had none stays as it was
    had, has = fresh(docs, "had_words"), F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return substring.remove_repeats(docs.withColumn(had, has)).where(~F.col(had) | has).drop(had)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: Toxicity scores, SimHash components and BPE are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    start = mark()
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
        discard_since(start, docs)  # the stage's scratch tables and its input
    return docs
