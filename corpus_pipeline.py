"""From raw documents to packed training sequences.

Each stage takes what the one before kept, as Parquet:

1. quality rules: documents that they reject go,
2. n-gram Jaccard join: of each group of near-duplicates the smallest id stays,
3. suffix-array dedup: passages that stand earlier are cut out of the texts,
4. best-fit packing: the ids of what is left, in sequences.

Stages 1 to 3 return the columns of their input, whatever their names. Edge
cases: a null or empty text is rejected by stage 1; a null id is kept, counts
as the largest, and decisions are by row, so of repeated rows one stays (stages
2 and 3); ties go to the row read first; texts of any length are read whole; an
empty table gives an empty result. ``n_chars``, if there, is set anew where
texts are cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.best_fit_packing import best_fit_packing
from surveyloom.llm.ngram_join import keep_one_of_each
from surveyloom.llm.quality_rules import keep_good
from surveyloom.llm.repeat_removal import cut_repeats
from surveyloom.llm.tables import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = cut_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast(left.schema["n_chars"].dataType)) if "n_chars" in left.columns else left


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs)


STAGES = [("quality_rules", quality), ("ngram_join", near_duplicates), ("suffix_array_dedup", repeats), ("best_fit_packing", packing)]

#: Compression, tries and packing have no form in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
