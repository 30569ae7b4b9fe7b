"""A corpus from raw documents to packed windows, stage by stage.

Each stage reads what its predecessor stored, works on all of it and returns
what it keeps; all but the last return the columns of ``documents``.

1. quality rules: rejected documents go.
2. line dedup: later runs of repeated lines (3 lines, or 8 words in fewer) go; a
   document that loses all its lines that way goes too, ``n_chars`` follows the text.
3. n-gram join: of each group of similar documents the smallest doc_id stays.
4. mixing: all documents, stored in the mixed order.
5. packing: windows of 2048 ids in stored order, one row per piece.

A rejected or removed doc_id takes all rows of that doc_id with it.  Null and
empty texts fall to the quality rules (fewer than 50 words); rows without a
doc_id are judged each by its text and stay in the join; rows of one doc_id
that differ are all kept or all go; ties are settled as the operators state.
An empty table gives no windows.  Columns beyond those of ``documents`` are
dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.llm import op1_mixing, op4_packing, op5_line_dedup, op7_quality_rules, op9_ngram_join
from histlake.llm.common import saved, table
from histlake.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_quality_rules.keep_good(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = op5_line_dedup.dedup_lines(docs.select(*COLUMNS))
    kept = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).select(*COLUMNS)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_ngram_join.keep_one_each(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_mixing.mixed(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_packing.pack(docs, tokenizer_path(), with_ids=False)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram join", ngram_join),
          ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Outlier estimates, schedules and packing are not SQL; tests hold the
#: stages against brute force.
ORACLE_SQL = None
