"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from histlake.llm import op1_mixing, op2_run_length_index, op3_topk_pivots, op4_packing, op5_line_dedup
from histlake.llm import op6_substring_dedup, op7_quality_rules, op8_quality_gam, op9_ngram_join, op10_url_filter
from histlake.llm import op11_whitening, op12_site_trees, op13_hard_negatives
from histlake.llm.common import table
from histlake.llm.oracle import LINE_DEDUP, LINE_PASSAGES, NGRAM_JOIN, STRING_DEDUP, SUBSTRING_DEDUP


def tokenizer_path(name: str = op4_packing.VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def q_mixing(spark, sf_dir):
    """All documents with their block's release, deadline and slot, and their place in the mix."""
    return op1_mixing.schedule(table(spark, sf_dir, "documents"), op1_mixing.WEIGHTS)


def q_run_length_index(spark, sf_dir):
    """Every byte under a 50-byte string of an earlier document removed."""
    return op2_run_length_index.dedup_strings(table(spark, sf_dir, "documents"), with_text=False)


def q_topk_pivots(spark, sf_dir):
    """The five best inner products of every 50th vector against all others."""
    return op3_topk_pivots.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def q_packing(spark, sf_dir):
    """All documents cut into windows of 2048 ids."""
    return op4_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def _line_report(spark, sf_dir, min_words):
    out = op5_line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_words)
    return out.select("doc_id", "n_lines", "n_removed", F.size("runs").cast("long").alias("n_runs"), "kept_sha256")


def q_line_dedup(spark, sf_dir):
    """Later runs of repeated lines (3 lines, or 8 words in fewer) removed;
    counts and digest per document."""
    return _line_report(spark, sf_dir, op5_line_dedup.MIN_WORDS)


def q_line_runs(spark, sf_dir):
    """As q_line_dedup, for runs of 3 lines or more only."""
    return _line_report(spark, sf_dir, None)


def q_substring_dedup(spark, sf_dir):
    """Later lines and sentences removed; their original byte offsets."""
    return op6_substring_dedup.report(table(spark, sf_dir, "documents"))


def q_quality_rules(spark, sf_dir):
    """Counts, base rules and the outlier verdict of every document."""
    return op7_quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def q_quality_gam(spark, sf_dir):
    """Quality score of every document."""
    return op8_quality_gam.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_ngram_join(spark, sf_dir):
    """Shingle count and component of every document."""
    return op9_ngram_join.similar_groups(table(spark, sf_dir, "documents"))


def q_url_filter(spark, sf_dir):
    """Rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages")
    return op10_url_filter.judge_urls(pages, op10_url_filter.junk_hosts(pages))


def q_whitening(spark, sf_dir):
    """The first 16 whitened components of every embedding."""
    return op11_whitening.whiten(table(spark, sf_dir, "embeddings"))


def q_main_text(spark, sf_dir):
    """The main text of every page."""
    return op12_site_trees.extract_main_text(table(spark, sf_dir, "pages"))


def q_hard_negatives(spark, sf_dir):
    """Hard negatives of every 100th vector; every 7th has its label moved on."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op13_hard_negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_pfair_mixing": q_mixing,
    "op2_run_length_index": q_run_length_index,
    "op3_topk_pivots": q_topk_pivots,
    "op4_window_packing": q_packing,
    "op5_line_winnowing": q_line_dedup,
    "op5_line_passages": q_line_dedup,
    "op5_line_runs": q_line_runs,
    "op6_unit_hashing": q_substring_dedup,
    "op7_quality_outliers": q_quality_rules,
    "op8_quality_gam": q_quality_gam,
    "op9_ngram_join": q_ngram_join,
    "op10_url_digests": q_url_filter,
    "op11_qdwh_whitening": q_whitening,
    "op12_site_style_trees": q_main_text,
    "op13_one_bit_negatives": q_hard_negatives,
}

ORACLE = {
    "op2_run_length_index": STRING_DEDUP,
    "op3_topk_pivots": op3_topk_pivots.ORACLE,
    "op5_line_winnowing": LINE_PASSAGES,
    "op5_line_passages": LINE_PASSAGES,
    "op5_line_runs": LINE_DEDUP,
    "op6_unit_hashing": SUBSTRING_DEDUP,
    "op9_ngram_join": NGRAM_JOIN,
    "op10_url_digests": op10_url_filter.ORACLE,
    "op12_site_style_trees": op12_site_trees.ORACLE,
    "op13_one_bit_negatives": op13_hard_negatives.ORACLE,
}
