"""Odd rows through every operator on documents: null and repeated ids, null
sources, clashing columns, empty tables."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as P
from histlake.llm import (op1_mixing, op2_run_length_index, op4_packing, op5_line_dedup, op6_substring_dedup, op7_quality_rules,
                          op8_quality_gam, op9_ngram_join, op10_url_filter)
from histlake.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: extra columns under names that the operators use inside
CLASH = DOCS + (", block int, position long, mix_source string, doc_key long, pos binary, kept boolean, score double, label double"
                ", sequence_id long, component_id long, grp string, n int")


def rows_of(rng):
    line = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    text = [line(120) for _ in range(5)]
    out = [(i, text[i % 5] if i % 3 else line(90), "en", f"src{i % 3}") for i in range(40)]
    out += [(None, text[0], "en", None), (None, text[0], "en", None), (None, line(70), None, ""), (None, None, "de", "src1"),
            (7, text[1], "en", "src0"), (7, line(60), "en", "src0"), (7, line(60), None, None), (3, "", "en", "src2"), (3, None, "en", "src2")]
    return [(d, t, lang, s, len(t or "")) for d, t, lang, s in out]


@pytest.fixture(scope="module")
def rows():
    return rows_of(random.Random(4))


@pytest.fixture(scope="module")
def odd(spark, rows):
    more = len(CLASH.split(",")) - 5
    return spark.createDataFrame([(*r, *[None] * more) for r in rows], CLASH)


def ids(df, name="doc_id"):
    return sorted((r[name] is not None, r[name] or 0) for r in df.collect())


def test_every_operator_gives_each_row_its_result(spark, rows, odd):
    want = sorted((r[0] is not None, r[0] or 0) for r in rows)
    assert ids(op1_mixing.schedule(odd, op1_mixing.WEIGHTS)) == want
    mixed = op1_mixing.mixed(odd)
    assert ids(mixed) == want and mixed.columns == odd.columns
    out = op2_run_length_index.dedup_strings(odd, with_text=False).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in out) == want
    assert all(r.n_removed == 0 for r in out if r.doc_id is None)           # nothing is smaller than no id
    for dedup in (op5_line_dedup.dedup_lines, op6_substring_dedup.dedup_units):
        assert ids(dedup(odd)) == want
    assert ids(op7_quality_rules.quality_rules(odd)) == want
    assert ids(op9_ngram_join.similar_groups(odd)) == want


def test_packing_keeps_every_row(spark, rows, odd):
    pieces = op4_packing.pack(odd, tokenizer_path(), with_ids=False).collect()
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
    assert sum(r.start == 0 for r in pieces) == len(rows)
    assert {r.doc_id for r in pieces} == {r[0] for r in rows}


def test_classifier_scores_every_row(spark, rows, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(None, 1, 0), (7, 1, 0), (9, None, 0)],
                                   "doc_id long, quality int, toxic int")
    out = op8_quality_gam.quality_scores(odd, labels)
    assert ids(out) == sorted((r[0] is not None, r[0] or 0) for r in rows)
    assert out.where("score < 0 or score > 1 or score is null or (doc_id is null and held_out)").count() == 0


def test_null_source_is_not_the_empty_source(spark):
    rng = random.Random(6)
    line = lambda w, n: " ".join(f"{w}{rng.randrange(900)}" for _ in range(n))
    n = op7_quality_rules.MIN_GROUP
    # two groups that differ in word length: each is plain by itself
    rows = [(i, line("w", 100), "en", None, 0) for i in range(n)] + [(n + i, line("verylongwordinthis", 100), "en", "", 0) for i in range(n)]
    out = op7_quality_rules.quality_rules(spark.createDataFrame(rows, DOCS))
    assert out.where("kept").count() == 2 * n


def test_pages_without_id(spark):
    pages = spark.createDataFrame([(None, "http://www.spam-x.example.org/a", "", None), (1, None, None, "k"), (1, "no", "", None),
                                   (2, "http://casino.net", "", None)], "page_id long, url string, html string, entry string")
    blocked = op10_url_filter.junk_hosts(pages)
    assert sorted(r.entry for r in blocked.collect()) == ["casino.net", "spam-x.example.org"]
    out = op10_url_filter.judge_urls(pages, blocked).collect()
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in out) == [
        (0, "www.spam-x.example.org", "allow"), (1, "", "allow"), (1, "", "allow"), (2, "casino.net", "block")]


def test_hosts_are_junk_by_whole_words(spark):
    hosts = ["ads.example.com", "www.best-ads-now.example.com", "loads.example.com", "adsx.example.com", "x.cheap-pills.co", "pills", "a.b-poker"]
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "page_id long, url string")
    assert sorted(r.entry for r in op10_url_filter.junk_hosts(pages).collect()) == [
        "ads.example.com", "best-ads-now.example.com", "cheap-pills.co"]


def test_stages_keep_columns_and_odd_rows(spark, rows, odd):
    stages = dict(P.STAGES)
    docs = stages["quality rules"](spark, odd, "")
    assert docs.columns == P.COLUMNS
    for name in ("line dedup", "n-gram join", "mixing"):
        out = stages[name](spark, odd, "")
        assert out.columns == P.COLUMNS and 0 < out.count() <= len(rows)
    # no id is no node to be dropped for
    assert stages["n-gram join"](spark, odd, "").where("doc_id is null").count() == 4
    assert stages["packing"](spark, odd, "").count() >= len(rows)


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], CLASH)
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == P.COLUMNS and docs.count() == 0
    assert P.STAGES[-1][1](spark, docs, "").count() == 0


