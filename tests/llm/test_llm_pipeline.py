"""The pipeline's stages, each held against a plain version on its own input."""

from __future__ import annotations

import corpus_pipeline as P
from histlake.llm import op1_mixing, op7_quality_rules
from histlake.llm.common import saved, table
from tests.llm.test_llm_operators import brute_components, brute_passages, check_pieces

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    columns, stages = docs.columns, dict(P.STAGES)
    before = {r.doc_id: r for r in docs.collect()}

    docs = saved(stages["quality rules"](spark, docs, SF), "t")
    verdict = {r.doc_id: r.kept for r in op7_quality_rules.quality_rules(table(spark, SF, "documents")).collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(rows) == {d for d, k in verdict.items() if k}
    assert all(rows[d] == before[d] for d in rows) and 0 < len(rows) < len(before)

    want = {d: (len(gone), sum(gone)) for d, gone in brute_passages([(d, r.text) for d, r in rows.items()], 8, longest=3).items()}
    docs = saved(stages["line dedup"](spark, docs, SF), "t")
    after = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns
    assert set(after) == {d for d, (n, gone) in want.items() if gone == 0 or gone < n}
    assert all((after[d].text == rows[d].text) == (want[d][1] == 0) for d in after)
    assert all(after[d].n_chars == len(after[d].text) for d in after if want[d][1])

    groups = brute_components([(d, r.text) for d, r in after.items()])
    docs = saved(stages["n-gram join"](spark, docs, SF), "t")
    single = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(single) == {c for _, c in groups.values()}
    assert all(single[d] == after[d] for d in single)

    order = {r.doc_id: (r.position, r.place) for r in op1_mixing.schedule(docs, op1_mixing.WEIGHTS).collect()}
    out = stages["mixing"](spark, docs, SF)
    ids = [r.doc_id for r in out.collect()]
    assert out.columns == columns and ids == sorted(single, key=order.get)

    docs = saved(out, "t")
    pieces = [r.asDict() for r in stages["packing"](spark, docs, SF).collect()]
    check_pieces(pieces, {d: r.text for d, r in single.items()})


def test_run_is_the_stages_in_a_row(spark):
    names = [n for n, _ in P.STAGES]
    assert names == ["quality rules", "line dedup", "n-gram join", "mixing", "packing"]
    docs = table(spark, SF, "documents")
    for name, stage in P.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF), "t")
    want = {(r.doc_id, r.doc_tokens) for r in P.STAGES[-1][1](spark, docs, SF).collect()}
    assert {(r.doc_id, r.doc_tokens) for r in P.run(spark, SF).collect()} == want
