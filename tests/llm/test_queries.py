"""The registered queries: DuckDB where SQL can express them, and the pipeline end to end."""

from __future__ import annotations

import hashlib
import zlib

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from ledgerstar.llm import line_dedup, ngram_join
from ledgerstar.llm.common import table
from ledgerstar.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.conftest import SF


def test_the_operators_and_the_pipeline_are_registered():
    held = registered.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in held) == 1 for i in range(1, 14))
    assert "pipeline" in held and set(ORACLES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_stages_decide_on_their_own_input(spark):
    """Every stage on what its predecessor kept, held against a plain statement of it."""
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_join", "decontaminate", "packing"]
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "line_dedup":
            assert set(after) == set(before)
            rows = spark.createDataFrame(list(before.items()), "doc_id long, text string")
            kept = {r.doc_id: r.kept_sha256 for r in line_dedup.digests(rows).collect()}
            assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in after.items()} == kept
        else:
            assert all(after[i] == before[i] for i in after)
        if name == "ngram_join":
            sets = {i: set(ngram_join.shingles(t).tolist()) for i, t in before.items()}
            for i in set(before) - set(after):
                near = [j for j in before if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
                assert near
            held = [sets[i] for i in after if sets[i]]
            assert not any(a is not b and len(a & b) >= 0.8 * len(a | b) for a in held for b in held)
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == set(before)


def test_the_held_out_fold_is_by_crc(spark):
    out = QUERIES["op2_toxicity"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
