"""Each stage of the pipeline against a plain version, on a whole small table."""

from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline as pipeline
from auditlake.llm.oracles import ORACLES
from conftest import SMALL_DIR
from test_lines import without_short_copies
from test_minhash import brute as brute_groups

SHAPE = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs, seen = spark.read.parquet(f"{SMALL_DIR}/documents.parquet"), {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        before = docs.toPandas()
        stage(spark, docs, SMALL_DIR).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        seen[name] = before, docs.toPandas()
    return seen


def judged(rows, query):
    with duckdb.connect() as db:
        db.register("documents", rows)
        db.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SMALL_DIR}/benchmark.parquet')")
        return db.sql(ORACLES[query]).df().set_index("doc_id")


def plain(rows):
    return {r.doc_id: tuple(r[c] for c in SHAPE[1:]) for _, r in rows.iterrows()}


def test_quality(stages):
    before, after = stages["quality rules"]
    kept = judged(before, "op2_quality_rules").kept
    assert plain(after) == plain(before[before.doc_id.map(kept)]) and len(after) < len(before)


def test_lines(stages):
    before, after = stages["line dedup"]
    expected = without_short_copies(list(zip(before.doc_id, before.text, strict=True)))
    texts = dict(zip(before.doc_id, before.text, strict=True))
    kept = {i: t for i, t in expected.items() if t == texts[i] or t.strip()}
    assert dict(zip(after.doc_id, after.text, strict=True)) == kept and kept != texts
    assert (after.n_chars == after.text.str.len()).all()


def test_near_duplicates(stages):
    before, after = stages["near-duplicates"]
    groups = brute_groups(list(zip(before.doc_id, before.text, strict=True)), pipeline.SHINGLE)
    assert plain(after) == plain(before[[groups[i][2] for i in before.doc_id]])


def test_decontamination(stages):
    before, after = stages["decontamination"]
    hit = judged(before, "op6_decontaminate").contaminated
    assert plain(after) == plain(before[~before.doc_id.map(hit)]) and len(after) < len(before)


def test_mixing(stages):
    before, after = stages["mixing"]
    sizes = {r.doc_id: len(r.text.split()) for r in before.itertuples()}
    taken, target = defaultdict(int), {}
    for r in after.itertuples():
        assert 0 < r.taken <= 2 * r.size and r.size == sizes[r.doc_id]
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= max(32, 0.05 * target[s]) for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1


def test_run_is_the_stages(stages, spark):
    rows = pipeline.run(spark, SMALL_DIR).toPandas()
    expected = stages["mixing"][1]
    key = ["doc_id", "taken"]
    assert sorted(map(tuple, rows[key].values)) == sorted(map(tuple, expected[key].values))
