"""Near-duplicates against all pairs, on whole small tables."""

from __future__ import annotations

import re

import pytest

from auditlake.llm import minhash
from conftest import SMALL_DIR


def brute(rows, shingle):
    """Component of each id, from every pair of texts."""
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(shingle, len(words))
        sets[doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("shingle", [2, 5])
def test_whole_small_table_equals_all_pairs(spark, shingle):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, shingle).collect()}
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()], shingle)


def chain(n, step):
    """Texts of 60 words, each with ``step`` more words replaced than the one before."""
    words = [f"w{i}" for i in range(60)]
    for k in range(n):
        for j in range(step):
            words[(7 * k + j) % 60] = f"x{k}-{j}"
        yield " ".join(words)


def test_chains_and_odd_rows(spark):
    texts = [*chain(40, 2), "One", "one", "", None, " \n\t", "a b", "A\tB", "é É", "same same same", "same same"]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 2).collect()}
    assert found == brute(rows, 2)


def test_strays_are_compared_in_blocks(spark, monkeypatch):
    """Small blocks take the same decisions."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rows = [(i, t) for i, t in enumerate([*chain(30, 3), *chain(30, 4), *chain(30, 6)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 2).collect()}
    assert found == brute(rows, 2)


def test_rows_without_id_repeats_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (2, "A b C")], "doc_id bigint, text string")
    found = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()))
    assert found == [(0, None, True), (2, 2, True), (3, 2, False), (3, 2, False)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_unlike_texts_of_one_id_are_one_document(spark):
    a, b = "a b c d e f", "u v w x y z"
    rows = [(3, a), (7, a), (7, b), (9, b), (9, ""), (11, ""), (12, "p q r s t"), (12, None), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    gone = [(7, 3, False)] * 2 + [(9, 3, False)] * 2
    assert found == [(0, None, True), (3, 3, True), *gone, (11, 11, True), (12, 12, True), (12, 12, True)]
