"""The Merkle manifest against a plain tree built from the whole list."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from auditlake.llm import manifest, queries


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row) -> str:
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(hashes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top and the path of every leaf."""
    paths = [[] for _ in hashes]
    nodes = [(h, [i]) for i, h in enumerate(hashes)]
    while len(nodes) > 1:
        above = []
        for low in range(0, len(nodes), 8):
            run = nodes[low : low + 8]
            for k, (_, own) in enumerate(run):
                for i in own:
                    paths[i].append(("".join(h for h, _ in run[:k]), "".join(h for h, _ in run[k + 1 :])))
            above.append((sha(*(h for h, _ in run)), [i for _, own in run for i in own]))
        nodes = above
    return nodes[0][0], paths


def brute(rows) -> list[tuple]:
    """Rows of the query for ``(doc_id, source, lang, n_chars, text)``."""
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append((row, leaf_of(row)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    tops, paths = {}, {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        tops[lang], paths[lang] = tree([leaf for _, leaf in by_lang[lang]])
    root, over = tree([tops[lang] for lang in langs])
    found = []
    for lang, top_path in zip(langs, over, strict=True):
        for (row, leaf), path in zip(by_lang[lang], paths[lang], strict=True):
            whole, text = path + top_path, row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf_of((*row[:4], text))
            for before, after in whole:
                node = sha(before, node, after)
            proof = sha(*(b + a for b, a in whole))
            found.append((row[0], leaf, tops[lang], root, proof, node, node == root))
    return found


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
DDL = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree int"


def asked(spark, tmp_path, rows):
    """The query's rows over a table with further columns of clashing names."""
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], DDL)
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r[c] for c in COLUMNS) for r in queries.op12_merkle_manifest(spark, str(tmp_path)).collect()]


@pytest.mark.parametrize("sizes", [(1,), (8,), (9, 1), (64, 65, 2), (513, 7, 1, 1, 1, 1, 1, 1, 1, 1)])
def test_proofs_are_those_of_a_plain_tree(spark, tmp_path, sizes):
    rows = [(1000 * k + 7 * i % 991, f"s{i % 3}", f"l{k}", i, f"Text {i} of {k}") for k, n in enumerate(sizes) for i in range(n)]
    assert Counter(asked(spark, tmp_path, rows)) == Counter(brute(rows))


def test_odd_rows(spark, tmp_path):
    rows = [(i, None, None, None, None) for i in range(10)]
    rows += [(None, "s", "en", 3, "ABC"), (None, "s", "en", 3, "abd"), (5, "s", "", 0, ""), (-3, "é", "zh", 1, "語 É ABC")]
    rows += [(6, "s", "en", 1, "Same")] * 20 + [(6, "s", "en", 1, "Other"), (9, "s", "en", 1, "X" * 300_000)]
    found = asked(spark, tmp_path, rows)
    assert Counter(found) == Counter(brute(rows))
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


def test_no_rows(spark, tmp_path):
    assert asked(spark, tmp_path, []) == []


def test_nodes_cover_their_leaves(spark):
    leaves = spark.createDataFrame([("a", i, sha(str(i))) for i in range(100)] + [("b", 1, "x")], "tree string, key int, leaf string")
    made = manifest.build(leaves)
    found = {(r.tree, r.level, r.lo, r.hi) for r in made.nodes().collect()}
    expected = {("a", 1, lo, min(lo + 8, 100)) for lo in range(0, 100, 8)} | {("a", 2, 0, 64), ("a", 2, 64, 100), ("a", 3, 0, 100), ("b", 1, 0, 1)}
    assert found == expected
    paths = {(r.tree, r["rank"]): len(r.path) for r in manifest.proofs(made).collect()}
    assert len(paths) == 101 and paths["=a", 99] == 4 and paths["=b", 0] == 1
