"""Vector codes against plain rounds over all points and entries."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from auditlake.llm import balls, codes, queries

DDL = "vec_id bigint, embedding array<float>, label int, id string, code int, n int"


def points_of(n, spread, width=8, seed=0):
    return np.random.default_rng(seed).integers(-spread, spread + 1, (n, width))


@pytest.mark.parametrize(("n", "spread"), [(1, 9), (96, 500), (97, 500), (3000, 500), (3000, 2), (300, 0), (2000, 1 << 26)])
def test_trees_give_what_all_pairs_give(n, spread):
    points = points_of(n, spread)
    points[n // 3 : n // 2] = points[0]
    tree = balls.Tree.unpack(balls.build(points).pack())
    entries = points[:16].copy()
    entries[len(entries) // 2] = entries[0]
    distances = ((points[:, None] - entries[None]) ** 2).sum(2)
    own = distances.argmin(1)
    counts, sums = balls.totals(tree, entries)
    assert (counts == np.bincount(own, minlength=len(entries))).all()
    assert all((sums[k] == points[own == k].sum(0)).all() for k in range(len(entries)))
    entry, error = balls.nearest(tree, entries)
    assert (entry == own).all() and (error == distances.min(1)).all()


def test_balls_hold_their_points_and_are_owned_as_a_whole():
    points = np.concatenate([points_of(500, 20) + 1000 * k for k in range(4)])
    tree = balls.build(points)
    for low, high, total, radius in zip(tree.low, tree.high, tree.sums, tree.radius, strict=True):
        own = tree.points[low:high]
        assert (own.sum(0) == total).all()
        assert np.sqrt(((own - total / len(own)) ** 2).sum(1)).max() <= radius * (1 + 1e-9) + 1e-9
    looked_at = sum(len(at) for _, _, at in balls._settle(tree, points[[0, 500, 1000, 1500]]) if at is not None)
    assert looked_at == 0


def brute(rows, parts=8, entries=16, rounds=6):
    """Rows of the query for ``(vec_id, vector, label)``."""
    valid = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and np.isfinite(x) for x in r[1])]
    valid.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in valid if len(r[1]) == len(valid[0][1])]
    if not kept:
        return []
    vectors = np.floor(np.array([r[1] for r in kept], np.float32).astype(float) * 4096).astype(np.int64)
    cut = vectors.reshape(len(kept), parts, -1)
    first = {r[0]: k for k, r in reversed(list(enumerate(kept)))}
    seeds = sorted(first.values())[:entries]
    books = cut[seeds].swapaxes(0, 1).copy()
    for turn in range(rounds + 1):
        distances = ((cut[:, :, None, :] - books[None]) ** 2).sum(3)
        own = distances.argmin(2)
        if turn < rounds:
            for k in range(parts):
                for e in range(len(seeds)):
                    members = cut[own[:, k] == e, k]
                    if len(members):
                        books[k, e] = members.sum(0) // len(members)
    errors = distances.min(2).sum(1)
    of_label = defaultdict(int)
    for r, error in zip(kept, errors, strict=True):
        of_label[r[2]] += int(error)
    digest = hashlib.sha256(",".join(str(x) for x in books.reshape(-1)).encode()).hexdigest()
    return [(r[0], bytes(own[i].astype(np.uint8)).hex(), int(errors[i]), of_label[r[2]], digest) for i, r in enumerate(kept)]


def asked(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], DDL)
    frame.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return [tuple(r) for r in queries.op11_vector_codes(spark, str(tmp_path)).collect()]


def vectors(n, seed=0, width=16):
    return np.random.default_rng(seed).normal(size=(n, width)).astype(np.float32).tolist()


def test_odd_rows(spark, tmp_path):
    rows = [(3 * i, v, (None, 1, 2)[i % 3]) for i, v in enumerate(vectors(150))]
    odd = [None, [], [1.0], [None] * 16, [float("nan")] * 16, [float("inf")] * 16, [0.5] * 24, [0.0] * 16, [3e4] * 16]
    rows += [(1000 + i, v, 7) for i, v in enumerate(odd)]
    rows += [(3, v, None) for v in vectors(5, 1)] + [(None, v, 9) for v in vectors(3, 2)] + [rows[4]] * 30
    assert Counter(asked(spark, tmp_path, rows)) == Counter(brute(rows))


def test_fewer_ids_than_entries(spark, tmp_path):
    rows = [(i % 3, v, 1) for i, v in enumerate(vectors(60, 4))] + [(None, v, 1) for v in vectors(4, 5)]
    assert Counter(asked(spark, tmp_path, rows)) == Counter(brute(rows))


@pytest.mark.parametrize("rows", [[], [(1, None, 2), (2, [1.0], None)]])
def test_nothing_to_code(spark, tmp_path, rows):
    assert asked(spark, tmp_path, rows) == []


def test_a_hot_label_is_joined_apart(spark, tmp_path):
    """More labels than may be hot, one of them with a third of all rows."""
    rows = [(i, v, 5 if i % 3 == 0 else i) for i, v in enumerate(vectors(2400, 3, 8))]
    assert Counter(asked(spark, tmp_path, rows)) == Counter(brute(rows))


def test_blocks_do_not_matter(spark, monkeypatch):
    rows = spark.createDataFrame([(i, v, i % 4) for i, v in enumerate(vectors(500))], "vec_id int, embedding array<float>, label int")
    expected, books = codes.compress(rows)
    monkeypatch.setattr(codes, "BLOCK", 33)
    again, same = codes.compress(rows.repartition(5))
    assert books.text() == same.text() and Counter(expected.collect()) == Counter(again.collect())
