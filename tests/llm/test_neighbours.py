"""Embedding near-duplicates against all pairs."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from auditlake.llm import neighbours

DDL = "vec_id bigint, embedding array<float>, label string, node int, weight int, cls string"


def brute(rows, threshold=0.93):
    """``vec_id, n_links, component_id, kept`` of ``(vec_id, vector, label)`` rows."""
    usable = [
        i
        for i, (key, v, label) in enumerate(rows)
        if key is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    parent = {rows[i][0]: rows[i][0] for i in usable}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    kinds = {}
    for i in usable:
        kinds.setdefault((rows[i][2], len(rows[i][1])), []).append(i)
    for own in kinds.values():
        x = np.array([rows[i][1] for i in own], np.float32).astype(float)
        x /= np.sqrt((x**2).sum(1, keepdims=True))
        hit = x @ x.T >= threshold
        np.fill_diagonal(hit, False)
        for i, n in zip(own, hit.sum(1), strict=True):
            links[i] = int(n)
        for a, b in np.argwhere(np.triu(hit)):
            low, high = sorted((root(rows[own[a]][0]), root(rows[own[b]][0])))
            parent[high] = low
    found = []
    for i, (key, _, _) in enumerate(rows):
        component = root(key) if i in set(usable) and key is not None else key
        found.append((key, links[i], component, True if key is None else key == component))
    return Counter(found)


def asked(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2, "clash") for r in rows], DDL).repartition(4)
    return Counter(tuple(r) for r in neighbours.near_duplicates(frame).collect())


def around(draw, base, cosine):
    """A vector at exactly this cosine to another one, in a random direction."""
    base = base / np.linalg.norm(base)
    other = draw.normal(size=len(base))
    other -= base * (other @ base)
    return cosine * base + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def planted(n=400, width=64, labels=2, seed=1, hot=0):
    draw = np.random.default_rng(seed)
    vectors = [draw.normal(size=width) for _ in range(n)]
    for i in range(n // 3):
        cosine = draw.choice([0.925, 0.9295, 0.9305, 0.935, 0.95, 0.98, 0.999])
        vectors.append(around(draw, vectors[int(draw.integers(len(vectors)))], cosine) * draw.choice([0.1, 1, 30]))
    vectors += [around(draw, vectors[0], draw.uniform(0.975, 0.99)) for _ in range(hot)]
    vectors += [around(draw, vectors[5], 0.94) for _ in range(hot // 4)]
    vectors += [vectors[int(draw.integers(len(vectors)))] for _ in range(n // 5)]
    keys = draw.permutation(len(vectors))
    return [(int(k), v.tolist(), f"l{int(draw.integers(labels))}") for k, v in zip(keys, vectors, strict=True)]


@pytest.mark.parametrize(("block", "n", "width", "labels", "hot"), [(1024, 400, 64, 2, 0), (40, 600, 64, 1, 300), (25, 500, 8, 1, 200), (16, 200, 3, 3, 0)])
def test_no_link_is_lost_or_made_up(spark, monkeypatch, block, n, width, labels, hot):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "SLICE", max(block // 3, 5))
    rows = planted(n, width, labels, seed=block, hot=hot)
    rows += [(10_000 + i, r[1], "other") for i, r in enumerate(rows[:30])]
    assert asked(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = planted(60, 16, 1)
    base = rows[0][1]
    rows += [(2_000 + i, v, "l0") for i, v in enumerate([None, [], [0.0] * 16, [None] * 16, [float("nan")] * 16, [float("inf")] * 16, base[:8]])]
    rows += [(3_000, base, None), (None, base, "l0"), (3_001, [x * 1e-30 for x in base], "l0"), (3_002, [x * 1e30 for x in base], "l0")]
    # one id, unlike vectors; and rows repeated as they are
    rows += [(3_003, rows[1][1], "l0"), (3_003, rows[2][1], "l0"), (3_003, rows[2][1], "l1")] + [rows[3]] * 50
    assert asked(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 0.0], "a")], [(1, None, "a"), (2, [1.0], None)]])
def test_few_rows(spark, rows):
    assert asked(spark, rows) == brute(rows)


def test_probes_reach_one_of_two_linked_vectors():
    """The border between two lists is within half the link distance of one of them."""
    draw = np.random.default_rng(3)
    units = draw.normal(size=(3_000, 24))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    model = neighbours.fit(units, 3_000)
    assert len(model.centroids) > 20
    partners = np.array([around(draw, u, 0.93 + 1e-9) for u in units])
    home_a, _, _, reach_a = neighbours.encode(model, units)
    home_b, _, _, reach_b = neighbours.encode(model, partners)
    every = np.arange(len(units))
    met = (home_a == home_b) | reach_a[every, home_b] | reach_b[every, home_a]
    assert met.all() and (home_a != home_b).sum() > 500
    assert reach_a.mean() < 0.6


def test_codes_leave_out_most_members():
    """A member's asymmetric distance is off by what its codes leave at most."""
    draw = np.random.default_rng(4)
    units = draw.normal(size=(500, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    model = neighbours.fit(units, 500)
    home, codes, rest, _ = neighbours.encode(model, units)
    told = model.centroids[home] + np.concatenate([model.codebooks[k][codes[:, k]] for k in range(neighbours.SUBSPACES)], axis=1)
    assert np.allclose(np.sqrt(((units - told) ** 2).sum(1)), rest)
    apart = np.sqrt(((units[:, None] - told[None]) ** 2).sum(2))
    assert (apart - rest[None] <= model.t).mean() < 0.05
