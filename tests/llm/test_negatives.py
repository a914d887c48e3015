"""Hard negatives against plain loops over all pairs, and the curve and the zones by themselves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracecause.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors=100, positives=5, most=10, scale=256, low=30, high=90):
    """Rows are (id, vector, label); every pair of equal length is scored with Python integers."""
    part = [(i, [math.floor(scale * float(c)) for c in v], y) for i, v, y in rows
            if i is not None and v is not None and y is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (i, v, y) in enumerate(part):
        if i % anchors:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for k, (j, w, z) in enumerate(part) if k != at and len(w) == len(v)]
        scored.sort(key=lambda t: t[:2])
        for p, j, z in [t for t in scored if t[2] == y][:positives]:
            fit = [(n, k) for n, k, z in scored if z != y and low * -p <= 100 * -n <= high * -p][:most]
            out += [(i, j, r + 1, k, -p, -n) for r, (n, k) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in negatives.mine(spark.createDataFrame(rows, SCHEMA), **options).collect())


def clusters(n, seed, width=6, labels=4, spread=0.2):
    """Vectors around one centre per label; a third of all rows has label 0, and some are equal."""
    r = np.random.default_rng(seed)
    centres = r.normal(0, 1, (labels, width))
    rows = []
    for i in range(n):
        y = int(r.integers(labels)) if i % 3 else 0
        v = centres[y] + r.normal(0, spread, width) if i % 11 else centres[y]
        rows.append((i, [float(c) for c in v], y))
    return rows


def test_curve_visits_every_cell_by_unit_steps():
    for axes, bits in ((1, 3), (2, 3), (3, 2), (4, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * axes)).reshape(axes, -1).T
        place = negatives.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_product():
    r = np.random.default_rng(1)
    for size in (1.0, 1e6, 1e14):
        a, x = np.floor(r.normal(0, size, (5, 7))), np.floor(r.normal(0, size, (50, 7)))
        least, largest = negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
        exact = negatives.products(a, x)
        assert all(l <= min(e) and max(e) <= m for l, m, e in zip(least[:, 0], largest[:, 0], exact.tolist()))


@pytest.mark.parametrize("spread", [0.05, 0.5])
def test_like_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "MOST_ROWS", 32)
    monkeypatch.setattr(negatives, "GROUP", 7)
    rows = clusters(700, 2, spread=spread)
    want = brute(rows, anchors=20)
    assert want and mined(spark, rows, anchors=20) == want
    assert mined(spark, rows, anchors=50, positives=2, negatives=3, low=-40, high=70) == brute(rows, 50, 2, 3, low=-40, high=70)


def test_blocks_out_of_reach_stay_closed(spark, monkeypatch):
    monkeypatch.setattr(negatives, "MOST_ROWS", 32)
    df = spark.createDataFrame(clusters(3000, 3, spread=0.02), SCHEMA)
    blocks, folder, zones = negatives.write_blocks(negatives.candidates(df, "vec_id", "embedding", F.col("label"), 256))
    anchors = [r.asDict() for r in negatives.anchors_of(blocks, 500).collect()]
    store = negatives.Store(folder, zones)
    for a in anchors:
        negatives.Group(store, [a], 5, 10, 30, 90).find_positives()
    assert len(anchors) == 6 and store.opened < 0.2 * len(anchors) * blocks.count()


def test_edges(spark):
    good = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [0.5, 2.0], 1), (1, [1.0, 1.0], 2), (2, [1.0, 1.0], 2), (3, [1.0, 0.9], 2),
            (200, [1.0], 3), (201, [1.0], 3), (202, [0.5], 4), (300, [], 5), (301, [], 5), (302, [], 6), (-100, [-1.0, 1.0], 1),
            (400, [7.0, 7.0, 7.0], 8)]
    odd = [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan"), 1.0], 1), (503, [float("inf"), 1.0], 1), (504, [1.0, 1.0], None),
           (None, [1.0, 1.0], 1)]
    want = brute(good + odd)
    assert {r[0] for r in want} >= {0, 100, 200, 300} and mined(spark, good + odd) == want
    assert mined(spark, []) == [] and mined(spark, odd) == [] and mined(spark, [(0, [1.0], 1)]) == []
    clash = spark.createDataFrame(good, SCHEMA).selectExpr("*", *[f"'clash' AS {c}" for c in ("id", "x", "c", "dim", "place", "file", "at", "ids")])
    assert sorted(tuple(r) for r in negatives.mine(clash).collect()) == want


def test_numbers_too_large_for_doubles(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(np.float32(c)) for c in r.normal(0, 1e8, 3)], i % 3) for i in range(60)]
    want = brute(rows, anchors=10)
    assert want and mined(spark, rows, anchors=10) == [(*w[:4], min(w[4], (1 << 63) - 1), min(w[5], (1 << 63) - 1)) for w in want]
    huge = [(i, [float(np.float32(c)) for c in r.normal(0, 1e25, 3)], i % 3) for i in range(40)]
    assert [w[:4] for w in mined(spark, huge, anchors=10)] == [w[:4] for w in brute(huge, anchors=10)]


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    moved = [(i, v, y if y is None or i % 7 else (y + 1) % 10) for i, v, y in rows]
    assert sorted(tuple(r) for r in queries.op12_hard_negatives(spark, sf_dir).collect()) == brute(moved)
