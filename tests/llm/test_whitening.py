"""Whitening against exact integers and a dense eigendecomposition."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracecause.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)


def brute(rows, most=32, multiplicity=True, scale=64, shift=1_000_000):
    """(n, deviations, eigenvalues, projections on own eigenvectors) by plain loops over exact integers."""
    xs = [[int(np.floor(scale * float(c))) + shift for c in v] for _, v in rows if usable(v)]
    fitted = xs if multiplicity else [list(t) for t in sorted({tuple(x) for x in xs})]
    n, sums = len(fitted), [sum(col) for col in zip(*fitted)]
    far = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for x in xs]
    centre = [Fraction(s, n) for s in sums]
    d = np.array([[float(c - m) for c, m in zip(x, centre)] for x in fitted])
    v = d.T @ d / n
    e = np.linalg.eigvalsh(v)[::-1]
    kept = min(most, int((e > 1e-10 * e[0]).sum()))
    every = np.array([[float(c - m) for c, m in zip(x, centre)] for x in xs])
    return n, far, e[:kept], np.trace(v), v, every


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = whitening.whiten(df, **options).collect()
    n, far, e, trace, v, d = brute(rows, options.get("most", 32), options.get("multiplicity", True))
    ids = [i for i, x in rows if usable(x)]
    assert sorted((r.id, r.deviation) for r in got) == sorted(zip(ids, far))
    assert all(int(r.deviation_exact) == r.deviation and r.n == n for r in got)
    np.testing.assert_allclose(got[0].explained, e / trace, rtol=1e-9)
    # Each component may have either sign: recover the component from all rows and hold it against V.
    order = {(r.id, r.deviation): np.array(r.z) for r in got}
    z = np.array([order[i, f] for i, f in zip(ids, far)])
    for k, value in enumerate(e):
        if k + 1 < len(e) and e[k] - e[k + 1] < 1e-6 * e[0]:
            continue
        u = np.linalg.eigh(v)[1][:, ::-1][:, k]
        want = d @ u / np.sqrt(value)
        sign = np.sign(want @ z[:, k]) or 1
        np.testing.assert_allclose(sign * z[:, k], want, rtol=1e-6, atol=1e-8)
    assert got[0].identity_error < 1e-9
    return got


def test_like_a_dense_decomposition(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(c) for c in r.normal(0, 1, 7) * np.arange(1, 8)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]
    check(spark, rows)
    check(spark, rows, most=3)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert whitening.distinct_vectors(whitening.integer_vectors(df, "vec_id", "embedding", 64, 1_000_000)).count() == 300


def test_distinct_vectors_count_once_if_asked(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(c) for c in r.normal(0, 2, 4)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(500)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = whitening.whiten(df, multiplicity=False).collect()
    assert {g.n for g in got} == {60} and len(got) == 560
    _, far, e, trace, _, _ = brute(rows, multiplicity=False)
    assert sorted(g.deviation for g in got) == sorted(far)
    np.testing.assert_allclose(got[0].explained, e / trace, rtol=1e-9)


def test_edges(spark, table_dir):
    r = np.random.default_rng(5)
    good = [(i, [float(c) for c in r.normal(0, 1, 3)]) for i in range(20)]
    odd = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]), (54, [float("inf"), 1.0, 1.0]), (55, [1.0])]
    # Repeated and null ids are rows like others; every third component repeats the first, so rank is two.
    good += [(3, [9.0, 9.0, 9.0]), (None, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0])]
    flat = [(i, [v[0], v[1], v[0]]) for i, v in good]
    df = spark.createDataFrame([(i, v, 0) for i, v in flat + odd], SCHEMA)
    clash = df.selectExpr("*", *[f"'clash' AS {c}" for c in ("id", "x", "k1", "k2", "w", "z", "n", "c", "v", "i", "component")])
    got = whitening.whiten(clash).collect()
    assert len(got) == len(flat) and {len(g.z) for g in got} == {2} and got[0].identity_error < 1e-9
    assert sum(g.id is None for g in got) == 2
    for rows in ([], odd[:5], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        assert whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        whitening.whiten(df, most=0)


def test_numbers_beyond_64_bits(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5.0, 3.0])]
    got = {g.id: g for g in whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()}
    assert got[1].deviation is None and np.isfinite(got[3].z).all()
    big = [(i, [float(2 ** 50 * i), float(i * i)]) for i in range(1, 9)]
    n, far, *_ = brute(big)
    found = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in big], SCHEMA)).collect()
    assert all(g.deviation is None for g in found if far[g.id - 1] >= 1 << 63)
    assert {g.id: int(g.deviation_exact) for g in found if far[g.id - 1] < 10 ** 38} == {
        i: far[i - 1] for i, _ in big if far[i - 1] < 10 ** 38}


def test_query(spark, sf_dir):
    got = queries.op13_whitening(spark, sf_dir).toPandas()
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, far, e, trace, *_ = brute(rows)
    assert len(got) == len([v for _, v in rows if usable(v)]) * len(e) and set(got.n) == {n}
    assert dict(zip(got.vec_id, got.deviation)) == dict(zip([i for i, v in rows if usable(v)], far))
    np.testing.assert_allclose(got.groupby("component").explained.first(), e / trace, rtol=1e-9)
    assert got.identity_error.max() < 1e-6
    assert spark.createDataFrame(got[["component"]]).agg(F.max("component")).first()[0] == len(e)
