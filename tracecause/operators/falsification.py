"""Does the data contradict the graph?

A graph says that each node is independent of its non-descendants given its parents. Every such claim is
tested by partial correlation, all of them from one correlation matrix, so the data is read once; or, with
``method="covariance"``, by the generalised covariance measure: products of held-out residuals of both nodes given the
parents, under fitted mechanisms, of the nodes and of their squares. That one also sees dependence that leaves no
correlation. The count of violated claims is compared with that of graphs whose nodes are permuted.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecause.functions.randomness import uniform, uniform_values
from tracecause.functions.statistics import chi2_tail_value, normal_tail_value
from tracecause.operators.frames import complete
from tracecause.operators.graph import CausalGraph
from tracecause.operators.mechanisms import Mechanism, collect_moments, design_terms, profile, solve_standard, to_raw
from tracecause.operators.resampling import array_sums

CONSTANT = 1e-9  # variance left after conditioning below which nothing is left to correlate


def correlation_matrix(df: DataFrame, nodes) -> tuple[np.ndarray, float]:
    """Correlations of complete rows and their number, from one scan."""
    nodes = list(nodes)
    groups, n, _ = collect_moments(df, nodes, [(nodes[0], tuple((c,) for c in nodes))])
    m = groups[()]
    cov = np.array([[m.cov(a, b) for b in nodes] for a in nodes])
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    safe = np.where(sd > 0, sd, 1.0)
    corr = cov / np.outer(safe, safe)
    np.fill_diagonal(corr, 1.0)
    return corr, float(n)


def partial_correlation(corr: np.ndarray, x: int, z: int, given: list[int]) -> float:
    """Correlation of x and z that the given columns leave; 0 where one of them is left constant."""
    block = corr[np.ix_([x, z], [x, z])]
    if given:
        inner = corr[np.ix_(given, given)]
        cross = corr[np.ix_([x, z], given)]
        block = block - cross @ np.linalg.pinv(inner, rcond=1e-12) @ cross.T
    if block[0, 0] < CONSTANT or block[1, 1] < CONSTANT:
        return 0.0
    return float(np.clip(block[0, 1] / math.sqrt(block[0, 0] * block[1, 1]), -1.0, 1.0))


def implied_claims(graph: CausalGraph) -> list[tuple[str, str, tuple[str, ...]]]:
    """``(node, other, parents)``: the independences the graph implies, in name order."""
    claims = []
    for x in sorted(graph.nodes):
        parents = graph.parents(x)
        barred = set(graph.descendants(x)) | set(parents) | {x}
        claims += [(x, z, parents) for z in sorted(graph.nodes) if z not in barred]
    return claims


def claim_results(graph: CausalGraph, nodes, corr: np.ndarray, n: float, level: float = 0.05) -> list[tuple]:
    """``(node, other, given, partial_corr, z, p_value, violated)`` per implied independence (Fisher z)."""
    at = {c: i for i, c in enumerate(nodes)}
    out = []
    for x, z, given in implied_claims(graph):
        r = partial_correlation(corr, at[x], at[z], [at[g] for g in given])
        bound = min(abs(r), 1.0 - 1e-15)
        score = math.atanh(bound) * math.sqrt(max(n - len(given) - 3.0, 0.0))
        p = min(2.0 * normal_tail_value(score), 1.0)
        out.append((x, z, ",".join(given), r, math.copysign(score, r), p, p < level))
    return out


CLAIM_SCHEMA = ("node string, other string, given string, partial_corr double, z double, p_value double, "
                "violated boolean")


def local_claims(df: DataFrame, graph: CausalGraph, level: float = 0.05) -> DataFrame:
    """Test table of the graph's implied independences."""
    nodes = sorted(graph.nodes)
    corr, n = correlation_matrix(df, nodes)
    return df.sparkSession.createDataFrame(claim_results(graph, nodes, corr, n, level), CLAIM_SCHEMA)


def permuted_graph(graph: CausalGraph, replicate: int, seed: int = 0) -> CausalGraph:
    nodes = sorted(graph.nodes)
    order = np.argsort(uniform_values(len(nodes), "permute", replicate, seed), kind="stable")
    return graph.relabel({n: nodes[j] for n, j in zip(nodes, order)})


def with_squares(df: DataFrame, nodes) -> tuple[DataFrame, dict[str, str]]:
    """Complete rows with a column for the square of each node about its mean, and the names of these columns."""
    scale, _, _ = profile(df, nodes)
    square = {n: f"{n}__square" for n in nodes}
    rows = df.filter(complete(nodes)).select("*", *[
        F.pow((F.col(n).cast("double") - scale.mean[n]) / scale.sd[n], 2).alias(square[n]) for n in nodes])
    return rows, square


def covariance_results(df: DataFrame, key: Column, claims, kind: str = "poly", squares: bool = True, folds: int = 5,
                       level: float = 0.05, seed: int = 0) -> dict[tuple, tuple[float, float]]:
    """``{(node, other, given): (statistic, p_value)}`` for any number of claims, from two passes over the rows.

    The first pass has the sums of all regressions per fold; the mechanism that judges a fold is fitted on the others. The
    second adds up, per claim, the products of residuals and their squares: the statistic is the squared distance of their
    mean from zero, a chi-square. Products: both nodes, and each with the other's square (``squares``).
    """
    claims = sorted(set(claims))
    nodes = sorted({n for x, z, given in claims for n in (x, z, *given)})
    rows, square = with_squares(df, nodes) if squares else (df.filter(complete(nodes)), {})
    fold = F.floor(uniform(key, "fold", 0, seed) * folds).cast("int")
    rows = rows.select(fold.alias("__fold"), *[F.col(c).cast("double").alias(c) for c in [*nodes, *square.values()]])
    targets = sorted({(t, given) for x, z, given in claims for n in (x, z) for t in ([n, square[n]] if squares else [n])})
    terms = {given: design_terms(kind, given) for _, given in targets}
    columns = [*nodes, *square.values()]
    groups, n, _ = collect_moments(rows, columns, [(t, terms[given]) for t, given in targets], ["__fold"])
    whole = None
    for m in groups.values():
        whole = m if whole is None else whole + m
    models = {}
    for (f,), m in groups.items():
        rest = whole - m if len(groups) > 1 else whole
        for t, given in targets:
            intercept, coef = to_raw(rest.scale, t, terms[given], solve_standard(rest, t, terms[given]))
            models[f, t, given] = Mechanism(t, "linear", given, terms[given], coef, intercept)
    spread = {c: max(whole.var(c), 1e-300) ** 0.5 for c in columns}
    found = sorted(f for (f,) in groups)

    def residual(x, t, given):
        out = np.empty(len(x[t]))
        for f in found:
            mine = x["__fold"] == f
            out[mine] = (x[t][mine] - models[f, t, given].predict({p: x[p][mine] for p in given})) / spread[t]
        return out

    def sums(x):
        held, out = {}, []
        for a, b, given in claims:
            def r(t):
                if (t, given) not in held:
                    held[t, given] = residual(x, t, given)
                return held[t, given]
            both = [r(a) * r(b)] + ([r(a) * r(square[b]), r(square[a]) * r(b)] if squares else [])
            both = np.column_stack(both)
            out += [both.sum(axis=0), (both.T @ both).ravel(), [(r(a) ** 2).sum(), (r(b) ** 2).sum()]]
        return np.concatenate(out)

    k = 3 if squares else 1
    each = array_sums(rows, ["__fold", *columns], sums).reshape(len(claims), k + k * k + 2)
    out = {}
    for claim, s in zip(claims, each):
        mean = s[:k] / n
        cov = s[k:k + k * k].reshape(k, k) / n - np.outer(mean, mean)
        if min(s[-2:]) / n < CONSTANT:  # one of the nodes is given by the parents: nothing is left to depend
            out[claim] = (0.0, 1.0)
            continue
        statistic = float(n * mean @ np.linalg.pinv(cov, rcond=1e-10) @ mean)
        out[claim] = (statistic, chi2_tail_value(statistic, k))
    return out


COVARIANCE_SCHEMA = "node string, other string, given string, statistic double, p_value double, violated boolean"


def covariance_claims(df: DataFrame, graph: CausalGraph, key: Column, kind: str = "poly", squares: bool = True, folds: int = 5,
                      level: float = 0.05, seed: int = 0) -> DataFrame:
    """Test table of the graph's implied independences by the generalised covariance measure."""
    claims = implied_claims(graph)
    found = covariance_results(df, key, claims, kind, squares, folds, level, seed)
    rows = [(x, z, ",".join(g), *found[x, z, g], found[x, z, g][1] < level) for x, z, g in claims]
    return df.sparkSession.createDataFrame(rows, COVARIANCE_SCHEMA)


PERMUTATION_SCHEMA = ("graph string, replicate int, n_claims int, n_violations int, violation_share double, "
                      "same_claims boolean")
VERDICT_SCHEMA = ("n_claims int, n_violations int, n_permutations int, p_value double, same_claims_share double, "
                  "informative boolean, rejected boolean")


def permutation_results(df: DataFrame, graph: CausalGraph, n_permutations: int = 20, level: float = 0.05,
                        seed: int = 0, method: str = "correlation", key: Column | None = None, kind: str = "poly") -> list[tuple]:
    nodes = sorted(graph.nodes)
    graphs = {r: graph if r < 0 else permuted_graph(graph, r, seed) for r in range(-1, n_permutations)}
    claims = {r: implied_claims(g) for r, g in graphs.items()}
    if method == "covariance":
        if key is None:
            raise ValueError("folds need a row key")
        every = [c for part in claims.values() for c in part]
        p = {c: v[1] for c, v in covariance_results(df, key, every, kind, level=level, seed=seed).items()} if every else {}
        bad = {r: sum(p[c] < level for c in part) for r, part in claims.items()}
    elif method == "correlation":
        corr, n = correlation_matrix(df, nodes)
        bad = {r: sum(v[-1] for v in claim_results(g, nodes, corr, n, level)) for r, g in graphs.items()}
    else:
        raise ValueError(f"unknown method {method!r}")

    def as_set(part) -> frozenset:
        return frozenset((frozenset((x, z)), frozenset(s)) for x, z, s in part)

    own = as_set(claims[-1])
    return [("given" if r < 0 else "permuted", r, len(part), bad[r], bad[r] / max(len(part), 1), as_set(part) == own)
            for r, part in claims.items()]


def permutations(df: DataFrame, graph: CausalGraph, n_permutations: int = 20, level: float = 0.05,
                 seed: int = 0) -> DataFrame:
    """Violations of the given and of each permuted graph: the histogram behind the verdict."""
    return df.sparkSession.createDataFrame(permutation_results(df, graph, n_permutations, level, seed),
                                           PERMUTATION_SCHEMA)


def falsify(df: DataFrame, graph: CausalGraph, n_permutations: int = 20, level: float = 0.05,
            seed: int = 0, method: str = "correlation", key: Column | None = None, kind: str = "poly") -> DataFrame:
    """One row: p-value (share of permuted graphs violated no more often) and how much the test can tell.

    When many permutations imply the very same independences the graph says little that could be wrong: the test
    is informative only if at most ``level`` of them do, and only an informative test rejects.
    """
    rows = permutation_results(df, graph, n_permutations, level, seed, method, key, kind)
    given, others = rows[0], rows[1:]
    p = sum(o[3] <= given[3] for o in others) / max(len(others), 1)
    same = sum(o[5] for o in others) / max(len(others), 1)
    return verdict(df.sparkSession, given, len(others), p, same, level)


def verdict(spark: SparkSession, given, n: int, p: float, same: float, level: float) -> DataFrame:
    informative = same <= level
    return spark.createDataFrame([(given[2], given[3], n, p, same, informative, informative and p > level)], VERDICT_SCHEMA)
