"""Mechanisms: one conditional distribution per node, fitted from distributed sums.

A node is ``intercept + sum(coef * term) + noise``, where a term is a product of parents. Fitting needs
no more than sums of products of columns, so all nodes, folds, periods or bootstrap replicates come out
of one aggregate, and only those sums reach the driver. A second pass numbers the rows, and noise is drawn from all
of them.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecause.functions.randomness import normal_from, normal_values, uniform, uniform_values
from tracecause.operators.frames import complete
from tracecause.operators.graph import CausalGraph
from tracecause.operators.noise import NoiseTable, RowOrder, fetch
from tracecause.sources.workspace import cut_lineage

RIDGE = 1e-10           # on the scaled moment matrix of exactly collinear parents
MAX_CONDITION = 1e10    # condition number from which on parents count as collinear
NOISE_FLOOR = 1e-9      # share of a node's variance below which its noise counts as none
WIDE_MOMENTS = 400      # sums per aggregate before the work is split
TREE_BINS = 32          # intervals of a column that trees tell apart
EXACT_VALUES = 20_000   # about so many different values of a column are counted one by one to bound its intervals
BOUND_ERROR = 0.001     # share of rows by which bounds between more values may miss equal counts

Term = tuple[str, ...]  # product of parents, () being the constant; of a tree ensemble, one tree as JSON

ROOT_KINDS = ("empirical", "halfnorm")
KINDS = ROOT_KINDS + ("mean", "linear", "poly", "gbt")


@dataclass(frozen=True)
class Mechanism:
    node: str
    kind: str
    parents: tuple[str, ...] = ()
    terms: tuple[Term, ...] = ()
    coef: tuple[float, ...] = ()
    intercept: float = 0.0
    noise: NoiseTable | None = field(default=None, compare=False)
    params: Mapping[str, float] = field(default_factory=dict)

    @property
    def is_root(self) -> bool:
        return self.kind in ROOT_KINDS

    @property
    def is_linear(self) -> bool:
        return self.kind != "gbt" and all(len(t) == 1 for t in self.terms)

    def predict(self, values: Mapping):
        """Expected value given the parents. ``values`` may hold Columns, arrays or numbers."""
        out = self.intercept
        if self.kind == "gbt":
            for (tree,), c in zip(self.terms, self.coef):
                out = out + tree_value(json.loads(tree), values) * c
            return out
        for term, c in zip(self.terms, self.coef):
            piece = values[term[0]]
            for name in term[1:]:
                piece = piece * values[name]
            out = out + piece * c
        return out

    def predict_column(self, values: Mapping[str, Column]) -> Column:
        out = self.predict(values)
        return out if isinstance(out, Column) else F.lit(float(out))

    @property
    def is_drawn(self) -> bool:
        """Does the noise come from rows? Otherwise it follows a formula or is none."""
        return self.kind != "halfnorm" and (self.is_root or not self.is_exact)

    @property
    def is_exact(self) -> bool:
        """No noise. Of a mechanism whose numbers are columns, ``exact`` says it for all fits together."""
        exact = self.params.get("exact")
        return self.params.get("noise_var", 0.0) == 0.0 if exact is None else bool(exact)

    def drawn(self, rows: Mapping):
        """Noise of rows given the values of all nodes in them: a root's is its value."""
        return rows[self.node] if self.is_root else rows[self.node] - self.predict(rows)

    def with_draws(self, df: DataFrame, row_id: Column, name: str, replicate=0, seed=0, method="md5") -> DataFrame:
        """``df`` with a column ``name``: a noise draw for each row."""
        if self.kind == "halfnorm":
            z = normal_from(uniform(row_id, f"{self.node}#1", replicate, seed, method),
                            uniform(row_id, f"{self.node}#2", replicate, seed, method))
            return df.withColumn(name, F.lit(self.params["loc"]) + F.lit(self.params["scale"]) * F.abs(z))
        if not self.is_drawn:
            return df.withColumn(name, F.lit(0.0))
        u = uniform(row_id, self.node, replicate, seed, method)
        return self.noise.join(df, u, self.drawn({n: F.col(n) for n in self.noise.nodes}), name)

    def noise_positions(self, n: int, replicate=0, seed=0) -> np.ndarray:
        return self.noise.positions(uniform_values(n, self.node, replicate, seed))

    def noise_values(self, n: int, replicate=0, seed=0) -> np.ndarray:
        """The first ``n`` draws of :meth:`with_draws` with md5, for the bounded draws of a query."""
        if self.kind == "halfnorm":
            z = normal_values(uniform_values(n, f"{self.node}#1", replicate, seed),
                              uniform_values(n, f"{self.node}#2", replicate, seed))
            return self.params["loc"] + self.params["scale"] * np.abs(z)
        if not self.is_drawn:
            return np.zeros(n)
        return np.broadcast_to(self.drawn(self.noise.rows(self.noise_positions(n, replicate, seed))), (n,))

    @property
    def noise_mean(self) -> float:
        return self.params["noise_mean"] if self.is_root else 0.0

    @property
    def noise_var(self) -> float:
        return self.params["noise_var"]


@dataclass(frozen=True)
class CausalModel:
    """Graph and mechanisms."""

    graph: CausalGraph
    mechanisms: Mapping[str, Mechanism] = field(default_factory=dict)
    n_rows: int = 0
    n_dropped: int = 0

    def __getitem__(self, node: str) -> Mechanism:
        return self.mechanisms[node]

    def with_mechanism(self, mechanism: Mechanism) -> "CausalModel":
        return replace(self, mechanisms={**self.mechanisms, mechanism.node: mechanism})

    def is_linear(self, nodes: Iterable[str]) -> bool:
        return all(self[n].is_linear for n in nodes)

    def total_effects(self, target: str) -> tuple[float, dict[str, float]]:
        """``target = constant + sum(effect * noise)`` when every mechanism upstream is linear."""
        nodes = self.graph.closure(target)
        effect = dict.fromkeys(nodes, 0.0)
        effect[target] = 1.0
        for n in reversed(nodes):
            for term, c in zip(self[n].terms, self[n].coef):
                effect[term[0]] += effect[n] * c
        return sum(effect[n] * self[n].intercept for n in nodes), effect

    def with_noise(self, df: DataFrame, nodes=None, suffix: str = "__noise") -> DataFrame:
        """Abduction: the noise each row must have had, one extra column per node."""
        nodes = nodes or self.graph.order
        at = {n: F.col(n) for n in self.graph.order if n in df.columns}
        return df.select("*", *[(at[n] - self[n].predict_column(at)).alias(n + suffix) for n in nodes])

    def residuals(self, df: DataFrame, nodes=None, keep=()) -> DataFrame:
        nodes = nodes or self.graph.order
        noisy = self.with_noise(df, nodes)
        return noisy.select(*keep, *[F.col(n + "__noise").alias(n) for n in nodes])

    def with_draws(self, df: DataFrame, row_id: Column, nodes, replicate=0, seed=0, method="md5",
                   suffix: str = "__draw") -> DataFrame:
        """One column of noise draws per node; ``row_id`` says which draws a row gets."""
        for n in nodes:
            df = self[n].with_draws(df, row_id, n + suffix, replicate, seed, method)
        return df

    @property
    def noise(self) -> NoiseTable | None:
        """The table all mechanisms draw from."""
        tables = {id(m.noise): m.noise for m in self.mechanisms.values() if m.noise is not None}
        if len(tables) > 1:
            raise ValueError("the mechanisms draw from different periods")
        return next(iter(tables.values()), None)

    def with_table(self, table: NoiseTable | None) -> "CausalModel":
        return replace(self, mechanisms={n: replace(m, noise=table) for n, m in self.mechanisms.items()})

    def to_rows(self) -> list[tuple]:
        return [(n, m.kind, list(m.parents), [list(t) for t in m.terms], [float(c) for c in m.coef],
                 float(m.intercept), {k: float(v) for k, v in m.params.items()})
                for n, m in ((n, self.mechanisms[n]) for n in self.graph.order if n in self.mechanisms)]

    def to_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.to_rows(), MECHANISM_SCHEMA)

    @classmethod
    def from_rows(cls, graph: CausalGraph, rows, n_rows: int = 0, n_dropped: int = 0) -> "CausalModel":
        mechanisms = {r.node: Mechanism(r.node, r.kind, tuple(r.parents), tuple(tuple(t) for t in r.terms),
                                        tuple(r.coef), r.intercept, params=dict(r.params)) for r in rows}
        return cls(graph, mechanisms, n_rows, n_dropped)


MECHANISM_SCHEMA = ("node string, kind string, parents array<string>, terms array<array<string>>, coef array<double>, "
                    "intercept double, params map<string,double>")


# --- moments -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Scale:
    """Where to shift and how to scale a column so that sums of products keep their digits."""

    mean: Mapping[str, float]
    sd: Mapping[str, float]

    def standard(self, node: str, x):
        return (x - self.mean[node]) / self.sd[node]


@dataclass
class Moments:
    """Sums of products of standardised columns for one group of rows. Sums of two groups add up."""

    scale: Scale
    sums: dict[Term, float]

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.scale, {k: self.sums[k] + other.sums[k] for k in self.sums})

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.scale, {k: self.sums[k] - other.sums[k] for k in self.sums})

    @property
    def n(self) -> float:
        return self.sums[()]

    def product(self, a: Term, b: Term) -> float:
        return self.sums[tuple(sorted(a + b))]

    def mean(self, node: str) -> float:
        return self.scale.mean[node] + self.scale.sd[node] * self.sums[(node,)] / self.n

    def cov(self, a: str, b: str) -> float:
        """Sample covariance in the units of the data."""
        z = self.product((a,), (b,)) - self.sums[(a,)] * self.sums[(b,)] / self.n
        return z * self.scale.sd[a] * self.scale.sd[b] / max(self.n - 1.0, 1.0)

    def var(self, node: str) -> float:
        return max(self.cov(node, node), 0.0)


def profile(df: DataFrame, nodes) -> tuple[Scale, int, int]:
    """Means and standard deviations over complete rows, and how many rows were complete or not."""
    ok = complete(nodes)
    x = {n: F.when(ok, F.col(n).cast("double")) for n in nodes}
    row = df.agg(F.count(F.lit(1)).alias("__all"), F.count(F.when(ok, 1)).alias("__ok"),
                 *[F.avg(x[n]).alias(f"{n}__m") for n in nodes],
                 *[F.stddev_samp(x[n]).alias(f"{n}__s") for n in nodes]).first()
    if row["__ok"] < 2:
        raise ValueError("fewer than two complete rows: nothing to fit")
    sd = {n: safe_scale(row[f"{n}__s"], row[f"{n}__m"]) for n in nodes}
    return Scale({n: row[f"{n}__m"] for n in nodes}, sd), row["__ok"], row["__all"] - row["__ok"]


def linear_moments(df: DataFrame, nodes, products: list[Term], by: list[str] | None = None
                   ) -> tuple[dict[tuple, Moments], int, int]:
    """``(moments per group, complete rows, dropped rows)`` in one pass, for products of at most two columns (very wide
    graphs take a pass per ``WIDE_MOMENTS`` covariances; the numbers are the same).

    Means and covariances merge without losing digits, so no earlier pass has to find where to shift; the
    sums follow from them. Rows with a null or NaN are counted but not used.
    """
    by = by or []
    ok = complete(nodes)
    x = df.select(*by, ok.alias("__ok"), *[F.when(ok, F.col(n).cast("double")).alias(f"x{i}")
                                           for i, n in enumerate(nodes)])
    at = {n: i for i, n in enumerate(nodes)}
    pairs = sorted({tuple(sorted((at[a], at[b]))) for a, b in (p for p in products if len(p) == 2)}
                   | {(i, i) for i in at.values()})
    aggs = [F.count(F.lit(1)).alias("__all"), F.count_if("__ok").alias("__n")]
    aggs += [F.avg(f"x{i}").alias(f"m{i}") for i in at.values()]
    merged: dict[tuple, dict] = {}
    for start in range(0, len(pairs), WIDE_MOMENTS):
        more = [F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs[start:start + WIDE_MOMENTS]]
        for row in (x.groupBy(*by) if by else x.groupBy()).agg(*aggs, *more).collect():
            merged.setdefault(tuple(row[c] for c in by), {}).update(row.asDict())
    rows = list(merged.values())
    used = [r for r in rows if r["__n"] > 0]
    n_ok = sum(r["__n"] for r in used)
    if n_ok < 2:
        raise ValueError("fewer than two complete rows: nothing to fit")
    mean = {n: sum(r["__n"] * r[f"m{i}"] for r in used) / n_ok for n, i in at.items()}
    sd = {}
    for n, i in at.items():
        var = sum(r["__n"] * (r[f"c{i}_{i}"] + (r[f"m{i}"] - mean[n]) ** 2) for r in used) / n_ok
        sd[n] = safe_scale(math.sqrt(max(var, 0.0)), mean[n])
    scale = Scale(mean, sd)
    out = {}
    for r in used:
        n = float(r["__n"])
        shift = {c: (r[f"m{i}"] - mean[c]) / sd[c] for c, i in at.items()}
        sums: dict[Term, float] = {}
        for p in products:
            if len(p) == 0:
                sums[p] = n
            elif len(p) == 1:
                sums[p] = n * shift[p[0]]
            else:
                i, j = sorted((at[p[0]], at[p[1]]))
                sums[p] = n * (r[f"c{i}_{j}"] / (sd[p[0]] * sd[p[1]]) + shift[p[0]] * shift[p[1]])
        out[tuple(r[c] for c in by)] = Moments(scale, sums)
    return out, n_ok, sum(r["__all"] for r in rows) - n_ok


def safe_scale(sd: float | None, mean: float) -> float:
    """A standard deviation to divide by; 1 for a column that does not vary."""
    return sd if sd and sd > 1e-12 * max(abs(mean), 1e-300) else 1.0


def collect_moments(df: DataFrame, nodes, designs, by: list[str] | None = None
                    ) -> tuple[dict[tuple, Moments], int, int]:
    """Moments for any designs: one pass if all terms are single columns, two if there are products."""
    products = needed_products(designs)
    if max(len(p) for p in products) <= 2:
        return linear_moments(df, nodes, products, by)
    scale, n_ok, n_dropped = profile(df, nodes)
    return moments(df.filter(complete(nodes)), scale, products, by), n_ok, n_dropped


def needed_products(designs: Iterable[tuple[str, tuple[Term, ...]]]) -> list[Term]:
    """Distinct products that the normal equations of all ``(node, terms)`` designs are made of."""
    need = {()}
    for node, terms in designs:
        axis = [()] + list(terms) + [(node,)]
        for a, b in combinations_with_replacement(axis, 2):
            need.add(tuple(sorted(a + b)))
    return sorted(need, key=lambda t: (len(t), t))


def moments(df: DataFrame, scale: Scale, products: list[Term], by: list[str] | None = None,
            weight: Column | None = None) -> dict[tuple, Moments]:
    """Weighted sums of products per group in one pass; rows fold up before the shuffle.

    ``df`` must hold complete rows. The result has one entry per group: folds, periods and replicates
    are few by construction.
    """
    by = by or []
    names = sorted({n for p in products for n in p})
    z = df.select(*by, *([weight.alias("__w")] if weight is not None else []),
                  *[((F.col(n).cast("double") - scale.mean[n]) / scale.sd[n]).alias(f"z{i}")
                    for i, n in enumerate(names)])
    at = {n: F.col(f"z{i}") for i, n in enumerate(names)}

    def total(product: Term) -> Column:
        x = F.col("__w").cast("double") if weight is not None else None
        for name in product:
            x = at[name] if x is None else x * at[name]
        return F.count(F.lit(1)).cast("double") if x is None else F.sum(x)

    out: dict[tuple, Moments] = {}
    for start in range(0, len(products), WIDE_MOMENTS):
        part = products[start:start + WIDE_MOMENTS]
        grouped = z.groupBy(*by) if by else z.groupBy()
        for row in grouped.agg(*[total(p).alias(f"s{i}") for i, p in enumerate(part)]).collect():
            entry = out.setdefault(tuple(row[c] for c in by), Moments(scale, {}))
            entry.sums.update({p: float(row[f"s{i}"] or 0.0) for i, p in enumerate(part)})
    return out


# --- solving -------------------------------------------------------------------------------------


def design_terms(kind: str, parents: tuple[str, ...]) -> tuple[Term, ...]:
    if kind in ROOT_KINDS or kind in ("mean", "gbt"):
        return ()
    linear = tuple((p,) for p in parents)
    if kind == "linear":
        return linear
    if kind == "poly":
        return linear + tuple(combinations_with_replacement(parents, 2))
    raise ValueError(f"unknown kind {kind!r}")


def solve_standard(m: Moments, node: str, terms: tuple[Term, ...]) -> np.ndarray:
    """Least squares on standardised columns: coefficients of the constant and the terms."""
    axis = [()] + list(terms)
    gram = np.array([[m.product(a, b) for b in axis] for a in axis]) / m.n
    right = np.array([m.product(a, (node,)) for a in axis]) / m.n
    size = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    scaled = gram / np.outer(size, size)
    if np.linalg.cond(scaled) > MAX_CONDITION:
        scaled = scaled + RIDGE * np.eye(len(axis))
    return np.linalg.solve(scaled, right / size) / size


def squared_error(m: Moments, node: str, terms: tuple[Term, ...], beta: np.ndarray) -> float:
    """Mean squared error of standardised coefficients on the rows behind ``m``, in data units."""
    axis = [()] + list(terms)
    gram = np.array([[m.product(a, b) for b in axis] for a in axis])
    right = np.array([m.product(a, (node,)) for a in axis])
    rss = m.product((node,), (node,)) - 2.0 * beta @ right + beta @ gram @ beta
    return float(max(rss / m.n, 0.0) * m.scale.sd[node] ** 2)


def to_raw(scale: Scale, node: str, terms: tuple[Term, ...], beta: np.ndarray) -> tuple[float, tuple[float, ...]]:
    """Coefficients for the columns as they are, from those for standardised columns."""
    raw: dict[Term, float] = {(): 0.0}
    for term, b in zip([()] + list(terms), beta):
        parts: dict[Term, float] = {(): float(b) * scale.sd[node]}
        for name in term:
            grown: dict[Term, float] = {}
            for t, c in parts.items():
                grown[tuple(sorted(t + (name,)))] = grown.get(tuple(sorted(t + (name,))), 0.0) + c / scale.sd[name]
                grown[t] = grown.get(t, 0.0) - c * scale.mean[name] / scale.sd[name]
            parts = grown
        for t, c in parts.items():
            raw[t] = raw.get(t, 0.0) + c
    return float(raw[()] + scale.mean[node]), tuple(float(raw.get(tuple(sorted(t)), 0.0)) for t in terms)


def solve(m: Moments, node: str, kind: str, parents: tuple[str, ...]) -> Mechanism:
    """A mechanism without the rows it draws noise from."""
    if kind in ROOT_KINDS:
        return Mechanism(node, kind, params={"noise_mean": m.mean(node), "noise_var": m.var(node), "n": m.n,
                                             "mean": m.mean(node), "total_var": m.var(node)})
    terms = design_terms(kind, parents)
    beta = solve_standard(m, node, terms)
    intercept, coef = to_raw(m.scale, node, terms, beta)
    total = m.var(node)
    left = squared_error(m, node, terms, beta) * m.n / max(m.n - 1.0, 1.0)
    exact = left <= NOISE_FLOOR * total
    return Mechanism(node, kind, parents, terms, coef, intercept,
                     params={"noise_var": 0.0 if exact else left, "total_var": total, "n": m.n,
                             "mean": m.mean(node),
                             "r2": 1.0 - left / total if total > 0 else 0.0})


# --- trees ---------------------------------------------------------------------------------------


def tree_value(tree, values: Mapping):
    """Value of a regression tree: a leaf is a number, a split ``[name, threshold, low side, high side]``."""
    if not isinstance(tree, list):
        return float(tree)
    name, threshold, low, high = tree
    a, b = tree_value(low, values), tree_value(high, values)
    if isinstance(values[name], Column):
        return F.when(values[name] <= threshold, a).otherwise(b)
    return np.where(np.asarray(values[name]) <= threshold, a, b)


def splits(tree):
    """``(name, threshold)`` of all splits of a tree."""
    if isinstance(tree, list):
        yield tree[0], tree[1]
        yield from splits(tree[2])
        yield from splits(tree[3])


def read_tree(text: str, names: Sequence):
    """A tree from its printed form: nested ``If``, ``Else`` and ``Predict`` lines."""
    lines = iter([line.strip() for line in text.splitlines() if re.match(r"\s*(If|Else|Predict)", line)])

    def node():
        line = next(lines)
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        next(lines)  # the matching Else
        return [names[int(feature)], float(threshold), low, node()]

    return node()


def interval_bounds(values: np.ndarray, counts: np.ndarray) -> list[float]:
    """Up to ``TREE_BINS - 1`` bounds between the sorted values of a column: all, or those at equal counts of rows."""
    between = (values[:-1] + values[1:]) / 2.0
    if len(between) < TREE_BINS:
        return between.tolist()
    share = counts.sum() / TREE_BINS
    bounds, target, below = [], share, counts.cumsum()
    for i, bound in enumerate(between):
        if abs(below[i] - target) < abs(below[i + 1] - target):
            bounds.append(float(bound))
            target += share
    return bounds


def tree_bounds(data: DataFrame, names) -> list[list[float]]:
    """Bounds of the intervals of columns without gaps, from all rows."""
    different = data.agg(*[F.approx_count_distinct(n).alias(f"d{i}") for i, n in enumerate(names)]).first()
    many = [n for i, n in enumerate(names) if different[f"d{i}"] > EXACT_VALUES]
    found = {}
    if many:
        shares = [i / TREE_BINS for i in range(1, TREE_BINS)]
        found = {n: sorted(set(q)) for n, q in zip(many, data.approxQuantile(many, shares, BOUND_ERROR))}
    for n in names:
        if n not in found:
            counted = data.groupBy(F.col(n).alias("x")).count().toPandas().sort_values("x")
            found[n] = interval_bounds(counted["x"].to_numpy(), counted["count"].to_numpy())
    return [found[n] for n in names]


def interval(name: str, bounds: list[float]) -> Column:
    """Number of the interval a row's value lies in, from 1; an upper bound belongs to its interval."""
    def between(first, last):
        if first == last:
            return first
        middle = (first + last) // 2
        return [name, bounds[middle - 1], between(first, middle), between(middle + 1, last)]

    found = tree_value(between(1, len(bounds) + 1), {name: F.col(name).cast("double")})
    return found if isinstance(found, Column) else F.lit(found)


def fit_trees(rows: DataFrame, node: str, parents: tuple[str, ...], trees: int = 20, depth: int = 4,
              seed: int = 0) -> Mechanism:
    """Boosted regression trees, kept as nested comparisons so that they evaluate as plain expressions.

    Trees tell rows apart by intervals of the parents, and squared error needs no more of rows that share all intervals
    than their number and mean. So all rows fold into such cells in one pass, and the rounds of boosting pass over cells.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    data = rows.select(F.col(node).cast("double").alias("label"), *[F.col(p).cast("double").alias(p) for p in parents])
    bounds = tree_bounds(data, parents)
    at = [f"i{i}" for i in range(len(parents))]
    cells = cut_lineage(data.select("label", *[interval(p, b).alias(i) for p, b, i in zip(parents, bounds, at)])
                        .groupBy(*at).agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight")))
    cells = VectorAssembler(inputCols=at, outputCol="features").transform(cells).select("label", "weight", "features")
    model = GBTRegressor(maxIter=trees, maxDepth=depth, seed=seed, maxBins=TREE_BINS + 2, weightCol="weight").fit(cells)

    def placed(tree):
        """The tree on the parents: it split numbers of intervals."""
        if not isinstance(tree, list):
            return tree
        i, split, low, high = tree
        return [parents[i], bounds[i][int(split) - 1], placed(low), placed(high)]

    terms = tuple((json.dumps(placed(read_tree(t.toDebugString, range(len(parents))))),) for t in model.trees)
    bare = Mechanism(node, "gbt", parents, terms, tuple(float(w) for w in model.treeWeights))
    x = F.col(node).cast("double")
    row = rows.select(x.alias("x"), (x - bare.predict_column({p: F.col(p).cast("double") for p in parents})).alias("r")).agg(
        F.avg("x").alias("mean"), F.var_samp("x").alias("total"), F.avg("r").alias("shift"), F.var_samp("r").alias("left"),
        F.count(F.lit(1)).alias("n")).first()
    exact = row.left <= NOISE_FLOOR * row.total
    return replace(bare, intercept=row.shift, params={
        "noise_var": 0.0 if exact else row.left, "total_var": row.total, "mean": row.mean, "n": float(row.n),
        "r2": 1.0 - row.left / row.total if row.total > 0 else 0.0})


# --- fitting -------------------------------------------------------------------------------------


def default_kinds(graph: CausalGraph, overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    kinds = {n: "linear" if graph.parents(n) else "empirical" for n in graph.nodes}
    for node, kind in (overrides or {}).items():
        if node not in kinds:
            raise KeyError(f"{node!r} is not a node of the graph")
        if kind not in KINDS or (kind in ROOT_KINDS) == bool(graph.parents(node)):
            raise ValueError(f"{kind!r} does not suit {node!r}")
        kinds[node] = kind
    return kinds


def first_rows(df: DataFrame, key: Column, nodes, size: int, seed: int = 0) -> np.ndarray:
    """``size`` rows picked by key hash, a uniform sample; the size is the caller's number of draws.

    Each task keeps its own ``size`` best rows, so nothing larger moves.
    """
    rows = (df.select(F.md5(F.concat_ws(":", key.cast("string"), F.lit("pool"), F.lit(str(seed))).cast("binary")).alias("__h"),
                      key.cast("string").alias("__k"), *[F.col(n).cast("double") for n in nodes])
            .orderBy("__h", "__k").limit(size).collect())
    return np.array([[r[n] for n in nodes] for r in rows], dtype=float).reshape(len(rows), len(nodes))


def keyed_rows(rows: DataFrame, key: Column, nodes) -> DataFrame:
    """``(__k, node...)``: key as text, nodes as doubles."""
    return rows.select(key.cast("string").alias("__k"), *[F.col(n).cast("double").alias(n) for n in nodes])


def noise_table(rows: DataFrame, key: Column, nodes, seed: int = 0, n: int = 1) -> NoiseTable:
    """All of ``rows`` (``n`` complete ones) by position; nothing is read before something is drawn."""
    return NoiseTable(RowOrder(keyed_rows(rows, key, nodes), nodes, seed, n))


def halfnorm_params(df: DataFrame, nodes) -> dict[str, dict[str, float]]:
    """Location (the minimum) and scale (root mean square above it) of half-normal roots, one pass.

    ``avg((x - min)^2)`` is taken apart into variance and squared mean distance, both of which merge.
    """
    if not nodes:
        return {}
    row = df.agg(*[e for i, n in enumerate(nodes) for e in (
        F.min(F.col(n).cast("double")).alias(f"lo{i}"), F.avg(F.col(n).cast("double")).alias(f"m{i}"),
        F.var_pop(F.col(n).cast("double")).alias(f"v{i}"))]).first()
    out = {}
    for i, n in enumerate(nodes):
        scale = math.sqrt(row[f"v{i}"] + (row[f"m{i}"] - row[f"lo{i}"]) ** 2)
        out[n] = {"loc": row[f"lo{i}"], "scale": scale,
                  "noise_mean": row[f"lo{i}"] + scale * math.sqrt(2.0 / math.pi),
                  "noise_var": scale * scale * (1.0 - 2.0 / math.pi)}
    return out


def fit(df: DataFrame, graph: CausalGraph, key: Column, kinds: Mapping[str, str] | None = None,
        pool: bool = True, seed: int = 0, nodes=None) -> CausalModel:
    """Fit all mechanisms: one pass for the sums (two if there are product terms); draws read the rows again when asked for.

    ``pool=False`` leaves the rows out of the model, for queries that draw no noise.
    ``kinds`` overrides the default family of single nodes. ``nodes`` limits the work to a set closed
    under parents, for queries about one target.
    """
    nodes = list(nodes or graph.order)
    kinds = default_kinds(graph, kinds)
    rows = df.filter(complete(nodes))
    designs = [(n, design_terms(kinds[n], graph.parents(n))) for n in nodes]
    groups, n_ok, n_dropped = collect_moments(df, nodes, designs)
    sums = groups[()]
    half = halfnorm_params(rows, [n for n in nodes if kinds[n] == "halfnorm"])
    mechanisms = {}
    for n in nodes:
        if kinds[n] == "gbt":
            mechanisms[n] = fit_trees(rows, n, graph.parents(n), seed=seed)
            continue
        m = solve(sums, n, kinds[n], graph.parents(n))
        mechanisms[n] = replace(m, params={**m.params, **half[n]}) if n in half else m
    model = CausalModel(graph, mechanisms, n_ok, n_dropped)
    return model.with_table(noise_table(rows, key, nodes, seed, n_ok)) if pool else model


def evaluate_nodes(nodes, mechanisms: Mapping[str, Mechanism], noise: Mapping[str, np.ndarray]) -> dict:
    """Values of all nodes from given noise, on arrays; for the bounded draws of a query."""
    values: dict[str, np.ndarray] = {}
    for n in nodes:
        values[n] = mechanisms[n].predict(values) + noise[n]
    return values


def draw_values(model: CausalModel, nodes, n: int, replicate=0, seed=0) -> tuple[dict, dict]:
    """``n`` joint draws on the driver: ``(noise, values)``. For draw counts that are a parameter."""
    prefetch([(model, nodes, n, replicate, seed)])
    noise = {v: model[v].noise_values(n, replicate, seed) for v in nodes}
    return noise, evaluate_nodes(nodes, model.mechanisms, noise)


def prefetch(draws) -> None:
    """Bring the rows behind all ``(model, nodes, n, replicate, seed)`` in one job."""
    fetch([(m[v].noise, m[v].noise_positions(n, replicate, seed).tolist()) for m, nodes, n, replicate, seed in draws
           for v in nodes if m[v].is_drawn])
