"""Causal graphs.

Two shapes. :class:`CausalGraph` is the graph over the columns of a table: it is metadata, no larger
than a table is wide, and lives on the driver. The functions on ``(parent, child)`` DataFrames answer
the same questions for edge tables of any size and never gather a node's neighbours in one place.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecause.sources.workspace import cut_lineage


@dataclass(frozen=True)
class CausalGraph:
    """Directed acyclic graph over column names; a repeated edge counts once."""

    edges: tuple[tuple[str, str], ...]
    isolated: tuple[str, ...] = ()
    order: tuple[str, ...] = field(init=False, default=())

    def __post_init__(self):
        object.__setattr__(self, "edges", tuple(dict.fromkeys((str(p), str(c)) for p, c in self.edges)))
        level = self.levels()
        object.__setattr__(self, "order", tuple(sorted(level, key=lambda n: (level[n], n))))

    @classmethod
    def from_table(cls, edges: DataFrame) -> "CausalGraph":
        """A graph over columns is part of a query; edge tables of data stay tables (``parent_table`` and others)."""
        rows = edges.select("parent", "child").distinct().collect()
        return cls(tuple(sorted((r.parent, r.child) for r in rows)))

    def to_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.edges), "parent string, child string")

    def to_json(self) -> str:
        return json.dumps({"directed": True, "multigraph": False, "graph": {},
                           "nodes": [{"id": n} for n in self.order],
                           "links": [{"source": p, "target": c} for p, c in self.edges]})

    @classmethod
    def from_json(cls, text: str) -> "CausalGraph":
        data = json.loads(text)
        edges = tuple((link["source"], link["target"]) for link in data["links"])
        named = {n for e in edges for n in e}
        return cls(edges, tuple(n["id"] for n in data["nodes"] if n["id"] not in named))

    @property
    def nodes(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([n for edge in self.edges for n in edge] + list(self.isolated)))

    def parents(self, node: str) -> tuple[str, ...]:
        return tuple(sorted(p for p, c in self.edges if c == node))

    def children(self, node: str) -> tuple[str, ...]:
        return tuple(sorted(c for p, c in self.edges if p == node))

    def roots(self) -> tuple[str, ...]:
        return tuple(n for n in self.order if not self.parents(n))

    def _reach(self, node: str, step) -> set[str]:
        seen, frontier = set(), set(step(node))
        while frontier:
            seen |= frontier
            frontier = {n for f in frontier for n in step(f)} - seen
        return seen

    def ancestors(self, node: str) -> tuple[str, ...]:
        """Strict ancestors in topological order."""
        found = self._reach(node, self.parents)
        return tuple(n for n in self.order if n in found)

    def descendants(self, node: str) -> tuple[str, ...]:
        found = self._reach(node, self.children)
        return tuple(n for n in self.order if n in found)

    def closure(self, target: str) -> tuple[str, ...]:
        """The target and its ancestors in topological order: the nodes that get a score."""
        if target not in self.nodes:
            raise KeyError(f"{target!r} is not a node of the graph")
        return self.ancestors(target) + (target,)

    def levels(self) -> dict[str, int]:
        """Longest path from a root; raises on a cycle."""
        level: dict[str, int] = {}
        left, open_edges, depth = set(self.nodes), self.edges, 0
        while left:
            ready = left - {c for _, c in open_edges}
            if not ready:
                raise ValueError(f"the graph has a cycle among {sorted(left)}")
            level.update(dict.fromkeys(ready, depth))
            left -= ready
            open_edges = [e for e in open_edges if e[0] not in ready]
            depth += 1
        return level

    def invert(self) -> "CausalGraph":
        return CausalGraph(tuple((c, p) for p, c in self.edges), self.isolated)

    def relabel(self, names: dict[str, str]) -> "CausalGraph":
        return CausalGraph(tuple((names[p], names[c]) for p, c in self.edges),
                           tuple(names[n] for n in self.isolated))


def edge_table(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Distinct, non-null edges from any table with two name columns."""
    return (df.select(F.col(parent).cast("string").alias("parent"), F.col(child).cast("string").alias("child"))
            .dropna().distinct())


def node_table(edges: DataFrame) -> DataFrame:
    """Both ends of all edges, which are read once."""
    return edges.select(F.explode(F.array("parent", "child")).alias("node")).distinct()


def parent_table(edges: DataFrame) -> DataFrame:
    """Incoming edges with the in-degree of the child, one row per edge.

    Long on purpose: a child may have a third of all edges, and its parents never become one array.
    """
    degree = edges.groupBy("child").agg(F.count(F.lit(1)).alias("n_parents"))
    return edges.join(degree, "child").select("child", "parent", "n_parents")


def root_table(edges: DataFrame) -> DataFrame:
    parents = edges.select(F.col("parent").alias("node")).distinct()
    return parents.join(edges.select(F.col("child").alias("node")), "node", "left_anti")


def invert_table(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("child").alias("parent"), F.col("parent").alias("child"))


def ancestor_table(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Upstream closure: ``(node, hops)`` for all nodes from which some target can be reached.

    One frontier step per level of the graph. A node enters the frontier once, so the work is one
    visit per edge however many paths there are, and a cycle ends by itself.
    """
    edges = cut_lineage(edges)
    reached = None
    frontier = cut_lineage(targets.select("node").distinct())
    seen = frontier
    hops = 0
    while True:
        hops += 1
        step = (edges.join(frontier.withColumnRenamed("node", "child"), "child", "left_semi")
                .select(F.col("parent").alias("node")).distinct()
                .join(seen, "node", "left_anti"))
        frontier = cut_lineage(step)
        if frontier.isEmpty():
            break
        seen = seen.union(frontier)
        found = frontier.withColumn("hops", F.lit(hops))
        reached = found if reached is None else reached.union(found)
    if reached is None:
        return frontier.withColumn("hops", F.lit(0))
    return reached


def level_table(edges: DataFrame) -> DataFrame:
    """Topological level of every node: the longest path from a root.

    Each round takes the nodes with no open incoming edge and closes the edges that leave them. A round
    reads the edges and writes the nodes that are left; edges are never rewritten. What a round takes and what it
    closes is written too, so that a join with few of either moves no edges and no nodes. Nothing waits for the
    last nodes, and no edges are read for them.
    """
    edges = cut_lineage(edges)
    ends = edges.select(F.explode(F.array(F.struct(F.col("parent").alias("node"), F.lit(0).alias("open")),
                                          F.struct(F.col("child").alias("node"), F.lit(1).alias("open")))).alias("end"))
    open_edges = F.when(F.col("end.node").isNull(), 0).otherwise(F.col("end.open"))  # no edge is ever closed for a null
    left = cut_lineage(ends.groupBy("end.node").agg(F.sum(open_edges).alias("open")))
    done = None
    level = 0
    while not left.isEmpty():
        ready = left.filter(F.col("open") == 0).select("node")
        if ready.isEmpty():
            raise ValueError("the graph has a cycle")
        rows = ready.withColumn("level", F.lit(level))
        done = rows if done is None else done.union(rows)
        waiting = left.filter(F.col("open") > 0)
        if waiting.isEmpty():
            break
        taken = cut_lineage(ready.withColumnRenamed("node", "parent"))
        closed = cut_lineage(edges.join(taken, "parent", "left_semi")
                             .groupBy(F.col("child").alias("node")).agg(F.count(F.lit(1)).alias("closed")))
        left = cut_lineage(waiting.join(closed, "node", "left")
                           .select("node", (F.col("open") - F.coalesce("closed", F.lit(0))).alias("open")))
        level += 1
    if done is None:
        return left.select("node", F.lit(0).alias("level"))
    return done
