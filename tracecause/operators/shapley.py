"""Coalitions and Shapley weights.

A plan lists the coalitions to evaluate and, per player, the factor of each coalition's value in the
player's share. With all 2^k coalitions the shares are exact, which is the default up to ``EXACT_PLAYERS``; beyond that, or
where ``orderings`` are asked for, they are averages over sampled orderings. Orderings come in pairs, one the reverse of
the other; coalitions met twice are evaluated once; and the spread between batches of pairs tells the error.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import factorial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracecause.functions.randomness import double_array, uniform_values

EXACT_PLAYERS = 20   # a million coalitions
LONG_PLAYERS = 62    # up to here a coalition is the bits of one long, beyond a text of zeros and ones
ORDERINGS = 128
BATCHES = 16


@dataclass(frozen=True)
class CoalitionPlan:
    players: tuple[str, ...]
    masks: tuple[int, ...]
    factors: np.ndarray  # coalition x player
    batches: np.ndarray | None = None  # batch x coalition x player: factors of parts of the orderings

    @property
    def size(self) -> int:
        return len(self.masks)

    @property
    def is_exact(self) -> bool:
        return self.batches is None

    @property
    def is_wide(self) -> bool:
        return len(self.players) > LONG_PLAYERS

    def inside(self) -> np.ndarray:
        """Coalition x player: is the player in it?"""
        return np.array([[mask >> j & 1 for j in range(len(self.players))] for mask in self.masks], dtype=bool)

    def explode(self, df: DataFrame, column: str = "coalition") -> DataFrame:
        """One copy of each row per coalition, ``coalition`` being its mask and ``slot`` its position."""
        slots = F.explode(F.sequence(F.lit(0), F.lit(self.size - 1)))
        out = df.select("*", slots.alias("slot"))
        mask = F.col("slot").cast("long") if self.is_exact else F.element_at(self.mask_array(), F.col("slot") + 1)
        return out.withColumn(column, mask)

    def mask_array(self) -> Column:
        if self.is_wide:
            return F.split(F.lit(",".join(bin(m)[2:].zfill(len(self.players))[::-1] for m in self.masks)), ",")
        return F.split(F.lit(",".join(map(str, self.masks))), ",").cast("array<bigint>")

    def has(self, player: str, column: str = "coalition") -> Column:
        at = self.players.index(player)
        if self.is_wide:
            return F.substring(column, at + 1, 1) == "1"
        return F.shiftright(F.col(column), at).bitwiseAND(F.lit(1)) == 1

    def errors(self, values: np.ndarray) -> np.ndarray:
        """Standard error of each player's share from the values of all coalitions; zero where shares are exact."""
        if self.batches is None or len(self.batches) < 2:
            return np.zeros(len(self.players))
        return np.einsum("c,bcp->bp", values, self.batches).std(axis=0, ddof=1) / np.sqrt(len(self.batches))

    def shares_with_errors(self, values: DataFrame, value: Column) -> DataFrame:
        """``(node, score, error)`` from one row per coalition; their number is a parameter, and they come to the driver."""
        rows = values.select("slot", value.cast("double").alias("v")).toArrow()
        v = np.zeros(self.size)
        v[rows.column("slot").to_numpy()] = rows.column("v").to_numpy()
        out = zip(self.players, (v @ self.factors).tolist(), self.errors(v).tolist())
        return values.sparkSession.createDataFrame(list(out), "node string, score double, error double")

    def shares(self, values: DataFrame, value: Column, by=(), slot: str = "slot") -> DataFrame:
        """Long ``(by..., node, score)`` from one row per key and coalition: a single aggregate."""
        sums = [F.sum(F.element_at(double_array(self.factors[:, j]), F.col(slot) + 1) * value).alias(f"__p{j}")
                for j in range(len(self.players))]
        wide = values.groupBy(*by).agg(*sums)
        return unpivot_players(wide, self.players, by)


def unpivot_players(wide: DataFrame, players, by=(), errors: bool = False) -> DataFrame:
    rows = [F.struct(F.lit(p).alias("node"), F.col(f"__p{j}").alias("score"), *([F.col(f"__e{j}").alias("error")] if errors else []))
            for j, p in enumerate(players)]
    return wide.select(*by, F.inline(F.array(*rows)))


def coalition_plan(players, orderings: int | None = None, seed: int = 0) -> CoalitionPlan:
    players = tuple(players)
    k = len(players)
    if orderings is None and k <= EXACT_PLAYERS:
        weight = [factorial(s) * factorial(k - s - 1) / factorial(k) for s in range(k)]
        masks = np.arange(1 << k)
        member = (masks[:, None] >> np.arange(k)) & 1 == 1
        size = member.sum(axis=1)
        ahead, behind = np.array(weight + [0.0])[size], np.array([0.0] + weight)[size]
        return CoalitionPlan(players, tuple(masks.tolist()), np.where(member, behind[:, None], -ahead[:, None]))
    orderings = ORDERINGS if orderings is None else orderings
    if orderings < 1:
        raise ValueError("at least one ordering")
    met: dict[int, int] = {}
    steps = []  # (ordering, player, coalition before, coalition after)
    for r in range(orderings):
        order = np.argsort(uniform_values(k, "ordering", r // 2, seed), kind="stable")
        mask = 0
        for j in (order[::-1] if r % 2 else order).tolist():
            steps.append((r, j, met.setdefault(mask, len(met)), met.setdefault(mask | 1 << j, len(met))))
            mask |= 1 << j
    place = np.empty(len(met), np.int64)
    place[[met[m] for m in sorted(met)]] = np.arange(len(met))
    r, j, low, high = np.array(steps).T
    count = min(BATCHES, (orderings + 1) // 2)
    batch = r // 2 % count
    size = np.bincount(batch[j == 0], minlength=count)
    batches = np.zeros((count, len(met), k))
    np.add.at(batches, (batch, place[high], j), 1.0 / size[batch])
    np.add.at(batches, (batch, place[low], j), -1.0 / size[batch])
    factors = np.einsum("b,bcp->cp", size / orderings, batches)
    return CoalitionPlan(players, tuple(sorted(met)), factors, batches)
