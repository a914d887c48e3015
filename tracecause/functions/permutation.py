"""Bijections of row positions, for draws without replacement that need no lookup.

A keyed permutation of 0..n-1 is made of Feistel rounds on pairs: with a = floor(sqrt(n)) and b = floor(n / a) a position
below a * b is a pair (position mod a, position div a), and each round adds to one part a hash of the other, modulo a or b.
The few positions from a * b on are reached by a second pass over the last a * b positions. Rounds are integer arithmetic
below 2^63, so that any SQL engine can follow them.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
ROUNDS = 4


def round_keys(label: str, replicate, seed: int) -> list[list[tuple[int, int, int]]]:
    """Per pass and round: what is added, and two factors, all below the prime."""
    out = []
    for half in range(2):
        keys = []
        for r in range(ROUNDS):
            digest = hashlib.md5(f"{label}:{replicate}:{seed}:{half}:{r}".encode()).hexdigest()
            keys.append(tuple(int(digest[8 * i:8 * i + 8], 16) % (PRIME - 1) + 1 for i in range(3)))
        out.append(keys)
    return out


def sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(n))
    return a, n // a


def mixed(v, key):
    c, m1, m2 = key
    t = (v + c) * m1 % PRIME
    return (t ^ (t >> 15)) * m2 % PRIME


def permuted_values(x: np.ndarray, n: int, label: str, replicate=0, seed: int = 0) -> np.ndarray:
    """Images of positions, on the driver."""
    a, b = sides(n)
    x = x.astype(np.int64)
    for half, keys in enumerate(round_keys(label, replicate, seed)):
        shift = half * (n - a * b)
        inside = (x >= shift) & (x < shift + a * b)
        left, right = (x - shift) % a, (x - shift) // a
        for r, key in enumerate(keys):
            if r % 2:
                right = (right + mixed(left, key)) % b
            else:
                left = (left + mixed(right, key)) % a
        x = np.where(inside, right * a + left + shift, x)
    return x


def with_permuted(df: DataFrame, source: str, name: str, n: int, label: str, replicate=0, seed: int = 0) -> DataFrame:
    """``df`` with a column ``name``: the images of the positions in ``source``. One projection per round, nothing moves."""
    a, b = sides(n)
    kept = df.columns
    df = df.withColumn("__x", F.col(source).cast("long"))
    for half, keys in enumerate(round_keys(label, replicate, seed)):
        shift = half * (n - a * b)
        df = df.selectExpr("*", f"(__x - {shift}L) % {a}L AS __l", f"(__x - {shift}L) div {a}L AS __r")
        for r, (c, m1, m2) in enumerate(keys):
            part, other, size = ("__r", "__l", b) if r % 2 else ("__l", "__r", a)
            df = df.withColumn("__t", F.expr(f"({other} + {c}L) * {m1}L % {PRIME}L"))
            df = df.withColumn(part, F.expr(f"({part} + (__t ^ shiftright(__t, 15)) * {m2}L % {PRIME}L) % {size}L"))
        inside = f"__x >= {shift}L AND __x < {shift + a * b}L"
        df = df.withColumn("__x", F.expr(f"CASE WHEN {inside} THEN __r * {a}L + __l + {shift}L ELSE __x END")).drop("__l", "__r", "__t")
    return df.select(*[F.col(f"`{c}`") for c in kept if c != name], F.col("__x").alias(name))
