"""Hash-based randomness.

Every random number is a function of ``(id, label, replicate, seed)``, so a result depends neither on
partitioning nor on the task that computes it, a lost executor recomputes the same numbers, and a SQL
engine can reproduce them.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496.0
TWO_POW_53 = 9007199254740992.0


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def uniform(row_id: Column, label, replicate=0, seed=0, method: str = "md5") -> Column:
    """Uniform number in [0, 1) for a row.

    ``md5`` can be checked against any SQL engine; ``xxhash64`` is several times cheaper and has no
    counterpart elsewhere.
    """
    parts = [_col(row_id).cast("string"), _col(label).cast("string"), _col(replicate).cast("string"),
             _col(seed).cast("string")]
    if method == "md5":
        head = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13)
        return F.conv(head, 16, 10).cast("double") / F.lit(TWO_POW_52)
    if method == "xxhash64":
        return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / F.lit(TWO_POW_53)
    raise ValueError(f"unknown hash method {method!r}")


def uniform_values(n: int, label: str, replicate=0, seed=0) -> np.ndarray:
    """The md5 numbers of :func:`uniform` for ids ``0..n-1``; for the bounded draws a model needs."""
    return keyed_uniform_values(range(n), label, replicate, seed)


def keyed_uniform_values(keys, label: str, replicate=0, seed=0) -> np.ndarray:
    """The md5 numbers of :func:`uniform` for given keys."""
    return uniform_matrix([str(k).encode() for k in keys], [f":{label}:{replicate}:{seed}".encode()])[0]


def uniform_matrix(keys: list[bytes], tails: list[bytes]) -> np.ndarray:
    """Tails x keys: the md5 numbers of :func:`uniform` where key and tail together are the hashed text."""
    md5 = hashlib.md5
    heads = b"".join([md5(k + t).digest()[:8] for t in tails for k in keys])
    return (np.frombuffer(heads, ">u8") >> np.uint64(12)).astype(np.float64).reshape(len(tails), len(keys)) / TWO_POW_52


def mixed_matrix(hashes: np.ndarray, replicates: int) -> np.ndarray:
    """Replicates x rows: uniform numbers from one 64-bit hash per row, a few array steps per replicate (splitmix64)."""
    out = np.empty((replicates, len(hashes)))
    for r in range(replicates):
        with np.errstate(over="ignore"):
            z = hashes.view(np.uint64) + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[r] = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / TWO_POW_53
    return out


def normal_from(u1: Column, u2: Column) -> Column:
    """Standard normal by Box-Muller; ``1 - u1`` keeps the logarithm finite."""
    return F.sqrt(-2.0 * F.log(1.0 - u1)) * F.cos(2.0 * math.pi * u2)


def normal_values(u1: np.ndarray, u2: np.ndarray) -> np.ndarray:
    return np.sqrt(-2.0 * np.log(1.0 - u1)) * np.cos(2.0 * math.pi * u2)


def poisson_thresholds(terms: int = 13) -> list[float]:
    """Cumulative probabilities of Poisson(1) at 0, 1, 2, ..."""
    total, out = 0.0, []
    for k in range(terms):
        total += math.exp(-1.0) / math.factorial(k)
        out.append(total)
    return out


def poisson_weight(u: Column) -> Column:
    """Poisson(1) count by inverting the distribution function."""
    chain = F.when(u < poisson_thresholds()[0], 0)
    for count, limit in enumerate(poisson_thresholds()[1:], start=1):
        chain = chain.when(u < limit, count)
    return chain.otherwise(len(poisson_thresholds())).cast("int")


def poisson_values(u: np.ndarray) -> np.ndarray:
    return np.searchsorted(poisson_thresholds(), u, side="right")


def double_array(values) -> Column:
    """An array literal. Written as text and folded once by the optimizer, so a bounded pool of some
    thousand numbers costs one expression and not one per number."""
    if len(values) == 0:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def rank_steps(name: str, size: int, test: str) -> list[str]:
    """SQL for how many leading elements of the sorted array ``__ref`` pass a test, by binary search.

    Each halving is a column that refers to the one before: a dozen integer steps of generated code per
    row, where a scan of the array would cost one interpreted call per element.
    """
    steps, last, step = [], "0", 1 << (size.bit_length() - 1)
    while step:
        here = f"{last} + {step}"
        now = f"__{name}{step}" if step > 1 else name
        element = f"element_at(__ref, least({here}, {size}))"
        steps.append(f"CASE WHEN {here} <= {size} AND {element} {test} THEN {here} ELSE {last} END AS {now}")
        last, step = now, step >> 1
    return steps
