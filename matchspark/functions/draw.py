"""Seeded, reproducible weighted draws.

The original draws a weather condition per game with an unseeded random
generator.  Here the uniform number is a pure function of the game key and
a seed, so a re-run (or a retried task) gives the same draw.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 53


def hash_uniform(key: Column, seed: int = 0) -> Column:
    """u in [0, 1) from ``xxhash64(key, seed)``."""
    return (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << _BITS)).cast("double")
            / F.lit(float(1 << _BITS)))


def arithmetic_uniform(key: Column, seed: int = 0, modulus: int = 10_000,
                       multiplier: int = 7919) -> Column:
    """u = ((key * multiplier + seed) mod modulus) / modulus — portable to
    any SQL engine (used to cross-check against an oracle)."""
    return (F.pmod(key.cast("long") * F.lit(multiplier) + F.lit(seed), F.lit(modulus)).cast("double")
            / F.lit(float(modulus)))


def weighted_choice(u: Column, categories: Sequence[str], weights: Sequence[Column]) -> Column:
    """First category whose cumulative weight exceeds ``u * total``
    (inverse CDF, like ``random.choices``); zero weights never win."""
    cum = []
    acc = None
    for w in weights:
        acc = w if acc is None else acc + w
        cum.append(acc)
    target = u * cum[-1]
    expr = None
    for cat, c in zip(categories, cum):
        expr = F.when(c > target, F.lit(cat)) if expr is None else expr.when(c > target, F.lit(cat))
    return expr.otherwise(F.lit(categories[-1]))
