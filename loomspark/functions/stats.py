"""Statistics as column expressions, and exact tails for small counts."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def wilson(successes: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """The Wilson interval of a share; NULL without trials."""
    p = successes / n
    base = 1 + z * z / n
    middle = (p + z * z / (2 * n)) / base
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / base
    low, high = F.greatest(F.lit(0.0), middle - half), F.least(F.lit(1.0), middle + half)
    return F.when(n > 0, low), F.when(n > 0, high)


def sign_test(wins: Column, losses: Column) -> Column:
    """One-sided exact P(Bin(n, 1/2) >= wins), ties left out, summed in logarithms; 1 without trials."""
    n = (wins + losses).cast("int")
    log_choose = lambda k: F.aggregate(F.sequence(F.lit(0), k), F.lit(0.0), lambda acc, i: acc + F.when(i == 0, 0.0).otherwise(F.log((n - i + 1).cast("double")) - F.log(i.cast("double"))))
    tail = F.aggregate(F.sequence(wins.cast("int"), n), F.lit(0.0), lambda acc, k: acc + F.exp(log_choose(k) - n * math.log(2)))
    return F.when(n <= 0, 1.0).otherwise(F.least(F.lit(1.0), tail))


def alpha_spent(alpha: float, generation: Column) -> Column:
    """What generation g may spend of alpha: alpha / (g (g + 1))."""
    return F.lit(alpha) / (generation * (generation + 1))


def binomial_tail(n: int, k: int, p: float = 0.5) -> float:
    """P(Bin(n, p) >= k)."""
    if k <= 0:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k, n + 1)]
    return min(1.0, math.fsum(map(math.exp, logs)))


def critical_wins(n: int, alpha: float = 0.05) -> int | None:
    """The least number of wins among n untied pairs that is significant; None if none is."""
    return next((k for k in range(n + 1) if binomial_tail(n, k) <= alpha), None)


def power(n: int, p: float, alpha: float = 0.05) -> float:
    """The chance of a significant result when each untied pair is won with probability p."""
    k = critical_wins(n, alpha)
    return 0.0 if k is None else binomial_tail(n, k, p)


def detectable(n: int, alpha: float = 0.05, wanted: float = 0.8) -> float | None:
    """The least win probability, to a thousandth, that is found with the wanted power."""
    return next((p / 1000 for p in range(501, 1000) if power(n, p / 1000, alpha) >= wanted), None)
