"""Deterministic sampling: draws come from hashes of a seed and an id, never from the order of rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import draw


def lowest_draws(rows: DataFrame, key: str, seed: str, share: float, by: list[str] | None = None) -> DataFrame:
    """The ceil(share * n) rows with the lowest draws, of all or of each group."""
    drawn = rows.withColumn("_u", draw(seed, F.col(key)))
    if by:
        w = Window.partitionBy(*by)
        return drawn.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_r", F.row_number().over(w.orderBy("_u", key))).filter(F.col("_r") <= F.ceil(F.col("_n") * share)).drop("_u", "_n", "_r")
    return drawn.orderBy("_u", key).limit(math.ceil(rows.count() * share)).drop("_u")


def capped(rows: DataFrame, by: list[str], key: str, seed: str, most: int) -> DataFrame:
    """At most `most` rows of each group, by draw."""
    w = Window.partitionBy(*by).orderBy(draw(seed, F.col(key)), key)
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).drop("_r")


def thinned(rows: DataFrame, by: list[str], order: list[str], share: float) -> DataFrame:
    """An even spread: row i is kept when floor(.5 + share * i) grows."""
    w = Window.partitionBy(*by).orderBy(*order)
    at = F.row_number().over(w)
    return rows.withColumn("_i", at).filter(F.floor(0.5 + share * F.col("_i")) > F.floor(0.5 + share * (F.col("_i") - 1))).drop("_i")


def weighted(rows: DataFrame, key: str, weight: Column, seed: str, most: int) -> DataFrame:
    """Weighted sampling without replacement: the highest u ** (1 / w), compared as ln(u) / w."""
    u = F.greatest(draw(seed, F.col(key)), F.lit(1e-300))
    return rows.withColumn("_k", F.when(weight > 0, F.log(u) / weight)).filter("_k is not null").orderBy(F.desc("_k"), key).limit(most).drop("_k")


def allocate(wanted: int, weights: dict[str, float], capacity: dict[str, int]) -> dict[str, int]:
    """Largest remainders under capacities: what a full group cannot take goes to the others."""
    out = {g: 0 for g in capacity}
    left, open_ = min(wanted, sum(capacity.values())), {g for g in capacity if weights.get(g, 0) > 0 and capacity[g] > 0}
    while left and open_:
        total = sum(weights[g] for g in open_)
        ideal = {g: left * weights[g] / total for g in open_}
        give = {g: min(int(ideal[g]), capacity[g] - out[g]) for g in open_}
        if not any(give.values()):
            for g in sorted(open_, key=lambda g: (-(ideal[g] - int(ideal[g])), g))[:left]:
                out[g] += 1
                left -= 1
        else:
            for g, n in give.items():
                out[g] += n
                left -= n
        open_ = {g for g in open_ if out[g] < capacity[g]}
    return out


def replay(rows: DataFrame, key: str, group: str, seed: str, wanted: int, weights: dict[str, float] | None = None) -> DataFrame:
    """A replay sample: places are allotted to groups (evenly, or by weights such as failure rates), then drawn in each.
    Only the sizes of the groups, which are few by contract, come to the driver."""
    sizes = {r[0]: r[1] for r in rows.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1))).collect()}
    places = allocate(wanted, weights or {g: 1.0 for g in sizes}, sizes)
    table = rows.sparkSession.createDataFrame([(g, n) for g, n in places.items() if n] or [("", 0)], [group, "_places"])
    w = Window.partitionBy(group).orderBy(draw(seed, F.col(key)), key)
    return rows.withColumn("_r", F.row_number().over(w)).join(F.broadcast(table), group).filter(F.col("_r") <= F.col("_places")).drop("_r", "_places")


def within_budget(rows: DataFrame, by: list[str], order: list, size: str, budget: float) -> DataFrame:
    """Rows in order while their running size stays within the budget."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_s", F.sum(size).over(w)).filter(F.col("_s") <= budget).drop("_s")
