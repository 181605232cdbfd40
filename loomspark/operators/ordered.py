"""Running totals and ranks over all rows without bringing them into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_total(rows: DataFrame, score: str, key: str, size: str | None, out: str, buckets: int = 200) -> DataFrame:
    """`out`: the sum of `size` (the count, where it is None) of this row and all before it, by score from high to low, NULL
    last, ties by key. Rows are laid into buckets by approximate quantiles of the score (at most `buckets` numbers come to
    the driver), summed within each bucket, and moved on by what the buckets before hold."""
    shares = [k / buckets for k in range(1, buckets)]
    edges = rows.agg(F.percentile_approx(score, shares, 10_000)).first()[0] or []
    edges = sorted({float(e) for e in edges if e == e})
    higher = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e > F.col(score))) if edges else F.lit(0)
    amount = F.col(size) if size else F.lit(1)
    laid = rows.withColumn("_b", F.when(F.col(score).isNull(), len(edges) + 1).otherwise(higher)).withColumn("_a", amount)
    sums = laid.groupBy("_b").agg(F.sum("_a").alias("_s"))
    before = sums.select("_b", F.coalesce(F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    w = Window.partitionBy("_b").orderBy(F.desc_nulls_last(score), key).rowsBetween(Window.unboundedPreceding, 0)
    within = laid.withColumn("_w", F.sum("_a").over(w))
    return within.join(F.broadcast(before), "_b").withColumn(out, F.col("_before") + F.col("_w")).drop("_b", "_a", "_w", "_before")
