"""Splits that never part a group: drawn, temporal, by source, folds and holdouts, and the gates that check them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import draw


def drawn_split(members: DataFrame, group: str, seed: str, shares: dict[str, float]) -> DataFrame:
    """part by one draw for each group."""
    part, edge = F.lit(list(shares)[-1]), 0.0
    cases = F
    for name, share in shares.items():
        edge = round(edge + share, 12)
        cases = cases.when(F.col("_u") < edge, name)
    part = cases.otherwise(part)
    return members.withColumn("_u", draw(seed, F.col(group))).withColumn("part", part).drop("_u")


def temporal_split(members: DataFrame, group: str, at: str, cutoff: object, seed: str, validation: float) -> DataFrame:
    """part and dropped: groups wholly after the cutoff are the test part, groups that straddle it are dropped, the rest is
    drawn into train and validation."""
    w = Window.partitionBy(group)
    late = F.col(at) > F.lit(cutoff)
    sides = members.withColumn("_any", F.max(late.cast("int")).over(w)).withColumn("_all", F.min(late.cast("int")).over(w))
    straddles = F.col("_any") != F.col("_all")
    part = F.when(straddles, None).when(F.col("_all") == 1, "test").when(draw(seed, F.col(group)) < validation, "validation").otherwise("train")
    return sides.withColumn("part", part).withColumn("dropped", F.when(straddles, "straddles_cutoff")).drop("_any", "_all")


def temporal_bands(members: DataFrame, group: str, at: str, edges: list[object]) -> DataFrame:
    """band (0 .. len(edges)) for groups that lie in one; the others are dropped as spanning bands."""
    band = F.lit(0)
    for e in edges:
        band = band + F.when(F.col(at) >= F.lit(e), 1).otherwise(0)
    banded = members.withColumn("_b", band)
    w = Window.partitionBy(group)
    low, high = F.min("_b").over(w), F.max("_b").over(w)
    return banded.withColumn("band", F.when(low == high, F.col("_b"))).withColumn("dropped", F.when(low != high, "spans_bands")).drop("_b")


def leave_one_source_out(members: DataFrame, group: str, source: str) -> DataFrame:
    """One row for each member and left-out source: test where its source is left out, train elsewhere; groups in several
    sources are dropped. The rows are members times sources, so sources are few by contract."""
    w = Window.partitionBy(group)
    kept = members.withColumn("_one", F.min(source).over(w) == F.max(source).over(w)).filter("_one").drop("_one")
    sources = members.select(F.col(source).alias("left_out")).filter("left_out is not null").distinct()
    return kept.join(F.broadcast(sources)).withColumn("part", F.when(F.col(source) == F.col("left_out"), "test").otherwise("train"))


def verify_disjoint(parts: DataFrame, group: str, member: str) -> DataFrame:
    """check, violations: counts only, never identities."""
    across = lambda key: parts.groupBy(key).agg(F.count_distinct("part").alias("n")).filter("n > 1").agg(F.count(F.lit(1)).alias("violations")).withColumn("check", F.lit(f"{key} in several parts"))
    return across(group).unionByName(across(member)).select("check", "violations")


def modal_stratum(members: DataFrame, group: str, stratum: str) -> DataFrame:
    """Each group's most frequent stratum, ties to the smaller name, and its size."""
    counts = members.groupBy(group, stratum).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(group).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(stratum).alias("s"))).alias("m"), F.sum("n").alias("size")).select(group, F.col("m.s").alias("stratum"), "size")


def folds(members: DataFrame, group: str, stratum: str, k: int, seed: str) -> DataFrame:
    """group, stratum, size, fold: within each stratum the largest groups go first into the least-filled fold, in seeded
    order among equals. Only groups are dealt, stratum by stratum."""
    groups = modal_stratum(members, group, stratum).withColumn("u", draw(seed, F.col(group)))

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "u", group], ascending=[False, True, True])
        filled = np.zeros(k)
        fold = []
        for size in pdf["size"]:
            at = int(filled.argmin())
            filled[at] += size
            fold.append(at)
        return pdf.assign(fold=fold)[[group, "stratum", "size", "fold"]]

    kind, stratum_kind = groups.schema[group].dataType.simpleString(), groups.schema["stratum"].dataType.simpleString()
    return groups.groupBy("stratum").applyInPandas(deal, f"`{group}` {kind}, stratum {stratum_kind}, size bigint, fold int")


def interleaved(groups: DataFrame, stratum: str, size: str, seed: str, key: str) -> DataFrame:
    """position: where the middle of a group lies within its stratum, in seeded order, as a share of the stratum."""
    order = Window.partitionBy(stratum).orderBy(draw(seed, F.col(key)), key)
    upto = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return groups.withColumn("position", (upto - F.col(size) / 2) / F.sum(size).over(Window.partitionBy(stratum)))


def holdout(groups: DataFrame, stratum: str, size: str, seed: str, key: str, share: float = 0.1) -> DataFrame:
    """held_out: groups in interleaved order until the held-out units reach the share; a group that starts beyond is kept.
    The running sum is taken over buckets of positions first, so no single task sees all groups."""
    placed = interleaved(groups, stratum, size, seed, key)
    buckets = placed.withColumn("_b", F.floor(F.col("position") * 1000))
    sums = buckets.groupBy("_b").agg(F.sum(size).alias("_s"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_b", "_before")
    total = sums.agg(F.sum("_s").alias("_total"))
    inner = F.coalesce(F.sum(size).over(Window.partitionBy("_b").orderBy("position", key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    run = buckets.withColumn("_inner", inner).join(F.broadcast(before), "_b").join(F.broadcast(total))
    return run.withColumn("held_out", (F.col("_before") + F.col("_inner")) < F.col("_total") * share).drop("_b", "_before", "_inner", "_total")


def bands_of(at: Column, edges: list) -> Column:
    """How many edges lie at or before a time."""
    out = F.lit(0)
    for e in edges:
        out = out + F.when(at >= F.lit(e), 1).otherwise(0)
    return out
