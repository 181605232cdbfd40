"""Splits that keep related records together.

Records that share a key, a speaker or a session form one component. Components start from a hashed assignment; parallel
annealing then moves and exchanges whole components to bring the sizes and labels of the splits nearer to their
proportions, and the best of several runs is kept.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import components
from ..session import cut
from .overlaps import split_name

SPLITS = ("train", "dev", "test")
PROPORTIONS = (0.8, 0.1, 0.1)
COMPONENTS_PER_BLOCK = 20_000
HEAVY = 1 / 1000
RUNS = 4
STEPS = 20_000
LABELS = ("fact", "rule", "procedure", "none")


def entity(column: Column) -> Column:
    """Trimmed, lower case, - for an inner blank or _; NULL for nothing."""
    name = F.regexp_replace(F.lower(F.trim(column)), r"[\s_]", "-")
    return F.when(name != "", name)


def energy(sizes: np.ndarray, labels: np.ndarray, want: np.ndarray, want_labels: np.ndarray) -> float:
    """Squared relative deviation of the splits' sizes, and with a tenth of the weight of their labels."""
    floor = max(1.0, want.sum() * 1e-9)
    return float((((sizes - want) / np.maximum(want, floor)) ** 2).sum() + 0.1 * (((labels - want_labels) / np.maximum(want_labels, floor)) ** 2).mean())


def anneal(weights: np.ndarray, labels: np.ndarray, start: np.ndarray, want: np.ndarray, seed: int, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """The best assignment found, and its energy. weights: records by component; labels: records by component and label;
    start: its split at first; want: records by split."""
    rng = np.random.default_rng(seed)
    n, k = len(weights), len(want)
    want_labels = np.outer(want / max(1.0, want.sum()), labels.sum(axis=0))
    now = start.copy()
    sizes = np.bincount(now, weights=weights, minlength=k)
    by_label = np.stack([np.bincount(now, weights=labels[:, j], minlength=k) for j in range(labels.shape[1])], axis=1)
    cost = energy(sizes, by_label, want, want_labels)
    best, best_cost = now.copy(), cost
    if n == 0:
        return best, best_cost
    picks, others, splits, luck = rng.integers(0, n, steps), rng.integers(0, n, steps), rng.integers(0, k, steps), rng.random(steps)
    heat = max(cost, 1e-6)
    for step in range(steps):
        i, j = int(picks[step]), int(others[step])
        old = now[i]
        swap = step % 2 == 1
        to = now[j] if swap else splits[step]
        if to == old:
            continue
        dw, dl = weights[i] - (weights[j] if swap else 0), labels[i] - (labels[j] if swap else 0)
        sizes[old] -= dw
        sizes[to] += dw
        by_label[old] -= dl
        by_label[to] += dl
        new = energy(sizes, by_label, want, want_labels)
        if new <= cost or luck[step] < math.exp(-(new - cost) / (heat * 0.1 * (1 - step / steps) ** 2 + 1e-12)):
            now[i] = to
            if swap:
                now[j] = old
            cost = new
            if cost < best_cost:
                best, best_cost = now.copy(), cost
        else:
            sizes[old] += dw
            sizes[to] -= dw
            by_label[old] += dl
            by_label[to] -= dl
    return best, best_cost


def hashed(ids: np.ndarray, proportions: tuple[float, ...], seed: int) -> np.ndarray:
    """A split for each id, by its hash."""
    mixed = (ids.astype(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return np.minimum(np.searchsorted(np.cumsum(proportions), (mixed >> np.uint64(11)).astype(np.float64) / 2**53, side="right"), len(proportions) - 1)


def assign(sizes: DataFrame, proportions: tuple[float, ...] = PROPORTIONS, seed: int = 0) -> DataFrame:
    """component, new_split for components with n and one column n_<label> for each label.

    Components of more than HEAVY of all records (at most 1/HEAVY of them) are settled first; the others follow in blocks
    of bounded size against what then is left, every block in RUNS runs of which the best is kept.
    """
    names = [f"n_{x}" for x in LABELS]
    total, count = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, want = total or 0, np.array(proportions) * float(total or 0)
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("run", T.IntegerType()), T.StructField("energy", T.DoubleType()), T.StructField("component", T.LongType()), T.StructField("new_split", T.StringType())])

    def searched(part: DataFrame, shares: np.ndarray, block: Column) -> DataFrame:
        def search(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("component")
            weights, labels = pdf["n"].to_numpy(float), pdf[names].to_numpy(float)
            start = hashed(pdf["component"].to_numpy(), tuple(shares), seed + int(key[1]))
            found, cost = anneal(weights, labels, start, shares * weights.sum(), seed + int(key[1]))
            return pd.DataFrame({"block": key[0], "run": key[1], "energy": cost, "component": pdf["component"], "new_split": [SPLITS[k] for k in found]})

        runs = part.withColumn("block", block).withColumn("run", F.explode(F.array(*[F.lit(r) for r in range(RUNS)])))
        tried = runs.groupBy("block", "run").applyInPandas(search, schema)
        best = F.min_by("new_split", F.struct("energy", "run"))
        return tried.groupBy("component").agg(best.alias("new_split"))

    bound = F.lit(total * HEAVY)
    heavy = cut(searched(sizes.filter(F.col("n") > bound), np.array(proportions), F.lit(0).cast("long")).join(sizes.select("component", "n"), "component"))
    taken = {r.new_split: r.s for r in heavy.groupBy("new_split").agg(F.sum("n").alias("s")).collect()}
    left = np.maximum(want - np.array([float(taken.get(s, 0)) for s in SPLITS]), 0)
    shares = left / left.sum() if left.sum() > 0 else np.array(proportions)
    blocks = max(1, math.ceil(count / COMPONENTS_PER_BLOCK))
    light = searched(sizes.filter(F.col("n") <= bound), shares, F.pmod(F.xxhash64("component", F.lit(7)), F.lit(blocks)))
    return heavy.select("component", "new_split").unionByName(light)


def grouped_splits(utterances: DataFrame, proportions: tuple[float, ...] = PROPORTIONS, seed: int = 0, edges_per_task: int = 2_000_000) -> DataFrame:
    """id, key, split (as given, NULL if undecided), component, parted (whether the component's records lie in more than
    one given split), new_split.

    Defined cases: ids delivered twice, and repeated rows, count once for each different key, speaker and session, and
    all their links hold; a NULL or blank key, speaker or session links nothing; a record without any of them is a
    component of its own; a NULL id takes no part; an unknown split counts as none; empty tables give no rows; other
    columns are ignored.
    """
    rows = cut(
        utterances.select("id", entity(F.col("key")).alias("key"), entity(F.col("speaker")).alias("speaker"), entity(F.col("session")).alias("session"), split_name(F.col("split")).alias("split"), F.lower(F.trim("kind")).alias("label"))
        .filter("id is not null")
        .distinct()
        .select("id", "key", "split", "label", *[F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), F.col(c))).alias(f"n_{c}") for c in ("key", "speaker", "session")], F.xxhash64(F.lit("id"), F.col("id")).alias("n_id"))
    )
    # an id links its own rows: each row's first node is that of its id only where the row has no other
    first = F.coalesce("n_key", "n_speaker", "n_session", "n_id")
    several = rows.groupBy("n_id").agg(F.min(first).alias("low"), F.max(first).alias("high")).filter("low <> high")
    edges = (
        rows.select(first.alias("a"), F.explode(F.array_compact(F.array("n_key", "n_speaker", "n_session", first))).alias("b"))
        .unionByName(rows.join(several.select("n_id"), "n_id", "left_semi").select(F.col("n_id").alias("a"), first.alias("b")))
    )
    of = components(edges, edges_per_task)
    placed = cut(rows.select("id", "key", "split", "label", first.alias("node")).join(of, "node").drop("node"))
    records = placed.groupBy("component", "id").agg(F.min("label").alias("label"), F.min("split").alias("low"), F.max("split").alias("high"))
    sizes = cut(
        records.groupBy("component").agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == x).alias(f"n_{x}") for x in LABELS], (F.min("low") < F.max("high")).alias("parted")
        )
    )
    chosen = assign(sizes, proportions, seed).join(sizes.select("component", F.coalesce("parted", F.lit(False)).alias("parted")), "component")
    return placed.join(chosen, "component").select("id", "key", "split", "component", "parted", "new_split")
