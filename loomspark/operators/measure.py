"""Paired comparison, pass rates, continual learning, intervals and gates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats as X


def paired(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Both arms side by side (full outer on the task): task, a, b; a missing arm or mark stays NULL."""
    return a.select(key, F.col("passed").alias("a")).join(b.select(key, F.col("passed").alias("b")), key, "full_outer")


def majority(rows: DataFrame, key: str, passed: str) -> DataFrame:
    """passed: what most graded attempts of a task did; NULL on a tie."""
    n = rows.groupBy(key).agg(F.count_if(F.col(passed)).alias("p"), F.count_if(~F.col(passed)).alias("f"))
    return n.select(key, F.when(F.col("p") > F.col("f"), True).when(F.col("p") < F.col("f"), False).alias("passed"))


def two_by_two(pairs: DataFrame, *by: str) -> DataFrame:
    """Counts of the 2 × 2 table over fully graded pairs, what is unpaired, accuracies, wins of b, and the exact p."""
    t = pairs.groupBy(*by).agg(
        F.count_if(F.col("a") & F.col("b")).alias("both"), F.count_if(F.col("a") & ~F.col("b")).alias("losses"), F.count_if(~F.col("a") & F.col("b")).alias("wins"),
        F.count_if(~F.col("a") & ~F.col("b")).alias("neither"), F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("unpaired"),
        F.avg(F.when(F.col("b").isNotNull(), F.col("a").cast("double"))).alias("accuracy_a"), F.avg(F.when(F.col("a").isNotNull(), F.col("b").cast("double"))).alias("accuracy_b"),
    )
    return t.withColumn("p_value", X.sign_test(F.col("wins"), F.col("losses")))


def by_cluster(pairs: DataFrame, cluster: Column) -> DataFrame:
    """wins, losses, ties of clusters by the sign of their net result."""
    net = pairs.filter("a is not null and b is not null").groupBy(cluster.alias("cluster")).agg(F.signum(F.sum(F.col("b").cast("int") - F.col("a").cast("int"))).alias("s"))
    return net.agg(F.count_if(F.col("s") > 0).alias("wins"), F.count_if(F.col("s") < 0).alias("losses"), F.count_if(F.col("s") == 0).alias("ties"))


def frontier(rows: DataFrame, task: str, taught: str, passed: str) -> DataFrame:
    """By task: class always / frontier / taught / never / unmeasured by passes without and with teaching."""
    p = F.col(passed)
    t = rows.groupBy(task).agg(F.count_if(~F.col(taught) & p.isNotNull()).alias("n"), F.count_if(~F.col(taught) & p).alias("k"), F.count_if(F.col(taught) & p).alias("helped"), F.count(passed).alias("all_"))
    kind = F.when(F.col("all_") == 0, "unmeasured").when((F.col("n") > 0) & (F.col("k") == F.col("n")), "always").when(F.col("k") > 0, "frontier").when(F.col("helped") > 0, "taught").otherwise("never")
    return t.select(task, F.col("n").alias("trials"), F.col("k").alias("passes"), kind.alias("class"))


def stale_pass_rates(rows: DataFrame, key: str, version: str, passed: str, discount: float = 0.5) -> DataFrame:
    """Pass rate by key in which a trial counts half for every policy version that is newer."""
    newest = F.max(version).over(Window.partitionBy(key))
    w = rows.filter(F.col(passed).isNotNull()).withColumn("_w", F.pow(F.lit(discount), newest - F.col(version)))
    r = w.groupBy(key).agg(F.sum("_w").alias("weight"), (F.sum(F.col("_w") * F.col(passed).cast("double")) / F.sum("_w")).alias("rate"), F.count(F.lit(1)).alias("n"))
    return r.withColumn("band", F.when((F.col("rate") >= 0.9) & (F.col("n") >= 8), "retired").when(F.col("rate") >= 0.7, "easy").when(F.col("rate") > 0.2, "middle").otherwise("hard"))


def continual(cells: DataFrame) -> DataFrame:
    """Over cells (unit, task, stage, score; task k is learnt at stage k, stage 0 is before): accuracy at the end, backward
    transfer, forgetting and learning gain, as means over units of means over tasks. Missing cells stay missing."""
    last = F.max("stage").over(Window.partitionBy("unit"))
    c = cells.withColumn("last", last)
    t = c.groupBy("unit", "task").agg(
        F.max(F.when(F.col("stage") == F.col("last"), F.col("score"))).alias("end"), F.max(F.when(F.col("stage") == F.col("task"), F.col("score"))).alias("learnt"),
        F.max(F.when((F.col("stage") >= F.col("task")) & (F.col("stage") < F.col("last")), F.col("score"))).alias("peak"), F.max(F.when(F.col("stage") == F.col("task") - 1, F.col("score"))).alias("before"),
        F.max("last").alias("last"),
    )
    old = F.col("task") < F.col("last")
    u = t.groupBy("unit").agg(F.avg("end").alias("acc"), F.avg(F.when(old, F.col("end") - F.col("learnt"))).alias("bwt"), F.avg(F.when(old, F.col("peak") - F.col("end"))).alias("forgetting"), F.avg(F.col("learnt") - F.col("before")).alias("gain"))
    return u.agg(*[F.avg(x).alias(x) for x in ("acc", "bwt", "forgetting", "gain")])


def intraclass(rows: DataFrame, family: str, value: str) -> DataFrame:
    """One-way intraclass correlation with the corrected mean size, not below 0."""
    g = rows.filter(F.col(value).isNotNull()).groupBy(family).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    s = g.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.sum(F.col("n") * F.col("m")).alias("nm"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("nm2"), F.sum(F.col("n") * F.col("v")).alias("within"))
    between = (F.col("nm2") - F.col("nm") * F.col("nm") / F.col("N")) / (F.col("k") - 1)
    inner = F.col("within") / (F.col("N") - F.col("k"))
    n0 = (F.col("N") - F.col("n2") / F.col("N")) / (F.col("k") - 1)
    return s.select(F.greatest(F.lit(0.0), (between - inner) / (between + (n0 - 1) * inner)).alias("icc"), n0.alias("mean_size"))


def holm(tests: DataFrame, p: str, key: str) -> DataFrame:
    """Step-down adjusted p: the running maximum of (m - rank + 1) p, at most 1."""
    w = Window.orderBy(p, key)
    m = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    return tests.withColumn("_t", (m - F.row_number().over(w) + 1) * F.col(p)).withColumn("adjusted", F.least(F.lit(1.0), F.max("_t").over(w.rowsBetween(Window.unboundedPreceding, 0)))).drop("_t")


def e_process(bets: DataFrame, by: list[str], order: list[str], etas: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75), null: float = 0.5) -> DataFrame:
    """capital after each outcome d in -1 .. 1: the mean of the capitals of several bets, each multiplied by
    (1 - eta) + eta * y / null with y = (1 + d) / 2."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    y = (1 + F.col("d")) / 2
    capitals = [F.exp(F.sum(F.log((1 - e) + e * y / null)).over(w)) for e in etas]
    total = capitals[0]
    for c in capitals[1:]:
        total = total + c
    return bets.withColumn("capital", total / len(etas))


def e_process_log(bets: DataFrame, by: list[str], order: list[str], etas: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75), null: float = 0.5) -> DataFrame:
    """log_capital: the logarithm of the capital of `e_process`, which stays finite over any number of outcomes."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    y = (1 + F.col("d")) / 2
    logs = bets.withColumn("_l", F.array(*[F.sum(F.log((1 - e) + e * y / null)).over(w) for e in etas]))
    most = F.array_max("_l")
    return logs.withColumn("log_capital", most + F.log(F.aggregate("_l", F.lit(0.0), lambda acc, x: acc + F.exp(x - most)) / len(etas))).drop("_l")


def bootstrap_interval(families: DataFrame, by: str, seed: int = 0, resamples: int = 2000, level: float = 0.95) -> DataFrame:
    """by, low, high of the pooled sum / count when families (total, n) are resampled whole. Each family's multiplicity in
    each resample is a Poisson draw of its own hash, so families stay where they are and only one row of sums for each
    task and group is shuffled. NULL below two families."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for group, family, total, n in zip(batch["g"], batch["family"], batch["total"], batch["n"]):
                weights = np.random.default_rng([seed, int(family) & 0xFFFFFFFF]).poisson(1.0, resamples)
                s = sums.setdefault(group, [np.zeros(resamples), np.zeros(resamples), 0])
                s[0] += weights * total
                s[1] += weights * n
                s[2] += 1
        if sums:
            yield pd.DataFrame({"g": list(sums), "t": [s[0].tolist() for s in sums.values()], "c": [s[1].tolist() for s in sums.values()], "k": [s[2] for s in sums.values()]})

    kind = families.schema[by].dataType.simpleString()
    parts = families.select(F.col(by).alias("g"), "family", "total", "n").mapInPandas(partial, f"g {kind}, t array<double>, c array<double>, k bigint")
    sums = parts.select("g", "k", F.posexplode(F.arrays_zip("t", "c"))).groupBy("g", "pos").agg(F.sum("col.t").alias("t"), F.sum("col.c").alias("c"), F.sum("k").alias("k"))
    tail = (1 - level) / 2
    out = sums.filter("c > 0").withColumn("r", F.col("t") / F.col("c")).groupBy("g").agg(F.percentile("r", F.lit(tail)).alias("low"), F.percentile("r", F.lit(1 - tail)).alias("high"), F.max("k").alias("k"))
    return out.select(F.col("g").alias(by), F.when(F.col("k") >= 2, F.col("low")).alias("low"), F.when(F.col("k") >= 2, F.col("high")).alias("high"))


def metric_gate(requirements: DataFrame, evidence: DataFrame) -> DataFrame:
    """metric, verdict: each requirement (kind, bound) against its evidence (value, low, high); missing evidence fails as
    unmeasured."""
    j = requirements.join(evidence, "metric", "left")
    ok = F.when(F.col("kind") == "improves", F.col("low") > 0).when(F.col("kind") == "within", F.abs("value") <= F.col("bound")).when(F.col("kind") == "at_least", F.col("value") >= F.col("bound")).when(F.col("kind") == "covers", (F.col("low") <= F.col("bound")) & (F.col("bound") <= F.col("high"))).when(F.col("kind") == "not_worse_by", F.col("low") >= -F.col("bound"))
    return j.select("metric", F.when(ok.isNull(), "unmeasured").when(ok, "passed").otherwise("failed").alias("verdict"))


def plateau(rows: DataFrame, by: list[str], order: list[str], found: str, width: int) -> DataFrame:
    """rate of discoveries over a sliding window, and its share of the peak so far."""
    w = Window.partitionBy(*by).orderBy(*order)
    rate = F.avg(F.col(found).cast("double")).over(w.rowsBetween(-(width - 1), 0))
    return rows.withColumn("rate", rate).withColumn("_p", F.max("rate").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("of_peak", F.when(F.col("_p") > 0, F.col("rate") / F.col("_p"))).drop("_p")


def consistency(answers: DataFrame, task: str, answer: Column) -> DataFrame:
    """answer, n: the strict majority among at least three answers of a task; otherwise it abstains (NULL)."""
    c = answers.filter(answer.isNotNull()).groupBy(task, answer.alias("x")).agg(F.count(F.lit(1)).alias("k"))
    t = c.groupBy(task).agg(F.sum("k").alias("n"), F.max(F.struct("k", "x")).alias("best"))
    return t.select(task, "n", F.when((F.col("n") >= 3) & (2 * F.col("best.k") > F.col("n")), F.col("best.x")).alias("answer"))
