"""Time: overlaps, windows around events, what follows an action, clocks, point-in-time views, survival."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlaps(a_start: Column, a_stop: Column, b_start: Column, b_stop: Column) -> Column:
    """Half-open overlap; an instant overlaps a span that holds it."""
    instant = (a_start == a_stop) & (b_start <= a_start) & (a_start < b_stop) | (b_start == b_stop) & (a_start <= b_start) & (b_start < a_stop)
    same = (a_start == a_stop) & (b_start == b_stop) & (a_start == b_start)
    return (a_start < b_stop) & (b_start < a_stop) | instant | same


def overlap_join(left: DataFrame, right: DataFrame, by: list[str], width: int) -> DataFrame:
    """Pairs of rows of one group whose spans (start, stop as integers) overlap. Both sides are laid into buckets of
    `width`, so that the join is an equi-join whose keys stay small even where one group holds a third of all rows; a pair
    is taken from the bucket in which the later of the two starts."""
    bucket = lambda c: F.floor(c / F.lit(width))
    spread = lambda df, s, e: df.withColumn("_b", F.explode(F.sequence(bucket(F.col(s)), bucket(F.greatest(F.col(s), F.col(e) - 1)))))
    a = left.withColumnsRenamed({"start": "l_start", "stop": "l_stop"})
    b = right.withColumnsRenamed({"start": "r_start", "stop": "r_stop"})
    pairs = spread(a, "l_start", "l_stop").join(spread(b, "r_start", "r_stop"), [*by, "_b"])
    return pairs.filter(overlaps(F.col("l_start"), F.col("l_stop"), F.col("r_start"), F.col("r_stop")) & (F.col("_b") == bucket(F.greatest("l_start", "r_start")))).drop("_b")


def around(events: DataFrame, others: DataFrame, by: list[str], before: int, after: int) -> DataFrame:
    """For each event (at) the others (t) of its group in [at - before, at + after); without any width only t = at."""
    stop = F.col("at") + after + (1 if before + after == 0 else 0)
    windows = events.withColumns({"start": F.col("at") - before, "stop": stop})
    points = others.withColumns({"start": F.col("t"), "stop": F.col("t") + 1})
    return overlap_join(windows, points, by, max(1, before + after)).drop("l_start", "l_stop", "r_start", "r_stop")


def followed_by(actions: DataFrame, events: DataFrame, by: list[str], within: int) -> DataFrame:
    """Actions (start) after which an event (t) of the group comes within `within`; each action once."""
    bucket = lambda c: F.floor(c / F.lit(max(1, within)))
    a = actions.withColumn("_b", F.explode(F.array(bucket(F.col("start")), bucket(F.col("start")) + 1)))
    e = events.select(*by, "t").withColumn("_b", bucket(F.col("t"))).distinct()
    return a.alias("a").join(e.alias("e"), [*[F.col(f"a.{c}") == F.col(f"e.{c}") for c in [*by, "_b"]], (F.col("t") >= F.col("start")) & (F.col("t") <= F.col("start") + within)], "left_semi").drop("_b").distinct()


def resolve_clocks(mappings: list[tuple[str, str, int, int, float, int]], base: str) -> dict[str, tuple[float, float, int]]:
    """clock -> (slope, offset, uncertainty) to the base clock: both directions of each mapping, the surest of each pair,
    the fewest hops, ties by name. Clocks are few: a breadth-first walk on the driver."""
    best: dict[tuple[str, str], tuple[int, float, float]] = {}
    for src, dst, src_ref, dst_ref, slope, unsure in mappings:
        for a, b, k, o in ((src, dst, slope, dst_ref - slope * src_ref), (dst, src, 1 / slope, src_ref - dst_ref / slope)):
            if (a, b) not in best or unsure < best[a, b][0]:
                best[a, b] = (unsure, k, o)
    known, queue = {base: (1.0, 0.0, 0)}, deque([base])
    while queue:
        here = queue.popleft()
        for a, b in sorted(best):
            if b == here and a not in known:
                unsure, k, o = best[a, b]
                slope, offset, so_far = known[here]
                known[a] = (k * slope, slope * o + offset, so_far + unsure)
                queue.append(a)
    return known


def convert(at: Column, src_ref: Column, dst_ref: Column, slope: Column) -> Column:
    """An affine change of clock whose whole part is exact."""
    return dst_ref + (at - src_ref) + F.round((slope - 1) * (at - src_ref)).cast("long")


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, value: list[str], width: int | None = None) -> DataFrame:
    """Each left row with the latest right row of its group at or before it, without a range join. With a `width` (in units
    of `at`) groups are worked on bucket by bucket of time, and what a bucket leaves is carried to the next ones, so that a
    group that holds a third of all rows is spread over many tasks."""
    tagged = left.withColumn("_side", F.lit(1)).unionByName(right.select(*by, at, F.struct(*value).alias("_v")).withColumn("_side", F.lit(0)), allowMissingColumns=True)
    tagged = tagged.withColumn("_b", F.floor(F.col(at) / width) if width else F.lit(0))
    w = Window.partitionBy(*by, "_b").orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    filled = tagged.withColumn("_last", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1")
    if width:
        ends = tagged.groupBy(*by, "_b").agg(F.max_by("_v", F.when(F.col("_side") == 0, F.col(at))).alias("_end"))
        earlier = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
        filled = filled.join(carried, [*by, "_b"], "left").withColumn("_last", F.coalesce("_last", "_carry"))
    return filled.select(*left.columns, *[F.col(f"_last.{c}").alias(f"as_of_{c}") for c in value])


def point_in_time(observations: DataFrame, events: DataFrame, cuts: DataFrame, by: str) -> DataFrame:
    """By subject: what was known at its cut (last value and count of observations up to it) and what came after (first
    event). Nothing after the cut reaches an input."""
    known = observations.join(cuts, by).filter(F.col("t") <= F.col("cut")).groupBy(by).agg(F.max_by("value", F.struct("t", "value")).alias("last_value"), F.count("value").alias("n_known"))
    later = events.join(cuts, by).filter(F.col("t") >= F.col("cut")).groupBy(by).agg(F.min("t").alias("first_after"))
    return cuts.join(known, by, "left").join(later, by, "left")


def kaplan_meier(subjects: DataFrame, by: list[str]) -> DataFrame:
    """time, at_risk, events, survival by group; subjects have time and event (0 or 1)."""
    steps = subjects.groupBy(*by, "time").agg(F.sum("event").alias("events"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by).orderBy(F.desc("time"))
    risk = steps.withColumn("at_risk", F.sum("n").over(w))
    forward = Window.partitionBy(*by).orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    log = F.when(F.col("events") < F.col("at_risk"), F.log(1 - F.col("events") / F.col("at_risk")))
    gone = F.max(F.when(F.col("events") == F.col("at_risk"), 1).otherwise(0)).over(forward)
    return risk.withColumn("survival", F.when(gone == 1, 0.0).otherwise(F.exp(F.sum(log).over(forward)))).select(*by, "time", "at_risk", "events", "survival")


def sessions(events: DataFrame, by: list[str], at: str, gap: int) -> DataFrame:
    """Events numbered by session: a pause of more than `gap` begins a new one."""
    w = Window.partitionBy(*by).orderBy(at, "event_id")
    fresh = F.when(F.col(at) - F.lag(at).over(w) <= gap, 0).otherwise(1)
    return events.withColumn("_new", fresh).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
