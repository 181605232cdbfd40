"""The record graph: declarative queries, neighbours, reachability, ancestors, order, components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: So many edges (32 MB of numbers) are contracted in one task.
EDGES_PER_TASK = 2_000_000


@dataclass
class RecordQuery:
    """Predicates over the record envelope; kinds are alternatives, everything else must hold. All of it reaches the scan."""

    kinds: list[str] = field(default_factory=list)
    equal: dict[str, object] = field(default_factory=dict)
    start: object = None
    stop: object = None
    most: int | None = None

    def run(self, records: DataFrame, key: str = "id", kind: str = "kind", at: str = "at") -> DataFrame:
        """Matching records, each id once (the first copy by time), the lowest ids if limited."""
        if self.kinds:
            records = records.filter(F.col(kind).isin(*self.kinds))
        for name, value in self.equal.items():
            records = records.filter(F.col(name) == value)
        if self.start is not None:
            records = records.filter(F.col(at) >= F.lit(self.start))
        if self.stop is not None:
            records = records.filter(F.col(at) < F.lit(self.stop))
        first = first_of_each(records, [key], [at])
        return first.orderBy(key).limit(self.most) if self.most is not None else first


def first_of_each(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group. A partial aggregate, so that a hot group is reduced before the shuffle."""
    rest = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(*order, *[F.xxhash64(*[F.col(c) for c in rest])])).alias("_r")).select(*by, "_r.*").select(*rows.columns)


def neighbours(edges: DataFrame, of: DataFrame, relation: str | None = None, backwards: bool = False) -> DataFrame:
    """node, neighbour along out-edges (or in-edges) of one relation or all."""
    src, dst = ("dst", "src") if backwards else ("src", "dst")
    kept = edges if relation is None else edges.filter(F.col("rel") == relation)
    return kept.join(of.select(F.col("node").alias(src)), src).select(F.col(src).alias("node"), F.col(dst).alias("neighbour")).distinct()


def reachable(edges: DataFrame, start: DataFrame, relation: str | None = None, backwards: bool = False, most: int = 1_000) -> DataFrame:
    """node, depth of all nodes that can be reached from `start` (depth 0), by breadth; cycles end by the anti-join."""
    src, dst = ("dst", "src") if backwards else ("src", "dst")
    kept = edges if relation is None else edges.filter(F.col("rel") == relation)
    step = kept.select(F.col(src).alias("node"), F.col(dst).alias("to")).filter("node is not null and to is not null").distinct()
    seen = cut(start.select("node").distinct().withColumn("depth", F.lit(0)))
    front = seen
    for depth in range(1, most + 1):
        found = front.select("node").join(step, "node").select(F.col("to").alias("node")).distinct().join(seen.select("node"), "node", "left_anti")
        front = cut(found.withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            return seen
        seen = cut(seen.unionByName(front)) if depth % 8 == 0 else seen.unionByName(front)
    raise RuntimeError(f"no end after {most} steps")


def ancestors(parents: DataFrame, most: int = 40) -> DataFrame:
    """node, root, depth along a parent column, by pointer doubling: the depth doubles with every join. A cycle is an error."""
    known = parents.select("node").distinct()
    jump = cut(
        parents.select("node", "parent").join(known.select(F.col("node").alias("parent"), F.lit(True).alias("there")), "parent", "left")
        .select("node", F.when(F.col("there"), F.col("parent")).otherwise(F.col("node")).alias("to"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"))
    )
    for _ in range(most):
        next_ = jump.select(F.col("node").alias("to"), F.col("to").alias("further"), F.col("depth").alias("more"))
        jumped = cut(jump.join(next_, "to").select("node", F.col("further").alias("to"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") > 0).alias("moved")))
        jump = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return jump.select("node", F.col("to").alias("root"), "depth")
    raise RuntimeError("the parents form a cycle")


def topological_levels(nodes: DataFrame, needs: DataFrame, most: int = 1_000) -> DataFrame:
    """node, level: 0 without needs, else one above the highest need. What is left in a cycle gets NULL."""
    todo, done, level = nodes.select("node").distinct(), None, 0
    edges = needs.select("node", "needs").distinct()
    while level < most:
        blocked = edges.join(todo.select(F.col("node").alias("needs")), "needs", "left_semi").select("node").distinct()
        ready = cut(todo.join(blocked, "node", "left_anti").withColumn("level", F.lit(level)))
        if ready.isEmpty():
            break
        done = ready if done is None else done.unionByName(ready)
        todo = cut(todo.join(ready, "node", "left_anti"))
        level += 1
    rest = todo.withColumn("level", F.lit(None).cast("int"))
    return rest if done is None else done.unionByName(rest)


def local_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, each with the least node of its component among these edges."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def components(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """node, component (its least node) for edges a, b of bigints.

    Each task first contracts the edges it holds, so that a component becomes a star there; what joins the stars of
    different tasks is found by alternating large-star and small-star steps, each behind a written table, until nothing
    changes. No task ever holds more than about `edges_per_task` edges of the contraction, and a node with very many
    neighbours is spread over all tasks there.
    """
    edges = cut(edges.select("a", "b").distinct())
    parts = max(1, math.ceil(edges.count() / edges_per_task))

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if held:
            node, least = local_labels(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            for at in range(0, len(node), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(node[at : at + 100_000]), pa.array(least[at : at + 100_000])], names=["a", "b"])

    spread = edges.repartition(parts) if parts > 1 else edges.coalesce(1)
    stars = spread.mapInArrow(contract, "a bigint, b bigint")
    if parts == 1:
        return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    stars = cut(stars.distinct())
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = mark(stars)
    while True:
        both = stars.filter("a <> b").unionByName(stars.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.unionByName(stars.filter("a = b")).distinct())
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        stars = cut(small.distinct())
        now = mark(stars)
        if now == before:
            break
        before = now
    return stars.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")


def connected(edges: DataFrame) -> DataFrame:
    """node, component of edges a, b."""
    return components(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")))


def live(adds: DataFrame, removes: DataFrame) -> DataFrame:
    """What was added and never removed."""
    return adds.distinct().join(removes.distinct(), adds.columns, "left_anti")


def snapshot_at(versions: DataFrame, key: str, at: str, moment: object) -> DataFrame:
    """The latest version of each key at a moment."""
    past = versions.filter(F.col(at) <= F.lit(moment))
    rest = [c for c in versions.columns if c != key]
    return past.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(at, *[c for c in rest if c != at])).alias("_r")).select(key, "_r.*")


def ranked(rows: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    """The first rows of each group in an order; Spark keeps only `most` of each group before the shuffle."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= most).drop("_n")
