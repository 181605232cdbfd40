"""The record graph: documents are versions, suppliers hang below nations and regions, orders and parts are linked by line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from .base import DataFrame, Plans, SparkSession, table

P = Plans()


@P.add("""SELECT event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts) AS n FROM events
    WHERE event_type IN ('click', 'error', 'purchase', 'view') AND user_id = 7 AND ts >= TIMESTAMP '2000-01-01' AND ts < TIMESTAMP '2100-01-01') WHERE n = 1 ORDER BY event_id LIMIT 50""")
def query_records(spark: SparkSession, d: str) -> DataFrame:
    """A query of kinds, equality and a half-open time range, limited to the lowest ids."""
    q = G.RecordQuery(kinds=["click", "error", "purchase", "view"], equal={"user_id": 7}, start="2000-01-01", stop="2100-01-01", most=50)
    return q.run(table(spark, d, "events"), "event_id", "event_type", "ts").select("event_id", "event_type", "value")


def hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """src, rel, dst: suppliers in nations in regions."""
    a = table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("src"), F.lit("in_nation").alias("rel"), F.concat(F.lit("n"), "s_nationkey").alias("dst"))
    b = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("src"), F.lit("in_region").alias("rel"), F.concat(F.lit("r"), "n_regionkey").alias("dst"))
    return a.unionByName(b)


EDGES = "edges AS (SELECT 's' || s_suppkey AS src, 'in_nation' AS rel, 'n' || s_nationkey AS dst FROM supplier UNION ALL SELECT 'n' || n_nationkey, 'in_region', 'r' || n_regionkey FROM nation)"


@P.add(f"WITH {EDGES} SELECT DISTINCT dst AS node, src AS neighbour FROM edges WHERE rel = 'in_nation' AND dst IN ('n1', 'n2', 'n3')")
def graph_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return G.neighbours(hierarchy(spark, d), spark.createDataFrame([("n1",), ("n2",), ("n3",)], "node string"), "in_nation", backwards=True)


@P.add(f"""WITH RECURSIVE {EDGES}, walk AS (SELECT 'r1' AS node, 0 AS depth UNION SELECT e.src, w.depth + 1 FROM walk w JOIN edges e ON e.dst = w.node)
    SELECT node, min(depth) AS depth FROM walk GROUP BY node""")
def graph_reaching(spark: SparkSession, d: str) -> DataFrame:
    """Everything below one region."""
    return G.reachable(hierarchy(spark, d), spark.createDataFrame([("r1",)], "node string"), backwards=True)


@P.add("""WITH RECURSIVE p AS (SELECT o_orderkey AS node, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey - o_orderkey % 7 END AS parent FROM orders),
    q AS (SELECT a.node, CASE WHEN b.node IS NULL THEN NULL ELSE a.parent END AS parent FROM p a LEFT JOIN p b ON a.parent = b.node),
    w AS (SELECT node, node AS root, 0 AS depth FROM q WHERE parent IS NULL UNION ALL SELECT q.node, w.root, w.depth + 1 FROM q JOIN w ON q.parent = w.node)
    SELECT node, root, depth::BIGINT AS depth FROM w""")
def graph_ancestors(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return G.ancestors(table(spark, d, "orders").select(k.alias("node"), F.when(k % 7 != 0, k - k % 7).alias("parent")))


@P.add("""WITH RECURSIVE e AS (SELECT p_partkey AS node, p_partkey // 2 AS needs FROM part WHERE p_partkey // 2 >= 1),
    w AS (SELECT p_partkey AS node, 0 AS level FROM part WHERE p_partkey NOT IN (SELECT node FROM e) UNION ALL SELECT e.node, w.level + 1 FROM e JOIN w ON e.needs = w.node)
    SELECT node, max(level) AS level FROM w GROUP BY node""")
def graph_levels(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select(F.col("p_partkey").alias("node"))
    needs = part.select("node", F.expr("node div 2").alias("needs")).filter("needs >= 1")
    return G.topological_levels(part, needs)


@P.add("""WITH RECURSIVE e AS (SELECT DISTINCT c_custkey AS a, c_custkey - 10 AS b FROM customer WHERE c_custkey % 50 >= 10 AND c_custkey > 10), s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    w AS (SELECT a AS node, a AS c FROM s UNION SELECT s.b, w.c FROM w JOIN s ON s.a = w.node) SELECT node, min(c) AS component FROM w GROUP BY node""")
def graph_components(spark: SparkSession, d: str) -> DataFrame:
    return G.connected(table(spark, d, "customer").filter("c_custkey % 50 >= 10 and c_custkey > 10").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") - 10).alias("b")))


@P.add("""SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'""")
def manifest_live(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return G.live(li.filter("l_returnflag = 'N'").select("l_partkey", "l_suppkey"), li.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey"))


@P.add("""SELECT document, doc_id, coalesce(version, -1) AS version FROM (SELECT *, row_number() OVER (PARTITION BY document ORDER BY added_at DESC, doc_id DESC) AS n FROM documents WHERE document IS NOT NULL AND added_at <= TIMESTAMP '2025-12-31') WHERE n = 1""")
def snapshot_time_travel(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("document is not null").select("document", "added_at", "doc_id", "version")
    return G.snapshot_at(docs, "document", "added_at", "2025-12-31").select("document", "doc_id", F.coalesce("version", F.lit(-1)).alias("version"))


@P.add("""SELECT id, min(proposed_at) = max(proposed_at) AS once, count(*) AS copies FROM proposed_objects GROUP BY id""")
def scan_copies(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "proposed_objects").groupBy("id").agg((F.min("proposed_at") == F.max("proposed_at")).alias("once"), F.count(F.lit(1)).alias("copies"))


@P.add("""SELECT id, kind, document FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY proposed_at, kind, document) AS n FROM proposed_objects) WHERE n = 1""")
def scan_first_copy(spark: SparkSession, d: str) -> DataFrame:
    """The first copy of each id wins."""
    rows = table(spark, d, "proposed_objects")
    return rows.groupBy("id").agg(F.min_by(F.struct("kind", "document"), F.struct("proposed_at", "kind", "document")).alias("r")).select("id", "r.*")
