"""Generic relational coverage over the star schema: joins, sets, grouping, windows, subqueries, top-k."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Window
from pyspark.sql import functions as F

from .base import DataFrame, Plans, SparkSession, table

P = Plans()


@P.add("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def rel_pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").filter(F.col("l_shipdate") <= "1998-09-02")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@P.add("""SELECT o_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1996-06-01' AND l_shipdate > TIMESTAMP '1996-01-01' GROUP BY 1 ORDER BY round(sum(l_extendedprice * (1 - l_discount)), 2) DESC, o_orderkey LIMIT 10""")
def rel_top_orders(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    o = table(spark, d, "orders").filter(F.col("o_orderdate") < "1996-06-01")
    li = table(spark, d, "lineitem").filter(F.col("l_shipdate") > "1996-01-01")
    j = li.join(o.join(c, F.col("c_custkey") == F.col("o_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderkey").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue")).orderBy(F.desc("revenue"), "o_orderkey").limit(10)


@P.add("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey = c_nationkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def rel_local_suppliers(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(t("supplier"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("s_nationkey") == F.col("c_nationkey"))).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def joined(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        a = table(spark, d, "customer").filter("c_custkey % 3 = 0").select("c_custkey", "c_nationkey")
        b = table(spark, d, "orders").filter("o_custkey % 2 = 0").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
        j = a.join(b, F.col("c_custkey") == F.col("o_custkey"), kind)
        return j.select("c_custkey") if kind in ("left_semi", "left_anti") else j.select(F.coalesce("c_custkey", F.lit(-1)).alias("c_custkey"), F.coalesce("o_custkey", F.lit(-1)).alias("o_custkey"), F.coalesce("n", F.lit(0)).alias("n"))

    run.__name__ = f"rel_join_{kind}"
    return run


SIDES = "a AS (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0), b AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1)"
for kind, words in {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "full": "FULL JOIN"}.items():
    P.add(f"WITH {SIDES} SELECT coalesce(c_custkey, -1) AS c_custkey, coalesce(o_custkey, -1) AS o_custkey, coalesce(n, 0) AS n FROM a {words} b ON c_custkey = o_custkey")(joined(kind))
P.add(f"WITH {SIDES} SELECT c_custkey FROM a WHERE c_custkey IN (SELECT o_custkey FROM b)")(joined("left_semi"))
P.add(f"WITH {SIDES} SELECT c_custkey FROM a WHERE c_custkey NOT IN (SELECT o_custkey FROM b)")(joined("left_anti"))



def joined_whole(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    """All customers and all orders; rel_join_* read a third of the one and half of the keys of the other."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        a = table(spark, d, "customer").select("c_custkey")
        b = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
        j = a.join(b, F.col("c_custkey") == F.col("o_custkey"), kind)
        return j.select("c_custkey") if kind in ("left_semi", "left_anti") else j.select(F.coalesce("c_custkey", F.lit(-1)).alias("c_custkey"), F.coalesce("o_custkey", F.lit(-1)).alias("o_custkey"), F.coalesce("n", F.lit(0)).alias("n"))

    run.__name__ = f"rel_join_{kind}_whole"
    return run


WHOLE_SIDES = "a AS (SELECT c_custkey FROM customer), b AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)"
for kind, words in {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "full": "FULL JOIN"}.items():
    P.add(f"WITH {WHOLE_SIDES} SELECT coalesce(c_custkey, -1) AS c_custkey, coalesce(o_custkey, -1) AS o_custkey, coalesce(n, 0) AS n FROM a {words} b ON c_custkey = o_custkey")(joined_whole(kind))
P.add(f"WITH {WHOLE_SIDES} SELECT c_custkey FROM a WHERE EXISTS (SELECT 1 FROM b WHERE o_custkey = c_custkey)")(joined_whole("left_semi"))
P.add(f"WITH {WHOLE_SIDES} SELECT c_custkey FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE o_custkey = c_custkey)")(joined_whole("left_anti"))

SETS = {"union": "UNION", "union_all": "UNION ALL", "intersect": "INTERSECT", "except": "EXCEPT"}


def set_operation(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        a = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("s"))
        b = table(spark, d, "customer").filter("c_acctbal > 5000").select((F.col("c_nationkey") + 1).alias("k"), F.col("c_mktsegment").alias("s"))
        return {"union": lambda: a.union(b).distinct(), "union_all": lambda: a.union(b), "intersect": lambda: a.intersect(b), "except": lambda: a.subtract(b)}[kind]()

    run.__name__ = f"rel_set_{kind}"
    return run


for kind, words in SETS.items():
    P.add(f"SELECT c_nationkey AS k, c_mktsegment AS s FROM customer {words} SELECT c_nationkey + 1, c_mktsegment FROM customer WHERE c_acctbal > 5000")(set_operation(kind))


@P.add("SELECT coalesce(o_orderstatus, '*') AS status, coalesce(o_orderpriority, '*') AS priority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def rel_cube(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return c.select(F.coalesce("o_orderstatus", F.lit("*")).alias("status"), F.coalesce("o_orderpriority", F.lit("*")).alias("priority"), "n")


@P.add("SELECT coalesce(o_orderstatus, '*') AS status, coalesce(o_orderpriority, '*') AS priority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def rel_rollup(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return c.select(F.coalesce("o_orderstatus", F.lit("*")).alias("status"), F.coalesce("o_orderpriority", F.lit("*")).alias("priority"), "n")


@P.add("SELECT coalesce(l_returnflag, '*') AS flag, coalesce(l_linestatus, '*') AS status, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
def rel_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    g = li.groupingSets([[F.col("l_returnflag")], [F.col("l_linestatus")], []], "l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("qty"))
    return g.select(F.coalesce("l_returnflag", F.lit("*")).alias("flag"), F.coalesce("l_linestatus", F.lit("*")).alias("status"), "qty")


@P.add("""SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS rk, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS dr, ntile(4) OVER w AS nt, coalesce(lag(o_orderkey) OVER w, -1) AS prev, coalesce(lead(o_orderkey) OVER w, -1) AS next,
    round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS last3 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def rel_windows(spark: SparkSession, d: str) -> DataFrame:
    w, p = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"), Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    return table(spark, d, "orders").select(
        "o_orderkey", F.row_number().over(w).alias("rn"), F.rank().over(p).alias("rk"), F.dense_rank().over(p).alias("dr"), F.ntile(4).over(w).alias("nt"),
        F.coalesce(F.lag("o_orderkey").over(w), F.lit(-1)).alias("prev"), F.coalesce(F.lead("o_orderkey").over(w), F.lit(-1)).alias("next"), F.round(F.sum("o_totalprice").over(w.rowsBetween(-2, 0)), 2).alias("last3"))


@P.add("""SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1""")
def rel_pivot(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return p.select("o_custkey", *[F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ("F", "O", "P")])


@P.add("""SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT 1.2 * avg(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""")
def rel_correlated(spark: SparkSession, d: str) -> DataFrame:
    """Decorrelated by hand into one aggregation and one join on the same key."""
    o = table(spark, d, "orders")
    mean = o.groupBy("o_custkey").agg((1.2 * F.avg("o_totalprice")).alias("m"))
    return o.join(mean, "o_custkey").filter(F.col("o_totalprice") > F.col("m")).select("o_orderkey")


@P.add("""SELECT p_brand, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT p_type) AS types FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def rel_distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("p_brand").agg(F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("p_type").alias("types"))


@P.add("""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT json_extract_string(props, '$.page')) AS pages FROM events GROUP BY 1""")
def rel_json(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("page", F.get_json_object("props", "$.page"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.count_distinct("page").alias("pages"))


@P.add("""SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags, len(list(l_partkey)) AS parts FROM lineitem GROUP BY 1""")
def rel_collections(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("flags"), F.size(F.collect_list("l_partkey")).cast("long").alias("parts"))
