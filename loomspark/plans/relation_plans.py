"""Relations over outcomes and scenarios, exam reservation and exposure, alarms and competence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relations as R
from .base import DataFrame, Plans, SparkSession, table
from .curation_plans import u
from .view_plans import EXPERIENCE, experiences

P = Plans()


@P.add(f"""WITH {EXPERIENCE}, r AS (SELECT id AS critique, id + 1 AS critiqued FROM x WHERE id % 5 = 0) SELECT r.critique, r.critiqued,
    CASE WHEN NOT coalesce(a.passed, false) THEN 'unverified_critique' WHEN a.answer IS NULL OR trim(a.answer, ' ') = '' THEN 'no_final_output' WHEN b.id IS NULL THEN 'related_missing' WHEN b.answer IS NULL OR trim(b.answer, ' ') = '' THEN 'no_final_output' END AS exclusion
    FROM r LEFT JOIN x a ON a.id = r.critique LEFT JOIN x b ON b.id = r.critiqued""")
def view_critic(spark: SparkSession, d: str) -> DataFrame:
    x = experiences(spark, d)
    return R.critic(x.filter("id % 5 = 0").select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")), x).select("critique", "critiqued", "exclusion")


@P.add(P.sql["view_critic"].replace(" WHERE id % 5 = 0", ""))
def view_critic_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every id criticises the next; view_critic takes every fifth."""
    x = experiences(spark, d)
    return R.critic(x.select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")), x).select("critique", "critiqued", "exclusion")


@P.add("""WITH a AS (SELECT l_orderkey AS id, list(l_returnflag ORDER BY l_linenumber, l_partkey, l_returnflag) AS steps, max(l_linestatus) = 'F' AS passed FROM lineitem GROUP BY 1), r AS (SELECT o_orderkey AS src, o_orderkey + 1 AS dst FROM orders WHERE o_orderkey % 2 = 0),
    j AS (SELECT r.*, a.id AS ai, b.id AS bi, a.passed AS ap, b.passed AS bp, a.steps AS s, b.steps AS t, list_min(list_filter(range(0, greatest(len(a.steps), len(b.steps))), lambda i: a.steps[i + 1] IS DISTINCT FROM b.steps[i + 1])) AS first FROM r LEFT JOIN a ON a.id = src LEFT JOIN a b ON b.id = dst)
    SELECT src, dst, CASE WHEN ai IS NULL OR bi IS NULL THEN 'related_missing' WHEN coalesce(ap = bp, true) THEN 'no_preferred_path' WHEN NOT coalesce(j.first < len(s) AND j.first < len(t), false) THEN 'no_divergence' END AS exclusion FROM j""")
def view_decision(spark: SparkSession, d: str) -> DataFrame:
    steps = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))), lambda x: x["l_returnflag"])
    a = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(steps.alias("steps"), (F.max("l_linestatus") == "F").alias("passed"))
    r = table(spark, d, "orders").filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("src"), (F.col("o_orderkey") + 1).alias("dst"))
    return R.decisions(r, a).select("src", "dst", "exclusion")


@P.add(P.sql["view_decision"].replace(" WHERE o_orderkey % 2 = 0", ""))
def view_decision_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every order and the next; view_decision takes even keys."""
    steps = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))), lambda x: x["l_returnflag"])
    a = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(steps.alias("steps"), (F.max("l_linestatus") == "F").alias("passed"))
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("src"), (F.col("o_orderkey") + 1).alias("dst"))
    return R.decisions(r, a).select("src", "dst", "exclusion")


@P.add("""WITH e AS (SELECT o_orderkey AS id, l_partkey AS blob FROM orders JOIN lineitem ON l_orderkey = o_orderkey), f AS (SELECT p_partkey AS blob, p_partkey - p_partkey % 50 AS family FROM part WHERE p_partkey % 7 <> 0)
    SELECT o_orderkey AS id, coalesce(min(coalesce(family, e.blob)), -1) AS family FROM orders LEFT JOIN e ON e.id = o_orderkey LEFT JOIN f ON f.blob = e.blob GROUP BY 1""")
def record_families(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    evidence = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("blob"))
    families = table(spark, d, "part").filter("p_partkey % 7 <> 0").select(F.col("p_partkey").alias("blob"), (F.col("p_partkey") - F.col("p_partkey") % 50).alias("family"))
    return R.grouped(records, evidence, families).withColumn("family", F.coalesce("family", F.lit(-1)))


@P.add(f"""WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY {u('exam', 'doc_id')}, doc_id) AS n FROM documents WHERE len(regexp_split_to_array(trim(text, ' '), ' +')) >= 120) SELECT doc_id, CASE WHEN n <= 50 THEN 'exam' ELSE 'dev' END AS use FROM o WHERE n <= 100""")
def exam_reserve(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.size(F.split(F.trim("text"), " +")).alias("words"))
    return R.reserved(docs, "doc_id", "words", "exam", 50, 50)


@P.add("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def exam_seal(spark: SparkSession, d: str) -> DataFrame:
    kept = table(spark, d, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return R.sealed(table(spark, d, "orders"), kept, "o_custkey", drop=True).select("o_orderkey")


@P.add()
def exposure_audit(spark: SparkSession, d: str) -> DataFrame:
    """Documents that show twelve-word windows of exam instructions which no teaching record holds."""
    items = table(spark, d, "exam_items").select(F.col("instruction").alias("text"))
    public = table(spark, d, "utterances").filter("said is not null").select(F.col("said").alias("text"))
    return R.exposed(table(spark, d, "documents").filter("text is not null").select("doc_id", "text"), items, public, "doc_id", "text")


@P.add()
def quota_selection(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_size", (-F.col("p_retailprice")).alias("rank"))
    return R.quota(parts, ["p_brand", "p_size"], ["rank"], "p_partkey", 0.05, 100)


@P.add("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n, CASE WHEN event_id % 3 = 0 THEN value END AS held FROM events), k AS (SELECT * FROM n WHERE n <= 6),
    t AS (SELECT user_id, count(value) AS c, arg_max(value, event_id) - arg_min(value, event_id) AS up, count(held) AS h, arg_max(held, event_id) FILTER (held IS NOT NULL) - arg_min(held, event_id) FILTER (held IS NOT NULL) AS hu FROM k GROUP BY 1)
    SELECT user_id, CASE WHEN c < 2 THEN NULL WHEN up >= 1 AND h < 2 THEN 'unconfirmed' WHEN up >= 1 AND hu <= 0 THEN 'diverging' ELSE 'steady' END AS state FROM t""")
def divergence_alarm(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", F.col("value").alias("reward"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("held_out"))
    return R.alarm(e, ["user_id"], "event_id", 6, 1.0, 0.0)


@P.add("""WITH b AS (SELECT c_custkey, c_nationkey, c_acctbal < 0 AS used, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS before, sum((c_acctbal < 0)::INT) OVER (PARTITION BY c_nationkey) AS u,
    coalesce(sum((c_acctbal < 0)::INT) OVER (PARTITION BY c_nationkey ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ub, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer) SELECT c_custkey, round((u - ub) / (n - before), 6) AS zeta FROM b""")
def pool_exposure(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    c = table(spark, d, "customer").withColumn("used", F.col("c_acctbal") < 0).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("c_nationkey")))
    return R.exposure(c, ["c_nationkey"], ["c_custkey"], F.col("n")).select("c_custkey", F.round("zeta", 6).alias("zeta"))


@P.add("""WITH f AS (SELECT l_returnflag AS policy, l_partkey AS family, avg(l_discount) AS q, avg(l_quantity) AS c, avg((l_linenumber = 1)::INT) AS a FROM lineitem GROUP BY ALL)
    SELECT policy, round(avg(q), 6) AS quality, round(avg(c), 5) AS cost, round(avg(a), 6) AS autonomy, count(q) AS families FROM f GROUP BY 1""")
def policy_competence(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("policy"), F.col("l_partkey").alias("family"), F.col("l_discount").alias("reward"), F.col("l_quantity").alias("cost"), (F.col("l_linenumber") == 1).alias("unaided"))
    c = R.competence(rows, ["policy"])
    return c.select("policy", F.round("quality", 6).alias("quality"), F.round("cost", 5).alias("cost"), F.round("autonomy", 6).alias("autonomy"), "families")


@P.add("""WITH v AS (SELECT user_id, count(value) AS n, avg((value < 1 OR value > 90)::INT) AS o, stddev_pop(value) AS s FROM events GROUP BY 1)
    SELECT user_id, n, CASE WHEN n < 60 THEN 'too_few' WHEN o > 0.1 THEN 'out_of_range' WHEN greatest(s / 10, 10 / s) > 2 THEN 'spread' ELSE 'admitted' END AS ruling FROM v""")
def harmonised_values(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "value", F.lit(10.0).alias("reference"))
    return R.harmonised(e, ["user_id"], F.lit(1.0), F.lit(90.0), 60, 0.1, 2.0)
