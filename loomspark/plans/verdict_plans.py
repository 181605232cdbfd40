"""Verdicts, rewards, families, skills and signals over orders (attempts) and line items (evaluations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import verdicts as V
from .base import DataFrame, Plans, SparkSession, table

P = Plans()

EVALUATIONS = """evaluations AS (
    SELECT l_orderkey AS target, l_suppkey AS evaluator, l_linenumber % 2 AS version, l_discount * 10 AS score, l_tax * 10 AS confidence,
           CASE l_returnflag WHEN 'A' THEN 'pass' WHEN 'R' THEN 'fail' ELSE 'abstain' END AS ruling, l_linenumber % 3 AS rank
    FROM lineitem)"""


def evaluations(spark: SparkSession, d: str) -> DataFrame:
    ruling = F.when(F.col("l_returnflag") == "A", "pass").when(F.col("l_returnflag") == "R", "fail").otherwise("abstain")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("target"), F.col("l_suppkey").alias("evaluator"), (F.col("l_linenumber") % 2).alias("version"), (F.col("l_discount") * 10).alias("score"),
        (F.col("l_tax") * 10).alias("confidence"), ruling.alias("ruling"), (F.col("l_linenumber") % 3).alias("rank"),
    )


@P.add(f"""WITH {EVALUATIONS}, ranked AS (SELECT *, max(rank) OVER (PARTITION BY target) AS top FROM evaluations WHERE ruling <> 'abstain')
    SELECT target, CASE WHEN count(DISTINCT ruling) = 1 THEN max(ruling) = 'pass' END AS passed FROM ranked WHERE rank = top GROUP BY target""")
def verdict_resolve(spark: SparkSession, d: str) -> DataFrame:
    return V.resolve_verdicts(evaluations(spark, d), "target")


@P.add(f"""WITH {EVALUATIONS}, gone AS (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0),
    kept AS (SELECT * FROM evaluations e WHERE e.confidence >= 0.1 AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.s_suppkey = e.evaluator AND e.version = 1))
    SELECT evaluator, version, count(*) AS n, round(sum(score), 4) AS score FROM kept GROUP BY ALL""")
def verdict_standing(spark: SparkSession, d: str) -> DataFrame:
    gone = table(spark, d, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("evaluator"), F.lit(1).alias("version"))
    kept = V.standing(evaluations(spark, d), gone, min_confidence=0.1)
    return kept.groupBy("evaluator", "version").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("score"), 4).alias("score"))


@P.add(f"""WITH {EVALUATIONS}, notes AS (SELECT target, ruling, CASE rank WHEN 2 THEN 255 ELSE rank END AS strength FROM evaluations WHERE ruling <> 'abstain'),
    ok AS (SELECT * FROM notes WHERE NOT (strength = 255 AND ruling = 'pass')), top AS (SELECT *, max(strength) OVER (PARTITION BY target) AS t FROM ok)
    SELECT target, CASE WHEN min(ruling) = max(ruling) THEN min(ruling) = 'pass' END AS passed FROM top WHERE strength = t GROUP BY target""")
def verdict_decide(spark: SparkSession, d: str) -> DataFrame:
    return V.decide(evaluations(spark, d).withColumn("strength", F.when(F.col("rank") == 2, V.CONSTRAINT).otherwise(F.col("rank"))), "target")


REWARDS = f"""{EVALUATIONS}, ranked AS (SELECT *, max(rank) OVER (PARTITION BY target) AS top FROM evaluations WHERE ruling <> 'abstain'),
    passes AS (SELECT target, CASE WHEN count(DISTINCT ruling) = 1 THEN (CASE max(ruling) WHEN 'pass' THEN 1.0 ELSE 0.0 END) END AS v FROM ranked WHERE rank = top GROUP BY target),
    rewards AS (SELECT e.target AS attempt, CASE WHEN count(*) FILTER (ruling <> 'abstain') > 0 THEN any_value(p.v)
        WHEN sum(confidence) > 0 THEN sum(score * confidence) / sum(confidence) ELSE sum(score * confidence) / count(score) END AS reward
        FROM evaluations e LEFT JOIN passes p ON e.target = p.target GROUP BY e.target)"""


def rewards(spark: SparkSession, d: str) -> DataFrame:
    return V.attempt_rewards(evaluations(spark, d), "target").withColumnRenamed("target", "attempt")


@P.add(f"WITH {REWARDS} SELECT attempt, round(reward, 6) AS reward FROM rewards")
def verdict_rewards(spark: SparkSession, d: str) -> DataFrame:
    return rewards(spark, d).select("attempt", F.round("reward", 6).alias("reward"))


ATTEMPTS = "attempts AS (SELECT o_orderkey AS attempt, o_custkey AS family, CASE o_orderstatus WHEN 'F' THEN 'pass' WHEN 'O' THEN 'fail' END AS outcome, o_totalprice AS cost FROM orders)"


def attempts(spark: SparkSession, d: str) -> DataFrame:
    outcome = F.when(F.col("o_orderstatus") == "F", "pass").when(F.col("o_orderstatus") == "O", "fail")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("attempt"), F.col("o_custkey").alias("family"), outcome.alias("outcome"), F.col("o_totalprice").alias("cost"))


@P.add(f"""WITH {REWARDS}, {ATTEMPTS}, r AS (SELECT family, CASE WHEN w.attempt IS NOT NULL THEN w.reward WHEN outcome = 'pass' THEN 1.0 WHEN outcome = 'fail' THEN 0.0 END AS r
        FROM attempts a LEFT JOIN (SELECT * FROM rewards WHERE attempt % 3 = 0) w ON a.attempt = w.attempt)
    SELECT family, count(*) AS attempts, count(r) AS measured, round(avg(r), 6) AS pass_rate, round(var_pop(r), 6) AS reward_variance,
           coalesce(bool_or(r >= 0.5), false) AND coalesce(bool_or(r < 0.5), false) AS mixed FROM r GROUP BY family""")
def family_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Every third attempt has been evaluated; the others fall back to their recorded outcome."""
    v = V.family_view(attempts(spark, d), rewards(spark, d).filter("attempt % 3 = 0"))
    return v.withColumn("pass_rate", F.round("pass_rate", 6)).withColumn("reward_variance", F.round("reward_variance", 6))


@P.add(f"""WITH {REWARDS}, {ATTEMPTS}, r AS (SELECT family, CASE WHEN w.attempt IS NOT NULL THEN w.reward WHEN outcome = 'pass' THEN 1.0 WHEN outcome = 'fail' THEN 0.0 END AS r
        FROM attempts a LEFT JOIN rewards w ON a.attempt = w.attempt)
    SELECT family, count(*) AS attempts, count(r) AS measured, round(avg(r), 6) AS pass_rate, round(var_pop(r), 6) AS reward_variance,
           coalesce(bool_or(r >= 0.5), false) AND coalesce(bool_or(r < 0.5), false) AS mixed FROM r GROUP BY family""")
def family_outcomes_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every reward counts; attempts without any evaluation fall back to their recorded outcome."""
    v = V.family_view(attempts(spark, d), rewards(spark, d))
    return v.withColumn("pass_rate", F.round("pass_rate", 6)).withColumn("reward_variance", F.round("reward_variance", 6))


@P.add("""WITH e AS (SELECT l_partkey AS skill, l_suppkey % 5 AS domain, l_returnflag <> 'R' AS supports FROM lineitem WHERE l_quantity > 25),
    dom AS (SELECT skill, domain, count(*) FILTER (supports) AS s, count(*) FILTER (NOT supports) AS c FROM e GROUP BY ALL),
    tot AS (SELECT skill, sum(s) AS s, sum(c) AS c, count(*) FILTER (s > c) AS d FROM dom GROUP BY skill),
    f AS (SELECT p_partkey AS skill, coalesce(s, 0) AS s, coalesce(c, 0) AS c, coalesce(d, 0) AS d FROM part LEFT JOIN tot ON p_partkey = skill)
    SELECT skill, s::BIGINT AS supports, c::BIGINT AS contradicts, d AS domains, round((1 + s) / (2 + s + c), 6) AS confidence,
        CASE WHEN s + c = 0 THEN 'proposed' WHEN c > s AND c >= 2 THEN 'contradicted' WHEN d >= 2 AND (1 + s) / (2 + s + c) >= 0.8 THEN 'general'
             WHEN s >= 2 AND (1 + s) / (2 + s + c) >= 0.7 THEN 'supported' ELSE 'candidate' END AS status FROM f""")
def skill_status(spark: SparkSession, d: str) -> DataFrame:
    evidence = table(spark, d, "lineitem").filter("l_quantity > 25").select(F.col("l_partkey").alias("skill"), (F.col("l_suppkey") % 5).alias("domain"), (F.col("l_returnflag") != "R").alias("supports"))
    return V.skill_assessment(table(spark, d, "part").select(F.col("p_partkey").alias("skill")), evidence).withColumn("confidence", F.round("confidence", 6))


@P.add("""SELECT p_partkey AS id, round(CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size * p_retailprice / (p_size % 10) END, 4) AS score,
    row_number() OVER (ORDER BY CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size * p_retailprice / (p_size % 10) END DESC NULLS LAST, p_partkey) AS position FROM part""")
def priority_order(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("value"), F.when(F.col("p_size") % 10 != 0, F.col("p_size") % 10).alias("cost"))
    return V.priority_rank(items, ["size", "value"], "cost", "id").select("id", F.round("score", 4).alias("score"), "position")


@P.add("""WITH n AS (SELECT o_orderpriority AS role, count(*) FILTER (o_orderstatus = 'F') AS good, count(*) FILTER (o_orderstatus = 'O') AS bad FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
    SELECT role, good, bad, round(CASE WHEN bad > good AND good > 0 THEN bad / good ELSE 1 END, 6) AS good_weight, round(CASE WHEN good > bad AND bad > 0 THEN good / bad ELSE 1 END, 6) AS bad_weight FROM n""")
def feedback_class_weights(spark: SparkSession, d: str) -> DataFrame:
    verified = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderpriority").alias("role"), (F.col("o_orderstatus") == "F").alias("desirable"))
    w = V.feedback_weights(verified, "role")
    return w.withColumn("good_weight", F.round("good_weight", 6)).withColumn("bad_weight", F.round("bad_weight", 6))


@P.add(f"""WITH {REWARDS}, g AS (SELECT o_custkey AS family, count(reward) AS n, max(reward) - min(reward) AS spread, bool_or(reward >= 0.5) AS p FROM orders JOIN rewards ON attempt = o_orderkey GROUP BY 1)
    SELECT family, n, coalesce(n >= 2 AND spread >= 1e-12, false) AS signals, CASE WHEN n >= 2 AND spread >= 1e-12 THEN 'graded' WHEN p THEN 'all_pass' ELSE 'all_fail' END AS kind FROM g""")
def reward_group_kinds(spark: SparkSession, d: str) -> DataFrame:
    r = rewards(spark, d).join(attempts(spark, d), "attempt")
    return V.group_kinds(r, "family", F.col("reward") >= 0.5).withColumn("signals", F.coalesce("signals", F.lit(False)))


@P.add("""WITH r AS (SELECT o_orderkey AS attempt, o_custkey AS g, o_totalprice / 100000 AS reward FROM orders), s AS (SELECT *, avg(reward) OVER w AS m, stddev_pop(reward) OVER w AS sd, count(*) OVER w AS n, sum(reward) OVER w AS t FROM r WINDOW w AS (PARTITION BY g))
    SELECT attempt, round(reward - m, 3) + 0.0 AS centred, round(CASE WHEN sd > 1e-12 THEN (reward - m) / sd ELSE 0 END, 3) + 0.0 AS standardised, round(CASE WHEN n > 1 THEN reward - (t - reward) / (n - 1) END, 3) + 0.0 AS leave_one_out, round(greatest(0, reward - m), 3) AS positive FROM s""")
def reward_advantages(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("attempt"), F.col("o_custkey").alias("g"), (F.col("o_totalprice") / 100000).alias("reward"))
    a = V.advantages(r, "g")
    return a.select("attempt", *[(F.round(c, 3) + 0.0).alias(c) for c in ("centred", "standardised", "leave_one_out", "positive")])


@P.add("""SELECT l_orderkey, l_linenumber, round(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.5 * greatest(0, (l_discount * 10 - 0.2) / 0.8) END, 6) AS reward,
    round(CASE WHEN l_quantity <= 30 THEN 0 WHEN l_quantity > 45 THEN -1 ELSE (30 - l_quantity) / 15 END, 6) AS penalty FROM lineitem""")
def reward_shape(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.round(V.shaped_reward(F.col("l_returnflag") == "A", F.col("l_discount") * 10, F.lit(0.2)), 6).alias("reward"), F.round(V.overlong_penalty(F.col("l_quantity"), 45.0, 15.0), 6).alias("penalty"))


@P.add("""WITH t AS (SELECT l_partkey AS task, count(*) AS n, var_pop(l_discount * 10) AS v, sum(greatest(0, least(1, l_discount * 10))) AS s, avg(l_quantity) AS cost FROM lineitem GROUP BY 1),
    k AS (SELECT *, (n * v + 2 * ((1 + s) * (1 + n - s) / ((2 + n) * (3 + n)))) / (n + 2) AS u FROM t)
    SELECT task, n, round(u, 6) AS variance, round(cost, 6) AS cost, round(u / cost, 6) AS signal, round(sqrt(u) / cost, 6) AS weight FROM k""")
def task_learning_signal(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "lineitem").select(F.col("l_partkey").alias("task"), (F.col("l_discount") * 10).alias("reward"), F.col("l_quantity").alias("cost"))
    return V.learning_signal(r, "task").select("task", "n", *[F.round(c, 6).alias(c) for c in ("variance", "cost", "signal", "weight")])
