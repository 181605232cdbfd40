"""Measurement over scenarios and outcomes: replies without and with teaching are the two arms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats as X
from ..operators import measure as M
from .base import DataFrame, Plans, SparkSession, table

P = Plans()

ARMS = """o AS (SELECT outcome_id, scenario_id, bool_or(untaught_passes) AS a, bool_or(taught_passes) AS b FROM outcomes GROUP BY ALL), s AS (SELECT id, min(kind) AS kind, min(source) AS source FROM scenarios GROUP BY id),
    arms AS (SELECT o.*, s.kind, s.source FROM o JOIN s ON s.id = o.scenario_id)"""


def arms(spark: SparkSession, d: str) -> DataFrame:
    """Each outcome once, with its scenario's kind and source; marks a and b."""
    o = table(spark, d, "outcomes").groupBy("outcome_id", "scenario_id").agg(F.bool_or("untaught_passes").alias("a"), F.bool_or("taught_passes").alias("b"))
    s = table(spark, d, "scenarios").groupBy(F.col("id").alias("scenario_id")).agg(F.min("kind").alias("kind"), F.min("source").alias("source"))
    return o.join(s, "scenario_id")


CHOOSE = "list_sum(list_transform(range(wins, wins + losses + 1), lambda k: exp(lgamma(wins + losses + 1) - lgamma(k + 1) - lgamma(wins + losses - k + 1) - (wins + losses) * ln(2))))"


@P.add(f"""WITH {ARMS}, t AS (SELECT kind, count(*) FILTER (a AND b) AS both, count(*) FILTER (a AND NOT b) AS losses, count(*) FILTER (NOT a AND b) AS wins, count(*) FILTER (NOT a AND NOT b) AS neither, count(*) FILTER (a IS NULL OR b IS NULL) AS unpaired,
        round(avg(CASE WHEN b IS NOT NULL THEN a::INT END), 6) AS accuracy_a, round(avg(CASE WHEN a IS NOT NULL THEN b::INT END), 6) AS accuracy_b FROM arms GROUP BY kind)
    SELECT *, round(CASE WHEN wins + losses = 0 THEN 1 ELSE least(1, {CHOOSE}) END, 6) AS p_value FROM t""")
def paired_by_kind(spark: SparkSession, d: str) -> DataFrame:
    t = M.two_by_two(arms(spark, d), "kind")
    return t.withColumns({c: F.round(c, 6) for c in ("accuracy_a", "accuracy_b", "p_value")})


@P.add(f"""WITH {ARMS}, n AS (SELECT scenario_id, sign(sum(b::INT - a::INT)) AS s FROM arms WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1)
    SELECT count(*) FILTER (s > 0) AS wins, count(*) FILTER (s < 0) AS losses, count(*) FILTER (s = 0) AS ties FROM n""")
def paired_by_cluster(spark: SparkSession, d: str) -> DataFrame:
    return M.by_cluster(arms(spark, d), F.col("scenario_id"))


@P.add(f"""WITH {ARMS}, m AS (SELECT scenario_id, count(*) FILTER (a) AS ap, count(*) FILTER (NOT a) AS af, count(*) FILTER (b) AS bp, count(*) FILTER (NOT b) AS bf FROM arms GROUP BY 1)
    SELECT CASE WHEN ap > af THEN 1 WHEN ap < af THEN 0 ELSE -1 END AS a, CASE WHEN bp > bf THEN 1 WHEN bp < bf THEN 0 ELSE -1 END AS b, count(*) AS n FROM m GROUP BY ALL""")
def compare_sets(spark: SparkSession, d: str) -> DataFrame:
    """Majority of each task in both arms, paired by a full outer join; -1 stands for undecided."""
    o = arms(spark, d)
    pairs = M.paired(M.majority(o, "scenario_id", "a"), M.majority(o, "scenario_id", "b"), "scenario_id")
    mark = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c)
    return pairs.select(mark("a"), mark("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


@P.add(f"""WITH {ARMS}, r AS (SELECT scenario_id, false AS t, a AS p FROM arms UNION ALL SELECT scenario_id, true, b FROM arms), k AS (SELECT scenario_id, count(*) FILTER (NOT t AND p IS NOT NULL) AS n, count(*) FILTER (NOT t AND p) AS k, count(*) FILTER (t AND p) AS h, count(p) AS c FROM r GROUP BY 1)
    SELECT scenario_id, n AS trials, k AS passes, CASE WHEN c = 0 THEN 'unmeasured' WHEN n > 0 AND k = n THEN 'always' WHEN k > 0 THEN 'frontier' WHEN h > 0 THEN 'taught' ELSE 'never' END AS class FROM k""")
def pass_classes(spark: SparkSession, d: str) -> DataFrame:
    o = arms(spark, d)
    rows = o.select("scenario_id", F.lit(False).alias("t"), F.col("a").alias("p")).unionByName(o.select("scenario_id", F.lit(True).alias("t"), F.col("b").alias("p")))
    return M.frontier(rows, "scenario_id", "t", "p")


@P.add(f"""WITH {ARMS}, v AS (SELECT source, (outcome_id % 4)::INT AS ver, b FROM arms WHERE b IS NOT NULL), w AS (SELECT *, pow(0.5, max(ver) OVER (PARTITION BY source) - ver) AS w FROM v), r AS (SELECT source, sum(w) AS weight, sum(w * b::INT) / sum(w) AS rate, count(*) AS n FROM w GROUP BY 1)
    SELECT source, round(weight, 4) AS weight, round(rate, 6) AS rate, n, CASE WHEN rate >= 0.9 AND n >= 8 THEN 'retired' WHEN rate >= 0.7 THEN 'easy' WHEN rate > 0.2 THEN 'middle' ELSE 'hard' END AS band FROM r""")
def pass_rates_stale(spark: SparkSession, d: str) -> DataFrame:
    r = M.stale_pass_rates(arms(spark, d).withColumn("ver", (F.col("outcome_id") % 4).cast("int")), "source", "ver", "b")
    return r.withColumn("weight", F.round("weight", 4)).withColumn("rate", F.round("rate", 6))


@P.add(f"""WITH {ARMS}, n AS (SELECT kind, count(b) AS n, count(*) FILTER (b) AS k FROM arms GROUP BY 1), w AS (SELECT *, k / n AS p, 1.959963984540054 AS z FROM n)
    SELECT kind, n, round(greatest(0, (p + z*z/(2*n)) / (1 + z*z/n) - z * sqrt(p*(1-p)/n + z*z/(4*n*n)) / (1 + z*z/n)), 6) AS low, round(least(1, (p + z*z/(2*n)) / (1 + z*z/n) + z * sqrt(p*(1-p)/n + z*z/(4*n*n)) / (1 + z*z/n)), 6) AS high FROM w""")
def wilson_by_kind(spark: SparkSession, d: str) -> DataFrame:
    n = arms(spark, d).groupBy("kind").agg(F.count("b").alias("n"), F.count_if("b").alias("k"))
    low, high = X.wilson(F.col("k"), F.col("n"))
    return n.select("kind", "n", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@P.add("""WITH c AS (SELECT l_suppkey % 7 AS unit, l_partkey % 5 + 1 AS task, l_linenumber - 1 AS stage, avg(l_discount) AS score FROM lineitem WHERE l_linenumber <= 6 GROUP BY ALL), k AS (SELECT *, max(stage) OVER (PARTITION BY unit) AS last FROM c),
    t AS (SELECT unit, task, max(score) FILTER (stage = last) AS e, max(score) FILTER (stage = task) AS l, max(score) FILTER (stage >= task AND stage < last) AS p, max(score) FILTER (stage = task - 1) AS b, max(last) AS last FROM k GROUP BY ALL),
    u AS (SELECT unit, avg(e) AS acc, avg(CASE WHEN task < last THEN e - l END) AS bwt, avg(CASE WHEN task < last THEN p - e END) AS forgetting, avg(l - b) AS gain FROM t GROUP BY unit) SELECT round(avg(acc), 6) AS acc, round(avg(bwt), 6) AS bwt, round(avg(forgetting), 6) AS forgetting, round(avg(gain), 6) AS gain FROM u""")
def continual_matrix(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "lineitem").filter("l_linenumber <= 6").groupBy((F.col("l_suppkey") % 7).alias("unit"), (F.col("l_partkey") % 5 + 1).alias("task"), (F.col("l_linenumber") - 1).alias("stage")).agg(F.avg("l_discount").alias("score"))
    return M.continual(c).select(*[F.round(x, 6).alias(x) for x in ("acc", "bwt", "forgetting", "gain")])


@P.add(P.sql["continual_matrix"].replace(" WHERE l_linenumber <= 6", ""))
def continual_matrix_whole(spark: SparkSession, d: str) -> DataFrame:
    """Stages from all line numbers; continual_matrix ends at the sixth."""
    c = table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 7).alias("unit"), (F.col("l_partkey") % 5 + 1).alias("task"), (F.col("l_linenumber") - 1).alias("stage")).agg(F.avg("l_discount").alias("score"))
    return M.continual(c).select(*[F.round(x, 6).alias(x) for x in ("acc", "bwt", "forgetting", "gain")])


@P.add("""WITH g AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY 1), s AS (SELECT count(*) AS k, sum(n) AS nn, sum(n*n) AS n2, sum(n*m) AS nm, sum(n*m*m) AS nm2, sum(n*v) AS w FROM g),
    q AS (SELECT (nm2 - nm*nm/nn)/(k-1) AS b, w/(nn-k) AS i, (nn - n2/nn)/(k-1) AS n0 FROM s) SELECT round(greatest(0, (b - i)/(b + (n0-1)*i)), 5) AS icc, round(n0, 4) AS mean_size FROM q""")
def family_icc(spark: SparkSession, d: str) -> DataFrame:
    return M.intraclass(table(spark, d, "orders"), "o_custkey", "o_totalprice").select(F.round("icc", 5).alias("icc"), F.round("mean_size", 4).alias("mean_size"))


@P.add(f"""WITH t AS (SELECT n_nationkey AS id, (n_nationkey * 37 % 25 + 1) / 400.0 AS p FROM nation), r AS (SELECT *, (count(*) OVER () - row_number() OVER (ORDER BY p, id) + 1) * p AS t FROM t)
    SELECT id, round(least(1, max(t) OVER (ORDER BY p, id ROWS UNBOUNDED PRECEDING)), 6) AS adjusted FROM r""")
def holm_adjusted(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), ((F.col("n_nationkey") * 37 % 25 + 1) / 400.0).alias("p"))
    return M.holm(t, "p", "id").select("id", F.round("adjusted", 6).alias("adjusted"))


@P.add(f"""WITH {ARMS}, b AS (SELECT kind, outcome_id, b::INT - a::INT AS d FROM arms WHERE a IS NOT NULL AND b IS NOT NULL), f AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY outcome_id) AS i FROM b), g AS (SELECT * FROM f WHERE i <= 20)
    SELECT outcome_id, round((exp(sum(ln(0.9 + 0.1 * (1 + d))) OVER w) + exp(sum(ln(0.75 + 0.25 * (1 + d))) OVER w) + exp(sum(ln(0.5 + 0.5 * (1 + d))) OVER w) + exp(sum(ln(0.25 + 0.75 * (1 + d))) OVER w)) / 4, 4) AS capital FROM g WINDOW w AS (PARTITION BY kind ORDER BY outcome_id ROWS UNBOUNDED PRECEDING)""")
def e_process_capital(spark: SparkSession, d: str) -> DataFrame:
    """The capital over the first twenty outcomes of each kind, as the gate looks at it."""
    from pyspark.sql import Window

    b = arms(spark, d).filter("a is not null and b is not null").withColumn("d", F.col("b").cast("int") - F.col("a").cast("int"))
    first = b.withColumn("i", F.row_number().over(Window.partitionBy("kind").orderBy("outcome_id"))).filter("i <= 20")
    return M.e_process(first, ["kind"], ["outcome_id"]).select("outcome_id", F.round("capital", 4).alias("capital"))


@P.add(f"""WITH {ARMS}, b AS (SELECT kind, outcome_id, b::INT - a::INT AS d FROM arms WHERE a IS NOT NULL AND b IS NOT NULL), g AS (SELECT outcome_id, [sum(ln(0.9 + 0.1 * (1 + d))) OVER w, sum(ln(0.75 + 0.25 * (1 + d))) OVER w, sum(ln(0.5 + 0.5 * (1 + d))) OVER w, sum(ln(0.25 + 0.75 * (1 + d))) OVER w] AS l
        FROM b WINDOW w AS (PARTITION BY kind ORDER BY outcome_id ROWS UNBOUNDED PRECEDING))
    SELECT outcome_id, round(list_max(l) + ln(list_sum(list_transform(l, lambda x: exp(x - list_max(l)))) / 4), 4) AS log_capital FROM g""")
def e_process_whole(spark: SparkSession, d: str) -> DataFrame:
    """The logarithm of the capital after every outcome of each kind; e_process_capital ends at the twentieth."""
    b = arms(spark, d).filter("a is not null and b is not null").withColumn("d", F.col("b").cast("int") - F.col("a").cast("int"))
    return M.e_process_log(b, ["kind"], ["outcome_id"]).select("outcome_id", F.round("log_capital", 4).alias("log_capital"))


@P.add()
def bootstrap_by_kind(spark: SparkSession, d: str) -> DataFrame:
    f = arms(spark, d).filter("b is not null").groupBy("kind", "scenario_id").agg(F.sum(F.col("b").cast("double")).alias("total"), F.count(F.lit(1)).alias("n"))
    return M.bootstrap_interval(f.withColumn("family", F.xxhash64("scenario_id")), "kind")


@P.add("""WITH e AS (SELECT o_orderpriority AS metric, avg(o_totalprice) AS value, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1), r AS (SELECT * FROM (VALUES ('1-URGENT', 'improves', 0.0), ('2-HIGH', 'at_least', 1e9), ('5-LOW', 'covers', 1000.0), ('none', 'within', 1.0)) t(metric, kind, bound))
    SELECT metric, CASE kind WHEN 'improves' THEN CASE WHEN low IS NULL THEN 'unmeasured' WHEN low > 0 THEN 'passed' ELSE 'failed' END WHEN 'at_least' THEN CASE WHEN value IS NULL THEN 'unmeasured' WHEN value >= bound THEN 'passed' ELSE 'failed' END
        WHEN 'covers' THEN CASE WHEN low IS NULL THEN 'unmeasured' WHEN low <= bound AND bound <= high THEN 'passed' ELSE 'failed' END ELSE CASE WHEN value IS NULL THEN 'unmeasured' WHEN abs(value) <= bound THEN 'passed' ELSE 'failed' END END AS verdict FROM r LEFT JOIN e USING (metric)""")
def gate_metrics(spark: SparkSession, d: str) -> DataFrame:
    evidence = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("metric")).agg(F.avg("o_totalprice").alias("value"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))
    needed = spark.createDataFrame([("1-URGENT", "improves", 0.0), ("2-HIGH", "at_least", 1e9), ("5-LOW", "covers", 1000.0), ("none", "within", 1.0)], "metric string, kind string, bound double")
    return M.metric_gate(needed, evidence)


@P.add("""WITH r AS (SELECT event_id, avg((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS rate, user_id FROM events), p AS (SELECT *, max(rate) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS p FROM r)
    SELECT event_id, round(rate, 6) AS rate, round(coalesce(CASE WHEN p > 0 THEN rate / p END, -1), 6) AS of_peak FROM p""")
def plateau_rate(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("hit", F.col("event_type") == "purchase")
    return M.plateau(e, ["user_id"], ["event_id"], "hit", 5).select("event_id", F.round("rate", 6).alias("rate"), F.round(F.coalesce("of_peak", F.lit(-1)), 6).alias("of_peak"))


@P.add("""WITH c AS (SELECT scenario_id AS task, lower(trim(taught_reply)) AS x, count(*) AS k FROM (SELECT DISTINCT outcome_id, scenario_id, taught_reply FROM outcomes WHERE taught_reply IS NOT NULL) GROUP BY ALL), t AS (SELECT task, sum(k)::BIGINT AS n, max(k) AS best, max_by(x, k) AS x FROM c GROUP BY 1)
    SELECT task, n, CASE WHEN n >= 3 AND 2 * best > n THEN x END AS answer FROM t""")
def consistent_answers(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "outcomes").select("outcome_id", F.col("scenario_id").alias("task"), "taught_reply").filter("taught_reply is not null").distinct()
    return M.consistency(o, "task", F.lower(F.trim("taught_reply")))
