"""Selection, curricula, ledgers and admission over parts, orders, events, utterances and outcomes; sections of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markup
from ..operators import selection as S
from .base import DataFrame, Plans, SparkSession, table

P = Plans()


@P.add("""WITH s AS (SELECT p_partkey AS id, p_size / 50.0 AS coverage, p_partkey % 90 AS words, (p_partkey % 8) / 8.0 AS novelty, p_retailprice AS weighted, CASE WHEN p_partkey % 11 = 0 THEN 'superseded' END AS ruling FROM part),
    r AS (SELECT *, CASE WHEN coverage < 0.5 THEN 'irrelevant' WHEN words <= 0 THEN 'empty' WHEN ruling IS NOT NULL THEN ruling WHEN novelty < 0.25 THEN 'known' END AS reason FROM s),
    o AS (SELECT id, sum(words) OVER (ORDER BY weighted * novelty / words DESC, id ROWS UNBOUNDED PRECEDING) AS run FROM r WHERE reason IS NULL)
    SELECT id, reason FROM r WHERE reason IS NOT NULL UNION ALL SELECT id, CASE WHEN run <= 5000 THEN 'chosen' ELSE 'over_budget' END FROM o""")
def select_for_goal(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") / 50).alias("coverage"), (F.col("p_partkey") % 90).alias("words"), (F.col("p_partkey") % 8 / 8).alias("novelty"), F.col("p_retailprice").alias("weighted"), F.when(F.col("p_partkey") % 11 == 0, "superseded").alias("ruling"))
    return S.goal_selection(s, 5000)


@P.add("""WITH k AS (SELECT replace(replace(lower(trim(key)), ' ', '-'), '_', '-') AS k, id, said, kind, said_at FROM utterances WHERE key IS NOT NULL), c AS (SELECT k, id, said AS statement, CASE WHEN kind = 'rule' THEN 'forget' ELSE 'assert' END AS action, said_at FROM k WHERE said IS NOT NULL GROUP BY ALL),
    l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY said_at DESC, id DESC, statement DESC) AS n FROM c), t AS (SELECT k, count(*) FILTER (action = 'assert') AS a, count(DISTINCT CASE WHEN action = 'assert' THEN statement END) AS d FROM c GROUP BY 1)
    SELECT l.k, CASE WHEN action = 'assert' THEN statement END AS statement, CASE WHEN action = 'forget' THEN 'forgotten' WHEN a > d THEN 'reinforced' WHEN d > 1 THEN 'superseding' ELSE 'live' END AS state FROM l JOIN t USING (k) WHERE n = 1""")
def claim_ledger(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "utterances").filter("key is not null and said is not null")
    c = u.select(F.regexp_replace(F.lower(F.trim("key")), "[ _]", "-").alias("k"), "id", F.col("said").alias("statement"), F.when(F.col("kind") == "rule", "forget").otherwise("assert").alias("action"), "said_at").distinct()
    return S.ledger(c, "k", ["said_at", "id", "statement"])


@P.add("""WITH c AS (SELECT DISTINCT o_custkey, o_orderpriority, o_orderkey % 3 AS run FROM orders) SELECT o_custkey, o_orderpriority, count(DISTINCT run) AS n, CASE WHEN count(DISTINCT run) >= 3 THEN 'kept' ELSE 'unconfirmed' END AS ruling FROM c GROUP BY ALL""")
def claim_agreement(spark: SparkSession, d: str) -> DataFrame:
    return S.agreement(table(spark, d, "orders").withColumn("run", F.col("o_orderkey") % 3), ["o_custkey", "o_orderpriority"], "run", 3)


@P.add("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 4 <> 0)
    SELECT o_custkey, count(*) AS n, round(avg((o_orderstatus = 'F')::INT), 6) AS rate FROM o WHERE n <= 5 GROUP BY 1""")
def mastery_recent(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("passed"), (F.col("o_orderkey") % 4 == 0).alias("aided"))
    return S.mastery(a, ["o_custkey"], ["o_orderdate", "o_orderkey"], 5).withColumn("rate", F.round("rate", 6))


@P.add("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) SELECT user_id, round(abs(avg(value) FILTER (n <= 10) - avg(value) FILTER (n > 10 AND n <= 20)), 5) AS progress FROM n GROUP BY 1""")
def learning_progress(spark: SparkSession, d: str) -> DataFrame:
    return S.learning_progress(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], 10).withColumn("progress", F.round("progress", 5))


@P.add("""WITH p AS (SELECT n_nationkey AS f, (n_nationkey % 7) / 7.0 AS progress, 1 + n_nationkey % 3 AS cost FROM nation) SELECT f, round(0.8 * (progress / cost) / sum(progress / cost) OVER () + 0.2 / count(*) OVER (), 6) AS weight FROM p""")
def curriculum_weights(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "nation").select(F.col("n_nationkey").alias("f"), (F.col("n_nationkey") % 7 / 7).alias("progress"), (1 + F.col("n_nationkey") % 3).alias("cost"))
    return S.family_weights(p, "f", 0.2).withColumn("weight", F.round("weight", 6))


@P.add("""SELECT c_custkey FROM customer WHERE c_acctbal >= 0 ORDER BY c_nationkey, ln(greatest((('0x' || substr(md5('d|' || c_custkey), 1, 13))::BIGINT / 4503599627370496.0), 1e-300)) / CASE WHEN c_custkey % 5 = 0 THEN 0.1 ELSE 1 END DESC, c_custkey LIMIT 60""")
def prompt_draw(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("visits"), (F.col("c_acctbal") < 0).alias("retired"), (F.col("c_custkey") % 5 == 0).alias("cliff"))
    return S.prompt_draw(c, "c_custkey", "d", 60).select("c_custkey")


@P.add("""SELECT l_orderkey, max(l_linenumber % 3) AS train, max(l_suppkey % 3) AS release, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS conditions FROM lineitem GROUP BY 1""")
def terms_combined(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 3).alias("train"), (F.col("l_suppkey") % 3).alias("release"), F.col("l_returnflag").alias("condition"))
    return S.terms_combined(t, ["l_orderkey"], ["train", "release"]).withColumn("conditions", F.array_join("conditions", ","))


@P.add("""WITH j AS (SELECT l_suppkey, CASE l_returnflag WHEN 'A' THEN 'pass' WHEN 'R' THEN 'fail' ELSE 'abstain' END AS said, l_linestatus = 'F' AS truth FROM lineitem)
    SELECT l_suppkey, round(coalesce(avg(truth::INT) FILTER (said = 'pass'), -1), 6) AS precision_pass, round(coalesce(avg((NOT truth)::INT) FILTER (said = 'fail'), -1), 6) AS precision_fail, round(avg((said = 'abstain')::INT), 6) AS abstains FROM j GROUP BY 1""")
def judge_calibration(spark: SparkSession, d: str) -> DataFrame:
    said = F.when(F.col("l_returnflag") == "A", "pass").when(F.col("l_returnflag") == "R", "fail").otherwise("abstain")
    c = S.calibration(table(spark, d, "lineitem").select("l_suppkey", said.alias("said"), (F.col("l_linestatus") == "F").alias("truth")), ["l_suppkey"])
    return c.select("l_suppkey", *[F.round(F.coalesce(x, F.lit(-1)), 6).alias(x) for x in ("precision_pass", "precision_fail")], F.round("abstains", 6).alias("abstains"))


@P.add("""WITH a AS (SELECT o_orderkey AS id, CASE o_custkey % 9 WHEN 0 THEN 'environment_error' WHEN 1 THEN 'model_error' WHEN 2 THEN 'verifier_error' END AS status, o_custkey % 10 = 3 AS violation, CASE o_orderkey % 4 WHEN 0 THEN 'no submission' WHEN 1 THEN 'wrong 502' END AS reason, o_orderkey % 3 = 0 AS changed, o_orderkey % 5 AS repeats, o_orderkey % 2 AS failing, o_custkey % 6 = 0 AS resource FROM orders)
    SELECT id, CASE WHEN status = 'environment_error' THEN 'environment' WHEN status = 'verifier_error' THEN 'verification' WHEN status = 'model_error' AND reason LIKE '%502%' THEN 'gateway' WHEN status = 'model_error' THEN 'model_server' WHEN violation THEN 'history_probing'
        WHEN NOT resource AND reason IS NOT NULL AND reason NOT LIKE '%no submission%' THEN 'wrong_content' WHEN NOT resource AND reason LIKE '%no submission%' AND changed THEN 'malformed_artifact' WHEN repeats >= 3 THEN 'repetition' WHEN failing > 0 THEN 'tool' WHEN resource THEN 'resource' WHEN reason IS NULL THEN 'no_answer' ELSE 'unclassified' END AS failure FROM a""")
def failure_diagnosis(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    a = table(spark, d, "orders").select(
        k.alias("id"), F.when(c % 9 == 0, "environment_error").when(c % 9 == 1, "model_error").when(c % 9 == 2, "verifier_error").alias("status"), (c % 10 == 3).alias("violation"),
        F.when(k % 4 == 0, "no submission").when(k % 4 == 1, "wrong 502").alias("reason"), (k % 3 == 0).alias("changed"), (k % 5).alias("repeats"), (k % 2).alias("failing"), (c % 6 == 0).alias("resource"))
    return S.diagnosis(a).select("id", "failure")


@P.add("""WITH c AS (SELECT c_custkey AS id, CASE c_nationkey % 3 WHEN 0 THEN 'live' WHEN 1 THEN 'simulated' ELSE 'other' END AS p, c_custkey % 4 <> 0 AS consent, c_custkey % 5 <> 0 AS scrubbed, c_custkey % 7 AS residue, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS reward, c_custkey % 6 = 0 AS leak FROM customer)
    SELECT id, CASE WHEN p = 'live' THEN CASE WHEN NOT consent THEN 'no_consent' WHEN NOT scrubbed THEN 'live_not_scrubbed' WHEN residue > 0 THEN 'residual_pii' ELSE 'live' END WHEN p = 'simulated' THEN CASE WHEN reward IS NULL THEN 'unmeasured' WHEN leak THEN 'answer_key_leak' ELSE 'simulated' END ELSE 'unknown_provenance' END AS ruling FROM c""")
def conversation_admission(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(
        k.alias("id"), F.when(F.col("c_nationkey") % 3 == 0, "live").when(F.col("c_nationkey") % 3 == 1, "simulated").otherwise("other").alias("provenance"), (k % 4 != 0).alias("consent"), (k % 5 != 0).alias("scrubbed"), (k % 7).alias("residue"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("reward"), (k % 6 == 0).alias("leak"))
    return S.admission(c).select("id", "ruling")


@P.add()
def contradicting_facts(spark: SparkSession, d: str) -> DataFrame:
    """Asks of one scenario that are nearly the same with different taught replies."""
    o = table(spark, d, "outcomes").filter("taught_reply is not null").groupBy("outcome_id").agg(F.min("scenario_id").alias("s"), F.min("ask").alias("q"), F.min("taught_reply").alias("a"))
    return S.contradictions(o, F.col("s"), F.col("q"), F.col("a"), "outcome_id")


@P.add()
def document_sections(spark: SparkSession, d: str) -> DataFrame:
    return markup.cut_sections(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")
