"""Views over outcomes (experience), scenarios (trajectories), documents and proposed objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import privacy
from ..functions import text as X
from ..operators import verdicts as V
from ..operators import views as W
from .base import DataFrame, Plans, SparkSession, table

P = Plans()

EXPERIENCE = """o AS (SELECT outcome_id AS id, min(scenario_id) AS scenario, min(ask) AS ask, min(taught_reply) AS answer, bool_and(taught_passes) AS passed FROM outcomes GROUP BY 1),
    s AS (SELECT id, min(source) AS role FROM scenarios GROUP BY 1), x AS (SELECT o.*, s.role, CASE s.role WHEN 'bench' THEN 3 WHEN 'field' THEN 2 ELSE 1 END AS strength FROM o LEFT JOIN s ON o.scenario = s.id)"""
BLANK = "(answer IS NULL OR trim(answer, ' ') = '')"
REFER = f"regexp_matches(lower(ask), '{'|'.join(W.REFERRING)}')"


def experiences(spark: SparkSession, d: str) -> DataFrame:
    """One experience for each outcome: the ask, the taught reply, its mark, and a strength by source."""
    o = table(spark, d, "outcomes").groupBy(F.col("outcome_id").alias("id")).agg(F.min("scenario_id").alias("scenario"), F.min("ask").alias("ask"), F.min("taught_reply").alias("answer"), F.bool_and("taught_passes").alias("passed"))
    s = table(spark, d, "scenarios").groupBy(F.col("id").alias("scenario")).agg(F.min("source").alias("role"))
    return o.join(s, "scenario", "left").withColumn("strength", F.when(F.col("role") == "bench", 3).when(F.col("role") == "field", 2).otherwise(1))


@P.add(f"""WITH {EXPERIENCE} SELECT id, CASE WHEN passed IS NULL THEN 'undecided' WHEN NOT passed THEN 'failed' WHEN strength < 2 THEN 'too_weak' WHEN {BLANK} THEN 'no_final_output' WHEN regexp_matches(answer, '</?think>') THEN 'reasoning_in_text' WHEN {REFER} THEN 'not_self_contained' END AS exclusion,
    CASE WHEN passed AND strength >= 2 AND NOT {BLANK} AND NOT regexp_matches(answer, '</?think>') AND NOT {REFER} THEN ask END AS "user", CASE WHEN passed AND strength >= 2 AND NOT {BLANK} AND NOT regexp_matches(answer, '</?think>') AND NOT {REFER} THEN answer END AS assistant FROM x""")
def view_sft_final(spark: SparkSession, d: str) -> DataFrame:
    v = W.sft_final(experiences(spark, d), 2)
    return v.select("id", "exclusion", F.get("messages", F.lit(0))["content"].alias("user"), F.get("messages", F.lit(1))["content"].alias("assistant"))


@P.add(f"""WITH {EXPERIENCE}, e AS (SELECT CASE WHEN passed IS NULL THEN 'undecided' WHEN NOT passed THEN 'failed' WHEN strength < 2 THEN 'too_weak' WHEN {BLANK} THEN 'no_final_output' WHEN {REFER} THEN 'not_self_contained' END AS exclusion FROM x)
    SELECT exclusion, count(*) AS n FROM e WHERE exclusion IS NOT NULL GROUP BY 1""")
def view_exclusions(spark: SparkSession, d: str) -> DataFrame:
    return V.counted(W.sft_final(experiences(spark, d), 2))


@P.add(f"WITH {EXPERIENCE} SELECT id, CASE WHEN NOT passed THEN 'failed' WHEN {BLANK} THEN 'no_final_output' WHEN {REFER} THEN 'not_self_contained' END AS exclusion FROM x")
def view_rehearsal(spark: SparkSession, d: str) -> DataFrame:
    return W.rehearsal(experiences(spark, d)).select("id", "exclusion")


@P.add(f"""WITH {EXPERIENCE}, e AS (SELECT *, CASE WHEN passed IS NULL THEN 'undecided' WHEN strength < 2 THEN 'too_weak' WHEN {BLANK} THEN 'no_final_output' WHEN {REFER} THEN 'not_self_contained' END AS exclusion FROM x)
    SELECT id, exclusion, CASE WHEN exclusion IS NULL THEN CASE WHEN passed THEN 'pass' ELSE 'fail' END END AS label FROM e""")
def view_verifier(spark: SparkSession, d: str) -> DataFrame:
    return W.verifier(experiences(spark, d), 2).select("id", "exclusion", "label")


@P.add(f"""WITH {EXPERIENCE}, e AS (SELECT *, CASE WHEN passed IS NULL THEN 'no_reward' WHEN strength < 2 THEN 'too_weak' WHEN {REFER} THEN 'not_self_contained' WHEN {BLANK} THEN 'no_action' END AS exclusion FROM x)
    SELECT id, exclusion, coalesce(CASE WHEN exclusion IS NULL THEN passed::INT::DOUBLE END, -1) AS reward FROM e""")
def view_outcome(spark: SparkSession, d: str) -> DataFrame:
    return W.outcome(experiences(spark, d), 2).select("id", "exclusion", F.coalesce("reward", F.lit(-1.0)).alias("reward"))


@P.add(f"""WITH {EXPERIENCE}, e AS (SELECT *, CASE WHEN NOT role IN ('bench', 'field') THEN 'role_not_wanted' WHEN passed IS NULL THEN 'undecided' WHEN strength < 3 AND passed THEN 'unverified_pass' WHEN strength < 3 THEN 'too_weak' WHEN {BLANK} THEN 'no_action' END AS exclusion FROM x)
    SELECT id, exclusion, CASE WHEN exclusion IS NULL THEN passed END AS desirable FROM e""")
def view_feedback(spark: SparkSession, d: str) -> DataFrame:
    return W.feedback(experiences(spark, d), ["bench", "field"], 3).select("id", "exclusion", "desirable")


@P.add(f"""WITH {EXPERIENCE}, g AS (SELECT *, max(passed::INT) OVER w - min(passed::INT) OVER w AS s FROM x WINDOW w AS (PARTITION BY scenario))
    SELECT id, CASE WHEN passed IS NULL THEN 'undecided' WHEN coalesce(s, 0) = 0 THEN 'no_group_signal' WHEN {BLANK} THEN 'no_action' END AS exclusion FROM g""")
def view_policy_gradient(spark: SparkSession, d: str) -> DataFrame:
    return W.policy_gradient(experiences(spark, d), "scenario").select("id", "exclusion")


def attempts(spark: SparkSession, d: str) -> DataFrame:
    """Both replies of each outcome as attempts of its scenario."""
    o = table(spark, d, "outcomes").groupBy("outcome_id", "scenario_id").agg(*[F.min(c).alias(c) for c in ("ask", "untaught_reply", "taught_reply")], F.bool_and("untaught_passes").alias("untaught_passes"), F.bool_and("taught_passes").alias("taught_passes"))
    side = lambda s: o.select(F.concat_ws("-", F.lit(s[0]), "outcome_id").alias("id"), F.col("scenario_id").alias("scenario"), "ask", F.col(f"{s}_reply").alias("answer"), F.col(f"{s}_passes").alias("passed"))
    return side("taught").unionByName(side("untaught"))


@P.add("""WITH o AS (SELECT outcome_id, scenario_id AS scenario, min(untaught_reply) AS ur, min(taught_reply) AS tr, bool_and(untaught_passes) AS up, bool_and(taught_passes) AS tp FROM outcomes GROUP BY ALL),
    a AS (SELECT scenario, tr AS answer, tp AS passed FROM o UNION ALL SELECT scenario, ur, up FROM o), k AS (SELECT * FROM a WHERE passed IS NOT NULL AND answer IS NOT NULL AND trim(answer, ' ') <> ''),
    s AS (SELECT scenario, count(*) FILTER (passed) AS p, count(*) FILTER (NOT passed) AS f FROM k GROUP BY 1) SELECT scenario, least(p * f, 4) AS n FROM s WHERE p > 0 AND f > 0""")
def view_preference(spark: SparkSession, d: str) -> DataFrame:
    """Pairs by scenario, at most four of each."""
    pairs, _ = W.preference(attempts(spark, d), ["scenario"], "p", 4)
    return pairs.groupBy("scenario").agg(F.count_distinct("chosen_id", "rejected_id").alias("n"))


@P.add("""WITH o AS (SELECT outcome_id, scenario_id AS scenario, min(untaught_reply) AS ur, min(taught_reply) AS tr, bool_and(untaught_passes) AS up, bool_and(taught_passes) AS tp FROM outcomes GROUP BY ALL),
    a AS (SELECT scenario, tr AS answer, tp AS passed FROM o UNION ALL SELECT scenario, ur, up FROM o), e AS (SELECT *, CASE WHEN passed IS NULL THEN 'undecided' WHEN answer IS NULL OR trim(answer, ' ') = '' THEN 'no_action' END AS x FROM a),
    s AS (SELECT scenario, count(*) FILTER (passed) AS p, count(*) FILTER (NOT passed) AS f FROM e WHERE x IS NULL GROUP BY 1)
    SELECT x AS exclusion, count(*) AS n FROM e WHERE x IS NOT NULL GROUP BY 1 UNION ALL SELECT 'no_counterpart', count(*) FROM e JOIN s USING (scenario) WHERE x IS NULL AND (p = 0 OR f = 0)""")
def view_preference_exclusions(spark: SparkSession, d: str) -> DataFrame:
    return V.counted(W.preference(attempts(spark, d), ["scenario"], "p", 4)[1])


@P.add(r"""WITH t AS (SELECT id, teach FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at, kind) AS n FROM scenarios WHERE teach IS NOT NULL) WHERE n = 1), p AS (SELECT id, teach, unnest(range(0, len(teach))) AS pos FROM t)
    SELECT id, pos::INT AS pos, CASE WHEN teach[pos + 1] IS NULL OR trim(teach[pos + 1], ' ') = '' THEN 'empty' WHEN list_contains(teach[1:pos], teach[pos + 1]) THEN 'repeated_action' END AS exclusion, coalesce(array_to_string(teach[1:pos], chr(10)), '') AS context, teach[pos + 1] AS step FROM p""")
def view_sft_steps(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "scenarios").filter("teach is not null").groupBy("id").agg(F.min_by("teach", F.struct("created_at", "kind")).alias("steps"))
    return W.sft_steps(t)


@P.add("""WITH t AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text ORDER BY added_at, doc_id) AS f FROM documents) SELECT doc_id, CASE WHEN text IS NULL OR trim(text, ' ') = '' THEN 'empty' WHEN f <> doc_id THEN 'duplicate' END AS exclusion FROM t""")
def view_cpt(spark: SparkSession, d: str) -> DataFrame:
    return W.cpt(table(spark, d, "documents"), "doc_id", "text", ["added_at", "doc_id"]).select("doc_id", "exclusion")


@P.add()
def view_retrieval(spark: SparkSession, d: str) -> DataFrame:
    """Quotes as queries, the section that holds one as the positive, sections beside it as negatives."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    sections = table(spark, d, "candidates").select("doc_id", "document", F.col("range.start").alias("start"), F.col("range.stop").alias("stop")).distinct()
    spans = sections.join(docs, "doc_id").select("document", "start", "stop", F.make_valid_utf8(F.expr("cast(substring(encode(text, 'UTF-8'), cast(start + 1 as int), cast(stop - start as int)) as string)")).alias("text"))
    quotes = table(spark, d, "proposed_objects").filter("quote is not null").select("id", "document", F.col("quote").alias("query")).distinct()
    return W.retrieval(quotes, spans, 3, "n")


@P.add(f"SELECT outcome_id, bool_or((contains(lower(taught_reply), '-1') OR contains(lower(taught_reply), 'quillon')) AND NOT contains(lower(taught_reply), 'probably')) AS ok FROM outcomes WHERE taught_reply IS NOT NULL GROUP BY 1")
def reply_check(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "outcomes").filter("taught_reply is not null")
    return o.groupBy("outcome_id").agg(F.bool_or(W.kept_by_reply(F.col("taught_reply"), ["-1", "quillon"], ["probably"])).alias("ok"))


@P.add(rf"SELECT doc_id, len(regexp_extract_all(text, '{privacy.EMAIL}')) AS emails, regexp_replace(text, '{privacy.EMAIL}', '[EMAIL]', 'g') = text AS clean FROM documents")
def privacy_emails(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.regexp_count("text", F.lit(privacy.EMAIL)).alias("emails"), (F.regexp_replace("text", privacy.EMAIL, "[EMAIL]") == F.col("text")).alias("clean"))


@P.add()
def privacy_scrub(spark: SparkSession, d: str) -> DataFrame:
    s = privacy.scrub(table(spark, d, "documents").select("doc_id", "text"), "text")
    return s.select("doc_id", F.explode("text_found").alias("kind", "n")).groupBy("kind").agg(F.sum("n").alias("n"), F.count_distinct("doc_id").alias("documents"))


@P.add(r"""SELECT c.doc_id, c.section, decode(array_slice(encode(d.text), c.range.start + 1, c.range.stop)) AS part FROM (SELECT DISTINCT doc_id, section, range FROM candidates) c JOIN documents d USING (doc_id)""")
def span_read(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "candidates").select("doc_id", "section", F.col("range.start").alias("a"), F.col("range.stop").alias("b")).distinct()
    return c.join(table(spark, d, "documents").select("doc_id", "text"), "doc_id").select("doc_id", "section", X.byte_span(F.col("text"), F.col("a"), F.col("b")).alias("part"))
