"""Evaluations, verdicts, rewards and what follows from them. Unmeasured stays NULL throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running_total


def standing(evaluations: DataFrame, retractions: DataFrame, *, target: str | None = None, criterion: str | None = None, min_confidence: float | None = None, include_retracted: bool = False) -> DataFrame:
    """Evaluations that still stand: a retraction of (evaluator, version) withdraws them, whenever it was recorded."""
    kept = evaluations
    if target is not None:
        kept = kept.filter(F.col("target") == target)
    if criterion is not None:
        kept = kept.filter(F.col("criterion") == criterion)
    if min_confidence is not None:
        kept = kept.filter(F.col("confidence") >= min_confidence)
    return kept if include_retracted else kept.join(retractions.select("evaluator", "version").distinct(), ["evaluator", "version"], "left_anti")


def resolve_verdicts(evaluations: DataFrame, *by: str) -> DataFrame:
    """passed: abstentions are dropped, the highest rank decides if it is unanimous, else NULL. One aggregation: the
    highest rank of passes and of fails are compared."""
    decided = evaluations.filter(F.col("ruling").isin("pass", "fail"))
    tops = decided.groupBy(*by).agg(F.max(F.when(F.col("ruling") == "pass", F.col("rank"))).alias("p"), F.max(F.when(F.col("ruling") == "fail", F.col("rank"))).alias("f"))
    return tops.select(*by, F.when(F.col("f").isNull() | (F.col("p") > F.col("f")), True).when(F.col("p").isNull() | (F.col("f") > F.col("p")), False).alias("passed"))


CONSTRAINT = 255


def decide(notes: DataFrame, *by: str) -> DataFrame:
    """As resolve_verdicts over strengths, where a pass of a mere constraint decides nothing."""
    counted = notes.filter(~((F.col("strength") == CONSTRAINT) & (F.col("ruling") == "pass"))).withColumn("rank", F.col("strength"))
    return resolve_verdicts(counted, *by)


def attempt_rewards(evaluations: DataFrame, *by: str) -> DataFrame:
    """reward: 1 or 0 where a verdict decides, NULL where verdicts conflict; without verdicts the mean score weighted by
    confidence, which is 0 when all weights are."""
    scores = evaluations.groupBy(*by).agg(
        F.count_if(F.col("ruling").isin("pass", "fail")).alias("verdicts"),
        F.sum(F.col("score") * F.col("confidence")).alias("weighted"),
        F.sum("confidence").alias("weight"),
        F.count("score").alias("n"),
    )
    mean = F.when(F.col("weight") > 0, F.col("weighted") / F.col("weight")).when(F.col("n") > 0, F.col("weighted") / F.col("n"))
    return scores.join(resolve_verdicts(evaluations, *by), list(by), "left").select(*by, F.when(F.col("verdicts") > 0, F.col("passed").cast("double")).otherwise(mean).alias("reward"))


def family_view(attempts: DataFrame, rewards: DataFrame) -> DataFrame:
    """By family: attempts, measured, pass_rate, reward_variance (population), mixed (both outcomes). A standing
    evaluation decides, even to NULL; only an attempt without any falls back to its recorded outcome."""
    reward = F.when(F.col("evaluated"), F.col("reward")).otherwise(F.when(F.col("outcome") == "pass", 1.0).when(F.col("outcome") == "fail", 0.0))
    joined = attempts.join(rewards.select("attempt", "reward", F.lit(True).alias("evaluated")), "attempt", "left").withColumn("r", reward)
    return joined.groupBy("family").agg(
        F.count(F.lit(1)).alias("attempts"), F.count("r").alias("measured"), F.avg("r").alias("pass_rate"), F.var_pop("r").alias("reward_variance"),
        (F.coalesce(F.bool_or(F.col("r") >= 0.5), F.lit(False)) & F.coalesce(F.bool_or(F.col("r") < 0.5), F.lit(False))).alias("mixed"),
    )


def skill_assessment(skills: DataFrame, evidence: DataFrame) -> DataFrame:
    """By skill: supports, contradicts, domains won, confidence (1+s)/(2+s+c), status."""
    domains = evidence.groupBy("skill", "domain").agg(F.count_if("supports").alias("s"), F.count_if(~F.col("supports")).alias("c"))
    totals = domains.groupBy("skill").agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.count_if(F.col("s") > F.col("c")).alias("d"))
    s, c, d = F.coalesce("s", F.lit(0)), F.coalesce("c", F.lit(0)), F.coalesce("d", F.lit(0))
    confidence = (1 + s) / (2 + s + c)
    status = F.when(s + c == 0, "proposed").when((c > s) & (c >= 2), "contradicted").when((d >= 2) & (confidence >= 0.8), "general").when((s >= 2) & (confidence >= 0.7), "supported").otherwise("candidate")
    return skills.join(totals, "skill", "left").select("skill", s.alias("supports"), c.alias("contradicts"), d.alias("domains"), confidence.alias("confidence"), status.alias("status"))


def priority_rank(items: DataFrame, factors: list[str], cost: str, key: str) -> DataFrame:
    """score = product of factors / cost, NULL if any is; the scored first, highest first, ties by key."""
    product = F.lit(1.0)
    for f in factors:
        product = product * F.col(f)
    scored = items.withColumn("score", F.when(F.col(cost) > 0, product / F.col(cost)))
    return running_total(scored, "score", key, None, "position")


def feedback_weights(verified: DataFrame, *by: str) -> DataFrame:
    """Weights of the wanted and unwanted class: the smaller class weighs the ratio, the larger 1."""
    n = verified.groupBy(*by).agg(F.count_if("desirable").alias("good"), F.count_if(~F.col("desirable")).alias("bad"))
    weight = lambda this, other: F.when((F.col(other) > F.col(this)) & (F.col(this) > 0), F.col(other) / F.col(this)).otherwise(1.0)
    return n.select(*by, "good", "bad", weight("good", "bad").alias("good_weight"), weight("bad", "good").alias("bad_weight"))


def group_kinds(rewards: DataFrame, group: str, passed: Column) -> DataFrame:
    """By group: signals (at least two rewards that differ), kind."""
    g = rewards.groupBy(group).agg(F.count("reward").alias("n"), (F.max("reward") - F.min("reward")).alias("spread"), F.bool_or(passed).alias("any_pass"))
    signals = (F.col("n") >= 2) & (F.col("spread") >= 1e-12)
    return g.select(group, "n", signals.alias("signals"), F.when(signals, "graded").when(F.col("any_pass"), "all_pass").otherwise("all_fail").alias("kind"))


def shaped_reward(passed: Column, fraction: Column, base: Column, ceiling: float = 0.5) -> Column:
    """1 for a pass; a fail earns what it gained over its base, up to the ceiling."""
    return F.when(passed, 1.0).otherwise(ceiling * F.greatest(F.lit(0.0), (fraction - base) / (1 - base)))


def overlong_penalty(length: Column, limit: float, cache: float) -> Column:
    """0 up to limit - cache, then down to -1 at the limit."""
    return F.when(length <= limit - cache, 0.0).when(length > limit, -1.0).otherwise((limit - cache - length) / cache)


def advantages(rewards: DataFrame, group: str) -> DataFrame:
    """Standardised, centred, leave-one-out and positive advantages within each group."""
    w = Window.partitionBy(group)
    mean, spread, n, total = F.avg("reward").over(w), F.stddev_pop("reward").over(w), F.count("reward").over(w), F.sum("reward").over(w)
    return rewards.withColumns({
        "centred": F.col("reward") - mean,
        "standardised": F.when(spread > 1e-12, (F.col("reward") - mean) / spread).otherwise(0.0),
        "leave_one_out": F.when(n > 1, F.col("reward") - (total - F.col("reward")) / (n - 1)),
        "positive": F.greatest(F.lit(0.0), F.col("reward") - mean),
    })


def learning_signal(rewards: DataFrame, task: str) -> DataFrame:
    """By task: shrunk variance V, mean cost, LS = V / cost and weight = sqrt(V) / cost."""
    clamp = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("reward")))
    t = rewards.groupBy(task).agg(F.count("reward").alias("n"), F.var_pop("reward").alias("v"), F.sum(clamp).alias("s"), F.avg("cost").alias("cost"))
    a, b = 1 + F.col("s"), 1 + F.col("n") - F.col("s")
    prior = a * b / ((a + b) * (a + b + 1))
    shrunk = (F.col("n") * F.col("v") + 2 * prior) / (F.col("n") + 2)
    return t.filter("n > 0").select(task, "n", shrunk.alias("variance"), "cost", F.when(F.col("cost") > 0, shrunk / F.col("cost")).alias("signal"), F.when(F.col("cost") > 0, F.sqrt(shrunk) / F.col("cost")).alias("weight"))


def exclusions(rows: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """`exclusion`: the first rule that holds, NULL for none. A rule that is NULL does not hold."""
    reason = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        reason = F.when(rule, name).otherwise(reason)
    return rows.withColumn("exclusion", reason)


def counted(excluded: DataFrame) -> DataFrame:
    """exclusion, n for all rows left out."""
    return excluded.filter("exclusion is not null").groupBy("exclusion").agg(F.count(F.lit(1)).alias("n"))
