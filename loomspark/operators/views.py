"""Dataset views: from verified experience to training rows. Every candidate becomes a row or an exclusion with the first
reason that applies, so rows and exclusions add up to the candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.text import draw
from .verdicts import exclusions

# How a text refers to what its reader cannot see.
REFERRING = "the passage|the document|the text above|the excerpt|the article|this section|the section above|as mentioned above|as stated above|according to the source|in the source|the author states|the paragraph|the snippet|the material".split("|")


def not_self_contained(text: Column) -> Column:
    return F.lower(text).rlike("|".join(REFERRING))


def reasoning_in_text(text: Column) -> Column:
    """Reasoning markup, opened or only closed."""
    return text.rlike("</?think>")


def blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def messages(*turns: tuple[str, Column, bool]) -> Column:
    return F.array(*[F.struct(F.lit(role).alias("role"), content.alias("content"), F.lit(train).alias("train")) for role, content, train in turns])


def require_pass(min_strength: int) -> list[tuple[str, Column]]:
    """Undecided, then failed (also weakly), then too weak."""
    return [("undecided", F.col("passed").isNull()), ("failed", ~F.col("passed")), ("too_weak", F.col("strength") < min_strength)]


def answer_rules() -> list[tuple[str, Column]]:
    return [("no_final_output", blank(F.col("answer"))), ("reasoning_in_text", reasoning_in_text(F.col("answer"))), ("not_self_contained", not_self_contained(F.col("ask")))]


def sft_final(experiences: DataFrame, min_strength: int = 0) -> DataFrame:
    """Passed experience (id, ask, answer, passed, strength) as a student turn and a trained final answer."""
    rows = exclusions(experiences, require_pass(min_strength) + answer_rules())
    return rows.withColumn("messages", F.when(F.col("exclusion").isNull(), messages(("user", F.col("ask"), False), ("assistant", F.col("answer"), True))))


def rehearsal(experiences: DataFrame) -> DataFrame:
    """Own answers that were not decided to fail."""
    rows = exclusions(experiences, [("failed", ~F.col("passed"))] + answer_rules())
    return rows.withColumn("messages", F.when(F.col("exclusion").isNull(), messages(("user", F.col("ask"), False), ("assistant", F.col("answer"), True))))


def verifier(experiences: DataFrame, min_strength: int = 0) -> DataFrame:
    """Task and answer with the label pass or fail."""
    rules = [("undecided", F.col("passed").isNull()), ("too_weak", F.col("strength") < min_strength), ("no_final_output", blank(F.col("answer"))), ("not_self_contained", not_self_contained(F.col("ask")))]
    rows = exclusions(experiences, rules)
    return rows.withColumn("label", F.when(F.col("exclusion").isNull(), F.when(F.col("passed"), "pass").otherwise("fail")))


def outcome(experiences: DataFrame, min_strength: int = 0) -> DataFrame:
    """Whole answers with their reward; an unmeasured reward is left out, never 0."""
    rows = exclusions(experiences, [("no_reward", F.col("passed").isNull()), ("too_weak", F.col("strength") < min_strength), ("not_self_contained", not_self_contained(F.col("ask"))), ("no_action", blank(F.col("answer")))])
    return rows.withColumn("reward", F.when(F.col("exclusion").isNull(), F.col("passed").cast("double")))


def feedback(experiences: DataFrame, roles: list[str] | None = None, min_strength: int = 0) -> DataFrame:
    """Each verified attempt, desirable if passed."""
    wanted = [("role_not_wanted", ~F.col("role").isin(*roles))] if roles else []
    rows = exclusions(experiences, wanted + [("undecided", F.col("passed").isNull()), ("unverified_pass", (F.col("strength") < min_strength) & F.col("passed")), ("too_weak", F.col("strength") < min_strength), ("no_action", blank(F.col("answer")))])
    return rows.withColumn("desirable", F.when(F.col("exclusion").isNull(), F.col("passed")))


def preference(experiences: DataFrame, group: list[str], seed: str, most: int) -> tuple[DataFrame, DataFrame]:
    """Pass and fail pairs within a bucket, and the exclusions. The pairs of a bucket are never all built: its passes and
    fails are each put in hashed order and pair k is (k mod passes, k div ... mod fails), so at most `most` rows arise."""
    rows = exclusions(experiences, [("undecided", F.col("passed").isNull()), ("no_action", blank(F.col("answer")))])
    kept = rows.filter("exclusion is null").withColumn("_u", draw(seed, F.col("id")))
    sides = kept.groupBy(*group).agg(F.count_if("passed").alias("passes"), F.count_if(~F.col("passed")).alias("fails"))
    w = Window.partitionBy(*group, "passed").orderBy("_u", "id")
    placed = kept.withColumn("_r", F.row_number().over(w) - 1).filter(F.col("_r") < most)
    good = placed.filter("passed").select(*group, F.col("_r").alias("_g"), F.col("id").alias("chosen_id"), F.col("answer").alias("chosen"), F.col("ask").alias("prompt"))
    bad = placed.filter("not passed").select(*group, F.col("_r").alias("_b"), F.col("id").alias("rejected_id"), F.col("answer").alias("rejected"))
    plan = sides.filter("passes > 0 and fails > 0").withColumn("_n", F.least(F.col("passes") * F.col("fails"), F.lit(most)))
    # numbers of pairs: along the diagonals of the passes-by-fails table, each cell once
    lcm = F.expr("passes * fails div greatest(1, aggregate(sequence(1, cast(least(passes, fails) as int)), 1, (acc, x) -> if(passes % x = 0 and fails % x = 0, x, acc)))")
    cells = plan.withColumn("_k", F.explode(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int")))).withColumn("_g", F.expr("cast(_k % passes as int)")).withColumn("_b", ((F.col("_k") + F.floor(F.col("_k") / lcm)) % F.col("fails")).cast("int"))
    pairs = cells.select(*group, "_g", "_b").join(good, [*group, "_g"]).join(bad, [*group, "_b"]).filter(F.col("chosen") != F.col("rejected"))
    lonely = kept.join(sides.filter("passes = 0 or fails = 0").select(*group), group, "left_semi").withColumn("exclusion", F.lit("no_counterpart"))
    out = rows.filter("exclusion is not null").select("id", "exclusion").unionByName(lonely.select("id", "exclusion"))
    return pairs.drop("_g", "_b"), out


def policy_gradient(experiences: DataFrame, group: str) -> DataFrame:
    """Attempts of graded groups with their rewards; untreated groups of one outcome have no signal."""
    w = Window.partitionBy(group)
    r = F.col("passed").cast("double")
    spread = F.max(r).over(w) - F.min(r).over(w)
    rows = experiences.withColumn("reward", r).withColumn("_s", spread)
    return exclusions(rows, [("undecided", F.col("passed").isNull()), ("no_group_signal", F.coalesce(F.col("_s"), F.lit(0.0)) < 1e-12), ("no_action", blank(F.col("answer")))]).drop("_s")


def sft_steps(trajectories: DataFrame) -> DataFrame:
    """Each step of a trajectory (id, steps array<string>) with the context before it; only the step is trained. A step that
    occurred before is left out."""
    s = trajectories.select("id", F.posexplode("steps").alias("pos", "step"), "steps")
    seen = F.array_contains(F.slice("steps", F.lit(1), F.col("pos")), F.col("step"))
    rows = exclusions(s, [("empty", blank(F.col("step"))), ("repeated_action", seen)])
    return rows.select("id", "pos", "exclusion", F.concat_ws("\n", F.slice("steps", F.lit(1), F.col("pos"))).alias("context"), "step")


def cpt(parts: DataFrame, key: str, text: str, order: list[str]) -> DataFrame:
    """Raw texts once by content; what is blank or a repeat is counted."""
    digest = F.sha2(F.col(text), 256)
    first = parts.filter(~blank(F.col(text))).groupBy(digest.alias("h")).agg(F.min_by(key, F.struct(*order)).alias("first"))
    rows = parts.withColumn("h", digest).join(first, "h", "left")
    return exclusions(rows, [("empty", blank(F.col(text))), ("duplicate", F.col(key) != F.col("first"))]).drop("first")


def retrieval(queries: DataFrame, spans: DataFrame, most: int, seed: str) -> DataFrame:
    """query id, positive span and up to `most` negatives: other spans of the same document that do not overlap it and hold
    other text. The spans of one document are few, and negatives are capped by draw within each query."""
    own = queries.join(spans.select("document", F.col("start").alias("p_start"), F.col("stop").alias("p_stop"), F.col("text").alias("positive")), "document").filter(F.contains("positive", "query"))
    first = own.groupBy("id").agg(F.min(F.struct("p_start", "p_stop", "positive", "document", "query")).alias("p")).select("id", "p.*")
    other = first.join(spans, "document").filter((F.col("stop") <= F.col("p_start")) | (F.col("start") >= F.col("p_stop"))).filter(F.col("text") != F.col("positive"))
    w = Window.partitionBy("id").orderBy(draw(seed, F.col("id"), F.col("start")), "start")
    negatives = other.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).groupBy("id").agg(F.sort_array(F.collect_set("start")).alias("negatives"))
    return first.join(negatives, "id", "left").select("id", "p_start", "p_stop", F.coalesce(F.size("negatives"), F.lit(0)).alias("n_negatives"))


def kept_by_reply(reply: Column, any_of: list[str], none_of: list[str], max_words: int | None = None) -> Column:
    """A reply check: one of these, none of those, not too long."""
    low = F.lower(reply)
    ok = F.lit(True)
    if any_of:
        one = F.lit(False)
        for x in any_of:
            one = one | F.contains(low, F.lit(x.lower()))
        ok = ok & one
    for x in none_of:
        ok = ok & ~F.contains(low, F.lit(x.lower()))
    return ok & (F.size(X.tokens(reply)) <= max_words) if max_words is not None else ok
