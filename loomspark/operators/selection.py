"""Choosing what to learn: relevance to a goal, budgets, quotas, curricula, ledgers, admission and diagnosis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import draw
from .ordered import running_total


def goal_selection(sections: DataFrame, budget: float) -> DataFrame:
    """One reason for each section (id, coverage, words, novelty, weighted, ruling): irrelevant, empty, the conflict's
    ruling, known; the rest by weighted novelty for each word, over_budget once the running words pass the budget, else
    chosen. The running sum is taken over the candidates that passed, which the rules have thinned out."""
    reason = (
        F.when(F.coalesce("coverage", F.lit(0.0)) < 0.5, "irrelevant").when(F.coalesce("words", F.lit(0)) <= 0, "empty").when(F.col("ruling").isNotNull(), F.col("ruling")).when(F.col("novelty") < 0.25, "known")
    )
    judged = sections.withColumn("reason", reason).withColumn("gain", F.col("weighted") * F.col("novelty") / F.col("words"))
    open_ = running_total(judged.filter("reason is null"), "gain", "id", "words", "_s")
    settled = open_.withColumn("reason", F.when(F.col("_s") <= budget, "chosen").otherwise("over_budget")).drop("_s")
    return judged.filter("reason is not null").unionByName(settled).select("id", "reason")


def relevance(terms: DataFrame, gaps: DataFrame, n: Column) -> DataFrame:
    """gap, id, relevance: the share of a gap's squared inverse document frequency that a section's terms cover."""
    df = terms.groupBy("term").agg(F.count_distinct("id").alias("df"))
    weighted = gaps.join(df, "term").withColumn("w", F.pow(F.log(n / F.col("df")), 2))
    total = weighted.groupBy("gap").agg(F.sum("w").alias("total"))
    return weighted.join(terms.select("id", "term").distinct(), "term").groupBy("gap", "id").agg(F.sum("w").alias("covered")).join(total, "gap").filter("total > 0").select("gap", "id", (F.col("covered") / F.col("total")).alias("relevance"))


def ledger(claims: DataFrame, key: str, order: list[str]) -> DataFrame:
    """State of each claim (key, statement, action assert or forget): the last decides; live once, reinforced if the same was
    asserted before, superseded counts what it replaced."""
    last = claims.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])))
    counts = claims.groupBy(key).agg(F.count_if(F.col("action") == "assert").alias("asserted"), F.count_distinct(F.when(F.col("action") == "assert", F.col("statement"))).alias("different"))
    state = F.when(F.col("action") == "forget", "forgotten").when(F.col("asserted") > F.col("different"), "reinforced").when(F.col("different") > 1, "superseding").otherwise("live")
    return last.filter("_n = 1").join(counts, key).select(key, F.when(F.col("action") == "assert", F.col("statement")).alias("statement"), state.alias("state"))


def agreement(claims: DataFrame, key: list[str], run: str, runs: int) -> DataFrame:
    """kept iff every pass produced the claim."""
    return claims.groupBy(*key).agg(F.count_distinct(run).alias("n")).withColumn("ruling", F.when(F.col("n") >= runs, "kept").otherwise("unconfirmed"))


def mastery(attempts: DataFrame, by: list[str], order: list[str], window: int) -> DataFrame:
    """Rate of the newest `window` decided, unaided attempts."""
    own = attempts.filter(F.col("passed").isNotNull() & ~F.col("aided"))
    newest = own.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order]))).filter(F.col("_n") <= window)
    return newest.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("passed").cast("double")).alias("rate"))


def learning_progress(rows: DataFrame, by: list[str], order: list[str], recent: int) -> DataFrame:
    """|mean of the recent window - mean of the one before|; NULL where there is none before."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order]))
    r = rows.withColumn("_n", n).groupBy(*by).agg(F.avg(F.when(F.col("_n") <= recent, F.col("value"))).alias("a"), F.avg(F.when((F.col("_n") > recent) & (F.col("_n") <= 2 * recent), F.col("value"))).alias("b"))
    return r.select(*by, F.abs(F.col("a") - F.col("b")).alias("progress"))


def family_weights(progress: DataFrame, family: str, mix: float) -> DataFrame:
    """Weights that add up to 1: progress by cost, mixed with an even share."""
    all_ = Window.partitionBy(F.lit(1))
    score = F.coalesce(F.col("progress"), F.lit(0.0)) / F.col("cost")
    s, n = F.sum(score).over(all_), F.count(F.lit(1)).over(all_)
    return progress.select(family, ((1 - mix) * F.when(s > 0, score / s).otherwise(1 / n) + mix / n).alias("weight"))


def prompt_draw(prompts: DataFrame, key: str, seed: str, most: int) -> DataFrame:
    """The least visited first, then by weighted draw (a tenth of the weight on a cliff); retired ones never."""
    weight = F.when(F.col("cliff"), 0.1).otherwise(1.0)
    u = F.greatest(draw(seed, F.col(key)), F.lit(1e-300))
    return prompts.filter(~F.col("retired")).withColumn("_k", F.log(u) / weight).orderBy("visits", F.desc("_k"), key).limit(most).drop("_k")


def terms_combined(terms: DataFrame, by: list[str], uses: list[str]) -> DataFrame:
    """The strictest of each use (0 allowed, 1 unknown, 2 forbidden) and all conditions."""
    return terms.groupBy(*by).agg(*[F.max(u).alias(u) for u in uses], F.sort_array(F.collect_set("condition")).alias("conditions"))


def calibration(judged: DataFrame, by: list[str]) -> DataFrame:
    """Precision of passes and fails against the truth, and the share of abstentions; NULL where nothing was claimed."""
    share = lambda said, true: F.avg(F.when(F.col("said") == said, (F.col("truth") == true).cast("double")))
    return judged.groupBy(*by).agg(share("pass", True).alias("precision_pass"), share("fail", False).alias("precision_fail"), F.avg((F.col("said") == "abstain").cast("double")).alias("abstains"))


def diagnosis(attempts: DataFrame) -> DataFrame:
    """The first rule that explains a failed attempt (status, violation, reason, changed, repeats, failing, resource)."""
    infra = F.when(F.col("status").isin("environment_error", "agent_error"), "environment").when(F.col("status") == "verifier_error", "verification").when(F.col("status") == "invalid_task", "unclear_task").when(F.col("status") == "unsupported", "unsupported").when(F.col("status") == "model_error", F.when(F.col("reason").rlike("unreachable|502|504"), "gateway").otherwise("model_server"))
    silent = F.col("reason").rlike("no submission|nothing submitted")
    bounded = F.coalesce(F.col("resource"), F.lit(False))
    return attempts.withColumn(
        "failure",
        F.coalesce(infra, F.when(F.col("violation"), "history_probing"), F.when(~bounded & F.col("reason").isNotNull() & ~silent, "wrong_content"), F.when(~bounded & silent & F.col("changed"), "malformed_artifact"), F.when(F.col("repeats") >= 3, "repetition"), F.when(F.col("failing") > 0, "tool"), F.when(bounded, "resource"), F.when(F.col("reason").isNull(), "no_answer"), F.lit("unclassified")),
    )


def admission(conversations: DataFrame) -> DataFrame:
    """Live conversations need consent, the current scrub and no residue; simulated ones a measurement and no leak."""
    live, sim = F.col("provenance") == "live", F.col("provenance") == "simulated"
    return conversations.withColumn(
        "ruling",
        F.when(live & ~F.coalesce("consent", F.lit(False)), "no_consent").when(live & ~F.coalesce("scrubbed", F.lit(False)), "live_not_scrubbed").when(live & (F.col("residue") > 0), "residual_pii").when(live, "live")
        .when(sim & F.col("reward").isNull(), "unmeasured").when(sim & F.coalesce("leak", F.lit(False)), "answer_key_leak").when(sim, "simulated").otherwise("unknown_provenance"),
    )


def contradictions(facts: DataFrame, subject: Column, question: Column, answer: Column, key: str, least: float = 0.8) -> DataFrame:
    """Pairs of facts of one subject whose questions are nearly the same and whose answers differ. Equal questions are one
    group, so that only different questions of a subject are compared, by shared word runs, never all with all."""
    from ..functions import text as X
    from .dedup import similar_pairs

    f = facts.select(F.col(key).alias("k"), X.normalised(subject).alias("s"), X.normalised(question).alias("q"), X.normalised(answer).alias("a"))
    forms = f.groupBy("s", "q").agg(F.min("k").alias("form"))
    words = forms.select("form", "s", X.shingles(X.tokens(F.col("q")), 2).alias("r"))
    runs = words.select("form", F.size("r").alias("n"), F.explode(F.transform("r", lambda x: F.xxhash64(F.col("s"), x))).alias("f"))
    near = similar_pairs(runs, "form", least).select("a", "b").unionByName(forms.select(F.col("form").alias("a"), F.col("form").alias("b")))
    answers = f.join(forms, ["s", "q"]).groupBy("form", "a").agg(F.min("k").alias("k"))
    left, right = answers.select(F.col("form").alias("a"), F.col("a").alias("x"), F.col("k").alias("ka")), answers.select(F.col("form").alias("b"), F.col("a").alias("y"), F.col("k").alias("kb"))
    return near.join(left, "a").join(right, "b").filter("x <> y and (a <> b or ka < kb)").select(F.least("ka", "kb").alias("id_a"), F.greatest("ka", "kb").alias("id_b")).distinct()
