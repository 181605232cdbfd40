"""Operators over relations between attempts, and what keeps exams apart from training."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.text import draw
from .verdicts import exclusions


def critic(relations: DataFrame, experiences: DataFrame) -> DataFrame:
    """critique, critiqued, exclusion for CritiqueOf relations (src critiques dst): the critique must be verified and both
    must have an answer; a missing side is counted."""
    side = lambda p: experiences.select(F.col("id").alias(p), F.col("answer").alias(f"{p}_answer"), F.col("passed").alias(f"{p}_passed"), F.lit(True).alias(f"{p}_there"))
    j = relations.select(F.col("src").alias("critique"), F.col("dst").alias("critiqued")).join(side("critique"), "critique", "left").join(side("critiqued"), "critiqued", "left")
    empty = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    return exclusions(j, [("unverified_critique", ~F.coalesce("critique_passed", F.lit(False))), ("no_final_output", empty("critique_answer")), ("related_missing", F.col("critiqued_there").isNull()), ("no_final_output", empty("critiqued_answer"))])


def first_difference(a: Column, b: Column) -> Column:
    """Where two arrays first differ (from 0); NULL if one begins with the other and they are as long as each other."""
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1), lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return F.when(F.greatest(F.size(a), F.size(b)) > 0, F.array_min(places))


def decisions(relations: DataFrame, attempts: DataFrame) -> DataFrame:
    """winner, loser, at, exclusion for RetryOf and RevisionOf relations: where a passing and a failing sibling part."""
    side = lambda p: attempts.select(F.col("id").alias(p), F.col("steps").alias(f"{p}_steps"), F.col("passed").alias(f"{p}_passed"), F.lit(True).alias(f"{p}_there"))
    j = relations.join(side("src"), "src", "left").join(side("dst"), "dst", "left")
    won = F.col("src_passed") & ~F.col("dst_passed")
    lost = F.col("dst_passed") & ~F.col("src_passed")
    at = first_difference(F.col("src_steps"), F.col("dst_steps"))
    j = j.withColumns({"winner": F.when(won, F.col("src")).when(lost, F.col("dst")), "loser": F.when(won, F.col("dst")).when(lost, F.col("src")), "at": at})
    inside = (F.col("at") < F.size("src_steps")) & (F.col("at") < F.size("dst_steps"))
    return exclusions(j, [("related_missing", F.col("src_there").isNull() | F.col("dst_there").isNull()), ("no_preferred_path", F.col("winner").isNull()), ("no_divergence", ~F.coalesce(inside, F.lit(False)))]).select("src", "dst", "winner", "loser", "at", "exclusion")


def repairs(fixed: DataFrame, failed: DataFrame, task: str) -> DataFrame:
    """chosen, rejected: a repair and a failure of the same task that it begins as a copy of (`copied` steps)."""
    a = fixed.select(task, F.col("id").alias("chosen"), F.col("steps").alias("a"), "copied")
    b = failed.select(task, F.col("id").alias("rejected"), F.col("steps").alias("b"))
    return a.join(b, task).filter((F.col("copied") > 0) & (F.slice("a", F.lit(1), F.col("copied")) == F.slice("b", F.lit(1), F.col("copied")))).select(task, "chosen", "rejected")


def grouped(records: DataFrame, evidence: DataFrame, families: DataFrame) -> DataFrame:
    """id, family: the least family of the blobs a record rests on; a record without any stays NULL."""
    of = evidence.join(families, "blob", "left").groupBy("id").agg(F.min(F.coalesce("family", "blob")).alias("family"))
    return records.select("id").join(of, "id", "left")


def reserved(families: DataFrame, family: str, words: str, seed: str, exam: int, dev: int, least: int = 120) -> DataFrame:
    """family, use: exam and dev families in hashed order among those with enough words."""
    order = families.filter(F.col(words) >= least).withColumn("_u", draw(seed, F.col(family))).orderBy("_u", family).limit(exam + dev)
    n = F.row_number().over(Window.orderBy("_u", family))
    return order.withColumn("use", F.when(n <= exam, "exam").otherwise("dev")).select(family, "use")


def sealed(corpus: DataFrame, reserved_families: DataFrame, family: str, drop: bool) -> DataFrame:
    """The corpus without what reserved families hold; unless told to drop it, anything found is an error that counts it."""
    if drop:
        return corpus.join(reserved_families.select(family), family, "left_anti")
    n = corpus.join(reserved_families.select(family), family, "left_semi").count()
    if n:
        raise ValueError(f"{n} rows lie in reserved families")
    return corpus


def exposed(shown: DataFrame, hidden: DataFrame, public: DataFrame, key: str, text: str, size: int = 12) -> DataFrame:
    """key, windows: how many word windows of a hidden text a shown text holds, those that are public left out. Tokens of
    digits alone do not count."""
    def windows(df: DataFrame, *keep: str) -> DataFrame:
        words = F.filter(X.tokens(F.col(text)), lambda w: ~w.rlike("^[0-9]+$"))
        return df.select(*keep, words.alias("w")).filter(F.size("w") >= 4).select(*keep, F.explode(F.transform(X.shingles(F.col("w"), size), lambda x: F.xxhash64(x))).alias("f")).distinct()

    secret = windows(hidden).join(windows(public), "f", "left_anti")
    return windows(shown, key).join(secret, "f", "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("windows"))


def quota(candidates: DataFrame, dimensions: list[str], order: list[str], key: str, share: float, wanted: int) -> DataFrame:
    """Greedy choice in order while every dimension has room: limit = ceil(max(share, 1 / groups) * wanted). The walk sees
    at most the least limit of rows for each combination of values; the dimensions have few values by contract."""
    limits = {c: -(-int(max(share, 1 / max(1, n)) * wanted * 1_000_000) // 1_000_000) for c, n in candidates.agg(*[F.count_distinct(c).alias(c) for c in dimensions]).first().asDict().items()}
    # rows of the same values differ in their order only, so of each combination no more than the least limit can be chosen
    nth = F.row_number().over(Window.partitionBy(*dimensions).orderBy(*order, key))
    bounded = candidates.withColumn("_n", nth).filter(F.col("_n") <= max(1, min(limits.values())))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        used: dict[tuple[str, object], int] = {}
        out = []
        for row in pdf.sort_values([*order, key]).to_dict("records"):
            full = next((c for c in dimensions if used.get((c, row[c]), 0) >= limits[c]), None)
            done = sum(x is None for _, x in out) >= wanted
            out.append((row[key], full if full else ("beyond" if done else None)))
            if not full and not done:
                for c in dimensions:
                    used[c, row[c]] = used.get((c, row[c]), 0) + 1
        return pd.DataFrame(out, columns=[key, "blamed"])

    kind = candidates.schema[key].dataType.simpleString()
    return bounded.groupBy(F.lit(0).alias("_all")).applyInPandas(lambda pdf: walk(pdf), f"`{key}` {kind}, blamed string").filter("blamed is null").select(key)


def alarm(rounds: DataFrame, by: list[str], order: str, width: int, rise: float, most: float) -> DataFrame:
    """Over the latest `width` rounds: diverging if the reward rises and the held-out score does not, unconfirmed without a
    held-out trend, else steady; NULL below two rounds."""
    newest = rounds.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order)))).filter(F.col("_n") <= width)
    t = newest.groupBy(*by).agg(F.count("reward").alias("n"), (F.max_by("reward", order) - F.min_by("reward", order)).alias("up"), F.count("held_out").alias("h"), (F.max_by("held_out", F.when(F.col("held_out").isNotNull(), F.col(order))) - F.min_by("held_out", F.when(F.col("held_out").isNotNull(), F.col(order)))).alias("held"))
    return t.select(*by, F.when(F.col("n") < 2, None).when((F.col("up") >= rise) & (F.col("h") < 2), "unconfirmed").when((F.col("up") >= rise) & (F.col("held") <= most), "diverging").otherwise("steady").alias("state"))


def exposure(draws: DataFrame, by: list[str], order: list[str], total: Column) -> DataFrame:
    """zeta before each draw: what of the used is left, among what remains."""
    w = Window.partitionBy(*by).orderBy(*order)
    before = F.row_number().over(w) - 1
    used_before = F.coalesce(F.sum(F.col("used").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    used = F.sum(F.col("used").cast("int")).over(Window.partitionBy(*by))
    return draws.withColumn("zeta", (used - used_before) / (total - before))


def competence(rows: DataFrame, by: list[str]) -> DataFrame:
    """Quality (mean over families of mean rewards), cost and autonomy; unmeasured stays out."""
    f = rows.groupBy(*by, "family").agg(F.avg("reward").alias("q"), F.avg("cost").alias("c"), F.avg(F.col("unaided").cast("double")).alias("a"))
    return f.groupBy(*by).agg(F.avg("q").alias("quality"), F.avg("c").alias("cost"), F.avg("a").alias("autonomy"), F.count("q").alias("families"))


def harmonised(values: DataFrame, by: list[str], low: Column, high: Column, least: int = 10, outside: float = 0.1, ratio: float = 5.0) -> DataFrame:
    """Admission of measured variables: enough values, few outside the range, spreads that fit. reference: the spread."""
    v = values.groupBy(*by).agg(F.count("value").alias("n"), F.avg(((F.col("value") < low) | (F.col("value") > high)).cast("double")).alias("out"), F.stddev_pop("value").alias("spread"), F.first("reference").alias("reference"))
    return v.select(*by, "n", F.when(F.col("n") < least, "too_few").when(F.col("out") > outside, "out_of_range").when(F.greatest(F.col("spread") / F.col("reference"), F.col("reference") / F.col("spread")) > ratio, "spread").otherwise("admitted").alias("ruling"))


def opaque(rows: DataFrame, column: str, secret: str) -> DataFrame:
    """An identifier as a keyed hash (HMAC-SHA-256), the same for the same secret."""
    import hashlib
    import hmac

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch[column] = [None if v is None else hmac.new(secret.encode(), str(v).encode(), hashlib.sha256).hexdigest() for v in batch[column]]
            yield batch

    schema = ", ".join(f"`{f.name}` {'string' if f.name == column else f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, schema)


def sample_slice(chunks: DataFrame, by: list[str], start: Column, stop: Column) -> DataFrame:
    """The samples (arrays `samples` whose first has the number `first`) of [start, stop) across chunk borders."""
    low, high = F.greatest(start - F.col("first"), F.lit(0)), F.least(stop - F.col("first"), F.size("samples").cast("long"))
    cut = chunks.filter((F.col("first") < stop) & (F.col("first") + F.size("samples") > start)).withColumn("_s", F.slice("samples", (low + 1).cast("int"), F.greatest(high - low, F.lit(0)).cast("int")))
    return cut.groupBy(*by).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("first", "_s"))), lambda x: x["_s"])).alias("samples"))
