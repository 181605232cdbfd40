"""Repeats, overlaps, contradictions and conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import cut
from .graph import connected


def exact_repeats(rows: DataFrame, key: str, text: Column, order: list[str]) -> DataFrame:
    """key, first: the first row with the same identity text. Only hashes are shuffled, and copies are folded first."""
    return firsts_of(rows, key, X.identity_text(text), order)


def firsts_of(rows: DataFrame, key: str, same: Column, order: list[str]) -> DataFrame:
    """key, first: the first row with the same value of `same`, by its hash."""
    hashed = rows.select(key, *[c for c in order if c != key], F.sha2(same, 256).alias("h"))
    firsts = hashed.groupBy("h").agg(F.min_by(key, F.struct(*order)).alias("first"))
    return hashed.join(firsts, "h").select(key, "first")


def features(rows: DataFrame, key: str, text: Column, size: int) -> DataFrame:
    """key, f, n: the hashed distinct word runs of each row, and how many there are."""
    sets = rows.select(key, X.shingles(X.tokens(text), size).alias("s"))
    return sets.select(key, F.size("s").alias("n"), F.explode(F.transform("s", lambda x: F.xxhash64(x))).alias("f"))


def similar_pairs(sets: DataFrame, key: str, least: float) -> DataFrame:
    """a, b, jaccard of pairs of sets (key, f, n) with a Jaccard of at least `least`, each pair once. Prefix filter: the
    features of a set are ordered from rare to frequent, and a pair that is similar enough must share one of the first
    n - ceil(least * n) + 1; only those are joined, the exact count follows for the candidates alone."""
    sets = cut(sets)
    frequency = sets.groupBy("f").agg(F.count(F.lit(1)).alias("df"))
    w = Window.partitionBy(key).orderBy("df", "f")
    ordered = sets.join(frequency, "f").withColumn("r", F.row_number().over(w))
    prefix = cut(ordered.filter((F.col("r") <= F.col("n") - F.ceil(F.lit(least) * F.col("n")) + 1) & (F.col("df") > 1)))
    a, b = prefix.select(F.col(key).alias("a"), "f", F.col("n").alias("na")), prefix.select(F.col(key).alias("b"), "f", F.col("n").alias("nb"))
    candidates = cut(a.join(b, "f").filter((F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.lit(least) * F.greatest("na", "nb"))).select("a", "b", "na", "nb").distinct())
    fa, fb = sets.select(F.col(key).alias("a"), "f"), sets.select(F.col(key).alias("b"), "f")
    shared = candidates.join(fa, "a").join(fb, ["b", "f"]).groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("k"))
    ratio = F.col("k") / (F.col("na") + F.col("nb") - F.col("k"))
    return shared.filter(ratio >= least).select("a", "b", ratio.alias("jaccard"))


def near_duplicates(rows: DataFrame, key: str, text: Column, size: int = 5, least: float = 0.8) -> DataFrame:
    """key, class_id, links: copies of a whole text are one representative; representatives that are similar enough are
    linked, and linked ones form a class. links counts the similar texts of a row's representative."""
    copies = cut(firsts_of(rows, key, X.normalised(text), [key]))
    representatives = rows.join(copies.filter(F.col(key) == F.col("first")).select(key), key, "left_semi")
    pairs = cut(similar_pairs(features(representatives, key, text, size), key, least))
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("links")).withColumnRenamed("a", "first")
    classes = connected(pairs.select("a", "b")).select(F.col("node").alias("first"), "component")
    return (
        copies.join(classes, "first", "left").join(degree, "first", "left")
        .select(key, F.coalesce("component", "first").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    )


def overlap_families(rows: DataFrame, key: str, text: Column, size: int = 8, most_holders: int = 6, least_shared: int = 8) -> DataFrame:
    """key, family: rows that share at least `least_shared` runs of `size` words, directly or through others. Runs held by
    more than `most_holders` different texts are boilerplate and bind nothing, which also bounds the join; copies of a text
    count once and share its family."""
    copies = cut(firsts_of(rows, key, text, [key]))
    runs = features(rows.join(copies.filter(F.col(key) == F.col("first")).select(key), key, "left_semi"), key, text, size)
    held = runs.groupBy("f").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n").between(2, most_holders)).select("f")
    kept = cut(runs.select(key, "f").join(held, "f"))
    a, b = kept.select(F.col(key).alias("a"), "f"), kept.select(F.col(key).alias("b"), "f")
    pairs = a.join(b, "f").filter("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= least_shared)
    same = copies.filter(F.col(key) != F.col("first")).select(F.col("first").alias("a"), F.col(key).alias("b"))
    classes = connected(pairs.select("a", "b").unionByName(same)).select(F.col("node").alias(key), "component")
    return rows.select(key).distinct().join(classes, key, "left").select(key, F.coalesce("component", key).alias("family"))


def arbitrate(facts: DataFrame, by: list[str], value: str, order: list[str]) -> DataFrame:
    """By key: the value of the highest authority, then the latest date, then the highest version; where several values
    share that rank the conflict is flagged, not resolved. One aggregation: the least and greatest value at the top."""
    rank = F.struct(*[F.col(c) for c in order])
    a = facts.groupBy(*by).agg(F.max(F.struct(rank.alias("r"), F.col(value).alias("v"))).alias("hi"), F.max(rank).alias("top"), F.count_distinct(value).alias("values"))
    lows = facts.join(a.select(*by, "top"), by).filter(rank == F.col("top")).groupBy(*by).agg(F.min(value).alias("lo"))
    return a.join(lows, by).select(*by, F.when(F.col("lo") == F.col("hi.v"), F.col("lo")).alias("value"), "values", F.when(F.col("lo") != F.col("hi.v"), "tie").when(F.col("values") > 1, "decided").otherwise("agreed").alias("ruling"))


def memorised(answers: DataFrame, corpus: DataFrame, key: str, text: str, size: int = 8) -> DataFrame:
    """key, runs, found, share, longest: how many of an answer's word runs occur in the corpus, and its longest stretch of
    words found (gaps and islands)."""
    def positioned(df: DataFrame) -> DataFrame:
        words = X.tokens(F.col(text))
        n = F.size(words) - (size - 1)
        runs = F.slice(words, F.lit(1), F.greatest(n, F.lit(0)))
        for k in range(1, size):
            runs = F.zip_with(runs, F.slice(words, F.lit(k + 1), F.greatest(n, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        return df.select(key, F.posexplode(F.transform(runs, lambda x: F.xxhash64(x))).alias("p", "f")) if key in df.columns else df.select(F.explode(F.transform(runs, lambda x: F.xxhash64(x))).alias("f")).distinct()

    own = positioned(answers)
    known = own.join(positioned(corpus.select(text)), "f", "left_semi")
    islands = known.withColumn("i", F.col("p") - F.row_number().over(Window.partitionBy(key).orderBy("p"))).groupBy(key, "i").agg(F.count(F.lit(1)).alias("len"))
    found = islands.groupBy(key).agg(F.sum("len").alias("found"), (F.max("len") + size - 1).alias("longest"))
    total = own.groupBy(key).agg(F.count(F.lit(1)).alias("runs"))
    return total.join(found, key, "left").select(key, "runs", F.coalesce("found", F.lit(0)).alias("found"), (F.coalesce("found", F.lit(0)) / F.col("runs")).alias("share"), F.coalesce("longest", F.lit(0)).alias("longest"))
