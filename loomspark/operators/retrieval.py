"""Lexical, dense and fused retrieval; every list is ordered by score, ties by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def postings(rows: DataFrame, key: str, text: Column) -> DataFrame:
    """key, term, tf, length."""
    words = rows.select(key, X.tokens(text).alias("w")).withColumn("length", F.size("w"))
    return words.select(key, "length", F.explode("w").alias("term")).groupBy(key, "term", "length").agg(F.count(F.lit(1)).alias("tf"))


def term_counts(index: DataFrame, key: str, terms: list[str], most: int) -> DataFrame:
    """key, score: summed counts of the distinct query terms."""
    hits = index.filter(F.col("term").isin(*sorted(set(terms))))
    return hits.groupBy(key).agg(F.sum("tf").alias("score")).orderBy(F.desc("score"), key).limit(most)


def bm25(index: DataFrame, documents: DataFrame, key: str, queries: DataFrame, most: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """query, key, score, rank for queries (query, term). Document frequencies are taken over the whole index, but only
    postings of asked terms are scored."""
    asked = queries.select("query", "term").distinct()
    size = documents.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("length").alias("mean_length"))
    hits = index.join(asked.select("term").distinct(), "term", "left_semi")
    frequency = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean_length")))
    scored = hits.join(frequency, "term").join(F.broadcast(size)).join(asked, "term").groupBy("query", key).agg(F.sum(weight).alias("score"))
    w = Window.partitionBy("query").orderBy(F.desc(F.round("score", 9)), key)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def unit(vector: Column) -> Column:
    """A vector of length 1; a zero vector stays."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def cosine_top(vectors: DataFrame, key: str, vector: str, query: list[float], most: int) -> DataFrame:
    """key, score: exact cosine; Spark fuses the sort and the limit, so each task keeps `most` rows."""
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with(unit(F.col(vector)), unit(q), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return vectors.select(key, dot.alias("score")).orderBy(F.desc(F.round("score", 9)), key).limit(most)


def fuse(lists: list[DataFrame], key: str, k: int = 60) -> DataFrame:
    """key, score: reciprocal ranks (from 1) of several lists with a column `rank`."""
    union = lists[0].select(key, "rank")
    for other in lists[1:]:
        union = union.unionByName(other.select(key, "rank"))
    return union.groupBy(key).agg(F.sum(1.0 / (k + F.col("rank"))).alias("score"))


def library_find(semantic: DataFrame, lexical: DataFrame, key: str, most: int) -> DataFrame:
    """key, position: the best of the semantic list, with ceil((most - 1) / 4) places at the end for lexical finds."""
    slots = -(-(most - 1) // 4)
    head = semantic.filter(F.col("rank") <= most - slots).select(key, F.col("rank").alias("position"))
    fresh = lexical.join(head.select(key), key, "left_anti")
    w = Window.orderBy("rank", key)
    tail = fresh.select(key, (F.row_number().over(w) + most - slots).alias("position")).filter(F.col("position") <= most)
    return head.unionByName(tail)


def rerank(found: DataFrame, relevant: Column) -> DataFrame:
    """The relevant first, otherwise in the order they had."""
    return found.withColumn("new_position", F.row_number().over(Window.orderBy(F.desc(relevant), "position")))
