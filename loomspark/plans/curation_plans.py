"""Splits, repeats, retrieval and sampling over documents, utterances, orders, line items and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedup as D
from ..operators import retrieval as R
from ..operators import sampling as A
from ..operators import splits as S
from .base import DataFrame, Plans, SparkSession, table

P = Plans()


def u(seed: str, key: str) -> str:
    """The same draw in SQL."""
    return f"(('0x' || substr(md5('{seed}|' || {key}), 1, 13))::BIGINT / 4503599627370496.0)"


def orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders")


@P.add(f"SELECT o_orderkey, CASE WHEN {u('s1', 'o_custkey')} < 0.8 THEN 'train' WHEN {u('s1', 'o_custkey')} < 0.9 THEN 'dev' ELSE 'test' END AS part FROM orders")
def split_drawn(spark: SparkSession, d: str) -> DataFrame:
    return S.drawn_split(orders(spark, d), "o_custkey", "s1", {"train": 0.8, "dev": 0.1, "test": 0.1}).select("o_orderkey", "part")


@P.add(f"""WITH s AS (SELECT *, min(CASE WHEN o_orderdate > TIMESTAMP '1997-01-01' THEN 1 ELSE 0 END) OVER w AS a, max(CASE WHEN o_orderdate > TIMESTAMP '1997-01-01' THEN 1 ELSE 0 END) OVER w AS b FROM orders WINDOW w AS (PARTITION BY o_custkey // 2, o_orderkey % 5))
    SELECT o_orderkey, CASE WHEN a <> b THEN NULL WHEN a = 1 THEN 'test' WHEN {u('s2', "(o_custkey // 2 || '-' || o_orderkey % 5)")} < 0.2 THEN 'validation' ELSE 'train' END AS part, CASE WHEN a <> b THEN 'straddles_cutoff' END AS dropped FROM s""")
def split_temporal(spark: SparkSession, d: str) -> DataFrame:
    rows = orders(spark, d).withColumn("g", F.concat_ws("-", F.expr("o_custkey div 2"), F.expr("o_orderkey % 5")))
    return S.temporal_split(rows, "g", "o_orderdate", "1997-01-01", "s2", 0.2).select("o_orderkey", "part", "dropped")


@P.add("""WITH b AS (SELECT *, (o_orderdate >= TIMESTAMP '1995-01-01')::INT + (o_orderdate >= TIMESTAMP '1997-01-01')::INT AS k FROM orders), w AS (SELECT *, min(k) OVER g AS a, max(k) OVER g AS z FROM b WINDOW g AS (PARTITION BY o_custkey, o_orderkey % 7))
    SELECT coalesce(CASE WHEN a = z THEN k END, -1) AS band, count(*) AS n FROM w GROUP BY 1""")
def split_bands(spark: SparkSession, d: str) -> DataFrame:
    rows = orders(spark, d).withColumn("g", F.struct("o_custkey", F.expr("o_orderkey % 7")))
    banded = S.temporal_bands(rows, "g", "o_orderdate", ["1995-01-01", "1997-01-01"])
    return banded.groupBy(F.coalesce("band", F.lit(-1)).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@P.add("""WITH m AS (SELECT c_custkey, c_nationkey % 5 AS source, c_custkey // 2 AS g FROM customer), k AS (SELECT *, min(source) OVER w AS a, max(source) OVER w AS b FROM m WINDOW w AS (PARTITION BY g))
    SELECT left_out, CASE WHEN source = left_out THEN 'test' ELSE 'train' END AS part, count(*) AS n FROM (SELECT * FROM k WHERE a = b), (SELECT DISTINCT source AS left_out FROM m) GROUP BY ALL""")
def split_by_source(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") % 5).alias("source"), F.expr("c_custkey div 2").alias("g"))
    return S.leave_one_source_out(rows, "g", "source").groupBy("left_out", "part").agg(F.count(F.lit(1)).alias("n"))


@P.add(f"""WITH p AS (SELECT o_orderkey, o_custkey, CASE WHEN {u('s3', 'o_orderkey')} < 0.5 THEN 'a' ELSE 'b' END AS part FROM orders)
    SELECT 'o_custkey in several parts' AS "check", count(*) AS violations FROM (SELECT o_custkey FROM p GROUP BY 1 HAVING count(DISTINCT part) > 1) UNION ALL
    SELECT 'o_orderkey in several parts', count(*) FROM (SELECT o_orderkey FROM p GROUP BY 1 HAVING count(DISTINCT part) > 1)""")
def split_verify(spark: SparkSession, d: str) -> DataFrame:
    return S.verify_disjoint(S.drawn_split(orders(spark, d), "o_orderkey", "s3", {"a": 0.5, "b": 0.5}), "o_custkey", "o_orderkey")


@P.add("""WITH c AS (SELECT o_custkey, o_orderpriority AS s, count(*) AS n FROM orders GROUP BY ALL) SELECT o_custkey, arg_min(s, (-n, s)) AS stratum, sum(n)::BIGINT AS size FROM c GROUP BY 1""")
def split_modal_stratum(spark: SparkSession, d: str) -> DataFrame:
    return S.modal_stratum(orders(spark, d), "o_custkey", "o_orderpriority")


@P.add()
def split_folds(spark: SparkSession, d: str) -> DataFrame:
    return S.folds(orders(spark, d), "o_custkey", "o_orderpriority", 5, "s4")


@P.add(f"""WITH g AS (SELECT o_custkey, o_custkey % 4 AS stratum, count(*) AS size FROM orders GROUP BY ALL), r AS (SELECT *, sum(size) OVER (PARTITION BY stratum ORDER BY {u('s5', 'o_custkey')}, o_custkey ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER (PARTITION BY stratum) AS total FROM g),
    p AS (SELECT *, (upto - size / 2) / total AS position FROM r), h AS (SELECT *, coalesce(sum(size) OVER (ORDER BY floor(position * 1000), position, o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(size) OVER () AS all_ FROM p)
    SELECT o_custkey, round(position, 6) AS position, before < all_ * 0.1 AS held_out FROM h""")
def split_holdout(spark: SparkSession, d: str) -> DataFrame:
    groups = orders(spark, d).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("size")).withColumn("stratum", F.col("o_custkey") % 4)
    return S.holdout(groups, "stratum", "size", "s5", "o_custkey").select("o_custkey", F.round("position", 6).alias("position"), "held_out")


NORM = "lower(trim(regexp_replace({0}, '\\s+', ' ', 'g')))"


@P.add(r"""WITH t AS (SELECT outcome_id, lower(trim(regexp_replace(CASE WHEN regexp_extract(ask, '(?s)```[^\n]*\n(.*?)```', 1) <> '' THEN regexp_extract(ask, '(?s)```[^\n]*\n(.*?)```', 1) ELSE ask END, '\s+', ' ', 'g'))) AS x FROM outcomes WHERE ask IS NOT NULL),
    f AS (SELECT x, min(outcome_id) AS first FROM t GROUP BY x) SELECT DISTINCT outcome_id, first FROM t JOIN f USING (x)""")
def dedup_exact(spark: SparkSession, d: str) -> DataFrame:
    return D.exact_repeats(table(spark, d, "outcomes").filter("ask is not null"), "outcome_id", F.col("ask"), ["outcome_id"]).distinct()


WORDS = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


@P.add()
def dedup_near(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text")
    return D.near_duplicates(docs, "doc_id", F.col("text"))


@P.add()
def dedup_overlap_families(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text")
    return D.overlap_families(docs, "doc_id", F.col("text"))


@P.add("""WITH f AS (SELECT l_partkey, l_suppkey % 3 AS side, l_quantity::INT AS value, l_linenumber AS authority, l_shipdate AS stated FROM lineitem), r AS (SELECT *, rank() OVER (PARTITION BY l_partkey, side ORDER BY authority DESC, stated DESC) AS k FROM f),
    t AS (SELECT l_partkey, side, min(value) FILTER (k = 1) AS lo, max(value) FILTER (k = 1) AS hi, count(DISTINCT value) AS n FROM r GROUP BY ALL)
    SELECT l_partkey, side, coalesce(CASE WHEN lo = hi THEN lo END, -1) AS value, n AS "values", CASE WHEN lo <> hi THEN 'tie' WHEN n > 1 THEN 'decided' ELSE 'agreed' END AS ruling FROM t""")
def conflict_arbitrate(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "lineitem").select("l_partkey", (F.col("l_suppkey") % 3).alias("side"), F.col("l_quantity").cast("int").alias("value"), F.col("l_linenumber").alias("authority"), F.col("l_shipdate").alias("stated"))
    return D.arbitrate(facts, ["l_partkey", "side"], "value", ["authority", "stated"]).withColumn("value", F.coalesce("value", F.lit(-1)))


@P.add()
def memorised_runs(spark: SparkSession, d: str) -> DataFrame:
    """How much of each exam item stands in the documents, in runs of eight words."""
    items = table(spark, d, "exam_items").select("item_id", F.col("instruction").alias("text"))
    return D.memorised(items, table(spark, d, "documents").select("text"), "item_id", "text")


TF = "p AS (SELECT id, unnest(regexp_split_to_array(lower(said), '[^a-z0-9]+')) AS term FROM (SELECT id, min(said) AS said FROM utterances WHERE said IS NOT NULL AND regexp_full_match(said, '[\\x00-\\x7F]*') GROUP BY id)), tf AS (SELECT id, term, count(*) AS tf FROM p WHERE term <> '' GROUP BY ALL), len AS (SELECT id, sum(tf) AS length FROM tf GROUP BY 1)"


def sayings(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "utterances").filter(F.col("said").rlike(r"^[\x00-\x7F]*$"))
    return rows.groupBy("id").agg(F.min("said").alias("said"))


@P.add(f"WITH {TF} SELECT id, sum(tf)::BIGINT AS score FROM tf WHERE term IN ('desk', 'kettle', 'badge') GROUP BY id ORDER BY score DESC, id LIMIT 20")
def retrieve_terms(spark: SparkSession, d: str) -> DataFrame:
    return R.term_counts(R.postings(sayings(spark, d), "id", F.col("said")), "id", ["kettle", "badge", "desk", "desk"], 20)


@P.add(f"""WITH {TF}, q AS (SELECT * FROM (VALUES (1, 'museum'), (1, 'tour'), (2, 'kettle'), (2, 'badge'), (2, 'desk')) t(query, term)), n AS (SELECT count(*) AS n, avg(length) AS m FROM len), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    s AS (SELECT query, tf.id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / m))) AS score FROM tf JOIN q USING (term) JOIN df USING (term) JOIN len USING (id), n GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, id) AS rank FROM s) SELECT query, id, round(score, 6) AS score, rank FROM r WHERE rank <= 15""")
def retrieve_bm25(spark: SparkSession, d: str) -> DataFrame:
    index = R.postings(sayings(spark, d), "id", F.col("said"))
    queries = spark.createDataFrame([(1, "museum"), (1, "tour"), (2, "kettle"), (2, "badge"), (2, "desk")], "query int, term string")
    return R.bm25(index, index.select("id", "length").distinct(), "id", queries, 15).select("query", "id", F.round("score", 6).alias("score"), "rank")


ALL_TF = "p AS (SELECT id, unnest(regexp_split_to_array(lower(said), '[^\\p{L}\\p{N}]+')) AS term FROM (SELECT id, min(said) AS said FROM utterances WHERE said IS NOT NULL GROUP BY id)), tf AS (SELECT id, term, count(*) AS tf FROM p WHERE term <> '' GROUP BY ALL), len AS (SELECT id, sum(tf) AS length FROM tf GROUP BY 1)"


def all_sayings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "utterances").filter("said is not null").groupBy("id").agg(F.min("said").alias("said"))


@P.add(f"WITH {ALL_TF} SELECT id, sum(tf)::BIGINT AS score FROM tf WHERE term IN ('desk', 'kettle', 'badge') GROUP BY id ORDER BY score DESC, id LIMIT 20")
def retrieve_terms_whole(spark: SparkSession, d: str) -> DataFrame:
    """Over utterances in any script; retrieve_terms leaves out those with a non-ASCII character."""
    return R.term_counts(R.postings(all_sayings(spark, d), "id", F.col("said")), "id", ["kettle", "badge", "desk", "desk"], 20)


@P.add(f"""WITH {ALL_TF}, q AS (SELECT * FROM (VALUES (1, 'museum'), (1, 'tour'), (2, 'kettle'), (2, 'badge'), (2, 'desk')) t(query, term)), n AS (SELECT count(*) AS n, avg(length) AS m FROM len), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    s AS (SELECT query, tf.id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / m))) AS score FROM tf JOIN q USING (term) JOIN df USING (term) JOIN len USING (id), n GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, id) AS rank FROM s) SELECT query, id, round(score, 6) AS score, rank FROM r WHERE rank <= 15""")
def retrieve_bm25_whole(spark: SparkSession, d: str) -> DataFrame:
    """Over utterances in any script, as are the document frequencies and the mean length."""
    index = R.postings(all_sayings(spark, d), "id", F.col("said"))
    queries = spark.createDataFrame([(1, "museum"), (1, "tour"), (2, "kettle"), (2, "badge"), (2, "desk")], "query int, term string")
    return R.bm25(index, index.select("id", "length").distinct(), "id", queries, 15).select("query", "id", F.round("score", 6).alias("score"), "rank")


QUERY = "(SELECT embedding FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))"


@P.add(f"SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], {QUERY}::DOUBLE[]), 5) AS score FROM embeddings ORDER BY round(list_cosine_similarity(embedding::DOUBLE[], {QUERY}::DOUBLE[]), 9) DESC, vec_id LIMIT 25")
def retrieve_cosine(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    query = vectors.orderBy("vec_id").select("embedding").first().embedding
    return R.cosine_top(vectors, "vec_id", "embedding", list(query), 25).select("vec_id", F.round("score", 5).alias("score"))


@P.add("""WITH a AS (SELECT p_partkey AS id, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part), b AS (SELECT p_partkey AS id, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS rank FROM part),
    f AS (SELECT id, sum(1.0 / (60 + rank)) AS score FROM (SELECT * FROM a WHERE rank <= 50 UNION ALL SELECT * FROM b WHERE rank <= 50) GROUP BY id) SELECT id, round(score, 8) AS score FROM f""")
def retrieve_fused(spark: SparkSession, d: str) -> DataFrame:
    return R.fuse([top_parts(spark, d, "p_retailprice"), top_parts(spark, d, "p_size")], "id").withColumn("score", F.round("score", 8))


def top_parts(spark: SparkSession, d: str, by: str) -> DataFrame:
    from pyspark.sql import Window

    best = table(spark, d, "part").select(F.col("p_partkey").alias("id"), by).orderBy(F.desc(by), "id").limit(50)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(by), "id"))).select("id", "rank")


@P.add("""WITH a AS (SELECT p_partkey AS id, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part), b AS (SELECT p_partkey AS id, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS rank FROM part),
    h AS (SELECT id, rank AS position FROM a WHERE rank <= 15), t AS (SELECT id, 15 + row_number() OVER (ORDER BY rank, id) AS position FROM b WHERE rank <= 50 AND id NOT IN (SELECT id FROM h)),
    l AS (SELECT * FROM h UNION ALL SELECT * FROM t WHERE position <= 20) SELECT id, position, row_number() OVER (ORDER BY (id % 2 = 0) DESC, position) AS new_position FROM l""")
def retrieve_library(spark: SparkSession, d: str) -> DataFrame:
    found = R.library_find(top_parts(spark, d, "p_retailprice"), top_parts(spark, d, "p_size"), "id", 20)
    return R.rerank(found, F.col("id") % 2 == 0)


@P.add(f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {u('r1', 'c_custkey')}, c_custkey) AS k, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer) SELECT c_custkey FROM r WHERE k <= ceil(n * 0.07)")
def sample_replay(spark: SparkSession, d: str) -> DataFrame:
    return A.lowest_draws(table(spark, d, "customer"), "c_custkey", "r1", 0.07, ["c_mktsegment"]).select("c_custkey")


@P.add(f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {u('r2', 'o_orderkey')}, o_orderkey) AS k FROM orders) SELECT o_orderkey FROM r WHERE k <= 3")
def sample_capped(spark: SparkSession, d: str) -> DataFrame:
    return A.capped(orders(spark, d), ["o_custkey"], "o_orderkey", "r2", 3).select("o_orderkey")


@P.add("WITH r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS i FROM orders) SELECT o_orderkey FROM r WHERE floor(0.5 + 0.3 * i) > floor(0.5 + 0.3 * (i - 1))")
def sample_thinned(spark: SparkSession, d: str) -> DataFrame:
    return A.thinned(orders(spark, d), ["o_orderpriority"], ["o_orderdate", "o_orderkey"], 0.3).select("o_orderkey")


@P.add(f"SELECT p_partkey FROM part WHERE p_size > 0 ORDER BY ln(greatest({u('r3', 'p_partkey')}, 1e-300)) / p_size DESC, p_partkey LIMIT 100")
def sample_weighted(spark: SparkSession, d: str) -> DataFrame:
    return A.weighted(table(spark, d, "part"), "p_partkey", F.col("p_size"), "r3", 100).select("p_partkey")


@P.add(f"WITH r AS (SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {u('r4', 'c_custkey')}, c_custkey) AS k FROM customer) SELECT c_custkey FROM r WHERE k <= 10")
def sample_balanced(spark: SparkSession, d: str) -> DataFrame:
    return A.replay(table(spark, d, "customer"), "c_custkey", "c_mktsegment", "r4", 50).select("c_custkey")


@P.add("WITH r AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS UNBOUNDED PRECEDING) AS s FROM lineitem) SELECT l_orderkey, l_linenumber FROM r WHERE s <= 60")
def sample_budget(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return A.within_budget(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "l_quantity", 60).select("l_orderkey", "l_linenumber")


@P.add(r"""SELECT doc_id, len(regexp_extract_all(text, '-?\d[\d,.]*')) AS n_numbers, regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug,
    len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS n_words FROM documents""")
def text_scalars(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.size(X.numbers(F.col("text"))).alias("n_numbers"), X.slug(F.coalesce("title", F.lit(""))).alias("slug"), F.size(X.tokens(F.col("text"))).alias("n_words"))


@P.add("""WITH o AS (SELECT outcome_id, min(taught_reply) AS a, min(untaught_reply) AS b FROM outcomes WHERE taught_reply IS NOT NULL AND untaught_reply IS NOT NULL GROUP BY 1),
    w AS (SELECT outcome_id, list_distinct(list_filter(regexp_split_to_array(lower(a), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS a, list_distinct(list_filter(regexp_split_to_array(lower(b), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS b FROM o)
    SELECT outcome_id, round(CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 1 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS jaccard FROM w""")
def text_jaccard(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "outcomes").filter("taught_reply is not null and untaught_reply is not null").groupBy("outcome_id").agg(F.min("taught_reply").alias("a"), F.min("untaught_reply").alias("b"))
    return o.select("outcome_id", F.round(X.jaccard(F.array_distinct(X.tokens(F.col("a"))), F.array_distinct(X.tokens(F.col("b")))), 6).alias("jaccard"))
