"""Events of a user are an episode; errors are its events, the others its actions and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import timeline as T
from .base import DataFrame, Plans, SparkSession, table

P = Plans()
HOUR = 3_600_000_000


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


@P.add(f"""WITH e AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS us FROM events), a AS (SELECT user_id, event_id, us AS s, us + {HOUR} * (1 + event_id % 5) AS t FROM e WHERE event_type = 'error'),
    b AS (SELECT user_id, event_id, us AS s, us + {HOUR} * (event_id % 3) AS t FROM e WHERE event_type <> 'error')
    SELECT a.event_id AS left_id, b.event_id AS right_id FROM a JOIN b ON a.user_id = b.user_id AND ((a.s < b.t AND b.s < a.t) OR (b.s = b.t AND a.s <= b.s AND b.s < a.t))""")
def window_overlap(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    a = e.filter("event_type = 'error'").select("user_id", F.col("event_id").alias("left_id"), F.col("us").alias("start"), (F.col("us") + HOUR * (1 + F.col("event_id") % 5)).alias("stop"))
    b = e.filter("event_type <> 'error'").select("user_id", F.col("event_id").alias("right_id"), F.col("us").alias("start"), (F.col("us") + HOUR * (F.col("event_id") % 3)).alias("stop"))
    return T.overlap_join(a, b, ["user_id"], 4 * HOUR).select("left_id", "right_id")


@P.add(f"""WITH e AS (SELECT user_id, event_id, event_type, value, epoch_us(ts) AS us FROM events)
    SELECT a.event_id, count(*) AS n, round(sum(b.value), 4) AS total FROM e a JOIN e b ON a.user_id = b.user_id AND b.us >= a.us - {2 * HOUR} AND b.us < a.us + {HOUR} WHERE a.event_type = 'error' GROUP BY 1""")
def window_around_events(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    pairs = T.around(e.filter("event_type = 'error'").select("user_id", "event_id", F.col("us").alias("at")), e.select("user_id", "value", F.col("us").alias("t")), ["user_id"], 2 * HOUR, HOUR)
    return pairs.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@P.add(f"""WITH e AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS us FROM events)
    SELECT a.user_id, a.event_id FROM e a WHERE a.event_type <> 'error' AND EXISTS (SELECT 1 FROM e b WHERE b.user_id = a.user_id AND b.event_type = 'error' AND b.us BETWEEN a.us AND a.us + {3 * HOUR})""")
def window_followed_by(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    actions = e.filter("event_type <> 'error'").select("user_id", "event_id", F.col("us").alias("start"))
    return T.followed_by(actions, e.filter("event_type = 'error'").select("user_id", F.col("us").alias("t")), ["user_id"], 3 * HOUR).select("user_id", "event_id")


@P.add("""WITH e AS (SELECT user_id, event_id, event_type, value, epoch_us(ts) AS us FROM events)
    SELECT a.event_id, (SELECT max_by(b.value, (b.us, b.event_id)) FROM e b WHERE b.user_id = a.user_id AND b.event_type = 'view' AND b.us <= a.us) AS as_of_value FROM e a WHERE a.event_type = 'error'""")
def window_as_of(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    views = e.filter("event_type = 'view'").groupBy("user_id", "us").agg(F.max_by("value", "event_id").alias("value"))
    return T.as_of(e.filter("event_type = 'error'").select("user_id", "event_id", "us"), views, ["user_id"], "us", ["value"], 24 * HOUR).select("event_id", "as_of_value")


@P.add("""WITH e AS (SELECT user_id, event_id, event_type, value, epoch_us(ts) AS t FROM events), c AS (SELECT user_id, (min(t) + max(t)) // 2 AS cut FROM e GROUP BY 1)
    SELECT c.user_id, (SELECT max_by(value, (t, value)) FROM e WHERE e.user_id = c.user_id AND event_type <> 'error' AND t <= cut) AS last_value,
        (SELECT count(value) FROM e WHERE e.user_id = c.user_id AND event_type <> 'error' AND t <= cut HAVING count(*) > 0) AS n_known,
        (SELECT min(t) FROM e WHERE e.user_id = c.user_id AND event_type = 'error' AND t >= cut) AS first_after FROM c""")
def point_in_time_view(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).select("user_id", "event_type", "value", F.col("us").alias("t"))
    cuts = e.groupBy("user_id").agg(F.expr("(min(t) + max(t)) div 2").alias("cut"))
    return T.point_in_time(e.filter("event_type <> 'error'"), e.filter("event_type = 'error'"), cuts, "user_id").drop("cut")


@P.add("""WITH s AS (SELECT o_orderpriority AS arm, (datediff('day', DATE '1992-01-01', o_orderdate::DATE) // 30) AS time, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS event FROM orders),
    g AS (SELECT arm, time, sum(event) AS events, count(*) AS n FROM s GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY arm ORDER BY time DESC) AS at_risk FROM g)
    SELECT arm, time, at_risk::BIGINT AS at_risk, events::BIGINT AS events, round(CASE WHEN max(CASE WHEN events = at_risk THEN 1 ELSE 0 END) OVER w = 1 THEN 0 ELSE exp(sum(CASE WHEN events < at_risk THEN ln(1 - events / at_risk) END) OVER w) END, 6) AS survival
    FROM r WINDOW w AS (PARTITION BY arm ORDER BY time ROWS UNBOUNDED PRECEDING)""")
def survival_curve(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "orders").select(F.col("o_orderpriority").alias("arm"), F.expr("datediff(cast(o_orderdate as date), date'1992-01-01') div 30").alias("time"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("event"))
    return T.kaplan_meier(s, ["arm"]).withColumn("survival", F.round("survival", 6))


@P.add(f"""WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events), f AS (SELECT *, CASE WHEN us - lag(us) OVER w <= {HOUR} THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
    SELECT event_id, (sum(fresh) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS session FROM f""")
def window_sessions(spark: SparkSession, d: str) -> DataFrame:
    return T.sessions(events(spark, d), ["user_id"], "us", HOUR).select("event_id", "session")


@P.add("""SELECT event_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def window_tumbling(spark: SparkSession, d: str) -> DataFrame:
    w = F.window("ts", "1 hour")
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).groupBy("event_type", w.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select("event_type", F.unix_micros("w.start").alias("start"), "n", "total")


@P.add("SELECT event_id, us + 1000000 + CAST(round(0.25 * (us - 1600000000000000)) AS BIGINT) AS device_us FROM (SELECT event_id, epoch_us(ts) AS us FROM events)")
def clock_convert(spark: SparkSession, d: str) -> DataFrame:
    ref = F.lit(1_600_000_000_000_000).cast("long")
    return events(spark, d).select("event_id", T.convert(F.col("us"), ref, ref + 1_000_000, F.lit(1.25)).alias("device_us"))
