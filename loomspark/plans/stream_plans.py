"""Streams over the events file, run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import jobs as J
from .base import DataFrame, Plans, SparkSession, table

P = Plans()


def events(spark: SparkSession, d: str) -> DataFrame:
    like = table(spark, d, "events")
    return J.stream(spark, f"{d}/events.parquet", like).withColumn("ts", F.col("ts").cast("timestamp"))


@P.add("SELECT event_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    out = J.finished(J.tumbling(events(spark, d), "ts", "1 hour", "1 hour", "event_type"))
    return out.select("event_type", F.unix_micros("w.start").alias("start"), "n", F.round("total", 4).alias("total"))


@P.add("""SELECT epoch_us(s) AS start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events) GROUP BY 1""")
def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    out = J.finished(J.sliding(events(spark, d), "ts", "1 hour", "30 minutes", "1 hour"))
    return out.select(F.unix_micros("w.start").alias("start"), "n")


@P.add("""WITH e AS (SELECT user_id, epoch_us(ts) AS us, ts FROM events), f AS (SELECT *, CASE WHEN us - lag(us) OVER w < 3600000000 THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS k FROM f)
    SELECT user_id, min(us) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    out = J.finished(J.session_counts(events(spark, d), "ts", "1 hour", "1 hour", "user_id"))
    return out.select("user_id", F.unix_micros("w.start").alias("start"), "n")


@P.add("SELECT DISTINCT event_id, event_type FROM events")
def stream_once(spark: SparkSession, d: str) -> DataFrame:
    return J.finished(J.once(events(spark, d), "event_id", "ts", "1 hour"), "append").select("event_id", "event_type")


@P.add("SELECT user_id, count(*) AS trials, count(*) FILTER (event_type <> 'error') AS passes FROM events GROUP BY 1")
def stream_pass_rates(spark: SparkSession, d: str) -> DataFrame:
    marked = events(spark, d).select("user_id", (F.col("event_type") != "error").cast("int").alias("passed"))
    out = J.finished(J.pass_rates(marked, "user_id", "passed"), "update")
    return out.groupBy("user_id").agg(F.max("trials").alias("trials"), F.max_by("passes", "trials").alias("passes"))
