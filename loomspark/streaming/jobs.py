"""Structured Streaming forms of the time and pass-rate operators. Every sink replaces its whole result by batch number or
writes append-only files, so a restart from the checkpoint repeats nothing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def stream(spark: SparkSession, path: str, like: DataFrame, per_trigger: int = 8) -> DataFrame:
    """A parquet file or folder as a stream."""
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(like.schema).option("pathGlobFilter", name if name.endswith(".parquet") else "*.parquet").option("maxFilesPerTrigger", per_trigger).parquet(folder if name.endswith(".parquet") and "." in name else path)


def tumbling(events: DataFrame, at: str, size: str, late: str, *by: str) -> DataFrame:
    """Counts and sums by window; what comes later than `late` behind the newest event is dropped."""
    return events.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def sliding(events: DataFrame, at: str, size: str, step: str, late: str, *by: str) -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.window(at, size, step).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))


def session_counts(events: DataFrame, at: str, gap: str, late: str, *by: str) -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))


def once(events: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """Each key once as long as its copies come within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def pass_rates(outcomes: DataFrame, key: str, passed: str) -> DataFrame:
    """key, trials, passes after each batch, with the counts of a key kept as state."""
    kind = outcomes.schema[key].dataType.simpleString()

    def update(name: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        trials, passes = state.get if state.exists else (0, 0)
        for batch in batches:
            marks = batch[passed].dropna()
            trials, passes = trials + len(marks), passes + int(marks.sum())
        state.update((trials, passes))
        yield pd.DataFrame({key: [name[0]], "trials": [trials], "passes": [passes]})

    return outcomes.select(key, passed).groupBy(key).applyInPandasWithState(update, f"`{key}` {kind}, trials bigint, passes bigint", "trials bigint, passes bigint", "update", "NoTimeout")


def finished(result: DataFrame, mode: str = "complete") -> DataFrame:
    """Run a stream to the end of what is there and return its result, written below the shared checkpoint folder. In
    complete mode each batch replaces the one before; in append and update mode batches lie side by side."""
    spark = result.sparkSession
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        target = f"{base}/out" if mode == "complete" else f"{base}/out/batch={number}"
        batch.write.mode("overwrite").parquet(target)

    query = result.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return spark.read.parquet(f"{base}/out")
