"""Mixing sources to target weights.

Tokens are counted with a public tokenizer and added up by source; from the totals follow repetition rates, and each
document is emitted floor(rate) times plus once more with the probability that the fraction gives, drawn from a hash.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pattern by which this vocabulary splits a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def source_name(source: Column) -> Column:
    """Lower case, trimmed, with - for blanks and _."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s_]+", "-")


def count_tokens(documents: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, source, tokens. The vocabulary is read on the driver and sent once to each executor (under 1 MB)."""
    shipped = documents.sparkSession.sparkContext.broadcast(Path(ranks).read_bytes())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shipped.value.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        for batch in batches:
            yield batch[["doc_id", "source"]].assign(tokens=[len(encoding.encode_ordinary(t)) for t in batch["text"]])

    rows = documents.select("doc_id", source_name(F.col("source")).alias("source"), "text").filter("doc_id is not null and text is not null and source is not null")
    counted = rows.mapInPandas(count, "doc_id bigint, source string, tokens bigint")
    return counted.groupBy("doc_id").agg(F.min("source").alias("source"), F.max("tokens").alias("tokens"))


def repetition_rates(totals: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """How often a document of each source is taken on average. Without `total` the mix is as large as the scarcest
    source allows, so that every share is met; with it a source that is too small for its share stays at its cap.
    Sources without documents leave their share to nobody; what is left is a proportionate mix."""
    wanted = {s: (share, cap) for s, (share, cap) in targets.items() if share and share > 0 and cap and cap > 0 and totals.get(s)}
    if not wanted:
        return {}
    size = total if total is not None else min(cap * totals[s] / share for s, (share, cap) in wanted.items())
    return {s: min(float(cap), share * size / totals[s]) for s, (share, cap) in wanted.items()}


def mix(documents: DataFrame, targets: DataFrame, seed: int = 0, total: float | None = None, ranks: str = RANKS) -> tuple[DataFrame, DataFrame]:
    """The drawn set (doc_id, copy from 1, source, tokens) and the report (source, target_share, max_repeats, documents,
    tokens, rate, drawn, drawn_tokens, actual_share).

    The targets are one row for each source (a fixed, small table); only sums by target source come to the driver.
    Defined cases: a NULL doc_id, text or source is never drawn; a source without target, with share or cap 0 or NULL is
    not drawn; a doc_id on several rows counts as one document, with the longest of its texts and the least of its
    sources; an empty text has no tokens but may be drawn; a target named twice counts once, with its highest share.
    """
    goals = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").filter("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    counted = cut(count_tokens(documents, ranks))
    sums = counted.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
    known = goals.join(sums, "source", "left").collect()
    rates = repetition_rates({r.source: r.tokens or 0 for r in known}, {r.source: (r.target_share, r.max_repeats) for r in known}, total)
    spark = documents.sparkSession
    rate = spark.createDataFrame([(s, int(math.floor(r)), r - math.floor(r)) for s, r in rates.items()], "source string, whole int, part double")
    # 53 bits of a hash as a number in [0, 1)
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) / F.lit(float(2**53))
    copies = F.col("whole") + F.when(chance < F.col("part"), 1).otherwise(0)
    drawn = (
        counted.join(F.broadcast(rate), "source")
        .withColumn("copies", copies)
        .filter("copies > 0")
        .select("doc_id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "source", "tokens")
    )
    reached = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("drawn"), F.sum("tokens").alias("drawn_tokens"))
    rated = spark.createDataFrame(list(rates.items()), "source string, rate double")
    whole = reached.agg(F.sum("drawn_tokens").alias("all_tokens"))
    report = (
        goals.join(sums, "source", "left").join(F.broadcast(rated), "source", "left").join(reached, "source", "left").join(F.broadcast(whole))
        .select("source", "target_share", "max_repeats", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"), "rate",
                F.coalesce("drawn", F.lit(0)).alias("drawn"), F.coalesce("drawn_tokens", F.lit(0)).alias("drawn_tokens"),
                F.coalesce(F.col("drawn_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"))
    )
    return drawn, report
