"""Cutting oversized sections at natural boundaries, with an overlap.

Every boundary of a section is joined to its farthest legal successor; the successor tables of a whole batch of
sections are then squared (pointer doubling), so all greedy cuts appear in a logarithmic number of array operations.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1500, 150
#: Ranges of one document that are joined in one part.
RANGES = 2000

#: Boundary classes, best first: paragraph, line, sentence, word. A boundary lies after its blanks.
_CLASSES = (
    (4, re.compile(r"\n[^\S\n]*(?:\n\s*)+")),
    (3, re.compile(r"\n")),
    (2, re.compile(r"[.!?…]+[\"'”’)\]]*\s+|[。！？]+[」』）”]*\s*")),
    (1, re.compile(r"\s+|[、，；：]")),
)
_FORCED = 0


def _hard_positions(text: str, start: int, stop: int) -> np.ndarray:
    """Places inside a run without any boundary where a cut parts no letter from its marks."""
    glue = np.fromiter(
        (unicodedata.combining(c) != 0 or c in "‍︎️" or text[start + i] == "‍" for i, c in enumerate(text[start + 1 : stop])),
        dtype=bool,
        count=max(0, stop - start - 1),
    )
    spots = np.arange(start + 1, stop)[~glue]
    return spots if len(spots) else np.arange(start + 1, stop)


def boundaries(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray]:
    """Positions and classes of all places where a text may be cut; the first is 0, the last its length."""
    best: dict[int, int] = {}
    for level, pattern in _CLASSES:
        for match in pattern.finditer(text):
            best.setdefault(match.end(), level)
    best.pop(0, None)
    best[len(text)] = 4
    at = np.fromiter(sorted(best), dtype=np.int64, count=len(best))
    level = np.fromiter((best[p] for p in at.tolist()), dtype=np.int8, count=len(at))
    edges = np.concatenate([[0], at])
    wide = np.nonzero(np.diff(edges) > limit - overlap)[0]
    if len(wide):
        hard = np.concatenate([_hard_positions(text, int(edges[k]), int(edges[k + 1])) for k in wide])
        at, level = np.concatenate([at, hard]), np.concatenate([level, np.full(len(hard), _FORCED, np.int8)])
        order = np.argsort(at, kind="stable")
        at, level = at[order], level[order]
    return np.concatenate([[0], at]), np.concatenate([[5], level]).astype(np.int8)


def successors(at: np.ndarray, level: np.ndarray, first: np.ndarray, last: np.ndarray, limit: int, overlap: int) -> np.ndarray:
    """For each boundary the index of the farthest legal one: of the best class that fills at least half a piece, else
    the farthest of any class. at: positions in one row of numbers, sections lying further apart than a piece."""
    start = np.where(np.arange(len(at)) == first, at, np.maximum(at - overlap, at[first]))
    reach = start + limit
    best = np.full(len(at), -1, dtype=np.int64)
    for want in (4, 3, 2, 1, 0):
        of = np.nonzero(level >= want)[0]
        k = np.searchsorted(at[of], reach, side="right") - 1
        found = of[np.maximum(k, 0)]
        legal = (k >= 0) & (at[found] > at) & (at[found] >= start + limit // 2)
        best = np.where((best < 0) & legal, found, best)
    for want in (4, 3, 2, 1, 0):  # nothing fills half a piece
        of = np.nonzero(level >= want)[0]
        k = np.searchsorted(at[of], reach, side="right") - 1
        found = of[np.maximum(k, 0)]
        best = np.where((best < 0) & (k >= 0) & (at[found] > at), found, best)
    best = np.where(best < 0, np.minimum(np.arange(len(at)) + 1, last), best)  # letters glued beyond the limit
    return np.where(at[last] <= reach, last, best)


def greedy_cuts(texts: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> list[list[int]]:
    """The cut positions of each text, from 0 to its length, by pointer doubling over all texts at once."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    parts = [boundaries(t, limit, overlap) for t in texts]
    sizes = np.array([len(p[0]) for p in parts])
    if not len(sizes):
        return []
    base = np.cumsum([0, *[len(t) + 2 * limit for t in texts[:-1]]])
    at = np.concatenate([p[0] + b for p, b in zip(parts, base)])
    level = np.concatenate([p[1] for p in parts])
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    jump = successors(at, level, np.repeat(starts, sizes), np.repeat(ends, sizes), limit, overlap)
    cut = np.zeros(len(at), dtype=bool)
    cut[starts] = True
    while True:
        known = np.nonzero(cut)[0]
        cut[jump[known]] = True
        if (jump[starts] == ends).all():
            break
        jump = jump[jump]
    return [at[s : e + 1][cut[s : e + 1]].tolist() for s, e in zip(starts, ends)] if base[-1] == 0 else [
        (at[s : e + 1][cut[s : e + 1]] - b).tolist() for s, e, b in zip(starts, ends, base)
    ]


def sections(documents: DataFrame, candidates: DataFrame, over: int = 0) -> DataFrame:
    """doc_id, section, start, stop, text of each delivered section of more than `over` code points. A byte count bounds
    the code points from above, so shorter ranges are left out before the join. A document of more than RANGES ranges is
    joined in that many parts, so that no task holds all of them."""
    ranges = (
        candidates.select("doc_id", "section", F.col("range.start").alias("start"), F.col("range.stop").alias("stop"))
        .filter(F.col("doc_id").isNotNull() & (F.col("start") >= 0) & (F.col("stop") - F.col("start") > over))
        .distinct()
    )
    hot = ranges.groupBy("doc_id").agg(F.ceil(F.count(F.lit(1)) / RANGES).cast("int").alias("parts")).filter(F.col("parts") > 1)
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("section", "start", "stop"), F.col("parts"))).cast("int")
    ranges = ranges.join(F.broadcast(hot), "doc_id", "left").withColumn("part", part).drop("parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    raw = F.encode("text", "UTF-8")
    return (
        documents.select("doc_id", "text")
        .filter(F.col("doc_id").isNotNull() & (F.octet_length("text") > over))
        .join(F.broadcast(hot), "doc_id", "left")
        .select("doc_id", "text", copies.alias("part"))
        .join(ranges, ["doc_id", "part"])
        .withColumn("raw", raw)
        .select("doc_id", "section", "start", "stop", F.make_valid_utf8(F.expr("cast(substring(raw, cast(start + 1 as int), cast(least(stop - start, 2147483647) as int)) as string)")).alias("text"))
        .filter(F.char_length("text") > over)
    )


def split_oversized(documents: DataFrame, candidates: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """Pieces of every section of more than `limit` code points.

    Returns doc_id, section, start, stop (the section's byte range), piece (from 0), piece_start, piece_stop (code
    points within the section) and, with_text, piece_text. Pieces hold at most `limit` code points; each but the first
    begins `overlap` code points before the end of the one before it.

    Defined cases: a NULL text, doc_id, section bound or range, an empty or inverted range, and a range past the end of
    its text give no piece (the part inside the text counts); a range that parts a character counts the broken
    character as one; rows delivered twice count once, the same section with two ranges as two; a run without any
    boundary is cut between letters; other columns of the inputs are ignored; empty tables give no rows.
    """
    columns = "doc_id bigint, section int, start bigint, stop bigint, piece int, piece_start int, piece_stop int" + (", piece_text string" if with_text else "")

    def cut_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            cuts = greedy_cuts(texts, limit, overlap)
            counts = np.array([len(c) - 1 for c in cuts], dtype=np.int64)
            row = np.repeat(np.arange(len(texts)), counts)
            begins = [0 if k == 0 else max(0, p - overlap) for c in cuts for k, p in enumerate(c[:-1])]
            ends = [p for c in cuts for p in c[1:]]
            out = batch[["doc_id", "section", "start", "stop"]].iloc[row].reset_index(drop=True)
            out["piece"] = [k for n in counts for k in range(n)]
            out["piece_start"], out["piece_stop"] = begins, ends
            if with_text:
                out["piece_text"] = [texts[r][b:e] for r, b, e in zip(row, begins, ends)]
            yield out

    return sections(documents, candidates, limit).mapInPandas(cut_batches, columns)
