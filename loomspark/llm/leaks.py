"""Held-out evaluation texts inside a corpus.

Items are partitioned by size. Each document is cut, once for every size class, into half-overlapping windows as long as
the items of that class, so that windows and items are of comparable size. One-permutation MinHash signatures of windows
and of the items' distinctive shingles are compared slot by slot; only the candidates found so are verified, by exact
shingle containment along one running passage.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forms import compose, skeleton
from .overlaps import _WORDS

SHINGLE = 3
SLOTS = 256
#: A window and an item are candidates when their signatures agree in so many slots.
MIN_SLOTS = 3
#: A shingle is distinctive when at most this share of the items of a block (and always two) hold it; an item with fewer
#: than MIN_DISTINCTIVE of them is known by all of its shingles.
MOST_ITEMS, MIN_DISTINCTIVE = 0.02, 8
ITEMS_PER_BLOCK = 20_000
MIN_SHARE = 1 / 3
#: Within a running passage, so many words may be other, missing or added between two matched shingles.
GAP, DRIFT = 4, 2
#: Of a passage's words so many must be found as they are; and of the smallest passage that counts.
MIN_DENSITY, MIN_MATCHED = 0.8, 0.9

class Words:
    """64-bit numbers for words; remembers the frequent ones."""

    def __init__(self, most: int = 1_000_000) -> None:
        self.known: dict[str, int] = {}
        self.most = most

    def of(self, text: str) -> np.ndarray:
        low = text.lower() if text.isascii() else unicodedata.normalize("NFKC", skeleton(compose(text))).casefold()
        known, found = self.known, _WORDS.findall(low)
        if len(known) > self.most:
            known.clear()
        for word in set(found):
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash of every run of SHINGLE words."""
    if len(words) < SHINGLE:
        return np.empty(0, np.uint64)
    out = words[: len(words) - SHINGLE + 1].copy()
    for k in range(1, SHINGLE):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[k : len(words) - SHINGLE + 1 + k]
    return out ^ (out >> np.uint64(32))


_EMPTY = np.uint64(2**64 - 1)


def block_minima(values: np.ndarray, block: np.ndarray, blocks: int) -> np.ndarray:
    """blocks × SLOTS: one permutation hashes every shingle into one slot and to one rank; each block keeps the least rank
    of each slot. block: of each shingle, ascending."""
    mixed = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    slot = (mixed >> np.uint64(56)).astype(np.int64) % SLOTS
    rank = mixed & np.uint64((1 << 56) - 1)
    out = np.full((blocks, SLOTS), _EMPTY, np.uint64)
    np.minimum.at(out.reshape(-1), block * SLOTS + slot, rank)
    return out


def size_class(n: int) -> int:
    """The power of two that is at least n, as its exponent."""
    return max(3, int(n - 1).bit_length())


class Index:
    """The items of one block: signatures by size class for the search, sorted shingles with their places for the check."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        words = Words()
        self.ids, self.lengths, sets = [], [], []
        for item, text in items:
            w = words.of(text)
            if len(s := shingles(w)):
                self.ids.append(item)
                self.lengths.append(len(w))
                sets.append(s)
        held, counts = np.unique(np.concatenate([np.unique(s) for s in sets]) if sets else np.empty(0, np.uint64), return_counts=True)
        common = held[counts > max(2.0, MOST_ITEMS * len(sets))]
        self.places: list[tuple[np.ndarray, np.ndarray]] = []
        own = []
        for s in sets:
            order = np.argsort(s, kind="stable")
            self.places.append((s[order], order))
            rare = s[~np.isin(s, common)]
            own.append(rare if len(rare) >= MIN_DISTINCTIVE else s)
        #: By size class: sorted slot keys, the item of each, and a table that tells most absent keys at one look.
        self.classes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by: dict[int, list[int]] = {}
        for k, s in enumerate(sets):
            by.setdefault(size_class(len(s)), []).append(k)
        for level, members in by.items():
            sizes = np.array([len(own[k]) for k in members])
            minima = block_minima(np.concatenate([own[k] for k in members]), np.repeat(np.arange(len(members)), sizes), len(members))
            at, slot = np.nonzero(minima != _EMPTY)
            keys = (slot.astype(np.uint64) << np.uint64(56)) | minima[at, slot]
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.classes[level] = keys[order], np.array(members)[at[order]], seen

    def candidates(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """document × items + item of each pair that shares MIN_SLOTS slots in one window. sizes: of each document's
        shingles in `values`."""
        n = max(1, len(self.ids))
        out = []
        starts = np.cumsum(sizes) - sizes
        document_of = np.repeat(np.arange(len(sizes)), sizes)
        within = np.arange(len(values)) - starts[document_of]
        for level, (keys, items, seen) in self.classes.items():
            half = 1 << (level - 1)
            counts = -(-sizes // half)
            first = np.cumsum(counts) - counts
            document = np.repeat(np.arange(len(sizes)), counts)
            minima = block_minima(values, first[document_of] + within // half, len(document))
            pairs = np.nonzero(document[1:] == document[:-1])[0]
            window = minima.copy()
            window[pairs] = np.minimum(minima[pairs], minima[pairs + 1])
            at, slot = np.nonzero(seen[(window & np.uint64((1 << 20) - 1)).astype(np.int64)])
            wanted = (slot.astype(np.uint64) << np.uint64(56)) | window[at, slot]
            low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
            hit = np.nonzero((high > low) & (window[at, slot] != _EMPTY))[0]
            times = (high - low)[hit]
            places = np.repeat(low[hit], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            found, agreeing = np.unique(np.repeat(at[hit], times) * n + items[places], return_counts=True)
            found = found[agreeing >= MIN_SLOTS]
            out.append(document[found // n] * n + found % n)
        return np.unique(np.concatenate(out)) if out else np.empty(0, np.int64)

    def matched(self, values: np.ndarray, item: int) -> tuple[list[int], list[int]]:
        """The places of the shingles of a document that an item holds, in the document and in the item."""
        held, order = self.places[item]
        low, high = np.searchsorted(held, values, "left"), np.searchsorted(held, values, "right")
        p = np.nonzero(high > low)[0]
        times = (high - low)[p]
        at = np.repeat(low[p], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(p, times).tolist(), order[at].tolist()


def longest_chain(position: list[int], place: list[int]) -> tuple[int, int]:
    """Words of the item that its longest running passage spans, and how many of them are matched. A passage goes on
    while both text and item advance by at most GAP words and drift apart by at most DRIFT."""
    open_: list[list[int]] = []  # last position, last place, first place, matched words
    best = (0, 0)
    for p, i in zip(position, place):
        chosen = None
        for chain in reversed(open_):
            dp, di = p - chain[0], i - chain[1]
            if 0 < dp <= GAP + SHINGLE and 0 < di <= GAP + SHINGLE and abs(dp - di) <= DRIFT and (chosen is None or chain[3] > chosen[3]):
                chosen = chain
        if chosen is None:
            open_ = [c for c in open_ if p - c[0] <= GAP + SHINGLE]
            open_.append(chosen := [p, i, i, SHINGLE])
        else:
            chosen[3] += min(SHINGLE, i - chosen[1])
            chosen[0], chosen[1] = p, i
        best = max(best, (chosen[1] + SHINGLE - chosen[2], chosen[3]))
    return best


def leaked_items(documents: DataFrame, items: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """doc_id, item_id, share, matched: documents that hold, as one running passage, at least `min_share` of the words of
    an item's instruction; share: of the item's words that the passage spans, matched: of those the ones found as they
    are. Of a passage MIN_DENSITY must be found as it is.

    The items are a stated query set: they are broadcast in blocks of ITEMS_PER_BLOCK, each against all documents.
    Defined cases: NULL ids, texts and instructions take no part; items and texts of fewer than three words hold nothing;
    repeated rows count once; a document is compared whole, whatever its length.
    """
    stated = items.select("item_id", "instruction").filter("item_id is not null and instruction is not null").distinct()
    blocks = -(-stated.count() // ITEMS_PER_BLOCK)
    context = documents.sparkSession.sparkContext
    texts = documents.select("doc_id", "text").filter("doc_id is not null and text is not null")
    schema = "doc_id bigint, item_id bigint, share double, matched double"
    result = documents.sparkSession.createDataFrame([], schema)
    for at in range(blocks):
        part = stated.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == at) if blocks > 1 else stated
        block = context.broadcast(Index(sorted(tuple(r) for r in part.collect())))

        def search(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            index, words = block.value, Words()
            n = max(1, len(index.ids))
            for batch in batches:
                found = []
                for begin in range(0, len(batch), 500):
                    ids = batch["doc_id"].iloc[begin : begin + 500].tolist()
                    values = [shingles(words.of(t)) for t in batch["text"].iloc[begin : begin + 500]]
                    keep = [k for k, v in enumerate(values) if len(v)]
                    if not keep or not index.ids:
                        continue
                    ids, values = [ids[k] for k in keep], [values[k] for k in keep]
                    for pair in index.candidates(np.concatenate(values), np.array([len(v) for v in values])).tolist():
                        d, item = divmod(pair, n)
                        length = index.lengths[item]
                        position, place = index.matched(values[d], item)
                        if len(position) < max(1, int(length * min_share * MIN_DENSITY / 2)):
                            continue
                        span, matched = longest_chain(position, place)
                        if span >= min_share * length and matched >= MIN_DENSITY * span and matched >= MIN_MATCHED * min_share * length:
                            found.append((ids[d], index.ids[item], span / length, matched / length))
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "share", "matched"])

        result = result.unionByName(texts.mapInPandas(search, schema))
    return result.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"), F.max("matched").alias("matched"))
