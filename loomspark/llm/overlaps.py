"""The same or almost the same records in training and evaluation splits.

Each record becomes its content words and its identity (numbers, and names that carry one). Word bigrams of the
evaluation records are hashed together with the identity and partitioned; the training records are scanned for hits, the
containment of each evaluation record in each hit training record is computed, and what passes is verified word by word.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .forms import compose, skeleton

# Words that may come, go or change without changing what is said.
SMALL = set(
    "a an and the then is are was were be been it its that this these those there here of to in on at by for from with near beside next into onto off "
    "over under up out as so or but if when while after before following since because i me my we us our ours you your youll youre youve he she they them their "
    "he's do does did dont doesnt have has had will would can could may might shall should must not just really also too very quite "
    "um uh er erm hm hmm ah oh like well okay ok right yes yeah no know got thanks thank please actually listen sorry anyway basically kind sort mean "
    "upon now one more thing way record remember all s t ll re ve d m thats whats im ill ive".split()
)
_SUFFIX = re.compile(r"['’ʼ](?:s|t|ll|re|ve|d|m)\b|['’ʼ]")
_WORDS = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"\d+")

MIN_CONTAINMENT = 0.2
#: So many hit pairs (16 MB of keys) may be broadcast to thin out the records before their words are shuffled.
BROADCAST_PAIRS = 1_000_000


def words(said: str) -> list[str]:
    """The words of an utterance without regard to case, marks, layout or character form."""
    text = unicodedata.normalize("NFKC", skeleton(compose(said))).casefold()
    return _WORDS.findall(_SUFFIX.sub(" ", text).replace("_", " "))


def identity(tokens: list[str]) -> list[str]:
    """Every number; a short one (at most three digits) together with the word before it, as in names like abc-7."""
    out = set()
    for k, token in enumerate(tokens):
        for run in _DIGITS.findall(token):
            before = tokens[k - 1] if k and len(run) <= 3 and not token[:1].isalpha() else ""
            out.add((before if before not in SMALL else "") + run)
    return sorted(out)


def _close(a: str, b: str) -> bool:
    """One slip apart (two in words of seven letters or more): a letter more, less or other, or two swapped."""
    if len(a) > len(b):
        a, b = b, a
    most = 0 if len(a) < 3 else 1 if len(b) < 7 else 2
    if len(b) - len(a) > most or len(set(b) - set(a)) > most:
        return False
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            new.append(cost)
        before, row = row, new
        if min(row) > most:
            return False
    return row[-1] <= most


def unexplained(a: list[str], b: list[str], most: int = 1_000_000) -> int:
    """Content words of `a` without a counterpart in `b`; stops counting above `most`."""
    there = set(b)
    joined = "".join(b)
    count = 0
    for word in set(a) - there - SMALL:
        if word.isdigit() or (len(word) >= 4 and word in joined) or any(_close(word, other) for other in there):
            continue
        count += 1
        if count > most:
            break
    return count


def same_saying(a: list[str], b: list[str]) -> bool:
    """Whether two lists of words of equal identity say the same in almost the same words: what is missing is on one side
    only (another word in its place is another saying) and is at most a word or a tenth of the longer list."""
    most = max(1, max(len(a), len(b)) // 10)
    left = unexplained(a, b, most)
    return left <= most and unexplained(b, a, 0 if left else most) <= (0 if left else most)


def split_name(split: Column) -> Column:
    """train, dev or test; NULL for anything else."""
    low = F.lower(F.trim(split))
    return (
        F.when(low.isin("train", "training"), "train").when(low.isin("dev", "val", "validation"), "dev").when(low == "test", "test")
    )


def _prepared(utterances: DataFrame) -> DataFrame:
    """id, split, source, saying (canonical words), key (identity and content words), class_id of each record that counts."""

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = [words(said) for said in batch.pop("said")]
            batch["saying"] = [" ".join(t) for t in tokens]
            batch["identity"] = [" ".join(identity(t)) for t in tokens]
            batch["content"] = [" ".join(w for w in t if w not in SMALL and not w.isdigit()) for t in tokens]
            yield batch[batch["saying"] != ""]

    rows = (
        utterances.select("id", split_name(F.col("split")).alias("split"), F.lower(F.trim("source")).alias("source"), "said")
        .filter("id is not null and split is not null and said is not null")
        .distinct()
        .mapInPandas(prepare, "id string, split string, source string, saying string, identity string, content string")
    )
    return rows.withColumn("class_id", F.xxhash64("saying"))


def _grams(rows: DataFrame) -> DataFrame:
    """class_id, gram, n: hashes of the bigrams of content words (of the only word, where there is but one), with the
    identity in the hash, so that hits need equal numbers and names; n counts a class's distinct ones."""
    tokens = F.split("content", " ")
    pairs = F.when(
        F.contains("content", F.lit(" ")),
        F.zip_with(F.slice(tokens, 1, F.size(tokens) - 1), F.slice(tokens, 2, F.size(tokens) - 1), lambda a, b: F.xxhash64("identity", a, b)),
    ).otherwise(F.array(F.xxhash64("identity", "content")))
    classes = rows.groupBy("class_id").agg(F.first("identity").alias("identity"), F.first("content").alias("content"))
    grams = classes.select("class_id", F.array_distinct(pairs).alias("grams"))
    return grams.select("class_id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))


def cross_split_overlaps(utterances: DataFrame, min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """id_eval, id_train, split, source (of the evaluation record), containment: each record of dev or test and each
    training record that says the same in almost the same words.

    Records with equal words form one class, so that copies are compared once; only the result holds them in pairs.
    Defined cases: NULL id, split or `said` and a `said` without a word take no part; ids delivered twice count once for
    each different text; source may be NULL; a record of unknown split takes no part; long texts are compared whole.
    """
    rows = cut(_prepared(utterances))
    evaluation, training = rows.filter("split <> 'train'"), rows.filter("split = 'train'")
    grams_e = _grams(evaluation).withColumnRenamed("class_id", "e")
    grams_t = _grams(training).select(F.col("class_id").alias("t"), "gram")
    hits = (
        grams_e.join(grams_t, "gram")
        .filter("e <> t")
        .groupBy("e", "t")
        .agg((F.count(F.lit(1)) / F.first("n")).alias("containment"))
        .filter(F.col("containment") >= min_containment)
    )
    hits = cut(hits)
    few = hits.count() <= BROADCAST_PAIRS

    def sayings(side: DataFrame, key: str) -> DataFrame:
        """What the classes that were hit say; where they are few, the others are left out before the shuffle."""
        if few:
            side = side.join(F.broadcast(hits.select(F.col(key).alias("class_id")).distinct()), "class_id", "left_semi")
        return side.groupBy("class_id").agg(F.first("saying").alias(f"said_{key}")).withColumnRenamed("class_id", key)

    candidates = hits.join(sayings(evaluation, "e"), "e").join(sayings(training, "t"), "t")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            same = [same_saying(a.split(), b.split()) for a, b in zip(batch["said_e"], batch["said_t"])]
            yield batch[same][["e", "t", "containment"]]

    near = candidates.select("e", "t", "containment", "said_e", "said_t").mapInPandas(verify, "e bigint, t bigint, containment double")
    exact = (
        evaluation.select("class_id").distinct().join(training.select("class_id").distinct(), "class_id")
        .select(F.col("class_id").alias("e"), F.col("class_id").alias("t"), F.lit(1.0).alias("containment"))
    )
    links = near.unionByName(exact)
    left = evaluation.select(F.col("class_id").alias("e"), F.col("id").alias("id_eval"), "split", "source")
    right = training.select(F.col("class_id").alias("t"), F.col("id").alias("id_train"))
    return (
        links.join(left, "e").join(right, "t").filter("id_eval <> id_train").select("id_eval", "id_train", "split", "source", "containment").distinct()
    )


def overlap_report(pairs: DataFrame) -> DataFrame:
    """split, source, records (evaluation records with a copy in training), pairs."""
    each = pairs.groupBy("split", "source", "id_eval").agg(F.count_distinct("id_train").alias("n"))
    return each.groupBy("split", "source").agg(F.count(F.lit(1)).alias("records"), F.sum("n").alias("pairs"))
