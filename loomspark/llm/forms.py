"""One consistent form for texts that look the same but hold different characters.

Two steps. `compose` settles what no reader sees: width, blanks, hyphens, invisible characters and how letters and marks
are composed. Script-aware repair then looks at each token: its dominant script is determined, and look-alike letters of
another script are substituted only in tokens that mix scripts (or that consist of look-alikes only, amid another
script), and only when the result occurs in the vocabulary of the corpus.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

# Letters that print alike, another script's first, its Latin twin second.
CYRILLIC_TWINS = "аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ѵv ӏl АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ЅS ІI ЈJ ԚQ ԜW ѴV ҮY"
GREEK_TWINS = "οo νv ϲc ϳj ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC"

_TO_LATIN = {"c": {p[0]: p[1] for p in CYRILLIC_TWINS.split()}, "g": {p[0]: p[1] for p in GREEK_TWINS.split()}}
_FROM_LATIN = {s: {v: k for k, v in reversed(pairs.items())} for s, pairs in _TO_LATIN.items()}
_ALL_TO_LATIN = str.maketrans(_TO_LATIN["c"] | _TO_LATIN["g"])

_INVISIBLE = "".join(map(chr, [0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF]))
_BLANKS = "".join(map(chr, [0x09, 0x0B, 0x0C, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]))
_HYPHENS = "‐‑﹣－"
_PLAIN = str.maketrans(
    {c: None for c in _INVISIBLE}
    | {c: " " for c in _BLANKS}
    | {c: "-" for c in _HYPHENS}
    | {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in [*range(0xFF01, 0xFFA0), *range(0xFFE0, 0xFFEF), *range(0xFB00, 0xFB07)] if chr(c) not in _HYPHENS}
)
_UNSETTLED = re.compile("[" + "".join(map(re.escape, map(chr, _PLAIN))) + "]+")
_LINE_END = re.compile(r"\r\n?|[\x85  ]")
_FOREIGN = re.compile("[Ͱ-ϿЀ-ԯἀ-῿]+")
_TOKEN = regex.compile(r"[\p{Latin}\p{Cyrillic}\p{Greek}](?:[\p{Latin}\p{Cyrillic}\p{Greek}]|\p{M})*")
_WORD = re.compile(r"[^\W\d_]+")


def compose(text: str) -> str:
    """Width, blanks, hyphens, line ends, invisible characters and composition in one form."""
    if text.isascii():
        return text.replace("\r\n", "\n").replace("\r", "\n").replace("\t", " ") if "\r" in text or "\t" in text else text
    return unicodedata.normalize("NFC", _UNSETTLED.sub(lambda m: m.group().translate(_PLAIN), _LINE_END.sub("\n", text)))


def skeleton(text: str) -> str:
    """Every look-alike as its Latin twin, without regard to context; for keys, not for reading."""
    if text.isascii() or not _FOREIGN.search(text):
        return text
    return unicodedata.normalize("NFC", _FOREIGN.sub(lambda m: m.group().translate(_ALL_TO_LATIN), unicodedata.normalize("NFD", text)))


def _script(letter: str) -> str:
    code = ord(letter)
    return "c" if 0x400 <= code <= 0x52F else "g" if 0x370 <= code <= 0x3FF or 0x1F00 <= code <= 0x1FFF else "l"


def profile(token: str) -> tuple[str, str]:
    """The scripts a token's letters come from, and those that only letters without twins vouch for."""
    letters = [c for c in unicodedata.normalize("NFD", token) if not unicodedata.combining(c)]
    scripts = {_script(c) for c in letters}
    own = {s for c in letters if (s := _script(c)) != "l" and c not in _TO_LATIN[s]}
    if any(_script(c) == "l" and c not in _FROM_LATIN["c"] and c not in _FROM_LATIN["g"] for c in letters):
        own.add("l")
    return "".join(sorted(scripts)), "".join(sorted(own))


def _turned(token: str, script: str) -> str | None:
    """The token wholly in one script, if every letter of another has a twin there."""
    out = []
    for c in unicodedata.normalize("NFD", token):
        if unicodedata.combining(c) or _script(c) == script:
            out.append(c)
            continue
        latin = c if _script(c) == "l" else _TO_LATIN[_script(c)].get(c)
        twin = latin if script == "l" else _FROM_LATIN[script].get(latin) if latin else None
        if twin is None:
            return None
        out.append(twin)
    return unicodedata.normalize("NFC", "".join(out))


def odd_tokens(text: str) -> list[tuple[int, int, str, str]]:
    """Start, stop, token and the script it should have, of each token that mixes scripts or consists of another
    script's look-alikes only. The script is that of the letters without twins; else of the nearest token that has such
    letters (the next before the previous one); else that of most letters."""
    if not _FOREIGN.search(text):
        return []
    found = [(m.start(), m.end(), m.group(), *profile(m.group())) for m in _TOKEN.finditer(text)]
    sure = [own if len(own) == 1 else "" for *_, own in found]
    after: list[str] = [""] * len(found)
    last = ""
    for k in range(len(found) - 1, -1, -1):
        after[k] = last
        last = sure[k] or last
    out, before = [], ""
    for k, (start, stop, token, scripts, own) in enumerate(found):
        if len(own) <= 1 and scripts != own:
            counts = {s: sum(_script(c) == s for c in token) for s in "lcg"}
            want = own or after[k] or before or max("lcg", key=lambda s: counts[s])
            if scripts != want:
                out.append((start, stop, token, want))
        before = sure[k] or before
    return out


def repaired(text: str, known: dict[str, str]) -> str:
    """The text with each odd token put as `known` has it; a token's key is the token, a blank and the wanted script."""
    out, at = [], 0
    for start, stop, token, want in odd_tokens(text):
        if (to := known.get(f"{token} {want}")) is not None:
            out += [text[at:start], to]
            at = stop
    return text if not out else unicodedata.normalize("NFC", "".join([*out, text[at:]]))


def vocabulary(*texts: DataFrame) -> DataFrame:
    """token: the distinct case-folded words of all given one-column tables, after `compose`. Each task folds its own
    words first, so that only distinct ones are shuffled."""

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[str] = set()
        for batch in batches:
            fresh: set[str] = set()
            for text in batch.iloc[:, 0]:
                if text is not None:
                    fresh.update(_WORD.findall(compose(text).casefold()))
            fresh -= seen
            if len(seen) < 1_000_000:  # what is forgotten is sent again, not lost
                seen |= fresh
            if fresh:
                yield pd.DataFrame({"token": sorted(fresh)})

    parts = [t.mapInPandas(words, "token string") for t in texts]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.distinct()


def consistent(rows: DataFrame, columns: list[str], vocab: DataFrame) -> DataFrame:
    """`rows` with `<column>_form` added for each text column: the consistent form.

    Defined cases: NULL stays NULL, an empty text stays empty; a token is left as it is when no single script fits it,
    when a letter has no twin there, or when the result is no word of the vocabulary and is not reached from two
    spellings either; repeated rows stay repeated; other columns are untouched. The inputs must not hold columns named
    `<column>_form`, `_odd` or `_row`.
    """

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odd: list[set[str]] = [set() for _ in range(len(batch))]
            for column in columns:
                forms = [None if t is None else compose(t) for t in batch[column]]
                batch[f"{column}_form"] = forms
                for keys, form in zip(odd, forms):
                    if form is not None:
                        keys.update(f"{token} {want}" for *_, token, want in odd_tokens(form))
            batch["_odd"] = [sorted(k) if k else None for k in odd]
            yield batch

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            turned = [_turned(*key.rsplit(" ", 1)) for key in batch["key"]]
            out = pd.DataFrame({"key": batch["key"], "to": turned}).dropna()
            yield out.assign(token=out["to"].str.casefold())

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = [dict(zip(k, v)) if k is not None else None for k, v in zip(batch.pop("_keys"), batch.pop("_to"))]
            for column in columns:
                batch[f"{column}_form"] = [t if t is None or not k else repaired(t, k) for t, k in zip(batch[f"{column}_form"], known)]
            yield batch

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), *(f"`{c}_form` string" for c in columns)])
    ready = cut(rows.mapInPandas(prepare, schema + ", _odd array<string>").withColumn("_row", F.monotonically_increasing_id()))
    odd = ready.filter("_odd is not null")
    keys = odd.select(F.explode("_odd").alias("key")).distinct()
    turned = keys.mapInPandas(candidates, "key string, to string, token string")
    twice = turned.groupBy("token").agg(F.count(F.lit(1)).alias("spellings"))
    known = (
        turned.join(twice, "token")
        .join(vocab.withColumn("in_vocabulary", F.lit(True)), "token", "left")
        .filter("spellings > 1 or in_vocabulary")
        .select("key", "to")
    )
    fixes = (
        odd.select("_row", F.explode("_odd").alias("key"))
        .join(known, "key")
        .groupBy("_row")
        .agg(F.collect_list(F.struct("key", "to")).alias("f"))
        .select("_row", F.col("f.key").alias("_keys"), F.col("f.to").alias("_to"))
    )
    fixed = odd.join(fixes, "_row", "left").drop("_row", "_odd").mapInPandas(repair, schema)
    return ready.filter("_odd is null").drop("_row", "_odd").unionByName(fixed)


def quotes_seen_by_readers(objects: DataFrame, documents: DataFrame) -> DataFrame:
    """id, doc_id: quotes that do not occur in a text of their document character by character, but do in consistent
    form. A NULL or blank quote, text or document name pairs with nothing; repeated rows count once."""
    quotes = objects.select("id", "document", "quote").filter("id is not null and document is not null and quote is not null").distinct()
    pairs = (
        quotes.join(documents.select("doc_id", "document", "text").filter("doc_id is not null and text is not null"), "document")
        .filter(~F.contains("text", "quote") & F.col("quote").rlike(r"[^\s]"))
        .select("id", "doc_id", "quote", "text")
    )
    forms = consistent(pairs, ["quote", "text"], vocabulary(documents.select("text"), objects.select("quote")))
    return forms.filter(F.contains("text_form", "quote_form") & (F.trim("quote_form") != "")).select("id", "doc_id").distinct()
