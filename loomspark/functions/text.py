"""Text as column expressions: tokens, normal forms, shingles, set similarity, numbers, draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def normalised(text: Column) -> Column:
    """Lower case, blanks folded."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def without_markup(text: Column) -> Column:
    """Markdown signs removed."""
    return F.translate(text, "*_`#>|", "")


def shingles(words: Column, size: int) -> Column:
    """Distinct runs of `size` words; a shorter list is one run. Linear in the words: shifted slices are zipped."""
    n = F.size(words)
    runs = F.slice(words, F.lit(1), F.greatest(n - F.lit(size - 1), F.lit(0)))
    for k in range(1, size):
        runs = F.zip_with(runs, F.slice(words, F.lit(k + 1), F.greatest(n - F.lit(size - 1), F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(n > size, F.array_distinct(runs)).otherwise(F.array(F.array_join(words, " ")))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; 1 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


# Words too common to carry content.
STOPWORDS = "a an and are as at be by for from had has have in is it its not of on or that the their this to was were which will with".split()


def content_words(words: Column) -> Column:
    """Words of three letters or more, or with a digit, that are no stopword; a plural s is dropped."""
    kept = F.filter(words, lambda w: (~w.isin(*STOPWORDS)) & ((F.length(w) >= 3) | w.rlike("[0-9]")))
    return F.array_distinct(F.transform(kept, lambda w: F.when((F.length(w) > 3) & w.endswith("s"), F.regexp_replace(w, "s$", "")).otherwise(w)))


def numbers(text: Column) -> Column:
    """Every number as written, with separators, without a trailing one."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(-?\d[\d,.]*)"), 1), lambda x: F.regexp_replace(x, r"[,.]+$", ""))


def identity_text(text: Column) -> Column:
    """What decides whether two texts are the same: the body of the first fenced block, if there is one."""
    body = F.regexp_extract(text, r"(?s)```[^\n]*\n(.*?)```", 1)
    return normalised(F.when(body != "", body).otherwise(text))


def draw(seed: str, *ids: Column) -> Column:
    """A number in [0, 1) from the top 52 bits of a hash of a seed and ids; the same on every engine with MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *[i.cast("string") for i in ids])), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def slug(text: Column) -> Column:
    """Lower-case words joined by -."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def byte_span(text: Column, start: Column, stop: Column) -> Column:
    """The text between two UTF-8 byte offsets."""
    return F.call_function("decode", F.call_function("substring", F.encode(text, "UTF-8"), (start + 1).cast("int"), (stop - start).cast("int")), F.lit("UTF-8"))
