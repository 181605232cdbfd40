"""Pages made of repeated keywords, links or tags instead of sentences.

A page is read line by line into pieces. Over all words of the page its suffix automaton is built (all links are one symbol
and all tags another, and every number one digit), and the characters that repeated maximal substrings cover are measured
for each piece. Coverage is weighed against clause structure as log-odds: words that tie clauses together (learned from the
sentences of the whole corpus, no list), the stop at a sentence's end, marks between list elements, links and tags. A
piece of a few words has too little structure to tell, so there coverage decides; a long run without a tie tells by
itself. A page is stuffed when pieces that speak for keywords hold more than half of its words.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Hashable, Iterator
from functools import lru_cache
from itertools import chain, compress

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

_LINK = re.compile(r"\[[^\]\n]*\]\((?:[^()\n]|\([^()\n]*\))*\)|<a\b[^>]*>.*?</a>|(?:https?://|ftp://|www\.)[^\s<>)\]\"']+|<https?:[^>]+>", re.I | re.S)
_MARKUP = re.compile(r"</?[a-z][^>]*>", re.I)
_TAG = re.compile(r"(?<![\w&/])[#@＃＠][^\s#@,;|]*\w|(?<!\S)(?:tags?|keywords?|labels?|topics?|categor(?:y|ies)):[^\s,;|/]+", re.I)
_KEYED = re.compile(r":[^\s,;|/]|[＃＠]")
_FENCE = re.compile(r"^\s*(```|~~~)")
_HEADING = re.compile(r"^\s*#{1,6}\s+\S")
_TABLE = re.compile(r"^\s*\|.*\|\s*$|^\s*\|?[\s:|+=-]{3,}\|?\s*$|^[^\t\n]*\t[^\t\n]*\t")
_LOG = re.compile(r"^\s*[\[(<]?(?:\d{4}[-/.]\d\d[-/.]\d\d|\d{1,2}:\d\d(?::\d\d)?|\w{3} +\d{1,2} \d\d:\d\d)")
_CODE = re.compile(
    r"^\s*(?:[\w.\[\]\"']+\s*(?:[-+*/:|&]?=|:=|=>)\s*\S|(?:if|for|while|def|class|return|import|from|else|elif|try|with|let|const|var|fn|func|function|public|private|SELECT|INSERT|UPDATE)\b.*[(:{;=]\s*(?:[#/].*)?$"
    r"|[$>%] \S|[\w./-]+\s(?:.*\s)?--?[a-z][\w-]*\b|[}\])]+[;,]?\s*$|\[[\w.-]+\]\s*$|(?://|/\*|#!|--\s)\S|.*[;{]\s*$)"
)
_GLOSSARY = re.compile(r"^\s*(?:[-*+•]\s+)?(?:\*\*|__)?[^:–—=\n]{1,60}?(?:\*\*|__)?\s*(?::|–|—|=|\s-)\s+\S+(?:\s+\S+){2,}")
_LISTED = re.compile(r"\S\s+[-–—]\s+\S")
_BULLET = re.compile(r"^\s*(?:[-*+•·>]|\d+[.)])\s+")
_STOP = re.compile(r"[.!?…。！？][\"'”’»)\]]*(?:\s+|(?<=[。！？]))")
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]+")
_ALNUM = re.compile(r"[^\W_]")
_DIGITS = re.compile(r"\d+")
_LINK_SYMBOL, _TAG_SYMBOL = "\x00link", "\x00tag"

_LETTERS = re.compile(r"[^\W\d_]+")
_ASCII_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(256))

#: A page is stuffed when more than this share of its words lies in stuffed pieces.
MOST_STUFFED = 0.5
#: A word ties clauses together when it stands in at least this share of the sentences of a language.
MIN_TIE = 0.025
#: Languages with fewer sentences than this are counted together.
FEW_SENTENCES = 1_000
#: Of a clause's and of a keyword run's words so many are ties.
TIES_IN_CLAUSE, TIES_IN_KEYWORDS = 0.4, 0.06
_TIE, _OTHER = math.log(TIES_IN_CLAUSE / TIES_IN_KEYWORDS), math.log((1 - TIES_IN_KEYWORDS) / (1 - TIES_IN_CLAUSE))
#: Log-odds for a clause: before anything is seen, of a stop, of a list mark, of a link or tag, and of coverage (0 at USUAL).
PRIOR, STOP, MARK, LINK, COVERAGE, USUAL = 1.0, 1.0, 0.5, 1.5, 4.0, 0.4


class Automaton:
    """The suffix automaton of a list of symbols: state k is that of its first k symbols, clones come behind these."""

    def __init__(self, symbols: list[Hashable]) -> None:
        following: list[dict[Hashable, int]] = [{symbol: k} for k, symbol in enumerate(symbols, 1)]
        following.append({})
        links, lengths = [0] * len(following), list(range(len(following)))
        links[0] = -1
        self.next, self.link, self.length = following, links, lengths
        clone = len(following)
        for new, symbol in enumerate(symbols[1:], 2):
            state = links[new - 1]
            while state >= 0:
                edges = following[state]
                to = edges.get(symbol)
                if to:
                    break
                edges[symbol] = new
                state = links[state]
            else:
                continue
            deep = lengths[state] + 1
            if lengths[to] == deep:
                links[new] = to
                continue
            following.append(following[to].copy())
            lengths.append(deep)
            links.append(links[to])
            links[to] = links[new] = clone
            while state >= 0 and (edges := following[state]).get(symbol) == to:
                edges[symbol] = clone
                state = links[state]
            clone += 1

    def covered(self, symbols: list[Hashable]) -> list[bool]:
        """Which places of its list lie in a substring that occurs at least twice. A state's substrings occur again exactly if
        the link of another state leads to it; the longest such one that ends at a place is the whole beginning up to there or
        what its link leads to. None starts before the one that ends a place earlier, so a place is covered if it ends one."""
        links, again = self.link, set(self.link)
        return [links[state] > 0 or state in again for state in range(1, len(symbols) + 1)]


def _cjk_letters(piece: str) -> int:
    return sum(map(len, _CJK.findall(piece)))


def _size(piece: str, words: list[str]) -> int:
    """Words; in scripts without blanks two letters count as one."""
    if piece.isascii():
        return len(words)
    letters = _cjk_letters(piece)
    return len(words) if not letters else max(len(words), letters // 2)


def clause_odds(piece: str, words: list[str], links: int, ties: frozenset[str]) -> float:
    """Log-odds that a piece of a line is a clause and not a run of keywords, from its structure alone."""
    if not piece.isascii() and _cjk_letters(piece) >= 4:
        whole = piece.rstrip("\"'”’」』）) ")[-1:] in "。！？…" or len(max(re.split(r"[\s,、，|/;；・•-]+", piece), key=len)) >= 10
        return 4 * PRIOR if whole else -_OTHER * _size(piece, words) - LINK * links
    n = len(words)
    tied = len(ties.intersection(map(str.lower, words)))
    marks = sum(map(piece.count, ",;|/•·")) + (len(_LISTED.findall(piece)) if " -" in piece or "–" in piece or "—" in piece else 0)
    odds = PRIOR + _TIE * tied - _OTHER * (n - tied) - MARK * max(0.0, marks - n / 4) - LINK * links
    return odds + STOP if n >= 3 and piece.rstrip("\"'”’»)]* _")[-1:] in ".!?…:" else odds


def _clauses(line: str) -> list[str]:
    """A line cut behind each stop."""
    pieces, begin = [], 0
    for stop in _STOP.finditer(line):
        at, end = stop.span()
        pieces.append(line[begin : at + 1])
        begin = end
    pieces.append(line[begin:])
    return pieces


@lru_cache(300_000)
def _spoken(word: str) -> bool:
    """Whether a word has a letter or digit, or stands for a link or tag."""
    return word[0] == "\x00" or _ALNUM.search(word) is not None


def _words(piece: str) -> list[str]:
    parted = piece.replace(",", " ").replace(";", " ").replace("|", " ")
    if not parted.isascii():
        for mark in "•·、，；":
            parted = parted.replace(mark, " ")
    return [w for w in parted.split() if w.isalnum() or _spoken(w)]


def _may_link(line: str) -> bool:
    return "://" in line or "](" in line or "<" in line or "www." in line or "www." in line.lower()


def _may_be_code(line: str, first: str, last: str) -> bool:
    return "=" in line or " -" in line or first in "$>%}])[/#-" or last in "(:{;="


def read_page(text: str) -> list[tuple[str, list[str], int, int]]:
    """The pieces of a page: piece, symbols, its size in words, and of these links and tags; -1 links mark lines of tables,
    code, logs, glossaries and headings, which are no case."""
    fenced, pieces = False, []
    for line in text.splitlines():
        bare = line.strip()
        if not bare:
            continue
        first, last = bare[0], bare[-1]
        if first in "`~" and _FENCE.match(line):
            fenced = not fenced
            continue
        plain = "/" not in line and "." not in line or not _may_link(line) or _LINK.search(line) is None
        has_tag = ("#" in line or "@" in line or ":" in line and _KEYED.search(line) is not None) and _TAG.search(line) is not None
        listed = line.count("-") + line.count("–") + line.count("—") >= 3 and len(_LISTED.findall(line)) >= 3
        if (
            fenced
            or (
                plain
                and not has_tag
                and ((first in "[(<" or first.isdigit() or line[3:4] == " ") and _LOG.match(line) or (first in "|:+=-" or "\t" in line) and _TABLE.match(line) or not listed and _may_be_code(line, first, last) and _CODE.match(line))
            )
            or (first == "|" and _TABLE.match(line))
        ):
            words = line.split()
            pieces.append((line, words, len(words), -1))
            continue
        if first == "#" and _HEADING.match(line):
            words = line.split()[1:]
            pieces.append((line, words, len(words), -1))
            continue
        bare = line if plain else _LINK.sub(lambda m: f" {_LINK_SYMBOL} " * len(m.group().split()), line)
        if "<" in bare:
            bare = _MARKUP.sub(" ", bare)
        if has_tag:
            bare = _TAG.sub(f" {_TAG_SYMBOL} ", bare)
        if not first.isalpha():
            bare = _BULLET.sub("", bare)
        for piece in _clauses(bare):
            words = _words(piece)
            if not words:
                continue
            links = 0 if plain and not has_tag else sum(w[0] == "\x00" for w in words)
            n = _size(piece, words[links:] if links else words)
            structured = not links and n >= 4 and not listed and (":" in piece or "=" in piece or "–" in piece or "—" in piece or " -" in piece) and _GLOSSARY.match(piece)
            pieces.append((piece, words, n + links, -1 if structured else links))
    return pieces


@lru_cache(300_000)
def _symbol(word: str) -> str:
    """What a word is to the automaton: every number one digit, no marks around it, no case."""
    return word if word[0] == "\x00" else _DIGITS.sub("0", word.strip(".:!?\"'()[]*_«»“”-–—/")).casefold()


def measure(text: str, ties: frozenset[str]) -> tuple[int, int, int, float, int]:
    """words, stuffed_words, links, coverage (share of the page's characters in repeated maximal substrings) and
    open_words (words of pieces whose structure alone cannot tell)."""
    pieces = read_page(text)
    total = sum(n for _, _, n, _ in pieces)
    odds = [
        None if links < 0
        else clause_odds(piece, words, 0, ties) if not links
        else clause_odds(piece.replace(_LINK_SYMBOL, "").replace(_TAG_SYMBOL, ""), [w for w in words if w[0] != "\x00"], links, ties)
        for piece, words, _, links in pieces
    ]
    linked = sum(max(0, links) for *_, links in pieces)
    every = list(chain.from_iterable(words for _, words, _, _ in pieces))
    row = list(map(_symbol, every))
    chars = list(map(len, every))
    covered = Automaton(row).covered(row)
    at = stuffed = unsure = 0
    for (_, words, n, _), o in zip(pieces, odds):
        end = at + len(words)
        if o is not None:
            if -COVERAGE * USUAL <= o < COVERAGE * (1 - USUAL):
                unsure += n
                share = sum(compress(chars[at:end], covered[at:end])) / max(1, sum(chars[at:end]))
                if o - COVERAGE * (share - USUAL) < 0:
                    stuffed += n
            elif o < 0:
                stuffed += n
        at = end
    return total, stuffed, linked, sum(compress(chars, covered)) / max(1, sum(chars)), unsure


def sentence_words(text: str) -> Iterator[set[str]]:
    """The different words of each sentence of a text: at least five words up to a stop, with few list marks."""
    for line in text.splitlines():
        if len(line) < 12 or line[0] == "|":
            continue
        for piece in _clauses(line):
            if piece.rstrip("\"'”’»)]* _")[-1:] in (".", "!", "?", "…") and "://" not in piece and "|" not in piece:
                words = piece.encode().translate(_ASCII_LETTERS).decode().split() if piece.isascii() else _LETTERS.findall(piece.lower())
                if len(words) >= 5 and piece.count(",") * 4 <= len(words):
                    yield set(words)


def clause_ties(documents: DataFrame) -> frozenset[str]:
    """The words that stand in at least MIN_TIE of the sentences of a language, over all documents. Their number is
    bounded: a language has at most (words of its mean sentence) / MIN_TIE of them, and languages are told by two letters."""
    lang = F.substring(F.lower(F.trim("lang")), 1, 2) if "lang" in documents.columns else F.lit(None).cast("string")

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: defaultdict[str, Counter[str]] = defaultdict(Counter)
            for code, text in zip(batch["code"], batch["text"]):
                for words in sentence_words(text):
                    words.add("")
                    seen[code].update(words)
            yield pd.DataFrame([(code, word, n) for code, of in seen.items() for word, n in of.items()], columns=["code", "word", "n"])

    texts = documents.filter("text is not null").select(F.coalesce(F.when(lang.rlike("^[a-z]{2}$"), lang), F.lit("")).alias("code"), "text")
    per = cut(texts.mapInPandas(counts, "code string, word string, n long").groupBy("code", "word").agg(F.sum("n").alias("n")))
    sentences = {r.code: r.n for r in per.filter("word = ''").collect()}
    own = [code for code, n in sentences.items() if n >= FEW_SENTENCES]
    least = {code: n for code, n in sentences.items() if code in own} | {"": sum(n for code, n in sentences.items() if code not in own or code == "")}
    group = F.when(F.col("code").isin(own), F.col("code")).otherwise("")
    bound = F.coalesce(*[F.when(F.col("g") == code, MIN_TIE * n) for code, n in least.items()], F.lit(0.0))
    tied = per.filter("word <> ''").groupBy(group.alias("g"), "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= bound)
    return frozenset(r.word for r in tied.select("word").distinct().collect())


def stuffed_pages(documents: DataFrame, ties: frozenset[str] | None = None) -> DataFrame:
    """doc_id, words, stuffed_words, links, coverage, open_words, stuffed for every document with a text. ties: the words
    that tie clauses together; if none are given they are learned from the sentences of all documents (`clause_ties`).

    Defined cases: NULL doc_id or text give no row; an empty text, or one of headings only, is not stuffed; repeated
    rows give one row for each different text; a text is read whole, whatever its length; a missing `lang` column or a NULL
    there is a language of its own; other columns are ignored.
    """
    known = documents.sparkSession.sparkContext.broadcast(clause_ties(documents) if ties is None else ties)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [measure(t, known.value) for t in batch.pop("text")]
            out = pd.DataFrame(rows, columns=["words", "stuffed_words", "links", "coverage", "open_words"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            out["stuffed"] = (out["stuffed_words"] > MOST_STUFFED * out["words"]) & (out["stuffed_words"] > 1)
            yield out

    texts = documents.select("doc_id", "text").filter("doc_id is not null and text is not null")
    return texts.mapInPandas(read, "doc_id bigint, words int, stuffed_words int, links int, coverage double, open_words int, stuffed boolean")
