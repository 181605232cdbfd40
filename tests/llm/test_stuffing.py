import random
import re

from loomspark.llm import stuffing
from loomspark.llm.stuffing import Automaton, clause_ties, measure, read_page, stuffed_pages


def test_automaton_against_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        row = [rng.randint(0, 4) for _ in range(rng.randint(1, 40))]
        n = len(row)
        occurs = lambda x: sum(row[k : k + len(x)] == x for k in range(n - len(x) + 1))
        wanted = [False] * n
        for a in range(n):
            for b in range(a + 1, n + 1):
                if occurs(row[a:b]) > 1:
                    wanted[a:b] = [True] * (b - a)
        assert Automaton(row).covered(row) == wanted


SENTENCES = "The team keeps two rows of data behind the gate. Nobody has explained it yet, and the plan was changed. " * 3
CASES = {
    "keywords": ("loan casino seo loan casino seo cheap loan casino seo " * 5, True),
    "links": ("\n".join(f"- [cheap loan](https://a{k}.example/x?id={k})" for k in range(20)), True),
    "html": ("\n".join(f'<li><a href="http://a{k}.test/y">seo fast</a></li>' for k in range(20)), True),
    "tags": (" ".join(f"#loan{k}" for k in range(30)), True),
    "products": ("\n".join(f"Loan toner red L No.{k}123 {k}.99" for k in range(20)), True),
    "sentences": (SENTENCES, False),
    "little": (SENTENCES + "\nloan seo loan seo loan seo", False),
    "table": ("| a | b |\n|---|---|\n" + "\n".join(f"| x{k % 3} | {k} rows |" for k in range(30)), False),
    "code": ("```sh\n" + "run copy --limit 5 notes.md\n" * 20 + "```", False),
    "log": ("\n".join(f"08:0{k % 10}:16 tool> never copy a and b together" for k in range(30)), False),
    "described links": ("\n".join(f"- [Notes](https://a{k}.example): What the reader keeps is checked by the team." for k in range(20)), False),
    "glossary": ("\n".join(f"term{k}: the thing that holds a record of kind {k}" for k in range(20)), False),
    "blob": ("aGrF+G3NLevsWhcaSu87/qasX6mwNxncfxYByvODj", False),
    "different keywords": ("loan casino seo cheap toner villa essay crack hotel proxy gpu keto slots serial voucher replica towing hosting", True),
    "keywords at random": ("\n".join(" ".join(random.Random(k).sample("loan casino seo toner villa essay crack hotel proxy gpu keto slots serial voucher replica towing hosting domain vpn".split(), 8)) for k in range(9)), True),
    "dashed keywords": ("loan - casino - loan - seo - loan - loan - casino - seo - casino - loan - seo", True),
    "one keyword a line": ("\n".join("loan seo villa loan".split() * 6), True),
    "one name a line": ("\n".join(f"{a}{b}" for a in ("ber", "tar", "lun", "mos") for b in ("ford", "ton", "wick", "by")), False),
    "sentences with a stop": ("Holdout loan cheap holdout loan holdout. Free holdout loan holdout seo loan! Holdout holdout loan, loan holdout, best holdout. " * 3, True),
    "empty": ("", False),
    "heading": ("# Loan Seo", False),
    "kana": ("記録が空の場合、待ちます。担当者が署名するまで待ってください。" * 10, False),
}


PROSE = [
    "The team keeps two rows of data behind the gate, and nobody has explained it yet. It is the plan of the day that was changed on the way to the desk.",
    "When it is time for the run to start, she reads the list and asks what was left out. The list is kept in a box on the shelf for all of us.",
    "What the reader keeps is checked by the team before it is sent to the shop. That is how we do it, and it has been so for a year or more.",
]


def test_kinds_of_pages(spark):
    prose = spark.createDataFrame([(t,) for t in PROSE], "text string")
    ties = clause_ties(prose)
    assert {"the", "it", "of"} <= ties and "loan" not in ties
    rows = [(k, text, 1) for k, (text, _) in enumerate(CASES.values())]
    rows += [rows[0], (None, "x", 1), (99, None, 1), (98, "word " * 50_000, 1)]
    out = {r.doc_id: r.stuffed for r in stuffed_pages(spark.createDataFrame(rows, "doc_id bigint, text string, words int"), ties).collect()}
    assert {name: out[k] for k, name in enumerate(CASES)} == {name: flag for name, (_, flag) in CASES.items()}
    assert out[98] and 99 not in out and None not in out
    assert stuffed_pages(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_ties_are_counted_by_language(spark):
    rows = [("en", "The cat is on the mat today.")] * 1500 + [("sv-SE", "Katten är på mattan i dag.")] * 1500 + [("SV", "x " * 9), (None, None)]
    found = clause_ties(spark.createDataFrame(rows, "lang string, text string"))
    assert {"the", "är"} <= found
    assert clause_ties(spark.createDataFrame([], "lang string, text string")) == frozenset()


def test_coverage_and_structure_both_decide():
    ties = frozenset("the a is of it and to".split())
    keywords, names = "loan\nseo\nvilla\nloan\nseo\nvilla", "berford\ntarton\nlunwick\nmosby\nhelden\nkarby"
    repeated = "the plan is a list of it and to the end.\n" * 5
    assert measure(keywords, ties)[1] == 6 and measure(names, ties)[1] == 0  # the same structure, other coverage
    assert measure(repeated, ties)[1] == 0  # the same coverage, other structure


def test_counts():
    words, stuffed, links, coverage, _ = measure("# Title\n\nloan seo loan seo\n\nhttps://a.example/b", frozenset())
    assert (words, stuffed, links) == (6, 4, 1) and 0 < coverage < 1


def test_the_automaton_reads_pages_of_sentences_too():
    ties = frozenset("the a is of it and to in was by has".split())
    words, stuffed, _, coverage, _ = measure("The plan of the day is in a box, and it has to be read.\n" + "loan seo villa loan seo villa", ties)
    assert (words, stuffed) == (21, 6)
    # covered: the (twice) in the sentence, both runs of three keywords
    assert coverage == (3 + 3 + 2 * len("loanseovilla")) / sum(len(w) for w in "The plan of the day is in a box and it has to be read. loan seo villa loan seo villa".split())
    assert measure("All of it was read once by her.", ties)[3] == 0 < measure("It is the plan of the day.\nIt is the plan of the day.", ties)[3]


def test_pages_with_few_keywords_give_their_measures(spark):
    rows = [(1, SENTENCES), (2, SENTENCES + "\nloan seo loan seo loan seo")]
    out = {r.doc_id: r for r in stuffed_pages(spark.createDataFrame(rows, "doc_id bigint, text string"), frozenset("the of it and was has two nobody".split())).collect()}
    assert out[1].coverage == 1.0 and not out[1].stuffed
    assert out[2].coverage == 1.0 and out[2].stuffed_words == out[1].stuffed_words + 6 and not out[2].stuffed


def test_lines_of_prose_are_read_without_a_search_for_links_and_tags(monkeypatch):
    text = "She reads the list, and/or asks: what was left out? It is kept - as ever - in a box.\nNo. 5 of the row: it was read."
    wanted = read_page(text)
    for name in ("_LINK", "_TAG", "_LISTED"):
        monkeypatch.setattr(stuffing, name, None)  # any use of it fails
    assert read_page(text) == wanted


def test_quick_looks_miss_nothing():
    stop = re.compile(r"(?<=[.!?…。！？])[\"'”’»)\]]*(?:\s+|(?<=[。！？]))")
    split, alnum = re.compile(r"[\s,;|•·、，；]+"), re.compile(r"[^\W_]")
    rng, parts = random.Random(3), [*" .!?…。！？\"'”)]([*_-–—/:;,|·•、，；#@＃<>aé木1\x00\u3000", "loan ", "http://x.y", "WWW.a.b", "httpſ://q", "[a](b)", "<a>b</a>", "tag:x", " - "]
    for _ in range(5_000):
        line = "".join(rng.choices(parts, k=rng.randint(0, 60)))
        assert stuffing._clauses(line) == stop.split(line)
        assert stuffing._words(line) == [w for w in split.split(line) if w.isalnum() or w[:1] == "\x00" or alnum.search(w)]
        assert stuffing._may_link(line) or not stuffing._LINK.search(line)
        assert not stuffing._TAG.search(line) or any(c in line for c in "#@＃＠") or stuffing._KEYED.search(line)


def test_sentence_words_in_and_out_of_ascii():
    found = list(stuffing.sentence_words("The Cat's 2 dogs ran to_us. Der Bär läuft heute über Straßen! one two three four.\n| a b c d e f. |"))
    assert found == [{"the", "cat", "s", "dogs", "ran", "to", "us"}, {"der", "bär", "läuft", "heute", "über", "straßen"}]
