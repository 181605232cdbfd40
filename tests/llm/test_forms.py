from loomspark.llm.forms import compose, consistent, odd_tokens, quotes_seen_by_readers, repaired, vocabulary


def test_compose_keeps_what_readers_tell_apart():
    assert compose("Ａ​b­c d‑e") == "Abc d-e"
    assert compose("e\u0301") == "\u00e9" and compose("ﬁle") == "file"
    for kept in ("10²", "1½", "①", "™", "résumé", "–", "…"):
        assert compose(kept) == kept


def test_repair_needs_vocabulary_and_one_script():
    key = [(t, w) for *_, t, w in odd_tokens("the rеader оf а бук")]
    assert key == [("rеader", "l"), ("оf", "l")]
    assert odd_tokens("тест слово") == []
    assert repaired("the rеader", {"rеader l": "reader"}) == "the reader"
    assert repaired("the rеader", {}) == "the rеader"


def test_quotes_against_brute_force(spark):
    documents = spark.createDataFrame(
        [
            (1, "d", "The reader weighs 10² rows of the caf\u00e9 log.", "x"),
            (2, "d", "Тhe rеader weіghs 10² rows.", "x"),
            (3, "e", None, "x"),
            (4, "f", "Нет данных в журнале.", "x"),
            (5, None, "The reader", "x"),
        ],
        "doc_id bigint, document string, text string, quote string",
    )
    objects = spark.createDataFrame(
        [
            ("a", "d", "The rеader weіghs", 1),
            ("a", "d", "The rеader weіghs", 1),
            ("b", "d", "the reader weighs", 1),
            ("c", "d", "102 rows", 1),
            ("d", "d", "of the cafe\u0301", 1),
            ("e", "e", "x", 1),
            ("f", "f", "Нeт данных", 1),
            ("g", "d", None, 1),
            ("h", "d", " ​", 1),
            ("i", "zzz", "The reader", 1),
            ("j", None, "The reader", 1),
            ("k", "d", "The reader weighs", 1),
        ],
        "id string, document string, quote string, doc_id int",
    )
    found = {(r.id, r.doc_id) for r in quotes_seen_by_readers(objects, documents).collect()}
    assert found == {("a", 1), ("a", 2), ("d", 1), ("f", 4), ("k", 2)}
    assert quotes_seen_by_readers(objects.limit(0), documents).count() == 0


def test_consistent_keeps_rows(spark):
    rows = spark.createDataFrame([(1, "rеad"), (1, "rеad"), (2, None), (3, ""), (4, "x" * 100_000)], "k int, t string")
    vocab = vocabulary(spark.createDataFrame([("Read me",)], "t string"))
    out = sorted((r.k, r.t_form or "") for r in consistent(rows, ["t"], vocab).collect())
    assert out == [(1, "read"), (1, "read"), (2, ""), (3, ""), (4, "x" * 100_000)]
