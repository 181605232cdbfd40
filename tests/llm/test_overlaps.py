from loomspark.llm.overlaps import cross_split_overlaps, identity, overlap_report, same_saying, words


def test_words_and_identity():
    assert words("It's  ABC‑7, оkay?\n") == ["it", "abc", "7", "okay"]
    assert identity(words("abc-7 holds 12345, abc 7's")) == ["12345", "abc7"]
    assert words(" … ") == []


def test_slips_and_other_names():
    a = words("Never touch the weir desk without opening abc-7 first")
    assert same_saying(a, words("never tuoch um the weir desk, desk without opeening abc 7 first"))
    assert same_saying(a, words("without opening abc-7 first never touch a weir desk"))
    assert not same_saying(a, words("Never touch the quarry desk without opening abc-7 first"))
    assert not same_saying(a, words("The weir desk is opened with abc-7"))


def test_pairs_against_brute_force(spark):
    rows = [
        ("a", "train", "Park abc-7 on the left", "s1"),
        ("a", "train", "Park abc-7 on the left", "s1"),
        ("b", " Val ", "park ABC-7 on a left!", "S2"),
        ("c", "TEST", "Park abc-8 on the left", "s2"),
        ("d", "training", "", None),
        ("e", "test", None, None),
        ("f", None, "Park abc-7 on the left", "s1"),
        ("g", "test", "Park abc-7 on the left", None),
        ("h", "train", "...", None),
        (None, "test", "Park abc-7 on the left", None),
        ("i", "test", "word " * 20000, None),
        ("j", "train", "word " * 20001, None),
        ("k", "test", "hello", None),
        ("l", "train", "hello", None),
    ]
    utterances = spark.createDataFrame(rows, "id string, split string, said string, source string").selectExpr("*", "1 as class_id")
    pairs = cross_split_overlaps(utterances)
    assert {(r.id_eval, r.id_train) for r in pairs.collect()} == {("b", "a"), ("g", "a"), ("i", "j"), ("k", "l")}
    assert sum(r.pairs for r in overlap_report(pairs).collect()) == 4
    assert cross_split_overlaps(utterances.limit(0)).count() == 0
