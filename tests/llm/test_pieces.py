import random

from loomspark.llm.pieces import boundaries, greedy_cuts, split_oversized, successors


def walk(text, limit, overlap):
    """The same cuts one after the other."""
    at, level = boundaries(text, limit, overlap)
    import numpy as np

    n = len(at)
    jump = successors(at, level, np.zeros(n, int), np.full(n, n - 1), limit, overlap)
    k, out = 0, [0]
    while k != n - 1:
        k = jump[k]
        out.append(int(at[k]))
    return out


def test_doubling_equals_walking():
    rng = random.Random(7)
    words = ["alpha", "be", "gamma.", "delta\n", "eps\n\n", "記録。", "x" * 400, "é" * 60]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 300))) for _ in range(40)] + ["", "a", "z" * 5000]
    for text, cuts in zip(texts, greedy_cuts(texts, 300, 30)):
        assert cuts == walk(text, 300, 30)
        begins = [0] + [c - 30 for c in cuts[1:-1]]
        assert all(0 < e - b <= 300 for b, e in zip(begins, cuts[1:])) or not text
        assert cuts[-1] == len(text)


def test_natural_boundaries_come_first():
    text = ("One sentence here. " * 20).strip() + "\n\n" + "Another one there. " * 40
    cuts = greedy_cuts([text], 500, 50)[0]
    assert text[: cuts[1]].endswith("\n\n")
    assert all(text[c - 1] == " " and text[c - 2] == "." for c in cuts[2:-1])


def test_nulls_repeats_clashing_columns_and_empty(spark):
    documents = spark.createDataFrame(
        [(1, "é" * 1600, "x"), (2, None, "x"), (3, "", "x"), (4, "w " * 900, None)], "doc_id bigint, text string, section string"
    )
    ranges = "doc_id bigint, section int, range struct<start bigint, stop bigint>, text string"
    candidates = spark.createDataFrame(
        [(1, 0, (0, 3200), "t"), (1, 0, (0, 3200), "t"), (1, 1, (0, 3000), "t"), (1, 2, (2000, 9999), "t"), (2, 0, (0, 5), None), (3, 0, (0, 0), "t"), (4, 0, (0, 1800), "t"), (4, 1, None, "t"), (None, 1, (0, 9), "t")],
        ranges,
    )
    rows = split_oversized(documents, candidates).collect()
    assert {(r.doc_id, r.section) for r in rows} == {(1, 0), (4, 0)}
    by = sorted((r.doc_id, r.piece, r.piece_start, r.piece_stop) for r in rows)
    assert by == [(1, 0, 0, 1500), (1, 1, 1350, 1600), (4, 0, 0, 1500), (4, 1, 1350, 1800)]
    assert split_oversized(documents.limit(0), candidates).count() == 0


def test_a_document_of_many_ranges_is_spread(spark, monkeypatch):
    from pyspark.sql import functions as F

    from loomspark.llm import pieces

    monkeypatch.setattr(pieces, "RANGES", 3, raising=False)
    documents = spark.createDataFrame([(1, "word " * 900), (2, "other " * 900)], "doc_id bigint, text string")
    wanted = {(1, k, k, 3000 + k) for k in range(60)} | {(2, 0, 0, 2000)}
    candidates = spark.createDataFrame([(d, k, (a, b)) for d, k, a, b in wanted] * 2, "doc_id bigint, section int, range struct<start bigint, stop bigint>")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = pieces.sections(documents, candidates, 1500).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted((r.doc_id, r.section, r.start, r.stop) for r in rows) == sorted(wanted)
    assert all(r.text == {1: "word ", 2: "other "}[r.doc_id].__mul__(900)[r.start : r.stop] for r in rows)
    assert len({r.task for r in rows if r.doc_id == 1}) > 1
