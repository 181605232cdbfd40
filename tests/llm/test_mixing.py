from loomspark.llm.mixing import mix, repetition_rates


def test_rates_meet_shares_or_caps():
    targets = {"a": (0.5, 1), "b": (0.5, 3), "c": (0.0, 9), "d": (0.2, 2)}
    rates = repetition_rates({"a": 1000, "b": 100, "c": 50}, targets)
    assert rates == {"a": 0.3, "b": 3.0}
    assert repetition_rates({"a": 1000, "b": 100}, targets, total=2000) == {"a": 1.0, "b": 3.0}
    assert repetition_rates({}, targets) == {}


def test_mix_reaches_its_shares(spark):
    rows = [(k, "Big_Source ", "one two three four", 1) for k in range(4000)] + [(10_000 + k, "small", "five six seven eight", 1) for k in range(400)]
    rows += [(20_000, None, "x", 1), (20_001, "small", None, 1), (None, "small", "x", 1), (20_002, "unknown", "x", 1), (20_003, "small", "", 1), (10_000, "small", "five six seven eight", 1)]
    documents = spark.createDataFrame(rows, "doc_id bigint, source string, text string, copies int")
    targets = spark.createDataFrame([("big-source", 0.75, 1), ("small", 0.25, 2), ("none", 0.0, 3), ("missing", 0.1, 2)], "source string, target_share double, max_repeats int")
    drawn, report = mix(documents, targets)
    taken = drawn.collect()
    assert max(r.copy for r in taken) <= 2 and {r.source for r in taken} == {"big-source", "small"}
    assert sum(r.source == "small" and r.doc_id < 20_000 for r in taken) == 800
    shares = {r.source: r.actual_share for r in report.collect()}
    assert abs(shares["big-source"] - 0.75) < 0.02 and shares["none"] == shares["missing"] == 0
    assert mix(documents.limit(0), targets)[0].count() == 0
