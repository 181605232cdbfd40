"""Cases by hand for what SQL does not settle: empty inputs, ties, NULL, chains, cycles."""

import math
import os

import pytest
from pyspark.sql import functions as F

from loomspark.functions import privacy, stats
from loomspark.functions import text as X
from loomspark.operators import dedup, graph, measure, sampling, splits, timeline, verdicts, views


def test_abstentions_conflicts_and_constraints(spark):
    e = spark.createDataFrame([(1, "abstain", 3, 1), (2, "pass", 2, 1), (2, "fail", 2, 1), (3, "fail", 1, 1), (3, "pass", 2, 1), (4, "pass", 255, 255)], "target int, ruling string, rank int, strength int")
    assert {r.target: r.passed for r in verdicts.resolve_verdicts(e, "target").collect()} == {2: None, 3: True, 4: True}
    assert 4 not in {r.target for r in verdicts.decide(e, "target").collect()}


def test_rewards_stay_unmeasured(spark):
    e = spark.createDataFrame([(1, "abstain", 1, 4.0, 0.0), (2, "abstain", 1, None, None), (3, "pass", 1, 0.0, 1.0)], "t int, ruling string, rank int, score double, confidence double")
    assert {r.t: r.reward for r in verdicts.attempt_rewards(e, "t").collect()} == {1: 0.0, 2: None, 3: 1.0}


def test_first_exclusion_wins_and_counts_add_up(spark):
    rows = spark.createDataFrame([(1, "a", "b", True, 3), (2, "a", None, True, 3), (3, "a", "x", None, 3), (4, "a", "x", False, 0), (5, "see the passage", "x", True, 3), (6, "a", "<think>x", True, 3)], "id int, ask string, answer string, passed boolean, strength int")
    out = views.sft_final(rows, 1)
    assert {r.id: r.exclusion for r in out.collect()} == {1: None, 2: "no_final_output", 3: "undecided", 4: "failed", 5: "not_self_contained", 6: "reasoning_in_text"}
    assert sum(r.n for r in verdicts.counted(out).collect()) + out.filter("exclusion is null").count() == 6


def test_preference_cells_are_distinct(spark):
    for passes, fails in ((1, 5), (4, 6), (3, 3), (2, 4), (5, 1)):
        rows = [(f"p{k}", "g", "q", f"good{k}", True) for k in range(passes)] + [(f"f{k}", "g", "q", f"bad{k}", False) for k in range(fails)]
        pairs, left = views.preference(spark.createDataFrame(rows, "id string, g string, ask string, answer string, passed boolean"), ["g"], "s", passes * fails)
        found = {(r.chosen_id, r.rejected_id) for r in pairs.collect()}
        assert len(found) == pairs.count() == passes * fails and left.count() == 0


def test_near_duplicate_chain(spark):
    words = [f"w{k}" for k in range(60)]
    change = lambda w, *at: " ".join("x" if k in at else v for k, v in enumerate(w))
    rows = [(1, " ".join(words)), (2, change(words, 0)), (3, change(words, 0, 59)), (4, " ".join(words)), (5, "other text"), (6, ""), (7, "")]
    out = {r.k: (r.class_id, r.links) for r in dedup.near_duplicates(spark.createDataFrame(rows, "k bigint, t string"), "k", F.col("t"), 5, 0.9).collect()}
    assert {k: v[0] for k, v in out.items()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 6}


def test_similar_pairs_against_brute_force(spark):
    import random

    rng = random.Random(2)
    sets = {k: {rng.randint(0, 14) for _ in range(rng.randint(1, 12))} for k in range(40)}
    table = spark.createDataFrame([(k, len(s), f) for k, s in sets.items() for f in s], "k bigint, n int, f bigint")
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.5}
    assert {(r.a, r.b) for r in dedup.similar_pairs(table, "k", 0.5).collect()} == want


def test_overlaps_of_instants():
    spans = [(0, 5, 5, 9, False), (0, 5, 4, 9, True), (3, 3, 0, 5, True), (5, 5, 0, 5, False), (0, 5, 0, 0, True), (2, 2, 2, 2, True)]
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    table = s.createDataFrame(spans, "a int, b int, c int, d int, want boolean")
    assert table.filter(timeline.overlaps(F.col("a"), F.col("b"), F.col("c"), F.col("d")) != F.col("want")).count() == 0
    left, right = table.selectExpr("1 as g", "a as start", "b as stop", "a * 100 + b as l").distinct(), table.selectExpr("1 as g", "c as start", "d as stop", "c * 100 + d as r").distinct()
    for width in (1, 3, 100):
        assert timeline.overlap_join(left, right, ["g"], width).count() == left.crossJoin(right.withColumnsRenamed({"start": "x", "stop": "y"})).filter(timeline.overlaps(F.col("start"), F.col("stop"), F.col("x"), F.col("y"))).count()


def test_two_hop_clock():
    known = timeline.resolve_clocks([("imu", "wall", 0, 100, 2.0, 5), ("cam", "imu", 10, 0, 1.0, 3), ("cam", "imu", 0, 0, 9.0, 50)], "wall")
    assert known["imu"] == (2.0, 100.0, 5) and known["cam"] == (2.0, 80.0, 8) and known["wall"] == (1.0, 0.0, 0)


def test_cycles_are_told(spark):
    with pytest.raises(RuntimeError):
        graph.ancestors(spark.createDataFrame([(1, 2), (2, 1)], "node int, parent int"), most=5)
    levels = {r.node: r.level for r in graph.topological_levels(spark.createDataFrame([(1,), (2,), (3,)], "node int"), spark.createDataFrame([(2, 3), (3, 2)], "node int, needs int")).collect()}
    assert levels == {1: 0, 2: None, 3: None}


def test_groups_are_never_parted(spark):
    rows = spark.range(3000).selectExpr("id", "id % 100 as g", "id % 3 as s", "id as at")
    assert all(r.violations == 0 for r in splits.verify_disjoint(splits.drawn_split(rows, "g", "x", {"a": 0.5, "b": 0.5}), "g", "id").collect())
    folds = splits.folds(rows, "g", "s", 5, "x").groupBy("stratum", "fold").agg(F.sum("size").alias("n")).collect()
    assert max(r.n for r in folds) - min(r.n for r in folds) <= 30
    t = splits.temporal_split(spark.createDataFrame([("a", 1), ("a", 9), ("b", 9), ("c", 1)], "g string, at int"), "g", "at", 5, "x", 0.0).collect()
    assert {(r.g, r.part, r.dropped) for r in t} == {("a", None, "straddles_cutoff"), ("b", "test", None), ("c", "train", None)}


def test_allocation_under_capacity():
    assert sampling.allocate(10, {"a": 1, "b": 1, "c": 1}, {"a": 1, "b": 100, "c": 100}) == {"a": 1, "b": 5, "c": 4}
    assert sampling.allocate(10, {"a": 1.0}, {"a": 3}) == {"a": 3}
    assert sampling.allocate(5, {}, {"a": 3}) == {"a": 0}


def test_exact_tails(spark):
    assert stats.binomial_tail(5, 5) == pytest.approx(1 / 32) and stats.critical_wins(4) is None and stats.critical_wins(5) == 5
    assert stats.power(20, 0.9) > 0.9 > stats.power(20, 0.6) and stats.detectable(2) is None
    rows = spark.createDataFrame([(5, 0), (0, 0), (3, 7), (60, 40)], "w int, l int")
    for r in rows.withColumn("p", stats.sign_test(F.col("w"), F.col("l"))).collect():
        assert r.p == pytest.approx(stats.binomial_tail(r.w + r.l, r.w), abs=1e-9)
    low, high = stats.wilson(F.col("w"), F.col("w") + F.col("l"))
    assert rows.filter("w + l = 0").select(low.alias("a"), high.alias("b")).first() == (None, None)


def test_bootstrap_covers_and_needs_two(spark):
    rows = [("a", k, float(k % 2), 1) for k in range(200)] + [("b", 1, 1.0, 1)]
    out = {r.g: (r.low, r.high) for r in measure.bootstrap_interval(spark.createDataFrame(rows, "g string, family bigint, total double, n int"), "g", resamples=500).collect()}
    assert 0.38 < out["a"][0] < 0.5 < out["a"][1] < 0.62 and out["b"] == (None, None)


def test_privacy_is_idempotent_and_checked():
    text = "mail a.b@c.example or +46 70 123 45 67, IBAN SE45 5000 0000 0583 9825 7466 not SE45 5000 0000 0583 9825 7467, password: hunter22x"
    once, counts = privacy.scrub_text(text, ("Ann",))
    assert counts == {"EMAIL": 1, "PHONE": 1, "IBAN": 1, "SECRET-assigned": 1} and "7467" in once
    assert privacy.scrub_text(once) == (once, {})
    assert privacy.luhn_valid("8112189876") and not privacy.luhn_valid("8112189875")


def test_text_functions(spark):
    t = spark.createDataFrame([("The Tables, the table's 12.5 rows.", "x"), ("", "y"), (None, "z")], "t string, k string")
    r = t.select(X.tokens(F.col("t")).alias("w"), X.numbers(F.col("t")).alias("n"), X.shingles(X.tokens(F.col("t")), 3).alias("s"), X.content_words(X.tokens(F.col("t"))).alias("c"), X.slug(F.col("t")).alias("g")).collect()
    assert r[0].w == ["the", "tables", "the", "table", "s", "12", "5", "rows"] and r[0].n == ["12.5"] and len(r[0].s) == 6 and r[0].c == ["table", "12", "row", "5"][:0] + [w for w in ["table", "12", "5", "row"]]
    assert r[1].s == [""] and r[2].w is None
    assert t.select(X.jaccard(F.array(), F.array()).alias("j")).first().j == 1.0


def test_survival_and_e_process(spark):
    s = spark.createDataFrame([("a", 1, 1), ("a", 2, 0), ("a", 3, 1), ("a", 3, 1)], "g string, time int, event int")
    assert [(r.time, r.at_risk, round(r.survival, 6)) for r in timeline.kaplan_meier(s, ["g"]).orderBy("time").collect()] == [(1, 4, 0.75), (2, 3, 0.75), (3, 2, 0.0)]
    b = spark.createDataFrame([("g", 1, 1.0), ("g", 2, 1.0)], "g string, i int, d double")
    last = measure.e_process(b, ["g"], ["i"]).orderBy(F.desc("i")).first().capital
    assert last == pytest.approx(sum((1 + e) ** 2 for e in (0.1, 0.25, 0.5, 0.75)) / 4) and not math.isnan(last)


def test_e_process_runs_over_all_outcomes_in_logarithms(spark):
    from loomspark.plans import registry

    won = spark.createDataFrame([("g", i, 1) for i in range(2000)], "g string, i int, d int")
    logs = [r.log_capital for r in measure.e_process_log(won, ["g"], ["i"]).orderBy("i").collect()]
    assert len(logs) == 2000 and logs[0] == pytest.approx(math.log(1.4)) and logs[-1] == pytest.approx(2000 * math.log(1.75) - math.log(4))
    folder = "/root/testdata/sf0.001"
    if os.path.isdir(folder):
        from loomspark.plans.measure_plans import arms

        assert registry.queries()["e_process_whole"](spark, folder).count() == arms(spark, folder).filter("a is not null and b is not null").count() > 20 * 7


def test_quota_against_a_plain_walk(spark):
    import random

    from loomspark.operators import relations

    rng = random.Random(6)
    rows = [(k, rng.choice("abc"), rng.choice("xy"), rng.randint(0, 9)) for k in range(300)]
    used, chosen = {}, []
    limit = {"p": -(-30 // 3), "q": 15}
    for k, p, q, o in sorted(rows, key=lambda r: (r[3], r[0])):
        if len(chosen) < 30 and used.get(("p", p), 0) < limit["p"] and used.get(("q", q), 0) < limit["q"]:
            chosen.append(k)
            used["p", p], used["q", q] = used.get(("p", p), 0) + 1, used.get(("q", q), 0) + 1
    table = spark.createDataFrame(rows, "k int, p string, q string, o int")
    assert {r.k for r in relations.quota(table, ["p", "q"], ["o"], "k", 0.1, 30).collect()} == set(chosen)


def test_first_difference_and_slices(spark):
    from loomspark.operators import relations

    t = spark.createDataFrame([(["a", "b"], ["a", "c"]), (["a"], ["a", "b"]), (["a"], ["a"]), ([], [])], "a array<string>, b array<string>")
    assert [r.x for r in t.select(relations.first_difference(F.col("a"), F.col("b")).alias("x")).collect()] == [1, 1, None, None]
    chunks = spark.createDataFrame([("s", 0, [0, 1, 2]), ("s", 3, [3, 4]), ("s", 5, [5])], "s string, first bigint, samples array<int>")
    assert relations.sample_slice(chunks, ["s"], F.lit(2), F.lit(6)).first().samples == [2, 3, 4, 5]
    keyed = relations.opaque(spark.createDataFrame([("a",), (None,)], "id string"), "id", "k").collect()
    assert len(keyed[0].id) == 64 and keyed[1].id is None


def test_contradictions(spark):
    from loomspark.operators import selection

    rows = [(1, "s", "What is the name?", "a"), (2, "s", "what is  the name?", "b"), (3, "s", "what is the name?", "A"), (4, "t", "What is the name?", "c"), (5, "s", "something else entirely", "d")]
    out = selection.contradictions(spark.createDataFrame(rows, "k int, s string, q string, a string"), F.col("s"), F.col("q"), F.col("a"), "k").collect()
    assert {(r.id_a, r.id_b) for r in out} == {(1, 2)}


def test_as_of_is_the_same_in_buckets(spark):
    import random

    rng = random.Random(8)
    left = spark.createDataFrame([(rng.choice("ab"), rng.randint(0, 99), k) for k in range(60)], "g string, t int, k int")
    right = spark.createDataFrame([("a", t, t * 10) for t in range(5, 90, 17)] + [("b", 50, None)], "g string, t int, v int")
    plain = {r.k: r.as_of_v for r in timeline.as_of(left, right, ["g"], "t", ["v"]).collect()}
    assert plain == {r.k: r.as_of_v for r in timeline.as_of(left, right, ["g"], "t", ["v"], 7).collect()} and len(plain) == 60


def test_retrieval_finds_utterances_in_any_script(spark, tmp_path):
    from loomspark.plans import registry

    said = [(1, "My desk, please"), (2, "Ein Schlüssel für desk 4"), (3, "記録 museum"), (4, "müzede tour"), (5, None)]
    spark.createDataFrame(said, "id bigint, said string").write.parquet(f"{tmp_path}/utterances.parquet")
    run = lambda name: registry.queries()[name](spark, str(tmp_path)).collect()
    assert {r.id: r.score for r in run("retrieve_terms_whole")} == {1: 1, 2: 1}
    assert {(r.query, r.id) for r in run("retrieve_bm25_whole")} == {(1, 3), (1, 4), (2, 1), (2, 2)}


def test_near_duplicates_with_one_code_block_stay_apart(spark):
    block = "```python\nprint(1)\n```"
    one, two = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(1, f"{one} {block}"), (2, f"{two} {block}"), (3, f"{two} {block} end"), (4, f"{two}  {block.upper()}")]
    out = {r.k: (r.class_id, r.links) for r in dedup.near_duplicates(spark.createDataFrame(rows, "k bigint, t string"), "k", F.col("t")).collect()}
    assert out == {1: (1, 0), 2: (2, 1), 3: (2, 1), 4: (2, 1)}


def test_joins_and_families_take_whole_tables(spark, tmp_path):
    from loomspark.plans import registry

    spark.createDataFrame([(k,) for k in range(1, 8)], "c_custkey bigint").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, 1, "F", 1.0), (2, 1, "F", 1.0), (3, 2, "O", 1.0), (4, 3, "F", 1.0), (5, 9, "P", 1.0)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    run = lambda kind: sorted(map(tuple, registry.queries()[f"rel_join_{kind}_whole"](spark, str(tmp_path)).collect()))
    both, left, right = [(1, 1, 2), (2, 2, 1), (3, 3, 1)], [(k, -1, 0) for k in range(4, 8)], [(-1, 9, 1)]
    assert [run(k) for k in ("inner", "left", "right", "full")] == [both, both + left, right + both, right + both + left]
    assert (run("left_semi"), run("left_anti")) == ([(1,), (2,), (3,)], [(4,), (5,), (6,), (7,)])
    folder = "/root/testdata/sf0.001"
    if os.path.isdir(folder):
        from loomspark.plans.verdict_plans import attempts, rewards

        wanted = {}
        given = {r.attempt: r.reward for r in rewards(spark, folder).collect()}
        for a in attempts(spark, folder).collect():
            wanted.setdefault(a.family, []).append(given[a.attempt] if a.attempt in given else {"pass": 1.0, "fail": 0.0}.get(a.outcome))
        found = {r.family: (r.attempts, r.measured) for r in registry.queries()["family_outcomes_whole"](spark, folder).collect()}
        assert found == {k: (len(v), sum(x is not None for x in v)) for k, v in wanted.items()}


def test_relations_and_stages_are_of_all_rows(spark, tmp_path):
    from loomspark.plans import registry

    for name in ("view_critic", "view_decision", "continual_matrix"):
        assert not [x for x in ("% 5 = 0", "% 2 = 0", "<= 6") if x in registry.oracle_sql()[f"{name}_whole"]]
    spark.createDataFrame([(k,) for k in (1, 2, 3)], "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 1, 1, "N", "F", 1, 0.1), (2, 1, 1, "R", "O", 1, 0.2), (2, 7, 1, "N", "O", 1, 0.5)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_returnflag string, l_linestatus string, l_suppkey bigint, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    run = lambda name: registry.queries()[name](spark, str(tmp_path)).collect()
    assert {(r.src, r.dst, r.exclusion) for r in run("view_decision_whole")} == {(1, 2, None), (2, 3, "related_missing"), (3, 4, "related_missing")}
    assert run("continual_matrix_whole")[0].acc == 0.5
    folder = "/root/testdata/sf0.001"
    if os.path.isdir(folder):
        from loomspark.plans.view_plans import experiences

        assert registry.queries()["view_critic_whole"](spark, folder).count() == experiences(spark, folder).count()


def test_many_copies_of_a_text_stay_one_family(spark):
    text = [f"w{k}" for k in range(40)]
    rows = [(k, " ".join(text)) for k in range(1, 10)] + [(10, " ".join(text[:30])), (11, "short text"), (12, "short text"), (13, "another one"), (14, None)]
    out = {r.k: r.family for r in dedup.overlap_families(spark.createDataFrame(rows, "k bigint, t string"), "k", F.col("t")).collect()}
    assert out == {k: 1 for k in range(1, 11)} | {11: 11, 12: 11, 13: 13, 14: 14}
    parts = [(k, " ".join(text + [f"x{k}y{n}" for n in range(20)])) for k in range(7)]
    assert len({r.family for r in dedup.overlap_families(spark.createDataFrame(parts, "k bigint, t string"), "k", F.col("t")).collect()}) == 7
