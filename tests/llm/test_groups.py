import random

import numpy as np

from loomspark.llm.groups import anneal, components, energy, grouped_splits, hashed


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_of_stars_paths_and_hubs(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 60)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(-5, -9), (7000, 7000)]
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    for per_task in (10_000, 60):  # one task, and the star steps
        assert {r.node: r.component for r in components(table, per_task).collect()} == union_find(edges)


def test_annealing_beats_the_hash():
    rng = np.random.default_rng(1)
    weights, labels = rng.integers(1, 30, 200).astype(float), rng.integers(0, 9, (200, 4)).astype(float)
    want = np.array([0.8, 0.1, 0.1]) * weights.sum()
    start = hashed(np.arange(200), (0.8, 0.1, 0.1), 0)
    _, best = anneal(weights, labels, start, want, 0)
    sizes = np.bincount(start, weights=weights, minlength=3)
    by_label = np.stack([np.bincount(start, weights=labels[:, j], minlength=3) for j in range(4)], axis=1)
    assert best < 0.2 * energy(sizes, by_label, want, np.outer(want / want.sum(), labels.sum(axis=0)))


def test_groups_nulls_and_repeats(spark):
    rows = [
        ("a", " Key-1", "train", "S1", None, "fact", "x"),
        ("a", " Key-1", "train", "S1", None, "fact", "x"),
        ("b", "key_1 ", "dev", None, None, None, "x"),
        ("c", "other", None, "s1", "q", "rule", "x"),
        ("d", "other2", "test", None, "Q", "rule", "x"),
        ("e", None, "train", None, None, "none", "x"),
        ("f", "", "test", " ", None, "none", "x"),
        ("g", "alone", "val", "z", None, "fact", "x"),
        ("h", "alone", None, "y", None, "fact", "x"),
        (None, "alone", "train", None, None, None, "x"),
        ("i", "twice", "train", None, None, None, "x"),
        ("i", "again", "train", None, None, None, "x"),
        ("j", "again", "dev", None, None, None, "x"),
    ]
    table = spark.createDataFrame(rows, "id string, key string, split string, speaker string, session string, kind string, component string")
    out = grouped_splits(table, edges_per_task=5).collect()
    assert {r.key for r in out if r.parted and r.key} == {"key-1", "other", "other2", "twice", "again"}
    by = {}
    for r in out:
        by.setdefault(r.component, set()).add(r.new_split)
    assert all(len(s) == 1 for s in by.values()) and {r.id for r in out} == set("abcdefghij")
    assert grouped_splits(table.limit(0)).count() == 0
