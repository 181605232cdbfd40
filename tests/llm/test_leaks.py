import random

import numpy as np

from loomspark.llm.leaks import Index, Words, leaked_items, longest_chain, shingles


def test_chain_spans_single_changes():
    words = Words()
    item = [f"w{k}" for k in range(60)]
    text = item[10:40]
    text[12] = "other"
    index = Index([(1, " ".join(item))])
    values = shingles(words.of(" ".join(text)))
    assert longest_chain(*index.matched(values, 0)) == (30, 29)


def test_search_leaves_few_pairs_to_the_check():
    rng = random.Random(2)
    items = [(k, "in the first hour of the long night shift " + " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 3000)) for _ in range(60))) for k in range(200)]
    index, words = Index(items), Words()
    values = [shingles(words.of("once in the first hour of the long night shift " + " ".join(f"x{rng.randint(0, 9000)}" for _ in range(100)))) for _ in range(50)]
    values.append(shingles(words.of(" ".join(items[7][1].split()[30:55]))))
    pairs = index.candidates(np.concatenate(values), np.array([len(v) for v in values]))
    assert 50 * 200 + 7 in pairs.tolist() and len(pairs) <= 5  # the shared phrase makes no candidates


def test_leaks_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"word{k}" for k in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, text(rng.randint(40, 120))) for k in range(30)]
    documents, truth = [], set()
    for doc in range(60):
        words = text(rng.randint(5, 1500))
        if doc % 3 == 0:
            k, item = items[doc % len(items)]
            share = rng.choice([0.15, 0.5, 1.0])
            start = rng.randint(0, len(item) - int(len(item) * share))
            passage = [w.upper() for w in item[start : start + int(len(item) * share)]]
            passage[len(passage) // 2] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = passage
            if share > 0.15:
                truth.add((doc, k))
        documents.append((doc, ", ".join(words), None))
    documents += [(documents[0][0], documents[0][1], None), (100, None, None), (101, "", None), (None, "x y z", None), (102, "two words", None)]
    table = spark.createDataFrame(documents, "doc_id bigint, text string, item_id int")
    stated = spark.createDataFrame([(k, " ".join(w)) for k, w in items] * 2 + [(None, "a b c"), (99, None), (98, "")], "item_id bigint, instruction string")
    assert {(r.doc_id, r.item_id) for r in leaked_items(table, stated).collect()} == truth
    assert leaked_items(table.limit(0), stated).count() == 0
    assert leaked_items(table, stated.limit(0)).count() == 0
