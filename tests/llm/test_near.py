import random
from collections import Counter

import numpy as np
import pytest
from plain import words_of

from paceway.llm import near
from paceway.llm.graph import components


def bag_of(text):
    w = words_of(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def brute_classes(texts, threshold=0.8):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = [bag_of(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if similarity(bags[i], bags[j]) >= threshold:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=5):
    rng = random.Random(seed)
    fresh = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    texts = [None, "", "!!!", "one two", "One, two!", "é ß ñ", "same same same same same same same"]
    texts += ["same " * 40, "same " * 44, "same " * 80]
    hot = fresh(120)
    texts += [edited(rng, hot, rng.randrange(1, 4)) for _ in range(40)]
    for _ in range(15):
        base = fresh(rng.randrange(8, 200))
        texts += [base, base, base.upper(), edited(rng, base, 1), edited(rng, base, 2), base + " " + fresh(5)]
        texts += [edited(rng, base, len(base.split()) // 6)]
    return texts


def test_classes_are_those_of_all_links(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, row int, keys string").repartition(4)
    got = {r["id"]: r for r in near.find(docs).collect()}
    want = brute_classes(texts)
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    sizes = Counter(want)
    assert all(got[i]["group_size"] == sizes[want[i]] and got[i]["kept"] == (want[i] == i) for i in got)
    kept = near.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def test_exact_rest_finds_chains(spark):
    """Without rounds of hubs, and with them, the classes are the same."""
    rng = random.Random(9)
    text, chain = " ".join(f"c{i}" for i in range(100)), []
    for _ in range(12):
        chain.append(text)
        text = edited(rng, text, 1)
    docs = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    want = brute_classes(chain)
    for rounds in (0, 1):
        got = {r["id"]: r["class_id"] for r in near.find(docs, rounds=rounds).collect()}
        assert [got[i] for i in range(len(chain))] == want


def test_hot_group_and_shared_passage(spark):
    """Copies of one text with few and with many edits, and texts that only share a passage."""
    rng = random.Random(21)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    hot, passage = fresh(150), fresh(60)
    texts = [edited(rng, hot, rng.randrange(0, 9)) for _ in range(120)]
    texts += [passage + " " + fresh(rng.randrange(5, 60)) for _ in range(120)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_classes(texts)
    for rounds in (0, 1, 2):
        got = {r["id"]: r["class_id"] for r in near.find(docs, rounds=rounds).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_rest_is_the_same_in_blocks(spark, monkeypatch):
    """A bucket dealt over many blocks has the links of one that is a single block."""
    monkeypatch.setattr(near, "REST_BLOCK", 5)
    rng = random.Random(22)
    hot = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150))
    texts = [edited(rng, hot, rng.randrange(0, 9)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_classes(texts)
    for rounds in (0, 1):
        got = {r["id"]: r["class_id"] for r in near.find(docs, rounds=rounds).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_repeated_rows_and_nulls(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "A b c d e f"), (None, None), (None, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near.find(docs).collect()
    assert len(got) == 6 and sum(r["kept"] for r in got) == 4
    assert near.keep(docs).count() == 4
    assert near.find(docs.where("false")).count() == 0


def test_very_long_text(spark):
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(10**5)}" for _ in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, edited(rng, text, 2000)), (3, "short text")], "doc_id long, text string")
    assert {r["id"]: r["class_id"] for r in near.find(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_signatures_estimate_weighted_similarity():
    _, _, signatures, band_keys, _, _ = near._kernel()
    rng = np.random.default_rng(3)
    elems = rng.integers(1, 2**63, 60).astype(np.uint64)
    wa, wb = rng.integers(0, 12, 60), rng.integers(0, 12, 60)
    doc = np.concatenate([np.zeros((wa > 0).sum(), int), np.ones((wb > 0).sum(), int)])
    m = 8192
    got = signatures(doc, np.concatenate([elems[wa > 0], elems[wb > 0]]), np.concatenate([wa[wa > 0], wb[wb > 0]]), 2, m)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert np.isfinite(got).all()
    assert abs((got[0] == got[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / m)
    assert band_keys(got, 32).shape == (2, 32)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 2000 + i) for i in range(60)]
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: r for n, r in root.items() if n != r}
