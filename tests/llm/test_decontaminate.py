import hashlib
import random

from plain import words_of

from paceway.llm import decontaminate


def brute(docs, items):
    out = {}
    wins = {}
    for item, t in items:
        w = words_of(t)
        for s in range(max(1, len(w) - 12)) if w else ():
            wins.setdefault(tuple(w[s : s + 13]), set()).add(item)
    lens = {len(w) for w in wins}
    for doc, t in docs:
        w = words_of(t)
        hit, found = set(), set()
        for n in lens:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s : s + n])) in wins:
                    hit |= set(range(s, s + n))
                    found |= wins[k]
        names = ",".join(sorted(map(str, found)))
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def tables():
    rng = random.Random(8)
    word = lambda: rng.choice(["the", "of", "and", "Ärger", "x9", *(f"w{i}" for i in range(60))])
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randrange(5, 60))) for i in range(30)] + [(100, None), (101, "!!"), (102, "the of"), (103, text(13)), (104, "the the the")]
    items += [(105, items[3][1]), (106, items[3][1])]
    docs = [(0, None), (1, ""), (2, "..."), (3, "The OF and"), (4, "the the the the"), (5, items[3][1].upper()), (6, " ".join(["the"] * 3000))]
    for i in range(80):
        t = text(rng.randrange(1, 200))
        if i % 2:
            w = rng.choice(items[:30])[1].split(" ")
            a = rng.randrange(len(w))
            t = " ".join([t, *w[a : a + rng.randrange(5, 40)], text(rng.randrange(0, 400))])
        docs.append((10 + i, t))
    return docs, items


def test_equals_brute_force(spark):
    docs, items = tables()
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, row int, word string").repartition(5)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, win int")
    want = brute(docs, items)
    for block in (decontaminate.BLOCK, 40):  # one block, and many
        got = decontaminate.judge(d, b, block=block).collect()
        assert len(got) == len(docs)
        for r in got:
            assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == want[r["id"]], r["id"]
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, v in want.items() if not v[4])


def test_repeated_rows_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None)], "doc_id long, text string")
    b = spark.createDataFrame([(7, "b c"), (7, "b c"), (None, "c")], "item_id long, text string")
    got = decontaminate.judge(d, b).collect()
    assert sorted((r["n_words"], r["n_hit"], r["contaminated"]) for r in got) == [(0, 0, False), (3, 2, True), (3, 2, True), (3, 2, True)]
    assert decontaminate.clean(d, b).count() == 1
    assert decontaminate.judge(d.where("false"), b).count() == 0
    assert [r["contaminated"] for r in decontaminate.judge(d, b.where("false")).collect()] == [False] * 4


def test_windows_of_one_word_in_many_blocks_and_long_texts(spark):
    """All windows begin with their rarest word, the same one; one window is shared by many items; a text of 40,000 words; ids that repeat over different texts, and ids of null."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(40)}"
    tail = lambda n: " ".join(word() for _ in range(n))
    items = [(i, f"rare {tail(12)}") for i in range(200)] + [(1000 + i, "rare shared passage") for i in range(300)]
    texts = [f"{tail(rng.randrange(50))} {rng.choice(items)[1]} {tail(rng.randrange(300))}" for _ in range(40)]
    texts += [f"{tail(20_000)} {items[7][1]} {tail(20_000)}", "rare shared passage rare shared passage", tail(30)]
    rows = [(i // 3 if i % 5 else None, t) for i, t in enumerate(texts)] * 2
    want = brute(list(enumerate(t for _, t in rows)), items)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.judge(d, b, block=16).collect()
    show = lambda v: sorted(map(repr, v))
    assert show((r["id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got) == show((rows[i][0], *v) for i, v in want.items())
