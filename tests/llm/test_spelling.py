import random
import re
import zlib
from collections import Counter

import pytest

from paceway.llm import spelling

LOW = {i: i + 32 for i in range(65, 91)}


def brute_words(rows, least_length=5, least_count=3, typo_every=97):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if typo_every and h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def one_edit(v, w):
    if len(v) > len(w):
        v, w = w, v
    if len(v) == len(w):
        return sum(x != y for x, y in zip(v, w, strict=True)) == 1
    return len(w) - len(v) == 1 and any(w[:i] + w[i + 1 :] == v for i in range(len(w)))


def brute(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if one_edit(v, w)]
        form = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = [form if form and words[form] >= 2 * n else None, n, len(near)]
    for w, r in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        r.append(root)
    return out


def check(rows, docs, **how):
    want = brute(brute_words(rows, **{k: v for k, v in how.items() if k in ("least_length", "least_count", "typo_every")}))
    got = spelling.variants(docs, **how).collect()
    assert len(got) == len(want) and {r["word"] for r in got} == set(want)
    for r in got:
        form, n, n_near, root = want[r["word"]]
        assert (r["form"], r["n"], r["n_near"], r["root"], r["form_n"]) == (form, n, n_near, root, want[form][1] if form else None), r
    return want


def test_equals_brute_force(spark):
    """Words of a tiny alphabet: runs of one letter, chains of forms, words that differ at either end, letters outside ASCII."""
    rng = random.Random(5)
    rows = []
    for i in range(250):
        words = ["".join(rng.choice("aabéÉ") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
        words += [w for k, w in enumerate(["colour", "colours", "color", "colors", "Colr", "colo"]) for _ in range(rng.randrange(1 << k))]
        rows.append((i, " ".join(words) + "¿qué中xİ\U0001f600\n×÷aaaa-µaaaaa"))
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n int, key string").repartition(5)
    want = check(rows, docs, typo_every=7)
    assert any(r[2] > 5 for r in want.values()) and any(r[3] != r[0] and r[0] for r in want.values())
    check(rows, docs, typo_every=7, span=3, crowded=20, least_length=1)  # every group is halved down to one position


def test_window_widths_do_not_matter(spark):
    rng = random.Random(6)
    words = list({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))) for _ in range(900)})
    vocabulary = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    want = sorted((min(v, w), max(v, w)) for v in words for w in words if v < w and one_edit(v, w))
    for span, crowded in ((1, 5000), (4, 5000), (9, 20)):
        got = spelling.near_pairs(vocabulary, span, crowded).collect()
        assert sorted((min(r["word"], r["near"]), max(r["word"], r["near"])) for r in got) == want, (span, crowded)


def test_edges(spark):
    long = "word" * 100_000
    text = " ".join(["colour"] * 4000 + [long, "color"] * 3 + [long + "s"] * 3)
    rows = [(None, "abcde abcde"), (None, "abcde"), (7, None), (7, ""), (7, "a b c"), (9, text), (9, text), (2**62, "abcdx " * 9)]
    docs = spark.createDataFrame([(t, i, 0) for i, t in rows], "text string, doc_id long, word int")
    want = check(rows, docs, typo_every=97)
    assert want["color"][0] == "colour" and want[long][2] == 1
    assert spelling.variants(docs.where("false")).count() == 0


@pytest.mark.parametrize("piece", [1, 10, 1000])
def test_pieces_and_flushes_do_not_matter(piece):
    import pyarrow as pa

    rows = [(str(i), f"Alpha beta{i % 3}gamma ÉTÉ \u0080 été alpha " * 9) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["id", "text"])
    got = Counter()
    for out in spelling._counter(5, 1, flush_words=4, flush_bytes=50, piece=piece)([batch]):
        for w, n in zip(*out.to_pydict().values(), strict=True):
            got[w] += n
    assert dict(got) == brute_words(rows, 1, 1, 5) | ({"": got[""]} if "" in got else {})
