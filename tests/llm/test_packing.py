import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from paceway.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(3)
    bits = ["The", "the,", "of.", "A,,", "b.,", "don't", "İstanbul", "é", "ÉTÉ.", "ΣΑΣ", "x1", "12.5", "<|endoftext|>", "a<|endoftext|>b", "\n", "\t", "  ", "...", "a.b", "it*s", "<|ENDOFTEXT|>", "é!é", "x|y", "😀", "漢字,", "ŉ", "\x1c", "tion", "=" * 9]
    out = [None, "", " ", "\n", "a", "x" * 5000, "word " * 6000]
    for _ in range(120):
        out.append(" ".join(rng.choice([rng.choice(bits), "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9)))]) for _ in range(int(rng.lognormvariate(4, 1.3)) + 1)))
    return out


def test_pieces(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, start int, length string").repartition(2)
    library = Tokenizer.from_file(FILE)
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    for block in (4_000_000, 5_000):
        got = packing.pack(docs, FILE, end_id=1, block_tokens=block, cached=300).collect()
        pieces, places = defaultdict(list), defaultdict(list)
        for r in got:
            assert r["ids_crc32"] == zlib.crc32(ids[r["id"]][r["start"] : r["start"] + r["length"]].tobytes())
            assert r["doc_tokens"] == len(ids[r["id"]]) and r["length"] > 0
            pieces[r["id"]].append((r["start"], r["length"]))
            places[r["sequence_id"]].append((r["offset"], r["length"]))
        for table, full in ((pieces, {i: len(v) for i, v in ids.items()}), (places, None)):
            for k, spans in table.items():
                at = 0
                for start, n in sorted(spans):
                    assert start == at
                    at += n
                assert at == full[k] if full else at <= 2048
        assert set(pieces) == set(ids)
        total = sum(map(len, ids.values()))
        if block > 5_000:
            assert 2048 * len(places) - total < 2 * 2048  # less than one sequence of padding a partition


def test_ids_of_all_short_texts(spark):
    """Every text of three out of letters with odd lower cases, marks, signs and special strings has the library's ids."""
    signs = ["a", "Z", "İ", "i", "\u0307", "\u0301", "ẞ", "Σ", "ŉ", " ", "\n", "'", "s", "7", "中", "\u200d", "<|endoftext|>", *"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]
    rows = ["".join(t) for t in itertools.product(signs, repeat=3)]
    library = Tokenizer.from_file(FILE)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(8)
    got = {}
    for r in packing.pack(docs, FILE, end_id=1).collect():
        got.setdefault(r["id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    for i, e in enumerate(library.encode_batch(rows, add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in got[i]) and sum(n for _, n, _ in got[i]) == len(ids), repr(rows[i])


def test_long_texts_and_extra_columns(spark):
    """Texts of megabytes among short ones, columns that clash with every name in use."""
    rows = [(1, "word " * 600_000), (2, "x"), (3, "y" * 300_000), (4, "İ." * 50_000)]
    docs = spark.createDataFrame([(i, t, "k", 1, 2, 3) for i, t in rows], "doc_id long, text string, id string, sequence_id int, offset int, ids_crc32 int")
    library = Tokenizer.from_file(FILE)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    got = defaultdict(int)
    for r in packing.pack(docs, FILE, end_id=1).collect():
        assert r["doc_tokens"] == want[r["id"]]
        got[r["id"]] += r["length"]
    assert got == want


def greedy(lengths, capacity, linear, quadratic):
    """The plain loop: whole sequences first, then pieces by falling cost, each to the cheapest open sequence with room, cut at the roomiest where there is none."""
    cost = lambda n: linear * n + quadratic * n * n
    out, used, rest = [], 0, []
    for d, n in enumerate(lengths):
        for k in range(n // capacity):
            out.append((d, k * capacity, capacity, used, 0))
            used += 1
        if n % capacity:
            rest.append((d, n - n % capacity, n % capacity))
    total = sum(n for _, _, n in rest)
    load, spent = [0] * -(-total // capacity), [0.0] * -(-total // capacity)
    for d, start, n in sorted(rest, key=lambda p: -cost(p[2])):
        while n:
            fits = [s for s in range(len(load)) if capacity - load[s] >= n]
            s = min(fits, key=lambda s: (spent[s], s)) if fits else min(range(len(load)), key=lambda s: (load[s], spent[s], s))
            take = min(n, capacity - load[s])
            out.append((d, start, take, used + s, load[s]))
            load[s], spent[s], start, n = load[s] + take, spent[s] + cost(take), start + take, n - take
    return out


def test_equals_greedy_loop():
    rng = random.Random(6)
    for capacity in (7, 64, 100):
        for _ in range(40):
            lengths = [rng.randrange(0, 3 * capacity) if rng.random() < 0.2 else rng.randrange(0, capacity) for _ in range(rng.randrange(0, 120))]
            pieces, _ = packing._placer()(lengths, capacity, 1.0, 1 / 64)
            assert sorted(pieces) == sorted(greedy(lengths, capacity, 1.0, 1 / 64))


def test_balance():
    """No sequence costs much more than the mean, though lengths differ widely."""
    rng = random.Random(1)
    lengths = [int(rng.lognormvariate(5.5, 1)) + 1 for _ in range(3000)]
    pieces, n = packing._placer()(lengths, 2048, 1.0, 1 / 512)
    assert n == -(-sum(lengths) // 2048) or n == sum(x // 2048 for x in lengths) + -(-sum(x % 2048 for x in lengths) // 2048)
    cost, last = defaultdict(float), defaultdict(int)
    for _, _, length, s, offset in pieces:
        cost[s] += length + length**2 / 512
        assert last[s] == offset
        last[s] += length
    mixed = [c for s, c in cost.items() if sum(p[3] == s for p in pieces) > 1]
    assert np.std(mixed) / np.mean(mixed) < 0.35


def test_repeated_rows_nulls_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string").coalesce(1)
    got = packing.pack(docs, FILE, end_id=1).collect()
    assert sorted((r["id"] or 0, r["length"], r["offset"]) for r in got)[0][:2] == (0, 1)
    assert len(got) == 3 and len({r["sequence_id"] for r in got}) == 1
    assert packing.pack(docs.where("false"), FILE, end_id=1).count() == 0
