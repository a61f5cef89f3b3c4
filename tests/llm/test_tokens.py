import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paceway.llm import tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def texts():
    rng = random.Random(11)
    bits = ["the", "The", " ", "  ", "\n", "\t ", "\r\n", "'s", "'re", "'r", "'", "''ll", "I'll", "123", "4", "é", "ß", "über", "漢字", "😀", "é", " ", " ", "\x1c", "\x85",
            "<|endoftext|>", "<|endo", "ftext|>", "...", "=====", "_a", "½", "٣", "ing", "tion", "internationalization", "aaaaaaa", "﻿", "\x00"]
    out = [None, "", " ", "   ", "\n\n", "'", "<|endoftext|>", " <|endoftext|> <|endoftext|>", "a" * 3000, "é" * 500, " " * 700, "ab " * 900]
    for _ in range(250):
        out.append("".join(rng.choice([rng.choice(bits), " ", "".join(rng.choice("abcdefghijklmnop e") for _ in range(rng.randrange(1, 12)))]) for _ in range(rng.randrange(1, 60))))
    out += ["".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(60)) for _ in range(60)]
    return out


@pytest.mark.parametrize("chunk", [3, 17, 1 << 16])
def test_counts_are_the_librarys(spark, library, chunk):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, 1, "m") for i, t in rows], "doc_id long, text string, row int, maps string").repartition(3)
    got = {r["id"]: r for r in tokens.count(docs, FILE, chunk=chunk).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 512), (i, t)


def test_small_cache_and_repeated_rows(spark, library):
    docs = spark.createDataFrame([(1, "some words, some more"), (1, "some words, some more"), (None, None), (2, "x" * 70_000 + " y")], "doc_id long, text string")
    got = sorted((r["n_bytes"], r["n_tokens"]) for r in tokens.count(docs, FILE, chunk=5, cached=40).collect())
    n = len(library.encode("some words, some more").ids)
    assert got == [(0, 0), (21, n), (21, n), (70_002, len(library.encode("x" * 70_000 + " y").ids))]
    assert tokens.count(docs.where("false"), FILE).count() == 0


def test_chunks_without_spaces_have_maps(spark, library):
    """Chinese with stops, base64, links and lines: no chunk returns its raw text whole, and counts stay the library's."""
    rng = random.Random(5)
    chinese = "".join(rng.choice("天地玄黃宇宙洪荒日月盈昃") if rng.random() < 0.9 else rng.choice("，。、") for _ in range(4000))
    base64 = "".join(rng.choice("ABCDEFGHabcdefgh01234567+/") for _ in range(4000))
    links = "".join(f"https://a{rng.randrange(99)}.example/x'll't/{rng.randrange(9999)}?q=<|endoftext|>\n" for _ in range(80))
    mixed = "".join(rng.choice(["'s", "'re", "a", "B7", "½", "é", "e\u0301", "\n", "\t", "<|endoftext|>", "<|endo", "t|>", "...", "٣", "Ⅷ"]) for _ in range(3000))
    texts = [chinese, base64, links, mixed]
    chunk_map, _, close = tokens._machine()(FILE, 500_000)
    for t in texts:
        assert all(chunk_map(t[i : i + 500])[1] is not None for i in range(0, len(t) - 500, 500))
    close()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for chunk in (7, 64, 500):
        got = {r["id"]: r["n_tokens"] for r in tokens.count(docs, FILE, chunk=chunk).collect()}
        assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
