import math
import random
import subprocess
import sys
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from paceway.llm import langid

WORDS = {"en": "the of and with that this is was", "fr": "le la les des avec été où être", "de": "der die das und für über nicht schön", "es": "el los las con niño está según"}
SCHEMA = "doc_id long, text string, lang string, source string, n int, logs string"


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def table(spark, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(160):
        lang = rng.choice(list(WORDS))
        host = {"fr": "a.site.fr", "de": "b.site.com"}.get(lang, "c.other.com") if rng.random() < 0.8 else rng.choice(["www.example.mx", "d.site.com", None, ""])
        said = lang if rng.random() < 0.8 else rng.choice(["en", "xx", None, "DE-at"])
        rows.append((i, sentence(rng, lang, rng.randrange(1, 30)), said, host, 1, "x"))
    rows += [(900, None, "en", "a.site.fr", 1, ""), (901, "", None, None, 1, ""), (902, "123 ... 456", "fr", None, 1, ""), (903, "Привет мир как дела сегодня вечером", None, None, 1, ""), (904, "le", "en", "a.site.fr", 1, "")]
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, lang, 40), lang) for i, lang in enumerate(list(WORDS) * 30)]
    return langid.train(spark.createDataFrame([*rows, (999, None, "en"), (998, "x", None)], "doc_id long, text string, lang string"))


def log_likelihood(model, text):
    data = b" " + (text or "").encode() + b" "
    low = [b + 32 if 65 <= b <= 90 else 32 if b < 33 else b for b in data]
    letter = [b >= 128 or 97 <= b <= 122 for b in low]
    out, n = np.zeros(len(model[1])), 0
    for i in range(len(low) - 2):
        if any(letter[i : i + 3]):
            cell = ((low[i] * 65536 + low[i + 1] * 256 + low[i + 2]) * 2654435761 % 2**32) >> 16
            out += model[1][:, cell].astype(float)
            n += 1
    return n, out


def brute(model, rows, weight=0.25, unknown=0.01, smoothing=20.0, trust=0.8):
    names = [*model[0], "und"]
    k, langs = len(names), model[0]
    soft = lambda x: (lambda e: e / e.sum())(np.exp(np.array(x) - max(x)))
    prior = np.log([(1 - unknown) / len(langs)] * len(langs) + [unknown])
    seen = []
    for i, text, said, host, *_ in rows:
        n, logs = log_likelihood(model, text)
        said = (said or "").strip().split("-")[0].lower()
        seen.append([i, n, weight * logs, soft(weight * logs + prior), said if said in langs else None, (host or "").lower() or None])
    sums, pairs, total = defaultdict(lambda: np.zeros(k)), defaultdict(lambda: np.zeros(k)), np.zeros(k)
    levels = lambda h: (("s", h.split(".")[-1]), ("d", ".".join(h.split(".")[-2:])), ("h", h))
    for _, n, _, p, said, host in seen:
        if n:
            total += p
            pairs[said] += p
            for level in levels(host) if host else ():
                sums[level] += p
    mass = sum(pairs[d] for d in langs)
    out = {}
    for i, n, logs, p, said, host in seen:
        own = p if n else np.zeros(k)
        share = (np.maximum(total - own, 0) + 1) / (total.sum() - own.sum() + k)
        for level in levels(host) if host else ():
            others = np.maximum(sums[level] - own, 0) if level in sums else np.zeros(k)
            share = (others + smoothing * share) / (others.sum() + smoothing)
        score = logs + np.log(share)
        for j, name in enumerate(names):
            if said:
                first = 1 / len(langs) if name == "und" else trust if name == said else (1 - trust) / (len(langs) - 1)
                score[j] += math.log((pairs[said][j] + smoothing * first) / (mass[j] + smoothing))
            main = langid.SUFFIX_LANGUAGE.get(host.split(".")[-1]) if host and levels(host)[2] in sums else None
            if main in langs:
                score[j] += math.log(len(langs) * (1 / len(langs) if name == "und" else trust if name == main else (1 - trust) / (len(langs) - 1)))
        q = soft(score)
        out[i] = ("und", 1.0) if not n else (names[int(q.argmax())], q.max())
    return out


def test_fusion_equals_brute_force(spark, model):
    rows = table(spark)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r["id"]: r for r in langid.identify(docs, model, "doc_id", F.col("text"), F.col("lang"), F.col("source")).collect()}
    want = brute(model, rows)
    assert got.keys() == want.keys()
    for i, (lang, sure) in want.items():
        assert got[i]["lang"] == lang and got[i]["confidence"] == pytest.approx(sure, abs=1e-6), i
        assert got[i]["rejected"] == (lang == "und" or sure < 0.5)
    assert [got[i]["lang"] for i in (900, 901, 902, 903)] == ["und"] * 4


def test_held_out_texts(spark, model):
    rng = random.Random(77)
    rows = [(i, sentence(rng, lang, 8), lang) for i, lang in enumerate(list(WORDS) * 40)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model, "doc_id", F.col("text")).collect()
    assert sum(r["lang"] == rows[r["id"]][2] for r in got) / len(rows) > 0.97


def test_keep_repeated_rows_and_empty(spark, model):
    rows = [(1, "the of and that", "en", "s", 1, ""), (1, "the of and that", "en", "s", 1, ""), (None, "le la les avec", None, None, 1, ""), (None, None, None, None, 1, ""), (2, "...", "en", "s", 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = langid.keep(docs, model)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "None"]
    assert langid.keep(docs.where("false"), model).count() == 0
    empty = langid.train(docs.where("false"))
    assert empty[0] == [] and langid.keep(docs, empty).count() == 0


def test_rare_language_has_a_model(spark):
    """A language of three rows beside thousands: the sample is far below its share, and it must be learned and found all the same."""
    rng = random.Random(5)
    rows = [(i, sentence(rng, "en", 12), "en") for i in range(3000)] + [(5000 + i, sentence(rng, "fr", 12), "fr") for i in range(3)] + [(6000, "12 34", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    small = langid.train(docs, sample=20)
    assert small[0] == ["en", "fr"]
    rare = docs.where("lang = 'fr'")
    got = langid.identify(rare, small, "doc_id", F.col("text"), F.col("lang")).collect()
    assert [(r["lang"], r["declared"], r["rejected"]) for r in got] == [("fr", "fr", False)] * 3


@pytest.mark.parametrize("sample", [20, 4000])
def test_copies_do_not_tilt_the_model(spark, sample):
    """Copies of a text, in the table by the thousand, leave the model as it is without them."""
    rng = random.Random(8)
    rows = [(sentence(rng, lang, 12), lang) for lang in ["en", "fr"] * 60]
    once = langid.train(spark.createDataFrame(rows, "text string, lang string"), sample=sample)
    many = langid.train(spark.createDataFrame(rows + rows[:3] * 1500, "text string, lang string"), sample=sample)
    assert once[0] == many[0] and np.array_equal(once[1], many[1])


def test_many_languages(spark):
    """Two hundred languages, each with words of its own: the plan grows in proportion and every language is found."""
    rng = random.Random(12)
    words = {f"l{i:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(6)] for i in range(200)}
    rows = [(i, " ".join(rng.choices(words[lang], k=12)), lang, f"h{i % 7}.x{i % 3}.de") for i, lang in enumerate(list(words) * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = langid.train(docs)
    assert model[0] == sorted(words)
    began = time.monotonic()
    got = langid.identify(docs, model, "doc_id", F.col("text"), F.col("lang"), F.col("source")).collect()
    assert time.monotonic() - began < 60
    assert all(r["lang"] == rows[r["id"]][2] and not r["rejected"] for r in got) and len(got) == len(rows)


def test_long_text(spark, model):
    rows = [(1, "le la les avec été " * 150_000, None, None), (2, "the of and", "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["id"]: r["lang"] for r in langid.identify(docs, model, "doc_id", F.col("text"), F.col("lang"), F.col("source")).collect()}
    assert got == {1: "fr", 2: "en"}


def test_helpers_reach_workers_without_the_package(tmp_path):
    fuse = langid._fuser(["en", "und"], np.zeros(2), np.zeros((2, 2)), {}, 1.0)
    for helper in (*langid._grams(), fuse):
        (tmp_path / "f").write_bytes(cloudpickle.dumps(helper))
        load = "import sys, pickle; pickle.load(open('f', 'rb')); assert 'paceway' not in sys.modules"
        subprocess.run([sys.executable, "-c", load], cwd=tmp_path, check=True, env={"PATH": ""})


def test_page_evidence(spark):
    html = '<!doctype html><HTML class="a" lang="fr-CA"><script>var x="<p>";</script><style>p{}</style><p>Bonjour &amp; <b>salut</b><!-- non --></p>'
    r = spark.createDataFrame([(html, "https://me@WWW.Example.fr:80/x")], "h string, u string").select(
        langid.page_language(F.col("h")).alias("l"), F.trim(F.regexp_replace(langid.page_text(F.col("h")), r"\s+", " ")).alias("t"), langid.url_host(F.col("u")).alias("o")
    )
    assert tuple(r.first()) == ("fr-CA", "Bonjour salut", "WWW.Example.fr")
