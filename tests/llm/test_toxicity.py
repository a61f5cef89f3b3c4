import math
import random
import re

import pytest
from pyspark.sql import functions as F

from paceway.llm import toxicity

BAD = ["idiot", "wretch", "oafish"]


def corpus(n=1500, seed=3):
    rng = random.Random(seed)
    plain = lambda k: " ".join("w" + "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(k))
    docs, labels, places = [], [], {}
    for i in range(n):
        parts = [plain(rng.randrange(3, 15)) for _ in range(rng.randrange(1, 40))]
        toxic = rng.random() < 0.15
        if toxic:
            k = rng.randrange(len(parts))
            stem = rng.choice(BAD)
            words = parts[k].split()
            words.insert(rng.randrange(len(words)), stem + rng.choice(["", "", "s", "ly", "ness", "est"]))
            parts[k] = " ".join(words)
            places[i] = sum(len(p) + 2 for p in parts[:k])
        docs.append((i, ". ".join(parts), 5))
        labels.append((i, int(toxic)))
    return docs, labels, places


def test_held_out_accuracy_and_location(spark):
    docs, labels, places = corpus()
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, score int"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(toxicity.labelled(d, lab, F.col("_id") % 4 != 2))
    got = {r["id"]: r for r in toxicity.score(d, model).collect()}
    truth = dict(labels)
    held = [i for i in truth if i % 4 == 2]
    caught = [got[i]["score"] >= 0.3 for i in held if truth[i]]
    false = [got[i]["score"] >= 0.3 for i in held if not truth[i]]
    assert sum(caught) / len(caught) > 0.97 and sum(false) / len(false) < 0.02
    found = [any(s["start"] <= places[i] + 1 < s["end"] for s in got[i]["sentences"]) for i in held if truth[i]]
    assert sum(found) / len(found) > 0.95


def plain_features(text):
    return {f for w in re.findall(r"[^\W\d_]+", text.lower()) for f in (w, w[:4] + "*" * (len(w) >= 4), w[:5] + "*" * (len(w) >= 5)) if f == w or f.endswith("*")}


def plain_model(rows, steps, least=3, rate=0.1, ridge=1e-4):
    """Training document by document and sentence by sentence, with the gradient of each loss as the chain rule gives it."""
    base, counts = sum(y for _, y in rows) / len(rows), {}
    for text, y in rows:
        for f in plain_features(text):
            toxic, n = counts.get(f, (0, 0))
            counts[f] = toxic + y, n + 1
    chosen = sorted(f for f, (t, n) in counts.items() if t >= least and (t - n * base) / math.sqrt(n * base * (1 - base)) > 3)
    names = [*chosen, "bias", "leak"]
    w = dict.fromkeys(chosen, 0.0) | dict.fromkeys(("bias", "leak"), math.log(0.001 / 0.999))
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    parts = [([f for f in (plain_features(x) & set(chosen) for x in re.split(r"[.!?\n]+", t)) if f], y) for t, y in rows]
    first, second = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0)
    for step in range(1, steps + 1):
        grad = dict.fromkeys(names, 0.0)
        for found, y in parts:
            chances = [sigmoid(w["bias"] + sum(w[f] for f in sorted(x))) for x in found]
            none = math.prod(1 - p for p in [*chances, sigmoid(w["leak"])])
            outer = -none / (1 - none) if y else 1.0  # of the loss by minus the log of the chance of no toxic sentence
            for x, p in zip(found, chances):
                for f in [*x, "bias"]:
                    grad[f] += outer * p / len(rows)
            grad["leak"] += outer * sigmoid(w["leak"]) / len(rows)
        for f in names:
            g = grad[f] + (ridge * w[f] if f in counts else 0)
            first[f], second[f] = 0.9 * first[f] + 0.1 * g, 0.99 * second[f] + 0.01 * g * g
            w[f] -= rate * first[f] / (1 - 0.9**step) / (math.sqrt(second[f] / (1 - 0.99**step)) + 1e-9)
    return w.pop("leak"), w.pop("bias"), w


def test_model_and_scores_equal_plain_loops(spark):
    docs, labels, _ = corpus(150, seed=11)
    docs += [(900, "Idiot! idiot idiots. Wretch\nwretched", 0), (901, None, 0), (902, "İDIOT oafish... oafish", 0), (903, "idiot " * 3000, 0)]
    labels += [(900, 1), (902, 1)]
    d = spark.createDataFrame([(a, b, c, 1, "x") for a, b, c in docs], "doc_id long, text string, score int, sentences int, id string").repartition(5)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(toxicity.labelled(d, lab, F.lit(True)), steps=40)
    leak, bias, weights = plain_model([(dict((a, b) for a, b, _ in docs)[i] or "", y) for i, y in labels], 40)
    assert len(weights) > 5 and model[2] == pytest.approx(weights, abs=1e-6) and model[:2] == pytest.approx((leak, bias), abs=1e-6)
    for r in toxicity.score(d, model).collect():
        text = dict((a, b) for a, b, _ in docs)[r["id"]] or ""
        none, bad, at = 1 / (1 + math.exp(leak)), [], 0
        for part in re.split(r"([.!?\n]+)", text):
            shown = [f for f in plain_features(part) if f in weights]
            if shown:
                p = 1 / (1 + math.exp(-bias - sum(weights[f] for f in shown)))
                none *= 1 - p
                bad += [(at, at + len(part))] * (p >= 0.3)
            at += len(part)
        assert r["score"] == pytest.approx(1 - none, abs=1e-5), r["id"]
        assert [(s["start"], s["end"]) for s in r["sentences"]] == bad, r["id"]


def test_no_feature_is_left_out(spark):
    """Every one of many equally strong features is learnt, whatever their number."""
    words = [f"bad{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    rows = [(" ".join(words), 1)] * 5 + [("quiet words", 0)] * 60
    _, _, weights = toxicity.train(spark.createDataFrame(rows, "text string, toxic int"), steps=3)
    assert set(words) <= set(weights)


def test_length_alone_is_no_evidence(spark):
    docs, labels, _ = corpus(600)
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, score int"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(toxicity.labelled(d, lab, F.lit(True)))
    long = spark.createDataFrame([(1, "quiet words here. " * 20_000, 1)], "doc_id long, text string, score int")
    assert toxicity.score(long, model).first()["score"] < 0.3


def test_nulls_repeated_rows_and_empty(spark):
    docs = spark.createDataFrame([(1, "idiot"), (1, "idiot"), (None, None), (2, ""), (3, "!!")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.train(toxicity.labelled(docs, labels, F.lit(True)))
    got = toxicity.score(docs, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 0.01 for r in got)  # labels of one kind only
    assert toxicity.score(docs.where("false"), model).count() == 0
    bounded = toxicity.labelled(docs, spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic")), F.lit(True), sample=10)
    assert bounded.count() <= 4
