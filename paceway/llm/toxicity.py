"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence gets a logistic score from its words; a document's score combines them by noisy-or, ``1 - (1 - leak) * prod(1 - p)``. Sentences without any known feature are no evidence, so a
long text is not suspect for its length; what no sentence explains is left to the leak, one for each document. Both are trained together from document labels: the gradient of the document's loss reaches
a sentence in proportion to its own score, so the words of the offending sentences take the weight. The same scores locate those sentences.

Words count with their first letters (prefixes of four and five), so that an unseen form of a known stem is recognised. The vocabulary is what the labelled rows show to go with the label: grouped counts of documents by feature, kept if a
feature lifts the rate of the label beyond chance; all of those are kept, their number is bounded by the sample. The model is fitted on a bounded sample of labelled rows, ``sample`` in the mean, chosen by a hash of the id; the sample of labels is small
enough to be broadcast. Every text is scored whole, in one pass without a shuffle.

Edge cases: null, empty and wordless texts get the leak as score; missing labels are left out, of conflicting ones toxic wins; repeated rows are scored
one by one; without labels of both kinds every score is ``prior``; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _reader():
    """Functions on text, made here so that they travel to the workers by value."""
    import re

    word = re.compile(r"[^\W\d_]+")
    stop = re.compile(r"[.!?\n]+")

    def features(w):
        """What a lower-cased word shows."""
        return [w, *(f"{w[:n]}*" for n in (4, 5) if len(w) >= n)]

    def sentences(text):
        """``(start, end)`` of the stretches between stops."""
        at, out = 0, []
        for m in stop.finditer(text):
            if m.start() > at:
                out.append((at, m.start()))
            at = m.end()
        if at < len(text):
            out.append((at, len(text)))
        return out or [(0, len(text))]

    return word, features, sentences


def labelled(docs: DataFrame, labels: DataFrame, usable: Column, id_col="doc_id", text_col="text", label_col="toxic", sample=20_000) -> DataFrame:
    """``text, toxic`` of the bounded sample of labelled rows; ``usable`` says which ids may be learnt from."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("toxic")).where(F.col("_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.where(usable).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if total > sample:
        known = known.where(F.shiftrightunsigned(F.xxhash64("_id"), 32) < math.ceil(sample / total * 2**32))
    if known.count() <= 2 * sample:
        known = F.broadcast(known)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return texts.join(known, "_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def train(rows: DataFrame, least_docs: int = 3, steps: int = 400, rate: float = 0.1, ridge: float = 1e-4, prior: float = 0.001) -> tuple[float, float, dict[str, float]]:
    """``(leak, bias, weights by feature)``, the first two as logits, from ``text, toxic``."""
    import numpy as np

    tools = _reader()

    def tally(batches):
        import pyarrow as pa

        word, seen, _ = tools
        counts = {}

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts)), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())], names=["feature", "toxic", "n"]
            )

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in {f for w in set(word.findall(text.lower())) for f in seen(w)}:
                    c = counts.setdefault(f, [0, 0])
                    c[0] += toxic
                    c[1] += 1
                if len(counts) > 200_000:
                    yield flush()
                    counts.clear()
        if counts:
            yield flush()

    n, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    bias = math.log(prior / (1 - prior))
    if not 0 < n_toxic < n:
        return bias, bias, {}
    base = n_toxic / n
    sums = rows.mapInArrow(tally, "feature string, toxic long, n long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    strength = (F.col("toxic") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base))
    chosen = sums.where((F.col("toxic") >= least_docs) & (strength > 3)).select("feature").collect()  # at most the features of the sample
    place = {f: i for i, f in enumerate(sorted(r["feature"] for r in chosen))}

    def instances(batches):
        import pyarrow as pa

        word, seen, sentences = tools
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                full = []
                for a, b in sentences(text):
                    hits = {place[f] for w in word.findall(text[a:b].lower()) for f in seen(w) if f in place}
                    if hits:
                        full.append(sorted(hits))
                found.append(full)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.list_(pa.int32())))], names=["toxic", "found"])

    toxic, owner, sentence, feature = [], [], [], []
    for r in rows.mapInArrow(instances, "toxic int, found array<array<int>>").collect():  # at most the sample, features only
        for hits in r["found"]:
            sentence += [len(owner)] * len(hits)
            feature += hits
            owner.append(len(toxic))
        toxic.append(r["toxic"])
    y, owner, sentence, feature = np.array(toxic, float), np.array(owner, int), np.array(sentence, int), np.array(feature, int)

    # The weights of the features, then the bias of a sentence and the leak.
    weights, first, second = np.zeros(len(place) + 2), 0.0, 0.0
    weights[-2:] = bias
    for step in range(1, steps + 1):
        z = np.bincount(sentence, weights[feature], minlength=len(owner)) + weights[-2]
        evidence = np.bincount(owner, np.logaddexp(0, z), minlength=len(y)) + np.logaddexp(0, weights[-1])  # -log of the chance of no toxic sentence
        missed = np.exp(-evidence)
        slope = (1 - y) - y * missed / np.maximum(1 - missed, 1e-12)
        each = slope[owner] / (1 + np.exp(-z))
        grad = np.concatenate([np.bincount(feature, each[sentence], minlength=len(place)), [each.sum(), slope.sum() / (1 + np.exp(-weights[-1]))]]) / len(y)
        grad[:-2] += ridge * weights[:-2]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return float(weights[-1]), float(weights[-2]), {f: float(weights[i]) for f, i in place.items()}


def score(docs: DataFrame, model, id_col="doc_id", text_col="text", least: float = 0.3) -> DataFrame:
    """One row per input row: ``id, score, sentences``, the last an array of ``(start, end, score)`` of the sentences at ``least`` or more."""
    leak, bias, weights = model
    tools = _reader()

    def run(batches):
        import math

        import pyarrow as pa

        word, seen, sentences = tools
        known = {}

        def weight(w):
            out = known.get(w)
            if out is None:
                if len(known) > 500_000:
                    known.clear()
                out = known[w] = sorted((f, weights[f]) for f in set(seen(w)) if f in weights)
            return out

        for batch in batches:
            scores, found = [], []
            for text in batch.column(1).to_pylist():
                low = text.lower()
                evidence, bad = math.log1p(math.exp(leak)), []
                if len(low) != len(text) or any(map(weight, set(word.findall(low)))):
                    for a, b in sentences(text):
                        shown = dict(x for w in word.findall(text[a:b].lower()) for x in weight(w))
                        if not shown:
                            continue
                        z = bias + sum(shown.values())
                        evidence += z if z > 30 else math.log1p(math.exp(z))
                        p = 1 / (1 + math.exp(-max(z, -700)))
                        if p >= least:
                            bad.append((a, b, p))
                scores.append(-math.expm1(-evidence))
                found.append([{"start": a, "end": b, "score": p} for a, b, p in bad])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, kind)], names=["id", "score", "sentences"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
    fields = [T.StructField("id", rows.schema["id"].dataType), T.StructField("score", T.DoubleType()), T.StructField("sentences", T.ArrayType(span))]
    return rows.mapInArrow(run, T.StructType(fields))
