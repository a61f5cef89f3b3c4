import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceway.llm import neighbours


def brute(rows, top, asked):
    """Plain version over rows ``(id, vector)`` with usable vectors of one row per id."""
    out = {}
    for i, v in rows:
        if asked(i):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != i)  # noqa: B905
            out[i] = [(j, -s) for s, j in scores[:top]]
    return out


def answers(got):
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    return out


def gauss(rng, n, dim, length=1.0):
    out = []
    for _ in range(n):
        v = [rng.gauss(0, 1) for _ in range(dim)]
        norm = math.sqrt(sum(c * c for c in v)) / length
        out.append([c / norm for c in v])
    return out


def test_recall_and_scores(spark):
    """Unstructured vectors, the hardest case: at least 0.9 of the true neighbours, and scores of what is found are exact and in order."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    x = np.array([v for _, v in rows])
    at = {i: k for k, (i, _) in enumerate(rows)}
    got = answers(neighbours.nearest(df, F.col("id") % 20 == 0, per_cell=32).collect())
    assert set(got) == {i for i, _ in rows if i % 20 == 0}
    hit = 0
    for i, found in got.items():
        score = x @ x[at[i]]
        score[at[i]] = -9
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(s == pytest.approx(score[at[j]], abs=1e-12) for _, j, s in found)
        assert [s for _, _, s in found] == sorted((s for _, _, s in found), reverse=True)
        hit += len({j for _, j, _ in found} & {rows[k][0] for k in np.argsort(-score)[:20]})
    assert hit >= 0.9 * 20 * len(got)


@pytest.mark.parametrize("how", [{"recall": 1.0, "per_cell": 8, "block": 16}, {"recall": 0.0, "per_cell": 1, "tables": 1, "block": 50}])
def test_copies_ties_and_lengths(spark, how):
    """A third of all rows are copies of one vector; lengths differ. Full recall, or so few probes that most queries have too few and go over all rows."""
    rng = random.Random(4)
    vectors = gauss(rng, 100, 5, 2.0) + gauss(rng, 60, 5, 0.5) + gauss(rng, 1, 5) * 100 + [[0.5, 0.25], [0.5, 0.25, 0.0]] * 5
    ids = rng.sample(range(1000), len(vectors))
    rows = [(i, v + [0.0] * (5 - len(v))) for i, v in zip(ids, vectors, strict=True)]
    bad = [(5001, None), (5002, [0.0] * 5), (5003, [float("nan")] * 5), (5004, [1.0, None]), (5005, []), (5006, [float("inf")]), (None, [9.0] * 5), (5000, None)]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in [*zip(ids, vectors, strict=True), *bad, (ids[0], vectors[0])]], "vec_id long, embedding array<double>, q int, cell string, t int")
    got = answers(neighbours.nearest(df.repartition(5), F.col("id") % 3 == 0, top=7, tune=400, **how).collect())
    want = brute(rows, 7, lambda i: i % 3 == 0)
    assert set(got) == set(want)
    same = sum([j for _, j, _ in got[i]] == [j for j, _ in want[i]] for i in want)
    assert all(len(v) == 7 for v in got.values())
    if how["recall"] == 1.0:
        assert same == len(want)
        copies = [i for i in want if i in ids[160:260]]
        assert len(copies) > 10 and all([s for _, _, s in got[i]] == pytest.approx([s for _, s in want[i]], abs=1e-12) for i in copies)


def test_small_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (20, [1.0, 1.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = answers(neighbours.nearest(df, F.col("id") % 20 == 0).collect())
    assert got == {0: [(1, 20, 1.0), (2, 1, 0.0)], 20: [(1, 0, 1.0), (2, 1, 1.0)]}
    assert neighbours.nearest(df.where("vec_id = 20"), F.col("id") % 20 == 0).count() == 0
    assert neighbours.nearest(df.where("vec_id = 1"), F.col("id") % 20 == 0).count() == 0
    assert neighbours.nearest(df.where("false"), F.col("id") % 20 == 0).count() == 0


def test_probes_are_nearest_cells_in_order():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20, 16))
    cells, probes = neighbours._turner(16, 2, [16, 4], 7)
    every = probes(x, 32 * 8)
    assert every.shape == (20, 2, 256) and all(len(set(c)) == 256 for row in every.tolist() for c in row)
    assert (every[:, :, 0] == cells(x)).all()
    for m in (1, 3, 40):
        assert (probes(x, m) == every[:, :, :m]).all()
    assert neighbours.shape(500, 64, 256) == [1] and neighbours.shape(51282, 64, 256) == [64] and len(neighbours.shape(10**9, 64, 256)) > 1
