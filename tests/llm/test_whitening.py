import math
import random

import numpy as np
import pytest

from paceway.llm import whitening


def brute(vectors, components=16):
    """Plain version: exact sums in Python's numbers, then the same eigenproblem."""
    rows = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    fit = sorted({tuple(r) for r in rows})
    n, dim = len(fit), len(rows[0])
    s = [sum(r[i] for r in fit) for i in range(dim)]
    v = np.array([[(n * sum(r[i] * r[j] for r in fit) - s[i] * s[j]) / (n * n) for j in range(dim)] for i in range(dim)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    white = np.array([[float(n * c - t) / n for c, t in zip(r, s, strict=True)] for r in rows]) @ vectors / np.sqrt(np.maximum(values, 1e-300))
    return n, [sum((n * c - t) ** 2 for c, t in zip(r, s, strict=True)) for r in rows], white, values / np.trace(v)


def as_rows(got):
    out = {}
    for r in got:
        out.setdefault(r["id"], []).append(r)
    return {k: sorted(v, key=lambda r: r["component"]) for k, v in out.items()}


@pytest.mark.parametrize("spread", [1.0, 3000.0])
def test_equals_brute_force(spark, spread):
    rng = random.Random(8)
    vectors = [[rng.gauss(0, spread * (1 + j)) + (5 if j % 2 else 0) for j in range(20)] for _ in range(300)]
    vectors += [vectors[3]] * 200 + [vectors[5]]  # a large group of copies counts once
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, n int, x double").repartition(7)
    got = as_rows(whitening.whiten(df).collect())
    n, deviation, white, explained = brute(vectors)
    assert len(got) == len(vectors) and all([r["component"] for r in v] == list(range(1, 17)) for v in got.values())
    w = np.array([[r["whitened"] for r in got[i]] for i in range(len(vectors))])
    sign = np.sign((w * white).sum(0))
    assert np.allclose(w * sign, white, rtol=1e-9, atol=1e-9)
    for i, rows in got.items():
        assert {(r["n"], r["deviation"]) for r in rows} == {(n, deviation[i] if deviation[i] < 2**63 else None)}
        assert np.allclose([r["explained"] for r in rows], explained, rtol=1e-9)
    errors = {r["identity_error"] for rows in got.values() for r in rows}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-9


def test_scatter_is_exact_for_any_block_and_large_numbers(spark):
    rng = random.Random(9)
    rows = [[rng.randrange(-(2**40), 2**40), rng.randrange(3), 7, rng.randrange(2**20)] for _ in range(150)]
    low, high = [min(c) for c in zip(*rows, strict=True)], [max(c) for c in zip(*rows, strict=True)]
    shifted = [[c - b for c, b in zip(r, low, strict=True)] for r in rows]
    want = {(i, j): sum(r[i] * r[j] for r in shifted) for i in range(4) for j in range(i, 4)}
    fit = spark.createDataFrame([(r,) for r in rows], "x array<long>").repartition(3)
    for block in (1, 64, 4096):
        sums, products = whitening.scatter(fit, low, high, block)
        assert sums == [sum(c) for c in zip(*shifted, strict=True)]
        assert {k: v for k, v in products.items() if v} == {k: v for k, v in want.items() if v}


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.25, -1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, []), (8, [-0.5, 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    got = as_rows(whitening.whiten(df, "id").collect())
    assert {k: len(v) for k, v in got.items()} == {1: 4, None: 2, 8: 2}
    n, deviation, _, _ = brute([[0.5, 1.0], [0.25, -1.0], [-0.5, 0.0]])
    assert n == 3 and got[8][0]["n"] == 3 and got[8][0]["deviation"] == deviation[2]
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 4.0])], "vec_id long, embedding array<double>")).collect()
    assert [r["whitened"] is None for r in sorted(flat, key=lambda r: (r["id"], r["component"]))] == [False, True, True] * 2
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 2, "vec_id long, embedding array<double>")).collect()
    assert len(same) == 4 and {(r["whitened"], r["deviation"], r["identity_error"], r["explained"]) for r in same} == {(None, 0, 0.0, 0.0)}
    far = whitening.whiten(spark.createDataFrame([(1, [1e14, 0.0]), (2, [-1e14, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in far} == {None}
    assert abs(abs(next(r for r in far if r["component"] == 1)["whitened"]) - 1) < 1e-9
    for empty in (df.where("false"), df.where("id = 7"), df.where("id = 2")):
        assert whitening.whiten(empty, "id").count() == 0
