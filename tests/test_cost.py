import heapq
import math
import random
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from paceway.meta import LATLNG, LayerMeta
from paceway.operators import cost


def dijkstra(pace, starts, w, h, cap):
    best, queue = {}, [(0.0, s) for s in starts if pace.get(s) is not None]
    while queue:
        c, cell = heapq.heappop(queue)
        if cell in best:
            continue
        best[cell] = c
        for dx in (-1, 0, 1):
            for dy in (-1, 0, 1):
                nxt = (cell[0] + dx, cell[1] + dy)
                if nxt not in best and pace.get(nxt) is not None:
                    step = c + (pace[cell] + pace[nxt]) / 2 * math.hypot(dx * w, dy * h)
                    if step <= cap:
                        heapq.heappush(queue, (step, nxt))
    return best


@pytest.mark.parametrize("cap", [15.0, 1e9])
def test_equals_dijkstra(spark, cells, as_dict, cap):
    """A maze over several tiles: walls, a spiral way round, sources on walls and outside."""
    rng = random.Random(3)
    n = 22
    meta = LayerMeta(LATLNG, 0.0, 0.0, float(n), n * 2.0, 1.0, 2.0, 6)
    pace = {(x, y): rng.choice([1.0, 2.5, 7.0]) for x in range(n) for y in range(n)}
    for i in range(n - 2):
        pace[(6, i)] = pace[(12, i + 2)] = pace[(i, 15)] = None
    starts = [(0, 0), (21, 21), (6, 3), (40, 40), (0, 0)]
    points = spark.createDataFrame(starts, "gx int, gy int")
    got = as_dict(cost.cost_distance(cells(pace), points, meta, cap, meta.tile_size))
    want = dijkstra(pace, starts, 1.0, 2.0, cap)
    assert got.keys() == want.keys()
    assert all(got[c] == pytest.approx(want[c], abs=1e-9) for c in want)
    assert got[(0, 0)] == 0.0


def test_tile_size_does_not_matter(spark, cells, as_dict):
    pace = {(x, y): 1.0 + (x * y) % 5 for x in range(20) for y in range(20)}
    points = spark.createDataFrame([(3, 3)], "gx int, gy int")
    base = LayerMeta(LATLNG, 0.0, 0.0, 20.0, 20.0, 1.0, 1.0, 32)
    one = as_dict(cost.cost_distance(cells(pace), points, base, 60.0))  # one tile
    two = as_dict(cost.cost_distance(cells(pace), points, base.with_(tile_size=5), 60.0, 5))
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) for k in one)
    less = as_dict(cost.cost_distance(cells(pace), points, base, 20.0, 7))
    assert all(v == pytest.approx(one[k]) for k, v in less.items()) and len(less) < len(one)


def test_negative_friction_is_nodata(spark, cells, as_dict):
    pace = {(x, y): -1.0 if x == 3 else 1.0 for x in range(6) for y in range(6)}
    meta = LayerMeta(LATLNG, 0.0, 0.0, 6.0, 6.0, 1.0, 1.0, 4)
    got = as_dict(cost.cost_distance(cells(pace), spark.createDataFrame([(0, 0)], "gx int, gy int"), meta, 1e9, meta.tile_size))
    assert got.keys() == {c for c in pace if c[0] < 3}


def test_no_source_on_the_layer(spark, cells):
    layer = cells({(0, 0): 1.0, (1, 0): 1.0})
    meta = LayerMeta(LATLNG, 0.0, 0.0, 4.0, 4.0, 1.0, 1.0, 4)
    points = spark.createDataFrame([(3, 3)], "gx int, gy int")
    assert cost.cost_distance(layer, points, meta, 9.0).count() == 0


@pytest.mark.parametrize("bits", [0, 2, 8])
def test_block_size_does_not_matter(spark, cells, as_dict, monkeypatch, tmp_path, bits):
    """With a block for each tile or one for all, the costs are the same; the folders of the run are gone afterwards."""
    pace = {(x, y): 1.0 + (x + y) % 3 for x in range(16) for y in range(16)}
    meta = LayerMeta(LATLNG, 0.0, 0.0, 16.0, 16.0, 1.0, 1.0, 4)
    points = spark.createDataFrame([(1, 1), (14, 14)], "gx int, gy int")
    want = dijkstra(pace, [(1, 1), (14, 14)], 1.0, 1.0, 1e9)
    monkeypatch.setattr(cost, "BLOCK_BITS", bits)
    used = []
    monkeypatch.setattr(cost, "fresh_dir", lambda s, name: used.append(str(tmp_path / name)) or used[-1])
    got = as_dict(cost.cost_distance(cells(pace), points, meta, 1e9, meta.tile_size))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert len(used) == 2 and not list(tmp_path.iterdir())


def test_many_rounds(spark, cells, as_dict):
    """A corridor that winds through many tiles takes a round for each, and ends at the exact costs."""
    pace = {(x, y): 1.0 for x in range(24) for y in range(8) if not (x % 4 == 2 and y != (7 if x % 8 == 2 else 0))}
    meta = LayerMeta(LATLNG, 0.0, 0.0, 24.0, 8.0, 1.0, 1.0, 4)
    got = as_dict(cost.cost_distance(cells(pace), spark.createDataFrame([(0, 0)], "gx int, gy int"), meta, 1e9, meta.tile_size))
    want = dijkstra(pace, [(0, 0)], 1.0, 1.0, 1e9)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_helpers_reach_workers_without_the_package(tmp_path):
    meta = LayerMeta(LATLNG, 0.0, 0.0, 4.0, 4.0, 1.0, 1.0, 4)
    for helper in (cost._solver(meta, 9.0, True), cost._dense(6)):
        (tmp_path / "f").write_bytes(cloudpickle.dumps(helper))
        load = "import sys, pickle; pickle.load(open('f', 'rb')); assert 'paceway' not in sys.modules"
        subprocess.run([sys.executable, "-c", load], cwd=tmp_path, check=True, env={"PATH": ""})
