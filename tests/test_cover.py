import random

import pytest
from pyspark.sql import functions as F

from paceway.meta import LATLNG, LayerMeta
from paceway.operators import raster

EDGES = "feature_id long, seq int, x0 double, y0 double, x1 double, y1 double, value double"
LAYERS = {
    "tall": LayerMeta(LATLNG, 0.0, 0.0, 7.0, 90.0, 1.0, 0.5, 8),
    "wide": LayerMeta(LATLNG, 0.0, 0.0, 90.0, 7.0, 0.5, 1.0, 8),
    "square": LayerMeta(LATLNG, 0.0, 0.0, 30.0, 30.0, 1.0, 1.0, 8),
}


def _corner(rnd, meta):
    """A point on the layer or around it, often on the lines and centres of cells."""
    x = meta.xmin + (meta.xmax - meta.xmin) * rnd.uniform(-0.6, 1.6)
    y = meta.ymin + (meta.ymax - meta.ymin) * rnd.uniform(-0.6, 1.6)
    if rnd.random() < 0.5:
        x, y = round(2 * x / meta.cell_w) * meta.cell_w / 2, round(2 * y / meta.cell_h) * meta.cell_h / 2
    return x, y


def _chain(fid, points, value):
    return [(fid, i, *a, *b, float(value)) for i, (a, b) in enumerate(zip(points, points[1:], strict=False))]


def _cells(df):
    return {(r["value"], r["gx"], r["gy"]) for r in df.select("value", "gx", "gy").collect()}


@pytest.mark.parametrize("name", LAYERS)
@pytest.mark.parametrize("steps", (4, 256))
def test_covered_cells_of_lines_equal_their_steps(spark, monkeypatch, name, steps):
    meta, rnd = LAYERS[name], random.Random(steps)
    rows = [e for i in range(150) for e in _chain(i, [_corner(rnd, meta) for _ in range(4)], i % 40)]
    edges = spark.createDataFrame(rows, EDGES)
    want = _cells(raster.rasterize_lines(edges, meta, ("value",)))
    monkeypatch.setattr(raster, "STEPS", steps)
    assert want and _cells(raster.line_cover(edges, meta, ("value",))) == want


@pytest.mark.parametrize("name", LAYERS)
def test_covered_cells_of_polygons_equal_their_rows(spark, name):
    """Rings that cross themselves, lie on one another or off the layer, have edges down a column or all but so; also features that are no ring."""
    meta, rnd = LAYERS[name], random.Random(7)
    rows = []
    for i in range(120):
        points = [_corner(rnd, meta) for _ in range(rnd.choice((3, 4, 6)))]
        if i % 5 == 0:
            points.append((points[-1][0] + rnd.choice((0.0, 1e-13, 1e-9)), _corner(rnd, meta)[1]))
        ring = _chain(i, [*points, points[0]], i)
        if i % 10 == 1:
            ring = ring[:-1]  # open
        if i % 10 == 2:
            ring[-1] = (*ring[-1][:-1], i + 0.5)  # two values
        rows += ring * (2 if i % 10 == 3 else 1)  # twice
    edges = spark.createDataFrame(rows, EDGES)
    want = _cells(raster.rasterize_polygons(edges, meta, ("value",)))
    assert want and _cells(raster.polygon_cover(edges, meta, ("value",))) == want


def test_long_edges_and_tall_rings_make_few_rows(spark):
    """The rows that are dealt follow the columns passed, not the length: roads of a hundred thousand cells on one another."""
    meta = LayerMeta(LATLNG, 0.0, 0.0, 8.0, 100_000.0, 1.0, 1.0, 256)
    ways = spark.range(2000).select(
        F.col("id").alias("feature_id"), F.lit(0).alias("seq"), F.lit(0.2).alias("x0"), (F.col("id") + 0.5).alias("y0"),
        F.lit(6.7).alias("x1"), (99_999.5 - F.col("id")).alias("y1"), (F.col("id") % 3).cast("double").alias("value"),
    )
    runs = raster._line_runs(raster._line_cells(ways, meta, ("value",)), meta, ("value",))
    assert runs.count() == 7 * 2000
    ring = [(0.2, 1.0), (6.7, 99_990.0), (7.4, 5.0), (0.2, 1.0)]
    rings = raster._rings(spark.createDataFrame(_chain(1, ring, 1), EDGES), meta, ("value",))
    assert rings.where("plain").count() == 3 and raster._ring_runs(rings, meta, ("value",)).count() <= 16
    layer = raster.rasterize_features(ways, meta, lines_only=True)
    assert layer.count() > 100_000 and layer.agg(F.max("value")).first()[0] == 2.0


def _mixed(rnd, meta, n):
    """Rings as in the test of covered cells; features that are no ring, come twice or have no id."""
    rows = []
    for i in range(n):
        points = [_corner(rnd, meta) for _ in range(rnd.choice((3, 4, 6)))]
        if i % 5 == 0:
            points.append((points[-1][0] + rnd.choice((0.0, 1e-13, 1e-9)), _corner(rnd, meta)[1]))
        if i % 7 == 0:
            points.insert(1, (_corner(rnd, meta)[0], points[0][1]))  # an edge along a row
        if i % 11 == 0:
            points[2] = points[1]
        ring = _chain(None if i == 14 else i, [*points, points[0]], i)
        if i % 10 == 1:
            ring = ring[1:]
        if i % 10 == 2:
            ring = [(*e[:1], None, *e[2:]) for e in ring]
        if i % 10 == 4:
            ring = [(*e[:1], len(ring) - e[1], *e[4:6], *e[2:4], *e[6:]) for e in ring]  # the other way round
        rows += ring * (2 if i % 10 == 3 else 1)
    return rows


@pytest.mark.parametrize("name", LAYERS)
@pytest.mark.parametrize("steps", (4, 256))
def test_counted_cells_of_polygons_equal_their_rows(spark, monkeypatch, name, steps):
    meta = LAYERS[name]
    edges = spark.createDataFrame(_mixed(random.Random(steps + 1), meta, 120), EDGES)
    edges = edges.withColumn("weight", F.when(F.col("feature_id") % 3 > 0, F.col("feature_id") - 50))
    rows = raster.rasterize_polygons(edges, meta, ("weight",)).groupBy("gx", "gy")
    want = {tuple(r) for r in rows.agg(F.count("*"), F.sum("feature_id"), F.sum("weight")).collect()}
    monkeypatch.setattr(raster, "STEPS", steps)
    counted = raster.rasterize_polygons(edges, meta, ("weight",), totals=("feature_id", "weight"))
    assert counted.columns == ["gx", "gy", "n", "feature_id", "weight"]
    got = [tuple(r) for r in counted.collect()]
    assert want and len(got) == len(want) and set(got) == want
    alone = spark.createDataFrame([e for e in edges.select(*EDGES.replace(",", "").split()[::2]).collect() if e["feature_id"] is None], EDGES)
    assert {r["feature_id"] for r in raster.rasterize_polygons(alone, meta, totals=("feature_id",)).collect()} == {None}


@pytest.mark.parametrize("side", ("tall", "wide"))
def test_counting_large_polygons_makes_few_rows(spark, side):
    """Areas of millions of cells on one another are counted from a few rows for each line of their shorter side."""
    tall = LayerMeta(LATLNG, 0.0, 0.0, 8.0, 100_000.0, 1.0, 1.0, 256)
    meta = tall if side == "tall" else LayerMeta(LATLNG, 0.0, 0.0, 100_000.0, 8.0, 1.0, 1.0, 256)
    turned = lambda points: points if side == "tall" else [(y, x) for x, y in points]
    rows = [e for i in range(400) for e in _chain(i, turned([(0.2, 1.0 + i), (6.7, 99_990.0 - i), (7.4, 5.0 + i), (0.2, 1.0 + i)]), i)]
    edges = spark.createDataFrame(rows, EDGES)
    rings = raster._rings(edges, meta, ())
    assert rings.where("plain").count() == 1200 and raster._ring_runs(rings, meta, ()).count() <= 400 * 16
    out = raster.rasterize_polygons(edges, meta, totals=("feature_id",)).agg(F.count("*"), F.max("n"), F.max("feature_id"), F.sum("n")).first()
    assert out[0] > 50_000 and out[1] == 400 and out[2] == 399 * 200 and out[3] > 20_000_000
