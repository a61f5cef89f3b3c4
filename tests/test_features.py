import math

from pyspark.sql import functions as F

from paceway.meta import LATLNG, LayerMeta
from paceway.operators import features, raster

GRID = LayerMeta(LATLNG, 0.0, 0.0, 20.0, 20.0, 1.0, 1.0, 8)
WAYS = "way_id long, tags map<string,string>, refs array<long>"


def nodes(spark, points):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in points.items()], "node_id long, lon double, lat double")


def test_missing_nodes_are_skipped(spark):
    ways = spark.createDataFrame([(1, {"highway": "road"}, [1, 99, 2, 3]), (2, {"highway": "road"}, [98, 3])], WAYS)
    edges = features.assemble_features(ways, nodes(spark, {1: (0, 0), 2: (1, 1), 3: (2, 0)}))
    got = sorted((r["feature_id"], r["seq"], r["x0"], r["x1"]) for r in edges.collect())
    assert got == [(1, 1, 0.0, 1.0), (1, 3, 1.0, 2.0)]


def test_long_gap_is_bridged(spark):
    """Tens of thousands of unknown references in a row do not break a line."""
    ways = spark.createDataFrame([(1, {"highway": "road"}, [1, *range(100, 40_000), 2])], WAYS)
    edges = features.assemble_features(ways, nodes(spark, {1: (0, 0), 2: (1, 1)})).collect()
    assert [(r["x0"], r["x1"]) for r in edges] == [(0.0, 1.0)]


def test_ring_without_its_closing_node_is_closed(spark, cells):
    ring = {1: (2, 2), 2: (9, 2), 3: (9, 9), 4: (2, 9)}
    ways = spark.createDataFrame([(1, {"waterway": "river"}, [99, 1, 2, 3, 4, 99]), (2, {"waterway": "river"}, [98, 1, 98, 98])], WAYS)
    edges = features.assemble_features(ways, nodes(spark, ring))
    got = sorted((r["seq"], r["x0"], r["y0"], r["x1"], r["y1"]) for r in edges.collect())
    assert got == [(2, 2, 2, 9, 2), (3, 9, 2, 9, 9), (4, 9, 9, 2, 9), (5, 2, 9, 2, 2)]
    filled = raster.rasterize_polygons(edges.withColumn("value", F.lit(1.0)), GRID, ("value",)).count()
    whole = spark.createDataFrame([(1, {"waterway": "river"}, [1, 2, 3, 4, 1])], WAYS)
    edges = features.assemble_features(whole, nodes(spark, ring))
    assert filled == raster.rasterize_polygons(edges.withColumn("value", F.lit(1.0)), GRID, ("value",)).count() == 49


def test_long_way_equals_one_window(spark):
    """A way half of whose nodes are unknown links its known ones."""
    points = {i: (i % 20, (i * 7) % 20) for i in range(0, 1000, 2)}
    ways = spark.createDataFrame([(1, {"highway": "road"}, list(range(1000))), (2, {"highway": "road"}, [4, 2])], WAYS)
    edges = features.assemble_features(ways, nodes(spark, points)).where("feature_id = 1")
    got = [(r["seq"], r["x0"], r["x1"]) for r in edges.orderBy("seq").collect()]
    ids = sorted(points)
    want = [(a + 1, float(points[a][0]), float(points[b][0])) for a, b in zip(ids, ids[1:])]
    assert got == want


def test_shared_node_is_split(spark):
    """A node that a third of all references name: the join splits its partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ids = spark.range(60000).repartition(8)
        refs = ids.select(
            (F.col("id") % 5000).alias("way_id"), F.floor(F.col("id") / 5000).cast("int").alias("seq"),
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 4000).alias("node_id"),
        )
        spots = spark.range(4000).select(F.col("id").alias("node_id"), (F.col("id") % 20).cast("double").alias("lon"), F.lit(1.0).alias("lat"))
        edges = features.link_references(refs, spots)
        assert len(edges.collect()) == 60000 - 5000
        plan = edges._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_polygon_rule(spark):
    ring, bar = [1, 2, 3, 1], [1, 2, 1]
    ways = spark.createDataFrame(
        [
            (1, {"waterway": "river"}, ring),
            (2, {"highway": "road"}, ring),
            (3, {"highway": "road", "area": "yes"}, ring),
            (4, {"waterway": "river"}, bar),
            (5, {}, []),
            (6, {"area": "no", "highway": "road"}, ring),
        ],
        WAYS,
    )
    got = {r["way_id"]: r["kind"] for r in features.classify_geometry(ways).collect()}
    assert got == {1: "polygon", 2: "line", 3: "polygon", 4: "line", 5: "line", 6: "line"}
    spots = nodes(spark, {1: (1, 1), 2: (9, 1), 3: (5, 9)})
    one = features.assemble_features(ways, spots)
    two = features.fuse(features.assemble_lines(ways, spots), features.assemble_polygons(ways, spots))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.select(one.columns).collect()))


def edges(spark, rows, kind="line"):
    data = [(i, kind, *map(float, r)) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "feature_id int, kind string, x0 double, y0 double, x1 double, y1 double")


def test_line_cells(spark, monkeypatch):
    lines = edges(spark, [(0.5, 19.5, 3.5, 19.5), (5.5, 15.5, 5.5, 15.5), (0.5, 10.5, 4.5, 8.5), (-3.5, 5.5, 1.5, 5.5), (19.5, 0.5, 0.5, 19.5)])
    for steps in (4096, 3):
        monkeypatch.setattr(raster, "STEPS", steps)
        got = {}
        for r in raster.rasterize_lines(lines, GRID).collect():
            got.setdefault(r["feature_id"], []).append((r["gx"], r["gy"]))
        assert sorted(got[0]) == [(0, 0), (1, 0), (2, 0), (3, 0)]
        assert set(got[1]) == {(5, 4)}
        assert len(got[2]) == 5 and (0, 9) in got[2] and (4, 11) in got[2]
        assert sorted(got[3]) == [(0, 14), (1, 14)]
        assert sorted(got[4]) == [(i, i) for i in range(20)]


def inside(x, y, ring):
    odd = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
        if (y0 > y) != (y1 > y) and x > x0 + (y - y0) * (x1 - x0) / (y1 - y0):
            odd = not odd
    return odd


def test_polygon_cells_by_brute_force(spark, monkeypatch):
    import random

    rng = random.Random(7)
    rings = {}
    for i in range(12):
        corners = [(rng.uniform(-6, 26), rng.uniform(-6, 26)) for _ in range(rng.randint(3, 9))]
        rings[i] = [*corners, corners[0]]
    rows = [(i, s, float(x), float(y)) for i, ring in rings.items() for s, (x, y) in enumerate(ring)]
    table = spark.createDataFrame(rows, "feature_id int, seq int, x double, y double")
    want = {
        (i, gx, gy) for i, ring in rings.items() for gx in range(20) for gy in range(20)
        if inside(gx + 0.5, 20 - gy - 0.5, ring)
    }
    for band in (16, 1, 5):
        monkeypatch.setattr(raster, "BAND", band)
        cells = raster.rasterize_polygons(features.rings_to_edges(table), GRID).collect()
        assert len(cells) == len(want) and {tuple(c) for c in cells} == want


def test_burn_order(spark):
    rows = [(0, 0, 5.0, 1.0), (0, 0, 9.0, 0.5), (0, 0, 4.0, 1.0), (1, 0, -2.0, -3.0)]
    cells = spark.createDataFrame(rows, "gx int, gy int, value double, z double")
    assert {r["gx"]: r["value"] for r in raster.burn(cells, "z").collect()} == {0: 5.0, 1: -2.0}
    assert {r["gx"]: r["value"] for r in raster.burn(cells).collect()} == {0: 9.0, 1: -2.0}


def test_burn_order_by_hash(spark):
    """Maxima by z sort no cells; unknown z and values lose."""
    rows = [(0, 0, 5.0, None), (0, 0, 9.0, None), (1, 0, None, 3.0), (1, 0, 4.0, 2.0), (2, 0, 1.0, 0.0), (2, 0, 2.0, -0.0), (3, 0, None, None), (4, 0, 7.0, float("nan")), (4, 0, 8.0, 1e9), (5, 0, 6.0, 1.0), (5, 0, 99.0, None)]
    burnt = raster.burn(spark.createDataFrame(rows, "gx int, gy int, value double, z double"), "z")
    assert "SortAggregate" not in burnt._jdf.queryExecution().executedPlan().toString()
    assert {r["gx"]: r["value"] for r in burnt.collect()} == {0: 9.0, 1: None, 2: 2.0, 3: None, 4: 7.0, 5: 6.0}


def test_line_pieces_stay_on_the_layer(spark, monkeypatch):
    """Steps off the layer are left out before cells are made, whatever way an edge takes past it."""
    import random

    rng = random.Random(5)
    near = [tuple(rng.uniform(-60, 80) for _ in range(4)) for _ in range(300)]
    far = [(0.5, -3e6, 19.5, 3e6), (-2e6, 3.5, 2e6, 3.5), (-2e6, -2e6, 2e6, 2e6 + 40), (5.5, 900.5, 5.5, -900.5), (40.5, -9e5, 40.5, 9e5), (3.5, 30.5, 3.5, 30.5)]
    lines = edges(spark, near + far)
    for steps in (256, 7):
        monkeypatch.setattr(raster, "STEPS", steps)
        pieces = raster._line_pieces(lines, GRID, ()).selectExpr("feature_id", "last - first + 1 as steps").collect()
        assert max(p["steps"] for p in pieces) <= steps
        made = {i: sum(p["steps"] for p in pieces if p["feature_id"] == i) for i in (300, 301, 302, 303)}
        assert all(0 < m <= 20 + 2 * steps for m in made.values())
        assert not any(p["feature_id"] in (304, 305) for p in pieces)
        want = set()
        for i, (x0, y0, x1, y1) in enumerate(near):
            (c0, r0), (c1, r1) = ((math.floor(x), math.floor(20 - y)) for x, y in ((x0, y0), (x1, y1)))
            n = max(abs(c1 - c0), abs(r1 - r0), 1)
            for k in range(n + 1):
                c, r = ((2 * k * (b - a) + n) // (2 * n) + a for a, b in ((c0, c1), (r0, r1)))
                if 0 <= c < 20 and 0 <= r < 20:
                    want.add((i, c, r))
        got = {tuple(r) for r in raster.rasterize_lines(lines, GRID).collect() if r["feature_id"] < 300}
        assert got == want


def test_open_rings_and_equal_crossings(spark):
    """Equal crossings cancel in pairs; one left over fills nothing."""
    upright = [(x, 19.9, x, 18.1) for x in (2.2, 5.2, 5.3, 9.2)] + [(x, 17.9, x, 16.1) for x in (2.2, 5.2, 5.3)]
    rows = edges(spark, upright, "polygon").withColumn("feature_id", F.floor(F.col("feature_id") / 100))
    got = {(r["gx"], r["gy"]) for r in raster.rasterize_polygons(rows, GRID).collect()}
    assert got == {(x, y) for x in range(2, 9) for y in (0, 1)}
    plan = raster.rasterize_polygons(rows, GRID)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_stream_orders(spark):
    rows = [("336", "0"), ("336", "7"), ("460", "6"), ("558", "1"), ("336", ""), ("336", None), ("460", "-9"), (None, "2"), ("336", "x")]
    flow = spark.createDataFrame(rows, "ftype string, stream_order string")
    kept = features.valid_order(features.filter_ftype(flow))
    assert [(r["stream_order"], r["value"]) for r in features.order_weight(kept).collect()] == [("0", 0.0), ("6", 0.1)]
    assert [tuple(r) for r in features.order_report(kept).collect()] == [("7", 1)]


def test_lines_and_polygons_share_the_assembly(spark):
    """Both branches of the burning read the same linked references."""
    ways = spark.createDataFrame([(1, {"waterway": "river"}, [1, 2, 3, 1]), (2, {"highway": "road"}, [1, 2])], WAYS)
    spots = nodes(spark, {1: (1, 1), 2: (9, 1), 3: (5, 9)})
    shapes = features.assemble_features(features.presence_value(ways), spots, ("value",))
    layer = raster.rasterize_features(shapes, GRID, "int8", num_partitions=3)
    got = {(r["gx"], r["gy"]): r["value"] for r in layer.collect()}
    assert set(got.values()) == {1, 2} and got[(5, 19)] == 2 and got[(5, 15)] == 1
    assert "ReusedExchange" in layer._jdf.queryExecution().executedPlan().toString()
