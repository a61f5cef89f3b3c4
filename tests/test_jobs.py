import math

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from paceway.meta import LATLNG, LayerMeta
from paceway.plans import jobs
from paceway.sources import osm

SF = "/root/testdata/sf0.001"


def test_adjusted_cost_brings_cover_to_the_road_layout(spark):
    """Cover on a coarser, shifted grid gives what the same cover gives when it is laid on the road grid by hand."""
    coarse = LayerMeta(LATLNG, -72.01, 41.0, -71.0, 42.013, 1 / 45, 1 / 45)
    codes = (11, 21, 31, 41, 71, 95)
    code = lambda x, y: codes[(5 * x + 3 * y) % len(codes)]
    on_coarse = [(x, y, float(code(x, y))) for x in range(coarse.cols) for y in range(coarse.rows)]
    g, on_grid = fx.GRID, []
    for gx in range(50):
        for gy in range(4):
            lon, lat = g.xmin + (gx + 0.5) * g.cell_w, g.ymax - (gy + 0.5) * g.cell_h
            on_grid.append((gx, gy, float(code(math.floor((lon - coarse.xmin) / coarse.cell_w), math.floor((coarse.ymax - lat) / coarse.cell_h)))))

    def base(cells, **kw):
        elements = osm.read_osm(spark, fx.elements_orc(spark, SF))
        cover = spark.createDataFrame(cells, "gx int, gy int, value double")
        out = jobs.adjusted_travel_cost(elements, fx.dem(spark, SF), cover, fx.flowlines(spark, SF), fx.sources(spark, SF), g, fx.MASK, layout=g, max_cost=1.0, **kw)
        rows = sorted((r["gx"], r["gy"], round(r["value"], 6)) for r in out.base.where(F.col("value").isNotNull()).collect())
        out.release()
        return rows

    want = base(on_grid)
    assert want and base(on_coarse, cover_meta=coarse) == want


ROADS_AT = {1: (-71.99, 41.99), 2: (-71.93, 41.975), 3: (-71.8, 41.99), 4: (-71.7, 41.972)}
FAR_AT = {5: (-71.9, -120.25), 6: (-71.8, -158.0041667)}


def snapshot(spark, path, places):
    """Elements stored as ORC: nodes at ``places``, and for each two that follow one another a road."""
    nodes = [(i, "node", {}, lat, lon, None) for i, (lon, lat) in places.items()]
    ways = [(100 + a, "way", {"highway": "primary", "maxspeed": "50"}, None, None, [(a,), (b,)]) for a, b in ((1, 2), (2, 3), (3, 4), (5, 6)) if b in places]
    rows = spark.createDataFrame(nodes + ways, "id long, type string, tags map<string,string>, lat double, lon double, nds array<struct<ref:long>>")
    shaped = ((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in osm.ELEMENTS.fields)
    rows.select(*shaped).write.orc(path)
    return osm.read_osm(spark, path)


def _ground(spark):
    return spark.createDataFrame([(x, y, 10.0 + (3 * x + y) % 7) for x in range(50) for y in range(4)], "gx int, gy int, value double")


def _points(spark):
    return spark.createDataFrame([(1, -71.99, 41.99), (2, -71.75, 41.98)], "pt_id long, lon double, lat double")


def _adjusted(spark, elements):
    cover = _ground(spark).withColumn("value", F.lit(21.0))
    flows = spark.createDataFrame([(1, [1, 4], "460", "2")], "way_id long, refs array<long>, ftype string, stream_order string")
    return jobs.adjusted_travel_cost(elements, _ground(spark), cover, flows, _points(spark), fx.GRID, fx.MASK, layout=fx.GRID, max_cost=1.0)


def _travel(spark, elements):
    return jobs.travel_cost(elements, _ground(spark), _points(spark), fx.GRID, layout=fx.ROADS, extent=fx.GRID.extent, first=6, max_cost=1.0)


JOBS = {
    "job_adjusted_friction": _adjusted,
    "job_cost_distance": _travel,
    "job_friction_pyramid": lambda spark, e: jobs.friction_pyramid(e, _ground(spark), fx.GRID, partitions=8),
    "job_presence": lambda spark, e: jobs.presence_layer(e, fx.ROADS, partitions=8),
}


@pytest.mark.parametrize("name", JOBS)
def test_nodes_far_off_the_map_change_nothing(spark, tmp_path, monkeypatch, name):
    """A snapshot with a road beyond latitude -99 is stored and read whole, and gives what the same snapshot gives without that road. Of the cost jobs, the friction that goes into the cost distance."""
    monkeypatch.setattr(jobs, "_cost_of", lambda friction, points, meta, *_: jobs.Surface(friction, meta))

    def rows(folder, places):
        out = JOBS[name](spark, snapshot(spark, f"{tmp_path}/{folder}", places))
        found = sorted((r["gx"], r["gy"], r["value"]) for r in out.base.where(F.col("value").isNotNull()).collect())
        out.release()
        return found

    want = rows("near", ROADS_AT)
    assert want and rows("far", ROADS_AT | FAR_AT) == want


def test_six_sources_reach_the_whole_map(spark, tmp_path):
    """The job of the wide region goes on until its sources' costs cover the friction surface, here level ground of 200 rows without roads but for one of two nodes."""
    from checks import queries

    tables = {
        "part": spark.range(10000).selectExpr("id as p_partkey", "5 as p_size", "1e0 as p_retailprice"),
        "supplier": spark.range(9).selectExpr("id as s_suppkey"),
        "orders": spark.range(10, 11).selectExpr("id as o_orderkey", "'5-LOW' as o_orderpriority"),
        "lineitem": spark.range(2).selectExpr("10L as l_orderkey", "cast(id as int) as l_linenumber", "id * 60 as l_partkey", "1e0 as l_extendedprice", "id as l_suppkey"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")

    def base_cells(query):
        rows = query(spark, str(tmp_path)).where("zoom = 8").collect()
        friction, cost = ({(r["gx"], r["gy"]): r["value"] for r in rows if r["layer"] == layer} for layer in ("friction", "cost"))
        return friction, cost

    friction, cost = base_cells(queries.job_cost_distance_6)
    assert len(friction) > 10000 and cost.keys() == friction.keys()
    assert 100 * fx.JOB_CAP > max(cost.values()) > 20 * fx.JOB_CAP
    near = base_cells(queries.job_cost_distance)[1]
    assert near and max(near.values()) <= fx.JOB_CAP  # its cap is its own
