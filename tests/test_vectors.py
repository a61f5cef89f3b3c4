import pathlib

import pytest
from pyspark.sql import functions as F

from paceway.operators import features
from paceway.runtime import fresh_dir
from paceway.sources import vectors

FIELDS = {"way_id": ("way_id", 20), "ftype": ("FType", 12), "name": ("Name", 40)}
READ = {c: label for c, (label, _) in FIELDS.items()}
SCHEMA = f"way_id long, ftype string, name string, points {vectors.POINTS}"


def plain(folder):
    return pathlib.Path(folder.removeprefix("file:"))


def sample(n):
    return [(i, ["336", "460", None, ""][i % 4], f"Bäch {i}" if i % 3 else "河", [(p, i + 0.1 * k, p - 0.25 * k) for p in range(1 + i % 3) for k in range(2 + i % 5)] if i % 7 else None) for i in range(n)]


def rows_of(df):
    return sorted((int(r["way_id"]), r["ftype"], r["name"], [tuple(p) for p in r["points"]]) for r in df.collect())


@pytest.mark.parametrize("records_per_task,block", [(1, 1), (7, 200), (50_000, 4 << 20)])
def test_round_trip(spark, records_per_task, block):
    folder, rows = fresh_dir(spark, "vectors"), sample(60)
    lines = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert vectors.write_lines(lines, folder, FIELDS, roll_bytes=1500) == 60
    assert len(list(plain(folder).glob("*.shx"))) > 3
    assert not list((plain(folder) / "_temporary").glob("*"))
    got = vectors.read_lines(spark, folder, READ, records_per_task, block=block)
    assert rows_of(got) == [(i, t or "", n, p or []) for i, t, n, p in rows]


def test_one_large_file_is_many_tasks(spark):
    folder = fresh_dir(spark, "vectors")
    vectors.write_lines(spark.createDataFrame(sample(60), SCHEMA).coalesce(1), folder, FIELDS)
    got = vectors.read_lines(spark, folder, READ, 10)
    assert len(list(plain(folder).glob("*.shp"))) == 1
    spread = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sorted(r["count"] for r in spread) == [10] * 6


def test_headers_and_boxes(spark):
    """The numbers that other readers go by, taken from the bytes."""
    import struct

    folder = fresh_dir(spark, "vectors")
    vectors.write_lines(spark.createDataFrame([(1, "336", "x", [(0, 3.0, -1.0), (0, 5.0, 2.0), (1, 0.5, 9.0), (1, 4.0, 1.0)])], SCHEMA).coalesce(1), folder, FIELDS)
    shp, shx, dbf = (next(plain(folder).glob(f"*.{end}")).read_bytes() for end in ("shp", "shx", "dbf"))
    for data in (shp, shx):
        assert struct.unpack(">i20xi", data[:28]) == (9994, len(data) // 2)
        assert struct.unpack("<2i4d", data[28:68]) == (1000, 3, 0.5, -1.0, 5.0, 9.0)
    assert struct.unpack(">2i", shx[100:]) == (50, (len(shp) - 108) // 2)
    assert struct.unpack("<i4d4i", shp[108:160]) == (3, 0.5, -1.0, 5.0, 9.0, 2, 4, 0, 2)
    assert struct.unpack("<IHH", dbf[4:12]) == (1, 32 + 3 * 32 + 1, 1 + 72) and len(dbf) == 129 + 73 + 1


def test_deleted_damaged_and_other_shapes(spark):
    folder = fresh_dir(spark, "vectors")
    vectors.write_lines(spark.createDataFrame(sample(8), SCHEMA).coalesce(1), folder, FIELDS)
    dbf, shp = (next(plain(folder).glob(f"*.{end}")) for end in ("dbf", "shp"))
    data = bytearray(dbf.read_bytes())
    data[129 + 73 * 2] = ord("*")
    dbf.write_bytes(data)
    assert [r[0] for r in rows_of(vectors.read_lines(spark, folder, READ, 3))] == [0, 1, 3, 4, 5, 6, 7]
    with pytest.raises(Exception, match="no field Width"):
        vectors.read_lines(spark, folder, {"w": "Width"}).collect()
    whole = shp.read_bytes()
    shp.write_bytes(whole[:108] + b"\x05" + whole[109:])  # the first record as a polygon
    with pytest.raises(Exception, match="shape type 5, not a line"):
        vectors.read_lines(spark, folder, READ).collect()
    shp.write_bytes(whole[:-8])
    with pytest.raises(Exception, match="not what the index says"):
        vectors.read_lines(spark, folder, READ).collect()
    # A set without its index is not there yet.
    next(plain(folder).glob("*.shx")).unlink()
    assert vectors.read_lines(spark, folder, READ).count() == 0


def test_failed_write_leaves_no_set(spark):
    folder = fresh_dir(spark, "vectors")
    with pytest.raises(Exception, match="longer than the 12 bytes"):
        vectors.write_lines(spark.createDataFrame([*sample(8), (9, "x" * 13, "n", None)], SCHEMA).repartition(4), folder, FIELDS)
    assert vectors.read_lines(spark, folder, READ).count() == 0
    assert vectors.write_lines(spark.createDataFrame([], SCHEMA), folder, FIELDS) == 0
    with pytest.raises(ValueError, match="does not fit"):
        vectors.write_lines(spark.createDataFrame([], SCHEMA), folder, {"name": ("much_too_long", 4)})


def test_edges_of_points(spark):
    rows = [(i, "336", "", p) for i, p in enumerate([None, [], [(0, 1.0, 1.0)], [(0, 1.0, 1.0), (0, 2.0, 1.0), (0, 2.0, 3.0), (1, 7.0, 7.0), (1, 8.0, 7.0)]])]
    edges = features.link_points(spark.createDataFrame(rows, SCHEMA), "way_id", ("ftype",), 3)
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    got = sorted((r["feature_id"], r["seq"], r["x0"], r["y0"], r["x1"], r["y1"], r["ftype"]) for r in edges.collect())
    assert got == [(3, 1, 1.0, 1.0, 2.0, 1.0, "336"), (3, 2, 2.0, 1.0, 2.0, 3.0, "336"), (3, 4, 7.0, 7.0, 8.0, 7.0, "336")]
