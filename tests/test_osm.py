from pyspark.sql import functions as F

from checks import fixtures as fx
from paceway.sources import osm


def test_snapshots_of_narrow_and_of_wide_numbers(spark, tmp_path):
    """Coordinates stored with fewer digits are read as they are, those of many digits are not refused."""
    rows = spark.createDataFrame([(1, "42.1234567", "-171.7654321"), (2, "-42.5", "0.0000001")], "id long, lat string, lon string")
    typed = rows.select("id", F.lit("node").alias("type"), F.col("lat").cast("decimal(9,7)").alias("lat"), F.col("lon").cast("decimal(10,7)").alias("lon"))
    typed.write.orc(f"{tmp_path}/narrow")
    got = osm.nodes_of(osm.read_osm(spark, f"{tmp_path}/narrow"))
    assert sorted((r["node_id"], r["lat"], r["lon"]) for r in got.collect()) == [(1, 42.1234567, -171.7654321), (2, -42.5, 0.0000001)]
    assert [r["node_id"] for r in got.where("lat > 42").collect()] == [1]


def test_elements_of_many_parts(spark, tmp_path):
    """The stand-in puts a node for each part on a row of its own, however many there are."""
    spark.createDataFrame([(7, 1), (1199999, 2)], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([], "o_orderkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    nodes, _, _ = osm.split_elements(osm.read_osm(spark, fx.elements_orc(spark, str(tmp_path))))
    want = {r["node_id"]: r["lat"] for r in fx.nodes(spark, str(tmp_path)).collect()}
    assert {r["node_id"]: r["lat"] for r in nodes.collect()} == want and want[1199999] < -99
