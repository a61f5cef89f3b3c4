import pytest
from pyspark.sql import functions as F

from paceway.operators import local
from paceway.runtime import fresh_dir
from paceway.sources import dealt


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def stored(spark, layer, buckets=4):
    path = fresh_dir(spark, "dealt")
    dealt.save_dealt(layer, path, buckets)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_layers_join_without_exchange(spark, cells, as_dict, no_broadcast):
    values = [{(x, y): None if (x + k * y) % 11 == 0 else x * (k + 1) + y for x in range(30) for y in range(20) if (x + y) % (k + 2)} for k in range(4)]
    layers = [dealt.read_dealt(spark, stored(spark, cells(v))) for v in values]
    for df, want in (
        (local.merge_max(*layers[:2]), local.merge_max(*map(cells, values[:2]))),
        (local.local_add(*layers[:2]), local.local_add(*map(cells, values[:2]))),
        (local.local_max(*layers[:2], nodata="ignore"), local.local_max(*map(cells, values[:2]), nodata="ignore")),
        (local.adjusted_speed(*layers), local.adjusted_speed(*map(cells, values))),
    ):
        text = plan(df)
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert as_dict(df) == as_dict(want)
    assert "Exchange" not in plan(layers[0].groupBy("gx", "gy").agg(F.max("value").alias("value")))
    # Another number of buckets still gives the same cells.
    other = dealt.read_dealt(spark, stored(spark, cells(values[1]), 3))
    assert as_dict(local.merge_max(layers[0], other)) == as_dict(local.merge_max(*map(cells, values[:2])))


def test_round_trip_and_refusal(spark, cells, as_dict):
    path = stored(spark, cells({(0, 0): 1, (5, 6): None, (-3, 2): 2.5}))
    assert as_dict(dealt.read_dealt(spark, path)) == {(0, 0): 1.0, (5, 6): None, (-3, 2): 2.5}
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        dealt.save_dealt(cells({(0, 0): 9}), path, 4)
    assert dealt.read_dealt(spark, path).count() == 3
    assert dealt.read_dealt(spark, stored(spark, cells({}))).count() == 0


def test_writer_that_dies(spark, cells):
    path = fresh_dir(spark, "dealt")
    broken = cells({(x, 0): x for x in range(40)}).withColumn("value", F.when(F.col("gx") == 33, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        dealt.save_dealt(broken, path, 4)
    with pytest.raises(ValueError, match="no dealt layer"):
        dealt.read_dealt(spark, path)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("paceway_") and not t.name.startswith("paceway_layer_")]
