"""Map elements: nodes, ways with tags and ordered node references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ELEMENTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        # as wide as a long holds: a snapshot with narrower numbers is read all the same
        T.StructField("lat", T.DecimalType(18, 7)),
        T.StructField("lon", T.DecimalType(18, 7)),
        T.StructField("nds", T.ArrayType(T.StructType([T.StructField("ref", T.LongType())]))),
        T.StructField(
            "members",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        T.StructField("ref", T.LongType()),
                        T.StructField("role", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("version", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("visible", T.BooleanType()),
    ]
)


def read_osm(spark: SparkSession, path: str) -> DataFrame:
    """Element snapshot (newest version of every element) stored as ORC."""
    return spark.read.schema(ELEMENTS).orc(path)


def patch_visible(elements: DataFrame) -> DataFrame:
    """Mark every element visible."""
    return elements.withColumn("visible", F.lit(True))


def nodes_of(elements: DataFrame) -> DataFrame:
    """nodes(node_id, lon, lat, tags)"""
    return elements.where(F.col("type") == "node").select(
        F.col("id").alias("node_id"),
        F.col("lon").cast("double").alias("lon"),
        F.col("lat").cast("double").alias("lat"),
        "tags",
    )


def ways_of(elements: DataFrame) -> DataFrame:
    """ways(way_id, tags, refs); ``refs`` keeps the order of the nodes."""
    return elements.where(F.col("type") == "way").select(
        F.col("id").alias("way_id"), "tags", F.col("nds.ref").alias("refs")
    )


def way_nodes_of(ways: DataFrame) -> DataFrame:
    """way_nodes(way_id, seq, node_id), ``seq`` counted from 1."""
    return ways.select("way_id", F.posexplode("refs").alias("pos", "node_id")).select(
        "way_id", (F.col("pos") + 1).alias("seq"), "node_id"
    )


def split_elements(elements: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, ways, way_nodes); relations are left out.

    Each of the three is its own column-pruned scan, and the ``type`` test reaches the file reader.
    """
    ways = ways_of(elements)
    return nodes_of(elements), ways, way_nodes_of(ways)


def tag(key: str, tags: str = "tags"):
    return F.try_element_at(F.col(tags), F.lit(key))


def has_tag(key: str, tags: str = "tags"):
    return F.map_contains_key(tags, key)


def roads_and_water(ways: DataFrame) -> DataFrame:
    """Ways tagged ``highway`` or ``waterway``, whatever the value."""
    return ways.where(has_tag("highway") | has_tag("waterway"))


def highways(features: DataFrame) -> DataFrame:
    return features.where(has_tag("highway"))
