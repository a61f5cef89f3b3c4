"""Point sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceway.functions.grid import mercator_x, mercator_y

GEOJSON = (
    "type string, "
    "features array<struct<type:string, geometry:struct<type:string, coordinates:array<double>>>>"
)


def read_geojson_points(spark: SparkSession, path: str) -> DataFrame:
    """points(lon, lat) of GeoJSON feature collections; properties are left out.

    Files are read in parallel, a document as a whole, as the format asks for.
    """
    documents = spark.read.schema(GEOJSON).json(path, multiLine=True)
    features = documents.select(F.explode("features").alias("f"))
    return features.where("f.geometry.type = 'Point'").select(
        F.get("f.geometry.coordinates", F.lit(0)).alias("lon"),
        F.get("f.geometry.coordinates", F.lit(1)).alias("lat"),
    )


def to_mercator(points: DataFrame) -> DataFrame:
    """Add Web Mercator metres ``x``, ``y`` to points in degrees."""
    return points.withColumn("x", mercator_x("lon")).withColumn("y", mercator_y("lat"))
