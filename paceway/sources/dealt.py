"""Layers stored by cell key, so that map algebra between stored layers needs no exchange.

The catalog keeps packed tiles along the z-curve, which suits boxes and rendering, but a join of two such layers on the cell shuffles both. A dealt layer is a bucketed table: cells with one hash of ``(gx, gy)`` share a
file, sorted by cell. Layers with the same number of buckets join, and group by cell, where they lie; a layer of another number costs the exchange of one side. Hashing by cell gives even buckets at any skew of the
extent; it costs storage against tiles, so it is meant for layers that are combined often.

A layer is written once: a folder that is there is refused, and the number of buckets, by which a reader finds the layer, is published last, so a layer whose writer died is not there. Null values are kept as NODATA.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_dealt(cells: DataFrame, path: str, buckets: int) -> None:
    """Write cells ``(gx, gy, value)`` in ``buckets`` files; one shuffle, and a task writes one file."""
    spark, name = cells.sparkSession, f"paceway_{uuid.uuid4().hex}"
    rows = cells.select(F.col("gx").cast("int").alias("gx"), F.col("gy").cast("int").alias("gy"), F.col("value").cast("double").alias("value"))
    rows = rows.repartition(buckets, "gx", "gy").sortWithinPartitions("gx", "gy")
    spark.createDataFrame([], "buckets int").write.json(f"{path}/started")  # refuses a folder that is there
    try:
        rows.write.format("parquet").bucketBy(buckets, "gx", "gy").sortBy("gx", "gy").option("path", f"{path}/cells").saveAsTable(name)
    finally:
        spark.sql(f"drop table if exists {name}")  # the files stay
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.json(f"{path}/layout")


def read_dealt(spark: SparkSession, path: str) -> DataFrame:
    """Cells of a dealt layer, hash-partitioned by ``(gx, gy)`` wherever a plan can use it."""
    try:
        layout = spark.read.schema("buckets int").json(f"{path}/layout").first()
    except AnalysisException:
        layout = None
    if layout is None:
        raise ValueError(f"no dealt layer in {path}")
    name = f"paceway_layer_{hashlib.md5(path.encode()).hexdigest()}"
    place = f"{path}/cells".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"create table if not exists {name} (gx int, gy int, value double) using parquet clustered by (gx, gy) sorted by (gx, gy) into {layout['buckets']} buckets location '{place}'")
    return spark.table(name)
