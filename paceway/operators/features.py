"""From ways to geometry: tags become values, node references become edges.

Features are plain rows, one per edge: ``(feature_id, kind, seq, x0, y0, x1, y1, <carried columns>)``
with ``kind`` ``line`` or ``polygon``. A polygon is the set of edges of its ring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceway.functions import speed
from paceway.sources.osm import has_tag, tag


# ---- values from tags ------------------------------------------------------------------------
def split_roads_paths(highways: DataFrame) -> tuple[DataFrame, DataFrame]:
    walked = tag("highway").isin(*speed.PATH_CLASSES)
    return highways.where(~walked), highways.where(walked)


def const_value(features: DataFrame, value: float = speed.PATH_SPEED) -> DataFrame:
    """The same number as value and as z-order on every feature."""
    return features.withColumn("value", F.lit(float(value))).withColumn("z", F.col("value"))


def presence_value(features: DataFrame) -> DataFrame:
    """2 for highways, 1 for everything else, as value and as z: roads lie over water."""
    v = F.when(has_tag("highway"), 2.0).otherwise(1.0)
    return features.withColumn("value", v).withColumn("z", v)


def chain_value(features: DataFrame) -> DataFrame:
    v = speed.speed_chain(tag("highway"), tag("maxspeed"))
    return features.withColumn("value", v).withColumn("z", F.col("value"))


def notebook_value(features: DataFrame, unit: str = "kmh", literal_split: bool = False) -> DataFrame:
    """Speed from free text as value and z. Step by step, so that each part is worked out once."""
    return (
        features.withColumn("_text", speed.plain_text(tag("maxspeed")))
        .withColumn("_unit", speed.text_unit_of("_text", unit))
        .withColumn("_base", speed.class_speed(tag("highway"), unit))
        .withColumn("value", speed.speed_of_text("_text", "_unit", "_base", unit, literal_split))
        .drop("_text", "_unit", "_base")
        .withColumn("z", F.col("value"))
    )


def speed_sources(highways: DataFrame) -> DataFrame:
    """How many features got their speed from which link of the chain."""
    source = speed.speed_source(tag("highway"), tag("maxspeed"))
    return highways.groupBy(source.alias("speed_source")).agg(F.count("*").alias("n"))


# ---- streams ---------------------------------------------------------------------------------
# kinds of flow line kept, and stream order -> weight (fixed values)
FLOW_TYPES = ("336", "460")
ORDER_WEIGHT = {0: 0.0, 1: 0.7, 2: 0.6, 3: 0.5, 4: 0.3, 5: 0.2, 6: 0.1}


def filter_ftype(flowlines: DataFrame) -> DataFrame:
    return flowlines.where(F.col("ftype").isin(*FLOW_TYPES))


def _order():
    text = F.trim("stream_order")
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def valid_order(flowlines: DataFrame) -> DataFrame:
    """Keep flow lines whose stream order is present and not negative."""
    return flowlines.where(_order() >= 0)


def order_weight(flowlines: DataFrame) -> DataFrame:
    """Weight of the stream order as value and z; orders without a weight are left out."""
    table = [F.lit(x) for k, v in ORDER_WEIGHT.items() for x in (k, v)]
    weighted = flowlines.withColumn("value", F.try_element_at(F.create_map(*table), _order()))
    return weighted.where(F.col("value").isNotNull()).withColumn("z", F.col("value"))


def order_report(flowlines: DataFrame) -> DataFrame:
    """Valid orders without a weight, counted, so that nothing vanishes unseen."""
    known = F.coalesce(_order().isin(*ORDER_WEIGHT), F.lit(False))
    return (
        valid_order(flowlines).where(~known).groupBy("stream_order").agg(F.count("*").alias("n"))
    )


# ---- geometry --------------------------------------------------------------------------------
def _is_polygon():
    """Closed, at least four references, and an area by tag or for want of ``highway``."""
    n = F.size("refs")
    closed = (n >= 4) & (F.get("refs", F.lit(0)) == F.get("refs", n - 1))
    area = F.coalesce(tag("area") == "yes", F.lit(False)) | ~has_tag("highway")
    return F.coalesce(closed & area, F.lit(False))


def classify_geometry(ways: DataFrame) -> DataFrame:
    """Add ``kind``. The test reads the reference array of the row itself: no shuffle, no join."""
    return ways.withColumn("kind", F.when(_is_polygon(), "polygon").otherwise("line"))


def lines_of(ways: DataFrame) -> DataFrame:
    return ways.where(~_is_polygon())


def polygons_of(ways: DataFrame) -> DataFrame:
    return ways.where(_is_polygon())


def references(ways: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per node reference: (way_id, <carry>, seq, node_id), ``seq`` counted from 1."""
    rows = ways.select("way_id", *carry, F.posexplode("refs").alias("pos", "node_id"))
    return rows.select("way_id", *carry, (F.col("pos") + 1).alias("seq"), "node_id")


def link_references(
    refs: DataFrame, nodes: DataFrame, carry: tuple[str, ...] = (), partitions: int | None = None
) -> DataFrame:
    """Edges between neighbouring references of each way.

    ``refs(way_id, seq, node_id, <carry>)`` meets ``nodes`` in an equi-join, the second shuffle
    brings each way together. A node that very many ways share sits in one join partition, which
    adaptive execution splits since a shuffle follows. A way's references come from the array of one row,
    which bounds the group. References without a node are skipped, however many in a row. A ring
    (``kind`` ``polygon`` among ``carry``) whose first reference has no node is closed from its last known node to its first.
    """
    placed = refs.join(nodes.select("node_id", "lon", "lat"), "node_id").select(
        "way_id", "seq", "lon", "lat", *carry
    )
    group = Window.partitionBy("way_id").orderBy("seq")
    point = F.struct("lon", "lat", "seq")
    step = F.lead(point).over(group)
    if "kind" in carry:
        first = F.first(point).over(group)
        open_ring = (F.col("kind") == "polygon") & (first["seq"] > 1) & (first["seq"] < F.col("seq"))
        step = F.coalesce(step, F.when(open_ring, first))
    # a stated number of partitions is kept as it is: an edge of few bytes may become many cells,
    # so merging partitions by the size of their edges would starve the burning that follows
    parts = partitions or int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        placed.repartition(parts, "way_id")
        .withColumn("step", step)
        .where(F.col("step").isNotNull())
        .select(
            F.col("way_id").alias("feature_id"),
            "seq",
            F.col("lon").alias("x0"),
            F.col("lat").alias("y0"),
            F.col("step.lon").alias("x1"),
            F.col("step.lat").alias("y1"),
            *carry,
        )
    )


def link_points(lines: DataFrame, id_col: str, carry: tuple[str, ...] = (), partitions: int | None = None) -> DataFrame:
    """Edges between neighbouring points of each part of lines that carry their ``points`` (``part``, ``lon``, ``lat``), as vector files give them.

    The points of a line are the array of one row, so no node is looked up and no line gathered; edges are dealt once for the burning that follows, see :func:`link_references`.
    """
    points = F.col("points")
    step = F.zip_with(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rows = lines.select(F.col(id_col).alias("feature_id"), *carry, F.posexplode(step).alias("seq", "step")).where("step.a.part = step.b.part")
    parts = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(
        "feature_id", (F.col("seq") + 1).alias("seq"), F.col("step.a.lon").alias("x0"), F.col("step.a.lat").alias("y0"), F.col("step.b.lon").alias("x1"), F.col("step.b.lat").alias("y1"), *carry,
    ).repartition(parts, "feature_id", "seq")


def assemble_features(
    ways: DataFrame, nodes: DataFrame, carry: tuple[str, ...] = (), partitions: int | None = None
) -> DataFrame:
    """Lines and polygons in one pass. ``ways(way_id, refs, tags, ..)``; filter them first."""
    kept = ("kind", *carry)
    return link_references(references(classify_geometry(ways), kept), nodes, kept, partitions)


def assemble_lines(
    ways: DataFrame, nodes: DataFrame, carry: tuple[str, ...] = (), partitions: int | None = None
) -> DataFrame:
    return assemble_features(lines_of(ways), nodes, carry, partitions)


def assemble_polygons(ways: DataFrame, nodes: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return assemble_features(polygons_of(ways), nodes, carry)


def fuse(lines: DataFrame, polygons: DataFrame) -> DataFrame:
    """Both kinds of feature together, duplicates kept."""
    return lines.unionByName(polygons)


def rings_to_edges(rings: DataFrame) -> DataFrame:
    """Edges of rings given as vertices ``(feature_id, seq, x, y)`` with ``seq`` counted up by one.

    Each vertex meets the next one by equality on (feature, seq), so a huge ring spreads evenly.
    """
    nxt = rings.select(
        "feature_id", (F.col("seq") - 1).alias("seq"), F.col("x").alias("x1"), F.col("y").alias("y1")
    )
    return rings.join(nxt, ["feature_id", "seq"]).select(
        "feature_id", F.lit("polygon").alias("kind"), "seq",
        F.col("x").alias("x0"), F.col("y").alias("y0"), "x1", "y1",
    )


# ---- points ----------------------------------------------------------------------------------
def first_k(df: DataFrame, k: int, order: str) -> DataFrame:
    """The first ``k`` rows in a stated order."""
    return df.orderBy(order).limit(k)
