"""Histograms, breaks, colour classes, bounds and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceway.functions.grid import _c, tile_of

# ten colours of each ramp, dark to light (fixed values)
RAMPS = {
    "viridis": ["#440154", "#482878", "#3e4989", "#31688e", "#26828e",
                "#1f9e89", "#35b779", "#6ece58", "#b5de2b", "#fde725"],
    "inferno": ["#000004", "#1b0c41", "#4a0c6b", "#781c6d", "#a52c60",
                "#cf4446", "#ed6925", "#fb9b06", "#f7d13d", "#fcffa4"],
    "magma": ["#000004", "#180f3d", "#440f76", "#721f81", "#9e2f7f",
              "#cd4071", "#f1605d", "#fd9668", "#feca8d", "#fcfdbf"],
}
# fixed breaks for roads (km/h) and for streams (weight): low, high, step
ROAD_BREAKS = (8.0, 100.0, 4.0)
STREAM_BREAKS = (0.1, 1.0, 0.1)


def histogram(cells: DataFrame, bins: int = 80) -> DataFrame:
    """Equal-width histogram (bin, lo, hi, n) between the least and the largest value.

    Two passes: the bounds as a scalar subquery, then a count per bin with map-side combine.
    Empty bins have no row.
    """
    known = cells.where("value is not null").select(F.col("value").cast("double").alias("value"))
    ends = known.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("e"))
    tagged = known.withColumn("e", ends.scalar())
    lo, span = F.col("e.lo"), F.col("e.hi") - F.col("e.lo")
    place = F.floor((F.col("value") - lo) / F.nullif(span, F.lit(0.0)) * bins).cast("int")
    slot = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1))
    counted = tagged.groupBy(slot.alias("bin"), lo.alias("lo0"), span.alias("span")).agg(
        F.count("*").alias("n")
    )
    return counted.select(
        "bin",
        (F.col("lo0") + F.col("bin") * F.col("span") / bins).alias("lo"),
        (F.col("lo0") + (F.col("bin") + 1) * F.col("span") / bins).alias("hi"),
        "n",
    )


def centroids(cells: DataFrame, bits: int = 7) -> DataFrame:
    """Histogram state ``(centroid, n, lo, hi)`` from one pass: values that agree in sign, power of two and the ``bits`` binary digits that follow are one row.

    The state of a task folds before the shuffle and states add up by key, in any order. A row spans at most ``2 ** -bits`` of its values, and there are at most ``2 * 2 ** bits`` rows for each power of two that occurs,
    whatever the number of cells. Null, NaN and infinite cells are no values.
    """
    value, size = F.col("value"), F.abs("value")
    known = cells.select(value.cast("double").alias("value")).where("value is not null and not isnan(value) and abs(value) < double('infinity')")
    two, guess = F.lit(2.0), F.floor(F.log2(size))  # a logarithm may be off by one beside a power of two
    power = guess - (F.pow(two, guess) > size).cast("int") + (F.pow(two, guess + 1) <= size).cast("int")
    keyed = known.withColumn("power", power).withColumn("slot", F.floor(size / F.pow(two, F.col("power")) * 2.0**bits))
    state = keyed.groupBy(F.signum("value").alias("sign"), "power", "slot").agg(F.count("*").alias("n"), F.sum("value").alias("sum"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    return state.select(F.greatest("lo", F.least("hi", F.col("sum") / F.col("n"))).alias("centroid"), "n", "lo", "hi")


def centroid_bins(state: DataFrame, bins: int = 80) -> DataFrame:
    """Equal-width histogram (bin, lo, hi, n) of a state of :func:`centroids`, which counts at its centroid.

    Bounds and total are exact; the count up to an edge is off by at most the cells of the row that the edge cuts. The window sees the rows of the state, whose number is bounded.
    """
    whole = Window.partitionBy()
    ends = state.select("centroid", "n", F.min("lo").over(whole).alias("lo0"), (F.max("hi").over(whole) - F.min("lo").over(whole)).alias("span"))
    place = F.floor((F.col("centroid") - F.col("lo0")) / F.nullif("span", F.lit(0.0)) * bins).cast("int")
    slot = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1))
    edge = lambda i: F.col("lo0") + (F.col("bin") + i) * F.col("span") / bins
    counted = ends.groupBy(slot.alias("bin"), "lo0", "span").agg(F.sum("n").alias("n"))
    return counted.select("bin", edge(0).alias("lo"), edge(1).alias("hi"), "n")


def quantile_breaks(cells: DataFrame, n: int = 10, bins: int = 256) -> DataFrame:
    """Values (k, break_value) below which k/n of the histogram lies, k = 1..n.

    Read off the histogram with linear interpolation inside a bin: the window sees at most ``bins``
    rows, so no quantile sketch or full sort of the layer is needed.
    """
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.orderBy("bin").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rows = (
        histogram(cells, bins)
        .withColumn("cum", F.sum("n").over(upto))
        .withColumn("total", F.sum("n").over(all_))
        .withColumn("before", F.col("cum") - F.col("n"))
    )
    first = F.floor(F.col("before") * n / F.col("total")) + 1
    last = F.floor(F.col("cum") * n / F.col("total"))
    share = (F.col("k") * F.col("total") / float(n) - F.col("before")) / F.col("n")
    return (
        rows.where(first <= last)
        .withColumn("k", F.explode(F.sequence(first, last)))
        .select(
            F.col("k").cast("int").alias("k"),
            (F.col("lo") + share * (F.col("hi") - F.col("lo"))).alias("break_value"),
        )
    )


def ramp_breaks(cells: DataFrame, ramp: str = "inferno", bins: int = 256) -> DataFrame:
    """Colour map (class_index, break_value, color) from the quantiles of a layer."""
    colors = RAMPS[ramp]
    breaks = quantile_breaks(cells, len(colors), bins)
    index = F.col("k") - 1
    return breaks.select(
        index.alias("class_index"), "break_value", F.get(F.array(*map(F.lit, colors)), index).alias("color")
    )


def classify(value, breaks: Column) -> Column:
    """Number of breaks below a value: its colour class."""
    v = _c(value)
    return F.when(v.isNotNull(), F.array_size(F.filter(breaks, lambda b: b < v)))


def break_array(breaks: DataFrame) -> Column:
    """A short table of breaks as one array column."""
    return breaks.agg(F.array_sort(F.collect_list("break_value"))).scalar()


def rank_breaks(cells: DataFrame, n: int = 10, bins: int = 256) -> DataFrame:
    """Values (k, break_value) of rank ``ceil(k * count / n)`` among all cells, k = 1..n, exact for any distribution.

    A round cuts each interval that holds wanted ranks into ``bins`` parts of equal width and counts them with map-side combine; the parts that hold the ranks, drawn in to the
    least and largest value they have, are the next round's intervals, until each is one value. An outlier is cut off in the first
    round, so the number of rounds follows the digits of a double, not the data; each reads only values inside its intervals, and the driver sees at most ``n * bins`` counts.
    Null, NaN and infinite cells are no values; without values there are no rows.
    """
    spark = cells.sparkSession
    known = cells.select(F.col("value").cast("double").alias("value")).where("value is not null and not isnan(value) and abs(value) < double('infinity')")
    ends = known.agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    total, found = ends["n"], {}
    # (least, largest, values before, wanted ranks by k)
    active = [(ends["lo"], ends["hi"], 0, {k: -(-k * total // n) for k in range(1, n + 1)})] if total else []
    while active:
        found.update({k: lo for lo, hi, _, ranks in active if lo == hi for k in ranks})
        active = [a for a in active if a[0] < a[1]]
        if not active:
            break
        part, slot = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (lo, hi, _, _) in enumerate(active):
            within = F.col("value").between(F.lit(lo), F.lit(hi))
            half = 1.0 if hi - lo < float("inf") else 0.5  # the width of all doubles is no double
            place = F.floor((F.col("value") * half - F.lit(lo * half)) / F.lit(hi * half - lo * half) * bins)
            part, slot = F.when(within, F.lit(i)).otherwise(part), F.when(within, F.least(place, F.lit(bins - 1)).cast("int")).otherwise(slot)
        reach = known.where(F.col("value").between(F.lit(active[0][0]), F.lit(active[-1][1]))).select("value", part.alias("part"), slot.alias("slot"))
        counted = reach.where("part is not null").groupBy("part", "slot").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        following, before = [], {i: a[2] for i, a in enumerate(active)}
        for r in sorted(counted.collect(), key=lambda r: (r["part"], r["slot"])):
            start = before[r["part"]]
            before[r["part"]] = start + r["n"]
            ranks = {k: x for k, x in active[r["part"]][3].items() if start < x <= start + r["n"]}
            if ranks:
                following.append((r["lo"], r["hi"], start, ranks))
        active = following
    return spark.createDataFrame(sorted(found.items()), "k int, break_value double")


def color_classes(
    cells: DataFrame, ramp: str = "inferno", breaks: DataFrame | None = None, bins: int = 256
) -> DataFrame:
    """Class index and colour of each cell; above the last break the last colour stays."""
    colors = RAMPS[ramp]
    if breaks is None:
        breaks = ramp_breaks(cells, ramp, bins)
    index = F.least(classify("value", F.col("breaks")), F.lit(len(colors) - 1))
    palette = F.array(*map(F.lit, colors))
    return (
        cells.where("value is not null")
        .withColumn("breaks", break_array(breaks))
        .withColumn("class_index", index)
        .withColumn("color", F.get(palette, F.col("class_index")))
        .drop("breaks")
    )


def fixed_classes(cells: DataFrame, breaks: tuple[float, float, float] = ROAD_BREAKS) -> DataFrame:
    """Class of each cell among equal steps: 0 below the first, steps + 1 above the last."""
    low, high, step = breaks
    steps = round((high - low) / step)
    known = cells.where("value is not null")
    slot = F.width_bucket(F.col("value").cast("double"), F.lit(low), F.lit(high), F.lit(steps))
    return known.withColumn("class_index", slot.cast("int"))


def cell_bounds(cells: DataFrame) -> DataFrame:
    """One row (gx0, gy0, gx1, gy1)."""
    return cells.agg(
        F.min("gx").alias("gx0"), F.min("gy").alias("gy0"),
        F.max("gx").alias("gx1"), F.max("gy").alias("gy1"),
    )


def key_bounds(cells: DataFrame, tile_size: int) -> DataFrame:
    """First and last tile column and row of a layer."""
    return cell_bounds(cells).select(
        tile_of("gx0", tile_size).alias("min_col"), tile_of("gy0", tile_size).alias("min_row"),
        tile_of("gx1", tile_size).alias("max_col"), tile_of("gy1", tile_size).alias("max_row"),
    )


def count_levels(levels: DataFrame, tile_size: int = 256) -> DataFrame:
    """Number of tiles per zoom."""
    tiles = levels.select(
        "zoom", tile_of("gx", tile_size).alias("tile_col"), tile_of("gy", tile_size).alias("tile_row")
    ).distinct()
    return tiles.groupBy("zoom").agg(F.count("*").alias("n"))
