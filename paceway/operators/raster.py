"""Burning features into cells, and the cell types of layers."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceway.functions.grid import _c, col_of, inside, row_of, tile_of
from paceway.meta import LayerMeta
from paceway.operators.layout import partition_tiles

# steps of a long edge taken by one row before the next row takes over
STEPS = 256
# grid rows of a polygon handled together
BAND = 16


def tile_keys(cells: DataFrame, meta: LayerMeta) -> DataFrame:
    """Add the tile that holds each cell."""
    return cells.withColumn("tile_col", tile_of("gx", meta.tile_size)).withColumn(
        "tile_row", tile_of("gy", meta.tile_size)
    )


def _steps(n: Column) -> Column:
    """0..n in pieces of bounded length: one array of piece starts, one array per piece."""
    return F.sequence(F.lit(0), F.floor(n / F.lit(float(STEPS))).cast("int"))


def _meets(meta: LayerMeta, c0, r0, c1, r1) -> Column:
    """Whether the box of two cells meets the layer."""
    c0, r0, c1, r1 = map(_c, (c0, r0, c1, r1))
    return (F.greatest(c0, c1) >= 0) & (F.least(c0, c1) < meta.cols) & (F.greatest(r0, r1) >= 0) & (F.least(r0, r1) < meta.rows)


def _at(a: str, b: str, i: Column) -> Column:
    """Cell at step ``i`` of ``n`` from cell ``a`` to cell ``b``."""
    d = (F.col(b) - F.col(a)).cast("double")
    return F.floor((2 * i * d + F.col("n")) / (2.0 * F.col("n"))).cast("int") + F.col(a)


def _line_cells(edges: DataFrame, meta: LayerMeta, carry: tuple[str, ...]) -> DataFrame:
    """Edges in cells (c0, r0, c1, r1) with their steps ``n``, without the edges whose box is off the layer."""
    n = F.greatest(F.abs(F.col("c1") - F.col("c0")), F.abs(F.col("r1") - F.col("r0")), F.lit(1))
    return (
        edges.select(
            "feature_id",
            *carry,
            col_of("x0", meta).alias("c0"),
            row_of("y0", meta).alias("r0"),
            col_of("x1", meta).alias("c1"),
            row_of("y1", meta).alias("r1"),
        )
        .where(_meets(meta, "c0", "r0", "c1", "r1"))
        .withColumn("n", n)
    )


def _line_pieces(edges: DataFrame, meta: LayerMeta, carry: tuple[str, ...]) -> DataFrame:
    """Edges in cells (c0, r0, c1, r1, n, whole), cut in pieces of at most ``STEPS`` steps ``first`` .. ``last``, without the pieces whose box is off the layer."""
    return _pieces(_line_cells(edges, meta, carry), meta)


def _pieces(lines: DataFrame, meta: LayerMeta) -> DataFrame:
    first, last = F.col("first"), F.col("last")
    return (
        # an edge with both ends on the layer stays on it: no test per cell
        lines.withColumn("whole", inside(meta, "c0", "r0") & inside(meta, "c1", "r1"))
        .withColumn("piece", F.explode(_steps(F.col("n"))))
        .withColumn("first", F.col("piece") * STEPS)
        .withColumn("last", F.least(F.col("n"), first + (STEPS - 1)))
        .where(F.col("whole") | _meets(meta, _at("c0", "c1", first), _at("r0", "r1", first), _at("c0", "c1", last), _at("r0", "r1", last)))
    )


def rasterize_lines(edges: DataFrame, meta: LayerMeta, carry: tuple[str, ...] = ()) -> DataFrame:
    """Cells on each edge, both ends included: one step per cell along the longer axis.

    Whole numbers throughout, so every engine finds the same cells. Pieces off the layer are left out before cells are made of them. Narrow: no shuffle.
    """
    i = F.col("i")
    return (
        _line_pieces(edges, meta, carry)
        .withColumn("i", F.explode(F.sequence("first", "last")))
        .select("feature_id", *carry, "whole", _at("c0", "c1", i).alias("gx"), _at("r0", "r1", i).alias("gy"))
        .where(F.col("whole") | inside(meta))
        .drop("whole")
    )


def _crossing_runs(edges: DataFrame, meta: LayerMeta, carry: tuple[str, ...]) -> DataFrame:
    """The cells of :func:`rasterize_polygons` as runs along rows: (feature_id, <carry>, down, at, lo, hi), cells ``lo`` .. ``hi`` of row ``at``."""
    x0, y0, x1, y1 = (F.col(c) for c in ("u0", "v0", "u1", "v1"))
    first = F.greatest(F.lit(0), F.ceil(F.least(y0, y1) - 0.5).cast("int"))
    last = F.least(F.lit(meta.rows - 1), F.ceil(F.greatest(y0, y1) - 0.5).cast("int") - 1)
    band_of = lambda c: F.floor(F.col(c) / float(BAND)).cast("int")
    start = F.greatest(F.col("first"), F.col("band") * BAND)
    stop = F.least(F.col("last"), F.col("band") * BAND + (BAND - 1))
    crossing = x0 + (F.col("gy") + 0.5 - y0) * (x1 - x0) / (y1 - y0)
    toggle = F.least(F.greatest(F.ceil(crossing - 0.5).cast("int"), F.lit(0)), F.lit(meta.cols))
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    banded = (
        edges.select(
            "feature_id",
            *carry,
            ((F.col("x0") - F.lit(meta.xmin)) / F.lit(meta.cell_w)).alias("u0"),
            ((F.lit(meta.ymax) - F.col("y0")) / F.lit(meta.cell_h)).alias("v0"),
            ((F.col("x1") - F.lit(meta.xmin)) / F.lit(meta.cell_w)).alias("u1"),
            ((F.lit(meta.ymax) - F.col("y1")) / F.lit(meta.cell_h)).alias("v1"),
        )
        .withColumn("first", first)
        .withColumn("last", last)
        .where("first <= last")
        .withColumn("band", F.explode(F.sequence(band_of("first"), band_of("last"))))
        .repartition(parts, "feature_id", "band")
    )
    crossings = banded.withColumn("gy", F.explode(F.sequence(start, stop))).select(
        "feature_id", "band", *carry, "gy", toggle.alias("gx")
    )
    keys = ["feature_id", "band", "gy"]
    # the band, constant there, makes both windows ask for one and the same order
    along, same = Window.partitionBy(*keys).orderBy("gx", "band"), Window.partitionBy(*keys, "gx").orderBy("band")
    # the last of equal crossings stands for them if they are odd in number
    odd = (
        crossings.withColumn("nth", F.row_number().over(same))
        .withColumn("next", F.lead("gx").over(along))
        .where("nth % 2 = 1 and (next is null or next <> gx)")
    )
    return (
        odd.withColumn("stop", F.lead("gx").over(along))
        .withColumn("nth", F.row_number().over(along))
        .where("nth % 2 = 1 and stop is not null")
        .select("feature_id", *carry, F.lit(False).alias("down"), F.col("gy").alias("at"), F.col("gx").alias("lo"), (F.col("stop") - 1).alias("hi"))
    )


def rasterize_polygons(edges: DataFrame, meta: LayerMeta, carry: tuple[str, ...] = (), totals: tuple[str, ...] | None = None) -> DataFrame:
    """Cells whose centre lies in a ring by the even-odd rule; ``carry`` is constant per feature.

    Every edge crosses the centre line of some rows; each crossing toggles the fill from one cell
    on. Edges are first cut by bands of rows and shuffled once by (feature, band), which spreads
    a huge polygon over many tasks; the far more numerous crossings are only made after that and put
    in order once, on disk where they are too many. Dropping pairs of equal ones and pairing the odd ones that are left runs along that order, with no table of crossings in memory.

    With ``totals``, whole-number columns among ``feature_id`` and ``carry``, the cells come counted: (gx, gy, n, <totals>), the number of these rows in each cell and the sums of those columns,
    made from runs of cells (:func:`_ring_runs`), so that the work follows the edges and the layer, not the area of the features.
    """
    if totals is not None:
        rings = _rings(edges, meta, carry)
        runs = _ring_runs(rings.where("plain"), meta, carry).unionByName(_crossing_runs(rings.where("not plain"), meta, carry))
        return _run_totals(runs, totals)
    return (
        _crossing_runs(edges, meta, carry)
        .withColumn("gx", F.explode(F.sequence("lo", "hi")))
        .select("feature_id", *carry, "gx", F.col("at").alias("gy"))
    )


def burn(cells: DataFrame, z: str | None = None) -> DataFrame:
    """One value per cell: the one on top.

    Without ``z`` the value is its own z-order, and a plain max stays a hash aggregate with
    map-side combine. With ``z`` the highest z wins, then the larger value: first the largest value of each z in a cell, then
    that of the highest z, both hash aggregates too, where a maximum of pairs would sort all cells.
    """
    if z is None:
        return cells.groupBy("gx", "gy").agg(F.max("value").alias("value"))
    tops = cells.groupBy("gx", "gy", F.col(z).alias("_z")).agg(F.max("value").alias("value"))
    # where no z is known, the larger value
    top = F.when(F.max("_z").isNull(), F.max("value")).otherwise(F.max_by("value", "_z"))
    return tops.groupBy("gx", "gy").agg(top.alias("value"))


def rasterize(features: DataFrame, meta: LayerMeta, carry: tuple[str, ...] = ("value",)) -> DataFrame:
    """Cells of lines and polygons, not yet burnt."""
    lines = rasterize_lines(features.where("kind = 'line'"), meta, carry)
    fills = rasterize_polygons(features.where("kind = 'polygon'"), meta, carry)
    return lines.unionByName(fills)


# ---- runs: cells in a line, burnt without a row for each ------------------------------------------
def _line_runs(lines: DataFrame, meta: LayerMeta, carry: tuple[str, ...]) -> DataFrame:
    """The cells on edges of :func:`_line_cells` as runs (down, at, lo, hi): cells ``lo`` .. ``hi`` of column ``at``, or of row ``at`` where not ``down``.

    Along its longer axis an edge makes one run for each column, or row, that it passes, whatever its length. Whole numbers throughout; runs are cut at the layer.
    """
    pick = lambda a, b: F.when(F.col("down"), a).otherwise(b)
    n, p0, way, q0, dq, j, i0, i1 = (F.col(c) for c in ("n", "p0", "way", "q0", "dq", "j", "i0", "i1"))
    side, across = pick(F.lit(meta.rows), F.lit(meta.cols)), pick(F.lit(meta.cols), F.lit(meta.rows))
    least, most = F.greatest(-q0, F.least(dq, F.lit(0))), F.least(across - 1 - q0, F.greatest(dq, F.lit(0)))
    # steps at which the edge is ``j`` away from where it began
    half = lambda odd: odd * n / F.nullif(2.0 * dq, F.lit(0.0))
    less, more = 2.0 * j - 1, 2.0 * j + 1
    begin = F.when(dq == 0, i0).when(dq > 0, F.ceil(half(less)).cast("int")).otherwise(F.floor(half(more)).cast("int") + 1)
    end = F.when(dq == 0, i1).when(dq > 0, F.ceil(half(more)).cast("int") - 1).otherwise(F.floor(half(less)).cast("int"))
    return (
        lines.withColumn("down", F.abs(F.col("r1") - F.col("r0")) >= F.abs(F.col("c1") - F.col("c0")))
        .select(
            *carry, "down", "n",
            pick(F.col("r0"), F.col("c0")).alias("p0"),
            F.signum(pick(F.col("r1") - F.col("r0"), F.col("c1") - F.col("c0"))).cast("int").alias("way"),
            pick(F.col("c0"), F.col("r0")).alias("q0"),
            pick(F.col("c1") - F.col("c0"), F.col("r1") - F.col("r0")).alias("dq"),
        )
        .withColumn("j", F.explode(F.when(least <= most, F.sequence(least, most))))
        .withColumn("i0", F.greatest(F.lit(0), F.when(way < 0, p0 - side + 1).otherwise(-p0)))
        .withColumn("i1", F.least(n, F.when(way < 0, p0).otherwise(side - 1 - p0)))
        .withColumn("begin", F.greatest(begin, i0))
        .withColumn("end", F.least(end, i1))
        .where("begin <= end")
        .select(
            *carry, "down", (q0 + j).alias("at"),
            F.least(p0 + way * F.col("begin"), p0 + way * F.col("end")).alias("lo"),
            F.greatest(p0 + way * F.col("begin"), p0 + way * F.col("end")).alias("hi"),
        )
    )


def _run_cells(runs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Cells (<carry>, gx, gy) under any run, each once for the same carried values.

    A run counts up where it begins and down behind its end; these counts add up in a hash aggregate with map-side combine, and along a column, or row, cells lie under a run where
    the sum so far is above 0. So what is shuffled is bounded by the layer, and runs that lie on one another are not taken apart.
    """
    ends = F.array(F.struct(F.col("lo").alias("pos"), F.lit(1).alias("d")), F.struct((F.col("hi") + 1).alias("pos"), F.lit(-1).alias("d")))
    line = [*carry, "down", "at"]
    counts = runs.select(*line, F.explode(ends).alias("e")).groupBy(*line, "e.pos").agg(F.sum("e.d").alias("d")).where("d <> 0")
    along = Window.partitionBy(*line).orderBy("pos")
    under = counts.withColumn("open", F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0))).withColumn("stop", F.lead("pos").over(along)).where("open > 0")
    first = F.col("pos") + F.col("piece") * STEPS
    place = F.explode(F.sequence(first, F.least(first + (STEPS - 1), F.col("stop") - 1)))
    cells = under.withColumn("piece", F.explode(_steps(F.col("stop") - 1 - F.col("pos")))).select(*line, place.alias("p"))
    pick = lambda a, b: F.when(F.col("down"), F.col(a)).otherwise(F.col(b))
    return cells.select(*carry, pick("at", "p").alias("gx"), pick("p", "at").alias("gy"))


def _run_totals(runs: DataFrame, totals: tuple[str, ...]) -> DataFrame:
    """Cells (gx, gy, n, <totals>) under any run: how many runs lie there, and the sums of the columns ``totals`` over them.

    As in :func:`_run_cells` what is shuffled is bounded by the layer: numbers and sums of runs go up where a run begins and down behind its end. A sum over nothing but unknown values is unknown.
    """
    sign = F.col("e.d")
    counts = {"n": sign} | {f"_n_{c}": F.when(F.col(c).isNotNull(), sign).otherwise(0) for c in totals} | {f"_s_{c}": F.coalesce(F.col(c) * sign, F.lit(0)) for c in totals}
    ends = F.array(F.struct(F.col("lo").alias("pos"), F.lit(1).alias("d")), F.struct((F.col("hi") + 1).alias("pos"), F.lit(-1).alias("d")))
    kept = runs.select(*totals, "down", "at", F.explode(ends).alias("e"))
    steps = kept.groupBy("down", "at", "e.pos").agg(*(F.sum(v).alias(k) for k, v in counts.items()))
    along = Window.partitionBy("down", "at").orderBy("pos")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    under = steps.select("down", "at", "pos", *(F.sum(k).over(so_far).alias(k) for k in counts), F.lead("pos").over(along).alias("stop")).where("n > 0")
    first = F.col("pos") + F.col("piece") * STEPS
    place = F.explode(F.sequence(first, F.least(first + (STEPS - 1), F.col("stop") - 1)))
    cells = under.withColumn("piece", F.explode(_steps(F.col("stop") - 1 - F.col("pos")))).select("down", "at", *counts, place.alias("p"))
    pick = lambda a, b: F.when(F.col("down"), F.col(a)).otherwise(F.col(b))
    cells = cells.select(pick("at", "p").alias("gx"), pick("p", "at").alias("gy"), *counts)
    total = [F.when(F.sum(f"_n_{c}") > 0, F.sum(f"_s_{c}")).alias(c) for c in totals]
    return cells.groupBy("gx", "gy").agg(F.sum("n").alias("n"), *total)


def line_cover(edges: DataFrame, meta: LayerMeta, carry: tuple[str, ...] = ()) -> DataFrame:
    """Cells (<carry>, gx, gy) of :func:`rasterize_lines` for aggregates that do not count, such as a maximum.

    Edges of fewer than ``STEPS`` steps give a row for each cell; longer ones are put together as runs, so that the work does not follow their length.
    """
    lines = _line_cells(edges, meta, carry)
    i = F.col("i")
    short = lines.where(F.col("n") < STEPS).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n"))))
    short = short.select(*carry, _at("c0", "c1", i).alias("gx"), _at("r0", "r1", i).alias("gy")).where(inside(meta))
    return short.unionByName(_run_cells(_line_runs(lines.where(F.col("n") >= STEPS), meta, carry), carry))


def _rings(edges: DataFrame, meta: LayerMeta, carry: tuple[str, ...]) -> DataFrame:
    """Edges of polygons in cell units, and whether their feature is ``plain``: one closed chain of edges in the order of ``seq`` with one set of carried values, whose columns are told exactly by :func:`_ring_runs`. A ``tall`` feature passes no more columns of the layer than rows."""
    chain, whole = Window.partitionBy("feature_id").orderBy("seq"), Window.partitionBy("feature_id")
    start = F.struct("x0", "y0")
    follows = F.coalesce(F.lead(start).over(chain), F.first(start).over(chain))
    later = F.coalesce(F.lead("seq").over(chain) > F.col("seq"), F.col("seq").isNotNull())
    fits = F.coalesce((follows["x0"] == F.col("x1")) & (follows["y0"] == F.col("y1")), F.lit(False)) & later
    u0, v0, u1, v1 = (F.col(c) for c in ("u0", "v0", "u1", "v1"))
    # the row at which an edge passes a column is found within half a row
    size = F.abs(u0) + F.abs(u1) + F.lit(float(meta.cols))
    spread = F.abs(v1 - v0) * size / F.nullif(F.abs(u1 - u0), F.lit(0.0)) + F.abs(v0) + F.abs(v1)
    exact = F.coalesce(spread * 2.0**-46 < 0.5, F.lit(True))  # an edge down a column passes none
    kept = F.struct(*carry) if carry else F.lit(0)
    passed = lambda a, b, n: F.sum(F.abs(F.least(F.greatest(b, F.lit(0.0)), F.lit(float(n))) - F.least(F.greatest(a, F.lit(0.0)), F.lit(float(n))))).over(whole)
    return (
        edges.withColumn("fits", fits)
        .select(
            "feature_id",
            *carry,
            "seq", "x0", "y0", "x1", "y1", "fits",
            ((F.col("x0") - F.lit(meta.xmin)) / F.lit(meta.cell_w)).alias("u0"),
            ((F.lit(meta.ymax) - F.col("y0")) / F.lit(meta.cell_h)).alias("v0"),
            ((F.col("x1") - F.lit(meta.xmin)) / F.lit(meta.cell_w)).alias("u1"),
            ((F.lit(meta.ymax) - F.col("y1")) / F.lit(meta.cell_h)).alias("v1"),
        )
        .withColumn("fits", F.col("fits") & exact)
        .withColumn("plain", F.min("fits").over(whole) & F.min(kept).over(whole).eqNullSafe(F.max(kept).over(whole)))
        .withColumn("tall", passed(u0, u1, meta.cols) <= passed(v0, v1, meta.rows))
    )


def _ring_runs(rings: DataFrame, meta: LayerMeta, carry: tuple[str, ...]) -> DataFrame:
    """The cells of :func:`rasterize_polygons` for plain features of :func:`_rings`, as runs: down columns for tall features, else along rows.

    An edge toggles, in each row it crosses, the fill from one cell on. That cell moves one way along the edge, so in a column the toggled rows are one stretch: it begins or ends where the
    edge passes the column, found by solving for the row and settled by the crossing itself in the rows around; its other end is an end of the edge, and there the next edge that crosses rows begins, so that
    both cancel but for the columns between them. The rows are as many as the columns, or rows, that edges pass, whichever are fewer.
    """
    u0, v0, u1, v1 = (F.col(c) for c in ("u0", "v0", "u1", "v1"))
    row_at = lambda v: F.least(F.greatest(F.ceil(v - 0.5), F.lit(0)), F.lit(meta.rows)).cast("int")

    def toggle(gy: Column) -> Column:
        crossing = u0 + (gy + 0.5 - v0) * (u1 - u0) / F.nullif(v1 - v0, F.lit(0.0))
        return F.least(F.greatest(F.ceil(crossing - 0.5), F.lit(0)), F.lit(meta.cols)).cast("int")

    first, stop, t0, t1, at = (F.col(c) for c in ("first", "stop", "t0", "t1", "at"))
    chain, onward = Window.partitionBy("feature_id").orderBy("seq"), v0 < v1
    leaves = F.when(onward, t0).otherwise(t1)
    crossed = (
        rings.select("feature_id", *carry, "seq", "tall", "u0", "v0", "u1", "v1", row_at(F.least(v0, v1)).alias("first"), row_at(F.greatest(v0, v1)).alias("stop"))
        .where("first < stop")
        .withColumn("t0", toggle(first))
        .withColumn("t1", toggle(stop - 1))
        .withColumn("arrives", F.when(onward, t1).otherwise(t0))
        .withColumn("tip", F.when(onward, stop).otherwise(first))
        .withColumn("leaves", F.coalesce(F.lead(leaves).over(chain), F.first(leaves).over(chain)))
    )
    # where an edge passes a column
    passed = lambda gy: (toggle(gy) > at) == (t1 > t0)
    guess = F.floor(v0 + (at + 0.5 - u0) * (v1 - v0) / F.nullif(u1 - u0, F.lit(0.0)) - 0.5)
    e = F.col("e")
    settled = F.when(passed(e - 1), e - 1).when(passed(e), e).when(passed(e + 1), e + 1).otherwise(e + 2)
    stretch = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    down = F.array(stretch("bend", t0, t1), stretch("tip", F.col("arrives"), F.col("leaves")))
    parts = int(rings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = Window.partitionBy("feature_id", "at").orderBy("pos")
    return (
        crossed.withColumn("k", F.explode(F.when(F.col("tall"), down).otherwise(F.array(stretch("row", first, stop)))))
        .where("k.lo < k.hi")
        .withColumn("at", F.explode(F.sequence("k.lo", F.col("k.hi") - 1)))
        .withColumn("e", F.when(F.col("k.kind") == "bend", F.least(F.greatest(guess, first), stop).cast("int")))
        .withColumn("bend", F.least(F.greatest(settled, first), stop - 1))
        .select("feature_id", *carry, "tall", "at", F.when(F.col("k.kind") == "bend", F.col("bend")).when(F.col("k.kind") == "tip", F.col("tip")).otherwise(toggle(at)).alias("pos"))
        .repartition(parts, "feature_id", "at")
        .withColumn("nth", F.row_number().over(line))
        .withColumn("until", F.lead("pos").over(line))
        .where("nth % 2 = 1 and pos < until")
        .select("feature_id", *carry, F.col("tall").alias("down"), "at", F.col("pos").alias("lo"), (F.col("until") - 1).alias("hi"))
    )


def polygon_cover(edges: DataFrame, meta: LayerMeta, carry: tuple[str, ...] = ()) -> DataFrame:
    """Cells (<carry>, gx, gy) of :func:`rasterize_polygons` for aggregates that do not count, such as a maximum. Features that are no closed chain of edges go through that operator itself."""
    rings = _rings(edges, meta, carry)
    fills = _run_cells(_ring_runs(rings.where("plain"), meta, carry), carry)
    return fills.unionByName(rasterize_polygons(rings.where("not plain"), meta, carry).drop("feature_id"))


def cover(features: DataFrame, meta: LayerMeta, carry: tuple[str, ...] = ("value",), lines_only: bool = False) -> DataFrame:
    """Cells (<carry>, gx, gy) of lines and polygons, not yet burnt, where no cell needs to be counted."""
    if lines_only:
        return line_cover(features, meta, carry)
    lines = line_cover(features.where("kind = 'line'"), meta, carry)
    return lines.unionByName(polygon_cover(features.where("kind = 'polygon'"), meta, carry))


def rasterize_features(
    features: DataFrame,
    meta: LayerMeta,
    cell_type: str = "float64",
    num_partitions: int | None = None,
    overflow: str = "wrap",
    lines_only: bool = False,
) -> DataFrame:
    """Burnt layer of features whose value is its own z-order, in a cell type.

    ``num_partitions`` puts whole tiles on that many partitions, at the price of a shuffle.
    """
    layer = cast_cells(burn(cover(features, meta, lines_only=lines_only)), cell_type, overflow)
    if num_partitions:
        layer = partition_tiles(tile_keys(layer, meta), num_partitions).select("gx", "gy", "value")
    return layer


# ---- cell types ------------------------------------------------------------------------------
def with_nodata(cells: DataFrame, nodata: float = 0) -> DataFrame:
    """Read one value as NODATA."""
    return cells.withColumn("value", F.nullif("value", F.lit(nodata)))


_INTEGERS = {"int8": ("tinyint", 8), "int16": ("smallint", 16), "int32": ("int", 32)}
_FLOATS = {"float32": "float", "float64": "double"}


def cast_value(value, cell_type: str, overflow: str = "wrap") -> Column:
    """A value in a cell type. Whole-number types truncate toward zero first.

    What does not fit wraps round, sticks to the nearest bound or turns NODATA.
    """
    v = _c(value)
    if cell_type in _FLOATS:
        return v.cast(_FLOATS[cell_type])
    sql_type, bits = _INTEGERS[cell_type]
    half = 2 ** (bits - 1)
    whole = F.when(v < 0, F.ceil(v)).otherwise(F.floor(v)).cast("long")
    if overflow == "wrap":
        whole = F.pmod(whole + half, F.lit(2 * half)) - half
    elif overflow == "saturate":
        bound = F.least(F.greatest(whole, F.lit(-half)), F.lit(half - 1))
        whole = F.when(whole.isNotNull(), bound)  # greatest() would turn NODATA into the bound
    elif overflow == "null":
        whole = F.when(whole.between(-half, half - 1), whole)
    else:
        raise ValueError(f"unknown overflow mode {overflow!r}")
    return whole.cast(sql_type)


def cast_cells(cells: DataFrame, cell_type: str = "int8", overflow: str = "wrap") -> DataFrame:
    return cells.withColumn("value", cast_value("value", cell_type, overflow))


def convert(
    cells: DataFrame, cell_type: str, nodata: float | None = None, overflow: str = "wrap"
) -> DataFrame:
    """Change the cell type, then read one value as NODATA."""
    out = cast_cells(cells, cell_type, overflow)
    if nodata is None:
        return out
    mark = F.lit(nodata).cast(out.schema["value"].dataType)
    return out.withColumn("value", F.nullif("value", mark))


def float_cells(cells: DataFrame) -> DataFrame:
    """Float cells in which NaN means NODATA."""
    v = F.col("value").cast("float")
    return cells.withColumn("value", F.when(~F.isnan(v), v))


def band(cells: DataFrame, index: int = 0) -> DataFrame:
    """One band of a multiband layer."""
    return cells.where(F.col("band") == index).drop("band")
