"""Nearest neighbours by inner product through cross-polytope hashing.

**Index.** A table turns a vector by three rounds of random signs and a fast Hadamard transform and assigns it to the nearest signed axis; where that gives too few cells for the number of vectors, further turns are
joined to it, the last over fewer axes, so that a cell holds about ``per_cell`` vectors at every size. Cells follow the direction of a vector; its length counts in the ranking.

**Probes.** A query visits, in each table, its own cell and those that come next when the distances to the axes are added up. How many is measured, not guessed: for a bounded sample of ``tune`` queries the true
neighbours are found by comparing with all vectors, and the fewest probes are taken that find the share ``recall`` of them. Vectors without structure need many probes, up to all cells, which is exact search.

**Ranking.** Equal vectors are one entry with its least ids, found in a window that is limited before the shuffle, so a vector of which there are very many copies costs no more than another. Entries and probes of a cell meet in blocks of bounded size,
dealt by hash; products are taken for whole blocks and those near the limit are taken again one by one, always in the same order, so equal vectors tie exactly. A block returns the best of each query, and these are
merged by query. Queries whose cells hold too few vectors are compared with all of them, in the same blocks.

Edge cases: vectors that are null, all zero, empty, or hold null or non-finite components take no part, nor do rows without id; a shorter vector counts as filled up with zeros; rows of one id are one row, with
the last of its vectors in the order of their bytes if they differ; ties go to the smaller id; with fewer candidates all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paceway.runtime import workspace, written


def shape(n: int, dim: int, per_cell: int) -> list[int]:
    """Axes of each turn of a table: ``2 * axes`` cells for each, about ``n / per_cell`` in all."""
    wanted, parts = max(2.0, n / per_cell), []
    while wanted >= 4 * dim:
        parts.append(dim)
        wanted /= 2 * dim
    return [*parts, min(dim, 1 << max(0, int(math.log2(wanted)) - 1))]


def _turner(dim: int, tables: int, parts: list[int], seed: int):
    """``(cells, probes)`` of vectors given as rows of a matrix, made here so that they travel to the workers by value.

    ``cells`` gives one cell per row and table; ``probes`` the ``m`` cells to visit, nearest first.
    """

    def turned(x, table, part):
        """The vectors' places along the signed axes."""
        import numpy as np

        signs = np.random.default_rng([seed, table, part]).choice([-1.0, 1.0], (3, dim))
        for round_of in signs:
            x = x * round_of
            h = 1
            while h < dim:
                x = x.reshape(len(x), -1, 2, h)
                x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], 2).reshape(-1, dim)
                h *= 2
            x = x / np.sqrt(dim)
        x = x[:, : parts[part]]
        return np.concatenate([x, -x], 1)

    def unit(x):
        import numpy as np

        x = x / np.abs(x).max(1, keepdims=True)  # squares of very large or small numbers would not be finite
        return x / np.sqrt((x * x).sum(1, keepdims=True))

    def cells(x):
        import numpy as np

        x, out = unit(x), np.zeros((len(x), tables), np.int64)
        for t in range(tables):
            for p in range(len(parts)):
                out[:, t] = out[:, t] * 2 * parts[p] + turned(x, t, p).argmax(1)
        return out

    def probes(x, m):
        import numpy as np

        x, out = unit(x), []
        for t in range(tables):
            cell, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
            for p in range(len(parts)):
                along = turned(x, t, p)
                order = np.argsort(-along, 1, kind="stable")[:, :m]
                far = along.max(1, keepdims=True) - np.take_along_axis(along, order, 1)
                # Of the m best, the i-th of one and the j-th of the other can only be if i * j <= m.
                i, j = np.nonzero(np.outer(np.arange(1, cost.shape[1] + 1), np.arange(1, order.shape[1] + 1)) <= m)
                both, at = cost[:, i] + far[:, j] ** 2, cell[:, i] * 2 * parts[p] + order[:, j]
                best = np.argsort(both, 1, kind="stable")[:, :m]
                cost, cell = np.take_along_axis(both, best, 1), np.take_along_axis(at, best, 1)
            out.append(cell)
        return np.stack(out, 1)

    return cells, probes


def _pack(width: int):
    """Batch function: lists of numbers to the bytes of doubles, filled up to ``width``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            x = np.zeros((len(sizes), width))
            x[np.arange(width) < sizes[:, None]] = flat + 0.0  # no negative zeros
            vectors = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors], names=["id", "v"])

    return run


def _unpack(width: int):
    def matrix(column):
        import numpy as np

        return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)

    return matrix


def _best(top: int):
    """Function: the ``top`` entries with the largest products for each query, exact and with ties in order: ``(query, entry, score)``."""

    def best(queries, entries, names):
        """``names`` settles ties of equal scores."""
        import numpy as np

        rough = queries @ entries.T
        if len(entries) > top:
            slack = 1e-12 * np.abs(queries).max() * np.abs(entries).max() * queries.shape[1]
            least = np.partition(rough, len(entries) - top, 1)[:, len(entries) - top, None] - slack
            q, e = np.nonzero(rough >= least)
        else:
            q, e = np.indices(rough.shape).reshape(2, -1)
        score = np.concatenate([(queries[q[i : i + 65536]] * entries[e[i : i + 65536]]).sum(1) for i in range(0, len(q), 65536)] or [np.zeros(0)])
        order = np.lexsort((names[e], -score, q))
        q, e, score = q[order], e[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        return q[place < top], e[place < top], score[place < top]

    return best


def _measured_probes(entries: DataFrame, asked: DataFrame, turner, matrix, tune: int, top: int, recall: float, most: int) -> int:
    """Fewest probes that find the share ``recall`` of the true neighbours of a sample of the queries."""
    import numpy as np

    cells, probes = turner
    chosen = asked.orderBy(F.xxhash64("v"), "v").limit(tune).collect()  # at most ``tune`` vectors
    if not chosen:
        return 1
    sample = np.stack([np.frombuffer(r["v"], np.float64) for r in chosen])
    best = _best(top + 1)  # a query's own vector is among the entries

    def run(batches):
        import pyarrow as pa

        kept = None
        for batch in batches:
            x, names = matrix(batch.column(0)), batch.column(1).to_numpy()
            if kept is not None:
                x, names = np.concatenate([kept[0], x]), np.concatenate([kept[1], names])
            q, e, score = best(sample, x, names)
            alive = np.unique(e)
            kept = x[alive], names[alive], q, np.searchsorted(alive, e), score
        if kept is not None:
            x, names, q, e, score = kept
            where = cells(x)[e]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(score), pa.array(names[e], pa.int64()), pa.array(list(where), pa.list_(pa.int64()))], names=["s", "score", "name", "cells"]
            )

    near = entries.select("v", F.col("ids")[0].alias("name")).mapInArrow(run, "s long, score double, name long, cells array<long>")
    place = F.row_number().over(Window.partitionBy("s").orderBy(F.desc("score"), "name"))
    near = near.withColumn("place", place).where(F.col("place") <= top + 1).collect()  # at most tune * (top + 1) rows
    who, where = np.array([r["s"] for r in near]), np.array([r["cells"] for r in near])

    def share(m):
        return (probes(sample, m)[who] == where[:, :, None]).any((1, 2)).mean()

    high = 1
    while high < most and share(high) < recall:
        high *= 2
    low, high = high // 2, min(high, most)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if share(mid) >= recall else (mid, high)
    return high


def nearest(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    top: int = 20,
    tables: int = 8,
    recall: float = 0.95,
    tune: int = 100,
    per_cell: int = 256,
    block: int = 1024,
    seed: int = 1,
) -> DataFrame:
    """``query_id, rank, id, score``: the ``top`` rows found nearest to each row of which ``is_query``, a condition on the column ``id``, holds."""
    spark = rows.sparkSession
    good = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where("id is not null and v is not null")
    good = good.where("not exists(v, c -> c is null or isnan(c) or abs(c) = double('infinity')) and exists(v, c -> c <> 0)")
    longest = good.agg(F.max(F.size("v"))).first()[0]
    width = 1 << max(0, (longest or 1) - 1).bit_length()
    matrix, best = _unpack(width), _best(top + 1)
    result = "query_id long, rank int, id long, score double"
    if longest is None:
        return spark.createDataFrame([], result)
    with workspace(spark, "neighbours") as keep:
        base = keep(good.mapInArrow(_pack(width), "id long, v binary").groupBy("id").agg(F.max("v").alias("v")), "base")
        place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
        least = base.withColumn("place", place).where(F.col("place") <= top + 1)
        entries = keep(least.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
        asked = keep(base.where(is_query).select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "asked")
        n = entries.count()
        parts = shape(n, width, per_cell)
        turner = cells, probes = _turner(width, tables, parts, seed)
        m = _measured_probes(entries, asked, turner, matrix, tune, top, recall, math.prod(2 * p for p in parts))

        def place_entries(batches):
            """Cells of entries, counted (for the sizes of cells)."""
            import numpy as np
            import pyarrow as pa

            found = {}
            for batch in batches:
                where = cells(matrix(batch.column(0)))
                for t in range(tables):
                    for c, k in zip(*(a.tolist() for a in np.unique(where[:, t], return_counts=True)), strict=True):
                        found[t, c] = found.get((t, c), 0) + k
            t, c = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(c, pa.int64()), pa.array(list(found.values()), pa.int64())], names=["t", "cell", "k"])

        def deal_entries(batches):
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                where, each = cells(matrix(batch.column(0))), pa.array(np.repeat(np.arange(batch.num_rows), tables))
                t = pa.array(np.tile(np.arange(tables, dtype=np.int32), batch.num_rows))
                yield pa.RecordBatch.from_arrays([t, pa.array(where.reshape(-1)), batch.column(0).take(each), batch.column(1).take(each)], names=["t", "cell", "v", "ids"])

        def deal_probes(batches):
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    some = batch.slice(i, 256)
                    to = probes(matrix(some.column(0)), m)
                    per = to.shape[1] * to.shape[2]
                    t = np.tile(np.repeat(np.arange(tables, dtype=np.int32), to.shape[2]), some.num_rows)
                    each = pa.array(np.repeat(np.arange(some.num_rows), per))
                    yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(to.reshape(-1)), some.column(0).take(each), some.column(1).take(each)], names=["t", "cell", "v", "q"])

        def rank(left, right):
            import numpy as np
            import pyarrow as pa

            x, y = matrix(right.column("v")), matrix(left.column("v"))
            ids = left.column("ids").combine_chunks()
            first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
            q, e, score = best(x, y, first)
            return pa.table({"q": right.column("q").take(pa.array(q)), "score": pa.array(np.ascontiguousarray(score)), "ids": ids.take(pa.array(e))})

        def ranked(index, visits, sizes):
            """Best entries of each block; blocks of a cell are dealt by hash."""
            keys = ["t", "cell", "i", "j"]
            index = index.join(sizes, ["t", "cell"]).withColumns({"i": F.expr("pmod(xxhash64(v), blocks)"), "j": F.explode(F.expr("sequence(0L, query_blocks - 1)"))}).select(*keys, "v", "ids")
            visits = visits.join(sizes, ["t", "cell"]).withColumns({"j": F.expr("pmod(xxhash64(q), query_blocks)"), "i": F.explode(F.expr("sequence(0L, blocks - 1)"))}).select(*keys, "v", "q")
            return index.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(rank, "q long, score double, ids array<long>")

        def merged(hits):
            """The first ``top + 1`` ids of each query, as a sorted list."""
            place = F.dense_rank().over(Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0]))
            one = hits.withColumn("place", place).where(F.col("place") <= top + 1).select("q", (-F.col("score")).alias("less"), F.explode("ids").alias("id"))
            return one.groupBy("q").agg(F.slice(F.array_sort(F.collect_set(F.struct("less", "id"))), 1, top + 1).alias("found"))

        def in_blocks(rows_per_cell, visits_per_cell):
            counted = rows_per_cell.groupBy("t", "cell").agg(F.sum("k").alias("k"))
            visited = visits_per_cell.groupBy("t", "cell").agg(F.count("*").alias("visits"))
            return counted.join(visited, ["t", "cell"]).select("t", "cell", F.expr(f"int(ceil(k / {block})) as blocks"), F.expr(f"int(ceil(visits / {block})) as query_blocks"))

        visits = keep(asked.select("v", "q").mapInArrow(deal_probes, "t int, cell long, v binary, q long"), "visits")
        sizes = keep(in_blocks(entries.select("v").mapInArrow(place_entries, "t int, cell long, k long"), visits), "sizes")
        index = entries.mapInArrow(deal_entries, "t int, cell long, v binary, ids array<long>")
        found = keep(merged(ranked(index, visits, sizes)), "found")

        # Too few in the cells: all entries are one cell.
        ids = base.count()
        full = asked.join(found.where(F.size("found") >= min(top + 1, ids)), "q", "left_anti")
        everywhere = lambda df: df.select(F.lit(0).alias("t"), F.lit(0).cast("long").alias("cell"), *df.columns)
        rest = keep(everywhere(full.select("v", "q")), "rest")
        if not rest.isEmpty():
            one = everywhere(entries)
            found = found.join(rest, "q", "left_anti").unionByName(merged(ranked(one, rest, in_blocks(one.select("t", "cell", F.lit(1).alias("k")), rest))))

        lists = asked.join(found, "q").select("v", "found")
        out = base.where(is_query).join(lists, "v").select(F.col("id").alias("query_id"), F.expr(f"slice(filter(found, f -> f.id <> id), 1, {top})").alias("found"))
        out = out.select("query_id", F.posexplode("found").alias("rank", "f")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("f.id").alias("id"), (-F.col("f.less")).alias("score"))
        return written(out, "nearest")
