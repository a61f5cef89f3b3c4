"""Whitening of embeddings from exact integer statistics.

Entries become whole numbers ``floor(scale * c) + shift``; the fit list holds each different vector of them once. **Bit-sliced scatter:** within a block of rows every dimension, less its minimum, is cut into bit planes, and each
plane is packed across the rows into 64-bit words. The cross-product of two dimensions is then the sum over pairs of planes of ``2**(a + b)`` times the number of ones in their AND. Tasks add up such counts as limbs of
16 bits, Spark adds the limbs, and the driver sees one number per pair of dimensions and limb, however many rows there are. The scatter is centred in whole numbers, ``n * C - S * S'``, before
it is divided once and handed to the eigensolver, so nothing is lost by subtracting large numbers.

A second pass gives the covariance of the whitened fit list, centred on its own mean, and its distance from the identity; the last projects all rows.

Edge cases: a vector that is null or holds null or non-finite entries is dropped, as is one whose length is not the commonest (ties: the longer), which no common covariance can hold; repeated rows are each returned and count
once in the fit list; a component without variance has a null ``whitened`` and no part in ``identity_error``; a ``deviation`` beyond a long is null; a null id is kept; empty vectors and an empty
table give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceway.runtime import written

#: Bits of a limb: a task's sums of 2**15 times counts stay far below 2**63.
LIMB = 16


def _matrix():
    """The function that reads a list column as a matrix, made here so that it travels to the workers by value."""

    def matrix(column, width):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)

    return matrix


def whole(rows: DataFrame, vector_col: str, scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """``rows`` of usable vectors with ``x``, the vector as whole numbers, in place of the vector."""
    bad = F.expr("exists(v, c -> c is null or isnan(c) or abs(c) = double('infinity'))")
    good = rows.withColumn("v", F.col(f"`{vector_col}`").cast("array<double>")).where("v is not null").where(~bad)
    return good.withColumn("x", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c) + F.lit(shift).cast("long"))).drop("v", *([vector_col] if vector_col != "x" else []))


def scatter(fit: DataFrame, low: list[int], high: list[int], block: int = 4096):
    """``(sums, products)`` of ``x - low`` over the rows of ``fit``, exact: a list and a dict ``{(i, j): total}``, i <= j."""
    matrix, dim = _matrix(), len(low)
    widths = [int(h - l).bit_length() for l, h in zip(low, high, strict=True)]  # noqa: E741
    limb = LIMB

    def count(batches):
        import numpy as np
        import pyarrow as pa

        base = np.array(low, np.int64)
        dims = np.repeat(np.arange(dim), widths)
        bits = np.concatenate([np.arange(w) for w in widths] or [np.zeros(0, int)]).astype(np.int64)
        n_limbs = (2 * max(widths, default=0)) // limb + 1
        products, sums = np.zeros((n_limbs, dim, dim), np.int64), np.zeros((n_limbs, dim), np.int64)

        def add(rows):
            values = (rows - base).view(np.uint64).T  # the difference is below 2**64 even where its sign bit is set
            ones = ((values[dims] >> bits[:, None].astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(ones, axis=1)
            planes = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)
            own = np.bitwise_count(planes).sum(1, dtype=np.int64)
            np.add.at(sums, (bits // limb, dims), own << (bits % limb))
            for p in range(len(dims)):
                both = np.bitwise_count(planes[p] & planes[p:]).sum(1, dtype=np.int64)
                both[1:][dims[p + 1 :] == dims[p]] *= 2  # (a, b) and (b, a) of one dimension
                weight = bits[p] + bits[p:]
                np.add.at(products, (weight // limb, dims[p], dims[p:]), both << (weight % limb))

        rest = np.zeros((0, dim), np.int64)
        for batch in batches:
            rest = np.concatenate([rest, matrix(batch.column(0), dim)])
            while len(rest) >= block:
                add(rest[:block])
                rest = rest[block:]
        if len(rest):
            add(rest)
        at, i, j = np.nonzero(products)
        to, k = np.nonzero(sums)
        columns = [np.concatenate([i, k]), np.concatenate([j, np.full(len(k), -1)]), np.concatenate([at, to]), np.concatenate([products[at, i, j], sums[to, k]])]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["i", "j", "limb", "total"])

    rows = fit.select("x").mapInArrow(count, "i long, j long, limb long, total long").groupBy("i", "j", "limb").agg(F.sum("total").alias("total"))
    sums, products = [0] * dim, {}
    for r in rows.collect():  # at most a number for each pair of dimensions and limb
        value = r["total"] << (limb * r["limb"])
        if r["j"] < 0:
            sums[r["i"]] += value
        else:
            products[r["i"], r["j"]] = products.get((r["i"], r["j"]), 0) + value
    return sums, products


def fit_model(fit: DataFrame, components: int = 16) -> dict | None:
    """Means, eigenvectors and eigenvalues of the fit list's vectors ``x``; None where there are none."""
    import numpy as np

    bounds = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n")).orderBy("i").collect()
    if not bounds:
        return None
    low, high, n = [r["low"] for r in bounds], [r["high"] for r in bounds], bounds[0]["n"]
    part, products = scatter(fit, low, high)
    dim = len(low)
    centred = [[0] * dim for _ in range(dim)]
    for i in range(dim):
        for j in range(i, dim):
            centred[i][j] = centred[j][i] = n * products.get((i, j), 0) - part[i] * part[j]
    # Whole numbers up to here; one correctly rounded division.
    covariance = np.array([[c / (n * n) for c in row] for row in centred])
    trace = sum(centred[i][i] for i in range(dim)) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(order))] < 0, -1.0, 1.0)
    live = values > max(values.max(initial=0.0), 0.0) * dim * np.finfo(float).eps
    return {
        "n": n,
        "sums": [s + n * b for s, b in zip(part, low, strict=True)],
        "reach": max(max(abs(n * (e - b) - s) for e in (lo, hi)) for s, b, lo, hi in zip(part, low, low, high, strict=True)),
        "low": low,
        "part": part,
        "vectors": vectors,
        "roots": np.sqrt(values),
        "live": live,
        "explained": values / trace if trace else np.zeros(len(values)),
    }


def _projector(model: dict):
    """Function: rows of ``x`` to ``(n * x - S, whitened)``; the first as int64 or, beyond that, as Python's numbers."""
    n, low, part, reach, live = model["n"], model["low"], model["part"], model["reach"], model["live"]
    vectors, scale = model["vectors"], [1 / r if ok else float("nan") for r, ok in zip(model["roots"], model["live"], strict=True)]

    def project(x):
        import numpy as np

        kind = np.int64 if reach < 2**62 else object
        apart = (x.astype(object) - np.array(low, object) if kind is object else x - np.array(low, np.int64)) * n - np.array(part, kind)
        with np.errstate(invalid="ignore"):
            return apart, (apart / n).astype(float) @ vectors * scale

    return project, live


def identity_error(fit: DataFrame, model: dict) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity, over components with variance."""
    import numpy as np

    project, live = _projector(model)
    matrix, dim, n, k = _matrix(), len(model["low"]), model["n"], int(live.sum())
    if not k:
        return 0.0

    def total(of):
        def run(batches):
            import pyarrow as pa

            out = 0
            for batch in batches:
                out = out + of(project(matrix(batch.column(0), dim))[1][:, live])
            if not np.isscalar(out):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.reshape(-1))], names=["i", "total"])

        rows = fit.select("x").mapInArrow(run, "i long, total double").groupBy("i").agg(F.sum("total").alias("total")).collect()
        return np.array([r["total"] for r in sorted(rows, key=lambda r: r["i"])]) / n  # at most components squared

    mean = total(lambda w: w.sum(0))
    covariance = total(lambda w: (w - mean).T @ (w - mean)).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """One row per usable input row and component: ``id, component, n, deviation, whitened, explained, identity_error``."""
    spark = rows.sparkSession
    id_type = rows.schema[id_col].dataType
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField("id", id_type), *(T.StructField(a, b) for a, b in zip(names, kinds, strict=True))])
    x = whole(rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector")), "vector", scale, shift)
    usual = x.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    x = x.where(F.size("x") == (usual["size"] if usual else 0))
    fit = written(x.select("x").distinct(), "fit")
    model = fit_model(fit, components)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(fit, model)
    project, _ = _projector(model)
    matrix, dim, n, explained = _matrix(), len(model["low"]), model["n"], model["explained"]
    exact = dim * model["reach"] ** 2 < 2**63

    def run(batches):
        import numpy as np
        import pyarrow as pa

        k = len(explained)
        for batch in batches:
            apart, white = project(matrix(batch.column(1), dim))
            if exact:
                deviation = pa.array((apart * apart).sum(1))
            else:
                deviation = pa.array([d if d < 2**63 else None for d in (apart.astype(object) ** 2).sum(1).tolist()], pa.int64())
            m = batch.num_rows
            each = pa.array(np.repeat(np.arange(m), k))
            columns = [
                batch.column(0).take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)),
                deviation.take(each),
                pa.array(white.reshape(-1), from_pandas=True),  # NaN becomes null
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *names])

    return x.select("id", "x").mapInArrow(run, schema)
