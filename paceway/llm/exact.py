"""Exact duplicates through an extendible-hash index kept in shared files.

The key of a text is the leading ``bits`` bits of a 64-bit hash of the normalised text, so a bucket is a range of keys. A directory of ``2**depth`` cells points to buckets: while a cell holds more than
``capacity`` keys the directory doubles, and a bucket is the widest range of cells within ``capacity``.

* Texts are compared by their bytes in a grouping on key and text, which folds copies before the shuffle, so a group of any size meets in one row per task. What is left is one entry per different text.
* The directory sends each entry to the owner of its bucket. Owners check that the bucket is within its range and capacity, chain the texts whose keys collide, and write the bucket to the index.
* The directory sends each posting (a row of the input, without its text) to its bucket, and the chain there gives the row that stays.

A posting whose cell the directory lacks, a bucket that holds too many keys or keys of others, and different texts of one key and digest are errors, not wrong results. The driver sees row counts only.

Edge cases: null text is empty text; empty texts equal each other; repeated rows belong to the same group and exactly one row stays per
group, the one with the largest id (null ids rank lowest; among rows of one id any single one); an empty table gives an empty result. The input's other columns are not read
by :func:`find`; :func:`keep` returns them all, so names such as ``key`` cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paceway.llm.text import ascii_lower
from paceway.runtime import fresh_dir, written

#: Keys in a bucket; an entry takes about 100 bytes, so an owner holds some 3 MB.
CAPACITY = 1 << 15
KEY_BITS = 63


def _key(norm: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(norm), 64 - bits)


def _normal(docs: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """``id, norm, key``."""
    rows = docs.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("norm"))
    return rows.withColumn("key", _key(F.col("norm"), bits))


def directory(keys: DataFrame, capacity: int = CAPACITY, bits: int = KEY_BITS) -> tuple[DataFrame, int]:
    """``(cell, bucket, local_depth)`` of a table of different ``key`` values, and the depth of the directory.

    A cell is the leading ``depth`` bits of a key; ``bucket`` is the first key of the bucket's range.
    """
    total = keys.count()
    depth = min(bits, max(0, math.ceil(math.log2(max(1, total / capacity)))))
    while True:
        cells = keys.groupBy(F.shiftright("key", bits - depth).alias("cell")).agg(F.count("*").alias("n"))
        if depth == bits or cells.where(F.col("n") > capacity).isEmpty():
            break
        depth += 1  # the directory doubles: every cell splits in two
    cells = written(cells, "cells")
    ranges = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("local_depth"))
    ranges = ranges.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - local_depth)"))
    fits = ranges.groupBy("local_depth", "prefix").agg(F.sum("n").alias("n")).where((F.col("n") <= capacity) | (F.col("local_depth") == depth))
    cells = ranges.join(fits.select("local_depth", "prefix"), ["local_depth", "prefix"], "left_semi").groupBy("cell").agg(F.min("local_depth").alias("local_depth"))
    first = F.expr(f"shiftleft(shiftright(cell, {depth} - local_depth), {bits} - local_depth)")
    return cells.select("cell", first.alias("bucket"), "local_depth"), depth


def _routed(rows: DataFrame, cells: DataFrame, depth: int, bits: int) -> DataFrame:
    """``rows`` with the ``bucket`` that the directory names for their ``key``, and its ``local_depth``."""
    met = rows.withColumn("cell", F.shiftright("key", bits - depth)).join(cells, "cell", "left")
    known = F.when(F.col("bucket").isNull(), F.raise_error(F.lit("a key's cell is not in the directory")).cast("long")).otherwise(F.col("bucket"))
    return met.withColumn("bucket", known).drop("cell")


def _owned(entries: DataFrame, capacity: int, bits: int) -> DataFrame:
    """The buckets as their owners write them: entries by bucket and key, with their place in the chain of the key."""
    owned = entries.repartition("bucket")
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("sha"))
    owned = owned.withColumn("chain", chain).withColumn("keys", F.sum(F.when(F.col("chain") == 1, 1).otherwise(0)).over(Window.partitionBy("bucket")))
    stray = F.expr(f"key < bucket or shiftright(key - bucket, {bits} - local_depth) > 0")
    full = (F.col("keys") > capacity) & (F.col("local_depth") < bits)
    wrong = F.when(stray, F.raise_error(F.lit("a bucket holds a key of another")).cast("int")).when(full, F.raise_error(F.lit("a bucket is overfull")).cast("int"))
    return owned.withColumn("chain", F.coalesce(wrong, "chain")).select("bucket", "key", "chain", "sha", "top", "size").sortWithinPartitions("bucket", "key", "chain")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, bits: int = KEY_BITS) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256, bucket, chain`` (place in the chain of the key, from 1)."""
    spark = docs.sparkSession
    rows = _normal(docs, id_col, text_col, bits)
    postings = written(rows.select("id", "key", F.sha2(F.col("norm"), 256).alias("sha"), F.monotonically_increasing_id().alias("row")), "postings")
    cells, depth = directory(postings.select("key").distinct(), capacity, bits)
    cells = written(cells, "directory")

    # Byte comparison: equal keys meet, and the grouping on the text itself parts what only collides.
    texts = rows.groupBy("key", "norm").agg(F.lit(1).alias("one")).select("key", F.sha2(F.col("norm"), 256).alias("sha"))
    links = texts.groupBy("key", "sha").agg(F.count("*").alias("texts"))
    tops = postings.groupBy("key", "sha").agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("n"))
    size = F.when(F.col("texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("different texts share key and digest")).cast("long"))
    entries = _routed(tops.join(links, ["key", "sha"]).withColumn("size", size), cells, depth, bits)
    index = _owned(entries, capacity, bits)
    path = fresh_dir(spark, "index")
    index.write.parquet(path)
    index = spark.read.schema(index.schema).parquet(path)

    met = _routed(postings, cells, depth, bits).drop("local_depth").join(index, ["bucket", "key", "sha"])
    return met.select(
        "id",
        F.col("top.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("top.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "bucket",
        "chain",
    )


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, bits: int = KEY_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one per group of equal texts, with their columns as they are."""
    stays = find(docs, id_col, text_col, capacity, bits).where("kept").select("id", "text_sha256")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    whole = whole.withColumns({"id": F.col("doc").getField(id_col), "text_sha256": F.sha2(ascii_lower(F.col("doc").getField(text_col)), 256)})
    same = whole["id"].eqNullSafe(stays["id"]) & (whole["text_sha256"] == stays["text_sha256"])
    met = whole.join(stays.withColumn("_stays", F.lit(True)), same, "left_semi")
    # Rows repeated with their id meet here; the join has brought them together already.
    nth = F.row_number().over(Window.partitionBy("text_sha256", "id").orderBy(F.lit(1)))
    return met.withColumn("nth", nth).where("nth = 1").select("doc.*")
