import hashlib
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paceway.llm import exact

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(t):
    return (t or "").translate(UPPER)


def corpus():
    rng = random.Random(4)
    texts = [None, "", "Abc", "aBC", "ÉA", "éa", "İ", "i̇", "x" * 200_000, "X" * 200_000, "a\nb", "a b"]
    texts += ["Copy of a very common text"] * 300
    texts += [f"text {rng.randrange(60)}" for _ in range(200)]
    return texts


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return {(i, norm(t)): (max(groups[norm(t)]), len(groups[norm(t)])) for i, t in rows}


def test_equals_brute_force_with_collisions_and_splits(spark):
    rows = list(enumerate(corpus()))
    docs = spark.createDataFrame([(i, t, 7, "b") for i, t in rows], "doc_id long, text string, key int, bucket string").repartition(6)
    want = brute(rows)
    for bits, capacity in ((63, 1 << 20), (3, 1), (12, 4)):
        got = exact.find(docs, capacity=capacity, bits=bits).collect()
        assert len(got) == len(rows)
        for r in got:
            keep, size = want[r["id"], norm(rows[r["id"]][1])]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, size, r["id"] == keep)
            assert r["text_sha256"] == hashlib.sha256(norm(rows[r["id"]][1]).encode()).hexdigest()
        if bits == 3:
            assert max(r["chain"] for r in got) > 1  # texts that only collide
    kept = exact.keep(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({k for k, _ in want.values()})


def test_directory_holds_capacity(spark):
    keys = spark.range(500).selectExpr("shiftrightunsigned(xxhash64(id), 50) as key").distinct().where("key < 9000")
    cells, depth = exact.directory(keys, capacity=8, bits=14)
    per = {}
    where = {r["cell"]: r["bucket"] for r in cells.collect()}
    for r in keys.collect():
        per[where[r["key"] >> (14 - depth)]] = per.get(where[r["key"] >> (14 - depth)], 0) + 1
    assert max(per.values()) <= 8
    assert len(per) < len(where)  # some cells share a bucket


@pytest.mark.parametrize("broken", ["one bucket", "lost cell", "wrong bucket"])
def test_result_depends_on_the_directory(spark, monkeypatch, broken):
    """Routing is through the directory: one that is not right never gives a result."""
    docs = spark.createDataFrame([(i, f"text {i % 40}") for i in range(80)], "doc_id long, text string")
    right = exact.directory

    def wrong(keys, capacity, bits):
        cells, depth = right(keys, capacity, bits)
        assert cells.count() > 4
        if broken == "one bucket":
            return cells.withColumns({"bucket": F.lit(0).cast("long"), "local_depth": F.lit(0)}), depth
        if broken == "lost cell":
            return cells.where(F.col("cell") != cells.agg(F.min("cell")).first()[0]), depth
        return cells.withColumn("bucket", F.lit(1).cast("long") + F.max("bucket").over(Window.partitionBy()) - F.col("bucket")), depth

    assert exact.find(docs, capacity=4).where("kept").count() == 40
    monkeypatch.setattr(exact, "directory", wrong)
    with pytest.raises(Exception, match="overfull|not in the directory|key of another"):
        exact.find(docs, capacity=4).collect()


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(1, "a"), (1, "a"), (None, "A"), (None, None), (None, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact.find(docs).collect()
    assert len(got) == 6 and sum(r["kept"] for r in got) == 2
    assert {r["keep_id"] for r in got} == {1, 5}
    assert sorted(r["doc_id"] for r in exact.keep(docs).collect()) == [1, 5]
    twins = spark.createDataFrame([(None, "q"), (None, "q")], "doc_id long, text string")
    assert exact.keep(twins).count() == 1
    assert exact.find(docs.where("false")).count() == 0
