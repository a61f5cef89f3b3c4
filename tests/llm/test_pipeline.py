import random

import corpus_pipeline
import pytest
from test_near import brute_classes, edited


def test_stages(spark, tmp_path):
    """Each stage against what must go: a planted row for every reason, and clean rows that must stay."""
    rng = random.Random(31)
    text = lambda n: " ".join(rng.choice("the of and with that this was for her his".split()) + rng.choice(["", "", "ing", "er"]) + str(rng.randrange(60)) for _ in range(n)) + "."
    item = text(40)
    clean = [text(rng.randrange(30, 90)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100, None), (101, ""), (102, "12 34 ..."), (200, clean[0].upper()), (201, clean[1]), (300, edited(rng, clean[2], 1)), (400, text(10) + " " + item + " " + text(10)), (0, clean[0])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "more") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, extra string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != "sequences":
            assert out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{name}")
            out = spark.read.parquet(f"{tmp_path}/{name}")
        ids.append(sorted(r["doc_id"] for r in out.collect()))
        now = out
    every = sorted(i for i, _ in rows)
    assert ids[0] == [i for i in every if i not in (100, 101, 102)]
    assert ids[1] == [i for i in ids[0] if i not in (0, 1)]  # the largest id stays
    by_id = dict(rows)
    order = ids[1]
    assert ids[2] == sorted({order[c] for c in brute_classes([by_id[i] for i in order])})
    assert ids[3] == [i for i in ids[2] if i != 400]
    assert sorted(set(ids[4])) == ids[3]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(ids[3])


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "only")]])
def test_tiny_tables(spark, tmp_path, rows):
    spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
