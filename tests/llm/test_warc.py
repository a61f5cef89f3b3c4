import glob
import gzip
import hashlib
import random

from paceway.llm import warc
from paceway.runtime import fresh_dir


def pages():
    rng = random.Random(5)
    body = lambda n: "<p>" + "".join(rng.choice("abé😀 \r\n") for _ in range(n))
    twin, short = body(300), "short"
    rows = [(1, "http://a.example/x", twin), (2, None, None), (3, "", ""), (4, "http://b.example/ü ö\r\nX: y", short), (5, "http://b.example/", short)]
    rows += [(10 + i, f"http://c.example/{i}", twin if i % 3 == 0 else body(rng.randrange(2000))) for i in range(120)]
    rows += [(500, "http://d.example/", "y" * 400_000)]
    return rows


def brute(rows):
    first, out = {}, []
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, i), i)
    for i, _, h in rows:
        b = (h or "").encode()
        again = b in first and first[b] != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return out


def test_round_trip_and_determinism(spark):
    rows = pages()
    frame = spark.createDataFrame([(*r, "extra", 3) for r in rows], "page_id long, url string, html string, digest string, kind int")
    files = []
    for parts in (1, 7):  # however the table is dealt, the bytes are the same
        root = fresh_dir(spark, "warc")
        manifest = warc.write(frame.repartition(parts), root, shard_bytes=40_000, roll_bytes=4_000)
        assert manifest.count() > manifest.select("shard").distinct().count() > 2
        got = [tuple(r)[:5] for r in warc.read(spark, root).collect()]
        assert sorted(got) == sorted(brute(rows))
        found = sorted(glob.glob(f"{root.removeprefix('file:')}/*.warc.gz"))
        assert {f.rpartition("/")[2] for f in found} == {r["name"] for r in manifest.collect()}
        assert not glob.glob(f"{root}/_temporary")
        files.append([(f.rpartition("/")[2], open(f, "rb").read()) for f in found])
        hashes = {r["name"]: r["sha256"] for r in manifest.collect()}
        assert all(hashlib.sha256(data).hexdigest() == hashes[name] for name, data in files[-1])
    assert files[0] == files[1]
    text = gzip.decompress(files[0][0][1])
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"\r\nX: y" not in text


def test_repeated_rows_nulls_and_empty(spark):
    long = "z" * 150
    frame = spark.createDataFrame([(1, "u", long), (1, "u", long), (2, "u", long), (None, None, long), (None, None, None)], "page_id long, url string, html string")
    got = sorted((r["id"] or 0, r["record_type"], r["refers_to"] or 0) for r in warc.archive(frame).collect())
    assert got == [(0, "response", 0), (0, "revisit", 1), (1, "response", 0), (1, "response", 0), (2, "revisit", 1)]
    assert warc.archive(frame.where("false")).count() == 0
