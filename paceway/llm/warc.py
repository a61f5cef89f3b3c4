"""Deterministic sharded WARC archives: write, commit, read back.

**Shards.** Records are ordered by id. A shard is a stretch of that order of about ``shard_bytes`` of payload, found from running sums that depend on the order alone, so neither the number of
tasks nor a retry changes what a shard holds. Payloads are shuffled once, by shard; what each record refers to comes along as a row of its own and meets the payload in the sorted
stream. The driver sees one id for each shard.

**Files.** A task writes its shards record by record, each a gzip member, and starts a new file once the compressed size passes ``roll_bytes``. Headers and digests are made anew from the payload;
dates are given, record ids follow from ids, so equal input gives equal bytes.

**Commit.** Files get temporary names of their attempt. A task returns the manifest rows of its files, so after retries only one attempt of each shard is in the manifest. When all tasks are done, the files of the manifest
are renamed, which can be repeated at will, then the manifest is published and the temporary folder goes.

Files are reached through pyarrow's file systems, so the folder may be local, HDFS or an object store. Edge cases: null html is an empty payload; a null or odd URL is left out or quoted; repeated rows
are written each (of equal payloads those with the smallest id are responses, so equal ids are treated alike); a null id stays null and only refers to itself where no other id has
the payload; an empty table makes an empty manifest; other columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paceway.runtime import fresh_dir, remove_dir, written

MANIFEST = "shard long, part int, temporary string, name string, records long, bytes long, sha256 string"


def _files():
    """Access to files, made here so that it travels to the workers by value."""

    def place(uri):
        """The file system and the path of a folder or file."""
        import re

        from pyarrow.fs import FileSystem

        return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))

    return place


def _record():
    """The function that makes a record's bytes."""

    def record(name, url, payload, digest, size, refers, date):
        """A response record, or a revisit record where ``refers`` is given; names are quoted ids."""
        import hashlib
        from urllib.parse import quote

        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
        block = http if refers is not None else http + payload
        lines = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {date}"]
        if url:
            lines.append(f"WARC-Target-URI: {quote(url, safe=chr(37) + ':/?#[]@!$&()*+,;=~' + chr(39))}")
        lines += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
        if refers is not None:
            lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
        lines.append(f"Content-Length: {len(block)}")
        return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    return record


def _plan(pages: DataFrame, id_col: str, html_col: str, least: int, shard_bytes: int):
    """``(id, digest, bytes, refers, revisit)`` of all records, and the first id of every shard but the first."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    light = written(pages.select(F.col(id_col).alias("id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes")), "payloads")
    firsts = light.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("id").alias("first"))
    light = light.join(firsts, "digest", "left")
    revisit = (F.col("bytes") >= least) & ~F.col("id").eqNullSafe(F.col("first"))
    light = light.select("id", "digest", "bytes", F.when(revisit, F.col("first")).alias("refers"), revisit.alias("revisit"))
    light = written(light.repartitionByRange("id").sortWithinPartitions("id", "digest").withColumn("part", F.spark_partition_id()), "records")

    sums = {r["part"]: r["s"] for r in light.groupBy("part").agg(F.sum("bytes").alias("s")).collect()}  # one row for each task
    at, before = 0, {}
    for part in sorted(sums):
        before[part] = at
        at += sums[part]
    if not before:
        return light, []
    running = F.sum("bytes").over(Window.partitionBy("part").orderBy("id", "digest").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes")
    offsets = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    shards = light.withColumn("shard", F.floor((running + offsets[F.col("part")]) / shard_bytes))
    starts = shards.where("id is not null").groupBy("shard").agg(F.min("id").alias("first")).orderBy("shard").collect()
    return light, [r["first"] for r in starts[1:]]


def write(pages: DataFrame, root: str, id_col="page_id", url_col="url", html_col="html", least=100, shard_bytes=32 << 20, roll_bytes=16 << 20, date="1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row below the folder ``root`` and return the manifest: ``shard, part, name, records, bytes, sha256``."""
    light, starts = _plan(pages, id_col, html_col, least, shard_bytes)
    place, record = _files(), _record()

    @F.pandas_udf("long")
    def later(ids: pd.Series) -> pd.Series:
        from bisect import bisect_right

        return ids.map(lambda i: bisect_right(starts, i)).astype("int64")

    # Null ids sort first. They are kept from the function, in which they would turn numbers into floats.
    shard = F.when(F.col("id").isNull(), 0).otherwise(later(F.coalesce("id", F.lit(starts[0])))) if starts else F.lit(0)

    payload = F.coalesce(F.col(html_col), F.lit(""))
    name, empty = F.url_encode(F.col("id").cast("string")), F.lit(None).cast("string")
    # A record's description sorts just before its payload. Rows of one id and payload are alike, so they may pair in any order.
    notes = light.select("id", "digest", F.lit(0).alias("kind"), name.alias("name"), F.url_encode(F.col("refers").cast("string")).alias("refers"), "revisit", empty.alias("url"), empty.alias("html"))
    whole = pages.select(F.col(id_col).alias("id"), F.sha2(payload, 256).alias("digest"), F.lit(1).alias("kind"), empty.alias("name"), empty.alias("refers"), F.lit(None).cast("boolean").alias("revisit"), F.col(url_col).alias("url"), payload.alias("html"))
    rows = notes.union(whole).withColumn("shard", shard.cast("long"))
    rows = rows.repartitionByRange(len(starts) + 1, "shard").sortWithinPartitions("shard", "id", "digest", "kind").drop("id")

    def run(batches):
        import hashlib
        import uuid
        import zlib

        import pyarrow as pa

        fs, base = place(root)
        attempt = f"{base}/_temporary/{uuid.uuid4().hex}"
        made, now = [], None

        class File:
            def __init__(self, shard, part):
                self.shard, self.part, self.name = shard, part, f"shard-{shard:06d}-{part:04d}.warc.gz"
                fs.create_dir(attempt, recursive=True)
                self.out, self.sum, self.size, self.records = fs.open_output_stream(f"{attempt}/{self.name}", compression=None), hashlib.sha256(), 0, 0

            def add(self, data):
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(data) + packer.flush()
                self.out.write(data)
                self.sum.update(data)
                self.size += len(data)
                self.records += 1

            def close(self):
                self.out.close()
                made.append((self.shard, self.part, f"{attempt}/{self.name}", self.name, self.records, self.size, self.sum.hexdigest()))

        waiting = []
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    waiting.append((r["digest"], r["name"], r["refers"], r["revisit"]))
                    continue
                digest, name, refers, revisit = waiting.pop(0)
                data = r["html"].encode("utf-8", "replace")
                if not digest == r["digest"] == hashlib.sha256(data).hexdigest():
                    raise ValueError(f"record {name}: the payload does not have its digest")
                if now is None or now.shard != r["shard"]:
                    if now:
                        now.close()
                    now = File(r["shard"], 0)
                elif now.size >= roll_bytes:
                    now.close()
                    now = File(now.shard, now.part + 1)
                now.add(record(name or "", r["url"], data, digest, len(data), (refers or "") if revisit else None, date))
        if now:
            now.close()
        columns = zip(*made, strict=True) if made else [[]] * 7
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[f.split(" ")[0] for f in MANIFEST.split(", ")])

    manifest = written(rows.mapInArrow(run, MANIFEST), "manifest")

    def commit(batches):
        from pyarrow.fs import FileType

        fs, base = place(root)
        for batch in batches:
            for r in batch.to_pylist():
                target = f"{base}/{r['name']}"
                if fs.get_file_info(r["temporary"]).type == FileType.File:
                    fs.move(r["temporary"], target)
                if fs.get_file_info(target).size != r["bytes"]:
                    raise ValueError(f"{target} is not what the manifest says")
            yield batch.select([n for n in batch.schema.names if n != "temporary"])

    schema = MANIFEST.replace(" temporary string,", "")
    done = manifest.repartition("name").mapInArrow(commit, schema)
    done.write.parquet(f"{root}/_manifest")
    remove_dir(pages.sparkSession, f"{root}/_temporary")
    return pages.sparkSession.read.schema(schema).parquet(f"{root}/_manifest")


def read(spark: SparkSession, root: str, id_type: str = "long") -> DataFrame:
    """One row per record of the archives that the manifest names: ``id, payload_bytes, payload_digest, record_type, refers_to, url``.

    Size and digest of a response come from its payload, those of a revisit from its headers.
    """
    place = _files()

    def run(batches):
        import gzip
        import hashlib

        import pyarrow as pa

        fs, base = place(root)

        def header(stream):
            out = {}
            while line := stream.readline().rstrip(b"\r\n"):
                key, _, value = line.decode().partition(": ")
                out[key] = value
            return out

        def records(name):
            with fs.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                while stream.peek(1):
                    head = header(stream)
                    block = stream.read(int(head["Content-Length"]))
                    stream.read(4)
                    page = lambda k: head[k][len("<urn:page:") : -1] or None if k in head else None  # noqa: B023, E731
                    http, _, payload = block.partition(b"\r\n\r\n")
                    if head["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                        raise ValueError(f"{name}: a block does not have its digest")
                    if head["WARC-Type"] == "response":
                        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    else:
                        size, digest = int(http.rpartition(b"Content-Length: ")[2]), head["WARC-Payload-Digest"].removeprefix("sha256:")
                    yield page("WARC-Record-ID"), size, digest, head["WARC-Type"], page("WARC-Refers-To"), head.get("WARC-Target-URI")

        def packed(rows):
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

        rows = []
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for r in records(name):
                    rows.append(r)
                    if len(rows) >= 5000:
                        yield packed(rows)
                        rows = []
        if rows:
            yield packed(rows)

    files = spark.read.schema(MANIFEST.replace(" temporary string,", "")).parquet(f"{root}/_manifest")
    out = files.select("name").repartition("name").mapInArrow(run, "id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string")
    return out.withColumns({c: F.url_decode(c).cast(id_type) for c in ("id", "refers_to")})


def archive(pages: DataFrame, **how) -> DataFrame:
    """Write ``pages`` into a fresh folder of the shared folder and read the archives back."""
    root = fresh_dir(pages.sparkSession, "warc")
    write(pages, root, **how)
    return read(pages.sparkSession, root)
