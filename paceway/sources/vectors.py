"""Lines with attributes in shapefiles (``.shp``, ``.shx``, ``.dbf``), read in ranges of their index and written with a commit.

Records of lines differ in length, so a file cannot be cut by bytes; its index ``.shx`` has the place of every record in eight bytes. The number of records follows from the size of the index, which a listing
gives, so reading plans ranges of records without opening a file, and deals them to tasks. A task reads its part of the index, the stretch of the main file that it names, in blocks, and the rows of the table, all of which are
of one width. A very large file is many tasks, and a task holds one block.

**Writing.** Tasks write whole sets of files under names of their attempt and return manifest rows; when all are done, the sets of the manifest are renamed into the folder, the index last: a set without index is not seen by
readers. Sets that are there already stay.

Edge cases: a record without a shape has no points, a record that is marked as deleted is left out; a field is text without the blanks around it, so a missing value and an empty one are alike; a folder
without index files has no lines; a file that does not agree with its index fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceway.runtime import remove_dir, workspace
from paceway.sources.tiles import _files

# numbers of the format (fixed values): file code, version, header bytes, bytes of an index entry, shape types
FILE_CODE, VERSION, HEADER, ENTRY = 9994, 1000, 100, 8
NO_SHAPE, LINE, LINE_TYPES = 0, 3, (3, 13, 23)
# records of a batch that are Python objects at a time
SLICE = 500
POINTS = "array<struct<part:int,lon:double,lat:double>>"


def _reader():
    """The function that reads a range of records, made here so that it travels to the workers by value."""

    def table_fields(head, rest, wanted, name):
        """``(first byte, end)`` of each wanted field in a table row."""
        places, at = {}, 1  # a mark comes first
        for i in range(0, len(rest) - 31, 32):
            if rest[i] == 0x0D:
                break
            label = rest[i : i + 11].split(b"\0")[0].decode("ascii", "replace").lower()
            places[label] = (at, at + rest[i + 16])
            at += rest[i + 16]
        missing = [w for w in wanted if w.lower() not in places]
        if missing:
            raise ValueError(f"{name}.dbf has no field {missing[0]}")
        return [places[w.lower()] for w in wanted]

    def read_range(fs, stem, first, count, wanted, encoding, block):
        """Blocks of ``(record, fields, part, lon, lat, points of each record)``."""
        import struct

        import numpy as np

        name = stem.rpartition("/")[2]
        with fs.open_input_file(f"{stem}.shx") as index:
            if struct.unpack(">i", index.read(4))[0] != FILE_CODE:
                raise ValueError(f"{name}.shx is no index")
            index.seek(HEADER + ENTRY * first)
            entries = np.frombuffer(index.read(ENTRY * count), ">i4").reshape(-1, 2).astype(np.int64) * 2  # given in words of two bytes
        starts, sizes = entries[:, 0], entries[:, 1]
        ends = starts + 8 + sizes
        with fs.open_input_file(f"{stem}.dbf") as rows, fs.open_input_file(f"{stem}.shp") as shapes:
            head = rows.read(32)
            total, head_size, width = struct.unpack("<IHH", head[4:12])
            if total < first + count:
                raise ValueError(f"{name}.dbf has {total} rows, its index more")
            places = table_fields(head, rows.read(head_size - 32), wanted, name)
            at = 0
            while at < count:
                upto = at + 1
                while upto < count and starts[upto] >= ends[upto - 1] and ends[upto] - starts[at] <= block:
                    upto += 1
                shapes.seek(int(starts[at]))
                data = shapes.read(int(ends[upto - 1] - starts[at]))
                rows.seek(head_size + width * (first + at))
                table = rows.read(width * (upto - at))
                records, fields, parts, xy, many = [], [], [], [], []
                for i in range(at, upto):
                    begin = int(starts[i] - starts[at])
                    body = data[begin + 8 : begin + 8 + int(sizes[i])]
                    if len(body) != sizes[i] or len(body) < 4 or struct.unpack(">i", data[begin + 4 : begin + 8])[0] * 2 != sizes[i]:
                        raise ValueError(f"record {first + i} of {name}.shp is not what the index says")
                    row = table[(i - at) * width : (i - at + 1) * width]
                    if row[:1] == b"*":
                        continue
                    kind, n = struct.unpack("<i", body[:4])[0], 0
                    if kind in LINE_TYPES:
                        n_parts, n = struct.unpack("<2i", body[36:44])
                        firsts = np.frombuffer(body, "<i4", n_parts, 44)
                        parts.append(np.repeat(np.arange(n_parts, dtype=np.int32), np.diff(firsts, append=n)))
                        xy.append(np.frombuffer(body, "<f8", 2 * n, 44 + 4 * n_parts).reshape(-1, 2))
                    elif kind != NO_SHAPE:
                        raise ValueError(f"record {first + i} of {name}.shp has shape type {kind}, not a line")
                    records.append(first + i)
                    fields.append([row[a:b].decode(encoding, "replace").strip(" \0") for a, b in places])
                    many.append(n)
                points = np.concatenate(xy) if xy else np.zeros((0, 2))
                yield records, fields, np.concatenate(parts) if parts else np.zeros(0, np.int32), points, many
                at = upto

    return read_range


def read_lines(spark: SparkSession, folder: str, fields: dict[str, str], records_per_task: int = 50_000, encoding: str = "utf-8", block: int = 4 << 20) -> DataFrame:
    """``file, record, <fields>, points`` of all line records below a folder; ``fields`` names for each column the field of the table it is read from. Points have the number of their part."""
    place, read_range, step = _files(), _reader(), records_per_task
    wanted = list(fields.values())
    names = ["file", "record", *fields, "points"]

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for path, first, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, base = place(path.removesuffix(".shx"))
                file = base.rpartition("/")[2]
                for records, values, parts, points, many in read_range(fs, base, first, count, wanted, encoding, block):
                    each = pa.StructArray.from_arrays([pa.array(parts, pa.int32()), pa.array(points[:, 0]), pa.array(points[:, 1])], names=["part", "lon", "lat"])
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many, dtype=np.int64)]), pa.int32()), each)
                    columns = [pa.array([v[i] for v in values], pa.string()) for i in range(len(wanted))]
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(records), pa.string()), pa.array(records, pa.int64()), *columns, lists], names=names)

    index = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.shx").load(folder)
    files = index.select("path", F.floor((F.col("length") - HEADER) / ENTRY).alias("records")).where("records > 0")
    ranges = files.select("path", "records", F.explode(F.sequence(F.lit(0).cast("long"), F.col("records") - 1, F.lit(step).cast("long"))).alias("first"))
    ranges = ranges.select("path", "first", F.least(F.col("records") - F.col("first"), F.lit(step)).alias("count"))
    columns = "".join(f"`{c}` string, " for c in fields)
    return ranges.repartition(max(1, ranges.count())).mapInArrow(read, f"file string, record long, {columns}points {POINTS}")


def write_lines(lines: DataFrame, folder: str, fields: dict[str, tuple[str, int]], roll_bytes: int = 64 << 20) -> int:
    """Write ``points`` (``lon``, ``lat`` and, if there, ``part`` in order) with fields as line files below ``folder``; the number of records.

    ``fields`` gives for each column the name of its field (at most 10 signs) and its width in bytes (at most 254). A task begins a new set of files once a main file reaches ``roll_bytes``, which is what it holds.
    """
    for label, width in fields.values():
        if not 0 < len(label) <= 10 or not 0 < width <= 254:
            raise ValueError(f"field {label!r} of {width} bytes does not fit the format")
    spark, staging, place = lines.sparkSession, f"{folder}/_temporary/{uuid.uuid4().hex}", _files()
    element = lines.schema["points"].dataType.elementType.fieldNames()
    part = (lambda p: p["part"]) if "part" in element else (lambda p: F.lit(0))
    points = F.transform("points", lambda p: F.struct(part(p).cast("int").alias("part"), p["lon"].alias("lon"), p["lat"].alias("lat")))
    labels = list(fields.values())

    def draw(batches):
        import struct
        import uuid

        import numpy as np
        import pyarrow as pa

        fs, base = place(staging)
        # the bytes as they go to the files, and the box of them; no object is kept for a record
        shapes, index, rows, around = bytearray(), bytearray(), bytearray(), []
        records, made = 0, []

        def header(length):
            x0, y0, x1, y1 = around or (0.0,) * 4
            return struct.pack(">7i", FILE_CODE, 0, 0, 0, 0, 0, length // 2) + struct.pack("<2i8d", VERSION, LINE, x0, y0, x1, y1, 0, 0, 0, 0)

        def close():
            nonlocal records
            fs.create_dir(base, recursive=True)
            stem = f"{base}/{uuid.uuid4().hex}"
            columns = b"".join(label.encode("ascii").ljust(11, b"\0") + b"C" + bytes(4) + bytes([width]) + bytes(15) for label, width in labels)
            table = struct.pack("<4BIHH20x", 3, 100, 1, 1, records, 32 + len(columns) + 1, 1 + sum(w for _, w in labels))
            for end, parts in (("dbf", [table, columns, b"\r", rows, b"\x1a"]), ("shp", [header(HEADER + len(shapes)), shapes]), ("shx", [header(HEADER + len(index)), index])):
                with fs.open_output_stream(f"{stem}.{end}") as out:
                    for part in parts:
                        out.write(part)
            made.append((stem, records))
            for held in (shapes, index, rows, around):
                held.clear()
            records = 0

        for batch in batches:
            for points, *values in (row for at in range(0, batch.num_rows, SLICE) for row in zip(*(c.slice(at, SLICE).to_pylist() for c in batch.columns), strict=True)):
                body = struct.pack("<i", NO_SHAPE)
                if points:
                    xy = np.array([(p["lon"], p["lat"]) for p in points], "<f8")
                    numbers = np.array([p["part"] for p in points])
                    firsts = np.flatnonzero(np.diff(numbers, prepend=numbers[0] - 1)).astype("<i4")
                    box = [float(v) for v in (*xy.min(axis=0), *xy.max(axis=0))]
                    body = struct.pack("<i4d2i", LINE, *box, len(firsts), len(xy)) + firsts.tobytes() + xy.tobytes()
                row = b" "
                for (label, width), value in zip(labels, values, strict=True):
                    data = (value or "").encode()
                    if len(data) > width:
                        raise ValueError(f"{value!r} is longer than the {width} bytes of field {label}")
                    row += data.ljust(width)
                if records and HEADER + len(shapes) + 8 + len(body) > roll_bytes:
                    close()
                if points:
                    around[:] = [*np.minimum(around[:2], box[:2]), *np.maximum(around[2:], box[2:])] if around else box
                records += 1
                index += struct.pack(">2i", (HEADER + len(shapes)) // 2, len(body) // 2)
                shapes += struct.pack(">2i", records, len(body) // 2) + body
                rows += row
        if records:
            close()
        stems, counts = zip(*made, strict=True) if made else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(counts, pa.int64())], names=["stem", "records"])

    def move(batches):
        import pyarrow as pa
        from pyarrow.fs import FileType

        fs, base = place(folder)
        for batch in batches:
            for stem in batch.column(0).to_pylist():
                for end in ("dbf", "shp", "shx"):  # the index last
                    target = f"{base}/{stem.rpartition('/')[2]}.{end}"
                    if fs.get_file_info(f"{stem}.{end}").type == FileType.File:
                        fs.move(f"{stem}.{end}", target)
                    elif fs.get_file_info(target).type != FileType.File:
                        raise FileNotFoundError(f"{stem}.{end}")
            yield batch.select(["records"])

    fs, base = place(folder)
    fs.create_dir(base, recursive=True)
    try:
        with workspace(spark, "lines") as keep:
            texts = (F.col(c).cast("string").alias(c) for c in fields)
            manifest = keep(lines.select(points.alias("points"), *texts).mapInArrow(draw, "stem string, records long"), "manifest")
            return manifest.mapInArrow(move, "records long").agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    finally:
        remove_dir(spark, staging)
