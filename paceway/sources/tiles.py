"""Styled tiles as files at their addresses: indexed PNG, written and read back.

**Commit.** A task writes its tiles under names of its attempt in a temporary folder beside the layer and returns their manifest rows, so after retries the manifest holds one attempt of each
tile. Only when all tasks are done are the files of the manifest renamed to their addresses, by tasks again; a rename that is repeated finds its work done. A write that fails
before that leaves the addresses as they were, and its temporary folder goes. The driver sees neither tiles nor manifest.

Files are reached through pyarrow's file systems, so the folder may be local, HDFS or an object store.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceway.runtime import remove_dir, workspace

MANIFEST = "path string, temporary string, bytes long"


def _files():
    """Access to files, made here so that it travels to the workers by value."""

    def place(uri):
        """The file system and the path of a folder or file."""
        import re

        from pyarrow.fs import FileSystem

        return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))

    return place


def _png():
    """An encoder and a decoder of square indexed images; index 0 is transparent, class ``k`` has index ``k + 1``."""
    import struct
    import zlib

    start = b"\x89PNG\r\n\x1a\n"

    def encode(px, classes, side, palette):
        import numpy as np

        image = np.zeros(side * side, np.uint8)
        image[px] = np.asarray(classes) + 1
        rows = np.zeros((side, side + 1), np.uint8)  # each row begins with its filter: none
        rows[:, 1:] = image.reshape(side, side)
        colours = b"\0\0\0" + b"".join(bytes.fromhex(c.lstrip("#")) for c in palette)
        header = struct.pack(">IIBBBBB", side, side, 8, 3, 0, 0, 0)
        parts = [(b"IHDR", header), (b"PLTE", colours), (b"tRNS", b"\0"), (b"IDAT", zlib.compress(rows.tobytes())), (b"IEND", b"")]
        return start + b"".join(struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body)) for name, body in parts)

    def decode(data):
        """``(px, class)`` arrays of an image of :func:`encode`."""
        import numpy as np

        if not data.startswith(start):
            raise ValueError("not a PNG file")
        at, pixels, side = len(start), b"", 0
        while at < len(data):
            size, name = struct.unpack(">I4s", data[at : at + 8])
            body = data[at + 8 : at + 8 + size]
            if zlib.crc32(name + body) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
                raise ValueError("a part of the image is damaged")
            if name == b"IHDR":
                side = struct.unpack(">I", body[:4])[0]
            elif name == b"IDAT":
                pixels += body
            at += 12 + size
        image = np.frombuffer(zlib.decompress(pixels), np.uint8).reshape(side, side + 1)[:, 1:].ravel()
        px = np.flatnonzero(image)
        return px, image[px].astype(int) - 1

    return encode, decode


def write_tiles(tiles: DataFrame, folder: str, palette: list[str], tile_size: int = 256) -> int:
    """Write ``(path, px, class_index)`` as images at their paths, all of which lie below ``folder``; the number of tiles.

    A class has the colour of its number in ``palette`` (``#rrggbb``, at most 255); cells without a class are transparent. Tiles that are there already are replaced.
    """
    if len(palette) > 255:
        raise ValueError("an indexed image has at most 255 classes")
    spark, staging = tiles.sparkSession, f"{folder}/_temporary/{uuid.uuid4().hex}"
    place, (encode, _) = _files(), _png()

    def draw(batches):
        import uuid

        import pyarrow as pa

        fs, base = place(staging)
        attempt, n = f"{base}/{uuid.uuid4().hex}", 0
        for batch in batches:
            made = []
            for path, px, classes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = encode(px, classes, tile_size, palette)
                if n == 0:
                    fs.create_dir(attempt)
                name, n = f"{attempt}/{n}", n + 1
                with fs.open_output_stream(name) as out:
                    out.write(data)
                made.append((path, name, len(data)))
            columns = zip(*made) if made else ((), (), ())
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "temporary", "bytes"])

    def move(batches):
        import pyarrow as pa
        from pyarrow.fs import FileType

        folders = set()
        for batch in batches:
            for path, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, target = place(path)
                if (parent := target.rpartition("/")[0]) not in folders:
                    fs.create_dir(parent)
                    folders.add(parent)
                if fs.get_file_info(temporary).type == FileType.File:
                    fs.move(temporary, target)
                elif fs.get_file_info(target).type != FileType.File:
                    raise FileNotFoundError(temporary)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    try:
        with workspace(spark, "tiles") as keep:
            manifest = keep(tiles.select("path", "px", "class_index").mapInArrow(draw, MANIFEST), "manifest")
            moved = manifest.mapInArrow(move, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)))
            return moved.first()[0]
    finally:
        remove_dir(spark, staging)


def read_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, zoom, tile_col, tile_row, px, class_index)`` of the images below a folder of layers; ``path`` counts from the folder."""
    _, decode = _png()

    def parse(batches):
        import pyarrow as pa

        for batch in batches:
            read = [decode(data) for data in batch.column(1).to_pylist()]
            kind = pa.list_(pa.int32())
            px, classes = (pa.array([r[i].tolist() for r in read], kind) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), px, classes], names=["path", "px", "class_index"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png").load(folder)
    root = unquote(folder).rstrip("/").rpartition("/")[2]
    address = F.regexp_extract("path", r"([^/]+/\d+/\d+/\d+\.png)$", 1)
    rows = files.select(address.alias("path"), "content").mapInArrow(parse, "path string, px array<int>, class_index array<int>")
    part = lambda i: F.regexp_extract("path", r"(\d+)/(\d+)/(\d+)\.png$", i).cast("int")
    return rows.select(F.concat(F.lit(f"{root}/"), "path").alias("path"), part(1).alias("zoom"), part(2).alias("tile_col"), part(3).alias("tile_row"), "px", "class_index")
