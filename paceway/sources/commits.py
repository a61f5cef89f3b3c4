"""Versions of a catalog: one small file says which folders hold its levels, and it is published whole.

A write puts its files below ``<kind>/version=<id>``, where nobody looks yet, and then publishes commit ``log/<number>.json``: for every level ``(kind, layer, zoom)`` the
version that holds it. The commit is written under another name and renamed to the next number, which fails if that number is taken; the writer then reads what the
other one published, adds its own levels and tries the next number. So readers see all of a write or nothing, a writer that dies leaves the old levels as they are, and of two
writers none undoes the levels of the other. The file system has to refuse a rename to an existing name, as HDFS and local ones do.

A commit lists the levels of a catalog (layers times zooms), not their tiles, so it stays small whatever the layers hold.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from paceway.runtime import remove_dir

Level = tuple[str, str, int]


class LevelExists(ValueError):
    """An append met a level that the catalog has."""


def _hadoop(spark: SparkSession, path: str):
    """The path as an object of the file system, and that file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    where, fs = _hadoop(spark, f"{path}/log")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))


def _commit(spark: SparkSession, path: str, number: int) -> dict[Level, str]:
    where, fs = _hadoop(spark, f"{path}/log/{number:012d}.json")
    stream = fs.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {(kind, layer, zoom): version for kind, layer, zoom, version in json.loads(text)}


def _publish_as(spark: SparkSession, path: str, number: int, levels: dict[Level, str]) -> bool:
    """Whether the commit got the number."""
    jvm = spark.sparkContext._jvm
    draft, fs = _hadoop(spark, f"{path}/log/_{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps([[*level, version] for level, version in sorted(levels.items())]).encode()))
    stream.close()
    target, _ = _hadoop(spark, f"{path}/log/{number:012d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), plain)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def current(spark: SparkSession, path: str) -> dict[Level, str]:
    """The version that holds each level now."""
    numbers = _numbers(spark, path)
    return _commit(spark, path, numbers[-1]) if numbers else {}


def refuse(known: dict[Level, str], levels: list[Level]) -> None:
    """Raise if one of the levels is there already."""
    met = sorted(set(known) & set(levels))
    if met:
        raise LevelExists("the catalog has " + ", ".join(f"{layer!r} at zoom {zoom} ({kind})" for kind, layer, zoom in met))


def publish(spark: SparkSession, path: str, levels: list[Level], version: str, append: bool = False) -> int:
    """Make the version what readers see of these levels; the number of the commit. ``append`` refuses levels that exist, also those that another writer publishes meanwhile."""
    while True:
        numbers = _numbers(spark, path)
        known = _commit(spark, path, numbers[-1]) if numbers else {}
        if append:
            refuse(known, levels)
        number = numbers[-1] + 1 if numbers else 0
        if _publish_as(spark, path, number, known | dict.fromkeys(levels, version)):
            return number


def expire(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of versions that were published once and that the newest commit does not name any more; folders of writers at work are left. No reader may be on an older commit."""
    numbers = _numbers(spark, path)
    if not numbers:
        return []
    named = {(kind, version) for (kind, _, _), version in _commit(spark, path, numbers[-1]).items()}
    once = {(kind, version) for number in numbers[:-1] for (kind, _, _), version in _commit(spark, path, number).items()}
    gone = sorted(once - named)
    for kind, version in gone:
        for folder in (kind, "meta") if kind == "tiles" else (kind,):
            remove_dir(spark, f"{path}/{folder}/version={version}")
    for number in numbers[:-1]:
        where, fs = _hadoop(spark, f"{path}/log/{number:012d}.json")
        fs.delete(where, False)
    return [version for _, version in gone]
