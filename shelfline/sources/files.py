"""Files in whatever file system a path names, through Spark's own client."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs


def _located(spark: SparkSession, path: str):
    """The path and its file system."""
    at = _hadoop(spark).Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _located(spark, path)
    return system.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted, without hidden ones; none if there is no folder."""
    at, system = _located(spark, path)
    if not system.exists(at):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(at)]
    return sorted(n for n in names if n[0] not in "._")


def is_file(spark: SparkSession, path: str) -> bool:
    at, system = _located(spark, path)
    return system.exists(at) and system.getFileStatus(at).isFile()


def length(spark: SparkSession, path: str) -> int:
    at, system = _located(spark, path)
    return system.getFileStatus(at).getLen()


def sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and bytes of the files in a folder, by name, without hidden ones; none if there is no folder."""
    at, system = _located(spark, path)
    found = system.listStatus(at) if system.exists(at) else []
    named = sorted((entry.getPath().getName(), entry.getLen()) for entry in found)
    return [(f"{path}/{name}", size) for name, size in named if name[0] not in "._"]


def _concatenates(at, system) -> bool:
    return system.hasPathCapability(at, "fs.capability.paths.concat")


def can_join(spark: SparkSession, path: str) -> bool:
    """Whether the path's store makes one file of several without one writer for all of it."""
    at, system = _located(spark, path)
    return _concatenates(at, system) or system.getUri().getScheme() == "file"


def join(spark: SparkSession, parts: Sequence[tuple[str, int]], target: str) -> str:
    """Make the files (path and bytes) one new file, in their order; returns its path.

    HDFS and its like do so by name; there the first becomes the target, which is to lie in
    the folder of the others. In a shared folder every part is copied to its place by a task.
    """
    at, system = _located(spark, target)
    if _concatenates(at, system):
        (first, *rest), fs = [path for path, _ in parts], _hadoop(spark)
        move(spark, first, target)
        if rest:
            others = spark.sparkContext._gateway.new_array(fs.Path, len(rest))
            for i, path in enumerate(rest):
                others[i] = fs.Path(path)
            system.concat(at, others)
        return target
    plain, places, start = at.toUri().getPath(), [], 0
    for number, (path, size) in enumerate(parts):
        places.append((number, _located(spark, path)[0].toUri().getPath(), start, size))
        start += size

    def copy(batches):
        import os

        for batch in batches:
            for place in batch.to_pylist():
                out, at = os.open(plain, os.O_WRONLY | os.O_CREAT, 0o644), place["start"]
                with open(place["path"], "rb") as source:
                    while block := source.read(1 << 22):
                        while block:
                            done = os.pwrite(out, block, at)
                            at, block = at + done, block[done:]
                os.close(out)
                if at != place["start"] + place["bytes"]:
                    raise OSError(f"{place['path']} has other bytes than when it was written")
            yield batch

    table = spark.createDataFrame(places, "number int, path string, start bigint, bytes bigint")
    each = table.repartitionById(len(places), F.col("number"))
    each.mapInArrow(copy, table.schema).agg(F.count(F.lit(1))).collect()
    return target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    at, system = _located(spark, path)
    system.delete(at, True)


def move(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> None:
    """Give a file a new path, in one step where the file system has it; else as its client does.

    Without ``overwrite`` a target that is there is an error.
    """
    fs = _hadoop(spark)
    options = getattr(fs, "Options$Rename")
    kinds = spark.sparkContext._gateway.new_array(options, 1)
    kinds[0] = options.OVERWRITE if overwrite else options.NONE
    at = fs.Path(target)
    context = fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()) if at.toUri().getScheme() else fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    context.rename(fs.Path(source), at, kinds)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file, whole or not at all; an error if it is there."""
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    at, system = _located(spark, aside)
    out = system.create(at)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, aside, path)


def read_text(spark: SparkSession, path: str) -> str:
    at, system = _located(spark, path)
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    at, system = _located(spark, path)
    stream = system.open(at)
    try:
        java = spark._jvm.java.io
        return java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
