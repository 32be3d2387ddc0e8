"""Folders as Hadoop file systems show them to the driver: what is in one, small records in them, and
taking things away."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without drafts and checksums; none if there is no such folder."""
    system, place = _open(spark, path)
    if not system.exists(place):
        return []
    names = (status.getPath().getName() for status in system.listStatus(place))
    return sorted(name for name in names if not name.startswith("."))


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files and folders; what is gone already is no error, so it can be repeated."""
    for path in paths:
        system, place = _open(spark, path)
        system.delete(place, True)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as plans name it."""
    system, place = _open(spark, path)
    return system.makeQualified(place).toString()


def stamp(spark: SparkSession, path: str) -> tuple:
    """What tells that the files of a folder have changed: their names, lengths and times."""
    system, place = _open(spark, path)
    found = system.listStatus(place)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see all of it or nothing. There must be none of that name."""
    folder, name = os.path.split(path)
    draft = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
    system, place = _open(spark, draft)
    out = system.create(place, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if not system.rename(place, _open(spark, path)[1]):
        raise FileExistsError(path)


def text_of(spark: SparkSession, path: str) -> str:
    system, place = _open(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
