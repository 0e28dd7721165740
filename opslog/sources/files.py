"""The few file-system calls the lake needs besides reading and writing tables."""

from __future__ import annotations

import os
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    is_folder: bool
    modified: float


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    system, place = _place(spark, path)
    return system.getContentSummary(place).getLength()


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What lies right in a folder, by name; nothing if there is no such folder."""
    system, place = _place(spark, folder)
    try:
        found = system.listStatus(place)
    except Py4JJavaError as missing:
        if "FileNotFoundException" not in missing.java_exception.getClass().getName():
            raise
        return []
    return sorted((
        Entry(e.getPath().getName(), e.getPath().toString(), e.isDirectory(), e.getModificationTime() / 1000)
        for e in found), key=lambda e: e.name)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file only if it is not there; false if it is. One of several callers succeeds.

    The file systems of clusters do this on their own. That of a local disk only looks before
    it writes, so there the operating system is asked for an exclusive creation.
    """
    system, place = _place(spark, path)
    system.mkdirs(place.getParent())
    if system.getUri().getScheme() == "file":
        try:
            with open(os.open(place.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY), "w") as file:
                file.write(text)
        except FileExistsError:
            return False
        return True
    try:
        stream = system.create(place, False)
    except Py4JJavaError as taken:
        if "AlreadyExists" not in taken.java_exception.getClass().getName():
            raise
        return False
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; None if it is not there."""
    system, place = _place(spark, path)
    try:
        stream = system.open(place)
    except Py4JJavaError as missing:
        if "FileNotFoundException" not in missing.java_exception.getClass().getName():
            raise
        return None
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a name that is not taken, as one step."""
    system, place = _place(spark, source)
    _, there = _place(spark, target)
    system.mkdirs(there.getParent())
    if system.exists(there) or not system.rename(place, there):
        raise FileExistsError(f"{source} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)
