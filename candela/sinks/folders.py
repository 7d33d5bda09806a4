"""Folders of a table, through the file system that Spark reads and writes them with."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, in order; none if it is not there."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path``, in order; none if it is not there."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isFile())


def file_times(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time) of the files directly in ``path``."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted((s.getPath().getName(), int(s.getModificationTime())) for s in fs.listStatus(where) if s.isFile())


def make(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.mkdirs(where)


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file; the copy appears whole, by one rename."""
    fs, where = _at(spark, target)
    there, origin = _at(spark, source)
    parent, _, name = target.rpartition("/")
    draft = _at(spark, f"{parent}/.{name}.draft")[1]
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(there, origin, fs, draft, False, True, spark._jsc.hadoopConfiguration())
    if not fs.rename(draft, where):
        raise OSError(target)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that appears whole, by one rename; one that is there is an error."""
    fs, where = _at(spark, path)
    draft = _at(spark, f"{path}.{uuid.uuid4().hex[:8]}.draft")[1]
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(where) or not fs.rename(draft, where):
        fs.delete(draft, False)
        raise FileExistsError(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def take_file(spark: SparkSession, folder: str, target: str) -> None:
    """Move the one data file of ``folder`` to ``target``."""
    fs, where = _at(spark, folder)
    found = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("part-")]
    if len(found) != 1 or not fs.rename(found[0], _at(spark, target)[1]):
        raise OSError(f"{folder} has {len(found)} files for {target}")


def name_files(spark: SparkSession, staged: str, path: str, suffix: str) -> None:
    """Move the one file of every ``column=value`` folder of ``staged`` to ``<path>/<value>.<suffix>``."""
    fs, base = _at(spark, staged)
    target = _at(spark, path)[1]
    fs.mkdirs(target)
    for name in subfolders(spark, staged):
        value = unquote(name.partition("=")[2])
        if "/" in value:
            raise ValueError(f"{value!r} is not a file name")
        files = [s.getPath() for s in fs.listStatus(_at(spark, f"{staged}/{name}")[1])
                 if s.getPath().getName().startswith("part-")]
        if len(files) != 1:
            raise ValueError(f"{name} has {len(files)} files")
        named = _at(spark, f"{path}/{value}.{suffix}")[1]
        fs.delete(named, False)  # a rename does not replace
        if not fs.rename(files[0], named):
            raise OSError(f"{named} could not be written")
    fs.delete(base, True)
