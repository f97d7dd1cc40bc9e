"""Small files of the driver's own (pointers, marks) in any store that Spark reads.

They go through Hadoop's FileSystem, so a path means the same as to a reader or a
writer of data.  A file is written under another name and renamed, and never
changed afterwards: it is there whole or not at all."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


#: Start of a URI whose host is empty: ``file:///x`` and ``file:/x`` are one path.
EMPTY_HOST = r"^([^:/]+):///"


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Write a file that is not there yet.  One that is there stays if it says the
    same; other content is an error, or with ``replace`` gives way."""
    fs, p = _at(spark, path)
    held = get_text(spark, path)
    if held is not None:
        if held == text:
            return
        if not replace:
            raise FileExistsError(f"{path} is there with other content")
        fs.delete(p, False)
    _, part = _at(spark, f"{p.getParent().toString()}/.part-{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, p):
        fs.delete(part, False)
        raise FileExistsError(f"{path} was written by another")


def get_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones; none where the folder is absent."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(n for n in found if not n.startswith(".") and n != "_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the files below a folder, without hidden ones, by path."""
    fs, p = _at(spark, path)
    found, walk = [], fs.listFiles(p, True)
    while walk.hasNext():
        at = walk.next().getPath()
        if not at.getName().startswith((".", "_")):
            found.append(at.toString())
    return sorted(found)


def uri_of(spark: SparkSession, path: str) -> str:
    """The path as the ``_metadata.file_path`` of its rows, but for the slashes of an empty host
    (see :data:`EMPTY_HOST`)."""
    return re.sub(EMPTY_HOST, r"\1:/", spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString())


def set_times(spark: SparkSession, paths: list[str], first_ms: int) -> int:
    """Give the files modification times one millisecond apart, in the order of the list;
    returns the first time after them.  A store that does not keep times is an error."""
    for i, path in enumerate(paths):
        fs, p = _at(spark, path)
        fs.setTimes(p, first_ms + i, -1)
    if paths:
        fs, p = _at(spark, paths[0])
        if fs.getFileStatus(p).getModificationTime() != first_ms:
            raise RuntimeError(f"the store of {paths[0]} keeps no set times: a file stream cannot be put in order there")
    return first_ms + len(paths)
