"""Paths on whatever file system Spark is configured for."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; a pattern such as ``day/*.tsv.gz`` is there if it matches anything."""
    fs, hadoop_path = _at(spark, path)
    matches = fs.globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _at(spark, path)
    fs.delete(hadoop_path, True)


def rename(spark: SparkSession, source: str, destination: str) -> None:
    fs, source_path = _at(spark, source)
    _, destination_path = _at(spark, destination)
    if not fs.rename(source_path, destination_path):
        raise OSError(f"could not rename {source} to {destination}")


def plain(spark: SparkSession, path: str) -> str:
    """A path without scheme and host."""
    fs, hadoop_path = _at(spark, path)
    return fs.makeQualified(hadoop_path).toUri().getPath()


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there, or is a file or a pattern."""
    fs, hadoop_path = _at(spark, path)
    if not fs.exists(hadoop_path) or fs.getFileStatus(hadoop_path).isFile():
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def data_files(spark: SparkSession, path: str) -> list[str]:
    """All data files below a folder, by their path there; hidden names, as Spark sees them, are left out."""
    fs, hadoop_path = _at(spark, path)
    if not fs.exists(hadoop_path):
        return []
    start, found = len(plain(spark, path)) + 1, []
    files = fs.listFiles(hadoop_path, True)
    while files.hasNext():
        name = files.next().getPath().toUri().getPath()[start:]
        if not any(part.startswith((".", "_")) and "=" not in part for part in name.split("/")):
            found.append(name)
    return found


def stamps(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Length and modification time of every file that a path, a folder or a pattern names; hidden ones are left out."""
    fs, hadoop_path = _at(spark, path)
    found = {}
    for match in fs.globStatus(hadoop_path) or []:
        files = fs.listFiles(match.getPath(), True)
        while files.hasNext():
            status = files.next()
            if not status.getPath().getName().startswith((".", "_")):
                found[status.getPath().toString()] = [status.getLen(), status.getModificationTime()]
    return dict(sorted(found.items()))


def delete_file(spark: SparkSession, path: str, name: str) -> None:
    """Delete a file below a folder, and the folders between that are empty then."""
    delete(spark, f"{path}/{name}")
    while "/" in name:
        name = name.rsplit("/", 1)[0]
        fs, folder = _at(spark, f"{path}/{name}")
        if fs.exists(folder) and len(fs.listStatus(folder)):
            return
        fs.delete(folder, True)


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; an error if it is there."""
    fs, hadoop_path = _at(spark, path)
    stream = fs.create(hadoop_path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _at(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for an intermediate table, in the shared folder named by ``spark.checkpoint.dir``.

    If that is unset, a local session gets a temporary folder; on a cluster it is an error, because
    the executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"
