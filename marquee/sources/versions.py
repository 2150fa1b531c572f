"""Which files make up a stored table: a small file beside them says so for each version.

Data files only ever come under new names. A version is published by creating one file that lists its data
files, the highest complete one counts; so a reader sees the table before a replacement or after it, and
nothing is renamed. What no kept version lists is deleted after the next publication: files of replaced versions, and
what a run left that died before it published. One run writes to a table at a time; of two that replace the same
version, the second is refused.

A folder without such files is a plain table, all of whose files count; its first publication takes it over.

A version can name the versions of other tables that it was made from. Who makes such a table holds these, so that
their files stay until the next time, when the files that differ say which rows have changed since.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marquee.sources import paths

_NAME = re.compile(r"^_version-(\d{10})$")
_HOLD = re.compile(r"^_held-(\w+)-(\d{10})$")
_END = "end"
KEPT = "spark.marquee.keptVersions"  # how many earlier versions keep their files, for readers that still use them; 0 if unset


class Version(NamedTuple):
    number: int
    schema: StructType | None  # None for a plain table
    files: dict[str, str]  # path below the table's folder, and the name of the batch that brought it
    sources: dict[str, int] = {}  # tables that it was made from, and their versions


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = [_NAME.match(name) for name in paths.names(spark, path)]
    return sorted((int(m[1]) for m in found if m), reverse=True)


def _file(path: str, number: int) -> str:
    return f"{path}/_version-{number:010d}"


def _read(spark: SparkSession, path: str, number: int) -> Version | None:
    """None if the run that writes it has not come to its end."""
    lines = paths.read_text(spark, _file(path, number)).splitlines()
    if not lines or lines[-1] != _END:
        return None
    entries = [json.loads(line) for line in lines[1:-1]]
    sources = next((entry for entry in entries if isinstance(entry, dict)), {})
    return Version(number, StructType.fromJson(json.loads(lines[0])), dict(e for e in entries if isinstance(e, list)), sources)


def current(spark: SparkSession, path: str) -> Version | None:
    """The published version of a table; None if it has none, as a plain table."""
    for number in _numbers(spark, path):
        version = _read(spark, path, number)
        if version is not None:
            return version
    return None


def at(spark: SparkSession, path: str, number: int) -> Version | None:
    """A version by its number; None if it is no longer there."""
    return _read(spark, path, number) if number in _numbers(spark, path) else None


def stored(spark: SparkSession, path: str) -> Version:
    """As ``current``; of a plain table, all its files."""
    return current(spark, path) or Version(0, None, dict.fromkeys(paths.data_files(spark, path), ""))


def read(spark: SparkSession, path: str, version: Version, schema: StructType | None = None, files: list[str] | None = None) -> DataFrame:
    """The rows of a version, or of some of its files."""
    files = sorted(version.files) if files is None else files
    schema = schema or version.schema
    if not files:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    listed = [f"{path}/{f}" for f in files]
    return reader.parquet(*listed) if schema is None else reader.schema(schema).parquet(*listed).select(*schema.names)


def difference(spark: SparkSession, path: str, old: Version, new: Version, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that only the old version has, and of those that only the new one has.

    A rewritten file brings its unchanged rows on both sides, so these are to be set off against each other.
    """
    gone, added = sorted(old.files.keys() - new.files.keys()), sorted(new.files.keys() - old.files.keys())
    return read(spark, path, old, schema, gone), read(spark, path, new, schema, added)


def _holds(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    found = [_HOLD.match(name) for name in paths.names(spark, path)]
    return [(m[1], int(m[2])) for m in found if m]


def _hold_file(path: str, reader: str, number: int) -> str:
    return f"{path}/_held-{reader}-{number:010d}"


def hold(spark: SparkSession, path: str, reader: str, number: int) -> None:
    """Keep the files of a version for ``reader`` until it releases it."""
    if (reader, number) not in _holds(spark, path):
        paths.create_text(spark, _hold_file(path, reader, number), _END)


def release(spark: SparkSession, path: str, reader: str, but: int) -> None:
    """Give up what ``reader`` holds except one version; the files go with the next publication."""
    for name, number in _holds(spark, path):
        if name == reader and number != but:
            paths.delete(spark, _hold_file(path, reader, number))


def written(df: DataFrame, path: str, partition_by: str | None) -> list[str]:
    """Write rows as further files of the folder, which no version lists yet; their names."""
    spark = df.sparkSession
    before = set(paths.data_files(spark, path))
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return sorted(set(paths.data_files(spark, path)) - before)


def publish(
    spark: SparkSession,
    path: str,
    replaced: Version,
    schema: StructType,
    files: dict[str, str],
    sources: dict[str, int] | None = None,
) -> None:
    """Make ``files`` the table, in one step, in place of the version that the caller has read."""
    entries = [json.dumps(item) for item in files.items()] + ([json.dumps(sources)] if sources else [])
    text = "\n".join([json.dumps(schema.jsonValue()), *entries, _END])
    number = max([replaced.number, *_numbers(spark, path)]) + 1
    latest = current(spark, path)
    if latest is not None and latest.number != replaced.number:
        raise RuntimeError(f"another run has replaced {path}")
    try:
        paths.create_text(spark, _file(path, number), text)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception):
            raise RuntimeError(f"another run has replaced {path}") from error
        raise
    clean(spark, path)


def clean(spark: SparkSession, path: str) -> None:
    """Delete what neither the current version nor one of those that are kept or held lists."""
    kept: dict[int, Version] = {}
    wanted = 1 + int(spark.conf.get(KEPT, "0"))
    held = {number for _, number in _holds(spark, path)}
    for number in _numbers(spark, path):
        if len(kept) < wanted or number in held:
            version = _read(spark, path, number)
            if version is not None:
                kept[number] = version
    if not kept:
        return
    listed = {f for version in kept.values() for f in version.files}
    for name in paths.data_files(spark, path):
        if name not in listed:
            paths.delete_file(spark, path, name)
    for number in _numbers(spark, path):
        if number not in kept and number < max(kept):
            paths.delete(spark, _file(path, number))


def below(spark: SparkSession, path: str, uri: str) -> str:
    """The name of a file below the table's folder, given as Spark reports it in ``_metadata.file_path``."""
    return unquote(urlparse(uri).path)[len(paths.plain(spark, path)) + 1 :]
