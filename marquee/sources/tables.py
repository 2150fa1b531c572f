"""Writing parquet tables: overwrite, overwrite by partition, and upsert in place.

What is to be replaced stays until its successor is complete and published in one step (``versions``), so a failed job
or a driver that dies costs nothing. Tasks are retried by Spark as usual; nothing is kept on an executor.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from marquee.operators.landing import by_hash, has_key, one_per_key, upsert
from marquee.sources import paths, versions
from marquee.sources.files import scan_table


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table is there. A replacement by renaming, as it was done formerly, that was interrupted half way is undone first."""
    if not paths.exists(spark, path) and paths.exists(spark, _previous(path)):
        paths.rename(spark, _previous(path), path)
    return paths.exists(spark, path)


def _previous(path: str) -> str:
    return f"{path}__previous"


def beside(path: str, what: str) -> str:
    """A folder next to a table, which all executors see, under a name that no other run has."""
    return f"{path}__{what}-{uuid4().hex}"


ROWS_PER_TASK = 1_000_000


def evenly(
    df: DataFrame, partition_by: str | None = None, rows_per_task: int = ROWS_PER_TASK, counted: DataFrame | None = None
) -> DataFrame:
    """Rows gathered by partition value, in tasks of even size.

    Writing many partition values without this gives every task a file in every partition. A count of rows
    per value, combined before its shuffle, says into how many parts a value is to be cut; its rows go to
    these by a hash of all columns. AQE joins small values into one task. ``df`` is read twice, so it should
    be a stored table; or ``counted`` is one that has at least as many rows of each value, and is counted instead.
    """
    if partition_by is None:
        return df.hint("rebalance")
    value = F.col(partition_by)
    # One row for each directory of the table.
    rows = df if counted is None else counted
    parts = rows.groupBy(value.alias("_value")).agg(F.ceil(F.count(F.lit(1)) / rows_per_task).cast("int").alias("_parts"))
    parts = parts.filter(F.col("_parts") > 1)
    cut = df.join(F.broadcast(parts), value.eqNullSafe(F.col("_value")), "left")
    part = F.pmod(F.xxhash64(*df.columns), F.coalesce("_parts", F.lit(1)))
    return cut.withColumn("_part", part).hint("rebalance", partition_by, "_part").select(*df.columns)


def overwrite_table(
    df: DataFrame, path: str, partition_by: str | None = None, sources: dict[str, int] | None = None
) -> None:
    """Replace the whole table, schema included. ``sources`` are the versions of the tables that ``df`` was made from.

    The new rows are files of their own, which take the place of the old ones when they are complete and
    published in one step, so ``df`` may read the table it replaces, and a reader sees either.
    """
    spark = df.sparkSession
    table_exists(spark, path)
    replaced = versions.stored(spark, path)
    files = versions.written(df, path, partition_by)
    versions.publish(spark, path, replaced, df.schema, dict.fromkeys(files, ""), sources)


def append_table(df: DataFrame, path: str, partition_by: str | None = None, batch: str = "") -> None:
    """Add rows. Those of a named batch replace the rows that an earlier attempt at it has added."""
    spark = df.sparkSession
    replaced = versions.stored(spark, path)
    kept = {name: own for name, own in replaced.files.items() if not batch or own != batch}
    schema = replaced.schema or (scan_table(spark, path).select(*df.columns).schema if replaced.files else df.schema)
    files = versions.written(df, path, partition_by)
    versions.publish(spark, path, replaced, schema, kept | dict.fromkeys(files, batch))


def compact_table(spark: SparkSession, path: str, partition_by: str | None, most_files: int) -> bool:
    """Pack a table of more than ``most_files`` files into few, a replacement like any other; whether that was done.

    Its rows no longer belong to the batches that brought them.
    """
    version = versions.current(spark, path)
    if version is None or len(version.files) <= most_files:
        return False
    overwrite_table(evenly(versions.read(spark, path, version), partition_by), path, partition_by)
    return True


def _is_one_of(column: str, values: list) -> Column:
    """Membership in a list that may contain NULL: never NULL itself, and it prunes partitions."""
    known = [v for v in values if v is not None]
    is_known = F.coalesce(F.col(column).isin(known), F.lit(False)) if known else F.lit(False)
    return is_known | F.col(column).isNull() if len(known) < len(values) else is_known


def _empty_as_null(df: DataFrame, partition_by: str) -> DataFrame:
    """Empty text in the partition column as NULL: Spark stores both in the same directory."""
    if not isinstance(df.schema[partition_by].dataType, StringType):
        return df
    return df.withColumn(partition_by, F.nullif(F.col(partition_by), F.lit("")))


def replace_partition(df: DataFrame, path: str, partition_by: str, value: str | None) -> None:
    """Replace the rows of one partition value; rows of ``df`` with another value are refused.

    Without rows in ``df`` the partition is removed. ``df`` may read the same table. Empty text and NULL are
    the same partition, that of NULL.
    """
    spark = df.sparkSession
    df, value = _empty_as_null(df, partition_by), None if value == "" else value
    table_exists(spark, path)
    refused = F.concat_ws(" ", F.lit(f"row outside partition {value}:"), F.col(partition_by).cast("string"))
    inside = F.when(F.col(partition_by).eqNullSafe(F.lit(value)), True).otherwise(F.raise_error(refused))
    replaced = versions.stored(spark, path)
    schema = replaced.schema or df.schema
    old = set()
    if replaced.files:
        rows = versions.read(spark, path, replaced, StructType(df.schema.fields)).filter(_is_one_of(partition_by, [value]))
        old = _named(rows.select(F.col("_metadata.file_path").alias(FILE)), path)
    files = versions.written(df.filter(inside), path, partition_by)
    kept = {name: batch for name, batch in replaced.files.items() if name not in old}
    versions.publish(spark, path, replaced, schema, kept | dict.fromkeys(files, ""))


FILE = "_file_of_row"


def _named(rows: DataFrame, path: str) -> set[str]:
    """The files in the column FILE, by their path below the table's folder; as many as there are files at most."""
    return {versions.below(rows.sparkSession, path, row[0]) for row in rows.select(FILE).distinct().collect()}


def _files_of(found: DataFrame, table: DataFrame, path: str) -> set[str]:
    """The files whose codes are in the column FILE of rows that were found among those of a table, as ``_named``.

    A row carries the code of its file through a shuffle, not the long name. If two files had the same, both would count.
    """
    codes = {row[0] for row in found.select(FILE).distinct().collect()}
    if not codes:
        return set()
    names = table.select(F.col("_metadata.file_path").alias("name")).distinct().select("name", F.xxhash64("name").alias(FILE))
    return {versions.below(table.sparkSession, path, row["name"]) for row in names.collect() if row[FILE] in codes}


def _located(table: DataFrame, keys: list[str]) -> DataFrame:
    return table.select(*keys, F.xxhash64(F.col("_metadata.file_path")).alias(FILE))


def upsert_table(
    source: DataFrame,
    path: str,
    keys: list[str],
    partition_by: str | None = None,
    on_duplicate: str = "error",
    order_by: list[str] | None = None,
    add_columns: bool = False,
    keep: Column | None = None,
    sources: dict[str, int] | None = None,
    stored: bool = False,
) -> None:
    """Upsert into a stored table. ``sources`` says what it holds then, as in ``overwrite_table``.

    The source must have all columns of the table, because a matched row is replaced as a whole. It may bring
    further ones only with ``add_columns``; rows that stay then have NULL there. With ``keep``, source rows
    that don't fulfil it replace the row of their key by nothing.

    Only files that hold a row with a key of the source are rewritten; the others stay as they are. To find them
    the keys of the table are read, once, and nothing else. A row may move to another partition, and a
    partition that loses all its rows is gone. The table is replaced in one step.

    The source is written to a table beside this one first, because it is used more than once and may be
    expensive to read (gzip text is decoded by one task per file). That is left out if the source reads a ``stored``
    table without much work.
    """
    spark = source.sparkSession
    table_exists(spark, path)
    if on_duplicate not in ("error", "last", "all"):
        raise ValueError(f"on_duplicate must be 'error', 'last' or 'all', not {on_duplicate!r}")
    if on_duplicate == "last" and not order_by:
        raise ValueError("on_duplicate='last' needs order_by")
    _check_columns(source, path, add_columns)
    if partition_by:
        source = _empty_as_null(source, partition_by)
    scratch = beside(path, "batch")
    try:
        batch = source
        if not stored:
            source.write.parquet(f"{scratch}/rows")
            batch = spark.read.schema(source.schema).parquet(f"{scratch}/rows")
        if on_duplicate == "error":
            refuse_duplicates(batch, keys)
        elif on_duplicate == "last":
            batch = one_per_key(batch, keys, order_by)
        batch_keys = batch.filter(has_key(keys)).select(*keys)
        if on_duplicate != "error":
            batch_keys.distinct().write.parquet(f"{scratch}/keys")
            batch_keys = spark.read.schema(batch_keys.schema).parquet(f"{scratch}/keys")
        _upsert_files(batch, by_hash(batch_keys), path, keys, partition_by, keep, sources)
    finally:
        paths.delete(spark, scratch)


def _upsert_files(
    batch: DataFrame,
    batch_keys: DataFrame,
    path: str,
    keys: list[str],
    partition_by: str | None,
    keep: Column | None,
    sources: dict[str, int] | None = None,
) -> None:
    spark = batch.sparkSession
    replaced = versions.stored(spark, path)
    read = lambda files=None: versions.read(spark, path, replaced, batch.schema, files)
    touched = set()
    if replaced.files:
        touched = _files_of(_located(read(), keys).join(batch_keys, keys, "left_semi"), read(), path)
    target = read(sorted(touched))
    merged = upsert(target, batch, keys, "all", source_keys=batch_keys)
    if keep is not None:
        merged = merged.filter(keep)
    # No value can have more rows than before and in the batch, and these are counted without meeting each other.
    counted = target.select(partition_by).unionByName(batch.select(partition_by)) if partition_by else None
    files = versions.written(evenly(merged, partition_by, counted=counted), path, partition_by)
    kept = {name: own for name, own in replaced.files.items() if name not in touched}
    versions.publish(spark, path, replaced, batch.schema, kept | dict.fromkeys(files, ""), sources)


def replace_keys(
    rows: DataFrame,
    changed: DataFrame,
    path: str,
    key: str,
    partition_by: str | None = None,
    sources: dict[str, int] | None = None,
) -> None:
    """Put ``rows`` in place of all rows whose key is in ``changed``, and of those without a key.

    Unlike an upsert this also removes a key that has no rows any more. Files without such a key stay as they are; the
    other rows of a file that is rewritten are copied without a shuffle. Both frames should be stored tables.
    """
    spark = rows.sparkSession
    replaced = versions.stored(spark, path)
    read = lambda files=None: versions.read(spark, path, replaced, rows.schema, files)
    touched = set()
    if replaced.files:
        located = _located(read(), [key])
        without = located.filter(F.col(key).isNull())
        touched = _files_of(located.join(changed, key, "left_semi").unionByName(without), read(), path)
    others = read(sorted(touched)).filter(F.col(key).isNotNull()).join(changed, key, "left_anti").select(*rows.columns)
    files = versions.written(others.unionByName(evenly(rows, partition_by)), path, partition_by)
    kept = {name: own for name, own in replaced.files.items() if name not in touched}
    versions.publish(spark, path, replaced, rows.schema, kept | dict.fromkeys(files, ""), sources)


def _check_columns(source: DataFrame, path: str, add_columns: bool) -> None:
    try:
        stored = scan_table(source.sparkSession, path).columns
    except AnalysisException:  # no file says what the columns are
        return
    missing = [c for c in stored if c not in source.columns]
    added = [c for c in source.columns if c not in stored]
    if missing or added and not add_columns:
        raise ValueError(f"columns of source and table differ: missing {missing}, added {added}")


def refuse_duplicates(batch: DataFrame, keys: list[str]) -> None:
    """Looked for before anything is written, and also in a table without rows to compare with."""
    counted = batch.filter(has_key(keys)).groupBy(*keys).count()
    for row in counted.filter(F.col("count") > 1).limit(1).collect():
        raise ValueError(f"several source rows for key {' '.join(str(row[k]) for k in keys)}")
