"""Reading raw files and stored tables."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.sources import versions
from marquee.specs import NULL_TOKEN

TABLE_FORMATS = ("parquet", "delta")


def scan_tsv(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None, header: bool = True
) -> DataFrame:
    """Tab separated text, compressed according to its extension; ``\\N`` is NULL.

    Quotes have no meaning, so a field that starts with a stray one does not swallow its neighbours.
    With a schema, the header must name the same columns. Without one the types are inferred, which
    reads the input twice. A gzip file is read by one task: give large inputs as many part files
    (``path`` may be a directory, a pattern or a list), or in a splittable form such as bzip2.
    """
    reader = spark.read.options(sep="\t", header=header, nullValue=NULL_TOKEN, quote="", enforceSchema=False)
    if schema is None:
        return reader.csv(path, inferSchema=True)
    return reader.csv(path, schema=schema)


BAD_LINE = "_bad_line"


def header_schema(spark: SparkSession, path: str | list[str]) -> StructType:
    """The columns that the header names, all as text."""
    return spark.read.options(sep="\t", header=True, quote="", inferSchema=False).csv(path).schema


def scan_tsv_checked(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """As ``scan_tsv``, with a column ``_bad_line``: the line, if it has another number of fields or a value that does not fit.

    Write the frame to a table before anything else: Spark looks at a line only as far as a query needs it.
    """
    options = {"sep": "\t", "header": True, "nullValue": NULL_TOKEN, "quote": "", "enforceSchema": False}
    checked = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    return spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE).csv(path, schema=checked)


class Drift(NamedTuple):
    """How a header differs from a schema: names that it lacks, names that it has besides, and whether the others changed places."""

    missing: tuple[str, ...]
    extra: tuple[str, ...]
    moved: bool


def _by_name(header: StructType, schema: StructType) -> dict[str, StructField]:
    """The fields of the schema by their names in the header; case does not matter, as in Spark."""
    known = {field.name.lower(): field for field in schema}
    return {name: known[name.lower()] for name in header.names if name.lower() in known}


def drift(header: StructType, schema: StructType) -> Drift:
    found = _by_name(header, schema)
    there = [field.name for field in found.values()]
    return Drift(
        tuple(name for name in schema.names if name not in there),
        tuple(name for name in header.names if name not in found),
        there != [name for name in schema.names if name in there],
    )


def reconciled_schema(header: StructType, schema: StructType, required: Iterable[str] = ()) -> StructType:
    """What a file with this header is read with: the schema's types in the header's order, and text for what the schema lacks.

    A column of ``required`` that is not there is an error, as is a column with the name that bad lines are kept under.
    A file without any line has no header and is read as an empty one.
    """
    if not header.names:
        return schema
    there = {name.lower() for name in header.names}
    lacking = [name for name in required if name.lower() not in there]
    if lacking:
        raise ValueError(f"the CSV header lacks {', '.join(lacking)}; it names {', '.join(header.names)}")
    if BAD_LINE in header.names:
        raise ValueError(f"the CSV header names {BAD_LINE}, which is kept for bad lines")
    found = _by_name(header, schema)
    return StructType([StructField(name, found[name].dataType if name in found else StringType()) for name in header.names])


def with_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of the schema in its order, by name; NULL where the frame has none, and without what it has besides."""
    names = {field.name: name for name, field in _by_name(df.schema, schema).items()}
    return df.select(
        *[(F.col(f"`{names[f.name]}`") if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    )


def scan_tsv_reconciled(
    spark: SparkSession, path: str | list[str], schema: StructType, required: Iterable[str] = ()
) -> tuple[DataFrame, Drift]:
    """As ``scan_tsv``, for files whose header has the columns in another order, has further ones, or lacks some; and what differs.

    Columns are told by name. What is missing is NULL unless it is ``required``; what is unknown is left out. The header
    of the first file counts, and files whose header is another one are refused while they are read.
    """
    header = header_schema(spark, path)
    read = scan_tsv(spark, path, reconciled_schema(header, schema, required))
    return with_schema(read, schema), drift(header, schema) if header.names else Drift((), (), False)


def scan_table(
    spark: SparkSession, path: str, schema: StructType | None = None, table_format: str = "parquet"
) -> DataFrame:
    """A stored table, as its published version says. A schema fixes the type of the partition column and the order of the columns."""
    if table_format == "parquet":
        version = versions.current(spark, path)
        if version is not None:
            return versions.read(spark, path, version, schema)
    reader = spark.read.format(table_format)
    if schema is None:
        return reader.load(path)
    return reader.schema(schema).load(path).select(*schema.names)


def read_source(
    spark: SparkSession,
    path: str,
    file_format: str,
    schema: StructType | None = None,
    header: bool = True,
) -> DataFrame:
    """Read ``tsv``, ``parquet`` or ``delta`` (if its connector is installed); nothing else."""
    if file_format == "tsv":
        return scan_tsv(spark, path, schema, header)
    if file_format in TABLE_FORMATS:
        return scan_table(spark, path, schema, file_format)
    raise ValueError(f"unsupported format {file_format!r}: use tsv, {', '.join(TABLE_FORMATS)}")
