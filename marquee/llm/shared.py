"""What the operators share: intermediate tables, the state of a Python worker, files in the shared folder."""

from __future__ import annotations

import ctypes
import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.paths import scratch_path


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared folder and read back: lineage is cut and lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


KEY = "__row_key"  # a column that tells rows apart which differ in id or text


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).isNull(), id_col, F.col(text_col).isNull(), text_col)


BROADCAST_ROWS = 1_000_000  # ids that may be sent to all executors, some 10 MB


def with_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    """Semi or anti join of docs with a frame of one column of ids; few ids are broadcast, more are shuffled.

    A null id is in ids if a row there is null.
    """
    found = ids.select(F.col(ids.columns[0]).alias("__id")).distinct()
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    return docs.join(found, docs[id_col].eqNullSafe(F.col("__id")), how)


TEXTS_AT_ONCE = 1000


def few_rows_a_batch(spark: SparkSession) -> None:
    """Lower the rows that this session sends to Python at once to TEXTS_AT_ONCE, if it sends more.

    Spark's 10,000 long rows take up memory four times: as vectors and as a stream in the JVM, outside its heap, and as
    a message and a batch in the worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXTS_AT_ONCE:
        spark.conf.set(name, str(TEXTS_AT_ONCE))


def give_back(keep: str | None = None) -> None:
    """Return what Arrow and the C library have freed, so that a worker does not keep the peak of an earlier task.

    What other operators than ``keep`` have left with ``worker_state`` goes too.
    """
    kept = sys.__dict__.get("_marquee_llm_state", {})
    for key in [key for key in kept if key != keep]:
        del kept[key]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few texts at a time; freed memory goes back before the first and after every batch."""
    give_back()
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(at, TEXTS_AT_ONCE)
        del batch
        give_back()


def labelled_texts(docs: DataFrame, labels: DataFrame, columns: list[str], rows: int, id_col: str, text_col: str) -> DataFrame:
    """key, body and the columns of labels, a row for each of `rows` labelled ids at most, chosen by a hash of the id.

    Label rows with a null are left out. Of several label rows of an id the greatest counts, of several documents the
    one of the least hash, so that repeated ids bring no more rows. The chosen labels, at most `rows`, are broadcast.
    """
    usable = labels.select(F.col(id_col).alias("key"), *columns).dropna().groupBy("key").agg(F.max(F.struct(*columns)).alias("label"))
    usable = staged(usable.select("key", "label.*"), "labels")
    place = F.xxhash64("key").cast("double")
    # The hashes are even, so that somewhat more than enough lie in this share of them; the limit is exact.
    share = 2.0 * (rows + 1000) / max(1, usable.count())
    chosen = usable.where(place < F.lit(-(2.0**63) + share * 2.0**63 * 2)) if share < 1 else usable
    chosen = chosen.withColumn("place", F.xxhash64("key")).orderBy("place", "key").limit(rows).drop("place")
    texts = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("body")).join(F.broadcast(chosen), "key")
    one = texts.groupBy("key", *columns).agg(F.min(F.struct(F.xxhash64("body").alias("place"), "body")).alias("text"))
    return one.select("key", "text.body", *columns)


def worker_state(key: str, make: Callable[[], object]) -> object:
    """Something that a Python worker builds once and keeps for its later tasks of the same operator."""
    kept = sys.__dict__.setdefault("_marquee_llm_state", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def filled(column: pa.Array) -> pa.Array:
    """Texts of a batch with null as empty text."""
    return pc.fill_null(column, "")


def file_system(path: str):
    """The file system of a path or URI, and the path in it, as a worker sees them."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def broadcast_file(spark: SparkSession, path: str):
    """The bytes of a vocabulary file, which has a fixed size, for all workers."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())
