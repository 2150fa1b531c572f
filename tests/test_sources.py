import gzip
import tempfile
from pathlib import Path
from unittest.mock import MagicMock

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marquee.operators import landing
from marquee.sources import tables
from marquee.sources import paths
from marquee.sources.files import read_source, scan_table, scan_tsv
from marquee.sources.tables import (
    append_table,
    beside,
    evenly,
    overwrite_table,
    replace_partition,
    table_exists,
    upsert_table,
)
from marquee.specs import NAME_BASICS, TITLE_PRINCIPALS, TITLE_RATINGS

HEADER = "nconst\tprimaryName\tbirthYear\tdeathYear\tprimaryProfession\tknownForTitles"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def write_gzip(path, *lines):
    with gzip.open(path, "wt", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")
    return str(path)


def directories(path):
    return sorted(p.name for p in Path(path).iterdir() if p.is_dir())


def test_scan_tsv(spark, tmp_path, rows):
    file = write_gzip(
        tmp_path / "names.tsv.gz",
        HEADER,
        "nm1\tAnn\t1970\t\\N\tactor,writer\ttt1,tt2",
        'nm2\t"Bob\t1971.5\t40000\t\\N\t\\N',
        'nm3\tCid "the" D\tx\t2015\ta\\b\ttt1',
    )
    assert rows(scan_tsv(spark, file, NAME_BASICS.schema)) == [
        ("nm1", "Ann", 1970, None, "actor,writer", "tt1,tt2"),
        ("nm2", '"Bob', None, None, None, None),
        ("nm3", 'Cid "the" D', None, 2015, "a\\b", "tt1"),
    ]


def test_scan_tsv_many_files(spark, tmp_path):
    for i in range(3):
        write_gzip(tmp_path / f"part{i}.tsv.gz", HEADER, f"nm{i}\tAnn\t1970\t\\N\tactor\ttt1")
    for source in (str(tmp_path), str(tmp_path / "*.tsv.gz"), [str(tmp_path / f"part{i}.tsv.gz") for i in range(3)]):
        assert scan_tsv(spark, source, NAME_BASICS.schema).count() == 3


def test_scan_tsv_checks_the_header(spark, tmp_path):
    file = write_gzip(tmp_path / "r.tsv.gz", "numVotes\tconst\tx", "1\ttt1\t7.5")
    with pytest.raises(Exception, match="CSV header does not conform"):
        scan_tsv(spark, file, TITLE_RATINGS.schema).collect()


def test_scan_tsv_reads_some_columns(spark, tmp_path, rows):
    file = write_gzip(tmp_path / "r.tsv.gz", "tconst\taverageRating\tnumVotes", "tt1\t7.5\t10")
    df = scan_tsv(spark, file, TITLE_RATINGS.schema)
    assert rows(df.select("numVotes")) == [(10,)]
    assert rows(df.select("numVotes", "tconst").filter("averageRating > 7")) == [(10, "tt1")]


def test_scan_tsv_infers_types_without_schema(spark, tmp_path, rows):
    file = write_gzip(tmp_path / "a.tsv.gz", "titleId\tordering", "tt1\t1", "tt2\t\\N")
    df = scan_tsv(spark, file)
    assert df.schema["ordering"].dataType.simpleString() == "int"
    assert rows(df) == [("tt1", 1), ("tt2", None)]


def test_scan_tsv_without_header(spark, tmp_path, rows):
    file = write_gzip(tmp_path / "r.tsv.gz", "tt1\t7.5\t10")
    assert rows(scan_tsv(spark, file, TITLE_RATINGS.schema, header=False)) == [("tt1", 7.5, 10)]


def test_read_source(spark, path, tmp_path, rows):
    spark.range(3).write.parquet(path)
    assert rows(read_source(spark, path, "parquet")) == [(0,), (1,), (2,)]
    file = write_gzip(tmp_path / "r.tsv.gz", "tconst\taverageRating\tnumVotes", "tt1\t7.5\t10")
    assert rows(read_source(spark, file, "tsv", TITLE_RATINGS.schema)) == [("tt1", 7.5, 10)]
    for unsupported in ("csv", "json", ""):
        with pytest.raises(ValueError, match="unsupported format"):
            read_source(spark, path, unsupported)


def test_overwrite_replaces_schema_and_may_read_itself(spark, path, rows):
    overwrite_table(spark.range(3), path)
    overwrite_table(scan_table(spark, path).select((F.col("id") + 1).alias("a")), path)
    assert rows(scan_table(spark, path)) == [(1,), (2,), (3,)]
    assert directories(Path(path).parent) == ["table"]


def test_failed_overwrite_keeps_the_table(spark, path, rows):
    overwrite_table(spark.range(3), path)
    failing = scan_table(spark, path).select(F.raise_error("no").alias("id"))
    with pytest.raises(PySparkException):
        overwrite_table(failing, path)
    assert rows(scan_table(spark, path)) == [(0,), (1,), (2,)]
    overwrite_table(spark.range(1), path)
    assert rows(scan_table(spark, path)) == [(0,)]


def test_interrupted_replacement_is_undone(spark, path, rows):
    overwrite_table(spark.range(3), path)
    paths.rename(spark, path, f"{path}__previous")
    assert table_exists(spark, path)
    assert rows(scan_table(spark, path)) == [(0,), (1,), (2,)]
    assert not table_exists(spark, f"{path}-other")


def test_remains_of_an_earlier_attempt_are_dropped(spark, path, rows):
    schema = "p string, v int"
    spark.createDataFrame([("stale", 1)], schema).write.partitionBy("p").parquet(f"{path}__next")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df = spark.createDataFrame([("a", 2)], schema)
        overwrite_table(df, path, "p")
        overwrite_table(df.withColumn("p", F.lit("b")), path, "p")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert rows(scan_table(spark, path, df.schema)) == [("b", 2)]


def test_partitioned_table(spark, path, rows):
    df = spark.createDataFrame([("0012", 1), (None, 2), ("a/b", 3)], "p string, v int")
    overwrite_table(evenly(df, "p"), path, "p")
    assert len(directories(path)) == 3
    assert rows(scan_table(spark, path, df.schema)) == [("0012", 1), ("a/b", 3), (None, 2)]
    overwrite_table(df.filter("v = 1").withColumn("w", F.lit(1)), path, "p")
    assert directories(path) == ["p=0012"]


def test_partition_filter_prunes(spark, path):
    df = spark.createDataFrame([("actor", "tt1"), ("writer", "tt2")], "category string, tconst string")
    overwrite_table(df, path, "category")
    scan = scan_table(spark, path, df.schema).filter(F.col("category").isin("actor", "actress"))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [category" in plan


def test_evenly_bounds_the_number_of_files(spark, path):
    df = spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 10).alias("p"))
    overwrite_table(evenly(df, "p"), path, "p")
    assert len(list(Path(path).rglob("*.parquet"))) == 10


def test_append(spark, path, rows):
    schema = "p string, v int"
    append_table(spark.createDataFrame([("a", 1)], schema), path, "p")
    append_table(spark.createDataFrame([("a", 2), ("b", 3)], schema), path, "p")
    assert rows(scan_table(spark, path, spark.createDataFrame([], schema).schema)) == [("a", 1), ("a", 2), ("b", 3)]


def test_replace_partition(spark, path, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c d", 3)], "p string, v int")
    overwrite_table(df, path, "p")

    stored = scan_table(spark, path, df.schema)
    replace_partition(stored.filter("p = 'b'").withColumn("v", F.col("v") + 10), path, "p", "b")
    assert rows(scan_table(spark, path, df.schema)) == [("a", 1), ("b", 12), ("c d", 3)]

    with pytest.raises(PySparkException, match="row outside partition b"):
        replace_partition(df, path, "p", "b")
    assert rows(scan_table(spark, path, df.schema)) == [("a", 1), ("b", 12), ("c d", 3)]

    replace_partition(df.filter("v > 99"), path, "p", "c d")
    assert rows(scan_table(spark, path, df.schema)) == [("a", 1), ("b", 12)]
    replace_partition(spark.createDataFrame([], df.schema), path, "p", "a")
    assert rows(scan_table(spark, path, df.schema)) == [("b", 12)]


def test_upsert_unpartitioned_table(spark, path, rows):
    overwrite_table(spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string"), path)
    upsert_table(spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string"), path, ["k"])
    assert rows(scan_table(spark, path)) == [(1, "old"), (2, "new"), (3, "new")]


SCHEMA = "k int, p int, v string"
OLD = [(1, 1960, "old"), (2, 1960, "old"), (3, 1970, "old"), (4, 1980, "old"), (5, None, "old"), (None, 1970, "old")]


@pytest.fixture
def stored(spark, path):
    df = spark.createDataFrame(OLD, SCHEMA)
    overwrite_table(df, path, "p")

    def upserted(new, **options):
        upsert_table(spark.createDataFrame(new, SCHEMA), path, ["k"], "p", **options)
        return scan_table(spark, path, df.schema)

    return upserted


def test_upsert_moves_rows_between_partitions(stored, path, rows):
    """Key 3 leaves a partition that keeps a row, key 4 and key 5 empty theirs, key 6 is new."""
    new = [(3, 1960, "new"), (4, None, "new"), (5, 1990, "new"), (6, 1990, "new")]
    expected = [
        (1, 1960, "old"),
        (2, 1960, "old"),
        (3, 1960, "new"),
        (4, None, "new"),
        (5, 1990, "new"),
        (6, 1990, "new"),
        (None, 1970, "old"),
    ]
    assert rows(stored(new)) == expected
    assert directories(path) == ["p=1960", "p=1970", "p=1990", "p=__HIVE_DEFAULT_PARTITION__"]
    assert rows(stored(new)) == expected


def test_upsert_leaves_other_partitions_alone(stored, path):
    def files():
        return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}

    before = files()
    stored([(3, 1970, "new")])
    after = files()
    assert {p.parent.name for p in before if after.get(p) != before[p]} == {"p=1970"}


def test_upsert_of_nothing(stored, rows):
    assert rows(stored([])) == sorted(OLD, key=repr)


def test_upsert_table_and_duplicates(stored, rows):
    new = [(1, 1960, "a"), (1, 1970, "b")]
    with pytest.raises(ValueError, match="several source rows for key 1"):
        stored(new)
    with pytest.raises(ValueError, match="several source rows for key 9"):
        stored([(9, 2000, "a"), (9, 2000, "b")])  # also in a partition that is not there yet
    rest = [r for r in OLD if r[0] != 1]
    assert rows(stored(new, on_duplicate="last", order_by=["v"])) == sorted([*rest, (1, 1970, "b")], key=repr)
    assert rows(stored(new, on_duplicate="all")) == sorted([*rest, *new], key=repr)
    with pytest.raises(ValueError, match="order_by"):
        stored(new, on_duplicate="last")
    with pytest.raises(ValueError, match="first"):
        stored(new, on_duplicate="first")


def test_upsert_handles_odd_partition_names(spark, path, rows):
    df = spark.createDataFrame([(1, "a/b c%d"), (2, "x=y")], "k int, p string")
    overwrite_table(df, path, "p")
    upsert_table(spark.createDataFrame([(1, "x=y")], "k int, p string"), path, ["k"], "p")
    assert rows(scan_table(spark, path, df.schema)) == [(1, "x=y"), (2, "x=y")]
    assert len(directories(path)) == 1


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = paths.scratch_path(spark, "x"), paths.scratch_path(spark, "x")
    assert first != second
    assert first.startswith(shared)


def test_scratch_without_shared_folder():
    """A local session may use a temporary folder, a cluster may not."""
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = "local[8]"
    assert paths.scratch_path(session, "x").startswith(tempfile.gettempdir())
    session.sparkContext.master = "yarn"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        paths.scratch_path(session, "x")
    session.sparkContext.getCheckpointDir.return_value = "hdfs:///shared"
    assert paths.scratch_path(session, "x").startswith("hdfs:///shared/x-")


def test_principals_schema_reads_partition_column_as_text(spark, path):
    df = spark.createDataFrame([("tt1", 1, "nm1", "1", None, None)], TITLE_PRINCIPALS.schema)
    overwrite_table(df, path, "category")
    assert scan_table(spark, path, df.schema).first()["category"] == "1"


def test_empty_text_and_null_are_one_partition(spark, path, rows):
    schema = "k string, p string, v int"
    overwrite_table(spark.createDataFrame([("a", None, 1), ("b", None, 2), ("c", "x", 3)], schema), path, "p")
    upsert_table(spark.createDataFrame([("z", "", 9)], schema), path, ["k"], "p")
    stored = lambda: rows(scan_table(spark, path, spark.createDataFrame([], schema).schema))
    assert stored() == sorted([("a", None, 1), ("b", None, 2), ("c", "x", 3), ("z", None, 9)], key=repr)
    replace_partition(spark.createDataFrame([("n", "", 5)], schema), path, "p", "")
    assert stored() == sorted([("c", "x", 3), ("n", None, 5)], key=repr)


@pytest.mark.parametrize("partition_by", [None, "w"])
def test_upsert_refuses_other_columns(spark, path, rows, partition_by):
    overwrite_table(spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], "k string, w string, v int"), path, partition_by)
    with pytest.raises(ValueError, match="missing"):
        upsert_table(spark.createDataFrame([("a", 5)], "k string, v int"), path, ["k"])
    more = spark.createDataFrame([("a", "x", 5, True)], "k string, w string, v int, n boolean")
    with pytest.raises(ValueError, match="added"):
        upsert_table(more, path, ["k"], partition_by)
    upsert_table(more, path, ["k"], partition_by, add_columns=True)
    assert rows(scan_table(spark, path, more.schema)) == [("a", "x", 5, True), ("b", "x", 2, None)]


def test_one_large_partition_value_of_one_file_is_cut(spark, path, tmp_path):
    """All rows have the same value and come from one task, so only the dealt parts can spread them."""
    source = str(tmp_path / "source")
    spark.range(40_000).select(F.col("id").alias("k"), F.lit(None).cast("int").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("v")).coalesce(1).write.parquet(source)
    # Else AQE joins parts of less than a megabyte.
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "400k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        overwrite_table(evenly(spark.read.parquet(source), "p", rows_per_task=1_000), path, "p")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    sizes = [f.stat().st_size for f in Path(path).rglob("*.parquet")]
    assert len(sizes) >= 4 and max(sizes) < sum(sizes) / 2


def test_two_runs_do_not_share_side_names(path):
    assert beside(path, "next") != beside(path, "next")


def test_many_keys_are_looked_up_not_sorted(spark, monkeypatch):
    monkeypatch.setattr(landing, "FEW_KEYS", 2)
    rows, keys = spark.range(100).repartition(3), spark.range(50)
    join = lambda: rows.join(landing.by_hash(keys), "id", "left_anti")
    assert "ShuffledHashJoin" in join()._jdf.queryExecution().executedPlan().toString() and join().count() == 50
    monkeypatch.setattr(landing, "KEYS_PER_TASK", 0)
    assert "ShuffledHashJoin" not in join()._jdf.queryExecution().executedPlan().toString()


def test_upsert_counts_the_rows_of_a_value_without_the_join(spark, tmp_path, rows, monkeypatch):
    path, seen = str(tmp_path / "t"), []
    table = spark.range(40).selectExpr("id", "id % 2 as part", "'old' as v")
    overwrite_table(table, path, "part")
    whole = tables.evenly
    monkeypatch.setattr(tables, "evenly", lambda df, by=None, **other: (seen.append(other["counted"]), whole(df, by, **other))[1])
    upsert_table(spark.range(30, 50).selectExpr("id", "id % 3 as part", "'new' as v"), path, ["id"], "part")
    assert seen[0].columns == ["part"] and "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.id, r.part, r.v) for r in scan_table(spark, path).collect()}
    assert got == {(i, i % 2, "old") for i in range(30)} | {(i, i % 3, "new") for i in range(30, 50)}


def test_a_stored_source_is_not_written_again(spark, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "t"), []
    overwrite_table(spark.range(5).selectExpr("id", "0 as v"), path)
    monkeypatch.setattr(tables.paths, "delete", lambda spark, p, delete=tables.paths.delete: (kept.append([f.name for f in tmp_path.glob("*batch*/*")]), delete(spark, p)))
    upsert_table(spark.range(3, 8).selectExpr("id", "1 as v"), path, ["id"], on_duplicate="all", stored=True)
    assert ["keys"] in kept and not any("rows" in names for names in kept)
    assert {(r.id, r.v) for r in scan_table(spark, path).collect()} == {(i, int(i > 2)) for i in range(8)}
