"""The run log: one row per stage, table, date and outcome."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.specs import RUN_LOG_SCHEMA, SUCCESS


def log_rows(spark: SparkSession, rows: Iterable[tuple[str, str, date, str]] = ()) -> DataFrame:
    """Rows (stage, table_name, date, status) as a frame; without rows, an empty log."""
    return spark.createDataFrame(list(rows), RUN_LOG_SCHEMA)


def run_log_append(run_log: DataFrame, rows: DataFrame) -> DataFrame:
    """The log with rows added. Rows of other stages and earlier runs stay."""
    return run_log.unionByName(rows)


def latest_success(run_log: DataFrame) -> DataFrame:
    """Latest successful date of every (stage, table_name) that ever succeeded."""
    return (
        run_log.filter(F.col("status") == SUCCESS)
        .groupBy("stage", "table_name")
        .agg(F.max("date").alias("latest_date"))
    )


def latest_success_of(run_log: DataFrame, stage: str, table_name: str) -> DataFrame:
    """One row with the latest successful date of one table in one stage; NULL if there is none."""
    return run_log.filter(
        (F.col("stage") == stage) & (F.col("table_name") == table_name) & (F.col("status") == SUCCESS)
    ).agg(F.max("date").alias("latest_date"))


def status_on_date(run_log: DataFrame, day: date) -> DataFrame:
    return run_log.filter(F.col("date") == F.lit(day)).select(*RUN_LOG_SCHEMA.names)


def serving_run_log(run_log: DataFrame) -> DataFrame:
    """Distinct log rows: in the serving store all four columns are the key."""
    return run_log.select(*RUN_LOG_SCHEMA.names).distinct()
