"""Landing zone: stamping raw rows, keyed upserts and the freshness test."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from marquee.functions.columns import null_token, number
from marquee.operators.runlog import latest_success
from marquee.specs import BATCH_DATE_COLUMN, TableSpec


def land_table(raw: DataFrame, spec: TableSpec, batch_date: date) -> DataFrame:
    """Raw rows with the casts and the vote threshold of their table, stamped with the batch date."""
    landed = raw.withColumns({name: number(raw, name, kind) for name, kind in spec.casts.items()})
    if spec.min_votes is not None:
        landed = landed.filter(F.col("numVotes") > spec.min_votes)
    return landed.withColumn(BATCH_DATE_COLUMN, F.lit(batch_date))


def lenient_casts(df: DataFrame, casts: dict[str, DataType]) -> dict[str, DataType]:
    """Those of ``casts`` that ``land_table`` really does: the others have their type already."""
    return {name: kind for name, kind in casts.items() if df.schema[name].dataType != kind}


def values_in(name: str) -> Column:
    """An aggregate: how many rows have a value, the null token being none."""
    return F.count(null_token(F.col(name).cast("string")))


def lost_in_cast(name: str, kind: DataType) -> Column:
    """An aggregate: how many values a lenient cast turns to NULL."""
    value = null_token(F.col(name).cast("string"))
    return F.count(F.when(value.isNotNull() & F.col(name).try_cast(kind).isNull(), 1))


def cast_losses(df: DataFrame, casts: dict[str, DataType]) -> DataFrame:
    """What lenient casts lose: column_name, n_values, n_lost, a row per column of ``casts``.

    All columns are counted in one pass that reads nothing else. NULL and the null token are no values and no loss.
    """
    counts = [count for name, kind in casts.items() for count in (values_in(name).alias(f"n {name}"), lost_in_cast(name, kind).alias(f"lost {name}"))]
    rows = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"`n {name}`").alias("n_values"), F.col(f"`lost {name}`").alias("n_lost"))
        for name in casts
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def first_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in the given order: a volume cap that gives the same rows every time."""
    return df.orderBy(*order_by).limit(n)


def has_key(keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


FEW_KEYS, KEYS_PER_TASK = 300_000, 1_000_000


def by_hash(keys: DataFrame) -> DataFrame:
    """Different keys, a stored table, for semi and anti joins: each task looks them up in a hash table, and neither side is sorted.

    That is left to Spark if they are so few that it may broadcast them, or more than a task should hold.
    """
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.hint("shuffle_hash") if FEW_KEYS < keys.count() <= KEYS_PER_TASK * tasks else keys


def one_per_key(df: DataFrame, keys: list[str], order_by: list[str], keep: str = "last") -> DataFrame:
    """The first or last row of every key; rows with a NULL in the key are not compared and all stay.

    Done as an aggregation, so that copies of a hot key are combined before the shuffle. Rows equal
    in ``order_by`` are told apart by their remaining columns.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    others = [c for c in df.columns if c not in keys and c not in order_by]
    values = [c for c in order_by if c not in keys] + others
    pick = F.max if keep == "last" else F.min
    keyed = df.filter(has_key(keys))
    if values:
        kept = keyed.groupBy(*keys).agg(pick(F.struct(*values)).alias("row"))
        kept = kept.select(*keys, *[F.col("row")[c].alias(c) for c in values])
    else:
        kept = keyed.distinct()
    return kept.select(*df.columns).unionByName(df.filter(~has_key(keys)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    on_duplicate: str = "error",
    order_by: list[str] | None = None,
    source_keys: DataFrame | None = None,
) -> DataFrame:
    """Target rows whose key is not in the source, plus the source rows.

    Several source rows with one key: ``error`` refuses them while the query runs; ``last`` keeps the last one in the order of ``order_by``; ``all`` keeps
    them all, so that the rows of a key are replaced as a group. A NULL in a key matches nothing: such rows stay in the target, and are
    added from the source, as in an SQL MERGE.

    Only the keys of the source meet the target. Spark broadcasts them if their measured size allows,
    and the target is then not shuffled; otherwise both are shuffled on the keys, where AQE can cut
    a hot key of the target because an anti join streams its left side. Who has the different keys of the source at
    hand gives them as ``source_keys`` (not with ``error``).
    """
    if on_duplicate not in ("error", "last", "all"):
        raise ValueError(f"on_duplicate must be 'error', 'last' or 'all', not {on_duplicate!r}")
    if source_keys is None or on_duplicate == "error":
        source_keys = source.filter(has_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    guard = None
    if on_duplicate == "error":
        refused = F.concat_ws(" ", F.lit("several source rows for key"), *[F.col(k).cast("string") for k in keys])
        source_keys = source_keys.filter(F.when(F.col("n") == 1, True).otherwise(F.raise_error(refused)))
        # Also read if the target has nothing to compare with: a branch of the result, without rows.
        guard = source_keys.filter(F.col("n") != 1).select(*[F.col(c) if c in keys else F.lit(None).cast(source.schema[c].dataType).alias(c) for c in source.columns])
    elif on_duplicate == "last":
        if not order_by:
            raise ValueError("on_duplicate='last' needs order_by")
        source = one_per_key(source, keys, order_by)

    kept = target.filter(has_key(keys)).join(source_keys.select(*keys), keys, "left_anti")
    unmatchable = target.filter(~has_key(keys))
    merged = kept.select(*target.columns).unionByName(unmatchable).unionByName(source)
    return merged.unionByName(guard) if guard is not None else merged


def needs_refresh(run_log: DataFrame, specs: DataFrame, batch_date: date) -> DataFrame:
    """What to do with each (stage, table_name) of ``specs``: load, upsert or skip.

    Load if the table is missing, skip if its last success is the batch date, otherwise upsert. A
    boolean column ``table_exists`` in ``specs`` says which tables are there; without it, a table
    that never succeeded counts as missing. All tables are answered by one pass over the log.
    """
    latest = latest_success(run_log)
    exists = F.col("table_exists") if "table_exists" in specs.columns else F.col("latest_date").isNotNull()
    action = F.when(~exists, "load").when(F.col("latest_date") == F.lit(batch_date), "skip").otherwise("upsert")
    return specs.join(latest, ["stage", "table_name"], "left").select(
        "stage", "table_name", "latest_date", action.alias("action")
    )
