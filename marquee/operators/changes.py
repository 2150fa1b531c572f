"""What changed between two states of a table, and sums that can be corrected by it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.specs import AVERAGE_RATING_TYPE, RATING_TYPE, ROLES


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose rows are not the same, copies included, in two frames of the same columns; NULL is no key.

    Rows that both have cancel out: every row counts as its hash, positive on one side and negative on the other, in
    one aggregation that combines before its shuffle. A changed key is overlooked if the sums of both halves of its
    64-bit hashes happen to agree. The halves are added up as longs, which is much faster than wide decimals.
    """
    columns = after.columns
    # The hash passes over NULLs, so where they stand goes into it too.
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    signed = [
        df.filter(F.col(key).isNotNull()).select(key, row.alias("row"), F.lit(sign).cast("long").alias("n"))
        for df, sign in ((before.select(*columns), -1), (after, 1))
    ]
    high, low = F.shiftright("row", 32) * F.col("n"), F.col("row").bitwiseAND(F.lit(0xFFFFFFFF)) * F.col("n")
    sums = signed[0].unionByName(signed[1]).groupBy(key).agg(F.sum(high).alias("high"), F.sum(low).alias("low"), F.sum("n").alias("n"))
    return sums.filter((F.col("high") != 0) | (F.col("low") != 0) | (F.col("n") != 0)).select(key)


SUMS = ["rating_sum", "rated", "run_time_sum", "timed", *ROLES]


def person_sums(fact: DataFrame, sign: int = 1) -> DataFrame:
    """What the indicators of a person are made of, as sums over the credits; ``sign`` -1 takes credits back."""
    credits = fact.filter(F.col("role").isin(*ROLES) & F.col("nconst").isNotNull())
    tenths = F.sum((F.col("rating").cast(RATING_TYPE) * 10).cast("long"))  # as longs: sums of wide decimals are slow
    return credits.groupBy("nconst").agg(
        ((F.coalesce(tenths, F.lit(0)) * sign).cast("decimal(20,0)") * F.lit(Decimal("0.1"))).cast("decimal(20,1)").alias("rating_sum"),
        (F.count("rating") * sign).alias("rated"),
        (F.coalesce(F.sum("run_time_minutes"), F.lit(0)) * sign).alias("run_time_sum"),
        (F.count("run_time_minutes") * sign).alias("timed"),
        *[(F.count_if(F.col("role") == role) * sign).alias(role) for role in ROLES],
    )


def added_up(*sums: DataFrame) -> DataFrame:
    """One row per person of several frames of ``person_sums``; persons in whom all is 0 are left out."""
    together = sums[0]
    for other in sums[1:]:
        together = together.unionByName(other)
    total = together.groupBy("nconst").agg(*[F.sum(c).cast(together.schema[c].dataType).alias(c) for c in SUMS])
    some = F.lit(False)
    for column in SUMS:
        some = some | (F.col(column) != 0)
    return total.filter(some)


def indicators(sums: DataFrame) -> DataFrame:
    """The indicators of every person, as ``role_rows`` takes them. Without a rating or run time they are NULL."""
    mean = F.col("rating_sum") / F.when(F.col("rated") > 0, F.col("rated"))
    credits = F.lit(0)
    for role in ROLES:
        credits = credits + F.col(role)
    return sums.select(
        "nconst",
        mean.cast(AVERAGE_RATING_TYPE).alias("average_rating"),
        F.when(F.col("timed") > 0, F.col("run_time_sum")).alias("total_run_time_minutes"),
        credits.alias("total_titles_as_principal"),
        *ROLES,
    )
