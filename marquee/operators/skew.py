"""A left join that stays balanced when one key of the right side holds a large share of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SHARE = 1_000_000
MOST_HEAVY_KEYS = 100_000


def heavy_keys(df: DataFrame, key: str, rows_per_share: int = ROWS_PER_SHARE, most: int = MOST_HEAVY_KEYS) -> DataFrame:
    """Keys with more than a share of rows, and the number of shares to cut each into.

    A share is ``rows_per_share`` rows, or 1/``most`` of all rows if that is more. So there are fewer than
    ``most`` such keys, which is what makes it safe to broadcast them, and every one is cut. The rows are
    counted right away, as a number in the plan: with a subquery in its place, Spark would not use one
    count of the keys for all sides of the join. Counting combines before the shuffle, so a hot key costs
    nothing extra here.
    """
    keyed = df.filter(F.col(key).isNotNull())
    share = max(rows_per_share, -(-keyed.count() // most))
    counts = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > share).select(
        key, F.ceil(F.col("n_rows") / share).cast("int").alias("_shares")
    )


def balanced_left_join(
    lefts: list[DataFrame], right: DataFrame, key: str, rows_per_share: int = ROWS_PER_SHARE
) -> DataFrame:
    """``lefts[0] left join lefts[1] ... left join right`` on ``key``, shuffling every input once.

    An outer join keeps its left side whole, so neither Spark nor AQE can cut a hot key of the right
    side. Here the rows of a heavy key on the right are dealt into shares and the few left rows of
    that key are repeated once per share. Keys that are not heavy have one share, so the plan is
    that of the plain join. A repeated left row that met no right row in its share is dropped: its
    key has right rows, so it is matched in another share. Left rows without a key match nothing and
    bypass the join, so they need not meet in one task either.

    Rows are dealt by position, not by content, so identical copies spread as well. Positions repeat
    when a lost task is run again if ``right`` is a filtered or projected table scan; write any other
    frame to a table first.
    """
    heavy = F.broadcast(heavy_keys(right, key, rows_per_share))  # bounded, see there

    def repeated(df: DataFrame) -> DataFrame:
        shares = F.sequence(F.lit(1), F.coalesce("_shares", F.lit(1)))
        return df.join(heavy, key, "left").withColumn("_share", F.explode(shares))

    left = repeated(lefts[0].filter(F.col(key).isNotNull()))
    for other in lefts[1:]:
        left = left.join(repeated(other).drop("_shares"), [key, "_share"], "left")

    share = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_shares")), F.lit(0)) + 1
    dealt = (
        right.join(heavy, key, "left")
        .withColumn("_share", share.cast("int"))
        .drop("_shares")
        .withColumn("_matched", F.lit(True))
    )
    joined = (
        left.join(dealt, [key, "_share"], "left")
        .filter(F.col("_shares").isNull() | F.col("_matched").isNotNull())
        .drop("_share", "_shares", "_matched")
    )
    return joined.unionByName(lefts[0].filter(F.col(key).isNull()), allowMissingColumns=True)
