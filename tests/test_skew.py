from collections import Counter

from pyspark.sql import functions as F

from marquee.operators.skew import balanced_left_join, heavy_keys


def hot(spark, n=3000):
    """A third of the rows has key 0, half of them identical copies; the rest has a key each."""
    ids = spark.range(n)
    return ids.select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("v"),
    )


def test_heavy_keys(spark):
    assert [tuple(r) for r in heavy_keys(hot(spark), "k", 100).collect()] == [(0, 10)]
    assert heavy_keys(hot(spark), "k", 1000).collect() == []


def test_heavy_keys_ignores_null(spark):
    nulls = spark.range(1000).select(F.lit(None).cast("long").alias("k"))
    assert heavy_keys(nulls, "k", 10).collect() == []


def test_balanced_join_equals_plain_join(spark):
    left = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a")).filter("k % 5 <> 1")
    left = left.unionByName(spark.createDataFrame([(None, 1)], "k long, a long"))
    other = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("b")).filter("k % 4 <> 1")
    right = hot(spark).unionByName(spark.createDataFrame([(None, 1)], "k long, v long"))
    plain = left.join(other, "k", "left").join(right, "k", "left")
    for rows_per_share in (1, 3, 100, 10_000):
        balanced = balanced_left_join([left, other], right, "k", rows_per_share)
        assert balanced.columns == plain.columns
        assert Counter(map(tuple, balanced.collect())) == Counter(map(tuple, plain.collect()))


def test_hot_key_is_spread(spark):
    """With shuffle joins, no task holds much more than its part although one key has a third."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        left = spark.range(3000).select(F.col("id").alias("k"))

        def largest_task(frame):
            sizes = frame.groupBy(F.spark_partition_id()).count()
            return sizes.agg(F.max("count")).first()[0]

        assert largest_task(left.join(hot(spark), "k", "left")) > 1000
        assert largest_task(balanced_left_join([left], hot(spark), "k", 20)) < 700
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_no_key_above_the_share_stays_whole(spark):
    """However small the asked share, the bound follows from the counted rows, and all keys beyond it are cut."""
    rows = spark.range(600).select((F.col("id") % 20).alias("k")).unionByName(spark.range(400).select(F.lit(99).cast("long").alias("k")))
    for most in (4, 10, 50, 1000):
        share = max(2, -(-1000 // most))
        cut = {r.k: r._shares for r in heavy_keys(rows, "k", 2, most).collect()}
        sizes = {**{k: 30 for k in range(20)}, 99: 400}
        assert cut == {k: -(-n // share) for k, n in sizes.items() if n > share}
        assert len(cut) <= most
