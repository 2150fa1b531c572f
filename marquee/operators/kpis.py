"""Aggregated zone: performance indicators per person, and the top-people report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.specs import AVERAGE_RATING_TYPE, BOTH_ROLES, ROLES

KPI_COLUMNS = [
    "nconst",
    "role",
    "name",
    "average_rating",
    "total_run_time_minutes",
    "total_titles_as_principal",
]
COPIES_PER_ROW = 100_000


def _totals(fact: DataFrame) -> DataFrame:
    """One row per credited person over both roles, with the number of credits in each role.

    The roles are few and known, so they are counted in columns: everything the KPI tables need comes
    from this one aggregation, which combines before its shuffle.
    """
    credits = fact.filter(F.col("role").isin(*ROLES) & F.col("nconst").isNotNull())
    return credits.groupBy("nconst").agg(
        F.avg("rating").cast(AVERAGE_RATING_TYPE).alias("average_rating"),
        F.sum("run_time_minutes").alias("total_run_time_minutes"),
        F.count("role").alias("total_titles_as_principal"),
        *[F.count_if(F.col("role") == role).alias(role) for role in ROLES],
    )


def person_kpis(names: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per person of the name dimension; people without credits have count 0."""
    return (
        names.select("nconst")
        .join(_totals(fact), "nconst", "left")
        .select(
            "nconst",
            "average_rating",
            "total_run_time_minutes",
            F.coalesce("total_titles_as_principal", F.lit(0)).alias("total_titles_as_principal"),
        )
    )


def role_kpis(names: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per person and role with credits in it; the indicators span both roles.

    ``credits`` is the number of credits of the person in that role.
    """
    return role_rows(names, _totals(fact))


def role_rows(names: DataFrame, totals: DataFrame) -> DataFrame:
    """``role_kpis`` from the indicators of the persons, with their credits in each role in a column."""
    per_role = F.array(*[F.struct(F.lit(role).alias("role"), F.col(role).alias("credits")) for role in ROLES])
    return (
        names.select("nconst", "name")
        .join(totals, "nconst")
        .withColumn("per_role", F.explode(per_role))
        .filter(F.col("per_role.credits") > 0)
        .select("nconst", "name", *KPI_COLUMNS[3:], "per_role.role", "per_role.credits")
        .select(*KPI_COLUMNS, "credits")
    )


def principal_kpis(names: DataFrame, fact: DataFrame, copies_per_row: int = COPIES_PER_ROW) -> DataFrame:
    """The indicators of the person on every one of their credits.

    All credits of a person in a role give the same row, so the credits need not be shuffled to the
    totals: the rows of ``role_kpis`` are repeated. A person with very many credits is first cut into
    blocks of at most ``copies_per_row``, which are spread over the tasks before they are repeated.
    The number of partitions is given so that AQE does not merge these small rows again.
    """
    return per_credit(role_kpis(names, fact), copies_per_row)


def per_credit(by_role: DataFrame, copies_per_row: int = COPIES_PER_ROW) -> DataFrame:
    """``principal_kpis`` from the rows of ``role_kpis``."""
    session = by_role.sparkSession
    tasks = int(session.conf.get("spark.sql.shuffle.partitions"))
    last_block = F.floor((F.col("credits") - 1) / copies_per_row)
    blocks = by_role.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    copies = F.least(F.lit(copies_per_row), F.col("credits") - F.col("block") * copies_per_row)
    return (
        blocks.withColumn("copies", copies.cast("int"))
        .repartition(tasks, "nconst", "role", "block")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(*KPI_COLUMNS)
    )


def serving_kpis(kpis: DataFrame) -> DataFrame:
    """Distinct rows per person and role: what the serving store keeps and answers from."""
    return kpis.select(*KPI_COLUMNS).distinct()


def top_people(kpis: DataFrame, role: str) -> DataFrame:
    """People by average rating, best first, unrated last.

    ``role`` is actor, actress or both, in any case. With one role there is one row per person who
    has it; with both there is one row per person, who is listed under their first role by name.
    """
    wanted = role.lower()
    if wanted not in (*ROLES, BOTH_ROLES):
        raise ValueError(f"role must be one of {', '.join((*ROLES, BOTH_ROLES))}, not {role!r}")
    if wanted == BOTH_ROLES:
        # Counting the known roles keeps this a hash aggregation; the minimum of a text would sort.
        has_role = [F.when(F.count_if(F.col("role") == r) > 0, r) for r in sorted(ROLES)]
        others = [c for c in KPI_COLUMNS if c != "role"]
        people = kpis.filter(F.col("role").isin(*ROLES)).groupBy(*others).agg(F.coalesce(*has_role).alias("role"))
        people = people.select(*KPI_COLUMNS)
    else:
        people = serving_kpis(kpis.filter(F.col("role") == wanted))
    return people.orderBy(F.desc_nulls_last("average_rating"), "nconst", "role")
