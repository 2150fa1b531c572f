"""Cleansed zone: two dimensions and the fact table of acting credits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, ShortType

from marquee.functions.columns import (
    adult_flag,
    alive_flag,
    comparable,
    null_token,
    number,
    parse_characters,
    split_list,
    strictly_between,
)
from marquee.operators.skew import ROWS_PER_SHARE, balanced_left_join
from marquee.specs import BATCH_DATE_COLUMN, BIRTH_YEARS, RATING_TYPE, ROLES, START_YEARS


def _batch_date(df: DataFrame) -> list[str]:
    return [BATCH_DATE_COLUMN] if BATCH_DATE_COLUMN in df.columns else []


def _within_years(df: DataFrame, column: str, years: tuple[int, int]) -> DataFrame:
    return df.filter(strictly_between(comparable(df, column, IntegerType()), years))


def dim_names(names: DataFrame, birth_years: tuple[int, int] = BIRTH_YEARS) -> DataFrame:
    """Name dimension of people born within the (open) range of years."""
    born = number(names, "birthYear", ShortType())
    died = number(names, "deathYear", ShortType())
    return _within_years(names, "birthYear", birth_years).select(
        F.col("nconst").cast("string").alias("nconst"),
        F.col("primaryName").cast("string").alias("name"),
        split_list(null_token(F.col("primaryProfession"))).alias("profession"),
        split_list(null_token(F.col("knownForTitles"))).alias("known_for_titles"),
        *_batch_date(names),
        alive_flag(born, died).alias("is_alive"),
    )


def dim_titles(titles: DataFrame, start_years: tuple[int, int] = START_YEARS) -> DataFrame:
    """Title dimension of titles started within the (open) range of years."""
    return _within_years(titles, "startYear", start_years).select(
        F.col("tconst").cast("string").alias("tconst"),
        F.col("titleType").cast("string").alias("type"),
        F.col("primaryTitle").cast("string").alias("primary_title"),
        F.col("originalTitle").cast("string").alias("original_title"),
        adult_flag(number(titles, "isAdult", IntegerType())).alias("is_adult"),
        number(titles, "startYear", ShortType()).alias("start_year"),
        number(titles, "endYear", ShortType()).alias("end_year"),
        split_list(null_token(F.col("genres"))).alias("genres"),
        *_batch_date(titles),
    )


def fact_principals(
    titles: DataFrame,
    ratings: DataFrame,
    principals: DataFrame,
    start_years: tuple[int, int] = START_YEARS,
    roles: tuple[str, ...] = ROLES,
    parse: str = "comma",
    rows_per_share: int = ROWS_PER_SHARE,
) -> DataFrame:
    """One row per acting credit, with run time and rating of its title.

    Titles without a rating keep NULL there, titles without acting credits keep one row with NULL
    person, role and characters. A title with a very large number of credits is cut into shares.
    """
    run_times = _within_years(titles, "startYear", start_years).select(
        F.col("tconst").cast("string").alias("tconst"),
        number(titles, "runtimeMinutes", IntegerType()).alias("run_time_minutes"),
    )
    rated = ratings.select(
        F.col("tconst").cast("string").alias("tconst"),
        number(ratings, "averageRating", RATING_TYPE).alias("rating"),
        number(ratings, "numVotes", IntegerType()).alias("num_votes"),
    )
    credits = principals.filter(F.col("category").isin(*roles)).select(
        F.col("tconst").cast("string").alias("tconst"),
        F.col("nconst").cast("string").alias("nconst"),
        F.col("category").cast("string").alias("role"),
        parse_characters(F.col("characters"), parse).alias("characters"),
    )
    return balanced_left_join([run_times, rated], credits, "tconst", rows_per_share).select(
        "tconst", "run_time_minutes", "rating", "num_votes", "nconst", "role", "characters"
    )
