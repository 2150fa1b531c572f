"""What is known about the tables: names, schemas, keys, and the fixed values of the daily batch."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

# Fixed values. They decide results, so they are stated here as they are.
NULL_TOKEN = "\\N"
LIST_SEPARATOR = r"\s*,\s*"
BRACKETS_AND_QUOTES = r'[\[\]"]'
BIRTH_YEARS = (1960, 2010)
START_YEARS = (1960, 2020)
MIN_VOTES = 10000
ROLES = ("actor", "actress")
BOTH_ROLES = "both"
BATCH_DATE_COLUMN = "today_date"
RATING_TYPE = DecimalType(10, 1)
AVERAGE_RATING_TYPE = DecimalType(14, 5)
SUCCESS = "success"
FAILURE = "unsuccessful"
# Zones (folders, and for the first, second and fourth also the stage in the run log), stages
# of the cleansed tables, and tables.
CACHE = "cache"
LANDING = "landing_zone"
CLEANSED = "cleansed_zone"
AGGREGATED = "aggregated_zone"
CLEANSED_STAGES = {
    "dim_names": "cleansed_dim_names",
    "dim_titles": "cleansed_dim_titles",
    "fact_title_principals": "cleansed_fact_title_principals",
}
REJECTED = "rejected"
NOTES = "landing_notes"
JOURNAL = "journal"
RUN_LOG = "metadata"
DIM_NAMES = "dim_names"
DIM_TITLES = "dim_titles"
FACT = "fact_title_principals"
KPIS = "actors_actress_kpis"
ROLE_KPIS = "role_kpis"
PERSON_SUMS = "person_sums"
SERVED_RUN_LOG = "etl_pipeline_status"


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


@dataclass(frozen=True)
class TableSpec:
    """A raw table: its key, how its landed copy is partitioned and which rows and types it lands with.

    ``schema`` is what the raw file is read with; without one, the header names columns of text. ``casts`` are
    applied while landing, for frames that did not come from a typed scan. ``min_votes`` keeps only
    rows with more votes than that. ``on_duplicate`` is how an upsert treats several new rows of a key.
    """

    name: str
    primary_key: tuple[str, ...]
    partition_by: str | None = None
    schema: StructType | None = None
    casts: dict[str, DataType] = field(default_factory=dict)
    min_votes: int | None = None
    on_duplicate: str = "error"

    @property
    def required(self) -> tuple[str, ...]:
        """The columns without which a raw file can't be landed; others may be missing from it."""
        votes = () if self.min_votes is None else ("numVotes",)
        by = (self.partition_by,) if self.partition_by else ()
        return tuple(dict.fromkeys([*self.primary_key, *by, *self.casts, *votes]))

    @property
    def landed_schema(self) -> StructType | None:
        if self.schema is None:
            return None
        return StructType([*self.schema.fields, StructField(BATCH_DATE_COLUMN, DateType())])


NAME_BASICS = TableSpec(
    "name_basics",
    ("nconst",),
    partition_by="birthYear",
    schema=_schema(
        nconst=StringType(),
        primaryName=StringType(),
        birthYear=IntegerType(),
        deathYear=ShortType(),
        primaryProfession=StringType(),
        knownForTitles=StringType(),
    ),
    casts={"birthYear": IntegerType()},
)
TITLE_BASICS = TableSpec(
    "title_basics",
    ("tconst",),
    partition_by="startYear",
    schema=_schema(
        tconst=StringType(),
        titleType=StringType(),
        primaryTitle=StringType(),
        originalTitle=StringType(),
        isAdult=IntegerType(),
        startYear=IntegerType(),
        endYear=ShortType(),
        runtimeMinutes=IntegerType(),
        genres=StringType(),
    ),
    casts={"startYear": IntegerType()},
)
TITLE_PRINCIPALS = TableSpec(
    "title_principals",
    ("tconst", "nconst"),
    partition_by="category",
    schema=_schema(
        tconst=StringType(),
        ordering=ShortType(),
        nconst=StringType(),
        category=StringType(),
        job=StringType(),
        characters=StringType(),
    ),
    # A person may have several credits on a title; they are replaced together and all kept.
    on_duplicate="all",
)
TITLE_RATINGS = TableSpec(
    "title_ratings",
    ("tconst",),
    schema=_schema(tconst=StringType(), averageRating=DoubleType(), numVotes=IntegerType()),
    casts={"numVotes": IntegerType()},
    min_votes=MIN_VOTES,
)
# Only the keys of these three are known; they are landed, as text but for the number, and not used further.
TITLE_AKAS = TableSpec("title_akas", ("titleId", "ordering"), casts={"ordering": IntegerType()})
TITLE_CREW = TableSpec("title_crew", ("tconst",))
TITLE_EPISODE = TableSpec("title_episode", ("tconst",))

TABLES = {
    spec.name: spec
    for spec in (
        NAME_BASICS,
        TITLE_AKAS,
        TITLE_BASICS,
        TITLE_CREW,
        TITLE_EPISODE,
        TITLE_PRINCIPALS,
        TITLE_RATINGS,
    )
}

NOTES_SCHEMA = _schema(
    date=DateType(), table_name=StringType(), note=StringType(), column_name=StringType(), n_values=LongType()
)

RUN_LOG_SCHEMA = _schema(stage=StringType(), table_name=StringType(), date=DateType(), status=StringType())

FACT_SCHEMA = _schema(
    tconst=StringType(),
    run_time_minutes=IntegerType(),
    rating=RATING_TYPE,
    num_votes=IntegerType(),
    nconst=StringType(),
    role=StringType(),
    characters=ArrayType(StringType()),
)
