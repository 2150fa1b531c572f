"""Fact table and indicators from what changed since they were made.

A derived table names the versions of its sources in its own version, published in the same step, and holds them. The
next refresh reads the files by which the sources differ now, finds the keys whose rows really changed, and replaces
those. If a source is a plain table, or a version is gone, everything is made anew: the rows are the same either way.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.operators.changes import added_up, changed_keys, person_sums
from marquee.operators.cleansed import fact_principals
from marquee.operators.landing import by_hash
from marquee.sources import paths, versions
from marquee.sources.files import scan_table
from marquee.sources.tables import beside, overwrite_table, replace_keys
from marquee.specs import (
    AGGREGATED,
    CLEANSED,
    FACT,
    FACT_SCHEMA,
    LANDING,
    PERSON_SUMS,
    ROLES,
    TITLE_BASICS,
    TITLE_PRINCIPALS,
    TITLE_RATINGS,
    TableSpec,
)

REBUILT, CORRECTED = "rebuilt", "corrected"
# The columns of the landed tables that the fact table is made from.
FACT_COLUMNS = [
    (TITLE_BASICS, ["tconst", "startYear", "runtimeMinutes"]),
    (TITLE_RATINGS, ["tconst", "averageRating", "numVotes"]),
    (TITLE_PRINCIPALS, ["tconst", "nconst", "category", "characters"]),
]


class Sources:
    """The stored tables ``names`` below ``root``, as they are now and as ``path`` was made from them last."""

    def __init__(self, spark: SparkSession, root: str, names: Iterable[str], path: str):
        self.spark = spark
        self.root = root
        self.reader = path.rsplit("/", 1)[-1]
        self.now = {name: versions.current(spark, f"{root}/{name}") for name in names}
        made = versions.current(spark, path)
        numbers = made.sources if made else {}
        self.then = {name: versions.at(spark, f"{root}/{name}", numbers[name]) for name in self.now if name in numbers}

    @property
    def comparable(self) -> bool:
        return set(self.then) == set(self.now) and None not in [*self.then.values(), *self.now.values()]

    @property
    def numbers(self) -> dict[str, int] | None:
        """What is to be published with the derived table; None if it can't be corrected later."""
        return None if None in self.now.values() else {name: version.number for name, version in self.now.items()}

    def hold(self) -> None:
        for name, number in (self.numbers or {}).items():
            versions.hold(self.spark, f"{self.root}/{name}", self.reader, number)

    def release(self) -> None:
        for name, number in (self.numbers or {}).items():
            versions.release(self.spark, f"{self.root}/{name}", self.reader, but=number)

    def rows(self, name: str, schema: StructType) -> DataFrame:
        version = self.now[name]
        path = f"{self.root}/{name}"
        return scan_table(self.spark, path, schema) if version is None else versions.read(self.spark, path, version, schema)

    def difference(self, name: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
        return versions.difference(self.spark, f"{self.root}/{name}", self.then[name], self.now[name], schema)


def _landed(spec: TableSpec) -> str:
    return f"{LANDING}/{spec.name}"


def _credits(principals: DataFrame) -> DataFrame:
    return principals.filter(F.col("category").isin(*ROLES))


def refresh_fact(spark: SparkSession, root: str) -> str:
    """Bring the fact table below ``root`` up to date with the landed tables; whether it was rebuilt or corrected.

    A title counts as changed if one of its rows, ratings or acting credits did, in a column that the fact table uses; a
    new batch date alone is no change. Rows of titles without a key are made anew each time.
    """
    path = f"{root}/{CLEANSED}/{FACT}"
    sources = Sources(spark, root, [_landed(spec) for spec, _ in FACT_COLUMNS], path)
    sources.hold()
    titles, ratings, principals = (
        sources.rows(_landed(spec), spec.landed_schema).select(*columns) for spec, columns in FACT_COLUMNS
    )
    if sources.comparable:
        scratch = {what: beside(path, what) for what in ("changed", "credits", "rows")}
        try:
            changed = None
            for spec, columns in FACT_COLUMNS:
                before, after = (df.select(*columns) for df in sources.difference(_landed(spec), spec.landed_schema))
                if spec is TITLE_PRINCIPALS:
                    before, after = _credits(before), _credits(after)
                keys = changed_keys(before, after, "tconst")
                changed = keys if changed is None else changed.unionByName(keys)
            changed = by_hash(_kept(changed.distinct(), scratch["changed"]))
            without_key = titles.filter(F.col("tconst").isNull())
            # Credits are dealt by their position in a table, so they have to be one.
            credits = _kept(_credits(principals).join(changed, "tconst", "left_semi"), scratch["credits"])
            fact = fact_principals(
                titles.join(changed, "tconst", "left_semi").unionByName(without_key),
                ratings.join(changed, "tconst", "left_semi"),
                credits,
            )
            rows = _kept(fact, scratch["rows"])
            replace_keys(rows, changed, path, "tconst", "role", sources.numbers)
        finally:
            for folder in scratch.values():
                paths.delete(spark, folder)
    else:
        overwrite_table(fact_principals(titles, ratings, principals), path, "role", sources.numbers)
    sources.release()
    return CORRECTED if sources.comparable else REBUILT


def refresh_person_sums(spark: SparkSession, root: str) -> str:
    """Bring the stored sums of every person up to date with the fact table; whether they were rebuilt or corrected.

    The credits of files that are gone are taken back and those of new files added, which is exact as all are integers
    and decimals. The sums and the version of the fact table that is in them are published in one step, so an attempt
    that is repeated adds nothing twice.
    """
    path, name = f"{root}/{AGGREGATED}/{PERSON_SUMS}", f"{CLEANSED}/{FACT}"
    sources = Sources(spark, root, [name], path)
    sources.hold()
    if sources.comparable:
        scratch = {what: beside(path, what) for what in ("changes", "rows")}
        try:
            gone, added = sources.difference(name, FACT_SCHEMA)
            changes = _kept(added_up(person_sums(added), person_sums(gone, -1)), scratch["changes"])
            changed = by_hash(changes.select("nconst"))
            stored = scan_table(spark, path).join(changed, "nconst", "left_semi")
            rows = _kept(added_up(stored, changes), scratch["rows"])
            replace_keys(rows, changed, path, "nconst", sources=sources.numbers)
        finally:
            for folder in scratch.values():
                paths.delete(spark, folder)
    else:
        overwrite_table(person_sums(sources.rows(name, FACT_SCHEMA)), path, sources=sources.numbers)
    sources.release()
    return CORRECTED if sources.comparable else REBUILT


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
