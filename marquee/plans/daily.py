"""The daily batch: raw files to landing, cleansed and aggregated zone, with a run log."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.operators.changes import indicators
from marquee.operators.cleansed import dim_names, dim_titles
from marquee.operators.kpis import per_credit, role_rows, serving_kpis
from marquee.operators.landing import land_table, lenient_casts, lost_in_cast, needs_refresh
from marquee.operators.runlog import log_rows, serving_run_log
from marquee.plans.incremental import refresh_fact, refresh_person_sums
from marquee.plans.journal import RAW, Journal, digest
from marquee.sources import paths, versions
from marquee.sources.files import (
    BAD_LINE,
    Drift,
    drift,
    header_schema,
    reconciled_schema,
    scan_table,
    scan_tsv_checked,
    with_schema,
)
from marquee.sources.tables import (
    append_table,
    beside,
    compact_table,
    evenly,
    overwrite_table,
    refuse_duplicates,
    table_exists,
    upsert_table,
)
from marquee.specs import (
    AGGREGATED,
    BATCH_DATE_COLUMN,
    CACHE,
    CLEANSED,
    CLEANSED_STAGES,
    DIM_NAMES,
    DIM_TITLES,
    FACT,
    FAILURE,
    KPIS,
    LANDING,
    NAME_BASICS,
    NOTES,
    NOTES_SCHEMA,
    PERSON_SUMS,
    REJECTED,
    ROLE_KPIS,
    RUN_LOG,
    RUN_LOG_SCHEMA,
    SERVED_RUN_LOG,
    SUCCESS,
    TABLES,
    TITLE_BASICS,
    TITLE_PRINCIPALS,
    TITLE_RATINGS,
    TableSpec,
)

Publish = Callable[[DataFrame, str], None]
LOG_FILES = 1_000  # of the run log; more are packed
MAX_BAD_SHARE = 0.01  # of the lines of a raw file, and of the rows that a lenient cast may cost a value; more fail its stage


def raw_paths(root: str) -> dict[str, str]:
    """Where the raw files are looked for under ``root``."""
    return {name: f"{root}/{CACHE}/{name}.tsv.gz" for name in TABLES}


def read_run_log(spark: SparkSession, root: str) -> DataFrame:
    """The run log under ``root``; empty if there is none yet."""
    path = f"{root}/{RUN_LOG}"
    return scan_table(spark, path, RUN_LOG_SCHEMA) if table_exists(spark, path) else log_rows(spark)


def read_landed(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    return scan_table(spark, f"{root}/{LANDING}/{spec.name}", spec.landed_schema)


class Batch:
    """One run of the batch for one date.

    Stages pass their data on as tables under ``root``, so each can also be run, and run again after
    a failure, on its own. With a ``run_id``, log rows of an attempt that is repeated under the same one replace
    those that it left before; without one every attempt has its rows. A repeated attempt replaces the bad
    lines that it set aside for its date in any case.

    A named run that broke off goes on where it stopped when it is run again under its name: what is finished, by the
    ``Journal``, is left as it is, unless a raw file or a table that it was made from is another now. While it runs, no
    other run may.

    Raw columns are told by name: a header may have another order and further columns, and may lack those that are not
    ``required``. What was left out, what is NULL for that, and how many values casts have lost, is noted in
    ``landing_notes/<table>``.
    """

    def __init__(
        self,
        spark: SparkSession,
        inputs: dict[str, str],
        root: str,
        batch_date: date,
        publish: Publish | None = None,
        max_bad_share: float = MAX_BAD_SHARE,
        run_id: str | None = None,
    ):
        self.spark = spark
        self.max_bad_share = max_bad_share
        self.run_id = run_id
        self.inputs = inputs
        self.root = root
        self.batch_date = batch_date
        self.publish = publish
        self.journal = Journal(spark, root, run_id)

    def run(self) -> None:
        """All stages in order. A failing stage is logged and raised; the log is published anyway."""
        with self.journal:
            try:
                self.check_inputs()
                self.land()
                self.cleanse()
                self.aggregate()
            finally:
                self.publish_run_log()

    def check_inputs(self) -> None:
        self._stages({(CACHE, name): lambda name=name: self._require(name) for name in self.inputs})

    def land(self) -> None:
        actions = self._landing_actions()
        self._stages({(LANDING, name): lambda name=name: self._land(name, actions[name]) for name in self.inputs})

    def cleanse(self) -> None:
        tables = {DIM_NAMES: self._dim_names, DIM_TITLES: self._dim_titles, FACT: self._fact}
        self._stages({(CLEANSED_STAGES[table], table): job for table, job in tables.items()})

    def aggregate(self) -> None:
        self._stages({(AGGREGATED, KPIS): self._kpis})

    def publish_run_log(self) -> None:
        if self.publish:
            self.publish(serving_run_log(read_run_log(self.spark, self.root)), SERVED_RUN_LOG)

    def _stages(self, jobs: dict[tuple[str, str], Callable[[], None]]) -> None:
        """Run independent jobs side by side, log every outcome, then raise the failures: one as it is, several as a group."""
        with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
            outcomes = {target: pool.submit(self._once, *target, job) for target, job in jobs.items()}
        failures = {target: outcome.exception() for target, outcome in outcomes.items()}
        rows = [
            (stage, table, self.batch_date, FAILURE if failure else SUCCESS)
            for (stage, table), failure in failures.items()
        ]
        batch = f"{self.run_id} {' '.join(f'{stage}/{table}' for stage, table in jobs)}" if self.run_id else ""
        path = f"{self.root}/{RUN_LOG}"
        append_table(log_rows(self.spark, rows).coalesce(1), path, "table_name", batch)
        compact_table(self.spark, path, "table_name", LOG_FILES)
        raised = [failure for failure in failures.values() if failure]
        if len(raised) == 1:
            raise raised[0]
        if raised:
            raise BaseExceptionGroup("several stages failed", raised)

    def _once(self, stage: str, table: str, job: Callable[[], None]) -> None:
        """The job of a stage, unless this run has finished it and nothing has changed since."""
        if self.run_id is None or stage == CACHE:
            job()
            return
        reads = self._reads(stage, table)
        if not self.journal.finished(stage, table, reads, self._wrote(stage, table)):
            job()
            self.journal.finish(stage, table, reads, self._wrote(stage, table))

    def _reads(self, stage: str, table: str) -> dict:
        if stage == LANDING:
            return {"date": str(self.batch_date), "files": paths.stamps(self.spark, self.inputs[table])}
        tables = {
            DIM_NAMES: [(LANDING, NAME_BASICS.name)],
            DIM_TITLES: [(LANDING, TITLE_BASICS.name)],
            FACT: [(LANDING, spec.name) for spec in (TITLE_BASICS, TITLE_RATINGS, TITLE_PRINCIPALS)],
            KPIS: [(CLEANSED, DIM_NAMES), (CLEANSED, FACT)],
        }
        return self._versions(tables[table])

    def _wrote(self, stage: str, table: str) -> dict[str, int]:
        if stage == AGGREGATED:
            return self._versions([(stage, t) for t in (PERSON_SUMS, ROLE_KPIS, KPIS)])
        return self._versions([(LANDING if stage == LANDING else CLEANSED, table)])

    def _versions(self, tables: list[tuple[str, str]]) -> dict[str, int]:
        found = {f"{zone}/{table}": versions.current(self.spark, self._path(zone, table)) for zone, table in tables}
        return {name: version.number if version else 0 for name, version in found.items()}

    def _path(self, zone: str, table: str) -> str:
        return f"{self.root}/{zone}/{table}"

    def _require(self, name: str) -> None:
        if not paths.exists(self.spark, self.inputs[name]):
            raise FileNotFoundError(f"no input for {name}: {self.inputs[name]}")

    def _landing_actions(self) -> dict[str, str]:
        rows = [(LANDING, name, table_exists(self.spark, self._path(LANDING, name))) for name in self.inputs]
        wanted = self.spark.createDataFrame(rows, "stage string, table_name string, table_exists boolean")
        answers = needs_refresh(read_run_log(self.spark, self.root), wanted, self.batch_date).collect()
        return {row["table_name"]: row["action"] for row in answers}

    def _land(self, name: str, action: str) -> None:
        spec, path = TABLES[name], self._path(LANDING, name)
        raw_files = None
        if self.run_id is not None:
            # The version that a run has published says what is in it, so a run that died right then lands nothing twice.
            raw_files = {RAW: digest(self._reads(LANDING, name))}
            stored = versions.current(self.spark, path)
            if stored is not None and stored.sources == raw_files:
                return
            if action == "skip":  # by the log, but the raw files are others now
                action = "upsert"
        if action == "skip":
            return
        lines = beside(path, "lines")
        try:
            raw = self._checked(name, spec, lines, self._known(spec, path, action))
            # On a later day rows below the vote threshold also take back the row that their key had.
            lasting = None if spec.min_votes is None else F.col("numVotes") > spec.min_votes
            landed = land_table(raw, replace(spec, min_votes=None) if action == "upsert" else spec, self.batch_date)
            if action == "upsert":
                upsert_table(
                    landed, path, list(spec.primary_key), spec.partition_by, spec.on_duplicate, keep=lasting, sources=raw_files, stored=True
                )
                return
            if spec.on_duplicate == "error":
                refuse_duplicates(landed, list(spec.primary_key))
            overwrite_table(evenly(landed, spec.partition_by), path, spec.partition_by, raw_files)
        finally:
            paths.delete(self.spark, lines)

    def _known(self, spec: TableSpec, path: str, action: str) -> StructType | None:
        """The raw columns that are expected: those of the spec, or else those that the table has, as text; None before the first load."""
        if spec.schema is not None or action != "upsert":
            return spec.schema
        stored = scan_table(self.spark, path).columns
        return StructType([StructField(column, StringType()) for column in stored if column != BATCH_DATE_COLUMN])

    def _checked(self, name: str, spec: TableSpec, lines: str, known: StructType | None) -> DataFrame:
        """The good lines of a raw file, which is read once into the table ``lines``; bad ones are kept aside."""
        header = header_schema(self.spark, self.inputs[name])
        schema = known or header
        scan_tsv_checked(self.spark, self.inputs[name], reconciled_schema(header, schema, spec.required)).write.parquet(lines)
        stored = scan_table(self.spark, lines)
        read = with_schema(stored, StructType([*schema.fields, StructField(BAD_LINE, StringType())]))
        casts = lenient_casts(read, spec.casts)
        losses = [lost_in_cast(column, kind) for column, kind in casts.items()]
        n_lines, n_bad, *n_lost = read.agg(F.count(F.lit(1)), F.count(BAD_LINE), *losses).first()
        lost = dict(zip(casts, n_lost, strict=True))
        self._note(name, drift(header, schema) if header.names else Drift((), (), False), lost)
        if n_bad:
            bad = read.filter(F.col(BAD_LINE).isNotNull()).select(F.lit(self.batch_date).alias(BATCH_DATE_COLUMN), F.col(BAD_LINE).alias("line"))
            append_table(bad, f"{self.root}/{REJECTED}/{name}", batch=str(self.batch_date))
        if n_bad > self.max_bad_share * n_lines:
            raise ValueError(f"{n_bad} of {n_lines} lines of {name} do not fit; they are in {REJECTED}/{name}")
        for column, n in lost.items():
            if n > self.max_bad_share * n_lines:
                raise ValueError(f"{n} of {n_lines} values of {column} in {name} are no {casts[column].simpleString()}")
        return read.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)

    def _note(self, name: str, change: Drift, lost: dict[str, int]) -> None:
        """What the raw file of this date had otherwise than expected, in place of what an earlier attempt has noted."""
        notes = [("missing", column, None) for column in change.missing] + [("left out", column, None) for column in change.extra]
        notes += [("other order", None, None)] * change.moved + [("lost in cast", column, n) for column, n in lost.items() if n]
        path = f"{self.root}/{NOTES}/{name}"
        if notes or table_exists(self.spark, path):
            rows = [(self.batch_date, name, *note) for note in notes]
            append_table(self.spark.createDataFrame(rows, NOTES_SCHEMA).coalesce(1), path, batch=str(self.batch_date))

    def _dim_names(self) -> None:
        names = read_landed(self.spark, self.root, NAME_BASICS)
        overwrite_table(dim_names(names), self._path(CLEANSED, DIM_NAMES))

    def _dim_titles(self) -> None:
        titles = read_landed(self.spark, self.root, TITLE_BASICS)
        overwrite_table(dim_titles(titles), self._path(CLEANSED, DIM_TITLES))

    def _fact(self) -> None:
        refresh_fact(self.spark, self.root)

    def _kpis(self) -> None:
        refresh_person_sums(self.spark, self.root)
        names = scan_table(self.spark, self._path(CLEANSED, DIM_NAMES))
        sums = scan_table(self.spark, self._path(AGGREGATED, PERSON_SUMS))
        # Stored once, a row per person and role; the rows per credit and the published ones come from it.
        path = self._path(AGGREGATED, ROLE_KPIS)
        overwrite_table(role_rows(names, indicators(sums)), path)
        by_role = scan_table(self.spark, path)
        overwrite_table(per_credit(by_role), self._path(AGGREGATED, KPIS))
        if self.publish:
            self.publish(serving_kpis(by_role), KPIS)


def run_batch(
    spark: SparkSession,
    inputs: dict[str, str],
    root: str,
    batch_date: date,
    publish: Publish | None = None,
    run_id: str | None = None,
) -> None:
    """Run the daily batch over raw ``inputs`` (table name to path) into tables under ``root``.

    ``publish`` receives each frame for the serving store with its table name, for example
    ``JdbcTarget(...).overwrite``. A run with a ``run_id`` that broke off is resumed when it is run under it again.
    """
    Batch(spark, inputs, root, batch_date, publish, run_id=run_id).run()
