"""Which stages of a named run are finished, and which run is at work: small files below the root of the tables.

An entry says what a stage has read (length and modification time of raw files, versions of tables) and which versions it
has written. A stage counts as finished only if all of that is still so; a changed input, or a table that
another run has replaced since, makes it run again. The lock keeps a second run out. A run that died leaves its lock,
which the same run, named again, takes over.
"""

from __future__ import annotations

import json
import re
from hashlib import sha256

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from marquee.sources import paths
from marquee.specs import JOURNAL

_END = "end"
_RUN_ID = re.compile(r"[\w-][\w.-]*")
RAW = "raw"  # under which a landed table's version says which files are in it


def digest(reads: dict) -> int:
    """A number of 56 bits for what a stage reads."""
    return int.from_bytes(sha256(json.dumps(reads, sort_keys=True).encode()).digest()[:7], "big")


class Journal:
    """The journal of run ``run_id``. As a context it holds the lock; without a name it only looks for another's."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None):
        if run_id is not None and not _RUN_ID.fullmatch(run_id):
            raise ValueError(f"a run's name is made of letters, digits, _, - and .: {run_id!r}")
        self.spark = spark
        self.run_id = run_id
        self.folder = f"{root}/{JOURNAL}"
        self.lock = f"{self.folder}/_lock"

    def __enter__(self) -> Journal:
        holder = self.holder()
        if holder is None and self.run_id is not None:
            try:
                paths.create_text(self.spark, self.lock, f"{self.run_id}\n{_END}")
                return self
            except Py4JJavaError as error:
                if "AlreadyExists" not in str(error.java_exception):
                    raise
                holder = self.holder()
        if holder is not None and holder != self.run_id:
            raise RuntimeError(f"run {holder!r} is at work, or broke off: name it to resume it, or delete {self.lock}")
        return self

    def __exit__(self, kind, error, trace) -> None:
        """A run that fails gives the lock back; only a driver that dies leaves it. A run that succeeds removes the entries of others."""
        if self.run_id is None:
            return
        if kind is None:
            for name in paths.names(self.spark, self.folder):
                if name not in (self.run_id, "_lock"):
                    paths.delete(self.spark, f"{self.folder}/{name}")
        paths.delete(self.spark, self.lock)

    def holder(self) -> str | None:
        """The run that has the lock; '' if it died while it took it."""
        if not paths.exists(self.spark, self.lock):
            return None
        lines = paths.read_text(self.spark, self.lock).splitlines()
        return lines[0] if lines[-1:] == [_END] else ""

    def _entry(self, stage: str, table: str) -> str:
        return f"{self.folder}/{self.run_id}/{stage}.{table}"

    def finished(self, stage: str, table: str, reads: dict, wrote: dict) -> bool:
        path = self._entry(stage, table)
        if self.run_id is None or not paths.exists(self.spark, path):
            return False
        lines = paths.read_text(self.spark, path).splitlines()
        return lines[-1:] == [_END] and json.loads(lines[0]) == {"reads": reads, "wrote": wrote}

    def finish(self, stage: str, table: str, reads: dict, wrote: dict) -> None:
        if self.run_id is None:
            return
        path = self._entry(stage, table)
        paths.delete(self.spark, path)
        paths.create_text(self.spark, path, json.dumps({"reads": reads, "wrote": wrote}) + f"\n{_END}")
