"""What a run of tasks has done so far, so that a second start goes on where the first one stopped.

Each task of a run has a folder. A phase that is over is a small file there, which appears by
one rename that never replaces another file; tables a later phase starts from lie beside it.
Files added to tables that are changed file by file carry the run's and the task's name, so
what was published just before a stop is found and not published again.

A start claims a task by a numbered file. Only the latest claim may end a phase: a start that
was thought dead and is not fails at its next phase and publishes nothing more there.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rowmend.sources.versions import ChangedMeanwhile, VersionedTable, current_version, publish, rename_new, table_files, write_files

COMPARED, STAGED, WRITTEN, LOGGED = "compared", "staged", "written", "logged"
PHASES = (COMPARED, STAGED, WRITTEN, LOGGED)
APPEND_TRIES = 20


class Overtaken(RuntimeError):
    """A later start of the same run has claimed the task."""


def safe_name(text: str) -> str:
    """A text as part of a file name; different texts stay different."""
    return re.sub(r"[^A-Za-z0-9-]", lambda m: f"_{ord(m[0]):x}_", text)


class TaskLedger:
    """Phases of one task of one run, below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str, table_id: str) -> None:
        self.spark, self.mark = spark, f"{safe_name(run_id)}.{safe_name(table_id)}"
        self.path = f"{folder.rstrip('/')}/{safe_name(run_id)}/{safe_name(table_id)}"
        self.attempt = self._claim()

    def _place(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _write_new(self, name: str, text: str) -> bool:
        """Whether the file appeared; False if there is one already."""
        files, draft = self._place(f".{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        _, final = self._place(name)
        return rename_new(self.spark, draft, final)

    def _claims(self) -> int:
        files, place = self._place("claims")
        return len(files.listStatus(place)) if files.exists(place) else 0

    def _claim(self) -> int:
        while True:
            number = self._claims()
            files, place = self._place("claims")
            files.mkdirs(place)
            if self._write_new(f"claims/{number:06d}", ""):
                return number

    def done(self, phase: str) -> dict | None:
        """What the phase left behind, or None if it is not over."""
        files, place = self._place(phase)
        if not files.exists(place):
            return None
        stream = files.open(place)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def end(self, phase: str, content: Mapping[str, object]) -> None:
        """The phase is over. Fails if a later start has claimed the task."""
        self.hold()
        self._write_new(phase, json.dumps(dict(content)))

    def hold(self) -> None:
        if self._claims() != self.attempt + 1:
            raise Overtaken(f"{self.path} was claimed by a later start")

    def table(self, name: str) -> str:
        """Where this start keeps a table for later phases."""
        return f"{self.path}/{name}-{self.attempt}"


def append_once(rows: DataFrame, spec: VersionedTable, mark: str) -> bool:
    """Adds the rows as new files unless files of this mark are there; whether it did.

    Appends by others do not matter to each other, so one that was published meanwhile is
    only a reason to try again with the same files.
    """
    spark = rows.sparkSession
    if has_mark(spark, spec, mark):
        return False
    added = write_files(rows, spec, mark)
    for _ in range(APPEND_TRIES):
        base = current_version(spark, spec)
        files = table_files(spark, VersionedTable(spec.path, spec.schema, base))
        if any(f"/{mark}." in f for f in files):
            return False
        try:
            publish(spark, spec, base, [*files, *added])
            return True
        except ChangedMeanwhile:
            continue
    raise ChangedMeanwhile(f"{spec.path} changed {APPEND_TRIES} times in a row")


def has_mark(spark: SparkSession, spec: VersionedTable, mark: str) -> bool:
    return any(f"/{mark}." in f for f in table_files(spark, spec))
