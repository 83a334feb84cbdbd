"""Repair of a table of files that rewrites only the files it has to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from rowmend.operators.filters import delete_where
from rowmend.operators.lookup import KeyRanges, covering_ranges, lookup_by_ranges
from rowmend.operators.ranks import quoted
from rowmend.operators.repair import apply_repair, inserted_rows
from rowmend.sources.versions import (
    FILE,
    VersionedTable,
    current_version,
    publish,
    read_files,
    relative,
    table_files,
    with_file,
    write_files,
)


@dataclass(frozen=True)
class FileRepair:
    """What a repair did: the version it published, files rewritten, files added, files left as they were."""

    version: int
    rewritten: tuple[str, ...]
    added: tuple[str, ...]
    kept: int


def files_with_keys(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], null_safe: bool = True, ranges: KeyRanges | None = None) -> DataFrame:
    """Names of the files that hold a row of the wanted keys; only key columns are read, and only near those keys."""
    found = lookup_by_ranges(with_file(rows).select(*quoted(keys), FILE), wanted, keys, null_safe, ranges)
    return found.select(FILE).distinct()


def repair_files(
    spark: SparkSession,
    spec: VersionedTable,
    patch: DataFrame,
    keys: Sequence[str],
    mode: str = "update",
    primary_key: bool = False,
    delete: Column | str | None = None,
    base: int | None = None,
    mark: str = "",
) -> FileRepair:
    """Applies the patch to a table in place, with the rows ``apply_repair`` would give.

    Rows of the patch's keys, and those that ``delete`` names, lie in some files. Those are
    read and written anew; all others keep their name and their content. ``insert`` rewrites
    none but for deletion: new rows go to new files. The new state is published at once, and
    only if the table is still at version ``base``, the one it was compared in. ``patch`` should
    be written down, as it is used several times. New files lie in a folder whose name begins
    with ``mark``.
    """
    base = current_version(spark, spec) if base is None else base
    at_base = VersionedTable(spec.path, spec.schema, base)
    files = table_files(spark, at_base)
    whole = read_files(spark, at_base, files)
    wanted = patch.select(*quoted(keys)).distinct()
    ranges = covering_ranges(wanted, keys)
    inserts = (mode or "").lower() == "insert"

    named = lambda found: {relative(spark, spec, r[FILE]) for r in found.collect()}
    # One row per file at most, as many as the file index on the driver has.
    holding = named(files_with_keys(whole, wanted, keys, not primary_key, ranges)) if files else set()
    dropped = named(with_file(whole).where(delete).select(FILE).distinct()) if files and delete is not None else set()
    touched = sorted(dropped if inserts else holding | dropped)
    rows = read_files(spark, at_base, sorted(holding), whole.schema)
    rows = rows if delete is None else delete_where(rows, delete)
    if inserts:
        new_rows = inserted_rows(rows, patch, keys, primary_key)
        if dropped:
            new_rows = delete_where(read_files(spark, at_base, touched, whole.schema), delete).unionByName(new_rows)
    else:
        only_deleted = sorted(dropped - holding)
        new_rows = apply_repair(rows, patch, keys, mode, primary_key)
        if only_deleted:
            new_rows = new_rows.unionByName(delete_where(read_files(spark, at_base, only_deleted, whole.schema), delete))
    added = write_files(new_rows, spec, mark)
    kept = [f for f in files if f not in set(touched)]
    version = publish(spark, spec, base, [*kept, *added])
    return FileRepair(version, tuple(touched), tuple(added), len(kept))
