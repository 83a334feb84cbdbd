"""Tables of Parquet files that are changed file by file.

A table is a folder. The files Spark finds in it are its first version. Each change writes
new files below ``_data``, where a plain reader of the folder does not look, and publishes a
list of the files that make up the table from then on. The list appears by one rename that
never replaces another list: a change is seen whole or not at all, and of two changes of the
same version one fails. Files that are not rewritten keep their name and their time, and
earlier versions can be read until ``remove_unreferenced`` deletes what no kept version needs.

As in Spark's own file index, the driver holds the names of a table's files, never rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LISTS, DATA = "_versions", "_data"
FILE = "_rowmend_file"
_NAME = re.compile(r"v(\d{12})")


@dataclass(frozen=True)
class VersionedTable:
    """A folder of Parquet files; ``version`` reads an earlier state, 0 being the folder's own files."""

    path: str
    schema: T.StructType | str | None = None
    version: int | None = None


class ChangedMeanwhile(RuntimeError):
    """Another change of the same version was published first."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, place):
    return place.getFileSystem(spark._jsc.hadoopConfiguration())


def _root(spark: SparkSession, path: str) -> str:
    """The folder's full name, as those of its files begin."""
    place = _path(spark, path)
    return _files(spark, place).makeQualified(place).toString().rstrip("/")


def _children(spark: SparkSession, path: str) -> list:
    place = _path(spark, path)
    files = _files(spark, place)
    return list(files.listStatus(place)) if files.exists(place) else []


def versions(spark: SparkSession, spec: VersionedTable) -> list[int]:
    """The published versions, ascending; 0 is not among them."""
    names = (_NAME.fullmatch(f.getPath().getName()) for f in _children(spark, f"{spec.path}/{LISTS}"))
    return sorted(int(n[1]) for n in names if n)


def current_version(spark: SparkSession, spec: VersionedTable) -> int:
    if spec.version is not None:
        return spec.version
    return max(versions(spark, spec), default=0)


def _own_files(spark: SparkSession, spec: VersionedTable) -> list[str]:
    """The files of a folder without any published list, relative to it."""
    root = _root(spark, spec.path)
    found = []
    for f in _children(spark, spec.path):
        name = f.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if f.isDirectory():
            raise ValueError(f"{name} in {spec.path}: tables in sub-folders cannot be changed file by file")
        found.append(f.getPath().toString().removeprefix(root + "/"))
    return sorted(found)


def table_files(spark: SparkSession, spec: VersionedTable) -> list[str]:
    """The files of the table's version, relative to its folder."""
    version = current_version(spark, spec)
    if version == 0:
        return _own_files(spark, spec)
    place = _path(spark, f"{spec.path}/{LISTS}/v{version:012d}")
    stream = _files(spark, place).open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text.split("\n")[:-1]


def read_files(spark: SparkSession, spec: VersionedTable, files: Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """The rows of some of the table's files."""
    schema = schema or spec.schema
    if not files:
        if schema is None:
            raise ValueError(f"{spec.path} has no files, so its columns must be given")
        return spark.createDataFrame([], schema)
    root = _root(spark, spec.path)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*[f"{root}/{f}" for f in files])


def open_version(spark: SparkSession, spec: VersionedTable) -> DataFrame:
    """The table as it is now, or in the version asked for; later changes do not reach a frame that is open."""
    return read_files(spark, spec, table_files(spark, spec))


def with_file(rows: DataFrame, name: str = FILE) -> DataFrame:
    """Rows with the name of the file they are in."""
    return rows.select("*", rows["_metadata.file_path"].alias(name))


def relative(spark: SparkSession, spec: VersionedTable, name: str) -> str:
    """A file's name as lists have it."""
    root = _root(spark, spec.path)
    plain = unquote(name)
    # One slash or three after the scheme name the same file.
    short = lambda text: re.sub(r"^(\w+):/+", r"\1:/", text)
    return short(plain).removeprefix(short(root) + "/")


def write_files(rows: DataFrame, spec: VersionedTable, mark: str = "") -> list[str]:
    """New files with the rows, not yet part of any version; their names, in a folder that begins with ``mark``."""
    spark, folder = rows.sparkSession, f"{DATA}/{mark}.{uuid.uuid4().hex}" if mark else f"{DATA}/{uuid.uuid4().hex}"
    rows.write.parquet(f"{spec.path}/{folder}")
    names = (f.getPath().getName() for f in _children(spark, f"{spec.path}/{folder}"))
    return sorted(f"{folder}/{n}" for n in names if not n.startswith(("_", ".")))


def rename_new(spark: SparkSession, draft, final) -> bool:
    """Gives a file its final name at once; False, and the draft goes, if that name is taken."""
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    none = spark.sparkContext._gateway.new_array(options, 1)
    none[0] = options.NONE
    files = _files(spark, draft)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(final), none)
    except Exception as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def publish(spark: SparkSession, spec: VersionedTable, base: int, files: Sequence[str]) -> int:
    """Makes the files the version after ``base``; fails if there is one already."""
    lists, version = f"{spec.path}/{LISTS}", base + 1
    if max(versions(spark, spec), default=0) != base:
        raise ChangedMeanwhile(f"{spec.path} is no longer at version {base}")
    draft, final = _path(spark, f"{lists}/.{uuid.uuid4().hex}"), _path(spark, f"{lists}/v{version:012d}")
    stream = _files(spark, draft).create(draft, False)
    try:
        stream.write(bytearray("".join(f"{name}\n" for name in files).encode()))
    finally:
        stream.close()
    if not rename_new(spark, draft, final):
        raise ChangedMeanwhile(f"version {version} of {spec.path} was published meanwhile")
    return version


def remove_unreferenced(spark: SparkSession, spec: VersionedTable, keep: int = 1) -> list[str]:
    """Deletes the lists before the last ``keep`` versions, and new files that no kept list names.

    Files that belong to a change in progress count as unreferenced: run it when there is none.
    The folder's own files stay, as plain readers see them. Returns what was deleted.
    """
    known = versions(spark, spec)
    kept, old = known[len(known) - keep :] if keep else [], known[: max(len(known) - keep, 0)]
    needed = {f for v in kept for f in table_files(spark, VersionedTable(spec.path, version=v))}
    gone = []
    for folder in _children(spark, f"{spec.path}/{DATA}"):
        for f in _children(spark, folder.getPath().toString()):
            name = f"{DATA}/{folder.getPath().getName()}/{f.getPath().getName()}"
            if name not in needed:
                _files(spark, f.getPath()).delete(f.getPath(), False)
                gone.append(name)
    for version in old:
        place = _path(spark, f"{spec.path}/{LISTS}/v{version:012d}")
        _files(spark, place).delete(place, False)
    return sorted(n for n in gone if not n.rsplit("/", 1)[-1].startswith(("_", ".")))
