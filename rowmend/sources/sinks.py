"""Result log and repaired tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmend.sources.jdbc import connection_options
from rowmend.sources.tables import CatalogTable, FileTable, TableSpec
from rowmend.sources.versions import VersionedTable, rename_new

TEXT, COUNT, TIME, NUMBER = T.StringType(), T.LongType(), T.TimestampNTZType(), T.DoubleType()

# The columns of the result log.
RESULT_LOG = (
    T.StructType()
    .add("table_id", TEXT)
    .add("compare_time", TIME)
    .add("compare_status", TEXT)
    .add("compare_msg", TEXT)
    .add("src_db_id", TEXT)
    .add("src_db_name", TEXT)
    .add("src_table_name", TEXT)
    .add("tgt_db_name", TEXT)
    .add("tgt_table_name", TEXT)
    .add("check_range", TEXT)
    .add("check_column", TEXT)
    .add("src_cnt", COUNT)
    .add("tgt_cnt", COUNT)
    .add("compare_start_time", TIME)
    .add("compare_end_time", TIME)
    .add("compare_cost_minute", NUMBER)
    .add("diff_cnt", COUNT)
    .add("compare_report", TEXT)
    .add("html_report", TEXT)
    .add("repair_status", TEXT)
    .add("repair_cnt", COUNT)
    .add("repair_start_time", TIME)
    .add("repair_end_time", TIME)
    .add("repair_cost_minute", NUMBER)
    .add("repair_job_file", TEXT)
    .add("compare_total_cost_minute", NUMBER)
    .add("is_delete", T.IntegerType())
    .add("create_time", TIME)
    .add("update_time", TIME)
    .add("repair_msg", TEXT)
)


def as_result_log(df: DataFrame) -> DataFrame:
    """The table in the log's columns and types; what it lacks stays NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RESULT_LOG.fields
        ]
    )


def append_table(df: DataFrame, spec: TableSpec) -> None:
    if isinstance(spec, VersionedTable):
        raise ValueError("a table changed file by file is appended to under a mark (append_once)")
    if isinstance(spec, FileTable):
        df.write.format(spec.format).options(**spec.options).mode("append").save(spec.path)
    elif isinstance(spec, CatalogTable):
        df.write.mode("append").saveAsTable(spec.name)
    else:
        options = connection_options(spec) | {"dbtable": spec.qualified}
        df.write.format("jdbc").options(**options).mode("append").save()


def write_table_at_once(df: DataFrame, spec: FileTable | CatalogTable, mark: str) -> bool:
    """A new table that appears whole by one rename; whether it was written, as one of an earlier start stays."""
    if not isinstance(spec, FileTable):
        if table_exists(df.sparkSession, spec):
            return False
        write_table(df, spec)
        return True
    spark = df.sparkSession
    if table_exists(spark, spec):
        return False
    final = spark._jvm.org.apache.hadoop.fs.Path(spec.path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{mark}")
    df.write.format(spec.format).options(**spec.options).mode("overwrite").save(draft.toString())
    return rename_new(spark, draft, final)


def append_result_log(df: DataFrame, spec: TableSpec) -> None:
    append_table(as_result_log(df), spec)


def table_exists(spark: SparkSession, spec: FileTable | CatalogTable) -> bool:
    if isinstance(spec, FileTable):
        place = spark._jvm.org.apache.hadoop.fs.Path(spec.path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return isinstance(spec, CatalogTable) and spark.catalog.tableExists(spec.name)


def write_table(df: DataFrame, spec: FileTable | CatalogTable) -> None:
    """A repaired table as a new table. It must not be the one it was computed from."""
    if isinstance(spec, FileTable):
        df.write.format(spec.format).options(**spec.options).mode("errorifexists").save(spec.path)
    elif isinstance(spec, CatalogTable):
        df.write.mode("errorifexists").saveAsTable(spec.name)
    else:
        raise ValueError("a database table is repaired in place: append the patch or merge it")


def merge_into(patch: DataFrame, table: str, keys: Sequence[str], mode: str = "update"):
    """A MERGE of the patch into a catalog table whose format supports it; run with ``.merge()``.

    Not available for plain Parquet tables: those are rewritten (``apply_repair``).
    """
    on = [F.col(f"{table}.{k}").eqNullSafe(F.col(f"patch.{k}")) for k in keys]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    writer = patch.alias("patch").mergeInto(table, condition)
    given = {c: F.col(f"patch.`{c}`") for c in patch.columns}
    missing = {c: F.lit(None) for c in patch.sparkSession.table(table).columns if c not in given}
    if mode == "insert":
        return writer.whenNotMatched().insert(given | missing)
    # A replaced row keeps nothing of the old one; an updated row keeps what the patch does not have.
    return writer.whenMatched().update(given | missing if mode == "replace" else given).whenNotMatched().insert(given | missing)
