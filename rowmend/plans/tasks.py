"""Task tables: which comparisons to run, whether their entries are complete, what came out."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from rowmend.functions.columns import ColumnRoles, compare_columns, fold_names, split_names
from rowmend.functions.crypto import decrypt_column
from rowmend.functions.times import format_range, window_bounds
from rowmend.operators.compare import DIFF_TYPE, MATCH, SRC_ONLY, LeastDiff, compare_least, compare_rows
from rowmend.operators.confirm import RESOLVED, STATE, confirm_differences
from rowmend.operators.filters import delete_where, incremental_filter, needs_alert_compare, needs_alert_repair
from rowmend.operators.keys import any_null
from rowmend.operators.lookup import covering_ranges, within
from rowmend.operators.ranks import assign_batches, quoted
from rowmend.operators.repair import (
    apply_repair,
    batch_outcome,
    repair_gate,
    repair_keys,
    repair_outcome,
    repair_rows,
    repair_window,
    verify_repair,
)
from rowmend.operators.slices import scan_by_keys
from rowmend.operators.summary import compare_sentence, count_columns, rate
from rowmend.operators.touched import repair_files
from rowmend.sources.jdbc import RUN_ID, JdbcTable, primary_keys
from rowmend.plans.ledger import COMPARED, LOGGED, STAGED, WRITTEN, TaskLedger, append_once, has_mark
from rowmend.plans.limits import timed
from rowmend.sources.sinks import append_result_log, append_table, as_result_log, table_exists, write_table, write_table_at_once
from rowmend.sources.storage import materialize, new_path, stored, working_tables
from rowmend.sources.tables import CatalogTable, FileTable, TableSpec, scan_by_key, scan_table
from rowmend.sources.versions import VersionedTable, current_version

logger = logging.getLogger(__name__)

# Entries every task needs.
REQUIRED_FIELDS = (
    "src_db_type",
    "src_host",
    "src_port",
    "src_username",
    "src_password",
    "src_db_name",
    "src_table_name",
    "tgt_db_type",
    "tgt_host",
    "tgt_port",
    "tgt_username",
    "tgt_password",
    "tgt_db_name",
    "tgt_table_name",
)


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Task table out of a JSON file holding one object or a list of them."""
    return spark.read.json(path, multiLine=True)


def active_tasks(tasks: DataFrame, task_id: int | None = None) -> DataFrame:
    """Tasks that are not deleted, all or one."""
    live = tasks.where(F.col("is_delete") == 0)
    return live if task_id is None else live.where(F.col("id") == task_id)


def validate_tasks(tasks: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """The tasks with ``missing_fields``, the required entries they lack, and ``is_valid``."""
    present = set(tasks.columns)
    absent = [F.when(F.col(n).isNull(), F.lit(n)) if n in present else F.lit(n) for n in required]
    return tasks.withColumn("missing_fields", F.array_compact(F.array(*absent))).withColumn(
        "is_valid", F.size("missing_fields") == 0
    )


@dataclass(frozen=True)
class CompareTask:
    """One pair of tables and how to compare and repair it.

    ``keys`` and ``primary_key`` may be functions that ask the databases for them. The whole
    repaired table goes to ``output``; ``patch_output`` gets just the rows to write, for
    instance a staging table in the target's database. ``in_place`` is the target itself, if
    it is a table that is changed file by file: only files with rows to repair are rewritten.
    ``confirm`` looks at differing rows a second time, in tables opened anew, and leaves alone
    what agrees by then; the counts are those of the first look.
    ``max_repair_rows`` refuses larger repairs; without it there is no limit. ``check_after`` is a condition that no row of the
    repaired table may break.
    """

    table_id: str
    source: Callable[[SparkSession], DataFrame]
    target: Callable[[SparkSession], DataFrame]
    keys: Sequence[str] | Callable[[SparkSession], Sequence[str]]
    src_db_id: str | None = None
    src_db_name: str = ""
    src_table_name: str = ""
    tgt_db_name: str = ""
    tgt_table_name: str = ""
    update_column: str | None = None
    sensitive: str = ""
    include_extra: bool = True
    include_strings: bool = False
    incremental_days: float | None = None
    as_of: datetime | None = None
    abs_tol: float = 0.0
    rel_tol: float = 0.0
    primary_key: bool | Callable[[SparkSession], bool] = False
    enable_repair: bool = False
    max_repair_rows: int | None = None
    batch_size: int = 3000
    time_filter: bool = False
    time_tolerance: float = 0.0
    repair_scope: str = "diff"
    delete_before: str | None = None
    check_after: str | None = None
    write_mode: str = "update"
    output: FileTable | CatalogTable | None = None
    patch_output: TableSpec | None = None
    run_id: str | None = None
    in_place: VersionedTable | None = None
    confirm: bool = False

    def resolved(self, spark: SparkSession) -> CompareTask:
        keys = list(self.keys(spark)) if callable(self.keys) else self.keys
        unique = self.primary_key(spark) if callable(self.primary_key) else self.primary_key
        return replace(self, keys=keys, primary_key=unique)

    def roles(self, src: DataFrame) -> ColumnRoles:
        return compare_columns(
            src.schema, self.keys, self.update_column, self.sensitive, self.include_extra, self.include_strings
        )

    def check_range(self) -> str | None:
        if self.incremental_days is None or not self.update_column or self.as_of is None:
            return None
        return format_range(*window_bounds(self.incremental_days, self.as_of))

    def windowed(self, df: DataFrame) -> DataFrame:
        if self.incremental_days is not None and self.update_column and self.as_of is None:
            raise ValueError("an incremental comparison needs the end of its window (as_of)")
        return incremental_filter(df, self.update_column, self.incremental_days, self.as_of)

    def compare_least(self, src: DataFrame, tgt: DataFrame) -> LeastDiff:
        columns = self.roles(src).all
        return compare_least(self.windowed(src), self.windowed(tgt), self.keys, columns, self.abs_tol, self.rel_tol)

    def compare(self, src: DataFrame, tgt: DataFrame) -> DataFrame:
        return compare_rows(
            self.windowed(src),
            self.windowed(tgt),
            self.keys,
            self.roles(src).all,
            self.abs_tol,
            self.rel_tol,
            self.primary_key,
        )

    def labels(self) -> dict[str, Column]:
        names = ("table_id", "src_db_id", "src_db_name", "src_table_name", "tgt_db_name", "tgt_table_name")
        return {n: F.lit(getattr(self, n)).cast("string") for n in names}


def _flag(value: object) -> bool:
    return value.strip().lower() in ("1", "true", "yes") if isinstance(value, str) else bool(value)


def read_database(spark: SparkSession, spec: JdbcTable, keys: Sequence[str], slices: int) -> DataFrame:
    """The table in parallel slices of its key, with lower-case names."""
    if len(keys) > 1:
        return fold_names(scan_by_keys(spark, spec, keys, slices))
    return fold_names(scan_by_key(spark, spec, keys[0], slices))


def known_keys(spark: SparkSession, spec: JdbcTable) -> list[str] | None:
    """The table's primary key, or None."""
    try:
        return primary_keys(spark, spec)
    except LookupError:
        return None


def with_passwords(tasks: DataFrame, key: Column) -> DataFrame:
    """The task table with its stored passwords decrypted by the caller's key."""
    return tasks.withColumns({n: decrypt_column(F.col(n), key) for n in ("src_password", "tgt_password")})


def task_from_config(
    config: Mapping[str, object],
    as_of: datetime,
    keys: Sequence[str] | None = None,
    slices: int = 32,
    output: FileTable | CatalogTable | None = None,
    patch_output: TableSpec | None = None,
) -> CompareTask:
    """The task of one row of a task table, comparing two database tables.

    Column names are compared in lower case. Without ``keys`` the source database names
    its primary key when the task runs, and rows count as unique by it only if the target
    has the same key. Each side is read by ``slices`` tasks, and that many connections are
    open at a time. Stored passwords are decrypted before (``with_passwords``).
    """
    absent = [n for n in REQUIRED_FIELDS if config.get(n) is None]
    if absent:
        raise ValueError(f"task entries missing: {absent}")

    def side(name: str) -> JdbcTable:
        return JdbcTable(
            dialect=str(config[f"{name}_db_type"]).lower(),
            host=str(config[f"{name}_host"]),
            port=int(config[f"{name}_port"]),
            database=str(config[f"{name}_db_name"]),
            table=str(config[f"{name}_table_name"]),
            user=str(config[f"{name}_username"]),
            password=str(config[f"{name}_password"]),
        )

    src, tgt = side("src"), side("tgt")
    update = str(config.get("update_time_str") or "").strip().lower()
    days = config.get("incremental_days")
    limit = config.get("max_repair_records_threshold")
    asked: dict[str, list[str] | None] = {}

    def key_of(spark: SparkSession, name: str, spec: JdbcTable) -> list[str] | None:
        if name not in asked:
            asked[name] = known_keys(spark, spec)
        return asked[name]

    def source_keys(spark: SparkSession) -> list[str]:
        found = list(keys) if keys else key_of(spark, "src", src)
        if not found:
            raise ValueError(f"{src.qualified} has no primary key")
        return found

    def target_keys(spark: SparkSession) -> list[str]:
        return list(keys) if keys else key_of(spark, "tgt", tgt) or source_keys(spark)

    def same_key(spark: SparkSession) -> bool:
        theirs = None if keys else key_of(spark, "tgt", tgt)
        return bool(theirs) and {k.lower() for k in theirs} == {k.lower() for k in source_keys(spark)}

    task_id = config["table_id"] if config.get("table_id") is not None else config.get("id")
    return CompareTask(
        table_id=str(task_id if task_id is not None else ""),
        source=lambda spark: read_database(spark, src, source_keys(spark), slices),
        target=lambda spark: read_database(spark, tgt, target_keys(spark), slices),
        keys=[k.lower() for k in keys] if keys else lambda spark: [k.lower() for k in source_keys(spark)],
        primary_key=False if keys else same_key,
        src_db_id=None if config.get("src_db_id") is None else str(config["src_db_id"]),
        src_db_name=src.database,
        src_table_name=src.table,
        tgt_db_name=tgt.database,
        tgt_table_name=tgt.table,
        update_column=update or None,
        sensitive=",".join(n.lower() for n in split_names(config.get("sensitive_str"))),
        incremental_days=float(1 if days is None else days) if _flag(config.get("incremental")) and update else None,
        as_of=as_of,
        enable_repair=_flag(config.get("enable_repair")),
        time_filter=_flag(config.get("enable_time_filter")),
        time_tolerance=float(config.get("time_tolerance") or 0),
        max_repair_rows=None if limit is None else int(limit),
        include_extra=_flag(config.get("extra_columns", True)),
        include_strings=_flag(config.get("string_columns", False)),
        delete_before=config.get("repair_delete") or None,
        check_after=config.get("repair_check") or None,
        write_mode=str(config.get("repair_write_mode") or "update"),
        output=output,
        patch_output=patch_output,
    )


def task_result(task: CompareTask, summary: DataFrame, roles: ColumnRoles) -> DataFrame:
    """One log row: the task's names, its window and columns, and the counts of its summary."""
    return summary.withColumns(
        task.labels()
        | {
            "compare_status": F.lit("success"),
            "compare_msg": F.lit("compared"),
            "check_range": F.lit(task.check_range()).cast("string"),
            "check_column": F.lit(roles.describe()),
            "compare_report": compare_sentence(),
            "is_delete": F.lit(0),
        }
    )


def total_cost(compare_minutes: Column, repair_minutes: Column) -> Column:
    """Minutes of both phases together, to six decimals."""
    return F.round(F.coalesce(compare_minutes, F.lit(0.0)) + F.coalesce(repair_minutes, F.lit(0.0)), 6)


RESULT_COLUMNS = (
    "table_id",
    "compare_status",
    "compare_msg",
    "src_cnt",
    "tgt_cnt",
    "match_cnt",
    "mismatch_cnt",
    "src_only_cnt",
    "tgt_only_cnt",
    "diff_cnt",
    "matching_rate",
)


def failed_result(spark: SparkSession, task: CompareTask, error: Exception) -> DataFrame:
    """The row of a task that could not be run."""
    counts = {n: F.lit(0).cast("bigint") for n in RESULT_COLUMNS if n.endswith("_cnt")}
    return spark.range(1).select(
        *[
            c.alias(n)
            for n, c in (
                task.labels()
                | {"compare_status": F.lit("fail"), "compare_msg": F.lit(str(error))}
                | counts
                | {"matching_rate": F.lit(0.0)}
                | {"repair_cnt": F.lit(0).cast("bigint"), "repair_status": F.lit("fail"), "repair_msg": F.lit(str(error)), "is_delete": F.lit(0)}
            ).items()
        ]
    )


def compare_many(spark: SparkSession, tasks: Sequence[CompareTask], concurrency: int = 3) -> DataFrame:
    """One result row per task, in the order of the tasks; a few run at a time, each as its own job.

    A task that fails, while it is planned or while it runs, becomes a failed row and does
    not stop the others.
    """
    if not tasks:
        raise ValueError("no tasks")

    def one(task: CompareTask) -> Row:
        try:
            task = task.resolved(spark)
            src, tgt = task.source(spark), task.target(spark)
            seen = compare_counts(spark, task, src, tgt)[0]
            result = task_result(task, counted_summary(spark, seen), task.roles(src))
            return result.select(*RESULT_COLUMNS).first()
        except Exception as error:
            logger.warning("task %s failed: %s", task.table_id, error)
            return failed_result(spark, task, error).select(*RESULT_COLUMNS).first()

    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        rows = list(pool.map(one, tasks))
    values = [F.struct(*[F.lit(row[n]).cast(_result_type(n)).alias(n) for n in RESULT_COLUMNS]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*values)))


def _result_type(name: str) -> str:
    return "bigint" if name.endswith("_cnt") else "double" if name == "matching_rate" else "string"


def counted_summary(spark: SparkSession, seen: Mapping[str, int]) -> DataFrame:
    """The summary of counts already taken."""
    summary = spark.range(1).select(*[F.lit(v).cast("bigint").alias(n) for n, v in seen.items()])
    return summary.withColumn("matching_rate", rate(F.col("match_cnt"), F.col("src_cnt"), F.col("tgt_cnt")))


def compare_counts(
    spark: SparkSession, task: CompareTask, src: DataFrame, tgt: DataFrame, keep: str | None = None
) -> tuple[dict[str, int], DataFrame | None]:
    """The counts of the comparison, and the differing rows, written to ``keep`` if that is given.

    Keys that are not declared may repeat: rows are paired with the fewest differences.

    A declared primary key is checked in the same pass: a key that repeats on one side, and
    that the other side has as well, multiplies rows in the join, and then its counts are not
    those of the sides; a NULL in a key is counted. Such a claim is an error. A repeated key
    that the other side lacks altogether is not noticed (``primary_key_audit`` finds it).
    """
    if not task.primary_key:
        least = task.compare_least(src, tgt)
        diff = stored(least.rows, keep) if keep else None
        seen = (least.rows if diff is None else diff).agg(*count_columns()).first().asDict()
        for name in ("src_cnt", "tgt_cnt", "match_cnt"):
            seen[name] += least.match_cnt
        if diff is not None and (task.abs_tol or task.rel_tol):
            diff = diff.where(F.col(DIFF_TYPE) != MATCH)
        return seen, diff
    sides = [Observation(), Observation()]
    # In the window, if there is one: those are the rows that are joined.
    held = F.count("*").alias("rows"), F.count_if(any_null(task.keys)).alias("nulls")
    src, tgt = (task.windowed(df).observe(seen, *held) for df, seen in zip((src, tgt), sides))
    rows = task.compare(src, tgt)
    counts = Observation()
    observed = rows.observe(counts, *count_columns()).where(F.col(DIFF_TYPE) != MATCH)
    diff = None
    if keep:
        diff = stored(observed, keep)
    else:
        observed.write.format("noop").mode("overwrite").save()
    seen = counts.get
    for side, name in zip(sides, ("src_cnt", "tgt_cnt")):
        found = side.get
        if found["rows"] != seen[name] or found["nulls"]:
            raise ValueError(
                f"{task.keys} is no primary key: {found['rows']} rows, {found['nulls']} with NULL keys, {seen[name]} after the join"
            )
    return seen, diff


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _minutes(start: datetime, end: datetime) -> float:
    return round((end - start).total_seconds() / 60, 6)


def check_output(spark: SparkSession, task: CompareTask) -> None:
    """A repair that could not be written fails before anything is compared."""
    if task.output is None and task.patch_output is None and task.in_place is None:
        raise ValueError("a repair needs an output table")
    if task.output is not None and task.in_place is not None:
        raise ValueError("a repair goes to a new table or in place, not both")
    if task.output is not None and table_exists(spark, task.output):
        raise ValueError(f"the output table exists already: {task.output}")


def run_task(spark: SparkSession, task: CompareTask, ledger: TaskLedger | None = None) -> DataFrame:
    """Compare, decide, repair and verify one pair of tables; returns its log row.

    For a repair the differing rows are written down once, the counts being taken on
    the way, and everything after that starts from those rows. The repaired table goes
    to ``task.output``. Tables written in between are removed at the end.

    With a ``ledger`` each phase is noted when it is over, and one that an earlier start of the
    same run has ended is not repeated: a comparison is read back, a patch, a table in place and
    an output are written once.
    """
    with working_tables(spark, "task"):
        return _run_task(spark, task, ledger)


def _run_task(spark: SparkSession, task: CompareTask, ledger: TaskLedger | None = None) -> DataFrame:
    started = _now()
    task = task.resolved(spark)
    # Taken before the target is opened: a repair then fails if somebody changes it meanwhile.
    base = None if task.in_place is None else current_version(spark, task.in_place)
    src, tgt = task.source(spark), task.target(spark)
    roles = task.roles(src)
    noted = ledger.done(COMPARED) if ledger else None
    if task.enable_repair and noted is None:
        check_output(spark, task)
    if noted is None:
        kept = ledger.table("diff") if ledger else new_path(spark, "diff")
        seen, diff = compare_counts(spark, task, src, tgt, kept if task.enable_repair else None)
        if ledger:
            ledger.end(COMPARED, {"seen": seen, "diff": kept if diff is not None else None, "base": base})
    else:
        # The base is that of the comparison: a target changed since then is refused.
        seen, base = noted["seen"], noted["base"]
        diff = spark.read.parquet(noted["diff"]).where(F.col(DIFF_TYPE) != MATCH) if noted["diff"] else None
    summary = counted_summary(spark, seen)
    compared = _now()

    result = task_result(task, summary, roles).withColumns(
        {
            "compare_time": F.lit(started),
            "compare_start_time": F.lit(started),
            "compare_end_time": F.lit(compared),
            "compare_cost_minute": F.lit(_minutes(started, compared)),
        }
    )
    repair: dict[str, object] = {}
    if task.enable_repair:
        differing = seen["diff_cnt"]
        if task.confirm and differing:
            base = None if task.in_place is None else current_version(spark, task.in_place)
            src, tgt = task.source(spark), task.target(spark)
            sides = task.windowed(src), task.windowed(tgt)
            found = confirm_differences(diff, *sides, task.keys, None, task.primary_key, not task.primary_key)
            diff = materialize(found.where(F.col(STATE) != RESOLVED).drop(STATE), "confirmed")
            differing = diff.count()
        repair = _repair(spark, task, src, tgt, diff, differing, base, ledger)
    ended = _now()
    repair_cost = _minutes(compared, ended) if repair.get("repair_status") not in (None, "skip") else 0.0
    return result.withColumns(
        {
            "repair_status": F.lit(repair.get("repair_status")).cast("string"),
            "repair_msg": F.lit(repair.get("repair_msg", "")),
            "repair_cnt": F.lit(repair.get("repair_cnt", 0)).cast("bigint"),
            "repair_start_time": F.lit(compared if repair else None).cast("timestamp_ntz"),
            "repair_end_time": F.lit(ended if repair else None).cast("timestamp_ntz"),
            "repair_cost_minute": F.lit(repair_cost),
            "compare_total_cost_minute": total_cost(F.col("compare_cost_minute"), F.lit(repair_cost)),
            "create_time": F.lit(ended),
            "update_time": F.lit(ended),
        }
    )


def _repair(
    spark: SparkSession, task: CompareTask, src: DataFrame, tgt: DataFrame, diff: DataFrame, diff_cnt: int, base: int | None, ledger: TaskLedger | None
) -> dict[str, object]:
    counted = spark.range(1).select(F.lit(diff_cnt).cast("bigint").alias("diff_cnt"))
    gate = repair_gate(counted, True, task.max_repair_rows).first()
    if gate["repair_status"] != "run":
        return {"repair_status": gate["repair_status"], "repair_msg": gate["repair_msg"]}
    time_column = task.roles(src).update
    if task.repair_scope == "diff":
        known = tgt
        if task.time_filter and time_column:
            known = within(tgt, covering_ranges(diff.where(F.col(DIFF_TYPE) == SRC_ONLY), task.keys))
        keys = repair_keys(diff, known, task.keys, time_column, task.time_tolerance, task.time_filter)
        wanted = materialize(keys, "repair-keys")
        gate = repair_gate(counted, True, task.max_repair_rows, F.lit(wanted.count())).first()
        if gate["repair_status"] != "run":
            return {"repair_status": gate["repair_status"], "repair_msg": gate["repair_msg"]}
        # A few ranges around the keys reach the scans, of files and databases alike.
        ranges = covering_ranges(wanted, task.keys)
        patch = materialize(repair_rows(within(src, ranges), tgt, wanted, task.keys, task.primary_key), "patch")
    else:
        ranges = None
        window = window_bounds(task.incremental_days, task.as_of) if task.check_range() else None
        patch = materialize(repair_window(src, tgt, task.keys, task.repair_scope, time_column, window), "patch")
        wanted = patch.select(*quoted(task.keys)).distinct()
    if task.patch_output is not None:
        # The run's id tells its rows apart from those of another attempt.
        staged = patch if task.run_id is None else patch.withColumn(RUN_ID, F.lit(task.run_id))
        if isinstance(task.patch_output, VersionedTable):
            append_once(staged, task.patch_output, f"{ledger.mark if ledger else uuid.uuid4().hex}.{STAGED}")
        elif ledger is None or ledger.done(STAGED) is None:
            append_table(staged, task.patch_output)
        if ledger:
            ledger.end(STAGED, {})
    if task.output is None and task.in_place is None:
        written = patch.count()
        return {"repair_status": "success", "repair_cnt": written, "repair_msg": f"patch of {written} rows written"}
    mark = f"{ledger.mark}.{WRITTEN}" if ledger else uuid.uuid4().hex
    if task.in_place is not None:
        if ledger and has_mark(spark, task.in_place, mark):
            where = ""  # published by an earlier start
        else:
            done = repair_files(
                spark, task.in_place, patch, task.keys, task.write_mode, task.primary_key, task.delete_before, base, mark
            )
            where = f", {len(done.rewritten)} of {len(done.rewritten) + done.kept} files rewritten"
        repaired = scan_table(spark, task.in_place)
    else:
        rest = tgt if task.delete_before is None else delete_where(tgt, task.delete_before)
        written = apply_repair(rest, patch, task.keys, task.write_mode, task.primary_key)
        if ledger:
            write_table_at_once(written, task.output, mark)
        else:
            write_table(written, task.output)
        repaired, where = scan_table(spark, task.output), ""
    if ledger:
        ledger.end(WRITTEN, {})
    columns = [c for c in patch.columns if c not in task.keys]
    # Against the source itself, not the patch: a wrong patch must not pass.
    checked = materialize(verify_repair(within(src, ranges), within(repaired, ranges), wanted, task.keys, columns, task.primary_key).select(*quoted(task.keys), DIFF_TYPE), "checked")
    batches = assign_batches(wanted, task.keys, task.batch_size)
    outcome = repair_outcome(batch_outcome(checked, batches, task.keys)).first()
    message = f"repaired in {outcome['batch_count']} batches{where}"
    lost = f"{outcome['failed_batches']} of {outcome['batch_count']} batches differ after the repair"
    broken = 0 if task.check_after is None else repaired.where(f"NOT coalesce({task.check_after}, TRUE)").count()
    if broken:
        return {"repair_status": "fail", "repair_cnt": outcome["repair_cnt"], "repair_msg": f"{broken} rows break the check {task.check_after}"}
    return {
        "repair_status": outcome["repair_status"],
        "repair_cnt": outcome["repair_cnt"],
        "repair_msg": message if outcome["repair_status"] == "success" else lost,
    }


@dataclass(frozen=True)
class RunReport:
    """What a run of tasks came to: how many failed, which could not be logged, and the messages worth an alert."""

    failures: int
    unlogged: tuple[str, ...]
    alerts: tuple[str, ...]


def run_tasks(
    spark: SparkSession,
    tasks: Sequence[CompareTask],
    log: TableSpec,
    concurrency: int = 3,
    threshold: float = 0.0,
    time_limit: float | None = None,
    ledger: str | None = None,
    run_id: str | None = None,
) -> RunReport:
    """Run the tasks, a few at a time, and append one log row each.

    A failing task is logged as such and does not stop the others; neither does a log
    row that cannot be written. ``threshold`` is the share of rows that may differ
    without an alert.

    Each task's jobs run in a scheduler pool of its own, so that under ``spark.scheduler.mode``
    FAIR a large task leaves room for small ones. A task that takes longer than ``time_limit``
    seconds has its jobs cancelled and is logged as failed; the others go on, and the call does
    not wait for what such a task does outside of Spark.

    With a ``ledger``, a folder that all starts see, and a ``run_id``, a second start of the
    same run leaves out the tasks that are logged and goes on with the others after the last
    phase they ended. The log is then best a ``VersionedTable``, to which rows are appended
    exactly once; in another table a row may come twice if a start stops just after writing it.
    """
    if ledger is not None and not run_id:
        raise ValueError("a ledger needs the run's id")
    pending = list(tasks)
    ledgers: dict[int, TaskLedger] = {}
    if ledger is not None:
        for k, task in enumerate(tasks):
            ledgers[k] = TaskLedger(spark, ledger, run_id, task.table_id)
        pending = [task for k, task in enumerate(tasks) if ledgers[k].done(LOGGED) is None]
        ledgers = {id(task): ledgers[k] for k, task in enumerate(tasks)}

    def one(task: CompareTask) -> tuple[CompareTask, DataFrame, bool]:
        try:
            own = ledgers.get(id(task))
            return task, run_task(spark, task, own) if own else run_task(spark, task), False
        except Exception as error:
            logger.warning("task %s failed: %s", task.table_id, error)
            return task, failed_row(spark, task, error), True

    failures, unlogged, alerts = 0, [], []
    for task, row, failed in timed(spark, one, pending, concurrency, time_limit):
        failures += failed
        row = failed_row(spark, task, row) if isinstance(row, Exception) else row
        try:
            for found in (needs_alert_compare(row, threshold), needs_alert_repair(row)):
                alerts += [r["alert"] for r in found.select("alert").collect()]
            # Here in the calling thread: one small append after another, as file tables want it.
            own = ledgers.get(id(task))
            if isinstance(log, VersionedTable):
                # A failure is logged for each start, the end of a task once.
                kind = f"failed-{own.attempt}" if own and failed else LOGGED
                append_once(as_result_log(row), log, f"{own.mark if own else uuid.uuid4().hex}.{kind}")
            else:
                append_result_log(row, log)
            if own and not failed:
                own.end(LOGGED, {})
        except Exception as error:
            logger.warning("log row of task %s is lost: %s", task.table_id, error)
            unlogged.append(task.table_id)
    return RunReport(failures, tuple(unlogged), tuple(alerts))


def failed_row(spark: SparkSession, task: CompareTask, error: Exception) -> DataFrame:
    names = ("compare_time", "compare_start_time", "compare_end_time", "create_time", "update_time")
    return failed_result(spark, task, error).withColumns(dict.fromkeys(names, F.lit(_now())))
