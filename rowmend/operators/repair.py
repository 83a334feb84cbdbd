"""Which differences to repair, and the repaired table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmend.functions.columns import common_columns, ordered_unique
from rowmend.functions.literals import column_name, sql_literal
from rowmend.functions.times import as_time, in_window, not_older_by
from rowmend.operators.compare import (
    DIFF_TYPE,
    MATCH,
    MISMATCH,
    SRC,
    SRC_ONLY,
    TGT,
    compare_rows,
    field,
    lookup_target,
    rows_of_keys,
)
from rowmend.operators.keys import HOT_ROWS, by_key, hot_keys_and_rows, join_keys, number_occurrences, split_hot
from rowmend.operators.ranks import number_in_hot_key, number_in_key, quoted
from rowmend.sources.jdbc import JdbcTable
from rowmend.sources.storage import materialize
from rowmend.sources.tables import TableSpec, scan_slices, scan_table

MODES = ("insert", "update", "replace")
MOST_PREDICATES = 1000  # batches of keys that are asked for by conditions
MOST_IN_SCAN = 10  # of those that one scan of files tests each row against


def time_allows(
    src_time: Column, src_type: T.DataType, tgt_time: Column, tgt_type: T.DataType, seconds: float, if_unreadable: bool
) -> Column:
    """Whether the source's time permits overwriting the target's row.

    A missing time permits it. Text that is no time gives ``if_unreadable``.
    Otherwise the source must not be older than the target by the tolerance:
    ``source - target >= seconds``.
    """
    a, b = as_time(src_time, src_type), as_time(tgt_time, tgt_type)
    missing = src_time.isNull() | tgt_time.isNull()
    for raw, dtype in ((src_time, src_type), (tgt_time, tgt_type)):
        if isinstance(dtype, T.StringType):
            missing = missing | (raw == "")
    return (
        F.when(F.coalesce(missing, F.lit(True)), F.lit(True))
        .when(a.isNull() | b.isNull(), F.lit(if_unreadable))
        .otherwise(not_older_by(a, b, seconds))
    )


def _type_of(rows: DataFrame, side: str, name: str) -> T.DataType:
    return rows.schema[side].dataType[name].dataType


def mismatch_to_repair(
    rows: DataFrame, keys: Sequence[str], time_column: str | None = None, tolerance: float = 0.0, time_filter: bool = True
) -> DataFrame:
    """Keys of mismatching rows that may be overwritten with the source's row."""
    differing = rows.where(F.col(DIFF_TYPE) == MISMATCH)
    if time_filter and time_column:
        differing = differing.where(
            time_allows(
                field(SRC, time_column),
                _type_of(rows, SRC, time_column),
                field(TGT, time_column),
                _type_of(rows, TGT, time_column),
                tolerance,
                if_unreadable=True,
            )
        )
    return differing.select(*quoted(keys))


def src_only_to_repair(
    rows: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    time_column: str | None = None,
    tolerance: float = 0.0,
    time_filter: bool = True,
) -> DataFrame:
    """Keys of source-only rows that may be written to the target.

    A comparison restricted in time can miss a target row lying outside the window.
    So the keys are looked up in ``tgt``, the whole target: absent ones are written,
    present ones only if their time allows it. Of several target rows of a key the
    latest counts.
    """
    absent = rows.where(F.col(DIFF_TYPE) == SRC_ONLY)
    if not (time_filter and time_column):
        return absent.select(*quoted(keys))
    src_type = _type_of(rows, SRC, time_column)
    tgt_type = tgt.schema[time_column].dataType
    wanted = absent.select(*quoted(keys), field(SRC, time_column).alias("_src_time"))
    found = (
        lookup_target(wanted.select(*quoted(keys)).distinct(), tgt, keys, [time_column], null_safe=True)
        .groupBy(*quoted(keys))
        .agg(
            F.max_by(F.col(f"`{time_column}`"), as_time(F.col(f"`{time_column}`"), tgt_type)).alias("_latest"),
            F.min(F.col(f"`{time_column}`")).alias("_any"),
            F.max(F.lit(True)).alias("_found"),
        )
        # max_by skips rows without a readable time; `_any` keeps the text of such a key.
        .select(*quoted(keys), F.coalesce("_latest", "_any").alias("_tgt_time"), "_found")
    )
    allowed = time_allows(F.col("_src_time"), src_type, F.col("_tgt_time"), tgt_type, tolerance, if_unreadable=False)
    return join_keys(wanted, found, keys).where(F.col("_found").isNull() | allowed).select(*quoted(keys))


def repair_keys(
    rows: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    time_column: str | None = None,
    tolerance: float = 0.0,
    time_filter: bool = True,
) -> DataFrame:
    """Keys to repair, each once. Target-only rows are differences but never repaired."""
    return (
        mismatch_to_repair(rows, keys, time_column, tolerance, time_filter)
        .unionByName(src_only_to_repair(rows, tgt, keys, time_column, tolerance, time_filter))
        .distinct()
    )


def repair_gate(
    summary: DataFrame, enabled: bool = True, max_rows: int | None = None, repairable: Column | None = None
) -> DataFrame:
    """The summary with ``repair_status`` (skip, fail or run) and ``repair_msg``.

    ``max_rows`` refuses larger repairs; without it there is no limit. ``repairable`` is the
    number of keys left after the time filter, if known.
    """
    diff = F.col("diff_cnt")
    over = F.lit(False) if max_rows is None else diff > max_rows
    none_left = (repairable == 0) if repairable is not None else F.lit(False)

    def choose(run, off, same, many, none):
        return (
            F.when(~F.lit(enabled), off).when(diff == 0, same).when(over, many).when(none_left, none).otherwise(run)
        )

    fail, skip = F.lit("fail"), F.lit("skip")
    too_many = F.format_string(f"%d different rows exceed the repair limit of {max_rows}", diff)
    return summary.withColumn("repair_status", choose(F.lit("run"), skip, skip, fail, skip)).withColumn(
        "repair_msg",
        choose(
            F.lit(""),
            F.lit("repair is switched off"),
            F.lit("no difference, nothing to repair"),
            too_many,
            F.lit("rows differ, but the source is not newer"),
        ),
    )


def repair_predicates(batches: DataFrame, keys: Sequence[str], dialect: str | None = None) -> DataFrame:
    """``(batch, key_cnt, predicate)``: for each batch the SQL condition that selects exactly its keys.

    A list is no longer than the batch size. Names and texts are written for the database
    ``dialect``, or for Spark; names that need no quotes there get none.
    """
    types = {f.name: f.dataType for f in batches.schema.fields}
    names = {k: column_name(k, dialect) for k in keys}

    def text(name: str) -> Column:
        return sql_literal(F.col(quoted([name])[0]), types[name], dialect)

    order = F.struct(*quoted(keys))
    if len(keys) == 1:
        key, value = names[keys[0]], F.col(quoted(keys)[0])
        has_null = F.max(value.isNull())
        item = F.when(value.isNotNull(), F.struct(order.alias("key"), text(keys[0]).alias("text")))
        listed = F.concat(F.lit(f"{key} IN ("), F.array_join(F.col("texts"), ", "), F.lit(")"))
        predicate = (
            F.when(~F.col("has_null"), listed)
            .when(F.size("texts") == 0, F.lit(f"{key} IS NULL"))
            .otherwise(F.concat(listed, F.lit(f" OR {key} IS NULL")))
        )
    else:
        has_null = F.lit(False)
        parts = [
            F.when(F.col(q).isNull(), F.lit(f"{names[k]} IS NULL")).otherwise(F.concat(F.lit(f"{names[k]} = "), text(k)))
            for k, q in zip(keys, quoted(keys))
        ]
        item = F.struct(order.alias("key"), F.concat(F.lit("("), F.concat_ws(" AND ", *parts), F.lit(")")).alias("text"))
        predicate = F.array_join(F.col("texts"), " OR ")
    grouped = batches.groupBy("batch").agg(
        F.count("*").alias("key_cnt"),
        F.array_sort(F.collect_list(item))["text"].alias("texts"),
        has_null.alias("has_null"),
    )
    return grouped.select("batch", "key_cnt", predicate.alias("predicate"))


def repair_rows(src: DataFrame, tgt: DataFrame, wanted: DataFrame, keys: Sequence[str], primary_key: bool = False) -> DataFrame:
    """The patch: all source rows of the wanted keys, NULL keys included, in the columns both tables have."""
    return rows_of_keys(src.select(*quoted(common_columns(src, tgt, keys))), wanted, keys, null_safe=not primary_key)


def lookup_by_predicates(
    spark: SparkSession,
    spec: TableSpec,
    batches: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    most: int = MOST_PREDICATES,
) -> DataFrame:
    """The table's rows of the numbered keys, each batch asked for by a condition of its own.

    A database then reads a handful of keys instead of the whole table, one batch per
    task. Conditions pass through the driver, so beyond ``most`` batches the table is
    read and joined instead. Files have no index to answer a condition: one scan tests each
    row against all of them, rows times batches, so they are joined beyond MOST_IN_SCAN batches.
    """
    dialect = spec.dialect if isinstance(spec, JdbcTable) else None
    most = most if isinstance(spec, JdbcTable) else min(most, MOST_IN_SCAN)
    found = repair_predicates(batches, keys, dialect).select("batch", "predicate").orderBy("batch").limit(most + 1).collect()
    if len(found) > most:
        read = scan_table(spark, spec, None if columns is None else [*columns, *keys])
        rows = rows_of_keys(read, materialize(batches.select(*quoted(keys)), "wanted"), keys, null_safe=True)
        return rows if columns is None else rows.select(*quoted(ordered_unique(columns)))
    return scan_slices(spark, spec, [r["predicate"] for r in found] or ["1 = 0"], columns)


def repair_window(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    scope: str,
    time_column: str | None = None,
    window: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """The patch without a comparison: the source's rows of a time window, or all of them."""
    columns = common_columns(src, tgt, keys)
    if scope == "full":
        return src.select(*quoted(columns))
    if scope != "window" or not time_column or not window:
        raise ValueError("scope is 'full', or 'window' with a time column and its bounds")
    return src.where(in_window(time_column, src.schema[time_column].dataType, *window)).select(*quoted(columns))


def apply_repair(
    tgt: DataFrame, patch: DataFrame, keys: Sequence[str], mode: str = "update", primary_key: bool = False
) -> DataFrame:
    """The target after writing the patch. No row of the patch is lost, and target-only rows stay.

    ``insert`` adds rows of new keys. ``update`` also overwrites the patch's columns in
    rows of known keys. ``replace`` swaps all rows of a key for those of the patch, so columns
    that only the target has become NULL. Another mode counts as update.

    Keys may repeat or be NULL, unless ``primary_key`` states that they do not on either side.
    Rows that agree in all columns of the patch belong together. Of what is left of a key,
    the k-th row of the patch, in value order, is written over the k-th row of the target;
    ``insert`` leaves those, and in both modes further rows of the patch are added.
    """
    mode = (mode or "").lower()
    mode = mode if mode in MODES else "update"
    if mode == "insert":
        return tgt.unionByName(inserted_rows(tgt, patch, keys, primary_key))
    patch, shared, as_target = _as_target(tgt, patch)
    if mode == "replace" or (primary_key and mode == "update" and len(shared) == len(tgt.columns)):
        # With all columns in the patch an update of unique keys is the same: the target is read once.
        wanted = patch.select(*quoted(keys)).distinct()
        return join_keys(tgt, wanted, keys, "left_anti", not primary_key).unionByName(patch.select(*as_target))
    if not primary_key:
        added, equal, written = _written_by_occurrence(tgt, patch, keys, shared, as_target)
        rest = join_keys(tgt, patch.select(*quoted(keys)).distinct(), keys, "left_anti")
        return rest.unionByName(equal).unionByName(written).unionByName(added)
    added = join_keys(patch, _known_keys(tgt, patch, keys), keys, "left_anti", False).select(*as_target)
    return _overwritten(tgt, patch, keys, shared, False).unionByName(added)


def _as_target(tgt: DataFrame, patch: DataFrame) -> tuple[DataFrame, list[str], list[Column]]:
    """The patch in the target's types, the columns both have, and what makes a row of the target of a row of the patch."""
    types = {f.name: f.dataType for f in tgt.schema.fields}
    shared = [c for c in tgt.columns if c in set(patch.columns)]
    patch = patch.select(*[F.col(q).cast(types[c]).alias(c) for c, q in zip(shared, quoted(shared))])
    as_target = [
        F.col(q) if c in shared else F.lit(None).cast(types[c]).alias(c) for c, q in zip(tgt.columns, quoted(tgt.columns))
    ]
    return patch, shared, as_target


def inserted_rows(tgt: DataFrame, patch: DataFrame, keys: Sequence[str], primary_key: bool = False) -> DataFrame:
    """The rows that ``insert`` adds to the target. Only target rows of the patch's keys matter."""
    patch, shared, as_target = _as_target(tgt, patch)
    if primary_key:
        return join_keys(patch, _known_keys(tgt, patch, keys), keys, "left_anti", False).select(*as_target)
    return _written_by_occurrence(tgt, patch, keys, shared, as_target)[0]


def _known_keys(tgt: DataFrame, patch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the patch that the target has, each once: never more rows than the patch."""
    return join_keys(tgt.select(*quoted(keys)), patch.select(*quoted(keys)), keys, "left_semi", False).distinct()


def _overwritten(rows: DataFrame, patch: DataFrame, keys: Sequence[str], shared: Sequence[str], null_safe: bool) -> DataFrame:
    """The rows with the patch's values where it has one of their key."""
    new = patch.select(*quoted(keys), F.struct(*quoted(shared)).alias("_new"))
    joined = join_keys(rows, new, keys, "left", null_safe)
    return joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(q)).alias(c) if c in shared and c not in keys else F.col(q)
            for c, q in zip(rows.columns, quoted(rows.columns))
        ]
    )


def _marked_equals(rows: DataFrame, others: DataFrame, shared: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The rows of both, ``_mine`` telling them apart, with ``_equal``: whether the other side has an equal row, each counting once.

    Both sides go through one shuffle, by a hash of their shared columns: Spark shuffles anew for fractions, in which it
    takes 0.0 and -0.0 for one, as their hash does. A column that only ``rows`` has decides which of several equal rows is
    left over.
    """
    sides = [rows.withColumn("_mine", F.lit(True)), others.select(*quoted(shared)).withColumn("_mine", F.lit(False))]
    stacked = sides[0].unionByName(sides[1], allowMissingColumns=True)
    hot, row_cnt = hot_keys_and_rows(stacked, shared, hot_rows)
    own = [c for c in rows.columns if c not in shared]
    usual = stacked if hot is None else split_hot(stacked, hot, shared)[0]
    # Texts that are equal by a collation have hashes of their own.
    hashed = [q for f, q in zip(rows.select(*quoted(shared)).schema, quoted(shared)) if "collate" not in f.dataType.simpleString()]
    usual = by_key(usual.withColumn("_hash", F.xxhash64(*hashed) if hashed else F.lit(0)), ["_hash"], row_cnt)
    numbered = number_in_key(usual, ["_hash", *shared, "_mine"], own or shared, "_copy")
    same = Window.partitionBy("_hash", *quoted(shared))
    other = F.when(F.col("_mine"), F.count_if(~F.col("_mine")).over(same)).otherwise(F.count_if(F.col("_mine")).over(same))
    marked = numbered.withColumn("_other", other).drop("_hash")
    if hot is not None:
        # Copies of a hot row are spread over tasks.
        large = split_hot(stacked, hot, shared)[1]
        counts = large.groupBy(*quoted(shared), (~F.col("_mine")).alias("_mine")).agg(F.count("*").alias("_other"))
        spread = number_in_hot_key(large, [*shared, "_mine"], own, "_copy")
        marked = marked.unionByName(join_keys(spread, counts, [*shared, "_mine"]))
    return marked.select(*quoted(rows.columns), "_mine", (F.col("_copy") <= F.coalesce("_other", F.lit(0))).alias("_equal"))


def _written_by_occurrence(
    tgt: DataFrame, patch: DataFrame, keys: Sequence[str], shared: Sequence[str], as_target: Sequence[Column]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows added, rows that stay and rows overwritten, where keys may repeat. Only the target's rows of the patch's keys are numbered."""
    wanted = patch.select(*quoted(keys)).distinct()
    touched = join_keys(tgt, wanted, keys, "left_semi")
    marked = materialize(_marked_equals(materialize(touched, "touched"), materialize(patch, "patch"), shared), "marked")
    equal = marked.where("_mine AND _equal").select(*quoted(tgt.columns))
    new_rows = marked.where("NOT _mine AND NOT _equal").select(*quoted(shared))
    place = [*keys, "_nr"]
    new_rows = materialize(number_occurrences(new_rows, keys, name="_nr"), "new-rows")
    order = [*shared, *[c for c in tgt.columns if c not in shared]]
    open_rows = marked.where("_mine AND NOT _equal").select(*quoted(order))
    open_rows = materialize(number_occurrences(open_rows, keys, name="_nr"), "open-rows")
    added = join_keys(new_rows, open_rows.select(*quoted(place)), place, "left_anti").select(*as_target)
    written = _overwritten(open_rows, new_rows, place, shared, True)
    return added, equal, written.select(*quoted(tgt.columns))


def verify_repair(
    src: DataFrame,
    repaired: DataFrame,
    wanted: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    primary_key: bool = False,
) -> DataFrame:
    """``compare_rows`` of source and repaired target over the repaired keys, NULL keys included."""
    return compare_rows(
        rows_of_keys(src, wanted, keys, not primary_key),
        rows_of_keys(repaired, wanted, keys, not primary_key),
        keys,
        columns,
        primary_key=primary_key,
    )


def batch_outcome(checked: DataFrame, batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(batch, key_cnt, repaired_cnt, failed)`` from verified rows and batch numbers."""
    state = checked.groupBy(*quoted(keys)).agg(F.min(F.col(DIFF_TYPE) == MATCH).alias("_good"))
    return (
        join_keys(batches, state, keys)
        .groupBy("batch")
        .agg(F.count("*").alias("key_cnt"), F.count_if(F.coalesce("_good", F.lit(False))).alias("repaired_cnt"))
        .withColumn("failed", F.col("repaired_cnt") < F.col("key_cnt"))
    )


def repair_outcome(outcome: DataFrame) -> DataFrame:
    """``(batch_count, repair_cnt, failed_batches, repair_status)`` over all batches."""
    totals = outcome.agg(
        F.count("*").alias("batch_count"),
        F.coalesce(F.sum("repaired_cnt"), F.lit(0)).alias("repair_cnt"),
        F.count_if("failed").alias("failed_batches"),
    )
    status = (
        F.when(F.col("batch_count") == 0, "skip")
        .when(F.col("failed_batches") == 0, "success")
        .when(F.col("failed_batches") < F.col("batch_count"), "partial_fail")
        .otherwise("fail")
    )
    return totals.withColumn("repair_status", status)
