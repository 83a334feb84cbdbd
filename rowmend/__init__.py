"""Compare two tables by key and repair the one that has drifted, on Spark."""

from rowmend.functions.columns import ColumnRoles, common_columns, compare_columns, drop_sensitive, fold_names
from rowmend.functions.crypto import decrypt_column, encrypt_column
from rowmend.functions.times import with_range_bounds
from rowmend.functions.types import unified_type, unify_types
from rowmend.operators.compare import (
    LeastDiff,
    compare_least,
    compare_rows,
    key_only_compare,
    lookup_target,
    mismatch_keys,
    mismatch_pairs,
    rows_of_keys,
    src_only_rows,
    tgt_only_keys,
)
from rowmend.operators.confirm import confirm_differences
from rowmend.operators.digests import DigestDiff, digest_compare, part_digests
from rowmend.operators.filters import (
    delete_where,
    incremental_filter,
    needs_alert_compare,
    needs_alert_repair,
    range_filter,
)
from rowmend.operators.keys import hot_keys, key_audit, number_occurrences, primary_key_audit
from rowmend.operators.lookup import covering_ranges, lookup_by_ranges, within
from rowmend.operators.ranks import assign_batches, global_rank
from rowmend.operators.repair import (
    apply_repair,
    batch_outcome,
    inserted_rows,
    lookup_by_predicates,
    mismatch_to_repair,
    repair_gate,
    repair_keys,
    repair_outcome,
    repair_predicates,
    repair_rows,
    repair_window,
    src_only_to_repair,
    verify_repair,
)
from rowmend.operators.slices import count_slices, equal_cuts, scan_by_keys, slice_conditions
from rowmend.operators.summary import (
    column_stats,
    compare_report,
    compare_summary,
    diff_summary,
    matching_rate,
    side_counts,
    top_diffs,
)
from rowmend.operators.touched import FileRepair, files_with_keys, repair_files
from rowmend.plans.ledger import Overtaken, TaskLedger, append_once
from rowmend.plans.tasks import (
    CompareTask,
    active_tasks,
    compare_many,
    read_tasks,
    run_task,
    run_tasks,
    task_from_config,
    task_result,
    validate_tasks,
)
from rowmend.sources.dialects import Dialect, register_dialect
from rowmend.sources.jdbc import JdbcTable, primary_keys, upsert_query
from rowmend.sources.sinks import RESULT_LOG, append_result_log, as_result_log, merge_into, write_table
from rowmend.sources.storage import materialize, new_path
from rowmend.sources.tables import (
    CatalogTable,
    FileTable,
    SourceTable,
    first_rows,
    row_count,
    scan_partitioned,
    scan_slices,
    scan_table,
    schema_diff,
    slice_counts,
    table_metadata,
)
from rowmend.sources.versions import (
    ChangedMeanwhile,
    VersionedTable,
    current_version,
    open_version,
    publish,
    remove_unreferenced,
    table_files,
    versions,
    write_files,
)

__all__ = [name for name in dir() if not name.startswith("_")]
