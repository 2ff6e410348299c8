from skewsafe.sinks.writers import (
    align_to_schema,
    append_by_name,
    create_target_tables,
    ensure_namespace,
    insert_by_name,
    read_target,
    replace_with_batch,
    save_clustered_table,
    stage_rows,
    staged_publish,
    verify_count,
    write_batch,
    write_clustered,
    write_day_partitioned,
    write_partitioned,
    write_table,
)

__all__ = [
    "align_to_schema", "append_by_name", "create_target_tables", "ensure_namespace", "insert_by_name",
    "read_target", "replace_with_batch", "save_clustered_table", "stage_rows", "staged_publish", "verify_count", "write_batch",
    "write_clustered", "write_day_partitioned", "write_partitioned", "write_table",
]
