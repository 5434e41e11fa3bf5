"""The merge and the table operators."""

from monthtide.operators.bloom import bloom_filters, has_new_by_filter, new_keys_by_filter, possible_keys
from monthtide.operators.merge import (
    first_seen,
    has_new,
    heavy_keys,
    merge_insert,
    new_keys,
    rows_of_keys,
    unseen,
    unseen_among_few,
    unseen_by_probe,
    unseen_keys,
)
from monthtide.operators.publish import discard_pending, drop_partitions, pending_rows, publish, write_pending
from monthtide.operators.tables import (
    add_column,
    append_rows,
    clear_partition,
    ensure_database,
    ensure_main,
    ensure_staging,
    ensure_table,
    filled_partitions,
    load_partitions,
    partitions,
    replace_partition,
)

__all__ = [
    "add_column",
    "append_rows",
    "bloom_filters",
    "clear_partition",
    "discard_pending",
    "drop_partitions",
    "ensure_database",
    "ensure_main",
    "ensure_staging",
    "ensure_table",
    "filled_partitions",
    "first_seen",
    "has_new",
    "has_new_by_filter",
    "heavy_keys",
    "load_partitions",
    "merge_insert",
    "new_keys",
    "new_keys_by_filter",
    "partitions",
    "pending_rows",
    "possible_keys",
    "publish",
    "replace_partition",
    "rows_of_keys",
    "unseen",
    "unseen_among_few",
    "unseen_by_probe",
    "unseen_keys",
    "write_pending",
]
