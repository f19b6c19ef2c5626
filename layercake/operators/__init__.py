from layercake.operators.dedup import distinct_keys, keep_first, keep_least
from layercake.operators.lookup import label_lookup, weighted_labels
from layercake.operators.upsert import (
    CHANGE,
    check_columns,
    insert_missing,
    merge_into,
    missing,
    update_where,
    upsert_non_null,
)

__all__ = [
    "CHANGE",
    "check_columns",
    "distinct_keys",
    "insert_missing",
    "keep_first",
    "keep_least",
    "label_lookup",
    "merge_into",
    "missing",
    "update_where",
    "upsert_non_null",
    "weighted_labels",
]
