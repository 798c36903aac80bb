from clickmart.operators.materialize import materialize
from clickmart.operators.ordered import lead_by_key, number_rows
from clickmart.operators.quality import (
    check_allowed,
    check_non_empty,
    check_not_null,
    check_reference,
    check_schema,
    check_unique,
    observed,
    partition_files,
    row_counts,
    sample_rows,
)
from clickmart.operators.ranking import best_value, collect_ranked, top_n, top_n_tree
from clickmart.operators.upsert import insert_ignore, upsert

__all__ = [
    "best_value",
    "check_allowed",
    "check_non_empty",
    "check_not_null",
    "check_reference",
    "check_schema",
    "check_unique",
    "collect_ranked",
    "insert_ignore",
    "lead_by_key",
    "materialize",
    "number_rows",
    "observed",
    "partition_files",
    "row_counts",
    "sample_rows",
    "top_n",
    "top_n_tree",
    "upsert",
]
