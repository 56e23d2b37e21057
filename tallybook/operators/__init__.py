"""Table operators: each takes a DataFrame and returns one, lazily."""

from tallybook.operators.columns import standardize_columns
from tallybook.operators.profile import (
    count_removed,
    day_first_columns,
    infer_types,
    null_profile,
    type_evidence,
    unparsed_dates,
)
from tallybook.operators.rows import deduplicate, deduplicate_by_digest, deduplicate_known, drop_empty_rows, row_hash
from tallybook.operators.share import top_k, with_running_share, with_share, with_totals
from tallybook.operators.values import (
    apply_schema,
    clean_values,
    column_rules,
    date_columns,
    detect_and_cast_dates,
    fill_nulls_numeric,
    fill_nulls_text,
    stringify_objects,
    unfit_counts,
    unfit_measures,
)

__all__ = [
    "apply_schema",
    "clean_values",
    "column_rules",
    "count_removed",
    "date_columns",
    "day_first_columns",
    "deduplicate",
    "deduplicate_by_digest",
    "deduplicate_known",
    "detect_and_cast_dates",
    "drop_empty_rows",
    "fill_nulls_numeric",
    "fill_nulls_text",
    "infer_types",
    "null_profile",
    "row_hash",
    "standardize_columns",
    "stringify_objects",
    "top_k",
    "type_evidence",
    "unfit_counts",
    "unfit_measures",
    "unparsed_dates",
    "with_running_share",
    "with_share",
    "with_totals",
]
