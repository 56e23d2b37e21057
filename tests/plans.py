"""Reading executed plans."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def final_plan(df: DataFrame) -> str:
    """The plan that ran, with the plans of its subqueries; run the query first."""
    text = df._jdf.queryExecution().executedPlan().toString()
    kept, skip_from = [], None
    for line in text.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if skip_from is not None and at >= skip_from:
            continue
        skip_from = None
        if "== Initial Plan ==" in line:
            skip_from = line.index("==")
            continue
        kept.append(line)
    return "\n".join(kept)


def scans(plan: str, column_prefix: str) -> int:
    """How often the plan reads the table whose columns start with the prefix."""
    return len(re.findall(rf"FileScan parquet \[{column_prefix}", plan))
