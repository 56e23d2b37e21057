"""Column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def standard_name(name: str) -> str:
    """``" Ship-State X "`` gives ``shipstate_x``: lower case, spaces to ``_``, symbols dropped."""
    joined = re.sub(r"\s+", "_", name.strip().lower())
    return re.sub(r"\W", "", joined)


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its standard name; a name already taken gets ``_2``, ``_3``, …"""
    names: list[str] = []
    for column in df.columns:
        base = name = standard_name(column)
        number = 2
        while name in names:
            name, number = f"{base}_{number}", number + 1
        names.append(name)
    return df.toDF(*names)
