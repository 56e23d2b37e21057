"""One-pass profiles of a table. Each is a single global aggregate, combined on the map side."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import day_parts, parse_date, strip
from tallybook.functions.numbers import INTEGER, NUMBER
from tallybook.operators.rows import deduplicate


_INTEGER, _NUMBER, _BOOLEAN, _OTHER = 1, 2, 3, 4


def type_evidence(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Per text column: values present, and how many are no integer, number, or boolean.

    Each cell is stripped once and classed once; the counts then compare small codes.
    """
    columns = list(columns if columns is not None else df.columns)
    places = range(len(columns))
    texts = df.select(
        *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)],
        *[strip(F.col(c)).alias(f"t{i}") for i, c in enumerate(columns)],
    )
    kinds = texts.select(*[_kind(F.col(f"v{i}"), F.col(f"t{i}")).alias(f"k{i}") for i in places])
    found = kinds.agg(*[_evidence(columns[i], F.col(f"k{i}")).alias(f"c{i}") for i in places])
    rows = found.select(F.inline(F.array(*[f"c{i}" for i in places])))
    return rows.withColumn("inferred_type", _inferred_type())


def _kind(value: Column, text: Column) -> Column:
    """Code of the narrowest class a cell is in; null for a missing one."""
    return (
        F.when(value.isNull(), F.lit(None))
        .when(text.rlike(INTEGER) & text.try_cast("bigint").isNotNull(), F.lit(_INTEGER))
        .when(text.rlike(NUMBER), F.lit(_NUMBER))
        .when(F.lower(value).isin("true", "false"), F.lit(_BOOLEAN))
        .otherwise(F.lit(_OTHER))
    )


def _evidence(column: str, kind: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column_name"),
        F.count(kind).alias("non_null"),
        F.count_if(kind != _INTEGER).alias("not_integer"),
        F.count_if(kind > _NUMBER).alias("not_number"),
        F.count_if(kind.isNull() | (kind != _BOOLEAN)).alias("not_boolean"),
    )


def _inferred_type() -> Column:
    """The narrowest type all values fit. Empty columns are numbers; booleans must be complete."""
    return (
        F.when(F.col("non_null") == 0, "double")
        .when(F.col("not_boolean") == 0, "boolean")
        .when(F.col("not_integer") == 0, "bigint")
        .when(F.col("not_number") == 0, "double")
        .otherwise("string")
    )


def position_evidence(df: DataFrame, cells: list[Column]) -> tuple[DataFrame, list[Column]]:
    """``df`` with a code per cell, and one aggregate ``e0``, ``e1``, … per position to take over it.

    Each counts cells by their narrowest class, and holds the largest first and second part of dates whose
    parts are all numbers. The aggregates of parts of a table merge (``merged_evidence``).
    """
    kept, n = df.columns, range(len(cells))
    texts = df.select(*kept, *[c.alias(f"_v{i}") for i, c in enumerate(cells)], *[strip(c).alias(f"_t{i}") for i, c in enumerate(cells)])
    kinds = texts.select(*kept, *[F.col(f"_t{i}") for i in n], *[_kind(F.col(f"_v{i}"), F.col(f"_t{i}")).alias(f"_k{i}") for i in n])
    parts = [F.when(F.col(f"_k{i}") == _OTHER, day_parts(F.col(f"_t{i}"))).alias(f"_d{i}") for i in n]
    coded = kinds.select(*kept, *[f"_k{i}" for i in n], *parts)

    def found(i: int) -> Column:
        kind, date = F.col(f"_k{i}"), F.col(f"_d{i}")
        return F.struct(
            F.count_if(kind.isNull()).alias("empty"),
            F.count_if(kind == _INTEGER).alias("integers"),
            F.count_if(kind == _NUMBER).alias("numbers"),
            F.count_if(kind == _BOOLEAN).alias("booleans"),
            F.count_if(kind == _OTHER).alias("others"),
            F.max(date["first"]).alias("first_part"),
            F.max(date["second"]).alias("second_part"),
        ).alias(f"e{i}")

    return coded, [found(i) for i in n]


def merged_evidence(width: int) -> list[Column]:
    """The evidence of several parts of a table as one."""
    sums, most = ("empty", "integers", "numbers", "booleans", "others"), ("first_part", "second_part")
    return [
        F.struct(*[F.sum(f"e{i}.{x}").alias(x) for x in sums], *[F.max(f"e{i}.{x}").alias(x) for x in most]).alias(f"e{i}")
        for i in range(width)
    ]


def day_first_columns(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    """Text columns whose dates have the day first, as the column proves: one scan, two numbers a column.

    A first part above 12 is no month. Where a second part is above 12 as well, no order reads them all, and
    where neither is, nothing is proven: then the month stands first.
    """
    given = columns if columns is not None else df.columns
    columns = [c for c in given if isinstance(df.schema[c].dataType, T.StringType)]
    if not columns:
        return []
    coded, found = position_evidence(df.select(*columns), [F.col(c) for c in columns])
    row = coded.agg(*found).first()
    parts = [(c, row[f"e{i}"]["first_part"] or 0, row[f"e{i}"]["second_part"] or 0) for i, c in enumerate(columns)]
    return [c for c, first, second in parts if first > 12 >= second]


def infer_types(df: DataFrame) -> dict[str, str]:
    """Inferred type of every text column: one scan, one small row per column on the driver."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return {}
    return {r.column_name: r.inferred_type for r in type_evidence(df, texts).collect()}


def null_profile(df: DataFrame) -> DataFrame:
    """Number of nulls per column, for the columns that have any."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], counts.columns, "column_name", "null_count")
    return long.where(F.col("null_count") > 0)


def count_removed(df: DataFrame) -> DataFrame:
    """Rows in, copies and empty rows removed, rows out."""
    counted = deduplicate(df, copies="_copies", filled="_filled")
    return counted.agg(*removal_counts("_copies", F.col("_filled") == 0))


def removal_counts(copies: str, is_empty: Column) -> list[Column]:
    """Aggregates over distinct rows and the number of copies each had."""
    raw, empty = F.coalesce(F.sum(copies), F.lit(0)), F.count_if(is_empty)
    return [
        raw.alias("raw_rows"),
        (F.count("*") - empty).alias("clean_rows"),
        (raw - F.count("*")).alias("duplicates_removed"),
        empty.alias("empty_rows_removed"),
    ]


def is_unparsed(name: str, day_first: bool = False) -> Column:
    """True where a text is present but is no date. Cleaning makes it null."""
    return F.col(name).isNotNull() & parse_date(strip(F.col(name)), day_first=day_first).isNull()


def unparsed_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Number of unreadable texts per date column."""
    columns = list(columns)
    bad = df.agg(*[F.count_if(is_unparsed(c)).alias(c) for c in columns])
    return bad.unpivot([], columns, "column_name", "unparsed")
