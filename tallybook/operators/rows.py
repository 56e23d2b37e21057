"""Row operators: full-row copies and empty rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def deduplicate(
    df: DataFrame,
    ignore: Iterable[str] = (),
    copies: str | None = None,
    filled: str | None = None,
) -> DataFrame:
    """Remove full-row copies; nulls are equal to each other.

    ``ignore`` names columns, such as a row number, that do not make rows different. Of such rows
    the one with the least ignored values stays. ``copies`` adds a column with the number of rows
    that were one, ``filled`` one with how many of these hold any value. Copies merge on the map
    side before the shuffle, so one row repeated in a third of the table sends one row per task.
    """
    ignore = set(ignore)
    ignored = [c for c in df.columns if c in ignore]
    counts = {}
    if copies:
        counts[copies] = F.count("*")
    if filled:
        counts[filled] = F.count_if(~all_null(df.columns))
    if not ignored and not counts:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c not in ignored]
    kept = [F.min(F.struct(*ignored)).alias("_least")] if ignored else []
    rows = df.groupBy(*keys).agg(*kept, *[count.alias(name) for name, count in counts.items()])
    if ignored:
        rows = rows.select("*", "_least.*")
    return rows.select(*df.columns, *counts)


def row_hash(df: DataFrame, ignore: Iterable[str] = ()) -> Column:
    """A number that rows have in common if they are copies, and others by chance."""
    ignore = set(ignore)
    return F.xxhash64(*(_unsigned(f) for f in df.schema.fields if f.name not in ignore))


def _unsigned(field: T.StructField) -> Column:
    """A column whose zeros have no sign, as in groups: zeros of either sign are equal but have other bits."""
    column = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column
    return (column + F.lit(0.0).cast(field.dataType)).alias(field.name)


def deduplicate_known(
    df: DataFrame,
    repeated: DataFrame,
    ignore: Iterable[str] = (),
    copies: str | None = None,
    filled: str | None = None,
) -> DataFrame:
    """``deduplicate`` where it is known which values of ``row_hash`` more than one row has.

    ``repeated`` has these in its only column and is broadcast. Rows with another hash have no copy and stay
    where they are; only the others are shuffled, and compared by all their columns.
    """
    ignore = set(ignore)
    name = repeated.columns[0]
    while name in df.columns:
        name += "_"
    known, hashed = F.broadcast(repeated.toDF(name)), df.withColumn(name, row_hash(df, ignore))
    counts = {}
    if copies:
        counts[copies] = F.lit(1).cast("bigint")
    if filled:
        counts[filled] = (~all_null(df.columns)).cast("bigint")
    kept = [F.col(f.name) if f.name in ignore else _unsigned(f) for f in df.schema.fields]
    alone = hashed.join(known, name, "left_anti").select(*kept, *[count.alias(c) for c, count in counts.items()])
    several = hashed.join(known, name, "left_semi").select(*df.columns)
    return alone.unionByName(deduplicate(several, ignore, copies, filled))


def deduplicate_by_digest(df: DataFrame) -> DataFrame:
    """Remove full-row copies of wide rows: digests meet first, rows only where a digest repeats.

    Every row sends 128 bits through the shuffle. Rows whose digest no other has are kept as they are; the
    others meet in full and are compared by all their columns, so a digest that two rows share by chance
    costs work and no row. Where few rows repeat, Spark broadcasts their digests and no wide row moves. Nulls
    are equal to each other. The table is read twice more; worth it where rows are far wider than 16 bytes.
    """
    first, second = "_digest_1", "_digest_2"
    while {first, second} & set(df.columns):
        first, second = f"{first}_", f"{second}_"
    # Zeros of either sign are equal but have other bits.
    plain = [
        F.col(f"`{f.name}`") + 0.0 if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    digests = {name: F.xxhash64(F.lit(k), *plain) for k, name in enumerate((first, second))}
    keyed = df.withColumns(digests)
    repeated = df.select(*(c.alias(n) for n, c in digests.items())).groupBy(first, second).count().where("count > 1")
    repeated = repeated.select(first, second)
    alone = keyed.join(repeated, [first, second], "left_anti").select(*df.columns)
    several = keyed.join(repeated, [first, second], "left_semi").select(*df.columns).dropDuplicates()
    return alone.unionByName(several)


def all_null(columns: Iterable[str]) -> Column:
    return reduce(and_, [F.col(c).isNull() for c in columns])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Remove rows whose columns are all null.

    The planner tracks a condition on many columns through every later renaming, at a cost that
    doubles with each. A plan that goes on to rename and filter wide rows should filter on the
    ``filled`` count of ``deduplicate`` instead, as the cleaning stage does.
    """
    return df.na.drop("all")
