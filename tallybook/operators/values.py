"""Value rules of the cleaning stage. Names decide which rules a column gets; one select applies them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import (
    money_text,
    not_negative,
    parse_date,
    parse_number,
    parse_timestamp,
    strip,
    title_case,
    upper_code,
)

# Fills for nulls, and the parts of a column name that select a rule.
TEXT_FILL = "Unknown"
NUMBER_FILL = 0
DATE_WORDS = ("date", "time", "dt")
MONEY_WORDS = ("amount", "revenue", "sales", "price", "mrp")
SKU_WORDS = ("sku",)
PLACE_WORDS = ("category", "state", "city", "country")

# Names that hold a money word but no money.
NOT_MONEY_SUFFIX = "_channel"


def _has(name: str, words: Iterable[str]) -> bool:
    return any(word in name for word in words)


def _is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StringType)


def _is_number(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def date_columns(df: DataFrame) -> list[str]:
    """Text columns whose name speaks of a date or time."""
    return [f.name for f in df.schema.fields if _is_text(f.dataType) and _has(f.name, DATE_WORDS)]


def column_rules(schema: T.StructType, legacy_substring: bool = False) -> dict[str, list[str]]:
    """The rules of every column, in the order they apply.

    A plain substring match would also treat ``sales_channel`` and dates such as ``sales_date`` as
    money and turn them into 0. These are left out unless ``legacy_substring`` asks for it.
    """
    plan = {}
    for field in schema.fields:
        name, rules = field.name, []
        dated = _is_text(field.dataType) and _has(name, DATE_WORDS)
        if dated:
            rules.append("date")
        elif _is_text(field.dataType):
            rules += ["fill_text", "strip"]
        elif _is_number(field.dataType):
            rules.append("fill_number")
        exempt = name.endswith(NOT_MONEY_SUFFIX) or dated or _is_date(field.dataType)
        if _has(name, MONEY_WORDS) and (legacy_substring or not exempt):
            rules.append("money")
        if _has(name, SKU_WORDS):
            rules.append("sku")
        if _has(name, PLACE_WORDS):
            rules.append("title")
        plan[name] = rules
    return plan


def _is_date(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))


def clean_values(df: DataFrame, legacy_substring: bool = False, day_first: Iterable[str] = ()) -> DataFrame:
    """Apply every column's rules, in two projections of one stage.

    The first fills and strips. The second reads its columns several times, to test a text and then
    convert it, so Spark keeps the two apart and fills and strips once. ``day_first`` names date columns
    that are read with the day before the month.
    """
    plan = column_rules(df.schema, legacy_substring)
    fields = [df.schema[name] for name in plan]
    prepared = df.select(*[_prepare(f, plan[f.name]).alias(f.name) for f in fields])
    return prepared.select(*[_convert(f, plan[f.name], f.name in day_first).alias(f.name) for f in fields])


def _prepare(field: T.StructField, rules: list[str]) -> Column:
    column = F.col(field.name)
    if "fill_text" in rules:
        column = F.coalesce(column, F.lit(TEXT_FILL))
    if "fill_number" in rules:
        column = _filled(column, field.dataType)
    if _is_text(field.dataType):
        column = strip(column)
        if "money" in rules:
            column = money_text(column)
    return column


def _convert(field: T.StructField, rules: list[str], day_first: bool) -> Column:
    column, data_type = F.col(field.name), field.dataType
    for rule in rules:
        match rule:
            case "date":
                column, data_type = _dated(field.name, column, day_first)
            case "money":
                column, data_type = _amount(column, data_type)
            case "sku":
                column, data_type = upper_code(column.cast("string")), T.StringType()
            case "title":
                column, data_type = title_case(column.cast("string")), T.StringType()
    return column


def _dated(name: str, text: Column, day_first: bool = False) -> tuple[Column, T.DataType]:
    if "time" in name:
        return parse_timestamp(text, day_first), T.TimestampNTZType()
    return parse_date(text, day_first=day_first), T.DateType()


def _amount(column: Column, data_type: T.DataType) -> tuple[Column, T.DataType]:
    if _is_number(data_type):
        return not_negative(column, data_type), data_type
    number = parse_number(column.cast("string"))
    return not_negative(number, T.DoubleType()), T.DoubleType()


def _filled(column: Column, data_type: T.DataType) -> Column:
    return F.coalesce(column, F.lit(NUMBER_FILL).cast(data_type))


def detect_and_cast_dates(df: DataFrame, day_first: Iterable[str] = ()) -> DataFrame:
    """Date columns from text; texts that are no date become null and stay null.

    ``day_first`` names columns with the day before the month, such as ``day_first_columns`` finds them. Texts
    are stripped in a projection of their own, as each form looks at them anew.
    """
    dated = date_columns(df)
    stripped = df.withColumns({c: strip(F.col(c)) for c in dated})
    return stripped.withColumns({c: _dated(c, F.col(c), c in day_first)[0] for c in dated})


def fill_nulls_text(df: DataFrame) -> DataFrame:
    """Null texts become ``Unknown``."""
    return df.na.fill(TEXT_FILL, [f.name for f in df.schema.fields if _is_text(f.dataType)])


def fill_nulls_numeric(df: DataFrame) -> DataFrame:
    """Null numbers become 0; dates and booleans keep their nulls."""
    numbers = [f for f in df.schema.fields if _is_number(f.dataType)]
    return df.withColumns({f.name: _filled(F.col(f.name), f.dataType) for f in numbers})


def fill_columns(schema: T.StructType) -> list[str]:
    """Columns whose nulls the cleaning stage fills, and so counts."""
    plan = column_rules(schema)
    return [name for name, rules in plan.items() if {"fill_text", "fill_number"} & set(rules)]


def apply_schema(
    df: DataFrame, schema: T.StructType | str, renamed: Mapping[str, str] | None = None
) -> DataFrame:
    """Project to declared columns and types; a value that does not fit becomes null, never a cut one.

    ``renamed`` maps a declared name to the column that holds it under another name. Declared columns that
    are absent are one error that names them all. ``unfit_counts`` counts the values that do not fit.
    """
    return df.select(*[column.alias(name) for name, _, column in _declared(df, schema, renamed)])


def unfit_counts(
    df: DataFrame, schema: T.StructType | str, renamed: Mapping[str, str] | None = None
) -> DataFrame:
    """(column_name, unfit): values of each declared column that ``apply_schema`` turns into null."""
    counts = df.agg(*unfit_measures(df, schema, renamed))
    return counts.unpivot([], [F.col(_quoted(c)) for c in counts.columns], "column_name", "unfit")


def unfit_measures(
    df: DataFrame, schema: T.StructType | str, renamed: Mapping[str, str] | None = None
) -> list[Column]:
    """The counts of ``unfit_counts`` as aggregates over ``df``, to be observed in another run."""
    declared = _declared(df, schema, renamed)
    return [F.count_if(given.isNotNull() & column.isNull()).alias(name) for name, given, column in declared]


def _declared(
    df: DataFrame, schema: T.StructType | str, renamed: Mapping[str, str] | None
) -> list[tuple[str, Column, Column]]:
    """Name, column as given, and column as declared."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    renamed = renamed or {}

    absent = [f.name for f in schema.fields if renamed.get(f.name, f.name) not in df.columns]
    if absent:
        raise ValueError(f"the table has no column for {', '.join(absent)}; it has {', '.join(df.columns)}")

    def typed(field: T.StructField) -> tuple[str, Column, Column]:
        name = renamed.get(field.name, field.name)
        given, kind = F.col(_quoted(name)), df.schema[name].dataType
        source = parse_date(strip(given)) if _is_text(kind) and _is_date(field.dataType) else given
        if isinstance(kind, (T.FractionalType, T.DecimalType)) and isinstance(field.dataType, T.IntegralType):
            source = F.when(source % 1 == 0, source)
        return field.name, given, source.try_cast(field.dataType)

    return [typed(f) for f in schema.fields]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def stringify_objects(df: DataFrame) -> DataFrame:
    """Columns that are neither numbers, booleans nor dates become text; nulls stay null."""
    kept = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f.name)
            if isinstance(f.dataType, kept)
            else F.col(f.name).cast("string").alias(f.name)
            for f in df.schema.fields
        ]
    )
