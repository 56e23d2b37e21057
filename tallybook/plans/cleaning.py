"""The cleaning stage: raw text tables to typed, filled, standard ones, with a report per source."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import parse_number, strip
from tallybook.operators import (
    apply_schema,
    clean_values,
    date_columns,
    deduplicate,
    deduplicate_known,
    infer_types,
    row_hash,
    standardize_columns,
)
from tallybook.operators.profile import day_first_columns, is_unparsed, removal_counts
from tallybook.operators.values import fill_columns
from tallybook.session import compile_wide_stages, table_bytes
from tallybook.sinks import write_cleaned
from tallybook.sinks.files import remove
from tallybook.sources import read_csv_facts, read_csv_source
from tallybook.sources.csv import SURPLUS, reading_error

# The declared form of the order-line table; what the KPI suite reads.
SALES_SCHEMA = (
    "order_id string, order_date date, status string, fulfilment string, sales_channel string,"
    " shipservicelevel string, sku string, category string, size string, courier_status string,"
    " qty bigint, amount decimal(18,2), shipcity string, shipstate string, shipcountry string,"
    " b2b boolean"
)

REPORT_SCHEMA = (
    "name string, raw_rows bigint, clean_rows bigint, duplicates_removed bigint,"
    " empty_rows_removed bigint, null_fills map<string,bigint>, columns array<string>,"
    " warnings array<string>, success boolean, error string"
)

_READING, _CLEANING = {"multi_line", "encoding"}, {"ignore", "legacy_substring", "day_first"}
_COPIES, _FILLED, _NULLS, _UNPARSED, _UNFIT = "_copies", "_filled", "_nulls:", "_unparsed:", "_unfit:"
_REJECTED = "_rejected"

#: Bytes of a source from which only rows whose hash repeats are shuffled, and such hashes that are broadcast at most.
SIFTED_BYTES, MOST_REPEATED = 32 << 20, 1 << 20


def typed_table(raw: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Standard names, and text columns that hold only numbers or booleans cast to these.

    ``types`` gives the types by standard name; without it they are inferred from all values, at the
    price of one more scan. Columns that become dates stay text until the values are cleaned.
    """
    named = standardize_columns(raw)
    return named.select(*_typed(named, infer_types(named) if types is None else types))


def _typed(named: DataFrame, found: Mapping[str, str]) -> list[Column]:
    def typed(field: T.StructField) -> Column:
        column = F.col(field.name)
        if not isinstance(field.dataType, T.StringType):
            return column
        match found.get(field.name, "string"):
            case "bigint":
                return strip(column).try_cast("bigint").alias(field.name)
            case "double":
                return parse_number(strip(column)).alias(field.name)
            case "boolean":
                return column.try_cast("boolean").alias(field.name)
        return column

    return [typed(field) for field in named.schema.fields]


def _distinct_rows(
    raw: DataFrame,
    types: Mapping[str, str] | None,
    ignore: Iterable[str],
    copies: str | None = None,
    fitting: bool = False,
    scratch: str | None = None,
) -> tuple[DataFrame, list[str]]:
    """Typed rows without copies, with the number of filled cells, and the names of the columns.

    Types that fit every cell, inferred or ``fitting``, are applied first and rows are compared typed. Other
    declared types may not fit: then rows are compared as text, and a cell that does not fit becomes null and is
    marked afterwards. A column ``SURPLUS`` of marked records is not part of the table: rows with a mark
    stay apart from others, and no cell of theirs counts as filled. ``scratch`` is a folder for hashes of rows.
    """
    compile_wide_stages(raw.sparkSession)
    marked = [SURPLUS] if SURPLUS in raw.columns else []
    plain = raw.drop(*marked)
    named = standardize_columns(plain)
    names = named.columns
    # No standard name begins with the sign that keeps the mark apart.
    named = raw.toDF(*[SURPLUS if c == SURPLUS else names[plain.columns.index(c)] for c in raw.columns])
    if types is None or fitting:
        types = infer_types(named.drop(*marked)) if types is None else types
        rows = named.select(*_typed(named.drop(*marked), types), *marked)
        return _apart(_without_copies(rows, ignore, copies, scratch), marked), names
    rows = _apart(_without_copies(named, ignore, copies, scratch), marked)
    columns = dict(zip(names, _typed(named.drop(*marked), types), strict=True))
    text = {f.name for f in named.schema.fields if isinstance(f.dataType, T.StringType)}
    marks = [
        (F.coalesce(strip(F.col(c)) != "", F.lit(False)) & columns[c].isNull()).alias(_UNFIT + c)
        for c in names
        if c in text and types.get(c, "string") != "string"
    ]
    return rows.select(*columns.values(), *marks, _FILLED, *([copies] if copies else []), *marked), names


def _without_copies(rows: DataFrame, ignore: Iterable[str], copies: str | None, scratch: str | None) -> DataFrame:
    """Distinct rows with the number of filled ones among their copies.

    Shuffled rows take many times the disk of the source, so of a large one, given ``scratch``, 64-bit hashes are
    shuffled first, in one more scan, and then only rows whose hash repeats. Where too many repeat to be broadcast,
    all rows are shuffled, and most copies meet on the map side.
    """
    ignore = set(ignore)
    if scratch is None or ignore >= set(rows.columns) or table_bytes(rows) < SIFTED_BYTES:
        return deduplicate(rows, ignore, copies, _FILLED)
    hashes = rows.select(row_hash(rows, ignore).alias("hash")).groupBy("hash").count()
    write_cleaned(hashes.where("count > 1").select("hash"), scratch)
    repeated = rows.sparkSession.read.schema("hash bigint").parquet(scratch)
    if repeated.count() > MOST_REPEATED:
        return deduplicate(rows, ignore, copies, _FILLED)
    return deduplicate_known(rows, repeated, ignore, copies, _FILLED)


def _apart(rows: DataFrame, marked: list[str]) -> DataFrame:
    """Marked rows as rows without any filled cell."""
    if not marked:
        return rows
    return rows.withColumn(_FILLED, F.when(F.col(SURPLUS).isNull(), F.col(_FILLED)).otherwise(0))


def clean_table(
    raw: DataFrame,
    types: Mapping[str, str] | None = None,
    ignore: Iterable[str] = (),
    legacy_substring: bool = False,
    day_first: Iterable[str] | None = (),
) -> DataFrame:
    """One cleaned table: names, types, copies, empty rows, then all value rules in one select.

    The only shuffle is the removal of copies. Cells that do not fit a declared type become null after
    copies and empty rows are removed, so no row goes with them. ``day_first`` names date columns with the day
    before the month; ``None`` lets the columns decide, at the price of one more scan.
    """
    rows, columns = _distinct_rows(raw, types, ignore)
    return clean_values(_not_empty(rows, columns), legacy_substring, _day_first(raw, day_first))


def _day_first(raw: DataFrame, day_first: Iterable[str] | None) -> list[str]:
    if day_first is not None:
        return list(day_first)
    named = standardize_columns(raw.drop(SURPLUS))
    return day_first_columns(named, date_columns(named))


def _not_empty(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.where(F.col(_FILLED) > 0).select(*columns)


def as_sales_orders(cleaned: DataFrame) -> DataFrame:
    """A cleaned order table in the declared form; its date may be called ``date``."""
    return apply_schema(cleaned, SALES_SCHEMA, sales_names(cleaned))


def sales_names(cleaned: DataFrame) -> dict[str, str]:
    """Columns that an order table may hold under another name."""
    return {} if "order_date" in cleaned.columns else {"order_date": "date"}


def cleaning_report(
    name: str,
    raw: DataFrame,
    types: Mapping[str, str] | None = None,
    ignore: Iterable[str] = (),
    day_first: Iterable[str] | None = (),
) -> DataFrame:
    """The report row of one source, as a lazy aggregate; nothing is written."""
    rows, columns = _distinct_rows(raw, types, ignore, _COPIES)
    return _report_row(name, rows.agg(*_counters(rows, columns, _day_first(raw, day_first))), columns)


def clean_and_write(
    name: str,
    raw: DataFrame,
    path: str,
    types: Mapping[str, str] | None = None,
    ignore: Iterable[str] = (),
    file_format: str = "parquet",
    legacy_substring: bool = False,
    day_first: Iterable[str] | None = (),
    fitting: bool = False,
) -> DataFrame:
    """Clean one source, write it, and return its report row, all in one run over the data.

    The counters are observed after copies are removed, in the stage that writes. Spark
    counts each task of that stage once, so a lost executor does not change them. Rows with more cells than
    their header (marked in ``SURPLUS``) are counted there too and left out; where there are any, a second
    run writes their records to ``path`` + ``_rejected``. ``fitting`` types are known to fit every cell.
    """
    day_first = _day_first(raw, day_first)
    folder, _, last = path.rstrip("/").rpartition("/")
    scratch = f"{folder}/_hashes-{uuid4().hex}-{last}" if folder else None
    try:
        rows, columns = _distinct_rows(raw, types, ignore, _COPIES, fitting, scratch)
        observed = Observation(name)
        rows = rows.observe(observed, *_counters(rows, columns, day_first))
        write_cleaned(clean_values(_not_empty(rows, columns), legacy_substring, day_first), path, file_format)
    finally:
        if scratch:
            remove(raw.sparkSession, scratch)
    values = observed.get
    if values.get(_REJECTED):
        rejected = raw.where(F.col(SURPLUS).isNotNull())
        write_cleaned(rejected.select(F.lit("more cells than the header").alias("reason"), F.col(SURPLUS).alias("record")), f"{path}_rejected")
    schema = T.StructType([T.StructField(key, T.LongType()) for key in values])
    counts = raw.sparkSession.createDataFrame([tuple(values.values())], schema)
    return _report_row(name, counts, columns)


def clean_all(
    spark: SparkSession,
    sources: Mapping[str, str],
    out: str,
    types: Mapping[str, Mapping[str, str]] | None = None,
    file_format: str = "parquet",
    options: Mapping[str, Mapping[str, object]] | None = None,
) -> DataFrame:
    """Clean every source into ``out``. A source that fails gets an error row; the others go on.

    A source's text is read twice: one scan of its lines for encodings, headers, quotes, types and the order
    of its dates, and one that cleans; a large one once more for the hashes of its rows, so that only rows that may be
    copies are shuffled, and once more for these if there are any. ``options`` gives by source what differs from the usual: ``multi_line`` and
    ``encoding`` of its files, ``ignore`` for columns that do not make rows different, ``legacy_substring``,
    ``types``, and ``day_first``. Known types spare the first scan its larger half.
    """
    types, options = types or {}, options or {}
    unknown = {o for given in options.values() for o in given} - _READING - _CLEANING - {"types"}
    if unknown or set(options) - set(sources):
        raise ValueError(f"unknown options or sources: {sorted(unknown | set(options) - set(sources))}")
    reports = []
    for name, source in sources.items():
        given = options.get(name, {})
        try:
            reading = {o: v for o, v in given.items() if o in _READING}
            how = {o: v for o, v in given.items() if o in _CLEANING}
            known = given.get("types", types.get(name))
            if known is None:
                raw, facts = read_csv_facts(spark, source, **reading)
                if facts.types is not None:
                    standard = dict(zip(raw.columns, standardize_columns(raw.drop(SURPLUS)).columns))
                    known = {standard[c]: kind for c, kind in facts.types.items()}
                    how |= {"fitting": True}
                    how.setdefault("day_first", [standard[c] for c in facts.day_first])
                else:
                    how.setdefault("day_first", None)
            else:
                raw = read_csv_source(spark, source, mark_surplus=True, **reading)
            reports.append(clean_and_write(name, raw, f"{out}/{name}_cleaned", known, file_format=file_format, **how))
        except Exception as error:  # one bad source must not stop the rest
            reports.append(_failed_row(spark, name, reading_error(source, error)))
    return reduce(DataFrame.unionByName, reports)


def _counters(rows: DataFrame, columns: list[str], day_first: Iterable[str] = ()) -> list[Column]:
    """Aggregates over the distinct rows that hold everything the report states."""
    full, typed = F.col(_FILLED) > 0, rows.select(*columns)
    marked = SURPLUS in rows.columns
    own = F.col(SURPLUS).isNull() if marked else F.lit(True)
    unfit = [c.removeprefix(_UNFIT) for c in rows.columns if c.startswith(_UNFIT)]

    def empty(name: str) -> Column:
        return F.col(name).isNull() & (~F.col(_UNFIT + name) if name in unfit else F.lit(True))

    nulls = [F.count_if(full & empty(c)).alias(_NULLS + c) for c in fill_columns(typed.schema)]
    unparsed = [F.count_if(own & is_unparsed(c, c in day_first)).alias(_UNPARSED + c) for c in date_columns(typed)]
    unparsed += [F.count_if(own & F.col(_UNFIT + c)).alias(_UNPARSED + c) for c in unfit]
    if not marked:
        return [*removal_counts(_COPIES, F.col(_FILLED) == 0), *nulls, *unparsed]
    rejected = F.coalesce(F.sum(F.when(~own, F.col(_COPIES))), F.lit(0))
    raw_rows, distinct = F.coalesce(F.sum(_COPIES), F.lit(0)), F.count_if(own)
    return [
        raw_rows.alias("raw_rows"),
        F.count_if(full).alias("clean_rows"),
        (raw_rows - rejected - distinct).alias("duplicates_removed"),
        F.count_if(own & ~full).alias("empty_rows_removed"),
        rejected.alias(_REJECTED),
        *nulls,
        *unparsed,
    ]


def _report_row(name: str, counts: DataFrame, columns: list[str]) -> DataFrame:
    def entries(prefix: str) -> list[Column]:
        return [
            F.struct(F.lit(c.removeprefix(prefix)).alias("key"), F.col(f"`{c}`").alias("value"))
            for c in counts.columns
            if c.startswith(prefix)
        ]

    def positive(pairs: list[Column]) -> Column:
        listed = F.array(*pairs).cast("array<struct<key:string,value:bigint>>")
        return F.filter(listed, lambda pair: pair["value"] > 0)

    def warning(pair: Column) -> Column:
        return F.concat(pair["value"].cast("string"), F.lit(" unparsed in "), pair["key"])

    warnings = F.transform(positive(entries(_UNPARSED)), warning)
    if _REJECTED in counts.columns:
        told = F.concat(F.col(_REJECTED).cast("string"), F.lit(" rows with more cells than the header"))
        warnings = F.concat(warnings, F.when(F.col(_REJECTED) > 0, F.array(told)).otherwise(F.array().cast("array<string>")))
    return counts.select(
        F.lit(name).alias("name"),
        "raw_rows",
        "clean_rows",
        "duplicates_removed",
        "empty_rows_removed",
        F.map_from_entries(positive(entries(_NULLS))).alias("null_fills"),
        F.array(*[F.lit(c) for c in columns]).alias("columns"),
        warnings.alias("warnings"),
        F.lit(True).alias("success"),
        F.lit("").alias("error"),
    )


def _failed_row(spark: SparkSession, name: str, error: str) -> DataFrame:
    row = (name, 0, 0, 0, 0, {}, [], [], False, error)
    return spark.createDataFrame([row], REPORT_SCHEMA)
