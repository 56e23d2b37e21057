"""Raw CSV files: every cell is text or null; types come later, in the cleaning plan."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import blank_to_null
from tallybook.sources.csv_facts import (
    CSV_FORMAT,
    FALLBACK_ENCODING,
    LINES,
    RECORDS,
    CsvFacts,
    CsvKind,
    cell_count,
    csv_facts,
    file_hash,
    header_names,
)
from tallybook.sources.csv_records import csv_records

__all__ = ["file_encodings", "header_names", "read_csv_facts", "read_csv_source", "read_sources"]

#: The column that holds the text of a record with more cells than its header, where such rows are marked.
SURPLUS = "surplus\x01record"


def read_csv_source(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    encoding: str | None = None,
    facts: CsvFacts | None = None,
    mark_surplus: bool = False,
) -> DataFrame:
    """Read one source, a file or a folder of files with the same columns, in any order.

    Without ``encoding`` each file is UTF-8 if all its bytes are, else Latin-1. Each file is read under its
    own header, the first record that is not blank, and columns meet by name; files whose columns differ are
    refused. A row with more cells than its header is an error, or with ``mark_surplus`` has its record in one
    more column, ``SURPLUS``, where its own cells may not be relied on. Files with line ends inside of quoted
    cells are read split by split like others. Only files whose quotes follow no rule, or all with
    ``multi_line``, are read whole, each by one task. ``facts`` of an earlier scan save this one's.
    """
    facts = facts or csv_facts(spark, path, multi_line, encoding)
    names = facts.kinds[0].names
    parts = [_read(spark, facts, kind, chosen) for kind, chosen in _branches(facts.kinds)]
    whole = reduce(DataFrame.unionByName, [p.select(*map(_quoted, names), SURPLUS) for p in parts])
    if mark_surplus:
        return whole
    more = F.raise_error(F.concat(F.lit(f"a row of {path} has more cells than its header: "), SURPLUS))
    kept = whole.where(F.when(F.col(SURPLUS).isNull(), F.lit(True)).otherwise(more.cast("boolean")))
    return kept.select(*map(_quoted, names))


def read_csv_facts(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, encoding: str | None = None
) -> tuple[DataFrame, CsvFacts]:
    """A source with surplus rows marked, and what one scan of its lines tells, types and dates included."""
    facts = csv_facts(spark, path, multi_line, encoding, types=True)
    return read_csv_source(spark, path, facts=facts, mark_surplus=True), facts


def file_encodings(spark: SparkSession, path: str | list[str]) -> dict[str, str]:
    """Encoding of each file of a source: UTF-8 when all its bytes are, else Latin-1."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("ok"))
    files = lines.groupBy("file").agg(F.bool_and("ok").alias("valid")).collect()
    return {unquote(f["file"]): "UTF-8" if f["valid"] else FALLBACK_ENCODING for f in files}


def read_sources(
    spark: SparkSession,
    sources: Mapping[str, str],
    options: Mapping[str, Mapping[str, object]] | None = None,
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Read every named source; one that is missing is noted and skipped, the others go on.

    ``options`` gives ``multi_line`` and ``encoding`` by source.
    """
    frames, errors = {}, {}
    for name, path in sources.items():
        try:
            frames[name] = read_csv_source(spark, path, **(options or {}).get(name, {}))
        except (AnalysisException, ValueError) as error:
            errors[name] = reading_error(path, error)
    return frames, errors


def reading_error(path: str, error: Exception) -> str:
    """What to tell about a source that cannot be read."""
    if isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND":
        return f"nothing to read at {path}; check the source's path"
    return str(error)


def _branches(kinds: tuple[CsvKind, ...]) -> list[tuple[CsvKind, Column | None]]:
    """Each kind with the condition that chooses its files: their hashes, or for the most files all other hashes.

    Spark tests the condition on the list of files, so none is opened twice.
    """
    if len(kinds) == 1:
        return [(kinds[0], None)]
    most = max(kinds, key=lambda k: len(k.files))
    rest = [h for k in kinds if k is not most for h in k.files]
    return [(k, ~file_hash().isin(rest) if k is most else file_hash().isin(list(k.files))) for k in kinds]


def _read(spark: SparkSession, facts: CsvFacts, kind: CsvKind, chosen: Column | None) -> DataFrame:
    """The files of a kind: cells as text, and the record of each row with more cells than names."""
    width = len(kind.names)
    cells = [f"c{i}" for i in range(width)]
    fields = [T.StructField(c, T.StringType()) for c in cells]
    if kind.quoting == RECORDS:
        records = csv_records(spark, facts.path, chosen, kind.encoding)
        parsed = F.from_csv("record", F.lit(", ".join(f"{c} string" for c in cells)), {**CSV_FORMAT, "multiLine": "true"})
        rows = records.select("record", parsed.alias("cells")).select("cells.*", "record")
    else:
        options = {**CSV_FORMAT, "encoding": kind.encoding, "multiLine": str(kind.quoting != LINES)}
        # All cells are parsed, so that a row whose number of cells differs is told apart.
        options |= {"header": "true", "enforceSchema": "true", "columnPruning": "false", "columnNameOfCorruptRecord": "record"}
        schema = T.StructType([*fields, T.StructField("record", T.StringType())])
        rows = spark.read.options(**options).schema(schema).csv(facts.path)
        rows = rows if chosen is None else rows.where(chosen)
    # Spark refuses plans that read nothing but the record, so a cell, or rather nothing of it, is part of it.
    record = F.concat("record", F.left(F.coalesce("c0", F.lit("")), F.lit(0)))
    surplus = F.when(cell_count(F.col("record")) > width, record).alias(SURPLUS)
    return rows.select(*[blank_to_null(F.col(c)).alias(n) for c, n in zip(cells, kind.names, strict=True)], surplus)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
