"""Token counts per field: whole documents are encoded once, and tokens attributed by their spans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.encoding import encoder, steps

RULES = ("overlap", "first", "last")


def attribute(starts: np.ndarray, ends: np.ndarray, edges: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token [start, end), and whether it crosses an edge; section k is [edges[k], edges[k+1]).

    A crossing token goes to the section of its first byte (``first``), of its last byte (``last``), or to the
    one that it overlaps most, the earlier of equals (``overlap``). Sections of no length get none.
    """
    first = np.searchsorted(edges, starts, side="right") - 1
    last = np.searchsorted(edges, ends - 1, side="right") - 1
    crossing = first != last
    section = (last if rule == "last" else first).copy()
    if rule == "overlap":
        for i in np.flatnonzero(crossing):
            inside = np.arange(first[i], last[i] + 1)
            overlap = np.minimum(edges[inside + 1], ends[i]) - np.maximum(edges[inside], starts[i])
            section[i] = inside[np.argmax(overlap)]
    return section, crossing


def _count(batches: Iterator[pa.RecordBatch], tokenizer: str, fields: Sequence[str], separator: str, rule: str) -> Iterator[pa.RecordBatch]:
    encode = encoder(tokenizer)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        columns = [batch.column(1 + i).to_pylist() for i in range(len(fields))]
        values = [[x or "" for x in row] for row in zip(*columns, strict=True)]
        texts = [separator.join(row) for row in values]
        for a, b in steps(texts):
            flat, n = encode.encode(texts[a:b])
            # The documents of the step stand one after the other; so do the edges of their sections.
            sizes = [s for row in values[a:b] for v in row for s in (len(v.encode()), len(separator.encode()))]
            sizes = np.array(sizes, np.int64).reshape(b - a, -1)[:, :-1]
            edges = np.concatenate([[0], np.cumsum(sizes.ravel())])
            ends = np.cumsum(encode.bytes[flat])
            section, crossing = attribute(ends - encode.bytes[flat], ends, edges, rule)
            total = sizes.size
            counts = np.bincount(section, minlength=total).reshape(b - a, -1)
            crossed = np.bincount(section[crossing], minlength=total).reshape(b - a, -1)
            out: dict[str, list] = {"id": [], "field": [], "n_bytes": [], "n_tokens": [], "n_crossing": [], "document_tokens": []}
            for k, name in enumerate(fields):
                # Before every field but the first stands a separator, whose tokens count with the field.
                own = slice(max(0, 2 * k - 1), 2 * k + 1)
                out["id"] += ids[a:b]
                out["field"] += [name] * (b - a)
                out["n_bytes"] += sizes[:, 2 * k].tolist()
                out["n_tokens"] += counts[:, own].sum(axis=1).tolist()
                out["n_crossing"] += crossed[:, own].sum(axis=1).tolist()
                out["document_tokens"] += n.tolist()
            yield pa.RecordBatch.from_pydict(
                {k: pa.array(v, pa.string() if k == "field" else pa.int64()) for k, v in out.items()}
            )


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    fields: Sequence[str] = ("source", "lang", "text"),
    separator: str = " ",
    rule: str = "overlap",
    id_col: str = "doc_id",
) -> DataFrame:
    """Tokens of each field of each document when its fields are encoded as one text.

    One row per document and field: ``id_col``, ``field``, ``n_bytes``, ``n_tokens``, ``n_crossing`` (those that
    reach over an edge) and ``document_tokens`` (of the whole). The counts of a document's fields add up to
    it: what lies between fields is counted with the field after it. A token that crosses is given to one
    field by ``rule``: most overlap (the earlier of equals), first byte, or last byte. Null fields are empty.
    Spans are in UTF-8 bytes, as byte-level tokens may cut a character. Rows are independent: nothing is
    shuffled, repeated ids are counted each, other columns are left out, an empty table stays empty.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    columns = [F.col(f).cast("string") for f in fields]
    counted = docs.select(F.col(id_col).cast("bigint"), *columns).mapInArrow(
        lambda it: _count(it, tokenizer, fields, separator, rule),
        "id long, field string, n_bytes long, n_tokens long, n_crossing long, document_tokens long",
    )
    return counted.withColumnRenamed("id", id_col)
