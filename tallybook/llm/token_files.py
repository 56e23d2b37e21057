"""Token ids as Arrow stream files of fixed-size lists.

A part is two streams: the sequences (``ids`` and ``mask``, fixed-size lists of equal length, the last one
padded) and the documents (id, place of the first token, number of tokens). Nothing is compressed, so a
mapped file gives any sequence as a view.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import cut, new_path
from tallybook.llm.encoding import encoder, steps

LENGTH = 2048
BATCH = 256
PART_BYTES = 32 << 20
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())])


def sequence_schema(length: int, number: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(number, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them in batches."""

    def __init__(self, sink: pa.NativeFile, length: int, number: pa.DataType):
        self.schema, self.length, self.number = sequence_schema(length, number), length, number
        self.stream, self.waiting, self.size = pa.ipc.new_stream(sink, self.schema), [], 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= BATCH * self.length:
            self._write(self.size - self.size % (BATCH * self.length))

    def _write(self, n: int) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        now, rest = flat[:n], flat[n:]
        self.waiting, self.size = [rest], len(rest)
        for start in range(0, len(now), BATCH * self.length):
            own = now[start : start + BATCH * self.length]
            rows = -(-len(own) // self.length)
            padded = np.zeros(rows * self.length, self.number.to_pandas_dtype())
            padded[: len(own)] = own
            lists = [pa.array(padded), pa.array(np.arange(len(padded)) < len(own))]
            self.stream.write_batch(
                pa.record_batch([pa.FixedSizeListArray.from_arrays(x, self.length) for x in lists], schema=self.schema)
            )

    def close(self) -> None:
        self._write(self.size)
        self.stream.close()


class SequenceFile:
    """Random access to a part by sequence number, without copying: ``file`` is mapped and not compressed."""

    def __init__(self, file: pa.NativeFile):
        self.batches = list(pa.ipc.open_stream(file))
        self.starts = np.cumsum([0, *(b.num_rows for b in self.batches)])

    def __len__(self) -> int:
        return int(self.starts[-1])

    def _values(self, i: int, column: str) -> pa.Array:
        k = int(np.searchsorted(self.starts, i, side="right")) - 1
        lists = self.batches[k].column(column)
        n = lists.type.list_size
        return lists.values.slice((i - self.starts[k]) * n, n)

    def ids(self, i: int) -> np.ndarray:
        return self._values(i, "ids").to_numpy()

    def mask(self, i: int) -> np.ndarray:
        return self._values(i, "mask").to_numpy(zero_copy_only=False)


def _open(path: str, mode: str) -> pa.NativeFile:
    """A file on whatever file system its address names."""
    system, name = FileSystem.from_uri(path)
    if mode == "r":
        return system.open_input_file(name)
    system.create_dir(name.rpartition("/")[0])
    return system.open_output_stream(name)


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end: int, length: int) -> Iterator[pa.RecordBatch]:
    encode, name, tokens = encoder(tokenizer), f"{folder}/{uuid.uuid4().hex}", 0
    number = pa.uint16() if max(len(encode.bytes) - 1, end) < 1 << 16 else pa.uint32()
    sequences = documents = first = None
    for batch in batches:
        texts, ids = batch.column(1).to_pylist(), batch.column(0)
        for a, b in steps(texts):
            if sequences is None:
                part = batch.column(2)[0].as_py()
                files = _open(name + ".ids.arrow", "w"), _open(name + ".docs.arrow", "w")
                sequences, documents = SequenceWriter(files[0], length, number), pa.ipc.new_stream(files[1], DOCUMENTS)
                first = part
            flat, n = encode.encode([t or "" for t in texts[a:b]])
            flat = np.insert(flat, np.cumsum(n), end)
            n = n + 1
            at = tokens + np.cumsum(n) - n
            documents.write_batch(pa.record_batch([ids.slice(a, b - a), pa.array(at), pa.array(n)], schema=DOCUMENTS))
            sequences.add(flat)
            tokens += len(flat)
    if sequences is not None:
        sequences.close()
        documents.close()
        for file in files:
            file.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([first], pa.int32()), "file": [name], "tokens": pa.array([tokens], pa.int64())})


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end: int = 0,
    length: int = LENGTH,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Encode whole texts, add ``end`` to each, write them in ascending id order; one row per part.

    Returns ``part``, ``file`` (address without endings), ``tokens`` and ``start`` (tokens of all parts before).
    A null text is empty. Null ids come first; rows with equal ids follow each other by a hash of the text,
    and such rows that are alike may swap. Other columns are left out. An empty table writes nothing. Parts
    are ranges of (id, hash of text), so a hot id is split too. A task names its files anew, and only files of
    tasks that finish are listed, so a repeated task leaves no mark.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "token-files")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("hash")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    ranged = rows.repartitionByRange(parts, "id", "hash").sortWithinPartitions("id", "hash")
    written = ranged.select("id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        lambda it: _write(it, path, tokenizer, end, length), "part int, file string, tokens long"
    )
    listed = cut(written, "token-parts")
    # One row per part, which bounds this window; parts grow with the input, by a part for each PART_BYTES.
    return listed.withColumn("start", F.expr("sum(tokens) over (order by part)") - F.col("tokens"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with _open(row["file"] + ".docs.arrow", "r") as docs, _open(row["file"] + ".ids.arrow", "r") as ids:
                sequences = iter(pa.ipc.open_stream(ids))
                have, passed = np.empty(0, np.uint32), 0
                for documents in pa.ipc.open_stream(docs):
                    at, n = documents.column(1).to_numpy(), documents.column(2).to_numpy()
                    need = int(at[-1] + n[-1]) - passed if len(n) else 0
                    parts, held = [have], len(have)
                    while held < need:
                        lists = next(sequences)
                        own, mask = (lists.column(k).values.to_numpy(zero_copy_only=False) for k in (0, 1))
                        parts.append(own[mask].astype(np.uint32))
                        held += len(parts[-1])
                    have = np.concatenate(parts)
                    spans = zip((at - passed).tolist(), n.tolist(), strict=True)
                    sums = [zlib.crc32(have[a : a + k].astype("<u4").tobytes()) for a, k in spans]
                    have, passed = have[need:], passed + need
                    yield pa.RecordBatch.from_arrays(
                        [documents.column(0), pa.array(at + row["start"]), pa.array(n), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )


def read_documents(parts: DataFrame) -> DataFrame:
    """One row per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    rows = parts.select("file", "start", "part")
    return rows.repartition(max(1, parts.count()), "part").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
