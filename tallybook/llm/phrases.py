"""Phrase collocation mining by HAT-trie counting.

Texts are encoded once: word ids of a small dictionary per chunk, 0 between pieces. Level by level, words, pairs,
triples of frequent pairs and quadruples of frequent triples are sifted: hashes are counted, and a bitmap of
bounded size tells the tasks which of them may be frequent. A bitmap has no false negatives and what passes is counted exactly, so
its size changes the work, never the result.

What passes is counted in a HAT-trie: a shallow trie over word ids whose leaves are hash containers; a
container that grows too large bursts into one per next word. When the tries of a task hold too much, whole
subtrees leave them as sorted runs, cut into blocks by the hashes of phrases, and the blocks of a part are merged.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import arrow_batches, cut

MASK = (1 << 64) - 1
#: Words of the longest phrase.
LONGEST = 4
#: Words in an encoded row, about; chunks of all languages together hold twice as many.
CHUNK_WORDS = 1 << 19
#: Bytes of a batch that a task hands to Python, about, and encoded rows that are written and read together at most.
BATCH_BYTES, GROUP_ROWS = 8 << 20, 8
#: Entries of a container that bursts, and of a task's tries together before subtrees leave them.
BURST, TRIE_ENTRIES = 4096, 400_000
#: Bytes of text that are Python objects at a time, and rows of a run that leave a task together.
SLICE_BYTES, RUN_ROWS = 4 << 20, 50_000
#: A word id has 21 bits, so that three of them are one number.
ID_BITS = 21
#: Counted hashes that a task holds before they leave it, and hashes that are merged together, about.
TASK_HASHES, PART_HASHES = 1 << 20, 1 << 22
#: Bits of a bitmap at most (32 MB), and bits for each entry below that.
FILTER_BITS, BITS_EACH = 1 << 28, 32
#: Words of the texts for each part that phrases are dealt to, about, and parts at least.
PART_WORDS, LEAST_PARTS = 1 << 21, 16
SALTS = 64
# What separates pieces.
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"\n" * 10)
BLOCKS = "lang string, part long, phrases array<string>, counts array<long>"


class _Numbers(dict):
    """Word -> its number, from 1."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


class _Chunk:
    """Words of one language, as numbers of an own dictionary."""

    def __init__(self):
        self.numbers, self.ids = _Numbers(), array("i")

    def row(self, lang: str, tail: int) -> tuple:
        flat = np.frombuffer(self.ids, np.int32) if len(self.ids) else np.empty(0, np.int32)
        counts = np.bincount(flat[: len(flat) - tail], minlength=len(self.numbers) + 1)[1:]
        return lang, list(self.numbers), counts, flat, tail


def _pieces(text: str) -> Iterator[list[bytes]]:
    for piece in text.encode("utf-8", "surrogatepass").lower().translate(_BREAKS).split(b"\n"):
        words = piece.split()
        if words:
            yield words


def _encoded_rows(texts: Iterator[tuple[str, str]], chunk_words: int) -> Iterator[tuple]:
    """(lang, words, counts, ids, tail): the last ``tail`` ids are shown only as what follows, and count elsewhere."""
    chunks: dict[str, _Chunk] = {}
    held = 0
    for lang, text in texts:
        chunk = chunks.setdefault(lang, _Chunk())
        for words in _pieces(text):
            at = 0
            while True:  # a piece longer than a chunk goes on in the next one
                room = max(1, chunk_words - len(chunk.ids))
                now = words[at : at + room]
                chunk.ids.extend(map(chunk.numbers.__getitem__, now))
                at, held = at + len(now), held + len(now) + 1
                if at >= len(words):
                    chunk.ids.append(0)
                    break
                ahead = words[at : at + LONGEST - 1]
                chunk.ids.extend(map(chunk.numbers.__getitem__, ahead))
                yield chunk.row(lang, len(ahead))
                chunk = chunks[lang] = _Chunk()
            if len(chunk.ids) >= chunk_words:
                yield chunk.row(lang, 0)
                chunk = chunks[lang] = _Chunk()
        if held > 2 * chunk_words:
            for name, own in chunks.items():
                if own.ids:
                    yield own.row(name, 0)
            chunks, held = {}, 0
    for name, own in chunks.items():
        if own.ids:
            yield own.row(name, 0)


def _encode(batches: Iterator[pa.RecordBatch], chunk_words: int) -> Iterator[pa.RecordBatch]:
    texts = (
        (lang, text)
        for batch in batches
        for part in _slices(batch)
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
        if text
    )
    for lang, words, counts, ids, tail in _encoded_rows(texts, chunk_words):
        one = [pa.array([lang]), _list(pa.array(words, pa.binary()).cast(pa.string())), _list(pa.array(counts, pa.int64())), _list(pa.array(ids, pa.int32())), pa.array([tail], pa.int32())]
        yield pa.RecordBatch.from_arrays(one, names=["lang", "words", "counts", "ids", "tail"])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, batch.num_rows * SLICE_BYTES // max(SLICE_BYTES, batch.column(1).nbytes))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def _list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class HatTrie:
    """Counts of sequences of word ids up to ``LONGEST``: a trie of word ids over hash containers.

    A node maps a word id to a node or a container; a container maps the ids that remain, packed into one
    number, to a count. The root maps first words.
    """

    def __init__(self, burst: int = BURST):
        self.root: dict[int, _Subtree] = {}
        self.burst, self.entries = burst, 0

    def add(self, first: np.ndarray, rest: np.ndarray, n: np.ndarray) -> None:
        """Count sequences: their first ids, ascending, the packed rest, and how often each."""
        if not len(first):
            return
        edges = np.flatnonzero(np.diff(first)) + 1
        starts, ends = [0, *edges.tolist()], [*edges.tolist(), len(first)]
        rests, counts, heads = rest.tolist(), n.tolist(), first[starts].tolist()
        for head, a, b in zip(heads, starts, ends, strict=True):
            tree = self.root.get(head)
            if tree is None:
                tree = self.root[head] = _Subtree()
            self.entries += tree.add(rests[a:b], counts[a:b], self.burst)

    def largest(self, share: float) -> list[int]:
        """First words of the largest subtrees that hold this share of all entries."""
        sizes = sorted(((t.size, head) for head, t in self.root.items()), reverse=True)
        out, left = [], share * self.entries
        for size, head in sizes:
            if left <= 0:
                break
            out.append(head)
            left -= size
        return out

    def take(self, heads: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Remove subtrees and return their entries: first words, packed rests and counts."""
        rest, n, sizes = array("q"), array("q"), []
        for head in heads:
            tree = self.root.pop(head)
            tree.fill(rest, n)
            sizes.append(tree.size)
        self.entries -= sum(sizes)
        return np.repeat(np.array(heads, np.int64), sizes), np.array(rest, np.int64), np.array(n, np.int64)


class _Subtree:
    """What starts with one word: one container, or after a burst one for each next word."""

    LOW = (1 << (2 * ID_BITS)) - 1

    def __init__(self):
        self.held: dict[int, int] | None = {}
        self.children: dict[int, dict[int, int]] = {}
        self.size = 0

    def add(self, rests: list[int], counts: list[int], burst: int) -> int:
        before = self.size
        if self.held is not None:
            held = self.held
            get = held.get
            for rest, n in zip(rests, counts, strict=True):
                held[rest] = get(rest, 0) + n
            self.size = len(held)
            if self.size > burst:
                self._burst()
        else:
            last, own = -1, {}
            for rest, n in zip(rests, counts, strict=True):
                word = rest >> (2 * ID_BITS)
                if word != last:
                    last, own = word, self.children.setdefault(word, {})
                key = rest & self.LOW
                if key in own:
                    own[key] += n
                else:
                    own[key] = n
                    self.size += 1
        return self.size - before

    def _burst(self) -> None:
        for rest, n in self.held.items():
            self.children.setdefault(rest >> (2 * ID_BITS), {})[rest & self.LOW] = n
        self.held = None

    def fill(self, rest: array, n: array) -> None:
        """Append the packed rests and the counts of all entries."""
        if self.held is not None:
            rest.extend(self.held)
            n.extend(self.held.values())
            return
        for word, own in self.children.items():
            start = word << (2 * ID_BITS)
            rest.extend([start + key for key in own])
            n.extend(own.values())


class _Frequent:
    """Whether a hash may belong to a frequent phrase; of the hash the bits below ``shift`` are left out."""

    def __init__(self, bitmap: bytes, shift: int = 0):
        self.bits, self.shift = np.frombuffer(bitmap, np.uint8), np.uint64(shift)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _hashes(values: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(v, seed) for v in values), np.uint64, len(values))


def _chain(hashes: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Hash of a sequence with one more word."""
    x = (hashes ^ hashes >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) + following
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


class _Sieve:
    """What the levels below know: bitmaps of frequent phrases of one to four words, as far as there are any."""

    def __init__(self, levels: Sequence[tuple[bytes, int]]):
        self.levels = [_Frequent(*level) for level in levels]

    def __call__(self, lang: str, words: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Of the words of a dictionary whether each passes; per level, which places of ``ids`` start a phrase that
        passes; and the hashes of the phrases one word longer.
        """
        own = _hashes(words, xxhash.xxh64_intdigest(lang.encode(), 42))
        frequent = np.concatenate([[False], self.levels[0](own)])
        word = np.concatenate([np.zeros(1, np.uint64), own])[ids]
        end = np.zeros(LONGEST, np.uint64)
        word = np.concatenate([word, end])
        passed = [np.concatenate([frequent[ids], np.zeros(LONGEST, bool)])]
        hashes = word
        for size, level in enumerate(self.levels[1:], 2):
            hashes = _chain(hashes, _ahead(word, size - 1))
            passed.append(passed[-1] & _ahead(passed[-1], 1) & level(hashes))
        return frequent[1:], passed, _chain(hashes, _ahead(word, len(self.levels)))


def _ahead(x: np.ndarray, n: int) -> np.ndarray:
    """``x`` moved ``n`` places to the front, with nothing behind."""
    return np.concatenate([x[n:], np.zeros(n, x.dtype)])


def _sift(batches: Iterator[pa.RecordBatch], levels: Sequence[tuple[bytes, int]], bits: int) -> Iterator[pa.RecordBatch]:
    """Counted hashes of phrases one word longer than the last level, whose parts pass it, in 2 ** ``bits`` parts.

    A hash is cut to 32 bits behind those of its part, and a count ends at 255: both can only make more pass.
    """
    sieve, held, size = _Sieve(levels), [], 0

    def combined() -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[edges], np.add.reduceat(counts[order], edges)

    def flushed(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = (keys >> np.uint64(32)).astype(np.int64)
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        low, few = keys.astype("<u4"), np.minimum(counts, 255).astype(np.uint8)
        spans = list(zip(edges, edges[1:]))
        for k in range(0, len(spans), 4096):
            some = spans[k : k + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[[a for a, _ in some]], pa.int64())] + [pa.array([x[a:b].tobytes() for a, b in some], pa.binary()) for x in (low, few)],
                names=["part", "keys", "counts"],
            )

    for lang, words, ids, tail in _rows(batches):
        _, passed, hashes = sieve(lang, words, ids)
        at = np.flatnonzero((passed[-1] & _ahead(passed[-1], 1))[: len(ids) - tail])
        if len(at):
            held.append(np.unique(hashes[at] >> np.uint64(32 - bits), return_counts=True))
            size += len(held[-1][0])
        if size > 2 * TASK_HASHES:
            held = [combined()]
            size = len(held[0][0])
            if size > TASK_HASHES:
                yield from flushed(*held[0])
                held, size = [], 0
    if held:
        yield from flushed(*combined())


def _frequent_keys(table: pa.Table, least: int) -> pa.Table:
    """The keys of a part whose counts add up to ``least``."""
    keys = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("keys").to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()])
    order = np.argsort(keys)
    keys = keys[order]
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    many = keys[edges][np.add.reduceat(counts[order].astype(np.int64), edges) >= min(least, 255)]
    return pa.table({"key": pa.array(table.column("part")[0].as_py() << 32 | many.astype(np.int64))})


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray, int]]:
    for batch in batches:
        for i in range(batch.num_rows):
            words = batch.column(1)[i].values.cast(pa.binary()).to_pylist()
            ids = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
            yield batch.column(0)[i].as_py(), words, ids, batch.column(3)[i].as_py()


class _Counter:
    """Counts the phrases of a task in tries and yields sorted runs."""

    def __init__(self, levels: Sequence[tuple[bytes, int]], burst: int, limit: int):
        self.sieve, self.burst, self.limit = _Sieve(levels), burst, limit
        self.tries: dict[str, tuple[HatTrie, _Numbers]] = {}

    def add(self, lang: str, words: list[bytes], ids: np.ndarray, tail: int) -> Iterator[pa.RecordBatch]:
        frequent, (_, pairs, triples, *more), _ = self.sieve(lang, words, ids)
        quads = more[0] if more else triples & _ahead(triples, 1)
        trie, numbers = self.tries.setdefault(lang, (HatTrie(self.burst), _Numbers()))
        if len(numbers) + len(words) >= 1 << ID_BITS:  # ids of a trie run out: start anew
            yield from self._spill(lang, 1.0)
            trie, numbers = self.tries[lang] = (HatTrie(self.burst), _Numbers())
        own = np.zeros(len(words) + 1, np.int64)
        for k in np.flatnonzero(frequent).tolist():
            own[k + 1] = numbers[words[k]]
        word = np.concatenate([own[ids], np.zeros(LONGEST, np.int64)])
        at = np.flatnonzero(pairs[: len(ids) - tail])
        third = np.where(triples[at], word[at + 2], 0)
        fourth = np.where(quads[at], word[at + 3], 0)
        first, rest = word[at], word[at + 1] << (2 * ID_BITS) | third << ID_BITS | fourth
        order = np.lexsort((rest, first))
        first, rest = first[order], rest[order]
        if len(first):
            edge = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])]))
            trie.add(first[edge], rest[edge], np.diff(np.append(edge, len(first))))
        if sum(t.entries for t, _ in self.tries.values()) > self.limit:
            yield from self._spill(max(self.tries, key=lambda k: self.tries[k][0].entries), 0.5)

    def _spill(self, lang: str, share: float) -> Iterator[pa.RecordBatch]:
        """Whole subtrees as one sorted run: by first words, then by the words that follow. Each phrase of two to four
        words is one row; a window counts for its first two and its first three words as well.
        """
        trie, numbers = self.tries[lang]
        heads = trie.largest(share)
        if not heads:
            return
        first, rest, n = _with_prefixes(*trie.take(heads))
        low = (1 << ID_BITS) - 1
        ids = [first, rest >> (2 * ID_BITS), rest >> ID_BITS & low, rest & low]
        names = [b"", *numbers]
        rank = np.empty(len(names), np.int64)
        rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        order = np.lexsort([rank[x] for x in reversed(ids)])
        words = pa.array(names, pa.binary()).cast(pa.string())
        for start in range(0, len(order), RUN_ROWS):
            own = order[start : start + RUN_ROWS]
            parts = [words.take(pa.array(x[own])) for x in ids]
            phrase = parts[0]
            for k in (1, 2, 3):  # words that are missing stand at the end, as number 0
                more = pa.array(ids[k][own] > 0)
                if k > 1 and not pc.any(more).as_py():
                    break
                phrase = pc.if_else(more, pc.binary_join_element_wise(phrase, parts[k], " "), phrase)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own)), parts[0], phrase, pa.array(n[own])], names=["lang", "first", "phrase", "n"]
            )

    def close(self) -> Iterator[pa.RecordBatch]:
        for lang in list(self.tries):
            yield from self._spill(lang, 1.0)


def _with_prefixes(first: np.ndarray, rest: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the phrases that windows of different words begin with, from the longest to pairs."""
    out = []
    for bits in (0, ID_BITS, 2 * ID_BITS):
        cut_off = rest >> bits << bits
        at = np.flatnonzero(rest >> bits & ((1 << ID_BITS) - 1))  # windows as long as that
        head, tail, own = first[at], cut_off[at], n[at]
        order = np.lexsort((tail, head))
        head, tail, own = head[order], tail[order], own[order]
        edges = np.flatnonzero(np.concatenate([[True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])])[: len(at)])
        if len(at):
            out.append((head[edges], tail[edges], np.add.reduceat(own, edges)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _blocks(run: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """A run as one row for each part that has any of its phrases."""
    phrases = run.column("phrase")
    part = (_hashes(phrases.cast(pa.binary()).to_pylist(), 0) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    edges, at = pa.array(np.append(starts, len(part)), pa.int32()), pa.array(order)
    lists = [pa.ListArray.from_arrays(edges, x.take(at)) for x in (phrases, run.column("n"))]
    return pa.RecordBatch.from_arrays(
        [run.column("lang").slice(0, len(starts)), pa.array(part[starts]), *lists], names=["lang", "part", "phrases", "counts"]
    )


def _runs(batches: Iterator[pa.RecordBatch], levels: Sequence[tuple[bytes, int]], burst: int, limit: int, parts: int) -> Iterator[pa.RecordBatch]:
    counter = _Counter(levels, burst, limit)
    for row in _rows(batches):
        for run in counter.add(*row):
            yield _blocks(run, parts)
    for run in counter.close():
        yield _blocks(run, parts)


def _summed(blocks: pa.Table, least: int) -> pa.Table:
    """The phrases of a part whose counts add up to ``least``."""
    flat = pa.table({"phrase": pc.list_flatten(blocks.column("phrases")), "n": pc.list_flatten(blocks.column("counts"))})
    sums = flat.group_by("phrase").aggregate([("n", "sum")])
    many = sums.filter(pc.greater_equal(sums.column("n_sum"), least))
    langs = pa.array([blocks.column("lang")[0].as_py()] * len(many), pa.string())
    return pa.table({"lang": langs, "phrase": many.column("phrase"), "n": many.column("n_sum")})


def _bitmap(keys: DataFrame, most: int) -> bytes:
    """Bits at the low bits of (key); at most ``most`` of them reach the driver."""
    bits = min(most, max(1 << 15, 1 << (BITS_EACH * max(1, keys.count()) - 1).bit_length()))
    slot = F.col("key").bitwiseAND(F.lit(bits - 1)) + 1
    rows = keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    out = bytearray(bits // 8)
    for r in rows.toLocalIterator():
        start = (r["bucket"] - 1) * 4096
        own = bytes(r["bits"])[: len(out) - start]
        out[start : start + len(own)] = own
    return bytes(out)


class _Levels:
    """The bitmaps so far. Each is sent to an executor once and read by its tasks, so that no step carries copies of all."""

    def __init__(self, spark: SparkSession):
        self.spark, self.sent = spark, []

    def add(self, bitmap: bytes, shift: int) -> None:
        self.sent.append((self.spark.sparkContext.broadcast(bitmap), shift))

    def reader(self) -> Callable[[], list[tuple[bytes, int]]]:
        """What a task calls for the bitmaps with the low bits that each leaves out."""
        sent = list(self.sent)
        return lambda: [(bitmap.value, shift) for bitmap, shift in sent]

    def discard(self) -> None:
        for bitmap, _ in self.sent:
            bitmap.destroy()


@contextmanager
def _sent_levels(spark: SparkSession) -> Iterator[_Levels]:
    levels = _Levels(spark)
    try:
        yield levels
    finally:
        levels.discard()


def _next_level(encoded: DataFrame, levels: Callable[[], list[tuple[bytes, int]]], least: int, bits: int, most: int) -> tuple[bytes, int]:
    """The bitmap of phrases one word longer than the last level has, and how many low bits of a hash it leaves out."""
    sifted = encoded.mapInArrow(lambda it: _sift(it, levels(), bits), "part long, keys binary, counts binary")
    keys = sifted.groupBy("part").applyInArrow(lambda t: _frequent_keys(t, least), "key long")
    return _bitmap(cut(keys, "frequent-keys"), most), 32 - bits


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of the frequent phrases of all runs, merged per part."""
    return runs.groupBy("lang", "part").applyInArrow(lambda t: _summed(t, least), "lang string, phrase string, n long")


def phrase_counts(
    docs: DataFrame,
    least: int = 30,
    text_col: str = "text",
    lang_col: str = "lang",
    chunk_words: int = CHUNK_WORDS,
    burst: int = BURST,
    trie_entries: int = TRIE_ENTRIES,
    filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, phrase, size, n) of one to four words, and (lang, total) of all words.

    Text is lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and
    tabs; a phrase lies in a piece. A null lang is ``und``; a null or empty text has no words. Repeated rows
    count each. Other columns are not read, so no name can clash; empty tables give empty results. A piece
    of any length is cut into chunks that see what follows, so nothing is lost at their ends.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    # Rows of megabytes: neither a batch nor a row group may gather as many of them as a file has.
    with arrow_batches(spark, BATCH_BYTES), _sent_levels(spark) as levels:
        encoded = cut(
            texts.mapInArrow(
                lambda it: _encode(it, chunk_words),
                "lang string, words array<string>, counts array<long>, ids array<int>, tail int",
            ),
            "encoded-texts",
            **{"parquet.block.row.count.limit": str(GROUP_ROWS)},
        )
        each = encoded.select("lang", F.inline(F.arrays_zip("words", "counts"))).select(
            "lang", F.col("words").alias("phrase"), F.col("counts").alias("n")
        )
        totals = cut(each.groupBy("lang").agg(F.sum("n").alias("total")), "word-totals")
        words = cut(each.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "frequent-words")
        narrow = encoded.select("lang", "words", "ids", "tail")
        places = encoded.agg(F.sum(F.size("ids"))).first()[0] or 0
        bits = min(31, max(1, places // PART_HASHES).bit_length())
        levels.add(_bitmap(words.select(F.xxhash64("lang", "phrase").alias("key")), filter_bits), 0)
        for _ in range(LONGEST - 1):  # pairs, triples, quadruples
            levels.add(*_next_level(narrow, levels.reader(), least, bits, filter_bits))
        parts, known = max(LEAST_PARTS, places // PART_WORDS), levels.reader()
        runs = narrow.mapInArrow(lambda it: _runs(it, known(), burst, trie_entries, parts), BLOCKS)
        longer = cut(_merged(runs, least), "frequent-phrases")
    found = words.unionByName(longer)
    return found.withColumn("size", F.size(F.split("phrase", " "))), totals


def _part(start: Column | int, words: Column | int) -> Column:
    return F.array_join(F.slice("words", start, words), " ")


def collocations(
    docs: DataFrame, least: int = 30, cover: int = 80, top: int = 2000, scale: int = 2_000_000, **options
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of ``a`` occurrences, cut into two parts with ``l`` and ``r``, scores ``scale * a / (l + r)``,
    rounded down; its lowest-scoring cut counts, the first one of equal ones. Phrases inside of a longer
    frequent one with at least ``cover`` per cent of their occurrences are left out. Order: score and ``a``
    descending, phrase by bytes. ``options`` go to ``phrase_counts``, which states what nulls and empties give.
    """
    counts, totals = phrase_counts(docs, least, **options)
    long_ones = counts.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.array(
            F.struct(k.alias("k"), F.lit("l").alias("side"), _part(1, k).alias("part")),
            F.struct(k.alias("k"), F.lit("r").alias("side"), _part(k + 1, F.col("size") - k).alias("part")),
        ),
    )
    asked = long_ones.select("lang", "phrase", F.col("n").alias("a"), F.inline(F.flatten(cuts)))
    known = counts.select("lang", F.col("phrase").alias("part"), "n")
    answered = asked.join(known, ["lang", "part"])
    one_cut = answered.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("n"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("n"))).alias("r")
    )
    # Decimals, as the product may pass 64 bits; div gives whole numbers.
    score = F.expr(f"(cast(a as decimal(19,0)) * cast({scale} as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    scored = one_cut.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    spans = [(size, start) for size in range(2, LONGEST) for start in range(1, LONGEST - size + 2)]
    inner = F.array(*(F.when(F.col("size") >= start + size - 1, F.when(F.col("size") > size, _part(start, size))) for size, start in spans))
    covered = long_ones.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "n").where("phrase is not null")
    widest = covered.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    free = scored.join(widest, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(20,0)") < cover * F.col("a").cast("decimal(20,0)"))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    flat = free.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # First the best of each share of a language, so that no task sorts all phrases of one.
    salted = flat.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
