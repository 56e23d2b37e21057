"""Scores by a class-based n-gram model in the manner of Brown clustering.

Every word of the training texts has a class, such that the classes of neighbours predict each other.
A text's probability is the product, over its words and its end, of the probability of the word's class
after the class before, and of the word within its class. Words that no training text has share one
open class; the end of a text has a class of its own, which also stands before the first word.

Words with at least ``SHARE`` of all training tokens, at most 1 / ``SHARE`` whatever the corpus, are put into classes
by exchange. Each other word then joins the class that makes its occurrences, all of them counted, the likeliest
between the classes of their neighbours: words meet by hash, and no task or driver holds them all.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import cut

#: Least share of the training tokens of a word that the exchange orders into a class; the others follow.
SHARE = 1e-4
#: Words whose counts and classes every task holds; those of all others meet them by a join.
HELD = 60_000
#: Words that join their classes together, documents whose rare words come back to them together, and tokens of either,
#: about.
PART_WORDS, PART_DOCS, PART_TOKENS = 20_000, 2_000, 2_000_000
#: Rows that leave a scoring task together.
OUT_ROWS = 100_000
CLASSES, ROUNDS = 48, 6
HELD_OUT = 1
FOLDS = 5
CHUNK = 1 << 21
#: Bytes of text whose words meet at a time, and bytes of paths whose steps do.
SLICE_BYTES, PATH_BYTES = 4 << 20, 1 << 18


def _slices(column: pa.Array, size: int) -> Iterator[pa.Array]:
    """Rows of about ``size`` bytes after the other."""
    step = max(1, len(column) * size // max(size, column.nbytes))
    for start in range(0, len(column), step):
        yield column.slice(start, step)


def _words(column: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """The words of some texts after the other, in lower case: distinct ones in the order they come in, their numbers
    in the order of the texts, and how many each text has.
    """
    for part in _slices(column, SLICE_BYTES):
        texts = pc.fill_null(part, "")
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        found = lists.flatten().cast(pa.binary())
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        # White space at the ends of a text leaves empty words.
        full = pc.not_equal(pc.binary_length(found), 0)
        if not pc.all(full).as_py():
            n = np.bincount(np.repeat(np.arange(len(n)), n), full.to_numpy(zero_copy_only=False), len(n)).astype(np.int64)
            found = found.filter(full)
        coded = found.dictionary_encode()
        yield coded.dictionary, coded.indices.to_numpy().astype(np.int64), n


def _bytes(words: pa.Array) -> list[bytes]:
    """As Python objects; no word holds a blank, and one text is split faster than many are made."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(whole, b" ")[0].as_py().split(b" ") if len(words) else []


def _with_ends(numbers: np.ndarray, n: np.ndarray, end: int) -> np.ndarray:
    return np.insert(numbers, np.cumsum(n), end)


def _kind(limit: int) -> type:
    """Of whole numbers below ``limit``; arrays of the short ones take half the memory."""
    return np.int32 if limit < 1 << 31 else np.int64


def _parts(rows: int, most: int, tokens: int) -> Column:
    """Number of parts of at most about ``most`` rows and ``PART_TOKENS`` tokens each, however long the rows are."""
    return F.lit(max(-(-rows // most), -(-tokens // PART_TOKENS), 1))


def _given_back(made: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; then the worker, which waits for other tasks, returns the memory that Arrow keeps for itself."""
    yield from made
    pa.default_memory_pool().release_unused()


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs; sorts them where they are."""
    keys.sort()
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys))


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 5; a null id counts as empty text."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)) == HELD_OUT


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "count"]
        )
        counts.clear()
        return out

    for batch in batches:
        for words, codes, _ in _words(batch.column(0)):
            for word, n in zip(_bytes(words), np.bincount(codes, minlength=len(words)).tolist(), strict=True):
                counts[word] += n
            if len(counts) > 500_000:
                yield flush()
    yield flush()


def _count_pairs(batches: Iterator[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Neighbours by number: clustered words from 0, then the open class, then the end; pairs that occur."""
    size = len(number) + 2
    get, unknown, end, kind = number.get, size - 2, size - 1, _kind(size * size)

    def counted(run: list[np.ndarray]) -> pa.RecordBatch:
        own = np.concatenate(run)
        run.clear()
        pairs = own[:-1] * kind(size)
        pairs += own[1:]
        pair, count = _counted(pairs)
        return pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(count)], names=["pair", "count"])

    run, held = [np.array([end], kind)], 0
    for batch in batches:
        for words, codes, n in _words(batch.column(0)):
            own = np.array([get(w, unknown) for w in _bytes(words)], kind)
            run.append(_with_ends(own[codes], n, end))
            held += len(run[-1])
            if held > CHUNK:
                yield counted(run)
                run, held = [np.array([end], kind)], 0
    yield counted(run)


@dataclass
class Neighbours:
    """Counts of neighbours of ``size`` words, as lists of those that occur: after each word, and before it."""

    size: int
    after: list[tuple[np.ndarray, np.ndarray]]
    before: list[tuple[np.ndarray, np.ndarray]]
    first: np.ndarray
    second: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, size: int, first: np.ndarray, second: np.ndarray, count: np.ndarray) -> Neighbours:
        def lists(by: np.ndarray, other: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
            order = np.argsort(by, kind="stable")
            edges = np.searchsorted(by[order], np.arange(size + 1))
            return [(other[order[a:b]], count[order[a:b]]) for a, b in zip(edges, edges[1:])]

        count = count.astype(float)
        return cls(size, lists(first, second), lists(second, first), first, second, count)

    def joint(self, label: np.ndarray) -> np.ndarray:
        """Counts of neighbours by class."""
        k = int(label.max()) + 1
        return np.bincount(label[self.first] * k + label[self.second], self.count, k * k).reshape(k, k)


def exchange(pairs: Neighbours, classes: int, rounds: int) -> np.ndarray:
    """Class of each word, from the counts of neighbours; the last two words keep classes of their own.

    Starts with words in turn over the classes, most frequent first, and moves one word after the other to
    the class that raises the sum of n log n over pairs of classes, less that over classes, the most.
    """
    words = pairs.size - 2
    label = np.concatenate([np.arange(words) % max(classes, 1), [classes, classes + 1]]).astype(int)
    k = classes + 2
    joint = pairs.joint(label)

    def weigh(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    for _ in range(rounds):
        moved = 0
        for w in range(words):
            old = label[w]
            (to, n_to), (by, n_by) = pairs.after[w], pairs.before[w]
            after, before = np.bincount(label[to], n_to, k), np.bincount(label[by], n_by, k)
            own = float(n_to[to == w].sum())
            after[old], before[old] = after[old] - own, before[old] - own
            joint[old] -= after
            joint[:, old] -= before
            joint[old, old] -= own
            # What changes when w goes to class c: row c, column c, and both margins.
            rows = weigh(joint[:classes] + after) - weigh(joint[:classes])
            columns = weigh(joint[:, :classes].T + before) - weigh(joint[:, :classes].T)
            at = np.arange(classes)
            both = joint[at, at]
            gain = rows.sum(1) + columns.sum(1) - rows[at, at] - columns[at, at]
            gain += weigh(both + after[:classes] + before[:classes] + own) - weigh(both)
            # Margins without w itself: its neighbours' sums stay, whatever class it joins.
            out = joint[:classes].sum(1) + before[:classes]
            into = joint[:, :classes].sum(0) + after[:classes]
            gain -= weigh(out + after.sum() + own) - weigh(out) + weigh(into + before.sum() + own) - weigh(into)
            new = int(np.argmax(gain))
            label[w] = new
            joint[new] += after
            joint[:, new] += before
            joint[new, new] += own
            moved += new != old
        if not moved:
            break
    return label


class _Codes(dict):
    """Word -> its class, or for a word without one a number from ``first``."""

    def __init__(self, classes: dict[bytes, int], first: int):
        super().__init__(classes)
        self.next = first

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.next
        self.next += 1
        return number


def _count_contexts(
    batches: Iterator[pa.RecordBatch], classes: dict[bytes, int], open_class: int, end: int
) -> Iterator[pa.RecordBatch]:
    """A row per word without a class: codes of the classes before it, and from ``k`` after it, and their counts."""
    k = end + 1

    def counted(run: list[np.ndarray], codes: _Codes) -> Iterator[pa.RecordBatch]:
        words = pa.array(list(codes)[len(classes) :], pa.binary())
        codes.clear()
        own = np.concatenate(run)
        run.clear()
        at = np.flatnonzero(own >= k)
        kind = _kind(len(words) * 2 * k)
        pairs = np.empty((2, len(at)), kind)
        pairs[:] = own[at] - own.dtype.type(k)
        pairs *= kind(2 * k)
        np.putmask(own, own >= k, open_class)
        pairs[0] += own[at - 1]
        pairs[1] += own[at + 1]
        pairs[1] += kind(k)
        del own, at
        pair, times = _counted(pairs.reshape(-1))
        edges = np.searchsorted(pair, np.arange(len(words) + 1, dtype=kind) * kind(2 * k))
        pair %= kind(2 * k)
        for a in range(0, len(words), OUT_ROWS):
            limits = edges[a : a + OUT_ROWS + 1]
            offsets = pa.array(limits - limits[0], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[limits[0] : limits[-1]], pa.int32())) for x in (pair, times)]
            yield pa.RecordBatch.from_arrays([words.slice(a, OUT_ROWS), *lists], names=["word", "codes", "times"])

    run, held, codes = [np.array([end], np.int32)], 0, _Codes(classes, k)
    for batch in batches:
        for distinct, numbers, n in _words(batch.column(0)):
            own = np.fromiter(map(codes.__getitem__, _bytes(distinct)), np.int32, len(distinct))
            run.append(_with_ends(own[numbers], n, end))
            held += len(run[-1])
            if held > CHUNK:
                yield from counted(run, codes)
                run, held, codes = [np.array([end], np.int32)], 0, _Codes(classes, k)
    yield from counted(run, codes)


def _joined(table: pa.Table, gain: np.ndarray) -> pa.Table:
    """Word, count and likeliest class of the words of a part; ``gain`` is that of one neighbour, by code and class."""
    found = table.column("word").combine_chunks().dictionary_encode()
    order = pc.sort_indices(found.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes, times = (table.column(c).combine_chunks() for c in ("codes", "times"))
    row = np.repeat(rank[found.indices.to_numpy()], pc.list_value_length(codes).to_numpy())
    at = row * len(gain) + codes.flatten().to_numpy()
    seen = np.bincount(at, times.flatten().to_numpy(), len(order) * len(gain)).reshape(len(order), len(gain))
    # Rounded, so that a tie goes to the first class whatever the last bits are.
    label = np.round(seen @ gain, 6).argmax(1)
    count = seen[:, : len(gain) // 2].sum(1).astype(np.int64)
    return pa.table({"word": found.dictionary.take(pa.array(order)), "count": count, "cls": pa.array(label, pa.int32())})


@dataclass
class Model:
    """Classes of the words that the exchange ordered, with their counts, and counts of neighbouring classes."""

    counts: dict[bytes, int]
    classes: dict[bytes, int]
    joint: np.ndarray
    open_class: int
    end_class: int

    def gain(self) -> np.ndarray:
        """Log probability that one occurrence adds: by the class before it, then by the class after it, and by its own."""
        n, k = self.open_class, self.end_class + 1
        step = _log_steps(self.joint)
        inside, members = np.zeros(n), np.zeros(n)
        for word, c in self.classes.items():
            inside[c] += self.counts[word]
            members[c] += 1
        within = np.log10(inside + 0.5 * members + 0.5)
        return np.concatenate([step[:, :n] - within, step[:n].T])


def _log_steps(joint: np.ndarray) -> np.ndarray:
    """log10 of the probability of each class after each, smoothed by one half."""
    return np.log10((joint + 0.5) / (joint.sum(1, keepdims=True) + 0.5 * len(joint)))


def fit(
    counts: DataFrame,
    training: DataFrame,
    text_col: str,
    totals: tuple[int, int, int],
    share: float = SHARE,
    classes: int = CLASSES,
) -> Model:
    """Exchange of the words with ``share`` of the tokens, from the words' counts, the training texts and (tokens,
    distinct tokens, ends). These are at most 1 / ``share`` words; ``word_classes`` adds the others.
    """
    most = counts.where(F.col("count") >= F.lit(share * totals[0])).orderBy(F.desc("count"), "word").collect()
    clustered = {bytes(r["word"]): i for i, r in enumerate(most)}
    size = len(clustered) + 2
    found = training.select(text_col).mapInArrow(lambda it: _given_back(_count_pairs(it, clustered)), "pair long, count long")
    # Pairs of clustered words that occur, a number that the bound on these words bounds.
    sums = cut(found.groupBy("pair").agg(F.sum("count").alias("count")), "class-pairs").orderBy("pair").toPandas()
    pair = sums["pair"].to_numpy(np.int64)
    pairs = Neighbours.of(size, pair // size, pair % size, sums["count"].to_numpy())
    label = exchange(pairs, min(classes, max(1, len(clustered))), ROUNDS)
    return Model(
        counts={bytes(r["word"]): r["count"] for r in most},
        classes={w: int(label[i]) for w, i in clustered.items()},
        joint=pairs.joint(label),
        open_class=int(label[-2]),
        end_class=int(label[-1]),
    )


def word_classes(
    counts: DataFrame,
    training: DataFrame,
    text_col: str,
    model: Model,
    distinct: int,
    open_rest: bool = False,
    tokens: int = 0,
) -> DataFrame:
    """(word, count, cls) of every training word: those of the model, and each other one in the class that its neighbours
    make the likeliest, or with ``open_rest`` in the open class.
    """
    spark, schema = counts.sparkSession, "word binary, count long, cls int"
    known = [(bytearray(w), model.counts[w], c) for w, c in model.classes.items()]
    core = spark.createDataFrame(known, schema)
    if open_rest:
        least = min(model.counts.values(), default=None)
        # The words of the model are all that occur as often as the rarest of them.
        rest = counts if least is None else counts.where(F.col("count") < least)
        rest = rest.select("word", "count", F.lit(model.open_class).alias("cls"))
    else:
        classes, open_class, end = model.classes, model.open_class, model.end_class
        gain = model.gain()
        found = training.select(text_col).mapInArrow(
            lambda it: _given_back(_count_contexts(it, classes, open_class, end)),
            "word binary, codes array<int>, times array<int>",
        )
        part = F.pmod(F.xxhash64("word"), _parts(distinct, PART_WORDS, tokens))
        rest = found.groupBy(part.alias("part")).applyInArrow(lambda t: _joined(t, gain), schema)
    return cut(core.unionByName(rest), "word-classes")


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` words with the largest counts, ties by word. Words that others keep out by their counts alone are
    left out first, so that tasks do not hold and send as many each.
    """
    sizes = counts.groupBy("count").agg(F.count("*").alias("words")).orderBy(F.desc("count")).limit(limit).collect()
    enough = np.flatnonzero(np.cumsum([r["words"] for r in sizes]) >= limit)
    if len(enough):
        counts = counts.where(F.col("count") >= sizes[enough[0]]["count"])
    return counts.orderBy(F.desc("count"), "word").limit(limit)


@dataclass
class Scale:
    """What scores follow from beside counts and classes: the denominators, and the end of a text."""

    within: np.ndarray  # by class
    base: float
    ends: int
    open_class: int
    end_class: int

    @property
    def kind(self) -> type:
        """Of a class in a path."""
        return np.uint8 if self.end_class < 256 else np.uint16


def _paths(batches: Iterator[pa.RecordBatch], held: dict[bytes, tuple[int, int]], scale: Scale) -> Iterator[pa.RecordBatch]:
    """A row per document with the classes of its tokens, and one per document and distinct word that the task
    doesn't hold, with its places.
    """
    number = {w: i for i, w in enumerate(held)}.get
    # The last place stands for a word that is not held.
    count = np.array([n for n, _ in held.values()] + [0])
    label = np.array([c for _, c in held.values()] + [scale.open_class])
    base, inside = np.log10((count + 0.5) / scale.base), np.log10((count + 0.5) / scale.within[label])
    base[-1] = inside[-1] = 0.0
    end_base = float(np.log10((scale.ends + 0.5) / scale.base))
    schema = pa.schema(
        [("row", pa.int64()), ("word", pa.binary()), ("at", pa.binary()), ("id", pa.string()), ("n_tokens", pa.int64()),
         ("base", pa.float64()), ("inside", pa.float64()), ("path", pa.binary())]
    )

    def made(**columns: pa.Array) -> pa.RecordBatch:
        """Rows with these columns, the others null."""
        size = len(columns["row"])
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    for batch in batches:
        done = 0
        for distinct, codes, n in _words(batch.column(2)):
            rows, ids = (batch.column(i).slice(done, len(n)) for i in (0, 1))
            done += len(n)
            own = np.array([number(w, -1) for w in _bytes(distinct)], np.int64)[codes]
            ends = np.cumsum(n)
            starts, path = ends - n, label[own].astype(scale.kind)
            spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
            end = np.array([scale.end_class], scale.kind).tobytes()
            yield made(
                row=rows,
                id=ids,
                n_tokens=pa.array(n + 1),
                base=pa.array([float(base[own[a:b]].sum()) + end_base for a, b in spans], pa.float64()),
                inside=pa.array([float(inside[own[a:b]].sum()) for a, b in spans], pa.float64()),
                path=pa.array([path[a:b].tobytes() + end for a, b in spans], pa.binary()),
            )
            rare = np.flatnonzero(own < 0)
            doc = np.repeat(np.arange(len(n)), n)[rare]
            # By document and word, and each word's places as they come.
            key = doc * max(len(distinct), 1) + codes[rare]
            order = np.argsort(key, kind="stable")
            key, place = key[order], (rare - starts[doc])[order].astype(np.int32)
            first = np.flatnonzero(np.diff(key, prepend=-1))
            edges = np.append(first, len(key)) * 4
            for a in range(0, len(first), OUT_ROWS):
                own_rows, limits = first[a : a + OUT_ROWS], edges[a : a + OUT_ROWS + 1]
                data = place[limits[0] // 4 : limits[-1] // 4].tobytes()
                offsets = (limits - limits[0]).astype(np.int32).tobytes()
                at = pa.Array.from_buffers(pa.binary(), len(own_rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                yield made(
                    row=rows.take(pa.array(key[own_rows] // len(distinct))),
                    word=distinct.take(pa.array(key[own_rows] % len(distinct))),
                    at=at,
                )


PATHS = "id string, n_tokens long, n_known long, base double, inside double, path binary"


def _completed(own: pa.Table, rare: pa.Table, scale: Scale) -> pa.Table:
    """Documents of a part with the classes, counts and probabilities of their rare words."""
    own = own.sort_by("row")
    rows, n_tokens = own.column("row").to_numpy(), own.column("n_tokens").to_numpy()
    path = np.frombuffer(b"".join(own.column("path").to_pylist()), scale.kind).copy()
    start = np.cumsum(n_tokens) - n_tokens
    at = np.frombuffer(b"".join(rare.column("at").to_pylist()), np.int32)
    times = pc.binary_length(rare.column("at")).to_numpy().astype(np.int64) // 4
    doc = np.searchsorted(rows, rare.column("of").to_numpy())
    count = pc.fill_null(rare.column("count"), 0).to_numpy()
    label = pc.fill_null(rare.column("cls"), scale.open_class).to_numpy()
    path[np.repeat(start[doc], times) + at] = np.repeat(label, times)
    # By document and place, so that sums of doubles do not depend on the order of arrival.
    order = np.lexsort((at[np.cumsum(times) - times], doc))
    doc, times, count, label = doc[order], times[order], count[order], label[order]

    def sums(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values, len(rows))

    unseen = sums(times * (count == 0)).astype(np.int64)
    edges = np.concatenate([start, [len(path)]]) * path.itemsize
    data = path.tobytes()
    return pa.table(
        {
            "id": own.column("id"),
            "n_tokens": n_tokens,
            "n_known": n_tokens - unseen - (scale.ends == 0),
            "base": own.column("base").to_numpy() + sums(times * np.log10((count + 0.5) / scale.base)),
            "inside": own.column("inside").to_numpy() + sums(times * np.log10((count + 0.5) / scale.within[label])),
            "path": pa.array([data[a:b] for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
        }
    )


def _steps(column: pa.Array, scale: Scale) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Steps from class to class of some documents after the other as numbers, and where each document starts: each
    path ends with the end, which the next one follows.
    """
    for paths in _slices(column, PATH_BYTES):
        flat = np.frombuffer(b"".join(paths.to_pylist()), scale.kind)
        steps = flat.astype(np.int64)
        steps[0] += scale.end_class * (scale.end_class + 1)
        steps[1:] += flat[:-1].astype(np.int64) * (scale.end_class + 1)
        n = pc.binary_length(paths).to_numpy().astype(np.int64) // flat.itemsize
        yield steps, np.cumsum(n) - n


def _count_steps(batches: Iterator[pa.RecordBatch], scale: Scale) -> Iterator[pa.RecordBatch]:
    size = (scale.end_class + 1) ** 2
    counts = np.zeros(size, np.int64)
    for batch in batches:
        for steps, _ in _steps(batch.column(0), scale):
            counts += np.bincount(steps, minlength=size)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["step", "count"])


def _score(batches: Iterator[pa.RecordBatch], step: np.ndarray, scale: Scale) -> Iterator[pa.RecordBatch]:
    flat = step.ravel()
    for batch in batches:
        if batch.num_rows:
            along = [np.add.reduceat(flat[steps], starts) for steps, starts in _steps(batch.column(5), scale)]
            score = pa.array(batch.column(4).to_numpy() + np.concatenate(along))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], score], names=["id", "n_tokens", "n_known", "base", "score"])


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    share: float | None = None,
    classes: int = CLASSES,
    core: float = SHARE,
) -> DataFrame:
    """One row per document: ``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` and ``perplexity`` (of ``score``, per token).

    Learns from all documents that are not held out, every word and pair of neighbours counted. Words are
    split at white space, A-Z lower-cased, and each text ends with one more token; a null text is empty, so
    only its end is scored. Logarithms are to base 10; all probabilities are smoothed by one half. Rows with
    equal ids are scored each. A null id is in no held-out fold. Other columns are left out. An empty table
    gives an empty result, and without training texts every word is unseen. Every training word is in one of
    ``classes``: those with at least ``core`` of the tokens by exchange, each other one where its neighbours' classes
    make it the likeliest. Only if ``share`` is given, words below that share are left in the open class instead.

    Counts and classes of the most frequent words go to every task, a fixed number; those of all others meet their
    words by a join, one row per document and distinct word, and go back to their documents. Steps between
    classes are then counted over all training texts.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = cut(
        training.select("text").mapInArrow(lambda it: _given_back(_count_words(it)), "word binary, count long")
        .groupBy("word").agg(F.sum("count").alias("count")),
        "word-counts",
    )
    n_docs, ends = rows.agg(F.count("*"), F.count_if(~F.col("held_out"))).first()
    seen = counts.agg(F.sum("count").alias("tokens"), F.count("*").alias("words")).first()
    totals = ((seen["tokens"] or 0) + ends, seen["words"] + (ends > 0), ends)
    model = fit(counts, training, "text", totals, core if share is None else share, classes)
    classed = word_classes(counts, training, "text", model, totals[1], share is not None, totals[0])
    within = np.zeros(model.end_class + 1)
    within[model.open_class] = 0.5  # for words not seen
    for r in classed.groupBy("cls").agg(F.sum("count").alias("inside"), F.count("*").alias("members")).collect():
        within[r["cls"]] += r["inside"] + 0.5 * r["members"]
    scale = Scale(within, totals[0] + 0.5 * (totals[1] + 1), ends, model.open_class, model.end_class)
    most = most_frequent(classed, HELD).collect()
    held = {bytes(r["word"]): (r["count"], r["cls"]) for r in most}
    # A number for each row lets rows with equal ids apart; it lives in this written table only.
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("string"), "text")
    scored = cut(
        numbered.mapInArrow(
            lambda it: _given_back(_paths(it, held, scale)),
            "row long, word binary, at binary, id string, n_tokens long, base double, inside double, path binary",
        ),
        "scored",
    )
    parts = _parts(n_docs, PART_DOCS, scored.agg(F.sum("n_tokens")).first()[0] or 0)
    rare = scored.where("word is not null").select("row", "word", "at").join(classed, "word", "left")
    rare = rare.select(F.pmod(F.xxhash64("row"), parts).alias("part"), F.col("row").alias("of"), "at", "count", "cls")
    own = scored.where("word is null").select(F.pmod(F.xxhash64("row"), parts).alias("part"), "row", "id", "n_tokens", "base", "inside", "path")
    both = own.groupBy("part").cogroup(rare.groupBy("part"))
    paths = cut(both.applyInArrow(lambda a, b: _completed(a, b, scale), PATHS), "paths")
    moves = paths.where(~held_out(F.col("id"))).select("path").mapInArrow(
        lambda it: _given_back(_count_steps(it, scale)), "step long, count long"
    )
    joint = np.zeros((model.end_class + 1) ** 2)
    for r in moves.groupBy("step").agg(F.sum("count").alias("count")).collect():
        joint[r["step"]] = r["count"]
    step = _log_steps(joint.reshape(model.end_class + 1, -1))
    out = paths.mapInArrow(
        lambda it: _given_back(_score(it, step, scale)), "id string, n_tokens long, n_known long, base double, score double"
    )
    return out.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(totals[0]).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
