"""Quality by weak labels: heuristics vote, expectation-maximisation weighs them, a linear model learns.

Each heuristic votes good, bad or nothing. How often each vote is right follows, without any true label,
from how the votes agree over all documents. The posterior of a bounded sample then trains a logistic
model on hashed words, pairs of words and shapes of words, which also sees what no heuristic looks at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Features of word shapes and of words and pairs of words, the latter behind the former.
SHAPES, WORDS = 1 << 10, 1 << 13
FEATURES = SHAPES + WORDS
#: Documents that train the scorer (those with the smallest seeded hash), steps, shrinkage.
SAMPLE, STEPS, SHRINK = 8000, 150, 1e-4
SEED = 3
#: Entries of sparse rows that training widens at a time.
BLOCK = 1 << 17
#: Words whose codes a task keeps, and the longest of them; bytes of text that are Python objects at a time.
CACHED_WORDS, CACHED_BYTES, SLICE_BYTES = 250_000, 64, 4 << 20
BAD, GOOD, NONE = 0, 1, 2
#: Heuristics: (name, bad from here, good up to here, least number of words).
HEURISTICS = (
    ("symbols", 0.08, 0.03, 5),  # share of symbols other than plain punctuation among characters
    ("capitals", 0.5, 0.2, 5),  # share of capitals among letters A-Z
    ("same_as_before", 0.2, 0.05, 10),  # share of words equal to the word before
    ("most_common", 0.3, 0.15, 20),  # share of the most common word
    ("repeated_lines", 0.5, 0.1, 10),  # share of lines that stand in the text before
    ("symbol_ends", 0.2, 0.05, 5),  # share of words that end in two or more characters that are no letters or digits
    ("digits", 0.3, 0.15, 5),  # share of digits among characters
    ("sameness", 0.35, 0.25, 20),  # 1 - log(distinct words) / log(words)
    ("no_letters", 0.25, 0.15, 10),  # share of words of one character that is no letter or digit
)
_PLAIN = np.zeros(256, bool)
_PLAIN[128:] = True
for _c in b" \t\n\r\x0b\x0c.,;:'\"!?()-abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789|":
    _PLAIN[_c] = True
_MARKS = [bytes([c]) for c in range(33, 127) if not chr(c).isalnum()]
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


class _Shapes(dict):
    """Word -> hash of the word, feature of its shape (10 bits), and 1 if it ends in two characters that are no
    letters or digits.

    The shape is how a word begins and ends, its case and its length. The word is hashed without
    such an end, in lower case.
    """

    def __missing__(self, word: bytes) -> int:
        core = word.rstrip(_SYMBOLS)
        tail = word[len(core) :]
        case = 2 if len(core) > 1 and core.isupper() else core.islower()
        shape = b"%b %d %d %d %d" % (tail[:4], word[:1].isalnum(), case, min(len(core), 16), core.isalpha())
        ends = len(word) > 2 and len(tail) > 1
        own = xxhash.xxh32_intdigest((core or word).lower(), SEED)
        value = own << 11 | xxhash.xxh32_intdigest(shape, SEED) % SHAPES << 1 | ends
        if len(word) <= CACHED_BYTES:
            if len(self) > CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


_shapes = _Shapes()


def look(text: str | None) -> tuple[int, list[float], np.ndarray]:
    """Number of words, the share that each heuristic looks at, and the code of each word."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    codes = np.fromiter(map(_shapes.__getitem__, words), np.int64, n)
    if not n:
        return 0, [0.0] * len(HEURISTICS), codes
    have = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    capitals, small = int(have[65:91].sum()), int(have[97:123].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    counts = Counter(words)
    return (
        n,
        [
            float(have[~_PLAIN].sum()) / len(data),
            capitals / max(1, capitals + small),
            sum(map(bytes.__eq__, words[1:], words)) / n,
            max(counts.values()) / n,
            1 - len(set(lines)) / max(1, len(lines)),
            float((codes & 1).sum()) / n,
            float(have[48:58].sum()) / len(data),
            1 - np.log(len(counts)) / np.log(n) if n > 1 else 0.0,
            sum(counts[c] for c in _MARKS) / n,
        ],
        codes,
    )


def votes(n: int, shares: list[float]) -> str:
    """One digit per heuristic; a text without words has a bad vote from each."""
    if not n:
        return str(BAD) * len(HEURISTICS)
    out = []
    for share, (_, bad, good, least) in zip(shares, HEURISTICS, strict=True):
        out.append(NONE if n < least else BAD if share >= bad else GOOD if share <= good else NONE)
    return "".join(map(str, out))


def posteriors(patterns: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """Probability of good for each pattern of votes, by expectation-maximisation from any bad vote.

    Each labeller has its own probabilities of each vote given good and given bad.
    """
    if not patterns:
        return {}
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    vote = np.array([[int(c) for c in k] for k in keys])
    one_hot = vote[:, :, None] == np.arange(3)
    good = np.where((vote == BAD).any(axis=1), 0.01, 0.99)
    for _ in range(rounds):
        prior = (good @ n + 1) / (n.sum() + 2)
        tables = []
        for weight in (n * good, n * (1 - good)):
            seen = np.einsum("p,plv->lv", weight, one_hot) + 0.1
            tables.append(np.log(seen / seen.sum(axis=1, keepdims=True)))
        yes, no = (np.einsum("plv,lv->p", one_hot, t) for t in tables)
        yes, no = yes + np.log(prior), no + np.log(1 - prior)
        good = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
    return dict(zip(keys, good.tolist(), strict=True))


def _unit(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their counts, as a vector of length 1."""
    at, count = np.unique(features, return_counts=True)
    return at, count / np.sqrt(float((count * count).sum()) or 1)


def features(n: int, shares: list[float], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and their values: shares of word shapes, words, pairs of neighbours, and the step of each measure."""
    words = codes >> 11
    pairs = (words[:-1] * 40503 + words[1:]) * 2654435761 >> 16
    shape, times = np.unique(codes >> 1 & SHAPES - 1, return_counts=True)
    word, pair = _unit(SHAPES + words % WORDS), _unit(SHAPES + pairs % WORDS)
    steps = np.array(_steps(n, shares))
    at = np.concatenate([shape, word[0], pair[0], steps])
    return at, np.concatenate([times / max(n, 1), word[1], pair[1], np.ones(len(steps))])


def _steps(n: int, shares: list[float]) -> list[int]:
    return [*(_step(k, min(9, int(x * 20))) for k, x in enumerate(shares)), _step(-1, n.bit_length())]


@cache
def _step(measure: int, step: int) -> int:
    return xxhash.xxh32_intdigest(f"{measure} {step}", SEED) % SHAPES


@dataclass
class Scorer:
    weight: np.ndarray
    bias: float
    posterior: dict[str, float]

    def score(self, n: int, shares: list[float], codes: np.ndarray) -> float:
        at, value = features(n, shares, codes)
        total = self.bias + float(self.weight[at] @ value)
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def _blocks(rows: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Neighbouring rows with about ``BLOCK`` entries: which they are, their features, values and sizes."""
    ends = np.cumsum([len(r[0]) for r in rows])
    first = 0
    while first < len(rows):
        last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BLOCK, side="right"))
        own = rows[first : max(last, first + 1)]
        at, value = (np.concatenate([r[k] for r in own]) for k in (0, 1))
        yield slice(first, first + len(own)), at, value, np.array([len(r[0]) for r in own])
        first += len(own)


def train(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps, over sparse rows.

    ``rows`` is emptied. Its entries are kept in the types they come in and widened block by block.
    """
    weight, bias, n = np.zeros(FEATURES), 0.0, len(rows)
    if not rows:
        return weight, bias
    blocks = list(_blocks(rows))
    rows.clear()
    ahead, ahead_bias, every = weight, bias, np.arange(FEATURES)
    longest = max(float(np.add.reduceat(value.astype(float) ** 2, np.cumsum(sizes) - sizes).max()) for _, _, value, sizes in blocks)
    rate = 4 / (1 + longest)
    wrong = np.empty(n)
    for step in range(STEPS):
        slope = np.zeros(FEATURES)
        for own, at, value, sizes in blocks:
            at, value = at.astype(np.int64), value.astype(float)
            seen = np.add.reduceat(value * ahead[at], np.cumsum(sizes) - sizes)
            wrong[own] = 1 / (1 + np.exp(-np.clip(seen + ahead_bias, -50, 50))) - good[own]
            value *= np.repeat(wrong[own], sizes)
            # The sums so far come first, so they are added up in the same order however rows are blocked.
            slope = np.bincount(np.concatenate([every, at]), np.concatenate([slope, value]), FEATURES)
        new = ahead - rate * (slope / n + SHRINK * ahead)
        new_bias = ahead_bias - rate * float(wrong.mean())
        momentum = step / (step + 3)
        ahead, ahead_bias = new + momentum * (new - weight), new_bias + momentum * (new_bias - bias)
        weight, bias = new, new_bias
    return weight, bias


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, few at a time as Python objects."""
    step = max(1, len(column) * SLICE_BYTES // max(SLICE_BYTES, column.nbytes))
    for start in range(0, len(column), step):
        yield from column.slice(start, step).to_pylist()


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        counts.update(votes(*look(t)[:2]) for t in _texts(batch.column(0)))
    _shapes.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["votes", "count"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
            seen = look(text)
            at, value = features(*seen)
            yield pa.RecordBatch.from_pydict(
                {
                    "order": pa.array([key], pa.int64()),
                    "votes": [votes(*seen[:2])],
                    "features": [at.astype("<u2").tobytes()],
                    "weights": [value.astype("<f4").tobytes()],
                }
            )
    _shapes.clear()


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Scorer:
    """Weigh the heuristics over all documents, and train on those ``sample`` with the smallest seeded hash.

    The hash is of id and text, and rows alike in both train once, so the sample is the same however the rows
    are dealt; those without any vote do not train. Patterns of votes are at most 3 to the number of heuristics (19,683). The sample sends its
    features, at most ``FEATURES`` of 6 bytes a document, to the driver. Null ids and texts are hashed like
    others; without documents the scorer rests on nothing and gives one half.
    """
    texts = docs.select(F.col(text_col).alias("text"))
    counted = texts.mapInArrow(_votes, "votes string, count long").groupBy("votes").agg(F.sum("count").alias("count"))
    posterior = posteriors({r["votes"]: r["count"] for r in counted.collect()})
    # First the smallest hashes alone, so that no text is sorted; then the texts at or below the last of them.
    order = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(SEED)).alias("order")
    hashes = docs.select(order).groupBy("order").agg(F.count("*").alias("rows"))
    last = hashes.orderBy("order").limit(sample).agg(F.max("order")).first()[0]
    if last is None:
        return Scorer(np.zeros(FEATURES), 0.0, posterior)
    chosen = docs.select(order, F.col(text_col).alias("text")).where(F.col("order") <= last).dropDuplicates(["order"])
    found = chosen.mapInArrow(_sampled, "order long, votes string, features binary, weights binary").toArrow()
    # Where no heuristic votes nothing is known, so words and shapes decide there as they do elsewhere.
    own = found.column("votes").to_pylist()
    order = [i for i in np.argsort(found.column("order").to_numpy()).tolist() if own[i].strip(str(NONE))]
    # Views of what has arrived, which nothing copies before it is put into blocks.
    at, value = ([np.frombuffer(x.as_buffer(), t) for x in found.column(c)] for c, t in (("features", "<u2"), ("weights", "<f4")))
    rows = [(at[i], value[i]) for i in order]
    del found, at, value
    weight, bias = train(rows, np.array([posterior.get(own[i], 0.5) for i in order]))
    return Scorer(weight, bias, posterior)


def _score(batches: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, scores = [], []
        for text in _texts(batch.column(batch.num_columns - 1)):
            seen = look(text)
            own.append(votes(*seen[:2]))
            scores.append(scorer.score(*seen))
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-1],
                pa.array(own, pa.string()),
                pa.array([scorer.posterior.get(v, 0.5) for v in own], pa.float64()),
                pa.array(scores, pa.float64()),
            ],
            names=[*batch.schema.names[:-1], "votes", "weak_quality", "quality"],
        )
    _shapes.clear()


def quality_scores(
    docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """One row per document: ``id_col``, ``votes``, ``weak_quality``, ``quality`` and ``kept``.

    ``kept`` is whether ``quality`` reaches the threshold. A text that is null, empty or white space has a
    bad vote from every heuristic. Nothing is shuffled; rows are independent, so repeated rows and ids are
    scored each and null ids stay. Other columns are left out; an empty table stays empty.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        lambda it: _score(it, scorer), f"id {kind}, votes string, weak_quality double, quality double"
    )
    return scored.withColumn("kept", F.col("quality") >= threshold).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, scorer: Scorer, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text the scorer does not reject, as they are.

    Texts alone go to Python and scores come back; rows are filtered where they are, so columns of any name
    and number stay. Repeated rows and null ids are scored like others; a text that is null, empty or
    white space is rejected. An empty table stays empty.
    """

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([scorer.score(*look(t)) for t in _texts(part)], pa.float64())
        _shapes.clear()

    return docs.where(score(F.col(text_col)) >= threshold)
