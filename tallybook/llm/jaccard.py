"""Jaccard join on word shingles, exact, by a size-aware heavy-light plan.

Small sets: two similar sets share a subset of a size that follows from theirs. All such subsets are
enumerated, and sets that share one are linked. Large sets: inverted lists of rare shingles. A set of n
shingles needs only its first n - ceil(t n) + 1 shingles in the lists, in any order that all sets share;
rarest first keeps the lists short, and shingles of one document alone need no list. Members of a list
are compared in full. The size below which a set is small follows from the cost of both ways.

The rare shingles are looked for in a fixed part of the universe of shingles, chosen by hash, that still
holds more than the needed number of each set's shingles; only this part is counted. Sets that have too
few there take all of theirs. The order is: that part first, then rarer first, then by hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import connected, cut, free_name, with_row

MASK = (1 << 64) - 1
#: Sets up to this size emit all shingles, so that either way is open to them.
SMALLEST_LARGE = 64
#: Members of a list that one task compares; longer lists are compared in chunks and pairs of chunks.
CHUNK = 1024
#: Members of a list that stand in each of its chunks, so that chunks meet.
PIVOTS = 32
#: Shingles that a chunk holds, about, and that a call compares: 8 bytes each.
CHUNK_SHINGLES, CALL_SHINGLES = 1 << 21, 1 << 20
#: Words whose hashes a task keeps, and the longest of them.
CACHED_WORDS, CACHED_BYTES = 250_000, 64
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """Sets of ``width``-word shingles link when percent * union <= 100 * intersection."""

    width: int = 5
    percent: int = 80

    def needed(self, a: int, b: int) -> int:
        """Smallest intersection that links sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def least(self, n: int) -> int:
        """Size of the smallest set that can link with one of n."""
        return -(-self.percent * n // 100)

    def prefix(self, n: int) -> int:
        return n - self.least(n) + 1

    @property
    def share(self) -> float:
        """Part of the universe in which rare shingles are looked for."""
        return min(1.0, 2 * (1 - self.percent / 100) + 0.05)

    def subset_sizes(self, n: int, limit: int) -> Iterator[tuple[int, int, int]]:
        """(smaller size, larger size, shared size) of the pairs that a set of n can be in, up to ``limit``."""
        for s in range(max(1, self.least(n)), n + 1):
            yield s, n, self.needed(s, n)
        for s in range(n + 1, limit + 1):
            if self.least(s) > n:
                break
            yield n, s, self.needed(n, s)

    def subset_cost(self, n: int, limit: int) -> int:
        return sum(math.comb(n, c) for _, _, c in self.subset_sizes(n, limit))


class _Hashes(dict):
    """Word -> hash, for a bounded number of bytes: long words are not kept."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= CACHED_BYTES:
            if len(self) > CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE_BYTES`` of text, so that few texts are Python objects at a time."""
    step = max(1, batch.num_rows * SLICE_BYTES // max(SLICE_BYTES, batch.column(text).nbytes))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


_hashes = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than ``width`` make one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mix(total ^ hashes[k : len(hashes) - width + 1 + k]) + np.uint64(0x9E3779B97F4A7C15)
    return np.unique(total)


def _sets(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    cut_at = np.uint64(min(MASK, int(rule.share * 2**64)))
    for batch in (part for whole in batches for part in _slices(whole, 1)):
        ids, n, front, high, low, keys, offsets = batch.column(0), [], [], [], [], [], [0]
        for text in batch.column(1).to_pylist():
            own = shingles(text, rule.width)
            part = own[own < cut_at]
            data = own.tobytes()
            n.append(len(own))
            front.append(len(part))
            high.append(xxhash.xxh64_intdigest(data, 1) - 2**63)
            low.append(xxhash.xxh64_intdigest(data, 2) - 2**63)
            whole = len(own) <= SMALLEST_LARGE or len(part) < rule.prefix(len(own))
            keys.append(own if whole else part)
            offsets.append(offsets[-1] + len(keys[-1]))
        flat = np.concatenate([np.empty(0, np.uint64), *keys]).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array(x, t) for x, t in ((n, pa.int32()), (front, pa.int32()), (high, pa.int64()), (low, pa.int64()))), lists],
            names=["id", "n", "front", "high", "low", "keys"],
        )
    _hashes.clear()


def _subsets(batches: Iterator[pa.RecordBatch], rule: Rule, limit: int) -> Iterator[pa.RecordBatch]:
    """Keys of the shared subsets that a small set can have with another, as sums of what they leave out."""
    for batch in batches:
        out: dict[str, list] = {"id": [], "smaller": [], "high": [], "low": []}
        for doc, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.array(keys, np.int64).view(np.uint64)
            sums = own, _mix(own ^ np.uint64(0x5851F42D4C957F2D))
            n = len(own)
            for s, larger, c in rule.subset_sizes(n, limit):
                left_out = np.array(list(combinations(range(n), n - c)), int).reshape(math.comb(n, c), n - c)
                tag = np.uint64((s << 40 | larger << 20 | c) & MASK)
                for name, x in zip(("high", "low"), sums, strict=True):
                    with np.errstate(over="ignore"):
                        kept = x.sum(dtype=np.uint64) - x[left_out].sum(axis=1, dtype=np.uint64)
                        out[name].append(_mix(_mix(kept) ^ tag).view(np.int64))
                out["id"].append(np.full(len(left_out), doc, np.int64))
                out["smaller"].append(np.full(len(left_out), s == n, bool))
        yield pa.RecordBatch.from_pydict(
            {k: np.concatenate([np.empty(0, bool if k == "smaller" else np.int64), *v]) for k, v in out.items()}
        )


def _tokens(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch, 1):
            sets = [shingles(text, rule.width) for text in part.column(1).to_pylist()]
            n = pa.array([len(x) for x in sets], pa.int32())
            packed = pa.array([x.tobytes() for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), n, packed], names=["id", "n", "tokens"])
    _hashes.clear()


def smallest_reachable(linked: np.ndarray) -> np.ndarray:
    """Smallest index that each row of a symmetric matrix can reach."""
    np.fill_diagonal(linked, True)
    least, seen = np.arange(len(linked)), None
    while seen is None or (least != seen).any():
        seen = least
        least = np.where(linked, seen[None, :], len(linked)).min(axis=1)
        least = least[least]
    return least


def ties(ids: np.ndarray, sets: list[np.ndarray], rule: Rule, label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(member, smallest member) for members that links connect; exact, one product of 0/1 matrices.

    With ``label``, a list whose members all have the same label has nothing to add.
    """
    if len(ids) < 2 or (label is not None and len(set(label.tolist())) < 2):
        return []
    order = np.argsort(ids, kind="stable")
    ids, sets = ids[order], [sets[i] for i in order]
    n = np.array([len(x) for x in sets])
    member = np.repeat(np.arange(len(ids)), n)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[token] > 1
    _, column = np.unique(token[shared], return_inverse=True)
    member = member[shared]
    both = np.zeros((len(ids), len(ids)), np.float32)
    width = column.max() + 1 if len(column) else 0
    by = np.argsort(column, kind="stable")
    member, column = member[by], column[by]
    step = max(256, (16 << 20) // (4 * len(ids)))
    for start in range(0, width, step):
        a, b = np.searchsorted(column, [start, start + step])
        slab = np.zeros((len(ids), min(step, width - start)), np.float32)
        slab[member[a:b], column[a:b] - start] = 1
        both += slab @ slab.T
    linked = (100 + rule.percent) * both.astype(np.int64) >= rule.percent * (n[:, None] + n[None, :])
    least = smallest_reachable(linked)
    return [(int(ids[i]), int(ids[j])) for i, j in enumerate(least) if ids[i] != ids[j]]


def _compare(table: pa.Table, rule: Rule) -> pa.Table:
    """The ties of every list in a group of lists."""
    out: list[tuple[int, int]] = []
    lists = table.column("list").to_numpy()
    order = np.argsort(lists, kind="stable")
    ids = table.column("id").to_numpy()[order]
    tokens = table.column("tokens").to_pylist()
    label = table.column("label").to_numpy()[order] if "label" in table.column_names else None
    for own in np.split(np.arange(len(order)), np.flatnonzero(np.diff(lists[order])) + 1):
        sets = [np.frombuffer(tokens[order[i]], np.uint64) for i in own]
        out += ties(ids[own], sets, rule, None if label is None else label[own])
    a, b = zip(*out, strict=True) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _boundary(sets: DataFrame, rule: Rule) -> int:
    """Largest size of a small set: the least cost of subsets up to it and of shingles from there on."""
    sizes = sets.where(F.col("n").between(1, SMALLEST_LARGE)).groupBy("n").count().collect()
    have = {r["n"]: r["count"] for r in sizes}
    best, least = 0, None
    for limit in range(0, SMALLEST_LARGE // 2):
        # A shingle is moved to be counted, moved to meet its count, and some again into a list.
        cost = sum(c * rule.subset_cost(n, limit) for n, c in have.items() if n <= limit)
        cost += sum(3 * c * n for n, c in have.items() if n >= rule.least(limit + 1))
        if least is None or cost < least:
            best, least = limit, cost
        if rule.subset_cost(limit + 1, limit + 1) > 20_000:
            break
    return best


def _in_part(token: Column, rule: Rule) -> Column:
    """Whether a shingle lies in the part of the universe that is counted, as unsigned numbers."""
    last = min(MASK, int(rule.share * 2**64)) - 2**63
    return token.bitwiseXOR(F.lit(-(2**63))) < F.lit(last)


def _place(chunks: Column) -> Column:
    return F.pmod(F.xxhash64("id"), chunks).cast("int")


def _feasible(table: pa.Table, rule: Rule) -> pa.Table:
    """Of each list, the sets of members that sizes and places leave together, as (list, id, size).

    At the first shingle that two sets share, at places a and b of sets of m and n, they can share no more
    than m - a and n - b. Equal sets of members get equal numbers, so they are compared once.
    """
    key, ids, n, at = (table.column(c).to_numpy() for c in ("key", "id", "n", "at"))
    order = np.lexsort((ids, key))
    lists, members, sizes = [], [], []
    for own in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
        room = (n[own] - at[own]).astype(np.int64)
        needed = -(-rule.percent * (n[own][:, None] + n[own][None, :]).astype(np.int64) // (100 + rule.percent))
        label = smallest_reachable(np.minimum(room[:, None], room[None, :]) >= needed)
        for first in np.unique(label):
            group = np.unique(ids[own[label == first]])
            if len(group) > 1:
                lists += [xxhash.xxh64_intdigest(group.tobytes()) - 2**63] * len(group)
                members += group.tolist()
                sizes += [len(group)] * len(group)
    return pa.table({"list": pa.array(lists, pa.int64()), "id": pa.array(members, pa.int64()), "size": pa.array(sizes, pa.int32())})


def _member_lists(entries: DataFrame, rule: Rule) -> DataFrame:
    """(list, id, size): what is to be compared within a list, or a chunk of one, each set of members once."""
    pivot = F.pmod(F.xxhash64("id", F.lit(7)), F.ceil(F.col("length") / PIVOTS)) == 0
    places = F.when(
        (F.col("chunks") > 1) & pivot, F.sequence(F.lit(0), F.col("chunks") - 1)
    ).otherwise(F.array(_place(F.col("chunks"))))
    placed = entries.select("length", "id", "n", "at", "token", F.explode(places).alias("place"))
    calls = max(1, entries.count() // 20_000)
    key = F.xxhash64("token", "place")
    call = F.when(F.col("length") >= 64, key).otherwise(F.pmod(key, F.lit(calls)))
    sent = placed.select(key.alias("key"), call.alias("call"), "id", "n", "at")
    return sent.groupBy("call").applyInArrow(
        lambda t: _feasible(t, rule), "list long, id long, size int"
    ).distinct()


def _joined(lists: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """The same comparisons with fewer copies of each set: lists that overlap become one, up to ``chunk`` members.

    Lists with the same smallest member, or with members that share such lists, are put together. Where that
    gives more members, the lists come second, as they are.
    """
    first = cut(lists.groupBy("list").agg(F.min("id").alias("first")), "list-firsts")
    near = cut(lists.join(first, "list").groupBy("id").agg(F.min("first").alias("near")), "near-firsts")
    names = cut(lists.join(near, "id").groupBy("list").agg(F.min("near").alias("part")), "list-parts")
    members = cut(lists.join(names, "list").select("part", "id").distinct(), "part-members")
    sizes = cut(members.groupBy("part").agg(F.count("*").cast("int").alias("members")), "part-sizes")
    whole = members.join(sizes.where(F.col("members") <= chunk), "part").select(
        F.col("part").alias("list"), "id", F.col("members").alias("size")
    )
    wide = names.join(sizes.where(F.col("members") > chunk), "part", "left_semi").select("list")
    return cut(whole, "joined-lists"), cut(lists.join(wide, "list", "left_semi"), "wide-lists")


def _regrouped(parts: DataFrame, ties: DataFrame) -> DataFrame:
    """(node, component) after ``ties`` between parts, of which only those that still are apart are followed."""
    label = parts.select("node", "component")
    ends = ties.join(label.withColumnRenamed("node", "a").withColumnRenamed("component", "la"), "a", "left")
    ends = ends.join(label.withColumnRenamed("node", "b").withColumnRenamed("component", "lb"), "b", "left")
    ends = ends.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
    apart = cut(ends.where("la <> lb").select("la", "lb").distinct(), "ties-between-parts")
    if apart.isEmpty():
        return parts
    moved = connected(apart, "la", "lb").select(F.col("node").alias("component"), F.col("component").alias("to"))
    moved = cut(moved, "moved-parts")
    known = label.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    alone = moved.join(label.select(F.col("node").alias("component")), "component", "left_anti")
    return cut(known.unionByName(alone.select(F.col("component").alias("node"), F.col("to").alias("component"))), "parts")


def _largest(wide: DataFrame) -> DataFrame:
    """Of the lists of large parts, those that are the largest one of some member."""
    best = wide.groupBy("id").agg(F.max(F.struct("size", "list"))["list"].alias("list"))
    return best.select("list").distinct()


def _open(members: DataFrame, key: str, parts: DataFrame, name: str) -> DataFrame:
    """The rows of ``members`` whose ``key`` has members in several parts, with the part of each id."""
    labelled = cut(
        members.join(parts.select(F.col("node").alias("id"), "component"), "id", "left")
        .withColumn("label", F.coalesce("component", "id")).drop("component"),
        name,
    )
    several = labelled.groupBy(key).agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b")
    return labelled.join(several.select(key), key, "left_semi")


def _across(entries: DataFrame, parts: DataFrame, rule: Rule) -> DataFrame:
    """Of pairs of chunks of the lists that are not connected yet: what sizes and places leave to compare."""
    own = _open(entries, "token", parts, "labelled").withColumn("i", _place(F.col("chunks")))
    other = own.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("i <> j")
    pairs = other.select(
        F.xxhash64("token", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "id", "n", "at"
    )
    found = pairs.groupBy("key").applyInArrow(lambda t: _feasible(t, rule), "list long, id long, size int")
    return _open(found.distinct(), "list", parts, "labelled-pairs")


def _compared(lists: DataFrame, tokens: DataFrame, rule: Rule) -> DataFrame:
    """The ties (a, b) of each list; lists of few shingles share a task's call, others have their own."""
    weighed = lists.join(tokens.select("id", "n"), "id").groupBy("list").agg(F.sum("n").alias("weight"))
    weights = cut(weighed, "list-weights")
    calls = max(1, (weights.agg(F.sum("weight")).first()[0] or 0) // CALL_SHINGLES)
    heavy = F.col("weight") >= CALL_SHINGLES // 4
    call = F.when(heavy, F.col("list")).otherwise(F.pmod("list", F.lit(calls)))
    sent = lists.join(weights.select("list", call.alias("call")), "list").join(tokens.drop("n"), "id")
    return sent.groupBy("call").applyInArrow(lambda t: _compare(t, rule), "a long, b long")


def jaccard_components(
    docs: DataFrame,
    rule: Rule,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    boundary: int | None = None,
) -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles``, ``component_id``, ``set_id``.

    Documents link when the Jaccard similarity of their shingle sets reaches the rule's; ``component_id`` is
    the smallest id reachable by links, itself included, and ``set_id`` the smallest id with the same set.
    Words are split at white space and A-Z lower-cased. A text with fewer words than the width is one
    shingle; without words (or null) the set is empty and links with nothing. Shingles are compared by 64-bit
    hashes. Rows that share an id count as one document; rows without an id are returned with a null
    component and link with nothing. Other columns are left out; an empty table gives an empty result.

    Equal sets meet once, by digest, before anything else, so copies cost nothing later. No list is capped:
    one longer than ``chunk`` is compared in chunks that share a few pivots, and then, unless that has
    connected it all, in pairs of chunks. Comparisons give a forest of ties, never all pairs.
    """
    named = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sets = cut(
        named.mapInArrow(
            lambda it: _sets(it, rule), "id long, n int, front int, high long, low long, keys array<long>"
        ),
        "shingle-sets",
    )
    known = sets.where("n > 0 and id is not null")
    classes = cut(known.groupBy("n", "high", "low").agg(F.min("id").alias("set_id")), "set-classes")
    first = classes.select(F.col("set_id").alias("id")).distinct()
    limit = _boundary(known, rule) if boundary is None else boundary

    # Small sets: whoever shares a subset with the smallest id of the smaller size is linked with it.
    small = known.where(F.col("n") <= limit).join(first, "id", "left_semi").select("id", "keys")
    subsets = small.mapInArrow(
        lambda it: _subsets(it, rule, limit), "id long, smaller boolean, high long, low long"
    )
    leaders = subsets.groupBy("high", "low").agg(
        F.min(F.when(F.col("smaller"), F.col("id"))).alias("b"), F.max("id").alias("last"), F.min("id").alias("any")
    ).where("b is not null and last <> any").select("high", "low", "b")
    links = cut(
        subsets.join(leaders, ["high", "low"]).where("id <> b").select(F.col("id").alias("a"), "b").distinct(),
        "subset-links",
    )

    # Large sets: count the shingles, keep the rare front of each set, and list who has it.
    large = known.where(F.col("n") >= rule.least(limit + 1))
    each = large.select("id", "n", "front", F.explode("keys").alias("token"))
    counts = cut(each.groupBy("token").agg(F.count("*").alias("count")).where("count > 1"), "shingle-counts")
    common = each.join(counts.hint("shuffle_hash"), "token")
    entry = F.struct((~_in_part(F.col("token"), rule)).alias("later"), F.col("count"), F.col("token"))
    gathered = common.groupBy("id", "n", "front").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    prefix = F.col("n") - F.ceil(F.col("n") * rule.percent / 100).cast("int") + 1
    early = F.filter("entries", lambda e: ~e["later"])
    late = F.filter("entries", lambda e: e["later"])
    # Shingles of one document come first in either part, so they move the others back.
    before_early = F.col("front") - F.size("early")
    before_late = F.col("n") - F.size("late")
    place = F.concat(
        F.transform("early", lambda e, k: F.struct(e["token"].alias("token"), (before_early + k).alias("at"))),
        F.transform("late", lambda e, k: F.struct(e["token"].alias("token"), (before_late + k).alias("at"))),
    )
    fronts = (
        gathered.select("id", "n", "front", prefix.alias("prefix"), early.alias("early"), late.alias("late"))
        .select("id", "n", "prefix", F.explode(place).alias("entry"))
        .where("entry.at < prefix")
    )
    postings = cut(fronts.join(first, "id", "left_semi").select("id", "n", "entry.token", "entry.at"), "postings")
    lengths = cut(
        postings.groupBy("token").agg(F.count_distinct("id").alias("length"), F.sum("n").alias("shingles"))
        .where("length > 1"),
        "list-lengths",
    )
    chunks = F.greatest(F.ceil(F.col("length") / chunk), F.ceil(F.col("shingles") / CHUNK_SHINGLES)).cast("int")
    entries = postings.join(lengths.select("token", "length", chunks.alias("chunks")), "token")
    found = cut(_member_lists(entries, rule), "lists")
    whole, wide = _joined(found, chunk)
    # Members of long lists are compared across chunks too, also those that are alone in their own.
    long_ones = entries.where("chunks > 1")
    wanted = whole.select("id").unionByName(wide.select("id")).unionByName(long_ones.select("id")).distinct()
    tokens = cut(
        named.join(wanted, "id", "left_semi").mapInArrow(
            lambda it: _tokens(it, rule), "id long, n int, tokens binary"
        ),
        "set-tokens",
    )
    # Large parts first by their largest lists, which connect most of them; then what is still apart.
    largest = cut(_largest(wide), "largest-lists")
    now = whole.unionByName(wide.join(largest, "list", "left_semi"))
    links = cut(links.unionByName(_compared(now, tokens, rule)).distinct(), "links")
    parts = cut(connected(links), "parts")
    if not wide.isEmpty():
        rest = cut(_open(wide.join(largest, "list", "left_anti"), "list", parts, "labelled-lists"), "open-lists")
        if not rest.isEmpty():
            parts = _regrouped(parts, cut(_compared(rest, tokens, rule).distinct(), "more-links"))
    if not long_ones.isEmpty():
        rest = cut(_across(long_ones, parts, rule), "open-pairs")
        if not rest.isEmpty():
            parts = _regrouped(parts, cut(_compared(rest, tokens, rule).distinct(), "links-across"))
    parts = parts.select(F.col("node").alias("set_id"), F.col("component").alias("component_id"))
    ids = sets.select("id", "n", "high", "low").join(classes, ["n", "high", "low"], "left")
    return ids.join(parts, "set_id", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.coalesce("component_id", "set_id", "id").alias("component_id"),
        F.coalesce("set_id", "id").alias("set_id"),
    )


def drop_near_duplicates(docs: DataFrame, rule: Rule, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group that links connect, with all columns of ``docs`` under their own names.

    The row with the smallest id stays, null ids last. Rows are compared each, whatever their ids, so rows that
    share an id or have none lose nothing. Texts without words are linked with nothing and stay. An empty
    table stays empty.
    """
    number = free_name(docs.columns, "row_number")
    rows, unique = with_row(docs, id_col, number)
    groups = jaccard_components(rows.select(F.col(number).alias("row"), F.col(text_col).alias("text")), rule, "row", "text", **options)
    later = cut(groups.where("row <> component_id").select("row", "component_id"), "later-members")
    if not unique:  # the smallest number need not be that of the smallest id
        first = later.select(F.col("component_id").alias("row"), "component_id").distinct()
        ids = rows.select(F.col(number).alias("row"), F.col(id_col).alias("id"))
        members = cut(later.unionByName(first).join(ids, "row"), "members")
        order = F.struct(F.col("id").isNull().alias("null"), F.col("id").alias("id"), F.col("row").alias("row"))
        kept = members.groupBy("component_id").agg(F.min(order)["row"].alias("kept"))
        later = members.join(kept, "component_id").where("row <> kept")
    dropped = later.select(F.col("row").alias(number))
    return rows.join(dropped, number, "left_anti").select(*(rows[c] for c in docs.columns))
