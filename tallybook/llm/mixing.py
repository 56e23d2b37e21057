"""Mixing sources to target weights by a min-cost flow.

Documents are grouped by the set of sources they belong to. The flow routes each group's words to the
quotas of its sources; a first copy of a word costs nothing, a second one 1, and so on, so repeats come
last. What a group has to give is then taken from its documents in a seeded order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import cut, free_name, with_row

SEED = "mix-1"
#: Groups that the driver routes at most; more is an error, not a cut.
MAX_PATTERNS = 5000
#: Documents of a group that share a prefix of the seeded order, about.
RUN_ROWS = 5000


def water_fill(sizes: Sequence[int], weights: Sequence[float], budget: float, repeats: int) -> list[float]:
    """Shares of ``budget`` by weight that stop at ``repeats`` times a size; the rest is reshared by weight."""
    caps = [repeats * x for x in sizes]
    level, full, weight = math.inf, 0, sum(weights)
    for i in sorted(range(len(caps)), key=lambda i: (caps[i] / weights[i], i)):
        if (budget - full) / weight <= caps[i] / weights[i]:
            level = (budget - full) / weight
            break
        full, weight = full + caps[i], weight - weights[i]
    return [float(c) if c / w < level else level * w for c, w in zip(caps, weights, strict=True)]


def route(supply: Sequence[int], member: Sequence[Sequence[int]], quota: Sequence[int], repeats: int) -> list[int]:
    """Words that each group gives in a cheapest largest flow to the quotas.

    ``member[g]`` lists the sources of group ``g``. Copy k of a group's words costs k. Paths go from a group
    over a source, and back over another group that can give way, to a source with quota left; the
    cheapest copy that any path can start from is used first.
    """
    given, left = [0] * len(supply), list(quota)
    flow = [dict.fromkeys(m, 0) for m in member]
    groups_of: dict[int, list[int]] = {}
    for g, m in enumerate(member):
        for s in m:
            groups_of.setdefault(s, []).append(g)
    for copy in range(1, repeats + 1):
        for g in range(len(supply)):
            while given[g] < copy * supply[g]:
                came: dict[int, tuple[int, int | None]] = {}
                queue = [(s, g, None) for s in sorted(flow[g])]
                end = None
                for s, by, before in queue:  # grows while it is read: breadth first
                    if s in came:
                        continue
                    came[s] = (by, before)
                    if left[s] > 0:
                        end = s
                        break
                    for other in groups_of[s]:
                        if flow[other][s] > 0:
                            queue += [(t, other, s) for t in sorted(flow[other]) if t not in came]
                if end is None:
                    break
                path, s = [], end
                while s is not None:
                    path.append((s, *came[s]))
                    s = came[s][1]
                step = min([copy * supply[g] - given[g], left[end], *(flow[by][b] for _, by, b in path if b is not None)])
                for s, by, before in path:
                    flow[by][s] += step
                    if before is not None:
                        flow[by][before] -= step
                left[end] -= step
                given[g] += step
    return given


def mix(
    docs: DataFrame,
    size: Column,
    weights: Sequence[float] = (3, 1, 2),
    budget_ratio: float = 1.5,
    repeats: int = 2,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: str = SEED,
    run_rows: int = RUN_ROWS,
    whole: bool = False,
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: ``id_col``, ``size``, ``source_size``, ``target``, ``taken`` and ``pattern``.

    ``source_col`` holds a source or an array of overlapping ones. Sources in code-point order, null last,
    get ``weights`` in turn and share ``budget_ratio`` times all sizes; a target stops at ``repeats`` times its
    source's size. ``taken`` is what the mix takes of a document, repeats counted; at most one document of a
    group is taken in part, unless ``whole``: then it is taken or left, whatever is nearer. ``source_size``
    and ``target`` are sums over a document's sources. A document without any source is taken not at all.
    Sizes that are null count as 0. The order is by a hash of seed and id, so reruns agree; rows that share
    an id, or have none, are ordered by a number of theirs, so no run holds them all. Other columns are left
    out, but for ``row_col``, a number that no two rows share, if it is given. An empty table gives an empty
    result.

    Only the sums per group reach the driver. Cumulative sums go over runs of the seeded order, so the
    documents of a hot source are spread over many small runs.
    """
    spark = docs.sparkSession
    source = F.col(source_col)
    if not dict(docs.dtypes)[source_col].startswith("array"):
        source = F.array(source)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(size, F.lit(0)).cast("bigint").alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(source, F.array(F.lit(None).cast("string"))))).alias("pattern"),
        *([F.col(row_col).cast("bigint").alias("given")] if row_col else []),
    )
    rows, unique = with_row(rows, "id", "row")
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    groups = sums.limit(MAX_PATTERNS + 1).collect()
    if len(groups) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} combinations of sources; merge the rare ones first")
    groups.sort(key=lambda g: [(x is None, x or "") for x in g["pattern"]])
    sources = sorted({s for g in groups for s in g["pattern"]}, key=lambda s: (s is None, (s or "").encode()))
    at = {s: i for i, s in enumerate(sources)}
    own = [sum(g["size"] for g in groups if s in g["pattern"]) for s in sources]
    weight = [weights[i % len(weights)] for i in range(len(sources))]
    target = water_fill(own, weight, budget_ratio * sum(g["size"] for g in groups), repeats)
    given = route(
        [g["size"] for g in groups],
        [[at[s] for s in g["pattern"]] for g in groups],
        [math.floor(t + 0.5) for t in target],
        repeats,
    )
    plan = spark.createDataFrame(
        [
            (
                list(g["pattern"]),
                g["size"],
                amount,
                sum(own[at[s]] for s in g["pattern"]),
                float(sum(target[at[s]] for s in g["pattern"])),
            )
            for g, amount in zip(groups, given, strict=True)
        ],
        "pattern array<string>, group_size long, amount long, source_size long, target double",
    )
    digits = max(1, math.ceil(math.log(max(1, sum(g["rows"] for g in groups)) / run_rows + 1, 16)))
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    key = F.md5(F.concat(F.lit(seed + ":"), key) if unique else F.concat(F.lit(seed + ":"), key, F.lit(":"), F.col("row")))
    ordered = rows.withColumn("key", key).withColumn("run", F.substring("key", 1, digits))
    runs = cut(ordered.groupBy("pattern", "run").agg(F.sum("size").alias("run_size")), "run-sizes")
    runs = runs.select(
        "pattern", "run", (F.expr("sum(run_size) over (partition by pattern order by run)") - F.col("run_size")).alias("before")
    )
    # Patterns are compared as text, since a null source must meet itself.
    named = F.to_json(F.struct("pattern"), {"ignoreNullFields": "false"})
    runs = runs.join(F.broadcast(plan.withColumn("name", named).drop("pattern")), named == F.col("name")).drop("pattern")
    placed = ordered.withColumn("name", named).join(runs, ["name", "run"]).withColumn(
        "start",
        F.col("before")
        + F.expr("sum(size) over (partition by name, run order by key, id, size, row rows unbounded preceding)")
        - F.col("size"),
    )
    copies = []
    for copy in range(repeats):
        room = F.col("amount") - copy * F.col("group_size") - F.col("start")
        part = F.greatest(F.least(room, F.col("size")), F.lit(0))
        copies.append(F.when(2 * room >= F.col("size"), F.col("size")).otherwise(0) if whole else part)
    taken = sum(copies[1:], copies[0]).cast("bigint").alias("taken")
    own = [F.col("given").alias(row_col)] if row_col else []
    return placed.select(F.col("id").alias(id_col), "size", "source_size", "target", taken, "pattern", *own)


def take_copies(docs: DataFrame, mixed: DataFrame, row_col: str = "doc_id") -> DataFrame:
    """``docs`` with each row as often as the mix takes it; ``row_col`` names a row in both, a number that no two share.

    Rows meet by their number, so rows that share an id, or have none, are taken each for itself. Columns
    stay as they are, whatever their names; ``row_col`` too.
    """
    copies = F.ceil(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    other, times = (free_name(docs.columns, c) for c in ("mix_row", "mix_times"))
    wanted = mixed.select(F.col(row_col).alias(other), copies.alias(times)).where(F.col(times) > 0)
    taken = docs.join(wanted, F.col(_quoted(row_col)) == F.col(other))
    names = [F.col(_quoted(c)) for c in docs.columns]
    return taken.select(*names, F.explode(F.sequence(F.lit(1), F.col(times))).alias(times)).select(*names)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
