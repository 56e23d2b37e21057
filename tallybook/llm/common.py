"""What the operators share: patterns, the shared folder, written cuts, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of every contract, and its complement.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; an own one on a single machine."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tallybook-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/tallybook-{context.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it: later steps start there, whatever executor is lost.

    ``options`` go to the writer.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs that run inside give Python batches that end at about ``most`` bytes, whatever a row holds."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard_cuts(spark: SparkSession) -> None:
    """Remove what this application has cut, once its results are written elsewhere."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with as many ``_`` behind as it takes to differ from all others, in any case of letters."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name += "_"
    return name


def with_row(docs: DataFrame, id_col: str, name: str) -> tuple[DataFrame, bool]:
    """``docs`` with a number that no two rows share, and whether it is the id.

    It is where ids are whole numbers, unique and not null. Otherwise the rows are written once, numbered.
    ``name`` must be free.
    """
    whole = dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint")
    if whole:
        counts = docs.groupBy(id_col).agg(F.count("*").alias("n"))
        worst = counts.agg(F.max("n").alias("n"), F.max(F.col(id_col).isNull().cast("int")).alias("null")).first()
        if (worst["n"] or 0) <= 1 and not worst["null"]:
            return docs.withColumn(name, F.col(id_col).cast("bigint")), True
    return cut(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), False


def collapsed(text: Column) -> Column:
    """Runs of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("bigint")


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; ``component`` is the smallest node reachable.

    Alternates the large-star and the small-star step until the edges are stars (a logarithmic number
    of rounds). Each step sends an edge to the smallest neighbour of one end: one aggregation that
    combines per task, and one join of two written tables, whose hot keys Spark splits. Nulls link
    nothing; an empty input gives an empty result.
    """
    edges = cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "edges",
    )

    def state(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    seen = state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = cut(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "smallest")
        edges = cut(
            both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct(),
            "large-star",
        )
        smallest = cut(edges.groupBy("u").agg(F.min("v").alias("m")), "smallest")
        moved = edges.join(smallest, "u")
        edges = cut(
            moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(smallest.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct(),
            "small-star",
        )
        before, seen = seen, state(edges)
        if before == seen:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
