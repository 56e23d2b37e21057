"""Session defaults the engine's semantics rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# ANSI and UTC fix the results; the adaptive settings let one plan serve 60 thousand rows and 100 TB:
# shuffle partitions from the size of the input, which merge when small, and skewed join partitions that split.
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Longest method, in bytes, that the JVM compiles; longer ones are interpreted, row by row.
COMPILED_BYTES = ("spark.sql.codegen.hugeMethodLimit", "8000")

# Whether the files of a query's shuffles go when it ends; else they stay until the driver's JVM collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, minimum: int = 200) -> int:
    """Shuffle partitions that keep about 128 MB in each when ``input_bytes`` are shuffled."""
    return max(minimum, -(-input_bytes // TARGET_SHUFFLE_BYTES))


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder on whatever file system holds it; 0 if there is none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def table_bytes(table: DataFrame) -> int:
    """Size of a table as its plan knows it; of files, their length."""
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return min(int(str(size)), 1 << 60)


def size_shuffles(spark: SparkSession, size: int) -> None:
    """Set the session's shuffle partitions for ``size`` bytes of input."""
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(size)))


def compile_wide_stages(spark: SparkSession) -> None:
    """Let Spark run a stage operator by operator where its one method would be too long for the JVM to compile.

    Rules for many columns make such methods. Spark's own limit is far above the JVM's; one that was set stays.
    """
    name, most = COMPILED_BYTES
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, most)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Tables written inside leave no shuffle files behind."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def build_session(
    app: str = "tallybook",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Start or get a session; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes))
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
