"""File sinks. Spark writes folders of files and commits them when all tasks are done.

A folder is published whole: it is written beside the old one, which stays readable until the new one is
done and then makes way. A run that fails leaves the old folder as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.session import dropped_shuffles

# CSV as it is read back: a header, doubled quotes, and white space kept.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder, and put it in the place of ``path`` when it is done.

    The switch is two renames, which a file system does at once whatever the size; an object store copies. If the
    second one fails, the first is undone. What a driver lost between the two has left behind stands beside
    as ``_old-…``, and is put back by the next ``publish`` before it starts.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    place = hadoop(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parent, name = place.getParent(), place.getName()
    # Names with _ in front are no data for Spark.
    new, old = (hadoop(parent, f"_{what}-{name}") for what in (f"new-{uuid4().hex}", "old"))
    if system.exists(old):
        if system.exists(place):
            system.delete(old, True)
        else:
            system.rename(old, place)
    try:
        write(new.toString())
    except BaseException:
        system.delete(new, True)
        raise
    replaced = system.exists(place)
    if replaced and not system.rename(place, old):
        raise OSError(f"cannot move {path} aside")
    if not system.rename(new, place):
        if replaced:
            system.rename(old, place)
        raise OSError(f"cannot move the new data to {path}")
    if replaced:
        system.delete(old, True)


def write_cleaned(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Replace ``path`` with the cleaned table, as Parquet or as CSV with a header. Its shuffles go when it is written."""
    options = CSV_OPTIONS if file_format == "csv" else {}
    with dropped_shuffles(df.sparkSession):
        publish(df.sparkSession, path, lambda to: df.write.options(**options).format(file_format).save(to))


def write_kpi(df: DataFrame, root: str, name: str) -> str:
    """Write a KPI as CSV in its order, to ``root/name``.

    Adaptive execution merges the sorted partitions of a small result, so it is one file; a large
    one stays in several, numbered in order, and never passes through one task.
    """
    path = f"{root}/{name}"
    publish(df.sparkSession, path, lambda to: df.write.options(**CSV_OPTIONS).csv(to))
    return path


def latest_and_archive(df: DataFrame, root: str, name: str, run_ts: str) -> None:
    """Replace the latest copy and the archive's copy under ``run_ts``; a repeated run leaves one copy.

    The archive copy is read from the latest one: both are the same, and ``df`` runs once.
    """
    latest = f"{root}/latest/{name}"
    publish(df.sparkSession, latest, lambda to: df.write.parquet(to))
    copy = df.sparkSession.read.parquet(latest).withColumn("run_ts", F.lit(run_ts))
    archive = copy.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    archive.partitionBy("run_ts").parquet(f"{root}/archive/{name}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there.

    Worth it when several jobs read the same joins. The folder is the one the cluster names in
    ``spark.checkpoint.dir``, and its rules decide how long the table stays; where none is named,
    this is an error.
    """
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("staging needs a shared folder: set spark.checkpoint.dir")
    path = f"{folder.rstrip('/')}/tallybook-{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run has written, in whatever store it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
