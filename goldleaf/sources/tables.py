"""Table publishing without a table format (S12, S17, M1 hard part 1).

A table is a directory of immutable versions plus an append-only pointer:
``<root>/<table>/v=<n>-<attempt>/`` holds version n; every publish adds a
one-line file naming its version to ``_CURRENT/``, the highest one wins. A job
reads the current version, writes the next one to a new directory and only
then moves the pointer, so a plan never overwrites a path it reads and a
failed job leaves the previous version in place.

The pointer is a one-line text file written through Spark (any Hadoop
filesystem); versions are listed through Spark too, never through the
local disk, so the layout works on shared cluster storage.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_if_exists(read, path: str) -> DataFrame | None:
    """``read(path)``, or None if there is no such path. Any other failure (a
    storage error, a broken file) is raised: it must not pass for an empty
    table."""
    try:
        return read(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _pointer(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/_CURRENT"


def _current_name(spark: SparkSession, root: str, table: str) -> str | None:
    lines = read_if_exists(spark.read.text, _pointer(root, table))
    if lines is None:
        return None
    name = F.trim("value")
    number = F.split_part(name, F.lit("-"), F.lit(1)).cast("int")
    return lines.where(name != "").agg(F.max_by(name, F.struct(number, name))).first()[0]


def current_version(spark: SparkSession, root: str, table: str) -> int | None:
    name = _current_name(spark, root, table)
    return int(name.split("-")[0]) if name else None


def read_table(spark: SparkSession, root: str, table: str, empty_schema=None) -> DataFrame | None:
    name = _current_name(spark, root, table)
    if name is None:
        return spark.createDataFrame([], empty_schema) if empty_schema is not None else None
    return spark.read.parquet(f"{root.rstrip('/')}/{table}/v={name}")


def publish(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None,
            sort_within: list[str] | None = None) -> int:
    """Write ``df`` as the next version and switch the pointer to it.

    Each attempt writes its own directory (``v=<n>-<attempt id>``), so a
    job that died half-way leaves debris nobody reads, and the rerun does
    not trip over it. ``sort_within`` clusters rows by key inside each
    file, so later readers' key filters skip row groups by min/max stats."""
    spark = df.sparkSession
    v = (current_version(spark, root, table) or 0) + 1
    name = f"{v}-{uuid.uuid4().hex[:8]}"
    out = df
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{root.rstrip('/')}/{table}/v={name}")
    # append-only pointer: a new one-line file per version; the previous
    # pointer is never removed, so a crash here cannot lose the table
    spark.range(1).select(F.lit(name).alias("value")).coalesce(1).write.mode("append").text(
        _pointer(root, table))
    return v


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition
    overwrite); all other partitions of ``path`` stay as they are."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
