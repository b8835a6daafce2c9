"""Lookup of the version that was valid at a fact's own time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_lookup(facts: DataFrame, versions: DataFrame, key: str, fact_time: str, valid_from: str,
                attrs: list[str], valid_to: str | None = None, bucket: str = "month") -> DataFrame:
    """``facts`` with ``attrs`` of the version of their key with the greatest
    ``valid_from`` not after ``fact_time`` (NULL if there is none, or if its
    ``valid_to`` has come by then).

    A join on the key with an interval condition would bring all facts of a key
    to one task and meet each with every version. Instead both sides are laid in
    one sequence per (key, ``bucket`` of time) and the last version is carried
    forward inside it, so a key that holds a third of all facts is split by time.
    What a bucket begins with comes from a table of one row per key and bucket,
    carried forward over the buckets of a key; facts meet it on the partitioning
    they already have. NULL keys and times find no version and are spread by the
    row's place instead of meeting in one task; they need no second reading.

    Facts travel as columns of their own, not as one struct: what the caller does
    not read is pruned before anything moves."""
    names = facts.columns
    flat = {c: f"_f{n}" for n, c in enumerate(names)}
    version = F.struct(*[F.col(f"`{a}`") for a in attrs], *([F.col(f"`{valid_to}`").alias("_to")] if valid_to else []))
    f = facts.select(*[F.col(f"`{c}`").alias(n) for c, n in flat.items()], F.col(f"`{key}`").alias("_key"),
                     F.col(f"`{fact_time}`").cast("timestamp_ntz").alias("_time"))
    # a place of its own for each fact without key or time, 0 for all others
    f = f.withColumn("_alone", F.when(F.col("_key").isNull() | F.col("_time").isNull(), F.monotonically_increasing_id() + 1)
                     .otherwise(F.lit(0).cast("bigint")))
    v = versions.select(version.alias("_version"), F.col(f"`{key}`").alias("_key"),
                        F.col(f"`{valid_from}`").cast("timestamp_ntz").alias("_time")).where(
        "_key is not null and _time is not null")
    # a version sorts before the facts of its own moment
    rows = v.withColumns({"_side": F.lit(0), "_alone": F.lit(0).cast("bigint")}).unionByName(
        f.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    rows = rows.withColumn("_bucket", F.date_trunc(bucket, "_time").cast("timestamp_ntz"))
    inside = Window.partitionBy("_key", "_bucket", "_alone").orderBy("_time", "_side").rowsBetween(Window.unboundedPreceding, 0)
    laid = rows.withColumn("_found", F.last("_version", ignorenulls=True).over(inside)).where("_side = 1")

    buckets = rows.where("_key is not null and _time is not null").groupBy("_key", "_bucket").agg(
        F.max_by("_version", F.when(F.col("_side") == 0, F.col("_time"))).alias("_last"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select("_key", "_bucket", F.lit(0).cast("bigint").alias("_alone"),
                             F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    found = laid.join(carried, ["_key", "_bucket", "_alone"], "left").select(
        *flat.values(), "_time", F.coalesce("_found", "_carried").alias("_version"))
    if valid_to:
        ends = F.col("_version._to").cast("timestamp_ntz")
        found = found.withColumn("_version", F.when(ends.isNull() | (F.col("_time") < ends), F.col("_version")))
    return found.select(*[F.col(n).alias(c) for c, n in flat.items()], *[F.col("_version").getField(a).alias(a) for a in attrs])
