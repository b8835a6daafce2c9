"""Date dimension."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's calendar span.
DEFAULT_START = "2019-01-01"
DEFAULT_END = "2030-12-31"


def date_attributes(d: Column) -> list[Column]:
    dow = F.dayofweek(d)  # Sunday = 1 ... Saturday = 7
    return [
        d.alias("date_key"),
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        dow.cast("bigint").alias("day_of_week"),
        dow.isin(1, 7).alias("is_weekend"),
    ]


def date_dim(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """One row per calendar day in ``[start, end]`` (4,383 rows by default).

    Days come from ``spark.range`` so generation is split over tasks.
    """
    n = (_dt.date.fromisoformat(end) - _dt.date.fromisoformat(start)).days
    days = spark.range(0, n + 1)
    d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    return days.select(*date_attributes(d))


def date_dim_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Date dimension spanning dates taken from data (a one-row frame of
    bounds): ``explode(sequence(lo, hi))``. The calendar span bounds the
    size, not the data volume."""
    d = F.col("date_key")
    return (bounds.select(F.explode(F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date")))
                          .alias("date_key"))
            .select(*date_attributes(d)))
