"""Equi-joins whose hot keys Spark can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "_join_key"


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left JOIN right USING (keys)``, with each side shuffled for the join.

    AQE splits a skewed partition only when both sides come straight from the
    join's own shuffle. A side that a window or an aggregate has already
    partitioned by the key is joined as it lies, and a key with a third of the
    rows then stays in one task. A second key, a hash of the first, asks for a
    partitioning that no input has yet."""
    both = [df.withColumn(_KEY, F.xxhash64(*[F.col(f"`{k}`") for k in keys])) for df in (left, right)]
    return both[0].join(both[1], [*keys, _KEY], how).drop(_KEY)
