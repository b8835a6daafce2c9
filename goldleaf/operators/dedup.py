"""Latest row per key (W1 + P3 + P2).

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1`` written as a
window; Catalyst turns it into a *partial* ``WindowGroupLimit`` before the
shuffle, so every map task forwards at most one row per key. A key that
holds a third of the input therefore costs one row per task in the
exchange, not a third of the data in one reducer.

The order is made total: the caller's recency columns first, then every
other orderable column, so reruns pick the same row (the reference orders
by ``updated_at`` alone, and a batch shares one ``updated_at``).
Rows with a NULL key never match a MERGE; they are returned apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERABLE = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.BinaryType)


def null_key_filter(keys: list[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(f"`{k}`").isNull()
    return cond


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    bad = null_key_filter(keys)
    return df.filter(~bad), df.filter(bad)


def total_order(df: DataFrame, keys: list[str], order_by: list[Column],
                tiebreak: list[str] | None = None) -> list[Column]:
    """Caller order + descending tie-break over the remaining orderable columns."""
    if tiebreak is None:
        tiebreak = [f.name for f in df.schema.fields
                    if f.name not in keys and isinstance(f.dataType, _ORDERABLE)]
    return list(order_by) + [F.col(f"`{c}`").desc_nulls_last() for c in tiebreak]


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[Column],
                   tiebreak: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Return ``(latest, null_key_rows)``.

    ``order_by`` are Column sort expressions (e.g. ``F.col('updated_at').desc()``);
    Spark's NULL placement (ASC: first, DESC: last) is the reference's too.
    """
    good, null_keys = split_null_keys(df, keys)
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(
        *total_order(df, keys, order_by, tiebreak))
    latest = (good.withColumn("row_num", F.row_number().over(w))
              .filter(F.col("row_num") == 1).drop("row_num"))
    return latest, null_keys
