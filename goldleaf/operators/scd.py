"""Slowly changing dimensions: type 1 (M2) and type 2 (M4 + W2).

Type 2 is built by the reference's stated intent ("insert new version,
close the old one"), not by its close-out UPDATE (which matches no row):

1. left-join the source to the *current* dimension rows on the key (J2);
   keep brand-new keys (J3) and rows whose tracked columns differ (P6,
   null-unsafe ``!=`` by default, as in the reference);
2. append them as new versions (J5: ``ON FALSE`` = always insert);
3. keep one row per (key, valid_from), the newest load winning, so no
   zero-length version exists and the surrogate key stays unique;
4. ``valid_to = lead(valid_from)`` per key, ``is_current = valid_to IS NULL``;
5. ``customer_sk = md5(key ~ valid_from)`` (F5): stable across recomputes.

Every step is a join or a window partitioned by the business key; a key
has as many rows as it has versions, so no partition grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import surrogate_key
from .merge import upsert


def scd1(dim: DataFrame, source: DataFrame, key: list[str], cols: list[str],
         keys_not_null: bool = True) -> DataFrame:
    """M2: overwrite ``cols`` on match, insert otherwise (a column-subset
    upsert). Gold tables and silver sources hold no NULL keys."""
    src = source.select(*key, *[c for c in cols if c not in key])
    return upsert(dim, src, key, update_cols=cols, insert_cols=list(key) + list(cols),
                  keys_not_null=keys_not_null)


def _tracked_change(tracked: list[str], null_safe: bool) -> Column:
    cond = F.lit(False)
    for c in tracked:
        cur, new = F.col(f"c__{c}"), F.col(f"`{c}`")
        diff = ~cur.eqNullSafe(new) if null_safe else (cur != new)
        cond = cond | F.coalesce(diff, F.lit(False))
    return cond


def scd2(dim: DataFrame, source: DataFrame, key: str, tracked: list[str], attrs: list[str],
         valid_from: str, sk_col: str, null_safe: bool = False) -> DataFrame:
    """Return the dimension after loading ``source`` (one row per key).

    ``dim`` has columns ``sk_col, key, attrs..., valid_from, valid_to,
    is_current`` (may be empty). ``source`` has ``key, attrs...`` and the
    ``valid_from`` column (the source's ``updated_at``).
    """
    cols = [key] + [a for a in attrs if a != key]
    current = dim.filter(F.col("is_current")).select(
        F.col(key).alias("c__key"), *[F.col(c).alias(f"c__{c}") for c in tracked])
    src = source.select(*cols, F.col(valid_from).alias("valid_from"))
    joined = src.join(current, src[key] == current["c__key"], "left")
    new_rows = (joined.filter(F.col("c__key").isNull() | _tracked_change(tracked, null_safe))
                .select(*cols, "valid_from", F.lit(1).alias("_load")))
    old_rows = dim.select(*cols, "valid_from", F.lit(0).alias("_load"))
    versions = old_rows.unionByName(new_rows)

    # Both windows partition by the key only, so one exchange serves both:
    # ordered by (valid_from, newest load first), a row whose predecessor
    # has the same valid_from is an older load of that version: drop it.
    by_key = Window.partitionBy(key).orderBy(F.col("valid_from"), F.col("_load").desc())
    # The same window spec again after the filter: no new exchange, no new sort.
    versions = (versions.withColumn("_prev", F.lag("valid_from").over(by_key))
                .filter(F.col("_prev").isNull() | (F.col("_prev") != F.col("valid_from")))
                .drop("_prev"))
    valid_to = F.lead("valid_from").over(by_key)
    return versions.select(
        surrogate_key([key], "valid_from").alias(sk_col), *cols, "valid_from",
        valid_to.alias("valid_to"), valid_to.isNull().alias("is_current"))


def scd2_invariants(dim: DataFrame, key: str) -> DataFrame:
    """One row of violation counts: keys without exactly one current row,
    overlapping or gapped versions. All zero for a well-formed type 2
    dimension."""
    seq = Window.partitionBy(key).orderBy("valid_from")
    steps = dim.select(key, "valid_from", "valid_to", "is_current",
                       F.lag("valid_to").over(seq).alias("prev_to"))
    per_key = steps.groupBy(key).agg(
        F.count_if(F.col("is_current")).alias("n_current"),
        F.count_if(F.col("prev_to").isNotNull() & (F.col("prev_to") != F.col("valid_from")))
        .alias("n_gap"))
    return per_key.agg(
        F.count_if(F.col("n_current") != 1).alias("keys_without_one_current"),
        F.coalesce(F.sum("n_gap"), F.lit(0)).alias("gaps_or_overlaps"))
