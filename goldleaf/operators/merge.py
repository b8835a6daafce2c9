"""Upsert without a table format.

``MERGE INTO`` is refused on plain Parquet tables, so the statement is
rebuilt as one ``full_outer`` equi-join on the key: every target row and
every source row flows through exactly once, each output row carries the
action taken (``_merge_action``: inserted / updated / unchanged / kept).

MERGE edge cases kept on purpose:
* duplicate target rows that match one source row are each updated;
* NULL keys never match: NULL-key target rows are kept, NULL-key source
  rows are inserted. Each gets a unique join salt, so a NULL "key" holding
  a third of the rows is spread over every join partition, in one pass;
* rows absent from the source are kept (no delete);
* ``update_cols`` may differ from ``insert_cols`` (fact_orders never
  rewrites ``order_id`` on update).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import read_if_exists
from .dedup import null_key_filter

ACTION = "_merge_action"
TARGET = "_target"


def _q(c: str) -> str:
    return f"`{c}`"


def assert_unique_keys(source: DataFrame, keys: list[str]) -> None:
    """M5: a target row may match at most one source row.

    Runs one small aggregate job; the driver sees at most one row.
    """
    dup = (source.filter(~null_key_filter(keys))
           .groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"MERGE source has duplicate keys {keys}: e.g. {dup[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           update_cols: list[str] | None = None, insert_cols: list[str] | None = None,
           changed: Column | None = None, hash_col: str | None = None,
           with_action: bool = False, keys_not_null: bool = False,
           unique_source: bool | None = None, with_target: bool = False) -> DataFrame:
    """Return the target after ``MERGE target USING source ON keys``.

    * ``unique_source``: the source is known to hold each key once (default:
      whenever ``keys_not_null``, as silver and gold sources do). Otherwise the
      plan itself raises when a target row matches more than one source row
      (M5): keys are counted on the partitioning that the join needs anyway, so
      there is no second scan and no second shuffle.
    * ``update_cols``: columns set from the source on match (default: all
      non-key target columns present in the source).
    * ``insert_cols``: columns filled on insert (default: all present in
      the source); the rest are NULL.
    * ``changed``: optional extra match condition over ``t.*``/``s.*``;
      ``hash_col``: update only when the two record hashes differ (M6).
    * ``keys_not_null``: both inputs are known to hold no NULL key (silver
      and gold tables never do); the join then runs on the keys alone and
      reuses a hash partitioning on the key that an input already has (e.g.
      from the latest-per-key window), saving a shuffle.
    * ``with_target``: a column ``_target`` holds the target row as it was (NULL
      for inserted rows), so one pass gives the table before and after.
    """
    tcols = target.columns
    scols = set(source.columns)
    ttypes = dict(target.dtypes)
    update_cols = [c for c in (update_cols if update_cols is not None else tcols)
                   if c not in keys and c in scols]
    insert_cols = [c for c in (insert_cols if insert_cols is not None else tcols) if c in scols]

    # NULL keys never match. Instead of a second pass for them, each NULL-key
    # row gets a unique salt ``_nk`` (positive on the target side, negative on
    # the source side, 0 for every real key): one join, NULL-key rows spread
    # over all partitions, and no NULL-key row can meet another.
    def salted(df, prefix, sign):
        cols = [f"{_q(c)} AS {_q(prefix + c)}" for c in df.columns]
        if not keys_not_null:
            nulls = " OR ".join(f"{_q(k)} IS NULL" for k in keys)
            cols.append(f"CASE WHEN {nulls} THEN (monotonically_increasing_id() + 1) * {sign} "
                        f"ELSE 0L END AS {_q(prefix + '_nk')}")
        return df.selectExpr(*cols, f"true AS {_q(prefix + 'hit')}")

    t = salted(target, "t__", 1)
    s = salted(source.select(*[_q(c) for c in tcols if c in scols]), "s__", -1)
    if unique_source is None:
        unique_source = keys_not_null
    if not unique_source:
        per_key = [F.col(_q(f"s__{k}")) for k in keys] + ([] if keys_not_null else [F.col("s___nk")])
        s = s.withColumn("_same_key", F.count(F.lit(1)).over(Window.partitionBy(*per_key)))
    on = None if keys_not_null else (F.col("t___nk") == F.col("s___nk"))
    for k in keys:  # plain equality: a NULL key never matches, as in MERGE
        cond = F.col(_q(f"t__{k}")) == F.col(_q(f"s__{k}"))
        on = cond if on is None else on & cond
    j = t.join(s, on, "full_outer")
    if not unique_source:  # a filter, so that no column pruning can lose it
        twice = F.col("t__hit") & F.col("s__hit") & (F.col("_same_key") > 1)
        text = F.concat(F.lit(f"MERGE: more than one source row matches a target row, {', '.join(keys)} = "),
                        F.concat_ws(", ", *[F.col(_q(f"t__{k}")).cast("string") for k in keys]))
        j = j.where(F.when(twice, F.raise_error(text).cast("boolean")).otherwise(True))

    # the caller's extra match condition becomes a column, so the whole
    # per-column projection below is one SQL select
    matched = "(t__hit IS NOT NULL AND s__hit IS NOT NULL)"
    do_update = matched
    if hash_col is not None:
        do_update += f" AND NOT ({_q('t__' + hash_col)} <=> {_q('s__' + hash_col)})"
    if changed is not None:
        j = j.withColumn("_changed", F.coalesce(changed, F.lit(False)))
        do_update += " AND _changed"

    exprs = []
    for c in tcols:
        typ = ttypes[c]
        tc = _q(f"t__{c}")
        sc = f"CAST({_q('s__' + c)} AS {typ})" if c in scols else f"CAST(NULL AS {typ})"
        ins = sc if (c in insert_cols or c in keys) else f"CAST(NULL AS {typ})"
        if c in update_cols:
            exprs.append(f"CASE WHEN t__hit IS NULL THEN {ins} WHEN {do_update} THEN {sc} "
                         f"ELSE {tc} END AS {_q(c)}")
        else:
            exprs.append(f"CASE WHEN t__hit IS NULL THEN {ins} ELSE {tc} END AS {_q(c)}")
    exprs.append(f"CASE WHEN t__hit IS NULL THEN 'inserted' WHEN {do_update} THEN 'updated' "
                 f"WHEN {matched} THEN 'unchanged' ELSE 'kept' END AS {ACTION}")
    if with_target:
        before = ", ".join(f"{_q('t__' + c)} AS {_q(c)}" for c in tcols)
        exprs.append(f"CASE WHEN t__hit IS NOT NULL THEN struct({before}) END AS {TARGET}")
    result = j.selectExpr(*exprs)
    return result if with_action else result.drop(ACTION)


def merge_metrics(merged_with_action: DataFrame) -> DataFrame:
    """M9: affected-row counts by action, one row (no second scan of inputs)."""
    a = F.col(ACTION)
    return merged_with_action.agg(
        F.count_if(a == "inserted").alias("rows_inserted"),
        F.count_if(a == "updated").alias("rows_updated"),
        F.count_if(a == "unchanged").alias("rows_unchanged"),
        F.count_if(a == "kept").alias("rows_kept"),
        (F.count_if(a == "inserted") + F.count_if(a == "updated")).alias("num_dml_affected_rows"),
        F.count("*").alias("rows_total"),
    )


def bounded_upsert(target: DataFrame, source: DataFrame, keys: list[str], window_col: str,
                   lower_bound: Column, **kw) -> DataFrame:
    """MERGE limited to target rows with ``window_col >= lower_bound``.

    Only that slice of the target joins (a partition filter Catalyst pushes
    into the scan); the rest passes through untouched. As in the documented
    pattern, a source row whose match lies *below* the bound is inserted as
    a second row.
    """
    want_action = kw.pop("with_action", False)
    inside = F.coalesce(F.col(_q(window_col)) >= lower_bound, F.lit(False))
    hot = target.filter(inside)
    cold = target.filter(~inside)
    merged = upsert(hot, source, keys, with_action=True, **kw)
    cold = cold.withColumn(ACTION, F.lit("kept"))
    out = merged.unionByName(cold)
    return out if want_action else out.drop(ACTION)


def _stored(spark, path: str, source: T.StructType, partition_col: str) -> DataFrame | None:
    """The table at ``path`` with all its columns in their own types (partitions
    may have gained columns at different times: footers are merged, no data is
    read), plus those that only ``source`` has."""
    found = read_if_exists(spark.read.option("mergeSchema", "true").parquet, path)
    if found is None:
        return None
    own = [source[partition_col] if f.name == partition_col else f for f in found.schema.fields]
    more = [f for f in source.fields if f.name not in found.columns]
    return spark.read.schema(T.StructType(own + more)).parquet(path)


def touched(target: DataFrame, partition_col: str, values: list) -> DataFrame:
    """The rows of ``target`` in the partitions ``values``, None included."""
    part = F.col(_q(partition_col))
    own = part.isin([v for v in values if v is not None])
    return target.where(own | part.isNull() if None in values else own)


def upsert_into_partitions(source: DataFrame, path: str, keys: list[str], partition_col: str,
                           staging: str, **kw) -> int:
    """MERGE into a Parquet table partitioned by ``partition_col``, rewriting
    only the partitions the source touches.

    Cost follows the increment, not the table: the values of the partitions that
    the source touches become a filter on the partition column, which prunes the
    target's folders before anything is read (a semi-join would not: Spark prunes
    at run time only behind a selective filter). The driver gets these values,
    one for each partition, as it has the target's list of folders anyway. Rows
    of the NULL partition are read only if the source has such rows. The merged
    rows go to ``staging`` first (a plan never overwrites a path it reads), then
    replace exactly those partitions; the others keep their files. The target
    keeps all its columns: those the source lacks stay as they are on match and
    are NULL on insert, and columns new in the source are added. The partition
    column is read with the source's type, so a value stays what it was ("01" is
    no number). A key must keep its partition value for life (e.g. the month of
    an order date); the source must hold a key once, which is checked.
    Returns the number of rewritten partitions.
    """
    spark = source.sparkSession
    assert_unique_keys(source, keys)
    part = F.col(_q(partition_col))
    values = [r[0] for r in source.select(part).distinct().collect()]
    if not values:
        return 0
    target = _stored(spark, path, source.schema, partition_col)
    if target is None:
        target = spark.createDataFrame([], source.schema)
    merged = upsert(touched(target, partition_col, values), source, keys, **{"unique_source": True, **kw})
    # rows of a partition meet before they are written, or every join task would
    # write a file for every partition; AQE cuts a large partition into several
    together = merged.hint("rebalance", part)
    together.write.mode("overwrite").partitionBy(partition_col).parquet(staging)
    staged = spark.read.schema(merged.schema).parquet(staging)
    (staged.select(*merged.columns).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    return len(values)
