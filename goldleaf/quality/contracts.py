"""Contract checks the reference documents without code (C8-C15, J7, W3,
P16, P17), as Spark jobs that each read their table once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import skew_join
from .checks import Check, _result_cols, rule_check

# Allowed order status steps (the order lifecycle contract).
ALLOWED_TRANSITIONS = [
    ("PENDING", "CONFIRMED"), ("CONFIRMED", "SHIPPED"), ("SHIPPED", "DELIVERED"),
    ("PENDING", "CANCELLED"), ("CONFIRMED", "CANCELLED"), ("DELIVERED", "RETURNED"),
]

# Default SLA tolerance (percent failing) per rule; the
# contracts allow 0.1 % invalid country codes and 0 % elsewhere.
SLA_THRESHOLDS = {"country_code_format": 0.1}


def cross_column_checks(entity: str, tolerance: float = 0.01) -> list[Check]:
    """One predicate per stated cross-column rule (NULL = not applicable)."""
    c = F.col
    if entity == "customers":
        return [rule_check("updated_after_created", c("updated_at") < c("created_at")),
                rule_check("signup_after_2019", c("signup_date") < F.lit("2019-01-01").cast("date")),
                rule_check("country_code_format", ~c("country_code").rlike("^[A-Z]{2}$"),
                           column="country_code")]
    if entity == "products":
        return [rule_check("cost_within_price", (c("cost_price") <= 0) | (c("cost_price") > c("unit_price"))),
                rule_check("updated_after_created", c("updated_at") < c("created_at"))]
    if entity == "orders":
        return [rule_check("shipped_after_ordered", c("shipped_date") < c("order_date")),
                rule_check("delivered_after_shipped", c("delivered_date") < c("shipped_date")),
                rule_check("updated_after_created", c("updated_at") < c("created_at"))]
    if entity == "order_items":
        return [rule_check("line_total_matches",
                           F.abs(c("line_total") - c("quantity") * c("unit_price")) > F.lit(tolerance)),
                rule_check("return_within_quantity", c("return_quantity") > c("quantity")),
                rule_check("return_reason_given",
                           (c("return_quantity") > 0) & (c("return_reason").isNull() | (c("return_reason") == "")))]
    if entity == "inventory":
        return [rule_check("available_is_on_hand_minus_reserved",
                           c("quantity_available") != c("quantity_on_hand") - c("quantity_reserved"))]
    if entity == "campaigns":
        return [rule_check("end_after_start", c("end_date") < c("start_date"))]
    if entity == "clickstream_events":
        return [rule_check("anonymous_id_when_no_customer",
                           c("customer_id").isNull() & (c("anonymous_id").isNull() | (c("anonymous_id") == ""))),
                rule_check("product_for_product_events",
                           c("event_type").isin("PRODUCT_VIEW", "ADD_TO_CART") & c("product_id").isNull()),
                rule_check("query_for_search",
                           (c("event_type") == "SEARCH") & c("search_query").isNull())]
    raise ValueError(f"no cross-column rules for {entity}")


def with_sla(results: DataFrame, thresholds: dict[str, float] | None = None,
             default: float = 0.0) -> DataFrame:
    """SLA met when ``failure_pct <= threshold`` (0 % unless stated)."""
    thresholds = dict(SLA_THRESHOLDS if thresholds is None else thresholds)
    thr = F.lit(default)
    for rule, t in thresholds.items():
        thr = F.when(F.col("rule_name") == rule, F.lit(float(t))).otherwise(thr)
    return results.withColumn("sla_threshold_pct", thr).withColumn(
        "sla_met", F.col("failure_pct") <= F.col("sla_threshold_pct"))


def foreign_key_check(child: DataFrame, fk: str, parent: DataFrame, pk: str, relation: str,
                      dataset: str, run_id: str, severity: str = "LOW",
                      checked_at: Column | None = None) -> DataFrame:
    """Orphan rows of ``child.fk`` not found in ``parent.pk``.

    The child is first pre-aggregated to one row per FK value (partial
    counts map-side), so a value carried by a third of the rows is a single
    row by the time the anti-join shuffles; the anti-join then moves only
    distinct keys (a left join, so totals and orphans come from one pass).
    NULL FKs are not orphans (nullable relations)."""
    checked_at = checked_at if checked_at is not None else F.current_timestamp()
    per_fk = child.groupBy(F.col(fk).alias("_fk")).agg(F.count("*").alias("n"))
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    looked = per_fk.join(keys, F.col("_fk") == F.col("_pk"), "left")
    orphan = F.col("_fk").isNotNull() & F.col("_pk").isNull()
    one = looked.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                     F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("failed"),
                     F.count_if(orphan).alias("orphan_keys"))
    details = F.concat(F.col("orphan_keys").cast("string"), F.lit(" unknown keys"))
    return one.select(*_result_cols(F.lit(f"fk_check_{relation}"), F.lit(fk), F.col("total"),
                                    F.col("failed"), F.lit(severity), details, dataset, relation,
                                    run_id, checked_at))


def foreign_key_checks(frames: dict[str, DataFrame], relations: list[tuple[str, str, str, str, str]], dataset: str,
                       run_id: str, severity: str = "LOW", checked_at: Column | None = None) -> DataFrame:
    """J7/C11 for many ``relations`` (name, child, fk, parent, pk) between ``frames``.

    The results of :func:`foreign_key_check`, but each table is computed once for
    all relations it is part of: a row gives one entry for every foreign key it
    holds and one for its own key where it is a parent, and one aggregate per
    parent and key (partial counts map-side, so a hot or NULL key is one row per
    task) says which keys are known and how many rows of each relation name them.
    Keys are compared as they are, so all must be of one type."""
    checked_at = checked_at if checked_at is not None else F.current_timestamp()
    parents = list(dict.fromkeys((p, pk) for _, _, _, p, pk in relations))
    places, taken = [], dict.fromkeys(parents, 0)  # a relation's parent and its number among that parent's relations
    for _, _, _, p, pk in relations:
        places.append((parents.index((p, pk)), taken[p, pk]))
        taken[p, pk] += 1
    width = max(taken.values())
    types = {frames[t].schema[c].dataType.simpleString() for _, child, fk, p, pk in relations for t, c in ((child, fk), (p, pk))}
    if len(types) > 1:
        raise ValueError(f"keys of several types: {sorted(types)}")

    def entry(slot: int, key: Column, known: bool = False, number: int | None = None) -> Column:
        return F.struct(F.lit(slot).alias("_slot"), key.alias("_key"), F.lit(known).alias("_known"),
                        *[F.lit(int(i == number)).cast("bigint").alias(f"_n{i}") for i in range(width)])

    # an entry without rows for each parent, so that relations of empty tables have their result too
    spark = next(iter(frames.values())).sparkSession
    rows = spark.range(1).select(F.inline(F.array(*[entry(s, F.lit(None).cast(min(types))) for s in range(len(parents))])))
    for name, df in frames.items():
        found = [entry(s, F.col(pk), known=True) for s, (p, pk) in enumerate(parents) if p == name]
        found += [entry(s, F.col(fk), number=n) for (_, c, fk, _, _), (s, n) in zip(relations, places) if c == name]
        if found:
            rows = rows.unionByName(df.select(F.inline(F.array(*found))))
    per_key = rows.groupBy("_slot", "_key").agg(F.max("_known").alias("_known"), *[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(width)])
    orphan = F.col("_key").isNotNull() & ~F.col("_known")
    one = per_key.groupBy("_slot").agg(*[F.struct(
        F.lit(i).alias("_number"), F.sum(f"_n{i}").alias("total"),
        F.coalesce(F.sum(F.when(orphan, F.col(f"_n{i}"))), F.lit(0)).alias("failed"),
        F.count_if(orphan & (F.col(f"_n{i}") > 0)).alias("orphan_keys")).alias(f"_r{i}") for i in range(width)])
    one = one.select("_slot", F.inline(F.array(*[f"_r{i}" for i in range(width)])))
    which = F.coalesce(*[F.when((F.col("_slot") == s) & (F.col("_number") == n), F.lit(k)) for k, (s, n) in enumerate(places)])
    one = one.withColumn("_k", which).filter(F.col("_k").isNotNull())
    name = F.get(F.array(*[F.lit(r[0]) for r in relations]), F.col("_k"))
    fk = F.get(F.array(*[F.lit(r[2]) for r in relations]), F.col("_k"))
    details = F.concat(F.col("orphan_keys").cast("string"), F.lit(" unknown keys"))
    return one.select(*_result_cols(F.concat(F.lit("fk_check_"), name), fk, F.col("total"), F.col("failed"), F.lit(severity),
                                    details, dataset, name, run_id, checked_at))


def status_transitions(history: DataFrame, key: str, status: str, order_by: str,
                       allowed=ALLOWED_TRANSITIONS, chunks: int | None = None, bucket: str = "month") -> DataFrame:
    """Steps between consecutive versions of a key that are not in
    the allowed lifecycle. Repeated equal statuses are not steps.

    NULL keys are dropped (they are not a history); exact copies of a
    version collapse map-side first (``dropDuplicates`` is a partial
    aggregate). A key may still hold a third of all *distinct* versions, so
    ``lag`` runs per (key, ``bucket`` of time), and what a bucket begins with
    comes from a table of one row per key and bucket: the last status of the
    key's bucket before. All of it is one lazy plan; the borders are dates, so
    every consumer sees the same ones. Versions without a time come first.
    ``chunks`` is accepted from earlier callers and has no effect: dates cut a
    key's history now, not a number of ranges."""
    hist = (history.filter(F.col(key).isNotNull()).dropDuplicates([key, status, order_by])
            .select(key, order_by, F.col(status).alias("to_status"), F.date_trunc(bucket, order_by).alias("_bucket")))
    inside = Window.partitionBy(key, "_bucket").orderBy(order_by, "to_status")
    steps = hist.withColumns({"_before": F.lag("to_status").over(inside), "_place": F.row_number().over(inside)})
    ends = hist.groupBy(key, "_bucket").agg(F.max(F.struct(order_by, "to_status"))["to_status"].alias("_end"))
    carried = ends.select(F.col(key).alias("_key"), F.col("_bucket").alias("_in"),
                          F.lag("_end").over(Window.partitionBy(key).orderBy("_bucket")).alias("_carried"))
    steps = steps.join(carried, (F.col(key) == F.col("_key")) & F.col("_bucket").eqNullSafe(F.col("_in")), "left")
    steps = steps.select(key, order_by, "to_status", F.when(F.col("_place") == 1, F.col("_carried")).otherwise(
        F.col("_before")).alias("from_status"))
    ok = F.lit(False)
    for a, b in allowed:
        ok = ok | ((F.col("from_status") == a) & (F.col("to_status") == b))
    return steps.filter(F.col("from_status").isNotNull()
                        & (F.col("from_status") != F.col("to_status")) & ~ok)


def volume_spike(counts: DataFrame, day_col: str, n_col: str, lookback: int = 7,
                 ratio: float = 2.0) -> DataFrame:
    """Rows per day against the mean of up to ``lookback`` earlier days.

    The per-day counts are tiny (one row per day), so the un-partitioned
    window here runs over a bounded calendar, never over raw rows."""
    w = Window.orderBy(day_col).rowsBetween(-lookback, -1)
    avg = F.avg(F.col(n_col)).over(w)
    return counts.select(day_col, n_col, avg.alias("trailing_avg"),
                         F.coalesce(F.col(n_col) > F.lit(ratio) * avg, F.lit(False)).alias("is_spike"))


def duplicate_flag(df: DataFrame, keys: list[str]) -> DataFrame:
    """``_duplicate_flag`` = the key occurs more than once.

    Counted by an aggregate (partial counts map-side); only keys that do
    repeat are joined back, in a join whose hot partition AQE can split."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    return skew_join(df, repeated, keys, "left").withColumn(
        "_duplicate_flag", F.col("_n").isNotNull()).drop("_n")


def late_flag(df: DataFrame, event_ts: str, ingest_ts: str, minutes: int = 10) -> DataFrame:
    """Accepted but flagged when ingestion lags event time by more
    than ``minutes`` (10 for clickstream, 2 for orders)."""
    lag = F.col(ingest_ts) - F.col(event_ts)
    return df.withColumn("_is_late_arrival",
                         F.coalesce(lag > F.make_dt_interval(mins=F.lit(minutes)), F.lit(False)))
