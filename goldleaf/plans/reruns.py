"""Queries on jobs that run twice (MERGE, SCD2, published tables) and on the log of their checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.casts import to_output
from ..functions.dates import date_dim
from ..quality.checks import CriticalQualityError, halt_on_critical, null_check, run_checks
from ..schemas import PRIMARY_KEYS
from ..session import scratch_path
from ..sources.tables import current_version, publish, read_table
from . import gold, silver
from .catalog import (ORACLES, RUN_ID, _as_of, bronze_orders_all, dim_customers_frame, register, silver_customers, silver_orders_initial)
from .incremental import _TABLES_SQL, _bronze_frames

# The days on which the given orders can stand.
CALENDAR = ("1992-01-01", "1998-12-31")


def _published(df, root: str, table: str):
    """``df`` as the next version of a table, read back."""
    publish(df, root, table)
    return read_table(df.sparkSession, root, table)


@register("rerun_silver_orders", ORACLES["silver_upsert_orders"])
def rerun_silver_orders(spark, sf_dir):
    """M8: the orders MERGE run twice over the same bronze, each run against the
    version that the one before it published, is the MERGE run once."""
    root = scratch_path(spark, "rerun-silver")
    target = silver_orders_initial(spark, sf_dir)
    for _ in range(2):
        target = _published(silver.silver_model(bronze_orders_all(spark, sf_dir), "orders", target=target)[0], root, "orders")
    return to_output(target)


@register("rerun_dim_customers_scd2", ORACLES["gold_dim_customers_scd2"])
def rerun_dim_customers_scd2(spark, sf_dir):
    """M8: the customer dimension run again on an unchanged silver opens and closes
    no version."""
    dim = _published(dim_customers_frame(spark, sf_dir), scratch_path(spark, "rerun-dim"), "dim_customers")
    return to_output(gold.dim_customers(silver_customers(spark, sf_dir), dim))


@register("published_calendar", f"""WITH days AS (SELECT CAST(unnest(generate_series(DATE '{CALENDAR[0]}',
  DATE '{CALENDAR[1]}', INTERVAL 1 DAY)) AS DATE) AS date_key)
SELECT date_key, CAST(year(date_key) AS BIGINT) AS year, CAST(quarter(date_key) AS BIGINT) AS quarter,
  dayofweek(date_key) IN (0, 6) AS is_weekend, count(o_orderkey) AS n_orders, CAST(2 AS BIGINT) AS version
FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date_key GROUP BY date_key""")
def published_calendar(spark, sf_dir):
    """The calendar of a fixed span, published twice (a rerun makes a new
    version, not more rows), with the orders of each day; counted per day before
    they meet it."""
    root = scratch_path(spark, "calendar")
    for _ in range(2):
        days = _published(date_dim(spark, *CALENDAR), root, "dim_date")
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").groupBy(
        F.col("o_orderdate").cast("date").alias("date_key")).agg(F.count(F.lit(1)).alias("n"))
    return (days.join(orders, "date_key", "left")
            .select("date_key", "year", "quarter", "is_weekend", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_orders"),
                    F.lit(current_version(spark, root, "dim_date")).cast("bigint").alias("version")))


# Columns whose absence ends a run, beside the keys.
REQUIRED = {"customers": "city", "products": "category_l2", "campaigns": "target_segment", "orders": "delivered_date",
            "order_items": "quantity", "inventory": "warehouse_id", "clickstream_events": "customer_id"}


def _missing_sql(column: str) -> str:
    return f"count_if({column} IS NULL OR CAST({column} AS VARCHAR) = '')"


@register("dq_results_log", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(4 AS BIGINT) AS n_results, {_missing_sql(key)} + {_missing_sql(REQUIRED[t])} AS failed_records, "
    f"{_missing_sql(key)} + {_missing_sql(REQUIRED[t])} > 0 AS halts FROM ({src}) AS b"
    for t, src, _ in _TABLES_SQL for key in [PRIMARY_KEYS[t][0]]))
def dq_results_log(spark, sf_dir):
    """The critical null checks of all seven bronze tables, appended to one
    results table by two runs; per table the rows of both, what the last run found,
    and whether the breaker stops that run there."""
    path = f"{scratch_path(spark, 'dq-results')}/dq_results"
    frames = _bronze_frames(spark, sf_dir)
    runs = [f"{RUN_ID}-{k}" for k in (1, 2)]
    for run in runs:
        parts = [run_checks(df, [null_check(df, c, "CRITICAL") for c in (PRIMARY_KEYS[e][0], REQUIRED[e])], "bronze", e, run, _as_of())
                 for e, df in frames.items()]
        reduce(lambda a, b: a.unionByName(b), parts).coalesce(1).write.mode("append").parquet(path)
    log = spark.read.parquet(path)
    last = F.col("pipeline_run_id") == runs[-1]
    halted = []
    for e in frames:  # one decision a table, over two rows
        try:
            halt_on_critical(log.where(last & (F.col("table_name") == e)))
        except CriticalQualityError:
            halted.append(e)
    return log.groupBy("table_name").agg(
        F.count("*").alias("n_results"), F.sum(F.when(last, F.col("failed_records")).otherwise(0)).alias("failed_records")).withColumn(
        "halts", F.col("table_name").isin(halted))
