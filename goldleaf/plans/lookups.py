"""Queries on stored, partitioned targets and on versions valid at a fact's time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import to_output
from ..sources import testdata as td
from . import gold, silver
from . import sqltwins as sq
from .catalog import (_ATTRS, _cols, _silver_sql, FACT_ORDERS_SQL, SILVER_ORDERS_DAY1_SQL, bronze_customers, bronze_orders,
                      fact_orders_frame, register, shared)

# Customer versions dated inside the span of the orders (by rule on the customer
# number): the first load some time in 1995, the second from 1998 on.
_NUMBER = "CAST(split_part(source_customer_id, '#', 2) AS BIGINT)"


def _dated(generation: int) -> str:
    start, spread = (("1995-01-01", 365), ("1998-01-01", 700))[generation - 1]
    return (f"SELECT * REPLACE (TIMESTAMP '{start} 00:00:00' + INTERVAL 1 DAY * ({_NUMBER} % {spread}) AS updated_at) "
            f"FROM ({td.bronze_customers_sql(generation)}) AS c")


def _dated_customers(spark, sf_dir, generation: int):
    start, spread = (("1995-01-01", 365), ("1998-01-01", 700))[generation - 1]
    day = F.date_add(F.lit(start).cast("date"), (F.split_part("source_customer_id", F.lit("#"), F.lit(2)).cast("long") % spread).cast("int"))
    return bronze_customers(spark, sf_dir, generation).withColumn("updated_at", day.cast("timestamp_ntz"))


@shared
def dated_dim_customers(spark, sf_dir):
    from ..schemas import empty_frame
    from .catalog import GOLD_COLUMNS
    one = _dated_customers(spark, sf_dir, 1)
    dim = gold.dim_customers(silver.silver_model(one, "customers")[0], empty_frame(spark, GOLD_COLUMNS["dim_customers"]))
    both = one.unionByName(_dated_customers(spark, sf_dir, 2))
    return gold.dim_customers(silver.silver_model(both, "customers")[0], dim)


_ONE = _silver_sql("customers", _dated(1))
_BOTH = _silver_sql("customers", f"({_dated(1)}) UNION ALL ({_dated(2)})")
DATED_DIM_SQL = f"""WITH one AS ({_ONE}), two AS ({_BOTH}),
v AS (SELECT customer_id, {_ATTRS}, updated_at AS valid_from FROM one
  UNION ALL SELECT n.customer_id, {', '.join('n.' + a.strip() for a in _ATTRS.split(','))}, n.updated_at FROM two n LEFT JOIN one o USING (customer_id)
  WHERE o.customer_id IS NULL OR o.email_hash <> n.email_hash OR o.customer_segment <> n.customer_segment)
SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to FROM v"""


@register("star_join_by_fact_date", f"""WITH f AS ({FACT_ORDERS_SQL}), d AS ({DATED_DIM_SQL})
SELECT CAST(year(f.order_date) AS INTEGER) AS order_year, coalesce(d.customer_segment, 'none yet') AS segment,
  d.valid_to IS NULL AND d.valid_from IS NOT NULL AS is_latest_version,
  CAST(SUM(f.line_total) AS DECIMAL(38,9)) AS revenue, count(*) AS n_items, count(DISTINCT f.customer_id) AS n_customers
FROM f LEFT JOIN d ON f.customer_id = d.customer_id AND f.order_date >= d.valid_from
  AND (d.valid_to IS NULL OR f.order_date < d.valid_to) GROUP BY ALL""")
def star_join_by_fact_date(spark, sf_dir):
    """Each order item with the customer version valid when it was ordered;
    versions split the orders of a customer. Revenue by year, segment then, and
    whether that version is still the latest."""
    from ..operators.asof import asof_lookup
    dim = dated_dim_customers(spark, sf_dir)
    found = asof_lookup(fact_orders_frame(spark, sf_dir), dim, "customer_id", "order_date", "valid_from",
                        ["customer_segment", "valid_from", "valid_to"], valid_to="valid_to")
    return found.groupBy(
        F.year("order_date").alias("order_year"), F.coalesce("customer_segment", F.lit("none yet")).alias("segment"),
        (F.col("valid_from").isNotNull() & F.col("valid_to").isNull()).alias("is_latest_version")).agg(
        F.sum("line_total").cast("decimal(38,9)").alias("revenue"), F.count("*").alias("n_items"),
        F.countDistinct("customer_id").alias("n_customers"))


STORED_UNTIL, CHANGED_FROM = "2000-01-01 00:00:00", "1998-01-01 00:00:00"
_MONTH = "strftime(order_date, '%Y-%m')"
_STORED = f"SELECT *, 'run-1' AS loaded_in FROM ({SILVER_ORDERS_DAY1_SQL}) AS o WHERE order_date < TIMESTAMP '{STORED_UNTIL}'"
_CHANGES = f"SELECT * FROM ({_silver_sql('orders', td.bronze_orders_sql(2))}) AS o WHERE order_date >= TIMESTAMP '{CHANGED_FROM}'"


@register("merge_partitions", f"""WITH t AS ({_STORED}), s AS ({_CHANGES}),
m AS ({sq.upsert_sql('SELECT * FROM t', 'SELECT *, NULL AS loaded_in FROM s', [*_cols('orders'), 'loaded_in'], ['order_id'],
                     update_cols=[c for c in _cols('orders') if c != 'order_id'])})
SELECT order_id, order_status, loaded_in, {_MONTH} AS order_month, {_MONTH} IN (SELECT {_MONTH} FROM s) AS rewritten FROM m""")
def merge_partitions(spark, sf_dir):
    """MERGE of the day-2 changes since 1998 into a stored table
    partitioned by order month. The target's own column ``loaded_in``, which the
    changes lack, stays; months without a change keep the files they had, which
    ``rewritten`` reads from the files themselves."""
    from ..operators.merge import upsert_into_partitions
    from ..streaming.jobs import fresh_root
    root = fresh_root(spark, "merge-partitions")
    path = f"{root}/orders"
    month = F.date_format("order_date", "yyyy-MM")
    day1 = silver.silver_model(bronze_orders(spark, sf_dir, 1), "orders")[0]
    day1.where(F.col("order_date") < F.lit(STORED_UNTIL).cast("timestamp")).withColumns(
        {"loaded_in": F.lit("run-1"), "order_month": month}).hint("rebalance", F.col("order_month")).write.partitionBy("order_month").parquet(path)
    spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct().write.parquet(f"{root}/files")
    changes = silver.silver_model(bronze_orders(spark, sf_dir, 2), "orders")[0].where(
        F.col("order_date") >= F.lit(CHANGED_FROM).cast("timestamp")).withColumn("order_month", month)
    upsert_into_partitions(changes, path, ["order_id"], "order_month", f"{root}/stage", keys_not_null=True)
    stored = spark.read.schema("order_id string, order_status string, loaded_in string, order_month string").parquet(path)
    old = spark.read.parquet(f"{root}/files").withColumn("old", F.lit(True))
    return stored.withColumn("file", F.col("_metadata.file_path")).join(old, "file", "left").select(
        "order_id", "order_status", "loaded_in", "order_month", F.col("old").isNull().alias("rewritten"))
