"""Queries on incremental loads, retention, versions, routes and table metadata."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import to_output
from ..schemas import PRIMARY_KEYS
from ..session import small_splits
from ..sources import testdata as td
from . import gold, silver
from . import sqltwins as sq
from .catalog import (CROSS_SQL, DAMAGE_SQL, ORDERS_BRONZE_SQL, RUN_ID, SILVER_CLICK_SQL, SILVER_CUSTOMERS_SQL, SILVER_INV_SQL,
                      SILVER_ITEMS_SQL, SILVER_ORDERS_SQL, SILVER_PRODUCTS_SQL, _as_of, _gcols, _schema_violation_sql, _silver_sql, bronze_clickstream,
                      bronze_customers, bronze_inventory, bronze_json, bronze_order_items, bronze_orders, bronze_orders_all, bronze_products,
                      landed_messages, register, shared, silver_clickstream, silver_customers, silver_order_items, silver_orders,
                      silver_products)

bronze_campaigns = shared(td.bronze_campaigns)


# ------------------------------------------------------------------ campaigns
CAMPAIGNS_BRONZE_SQL = f"({td.bronze_campaigns_sql(1)}) UNION ALL ({td.bronze_campaigns_sql(2)})"
SILVER_CAMPAIGNS_SQL = _silver_sql("campaigns", CAMPAIGNS_BRONZE_SQL)
_DIM = _gcols("dim_campaigns")
_LISTED = "is_active AND campaign_type <> 'SOCIAL'"


@shared
def silver_campaigns(spark, sf_dir, day1_only=False):
    one = bronze_campaigns(spark, sf_dir, 1)
    return silver.silver_model(one if day1_only else one.unionByName(bronze_campaigns(spark, sf_dir, 2)), "campaigns")[0]


@register("silver_campaigns", SILVER_CAMPAIGNS_SQL)
def silver_campaigns_q(spark, sf_dir):
    """M1/W1 for campaigns: the latest row of both loads."""
    return to_output(silver_campaigns(spark, sf_dir))


@register("gold_dim_campaigns_scd1", sq.upsert_sql(
    f"SELECT {', '.join(_DIM)} FROM ({_silver_sql('campaigns', td.bronze_campaigns_sql(1))}) AS a WHERE {_LISTED}",
    f"SELECT {', '.join(_DIM)} FROM ({SILVER_CAMPAIGNS_SQL}) AS b", _DIM, ["campaign_id"]))
def gold_dim_campaigns_scd1(spark, sf_dir):
    """M2: the dimension of run 1 (SOCIAL campaigns not yet listed) overwritten by
    the latest silver campaigns."""
    dim = silver_campaigns(spark, sf_dir, day1_only=True).where(_LISTED).select(*_DIM)
    return to_output(gold.dim_campaigns(silver_campaigns(spark, sf_dir), dim))


# ------------------------------------------------------------------ referential
_SILVER_SQL = {"customers": SILVER_CUSTOMERS_SQL, "products": SILVER_PRODUCTS_SQL, "campaigns": SILVER_CAMPAIGNS_SQL,
               "orders": SILVER_ORDERS_SQL, "order_items": SILVER_ITEMS_SQL, "inventory": SILVER_INV_SQL,
               "clickstream_events": SILVER_CLICK_SQL}


def _silver_frames(spark, sf_dir) -> dict:
    return {"customers": silver_customers(spark, sf_dir), "products": silver_products(spark, sf_dir),
            "campaigns": silver_campaigns(spark, sf_dir), "orders": silver_orders(spark, sf_dir),
            "order_items": silver_order_items(spark, sf_dir),
            "inventory": silver.silver_model(bronze_inventory(spark, sf_dir), "inventory")[0],
            "clickstream_events": silver_clickstream(spark, sf_dir)}


# The contracts' foreign keys, stated once more for the twin.
_KEYS_SQL = [("orders", "customer_id", "customers"), ("orders", "campaign_id", "campaigns"), ("order_items", "order_id", "orders"),
             ("order_items", "product_id", "products"), ("inventory", "product_id", "products"),
             ("clickstream_events", "customer_id", "customers"), ("clickstream_events", "product_id", "products")]


@register("dq_referential_contracts", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS child, '{k}' AS fk, count(*) AS total_records, count_if({k} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM ({_SILVER_SQL[p]}) AS p WHERE p.{PRIMARY_KEYS[p][0]} = c.{k})) AS failed_records FROM ({_SILVER_SQL[c]}) AS c"
    for c, k, p in _KEYS_SQL))
def dq_referential_contracts(spark, sf_dir):
    """All seven foreign keys of the contracts, campaigns and inventory
    included, over both loads."""
    from ..quality.contracts import foreign_key_checks
    from .batch_run import FOREIGN_KEYS
    small_splits(spark)
    relations = [(f"{c}.{fk}", c, fk, p, pk) for c, fk, p, pk in FOREIGN_KEYS]
    return foreign_key_checks(_silver_frames(spark, sf_dir), relations, "silver", RUN_ID, checked_at=_as_of()).select(
        F.split_part("table_name", F.lit("."), F.lit(1)).alias("child"), F.col("column_name").alias("fk"),
        "total_records", "failed_records")


# ------------------------------------------------------------------ loads
_HALF = "2024-01-15"
_FORCED = "2024-01-10"


@register("incremental_loads", f"""WITH e AS (SELECT event_id, CAST(ts AS DATE) AS d, event_id % 97 = 0 AS bad FROM events),
n AS (SELECT count_if(d < DATE '{_HALF}' AND NOT bad) AS a, count_if(d < DATE '{_HALF}' AND bad) AS a_bad,
  count_if(d >= DATE '{_HALF}' AND NOT bad) AS b, count_if(d >= DATE '{_HALF}' AND bad) AS b_bad,
  count_if(d = DATE '{_FORCED}' AND NOT bad) AS f, count_if(d = DATE '{_FORCED}' AND bad) AS f_bad FROM e)
SELECT 'run-1' AS run_id, a AS rows_loaded, a_bad AS rows_rejected, a AS rows_in_bronze, a AS distinct_events FROM n
UNION ALL SELECT 'run-2', 0, 0, a, a FROM n UNION ALL SELECT 'run-3', b, b_bad, a + b, a + b FROM n
UNION ALL SELECT 'run-4', f, f_bad, a + b + f, a + b FROM n""")
def incremental_loads(spark, sf_dir):
    """Four runs of the loader. Half a month lands; nothing new lands;
    the rest lands; one date is forced to load again by taking its files out of the
    manifest. Each run opens only files that no committed load holds."""
    from ..sources.bronze import committed_bronze, force_reload, load_entities
    from ..streaming.jobs import fresh_root
    root = fresh_root(spark, "incremental")
    src = td.table(spark, sf_dir, "events", "event_id", "user_id", "ts")
    line = F.when(F.col("event_id") % 97 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("event_id", "user_id")))
    lines = src.select(line.alias("value"), F.to_date("ts").alias("dt"))
    schema = T.StructType().add("event_id", "long").add("user_id", "long")
    first = F.col("dt") < F.lit(_HALF).cast("date")
    out, manifest = [], f"{root}/manifest"
    for run, landing in (("run-1", lines.where(first)), ("run-2", None), ("run-3", lines.where(~first)), ("run-4", None)):
        if landing is not None:
            landing.write.mode("append").partitionBy("dt").text(f"{root}/landing/events")
        if run == "run-4":
            force_reload(spark.read.parquet(manifest), f"%dt={_FORCED}%").coalesce(1).write.parquet(f"{root}/manifest-forced")
            manifest = f"{root}/manifest-forced"
        load_entities(spark, f"{root}/landing", f"{root}/bronze", {"events": schema}, run, manifest=manifest) \
            .write.mode("append").parquet(f"{root}/audit")
        committed_bronze(spark, f"{root}/bronze", "events", manifest).agg(
            F.count("*").alias("rows_in_bronze"), F.count_distinct("event_id").alias("distinct_events")).withColumn(
            "run_id", F.lit(run)).write.mode("append").parquet(f"{root}/state")
    audit = spark.read.parquet(f"{root}/audit").select("run_id", "rows_loaded", "rows_rejected")
    return audit.join(spark.read.parquet(f"{root}/state"), "run_id").select(
        "run_id", "rows_loaded", "rows_rejected", "rows_in_bronze", "distinct_events")


_KEEP_AS_OF, _KEEP_FROM = "2024-02-12", "2024-01-13"


@register("quarantine_retention", f"""SELECT CAST(ts AS DATE) AS quarantined_on, error_message, count(*) AS n_rows
FROM ({DAMAGE_SQL}) AS m WHERE error_message IS NOT NULL AND CAST(ts AS DATE) >= DATE '{_KEEP_FROM}' GROUP BY ALL""")
def quarantine_retention(spark, sf_dir):
    """Refused messages held by the day they came, written twice as a repeated
    run would (a day's folder is replaced, no row doubles), then expired on
    2024-02-12: days beyond the 30-day cut are gone, folder and all."""
    from ..sources.retention import expire_partitions
    from ..sources.tables import overwrite_partitions
    from ..streaming.jobs import fresh_root
    path = f"{fresh_root(spark, 'quarantine')}/messages"
    refused = landed_messages(spark, sf_dir).where("error_message is not null").select(
        "payload", "error_message", F.col("dt").alias("quarantined_on"))
    for _ in range(2):
        overwrite_partitions(refused, path, ["quarantined_on"])
    expire_partitions(spark, path, "quarantined_on", _KEEP_AS_OF, 30)
    return spark.read.parquet(path).groupBy("quarantined_on", "error_message").agg(F.count("*").alias("n_rows"))


# ------------------------------------------------------------------ versions and routes
_VERSION = ("CASE WHEN order_status = 'PENDING' THEN NULL WHEN channel = 'APP' THEN '1.1' WHEN channel = 'MOBILE' THEN '2.0' "
            "ELSE '1.0' END")
_MIXED_SQL = f"SELECT * REPLACE ({_VERSION} AS _schema_version) FROM ({td.bronze_orders_sql(1)}) AS o"


@register("silver_schema_versions", f"""SELECT order_id, _schema_version, channel, updated_at,
  CASE WHEN _schema_version = '2.0' THEN 'unsupported schema version' END AS refused FROM ({sq.typed_sql('orders', _MIXED_SQL)}) AS t""")
def silver_schema_versions(spark, sf_dir):
    """One load with rows of versions 1.0, 1.1, 2.0 and none. The contract in
    force takes its major number; the rest is quarantined, bronze keeps all."""
    from ..schemas import CURRENT_VERSIONS
    mixed = bronze_orders(spark, sf_dir, 1).withColumn("_schema_version", F.expr(_VERSION))
    good, refused = silver.silver_model(mixed, "orders", current_version=CURRENT_VERSIONS["orders"])
    cols = ["order_id", "_schema_version", "channel", "updated_at"]
    return to_output(good.select(*cols, F.lit(None).cast("string").alias("refused")).unionByName(
        refused.select(*cols, F.array_join("_validation_errors", "; ").alias("refused"))))


_ROUTES_SQL = {
    "orders": (ORDERS_BRONZE_SQL, [("amount_above_limit", "HIGH", "total_amount > 300000"),
                                   ("not_shipped", "MEDIUM", "shipped_date IS NULL"), ("no_campaign", "LOW", "campaign_id IS NULL")]),
    "products": (f"({td.bronze_products_sql(1)}) UNION ALL ({td.bronze_products_sql(2)})",
                 [("price_out_of_range", "HIGH", "unit_price > 1500"), ("inactive", "MEDIUM", "NOT is_active"),
                  ("no_size", "LOW", "category_l2 IS NULL")]),
    "campaigns": (CAMPAIGNS_BRONZE_SQL, [("ends_before_start", "HIGH", "end_date < start_date"),
                                         ("over_half_spent", "MEDIUM", "spent_amount > budget_amount * 0.55"),
                                         ("no_segment", "LOW", "target_segment IS NULL")])}


def _routes_twin(table: str) -> str:
    src, rules = _ROUTES_SQL[table]
    names = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, _, cond in rules)
    return (f"SELECT '{table}' AS table_name, CASE WHEN {rules[0][2]} THEN 'quarantine' WHEN {rules[1][2]} OR {rules[2][2]} THEN 'flag' "
            f"ELSE 'pass' END AS route, concat_ws(',', {names}) AS flags, count(*) AS n_rows FROM ({src}) AS s GROUP BY ALL")


@register("quality_routes", "\nUNION ALL\n".join(_routes_twin(t) for t in _ROUTES_SQL))
def quality_routes(spark, sf_dir):
    """Rows of three entities, both loads, routed by the gravest check they
    fail: HIGH to quarantine, MEDIUM and LOW kept and flagged. Counts per route."""
    from ..quality.checks import rule_check
    from ..quality.routing import split_by_route
    frames = {"orders": bronze_orders_all(spark, sf_dir),
              "products": bronze_products(spark, sf_dir, 1).unionByName(bronze_products(spark, sf_dir, 2)),
              "campaigns": bronze_campaigns(spark, sf_dir, 1).unionByName(bronze_campaigns(spark, sf_dir, 2))}
    c = F.col
    rules = {"orders": [("amount_above_limit", "HIGH", c("total_amount") > 300000), ("not_shipped", "MEDIUM", c("shipped_date").isNull()),
                        ("no_campaign", "LOW", c("campaign_id").isNull())],
             "products": [("price_out_of_range", "HIGH", c("unit_price") > 1500), ("inactive", "MEDIUM", ~c("is_active")),
                          ("no_size", "LOW", c("category_l2").isNull())],
             "campaigns": [("ends_before_start", "HIGH", c("end_date") < c("start_date")),
                           ("over_half_spent", "MEDIUM", c("spent_amount") > c("budget_amount") * F.lit(0.55)),
                           ("no_segment", "LOW", c("target_segment").isNull())]}
    out = None
    for name, df in frames.items():
        kept, refused = split_by_route(df, [rule_check(n, bad, sev) for n, sev, bad in rules[name]])
        rows = kept.select(F.when(F.size("_flags") > 0, "flag").otherwise("pass").alias("route"), F.array_join("_flags", ",").alias("flags")) \
            .unionByName(refused.select(F.lit("quarantine").alias("route"), F.array_join("_validation_errors", ",").alias("flags")))
        counted = rows.groupBy(F.lit(name).alias("table_name"), "route", "flags").agg(F.count("*").alias("n_rows"))
        out = counted if out is None else out.unionByName(counted)
    return out


# ------------------------------------------------------------------ table metadata
_TABLES_SQL = [("customers", f"({td.bronze_customers_sql(1)}) UNION ALL ({td.bronze_customers_sql(2)})", 2),
               ("products", f"({td.bronze_products_sql(1)}) UNION ALL ({td.bronze_products_sql(2)})", 2),
               ("campaigns", CAMPAIGNS_BRONZE_SQL, 2), ("orders", ORDERS_BRONZE_SQL, 2), ("order_items", td.bronze_order_items_sql(), 1),
               ("inventory", td.bronze_inventory_sql(), 1), ("clickstream_events", td.bronze_clickstream_sql(), 1)]


@register("report_tables", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({loads} AS BIGINT) AS n_loads, TRUE AS has_bytes, TRUE AS changed_last_hour "
    f"FROM ({src}) AS s" for t, src, loads in _TABLES_SQL))
def report_tables(spark, sf_dir):
    """Row count, size and last change of all seven bronze tables after
    both loads, from Parquet footers and the file listing (no column is read).
    Sizes and times differ from run to run, so the result says whether they hold:
    the bytes are there, and the last change lies between the load and now."""
    from ..sources.bronze import table_metadata
    from ..streaming.jobs import fresh_root
    root = fresh_root(spark, "bronze-tables")
    started = F.lit(spark.sql("select current_timestamp()").first()[0])
    sources = {"customers": [bronze_customers(spark, sf_dir, k) for k in (1, 2)], "products": [bronze_products(spark, sf_dir, k) for k in (1, 2)],
               "campaigns": [bronze_campaigns(spark, sf_dir, k) for k in (1, 2)], "orders": [bronze_orders(spark, sf_dir, k) for k in (1, 2)],
               "order_items": [bronze_order_items(spark, sf_dir)], "inventory": [bronze_inventory(spark, sf_dir)],
               "clickstream_events": [bronze_clickstream(spark, sf_dir)]}

    def load(name: str) -> None:  # a table's loads append to one folder, so they follow each other
        for k, df in enumerate(sources[name], 1):
            df.withColumn("_load", F.lit(k)).write.mode("append").partitionBy("_load").parquet(f"{root}/{name}")

    with ThreadPoolExecutor(len(sources)) as pool:  # the tables land beside each other: a small one has fewer tasks than there are cores
        list(pool.map(load, sources))
    meta = reduce(lambda a, b: a.unionByName(b), [table_metadata(spark, root, name, "_load") for name in sources])
    changed = F.col("last_modified").between(started - F.expr("INTERVAL 1 MINUTE"), F.current_timestamp() + F.expr("INTERVAL 1 MINUTE"))
    return meta.select("table_name", "row_count", F.col("n_partitions").alias("n_loads"), (F.col("size_bytes") > 0).alias("has_bytes"),
                       changed.alias("changed_last_hour")).orderBy("table_name")




# ------------------------------------------------------------------ contracts over all entities
def _bronze_frames(spark, sf_dir) -> dict:
    """All seven entities as landed, both loads where there are two."""
    return {"customers": bronze_customers(spark, sf_dir, 1).unionByName(bronze_customers(spark, sf_dir, 2)),
            "products": bronze_products(spark, sf_dir, 1).unionByName(bronze_products(spark, sf_dir, 2)),
            "campaigns": bronze_campaigns(spark, sf_dir, 1).unionByName(bronze_campaigns(spark, sf_dir, 2)),
            "orders": bronze_orders_all(spark, sf_dir), "order_items": bronze_order_items(spark, sf_dir),
            "inventory": bronze_inventory(spark, sf_dir), "clickstream_events": bronze_clickstream(spark, sf_dir)}


@register("dq_schema_contracts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS total_records, count_if({_schema_violation_sql(t)}) AS failed_records FROM ({src}) AS b"
    for t, src, _ in _TABLES_SQL))
def dq_schema_contracts(spark, sf_dir):
    """The entity schemas on the landed JSON text of all seven entities, both
    loads."""
    from ..quality.schema_check import ENTITY_SCHEMAS, schema_check
    small_splits(spark)
    parts = [schema_check(bronze_json(df, e), "value", ENTITY_SCHEMAS[e], "bronze", e, RUN_ID, checked_at=_as_of())
             for e, df in _bronze_frames(spark, sf_dir).items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("table_name", "total_records", "failed_records")


_CROSS_ALL = {**CROSS_SQL, "campaigns": [("end_after_start", None, "end_date < start_date")]}


@register("dq_cross_contracts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{name}' AS rule_name, count(*) AS total_records, count_if(coalesce({cond}, FALSE)) AS failed_records "
    f"FROM ({sq.typed_sql(t, src)}) AS b" for t, src, _ in _TABLES_SQL for name, _, cond in _CROSS_ALL[t]))
def dq_cross_contracts(spark, sf_dir):
    """The cross-column rules of all seven entities on every row landed, both
    loads, typed as silver types them; one aggregate per table."""
    from ..functions.casts import typed_select
    from ..quality.checks import run_checks
    from ..quality.contracts import cross_column_checks
    from ..schemas import SILVER_COLUMNS
    parts = [run_checks(typed_select(df, SILVER_COLUMNS[e]), cross_column_checks(e), "silver", e, RUN_ID, _as_of())
             for e, df in _bronze_frames(spark, sf_dir).items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("table_name", "rule_name", "total_records", "failed_records")


@register("late_orders", f"""SELECT channel, count(*) AS n_orders, count_if(came > INTERVAL 2 MINUTE) AS n_late,
  count_if(came > INTERVAL 10 MINUTE) AS n_beyond_ten FROM (
  SELECT channel, INTERVAL 1 SECOND * (CAST('0x' || right(order_id, 2) AS INTEGER) * 3) AS came FROM ({ORDERS_BRONZE_SQL}) AS o) AS x
GROUP BY channel""")
def late_orders(spark, sf_dir):
    """The orders rule, two minutes. An order comes (by rule) three seconds
    late for each unit of its id's last two hex digits; both loads."""
    from ..quality.contracts import late_flag
    delay = F.make_dt_interval(secs=(F.conv(F.right("order_id", F.lit(2)), 16, 10).cast("int") * 3).cast("decimal(18,6)"))
    o = bronze_orders_all(spark, sf_dir).select("channel", "order_date", (F.col("order_date") + delay).alias("came"))
    two = late_flag(o, "order_date", "came", 2).withColumnRenamed("_is_late_arrival", "l2")
    both = late_flag(two, "order_date", "came", 10).withColumnRenamed("_is_late_arrival", "l10")
    return both.groupBy("channel").agg(F.count("*").alias("n_orders"), F.count_if("l2").alias("n_late"), F.count_if("l10").alias("n_beyond_ten"))


# ------------------------------------------------------------------ type 2 for products and campaigns
def _scd2_twin(entity: str, key: str, tracked: list[str], attrs: list[str], one: str, both: str) -> str:
    moved = " OR ".join(f"o.{c} <> n.{c}" for c in tracked)
    return f"""WITH a AS ({one}), b AS ({both}),
v AS (SELECT {key}, {', '.join(attrs)}, updated_at AS valid_from FROM a
  UNION ALL SELECT n.{key}, {', '.join('n.' + c for c in attrs)}, n.updated_at FROM b n LEFT JOIN a o USING ({key}) WHERE o.{key} IS NULL OR {moved})
SELECT '{entity}' AS entity, {key} AS business_key, {' || '.join(f"coalesce(CAST({c} AS VARCHAR), '')" + (" || '|'" if c != attrs[-1] else '') for c in attrs)} AS attributes,
  valid_from, lead(valid_from) OVER (PARTITION BY {key} ORDER BY valid_from) AS valid_to,
  lead(valid_from) OVER (PARTITION BY {key} ORDER BY valid_from) IS NULL AS is_current FROM v"""


_SCD2 = {"products": ("product_id", ["unit_price", "is_active"], ["sku", "category_l1", "unit_price", "is_active"]),
         "campaigns": ("campaign_id", ["spent_amount", "is_active"], ["campaign_name", "channel", "spent_amount", "is_active"])}


@register("gold_scd2_products_campaigns", "\nUNION ALL\n".join(f"SELECT * FROM ({_scd2_twin(e, *_SCD2[e], one, both)}) AS t_{e}" for e, one, both in (
    ("products", _silver_sql("products", td.bronze_products_sql(1)), SILVER_PRODUCTS_SQL),
    ("campaigns", _silver_sql("campaigns", td.bronze_campaigns_sql(1)), SILVER_CAMPAIGNS_SQL))))
def gold_scd2_products_campaigns(spark, sf_dir):
    """M7: versioned product and campaign dimensions over both loads: price,
    spending and activity open a version, other columns do not."""
    from ..operators.scd import scd2
    from ..schemas import SILVER_COLUMNS, empty_frame
    out = None
    for entity, first, both in (("products", silver_products(spark, sf_dir, day1_only=True), silver_products(spark, sf_dir)),
                                ("campaigns", silver_campaigns(spark, sf_dir, day1_only=True), silver_campaigns(spark, sf_dir))):
        key, tracked, attrs = _SCD2[entity]
        types = dict(SILVER_COLUMNS[entity])
        dim = empty_frame(spark, [("sk", "string"), (key, "string"), *[(a, types[a]) for a in attrs], ("valid_from", "timestamp"),
                                  ("valid_to", "timestamp"), ("is_current", "boolean")])
        for load in (first, both):
            dim = scd2(dim, load, key, tracked, attrs, valid_from="updated_at", sk_col="sk")
        rows = dim.select(F.lit(entity).alias("entity"), F.col(key).alias("business_key"),
                          F.concat_ws("|", *[F.coalesce(F.col(a).cast("string"), F.lit("")) for a in attrs]).alias("attributes"),
                          "valid_from", "valid_to", "is_current")
        out = rows if out is None else out.unionByName(rows)
    return to_output(out)
