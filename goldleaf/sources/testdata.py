"""Bind the driver's TPC-H-like tables to the retail entities.

Each function returns a *bronze-shaped* frame (the raw entity columns as a
JSON landing would carry them) derived by a fixed rule from one given table,
so every job's work grows with the input. Next to each Spark binding sits
its SQL twin (``*_SQL``) that DuckDB runs for the correctness oracle; the
two must stay in step.

Binding (see SURVEY 7.1): customer -> customers, part -> products,
orders -> orders, lineitem -> order_items (and a derived inventory),
events -> clickstream_events, supplier -> warehouses.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA_VERSION = "1.0"

# The two load days used by the incremental scenarios.
DAY1_CUSTOMERS_TS = "2024-01-02 00:00:00"
DAY2_CUSTOMERS_TS = "2024-02-01 00:00:00"
ORDERS_INITIAL_CUTOFF = "1998-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str, wide: bool = False) -> DataFrame:
    """Read one driver table, pruned to ``cols``. ``wide=True`` for inputs
    with heavy per-row work ahead (see ``spread``)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*cols) if cols else df
    return spread(df) if wide else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an under-split scan over the cluster's cores.

    A file with one row group is read by one task, and everything up to the
    first shuffle would run on one core. When a scan has fewer partitions
    than the default parallelism, one cheap round-robin exchange of the raw
    (pruned) rows spreads the per-row work; a real 100 TB input has far
    more splits than cores and is left alone."""
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # e.g. a Connect session exposes no RDDs: leave the plan as is
        return df
    return df.repartition(want) if have < want else df


# ---------------------------------------------------------------- ids
# 8-hex namespace prefix of each id family.
ID_NAMESPACES = {"customer": "c0570e00", "product": "9a0d0c70", "order": "0a0e0a00",
                 "item": "17e00000", "campaign": "ca3a1900", "inventory": "1a7e0700", "event": "e7e00000"}


def uuid_like(namespace: str, key: Column, second: Column | None = None) -> Column:
    """36-character, UUID-shaped id from one or two non-negative integer keys.

    After the namespace stand 24 hex digits: one key has them all, two keys have
    12 each. Nothing is shortened, so ids are unique; a key of a pair that
    doesn't fit its 12 digits (2**48) is an error. Only integer hex formatting,
    no hashing, so an id costs little per row: each group of digits is printed
    with a 1 before it, which keeps its zeros, instead of being padded."""
    def digits(k: Column, width: int) -> Column:
        return F.hex(k.bitwiseOR(F.lit(1 << 4 * width)))

    ns, a = ID_NAMESPACES[namespace], key.cast("bigint")
    if second is None:
        top, tail = F.shiftrightunsigned(a, 48), F.substring(digits(a.bitwiseAND(F.lit((1 << 48) - 1)), 12), 2, 12)
        out = F.when(top == 0, F.concat(F.lit(f"{ns}-0000-0000-0000-"), tail)).otherwise(
            F.concat(F.lit(f"{ns}-0000-0000-"), F.substring(digits(top, 4), 2, 4), F.lit("-"), tail))
    else:
        too_large = (F.greatest(key, second) >= F.lit(1 << 48)) | (F.least(key, second) < 0)
        head, tail = digits(a, 12), F.substring(digits(second.cast("bigint"), 12), 2, 12)
        out = F.when(too_large, F.raise_error(F.lit("id key out of range"))).otherwise(F.concat(
            F.lit(f"{ns}-"), F.substring(head, 2, 4), F.lit("-"), F.substring(head, 6, 4), F.lit("-"),
            F.substring(head, 10, 4), F.lit("-"), tail))
    return F.coalesce(F.lower(out), F.lit(ns))


def uuid_sql(namespace: str, *keys: str) -> str:
    """The id rule stated on its own for the twin: printed hex digits, cut into
    groups by a pattern."""
    width = 24 // len(keys)
    shape = f"{{:0{width}x}}" * len(keys)
    args = ", ".join(f"CAST({k} AS BIGINT)" for k in keys)
    return (f"'{ID_NAMESPACES[namespace]}' || regexp_replace(format('{shape}', {args}), "
            f"'^(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '-\\1-\\2-\\3-\\4')")


def _dec(x: Column, scale: int = 2) -> Column:
    return x.cast(f"decimal(18,{scale})")


# ---------------------------------------------------------------- customers
def _segment(bal: Column) -> Column:
    return (F.when(bal >= 7500, "PLATINUM").when(bal >= 5000, "GOLD")
            .when(bal >= 2500, "SILVER").otherwise("BRONZE"))


def bronze_customers(spark: SparkSession, sf_dir: str, generation: int = 1) -> DataFrame:
    """Customers as landed on load day 1 or 2.

    Day 2 changes, by rule on the market segment: BUILDING customers gain
    2,500 balance (segment may step up: tracked change), AUTOMOBILE
    customers get a new e-mail (tracked), MACHINERY customers get an
    upper-case first name (untracked: must not version).
    """
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal",
              "c_mktsegment")
    bal = F.col("c_acctbal")
    email_src = F.col("c_name")
    first = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    ts = DAY1_CUSTOMERS_TS
    if generation == 2:
        bal = F.col("c_acctbal") + F.when(F.col("c_mktsegment") == "BUILDING", 2500).otherwise(0)
        email_src = F.when(F.col("c_mktsegment") == "AUTOMOBILE",
                           F.concat(F.col("c_name"), F.lit("@v2"))).otherwise(F.col("c_name"))
        first = F.when(F.col("c_mktsegment") == "MACHINERY", F.upper(first)).otherwise(first)
        ts = DAY2_CUSTOMERS_TS
    return c.select(
        uuid_like("customer", F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("source_customer_id"),
        F.sha2(email_src, 256).alias("email_hash"),
        first.alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lit("N"), F.chr(F.col("c_nationkey") + 65)).alias("country_code"),
        F.lit(None).cast("string").alias("city"),
        F.date_add(F.lit("2019-01-01").cast("date"), (F.col("c_custkey") % 1500).cast("int"))
        .alias("signup_date"),
        _segment(bal).alias("customer_segment"),
        F.floor(bal).cast("bigint").alias("loyalty_points"),
        (bal >= 0).alias("is_active"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit(ts).cast("timestamp_ntz").alias("updated_at"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"),
    )


def bronze_customers_sql(generation: int = 1) -> str:
    bal = "c_acctbal"
    email_src = "c_name"
    first = "split_part(c_name, '#', 1)"
    ts = DAY1_CUSTOMERS_TS
    if generation == 2:
        bal = "(c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 2500 ELSE 0 END)"
        email_src = "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_name || '@v2' ELSE c_name END"
        first = f"CASE WHEN c_mktsegment = 'MACHINERY' THEN upper({first}) ELSE {first} END"
        ts = DAY2_CUSTOMERS_TS
    seg = (f"CASE WHEN {bal} >= 7500 THEN 'PLATINUM' WHEN {bal} >= 5000 THEN 'GOLD' "
           f"WHEN {bal} >= 2500 THEN 'SILVER' ELSE 'BRONZE' END")
    return f"""SELECT {uuid_sql('customer', 'c_custkey')} AS customer_id,
  c_name AS source_customer_id, sha256({email_src}) AS email_hash,
  {first} AS first_name, split_part(c_name, '#', 2) AS last_name,
  'N' || chr(CAST(c_nationkey + 65 AS INTEGER)) AS country_code, CAST(NULL AS VARCHAR) AS city,
  DATE '2019-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS signup_date,
  {seg} AS customer_segment, CAST(floor({bal}) AS BIGINT) AS loyalty_points,
  ({bal} >= 0) AS is_active, TIMESTAMP '2024-01-01 00:00:00' AS created_at,
  TIMESTAMP '{ts}' AS updated_at, '{SCHEMA_VERSION}' AS _schema_version
FROM customer"""


# ---------------------------------------------------------------- products
def bronze_products(spark: SparkSession, sf_dir: str, generation: int = 1) -> DataFrame:
    """Products from ``part``. Day 2 raises PROMO prices by 10 % (by rule)."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size",
              "p_retailprice")
    price = _dec(F.col("p_retailprice"))
    ts = "2024-01-02 00:00:00"
    if generation == 2:
        price = F.when(F.col("p_type") == "PROMO", (price * F.lit(Decimal("1.10"))).cast("decimal(18,3)")
                       ).otherwise(price.cast("decimal(18,3)"))
        ts = "2024-02-01 00:00:00"
    return p.select(
        uuid_like("product", F.col("p_partkey")).alias("product_id"),
        F.col("p_partkey").cast("string").alias("source_product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_l1"),
        F.when(F.col("p_size") > 40, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("SIZE-"), F.col("p_size").cast("string"))).alias("category_l2"),
        F.col("p_brand").alias("brand"),
        price.alias("unit_price"),
        (_dec(F.col("p_retailprice")) * F.lit(Decimal("0.60"))).alias("cost_price"),
        (F.col("p_size") % 7 != 0).alias("is_active"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit(ts).cast("timestamp_ntz").alias("updated_at"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"),
    )


def bronze_products_sql(generation: int = 1) -> str:
    price = "CAST(p_retailprice AS DECIMAL(18,2))"
    ts = "2024-01-02 00:00:00"
    if generation == 2:
        price = (f"CASE WHEN p_type = 'PROMO' THEN CAST({price} * 1.10 AS DECIMAL(18,3)) "
                 f"ELSE CAST({price} AS DECIMAL(18,3)) END")
        ts = "2024-02-01 00:00:00"
    return f"""SELECT {uuid_sql('product', 'p_partkey')} AS product_id,
  CAST(p_partkey AS VARCHAR) AS source_product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
  p_name AS product_name, p_type AS category_l1,
  CASE WHEN p_size > 40 THEN NULL ELSE 'SIZE-' || CAST(p_size AS VARCHAR) END AS category_l2,
  p_brand AS brand, {price} AS unit_price,
  CAST(p_retailprice AS DECIMAL(18,2)) * 0.60 AS cost_price, (p_size % 7 <> 0) AS is_active,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '{ts}' AS updated_at,
  '{SCHEMA_VERSION}' AS _schema_version
FROM part"""


# ---------------------------------------------------------------- orders
def bronze_orders(spark: SparkSession, sf_dir: str, generation: int = 1) -> DataFrame:
    """Orders as landed.

    Day 1 is the full extract with status F/O/P -> DELIVERED/SHIPPED/PENDING.
    Day 2 holds only the orders whose status moved on (SHIPPED -> DELIVERED,
    PENDING -> CONFIRMED), with a later ``updated_at``.
    """
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
              "o_orderdate", "o_orderpriority", wide=True)
    d = F.col("o_orderdate")
    if generation == 3:
        return _orders_day3(o)
    if generation == 1:
        status = (F.when(F.col("o_orderstatus") == "F", "DELIVERED")
                  .when(F.col("o_orderstatus") == "O", "SHIPPED").otherwise("PENDING"))
        shipped = F.when(F.col("o_orderstatus").isin("F", "O"), d + F.expr("INTERVAL 2 DAYS"))
        delivered = F.when(F.col("o_orderstatus") == "F", d + F.expr("INTERVAL 5 DAYS"))
        updated = d + F.expr("INTERVAL 1 DAYS")
    else:
        o = o.filter(F.col("o_orderstatus").isin("O", "P"))
        status = F.when(F.col("o_orderstatus") == "O", "DELIVERED").otherwise("CONFIRMED")
        shipped = F.when(F.col("o_orderstatus") == "O", d + F.expr("INTERVAL 2 DAYS"))
        delivered = F.when(F.col("o_orderstatus") == "O", d + F.expr("INTERVAL 6 DAYS"))
        updated = d + F.expr("INTERVAL 6 DAYS")
    return o.select(
        uuid_like("order", F.col("o_orderkey")).alias("order_id"),
        F.concat(F.lit("SRC-"), F.col("o_orderkey").cast("string")).alias("source_order_id"),
        uuid_like("customer", F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", uuid_like("campaign", F.col("o_custkey") % 97 + 1)).alias("campaign_id"),
        status.alias("order_status"),
        d.alias("order_date"),
        shipped.alias("shipped_date"),
        delivered.alias("delivered_date"),
        F.col("o_totalprice").alias("total_amount"),
        F.lit(0.0).alias("discount_amount"),
        F.lit(0.0).alias("tax_amount"),
        F.lit("USD").alias("currency_code"),
        (F.when(F.col("o_orderpriority") == "1-URGENT", "APP")
         .when(F.col("o_orderpriority") == "2-HIGH", "MOBILE").otherwise("WEB")).alias("channel"),
        d.alias("created_at"),
        updated.alias("updated_at"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"),
    )


def _orders_day3(o: DataFrame) -> DataFrame:
    """Day 3 (status-history scenario only): delivered URGENT orders come
    back as SHIPPED (an illegal step), delivered LOW orders are RETURNED."""
    o = o.filter((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return o.select(
        uuid_like("order", F.col("o_orderkey")).alias("order_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "SHIPPED").otherwise("RETURNED").alias("order_status"),
        (F.col("o_orderdate") + F.expr("INTERVAL 9 DAYS")).alias("updated_at"))


ORDERS_DAY3_SQL = f"""SELECT {uuid_sql('order', 'o_orderkey')} AS order_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'SHIPPED' ELSE 'RETURNED' END AS order_status,
  o_orderdate + INTERVAL 9 DAY AS updated_at
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')"""


def bronze_orders_sql(generation: int = 1) -> str:
    if generation == 1:
        status = ("CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'SHIPPED' "
                  "ELSE 'PENDING' END")
        shipped = "CASE WHEN o_orderstatus IN ('F','O') THEN o_orderdate + INTERVAL 2 DAY END"
        delivered = "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 5 DAY END"
        updated = "o_orderdate + INTERVAL 1 DAY"
        where = ""
    else:
        status = "CASE o_orderstatus WHEN 'O' THEN 'DELIVERED' ELSE 'CONFIRMED' END"
        shipped = "CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 2 DAY END"
        delivered = "CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 6 DAY END"
        updated = "o_orderdate + INTERVAL 6 DAY"
        where = "WHERE o_orderstatus IN ('O','P')"
    return f"""SELECT {uuid_sql('order', 'o_orderkey')} AS order_id,
  'SRC-' || CAST(o_orderkey AS VARCHAR) AS source_order_id,
  {uuid_sql('customer', 'o_custkey')} AS customer_id,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN {uuid_sql('campaign', 'o_custkey % 97 + 1')} END AS campaign_id,
  {status} AS order_status, o_orderdate AS order_date, {shipped} AS shipped_date,
  {delivered} AS delivered_date, o_totalprice AS total_amount, 0.0::DOUBLE AS discount_amount,
  0.0::DOUBLE AS tax_amount, 'USD' AS currency_code,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'APP' WHEN '2-HIGH' THEN 'MOBILE' ELSE 'WEB' END
    AS channel,
  o_orderdate AS created_at, {updated} AS updated_at, '{SCHEMA_VERSION}' AS _schema_version
FROM orders {where}"""


# ---------------------------------------------------------------- order items
def bronze_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items from ``lineitem``. ``(l_orderkey, l_linenumber)`` repeats,
    so the landing carries real duplicates of ``order_item_id``.

    Amounts are exact decimals: unit price in whole cents (floor of
    extended / quantity), line total = extended * (1 - discount),
    discount = extended * discount. ``l_shipdate`` rides along as the
    landing's recency column."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
               "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
               "l_linestatus", "l_shipdate", wide=True)
    qty = F.col("l_quantity").cast("bigint")
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)  # exact: at most 2 decimals
    ext = F.col("l_extendedprice").cast("decimal(12,2)")    # precision <= 18: compact
    disc = F.col("l_discount").cast("decimal(3,2)")
    unit_cents = F.floor((cents * 2 + qty) / (qty * 2))      # cents / qty, half-up
    return li.select(
        uuid_like("item", F.col("l_orderkey"), F.col("l_linenumber")).alias("order_item_id"),
        uuid_like("order", F.col("l_orderkey")).alias("order_id"),
        uuid_like("product", F.col("l_partkey")).alias("product_id"),
        qty.alias("quantity"),
        (unit_cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).alias("unit_price"),
        (ext * (F.lit(1) - disc)).alias("line_total"),
        (ext * disc).alias("discount_amount"),
        F.when(F.col("l_returnflag") == "R", qty).otherwise(F.lit(0).cast("bigint"))
        .alias("return_quantity"),
        F.when(F.col("l_returnflag") == "R", F.lit("DAMAGED")).alias("return_reason"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"),
        # landing metadata kept for ordering and derived tables
        F.col("l_shipdate").alias("_shipdate"),
        F.col("l_suppkey").alias("_suppkey"),
        F.col("l_linestatus").alias("_linestatus"),
        F.col("l_tax").alias("_tax"),
        F.col("l_returnflag").alias("_returnflag"),
    )


def bronze_order_items_sql() -> str:
    cents = "floor(l_extendedprice * 100 + 0.5)"
    qty = "CAST(l_quantity AS BIGINT)"
    return f"""SELECT {uuid_sql('item', 'l_orderkey', 'l_linenumber')} AS order_item_id,
  {uuid_sql('order', 'l_orderkey')} AS order_id, {uuid_sql('product', 'l_partkey')} AS product_id,
  {qty} AS quantity,
  CAST(floor(({cents} * 2 + {qty}) / ({qty} * 2)) AS DECIMAL(18,0)) * 0.01 AS unit_price,
  CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS line_total,
  CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(3,2)) AS discount_amount,
  CASE WHEN l_returnflag = 'R' THEN {qty} ELSE CAST(0 AS BIGINT) END AS return_quantity,
  CASE WHEN l_returnflag = 'R' THEN 'DAMAGED' END AS return_reason,
  '{SCHEMA_VERSION}' AS _schema_version, l_shipdate AS _shipdate, l_suppkey AS _suppkey,
  l_linestatus AS _linestatus, l_tax AS _tax, l_returnflag AS _returnflag
FROM lineitem"""


# ---------------------------------------------------------------- clickstream
def bronze_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream events from ``events``.

    The landing delay (ingestion - event time) is ``value`` seconds times
    3, so about a fifth of the events arrive more than ten minutes late.
    """
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object(F.col("props"), "$.k")
    etype = (F.when(F.col("event_type") == "view", "PAGE_VIEW")
             .when(F.col("event_type") == "click", "PRODUCT_VIEW")
             .when(F.col("event_type") == "purchase", "PURCHASE")
             .when(F.col("event_type") == "signup", "ADD_TO_CART").otherwise("SEARCH"))
    return e.select(
        uuid_like("event", F.col("event_id")).alias("event_id"),
        F.concat(F.lit("S-"), F.col("user_id").cast("string"), F.lit("-"),
                 F.to_date(F.col("ts")).cast("string")).alias("session_id"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None).cast("string"))
        .otherwise(uuid_like("customer", F.col("user_id"))).alias("customer_id"),
        F.concat(F.lit("A-"), F.col("user_id").cast("string")).alias("anonymous_id"),
        etype.alias("event_type"),
        F.concat(F.lit("/p/"), k).alias("page_url"),
        F.lit(None).cast("string").alias("referrer_url"),
        F.when(F.col("event_type").isin("click", "signup"), uuid_like("product", k.cast("bigint")))
        .alias("product_id"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("q"), k)).alias("search_query"),
        F.col("ts").alias("event_timestamp"),
        (F.col("ts") + F.make_dt_interval(secs=(F.col("value") * 3).cast("decimal(18,6)")))
        .alias("ingestion_timestamp"),
        (F.when(F.col("user_id") % 3 == 0, "DESKTOP").when(F.col("user_id") % 3 == 1, "MOBILE")
         .otherwise("TABLET")).alias("device_type"),
        F.sha2(F.concat(F.lit("ua-"), F.col("user_id").cast("string")), 256).alias("user_agent_hash"),
        F.lit("US").alias("ip_country"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"),
    )


def bronze_clickstream_sql() -> str:
    k = "json_extract_string(props, '$.k')"
    return f"""SELECT {uuid_sql('event', 'event_id')} AS event_id,
  'S-' || CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
  CASE WHEN user_id % 5 = 0 THEN NULL ELSE {uuid_sql('customer', 'user_id')} END AS customer_id,
  'A-' || CAST(user_id AS VARCHAR) AS anonymous_id,
  CASE event_type WHEN 'view' THEN 'PAGE_VIEW' WHEN 'click' THEN 'PRODUCT_VIEW'
    WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN 'ADD_TO_CART' ELSE 'SEARCH' END AS event_type,
  '/p/' || {k} AS page_url, CAST(NULL AS VARCHAR) AS referrer_url,
  CASE WHEN event_type IN ('click','signup') THEN {uuid_sql('product', k)} END AS product_id,
  CASE WHEN event_type = 'error' THEN 'q' || {k} END AS search_query,
  ts AS event_timestamp,
  ts + to_microseconds(CAST(round(CAST(value * 3 AS DECIMAL(18,6)) * 1000000) AS BIGINT))
    AS ingestion_timestamp,
  CASE user_id % 3 WHEN 0 THEN 'DESKTOP' WHEN 1 THEN 'MOBILE' ELSE 'TABLET' END AS device_type,
  sha256('ua-' || CAST(user_id AS VARCHAR)) AS user_agent_hash, 'US' AS ip_country,
  '{SCHEMA_VERSION}' AS _schema_version
FROM events"""


# ---------------------------------------------------------------- inventory
def bronze_inventory(spark: SparkSession, sf_dir: str, before: str | None = None) -> DataFrame:
    """Inventory snapshot derived from lineitem: one row per (part, supplier).

    on hand = total quantity, reserved = quantity of open lines (status O),
    reorder level = 10, snapshot date = the latest ship date. Pre-aggregated
    (map-side partial aggregation) before the shuffle.
    """
    li = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus",
               "l_shipdate", wide=True)
    if before is not None:
        li = li.filter(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
    g = li.groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("on_hand"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("bigint"))
              .otherwise(F.lit(0).cast("bigint"))).alias("reserved"),
        F.max("l_shipdate").alias("last_ship"),
    )
    return g.select(
        uuid_like("inventory", F.col("l_partkey"), F.col("l_suppkey")).alias("inventory_id"),
        uuid_like("product", F.col("l_partkey")).alias("product_id"),
        F.concat(F.lit("WH-"), F.col("l_suppkey").cast("string")).alias("warehouse_id"),
        F.col("on_hand").alias("quantity_on_hand"),
        F.col("reserved").alias("quantity_reserved"),
        (F.col("on_hand") - F.col("reserved")).alias("quantity_available"),
        F.lit(10).cast("bigint").alias("reorder_level"),
        F.to_date(F.col("last_ship")).alias("snapshot_date"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"),
    )


def bronze_inventory_sql(before: str | None = None) -> str:
    where = f"WHERE l_shipdate < TIMESTAMP '{before}'" if before else ""
    return f"""SELECT {uuid_sql('inventory', 'l_partkey', 'l_suppkey')} AS inventory_id,
  {uuid_sql('product', 'l_partkey')} AS product_id, 'WH-' || CAST(l_suppkey AS VARCHAR) AS warehouse_id,
  on_hand AS quantity_on_hand, reserved AS quantity_reserved,
  on_hand - reserved AS quantity_available, CAST(10 AS BIGINT) AS reorder_level,
  CAST(last_ship AS DATE) AS snapshot_date, '{SCHEMA_VERSION}' AS _schema_version
FROM (SELECT l_partkey, l_suppkey, SUM(CAST(l_quantity AS BIGINT)) AS on_hand,
        SUM(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS reserved,
        MAX(l_shipdate) AS last_ship
      FROM lineitem {where} GROUP BY l_partkey, l_suppkey)"""


# ---------------------------------------------------------------- campaigns
CAMPAIGN_TYPES = ["EMAIL", "SMS", "PAID_SEARCH", "DISPLAY", "SOCIAL"]


def bronze_campaigns(spark: SparkSession, sf_dir: str, generation: int = 1) -> DataFrame:
    """Campaigns from ``supplier``, one each. Day 2 spends a tenth of the budget
    more and ends the campaigns of overdrawn suppliers (by rule). About a seventh
    ends before it starts."""
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    key, second = F.col("s_suppkey"), generation == 2
    start = F.date_add(F.lit("2024-01-01").cast("date"), (key % 300).cast("int"))
    budget = _dec(F.abs("s_acctbal") + 100)
    kinds = F.array(*[F.lit(t) for t in CAMPAIGN_TYPES])
    return s.select(
        uuid_like("campaign", key).alias("campaign_id"), F.col("s_name").alias("source_campaign_id"),
        F.concat(F.lit("Campaign "), key.cast("string")).alias("campaign_name"),
        F.get(kinds, (key % 5).cast("int")).alias("campaign_type"),
        F.lower(F.get(kinds, (key % 5).cast("int"))).alias("channel"), start.alias("start_date"),
        F.date_add(start, F.when(key % 7 == 0, -3).otherwise(30)).alias("end_date"), budget.alias("budget_amount"),
        (budget * F.lit(Decimal("0.60" if second else "0.50"))).alias("spent_amount"),
        F.when(key % 3 == 0, "GOLD").alias("target_segment"),
        (F.col("s_acctbal") >= 0 if second else F.lit(True)).alias("is_active"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("2024-02-01 00:00:00" if second else "2024-01-02 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"))


def bronze_campaigns_sql(generation: int = 1) -> str:
    second = generation == 2
    kind = f"{CAMPAIGN_TYPES!r}[CAST(s_suppkey % 5 + 1 AS INTEGER)]"
    budget = "CAST(abs(s_acctbal) + 100 AS DECIMAL(18,2))"
    return f"""SELECT {uuid_sql('campaign', 's_suppkey')} AS campaign_id, s_name AS source_campaign_id,
  'Campaign ' || CAST(s_suppkey AS VARCHAR) AS campaign_name, {kind} AS campaign_type, lower({kind}) AS channel,
  DATE '2024-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS start_date,
  DATE '2024-01-01' + CAST(s_suppkey % 300 AS INTEGER) + CASE WHEN s_suppkey % 7 = 0 THEN -3 ELSE 30 END AS end_date,
  {budget} AS budget_amount, {budget} * {'0.60' if second else '0.50'} AS spent_amount,
  CASE WHEN s_suppkey % 3 = 0 THEN 'GOLD' END AS target_segment, {'s_acctbal >= 0' if second else 'TRUE'} AS is_active,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '{'2024-02-01' if second else '2024-01-02'} 00:00:00' AS updated_at,
  '{SCHEMA_VERSION}' AS _schema_version
FROM supplier"""


# ---------------------------------------------------------------- messages
# Damage rules applied to landed event messages (first match wins):
#   error events of users divisible by 10 -> cut-off text        (invalid JSON)
#   value above 300                       -> free text            (invalid JSON)
#   signup events of user 7               -> a bare number        (not a JSON object)
#   view events of user 3                 -> trailing text        (invalid JSON)
#   click events of user 11               -> value_cents "abc"    (wrong type)
#   purchase events of user 5             -> bytes FF FE + text   (invalid UTF-8)
def _event_line(value_cents: Column) -> Column:
    return F.concat(
        F.lit('{"event_id": '), F.col("event_id").cast("string"),
        F.lit(', "ts": "'), F.col("ts").cast("string"),
        F.lit('", "user_id": '), F.col("user_id").cast("string"),
        F.lit(', "event_type": "'), F.col("event_type"),
        F.lit('", "value_cents": '), value_cents,
        F.lit(', "props": '), F.col("props"), F.lit("}"))


def event_messages(spark: SparkSession, sf_dir: str, damaged: bool = True,
                   redeliver: bool = False, with_date: bool = False) -> DataFrame:
    """Events as landed message text (column ``value``), damaged by rule.

    With ``redeliver`` every event of a user divisible by 4 is sent twice
    (same message), as a broker re-delivery would."""
    # landed as several files, as a message sink writes them
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props",
              wide=True)
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    line = _event_line(cents)
    if damaged:
        et, uid = F.col("event_type"), F.col("user_id")
        bad_utf8 = F.concat(F.unhex(F.lit("FFFE")),
                            F.encode(F.concat(F.lit(" INVALID UTF-8 "), F.col("event_id").cast("string")),
                                     "UTF-8")).cast("string")
        line = (F.when((et == "error") & (uid % 10 == 0), F.substring(line, 1, F.length(line) - 3))
                .when(F.col("value") > 300, F.concat(F.lit("NOT_JSON event "), F.col("event_id").cast("string")))
                .when((et == "signup") & (uid == 7), F.col("event_id").cast("string"))
                .when((et == "view") & (uid == 3), F.concat(line, F.lit(" trailing")))
                .when((et == "click") & (uid == 11), _event_line(F.lit('"abc"')))
                .when((et == "purchase") & (uid == 5), bad_utf8)
                .otherwise(line))
    out = e.select(line.alias("value"), F.col("user_id"), F.to_date("ts").alias("dt"))
    if redeliver:
        out = out.unionByName(out.filter(F.col("user_id") % 4 == 0))
    return out.select("value", "dt") if with_date else out.select("value")


def _event_line_sql(value_cents: str) -> str:
    return ("'{\"event_id\": ' || CAST(event_id AS VARCHAR) || ', \"ts\": \"' || CAST(ts AS VARCHAR) || "
            "'\", \"user_id\": ' || CAST(user_id AS VARCHAR) || ', \"event_type\": \"' || event_type || "
            f"'\", \"value_cents\": ' || {value_cents} || ', \"props\": ' || props || '}}'")


EVENT_CENTS_SQL = "CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)"
EVENT_LINE_SQL = _event_line_sql(EVENT_CENTS_SQL)
# The damage classes above as SQL, with the reason each gets.
EVENT_DAMAGE_SQL = [
    ("event_type = 'error' AND user_id % 10 = 0", f"substr(line, 1, length(line) - 3)", "invalid JSON"),
    ("value > 300", "'NOT_JSON event ' || CAST(event_id AS VARCHAR)", "invalid JSON"),
    ("event_type = 'signup' AND user_id = 7", "CAST(event_id AS VARCHAR)", "not a JSON object"),
    ("event_type = 'view' AND user_id = 3", "line || ' trailing'", "invalid JSON"),
    ("event_type = 'click' AND user_id = 11", _event_line_sql("'\"abc\"'"), "value_cents: expected bigint"),
    ("event_type = 'purchase' AND user_id = 5",
     "chr(65533) || chr(65533) || ' INVALID UTF-8 ' || CAST(event_id AS VARCHAR)", "invalid UTF-8"),
]


def event_damage_sql() -> str:
    """Every event with its landed payload and, when damaged, the reason
    and (for non-UTF-8 bytes) the base64 of the raw message."""
    payload = "CASE " + " ".join(f"WHEN {c} THEN {p}" for c, p, _ in EVENT_DAMAGE_SQL) + " ELSE line END"
    reason = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, _, r in EVENT_DAMAGE_SQL) + " END"
    b64 = ("CASE WHEN " + EVENT_DAMAGE_SQL[0][0] + " OR " + EVENT_DAMAGE_SQL[1][0] + " OR "
           + EVENT_DAMAGE_SQL[2][0] + " OR " + EVENT_DAMAGE_SQL[3][0] + " OR " + EVENT_DAMAGE_SQL[4][0]
           + " THEN NULL WHEN " + EVENT_DAMAGE_SQL[5][0]
           + " THEN base64(unhex('FFFE') || encode(' INVALID UTF-8 ' || CAST(event_id AS VARCHAR))) END")
    return (f"SELECT event_id, ts, user_id, event_type, {payload} AS payload, {reason} AS error_message, "
            f"{b64} AS payload_base64 FROM (SELECT *, {EVENT_LINE_SQL} AS line FROM events) AS e")


# Arrival rules for events that land batch by batch. A month of events is
# squeezed to about 43 minutes, so that windows hold many events and lateness
# counts; messages land in eight-minute slices of their arrival:
#   event_id % 20 = 7   -> arrives 5 minutes late    (within the lateness)
#   event_id % 20 = 13  -> arrives 15 minutes late   (mostly beyond it)
#   event_id % 50 = 11  -> claims a time 1 hour ahead of its arrival
ARRIVAL_BASE = "2024-01-01 00:00:00"
SQUEEZE = 1000
SLICE_S = 480
SLICES = 8


def event_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(slice, value): message lines with ``ts`` and ``arrived_at``."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    base = F.unix_micros(F.lit(ARRIVAL_BASE).cast("timestamp"))
    t = base + F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - base) / SQUEEZE)
    late_s = F.when(F.col("event_id") % 20 == 7, 300).when(F.col("event_id") % 20 == 13, 900).otherwise(0)
    e = e.withColumn("t", t).withColumn("arrival", F.col("t") + late_s * 1_000_000)
    claimed = F.when(F.col("event_id") % 50 == 11, F.col("t") + 3_600_000_000).otherwise(F.col("t"))
    line = F.to_json(F.struct(
        "event_id", F.timestamp_micros(claimed).cast("string").alias("ts"), "user_id", "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("value_cents"),
        F.timestamp_micros("arrival").cast("string").alias("arrived_at")))
    slice_ = F.least(F.floor((F.col("arrival") - base) / (SLICE_S * 1_000_000)), F.lit(SLICES - 1))
    return e.select(slice_.cast("int").alias("slice"), line.alias("value"))


EVENT_ARRIVALS_SQL = f"""SELECT event_id, t, t + late AS arrival, event_id % 50 = 11 AS ahead,
  least((t + late - base) // {SLICE_S * 1_000_000}, {SLICES - 1}) AS slice
FROM (SELECT event_id, base, base + (epoch_us(ts) - base) // {SQUEEZE} AS t,
        CASE event_id % 20 WHEN 7 THEN 300000000 WHEN 13 THEN 900000000 ELSE 0 END AS late
      FROM events, (SELECT epoch_us(TIMESTAMP '{ARRIVAL_BASE}') AS base) AS b) AS e"""


# Re-delivery rules, on the same squeezed arrivals:
#   event_id % 10 = 3  -> the same message again 4 minutes after it came
#   event_id % 10 = 6  -> the same message again 6 minutes after it came
def event_redeliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(slice, value): messages and their re-deliveries by arrival."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    base = F.unix_micros(F.lit(ARRIVAL_BASE).cast("timestamp"))
    e = e.withColumn("t", base + F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - base) / SQUEEZE))
    again = F.when(F.col("event_id") % 10 == 3, F.array(F.lit(0), F.lit(240))).when(
        F.col("event_id") % 10 == 6, F.array(F.lit(0), F.lit(360))).otherwise(F.array(F.lit(0)))
    e = e.withColumn("later", F.explode(again)).withColumn("arrival", F.col("t") + F.col("later").cast("long") * 1_000_000)
    line = F.to_json(F.struct(
        "event_id", F.timestamp_micros("t").cast("string").alias("ts"), "user_id", "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("value_cents"),
        F.timestamp_micros("arrival").cast("string").alias("arrived_at")))
    slice_ = F.least(F.floor((F.col("arrival") - base) / (SLICE_S * 1_000_000)), F.lit(SLICES - 1))
    return e.select(slice_.cast("int").alias("slice"), line.alias("value"))


# Damage rules for landed order messages, after the three bad order
# messages of the reference's publisher (first match wins):
#   PENDING URGENT orders -> cut-off text        (invalid JSON)
#   PENDING LOW orders    -> free text           (invalid JSON)
#   PENDING HIGH orders   -> unquoted keys       (invalid JSON)
def _order_line(o_key: Column, c_key: Column, status: Column, date: Column, amount: Column) -> Column:
    return F.concat(F.lit('{"order_id": "'), o_key, F.lit('", "customer_id": "'), c_key,
                    F.lit('", "order_status": "'), status, F.lit('", "order_date": "'), date,
                    F.lit('", "total_amount": '), amount, F.lit("}"))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
              "o_orderdate", "o_orderpriority", wide=True)
    status = (F.when(F.col("o_orderstatus") == "F", "DELIVERED")
              .when(F.col("o_orderstatus") == "O", "SHIPPED").otherwise("PENDING"))
    oid = uuid_like("order", F.col("o_orderkey"))
    line = _order_line(oid, uuid_like("customer", F.col("o_custkey")), status,
                       F.col("o_orderdate").cast("string"),
                       F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    pend = F.col("o_orderstatus") == "P"
    pr = F.col("o_orderpriority")
    line = (F.when(pend & (pr == "1-URGENT"), F.substring(line, 1, F.length(line) - 10))
            .when(pend & (pr == "5-LOW"), F.concat(F.lit("This is not JSON at all: "), oid))
            .when(pend & (pr == "2-HIGH"), F.concat(F.lit("{order_id: "), oid, F.lit(", broken quotes}")))
            .otherwise(line))
    return o.select(line.alias("value"))


ORDER_DAMAGE_WHERE = ("o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '5-LOW', '2-HIGH')")
