"""Entity and output schemas.

Silver column types follow the reference's typed DDL: STRING -> string,
INT64 -> bigint, NUMERIC -> decimal(38,9), BOOL -> boolean, DATE -> date,
TIMESTAMP -> timestamp. One ordered dict per entity drives the typed
projection (P1) and the empty-table DDL (S13).
"""

from __future__ import annotations

from pyspark.sql import types as T

NUMERIC = "decimal(38,9)"

# The contract version in force per entity.
CURRENT_VERSIONS = {e: "1.0" for e in ("customers", "products", "campaigns", "inventory", "orders", "order_items",
                                       "clickstream_events")}

# Silver column lists and types per entity (order = DDL order).
SILVER_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "customers": [
        ("customer_id", "string"), ("source_customer_id", "string"), ("email_hash", "string"),
        ("first_name", "string"), ("last_name", "string"), ("country_code", "string"),
        ("city", "string"), ("signup_date", "date"), ("customer_segment", "string"),
        ("loyalty_points", "bigint"), ("is_active", "boolean"), ("created_at", "timestamp"),
        ("updated_at", "timestamp"), ("_schema_version", "string"),
    ],
    "products": [
        ("product_id", "string"), ("source_product_id", "string"), ("sku", "string"),
        ("product_name", "string"), ("category_l1", "string"), ("category_l2", "string"),
        ("brand", "string"), ("unit_price", NUMERIC), ("cost_price", NUMERIC),
        ("is_active", "boolean"), ("created_at", "timestamp"), ("updated_at", "timestamp"),
        ("_schema_version", "string"),
    ],
    "campaigns": [
        ("campaign_id", "string"), ("source_campaign_id", "string"), ("campaign_name", "string"),
        ("campaign_type", "string"), ("channel", "string"), ("start_date", "date"),
        ("end_date", "date"), ("budget_amount", NUMERIC), ("spent_amount", NUMERIC),
        ("target_segment", "string"), ("is_active", "boolean"), ("created_at", "timestamp"),
        ("updated_at", "timestamp"), ("_schema_version", "string"),
    ],
    "inventory": [
        ("inventory_id", "string"), ("product_id", "string"), ("warehouse_id", "string"),
        ("quantity_on_hand", "bigint"), ("quantity_reserved", "bigint"),
        ("quantity_available", "bigint"), ("reorder_level", "bigint"),
        ("snapshot_date", "date"), ("_schema_version", "string"),
    ],
    "orders": [
        ("order_id", "string"), ("source_order_id", "string"), ("customer_id", "string"),
        ("campaign_id", "string"), ("order_status", "string"), ("order_date", "timestamp"),
        ("shipped_date", "timestamp"), ("delivered_date", "timestamp"),
        ("total_amount", NUMERIC), ("discount_amount", NUMERIC), ("tax_amount", NUMERIC),
        ("currency_code", "string"), ("channel", "string"), ("created_at", "timestamp"),
        ("updated_at", "timestamp"), ("_schema_version", "string"),
    ],
    "order_items": [
        ("order_item_id", "string"), ("order_id", "string"), ("product_id", "string"),
        ("quantity", "bigint"), ("unit_price", NUMERIC), ("line_total", NUMERIC),
        ("discount_amount", NUMERIC), ("return_quantity", "bigint"),
        ("return_reason", "string"), ("_schema_version", "string"),
    ],
    "clickstream_events": [
        ("event_id", "string"), ("session_id", "string"), ("customer_id", "string"),
        ("anonymous_id", "string"), ("event_type", "string"), ("event_timestamp", "timestamp"),
        ("ingestion_timestamp", "timestamp"), ("page_url", "string"), ("referrer_url", "string"),
        ("product_id", "string"), ("search_query", "string"),
        ("device_type", "string"), ("user_agent_hash", "string"), ("ip_country", "string"),
        ("_schema_version", "string"),
    ],
}

# Business key of each entity.
PRIMARY_KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "campaigns": ["campaign_id"],
    "inventory": ["inventory_id"],
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
    "clickstream_events": ["event_id"],
}

# Gold table columns (order = DDL order).
GOLD_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "dim_customers": [
        ("customer_sk", "string"), ("customer_id", "string"), ("email_hash", "string"),
        ("first_name", "string"), ("last_name", "string"), ("country_code", "string"),
        ("city", "string"), ("customer_segment", "string"), ("valid_from", "timestamp"),
        ("valid_to", "timestamp"), ("is_current", "boolean"),
    ],
    "dim_products": [
        ("product_id", "string"), ("sku", "string"), ("product_name", "string"),
        ("category_l1", "string"), ("category_l2", "string"), ("brand", "string"),
        ("unit_price", NUMERIC), ("cost_price", NUMERIC), ("is_active", "boolean"),
    ],
    "dim_campaigns": [
        ("campaign_id", "string"), ("campaign_name", "string"), ("campaign_type", "string"),
        ("channel", "string"), ("start_date", "date"), ("end_date", "date"),
        ("budget_amount", NUMERIC), ("target_segment", "string"), ("is_active", "boolean"),
    ],
    "dim_date": [
        ("date_key", "date"), ("year", "bigint"), ("quarter", "bigint"), ("month", "bigint"),
        ("day", "bigint"), ("day_of_week", "bigint"), ("is_weekend", "boolean"),
    ],
    "fact_orders": [
        ("order_id", "string"), ("customer_id", "string"), ("campaign_id", "string"),
        ("order_item_id", "string"), ("product_id", "string"), ("order_date", "timestamp"),
        ("order_status", "string"), ("quantity", "bigint"), ("unit_price", NUMERIC),
        ("line_total", NUMERIC), ("item_discount", NUMERIC), ("order_channel", "string"),
        ("currency_code", "string"),
    ],
    "fact_inventory_daily": [
        ("inventory_id", "string"), ("product_id", "string"), ("warehouse_id", "string"),
        ("snapshot_date", "date"), ("quantity_on_hand", "bigint"),
        ("quantity_reserved", "bigint"), ("quantity_available", "bigint"),
    ],
    "fact_clickstream": [
        ("event_id", "string"), ("session_id", "string"), ("customer_id", "string"),
        ("product_id", "string"), ("event_type", "string"), ("event_timestamp", "timestamp"),
        ("page_url", "string"), ("device_type", "string"), ("ip_country", "string"),
    ],
}

# Quality output table.
DQ_RESULT_COLUMNS = [
    ("rule_name", "string"), ("dataset_name", "string"), ("table_name", "string"),
    ("column_name", "string"), ("total_records", "bigint"), ("failed_records", "bigint"),
    ("severity", "string"), ("status", "string"), ("pipeline_run_id", "string"),
    ("error_details", "string"), ("checked_at", "timestamp"), ("failure_pct", "double"),
]


def ddl(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in columns)


def struct_type(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType.fromDDL(ddl(columns))


def empty_frame(spark, columns: list[tuple[str, str]]):
    """CREATE TABLE IF NOT EXISTS equivalent: an empty, typed frame."""
    return spark.createDataFrame([], struct_type(columns))
