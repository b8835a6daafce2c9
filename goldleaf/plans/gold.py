"""Gold models: dimensions and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import skew_join
from ..operators.merge import upsert
from ..operators.scd import scd1, scd2
from ..schemas import GOLD_COLUMNS

# Columns each gold model takes from silver.
DIM_PRODUCT_COLS = ["sku", "product_name", "category_l1", "category_l2", "brand",
                    "unit_price", "cost_price", "is_active"]
DIM_CAMPAIGN_COLS = ["campaign_name", "campaign_type", "channel", "start_date", "end_date",
                     "budget_amount", "target_segment", "is_active"]
DIM_CUSTOMER_ATTRS = ["email_hash", "first_name", "last_name", "country_code", "city",
                      "customer_segment"]
DIM_CUSTOMER_TRACKED = ["email_hash", "customer_segment"]
FACT_INVENTORY_COLS = ["product_id", "warehouse_id", "snapshot_date", "quantity_on_hand",
                       "quantity_reserved", "quantity_available"]
FACT_CLICK_COLS = ["session_id", "customer_id", "product_id", "event_type", "event_timestamp",
                   "page_url", "device_type", "ip_country"]


def _cols(table: str) -> list[str]:
    return [c for c, _ in GOLD_COLUMNS[table]]


def fact_orders_source(orders: DataFrame, items: DataFrame) -> DataFrame:
    """J1 + P4: item-grain facts. Inner join: orders without items and
    orphan items drop out, as in the reference. A hot order is split.

    Silver items hold each ``order_item_id`` once and lie partitioned by it, which
    is also the MERGE's key. So only the two ids go to the orders, the order's
    columns come back by item id, and the items' own columns stay where they are:
    neither this join nor the MERGE moves them again. Items without an id (silver
    holds some only with that check switched off) go to the orders themselves."""
    o = orders.select("order_id", "customer_id", "campaign_id", "order_date", "order_status",
                      F.col("channel").alias("order_channel"), "currency_code")
    i = items.select("order_id", "order_item_id", "product_id", "quantity", "unit_price",
                     "line_total", F.col("discount_amount").alias("item_discount"))
    found = skew_join(i.select("order_id", "order_item_id"), o, ["order_id"]).drop("order_id")
    unnamed = skew_join(o, i.where(F.col("order_item_id").isNull()), ["order_id"])
    return i.join(found, "order_item_id").select(*_cols("fact_orders")).unionByName(unnamed.select(*_cols("fact_orders")))


def fact_orders(orders: DataFrame, items: DataFrame, target: DataFrame | None = None,
                with_target: bool = False) -> DataFrame:
    """M3: on match every column but ``order_id`` is rewritten. ``with_target``
    keeps the target's row beside the merged one (see ``upsert``)."""
    src = fact_orders_source(orders, items)
    if target is None:
        return src
    update = [c for c in _cols("fact_orders") if c not in ("order_id", "order_item_id")]
    return upsert(target, src, ["order_item_id"], update_cols=update, keys_not_null=True, with_target=with_target)


def dim_products(silver_products: DataFrame, dim: DataFrame) -> DataFrame:
    return scd1(dim, silver_products, ["product_id"], DIM_PRODUCT_COLS).select(*_cols("dim_products"))


def dim_campaigns(silver_campaigns: DataFrame, dim: DataFrame) -> DataFrame:
    return scd1(dim, silver_campaigns, ["campaign_id"], DIM_CAMPAIGN_COLS).select(*_cols("dim_campaigns"))


def dim_customers(silver_customers: DataFrame, dim: DataFrame, null_safe: bool = False) -> DataFrame:
    out = scd2(dim, silver_customers, "customer_id", DIM_CUSTOMER_TRACKED, DIM_CUSTOMER_ATTRS,
               valid_from="updated_at", sk_col="customer_sk", null_safe=null_safe)
    return out.select(*_cols("dim_customers"))


def fact_inventory_daily(silver_inventory: DataFrame, target: DataFrame) -> DataFrame:
    """Keyed by ``inventory_id`` only: a re-used id overwrites the earlier
    snapshot (the reference's behaviour despite the name)."""
    return scd1(target, silver_inventory, ["inventory_id"], FACT_INVENTORY_COLS).select(
        *_cols("fact_inventory_daily"))


def fact_clickstream(silver_click: DataFrame, target: DataFrame) -> DataFrame:
    return scd1(target, silver_click, ["event_id"], FACT_CLICK_COLS).select(*_cols("fact_clickstream"))


# The columns of the facts that daily sales read.
DAILY_SALES_READS = ["order_id", "order_date", "order_channel", "currency_code", "line_total", "item_discount", "quantity"]


def daily_sales(facts: DataFrame) -> DataFrame:
    """A10: day x channel x currency roll-up of item facts. Partial
    aggregation runs map-side; the distinct order count adds one shuffle
    keyed by (group, order_id)."""
    return (facts.groupBy(F.to_date("order_date").alias("sales_date"), "order_channel",
                          "currency_code")
            .agg(F.sum("line_total").cast("decimal(38,9)").alias("revenue"),
                 F.sum("item_discount").cast("decimal(38,9)").alias("discount"),
                 F.sum("quantity").alias("units"),
                 F.countDistinct("order_id").alias("n_orders"),
                 F.count("*").alias("n_items")))
