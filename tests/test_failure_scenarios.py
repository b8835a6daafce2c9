"""The reference's failure scenarios (FS-0xx) that concern data, each
reproduced on DataFrames and checked for the intended behaviour."""

import datetime as dt
import json

from pyspark.sql import types as T

from goldleaf.plans.silver import silver_model
from goldleaf.quality.contracts import foreign_key_check, late_flag
from goldleaf.quality.schema_check import ENTITY_SCHEMAS, split_by_schema
from goldleaf.session import scratch_path
from goldleaf.sources.bronze import (list_files, manifest_entries, read_landed, split_corrupt,
                                     unseen_files, with_ingest_metadata)
from goldleaf.streaming.parse import dead_letters, good_rows, parse_messages

ORDER_SCHEMA = T.StructType([T.StructField("order_id", T.StringType()),
                             T.StructField("order_status", T.StringType()),
                             T.StructField("total_amount", T.DoubleType()),
                             T.StructField("updated_at", T.StringType()),
                             T.StructField("_schema_version", T.StringType())])


def _order(oid, status="PENDING", amount=10.0, ts="2024-01-01T00:00:00", version="1.0", **extra):
    return json.dumps({"order_id": oid, "order_status": status, "total_amount": amount,
                       "updated_at": ts, "_schema_version": version, **extra})


def _land_lines(spark, root, lines, dt_="2024-01-01"):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("append").text(f"{root}/orders/dt={dt_}")


def test_fs002_duplicate_file_delivered_twice(spark):
    root = scratch_path(spark, "fs002")
    lines = [_order("o1"), _order("o2")]
    _land_lines(spark, root, lines)
    manifest = manifest_entries(list_files(spark, f"{root}/orders"), "run-1")
    _land_lines(spark, root, lines)  # the same content delivered again as a new file
    loaded = with_ingest_metadata(split_corrupt(read_landed(spark, root, "orders", ORDER_SCHEMA))[0], "run-2")
    new_rows = unseen_files(loaded, manifest).collect()
    assert len(new_rows) == 2  # only the new file's rows are picked up by the manifest ...
    silver, _ = silver_model(loaded, "orders")
    assert sorted(r.order_id for r in silver.collect()) == ["o1", "o2"]  # ... and dedup absorbs them


def test_fs003_fs009_invalid_and_truncated_lines_go_to_quarantine(spark):
    root = scratch_path(spark, "fs009")
    full = _order("o3")
    _land_lines(spark, root, [_order("o1"), "NOT JSON", _order("o2"), full[: len(full) // 2]])
    good, bad = split_corrupt(read_landed(spark, root, "orders", ORDER_SCHEMA))
    assert sorted(r.order_id for r in good.collect()) == ["o1", "o2"]
    assert sorted(r.payload for r in bad.collect()) == sorted(["NOT JSON", full[: len(full) // 2]])


def test_fs004_missing_required_field(spark):
    rec = json.loads(_order("0a0e0a00-0000-4000-8000-000000000001"))
    df = spark.createDataFrame([(json.dumps(rec),)], "value string")
    _, invalid = split_by_schema(df, "value", ENTITY_SCHEMAS["orders"])
    errs = invalid.first()._validation_errors
    assert "'customer_id' is a required property" in errs
    # a record without its key never reaches silver: it is quarantined
    bronze = spark.createDataFrame([(None, "PENDING", dt.datetime(2024, 1, 1), "1.0")],
                                   "order_id string, order_status string, updated_at timestamp, "
                                   "_schema_version string")
    silver, quarantine = silver_model(bronze, "orders")
    assert silver.count() == 0 and quarantine.count() == 1


def test_fs005_new_field_is_ignored_by_load_and_flagged_by_schema(spark):
    root = scratch_path(spark, "fs005")
    _land_lines(spark, root, [_order("o1", loyalty_tier="GOLD")])
    good, bad = split_corrupt(read_landed(spark, root, "orders", ORDER_SCHEMA))
    assert [r.order_id for r in good.collect()] == ["o1"] and bad.collect() == []
    df = spark.createDataFrame([(_order("o1", loyalty_tier="GOLD"),)], "value string")
    _, invalid = split_by_schema(df, "value", ENTITY_SCHEMAS["orders"])
    assert any("loyalty_tier" in e for e in invalid.first()._validation_errors)


def test_fs006_breaking_type_change_is_quarantined(spark):
    bronze = spark.createDataFrame(
        [("o1", "12.5", "2024-01-01 00:00:00", "1.0"), ("o2", "lots", "2024-01-01 00:00:00", "1.0"),
         ("o3", "7", "2024-01-01 00:00:00", "2.0")],
        "order_id string, total_amount string, updated_at string, _schema_version string")
    silver, quarantine = silver_model(bronze, "orders", on_error="quarantine", accept_versions=["1.0"])
    assert [r.order_id for r in silver.collect()] == ["o1"]
    reasons = {r.order_id: list(r._validation_errors) for r in quarantine.collect()}
    assert reasons["o2"] == ["total_amount: cannot cast to decimal(38,9)"]
    assert reasons["o3"] == ["unsupported schema version"]


def test_fs008_order_with_unknown_customer(spark):
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c404")], "order_id string, customer_id string")
    customers = spark.createDataFrame([("c1",)], "customer_id string")
    r = foreign_key_check(orders, "customer_id", customers, "customer_id", "orders_customer", "silver",
                          "run").first()
    assert (r.failed_records, r.status, r.severity) == (1, "FAILED", "LOW")


def test_fs016_late_event_is_flagged_not_lost(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12, 0), dt.datetime(2024, 1, 1, 12, 30)),
                                (dt.datetime(2024, 1, 1, 12, 0), dt.datetime(2024, 1, 1, 12, 1))],
                               "event_timestamp timestamp, ingestion_timestamp timestamp")
    flags = sorted(r._is_late_arrival for r in
                   late_flag(df, "event_timestamp", "ingestion_timestamp", 10).collect())
    assert flags == [False, True]


def test_fs017_poison_messages_never_stop_the_parse(spark):
    msgs = [b"\xff\xfe\x00", b"{", b"", b'{"a": 1}', b"\x00\x01binary"]
    parsed = parse_messages(spark.createDataFrame([(m,) for m in msgs], "value binary"), "orders")
    assert good_rows(parsed).count() == 1
    assert dead_letters(parsed).count() == 4
