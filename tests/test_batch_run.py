"""End-to-end batch run over landed files; a rerun leaves gold unchanged (M8)."""


from pyspark.sql import functions as F

from goldleaf.plans.batch_run import run_batch
from goldleaf.session import scratch_path
from goldleaf.sources import testdata as td
from goldleaf.sources.tables import read_table

from .conftest import SF_SMALL

TS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _land(df, landing, entity):
    (df.withColumn("dt", F.lit("2024-01-01").cast("date")).write.options(**TS)
     .mode("append").partitionBy("dt").json(f"{landing}/{entity}"))


def test_batch_run_end_to_end_and_idempotent(spark):
    root = scratch_path(spark, "t-batch")
    landing, wh = f"{root}/landing", f"{root}/warehouse"
    items = td.bronze_order_items(spark, SF_SMALL).drop("_shipdate", "_suppkey", "_linestatus", "_tax",
                                                        "_returnflag")
    frames = {"customers": td.bronze_customers(spark, SF_SMALL, 1),
              "products": td.bronze_products(spark, SF_SMALL, 1),
              "orders": td.bronze_orders(spark, SF_SMALL, 1),
              "order_items": items,
              "inventory": td.bronze_inventory(spark, SF_SMALL),
              "clickstream_events": td.bronze_clickstream(spark, SF_SMALL),
              "campaigns": spark.createDataFrame(
                  [("0a0b0c0d-0000-4000-8000-000000000001", "SRC-1", "Spring", "EMAIL", "email",
                    "2024-01-01", "2024-02-01", 100.0, 10.0, None, True, "2024-01-01T00:00:00",
                    "2024-01-01T00:00:00", "1.0")],
                  "campaign_id string, source_campaign_id string, campaign_name string, "
                  "campaign_type string, channel string, start_date string, end_date string, "
                  "budget_amount double, spent_amount double, target_segment string, "
                  "is_active boolean, created_at string, updated_at string, _schema_version string")}
    for entity, df in frames.items():
        _land(df, landing, entity)
    steps = run_batch(spark, landing, wh, run_id="r1", as_of="2024-01-02 00:00:00")
    assert all(s["status"] in ("SUCCESS", "SKIPPED") for s in steps), steps
    g1 = {t: sorted(read_table(spark, f"{wh}/gold", t).collect())
          for t in ["fact_orders", "dim_customers", "dim_products", "dim_campaigns", "fact_clickstream"]}
    assert len(g1["fact_orders"]) == items.select("order_item_id").distinct().count()
    assert len(g1["dim_customers"]) == 150 and len(g1["dim_campaigns"]) == 1
    silver_orders = read_table(spark, f"{wh}/silver", "orders")
    meta = silver_orders.select("_record_hash", "_source_file", "_pipeline_run_id").first()
    assert len(meta._record_hash) == 32 and meta._source_file and meta._pipeline_run_id == "r1"
    quarantine = spark.read.parquet(f"{wh}/silver_quarantine/order_items")
    assert quarantine.count() == 0
    steps = run_batch(spark, landing, wh, run_id="r2", as_of="2024-01-02 00:00:00")
    # the same records landed again: the hash-guarded MERGE keeps run 1's rows
    assert read_table(spark, f"{wh}/silver", "orders").filter("_pipeline_run_id = 'r1'").count() \
        == silver_orders.count()
    for t, rows in g1.items():
        assert sorted(read_table(spark, f"{wh}/gold", t).collect()) == rows, t
    dq = spark.read.parquet(f"{wh}/quality/dq_results")
    assert dq.filter("pipeline_run_id = 'r2'").count() == 3
    models = spark.read.parquet(f"{wh}/audit/model_runs").filter("run_id = 'r2'")
    assert models.count() == 14 and models.filter("status = 'SUCCESS'").count() == 14
    audit = spark.read.parquet(f"{wh}/audit/pipeline_runs")
    assert audit.filter("status = 'SUCCESS'").count() == 14


def test_failed_model_ends_the_run_before_gold(spark, monkeypatch):
    from goldleaf.plans import batch_run
    root = scratch_path(spark, "t-batch-fail")
    _land(td.bronze_customers(spark, SF_SMALL, 1), f"{root}/landing", "customers")
    real = batch_run._silver_step

    def broken(spark, warehouse, entity, dt):
        if entity == "orders":
            raise RuntimeError("x" * 900)
        return real(spark, warehouse, entity, dt)

    monkeypatch.setattr(batch_run, "_silver_step", broken)
    steps = run_batch(spark, f"{root}/landing", f"{root}/wh", run_id="r1")
    failed = [s for s in steps if s["status"] == "FAILED" and not s["model"].startswith("bronze.")]
    assert len(failed) == 1 and len(failed[0]["error"]) > 900
    assert not any(s["model"].startswith(("gold.", "quality.")) for s in steps)
    assert read_table(spark, f"{root}/wh/gold", "dim_customers") is None
