"""The batch run: landing -> bronze -> silver -> gold -> checks.

Keeps the reference's dependency order (7 silver models, then 4
dimensions, then 3 facts, then the post-run checks) without rebuilding a
scheduler: models of one layer do not depend on each other and are
submitted from a small thread pool (Spark runs jobs from several threads
concurrently); layers run one after the other.

Tables live under ``warehouse`` as versioned directories
(``sources.tables``): a model reads the current version of its inputs and
target, writes the next version, then moves the pointer. A failed model
leaves the previous version in place, and a rerun over the same landing
yields the same tables: files that a committed load has taken are not loaded
again (S15), and quarantine gets each refused row once (S18).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_dim
from ..quality.checks import CriticalQualityError, _result_cols, halt_on_critical
from ..quality.contracts import foreign_key_check
from ..schemas import CURRENT_VERSIONS, GOLD_COLUMNS, SILVER_COLUMNS, empty_frame, struct_type
from ..sources.bronze import committed_bronze, load_entities
from ..sources.tables import publish, read_if_exists, read_table
from . import gold, silver

# Model order of the reference's runner.
SILVER_ENTITIES = ["customers", "products", "campaigns", "inventory", "orders", "order_items",
                   "clickstream_events"]
POOL = 4
# Ingest metadata kept on silver rows, with types.
SILVER_METADATA = [("_ingestion_ts", "timestamp"), ("_pipeline_run_id", "string"),
                   ("_source_file", "string"), ("_record_hash", "string")]


def bronze_schema(entity: str) -> T.StructType:
    """Raw landing types: numbers as double/bigint, times as text (cast at
    silver, where a bad value is quarantined rather than guessed)."""
    raw = {"timestamp": "string", "date": "string", "boolean": "boolean", "bigint": "bigint",
           "string": "string"}
    cols = [(c, raw.get(t, "double")) for c, t in SILVER_COLUMNS[entity]]
    return struct_type(cols)


# The reference's quarantine switches and their defaults. A run
# reads them from the session under this prefix, e.g.
# ``--conf spark.goldleaf.quarantine_on_null_key=false``.
SWITCHES = {"quarantine_on_schema_failure": True, "quarantine_on_null_key": True,
            "halt_on_referential_integrity_failure": False}
SWITCH_PREFIX = "spark.goldleaf."
QUARANTINE_DAYS = 30


def switch(spark: SparkSession, name: str) -> bool:
    """C14: one of the run's switches."""
    return spark.conf.get(SWITCH_PREFIX + name, str(SWITCHES[name])).lower() == "true"


def _model(spark: SparkSession, bronze: DataFrame, entity: str, target: DataFrame | None):
    """The silver model of an entity under the run's contract version and switches."""
    return silver.silver_model(
        bronze, entity, target=target, current_version=CURRENT_VERSIONS[entity],
        on_error="quarantine" if switch(spark, "quarantine_on_schema_failure") else "null",
        null_keys_too=not switch(spark, "quarantine_on_null_key"))


def _manifest(warehouse: str) -> str:
    return f"{warehouse}/control/file_manifest"


def _quarantine(spark: SparkSession, warehouse: str, entity: str, bronze: DataFrame) -> None:
    """What silver refuses of each run's loads, once. A run's rows go to a
    folder named after the run, overwritten when the step is repeated, and the run
    is noted down afterwards; runs that loaded nothing add nothing."""
    log = f"{warehouse}/control/quarantined_runs/{entity}"  # of its own: models of a layer write at the same time
    loads = spark.read.parquet(_manifest(warehouse)).where(F.col("entity") == entity)
    runs = loads.groupBy("_pipeline_run_id").agg(F.min("committed_at").alias("committed_at"))
    done = read_if_exists(spark.read.parquet, log)
    if done is not None:
        runs = runs.join(done, "_pipeline_run_id", "left_anti")
    for run in runs.collect():  # the runs since this step last ended: one, unless runs died
        _, refused = _model(spark, bronze.where(F.col("_pipeline_run_id") == run["_pipeline_run_id"]), entity, None)
        (refused.withColumn("quarantined_at", F.lit(run["committed_at"]).cast("timestamp")).write.mode("overwrite")
         .parquet(f"{warehouse}/silver_quarantine/{entity}/loaded_by={run['_pipeline_run_id']}"))
        spark.createDataFrame([(run["_pipeline_run_id"],)], "_pipeline_run_id string") \
            .coalesce(1).write.mode("append").parquet(log)


def read_quarantine(spark: SparkSession, warehouse: str, entity: str, as_of: str | None = None,
                    days: int = QUARANTINE_DAYS) -> DataFrame:
    """Quarantined rows not older than ``days`` (S18 expiry)."""
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    held = spark.read.parquet(f"{warehouse}/silver_quarantine/{entity}")
    return held.where(F.col("quarantined_at") >= now - F.make_dt_interval(days=F.lit(days)))


def _silver_step(spark: SparkSession, warehouse: str, entity: str, dt: str | None) -> dict:
    bronze = committed_bronze(spark, f"{warehouse}/bronze", entity, _manifest(warehouse))
    if bronze is None:
        return {"model": f"silver.{entity}", "status": "SKIPPED"}
    target = read_table(spark, f"{warehouse}/silver", entity,
                        empty_schema=struct_type(SILVER_COLUMNS[entity] + SILVER_METADATA))
    of_date = bronze if dt is None else bronze.filter(F.col("_ingestion_date") == F.lit(dt).cast("date"))
    model, _ = _model(spark, of_date, entity, target)
    v = publish(model, f"{warehouse}/silver", entity)
    _quarantine(spark, warehouse, entity, bronze)
    return {"model": f"silver.{entity}", "status": "SUCCESS", "version": v}


def _gold(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    return read_table(spark, f"{warehouse}/gold", name, empty_schema=struct_type(GOLD_COLUMNS[name]))


def _silver(spark: SparkSession, warehouse: str, entity: str) -> DataFrame:
    return read_table(spark, f"{warehouse}/silver", entity,
                      empty_schema=struct_type(SILVER_COLUMNS[entity]))


def _dim_step(spark: SparkSession, warehouse: str, name: str) -> dict:
    if name == "dim_date":
        df = date_dim(spark)
    elif name == "dim_products":
        df = gold.dim_products(_silver(spark, warehouse, "products"), _gold(spark, warehouse, name))
    elif name == "dim_campaigns":
        df = gold.dim_campaigns(_silver(spark, warehouse, "campaigns"), _gold(spark, warehouse, name))
    else:
        df = gold.dim_customers(_silver(spark, warehouse, "customers"), _gold(spark, warehouse, name))
    return {"model": f"gold.{name}", "status": "SUCCESS",
            "version": publish(df, f"{warehouse}/gold", name)}


def _fact_step(spark: SparkSession, warehouse: str, name: str) -> dict:
    if name == "fact_orders":
        df = gold.fact_orders(_silver(spark, warehouse, "orders"), _silver(spark, warehouse, "order_items"),
                              target=_gold(spark, warehouse, name))
    elif name == "fact_inventory_daily":
        df = gold.fact_inventory_daily(_silver(spark, warehouse, "inventory"), _gold(spark, warehouse, name))
    else:
        df = gold.fact_clickstream(_silver(spark, warehouse, "clickstream_events"),
                                   _gold(spark, warehouse, name))
    return {"model": f"gold.{name}", "status": "SUCCESS",
            "version": publish(df, f"{warehouse}/gold", name)}


def post_run_checks(spark: SparkSession, warehouse: str, run_id: str,
                    as_of: str | None = None) -> DataFrame:
    """The three post-run checks as ``dq_results`` rows."""
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    orders = _silver(spark, warehouse, "orders")
    facts = _gold(spark, warehouse, "fact_orders")
    specs = [
        ("silver_orders_no_null_order_id", "CRITICAL", "orders",
         orders.agg(F.count("*").alias("total"), F.count_if(F.col("order_id").isNull()).alias("failed"))),
        ("gold_fact_orders_no_negative_amounts", "HIGH", "fact_orders",
         facts.agg(F.count("*").alias("total"), F.count_if(F.col("line_total") < 0).alias("failed"))),
        ("silver_orders_freshness_24h", "MEDIUM", "orders",
         orders.agg(F.count("*").alias("total"),
                    F.when(F.max("order_date") < now - F.expr("INTERVAL 1 DAY"), 1).otherwise(0)
                    .alias("failed"))),
    ]
    out = None
    for name, sev, table, agg in specs:
        details = F.concat(F.col("failed").cast("string"), F.lit(" violations"))
        r = agg.select(*_result_cols(F.lit(name), F.lit(None).cast("string"), F.col("total"),
                                     F.col("failed"), F.lit(sev), details, "pipeline", table,
                                     run_id, now))
        out = r if out is None else out.unionByName(r)
    return out


# The contracts' seven foreign keys (child, column, parent, key).
FOREIGN_KEYS = [("orders", "customer_id", "customers", "customer_id"), ("orders", "campaign_id", "campaigns", "campaign_id"),
                ("order_items", "order_id", "orders", "order_id"), ("order_items", "product_id", "products", "product_id"),
                ("inventory", "product_id", "products", "product_id"),
                ("clickstream_events", "customer_id", "customers", "customer_id"),
                ("clickstream_events", "product_id", "products", "product_id")]


def referential_checks(spark: SparkSession, warehouse: str, run_id: str, as_of: str | None = None) -> DataFrame:
    """J7/C11 over the stored silver tables; a warning unless the switch is on."""
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    out = None
    for child, fk, parent, pk in FOREIGN_KEYS:
        r = foreign_key_check(_silver(spark, warehouse, child), fk, _silver(spark, warehouse, parent), pk,
                              f"{child}_{fk}", "silver", run_id, checked_at=now)
        out = r if out is None else out.unionByName(r)
    return out


def _timed(fn):
    """Wrap a model step: wall-clock start/end, and a FAILED row instead of
    an exception (the layer's other models still run; the caller sees it)."""
    import datetime as _dt

    def run(arg):
        started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        try:
            out = fn(arg)
        except Exception as e:  # isolation per model, reported in the audit
            out = {"model": str(arg), "status": "FAILED", "error": f"{type(e).__name__}: {e}"}
        out["started_at"] = started
        out["finished_at"] = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        return out
    return run


def _model_audit(spark: SparkSession, run_id: str, steps: list[dict]) -> DataFrame:
    """One audit row per model step (a handful of rows, built on the driver)."""
    rows = [(run_id, s["model"], s["status"], s.get("version"), s["started_at"], s["finished_at"],
             (s["finished_at"] - s["started_at"]).total_seconds(), s.get("error")) for s in steps]
    return spark.createDataFrame(rows, "run_id string, model string, status string, version int, "
                                       "started_at timestamp, finished_at timestamp, "
                                       "duration_s double, error string")


def run_batch(spark: SparkSession, landing: str, warehouse: str, run_id: str | None = None,
              dt: str | None = None, skip_quality: bool = False, fmt: str = "json",
              as_of: str | None = None) -> list[dict]:
    """Run every layer once; returns one status dict per step. A failed model
    ends the run after its layer: the layers above keep their tables.

    Raises ``CriticalQualityError`` when a CRITICAL post-run check fails
    (after its results are written), as the reference's runner does."""
    run_id = run_id or f"run-{uuid.uuid4().hex[:8]}"
    steps: list[dict] = []
    schemas = {e: bronze_schema(e) for e in SILVER_ENTITIES}
    audit = load_entities(spark, landing, f"{warehouse}/bronze", schemas, run_id, dt=dt, fmt=fmt,
                          manifest=_manifest(warehouse))
    audit.write.mode("append").parquet(f"{warehouse}/audit/pipeline_runs")
    steps += [{"model": f"bronze.{r.entity}", "status": r.status, "rows": r.rows_loaded, "rejected": r.rows_rejected}
              for r in audit.collect()]  # one row per entity
    with ThreadPoolExecutor(POOL) as pool:
        layers = [
            (lambda e: _silver_step(spark, warehouse, e, dt), SILVER_ENTITIES),
            (lambda n: _dim_step(spark, warehouse, n), ["dim_date", "dim_products", "dim_campaigns", "dim_customers"]),
            (lambda n: _fact_step(spark, warehouse, n), ["fact_orders", "fact_inventory_daily", "fact_clickstream"]),
        ]
        model_steps: list[dict] = []
        for step, names in layers:
            model_steps += pool.map(_timed(step), names)
            if any(s["status"] == "FAILED" for s in model_steps):
                break  # later layers would be built from stale inputs
    steps += model_steps
    _model_audit(spark, run_id, model_steps).write.mode("append") \
        .parquet(f"{warehouse}/audit/model_runs")
    if any(s["status"] == "FAILED" for s in model_steps):
        return steps
    if not skip_quality:
        results = post_run_checks(spark, warehouse, run_id, as_of)
        results.write.mode("append").parquet(f"{warehouse}/quality/dq_results")
        halt_on_critical(spark.read.parquet(f"{warehouse}/quality/dq_results")
                         .filter(F.col("pipeline_run_id") == run_id))
        orphans = referential_checks(spark, warehouse, run_id, as_of)
        orphans.write.mode("append").parquet(f"{warehouse}/quality/referential_results")
        broken = orphans.where("status = 'FAILED'").collect()  # one row for each relation
        if broken and switch(spark, "halt_on_referential_integrity_failure"):
            raise CriticalQualityError(f"referential integrity: {', '.join(r.rule_name for r in broken)}")
        steps.append({"model": "quality.post_run", "status": "SUCCESS"})
    return steps


__all__ = ["run_batch", "post_run_checks", "bronze_schema", "SILVER_ENTITIES", "empty_frame"]


def main(argv=None) -> int:
    """``python -m goldleaf.plans.batch_run --landing L --warehouse W [--dt D]
    [--skip-quality]``: one run on the cluster the session points at."""
    import argparse
    import json

    from ..session import get_session
    ap = argparse.ArgumentParser(prog="goldleaf.plans.batch_run")
    ap.add_argument("--landing", required=True, help="landing root (<entity>/dt=<date>/...)")
    ap.add_argument("--warehouse", required=True, help="shared root for bronze/silver/gold tables")
    ap.add_argument("--dt", default=None, help="load and merge only this landing date")
    ap.add_argument("--format", default="json", choices=["json", "csv", "parquet"])
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--skip-quality", action="store_true")
    args = ap.parse_args(argv)
    spark = get_session(app="goldleaf-batch")
    steps = run_batch(spark, args.landing, args.warehouse, run_id=args.run_id, dt=args.dt,
                      skip_quality=args.skip_quality, fmt=args.format)
    for s in steps:
        print(json.dumps(s, default=str))
    return 0 if all(s["status"] in ("SUCCESS", "SKIPPED") for s in steps) else 1


if __name__ == "__main__":
    raise SystemExit(main())
