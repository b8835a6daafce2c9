"""Loads tied to their files, quarantine once per row, expiry, run switches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.plans import batch_run, silver
from goldleaf.plans.batch_run import SWITCH_PREFIX, read_quarantine, run_batch
from goldleaf.quality.checks import CriticalQualityError
from goldleaf.session import scratch_path
from goldleaf.sources import bronze, retention
from goldleaf.sources.bronze import committed_bronze, load_entities
from goldleaf.sources.tables import publish, read_table

SCHEMA = T.StructType().add("id", "long").add("name", "string")


@pytest.fixture
def root(spark):
    return scratch_path(spark, "t-incr")


def land(spark, root, entity, lines, day="2024-01-01"):
    spark.createDataFrame([(x, day) for x in lines], "value string, dt string").repartition(2) \
        .write.mode("append").partitionBy("dt").text(f"{root}/landing/{entity}")


def things(*ids):
    return [f'{{"id": {i}, "name": "n{i}"}}' for i in ids]


def load(spark, root, run, **kw):
    audit = load_entities(spark, f"{root}/landing", f"{root}/bronze", {"things": SCHEMA}, run, manifest=f"{root}/manifest", **kw).first()
    return audit.status, audit.rows_loaded, audit.rows_rejected


def held(spark, root):
    rows = committed_bronze(spark, f"{root}/bronze", "things", f"{root}/manifest")
    return sorted(r.id for r in rows.collect())


def test_files_are_loaded_once(spark, root, monkeypatch):
    land(spark, root, "things", things(1, 2, 3) + ["broken"])
    assert load(spark, root, "r1") == ("SUCCESS", 3, 1)
    assert load(spark, root, "r2") == ("SUCCESS", 0, 0)
    land(spark, root, "things", things(4), "2024-01-02")
    land(spark, root, "things", things(5), "2024-01-03")
    assert load(spark, root, "r3", dt="2024-01-03") == ("SUCCESS", 1, 0)
    assert load(spark, root, "r4") == ("SUCCESS", 1, 0)
    assert held(spark, root) == [1, 2, 3, 4, 5]


def test_bounded_loads_take_every_file(spark, root, monkeypatch):
    monkeypatch.setattr(bronze.load_new_files, "__defaults__", (None, "json", 2))
    for k in range(5):
        land(spark, root, "things", things(2 * k, 2 * k + 1))
    assert load(spark, root, "r1") == ("SUCCESS", 10, 0)
    assert held(spark, root) == list(range(10))
    assert spark.read.parquet(f"{root}/manifest").select("_load_id").distinct().count() >= 3


def test_a_crash_between_data_and_commit_neither_loses_nor_doubles(spark, root, monkeypatch):
    land(spark, root, "things", things(1, 2))
    assert load(spark, root, "r1") == ("SUCCESS", 2, 0)
    land(spark, root, "things", things(3, 4))
    monkeypatch.setattr(bronze, "manifest_entries", lambda *a: 1 / 0)
    assert load(spark, root, "r2")[0] == "FAILED"
    assert spark.read.parquet(f"{root}/bronze/things").count() == 4 and held(spark, root) == [1, 2]
    monkeypatch.undo()
    assert load(spark, root, "r3") == ("SUCCESS", 2, 0)
    assert held(spark, root) == [1, 2, 3, 4]


def order(i, customer="c1", version="1.0", amount="5.0"):
    key = "null" if i is None else f'"{i}"'
    return (f'{{"order_id": {key}, "customer_id": "{customer}", "order_status": "PENDING", "order_date": "2024-01-01T00:00:00", '
            f'"total_amount": {amount}, "updated_at": "2024-01-01T00:00:00", "created_at": "whenever", "_schema_version": "{version}"}}'
            .replace('"whenever"', '"2024-01-01T00:00:00"'))


def errors(spark, root, **kw):
    return sorted(r._validation_errors[0] for r in read_quarantine(spark, f"{root}/wh", "orders", **kw).collect())


def test_quarantine_holds_each_row_once_and_expires(spark, root):
    land(spark, root, "orders", [order("a"), order(None), order("b", version="2.0"), order("c", version="1.1"), order("d", version="x")])
    for run in ("r1", "r2", "r1"):
        run_batch(spark, f"{root}/landing", f"{root}/wh", run_id=run, skip_quality=True)
        assert errors(spark, root) == ["null primary key order_id", "unsupported schema version", "unsupported schema version"]
    assert sorted(r.order_id for r in read_table(spark, f"{root}/wh/silver", "orders").collect()) == ["a", "c"]
    land(spark, root, "orders", [order(None, "c2")], "2024-01-02")
    run_batch(spark, f"{root}/landing", f"{root}/wh", run_id="r3", skip_quality=True)
    assert len(errors(spark, root)) == 4
    later = (dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=29)).strftime("%Y-%m-%d %H:%M:%S")
    assert len(errors(spark, root, as_of=later)) == 4
    later = (dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=31)).strftime("%Y-%m-%d %H:%M:%S")
    assert errors(spark, root, as_of=later) == []


def test_switches_are_read_by_the_run(spark, root):
    land(spark, root, "orders", [order("a"), order(None), order("b", amount="1e300")])
    names = ["quarantine_on_null_key", "quarantine_on_schema_failure", "halt_on_referential_integrity_failure"]
    try:
        for n in names[:2]:
            spark.conf.set(SWITCH_PREFIX + n, "false")
        steps = run_batch(spark, f"{root}/landing", f"{root}/wh", run_id="r1", skip_quality=True)
        assert not [s for s in steps if s.get("error")], steps
        rows = read_table(spark, f"{root}/wh/silver", "orders").collect()
        assert sorted((r.order_id or "", r.total_amount is None) for r in rows) == [("", False), ("a", False), ("b", True)]
        assert errors(spark, root) == []
        for n in names[:2]:
            spark.conf.unset(SWITCH_PREFIX + n)
        spark.conf.set(SWITCH_PREFIX + names[2], "true")
        with pytest.raises(CriticalQualityError, match="orders_customer_id"):
            run_batch(spark, f"{root}/landing", f"{root}/wh2", run_id="r1", as_of="2024-01-01 12:00:00")
        assert errors(spark, f"{root}", as_of=None) == []
        assert [r._validation_errors for r in read_quarantine(spark, f"{root}/wh2", "orders").orderBy("order_id").collect()] == [
            ["null primary key order_id"], ["total_amount: cannot cast to decimal(38,9)"]]
        spark.conf.unset(SWITCH_PREFIX + names[2])
        run_batch(spark, f"{root}/landing", f"{root}/wh2", run_id="r2", as_of="2024-01-01 12:00:00")
        dq = spark.read.parquet(f"{root}/wh2/quality/referential_results").where("pipeline_run_id = 'r2'")
        assert dq.count() == 7
    finally:
        for n in names:
            spark.conf.unset(SWITCH_PREFIX + n)


def test_versions_by_major_number(spark):
    got = spark.createDataFrame([("1.0",), ("1.17",), ("1",), (None,), ("2.0",), ("10.0",), ("1.0-x",), ("",)], "v string")
    ok = got.select("v", silver.supported_version(F.col("v"), "1.3").alias("ok")).collect()
    assert [r.v for r in ok if r.ok] == ["1.0", "1.17", "1", None]


def test_expired_partitions_versions_and_scratch_go(spark, root):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-31"), (3, "2024-02-29"), (4, None)], "n int, day string")
    rows.write.partitionBy("day").parquet(f"{root}/held")
    assert retention.expire_partitions(spark, f"{root}/held", "day", "2024-03-01 10:00:00", 30) == ["day=2024-01-01"]
    assert sorted(r.n for r in spark.read.parquet(f"{root}/held").collect()) == [2, 3, 4]
    assert retention.expire_partitions(spark, f"{root}/held", "day", "2024-03-01", 30) == []
    assert retention.expire_partitions(spark, f"{root}/nothing", "day", "2024-03-01") == []
    for k in range(5):
        publish(spark.range(k), root, "t")
    reader = read_table(spark, root, "t")
    assert retention.expire_versions(spark, root, "t", keep=2) == []  # all younger than the grace period
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=2)
    assert len(retention.expire_versions(spark, root, "t", keep=2, now=later)) == 3
    assert reader.count() == read_table(spark, root, "t").count() == 4
    assert retention.expire_scratch(spark, grace=dt.timedelta(days=300)) == []
    assert os.path.isdir(root.removeprefix("file:"))
