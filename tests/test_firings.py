"""Window firings: late rows, several runs, replayed epochs, hot windows."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from goldleaf.session import scratch_path
from goldleaf.streaming.firings import run_firings_job
from goldleaf.streaming.jobs import run_clickstream_job

BASE = dt.datetime(2024, 1, 1, 12, 0, 0)


def message(i, at, arrived=None):
    return json.dumps({"event_id": i, "ts": str(BASE + dt.timedelta(seconds=at)), "user_id": 1, "event_type": "view",
                       "value_cents": 1, "arrived_at": str(BASE + dt.timedelta(seconds=at if arrived is None else arrived))})


def land(spark, root, *batches):
    for lines in batches:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{root}/landing")


def panes(spark, out):
    return sorted((int((r.window_start.replace(tzinfo=None) - BASE).total_seconds()), r.firing, r.pane, r.event_count)
                  for r in spark.read.parquet(out["panes"]).collect())


@pytest.fixture
def root(spark):
    return scratch_path(spark, "t-firings")


def test_firings_across_batches_and_runs(spark, root):
    land(spark, root,
         [message(k, 10 * k) for k in range(12)],                       # windows 0 and 60: six each
         [message(20, 130), message(21, 5, 130)],                       # 0 is closed only by the batch before: a late row
         [message(30, 400), message(31, 10, 400), message(32, 70, 400)])
    out = run_firings_job(spark, f"{root}/landing", f"{root}/out", files_per_batch=1)
    # watermarks: none, 110, 130, then 400 in the batch without data
    assert panes(spark, out) == [(0, 1, "on_time", 7), (0, 2, "late", 1), (60, 1, "on_time", 7), (120, 1, "on_time", 1)]
    land(spark, root, [message(40, 20, 410), message(41, 410)], [message(50, 700)], [message(60, 30, 710), message(61, 70, 710)])
    run_firings_job(spark, f"{root}/landing", f"{root}/out", files_per_batch=1)
    assert panes(spark, out) == [
        (0, 0, "dropped", 1), (0, 1, "on_time", 7), (0, 2, "late", 1), (0, 3, "late", 1),
        (60, 1, "on_time", 7), (60, 2, "late", 1), (120, 1, "on_time", 1), (360, 1, "on_time", 2)]
    assert spark.read.parquet(out["bronze"]).count() == 22


def test_a_wrong_clock_closes_no_window(spark, root):
    land(spark, root, [message(k, k) for k in range(5)] + [message(9, 86400 * 30, 5)])
    run_firings_job(spark, f"{root}/landing", f"{root}/out")
    land(spark, root, [message(10 + k, 30 + k) for k in range(7)], [message(30, 100)])
    out = run_firings_job(spark, f"{root}/landing", f"{root}/out", files_per_batch=1)
    assert panes(spark, out) == [(0, 1, "on_time", 12)]
    refused = spark.read.parquet(out["dead_letter_queue"]).collect()
    assert [r.error_message for r in refused] == ["event time ahead of arrival"]


def test_plain_window_job_refuses_a_wrong_clock(spark, root):
    old = [json.dumps({"event_id": k, "ts": str(BASE + dt.timedelta(seconds=k)), "value_cents": 1}) for k in range(5)]
    land(spark, root, old + [json.dumps({"event_id": 9, "ts": "2990-01-01 00:00:00"})])
    run_clickstream_job(spark, f"{root}/landing", f"{root}/out")
    more = [json.dumps({"event_id": k, "ts": str(BASE + dt.timedelta(seconds=k + 20))}) for k in range(10, 17)]
    land(spark, root, more, ['{"event_id": -1, "ts": "2999-01-01 00:00:00", "_control": "flush"}'])
    out = run_clickstream_job(spark, f"{root}/landing", f"{root}/out", max_files=1)
    assert spark.read.parquet(out["window_summary"]).agg(F.sum("event_count")).first()[0] == 12
    assert spark.read.parquet(out["dead_letter_queue"]).count() == 1


def test_replayed_epoch_changes_nothing(spark, root):
    land(spark, root, [message(k, 10 * k) for k in range(12)], [message(20, 300), message(21, 5, 300)])
    out = run_firings_job(spark, f"{root}/landing", f"{root}/out", files_per_batch=1)
    before = panes(spark, out)
    local = f"{root}/out/_checkpoints/panes/commits".removeprefix("file:")
    last = max((p for p in glob.glob(f"{local}/*")), key=lambda p: int(os.path.basename(p)))
    for part in (last, os.path.join(local, f".{os.path.basename(last)}.crc")):
        os.remove(part)  # as after a crash between the epoch's output and its commit
    run_firings_job(spark, f"{root}/landing", f"{root}/out", files_per_batch=1)
    assert panes(spark, out) == before
    assert os.path.exists(last)


def test_hot_window_and_rows_without_time(spark, root):
    lines = [message(k, 30) for k in range(3000)] + [message(5000 + k, 60 * k) for k in range(1, 30)]
    lines += ['{"event_id": 1, "ts": null, "arrived_at": "2024-01-01 12:00:00"}', '{"event_id": 2}']
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(6).write.mode("append").text(f"{root}/landing")
    out = run_firings_job(spark, f"{root}/landing", f"{root}/out")
    got = panes(spark, out)
    assert got[0] == (0, 1, "on_time", 3000) and len(got) == 29
    assert spark.read.parquet(out["bronze"]).count() == len(lines)


def test_state_stores_do_not_outnumber_the_cores(spark, root):
    """Every store costs a task in each micro-batch; a later run with another
    setting keeps the stores of the first, and the setting is put back."""
    key = "spark.sql.shuffle.partitions"
    before, cores = spark.conf.get(key), spark.sparkContext.defaultParallelism
    spark.conf.set(key, str(5 * cores))
    try:
        land(spark, root, [message(k, 10 * k) for k in range(12)])
        run_firings_job(spark, f"{root}/landing", f"{root}/out")
        assert spark.conf.get(key) == str(5 * cores)
        spark.conf.set(key, "2")
        land(spark, root, [message(100, 900)])
        out = run_firings_job(spark, f"{root}/landing", f"{root}/out")
    finally:
        spark.conf.set(key, before)
    assert panes(spark, out) == [(0, 1, "on_time", 6), (60, 1, "on_time", 6)]
    stores = [d for d in os.listdir(f"{root}/out/_checkpoints/panes/state/0".removeprefix("file:")) if d.isdigit()]
    assert len(stores) == cores
