"""Re-delivered events across batches and runs."""

import datetime as dt
import json

from pyspark.sql import functions as F

from goldleaf.session import scratch_path
from goldleaf.streaming.jobs import run_dedup_job

BASE = dt.datetime(2024, 1, 1, 12, 0, 0)


def message(i, arrived, **more):
    return json.dumps({"event_id": i, "ts": str(BASE), "user_id": 1, "arrived_at": str(BASE + dt.timedelta(seconds=arrived)), **more})


def land(spark, root, *batches):
    for lines in batches:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{root}/landing")


def kept(spark, path):
    return sorted((r.event_id, int((r.arrived_at.replace(tzinfo=None) - BASE).total_seconds())) for r in spark.read.parquet(path).collect()
                  if r.event_id is not None)


def test_within_and_beyond_five_minutes(spark):
    root = scratch_path(spark, "t-redeliver")
    land(spark, root,
         [message(1, 0), message(2, 0), message(3, 10), message(3, 10), message(4, 0)],
         [message(1, 299), message(2, 301), message(4, 240), message(9, 300)],
         [message(4, 310), message(2, 600)])                     # 4: 310 s after its first; 2: 299 s after its second window
    path = run_dedup_job(spark, f"{root}/landing", f"{root}/out", max_files=1)
    want = [(1, 0), (2, 0), (2, 301), (3, 10), (4, 0), (4, 310), (9, 300)]
    assert kept(spark, path) == want
    land(spark, root, [message(4, 600), message(9, 601), message(1, 5000)], [message(4, 615)])  # a second run on the same state
    run_dedup_job(spark, f"{root}/landing", f"{root}/out", max_files=1)
    assert kept(spark, path) == sorted(want + [(9, 601), (1, 5000), (4, 615)])


def test_hot_message_and_missing_ids(spark):
    root = scratch_path(spark, "t-redeliver-hot")
    lines = [message(7, k % 100) for k in range(3000)] + [message(100 + k, k) for k in range(50)]
    lines += ['{"ts": "2024-01-01 00:00:00"}'] * 3
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(6).write.mode("append").text(f"{root}/landing")
    path = run_dedup_job(spark, f"{root}/landing", f"{root}/out")
    assert [i for i, _ in kept(spark, path)] == [7] + list(range(100, 150))
    assert spark.read.parquet(path).where(F.col("event_id").isNull()).count() == 3


def test_state_is_a_table_of_live_ids_that_a_replay_finds_again(spark):
    """One state-server call per id made the run time out; the state is joined."""
    from goldleaf.streaming.redelivery import drop_redeliveries
    root = scratch_path(spark, "t-redeliver-state")
    schema = "event_id long, arrived_at timestamp"

    def run(epoch, *rows):
        batch = spark.createDataFrame([(i, BASE + dt.timedelta(seconds=s)) for i, s in rows], schema)
        drop_redeliveries(batch, epoch, f"{root}/out", f"{root}/state", "event_id", "arrived_at")
        found = spark.read.parquet(f"{root}/out/epoch={epoch}").collect()
        return sorted((r.event_id or 0, int((r.arrived_at - BASE).total_seconds())) for r in found)

    big = 2**53 + 1
    assert run(0, (1, 0), (2, 0), (big, 5), (big - 1, 5), (None, 5), (None, 5)) == [(0, 5), (0, 5), (1, 0), (2, 0), (big - 1, 5), (big, 5)]
    assert run(1) == []
    for _ in range(2):  # the second time as after a failure
        assert run(2, (1, 100), (2, 2000)) == [(2, 2000)]
    assert run(3, (1, 2001)) == [(1, 2001)]
    live = spark.read.parquet(f"{root}/state/turn=1").where("_key IS NOT NULL")
    assert sorted(r._key for r in live.collect()) == [1, 2]
