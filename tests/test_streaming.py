"""Streaming jobs: windows across micro-batches, dead letters, dedup."""

import datetime as dt
import json

from pyspark.sql import functions as F

from goldleaf.session import scratch_path
from goldleaf.streaming.jobs import FLUSH_LINE, run_clickstream_job, run_dedup_job


def _line(i, ts, etype="view", value_cents=1):
    return json.dumps({"event_id": i, "ts": ts.strftime("%Y-%m-%d %H:%M:%S"), "user_id": 1,
                       "event_type": etype, "value_cents": value_cents})


def _land(spark, landing, batches):
    # one write per batch: later files are newer, so they form later micro-batches
    for lines in batches:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.mode("append").text(landing)


def test_stream_windows_across_batches_equal_batch_counts(spark):
    root = scratch_path(spark, "t-stream")
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    b1 = [_line(i, base + dt.timedelta(seconds=20 * i)) for i in range(10)]          # 12:00-12:03
    b2 = [_line(100 + i, base + dt.timedelta(minutes=8, seconds=i)) for i in range(5)]  # 12:08
    late = [_line(200, base + dt.timedelta(seconds=5))]                               # 8 min late, kept
    bad = ["not json", '{"event_id": 5, "ts": "2024-01-01 12:00:00", "value_cents": "x"}']
    _land(spark, f"{root}/landing", [b1, b2 + late + bad, [FLUSH_LINE]])
    out = run_clickstream_job(spark, f"{root}/landing", f"{root}/out", max_files=1)
    win = {r.window_start.replace(tzinfo=None): r.event_count
           for r in spark.read.parquet(out["window_summary"]).collect()}
    assert win[base] == 4  # 12:00:00, :20, :40 and the late 12:00:05
    assert sum(win.values()) == 16
    dlq = spark.read.parquet(out["dead_letter_queue"]).collect()
    assert sorted(r.error_message for r in dlq) == ["invalid JSON", "value_cents: expected bigint"]
    bronze = spark.read.parquet(out["bronze"])
    assert bronze.count() == 16 and bronze.filter(F.col("event_id") == -1).count() == 0


def test_stream_dedup_within_watermark(spark):
    root = scratch_path(spark, "t-dedup")
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    b1 = [_line(1, base), _line(2, base + dt.timedelta(minutes=1)), _line(1, base)]
    b2 = [_line(2, base + dt.timedelta(minutes=1)), _line(3, base + dt.timedelta(minutes=2))]
    _land(spark, f"{root}/landing", [b1, b2])
    path = run_dedup_job(spark, f"{root}/landing", f"{root}/out")
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_stream_dedup_hot_copies(spark):
    root = scratch_path(spark, "t-dedup-hot")
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    hot = [_line(7, base)] * 3000
    rest = [_line(i, base + dt.timedelta(seconds=i)) for i in range(8, 40)]
    spark.createDataFrame([(x,) for x in hot + rest], "value string").repartition(8) \
        .write.mode("append").text(f"{root}/landing")
    path = run_dedup_job(spark, f"{root}/landing", f"{root}/out")
    ids = sorted(r.event_id for r in spark.read.parquet(path).collect())
    assert ids == [7] + list(range(8, 40))


def test_update_mode_panes_sum_to_totals(spark):
    from goldleaf.streaming.jobs import pane_deltas, run_window_panes
    root = scratch_path(spark, "t-panes")
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    b1 = [_line(i, base + dt.timedelta(seconds=i)) for i in range(3)]          # window 12:00, 3 rows
    b2 = [_line(10, base + dt.timedelta(seconds=30)),                          # late for 12:00
          _line(11, base + dt.timedelta(minutes=2))]                           # window 12:02
    _land(spark, f"{root}/landing", [b1, b2])
    path = run_window_panes(spark, f"{root}/landing", f"{root}/out", max_files=1)
    panes = pane_deltas(spark.read.parquet(path)).collect()
    by_window = {}
    for r in panes:
        by_window.setdefault(r.window_start.replace(tzinfo=None), []).append((r.epoch, r.pane_count))
    assert sorted(by_window[base]) == [(0, 3), (1, 1)]       # on-time pane, then the late pane
    assert sorted(by_window[base + dt.timedelta(minutes=2)]) == [(1, 1)]


def test_split_holds_only_what_its_tables_take(spark, monkeypatch):
    """Whole messages beside their parsed record made one cached split a multiple of its text."""
    from goldleaf.session import scratch_path
    from goldleaf.streaming import jobs
    from goldleaf.streaming.parse import parse_messages
    held = []
    df = parse_messages(spark.createDataFrame([('{"order_id": "a", "total_amount": 1.5}',), ("{",)], "value string"),
                        "orders", fields=jobs.ORDER_FIELDS)
    persist = type(df).persist
    monkeypatch.setattr(type(df), "persist", lambda self, *a: held.append(self.columns) or persist(self, *a))
    root = scratch_path(spark, "t-split")
    jobs._split_writer(root, jobs.ORDER_FIELDS)(df, 0)
    assert len(held) == 1 and not {"value", "record"} & set(held[0])
    assert [r.order_id for r in spark.read.parquet(f"{root}/bronze").collect()] == ["a"]
    assert [r.payload for r in spark.read.parquet(f"{root}/dead_letter_queue").collect()] == ["{"]


def test_a_message_is_parsed_once_however_many_fields_and_filters_read_it(spark):
    from goldleaf.streaming.jobs import CLICK_FIELDS
    from goldleaf.streaming.parse import good_rows, parse_messages
    df = spark.createDataFrame([('{"event_id": 1}',), ("{",)], "value string").repartition(2)
    good = good_rows(parse_messages(df, "clickstream", fields=CLICK_FIELDS)).select("event_id", "ts", "user_id")
    plan = good._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson(") + plan.count("try_parse_json(") == 1
    assert [r.event_id for r in good.collect()] == [1]


def test_a_message_is_read_as_json_once_not_again_for_its_count_and_kind(spark):
    """The JSON was parsed a second time to count its values, and a record's whole schema was built to see an object."""
    from goldleaf.streaming.jobs import CLICK_FIELDS
    from goldleaf.streaming.parse import parse_messages
    lines = {'{"event_id": 1, "ts": "2024-01-01 00:00:00"}': None, ' \t{"event_id": null}': None, '{"event_id": 1} x': "invalid JSON",
             '{"event_id": 1}{}': "invalid JSON", '{"event_id": 1},{}': "invalid JSON", "": "invalid JSON", "[{}]": "not a JSON object",
             "null": "not a JSON object", '"{"': "not a JSON object", "1, 2": "invalid JSON", '{"event_id": "x"}': "event_id: expected bigint",
             '{"ts": "no time", "event_id": "x"}': "event_id: expected bigint", '{"ts": "no time"}': "ts: expected timestamp"}
    parsed = parse_messages(spark.createDataFrame([(x,) for x in lines], "value string"), "clickstream", fields=CLICK_FIELDS)
    assert {r["value"]: r["error_message"] for r in parsed.select("value", "error_message").collect()} == lines
    plan = parsed._jdf.queryExecution().optimizedPlan().toString().lower()
    assert not any(again in plan for again in ("json_array_length", "lengthofjsonarray", "schema_of_variant", "schemaofvariant"))
