"""Window firings over late data (L4-L6): on-time and late panes.

The reference counts events per 60-second window, fires when the watermark
passes the window's end, fires again for late data, allows 10 minutes of
lateness and discards what a pane has counted. Here:

* admission (:func:`parse.gate_ahead`): an event that claims a time well ahead
  of its arrival goes to the dead letters, before the watermark is taken. One
  wrong clock would otherwise close every window for good;
* the watermark is the greatest admitted event time of the micro-batches before;
* each window is a key with state (``transformWithState``): the count not yet
  emitted and the number of firings. A timer at the window's end fires the
  on-time pane, late rows fire a pane each micro-batch, a timer at end + lateness
  clears the state. A pane holds only what no earlier pane held. Rows beyond the
  lateness come out as ``dropped`` rows, so nothing is lost unseen;
* each task sums its own events per window first, so a window that holds a third
  of all events sends one row per task and batch to its key;
* state lives in the checkpoint and survives any number of bounded runs: windows
  still open at the end of a run wait for the next one, no closing message needed.
  Every epoch writes its own folder, so a replayed epoch changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .jobs import CLICK_FIELDS, run_message_job
from .parse import gate_ahead, good_rows, parse_messages

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PARTITIONS = "spark.sql.shuffle.partitions"
PANES = "window_us long, firing int, pane string, event_count long"


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None):
    """Queries started inside keep their state in RocksDB, which keyed state with
    timers needs; a query takes its settings when it starts. ``partitions`` is the
    number of its state stores at most: each is opened and committed by a task in
    every micro-batch, whether it holds a key or not. A checkpoint keeps the number
    of its first run."""
    before = {key: spark.conf.get(key, None) for key in (_PROVIDER, _PARTITIONS)}
    spark.conf.set(_PROVIDER, _ROCKSDB)
    if partitions:
        spark.conf.set(_PARTITIONS, str(min(partitions, int(spark.conf.get(_PARTITIONS)))))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


class WindowFirings(StatefulProcessor):
    """Panes of one window, the key being its start in microseconds."""

    def __init__(self, width_s: int, lateness_s: int):
        self.width_s, self.lateness_s = width_s, lateness_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", "pending long, firings int")

    def _ends_ms(self, key) -> int:
        return key[0] // 1000 + self.width_s * 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = sum(r.n for r in rows)
        end, now = self._ends_ms(key), timerValues.getCurrentWatermarkInMs()
        pending, firings = self.state.get() or (0, 0)
        if now >= end + self.lateness_s * 1000:
            yield Row(window_us=key[0], firing=0, pane="dropped", event_count=n)
        elif now < end:
            if not pending:
                self.handle.registerTimer(end)
                self.handle.registerTimer(end + self.lateness_s * 1000)
            self.state.update((pending + n, firings))
        else:
            if not firings and not pending:  # its first rows are late already
                self.handle.registerTimer(end + self.lateness_s * 1000)
            self.state.update((0, firings + 1))
            yield Row(window_us=key[0], firing=firings + 1, pane="on_time" if pending else "late", event_count=pending + n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        pending, firings = self.state.get() or (0, 0)
        if pending:
            yield Row(window_us=key[0], firing=firings + 1, pane="on_time", event_count=pending)
            self.state.update((0, firings + 1))
        if expiredTimerInfo.getExpiryTimeInMs() >= self._ends_ms(key) + self.lateness_s * 1000:
            self.state.clear()

    def close(self) -> None:
        pass


def window_firings(events: DataFrame, ts: str, width_s: int = 60, lateness_s: int = 600) -> DataFrame:
    """Stream of panes (window_start, window_end, firing, pane, event_count) of a
    stream of events with a TIMESTAMP column ``ts``; rows without a time have no
    window."""
    width = width_s * 1_000_000

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            us = pc.drop_null(b.column(0)).cast(pa.int64())
            # floor also before 1970
            start = pc.multiply(pc.floor(pc.divide(us.cast(pa.float64()), float(width))).cast(pa.int64()), width)
            counted = pc.value_counts(start)
            yield pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], ["window_us", "n"])

    partial = events.select(ts).withWatermark(ts, "0 seconds").mapInArrow(sums, "window_us long, n long")
    panes = partial.groupBy("window_us").transformWithState(
        WindowFirings(width_s, lateness_s), PANES, outputMode="append", timeMode="eventTime")
    return panes.select(F.timestamp_micros("window_us").alias("window_start"),
                        F.timestamp_micros(F.col("window_us") + width).alias("window_end"), "firing", "pane", "event_count")


def run_firings_job(spark: SparkSession, landing: str, out_root: str, files_per_batch: int | None = None,
                    arrival: str = "arrived_at", ahead: str = "5 minutes", width_s: int = 60, lateness_s: int = 600,
                    source: str = "clickstream") -> dict:
    """One bounded run over the messages that landed since the last one: raw rows
    to bronze, refused ones to the dead letters, panes to ``panes/epoch=n``. The
    message field ``arrival`` says when a message arrived. Returns the paths."""
    fields = [*CLICK_FIELDS, (arrival, "timestamp")]
    out = run_message_job(spark, landing, out_root, source, fields, files_per_batch, gate=("ts", arrival, ahead))
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    parsed = gate_ahead(parse_messages(reader.load(landing), source, fields=fields), "ts", arrival, ahead)

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_root}/panes/epoch={epoch_id}")

    # open windows are few, whatever the input, and a task sends one row for each: a store per core is enough
    with rocksdb_state(spark, spark.sparkContext.defaultParallelism):
        q = (window_firings(good_rows(parsed), "ts", width_s, lateness_s).writeStream.outputMode("append").foreachBatch(write)
             .option("checkpointLocation", f"{out_root}/_checkpoints/panes").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return {**out, "panes": f"{out_root}/panes"}
