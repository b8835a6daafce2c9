"""Structured Streaming jobs.

The reference's Beam job reads two message topics, writes good rows to
bronze, bad ones to a dead-letter table, and counts clickstream events per
60-second window with 10 minutes of allowed lateness. Here:

* source: a file stream of JSON lines (``readStream.text``). Kafka is the
  scale-out choice with the same ``value`` column; its connector jar is
  not on this image, so the file source stands in;
* raw + dead-letter sinks: one ``foreachBatch`` that persists the batch,
  writes both splits and unpersists, so each message is read once. Each
  epoch writes its own directory with overwrite, so a replayed epoch after
  a failure replaces its own output (exactly-once effect);
* window summary: ``withWatermark`` + ``window`` + ``append`` to Parquet
  partitioned by window date; the file sink is exactly-once by itself.
  ``append`` emits each window once, after the watermark passes its end;
  that is the sum of the reference's discarding panes (L5, L6);
* every query keeps its own checkpoint under the shared checkpoint root.

Event time is the payload's timestamp, not the arrival time (the
reference used publish time by mistake).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import window_counts
from ..session import scratch_path
from .parse import dead_letters, gate_ahead, good_rows, parse_messages

# The clickstream message fields and types; the flush
# control message used to close the last windows of a bounded run.
CLICK_FIELDS = [("event_id", "bigint"), ("ts", "timestamp"), ("user_id", "bigint"),
                ("event_type", "string"), ("value_cents", "bigint")]
FLUSH_TS = "2999-01-01 00:00:00"
FLUSH_LINE = '{"event_id": -1, "ts": "' + FLUSH_TS + '", "_control": "flush"}'


def _is_control(rec: Column) -> Column:
    return F.try_variant_get(rec, "$._control", "string").isNotNull()


def write_landing(lines: DataFrame, landing: str, flush: bool = True) -> str:
    """Land JSON lines as text files (one Spark write), then, in a later
    write, one flush message far in event-time future."""
    lines.select("value").write.mode("append").text(landing)
    if flush:
        spark = lines.sparkSession
        spark.range(1).select(F.lit(FLUSH_LINE).alias("value")).coalesce(1) \
            .write.mode("append").text(landing)
    return landing


def _split_writer(out_root: str, fields: list[tuple[str, str]]):
    names = [n for n, _ in fields]

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # only what the two tables take is held: the typed fields, and a refused row's text
        bad = F.col("error_message").isNotNull()
        rows = batch.select(*names, F.when(bad, F.col("payload")).alias("payload"), "payload_base64", "error_message",
                            "source", _is_control(F.col("record")).alias("_control")).persist()
        try:
            good = good_rows(rows).filter(~F.col("_control")).select(*names)
            good.write.mode("overwrite").parquet(f"{out_root}/bronze/epoch={epoch_id}")
            dead_letters(rows).write.mode("overwrite").parquet(
                f"{out_root}/dead_letter_queue/epoch={epoch_id}")
        finally:
            rows.unpersist()
    return write_batch


# The order message fields and types (orders branch).
ORDER_FIELDS = [("order_id", "string"), ("customer_id", "string"), ("order_status", "string"),
                ("order_date", "timestamp"), ("total_amount", "double")]


def run_message_job(spark: SparkSession, landing: str, out_root: str, source: str,
                    fields: list[tuple[str, str]], max_files: int | None = None,
                    gate: tuple[str, str, str] | None = None) -> dict:
    """S7-S10 for one message branch without windowing (the orders branch):
    parse, raw rows to bronze, bad ones to the shared dead-letter table. ``gate``
    (event time, arrival, bound) also refuses rows ahead of their arrival."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    parsed = parse_messages(reader.load(landing), source, fields=fields)
    if gate:
        parsed = gate_ahead(parsed, *gate)
    q = (parsed.writeStream.foreachBatch(_split_writer(out_root, fields))
         .option("checkpointLocation", f"{out_root}/_checkpoints/split")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return {"bronze": f"{out_root}/bronze", "dead_letter_queue": f"{out_root}/dead_letter_queue"}


def run_clickstream_job(spark: SparkSession, landing: str, out_root: str,
                        width: str = "60 seconds", lateness: str = "10 minutes",
                        max_files: int | None = None, source: str = "clickstream",
                        ahead: str = "5 minutes") -> dict:
    """Raw, dead-letter and window-summary queries over one landing. Events
    more than ``ahead`` of the time their file landed are dead letters (L4).

    Runs with ``trigger(availableNow=True)`` (bounded: process what is
    there, then stop) and returns the output paths."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.load(landing).select("value", F.col("_metadata.file_modification_time").alias("landed_at"))
    parsed = parse_messages(raw, source, fields=CLICK_FIELDS)
    # the closing message of a bounded run is the only row allowed ahead of its file
    parsed = gate_ahead(parsed, "ts", "landed_at", ahead, unless=_is_control(F.col("record")))

    q_split = (parsed.writeStream.foreachBatch(_split_writer(out_root, CLICK_FIELDS))
               .option("checkpointLocation", f"{out_root}/_checkpoints/split")
               .trigger(availableNow=True).start())

    events = good_rows(parsed).select(F.col("ts").alias("event_timestamp"))
    summary = (window_counts(events, "event_timestamp", width, lateness, computed_at=True)
               .withColumn("window_date", F.to_date("window_start")))
    q_win = (summary.writeStream.outputMode("append").format("parquet")
             .partitionBy("window_date")
             .option("path", f"{out_root}/window_summary")
             .option("checkpointLocation", f"{out_root}/_checkpoints/window_summary")
             .trigger(availableNow=True).start())
    for q in (q_split, q_win):
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return {"bronze": f"{out_root}/bronze", "dead_letter_queue": f"{out_root}/dead_letter_queue",
            "window_summary": f"{out_root}/window_summary"}


def _pane_writer(out_root: str):
    def write_panes(batch: DataFrame, epoch_id: int) -> None:
        # one directory per epoch, overwritten on replay: idempotent
        batch.withColumn("epoch", F.lit(epoch_id).cast("bigint")) \
            .write.mode("overwrite").parquet(f"{out_root}/window_panes/epoch={epoch_id}")
    return write_panes


def run_window_panes(spark: SparkSession, landing: str, out_root: str,
                     width: str = "60 seconds", lateness: str = "10 minutes",
                     max_files: int | None = None, source: str = "clickstream") -> str:
    """L5/L6 pane feed: ``update`` mode emits a window every micro-batch in
    which its count changed (early and late firings, running totals), each
    epoch written to its own directory. ``pane_deltas`` turns the running
    totals into discarding panes (only the additional count per firing)."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    parsed = parse_messages(reader.load(landing), source, fields=CLICK_FIELDS)
    events = (good_rows(parsed).filter(~_is_control(F.col("record")))
              .select(F.col("ts").alias("event_timestamp")))
    totals = window_counts(events, "event_timestamp", width, lateness)
    q = (totals.writeStream.outputMode("update").foreachBatch(_pane_writer(out_root))
         .option("checkpointLocation", f"{out_root}/_checkpoints/window_panes")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return f"{out_root}/window_panes"


def pane_deltas(panes: DataFrame) -> DataFrame:
    """Discarding panes from running totals: per window, the count minus the
    count of its previous firing. The sum of a window's panes is its final
    count. Partitioned by window: a window has one row per firing."""
    from pyspark.sql import Window
    w = Window.partitionBy("window_start").orderBy("epoch")
    prev = F.coalesce(F.lag("event_count").over(w), F.lit(0))
    return panes.select("window_start", "window_end", "epoch",
                        (F.col("event_count") - prev).alias("pane_count"))


def run_dedup_job(spark: SparkSession, landing: str, out_root: str, within: str = "5 minutes",
                  key: str = "event_id", max_files: int | None = None, arrival: str = "arrived_at") -> str:
    """Drop re-delivered events (same id) that arrive within ``within`` of
    their first arrival, in this run or a later one on the same checkpoint. The
    message field ``arrival`` says when a message came; without it, its file's
    time does. Events without an id pass untouched."""
    from .redelivery import drop_redeliveries
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.load(landing).select("value", F.col("_metadata.file_modification_time").alias("_landed"))
    good = good_rows(parse_messages(raw, "clickstream", fields=[*CLICK_FIELDS, (arrival, "timestamp")]))
    good = good.filter(~_is_control(F.col("record"))).select(
        *[n for n, _ in CLICK_FIELDS], F.coalesce(arrival, "_landed").alias(arrival))
    seconds = spark.sql(f"SELECT unix_seconds(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {within})").first()[0]

    def write(batch: DataFrame, epoch_id: int) -> None:
        drop_redeliveries(batch, epoch_id, f"{out_root}/deduped", f"{out_root}/_state/deduped", key, arrival, seconds)

    q = (good.writeStream.foreachBatch(write)
         .option("checkpointLocation", f"{out_root}/_checkpoints/deduped")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return f"{out_root}/deduped"


def fresh_root(spark: SparkSession, name: str) -> str:
    """New folder per run under the shared checkpoint root (never reused,
    never deleted by the job)."""
    return scratch_path(spark, name)
