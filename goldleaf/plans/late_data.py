"""Queries over late data: several micro-batches and several runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import to_output
from ..sources import testdata as td
from .catalog import register

FILES_PER_SLICE = 2
FIRST_RUN = 4  # slices landed before the first run; the rest land before the second


def firings_outputs(spark, sf_dir) -> dict:
    """Two bounded runs over one checkpoint, a micro-batch for each slice."""
    from ..streaming.firings import run_firings_job
    from ..streaming.jobs import fresh_root
    root = fresh_root(spark, "firings")
    messages = td.event_arrivals(spark, sf_dir)
    out = {}
    for first, last in ((0, FIRST_RUN), (FIRST_RUN, td.SLICES)):
        for k in range(first, last):  # later files are newer, so they form later micro-batches
            messages.where(F.col("slice") == k).select("value").repartition(FILES_PER_SLICE) \
                .write.mode("append").text(f"{root}/landing")
        out = run_firings_job(spark, f"{root}/landing", f"{root}/out", files_per_batch=FILES_PER_SLICE)
    return out


# Ticks are the micro-batches: one for each slice, and one without data at the
# end of each run (4 and 9), in which the watermark of the last slice takes effect.
_TICKS = f"""WITH m AS ({td.EVENT_ARRIVALS_SQL}),
c AS (
  SELECT t - t % 60000000 AS w, slice + CASE WHEN slice >= {FIRST_RUN} THEN 1 ELSE 0 END AS k, count(*) AS n, max(t) AS top
  FROM m WHERE NOT ahead GROUP BY 1, 2),
marks AS (SELECT r.k, (SELECT max(top) FROM c WHERE c.k < r.k) AS mark FROM range(0, {td.SLICES + 2}) r(k)),
x AS (
  SELECT w, k, n, coalesce(mark >= w + 60000000, FALSE) AS closed, coalesce(mark >= w + 660000000, FALSE) AS gone
  FROM c JOIN marks USING (k)),
early AS (
  SELECT w, sum(n) AS n, (SELECT min(k) FROM marks WHERE mark >= x.w + 60000000) AS fires
  FROM x WHERE NOT closed GROUP BY w),
panes AS (
  SELECT e.w, e.fires AS k, 'on_time' AS pane, e.n + coalesce(x.n, 0) AS n
  FROM early e LEFT JOIN x ON x.w = e.w AND x.k = e.fires AND NOT x.gone WHERE e.fires IS NOT NULL
  UNION ALL
  SELECT x.w, x.k, 'late', x.n FROM x LEFT JOIN early e ON e.w = x.w AND e.fires = x.k
  WHERE closed AND NOT gone AND e.w IS NULL)"""


@register("stream_window_firings", f"""{_TICKS}
SELECT make_timestamp(w) AS window_start, make_timestamp(w + 60000000) AS window_end,
  CAST(row_number() OVER (PARTITION BY w ORDER BY k) AS INTEGER) AS firing, pane, CAST(n AS BIGINT) AS event_count FROM panes
UNION ALL
SELECT make_timestamp(w), make_timestamp(w + 60000000), 0, 'dropped', n FROM x WHERE gone""")
def stream_window_firings(spark, sf_dir):
    """Eight slices of messages, some 5 or 15 minutes late, some an hour
    ahead, in two bounded runs on one checkpoint. Every firing of every window
    with what it alone counts, and what came beyond the lateness."""
    out = firings_outputs(spark, sf_dir)
    return to_output(spark.read.parquet(out["panes"]).select("window_start", "window_end", "firing", "pane", "event_count"))


@register("stream_ahead_gate", f"""SELECT event_id, ahead, CASE WHEN ahead THEN 'event time ahead of arrival' END AS error_message
FROM ({td.EVENT_ARRIVALS_SQL}) AS m""")
def stream_ahead_gate(spark, sf_dir):
    """L4: what the same runs admit to bronze and refuse: each message once."""
    out = firings_outputs(spark, sf_dir)
    good = spark.read.parquet(out["bronze"]).select("event_id", F.lit(None).cast("string").alias("error_message"))
    bad = spark.read.parquet(out["dead_letter_queue"]).select(
        F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"), "error_message")
    both = good.unionByName(bad)
    return both.select("event_id", F.col("error_message").isNotNull().alias("ahead"), "error_message")


@register("stream_redelivery", f"""SELECT event_id, user_id, event_type, later AS seconds_after FROM (
  SELECT event_id, user_id, event_type, unnest(CASE WHEN event_id % 10 = 6 THEN [0, 360] ELSE [0] END) AS later FROM events) AS e""")
def stream_redelivery(spark, sf_dir):
    """Messages that come again 4 minutes later (dropped) or 6 minutes later
    (kept), mostly in another micro-batch, some in another run."""
    from ..streaming.jobs import fresh_root, run_dedup_job
    root = fresh_root(spark, "redelivery")
    messages = td.event_redeliveries(spark, sf_dir)
    path = ""
    for first, last in ((0, FIRST_RUN), (FIRST_RUN, td.SLICES)):
        for k in range(first, last):
            messages.where(F.col("slice") == k).select("value").repartition(FILES_PER_SLICE) \
                .write.mode("append").text(f"{root}/landing")
        path = run_dedup_job(spark, f"{root}/landing", f"{root}/out", max_files=FILES_PER_SLICE)
    after = F.unix_seconds("arrived_at") - F.unix_seconds("ts")
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", after.cast("int").alias("seconds_after"))
