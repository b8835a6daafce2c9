"""Event-time windows (L3-L7, A5) shared by batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(df: DataFrame, ts: str, width: str = "60 seconds",
                  lateness: str | None = None, computed_at: bool = False) -> DataFrame:
    """Count rows per tumbling window of ``width`` on event time ``ts``.

    Works on a batch or a streaming frame. With ``lateness`` a watermark is
    set first (streaming: state for a window is dropped once the watermark
    passes its end + lateness; ``append`` mode emits each window once).
    The aggregate is keyed by the window itself, so partial counts are
    combined map-side and no single key carries every record.
    """
    src = df
    if lateness:
        src = src.withWatermark(ts, lateness)
    out = src.groupBy(F.window(F.col(ts), width).alias("w")).agg(F.count("*").alias("event_count"))
    cols = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_count"]
    if computed_at:
        cols.append(F.current_timestamp().alias("computed_at"))
    return out.select(*cols)
