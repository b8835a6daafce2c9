"""Dropping re-delivered events (L10), across micro-batches and runs.

A message that arrives again within the window after its first arrival is a
re-delivery; one that arrives later counts as new, and silver's MERGE settles it.
Time is the arrival, in whole seconds: a re-delivered message claims the same
event time however late it comes. The state is a table (id, second its window
began) joined to each micro-batch by id, so an id costs a row of a join and not a
call to a state server. An id leaves it once the greatest arrival of the batches
before has passed the window and the lateness. Two folders take turns: a batch
reads the one that the batch before wrote and overwrites the other, so a replayed
batch finds the state it began with. Each task first keeps one row per id and
second of each Arrow batch it reads, so a message sent over and over reaches its
id as a few rows a task, not as a third of the stream. Equal seconds are one
arrival, so that changes no decision.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _one_per_second(batch: DataFrame, key: str, arrival: str) -> DataFrame:
    """``batch`` with ``_second`` and ``_nk`` (0, or a number of its own for a row
    without a key), one row per key and second of each Arrow batch."""
    staged = batch.withColumns({
        "_second": F.coalesce(F.unix_seconds(F.col(f"`{arrival}`")), F.lit(0)),
        "_nk": F.when(F.col(f"`{key}`").isNull(), F.monotonically_increasing_id() + 1).otherwise(F.lit(0))})

    def one_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.select([key, "_second", "_nk"]).to_pandas(integer_object_nulls=True)
            yield b.take(pa.array((~ids.duplicated()).to_numpy().nonzero()[0]))

    return staged.mapInArrow(one_each, T.StructType([T.StructField(f.name, f.dataType) for f in staged.schema.fields]))


def first_arrivals(batch: DataFrame, state: DataFrame, key: str, arrival: str, within_s: int = 300) -> DataFrame:
    """The rows of ``batch`` that are no re-delivery, given the ``state`` (key,
    ``_first``) of the batches before. Rows without a key pass."""
    names = batch.columns
    rows = F.struct("_second", *[F.col(f"`{n}`") for n in names])
    per_id = _one_per_second(batch, key, arrival).groupBy(F.col(f"`{key}`").alias("_key"), "_nk").agg(
        F.sort_array(F.collect_list(rows)).alias("_rows"))
    held = state.select("_key", F.lit(0).cast("bigint").alias("_nk"), "_first")
    joined = per_id.join(held, ["_key", "_nk"], "left")
    # in order of arrival: a row beyond the window is new, and a later one opens the next window
    empty = F.filter(F.col("_rows"), lambda r: F.lit(False))

    def step(acc, r):
        fresh = acc["first"].isNull() | (F.abs(r["_second"] - acc["first"]) > within_s)
        opens = acc["first"].isNull() | (fresh & (r["_second"] > acc["first"]))
        return F.struct(F.when(opens, r["_second"]).otherwise(acc["first"]).alias("first"),
                        F.when(fresh, F.concat(acc["kept"], F.array(r))).otherwise(acc["kept"]).alias("kept"))

    kept = F.aggregate("_rows", F.struct(F.col("_first").alias("first"), empty.alias("kept")), step, lambda acc: acc["kept"])
    return joined.select(F.inline(kept)).select(*[F.col(f"`{n}`") for n in names])


def drop_redeliveries(batch: DataFrame, epoch_id: int, out: str, states: str, key: str, arrival: str,
                      within_s: int = 300, lateness_s: int = 600) -> None:
    """Write to ``out``/epoch=n the rows of micro-batch ``epoch_id`` that do not
    repeat ``key`` within ``within_s`` seconds of the ``arrival`` (TIMESTAMP) that
    opened its window, and the state for the next one under ``states``. Arrivals
    up to ``lateness_s`` out of order still find their state. Rows without a key
    are no re-deliveries of each other; a missing arrival counts as the start of
    time."""
    spark = batch.sparkSession
    fields = T.StructType([T.StructField("_key", batch.schema[key].dataType), T.StructField("_first", T.LongType()),
                           T.StructField("_mark", T.LongType())])
    if epoch_id:
        stored = spark.read.schema(fields).parquet(f"{states}/turn={(epoch_id - 1) % 2}")
    else:
        stored = spark.createDataFrame([], fields)
    # the row without a key holds the greatest arrival of all batches before
    mark = stored.where(F.col("_key").isNull()).agg(F.max("_mark")).first()[0]
    state = stored.where(F.col("_key").isNotNull()).select("_key", "_first")
    seen = Observation()
    watched = batch.observe(seen, F.max(F.when(F.col(f"`{key}`").isNotNull(), F.unix_millis(F.col(f"`{arrival}`")))).alias("top"))
    path = f"{out}/epoch={epoch_id}"
    first_arrivals(watched, state, key, arrival, within_s).write.mode("overwrite").parquet(path)
    # a window began with the latest row that was let through
    new = spark.read.schema(batch.schema).parquet(path).select(
        F.col(f"`{key}`").alias("_key"), F.coalesce(F.unix_seconds(F.col(f"`{arrival}`")), F.lit(0)).alias("_first"))
    after = state.unionByName(new.where(F.col("_key").isNotNull())).groupBy("_key").agg(F.max("_first").alias("_first"))
    if mark is not None:
        after = after.where((F.col("_first") + within_s + lateness_s) * 1000 > mark)
    top = None if batch.isEmpty() else seen.get["top"]  # a batch without rows leaves no observation
    marks = [m for m in (mark, top) if m is not None]
    last = spark.range(1).select(F.lit(None).cast(fields["_key"].dataType).alias("_key"), F.lit(None).cast("bigint").alias("_first"),
                                 F.lit(max(marks) if marks else None).cast("bigint").alias("_mark"))
    after.withColumn("_mark", F.lit(None).cast("bigint")).unionByName(last).write.mode("overwrite").parquet(
        f"{states}/turn={epoch_id % 2}")
