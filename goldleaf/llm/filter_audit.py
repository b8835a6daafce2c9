"""Filter interaction audit by contraction of contingency tensors.

Every document gets one bit for each filter it fails. Documents are counted by
part and combination of bits; a part's counts, reshaped to an axis of length two
for each filter, are a contingency tensor. Any count of the audit is then a
contraction that takes *pass*, *fail* or *all* along each axis: after the steps
o1..ok of an order, ``kept`` passes along o1..ok and takes all along the rest,
``removed`` fails along ok and passes along the steps before it. No document is
read again for any of the orders.

The copies filter (the last letter) fails a document whose text a smaller
doc_id holds anywhere in the table. Rows are counted by text, part, bits and
labels before texts meet, so a text that a third of all documents share is a
few rows for each part.

Cases: a null text is an empty one; a null part is ''; a null doc_id has no
labels, is nobody's smaller doc_id and is no copy; rows that repeat a doc_id are
documents of their own, but no copies of each other; a doc_id with several rows
of labels is good or toxic if any of them says so; texts are read whole, however
long; empty tables give no rows; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.common import let

SPACE = r"[\x20\x09-\x0D]+"
COPIES = "E"
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)


def text_failures(text: Column) -> Column:
    """The contract's filters on a text alone, as a struct of booleans."""
    def judged(words: Column) -> Column:
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
        return F.struct((n < 100).alias("A"), (100 * distinct < 80 * n).alias("B"),
                        (100 * capitals > 10 * F.char_length(text)).alias("C"), text.rlike("[#$%&*|]").alias("D"))

    return let(F.array_remove(F.split(text, SPACE), ""), judged)


def count_failures(docs: DataFrame, labels: DataFrame, letters: str = "ABCD",
                   failures: Callable[[Column], Column] = text_failures, part: str = "lang") -> DataFrame:
    """(part, cell, n, good, toxic): documents by part and failed filters; bit k
    of ``cell`` is letter k, the bit after the last one is the copies filter."""
    text = F.coalesce("text", F.lit(""))
    bits = let(failures(text), lambda f: sum(f[c].cast("int") * (1 << k) for k, c in enumerate(letters)))
    # a null doc_id meets no label, so any key but one and the same will do
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(part, F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("text_key"), bits.alias("bits")).groupBy(
        "doc_id", "part", "text_key", "bits").agg(F.count("*").alias("n")).withColumns(
        {"named": F.col("doc_id").isNotNull(), "label_key": F.coalesce("doc_id", F.xxhash64("text_key"))})
    says = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn("named", F.lit(True))
    told = rows.join(says, ["label_key", "named"], "left")
    held = told.groupBy("text_key", "part", "bits", F.coalesce("good", F.lit(False)).alias("good"),
                        F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("low"),
        (F.coalesce(F.min_by("n", "doc_id"), F.lit(0))).alias("n_low"),
        F.sum(F.when(F.col("named"), 0).otherwise(F.col("n"))).alias("unnamed"))
    lowest = F.min("low").over(Window.partitionBy("text_key"))
    first = F.col("unnamed") + F.when(F.col("low") == F.col("lowest"), F.col("n_low")).otherwise(0)
    split = held.withColumn("lowest", lowest).withColumn("first", first).select(
        "part", "good", "toxic", F.inline(F.array(
            F.struct(F.col("bits").alias("cell"), F.col("first").alias("n")),
            F.struct((F.col("bits") + (1 << len(letters))).alias("cell"), (F.col("n") - F.col("first")).alias("n")))))
    return split.groupBy("part", "cell").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def _selectors(orders: list[tuple[int, ...]], filters: int) -> dict[str, np.ndarray]:
    """For each (order, step): what to take along each axis, by kind of count."""
    kept, removed, alone, failing = [], [], [], []
    for order in orders:
        for step, f in enumerate(order):
            before = order[:step]
            kept.append([_PASS if a == f or a in before else _ALL for a in range(filters)])
            removed.append([_FAIL if a == f else _PASS if a in before else _ALL for a in range(filters)])
            alone.append([_FAIL if a == f else _PASS for a in range(filters)])
            failing.append([_FAIL if a == f else _ALL for a in range(filters)])
    return {k: np.array(v, np.int64) for k, v in
            {"kept": kept, "removed": removed, "alone": alone, "failing": failing}.items()}


def _contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Counts (part, order and step) of ``tensor`` (part, 2, .., 2)."""
    axes = "abcdefghijklmno"[:tensor.ndim - 1]
    terms = ",".join(f"n{a}" for a in axes)
    return np.einsum(f"p{axes},{terms}->pn", tensor, *(chosen[:, a] for a in range(len(axes))), optimize="greedy")


def audit_counts(cells: DataFrame, letters: str = "ABCD" + COPIES) -> DataFrame:
    """(part, filter_order, step and MEASURES) of every order of ``letters``
    from counts like those of :func:`count_failures`. A part is a row of at most
    2 ** filters cells."""
    k = len(letters)
    per_part = cells.groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = list(permutations(range(k)))
        pick = _selectors(orders, k)
        names = np.repeat(["".join(letters[f] for f in o) for o in orders], k)
        steps = np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders))
        own = np.array(orders).ravel()  # the filter of each order and step
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                flat = np.zeros((3, part.num_rows, 1 << k), np.int64)
                for row, counted in enumerate(part.column("cells").to_pylist()):
                    for c in counted:
                        flat[:, row, c["cell"]] = c["n"], c["good"], c["toxic"]
                # bit 0 is the last axis of a C-ordered reshape: turn the axes round
                n, good, toxic = (x.reshape(-1, *[2] * k).transpose(0, *range(k, 0, -1)) for x in flat)
                out = {m: _contract(n, pick[m]) for m in ("kept", "removed")}
                out["redundant"] = _contract(n, pick["failing"]) - out["removed"]
                out["unique_fails"] = _contract(n, pick["alone"])
                out["good_lost"], out["toxic_lost"] = (_contract(x, pick["removed"]) for x in (good, toxic))
                per_filter = np.stack([out["removed"][:, own == f].sum(1) for f in range(k)], 1)
                out["shapley"] = per_filter[:, own]
                rows = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(part.column("part").to_pylist(), object), len(steps)), pa.string()),
                     pa.array(np.tile(names, rows), pa.string()), pa.array(np.tile(steps, rows)),
                     *(pa.array(out[m].ravel()) for m in MEASURES)], ["part", "filter_order", "step", *MEASURES])

    return per_part.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the contract's five filters over ``docs`` (doc_id, text,
    lang), with ``labels`` (doc_id, quality, toxic)."""
    return audit_counts(count_failures(docs, labels))
