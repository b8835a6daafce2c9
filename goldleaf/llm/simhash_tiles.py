"""SimHash near-dedup by tiled exact comparison.

Every text gets a 64-bit fingerprint. Distinct fingerprints are sorted into
cells by the bit counts of their two 32-bit halves and cut into tiles. The
counts of two fingerprints differ by no more than their Hamming distance, so a
pair of tiles is compared only if the counts of their cells differ by the radius
or less in sum; the others are skipped without loss. Two tiles are compared by
numpy exclusive-or and bit counts, each pair of tiles in one row of its own. A
pair of tiles answers with links that join what it found linked (a forest, not
all pairs), which keeps every connection. Components follow from the links.

Cases: null text counts as empty (fingerprint 0, linked like any other); a
null doc_id gets a fingerprint and the component of its text's group, but is
never a component's smallest id unless no other id is there (then null); rows
that repeat a doc_id are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import saved
from goldleaf.llm.components import components

SHINGLE = 4
RADIUS = 4
TILE = 1024
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text over word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII rules only, as bytes
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n = max(1, len(words) - shingle + 1)
    last = ends[len(words) - n:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, last)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        part = hashes[k:k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` holds the 64 bits as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint")


def _forest(near: np.ndarray, n: int) -> np.ndarray:
    """Roots of ``n`` vertices under the index pairs ``near`` (2 x m)."""
    root = np.arange(n)
    a, b = near
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(left: bytes, right: bytes, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints of two tiles: a spanning forest."""
    x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    rows, cols = [], []
    for k in range(0, len(x), 256):
        i, j = np.nonzero(np.bitwise_count(x[k:k + 256, None] ^ y[None, :]) <= radius)
        rows.append(i + k)
        cols.append(j)
    i, j = np.concatenate(rows), np.concatenate(cols)
    every = x if same else np.concatenate([x, y])
    if not same:
        j = j + len(x)
    root = _forest(np.stack([i, j]), len(every))
    child = np.nonzero(root != np.arange(len(every)))[0]
    return every[child].view(np.int64), every[root[child]].view(np.int64)


def near_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column ``fp``)
    within ``radius`` bits of each other."""
    halves = [F.bit_count(F.shiftrightunsigned("fp", 32)), F.bit_count(F.col("fp").bitwiseAND(0xFFFFFFFF))]
    cells = fps.select("fp").distinct().select("fp", halves[0].alias("hi"), halves[1].alias("lo"))
    sizes = cells.groupBy("hi", "lo").agg(F.ceil(F.count("*") / tile).alias("parts"))  # at most 33 x 33 rows
    cells = saved(cells, "simhash-cells")
    tiles = cells.join(F.broadcast(sizes), ["hi", "lo"]).withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # a tile is gathered by its own key and holds about ``tile`` fingerprints
    packed = saved(tiles.groupBy("hi", "lo", "part").agg(F.collect_list("fp").alias("fps")), "simhash-tiles")
    steps = [(d, e) for d in range(radius + 1) for e in range(-radius, radius + 1)
             if abs(d) + abs(e) <= radius and (d > 0 or e >= 0)]
    reach = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(e).alias("e")) for d, e in steps])
    left = packed.select("hi", "lo", F.col("part").alias("l_part"), F.col("fps").alias("l"), F.inline(reach)).select(
        (F.col("hi") + F.col("d")).alias("hi"), (F.col("lo") + F.col("e")).alias("lo"), "l_part", "l",
        ((F.col("d") == 0) & (F.col("e") == 0)).alias("own"))
    pairs = left.join(packed, ["hi", "lo"]).where("not own or l_part <= part")
    pairs = pairs.select("l", F.col("fps").alias("r"), (F.col("own") & (F.col("l_part") == F.col("part"))).alias("same"))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = (np.asarray(batch.column(c)[k].values, np.int64).tobytes() for c in ("l", "r"))
                a, b = _compare(x, y, batch.column("same")[k].as_py(), radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs``: doc_id, fp and component_id, the smallest doc_id
    that links of at most ``radius`` differing bits reach."""
    prints = saved(with_fingerprints(docs, shingle), "simhash-prints")
    classes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    groups = components(near_links(classes, radius))
    linked = classes.join(groups, classes.fp == groups.id, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    # fingerprint -> smallest id of its component; groups are whole by now
    named = saved(linked.join(smallest, "component").select("fp", "component_id"), "simhash-named")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with the smallest doc_id of every group of near copies. Rows
    without a doc_id can't stand for a group and stay; so do all rows that
    repeat the kept doc_id."""
    gone = (simhash_groups(docs, shingle, radius).where("doc_id <> component_id")
            .select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, docs.doc_id == gone["_gone"], "left_anti")
