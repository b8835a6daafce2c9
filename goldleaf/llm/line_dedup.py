"""Reversible line dedup over an index of three kinds of table.

* *postings*: one row per distinct (line key, document), the exact references;
* *refs*: per line key how many documents hold it and the smallest of them;
* *filters*: per shard of the key space one cuckoo filter for each insertion,
  with 16-bit marks, four to a bucket.

An insertion counts the references of its own batch, asks the shard's filters
which keys may be known, and reads the exact table only for those; a key the
filters deny is surely new. Its new keys then become the shard's next filter. A
deletion takes the documents' postings out, lowers the counts, looks for a new
smallest holder among the postings that are left, and takes keys that nobody
holds any more out of the filters. So inserting and deleting a document leaves
the index as it was, and the exact tables alone decide what a line's state is.

A line's key is the line without ASCII white space at both ends and with A-Z
lower-cased, as two halves of a 128-bit hash. Shards hold a bounded number of
keys, since their number is chosen from the number of keys expected.

Cases: a null or empty text is one empty line; a null doc_id names no document:
its rows keep all lines and count for no key; rows that repeat a doc_id are one
document for the counts; other columns are kept by :func:`drop_lines`; empty
tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from goldleaf.llm.common import saved, widened

SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
SHARD_KEYS = 100_000
SLOTS = 4
LINE_BYTES = 64  # guess of a line's length, to choose the number of shards
KEY = "h1 bigint, h2 bigint"
FILTER = "shard int, segment int, buckets long, marks binary"


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """The 16-byte key of every line; None where the line is too short."""
    out = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = line.strip(SPACE).lower()
        long = len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


# ---- cuckoo filter of one shard and insertion ----------------------------

def _mark(h2: np.ndarray) -> np.ndarray:
    return ((h2.view(np.uint64) >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)


def _other(bucket: np.ndarray, mark: np.ndarray, buckets: int) -> np.ndarray:
    spread = (mark.astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(3)
    return bucket ^ (spread & np.uint64(buckets - 1)).astype(np.int64)


def _home(h1: np.ndarray, buckets: int) -> np.ndarray:
    return ((h1.view(np.uint64) >> np.uint64(20)) & np.uint64(buckets - 1)).astype(np.int64)


def build_filter(h1: np.ndarray, h2: np.ndarray) -> tuple[int, bytes]:
    """Cuckoo filter over distinct keys: whole arrays are placed per round, a
    full bucket gives up a mark to its other bucket. Doubles when it is full."""
    buckets = 1 << max(0, int(np.ceil(np.log2(max(1, len(h1)) / (SLOTS * 0.85)))))
    while True:
        table = np.zeros((buckets, SLOTS), np.uint16)
        mark, at = _mark(h2), _home(h1, buckets)
        rng = np.random.default_rng(7)
        for _ in range(500):
            order = np.argsort(at, kind="stable")
            at, mark = at[order], mark[order]
            first = np.searchsorted(at, at, side="left")
            place = np.arange(len(at)) - first + (table[at] != 0).sum(1)
            fits = place < SLOTS
            table[at[fits], place[fits]] = mark[fits]
            at, mark = at[~fits], mark[~fits]
            if not len(at):
                return buckets, table.tobytes()
            # one swap per full bucket; the others try their other bucket
            head = np.r_[True, at[1:] != at[:-1]]
            slot = rng.integers(0, SLOTS, head.sum())
            out = table[at[head], slot].copy()
            table[at[head], slot] = mark[head]
            mark[head] = out
            at = _other(at, mark, buckets)
        buckets *= 2


def probe(buckets: int, marks: bytes, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    table = np.frombuffer(marks, np.uint16).reshape(buckets, SLOTS)
    mark, at = _mark(h2), _home(h1, buckets)
    return ((table[at] == mark[:, None]) | (table[_other(at, mark, buckets)] == mark[:, None])).any(1)


def take_out(buckets: int, marks: bytes, h1: np.ndarray, h2: np.ndarray) -> bytes:
    """The filter without one mark for each given key (all must be in it)."""
    table = np.frombuffer(marks, np.uint16).reshape(buckets, SLOTS).copy()
    mark, at = _mark(h2), _home(h1, buckets)
    for m, a, b in zip(mark, at, _other(at, mark, buckets)):
        for k in (a, b):
            here = np.nonzero(table[k] == m)[0]
            if len(here):
                last = np.nonzero(table[k])[0][-1]  # keep buckets packed
                table[k, here[0]] = table[k, last]
                table[k, last] = 0
                break
    return table.tobytes()


# ---- the index -----------------------------------------------------------

@dataclass(frozen=True)
class LineIndex:
    """Postings (h1, h2, doc_id), refs (shard, h1, h2, n, owner, segment) and
    filters; ``segments`` counts insertions."""

    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    segments: int = 0
    min_chars: int = MIN_CHARS

    @classmethod
    def empty(cls, spark: SparkSession, expected_keys: int, min_chars: int = MIN_CHARS) -> LineIndex:
        return cls(spark.createDataFrame([], f"{KEY}, doc_id bigint"),
                   spark.createDataFrame([], f"shard int, {KEY}, n bigint, owner bigint, segment int"),
                   spark.createDataFrame([], FILTER), max(1, -(-expected_keys // SHARD_KEYS)), 0, min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with ``docs`` in it; their doc_ids must be new to it."""
        return self.insert_keys(saved(document_keys(docs, self.min_chars), "lines-postings"))

    def insert_keys(self, new: DataFrame) -> LineIndex:
        """As :meth:`insert`, from distinct written (h1, h2, doc_id)."""
        new = new.select("h1", "h2", "doc_id")
        shard = F.pmod("h1", F.lit(self.shards)).cast("int")
        counted = saved(new.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("owner"))
                        .withColumn("shard", shard), "lines-counts")
        counted = counted.withColumn("segment", F.lit(self.segments))
        if self.segments == 0:
            fresh, refs, postings = counted, counted, new
        else:
            asked = saved(self._ask(counted), "lines-asked")
            known = self.refs.select("h1", "h2", F.col("n").alias("n0"), F.col("owner").alias("o0"),
                                     F.col("segment").alias("s0"))
            maybe = asked.where("maybe").join(known, ["h1", "h2"], "left")
            merged = maybe.select(
                "shard", "h1", "h2", (F.col("n") + F.coalesce("n0", F.lit(0))).alias("n"),
                F.least("owner", "o0").alias("owner"), F.coalesce("s0", "segment").alias("segment"),
                F.col("n0").isNull().alias("fresh"))
            merged = saved(merged.unionByName(asked.where("not maybe").drop("maybe").withColumn("fresh", F.lit(True))),
                           "lines-merged")
            fresh = merged.where("fresh")
            touched = merged.where("not fresh").select("h1", "h2")
            refs = saved(self.refs.join(touched, ["h1", "h2"], "left_anti").unionByName(merged.drop("fresh")), "lines-refs")
            postings = self.postings.unionByName(new)
        filters = saved(self.filters.unionByName(_new_filters(fresh, self.segments)), "lines-filters")
        return replace(self, postings=postings, refs=refs, filters=filters, segments=self.segments + 1)

    def _ask(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``maybe``: whether a filter of the shard knows it."""
        def run(own: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            h1, h2 = own["h1"].to_numpy(np.int64), own["h2"].to_numpy(np.int64)
            seen = np.zeros(len(own), bool)
            for buckets, marks in zip(filters["buckets"], filters["marks"]):
                seen |= probe(int(buckets), marks, h1, h2)
            return own.assign(maybe=seen)

        schema = f"{KEY}, n bigint, owner bigint, shard int, segment int, maybe boolean"
        return (keys.select("h1", "h2", "n", "owner", "shard", "segment").groupBy("shard")
                .cogroup(self.filters.groupBy("shard")).applyInPandas(run, schema))

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents of column ``doc_id``."""
        ids = doc_ids.select("doc_id").distinct()
        left = saved(self.postings.join(ids, "doc_id", "left_anti").select("h1", "h2", "doc_id"), "lines-postings")
        gone = saved(self.postings.join(ids, "doc_id", "left_semi").select("h1", "h2").distinct(), "lines-gone")
        now = left.join(gone, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(
            F.count("*").alias("n1"), F.min("doc_id").alias("o1"))
        changed = saved(self.refs.join(gone, ["h1", "h2"], "left_semi").join(now, ["h1", "h2"], "left"), "lines-changed")
        refs = saved(self.refs.join(gone, ["h1", "h2"], "left_anti").unionByName(
            changed.where("n1 is not null").select("shard", "h1", "h2", F.col("n1").alias("n"),
                                                   F.col("o1").alias("owner"), "segment")), "lines-refs")
        lost = changed.where("n1 is null").select("shard", "segment", "h1", "h2")

        def run(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            rows = [(s, g, n, take_out(int(n), m, *(keys.loc[keys["segment"] == g, c].to_numpy(np.int64) for c in ("h1", "h2"))))
                    for s, g, n, m in filters[["shard", "segment", "buckets", "marks"]].itertuples(index=False)]
            return pd.DataFrame(rows, columns=["shard", "segment", "buckets", "marks"])

        filters = saved(self.filters.groupBy("shard").cogroup(lost.groupBy("shard")).applyInPandas(run, FILTER), "lines-filters")
        return replace(self, postings=left, refs=refs, filters=filters)

    def repeats(self) -> DataFrame:
        """(doc_id, keys): per document the keys it loses, all held by a
        document with a smaller id. Both join sides are plain shuffles of
        written tables, so the partition of a very common line can be split."""
        shared = self.refs.where("n >= 2").select("h1", "h2", "owner")
        lost = self.postings.join(shared, ["h1", "h2"]).where("doc_id <> owner")
        return lost.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("lost"))


def _new_filters(keys: DataFrame, segment: int) -> DataFrame:
    def run(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        buckets, marks = build_filter(own["h1"].to_numpy(np.int64), own["h2"].to_numpy(np.int64))
        return pd.DataFrame([(key[0], segment, buckets, marks)], columns=["shard", "segment", "buckets", "marks"])

    return keys.select("shard", "h1", "h2").groupBy("shard").applyInPandas(run, FILTER)


def document_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Distinct (h1, h2, doc_id) of all lines that are long enough."""
    def run(batches):
        for b in batches:
            ids, keys = [], []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                own = {k for k in line_keys(t, min_chars) if k}
                keys += own
                ids += [d] * len(own)
            h = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64())], ["h1", "h2", "doc_id"])

    rows = docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(run, f"{KEY}, doc_id bigint")
    return rows.distinct()


def drop_lines(docs: DataFrame, index: LineIndex) -> DataFrame:
    """``docs`` with ``kept`` (the text without its repeated lines), ``n_lines``
    and ``n_dropped``; all other columns stay (those three names are replaced)."""
    docs = docs.drop("kept", "n_lines", "n_dropped")
    lost = index.repeats().withColumnsRenamed({"doc_id": "_lost_doc", "lost": "_lost"})
    joined = docs.join(lost, docs.doc_id == lost["_lost_doc"], "left").drop("_lost_doc")
    min_chars = index.min_chars

    def run(batches):
        for b in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, keys in zip(b.column("text").to_pylist(), b.column("_lost").to_pylist()):
                lines = (text or "").split("\n")
                gone = {np.array([k["h1"], k["h2"]], np.int64).tobytes() for k in keys or ()}
                stay = [x for x, k in zip(lines, line_keys(text, min_chars)) if k not in gone] if gone else lines
                kept.append("\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            out = b.drop_columns(["_lost"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                [*out.schema.names, "kept", "n_lines", "n_dropped"])

    schema = widened(joined.drop("_lost"), kept=StringType(), n_lines=LongType(), n_dropped=LongType())
    return joined.mapInArrow(run, schema)



def dedup_lines(docs: DataFrame, batches: int = 2, min_chars: int = MIN_CHARS) -> DataFrame:
    """Line dedup of a whole table: it is inserted into an empty index in
    ``batches`` parts (by a hash of doc_id), then every text is rewritten.
    The outcome does not depend on the parts."""
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    index = LineIndex.empty(docs.sparkSession, size // LINE_BYTES, min_chars)
    keys = saved(document_keys(docs, min_chars), "lines-keys")
    for k in range(batches):
        index = index.insert_keys(keys.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k))
    return drop_lines(docs, index)
