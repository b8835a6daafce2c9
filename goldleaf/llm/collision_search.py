"""Nearest neighbours by inner product, with collision-counting hashing.

Equal vectors form one class, which keeps as many of its smallest ids as an
answer can use; the classes are indexed and searched, so a vector that a third of
all rows share is one entry and one question.

Index: classes are dealt into shards of about ``SHARD``. A shard scales its
vectors by its largest norm and adds one component that brings each to length
one. Between such vectors and a query scaled to length one, distance falls as the
inner product grows. Each of ``PROJECTIONS`` random directions gives an array of
the shard's projections in sorted order.

Search: around a query's own projection a window of half-width ``WIDTH * R`` is
open in every array; a vector collides with the query once for each window that
holds it. Virtual rehashing lets R grow; a narrow window is counted by walking
along what it gained, a wide one by comparing places in the array with its ends. Vectors that collide ``threshold()`` times are verified by their
inner product. The search of a shard ends when R reaches the distance of the
last place of the answer: a vector at that distance or nearer has had enough
collisions with probability ``1 - MISS`` at least. A task that searches a further
shard for the same queries starts with the R of the answer so far.

The query set meets every shard in blocks of ``BLOCK`` queries; a meeting gives
each query no more hits than its answer has places, and places are taken among
all shards' hits afterwards.

Audit: at most ``AUDIT`` query classes, chosen by hash, are compared with all
classes by brute force. Recall below ``RECALL`` is an error.

Cases: vectors that are null, empty, zero or hold a null or non-finite component
take no part, nor do rows with a null id; vectors meet only those of their own
length; rows that repeat both id and vector are one row, and rows with the
query's own id are never its neighbours; equal inner products are ranked by id;
an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.common import saved

NEAREST = 20
PROJECTIONS = 64
WIDTH = 1.5
MISS = 0.01
GROWTH = 1.25
NARROW = 64  # the first windows hold this part of a shard on either side
SHARD = 4096
BLOCK = 512
SEED = 13
AUDIT = 256
RECALL = 0.9
WALK = 12  # a step of a walk costs as much as so many comparisons
REMEMBERED = 64  # blocks of queries whose answer so far a task keeps
PARTS = 1024  # of a class's ids, so that no task gets all ids of a common vector


def threshold(projections: int = PROJECTIONS, width: float = WIDTH, miss: float = MISS) -> int:
    """The number of collisions that a vector at distance R reaches with
    probability ``1 - miss``: one is likely with that of a normal deviate within
    ``width``."""
    p, tail = math.erf(width / math.sqrt(2)), 0.0
    for k in range(projections + 1):
        tail += math.comb(projections, k) * p ** k * (1 - p) ** (projections - k)
        if tail > miss:
            return k
    return projections


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, vec) of the rows that take part, components as doubles."""
    for b in batches:
        ids, vecs = [], []
        for i, v in zip(b.column("vec_id").to_pylist(), b.column("embedding").to_pylist()):
            if i is None or v is None or any(x is None for x in v):
                continue
            x = np.asarray(v, np.float64) + 0.0  # no negative zeros: equal vectors get equal bytes
            if x.any() and np.isfinite(x).all():
                ids.append(i)
                vecs.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary())], ["vec_id", "vec"])


def _matrix(payload: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(payload, np.float64).reshape(-1, dim)


def _norms(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(1, keepdims=True)
    return top[:, 0] * np.sqrt(((x / top) ** 2).sum(1))


def _directions(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(size=(PROJECTIONS, dim + 1))


def classes_of(vectors: DataFrame, asks: Callable[[Column], Column], nearest: int = NEAREST) -> tuple[DataFrame, DataFrame]:
    """(classes, questions). Classes: (key, vec, ids, asked), ids being the
    ``nearest + 1`` smallest. Questions: (key, part, ids), all ids that
    ``asks`` takes for queries."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        _clean, "vec_id bigint, vec binary").withColumns(
        {"key": F.unhex(F.md5("vec")), "part": F.pmod(F.xxhash64("vec_id"), F.lit(PARTS))})
    parts = saved(rows.groupBy("key", "part").agg(
        F.first("vec").alias("vec"), F.sort_array(F.collect_set("vec_id")).alias("ids")).withColumn(
        "asking", F.filter("ids", asks)), "ann-parts")
    classes = saved(parts.groupBy("key").agg(
        F.first("vec").alias("vec"), F.max(F.size("asking") > 0).alias("asked"),
        F.slice(F.sort_array(F.flatten(F.collect_list(F.slice("ids", 1, nearest + 1)))), 1, nearest + 1).alias("ids")),
        "ann-classes")
    return classes, parts.where(F.size("asking") > 0).select("key", "part", F.col("asking").alias("ids"))


def build_index(classes: DataFrame, shards: int) -> DataFrame:
    """One row for each shard and vector length: its classes and sorted arrays."""
    dealt = classes.select("key", "vec", "ids", (F.length("vec") / 8).cast("int").alias("dim"),
                           F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    held = dealt.groupBy("dim", "shard").agg(F.collect_list(F.struct("vec", "ids")).alias("held"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, shard, rows in zip(b.column("dim").to_pylist(), b.column("shard").to_pylist(), b.column("held")):
                x = _matrix(b"".join(rows.values.field("vec").to_pylist()), dim)
                norms = _norms(x)
                top = float(norms.max())
                unit = np.column_stack([x / top, np.sqrt(np.maximum(0.0, 1 - (norms / top) ** 2))])
                values = (_directions(dim) @ unit.T).astype(np.float32)
                order = np.argsort(values, axis=1).astype(np.int32)
                values = np.take_along_axis(values, order, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([shard], pa.int64()), pa.array([top]),
                     pa.array([rows.values.field("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
                     *(pa.array([a.tobytes()], pa.binary()) for a in (x, values, order))],
                    ["dim", "shard", "top", "ids", "vecs", "sorted_values", "sorted_rows"])

    return held.mapInArrow(build, "dim int, shard bigint, top double, ids array<array<bigint>>, vecs binary, "
                                  "sorted_values binary, sorted_rows binary")


def search_shard(queries: np.ndarray, x: np.ndarray, top: float, values: np.ndarray, order: np.ndarray,
                 best: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows of ``x`` that were verified and their inner
    products. ``best`` are its best scores so far, falling; they are kept up."""
    needed, n, places = threshold(), len(x), best.shape[1]
    flat, starts = order.ravel(), np.arange(PROJECTIONS) * n
    place = np.empty(order.shape, np.uint16 if n < 1 << 16 else np.uint32)  # of each vector in each sorted array
    np.put_along_axis(place, order.astype(np.int64), np.arange(n, dtype=place.dtype)[None, :], 1)
    norms = _norms(queries)
    own = ((queries / norms[:, None]) @ _directions(queries.shape[1])[:, :-1].T).T.copy()
    counts = np.zeros((len(queries), n), np.uint8 if PROJECTIONS < 256 else np.int32)
    verified = np.zeros((len(queries), n), bool)
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[(np.zeros(0, np.int64), np.zeros(0))] for _ in queries]

    def reach(k) -> np.ndarray:
        """The distance of the last place, infinite while it is free; nan if no
        vector of this shard can take it."""
        cos = best[k, -1] / (norms[k] * top)
        far = np.sqrt(np.maximum(0.0, 2 - 2 * np.maximum(cos, -1.0)))
        return np.where(cos > 1 + 1e-9, np.nan, np.where(np.isneginf(cos), np.inf, far))

    def verify(k: int, rows: np.ndarray) -> None:
        if len(rows):
            verified[k, rows] = True
            score = (x @ queries[k])[rows] if 3 * len(rows) > n else x[rows] @ queries[k]
            found[k].append((rows, score))
            best[k] = -np.sort(-np.concatenate([best[k], score]))[:places]

    def walk(k: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Collisions along stretches of the sorted arrays."""
        steps = np.concatenate([flat[i:j] for i, j in zip(begins.tolist(), ends.tolist())])
        return np.bincount(steps, minlength=n).astype(counts.dtype)

    # without an answer to better, narrow windows come first: what collides most gives the first bound
    lo = np.stack([np.searchsorted(values[j], own[j]) for j in range(PROJECTIONS)])
    hi = lo.copy()
    radius = reach(np.arange(len(queries)))
    narrow = places + n // NARROW
    for k in np.nonzero(np.isinf(radius))[0].tolist():
        hi[:, k] = np.minimum(lo[:, k] + narrow, n)
        lo[:, k] = np.maximum(lo[:, k] - narrow, 0)
        counts[k] = walk(k, starts + lo[:, k], starts + hi[:, k])
        verify(k, np.argsort(-counts[k].astype(np.int16), kind="stable")[:2 * places])
        radius[k] = reach(k) / GROWTH
    radius = np.minimum(radius, 2.0)  # no distance is greater
    going = np.nonzero(~np.isnan(radius))[0]
    while len(going):
        was = lo[:, going], hi[:, going]
        for j in range(PROJECTIONS):
            mid, half = own[j, going], WIDTH * radius[going]
            lo[j, going] = np.minimum(was[0][j], np.searchsorted(values[j], mid - half, "left"))
            hi[j, going] = np.maximum(was[1][j], np.searchsorted(values[j], mid + half, "right"))
        gain = (was[0] - lo[:, going] + hi[:, going] - was[1]).sum(0)
        for col, k in enumerate(going.tolist()):
            if gain[col] * WALK < PROJECTIONS * n:  # walk along what the windows gain on their left and right
                counts[k] += walk(k, np.concatenate([starts + lo[:, k], starts + was[1][:, col]]),
                                  np.concatenate([starts + was[0][:, col], starts + hi[:, k]]))
            else:  # wide windows: compare every vector's place with the windows' ends
                wide = (hi[:, k] - lo[:, k]).astype(place.dtype)
                inside = place - lo[:, k].astype(place.dtype)[:, None] < wide[:, None]  # places before lo wrap round
                counts[k] = np.add.reduce(inside.view(np.uint8), axis=0, dtype=counts.dtype)
            verify(k, np.nonzero((counts[k] >= needed) & ~verified[k])[0])
        far = np.minimum(reach(going), 2.0)
        done = np.isnan(far) | (radius[going] >= far)
        going, far = going[~done], far[~done]
        radius[going] = np.minimum(radius[going] * GROWTH, far)
    return [tuple(map(np.concatenate, zip(*f))) for f in found]


def _meet(places: int):
    """A task function over (block, query keys and vectors, a shard's index)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far: OrderedDict[tuple, np.ndarray] = OrderedDict()
        for b in batches:
            for row in range(b.num_rows):
                dim, block, top, asked = (b.column(c)[row].as_py() for c in ("dim", "block", "top", "asked"))
                x = _matrix(b.column("vecs")[row].as_py(), dim)
                values = np.frombuffer(b.column("sorted_values")[row].as_py(), np.float32).reshape(PROJECTIONS, -1)
                order = np.frombuffer(b.column("sorted_rows")[row].as_py(), np.int32).reshape(PROJECTIONS, -1)
                ids = b.column("ids")[row].values
                queries = _matrix(b"".join(a["vec"] for a in asked), dim)
                best = so_far.pop((dim, block), None)
                if best is None:
                    best = np.full((len(queries), places), -np.inf)
                found = search_shard(queries, x, top, values, order, best)
                so_far[dim, block] = best
                if len(so_far) > REMEMBERED:
                    so_far.popitem(last=False)
                out: tuple[list, list, list] = ([], [], [])
                for a, (rows, score), last in zip(asked, found, best[:, -1]):
                    rows, score = rows[score >= last], score[score >= last]
                    hits = sorted((-s, i) for r, s in zip(rows.tolist(), score.tolist()) for i in ids[r].as_py())[:places]
                    out[0].extend([a["key"]] * len(hits))
                    out[1].extend(-s for s, _ in hits)
                    out[2].extend(i for _, i in hits)
                yield _hits(*out)

    return run


HITS = "key binary, score double, vec_id bigint"


def _hits(keys: list, scores: list, ids: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(scores, pa.float64()), pa.array(ids, pa.int64())],
                                      ["key", "score", "vec_id"])


def _top(hits: DataFrame, places: int) -> DataFrame:
    """(key, near): the best ``places`` (score, vec_id) of each key."""
    w = Window.partitionBy("key").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("place", F.row_number().over(w)).where(F.col("place") <= places).groupBy("key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "score", "vec_id"))),
                    lambda h: F.struct(h["score"].alias("score"), h["vec_id"].alias("vec_id"))).alias("near"))


def brute_force(sample: DataFrame, classes: DataFrame, places: int, most: int = AUDIT) -> DataFrame:
    """(key, near) of at most ``most`` classes, compared with all classes. The
    sample is bounded, so the tasks get it whole, each with its block of vectors."""
    by_dim: dict[int, list] = {}
    for r in sample.select("key", "vec").orderBy("key").limit(most).collect():
        by_dim.setdefault(len(r["vec"]) // 8, []).append((bytes(r["key"]), bytes(r["vec"])))
    by_dim = {d: ([k for k, _ in rows], _matrix(b"".join(v for _, v in rows), d)) for d, rows in by_dim.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs, ids = b.column("vec").to_pylist(), b.column("ids")
            size = np.array([len(v) // 8 for v in vecs])
            out: tuple[list, list, list] = ([], [], [])
            for dim, (keys, q) in by_dim.items():
                own = np.nonzero(size == dim)[0]
                if not len(own):
                    continue
                score = q @ _matrix(b"".join(vecs[k] for k in own), dim).T
                for key, s in zip(keys, score):
                    last = -np.sort(-s)[min(places, len(s)) - 1]
                    rows = np.nonzero(s >= last)[0]
                    hits = sorted((-s[r], i) for r in rows.tolist() for i in ids[int(own[r])].as_py())[:places]
                    out[0].extend([key] * len(hits))
                    out[1].extend(-v for v, _ in hits)
                    out[2].extend(i for _, i in hits)
            yield _hits(*out)

    return _top(classes.select("vec", "ids").mapInArrow(run, HITS), places)


def recall(found: DataFrame, truth: DataFrame) -> float | None:
    """Share of the true ids found, averaged over the keys of ``truth``."""
    ids = lambda c: F.transform(F.coalesce(c, F.array()), lambda h: h["vec_id"])
    both = truth.join(found.select("key", F.col("near").alias("got")), "key", "left")
    share = F.size(F.array_intersect(ids("near"), ids("got"))) / F.size("near")
    return both.agg(F.avg(share)).first()[0]


def nearest(vectors: DataFrame, asks: Callable[[Column], Column], places: int = NEAREST, least: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``places`` nearest rows of ``vectors``
    (vec_id, embedding) to each row whose id ``asks`` takes."""
    spark = vectors.sparkSession
    classes, questions = classes_of(vectors, asks, places)
    n, asked = classes.agg(F.count("*"), F.count_if("asked")).first()
    shards, blocks = max(1, math.ceil(n / SHARD)), max(1, math.ceil(asked / BLOCK))
    index = saved(build_index(classes, shards), "ann-index")
    packed = classes.where("asked").groupBy(
        (F.length("vec") / 8).cast("int").alias("dim"), F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("key", "vec")).alias("asked"))
    # a meeting is little to read and much to compute: as many tasks as shards, which AQE must not fold
    tasks = min(shards, max(1000, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    sent = packed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    meetings = index.repartition(tasks, "dim", "shard").hint("shuffle_merge").join(
        sent.repartition(tasks, "dim", "shard"), ["dim", "shard"])
    hits = meetings.select("dim", "block", "top", "asked", "vecs", "ids", "sorted_values", "sorted_rows").mapInArrow(
        _meet(places + 1), HITS)
    found = saved(_top(hits, places + 1), "ann-found")
    got = recall(found, brute_force(classes.where("asked"), classes, places + 1))
    if got is not None and got < least:
        raise RuntimeError(f"collision search: recall {got:.4f} in the audit is below {least}")
    own = questions.join(found, "key").repartition(F.col("key"), F.col("part")).select(F.explode("ids").alias("query_id"), "near")
    others = F.slice(F.filter("near", lambda h: h["vec_id"] != F.col("query_id")), 1, places)
    return own.select("query_id", F.posexplode(others).alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), "hit.vec_id", "hit.score")
