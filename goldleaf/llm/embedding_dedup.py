"""Embedding near-dedup by NN-descent.

1. Equal vectors form one class with its number of rows; the graph is over
   classes, so a vector that holds a third of all rows is one vertex.
2. Sign codes of random hyperplanes deal the classes into leaves, once for each
   tree; the best few neighbours within a leaf start the neighbour graph.
   Leaves beyond a size are split by a hash, so no task gets an unbounded one.
3. NN-descent: the neighbours and reverse neighbours of a vertex meet and offer
   each other as neighbours, until few lists change. A vertex with very many
   reverse neighbours lets them meet in several groups.
   Of all pairs at the threshold that meet in a leaf or a meeting a spanning
   forest is kept, whatever the lists have room for.
4. Edges at the threshold give components. A vertex whose whole list is above
   the threshold is saturated: only nearer ones of its own group are offered to
   it. So saturated vertices look for neighbours outside their components, by the
   same steps, until no component gets a link any more. Then every list is
   enlarged to its component: tiles of a component are compared with each other by
   numpy and only counts leave the task, so a dense group costs no table of pairs.
5. Audit: a bounded sample of classes is compared with all vectors by brute
   force. Recall is the share of its true partners that a class is grouped with,
   averaged over classes and then over components, so a dense group counts once.
   Below the wanted recall, or where the sample has no pair to tell by, the graph
   grows by other trees and the steps repeat; a recall still below it is an error.
   The true pairs that the audit finds join the links.

All cosines are computed in double precision.

Cases: vectors that are null, zero, or hold a null or non-finite component link
with nothing and are their own component; so do vectors of different lengths with
each other; a null vec_id has links like any row but is no component's smallest
id unless there is no other (then null) and is not kept; rows that repeat a
vec_id are vectors of their own; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import saved
from goldleaf.llm.components import components

THRESHOLD = 0.95
NEIGHBOURS = 12
TREES = 10
LEAF = 96
MAX_LEAF = 512
MEETING = 64
TILE = 256
MAX_STEPS = 6
SETTLED = 0.005
AUDIT = 512
RECALL = 0.97
LEAF_CHANCE = 0.975  # that some tree deals a pair at THRESHOLD into one leaf

_LOG = logging.getLogger(__name__)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, vec): the components as doubles; null where they can't link."""
    for b in batches:
        out = []
        for v in b.column("embedding").to_pylist():
            if v is None or any(x is None for x in v):
                out.append(None)
                continue
            x = np.asarray(v, np.float64)
            out.append((x + 0.0).tobytes() if np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "vec"])


def unit(vecs: list[bytes]) -> np.ndarray:
    """Rows of length one. All vectors must have the same length."""
    x = np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # large components must not overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _best(ids: np.ndarray, grp: np.ndarray, cos: np.ndarray, most: int, threshold: float, floor: np.ndarray | None = None):
    """The ``most`` nearest of each row (a, b, cos) that are above ``floor`` and of
    another group, and a spanning forest, both ways, of all such pairs at the
    ``threshold``, so that no pair that was compared is lost to a full list."""
    cos[grp[:, None] == grp[None, :]] = -2
    k = min(most, len(ids) - 1)
    if k < 1:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    a, b = np.repeat(np.arange(len(ids)), k), top.ravel()
    c = cos[a, b]
    keep = (c > -2) & (c > (-2 if floor is None else floor[a]))
    i, j = _forest(cos >= threshold)
    a, b, c = np.r_[a[keep], i, j], np.r_[b[keep], j, i], np.r_[c[keep], cos[i, j], cos[j, i]]
    return ids[a], ids[b], c


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): a spanning forest of the links that a symmetric matrix holds."""
    left = near.any(1)
    ends: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
    while left.any():
        reach = [int(np.argmax(left))]
        left[reach[0]] = False
        while reach:
            i = reach.pop()
            j = np.nonzero(near[i] & left)[0]
            left[j] = False
            ends.append((np.full(len(j), i), j))
            reach.extend(j.tolist())
    return np.concatenate([i for i, _ in ends]), np.concatenate([j for _, j in ends])


def _edges(a, b, cos) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(cos)], ["a", "b", "cos"])


EDGES = "a bigint, b bigint, cos double"


def _depth(n: int) -> int:
    """Planes of a tree over ``n`` classes."""
    return max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))


def trees_for(n: int) -> int:
    """TREES, or more where deeper trees part a pair at THRESHOLD too often."""
    together = (1 - np.arccos(THRESHOLD) / np.pi) ** _depth(n)
    return max(TREES, int(np.ceil(np.log(1 - LEAF_CHANCE) / np.log1p(-together)))) if together < 1 else TREES


def _leaf_edges(classes: DataFrame, n: int, seed: int, trees: int, threshold: float) -> DataFrame:
    depth = _depth(n)

    def deal(batches):
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            for k in range(b.num_rows):
                vec = b.column("vec")[k].as_py()
                dim = len(vec) // 8
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).normal(size=(trees * depth, dim))
                signs = (planes[dim] @ np.frombuffer(vec, np.float64) > 0).reshape(trees, depth)
                codes = signs @ (1 << np.arange(depth, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([b.column(c)[k].as_py()] * trees, pa.int64()) for c in ("cid", "grp")),
                     pa.array([vec] * trees, pa.binary()), pa.array([dim] * trees, pa.int32()),
                     pa.array(range(trees), pa.int32()), pa.array(codes.astype(np.int64))],
                    ["cid", "grp", "vec", "dim", "tree", "code"])

    dealt = saved(classes.select("cid", "grp", "vec").mapInArrow(
        deal, "cid bigint, grp bigint, vec binary, dim int, tree int, code bigint"), "embed-leaves")
    sizes = dealt.groupBy("dim", "tree", "code").agg(F.ceil(F.count("*") / MAX_LEAF).alias("parts"))
    parts = dealt.join(sizes, ["dim", "tree", "code"]).withColumn(
        "part", F.pmod(F.xxhash64("cid", "tree"), F.col("parts")))
    leaves = parts.groupBy("dim", "tree", "code", "part").agg(
        F.collect_list(F.struct("cid", "grp", "vec")).alias("m"))

    def compare(batches):
        for b in batches:
            for row in b.column("m"):
                m = row.values
                x = unit(m.field("vec").to_pylist())
                yield _edges(*_best(np.asarray(m.field("cid")), np.asarray(m.field("grp")), x @ x.T, NEIGHBOURS // 2, threshold))

    return leaves.select("m").mapInArrow(compare, EDGES)


def _lists(edges: DataFrame, threshold: float) -> DataFrame:
    """(a, near): the NEIGHBOURS best distinct (cos, b) of each vertex, best first,
    and after them all others at the threshold. A list gets at most what trees and
    meetings offer it."""
    ranked = F.sort_array(F.collect_list(F.struct("cos", "b")), asc=False)
    return edges.groupBy("a", "b").agg(F.max("cos").alias("cos")).groupBy("a").agg(ranked.alias("near")).select(
        "a", F.filter("near", lambda x, k: (k < NEIGHBOURS) | (x["cos"] >= threshold)).alias("near"))


def _nearest(lists: DataFrame) -> DataFrame:
    """(a, b): the NEIGHBOURS best of each list, which are the graph to descend."""
    return lists.select("a", F.explode(F.slice("near", 1, NEIGHBOURS)["b"]).alias("b"))


def _offers(lists: DataFrame, classes: DataFrame, threshold: float, known: DataFrame | None = None) -> DataFrame:
    """What neighbours of neighbours offer: edges above a list's last entry, and
    those at the threshold. ``known`` are further edges to meet by."""
    out = _nearest(lists) if known is None else _nearest(lists).unionByName(known)
    both = out.select(F.col("a").alias("pivot"), F.col("b").alias("cid")).unionByName(
        out.select(F.col("b").alias("pivot"), F.col("a").alias("cid"))).distinct()
    sizes = both.groupBy("pivot").agg(F.ceil(F.count("*") / MEETING).alias("parts"))
    placed = both.join(sizes, "pivot").withColumn("part", F.pmod(F.xxhash64("cid", "pivot"), F.col("parts")))
    floor = F.coalesce(F.get("near", F.lit(NEIGHBOURS - 1))["cos"], F.lit(-2.0))
    members = classes.select("cid", "grp", "vec").join(lists.select(F.col("a").alias("cid"), floor.alias("floor")), "cid", "left")
    meetings = placed.join(members, "cid").groupBy("pivot", "part", F.length("vec").alias("bytes")).agg(
        F.collect_list(F.struct("cid", "grp", F.coalesce("floor", F.lit(-2.0)).alias("floor"), "vec")).alias("m"))

    def meet(batches):
        for b in batches:
            parts = []
            for row in b.column("m"):
                m = row.values
                ids, low = np.asarray(m.field("cid")), np.asarray(m.field("floor"))
                x = unit(m.field("vec").to_pylist())
                parts.append(_best(ids, np.asarray(m.field("grp")), x @ x.T, NEIGHBOURS // 2, threshold, low))
            if parts:
                yield _edges(*map(np.concatenate, zip(*parts)))

    return meetings.select("m").mapInArrow(meet, EDGES)


def neighbour_graph(classes: DataFrame, n: int, seed: int = 0, trees: int = TREES, threshold: float = THRESHOLD,
                    known: DataFrame | None = None) -> DataFrame:
    """(a, near) after NN-descent over written classes (cid, vec). With a column
    ``grp`` neighbours are of other groups only; they meet by ``known`` edges too."""
    if "grp" not in classes.columns:
        classes = classes.withColumn("grp", F.col("cid"))
    lists = saved(_lists(_leaf_edges(classes, n, seed, trees, threshold), threshold), "embed-lists")
    for _ in range(MAX_STEPS):
        offers = saved(_offers(lists, classes, threshold, known), "embed-offers")
        own = lists.select("a", F.inline("near")).select("a", "b", "cos")
        after = saved(_lists(own.unionByName(offers), threshold), "embed-lists")
        changed = _nearest(after).join(_nearest(lists), ["a", "b"], "left_anti").count()
        lists = after
        if changed <= SETTLED * NEIGHBOURS * max(1, n):
            break
    return lists


def _links(lists: DataFrame, threshold: float) -> DataFrame:
    return lists.select("a", F.inline("near")).where(F.col("cos") >= threshold).select("a", "b")


def outside_links(classes: DataFrame, lists: DataFrame, links: DataFrame, seed: int, threshold: float) -> DataFrame:
    """``links`` and those that saturated vertices have outside their components.
    The search ends when it finds none, so each round has fewer components."""
    full = lists.where(F.get("near", F.lit(NEIGHBOURS - 1))["cos"] >= threshold)
    known = _nearest(full)
    while True:
        groups = components(links).select(F.col("id").alias("cid"), F.col("component").alias("grp"))
        some = saved(classes.select("cid", "vec").join(full.select(F.col("a").alias("cid")), "cid").join(groups, "cid"), "embed-full")
        n, parts = some.agg(F.count("*"), F.count_distinct("grp")).first()
        if parts < 2:
            return links
        found = saved(_links(neighbour_graph(some, n, seed, trees_for(n), threshold, known), threshold), "embed-outside")
        if found.isEmpty():
            return links
        links = links.unionByName(found)


def audit(classes: DataFrame, threshold: float = THRESHOLD, most: int = AUDIT) -> DataFrame:
    """(a, b): all pairs at the threshold of at most ``most`` sampled classes
    with all others, by brute force. The sample is bounded, so the tasks get it
    whole and each compares its block of vectors."""
    picked = classes.select("cid", "vec").orderBy(F.xxhash64("cid"), "cid").limit(most).collect()
    by_size: dict[int, list] = {}
    for r in picked:
        by_size.setdefault(len(r["vec"]), []).append((r["cid"], bytes(r["vec"])))

    def run(batches):
        for b in batches:
            vecs, ids = b.column("vec").to_pylist(), np.asarray(b.column("cid"))
            size = np.array([len(v) for v in vecs])
            for s, queries in by_size.items():
                own = np.nonzero(size == s)[0]
                if not len(own):
                    continue
                q = np.array([c for c, _ in queries], np.int64)
                i, j = np.nonzero(unit([v for _, v in queries]) @ unit([vecs[k] for k in own]).T >= threshold)
                other = q[i] != ids[own][j]
                yield pa.RecordBatch.from_arrays([pa.array(q[i][other]), pa.array(ids[own][j][other])], ["a", "b"])

    return classes.select("cid", "vec").mapInArrow(run, "a bigint, b bigint")


def audited(truth: DataFrame, groups: DataFrame, whole: DataFrame) -> float | None:
    """Recall of ``groups`` (id, component) on the pairs of ``truth``; None without
    a pair. ``whole`` are the components once the pairs of ``truth`` are linked."""
    ends = [groups.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")) for c in "ab"]
    per_class = truth.join(ends[0], "a", "left").join(ends[1], "b", "left").groupBy("a").agg(
        (F.count_if(F.col("ca") == F.col("cb")) / F.count("*")).alias("found"))
    per_component = per_class.join(whole.withColumnRenamed("id", "a"), "a").groupBy("component").agg(F.avg("found").alias("found"))
    return per_component.agg(F.avg("found")).first()[0]


def _component_links(classes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(cid, links): rows linked with each class inside its component, from
    tiles compared with each other."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).alias("parts"))
    tiles = (members.join(sizes, "component").withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("parts")))
             .join(classes.select("cid", "vec", "n"), "cid"))
    packed = saved(tiles.groupBy("component", "tile").agg(
        F.collect_list(F.struct("cid", "n", "vec")).alias("t")), "embed-tiles")
    right = packed.select("component", F.col("tile").alias("r_tile"), F.col("t").alias("r"))
    pairs = packed.join(right, "component").where("tile <= r_tile").select("t", "r", (F.col("tile") == F.col("r_tile")).alias("same"))

    def run(batches):
        for b in batches:
            for t, r, same in zip(b.column("t"), b.column("r"), b.column("same").to_pylist()):
                (i, n, x), (j, m, y) = ((np.asarray(v.values.field("cid")), np.asarray(v.values.field("n")),
                                         unit(v.values.field("vec").to_pylist())) for v in (t, r))
                near = x @ y.T >= threshold
                if same:
                    np.fill_diagonal(near, False)
                    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(near @ m)], ["cid", "links"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(np.r_[i, j]), pa.array(np.r_[near @ m, n @ near])], ["cid", "links"])

    return pairs.mapInArrow(run, "cid bigint, links bigint").groupBy("cid").agg(F.sum("links").alias("links"))


def embedding_groups(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, rounds: int = 3) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links,
    component_id and kept."""
    rows = saved(vectors.select("vec_id", "embedding").mapInArrow(_clean, "vec_id bigint, vec binary"), "embed-rows")
    classes = saved(rows.where("vec is not null").groupBy("vec").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("n")).withColumn("cid", F.monotonically_increasing_id()),
        "embed-classes")
    n = classes.count()
    truth = saved(audit(classes, threshold, AUDIT), "embed-audit")
    links, got = truth.limit(0), None
    for k in range(rounds):
        lists = neighbour_graph(classes, n, k, trees_for(n) * (k + 1), **({} if threshold == THRESHOLD else {"threshold": threshold}))
        links = outside_links(classes, lists, links.unionByName(_links(lists, threshold)), k, threshold)
        groups = components(links.unionByName(truth))
        got = audited(truth, components(links), groups)
        _LOG.info("embedding links audited: recall %s", got)
        if got is not None and got >= recall or n <= AUDIT:  # a whole sample has found all there is
            break
    else:
        if got is not None:
            raise RuntimeError(f"embedding near-dedup: recall {got:.4f} in the audit is below {recall} after {rounds} rounds")
        _LOG.warning("embedding near-dedup: no pair among %s sampled classes, recall is not known", AUDIT)
    members = saved(groups.select(F.col("id").alias("cid"), "component"), "embed-members")
    counted = _component_links(classes, members, threshold)
    named = classes.join(members, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    per_class = saved(named.join(smallest, "component").join(counted, "cid", "left").select(
        "vec", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "embed-result")
    return rows.join(per_class, "vec", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
