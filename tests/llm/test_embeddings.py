"""Embedding near-dedup against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.llm import embedding_dedup, queries
from goldleaf.llm.components import components

from ..conftest import SF_MID, SF_SMALL
from .test_dedup import roots


def brute(rows):
    ok = [k for k, (_, v) in enumerate(rows) if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    pairs, links = [], [0] * len(rows)
    for size in {len(rows[k][1]) for k in ok}:
        own = [k for k in ok if len(rows[k][1]) == size]
        x = np.array([rows[k][1] for k in own], np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, j in zip(*np.nonzero(x @ x.T >= 0.95)):
            if i != j:
                links[own[i]] += 1
                pairs.append((own[i], own[j]))
    r, low = roots(len(rows), pairs), {}
    for k, (d, _) in zip(r, rows):
        if d is not None:
            low[k] = min(d, low.get(k, d))
    return sorted((str(d), n, str(low.get(k)), d is not None and low.get(k) == d) for (d, _), n, k in zip(rows, links, r))


def got(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def test_cases(spark):
    rng = np.random.default_rng(4)
    rows = [(1, None), (2, [0.0] * 8), (3, [1.0, None] + [0.0] * 6), (4, [float("nan")] * 8), (5, [float("inf")] + [1.0] * 7),
            (6, [1.0, 2.0]), (7, [2.0, 4.0]), (None, [1.0, 2.0]), (8, []), (6, [-1.0, 5.0])]
    for k in range(40):
        base = rng.normal(size=8)
        rows += [(100 + 3 * k, base.tolist()), (101 + 3 * k, (base * 3).tolist()), (102 + 3 * k, (base + rng.normal(size=8) * 0.1).tolist())]
    rows += [(500 + k, [1.0] * 8) for k in range(50)]
    rows = [(d, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for d, v in rows]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, n int")
    assert got(embedding_dedup.embedding_groups(df)) == brute(rows)
    assert embedding_dedup.embedding_groups(df.limit(0)).count() == 0


def test_dense_group_larger_than_lists_and_leaves(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 32)
    monkeypatch.setattr(embedding_dedup, "MAX_LEAF", 40)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    x = np.concatenate([centre + rng.normal(size=(150, 16)) * 0.08, rng.normal(size=(200, 16))]).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert got(embedding_dedup.embedding_groups(df)) == brute(rows)


def test_dense_group_does_not_hide_missed_small_groups(spark, monkeypatch):
    def dense_only(classes, n, seed=0, trees=0):
        group = classes.where("first < 100")
        star = group.crossJoin(group.select(F.min("cid").alias("b"))).where("cid != b")
        return star.select(F.col("cid").alias("a"), F.array(F.struct(F.lit(1.0).alias("cos"), "b")).alias("near"))

    monkeypatch.setattr(embedding_dedup, "AUDIT", 100)
    monkeypatch.setattr(embedding_dedup, "neighbour_graph", dense_only)
    rng = np.random.default_rng(6)
    centre, small = rng.normal(size=16), np.repeat(rng.normal(size=(20, 16)), 2, axis=0)
    x = np.concatenate([centre + rng.normal(size=(100, 16)) * 0.02, small + rng.normal(size=(40, 16)) * 0.02])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    with pytest.raises(RuntimeError, match="recall"):
        embedding_dedup.embedding_groups(df, rounds=1)


def test_trees_grow_with_the_classes():
    assert embedding_dedup.trees_for(0) == embedding_dedup.trees_for(10**4) == embedding_dedup.TREES
    assert embedding_dedup.trees_for(10**8) >= 2 * embedding_dedup.TREES


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_recall(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, have = brute(rows), got(queries.op6_embedding_near_dedup(spark, sf))
    assert len(want) == len(have)
    links = sum(w[1] for w in want)
    assert sum(h[1] for h in have) >= 0.98 * links
    assert all(h[1] <= w[1] for h, w in zip(have, want))


def test_full_lists_lose_no_link_between_dense_groups(spark, monkeypatch):
    """Two dense groups that one pair of vectors links: the lists of both ends are
    full of nearer ones of their own group."""
    monkeypatch.setattr(embedding_dedup, "AUDIT", 20)
    rng, x = np.random.default_rng(7), []
    for _ in range(2):
        q = np.linalg.qr(rng.normal(size=(32, 2)))[0]
        turn = np.arccos(0.92)
        at = [np.cos(t) * q[:, 0] + np.sin(t) * q[:, 1] for t in (0, 0.13 * turn, 0.87 * turn, turn)]
        x += [at[1], at[2], *(at[0] + rng.normal(size=(40, 32)) * 0.004), *(at[3] + rng.normal(size=(40, 32)) * 0.004)]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    have = got(embedding_dedup.embedding_groups(df))
    assert have == brute(rows) and len({r[2] for r in have}) == 2


def test_outside_links_of_saturated_vertices(spark, monkeypatch):
    """Lists as full as the descent leaves them, without the pair between the groups."""
    monkeypatch.setattr(embedding_dedup, "NEIGHBOURS", 4)
    rng, turn = np.random.default_rng(8), np.arccos(0.96)
    q = np.linalg.qr(rng.normal(size=(16, 2)))[0]
    ends = [q[:, 0], np.cos(turn) * q[:, 0] + np.sin(turn) * q[:, 1]]
    x = np.concatenate([e + rng.normal(size=(20, 16)) * 0.001 for e in ends])
    classes = spark.createDataFrame([(k, v.tobytes()) for k, v in enumerate(x)], "cid bigint, vec binary")
    near = [(k, [(1.0, 20 * (k // 20) + (k + d) % 20) for d in range(1, 5)]) for k in range(40)]
    lists = spark.createDataFrame(near, "a bigint, near array<struct<cos: double, b: bigint>>")
    links = embedding_dedup._links(lists, 0.95)
    assert components(links).select("component").distinct().count() == 2
    assert components(embedding_dedup.outside_links(classes, lists, links, 0, 0.95)).select("component").distinct().count() == 1


def test_forest_spans_what_is_linked():
    rng = np.random.default_rng(9)
    for share in (0, 0.01, 0.05, 0.6):
        near = np.triu(rng.random((60, 60)) < share, 1)
        near = near | near.T
        i, j = embedding_dedup._forest(near)
        assert near[i, j].all() and len(i) < 60
        assert roots(60, list(zip(i, j))) == roots(60, list(zip(*np.nonzero(near))))
