"""Collision-counting search against brute force."""

import math

import numpy as np
import pytest

from goldleaf.llm import collision_search, queries

from ..conftest import SF_MID, SF_SMALL

VECTORS = "vec_id bigint, embedding array<{}>, key int, ids string, shard int, score double"
EVERY_20TH = lambda i: i % 20 == 0


def brute(rows, places=20):
    """Each query's neighbours (score, id), nearest first."""
    ok = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)})
    out = {}
    for i, v in ok:
        if i % 20 == 0:
            near = [(-float(np.dot(np.array(v), np.array(u))), j) for j, u in ok if j != i and len(u) == len(v)]
            out.setdefault(i, []).append([(j, -s) for s, j in sorted(near)[:places]])
    return out


def check(got, want, least):
    rows = {}
    for r in got:
        rows.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(rows) == {q for q, lists in want.items() if lists[0]}
    shares = []
    for q, have in rows.items():
        have.sort()
        true = want[q][0]
        assert [k for k, *_ in have] == list(range(1, len(true) + 1))
        assert q not in {i for _, i, _ in have} and len({i for _, i, _ in have}) == len(have)
        assert have == sorted(have, key=lambda h: (-h[2], h[1]))
        shares.append(len({i for _, i, _ in have} & {i for i, _ in true}) / len(true))
    assert np.mean(shares) >= least, np.mean(shares)
    return np.mean(shares)


def search(spark, rows, kind="float"):
    df = spark.createDataFrame([(*r, 1, "x", 2, 0.5) for r in rows], VECTORS.format(kind))
    return collision_search.nearest(df, EVERY_20TH)


def test_cases(spark):
    rng = np.random.default_rng(2)
    rows = [(20, None), (40, []), (60, [0.0] * 8), (80, [1.0, None] * 4), (100, [math.nan] * 8), (120, [math.inf] * 8), (None, [1.0] * 8),
            (140, [1.0, 2.0]), (160, [3.0, 0.0]), (161, [-1.0, 1.0]), (180, [5.0]), (200, [1.0] * 8), (200, [1.0] * 8)]
    rows += [(k, [1.0] * 8) for k in range(1000, 1100)]
    rows += [(k, rng.normal(size=8).astype(np.float32).tolist()) for k in range(2000, 2300)]
    got = search(spark, rows).collect()
    want = brute(rows)
    check(got, want, 0.97)
    scores = {(r.query_id, r.vec_id): r.score for r in got}
    vec = {i: np.array(v, np.float64) for i, v in rows if v and i not in (None, 80)}
    assert all(s == pytest.approx(float(vec[q] @ vec[i]), rel=1e-12) for (q, i), s in scores.items())
    assert [(r.vec_id, r.score) for r in got if r.query_id == 140] == [(160, 3.0), (161, 1.0)]
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 200 and r.score == 8.0][:3] == [1000, 1001, 1002]
    assert search(spark, []).count() == 0
    assert search(spark, [(20, [1.0, 2.0])]).count() == 0


def test_vectors_of_all_lengths_and_a_giant(spark, monkeypatch):
    monkeypatch.setattr(collision_search, "SHARD", 100)
    monkeypatch.setattr(collision_search, "BLOCK", 8)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 24)) * rng.lognormal(0, 1, size=(900, 1))
    x[7] *= 1000
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    check(search(spark, rows, "double").collect(), brute(rows), 0.97)


def test_windows_grow_and_few_vectors_are_verified():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    x = np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 32)) * 0.05
    norms = collision_search._norms(x)
    unit = np.column_stack([x / norms.max(), np.sqrt(np.maximum(0, 1 - (norms / norms.max()) ** 2))])
    values = (collision_search._directions(32) @ unit.T).astype(np.float32)
    order = np.argsort(values, axis=1).astype(np.int32)
    best = np.full((40, 21), -np.inf)
    found = collision_search.search_shard(x[::50], x, norms.max(), np.take_along_axis(values, order, 1), order, best)
    verified = np.mean([len(rows) for rows, _ in found])
    truth = -np.sort(-(x[::50] @ x.T), axis=1)[:, :21]
    assert verified < 0.35 * len(x)
    assert np.mean(best >= truth - 1e-9) >= 0.97
    # a shard that can't better the answers is left unread
    high = np.full((40, 21), 1e9)
    assert all(not len(rows) for rows, _ in collision_search.search_shard(x[::50], x, norms.max(), np.sort(values), order, high))


def test_threshold():
    p = math.erf(collision_search.WIDTH / math.sqrt(2))
    rng = np.random.default_rng(5)
    hits = rng.binomial(collision_search.PROJECTIONS, p, size=200_000)
    assert (hits < collision_search.threshold()).mean() <= collision_search.MISS * 1.1


def test_poor_recall_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(collision_search, "search_shard", lambda q, x, *a: [(np.zeros(1, np.int64), x[:1] @ v) for v in q])
    rng = np.random.default_rng(6)
    with pytest.raises(RuntimeError, match="recall"):
        search(spark, [(k, rng.normal(size=8).tolist()) for k in range(200)]).count()


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(queries.op13_nearest_neighbours(spark, sf).collect(), brute(rows), 0.95)
