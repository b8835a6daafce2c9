"""Line dedup, SimHash near-dedup and components against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from goldleaf.llm import components, line_dedup, queries, simhash_tiles

from ..conftest import SF_SMALL

DOCS = "doc_id bigint, text string, lang string, kept string, h1 int"
SPACE = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def dedup_brute(rows):
    holders = defaultdict(set)
    key = lambda line: lower(line.strip(SPACE))
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= 10:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if d is None or len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == d]
        out.append((str(d), len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def dedup_rows(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in df.collect())


LINES = ["The same long line here", " THE SAME long line HERE\r", "short", "ünïcödé lï", "ÜNÏcödé lï", "", "exactly 10", "nine char",
         "\x0bexactly 10\x0c", "x" * 50000, " nbsp is kept ", "nbsp is kept"]


def line_docs(n, seed):
    rng = random.Random(seed)
    rows = [(k, "\n".join(rng.choices(LINES + [f"own line number {rng.randrange(40)}"], k=rng.randrange(6)))) for k in range(n)]
    return rows + [(n, None), (n + 1, ""), (None, "The same long line here"), (3, "The same long line here\nexactly 10")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", "k", 1) for r in rows], DOCS)


def test_line_dedup_cases(spark):
    rows = line_docs(30, 1)
    out = line_dedup.dedup_lines(frame(spark, rows))
    assert dedup_rows(out) == dedup_brute(rows)
    assert {"lang", "h1", "text"} <= set(out.columns)
    assert line_dedup.dedup_lines(frame(spark, rows).limit(0)).count() == 0


def test_line_index_is_reversible(spark):
    rows = [r for r in line_docs(30, 2) if r[0] is not None]
    parts = [[r for r in rows if r[0] % 3 == k] for k in range(3)]
    index = line_dedup.LineIndex.empty(spark, 100)
    state = lambda i: (sorted(tuple(r) for r in i.refs.select("h1", "h2", "n", "owner").collect()),
                       sorted(tuple(r) for r in i.postings.collect()))
    states = []
    for p in parts:
        index = index.insert(frame(spark, p))
        states.append(state(index))
    assert dedup_rows(line_dedup.drop_lines(frame(spark, rows), index)) == dedup_brute(rows)
    back = index.delete(frame(spark, parts[2]))
    assert state(back) == states[1]
    # nothing is in the filters that the exact table doesn't hold, and nothing is missing
    held = back.refs.select("h1", "h2", "shard").toPandas()
    filters = back.filters.toPandas()
    seen = np.zeros(len(held), bool)
    for f in filters.itertuples():
        seen |= line_dedup.probe(f.buckets, f.marks, held.h1.to_numpy(), held.h2.to_numpy()) & (held.shard == f.shard).to_numpy()
    assert seen.all()
    assert sum(int((np.frombuffer(f.marks, np.uint16) > 0).sum()) for f in filters.itertuples()) == len(held)
    assert state(back.insert(frame(spark, parts[2]))) == states[2]


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    h1, h2 = rng.integers(-2**63, 2**63 - 1, (2, 20000))
    buckets, marks = line_dedup.build_filter(h1, h2)
    assert line_dedup.probe(buckets, marks, h1, h2).all()
    assert line_dedup.probe(buckets, marks, *rng.integers(-2**63, 2**63 - 1, (2, 20000))).mean() < 0.01
    less = line_dedup.take_out(buckets, marks, h1[:5000], h2[:5000])
    assert line_dedup.probe(buckets, less, h1[5000:], h2[5000:]).all()
    assert line_dedup.probe(buckets, less, h1[:5000], h2[:5000]).mean() < 0.01


def test_line_dedup_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op1_line_dedup(spark, SF_SMALL).collect())
    assert got == [(a, b, c, hashlib.sha256(t.encode()).hexdigest()) for a, b, c, t in dedup_brute(rows)]


# ---- SimHash -------------------------------------------------------------

def print_brute(text):
    w = [x for x in lower(text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ")
         .replace("\r", " ").split(" ") if x]
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def simhash_brute(rows):
    fps = [print_brute(t) for _, t in rows]
    r = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    low = {}
    for k, (d, _) in zip(r, rows):
        if d is not None:
            low[k] = min(d, low.get(k, d))
    return sorted((str(d), f"{f:016x}", low.get(k)) for (d, _), f, k in zip(rows, fps, r))


def simhash_rows(df):
    return sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in df.select(
        "doc_id", simhash_tiles.hex_fingerprint("fp").alias("fingerprint"), "component_id").collect())


def near_docs():
    rng = random.Random(5)
    words = [f"wörd{k}" for k in range(300)]
    rows = [(9, None), (4, ""), (5, " \t\n"), (None, "lonely row without an id at all"), (11, "One two"), (12, "one\ttwo"), (13, "é É")]
    for k in range(25):
        base = rng.choices(words, k=300)
        for j in range(4):
            mine = list(base)
            for _ in range(j):
                mine[rng.randrange(300)] = rng.choice(words)
            rows.append((100 + 10 * k + j, " ".join(mine)))
    return rows + rows[-1:] + [(1, rows[-1][1]), (None, rows[-1][1])]


def test_simhash_cases(spark):
    rows = near_docs()
    df = frame(spark, rows)
    assert simhash_rows(simhash_tiles.simhash_groups(df)) == simhash_brute(rows)
    kept = sorted(str(r.doc_id) for r in simhash_tiles.keep_one(df).collect())
    assert kept == sorted(d for d, _, c in simhash_brute(rows) if d in ("None", str(c)))
    assert simhash_tiles.simhash_groups(df.limit(0)).count() == 0


def test_tiles_lose_no_link(spark):
    rng = np.random.default_rng(1)
    fps = rng.integers(-2**63, 2**63 - 1, 60)
    for _ in range(6):
        fps = np.r_[fps, fps ^ (1 << rng.integers(0, 63, len(fps)))]
    fps = np.unique(fps)[:2500]
    df = spark.createDataFrame([(int(f),) for f in fps], "fp bigint")
    got = {r.id: r.component for r in components.components(simhash_tiles.near_links(df, 4, tile=64)).collect()}
    u = fps.view(np.uint64)
    i, j = np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 4)
    want = roots(len(fps), [(a, b) for a, b in zip(i, j) if a < b])
    assert [got.get(int(f), int(f)) for f in fps] == [int(fps[w]) for w in want]


def test_simhash_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in queries.op10_simhash_near_dedup(spark, SF_SMALL).collect())
    assert got == simhash_brute(rows)


# ---- components ----------------------------------------------------------

@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(2)
    pairs = {"chain": [(i, i + 1) for i in range(200)], "star": [(50, i) for i in range(200)],
             "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)], "none": [(3, 3), (None, 1)]}[kind]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    pairs = [p for p in pairs if None not in p]
    want = roots(201, pairs)
    assert got == {v: want[v] for p in pairs if p[0] != p[1] for v in p}
