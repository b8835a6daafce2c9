"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from goldleaf.llm import periodic_runs, queries

from ..conftest import SF_SMALL

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """All maximal stretches by period, smallest periods first."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(6, 4 * q) and not any(x <= s and i + q <= x + m for x, m, _ in out):
                out.append((s, i + q - s, q))
            i += 1
    return sorted(out)


def numbered(w):
    known = {}
    return [known.setdefault(x, len(known)) for x in w]


def runs(w):
    return periodic_runs.runs_of([numbered(w)])[0]


def brute_rows(docs):
    out = {}
    for d, text in docs:
        w = WORDS.findall(text or "")
        n = len(w)
        h = zlib.crc32(str(d).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute(w)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        text = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                  hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=70))
def test_two_words(w):
    assert runs(w) == brute(w)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), st.integers(1, 9)), max_size=8))
def test_nested_repeats(parts):
    w = [x for p, k in parts for x in p * k]
    assert runs(w * 2) == brute(w * 2)


def test_known_sequences():
    assert runs([]) == [] and runs("aaaaa") == [] and runs("aaaaaa") == [(0, 6, 1)]
    assert runs("xabababab") == [(1, 8, 2)]
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    thue = "a"
    while len(thue) < 512:
        thue += thue.translate({97: 98, 98: 97})
    for w in (fibonacci[-1], thue, "aaaaaab" * 4, ("a" * 7 + "b") * 9 + "c" + "ab" * 30):
        assert runs(w) == brute(w)


def test_grammar_is_exact_and_small():
    rng = random.Random(3)
    w = [rng.randrange(40) for _ in range(2000)] * 2
    g = periodic_runs.Grammar(w, 40)

    def spell(s):
        return [s] if s < 40 else spell(g.left[s - 40]) + spell(g.right[s - 40])

    assert [x for s, _ in g.top for x in spell(s)] == w
    assert all(w[p:p + g.size[40 + k]] == spell(40 + k) for k, p in enumerate(g.place))
    pairs = [(a, b) for (a, _), (b, _) in zip(g.top, g.top[1:])]
    assert len(set(pairs)) == len(pairs)  # no pair is left twice
    assert sum(g.size[40:]) < 40 * len(w)  # derivations stay shallow


@pytest.mark.parametrize("w", [["a"] * 200_000, ["a", "b", "c"] * 70_000, [str(k) for k in range(100_000)] * 2])
def test_long_texts(w):
    t0 = time.time()
    period = len(set(w))
    assert runs(w) == ([(0, len(w), period)] if len(w) >= 4 * period else [])
    assert time.time() - t0 < 60


def test_small_steps(monkeypatch):
    monkeypatch.setattr(periodic_runs, "MOST_CHECKS", 7)
    for w in ("ab" * 40 + "c" * 30, "abc" * 9 + "aab" * 8):
        assert runs(w) == brute(w)


def test_cases(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "GROUP_WORDS", 50)
    docs = [(1, None), (2, ""), (3, "a " * 9), (3, "a " * 9), (None, "x y\x0bx\ty x y x y"), (4, "\n"), (5, "é é é é é é \x85 ok"), (6, "b " * 3000)]
    df = spark.createDataFrame([(*r, [1], 2, "x") for r in docs], "doc_id bigint, text string, runs array<int>, n_words int, collapsed string")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(df).collect()), key=str)
    assert got == sorted([(1, 0, [], ""), (2, 0, [], ""), (3, 9, [(0, 9, 1)], "a"), (3, 9, [(0, 9, 1)], "a"), (None, 8, [(0, 8, 2)], "x y"),
                          (4, 0, [], ""), (5, 8, [(0, 6, 1)], "é \x85 ok"), (6, 3000, [(0, 3000, 1)], "b")], key=str)
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op12_periodic_runs(spark, SF_SMALL).collect()
    want = brute_rows(docs)
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(docs)
    assert sum(v[0] > 0 for v in want.values()) > len(docs) / 20
