"""PPM scoring against a direct trie walk and a brute-force baseline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.llm import ppm, queries

from ..conftest import SF_SMALL


def trie(texts):
    counts = defaultdict(Counter)
    for t in texts:
        s = ppm.symbols(ppm.lowered(t)).tolist()
        for i in range(ppm.ORDER, len(s)):
            for k in range(ppm.ORDER + 1):
                counts[tuple(s[i - k:i])][s[i]] += 1
    return counts


def walk(counts, text):
    """log10 probability, escape by escape."""
    s, total = ppm.symbols(ppm.lowered(text)).tolist(), 0.0
    for i in range(ppm.ORDER, len(s)):
        out = set()
        for k in range(ppm.ORDER, -1, -1):
            left = {x: c for x, c in counts.get(tuple(s[i - k:i]), {}).items() if x not in out}
            size = sum(left.values()) + len(left)
            if s[i] in left:
                total += np.log10(left[s[i]] / size)
                break
            if left:
                total += np.log10(len(left) / size)
                out |= left.keys()
        else:
            total -= np.log10(257 - len(out))
    return total


def baseline(train, text):
    split = lambda t: [*ppm.lowered(t).split(), b""]
    c = Counter(w for t in train for w in split(t))
    n, v = c.total(), len(c)
    own = split(text)
    return len(own), sum(c[w] > 0 for w in own), n, sum(np.log10((c[w] + 1) / (n + v + 1)) for w in own)


TEXTS = ["the cat sat on the mat", "The dog SAT on the log\n", None, "", "éa éb éa", "zzz qqq", "cat " * 30000, "\x0bodd space\x1c"]


@pytest.mark.parametrize("head", [0, 3, 1000])
def test_scores_match_a_direct_walk(spark, head):
    rows = [(k, t, k % 3 == 2, "x") for k, t in enumerate(TEXTS + TEXTS[:2])] + [(0, "the cat", False, "x"), (None, "unheard", True, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean, word string")
    train = [r[1] for r in rows if not r[2]]
    counts = trie(train)
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                  for r in ppm.score_texts(df, head=head).collect()))
    want = []
    for d, t, h, _ in rows:
        size, known, n, base = baseline(train, t)
        want.append((str(d), h, size, known, n, base, walk(counts, t)))
    want.sort()
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-5, atol=1e-5)


@pytest.mark.parametrize("most", [0, 25, 60])
def test_scores_do_not_depend_on_what_is_broadcast(spark, most):
    rows = [(k, t, k % 3 == 2) for k, t in enumerate(TEXTS + TEXTS[:2])] + [(90, "the cat in the hat\x00", True)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean")
    counts = trie([r[1] for r in rows if not r[2]])
    got = {r.doc_id: r.score for r in ppm.score_texts(df, max_grams=most).collect()}
    for d, t, _ in rows:
        assert np.isclose(got[d], walk(counts, t), rtol=1e-9, atol=1e-9), (d, t)


def test_no_training_and_empty(spark):
    df = spark.createDataFrame([(1, "ab", True), (2, None, True)], "doc_id bigint, text string, held_out boolean")
    got = {r.doc_id: r for r in ppm.score_texts(df).collect()}
    assert got[1].train_tokens == 0 and got[1].n_known == 0 and got[1].base_score == 0
    assert np.isclose(got[1].score, -3 * np.log10(257), rtol=1e-3)
    assert ppm.score_texts(df.limit(0)).count() == 0


def test_bounded_model_still_sums_to_one(spark):
    codes = np.concatenate([ppm.gram_codes(ppm.symbols(ppm.lowered(t))) for t in TEXTS])
    grams, n = np.unique(codes, return_counts=True)
    counts = spark.createDataFrame([(None, int(g), int(c)) for g, c in zip(grams, n)], "word string, gram bigint, n bigint")
    for most in (10**6, 60, 25):
        levels = ppm.train(counts, most)
        assert max(len(x.pairs) for x in levels) <= most
        for context in [*(grams[::7] // 257), 5, 257**4]:
            p = 10.0 ** ppm.walk(levels, context * 257 + np.arange(257))
            assert np.isclose(p.sum(), 1, atol=1e-9), (most, context, p.sum())


def test_beats_the_word_baseline_on_held_out_texts(spark):
    got = queries.op9_lm_scoring(spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_adaptive_prefers_repeats():
    assert ppm.adaptive_log10("abcabcabcabcabcabc") > ppm.adaptive_log10("qwertyuiopasdfghjk")
    assert np.isclose(ppm.adaptive_log10(None), -np.log10(257))


def test_lm_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op9_lm_scoring(spark, SF_SMALL).collect()}
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    train = [r.text for r in docs if not held(r.doc_id)]
    c = Counter(w for t in train for w in [*ppm.lowered(t).split(), b""])
    counts = trie(train)
    assert len(got) == len(docs)
    for r in docs:
        g, own = got[r.doc_id], [*ppm.lowered(r.text).split(), b""]
        assert (g.held_out, g.n_tokens, g.train_tokens) == (held(r.doc_id), len(own), c.total())
        assert g.n_known == sum(c[w] > 0 for w in own)
        assert np.isclose(g.base_score, sum(np.log10((c[w] + 1) / (c.total() + len(c) + 1)) for w in own))
    for r in docs[:5]:
        assert np.isclose(got[r.doc_id].score, walk(counts, r.text), rtol=1e-4)


def test_slots_find_what_a_sorted_search_finds():
    rng = np.random.default_rng(3)
    # codes that share their slot in the first table, others at random; 0 is a code too
    step = pow(int(ppm._MIXES[0]), -1, 1 << 64)
    same = np.array([k * step % (1 << 64) for k in range(400)], np.uint64).view(np.int64)
    for codes in (np.zeros(0, np.int64), np.zeros(1, np.int64), np.unique(np.concatenate([same, rng.integers(0, ppm.SYMBOLS**6, 5000)]))):
        slots = ppm.Slots.of(codes)
        own = np.concatenate([codes, rng.integers(0, ppm.SYMBOLS**6, 3000), codes[::-1] + 1, np.zeros(2, np.int64)])
        at, found = slots.find(own)
        want_at, want = ppm._find(codes, own)
        assert (found == want).all() and (at[found] == want_at[want]).all()
    assert len(slots.tables) > 1  # the shared slot was left for another table


def test_texts_go_to_the_tasks_in_small_batches_and_the_setting_comes_back(spark, monkeypatch):
    """Batches of 10,000 whole texts took an executor over its memory."""
    name, seen, saved = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, ppm.saved

    def spy(df, table, *rest):
        seen[table] = int(df.sparkSession.conf.get(name))
        return saved(df, table, *rest)

    monkeypatch.setattr(ppm, "saved", spy)
    before = spark.conf.get(name)
    docs = spark.range(0, 1300, 1, 1).selectExpr("id AS doc_id", "concat('word ', id) AS text", "id % 7 = 2 AS held_out")
    got = ppm.score_texts(docs)
    assert spark.conf.get(name) == before
    assert seen["ppm-counts"] <= 512 and seen["ppm-scored"] <= 512
    assert got.count() == 1300 and got.first()["train_tokens"] == 3 * 1300 - 3 * 186
