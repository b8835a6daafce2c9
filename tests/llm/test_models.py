"""Language ID and mixing: held-out accuracy, brute force and edge cases."""

import zlib

import numpy as np
import pytest

from goldleaf.llm import language_id, mixing, queries

from ..conftest import SF_MID, SF_SMALL

DOCS = "doc_id bigint, text string, lang string, score string, rate int"


def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    got = queries.op7_language_id(spark, SF_MID).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in truth[r.doc_id].text or ""))
    judged = [r for r in got if r.held_out and r.lang_pred != "und" and truth[r.doc_id].lang]
    right = np.mean([r.lang_pred == truth[r.doc_id].lang for r in judged])
    assert right > 0.95, right


def test_language_cases(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !!", None), (3, "\u00b2 \u2460", None), (4, "x" * 300000, None), (None, "the other man and the house", "en"),
            (5, "der andere Mann und das Haus", "de"), (6, "le chien et la maison", "fr"), (7, "il cane e la casa", "it"),
            (8, "tha", "xx"), (5, "der andere Mann und das Haus", "de"), (9, "the man and the house", None)]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], DOCS)
    got = {r.text: r for r in language_id.identify(df).collect()}
    assert all(got[t].lang_pred == "und" and got[t].score == 0 for t in (None, "", "123 !!", "\u00b2 \u2460"))
    assert got["the man and the house"].lang_pred == "en"
    assert language_id.identify(df.limit(0)).count() == 0
    unlabelled = df.withColumn("lang", df.lang.substr(9, 1).cast("string")).replace("", None, "lang")
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_language_within_families():
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(size=(400, 60))).astype(np.float32)
    x[:, :3] += np.eye(3, dtype=np.float32)[np.arange(400) % 3] * 4
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    w = language_id.fit_svm(x, np.where(np.arange(400) % 3 == 0, 1, -1).astype(np.float32))
    assert ((language_id._odds(x, w) > 0.5) == (np.arange(400) % 3 == 0)).mean() > 0.97


def mixing_frames(spark, n=60):
    words = {"high": "alpha beta gamma", "low": "spam spam spam", "toxic": "nasty words here"}
    names = list(words)
    docs = [(k, " ".join([words[names[k % 3]]] * (1 + k % 5)), "en", "s", 1) for k in range(n)]
    docs += [(n, None, "en", "s", 1), (n + 1, "", "en", "s", 1), (None, "alpha beta", "en", "s", 1), (3, "alpha beta gamma", "en", "s", 1)]
    labels = [(k, 1 if k % 3 == 0 else 0, 1 if k % 3 == 2 else 0, "x") for k in range(0, n, 2)]
    labels += [(None, 1, 0, "x"), (3, None, None, "x"), (0, 1, 0, "y")]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")


def test_mixing_matches_targets(spark):
    docs, labels = mixing_frames(spark)
    targets = {"high": 0.7, "low": 0.3, "toxic": 0.0}
    rows = mixing.mix(docs, labels, targets).collect()
    assert len(rows) == docs.count()
    p, n, r = (np.array([getattr(x, c) for x in rows], float) for c in ("posterior", "n_tokens", "rate"))
    assert (r >= 0).all() and np.allclose(p.sum(1), 1)
    reached = (n * r) @ p / n.sum()
    assert np.allclose(reached, [0.7, 0.3, 0.0], atol=0.01), reached
    assert all(abs(x.copies - x.rate) < 1 for x in rows)
    assert {x.domain for x in rows if x.text and "nasty" in x.text} == {"toxic"}


def test_mixing_against_plain_solver(spark):
    docs, labels = mixing_frames(spark)
    targets, ridge = np.array([0.5, 0.2, 0.3]), 0.05
    rows = mixing.mix(docs, labels, dict(zip(["high", "low", "toxic"], targets)), ridge=ridge).collect()
    p, n = np.array([x.posterior for x in rows]), np.array([x.n_tokens for x in rows], float)
    w, r = n / n.sum(), np.ones(len(rows))
    for _ in range(5000):
        r = np.maximum(0, r - 0.5 * (p @ (p.T @ (w * r) - targets) + ridge * (r - 1)))
    cost = lambda v: 0.5 * ((p.T @ (w * v) - targets) ** 2).sum() + ridge / 2 * (w * (v - 1) ** 2).sum()
    assert cost(np.array([x.rate for x in rows])) < cost(r) + 1e-5


def test_mixing_cases(spark):
    docs, labels = mixing_frames(spark, 6)
    assert mixing.mix(docs.limit(0), labels).count() == 0
    even = mixing.mix(docs, labels.limit(0)).collect()
    assert all(np.allclose(r.posterior, 1 / 3) for r in even)
    got = queries.op2_source_mixing(spark, SF_SMALL)
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    total = got.selectExpr("sum(n_tokens * rate * posterior[0]) / sum(n_tokens) as high").first().high
    assert abs(total - mixing.TARGETS["high"]) < 0.02


def test_mixing_rare_domain_of_target_zero(spark):
    """A domain of one token in a thousand, and of one in ten thousand."""
    for rare in (1e-3, 1e-4):
        rows = [(int(1e6 * 0.6), [1.0, 0.0, 0.0]), (int(1e6 * (0.4 - rare)), [0.0, 1.0, 0.0]), (int(1e6 * rare), [0.0, 0.0, 1.0])]
        scored = spark.createDataFrame(rows, "n_tokens bigint, posterior array<double>")
        for wanted in ([0.9, 0.1, 0.0], [0.5, 0.5 - 5 * rare, 5 * rare]):
            wanted = np.array(wanted)
            m = mixing.fit_rates(scored, wanted)
            n, p = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows])
            rates = mixing._open(p, wanted) * np.maximum(0, 1 - p @ m)
            reached = (n * rates) @ p / n.sum()
            assert np.allclose(reached, wanted, rtol=0.01, atol=1e-12), (reached, wanted)
            assert (rates[2] == 0) == (wanted[2] == 0)


def test_mixing_raises_when_steps_run_out(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200)
    scored = spark.createDataFrame([(10, v.tolist()) for v in p], "n_tokens bigint, posterior array<double>")
    with pytest.raises(RuntimeError, match="mixing"):
        mixing.fit_rates(scored, np.array([0.9, 0.1, 0.0]), steps=1)
    m = mixing.fit_rates(scored, np.array([0.5, 0.3, 0.2]))
    reached = np.maximum(0, 1 - p @ m) @ p / len(p)
    assert np.allclose(reached, [0.5, 0.3, 0.2], rtol=0.01), reached


def test_mixing_takes_very_long_texts(spark):
    docs, labels = mixing_frames(spark)
    long = spark.createDataFrame([(10**6, "spam nasty " * 300000, "en", "s", 1)], docs.schema)
    row = mixing.mix(docs.union(long), labels).where("doc_id = 1000000").first()
    assert row.n_tokens == 600000 and abs(sum(row.posterior) - 1) < 1e-9


def test_mixing_query_shares(spark):
    rows = queries.op2_source_mixing(spark, SF_MID).collect()
    p, n, r = (np.array([getattr(x, c) for x in rows], float) for c in ("posterior", "n_tokens", "rate"))
    reached = (n * r) @ p / n.sum()
    assert np.allclose(reached[:2], [mixing.TARGETS["high"], mixing.TARGETS["low"]], rtol=0.01), reached
    assert reached[2] < 0.6 * (n @ p / n.sum())[2]
    assert all(x.rate == 0 for x in rows if x.posterior[2] > 0.5)
    toxic = {x.doc_id: x.toxic for x in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    lost = {k: np.mean([x.rate == 0 for x in rows if toxic.get(x.doc_id) == k]) for k in (0, 1)}
    assert lost[0] < 0.02 and lost[1] > 0.7, lost
