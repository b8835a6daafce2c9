"""The pipeline: each stage against brute force on what the stage before kept."""

import numpy as np
import pytest

import corpus_pipeline
from goldleaf.llm.common import saved

from ..conftest import SF_SMALL
from .test_dedup import dedup_brute, simhash_brute
from .test_native import decontam_brute


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    junk = spark.createDataFrame([(10**9, None, None, "x", 0), (10**9 + 1, "123 456", None, "x", 7), (10**9 + 2, "", "en", "x", 0)], docs.schema)
    out = [saved(docs.unionByName(junk), "test-docs")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], SF_SMALL), "test-stage"))
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources"]
    assert all(s.dtypes == steps[0].dtypes for s in steps[1:-1])


def test_language_stage(steps):
    want = sorted(d for d, t in pairs(steps[0]) if any(c.isalpha() for c in t or ""))
    assert sorted(d for d, _ in pairs(steps[1])) == want
    assert steps[1].where("lang is null").count() == 0


def test_line_stage(steps):
    want = {d: kept for d, _, _, kept in dedup_brute(pairs(steps[1]))}
    got = {str(r.doc_id): r for r in steps[2].collect()}
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_simhash_stage(steps):
    assert sorted(str(d) for d, _ in pairs(steps[3])) == sorted(d for d, _, c in simhash_brute(pairs(steps[2])) if d == str(c))


def test_decontamination_stage(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = sorted(r[0][1] for r in decontam_brute(pairs(steps[3]), items) if not r[-1])
    assert sorted(d for d, _ in pairs(steps[4])) == want


def test_mixing_stage(steps):
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} <= {d for d, _ in pairs(steps[4])}
    assert all(r.rate > 0 and abs(r.copies - r.rate) < 1 for r in rows)
    assert np.isfinite([r.rate for r in rows]).all()
    assert len(rows) >= 0.75 * steps[4].count()


def test_clashing_columns_keep_their_values(spark):
    rows = [(k, f"The long shared line\nline number {k} of mine", "en", "s", 30, f"mine {k}", k, 0.5) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "kept string, n_lines bigint, score double")
    for stage in (corpus_pipeline.language_id, corpus_pipeline.line_dedup):
        out = stage(spark, docs, SF_SMALL)
        assert out.dtypes == docs.dtypes
        assert sorted((r.doc_id, r.kept, r.n_lines, r.score) for r in out.collect()) == [(r[0], *r[5:]) for r in rows]


def test_run_and_empty(spark, tmp_path):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.count() > 0 and {"rate", "copies", "domain"} <= set(got.columns)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0


def test_mixing_takes_clashing_columns(spark):
    rows = [(k, ("alpha beta gamma delta " * 9) + str(k), 0.5, k, "own", 7, [1.0]) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rate double, copies int, domain string, n_tokens int, posterior array<double>")
    got = corpus_pipeline.mixing(spark, docs, SF_SMALL)
    assert got.columns == ["doc_id", "text", "n_tokens", "posterior", "domain", "rate", "copies"]
    assert {(r.n_tokens, tuple(r.posterior)) for r in got.collect()} <= {(7, (1.0,))}
