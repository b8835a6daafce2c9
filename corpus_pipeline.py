"""A corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept and returns a DataFrame, which is written and read again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.common import read_table, saved
from goldleaf.llm.decontaminate import drop_contaminated
from goldleaf.llm.language_id import UNKNOWN, identify
from goldleaf.llm.line_dedup import dedup_lines
from goldleaf.llm.mixing import mix
from goldleaf.llm.simhash_tiles import keep_one


def _with_own_columns(docs: DataFrame, stage, names: list[str]) -> DataFrame:
    """``stage(docs)`` where columns of ``docs`` that are called like the
    stage's results stand aside meanwhile."""
    aside = {c: f"_own_{c}" for c in docs.columns if c in names}
    out = stage(docs.withColumnsRenamed(aside))
    return out.drop(*aside).withColumnsRenamed({v: k for k, v in aside.items()}).select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text or no letters) go; a missing
    lang is filled in with the prediction."""
    def told(own: DataFrame) -> DataFrame:
        known = identify(own).where(F.col("lang_pred") != UNKNOWN)
        return known.withColumn("lang", F.coalesce("lang", "lang_pred"))

    return _with_own_columns(docs, told, ["held_out", "lang_pred", "score"])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from all but their first document; n_chars follows. A
    document that loses every line stays, empty."""
    def rewritten(own: DataFrame) -> DataFrame:
        out = dedup_lines(own).withColumn("text", F.col("kept"))
        if "n_chars" in own.columns:
            out = out.withColumn("n_chars", F.char_length("text").cast(own.schema["n_chars"].dataType))
        return out

    return _with_own_columns(docs, rewritten, ["kept", "n_lines", "n_dropped"])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their domain, sampling rate and copies; rate 0 goes. Columns
    of the table that are called like these three give way to them; its own
    ``n_tokens`` and ``posterior`` stay as they are."""
    results = ["domain", "rate", "copies"]
    aside = {c: f"_own_{c}" for c in docs.columns if c in ("n_tokens", "posterior")}
    mixed = mix(docs.withColumnsRenamed(aside), read_table(spark, sf_dir, "labels")).where("rate > 0")
    kept = mixed.drop(*aside).withColumnsRenamed({v: k for k, v in aside.items()})
    return kept.select(*[c for c in docs.columns if c not in results], *results)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
]

# Trained classifiers and XXH64 are not SQL: tests/llm/test_pipeline.py holds
# the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}", "zstd")
    return docs
