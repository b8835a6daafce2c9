"""Hierarchical language identification: a linear classifier picks the
language family, then one-versus-one linear support vector machines vote
between the languages of that family.

Features are square roots of hashed byte 1- to 3-gram shares over the letters
of the whole text. The machines are fitted on at most ``sample_rows`` labelled
texts, the same number for each language, those with the smallest text hash;
their feature rows (bounded by that parameter) are all the driver ever holds.

Cases: a null text, or one without letters, is ``und`` with score 0; without any
labelled text everything is ``und``; a null label teaches nothing; one known
language is always predicted with score 1; a null doc_id counts as not held
out; rows that repeat a doc_id are rows of their own; an empty table gives no
rows; other columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from goldleaf.llm.common import widened

DIMS = 4096
SAMPLE_ROWS = 2000
UNKNOWN = "und"
# Families of closely related languages. A language that is not
# listed is a family of its own.
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
}
_FAMILY = {lang: name for name, langs in FAMILIES.items() for lang in langs}
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_CHUNK = 1 << 20


def letters_only(text: str | None) -> str:
    """Lower-cased letters, other runs as one space; empty without letters."""
    out = _NOT_LETTERS.sub(" ", text or "").strip().lower()
    return out if any(map(str.isalpha, out)) else ""  # numerals like "²" count as word characters


def features(letters: str) -> np.ndarray:
    """Unit vector of square-rooted hashed byte n-gram shares."""
    raw = np.frombuffer(f" {letters} ".encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(DIMS, np.int64)
    for k in range(0, len(raw), _CHUNK):
        b = raw[k:k + _CHUNK + 2].astype(np.uint32)
        own = min(_CHUNK, len(raw) - k)
        for order, code in enumerate((b, b[:-1] << 8 | b[1:], b[:-2] << 16 | b[1:-1] << 8 | b[2:])):
            spread = (code[:own] + np.uint32(order << 24)) * np.uint32(2654435761)
            counts += np.bincount(spread >> np.uint32(20), minlength=DIMS)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 120) -> np.ndarray:
    """Linear support vector machine (squared hinge, classes weighted evenly,
    accelerated gradient steps). Last two entries: offset and the scale that
    turns a margin into log odds."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    look, t, rate = w, 1.0, 1 / (4 + penalty)
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ look))
        step = look - rate * (penalty * look - x.T @ (2 * weight * slack * y))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look, w = step + (before - 1) / t * (step - w), step
    margin, scale = y * (x @ w), 1.0
    for _ in range(25):  # one-parameter logistic fit, softened so that it stays finite
        p = 1 / (1 + np.exp(-scale * margin))
        slope = (weight * (1 - p) * margin).sum() - 0.01 * scale
        scale += slope / ((weight * p * (1 - p) * margin**2).sum() + 0.01)
    return np.append(w, max(scale, 0.1)).astype(np.float32)


def _odds(x: np.ndarray, machine: np.ndarray) -> np.ndarray:
    """Probability of the positive class."""
    return 1 / (1 + np.exp(-machine[-1] * (x @ machine[:-2] + machine[-2])))


@dataclass
class LanguageModel:
    families: list[tuple[str, list[str]]]
    of_family: list[np.ndarray]
    of_pair: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        if not self.families:
            return [UNKNOWN] * n, np.zeros(n)
        if len(self.families) == 1:
            chosen, sure = np.zeros(n, int), np.ones(n)
        else:
            p = np.stack([_odds(x, m) for m in self.of_family], 1)
            p = p / np.maximum(p.sum(1, keepdims=True), 1e-12)
            chosen, sure = p.argmax(1), p.max(1)
        out, score = np.empty(n, object), sure.astype(float)
        for f, (_, langs) in enumerate(self.families):
            rows = np.nonzero(chosen == f)[0]
            if not len(rows):
                continue
            votes, sums = np.zeros((2, len(rows), len(langs)))
            for (i, a), (j, b) in combinations(enumerate(langs), 2):
                p = _odds(x[rows], self.of_pair[a, b])
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
                sums[:, i] += p
                sums[:, j] += 1 - p
            best = (votes + sums / (len(langs) + 1)).argmax(1)
            out[rows] = np.array(langs, object)[best]
            if len(langs) > 1:
                score[rows] *= sums[np.arange(len(rows)), best] / (len(langs) - 1)
        return out.tolist(), np.clip(score, 0, 1)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from the rows of ``docs`` that have a lang."""
    labelled = docs.select("lang", "text").where("lang is not null and text is not null")
    n_langs = labelled.select("lang").distinct().count()
    if not n_langs:
        return LanguageModel([], [], {})
    order = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    sample = (labelled.withColumn("_n", F.row_number().over(order))
              .where(F.col("_n") <= max(2, sample_rows // n_langs)).select("lang", "text"))

    def run(batches):
        for b in batches:
            rows = [(lang, features(t).tobytes()) for lang, t in zip(b.column("lang").to_pylist(),
                    map(letters_only, b.column("text").to_pylist())) if t]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary())], ["lang", "x"])

    rows = sorted((r["lang"], bytes(r["x"])) for r in sample.mapInArrow(run, "lang string, x binary").collect())
    if not rows:
        return LanguageModel([], [], {})
    langs = np.array([r[0] for r in rows])
    x = np.stack([np.frombuffer(r[1], np.float32) for r in rows])
    family = np.array([_FAMILY.get(lang, f"only {lang}") for lang in langs])
    families = [(f, sorted(set(langs[family == f]))) for f in sorted(set(family))]
    signs = lambda mask: np.where(mask, 1, -1).astype(np.float32)
    pairs = {(a, b): fit_svm(x[both], signs(langs[both] == a)) for _, ls in families for a, b in combinations(ls, 2)
             if (both := (langs == a) | (langs == b)).any()}
    return LanguageModel(families, [fit_svm(x, signs(family == f)) for f, _ in families] if len(families) > 1 else [], pairs)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (columns of these names are
    replaced). Only the text is looked at."""
    docs = docs.drop("lang_pred", "score")

    def run(batches):
        for b in batches:
            names, scores = [], []
            texts = b.column("text")
            for k in range(0, len(texts), 256):
                part = [letters_only(t) for t in texts.slice(k, 256).to_pylist()]
                known = [i for i, t in enumerate(part) if t]
                lang, score = [UNKNOWN] * len(part), np.zeros(len(part))
                if known:
                    got, score[known] = model.predict(np.stack([features(part[i]) for i in known]))
                    for i, g in zip(known, got):
                        lang[i] = g
                names += lang
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))],
                [*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, widened(docs, lang_pred=StringType(), score=DoubleType()))


def held_out(folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of doc_id as text leaves ``fold``."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    return predict(docs.withColumn("held_out", held_out()), fit(docs.where(~held_out()), sample_rows))
