"""Mixing sources to target weights with soft domain membership.

A softmax classifier, fitted on at most ``sample_rows`` labelled documents,
gives every document a posterior over domains. With ``w`` the share of all
tokens a document holds and ``p`` its posterior, nonnegative document rates
``r`` minimise

    1/2 sum_d (sum_i w_i p_id r_i - target_d)^2 / slack_d + 1/2 sum_i w_i (r_i - 1)^2

by projected gradient steps in the metric of ``w``. All steps of a document go
along its posterior, so its rate is ``max(0, 1 - p_i . m)`` for one vector ``m``
over domains: no rate table is shuffled or rewritten between steps. A step is
scaled with the small domain-by-domain matrix of the documents whose rate is
positive; one Spark job over the narrow columns sums gradient, matrix and
objective for several step lengths, and the best one is taken. A few jobs reach
the optimum; a fit that doesn't reach it raises.

The slack is a thousandth of a domain's share of the tokens, so that a rare domain
meets its target like a frequent one. A domain of target 0 has a tenth: every
document belongs to it a little, so only rates of 0 for all could meet it, and a
smaller slack would give rate 0 to many documents that belong to it hardly. Those
with more than half of their posterior in domains of target 0 have rate 0.

Domains of the labels table: ``toxic`` where toxic is 1, else ``high`` or ``low``
by quality; a document with contradicting rows in the table takes the toxic, or
else the lower one.

Cases: null text counts as empty (no tokens; posterior of an empty text); a
null doc_id has no label and gets rates like any row; rows that repeat a doc_id
are rows of their own, and equal texts have equal rates; very long texts are
read whole; labels that are null teach nothing; without labels the posterior is
even; a table without tokens keeps the rates it starts with, an empty one gives
no rows; other columns are kept, those named like the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType

from goldleaf.llm.common import saved, widened

DIMS = 8192
SAMPLE_ROWS = 6000
# Production targets: shares of all tokens by domain.
TARGETS = {"high": 0.9, "low": 0.1, "toxic": 0.0}
# Slack of a domain, as a part of its share of the tokens.
SLACK = 1e-3
ZERO_SLACK = 0.1
STEPS = 60
# Largest slope left, as a part of the smallest domain's share.
TOLERANCE = 1e-4
STRIDES = (1.0, 0.5, 0.25, 0.0625)


class _Buckets(dict):
    """The bucket of each word met; starts anew when it holds too many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = bucket = xxhash.xxh32_intdigest(word) % DIMS
        return bucket


def features(texts: list[str | None], buckets: _Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens per text, and the unit vectors of log counts of hashed words as
    places (text, bucket) with their values."""
    keys, counts = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        counts[k] = len(words)
        keys.append(np.fromiter(map(buckets.__getitem__, words), np.int64, len(words)) + k * DIMS)
    places, times = np.unique(np.concatenate(keys), return_counts=True)
    row, value = places // DIMS, np.log1p(times)
    norm = np.sqrt(np.bincount(row, value * value, len(texts)))
    return counts, row, places % DIMS, value / norm[row]


@dataclass
class DomainModel:
    names: list[str]
    weights: np.ndarray

    def posterior(self, n: int, row: np.ndarray, bucket: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Posteriors of ``n`` texts given by their places."""
        z = np.stack([np.bincount(row, value * w[bucket], n) + w[-1] for w in self.weights.T], 1)
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit_domains(docs: DataFrame, labels: DataFrame, names: list[str], sample_rows: int = SAMPLE_ROWS,
                penalty: float = 1e-4, steps: int = 300) -> DomainModel:
    """Softmax regression on the labelled documents with the smallest hash."""
    rank = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    known = labels.select("doc_id", rank.alias("rank")).where("doc_id is not null and rank is not null")
    known = known.groupBy("doc_id").agg(F.min("rank").alias("rank"))
    # the hash picks labels first, so the texts join only a bounded table
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("rank", "text")

    def run(batches):
        buckets = _Buckets()
        for b in batches:
            _, row, bucket, value = features(b.column("text").to_pylist(), buckets)
            ends = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in (bucket.astype(np.int32), value)]
            yield pa.RecordBatch.from_arrays([b.column("rank"), *lists], ["rank", "buckets", "x"])

    place = {0: "toxic", 1: "low", 2: "high"}
    got = sample.mapInArrow(run, "rank int, buckets array<int>, x array<double>").collect()
    rows = sorted((names.index(place[r[0]]), r[1], r[2]) for r in got if place[r[0]] in names)
    weights = np.zeros((DIMS + 1, len(names)))
    if not rows:
        return DomainModel(names, weights)
    n = len(rows)
    row = np.repeat(np.arange(n), [len(r[1]) for r in rows])
    bucket = np.concatenate([np.array(r[1], np.int64) for r in rows])
    value = np.concatenate([np.array(r[2], float) for r in rows])
    y = np.eye(len(names))[[r[0] for r in rows]]
    look, t, model = weights, 1.0, DomainModel(names, weights)
    for _ in range(steps):
        model.weights = look
        miss = (model.posterior(n, row, bucket, value) - y) / n
        slope = [np.append(np.bincount(bucket, value * v[row], DIMS), v.sum()) for v in miss.T]
        step = look - np.stack(slope, 1) - penalty * look
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look, weights = step + (before - 1) / t * (step - weights), step
    model.weights = weights
    return model


def with_posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``posterior`` (in the order of names)."""
    docs = docs.drop("n_tokens", "posterior")
    d = len(model.names)

    def run(batches):
        buckets = _Buckets()
        for b in batches:
            counts, post = [np.zeros(0, np.int64)], [np.zeros((0, d))]
            texts = b.column("text")
            for k in range(0, len(texts), 256):
                part = texts.slice(k, 256).to_pylist()
                n, *places = features(part, buckets)
                counts.append(n)
                post.append(model.posterior(len(part), *places))
            flat = np.concatenate(post)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * d), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(counts)), lists],
                                             [*b.schema.names, "n_tokens", "posterior"])

    return docs.mapInArrow(run, widened(docs, n_tokens=LongType(), posterior=ArrayType(DoubleType())))


def _posteriors(b: pa.RecordBatch, d: int) -> np.ndarray:
    return np.asarray(b.column("posterior").flatten()).reshape(-1, d)


def _open(p: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """1 for documents that may have a rate above 0."""
    return (p[:, targets == 0].sum(1) <= 0.5).astype(float)


def _sums(narrow: DataFrame, points: list[np.ndarray], targets: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """At each point: half the tokens by squared rate, tokens by domain under
    the rates, and the matrix of the documents with a positive rate."""
    d = len(targets)
    size = 1 + d + d * d

    def run(batches):
        sums = np.zeros((len(points), size))
        for b in batches:
            p, n = _posteriors(b, d), np.asarray(b.column("n_tokens"), np.float64)
            n = n * _open(p, targets)
            for at, m in zip(sums, points):
                rate = np.maximum(0, 1 - p @ m)
                at[0] += n @ (rate * rate) / 2
                at[1:d + 1] += (n * rate) @ p
                at[d + 1:] += ((p * (n * (rate > 0))[:, None]).T @ p).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], ["place", "value"])

    got = narrow.mapInArrow(run, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value"))
    sums = np.zeros(len(points) * size)
    for r in got.collect():  # points x (1 + d + d * d) numbers
        sums[r["place"]] = r["value"]
    return [(v[0], v[1:d + 1], v[d + 1:].reshape(d, d)) for v in sums.reshape(len(points), size)]


def fit_rates(scored: DataFrame, targets: np.ndarray, ridge: float | None = None, steps: int = STEPS,
              tolerance: float = TOLERANCE) -> np.ndarray:
    """The vector m of the rates over written (n_tokens, posterior). A ``ridge``
    is the slack of all domains."""
    narrow, d = scored.select("n_tokens", "posterior"), len(targets)
    row = narrow.agg(F.sum("n_tokens"), *[F.sum(F.col("n_tokens") * F.get("posterior", F.lit(k))) for k in range(d)]).first()
    m, total = np.zeros(d), row[0] or 0
    if not total:
        return m
    smallest = min(v / total for v in row[1:] if v > 0)
    shares = np.maximum(np.array(row[1:], float) / total, smallest)
    slack = shares * np.where(targets > 0, SLACK, ZERO_SLACK) if ridge is None else np.full(d, ridge)
    points = [m]
    for _ in range(steps):
        # the objective's dual: its slope says what the rates at m miss
        found = [(s / total + targets @ at + at @ (slack * at) / 2, at, t / total - targets - slack * at, h / total)
                 for at, (s, t, h) in zip(points, _sums(narrow, points, targets))]
        _, m, slope, matrix = min(found, key=lambda f: f[0])
        if np.abs(slope).max() <= tolerance * smallest:
            return m
        step = np.linalg.solve(matrix + np.diag(slack), slope)
        points = [m + a * step for a in STRIDES]
    raise RuntimeError(f"mixing: rates not found in {steps} steps, largest slope {np.abs(slope).max():.3g}")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
        ridge: float | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``n_tokens``, ``posterior`` (by sorted domain name),
    ``domain`` (the likeliest), ``rate``, and ``copies``: the rate rounded up
    or down by a hash of the row, so that expected copies equal the rate."""
    targets = TARGETS if targets is None else targets
    names = sorted(targets)
    docs = docs.drop("domain", "rate", "copies")
    scored = saved(with_posteriors(docs, fit_domains(docs, labels, names, sample_rows)), "mix-scored", "zstd")
    wanted, d = np.array([targets[k] for k in names], float), len(names)
    m = fit_rates(scored, wanted, ridge)

    def run(batches):
        for b in batches:
            p = _posteriors(b, d)
            top = [names[k] for k in p.argmax(1)] if len(p) else []
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(top, pa.string()), pa.array(_open(p, wanted) * np.maximum(0, 1 - p @ m))],
                [*b.schema.names, "domain", "rate"])

    rated = scored.mapInArrow(run, widened(scored, domain=StringType(), rate=DoubleType()))
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("long"))
