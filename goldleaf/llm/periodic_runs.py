"""Periodic run detection over grammar-compressed word sequences.

A run is a stretch of words with smallest period q, at least ``max(6, 4 * q)``
long, that no neighbouring word extends. For every document:

1. Re-Pair: the most frequent pair of neighbouring symbols becomes a new
   nonterminal until no pair occurs twice; pairs of one frequency are taken in
   the order they came up, which keeps derivations shallow. What is left is
   halved into a balanced tree, so every boundary between two words belongs to
   one node of the derivation.
2. For each nonterminal, once, at one of its places: the stretches of period q
   that cross the boundary between its two halves. Such a stretch has two whole
   periods on one side of the boundary, so that side is compared with itself q
   words on; how far the period goes on either way is read from ranks of all
   blocks of 1, 2, 4, ... words (equal rank, equal words). A stretch inside one of
   a smaller period is no run of its own.
3. The stretches are carried to every place of their nonterminal in the
   derivation, and those of one period that overlap by a period are merged. A run
   crosses the boundary of the smallest node that holds it whole, so it is found
   there with both its ends.

Documents are worked on in groups of ``GROUP_WORDS`` words: steps 1 and 3 by
document, step 2 by numpy over a group. Nothing leaves a task but results, and
there is no shuffle.

Cases: a null or empty text has no words, no runs and an empty collapsed text;
a null doc_id is kept as it is, and so are rows that repeat one; a very long
text is a group of its own, in memory and time proportional to n log n words;
an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LEAST, PERIODS = 6, 4
GROUP_WORDS = 200_000
MOST_CHECKS = 2_000_000  # (node, period) pairs looked at in one numpy step
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Grammar:
    """A Re-Pair grammar of a word sequence. Symbol k >= ``words`` is the rule
    ``left[k - words] right[k - words]``; ``place`` is one place of it."""

    def __init__(self, ids: list[int], words: int):
        n = len(ids)
        self.words = words
        self.left, self.right, self.place = [], [], []
        size = [1] * words
        sym, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        found: dict[tuple[int, int], list[int]] = {}
        for p, pair in enumerate(zip(ids, ids[1:])):
            found.setdefault(pair, []).append(p)
        heap = [(-len(ps), k, pair) for k, (pair, ps) in enumerate(found.items()) if len(ps) > 1]
        heapify(heap)
        came = len(found)
        while heap:
            count, k, (a, b) = heappop(heap)
            places, last = [], -1
            for p in sorted(found.pop((a, b))):
                if sym[p] == a and p != last and after[p] < n and sym[after[p]] == b:
                    places.append(p)
                    last = after[p]
            if len(places) < 2:
                continue
            if len(places) < -count and heap and -heap[0][0] > len(places):
                found[a, b] = places  # other pairs are more frequent by now
                heappush(heap, (-len(places), k, (a, b)))
                continue
            new = len(size)
            size.append(size[a] + size[b])
            self.left.append(a)
            self.right.append(b)
            self.place.append(places[0])
            fresh: dict[tuple[int, int], list[int]] = {}
            for p in places:
                q = after[p]
                r, left = after[q], before[p]
                sym[p], sym[q], after[p] = new, -1, r
                if r < n:
                    before[r] = p
                    fresh.setdefault((new, sym[r]), []).append(p)
                if left >= 0:
                    fresh.setdefault((sym[left], new), []).append(left)
            for pair, ps in fresh.items():
                if len(ps) > 1:
                    found[pair] = ps
                    heappush(heap, (-len(ps), came, pair))
                    came += 1
        self.size = size
        self.top = []  # (symbol, place) of the start rule
        p = 0
        while p < n:
            self.top.append((sym[p], p))
            p = after[p]
        self.n = n

    def nodes(self) -> list[tuple[int, int, int, int]]:
        """(rule or -1, start, boundary, end) of each rule and of each node of the
        tree over the start rule that is long enough to hold a run."""
        size, out = self.size, []
        for k, (a, p) in enumerate(zip(self.left, self.place)):
            if size[self.words + k] >= LEAST:
                out.append((k, p, p + size[a], p + size[self.words + k]))
        ends = [p for _, p in self.top] + [self.n]
        m, step = len(self.top), 1
        while step < m:
            for i in range(0, m - step, 2 * step):
                lo, hi = ends[i], ends[min(i + 2 * step, m)]
                if hi - lo >= LEAST:
                    out.append((-1, lo, ends[i + step], hi))
            step *= 2
        return out

    def places(self, rules: set[int]) -> dict[int, list[int]]:
        """Every place of the given rules in the derivation."""
        words, inside = self.words, []
        for k, (a, b) in enumerate(zip(self.left, self.right)):
            inside.append(k in rules or a >= words and inside[a - words] or b >= words and inside[b - words])
        out: dict[int, list[int]] = {k: [] for k in rules}
        todo = [(s - words, p) for s, p in self.top if s >= words and inside[s - words]]
        while todo:
            k, p = todo.pop()
            if k in out:
                out[k].append(p)
            for s, at in ((self.left[k], p), (self.right[k], p + self.size[self.left[k]])):
                if s >= words and inside[s - words]:
                    todo.append((s - words, at))
        return out


class Blocks:
    """Ranks of all blocks of 2**k words of a sequence: two blocks hold the same
    words exactly if their ranks are equal."""

    def __init__(self, seq: np.ndarray, longest: int):
        self.ranks = [seq.astype(np.int64)]
        n, width = len(seq), 1
        while 2 * width <= longest:
            rank = self.ranks[-1]
            whole = n - 2 * width + 1
            pairs = rank[:whole] * (n + 1) + rank[width:width + whole]
            nxt = -1 - np.arange(n, dtype=np.int64)  # blocks beyond the end equal nothing
            nxt[:whole] = np.unique(pairs, return_inverse=True)[1]
            self.ranks.append(nxt)
            width *= 2
        self.n = n

    def alike(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """Number of equal words from ``i`` and ``j`` on (``back``: before them),
        ``most`` at most."""
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, width = self.ranks[k], 1 << k
            while True:  # the widest block may fit several times
                step = -(got + width) if back else got
                fits = got + width <= most
                x, y = (np.where(fits, v + step, 0) for v in (i, j))
                same = fits & (rank[x] == rank[y])
                got[same] += width
                if k + 1 < len(self.ranks) or not same.any():
                    break
        return got


def _candidates(seq: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray):
    """(node, period, anchor) where three words of two neighbouring periods after
    or before the boundary agree, as any run that crosses it must show. The
    anchor is where the two periods begin."""
    out: list[list[np.ndarray]] = [[], [], []]
    most = (hi - lo) // PERIODS
    total = np.cumsum(most)
    at = 0
    while at < len(lo):
        done = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, done + MOST_CHECKS, "right")))
        # one node may have more periods than a step looks at
        for first in range(1, int(most[at:upto].max()) + 1, MOST_CHECKS):
            count = np.clip(most[at:upto] - first + 1, 0, MOST_CHECKS)
            k = np.repeat(np.arange(at, upto), count)
            q = np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count) + first
            for start, fits in ((mid[k], mid[k] + 2 * q <= hi[k]), (mid[k] - 2 * q, mid[k] - 2 * q >= lo[k])):
                rows = [v[fits] for v in (k, q, start)]
                for inner in (lambda y: 0, lambda y: y - 1, lambda y: y // 2):
                    _, y, x = rows
                    same = seq[x + inner(y)] == seq[x + y + inner(y)]
                    rows = [v[same] for v in rows]
                for kept, v in zip(out, rows):
                    kept.append(v)
        at = upto
    return [np.concatenate(v) if v else np.zeros(0, np.int64) for v in out]


def _crossing(docs: list[list[int]], grammars: list[Grammar]) -> list[list[tuple[int, int, int, int]]]:
    """For each document the stretches (rule, start, end, period) found at its
    nodes: periodic, crossing the node's boundary, maximal inside the node."""
    nodes = [(d, *node) for d, g in enumerate(grammars) for node in g.nodes()]
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in docs]
    if not nodes:
        return out
    doc, rule, lo, mid, hi = np.array(nodes, np.int64).T
    base = np.cumsum([0, *map(len, docs)])[:-1]
    lo, mid, hi = (v + base[doc] for v in (lo, mid, hi))
    seq = np.concatenate([np.array(d, np.int64) for d in docs])
    node, q, a = _candidates(seq, lo, mid, hi)
    if not len(node):
        return out
    # only documents with candidates need the ranks of their blocks
    own = np.unique(doc[node])
    shift = np.zeros(len(docs), np.int64)
    shift[own] = np.cumsum([0, *(len(docs[d]) for d in own)])[:-1]
    ranks = Blocks(np.concatenate([np.array(docs[d], np.int64) for d in own]), int((hi - lo)[node].max()))
    move = (shift - base)[doc[node]]
    low, high, b = lo[node] + move, hi[node] + move, mid[node] + move
    a = a + move
    end = a + q + ranks.alike(a, a + q, high - a - q)
    start = a - ranks.alike(a, a + q, a - low, back=True)
    fine = (end - start >= np.maximum(LEAST, PERIODS * q)) & (start < b) & (b < end)
    node, q, start, end = (v[fine] for v in (node, q, start - shift[doc[node]], end - shift[doc[node]]))
    order = np.lexsort((start, q, node))
    was, kept = -1, []
    for k, s, e, y in zip(node[order].tolist(), start[order].tolist(), end[order].tolist(), q[order].tolist()):
        if k != was:
            was, kept = k, []
        if not any(x <= s and e <= z for x, z in kept):  # else of a smaller period, or the same again
            kept.append((s, e))
            out[doc[k]].append((int(rule[k]), s, e, y))
    return out


def _merged(stretches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Maximal (start, length, period) of (period, start, end), by start and period."""
    out: list[list[int]] = []
    for q, s, e in sorted(stretches):
        if out and out[-1][0] == q and s + q <= out[-1][2]:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([q, s, e])
    return sorted((s, e - s, q) for q, s, e in out)


def runs_of(docs: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """All runs (start, length, period) of each sequence of ids; the ids of a
    sequence count up from 0."""
    grammars = [Grammar(ids, max(ids) + 1 if ids else 0) for ids in docs]
    out = []
    for g, found in zip(grammars, _crossing(docs, grammars)):
        places = g.places({k for k, *_ in found if k >= 0}) if found else {}
        out.append(_merged([(q, s + p, e + p) for k, s, e, q in found
                            for p in ((0,) if k < 0 else [at - g.place[k] for at in places[k]])]))
    return out


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run holds after its first period."""
    gone = bytearray(len(words))
    for s, length, q in runs:
        gone[s + q:s + length] = b"\x01" * (length - q)
    return [w for w, g in zip(words, gone) if not g]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, runs (RUNS, by start
    and period) and collapsed, the kept words joined by one space."""
    def worked(ids, texts):
        words = [WORDS.findall(t or "") for t in texts]
        numbered = []
        for ws in words:
            known: dict[str, int] = {}
            numbered.append([known.setdefault(w, len(known)) for w in ws])
        runs = runs_of(numbered)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(list(map(len, words)), pa.int64()),
             pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs],
                      pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
             pa.array([" ".join(collapse(w, r)) for w, r in zip(words, runs)], pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column("text").to_pandas().str.len().fillna(0).to_numpy()
            at, held = 0, 0.0
            for k, size in enumerate(sizes):
                if held and held + size > 4 * GROUP_WORDS:  # few words are shorter than four characters
                    yield worked(b.column("doc_id").slice(at, k - at), b.column("text").slice(at, k - at).to_pylist())
                    at, held = k, 0.0
                held += size
            if at < b.num_rows:
                yield worked(b.column("doc_id").slice(at), b.column("text").slice(at).to_pylist())

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string")
