"""Language-model scoring by prediction by partial matching (PPM).

The model is a trie of byte contexts of up to five bytes with the counts of
the symbol that follows; the symbol after the last byte is an end mark, so a
text's probability is that of the whole text. A symbol unseen in a context costs
that context's escape (distinct symbols / (total + distinct), method C) and is
looked up in the next shorter one, where symbols of the longer context are
excluded. In a trie trained on whole texts the symbols of a context are a
subset of those of its suffixes, so what an exclusion takes from the next
shorter context is a number that each context can carry.

Counts come from all training texts: tasks count their own n-grams, Spark sums
them. The whole trie is written as tables, for each context length the pairs
(context, symbol) and the contexts. A symbol's probability depends on it and the
ORDER symbols before it alone, so the ``max_grams`` most frequent such runs go to
the tasks with theirs; each other run of the texts is joined with the tables,
once however often it occurs. How many runs go to the tasks changes no score.
No key of these joins meets more than SYMBOLS rows of the next longer length.

Beside it, an add-one unigram baseline over words with exact counts: the
``head`` most frequent words go to the tasks, all others are joined.

:func:`train` and :func:`walk` are a smaller model in sorted arrays that leaves
out the rarest pairs; :func:`score_texts` does not use it.

:func:`adaptive_log10` learns within a text instead and needs no training.

Cases: null text counts as empty (its end is its only token); a null doc_id is
not held out; rows that repeat a doc_id are rows of their own; without training
texts every symbol is equally likely and the baseline is 0; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import saved

ORDER = 5
SYMBOLS = 257  # 256 bytes after the mark for start and end, which is 0
MAX_GRAMS = 1_000_000
HEAD = 65_536
END = ""  # the end as a word; no real word is empty
_CHUNK = 1 << 20  # symbols counted together: some 30 MB with their sorted copy
_LOOK = 1 << 19  # symbols looked up together
_ROWS = 512  # texts of a batch at hand together
# Odd multipliers, one for each table of slots.
_MIXES = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only


def symbols(raw: bytes) -> np.ndarray:
    """ORDER start marks, the bytes plus one, the end mark."""
    out = np.zeros(len(raw) + ORDER + 1, np.uint16)
    out[ORDER:-1] = np.frombuffer(raw, np.uint8)
    out[ORDER:-1] += 1
    return out


def gram_codes(s: np.ndarray) -> np.ndarray:
    """One code for each symbol with the ORDER symbols before it."""
    n = len(s) - ORDER
    out = np.zeros(n, np.int64)
    for k in range(ORDER + 1):
        out = out * SYMBOLS + s[k:k + n]
    return out


def texts(batches):
    """The texts of Arrow batches, _ROWS at a time as Python strings: a batch of
    10,000 rows would otherwise be held a second time, whole."""
    for b in batches:
        for k in range(0, b.num_rows, _ROWS):
            yield from b.column("text").slice(k, _ROWS).to_pylist()


@contextmanager
def small_batches(spark):
    """Jobs that run inside send texts to the tasks' Python in Arrow batches of
    _ROWS rows: the vectors of 10,000 whole texts are held by the JVM and by Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(_ROWS, int(before)) if int(before) > 0 else _ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# ---- counts --------------------------------------------------------------

def corpus_counts(docs: DataFrame) -> DataFrame:
    """(word, gram, n): counts of all words (ends as ``""``) and of all
    runs of ORDER + 1 symbols;
    exactly one of word and gram is set."""
    def run(batches):
        words, codes, size = Counter(), [], 0

        def flush():
            grams, n = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())], ["word", "gram", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode("utf-8", "replace") for w in words], pa.string()), pa.nulls(len(words), pa.int64()),
                 pa.array(list(words.values()), pa.int64())], ["word", "gram", "n"])

        for text in texts(batches):
            raw = lowered(text)
            words.update(raw.split())
            words[b""] += 1
            codes.append(gram_codes(symbols(raw)))
            size += len(raw) + 1
            if size >= _CHUNK:
                yield from flush()
                words, codes, size = Counter(), [], 0
        if size:
            yield from flush()
        pa.default_memory_pool().release_unused()

    counted = docs.select("text").mapInArrow(run, "word string, gram bigint, n bigint")
    return counted.groupBy("word", "gram").agg(F.sum("n").alias("n"))


def frequency_class(n):
    """Eight classes for each doubling of ``n``: a few hundred in all."""
    return F.floor(F.log2(n) * 8 + 1e-9)


def least_class(counts: DataFrame, most: int, least: int = 0) -> int:
    """The lowest frequency class, ``least`` or above, such that at most
    ``most`` rows are in it or above."""
    total = 0
    sizes = counts.groupBy(frequency_class(F.col("n")).alias("c")).count().collect()
    for c, rows in sorted(((r["c"], r["count"]) for r in sizes), reverse=True):
        total += rows
        if total > most:
            return max(least, c + 1)
    return least


# ---- the model -----------------------------------------------------------

@dataclass
class Level:
    """One context length: sorted (context, symbol) codes with the log10 count
    of each, sorted contexts with log10 (total + distinct), log10 distinct, and
    the same two of the next shorter context without the symbols seen here."""

    pairs: np.ndarray
    count: np.ndarray
    contexts: np.ndarray
    size: np.ndarray
    kinds: np.ndarray
    left_size: np.ndarray
    left_kinds: np.ndarray


def _find(table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, found) of codes in a sorted table."""
    at = np.minimum(np.searchsorted(table, codes), max(len(table) - 1, 0))
    return at, table[at] == codes if len(table) else np.zeros(len(codes), bool)


def build(grams: list[tuple[np.ndarray, np.ndarray]]) -> list[Level]:
    """Levels from sorted (codes, counts) by context length, shortest first.
    A pair's shorter forms must be there too."""
    levels: list[Level] = []
    below = None
    for k, (pairs, n) in enumerate(grams):
        contexts, row = np.unique(pairs // SYMBOLS, return_inverse=True)
        total, kinds = np.bincount(row, n, len(contexts)), np.bincount(row, minlength=len(contexts))
        rest = kinds_left = np.zeros(len(contexts))
        if k:
            low_pairs, low_n, low_contexts, low_total, low_kinds = below
            seen = np.bincount(row, low_n[_find(low_pairs, pairs % SYMBOLS**k)[0]], len(contexts))
            at = _find(low_contexts, contexts % SYMBOLS**(k - 1))[0]
            rest, kinds_left = low_total[at] - seen, low_kinds[at] - kinds
        below = pairs, n, contexts, total, kinds
        with np.errstate(divide="ignore"):
            levels.append(Level(pairs, np.log10(n), contexts, np.log10(total + kinds), np.log10(kinds),
                                np.log10(rest + kinds_left), np.log10(kinds_left)))
    return levels


def walk(levels: list[Level], codes: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol given the ORDER before it (codes of
    :func:`gram_codes`)."""
    out, open_ = np.zeros(len(codes)), np.arange(len(codes))
    # what is left of the context at hand once the longer one's symbols are out
    size, kinds = np.full(len(codes), np.nan), np.full(len(codes), np.nan)
    for k in range(len(levels) - 1, -1, -1):
        level, own = levels[k], codes[open_] % SYMBOLS**(k + 1)
        pair, hit = _find(level.pairs, own)
        context, known = _find(level.contexts, own // SYMBOLS)
        if len(level.contexts):
            whole = np.isnan(size[open_])
            low = np.where(whole, level.size[context], size[open_])
            few = np.where(whole, level.kinds[context], kinds[open_])
            out[open_[hit]] += level.count[pair[hit]] - low[hit]
            miss = known & ~hit
            escape = miss & np.isfinite(few)  # else nothing is left here to escape from
            out[open_[escape]] += few[escape] - low[escape]
            size[open_[miss]], kinds[open_[miss]] = level.left_size[context[miss]], level.left_kinds[context[miss]]
        open_ = open_[~hit]
    unseen = SYMBOLS - (len(levels[0].pairs) if levels else 0)
    out[open_] -= np.log10(max(unseen, 1))
    return out


def train(counts: DataFrame, max_grams: int = MAX_GRAMS) -> list[Level]:
    """A bounded model from written corpus counts. Shorter contexts have the summed
    counts of the longer ones, before any is left out."""
    longest = counts.where("gram is not null").select("gram", "n")
    grams, least = [], 0
    for k in range(ORDER + 1):
        own = longest.groupBy(F.pmod("gram", F.lit(SYMBOLS**(k + 1))).alias("gram")).agg(F.sum("n").alias("n"))
        if k >= 3:
            own = saved(own, "ppm-grams")
        least = least_class(own, max_grams, least)  # never lower than for a shorter context
        kept = own.where(frequency_class(F.col("n")) >= least).toArrow()
        codes, n = (np.asarray(kept.column(c), np.int64) for c in ("gram", "n"))
        order = np.argsort(codes)
        grams.append((codes[order], n[order].astype(float)))
    return build(grams)


# ---- the whole trie as tables --------------------------------------------

def suffix(code: str, k: int):
    """The last ``k`` symbols of a code."""
    return F.pmod(F.col(code), F.lit(SYMBOLS**k))


def trie(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """By context length, shortest first, from written corpus counts: (pair, n) and
    (context, total, kinds, left_size, left_kinds); the last two are the size
    (total + kinds) and kinds of the next shorter context without the symbols
    seen here."""
    pairs = {ORDER: counts.where("gram is not null").select(F.col("gram").alias("pair"), "n")}
    for k in range(ORDER - 1, -1, -1):
        pairs[k] = saved(pairs[k + 1].groupBy(suffix("pair", k + 1).alias("pair")).agg(F.sum("n").alias("n")), "ppm-pairs")
    out: list[tuple[DataFrame, DataFrame]] = []
    for k in range(ORDER + 1):
        own = pairs[k].withColumn("context", F.expr(f"pair div {SYMBOLS}"))
        sums = [F.sum("n").alias("total"), F.count("*").alias("kinds")]
        if k:
            low = pairs[k - 1].select(F.col("pair").alias("low"), F.col("n").alias("low_n"))
            below = out[-1][1].select(F.col("context").alias("low"), F.col("total").alias("low_total"), F.col("kinds").alias("low_kinds"))
            contexts = (own.withColumn("low", suffix("pair", k)).join(low, "low").groupBy("context").agg(*sums, F.sum("low_n").alias("seen"))
                        .withColumn("low", suffix("context", k - 1)).join(below, "low")
                        .withColumn("left_kinds", F.col("low_kinds") - F.col("kinds"))
                        .withColumn("left_size", F.col("low_total") - F.col("seen") + F.col("left_kinds")))
        else:
            none = F.lit(0).cast("long")
            contexts = own.groupBy("context").agg(*sums).withColumns({"left_kinds": none, "left_size": none})
        out.append((pairs[k], saved(contexts.select("context", "total", "kinds", "left_size", "left_kinds"), "ppm-contexts")))
    return out


def log10_codes(levels: list[tuple[DataFrame, DataFrame]], codes: DataFrame) -> DataFrame:
    """(pair, value): log10 probability of each of the distinct codes ``pair``.

    Down: the pairs unseen at a length are asked for at the next shorter one.
    Up: ``reached`` is the value once the longer context's symbols are out, but
    for what the longer context says of the rest (its left_size and left_kinds);
    ``value`` is that of a walk which starts here."""
    asked = {}
    for k in range(ORDER, -1, -1):
        asked[k] = saved(codes.join(levels[k][0], "pair", "left"), "ppm-asked")
        codes = asked[k].where("n is null").select(suffix("pair", k).alias("pair")).distinct()
    unseen = F.lit(-float(np.log10(max(SYMBOLS - levels[0][0].count(), 1))))
    below = None
    for k in range(ORDER + 1):
        rows = asked[k].withColumn("context", F.expr(f"pair div {SYMBOLS}")).join(levels[k][1], "context", "left")
        shorter = on = unseen
        if k:
            rows = rows.withColumn("low", suffix("pair", k)).join(below, "low", "left")
            rest = F.log10("left_size")
            on = F.when(F.col("low_seen"), F.col("low_reached") - rest).when(
                F.col("left_kinds") > 0, F.col("low_reached") + F.log10("left_kinds") - rest).otherwise(F.col("low_reached"))
            shorter = F.col("low_value")
        size, seen = F.log10(F.col("total") + F.col("kinds")), F.col("n").isNotNull()
        rows = saved(rows.select(
            "pair", seen.alias("seen"), F.when(seen, F.log10("n")).otherwise(on).alias("reached"),
            F.when(F.col("total").isNull(), shorter).when(seen, F.log10("n") - size).otherwise(F.log10("kinds") - size + on).alias("value")),
            "ppm-values")
        below = rows.select(F.col("pair").alias("low"), *[F.col(c).alias(f"low_{c}") for c in ("seen", "reached", "value")])
    return rows.select("pair", "value")


def frequent_codes(levels: list[tuple[DataFrame, DataFrame]], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of the at most ``most`` frequent runs of ORDER + 1 symbols,
    and their log10 probabilities."""
    pairs, contexts = levels[ORDER]
    often = pairs.where(frequency_class(F.col("n")) >= least_class(pairs, most)).withColumn("context", F.expr(f"pair div {SYMBOLS}"))
    got = often.join(contexts, "context").select("pair", (F.log10("n") - F.log10(F.col("total") + F.col("kinds"))).alias("value")).toArrow()
    codes, values = np.asarray(got.column("pair"), np.int64), np.asarray(got.column("value"), np.float64)
    order = np.argsort(codes)
    return codes[order], values[order]


@dataclass
class Slots:
    """Where each of ``codes`` stands, by hash: a code lies in the first table in
    which no other code took its slot (an empty slot says 0, which no other code
    equals), the few without one in a sorted rest."""

    codes: np.ndarray
    tables: list[tuple[np.uint64, np.uint64, np.ndarray]]
    rest: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray) -> Slots:
        tables, left = [], np.arange(len(codes), dtype=np.int32)
        for mix in _MIXES:
            if not len(left):
                break
            bits = (4 * len(left)).bit_length()
            shift = np.uint64(64 - bits)
            place = codes[left].view(np.uint64) * mix >> shift
            table = np.zeros(1 << bits, np.int32)
            table[place] = left
            tables.append((mix, shift, table))
            left = left[table[place] != left]
        return cls(codes, tables, left)

    def find(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, found) of ``own``, as :func:`_find` gives them where found."""
        at, found = np.zeros(len(own), np.int32), np.zeros(len(own), bool)
        open_ = None  # all
        for mix, shift, table in self.tables:
            asked = own if open_ is None else own[open_]
            place = table[asked.view(np.uint64) * mix >> shift]
            hit = self.codes[place] == asked
            if open_ is None:
                at, found, open_ = place, hit, np.flatnonzero(~hit)
            else:
                at[open_[hit]], found[open_[hit]] = place[hit], True
                open_ = open_[~hit]
        if len(self.rest):
            place, hit = _find(self.codes[self.rest], own[open_])
            at[open_[hit]], found[open_[hit]] = self.rest[place[hit]], True
        return at, found


def look_up(slots: Slots, values: np.ndarray, raws: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(log10 probability of each text's symbols that ``slots`` has, (code, times) of
    all others by text)."""
    out, rare, held, size = np.zeros(len(raws)), [[] for _ in raws], [], 0

    def flush():
        owner = np.repeat([i for i, _ in held], [len(c) for _, c in held])
        own = np.concatenate([c for _, c in held])
        at, found = slots.find(own)
        out[:] += np.bincount(owner[found], values[at[found]], len(raws))
        owner, own = owner[~found], own[~found]
        ends = np.searchsorted(owner, np.arange(len(raws) + 1))
        for i in np.unique(owner):
            rare[i].append(own[ends[i]:ends[i + 1]])
        held.clear()

    for i, raw in enumerate(raws):
        s = symbols(raw)
        for k in range(0, len(s) - ORDER, _LOOK):
            held.append((i, gram_codes(s[k:k + _LOOK + ORDER])))
            size += len(held[-1][1])
            if size >= _LOOK:
                flush()
                size = 0
    if held:
        flush()
    none = np.zeros(0, np.int64)
    return out, [np.unique(np.concatenate(r), return_counts=True) if r else (none, none) for r in rare]


def adaptive_log10(text: str | None, order: int = ORDER) -> float:
    """Code length of one text (as log10 probability) when the trie learns as
    it reads: the same escapes and exclusions, counts of what came before."""
    s, total = symbols(lowered(text)).tolist(), 0.0
    counts: dict[tuple, Counter] = defaultdict(Counter)
    for i in range(ORDER, len(s)):
        out: set[int] = set()
        for k in range(order, -1, -1):
            seen = counts.get(tuple(s[i - k:i]), {})
            left = {x: c for x, c in seen.items() if x not in out}
            size = sum(left.values()) + len(left)
            if s[i] in left:
                total += np.log10(left[s[i]] / size)
                break
            if left:
                total += np.log10(len(left) / size)
                out |= left.keys()
        else:
            total -= np.log10(SYMBOLS - len(out))
        for k in range(order + 1):
            counts[tuple(s[i - k:i])][s[i]] += 1
    return float(total)


# ---- scoring -------------------------------------------------------------

def score_texts(docs: DataFrame, held_out: str = "held_out", head: int = HEAD, max_grams: int = MAX_GRAMS) -> DataFrame:
    """Learn from the rows where boolean column ``held_out`` is false, score
    all: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    with small_batches(spark):
        counts = saved(corpus_counts(docs.where(~F.col(held_out))), "ppm-counts")
    words = counts.where("word is not null").select("word", "n")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = words.where(frequency_class(F.col("n")) >= least_class(words, head)).toArrow().to_pydict()
    top = {w.encode(): float(np.log10(c + 1)) for w, c in zip(frequent["word"], frequent["n"])}
    least = min(frequent["n"], default=1 << 62)
    levels = trie(counts)
    model = spark.sparkContext.broadcast((*frequent_codes(levels, max_grams), top))

    def run(batches):
        codes, values, top = model.value
        slots = Slots.of(codes)
        for b in batches:
            for k in range(0, b.num_rows, _ROWS):
                yield part(slots, values, top, b.slice(k, _ROWS))
        pa.default_memory_pool().release_unused()

    def part(slots, values, top, b):
        tokens, known, base, tail_words, tail_n, ends = [], [], [], [], [], [0]
        raws = [lowered(t) for t in b.column("text").to_pylist()]
        for raw in raws:
            own = Counter(raw.split())
            own[b""] = 1
            seen, value = 0, 0.0
            for w, c in own.items():
                if w in top:
                    seen += c
                    value += c * top[w]
                else:
                    tail_words.append(w.decode("utf-8", "replace"))
                    tail_n.append(c)
            ends.append(len(tail_words))
            tokens.append(own.total())
            known.append(seen)
            base.append(value)
        tail = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(tail_words, pa.string()), pa.array(tail_n, pa.int64())], ["word", "c"]))
        often, rare = look_up(slots, values, raws)
        starts = np.cumsum([0, *(len(r) for r, _ in rare)])
        runs = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(np.concatenate([x[k] for x in rare]), pa.int64()) for k in (0, 1)], ["pair", "c"]))
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("held_out"), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
             pa.array(base, pa.float64()), pa.array(often), tail, runs],
            ["doc_id", "held_out", "n_tokens", "known", "base", "often", "tail", "runs"])

    schema = ("doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, often double, "
              "tail array<struct<word:string,c:bigint>>, runs array<struct<pair:bigint,c:bigint>>")
    with small_batches(spark):
        read = saved(docs.select("doc_id", F.col(held_out).alias("held_out"), "text").mapInArrow(run, schema)
                     .withColumn("rid", F.monotonically_increasing_id()), "ppm-scored")
    # words outside the head; those never seen in training add nothing
    rest = read.select("rid", F.inline("tail")).join(words.where(F.col("n") < least), "word")
    rest = rest.groupBy("rid").agg(F.sum("c").alias("more_known"), F.sum(F.col("c") * F.log10(F.col("n") + 1)).alias("more"))
    # runs outside the head, those never seen in training included
    runs = read.select("rid", F.inline("runs"))
    rare = runs.join(log10_codes(levels, runs.select("pair").distinct()), "pair").groupBy("rid").agg(
        F.sum(F.col("c") * F.col("value")).alias("rare"))
    out = read.drop("tail", "runs").join(rest, "rid", "left").join(rare, "rid", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("often") + F.coalesce("rare", F.lit(0.0))).alias("score"))
