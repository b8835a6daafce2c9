"""Benchmark decontamination by winnowing.

Of every run of ``span`` consecutive words only the smallest k-gram hash is
kept (window of ``span - k + 1`` k-grams). Equal spans have equal smallest
hashes, so a shared span of ``span`` words always shares a kept fingerprint.
Fingerprints of documents and benchmark are joined, and every joined hit is
extended: the whole spans around it are compared word by word.

An item with fewer words than ``span`` (but not none) is one span of its own
length; for such lengths every gram of that length is a fingerprint.

Nothing here runs Python: hashes, sliding minima and the comparison are array
expressions. The benchmark side of the join is small or large by its own size;
Spark broadcasts it only below its size threshold and shuffles it beyond.

Cases: null text has no words; a null doc_id is a value like any other; rows
that repeat a doc_id are judged each by its own text; a benchmark without
words marks nothing; an empty table gives no rows; other columns are kept by
:func:`drop_contaminated` and ignored elsewhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import ascii_lower, let, saved, words_of

SPAN = 13
GRAM = 6


def _slide(array: Column, width: int, join, then) -> Column:
    """``then`` applied to ``array`` with ``join`` over each ``width``
    neighbours, by doubling; ``join`` may see neighbours twice. Entries past
    the last whole window are rests that the caller cuts off."""
    def grow(a, reach):
        if reach >= width:
            return then(a)
        step = min(reach, width - reach)
        longer = F.zip_with(a, F.slice(a, F.lit(step + 1), F.greatest(F.size(a) - step, F.lit(0))), join)
        return let(longer, lambda b: grow(b, reach + step))

    return let(array, lambda a: grow(a, 1))


def _first(array: Column, n: Column) -> Column:
    return F.slice(array, F.lit(1), F.greatest(n, F.lit(0)))


def _prints(words: Column, span: int, gram: int) -> Column:
    """Kept fingerprints: ``fp``, and ``s`` so that every span start with this
    smallest gram hash lies in ``s .. s + span - gram`` of some entry."""
    window = span - gram + 1

    def prints(w):
        def smallest(grams):
            return _slide(_first(grams, F.size(w) - (gram - 1)), window,
                          lambda a, b: F.least(a, b),
                          lambda m: let(_first(m, F.size(w) - (span - 1)), marked))

        return _slide(F.transform(w, lambda x: F.xxhash64(x)), gram, lambda a, b: F.xxhash64(a, b), smallest)

    def marked(m):
        # where the smallest hash changes, and every window-th start besides
        places = F.filter(F.sequence(F.lit(0), F.size(m) - 1, F.lit(1)),
                          lambda i: (i % window == 0) | (F.get(m, i) != F.get(m, i - 1)))
        return F.when(F.size(m) > 0, F.transform(places, lambda i: F.struct(
            F.get(m, i).alias("fp"), i.alias("s")))).otherwise(
                F.expr("cast(array() as array<struct<fp:bigint,s:int>>)"))

    return let(words, prints)


def _starts(s: Column, n_words: Column, span, gram) -> Column:
    """Span starts an entry stands for."""
    return F.sequence(s, F.least(s + (span - gram), n_words - span))


def benchmark_fingerprints(benchmark: DataFrame, span: int = SPAN, gram: int = GRAM
                           ) -> tuple[DataFrame, list[int]]:
    """(table, lengths): one row per item and run with ``len``, ``fp``,
    ``spans`` (the distinct span texts of the run), ``seg`` (their digest) and
    ``item_id``; ``lengths`` are the span lengths that occur (at most
    ``span`` numbers)."""
    items = saved(benchmark.select(
        "item_id", words_of(ascii_lower(F.coalesce("text", F.lit("")))).alias("words")), "bench-words")
    items = items.withColumn("len", F.least(F.size("words"), F.lit(span))).where("len > 0")
    lengths = sorted(r[0] for r in items.select("len").distinct().collect())
    parts = []
    for n in lengths:
        k = gram if n == span else n
        prints = items.where(F.col("len") == n).select(
            "item_id", "len", "words", F.inline(_prints(F.col("words"), n, k)))
        texts = F.transform(_starts(F.col("s"), F.size("words"), F.lit(n), F.lit(k)),
                            lambda i: F.array_join(F.slice("words", i + 1, F.col("len")), " "))
        parts.append(prints.select("item_id", "len", "fp", F.array_sort(F.array_distinct(texts)).alias("spans")))
    if not parts:
        return benchmark.sparkSession.createDataFrame(
            [], "item_id bigint, len int, fp bigint, spans array<string>, seg string"), []
    out = reduce(DataFrame.unionByName, parts)
    return saved(out.withColumn("seg", F.md5(F.array_join("spans", "\n"))).distinct(), "bench-fp"), lengths


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: doc_id, ``text_key`` (hash of the text, to tell
    rows with one doc_id apart), n_words, n_hit, n_items, ``items`` (sorted as
    strings) and contaminated."""
    bench, lengths = benchmark_fingerprints(benchmark, span, gram)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    words = words_of(ascii_lower(F.col("text")))
    # One pass over the texts: an entry of length 0 carries the word count,
    # the others are kept fingerprints.
    entry = "struct<len:int,fp:bigint,s:int>"

    def entries(w):
        def of_length(n):
            return F.transform(_prints(w, n, gram if n == span else n), lambda r: F.struct(
                F.lit(n).alias("len"), r["fp"].alias("fp"), r["s"].alias("s")))

        own = map(of_length, lengths)
        size = F.array(F.struct(F.lit(0).alias("len"), F.lit(0).cast("long").alias("fp"), F.size(w).alias("s")))
        return F.concat(size.cast(f"array<{entry}>"), *own)

    prints = docs.select("doc_id", "text_key", F.inline(let(words, entries)))
    segments = bench.select("len", "fp", "seg", "spans").distinct().unionByName(
        docs.sparkSession.range(1).select(
            F.lit(0).alias("len"), F.lit(0).cast("long").alias("fp"), F.lit("").alias("seg"),
            F.expr("cast(array() as array<string>)").alias("spans")))
    met = saved(prints.join(segments, ["len", "fp"]).groupBy("doc_id", "text_key").agg(
        F.max(F.when(F.col("len") == 0, F.col("s"))).alias("n_words"),
        F.count(F.when(F.col("len") == 0, F.lit(1))).alias("n_rows"),
        F.collect_set(F.when(F.col("len") > 0, F.struct("s", "len", "seg", "spans"))).alias("hits")), "decontam-hits")

    hit = met.where(F.size("hits") > 0).select(F.col("doc_id").alias("h_doc"), F.col("text_key").alias("h_key"), "hits")
    texts = docs.join(hit, F.col("doc_id").eqNullSafe(F.col("h_doc")) & (F.col("text_key") == F.col("h_key")))

    def extended(w, h):
        """Starts of the spans around hit ``h`` that equal a benchmark span."""
        reach = F.when(h["len"] == span, F.lit(span - gram)).otherwise(F.lit(0))
        return F.filter(F.sequence(h["s"], F.least(h["s"] + reach, F.size(w) - h["len"])), lambda i: F.array_contains(
            h["spans"], F.array_join(F.slice(w, i + 1, h["len"]), " ")))

    def judged(w):
        found = F.filter(F.transform(F.col("hits"), lambda h: F.struct(
            h["seg"].alias("seg"), h["len"].alias("len"), extended(w, h).alias("at"))), lambda f: F.size(f["at"]) > 0)
        return let(found, lambda fs: F.struct(
            F.size(F.array_distinct(F.flatten(F.transform(fs, lambda f: F.flatten(F.transform(
                f["at"], lambda i: F.sequence(i, i + f["len"] - 1))))))).cast("long").alias("n_hit"),
            F.array_distinct(F.transform(fs, lambda f: f["seg"])).alias("segs")))

    hits = saved(texts.select("doc_id", "text_key", let(words, judged).alias("j"))
                 .select("doc_id", "text_key", "j.*").where("n_hit > 0").dropDuplicates(["doc_id", "text_key"]),
                 "decontam-verified")
    per_doc = (hits.select("doc_id", "text_key", "n_hit", F.explode("segs").alias("seg"))
               .join(bench.select("seg", "item_id").distinct(), "seg")
               .groupBy(F.col("doc_id").alias("i_doc"), F.col("text_key").alias("i_key"))
               .agg(F.max("n_hit").alias("n_hit"),
                    F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    rows = met.select("doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"),
                      F.explode(F.array_repeat(F.lit(1), F.col("n_rows").cast("int"))).alias("one"))
    out = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("i_doc")) & (F.col("text_key") == F.col("i_key")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return out.select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        items.alias("items"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``docs`` without its contaminated rows, all columns kept."""
    bad = contamination(docs, benchmark, span, gram).where("contaminated").select(
        F.col("doc_id").alias("_bad_doc"), F.col("text_key").alias("_bad_key")).distinct()
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_bad_doc")) & (key == F.col("_bad_key")), "left_anti")
