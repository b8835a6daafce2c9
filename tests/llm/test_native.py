"""Chat formatting, license scan and decontamination against brute force."""

import hashlib
import math
import re
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldleaf.llm import chat_format, decontaminate, license_scan, queries

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id bigint, text string, lang string, word string, items int"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- chat formatting -----------------------------------------------------

def check_chats(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, loss int")
    got = {r.conv_id: r for r in chat_format.chat_digest(chat_format.format_chats(df)).collect()}
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns = sorted(turns)
        r = got[c]
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for _, a, b in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.n_messages == sum(i == 0 or turns[i - 1][1] != t[1] for i, t in enumerate(turns))


def test_chat_round_trip_cases(spark):
    nasty = ["", None, "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>", "<\\|im_sep|>", "<", "|im_end|>", "[\\\\INST]",
             "a\n\nb ", "é😀<", "<s", "\\", "x" * 20000]
    rows = [(c, k, role, t) for c, role in ((1, "assistant"), (2, "user"), (None, None), (3, "<|im_sep|>"))
            for k, t in enumerate(nasty)]
    rows += [(4, None, "user", "late"), (4, 1, "assistant", "b"), (4, 1, "assistant", "a"), (4, 1, "assistant", "a")]
    check_chats(spark, rows)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "tool"]),
                          st.text(alphabet="<|>\\[]/simINST_ \né", max_size=30)), min_size=20, max_size=60))
def test_chat_round_trip_random(spark, turns):
    check_chats(spark, [(k // 7, k, role, text) for k, (role, text) in enumerate(turns)])


def test_chat_query_and_empty(spark):
    got = {r.conv_id: r for r in queries.op5_chat_format(spark, SF_SMALL).collect()}
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len(queries.CONTROL_TEXT)
    assert got[-7].loss_sha256 == sha(queries.CONTROL_TEXT)
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat_format.format_chats(empty).count() == 0


# ---- license scan --------------------------------------------------------

def scan_brute(text, threshold=0.8):
    low = (text or "").translate(LOWER)
    w = WORD.findall(low)
    places = {label: [i for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
              for p, label in license_scan.PHRASES.items()}
    base = sorted(k for k, v in places.items() if v)
    at = [i for v in places.values() for i in v]
    labels, best = set(base), 0.0
    for block in low.split("\n"):
        b = set(WORD.findall(block))
        for label, t in license_scan.TEMPLATES:
            t = set(WORD.findall(t.translate(LOWER)))
            if len(t & b) >= math.ceil(round(threshold * len(t), 9)):
                labels.add(label)
                best = max(best, len(t & b) / len(t))
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(base),
            ",".join(sorted(labels)), 1.0 if base else best)


def license_rows(df):
    return sorted(((r.doc_id is not None, r.doc_id or 0), r.n_words, r.n_base, r.first_word, r.last_word,
                   r.base_labels, r.labels, round(r.score, 9)) for r in df.collect())


def license_want(rows):
    return sorted(((d is not None, d or 0), *(round(x, 9) if isinstance(x, float) else x for x in scan_brute(t)))
                  for d, t in rows)


def test_license_cases(spark):
    gpl = license_scan.TEMPLATES[5][1]
    rows = [(1, None), (2, ""), (3, "MIT\nLicense"), (4, "x MIT license, mit LICENSE. Apache-License"), (None, gpl), (4, gpl.upper()),
            (5, " ".join(gpl.split()[:24])), (6, " ".join(gpl.split()[:12])), (7, "General\tPublic License " * 3000),
            (8, "Licensed under CC BY-NC 4.0.\nRELEASED UNDER THE MIT"), (9, "licénse mit licensé")]
    df = spark.createDataFrame([(*r, "en", "w", 1) for r in rows], DOCS)
    assert repr(license_rows(license_scan.scan_licenses(df))) == repr(license_want(rows))
    assert license_scan.scan_licenses(df.limit(0)).count() == 0
    assert license_scan.scan_licenses(df, templates=[]).count() == len(rows)


def test_license_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert repr(license_rows(queries.op4_license_scan(spark, SF_SMALL))) == repr(license_want(rows))


# ---- decontamination -----------------------------------------------------

def decontam_brute(docs, items, span=13):
    spans = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            spans[tuple(w[i:i + n])].add(item)
    lengths = {len(s) for s in spans}
    out = []
    for d, text in docs:
        w, hit, seen = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (at := tuple(w[i:i + n])) in spans:
                    hit.update(range(i, i + n))
                    seen |= spans[at]
        key = ",".join(sorted(map(str, seen)))
        out.append(((d is not None, d or 0), len(w), len(hit), len(seen), sha(key), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def decontam_rows(df):
    return sorted(((r.doc_id is not None, r.doc_id or 0), r.n_words, r.n_hit, r.n_items,
                   sha(",".join(r["items"])), r.contaminated) for r in df.collect())


@pytest.mark.parametrize("short", [False, True])
def test_decontamination_cases(spark, short):
    w = [f"w{i}" for i in range(60)]
    items = [(1, " ".join(w[:40])), (2, " ".join(w[20:60])), (3, " ".join(w[:40])), (4, "ha " * 30), (5, None), (6, "")]
    items += [(7, "One two"), (8, "three")] if short else []
    docs = [(1, None), (2, ""), (3, " ".join(w[5:17])), (4, " ".join(w[5:18])), (5, "A, " + " ".join(w[:60]).upper()),
            (6, "ha " * 500), (7, "x " * 400 + " ".join(w[22:38]) + " y" * 500), (7, "one two three"), (7, "one two three"),
            (None, " ".join(w[3:30])), (8, " ".join(w[3:15] + ["z"] + w[15:40])), (9, "ha " * 12 + "x " + "ha " * 14)]
    d = spark.createDataFrame([(*r, "en", "w", 1) for r in docs], DOCS)
    b = spark.createDataFrame([(*r, 5) for r in items], "item_id bigint, text string, s int")
    assert decontam_rows(decontaminate.contamination(d, b)) == decontam_brute(docs, items)
    if not short:
        kept = decontaminate.drop_contaminated(d, b)
        assert kept.columns == d.columns
        assert kept.count() == sum(not r[-1] for r in decontam_brute(docs, items))
        assert decontaminate.contamination(d.limit(0), b).count() == 0
        assert decontam_rows(decontaminate.contamination(d, b.limit(0))) == decontam_brute(docs, [])


def test_decontamination_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = queries.op8_decontamination(spark, SF_SMALL).select(
        F.struct((F.col("doc_id").isNotNull()).alias("a"), "doc_id").alias("d"), "n_words", "n_hit", "n_items",
        "items_sha256", "contaminated").collect()
    assert sorted((tuple(r[0]), *r[1:]) for r in got) == decontam_brute(docs, items)
