"""Filter audit against a walk over all orders, document by document."""

import random
import re
from collections import Counter
from itertools import permutations

from goldleaf.llm import filter_audit

DOCS = "doc_id bigint, text string, lang string, part string, cell int, n bigint, good boolean, bits int"
LABELS = "doc_id bigint, quality int, toxic int, named int"


def fails(rows):
    """The set of failed filters of each row."""
    out = []
    for d, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = set()
        if len(words) < 100:
            own.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            own.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            own.add("C")
        if re.search(r"[#$%&*|]", text):
            own.add("D")
        if d is not None and any(e is not None and e < d and (t or "") == text for e, t, _ in rows):
            own.add("E")
        out.append(own)
    return out


def brute(rows, labels):
    failed = fails(rows)
    parts = {p or "" for _, _, p in rows}
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for part in parts:
            alive = [k for k, r in enumerate(rows) if (r[2] or "") == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [k for k in alive if f in failed[k]]
                alive = [k for k in alive if f not in failed[k]]
                ids = [rows[k][0] for k in removed]
                out[part, "".join(order), step] = [
                    len(alive), len(removed), sum(f in failed[k] for k in gone),
                    sum(own == {f} and (r[2] or "") == part for own, r in zip(failed, rows)),
                    sum(d in good for d in ids), sum(d in toxic for d in ids)]
                shapley[part, f] += len(removed)
                gone += removed
    return {key: (*v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1, 2, True, 3) for r in rows], DOCS)
    got = filter_audit.audit_filters(docs, spark.createDataFrame([(*r, 1) for r in labels], LABELS)).collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[m] for m in filter_audit.MEASURES) for r in got}
    assert len(out) == len(got)
    return out


def test_cases(spark):
    many = " ".join(f"w{k}" for k in range(120))
    rows = [(1, None, "en"), (2, "", "en"), (3, many, None), (4, many, "de"), (5, many, ""), (6, many + " $", "de"),
            (6, many + " $", "de"), (6, many, "de"), (None, many, "de"), (None, None, None), (7, "a b\x0b c \x85 d", "fr"),
            (8, "W " * 200, "fr"), (9, "Ä É" * 60, "fr"), (10, "ABC DEF", "en"), (11, "x " * 300_000 + "#", "en")]
    labels = [(1, 1, 0), (2, None, 1), (4, 0, 1), (4, 1, None), (6, 1, 1), (None, 1, 1), (99, 1, 1), (11, 1, 0), (11, 1, 0)]
    assert audited(spark, rows, labels) == brute(rows, labels)


def test_random_tables(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["Aa", "b", "C", "d|", "eé", f"w{rng.randrange(400)}"][rng.randrange(2):]) for _ in range(rng.choice([20, 99, 100, 130])))
             + rng.choice(["", "%"]) for _ in range(25)] + [None, "hot copy"]
    rows = [(k, rng.choice(texts[:-1]) if k % 3 else texts[-1], rng.choice(["en", "de", None])) for k in range(160)]
    rng.shuffle(rows)
    labels = [(k, rng.randrange(2), rng.randrange(2)) for k in range(0, 160, 2)]
    assert audited(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert audited(spark, [], []) == {}
    rows = [(1, "one", "en"), (2, "one", "en")]
    assert audited(spark, rows, []) == brute(rows, [])


def test_any_number_of_filters(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 1, 3, 2, 1), ("p", 3, 2, 0, 2)], "part string, cell int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in filter_audit.audit_counts(cells, "XY").collect()}
    assert got == {("XY", 1): (5, 5, 0, 3, 2, 3, 8), ("XY", 2): (5, 0, 2, 0, 0, 0, 2),
                   ("YX", 1): (8, 2, 0, 0, 0, 2, 2), ("YX", 2): (5, 3, 2, 3, 2, 1, 8)}
