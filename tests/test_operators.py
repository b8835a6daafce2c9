"""Operators: typed projection, latest-per-key, upsert, SCD1/SCD2, dates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from goldleaf.functions.casts import typed_select
from goldleaf.functions.dates import date_dim
from goldleaf.operators.dedup import latest_per_key
from goldleaf.operators.merge import (ACTION, assert_unique_keys, bounded_upsert, merge_metrics,
                                      upsert)
from goldleaf.operators.scd import scd2, scd2_invariants

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 2, 1)


def test_typed_select_rules(spark):
    df = spark.createDataFrame([("2.5", "true", "2024-01-01"), ("3", "t", "not a date")],
                               "n string, b string, d string")
    valid, invalid = typed_select(df, [("n", "bigint"), ("b", "boolean"), ("d", "date")],
                                  on_error="quarantine")
    v = valid.collect()
    assert [(r.n, r.b, r.d) for r in v] == [(3, True, dt.date(2024, 1, 1))]  # 2.5 rounds half away
    errs = invalid.first()._validation_errors
    assert sorted(errs) == ["b: cannot cast to boolean", "d: cannot cast to date"]


def test_typed_select_fail_mode_raises(spark):
    df = spark.createDataFrame([("x",)], "d string")
    with pytest.raises(Exception):
        typed_select(df, [("d", "date")]).collect()


def test_latest_per_key_total_order_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", T1, "x"), ("a", T2, "y"), ("a", T2, "z"), ("b", None, "q"), (None, T1, "n")],
        "k string, ts timestamp, v string")
    latest, nulls = latest_per_key(df, ["k"], [F.col("ts").desc()])
    got = {r.k: r.v for r in latest.collect()}
    assert got == {"a": "z", "b": "q"}  # tie on ts -> highest v; DESC puts NULL last
    assert nulls.count() == 1


def _t(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, extra string")


def test_upsert_merge_semantics(spark):
    target = _t(spark, [("a", "old", "e1"), ("a", "old", "e2"), ("b", "keep", "e3"), (None, "nk", "e4")])
    source = spark.createDataFrame([("a", "new"), ("c", "ins"), (None, "nk2")], "k string, v string")
    out = upsert(target, source, ["k"], with_action=True)
    rows = sorted((r.k or "", r.v, r.extra or "", r[ACTION]) for r in out.collect())
    assert rows == [("", "nk", "e4", "kept"), ("", "nk2", "", "inserted"),
                    ("a", "new", "e1", "updated"), ("a", "new", "e2", "updated"),
                    ("b", "keep", "e3", "kept"), ("c", "ins", "", "inserted")]
    m = merge_metrics(out).first()
    assert (m.rows_inserted, m.rows_updated, m.rows_kept, m.num_dml_affected_rows) == (2, 2, 2, 4)


def test_upsert_update_cols_differ_from_insert_cols(spark):
    target = spark.createDataFrame([("i1", "o1", 1)], "item string, order_id string, q int")
    source = spark.createDataFrame([("i1", "o2", 5), ("i2", "o3", 7)], "item string, order_id string, q int")
    out = upsert(target, source, ["item"], update_cols=["q"])
    got = {r.item: (r.order_id, r.q) for r in out.collect()}
    assert got == {"i1": ("o1", 5), "i2": ("o3", 7)}  # order_id not rewritten on update (M3)


def test_upsert_hash_guard(spark):
    target = spark.createDataFrame([("a", "v", "h1"), ("b", "v", "h2")], "k string, v string, h string")
    source = spark.createDataFrame([("a", "v2", "h1"), ("b", "v3", "h9")], "k string, v string, h string")
    out = upsert(target, source, ["k"], hash_col="h", with_action=True)
    got = {r.k: (r.v, r[ACTION]) for r in out.collect()}
    assert got == {"a": ("v", "unchanged"), "b": ("v3", "updated")}


def test_assert_unique_keys(spark):
    with pytest.raises(ValueError, match="duplicate keys"):
        assert_unique_keys(spark.createDataFrame([("a",), ("a",)], "k string"), ["k"])
    assert_unique_keys(spark.createDataFrame([("a",), (None,), (None,)], "k string"), ["k"])


def test_upsert_idempotent(spark):
    target = _t(spark, [("a", "1", "x")])
    source = spark.createDataFrame([("a", "2"), ("b", "3")], "k string, v string")
    once = upsert(target, source, ["k"])
    twice = upsert(once, source, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_bounded_upsert_inserts_old_match_again(spark):
    target = spark.createDataFrame([("a", "old", T1), ("b", "old", T2)], "k string, v string, d timestamp")
    source = spark.createDataFrame([("a", "new", T1), ("b", "new", T2)], "k string, v string, d timestamp")
    out = bounded_upsert(target, source, ["k"], "d", F.lit(T2))
    rows = sorted((r.k, r.v) for r in out.collect())
    assert rows == [("a", "new"), ("a", "old"), ("b", "new")]


DIM = ("customer_sk string, customer_id string, email_hash string, customer_segment string, "
       "city string, valid_from timestamp, valid_to timestamp, is_current boolean")


def _src(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, email_hash string, customer_segment string, "
                                       "city string, updated_at timestamp")


def _load(dim, src, null_safe=False):
    return scd2(dim, src, "customer_id", ["email_hash", "customer_segment"],
                ["email_hash", "customer_segment", "city"], "updated_at", "customer_sk", null_safe)


def test_scd2_versions(spark):
    dim0 = spark.createDataFrame([], DIM)
    d1 = _load(dim0, _src(spark, [("c1", "e", "GOLD", "X", T1), ("c2", "e", "GOLD", "X", T1),
                                  ("c3", "e", None, "X", T1)]))
    d2 = _load(d1, _src(spark, [("c1", "e", "PLATINUM", "X", T2),   # tracked change
                                ("c2", "e", "GOLD", "Y", T2),       # untracked change
                                ("c3", "e", "GOLD", "X", T2)]))     # NULL -> value
    rows = sorted((r.customer_id, r.customer_segment or "", r.valid_from, r.valid_to, r.is_current)
                  for r in d2.collect())
    assert rows == [("c1", "GOLD", T1, T2, False), ("c1", "PLATINUM", T2, None, True),
                    ("c2", "GOLD", T1, None, True), ("c3", "", T1, None, True)]
    inv = scd2_invariants(d2, "customer_id").first()
    assert (inv.keys_without_one_current, inv.gaps_or_overlaps) == (0, 0)
    assert d2.select("customer_sk").distinct().count() == d2.count()
    # null-safe comparison versions the NULL -> value change
    d2s = _load(d1, _src(spark, [("c3", "e", "GOLD", "X", T2)]), null_safe=True)
    assert d2s.filter("customer_id = 'c3'").count() == 2


def test_scd2_rerun_is_idempotent(spark):
    dim0 = spark.createDataFrame([], DIM)
    src = _src(spark, [("c1", "e", "GOLD", "X", T1)])
    d1 = _load(dim0, src)
    d2 = _load(d1, src)
    assert sorted(d1.collect()) == sorted(d2.collect())


def test_scd2_same_valid_from_newest_load_wins(spark):
    dim0 = spark.createDataFrame([], DIM)
    d1 = _load(dim0, _src(spark, [("c1", "e", "GOLD", "X", T1)]))
    d2 = _load(d1, _src(spark, [("c1", "e2", "GOLD", "X", T1)]))
    rows = d2.collect()
    assert len(rows) == 1 and rows[0].email_hash == "e2" and rows[0].is_current


def test_date_dim(spark):
    d = date_dim(spark)
    assert d.count() == 4383
    sunday = d.filter(F.col("date_key") == F.lit("2019-01-06").cast("date")).first()
    assert sunday.day_of_week == 1 and sunday.is_weekend
    monday = d.filter(F.col("date_key") == F.lit("2019-01-07").cast("date")).first()
    assert monday.day_of_week == 2 and not monday.is_weekend
    assert dict(d.dtypes)["year"] == "bigint"


def test_scd2_on_products_tracks_price(spark):
    """M7: the same operator versions products on price changes."""
    dim0 = spark.createDataFrame([], "product_sk string, product_id string, unit_price double, "
                                     "brand string, valid_from timestamp, valid_to timestamp, "
                                     "is_current boolean")
    src1 = spark.createDataFrame([("p1", 10.0, "A", T1)], "product_id string, unit_price double, "
                                                          "brand string, updated_at timestamp")
    src2 = spark.createDataFrame([("p1", 12.0, "A", T2)], "product_id string, unit_price double, "
                                                          "brand string, updated_at timestamp")
    d1 = scd2(dim0, src1, "product_id", ["unit_price"], ["unit_price", "brand"], "updated_at", "product_sk")
    d2 = scd2(d1, src2, "product_id", ["unit_price"], ["unit_price", "brand"], "updated_at", "product_sk")
    assert sorted((r.unit_price, r.is_current) for r in d2.collect()) == [(10.0, False), (12.0, True)]


def test_silver_quarantines_unknown_schema_version(spark):
    from goldleaf.plans.silver import silver_model
    rows = [("a", "1.0", T1), ("b", "2.0", T1), (None, "1.0", T1)]
    bronze = spark.createDataFrame(rows, "order_id string, _schema_version string, updated_at timestamp")
    silver, quarantine = silver_model(bronze, "orders", accept_versions=["1.0"])
    assert [r.order_id for r in silver.collect()] == ["a"]
    errs = sorted((r.order_id or "", r._validation_errors[0]) for r in quarantine.collect())
    assert errs == [("", "null primary key order_id"), ("b", "unsupported schema version")]


def test_upsert_hot_null_key_group_is_spread(spark):
    """A NULL 'key' carrying most rows: never matched, kept/inserted whole,
    and spread over many join partitions instead of one."""
    n = 5000
    target = spark.range(n).select(F.lit(None).cast("string").alias("k"), F.col("id").cast("string").alias("v"))
    target = target.unionByName(spark.createDataFrame([("a", "1")], "k string, v string"))
    source = spark.range(n).select(F.lit(None).cast("string").alias("k"), F.lit("s").alias("v"))
    source = source.unionByName(spark.createDataFrame([("a", "2")], "k string, v string"))
    out = upsert(target, source, ["k"], with_action=True)
    counts = {r[ACTION]: r["count"] for r in out.groupBy(ACTION).count().collect()}
    assert counts == {"kept": n, "inserted": n, "updated": 1}
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # keep AQE from merging tiny partitions
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        per_part = out.filter(F.col("k").isNull()).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set(key, old)
    assert len(per_part) > 1 and max(r["count"] for r in per_part) < 2 * n


def test_upsert_into_partitions_rewrites_only_touched(spark):
    from goldleaf.operators.merge import upsert_into_partitions
    from goldleaf.session import scratch_path
    root = scratch_path(spark, "t-partmerge")
    path = f"{root}/orders"
    base = spark.createDataFrame([("o1", "NEW", "2024-01"), ("o2", "NEW", "2024-01"), ("o3", "NEW", "2024-02")],
                                 "order_id string, status string, month string")
    assert upsert_into_partitions(base, path, ["order_id"], "month", f"{root}/stage0") == 2
    before = {r.order_id: r.status for r in spark.read.parquet(path).collect()}
    assert before == {"o1": "NEW", "o2": "NEW", "o3": "NEW"}
    inc = spark.createDataFrame([("o1", "SHIPPED", "2024-01"), ("o4", "NEW", "2024-03")],
                                "order_id string, status string, month string")
    touched = upsert_into_partitions(inc, path, ["order_id"], "month", f"{root}/stage1")
    assert touched == 2
    after = {r.order_id: (r.status, r.month) for r in spark.read.parquet(path).collect()}
    assert after == {"o1": ("SHIPPED", "2024-01"), "o2": ("NEW", "2024-01"),
                     "o3": ("NEW", "2024-02"), "o4": ("NEW", "2024-03")}


def test_scd2_many_versions_of_one_key(spark):
    """One customer with hundreds of versions in one load: the versions
    chain without gaps and exactly one stays current."""
    dim0 = spark.createDataFrame([], DIM)
    rows = [("hot", f"e{i}", "GOLD", "X", T1 + dt.timedelta(hours=i)) for i in range(300)]
    rows += [(f"c{i}", "e", "GOLD", "X", T1) for i in range(40)]
    args = ("customer_id", ["email_hash", "customer_segment"], ["email_hash", "customer_segment", "city"],
            "updated_at", "customer_sk")
    d1 = scd2(dim0, _src(spark, rows[:1] + rows[300:]), *args)
    d2 = scd2(d1, _src(spark, rows[1:300]), *args)  # one load, 299 new versions
    hot = sorted((r.valid_from, r.valid_to, r.is_current) for r in d2.filter("customer_id = 'hot'").collect())
    assert len(hot) == 300
    assert all(hot[i][1] == hot[i + 1][0] for i in range(299)) and hot[-1][2] and hot[-1][1] is None
    inv = scd2_invariants(d2, "customer_id").first()
    assert (inv.keys_without_one_current, inv.gaps_or_overlaps) == (0, 0)


def test_upsert_into_partitions_keeps_null_partitions_and_types(spark):
    from goldleaf.operators.merge import upsert_into_partitions
    from goldleaf.session import scratch_path
    root = scratch_path(spark, "t-partnull")
    schema = "k string, v string, p string"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    read = lambda: sorted(tuple(r) for r in spark.read.schema(schema).parquet(f"{root}/t").collect())
    upsert_into_partitions(frame([("a", "1", "01"), ("b", "1", None), ("c", "1", None)]), f"{root}/t", ["k"], "p", f"{root}/s0")
    upsert_into_partitions(frame([("d", "2", None), ("e", "2", "02")]), f"{root}/t", ["k"], "p", f"{root}/s1")
    upsert_into_partitions(frame([("b", "3", None)]), f"{root}/t", ["k"], "p", f"{root}/s2")
    want = [("a", "1", "01"), ("b", "3", None), ("c", "1", None), ("d", "2", None), ("e", "2", "02")]
    assert sorted(spark.createDataFrame(want, schema).collect()) == sorted(spark.createDataFrame(read(), schema).collect())
    assert {r[2] for r in read()} == {"01", "02", None}
    with pytest.raises(ValueError, match="duplicate keys"):
        upsert_into_partitions(frame([("a", "1", "01"), ("a", "2", "01")]), f"{root}/t", ["k"], "p", f"{root}/s3")


def test_broken_table_is_no_missing_table(spark):
    from goldleaf.session import scratch_path
    from goldleaf.sources.tables import read_if_exists
    path = scratch_path(spark, "t-broken")
    assert read_if_exists(spark.read.parquet, path) is None
    spark.range(3).selectExpr("cast(id as string) as value").write.text(path)
    with pytest.raises(Exception):
        read_if_exists(spark.read.parquet, path)


def test_ids_stay_apart_above_24_bits(spark):
    from pyspark.sql import functions as F

    from goldleaf.plans.compare import duck_connect, run_oracle
    from goldleaf.sources.testdata import uuid_like, uuid_sql

    from .conftest import SF_SMALL
    big = [1, 2**24 - 1, 2**24, 2**24 + 1, 2**31, 2**40 + 7, 2**47]
    pairs = [(a, b) for a in big for b in big]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    ids = [r[0] for r in df.select(uuid_like("item", F.col("a"), F.col("b"))).collect()]
    assert len(set(ids)) == len(pairs) and {len(i) for i in ids} == {36}
    values = ", ".join(map(str, pairs))
    twin = run_oracle(duck_connect(SF_SMALL), f"SELECT {uuid_sql('item', 'a', 'b')} FROM (VALUES {values}) v(a, b)")[1]
    assert sorted(r[0] for r in twin) == sorted(ids)
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([(1, 2**48)], "a bigint, b bigint").select(uuid_like("item", F.col("a"), F.col("b"))).collect()


def test_hot_key_is_split(spark):
    """One key with a third of the rows: the join's hot partition is split,
    although one side comes from an aggregate by the key."""
    from pyspark.sql import functions as F

    from goldleaf.quality.contracts import duplicate_flag
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 300_000
        df = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
                                            F.sha2(F.col("id").cast("string"), 256).alias("v"))
        flagged = duplicate_flag(df, ["k"])
        got = flagged.groupBy("_duplicate_flag").count().collect()
        assert {r[0]: r[1] for r in got} == {True: n // 3, False: n - n // 3}
        sizes = sorted(r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] < n // 6, sizes[-3:]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_record_hash_include_list(spark):
    from goldleaf.functions.hashing import record_hash
    df = spark.createDataFrame([("1", "a", "x"), ("1", "a", "y")], "id string, v string, note string")
    hs = [r.h for r in df.select(record_hash(df, include=["id", "v"]).alias("h")).collect()]
    assert hs[0] == hs[1]


def test_upsert_with_target_gives_the_table_before_and_after(spark):
    target = spark.createDataFrame([("a", 1), ("b", None), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("a", 9), ("c", 4), (None, 5)], "k string, v int")
    for keys_not_null in (False, True):  # NULL keys match nothing either way
        out = upsert(target, source, ["k"], with_target=True, keys_not_null=keys_not_null).collect()
        assert sorted(map(str, [(r._target.k, r._target.v) for r in out if r._target is not None])) == sorted(
            map(str, [("a", 1), ("b", None), (None, 3)]))
        assert sorted(map(str, [(r.k, r.v) for r in out])) == sorted(
            map(str, [("a", 9), ("b", None), ("c", 4), (None, 3), (None, 5)]))
