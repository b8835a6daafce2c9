"""As-of lookup, and MERGE: uniqueness in the plan, stored partitioned targets."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from goldleaf.operators.asof import asof_lookup
from goldleaf.operators.merge import touched, upsert, upsert_into_partitions
from goldleaf.session import scratch_path

DAY = dt.datetime(2020, 1, 1)


def test_asof_equals_a_walk_over_the_versions(spark):
    rng = random.Random(5)
    versions = [(k, DAY + dt.timedelta(days=rng.randrange(900)), f"v{i}") for i, k in enumerate([rng.randrange(12) for _ in range(60)])]
    versions = list({(k, t): (k, t, a) for k, t, a in versions}.values()) + [(None, DAY, "x"), (3, None, "y")]
    # key 0 holds a third of the facts, key 99 no version
    facts = [(i, rng.choice([0, *range(1, 14), 99]) if i % 3 else 0, DAY + dt.timedelta(days=rng.randrange(-50, 1000), hours=rng.randrange(24)))
             for i in range(600)]
    facts += [(1000 + i, k, t) for i, (k, t, _) in enumerate(versions)]  # facts at a version's own moment, and without key or time
    by_key = {}
    for k, t, a in versions:
        if k is not None and t is not None:
            by_key.setdefault(k, []).append((t, a))
    want = {}
    for i, k, t in facts:
        own = sorted(by_key.get(k, []))
        at = bisect.bisect_right([x for x, _ in own], t) if t is not None else 0
        want[i] = own[at - 1][1] if k is not None and at else None
    f = spark.createDataFrame(facts, "id int, k int, at timestamp_ntz")
    v = spark.createDataFrame(versions, "k int, since timestamp_ntz, name string")
    for bucket in ("month", "year", "day"):
        got = asof_lookup(f, v, "k", "at", "since", ["name"], bucket=bucket).collect()
        assert {r.id: r.name for r in got} == want and len(got) == len(facts)


def test_asof_closed_versions_and_clashing_names(spark):
    v = spark.createDataFrame([("a", DAY, DAY + dt.timedelta(days=10), 1)], "k string, since timestamp_ntz, until timestamp_ntz, n int")
    f = spark.createDataFrame([("a", DAY + dt.timedelta(days=d), "note") for d in (-1, 0, 9, 10, 400)], "k string, at timestamp_ntz, since string")
    got = asof_lookup(f, v, "k", "at", "since", ["n"], valid_to="until")
    assert [r.n for r in got.orderBy("at").collect()] == [None, 1, 1, None, None]
    assert got.columns == ["k", "at", "since", "n"]
    assert asof_lookup(f.limit(0), v, "k", "at", "since", ["n"]).count() == 0
    assert asof_lookup(f, v.limit(0), "k", "at", "since", ["n"]).where("n is null").count() == 5


def test_asof_spreads_a_hot_key(spark):
    f = spark.range(4000).select(F.lit("hot").alias("k"), (F.lit(DAY) + F.make_dt_interval(days=(F.col("id") % 730).cast("int"))).alias("at"))
    v = spark.createDataFrame([("hot", DAY, 1), ("hot", DAY + dt.timedelta(days=400), 2)], "k string, since timestamp_ntz, n int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof_lookup(f, v, "k", "at", "since", ["n"])
        shares = [r.n for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert max(shares) < 2000 and len(shares) > 3
        assert {r.n: r["count"] for r in got.groupBy("n").count().collect()} == {
            1: sum(1 for i in range(4000) if i % 730 < 400), 2: sum(1 for i in range(4000) if i % 730 >= 400)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_asof_moves_only_what_is_read_and_reads_facts_twice(spark, tmp_path):
    spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(DAY).alias("at"), F.lit("w").alias("wide")).write.parquet(f"{tmp_path}/f")
    v = spark.createDataFrame([("1", DAY, 1)], "k string, since timestamp_ntz, n int")
    found = asof_lookup(spark.read.parquet(f"{tmp_path}/f"), v, "k", "at", "since", ["n"]).groupBy("n").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "wide" not in plan
    assert {r.n: r["count"] for r in found.collect()} == {1: 1, None: 49}


def test_upsert_raises_on_two_matches(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    twice = spark.createDataFrame([("a", 5), ("a", 6)], "k string, v int")
    with pytest.raises(Exception, match="more than one source row matches a target row, k = a"):
        upsert(target, twice, ["k"]).collect()
    with pytest.raises(Exception, match="more than one source row"):
        upsert(target, twice, ["k"]).select(F.lit(1)).count()  # pruned columns don't lose it
    # as in MERGE: repeats that match nothing are inserted, NULL keys never match
    free = spark.createDataFrame([("z", 5), ("z", 6), (None, 7), (None, 8)], "k string, v int")
    got = sorted(((r.k, r.v) for r in upsert(target, free, ["k"]).collect()), key=str)
    assert got == sorted([("a", 1), ("b", 2), ("z", 5), ("z", 6), (None, 7), (None, 8)], key=str)
    # duplicate target rows that match one source row are each updated
    one = spark.createDataFrame([("a", 9)], "k string, v int")
    assert sorted(r.v for r in upsert(target.union(target), one, ["k"]).collect()) == [2, 2, 9, 9]


def test_upsert_check_costs_no_second_shuffle(spark):
    spark.range(1000).selectExpr("cast(id as string) k", "id v").write.parquet(path := f"{scratch_path(spark, 't-uniq')}/s")
    df = spark.read.parquet(path)
    plan = upsert(df.hint("shuffle_merge"), df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_partition_merge_keeps_columns_and_files(spark):
    root = scratch_path(spark, "t-part")
    path = f"{root}/t"
    spark.createDataFrame([(1, "x", "old", "01"), (2, "y", "old", "02"), (3, "z", "old", None)], "k int, v string, note string, m string") \
        .write.partitionBy("m").parquet(path)
    files = {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").where("m is null or m != '01'").collect()}
    inc = spark.createDataFrame([(1, "X", 7, "01"), (5, "N", 8, "01"), (6, "M", 9, "03")], "k int, v string, extra int, m string")
    assert upsert_into_partitions(inc, path, ["k"], "m", f"{root}/stage") == 2
    schema = "k int, v string, note string, extra int, m string"
    got = sorted((r.k, r.v, r.note, r.extra, r.m) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [(1, "X", "old", 7, "01"), (2, "y", "old", None, "02"), (3, "z", "old", None, None), (5, "N", None, 8, "01"), (6, "M", None, 9, "03")]
    assert files <= {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").collect()}
    # a later merge still knows every column, whichever file is looked at first
    upsert_into_partitions(spark.createDataFrame([(2, "Y", "02")], "k int, v string, m string"), path, ["k"], "m", f"{root}/stage2")
    got = sorted((r.k, r.v, r.note, r.extra) for r in spark.read.schema(schema).parquet(path).where("k < 3").collect())
    assert got == [(1, "X", "old", 7), (2, "Y", "old", None)]
    twice = spark.createDataFrame([(2, "a", "02"), (2, "b", "02")], "k int, v string, m string")
    with pytest.raises(ValueError, match="duplicate keys"):
        upsert_into_partitions(twice, path, ["k"], "m", f"{root}/stage3")
    assert spark.read.parquet(path).count() == 5


def test_partition_merge_reads_touched_partitions_only(spark):
    root = scratch_path(spark, "t-prune")
    spark.range(0, 400).selectExpr("id k", "nullif(cast(id % 40 as string), '9') m", "'v' v").write.partitionBy("m").parquet(f"{root}/t")
    target = spark.read.schema("k long, v string, m string").parquet(f"{root}/t")
    for values, n in ((["3", "4"], 20), (["3", None], 20), ([None], 10), (["999"], 0)):
        read = touched(target, "m", values)
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
        assert read.count() == n
    # the scan opens no other folder: with the others' files damaged, it still reads
    damaged = f"{root}/t/m=5"
    spark.range(3).selectExpr("cast(id as string) as value").write.mode("append").text(damaged)
    with pytest.raises(Exception):
        spark.read.schema(target.schema).parquet(f"{root}/t").collect()
    inc = spark.createDataFrame([(3, "new", "3")], "k long, v string, m string")
    fresh = spark.read.schema(target.schema).parquet(f"{root}/t")
    assert touched(fresh, "m", [r.m for r in inc.collect()]).count() == 10


def test_facts_keep_items_without_an_id(spark):
    from goldleaf.plans.gold import fact_orders_source
    o = spark.createDataFrame([("o1", "c", "p", DAY, "PENDING", "WEB", "USD")],
                              "order_id string, customer_id string, campaign_id string, order_date timestamp, order_status string, channel string, currency_code string")
    i = spark.createDataFrame([("o1", "i1", "p", 1), ("o1", None, "p", 2), ("o1", None, "p", 3), ("o2", None, "p", 4)],
                              "order_id string, order_item_id string, product_id string, quantity bigint")
    i = i.selectExpr("*", "1.0 AS unit_price", "1.0 AS line_total", "0.0 AS discount_amount")
    assert sorted(r.quantity for r in fact_orders_source(o, i).collect()) == [1, 2, 3]


def test_report_tables_lands_its_tables_beside_each_other(spark, monkeypatch):
    """All seven writers are at work before the first one ends."""
    import threading

    from pyspark.sql import DataFrameWriter

    from goldleaf.plans.catalog import QUERIES

    from .conftest import SF_SMALL
    write, all_in, seen, loads = DataFrameWriter.parquet, threading.Barrier(7), set(), []

    def parquet(self, path, *args, **kw):
        loads.append(path)
        if path not in seen:
            seen.add(path)
            all_in.wait(timeout=30)
        return write(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    rows = QUERIES["report_tables"](spark, SF_SMALL).collect()
    assert len(rows) == len(seen) == 7 and len(loads) == 11
    assert {r.table_name: r.n_loads for r in rows} == {
        "customers": 2, "products": 2, "campaigns": 2, "orders": 2, "order_items": 1, "inventory": 1, "clickstream_events": 1}
