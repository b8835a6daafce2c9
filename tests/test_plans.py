"""Physical-plan properties the design relies on at scale, read from
``explain()``: they must not silently regress."""

import contextlib
import io
import re

from goldleaf.plans.catalog import QUERIES

from .conftest import SF_SMALL


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _tree(plan: str) -> str:
    return plan.split("\n\n")[0]


def _hash_exchange_ids(plan: str) -> set[str]:
    """Node ids of exchanges that hash-partition (not round-robin spreads)."""
    ids = set()
    for m in re.finditer(r"\((\d+)\) Exchange\s*\n(?:.*\n)*?Arguments: (\w+)", plan):
        if m.group(2) == "hashpartitioning":
            ids.add(m.group(1))
    return ids


def _node_line(tree: str, node_id: str) -> int:
    for i, ln in enumerate(tree.splitlines()):
        if ln.rstrip().endswith(f"({node_id})"):
            return i
    raise AssertionError(node_id)


def test_latest_per_key_limits_before_the_shuffle(spark):
    plan = _plan(QUERIES["silver_dedup_order_items"](spark, SF_SMALL))
    tree = _tree(plan)
    lines = [ln.strip("+-: ") for ln in tree.splitlines()]
    (hash_id,) = _hash_exchange_ids(plan)
    exchange = _node_line(tree, hash_id)
    partial = max(i for i, ln in enumerate(lines) if ln.startswith("WindowGroupLimit"))
    assert partial > exchange  # deeper in the tree = runs before the exchange (map side)
    assert re.search(r"WindowGroupLimit\s*\n(?:.*\n)*?Arguments: .*Partial", plan)


def test_merge_adds_no_exchange_beyond_the_windows(spark):
    plan = _plan(QUERIES["silver_upsert_orders"](spark, SF_SMALL))
    assert "SortMergeJoin FullOuter" in _tree(plan)
    # one hash exchange per side (the latest-per-key windows); the join reuses them
    assert len(_hash_exchange_ids(plan)) == 2, plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["dq_null"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<c_custkey:bigint,c_name:string>" in schemas
    assert all("c_acctbal" not in s for s in schemas)


def test_window_counts_aggregate_partially_before_shuffle(spark):
    tree = _tree(_plan(QUERIES["clickstream_window_counts"](spark, SF_SMALL)))
    lines = [ln.strip("+-: ") for ln in tree.splitlines()]
    aggs = [i for i, ln in enumerate(lines) if ln.startswith("HashAggregate")]
    exchange = [i for i, ln in enumerate(lines) if ln.startswith("Exchange")][0]
    assert len(aggs) == 2 and aggs[0] < exchange < aggs[1]  # final above, partial below


def test_star_join_forces_no_broadcast(spark):
    logical = _plan(QUERIES["star_join_orders_by_segment"](spark, SF_SMALL), mode="extended")
    assert not re.findall(r"ResolvedHint", logical)


def test_filters_reach_the_scan(spark):
    plan = _plan(QUERIES["silver_upsert_orders"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate", plan)


def test_facts_leave_the_columns_of_an_item_where_they_lie(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    try:
        plan = _plan(QUERIES["gold_fact_orders"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin FullOuter" in _tree(plan)
    moved = re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: (.*)\nArguments: hashpartitioning", plan)
    items = [m for m in moved if "line_total#" in m]
    # only the latest-per-key window's own exchange (which orders by ship date)
    assert items and all("_shipdate#" in m for m in items), plan


def test_partition_overwrite_ranks_the_items_once(spark, monkeypatch):
    """Each run ranked all items for itself; now both read the facts of one pass."""
    from goldleaf.plans import gold
    given, daily_sales = [], gold.daily_sales
    monkeypatch.setattr(gold, "daily_sales", lambda facts: given.append(facts) or daily_sales(facts))
    QUERIES["partition_overwrite"](spark, SF_SMALL)
    assert len(given) == 2
    for facts in given:
        plan = _plan(facts)
        assert "Window" not in plan and "Join" not in plan
    run1, run2 = (f.count() for f in given)
    assert 0 < run1 < run2


def test_partitions_grow_with_the_input(spark, monkeypatch, tmp_path):
    from goldleaf import session
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    sizes = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = {k: spark.conf.get(k, None) for k in [key, *sizes]}
    path = str(tmp_path / "t")
    spark.range(1 << 19).selectExpr("uuid() AS x").write.parquet(path)
    try:
        session.small_partitions(spark, spark.read.parquet(path))
        once = int(spark.conf.get(key))
        assert [spark.conf.get(k) for k in sizes] == ["16m", "16m"]
        monkeypatch.setattr(session, "PARTITION_MB", 1)
        session.small_partitions(spark, *[spark.read.parquet(path)] * 4)
        assert 8 <= once and int(spark.conf.get(key)) >= 7 * once  # four times the bytes, half of them each
        spark.conf.set(sizes[0], "8m")
        spark.conf.set(key, "5000")
        session.small_partitions(spark, spark.read.parquet(path))
        assert spark.conf.get(key) == "5000" and spark.conf.get(sizes[0]) == "8m"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
