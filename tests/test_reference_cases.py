"""The reference's own unit cases (checks, hash, breaker, parser), restated
on DataFrames."""

import pytest
from pyspark.sql import functions as F

from goldleaf.functions.hashing import record_hash
from goldleaf.quality.checks import (CriticalQualityError, duplicate_check, halt_on_critical,
                                     null_check, range_check, run_checks)
from goldleaf.streaming.parse import dead_letters, good_rows, parse_messages


def _one(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def _null(spark, values):
    df = _one(spark, [(v,) for v in values], "c string")
    return run_checks(df, [null_check(df, "c", "HIGH")], "ds", "t", "run").first()


def test_null_check_passes(spark):
    r = _null(spark, ["abc", "def"])
    assert (r.failed_records, r.status, r.error_details) == (0, "PASSED", "")


def test_null_check_counts_null(spark):
    r = _null(spark, [None, "def"])
    assert r.failed_records == 1 and r.status == "FAILED"
    assert r.error_details == "1 records have null 'c'"


def test_null_check_empty_string_fails(spark):
    assert _null(spark, [""]).status == "FAILED"


def test_null_check_total_and_pct(spark):
    assert _null(spark, ["x"] * 10).total_records == 10
    r = _null(spark, [None, "a", "b", "c"])
    assert r.failure_pct == 25.0


def test_null_check_blank_passes(spark):
    assert _null(spark, ["  "]).failed_records == 0


def _dup(spark, rows, keys, schema):
    df = _one(spark, rows, schema)
    return duplicate_check(df, keys, "ds", "t", "run").first()


def test_duplicate_none(spark):
    assert _dup(spark, [("a",), ("b",), ("c",)], ["k"], "k string").failed_records == 0


def test_duplicate_one(spark):
    r = _dup(spark, [("a",), ("a",), ("b",)], ["k"], "k string")
    assert r.failed_records == 1 and r.error_details == "1 duplicate keys found"


def test_duplicate_composite(spark):
    r = _dup(spark, [("a", "x"), ("a", "x"), ("a", "y")], ["k", "v"], "k string, v string")
    assert r.failed_records == 1
    assert r.rule_name == "duplicate_check_k_v" and r.column_name == "k,v"


def test_duplicate_empty(spark):
    r = _dup(spark, [], ["k"], "k string")
    assert (r.total_records, r.failed_records, r.status) == (0, 0, "PASSED")
    assert r.failure_pct == 0.0


def test_duplicate_typed_keys_do_not_collide(spark):
    # joined text would make ("a|b", "c") equal ("a", "b|c"); typed keys do not
    r = _dup(spark, [("a|b", "c"), ("a", "b|c")], ["k", "v"], "k string, v string")
    assert r.failed_records == 0


def _range(spark, values, lo, hi):
    df = _one(spark, [(v,) for v in values], "c string")
    return run_checks(df, [range_check(df, "c", lo, hi)], "ds", "t", "run").first()


def test_range_within(spark):
    assert _range(spark, ["10", "50"], 0.01, 1000).failed_records == 0


def test_range_below_min(spark):
    r = _range(spark, ["-1"], 0, None)
    assert r.failed_records == 1 and r.error_details == "1 records have 'c' outside [0, None]"


def test_range_null_skipped(spark):
    assert _range(spark, [None], 0, 10).failed_records == 0


def test_range_not_numeric_fails_nan_passes(spark):
    assert _range(spark, ["abc"], 0, 10).failed_records == 1
    assert _range(spark, ["NaN"], 0, 10).failed_records == 0
    assert _range(spark, ["0", "10"], 0, 10).failed_records == 0  # inclusive


def _hash(spark, rows):
    df = spark.createDataFrame(rows, "id string, status string, _ingestion_ts string")
    return [r.h for r in df.select(record_hash(df).alias("h")).collect()]


def test_record_hash_ignores_metadata(spark):
    a, b = _hash(spark, [("1", "NEW", "t1"), ("1", "NEW", "t2")])
    assert a == b


def test_record_hash_changes_with_business_field(spark):
    a, b = _hash(spark, [("1", "NEW", "t1"), ("1", "SHIPPED", "t1")])
    assert a != b


def test_record_hash_is_32_hex_and_repeatable(spark):
    a = _hash(spark, [("1", "NEW", "t1")])[0]
    assert len(a) == 32 and all(c in "0123456789abcdef" for c in a)
    assert _hash(spark, [("1", "NEW", "t1")])[0] == a


def _results(spark, severity, failed, total):
    df = spark.createDataFrame([(severity, failed, total)], "severity string, f long, t long")
    from goldleaf.quality.checks import _result_cols
    return df.select(*_result_cols(F.lit("r"), F.lit("c"), F.col("t"), F.col("f"), F.col("severity"),
                                   F.lit("x"), "ds", "tb", "run", F.current_timestamp()))


def test_breaker_raises_on_critical_failure(spark):
    with pytest.raises(CriticalQualityError, match="5/100"):
        halt_on_critical(_results(spark, "CRITICAL", 5, 100))


def test_breaker_quiet_on_pass_or_lower_severity(spark):
    halt_on_critical(_results(spark, "CRITICAL", 0, 100))
    halt_on_critical(_results(spark, "HIGH", 5, 100))


def _parse(spark, payloads, source="orders", binary=False):
    if binary:
        df = spark.createDataFrame([(p,) for p in payloads], "value binary")
    else:
        df = spark.createDataFrame([(p,) for p in payloads], "value string")
    return parse_messages(df, source)


def test_parser_valid_message(spark):
    p = _parse(spark, ['{"order_id": "ORD-001", "total_amount": 99.99}'])
    row = good_rows(p).select(F.variant_get("record", "$.order_id", "string").alias("id"),
                              F.variant_get("record", "$.total_amount", "double").alias("amt")).first()
    assert (row.id, row.amt) == ("ORD-001", 99.99)


@pytest.mark.parametrize("bad", ["THIS_IS_NOT_JSON", "NOT_VALID_JSON", "NOT JSON", "[INVALID"])
def test_parser_invalid_json_to_dead_letter(spark, bad):
    d = dead_letters(_parse(spark, [bad])).first()
    assert d.payload == bad and d.error_message == "invalid JSON" and d.source == "orders"
    assert d.timestamp is not None


def test_parser_source_tag(spark):
    assert dead_letters(_parse(spark, ["x"], "clickstream")).first().source == "clickstream"


def test_parser_invalid_utf8(spark):
    d = dead_letters(_parse(spark, [b"\xff\xfe INVALID UTF-8"], binary=True)).first()
    assert d.error_message == "invalid UTF-8" and d.payload_base64 == "//4gSU5WQUxJRCBVVEYtOA=="


def test_parser_nested_kept(spark):
    msg = '{"order_id": "O1", "items": [{"sku": "S1"}], "metadata": {"source": "web"}}'
    r = good_rows(_parse(spark, [msg])).select(
        F.variant_get("record", "$.items[0].sku", "string").alias("sku"),
        F.variant_get("record", "$.metadata.source", "string").alias("src")).first()
    assert (r.sku, r.src) == ("S1", "web")


@pytest.mark.parametrize("bad,reason", [
    ('{"a": 1} trailing', "invalid JSON"), ('{"a": NaN}', "invalid JSON"), ("", "invalid JSON"),
    ('{"order_id": "ORD-', "invalid JSON"), ("123", "not a JSON object"),
    ('"x"', "not a JSON object"), ("null", "not a JSON object"), ("[1,2]", "not a JSON object")])
def test_parser_strict_rules(spark, bad, reason):
    assert dead_letters(_parse(spark, [bad])).first().error_message == reason


def test_parser_duplicate_keys_last_wins(spark):
    p = good_rows(_parse(spark, ['{"a": 1, "a": 2}']))
    assert p.select(F.variant_get("record", "$.a", "int").alias("a")).first().a == 2


def test_parser_wrong_type_is_dead_letter(spark):
    df = spark.createDataFrame([('{"total_amount": "abc"}',), ('{"total_amount": 5}',)], "value string")
    p = parse_messages(df, "orders", fields=[("total_amount", "double")])
    got = {r.value: r.error_message for r in p.collect()}
    assert got == {'{"total_amount": "abc"}': "total_amount: expected double", '{"total_amount": 5}': None}
