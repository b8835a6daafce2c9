"""Schema check, contracts, referential and status checks."""

import datetime as dt
import json


from goldleaf.quality.contracts import (duplicate_flag, foreign_key_check, late_flag,
                                        status_transitions, volume_spike)
from goldleaf.quality.schema_check import ENTITY_SCHEMAS, schema_check, split_by_schema

GOOD_CUSTOMER = {
    "customer_id": "0a1b2c3d-0000-4000-8000-000000000001", "source_customer_id": "C1",
    "email_hash": "a" * 64, "first_name": "Ann", "last_name": "Lee", "country_code": "US",
    "city": None, "signup_date": "2020-01-01", "customer_segment": "GOLD", "loyalty_points": 10,
    "is_active": True, "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z",
    "_schema_version": "1.0"}


def _check(spark, records):
    df = spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in records],
                               "value string")
    valid, invalid = split_by_schema(df, "value", ENTITY_SCHEMAS["customers"])
    return valid, {r.value: list(r._validation_errors) for r in invalid.collect()}


def test_schema_valid_record(spark):
    valid, bad = _check(spark, [GOOD_CUSTOMER])
    assert valid.count() == 1 and bad == {}


def test_schema_fixture_63_char_email_is_invalid(spark):
    rec = dict(GOOD_CUSTOMER, email_hash="a" * 63)
    _, bad = _check(spark, [rec])
    assert list(bad.values()) == [["'email_hash' does not match '^[a-f0-9]{64}$'"]]


def test_schema_keywords(spark):
    cases = {
        "missing": ({k: v for k, v in GOOD_CUSTOMER.items() if k != "first_name"},
                    "'first_name' is a required property"),
        "extra": (dict(GOOD_CUSTOMER, nickname="x"), "Additional properties are not allowed (nickname were unexpected)"),
        "enum": (dict(GOOD_CUSTOMER, customer_segment="IRON"), "'customer_segment' is not one of"),
        "minimum": (dict(GOOD_CUSTOMER, loyalty_points=-1), "'loyalty_points' is less than the minimum of 0"),
        "integer": (dict(GOOD_CUSTOMER, loyalty_points=1.5), "'loyalty_points' is not of type integer"),
        "boolean": (dict(GOOD_CUSTOMER, is_active="yes"), "'is_active' is not of type boolean"),
        "minLength": (dict(GOOD_CUSTOMER, last_name=""), "'last_name' is too short"),
        "not_object": ("[1, 2]", "record is not a JSON object"),
        "not_json": ("{oops", "record is not valid JSON"),
    }
    _, bad = _check(spark, [c for c, _ in cases.values()])
    for name, (rec, msg) in cases.items():
        key = rec if isinstance(rec, str) else json.dumps(rec)
        assert any(m.startswith(msg) for m in bad[key]), (name, bad[key])


def test_schema_integer_accepts_whole_float_and_null_union(spark):
    valid, bad = _check(spark, [dict(GOOD_CUSTOMER, loyalty_points=3.0, city="Oslo")])
    assert valid.count() == 1, bad


def test_schema_check_result_row(spark):
    df = spark.createDataFrame([(json.dumps(GOOD_CUSTOMER),), ("nope",)], "value string")
    r = schema_check(df, "value", ENTITY_SCHEMAS["customers"], "bronze", "customers", "run").first()
    assert (r.total_records, r.failed_records, r.status, r.failure_pct) == (2, 1, "FAILED", 50.0)


def test_foreign_key_check(spark):
    child = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), ("b",)], "pk string")
    r = foreign_key_check(child, "fk", parent, "pk", "rel", "ds", "run").first()
    assert (r.total_records, r.failed_records, r.error_details) == (4, 1, "1 unknown keys")


def test_status_transitions(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    hist = spark.createDataFrame(
        [("o1", "PENDING", t[0]), ("o1", "CONFIRMED", t[1]), ("o1", "SHIPPED", t[2]),
         ("o1", "DELIVERED", t[3]), ("o1", "SHIPPED", t[4]),
         ("o2", "PENDING", t[0]), ("o2", "PENDING", t[1]), ("o2", "DELIVERED", t[2]),
         (None, "PENDING", t[0])], "order_id string, status string, ts timestamp")
    bad = status_transitions(hist, "order_id", "status", "ts").collect()
    assert sorted((r.order_id, r.from_status, r.to_status) for r in bad) == [
        ("o1", "DELIVERED", "SHIPPED"), ("o2", "PENDING", "DELIVERED")]


def test_volume_spike(spark):
    days = [(dt.date(2024, 1, d), 10) for d in range(1, 9)] + [(dt.date(2024, 1, 9), 30)]
    df = spark.createDataFrame(days, "day date, n long")
    flags = {r.day.day: r.is_spike for r in volume_spike(df, "day", "n").collect()}
    assert flags[9] and not any(v for d, v in flags.items() if d != 9)


def test_duplicate_and_late_flags(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 11)),
                                ("a", dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 5)),
                                ("b", dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 10))],
                               "k string, ev timestamp, ing timestamp")
    out = late_flag(duplicate_flag(df, ["k"]), "ev", "ing", 10).collect()
    got = sorted((r.k, r._duplicate_flag, r._is_late_arrival) for r in out)
    assert got == [("a", True, False), ("a", True, True), ("b", False, False)]


def test_fail_fast_raises_with_samples(spark):
    import pytest

    from goldleaf.quality.schema_check import fail_fast
    df = spark.createDataFrame([(json.dumps(GOOD_CUSTOMER),),
                                (json.dumps(dict(GOOD_CUSTOMER, loyalty_points=-5)),)], "value string")
    with pytest.raises(ValueError, match="loyalty_points"):
        fail_fast(df, "value", ENTITY_SCHEMAS["customers"])
    fail_fast(df.limit(1), "value", ENTITY_SCHEMAS["customers"])


def test_status_transitions_hot_key_split_across_chunks(spark):
    """One order holds most of the history: its versions are range-split
    into chunks and the steps across chunk borders are still found."""
    base = dt.datetime(2024, 1, 1)
    cycle = ["PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "SHIPPED"]  # last step illegal
    rows = [("hot", cycle[i % 5], base + dt.timedelta(hours=i)) for i in range(400)]
    rows += [(f"o{i}", "PENDING", base) for i in range(50)] + [(f"o{i}", "DELIVERED", base + dt.timedelta(days=1))
                                                              for i in range(50)]
    hist = spark.createDataFrame(rows, "order_id string, status string, ts timestamp")
    got = status_transitions(hist, "order_id", "status", "ts", chunks=8).collect()
    hot = [r for r in got if r.order_id == "hot"]
    # every cycle: DELIVERED->SHIPPED (illegal), and SHIPPED->PENDING between cycles (illegal)
    assert len(hot) == 80 + 79
    assert len([r for r in got if r.order_id != "hot"]) == 50  # PENDING->DELIVERED skips steps


def test_status_transitions_across_buckets_and_lazily(spark):
    import datetime as dt

    from goldleaf.quality.contracts import status_transitions
    day = dt.datetime(2024, 1, 31, 23, 59)
    rows = [("a", "PENDING", day), ("a", "CONFIRMED", day + dt.timedelta(minutes=5)),           # over a month's end: allowed
            ("b", "SHIPPED", day), ("b", "PENDING", day + dt.timedelta(days=70)),               # over an empty month: illegal
            ("c", "PENDING", None), ("c", "DELIVERED", day), (None, "PENDING", day), ("a", "CONFIRMED", day + dt.timedelta(minutes=5))]
    hist = spark.createDataFrame(rows, "k string, s string, at timestamp_ntz")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = status_transitions(hist, "k", "s", "at")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before  # building the frame runs nothing
    assert sorted((r.k, r.from_status, r.to_status) for r in got.collect()) == [("b", "SHIPPED", "PENDING"), ("c", "PENDING", "DELIVERED")]
    monthly = status_transitions(hist, "k", "s", "at", bucket="day")
    assert sorted(r.k for r in monthly.collect()) == ["b", "c"]


def test_schema_check_parses_a_record_once(spark):
    """The parsed record and its keys were copied to every rule that reads them."""
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"b": null}',), ("{",)], "value string").repartition(2)
    schema = {"required": ["a", "b"], "properties": {
        "a": {"type": "integer", "minimum": 1}, "b": {"type": "string", "minLength": 1, "pattern": "^x$"}}}
    r = schema_check(df, "value", schema, "bronze", "t", "run")
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson(") == 1
    assert [r.first()[c] for c in ("total_records", "failed_records")] == [3, 2]


def test_schema_check_is_compiled_and_agrees_with_the_messages(spark):
    """The count interpreted a lambda over each record; it must find just the
    records that get a message."""
    from goldleaf.quality.schema_check import invalid_records
    odd = ["null", "[]", "{}", '""', '"x"', "0", "-0.0", "3.0", "1.5", "1e2", "1e400", "-1e400", "-1e-400", "99999999999999999999",
           "-0.00000000000000000000000000000000000000000001", "NaN", "01", '"-5"', '"GOLD"', '"US\\n"', "true", '{"a": null}']
    text = {k: json.dumps(v) for k, v in GOOD_CUSTOMER.items()}
    records = [None, "", "null", "1", "{}", "[]", "{oops", "{} x", '{"a": 1', json.dumps(GOOD_CUSTOMER)]
    for name in text:
        swapped = [{**text, name: x} for x in odd] + [{k: v for k, v in text.items() if k != name}, {**text, name.upper(): "1"}, {**text, name + ".x": "1"}]
        records += ["{" + ", ".join(f'"{k}": {v}' for k, v in r.items()) + "}" for r in swapped]
        records.append("{" + f'"{name}": null, ' + json.dumps(GOOD_CUSTOMER)[1:])
    schema = ENTITY_SCHEMAS["customers"]
    df = spark.createDataFrame([(r,) for r in records], "value string").coalesce(1)
    valid, invalid = split_by_schema(df, "value", schema)
    bad = [r.bad for r in invalid_records(df, "value", schema).collect()]
    assert None not in bad and sorted(str(r.value) for r in invalid.collect()) == sorted(str(r) for r, b in zip(records, bad) if b)
    assert [str(r.value) for r in valid.collect()] == [str(r) for r, b in zip(records, bad) if not b]
    check = schema_check(df, "value", schema, "bronze", "t", "run")
    assert check.first().failed_records == sum(bad)
    assert "lambda" not in check._jdf.queryExecution().optimizedPlan().toString()
    none = invalid_records(df, "value", {"required": ["gone"], "properties": {"a": {}}})
    assert all(r.bad for r in none.collect())


def test_generated_schema_checks_are_small_enough_for_the_jvm_compiler(spark):
    """Methods beyond 8,000 bytes stay interpreted; a check with messages isn't generated at all."""
    df = spark.createDataFrame([("{}",)], "value string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, schema in ENTITY_SCHEMAS.items():
            check = schema_check(df, "value", schema, "bronze", name, "run")
            code = check._jdf.queryExecution().debug().codegenToSeq()
            parts = [code.apply(k) for k in range(code.size())]
            assert any("parseJson" in p._2() for p in parts), name
            assert max(p._3().maxMethodCodeSize() for p in parts) < 8000, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_foreign_key_checks_agree_with_the_single_check(spark):
    """Several relations in one pass: a parent that is a child too, NULL keys, two
    relations on one parent, empty tables."""
    import pytest
    from pyspark.sql import functions as F

    from goldleaf.quality.contracts import foreign_key_checks
    s = "id string, parent string, other string"
    frames = {"a": spark.createDataFrame([("1", None, "x"), ("1", "9", "x"), (None, "9", "y"), ("2", "1", None)], s),
              "b": spark.createDataFrame([("x", "1", "1"), ("z", "2", "3"), (None, "3", "3")], s),
              "empty": spark.createDataFrame([], s)}
    relations = [("a_a", "a", "parent", "a", "id"), ("a_b", "a", "other", "b", "id"), ("b_a", "b", "parent", "a", "id"),
                 ("b_a2", "b", "other", "a", "id"), ("e_a", "empty", "parent", "a", "id"), ("b_e", "b", "other", "empty", "id"),
                 ("e_e", "empty", "other", "empty", "id")]
    at = F.lit("2024-01-01").cast("timestamp")
    want = [foreign_key_check(frames[c], fk, frames[p], pk, n, "ds", "run", checked_at=at).first() for n, c, fk, p, pk in relations]
    got = foreign_key_checks(frames, relations, "ds", "run", checked_at=at)
    assert got.columns == list(want[0].asDict())
    assert sorted(got.collect(), key=lambda r: r.rule_name) == sorted(want, key=lambda r: r.rule_name)
    with pytest.raises(ValueError, match="several types"):
        foreign_key_checks({**frames, "c": spark.range(3)}, [("a_c", "a", "parent", "c", "id")], "ds", "run")


def test_referential_checks_sort_each_silver_table_once(spark):
    from goldleaf.plans.catalog import QUERIES

    from .conftest import SF_SMALL
    for name, tables in (("dq_referential_contracts", 7), ("dq_referential", 6)):  # the latter has customers and the active ones
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert sum("Window [" in line for line in plan.splitlines()) == tables, plan


def test_checks_read_small_splits(spark):
    from goldleaf.plans.catalog import QUERIES

    from .conftest import SF_SMALL
    key = "spark.sql.files.maxPartitionBytes"
    try:
        for name in ("dq_cross_column", "dq_sla", "dq_referential", "dq_referential_contracts"):
            spark.conf.set(key, "128MB")
            QUERIES[name](spark, SF_SMALL)
            assert spark.conf.get(key) == "16m", name
        spark.conf.set(key, "1m")
        QUERIES["dq_referential"](spark, SF_SMALL)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)
