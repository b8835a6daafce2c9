"""Schema check (C6, C13, C16): split raw JSON records into valid / invalid.

The reference runs a draft-07 validator per Python record. Here the schema
file becomes *one* ``array<string>`` column of error messages built from
Spark expressions over the parsed VARIANT, so validation is a projection
(no UDF, no per-row library): ``filter(array(when(bad, msg), ...), notnull)``.

Keywords used by the entity schemas and supported here: ``type`` (string,
number, integer, boolean, and unions with null), ``required``, ``enum``,
``pattern``, ``minLength``, ``minimum``, ``exclusiveMinimum``,
``additionalProperties: false``. ``format`` is not enforced, as in the
reference (its validator had no format checker).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checks import _result_cols

_UUID = "^[0-9a-f-]{36}$"
_SHA = "^[a-f0-9]{64}$"

# Entity JSON schemas (properties, required) as the reference
# states them. Every entity also has additionalProperties: false.
ENTITY_SCHEMAS: dict[str, dict] = {
    "customers": {
        "required": ["customer_id", "source_customer_id", "email_hash", "first_name", "last_name",
                     "country_code", "signup_date", "customer_segment", "loyalty_points",
                     "is_active", "created_at", "updated_at", "_schema_version"],
        "properties": {
            "customer_id": {"type": "string", "pattern": _UUID},
            "source_customer_id": {"type": "string", "minLength": 1},
            "email_hash": {"type": "string", "pattern": _SHA},
            "first_name": {"type": "string", "minLength": 1},
            "last_name": {"type": "string", "minLength": 1},
            "country_code": {"type": "string", "pattern": "^[A-Z]{2}$"},
            "city": {"type": ["string", "null"]},
            "signup_date": {"type": "string", "format": "date"},
            "customer_segment": {"type": "string", "enum": ["BRONZE", "SILVER", "GOLD", "PLATINUM"]},
            "loyalty_points": {"type": "integer", "minimum": 0},
            "is_active": {"type": "boolean"},
            "created_at": {"type": "string", "format": "date-time"},
            "updated_at": {"type": "string", "format": "date-time"},
            "_schema_version": {"type": "string"},
        },
    },
    "products": {
        "required": ["product_id", "source_product_id", "sku", "product_name", "category_l1",
                     "unit_price", "cost_price", "is_active", "created_at", "updated_at",
                     "_schema_version"],
        "properties": {
            "product_id": {"type": "string", "pattern": _UUID},
            "source_product_id": {"type": "string", "minLength": 1},
            "sku": {"type": "string", "minLength": 1},
            "product_name": {"type": "string", "minLength": 1},
            "category_l1": {"type": "string", "minLength": 1},
            "category_l2": {"type": ["string", "null"]},
            "brand": {"type": ["string", "null"]},
            "unit_price": {"type": "number", "exclusiveMinimum": 0},
            "cost_price": {"type": "number", "exclusiveMinimum": 0},
            "is_active": {"type": "boolean"},
            "created_at": {"type": "string", "format": "date-time"},
            "updated_at": {"type": "string", "format": "date-time"},
            "_schema_version": {"type": "string"},
        },
    },
    "campaigns": {
        "required": ["campaign_id", "source_campaign_id", "campaign_name", "campaign_type",
                     "channel", "start_date", "end_date", "budget_amount", "spent_amount",
                     "is_active", "created_at", "updated_at", "_schema_version"],
        "properties": {
            "campaign_id": {"type": "string", "pattern": _UUID},
            "source_campaign_id": {"type": "string", "minLength": 1},
            "campaign_name": {"type": "string", "minLength": 1},
            "campaign_type": {"type": "string",
                              "enum": ["EMAIL", "SMS", "PAID_SEARCH", "DISPLAY", "SOCIAL"]},
            "channel": {"type": "string", "minLength": 1},
            "start_date": {"type": "string", "format": "date"},
            "end_date": {"type": "string", "format": "date"},
            "budget_amount": {"type": "number", "exclusiveMinimum": 0},
            "spent_amount": {"type": "number", "minimum": 0},
            "target_segment": {"type": ["string", "null"]},
            "is_active": {"type": "boolean"},
            "created_at": {"type": "string", "format": "date-time"},
            "updated_at": {"type": "string", "format": "date-time"},
            "_schema_version": {"type": "string"},
        },
    },
    "inventory": {
        "required": ["inventory_id", "product_id", "warehouse_id", "quantity_on_hand",
                     "quantity_reserved", "quantity_available", "reorder_level", "snapshot_date",
                     "_schema_version"],
        "properties": {
            "inventory_id": {"type": "string", "pattern": _UUID},
            "product_id": {"type": "string", "pattern": _UUID},
            "warehouse_id": {"type": "string", "minLength": 1},
            "quantity_on_hand": {"type": "integer", "minimum": 0},
            "quantity_reserved": {"type": "integer", "minimum": 0},
            "quantity_available": {"type": "integer", "minimum": 0},
            "reorder_level": {"type": "integer", "minimum": 0},
            "snapshot_date": {"type": "string", "format": "date"},
            "_schema_version": {"type": "string"},
        },
    },
    "orders": {
        "required": ["order_id", "source_order_id", "customer_id", "order_status", "order_date",
                     "total_amount", "discount_amount", "tax_amount", "currency_code", "channel",
                     "created_at", "updated_at", "_schema_version"],
        "properties": {
            "order_id": {"type": "string", "pattern": _UUID},
            "source_order_id": {"type": "string", "minLength": 1},
            "customer_id": {"type": "string", "pattern": _UUID},
            "campaign_id": {"type": ["string", "null"]},
            "order_status": {"type": "string", "enum": ["PENDING", "CONFIRMED", "SHIPPED",
                                                       "DELIVERED", "CANCELLED", "RETURNED"]},
            "order_date": {"type": "string", "format": "date-time"},
            "shipped_date": {"type": ["string", "null"], "format": "date-time"},
            "delivered_date": {"type": ["string", "null"], "format": "date-time"},
            "total_amount": {"type": "number", "exclusiveMinimum": 0},
            "discount_amount": {"type": "number", "minimum": 0},
            "tax_amount": {"type": "number", "minimum": 0},
            "currency_code": {"type": "string", "pattern": "^[A-Z]{3}$"},
            "channel": {"type": "string", "enum": ["WEB", "MOBILE", "APP"]},
            "created_at": {"type": "string", "format": "date-time"},
            "updated_at": {"type": "string", "format": "date-time"},
            "_schema_version": {"type": "string"},
        },
    },
    "order_items": {
        "required": ["order_item_id", "order_id", "product_id", "quantity", "unit_price",
                     "line_total", "discount_amount", "return_quantity", "_schema_version"],
        "properties": {
            "order_item_id": {"type": "string", "pattern": _UUID},
            "order_id": {"type": "string", "pattern": _UUID},
            "product_id": {"type": "string", "pattern": _UUID},
            "quantity": {"type": "integer", "minimum": 1},
            "unit_price": {"type": "number", "exclusiveMinimum": 0},
            "line_total": {"type": "number", "exclusiveMinimum": 0},
            "discount_amount": {"type": "number", "minimum": 0},
            "return_quantity": {"type": "integer", "minimum": 0},
            "return_reason": {"type": ["string", "null"]},
            "_schema_version": {"type": "string"},
        },
    },
    "clickstream_events": {
        "required": ["event_id", "session_id", "anonymous_id", "event_type", "event_timestamp",
                     "ingestion_timestamp", "page_url", "device_type", "user_agent_hash",
                     "ip_country", "_schema_version"],
        "properties": {
            "event_id": {"type": "string", "pattern": _UUID},
            "session_id": {"type": "string", "minLength": 1},
            "customer_id": {"type": ["string", "null"]},
            "anonymous_id": {"type": "string", "minLength": 1},
            "event_type": {"type": "string", "enum": ["PAGE_VIEW", "PRODUCT_VIEW", "ADD_TO_CART",
                                                     "CHECKOUT", "PURCHASE", "SEARCH"]},
            "event_timestamp": {"type": "string", "format": "date-time"},
            "ingestion_timestamp": {"type": "string", "format": "date-time"},
            "page_url": {"type": "string", "minLength": 1},
            "referrer_url": {"type": ["string", "null"]},
            "product_id": {"type": ["string", "null"]},
            "search_query": {"type": ["string", "null"]},
            "device_type": {"type": "string", "enum": ["DESKTOP", "MOBILE", "TABLET"]},
            "user_agent_hash": {"type": "string", "pattern": _SHA},
            "ip_country": {"type": "string", "pattern": "^[A-Z]{2}$"},
            "_schema_version": {"type": "string"},
        },
    },
}

_INTEGERS = ["TINYINT", "SMALLINT", "INT", "BIGINT"]


def _once(x: Column, then) -> Column:
    """``then(x)`` with ``x`` evaluated once per row, however often ``then`` uses
    it: a plain column expression is copied to each place that mentions it, which
    for a parsed record meant parsing it a hundred times over."""
    return F.get(F.transform(F.array(x), then), F.lit(0))


def _is_int(vtype: Column) -> Column:
    return vtype.isin(*_INTEGERS) | (vtype.startswith("DECIMAL(") & vtype.endswith(",0)"))


def _is_num(vtype: Column) -> Column:
    return vtype.isin(*_INTEGERS, "FLOAT", "DOUBLE") | vtype.startswith("DECIMAL(")


def _type_ok(vtype: Column, allowed: list[str]) -> Column:
    ok = F.lit(False)
    for t in allowed:
        if t == "string":
            ok = ok | (vtype == "STRING")
        elif t == "boolean":
            ok = ok | (vtype == "BOOLEAN")
        elif t == "null":
            ok = ok | (vtype == "VOID")
        elif t == "integer":
            ok = ok | _is_int(vtype)
        elif t == "number":
            ok = ok | _is_num(vtype)
        elif t == "object":
            ok = ok | vtype.startswith("OBJECT")
        elif t == "array":
            ok = ok | vtype.startswith("ARRAY")
    return ok


def _property_rules(name: str, rule: dict, field: Column, vtype: Column) -> list[tuple[Column, str]]:
    """(violated, message) of each rule of one property: ``field`` is its VARIANT,
    ``vtype`` that one's type, both NULL if it is absent, and so is ``violated``
    then; where a rule has nothing to say it is false or NULL.

    Numbers are read from their JSON text (an infinite one, which that quotes, from
    the VARIANT): casting a VARIANT builds and interprets a cast for every value."""
    allowed = rule.get("type")
    allowed = [allowed] if isinstance(allowed, str) else (allowed or [])
    as_str = F.try_variant_get(field, "$", "string")
    is_str = vtype == "STRING"
    as_num = F.when(_is_num(vtype), F.coalesce(F.to_json(field).try_cast("double"), F.try_variant_get(field, "$", "double")))
    rules: list[tuple[Column, str]] = []
    if allowed:
        rules.append((~_type_ok(vtype, allowed), f"'{name}' is not of type {'/'.join(allowed)}"))
    if "enum" in rule:
        rules.append(((vtype != "VOID") & ~as_str.isin(*rule["enum"]),
                      f"'{name}' is not one of {rule['enum']}"))
    if "pattern" in rule:
        rules.append((is_str & ~as_str.rlike(rule["pattern"]), f"'{name}' does not match '{rule['pattern']}'"))
    if "minLength" in rule:
        rules.append((is_str & (F.char_length(as_str) < rule["minLength"]), f"'{name}' is too short"))
    if "minimum" in rule:
        rules.append((as_num < F.lit(float(rule["minimum"])),
                      f"'{name}' is less than the minimum of {rule['minimum']}"))
    if "exclusiveMinimum" in rule:
        rules.append((as_num <= F.lit(float(rule["exclusiveMinimum"])),
                      f"'{name}' is less than or equal to the minimum of {rule['exclusiveMinimum']}"))
    return rules


def _property_errors(name: str, rule: dict, field: Column, vtype: Column) -> Column:
    """Messages, NULL where a rule holds, for one property."""
    msgs = [F.when(bad, F.lit(m)) for bad, m in _property_rules(name, rule, field, vtype)]
    return F.array(*msgs) if msgs else F.array().cast("array<string>")


def schema_errors(v: Column, schema: dict) -> Column:
    """``array<string>`` of violations of ``schema`` by the VARIANT ``v``.

    Non-objects get one error; each property rule adds one message."""
    return _once(F.struct(v.alias("v")), lambda r: F.when(
        ~F.coalesce(F.schema_of_variant(r["v"]).startswith("OBJECT"), F.lit(False)),
        F.array(F.lit("record is not a JSON object"))).otherwise(_object_errors(r["v"], schema)))


def _object_errors(v: Column, schema: dict) -> Column:
    props: dict = schema.get("properties", {})

    def per_record(r: Column) -> Column:
        def has(name: str) -> Column:
            return F.coalesce(F.array_contains(r["keys"], F.lit(name)), F.lit(False))

        msgs = [F.array(*[F.when(~has(name), F.lit(f"'{name}' is a required property"))
                          for name in schema.get("required", [])]).cast("array<string>")]
        def per_property(name: str, rule: dict) -> Column:
            field = F.variant_get(v, f"$.{name}", "variant")
            return _once(F.struct(field.alias("f"), F.schema_of_variant(field).alias("t")),
                         lambda x: _property_errors(name, rule, x["f"], x["t"]))

        msgs += [per_property(name, rule) for name, rule in props.items()]
        extra = F.array_except(F.coalesce(r["keys"], F.array().cast("array<string>")),
                               F.array(*[F.lit(p) for p in props]).cast("array<string>"))
        msgs.append(_once(extra, lambda e: F.array(F.when(F.size(e) > 0, F.concat(
            F.lit("Additional properties are not allowed ("), F.array_join(e, ", "),
            F.lit(" were unexpected)"))))))
        return F.filter(F.flatten(F.array(*msgs)), lambda m: m.isNotNull())

    keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    return _once(F.struct(keys.alias("keys")), per_record)


def _record_errors(text: Column, schema: dict) -> Column:
    """Violations of ``schema`` by JSON text; text that is no JSON has one."""
    return _once(F.struct(F.try_parse_json(text).alias("v")), lambda r: F.when(
        r["v"].isNull(), F.array(F.lit("record is not valid JSON"))).otherwise(schema_errors(r["v"], schema)))


def split_by_schema(df: DataFrame, value_col: str, schema: dict) -> tuple[DataFrame, DataFrame]:
    """``(valid, invalid)``; invalid rows carry ``_validation_errors``.
    A value that is not JSON at all is invalid with one message."""
    staged = df.withColumn("_validation_errors", _record_errors(F.col(value_col), schema))
    return (staged.filter(F.size("_validation_errors") == 0).drop("_validation_errors"),
            staged.filter(F.size("_validation_errors") > 0))


def invalid_records(df: DataFrame, value_col: str, schema: dict) -> DataFrame:
    """(bad): for each record whether ``schema`` is violated, without messages.

    The parsed record, its properties and their types are columns of one
    projection after the other: each is computed once, since Spark doesn't merge
    projections that would repeat work, and all of it is compiled, which a lambda
    over the record (as the messages need) is not."""
    props = schema.get("properties", {})
    record = df.select(F.try_parse_json(value_col).alias("v")).select(
        F.try_variant_get("v", "$", "map<string,variant>").alias("m"))  # NULL unless an object
    fields = record.select(F.col("m").isNull().alias("none"), F.size("m").alias("keys"),
                           *[F.col("m")[F.lit(p)].alias(f"f{k}") for k, p in enumerate(props)])
    typed = fields.select("*", *[F.schema_of_variant(f"f{k}").alias(f"t{k}") for k in range(len(props))])
    bad, known = F.col("none"), F.lit(0)
    for k, (name, rule) in enumerate(props.items()):
        present = F.col(f"f{k}").isNotNull()
        known = known + present.cast("int")
        if name in schema.get("required", []):
            bad = bad | ~present
        for violated, _ in _property_rules(name, rule, F.col(f"f{k}"), F.col(f"t{k}")):
            bad = bad | violated
    for name in schema.get("required", []):
        if name not in props:  # no property has it, so it is no known key either
            bad = F.lit(True)
    return typed.select(F.coalesce(bad | (known < F.col("keys")), F.lit(False)).alias("bad"))


def schema_check(df: DataFrame, value_col: str, schema: dict, dataset: str, table: str,
                 run_id: str, severity: str = "HIGH", checked_at: Column | None = None) -> DataFrame:
    """One ``dq_results`` row for the schema check of ``df`` (one scan)."""
    checked_at = checked_at if checked_at is not None else F.current_timestamp()
    # count of a CASE: count_if would evaluate its condition twice
    one = invalid_records(df, value_col, schema).agg(
        F.count("*").alias("total"), F.count(F.when(F.col("bad"), 1)).alias("failed"))
    details = F.concat(F.col("failed").cast("string"), F.lit(" records failed schema validation"))
    return one.select(*_result_cols(F.lit("schema_check"), F.lit(None).cast("string"), F.col("total"),
                                    F.col("failed"), F.lit(severity), details, dataset, table,
                                    run_id, checked_at))


def fail_fast(df: DataFrame, value_col: str, schema: dict, sample: int = 3) -> None:
    """Raise when any record is invalid, quoting a few of them."""
    _, invalid = split_by_schema(df, value_col, schema)
    rows = invalid.limit(sample).collect()
    if rows:
        shown = "; ".join(f"{r[value_col]!s:.200} -> {list(r['_validation_errors'])}" for r in rows)
        raise ValueError(f"schema validation failed: {shown}")
