"""Message parsing with a dead-letter route.

Pure column expressions, so one function serves a batch frame and a
streaming frame alike, and a poison message never raises: it becomes a
dead-letter row with a reason. Rules (strict JSON, as Python's json.loads):

* not valid UTF-8                      -> ``invalid UTF-8``
* not exactly one JSON value (also: trailing text after an object,
  cut-off text, free text, empty line) -> ``invalid JSON``
* a JSON value that is not an object   -> ``not a JSON object``
* with a ``fields`` schema: a present field whose value does not convert
  to the declared type                 -> ``<field>: expected <type>``

``{"a": NaN}`` stays invalid (strict JSON; Python accepts it). Duplicate
keys are rejected unless ``spark.sql.variant.allowDuplicateKeys`` is on
(goldleaf sessions turn it on: last value wins, as in Python).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dead-letter reasons.
ERR_UTF8 = "invalid UTF-8"
ERR_JSON = "invalid JSON"
ERR_NOT_OBJECT = "not a JSON object"
ERR_AHEAD = "event time ahead of arrival"


def _text_and_bytes(df: DataFrame, value_col: str) -> tuple[Column, Column]:
    dt = df.schema[value_col].dataType
    raw = F.col(value_col)
    if isinstance(dt, T.BinaryType):
        return raw.cast("string"), raw
    return raw, raw.cast("binary")


def parse_messages(df: DataFrame, source: str, value_col: str = "value",
                   fields: list[tuple[str, str]] | None = None) -> DataFrame:
    """Add ``record`` (VARIANT; NULL unless the text is one JSON value), typed
    ``fields`` (if given), ``payload``,
    ``payload_base64`` (only for non-UTF-8 input), ``error_message``
    (NULL = good) and ``source``."""
    text, raw = _text_and_bytes(df, value_col)
    utf8_ok = F.coalesce(F.is_valid_utf8(text), F.lit(False))
    names = [n for n, _ in fields or []]
    taken = [c for c in df.columns if c not in ("record", *names)]

    def bind(rows: DataFrame, **cols: Column) -> DataFrame:
        # a generator's columns are computed once: as plain expressions they are
        # copied into each filter and field that reads them
        return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))

    # one parse as the items of an array: text after the value is a second item, or breaks it
    rows = bind(df, _items=F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))))
    first = F.try_variant_get("_items", "$[0]", "variant")
    rows = bind(rows, _record=F.when(F.try_variant_get("_items", "$[1]", "variant").isNull(), first))
    v, typed = F.col("_record"), {}
    for k, (name, t) in enumerate(fields or []):
        typed[f"_f{k}"] = F.try_variant_get(v, f"$.{name}", t)
        if t in ("timestamp", "timestamp_ntz", "date"):
            # ISO text -> time; variant_get reads strings, then cast
            typed[f"_f{k}"] = F.try_variant_get(v, f"$.{name}", "string").try_cast(t)
    if typed:
        rows = bind(rows, **typed)
    # of valid JSON the first character says whether it is an object
    is_object = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
    err = (F.when(~utf8_ok, F.lit(ERR_UTF8)).when(v.isNull(), F.lit(ERR_JSON))
           .when(~is_object, F.lit(ERR_NOT_OBJECT)))
    for k, (name, t) in enumerate(fields or []):
        field = F.variant_get(v, f"$.{name}", "variant")
        # a missing field is SQL NULL, a JSON null is a variant null
        present = field.isNotNull() & ~F.is_variant_null(field)
        err = err.when(F.col(f"_f{k}").isNull() & present, F.lit(f"{name}: expected {t}"))
    payload = F.when(utf8_ok, text).otherwise(F.make_valid_utf8(text))
    rows = bind(rows, _payload=payload, _payload_base64=F.when(~utf8_ok, F.base64(raw)), _error=err)
    return rows.select(*[F.col(c) for c in taken], v.alias("record"), *[F.col(f"_f{k}").alias(n) for k, n in enumerate(names)],
                       F.col("_payload").alias("payload"), F.col("_payload_base64").alias("payload_base64"),
                       F.col("_error").alias("error_message"), F.lit(source).alias("source"))


def gate_ahead(parsed: DataFrame, ts: str, arrival: str, ahead: str = "5 minutes",
               unless: Column | None = None) -> DataFrame:
    """L4 admission: refuse good rows whose time ``ts`` lies more than ``ahead``
    after their ``arrival``. They would push the watermark past every open window.
    A row without either time passes, as do rows that meet ``unless``."""
    early = F.col("error_message").isNull() & (F.col(ts) > F.col(arrival) + F.expr(f"INTERVAL {ahead}"))
    if unless is not None:
        early = early & ~unless
    return parsed.withColumn("error_message", F.when(early, F.lit(ERR_AHEAD)).otherwise(F.col("error_message")))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error_message").isNull())


def dead_letters(parsed: DataFrame) -> DataFrame:
    """L2 dead-letter shape: payload, payload_base64, error_message, source,
    timestamp (processing time)."""
    return parsed.filter(F.col("error_message").isNotNull()).select(
        "payload", "payload_base64", "error_message", "source",
        F.current_timestamp().alias("timestamp"))
