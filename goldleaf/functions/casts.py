"""Typed projection (P1, F10): cast every column to its silver type.

``on_error="fail"`` uses ANSI ``cast``: one bad value fails the job, as one
failed CAST aborts a whole reference model. ``on_error="quarantine"`` uses
``try_cast`` and routes rows whose non-NULL input did not convert into a
second frame with the reasons in ``_validation_errors``. ``on_error="null"``
turns such values into NULL and keeps their rows.

Two cast rules follow the reference's engine rather than Spark's defaults:
boolean text accepts only ``true``/``false`` (Spark also takes ``t``,
``yes``...), and fractional numbers cast to bigint round half away from zero
(Spark truncates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cast_sql(src: str, src_type: T.DataType, target: str, safe: bool) -> str:
    """SQL for one column's cast under the rules above."""
    cast = "TRY_CAST" if safe else "CAST"
    t = target.lower()
    if t == "boolean" and isinstance(src_type, T.StringType):
        low = f"lower(trim({src}))"
        other = ("NULL" if safe else
                 f"CASE WHEN {src} IS NOT NULL THEN CAST(raise_error(concat('invalid boolean: ', {src})) "
                 f"AS BOOLEAN) END")
        return f"CASE WHEN {low} = 'true' THEN true WHEN {low} = 'false' THEN false ELSE {other} END"
    if t in ("bigint", "int", "integer", "smallint") and isinstance(src_type, _FRACTIONAL):
        return f"{cast}(round({src}, 0) AS {t})"
    if t in ("bigint", "int", "integer") and isinstance(src_type, T.StringType):
        # "2.5" as text: parse as decimal first so the rounding rule applies
        return f"{cast}(round({cast}({src} AS decimal(38,9)), 0) AS {t})"
    return f"{cast}({src} AS {t})"


def typed_select(df: DataFrame, columns: list[tuple[str, str]], on_error: str = "fail",
                 keep: list[str] | None = None):
    """Project ``df`` onto ``columns`` (name, type); missing columns are NULL.

    Returns the typed frame, or ``(valid, invalid)`` in quarantine mode.
    ``keep`` names extra columns carried through untouched (e.g. ordering
    metadata needed by a later window). The projection is one SQL select.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    keep = keep or []
    if on_error not in ("fail", "quarantine", "null"):
        raise ValueError(f"on_error must be 'fail', 'quarantine' or 'null', got {on_error!r}")
    safe = on_error != "fail"
    exprs, errors = [], []
    for name, target in columns:
        if name in present:
            typed = _cast_sql(_q(name), present[name], target, safe)
            if safe:
                errors.append(f"CASE WHEN {_q(name)} IS NOT NULL AND ({typed}) IS NULL "
                              f"THEN {_lit(f'{name}: cannot cast to {target}')} END")
        else:
            typed = f"CAST(NULL AS {target})"
        exprs.append(f"{typed} AS {_q(name)}")
    extra = [_q(k) for k in keep if k in present]
    if on_error != "quarantine":
        return df.selectExpr(*exprs, *extra)
    errs = (f"filter(array({', '.join(errors)}), e -> e IS NOT NULL)" if errors
            else "CAST(array() AS array<string>)")
    staged = df.selectExpr(*exprs, *extra, f"{errs} AS _validation_errors")
    valid = staged.filter(F.size("_validation_errors") == 0).drop("_validation_errors")
    invalid = staged.filter(F.size("_validation_errors") > 0)
    return valid, invalid


def to_output(df: DataFrame) -> DataFrame:
    """Timestamps leave as TIMESTAMP_NTZ so results read the same wall clock
    whatever the reader's zone (the session zone round-trips them)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)
