"""Data-quality checks as Spark aggregations.

The reference loops over a Python list of records once per check. Here all
column checks of one table are columns of *one* aggregate (one scan, map-
side partial aggregation), then unpivoted into ``dq_results`` rows. Only the
duplicate check needs its own shuffle (group by the key).

Semantics kept from the reference:
* null: NULL, missing, or empty text fails; blanks pass;
* duplicate: failed = sum(count - 1) over repeated keys, details = number
  of repeated keys; NULLs group together;
* range: NULL skipped; not a number fails; bounds inclusive, either one
  optional; NaN passes (both comparisons false);
* status PASSED when nothing failed, else FAILED; WARNING is never set;
* failure_pct = round(failed / total * 100, 4) half-even, 0.0 when empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DQ_RESULT_COLUMNS

# Severities and statuses.
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
STATUSES = ("PASSED", "FAILED", "WARNING")


@dataclass(frozen=True)
class Check:
    """One row-level rule. ``failed`` is a boolean Column: True = row fails."""
    rule_name: str
    column_name: str | None
    failed: Column
    severity: str
    details: str  # template with {failed}


def _is_string(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def null_check(df: DataFrame, column: str, severity: str = "HIGH") -> Check:
    c = F.col(f"`{column}`")
    bad = c.isNull() | (c == "") if (column in df.columns and _is_string(df, column)) else c.isNull()
    if column not in df.columns:
        bad = F.lit(True)  # a missing field counts as NULL on every row
    return Check(f"null_check_{column}", column, bad, severity,
                 "{failed} records have null '" + column + "'")


def _fmt(v) -> str:
    return "None" if v is None else repr(v) if isinstance(v, float) else str(v)


def range_check(df: DataFrame, column: str, min_value=None, max_value=None,
                severity: str = "MEDIUM") -> Check:
    raw = F.col(f"`{column}`")
    num = raw.try_cast("double")
    nan = F.isnan(num)
    out = F.lit(False)
    if min_value is not None:
        out = out | (num < F.lit(float(min_value)))
    if max_value is not None:
        out = out | (num > F.lit(float(max_value)))
    bad = (F.when(raw.isNull(), F.lit(False))
           .when(num.isNull(), F.lit(True))          # not numeric
           .when(nan, F.lit(False))                  # NaN compares false both ways
           .otherwise(out))
    return Check(f"range_check_{column}", column, bad, severity,
                 "{failed} records have '" + column + "' outside [" + _fmt(min_value) + ", "
                 + _fmt(max_value) + "]")


def rule_check(name: str, violated: Column, severity: str = "MEDIUM",
               column: str | None = None, what: str = "violate") -> Check:
    """A cross-column or contract rule; NULL (rule not applicable) passes."""
    return Check(name, column, F.coalesce(violated, F.lit(False)), severity,
                 "{failed} records " + what + " " + name)


def failure_pct(failed: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(
        F.bround(failed.cast("double") / total.cast("double") * 100.0, 4))


def _sql_str(v) -> str:
    """A Spark SQL string literal (backslash escapes)."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


RESULT_ORDER = [c for c, _ in DQ_RESULT_COLUMNS]


def _result_sql(rule: str, column: str, total: str, failed: str, severity: str, details: str,
                dataset: str, table: str, run_id: str) -> list[str]:
    """dq_results columns (all but ``checked_at``) as SQL expressions over
    the aggregate's columns: one ``selectExpr`` call builds them all."""
    return [
        f"{rule} AS rule_name", f"{_sql_str(dataset)} AS dataset_name",
        f"{_sql_str(table)} AS table_name", f"CAST({column} AS STRING) AS column_name",
        f"CAST({total} AS BIGINT) AS total_records", f"CAST({failed} AS BIGINT) AS failed_records",
        f"{severity} AS severity",
        f"CASE WHEN {failed} = 0 THEN 'PASSED' ELSE 'FAILED' END AS status",
        f"{_sql_str(run_id)} AS pipeline_run_id",
        f"CASE WHEN {failed} > 0 THEN {details} ELSE '' END AS error_details",
        f"CASE WHEN {total} = 0 THEN 0.0D ELSE bround(CAST({failed} AS DOUBLE) / "
        f"CAST({total} AS DOUBLE) * 100.0D, 4) END AS failure_pct",
    ]


def to_results(agg: DataFrame, rule: str, column: str, total: str, failed: str, severity: str,
               details: str, dataset: str, table: str, run_id: str, checked_at: Column) -> DataFrame:
    out = agg.selectExpr(*_result_sql(rule, column, total, failed, severity, details, dataset,
                                      table, run_id))
    return out.withColumn("checked_at", checked_at).select(*RESULT_ORDER)


def _result_cols(rule, column, total, failed, severity, details, dataset, table, run_id, checked_at):
    status = F.when(failed == 0, F.lit("PASSED")).otherwise(F.lit("FAILED"))
    return [
        rule.alias("rule_name"), F.lit(dataset).alias("dataset_name"), F.lit(table).alias("table_name"),
        column.alias("column_name"), total.cast("bigint").alias("total_records"),
        failed.cast("bigint").alias("failed_records"), severity.alias("severity"), status.alias("status"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.when(failed > 0, details).otherwise(F.lit("")).alias("error_details"),
        checked_at.alias("checked_at"), failure_pct(failed, total).alias("failure_pct"),
    ]


def run_checks(df: DataFrame, checks: list[Check], dataset: str, table: str, run_id: str,
               checked_at: Column | None = None) -> DataFrame:
    """All row-level checks of one table in one aggregate -> dq_results rows."""
    checked_at = checked_at if checked_at is not None else F.current_timestamp()
    aggs = [F.count("*").alias("_total")]
    aggs += [F.count_if(c.failed).alias(f"_f{i}") for i, c in enumerate(checks)]
    one = df.agg(*aggs)
    entries = ", ".join(
        f"named_struct('rule', {_sql_str(c.rule_name)}, 'column', "
        f"{'CAST(NULL AS STRING)' if c.column_name is None else _sql_str(c.column_name)}, "
        f"'failed', _f{i}, 'severity', {_sql_str(c.severity)}, 'details', {_sql_str(c.details)})"
        for i, c in enumerate(checks))
    rows = one.selectExpr("_total", f"inline(array({entries}))")
    details = "replace(details, '{failed}', CAST(failed AS STRING))"
    return to_results(rows, "rule", "`column`", "_total", "failed", "severity", details, dataset,
                      table, run_id, checked_at)


def duplicate_check(df: DataFrame, keys: list[str], dataset: str, table: str, run_id: str,
                    severity: str = "HIGH", checked_at: Column | None = None) -> DataFrame:
    """One group-by on the key (partial counts map-side), then a
    one-row roll-up. A key holding a third of the rows is one partial count
    per map task, never a third of the rows in one reducer."""
    checked_at = checked_at if checked_at is not None else F.current_timestamp()
    per_key = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count("*").alias("n"))
    one = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                      F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("failed"),
                      F.count_if(F.col("n") > 1).alias("dup_keys"))
    return to_results(one, _sql_str("duplicate_check_" + "_".join(keys)), _sql_str(",".join(keys)),
                      "total", "failed", _sql_str(severity),
                      "concat(CAST(dup_keys AS STRING), ' duplicate keys found')", dataset, table,
                      run_id, checked_at)


class CriticalQualityError(RuntimeError):
    pass


def halt_on_critical(results: DataFrame) -> DataFrame:
    """C5 circuit breaker: raise when any CRITICAL check FAILED.

    The result frame is one row per check (small by construction), so only
    the offending rows come back to the driver.
    """
    bad = (results.filter((F.col("severity") == "CRITICAL") & (F.col("status") == "FAILED"))
           .select("rule_name", "dataset_name", "table_name", "failed_records", "total_records",
                   "failure_pct").collect())
    if bad:
        r = bad[0]
        raise CriticalQualityError(
            f"CRITICAL quality check failed: {r.rule_name} on {r.dataset_name}.{r.table_name} "
            f"({r.failed_records}/{r.total_records} records, {r.failure_pct}%)")
    return results


__all__ = ["Check", "null_check", "range_check", "rule_check", "run_checks", "duplicate_check",
           "failure_pct", "halt_on_critical", "CriticalQualityError",
           "DQ_RESULT_COLUMNS", "SEVERITIES", "STATUSES"]
