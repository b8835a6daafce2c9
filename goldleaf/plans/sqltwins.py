"""SQL twins of the library operators, for the DuckDB correctness oracle.

These build plain ANSI SQL text (DuckDB dialect where the two differ) that
computes what the Spark operators compute, independently: the oracle is
the reference's own SQL idiom (ROW_NUMBER, FULL OUTER JOIN MERGE, LEAD),
the Spark side is DataFrame code.
"""

from __future__ import annotations

from ..schemas import PRIMARY_KEYS, SILVER_COLUMNS

_DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE",
               "timestamp": "TIMESTAMP", "double": "DOUBLE"}


def duck_type(t: str) -> str:
    return _DUCK_TYPES.get(t, t.upper())


def typed_sql(entity: str, src: str, keep: list[str] = ()) -> str:
    cols = ", ".join(f"CAST({c} AS {duck_type(t)}) AS {c}" for c, t in SILVER_COLUMNS[entity])
    extra = "".join(f", {k}" for k in keep)
    return f"SELECT {cols}{extra} FROM ({src}) AS b"


def latest_sql(entity: str, src: str, recency: list[str], tiebreak: list[str],
               keep: list[str] = ()) -> str:
    keys = PRIMARY_KEYS[entity]
    cols = ", ".join(c for c, _ in SILVER_COLUMNS[entity])
    order = ", ".join(f"{c} DESC NULLS LAST" for c in list(recency) + list(tiebreak))
    part = ", ".join(keys)
    notnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""SELECT {cols} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {part} ORDER BY {order}) AS row_num
  FROM ({typed_sql(entity, src, keep)}) AS typed WHERE {notnull}
) AS ranked WHERE row_num = 1"""


def upsert_sql(target: str, source: str, cols: list[str], keys: list[str],
               update_cols: list[str] | None = None, insert_cols: list[str] | None = None,
               action: bool = False) -> str:
    update_cols = [c for c in (update_cols if update_cols is not None else cols) if c not in keys]
    insert_cols = list(insert_cols if insert_cols is not None else cols)
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    tnn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    tn = " OR ".join(f"{k} IS NULL" for k in keys)
    out = []
    for c in cols:
        ins = f"s.{c}" if (c in insert_cols or c in keys) else "NULL"
        if c in keys or c not in update_cols:
            out.append(f"CASE WHEN t.t_hit IS NULL THEN {ins} ELSE t.{c} END AS {c}")
        else:
            out.append(f"CASE WHEN t.t_hit IS NULL THEN {ins} WHEN s.s_hit IS NOT NULL THEN s.{c} "
                       f"ELSE t.{c} END AS {c}")
    act = ""
    if action:
        act = (", CASE WHEN t.t_hit IS NULL THEN 'inserted' WHEN s.s_hit IS NOT NULL THEN 'updated' "
               "ELSE 'kept' END AS _merge_action")
    plain = ", ".join(cols)
    ins_null = ", ".join((c if (c in insert_cols or c in keys) else f"NULL AS {c}") for c in cols)
    return f"""SELECT {', '.join(out)}{act}
FROM (SELECT *, TRUE AS t_hit FROM ({target}) AS t0 WHERE {tnn}) AS t
FULL OUTER JOIN (SELECT *, TRUE AS s_hit FROM ({source}) AS s0 WHERE {tnn}) AS s ON {on}
UNION ALL SELECT {plain}{", 'kept'" if action else ''} FROM ({target}) AS tn WHERE {tn}
UNION ALL SELECT {ins_null}{", 'inserted'" if action else ''} FROM ({source}) AS sn WHERE {tn}"""


def checks_sql(src: str, specs: list[tuple[str, str | None, str, str, str]], dataset: str,
               table: str, run_id: str, as_of: str) -> str:
    """dq_results rows for row-level checks: ``specs`` are
    ``(rule_name, column_name, failed_sql, severity, details_template)``."""
    aggs = ", ".join(f"count_if({f}) AS f{i}" for i, (_, _, f, _, _) in enumerate(specs))
    parts = []
    for i, (rule, col, _, sev, det) in enumerate(specs):
        colv = "NULL" if col is None else f"'{col}'"
        pre, post = (x.replace("'", "''") for x in det.split("{failed}"))
        details = f"'{pre}' || CAST(f{i} AS VARCHAR) || '{post}'".replace("'' || ", "")
        parts.append(result_sql(f"'{rule}'", colv, "total", f"f{i}", f"'{sev}'", details,
                                dataset, table, run_id, as_of))
    body = "\nUNION ALL ".join(parts)
    inner = f"WITH agg AS (SELECT count(*) AS total, {aggs} FROM ({src}) AS src)\n" + body.replace(
        "FROM agg_placeholder", "FROM agg")
    return f"SELECT * FROM ({inner}) AS checks"


def result_sql(rule: str, col: str, total: str, failed: str, sev: str, details: str,
               dataset: str, table: str, run_id: str, as_of: str, src: str = "agg_placeholder") -> str:
    return (f"SELECT {rule} AS rule_name, '{dataset}' AS dataset_name, '{table}' AS table_name, "
            f"CAST({col} AS VARCHAR) AS column_name, CAST({total} AS BIGINT) AS total_records, "
            f"CAST({failed} AS BIGINT) AS failed_records, {sev} AS severity, "
            f"CASE WHEN {failed} = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, "
            f"'{run_id}' AS pipeline_run_id, "
            f"CASE WHEN {failed} > 0 THEN {details} ELSE '' END AS error_details, "
            f"TIMESTAMP '{as_of}' AS checked_at, "
            f"CASE WHEN {total} = 0 THEN 0.0 ELSE round_even(CAST({failed} AS DOUBLE) / "
            f"CAST({total} AS DOUBLE) * 100.0, 4) END AS failure_pct FROM {src}")
