"""Local twin of the driver's correctness gate: run a registered query on
Spark and its SQL twin on DuckDB, compare row count, column names and an
order-insensitive hash of the values. Used by tests and by hand."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "T" if v else "F"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def frame_digest(cols: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(lines), h


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run_oracle(con, sql: str):
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from .catalog import ORACLES, QUERIES
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"name": name, "spark_rows": len(s_rows), "spark_cols": sorted(s_cols)}
    if name not in ORACLES:
        out["oracle"] = None
        return out
    con = con or duck_connect(sf_dir)
    o_cols, o_rows = run_oracle(con, ORACLES[name])
    out["oracle_rows"] = len(o_rows)
    out["cols_match"] = sorted(s_cols) == sorted(o_cols)
    out["rows_match"] = len(s_rows) == len(o_rows)
    if out["cols_match"]:
        out["hash_match"] = frame_digest(s_cols, s_rows)[1] == frame_digest(list(o_cols), o_rows)[1]
        if not out["hash_match"]:
            oi = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
            oo = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
            a = {"|".join(_norm(r[i]) for i in oi) for r in s_rows}
            b = {"|".join(_norm(r[i]) for i in oo) for r in o_rows}
            out["only_spark"] = sorted(a - b)[:3]
            out["only_oracle"] = sorted(b - a)[:3]
            out["sorted_cols"] = sorted(s_cols)
    else:
        out["oracle_cols"] = sorted(o_cols)
        out["hash_match"] = False
    return out


def main(argv=None) -> int:
    import json
    import sys

    from ..session import get_session
    from .catalog import QUERIES
    args = list(sys.argv[1:] if argv is None else argv)
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir = args.pop(0)
    names = args or sorted(QUERIES)
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connect(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("hash_match") or (r.get("oracle", 1) is None and "error" not in r)
        bad += 0 if ok else 1
        print(json.dumps(r, default=str), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
