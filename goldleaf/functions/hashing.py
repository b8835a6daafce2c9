"""Record hash (H1) and stable surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pipeline metadata fields never part of a business hash.
DEFAULT_HASH_EXCLUDE = (
    "_ingestion_ts", "_pipeline_run_id", "_source_file", "_record_hash",
    "_validation_errors", "_is_late_arrival", "_duplicate_flag",
)


def record_hash(df: DataFrame, exclude: list[str] | tuple[str, ...] = (),
                include: list[str] | None = None) -> Column:
    """32-hex MD5 over the business columns, independent of column order.

    Columns are sorted by name and rendered as JSON with NULLs kept, so a
    changed metadata column leaves the hash alone and any business change
    moves it. Byte equality with a Python ``json.dumps`` hash is not a goal.
    """
    skip = set(DEFAULT_HASH_EXCLUDE) | set(exclude)
    names = sorted(include if include is not None else [c for c in df.columns if c not in skip])
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]),
                           {"ignoreNullFields": "false"}))


def concat_hash(cols: list[str]) -> Column:
    """md5 of the columns as text, each with its length before it and ``N`` for
    NULL, so a value that moves to the next column changes the digest."""
    parts = [F.col(f"`{c}`").cast("string") for c in cols]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.char_length(p).cast("string"), F.lit(":"), p), F.lit("N"))
                            for p in parts]))


def surrogate_key(key_cols: list[str], version_col: str) -> Column:
    """deterministic version key; unlike ``uuid()`` it survives recompute."""
    return concat_hash(list(key_cols) + [version_col])
