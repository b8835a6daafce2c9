"""Silver models: typed projection -> latest row per key -> upsert (M1).

One function builds any of the seven silver tables; the entity decides the
key, the type list and the recency order (W1). NULL-key rows are routed to
quarantine with a reason instead of being re-inserted on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import typed_select
from ..operators.dedup import latest_per_key
from ..operators.merge import upsert
from ..schemas import PRIMARY_KEYS, SILVER_COLUMNS

# Recency order per entity. The reference orders by
# updated_at / snapshot_date / ingestion_timestamp DESC; order_items by
# order_id, which says nothing about recency, so the landing's ship date
# (``_shipdate``) leads there. A full tie-break follows in every case.
RECENCY: dict[str, list[str]] = {
    "customers": ["updated_at"],
    "products": ["updated_at"],
    "campaigns": ["updated_at"],
    "orders": ["updated_at"],
    "inventory": ["snapshot_date"],
    "clickstream_events": ["ingestion_timestamp"],
    "order_items": ["_shipdate"],
}

# Extra landing columns carried into the dedup order.
ORDER_ITEM_LANDING = ["_shipdate", "_suppkey", "_tax", "_linestatus"]


# Ingest metadata column: the time a row was loaded into bronze.
LOAD_TS = "_ingestion_ts"
# Ingest metadata silver keeps when bronze has it (S21);
# ``_record_hash`` also guards the MERGE (M6: unchanged rows are not rewritten).
METADATA = ["_ingestion_ts", "_pipeline_run_id", "_source_file", "_record_hash"]
HASH = "_record_hash"


def tiebreak_columns(entity: str, extra: list[str]) -> list[str]:
    """Every non-key column, then the landing extras, all DESC NULLS LAST."""
    keys = PRIMARY_KEYS[entity]
    return ([c for c, _ in SILVER_COLUMNS[entity] if c not in keys]
            + [c for c in extra if c not in RECENCY[entity] and c != LOAD_TS])


def supported_version(version: Column, current: str) -> Column:
    """Whether rows of ``version`` meet the contract of version ``current``."""
    major = current.split(".")[0]
    return version.isNull() | version.rlike(rf"^{major}(\.\d+)*$")


def silver_model(bronze: DataFrame, entity: str, target: DataFrame | None = None,
                 on_error: str = "fail", with_action: bool = False,
                 accept_versions: list[str] | None = None, current_version: str | None = None,
                 null_keys_too: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return ``(silver, quarantine)`` for one entity.

    ``quarantine`` holds NULL-key rows (and, with ``on_error="quarantine"``,
    rows whose values do not cast), each with ``_validation_errors``.
    ``accept_versions`` (C13): rows of any other ``_schema_version`` are
    quarantined at silver; bronze keeps every version. ``current_version``
    states the contract instead: every version of the same major number is
    taken (a minor version only adds nullable fields), as are rows that carry no
    version; another major number, or text that is no version, is quarantined.
    ``null_keys_too`` (C14: that switch off) keeps NULL-key rows in silver, where
    they match nothing. With ``on_error="null"`` (the schema switch off) a value
    that does not cast becomes NULL and its row stays.
    """
    version_bad = None
    if accept_versions is not None or current_version is not None:
        if accept_versions is not None:
            ok = F.coalesce(F.col("_schema_version").isin(*accept_versions), F.lit(False))
        else:
            ok = supported_version(F.col("_schema_version"), current_version)
        version_bad = bronze.filter(~ok)
        bronze = bronze.filter(ok)
    keys = PRIMARY_KEYS[entity]
    columns = SILVER_COLUMNS[entity]
    extra = [c for c in bronze.columns if c.startswith("_") and c != "_schema_version"]
    extra = [c for c in extra if c in RECENCY[entity] or c in ORDER_ITEM_LANDING or c in METADATA]
    meta = [c for c in METADATA if c in extra]
    if on_error == "quarantine":
        typed, bad_cast = typed_select(bronze, columns, on_error="quarantine", keep=extra)
    else:
        typed, bad_cast = typed_select(bronze, columns, on_error=on_error, keep=extra), None
    # recency columns the landing has, then the load time (newest load wins)
    recency = [c for c in RECENCY[entity] if c in typed.columns]
    if LOAD_TS in extra:
        recency.append(LOAD_TS)
    order: list[Column] = [F.col(c).desc_nulls_last() for c in recency]
    tiebreak = tiebreak_columns(entity, extra)
    latest, null_keys = latest_per_key(typed, keys, order, tiebreak=tiebreak)
    helpers = [c for c in extra if c not in meta]
    latest = latest.drop(*helpers)
    if null_keys_too:
        latest, null_keys = latest.unionByName(null_keys.drop(*helpers)), null_keys.limit(0)
    quarantine = null_keys.drop(*helpers).withColumn(
        "_validation_errors", F.array(F.lit("null primary key " + ",".join(keys))))
    if bad_cast is not None:
        quarantine = quarantine.unionByName(bad_cast.drop(*helpers))
    if version_bad is not None:
        vq = typed_select(version_bad, columns, on_error="quarantine", keep=meta)
        vq = vq[0].unionByName(vq[1].drop("_validation_errors")).withColumn(
            "_validation_errors", F.array(F.lit("unsupported schema version")))
        quarantine = quarantine.unionByName(vq)
    # a silver target never holds NULL keys (they go to quarantine), and
    # ``latest`` has none: join on the key alone, reusing the window's shuffle
    guard = HASH if (target is not None and HASH in target.columns and HASH in meta) else None
    silver = latest if target is None else upsert(target, latest, keys, with_action=with_action,
                                                  keys_not_null=not null_keys_too, unique_source=True,
                                                  hash_col=guard)
    return silver, quarantine
