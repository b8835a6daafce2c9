"""Bronze landing and loading.

Landing layout is Hive style, ``<root>/<entity>/dt=<date>/part-*``; ``dt``
comes back as a partition column, so loading one date prunes every other
directory at listing time.

Loads read with an explicit schema (no inference pass), add the ingest
metadata columns, count the rows of *this* load with ``observe`` (no
second scan), and append to Parquet partitioned by ``_ingestion_date``.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import record_hash
from .tables import read_if_exists

FORMATS = ("json", "csv", "parquet")


def land(df: DataFrame, root: str, entity: str, fmt: str = "json", dt_col: str = "dt",
         mode: str = "append") -> str:
    """Write an entity in one of three formats, partitioned by ``dt``."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    path = f"{root.rstrip('/')}/{entity}"
    w = df.write.mode(mode).partitionBy(dt_col)
    if fmt == "csv":
        w = w.option("header", "true")
    getattr(w, fmt)(path)
    return path


def read_landed(spark: SparkSession, root: str, entity: str, schema: T.StructType,
                fmt: str = "json", dt: str | None = None, mode: str = "PERMISSIVE",
                corrupt_col: str = "_corrupt_record", paths: list[str] | None = None) -> DataFrame:
    """Explicit-schema read of one date (or all dates), or of the
    files ``paths`` alone.

    ``PERMISSIVE`` keeps malformed lines in ``corrupt_col`` (route them to
    quarantine with ``split_corrupt``); ``FAILFAST`` aborts on the first
    one, as the reference's whole-file-set rejection does."""
    path = f"{root.rstrip('/')}/{entity}"
    fields = list(schema.fields)
    if fmt in ("json", "csv") and mode == "PERMISSIVE":
        fields.append(T.StructField(corrupt_col, T.StringType()))
    if not any(f.name == "dt" for f in fields):
        fields.append(T.StructField("dt", T.DateType()))
    reader = spark.read.schema(T.StructType(fields)).option("mode", mode)
    if fmt in ("json", "csv"):
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    if fmt == "csv":
        reader = reader.option("header", "true")
    df = getattr(reader.option("basePath", path), fmt)(paths or path)
    if dt is not None:
        df = df.filter(F.col("dt") == F.lit(dt).cast("date"))  # partition pruning
    return df


def split_corrupt(df: DataFrame, corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` of a PERMISSIVE read.

    Quarantine rows keep every column (mostly NULL for a malformed line)
    plus ``payload`` and ``_validation_errors``. Spark refuses a JSON/CSV
    scan that reads *only* the corrupt-record column, so neither side is
    ever narrowed to it; count good rows through a written table or
    ``observe``, not through ``count()`` on the raw read."""
    if corrupt_col not in df.columns:
        return df, df.limit(0)
    bad = F.col(corrupt_col).isNotNull()
    data = [c for c in df.columns if c != corrupt_col]
    quarantine = df.filter(bad).select(
        F.col(corrupt_col).alias("payload"), *data,
        F.array(F.lit("malformed record")).alias("_validation_errors"))
    return df.filter(~bad).drop(corrupt_col), quarantine


def with_ingest_metadata(df: DataFrame, run_id: str, ingestion_ts: Column | None = None,
                         hash_exclude: tuple[str, ...] = ("dt",)) -> DataFrame:
    """``_ingestion_ts``, ``_pipeline_run_id``, ``_source_file``,
    ``_record_hash``; ``_ingestion_date`` is the landing ``dt``."""
    ts = ingestion_ts if ingestion_ts is not None else F.current_timestamp()
    out = df.withColumn("_record_hash", record_hash(df, exclude=hash_exclude))
    return (out.withColumn("_ingestion_ts", ts)
            .withColumn("_pipeline_run_id", F.lit(run_id))
            .withColumn("_source_file", F.col("_metadata.file_path"))
            .withColumn("_source_mtime", F.col("_metadata.file_modification_time"))
            .withColumn("_ingestion_date", F.col("dt")))


def append_bronze(df: DataFrame, bronze_root: str, entity: str) -> Observation:
    """Append partitioned by ``_ingestion_date``; the Observation
    holds the row count of this load, gathered during the write itself."""
    obs = Observation(f"load_{entity}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("append").partitionBy("_ingestion_date").parquet(f"{bronze_root}/{entity}"))
    return obs


def unseen_files(listing: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """The files of ``listing`` (see :func:`list_files`) that are not in
    the manifest, by path and modification time. Only names meet in the join;
    the loader then opens the remaining files and no others."""
    if manifest is None:
        return listing
    return listing.join(manifest.select("_source_file", "_source_mtime"),
                        ["_source_file", "_source_mtime"], "left_anti")


def paths_of(files: DataFrame) -> list[str]:
    """Paths for a reader: one name for each file of an increment."""
    return [r[0] for r in files.select("_source_file").collect()]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``path`` (recursively, partition folders included) as
    ``_source_file, _source_mtime, _source_bytes``. The ``binaryFile``
    source reads file content only when ``content`` is selected, so this
    is a distributed listing, not a data scan."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "[!_.]*").load(path))
    return files.select(F.col("path").alias("_source_file"),
                        F.col("modificationTime").alias("_source_mtime"),
                        F.col("length").alias("_source_bytes"))


def table_metadata(spark: SparkSession, root: str, table: str, partition_col: str) -> DataFrame:
    """One row per table: row_count, n_files, n_partitions, size_bytes and
    last_modified. Counts come from Parquet footers (the scan reads no column),
    sizes and times from a distributed listing."""
    path = f"{root.rstrip('/')}/{table}"
    per_part = spark.read.parquet(path).groupBy(partition_col).agg(F.count("*").alias("n"))
    rows = per_part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("n_partitions"))
    files = list_files(spark, path).agg(F.count("*").alias("n_files"), F.coalesce(F.sum("_source_bytes"), F.lit(0)).alias("size_bytes"),
                                        F.max("_source_mtime").alias("last_modified"))
    key = F.lit(table).alias("table_name")
    return rows.select(key, "*").join(files.select(key, "*"), "table_name")


def manifest_entries(files: DataFrame, run_id: str) -> DataFrame:
    """New manifest rows: the files of this load (from ``list_files``)."""
    return files.select("_source_file", "_source_mtime", "_source_bytes",
                        F.lit(run_id).alias("_pipeline_run_id"))


def force_reload(manifest: DataFrame, path_like: str) -> DataFrame:
    """Drop manifest entries whose path matches, so the next load
    takes those files again (silver upsert keeps the result idempotent)."""
    return manifest.filter(~F.col("_source_file").like(path_like))


def audit_row(spark: SparkSession, run_id: str, entity: str, status: str, rows: int | None,
              started_at: _dt.datetime, finished_at: _dt.datetime, error: str | None = None,
              rejected: int | None = None) -> DataFrame:
    """One audit row per load step (a driver-side scalar, never data)."""
    schema = ("run_id string, entity string, status string, rows_loaded bigint, rows_rejected bigint, "
              "started_at timestamp, finished_at timestamp, duration_s double, error string")
    return spark.createDataFrame(
        [(run_id, entity, status, rows, rejected, started_at, finished_at,
          (finished_at - started_at).total_seconds(), error)], schema)


FILES_PER_LOAD = 10_000  # names that one load hands to the reader through the driver


def _committed(spark: SparkSession, manifest: str, entity: str) -> DataFrame | None:
    found = read_if_exists(spark.read.parquet, manifest)
    return None if found is None else found.where(F.col("entity") == entity)


def committed_bronze(spark: SparkSession, bronze_root: str, entity: str, manifest: str) -> DataFrame | None:
    """Bronze rows of committed loads. Rows that a load wrote before it died,
    without its commit, are not among them: the next run loads their files."""
    rows = read_if_exists(spark.read.parquet, f"{bronze_root}/{entity}")
    loads = _committed(spark, manifest, entity)
    if rows is None or loads is None:
        return None
    return rows.join(loads.select("_load_id").distinct(), "_load_id", "left_semi")


def _load(spark, landing_root, bronze_root, entity, schema, run_id, dt, fmt, paths=None, load_id=None) -> tuple[int, int]:
    """One load: good rows to bronze, malformed lines to quarantine; their counts."""
    df = read_landed(spark, landing_root, entity, schema, fmt=fmt, dt=dt, paths=paths)
    good, bad = split_corrupt(df)
    rejected = 0
    own = {"_load_id": F.lit(load_id)} if load_id else {}
    if "_corrupt_record" in df.columns:
        refused = Observation(f"reject_{entity}")
        (bad.observe(refused, F.count(F.lit(1)).alias("rows"))
         .withColumns({"_pipeline_run_id": F.lit(run_id), "_quarantined_at": F.current_timestamp(), **own})
         .write.mode("append").parquet(f"{bronze_root}/_quarantine/{entity}"))
        rejected = refused.get.get("rows", 0)
    obs = append_bronze(with_ingest_metadata(good, run_id).withColumns(own), bronze_root, entity)
    return obs.get.get("rows", 0), rejected


def load_new_files(spark: SparkSession, landing_root: str, bronze_root: str, entity: str, schema: T.StructType, run_id: str,
                   manifest: str, dt: str | None = None, fmt: str = "json", files_per_load: int = FILES_PER_LOAD) -> tuple[int, int]:
    """Load the files that no committed load has taken, and commit them.

    Files go through in loads of at most ``files_per_load``, so the driver holds
    that many names, not an increment's. Every load writes its rows under an id of
    its own and then one manifest file that names the load and its files: that
    append is the commit, and readers (:func:`committed_bronze`) see rows of
    committed loads only. Whenever a run dies, a file is either in a committed load
    or will be loaded again. Returns rows loaded and rejected."""
    where = f"{landing_root.rstrip('/')}/{entity}" + (f"/dt={dt}" if dt else "")
    loaded = rejected = 0
    while True:
        new = unseen_files(list_files(spark, where), _committed(spark, manifest, entity))
        names = new.orderBy("_source_file").limit(files_per_load).collect()
        if not names:
            return loaded, rejected
        load_id = f"{run_id}-{uuid.uuid4().hex[:12]}"
        good, bad = _load(spark, landing_root, bronze_root, entity, schema, run_id, dt, fmt,
                          paths=[r["_source_file"] for r in names], load_id=load_id)
        taken = spark.createDataFrame(names, new.schema)
        (manifest_entries(taken, run_id).withColumns(
            {"entity": F.lit(entity), "_load_id": F.lit(load_id), "committed_at": F.current_timestamp()})
         .coalesce(1).write.mode("append").parquet(manifest))
        loaded, rejected = loaded + good, rejected + bad


def load_entities(spark: SparkSession, landing_root: str, bronze_root: str,
                  schemas: dict[str, T.StructType], run_id: str, dt: str | None = None,
                  fmt: str = "json", manifest: str | None = None) -> DataFrame:
    """Load every entity; one entity failing is logged in its
    audit row and the others go on. Malformed lines go to
    ``<bronze_root>/_quarantine/<entity>`` and are counted, so that loaded and
    rejected rows add up to the lines landed. With ``manifest`` only files that
    no committed load holds are loaded (S15). Returns the audit rows."""
    audits = []
    for entity, schema in schemas.items():
        started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        try:
            if manifest:
                rows, rejected = load_new_files(spark, landing_root, bronze_root, entity, schema, run_id, manifest, dt, fmt)
            else:
                rows, rejected = _load(spark, landing_root, bronze_root, entity, schema, run_id, dt, fmt)
            status, err = "SUCCESS", None
        except Exception as e:  # per-entity isolation (S4)
            rows, rejected, status, err = None, None, "FAILED", f"{type(e).__name__}: {e}"
        finished = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        audits.append(audit_row(spark, run_id, entity, status, rows, started, finished, err, rejected))
    out = audits[0]
    for a in audits[1:]:
        out = out.unionByName(a)
    return out
