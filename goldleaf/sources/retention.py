"""Retention of append-only tables, table versions and scratch tables.

Only whole folders go, by metadata alone: the file system that Spark reads
through lists and deletes them, no data is read or rewritten. A reader that
opened a folder before keeps working for the grace period that the caller
states: nothing younger than it is deleted, nor is a table's current version.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir
from .tables import _current_name


def _folders(spark: SparkSession, path: str) -> list[tuple[str, _dt.datetime]]:
    """(name, last change) of the folders in ``path``; none if it is missing."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    return [(s.getPath().getName(), _dt.datetime.fromtimestamp(s.getModificationTime() / 1000, _dt.timezone.utc).replace(tzinfo=None))
            for s in fs.listStatus(where) if s.isDirectory()]


def _drop(spark: SparkSession, path: str, names: list[str]) -> list[str]:
    jvm = spark._jvm
    for name in names:
        where = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return names


def expire_partitions(spark: SparkSession, path: str, column: str, as_of: str, days: int = 30) -> list[str]:
    """Delete the folders ``column=<date>`` of an append-only table that are more
    than ``days`` older than ``as_of``; returns their names. Folders whose value
    is no date (the NULL partition among them) stay."""
    cut = _dt.date.fromisoformat(as_of[:10]) - _dt.timedelta(days=days)
    old = []
    for name, _ in _folders(spark, path):
        key, _, value = name.partition("=")
        try:
            if key == column and _dt.date.fromisoformat(value) < cut:
                old.append(name)
        except ValueError:
            continue
    return _drop(spark, path, sorted(old))


def expire_versions(spark: SparkSession, root: str, table: str, keep: int = 2,
                    grace: _dt.timedelta = _dt.timedelta(days=1), now: _dt.datetime | None = None) -> list[str]:
    """Delete versions of a published table that are neither current nor among
    the ``keep`` newest nor younger than ``grace``, debris of failed attempts
    included. Returns the names of what went."""
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    current = _current_name(spark, root, table)
    found = sorted(((int(n[2:].split("-")[0]), n, t) for n, t in _folders(spark, f"{root}/{table}") if n.startswith("v=")), reverse=True)
    old = [n for k, (_, n, t) in enumerate(found) if n != f"v={current}" and k >= keep and now - t > grace]
    return _drop(spark, f"{root}/{table}", old)


def expire_scratch(spark: SparkSession, grace: _dt.timedelta = _dt.timedelta(days=7), now: _dt.datetime | None = None) -> list[str]:
    """Delete intermediate tables under the shared checkpoint folder that no job
    has touched for ``grace``, which must exceed the longest job."""
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/goldleaf"
    return _drop(spark, root, [n for n, t in _folders(spark, root) if now - t > grace])
