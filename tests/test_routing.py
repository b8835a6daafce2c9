"""Routes by severity, table metadata without reading data."""

import pytest
from pyspark.sql import functions as F

from goldleaf.quality.checks import rule_check
from goldleaf.quality.routing import split_by_route, with_routes
from goldleaf.session import scratch_path
from goldleaf.sources.bronze import table_metadata


def checks(*severities):
    return [rule_check(f"r{k}", F.col("n") % k == 0, s) for k, s in zip((2, 3, 5), severities)]


def test_the_gravest_check_decides(spark):
    df = spark.range(1, 31).withColumnRenamed("id", "n")
    got = {r.n: (r._route, r._flags) for r in with_routes(df, checks("LOW", "HIGH", "MEDIUM")).collect()}
    assert got[1] == ("pass", []) and got[2] == ("flag", ["r2"]) and got[30] == ("quarantine", ["r2", "r3", "r5"]) and got[10] == ("flag", ["r2", "r5"])
    kept, refused = split_by_route(df, checks("LOW", "HIGH", "MEDIUM"))
    assert sorted(r.n for r in refused.collect()) == list(range(3, 31, 3))
    assert kept.count() + refused.count() == 30 and {"_flags"} == set(kept.columns) - {"n"}
    kept, refused = split_by_route(df, checks("LOW", "HIGH", "MEDIUM"), quarantine=False)
    assert refused.count() == 0 and kept.where(F.array_contains("_flags", "r3")).count() == 10


def test_critical_ends_the_job_and_null_passes(spark):
    df = spark.createDataFrame([(1,), (None,)], "n int")
    kept, refused = split_by_route(df, checks("CRITICAL", "HIGH", "LOW"))
    assert kept.count() == 2 and refused.count() == 0
    kept, _ = split_by_route(df.union(spark.createDataFrame([(4,)], "n int")), checks("CRITICAL", "HIGH", "LOW"))
    with pytest.raises(Exception, match="CRITICAL check failed: r2"):
        kept.count()


def test_table_metadata_reads_no_column(spark):
    root = scratch_path(spark, "t-meta")
    spark.range(1000).selectExpr("id", "repeat('x', 50) t", "id % 4 p").write.partitionBy("p").parquet(f"{root}/t")
    meta = table_metadata(spark, root, "t", "p")
    r = meta.first()
    assert (r.table_name, r.row_count, r.n_partitions) == ("t", 1000, 4) and r.size_bytes > 1000 and r.n_files >= 4 and r.last_modified
    scan = spark.read.parquet(f"{root}/t").groupBy("p").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in scan
