"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from goldleaf.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Everything in ASCII that is neither a digit nor a lower-case letter.
WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def saved(df: DataFrame, name: str, compression: str = "none") -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs no recomputation of what went before. Most of these tables are
    narrow ids and hashes that don't compress; tables with texts should name a
    ``compression``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the built-in ``lower``."""
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words_of(lowered: Column) -> Column:
    """Words of an already lower-cased text, without empty ones."""
    return F.array_remove(F.split(lowered, WORD_SEPARATORS), "")


def widened(df: DataFrame, **more: DataType) -> StructType:
    """The schema of ``df`` with more columns at its end."""
    return StructType([*df.schema.fields, *(StructField(k, v) for k, v in more.items())])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: Spark may copy a
    column's expression into every place that names it, lambdas included."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
