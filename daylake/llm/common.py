"""Column helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.session import new_work_dir

# A word is a run of anything but space and the controls \x09-\x0D.
WORD_GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text, in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def as_row(df: DataFrame) -> DataFrame:
    """The whole input row as one struct column ``row``: operator columns added
    beside it can't clash with any column the caller brings."""
    return df.select(F.struct(*[F.col(_q(c)).alias(c) for c in df.columns]).alias("row"))


def field(name: str) -> Column:
    return F.col("row")[name]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# Rows sent to a Python worker at once, where the session leaves Spark's default: whole texts are large rows.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of whole texts are held by the JVM and by the worker at the same time: keep them to some megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, BATCH_ROWS)


def keep_table(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Write a frame to a new folder below the shared folder and read it again:
    cuts the lineage, and a lost executor costs no recomputation of what is below."""
    path = new_work_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
