"""Metadata and profile operators: objects (L1), schema (L2/L3, D3), context (L4, E5/E6),
drift (L5) and SUMMARIZE (E9).

Counts and min/max of an object are fused into one aggregate per object;
the column listing comes from DataFrame schemas (no data read) and meets the
catalog meanings by a join with the (small, bounded) catalog frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.sources.catalog import Catalog, working_name

DATE_LIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)


def list_objects(spark: SparkSession) -> DataFrame:
    """L1: registered tables and views, ordered by name."""
    names = sorted({t.name for t in spark.catalog.listTables()})
    return spark.createDataFrame([(n,) for n in names], "table_name string")


def schema_rows(frames: dict[str, DataFrame]) -> list[tuple]:
    return [(name, f.name, i + 1, working_name(f.dataType))
            for name, df in frames.items() for i, f in enumerate(df.schema.fields)]


def schema_listing(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """L2: (table, column, ordinal, type) for every object, ordered."""
    return (spark.createDataFrame(schema_rows(frames), "table_name string, column_name string, "
                                                       "ordinal_position int, data_type string")
            .orderBy("table_name", "ordinal_position"))


def column_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Non-NULL values per column: one aggregate per object, unpivoted to rows."""
    parts = []
    for name, df in sorted(frames.items()):
        cols = [f.name for f in df.schema.fields]
        agg = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("non_null"))
                         for i, c in enumerate(cols)])
        parts.append(agg.select(F.lit(name).alias("table_name"), F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def schema_with_semantics(spark: SparkSession, frames: dict[str, DataFrame],
                          catalog: Catalog) -> DataFrame:
    """L3 + D3: columns left-joined with catalog meanings; empty meaning -> NULL."""
    cat = catalog.to_df(spark).select(F.col("source").alias("table_name"),
                                      F.col("storage_name").alias("column_name"),
                                      F.nullif(F.trim("description"), F.lit("")).alias("semantics"))
    # Broadcast bound: one row per catalog field.
    return (schema_listing(spark, frames)
            .join(F.broadcast(cat), ["table_name", "column_name"], "left")
            .orderBy("table_name", "ordinal_position"))


def object_schema(spark: SparkSession, frames: dict[str, DataFrame], catalog: Catalog,
                  name: str) -> DataFrame:
    """L3 for one object; an unknown name lists the known ones."""
    if name not in frames:
        raise KeyError(f"unknown object {name!r}; known: {sorted(frames)}")
    return schema_with_semantics(spark, {name: frames[name]}, catalog)


def first_date_like(df: DataFrame) -> str | None:
    """First column (by ordinal) of a date/time type or named ``date``."""
    for f in df.schema.fields:
        if isinstance(f.dataType, DATE_LIKE) or f.name == "date":
            return f.name
    return None


def object_profile(name: str, df: DataFrame) -> DataFrame:
    """E5 + E6 in one pass: row count and the text range of the date-like column."""
    col = first_date_like(df)
    if col is None:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("object"), "row_count", F.lit(None).cast("string").alias("date_column"),
            F.lit(None).cast("string").alias("min_value"), F.lit(None).cast("string").alias("max_value"))
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.min(col).cast("string").alias("min_value"),
                  F.max(col).cast("string").alias("max_value")).select(
        F.lit(name).alias("object"), "row_count", F.lit(col).alias("date_column"),
        "min_value", "max_value")


def context_profile(frames: dict[str, DataFrame]) -> DataFrame:
    """L4: one row per object; an empty object has 0 rows and no range."""
    return reduce(DataFrame.unionByName, [object_profile(n, df) for n, df in sorted(frames.items())])


def context_columns(spark: SparkSession, frames: dict[str, DataFrame], catalog: Catalog) -> DataFrame:
    """L4 column part: object, column, type, meaning, joined with the object profile."""
    return schema_with_semantics(spark, frames, catalog).join(
        context_profile(frames).withColumnRenamed("object", "table_name"), "table_name", "left")


def drift_report(spark: SparkSession, frames: dict[str, DataFrame], catalog: Catalog,
                 filled: DataFrame | None = None, names_only: bool = False) -> DataFrame:
    """Both directions between catalogued views and described catalog rows, plus
    catalogued columns that no loaded row fills (NULL everywhere, e.g. a field no
    day's export carries).

    The last are counted in the views, unless ``filled`` (``table_name, column_name, non_null``) tells them, as the day
    files' statistics do without a scan; ``names_only`` leaves them out and reads no data."""
    known = {n: df for n, df in frames.items() if n in catalog.sources()}
    listed = schema_listing(spark, known)
    cat = catalog.to_df(spark).select(F.col("source").alias("table_name"),
                                      F.col("storage_name").alias("column_name"), "description")
    described = cat.where(F.trim(F.coalesce("description", F.lit(""))) != "")
    no_meaning = (listed.join(described, ["table_name", "column_name"], "left_anti")
                  .select("table_name", "column_name", F.lit("column without description").alias("issue")))
    not_in_view = (cat.join(listed, ["table_name", "column_name"], "left_anti")
                   .where(F.col("table_name").isin(list(frames)))
                   .select("table_name", "column_name", F.lit("catalog column not in view").alias("issue")))
    out = no_meaning.unionByName(not_in_view)
    if known and not names_only:
        filled = filled if filled is not None else column_counts(known)
        empty = (filled.where("non_null = 0").where(F.col("table_name").isin(list(known)))
                 .select("table_name", "column_name", F.lit("no value in any row").alias("issue")))
        out = out.unionByName(empty)
    return out.orderBy("table_name", "column_name", "issue")


def summarize(df: DataFrame, exact_only: bool = False) -> DataFrame:
    """E9 (SUMMARIZE): per column name, type, min, max, approx unique, avg, std,
    quartiles, count and null percentage, from ONE aggregate over the data."""
    aggs, specs = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        numeric = isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, T.BooleanType)
        orderable = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        parts = {
            "min": F.min(c).cast("string") if orderable else F.lit(None).cast("string"),
            "max": F.max(c).cast("string") if orderable else F.lit(None).cast("string"),
            "nulls": F.count_if(c.isNull()),
        }
        if not exact_only:
            parts["approx_unique"] = (F.approx_count_distinct(c) if orderable
                                      else F.lit(None).cast("long"))
            parts["avg"] = F.avg(c).cast("double") if numeric else F.lit(None).cast("double")
            parts["std"] = F.stddev(c).cast("double") if numeric else F.lit(None).cast("double")
            q = (F.percentile_approx(c.cast("double"), [0.25, 0.5, 0.75]) if numeric
                 else F.lit(None).cast("array<double>"))
            parts["q"] = q
        aggs.append(F.struct(*[v.alias(k) for k, v in parts.items()]).alias(f"c{i}"))
        specs.append((i, f.name, working_name(f.dataType)))
    one = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("column_name"),
                              F.lit(typ).alias("column_type"), F.col(f"c{i}").alias("s"))
                     for i, name, typ in specs])
    out = one.select("n", F.inline(rows))
    cols = [F.col("column_name"), F.col("column_type"), F.col("s.min").alias("min"),
            F.col("s.max").alias("max")]
    if not exact_only:
        cols += [F.col("s.approx_unique").alias("approx_unique"), F.col("s.avg").alias("avg"),
                 F.col("s.std").alias("std"), F.col("s.q")[0].alias("q25"),
                 F.col("s.q")[1].alias("q50"), F.col("s.q")[2].alias("q75")]
    cols += [F.col("n").alias("count"),
             F.when(F.col("n") > 0, F.round(F.col("s.nulls") * 100.0 / F.col("n"), 2))
             .otherwise(F.lit(0.0)).alias("null_percentage")]
    return out.orderBy("ordinal").select(*cols)
