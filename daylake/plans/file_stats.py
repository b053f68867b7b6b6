"""Statistics of the raw day files: one row per file, written once, merged when asked.

A row holds the file's row count and, for each catalog column after typing, the NULL count, the typed
smallest and largest value, the mean and squared deviations, a HyperLogLog sketch of the values and, for numbers, a
KLL sketch of the distribution.  All of these merge, so a profile of any set of days (``SUMMARIZE``, object context,
columns no row fills) is read from these few rows, and the typed bounds serve as a zone map that picks the
files a filter can meet: typing a string cell is a cast, which Parquet's own bounds on text can't follow.

``refresh`` looks only at files it has no row for.  A day that is loaded anew has new files; rows of files that
are gone are left out by the join with the present listing, so no answer is stale.  The layout below the lake is
``stats/<source>/``, Parquet, appended to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.functions.typing import typed_projection
from daylake.operators.profile import first_date_like
from daylake.sinks import fs
from daylake.sources.catalog import Catalog, working_name
from daylake.sources.raw import DAY, list_day_files, scan_files, scan_raw

# Size of a KLL sketch: quartiles lie within half a percent by rank.
KLL_K = 800
# Files named one by one to a scan; a filter that meets more reads their days instead.
MAX_FILES = 20_000
# New files that are told to the tasks by a broadcast; more meet the rows by a shuffle join.
BROADCAST_FILES = 100_000


def stats_dir(lake: str, source: str) -> str:
    return f"{lake.rstrip('/')}/stats/{source}"


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType))


def _whole(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.scale == 0)


def _value(v, kind: T.DataType) -> Column:
    """A value as a column of a type; whole numbers go as text, since they may not fit a long."""
    return F.lit(str(v) if isinstance(v, int) and not isinstance(v, bool) else v).cast(kind)


def _measures(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    parts = [F.count(c).alias("held")]
    if _whole(kind):
        # Values whose cell is not the number's own text ("007", " 7", "7.0").
        parts.append(F.count_if(c.isNotNull() & (F.col(f"`_raw_{name}`") != c.cast("string"))).alias("odd"))
    if _orderable(kind):
        parts += [F.min(c).alias("min"), F.max(c).alias("max"), F.hll_sketch_agg(c.cast("string")).alias("hll")]
    if isinstance(kind, T.NumericType):
        d = c.cast("double")
        parts += [F.avg(d).alias("mean"), (F.var_pop(d) * F.count(d)).alias("m2"), F.kll_sketch_agg_double(d, KLL_K).alias("kll")]
    return F.struct(*parts).alias(name)


def _struct(catalog: Catalog, source: str) -> T.StructType:
    fields = [T.StructField("file", T.StringType()), T.StructField(DAY, T.DateType()), T.StructField("n", T.LongType())]
    for f in catalog.typed_schema(source).fields:
        parts = [T.StructField("held", T.LongType())]
        if _whole(f.dataType):
            parts.append(T.StructField("odd", T.LongType()))
        if _orderable(f.dataType):
            parts += [T.StructField("min", f.dataType), T.StructField("max", f.dataType), T.StructField("hll", T.BinaryType())]
        if isinstance(f.dataType, T.NumericType):
            parts += [T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType()), T.StructField("kll", T.BinaryType())]
        fields.append(T.StructField(f.name, T.StructType(parts)))
    return T.StructType(fields)


def _written(spark: SparkSession, lake: str, catalog: Catalog, source: str) -> DataFrame:
    schema = _struct(catalog, source)
    if not fs.exists(spark, stats_dir(lake, source)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(stats_dir(lake, source))


def refresh(spark: SparkSession, lake: str, catalog: Catalog, source: str, d1=None, d2=None) -> int:
    """Write rows for the day files that have none; returns how many.  One scan of these files."""
    files = list_day_files(spark, lake, source, d1, d2).select(F.col("path").alias("file"), DAY)
    new = files.join(_written(spark, lake, catalog, source).select("file"), "file", "left_anti")
    n = new.count()
    if not n:
        return 0
    kinds = catalog.typed_schema(source).fields
    whole = [f.name for f in kinds if _whole(f.dataType)]
    raw = scan_raw(spark, lake, catalog, source, file_col="_file")
    raw = raw.withColumns({f"_raw_{c}": F.col(f"`{c}`") for c in whole})
    # Lists are only counted.
    typed = typed_projection(raw, catalog, source, keep=(DAY, "_file", *[f"_raw_{c}" for c in whole]), lists=False)
    told = new.select(F.col("file").alias("_file"), DAY)
    # The day in the join prunes folders; files without a row (empty days) are added after it.
    rows = typed.join(F.broadcast(told) if n <= BROADCAST_FILES else told, ["_file", DAY], "left_semi")
    made = rows.groupBy(F.col("_file").alias("file"), DAY).agg(F.count(F.lit(1)).alias("n"), *[_measures(f.name, f.dataType) for f in kinds])
    made = new.join(made.drop(DAY), "file", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    made.write.mode("append").parquet(stats_dir(lake, source))
    return n


def file_stats(spark: SparkSession, lake: str, catalog: Catalog, source: str, d1=None, d2=None,
               parts: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per present day file.  Files without statistics have ``n`` NULL; two appends of one file count once.

    ``parts``: the measures asked of each column (``{column: (measure, ...)}``); the others, above all the sketches, are
    neither read nor moved.
    """
    files = list_day_files(spark, lake, source, d1, d2).select(F.col("path").alias("file"))
    written = _written(spark, lake, catalog, source)
    if parts is not None:
        asked = [F.struct(*[F.col(f"`{c}`")[p].alias(p) for p in ps]).alias(c) for c, ps in parts.items()]
        written = written.select("file", DAY, "n", *asked)
    return files.join(written.dropDuplicates(["file"]), "file", "left")


def _complete(spark: SparkSession, lake: str, catalog: Catalog, source: str, d1, d2, parts=None) -> DataFrame:
    refresh(spark, lake, catalog, source, d1, d2)
    return file_stats(spark, lake, catalog, source, d1, d2, parts)


def summarize_merged(spark: SparkSession, lake: str, catalog: Catalog, source: str, d1=None, d2=None) -> DataFrame:
    """E9 from the files' statistics: the columns of ``profile.summarize``; no raw day is read that has its row.

    Count, NULL share, min and max are exact; the distinct count is within about 2 % (HyperLogLog, 4096 registers), quartiles
    within half a percent by rank (KLL), mean and deviation exact but for rounding.
    """
    stats = _complete(spark, lake, catalog, source, d1, d2)
    kinds = catalog.typed_schema(source).fields
    numeric = [f.name for f in kinds if isinstance(f.dataType, T.NumericType)]
    means = stats.agg(*[(F.sum(F.col(f"`{c}`.mean") * F.col(f"`{c}`.held")) / F.sum(f"`{c}`.held")).alias(f"m{i}") for i, c in enumerate(numeric)], F.lit(1)).first()
    aggs = []
    for i, f in enumerate(kinds):
        c = f"`{f.name}`."
        parts = {"held": F.coalesce(F.sum(c + "held"), F.lit(0))}
        if _orderable(f.dataType):
            parts |= {"min": F.min(c + "min").cast("string"), "max": F.max(c + "max").cast("string"), "hll": F.hll_union_agg(c + "hll")}
        else:
            parts |= {"min": F.lit(None).cast("string"), "max": F.lit(None).cast("string"), "hll": F.lit(None).cast("binary")}
        if f.name in numeric:
            mean = means[numeric.index(f.name)]
            off = F.col(c + "mean") - F.lit(mean)
            parts |= {"mean": F.lit(mean).cast("double"), "m2": F.sum(F.col(c + "m2") + F.col(c + "held") * off * off),
                      "kll": F.kll_merge_agg_double(F.when(F.col(c + "held") > 0, F.col(c + "kll")))}
        else:
            parts |= {"mean": F.lit(None).cast("double"), "m2": F.lit(None).cast("double"), "kll": F.lit(None).cast("binary")}
        aggs.append(F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"), F.lit(working_name(f.dataType)).alias("column_type"),
                             *[v.alias(k) for k, v in parts.items()]).alias(f"c{i}"))
    one = stats.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *aggs)
    out = one.select("n", F.inline(F.array(*[F.col(f"c{i}") for i in range(len(kinds))])))
    some = F.col("held") > 0

    def quantile(rank: float) -> Column:
        return F.when(some & F.col("kll").isNotNull(), F.kll_sketch_get_quantile_double("kll", F.lit(rank)))

    return out.orderBy("ordinal").select(
        "column_name", "column_type", "min", "max",
        F.when(F.col("hll").isNotNull(), F.hll_sketch_estimate("hll")).alias("approx_unique"),
        F.when(some, F.col("mean")).alias("avg"),
        F.when(F.col("held") > 1, F.sqrt(F.col("m2") / (F.col("held") - 1))).alias("std"),
        quantile(0.25).alias("q25"), quantile(0.5).alias("q50"), quantile(0.75).alias("q75"),
        F.col("n").alias("count"),
        F.when(F.col("n") > 0, F.round((F.col("n") - F.col("held")) * 100.0 / F.col("n"), 2)).otherwise(F.lit(0.0)).alias("null_percentage"))


def context_merged(spark: SparkSession, lake: str, catalog: Catalog, sources) -> DataFrame:
    """L4 (E5, E6) from the files' statistics: row count and range of the first date-like column of each source."""
    out = None
    for s in sorted(sources):
        col = first_date_like(spark.createDataFrame([], catalog.typed_schema(s)))
        stats = _complete(spark, lake, catalog, s, None, None, {col: ("min", "max")} if col else {})
        bounds = [F.min(f"`{col}`.min"), F.max(f"`{col}`.max")] if col else [F.lit(None), F.lit(None)]
        one = stats.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), bounds[0].cast("string").alias("min_value"), bounds[1].cast("string").alias("max_value"))
        one = one.select(F.lit(s).alias("object"), "row_count", F.lit(col).cast("string").alias("date_column"), "min_value", "max_value")
        out = one if out is None else out.unionByName(one)
    return out


def column_counts_merged(spark: SparkSession, lake: str, catalog: Catalog, sources) -> DataFrame:
    """``table_name, column_name, non_null`` of each source from the files' statistics."""
    out = None
    for s in sorted(sources):
        names = [f.storage_name for f in catalog.fields_for(s)]
        stats = _complete(spark, lake, catalog, s, None, None, {c: ("held",) for c in names})
        one = stats.agg(*[F.coalesce(F.sum(f"`{c}`.held"), F.lit(0)).alias(f"c{i}") for i, c in enumerate(names)])
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("non_null")) for i, c in enumerate(names)])
        one = one.select(F.lit(s).alias("table_name"), F.inline(rows))
        out = one if out is None else out.unionByName(one)
    return out


@dataclass(frozen=True)
class Pruned:
    """Typed rows that pass a range filter, and how many of the source's files are read for them."""

    frame: DataFrame
    files: int
    all_files: int


def where_between(spark: SparkSession, lake: str, catalog: Catalog, source: str, column: str, low, high, max_files: int = MAX_FILES) -> Pruned:
    """Rows with ``low <= column <= high`` (typed; None: no bound), read from the files whose bounds meet the range.

    Files without statistics are read.  Above ``max_files`` files the scan is cut to their days; rows are the same.
    """
    kind = catalog.typed_schema(source)[column].dataType
    if not _orderable(kind):
        raise ValueError(f"{column}: {working_name(kind)} has no order")

    def both(lower: Column, upper: Column) -> Column:
        ok = F.lit(True)
        if low is not None:
            ok = ok & (upper >= _value(low, kind))
        if high is not None:
            ok = ok & (lower <= _value(high, kind))
        return ok

    stats = file_stats(spark, lake, catalog, source, parts={column: ("held", "min", "max")})
    meets = F.col("n").isNull() | ((F.col(f"`{column}`.held") > 0) & both(F.col(f"`{column}`.min"), F.col(f"`{column}`.max")))
    total, met = stats.agg(F.count(F.lit(1)), F.count_if(meets)).first()
    if met <= max_files:
        raw = scan_files(spark, lake, catalog, source, [r[0] for r in stats.where(meets).select("file").collect()])
    else:
        raw = scan_raw(spark, lake, catalog, source)
        listed = list_day_files(spark, lake, source).select(F.col("path").alias("file"), DAY)
        raw = raw.join(F.broadcast(listed.join(stats.where(meets).select("file"), "file").select(DAY).distinct()), DAY, "left_semi")
    typed = typed_projection(raw, catalog, source, keep=())
    return Pruned(typed.where(F.col(f"`{column}`").isNotNull() & both(F.col(f"`{column}`"), F.col(f"`{column}`"))), met, total)


# Values looked up one by one; more are joined.
MAX_VALUES = 1_000


def lookup(spark: SparkSession, lake: str, catalog: Catalog, source: str, column: str, values: list, max_files: int = MAX_FILES) -> DataFrame:
    """The typed rows whose ``column`` (whole numbers) is one of a few values.

    The files' bounds choose the files.  In files where every cell is its number's own text the values are asked as text, by
    equalities that reach the Parquet reader, where a column loaded as ``lookup`` has Bloom filters; other files,
    and those without statistics, are filtered after typing.  The rows are the same either way.
    """
    kind = catalog.typed_schema(source)[column].dataType
    if not _whole(kind):
        raise ValueError(f"{column}: only columns of whole numbers are looked up, not {working_name(kind)}")
    values = sorted({int(v) for v in values if v is not None})
    if len(values) > MAX_VALUES:
        raise ValueError(f"{len(values)} values: join them, a lookup takes {MAX_VALUES}")
    none = typed_projection(scan_files(spark, lake, catalog, source, []), catalog, source, keep=())
    if not values:
        return none
    stats = file_stats(spark, lake, catalog, source, parts={column: ("odd", "min", "max")})
    c = F.col(f"`{column}`")
    bounds = F.array(*[_value(v, kind) for v in values])
    meets = F.col("n").isNull() | F.exists(bounds, lambda v: (v >= F.col(f"`{column}`.min")) & (v <= F.col(f"`{column}`.max")))
    plain = F.coalesce(F.col(f"`{column}`.odd") == 0, F.lit(False))
    chosen = stats.where(meets).select("file", plain.alias("plain"))
    by_kind = {r["plain"]: r["n"] for r in chosen.groupBy("plain").agg(F.count(F.lit(1)).alias("n")).collect()}
    typed_in = c.isin([_value(v, kind) for v in values])
    if sum(by_kind.values()) > max_files:
        return typed_projection(scan_raw(spark, lake, catalog, source), catalog, source, keep=()).where(typed_in)
    files = {k: sorted(r[0] for r in chosen.where(F.col("plain") == k).select("file").collect()) for k in by_kind}
    out = none
    if files.get(True):
        # Lists of ten stay lists of equalities on their way to the reader; a longer one becomes a range.
        texts = [str(v) for v in values]
        asked = None
        for i in range(0, len(texts), 10):
            part = c.isin(texts[i : i + 10])
            asked = part if asked is None else asked | part
        # Rows meet one set of all values first: few get as far as the lists.
        asked = c.isin(texts) & asked
        out = typed_projection(scan_files(spark, lake, catalog, source, files[True], asked), catalog, source, keep=())
    if files.get(False):
        rest = typed_projection(scan_files(spark, lake, catalog, source, files[False]), catalog, source, keep=()).where(typed_in)
        out = out.unionByName(rest) if files.get(True) else rest
    return out
