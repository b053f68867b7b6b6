"""Landing zone: multi-part TSV exports per (source, day), each part with its own header.

Layout: ``<landing>/<source>/load_date=YYYY-MM-DD/<part files>``.

* A3  lines are cut at ``\\n`` only (never at ``\\v``, ``\\f``, U+0085, U+2028),
  trailing ``\\r`` removed, empty lines dropped, the header kept;
* A4  the header of a part is its first non-empty line; all parts of a day must
  share one header;
* A5  cells are ``split(line, '\\t', -1)``: no quoting, no padding, no cutting;
  every row must be as wide as its header;
* E1  rows of a part = non-empty lines - 1 (one header off per part);
* E2  rows of a day = sum over its parts; duplicates are counted and kept.

All of it is one scan plus one hash aggregate whose output has one row per
part file; no data row is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.functions.typing import array_text
from daylake.sinks import fs
from daylake.sources.catalog import Catalog

DAY = "load_date"


def day_in(days, col: str = DAY) -> Column:
    """``load_date IN (...)`` as one parsed expression (prunes day folders).

    Built as SQL text on purpose: one expression instead of one literal object
    per day keeps plan building cheap for thousands of days.
    """
    days = sorted({str(d) for d in days})
    for d in days:
        if len(d) != 10 or d[4] != "-" or d[7] != "-" or not (d[:4] + d[5:7] + d[8:]).isdigit():
            raise ValueError(f"not a day: {d!r}")
    if not days:
        return F.lit(False)
    return F.expr(f"`{col}` IN (" + ", ".join(f"DATE'{d}'" for d in days) + ")")


def source_dir(landing_root: str, source: str) -> str:
    return f"{landing_root.rstrip('/')}/{source}"


def cell_text(c: Column, dt: T.DataType) -> Column:
    """A value as export text: arrays as ``[a,b]`` (strings quoted), NULL as ''."""
    if isinstance(dt, T.ArrayType):
        text = array_text(c, quote=isinstance(dt.elementType, T.StringType))
    elif isinstance(dt, T.BooleanType):
        text = F.when(c, F.lit("1")).when(~c, F.lit("0"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def write_landing(df: DataFrame, landing_root: str, source: str, catalog: Catalog, *,
                  parts_per_day: int = 1, mode: str = "overwrite",
                  native_names: dict | None = None, gathered: bool = False) -> None:
    """Write ``df`` (storage-named columns + ``load_date``) as TSV exports.

    Stands in for the remote export: every part file carries the header of
    native field names, cells are plain text.  ``parts_per_day`` > 1 spreads
    each day over several part files (rows salted by a hash of the row).  ``gathered``: the rows of a day
    are together already.  Parts are gzipped, as text holds much that repeats.
    """
    names = native_names or {f.storage_name: f.native_field for f in catalog.fields_for(source)}
    present = [c for c in df.columns if c in names]
    texts = [cell_text(F.col(c), df.schema[c].dataType).alias(names[c]) for c in present]
    if not gathered:
        # Rows of a day go together (few files per day), but AQE's rebalance splits a
        # hot day over several tasks instead of writing it from one.  Values are moved, not their texts.
        salt = F.pmod(F.xxhash64(*texts), F.lit(parts_per_day)) if parts_per_day > 1 else F.lit(0)
        df = df.withColumn("_part", salt).hint("rebalance", DAY, "_part")
    out = df.select(F.col(DAY).cast("string").alias(DAY), *texts)
    (out.write.mode(mode).partitionBy(DAY)
        .option("partitionOverwriteMode", "dynamic")
        .option("sep", "\t").option("header", True).option("quote", "")
        .option("emptyValue", "").option("nullValue", "").option("compression", "gzip")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(source_dir(landing_root, source)))


def open_parts(spark: SparkSession, landing_root: str, source: str, days=None,
               files: list[str] | None = None) -> DataFrame | None:
    """The part files of some days (default: all), or the files named, as raw lines; None if no day has landed.

    The files are listed here, once: whatever is read from this frame later reads exactly these, so a part that
    lands meanwhile is left.  A few of the landed days are listed by their folders, most of them as a whole.
    """
    root = source_dir(landing_root, source)
    reader = (spark.read.schema(T.StructType([T.StructField("value", T.StringType()),
                                              T.StructField(DAY, T.DateType())]))
              .option("lineSep", "\n").option("basePath", root))
    if files is not None:
        return reader.text(files)
    landed = [n for n in fs.list_children(spark, root) if n.startswith(f"{DAY}=")]
    wanted = sorted({f"{DAY}={d}" for d in days}.intersection(landed)) if days is not None else landed
    if days is not None:
        day_in(days)  # checks the form of the days
    if not wanted:
        return None
    if len(wanted) <= len(landed) // 2:
        return reader.text([f"{root}/{n}" for n in wanted])
    return reader.text(root) if days is None else reader.text(root).where(day_in(days))


def parts_per_day(parts: DataFrame) -> dict[str, int]:
    """How many part files each day has, from the listing that the frame holds (it may list further days)."""
    counts: dict[str, int] = {}
    for path in parts.inputFiles():
        day = path.rpartition(f"/{DAY}=")[2].split("/", 1)[0]
        counts[day] = counts.get(day, 0) + 1
    return counts


def lines_of(parts: DataFrame, ordered: bool = True) -> DataFrame:
    """A3: non-empty lines with their part file; ``ordered`` adds the split's start and an order id inside the split."""
    extra = [F.col("_metadata.file_block_start").alias("blk"), F.monotonically_increasing_id().alias("rid")] if ordered else []
    return (parts.select(
                F.col(DAY),
                F.col("_metadata.file_path").alias("file"), *extra,
                F.expr("trim(TRAILING '\\r' FROM value)").alias("line"))
            .where(F.col("line") != ""))


def scan_lines(spark: SparkSession, landing_root: str, source: str, days=None,
               files: list[str] | None = None, ordered: bool = True) -> DataFrame:
    """:func:`lines_of` the parts that have landed."""
    return lines_of(open_parts(spark, landing_root, source, days, files), ordered)


def tab_count(c: Column) -> Column:
    """Tabs in a line, by the bytes that go with them (no regex engine, no step per character)."""
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit("\t"), F.lit("")))


_BITS = 30
_LOW = (1 << _BITS) - 1


def part_stats(lines: DataFrame) -> DataFrame:
    """A4/A5/E1 per part file, one hash aggregate of fixed-width values (no line is sorted or kept).

    The header is the first non-empty line of the split that starts the file (ids grow in read order
    inside a split); it is told by 60 bits of its hash, each half carried below the line's place, so the least
    value is the first line's.  Width is checked as "every line of the part, header included, has the
    same number of tabs", which equals "every row is as wide as the header".
    """
    tabs = tab_count(F.col("line"))
    place = F.shiftleft(F.col("rid").bitwiseAND((1 << 33) - 1), _BITS)
    hashed = F.xxhash64("line")

    def first(shift: int) -> Column:
        return F.min(F.when(F.col("blk") == 0, place.bitwiseOR(F.shiftrightunsigned(hashed, shift).bitwiseAND(_LOW))))

    return (lines.groupBy(DAY, "file")
            .agg(F.count(F.lit(1)).alias("n_lines"), first(0).alias("low"), first(_BITS).alias("high"),
                 F.min(tabs).alias("min_tabs"), F.max(tabs).alias("max_tabs"),
                 F.bool_and(F.is_valid_utf8("line")).alias("text_ok"))
            .select(DAY, "file", "n_lines",
                    F.shiftleft(F.col("high").bitwiseAND(_LOW), _BITS).bitwiseOR(F.col("low").bitwiseAND(_LOW)).alias("header_key"),
                    F.greatest(F.lit(0), F.col("n_lines") - 1).alias("rows"),
                    (F.col("min_tabs") == F.col("max_tabs")).alias("width_ok"), "text_ok"))


def day_expectations(stats: DataFrame) -> DataFrame:
    """Expected rows per day from the raw text, plus the day-level checks; ``sample``: its shortest part."""
    return (stats.groupBy(DAY)
            .agg(F.count(F.lit(1)).alias("n_parts"), F.sum("rows").alias("expected"),
                 F.count_distinct("header_key").alias("n_headers"),
                 F.min("header_key").alias("header_key"), F.min_by("file", "n_lines").alias("sample"),
                 F.bool_and("width_ok").alias("width_ok"), F.bool_and("text_ok").alias("text_ok")))


def header_texts(spark: SparkSession, landing_root: str, source: str, samples: dict[int, str]) -> dict[int, str]:
    """The header's text for each header key, read from one part that has it."""
    if not samples:
        return {}
    first = F.min(F.struct("rid", "line")).alias("head")
    lines = scan_lines(spark, landing_root, source, files=sorted(set(samples.values()))).where("blk = 0")
    by_file = {r["file"]: r["head"]["line"] for r in lines.groupBy("file").agg(first).collect()}
    return {k: by_file[f] for k, f in samples.items()}


def write_raw_part(spark: SparkSession, landing_root: str, source: str, day: str,
                   lines: list[str]) -> None:
    """Add one part file with the given lines (header included) to a landed day.

    For fault and edge cases (header-only parts, odd rows); appends a file.
    """
    (spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
     .write.mode("append").text(f"{source_dir(landing_root, source)}/{DAY}={day}"))


def cells(line: Column) -> Column:
    """A5: the cells of a line; no quoting, empty cells kept."""
    return F.split(line, "\t", -1)
