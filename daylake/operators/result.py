"""Result handling: limit clamp + page (G1), sample (G2), export (J4), auto-export.

Nothing here pulls a whole result to the driver: a page is ``offset/limit``
on the query, the total is a count job (no column is read), and a large
result goes to files written by the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.functions.typing import array_text
from daylake.functions.encode import csv_header, csv_row, json_ready, json_row, md_cell, md_row
from daylake.session import new_work_dir


# Fixed values of the read channel.
DEFAULT_LIMIT = 100
MAX_LIMIT = 10_000
AUTO_EXPORT_THRESHOLD = 500
DEFAULT_SAMPLE = 5
EXPORT_FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json"}


def clamp_limit(limit) -> int:
    """<=0 or missing -> 100; above 10 000 -> 10 000."""
    try:
        n = int(limit)
    except (TypeError, ValueError):
        return DEFAULT_LIMIT
    if n <= 0:
        return DEFAULT_LIMIT
    return min(n, MAX_LIMIT)


def sample_size(n) -> int:
    """Missing / non-numeric / negative -> 5; 0 -> 1."""
    try:
        k = int(n)
    except (TypeError, ValueError):
        return DEFAULT_SAMPLE
    if k < 0:
        return DEFAULT_SAMPLE
    return max(k, 1)


@dataclass
class Page:
    rows: DataFrame
    total_rows: int
    limit: int
    offset: int

    @property
    def has_more(self) -> bool:
        return self.total_rows > self.offset + self.limit

    @property
    def next_offset(self) -> int | None:
        return self.offset + self.limit if self.has_more else None

    def meta(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.total_rows, self.limit, self.has_more, self.next_offset)],
            "total_rows long, page_limit int, has_more boolean, next_offset int")


def page(df: DataFrame, limit=None, offset: int = 0) -> Page:
    """G1: page ``offset/limit`` of an (ordered) frame plus the total row count."""
    n = clamp_limit(limit)
    total = df.count()
    rows = (df.offset(offset) if offset else df).limit(n)
    return Page(rows, total, n, offset)


@dataclass
class SeekPage:
    rows: DataFrame
    token: str | None  # where the next page begins; None: there is none

    @property
    def has_more(self) -> bool:
        return self.token is not None


def _after(keys: list[str], kinds: dict[str, T.DataType], values: list, orequal: bool = False):
    """Rows that come after ``values`` in ascending order of ``keys`` (NULL first, as Spark orders)."""
    cond = F.lit(orequal)
    for k, v in reversed(list(zip(keys, values))):
        c = F.col(f"`{k}`")
        if v is None:
            cond = c.isNotNull() | cond
        else:
            at = F.lit(v).cast(kinds[k])
            cond = F.coalesce(c > at, F.lit(False)) | (c.eqNullSafe(at) & cond)
    return cond


def _all_pages(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """All pages of ``df`` with their number (``page``), cut as if each was sought by the last key of the one before.

    The rows are laid out once, sorted in ranges of the keys.  Where a page begins depends on how full the ranges before
    left the open page: each range tells this for every filling (``n`` of them) beside the others, the driver only
    follows the ranges.  At most a number per page, and two per range and filling, come to the driver.
    """
    spark = df.sparkSession
    order = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    path = new_work_dir(spark, "pages")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A range is a task here: its number and the row's place in it are the upper and lower bits of the id.
    laid = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    laid.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_id", T.LongType())])).parquet(path)
    rows = rows.withColumn("_range", F.shiftright("_id", 33).cast("int"))
    same_key = rows.groupBy("_range", *[F.col(f"`{k}`") for k in keys]).agg(F.max("_id").alias("_last")).select("_range", "_last")

    def ends(group) -> np.ndarray:
        """Rows of the range up to the end of each key."""
        return np.sort(group["_last"].to_numpy() & ((1 << 33) - 1)) + 1

    def fillings(group):
        e = ends(group)
        full = n - np.arange(n, dtype=np.int64)
        ended = np.zeros(n, dtype=np.int32)
        while (open_ := full <= e[-1]).any():
            full[open_] = e[np.searchsorted(e, full[open_])] + n
            ended[open_] += 1
        left = (e[-1] - (full - n)).astype(np.int32)
        return pd.DataFrame({"_range": [int(group["_range"].iloc[0])], "ended": [ended.tobytes()], "left": [left.tobytes()]})

    told = same_key.groupBy("_range").applyInPandas(fillings, "_range int, ended binary, left binary").collect()
    begun, page, filled = {}, 1, 0
    for r in sorted(told, key=lambda r: r["_range"]):
        begun[r["_range"]] = (page, filled)
        page += int(np.frombuffer(r["ended"], np.int32)[filled])
        filled = int(np.frombuffer(r["left"], np.int32)[filled])

    def cuts(group):
        e, k = ends(group), int(group["_range"].iloc[0])
        full, found = n - begun[k][1], []
        while full <= e[-1]:
            found.append(int(e[np.searchsorted(e, full)]))
            full = found[-1] + n
        return pd.DataFrame({"_range": [k], "cuts": [found]})

    cut_at = {r["_range"]: np.array(r["cuts"], dtype=np.int64)
              for r in same_key.groupBy("_range").applyInPandas(cuts, "_range int, cuts array<long>").collect()}

    @F.pandas_udf("int")
    def page_of(ids: pd.Series) -> pd.Series:
        ids = ids.to_numpy()
        ranges, places = ids >> 33, ids & ((1 << 33) - 1)
        out = np.zeros(len(ids), dtype=np.int32)
        for k in np.unique(ranges):
            mine = ranges == k
            out[mine] = begun[k][0] + np.searchsorted(cut_at[k], places[mine], side="right")
        return pd.Series(out)

    return rows.withColumn("page", page_of("_id")).drop("_id", "_range").orderBy(*order)


def page_after(df: DataFrame, keys: list[str], limit=None, token: str | None = None, all_pages: bool = False) -> SeekPage:
    """G1 by seeking: the page of ``df`` in the order of ``keys`` that begins after ``token`` (of the page before).

    A page costs the same wherever it lies: a filter on the keys (which reaches the files where their types
    allow it) and a top-``limit`` of the keys, in place of an offset that sorts and skips all before it.  Rows added or
    removed on other pages don't shift this one.  Rows equal in all ``keys`` stay on one page, so a
    page holds more than ``limit`` rows where the last of them come again; no row is left out or told twice.

    ``all_pages=True`` gives this page and all after it, in order, with a column ``page`` (1, 2, ...): one sort of the rows in
    place of a scan per page.
    """
    n = clamp_limit(limit)
    kinds = {k: df.schema[k].dataType for k in keys}
    rest = df
    if token is not None:
        rest = df.where(_after(keys, kinds, json.loads(token)))
    if all_pages:
        return SeekPage(_all_pages(rest, keys, n), None)
    # At most the page's keys and one more come to the driver, as text.
    texts = [F.col(f"`{k}`").cast("string").alias(f"k{i}") for i, k in enumerate(keys)]
    order = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    found = [list(r) for r in rest.orderBy(*order).limit(n + 1).select(*texts).collect()]
    last = found[n - 1] if len(found) > n else None
    if last is not None:
        rest = rest.where(~_after(keys, kinds, last))
        if found[n] == last and df.where(_after(keys, kinds, last)).isEmpty():
            last = None
    return SeekPage(rest.orderBy(*order), json.dumps(last) if last is not None else None)


def sample(df: DataFrame, n=None) -> DataFrame:
    """The first N rows in scan order (no order promise)."""
    return df.limit(sample_size(n))


def csv_cell(c, kind: T.DataType):
    """CSV has no list type: lists are written as the list text the typed layer reads.
    Times are written as SQL text (``2024-01-05 10:00:00``), not in the ``T`` form."""
    if isinstance(kind, T.ArrayType):
        return array_text(c, quote=isinstance(kind.elementType, T.StringType))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("string")
    return c


def export(df: DataFrame, path: str, fmt: str | None = None) -> int:
    """Write the result once and count it in the same pass.

    csv (with header), parquet or json (JSON Lines); an existing target is refused.
    """
    if fmt is None:
        ext = "." + path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
        if ext not in EXPORT_FORMATS:
            raise ValueError(f"export target must end in one of {sorted(EXPORT_FORMATS)}: {path}")
        fmt = EXPORT_FORMATS[ext]
    if fmt == "json":
        # Same value rules as the inline JSON: NaN/Inf -> null, date/time -> ISO text.
        df = df.select(*json_ready(df))
    elif fmt == "csv":
        df = df.select(*[csv_cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
    obs = Observation("export")
    counted = df.observe(obs, F.count(F.lit(1)).alias("n"))
    w = counted.write.mode("errorifexists")
    if fmt == "csv":
        # RFC-4180: a quote inside a quoted cell is doubled (Spark's default is a backslash).
        # Cells keep their white space; NULL is nothing, the empty string is "".
        (w.option("header", True).option("escape", '"').option("emptyValue", '""').option("nullValue", "")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    elif fmt == "parquet":
        w.parquet(path)
    elif fmt == "json":
        w.option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")
    return int(obs.get["n"])


@dataclass
class QueryResult:
    mode: str            # "inline" or "file"
    rows: DataFrame | None
    total_rows: int
    path: str | None
    has_more: bool = False
    next_offset: int | None = None


def run_query(df: DataFrame, export_path: str, limit=None) -> QueryResult:
    """More than 500 rows -> file + status; up to 500 -> rows inline (paged by G1).

    The first 501 rows decide.  They are the inline answer when they are 500 or fewer, so
    the query runs once for it; the export counts its rows as it writes them.
    """
    spark = df.sparkSession
    head = df.limit(AUTO_EXPORT_THRESHOLD + 1).collect()
    if len(head) > AUTO_EXPORT_THRESHOLD:
        n = export(df, export_path)
        return QueryResult("file", None, n, export_path)
    pg = Page(spark.createDataFrame(head[: clamp_limit(limit)], df.schema), len(head), clamp_limit(limit), 0)
    return QueryResult("inline", pg.rows, pg.total_rows, None, pg.has_more, pg.next_offset)


def render(df: DataFrame, limit=None, fmt: str = "json") -> str:
    """The inline answer of the read channel for one page (I2/I3/I4 + G1).

    Rows are encoded on the executors; only the page (at most 10 000 rows)
    reaches the driver.  json: a document with ``columns``, ``rows``,
    ``total_rows``, ``limit``, ``has_more``, ``next_offset``; csv: header +
    rows; markdown: a table, or a no-rows note, with a note when cut.
    """
    pg = page(df, limit)
    cols = df.columns
    if fmt == "json":
        rows = [json.loads(r[0]) for r in pg.rows.select(json_row(pg.rows)).collect()]
        return json.dumps({"columns": cols, "rows": rows, "total_rows": pg.total_rows,
                           "limit": pg.limit, "has_more": pg.has_more,
                           "next_offset": pg.next_offset}, ensure_ascii=False, indent=2)
    if fmt == "csv":
        lines = [csv_header(cols)] + [r[0] for r in pg.rows.select(csv_row(pg.rows)).collect()]
        return "\n".join(lines)
    if fmt == "markdown":
        if pg.total_rows == 0:
            return "_no rows_"
        head = pg.rows.sparkSession.createDataFrame([tuple(cols)], [f"c{i}" for i in range(len(cols))])
        header = head.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[md_cell(F.col(c)) for c in head.columns]),
                                      F.lit(" |"))).first()[0]
        lines = [header, "| " + " | ".join(["---"] * len(cols)) + " |"]
        lines += [r[0] for r in pg.rows.select(md_row(pg.rows)).collect()]
        text = "\n".join(lines)
        if pg.has_more:
            text += f"\n\n_... {pg.total_rows - pg.limit} more rows (limit {pg.limit})_"
        return text
    raise ValueError(f"unknown format {fmt!r}; use json, csv or markdown")
