"""Interval join: points to the spans that hold them, as an equality join on buckets of the axis.

Spans are sorted into levels by their length; a level's buckets are as wide as its longest span, so a span touches
two buckets at most, however long it is.  A point looks into one bucket of every level there is.  The
equality on (level, bucket, keys) is what Spark joins by (hash or sort-merge, never a nested loop); the exact
condition filters after it.  A bucket with many points, many spans or both is dealt over a grid of cells: points to rows,
spans to columns, so every pair meets in exactly one cell and no task holds more than about two sides of a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daylake.session import new_work_dir

STEP = 4          # a level's buckets are so many times as wide as those of the level below
CELL_ROWS = 10_000  # points, and spans, of one grid cell


def axis(c: Column, kind: T.DataType) -> Column:
    """The place on the axis as a double; order is kept (times: seconds, without their time zone's jumps)."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c) * F.lit(86_400.0)
    if isinstance(kind, T.TimestampNTZType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")) * F.lit(86_400.0) + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(c).cast("double")
    return c.cast("double")


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    point: str,
    start: str,
    end: str,
    on: list[str] = (),
    closed: bool = True,
    width: float = 1.0,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Rows of ``points`` with the rows of ``spans`` for which ``start <= point <= end`` (``closed=False``: ``< end``).

    ``on`` names key columns that must be equal besides (NULL equals nothing).  ``width`` is the width of
    the narrowest buckets on the axis (seconds for times).  Repeated rows match each.
    A NULL or NaN point or bound, and a span that ends before it starts, match nothing.  Column names of both sides must differ, but for ``on``.
    """
    on = list(on)
    kinds = {**{f.name: f.dataType for f in spans.schema.fields}, **{f.name: f.dataType for f in points.schema.fields}}
    zoned = {isinstance(kinds[c], T.TimestampType) for c in (point, start, end)}
    if len(zoned) > 1:
        raise ValueError("points and bounds must all be times with a zone, or none of them")

    def place(name: str) -> Column:
        return axis(F.col(name), kinds[name])

    length = place(end) - place(start)
    level = F.greatest(F.ceil(F.log(F.greatest(length, F.lit(width)) / F.lit(width)) / F.log(F.lit(float(STEP)))), F.lit(0)).cast("int")

    def wide(lv: Column) -> Column:
        return F.pow(F.lit(float(STEP)), lv) * F.lit(width)

    ordered = (F.col(start) <= F.col(end)) & ~F.isnan(place(start)) & ~F.isnan(place(end))
    spans = spans.where(ordered).withColumn("_level", level)
    first, last = F.floor(place(start) / wide(F.col("_level"))), F.floor(place(end) / wide(F.col("_level")))
    spans = spans.withColumn("_bucket", F.explode(F.sequence(first, last)))
    # At most a few dozen levels exist between the narrowest and the longest span.
    levels = sorted(r[0] for r in spans.select("_level").distinct().collect())
    probes = F.explode(F.array(*[F.lit(lv) for lv in levels]).cast("array<int>"))
    probed = points.where(F.col(point).isNotNull() & ~F.isnan(place(point))).withColumn("_level", probes)
    probed = probed.withColumn("_bucket", F.floor(place(point) / wide(F.col("_level"))))

    # How many cells a bucket needs; only crowded buckets are told.
    at = ["_level", "_bucket", *on]
    rows = probed.groupBy(*at).agg(F.count(F.lit(1)).alias("_p")).join(spans.groupBy(*at).agg(F.count(F.lit(1)).alias("_s")), at)
    crowded = rows.where((F.col("_p") > cell_rows) | (F.col("_s") > cell_rows)).select(
        *at, F.ceil(F.col("_p") / cell_rows).cast("int").alias("_rows"), F.ceil(F.col("_s") / cell_rows).cast("int").alias("_cols")
    )
    probed, spans = (d.join(crowded, at, "left").na.fill(1, ["_rows", "_cols"]) for d in (probed, spans))
    own_row = F.pmod(F.xxhash64(*[F.col(c) for c in points.columns]), F.col("_rows")).cast("int")
    own_col = F.pmod(F.xxhash64(*[F.col(c) for c in spans.columns if not c.startswith("_")]), F.col("_cols")).cast("int")
    each = F.lit(0).cast("int")
    probed = probed.withColumn("_r", own_row).withColumn("_c", F.explode(F.sequence(each, F.col("_cols") - 1))).drop("_rows", "_cols")
    spans = spans.withColumn("_c", own_col).withColumn("_r", F.explode(F.sequence(each, F.col("_rows") - 1))).drop("_rows", "_cols")

    p, s = probed.alias("p"), spans.alias("s")
    same = None
    for c in [*at, "_r", "_c"]:
        eq = F.col(f"p.{c}") == F.col(f"s.{c}")
        same = eq if same is None else same & eq
    inside = F.col(f"s.{start}") <= F.col(f"p.{point}")
    inside = inside & (F.col(f"p.{point}") <= F.col(f"s.{end}") if closed else F.col(f"p.{point}") < F.col(f"s.{end}"))
    joined = p.join(s, same & inside, "inner")
    return joined.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"s.{c}") for c in spans.columns if c not in on and not c.startswith("_")])


def interval_totals(
    points: DataFrame,
    spans: DataFrame,
    point: str,
    start: str,
    end: str,
    by: list[str],
    apart: tuple[str, str],
    value: str,
    ident: str,
    width: float = 1.0,
) -> DataFrame:
    """For each span the points of :func:`interval_join` (closed) whose key differs from its own, as totals: ``by``, ``n`` (points),
    ``total`` (sum of ``value``), ``first`` and ``last`` (least and largest ``ident``).  Spans without such a point are left out.

    ``by`` names the columns that identify a span, ``apart`` the key of points and spans (NULL differs from nothing).
    The pairs are never made, since these grow with the square of the rows.  Points are numbered along the axis (by time and
    key, in cells of ``width``), so a span is a run of numbers, and those of its own key cut it into pieces.  Totals
    are kept for each aligned block of 1, 2, 4, ... numbers; a piece is the sum of the few blocks that fill it.
    """
    kinds = {f.name: f.dataType for f in points.schema.fields}
    spark = points.sparkSession
    key, own = apart

    def cell(c: str) -> Column:
        return F.floor(axis(F.col(c), kinds[point]) / F.lit(width)).cast("long")

    known = points.where(F.col(point).isNotNull() & ~F.isnan(axis(F.col(point), kinds[point])) & F.col(key).isNotNull())
    leaves = known.groupBy(F.col(point).alias("t"), F.col(key).alias("who")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(ident).alias("first"), F.max(ident).alias("last"))
    leaves = leaves.withColumns({"side": F.lit(1), "span_by": F.lit(None)})
    spans = spans.where((F.col(start) <= F.col(end)) & F.col(own).isNotNull())
    bounds = [spans.select(F.col(c).alias("t"), F.col(own).alias("of"), F.lit(side).alias("side"), F.struct(*by).alias("span_by"))
              for c, side in ((start, 0), (end, 2))]
    both = leaves.unionByName(bounds[0].unionByName(bounds[1]), allowMissingColumns=True).withColumn("cell", cell("t"))
    # Points up to here in the cell: a bound stands before (start) or after (end) all points of its time.
    here = Window.partitionBy("cell").orderBy("t", "side", "who").rowsBetween(Window.unboundedPreceding, 0)
    path = new_work_dir(spark, "interval")
    both.withColumn("upto", F.count(F.when(F.col("side") == 1, 1)).over(here)).write.parquet(f"{path}/numbered")
    numbered = spark.read.parquet(f"{path}/numbered")
    bits = ((numbered.agg(F.max("upto")).first()[0] or 1) - 1).bit_length()
    at = F.shiftleft("cell", bits) + F.col("upto")
    leaves = numbered.where("side = 1").withColumn("at", at - 1)
    spans = numbered.where("side <> 1").groupBy("span_by").agg(
        F.max("of").alias("who"), F.min("t").alias("from_t"), F.max("t").alias("to_t"),
        F.min(F.when(F.col("side") == 0, at)).alias("lo"), F.max(F.when(F.col("side") == 2, at)).alias("hi"))

    # A span's own points are few: those of its key.
    mine = interval_join(leaves.select("who", "t", "at"), spans, "t", "from_t", "to_t", on=["who"], width=width)
    ends = mine.select("span_by", "lo", "at").unionByName(spans.select("span_by", "lo", F.col("hi").alias("at")))
    before = F.lag("at").over(Window.partitionBy("span_by").orderBy("at"))
    pieces = ends.select("span_by", F.coalesce(before + 1, "lo").alias("lo"), F.col("at").alias("hi")).where("lo < hi")
    pieces.write.parquet(f"{path}/pieces")
    pieces = spark.read.schema(pieces.schema).parquet(f"{path}/pieces")
    levels = F.explode(F.sequence(F.lit(0), F.lit((pieces.agg(F.max(F.col("hi") - F.col("lo"))).first()[0] or 1).bit_length())))

    # Of a level's blocks inside a piece, at most the first and the last lie in no block of the level above.
    blocks = pieces.withColumn("level", levels).withColumns({
        "l": F.expr("shiftright(lo + shiftleft(1L, level) - 1, level)"), "r": F.expr("shiftright(hi, level)")}).where("l < r")
    odd = [F.when(F.col("l") % 2 != 0, F.col("l")), F.when(F.col("r") % 2 != 0, F.col("r") - 1)]
    asked = blocks.select("span_by", "level", F.explode(F.array_compact(F.array_distinct(F.array(*odd)))).alias("block"))
    totals = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("first").alias("first"), F.max("last").alias("last")]
    held = leaves.withColumn("level", levels).groupBy("level", F.expr("shiftright(at, level)").alias("block")).agg(*totals)
    return asked.join(held, ["level", "block"]).groupBy("span_by").agg(*totals).select("span_by.*", "n", "total", "first", "last")
