"""Mixing sources to target weights (DataFrame functions only).

Every document gets a hash-random key.  Within its source, documents are ranged by
key into 4096 key buckets; running sums inside a bucket plus the sums of the
buckets before it are the source's prefix sums of word counts, so no task holds a
whole source.  The row at which a source's budget runs out is its *cut*; a document is
taken if it lies before the cut, so the decision for all documents needs one small
row per source.

Defined cases
  null text            size 0, taken 0
  null source          a source of its own, last in the order of sources
  null id              ordered before all ids, with the key of the text ``null``
  repeated rows        each is a document; rows with the same id and size that lie on
                       the cut share what is left of the budget evenly
  empty table          no rows
  source of size 0     target 0, taken 0
  very long text       one document, counted whole; on the cut it is taken in part
  other columns        ignored by :func:`mix`, kept by :func:`mixed_documents`
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daylake.llm.common import as_row, field, keep_table, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
# A plan has one row per source; up to this many rows it is broadcast.
BROADCAST_SOURCES = 100_000


def _source_key(source: Column) -> Column:
    """Never null, and ordered as the source: ``=name``; ``~`` (after ``=``) for null."""
    return F.when(source.isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), source.cast("string")))


def _hash_key(ident: Column, seed: str) -> Column:
    text = F.concat(F.lit(seed + ":"), F.coalesce(ident.cast("string"), F.lit("null")))
    return F.substring(F.md5(text), 1, 16)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes(src, source_size)`` -> adds ``target``: weights over all sizes, a target never above
    ``max_epochs`` times its source, the excess reshared by weight.

    Sorted by cap / weight, capped sources come first; what they leave is shared by
    the weights of the rest.  One row per source, so the windows without a key are small.
    """
    order = Window.orderBy("src")
    every = Window.partitionBy()
    ws = F.array(*[F.lit(int(w)) for w in weights])
    rows = (
        sizes.withColumn("n", F.row_number().over(order))
        .withColumn("w", F.get(ws, (F.col("n") - 1) % len(weights)).cast("long"))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("room", F.col("cap") / F.col("w"))
    )
    upto = Window.orderBy("room", "src").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (
        rows.withColumn("num", F.sum("source_size").over(every) - (F.sum("cap").over(upto) - F.col("cap")))
        .withColumn("den", F.sum("w").over(every) - (F.sum("w").over(upto) - F.col("w")))
        .withColumn("capped", F.col("num") / F.col("den") > F.col("room"))
    )
    first_free = F.min(F.when(~F.col("capped"), F.struct("room", "src", "num", "den"))).over(every)
    rows = rows.withColumn("free", first_free)
    share = (F.col("w") * F.col("free.num")).cast("double") / F.col("free.den")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.least(share, F.col("cap").cast("double")))
    return rows.select("src", "source_size", target.alias("target"))


def mix_plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sized(src, id, size, key)`` -> one row per source: ``source_size, target, epochs`` (whole passes) and the cut:
    ``cut`` (key, id, size), ``cut_left`` words of the budget for the ``cut_rows`` rows there."""
    ties = (
        sized.groupBy("src", F.substring("key", 1, 3).alias("bucket"), "key", "id", "size")
        .agg(F.count("*").alias("copies"))
        .withColumn("mass", F.col("size") * F.col("copies"))
    )
    buckets = ties.groupBy("src", "bucket").agg(F.sum("mass").alias("bucket_size"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("offset", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    sizes = buckets.groupBy("src").agg(F.sum("bucket_size").alias("source_size"))
    plan = source_targets(sizes, weights, max_epochs)
    budget = F.floor("target")
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0).cast("long")))
    plan = plan.withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    # Only the bucket in which the budget runs out can hold the cut.
    hit = buckets.join(plan.select("src", "rest"), "src").where(
        (F.col("offset") < F.col("rest")) & (F.col("rest") <= F.col("offset") + F.col("bucket_size"))
    )
    inside = Window.partitionBy("src").orderBy("key", "id", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        ties.join(hit, ["src", "bucket"])
        .withColumn("end", F.col("offset") + F.sum("mass").over(upto))
        .where((F.col("end") - F.col("mass") < F.col("rest")) & (F.col("rest") <= F.col("end")))
        .select(
            "src",
            F.struct("key", "id", "size").alias("cut"),
            (F.col("rest") - F.col("end") + F.col("mass")).alias("cut_left"),
            F.col("copies").alias("cut_rows"),
        )
    )
    return plan.join(cut, "src", "left").select("src", "source_size", "target", "epochs", "cut", "cut_left", "cut_rows")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with ``src, key, id, size`` joined with their source's plan; ``part``: words taken beside the whole epochs."""
    small = plan.count() <= BROADCAST_SOURCES
    joined = rows.join(F.broadcast(plan) if small else plan, "src")
    here = F.struct("key", "id", "size")
    part = (
        F.when(F.col("cut").isNull(), F.lit(0))
        .when(here < F.col("cut"), F.col("size"))
        .when(here == F.col("cut"), F.expr("cut_left div cut_rows"))
        .otherwise(F.lit(0))
    )
    return joined.withColumn("part", part.cast("long"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return as_row(docs).select(
        "row",
        _source_key(field(source_col)).alias("src"),
        F.coalesce(field(id_col).cast("string"), F.lit("")).alias("id"),
        word_count(field(text_col)).alias("size"),
        _hash_key(field(id_col), seed).alias("key"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: ``<id_col>, size, source_size, target, taken``.

    A source's taken words are its target, rounded down (less a word for each further repeated row on the cut).
    """
    spark = docs.sparkSession
    sized = _sized(docs, id_col, text_col, source_col, seed)
    # Word counts are made once; both the sums and the result read the small table.
    sized = keep_table(spark, sized.select(field(id_col).alias("doc"), "src", "id", "size", "key"), "mix-sizes")
    plan = keep_table(spark, mix_plan(sized, weights, max_epochs), "mix-plan")
    return _with_plan(sized, plan).select(
        F.col("doc").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mix as whole documents, with the columns of ``docs``: a row per copy taken.

    The document on the cut comes whole if at least half of it fits.  The text moves
    through no shuffle: each row decides by its source's plan.
    """
    spark = docs.sparkSession
    sized = _sized(docs, id_col, text_col, source_col, seed)
    table = keep_table(spark, sized.select("src", "id", "size", "key"), "mix-sizes")
    plan = keep_table(spark, mix_plan(table, weights, max_epochs), "mix-plan")
    # An empty document weighs nothing: it goes through once.
    whole = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.col("epochs") + F.when(F.col("part") * 2 >= F.col("size"), F.lit(1)).otherwise(F.lit(0))
    )
    copies = _with_plan(sized, plan).withColumn("copies", whole.cast("int")).where("copies > 0")
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
         substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 16) AS key
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) AS n FROM sized GROUP BY source),
w AS (SELECT *, CASE n % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS w FROM src),
r AS (SELECT *, 3.0 * source_size / w AS room, 3 * source_size AS cap FROM w),
s AS (SELECT *, CAST(sum(source_size) OVER () - (sum(cap) OVER (ORDER BY room, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap) AS BIGINT) AS num,
             CAST(sum(w) OVER () - (sum(w) OVER (ORDER BY room, source NULLS LAST ROWS UNBOUNDED PRECEDING) - w) AS BIGINT) AS den FROM r),
f AS (SELECT num AS fnum, den AS fden FROM s WHERE CAST(num AS DOUBLE) / den <= room ORDER BY room, source NULLS LAST LIMIT 1),
t AS (SELECT s.source, source_size,
             CASE WHEN CAST(num AS DOUBLE) / den > room THEN CAST(cap AS DOUBLE)
                  ELSE least(CAST(w * fnum AS DOUBLE) / fden, CAST(cap AS DOUBLE)) END AS target FROM s, f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS before
      FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM e
"""
