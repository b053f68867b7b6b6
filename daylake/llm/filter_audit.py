r"""Filter interaction audit: what each filter of a chain removes, under every order of the filters.

Filters that look at one text are tested where the text lies.  The last filter (``COPY``: the text is identical to that
of a smaller id) is an existential self-join: rows whose text hash comes again are left-semi joined with
the least id of each text on hash, exact text and smaller id.  Its ids are united with the other failures' ids, one
row of bits a document; the combinations of bits are counted for each part, and every order is read off these counts.

Scale: texts move only where their hash comes again; a text's rows are dealt over salts by how often its
hash comes (``SALT_ROWS``), and the other side holds one row a text and salt.  All after that has a few bytes a document,
then at most 2^filters rows a part.

Defined cases
  null text       the empty text
  null part       the empty string
  null id         has no smaller id and is nobody's smaller id; it is counted like others
  repeated rows   counted each; rows of one id are told apart by a 64-bit hash of the text
  ties            rows of one id and one text are not copies of each other (no id is smaller)
  ids rated repeatedly   good or toxic if any of the ratings says so
  very long text  read whole by one task
  empty table     no rows
  extra columns   not read
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import as_row, field, keep_table

UPPER = bytes(range(ord("A"), ord("Z") + 1))
SIGNS = re.compile(rb"[#$%&*|]")
# Rows of one text hash that share a salt.
SALT_ROWS = 200
# So many repeated hashes (12 bytes each) are broadcast to the rows; more are joined by a shuffle.
BROADCAST_HASHES = 500_000


@dataclass(frozen=True)
class Read:
    """A text as the filters see it."""

    data: bytes  # UTF-8
    n_chars: int
    words: list[bytes]

    @classmethod
    def of(cls, text: str) -> Read:
        data = text.encode()
        # bytes.split() parts at the space and \x09-\x0D, nothing else
        return cls(data, len(text), data.split())


def few_words(t: Read) -> bool:
    return len(t.words) < 200


def few_distinct(t: Read) -> bool:
    return 100 * len(set(t.words)) < 50 * len(t.words)


def many_capitals(t: Read) -> bool:
    return 100 * (len(t.data) - len(t.data.translate(None, UPPER))) > 3 * t.n_chars


def holds_sign(t: Read) -> bool:
    return SIGNS.search(t.data) is not None


# Letter -> condition under which a text fails.
FILTERS: dict[str, Callable[[Read], bool]] = {"A": few_words, "B": few_distinct, "C": many_capitals, "D": holds_sign}
COPY = "E"


def text_failures(docs: DataFrame, filters: dict[str, Callable[[Read], bool]], id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id, h, part, bits`` of every row: bit i is set if the row fails the i-th filter; h is the hash of its text."""
    rows = as_row(docs).select(
        field(id_col).alias("id"), F.coalesce(field(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(field(text_col), F.lit("")).alias("text")
    )
    rows = rows.select("id", F.xxhash64("text").alias("h"), "part", "text")
    tests = [(1 << i, test) for i, test in enumerate(filters.values())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for text in batch.column("text"):
                t = Read.of(text.as_py())
                bits.append(sum(bit for bit, test in tests if test(t)))
            arrays = [batch.column("id"), batch.column("h"), batch.column("part"), pa.array(bits, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "h", "part", "bits"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, h long, part string, bits int")


def copies_of_smaller(docs: DataFrame, hashes: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id, h, part`` of the rows whose text is that of a smaller id.  ``hashes(h)``: the hash of every row's text."""
    spark = docs.sparkSession
    salts = F.ceil(F.col("n") / F.lit(SALT_ROWS)).cast("int").alias("salts")
    repeated = keep_table(spark, hashes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", salts), "audit-repeated")
    if repeated.count() <= BROADCAST_HASHES:
        repeated = F.broadcast(repeated)
    rows = as_row(docs).select(
        field(id_col).alias("id"), F.coalesce(field(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(field(text_col), F.lit("")).alias("text")
    )
    rows = rows.withColumn("h", F.xxhash64("text")).join(repeated, "h")
    least = rows.groupBy("h", "text", "salts").agg(F.min("id").alias("least"))
    least = least.select("h", "text", "least", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int"))
    smaller = (rows["h"] == least["h"]) & (rows["salt"] == least["salt"]) & (rows["text"] == least["text"]) & (least["least"] < rows["id"])
    return rows.join(least, smaller, "left_semi").select("id", "h", "part")


def combinations(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    filters: dict[str, Callable[[Read], bool]] = FILTERS,
) -> DataFrame:
    """``part, bits, n, n_good, n_toxic``: how many rows of a part fail exactly these filters (the last bit: ``COPY``)."""
    failed = keep_table(docs.sparkSession, text_failures(docs, filters, id_col, text_col, part_col), "audit-failed")
    copies = copies_of_smaller(docs, failed.select("h"), id_col, text_col, part_col)
    marks = failed.withColumn("rows", F.lit(1).cast("long")).unionByName(
        copies.select("id", "h", "part", F.lit(1 << len(filters)).alias("bits"), F.lit(0).cast("long").alias("rows"))
    )
    each = marks.groupBy("id", "h", "part").agg(F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"))
    rated = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    rated = rated.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))

    def rows_if(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0)).cast("long")

    return each.join(rated, "id", "left").groupBy("part", "bits").agg(
        F.sum("rows").alias("n"), rows_if(F.col("good")).alias("n_good"), rows_if(F.col("toxic")).alias("n_toxic")
    )


def orders_of(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, ``filter_order`` and ``step`` from the counts of :func:`combinations`."""
    steps = []
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            steps.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    schema = "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    # A few hundred rows a part, made from at most 2^filters counts each.
    each = counts.withColumn("s", F.explode(F.from_json(F.lit(json.dumps(steps)), schema))).select("*", "s.*")
    bits, bit, before = F.col("bits"), F.col("bit"), F.col("before")
    fails = bits.bitwiseAND(bit) != 0
    gone = bits.bitwiseAND(before) != 0

    def total(condition: Column, n: Column | str = "n") -> Column:
        value = F.col(n) if isinstance(n, str) else n
        return F.sum(F.when(condition, value).otherwise(F.lit(0))).cast("long")

    # Among the orders of all filters each of a row's failures comes first equally often.
    turns = F.col("n") * F.lit(math.factorial(len(letters))) / F.greatest(F.bit_count(bits), F.lit(1))
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(bits == bit).alias("unique_fails"),
        total(fails & ~gone, "n_good").alias("good_lost"),
        total(fails & ~gone, "n_toxic").alias("toxic_lost"),
        total(fails, turns.cast("long")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Read], bool]] = FILTERS, **columns: str) -> DataFrame:
    """Counts for every part, order of the filters (``COPY`` among them) and step.  ``columns``: ``id_col``, ``text_col``, ``part_col``."""
    return orders_of(combinations(docs, labels, filters=filters, **columns), "".join(filters) + COPY)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
f AS (SELECT doc_id, part,
             CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS bits FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
o AS (SELECT '' AS o UNION ALL SELECT o || x FROM o, unnest(['A', 'B', 'C', 'D', 'E']) u(x) WHERE NOT contains(o, x)),
s AS (SELECT o AS filter_order, CAST(step AS INTEGER) AS step, 1 << (ascii(o[step]) - 65) AS bit,
             list_sum([1 << (ascii(x) - 65) for x in string_split(o[:step - 1], '') if x <> '']) AS before
      FROM o, range(1, 6) r(step) WHERE length(o) = 5),
e AS (SELECT part, filter_order, step, n, n_good, n_toxic, bits, CAST(bit AS BIGINT) AS bit, coalesce(CAST(before AS BIGINT), 0) AS before FROM c, s),
g AS (SELECT part, filter_order, step, any_value(bit) AS bit,
             coalesce(sum(n) FILTER ((bits & (before | bit)) = 0), 0) AS kept,
             coalesce(sum(n) FILTER ((bits & bit) <> 0 AND (bits & before) = 0), 0) AS removed,
             coalesce(sum(n) FILTER ((bits & bit) <> 0 AND (bits & before) <> 0), 0) AS redundant,
             coalesce(sum(n) FILTER (bits = bit), 0) AS unique_fails,
             coalesce(sum(n_good) FILTER ((bits & bit) <> 0 AND (bits & before) = 0), 0) AS good_lost,
             coalesce(sum(n_toxic) FILTER ((bits & bit) <> 0 AND (bits & before) = 0), 0) AS toxic_lost
      FROM e GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM g
"""
