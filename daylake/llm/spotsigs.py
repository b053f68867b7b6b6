r"""Document fingerprints by spot signatures.

A spot signature is an anchor (a common word) and the chain of the content words that follow it:
``CHAIN`` words, each ``DISTANCE`` words after the one before, common words and one-letter words not
counted.  A document's fingerprint is the set of its signatures' 32-bit hashes, written as sorted hex.
Texts are alike as their sets' Jaccard coefficient.  A text with words but no signature (too short,
no anchor) is fingerprinted by its whole sequence of words.

:func:`near_duplicates` finds all pairs above a threshold: documents are partitioned by set length into
ranges such that a match lies in the same range or the next, and inside a range
Jaccard is pruned by length and by the first hashes, which two similar sets must share.

Defined cases
  null text        as the empty text: the empty fingerprint
  very long text   read whole, in one task with its next document
  ties             rows of one id are ordered by a hash of their texts
  empty sets       two are alike by 1, an empty and a filled one by 0
  null id          ordered before all ids
  repeated rows    each has the next row as its next document
  one row          is its own next document
  empty table      no rows
  extra columns    ignored
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daylake.llm import ngram_join
from daylake.llm.common import keep_table
from daylake.llm.components import components

# Common words of the languages at hand.
ANCHORS = frozenset(
    "the of and to a in is that it for was on with as be by are this at from"
    " der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als"
    " de la le et les des en un du une que est pour qui dans par plus pas au sur"
    " el los se las del por con no una su para es al lo como más o pero sus".split()
)
CHAIN = 2
DISTANCE = 1
WORD = re.compile(r"[^\W_]+")
# Documents are put in order in ranges of about so many, found from so many quantiles of their ids.
QUANTILES = 512
RANGE_ROWS = 20_000
# The first documents of so many ranges are broadcast; more are joined by a shuffle.
BROADCAST_HEADS = 500_000


def signatures(text: str | None, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN, distance: int = DISTANCE) -> np.ndarray:
    """The sorted distinct 32-bit hashes of a text's spot signatures."""
    words = WORD.findall((text or "").lower())
    content = [w for w in words if w not in anchors and len(w) > 1]
    found = set()
    digest = xxhash.xxh32_intdigest
    reach = chain * distance
    next_content = 0
    for w in words:
        if w in anchors:
            spot = content[next_content + distance - 1 : next_content + reach : distance]
            if len(spot) == chain:
                found.add(digest(" ".join([w, *spot])))
        elif len(w) > 1:
            next_content += 1
    if not found and words:
        found.add(digest(" ".join(words)))
    return np.sort(np.fromiter(found, np.uint32, len(found)))


def fingerprint(sigs: np.ndarray) -> str:
    return sigs.astype(">u4").tobytes().hex()


def as_lists(sigs: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, sigs)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *sigs]).astype(np.int64)))


def parse(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard of two sorted sets."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_spots, fingerprint`` of every whole text, and ``sigs``, the fingerprint's hashes as numbers."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [signatures(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(list(map(len, sigs)), pa.int32()), pa.array(list(map(fingerprint, sigs)), pa.string()), as_lists(sigs)],
                [id_col, "n_spots", "fingerprint", "sigs"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_spots int, fingerprint string, sigs array<bigint>")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, next_text``: each document with the next one by id (after the last: the first).

    Ids are cut into ranges of about ``RANGE_ROWS`` documents: first by quantiles, then into equal steps between
    two quantiles.  Each range is put in order alone, with the first document of the next range at its end,
    so every text moves once.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    steps = [i / QUANTILES for i in range(1, QUANTILES)]
    told = rows.select("id").agg(F.count("*"), F.min("id"), F.max("id"), F.percentile_approx("id", steps, 10 * QUANTILES)).first()
    n, low, high, cuts = told
    place = F.lit(0).cast("long")
    if low is not None:
        cuts = sorted(set(cuts))
        fine = -(-n // (QUANTILES * RANGE_ROWS))
        quantile = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("id")))
        edges = F.array(*[F.lit(c) for c in [low - 1, *cuts, high]])
        below, upto = F.get(edges, quantile), F.get(edges, quantile + 1)
        step = F.floor((F.col("id") - below - 1) * fine / F.greatest(upto - below, F.lit(1)))
        place = F.when(F.col("id").isNull(), F.lit(0)).otherwise(quantile * fine + F.least(step, F.lit(fine - 1))).cast("long")
    tagged = rows.withColumns({"mark": F.xxhash64("text"), "range": place})
    # The first document of each range also goes to the range before (that of the first range: to the last).
    first = F.min(F.struct(F.col("id").isNotNull().alias("given"), "id", "mark")).alias("f")
    heads = tagged.groupBy("range").agg(first).select("range", F.col("f.id").alias("hid"), F.col("f.mark").alias("hmark"))
    order = Window.orderBy("range")
    last = F.max("range").over(Window.partitionBy())
    heads = heads.select("hid", "hmark", F.coalesce(F.lag("range").over(order), last).alias("hrange"))
    heads = keep_table(docs.sparkSession, heads, "spots-heads")
    if n <= BROADCAST_HEADS * RANGE_ROWS:
        heads = F.broadcast(heads)
    tagged = tagged.join(heads, F.col("id").eqNullSafe(F.col("hid")) & (F.col("mark") == F.col("hmark")), "left")
    places = F.array(F.struct(F.col("range"), F.lit(False).alias("head")), F.struct(F.col("hrange").alias("range"), F.lit(True).alias("head")))
    put = tagged.select("id", "text", "mark", F.explode(F.filter(places, lambda x: x["range"].isNotNull())).alias("to"))
    inside = Window.partitionBy("to.range").orderBy(F.col("to.head"), F.col("id").asc_nulls_first(), "mark")
    return put.withColumn("next_text", F.lead("text").over(inside)).where(~F.col("to.head")).select("id", "text", "next_text")


def edited_text(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next`` of every document."""
    pairs = with_next(docs, id_col, text_col)
    kind = pairs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # In order, a row's next text is the following row's text: each text's set is made once.
            known: tuple[str, np.ndarray] = ("", signatures(""))
            out = []
            for row in range(batch.num_rows):
                text, following = batch.column("text")[row].as_py(), batch.column("next_text")[row].as_py() or ""
                own = known[1] if known[0] == text else signatures(text)
                known = (following, own if following == text else signatures(following))
                edited = edited_text(text, following)
                changed = own if edited == text else signatures(edited)
                out.append((len(text), edited, fingerprint(own), fingerprint(changed), likeness(own, changed), likeness(own, known[1])))
            columns = list(zip(*out)) or [[]] * 6
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, types))],
                [id_col, "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    schema = f"`{id_col}` {kind}, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return pairs.mapInArrow(run, schema)


def length_bounds(percent: int, most: int = 1 << 31) -> list[int]:
    """First lengths of the ranges: a set links only to sets of its own range and the ones beside it."""
    bounds = [1]
    while bounds[-1] < most:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 100 // percent)))
    return bounds


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """``<id_col>, n_spots, component_id`` of every document: the smallest id reachable through pairs whose
    sets have a Jaccard coefficient of ``percent`` / 100 or more, its own included.

    Sets are partitioned by length: cell j holds the ranges j and j + 1, so a set is in two cells and each
    pair that can link meets in one.  Inside the cells the search prunes by the rarest signatures and by length.
    Documents without words link to nothing.
    """
    spark = docs.sparkSession
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    prints = fingerprints(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id", "text")
    prints = keep_table(spark, prints.select("id", "n_spots", F.xxhash64("fingerprint").alias("c"), "sigs"), "spots-prints")
    # Equal fingerprints are one set.
    sets = prints.where("n_spots > 0").groupBy("c").agg(F.min("id").alias("least"), F.max("n_spots").cast("long").alias("n"), F.max("sigs").alias("tokens"))
    ranges = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in length_bounds(percent)]), lambda b: b <= F.col("n")))
    cells = sets.withColumn("cell", F.explode(F.array(ranges - 1, ranges)))
    cells = cells.select(
        F.xxhash64("c", "cell").alias("in_cell"), F.col("c").alias("set"), "n", F.transform("tokens", lambda t: F.xxhash64(t, F.col("cell"))).alias("tokens")
    )
    cells = keep_table(spark, cells, "spots-cells")
    links = ngram_join.links_of_sets(cells.select(F.col("in_cell").alias("c"), "n", "tokens"), percent)
    names = cells.select("in_cell", "set")
    links = links.join(names.toDF("a", "x"), "a").join(names.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    found = components(spark, links, "spots-links").select(F.col("node").alias("c"), "component")
    named = sets.select("c", "least").join(found, "c").groupBy("component").agg(F.min("least").alias("component_id"))
    labels = sets.select("c", "least").join(found.join(named, "component").select("c", "component_id"), "c", "left")
    labels = labels.select("c", F.coalesce("component_id", "least").alias("component_id"))
    return prints.join(labels, "c", "left").select(
        F.col("id").cast(kind).alias(id_col),
        "n_spots",
        F.when(F.col("n_spots") > 0, F.col("component_id")).otherwise(F.col("id")).cast(kind).alias("component_id"),
    )
