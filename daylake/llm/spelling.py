r"""Spelling variant grouping: words one edit apart, and the common form each rare word stands for.

Near words are found by a bit-sliced position index: for each (position, letter) a bitset over the vocabulary tells
which words have that letter there.  A query word is read letter by letter; word-parallel recurrences carry three sets of
vocabulary words along: no error so far, one letter replaced, one letter more than the query (read at positions shifted by one).
The query is the shorter word, or one of equal length, so a letter less needs no set of its own.

Scale.  An edit at the first differing letter lies in one of ``PIECES`` pieces of the shorter word; before and after that
piece both words are equal.  Words are dealt to buckets by what surrounds each piece, so near words meet
in exactly one bucket, and a query meets its bucket only.  A bucket above ``BUCKET`` words is dealt again by
pieces half as long, until a piece is one letter.  Buckets are packed into groups of about ``GROUP`` words, each searched by one task;
work grows with the vocabulary, not with its square.

Defined cases
  null text       no runs
  null id         its runs are tagged by an empty id when they are hashed
  repeated rows   each counts its occurrences
  ties            of near words that occur equally often the smallest in code-point order is the form
  very long text  read whole by one task; a long run is a word like others
  empty table     no rows
  extra columns   not read
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import as_row, field, keep_table

MIN_CHARS = 7
MIN_COUNT = 2
TIMES = 10
EVERY = 31
PIECES = 2
BUCKET = 8192
GROUP = 32_768
BATCH = 256
# A task hands on what it has counted when it holds so many words, or so many bytes of them.
HELD_WORDS, HELD_BYTES = 400_000, 32 << 20

# Over Latin-1 bytes; what Latin-1 lacks becomes a question mark, which is no letter.
RUN = re.compile(rb"[a-z\xc0-\xff]+")


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY, min_chars: int = MIN_CHARS) -> DataFrame:
    """``word, n``: how often each word comes, after the letter that the hash of id and run tells is deleted; a word may come in several rows."""
    rows = as_row(docs).select(F.coalesce(field(id_col).cast("string"), F.lit("")).alias("id"), field(text_col).alias("text"))

    def told(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        size = 0
        for batch in batches:
            for name, text in zip(batch.column("id"), batch.column("text")):
                text = text.as_py()
                if not text:
                    continue
                tag = zlib.crc32(f"{name.as_py()}:".encode())
                # bytes.lower() changes A-Z only
                for word, n in Counter(RUN.findall(text.encode("latin-1", "replace").lower())).items():
                    if len(word) < min_chars:
                        continue
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), tag)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_chars:
                            continue
                    if word not in held:
                        size += len(word)
                    held[word] += n
                if len(held) >= HELD_WORDS or size >= HELD_BYTES:
                    yield told(held)
                    held, size = Counter(), 0
        yield told(held)

    return rows.mapInArrow(run, "word string, n long")


def _cut(piece: Column, pieces: Column, base: Column) -> Column:
    """Where a piece of a word of ``base`` letters begins."""
    return F.floor(piece * base / pieces).cast("int")


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds ``lo, hi`` (the piece) and ``key`` (a hash of what surrounds it); empty pieces are left out."""
    p, k, b, word = F.col("piece"), F.col("pieces"), F.col("base"), F.col("word")
    rows = rows.withColumns({"lo": _cut(p, k, b), "hi": _cut(p + 1, k, b)}).where("lo < hi")
    before = F.substring(word, F.lit(1), F.col("lo"))
    after = F.substring(word, F.col("size") - (F.col("base") - F.col("hi")) + 1, F.col("base") - F.col("hi"))
    return rows.withColumn("key", F.xxhash64("base", "lo", "hi", before, after))


def buckets(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``base, lo, hi, key, word, n, size``: words in the buckets where each can meet a near one.

    In the buckets of ``base`` the words of ``base`` letters are compared with each other and with those of one letter more.
    """
    spark = words.sparkSession
    bases = F.explode(F.array(F.col("size"), F.col("size") - 1)).alias("base")
    rows = words.select("word", "n", "size", bases).withColumn("pieces", F.lit(PIECES))
    rows = _keyed(rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1)))))
    same = ["base", "lo", "hi", "key"]
    ready = None
    while True:
        sizes = rows.groupBy(*same).agg(F.count("*").alias("held"), F.max(F.col("size") == F.col("base")).alias("asked"))
        rows = keep_table(spark, rows.join(sizes.where("held > 1 AND asked"), same), "spelling-buckets")
        settled = (F.col("held") <= bucket) | (F.col("hi") - F.col("lo") <= 1)
        done = rows.where(settled).select(*same, "word", "n", "size")
        ready = done if ready is None else ready.unionByName(done)
        rows = rows.where(~settled)
        if rows.isEmpty():
            return ready
        halves = F.explode(F.array(F.col("piece") * 2, F.col("piece") * 2 + 1)).alias("piece")
        rows = _keyed(rows.select("word", "n", "size", "base", (F.col("pieces") * 2).alias("pieces"), halves))


class PositionIndex:
    """Bitsets over a vocabulary, 64 words to an integer: for each position and letter, the words that have it there."""

    def __init__(self, words: list[str], base: int):
        n = len(words)
        codes = np.array(words, f"U{base + 1}").view(np.uint32).reshape(n, base + 1)
        alphabet, self.letters = np.unique(np.append(codes.ravel(), np.uint32(0)), return_inverse=True)
        self.letters = self.letters[:-1].reshape(n, base + 1)  # 0: none, past the end
        self.base, self.width = base, -(-n // 64)
        wide = np.full((64 * self.width, base + 1), -1)
        wide[:n] = self.letters
        self.has = np.stack([_bits(wide[:, p][None, :] == np.arange(len(alphabet))[:, None]) for p in range(base + 1)])
        longer = np.zeros(64 * self.width, bool)
        longer[:n] = self.letters[:, base] > 0
        self.longer = _bits(longer[None, :])[0]

    def near(self, queries: np.ndarray, begin: np.ndarray, end: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """For query words (by number, ``base`` letters each) the words among ``begin .. end - 1`` (of each query) that differ
        by one replaced or one more letter, the first difference being at ``lo .. hi - 1`` (or past the end, where ``hi`` is ``base``)."""
        left, right = int(begin.min()) // 64, -(-int(end.max()) // 64)
        number = np.arange(64 * left, 64 * right)
        same = _bits((number >= begin[:, None]) & (number < end[:, None]))
        replaced, more = np.zeros_like(same), np.zeros_like(same)
        for i in range(self.base):
            letter = self.letters[queries, i]
            here = self.has[i][letter, left:right]
            shifted = self.has[i + 1][letter, left:right]
            if lo <= i < hi:
                wrong = same & ~here
                replaced = (replaced & here) | wrong
                more = (more | wrong) & shifted
            elif i >= hi:
                replaced &= here
                more &= shifted
            same &= here
        longer = self.longer[left:right]
        if hi == self.base:
            more |= same
        found = (replaced & ~longer) | (more & longer)
        query, word = np.nonzero(np.unpackbits(found.view(np.uint8), axis=1, bitorder="little"))
        return query, word + 64 * left


def _bits(flags: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.packbits(flags, axis=1, bitorder="little")).view(np.uint64)


def _search(table: pa.Table) -> pa.Table:
    """Near pairs of a group of buckets, in both directions."""
    frame = table.select(["base", "lo", "hi", "key", "word", "n", "size"]).sort_by([(c, "ascending") for c in ("base", "lo", "hi", "key")])
    place = np.stack([frame[c].to_numpy() for c in ("base", "lo", "hi")])
    key, words, n, size = frame["key"].to_numpy(), np.array(frame["word"].to_pylist(), object), frame["n"].to_numpy(), frame["size"].to_numpy()
    edges = np.flatnonzero(np.any(place[:, 1:] != place[:, :-1], axis=0)) + 1
    pairs = []
    for a, b in zip([0, *edges], [*edges, len(words)]):
        base, lo, hi = (int(x) for x in place[:, a])
        index = PositionIndex(words[a:b].tolist(), base)
        keys = key[a:b]
        begin, end = np.searchsorted(keys, keys, "left"), np.searchsorted(keys, keys, "right")
        queries = np.flatnonzero(size[a:b] == base)
        for at in range(0, len(queries), BATCH):
            q = queries[at : at + BATCH]
            which, word = index.near(q, begin[q], end[q], lo, hi)
            pairs.append((a + q[which], a + word))
    x, y = (np.concatenate(c) for c in zip(*pairs)) if pairs else (np.empty(0, int), np.empty(0, int))
    back = size[y] > size[x]  # of equal length: found from either word
    x, y = np.concatenate((x, y[back])), np.concatenate((y, x[back]))
    return pa.table({"word": pa.array(words[x], pa.string()), "near": pa.array(words[y], pa.string()), "near_n": pa.array(n[y], pa.int64())})


def near_pairs(words: DataFrame, bucket: int = BUCKET, group: int = GROUP) -> DataFrame:
    """``words(word, n, size)`` -> ``word, near, near_n``: every pair one edit apart, once in each direction."""
    rows = keep_table(words.sparkSession, buckets(words, bucket), "spelling-rows")
    groups = max(1, rows.count() // group)
    rows = rows.withColumn("part", F.pmod("key", F.lit(groups)))
    return rows.groupBy("part").applyInArrow(_search, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form: the forms followed to the last.  Each round doubles the steps made; a form
    comes at least ``TIMES`` times as often as its word, so chains are short and have no cycle."""
    spark = forms.sparkSession
    roots = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        roots = keep_table(spark, roots, "spelling-roots")
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if roots.join(onward, "root", "left_semi").isEmpty():
            return roots
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT, times: int = TIMES, bucket: int = BUCKET, group: int = GROUP
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word that comes ``min_count`` times or more."""
    spark = docs.sparkSession
    words = counted(docs, id_col, text_col).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    words = keep_table(spark, words.withColumn("size", F.length("word")), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_pairs(words, bucket, group).groupBy("word").agg(F.count("*").alias("n_near"), best)
    common = -F.col("best.less") >= times * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word",
        F.when(common, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, -F.col("best.less")).alias("form_n"),
    )
    forms = keep_table(spark, forms, "spelling-forms")
    return forms.join(_roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
