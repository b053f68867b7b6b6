r"""Substring dedup: every word run of ``WINDOW`` words that starts in a document with a smaller id is removed.

Two passes over blocks of documents.  In the first each block makes a partial count-min sketch of its windows
(how many documents have each, at most 2); the partial sketches are merged, and as a count-min sketch never counts too little,
a window that it counts once stands in one document only.  In the second pass only the windows estimated repeated are
grouped exactly, by 96 bits of their words, to find the least id that has each.

Scale.  The sketch grows with the corpus (about ``ROOM`` counters a window and row), so it is never in one place:
it is cut into slices by counter number, a block sends a slice the numbers it hit (some eleven bits each), the slice's task adds
them up and answers each block with a bit for each number sent.  A window that a third of all documents share is one row
a block, and what repeats inside a block is settled there.  Documents are dealt to blocks of about ``BLOCK_BYTES`` of text by a hash of id and text; this
shuffle of the texts is the only one and serves all passes.  Nothing is collected but the number of bytes.

Defined cases
  null text       no words
  null id         has no smaller id and is nobody's smaller id: its words stay
  repeated rows   judged each; rows of one id do not remove each other's windows (no id is smaller)
  ties            a window several times in one document: its places there are treated alike
  short text      without a whole window nothing is removed
  very long text  a block of its own size, in one task
  empty table     no rows
  extra columns   not read
  ids             integers
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daylake.llm.common import as_row, field

WINDOW = 13
BLOCK_BYTES = 8 << 20
LEAST_BLOCK_BYTES = 64 << 10
DEPTH = 2  # rows of the sketch
ROOM = 6  # counters a window, in each row of the sketch (up to twice as many: rows hold a power of two)
BYTES_A_WORD = 6
# Counters of a slice: 2 ** SLICE_BITS, more (to MAX_SLICE_BITS, a byte each) where there would be over 2 ** SLICES slices.
SLICE_BITS, MAX_SLICE_BITS, SLICES = 22, 28, 13
# Words remembered by a task, and the longest of them in bytes.
WORDS, LONG_WORD = 300_000, 64
STRIDE = 1 << 15

_GOLDEN = 0x9E3779B97F4A7C15


def _odd(i: int) -> np.uint64:
    """An odd multiplier: one for each place in a window and key, and one for each row of the sketch."""
    return np.uint64(xxhash.xxh3_64_intdigest((_GOLDEN + i).to_bytes(8, "little")) | 1)


class WordHash(dict):
    """Word (bytes) -> 64-bit hash; remembers short words up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONG_WORD:
            if len(self) >= WORDS:
                self.clear()
            self[word] = h
        return h


def _windows(h: np.ndarray, size: int, key: int) -> np.ndarray:
    """Multilinear hash of every run of ``size`` words; by strides that stay in the processor's cache."""
    n = len(h) - size + 1
    out = np.empty(max(n, 0), np.uint64)
    steps = [_odd(1000 * key + i) for i in range(size)]
    for at in range(0, n, STRIDE):
        part = out[at : at + STRIDE]
        part[:] = 0
        for i, step in enumerate(steps):
            part += h[at + i : at + i + len(part)] * step
    return out


def _words(text: pa.StringScalar) -> list[bytes]:
    """The words of a text, as UTF-8: bytes.split() parts at the space and \\x09-\\x0D, nothing else."""
    return text.as_buffer().to_pybytes().split() if text.is_valid else []


class Block:
    """The windows of a block of documents, in the order of their first key."""

    def __init__(self, ids: list, texts: pa.ChunkedArray, size: int, known: WordHash):
        hashes = []
        for text in texts:
            words = _words(text)
            hashes.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        self.n_words = np.array([len(h) for h in hashes], np.int64)
        self.word_at = np.concatenate(([0], np.cumsum(self.n_words)))
        self.size = size
        self.h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), self.n_words)
        named = np.array([i is not None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        inside = np.arange(len(owner)) + size <= np.repeat(self.word_at[1:], self.n_words)
        self.at = np.flatnonzero(inside & named[owner]).astype(np.int32)
        k = _windows(self.h, size, 1)[self.at]
        order = np.argsort(k, kind="stable")
        self.at, k = self.at[order], k[order]
        self.owner = owner[self.at]
        self.first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, np.int64)
        self.keys = k[self.first]
        self.runs = np.diff(np.append(self.first, len(k)))
        self.least = np.minimum.reduceat(self.ids[self.owner], self.first) if len(k) else np.empty(0, np.int64)

    def shared(self) -> np.ndarray:
        """Which keys stand in two documents or more of this block."""
        if not len(self.keys):
            return np.empty(0, bool)
        other = np.concatenate(([False], self.owner[1:] != self.owner[:-1]))
        other[self.first] = False
        return np.add.reduceat(other, self.first, dtype=np.int64) > 0

    def second_keys(self) -> np.ndarray:
        return _windows(self.h, self.size, 2)[self.at[self.first]]

    def removed(self, smaller: dict[str, np.ndarray]) -> np.ndarray:
        """Marks the words to remove.  ``smaller``: keys (sorted) whose least id lies in another block, and that id."""
        least = self.least.copy()
        if len(smaller["key"]):
            where = np.searchsorted(smaller["key"], self.keys)
            where[where == len(smaller["key"])] = 0
            hit = smaller["key"][where] == self.keys
            least[hit] = np.minimum(least[hit], smaller["least"][where[hit]])
        again = self.ids[self.owner] > np.repeat(least, self.runs)
        edges = np.zeros(len(self.h) + 1, np.int32)
        np.add.at(edges, self.at[again], 1)
        np.add.at(edges, self.at[again] + self.size, -1)
        return np.cumsum(edges[:-1]) > 0


@dataclass(frozen=True)
class Sketch:
    """Shape of the count-min sketch: ``depth`` rows of 2 ** ``bits`` counters, in slices of 2 ** ``slice_bits``."""

    depth: int
    bits: int
    slice_bits: int

    @classmethod
    def for_bytes(cls, n: int) -> Sketch:
        bits = max(12, math.ceil(math.log2(ROOM * max(n, 1) / BYTES_A_WORD)))
        return cls(DEPTH, bits, min(bits, MAX_SLICE_BITS, max(SLICE_BITS, bits - SLICES)))

    def counters(self, keys: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct counters that the keys hit in a row, ascending, and the place of each key's counter among them."""
        hit = (keys if row == 0 else keys * _odd(-row)) >> np.uint64(64 - self.bits)
        if row == 0:  # keys are sorted, so are their first bits
            new = np.concatenate(([True], hit[1:] != hit[:-1])) if len(hit) else np.empty(0, bool)
            return hit[new], np.cumsum(new) - 1
        return np.unique(hit, return_inverse=True)

    def slices(self, counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slices hit, ascending, and where each begins among the counters (one more at the end)."""
        number = (counters >> np.uint64(self.slice_bits)).astype(np.int64)
        begin = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(number) else np.empty(0, np.int64)
        return number[begin], np.append(begin, len(number))


def _pack(numbers: np.ndarray) -> bytes:
    """Ascending distinct numbers by their steps: the low bits of each as they are, the rest counted in unary (Rice's code)."""
    steps = np.diff(numbers.astype(np.int64), prepend=-1) - 1
    k = int(steps.mean()).bit_length()
    k = max(k - 1, 0)
    low = np.unpackbits((steps & ((1 << k) - 1)).astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :k]
    ends = np.cumsum((steps >> k) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    return b"".join([len(steps).to_bytes(4, "little"), bytes([k]), np.packbits(low.ravel()).tobytes(), np.packbits(unary).tobytes()])


def _unpack(data: bytes) -> np.ndarray:
    n, k = int.from_bytes(data[:4], "little"), data[4]
    edge = 5 + -(-n * k // 8)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :k] = np.unpackbits(np.frombuffer(data, np.uint8, edge - 5, 5), count=n * k).reshape(n, k)
    low = np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.int64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, -1, edge)))
    steps = ((np.diff(ends, prepend=-1) - 1) << k) + low
    return (np.cumsum(steps + 1) - 1).astype(np.uint32)


PARTIAL = "depth int, slice long, block long, hits binary, again binary"
ANSWER = "block long, depth int, slice long, again binary"
# ``at``: the block above 32 bits of the second key, one long in place of two.
REPEATED = "k1 long, at long, least long"


def _partial_sketch(sketch: Sketch, size: int):
    known = WordHash()

    def run(table: pa.Table) -> pa.Table:
        block = Block(table["id"].to_pylist(), table["text"], size, known)
        shared = block.shared()
        out: dict[str, list] = {c.split()[0]: [] for c in PARTIAL.split(", ")}
        low = np.uint64((1 << sketch.slice_bits) - 1)
        for row in range(sketch.depth):
            hits, place = sketch.counters(block.keys, row)
            again = np.bincount(place, 1.0 + shared, len(hits)) >= 2
            numbers, edge = sketch.slices(hits)
            for number, a, b in zip(numbers, edge[:-1], edge[1:]):
                out["depth"].append(row)
                out["slice"].append(number)
                out["hits"].append(_pack((hits[a:b] & low).astype(np.uint32)))
                out["again"].append(np.packbits(again[a:b]).tobytes())
        out["block"] = [table["block"][0].as_py()] * len(out["depth"]) if table.num_rows else []
        return pa.table(out, schema=_arrow(PARTIAL))

    return run


def _merge(sketch: Sketch):
    def run(table: pa.Table) -> pa.Table:
        counts = np.zeros(1 << sketch.slice_bits, np.uint8)
        sent = [_unpack(hits.as_py()) for hits in table["hits"]]
        for numbers, again in zip(sent, table["again"]):
            more = np.unpackbits(np.frombuffer(again.as_py(), np.uint8), count=len(numbers))
            counts[numbers] = np.minimum(counts[numbers] + 1 + more, 2)
        sent = [np.packbits(counts[numbers] == 2).tobytes() for numbers in sent]
        return pa.table({"block": table["block"], "depth": table["depth"], "slice": table["slice"], "again": pa.array(sent, pa.binary())}, schema=_arrow(ANSWER))

    return run


def _estimated(sketch: Sketch, size: int):
    known = WordHash()

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(docs["id"].to_pylist(), docs["text"], size, known)
        bits = {(d, s): m for d, s, m in zip(answers["depth"].to_pylist(), answers["slice"].to_pylist(), answers["again"].to_pylist())}
        repeated = np.ones(len(block.keys), bool)
        for row in range(sketch.depth):
            hits, place = sketch.counters(block.keys, row)
            again = np.zeros(len(hits), bool)
            numbers, edge = sketch.slices(hits)
            for number, a, b in zip(numbers, edge[:-1], edge[1:]):
                again[a:b] = np.unpackbits(np.frombuffer(bits[row, number], np.uint8), count=b - a)
            repeated &= again[place]
        number = docs["block"][0].as_py() if docs.num_rows else 0
        at = (block.second_keys()[repeated] >> np.uint64(32)) | np.uint64(number << 32)
        return pa.table([block.keys[repeated].view(np.int64), at.view(np.int64), block.least[repeated]], schema=_arrow(REPEATED))

    return run


def _cut(size: int, schema: pa.Schema):
    known = WordHash()

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(docs["id"].to_pylist(), docs["text"], size, known)
        keys = answers["k1"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        gone = block.removed({"key": keys[order], "least": answers["least"].to_numpy()[order]})
        kept, counts = [], []
        for text, a, b in zip(docs["text"], block.word_at[:-1], block.word_at[1:]):
            words = _words(text)
            out = gone[a:b]
            counts.append(int(out.sum()))
            if counts[-1]:
                words = [w for w, g in zip(words, out.tolist()) if not g]
            kept.append(b" ".join(words).decode())
        return pa.table([docs["id"], pa.array(block.n_words), pa.array(counts, pa.int64()), pa.array(kept, pa.string())], schema=schema)

    return run


def _arrow(ddl: str) -> pa.Schema:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, types[t]) for n, t in (c.split() for c in ddl.split(", "))])


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``id, n_words, n_removed, kept`` of every row: the words kept, joined by one space."""
    spark = docs.sparkSession
    rows = as_row(docs).select(field(id_col).cast("long").alias("id"), field(text_col).alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sketch = Sketch.for_bytes(n_bytes)
    deal = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    blocks = max(1, n_bytes // BLOCK_BYTES, min(deal, n_bytes // LEAST_BLOCK_BYTES))
    rows = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("long").alias("block"), "id", "text")
    by_block = rows.groupBy("block")

    partial = by_block.applyInArrow(_partial_sketch(sketch, size), PARTIAL)
    answers = partial.groupBy("depth", "slice").applyInArrow(_merge(sketch), ANSWER)
    repeated = by_block.cogroup(answers.groupBy("block")).applyInArrow(_estimated(sketch, size), REPEATED)
    # Dealt by the first key, told apart by both: the second one is unpacked after the shuffle.
    repeated = repeated.repartition("k1").withColumn("k2", F.col("at").bitwiseAND((1 << 32) - 1))
    everywhere = Window.partitionBy("k1", "k2")
    smaller = repeated.select("at", "k1", F.min("least").over(everywhere).alias("least"), F.col("least").alias("here")).where("least < here")
    smaller = smaller.select(F.shiftright("at", 32).alias("block"), "k1", "least")
    out = "id long, n_words long, n_removed long, kept string"
    return by_block.cogroup(smaller.groupBy("block")).applyInArrow(_cut(size, _arrow(out)), out)


def _oracle() -> str:
    window = " || ' ' || ".join(f"w[i + {j}]" for j in range(WINDOW))
    return rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
pos AS (SELECT doc_id, i, {window} AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM pos) WHERE doc_id > least),
gone AS (SELECT doc_id, list(DISTINCT p) AS p FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM again) GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
out AS (SELECT doc_id, unnest(p) AS i FROM gone),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN out USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


ORACLE = _oracle()
