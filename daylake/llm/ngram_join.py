r"""N-gram Jaccard join by T-occurrence search.

Two documents link if their sets of word shingles have a Jaccard coefficient of ``percent`` / 100 or more.
They then share at least T = ceil(percent * n / 100) shingles, n the size of either set.  All steps are exact:

1. Documents with equal sets are one class; classes are compared.
2. *Count filter.*  In the order of the shingles' hashes, two linked sets share m shingles among their first n - T + m.
   A class stays only if enough of its first shingles occur in another class, too.
   A map task settles shingles that come more than once among its own rows and sends one mark for each, so a
   very common shingle is one row a task, not one a document.
3. Of the classes that stay, shingles are ordered by their number of classes, rarest first.  Shingles of one class alone
   are dropped; a class with fewer than T others has no link.  Linked classes share one of the rarest ones (the
   short lists left when the T - 1 longest are set aside), so classes in touch through these form regions, and links stay inside.
4. *T-occurrence search* inside a region (DivideSkip): a heap merges the short inverted lists of a query's shingles, and
   classes met often enough are probed in the long lists by binary search.  A few central classes are
   first compared with the whole region.  What hangs together by that needs no queries of its own: any link not yet known
   has an end outside.  So a region of copies costs a few passes, not all pairs.
   Large regions (chains of sets that share a rare shingle) are taken apart first: linked sets share their 8 rarest common shingles
   in both prefixes, so pairs without a shingle of a long list are told by counting short lists, and only sets in touch through
   long lists stay together.  What is large still is split into blocks, and its queries into chunks of the same size; every chunk
   meets every block.
5. Links of all blocks are joined to components.

Defined cases
  null or blank text       the empty set, linked with nothing
  very long text           read whole; its set is one row
  fewer words than a shingle   the whole sequence is the one shingle
  null id                  takes part; a component's name is its smallest id, null if all are null
  repeated rows            are equal sets: one class; :func:`without_copies` keeps one row of them
  one id, several texts    each row is judged by its own text
  empty table              no rows
  extra columns            ignored by :func:`link`, kept by :func:`without_copies`
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daylake.llm.common import as_row, field, keep_table, small_batches
from daylake.llm.components import components

SHINGLE = 4
PERCENT = 85
# Ids known to be this few are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 500_000
# Shingles that a map task settles among themselves.
CHUNK_SHINGLES = 1_000_000
# A region of more shingles is split into blocks of about so many.
BLOCK_SHINGLES = 4_000_000
# In a large region: lists of up to so many sets tell their pairs, and so many of a linked pair's rarest shared shingles are looked at.
SHORT_LIST = 16
SHARED = 8
# Central classes of a region that are compared with all of it.
PIVOTS = 16
# Entries of short lists that are merged by a heap; more are counted by one pass over an array.
HEAP_ENTRIES = 2_000
# Characters of the longest word whose hash a task remembers.
LONG_WORD = 48
# DivideSkip: a query sets T / (SHARE * log2(longest list) + 1) lists aside as long.
SHARE = 0.0085

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
# Odd multipliers that tell the places in a shingle apart and spread bits.
MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
STEP = 0x9E3779B97F4A7C15


def least_shared(n, percent: int):
    """T: shingles that a set of n shares with any set it links to.  Works on ints, arrays and columns."""
    return -((-n * percent) // 100)


def slack(n):
    """m of the count filter for a set of n."""
    return n // 10 + 1


class Shingler:
    """Text -> sorted distinct 64-bit hashes of its shingles.  Remembers words' hashes, up to a bound."""

    def __init__(self, size: int, words: int = 100_000):
        self.size, self.bound, self.known = size, words, {}
        self.steps = [np.uint64((STEP * (2 * i + 1)) & 0xFFFFFFFFFFFFFFFF) for i in range(size)]

    def __call__(self, text: str | None) -> np.ndarray:
        words = WORD.findall((text or "").translate(LOWER))
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.size:
            return np.array([xxhash.xxh64_intdigest(" ".join(words), 7)], np.uint64)
        known = self.known
        if len(known) > self.bound:
            known.clear()
        long = []
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
                if len(w) > LONG_WORD:
                    long.append(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        for w in long:  # only short words are remembered, so the bound on words is one on memory
            known.pop(w, None)
        n = len(words) - self.size + 1
        out = np.zeros(n, np.uint64)
        for i, step in enumerate(self.steps):
            out = (out ^ (h[i : i + n] * step)) * MIX[0]
            out ^= out >> np.uint64(29)
        out *= MIX[1]
        out ^= out >> np.uint64(32)
        return np.unique(out)


def _set_keys(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two longs."""
    digest = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _first_pass(shingle: int, percent: int, id_type: pa.DataType):
    """Per document: id, name of the row (r1, r2), n, key of its set (k1, k2), the first shingles that no other set of the task's chunk has
    (``alone``), how many others there are (``met``), and the marks sent for those (``marks``: shingle, lowest and highest k1, flat)."""
    names = ["id", "r1", "r2", "n", "k1", "k2", "met", "alone", "marks"]

    def settle(ids, sizes, keys, firsts) -> pa.RecordBatch:
        ids, r1, r2 = zip(*ids)
        k1 = np.array([k[0] for k in keys], np.int64)
        # Copies in a chunk are one set: only the first of each key sends shingles.
        _, lead = np.unique(k1, return_index=True)
        is_lead = np.zeros(len(keys), bool)
        is_lead[lead] = True
        counts = np.array([len(f) if is_lead[i] else 0 for i, f in enumerate(firsts)], np.int64)
        flat = np.concatenate([f for i, f in enumerate(firsts) if is_lead[i]] or [np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(keys)), counts)
        order = np.argsort(flat, kind="stable")
        s, o = flat[order], owner[order]
        edge = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.empty(0, np.int64)
        size = np.diff(np.append(edge, len(s)))
        group = np.repeat(np.arange(len(edge)), size)
        many = size[group] > 1
        met = np.bincount(o[many], minlength=len(keys))
        mine, token = o[~many], s[~many].view(np.int64)
        by = np.argsort(mine, kind="stable")
        alone = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(np.bincount(mine, minlength=len(keys))))).astype(np.int32), pa.array(token[by]))
        # One mark for each shingle that several sets of the chunk have, with the first and the last of these by key.
        heads = edge[size > 1]
        low = np.minimum.reduceat(k1[o], edge)[size > 1] if len(edge) else np.empty(0, np.int64)
        high = np.maximum.reduceat(k1[o], edge)[size > 1] if len(edge) else np.empty(0, np.int64)
        triple = np.stack([s[heads].view(np.int64), low, high], 1) if len(heads) else np.empty((0, 3), np.int64)
        sender = o[heads]
        by = np.argsort(sender, kind="stable")
        ends = np.concatenate(([0], 3 * np.cumsum(np.bincount(sender, minlength=len(keys))))).astype(np.int32)
        marks = pa.ListArray.from_arrays(ends, pa.array(triple[by].reshape(-1)))
        met = pa.array(np.where(is_lead, met, 0), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_type), pa.array(r1, pa.int64()), pa.array(r2, pa.int64()), pa.array(sizes, pa.int64()), pa.array(k1), pa.array([k[1] for k in keys], pa.int64()), met, alone, marks], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of = Shingler(shingle)
        ids, sizes, keys, firsts, held = [], [], [], [], 0
        for batch in batches:
            for ident, text in zip(zip(*(batch.column(c).to_pylist() for c in ("id", "r1", "r2"))), batch.column("text")):
                all_of = shingles_of(text.as_py())
                n = len(all_of)
                first = all_of[: n - least_shared(n, percent) + slack(n)] if n else all_of
                ids.append(ident)
                sizes.append(n)
                keys.append(_set_keys(all_of))
                firsts.append(first.copy())
                held += len(first)
                if held >= CHUNK_SHINGLES:
                    yield settle(ids, sizes, keys, firsts)
                    ids, sizes, keys, firsts, held = [], [], [], [], 0
        if ids:
            yield settle(ids, sizes, keys, firsts)

    return run


def _staying(rows: DataFrame, percent: int) -> DataFrame:
    """``k1`` of the sets that pass the count filter."""
    own = rows.select(F.explode("alone").alias("token"), F.col("k1").alias("low"), F.col("k1").alias("high"), F.lit(True).alias("own"))
    triples = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("marks") / 3).cast("int") - 1),
        lambda i: F.struct(F.get("marks", i * 3).alias("token"), F.get("marks", i * 3 + 1).alias("low"), F.get("marks", i * 3 + 2).alias("high")),
    )
    marks = rows.where(F.size("marks") > 0).select(F.explode(triples).alias("m")).select("m.*", F.lit(False).alias("own"))
    marked = marks.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).withColumn("own", F.lit(False))
    # A shingle of two sets or more: its lowest and highest keys differ.  One row a chunk at most stands for a shingle.
    by = own.unionByName(marked)
    group = Window.partitionBy("token")
    shared = by.withColumn("shared", F.min("low").over(group) != F.max("high").over(group)).where("own and shared")
    met = shared.select(F.col("low").alias("k1"), F.lit(1).alias("met")).unionByName(rows.where("met > 0").select("k1", "met"))
    counts = met.groupBy("k1").agg(F.sum("met").alias("met"))
    sizes = rows.where("n > 0").groupBy("k1").agg(F.min("n").alias("n"))
    # A linked set has T shingles at least, so its slack is that of T at least.
    least = -F.floor(-F.col("n") * percent / 100)
    return counts.join(sizes, "k1").where(F.col("met") >= F.floor(least / 10) + 1).select("k1")


def _only(df: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Semi or anti join with a key table: broadcast if it is counted small, else shuffled and hashed."""
    small = keys.count() <= BROADCAST_IDS
    right = keys.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(on)])
    right = F.broadcast(right) if small else right.hint("shuffle_hash")
    return df.join(right, [df[c].eqNullSafe(right[f"_key{i}"]) for i, c in enumerate(on)], how)


def _row_name(ident, text) -> list:
    """128 bits that name rows of one id and one text, as two long columns ``r1, r2``."""
    return [F.xxhash64(ident, text).alias("r1"), F.xxhash64(F.lit(1), ident, text).alias("r2")]


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """``k1, k2, n, tokens`` of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of = Shingler(shingle)
        for batch in batches:
            made = [shingles_of(t.as_py()) for t in batch.column("text")]
            keys = [_set_keys(m) for m in made]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([len(m) for m in made], pa.int64()),
                    pa.array([m.view(np.int64) for m in made], pa.list_(pa.int64())),
                ],
                ["k1", "k2", "n", "tokens"],
            )

    return rows.select("text").mapInArrow(run, "k1 long, k2 long, n long, tokens array<long>")


class Index:
    """Inverted lists over a block of sets.  ``tokens``: a sorted array per set; ``sizes``: their whole sizes."""

    def __init__(self, tokens: list[np.ndarray], sizes: np.ndarray, percent: int):
        self.tokens, self.sizes, self.percent = tokens, sizes, percent
        self.flat = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
        lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(lengths)))
        owner = np.repeat(np.arange(len(tokens)), lengths)
        order = np.argsort(self.flat, kind="stable")
        self.words, first = np.unique(self.flat[order], return_index=True)
        self.owners = owner[order]
        self.ends = np.append(first, len(order))

    def linked(self, shared: np.ndarray, size: int, others: np.ndarray) -> np.ndarray:
        return 100 * shared >= self.percent * (size + self.sizes[others] - shared)

    def scan(self, tokens: np.ndarray, size: int) -> np.ndarray:
        """Sets linked to one set, by comparing it with the whole block."""
        at = np.minimum(np.searchsorted(tokens, self.flat), max(len(tokens) - 1, 0))
        same = tokens[at] == self.flat if len(tokens) else np.zeros(len(self.flat), bool)
        shared = np.concatenate(([0], np.cumsum(same)))
        shared = shared[self.starts[1:]] - shared[self.starts[:-1]]
        return np.flatnonzero(self.linked(shared, size, np.arange(len(self.tokens))))

    def search(self, tokens: np.ndarray, size: int) -> np.ndarray:
        """Sets linked to one set, by T-occurrence search."""
        need = least_shared(size, self.percent)
        at = np.searchsorted(self.words, tokens)
        hit = at[(at < len(self.words))]
        hit = hit[self.words[hit] == tokens[at < len(self.words)]]
        if len(hit) < need:
            return np.empty(0, np.int64)
        lengths = self.ends[hit + 1] - self.ends[hit]
        hit = hit[np.argsort(lengths, kind="stable")]
        longest = int(lengths.max())
        aside = min(need - 1, int(need / (SHARE * np.log2(max(longest, 2)) + 1)))
        lists = [self.owners[self.ends[i] : self.ends[i + 1]] for i in hit]
        short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
        if sum(map(len, short)) <= HEAP_ENTRIES:
            found, counts = merge_lists([x.tolist() for x in short], need - aside)
            sets, shared = np.array(found, np.int64), np.array(counts, np.int64)
        else:  # the same merge for many entries: count each set's entries at once
            counts = np.bincount(np.concatenate(short), minlength=len(self.tokens))
            sets = np.flatnonzero(counts >= need - aside)
            shared = counts[sets]
        # The coefficient bounds the sizes of linked sets.
        fits = (100 * self.sizes[sets] >= self.percent * size) & (100 * size >= self.percent * self.sizes[sets])
        sets, shared = sets[fits], shared[fits]
        for done, x in enumerate(long):
            open_ = shared + len(long) - done >= need
            sets, shared = sets[open_], shared[open_]
            if not len(sets):
                break
            if len(sets) * 16 > len(self.tokens):  # so many sets left that reading the lists is cheaper than probing them
                shared = shared + np.bincount(np.concatenate(long[done:]), minlength=len(self.tokens))[sets]
                break
            i = np.minimum(np.searchsorted(x, sets), len(x) - 1)
            shared = shared + (x[i] == sets)
        return sets[self.linked(shared, size, sets)]


def merge_lists(lists: list[list[int]], need: int) -> tuple[list[int], list[int]]:
    """Ids that ``need`` of the sorted lists hold, and how many do: a heap of the lists' heads; where too few heads
    agree, the lists that can't matter skip ahead by binary search."""
    heap = [(x[0], i, 0) for i, x in enumerate(lists) if x]
    heapq.heapify(heap)
    ids, counts = [], []
    while len(heap) >= need:
        least, popped = heap[0][0], []
        while heap and heap[0][0] == least:
            popped.append(heapq.heappop(heap))
        if len(popped) >= need:
            ids.append(least)
            counts.append(len(popped))
            target = least + 1
        else:
            # need - 1 lists may be ahead of an id without making it: the others' next head is the least id that can.
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            target = max(heap[0][0], least + 1)
        for _, i, at in popped:
            x = lists[i]
            if x[at] < target:
                at = bisect_left(x, target, at + 1)
            if at < len(x):
                heapq.heappush(heap, (x[at], i, at))
    return ids, counts


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _links_of_region(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that hold a whole region together as its sets' links do (``a, b``: class numbers)."""
    ids, sizes = group["c"].to_numpy(), group["n"].to_numpy()
    tokens = [np.asarray(t, np.int64) for t in group["tokens"]]
    index = Index(tokens, sizes, percent)
    forest = Forest(len(ids))
    links = []

    def take(i: int, others: np.ndarray) -> None:
        for j in others.tolist():
            if forest.join(i, j):
                links.append((ids[i], ids[j]))

    order = np.argsort(group["rare"].to_numpy() / np.maximum(sizes, 1), kind="stable").tolist()
    if len(ids) > 2 * PIVOTS:
        for i in order[:PIVOTS]:
            take(i, index.scan(tokens[i], int(sizes[i])))
    home = int(np.bincount([forest.root(i) for i in range(len(ids))]).argmax())
    # Any link not yet known has an end outside home.  A set that comes home meanwhile needs no query: its links to sets
    # that stay outside are found by theirs.
    for i in order:
        if forest.root(i) != forest.root(home):
            take(i, index.search(tokens[i], int(sizes[i])))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _links_of_block(queries: pd.DataFrame, block: pd.DataFrame, percent: int, scan: bool) -> pd.DataFrame:
    """Links between queries and the sets of a block; one from each query to each part of the block that hangs together by these."""
    index = Index([np.asarray(t, np.int64) for t in block["tokens"]], block["n"].to_numpy(), percent)
    ids = block["c"].to_numpy()
    forest = Forest(len(ids) + len(queries))
    links = []
    for q, (c, n, t) in enumerate(zip(queries["c"], queries["n"], queries["tokens"])):
        t = np.asarray(t, np.int64)
        for j in (index.scan if scan else index.search)(t, int(n)).tolist():
            if forest.join(len(ids) + q, j) and c != ids[j]:
                links.append((c, ids[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _links_by_short_lists(prefixes: DataFrame, lists: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links between sets that share no shingle of a long list.

    Of the shingles that two linked sets share the ``SHARED`` rarest lie in both prefixes, so all of these are in short lists: a
    pair is a candidate if so many short lists hold it (a list of ``SHORT_LIST`` sets holds a bounded number of pairs)."""
    entries = prefixes.join(lists.select("token"), "token")
    a, b = (entries.select("token", F.col("c").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    pairs = a.join(b, "token").where("a < b").groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("k"))
    least = F.least(F.lit(SHARED), *[-F.floor(-F.col(f"n_{x}") * percent / 100) for x in "ab"])
    sizes = (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    pairs = pairs.where((F.col("k") >= least) & sizes)
    of = members.select("c", "tokens")
    pairs = pairs.join(of.toDF("a", "t_a"), "a").join(of.toDF("b", "t_b"), "b")
    shared = F.size(F.array_intersect("t_a", "t_b"))
    return pairs.where(100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")


def links_of_sets(sets: DataFrame, percent: int) -> DataFrame:
    """``sets(c, n, tokens)``, one row a class -> ``a, b``: links that join the classes as all links would.

    ``n`` is the size of the whole set; ``tokens`` may leave out members that no other set has."""
    spark = sets.sparkSession
    postings = sets.select("c", "n", F.explode("tokens").alias("token"))
    lists = postings.groupBy("token").agg(F.count("*").alias("df"), F.min("c").alias("first")).where("df > 1")
    ranked = postings.join(lists, "token").groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token", "first"))).alias("ranked"))
    need = -F.floor(-F.col("n") * percent / 100)
    ranked = ranked.where(F.size("ranked") >= need).withColumn("short", (F.size("ranked") - need + 1).cast("int"))
    ranked = keep_table(
        spark,
        ranked.select(
            "c", "n", F.sort_array("ranked.token").alias("tokens"),
            F.slice("ranked", F.lit(1), F.col("short")).alias("short"),
            F.slice("ranked.token", F.lit(1), (F.col("short") - 1 + F.least(F.lit(SHARED), need)).cast("int")).alias("long"),
            # Shingles few classes have: a central class has few, the fewer the more its others are common.
            F.aggregate("ranked", F.lit(0.0), lambda a, x: a + F.lit(1.0) / x["df"]).alias("rare"),
        ),
        "ngram-ranked",
    )
    touch = ranked.select("c", F.explode("short").alias("s")).select(F.col("c").alias("a"), F.col("s.first").alias("b"), F.col("s.token").alias("token"))
    # ``first`` may itself have dropped out or not have the shingle among its rarest: hang on the smallest class that does.
    hooks = touch.groupBy("token").agg(F.min("a").alias("b"), F.count("*").alias("k")).where("k > 1")
    touch = touch.select("a", "token").join(hooks, "token").where("a <> b").select("a", "b").distinct()
    regions = components(spark, touch, "ngram-regions").select(F.col("node").alias("c"), F.col("component").alias("region"))
    members = ranked.join(regions, "c").select("region", "c", "n", "tokens", "rare")
    members = keep_table(spark, members, "ngram-members")
    weight = members.groupBy("region").agg(F.sum(F.size("tokens")).cast("long").alias("weight"))
    members = members.join(weight, "region")
    out = "a long, b long"
    whole = members.where(F.col("weight") <= BLOCK_SHINGLES).drop("weight")
    links = whole.groupBy("region").applyInPandas(lambda g: _links_of_region(g, percent), out)
    large = keep_table(spark, members.where(F.col("weight") > BLOCK_SHINGLES), "ngram-large")
    if large.isEmpty():
        return links
    # A large region is mostly a chain of sets that share a rare shingle or two.  It is taken apart: pairs are told by short
    # lists, and only sets that share a shingle of a long list stay together.
    prefixes = ranked.join(regions, "c").join(weight.where(F.col("weight") > BLOCK_SHINGLES), "region").select("c", "n", F.explode("long").alias("token"))
    prefixes = keep_table(spark, prefixes, "ngram-prefixes")
    lengths = prefixes.groupBy("token").agg(F.count("*").alias("k"), F.min("c").alias("b")).where("k > 1")
    lengths = keep_table(spark, lengths, "ngram-lengths")
    links = links.unionByName(_links_by_short_lists(prefixes, lengths.where(F.col("k") <= SHORT_LIST), large, percent))
    dense = prefixes.select(F.col("c").alias("a"), "token").join(lengths.where(F.col("k") > SHORT_LIST), "token").where("a <> b").select("a", "b").distinct()
    dense = components(spark, dense, "ngram-dense").select(F.col("node").alias("c"), F.col("component").alias("region"))
    large = keep_table(spark, large.drop("region", "weight").join(dense, "c"), "ngram-dense-members")
    weight = keep_table(spark, large.groupBy("region").agg(F.sum(F.size("tokens")).cast("long").alias("weight")), "ngram-dense-weights")
    large = large.join(weight, "region").select("region", "c", "n", "tokens", "rare", "weight")
    whole = large.where(F.col("weight") <= BLOCK_SHINGLES).drop("weight")
    links = links.unionByName(whole.groupBy("region").applyInPandas(lambda g: _links_of_region(g, percent), out))
    large = keep_table(spark, large.where(F.col("weight") > BLOCK_SHINGLES), "ngram-large")
    if large.isEmpty():
        return links
    # What is large still: blocks of about BLOCK_SHINGLES; the pivots, then the queries of all that is not settled, go to every block.
    n_blocks = F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int")
    # A frame of its own: one side of the cogroups below.
    blocks = large.toDF(*large.columns).withColumn("block", F.pmod(F.xxhash64("c"), n_blocks).cast("int"))
    salted = large.withColumn("salt", F.pmod(F.xxhash64("c", F.lit(1)), F.lit(PIVOTS)))
    best = salted.groupBy("region", "salt").agg(F.min(F.struct((F.col("rare") / F.col("n")).alias("r"), "c")).alias("p"))
    pivots = large.join(best.select(F.col("p.c").alias("c")), "c")

    def against_blocks(queries: DataFrame, scan: bool) -> DataFrame:
        # The queries are cut into chunks, too: both frames of a group hold about BLOCK_SHINGLES.
        chunks = queries.groupBy("region").agg(F.ceil(F.sum(F.size("tokens")) / BLOCK_SHINGLES).cast("int").alias("n_chunks"))
        chunks = keep_table(spark, chunks, "ngram-chunks")
        sent = queries.join(chunks, "region").withColumn("chunk", F.pmod(F.xxhash64("c", F.lit(2)), "n_chunks").cast("int")).drop("n_chunks")
        sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        met = blocks.join(chunks.toDF("region", "n_chunks"), "region")
        met = met.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1))).drop("n_chunks")
        left, right = sent.groupBy("region", "block", "chunk"), met.groupBy("region", "block", "chunk")
        return left.cogroup(right).applyInPandas(lambda q, b: _links_of_block(q, b, percent, scan), out)

    first = keep_table(spark, against_blocks(pivots, True), "ngram-pivot-links")
    parts = components(spark, first, "ngram-parts").select(F.col("node").alias("c"), F.col("component").alias("part"))
    placed = large.select("region", "c").join(parts, "c", "left").withColumn("part", F.coalesce("part", "c"))
    sizes = placed.groupBy("region", "part").agg(F.count("*").alias("k"))
    settled = sizes.groupBy("region").agg(F.max_by("part", F.struct("k", "part")).alias("part"))
    open_ = placed.join(settled, ["region", "part"], "left_anti").select("c")
    rest = against_blocks(large.join(open_, "c"), False)
    return links.unionByName(first).unionByName(rest)


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """``id, r1, r2, n, component_id, first`` of every row: its name, the smallest id reachable by links, and the
    least (id, name) reachable, null ids last (both null for the empty set)."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.select("id", "text", *_row_name(F.col("id"), F.col("text")))
    run = _first_pass(shingle, percent, pa.int64())
    rows = texts.mapInArrow(run, "id long, r1 long, r2 long, n long, k1 long, k2 long, met int, alone array<long>, marks array<long>")
    rows = keep_table(spark, rows, "ngram-first")
    staying = keep_table(spark, _staying(rows, percent), "ngram-staying")
    classes = rows.where("n > 0").groupBy("k1", "k2").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "r1", "r2")).alias("first"))
    chosen = _only(classes, staying, ["k1"]).select("k1", "k2", "first.r1", "first.r2")
    chosen = keep_table(spark, chosen, "ngram-chosen")
    # One document of each staying class brings its whole set; equal sets count once.
    again = _only(texts, chosen.select("r1", "r2"), ["r1", "r2"])
    sets = _sets(again, shingle).join(chosen.select("k1", "k2"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    sets = sets.withColumn("c", F.col("k1"))
    sets = keep_table(spark, sets, "ngram-sets")
    links = links_of_sets(sets.select("c", "n", "tokens"), percent)
    found = components(spark, links, "ngram-links").select(F.col("node").alias("k1"), "component")
    named = classes.join(found, "k1").groupBy("component").agg(F.min("first").alias("named"))
    labels = found.join(named, "component").select("k1", "named")
    classes = classes.join(labels, "k1", "left").select("k1", "k2", F.coalesce("named", "first").alias("first"))
    labelled = rows.select("id", "r1", "r2", "n", "k1", "k2").join(classes, ["k1", "k2"], "left")
    return labelled.select("id", "r1", "r2", "n", F.col("first.id").alias("component_id"), "first")


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``<id_col>, n_shingles, component_id`` of every document: the smallest id reachable by links, its own included."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return _labelled(docs, id_col, text_col, shingle, percent).select(
        F.col("id").cast(kind).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).cast(kind).alias("component_id"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of ``docs`` whose texts link, directly or through others: one with the smallest id (null last),
    among several texts of this id the one least by hash.  Rows whose texts have no words link to nothing and stay."""
    spark = docs.sparkSession
    linked = _labelled(docs, id_col, text_col, shingle, percent).where("n > 0")
    named = linked.groupBy("r1", "r2", ((F.col("r1") == F.col("first.r1")) & (F.col("r2") == F.col("first.r2"))).alias("stays"))
    # Small: only rows that go, and the names that several rows have.
    told = keep_table(spark, named.agg(F.count("*").alias("k")).where("not stays or k > 1"), "ngram-told")
    rows = as_row(docs)
    rows = rows.select("row", *_row_name(field(id_col).cast("long"), field(text_col)))
    kept = _only(rows, told, ["r1", "r2"], "left_anti").select("row")
    again = keep_table(spark, told.where("stays"), "ngram-repeated")
    if not again.isEmpty():
        # Each task brings one row of a name at most, so a text of very many rows is no large group.
        one = _only(rows, again, ["r1", "r2"]).groupBy("r1", "r2").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
        kept = kept.unionByName(one.select("row"))
    return kept.select("row.*")


ORACLE = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
                     ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM s),
t AS (SELECT doc_id, unnest(s) AS g FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * o >= {PERCENT} * (x.n_shingles + y.n_shingles - o)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, n_shingles, c AS component_id FROM n JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = doc_id
"""
