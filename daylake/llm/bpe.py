"""Byte-level BPE encoding and decoding: speculate, verify, repair.

Greedy longest match proposes the tokens of a word.  A proposal is the true BPE result
if every token is what BPE makes of its own bytes and every adjacent pair of tokens
is compatible: BPE over the two tokens' bytes would not have merged across the border.
Compatibility needs only the merge table, so it is checked for all
pairs of a slice of texts at once with numpy.  Words with a failing pair are
merged exactly, in rank order.

Tokenizer files are read on the driver (their path is a parameter) and broadcast; a
file's size is bounded by ``MAX_TOKENIZER_BYTES``.

Defined cases
  null text       encoded as the empty text: no ids; decodes to the empty text
  special tokens  their strings in a text become their ids, as in the tokenizers library
  very long text  encoded whole, by one task
  repeated rows   encoded each
  ties            of equal ranks the left pair is merged first
  empty table     no rows
  extra columns   kept; a column with the name of an output column is replaced
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daylake.llm.common import small_batches

MAX_TOKENIZER_BYTES = 64 << 20
# Texts are encoded in slices of about so many characters, which bounds a worker's memory.
SLICE_CHARS = 1_500_000
# Pieces a worker remembers in each of two generations: a full one becomes the old one, and
# pieces met again move over, so frequent ones stay.
CACHE_PIECES = 200_000
# Longer pieces (in characters) are forgotten after each slice, so the bound on pieces is one on memory.
LONG_PIECE = 48
FAR = np.int64(1) << 40

# Unicode white space.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A text falls into runs without white space (each with one space before it, if there is one)
# and the rest of the white space; contractions, letters, digits and signs are told apart inside a run.
RUNS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
PARTS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+")


def _byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE tokenizer read from a tokenizers JSON file."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without a normalizer or a space put first")
        if model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("unsupported BPE options")
        added = spec.get("added_tokens") or []
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
            raise ValueError("added tokens that strip or match whole words only are not supported")
        names = _byte_names()
        vocab: dict[str, int] = model["vocab"]
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in added)])
        self.ids = {bytes(names[c] for c in token): i for token, i in vocab.items()}
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in self.ids.items():
            self.bytes_of[i] = token
        self.special = {t["content"]: t["id"] for t in added}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        by_length = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        # A trie over the tokens: (node, byte) -> node, and the token that ends at a node.
        self.steps: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for token, i in self.ids.items():
            node = 0
            for byte in token:
                node = self.steps.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = i
        if any((one := bytes([b])) not in self.ids for b in range(256)):
            raise ValueError(f"the vocabulary lacks byte {one!r}")
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]

        self.rank = np.full(self.size, -1, np.int64)
        self.left = np.zeros(self.size, np.int64)
        self.right = np.zeros(self.size, np.int64)
        self.merges: dict[tuple[int, int], int] = {}  # pair -> rank
        self.made: list[int] = []  # rank -> token
        sound = np.ones(self.size, bool)
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[a], vocab[b]
            made = vocab[a + b]
            if pair in self.merges:
                raise ValueError(f"the merge {a} {b} is listed twice")
            if self.rank[made] >= 0 or rank <= max(self.rank[pair[0]], self.rank[pair[1]]):
                sound[made] = False  # made in two ways or out of order: words with it go to exact merging
            self.merges[pair] = rank
            self.made.append(made)
            self.rank[made], self.left[made], self.right[made] = rank, *pair
        keys = np.array([a * self.size + b for a, b in self.merges], np.int64)
        ranks = np.array([*self.merges.values()], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], ranks[order]
        self.usable = self._usable(sound)
        self.packed = [i.to_bytes(4, "little") for i in range(self.size)]
        self.cache: dict[str, bytes] = {}
        self.old_cache: dict[str, bytes] = {}
        self.long: list[str] = []

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.pair_keys):
            return np.full(len(a), FAR)
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], FAR)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair: would BPE leave the border between the two tokens alone?

        The merges that made the two tokens are undone from the last to the first.  Each state on the way
        is one in which a part of ``a`` lies next to a part of ``b``; a merge of the two that ranks before the merge that
        takes one of them away would have crossed the border (of equal ranks the left one goes first).
        ``limit``: the rank at which both tokens are taken away together; none if absent.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        until_x = np.full(len(a), FAR) if limit is None else limit.astype(np.int64)
        until_y = until_x.copy()
        while len(live):
            across = self._pair_rank(x, y)
            crossed = (across < until_x) & (across <= until_y)
            good[live[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            undo_x = rx > ry
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            until_x, until_y = np.where(undo_x, rx, until_x)[go], np.where(undo_x, until_y, ry)[go]
            x, y = np.where(undo_x, self.right[x], x)[go], np.where(undo_x, y, self.left[y])[go]
            live = live[go]
        return good

    def _usable(self, sound: np.ndarray) -> np.ndarray:
        """Tokens that BPE makes of their own bytes."""
        made = np.flatnonzero(self.rank >= 0)
        usable = np.zeros(self.size, bool)
        usable[self.byte_ids] = True
        sound[made] &= self.compatible(self.left[made], self.right[made], self.rank[made])
        for t in made[np.argsort(self.rank[made])]:
            usable[t] = sound[t] and usable[self.left[t]] and usable[self.right[t]]
        return usable

    def _propose(self, word: bytes) -> list[int]:
        steps, ends, out, at, n = self.steps, self.ends, [], 0, len(word)
        while at < n:
            node, here = 0, at
            while here < n:
                node = steps.get(node << 8 | word[here])
                if node is None:
                    break
                here += 1
                if ends[node] >= 0:
                    token, at = ends[node], here
            out.append(token)
        return out

    def merge_exactly(self, word: bytes) -> list[int]:
        """The word's tokens by merging in rank order, leftmost first."""
        parts = [self.byte_ids[b] for b in word]
        return self._merge_short(parts) if len(parts) <= 48 else self._merge_long(parts)

    def _merge_short(self, parts: list[int]) -> list[int]:
        rank, none = self.merges.get, 1 << 40
        ranks = [rank(p, none) for p in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            parts[i : i + 2] = [self.made[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), none)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same with a heap and links to the neighbours, n log n in the word's length."""
        rank = self.merges.get
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap = [(r, i) for i, p in enumerate(zip(parts, parts[1:])) if (r := rank(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or rank((parts[i], parts[j])) != r:
                continue  # one of the two has gone into another token meanwhile
            parts[i], parts[j] = self.made[r], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := rank((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (r, a))
        return [p for p in parts if p >= 0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The tokens of every word: proposed, verified together, repaired where needed."""
        proposed = [self._propose(w) for w in words]
        if not words:
            return []
        flat = np.fromiter((t for p in proposed for t in p), np.int64)
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        owner = np.repeat(np.arange(len(proposed)), lengths)
        bad = np.zeros(len(proposed), bool)
        bad[owner[~self.usable[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        if len(inner):
            pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
            good = self.compatible(pairs // self.size, pairs % self.size)
            bad[owner[inner[~good[back]]]] = True
        for i in np.flatnonzero(bad):
            proposed[i] = self.merge_exactly(words[i])
        return proposed

    def _learn(self, pieces: list[str]) -> None:
        """Put pieces (runs between white space) and the words they consist of into the cache."""
        cache, old, packed = self.cache, self.old_cache, self.packed.__getitem__
        cache.update((p, old[p]) for p in pieces if p in old)
        pieces = [p for p in pieces if p not in cache]
        parts = [[p] if p.isascii() and p.lstrip(" ").isalpha() else PARTS.findall(p) for p in pieces]
        words = [w for w in dict.fromkeys(w for ws in parts for w in ws) if w not in cache]
        cache.update((w, old[w]) for w in words if w in old)
        words = [w for w in words if w not in cache]
        for word, ids in zip(words, self.encode_words([w.encode() for w in words])):
            cache[word] = b"".join(map(packed, ids))
        for piece, ws in zip(pieces, parts):
            if len(ws) > 1:
                cache[piece] = b"".join([cache[w] for w in ws])
        self.long += [p for p in pieces if len(p) > LONG_PIECE]
        self.long += [w for w in words if len(w) > LONG_PIECE]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, packed as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHE_PIECES:
            self.cache, self.old_cache = {}, self.cache
        plans: list[list] = []
        unseen: dict[str, None] = {}
        for text in texts:
            plan: list = []
            for k, segment in enumerate(self.special_at.split(text) if self.special_at else [text]):
                if k % 2:
                    plan.append(self.special[segment])
                elif segment:
                    runs = RUNS.findall(segment)
                    unseen.update(dict.fromkeys(r for r in runs if r not in self.cache))
                    plan.append(runs)
            plans.append(plan)
        if unseen:
            self._learn(list(unseen))
        get = self.cache.__getitem__
        out = [b"".join(x.to_bytes(4, "little") if isinstance(x, int) else b"".join(map(get, x)) for x in plan) for plan in plans]
        for piece in self.long:
            self.cache.pop(piece, None)
        self.long.clear()
        return out

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary nothing."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        table = self.bytes_of
        if numbers and max(numbers) >= self.size:
            numbers = [i for i in numbers if i < self.size]
        return b"".join([table[i] for i in numbers]).decode("utf-8", "replace")


_LOADED: dict[str, ByteBpe] = {}


def _tokenizer(content: bytes) -> ByteBpe:
    key = hashlib.sha256(content).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe(content)
    return _LOADED[key]


def _content(path: str) -> bytes:
    with open(path, "rb") as f:
        content = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(content) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} is larger than {MAX_TOKENIZER_BYTES} bytes")
    return content


def _slices(batch: pa.RecordBatch, column: str, chars: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about so many bytes each."""
    data = batch.column(column)
    sizes = np.array([v.as_buffer().size if isinstance(v, (pa.StringScalar, pa.LargeStringScalar, pa.BinaryScalar, pa.LargeBinaryScalar)) and v.is_valid else 0 for v in data], np.int64)
    group = (np.cumsum(sizes) - sizes) // chars
    starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _outputs(docs: DataFrame, added: list[T.StructField]) -> tuple[list[str], T.StructType]:
    names = {f.name for f in added}
    kept = [f for f in docs.schema.fields if f.name not in names]
    return [f.name for f in kept], T.StructType([*kept, *added])


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    text_col: str = "text",
    ids_col: str = "ids",
    count_col: str = "n_tokens",
    packed: bool = False,
    decoded_col: str | None = None,
) -> DataFrame:
    """The columns of ``docs`` with ``ids_col`` and ``count_col`` (long) of every whole text.

    ids are ``array<int>``, or with ``packed`` a binary of little-endian unsigned 32-bit integers.
    ``decoded_col`` adds the text that the ids decode to, made in the same pass.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_content(tokenizer_path))
    added = [
        T.StructField(ids_col, T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)),
        T.StructField(count_col, T.LongType()),
    ]
    if decoded_col:
        added.append(T.StructField(decoded_col, T.StringType()))
    kept, schema = _outputs(docs, added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _tokenizer(shared.value)
        for batch in batches:
            for part in _slices(batch, text_col, SLICE_CHARS):
                ids = bpe.encode_batch([t or "" for t in part.column(text_col).to_pylist()])
                counts = [len(x) // 4 for x in ids]
                if packed:
                    arrays = [pa.array(ids, pa.binary())]
                else:
                    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                    arrays = [pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), "<i4")))]
                arrays.append(pa.array(counts, pa.int64()))
                if decoded_col:
                    arrays.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + arrays, [*kept, *(f.name for f in added)])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The columns of ``encoded`` with the text of its ids (``array<int>`` or packed binary; null ids: the empty text)."""
    shared = encoded.sparkSession.sparkContext.broadcast(_content(tokenizer_path))
    kept, schema = _outputs(encoded, [T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _tokenizer(shared.value)
        for batch in batches:
            ids = [x if isinstance(x, bytes) else np.array(x or [], "<u4").tobytes() for x in batch.column(ids_col).to_pylist()]
            texts = pa.array([bpe.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [texts], [*kept, text_col])

    return encoded.mapInArrow(run, schema)
