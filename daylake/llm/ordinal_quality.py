r"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - w.x) with one weight vector w for all grades and ordered thresholds.
x are hashed text features, each present or not: the words (letters and digits, lower case); their beginnings,
with how often each comes (at least 1, 2, 3, 5 times); how large a share of the words
has each shape (letters, capitals, digits, signs); how many words differ; and the length.
A run longer than ``LONG`` characters, as in a text without spaces, is parted at its signs, and what is still longer
into overlapping pieces of ``PIECE`` characters; so every character of a text takes part.
The model gives the expected grade and the probability of the top grades, by which documents are selected.

It is fitted on the driver from a bounded sample of rated documents (``MAX_RATED``, chosen by a
hash of the id); features are made by tasks, and every document is scored.

Defined cases
  null text        as the empty text: only its length feature speaks
  very long text   read whole, and so is a long word (in pieces); work grows with its length
  ties             of rated rows with equal hashes of id or text any one, they are equal
  null rating      not used; null toxicity counts as not toxic
  rated repeatedly the lowest grade counts
  one grade or none among the ratings   nothing to tell apart: every document gets that grade (or the top one) and is kept
  repeated rows    scored each; of rows with one rated id the one with the least hash of its text is fitted
  empty table      no rows
  extra columns    kept; a column with the name of an output column is replaced
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.llm.common import as_row, small_batches

BUCKETS = 1 << 18
MAX_RATED = 10_000
SEED = 17
# A feature counts if so many rated documents have it, and if at some threshold the share of low grades among these
# is so many standard errors from the share among all.
MIN_DOCS = 3
MIN_ERRORS = 4.0
L2 = 0.1
STEPS = 250
MIN_TAIL = 0.5
CACHE_WORDS = 60_000

CORE = re.compile(r"[^\W_]+")
PARTS = re.compile(r"[^\W_]+|[\W_]+")
LONG = 32
PIECE = 4
RUN = re.compile(r"(.)\1+")


class _Shape(dict):
    def __missing__(self, c: int) -> str:
        ch = chr(c)
        kind = "A" if ch.isupper() else "a" if ch.isalpha() else "0" if ch.isdigit() else ch
        self[c] = kind
        return kind


_SHAPE = _Shape()


# A word's beginning, and how often it comes to count as a feature of its own.
STEM = 5
TIMES = (1, 2, 3, 5)


def _bucket(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature) % BUCKETS


def words_of(text: str | None) -> Counter:
    """How often each word comes; long ones in their pieces."""
    words = Counter((text or "").split())
    for word in [w for w in words if len(w) > LONG]:
        count = words.pop(word)
        for part in PARTS.findall(word):
            if len(part) <= LONG:
                words[part] += count
            else:
                for piece, n in Counter(part[i : i + PIECE] for i in range(len(part) - PIECE + 1)).items():
                    words[piece] += count * n
    return words


class Features:
    """Text -> sorted buckets of its features.  Remembers the words it has met, up to a bound."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, str, str]] = {}

    def _word(self, word: str) -> tuple[int, str, str]:
        core = "".join(CORE.findall(word)).lower()
        shape = RUN.sub(r"\1", word.translate(_SHAPE))
        made = _bucket("w" + core), core[:STEM] if len(core) >= STEM else "", shape
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        self.known[word] = made
        return made

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        n = words.total()
        known = self.known
        buckets = set()
        shapes: dict[str, int] = {}
        stems: dict[str, int] = {}
        for word, count in words.items():
            bucket, stem, shape = known.get(word) or self._word(word)
            buckets.add(bucket)
            shapes[shape] = shapes.get(shape, 0) + count
            if stem:
                stems[stem] = stems.get(stem, 0) + count
        for stem, count in stems.items():
            for least in TIMES:
                if count >= least:
                    buckets.add(_bucket(f"b{stem} {least}"))
        for shape, count in shapes.items():
            buckets.add(_bucket(f"s{shape} {int(np.log2(128 * count / n))}"))
        long = n.bit_length()
        buckets.add(_bucket(f"n{long}"))
        if n:
            buckets.add(_bucket(f"d{long} {10 * len(words) // n}"))
        return np.sort(np.fromiter(buckets, np.int32, len(buckets)))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # of grades 0 .. top - 1; infinite where the sample could not tell grades apart

    @property
    def top(self) -> int:
        return len(self.thresholds)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. top, a column each."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(rows: list[np.ndarray], grades: np.ndarray, top: int, l2: float = L2, steps: int = STEPS, min_docs: int = MIN_DOCS, min_errors: float = MIN_ERRORS) -> Model:
    """Maximum penalised likelihood by Adam over the whole sample."""
    weights = np.zeros(BUCKETS)
    present = np.unique(grades)
    if len(present) < 2:
        level = present[0] if len(present) else top
        return Model(weights, np.where(np.arange(top) < level, -np.inf, np.inf))
    # Grades that do not occur share the threshold of the next one that does.
    level = np.searchsorted(present, grades)
    k = len(present)
    flat = np.concatenate(rows)
    docs = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    df = np.bincount(flat, minlength=BUCKETS)
    apart = np.zeros(BUCKETS)
    for j in range(k - 1):
        low = (level <= j).astype(float)
        share = low.mean()
        errors = np.sqrt(np.maximum(df, 1) * share * (1 - share))
        apart = np.maximum(apart, np.abs(np.bincount(flat, low[docs], BUCKETS) - df * share) / errors)
    used = np.flatnonzero((df >= min_docs) & (apart >= min_errors))
    column = np.full(BUCKETS, -1)
    column[used] = np.arange(len(used))
    held = column[flat] >= 0
    cols, docs = column[flat[held]], docs[held]
    n = len(rows)
    below = np.array([(level <= j).mean() for j in range(k - 1)])
    first = np.log(below / (1 - below))
    # thresholds = first gap, then exp of the rest: always in order
    free = np.concatenate(([first[0]], np.log(np.maximum(np.diff(first), 1e-3))))
    params = np.concatenate((np.zeros(len(used)), free))
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, g = params[: len(used)], params[len(used) :]
        cuts = np.cumsum(np.concatenate(([g[0]], np.exp(g[1:]))))
        score = np.bincount(docs, w[cols], n)
        edge = np.concatenate(([-np.inf], cuts, [np.inf]))
        hi, lo = _sigmoid(edge[level + 1] - score), _sigmoid(edge[level] - score)
        p = np.maximum(hi - lo, 1e-12)
        d_score = 1 - hi - lo
        d_cut = np.zeros(k + 1)
        np.add.at(d_cut, level + 1, -hi * (1 - hi) / p)
        np.add.at(d_cut, level, lo * (1 - lo) / p)
        d_cut = d_cut[1:-1]
        rest = np.cumsum(d_cut[::-1])[::-1]
        d_free = np.concatenate(([rest[0]], rest[1:] * np.exp(g[1:])))
        grad = np.concatenate((np.bincount(cols, d_score[docs], len(used)) + l2 * w, d_free))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w, g = params[: len(used)], params[len(used) :]
    weights[used] = w
    cuts = np.cumsum(np.concatenate(([g[0]], np.exp(g[1:]))))
    # threshold_j parts grades <= j from the rest
    thresholds = np.array([cuts[i - 1] if 0 < (i := int((present <= j).sum())) < k else (-np.inf if i == 0 else np.inf) for j in range(top)])
    return Model(weights, thresholds)


def grade_of(quality: Column, toxic: Column) -> Column:
    """0: toxic; 1: poor; 2: good.  Toxic is the lowest: each toxic word more speaks for it, with no grade to overshoot."""
    return F.when(quality.isNull(), F.lit(None)).when(F.coalesce(toxic, F.lit(0)) > 0, 0).when(quality <= 0, 1).otherwise(2)


def train(docs: DataFrame, rated: DataFrame, top: int = 2, id_col: str = "doc_id", text_col: str = "text", max_rated: int = MAX_RATED, **options) -> Model:
    """Fit on ``rated(<id_col>, grade)``.  At most ``max_rated`` documents are used; above that, those with the smallest hash of the id."""
    sample = (
        rated.where(F.col("grade").isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.min("grade").cast("int").alias("grade"))
        .orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(max_rated)
    )
    # The sample is bounded by its parameter, so it is broadcast; the texts stay where they are.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark")).join(F.broadcast(sample), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            made = [features(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("grade"), batch.column("mark"), pa.array(made, pa.binary())], ["id", "grade", "mark", "x"]
            )

    # One row of each id, so the bound on ids is one on rows; a task sends one row of an id at most.
    made = texts.mapInArrow(run, "id string, grade int, mark long, x binary")
    one = made.groupBy("id", "grade").agg(F.min(F.struct("mark", "x")).alias("least"))
    rows = sorted(map(tuple, one.select("id", "grade", "least.x").collect()))
    return fit([np.frombuffer(bytes(x), np.int32) for _, _, x in rows], np.array([g for _, g, _ in rows], int), top, **options)


def score(docs: DataFrame, model: Model, text_col: str = "text", min_tail: float = MIN_TAIL, column: str | None = None) -> DataFrame:
    """The columns of ``docs`` with ``expected_grade`` and ``p_top`` (P(top grade)), to 6 places, and ``kept``: p_top >= ``min_tail``.
    ``column``: a struct that has the text (it is sent to the workers once)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [T.StructField("expected_grade", T.DoubleType()), T.StructField("p_top", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    kept = [f for f in docs.schema.fields if f.name not in {a.name for a in added}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, model = Features(), shared.value
        for batch in batches:
            texts = batch.column(text_col) if column is None else batch.column(column).field(text_col)
            scores = np.array([model.weights[features(t.as_py())].sum() for t in texts])
            tails = model.tails(scores)
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(tails.sum(axis=1).round(6)), pa.array(tails[:, -1].round(6)), pa.array(tails[:, -1] >= min_tail)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in kept + added])

    return docs.mapInArrow(run, T.StructType(kept + added))


def select(docs: DataFrame, model: Model, text_col: str = "text", min_tail: float = MIN_TAIL) -> DataFrame:
    """The documents kept, with their own columns only."""
    return score(as_row(docs), model, text_col, min_tail, "row").where("kept").select("row.*")
