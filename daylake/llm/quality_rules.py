r"""Quality rules by distribution divergence (DataFrame functions only).

A document's histogram of character classes and its histogram of common words are compared with
its language's reference by Jensen-Shannon distance (root of the divergence, base 2, so 0 to 1).  A document is kept if its base
counts pass and neither histogram is further from the reference than the limit.
A document with fewer than ``MIN_LETTER_WORDS`` words of letters is too short for the word histogram, which is then not asked.
Each row is judged alone: the plan is one scan with no shuffle.

References are parameters; the default ones are rough shares in printed prose, and :func:`fit_references` measures
them on a corpus.  A language
without a reference (or null) is compared with each and judged by the nearest.

Defined cases
  null text      no words, all counts 0, base_failed
  empty text     as null
  very long text read whole; work grows with its length
  repeated rows  judged each
  ties           none: rows are judged alone (of equally common words :func:`fit_references` takes the first by spelling)
  empty table    no rows
  extra columns  kept in ``row``
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daylake.llm.common import as_row, field, words

# The character classes and what is in each, the most frequent first.  What is in none is the last class, ``other``.
CLASSES = {
    "lower": r"\p{Ll}+",
    "space": r"[\x20\x09-\x0D]+",
    "upper": r"\p{Lu}+",
    "digit": r"\p{Nd}+",
    "mark": r"[.,;:!?'\"()’“”«»¿¡…–—-]+",
}
# Rough shares of the classes, ``other`` last.
CLASS_SHARES = {
    "en": (0.775, 0.175, 0.025, 0.005, 0.02, 0.0),
    "de": (0.78, 0.145, 0.05, 0.005, 0.02, 0.0),
    "fr": (0.775, 0.17, 0.025, 0.005, 0.025, 0.0),
    "es": (0.785, 0.17, 0.02, 0.005, 0.02, 0.0),
}
# Rough shares of the most common words among all words.
WORD_SHARES = {
    "en": {
        "the": 0.06, "of": 0.03, "and": 0.028, "to": 0.026, "a": 0.022, "in": 0.02, "is": 0.011, "that": 0.011,
        "it": 0.01, "for": 0.01, "was": 0.009, "on": 0.007, "with": 0.007, "as": 0.007, "be": 0.006, "by": 0.005,
        "are": 0.005, "this": 0.005, "at": 0.005, "from": 0.004,
    },
    "de": {
        "der": 0.034, "die": 0.033, "und": 0.027, "in": 0.02, "den": 0.012, "von": 0.011, "zu": 0.01, "das": 0.01,
        "mit": 0.009, "sich": 0.008, "auf": 0.007, "für": 0.007, "des": 0.007, "ist": 0.008, "im": 0.007,
        "dem": 0.007, "nicht": 0.007, "ein": 0.006, "eine": 0.006, "als": 0.005,
    },
    "fr": {
        "de": 0.05, "la": 0.03, "le": 0.025, "et": 0.024, "les": 0.022, "des": 0.018, "en": 0.014, "un": 0.013,
        "du": 0.013, "une": 0.011, "que": 0.011, "est": 0.011, "pour": 0.009, "qui": 0.009, "dans": 0.009,
        "par": 0.008, "sur": 0.006, "au": 0.006, "pas": 0.006, "avec": 0.005,
    },
    "es": {
        "de": 0.06, "la": 0.037, "que": 0.03, "el": 0.027, "en": 0.026, "y": 0.026, "los": 0.017, "se": 0.014,
        "las": 0.012, "del": 0.012, "un": 0.011, "por": 0.01, "con": 0.01, "no": 0.01, "una": 0.009, "para": 0.008,
        "su": 0.008, "es": 0.008, "al": 0.007, "lo": 0.006,
    },
}
MAX_CLASS_DISTANCE = 0.2236
MAX_WORD_DISTANCE = 0.3873
MIN_WORDS = 50
MIN_LETTER_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _half(p: Column, q: Column) -> Column:
    """p's half of the Jensen-Shannon sum for one bin."""
    return F.when(p > 0, p * F.log2(p * 2 / (p + q)) * 0.5).otherwise(0.0)


def divergence(p: list[Column], q: list[float]) -> Column:
    """Jensen-Shannon divergence of two histograms over the same bins."""
    terms = []
    for a, share in zip(p, q):
        b = F.lit(float(share))
        terms.append(_half(a, b) + _half(b, a) if share else _half(a, b))
    return reduce(add, terms)


def _by_language(lang: Column, made: dict[str, Column]) -> Column:
    known = None
    for name, value in made.items():
        known = F.when(lang == name, value) if known is None else known.when(lang == name, value)
    return known.otherwise(F.least(*made.values()) if len(made) > 1 else next(iter(made.values())))


def base_counts(df: DataFrame, text: str = "t") -> DataFrame:
    """Adds ``n_words, n_dup_lines, n_repeat_words`` of the column ``text``."""
    t = F.col(text)
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    df = df.withColumns({"w": words(t), "lines": lines})
    w = F.col("w")
    places = F.sequence(F.lit(0), F.size(w) - 3)
    df = df.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "hashes": F.when(F.size(w) > 3, F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))),
        }
    )
    # Only texts in which a window comes again put their windows in order.  Windows are told apart by 64-bit hashes.
    again = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("order", F.when(again, F.sort_array(placed)))
    order = F.col("order")

    # Neighbours of one hash are two places of a window that comes again.
    pairs = F.zip_with(order, F.slice(order, 2, F.size(order)), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))
    starts = F.array_distinct(F.flatten(F.array_compact(pairs)))
    df = df.withColumn("starts", F.when(order.isNotNull(), F.sort_array(starts)))
    s = F.col("starts")
    covered = F.transform(s, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - p, F.lit(3))))
    repeated = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(repeated, F.lit(0)).cast("long")).drop("w", "lines", "hashes", "order", "starts")


def class_counts(df: DataFrame, text: str = "t") -> DataFrame:
    """Adds ``c_<class>`` for each class and ``c_other`` of the column ``text``, ``word_chars`` and ``n_symbols``.

    Each class is taken out of what the ones before it left, so only the first looks at the whole text."""
    left = F.col(text)
    sizes = [F.length(left)]
    for i, pattern in enumerate(CLASSES.values()):
        df = df.withColumn(f"left_{i}", F.regexp_replace(left, pattern, ""))
        left = F.col(f"left_{i}")
        sizes.append(F.length(left))
    counts = {f"c_{c}": a - b for c, a, b in zip(CLASSES, sizes, sizes[1:])}
    space = list(CLASSES).index("space")
    counts["c_other"] = sizes[-1]
    counts["word_chars"] = (sizes[0] - counts["c_space"]).cast("long")
    # No symbol is a lower-case letter or white space.
    counts["n_symbols"] = F.length(F.regexp_replace(F.col(f"left_{space}"), r"[^#*$%&|<>]+", "")).cast("long")
    return df.withColumns(counts).drop(*[f"left_{i}" for i in range(len(CLASSES))])


def distances(
    df: DataFrame,
    text: str = "t",
    lang: str = "lang",
    class_shares: dict[str, tuple[float, ...]] = CLASS_SHARES,
    word_shares: dict[str, dict[str, float]] = WORD_SHARES,
) -> DataFrame:
    """Adds ``class_distance``, ``word_distance`` and ``n_letter_words`` (words of letters); ``df`` has the :func:`class_counts`."""
    classes = [*CLASSES, "other"]
    total = F.greatest(reduce(add, [F.col(f"c_{c}") for c in classes]), F.lit(1)).cast("double")
    df = df.withColumns({f"s_{i}": F.col(f"c_{c}") / total for i, c in enumerate(classes)})
    by_class = {k: divergence([F.col(f"s_{i}") for i in range(len(classes))], list(v)) for k, v in class_shares.items()}
    # Of a document's words of letters only the common ones of any language are kept, each between spaces of its own.
    common = sorted({w for ref in word_shares.values() for w in ref})
    letters = F.col("letters")
    df = df.withColumns({"class_distance": F.sqrt(F.greatest(_by_language(F.col(lang), by_class), F.lit(0.0))), "letters": F.split(F.lower(F.col(text)), r"\P{L}+", -1)})
    edges = [F.when(F.get(letters, F.lit(0)) == "", 1).otherwise(0), F.when((F.size(letters) > 1) & (F.get(letters, F.size(letters) - 1) == ""), 1).otherwise(0)]
    kept = F.array_join(F.filter(letters, lambda x: x.isin(common)), "  ")
    df = df.withColumns({"n_letter_words": F.size(letters) - edges[0] - edges[1], "kept": F.concat(F.lit(" "), kept, F.lit(" "))})
    unknown = ~F.coalesce(F.col(lang).isin(list(word_shares)), F.lit(False))

    def counted(ref: dict[str, float]) -> Column:
        size = F.length("kept")
        return F.array(*[((size - F.length(F.replace(F.col("kept"), F.lit(f" {w} ")))) / (len(w) + 2)).cast("int") for w in ref])

    df = df.withColumns({f"h_{k}": F.when(unknown | (F.col(lang) == k), counted(v)) for k, v in word_shares.items()})

    def told(k: str, ref: dict[str, float]) -> Column:
        # Each common word's count, then what is left, as one array; the reference beside it.
        hits, n = F.col(f"h_{k}"), F.greatest(F.col("n_letter_words"), F.lit(1))
        p = F.concat(hits, F.array((n - F.aggregate(hits, F.lit(0), lambda a, x: a + x)).cast("int")))
        q = F.array(*[F.lit(float(v)) for v in ref.values()], F.lit(1.0 - sum(ref.values())))
        terms = F.zip_with(p, q, lambda a, b: _half(a / n, b) + _half(b, a / n))
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)

    word = _by_language(F.col(lang), {k: told(k, v) for k, v in word_shares.items()})
    df = df.withColumn("word_distance", F.sqrt(F.greatest(word, F.lit(0.0))))
    return df.drop("letters", "kept", *[f"h_{k}" for k in word_shares], *[f"c_{c}" for c in classes], *[f"s_{i}" for i in range(len(classes))])


def fit_references(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", n_words: int = 20
) -> tuple[dict[str, tuple[float, ...]], dict[str, dict[str, float]]]:
    """``class_shares`` and ``word_shares`` as :func:`judge` takes them, measured on the documents of each language.

    Counts are added up by Spark; what comes to the driver is one row and ``n_words`` words a language."""
    df = as_row(docs).select(field(lang_col).alias("lang"), F.coalesce(field(text_col), F.lit("")).alias("t")).where("lang IS NOT NULL")
    names = [*CLASSES, "other"]
    sums = class_counts(df).groupBy("lang").agg(*[F.sum(f"c_{c}").cast("double").alias(c) for c in names]).collect()
    class_shares = {r["lang"]: tuple(r[c] / max(sum(r[x] for x in names), 1.0) for c in names) for r in sorted(sums)}
    found = df.select("lang", F.explode(F.regexp_extract_all(F.lower("t"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    counts = found.groupBy("lang", "word").agg(F.count("*").alias("n"))
    # Spark drops all but each task's first ``n_words`` of a language before they meet.
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.select("*", F.row_number().over(first).alias("place")).where(F.col("place") <= n_words)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    word_shares: dict[str, dict[str, float]] = {k: {} for k in class_shares}
    for r in top.join(totals, "lang").orderBy("lang", "place").collect():
        word_shares[r["lang"]][r["word"]] = r["n"] / r["all"]
    return class_shares, word_shares


def judge(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    class_shares: dict[str, tuple[float, ...]] = CLASS_SHARES,
    word_shares: dict[str, dict[str, float]] = WORD_SHARES,
) -> DataFrame:
    """Every row as ``row`` with its base counts, both distances, ``base_failed`` and ``kept``."""
    df = as_row(docs).withColumns({"t": F.coalesce(field(text_col), F.lit("")), "lang": field(lang_col)})
    df = distances(class_counts(base_counts(df)), class_shares=class_shares, word_shares=word_shares)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    near = (F.col("class_distance") <= max_class_distance) & (
        (F.col("n_letter_words") < MIN_LETTER_WORDS) | (F.col("word_distance") <= max_word_distance)
    )
    return df.drop("t", "lang").withColumns({"base_failed": failed, "kept": ~failed & near})


def _sql_half(p: str, q: str) -> str:
    return f"CASE WHEN {p} > 0 THEN {p} * log2({p} * 2 / ({p} + {q})) * 0.5 ELSE 0.0 END"


def _sql_oracle() -> str:
    pats = {c: p.replace("'", "''") for c, p in CLASSES.items()}
    counts = ", ".join(f"length(t) - length(regexp_replace(t, '{p}', '', 'g')) AS c_{c}" for c, p in pats.items())
    every = " + ".join(f"c_{c}" for c in CLASSES)
    shares = ", ".join([*(f"c_{c} / greatest(length(t), 1)::DOUBLE AS s{i}" for i, c in enumerate(CLASSES)),
                        f"(length(t) - ({every})) / greatest(length(t), 1)::DOUBLE AS s{len(CLASSES)}"])
    by_class = " ".join(
        f"WHEN lang = '{k}' THEN " + " + ".join(f"{_sql_half(f's{i}', f'{s}::DOUBLE')} + {_sql_half(f'{s}::DOUBLE', f's{i}')}" for i, s in enumerate(v))
        for k, v in CLASS_SHARES.items())
    refs = ", ".join(f"('{k}', '{w}', {s}::DOUBLE)" for k, v in WORD_SHARES.items() for w, s in v.items())
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
a AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
             list_filter(string_split_regex(lower(t), '[^\p{{L}}]+'), lambda x: x <> '') AS letters, {counts} FROM d),
b AS (SELECT *, {shares} FROM a),
pos AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM a WHERE len(w) >= 3)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM pos) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY doc_id),
ref AS (SELECT * FROM (VALUES {refs}) r(lang, word, q)),
cnt AS (SELECT doc_id, lang, word, count(*) AS n FROM (SELECT doc_id, lang, unnest(letters) AS word FROM a) GROUP BY ALL),
bins AS (SELECT a.doc_id, ref.word, ref.q, coalesce(cnt.n, 0) / greatest(len(letters), 1)::DOUBLE AS p
         FROM a JOIN ref ON ref.lang = a.lang LEFT JOIN cnt ON cnt.doc_id = a.doc_id AND cnt.word = ref.word),
alls AS (SELECT doc_id, p, q FROM bins UNION ALL SELECT doc_id, 1 - sum(p), 1 - sum(q) FROM bins GROUP BY doc_id),
wd AS (SELECT doc_id, sum({_sql_half('p', 'q')} + {_sql_half('q', 'p')}) AS word_distance FROM alls GROUP BY doc_id),
f AS (SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, len(letters) AS n_letters,
             sqrt(greatest(CASE {by_class} END, 0)) AS class_distance, sqrt(greatest(word_distance, 0)) AS word_distance
      FROM b LEFT JOIN rep USING (doc_id) LEFT JOIN wd USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
       AND class_distance <= {MAX_CLASS_DISTANCE} AND (n_letters < {MIN_LETTER_WORDS} OR word_distance <= {MAX_WORD_DISTANCE}) AS kept
FROM f
"""


ORACLE = _sql_oracle()
