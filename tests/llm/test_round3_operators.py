"""Filter audit, window dedup and spelling variants against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from daylake.llm import filter_audit, queries, spelling, window_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, part string, word string"


def frame(spark, rows):
    """Documents with two columns that clash with names used inside."""
    return spark.createDataFrame([(i, t, lang, "x", "y") for i, t, lang in rows], SCHEMA).repartition(3)


# ---------------------------------------------------------------- filter audit


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failing = []
    for i, text, lang in rows:
        t = text or ""
        w = WORD.findall(t)
        bits = set()
        if len(w) < 200:
            bits.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            bits.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            bits.add("C")
        if re.search("[#$%&*|]", t):
            bits.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows):
            bits.add("E")
        failing.append((lang or "", i, bits))
    out = {}
    for part in {p for p, _, _ in failing}:
        here = [(i, b) for p, i, b in failing if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = list(here)
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                failed = sum(f in b for _, b in here)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failed - len(gone), sum(b == {f} for _, b in here),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), told in out.items():
            if p == part:
                told.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audit_rows(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(600)] + ["Big", "CAPS", "a#b", "100%", "é", "x y"]
    texts = [None, "", " \n", "AB", "one two", " wide "]
    for _ in range(40):
        texts.append(" ".join(rnd.choices(vocabulary[: rnd.choice([3, 80, 606])], k=rnd.choice([5, 199, 200, 260]))))
    rows = [(n, rnd.choice(texts), rnd.choice(["en", "de", "", None])) for n in range(150)]
    rows += [(7, rows[7][1], "en"), (None, texts[8], "en"), (None, texts[8], "en"), (300, "X" * 200_000, "fr")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("salt", "broadcast"), [(200, 500_000), (3, 0)])
def test_filter_audit_equals_brute_force(spark, monkeypatch, salt, broadcast):
    monkeypatch.setattr(filter_audit, "SALT_ROWS", salt)
    monkeypatch.setattr(filter_audit, "BROADCAST_HASHES", broadcast)
    rows = audit_rows(salt)
    labels = [(n, n % 2, n % 5 == 0) for n in range(0, 150, 3)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    labels = [(i, q, int(t)) for i, q, t in labels] + [(4, None, None)]
    df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(frame(spark, rows), df)
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in got.collect()} == brute_audit(rows, labels)
    assert [t for _, t in got.dtypes] == ["string", "string", "int", *["bigint"] * 7]


def test_filter_audit_hot_copies_and_empty_tables(spark):
    rows = [(n, "the same text", "en") for n in range(3000)] + [(5000 + n, f"text {n}", "en") for n in range(50)]
    df = frame(spark, rows)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    hashes = df.select(F.xxhash64("text").alias("h"))
    assert filter_audit.copies_of_smaller(df, hashes, "doc_id", "text", "lang").count() == 2999
    assert filter_audit.audit(df.limit(0), labels).count() == 0
    assert filter_audit.audit(df, labels).count() == 600


# ---------------------------------------------------------------- window dedup


def brute_cut(rows, size):
    first = {}
    words = [WORD.findall(t or "") for _, t, _ in rows]
    for (i, _, _), w in zip(rows, words):
        if i is not None:
            for k in range(len(w) - size + 1):
                key = tuple(w[k : k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def passages(seed, size):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "x y", "漢字"]
    shared = [rnd.choices(vocabulary, k=n) for n in (size - 1, size, size + 1, 40)]
    rows = [(0, None, "en"), (1, "", "en"), (2, " \t\n", "en"), (3, " ".join(shared[1]), "en")]
    for n in range(60):
        w = rnd.choices(vocabulary, k=rnd.randint(0, 60))
        for s in rnd.sample(shared, rnd.randint(0, 3)):
            at = rnd.randint(0, len(w))
            w = w[:at] + s + w[at:]
        rows.append((100 - n, rnd.choice([" ", "\n", "  \t"]).join(w), "en"))
    twice = rnd.choices(vocabulary, k=20)
    rows += [(200, " ".join(twice + twice), "en"), (201, " ".join(twice), "en"), (201, " ".join(twice), "en"), (None, rows[10][1], "en"),
             (50, rows[20][1], "de"), (300, "a " * 30_000, "en"), (301, "a " * 20, "en")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "size", "blocks"), [(1, 13, 1), (2, 13, 16 << 20), (3, 3, 4000), (4, 1, 4000)])
def test_window_dedup_equals_brute_force(spark, monkeypatch, seed, size, blocks):
    monkeypatch.setattr(window_dedup, "LEAST_BLOCK_BYTES", blocks)
    rows = passages(seed, size)
    got = window_dedup.cut_repeats(frame(spark, rows), size=size).collect()
    assert sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in got), key=repr) == brute_cut(rows, size)


def test_window_dedup_survives_a_crowded_sketch(spark, monkeypatch):
    """A sketch with far too few counters lets more windows through to the exact pass and loses none."""
    monkeypatch.setattr(window_dedup, "LEAST_BLOCK_BYTES", 2000)
    monkeypatch.setattr(window_dedup.Sketch, "for_bytes", classmethod(lambda cls, n: cls(2, 6, 3)))
    rows = passages(9, 5)
    got = window_dedup.cut_repeats(frame(spark, rows), size=5).collect()
    assert sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in got), key=repr) == brute_cut(rows, 5)
    assert window_dedup.cut_repeats(frame(spark, rows).limit(0)).count() == 0


def test_sketch_never_counts_too_little():
    rnd = np.random.default_rng(5)
    sketch = window_dedup.Sketch(2, 10, 4)
    keys = [np.unique(rnd.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2)) for _ in range(6)]
    keys[1] = np.unique(np.concatenate((keys[1], keys[0][:50])))
    for row in range(2):
        counts = Counter()
        for k in keys:
            counts.update(sketch.counters(k, row)[0].tolist())
        hits, place = sketch.counters(keys[0], row)
        assert all(counts[h] >= 2 for h in hits[place[:50]].tolist())
    numbers = np.array([0, 1, 700, 70_000, 16_000_000], np.uint32)
    assert window_dedup._unpack(window_dedup._pack(numbers)).tolist() == numbers.tolist()


# ---------------------------------------------------------------- spelling variants


def lower_ascii(t):
    return "".join(c.lower() if c.isascii() else c for c in t)


def brute_words(rows):
    counts = Counter()
    for i, text, _ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = lower_ascii(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(words):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), words.get(forms[w]))
    return out


def spelled(seed):
    rnd = random.Random(seed)
    letters = "abcdeéß×"
    base = ["".join(rnd.choices(letters, k=rnd.randint(6, 14))) for _ in range(25)] + ["aaaaaaa", "aaaaaaaa", "abababab", "informations"]
    vocabulary = Counter()
    for w in base:
        vocabulary[w] += rnd.choice([2, 30, 300, 2000])
        for _ in range(12):
            at = rnd.randrange(len(w))
            v = rnd.choice([w[:at] + w[at + 1 :], w[:at] + rnd.choice(letters) + w[at:], w[:at] + rnd.choice(letters) + w[at + 1 :], w + "a"])
            vocabulary[v] += rnd.choice([1, 2, 3, 25, 200])
            at = rnd.randrange(len(v))
            vocabulary[v[:at] + v[at + 1 :]] += rnd.choice([1, 2, 20])
    runs = [w if rnd.random() < 0.8 else w.upper() if w.isascii() else w.capitalize() for w, n in vocabulary.items() for _ in range(n)]
    rnd.shuffle(runs)
    rows = [(n, rnd.choice([" ", "-", "1", "\n", "Ł"]).join(runs[n * 40 : n * 40 + 40]), "en") for n in range(len(runs) // 40 + 1)]
    return rows + [(9001, None, "en"), (9002, "", "en"), (None, "informations " * 3, "en"), (5, rows[5][1], "en"), (9003, "q" * 50_000, "en"), (9004, "q" * 50_000, "en")]


@pytest.mark.parametrize(("seed", "bucket", "group"), [(1, 8192, 32768), (2, 4, 50), (3, 1, 200)])
def test_spelling_equals_brute_force(spark, seed, bucket, group):
    rows = spelled(seed)
    got = spelling.group_variants(frame(spark, rows), bucket=bucket, group=group)
    want = brute_spelling(brute_words(rows))
    told = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()}
    assert told == want
    assert any(v[0] for v in want.values()) and any(v[0] and v[1] != v[0] for v in want.values())
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]


def test_spelling_of_an_empty_table(spark):
    assert spelling.group_variants(frame(spark, [(1, None, "en")]).limit(0)).count() == 0
    assert spelling.group_variants(frame(spark, [(1, None, "en"), (2, "few words", "en")])).count() == 0


# ---------------------------------------------------------------- registered queries


def test_registered_queries(spark, tmp_path):
    rows = passages(3, 13) + [(n + 1000, t, lang) for n, (_, t, lang) in enumerate(audit_rows(2)[:40])] + [(i + 2000, t, x) for i, t, x in spelled(4)[:40] if i is not None]
    rows = list({i: (i, t, lang) for i, t, lang in rows if i is not None}.values())
    frame(spark, rows).select("doc_id", "text", "lang", F.lit("s").alias("source")).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2, 0) for i, _, _ in rows[::3]]
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    sf = str(tmp_path)
    cut = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op12_window_dedup(spark, sf).collect()}
    assert cut == {i: (n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in brute_cut(rows, 13)}
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = queries.op11_filter_audit(spark, sf).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in got} == brute_audit(rows, labels)
    told = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in queries.op13_spelling(spark, sf).collect()}
    assert told == brute_spelling(brute_words(rows))
