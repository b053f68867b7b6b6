"""Row-local operators: BPE, quality rules, licences, URLs, classifier."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daylake.llm import bpe, license_scan, ordinal_quality, quality_rules, url_filter

BPE = public_tokenizers.path("byte_bpe_50k.json")
LONG = "the quick brown fox isn't 12345 lazy " * 4000
TEXTS = [
    None, "", " ", "a", "\n\n\t x", "a  b   c ", "it's we'll 'S don't", "x<|endoftext|> y<|endoftext|>", "日本語 テスト一二三",
    "½ Ⅷ x² \x85 　z", "=" * 700, "ab" * 900, "é́ñ🎉👩‍👩‍👧", "\x00\x1c\x1f", LONG, "dup", "dup",
]
SCHEMA = "doc_id long, text string, ids string, kept string, row string, t string, lang string, license int"


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i if i else None, t, "own", "own", "own", "own", "en", 5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_bpe_equals_library(texts, library):
    got = {r.doc_id: r for r in bpe.encode(texts, BPE, decoded_col="decoded").collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        r = got[i if i else None]
        want = library.encode(t or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens, r.row) == (want, len(want), "own"), repr(t)[:60]
        assert r.decoded == library.decode(want, skip_special_tokens=False) == (t or "")


def test_bpe_random_words(library):
    model = bpe.ByteBpe(open(BPE, "rb").read())
    rnd = random.Random(5)
    alphabet = "abcdeinorst .,'\n01éßн中"
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 60))) for _ in range(3000)]
    for t, ids in zip(texts, model.encode_batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_bpe_compatibility_is_what_merging_does():
    model = bpe.ByteBpe(open(BPE, "rb").read())
    rnd = np.random.default_rng(3)
    usable = np.flatnonzero(model.usable)
    a, b = rnd.choice(usable, 3000), rnd.choice(usable, 3000)
    for x, y, ok in zip(a.tolist(), b.tolist(), model.compatible(a, b).tolist()):
        assert ok == (model.merge_exactly(model.bytes_of[x] + model.bytes_of[y]) == [x, y])
    long = b"the cat" * 40
    assert model._merge_long([model.byte_ids[c] for c in long]) == model._merge_short([model.byte_ids[c] for c in long])


def test_bpe_decode_of_any_ids(spark, library):
    ids = [[], [220, 256, 50256], [127, 128, 200], None]
    df = spark.createDataFrame([(i,) for i in ids], "ids array<int>")
    got = [r.decoded for r in bpe.decode(df, BPE).collect()]
    assert sorted(got) == sorted(library.decode(i or [], skip_special_tokens=False) for i in ids)


def test_bpe_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, BPE).count() == 0


def brute_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(three)
    again = {p for i, w in enumerate(three) if n[w] > 1 for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again))


def test_quality_rules_counts(spark):
    rnd = random.Random(1)
    made = [" ".join(rnd.choices(["a", "b", "the", "#x", "é|", "\n", "\x0b", "of\n"], k=rnd.randint(0, 80))) for _ in range(80)]
    rows = [(i, t, "en", "own", "own") for i, t in enumerate(TEXTS + made)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string, n_words string")
    got = {r.row.doc_id: r for r in quality_rules.judge(df).collect()}
    for i, t in enumerate(TEXTS + made):
        r = got[i]
        want = brute_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(t)[:80]
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.row.kept == "own" and not (r.base_failed and r.kept)


def test_quality_rules_distances(spark):
    rows = [("en", LONG), (None, "der die und " * 30), ("xx", "%%% $$$ " * 60), ("en", "THE OF AND " * 40)]
    got = quality_rules.judge(spark.createDataFrame(rows, "lang string, text string")).collect()
    for r, (lang, text) in zip(got, rows):
        import regex

        shares = [sum(map(len, regex.findall(p, text))) / len(text) for p in quality_rules.CLASSES.values()]
        shares.append(1 - sum(shares))

        def js(p, q):
            p, q = np.maximum(p, 0), np.array(q)
            half = lambda a, b: sum(x * np.log2(2 * x / (x + y)) / 2 for x, y in zip(a, b) if x > 1e-15)
            return np.sqrt(max(0.0, half(p, q) + half(q, p)))

        refs = [lang] if lang in quality_rules.CLASS_SHARES else list(quality_rules.CLASS_SHARES)
        assert r.class_distance == pytest.approx(min(js(shares, quality_rules.CLASS_SHARES[k]) for k in refs), abs=1e-9)
        words = regex.findall(r"\p{L}+", text.lower())
        best = []
        for k in refs:
            ref = quality_rules.WORD_SHARES[k]
            p = [words.count(w) / max(1, len(words)) for w in ref]
            best.append(js([*p, 1 - sum(p)], [*ref.values(), 1 - sum(ref.values())]))
        assert r.word_distance == pytest.approx(min(best), abs=1e-6)


def test_quality_references_are_fitted_from_a_corpus(spark):
    texts = {"en": ["The cat and the Dog, the END.", None, "A cat 12 (cat)"], "xx": ["öl öl Öl", ""], None: ["the the"]}
    rows = [(k, t) for k, v in texts.items() for t in v]
    classes, words = quality_rules.fit_references(spark.createDataFrame(rows, "lang string, text string").repartition(3), n_words=2)
    assert words == {"en": {"cat": 3 / 10, "the": 3 / 10}, "xx": {"öl": 1.0}}
    assert list(classes) == ["en", "xx"] and all(sum(v) == pytest.approx(1) for v in classes.values())
    whole = "".join(t for t in texts["en"] if t)
    assert classes["en"][list(quality_rules.CLASSES).index("upper")] == sum(c.isupper() for c in whole) / len(whole)
    judged = quality_rules.judge(spark.createDataFrame([("xx", "öl " * 60)], "lang string, text string"), class_shares=classes, word_shares=words)
    assert judged.first().word_distance == pytest.approx(0, abs=1e-6) and judged.first().n_letter_words == 60


def test_license_scan_equals_brute_force(texts, spark):
    rnd = random.Random(2)
    bits = "Licensed under the Apache License, Version 2.0. Released MIT this work is GNU General Public version 3 of x".split()
    made = [" ".join(rnd.choices(bits, k=rnd.randint(0, 40))) for _ in range(60)]
    made += ["aa. " + t + " zz" for t in license_scan.TEMPLATES.values()] + [f"{t}\n" * 3 for t in license_scan.TEMPLATES.values()]
    made += [None, "", LONG, "licensed UNDER the apache -- licence version 2 0"]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    for i, t in enumerate(made):
        words = license_scan.normalised(t or "")
        want = []
        if len(words) < 1000:
            grams = license_scan.bigrams(words)
            for k, (name, text) in enumerate(license_scan.TEMPLATES.items()):
                ref = Counter(license_scan.bigrams(license_scan.normalised(text)))
                best = max(
                    ((license_scan.dice(Counter(grams[a:b]), ref), -a, -b) for a in range(len(grams)) for b in range(a + 1, min(len(grams), a + 2 * ref.total()) + 1)),
                    default=(0, 0, 0),
                )
                if best[0] >= license_scan.MIN_DICE:
                    want.append((-best[0], k, name, -best[1], -best[2] + 1))
        told = [(x.license, x.dice, x.start, x.end) for x in got[i].licenses]
        assert told == [(n, round(-s, 6), a, b) for s, _, n, a, b in sorted(want)], repr(t)
        assert got[i].license == (told[0][0] if told else None)
    kept = license_scan.scan(texts).collect()
    assert len(kept) == len(TEXTS) and {r.row for r in kept} == {"own"}


def test_license_query_knows_families_and_whole_texts(spark, tmp_path):
    from daylake.llm.queries import op10_licenses

    body = lambda name: license_scan.production()[name][-1]
    want = {
        "x Licensed under CC BY-NC 4.0. y": "CC-BY-NC-4.0",
        "free as CC BY-NC-SA 4.0, they say": "CC-BY-NC-SA-4.0",
        "see CC BY 4.0": "CC-BY-4.0",
        "Licensed under CC BY-ND 3.0.": "CC-BY-ND-3.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "Creative Commons Attribution-NonCommercial 2.5 Generic License": "CC-BY-NC-2.5",
        "CC0 1.0 Universal": "CC0-1.0",
        "Copyright A. All rights reserved.": "proprietary",
        "All rights reserved. Released under the MIT License.": "MIT",
        "prices grew by 4.0 percent, all other rights too": None,
        **{f"Copyright (c) 2020 A. All rights reserved.\n\n{body(n)}\nint main;": n for n in license_scan.WHOLE_TEXTS},
        "# " + body("MIT").replace("\n", "\n# ") + " the end": "MIT",
    }
    spark.createDataFrame(list(enumerate(want)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.license for r in op10_licenses(spark, str(tmp_path)).collect()}
    assert {t: got[i] for i, t in enumerate(want)} == want


def test_license_best_window_equals_a_plain_search():
    rnd = random.Random(4)
    for _ in range(150):
        words = "a b c d".split()
        template = license_scan.Template("t", " ".join(rnd.choices(words, k=rnd.randint(2, 14))), least := rnd.choice([0.5, 0.8]))
        text = rnd.choices([*words, "x"], k=rnd.randint(2, 40))
        grams = license_scan.bigrams(text)
        spans = [(license_scan.dice(Counter(grams[a:b]), template.grams), -a, -b) for a in range(len(grams)) for b in range(a + 1, len(grams) + 1)]
        score, a, b = max(spans)
        hit = {i: g for i, g in enumerate(grams) if g in template.grams}
        got = template.best(list(hit), hit, least)
        assert got == ((score, -a, -b - 1) if score >= least else None)


def test_url_filter(spark):
    urls = [
        None, "", "no scheme/x", "http://", "https://A.Example.ORG/es/x?q#f", "https://example.org/en/12", "http://example.org",
        "http://x.com/de/?a", "http://x.com/fr/", "http://X.com#/de/", "ftp://evilexample.org/en/1", "http://m.spam-farm.example.com/en/1",
        "http://spam-farm.example.com?x", "http://notspam-farm.example.com/", "http://bad.net/evil/x", "http://bad.net/evilx", "http://bad.net/evil",
        "a://b://c.org/x", "http://org/", "http://.org/",
    ]
    rules, blocked = url_filter.RULES, (*url_filter.BLOCKED, "bad.net/evil")
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls * 2)], "page_id long, url string, rule string")
    got = url_filter.judge(df, blocked=blocked).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        host, path = url_filter.split_url(urls[r.page_id % len(urls)])
        below = lambda name: host == name or host.endswith("." + name)
        fits = [(len(h + p), h + p, a) for a, h, p in rules if below(h) and path.startswith(p)]
        listed = any(below(b.split("/")[0]) and ("/" not in b or path == b[b.index("/") :] or path.startswith(b[b.index("/") :] + "/")) for b in blocked)
        want = max(fits)[1:] if fits else (None, "block" if listed else "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *want), urls[r.page_id % len(urls)]
    assert url_filter.judge(df.limit(0)).count() == 0


def test_url_index_confirms_strings_on_collisions():
    index = url_filter.DigestIndex(url_filter.build_index([(f"h{i}.org", str(i)) for i in range(500)]))
    assert index.find(["h3.org", "h999.org", "h499.org", ""]) == ["3", None, "499", None]
    index.keys = np.zeros(500, np.uint64)  # every digest collides
    probe = url_filter.xxhash.xxh64_intdigest
    url_filter.xxhash.xxh64_intdigest = lambda _: 0
    try:
        assert index.find(["h3.org", "h999.org", "h499.org"]) == ["3", None, "499"]
    finally:
        url_filter.xxhash.xxh64_intdigest = probe


def test_ordinal_model_recovers_grades():
    rnd = np.random.default_rng(0)
    rows, grades = [], []
    for _ in range(1500):
        grade = int(rnd.integers(0, 3))
        noise = rnd.choice(5000, 30, replace=False) + 100
        marks = {0: [1, 2], 1: [3], 2: []}[grade]
        rows.append(np.sort(np.array([*marks, *noise], np.int32)))
        grades.append(grade)
    grades = np.array(grades)
    model = ordinal_quality.fit(rows[:1000], grades[:1000], 2)
    tails = model.tails(np.array([model.weights[r].sum() for r in rows[1000:]]))
    assert ((tails > 0.5).sum(axis=1) == grades[1000:]).mean() > 0.95
    assert model.thresholds[0] < model.thresholds[1] and (tails[:, 0] >= tails[:, 1]).all()


def test_ordinal_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    grade = ordinal_quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade")
    rated = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", grade)
    model = ordinal_quality.train(docs, rated.where("doc_id % 4 <> 0"))
    held = ordinal_quality.score(docs.join(rated.where("doc_id % 4 = 0"), "doc_id"), model)
    share = {r.grade: r.kept for r in held.groupBy("grade").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[2] > 0.97 and share[1] < 0.25 and share[0] < 0.05


def test_ordinal_edge_cases(texts, spark):
    none = spark.createDataFrame([], "doc_id long, grade int")
    for rated in (none, spark.createDataFrame([(1, 2), (2, 2), (3, None)], none.schema)):
        model = ordinal_quality.train(texts, rated)
        got = ordinal_quality.score(texts, model).collect()
        assert len(got) == len(TEXTS) and all(r.kept and r.expected_grade == 2.0 for r in got)
        assert {r.kept for r in ordinal_quality.select(texts, model).collect()} == {"own"}
    assert ordinal_quality.score(texts.limit(0), model).count() == 0


def test_ordinal_sample_takes_one_row_of_an_id(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(ordinal_quality, "fit", lambda rows, grades, top: taken.append((len(rows), grades.tolist())))
    docs = [(1, f"text {i % 3}") for i in range(300)] + [(2, "b"), (2, None), (3, "c"), (3, "c"), (4, "not rated")]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    ordinal_quality.train(docs, spark.createDataFrame([(1, 0), (2, 2), (2, 1), (3, 2)], "doc_id long, grade int"))
    assert taken == [(3, [0, 1, 2])]


def test_digest_columns(spark):
    from daylake.llm.queries import op1_bpe

    r = op1_bpe(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").first().text
    assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
