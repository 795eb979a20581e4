"""Periodic runs against a direct search of every period."""

import hashlib
import random
import zlib

import llm_plain as brute
import numpy as np
import pytest
from llm_plain import ODD
from pyspark.sql import functions as F

from sensorlake.llm import periodic


def plain_runs(w, min_words=6, min_repeats=4):
    """Every maximal stretch of period q, for each q; the smallest period of a stretch stays."""
    best = {}
    for q in range(1, len(w) // min_repeats + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            length = e + q - i
            if length >= max(min_words, min_repeats * q):
                best.setdefault((i, length), q)
            i = e
    return sorted((s, n, q) for (s, n), q in best.items())


def plain_report(doc_id, text):
    w = brute.words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = plain_runs(w)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), s, n, q, 1000 * n // q if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def key(row):
    return tuple((x is None, x) for x in row)


def check(rows, df):
    got = periodic.run_report(periodic.collapse(periodic.plant(df))).collect()
    assert sorted(map(tuple, got), key=key) == sorted((plain_report(i, t) for i, t in rows), key=key)


def test_odd_rows(odd_docs):
    check([(r[0], r[1]) for r in ODD], odd_docs)


def test_tables(spark, make_docs):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)
    check(rows, make_docs(rows))


@pytest.mark.parametrize("seed,letters", [(1, 1), (2, 2), (3, 2), (4, 3)])
def test_few_words(make_docs, seed, letters):
    """Random texts, squares, Fibonacci words and nested repeats over few words."""
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        w = [rng.choice("abc"[:letters]) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            root = w[:rng.randint(1, 9)] or ["a"]
            w = w[:rng.randint(0, 9)] + root * rng.randint(2, 9) + root[:rng.randint(0, len(root))] + w[-3:]
        if rng.random() < 0.3:
            w = w * rng.randint(2, 5)
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    a, b = "a", "a b"
    for _ in range(7):
        a, b = b, f"{b} {a}"
    rows.append((999, b))
    check(rows, make_docs(rows))


def test_other_limits():
    rng = random.Random(9)
    for _ in range(200):
        texts = [[rng.randrange(2) for _ in range(rng.randint(0, 30))] for _ in range(3)]
        bounds = np.cumsum([0, *map(len, texts)])
        for words, repeats in ((2, 2), (6, 2), (9, 3)):
            got = periodic.find_runs(np.array(sum(texts, []), dtype=np.int64), bounds, words, repeats)
            want = [(s + int(at), n, q) for t, at in zip(texts, bounds) for s, n, q in plain_runs(t, words, repeats)]
            assert list(zip(*(x.tolist() for x in got))) == want


def test_suffix_array_and_intervals():
    rng = random.Random(3)
    for _ in range(50):
        texts = [[rng.randrange(3) for _ in range(rng.randint(0, 25))] for _ in range(4)]
        bounds = np.cumsum([0, *map(len, texts)])
        flat = sum(texts, [])
        array = periodic.SuffixArray(np.array(flat, dtype=np.int64), bounds)
        suffixes = sorted((k, flat[i:bounds[k + 1]], i) for k in range(4) for i in range(bounds[k], bounds[k + 1]))
        assert array.order.tolist() == [s[2] for s in suffixes]
        for r in range(1, len(flat)):
            a, b = suffixes[r - 1], suffixes[r]
            common = next((k for k, (x, y) in enumerate(zip(a[1], b[1])) if x != y), min(len(a[1]), len(b[1])))
            assert array.lcp[r] == (common if a[0] == b[0] else 0)
        for r, d, left, right in zip(*(x.tolist() for x in array.intervals())):
            assert array.lcp[left] < d and array.lcp[right + 1] < d
            assert min(array.lcp[left + 1:right + 1]) == d == array.lcp[r] and left < r <= right


def test_long_text_of_one_word(make_docs):
    rows = [(1, "x " * 30000), (2, "a b c " * 20000 + "d"), (3, " ".join(map(str, range(50000))))]
    got = {r["doc_id"]: r for r in periodic.collapse(make_docs(rows)).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 30000, 1)] and got[1]["kept_text"] == "x"
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 60000, 3)] and got[2]["kept_text"] == "a b c d"
    assert got[3]["runs"] == [] and got[3]["kept_text"] == rows[2][1]


def test_carried_columns_and_empty(make_docs, no_docs):
    df = make_docs([(1, "a a a a a a a", "en", "s")]).withColumn("runs", F.lit(7)).withColumn("n_words", F.lit("x"))
    assert [(r["kept_text"], r["lang"], r["chunk"]) for r in periodic.collapse(df, carry=("lang", "chunk")).collect()] == [("a", "en", 13)]
    assert periodic.run_report(periodic.collapse(periodic.plant(no_docs))).count() == 0
