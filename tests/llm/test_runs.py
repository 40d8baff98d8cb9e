"""Periodic runs against a scan of every lag."""

import random
from hashlib import sha256
from zlib import crc32

import pytest

from voxsift.llm import registry, runs


def brute(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(6, 4 * q) and not any((s, m) == (start, length) for s, m, _ in out):
                out.add((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def random_words(rng, most=120):
    words = []
    while len(words) < rng.randrange(most):
        if rng.random() < 0.5:
            words += [rng.choice("abcdefgh"[:rng.randrange(1, 9)]) for _ in range(rng.randrange(1, 12))]
        else:
            period = [rng.choice("abcd"[:rng.randrange(1, 5)]) for _ in range(rng.randrange(1, 7))]
            n = rng.randrange(1, 45)
            words += (period * n)[:n]
    return words


@pytest.mark.parametrize("seed", range(20))
def test_runs_of_many_documents(seed):
    rng = random.Random(seed)
    texts = [random_words(rng) for _ in range(60)]
    got = runs.runs_of(texts)
    assert got == [brute(w) for w in texts]
    assert [runs.collapsed(w, r) for w, r in zip(texts, got)] == [kept(w, r) for w, r in zip(texts, got)]


def test_splitting_recurses():
    # c is rare; without it the a b stretch holds b three times only, and only the last one stays
    words = list("abababc") + list("xyxyxyxy")
    assert runs.runs_of([words])[0] == [(7, 8, 2)]
    import numpy as np

    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    spans = runs.surviving(np.array([numbers[w] for w in words]), np.zeros(len(words), int))
    assert spans == [(7, 15)]


def test_smallest_period_and_short_runs():
    assert runs.runs_of([["a"] * 5])[0] == []
    assert runs.runs_of([["a"] * 6])[0] == [(0, 6, 1)]
    assert runs.runs_of([["a"] * 4000])[0] == [(0, 4000, 1)]
    assert runs.runs_of([list("ab") * 4])[0] == [(0, 8, 2)]
    assert runs.runs_of([(list("ab") * 4)[:7]])[0] == []


def test_long_periods():
    words = [str(i % 5000) for i in range(20_003)]
    assert runs.runs_of([["x", *words, "y"]])[0] == [(1, 20_003, 5000)]


def test_spark(spark):
    rng = random.Random(9)
    texts = [None, "", " \t\n ", "a\x1ca " * 9, "x\xa0y " * 8, "same " * 7] + [
        rng.choice([" ", "\n", "\t "]).join(random_words(rng)) for _ in range(80)]
    texts += ["one two " * 30_000 + "end"]
    rows = [(i, t, "r", 3) for i, t in enumerate(texts)] + [(0, "a a a a a a", "r", 3), (None, "b " * 9, "r", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, n_words int")
    got = runs.find_runs(docs, slice_bytes=500).collect()
    shape = lambda i, w, r: (str(i), len(w), r, " ".join(x.decode() for x in kept(w, r)))
    want = [shape(i, w, brute(w) if len(w) < 1000 else [(0, 60_000, 2)])
            for i, w in [(r[0], (r[1] or "").encode().split()) for r in rows]]
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == sorted(want)


def test_empty_table(spark):
    assert runs.find_runs(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_strongest(spark):
    from pyspark.sql import functions as F

    rows = [(1, [(5, 8, 2), (20, 9, 2), (40, 18, 4), (60, 9, 2)]), (2, []), (3, [(9, 8, 2), (3, 16, 4), (3, 8, 2)])]
    df = spark.createDataFrame(rows, f"id int, runs array<{runs.RUN}>")
    got = {r.id: r.best and tuple(r.best) for r in df.select("id", runs.strongest(F.col("runs")).alias("best")).collect()}
    assert got == {1: (20, 9, 2), 2: None, 3: (3, 8, 2)}


def test_registered_query(spark, sf):
    rows = {r.doc_id: r for r in registry.op13_periodic_runs(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        words, h = (text or "").encode().split(), crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
        found = runs.runs_of([words])[0] if len(words) > 400 else brute(words)
        r = rows[i]
        assert r.n_runs == len(found)
        shown = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        assert r.runs_sha256 == sha256(shown.encode()).hexdigest()
        assert r.collapsed_sha256 == sha256(b" ".join(kept(words, found))).hexdigest()
        if found:
            s, m, q = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, m, q, 1000 * m // q)
        else:
            assert r.start is r.length is r.period is r.exponent_milli is None
