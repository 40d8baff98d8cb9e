"""Suffix-tree scores against a plain version of the definition."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from voxsift.llm import suffixtree
from voxsift.llm.common import remainder

DEPTH = suffixtree.DEPTH


def held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def symbols(text):
    return b" ".join((text or "").encode().lower().split()) + b"\n"


def brute(rows, mass=suffixtree.MASS, min_divergence=suffixtree.MIN_DIVERGENCE):
    words = Counter()
    counts = [Counter() for _ in range(DEPTH + 1)]
    for doc, text in rows:
        if not held_out(doc):
            words.update((text or "").encode().lower().split() + [b"\n"])
            data = b"\n" * DEPTH + symbols(text)
            for i in range(DEPTH, len(data)):
                for k in range(DEPTH + 1):
                    counts[k][data[i - k:i + 1]] += 1
    n, v = sum(words.values()), len(words)
    p = {}
    total = sum(counts[0].values())
    for k in range(1, DEPTH + 1):
        by = defaultdict(dict)
        for gram, c in counts[k].items():
            by[gram[:-1]][gram[-1:]] = c
        p[k] = by

    def root(s):
        return (counts[0][s] + 0.5) / (total + 128)

    kept = {}

    def prob(context, s):
        """After the longest retained suffix of the context."""
        if not context:
            return root(s)
        lower = prob(context[1:], s)
        if not retained(context):
            return lower
        here = p[len(context)].get(context, {})
        return (here.get(s, 0) + mass * lower) / (sum(here.values()) + mass)

    def retained(context):
        if context not in kept:
            here = p[len(context)].get(context, {})
            size = sum(here.values())
            d = 0.0
            for s, c in here.items():
                lower = prob(context[1:], s)
                d += c * math.log((c + mass * lower) / (size + mass) / lower)
            kept[context] = d > min_divergence
        return kept[context]

    out = []
    for doc, text in rows:
        tokens = (text or "").encode().lower().split() + [b"\n"]
        data = b"\n" * DEPTH + symbols(text)
        out.append((doc, held_out(doc), len(tokens), sum(words[t] > 0 for t in tokens), n,
                    sum(math.log10((words[t] + 1) / (n + v + 1)) for t in tokens),
                    sum(math.log10(prob(data[i - DEPTH:i], data[i:i + 1])) for i in range(DEPTH, len(data)))))
    return out


def corpus(n=60):
    rng = random.Random(17)
    parts = "an ter ing lo mi Ra dé st on kä he".split()
    rows = [(1000, None), (1001, ""), (1002, " \n\t"), (None, "no id An"), (1003, "twice"), (1003, "twice")]
    for i in range(n):
        rows.append((i, (" " if i % 3 else "\n ").join(
            "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(rng.choice([1, 8, 60])))))
    return rows


def compare(got, rows):
    key = lambda r: (str(r[0]), r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(brute(rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])) and abs(g[6] - w[6]) < 1e-5 * max(1, abs(w[6]))


@pytest.mark.parametrize("block_bytes", [1 << 25, 700])
def test_against_a_plain_version(spark, block_bytes):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, score int, block string")
    got = suffixtree.score(df, remainder("doc_id", 7) == 2, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    compare(got.collect(), rows)


def test_nothing_to_train_and_empty_table(spark):
    held = [i for i in range(60) if held_out(i)]
    rows = [(i, f"text {i}") for i in held]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    compare(suffixtree.score(df, remainder("doc_id", 7) == 2).collect(), rows)
    assert suffixtree.score(df.where("false"), remainder("doc_id", 7) == 2).collect() == []


def test_retained_contexts_help_on_held_out_texts(spark):
    """Against the root alone, where no divergence is large enough."""
    rng = random.Random(6)
    parts = "an ter ing lo mi ra de st on ka he".split()
    rows = [(i, " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(3, 6))) for _ in range(50)))
            for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    scores = [sum(r.score for r in suffixtree.score(
        df, remainder("doc_id", 7) == 2, min_divergence=d).where("held_out").collect())
        for d in (suffixtree.MIN_DIVERGENCE, 1e18)]
    assert scores[0] > 0.6 * scores[1]


def test_lookup_finds_every_key():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 48, 5000).astype(np.uint64))
    queries = rng.choice(keys, 20_000)
    assert (keys[suffixtree.Lookup(keys).places(queries)] == queries).all()
    one = np.array([5], np.uint64)
    assert suffixtree.Lookup(one).places(one).tolist() == [0]


def test_very_long_text(spark):
    rng = random.Random(3)
    rows = [(1, " ".join(str(rng.randrange(500)) for _ in range(60_000))), (2, "x" * 200_000), (3, "7 8 9")]
    got = suffixtree.score(spark.createDataFrame(rows, "doc_id bigint, text string"), remainder("doc_id", 7) == 2)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {1: 60_001, 2: 2, 3: 4}
