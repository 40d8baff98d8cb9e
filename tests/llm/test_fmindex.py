"""Decontamination against a brute-force search."""

import random
import re

import numpy as np
import pytest

from voxsift.llm import fmindex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text, items, window=10):
    """n_words, hit word numbers, items hit."""
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, passage in items:
        own = WORD.findall(lower(passage))
        size = min(window, len(own))
        if not size or item is None:
            continue
        windows = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)}
        for p in range(len(words) - size + 1):
            if tuple(words[p:p + size]) in windows:
                hit.update(range(p, p + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(8))
def test_index_finds_every_occurrence(seed):
    rng = random.Random(seed)
    n = rng.choice([2, 3, 40])
    numbers = np.array([rng.randrange(n + 1) for _ in range(rng.choice([5, 300, 3000]))], np.int64)
    sizes = [rng.randrange(1, 5) for _ in range(30)]
    phrases = list({tuple(rng.randrange(1, n + 1) for _ in range(s)) for s in sizes})
    lengths = np.array([len(p) for p in phrases])
    matrix = np.zeros((len(phrases), 4), np.int64)
    for i, p in enumerate(phrases):
        matrix[i, :len(p)] = p
    at, which = fmindex.shard_hits(numbers, matrix, lengths, n)
    want = {(i, k) for k, p in enumerate(phrases) for i in range(len(numbers) - len(p) + 1)
            if tuple(numbers[i:i + len(p)].tolist()) == p}
    assert len(at) == len(want)
    assert set(zip(at.tolist(), which.tolist())) == want


ITEMS = [(1, "the quick brown fox jumps over the lazy dog and then it sleeps all day"),
         (10, "Ünïcode wörds stand here, 42 of them! and more come after these words now okay"),
         (2, "short one"), (3, None), (4, "--- !!!"), (None, "no id here"),
         (1, "a second row of item one with quite a few words in it"),
         (9, "the quick brown fox jumps over the lazy dog and then it sleeps all night")]


def documents():
    rng = random.Random(7)
    filler = "the and fox dog one it day a of wörds okay zebra".split()
    rows = [(0, None), (1, ""), (2, "..."), (3, "SHORT, one"), (3, "SHORT, one"), (None, "short one short one")]
    for i in range(4, 60):
        words = [rng.choice(filler) for _ in range(rng.choice([1, 9, 60, 400]))]
        if i % 2:
            text = rng.choice([x[1] for x in ITEMS if x[1]])
            cut = text.split()[rng.randrange(3):][:rng.randrange(9, 16)]
            words[len(words) // 2:len(words) // 2] = [w.upper() if i % 3 else w + "," for w in cut]
        rows.append((i, "\n".join(words) if i % 5 else " ".join(words)))
    rows.append((99, " ".join(rng.choice(filler) for _ in range(50_000))))
    return rows


@pytest.mark.parametrize("block_bytes,broadcast_bytes,shard_bytes", [
    (1 << 24, 1 << 27, 1 << 22), (100, 1 << 20, 300), (100, 200, 300)])  # one block, one pass, several passes
def test_against_brute_force(spark, block_bytes, broadcast_bytes, shard_bytes):
    rows = documents()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, items string, id int")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = fmindex.contamination(docs, bench, block_bytes=block_bytes, broadcast_bytes=broadcast_bytes,
                                shard_bytes=shard_bytes).collect()
    want = [(r[0], *brute(r[1], ITEMS)) for r in rows]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == sorted(want, key=str)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        if r.doc_id in (None, 3):
            continue
        inside = "".join(texts[r.doc_id][s.start:s.end] + " " for s in r.spans) if r.spans else ""
        assert len(WORD.findall(lower(inside))) == r.n_hit
        assert [s.start for s in r.spans] == sorted(s.start for s in r.spans)


def test_passes_hold_no_more_than_their_bound(spark):
    """A test set whose rows share one id spreads over blocks and passes; repeats go once."""
    rows = [(1, f"word{i} " * 20) for i in range(50)] * 3
    bench = spark.createDataFrame(rows, "item_id bigint, text string")
    passes = list(fmindex.query_passes(bench, "item_id", "text", 10, 1000, 3000))
    size = sum(len(t) for _, t in set(rows))
    assert [last for _, last in passes] == [False] * (len(passes) - 1) + [True]
    assert len(passes) == -(-(-(-size // 1000)) // 3) and all(len(blocks) <= 3 for blocks, _ in passes)
    assert sum(len(b.value[1]) for blocks, _ in passes for b in blocks) == 50


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 100])
def test_passes_cut_the_same_spans(spark, broadcast_bytes):
    rows = documents()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, _found string, id int")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    whole = fmindex.decontaminate(docs, bench)
    got = fmindex.decontaminate(docs, bench, block_bytes=100, broadcast_bytes=broadcast_bytes, shard_bytes=300)
    assert got.schema == docs.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_decontaminate_cuts_the_spans_and_keeps_columns(spark):
    text = "Before this, THE quick brown fox jumps over the lazy dog and then it sleeps, after ünd."
    docs = spark.createDataFrame([(1, text, "a"), (2, "clean text", "b"), (3, None, "c")],
                                 "doc_id int, text string, spans string")
    bench = spark.createDataFrame(ITEMS[:1], "item_id bigint, text string")
    got = {r.doc_id: r for r in fmindex.decontaminate(docs, bench).collect()}
    assert got[1].text == "Before this, , after ünd." and got[1].spans == "a"
    assert got[2].text == "clean text" and got[3].text is None


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert fmindex.contamination(docs, bench).collect() == []
    one = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    row = fmindex.contamination(one, bench).first()
    assert (row.n_words, row.n_hit, row["items"], row.spans) == (2, 0, [], [])
