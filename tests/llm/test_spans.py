"""Substring deduplication against a brute-force version."""

import random
import re
import zlib

import pytest

from voxsift.llm import spans


def version(text):
    """Rows of one id are ordered by the text's murmur3 hash."""
    return VERSIONS[text]


VERSIONS: dict = {}


def parts_of(text, a, b):
    """A long sentence is cut after the word of the last smallest crc32 of
    each window of 11 words, but for the last word."""
    words = [(m.start() + a, m.end() + a) for m in re.finditer(r"\S+", text[a:b])]
    if len(words) <= 15:
        return [(a, b)]
    cuts = brute_cuts([text[s:e].lower() for s, e in words])
    ends = [words[i][1] for i in cuts if i < len(words) - 1]
    return list(zip([a, *ends], [*ends, b]))


def runs_to(pieces, j, min_sentences, min_words):
    """The shortest full run that ends with sentence j."""
    for i in range(j, -1, -1):
        if j + 1 - i >= min_sentences and sum(len(p[2].split()) for p in pieces[i:j + 1]) >= min_words:
            return (i, j + 1, tuple(p[2] for p in pieces[i:j + 1]))
    return None


def brute(rows, both_ends, min_sentences=2, min_words=20):
    """(id, sentences, removed, text left) of (id, text) rows."""
    parsed, seen = [], {}
    for doc, text in rows:
        pieces, at = [], 0
        for m in re.finditer(r"[.!?;:,](?=\s)|\n", text or ""):
            pieces.append((at, m.end()))
            at = m.end()
        pieces.append((at, len(text or "")))
        pieces = [x for a, b in pieces for x in parts_of(text or "", a, b)]
        pieces = [(a, b, " ".join((text or "")[a:b].lower().split())) for a, b in pieces if (text or "")[a:b].split()]
        runs = []
        for i in range(len(pieces)):
            for j in range(i + 1, len(pieces) + 1):
                if j - i >= min_sentences and sum(len(p[2].split()) for p in pieces[i:j]) >= min_words:
                    runs.append((i, j, tuple(p[2] for p in pieces[i:j])))
                    break
        if both_ends:
            ends = [runs_to(pieces, j, min_sentences, min_words) for j in range(len(pieces))]
            runs = list(dict.fromkeys(runs + [r for r in ends if r]))
        for i, _, key in runs:
            here = (doc is None, doc or 0, version(text), i)
            seen[key] = min(seen.get(key, here), here)
        parsed.append((doc, text, pieces, runs))
    out = []
    for doc, text, pieces, runs in parsed:
        gone = {k for i, j, key in runs if seen[key] != (doc is None, doc or 0, version(text), i) for k in range(i, j)}
        left, last = "", 0
        for k in sorted(gone):
            left += (text or "")[last:pieces[k][0]]
            last = pieces[k][1]
        left += (text or "")[last:]
        # blank sentences between two removed ones go with them
        out.append((doc, len(pieces), len(gone), None if text is None else re.sub(r"\s", "", left)))
    return sorted(out, key=str)


def corpus(n=150):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    sentence = lambda: " ".join(word() for _ in range(rng.choice([*range(1, 16), 16, 23, 40, 80]))) + rng.choice([".", "!", ",", ";", "\n"])
    passages = [" ".join(sentence() for _ in range(rng.randrange(2, 12))) for _ in range(6)]
    rows = [(9000, None), (9001, ""), (9002, " \n ,"), (9003, "Short text. Twice."), (9004, "Short text. Twice.")]
    for i in range(n):
        parts = [sentence() for _ in range(rng.randrange(1, 25))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            parts.insert(rng.randrange(len(parts) + 1), rng.choice([p, p.upper(), p.replace(" ", "  ")]))
        rows.append((i, " ".join(parts)))
    whole = rows[20][1] + " " + passages[0]
    rows += [(500, whole), (501, whole), (501, whole), (None, whole), (None, passages[1] + " " + passages[1])]
    rng.shuffle(rows)
    return rows


def compare(spark, rows, parts, both_ends=True):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, place int, id string")
    VERSIONS.update({r.text: r.h for r in df.selectExpr("text", "hash(text) AS h").collect()})
    got = spans.remove_repeats(df.repartition(parts), both_ends=both_ends).collect()
    found = sorted(((r.doc_id, r.n_sentences, r.n_removed, None if r.text is None else re.sub(r"\s", "", r.text))
                    for r in got), key=str)
    assert found == brute(rows, both_ends)
    texts = dict(rows)
    for r in got:
        if r.text is not None and r.doc_id is not None:
            left, last = "", 0
            for s in r.removed:
                left, last = left + texts[r.doc_id][last:s.start], s.end
            assert left + texts[r.doc_id][last:] == r.text


@pytest.mark.parametrize("both_ends", [False, True])
@pytest.mark.parametrize("parts", [1, 7])
def test_against_brute_force(spark, parts, both_ends):
    compare(spark, corpus(), parts, both_ends)


def test_runs_over_batch_ends(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        compare(spark, corpus(40), 4)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_long_passage_inside_unlike_documents(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("klmnopqr") for _ in range(5))
    passage = " ".join(word() + ("," if i % 9 == 4 else "." if i % 13 == 6 else "") for i in range(60))
    texts = [" ".join(word() for _ in range(80)) for _ in range(30)]
    rows = [(i, f"{t} {passage} {t[::-1]}" if i % 3 == 0 else t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, text in rows:
        assert (got[i].n_removed > 0) == (i % 3 == 0 and i > 0)
        if not got[i].n_removed:
            assert got[i].text == text


def test_passage_without_marks(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("klmnopqr") for _ in range(5))
    passages = [" ".join(word() for _ in range(60)) for _ in range(20)]
    rows = [(k * 100 + i, " ".join([*(word() for _ in range(40)), p, *(word() for _ in range(40))]))
            for k, p in enumerate(passages) for i in range(2)]
    got = {r.doc_id: r.n_removed for r in spans.remove_repeats(
        spark.createDataFrame(rows, "doc_id bigint, text string"), both_ends=True).collect()}
    assert all(got[k * 100] == 0 for k in range(20)) and all(got[k * 100 + 1] > 0 for k in range(20))


def test_very_long_text_and_empty_table(spark):
    rng = random.Random(2)
    long = ", ".join(" ".join(str(rng.random()) for _ in range(8)) for _ in range(8000))
    rows = [(1, long), (2, "head. " + long)]
    got = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 8000
    assert spans.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def brute_cuts(words):
    """Winnowing: the last smallest hash of every window of 11 words."""
    hashes = [zlib.crc32(w.encode()) for w in words]
    windows = [range(i, i + 11) for i in range(len(words) - 10)]
    return sorted({min(w, key=lambda i: (hashes[i], -i)) for w in windows})


def test_long_cuts_against_brute_force():
    rng = random.Random(5)
    for n in [*range(14), *range(16, 400, 7)]:
        words = [rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(n)]
        assert spans.long_cuts(words) == brute_cuts(words)
    assert all(size <= 15 for size in spans.sentences_of("a " * 500)[1])
    for text in ("a " * 500, " ".join(str(rng.random()) for _ in range(500))):
        pieces, sizes, _ = spans.sentences_of(text)
        assert sum(sizes) == 500 and max(sizes) <= 15
        assert [a for a, _ in pieces] == [0, *(b for _, b in pieces[:-1])]


def test_runs_against_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        sizes = [rng.randrange(1, 12) for _ in range(rng.randrange(14))]
        digests = [bytes([i]) * 16 for i in range(len(sizes))]
        full = lambda i, j: j - i >= 2 and sum(sizes[i:j]) >= 20
        every = [(i, j) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1) if full(i, j)]
        heads = {(i, j) for i, j in every if not full(i, j - 1)}
        tails = {(i, j) for i, j in every if not full(i + 1, j)}
        for both, expected in ((False, heads), (True, heads | tails)):
            got = [(i, i + n) for i, n, _ in spans.runs_of(sizes, digests, 2, 20, both)]
            assert len(got) == len(set(got)) and set(got) == expected


@pytest.mark.parametrize("marks", [0.0, 0.05, 0.15])
def test_every_passage_of_over_fifty_words(spark, marks):
    """200 passages in two unlike documents each: none is missed, and each
    end keeps 15 words at most."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("klmnopqr") for _ in range(5)) + (
        rng.choice(".,;") if rng.random() < marks else "")
    lines = lambda n: " ".join(word() for _ in range(n))
    rows, places = [], {}
    for k in range(200):
        passage = lines(51 + k % 30)
        for i in range(2):
            head = lines(rng.randrange(5, 60)) + " "
            places[k * 2 + i] = (len(head), len(head) + len(passage))
            rows.append((k * 2 + i, f"{head}{passage} {lines(rng.randrange(5, 60))}"))
    got = {r.doc_id: r.removed for r in spans.remove_repeats(
        spark.createDataFrame(rows, "doc_id bigint, text string"), both_ends=True).collect()}
    texts = dict(rows)
    for doc, (start, end) in places.items():
        if doc % 2 == 0:
            assert got[doc] == []
            continue
        (cut,) = got[doc]
        assert start <= cut.start + 1 and cut.end <= end + 1
        assert len(texts[doc][start:cut.start].split()) <= 15 and len(texts[doc][cut.end:end].split()) <= 15
