"""SimHash near-duplicates against a brute-force version."""

import random

import pytest
import xxhash

from voxsift.llm import simhash

MASK = (1 << 64) - 1


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < 4:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits=4):
    """fps: list of (id, fp); smallest id reachable of each."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(fps):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(fps))]


def compare(spark, rows, schema="doc_id bigint, text string"):
    got = simhash.near_duplicates(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "fp", "n_same", "component"]
    fps = [(r[0], brute_fp(r[1])) for r in rows]
    want = sorted(((d, fp, c) for (d, fp), c in zip(fps, brute_components(fps))), key=str)
    assert sorted(((r.doc_id, r.fp & MASK, r.component) for r in got.collect()), key=str) == want


def text_of(rng, n):
    return " ".join(rng.choice("alpha Beta gamma delta eps zeta Öl é".split()) + str(rng.randrange(30))
                    for _ in range(n))


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        words = text_of(rng, rng.choice([3, 4, 5, 40, 300, 700])).split()
        rows.append((i, " ".join(words)))
        for k in range(rng.randrange(3)):
            other = list(words)
            other[rng.randrange(len(other))] = "changed"
            rows.append((1000 + 10 * i + k, "\n\t".join(other)))
    rows += [(2000, None), (2001, ""), (2002, " \n\x0b"), (2003, "A b"), (2004, "a B"),
             (5, "repeated id"), (5, "repeated id"), (None, "repeated id"), (None, "lone null id here ok")]
    compare(spark, rows)


def test_empty_table(spark):
    compare(spark, [])


def test_long_text_and_clashing_columns(spark):
    rng = random.Random(2)
    long = text_of(rng, 60_000)
    rows = [(1, long, 1, "x"), (2, long + " tail", 2, "y"), (3, "short", 3, "z")]
    compare(spark, rows, "doc_id bigint, text string, fp int, component string")


@pytest.mark.parametrize("max_bits", [0, 2, 4, 6])
def test_edges_connect_all_links(spark, max_bits):
    rng = random.Random(max_bits)
    fps = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(12):
            base ^= 1 << rng.randrange(64)
            base ^= 1 << rng.randrange(64)
            fps.add(base)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.near_edges(spark.createDataFrame([(x,) for x in signed], "fp bigint"), max_bits)
    for a, b in edges.collect():
        assert bin((a ^ b) & MASK).count("1") <= max_bits
    labels = {r.node: r.root for r in simhash.components(edges).collect()}
    by_id = brute_components(list(zip(signed, fps)), max_bits)
    got = [labels.get(x, x) for x in signed]
    assert got == by_id


def test_long_chain_settles(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a bigint, b bigint")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_equal_ids_and_texts_leave_the_same_row_in_any_order(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, "p"), (1, words, "q"), (1, words, None), (2, words, "a")]
    for order in (rows, rows[::-1], [rows[1], rows[0], rows[3]]):
        docs = spark.createDataFrame(order, "doc_id bigint, text string, src string")
        kept = simhash.keep_first(docs).collect()
        assert [tuple(r) for r in kept] == [min(
            (r for r in order if r[0] == 1), key=lambda r: (r[2] is not None, r[2] or ""))]
