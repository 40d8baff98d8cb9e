"""Merkle manifest against a tree built level by level."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from voxsift.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def climb(digests):
    """Levels of a tree, from the leaves to the root."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 8]) for i in range(0, len(last), 8)])
    return levels


def siblings(levels, place):
    out = []
    for level in levels[:-1]:
        first = place // 8 * 8
        out += [(level[first:place], level[place + 1:first + 8])]
        place //= 8
    return out


def brute(rows):
    """(id, leaf, subroot, root, proof) of rows (id, group, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], leaf(*r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([d for _, d in sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))])
             for g in order}
    top = climb([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        members = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        for place, (i, d) in enumerate(members):
            proof = siblings(trees[g], place) + siblings(top, k)
            out.append((i, d, trees[g][-1][0], top[-1][0], [("".join(b), "".join(a)) for b, a in proof]))
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512])
def test_sweeps_over_a_block(n):
    digests = [h(str(i)) for i in range(n)]
    want = climb(digests)
    level = merkle.levels_of(0, n)
    assert level == len(want) - 1
    head, nodes = merkle.upwards(digests, level)
    assert head == want[-1][0]
    assert [label for label, _ in nodes] == sorted(label for label, _ in nodes)
    suffix = [("x", "y")]
    ways = merkle.downwards(n, nodes, suffix)
    assert ways == [[("".join(b), "".join(a)) for b, a in siblings(want, i)] + suffix for i in range(n)]


def test_last_block_climbs_to_its_head():
    # a block that is not alone: one leaf still becomes a node at each level
    head, nodes = merkle.upwards([h("a")], merkle.levels_of(3, 1))
    assert head == h(h(h(h("a")))) and len(nodes) == 3


def corpus():
    rng = random.Random(4)
    rows = []
    for group, n in (("en", 1100), ("de", 513), ("é", 9), (None, 65), ("one", 1), ("", 8)):
        rows += [(rng.randrange(10 ** 6), group, "tèxt %d" % rng.randrange(99)) for _ in range(n)]
    rows += [(7, "en", "same row")] * 700 + [(7, "en", None), (None, "en", "x"), (None, "en", "x")]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    # column names that the operator uses inside must not clash
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows],
                                 "id bigint, `group` string, text string, place int, proof string").repartition(5)
    got = merkle.manifest(docs, ["id", "group", "text"], "group", "id", {"digest": F.upper("text")})
    found = got.withColumn("folded", merkle.folded(F.col("leaf"), F.col("proof"))).collect()
    shape = lambda r: (r.id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof])
    key = lambda x: (str(x[0]), x[1:])
    assert sorted(map(shape, found), key=key) == sorted(brute(rows), key=key)
    assert all(r.folded == r.root for r in found)
    assert {(r.id, r.digest) for r in found} == {(i, t and t.upper()) for i, _, t in rows}


def test_tampered_row_fails(spark):
    docs = spark.createDataFrame([(i, "en", f"Text {i}", "s", 6) for i in range(70)],
                                 "doc_id bigint, lang string, text string, source string, n_chars int")
    lowered = merkle.leaf_digest(F.col("doc_id"), F.lower("text"))
    found = merkle.manifest(docs, ["doc_id", "text"], carry={"other": F.when(F.crc32(
        F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lowered)}).withColumn(
        "ok", merkle.folded(F.coalesce("other", "leaf"), F.col("proof")) == F.col("root"))
    got = {r.doc_id: r.ok for r in found.collect()}
    assert got == {i: crc32(str(i).encode()) % 3 != 0 for i in range(70)}


def test_empty_table_and_single_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, lang string, text string")
    assert merkle.manifest(empty, ["doc_id", "lang", "text"]).collect() == []
    one = spark.createDataFrame([(1, None, None)], "doc_id bigint, lang string, text string")
    row = merkle.manifest(one, ["doc_id", "lang", "text"]).first()
    assert row.leaf == row.subroot == row.root == leaf(1, None, None) and row.proof == []


def test_very_long_text(spark):
    docs = spark.createDataFrame([(i, "en", "wörd " * 400_000 if i == 2 else "") for i in range(3)],
                                 "doc_id bigint, lang string, text string")
    got = {r.doc_id: r.leaf for r in merkle.manifest(docs, ["doc_id", "text"]).collect()}
    assert got[2] == leaf(2, "wörd " * 400_000) and got[0] == leaf(0, "")
