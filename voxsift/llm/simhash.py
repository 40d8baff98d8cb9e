"""SimHash near-duplicates over a byte-position inverted index.

A 64-bit fingerprint has eight positional bytes.  Two fingerprints that
differ in at most ``max_bits`` bits differ in at most ``max_bits`` bytes, so
they share at least ``8 - max_bits`` positional bytes: that guaranteed count
is the count filter.  Posting lists of single bytes hold 1/256 of the corpus
each and cannot be joined pairwise, so the tally is made inside the index:
the postings of a fingerprint are all combinations of ``8 - max_bits`` of its
positional bytes (70 for four bits).  Two fingerprints meet in a posting list
exactly if they share that many positional bytes; no qualifying pair is
missed and no other pair is ever a candidate.  Candidates are verified by
their bit distance.

Equal fingerprints are folded into one representative before the index is
built, so a hot group of copies is one row there.  Inside a posting list only
the edges of a spanning forest are emitted (a search that removes what it has
reached), never all pairs; components do not need more.  Edges of all lists
are joined into components by alternating large-star and small-star rounds,
checkpointed in the shared folder.

Defined results: a null or blank text has no words and fingerprint zero, and
zero fingerprints link like any others; repeated rows and repeated ids give
one output row each; a null id is kept, and is a component's id only where
the component has no other; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, cut, release, shuffle_partitions, slices

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SLICE_BYTES = 1 << 20


# -- inside tasks ---------------------------------------------------------

def spread_table():
    """For each byte value, its eight bits in the eight bytes of a word."""
    import numpy as np

    values = np.arange(256, dtype=np.uint64)
    table = np.zeros(256, np.uint64)
    for bit in range(8):
        table |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(8 * bit)
    return table


def majority_bits(hashes, counts):
    """Per run of ``counts`` hashes, the bits set in over half of them.

    Bits are counted in byte lanes, in chunks of at most 255 hashes, and the
    chunks of a run are added up afterwards."""
    import numpy as np

    counts = np.asarray(counts, np.int64)
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    runs = counts[some]
    starts = np.concatenate([[0], np.cumsum(runs)[:-1]])
    n_chunks = -(-runs // 255)
    owner = np.repeat(np.arange(len(runs)), n_chunks)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
    chunk_starts = starts[owner] + within * 255
    lanes = np.ascontiguousarray(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    table = spread_table()
    first_chunk = np.cumsum(n_chunks) - n_chunks
    fingerprints = np.zeros(len(runs), np.uint64)
    for byte in range(8):
        sums = np.add.reduceat(table[lanes[:, byte]], chunk_starts)
        per_bit = sums.view(np.uint8).reshape(-1, 8).astype(np.int64)
        totals = np.add.reduceat(per_bit, first_chunk, axis=0)
        bits = np.packbits(totals * 2 > runs[:, None], axis=1, bitorder="little")[:, 0]
        fingerprints |= bits.astype(np.uint64) << np.uint64(8 * byte)
    out[some] = fingerprints
    return out


def fingerprints_of(texts, shingle_words=SHINGLE_WORDS, seed=SEED):
    """64-bit SimHash of each text (None: no words)."""
    import numpy as np
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes, counts = [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            counts.append(0)
            continue
        joined = b" ".join(words)
        if len(words) < shingle_words:
            hashes.append(digest(joined, seed))
            counts.append(1)
            continue
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        n = len(words) - shingle_words + 1
        begins = [0, *(gaps[: n - 1] + 1).tolist()]
        ends = [*gaps[shingle_words - 1:].tolist(), len(joined)]
        hashes += [digest(joined[a:b], seed) for a, b in zip(begins, ends)]
        counts.append(n)
    return majority_bits(np.array(hashes, np.uint64), counts)


def posting_keys(fps, max_bits):
    """(combination number, packed bytes) as one int64 key for each
    fingerprint and combination, combinations in the outer order."""
    import numpy as np

    keep = 8 - max_bits
    lanes = np.ascontiguousarray(fps, dtype="<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
    parts = []
    for number, chosen in enumerate(combinations(range(8), keep)):
        key = np.full(len(fps), number, np.int64)
        for at in chosen:
            key = (key << 8) | lanes[:, at]
        parts.append(key)
    return parts


def forest_edges(members, max_bits):
    """Spanning-forest edges of the members (distinct fingerprints that share
    a posting) under the bit distance: a search from each member in turn
    that visits only what no search has reached yet."""
    import numpy as np

    left, right = [], []
    rest = members
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            near = np.bitwise_count(rest ^ here) <= max_bits
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), here, np.uint64))
                right.append(found)
                queue.extend(found)
                rest = rest[~near]
    return left, right


def list_edges(keys, fps, max_bits):
    """Edges of all posting lists in arrays sorted by key."""
    import numpy as np

    bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(bounds)
    left, right = [], []
    two = bounds[:-1][sizes == 2]
    if len(two):
        a, b = fps[two], fps[two + 1]
        near = np.bitwise_count(a ^ b) <= max_bits
        left.append(a[near])
        right.append(b[near])
    for i in np.flatnonzero(sizes > 2):
        more = forest_edges(fps[bounds[i]:bounds[i + 1]], max_bits)
        left += more[0]
        right += more[1]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


# -- Spark plans ----------------------------------------------------------

def fingerprint(docs: DataFrame, keep: dict[str, str], text_col: str = "text", fp_col: str = "fp",
                shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` (name -> name in the result) and the fingerprint
    (bigint) of every row; no shuffle."""
    src = docs.select(col(text_col).cast("string").alias("text"),
                      *[col(c).alias(str(i)) for i, c in enumerate(keep)])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for start, stop in slices(batch, 0, SLICE_BYTES):
                part = batch.slice(start, stop - start)
                fps = fingerprints_of(part.column(0).to_pylist(), shingle_words, seed)
                arrays = [*part.columns[1:], pa.array(fps.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
            release()

    kinds = [f.dataType.simpleString() for f in src.schema.fields[1:]] + ["bigint"]
    out = src.mapInArrow(run, ", ".join(f"`{i}` {k}" for i, k in enumerate(kinds)))
    return out.toDF(*keep.values(), fp_col)


def near_edges(reps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints at most ``max_bits`` apart
    that connect the same components as all such links do."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be between 0 and 7")
    spark = reps.sparkSession

    def postings(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            fps = np.asarray(batch.column(0), dtype=np.int64)
            for start in range(0, len(fps), 1 << 14):
                part = fps[start:start + (1 << 14)]
                keys = posting_keys(part.view(np.uint64), max_bits)
                for at in range(0, len(keys), 10):
                    block = np.concatenate(keys[at:at + 10])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block), pa.array(np.tile(part, len(block) // len(part)))],
                        names=["key", "fp"])

    def verify(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        key = np.zeros(0, np.int64)
        fp = np.zeros(0, np.uint64)

        def edges(keys, fps):
            a, b = list_edges(keys, fps, max_bits)
            a, b = a.view(np.int64), b.view(np.int64)
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([key, np.asarray(batch.column(0), dtype=np.int64)])
            fp = np.concatenate([fp, np.asarray(batch.column(1), dtype=np.int64).view(np.uint64)])
            # the last list may go on in the next batch
            done = int(np.searchsorted(key, key[-1], side="left"))
            if done:
                yield edges(key[:done], fp[:done])
                key, fp = key[done:], fp[done:]
        if len(key):
            yield edges(key, fp)

    index = reps.select("fp").mapInArrow(postings, "key bigint, fp bigint")
    lists = index.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key")
    return lists.mapInArrow(verify, "a bigint, b bigint").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b): alternating large-star
    and small-star rounds until nothing changes; root is the component's
    smallest node.  Each round is a checkpoint in the shared folder."""

    def minimum(sym: DataFrame) -> DataFrame:
        least = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return sym.join(least, "u")

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = cut(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    seen = state(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        sym = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = minimum(sym).where(F.col("v") > F.col("u")).select(
            F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        joined = minimum(down)
        small = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            joined.select(F.col("u").alias("a"), F.col("m").alias("b"))
        ).where("a != b").distinct()
        now = cut(small)
        after = state(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    seed: int = SEED) -> DataFrame:
    """One row per input row: the id, ``fp`` (bigint), ``n_same`` (rows with
    the same fingerprint) and ``component`` (smallest id reachable over links
    of at most ``max_bits`` differing bits)."""
    fps = cut(fingerprint(docs, {id_col: "id"}, text_col, "fp", shingle_words, seed))
    return fps.join(_groups(fps, max_bits), "fp").select(
        F.col("id").alias(id_col), "fp", "n_same", "component")


def _groups(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, n_same, least, root, component) of each distinct fingerprint of
    the rows (id, fp)."""
    reps = fps.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n_same"))
    labels = components(near_edges(reps, max_bits))
    roots = reps.join(labels, reps.fp == labels.node, "left").select(
        "fp", "least", "n_same", F.coalesce("root", "fp").alias("root"))
    ids = roots.groupBy("root").agg(F.min("least").alias("component"))
    return roots.join(ids, "root").select("fp", "n_same", "least", "root", "component")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
               seed: int = SEED) -> DataFrame:
    """The documents, all columns, with one row of each component: the one
    of the smallest id (then smallest fingerprint); of several such rows the
    one of the shortest text, then the first in the order of all columns.
    A row without an id stays only if its component has no id."""
    fps = cut(fingerprint(docs, {id_col: "id"}, text_col, "fp", shingle_words, seed))
    groups = _groups(fps, max_bits)
    # min() passes over nulls, so a component's rows without ids lose to others
    first = groups.groupBy("root").agg(F.min(F.struct(
        F.col("least").isNull().alias("missing"), "least", "fp")).alias("first"))
    keepers = first.select(F.col("first.least").alias("keep_id"), F.col("first.fp").alias("keep_fp"))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = fingerprint(docs, names, text_col, "fp", shingle_words, seed)
    mine = names[id_col]
    # a total order of distinct rows, whatever order they come in
    order = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() or "variant" in
             f.dataType.simpleString() else F.col(f.name) for f in rows.schema.fields if f.name != "fp"]
    one = Window.partitionBy(mine, "fp").orderBy(F.length(names[text_col]), *order)
    rows = rows.withColumn("place", F.row_number().over(one)).where("place = 1")
    kept = rows.join(keepers, rows[mine].eqNullSafe(keepers.keep_id) & (rows.fp == keepers.keep_fp), "left_semi")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def fingerprint_hex(fp):
    """A bigint fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
