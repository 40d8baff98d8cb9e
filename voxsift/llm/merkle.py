"""A Merkle manifest of a dataset by time-forward processing.

Each row is a leaf: the digest of its fields.  Leaves of one group, in the
order of the id, form a tree of ``FANOUT`` children a node (the last node of a
level may have fewer); the groups' roots, in the order of the group, form one
more tree, whose root stands for the dataset.

Nodes carry labels that ascend from children to parents: (last leaf below,
level).  A node's digest is a message to its parent's label in a priority
queue; the sweep takes labels in ascending order, so a parent finds all its
children's digests at the head of the queue.  A second sweep runs the labels in
descending order: each node finds the rest of its way to the root, its proof
suffix, at the head of the queue and sends every child that suffix behind the
child's own siblings, until the leaves hold whole proofs.

On Spark the queue is external: labels are dealt into blocks of ``BLOCK``
consecutive leaves (three levels), the messages that leave a block are rows of
a table that a shuffle delivers to the block of their recipient, and a heap
orders the labels inside a block.  A block's head is a leaf of the next round,
so n leaves take log_512 n rounds upwards and as many back.  A task holds one
block at a time, whatever the size of a group.

Places in a group come from a range sort by (group, id, digest) and one number
a partition (how many leaves of its first group lie in earlier partitions);
that table has a row per partition and is the only thing sent to the driver
and broadcast, besides the root.

Defined results: a null field is a mark of its own; null groups form a group
that comes first, null ids come first in a group; rows of one id are ordered by
their digest, and equal rows are a leaf each; a group of one row has that leaf
as its root, and one group's root is the root; an empty table gives an empty
result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, cut

FANOUT = 8
LEVELS = 3  # of a block
BLOCK = FANOUT ** LEVELS

STEP = "struct<before:string,after:string>"


# -- digests as column expressions ----------------------------------------

def leaf_digest(*fields: Column) -> Column:
    """Lower-case hex SHA-256 of the fields: ``-`` for a null one, else its
    length in UTF-8 bytes, a colon and the value."""
    def shown(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.sha2(F.concat(*map(shown, fields)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to; whoever knows the dataset's
    root can check a row with it."""
    return F.aggregate(proof, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


# -- the sweeps over a block ----------------------------------------------

def parent(label, n, last_level):
    """The label of the node above (``n`` leaves, ``last_level`` levels); the
    highest node has none."""
    place, level = label
    if level == last_level:
        return None
    width = FANOUT ** (level + 1)
    return min(n, (place // width + 1) * width) - 1, level + 1


def upwards(leaves, last_level):
    """Time-forward sweep over a block's leaf digests, in order: its head's
    digest and the inner nodes (label, children) by ascending label."""
    from hashlib import sha256
    from heapq import heappop, heappush

    n, queue, nodes = len(leaves), [], []

    def deliver(before):
        """Work off the labels below ``before``."""
        head = None
        while queue and queue[0][0] < before:
            label, children = queue[0][0], []
            while queue and queue[0][0] == label:
                children.append(heappop(queue)[1:])
            nodes.append((label, children))
            head = sha256("".join([digest for _, digest in children]).encode()).hexdigest()
            if above := parent(label, n, last_level):
                heappush(queue, (above, label, head))
        return head

    for place, digest in enumerate(leaves):
        deliver((place, 0))
        if above := parent((place, 0), n, last_level):
            heappush(queue, (above, (place, 0), digest))
    return (deliver((n, 0)) if last_level else leaves[0]), nodes


def downwards(n, nodes, suffix):
    """Reversed sweep: the proof of each leaf of a block, given its head's.
    A proof is a list of (digests before, digests after) from the leaf up."""
    from heapq import heappop, heappush

    out = [suffix] * n
    queue = []
    if nodes:
        place, level = nodes[-1][0]
        heappush(queue, ((-place, -level), suffix))
    for label, children in reversed(nodes):
        key, way = heappop(queue)
        assert key == (-label[0], -label[1])
        digests = [digest for _, digest in children]
        for i, ((place, level), _) in enumerate(children):
            own = [("".join(digests[:i]), "".join(digests[i + 1:])), *way]
            if level:
                heappush(queue, ((-place, -level), own))
            else:
                out[place] = own
    return out


def levels_of(block, n):
    """Levels to climb in a block of n leaves: until one node remains if the
    block is all there is, else up to the block's head."""
    if block or n == BLOCK:
        return LEVELS
    level, width = 0, 1
    while width < n:
        level, width = level + 1, width * FANOUT
    return level


# -- Spark plan -----------------------------------------------------------

def numbered(leaves: DataFrame) -> tuple[DataFrame, int]:
    """The leaves (group, id, digest, ...) with their ``place`` in the group,
    and the size of the largest group."""
    spark = leaves.sparkSession
    # equal rows are told apart by their place in the input, so that they can be dealt to many tasks
    order = ["group", "id", "digest", "tie"]
    told = leaves.withColumn("tie", F.monotonically_increasing_id())
    ranged = cut(told.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "part", F.spark_partition_id()))
    sizes = ranged.groupBy("part", "group").agg(F.count("*").alias("n")).groupBy("part").agg(
        F.min(F.struct("group", "n")).alias("first"), F.max(F.struct("group", "n")).alias("last"),
        F.max("n").alias("most")).collect()  # a row per partition
    before, largest, carried, group = {}, 0, 0, None
    for r in sorted(sizes, key=lambda r: r.part):
        before[r.part] = carried if r.first.group == group else 0
        alone = r.first.group == r.last.group
        largest = max(largest, r.most, before[r.part] + r.first.n)
        group, carried = r.last.group, r.last.n + (before[r.part] if alone else 0)
    earlier = spark.sparkContext.broadcast(before)
    at, group_at = ranged.columns.index("part"), ranged.columns.index("group")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        group, following = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if following is None:
                group, following = batch.column(group_at)[0].as_py(), earlier.value[batch.column(at)[0].as_py()]
            spans = pc.run_end_encode(batch.column(group_at))
            places, start = np.empty(batch.num_rows, np.int64), 0
            for name, stop in zip(spans.values.to_pylist(), spans.run_ends.to_pylist()):
                if name != group:
                    group, following = name, 0
                places[start:stop] = np.arange(following, following + stop - start)
                following += stop - start
                start = stop
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)],
                                             names=[*batch.schema.names, "place"])

    schema = T.StructType([*ranged.schema.fields, T.StructField("place", T.LongType())])
    return ranged.mapInArrow(run, schema).drop("part", "tie"), largest


def paged(nodes: DataFrame) -> DataFrame:
    """A row per block: ``leaves`` holds at most BLOCK structs."""
    inner = [c for c in nodes.columns if c != "group"]
    return nodes.groupBy("group", F.expr(f"place div {BLOCK}").alias("block")).agg(
        F.collect_list(F.struct(*inner)).alias("leaves"))


def heads(pages: DataFrame) -> DataFrame:
    """Sweep upwards: each block's head as a node of the next round."""
    src = pages.select("group", "block", F.transform(
        "leaves", lambda x: F.struct(x["place"].alias("place"), x["digest"].alias("digest"))).alias("leaves"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = []
            for i, block in enumerate(batch.column(1).to_pylist()):
                leaves = sorted(batch.column(2)[i].as_py(), key=lambda x: x["place"])
                found.append(upwards([x["digest"] for x in leaves], levels_of(block, len(leaves)))[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())],
                                             names=["group", "place", "digest"])

    return src.mapInArrow(run, "`group` binary, place bigint, digest string")


def proofs(pages: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Sweep downwards: a row per leaf of the blocks, with its ``proof``, the
    columns of ``suffixes`` (group, block, proof and others) and its own."""
    src = pages.join(suffixes, ["group", "block"])
    leaf_type = src.schema["leaves"].dataType.elementType
    more = [f for f in src.schema.fields if f.name not in ("leaves", "proof")]
    names = [f.name for f in more]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        step = pa.struct([("before", pa.string()), ("after", pa.string())])
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                leaves = row.column("leaves").flatten()
                leaves = leaves.take(pc.sort_indices(leaves.field("place")))
                n, digests = len(leaves), leaves.field("digest").to_pylist()
                block = row.column("block")[0].as_py()
                suffix = [(s["before"], s["after"]) for s in row.column("proof")[0].as_py()]
                _, nodes = upwards(digests, levels_of(block, n))
                ways = downwards(n, nodes, suffix)
                same = pa.array([0] * n)
                yield pa.RecordBatch.from_arrays(
                    [*[row.column(c).take(same) for c in names],
                     pa.array([[{"before": b, "after": a} for b, a in way] for way in ways], pa.list_(step)), leaves],
                    names=[*names, "proof", "leaf"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in more)
    return src.mapInArrow(run, f"{schema}, proof array<{STEP}>, leaf {leaf_type.simpleString()}")


def rounds(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Sweep upwards over all rounds: each round's blocks, and the last one's
    heads, one a group."""
    nodes, largest = numbered(leaves)
    pages = []
    while True:
        pages.append(cut(paged(nodes)))
        nodes, largest = heads(pages[-1]), -(-largest // BLOCK)
        if largest <= 1:
            return pages, cut(nodes)


def back(pages: list[DataFrame], suffixes: DataFrame) -> DataFrame:
    """Sweep downwards over all rounds."""
    others = [c for c in suffixes.columns if c not in ("group", "block", "proof")]
    for blocks in pages[:0:-1]:
        suffixes = proofs(blocks, suffixes).select("group", F.col("leaf.place").alias("block"), "proof", *others)
    return proofs(pages[0], suffixes)


def manifest(docs: DataFrame, fields: list[str], group_col: str = "lang", id_col: str = "doc_id",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``leaf``, ``subroot`` (of its
    group), ``root`` and ``proof``: from the leaf to the root, the digests
    ``before`` and ``after`` it in its node.  Digests are lower-case hex text.
    ``carry`` names further columns to compute from the row and pass on."""
    carry = carry or {}
    named = col(group_col).cast("string").cast("binary")
    leaves = cut(docs.select(
        F.when(named.isNull(), F.lit(b"")).otherwise(F.concat(F.lit(b"\x01"), named)).alias("group"),
        col(id_col).alias("id"), leaf_digest(*map(col, fields)).alias("digest"),
        *([F.struct(*[c.alias(name) for name, c in carry.items()]).alias("carried")] if carry else [])))
    pages, subroots = rounds(leaves)
    # the groups' roots are the leaves of one more tree
    above, top = rounds(subroots.select(F.lit(b"").alias("group"), F.col("group").alias("id"), "digest"))
    head = top.select("digest").first()
    root = F.lit(head.digest if head else None).cast("string")
    ways = back(above, top.select("group", F.lit(0).cast("bigint").alias("block"),
                                  F.array().cast(f"array<{STEP}>").alias("proof")))
    found = back(pages, ways.select(F.col("leaf.id").alias("group"), F.lit(0).cast("bigint").alias("block"), "proof",
                                    F.col("leaf.digest").alias("subroot")))
    return found.select(F.col("leaf.id").alias(id_col), F.col("leaf.digest").alias("leaf"), "subroot",
                        root.alias("root"), "proof", *[F.col(f"leaf.carried.`{c}`").alias(c) for c in carry])
