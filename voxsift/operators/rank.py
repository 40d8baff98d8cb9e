"""SRT-2 / SRT-3: a dense position over all rows without a one-task window.

``row_number()`` over an unpartitioned window sorts the whole table in one
task.  Here a range partitioning puts the rows in order over many tasks; a row's
position is the number of rows in earlier partitions (a prefix sum over one
count per partition, the only thing that reaches the driver) plus its place in
its own sorted partition.  The sorted frame is checkpointed in the shared
folder, so that counts and places are of the same partitions even if a task
is run again.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxsift.session import materialize
from voxsift.sources import tables

#: Fixed value: the part of monotonically_increasing_id() that counts inside a partition.
PLACE_BITS = 33
#: Weights of the registered engagement order.
ENGAGEMENT = {"votes": 3, "author_posts": 1}


def global_rank(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with its 1-based position in ``order``, which should be total
    (rows of equal keys get neighbouring positions in any order).  Nulls go
    where the sort order puts them; an empty table stays empty."""
    ranged = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order))
    row = F.monotonically_increasing_id()
    part = F.shiftright(row, PLACE_BITS)
    sizes = {r.part: r.n for r in ranged.select(part.alias("part")).groupBy("part").agg(
        F.count("*").alias("n")).collect()}
    parts = sorted(sizes)
    starts = dict(zip(parts, accumulate([0, *[sizes[p] for p in parts]])))
    spark = df.sparkSession
    table = spark.createDataFrame(list(starts.items()), "_part bigint, _before bigint")
    placed = ranged.withColumn("_row", row).withColumn("_part", F.shiftright("_row", PLACE_BITS))
    # one row a partition: a proven bound for the broadcast
    return placed.join(F.broadcast(table), "_part").withColumn(
        name, F.col("_before") + F.col("_row").bitwiseAND((1 << PLACE_BITS) - 1) + 1).drop("_part", "_before", "_row")


def engagement(df: DataFrame, weights: dict[str, int]) -> Column:
    """A weighted sum of count columns; null counts as 0."""
    total = F.lit(0).cast("bigint")
    for name, weight in weights.items():
        total = total + F.coalesce(F.col(name), F.lit(0)).cast("bigint") * F.lit(weight)
    return total


# --- registered query -------------------------------------------------------

def engagement_rank_query(spark, d):
    """All reviews by votes and their author's number of reviews."""
    reviews = tables.reviews(spark, d).select("review_id", "username", "votes")
    authors = reviews.groupBy("username").agg(F.count("*").alias("author_posts"))
    scored = reviews.join(authors, "username")
    scored = scored.select("review_id", engagement(scored, ENGAGEMENT).alias("engagement"))
    return global_rank(scored, [F.col("engagement").desc(), F.col("review_id").asc()])
