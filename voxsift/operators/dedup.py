"""Duplicate folding (DED-1, SET-2, AGG-1, JN-3, JN-4, WIN-1, WIN-2, AGG-2).

* ``exact_groups``: copies with the same normalized text fold into the
  first one in rank order.  min/count/sum are all partially aggregated on
  the map side, so a group holding a third of all rows costs one row per
  map task in the shuffle.
* ``near_duplicate_leaders``: the sequential greedy-leader rule (a review
  is a duplicate when it is similar to an earlier *leader*) computed in
  distributed rounds without enumerating all similar pairs; see its
  docstring.
* ``replay_duplicates``: the reference's reply-driven decision with
  ``match_with`` indices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxsift.functions.replies import is_duplicate, match_index, parse_reply
from voxsift.functions.text import text_key


def exact_groups(df: DataFrame, keys: list[str] | None = None, text: str = "text") -> DataFrame:
    """One row per (command, normalized text): the leader (first in rank
    order), total reviews and total votes."""
    keys = keys or ["command_id"]
    first = F.min(F.struct("rank", "review_id", "votes")).alias("_first")
    g = (df.withColumn("_key", text_key(F.col(text)))
         .groupBy(*keys, "_key")
         .agg(first, F.count("*").alias("total_reviews"), F.sum("votes").alias("total_votes")))
    return g.select(*keys, F.col("_first.review_id").alias("leader_id"),
                    F.col("_first.rank").alias("leader_rank"),
                    F.col("total_reviews").cast("bigint").alias("total_reviews"),
                    F.col("total_votes").cast("bigint").alias("total_votes"))


def exact_membership(df: DataFrame, keys: list[str] | None = None, text: str = "text") -> DataFrame:
    """Every row with the leader of its exact-copy group (``is_leader``)."""
    keys = keys or ["command_id"]
    # An aggregate + join rather than a window: the window would gather each
    # group in one task, the aggregate combines on the map side.
    keyed = df.withColumn("_key", text_key(F.col(text)))
    leaders = keyed.groupBy(*keys, "_key").agg(
        F.min(F.struct("rank", "review_id")).alias("_first"))
    out = keyed.join(leaders, [*keys, "_key"])
    return out.withColumn("leader_id", F.col("_first.review_id")).withColumn(
        "is_leader", F.col("leader_id") == F.col("review_id")).drop("_first", "_key")


def replay_duplicates(df: DataFrame, keys: list[str] | None = None, reply: str = "reply",
                      strict_string: bool = True) -> DataFrame:
    """Apply recorded duplicate replies in rank order (JN-3, SCA-10/11, Q10).

    A row is a leader unless its reply strictly says ``"true"``; leaders get
    0-based indices in rank order (WIN-1).  A duplicate folds into leader
    ``match_with`` only when ``0 <= match_with < leaders before it``;
    otherwise it is dropped uncounted.  Returns one row per leader with
    total reviews and votes.  Commands are top-N fetches, so a command's
    rows are bounded by its count.
    """
    keys = keys or ["command_id"]
    v = parse_reply(F.col(reply))
    w = Window.partitionBy(*keys).orderBy("rank")
    d = (df.withColumn("_dup", is_duplicate(v, strict_string))
         .withColumn("_match", match_index(v))
         .withColumn("_leaders_before",
                     F.coalesce(F.sum((~F.col("_dup")).cast("int"))
                                .over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    leaders = (d.where(~F.col("_dup"))
               .withColumn("leader_idx", (F.col("_leaders_before")).cast("bigint"))
               .select(*keys, "leader_idx", F.col("review_id").alias("leader_id"),
                       F.col("votes").alias("_own_votes")))
    dups = (d.where(F.col("_dup") & (F.col("_match") >= 0) &
                    (F.col("_match") < F.col("_leaders_before")))
            .groupBy(*keys, F.col("_match").alias("leader_idx"))
            .agg(F.count("*").alias("_n"), F.sum("votes").alias("_v")))
    out = leaders.join(dups, [*keys, "leader_idx"], "left")
    return out.select(*keys, "leader_idx", "leader_id",
                      (F.lit(1) + F.coalesce(F.col("_n"), F.lit(0))).cast("bigint")
                      .alias("total_reviews"),
                      (F.col("_own_votes") + F.coalesce(F.col("_v"), F.lit(0))).cast("bigint")
                      .alias("total_votes"))


def leader_context(leaders: DataFrame, keys: list[str] | None = None,
                   summary: str = "summary", sep: str = ",\n") -> DataFrame:
    """AGG-2 / WIN-2 / SCA-12: for each leader, the summaries of all earlier
    leaders of its command joined with ``sep`` (the "past reviews" context
    of the duplicate prompt), plus its 0-based leader index.  This is
    quadratic in a command's leaders by nature; commands are top-N fetches.
    """
    keys = keys or ["command_id"]
    w = Window.partitionBy(*keys).orderBy("rank")
    prev = F.collect_list(F.col(summary)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return leaders.select(
        *keys, "review_id", (F.row_number().over(w) - 1).cast("bigint").alias("leader_idx"),
        F.size(prev).cast("bigint").alias("n_context"),
        F.array_join(prev, sep).alias("context"))
