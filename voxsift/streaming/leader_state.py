"""STR-2: the leaders of each command as keyed state.

``transformWithStateInPandas`` keeps, for every (command, shard), its leaders
in a map state: text key → first review in rank order, reviews and votes folded
so far.  A micro-batch folds its own rows first, then reads and writes only the
entries of the texts that it brings, and emits those as changed leaders.

* A command's texts are dealt into ``shards`` by their key, so a command with a
  third of all reviews is not one task; copies of a text share a shard.
* **Bound.**  The state of a shard holds one entry (about 100 bytes) for each
  distinct text that the command saw within ``ttl`` of processing time, over
  ``shards``; without a ``ttl`` it grows with the distinct texts, and the
  result equals the batch groups for ever.  With one, a leader that saw no
  review for that long is forgotten: a later copy starts a new leader.
* **Restart.**  State and offsets are committed together with the batch; the
  sink writes a batch's rows to a folder of its own, which a replay replaces.

The state lives in RocksDB on the executors and in the checkpoint folder.

Defined results: rows without a command form a command of their own; equal
votes are ordered by the review id; null votes count as none and come last.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from voxsift.functions.text import text_key
from voxsift.operators.classify import noise_filter
from voxsift.sinks.writers import write_delta
from voxsift.sources import tables
from voxsift.streaming.triage_stream import FILES_PER_TRIGGER, _run, table_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARDS = 16
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGED = ("command_id string, h1 bigint, h2 int, leader_id bigint, neg_votes bigint, "
           "total_reviews bigint, total_votes bigint")


def folded(rows, parts: Iterator):
    """Fold rows (h1, h2, neg_votes, review_id, n, votes) into ``rows``, a
    dict from (h1, h2) to [neg_votes, review_id, reviews, votes]."""
    for h1, h2, neg, review, n, votes in parts:
        old = rows.get((h1, h2))
        if old is None:
            rows[h1, h2] = [neg, review, n, votes]
        else:
            old[0], old[1] = min((old[0], old[1]), (neg, review))
            old[2] += n
            old[3] += votes
    return rows


class Leaders(StatefulProcessor):
    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("leaders", "h1 bigint, h2 int",
                                        "neg_votes bigint, review_id bigint, reviews bigint, votes bigint",
                                        self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        new: dict = {}
        for part in rows:
            folded(new, zip(*[part[c].tolist() for c in ("h1", "h2", "neg_votes", "review_id", "n", "votes")]))
        out = []
        for text, row in new.items():
            if self.state.containsKey(text):
                folded(new, [(*text, *self.state.getValue(text))])
            self.state.updateValue(text, tuple(row))
            out.append((key[0], *text, row[1], row[0], row[2], row[3]))
        yield pd.DataFrame(out, columns=["command_id", "h1", "h2", "leader_id", "neg_votes", "total_reviews",
                                         "total_votes"])

    def close(self) -> None:
        pass


def leader_changes(reviews: DataFrame, ttl_ms: int | None = None, shards: int = SHARDS) -> DataFrame:
    """The leaders that each micro-batch of ``reviews`` (command_id,
    review_id, votes, text) changed, as they stand after it."""
    votes = F.coalesce("votes", F.lit(0)).cast("bigint")
    # without votes a review comes last in rank order
    src = reviews.withColumn("_key", text_key(F.col("text"))).select(
        F.col("command_id").cast("string").alias("command_id"), F.col("_key.h1").alias("h1"),
        F.col("_key.h2").alias("h2"),
        F.coalesce(-F.col("votes").cast("bigint"), F.lit((1 << 62))).alias("neg_votes"),
        F.col("review_id").cast("bigint").alias("review_id"),
        F.lit(1).cast("bigint").alias("n"), votes.alias("votes"),
        F.pmod("_key.h1", F.lit(shards)).cast("int").alias("shard"))
    return src.groupBy("command_id", "shard").transformWithStateInPandas(
        Leaders(ttl_ms), CHANGED, "Update", "ProcessingTime" if ttl_ms else "None")


def stream_command_leaders(spark: SparkSession, sf_dir: str, files_per_trigger: int = FILES_PER_TRIGGER,
                           folder: str | None = None, ttl_ms: int | None = None) -> str:
    """Leaders per command (app) of the documents that arrive; returns the
    sink, which ``leaders_now`` reads."""
    docs = table_stream(spark, sf_dir, "documents", files_per_trigger)
    reviews = noise_filter(tables.reviews_from(docs, tables.table(spark, sf_dir, "events")))
    changes = leader_changes(reviews.withColumn("command_id", F.col("app_id")), ttl_ms)
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return _run(lambda sink: changes.writeStream.outputMode("update").foreachBatch(
            lambda b, e: write_delta(b, sink, e)), "command-leaders", spark, folder)
    finally:
        spark.conf.set(PROVIDER, before)


def leaders_now(spark: SparkSession, sink: str) -> DataFrame:
    """Each leader as the last batch that changed it left it."""
    last = F.max_by(F.struct("leader_id", "total_reviews", "total_votes"), F.col("batch")).alias("g")
    return spark.read.parquet(sink).groupBy("command_id", "h1", "h2").agg(last).select("command_id", "g.*")


def stream_command_leaders_query(spark, d):
    return leaders_now(spark, stream_command_leaders(spark, d))
