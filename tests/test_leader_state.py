"""Leaders as keyed state equal the batch groups per command."""
import random

import pytest
from pyspark.sql import functions as F

from voxsift.operators.classify import noise_filter
from voxsift.operators.dedup import exact_groups
from voxsift.operators.fetch import with_order_key
from voxsift.sources import tables
from voxsift.streaming import leader_state


def _rows(df):
    return sorted(tuple(r) for r in df.select("command_id", "leader_id", "total_reviews", "total_votes").collect())


def _batch(spark, d):
    reviews = with_order_key(tables.reviews(spark, d)).withColumn("command_id", F.col("app_id"))
    return _rows(exact_groups(noise_filter(reviews)))


def test_equals_batch_groups(spark, sf):
    assert _rows(leader_state.stream_command_leaders_query(spark, sf)) == _batch(spark, sf)


def _folder(spark, sf, path, parts, seed):
    """The tables as folders; the documents shuffled over files, a third of
    them copies of one text of one app."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    first = rows[0]
    rows = [r if i % 3 else type(r)(**{**r.asDict(), "text": first.text.upper(), "source": first.source})
            for i, r in enumerate(rows)]
    random.Random(seed).shuffle(rows)
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size:(i + 1) * size], docs.schema).coalesce(1).write.mode("append").parquet(
            str(path / "documents.parquet"))
    spark.read.parquet(f"{sf}/events.parquet").write.parquet(str(path / "events.parquet"))


@pytest.mark.parametrize("files", [1, 2])
def test_shuffled_files_and_restarts_change_nothing(spark, sf, tmp_path, files):
    _folder(spark, sf, tmp_path, 3, files)
    d, run = str(tmp_path), str(tmp_path / "run")
    sink = leader_state.stream_command_leaders(spark, d, files, folder=run)
    want = _batch(spark, d)
    assert _rows(leader_state.leaders_now(spark, sink)) == want
    assert leader_state.stream_command_leaders(spark, d, files, folder=run) == sink  # nothing new
    assert _rows(leader_state.leaders_now(spark, sink)) == want
    # files that arrive later go on from the kept state
    more = spark.read.parquet(f"{d}/documents.parquet").limit(40).withColumn("doc_id", F.col("doc_id") + 100)
    more.coalesce(1).write.mode("append").parquet(f"{d}/documents.parquet")
    leader_state.stream_command_leaders(spark, d, files, folder=run)
    assert _rows(leader_state.leaders_now(spark, sink)) == _batch(spark, d) != want


def test_folding_rows():
    rows = leader_state.folded({}, [(1, 1, -5, 9, 1, 5), (1, 1, -5, 3, 1, 5), (1, 2, 0, 4, 1, 0), (1, 1, -7, 8, 2, 14)])
    assert rows == {(1, 1): [-7, 8, 4, 24], (1, 2): [0, 4, 1, 0]}
