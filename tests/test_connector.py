"""The page connector against the window form of the cursor rule."""
import random

import pytest
from pyspark.sql import functions as F

from voxsift.operators.fetch import build_pages, explode_pages
from voxsift.plans import catalog
from voxsift.sources import connector


def _rows(df):
    return sorted(tuple(r) for r in df.select("command_id", "page_no", "pos", "review_id").collect())


def _offered(spark, seed=1, commands=60):
    """Ranked rows of commands: several offer whole pages beyond their count."""
    rng = random.Random(seed)
    rows, review = [], 0
    for c in range(commands):
        have = rng.choice([0, 1, 19, 20, 21, 40, 55, 130])
        wanted = rng.choice([0, 1, 20, 25, 100])
        for rank in range(1, min(have, -(-wanted // 20) * 20) + 1):
            review += 1
            rows.append((c, rank, review, wanted))
    return spark.createDataFrame(rows, "command_id bigint, rank int, review_id bigint, fetch_n bigint")


def _pages(offered):
    return build_pages(offered).join(offered.select("command_id", "fetch_n").distinct(), "command_id")


@pytest.mark.parametrize("chains", [1, 2, 10])
def test_rows_equal_the_window_form(spark, tmp_path, chains):
    offered = _offered(spark)
    pages = _pages(offered)
    connector.store_pages(pages, str(tmp_path), chains=chains)
    want = _rows(explode_pages(build_pages(offered), offered.select("command_id", "fetch_n").distinct()))
    got = connector.read_pages(spark, str(tmp_path), chains)
    assert want and _rows(got) == want
    assert got.rdd.getNumPartitions() <= chains


def test_chains_span_record_batches(spark, tmp_path):
    offered = _offered(spark, 2)
    connector.store_pages(_pages(offered), str(tmp_path), chains=2)
    connector.register(spark)
    got = spark.read.format(connector.NAME).option("chains", 2).option("batch_rows", 1).load(str(tmp_path))
    assert _rows(got) == _rows(connector.read_pages(spark, str(tmp_path), 2))


def test_filters_are_pushed_down(spark, tmp_path):
    offered = _offered(spark, 3)
    connector.store_pages(_pages(offered), str(tmp_path), chains=10)
    every = connector.read_pages(spark, str(tmp_path), 10)
    some = every.where(F.col("command_id") == 7)
    assert _rows(some) == [r for r in _rows(every) if r[0] == 7]
    assert some.rdd.getNumPartitions() == 1
    several = every.where(F.col("command_id").isin(3, 7, 11) & (F.col("pos") > 2))
    assert _rows(several) == [r for r in _rows(every) if r[0] in (3, 7, 11) and r[2] > 2]
    assert several.rdd.getNumPartitions() <= 3
    assert _rows(every.where("command_id = 3 AND command_id = 7")) == []


def test_broken_chains(spark, tmp_path):
    full = [(1, i) for i in range(20)]
    rows = [(1, 2, full, "1:3", 60), (1, 3, full, "1:4", 60),          # no first page
            (2, 1, full, "2:2", 60), (2, 3, full, "2:4", 60),          # page 2 is missing
            (3, 1, full[:5], "3:2", 60), (3, 2, full, None, 60),       # short page before
            (4, 1, full, "4:2", None),                                 # no wanted count
            (5, 1, None, None, 60), (6, 1, full, None, 3)]
    pages = spark.createDataFrame(rows, "command_id bigint, page_no bigint, results array<struct<rank:int,"
                                        "review_id:bigint>>, continuation_token string, fetch_n bigint")
    connector.store_pages(pages, str(tmp_path), chains=3)
    got = _rows(connector.read_pages(spark, str(tmp_path), 3))
    assert {(r[0], r[1]) for r in got} == {(2, 1), (3, 1), (6, 1)}
    assert len(got) == 20 + 5 + 3


def test_empty_and_missing_folders(spark, tmp_path):
    assert _rows(connector.read_pages(spark, str(tmp_path))) == []
    assert _rows(connector.read_pages(spark, str(tmp_path / "none"))) == []


def test_stream_reads_each_fetch_once_over_restarts(spark, tmp_path):
    path, sink, ck = str(tmp_path / "pages"), str(tmp_path / "sink"), str(tmp_path / "ck")

    def run():
        q = (connector.stream_pages(spark, path, 4).writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
        return _rows(spark.read.parquet(sink))

    offered = _offered(spark, 4)
    odd = offered.where("command_id % 2 = 1")
    connector.store_pages(_pages(odd), path, 0, 4)
    first = run()
    assert first == _rows(connector.read_pages(spark, path, 4))
    assert run() == first                                              # nothing new
    connector.store_pages(_pages(offered.where("command_id % 2 = 0")), path, 1, 4)
    (tmp_path / "pages" / "fetch=2" / "chains=0").mkdir(parents=True)  # a write in progress
    assert run() == _rows(connector.read_pages(spark, path, 4)) != first


def test_query_equals_page_explode(spark, sf):
    want = _rows(catalog.page_explode(spark, sf))
    assert _rows(catalog.page_connector(spark, sf)) == want
    assert _rows(catalog.page_connector_stream(spark, sf)) == want
