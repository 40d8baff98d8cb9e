"""mention/hashtag tokens and the cursor paging stop rule."""
from pyspark.sql import functions as F

from voxsift.functions.text import tags_of
from voxsift.operators.fetch import build_pages, explode_pages, page_log


def test_tags_ignore_email(spark):
    df = spark.createDataFrame([("hi @Shop and #Deal, mail a.b@shop.com #x_1",)], "text string")
    r = df.select(tags_of("text", "@").alias("m"), tags_of("text", "#").alias("h")).first()
    assert r.m == ["shop"] and r.h == ["deal", "x_1"]


def _fetched(spark, sizes):
    rows = []
    for cid, (available, n) in enumerate(sizes):
        rows += [(cid, i + 1, cid * 1000 + i, n, f"app{cid}") for i in range(available)]
    return spark.createDataFrame(
        rows, "command_id long, rank int, review_id long, fetch_n long, term string")


def test_page_log_and_stop_rule(spark):
    # command 0: 45 available, wants 45 (20+20+5); command 1: exactly 20, wants 30;
    # command 2: 60 offered, wants 30 -> read 20 + 10, never more than asked.
    f = _fetched(spark, [(45, 45), (20, 30), (60, 30)])
    rows = page_log(f.where(F.col("rank") <= F.col("fetch_n"))).collect()
    log = {(r.command_id, r.page_no): (r.rows_in_page, r.seen_before, r.page_limit) for r in rows}
    assert log[(0, 1)] == (20, 0, 20) and log[(0, 3)] == (5, 40, 5)
    assert log[(2, 2)] == (10, 20, 10)
    urls = {(r.command_id, r.page_no): r.request_url for r in rows}
    assert "continuation_token" not in urls[(0, 1)] and urls[(0, 1)].endswith("&limit=20")
    assert "continuation_token=0:3" in urls[(0, 3)] and "query=%40app0" in urls[(0, 3)]
    pages = build_pages(f)
    wanted = f.select("command_id", "fetch_n").distinct()
    got = explode_pages(pages, wanted).groupBy("command_id").count().collect()
    assert {r.command_id: r["count"] for r in got} == {0: 45, 1: 20, 2: 30}


def test_short_page_stops(spark):
    # a short page (5 rows) in the middle stops the read
    rows = [(0, 1, [(i, i) for i in range(1, 21)]), (0, 2, [(21, 21)] * 5), (0, 3, [(26, 26)] * 20)]
    pages = spark.createDataFrame(
        [(c, p, [{"rank": r, "review_id": v} for r, v in res]) for c, p, res in rows],
        "command_id long, page_no long, results array<struct<rank:int,review_id:long>>")
    wanted = spark.createDataFrame([(0, 100)], "command_id long, fetch_n long")
    assert explode_pages(pages, wanted).count() == 25
