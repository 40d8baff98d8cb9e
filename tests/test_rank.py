"""Positions over all rows, and the join on hot keys."""
import random

from pyspark.sql import functions as F

from voxsift.operators.fetch import join_by_rows, join_on_hot_keys
from voxsift.operators.rank import engagement_rank_query, global_rank


def test_positions_are_dense_and_in_order(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 1, 2, 5, 5, 5, 9])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, score bigint").repartition(7)
    got = global_rank(df, [F.col("score").desc(), F.col("id").asc()]).collect()
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert sorted((r.position, r.id) for r in got) == [(k, i) for k, (i, _) in enumerate(order, 1)]


def test_equal_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1,)] * 500, "id bigint")
    assert sorted(r.position for r in global_rank(df, [F.col("id")]).collect()) == list(range(1, 501))
    assert global_rank(df.limit(0), [F.col("id")]).collect() == []


def test_plan_has_no_window(spark, sf):
    plan = engagement_rank_query(spark, sf)._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_hot_key_is_dealt_to_many_tasks(spark):
    rng = random.Random(2)
    commands = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else f"t{rng.randrange(400)}", 5) for i in range(6000)],
        "command_id bigint, term string, fetch_n bigint")
    ranked = spark.createDataFrame([(t, r, 10 * k + r) for k, t in enumerate(["hot", *[f"t{i}" for i in range(400)]])
                                    for r in range(1, 6)], "term string, rank int, review_id bigint")
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        def sizes(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        salted = join_on_hot_keys(commands, ranked, "term", hot=20)
        plain = join_on_hot_keys(commands, ranked, "term", hot=10_000)
        columns = ["command_id", "term", "fetch_n", "rank", "review_id"]
        assert sorted(map(tuple, salted.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))
        a, b = sizes(salted), sizes(plain)
        assert a[-1] <= 3 * a[len(a) // 2] and b[-1] > 3 * b[len(b) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_join_is_dealt_by_its_rows(spark):
    """One key asks for 300 rows, the others for few: the joined rows, not the
    commands, decide the tasks."""
    commands = spark.createDataFrame(
        [(i if i % 50 else None, f"t{i % 40}" if i % 3 else "much") for i in range(3000)] + [(1, None), (2, "none")],
        "command_id bigint, request string")
    ranked = spark.createDataFrame([("much", r) for r in range(300)] + [(f"t{i}", r) for i in range(40) for r in range(3)]
                                   + [(None, 1), ("unasked", 1)], "request string, review_id bigint")
    dealt = join_by_rows(commands, ranked, "request", rows=10_000)
    plain = commands.join(ranked, "request")
    assert dealt.columns == plain.columns and dealt.count() == plain.count() > 300_000
    assert dealt.exceptAll(plain).count() == 0
    assert join_by_rows(commands, ranked, "request").exceptAll(plain).count() == 0
    assert join_by_rows(commands.limit(0), ranked, "request", rows=1).count() == 0
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 15 and max(sizes) <= 60_000
