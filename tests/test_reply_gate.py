"""Replies split into accepted ones and rejects."""
from pyspark.sql import functions as F

from voxsift.operators import reply_gate
from voxsift.operators.reply_gate import DUPLICATE, RELEVANCE

STEPS = {"relevance": ("rel", RELEVANCE), "duplicate": ("dup", DUPLICATE)}
RELEVANCE_REPLIES = [
    (None, "no reply"), ("  ", "no reply"), ("not json", "not JSON"), ('{"relevance":', "not JSON"),
    ("[1]", "not an object"), ('"true"', "not an object"), ("null", "not an object"), ("{}", "relevance missing"),
    ('{"relevance":true}', "relevance is boolean"), ('{"relevance":null}', "relevance is null"),
    ('{"relevance":{"a":1}}', "relevance is object"), ('{"relevance":"no","more":1}', None),
    ('```json\n{"relevance":"true"}\n```', None), ('{"relevance":"' + "x" * 200_000 + '"}', None)]
DUPLICATE_REPLIES = [
    ('{"is_duplicate":"true","match_with":0}', None), ('{"is_duplicate":"true","match_with":"12"}', None),
    ('{"is_duplicate":"true","match_with":"x"}', "match_with is no index"),
    ('{"is_duplicate":"true","match_with":-1}', "match_with is no index"),
    ('{"is_duplicate":"false","match_with":-1}', None), ('{"is_duplicate":"false"}', "match_with missing"),
    ('{"is_duplicate":"true","match_with":[0]}', "match_with is array"),
    ('{"match_with":0}', "is_duplicate missing")]


def frame(spark):
    good_r, good_d = '{"relevance":"true"}', '{"is_duplicate":"false","match_with":-1}'
    rows = [(i, r, good_d) for i, (r, _) in enumerate(RELEVANCE_REPLIES)]
    rows += [(100 + i, good_r, r) for i, (r, _) in enumerate(DUPLICATE_REPLIES)]
    return spark.createDataFrame(rows + rows[:1], "id long, rel string, dup string")  # one row repeated


def test_first_fault_of_every_reply(spark):
    got = reply_gate.gate(frame(spark).distinct(), ["id"], STEPS).collect()
    faults = {(r.id, r.step): r.error for r in got}
    assert len(got) == 2 * (len(RELEVANCE_REPLIES) + len(DUPLICATE_REPLIES))
    for i, (_, error) in enumerate(RELEVANCE_REPLIES):
        assert faults[i, "relevance"] == error and faults[i, "duplicate"] is None, RELEVANCE_REPLIES[i][0]
    for i, (_, error) in enumerate(DUPLICATE_REPLIES):
        assert faults[100 + i, "duplicate"] == error and faults[100 + i, "relevance"] is None, DUPLICATE_REPLIES[i]


def test_split_writes_every_reply_once(spark, tmp_path):
    gated = reply_gate.gate(frame(spark), ["id"], STEPS)
    path = str(tmp_path / "split")
    seen = reply_gate.write_split(gated, path)
    stored = spark.read.parquet(path)
    bad = reply_gate.rejects(stored.where("NOT accepted"), ["id"])
    assert seen.get == {"rows": gated.count(), "rejected": bad.count()}
    assert stored.count() == gated.count()
    assert bad.where(F.col("key") == "0").count() == 2  # repeated rows are rejected each
    assert {r.detail for r in bad.where("key = '0'").collect()} == {"{}"}
    assert reply_gate.rejects(reply_gate.gate(frame(spark).limit(0), ["id"], STEPS), ["id"]).count() == 0


def test_input_is_read_once_without_a_shuffle(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "in"))
    plan = reply_gate.gate(spark.read.parquet(str(tmp_path / "in")), ["id"], STEPS)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
