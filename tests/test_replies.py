"""strict reading of model replies."""
from pyspark.sql import functions as F

from voxsift.functions.replies import (field_type, is_duplicate, keep_relevant, match_index,
                                       parse_reply, text_or_empty)


def test_relevance_replies(spark):
    rows = ['{"relevance":"true"}', '{"relevance":true}', '{"relevance":"false","reason":"x"}',
            '{"relevance":null}', "{}", "not json", None, '```json\n{"relevance":"true"}\n```']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, reply string")
    v = parse_reply(F.col("reply"))
    got = [r.k for r in df.orderBy("i").select(keep_relevant(v).alias("k")).collect()]
    assert got == [True, False, False, False, True, True, True, True]


def test_duplicate_replies(spark):
    rows = ['{"is_duplicate":"true","match_with":0}', '{"is_duplicate":"true","match_with":"1"}',
            '{"is_duplicate":"true","match_with":-1}', '{"is_duplicate":"true"}',
            '{"is_duplicate":true,"match_with":0}', "not json"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, reply string")
    v = parse_reply(F.col("reply"))
    got = [(r.d, r.m) for r in df.orderBy("i").select(
        is_duplicate(v).alias("d"), match_index(v).alias("m")).collect()]
    assert got == [(True, 0), (True, 1), (True, -1), (True, None), (False, 0), (False, None)]


def test_types_and_defaults(spark):
    df = spark.createDataFrame([('{"title":"t","a":1,"b":[1],"c":{}}',), ("{}",)], "reply string")
    v = parse_reply(F.col("reply"))
    r = df.select(field_type(v, "a").alias("a"), field_type(v, "b").alias("b"),
                  field_type(v, "c").alias("c"), text_or_empty(v, "title").alias("t"),
                  text_or_empty(v, "summary").alias("s")).collect()
    assert (r[0].a, r[0].b, r[0].c, r[0].t, r[0].s) == ("number", "array", "object", "t", "")
    assert (r[1].a, r[1].t) == (None, "")
