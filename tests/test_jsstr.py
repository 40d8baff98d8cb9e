"""JavaScript string semantics of the command parser and length filter."""
from pyspark.sql import functions as F

from voxsift.functions.jsstr import js_or, js_parse_int, js_split3, js_trim, longer_than, utf16_length


def test_trim_split_parseint(spark):
    rows = [("",), ("  \n",), (" 12abc",), ("3.7",), ("+7",), ("-5",), ("0x1F",), ("abc",),
            ("101",), ("search  x 10",), ("search a 10 extra",), (" help\ufeff",), ("0x",),
            ("-0x1f",), (None,)]
    df = spark.createDataFrame(rows, "p string")
    out = df.select("p", js_trim("p").alias("t"), js_split3(js_trim("p")).alias("s"),
                    js_parse_int(js_trim("p")).alias("n")).collect()
    got = {r.p: (r.t, r.s, r.n) for r in out}
    assert got[""][0] == "" and got["  \n"][0] == ""
    assert got[" 12abc"][2] == 12
    assert got["3.7"][2] == 3 and got["+7"][2] == 7 and got["-5"][2] == -5
    assert got["0x1F"][2] == 31 and got["-0x1f"][2] == -31
    assert got["abc"][2] is None and got["0x"][2] is None
    assert got["101"][2] == 101
    assert got["search  x 10"][1] == ["search", "", "x"]
    assert got["search a 10 extra"][1] == ["search", "a", "10"]
    assert got[" help\ufeff"][0] == "help"
    assert got[None][2] is None


def test_utf16_length_and_noise(spark):
    rows = [("abc",), ("abcd",), ("\U0001F44D\U0001F44D",), ("ab\U0001F44D",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    out = {r.t: (r.n, r.keep) for r in df.select(
        "t", utf16_length("t").alias("n"), longer_than(F.col("t"), 3).alias("keep")).collect()}
    assert out["abc"] == (3, False)
    assert out["abcd"] == (4, True)
    assert out["\U0001F44D\U0001F44D"] == (4, True)
    assert out["ab\U0001F44D"] == (4, True)
    assert out[None] == (None, False)


def test_js_or(spark):
    df = spark.createDataFrame([("", "d"), (None, "d"), ("t", "d")], "a string, b string")
    assert [r.x for r in df.select(js_or("a", "b").alias("x")).collect()] == ["d", "d", "t"]
