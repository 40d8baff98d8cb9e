"""Command parsing, validation and routing (F5, F3)."""
from voxsift.operators.commands import SOCIAL, STORE, parse_commands, route
from voxsift.sources import tables


def _parse(spark, rows, **kw):
    df = spark.createDataFrame(rows, "command_id long, command string, parameters string")
    return {r.command_id: r for r in parse_commands(df, **kw).collect()}


def test_store_commands(spark):
    got = _parse(spark, [(1, STORE, ""), (2, STORE, " 12abc"), (3, STORE, "abc"),
                         (4, STORE, "101"), (5, STORE, " help\ufeff"), (6, STORE, "0"),
                         (7, STORE, "-5"), (8, STORE, "0x1F")])
    assert (got[1].status, got[1].fetch_n) == ("ok", 10)
    assert (got[2].status, got[2].fetch_n) == ("ok", 12)
    assert got[3].status == "reject_not_integer" and got[3].fetch_n is None
    assert (got[4].status, got[4].fetch_n) == ("warn_over_100", 101)
    assert got[5].status == "help" and got[5].requested is None
    assert (got[6].status, got[6].fetch_n) == ("warn_non_positive", 0)
    assert (got[7].status, got[7].fetch_n) == ("warn_non_positive", 0)
    assert got[8].fetch_n == 31


def test_social_commands(spark):
    got = _parse(spark, [(1, SOCIAL, ""), (2, SOCIAL, "search  x 10"),
                         (3, SOCIAL, "search a 10 extra"), (4, SOCIAL, "trend a 5"),
                         (5, SOCIAL, "hashtag foo 20"), (6, SOCIAL, "help")])
    assert (got[1].mode, got[1].term, got[1].fetch_n) == ("search", "blinkiteng", 10)
    assert got[2].status == "reject_not_integer"
    assert (got[3].mode, got[3].term, got[3].fetch_n) == ("search", "a", 10)
    assert got[4].status == "reject_unknown_mode"
    assert (got[5].mode, got[5].fetch_n) == ("hashtag", 20)
    assert got[6].status == "help"


def test_over_limit_policies(spark):
    rows = [(1, STORE, "150")]
    assert _parse(spark, rows, over_limit="clamp")[1].fetch_n == 100
    assert _parse(spark, rows, over_limit="reject")[1].status == "reject_over_100"


def test_route_rejects_unknown(spark):
    ev = spark.createDataFrame([(1, "purchase"), (2, "view"), (3, "work_created")],
                               "event_id long, event_type string")
    out = {r.event_id: (r.function, r.route_status)
           for r in route(ev, tables.routes(spark)).collect()}
    assert out[1] == ("record_purchase", "routed")
    assert out[2] == (None, "rejected")
    assert out[3] == ("on_work_creation", "routed")
