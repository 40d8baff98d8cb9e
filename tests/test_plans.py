"""Plan checks: no cartesian products, partial top-N before the shuffle,
fixed dimensions broadcast, filters and pruning reach the Parquet scan."""
from voxsift.plans import catalog


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_topn_partial_group_limit(spark, sf):
    plan = _plan(catalog.topn_helpful(spark, sf))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan


def test_tags_broadcast_and_no_cartesian(spark, sf):
    df = catalog.category_rules(spark, sf)
    assert "BroadcastExchange" in _plan(df) or "BroadcastHashJoin" in _plan(df)
    for name in ["severity_tickets", "union_sources", "relevance_rules", "config_defaults"]:
        assert "CartesianProduct" not in _plan(catalog.queries()[name](spark, sf)), name


def test_pruning_and_pushdown(spark, sf):
    df = catalog.route_events(spark, sf)
    plan = _plan(df)
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan
    search = catalog.mention_search(spark, sf)
    assert "PushedFilters" in _plan(search)


def test_model_udf_runs_once(spark, sf):
    plan = _plan(catalog.model_map_udf(spark, sf))
    assert plan.count("ArrowEvalPython") == 1


def test_small_dim_checks_size(spark):
    from pyspark.sql import functions as F

    from voxsift.operators.joins import small_dim
    big = spark.range(0, 1000).withColumn("k", F.col("id") % 7)
    dim = spark.range(0, 50).withColumnRenamed("id", "k")
    hinted = big.join(small_dim(dim, 100), "k")
    plain = big.join(small_dim(dim, 10), "k")
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()
