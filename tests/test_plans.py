"""Plan shape: the scale properties the README claims, read from Spark's
physical plans (the final AQE plan where the query has run)."""

from tabscore.operators import assoc
from tabscore.operators import profile as prof
from tabscore.operators import sampling as smp
from tabscore.plans import fixtures as fx
from tabscore.plans import stored
from tabscore.sources.tables import read_table

from .conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def test_profile_shares_the_distinct_and_has_no_expand(spark):
    p = _final_plan(prof.profile(fx.wide(spark, SF001), digits=6))
    assert "ReusedExchange" in p
    # The unpivot is an Expand of one value per column; the count(distinct)
    # rewrite (an Expand copying whole rows per group id) must not appear.
    assert "gid#" not in p
    assert p.count("FileScan parquet") <= 2


def test_filter_reaches_the_scan(spark):
    import __spark_entry__ as entry
    p = _plan(entry.queries()["b5_conjunctive_filter"](spark, SF001))
    assert "EqualTo(event_type,click)" in p


def test_projection_prunes_the_scan(spark):
    import __spark_entry__ as entry
    p = _plan(entry.queries()["a6_column_scan"](spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p


def test_first_per_class_moves_only_candidates(spark):
    """Whatever the static broadcast threshold, the table's rows meet the
    per-class cuts without an exchange: only candidates are shuffled."""
    o = read_table(spark, SF001, "orders")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        p = _plan(smp.first_per_class(o, "o_orderpriority", 5, ["o_orderkey"]))
    finally:
        spark.conf.set(key, before)
    cut = p.index("BroadcastHashJoin")
    assert "Exchange" not in p[cut:cut + p[cut:].index("FileScan")]


def test_folds_use_one_exchange_for_join_and_window(spark):
    """The class struct is the key of both, so rows move once: the plan has
    the cell aggregate's exchange, its prefix window's, and one for the rows."""
    o = fx.orders_t(spark, SF001).select("o_orderkey", "done")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        p = _plan(smp.stratified_folds(o, "done", 3, ["o_orderkey"]))
    finally:
        spark.conf.set(key, before)
    join = p.index("SortMergeJoin")
    above = p[:join]
    assert "Exchange" not in above[above.index("Window"):]


def test_no_query_plans_a_cartesian_product(spark):
    """No registered query with an oracle pairs rows by a cross or nested
    loop join (the planned form, with the optimizer's statistics)."""
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = []
    trained = {"k9_predict", "k15_importances", "k17_run_record", "l3_batch_score"}  # they'd train first
    for name in sqls:
        if name.startswith(("a", "m", "op")) or name in trained:  # writers, streams and the optional part: covered elsewhere
            continue
        p = _plan(qs[name](spark, SF001))
        if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p:
            bad.append(name)
    assert bad == []


def test_profile_aggregates_are_compiled_and_times_formatted_when_distinct(spark):
    """One text end in the global aggregate would make all of it run uncompiled, and a text of every time stamp would be made per row."""
    p = _final_plan(prof.profile(fx.wide(spark, SF001), digits=6))
    assert "SortAggregate(key=[]" not in p
    before = [x for x in p[p.index("Expand"):].splitlines() if "date_format" in x]
    assert not before


def test_contingency_hands_few_columns_to_its_tasks(spark):
    """Six binned columns are one long beside the four others."""
    p = _plan(assoc.contingency(fx.wide(spark, SF001), stored.ASSOC_NUM, stored.ASSOC_CAT))
    assert "c4#" in p and "c5#" not in p
