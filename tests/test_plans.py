"""Plan-shape checks: what reaches the scan, what never appears."""

import contextlib
import io
import re

import pytest

from civica.plans import catalogue
from conftest import SF_SMALL

QUERIES = catalogue.queries()
MODEL = {"forest_predict"}


def physical(df, mode="extended") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    txt = buf.getvalue()
    return txt[txt.index("== Physical Plan =="):]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL))
def test_no_pair_explosion_and_no_row_python(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_year_range_pushed_to_scan(spark):
    plan = physical(QUERIES["scan_year_range"](spark, SF_SMALL), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "o_orderpriority" not in schema and "o_orderstatus" not in schema


def test_equality_filter_pushed(spark):
    plan = physical(QUERIES["filtered_ordered_scan"](spark, SF_SMALL), "formatted")
    assert "EqualTo(c_nationkey,13)" in plan


def test_wide_to_long_is_one_generator(spark):
    plan = physical(QUERIES["long_by_suffix"](spark, SF_SMALL))
    assert plan.count("Generate") == 1 and "Union" not in plan


def test_party_totals_aggregate_before_generate(spark):
    plan = physical(QUERIES["keyword_party_votes"](spark, SF_SMALL))
    # the long form is generated from the per-year aggregate, not per row
    assert plan.index("Generate") < plan.index("HashAggregate")
    assert len(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", plan)) == 1


def test_latest_row_is_an_aggregate_not_a_window(spark):
    plan = physical(QUERIES["join_distinct_latest"](spark, SF_SMALL))
    assert "Window" not in plan


def test_split_lag_shuffles_fact_rows_once(spark):
    from civica.plans import carriers as C
    from civica.operators.windows import lag_within
    v = C.votes(spark, SF_SMALL)
    plan = physical(lag_within(v, ["code_region", "nom"], ["annee", "o_orderkey"], "voix", "p", split="annee"))
    # The lagged rows are written once.  That table is read for the tails, for the first rows of the splits, which are
    # joined to the tails, and for all other rows, which aren't shuffled again.
    assert plan.count("FileScan parquet") == 3 and "orders.parquet" not in plan
    rest = plan[plan.rindex("FileScan parquet"):]
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") == 1 and "Exchange" not in rest


@pytest.mark.parametrize("name, table, most", [
    ("class_metrics", "orders", 1), ("right_votes", "lineitem", 1), ("keyword_party_votes", "lineitem", 1),
    ("left_join_fanout", "orders", 1), ("left_join_composite", "orders", 1), ("unstack_zero_fill", "orders", 0),
    ("bucket_other", "lineitem", 0), ("scenario_rows", "lineitem", 0)])
def test_facts_are_read_once(spark, name, table, most):
    # 0: read while the query is built, into a small table.
    plan = physical(QUERIES[name](spark, SF_SMALL))
    assert len(re.findall(rf"FileScan parquet.*?{table}\.parquet", plan)) <= most


@pytest.mark.parametrize("name", ["left_join_fanout", "left_join_suffix", "left_join_composite", "group_mean_fill"])
def test_facts_do_not_move_for_a_small_side(spark, name):
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = physical(QUERIES[name](own, SF_SMALL))
    key = "o_orderpriority" if name == "group_mean_fill" else "annee"
    assert "BroadcastHashJoin" in plan
    assert not re.search(rf"hashpartitioning\({key}#", plan)


def test_global_mean_is_a_scalar_subquery(spark):
    plan = physical(QUERIES["global_mean_fill"](spark, SF_SMALL))
    assert "Subquery" in plan and "Join" not in plan


def test_integer_prefix_pushed_as_ranges(spark):
    plan = physical(QUERIES["prefix_filter"](spark, SF_SMALL), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThanOrEqual(p_size,1)" in pushed and "Or(" in pushed


def test_lag_moves_the_facts_once(spark):
    # Building the query writes the lagged rows; in what is left only first rows meet the tails.
    plan = physical(QUERIES["lag_votes"](spark, SF_SMALL))
    joined = [x for x in plan.splitlines() if "Join" in x]
    assert len(joined) == 1 and "Union" in plan
    assert len(re.findall(r"Filter \(.*__rn#\d+ = 1\)", plan)) >= 1


def test_last_period_without_sorting_the_facts(spark):
    from civica.operators.windows import latest_row
    from civica.plans import carriers as C
    from civica.session import cut_lineage
    v = cut_lineage(C.votes(spark, SF_SMALL))
    plan = physical(latest_row(v, ["code_region", "nom"], "annee", ["o_orderkey"]))
    # One ordering aggregate, and what it reads are the survivors of a semi join.
    below = plan[plan.rindex("SortAggregate"):]
    assert "LeftSemi" in below


def test_bucketed_tables_are_read_in_place(spark):
    """Lag and join on the bucket key move nothing."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(QUERIES["bucketed_lag"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Window" in plan and "Exchange" not in plan
