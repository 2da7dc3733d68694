"""Plan-shape checks: the physical plans we want, not only the right rows."""

import re

import pytest

from arenaspark.operators import clean, stats as S
from arenaspark.plans import bindings as B
from arenaspark.plans import queries as Q
from conftest import SF_SMALL, rows

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]
MODEL = Q.NO_ORACLE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(Q.REGISTRY) - MODEL))
def test_no_cross_join_no_python(spark, name):
    p = plan(Q.REGISTRY[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in p, f"{name} plans {bad}"


def test_two_sided_stats_is_one_shuffle(spark):
    p = plan(Q.REGISTRY["team_stats"](spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert "partial_sum" in p                     # map-side partial aggregation


def test_feature_windows_share_one_shuffle(spark):
    p = plan(Q.REGISTRY["pre_event_features"](spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning\(team", p)) == 1
    assert p.count("Exchange") == 1


def test_contest_view_prunes_and_broadcasts_dimensions(spark):
    p = plan(B.contests(spark, SF_SMALL))
    assert "l_shipdate" not in p and "l_comment" not in p and "o_totalprice" not in p
    assert "PushedFilters" in p
    # nation is broadcast behind its row check
    assert re.search(r"BroadcastExchange.*\n.*\n?.*nation", p, re.S) or "BroadcastHashJoin" in p


def test_top_k_is_take_ordered(spark):
    p = plan(Q.REGISTRY["participation_top15"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_keep_first_is_a_sort_aggregate_reduced_before_the_shuffle(spark):
    p = plan(Q.REGISTRY["unified_matches"](spark, SF_SMALL))
    assert "Window" not in p
    assert p.count("SortAggregate") == 2 and "partial_min" in p


def finished_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_fact_matches_shuffles_no_fact(spark):
    p = finished_plan(Q.REGISTRY["fact_matches"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") == 3
    assert "Exchange hashpartitioning" not in p and "SortMergeJoin" not in p


def test_star_join_reads_the_written_warehouse(spark):
    files = Q.REGISTRY["star_join_finals"](spark, SF_SMALL).inputFiles()
    assert files and all("/warehouse/load-" in f and ("/fact_matches/" in f or "/dim_team/" in f) for f in files)


def test_one_edition_opens_one_partition(spark):
    p = finished_plan(Q.REGISTRY["edition_join"](spark, SF_SMALL))
    filters = p.split("PartitionFilters: [")[1].split("]")[0]
    assert "edition_year#" in filters and f" = {Q.JOIN_EDITION})" in filters


def test_editions_of_a_winner_prune_partitions_at_run_time(spark):
    p = finished_plan(Q.REGISTRY["title_editions_join"](spark, SF_SMALL))
    assert "dynamicpruning" in p.lower()


def test_correlation_matrix_has_one_aggregate_per_pair(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    p = S.correlation_matrix(df, ["a", "b", "c"])._jdf.queryExecution().analyzed().toString()
    assert p.count("covar_pop(") == 3


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 4.0)], "a double, b double")
    assert S.correlation(df, "a", "b").first()["corr"] is None


def test_harmonise_with_table_never_fans_out(spark):
    df = spark.createDataFrame([("West Germany",), ("Italy",), (None,)], "team string")
    aliases = spark.createDataFrame([("West Germany", "Germany"), ("West Germany", "Germany")],
                                    "old_name string, new_name string")
    out = clean.harmonise_with_table(df, "team", aliases)
    assert out.count() == 3
    assert rows(out, "team") == [("Germany",), ("Italy",), (None,)]


def test_mode_in_top_and_bounds(spark):
    df = spark.createDataFrame([("a", "X", 9.0), ("b", "Y", 8.0), ("c", "Y", 7.0), ("d", "X", 1.0)],
                               "team string, grp string, p double")
    m = S.mode_in_top(df, "p", "grp", k=3, tie=["team"]).first()
    assert (m.grp, m["count"]) == ("Y", 2)
    b = S.bounds(df, "p").first()
    assert (b.min_value, b.max_value) == (1.0, 9.0)
    assert [r.grp for r in S.sorted_distinct(df, "grp").collect()] == ["X", "Y"]


def test_lazy_and_materialised_views_agree(spark):
    """The workspace only changes where views live, never the results."""
    name = "team_stats"
    mat = rows(Q.REGISTRY[name](spark, SF_SMALL))
    spark.conf.set("arenaspark.materialize", "false")
    try:
        lazy = rows(Q.REGISTRY[name](spark, SF_SMALL))
    finally:
        spark.conf.set("arenaspark.materialize", "true")
    assert mat == lazy


def test_scale_settings_bounds():
    from arenaspark.session import scale_settings
    big = int(scale_settings(20 * 1024 ** 4, 8000)["spark.sql.shuffle.partitions"])
    small = int(scale_settings(1024 ** 3, 64)["spark.sql.shuffle.partitions"])
    assert 3 * 8000 <= big <= 20 * 8000 and small == 3 * 64


def test_summary_prunes_unused_aggregates(spark):
    # A1 and A2 share one aggregate definition; the win-rate query keeps only its two counts
    p = plan(Q.REGISTRY["win_rate"](spark, SF_SMALL))
    assert "partial_sum" not in p and "partial_count" in p
    # the dimension needs games and win rate: both from counts of the same single aggregate
    p = plan(Q.REGISTRY["dim_team"](spark, SF_SMALL))
    assert "partial_sum" not in p


def test_row_bound_check_edges(spark):
    from arenaspark.session import broadcast_if_small, has_at_most
    df = spark.range(100).repartition(7)
    assert has_at_most(df, 100) and not has_at_most(df, 99)
    assert has_at_most(df.where("id < 0"), 0)
    # over the bound: no hint and no estimate-based broadcast; the planner shuffles
    # (AQE may still broadcast later on a measured size)
    assert "SortMergeJoin" in plan(spark.range(500).join(broadcast_if_small(df, 10), "id"))
    assert "BroadcastHashJoin" in plan(spark.range(500).join(broadcast_if_small(df, 1000), "id"))
