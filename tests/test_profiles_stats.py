"""Profiles, statistics and ranking (A19-A21, A24, A25, A31, L1-L3, J4, J5, P16, P23); traps T6, T17."""

import numpy as np
from pyspark.sql import functions as F

from arenaspark.operators import profiles as R, stats as S
from conftest import rows

PROF = ("team string, confederation string, total_wc_appearances int, total_matches int, total_wins int, "
        "total_goals_scored int, total_goals_conceded int, win_rate double, titles int, finals_reached int, "
        "semis_reached int, quarters_reached int")


def prof(spark):
    return spark.createDataFrame([
        ("a", "X", 5, 20, 10, 30, 20, 0.5, 2, 3, 4, 5),
        ("b", "X", 5, 10, 2, 10, 15, 0.2, 2, 2, 2, 3),
        ("c", "Y", 2, 4, 3, 8, 2, 0.75, 0, 0, 1, 1),
        ("d", "Y", 7, 30, 12, 40, 35, 0.4, 1, 1, 2, 2),
    ], PROF)


def test_top_k_ties(spark):
    # Values 5,5,5,1 with keys a-d, k=2 -> a, b
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5), ("d", 1)], "team string, v int")
    assert [r.team for r in S.top_k(df, "v", 2, tie=["team"]).collect()] == ["a", "b"]
    assert [r.team for r in S.top_k(df, "v", 1, ascending=True, tie=["team"]).collect()] == ["d"]


def test_leaders_and_metric_direction(spark):
    lead = R.profile_leaders(prof(spark)).first()
    assert lead.most_titles == "a" and lead.best_win_rate_team == "c" and lead.most_appearances_team == "d"
    f = R.factor_leaders(prof(spark)).first()
    assert f.best_defence == "c"          # lowest conceded per match
    top = S.metric_top(R.with_rates(prof(spark)), "conceded_per_match", 2).collect()
    assert [r.team for r in top] == ["c", "a"]


def test_ranking_join_keeps_unranked(spark):
    # A profile without a ranking row is kept with a null rank and left out of correlations
    rk = spark.createDataFrame([("a", 3), ("b", 1), ("d", 2)], "team string, rank int")
    j = R.join_ranking(R.with_rates(prof(spark)), rk)
    assert {r.team: r.ranking for r in j.collect()}["c"] is None
    m = S.correlation_matrix(j, ["win_rate", "ranking"], min_rows=2)
    got = {(r.col_a, r.col_b): r.corr for r in m.collect()}
    pdf = j.toPandas().dropna(subset=["ranking"])
    assert abs(got[("win_rate", "ranking")] - pdf["win_rate"].corr(pdf["ranking"].astype(float))) < 1e-6
    assert got[("ranking", "ranking")] == 1.0
    assert S.correlation_matrix(j, ["win_rate", "ranking"], min_rows=3).count() == 0


def test_linear_trend_matches_numpy(spark):
    p = prof(spark)
    t = S.linear_trend(p, "total_wc_appearances", "win_rate", min_points=2).first()
    x = np.array([5, 5, 2, 7], float)
    y = np.array([0.5, 0.2, 0.75, 0.4])
    slope, icpt = np.polyfit(x, y, 1)
    assert abs(t.slope - slope) < 1e-9 and abs(t.intercept - icpt) < 1e-9
    line = S.trend_line(p, "total_wc_appearances", "win_rate", n=100, min_points=2).collect()
    assert len(line) == 100 and min(r.x for r in line) == 2.0 and max(r.x for r in line) == 7.0
    assert S.linear_trend(p, "total_wc_appearances", "win_rate", min_points=5).count() == 0


def test_group_share_and_finals(spark):
    share = {r.group_name: r.share for r in R.group_titles_share(prof(spark)).collect()}
    assert share == {"X": 0.8, "Y": 0.2}
    fin = {r.group_name: (r.finals, r.semis, r.quarters) for r in R.group_finals(prof(spark)).collect()}
    assert fin["X"] == (5, 6, 8)


def test_bubble_floor_and_label(spark):
    b = {r.team: r.bubble_size for r in R.bubble(prof(spark)).collect()}
    assert b["c"] == 0.5 and b["a"] == 2.0
    labels = spark.createDataFrame([("a", "[EU]"), ("a", "[EU]")], "name string, tag string")
    lab = {r.team: r.label_team for r in R.with_label(prof(spark), "team", labels).collect()}
    assert lab["a"] == "[EU] a" and lab["b"] == "b"      # unknown entity keeps its bare name
    assert R.with_label(prof(spark), "team", labels).count() == 4   # no fan-out


def test_add_win_rate_if_absent(spark):
    p = prof(spark).drop("win_rate")
    wr = spark.createDataFrame([("a", 0.9)], "team string, win_rate double")
    got = {r.team: r.win_rate for r in R.add_win_rate_if_absent(p, wr).collect()}
    assert got["a"] == 0.9 and got["b"] is None
    assert R.add_win_rate_if_absent(prof(spark), wr).columns == prof(spark).columns
