"""Panel operators (P13-P15, P20-P22, A11-A18, W5) and traps T8, T18, T19."""

from pyspark.sql import functions as F

from arenaspark.functions.exprs import stage_score, truthy
from arenaspark.operators import clean, panels as P
from conftest import rows

PSCHEMA = ("team string, confederation string, wc_year int, final_stage_reached string, matches_played int, "
           "wins int, draws int, losses int, goals_scored int, goals_conceded int, host_nation string, "
           "elo_rating_approx int")


def mk(spark, data):
    return spark.createDataFrame(data, PSCHEMA)


def test_truthy_words(spark):
    # Four truthy words vs the strict 'yes'
    df = spark.createDataFrame([("Yes",), (" TRUE ",), ("oui",), ("1",), (None,)], "h string")
    assert [r[0] for r in df.select(truthy("h")).collect()] == [True, True, True, True, False]
    assert [r[0] for r in df.select(truthy("h", ["yes"])).collect()] == [True, False, False, False, False]


def test_stage_score_scale(spark):
    df = spark.createDataFrame([("Winner",), (" group stage ",), ("final",), (None,)], "s string")
    assert [r[0] for r in df.select(stage_score("s")).collect()] == [7, 0, 0, 0]


def test_targets_nested(spark):
    df = mk(spark, [("a", "X", 1930, s, 1, 1, 0, 0, 1, 0, "No", 1500) for s in
                    ["Winner", "Semi-finals", "Quarter-finals", "Group stage", None]])
    t = rows(P.with_targets(df), "final_stage_reached", "target_champion", "target_top4", "target_top8")
    assert (None, 0, 0, 0) in t and ("Winner", 1, 1, 1) in t
    assert ("Semi-finals", 0, 1, 1) in t and ("Quarter-finals", 0, 0, 1) in t


def test_heatmap_merged_names(spark):
    # West and East Germany become Germany in the same year -> one cell, the higher stage
    df = mk(spark, [("West Germany", "UEFA", 1974, "Winner", 7, 6, 0, 1, 13, 4, "Yes", 2000),
                    ("East Germany", "UEFA", 1974, "Quarter-finals", 6, 2, 2, 2, 5, 5, "No", 1800),
                    ("Italy", "UEFA", 1978, "Fourth place", 7, 4, 1, 2, 9, 6, "No", 1900)])
    h = clean.harmonise_columns(df, ["team"])
    m = {r.team: r.asDict() for r in P.stage_heatmap(h, [1974, 1978]).collect()}
    assert m["Germany"]["y1974"] == 7 and m["Germany"]["y1978"] == -1
    lab = {r.team: r.asDict() for r in P.stage_labels(h, [1974, 1978]).collect()}
    assert lab["Germany"]["y1974"] == "Winner" and lab["Germany"]["y1978"] == "not qualified"


def test_host_and_upsets(spark):
    df = mk(spark, [("a", "X", 2000, "Winner", 4, 4, 0, 0, 8, 1, "Yes", 1700),
                    ("b", "X", 2000, "Quarter-finals", 4, 2, 0, 2, 5, 5, "No", 1960),
                    ("c", "Y", 2000, "Group stage", 0, 0, 0, 0, 0, 0, "no", 2000)])
    hv = P.host_vs_visitor(df).first()
    assert hv.host_count == 1 and hv.visitor_count == 2
    assert hv.host_win_rate == 1.0 and hv.visitor_win_rate == 0.25 and hv.delta == 0.75
    k = P.upset_kpis(df).first()
    assert k.upsets == 1 and k.favourites_far == 0 and k.rated_rows == 3
    # A stage off the scale ("final") falls back to the default threshold 2
    assert P.upset_rows(df, max_strength=2100, chosen_stage="final").count() == 2
    assert P.upset_rows(df, max_strength=2100, chosen_stage="winner").count() == 1


def test_decade_top_unique_ranks(spark):
    data = [(t, "X", 1990 + i, "Group stage", 3, w, 0, 3 - w, 1, 1, "No", 1500)
            for i, (t, w) in enumerate([("a", 2), ("b", 2), ("c", 1), ("d", 3)])]
    top = P.decade_top(mk(spark, data), k=2).orderBy("rank").collect()
    assert [(r.team, r.rank) for r in top] == [("d", 1), ("a", 2)]


def test_filter_members_semi_join(spark):
    df = mk(spark, [("a", "X", y, "Winner", 1, 1, 0, 0, 1, 0, "No", 1500) for y in (1990, 1994, 1998)]
            + [("b", "X", 1994, "Winner", 1, 1, 0, 0, 1, 0, "No", 1500)])
    sel = spark.createDataFrame([("a",), ("a",)], "team string")
    out = P.filter_members(df, "team", sel, lo=1994, hi=1998, range_col="wc_year")
    assert rows(out, "team", "wc_year") == [("a", 1994), ("a", 1998)]


def test_normalise_keeps_null(spark):
    # T5: a missing stage stays missing (no 'nan' text), scores 0 on the scale
    from arenaspark.functions.exprs import normalise_text
    df = spark.createDataFrame([(" Final ",), (None,)], "s string")
    assert [r[0] for r in df.select(normalise_text("s")).collect()] == ["final", None]
    assert [r[0] for r in df.select(stage_score("s")).collect()] == [0, 0]
