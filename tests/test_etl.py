"""The batch flow over files in the reference's layout (two match sources with
different score columns, editions with Host/Champion headers, a panel file)."""

import os
import tempfile

from arenaspark.plans import etl
from arenaspark.sources.tableset import TableSet
from conftest import rows


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def layout():
    root = tempfile.mkdtemp(prefix="arenaspark-etl-", dir="/tmp")
    write(f"{root}/raw/matches/matches_1930_2022.csv",
          "date,home_team,away_team,home_score,away_score,stage,stadium,city\n"
          "1974-07-07,West Germany,Netherlands,2,1,Final, Olympiastadion ,Munich\n"
          "1974-07-07,West Germany,Netherlands,2,1,Final, Olympiastadion ,Munich\n"
          "1978-06-25,Argentina,Netherlands,3,1,Final,Monumental,Buenos Aires\n")
    write(f"{root}/raw/matches/world_cup.csv",
          "Year,Host,Teams,Champion,Runner-Up\n1974,West Germany,16,West Germany,Netherlands\n"
          "1978,Argentina,16,Argentina,Netherlands\n")
    write(f"{root}/raw/compets/wc_matches_historical.csv",
          "match_id,wc_year,stage,date,home_team,away_team,home_goals,away_goals,stadium,city\n"
          "m1,1974,Final,1974-07-07,Germany,Netherlands,9,9,Olympiastadion,Munich\n"
          "m2,1986,Final,1986-06-29,Argentina,FRG,3,2,Azteca,Mexico City\n")
    write(f"{root}/raw/compets/wc_prediction_features_2026.csv",
          "team,confederation,elo_rating_2026,wc_titles,wc_appearances,host_nation,is_debut,consecutive_wc_appearances\n"
          "Argentina,CONMEBOL,2100,3,18,No,No,14\nCanada,CONCACAF,1750,0,2,Yes,No,1\nCuracao,CONCACAF,1500,0,0,No,Yes,0\n")
    write(f"{root}/raw/compets/wc_head_to_head.csv",
          "team_a,team_b,total_wc_matches\nArgentina,Netherlands,2\n")
    write(f"{root}/raw/compets/wc_team_appearances.csv",
          "team,confederation,wc_year,final_stage_reached,matches_played,wins,draws,losses,goals_scored,"
          "goals_conceded,host_nation,elo_rating_approx\n"
          "Argentina,CONMEBOL,1930,Runner-up,4,3,0,1,18,9,No,1900\n"
          "Argentina,CONMEBOL,1934,,,,,,,,No,\n"
          "Argentina,CONMEBOL,1958,Group stage,3,1,0,2,5,10,No,1830\n")
    return root


def test_build_tables(spark):
    root = layout()
    t = etl.build_tables(etl.read_sources(spark, f"{root}/raw"))
    m = t.matches
    # harmonised names, normalised text, de-duplicated: the second source's copy of the 1974 final loses
    assert rows(m, "home_team", "away_team", "home_score", "stage") == [
        ("Argentina", "Germany", 3, "final"), ("Argentina", "Netherlands", 3, "final"),
        ("Germany", "Netherlands", 2, "final")]
    assert rows(m.where("home_team = 'Germany'"), "stadium") == [("olympiastadion",)]
    st = {r.team: r for r in t.team_stats.collect()}
    assert st["Netherlands"].games_played == 2 and st["Germany"].goals_conceded == 4
    assert rows(t.titles, "team", "titles") == [("Argentina", 1), ("Germany", 1)]
    assert rows(t.phase_performance, "team", "stage", "appearances") == [
        ("Argentina", "final", 2), ("Germany", "final", 2), ("Netherlands", "final", 2)]
    # typed columns
    assert dict(t.worldcup.dtypes)["year"] == "int" and dict(t.team_appearances.dtypes)["wins"] == "int"
    assert dict(t.head_to_head.dtypes)["total_wc_matches"] == "int"
    assert t.home_advantage.first().home_win_rate == 1.0


def test_run_writes_warehouse_and_features(spark):
    root = layout()
    counts = etl.run(spark, f"{root}/raw", f"{root}/out")
    assert counts["dim_team"] == 3 and counts["fact_matches"] == 3 and counts["fact_head_to_head"] == 1
    assert counts["ml_dataset_historical"] == 3
    feats = spark.read.option("header", True).csv(f"{root}/out/processed/ml_dataset_historical")
    got = {r.wc_year: r for r in feats.collect()}
    assert got["1934"].win_rate_before == "0.75" and got["1958"].win_rate_before == "0.0"
    assert got["1958"].consecutive_wc_appearances == "2"
    assert counts["predictions"] == 3
    pred = spark.read.option("header", True).csv(f"{root}/out/processed/predictions")
    assert {r.team for r in pred.collect()} == {"Argentina", "Canada", "Curacao"}
    assert all(0.0 <= float(r.prob_top4) <= 100.0 for r in pred.collect())


def test_first_row_of_the_file_wins(spark):
    """Many rows per key in both sources, cut into many splits: the first source's first row stays."""
    root = tempfile.mkdtemp(prefix="arenaspark-etl-", dir="/tmp")
    line = "1990-06-{:02d},t{},u{},{},{},group\n"
    head = "date,home_team,away_team,home_score,away_score,stage\n"
    write(f"{root}/matches/matches_1930_2022.csv",
          head + "".join(line.format(i % 5 + 1, i % 30, i % 3, i // 30, 0) for i in range(3000)))
    write(f"{root}/compets/wc_matches_historical.csv",
          head.replace("score", "goals") + "".join(line.format(i % 7 + 1, i % 30, i % 3, i + 5000, 0) for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        m = etl.build_tables(etl.read_sources(spark, root)).matches
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want: dict = {}
    for source, days, off, per in ((1, 5, 0, 30), (2, 7, 5000, 1)):
        for i in range(3000):
            want.setdefault((f"1990-06-{i % days + 1:02d}", f"t{i % 30}", f"u{i % 3}"), i // per + off)
    assert {(str(r.date), r.home_team, r.away_team): r.home_score for r in m.collect()} == want


def test_optional_columns_may_be_absent(spark):
    root = tempfile.mkdtemp(prefix="arenaspark-etl-", dir="/tmp")
    write(f"{root}/matches/matches_1930_2022.csv", "date,home_team,away_team,home_score,away_score,stadium\n1990-06-01,a,b,1.0,0,x\n")
    write(f"{root}/compets/wc_team_appearances.csv", "team,wc_year,final_stage_reached,matches_played,wins,goals_scored,"
                                                     "goals_conceded\na,1990,Winner,7,6,15,5\n")
    counts = etl.run(spark, root, f"{root}/out", with_model=False)
    assert counts["fact_matches"] == 1 and counts["dim_stadium"] == 1 and counts["dim_edition"] == 0
    f = TableSet(spark, f"{root}/out/warehouse").read("fact_matches").first()
    assert (f.home_score, f.stage, f.stadium_id) == (1, None, 1)
