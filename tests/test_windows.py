"""Pre-event features (W1-W4), dense keys (W7); traps T1, T2, T9, T13, T14; golden rows."""

import random

from pyspark.sql import functions as F

from arenaspark.operators.windows import dense_keys, pre_event_features, streak_columns
from conftest import rows

PSCHEMA = ("team string, confederation string, wc_year int, final_stage_reached string, matches_played int, "
           "wins int, draws int, losses int, goals_scored int, goals_conceded int, host_nation string, "
           "elo_rating_approx int")

# Input rows of one entity (played / wins / goals for / goals against; 1934 is blank)
ARG = [
    (1930, "Runner-up", 4, 3, 18, 9, "No", 1900),
    (1934, None, None, None, None, None, "No", None),
    (1958, "Group stage", 3, 1, 5, 10, "No", 1830),
    (1966, "Quarter-finals", 4, 2, 7, 4, "No", 1860),
    (1974, "Group stage", 4, 2, 7, 6, "No", 1890),
    (1978, "Winner", 7, 5, 15, 4, "Yes", 1960),
]

# Expected output (golden extract): year, appearances, titles, elo, host, streak, debut,
# win_rate_before, gf_before, ga_before, champion, top4, top8
GOLDEN_POISON = [
    (1930, 0, 0, 1900.0, 0, 0, 1, 0.0, 0.0, 0.0, 0, 1, 1),
    (1934, 1, 0, None, 0, 1, 0, 0.75, 4.5, 2.25, 0, 0, 0),
    (1958, 2, 0, 1830.0, 0, 2, 0, 0.0, 0.0, 0.0, 0, 0, 0),
    (1966, 3, 0, 1860.0, 0, 1, 0, 0.0, 0.0, 0.0, 0, 0, 1),
    (1974, 4, 0, 1890.0, 0, 1, 0, 0.0, 0.0, 0.0, 0, 0, 0),
    (1978, 5, 0, 1960.0, 1, 1, 0, 0.0, 0.0, 0.0, 1, 1, 1),
]
OUT = ["wc_year", "wc_appearances", "wc_titles", "elo_rating", "host_nation", "consecutive_wc_appearances",
       "is_debut", "win_rate_before", "goals_scored_per_match_before", "goals_conceded_per_match_before",
       "target_champion", "target_top4", "target_top8"]


def panel(spark, entity="Argentina", data=ARG):
    return spark.createDataFrame(
        [(entity, "CONMEBOL", y, s, p, w, None, None, gf, ga, h, e) for y, s, p, w, gf, ga, h, e in data], PSCHEMA)


def test_golden_poison(spark):
    # One blank row poisons every later running total -> rates 0.0
    got = rows(pre_event_features(panel(spark), null_policy="poison"), *OUT)
    assert got == GOLDEN_POISON


def test_skip_policy(spark):
    got = {r.wc_year: r for r in pre_event_features(panel(spark), null_policy="skip").collect()}
    assert (got[1958].win_rate_before, got[1958].goals_scored_per_match_before,
            got[1958].goals_conceded_per_match_before) == (0.75, 4.5, 2.25)
    assert (got[1966].win_rate_before, got[1966].goals_scored_per_match_before,
            got[1966].goals_conceded_per_match_before) == (0.571, 3.286, 2.714)


def test_streak_gap_exception(spark):
    # The declared (1938 -> 1950) pair counts as consecutive
    data = [(y, "Group stage", 3, 1, 1, 1, "No", 1500) for y in (1938, 1950, 1954)]
    got = rows(streak_columns(panel(spark, "x", data), "team", "wc_year"), "wc_year", "consecutive_wc_appearances")
    assert got == [(1938, 0), (1950, 1), (1954, 2)]


def test_half_even_rounding(spark):
    # 1/16 -> 0.062 (half-even), not 0.063
    data = [(2000, "Group stage", 16, 1, 1, 1, "No", 1500), (2004, "Group stage", 1, 0, 0, 0, "No", 1500)]
    got = {r.wc_year: r.win_rate_before for r in pre_event_features(panel(spark, "x", data)).collect()}
    assert got[2004] == 0.062


def test_no_leakage_when_history_grows(spark):
    base = pre_event_features(panel(spark))
    more = ARG + [(1982, "Group stage", 5, 2, 8, 7, "No", 1950), (1986, "Winner", 7, 6, 14, 5, "No", 2000)]
    grown = pre_event_features(panel(spark, data=more)).where(F.col("wc_year") <= 1978)
    assert rows(base, *OUT) == rows(grown, *OUT)
    # one debut per entity, and the debut row has zero history
    assert base.where("is_debut = 1").count() == 1
    d = base.where("is_debut = 1").first()
    assert (d.wc_appearances, d.win_rate_before, d.consecutive_wc_appearances) == (0, 0.0, 0)


def test_dense_keys_are_1_to_n_in_order(spark):
    names = [f"k{i:04d}" for i in range(500)]
    random.Random(7).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    got = dense_keys(df, ["name"], "id", partitions=6).collect()
    pairs = sorted((r.name, r.id) for r in got)
    assert [p[1] for p in pairs] == list(range(1, 501))


def test_dense_keys_with_payload_at_scale(spark):
    """Keys are exactly 1..n in order over many partitions, whatever columns ride along."""
    n = 3_000_000
    df = spark.range(n).select(F.format_string("k%08d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("name"),
                               F.md5(F.col("id").cast("string")).alias("payload"))
    got = dense_keys(df, ["name"], "id", partitions=11)
    assert got.columns == ["name", "payload", "id"]
    want = F.substring("name", 2, 8).cast("long") + 1
    r = got.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id"), F.count_if(F.col("id") != want)).first()
    assert tuple(r) == (n, n, 1, n, 0)


def test_dirty_numbers_in_the_panel(spark):
    # "nan" and suffixed text are missing values; a year that is no number drops its row
    rows_ = [("x", "2000", "Winner", "4", "2"), ("x", "nan", "Winner", "4", "4"), ("x", "2004.0", "", "4d", "1"),
             ("x", "2008", "", "4", "1")]
    df = spark.createDataFrame(rows_, "team string, wc_year string, final_stage_reached string, matches_played string, "
                                      "wins string").withColumns({"goals_scored": F.lit("1"), "goals_conceded": F.lit("1")})
    got = {r.wc_year: r for r in pre_event_features(df).collect()}  # no host, group or strength column
    assert sorted(got) == [2000, 2004, 2008]
    assert got[2004].win_rate_before == 0.5 and got[2008].win_rate_before == 0.0
    assert got[2000].host_nation == 0 and got[2000].confederation is None and got[2000].elo_rating is None


def test_no_nan_in_features(spark):
    # Spark orders NaN above every number, so a NaN would turn "played > 0" true;
    # running totals keep missing values as null, never NaN
    from arenaspark.plans import bindings as B
    f = pre_event_features(B.cust_panel(spark, "/root/testdata/sf0.001"),
                           gap=B.CUST_GAP, exceptions=B.CUST_GAP_EXCEPTIONS)
    cols = ["win_rate_before", "goals_scored_per_match_before", "goals_conceded_per_match_before", "elo_rating"]
    assert f.where(" OR ".join(f"isnan({c})" for c in cols)).count() == 0
    assert f.where("win_rate_before IS NULL").count() == 0   # played and wins are null together
