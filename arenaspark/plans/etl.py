"""The batch flow over the reference's own file layout.

``read_sources`` reads the two source folders, ``build_tables(catalog)`` returns
the cleaned, harmonised, typed and unified tables and the team-level
statistics, and ``run(...)`` chains extract -> transform -> load -> feature
table as the batch entry point. The unified contest table is written once to
shared storage; everything after reads it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaspark.operators import clean, contests as C, model as M, warehouse as W
from arenaspark.operators.windows import pre_event_features
from arenaspark.session import shared_table
from arenaspark.sources.io import Catalog, empty_frame, exists, read_csv, write_csv
from arenaspark.sources.tableset import TableSet

# File stems the flow looks for (fixed values of the source layout)
MATCHES_MAIN = "matches_1930_2022"
MATCHES_SECOND = "wc_matches_historical"
EDITIONS = "world_cup"
RANKING = "fifa_ranking_2022-10-06"
HEAD_TO_HEAD = "wc_head_to_head"
APPEARANCES = "wc_team_appearances"
ALLTIME = "wc_team_alltime_stats"
SCORING = "wc_prediction_features_2026"
SCORING_RENAMES = {"elo_rating_2026": "elo_rating"}

NAME_COLUMNS = ["home_team", "away_team", "team", "winner", "host_country"]
TEXT_COLUMNS = ["stadium", "stage", "city"]
SCORE_ALIASES = {"home_goals": "home_score", "away_goals": "away_score"}
ORDER = "__order"  # place of a row in its source file

# Columns of the source files that are numbers (fixed values of the layout); the others stay text
INTEGERS = {
    EDITIONS: ["year", "teams", "attendance", "attendanceavg", "matches"],
    RANKING: ["rank", "previous_rank"],
    HEAD_TO_HEAD: ["total_wc_matches", "team_a_wins", "draws", "team_b_wins", "team_a_goals", "team_b_goals",
                   "goal_difference_a", "last_wc_meeting_year", "most_famous_match_year"],
    APPEARANCES: ["wc_year", "matches_played", "wins", "draws", "losses", "goals_scored", "goals_conceded",
                  "goal_difference", "points_earned", "wc_titles_before_tournament", "consecutive_appearances"],
    ALLTIME: ["total_wc_appearances", "total_matches", "total_wins", "total_draws", "total_losses", "total_goals_scored",
              "total_goals_conceded", "goal_difference", "titles", "finals_reached", "semis_reached", "quarters_reached",
              "last_wc_year", "first_wc_year", "consecutive_appearances_current", "host_times"],
    MATCHES_SECOND: ["wc_year", "home_pen_goals", "away_pen_goals"],
}
DECIMALS = {
    RANKING: ["points", "previous_points"], ALLTIME: ["win_rate", "elo_peak_approx"],
    APPEARANCES: ["elo_rating_approx", "fifa_ranking"],
    MATCHES_SECOND: ["home_pre_match_elo", "away_pre_match_elo"],
}
EDITION_SCHEMA = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("host_country", T.StringType()),
                               T.StructField("winner", T.StringType()), T.StructField("teams", T.IntegerType())])


@dataclass
class Tables:
    matches: DataFrame | None
    team_stats: DataFrame | None
    win_rate: DataFrame | None
    titles: DataFrame | None
    phase_performance: DataFrame | None
    home_advantage: DataFrame | None
    head_to_head: DataFrame | None
    team_appearances: DataFrame | None
    team_alltime_stats: DataFrame | None
    worldcup: DataFrame | None
    ranking: DataFrame | None


def read_sources(spark: SparkSession, raw_root: str) -> Catalog:
    """Every file of the two source folders as group.table; each row knows its place in its file (column ``ORDER``)."""
    return Catalog.read(spark, raw_root, ["matches", "compets"], order_column=ORDER)


def _find(catalog: Mapping[str, DataFrame], group: str, stem: str) -> DataFrame | None:
    """The table of the group, else the one of that name."""
    own = catalog.get(f"{group}.{stem}")
    return own if own is not None else catalog.get(stem)


def _prep(stem: str, df: DataFrame | None, basic_clean: bool) -> DataFrame | None:
    """Headers, types, names and text of one file; whole-row cleaning keeps the first of equal rows."""
    if df is None:
        return None
    if ORDER not in df.columns:
        # no place recorded: the content itself orders the rows, so the choice is at least the same every time
        df = df.withColumn(ORDER, F.struct(F.concat_ws("\x1f", *[F.col(c) for c in df.columns]).alias("text")))
    if basic_clean:
        df = clean.clean_rows(df, ORDER)
    df = clean.lower_headers(df)
    df = clean.parse_numbers(df, {**{c: "int" for c in INTEGERS.get(stem, [])}, **{c: "double" for c in DECIMALS.get(stem, [])}})
    df = clean.harmonise_columns(df, NAME_COLUMNS)
    return clean.normalise_columns(df, TEXT_COLUMNS)


def _matches(df: DataFrame | None, source: int) -> DataFrame | None:
    if df is None:
        return None
    df = clean.rename(df, SCORE_ALIASES)
    df = clean.parse_dates(df, ["date"], ORDER if ORDER in df.columns else None)
    df = clean.parse_numbers(df, {"home_score": "int", "away_score": "int"})
    df = df.withColumn("__src", F.lit(source))
    if {"home_score", "away_score"}.issubset(df.columns):
        df = C.contest_features(df)
    return df


def build_tables(catalog: Mapping[str, DataFrame]) -> Tables:
    """Clean, harmonise, unify and summarise (the transform step).

    Of contests with the same date and sides, the first row of the first source stays. Missing files give
    None; a missing edition file gives an empty typed edition table."""
    m1 = _matches(_prep(MATCHES_MAIN, _find(catalog, "matches", MATCHES_MAIN), True), 1)
    m2 = _matches(_prep(MATCHES_SECOND, _find(catalog, "matches", MATCHES_SECOND), True), 2)
    editions = _find(catalog, "compets", EDITIONS)
    wc = _prep(EDITIONS, clean.rename(clean.lower_headers(editions), {"host": "host_country", "champion": "winner"})
               if editions is not None else None, True)
    if wc is not None:
        wc = wc.drop(ORDER)
    elif catalog:
        wc = empty_frame(next(iter(catalog.values())).sparkSession, EDITION_SCHEMA)
    others = {}
    for k in (RANKING, HEAD_TO_HEAD, APPEARANCES, ALLTIME):
        df = _prep(k, _find(catalog, "compets", k), False)
        others[k] = df.drop(ORDER) if df is not None else None

    matches = m1 if m2 is None else m2 if m1 is None else m1.unionByName(m2, allowMissingColumns=True)
    if matches is not None:
        key = ["date", "home_team", "away_team"]
        if m1 is not None and m2 is not None:
            own = [c for c in matches.columns if c not in ("__src", ORDER)]
            matches = C.keep_first(matches, key if set(key).issubset(own) else own, ["__src", ORDER])
        matches = shared_table(matches.drop("__src", ORDER), "unified-contests")

    stats = wr = phase = adv = None
    if matches is not None and {"home_team", "away_team", "home_score", "away_score"}.issubset(matches.columns):
        # one aggregate serves both tables
        summary = shared_table(C.two_sided_summary(matches), "team-summary")
        stats, wr = summary.select(*C.A1_COLUMNS), summary.select(*C.A2_COLUMNS)
        adv = C.side_advantage(matches)
        if "stage" in matches.columns:
            phase = C.stage_counts(matches)
    titles = C.title_counts(wc) if wc is not None and "winner" in wc.columns else None
    return Tables(matches, stats, wr, titles, phase, adv, others[HEAD_TO_HEAD], others[APPEARANCES],
                  others[ALLTIME], wc, others[RANKING])


def run(spark: SparkSession, raw_root: str, out_root: str, with_model: bool = True) -> dict[str, int]:
    """extract -> transform -> load -> pre-event feature table -> model (batch entry).

    Returns rows written per table. The feature table is built from the raw
    appearance file (not the harmonised one), as in the flow being rebuilt.
    When a scoring file is present, the outcome model is fitted on the
    feature table and its ranked predictions are exported (S8). Reports are
    small by nature (a row per entity and edition) and go to single files.
    """
    raw_root, out_root = raw_root.rstrip("/"), out_root.rstrip("/")
    t = build_tables(read_sources(spark, raw_root))
    counts: dict[str, int] = {}
    if t.matches is not None:
        tables = {"dim_team": W.build_dim_team(t.matches, t.team_stats, t.win_rate, t.titles),
                  "dim_edition": W.build_dim_edition(t.worldcup)}
        if "stadium" in t.matches.columns:
            tables["dim_stadium"] = W.build_dim_stadium(t.matches)
        tables["fact_matches"] = lambda r: W.build_fact_matches(t.matches, r("dim_team"), r("dim_stadium") if "dim_stadium" in tables else None)
        if t.team_stats is not None:
            tables["fact_team_performance"] = lambda r: W.with_team_id(t.team_stats, r("dim_team"))
        if t.phase_performance is not None:
            tables["fact_phase_performance"] = lambda r: W.with_team_id(t.phase_performance, r("dim_team"))
        if t.head_to_head is not None:
            tables["fact_head_to_head"] = t.head_to_head
        counts.update(TableSet(spark, f"{out_root}/warehouse").load(tables, W.FACT_PARTITIONS))
    raw_app, scoring_path = f"{raw_root}/compets/{APPEARANCES}.csv", f"{raw_root}/compets/{SCORING}.csv"
    if not exists(spark, raw_app):
        return counts
    feats = pre_event_features(read_csv(spark, raw_app)).orderBy("team", "wc_year")
    counts["ml_dataset_historical"] = write_csv(feats, f"{out_root}/processed/ml_dataset_historical", single_file=True)
    if with_model and exists(spark, scoring_path):
        train = spark.read.option("header", True).csv(f"{out_root}/processed/ml_dataset_historical")
        train = clean.parse_numbers(M.align_features(train), {"target_top4": "int"})
        model = M.fit_outcome_model(train)
        scoring = M.align_features(read_csv(spark, scoring_path), SCORING_RENAMES)
        ranked = M.score_outcomes(model, scoring)
        counts["predictions"] = write_csv(ranked, f"{out_root}/processed/predictions", single_file=True)
    return counts
