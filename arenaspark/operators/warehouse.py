"""Star-schema warehouse.

Dimensions get dense surrogate keys in natural-key order (reproducible, T12),
computed without a single-task global window. Facts look the keys up with
left joins on unique dimension keys, so a fact row is never duplicated or
dropped; the stadium lookup is keyed on (stadium, city) (trap T7).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenaspark.functions.exprs import goal_diff, result_code
from arenaspark.operators.keys import merge_key_map
from arenaspark.operators.windows import dense_keys
from arenaspark.session import broadcast_if_small
from arenaspark.sources.tableset import TableSet
from arenaspark.specs import ContestSpec


DIM_MAX_ROWS = 200_000  # rows up to which a dimension is broadcast


def entity_names(contests: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Distinct union of home and away names, nulls dropped (U3); one scan for both sides."""
    return (contests.select(F.explode(F.array(spec.home, spec.away)).alias("team_name"))
            .where(F.col("team_name").isNotNull()).distinct())


def build_dim_team(contests: DataFrame, team_stats: DataFrame | None = None,
                   win_rate: DataFrame | None = None, titles: DataFrame | None = None,
                   spec: ContestSpec = ContestSpec(), keys: bool = True) -> DataFrame:
    """team_id, team_name, games_played, win_rate, titles.

    When one table carries both games_played and win_rate (the one-aggregate
    summary), it is joined once. Without ``keys`` there is no team_id.
    """
    d = entity_names(contests, spec)
    if keys:
        d = dense_keys(d, ["team_name"], "team_id")
    if team_stats is not None and win_rate is None and "win_rate" in team_stats.columns:
        d = d.join(team_stats.select(F.col("team").alias("team_name"), "games_played", "win_rate"),
                   "team_name", "left")
    if team_stats is not None and win_rate is not None:
        d = d.join(team_stats.select(F.col("team").alias("team_name"), "games_played"), "team_name", "left")
    if win_rate is not None:
        d = d.join(win_rate.select(F.col("team").alias("team_name"), "win_rate"), "team_name", "left")
    if titles is not None:
        d = (d.join(titles.select(F.col("team").alias("team_name"), "titles"), "team_name", "left")
             .withColumn("titles", F.coalesce(F.col("titles"), F.lit(0)).cast("long")))
    return d


def build_dim_edition(editions: DataFrame) -> DataFrame:
    """edition_year, host_country, winner, teams (present columns only)."""
    cols = [c for c in ["year", "host_country", "winner", "teams"] if c in editions.columns]
    return editions.select(*cols).withColumnRenamed("year", "edition_year")


def stadium_names(contests: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Distinct (stadium, city) pairs with a stadium (U6); city null when contests have none."""
    city = F.col(spec.city) if spec.city in contests.columns else F.lit(None).cast("string")
    return (contests.select(F.col(spec.venue).alias("stadium"), city.alias("city"))
            .where(F.col("stadium").isNotNull()).distinct())


def build_dim_stadium(contests: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """The stadium pairs keyed 1..n."""
    return dense_keys(stadium_names(contests, spec), ["stadium", "city"], "stadium_id")


def build_fact_matches(contests: DataFrame, dim_team: DataFrame, dim_stadium: DataFrame | None,
                       spec: ContestSpec = ContestSpec()) -> DataFrame:
    """One row per contest with team and stadium foreign keys.

    Dimensions are broadcast behind a row count (``DIM_MAX_ROWS``), so the facts
    are not shuffled on a few hot names; a larger dimension joins by shuffle.
    Without a stage or venue in the contests those columns are null or absent.
    """
    dim_team = broadcast_if_small(dim_team.select("team_name", "team_id"), DIM_MAX_ROWS)
    h = dim_team.select(F.col("team_name").alias("__h"), F.col("team_id").alias("home_team_id"))
    a = dim_team.select(F.col("team_name").alias("__a"), F.col("team_id").alias("away_team_id"))
    f = (contests.join(h, contests[spec.home] == h["__h"], "left")
         .join(a, F.col(spec.away) == a["__a"], "left"))
    cols = [F.col(spec.date).alias("date"), F.year(spec.date).alias("edition_year"),
            "home_team_id", "away_team_id"]
    if dim_stadium is not None:
        s = broadcast_if_small(dim_stadium.select(F.col("stadium").alias("__s"), F.col("city").alias("__c"), "stadium_id"),
                               DIM_MAX_ROWS)
        city = F.col(spec.city) if spec.city in contests.columns else F.lit(None).cast("string")
        f = f.join(s, (F.col(spec.venue) == s["__s"]) & city.eqNullSafe(s["__c"]), "left")
        cols.append("stadium_id")
    cols += [F.col(spec.home_score).alias("home_score"), F.col(spec.away_score).alias("away_score"),
             goal_diff(spec.home_score, spec.away_score).alias("goal_diff"),
             (F.col(spec.stage) if spec.stage in contests.columns else F.lit(None).cast("string")).alias("stage"),
             result_code(spec.home_score, spec.away_score).alias("result")]
    return f.select(*cols)


def with_team_id(df: DataFrame, dim_team: DataFrame, team: str = "team") -> DataFrame:
    """Replace the team name by its surrogate key (fact_team_performance,
    fact_phase_performance)."""
    d = broadcast_if_small(dim_team.select(F.col("team_name").alias("__t"), "team_id"), DIM_MAX_ROWS)
    return df.join(d, df[team] == d["__t"], "left").drop("__t", team)


def head_to_head(contests: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Pair record for every unordered pair (team_a <= team_b): meetings,
    wins of each side, draws, goals, last meeting (fact_head_to_head).

    One partial aggregate keyed on the pair: a pair holding a third of all
    contests is combined inside each task before the shuffle.
    """
    h, a = F.col(spec.home), F.col(spec.away)
    hs, as_ = F.col(spec.home_score), F.col(spec.away_score)
    ta, tb = F.least(h, a), F.greatest(h, a)
    a_is_home = h == ta
    ga = F.when(a_is_home, hs).otherwise(as_)
    gb = F.when(a_is_home, as_).otherwise(hs)
    x = contests.where(h.isNotNull() & a.isNotNull()).select(
        ta.alias("team_a"), tb.alias("team_b"), ga.alias("ga"), gb.alias("gb"), F.col(spec.date).alias("d"))
    g = x.groupBy("team_a", "team_b").agg(
        F.count(F.lit(1)).alias("total_wc_matches"),
        F.count_if(F.col("ga") > F.col("gb")).alias("team_a_wins"),
        F.count_if(F.col("ga") == F.col("gb")).alias("draws"),
        F.count_if(F.col("ga") < F.col("gb")).alias("team_b_wins"),
        F.coalesce(F.sum("ga"), F.lit(0)).cast("long").alias("team_a_goals"),
        F.coalesce(F.sum("gb"), F.lit(0)).cast("long").alias("team_b_goals"),
        F.max("d").alias("last_wc_meeting_date"),
    )
    return g.withColumns({
        "goal_difference_a": F.col("team_a_goals") - F.col("team_b_goals"),
        "last_wc_meeting_year": F.year("last_wc_meeting_date"),
    })


def star_join(spark: SparkSession, fact: DataFrame, dim_team: DataFrame, stage: str) -> DataFrame:
    """Fact joined twice to the team dimension, one stage, by date."""
    return spark.sql(
        """
        SELECT f.date, h.team_name AS home_team, a.team_name AS away_team,
               f.home_score, f.away_score
        FROM {fact} f
        JOIN {dim} h ON f.home_team_id = h.team_id
        JOIN {dim} a ON f.away_team_id = a.team_id
        WHERE f.stage = {stage}
        ORDER BY f.date
        """, fact=fact, dim=dim_team, stage=stage)


def edition_join(spark: SparkSession, fact: DataFrame, dim_team: DataFrame, edition: int) -> DataFrame:
    """The star join for one edition (J7); on facts partitioned by edition only its folder is opened."""
    return spark.sql(
        """
        SELECT f.date, h.team_name AS home_team, a.team_name AS away_team, f.home_score, f.away_score, f.stage, f.result
        FROM {fact} f
        JOIN {dim} h ON f.home_team_id = h.team_id
        JOIN {dim} a ON f.away_team_id = a.team_id
        WHERE f.edition_year = {edition}
        """, fact=fact, dim=dim_team, edition=edition)


def title_editions_join(spark: SparkSession, fact: DataFrame, dim_edition: DataFrame, dim_team: DataFrame, winner: str) -> DataFrame:
    """Contests of the editions that ``winner`` won, per edition.

    The editions come from the dimension at run time; the facts' partitions are pruned by them."""
    return spark.sql(
        """
        SELECT f.edition_year, count(*) AS matches, sum(f.home_score + f.away_score) AS goals,
               count_if(h.team_name = e.winner OR a.team_name = e.winner) AS winner_matches
        FROM {fact} f
        JOIN {editions} e ON f.edition_year = e.edition_year
        JOIN {dim} h ON f.home_team_id = h.team_id
        JOIN {dim} a ON f.away_team_id = a.team_id
        WHERE e.winner = {winner}
        GROUP BY f.edition_year
        """, fact=fact, editions=broadcast_if_small(dim_edition, DIM_MAX_ROWS), dim=dim_team, winner=winner)


def dim_top(spark: SparkSession, dim_team: DataFrame, min_games: int = 10, k: int = 10) -> DataFrame:
    """WHERE games_played >= k ORDER BY win_rate DESC LIMIT 10 over the dimension."""
    return spark.sql(
        """
        SELECT team_name, win_rate, games_played FROM {dim}
        WHERE games_played >= {min_games}
        ORDER BY win_rate DESC, team_name
        LIMIT {k}
        """, dim=dim_team, min_games=min_games, k=k)


FACT_PARTITIONS = {"fact_matches": ["edition_year"]}  # one folder per edition: an edition's queries open no other


def keyed_dimension(dim: DataFrame, key_map: DataFrame, natural: list[str], key: str) -> DataFrame:
    """``dim`` with ``key`` from the key map instead of its own."""
    d, m = dim.drop(key).alias("d"), broadcast_if_small(key_map, DIM_MAX_ROWS).alias("m")
    on = reduce(lambda x, y: x & y, [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in natural])
    return d.join(m, on).select(f"m.{key}", "d.*")


def load_warehouse(spark: SparkSession, contests: DataFrame, editions: DataFrame, stages: list[str],
                   root: str, spec: ContestSpec = ContestSpec(), stable_keys: bool = False,
                   extra: Mapping[str, DataFrame] | None = None) -> dict[str, int]:
    """Build the seven warehouse tables and replace the set as a whole (S6); rows per table.

    Dimensions are written first and read back, so the facts look up the
    keys of the written dimensions (each dimension is computed once, and the
    facts never depend on recomputing it). Keys number the names from 1, or,
    with ``stable_keys``, are hash keys kept in the tables key_team and
    key_stadium of the set: a later load adds names and leaves known keys.
    Facts are partitioned by edition. ``extra`` tables replace or join the seven.
    """
    from arenaspark.operators.contests import A1_COLUMNS, stage_matrix, title_counts, two_sided_summary

    target = TableSet(spark, root)
    had = set(target.tables())
    summary = two_sided_summary(contests, spec)
    stats = summary.select(*A1_COLUMNS)
    titles = title_counts(editions)
    tables: dict = {}
    if stable_keys:
        def key_map(name: str, names: DataFrame, natural: list[str], key: str) -> DataFrame:
            return merge_key_map(target.read(name) if name in had else None, names, natural, key)

        place = ["stadium", "city"]
        tables["key_team"] = lambda _: key_map("key_team", entity_names(contests, spec), ["team_name"], "team_id")
        tables["key_stadium"] = lambda _: key_map("key_stadium", stadium_names(contests, spec), place, "stadium_id")
        tables["dim_team"] = lambda t: keyed_dimension(
            build_dim_team(contests, summary, None, titles, spec, keys=False), t("key_team"), ["team_name"], "team_id")
        tables["dim_stadium"] = lambda t: keyed_dimension(stadium_names(contests, spec), t("key_stadium"), place, "stadium_id")
    else:
        tables["dim_team"] = build_dim_team(contests, summary, None, titles, spec)
        tables["dim_stadium"] = build_dim_stadium(contests, spec)
    tables |= {
        "dim_edition": build_dim_edition(editions),
        "fact_matches": lambda t: build_fact_matches(contests, t("dim_team"), t("dim_stadium"), spec),
        "fact_team_performance": lambda t: with_team_id(stats, t("dim_team")),
        "fact_phase_performance": lambda t: with_team_id(stage_matrix(contests, stages, spec), t("dim_team")),
        "fact_head_to_head": head_to_head(contests, spec),
        **(extra or {}),
    }
    return target.load(tables, FACT_PARTITIONS)
