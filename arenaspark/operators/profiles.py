"""Entity profile operators."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaspark.functions.exprs import clip_lower, safe_ratio
from arenaspark.operators.stats import arg_best
from arenaspark.specs import ProfileSpec

ROUND = 6


def with_rates(df: DataFrame, spec: ProfileSpec = ProfileSpec()) -> DataFrame:
    """goals_per_match and conceded_per_match, 0 without matches (P10)."""
    return df.withColumns({
        "goals_per_match": F.bround(safe_ratio(spec.goals_for, spec.matches), ROUND),
        "conceded_per_match": F.bround(safe_ratio(spec.goals_against, spec.matches), ROUND),
    })


def add_win_rate_if_absent(df: DataFrame, win_rate: DataFrame, spec: ProfileSpec = ProfileSpec()) -> DataFrame:
    """Conditional left join: add win_rate from the contest table only when the
    profile lacks it (J4). win_rate is keyed by entity, so no fan-out."""
    if spec.win_rate in df.columns:
        return df
    wr = win_rate.select(F.col("team").alias(spec.entity), F.col("win_rate").alias(spec.win_rate))
    return df.join(wr, spec.entity, "left")


def join_ranking(df: DataFrame, ranking: DataFrame, spec: ProfileSpec = ProfileSpec(),
                 rank_col: str = "rank", as_name: str = "ranking") -> DataFrame:
    """Left join of an external ranking by name; unmatched -> null.

    The ranking is reduced to one row per name first, so the join cannot fan out.
    """
    r = ranking.groupBy(F.col("team").alias(spec.entity)).agg(F.min(rank_col).alias(as_name))
    return df.join(r, spec.entity, "left")


def filter_profiles(df: DataFrame, spec: ProfileSpec = ProfileSpec(), min_appearances: int | None = 3,
                    group: str | None = None, min_matches: int | None = None) -> DataFrame:
    """Minimum support (P18) and optional one-group filter (P19, 'all' = None)."""
    out = df
    if min_appearances is not None:
        out = out.where(F.col(spec.appearances) >= min_appearances)
    if min_matches is not None:
        out = out.where(F.col(spec.matches) >= min_matches)
    if group is not None:
        out = out.where(F.col(spec.group) == group)
    return out


def profile_leaders(df: DataFrame, spec: ProfileSpec = ProfileSpec()) -> DataFrame:
    """Entity count and the arg-max entity for titles, win rate and
    appearances, one row (A31, T6: ties resolved by name)."""
    return df.agg(
        F.count(F.lit(1)).alias("entities"),
        arg_best(spec.titles, spec.entity).alias("most_titles"),
        F.max(spec.titles).alias("max_titles"),
        arg_best(spec.win_rate, spec.entity).alias("best_win_rate_team"),
        F.bround(F.max(spec.win_rate), ROUND).alias("best_win_rate"),
        arg_best(spec.appearances, spec.entity).alias("most_appearances_team"),
        F.max(spec.appearances).alias("max_appearances"),
    )


def factor_leaders(df: DataFrame, spec: ProfileSpec = ProfileSpec()) -> DataFrame:
    """Best attack, best defence (lowest conceded), most experienced."""
    r = with_rates(df, spec)
    return r.agg(
        arg_best("goals_per_match", spec.entity).alias("best_attack"),
        arg_best("conceded_per_match", spec.entity, lowest=True).alias("best_defence"),
        arg_best(spec.appearances, spec.entity).alias("most_experienced"),
        arg_best(spec.win_rate, spec.entity).alias("best_win_rate"),
    )


def bubble(df: DataFrame, spec: ProfileSpec = ProfileSpec(), min_size: float = 0.5) -> DataFrame:
    """Bubble table: titles shown with a floor so zero-title entities stay visible."""
    return df.select(
        spec.entity, spec.group, spec.appearances, F.bround(spec.win_rate, ROUND).alias(spec.win_rate),
        F.coalesce(F.col(spec.titles), F.lit(0)).alias("titles_disp"),
        clip_lower(F.coalesce(F.col(spec.titles), F.lit(0)).cast("double"), min_size).alias("bubble_size"),
    )


def group_titles_share(df: DataFrame, spec: ProfileSpec = ProfileSpec()) -> DataFrame:
    """Titles per group and each group's share of all titles.

    The grand total is a scalar subquery, not a window over one partition.
    """
    g = (df.where(F.col(spec.group).isNotNull())
         .groupBy(F.col(spec.group).alias("group_name"))
         .agg(F.coalesce(F.sum(spec.titles), F.lit(0)).cast("long").alias("titles")))
    total = df.agg(F.coalesce(F.sum(spec.titles), F.lit(0)).cast("double")).scalar()
    return g.withColumn("share", F.bround(safe_ratio(F.col("titles"), total), ROUND))


def group_finals(df: DataFrame, spec: ProfileSpec = ProfileSpec()) -> DataFrame:
    """Finals, semi-finals and quarter-finals reached per group."""
    return (df.where(F.col(spec.group).isNotNull())
            .groupBy(F.col(spec.group).alias("group_name")).agg(
                F.coalesce(F.sum(spec.finals), F.lit(0)).cast("long").alias("finals"),
                F.coalesce(F.sum(spec.semis), F.lit(0)).cast("long").alias("semis"),
                F.coalesce(F.sum(spec.quarters), F.lit(0)).cast("long").alias("quarters")))


def with_label(df: DataFrame, key: str, labels: DataFrame, label_key: str = "name",
               tag: str = "tag", out: str | None = None) -> DataFrame:
    """Display label 'tag name'; entities without a tag keep their name.

    The label dimension is reduced to one row per key, then left-joined: the
    row count of ``df`` never changes.
    """
    out = out or f"label_{key}"
    lab = labels.groupBy(F.col(label_key).alias("__k")).agg(F.min(tag).alias("__tag"))
    j = df.join(lab, df[key] == lab["__k"], "left")
    return j.withColumn(out, F.coalesce(F.concat_ws(" ", F.col("__tag"), F.col(key)), F.col(key))) \
        .drop("__k", "__tag")
