"""Entity x edition panel operators."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenaspark.constants import (
    FAVOURITE_MIN_STAGE_SCORE, FAVOURITE_STRENGTH, STAGE_SCORE, TRUTHY_WORDS,
    UPSET_DEFAULT_STAGE_SCORE, UPSET_STRENGTH,
)
from arenaspark.functions.exprs import (
    decade_of, normalise_text, outcome_targets, safe_ratio, stage_score, truthy, two_label,
)
from arenaspark.operators.stats import safe_corr
from arenaspark.specs import PanelSpec

ROUND = 6


def enrich_panel(df: DataFrame, spec: PanelSpec = PanelSpec(),
                 host_words: Iterable[str] = TRUTHY_WORDS) -> DataFrame:
    """Adds decade, is_host, win_rate, phase_lower, phase_score, strength.

    win_rate = wins / played, 0 when not played (P10); host flag by the truthy
    word set (P13, T19); stage score on the ordinal scale (P14).
    """
    return df.withColumns({
        "decade": decade_of(spec.edition),
        "is_host": truthy(spec.host, host_words),
        "win_rate": safe_ratio(spec.wins, spec.played),
        "phase_lower": normalise_text(spec.stage),
        "phase_score": stage_score(spec.stage),
        "strength": F.col(spec.strength).cast("string").try_cast("double"),
    })


def with_targets(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Champion / top-4 / top-8 indicators from the stage reached."""
    return df.withColumns(outcome_targets(spec.stage))


def filter_members(df: DataFrame, column: str, values: DataFrame | Sequence | None = None,
                   lo=None, hi=None, range_col: str | None = None) -> DataFrame:
    """Membership + closed-range filter (P20).

    ``values`` may be a list (literal IN, pushed to the scan) or a DataFrame of
    members (left-semi join: never fans out; AQE broadcasts it when small).
    """
    out = df
    if values is not None:
        if isinstance(values, DataFrame):
            m = values.select(F.col(values.columns[0]).alias("__m")).distinct()
            out = out.join(m, out[column] == m["__m"], "left_semi")
        else:
            out = out.where(F.col(column).isin(list(values)))
    if range_col is not None and (lo is not None or hi is not None):
        c = F.col(range_col)
        if lo is not None:
            out = out.where(c >= lo)
        if hi is not None:
            out = out.where(c <= hi)
    return out


def host_vs_visitor(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Host and visitor counts, mean win rates and their difference, one row."""
    p = enrich_panel(df, spec)
    r = p.agg(
        F.count_if(F.col("is_host")).alias("host_count"),
        F.count_if(~F.col("is_host")).alias("visitor_count"),
        F.avg(F.when(F.col("is_host"), F.col("win_rate"))).alias("host_win_rate"),
        F.avg(F.when(~F.col("is_host"), F.col("win_rate"))).alias("visitor_win_rate"),
    )
    return r.select(
        "host_count", "visitor_count",
        F.bround("host_win_rate", ROUND).alias("host_win_rate"),
        F.bround("visitor_win_rate", ROUND).alias("visitor_win_rate"),
        F.bround(F.col("host_win_rate") - F.col("visitor_win_rate"), ROUND).alias("delta"),
    )


def host_wdl_means(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Mean wins, draws, losses for hosts and visitors."""
    p = enrich_panel(df, spec)
    return p.groupBy(two_label("is_host", "host", "visitor").alias("status")).agg(
        F.bround(F.avg(spec.wins), ROUND).alias("mean_wins"),
        F.bround(F.avg(spec.draws), ROUND).alias("mean_draws"),
        F.bround(F.avg(spec.losses), ROUND).alias("mean_losses"),
    )


def host_stage_counts(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Stages reached by hosts and how often."""
    p = enrich_panel(df, spec).where(F.col("is_host"))
    return p.groupBy(F.col(spec.stage).alias("stage")).agg(F.count(F.lit(1)).alias("count"))


def host_by_edition(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Mean win rate by edition and host status."""
    p = enrich_panel(df, spec)
    return p.groupBy(F.col(spec.edition).alias("edition"),
                     two_label("is_host", "host", "visitor").alias("status")).agg(
        F.bround(F.avg("win_rate"), ROUND).alias("win_rate"))


def host_table(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Host rows with their record, latest edition first (L4)."""
    p = enrich_panel(df, spec).where(F.col("is_host"))
    return p.select(
        F.col(spec.entity).alias("team"), F.col(spec.edition).alias("edition"),
        spec.wins, spec.draws, spec.losses, spec.goals_for, spec.goals_against,
        F.bround("win_rate", ROUND).alias("win_rate"), F.col(spec.stage).alias("stage"),
    ).orderBy(F.desc("edition"), "team")


def participation_counts(df: DataFrame, spec: PanelSpec = PanelSpec(), k: int | None = 15) -> DataFrame:
    """Participations per entity; the k most frequent (A15, L1), ties by name."""
    c = (df.where(F.col(spec.entity).isNotNull())
         .groupBy(F.col(spec.entity).alias("team"))
         .agg(F.count(spec.edition).alias("participations")))
    if k is None:
        return c
    return c.orderBy(F.desc("participations"), "team").limit(k)


def _stage_pivot(df: DataFrame, editions: Sequence[int], value, agg, spec: PanelSpec,
                 fill, prefix: str) -> DataFrame:
    return df.groupBy(F.col(spec.entity).alias("team")).agg(*[
        F.coalesce(agg(F.when(F.col(spec.edition) == y, value)), F.lit(fill)).alias(f"{prefix}{y}")
        for y in editions
    ])


def stage_heatmap(df: DataFrame, editions: Sequence[int], spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Entity x edition matrix of the best stage score, absent = -1.

    Editions are a parameter, so the pivot is one conditional aggregate.
    """
    p = enrich_panel(df, spec)
    return _stage_pivot(p, editions, F.col("phase_score"), F.max, spec, -1, "y")


def stage_labels(df: DataFrame, editions: Sequence[int], spec: PanelSpec = PanelSpec(),
                 absent: str = "not qualified") -> DataFrame:
    """Entity x edition matrix of the stage label, absent = 'not qualified' (A17).

    When two rows share (entity, edition) after harmonising (T8), the label of
    the best stage is kept (equal scores: the larger label), which is
    deterministic.
    """
    p = enrich_panel(df, spec).withColumn(
        "__rank", F.struct(F.col("phase_score"), F.col(spec.stage)))
    return p.groupBy(F.col(spec.entity).alias("team")).agg(*[
        F.coalesce(F.max(F.when(F.col(spec.edition) == y, F.col("__rank")))[spec.stage],
                   F.lit(absent)).alias(f"y{y}")
        for y in editions
    ])


def stage_grid(df: DataFrame, lo: Column, hi: Column, spec: PanelSpec = PanelSpec(),
               absent: str = "not qualified") -> DataFrame:
    """Entity x edition grid in long form: best stage score and label.

    Every entity gets every edition from ``lo`` to ``hi`` (columns, such as
    scalar subqueries of the data's own bounds); absent: score -1 and the label
    ``absent``. Two rows of one entity and edition: the best stage counts (T8).
    """
    p = enrich_panel(df, spec).where(F.col(spec.edition).between(lo, hi))
    best = p.groupBy(F.col(spec.entity).alias("team"), F.col(spec.edition).cast("int").alias("edition")).agg(
        F.max(F.struct("phase_score", F.col(spec.stage).alias("label"))).alias("best"))
    cells = best.select("team").distinct().select("team", F.explode(F.sequence(lo.cast("int"), hi.cast("int"))).alias("edition"))
    return cells.join(best, ["team", "edition"], "left").select(
        "team", "edition", F.coalesce("best.phase_score", F.lit(-1)).alias("phase_score"),
        F.when(F.col("best").isNull(), F.lit(absent)).otherwise(F.col("best.label")).alias("stage"))


def winrate_by_entity_edition(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Per-row win rate, 0 when not played (P10)."""
    p = enrich_panel(df, spec)
    return p.select(F.col(spec.entity).alias("team"), F.col(spec.edition).alias("edition"),
                    F.bround("win_rate", ROUND).alias("win_rate_ed"))


def top_per_group(df: DataFrame, group: str, value: str, entity: str, k: int) -> DataFrame:
    """Rank within group with unique ranks, keep the top k.

    ``row_number() <= k`` is planned as a WindowGroupLimit, which trims each
    partition to k rows per group *before* the shuffle.
    """
    w = Window.partitionBy(group).orderBy(F.desc(value), F.asc(entity))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def decade_top(df: DataFrame, spec: PanelSpec = PanelSpec(), k: int = 5) -> DataFrame:
    """Wins per decade and entity (A18), top k per decade."""
    p = enrich_panel(df, spec)
    s = (p.where(F.col(spec.entity).isNotNull())
         .groupBy("decade", F.col(spec.entity).alias("team"))
         .agg(F.coalesce(F.sum(spec.wins), F.lit(0)).cast("long").alias("wins")))
    return top_per_group(s, "decade", "wins", "team", k)


def upset_rows(df: DataFrame, spec: PanelSpec = PanelSpec(), max_strength: float = UPSET_STRENGTH,
               chosen_stage: str | None = None) -> DataFrame:
    """Weak entity that still went far: strength < t1 and stage score >= t2.

    t2 is the score of ``chosen_stage`` on the scale, the default score when
    the stage is not on it (trap T18).
    """
    t2 = STAGE_SCORE.get((chosen_stage or "").lower().strip(), UPSET_DEFAULT_STAGE_SCORE)
    p = enrich_panel(df, spec).where(F.col("strength").isNotNull())
    return p.where((F.col("strength") < max_strength) & (F.col("phase_score") >= t2))


def upset_kpis(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Strength/stage correlation, upset and favourite counts, one pass."""
    p = enrich_panel(df, spec).where(F.col("strength").isNotNull())
    s, ps = F.col("strength"), F.col("phase_score")
    return p.agg(
        F.bround(safe_corr(s, ps), ROUND).alias("strength_stage_corr"),
        F.count_if((s < UPSET_STRENGTH) & (ps >= UPSET_DEFAULT_STAGE_SCORE)).alias("upsets"),
        F.count_if((s >= FAVOURITE_STRENGTH) & (ps >= FAVOURITE_MIN_STAGE_SCORE)).alias("favourites_far"),
        F.count(F.lit(1)).alias("rated_rows"),
    )


def upsets_by_edition(df: DataFrame, spec: PanelSpec = PanelSpec(),
                      max_strength: float = UPSET_STRENGTH, chosen_stage: str = "quarter-finals") -> DataFrame:
    """Upset count per edition."""
    u = upset_rows(df, spec, max_strength, chosen_stage)
    return u.groupBy(F.col(spec.edition).alias("edition")).agg(F.count(F.lit(1)).alias("upsets"))


def upset_list(df: DataFrame, spec: PanelSpec = PanelSpec(), max_strength: float = 1800,
               min_strength: float | None = None) -> DataFrame:
    """The list of upsets, deepest run first (L4, P22 floor)."""
    u = upset_rows(df, spec, max_strength)
    if min_strength is not None:
        u = u.where(F.col("strength") >= min_strength)
    return u.select(F.col(spec.entity).alias("team"), F.col(spec.edition).alias("edition"),
                    "strength", F.col(spec.stage).alias("stage"), F.col(spec.group).alias("group_name"),
                    "phase_score").orderBy(F.desc("phase_score"), "edition", "team")


def group_winrate_decade(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Mean win rate per decade and group."""
    p = enrich_panel(df, spec).where(F.col(spec.group).isNotNull())
    return p.groupBy("decade", F.col(spec.group).alias("group_name")).agg(
        F.bround(F.avg("win_rate"), ROUND).alias("win_rate"))


def group_stage_counts(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Participations per group and stage (A27); null stages form no group (T5)."""
    p = enrich_panel(df, spec).where(F.col(spec.group).isNotNull() & F.col("phase_lower").isNotNull())
    return p.groupBy(F.col(spec.group).alias("group_name"), "phase_lower").agg(
        F.count(F.lit(1)).alias("count"))


def group_participations(df: DataFrame, spec: PanelSpec = PanelSpec(), by_edition: bool = False) -> DataFrame:
    """Participations per group (A29) or per edition and group."""
    keys = [F.col(spec.group).alias("group_name")]
    if by_edition:
        keys = [F.col(spec.edition).alias("edition")] + keys
    return (df.where(F.col(spec.group).isNotNull()).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("participations")))
