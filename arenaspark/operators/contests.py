"""Two-sided contest operators.

Design: every per-entity statistic is computed from the *long form* -- each
contest row is turned into two rows (one per side) by a generator inside the
same stage as the scan, then a single ``groupBy(entity)`` aggregates both
sides. That is one shuffle with map-side partial aggregation, instead of two
aggregates and a full outer join; a hot entity is pre-aggregated per task, so
at most (tasks x entities) rows cross the network whatever the skew.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenaspark.functions.exprs import (
    decade_of, goal_diff, result_code, round_half_even, safe_ratio, score_label, total_score,
)
from arenaspark.specs import ContestSpec

ROUND = 6  # every ratio / mean leaves the engine rounded to this many places


def contest_features(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """goal_diff, result, year, decade, total_goals per contest."""
    h, a = F.col(spec.home_score), F.col(spec.away_score)
    cols = {
        "goal_diff": goal_diff(h, a),
        "result": result_code(h, a),
        "total_goals": total_score(h, a),
    }
    if spec.date in df.columns:
        cols["year"] = F.year(spec.date)
        cols["decade"] = decade_of(F.year(spec.date))
    return df.withColumns(cols)


def with_calendar(df: DataFrame, date: str | None = "date", year: str | None = None) -> DataFrame:
    """Derived year and decade (the accessors' calendar columns, P11): from a
    date column (coerced parse first), or from an existing year column."""
    if date is not None and date in df.columns:
        from arenaspark.operators.clean import parse_dates

        df = parse_dates(df, [date])
        return df.withColumns({"year": F.year(date), "decade": decade_of(F.year(date))})
    if year is not None and year in df.columns:
        return df.withColumn("decade", decade_of(F.col(year).cast("int")))
    return df


def long_form(df: DataFrame, spec: ContestSpec = ContestSpec(),
              keep: Sequence[str] = ()) -> DataFrame:
    """One row per (contest, side): team, opponent, side, goals_for, goals_against.

    ``keep`` columns are carried on both rows. ``inline(array(struct, struct))``
    reads the contest once (a union would scan and join the input twice).
    """
    h, a = F.col(spec.home), F.col(spec.away)
    hs, as_ = F.col(spec.home_score), F.col(spec.away_score)
    home = F.struct(h.alias("team"), a.alias("opponent"), F.lit("home").alias("side"),
                    hs.alias("goals_for"), as_.alias("goals_against"))
    away = F.struct(a.alias("team"), h.alias("opponent"), F.lit("away").alias("side"),
                    as_.alias("goals_for"), hs.alias("goals_against"))
    return df.select(*[F.col(c) for c in keep], F.inline(F.array(home, away)))


def _side(side: str, c: Column) -> Column:
    return F.when(F.col("side") == side, c)


A1_COLUMNS = ["team", "goals_scored_home", "home_games", "goals_conceded_home", "goals_scored_away",
              "away_games", "goals_conceded_away", "goals_scored", "goals_conceded", "games_played",
              "goal_diff", "goals_per_game", "conceded_per_game"]
A2_COLUMNS = ["team", "win_rate", "total_wins", "total_games"]


def two_sided_summary(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Every per-entity two-sided statistic from ONE aggregate (A1 + A2).

    goals and games per side and in total, rates, wins and the pooled win
    rate. Games per side count *non-null* scores (trap T3) while total_games
    counts rows, so a contest with a missing score is a game but not a win
    (T4); sums of all-null groups are 0 (T11); null names form no group (T10).
    Queries that need only some columns get only those aggregates: Catalyst
    prunes the unused ones.
    """
    lf = long_form(df, spec).where(F.col("team").isNotNull())
    gf, ga = F.col("goals_for"), F.col("goals_against")
    z = F.lit(0).cast("long")
    agg = lf.groupBy("team").agg(
        F.coalesce(F.sum(_side("home", gf)).cast("long"), z).alias("goals_scored_home"),
        F.count(_side("home", gf)).alias("home_games"),
        F.coalesce(F.sum(_side("home", ga)).cast("long"), z).alias("goals_conceded_home"),
        F.coalesce(F.sum(_side("away", gf)).cast("long"), z).alias("goals_scored_away"),
        F.count(_side("away", gf)).alias("away_games"),
        F.coalesce(F.sum(_side("away", ga)).cast("long"), z).alias("goals_conceded_away"),
        F.count_if(gf > ga).alias("total_wins"),
        F.count(F.lit(1)).alias("total_games"),
    )
    return agg.withColumns({
        "goals_scored": F.col("goals_scored_home") + F.col("goals_scored_away"),
        "goals_conceded": F.col("goals_conceded_home") + F.col("goals_conceded_away"),
        "games_played": F.col("home_games") + F.col("away_games"),
        "win_rate": F.bround(safe_ratio("total_wins", "total_games"), ROUND),
    }).withColumns({
        "goal_diff": F.col("goals_scored") - F.col("goals_conceded"),
        "goals_per_game": F.bround(safe_ratio("goals_scored", "games_played"), ROUND),
        "conceded_per_game": F.bround(safe_ratio("goals_conceded", "games_played"), ROUND),
    })


def two_sided_stats(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Per-entity goals and games for each side and in total."""
    return two_sided_summary(df, spec).select(*A1_COLUMNS)


def two_sided_win_rate(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Pooled win rate over both sides."""
    return two_sided_summary(df, spec).select(*A2_COLUMNS)


def title_counts(editions: DataFrame, winner: str = "winner") -> DataFrame:
    """Titles per winner; editions without a winner form no group."""
    return (editions.where(F.col(winner).isNotNull())
            .groupBy(F.col(winner).alias("team")).agg(F.count(F.lit(1)).alias("titles")))


def _safe_names(values: Sequence[str]) -> list[str]:
    """Column names for ``values``; those that would collide get a number."""
    out: list[str] = []
    for v in values:
        base = name = "".join(ch if ch.isalnum() else "_" for ch in str(v)).strip("_")
        n = 2
        while name in out:
            name, n = f"{base}_{n}", n + 1
        out.append(name)
    return out


def stage_counts(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Appearances per entity and stage, long form: team, stage, appearances.

    The primary form: no stage list, so no stage can be left out."""
    lf = long_form(df, spec, keep=[spec.stage]).where(F.col("team").isNotNull() & F.col(spec.stage).isNotNull())
    return lf.groupBy("team", F.col(spec.stage).alias("stage")).agg(F.count(F.lit(1)).alias("appearances"))


def stage_matrix(df: DataFrame, stages: Sequence[str], spec: ContestSpec = ContestSpec(),
                 prefix: str = "stage_") -> DataFrame:
    """Entity x stage appearance counts, 0 for none.

    The stage list is a parameter (no extra job to discover it); stages outside
    it are counted in ``<prefix>other``, so no entity and no appearance is lost.
    The pivot is a conditional aggregate: both sides and all stages cost one shuffle.
    """
    stage = F.col(spec.stage)
    lf = long_form(df, spec, keep=[spec.stage]).where(F.col("team").isNotNull() & stage.isNotNull())
    return lf.groupBy("team").agg(
        *[F.count_if(stage == s).alias(prefix + name) for s, name in zip(stages, _safe_names([*stages, "other"]))],
        F.count_if(~stage.isin(list(stages))).alias(prefix + _safe_names([*stages, "other"])[-1]))


def side_advantage(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Home win rate, away win rate and their difference, one row (A5)."""
    h, a = F.col(spec.home_score), F.col(spec.away_score)
    r = df.agg(
        F.avg(F.coalesce(h > a, F.lit(False)).cast("int")).alias("home_win_rate"),
        F.avg(F.coalesce(a > h, F.lit(False)).cast("int")).alias("away_win_rate"),
    )
    return r.select(
        F.bround("home_win_rate", ROUND).alias("home_win_rate"),
        F.bround("away_win_rate", ROUND).alias("away_win_rate"),
        F.bround(F.col("home_win_rate") - F.col("away_win_rate"), ROUND).alias("home_advantage_index"),
    )


def scored_contests(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Contests with both scores and a date, plus year/decade/total (A6-A9 input)."""
    return (df.where(F.col(spec.home_score).isNotNull() & F.col(spec.away_score).isNotNull()
                     & F.col(spec.date).isNotNull())
            .withColumns({"year": F.year(spec.date),
                          "total_goals": F.col(spec.home_score) + F.col(spec.away_score)})
            .withColumn("decade", decade_of("year")))


def goals_by_edition(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Per edition: mean, sum and count of total goals."""
    s = scored_contests(df, spec)
    return s.groupBy("year").agg(
        F.bround(F.avg("total_goals"), ROUND).alias("goals_per_match"),
        F.sum("total_goals").cast("long").alias("total_goals"),
        F.count("total_goals").alias("nb_matches"),
    )


def goals_by_decade(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Per decade: mean total, mean home, mean away, count."""
    s = scored_contests(df, spec)
    return s.groupBy("decade").agg(
        F.bround(F.avg("total_goals"), ROUND).alias("goals_per_match"),
        F.bround(F.avg(spec.home_score), ROUND).alias("home_goals"),
        F.bround(F.avg(spec.away_score), ROUND).alias("away_goals"),
        F.count("total_goals").alias("nb_matches"),
    )


def decade_lookup(by_decade: DataFrame, decades: Iterable[int]) -> DataFrame:
    """One decade's value or null when absent (A34), for each wanted decade."""
    # the wanted decades are a literal parameter list: built inside the JVM
    # and broadcast (its size is the length of that list)
    wanted = by_decade.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(int(d)) for d in decades])).alias("decade"))
    return F.broadcast(wanted).join(by_decade.select("decade", "goals_per_match"), "decade", "left")


def score_frequency(df: DataFrame, k: int | None = 10, spec: ContestSpec = ContestSpec(),
                    decades: Iterable[int] | None = None) -> DataFrame:
    """Score-line frequencies with an 'h - a' label, top k by count.

    Ties on the count are broken by the score itself (trap T6).
    """
    s = scored_contests(df, spec)
    if decades is not None:
        s = s.where(F.col("decade").isin(list(decades)))
    f = (s.groupBy(spec.home_score, spec.away_score).agg(F.count(F.lit(1)).alias("count"))
         .withColumn("score", score_label(spec.home_score, spec.away_score)))
    if k is None:
        return f
    return f.orderBy(F.desc("count"), F.asc(spec.home_score), F.asc(spec.away_score)).limit(k)


def histogram(df: DataFrame, value: str, bins: int = 15, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over [min, max] of ``value``, per ``by`` group.

    min and max are scalar subqueries (one small extra job each, no join).
    """
    bounds = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo = bounds.select(F.col("lo").cast("double")).scalar()
    hi = bounds.select(F.col("hi").cast("double")).scalar()
    width = F.when(hi > lo, (hi - lo) / bins).otherwise(F.lit(1.0))
    idx = F.least(F.floor((F.col(value).cast("double") - lo) / width), F.lit(bins - 1)).cast("int")
    h = (df.where(F.col(value).isNotNull()).withColumn("bin", idx)
         .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count")))
    return h.withColumn("bin_start", F.bround(lo + F.col("bin") * width, ROUND))


def rounded_histogram(df: DataFrame, value: str, max_bins: int = 15, by: Sequence[str] = (), whole: bool = True) -> DataFrame:
    """Histogram on a rounded grid, one grid for all groups.

    The step is the smallest of 1, 2, 5 times a power of ten with which the range of
    ``value`` needs at most ``max_bins`` bins; with ``whole`` it is no fraction, so whole
    numbers never share a bin by fractions. Bins start at multiples of the step.
    """
    bounds = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo = bounds.select(F.col("lo").cast("double")).scalar()
    hi = bounds.select(F.col("hi").cast("double")).scalar()
    ten = F.pow(F.lit(10.0), F.floor(F.log10(F.greatest((hi - lo) / max_bins, F.lit(1e-300)))) - 1)
    steps = [ten * (m * 10 ** k) for k in range(4) for m in (1, 2, 5)]
    fits = [F.when((F.floor(hi / w) - F.floor(lo / w) + 1 <= max_bins) & (F.lit(not whole) | (w >= 1)), w) for w in steps]
    step = F.when(hi > lo, F.coalesce(*fits)).otherwise(F.lit(1.0))
    if whole:
        step = F.greatest(step, F.lit(1.0))
    place = df.where(F.col(value).isNotNull()).withColumn("step", step)
    h = (place.withColumn("bin_start", F.floor(F.col(value).cast("double") / F.col("step")) * F.col("step"))
         .groupBy(*by, "step", "bin_start").agg(F.count(F.lit(1)).alias("count")))
    return h.withColumns({"bin_start": F.bround("bin_start", ROUND), "step": F.bround("step", ROUND)})


def overview_kpis(df: DataFrame, spec: ContestSpec = ContestSpec()) -> DataFrame:
    """Rows, distinct home entities, distinct editions, mean total goals."""
    return df.agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.countDistinct(spec.home).alias("total_teams"),
        F.countDistinct(F.year(spec.date)).alias("total_editions"),
        round_half_even(F.avg(total_score(spec.home_score, spec.away_score, zero_fill=True)), 2)
        .alias("avg_goals"),
    )


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column | str],
               payload: Sequence[str] | None = None) -> DataFrame:
    """Keep-first de-duplication on ``key``.

    Expressed as ``min(struct(order..., payload...))`` per key. The struct is
    no fixed-width value, so Spark plans a sort aggregate: each task sorts its
    own rows by key and reduces them to one per key before the shuffle, and a
    key repeated in a third of all rows sends one row per task (a row_number
    window would gather and sort the whole hot key in one task). ``order`` must
    end with enough columns to make the choice deterministic.
    """
    payload = [c for c in (payload or df.columns) if c not in key]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order_cols)],
                      *[F.col(f"`{p}`").alias(p) for p in payload])
    best = df.groupBy(*key).agg(F.min(packed).alias("__best"))
    return best.select(*key, *[F.col("__best")[p].alias(p) for p in payload])


def unify_sources(first: DataFrame, second: DataFrame, key: Sequence[str],
                  tie: Sequence[str]) -> DataFrame:
    """Union of two contest sources with different columns (missing -> null),
    then keep-first on ``key`` with the first source winning (U1, W6, T23)."""
    u = (first.withColumn("__src", F.lit(1))
         .unionByName(second.withColumn("__src", F.lit(2)), allowMissingColumns=True))
    out = keep_first(u, key, ["__src", *tie])
    return out.drop("__src")
