"""Order-dependent operators.

The reference folds rows per entity in edition order with a Python loop and a
state dict. Here the same fold is a set of window expressions sharing one
(entity, edition) sort: ``rowsBetween(unboundedPreceding, -1)`` gives the
values strictly *before* the current edition, so no row sees its own outcome
(no leakage). Each window partition holds one entity's editions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arenaspark.constants import EDITION_GAP, EDITION_GAP_EXCEPTIONS
from arenaspark.functions.exprs import outcome_targets, round_half_even, yes_no_flag
from arenaspark.operators.clean import parse_numbers
from arenaspark.session import shared_table
from arenaspark.specs import PanelSpec


def streak_columns(df: DataFrame, entity: str, edition: str, gap: int = EDITION_GAP,
                   exceptions: Sequence[tuple[int, int]] = tuple(EDITION_GAP_EXCEPTIONS)) -> DataFrame:
    """Consecutive-edition streak (W4) by gaps-and-islands, emitted lagged.

    break = first row, or gap > ``gap`` and (previous, current) not a declared
    exception (T14); island = running sum of breaks; streak = position in the
    island; the emitted value is the *previous* row's streak, 0 on the first
    row, and is not reset for the current gap (T13).
    """
    w = Window.partitionBy(entity).orderBy(edition)
    prev = F.lag(edition).over(w)
    ok = (F.col(edition) - prev) <= gap
    for before, after in exceptions:
        ok = ok | ((F.col(edition) == after) & (prev == before))
    out = df.withColumn("__break", F.when(prev.isNull(), 1).when(ok, 0).otherwise(1))
    out = out.withColumn("__island", F.sum("__break").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    wi = Window.partitionBy(entity, "__island").orderBy(edition)
    out = out.withColumn("streak", F.row_number().over(wi))
    out = out.withColumn("consecutive_wc_appearances",
                         F.coalesce(F.lag("streak").over(w), F.lit(0)).cast("int"))
    return out.drop("__break", "__island")


def pre_event_features(panel: DataFrame, spec: PanelSpec = PanelSpec(), null_policy: str = "poison",
                       gap: int = EDITION_GAP,
                       exceptions: Sequence[tuple[int, int]] = tuple(EDITION_GAP_EXCEPTIONS),
                       strength: str | None = None, host_words: Sequence[str] = ("yes",)) -> DataFrame:
    """Leakage-free pre-edition features and outcome targets.

    ``null_policy``:
      * ``"poison"`` -- one missing value makes every later running total
        missing, and a missing total gives rates of 0.0, as the fold being
        reproduced does (trap T1);
      * ``"skip"`` -- missing values are ignored by the running sums.
    Rates are rounded half-even to 3 places (T9). Rows without an edition are
    dropped first; text that is no number counts as missing, and so do the host,
    group and strength columns when the panel has none.
    """
    if null_policy not in ("poison", "skip"):
        raise ValueError("null_policy must be 'poison' or 'skip'")
    e, t = spec.entity, spec.edition
    strength = strength or spec.strength
    df = parse_numbers(panel, {t: "int", spec.played: "double", spec.wins: "double", spec.goals_for: "double",
                               spec.goals_against: "double", strength: "double"}).where(F.col(t).isNotNull())
    # columns that a source may lack: nothing known
    df = df.withColumns({c: F.lit(None).cast(kind) for c, kind in
                         ((spec.host, "string"), (spec.group, "string"), (strength, "double")) if c not in df.columns})
    tg = outcome_targets(spec.stage)
    df = df.withColumns({
        "target_champion": tg["target_champion"], "target_top4": tg["target_top4"],
        "target_top8": tg["target_top8"],
        "__played": F.col(spec.played).cast("double"), "__wins": F.col(spec.wins).cast("double"),
        "__gf": F.col(spec.goals_for).cast("double"), "__ga": F.col(spec.goals_against).cast("double"),
    })
    w = Window.partitionBy(e).orderBy(t)
    pre = w.rowsBetween(Window.unboundedPreceding, -1)

    def prior(c):
        s = F.coalesce(F.sum(c).over(pre), F.lit(0.0))
        if null_policy == "skip":
            return s
        poisoned = F.coalesce(F.max(F.col(c).isNull().cast("int")).over(pre), F.lit(0)) == 1
        return F.when(poisoned, F.lit(None).cast("double")).otherwise(s)

    df = df.withColumns({
        "wc_appearances": (F.row_number().over(w) - 1).cast("int"),
        "wc_titles": F.coalesce(F.sum("target_champion").over(pre), F.lit(0)).cast("int"),
        "__p_played": prior("__played"), "__p_wins": prior("__wins"),
        "__p_gf": prior("__gf"), "__p_ga": prior("__ga"),
    })

    def rate(num):
        # played > 0 is null when poisoned -> 0.0; a poisoned numerator alone stays null
        return round_half_even(F.when(F.col("__p_played") > 0, F.col(num) / F.col("__p_played"))
                               .otherwise(F.lit(0.0)), 3)

    df = df.withColumns({
        "is_debut": (F.col("wc_appearances") == 0).cast("int"),
        "win_rate_before": rate("__p_wins"),
        "goals_scored_per_match_before": rate("__p_gf"),
        "goals_conceded_per_match_before": rate("__p_ga"),
        "elo_rating": F.col(strength).cast("double"),
        "host_nation_flag": yes_no_flag(spec.host, host_words),
    })
    df = streak_columns(df, e, t, gap, exceptions)
    return df.select(
        F.col(e).alias("team"), F.col(spec.group).alias("confederation"), F.col(t).alias("wc_year"),
        "wc_appearances", "wc_titles", "elo_rating", F.col("host_nation_flag").alias("host_nation"),
        "consecutive_wc_appearances", "is_debut", "win_rate_before",
        "goals_scored_per_match_before", "goals_conceded_per_match_before",
        "target_champion", "target_top4", "target_top8",
    )


def dense_keys(df: DataFrame, order: Sequence[str], key_name: str,
               partitions: int | None = None) -> DataFrame:
    """Surrogate keys 1..n in natural-key order, computed in parallel.

    ``row_number()`` over a global ``orderBy`` would pull every row into one
    task. Instead: range-partition on the natural key, sort inside each
    partition, take the position inside the partition from
    ``monotonically_increasing_id``, and write the rows with partition and
    position to a shared table. Row counts per partition come from that table,
    so rows and counts agree whatever the columns; the counts of all earlier
    partitions (one row per partition, broadcast) are added.
    ``order`` must be unique per row.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = [F.col(c) for c in order]
    s = (df.repartitionByRange(n, *o).sortWithinPartitions(*o)
         .withColumn("__pid", F.spark_partition_id()))
    s = s.withColumn("__local", F.monotonically_increasing_id()
                     - F.shiftleft(F.col("__pid").cast("long"), 33) + 1)
    s = shared_table(s, "dense-keys")
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__offset",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    # one row per partition: bounded by ``n``, safe to broadcast
    j = s.join(F.broadcast(offsets.select("__pid", "__offset")), "__pid")
    return j.withColumn(key_name, (F.col("__offset") + F.col("__local")).cast("long")) \
        .drop("__pid", "__local", "__offset")
