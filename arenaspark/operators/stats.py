"""Statistics and ranking operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUND = 6


def top_k(df: DataFrame, metric: str, k: int = 10, ascending: bool = False,
          tie: Sequence[str] = ()) -> DataFrame:
    """nlargest / nsmallest with a deterministic tie key.

    ``orderBy(...).limit(k)`` is planned as TakeOrderedAndProject: each task
    keeps its own k best, only those reach the final merge.
    """
    order = [F.asc_nulls_last(metric) if ascending else F.desc_nulls_last(metric)]
    order += [F.asc(t) for t in tie]
    return df.where(F.col(metric).isNotNull()).orderBy(*order).limit(k)


# Direction per metric: lower is better only for goals conceded (L3).
LOWER_IS_BETTER = {"conceded_per_match"}


def metric_top(df: DataFrame, metric: str, k: int = 10, tie: Sequence[str] = ("team",)) -> DataFrame:
    """Top k by a chosen metric, direction chosen by the metric (L3)."""
    return top_k(df, metric, k, ascending=metric in LOWER_IS_BETTER, tie=tie)


def arg_best(value: str, label: str, lowest: bool = False, tie: str | None = None) -> Column:
    """Label of the row with the max (or min) value; ties -> smallest tie key.

    ``max_by``/``min_by`` over a struct key are ordinary aggregates, so they
    combine map-side like sum and count.
    """
    tie = tie or label
    v = F.col(value).cast("double")
    key = v if lowest else -v
    # nulls never win: (is_null, key, tie) orders non-null values first
    return F.min_by(F.col(label), F.struct(v.isNull(), key, F.col(tie)))


def safe_corr(x, y) -> Column:
    """Pearson correlation, null where either side does not vary (``corr`` would divide by zero)."""
    x, y = (F.col(c).cast("double") if isinstance(c, str) else c.cast("double") for c in (x, y))
    # complete pairs only, as corr does
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    sx, sy = F.stddev_pop(x), F.stddev_pop(y)
    return F.when((sx > 0) & (sy > 0), F.covar_pop(x, y) / (sx * sy))


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation of two columns over complete rows."""
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .agg(F.bround(safe_corr(x, y), ROUND).alias("corr")))


def correlation_matrix(df: DataFrame, columns: Sequence[str], min_rows: int = 3) -> DataFrame:
    """All pairwise correlations over complete rows, long form.

    One ``agg`` computes every pair in a single pass; ``stack`` turns the one
    result row into (col_a, col_b, corr) rows. Empty when rows <= min_rows.
    """
    complete = df.where(F.lit(True) if not columns else
                        F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in columns)))
    names = list(columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, a in enumerate(names):  # the matrix is symmetric: one aggregate per unordered pair
        for j, b in enumerate(names[i:], i):
            if i == j:
                e = F.when(F.stddev_pop(F.col(a).cast("double")) > 0, F.lit(1.0))
            else:
                e = safe_corr(a, b)
            aggs.append(F.bround(e, ROUND).alias(f"__c{i}_{j}"))
    one = complete.agg(*aggs)
    cells = [f"'{a}', '{b}', __c{min(i, j)}_{max(i, j)}" for i, a in enumerate(names) for j, b in enumerate(names)]
    stack = f"stack({len(cells)}, {', '.join(cells)}) as (col_a, col_b, corr)"
    return one.where(F.col("__n") > min_rows).selectExpr(stack)


def linear_trend(df: DataFrame, x: str, y: str, min_points: int = 5) -> DataFrame:
    """Degree-1 least squares y = slope * x + intercept, when more than
    ``min_points`` complete points exist (A21)."""
    c = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    r = c.agg(F.regr_slope(yd, xd).alias("slope"), F.regr_intercept(yd, xd).alias("intercept"),
              F.regr_count(yd, xd).alias("points"), F.min(xd).alias("x_min"), F.max(xd).alias("x_max"))
    return r.where(F.col("points") > min_points)


def trend_line(df: DataFrame, x: str, y: str, n: int = 100, min_points: int = 5) -> DataFrame:
    """The fitted line sampled at n evenly spaced x between min and max."""
    t = linear_trend(df, x, y, min_points)
    step = F.when(F.col("x_max") > F.col("x_min"), (F.col("x_max") - F.col("x_min")) / (n - 1)).otherwise(F.lit(0.0))
    g = t.select("slope", "intercept", "x_min", step.alias("step"),
                 F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    xv = F.col("x_min") + F.col("i") * F.col("step")
    return g.select("i", F.bround(xv, ROUND).alias("x"),
                    F.bround(F.col("slope") * xv + F.col("intercept"), ROUND).alias("y"))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """min and max of a column, for filter bounds."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def mode_in_top(df: DataFrame, order_metric: str, category: str, k: int = 10,
                tie: Sequence[str] = ()) -> DataFrame:
    """Most frequent category among the top k rows and its count."""
    top = top_k(df, order_metric, k, tie=tie)
    counts = top.groupBy(category).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(category)).limit(1)
