"""Cleaning operators."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaspark.functions.exprs import harmonise, normalise_text
from arenaspark.sources.io import coerce, first_date_form, parse_date_as, parse_number


def lower_headers(df: DataFrame) -> DataFrame:
    """All column names lower-cased."""
    return df.toDF(*[c.lower() for c in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that exist; others are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def harmonise_columns(df: DataFrame, columns: Iterable[str], aliases: dict | None = None) -> DataFrame:
    """Apply the alias table to each listed column that exists."""
    cols = {c: harmonise(c, aliases) for c in columns if c in df.columns}
    return df.withColumns(cols) if cols else df


def harmonise_with_table(df: DataFrame, column: str, alias_df: DataFrame,
                         old: str = "old_name", new: str = "new_name") -> DataFrame:
    """P3 with an alias *table* (for alias lists too large for a literal map).

    Left join on the name; the alias side is de-duplicated on its key first so
    the join can never fan out. Strategy (broadcast or shuffle) is left to AQE.
    """
    a = (alias_df.groupBy(old).agg(F.min(new).alias("__canon"))
         .withColumnRenamed(old, "__alias"))
    j = df.join(a, df[column] == a["__alias"], "left")
    return j.withColumn(column, F.coalesce(F.col("__canon"), F.col(column))).drop("__alias", "__canon")


def normalise_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """lower(trim(x)) on each listed column that exists."""
    cols = {c: normalise_text(c) for c in columns if c in df.columns}
    return df.withColumns(cols) if cols else df


def parse_dates(df: DataFrame, columns: Iterable[str], order_column: str | None = None) -> DataFrame:
    """Coerced date parse, bad values -> null (P5).

    With ``order_column`` (a row's place in its source) a text column is read as
    a whole: the first value that is there gives the form, and values of another
    form are null. Without it every value is read by the first form it fits.
    """
    cols = {}
    for c in columns:
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.DateType):
            continue
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            cols[c] = F.to_date(F.col(c))
        elif order_column:
            text = F.col(c).cast("string")
            # one number per column: the form of the first value
            form = df.where(F.col(c).isNotNull()).agg(F.min_by(first_date_form(text), F.col(order_column))).scalar()
            cols[c] = parse_date_as(text, form)
        else:
            cols[c] = coerce(F.col(c).cast("string"), T.DateType())
    return df.withColumns(cols) if cols else df


def parse_numbers(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Coerced numeric parse, bad values -> null."""
    cols = {}
    for c, t in columns.items():
        if c not in df.columns:
            continue
        kind = df.schema[c].dataType
        if kind.simpleString() == t:
            if t in ("double", "float"):
                cols[c] = F.when(~F.isnan(c), F.col(c))
        elif isinstance(kind, T.IntegralType) and t in ("int", "bigint", "double"):
            cols[c] = F.col(c).try_cast(t)
        else:
            cols[c] = parse_number(F.col(c).cast("string"), t)
    return df.withColumns(cols) if cols else df


def clean_rows(df: DataFrame, order_column: str | None = None) -> DataFrame:
    """Full-row de-duplication, then drop rows that are entirely null.

    An aggregate with map-side combine, so heavily repeated rows collapse
    before the shuffle. Of equal rows ``order_column`` (which does not count as
    content) keeps the smallest value.
    """
    if order_column is None:
        return df.distinct().na.drop(how="all")
    own = [c for c in df.columns if c != order_column]
    return df.groupBy(*own).agg(F.min(order_column).alias(order_column)).na.drop(how="all", subset=own)


def drop_incomplete(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """Drop rows with a null in any listed column."""
    sub = [c for c in subset if c in df.columns]
    return df.na.drop(subset=sub) if sub else df


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    """Presence guard before a query (P28): fail early with a clear message."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns {missing}; has {df.columns}")
    return df


def select_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])
