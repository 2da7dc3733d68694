"""Column expressions (P3-P17, P23-P26): all built-in, all inside codegen."""

from __future__ import annotations

from itertools import chain
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from arenaspark.constants import (
    CHAMPION_STAGES, ENTITY_ALIASES, STAGE_ORDER, TOP4_STAGES, TOP8_EXTRA_STAGES, TRUTHY_WORDS,
)

__all__ = [
    "col_of", "literal_map", "harmonise", "normalise_text", "safe_ratio", "result_code",
    "goal_diff", "total_score", "decade_of", "truthy", "stage_score", "outcome_targets",
    "clip_lower", "round_half_even", "percent_text", "score_label", "decade_label", "two_label",
    "yes_no_flag",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: dict) -> Column:
    """A small literal MapType (fixed lookup tables only)."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def harmonise(c, aliases: dict | None = None) -> Column:
    """Replace known alias names by the canonical one (P3); unknown names stay."""
    c = col_of(c)
    aliases = ENTITY_ALIASES if aliases is None else aliases
    if not aliases:
        return c
    return F.coalesce(literal_map(aliases)[c], c)


def normalise_text(c) -> Column:
    """lower(trim(x)); null stays null (P4, trap T5)."""
    return F.lower(F.trim(col_of(c)))


def safe_ratio(num, den, default: float = 0.0) -> Column:
    """num / den when den > 0, else ``default`` (P10; ANSI-safe)."""
    num, den = col_of(num), col_of(den)
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(default).cast("double"))


def result_code(home_score, away_score) -> Column:
    """'H' / 'A' / 'D'; a missing score falls to 'D' (P9, trap T4)."""
    h, a = col_of(home_score), col_of(away_score)
    return F.when(h > a, "H").when(h < a, "A").otherwise("D")


def goal_diff(home_score, away_score) -> Column:
    return col_of(home_score) - col_of(away_score)


def total_score(home_score, away_score, zero_fill: bool = False) -> Column:
    """home + away (P12): null-propagating, or zero-filled."""
    h, a = col_of(home_score), col_of(away_score)
    if zero_fill:
        return F.coalesce(h, F.lit(0)) + F.coalesce(a, F.lit(0))
    return h + a


def decade_of(year) -> Column:
    """floor(year / 10) * 10 as int."""
    return (F.floor(col_of(year) / 10) * 10).cast("int")


def truthy(c, words: Iterable[str] = TRUTHY_WORDS) -> Column:
    """Text flag -> boolean after trim + lower; null -> false."""
    return F.coalesce(F.lower(F.trim(col_of(c).cast("string"))).isin(list(words)), F.lit(False))


def yes_no_flag(c, words: Iterable[str] = ("yes",)) -> Column:
    """0/1 indicator of a truthy text (strict form used by the feature step)."""
    return truthy(c, words).cast("int")


def stage_score(c, order: list[str] = STAGE_ORDER) -> Column:
    """Ordinal stage score on the scale, unknown or null -> 0."""
    scale = {name: i for i, name in enumerate(order)}
    return F.coalesce(literal_map(scale)[normalise_text(c)], F.lit(0))


def outcome_targets(stage) -> dict[str, Column]:
    """Champion / top-4 / top-8 indicators; top-8 contains top-4."""
    s = F.coalesce(F.lower(col_of(stage)), F.lit(""))
    champion = s.isin(CHAMPION_STAGES).cast("int")
    top4 = s.isin(TOP4_STAGES).cast("int")
    top8 = F.greatest(s.isin(TOP8_EXTRA_STAGES).cast("int"), top4)
    return {"target_champion": champion, "target_top4": top4, "target_top8": top8}


def clip_lower(c, lo: float) -> Column:
    """max(x, lo)."""
    return F.greatest(col_of(c), F.lit(lo))


_SPLITTER = 134217729.0  # 2^27 + 1: splits a double into two halves whose products are exact


def _halves(x):
    big = x * _SPLITTER
    high = big - (big - x)
    return high, x - high


def round_half_even(c, digits: int) -> Column:
    """Correctly rounded to ``digits`` decimals, ties to even, as Python's round.

    Decided on the binary value: x * 10^digits is taken as a rounded product and
    its exact error (both factors split in halves), so 0.0125, which lies above
    its decimal, becomes 0.013 and 0.0625, a true tie, 0.062. Values too large
    to have that many decimals, infinities and NaN stay.
    """
    if not 0 <= digits <= 15:
        raise ValueError("0 to 15 decimals")
    x, scale = col_of(c).cast("double"), 10.0 ** digits
    product = x * scale
    (xh, xl), (sh, sl) = _halves(x), _halves(scale)
    error = ((xh * sh - product) + xh * sl + xl * sh) + xl * sl
    low = F.floor(product).cast("double")
    part = product - low
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (F.pmod(low, F.lit(2.0)) == 1))))
    return F.when(F.abs(product) < 2.0 ** 52, (low + F.when(up, 1.0).otherwise(0.0)) / scale).otherwise(x)


def percent_text(c, digits: int = 1) -> Column:
    """'12.5%' of a share, correctly rounded (P25)."""
    return F.format_string(f"%.{digits}f%%", round_half_even(col_of(c).cast("double") * 100, digits))


def score_label(home_score, away_score) -> Column:
    """'h - a' (P25)."""
    return F.concat(col_of(home_score).cast("long").cast("string"), F.lit(" - "),
                    col_of(away_score).cast("long").cast("string"))


def decade_label(decade) -> Column:
    """'1990s' (P25)."""
    return F.concat(col_of(decade).cast("string"), F.lit("s"))


def two_label(flag, when_true: str, when_false: str) -> Column:
    """Boolean -> one of two labels."""
    return F.when(col_of(flag), F.lit(when_true)).otherwise(F.lit(when_false))
