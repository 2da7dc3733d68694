"""Column bindings: operators are written against these, never against names."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ContestSpec:
    """One row per contest between a home and an away entity."""

    home: str = "home_team"
    away: str = "away_team"
    home_score: str = "home_score"
    away_score: str = "away_score"
    date: str = "date"
    stage: str = "stage"
    venue: str = "stadium"
    city: str = "city"


@dataclass(frozen=True)
class PanelSpec:
    """One row per entity per edition."""

    entity: str = "team"
    edition: str = "wc_year"
    group: str = "confederation"
    stage: str = "final_stage_reached"
    played: str = "matches_played"
    wins: str = "wins"
    draws: str = "draws"
    losses: str = "losses"
    goals_for: str = "goals_scored"
    goals_against: str = "goals_conceded"
    host: str = "host_nation"
    strength: str = "elo_rating_approx"


@dataclass(frozen=True)
class ProfileSpec:
    """One all-time row per entity."""

    entity: str = "team"
    group: str = "confederation"
    appearances: str = "total_wc_appearances"
    matches: str = "total_matches"
    wins: str = "total_wins"
    goals_for: str = "total_goals_scored"
    goals_against: str = "total_goals_conceded"
    win_rate: str = "win_rate"
    titles: str = "titles"
    finals: str = "finals_reached"
    semis: str = "semis_reached"
    quarters: str = "quarters_reached"
    extra: tuple = field(default_factory=tuple)
