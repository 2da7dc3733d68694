"""DuckDB SQL for every registered query that SQL can express.

The same views as ``bindings`` are written once as CTEs; each query text is
``WITH <the views it needs> <its body>``. Ratios and means are rounded
half-even to the same number of places as the Spark side.
"""

from __future__ import annotations

from arenaspark.constants import ENTITY_ALIASES, MODEL_FEATURES, STAGE_ORDER
from arenaspark.plans import bindings as B
from arenaspark.plans import queries as Q

R6 = "round_even({}, 6)"


def _case_stage_score(col: str) -> str:
    arms = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(STAGE_ORDER))
    return f"COALESCE(CASE lower(trim({col})) {arms} END, 0)"


def _alias_case(col: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ENTITY_ALIASES.items())
    return f"(CASE {col} {arms} ELSE {col} END)"


_OLD_NAMES = "[" + ", ".join(f"'{n}'" for n in Q.ALIAS_NAMES) + "]"


def _panel_stage_case() -> str:
    arms = " ".join(f"WHEN pos >= {lo}{'' if hi is None else f' AND pos <= {hi}'} THEN '{name}'"
                    for lo, hi, name in B.PANEL_STAGES)
    return f"CASE {arms} END"


CUST_STAGE_LIST = "[" + ", ".join(f"'{s}'" for s in B.CUST_STAGES) + "]"

VIEWS = {
    "contests_v": """
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_no, l.l_partkey AS part_key,
         l.l_suppkey AS supp_key, l.l_quantity AS qty, l.l_extendedprice AS price,
         s.s_nationkey AS home_key, c.c_nationkey AS away_key,
         hn.n_name AS home_team, an.n_name AS away_team,
         CAST(l.l_quantity AS INTEGER) % 6 AS home_score, l.l_linenumber % 4 AS away_score,
         CAST(o.o_orderdate AS DATE) AS date, lower(o.o_orderpriority) AS stage,
         lower(p.p_brand) AS stadium, lower(r.r_name) AS city,
         o.o_orderpriority AS raw_stage, p.p_brand AS raw_stadium, r.r_name AS raw_city
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation an ON c.c_nationkey = an.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation hn ON s.s_nationkey = hn.n_nationkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN region r ON hn.n_regionkey = r.r_regionkey""",
    "contests_b_v": """
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_no, l.l_partkey AS part_key,
         l.l_suppkey AS supp_key, l.l_quantity AS qty, l.l_extendedprice AS price,
         cn.n_name AS home_team, sn.n_name AS away_team,
         l.l_linenumber % 4 AS home_goals, CAST(l.l_quantity AS INTEGER) % 6 AS away_goals,
         CAST(o.o_orderdate AS DATE) AS date, lower(o.o_orderpriority) AS stage,
         CAST(year(o.o_orderdate) AS INTEGER) AS wc_year, 'returned' AS result_type
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  WHERE l.l_returnflag = 'R'""",
    "lf": """
  SELECT home_team AS team, 'home' AS side, home_score AS gf, away_score AS ga, stage FROM contests_v
  UNION ALL
  SELECT away_team AS team, 'away' AS side, away_score AS gf, home_score AS ga, stage FROM contests_v""",
    "panel_rec": """
  SELECT wc_year, k, count(*) AS matches_played, count_if(gf > ga) AS wins,
         count_if(gf = ga) AS draws, count_if(gf < ga) AS losses,
         CAST(sum(gf) AS BIGINT) AS goals_scored, CAST(sum(ga) AS BIGINT) AS goals_conceded
  FROM (SELECT CAST(year(date) AS INTEGER) AS wc_year, home_key AS k, home_score AS gf, away_score AS ga FROM contests_v
        UNION ALL
        SELECT CAST(year(date) AS INTEGER), away_key, away_score, home_score FROM contests_v)
  GROUP BY wc_year, k""",
    "panel_v": f"""
  SELECT n.n_name AS team, r.r_name AS confederation, p.wc_year,
         {_panel_stage_case()} AS final_stage_reached,
         matches_played, wins, draws, losses, goals_scored, goals_conceded,
         goals_scored - goals_conceded AS goal_difference,
         CASE WHEN k = (p.wc_year * 7) % 25 THEN 'Yes' ELSE 'No' END AS host_nation,
         1400 + (k * 37 + p.wc_year * 11) % 600 AS elo_rating_approx, k AS nation_key
  FROM (SELECT *, row_number() OVER (PARTITION BY wc_year
                 ORDER BY (k * 7 + wc_year * 11 + wins) % 101 DESC, k) AS pos FROM panel_rec) p
  LEFT JOIN nation n ON p.k = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "panel_e": f"""
  SELECT *, CAST(floor(wc_year / 10) * 10 AS INTEGER) AS decade,
         COALESCE(lower(trim(host_nation)) IN ('true', 'yes', '1', 'oui'), false) AS is_host,
         CASE WHEN matches_played > 0 THEN wins / matches_played ELSE 0.0 END AS win_rate,
         lower(trim(final_stage_reached)) AS phase_lower,
         {_case_stage_score('final_stage_reached')} AS phase_score,
         TRY_CAST(CAST(elo_rating_approx AS VARCHAR) AS DOUBLE) AS strength
  FROM panel_v""",
    "profile_v": """
  SELECT *, total_goals_scored - total_goals_conceded AS goal_difference,
         round_even(CASE WHEN total_matches > 0 THEN total_wins / total_matches ELSE 0.0 END, 6) AS win_rate
  FROM (SELECT team, confederation, count(*) AS total_wc_appearances,
          CAST(sum(matches_played) AS BIGINT) AS total_matches, CAST(sum(wins) AS BIGINT) AS total_wins,
          CAST(sum(draws) AS BIGINT) AS total_draws, CAST(sum(losses) AS BIGINT) AS total_losses,
          CAST(sum(goals_scored) AS BIGINT) AS total_goals_scored,
          CAST(sum(goals_conceded) AS BIGINT) AS total_goals_conceded,
          count_if(final_stage_reached = 'Winner') AS titles,
          count_if(final_stage_reached IN ('Winner', 'Runner-up')) AS finals_reached,
          count_if(final_stage_reached IN ('Winner', 'Runner-up', 'Third place', 'Fourth place')) AS semis_reached,
          count_if(final_stage_reached IN ('Winner', 'Runner-up', 'Third place', 'Fourth place', 'Quarter-finals')) AS quarters_reached,
          min(wc_year) AS first_wc_year, max(wc_year) AS last_wc_year,
          count_if(host_nation = 'Yes') AS host_times
        FROM panel_v GROUP BY team, confederation)""",
    "profile_r": """
  SELECT *, round_even(CASE WHEN total_matches > 0 THEN total_goals_scored / total_matches ELSE 0.0 END, 6) AS goals_per_match,
         round_even(CASE WHEN total_matches > 0 THEN total_goals_conceded / total_matches ELSE 0.0 END, 6) AS conceded_per_match
  FROM profile_v""",
    "editions_v": """
  SELECT y.wc_year AS year, n.n_name AS host_country, y.winner, y.teams
  FROM (SELECT wc_year, max(CASE WHEN final_stage_reached = 'Winner' THEN team END) AS winner,
               count(*) AS teams FROM panel_v GROUP BY wc_year) y
  LEFT JOIN nation n ON (y.wc_year * 7) % 25 = n.n_nationkey""",
    "ranking_v": f"""
  SELECT team, CAST(row_number() OVER (ORDER BY points DESC, team) AS INTEGER) AS rank, points
  FROM (SELECT CASE WHEN n.n_nationkey % {B.RANKING_SPELLING[0]} = {B.RANKING_SPELLING[1]}
                    THEN '{B.RANKING_SPELLING[2]}' || n.n_name ELSE n.n_name END AS team, g.points
        FROM (SELECT s_nationkey, sum(CAST(round(s_acctbal * 100) AS BIGINT)) AS points
              FROM supplier GROUP BY s_nationkey) g
        JOIN nation n ON g.s_nationkey = n.n_nationkey)""",
    "factor_v": """
  SELECT p.*, rk.ranking FROM profile_r p
  LEFT JOIN (SELECT team, min(rank) AS ranking FROM ranking_v GROUP BY team) rk ON p.team = rk.team""",
    "cust_rec": """
  SELECT o_custkey AS custkey, CAST(year(o_orderdate) AS INTEGER) AS wc_year, count(*) AS n,
         count_if(o_orderstatus = 'F') AS f, count_if(o_orderstatus = 'O') AS op,
         CAST(sum(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS BIGINT) AS prio
  FROM orders GROUP BY 1, 2""",
    "cust_panel_v": f"""
  SELECT c.c_name AS team, r.r_name AS confederation, x.wc_year,
         CASE WHEN f + op > 0 THEN {CUST_STAGE_LIST}[CAST((f * 3 + prio + x.wc_year) % 8 + 1 AS INTEGER)] END AS final_stage_reached,
         CASE WHEN f + op > 0 THEN n END AS matches_played,
         CASE WHEN f + op > 0 THEN f END AS wins,
         CASE WHEN f + op > 0 THEN n - f - op END AS draws,
         CASE WHEN f + op > 0 THEN op END AS losses,
         CASE WHEN f + op > 0 THEN prio END AS goals_scored,
         CASE WHEN f + op > 0 THEN op END AS goals_conceded,
         CASE WHEN c.c_nationkey = (x.wc_year * 7) % 25 THEN 'Yes' ELSE 'No' END AS host_nation,
         1400 + (x.custkey * 37 + x.wc_year * 11) % 600 AS elo_rating_approx
  FROM cust_rec x JOIN customer c ON x.custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
}

VIEWS["cust_profile_v"] = VIEWS["profile_v"].replace("FROM panel_v", "FROM cust_panel_v")

# Dependencies between views, so a query lists only what it reads directly.
DEPS = {
    "lf": ["contests_v"], "panel_rec": ["contests_v"], "panel_v": ["panel_rec"],
    "panel_e": ["panel_v"], "profile_v": ["panel_v"], "profile_r": ["profile_v"],
    "editions_v": ["panel_v"], "factor_v": ["profile_r", "ranking_v"], "cust_panel_v": ["cust_rec"],
    "cust_profile_v": ["cust_panel_v"],
}


def _expand(names):
    out: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in out:
            out.append(n)
    for n in names:
        add(n)
    return out


def sql(uses: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    """``WITH <views used, in dependency order>, <extra CTEs> <body>``."""
    parts = [f"{v} AS ({VIEWS[v]}\n)" for v in _expand(uses)]
    parts += [f"{name} AS ({text}\n)" for name, text in extra]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def _stage_cols() -> str:
    return ",\n  ".join(
        f"count_if(stage = '{s}') AS stage_{''.join(ch if ch.isalnum() else '_' for ch in s).strip('_')}"
        for s in Q.STAGES) + f",\n  count_if(stage NOT IN ({_STAGE_LIST})) AS stage_other"


_STAGE_LIST = ", ".join(f"'{s}'" for s in Q.STAGES)


_TEAM_STATS_BODY = """
SELECT *, goals_scored - goals_conceded AS goal_diff,
  round_even(CASE WHEN games_played > 0 THEN goals_scored / games_played ELSE 0.0 END, 6) AS goals_per_game,
  round_even(CASE WHEN games_played > 0 THEN goals_conceded / games_played ELSE 0.0 END, 6) AS conceded_per_game
FROM (SELECT *, goals_scored_home + goals_scored_away AS goals_scored,
        goals_conceded_home + goals_conceded_away AS goals_conceded,
        home_games + away_games AS games_played
  FROM (SELECT team,
      CAST(COALESCE(sum(CASE WHEN side = 'home' THEN gf END), 0) AS BIGINT) AS goals_scored_home,
      count(CASE WHEN side = 'home' THEN gf END) AS home_games,
      CAST(COALESCE(sum(CASE WHEN side = 'home' THEN ga END), 0) AS BIGINT) AS goals_conceded_home,
      CAST(COALESCE(sum(CASE WHEN side = 'away' THEN gf END), 0) AS BIGINT) AS goals_scored_away,
      count(CASE WHEN side = 'away' THEN gf END) AS away_games,
      CAST(COALESCE(sum(CASE WHEN side = 'away' THEN ga END), 0) AS BIGINT) AS goals_conceded_away
    FROM lf WHERE team IS NOT NULL GROUP BY team))"""

_WIN_RATE_BODY = """
SELECT team, round_even(CASE WHEN total_games > 0 THEN total_wins / total_games ELSE 0.0 END, 6) AS win_rate,
       total_wins, total_games
FROM (SELECT team, count_if(gf > ga) AS total_wins, count(*) AS total_games
      FROM lf WHERE team IS NOT NULL GROUP BY team)"""

_SCORED = """(SELECT *, CAST(year(date) AS INTEGER) AS year, home_score + away_score AS total_goals,
   CAST(floor(year(date) / 10) * 10 AS INTEGER) AS decade
 FROM contests_v WHERE home_score IS NOT NULL AND away_score IS NOT NULL AND date IS NOT NULL)"""

_BY_DECADE = f"""(SELECT decade, round_even(avg(total_goals), 6) AS goals_per_match,
   round_even(avg(home_score), 6) AS home_goals, round_even(avg(away_score), 6) AS away_goals,
   count(total_goals) AS nb_matches FROM {_SCORED} GROUP BY decade)"""

_SELECTED = f"""(SELECT * FROM panel_e WHERE team IN (
   SELECT team FROM (SELECT team, count(wc_year) AS participations FROM panel_v
                     WHERE team IS NOT NULL GROUP BY team
                     ORDER BY participations DESC, team LIMIT 15)))"""

_STAGE_GRID = f"""(SELECT c.team, c.edition, COALESCE(b.phase_score, -1) AS phase_score,
    CASE WHEN b.team IS NULL THEN 'not qualified' ELSE b.final_stage_reached END AS stage
  FROM (SELECT team, CAST(unnest(generate_series((SELECT min(wc_year) FROM panel_v), (SELECT max(wc_year) FROM panel_v)))
                          AS INTEGER) AS edition FROM (SELECT DISTINCT team FROM {_SELECTED})) c
  LEFT JOIN {_SELECTED} b ON c.team = b.team AND c.edition = b.wc_year)"""


def _pre_event_ctes(policy: str) -> list[tuple[str, str]]:
    def prior(c):
        s = f"COALESCE(sum({c}) OVER pre, 0.0)"
        if policy == "skip":
            return s
        return (f"CASE WHEN COALESCE(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) OVER pre, 0) = 1 "
                f"THEN NULL ELSE {s} END")
    exc = " OR ".join(f"(wc_year = {b} AND prev = {a})" for a, b in B.CUST_GAP_EXCEPTIONS)
    return [
        ("base", """
  SELECT team, confederation, CAST(wc_year AS INTEGER) AS wc_year,
    CAST(lower(COALESCE(final_stage_reached, '')) = 'winner' AS INTEGER) AS target_champion,
    CAST(lower(COALESCE(final_stage_reached, '')) IN ('winner', 'runner-up', 'third place', 'fourth place', 'semi-finals') AS INTEGER) AS target_top4,
    CAST(lower(COALESCE(final_stage_reached, '')) IN ('winner', 'runner-up', 'third place', 'fourth place', 'semi-finals', 'quarter-finals') AS INTEGER) AS target_top8,
    CAST(matches_played AS DOUBLE) AS played, CAST(wins AS DOUBLE) AS w,
    CAST(goals_scored AS DOUBLE) AS gf, CAST(goals_conceded AS DOUBLE) AS ga,
    CAST(elo_rating_approx AS DOUBLE) AS elo_rating,
    CAST(COALESCE(lower(trim(host_nation)) = 'yes', false) AS INTEGER) AS host_nation
  FROM cust_panel_v WHERE wc_year IS NOT NULL"""),
        ("w1", f"""
  SELECT *, CAST(row_number() OVER w - 1 AS INTEGER) AS wc_appearances,
    CAST(COALESCE(sum(target_champion) OVER pre, 0) AS INTEGER) AS wc_titles,
    {prior('played')} AS p_played, {prior('w')} AS p_w, {prior('gf')} AS p_gf, {prior('ga')} AS p_ga,
    lag(wc_year) OVER w AS prev
  FROM base
  WINDOW w AS (PARTITION BY team ORDER BY wc_year),
         pre AS (PARTITION BY team ORDER BY wc_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
        ("w2", f"""
  SELECT *, sum(CASE WHEN prev IS NULL THEN 1 WHEN wc_year - prev <= {B.CUST_GAP} OR {exc} THEN 0 ELSE 1 END)
      OVER (PARTITION BY team ORDER BY wc_year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM w1"""),
        ("w3", """
  SELECT *, row_number() OVER (PARTITION BY team, island ORDER BY wc_year) AS streak FROM w2"""),
    ]


def _rate(c: str) -> str:
    # printf rounds the binary value correctly, as Python does; round_even takes the printed decimal
    return f"CAST(printf('%.3f', CASE WHEN p_played > 0 THEN {c} / p_played ELSE 0.0 END) AS DOUBLE)"


def _rounded_step(bounds: str, bins: int, whole: bool) -> str:
    """Column w: the smallest of 1, 2, 5 times a power of ten that needs at most ``bins`` bins."""
    grid = f"list_transform([1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000], lambda m: pow(10.0, floor(log10(greatest((hi - lo) / {bins}, 1e-300))) - 1) * m)"
    least = " AND w >= 1" if whole else ""
    pick = f"CASE WHEN hi > lo THEN list_filter({grid}, lambda w: floor(hi / w) - floor(lo / w) + 1 <= {bins}{least})[1] ELSE 1.0 END"
    return f"SELECT {f'greatest({pick}, 1.0)' if whole else pick} AS w FROM {bounds}"


_LAGGED_STREAK = ("CAST(COALESCE(lag(streak) OVER (PARTITION BY team ORDER BY wc_year), 0) AS INTEGER)"
                  " AS consecutive_wc_appearances")


def _pre_event_sql(policy: str) -> str:
    return sql(["cust_panel_v"], f"""
SELECT team, confederation, wc_year, wc_appearances, wc_titles, elo_rating, host_nation,
  {_LAGGED_STREAK}, CAST(wc_appearances = 0 AS INTEGER) AS is_debut,
  {_rate('p_w')} AS win_rate_before, {_rate('p_gf')} AS goals_scored_per_match_before,
  {_rate('p_ga')} AS goals_conceded_per_match_before,
  target_champion, target_top4, target_top8
FROM w3""", _pre_event_ctes(policy))


def _streaks_sql() -> str:
    return sql(["cust_panel_v"], f"SELECT team, wc_year, streak, {_LAGGED_STREAK} FROM w3",
               _pre_event_ctes("poison"))


_CORR_PAIRS = [(a, b) for a in Q.CORR_COLUMNS for b in Q.CORR_COLUMNS]


def _corr_matrix() -> str:
    cols = ", ".join(
        f"round_even(CASE WHEN stddev_pop(CAST({a} AS DOUBLE)) > 0 AND stddev_pop(CAST({b} AS DOUBLE)) > 0 "
        f"THEN corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) END, 6) AS c{i}"
        for i, (a, b) in enumerate(_CORR_PAIRS))
    cond = " AND ".join(f"{c} IS NOT NULL" for c in Q.CORR_COLUMNS)
    unions = "\nUNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, c{i} AS corr FROM one"
                                 for i, (a, b) in enumerate(_CORR_PAIRS))
    one = (f"SELECT count(*) AS n, {cols} FROM factor_v "
           f"WHERE total_matches >= {Q.MIN_MATCHES_FACTORS} AND {cond}")
    return sql(["factor_v"], f"SELECT * FROM ({unions}) WHERE (SELECT n FROM one) > 3", [("one", one)])


_DIM_TEAM_BODY = f"""
  SELECT d.team_id, d.team_name, ts.games_played, wr.win_rate, CAST(COALESCE(t.titles, 0) AS BIGINT) AS titles
  FROM (SELECT team_name, row_number() OVER (ORDER BY team_name) AS team_id
        FROM (SELECT DISTINCT team AS team_name FROM lf WHERE team IS NOT NULL)) d
  LEFT JOIN (SELECT team, games_played FROM ({_TEAM_STATS_BODY})) ts ON d.team_name = ts.team
  LEFT JOIN (SELECT team, win_rate FROM ({_WIN_RATE_BODY})) wr ON d.team_name = wr.team
  LEFT JOIN (SELECT winner AS team, count(*) AS titles FROM editions_v WHERE winner IS NOT NULL GROUP BY winner) t
    ON d.team_name = t.team"""


_DIM_TEAM_PLAIN = """(SELECT team_name, row_number() OVER (ORDER BY team_name) AS team_id
      FROM (SELECT DISTINCT team AS team_name FROM lf WHERE team IS NOT NULL))"""
_DIM_STADIUM = """(SELECT stadium, city, row_number() OVER (ORDER BY stadium, city) AS stadium_id
      FROM (SELECT DISTINCT stadium, city FROM contests_v WHERE stadium IS NOT NULL))"""
_FACT = f"""(SELECT f.date, CAST(year(f.date) AS INTEGER) AS edition_year, h.team_id AS home_team_id,
        a.team_id AS away_team_id, s.stadium_id, f.home_score, f.away_score,
        f.home_score - f.away_score AS goal_diff, f.stage,
        CASE WHEN f.home_score > f.away_score THEN 'H' WHEN f.home_score < f.away_score THEN 'A' ELSE 'D' END AS result
      FROM contests_v f
      LEFT JOIN {_DIM_TEAM_PLAIN} h ON f.home_team = h.team_name
      LEFT JOIN {_DIM_TEAM_PLAIN} a ON f.away_team = a.team_name
      LEFT JOIN {_DIM_STADIUM} s ON f.stadium = s.stadium AND f.city = s.city)"""

_FACT_TEAM = f"""
SELECT ts.* EXCLUDE (team), d.team_id FROM ({_TEAM_STATS_BODY}) ts
LEFT JOIN {_DIM_TEAM_PLAIN} d ON ts.team = d.team_name"""
_FACT_PHASE = f"""
SELECT pm.* EXCLUDE (team), d.team_id FROM (
  SELECT team,
    {_stage_cols()}
  FROM lf WHERE team IS NOT NULL AND stage IS NOT NULL GROUP BY team) pm
LEFT JOIN {_DIM_TEAM_PLAIN} d ON pm.team = d.team_name"""
_HEAD_TO_HEAD = """
SELECT *, team_a_goals - team_b_goals AS goal_difference_a,
       CAST(year(last_wc_meeting_date) AS INTEGER) AS last_wc_meeting_year
FROM (SELECT team_a, team_b, count(*) AS total_wc_matches, count_if(ga > gb) AS team_a_wins,
             count_if(ga = gb) AS draws, count_if(ga < gb) AS team_b_wins,
             CAST(COALESCE(sum(ga), 0) AS BIGINT) AS team_a_goals,
             CAST(COALESCE(sum(gb), 0) AS BIGINT) AS team_b_goals, max(d) AS last_wc_meeting_date
      FROM (SELECT least(home_team, away_team) AS team_a, greatest(home_team, away_team) AS team_b,
                   CASE WHEN home_team = least(home_team, away_team) THEN home_score ELSE away_score END AS ga,
                   CASE WHEN home_team = least(home_team, away_team) THEN away_score ELSE home_score END AS gb,
                   date AS d
            FROM contests_v WHERE home_team IS NOT NULL AND away_team IS NOT NULL)
      GROUP BY team_a, team_b)"""
_WAREHOUSE_SUMS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, count(*) AS observed, CAST(sum({e}) AS BIGINT) AS content FROM {t}"
    for t, e in Q.WAREHOUSE_SUMS.items())


def _assembled_sql() -> str:
    """Feature matrix and class weights over the same feature SQL."""
    ctes = [*_pre_event_ctes("poison"), ("feats", f"""
  SELECT team, wc_year, target_top4, wc_appearances, wc_titles, elo_rating, host_nation, {_LAGGED_STREAK},
         CAST(wc_appearances = 0 AS INTEGER) AS is_debut FROM w3""")]
    cols = ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS f_{c}" for c in MODEL_FEATURES)
    return sql(["cust_panel_v"], f"""
SELECT team, wc_year, target_top4,
  round_even((SELECT count(*) FROM feats) / ((SELECT count(DISTINCT target_top4) FROM feats)
             * count(*) OVER (PARTITION BY target_top4)), 9) AS weight,
  {cols} FROM feats""", ctes)


_FACTOR = f"(SELECT * FROM factor_v WHERE total_matches >= {{m}})"


def oracle_sql() -> dict[str, str]:
    tie = ", ".join(Q.CONTEST_TIE)
    fm = Q.MIN_MATCHES_FACTORS
    tm = Q.MIN_MATCHES_TOP
    o = {
        "team_stats": sql(["lf"], _TEAM_STATS_BODY),
        "win_rate": sql(["lf"], _WIN_RATE_BODY),
        "titles": sql(["editions_v"], "SELECT winner AS team, count(*) AS titles FROM editions_v "
                                      "WHERE winner IS NOT NULL GROUP BY winner"),
        "phase_matrix": sql(["lf"], f"""
SELECT team,
  {_stage_cols()}
FROM lf WHERE team IS NOT NULL AND stage IS NOT NULL GROUP BY team"""),
        "phase_counts": sql(["lf"], """
SELECT team, stage, count(*) AS appearances FROM lf WHERE team IS NOT NULL AND stage IS NOT NULL GROUP BY team, stage"""),
        "home_advantage": sql(["contests_v"], """
SELECT round_even(h, 6) AS home_win_rate, round_even(a, 6) AS away_win_rate,
       round_even(h - a, 6) AS home_advantage_index
FROM (SELECT avg(CAST(COALESCE(home_score > away_score, false) AS INTEGER)) AS h,
             avg(CAST(COALESCE(away_score > home_score, false) AS INTEGER)) AS a FROM contests_v)"""),
        "contest_features": sql(["contests_v"], f"""
SELECT {tie}, date, home_team, away_team, home_score, away_score,
  home_score - away_score AS goal_diff,
  CASE WHEN home_score > away_score THEN 'H' WHEN home_score < away_score THEN 'A' ELSE 'D' END AS result,
  CAST(year(date) AS INTEGER) AS year, CAST(floor(year(date) / 10) * 10 AS INTEGER) AS decade,
  home_score + away_score AS total_goals
FROM contests_v"""),
        "harmonise_names": sql(["contests_v"], f"""
SELECT team, count(*) AS contests FROM (
  SELECT {_alias_case('name')} AS team FROM (
    SELECT COALESCE({_OLD_NAMES}[home_key + 1], home_team) AS name FROM contests_v
    UNION ALL SELECT COALESCE({_OLD_NAMES}[away_key + 1], away_team) AS name FROM contests_v))
WHERE team IS NOT NULL GROUP BY team"""),
        "normalise_text": sql(["contests_v"], """
SELECT lower(trim(raw_stadium)) AS stadium, lower(trim(raw_stage)) AS stage, lower(trim(raw_city)) AS city,
       count(*) AS contests
FROM contests_v GROUP BY 1, 2, 3"""),
        "clean_rows": sql(["contests_v"], """
SELECT DISTINCT date, home_team, away_team, home_score, away_score, stage FROM contests_v
WHERE line_no <> 7
  AND NOT (date IS NULL AND home_team IS NULL AND away_team IS NULL AND home_score IS NULL
           AND away_score IS NULL AND stage IS NULL)"""),
        "coerce_types": """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 6 IN (0, 1, 3) THEN TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS prio_digit,
  TRY_CAST(o_orderpriority AS INTEGER) AS prio_as_int,
  CASE WHEN o_orderkey % 8 < 6 THEN CAST(o_orderdate AS DATE) END AS order_day,
  TRY_CAST(o_orderstatus AS DATE) AS status_as_date,
  CASE WHEN o_orderkey % 5 IN (0, 3) THEN o_totalprice END AS total_price
FROM orders""",
        "csv_round_trip": """
SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal,
  CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS BIGINT) END AS code, CAST(NULL AS VARCHAR) AS note, 0 AS flag
FROM customer""",
        "unified_matches": sql(["contests_v", "contests_b_v"], f"""
SELECT date, home_team, away_team, home_score, away_score, stage, wc_year, result_type FROM (
  SELECT *, row_number() OVER (PARTITION BY date, home_team, away_team ORDER BY src, {tie}) AS rn FROM (
    SELECT 1 AS src, {tie}, date, home_team, away_team, home_score, away_score, stage,
           CAST(NULL AS INTEGER) AS wc_year, CAST(NULL AS VARCHAR) AS result_type FROM contests_v
    UNION ALL
    SELECT 2 AS src, {tie}, date, home_team, away_team, home_goals, away_goals, stage,
           wc_year, result_type FROM contests_b_v))
WHERE rn = 1"""),
        "goals_by_edition": sql(["contests_v"], f"""
SELECT year, round_even(avg(total_goals), 6) AS goals_per_match,
       CAST(sum(total_goals) AS BIGINT) AS total_goals, count(total_goals) AS nb_matches
FROM {_SCORED} GROUP BY year"""),
        "goals_by_decade": sql(["contests_v"], f"SELECT * FROM {_BY_DECADE}"),
        "decade_lookup": sql(["contests_v"], f"""
SELECT w.decade, d.goals_per_match
FROM (SELECT CAST(unnest([{", ".join(str(d) for d in Q.LOOKUP_DECADES)}]) AS INTEGER) AS decade) w
LEFT JOIN {_BY_DECADE} d ON w.decade = d.decade"""),
        "score_frequency_top10": sql(["contests_v"], f"""
SELECT home_score, away_score, count(*) AS count,
       CAST(home_score AS VARCHAR) || ' - ' || CAST(away_score AS VARCHAR) AS score
FROM {_SCORED} GROUP BY home_score, away_score
ORDER BY count DESC, home_score, away_score LIMIT 10"""),
        "goal_histogram": sql(["contests_v"], f"""
SELECT decade, bin, count(*) AS count, round_even(lo + bin * width, 6) AS bin_start FROM (
  SELECT decade, lo, width,
         CAST(least(floor((CAST(total_goals AS DOUBLE) - lo) / width), 14) AS INTEGER) AS bin
  FROM {_SCORED} s, (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 15 ELSE 1.0 END AS width
                     FROM (SELECT CAST(min(total_goals) AS DOUBLE) AS lo, CAST(max(total_goals) AS DOUBLE) AS hi
                           FROM {_SCORED})) b
  WHERE total_goals IS NOT NULL)
GROUP BY decade, bin, lo, width"""),
        "goal_histogram_rounded": sql(["contests_v"], f"""
SELECT decade, round_even(w, 6) AS step, round_even(floor(total_goals / w) * w, 6) AS bin_start, count(*) AS count
FROM {_SCORED} s, step WHERE total_goals IS NOT NULL GROUP BY decade, w, floor(total_goals / w) * w""", [
            ("b", f"SELECT CAST(min(total_goals) AS DOUBLE) AS lo, CAST(max(total_goals) AS DOUBLE) AS hi FROM {_SCORED}"),
            ("step", _rounded_step("b", 15, True))]),
        "order_value_histogram": f"""
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
step AS ({_rounded_step("b", Q.VALUE_BINS, False)})
SELECT o_orderstatus, round_even(w, 6) AS step, round_even(floor(o_totalprice / w) * w, 6) AS bin_start, count(*) AS count
FROM orders, step GROUP BY o_orderstatus, w, floor(o_totalprice / w) * w""",
        "half_even_rates": """
SELECT l_quantity, count(*) AS rows, CAST(printf('%.3f', l_quantity / 80) AS DOUBLE) AS eightieth,
       CAST(printf('%.3f', l_quantity / 16) AS DOUBLE) AS sixteenth, CAST(printf('%.2f', l_quantity / 8) AS DOUBLE) AS eighth,
       printf('%.1f%%', l_quantity / 16 * 100) AS share
FROM (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity FROM lineitem) GROUP BY l_quantity""",
        "dates_by_column": """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 3 THEN CAST(try_strptime(strftime(d, '%d/%m/%Y'), '%m/%d/%Y') AS DATE) ELSE d END AS month_first,
  CASE WHEN o_orderkey % 3 <> 2 THEN d END AS iso, CASE WHEN o_orderkey % 7 <> 0 THEN d END AS late_start
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
        "csv_multiline": """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || chr(10) || 'line "two", ' || p_brand WHEN 1 THEN chr(10) || p_name || chr(10) || chr(10) || p_type
         WHEN 2 THEN 'say "' || p_name || '"' ELSE p_name END AS note,
       row_number() OVER (ORDER BY p_partkey) AS place
FROM part""",
        "ragged_csv": """
SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS c_name, CASE WHEN c_custkey % 3 = 1 THEN c_acctbal END AS c_acctbal,
       CAST(NULL AS VARCHAR) AS note
FROM customer""",
        "catalog_sql": """
SELECT n.n_name AS nation, r.r_name AS region, (SELECT count(*) FROM region) AS regions
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
        "decade_shares": sql(["contests_v"], f"""
SELECT CAST(decade AS VARCHAR) || 's' AS decade, count(*) AS matches,
       printf('%.1f%%', 100 * (count(*) FILTER (WHERE home_score > away_score) / count(*))) AS home_win_share
FROM {_SCORED} WHERE home_score IS NOT NULL AND away_score IS NOT NULL GROUP BY decade"""),
        "overview_kpis": sql(["contests_v", "profile_v"], """
SELECT count(*) AS total_matches, count(DISTINCT home_team) AS total_teams,
       count(DISTINCT year(date)) AS total_editions,
       CAST(printf('%.2f', avg(COALESCE(home_score, 0) + COALESCE(away_score, 0))) AS DOUBLE) AS avg_goals,
       (SELECT team FROM profile_v WHERE titles IS NOT NULL ORDER BY titles DESC, team LIMIT 1) AS most_titles
FROM contests_v"""),
        "edition_bounds": sql(["panel_v"], """
SELECT min(wc_year) AS min_year, max(wc_year) AS max_year, count(DISTINCT confederation) AS groups FROM panel_v"""),
        "group_list": sql(["profile_v"], """
SELECT DISTINCT confederation FROM profile_v WHERE confederation IS NOT NULL"""),
        "host_vs_visitor": sql(["panel_e"], """
SELECT host_count, visitor_count, round_even(h, 6) AS host_win_rate, round_even(v, 6) AS visitor_win_rate,
       round_even(h - v, 6) AS delta
FROM (SELECT count_if(is_host) AS host_count, count_if(NOT is_host) AS visitor_count,
             avg(CASE WHEN is_host THEN win_rate END) AS h, avg(CASE WHEN NOT is_host THEN win_rate END) AS v
      FROM panel_e)"""),
        "host_wdl_means": sql(["panel_e"], """
SELECT CASE WHEN is_host THEN 'host' ELSE 'visitor' END AS status,
       round_even(avg(wins), 6) AS mean_wins, round_even(avg(draws), 6) AS mean_draws,
       round_even(avg(losses), 6) AS mean_losses
FROM panel_e GROUP BY 1"""),
        "host_stage_counts": sql(["panel_e"], """
SELECT final_stage_reached AS stage, count(*) AS count FROM panel_e WHERE is_host GROUP BY 1"""),
        "host_by_edition": sql(["panel_e"], """
SELECT wc_year AS edition, CASE WHEN is_host THEN 'host' ELSE 'visitor' END AS status,
       round_even(avg(win_rate), 6) AS win_rate
FROM panel_e GROUP BY 1, 2"""),
        "host_table": sql(["panel_e"], """
SELECT team, wc_year AS edition, wins, draws, losses, goals_scored, goals_conceded,
       round_even(win_rate, 6) AS win_rate, final_stage_reached AS stage
FROM panel_e WHERE is_host"""),
        "participation_top15": sql(["panel_v"], """
SELECT team, count(wc_year) AS participations FROM panel_v WHERE team IS NOT NULL
GROUP BY team ORDER BY participations DESC, team LIMIT 15"""),
        "stage_heatmap": sql(["panel_e"], f"SELECT team, edition, phase_score FROM {_STAGE_GRID}"),
        "stage_labels": sql(["panel_e"], f"SELECT team, edition, stage FROM {_STAGE_GRID}"),
        "winrate_by_entity_edition": sql(["panel_e"], f"""
SELECT team, wc_year AS edition, round_even(win_rate, 6) AS win_rate_ed FROM {_SELECTED}"""),
        "decade_top5": sql(["panel_e"], """
SELECT * FROM (
  SELECT decade, team, wins, CAST(row_number() OVER (PARTITION BY decade ORDER BY wins DESC, team) AS INTEGER) AS rank
  FROM (SELECT decade, team, CAST(COALESCE(sum(wins), 0) AS BIGINT) AS wins FROM panel_e
        WHERE team IS NOT NULL GROUP BY decade, team))
WHERE rank <= 5"""),
        "strength_correlation": sql(["panel_e"], """
SELECT round_even(corr(strength, CAST(phase_score AS DOUBLE)), 6) AS corr
FROM panel_e WHERE strength IS NOT NULL AND phase_score IS NOT NULL"""),
        "strength_trend": sql(["panel_e"], """
SELECT i, round_even(x_min + i * step, 6) AS x, round_even(slope * (x_min + i * step) + intercept, 6) AS y
FROM (SELECT regr_slope(CAST(phase_score AS DOUBLE), strength) AS slope,
             regr_intercept(CAST(phase_score AS DOUBLE), strength) AS intercept,
             regr_count(CAST(phase_score AS DOUBLE), strength) AS points,
             min(strength) AS x_min,
             CASE WHEN max(strength) > min(strength) THEN (max(strength) - min(strength)) / 99 ELSE 0.0 END AS step
      FROM panel_e WHERE strength IS NOT NULL AND phase_score IS NOT NULL) t,
     (SELECT CAST(generate_series AS INTEGER) AS i FROM generate_series(0, 99)) g
WHERE points > 5"""),
        "upset_kpis": sql(["panel_e"], """
SELECT round_even(corr(strength, CAST(phase_score AS DOUBLE)), 6) AS strength_stage_corr,
       count_if(strength < 1750 AND phase_score >= 2) AS upsets,
       count_if(strength >= 1950 AND phase_score >= 4) AS favourites_far,
       count(*) AS rated_rows
FROM panel_e WHERE strength IS NOT NULL"""),
        "upsets_by_edition": sql(["panel_e"], """
SELECT wc_year AS edition, count(*) AS upsets FROM panel_e
WHERE strength IS NOT NULL AND strength < 1750 AND phase_score >= 2 GROUP BY 1"""),
        "upset_list": sql(["panel_e"], """
SELECT team, wc_year AS edition, strength, final_stage_reached AS stage, confederation AS group_name, phase_score
FROM panel_e WHERE strength IS NOT NULL AND strength < 1800 AND phase_score >= 2"""),
        "upset_list_floor": sql(["panel_e"], f"""
SELECT team, wc_year AS edition, strength, final_stage_reached AS stage, confederation AS group_name, phase_score
FROM panel_e WHERE strength IS NOT NULL AND strength < 1800 AND strength >= {Q.STRENGTH_FLOOR} AND phase_score >= 2"""),
        "group_winrate_decade": sql(["panel_e"], """
SELECT decade, confederation AS group_name, round_even(avg(win_rate), 6) AS win_rate
FROM panel_e WHERE confederation IS NOT NULL GROUP BY 1, 2"""),
        "group_stage_counts": sql(["panel_e"], """
SELECT confederation AS group_name, phase_lower, count(*) AS count FROM panel_e
WHERE confederation IS NOT NULL AND phase_lower IS NOT NULL GROUP BY 1, 2"""),
        "group_participations": sql(["panel_v"], """
SELECT confederation AS group_name, count(*) AS participations FROM panel_v
WHERE confederation IS NOT NULL GROUP BY 1"""),
        "group_participations_edition": sql(["panel_v"], """
SELECT wc_year AS edition, confederation AS group_name, count(*) AS participations FROM panel_v
WHERE confederation IS NOT NULL GROUP BY 1, 2"""),
        "outcome_targets": sql(["panel_v"], """
SELECT team, wc_year, final_stage_reached,
  CAST(lower(COALESCE(final_stage_reached, '')) = 'winner' AS INTEGER) AS target_champion,
  CAST(lower(COALESCE(final_stage_reached, '')) IN ('winner', 'runner-up', 'third place', 'fourth place', 'semi-finals') AS INTEGER) AS target_top4,
  CAST(lower(COALESCE(final_stage_reached, '')) IN ('winner', 'runner-up', 'third place', 'fourth place', 'semi-finals', 'quarter-finals') AS INTEGER) AS target_top8
FROM panel_v"""),
        "group_titles_share": sql(["profile_v"], """
SELECT group_name, titles,
       round_even(CASE WHEN total > 0 THEN titles / total ELSE 0.0 END, 6) AS share
FROM (SELECT confederation AS group_name, CAST(COALESCE(sum(titles), 0) AS BIGINT) AS titles
      FROM profile_v WHERE confederation IS NOT NULL GROUP BY 1),
     (SELECT CAST(COALESCE(sum(titles), 0) AS DOUBLE) AS total FROM profile_v)"""),
        "group_finals": sql(["profile_v"], """
SELECT confederation AS group_name, CAST(COALESCE(sum(finals_reached), 0) AS BIGINT) AS finals,
       CAST(COALESCE(sum(semis_reached), 0) AS BIGINT) AS semis,
       CAST(COALESCE(sum(quarters_reached), 0) AS BIGINT) AS quarters
FROM profile_v WHERE confederation IS NOT NULL GROUP BY 1"""),
        "profile_ranked": sql(["profile_r"], f"""
SELECT team, confederation, total_wc_appearances, titles, finals_reached, semis_reached, total_matches,
       total_wins, win_rate, goals_per_match, conceded_per_match
FROM profile_r WHERE total_wc_appearances >= {Q.MIN_APPEARANCES}"""),
        "profile_group": sql(["profile_v"], f"""
SELECT team, confederation, titles, total_matches, win_rate FROM profile_v
WHERE total_wc_appearances >= {Q.MIN_APPEARANCES} AND confederation = '{Q.GROUP}'"""),
        "titles_top15": sql(["profile_v"], """
SELECT team, confederation, total_wc_appearances, titles, finals_reached, semis_reached FROM profile_v
WHERE titles IS NOT NULL ORDER BY titles DESC, team LIMIT 15"""),
        "win_rate_top20": sql(["profile_v"], f"""
SELECT team, win_rate, total_matches FROM profile_v WHERE total_matches >= {tm} AND win_rate IS NOT NULL
ORDER BY win_rate DESC, team LIMIT 20"""),
        "win_rate_joined": sql(["profile_v", "lf"], f"""
SELECT p.team, p.total_matches, w.win_rate FROM profile_v p LEFT JOIN ({_WIN_RATE_BODY}) w ON p.team = w.team"""),
        "group_mode_top10": sql(["profile_v"], """
SELECT confederation, count(*) AS count FROM (
  SELECT confederation FROM profile_v WHERE total_wins IS NOT NULL ORDER BY total_wins DESC, team LIMIT 10)
GROUP BY confederation ORDER BY count DESC, confederation LIMIT 1"""),
        "profile_leaders": sql(["profile_v"], f"""
SELECT count(*) AS entities,
  (SELECT team FROM p WHERE titles IS NOT NULL ORDER BY titles DESC, team LIMIT 1) AS most_titles,
  max(titles) AS max_titles,
  (SELECT team FROM p WHERE win_rate IS NOT NULL ORDER BY win_rate DESC, team LIMIT 1) AS best_win_rate_team,
  round_even(max(win_rate), 6) AS best_win_rate,
  (SELECT team FROM p WHERE total_wc_appearances IS NOT NULL ORDER BY total_wc_appearances DESC, team LIMIT 1)
    AS most_appearances_team,
  max(total_wc_appearances) AS max_appearances
FROM p""", [("p", f"SELECT * FROM profile_v WHERE total_wc_appearances >= {Q.MIN_APPEARANCES}")]),
        "profile_bubble": sql(["profile_v"], f"""
SELECT team, confederation, total_wc_appearances, round_even(win_rate, 6) AS win_rate,
       COALESCE(titles, 0) AS titles_disp, greatest(CAST(COALESCE(titles, 0) AS DOUBLE), 0.5) AS bubble_size
FROM profile_v WHERE total_wc_appearances >= {Q.MIN_APPEARANCES}"""),
        "metric_top10": sql(["factor_v"], f"""
SELECT team, win_rate, total_matches FROM {_FACTOR.format(m=tm)} WHERE win_rate IS NOT NULL
ORDER BY win_rate DESC, team LIMIT 10"""),
        "metric_bottom10_conceded": sql(["factor_v"], f"""
SELECT team, conceded_per_match, total_matches FROM {_FACTOR.format(m=tm)} WHERE conceded_per_match IS NOT NULL
ORDER BY conceded_per_match ASC, team LIMIT 10"""),
        "factor_correlation_matrix": _corr_matrix(),
        "experience_trend": sql(["cust_profile_v"], f"""
SELECT round_even(slope, 6) AS slope, round_even(intercept, 6) AS intercept, points, x_min, x_max FROM (
  SELECT regr_slope(CAST(win_rate AS DOUBLE), CAST(total_wc_appearances AS DOUBLE)) AS slope,
         regr_intercept(CAST(win_rate AS DOUBLE), CAST(total_wc_appearances AS DOUBLE)) AS intercept,
         regr_count(CAST(win_rate AS DOUBLE), CAST(total_wc_appearances AS DOUBLE)) AS points,
         min(CAST(total_wc_appearances AS DOUBLE)) AS x_min, max(CAST(total_wc_appearances AS DOUBLE)) AS x_max
  FROM (SELECT * FROM cust_profile_v WHERE total_matches >= {fm}) WHERE win_rate IS NOT NULL AND total_wc_appearances IS NOT NULL)
WHERE points > 2"""),
        "experience_titles_trend": sql(["cust_profile_v"], f"""
SELECT round_even(slope, 6) AS slope, round_even(intercept, 6) AS intercept, points, x_min, x_max FROM (
  SELECT regr_slope(CAST(titles AS DOUBLE), CAST(total_wc_appearances AS DOUBLE)) AS slope,
         regr_intercept(CAST(titles AS DOUBLE), CAST(total_wc_appearances AS DOUBLE)) AS intercept,
         regr_count(CAST(titles AS DOUBLE), CAST(total_wc_appearances AS DOUBLE)) AS points,
         min(CAST(total_wc_appearances AS DOUBLE)) AS x_min, max(CAST(total_wc_appearances AS DOUBLE)) AS x_max
  FROM (SELECT * FROM cust_profile_v WHERE total_matches >= {fm}) WHERE titles IS NOT NULL AND total_wc_appearances IS NOT NULL)
WHERE points > 2"""),
        "attack_defence_profile": sql(["factor_v"], f"""
SELECT team, goals_per_match, conceded_per_match,
  round_even((SELECT avg(goals_per_match) FROM {_FACTOR.format(m=fm)}), 6) AS mean_goals_per_match,
  round_even((SELECT avg(conceded_per_match) FROM {_FACTOR.format(m=fm)}), 6) AS mean_conceded_per_match
FROM {_FACTOR.format(m=fm)}"""),
        "factor_leaders": sql(["factor_v"], f"""
SELECT
  (SELECT team FROM {_FACTOR.format(m=tm)} WHERE goals_per_match IS NOT NULL ORDER BY goals_per_match DESC, team LIMIT 1) AS best_attack,
  (SELECT team FROM {_FACTOR.format(m=tm)} WHERE conceded_per_match IS NOT NULL ORDER BY conceded_per_match ASC, team LIMIT 1) AS best_defence,
  (SELECT team FROM {_FACTOR.format(m=tm)} WHERE total_wc_appearances IS NOT NULL ORDER BY total_wc_appearances DESC, team LIMIT 1) AS most_experienced,
  (SELECT team FROM {_FACTOR.format(m=tm)} WHERE win_rate IS NOT NULL ORDER BY win_rate DESC, team LIMIT 1) AS best_win_rate"""),
        "with_label": sql(["profile_v", "ranking_v"], """
SELECT p.team, p.titles, COALESCE(concat_ws(' ', l.tag, p.team), p.team) AS label
FROM profile_v p LEFT JOIN (
  SELECT n.n_name AS name, min('[' || upper(substr(r.r_name, 1, 3)) || ']') AS tag
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_name IN (SELECT team FROM ranking_v) GROUP BY n.n_name) l ON p.team = l.name"""),
        "dim_team": sql(["lf", "editions_v"], "SELECT * FROM dim_team", [("dim_team", _DIM_TEAM_BODY)]),
        "dim_edition": sql(["editions_v"], """
SELECT year AS edition_year, host_country, winner, teams FROM editions_v"""),
        "dim_stadium": sql(["contests_v"], f"SELECT * FROM {_DIM_STADIUM}"),
        "fact_matches": sql(["lf"], f"SELECT * FROM {_FACT}"),
        "fact_team_performance": sql(["lf"], _FACT_TEAM),
        "fact_phase_performance": sql(["lf"], _FACT_PHASE),
        "fact_head_to_head": sql(["contests_v"], _HEAD_TO_HEAD),
        "star_join_finals": sql(["lf"], f"""
SELECT f.date, h.team_name AS home_team, a.team_name AS away_team, f.home_score, f.away_score
FROM {_FACT} f
JOIN {_DIM_TEAM_PLAIN} h ON f.home_team_id = h.team_id
JOIN {_DIM_TEAM_PLAIN} a ON f.away_team_id = a.team_id
WHERE f.stage = '{Q.FINAL_STAGE}'"""),
        "edition_join": sql(["lf"], f"""
SELECT f.date, h.team_name AS home_team, a.team_name AS away_team, f.home_score, f.away_score, f.stage, f.result
FROM {_FACT} f
JOIN {_DIM_TEAM_PLAIN} h ON f.home_team_id = h.team_id
JOIN {_DIM_TEAM_PLAIN} a ON f.away_team_id = a.team_id
WHERE f.edition_year = {Q.JOIN_EDITION}"""),
        "title_editions_join": sql(["lf", "editions_v"], f"""
SELECT f.edition_year, count(*) AS matches, CAST(sum(f.home_score + f.away_score) AS BIGINT) AS goals,
       count(*) FILTER (WHERE h.team_name = e.winner OR a.team_name = e.winner) AS winner_matches
FROM {_FACT} f JOIN editions_v e ON f.edition_year = e.year
JOIN {_DIM_TEAM_PLAIN} h ON f.home_team_id = h.team_id
JOIN {_DIM_TEAM_PLAIN} a ON f.away_team_id = a.team_id
WHERE e.winner = (SELECT winner FROM editions_v WHERE winner IS NOT NULL GROUP BY winner ORDER BY count(*) DESC, winner LIMIT 1)
GROUP BY f.edition_year"""),
        "warehouse_reload": sql(["contests_v"], f"""
SELECT t.team_name, f.team_name IS NOT NULL AS in_first_load, CASE WHEN f.team_name IS NOT NULL THEN true END AS key_kept,
       (SELECT count(*) FROM contests_v c WHERE c.home_team = t.team_name) AS home_matches
FROM (SELECT home_team AS team_name FROM contests_v UNION SELECT away_team FROM contests_v) t
LEFT JOIN (SELECT home_team AS team_name FROM contests_v WHERE home_team < '{Q.FIRST_LOAD_BELOW}' AND away_team < '{Q.FIRST_LOAD_BELOW}'
           UNION SELECT away_team FROM contests_v WHERE home_team < '{Q.FIRST_LOAD_BELOW}' AND away_team < '{Q.FIRST_LOAD_BELOW}') f
  ON f.team_name = t.team_name WHERE t.team_name IS NOT NULL"""),
        "dim_top10_winrate": sql(["lf", "editions_v"], f"""
SELECT team_name, win_rate, games_played FROM dim_team WHERE games_played >= {Q.MIN_GAMES_DIM}
ORDER BY win_rate DESC, team_name LIMIT 10""", [("dim_team", _DIM_TEAM_BODY)]),
        "warehouse_load": sql(["lf", "editions_v"], _WAREHOUSE_SUMS, [
            ("dim_team", _DIM_TEAM_BODY), ("dim_edition", "SELECT year AS edition_year, * EXCLUDE (year) FROM editions_v"),
            ("dim_stadium", f"SELECT * FROM {_DIM_STADIUM}"), ("fact_matches", f"SELECT * FROM {_FACT}"),
            ("fact_team_performance", _FACT_TEAM), ("fact_phase_performance", _FACT_PHASE),
            ("fact_head_to_head", _HEAD_TO_HEAD)]),
        "assembled_features": _assembled_sql(),
        "pre_event_features": _pre_event_sql("poison"),
        "pre_event_features_skip": _pre_event_sql("skip"),
    }
    o["streaks"] = _streaks_sql()
    return o
