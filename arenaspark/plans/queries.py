"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Each query binds one or more operators to the views of ``bindings`` and reads
the whole tables: no sampling, no id subsets, no row caps except where the
limit is the feature (top-k reports).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaspark.constants import ENTITY_ALIASES, MODEL_DEPTH, MODEL_FEATURES, MODEL_SEED, MODEL_TREES, UPSET_LIST_STRENGTH
from arenaspark.functions import exprs as E
from arenaspark.operators import clean, contests as C, model as M, panels as P, profiles as R
from arenaspark.operators import stats as S, warehouse as W, windows as WD
from arenaspark.plans import bindings as B
from arenaspark.plans.workspace import workspace as V
from arenaspark.sources import io
from arenaspark.sources.tableset import TableSet
from arenaspark.specs import ContestSpec, PanelSpec, ProfileSpec

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Parameters of the registered queries (the reference's defaults, bound to this data)
STAGES = ["1-urgent", "2-high", "3-medium", "4-not specified", "5-low"]
FINAL_STAGE = "1-urgent"
JOIN_EDITION = 1997
FIRST_LOAD_BELOW = "J"  # the first of two loads has the contests among names before this one
VALUE_BINS = 20
LOOKUP_DECADES = [1930, 1990, 2000, 2010]
MIN_APPEARANCES = 3
MIN_MATCHES_FACTORS = 10
MIN_MATCHES_TOP = 10
MIN_GAMES_DIM = 10
CORR_COLUMNS = ["total_wc_appearances", "titles", "win_rate", "goals_per_match",
                "conceded_per_match", "ranking"]
# What each warehouse table is summed over when its content is checked
WAREHOUSE_SUMS = {
    "dim_team": "team_id * games_played + titles",
    "dim_edition": "edition_year * teams",
    "dim_stadium": "stadium_id * length(stadium)",
    "fact_matches": "home_team_id * 31 + away_team_id * 7 + stadium_id + home_score - away_score",
    "fact_team_performance": "team_id * goals_scored + games_played",
    "fact_phase_performance": "team_id * stage_1_urgent + stage_other",
    "fact_head_to_head": "total_wc_matches * team_a_goals + team_b_wins",
}
CONTEST_TIE = ["order_key", "line_no", "part_key", "supp_key", "qty", "price"]

GROUP = "ASIA"
STRENGTH_FLOOR = 1500
ALIAS_NAMES = sorted(ENTITY_ALIASES)

CS, PS, RS = ContestSpec(), PanelSpec(), ProfileSpec()


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ----------------------------------------------------------------- contests
@query("team_stats")
def q_team_stats(spark, sf):
    return C.two_sided_stats(V(spark, sf).contests())


@query("win_rate")
def q_win_rate(spark, sf):
    return C.two_sided_win_rate(V(spark, sf).contests())


@query("titles")
def q_titles(spark, sf):
    return C.title_counts(V(spark, sf).editions())


@query("phase_matrix")
def q_phase_matrix(spark, sf):
    return C.stage_matrix(V(spark, sf).contests(), STAGES)


@query("phase_counts")
def q_phase_counts(spark, sf):
    return C.stage_counts(V(spark, sf).contests())


@query("home_advantage")
def q_home_advantage(spark, sf):
    return C.side_advantage(V(spark, sf).contests())


@query("contest_features")
def q_contest_features(spark, sf):
    c = C.contest_features(V(spark, sf).contests())
    return c.select(*CONTEST_TIE, "date", "home_team", "away_team", "home_score", "away_score",
                    "goal_diff", "result", "year", "decade", "total_goals")


@query("harmonise_names")
def q_harmonise_names(spark, sf):
    """Names of the first nations are spelled by the alias table's old names."""
    old = F.array(*[F.lit(n) for n in ALIAS_NAMES])
    raw = lambda key, name: F.coalesce(F.get(old, key), F.col(name)).alias(name)
    c = V(spark, sf).contests().select(raw("home_key", "home_team"), raw("away_key", "away_team"), "home_score", "away_score")
    lf = C.long_form(clean.harmonise_columns(c, ["home_team", "away_team"])).where(F.col("team").isNotNull())
    return lf.groupBy("team").agg(F.count(F.lit(1)).alias("contests"))


@query("normalise_text")
def q_normalise_text(spark, sf):
    raw = V(spark, sf).contests().select(F.col("raw_stadium").alias("stadium"),
                                         F.col("raw_stage").alias("stage"), F.col("raw_city").alias("city"))
    c = clean.normalise_columns(raw, ["stadium", "stage", "city"])
    return c.groupBy("stadium", "stage", "city").agg(F.count(F.lit(1)).alias("contests"))


@query("clean_rows")
def q_clean_rows(spark, sf):
    """Contests of the seventh line lose every value: rows that are entirely null."""
    cols = ["date", "home_team", "away_team", "home_score", "away_score", "stage"]
    c = V(spark, sf).contests().select(*[F.when(F.col("line_no") != 7, F.col(x)).alias(x) for x in cols])
    return clean.clean_rows(c)


@query("coerce_types")
def q_coerce_types(spark, sf):
    """Order columns written as text in turn in the forms a dirty source has."""
    digit, price, day = F.substring("o_orderpriority", 1, 1), F.col("o_totalprice").cast("string"), F.col("o_orderdate").cast("date")
    turn = lambda n, forms: F.element_at(F.array(*forms), (F.col("o_orderkey") % n + 1).cast("int"))
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey",
        turn(6, [digit, F.concat(digit, F.lit(".0")), F.concat(digit, F.lit("d")), F.concat(F.lit(" "), digit, F.lit(" ")),
                 F.concat(digit, F.lit(".5")), F.lit("nan")]).alias("prio_digit"),
        F.col("o_orderpriority").alias("prio_as_int"),
        turn(8, [day.cast("string"), F.concat(day.cast("string"), F.lit(" 15:00:00")), F.date_format(day, "yyyy/MM/dd"),
                 F.date_format(day, "MM/dd/yyyy"), F.date_format(day, "MMMM d, yyyy"), F.date_format(day, "d MMM yyyy"),
                 F.lit("31/31/2020"), F.lit("soon")]).alias("order_day"),
        F.col("o_orderstatus").alias("status_as_date"),
        turn(5, [price, F.concat(price, F.lit("f")), F.lit("NaN"), F.concat(F.lit("+"), price), F.lit("N/A")]).alias("total_price"))
    o = clean.parse_numbers(o, {"prio_digit": "int", "prio_as_int": "int", "total_price": "double"})
    return clean.parse_dates(o, ["order_day", "status_as_date"])


@query("csv_round_trip")
def q_csv_round_trip(spark, sf):
    """Customers written as CSV, read back with a declared schema and conformed."""
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]

    def write(path: str) -> str:
        c = spark.read.parquet(f"{sf}/customer.parquet").select(
            *cols, F.when(F.col("c_custkey") % 3 == 0, F.lit("N/A")).otherwise(F.col("c_custkey").cast("string")).alias("code"))
        io.write_csv(c, path)
        return path

    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
                           T.StructField("code", T.LongType())])
    back = io.read_csv(spark, V(spark, sf).once("customer-csv", write), schema)
    return io.conform(back, {"c_custkey": T.LongType(), "c_name": T.StringType(), "c_nationkey": T.IntegerType(),
                             "c_acctbal": T.DoubleType(), "code": T.LongType(), "note": T.StringType(), "flag": T.IntegerType()},
                      {"flag": 0})


@query("csv_multiline")
def q_csv_multiline(spark, sf):
    """Part texts with quotes and line breaks written as CSV in key order and read back; records keep their order."""
    name, brand, kind, nl = F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.lit("\n")
    turn = F.col("p_partkey") % 4

    def write(path: str) -> str:
        note = (F.when(turn == 0, F.concat(name, nl, F.lit('line "two", '), brand)).when(turn == 1, F.concat(nl, name, nl, nl, kind))
                .when(turn == 2, F.concat(F.lit('say "'), name, F.lit('"'))).otherwise(name))
        p = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", note.alias("note"))
        # part files hold consecutive ranges of keys, so file order is key order
        io.write_csv(p.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey"), path)
        return path

    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("note", T.StringType())])
    back = io.read_csv(spark, V(spark, sf).once("part-notes-csv", write), schema, order_column="order")
    return WD.dense_keys(back, ["order"], "place").drop("order")


@query("ragged_csv")
def q_ragged_csv(spark, sf):
    """Customers as text lines of one, two or three fields: short records are padded (S5); an absent second file is an
    empty typed table (S10)."""
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_acctbal", T.DoubleType())])

    def write(path: str) -> str:
        key, n = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
        line = F.concat_ws(",", key, F.when(n != 0, F.col("c_name")), F.when(n == 1, F.col("c_acctbal").cast("string")))
        head = F.lit("c_custkey,c_name,c_acctbal")
        # every part file starts with the header, as the files of a folder do
        c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", line.alias("value")).repartition(3, "c_custkey")
        c = c.withColumns({"part": F.spark_partition_id(), "n": F.lit(1)})
        heads = c.select("part").distinct().select(F.lit(None).cast("bigint").alias("c_custkey"), head.alias("value"), "part", F.lit(0).alias("n"))
        (c.unionByName(heads).repartition(3, "part").sortWithinPartitions("part", "n").select("part", "value")
         .write.partitionBy("part").text(path))
        return path

    path = V(spark, sf).once("customer-ragged", write)
    here = io.read_csv(spark, path, schema)
    absent = io.read_csv(spark, f"{path}-absent.csv", schema, missing_ok=True)
    both = here.unionByName(absent)
    return io.conform(clean.select_present(both, ["c_custkey", "c_name", "c_acctbal", "not_there"]),
                      {"c_custkey": T.LongType(), "c_name": T.StringType(), "c_acctbal": T.DoubleType(), "note": T.StringType()})


@query("catalog_sql")
def q_catalog_sql(spark, sf):
    """Two source folders that both hold a table called places, queried by group.table."""
    def write(path: str) -> str:
        for group, table, cols in (("nations", "nation", ["n_name", "n_regionkey"]), ("regions", "region", ["r_regionkey", "r_name"])):
            io.write_csv(spark.read.parquet(f"{sf}/{table}.parquet").select(*cols), f"{path}/{group}/places.csv")
        return path

    catalog = io.Catalog.read(spark, V(spark, sf).once("catalog", write), ["nations", "regions"])
    return catalog.sql("""
        SELECT n.n_name AS nation, r.r_name AS region, (SELECT count(*) FROM {regions.places}) AS regions
        FROM {nations.places} n JOIN {regions.places} r ON n.n_regionkey = r.r_regionkey""")


@query("dates_by_column")
def q_dates_by_column(spark, sf):
    """Date columns read as a whole: the first value's form holds for the column (P5)."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        key, F.when(key % 5 == 3, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "MM/dd/yyyy")).alias("month_first"),
        F.when(key % 3 == 2, F.date_format(day, "yyyy/MM/dd")).otherwise(day.cast("string")).alias("iso"),
        F.when(key % 7 != 0, F.date_format(day, "d MMMM yyyy")).alias("late_start"))
    return clean.parse_dates(o, ["month_first", "iso", "late_start"], "o_orderkey")


@query("half_even_rates")
def q_half_even_rates(spark, sf):
    """Shares of a quantity, correctly rounded: ties only where the binary value is one (P24); percent text (P25)."""
    q = F.col("l_quantity").cast("double")
    l = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(q.alias("l_quantity")).agg(F.count("*").alias("rows"))
    q = F.col("l_quantity")
    return l.select("l_quantity", "rows", E.round_half_even(q / 80, 3).alias("eightieth"), E.round_half_even(q / 16, 3).alias("sixteenth"),
                    E.round_half_even(q / 8, 2).alias("eighth"), E.percent_text(q / 16).alias("share"))


@query("decade_shares")
def q_decade_shares(spark, sf):
    """Home wins per decade as decade label and percent text (P25), over contests with both scores."""
    c = clean.drop_incomplete(C.scored_contests(V(spark, sf).contests()), ["home_score", "away_score"])
    g = c.groupBy("decade").agg(F.count("*").alias("matches"), F.count_if(F.col("home_score") > F.col("away_score")).alias("wins"))
    return g.select(E.decade_label("decade").alias("decade"), "matches", E.percent_text(F.col("wins") / F.col("matches")).alias("home_win_share"))


@query("unified_matches")
def q_unified_matches(spark, sf):
    a = V(spark, sf).contests().select(*CONTEST_TIE, "date", "home_team", "away_team",
                                     "home_score", "away_score", "stage")
    b = clean.rename(V(spark, sf).contests_b(), {"home_goals": "home_score", "away_goals": "away_score"})
    u = C.unify_sources(a, b, ["date", "home_team", "away_team"], CONTEST_TIE)
    return u.select("date", "home_team", "away_team", "home_score", "away_score", "stage",
                    F.col("wc_year").cast("int").alias("wc_year"), "result_type")


@query("goals_by_edition")
def q_goals_by_edition(spark, sf):
    return C.goals_by_edition(V(spark, sf).contests())


@query("goals_by_decade")
def q_goals_by_decade(spark, sf):
    return C.goals_by_decade(V(spark, sf).contests())


@query("decade_lookup")
def q_decade_lookup(spark, sf):
    return C.decade_lookup(C.goals_by_decade(V(spark, sf).contests()), LOOKUP_DECADES)


@query("score_frequency_top10")
def q_score_frequency(spark, sf):
    return C.score_frequency(V(spark, sf).contests(), 10)


@query("goal_histogram_rounded")
def q_goal_histogram_rounded(spark, sf):
    """At most 15 bins of rounded width, one grid for all decades."""
    return C.rounded_histogram(C.scored_contests(V(spark, sf).contests()), "total_goals", 15, by=["decade"])


@query("order_value_histogram")
def q_order_value_histogram(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return C.rounded_histogram(o, "o_totalprice", VALUE_BINS, by=["o_orderstatus"], whole=False)


@query("goal_histogram")
def q_goal_histogram(spark, sf):
    return C.histogram(C.scored_contests(V(spark, sf).contests()), "total_goals", 15, by=["decade"])


@query("overview_kpis")
def q_overview_kpis(spark, sf):
    k = C.overview_kpis(V(spark, sf).contests())
    top = S.top_k(V(spark, sf).profiles(), "titles", 1, tie=["team"]).select("team")
    return k.withColumn("most_titles", top.scalar())


@query("edition_bounds")
def q_edition_bounds(spark, sf):
    p = V(spark, sf).panel()
    return p.agg(F.min("wc_year").alias("min_year"), F.max("wc_year").alias("max_year"),
                 F.countDistinct("confederation").alias("groups"))


@query("group_list")
def q_group_list(spark, sf):
    return S.sorted_distinct(V(spark, sf).profiles(), "confederation")


# ------------------------------------------------------------------- panels
@query("host_vs_visitor")
def q_host_vs_visitor(spark, sf):
    return P.host_vs_visitor(V(spark, sf).panel())


@query("host_wdl_means")
def q_host_wdl_means(spark, sf):
    return P.host_wdl_means(V(spark, sf).panel())


@query("host_stage_counts")
def q_host_stage_counts(spark, sf):
    return P.host_stage_counts(V(spark, sf).panel())


@query("host_by_edition")
def q_host_by_edition(spark, sf):
    return P.host_by_edition(V(spark, sf).panel())


@query("host_table")
def q_host_table(spark, sf):
    return P.host_table(V(spark, sf).panel())


@query("participation_top15")
def q_participation_top15(spark, sf):
    return P.participation_counts(V(spark, sf).panel(), k=15)


def _selected_panel(spark, sf):
    """Default selection of the heat-map page: the 15 most frequent entities
    (semi-join) over the data's whole edition range."""
    p = V(spark, sf).panel()
    return P.filter_members(p, "team", P.participation_counts(p, k=15).select("team"))


def _stage_grid(spark, sf):
    edges = S.bounds(V(spark, sf).panel(), "wc_year")
    lo, hi = (edges.select(F.col(c).cast("int")).scalar() for c in ("min_value", "max_value"))
    return P.stage_grid(_selected_panel(spark, sf), lo, hi)


@query("stage_heatmap")
def q_stage_heatmap(spark, sf):
    return _stage_grid(spark, sf).select("team", "edition", "phase_score")


@query("stage_labels")
def q_stage_labels(spark, sf):
    return _stage_grid(spark, sf).select("team", "edition", "stage")


@query("winrate_by_entity_edition")
def q_winrate_by_entity_edition(spark, sf):
    return P.winrate_by_entity_edition(_selected_panel(spark, sf))


@query("decade_top5")
def q_decade_top5(spark, sf):
    return P.decade_top(V(spark, sf).panel(), k=5)


@query("strength_correlation")
def q_strength_correlation(spark, sf):
    p = P.enrich_panel(V(spark, sf).panel())
    return S.correlation(p, "strength", "phase_score")


@query("strength_trend")
def q_strength_trend(spark, sf):
    p = P.enrich_panel(V(spark, sf).panel())
    return S.trend_line(p, "strength", "phase_score", n=100, min_points=5)


def _upset_panel(spark, sf) -> DataFrame:
    """The panel, checked for what the upset pages need."""
    return clean.require_columns(V(spark, sf).panel(), [PS.entity, PS.edition, PS.stage, PS.strength], "the upset pages' panel")


@query("upset_kpis")
def q_upset_kpis(spark, sf):
    return P.upset_kpis(_upset_panel(spark, sf))


@query("upsets_by_edition")
def q_upsets_by_edition(spark, sf):
    return P.upsets_by_edition(_upset_panel(spark, sf))


@query("upset_list")
def q_upset_list(spark, sf):
    return P.upset_list(_upset_panel(spark, sf), max_strength=UPSET_LIST_STRENGTH)


@query("upset_list_floor")
def q_upset_list_floor(spark, sf):
    """Upsets with the page's strength floor."""
    return P.upset_list(_upset_panel(spark, sf), max_strength=UPSET_LIST_STRENGTH, min_strength=STRENGTH_FLOOR)


@query("group_winrate_decade")
def q_group_winrate_decade(spark, sf):
    return P.group_winrate_decade(V(spark, sf).panel())


@query("group_stage_counts")
def q_group_stage_counts(spark, sf):
    return P.group_stage_counts(V(spark, sf).panel())


@query("group_participations")
def q_group_participations(spark, sf):
    return P.group_participations(V(spark, sf).panel())


@query("group_participations_edition")
def q_group_participations_edition(spark, sf):
    return P.group_participations(V(spark, sf).panel(), by_edition=True)


@query("outcome_targets")
def q_outcome_targets(spark, sf):
    p = P.with_targets(V(spark, sf).panel())
    return p.select("team", "wc_year", "final_stage_reached", "target_champion", "target_top4", "target_top8")


# ----------------------------------------------------------------- profiles
def _factor_profiles(spark, sf, min_matches):
    """Profiles with rates, win rate, and the external ranking."""
    prof = R.with_rates(V(spark, sf).profiles())
    prof = R.join_ranking(prof, V(spark, sf).ranking())
    return R.filter_profiles(prof, min_appearances=None, min_matches=min_matches)


@query("group_titles_share")
def q_group_titles_share(spark, sf):
    return R.group_titles_share(V(spark, sf).profiles())


@query("group_finals")
def q_group_finals(spark, sf):
    return R.group_finals(V(spark, sf).profiles())


@query("profile_ranked")
def q_profile_ranked(spark, sf):
    p = R.filter_profiles(R.with_rates(V(spark, sf).profiles()), min_appearances=MIN_APPEARANCES)
    return p.select("team", "confederation", "total_wc_appearances", "titles", "finals_reached",
                    "semis_reached", "total_matches", "total_wins", "win_rate", "goals_per_match",
                    "conceded_per_match").orderBy(F.desc("titles"), "team")


@query("profile_group")
def q_profile_group(spark, sf):
    """One group's profiles."""
    p = R.filter_profiles(V(spark, sf).profiles(), min_appearances=MIN_APPEARANCES, group=GROUP)
    return p.select("team", "confederation", "titles", "total_matches", "win_rate")


@query("titles_top15")
def q_titles_top15(spark, sf):
    return S.top_k(V(spark, sf).profiles(), "titles", 15, tie=["team"]).select(
        "team", "confederation", "total_wc_appearances", "titles", "finals_reached", "semis_reached")


@query("win_rate_top20")
def q_win_rate_top20(spark, sf):
    p = R.filter_profiles(V(spark, sf).profiles(), min_appearances=None, min_matches=MIN_MATCHES_TOP)
    return S.top_k(p, "win_rate", 20, tie=["team"]).select("team", "win_rate", "total_matches")


@query("win_rate_joined")
def q_win_rate_joined(spark, sf):
    """Profiles that lack a win rate take it from the contests."""
    p = V(spark, sf).profiles().drop("win_rate")
    p = R.add_win_rate_if_absent(p, C.two_sided_win_rate(V(spark, sf).contests()))
    return p.select("team", "total_matches", "win_rate")


@query("group_mode_top10")
def q_group_mode_top10(spark, sf):
    """The commonest group among the ten with most wins."""
    return S.mode_in_top(V(spark, sf).profiles(), "total_wins", "confederation", 10, tie=["team"])


@query("profile_leaders")
def q_profile_leaders(spark, sf):
    return R.profile_leaders(R.filter_profiles(V(spark, sf).profiles(), min_appearances=MIN_APPEARANCES))


@query("profile_bubble")
def q_profile_bubble(spark, sf):
    return R.bubble(R.filter_profiles(V(spark, sf).profiles(), min_appearances=MIN_APPEARANCES))


@query("metric_top10")
def q_metric_top10(spark, sf):
    p = _factor_profiles(spark, sf, MIN_MATCHES_TOP)
    return S.metric_top(p, "win_rate", 10).select("team", "win_rate", "total_matches")


@query("metric_bottom10_conceded")
def q_metric_bottom10(spark, sf):
    p = _factor_profiles(spark, sf, MIN_MATCHES_TOP)
    return S.metric_top(p, "conceded_per_match", 10).select("team", "conceded_per_match", "total_matches")


@query("factor_correlation_matrix")
def q_factor_correlation_matrix(spark, sf):
    return S.correlation_matrix(_factor_profiles(spark, sf, MIN_MATCHES_FACTORS), CORR_COLUMNS, min_rows=3)


@query("experience_trend")
def q_experience_trend(spark, sf):
    """Over customers: nations play every year, so their experience does not vary."""
    p = R.filter_profiles(V(spark, sf).cust_profiles(), min_appearances=None, min_matches=MIN_MATCHES_FACTORS)
    t = S.linear_trend(p, "total_wc_appearances", "win_rate", min_points=2)
    return t.select(F.bround("slope", 6).alias("slope"), F.bround("intercept", 6).alias("intercept"),
                    "points", "x_min", "x_max")


@query("experience_titles_trend")
def q_experience_titles_trend(spark, sf):
    p = R.filter_profiles(V(spark, sf).cust_profiles(), min_appearances=None, min_matches=MIN_MATCHES_FACTORS)
    t = S.linear_trend(p, "total_wc_appearances", "titles", min_points=2)
    return t.select(F.bround("slope", 6).alias("slope"), F.bround("intercept", 6).alias("intercept"),
                    "points", "x_min", "x_max")


@query("attack_defence_profile")
def q_attack_defence_profile(spark, sf):
    p = _factor_profiles(spark, sf, MIN_MATCHES_FACTORS)
    return p.select("team", "goals_per_match", "conceded_per_match").withColumns({
        "mean_goals_per_match": F.bround(p.agg(F.avg("goals_per_match")).scalar(), 6),
        "mean_conceded_per_match": F.bround(p.agg(F.avg("conceded_per_match")).scalar(), 6),
    })


@query("factor_leaders")
def q_factor_leaders(spark, sf):
    return R.factor_leaders(_factor_profiles(spark, sf, MIN_MATCHES_TOP))


@query("with_label")
def q_with_label(spark, sf):
    p = V(spark, sf).profiles().select("team", "titles")
    return R.with_label(p, "team", V(spark, sf).labels(), out="label")


# ---------------------------------------------------------------- warehouse
def _dim_team(spark, sf):
    c = V(spark, sf).contests()
    # games_played and win_rate come from one two-sided aggregate
    return W.build_dim_team(c, C.two_sided_summary(c), None, C.title_counts(V(spark, sf).editions()))


@query("dim_team")
def q_dim_team(spark, sf):
    return _dim_team(spark, sf)


@query("dim_edition")
def q_dim_edition(spark, sf):
    return W.build_dim_edition(V(spark, sf).editions())


@query("dim_stadium")
def q_dim_stadium(spark, sf):
    return W.build_dim_stadium(V(spark, sf).contests())


def _warehouse(spark, sf) -> tuple[str, dict[str, int]]:
    """(folder, rows written per table) of the warehouse, loaded once per session."""
    ws = V(spark, sf)
    return ws.once("warehouse", lambda path: (path, W.load_warehouse(spark, ws.contests(), ws.editions(), STAGES, path)))


def _table(spark, sf, name: str) -> DataFrame:
    """A table of the warehouse's current load, found through its manifest."""
    return TableSet(spark, _warehouse(spark, sf)[0]).read(name)


@query("fact_matches")
def q_fact_matches(spark, sf):
    """Keys looked up in the written dimensions."""
    return W.build_fact_matches(V(spark, sf).contests(), _table(spark, sf, "dim_team"), _table(spark, sf, "dim_stadium"))


@query("fact_team_performance")
def q_fact_team_performance(spark, sf):
    return W.with_team_id(C.two_sided_stats(V(spark, sf).contests()), _table(spark, sf, "dim_team"))


@query("fact_phase_performance")
def q_fact_phase_performance(spark, sf):
    return W.with_team_id(C.stage_matrix(V(spark, sf).contests(), STAGES), _table(spark, sf, "dim_team"))


@query("fact_head_to_head")
def q_fact_head_to_head(spark, sf):
    return W.head_to_head(V(spark, sf).contests())


@query("star_join_finals")
def q_star_join_finals(spark, sf):
    return W.star_join(spark, _table(spark, sf, "fact_matches"), _table(spark, sf, "dim_team"), FINAL_STAGE)


@query("dim_top10_winrate")
def q_dim_top10_winrate(spark, sf):
    return W.dim_top(spark, _table(spark, sf, "dim_team"), MIN_GAMES_DIM, 10)


@query("warehouse_load")
def q_warehouse_load(spark, sf):
    """The seven warehouse tables read back after the load through its manifest (S6): rows, rows
    observed during each write (S7), and a content sum over keys and measures."""
    observed = TableSet(spark, _warehouse(spark, sf)[0]).rows()
    parts = [_table(spark, sf, name).agg(F.count(F.lit(1)).alias("rows"), F.expr(f"sum({e})").cast("long").alias("content"))
             .select(F.lit(name).alias("table"), "rows", F.lit(observed[name]).cast("long").alias("observed"), "content")
             for name, e in WAREHOUSE_SUMS.items()]
    return reduce(DataFrame.unionByName, parts)


@query("edition_join")
def q_edition_join(spark, sf):
    """The latest full edition's contests by name; one partition of the facts is opened."""
    return W.edition_join(spark, _table(spark, sf, "fact_matches"), _table(spark, sf, "dim_team"), JOIN_EDITION)


@query("title_editions_join")
def q_title_editions_join(spark, sf):
    """Contests of the editions that the most frequent winner won; partitions are pruned at run time."""
    editions = _table(spark, sf, "dim_edition")
    wins = editions.where("winner IS NOT NULL").groupBy("winner").count()
    best = wins.agg(F.min_by("winner", F.struct(-F.col("count"), "winner"))).first()[0]
    return W.title_editions_join(spark, _table(spark, sf, "fact_matches"), editions, _table(spark, sf, "dim_team"), best)


@query("warehouse_reload")
def q_warehouse_reload(spark, sf):
    """Two loads with stable keys: contests between the first names, then all.

    Per team: whether the first load had it, whether the second left its key, and its home contests
    found through the second load's keys."""
    ws = V(spark, sf)
    c = ws.contests()

    def loads(path: str) -> str:
        early = c.where((F.col("home_team") < FIRST_LOAD_BELOW) & (F.col("away_team") < FIRST_LOAD_BELOW))
        W.load_warehouse(spark, early, ws.editions(), STAGES, path, stable_keys=True)
        TableSet(spark, path).read("key_team").write.parquet(f"{path}-first")
        W.load_warehouse(spark, c, ws.editions(), STAGES, path, stable_keys=True)
        return path

    path = ws.once("warehouse-reload", loads)
    now = TableSet(spark, path)
    first = spark.read.parquet(f"{path}-first").select("team_name", F.col("team_id").alias("first_id"))
    home = now.read("fact_matches").groupBy(F.col("home_team_id").alias("team_id")).agg(F.count("*").alias("home_matches"))
    return (now.read("dim_team").join(first, "team_name", "left").join(home, "team_id", "left")
            .select("team_name", F.col("first_id").isNotNull().alias("in_first_load"),
                    (F.col("first_id") == F.col("team_id")).alias("key_kept"),
                    F.coalesce("home_matches", F.lit(0)).alias("home_matches")))


# ----------------------------------------------------- pre-event features
def _cust_spec():
    return dict(gap=B.CUST_GAP, exceptions=B.CUST_GAP_EXCEPTIONS)


@query("pre_event_features")
def q_pre_event_features(spark, sf):
    return WD.pre_event_features(V(spark, sf).cust_panel(), null_policy="poison", **_cust_spec())


@query("pre_event_features_skip")
def q_pre_event_features_skip(spark, sf):
    return WD.pre_event_features(V(spark, sf).cust_panel(), null_policy="skip", **_cust_spec())


@query("streaks")
def q_streaks(spark, sf):
    s = WD.streak_columns(V(spark, sf).cust_panel(), "team", "wc_year", **_cust_spec())
    return s.select("team", "wc_year", "streak", "consecutive_wc_appearances")


# -------------------------------------------------------------------- model
def _training(spark, sf):
    return WD.pre_event_features(V(spark, sf).cust_panel(), null_policy="poison", **_cust_spec())


def _scoring(spark, sf):
    both = V(spark, sf).cust_panel().unionByName(V(spark, sf).cust_panel_next())
    feats = WD.pre_event_features(both, null_policy="poison", **_cust_spec())
    nxt = V(spark, sf).cust_panel().agg((F.max("wc_year") + 1).cast("int")).scalar()
    return feats.where(F.col("wc_year") == nxt)


def _fitted(spark, sf):
    """(model, assembled training set) of the source files' state: a saved artefact, fitted only where there is none."""
    ws = V(spark, sf)

    def load(_):
        path = ws.artefact(f"outcome-model-{MODEL_TREES}-{MODEL_DEPTH}-{MODEL_SEED}")
        if not io.exists(spark, f"{path}/forest/data/_SUCCESS"):  # written last
            model, assembled = M.fit_outcome_model(_training(spark, sf), return_data=True)
            assembled.write.mode("overwrite").parquet(f"{path}/training")
            M.save_model(model, f"{path}/forest")
        return M.load_model(f"{path}/forest"), spark.read.parquet(f"{path}/training")

    return ws.once("outcome-model", load)


def _model(spark, sf):
    return _fitted(spark, sf)[0]


@query("assembled_features")
def q_assembled_features(spark, sf):
    """The feature vector and class weight of every training row (M1, P27, weights of M2)."""
    f = M.align_features(_training(spark, sf)).select("team", "wc_year", "target_top4", *MODEL_FEATURES)
    f = M.balanced_weights(M.assemble(f), "target_top4")
    v = vector_to_array("features")
    return f.select("team", "wc_year", "target_top4", F.bround("weight", 9).alias("weight"),
                    *[v[i].alias(f"f_{name}") for i, name in enumerate(MODEL_FEATURES)])


@query("model_training_metrics")
def q_model_training_metrics(spark, sf):
    model, assembled = _fitted(spark, sf)
    return M.training_metrics(model, assembled, label="label")


@query("classification_report")
def q_classification_report(spark, sf):
    """The report with accuracy, macro and weighted averages (M3)."""
    model, assembled = _fitted(spark, sf)
    return M.classification_report(model, assembled, label="label")


@query("feature_importance")
def q_feature_importance(spark, sf):
    return M.feature_importance(_model(spark, sf))


def _scored(spark, sf):
    """Scoring table scored once per session (ranking and summary read it)."""
    return V(spark, sf).derived("scored", lambda: M.score_outcomes(_model(spark, sf), _scoring(spark, sf), ranked=False))


@query("outcome_ranking")
def q_outcome_ranking(spark, sf):
    return _scored(spark, sf).orderBy(F.desc("prob_top4"), "team")


@query("prediction_summary")
def q_prediction_summary(spark, sf):
    return M.prediction_summary(_scored(spark, sf))


# Queries checked only by row count (iterative ML fit: no SQL equivalent)
NO_ORACLE = {"model_training_metrics", "classification_report", "feature_importance", "outcome_ranking", "prediction_summary"}
