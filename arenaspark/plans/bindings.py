"""Views over the driver's tables in the three shapes the operators expect.

* ``contests``   one row per line item: home = supplier nation, away = customer
                 nation, scores from quantity and line number, date and stage
                 from the order, venue from the part brand, city from the home
                 region.
* ``contests_b`` a second contest source with other column names (returned
                 line items seen from the customer side), for the union and
                 keep-first de-duplication.
* ``panel``      nation x order year, every nation of the year, with a stage.
* ``cust_panel`` customer x order year for the leakage-free feature step.
* ``profiles``   all-time sums of ``panel`` per nation.
* ``editions``   one row per year: host, winner, qualifier count.
* ``ranking``    nations ranked by supplier balance; some are spelled
                 differently there, so the join by name leaves them unranked.
* ``labels``     display tag per nation (region code).

Every view is lazy: Catalyst prunes the columns a query does not use and
pushes its filters into the Parquet scans. The nation and region dimensions
are broadcast behind a row-count check; all other joins are left to AQE,
which broadcasts by runtime size and otherwise shuffles (and splits skewed
partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arenaspark.session import broadcast_if_small

DIM_MAX_ROWS = 10_000

# Stage of a nation by its position in the year (1 = winner); the last reaches to the end
PANEL_STAGES = [
    (1, 1, "Winner"), (2, 2, "Runner-up"), (3, 3, "Third place"), (4, 4, "Fourth place"),
    (5, 8, "Quarter-finals"), (9, 12, "Round of 16"), (13, None, "Group stage"),
]
# Stage labels of the customer panel, weakest first
CUST_STAGES = ["Group stage", "Round of 16", "Quarter-finals", "Semi-finals",
               "Fourth place", "Third place", "Runner-up", "Winner"]
CUST_GAP = 1
CUST_GAP_EXCEPTIONS = ((1997, 1999),)
# The ranking spells every eighth nation its own way (trap T17)
RANKING_SPELLING = (8, 7, "Rep. of ")


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _dim(spark: SparkSession, sf: str, name: str, cols: list[str]) -> DataFrame:
    df = _t(spark, sf, name).select(*cols)
    return broadcast_if_small(df, DIM_MAX_ROWS)


def nations(spark: SparkSession, sf: str) -> DataFrame:
    """n_nationkey, n_name, n_regionkey, r_name (both dimensions broadcast)."""
    n = _dim(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = _dim(spark, sf, "region", ["r_regionkey", "r_name"])
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").drop("r_regionkey")


def contests(spark: SparkSession, sf: str, venue: bool = False, city: bool = False,
             raw_text: bool = False, keep_raw_text: bool = False) -> DataFrame:
    """Contest view. ``venue``/``city`` add the part and region enrichments
    only when a query needs them (left joins on a foreign key: same rows).
    ``raw_text`` keeps stage / venue / city as stored (not normalised);
    ``keep_raw_text`` adds the stored text next to the normalised columns
    (raw_stage, raw_stadium, raw_city)."""
    txt = (lambda c: F.col(c)) if raw_text else (lambda c: F.lower(c))
    nat = _dim(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    sup = (_t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
           .join(nat.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("home_team"),
                            F.col("n_regionkey").alias("home_region")), "s_nationkey"))
    cus = (_t(spark, sf, "customer").select("c_custkey", "c_nationkey")
           .join(nat.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("away_team")),
                 "c_nationkey"))
    ords = (_t(spark, sf, "orders")
            .select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("date"),
                    txt("o_orderpriority").alias("stage"), F.col("o_orderpriority").alias("raw_stage"))
            .join(cus, F.col("o_custkey") == F.col("c_custkey")))
    li = _t(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supp_key"),
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("return_flag"))
    c = (li.join(ords, F.col("order_key") == F.col("o_orderkey"))
         .join(sup, F.col("supp_key") == F.col("s_suppkey")))
    cols: list[Column] = [
        "order_key", "line_no", "part_key", "supp_key", "qty", "price", "return_flag",
        F.col("s_nationkey").alias("home_key"), F.col("c_nationkey").alias("away_key"),
        "home_team", "away_team",
        (F.col("qty").cast("int") % 6).alias("home_score"),
        (F.col("line_no") % 4).alias("away_score"),
        "date", "stage",
    ]
    if venue:
        part = _t(spark, sf, "part").select("p_partkey", txt("p_brand").alias("stadium"),
                                            F.col("p_brand").alias("raw_stadium"))
        c = c.join(part, F.col("part_key") == F.col("p_partkey"), "left")
        cols.append("stadium")
        if keep_raw_text:
            cols.append("raw_stadium")
    if city:
        reg = _dim(spark, sf, "region", ["r_regionkey", "r_name"])
        c = c.join(reg, F.col("home_region") == F.col("r_regionkey"), "left")
        cols.append(txt("r_name").alias("city"))
        if keep_raw_text:
            cols.append(F.col("r_name").alias("raw_city"))
    if keep_raw_text:
        cols.append("raw_stage")
    return c.select(*cols)


def contests_b(spark: SparkSession, sf: str) -> DataFrame:
    """Second contest source, its own column names (home_goals, away_goals,
    wc_year, result_type): returned line items seen from the customer side."""
    nat = _dim(spark, sf, "nation", ["n_nationkey", "n_name"])
    sup = (_t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
           .join(nat.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("away_team")),
                 "s_nationkey"))
    cus = (_t(spark, sf, "customer").select("c_custkey", "c_nationkey")
           .join(nat.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home_team")),
                 "c_nationkey"))
    ords = (_t(spark, sf, "orders")
            .select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("date"),
                    F.lower("o_orderpriority").alias("stage"))
            .join(cus, F.col("o_custkey") == F.col("c_custkey")))
    li = (_t(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supp_key"),
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price")))
    c = (li.join(ords, F.col("order_key") == F.col("o_orderkey"))
         .join(sup, F.col("supp_key") == F.col("s_suppkey")))
    return c.select(
        "order_key", "line_no", "part_key", "supp_key", "qty", "price", "home_team", "away_team",
        (F.col("line_no") % 4).alias("home_goals"), (F.col("qty").cast("int") % 6).alias("away_goals"),
        "date", "stage", F.year("date").alias("wc_year"), F.lit("returned").alias("result_type"))


def contests_b_from(contest_view: DataFrame) -> DataFrame:
    """``contests_b`` derived from an already built contest view: the same
    returned line items with the sides swapped (identical rows to the
    raw-table definition, without redoing its joins)."""
    c = contest_view.where(F.col("return_flag") == "R")
    return c.select(
        "order_key", "line_no", "part_key", "supp_key", "qty", "price",
        F.col("away_team").alias("home_team"), F.col("home_team").alias("away_team"),
        F.col("away_score").alias("home_goals"), F.col("home_score").alias("away_goals"),
        "date", "stage", F.year("date").alias("wc_year"), F.lit("returned").alias("result_type"))


def _panel_stage(pos: Column) -> Column:
    e = None
    for lo, hi, name in PANEL_STAGES:
        cond = pos >= lo if hi is None else pos.between(lo, hi)
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return e


def panel(spark: SparkSession, sf: str, contest_view: DataFrame | None = None) -> DataFrame:
    """Nation x year panel: record from both sides of every contest, position
    within the year by a fixed rule, the stage it stands for, host and strength.

    The record is one partial aggregate over the contest view (map-side
    combine: a hot nation never lands whole in one task); the per-year window
    runs over the aggregated (year x nation) rows only.
    """
    c = contest_view if contest_view is not None else contests(spark, sf)
    k = F.struct(F.col("home_key").alias("k"), F.col("home_score").alias("gf"), F.col("away_score").alias("ga"))
    a = F.struct(F.col("away_key").alias("k"), F.col("away_score").alias("gf"), F.col("home_score").alias("ga"))
    lf = c.select(F.year("date").alias("wc_year"), F.inline(F.array(k, a)))
    rec = lf.groupBy("wc_year", "k").agg(
        F.count(F.lit(1)).alias("matches_played"),
        F.count_if(F.col("gf") > F.col("ga")).alias("wins"),
        F.count_if(F.col("gf") == F.col("ga")).alias("draws"),
        F.count_if(F.col("gf") < F.col("ga")).alias("losses"),
        F.sum("gf").cast("long").alias("goals_scored"),
        F.sum("ga").cast("long").alias("goals_conceded"),
    )
    order = (F.col("k") * 7 + F.col("wc_year") * 11 + F.col("wins")) % 101
    w = Window.partitionBy("wc_year").orderBy(order.desc(), F.col("k").asc())
    q = rec.withColumn("pos", F.row_number().over(w))
    nat = nations(spark, sf)
    q = q.join(nat, q["k"] == nat["n_nationkey"], "left")
    return q.select(
        F.col("n_name").alias("team"), F.col("r_name").alias("confederation"), "wc_year",
        _panel_stage(F.col("pos")).alias("final_stage_reached"),
        "matches_played", "wins", "draws", "losses", "goals_scored", "goals_conceded",
        (F.col("goals_scored") - F.col("goals_conceded")).alias("goal_difference"),
        F.when(F.col("k") == (F.col("wc_year") * 7) % 25, "Yes").otherwise("No").alias("host_nation"),
        (F.lit(1400) + (F.col("k") * 37 + F.col("wc_year") * 11) % 600).alias("elo_rating_approx"),
        F.col("k").alias("nation_key"),
    )


def cust_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Customer x year panel. A year in which all of a customer's orders are
    still pending has no result: its record and stage are null (this is what
    exercises the null policies of the feature step)."""
    o = _t(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("wc_year"), "o_orderstatus",
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("prio"))
    rec = o.groupBy("custkey", "wc_year").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("op"),
        F.sum("prio").cast("long").alias("prio"),
    )
    rated = (F.col("f") + F.col("op")) > 0
    stage_idx = ((F.col("f") * 3 + F.col("prio") + F.col("wc_year")) % 8 + 1).cast("int")
    stages = F.array(*[F.lit(s) for s in CUST_STAGES])
    cus = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nat = nations(spark, sf)
    cus = cus.join(nat, cus["c_nationkey"] == nat["n_nationkey"], "left")
    j = rec.join(cus, rec["custkey"] == cus["c_custkey"])
    return j.select(
        F.col("c_name").alias("team"), F.col("r_name").alias("confederation"), "wc_year",
        F.when(rated, F.element_at(stages, stage_idx)).alias("final_stage_reached"),
        F.when(rated, F.col("n")).alias("matches_played"),
        F.when(rated, F.col("f")).alias("wins"),
        F.when(rated, F.col("n") - F.col("f") - F.col("op")).alias("draws"),
        F.when(rated, F.col("op")).alias("losses"),
        F.when(rated, F.col("prio")).alias("goals_scored"),
        F.when(rated, F.col("op")).alias("goals_conceded"),
        F.when(F.col("c_nationkey") == (F.col("wc_year") * 7) % 25, "Yes").otherwise("No").alias("host_nation"),
        (F.lit(1400) + (F.col("custkey") * 37 + F.col("wc_year") * 11) % 600).alias("elo_rating_approx"),
        F.col("custkey"), F.col("c_nationkey"),
    )


def profiles(spark: SparkSession, sf: str, panel_view: DataFrame | None = None) -> DataFrame:
    """All-time row per nation from the panel."""
    p = panel_view if panel_view is not None else panel(spark, sf)
    st = F.col("final_stage_reached")
    g = p.groupBy("team", "confederation").agg(
        F.count(F.lit(1)).alias("total_wc_appearances"),
        F.sum("matches_played").cast("long").alias("total_matches"),
        F.sum("wins").cast("long").alias("total_wins"),
        F.sum("draws").cast("long").alias("total_draws"),
        F.sum("losses").cast("long").alias("total_losses"),
        F.sum("goals_scored").cast("long").alias("total_goals_scored"),
        F.sum("goals_conceded").cast("long").alias("total_goals_conceded"),
        F.count_if(st == "Winner").alias("titles"),
        F.count_if(st.isin("Winner", "Runner-up")).alias("finals_reached"),
        F.count_if(st.isin("Winner", "Runner-up", "Third place", "Fourth place")).alias("semis_reached"),
        F.count_if(st.isin("Winner", "Runner-up", "Third place", "Fourth place", "Quarter-finals"))
        .alias("quarters_reached"),
        F.min("wc_year").alias("first_wc_year"), F.max("wc_year").alias("last_wc_year"),
        F.count_if(F.col("host_nation") == "Yes").alias("host_times"),
    )
    return g.withColumns({
        "goal_difference": F.col("total_goals_scored") - F.col("total_goals_conceded"),
        "win_rate": F.bround(F.when(F.col("total_matches") > 0,
                                    F.col("total_wins") / F.col("total_matches")).otherwise(0.0), 6),
    })


def editions(spark: SparkSession, sf: str, panel_view: DataFrame | None = None) -> DataFrame:
    """One row per year: host nation (by rule), winner, number of nations."""
    p = panel_view if panel_view is not None else panel(spark, sf)
    y = p.groupBy("wc_year").agg(
        F.max(F.when(F.col("final_stage_reached") == "Winner", F.col("team"))).alias("winner"),
        F.count(F.lit(1)).alias("teams"))
    nat = _dim(spark, sf, "nation", ["n_nationkey", "n_name"])
    y = y.join(nat, (y["wc_year"] * 7) % 25 == nat["n_nationkey"], "left")
    return y.select(F.col("wc_year").alias("year"), F.col("n_name").alias("host_country"), "winner", "teams")


def ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Nations ranked by summed supplier balance (in cents), under the names of
    the ranking, some of which the other views spell differently (trap T17)."""
    s = _t(spark, sf, "supplier").select("s_nationkey", "s_acctbal")
    g = s.groupBy("s_nationkey").agg(F.sum(F.round(F.col("s_acctbal") * 100).cast("long")).alias("points"))
    every, rest, prefix = RANKING_SPELLING
    spelled = F.when(F.col("n_nationkey") % every == rest, F.concat(F.lit(prefix), "n_name")).otherwise(F.col("n_name"))
    nat = _dim(spark, sf, "nation", ["n_nationkey", "n_name"]).withColumn("n_name", spelled)
    g = g.join(nat, g["s_nationkey"] == nat["n_nationkey"]).withColumn("__neg", -F.col("points"))
    # rank 1..n by (points desc, name): the distributed dense-key operator,
    # not a window over one partition
    from arenaspark.operators.windows import dense_keys

    r = dense_keys(g.select("n_name", "points", "__neg"), ["__neg", "n_name"], "rank")
    return r.select(F.col("n_name").alias("team"), F.col("rank").cast("int").alias("rank"), "points")


def labels(spark: SparkSession, sf: str, ranking_view: DataFrame | None = None) -> DataFrame:
    """Display tag per *ranked* nation: '[' + first three letters of its
    region + ']'. Unranked nations have no tag (they keep their bare name)."""
    nat = nations(spark, sf)
    rk = (ranking_view if ranking_view is not None else ranking(spark, sf)).select(F.col("team").alias("n_name"))
    return nat.join(rk, "n_name", "left_semi").select(
        F.col("n_name").alias("name"),
        F.concat(F.lit("["), F.upper(F.substring("r_name", 1, 3)), F.lit("]")).alias("tag"))


def cust_panel_next(spark: SparkSession, sf: str, cust_view: DataFrame | None = None) -> DataFrame:
    """One placeholder row per customer for the edition after the last one in
    the data (the scoring table of the outcome model): host and strength by
    the same rules, no result yet."""
    cp = cust_view if cust_view is not None else cust_panel(spark, sf)
    nxt = cp.agg((F.max("wc_year") + 1).cast("int")).scalar()
    ents = cp.select("team", "confederation", "custkey", "c_nationkey").distinct()
    return ents.select(
        "team", "confederation", nxt.alias("wc_year"),
        F.lit(None).cast("string").alias("final_stage_reached"),
        *[F.lit(None).cast("long").alias(c) for c in
          ("matches_played", "wins", "draws", "losses", "goals_scored", "goals_conceded")],
        F.when(F.col("c_nationkey") == (nxt * 7) % 25, "Yes").otherwise("No").alias("host_nation"),
        (F.lit(1400) + (F.col("custkey") * 37 + nxt * 11) % 600).alias("elo_rating_approx"),
        "custkey", "c_nationkey")
