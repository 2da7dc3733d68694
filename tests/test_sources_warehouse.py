"""Sources and sinks (S1-S10), cleaning (P1-P8), warehouse (W7, J6, J7, L6); traps T7, T24."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaspark.operators import clean, warehouse as W
from arenaspark.operators.keys import merge_key_map
from arenaspark.sources import io
from arenaspark.sources.tableset import TableSet
from conftest import rows


def scratch():
    return tempfile.mkdtemp(prefix="arenaspark-test-", dir="/tmp")


def test_csv_null_tokens_ragged_and_bad_values(spark):
    d = scratch()
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("Team,Score,Day,Rank\n")
        f.write("a,3,2020-01-31,N/A\n")
        f.write("b,abc,31/31/2020,4\n")     # T24: bad number and bad date -> null
        f.write("c,4.0\n")                   # ragged row -> padded with nulls
    schema = T.StructType([T.StructField("Team", T.StringType()), T.StructField("Score", T.IntegerType()),
                           T.StructField("Day", T.DateType()), T.StructField("Rank", T.IntegerType())])
    df = io.read_csv(spark, os.path.join(d, "t.csv"), schema)
    got = {r.Team: r for r in df.collect()}
    assert got["a"].Score == 3 and got["a"].Rank is None and str(got["a"].Day) == "2020-01-31"
    assert got["b"].Score is None and got["b"].Day is None and got["b"].Rank == 4
    assert got["c"].Score == 4 and got["c"].Day is None
    low = clean.lower_headers(df)
    assert low.columns == ["team", "score", "day", "rank"]
    assert clean.rename(low, {"team": "name", "absent": "x"}).columns[0] == "name"


def test_missing_file_and_catalog(spark):
    d = scratch()
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    e = io.read_csv(spark, os.path.join(d, "nope.csv"), schema, missing_ok=True)
    assert e.count() == 0 and e.schema == schema
    for name in ("one", "two"):
        with open(os.path.join(d, f"{name}.csv"), "w") as f:
            f.write("x\n1\n2\n")
    cat = io.read_catalog(spark, d)
    assert sorted(cat) == ["one", "two"] and cat["one"].count() == 2
    try:
        io.read_catalog(spark, os.path.join(d, "missing"))
        raise AssertionError("missing folder must fail")
    except FileNotFoundError:
        pass


def test_one_parser_for_numbers(spark):
    texts = ["4", "4.0", " 7 ", "-3", "+2", "1e3", "4.5", "12d", "3f", "nan", "inf", "-Infinity", "N/A", "", None, "9223372036854775807"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ints = {r.t: r.t2 for r in clean.parse_numbers(df.withColumn("t2", F.col("t")), {"t2": "bigint"}).collect()}
    reals = {r.t: r.t2 for r in clean.parse_numbers(df.withColumn("t2", F.col("t")), {"t2": "double"}).collect()}
    want = {"4": 4, "4.0": 4, " 7 ": 7, "-3": -3, "+2": 2, "1e3": 1000, "9223372036854775807": 9223372036854775807}
    assert ints == {t: want.get(t) for t in texts}
    for t, v in {"4": 4.0, "4.5": 4.5, "1e3": 1000.0, "inf": float("inf"), "-Infinity": float("-inf")}.items():
        assert reals[t] == v
    assert all(reals[t] is None for t in ("12d", "3f", "nan", "N/A", "", None))
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r.x for r in clean.parse_numbers(nan, {"x": "double"}).collect()] == [None, 1.0]


def test_date_forms(spark):
    forms = {"1930-07-13": "1930-07-13", "1930-07-13 15:00:00": "1930-07-13", "1930-07-13T15:00:00Z": "1930-07-13",
             "1930/07/13": "1930-07-13", "07/13/1930": "1930-07-13", "13/07/1930": "1930-07-13", "01/02/2000": "2000-01-02",
             "July 13, 1930": "1930-07-13", "jul 13, 1930": "1930-07-13", "13 July 1930": "1930-07-13",
             "31/31/2020": None, "2020-02-30": None, "soon": None}
    df = spark.createDataFrame([(t, t) for t in forms], "t string, d string")
    got = {r.t: (str(r.d) if r.d else None) for r in clean.parse_dates(df, ["d"]).collect()}
    assert got == forms


def test_source_order_survives_splits(spark):
    """Keep-first takes the first row of the file for every key, however the file is cut."""
    d = scratch()
    path = os.path.join(d, "m.csv")
    with open(path, "w") as f:
        f.write("k,v\n" + "".join(f"{i % 450},{i}\n" for i in range(20000)))
    from arenaspark.operators.contests import keep_first
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = io.read_csv(spark, path, order_column="o")
        assert df.rdd.getNumPartitions() > 8
        kept = keep_first(clean.clean_rows(df, "o"), ["k"], ["o"])
        for _ in range(2):
            assert {(int(r.k), int(r.v)) for r in kept.collect()} == {(i, i) for i in range(450)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_conform_and_clean(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "x int, y string")
    c = io.conform(df, {"y": T.StringType(), "z": T.IntegerType()}, {"z": 0})
    assert c.columns == ["y", "z"] and rows(c, "z") == [(0,), (0,), (0,)]
    assert clean.clean_rows(df).count() == 1           # de-dup + drop all-null rows
    assert clean.drop_incomplete(df, ["x", "absent"]).count() == 2
    try:
        clean.require_columns(df, ["x", "w"])
        raise AssertionError
    except ValueError as e:
        assert "w" in str(e)


def test_write_table_reports_rows(spark):
    d = scratch()
    df = spark.range(123).withColumn("g", F.col("id") % 3)
    assert io.write_table(df, os.path.join(d, "t"), partition_by=["g"]) == 123
    assert spark.read.parquet(os.path.join(d, "t")).count() == 123
    assert io.write_csv(df.repartition(3), os.path.join(d, "p")) == 123
    assert len([f for f in os.listdir(os.path.join(d, "p")) if f.endswith(".csv")]) == 3
    assert io.write_csv(df.repartition(3), os.path.join(d, "c"), single_file=True) == 123
    assert len([f for f in os.listdir(os.path.join(d, "c")) if f.endswith(".csv")]) == 1


def contests(spark):
    return spark.createDataFrame([
        ("2000-01-01", "a", "b", 2, 1, "final", "x", "p"),
        ("2000-01-02", "b", "c", 0, 0, "group", "x", "q"),     # T7: venue x in two cities
        ("2000-01-03", "c", "a", 1, 3, "final", "y", "p"),
    ], "date string, home_team string, away_team string, home_score int, away_score int, stage string, "
       "stadium string, city string").withColumn("date", F.to_date("date"))


def test_star_schema(spark):
    c = contests(spark)
    dim_team = W.build_dim_team(c)
    assert rows(dim_team, "team_name", "team_id") == [("a", 1), ("b", 2), ("c", 3)]
    dim_st = W.build_dim_stadium(c)
    assert rows(dim_st, "stadium", "city", "stadium_id") == [("x", "p", 1), ("x", "q", 2), ("y", "p", 3)]
    fact = W.build_fact_matches(c, dim_team, dim_st)
    assert fact.count() == 3                               # no fan-out on the stadium lookup
    assert rows(fact, "home_team_id", "stadium_id", "result") == [(1, 1, "H"), (2, 2, "D"), (3, 3, "A")]
    fin = W.star_join(spark, fact, dim_team, "final").collect()
    assert [(r.home_team, r.away_team) for r in fin] == [("a", "b"), ("c", "a")]
    h2h = {(r.team_a, r.team_b): r for r in W.head_to_head(c).collect()}
    assert h2h[("a", "c")].team_a_wins == 1 and h2h[("a", "c")].team_a_goals == 3
    counts = TableSet(spark, scratch()).load({"dim_team": dim_team, "fact_matches": fact})
    assert counts == {"dim_team": 3, "fact_matches": 3}


def test_table_set_is_replaced_whole_or_not_at_all(spark):
    s = TableSet(spark, scratch())
    assert s.tables() == [] and s.manifest() is None
    names = [f"t{i}" for i in range(7)]
    s.load({n: spark.range(10 + i) for i, n in enumerate(names)})
    assert s.rows() == {n: 10 + i for i, n in enumerate(names)}
    held = s.read("t0")                                     # a reader of the first load

    bad = spark.range(5).select(F.raise_error(F.lit("broken source")).alias("id"))
    for tables in ({**{n: spark.range(3) for n in names[:3]}, "t3": bad}, {"t0": spark.range(1), "t1": lambda read: read("absent")}):
        try:
            s.load(tables)
            raise AssertionError("the load must fail")
        except AssertionError:
            raise
        except Exception:  # noqa: BLE001 - whatever the store or the job raises
            pass
        assert {n: s.read(n).count() for n in names} == {n: 10 + i for i, n in enumerate(names)}
        assert len(s._versions()) == 1                      # nothing of the failed load is left

    s.load({n: spark.range(2) for n in names[1:]} | {"t9": lambda read: read("t1").union(read("t2"))})
    assert s.tables() == names[1:] + ["t9"] and s.read("t9").count() == 4 and s.read("t3").count() == 2
    assert held.count() == 10                               # still readable
    s.load({"t1": spark.range(1)})
    assert len(s._versions()) == 2 and s.manifest()["previous"] is not None
    try:
        s.read("t9")
        raise AssertionError
    except KeyError:
        pass


def test_stable_keys_survive_new_names_and_collisions(spark):
    def names(*n):
        return spark.createDataFrame([(x,) for x in n], "name string")

    first = merge_key_map(None, names("b", "c", None, "b"), ["name"], "id")
    one = {r.name: r.id for r in first.collect()}
    assert len(one) == 3 and len(set(one.values())) == 3
    two = {r.name: r.id for r in merge_key_map(first, names("a", "b", "d"), ["name"], "id").collect()}
    assert {k: two[k] for k in one} == one and set(two) == {"a", "b", "c", "d", None} and len(set(two.values())) == 5

    def poor(*cols):  # salt 0 and 1: one value for all; later salts: the real hash, cut to three values
        *own, salt = cols
        return F.when(salt < 2, F.lit(7).cast("bigint")).otherwise(F.pmod(F.xxhash64(*own, salt), F.lit(3)))

    forced = merge_key_map(None, names("x", "y", "z"), ["name"], "id", hash_of=poor)
    a = {r.name: r.id for r in forced.collect()}
    assert len(set(a.values())) == 3 and a["x"] == 7        # the smallest name keeps the shared hash
    b = {r.name: r.id for r in merge_key_map(forced, names("w", "x"), ["name"], "id", hash_of=poor).collect()}
    assert {k: b[k] for k in a} == a and len(set(b.values())) == 4


def test_warehouse_reload_with_stable_keys(spark):
    c = contests(spark).withColumn("stage", F.lit("final"))
    editions = spark.createDataFrame([(2000, "p", "a", 3)], "year int, host_country string, winner string, teams int")
    root = scratch()
    W.load_warehouse(spark, c.where("home_team = 'b'"), editions, ["final"], root, stable_keys=True)
    s = TableSet(spark, root)
    old = {r.team_name: r.team_id for r in s.read("dim_team").collect()}
    assert set(old) == {"b", "c"}
    W.load_warehouse(spark, c, editions, ["final"], root, stable_keys=True)
    new = {r.team_name: r.team_id for r in s.read("dim_team").collect()}
    assert set(new) == {"a", "b", "c"} and all(new[t] == k for t, k in old.items())
    assert s.rows()["fact_matches"] == 3 and s.rows()["dim_stadium"] == 3
    keyed = {(r.home_team_id, r.away_team_id) for r in s.read("fact_matches").collect()}
    assert keyed == {(new["a"], new["b"]), (new["b"], new["c"]), (new["c"], new["a"])}
