"""Records over several lines (S1, S3), two-level catalog (S2), dates by column (P5), correct rounding (P24), bins (A9), report (M3), artefact (M2)."""

import csv
import os
import random
import struct
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaspark.functions.exprs import percent_text, round_half_even
from arenaspark.operators import clean, contests as C, model as M
from arenaspark.plans import queries as Q
from arenaspark.plans.workspace import workspace
from arenaspark.sources import io
from conftest import SF_SMALL


def scratch():
    return tempfile.mkdtemp(prefix="arenaspark-test-", dir="/tmp")


@pytest.mark.parametrize("block, end", [(200, "\n"), (4096, "\r\n"), (1 << 20, "\n")])
def test_records_over_lines_keep_content_and_order(spark, block, end):
    """Records with breaks, quotes and commas, cut into many blocks, one record longer than several blocks."""
    rng = random.Random(5)
    rows = [(str(i), rng.choice(["plain", 'say "hi"', "two\nlines", '\n"a"\n\n,b\n', "", "x, y", "long\n" * rng.choice([1, 2, 300])]), f"t{i}")
            for i in range(400)]
    path = os.path.join(scratch(), "notes.csv")
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["k", "note\nhead", "t"])
        w.writerows(rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        df = io.read_csv(spark, path, order_column="o", null_tokens=["N/A"])
        assert df.columns == ["k", "note\nhead", "t", "o"]
        got = [(r[0], r[1] or "", r[2]) for r in df.orderBy("o").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == rows


def test_schema_and_ragged_records_over_lines(spark):
    path = os.path.join(scratch(), "r.csv")
    with open(path, "w") as f:
        f.write('k,v,d\n1,"a\nb",2020-01-02\n2\n\n3,"c",x\n4,"open\nend,4')
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType()), T.StructField("d", T.DateType())])
    got = [(r.k, r.v, str(r.d) if r.d else None) for r in io.read_csv(spark, path, schema, order_column="o").orderBy("o").collect()]
    assert got[:3] == [(1, "a\nb", "2020-01-02"), (2, None, None), (3, "c", None)]
    assert got[3][0] == 4  # a quote that is never closed: the rest of the file is one record


def test_catalog_keeps_equal_names_apart(spark):
    root = scratch()
    for group, n in (("one", 2), ("two", 5)):
        os.makedirs(f"{root}/{group}")
        with open(f"{root}/{group}/same.csv", "w") as f:
            f.write("x\n" + "".join(f"{i}\n" for i in range(n)))
    with open(f"{root}/two/other.csv", "w") as f:
        f.write("x,y\n1,a\n")
    c = io.Catalog.read(spark, root, ["one", "two"])
    assert sorted(c) == ["one.same", "two.other", "two.same"] and len(c) == 3
    assert c["one.same"].count() == 2 and c["two.same"].count() == 5 and c["other"].count() == 1
    with pytest.raises(ValueError):
        c["same"]
    assert c.get("absent") is None
    assert c.sql("SELECT count(*) AS n FROM {one.same} a JOIN {two.same} b ON a.x = b.x WHERE a.x < {top}", top=9).first().n == 2
    views = c.register("p_")
    assert sorted(views) == ["p_one__same", "p_two__other", "p_two__same"]
    assert spark.sql("SELECT count(*) AS n FROM p_two__same").first().n == 5
    other = spark.newSession()
    assert not other.catalog.tableExists("p_two__same")


def test_first_value_gives_the_form_of_a_date_column(spark):
    rows = [(1, None, "2000-01-02 10:00:00", "13/02/2000", "soon"), (2, "01/02/2000", "2000-01-03", "01/02/2000", "2001-01-01"),
            (3, "13/02/2000", "2000-01-04 00:00:01", "02/13/2000", "5/6/2001"), (4, "2000-01-01", None, None, None)]
    df = spark.createDataFrame(rows, "o int, a string, b string, c string, d string")
    got = {r.o: [str(x) if x else None for x in r[1:]] for r in clean.parse_dates(df, ["a", "b", "c", "d"], "o").collect()}
    assert got[1] == [None, "2000-01-02", "2000-02-13", None]
    assert got[2] == ["2000-01-02", None, "2000-02-01", "2001-01-01"]   # d: no form at first, so value by value
    assert got[3] == [None, "2000-01-04", None, "2001-05-06"]
    assert got[4] == [None] * 4
    months = spark.createDataFrame([(1, "2 July 1997"), (2, "1 May 1995"), (3, "1 Jun 1995"), (4, "1 January 1995")], "o int, a string")
    got = [str(r.a) if r.a else None for r in clean.parse_dates(months, ["a"], "o").orderBy("o").collect()]
    assert got == ["1997-07-02", "1995-05-01", None, "1995-01-01"]
    by_value = {r.o: r.a for r in clean.parse_dates(df, ["a"]).collect()}
    assert str(by_value[3]) == "2000-02-13"


def test_rounding_equals_python(spark):
    rng = random.Random(11)
    values = [0.0125, 0.0625, 0.5, 1.5, 2.5, -0.0125, -2.5, 1e22, -1e300, 5e-324, 0.0, 2.675, 1.005, 4503599627370497.5, float("inf")]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 9) for _ in range(60_000)]
    values += [k / d for d in (16, 80, 160, 7, 400) for k in range(-400, 4000)]
    values += [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(20_000)]
    values = [v for v in values if v == v]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    for digits in (0, 1, 3, 6):
        bad = [(r.x, r.y) for r in df.select("x", round_half_even("x", digits).alias("y")).collect()
               if abs(r.x) < 2 ** 52 / 10 ** digits and r.y != round(r.x, digits)]
        assert not bad, bad[:5]
    assert spark.range(1).select(round_half_even(F.lit(None).cast("double"), 3)).first()[0] is None
    texts = spark.createDataFrame([(0.0625,), (0.125,), (1.0,)], "x double").select(percent_text("x").alias("t")).collect()
    assert [r.t for r in texts] == ["6.2%", "12.5%", "100.0%"]


@pytest.mark.parametrize("values, bins, whole, step", [
    ([0, 1, 2, 8], 15, True, 1.0), ([0, 30], 15, True, 5.0), ([0, 29], 15, True, 2.0), ([3, 3], 15, True, 1.0),
    ([0.0, 0.9], 10, False, 0.1), ([-7.0, 1200.0], 10, False, 200.0)])
def test_rounded_bins(spark, values, bins, whole, step):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = C.rounded_histogram(df, "v", bins, whole=whole).collect()
    assert {r.step for r in got} == {step} and sum(r["count"] for r in got) == len(values)
    assert (max(values) // step - min(values) // step + 1) <= bins


def test_report_averages(spark):
    rows = {r.row: r for r in Q.REGISTRY["classification_report"](spark, SF_SMALL).collect()}
    assert set(rows) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    n0, n1 = rows["0"].support, rows["1"].support
    for c in ("precision", "recall", "f1"):
        assert rows["macro avg"][c] == pytest.approx((rows["0"][c] + rows["1"][c]) / 2, abs=2e-6)
        assert rows["weighted avg"][c] == pytest.approx((rows["0"][c] * n0 + rows["1"][c] * n1) / (n0 + n1), abs=2e-6)
    assert rows["weighted avg"].recall == pytest.approx(rows["accuracy"].precision, abs=2e-6)


def test_model_is_an_artefact_of_the_source_state(spark, monkeypatch):
    fits = []
    real = M.fit_outcome_model
    monkeypatch.setattr(M, "fit_outcome_model", lambda *a, **k: (fits.append(1), real(*a, **k))[1])
    spark.conf.set("arenaspark.workspace.dir", scratch())
    try:
        from arenaspark.plans import workspace as module
        module._SPACES.clear()
        first = [tuple(r) for r in Q.REGISTRY["feature_importance"](spark, SF_SMALL).collect()]
        path = workspace(spark, SF_SMALL).artefact("x")
        module._SPACES.clear()                              # as in another session: nothing kept in memory
        again = [tuple(r) for r in Q.REGISTRY["feature_importance"](spark, SF_SMALL).collect()]
        assert first == again and len(fits) == 1
        monkeypatch.setattr(module, "_state", lambda *_: "changed")
        module._SPACES.clear()
        Q.REGISTRY["feature_importance"](spark, SF_SMALL).collect()
        assert len(fits) == 2 and workspace(spark, SF_SMALL).artefact("x") != path
    finally:
        spark.conf.unset("arenaspark.workspace.dir")
        module._SPACES.clear()
