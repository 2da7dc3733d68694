"""Outcome model (M1-M6) and the streaming upkeep of the team table."""

import tempfile

from pyspark.sql import functions as F

from arenaspark.operators import model as M
from arenaspark.operators.windows import pre_event_features
from arenaspark.plans import bindings as B
from conftest import SF_SMALL


def test_model_metrics_identities(spark):
    train = pre_event_features(B.cust_panel(spark, SF_SMALL), gap=B.CUST_GAP, exceptions=B.CUST_GAP_EXCEPTIONS)
    n = train.count()
    model = M.fit_outcome_model(train, trees=20, depth=4)
    met = M.training_metrics(model, train).collect()
    assert sum(r.support for r in met) == n
    assert all(0.0 <= r.accuracy <= 1.0 and 0.0 <= r.f1 <= 1.0 for r in met)
    imp = M.feature_importance(model).collect()
    assert len(imp) == 6 and abs(sum(r.importance for r in imp) - 1.0) < 1e-4
    scored = M.score_outcomes(model, train)
    assert scored.count() == n
    assert scored.agg(F.min("prob_top4"), F.max("prob_top4")).first()[0] >= 0.0
    s = M.prediction_summary(scored).first()
    assert s.scored == n and s.dominant_count >= 1 and s.leader is not None


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1.0,)] * 3 + [(0.0,)] * 9, "label double")
    w = {r.label: r.weight for r in M.balanced_weights(df, "label").distinct().collect()}
    assert abs(w[1.0] - 12 / (2 * 3)) < 1e-12 and abs(w[0.0] - 12 / (2 * 9)) < 1e-12


def test_streaming_team_table_equals_batch(spark):
    from arenaspark.operators.contests import two_sided_summary
    from arenaspark.streaming import latest_team_table, running_team_table

    d = tempfile.mkdtemp(prefix="arenaspark-stream-", dir="/tmp")
    c = B.contests(spark, SF_SMALL).select("home_team", "away_team", "home_score", "away_score", "date", "stage")
    c.where("date < '1998-01-01'").write.parquet(d + "/src/p1")
    running_team_table(spark, d + "/src/*", c.schema, d + "/out", checkpoint=d + "/ckpt").awaitTermination()
    c.where("date >= '1998-01-01'").write.parquet(d + "/src/p2")
    running_team_table(spark, d + "/src/*", c.schema, d + "/out", checkpoint=d + "/ckpt").awaitTermination()
    assert len(spark.streams.active) == 0
    got = latest_team_table(spark, d + "/out")
    exp = two_sided_summary(c)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
