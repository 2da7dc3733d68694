"""Outcome model (M1-M6) with Spark ML.

Random forest with balanced class weights, in-sample metrics from the
confusion counts, feature importances, ranked scoring. Training data is cut
from its lineage with a reliable checkpoint before the fit, so a lost
executor during the many tree passes recomputes from the checkpoint, not from
the raw tables.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaspark.constants import MODEL_DEPTH, MODEL_FEATURES, MODEL_SEED, MODEL_TREES
from arenaspark.functions.exprs import round_half_even
from arenaspark.session import broadcast_if_small, cut_lineage
from arenaspark.operators.stats import arg_best, mode_in_top


def spread(df: DataFrame) -> DataFrame:
    """Spread the rows over all cores before CPU-heavy model work.

    Small inputs arrive in one or two partitions (AQE coalesces small
    shuffles); a forest fit or a 300-tree prediction on them would run on one
    core. A rebalance by the session's partition count (at least one per core)
    never merges a large input into fewer, larger partitions than that.
    """
    conf = df.sparkSession.conf
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, int(conf.get("spark.sql.shuffle.partitions"))))


def align_features(df: DataFrame, renames: dict[str, str] | None = None,
                   flags: Sequence[str] = ("host_nation", "is_debut"),
                   features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Give a scoring table the training table's feature columns (P27):
    rename (e.g. a current-strength column to ``elo_rating``), turn yes/no
    text flags into 0/1, and coerce every feature to a number."""
    from arenaspark.functions.exprs import yes_no_flag
    from arenaspark.sources.io import parse_number

    out = df
    for old, new in (renames or {}).items():
        if old in out.columns:
            out = out.withColumn(new, F.col(old))
    for f in flags:
        if f in out.columns and dict(out.dtypes)[f] == "string":
            out = out.withColumn(f, yes_no_flag(f))
    return out.withColumns({f: parse_number(F.col(f).cast("string"), "double") if f in out.columns
                            else F.lit(None).cast("double") for f in features})


def assemble(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Missing feature values -> 0, then one vector column."""
    filled = df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """weight = n / (classes * n_class), as 'balanced' class weighting.

    The per-class counts table has one row per class; the totals are windows
    over that tiny table, and it is broadcast only after checking its bound.
    """
    from pyspark.sql import Window

    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    every = Window.partitionBy()
    counts = counts.withColumn(
        "weight", F.sum("__nc").over(every) / (F.count(F.lit(1)).over(every) * F.col("__nc"))).drop("__nc")
    return df.join(broadcast_if_small(counts, 1000), label)


def fit_outcome_model(train: DataFrame, label: str = "target_top4",
                      features: Sequence[str] = MODEL_FEATURES, trees: int = MODEL_TREES,
                      depth: int = MODEL_DEPTH, seed: int = MODEL_SEED, return_data: bool = False):
    """Weighted random forest on the assembled features (M2).

    The assembled training set is spread over all cores and checkpointed
    once; the class weights and the many tree passes read that checkpoint.
    """
    assembled = cut_lineage(spread(assemble(train, features)
                                   .select("features", F.col(label).cast("double").alias("label"))))
    data = balanced_weights(assembled, "label")
    rf = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight",
                                featuresCol="features", labelCol="label",
                                featureSubsetStrategy="sqrt", impurity="gini",
                                # per-row node ids are cached (and checkpointed to the shared
                                # folder every 10 levels) instead of re-walking every tree
                                # per level: same model, fewer passes of work
                                cacheNodeIds=True, checkpointInterval=10)
    # The fitted model keeps a training summary that references the session;
    # a copy has no summary, so scoring never has to serialise session state.
    model = rf.fit(data).copy()
    return (model, assembled) if return_data else model


def predict(model: RandomForestClassificationModel, df: DataFrame,
            features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    return model.transform(assemble(spread(df), features))


def training_metrics(model, train: DataFrame, label: str = "target_top4",
                     features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """In-sample accuracy, per-class precision / recall / F1 / support (M3),
    all from one pass of confusion counts."""
    if "features" in train.columns:
        # already assembled (the checkpointed training set of the fit)
        p = model.transform(train)
    else:
        p = predict(model, train, features)
    p = p.select(F.col(label).cast("int").alias("y"), F.col("prediction").cast("int").alias("p"))
    c = p.agg(*[F.count_if((F.col("y") == y) & (F.col("p") == q)).alias(f"c{y}{q}")
                for y in (0, 1) for q in (0, 1)])
    rows = []
    for k in (0, 1):
        o = 1 - k
        tp, fn, fp = F.col(f"c{k}{k}"), F.col(f"c{k}{o}"), F.col(f"c{o}{k}")
        prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
        rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
        rows.append(F.struct(F.lit(k).alias("class"), F.bround(prec, 6).alias("precision"),
                             F.bround(rec, 6).alias("recall"), F.bround(f1, 6).alias("f1"),
                             (tp + fn).alias("support")))
    total = sum(F.col(f"c{y}{q}") for y in (0, 1) for q in (0, 1))
    acc = F.bround((F.col("c00") + F.col("c11")) / total, 6).alias("accuracy")
    return c.select(acc, F.inline(F.array(*rows)))


def classification_report(model, train: DataFrame, label: str = "target_top4",
                          features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """The whole report (M3): a row per class, accuracy, and the plain and the support-weighted mean of the classes."""
    m = training_metrics(model, train, label, features)
    per = m.select(F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support")
    n = F.sum("support")
    plain = m.agg(*[F.bround(F.avg(c), 6).alias(c) for c in ("precision", "recall", "f1")], n.alias("support"))
    weighted = m.agg(*[F.bround(F.sum(F.col(c) * F.col("support")) / n, 6).alias(c) for c in ("precision", "recall", "f1")], n.alias("support"))
    right = m.agg(F.max("accuracy").alias("a"), n.alias("support"))
    return (per.unionByName(right.select(F.lit("accuracy").alias("row"), F.col("a").alias("precision"), F.col("a").alias("recall"),
                                         F.col("a").alias("f1"), "support"))
            .unionByName(plain.select(F.lit("macro avg").alias("row"), "precision", "recall", "f1", "support"))
            .unionByName(weighted.select(F.lit("weighted avg").alias("row"), "precision", "recall", "f1", "support")))


def save_model(model: RandomForestClassificationModel, path: str) -> str:
    """Write the fitted model as a Spark ML artefact."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def feature_importance(model: RandomForestClassificationModel,
                       features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Importance per feature, largest first (M4). The model holds one number
    per feature; that small vector is all that leaves the JVM."""
    spark = model.sparkSession if hasattr(model, "sparkSession") else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    return df.withColumn("importance", F.bround("importance", 6)).orderBy(F.desc("importance"), "feature")


def score_outcomes(model, df: DataFrame, entity: str = "team", group: str = "confederation",
                   strength: str = "elo_rating", features: Sequence[str] = MODEL_FEATURES,
                   ranked: bool = True) -> DataFrame:
    """P(top 4) x 100 to one decimal, highest first unless not ``ranked`` (M5)."""
    p = predict(model, df.select(*dict.fromkeys([entity, group, strength, *features])), features)
    prob = vector_to_array("probability")[1]
    out = p.select(F.col(entity).alias("team"), F.col(group).alias("confederation"),
                   F.col(strength).alias("elo_rating"), round_half_even(prob * 100, 1).alias("prob_top4"))
    return out.orderBy(F.desc("prob_top4"), "team") if ranked else out


def prediction_summary(scored: DataFrame, k: int = 10) -> DataFrame:
    """Leader, best strength, dominant group in the top k and its count (M6)."""
    head = scored.agg(
        F.count(F.lit(1)).alias("scored"),
        arg_best("prob_top4", "team").alias("leader"),
        F.max("prob_top4").alias("leader_prob"),
        arg_best("elo_rating", "team").alias("best_elo_team"),
        F.max("elo_rating").alias("best_elo"),
    )
    dom = mode_in_top(scored, "prob_top4", "confederation", k, tie=["team"])
    # the single winning row enters as two scalar subqueries (no join needed)
    return head.withColumns({
        "dominant_confederation": dom.select("confederation").scalar(),
        "dominant_count": dom.select("count").scalar(),
    })
