"""Models: activity/payment clusters (MLlib) and the cross-validated forest.

The model matrices (one row per user) are landed as parquet in the shared
folder before the fits: k-means restarts and the K forest fits read them
many times, and a lost executor then re-reads the landed table instead of
replaying the whole feature plan. (A reliable ``checkpoint()`` of an
unpersisted plan would compute it twice: once for the eager count, once
for the checkpoint write.)
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.operators.spine import USER_KEY, numeric_columns
from lapse.plans import forest
from lapse.plans.bundle import CategoryShares, NumberVector
from lapse.plans.encode import (
    CAT_FEATURES, NON_FEATURES, SEED, class_names, clean_categoricals, encoding_shares, fit_categories, label_index, model_frame, n_folds_of,
    stratified_folds,
)
from lapse.operators.materialize import land

# Clustering inputs and model settings of the engine.
CLUSTER_FEATURES = (
    "gen_total", "gen_completed", "gen_total_credits", "gen_trend", "days_since_last_gen",
    "total_purchases", "total_spend", "tx_failure_rate", "gen_intensity",
)
MAX_CLUSTERS = 6
KMEANS_RESTARTS = 10
RESTARTS_AT_ONCE = 4  # a fit's jobs and summaries also take the driver's memory
NUM_TREES = 300
MIN_LEAF = 2
MAX_DEPTH = 30  # MLlib's limit; the engine grows trees without a depth cap
MISSING_NUMBER = -1.0
# Thresholds MLlib may try per feature (its default is 32).
MAX_BINS = 64


def bounded(rows: DataFrame, limit: int, seed: int = SEED) -> DataFrame:
    """``rows``, or a reproducible hash sample of about ``limit`` of them. No fit
    calls it: k-means and the forests read all train users."""
    n = rows.count()
    if n <= limit:
        return rows
    draw = F.pmod(F.xxhash64(*USER_KEY, F.lit(seed)), F.lit(1 << 40))
    return rows.where(draw < int(limit / n * (1 << 40)))


def cluster_inputs(features: DataFrame) -> DataFrame:
    """Users with the assembled clustering inputs (gaps as 0)."""
    return NumberVector(cols=list(CLUSTER_FEATURES)).transform(features).select(*USER_KEY, "_raw")


def scaler_for(raw: DataFrame):
    """Standardisation (train mean, sample deviation) of the cluster inputs."""
    return StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True).fit(raw.where(F.col("split") == "train"))


def scaled_features(features: DataFrame) -> DataFrame:
    """The standardised clustering inputs as columns, every user."""
    raw = cluster_inputs(features)
    x = vector_to_array("_x")
    return scaler_for(raw).transform(raw).select(*USER_KEY, *[x[j].alias(c) for j, c in enumerate(CLUSTER_FEATURES)])


def fit_clusters(
    features: DataFrame, seed: int = SEED, max_k: int = MAX_CLUSTERS, restarts: int = KMEANS_RESTARTS
) -> PipelineModel:
    """Input vector, scaler and k-means, fitted on train.

    k = min(6, train users); of ``restarts`` seeded fits the one with the
    lowest within-cluster cost is kept.
    """
    raw = cluster_inputs(features)
    scaler = scaler_for(raw)
    scaled = scaler.transform(raw.where(F.col("split") == "train")).select(*USER_KEY, "_x")
    train_x = land(scaled, "kmeans-train").select("_x")
    k = max(1, min(max_k, train_x.count()))

    def fit(r: int):
        # In blocks: each fit keeps the users as dense matrices (8 bytes a
        # number) while it runs. Over a persisted frame every iteration would
        # decode the rows into vectors again.
        kmeans = KMeans(k=k, seed=seed + r, featuresCol="_x", predictionCol="cluster_id", maxIter=300, solver="block")
        model = kmeans.fit(train_x)
        return model.summary.trainingCost, r, model

    # The restarts are independent jobs: some at once share the executors
    # instead of queueing one small job after another.
    with ThreadPoolExecutor(max_workers=RESTARTS_AT_ONCE) as pool:
        fits = list(pool.map(fit, range(restarts)))
    best = min(fits, key=lambda t: (t[0], t[1]))[2]  # lowest cost, then first restart
    return PipelineModel(stages=[NumberVector(cols=list(CLUSTER_FEATURES)), scaler, best])


def apply_clusters(features: DataFrame, fitted: PipelineModel) -> DataFrame:
    """(split, user_id, cluster_id) for every user."""
    scored = fitted.transform(features.select(*USER_KEY, *CLUSTER_FEATURES))
    return scored.select(*USER_KEY, F.col("cluster_id").cast("int").alias("cluster_id"))


def cluster_ids(features: DataFrame, seed: int = SEED, max_k: int = MAX_CLUSTERS, restarts: int = KMEANS_RESTARTS) -> DataFrame:
    """(split, user_id, cluster_id) for every user; scaler and k-means fit on train."""
    return apply_clusters(features, fit_clusters(features, seed, max_k, restarts))


def cluster_sizes(features: DataFrame, clusters: DataFrame) -> DataFrame:
    """Train users per cluster, ordered by cluster id."""
    train = features.where(F.col("split") == "train").select(*USER_KEY)
    joined = train.join(clusters, list(USER_KEY))
    return joined.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_users")).orderBy("cluster_id")


def feature_columns(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in NON_FEATURES and c != "fold"]


def _assembled(frame: DataFrame) -> DataFrame:
    cols = feature_columns(frame)
    num = numeric_columns(frame.select(*cols))
    filled = frame.na.fill(MISSING_NUMBER, subset=num)
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(filled)


def class_weights(train: DataFrame) -> DataFrame:
    """w_c = n / (n_classes * n_c), the 'balanced' class weight (one row per class)."""
    counts = train.groupBy("target").agg(F.count(F.lit(1)).alias("_nc"))
    everything = Window.partitionBy()  # over the per-class rows only
    w = F.sum("_nc").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("_nc"))
    return counts.select("target", w.alias("w"))


@dataclass
class Forests:
    """The fold forests and the matrices (of landed tables) they were fitted on and score."""

    models: list
    train: DataFrame  # split, user_id, target, features, fold
    test: DataFrame  # split, user_id, features
    classes: tuple[str, ...]


def fit_forest(train: DataFrame, fold: int, num_trees: int, min_leaf: int, max_depth: int, max_bins: int, range_rows: int, seed: int):
    """The forest of one fold on all its train rows (target, features).
    ``range_rows``: how many rows' values of a feature a task merges."""
    found = {r["target"]: r["w"] for r in class_weights(train).collect()}
    weights = [found.get(c, 0.0) for c in range(max(found, default=-1) + 1)]
    return forest.fit(
        train, train.count(), weights, num_trees, min_leaf, max_depth, max_bins, seed + fold + 1, output=f"_p{fold}", range_rows=range_rows
    )


def fit_forests(
    frame: DataFrame,
    folds: DataFrame,
    classes: tuple[str, ...],
    num_trees: int = NUM_TREES,
    min_leaf: int = MIN_LEAF,
    max_depth: int = MAX_DEPTH,
    max_bins: int = MAX_BINS,
    seed: int = SEED,
) -> Forests:
    """One forest a fold, fitted on the train users outside it.

    ``frame``: model table (both splits, ``target`` on train rows);
    ``folds``: (split, user_id, fold); ``classes`` in code order.
    """
    key = list(USER_KEY)
    # The plan of the encoded table is wide: planned and compiled once, for both splits.
    data = land(_assembled(frame).select(*key, "target", "features"), "forest-matrix")
    train = land(data.where(F.col("split") == "train").join(folds.select(*key, "fold"), key), "forest-train")
    test = data.where(F.col("split") != "train").select(*key, "features")
    n_folds = folds.agg(F.max("fold")).first()[0] + 1

    settings = {"num_trees": num_trees, "min_leaf": min_leaf, "max_depth": max_depth, "max_bins": max_bins, "range_rows": forest.RANGE_ROWS, "seed": seed}

    def fit_fold(f: int):
        return fit_forest(train.where(F.col("fold") != f), f, **settings)

    # Fold fits are independent; their jobs run side by side.
    with ThreadPoolExecutor(max_workers=n_folds) as pool:
        models = list(pool.map(fit_fold, range(n_folds)))
    return Forests(models, train, test, classes)


def score_forests(forests: Forests) -> tuple[DataFrame, DataFrame]:
    """(oof, test), landed: oof has split, user_id, target, fold and prob_* of
    the forest that has not seen the user's fold; test has split, user_id and
    prob_* averaged over the folds."""
    key, probs = list(USER_KEY), [f"prob_{c}" for c in forests.classes]
    models, train, test = forests.models, forests.train, forests.test
    n_folds = len(models)

    def part(f: int) -> DataFrame:
        p = vector_to_array(f"_p{f}")
        scored = models[f].transform(train.where(F.col("fold") == f))
        return scored.select(*key, "target", "fold", *[p[i].alias(c) for i, c in enumerate(probs)])

    oof = land(reduce(DataFrame.unionByName, map(part, range(n_folds))), "forest-oof")
    # The models score the test users one after another in the same rows, and
    # a projection averages: no union, no shuffle.
    scored = reduce(lambda df, m: m.transform(df), models, test)
    averages = [sum((vector_to_array(f"_p{f}")[i] for f in range(n_folds)), F.lit(0.0)) / n_folds for i in range(len(probs))]
    return oof, land(scored.select(*key, *[a.alias(c) for a, c in zip(averages, probs)]), "forest-test-probs")


def forest_cv(frame: DataFrame, folds: DataFrame, classes: tuple[str, ...], **settings) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold train probabilities and fold-averaged test probabilities,
    landed (the fits are the expensive part)."""
    return score_forests(fit_forests(frame, folds, classes, **settings))


def foldwise_oof(
    features: DataFrame, folds: DataFrame, classes: tuple[str, ...], seed: int = SEED, num_trees: int = NUM_TREES, restarts: int = KMEANS_RESTARTS
) -> DataFrame:
    """Out-of-fold train probabilities where clusters, dictionaries and country
    shares too are fitted on the other folds only, landed.

    ``forest_cv`` fits these on all train users before the folds are cut, as
    the engine does by default; the held-out users have then had a part in
    their own encodings. Columns as the out-of-fold table of ``forest_cv``.
    """
    key, probs = list(USER_KEY), [f"prob_{c}" for c in classes]
    dealt = features.where(F.col("split") == "train").join(folds.select(*key, "fold", F.col("target").alias("_class")), key)
    dealt = land(dealt, "foldwise-features")
    n_folds = dealt.agg(F.max("fold")).first()[0] + 1

    def part(f: int) -> DataFrame:
        # Users of the fold stand where test users do.
        split = F.when(F.col("fold") == f, F.lit("held")).otherwise(F.lit("train"))
        rows = dealt.withColumn("split", split)
        own = rows.drop("fold", "_class")
        clusters = land(apply_clusters(own, fit_clusters(own, seed, restarts=restarts)), "foldwise-clusters")
        data = land(_assembled(model_frame(own, clusters, seed=seed)).select(*key, "target", "features"), "foldwise-matrix")
        fitted = fit_forest(data.where(F.col("split") == "train"), f, num_trees, MIN_LEAF, MAX_DEPTH, MAX_BINS, forest.RANGE_ROWS, seed)
        held = data.where(F.col("split") == "held").drop("target").join(rows.select(*key, F.col("_class").alias("target")), key)
        p = vector_to_array(f"_p{f}")
        scored = fitted.transform(held)
        return scored.select(
            F.lit("train").alias("split"), "user_id", "target", F.lit(f).cast("int").alias("fold"), *[p[i].alias(c) for i, c in enumerate(probs)]
        )

    with ThreadPoolExecutor(max_workers=n_folds) as pool:
        return land(reduce(DataFrame.unionByName, pool.map(part, range(n_folds))), "foldwise-oof")


def feature_preview(frame: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` feature names, numbered (schema only)."""
    names = feature_columns(frame)[:n]
    return frame.sparkSession.createDataFrame(list(enumerate(names)), "position int, feature string")


@dataclass
class ModelData:
    """Everything the forest needs: lazy DataFrames, the fitted parts, a few
    scalars. ``bundle.bundle`` makes one saveable pipeline of it."""

    features: DataFrame  # user feature table, both splits
    clusters: DataFrame  # (split, user_id, cluster_id)
    frame: DataFrame  # encoded model table (codes, target encoding, cluster id, target)
    folds: DataFrame  # (split, user_id, target, fold) for train users
    feature_cols: list[str]
    cat_features: tuple[str, ...]
    class_names: tuple[str, ...]
    n_folds: int
    seed: int
    cluster_model: PipelineModel  # input vector, scaler, k-means
    category_model: StringIndexerModel  # a dictionary per categorical
    shares: CategoryShares  # class shares per country over all train users


def country_shares(features: DataFrame, col: str = "country_code") -> CategoryShares:
    """Class shares per country over all train users, as a pipeline stage."""
    labelled = label_index(clean_categoricals(features.select(*USER_KEY, "churn_status", col)))
    table, overall = encoding_shares(labelled, col)
    return CategoryShares(land(table, "country-shares"), col, overall)


def prepare_model_data(features: DataFrame, users: DataFrame, seed: int = SEED) -> ModelData:
    """Clusters, encodings and folds for the feature table (one job for the
    fold count, which is a property of the class sizes)."""
    cluster_model = fit_clusters(features, seed=seed)
    clusters = land(apply_clusters(features, cluster_model), "clusters")
    frame = model_frame(features, clusters, seed=seed)
    labelled = label_index(users)
    n_folds = n_folds_of(labelled)
    return ModelData(
        features=features,
        clusters=clusters,
        frame=frame,
        folds=stratified_folds(labelled, seed=seed),
        feature_cols=feature_columns(frame),
        cat_features=CAT_FEATURES,
        class_names=class_names(users),
        n_folds=int(n_folds),
        seed=seed,
        cluster_model=cluster_model,
        category_model=fit_categories(clean_categoricals(features)),
        shares=country_shares(features),
    )
