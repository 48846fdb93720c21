"""Model invariants (no oracle is possible for the fitted models)."""

import functools
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from lapse.operators.materialize import land
from lapse.plans import assemble, bundle, encode, model, report
from lapse.sources.fixtures import load_inputs


@pytest.fixture(scope="module")
def fitted(spark):
    i = load_inputs(spark, SF_SMALL)
    feats = land(assemble.user_features(i), "test-features")
    clusters = model.cluster_ids(feats, restarts=2)
    frame = encode.model_frame(feats, clusters)
    folds = encode.stratified_folds(encode.label_index(i.users))
    oof, test = model.forest_cv(frame, folds, encode.class_names(i.users), num_trees=10)
    return i, feats, clusters, folds, report.decide(oof).toPandas(), report.decide(test).toPandas()


SCORE = """
import sys
sys.path.insert(0, sys.argv[1])
from lapse.plans import bundle
from lapse.session import build_session
spark = build_session("local[2]", shuffle_partitions=2)
features = spark.read.parquet(sys.argv[3])
bundle.score(bundle.load(sys.argv[2]), features, ("split", "user_id")).write.parquet(sys.argv[4])
"""


def test_saved_pipeline_scores_in_another_process(spark, fitted, tmp_path, monkeypatch):
    """Saved, loaded where nothing was fitted, applied to raw features: the
    scores of the fitted forests, also for countries and answers never seen."""
    i, feats, *_ = fitted
    monkeypatch.setattr(model, "fit_clusters", functools.partial(model.fit_clusters, restarts=2))
    data = model.prepare_model_data(feats, i.users)
    forests = model.fit_forests(data.frame, data.folds, data.class_names, num_trees=5)
    expected = report.decide(model.score_forests(forests)[1])
    path, rows, out = (str(tmp_path / x) for x in ("model", "rows", "scores"))
    bundle.save(bundle.bundle(data, forests.models), path)
    test_users = feats.where("split != 'train'")
    new = test_users.limit(3).withColumns({"user_id": F.col("user_id") + 10_000_000, "country_code": F.lit("XX"), "quiz_role": F.lit(None).cast("string")})
    test_users.unionByName(new).write.parquet(rows)
    subprocess.run([sys.executable, "-c", SCORE, ROOT, path, rows, out], check=True, capture_output=True, timeout=300)
    got = {r.user_id: r for r in spark.read.parquet(out).collect()}
    assert len(got) == test_users.count() + 3
    for r in expected.collect():
        assert got[r.user_id].predicted_class == r.predicted_class
        for c in report.prob_columns(expected):
            assert got[r.user_id][c] == pytest.approx(r[c], abs=1e-9)


def test_encodings_inside_the_folds(spark, fitted):
    i, feats, _, folds, oof, _ = fitted
    inside = model.foldwise_oof(feats, folds, encode.class_names(i.users), num_trees=5, restarts=1)
    got = report.decide(inside).toPandas()
    dealt = {r.user_id: (r.fold, r.target) for r in folds.collect()}
    assert len(got) == len(oof) and {r.user_id: (r.fold, r.target) for r in got.itertuples()} == dealt
    assert ((got[[c for c in got.columns if c.startswith("prob_")]].sum(axis=1) - 1).abs() < 1e-6).all()


def test_every_train_user_scored_once_out_of_fold(fitted):
    i, feats, _, folds, oof, test = fitted
    n_train = feats.where("split = 'train'").count()
    assert len(oof) == n_train and oof.user_id.is_unique
    assert len(test) == feats.where("split = 'test'").count() and test.user_id.is_unique


def test_probabilities_and_decisions(fitted):
    *_, oof, test = fitted
    for df in (oof, test):
        probs = df[[c for c in df.columns if c.startswith("prob_")]]
        assert ((probs.sum(axis=1) - 1).abs() < 1e-6).all()
        assert ((probs.max(axis=1) - df.confidence).abs() < 1e-12).all()
        assert (probs.to_numpy().argmax(axis=1) == df.prediction).all()
        assert set(df.predicted_class) <= {c.removeprefix("prob_") for c in probs.columns}


def test_fold_sizes_per_class_differ_by_at_most_one(fitted):
    _, _, _, folds, _, _ = fitted
    counts = folds.groupBy("target", "fold").count().toPandas()
    for _, g in counts.groupby("target"):
        assert g["count"].max() - g["count"].min() <= 1


def test_clusters_cover_all_users(fitted):
    _, feats, clusters, *_ = fitted
    assert clusters.count() == feats.count()
    k = clusters.agg(F.countDistinct("cluster_id")).first()[0]
    assert 1 <= k <= model.MAX_CLUSTERS


def test_kmeans_reads_all_train_users(fitted, monkeypatch):
    _, feats, clusters, *_ = fitted
    monkeypatch.setattr(model, "bounded", lambda rows, *_: rows.limit(4))
    assert sorted(model.cluster_ids(feats, restarts=2).collect()) == sorted(clusters.collect())


def test_reports_on_forest_output(fitted, spark):
    *_, oof, _ = fitted
    df = spark.createDataFrame(oof[["user_id", "target", "prediction", "predicted_class", "confidence", *report.prob_columns(oof)]])
    m = report.macro_f1(df).first()
    assert 0 <= m.macro_f1 <= 1 and m.n_users == len(oof)
    assert report.confusion_matrix(df).agg(F.sum("n_users")).first()[0] == len(oof)


def test_bounded_fit_rows(spark):
    df = spark.createDataFrame([("train", i) for i in range(2000)], "split string, user_id long")
    assert model.bounded(df, 2000).count() == 2000
    assert 400 < model.bounded(df, 500).count() < 600
