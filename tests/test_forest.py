"""The forest grown by Spark jobs: splits against a plain search, large nodes
split by summed histograms, scores of every row, saved and loaded."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lapse.operators import materialize, trees
from lapse.plans import bundle, forest, model


def _gini(w):
    s = w.sum()
    return 1 - (w * w).sum() / (s * s) if s else 0.0


def test_best_splits_are_those_of_a_plain_search():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 5, (60, 4)).astype(np.uint8)
    y, n, at = rng.integers(0, 3, 60), rng.integers(1, 4, 60), rng.integers(0, 3, 60)
    sizes, weights = np.array([5, 5, 5, 5]), np.array([1.0, 0.5, 2.0])
    subset = np.array([[0, 2], [3, 1], [2, 1]])
    counts = trees.histogram(x[np.arange(60)[:, None], subset[at]], y, n, at, subset, sizes, 3)
    gain, feature, cell, left, total = trees.best_splits(counts, subset, sizes, weights, 2)
    for node in range(3):
        rows = at == node
        own = np.bincount(y[rows], n[rows], 3)
        assert (total[node] == own).all()
        found = []
        for f in subset[node]:
            for c in range(5):
                low = np.bincount(y[rows & (x[:, f] <= c)], n[rows & (x[:, f] <= c)], 3)
                if low.sum() >= 2 and (own - low).sum() >= 2:
                    a, b = low * weights, (own - low) * weights
                    found.append((_gini(a + b) - (a.sum() * _gini(a) + b.sum() * _gini(b)) / (a + b).sum(), f, c))
        assert gain[node] == pytest.approx(max(g for g, *_ in found))
        assert any(f == feature[node] and c == cell[node] and g == pytest.approx(gain[node]) for g, f, c in found)


def test_splits_among_cells_without_rows(monkeypatch):
    """Cells are numbered with the empty ones, but sums run over the others
    only."""
    rng = np.random.default_rng(8)
    x, y, n = (7 * rng.integers(0, 9, (12, 3)) + 2).astype(np.uint8), rng.integers(0, 2, 12), np.ones(12, dtype=np.int64)
    at, subset, sizes = np.repeat([0, 1], 6), np.array([[0, 2], [1, 0]]), np.array([64, 64, 64])
    counts = trees.histogram(x[np.arange(12)[:, None], subset[at]], y, n, at, subset, sizes, 2)
    widest, plain = [], np.cumsum
    monkeypatch.setattr(trees.np, "cumsum", lambda v, *a, **k: widest.append(np.shape(v)[-1]) or plain(v, *a, **k))
    gain, feature, cell, left, total = trees.best_splits(counts, subset, sizes, np.ones(2), 1)
    assert max(widest) <= 12 * 2 + 4 < counts.shape[1]
    for node in range(2):
        rows = at == node
        low = rows & (x[:, feature[node]] <= cell[node])
        assert gain[node] > 0 and (rows & (x[:, feature[node]] == cell[node])).any()
        assert left[node].tolist() == np.bincount(y[low], minlength=2).tolist()
        assert total[node].tolist() == np.bincount(y[rows], minlength=2).tolist()


def test_histograms_are_counted_some_rows_at_a_time(monkeypatch):
    """As at once; the arrays of a task no longer grow with a node's rows."""
    rng = np.random.default_rng(4)
    x, y, n = rng.integers(0, 5, (300, 4)).astype(np.uint8), rng.integers(0, 3, 300), rng.integers(1, 4, 300)
    rows, subset, sizes = rng.permutation(300)[:200], np.array([[0, 2], [3, 1], [2, 1]]), np.array([5, 5, 5, 5])
    at = np.sort(rng.integers(0, 3, 200))
    whole = trees.histogram(x[rows[:, None], subset[at]], y[rows], n[rows], at, subset, sizes, 3)
    for some in (1, 7, 1000):
        monkeypatch.setattr(trees, "ROWS_AT_ONCE", some)
        assert (trees.histogram_of(x, y, n, rows, at, subset, sizes, 3) == whole).all()


def test_a_subtree_is_the_same_however_many_nodes_are_counted_at_once(monkeypatch):
    rng = np.random.default_rng(6)
    x, y, n = rng.integers(0, 20, (500, 6)).astype(np.uint8), rng.integers(0, 3, 500), rng.integers(1, 4, 500)
    grown = []
    for nodes, some in ((1 << 20, 1 << 20), (2, 16), (1, 1)):
        monkeypatch.setattr(trees, "NODES_AT_ONCE", nodes)
        monkeypatch.setattr(trees, "ROWS_AT_ONCE", some)
        grown.append(trees.grow(x, y, n, 3, np.full(6, 20), np.ones(3), 3, 2, 30, np.random.default_rng(1)))
    assert len(grown[0][0]) > 50
    for piece in grown[1:]:
        assert all((a == b).all() for a, b in zip(piece, grown[0]))


def test_rows_follow_only_the_paths_to_wanted_nodes():
    """Rows that end elsewhere were routed to their leaves at every level."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, 9, (400, 4)).astype(np.uint8)
    # 0 -> (1 -> (3, 4), 2 -> (5 -> (7, 8), 6))
    feature, cell, left = np.array([0, 1, 2, -1, -1, 3, -1, -1, -1]), np.array([4, 3, 5, 0, 0, 2, 0, 0, 0]), np.array([1, 3, 5, 0, 0, 7, 0, 0, 0])
    rows = np.flatnonzero(rng.random(400) < 0.6)
    at = trees.route(feature, cell, left, x, rows, np.zeros(len(rows), dtype=np.int64))
    for wanted in ({4}, {3, 8}, {3, 4, 6, 7, 8}):
        on_path = trees.paths(feature, left, wanted)
        assert on_path[0] and on_path[2] == bool(wanted & {6, 7, 8})
        got = dict(trees.arrivals(feature, cell, left, on_path, wanted, np.ascontiguousarray(x.T), rows))
        assert set(got) == wanted
        assert all((got[node] == rows[at == node]).all() for node in wanted)


def test_histogram_of_one_node():
    rng = np.random.default_rng(12)
    x, y, n = rng.integers(0, 5, (200, 4)).astype(np.uint8), rng.integers(0, 3, 200).astype(np.uint8), rng.integers(1, 4, 200)
    rows, subset, sizes = rng.permutation(200)[:90], np.array([3, 0]), np.array([5, 6, 7, 8])
    whole = trees.histogram(x[rows[:, None], subset], y[rows], n[rows], np.zeros(90, dtype=np.int64), subset[None, :], sizes, 3)
    assert (trees.histogram_at(np.ascontiguousarray(x.T), y, n, rows, subset, sizes, 3) == whole).all()


def test_draws_and_subsets_are_those_of_their_definition():
    ids = np.random.default_rng(13).integers(0, 2**64, 50_000, dtype=np.uint64)
    key = trees._mixed(np.array([7 * 1_000_003 + 3], dtype=np.uint64))
    unit = (trees._mixed(ids ^ key) >> np.uint64(11)) * 2.0**-53
    assert (trees.draws(ids, 3, 7) == np.searchsorted(trees.POISSON, unit, side="right")).all()
    for k in (1, 5, 9):
        whole = np.argsort(np.random.default_rng(1).random((30, 9)), axis=1)[:, :k]
        assert (trees.feature_subsets(np.random.default_rng(1), 30, 9, k) == whole).all()


def test_thresholds_and_cells():
    assert trees.thresholds_of(np.array([3.0, 1.0, np.nan, 1.0]), 64).tolist() == [2.0]
    assert trees.thresholds_of(np.array([1.0, 1.0]), 64).tolist() == []
    many = trees.thresholds_of(np.arange(1000.0), 8)
    assert len(many) == 7
    cells = trees.binned(np.array([[1.0], [2.0], [2.5], [np.nan]]), [np.array([2.0])])
    assert cells.ravel().tolist() == [0, 0, 1, 1]


@pytest.mark.parametrize("range_rows", [1_000_000, 5000, 1000])
def test_thresholds_come_from_all_rows(spark, range_rows, monkeypatch):
    """They were those of a sample of 10,000 rows. Ranges only deal the values
    out; a range may hold no value and a feature no number."""
    monkeypatch.setattr(forest, "COUNTED_ROWS", 1500)
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(size=12_000), rng.integers(0, 3, 12_000), rng.geometric(0.02, 12_000), np.full(12_000, np.nan), np.zeros(12_000)])
    x[rng.random(12_000) < 0.2, 0] = np.nan
    x[7, 1] = 99.0
    df = spark.createDataFrame([("train", i, v) for i, v in enumerate(x.tolist())], "split string, user_id long, v array<double>")
    df = df.withColumn("features", array_to_vector("v"))
    got = forest._thresholds(df, "features", 64, 12_000, 7, range_rows)
    assert got == [trees.thresholds_of(x[:, j], 64).tolist() for j in range(5)]
    assert len(got[0]) == 63 and got[1] == [0.5, 1.5, 50.5] and got[3:] == [[], []]


@pytest.fixture(scope="module")
def rows(spark):
    """Class by two numbers, one in ten at random, and a gap."""
    rng = np.random.default_rng(5)
    out = []
    for i in range(900):
        a, b, noise = rng.random(3).tolist()
        target = int(rng.integers(0, 3)) if i % 10 == 0 else (0 if a < 0.4 else 1 if b < 0.5 else 2)
        out.append(("train", i, target, [a, b, noise, float("nan") if i % 7 == 0 else noise]))
    df = spark.createDataFrame(out, "split string, user_id long, target int, v array<double>")
    return df.withColumn("features", array_to_vector("v")).drop("v").localCheckpoint()


def _scores(fitted, rows):
    p = vector_to_array(fitted.getProbabilityCol())
    return {r.user_id: (r.target, r.p) for r in fitted.transform(rows).select("user_id", "target", p.alias("p")).collect()}


@pytest.mark.parametrize("limit", [None, 150])
def test_forest_learns_and_scores_every_row(rows, limit):
    """``limit`` 150: the first levels are split by histograms of all blocks."""
    fitted = forest.fit(rows, 900, [1.0, 1.0, 1.0], 25, 2, 30, 64, 7, limit=limit)
    got = _scores(fitted, rows)
    assert len(got) == 900
    assert all(abs(sum(p) - 1) < 1e-9 for _, p in got.values())
    clean = [int(np.argmax(p)) == t for u, (t, p) in got.items() if u % 10]
    assert np.mean(clean) > 0.97
    again = forest.fit(rows.repartition(7), 900, [1.0, 1.0, 1.0], 25, 2, 30, 64, 7, limit=limit)
    assert _scores(again, rows) == got


def test_large_nodes_are_numbered_alike_however_counts_arrive(spark, rows):
    """Nodes were numbered in the order that shuffle partitions came in."""
    got = []
    for n in ("3", "40"):
        before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
        for c, v in zip(before, (n, "false")):
            spark.conf.set(c, v)
        fitted = forest.fit(rows, 900, [1.0, 1.0, 1.0], 6, 2, 30, 64, 7, limit=60)
        for c, v in before.items():
            spark.conf.set(c, v)
        got.append(_scores(fitted, rows))
    assert got[0] == got[1]


def test_rows_are_dealt_in_waves(rows, monkeypatch):
    whole = _scores(forest.fit(rows, 900, [1.0, 1.0, 1.0], 25, 2, 30, 64, 7), rows)
    monkeypatch.setattr(forest, "DEALT_AT_ONCE", 900 * 10)
    assert _scores(forest.fit(rows, 900, [1.0, 1.0, 1.0], 25, 2, 30, 64, 7), rows) == whole


def test_saved_forest_scores_alike(spark, rows, tmp_path):
    fitted = forest.fit(rows, 900, [1.0, 2.0, 1.0], 12, 2, 30, 64, 7)
    fitted.write().overwrite().save(str(tmp_path / "forest"))
    loaded = forest.ForestModel.load(str(tmp_path / "forest"))
    assert _scores(loaded, rows) == _scores(fitted, rows)


def test_scoring_lands_the_key_and_the_vector_only(rows, monkeypatch):
    """Every forest of a saved pipeline landed and joined all columns of the
    user features; planning and compiling that filled the driver."""
    fitted = forest.fit(rows, 900, [1.0, 1.0, 1.0], 5, 2, 30, 64, 7, output="_p0")
    x = vector_to_array("features")
    wide = rows.select("split", "user_id", "target", *[x[j].alias(f"x{j}") for j in range(4)], *[F.lit(j).alias(f"other{j}") for j in range(30)])
    stages = [
        VectorAssembler(inputCols=[f"x{j}" for j in range(4)], outputCol="features", handleInvalid="keep"), fitted,
        bundle.MeanProbability(cols=["_p0"]), IndexToString(inputCol="prediction", outputCol="predicted_class", labels=["a", "b", "c"]),
    ]
    landed = []
    monkeypatch.setattr(materialize, "observers", [lambda name, df: landed.append((name, set(df.columns)))])
    got = {r.user_id: [r.prob_a, r.prob_b, r.prob_c] for r in bundle.score(PipelineModel(stages=stages), wide, ("user_id",)).collect()}
    assert landed == [("forest-scored", {"user_id", "features", "_row"})]
    assert got == {u: p for u, (_, p) in _scores(fitted, rows).items()}


def test_fold_forest_keeps_no_tree_in_the_driver(rows):
    """MLlib's model held every node of every tree as driver objects."""
    fitted = model.fit_forest(rows, 1, 12, 2, 30, 64, 1_000_000, 42)
    assert fitted.getProbabilityCol() == "_p1" and not hasattr(fitted, "trees")
    assert fitted.table.count() == 2


def test_fold_forest_is_fitted_on_all_rows(rows, monkeypatch):
    """A fit of more rows than a bound, the seventh argument, read a sample."""
    read = []

    def observe(name, df):
        if name == "forest-blocks":
            read.append(sum(len(r.y) for r in df.collect()))

    monkeypatch.setattr(materialize, "observers", [observe])
    fitted = model.fit_forest(rows, 1, 4, 2, 30, 64, 100, 42)
    assert read == [900]
    again = model.fit_forest(rows, 1, 4, 2, 30, 64, 1_000_000, 42)
    assert again.getOrDefault(again.thresholds) == fitted.getOrDefault(fitted.thresholds)


def test_leaves_of_one_class_are_merged():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 20, (400, 3)).astype(np.uint8), rng.integers(0, 2, 400)
    feature, cell, left, shares = trees.grow(x, y, np.ones(400), 2, np.full(3, 20), np.ones(2), 2, 2, 30, rng)
    best, reached = shares.argmax(axis=1), [0]
    for node in reached:
        if feature[node] >= 0:
            a, b = left[node], left[node] + 1
            assert feature[a] >= 0 or feature[b] >= 0 or best[a] != best[b]
            reached += [a, b]
    assert len(reached) > 50
