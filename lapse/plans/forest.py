"""A random forest grown by Spark jobs and kept in the shared folder.

MLlib's forest deals out dense histograms of every node to every partition and
holds all trees in the driver; with trees that grow until their leaves are
small, both are many times the data. Here rows are binned and landed in
blocks. While a node has more than ``LOCAL_ROWS`` drawn rows, its histograms
are counted where the blocks lie and summed per node; then the node's rows are
dealt to one task, which grows the rest of the subtree. Trees are landed as
Parquet, some to a row, and scoring joins blocks of rows with them: the driver
holds thresholds and the few large nodes.

As in MLlib: Poisson(1) bootstraps per tree, sqrt features per node, at most
``max_bins`` cells a feature, weighted Gini impurity, class shares averaged over
the trees. Unlike there, the cells come from all rows, not from a sample.
"""

from __future__ import annotations

import sys
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.operators import trees as T
from lapse.operators.materialize import land
from lapse.operators.spine import USER_KEY

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Drawn rows of a node that one task may take to grow its subtree.
LOCAL_ROWS = 200_000
# Rows times trees that are dealt out at once (bounds the shuffle files).
DEALT_AT_ONCE = 12_000_000
DEALT_ROWS = 16_000  # rows times trees in a batch that is dealt out
TREES_A_ROW = 10
BLOCK_ROWS = 4000
# Rows whose distinct values a task sorts at once, rows of one range of a
# feature's values, and rows sampled to find where the ranges begin.
COUNTED_ROWS = 50_000
RANGE_ROWS = 1_000_000
BORDER_ROWS = 10_000

BLOCKS = "ids binary, x binary, y binary"
PIECES = "tree int, node int, feature binary, cell binary, left binary, shares binary"
GROUPS = "grp int, roots binary, feature binary, cell binary, left binary, shares binary"


def _array(value, dtype, *shape) -> np.ndarray:
    out = np.frombuffer(value.as_buffer() if hasattr(value, "as_buffer") else value, dtype=dtype)
    return out.reshape(shape) if shape else out


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], type=kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields]
    )


def _counted(rows: DataFrame, features: str, borders: list) -> DataFrame:
    """The distinct values of every feature with their numbers of rows, sorted,
    a row for each feature and range between its ``borders``; landed."""

    def pack(tables):
        x = np.concatenate(tables)
        for j in range(x.shape[1]):
            values, n = np.unique(x[~np.isnan(x[:, j]), j], return_counts=True)
            cuts = borders[j] if borders else ()
            ends = [0, *np.searchsorted(values, cuts, side="right"), len(values)]
            for part, (a, b) in enumerate(zip(ends, ends[1:])):
                if b > a or not part:  # range 0 also stands for a feature without values
                    yield _batch(packed, [(j, part, values[a:b].tobytes(), n[a:b].astype(np.int64).tobytes())])

    def count(batches):
        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(_matrix(b, "x"))
                size += b.num_rows
            if size >= COUNTED_ROWS:
                yield from pack(held)
                held, size = [], 0
        if held:
            yield from pack(held)

    def merge(key, table):
        values, n = (np.concatenate([_array(v, t) for v in table.column(c)]) for c, t in (("vals", np.float64), ("n", np.int64)))
        order = np.argsort(values, kind="stable")
        values = values[order]
        firsts = np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), dtype=bool), values[1:] != values[:-1]]))
        values, n = values[firsts], np.add.reduceat(n[order], firsts) if len(firsts) else n
        first = float(values[0]) if len(values) else 0.0
        row = (*(int(v.as_py()) for v in key), len(values), int(n.sum()), first, values.tobytes(), n.tobytes())
        return pa.Table.from_batches([_batch(merged, [row])])

    packed = "feature int, part int, vals binary, n binary"
    merged = "feature int, part int, distinct long, size long, first double, vals binary, n binary"
    found = rows.select(vector_to_array(features).alias("x")).mapInArrow(count, packed)
    return land(found.groupBy("feature", "part").applyInArrow(merge, merged), "forest-values")


def _thresholds(rows: DataFrame, features: str, max_bins: int, n: int, seed: int, range_rows: int) -> list[list[float]]:
    """Thresholds of every feature, from the values of all ``rows``.

    A task merges the values of one range of a feature. Ranges hold about
    ``range_rows`` rows; where they begin is taken from a hash sample, which
    has no part in the thresholds.
    """
    borders = []
    if n > range_rows:
        draw = F.pmod(F.xxhash64(*USER_KEY, F.lit(seed + 1)), F.lit(1 << 40))
        part = rows.where(draw < int(BORDER_ROWS / n * (1 << 40)))
        found = part.select(vector_to_array(features).alias("x")).toArrow().column("x").combine_chunks()
        if len(found):
            x = found.flatten().to_numpy(zero_copy_only=False).reshape(len(found), -1)
            borders = [T.thresholds_of(x[:, j], ceil(n / range_rows)) for j in range(x.shape[1])]
            borders = [cuts[np.isfinite(cuts)] for cuts in borders]
    values = _counted(rows, features, borders)
    parts: dict[int, list] = {}
    for r in sorted(values.select("feature", "part", "distinct", "size", "first").collect()):
        parts.setdefault(r.feature, []).append(r)
    if not parts:
        raise ValueError("no rows to fit a forest on")
    # Of every range: values and rows of the feature, rows of the ranges before,
    # the value after.
    known = {}
    for j, own in parts.items():
        own = [r for r in own if r.distinct]
        total, distinct, before = sum(r.size for r in own), sum(r.distinct for r in own), 0
        for r, after in zip(own, [*own[1:], None]):
            known[j, r.part] = (distinct, total, before, after and after.first)
            before += r.size

    def pick(batches):
        for b in batches:
            for i in range(b.num_rows):
                j, part = b.column("feature")[i].as_py(), b.column("part")[i].as_py()
                if (j, part) in known:
                    distinct, total, before, after = known[j, part]
                    cuts = T.cuts_of(_array(b.column("vals")[i], np.float64), _array(b.column("n")[i], np.int64), max_bins, distinct, total, before, after)
                    yield _batch("feature int, part int, cuts binary", [(j, part, cuts.tobytes())])

    out: list[list[float]] = [[] for _ in range(max(parts) + 1)]
    for r in sorted(values.select("feature", "part", "vals", "n").mapInArrow(pick, "feature int, part int, cuts binary").collect()):
        out[r.feature] += _array(r.cuts, np.float64).tolist()
    return out


def _blocks(rows: DataFrame, features: str, thresholds: list, n: int) -> DataFrame:
    """Binned rows in blocks, landed."""
    cuts = [np.array(c, dtype=np.float64) for c in thresholds]

    def bin_rows(batches):
        for b in batches:
            for i in range(0, b.num_rows, BLOCK_ROWS):
                s = b.slice(i, BLOCK_ROWS)
                x = T.binned(_matrix(s, "x"), cuts)
                y = s.column("y").to_numpy().astype(np.uint8)
                yield _batch(BLOCKS, [(s.column("id").to_numpy().tobytes(), x.tobytes(), y.tobytes())])

    wanted = rows.select(F.xxhash64(*USER_KEY).alias("id"), vector_to_array(features).alias("x"), F.col("target").cast("int").alias("y"))
    blocks = ceil(n / BLOCK_ROWS)
    # Some blocks to a file once there are many.
    dealt = wanted.repartition(max(1, min(1000, blocks, max(64, blocks // 4))))
    return land(dealt.mapInArrow(bin_rows, BLOCKS), "forest-blocks")


def _unpacked(batches, features: int):
    for b in batches:
        for i in range(b.num_rows):
            ids, x, y = (b.column(c)[i] for c in ("ids", "x", "y"))
            yield _array(ids, np.uint64), _array(x, np.uint8, -1, features), _array(y, np.uint8)


class _Top:
    """The large nodes of one tree, split level by level."""

    def __init__(self, n: int, limit: int):
        self.feature, self.cell, self.left, self.depth = [-1], [0], [0], [0]
        self.large = [0] if n > limit else []
        self.leaves: dict[int, list[float]] = {}

    def split(self, node: int, feature: int, cell: int, sizes: tuple[float, float], limit: int) -> None:
        self.feature[node], self.cell[node], self.left[node] = feature, cell, len(self.feature)
        for size in sizes:
            if size > limit:
                self.large.append(len(self.feature))
            self.feature.append(-1)
            self.cell.append(0)
            self.left.append(0)
            self.depth.append(self.depth[node] + 1)

    def arrays(self):
        return np.array(self.feature), np.array(self.cell), np.array(self.left)

    def paths(self, wanted):
        """The nodes and the way to the ``wanted``, for ``trees.arrivals``."""
        return self.feature, self.cell, self.left, T.paths(self.feature, self.left, set(wanted)), set(wanted)

    def small(self) -> list[int]:
        """The nodes whose subtrees grow in one task."""
        return [node for node, f in enumerate(self.feature) if f < 0 and node not in self.leaves]


def _split_large(blocks: DataFrame, tops: dict[int, _Top], settings: dict, limit: int) -> None:
    """Split every large node of the trees once: counts where the blocks lie,
    summed per node."""
    sizes, weights, classes, k = settings["sizes"], settings["weights"], settings["classes"], settings["k"]
    seed, min_leaf, features = settings["seed"], settings["min_leaf"], len(sizes)
    open_ = {t: top.paths(top.large) for t, top in tops.items() if top.large}
    subsets = {
        (t, node): T.feature_subsets(np.random.default_rng([seed, t, node, 1]), 1, features, k)[0] for t, top in tops.items() for node in top.large
    }

    def count(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for ids, x, y in _unpacked(batches, features):
            columns = np.ascontiguousarray(x.T)
            for tree, top in open_.items():
                n = T.draws(ids, tree, seed)
                for node, r in T.arrivals(*top, columns, np.flatnonzero(n)):
                    counts = T.histogram_at(columns, y, n, r, subsets[tree, node], sizes, classes)
                    sums[tree, node] = sums[tree, node] + counts if (tree, node) in sums else counts
        for (tree, node), counts in sums.items():
            yield _batch("tree int, node int, counts binary", [(tree, node, counts.tobytes())])

    def search(key, table):
        tree, node = (int(v.as_py()) for v in key)
        counts = sum(_array(v, np.float64, classes, -1) for v in table.column("counts"))
        gain, feature, cell, left, total = T.best_splits(counts, subsets[tree, node][None, :], sizes, weights, min_leaf)
        row = (tree, node, float(gain[0]), int(feature[0]), int(cell[0]), left[0].tobytes(), total[0].tobytes())
        return pa.Table.from_batches([_batch(found, [row])])

    found = "tree int, node int, gain double, feature int, cell int, lefts binary, total binary"
    counted = blocks.mapInArrow(count, "tree int, node int, counts binary")
    for top in tops.values():
        top.large = []
    # In order, since the numbers of new nodes draw their features.
    for r in sorted(counted.groupBy("tree", "node").applyInArrow(search, found).collect(), key=lambda r: (r.tree, r.node)):
        top, lefts, total = tops[r.tree], _array(r.lefts, np.float64), _array(r.total, np.float64)
        if r.gain > T.LEAST_GAIN and top.depth[r.node] < settings["depth"]:
            top.split(r.node, r.feature, r.cell, (lefts.sum(), (total - lefts).sum()), limit)
        else:
            shares = total * weights
            top.leaves[r.node] = (shares / shares.sum()).tolist()


def _grow_small(blocks: DataFrame, tops: dict[int, _Top], settings: dict) -> DataFrame:
    """The subtrees below the large nodes of the trees, landed: a node's rows
    are dealt to one task."""
    sizes, weights, classes = settings["sizes"], settings["weights"], settings["classes"]
    seed, features = settings["seed"], len(sizes)
    known = {t: top.paths(top.small()) for t, top in tops.items()}
    depths = {t: list(top.depth) for t, top in tops.items()}
    dealt = "tree int, node int, ids binary, x binary, y binary, n binary"

    def slices(data: np.ndarray, ends: np.ndarray):
        """The lines of ``data`` up to each of the ``ends``, as a binary column."""
        each = data.itemsize * (data.shape[1] if data.ndim > 1 else 1)
        bounds = np.concatenate([[0], ends * each]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])

    def pack(held, ids, x, y):
        trees, nodes, rows, n = zip(*held)
        ends, rows = np.cumsum([len(r) for r in rows]), np.concatenate(rows)
        columns = [pa.array(trees, type=pa.int32()), pa.array(nodes, type=pa.int32())]
        columns += [slices(v, ends) for v in (ids.take(rows), x.take(rows, axis=0), y.take(rows), np.concatenate(n).astype(np.uint8))]
        return pa.RecordBatch.from_arrays(columns, names=["tree", "node", "ids", "x", "y", "n"])

    def deal(batches):
        for ids, x, y in _unpacked(batches, features):
            columns, held, size = np.ascontiguousarray(x.T), [], 0
            for tree, top in known.items():
                n = T.draws(ids, tree, seed)
                for node, r in T.arrivals(*top, columns, np.flatnonzero(n)):
                    held.append((tree, node, r, n.take(r)))
                    size += len(r)
                if size >= DEALT_ROWS:
                    yield pack(held, ids, x, y)
                    held, size = [], 0
            if held:
                yield pack(held, ids, x, y)

    def grow(key, table):
        tree, node = (int(v.as_py()) for v in key)
        parts = {c: [v for v in table.column(c)] for c in ("ids", "x", "y", "n")}
        ids = np.concatenate([_array(v, np.uint64) for v in parts["ids"]])
        x = np.concatenate([_array(v, np.uint8, -1, features) for v in parts["x"]])
        y, n = (np.concatenate([_array(v, np.uint8) for v in parts[c]]).astype(np.int64) for c in ("y", "n"))
        order = np.argsort(ids, kind="stable")  # one order, however the rows came
        rng = np.random.default_rng([seed, tree, node])
        piece = T.grow(
            x[order], y[order], n[order], classes, sizes, weights, settings["k"], settings["min_leaf"], settings["depth"] - depths[tree][node], rng
        )
        return pa.Table.from_batches([_batch(PIECES, [(tree, node, *[a.tobytes() for a in piece])])])

    return land(blocks.mapInArrow(deal, dealt).groupBy("tree", "node").applyInArrow(grow, PIECES), "forest-pieces")


def _grouped(pieces: DataFrame, tops: dict[int, _Top], classes: int) -> DataFrame:
    """Whole trees, ``TREES_A_ROW`` to a row, landed. Children are numbered
    within the row; leaves name their line of shares in place of a child."""
    known = {t: (top.arrays(), dict(top.leaves)) for t, top in tops.items()}

    def join(key, table):
        grp = int(key[0].as_py())
        found = {(r["tree"], r["node"]): r for r in table.to_pylist()}
        roots, parts, base = [], [], 0
        for tree in sorted(t for t in known if t // TREES_A_ROW == grp):
            (feature, cell, left), leaves = known[tree]
            feature, cell, left = feature.copy(), cell.copy(), left + base
            shares = np.zeros((len(feature), classes))
            for node, own in leaves.items():
                shares[node] = own
            roots.append(base)
            subtrees, end = [], base + len(feature)
            for node in range(len(feature)):
                r = found.get((tree, node))
                if r is None:
                    continue
                # The piece's root takes the place of the node; its other
                # nodes follow the tree.
                f, c, l = _array(r["feature"], np.int16), _array(r["cell"], np.uint8), _array(r["left"], np.int32).astype(np.int64) + end - 1
                s = _array(r["shares"], np.float64, -1, classes)
                feature[node], cell[node], left[node], shares[node] = f[0], c[0], l[0], s[0]
                subtrees.append((f[1:], c[1:], l[1:], s[1:]))
                end += len(f) - 1
            parts += [(feature, cell, left, shares), *subtrees]
            base = end
        feature, cell, left, shares = (np.concatenate(v) for v in zip(*parts))
        leaf = feature < 0
        left[leaf] = np.arange(leaf.sum())
        row = (grp, np.array(roots, dtype=np.int64).tobytes(), feature.astype(np.int16).tobytes(), cell.astype(np.uint8).tobytes(), left.astype(np.int32).tobytes(), shares[leaf].tobytes())
        return pa.Table.from_batches([_batch(GROUPS, [row])])

    by = pieces.withColumn("grp", F.floor(F.col("tree") / TREES_A_ROW).cast("int"))
    return land(by.groupBy("grp").applyInArrow(join, GROUPS), "forest-trees")


def fit(
    rows: DataFrame, n: int, weights: list[float], num_trees: int, min_leaf: int, max_depth: int, max_bins: int, seed: int,
    features: str = "features", output: str = "probability", limit: int | None = None, range_rows: int | None = None,
) -> ForestModel:
    """The forest of ``n`` ``rows`` (split, user_id, target, features) with a
    weight a class. ``limit``: ``LOCAL_ROWS``; ``range_rows``: ``RANGE_ROWS``."""
    limit = limit or LOCAL_ROWS
    thresholds = _thresholds(rows, features, max_bins, n, seed, range_rows or RANGE_ROWS)
    blocks = _blocks(rows, features, thresholds, n)
    settings = {
        "sizes": np.array([len(c) + 1 for c in thresholds]), "weights": np.array(weights), "classes": len(weights),
        "k": ceil(sqrt(len(thresholds))), "seed": seed, "min_leaf": min_leaf, "depth": max_depth,
    }
    tops = {t: _Top(n, limit) for t in range(num_trees)}
    while any(top.large for top in tops.values()):
        _split_large(blocks, tops, settings, limit)
    at_once = max(TREES_A_ROW, DEALT_AT_ONCE // max(1, n))
    waves = [{t: tops[t] for t in range(i, min(num_trees, i + at_once))} for i in range(0, num_trees, at_once)]
    pieces = [_grow_small(blocks, wave, settings) for wave in waves]
    whole = pieces[0]
    for p in pieces[1:]:
        whole = whole.unionByName(p)
    return ForestModel(_grouped(whole, tops, len(weights)), thresholds, num_trees, len(weights), features, output)


class ForestModel(Model, MLReadable, MLWritable):
    """The trees applied: a vector of class probabilities for every row."""

    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", typeConverter=TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probability vector", typeConverter=TypeConverters.toString)
    numTrees = Param(Params._dummy(), "numTrees", "trees", typeConverter=TypeConverters.toInt)
    numClasses = Param(Params._dummy(), "numClasses", "classes", typeConverter=TypeConverters.toInt)
    thresholds = Param(Params._dummy(), "thresholds", "thresholds of every feature", typeConverter=TypeConverters.toList)

    def __init__(self, table=None, thresholds=None, trees=None, classes=None, features=None, output=None):
        super().__init__()
        self.table = table
        if thresholds is not None:
            self._set(thresholds=thresholds, numTrees=trees, numClasses=classes, featuresCol=features, probabilityCol=output)

    def getProbabilityCol(self) -> str:
        return self.getOrDefault(self.probabilityCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts = [np.array(c, dtype=np.float64) for c in self.getOrDefault(self.thresholds)]
        n_trees, classes, features = self.getOrDefault(self.numTrees), self.getOrDefault(self.numClasses), len(cuts)
        groups = ceil(n_trees / TREES_A_ROW)
        # Landed, so that the numbers of the rows stay.
        rows = land(dataset.withColumn("_row", F.monotonically_increasing_id()), "forest-scored")

        def bin_rows(batches):
            for b in batches:
                for i in range(0, b.num_rows, BLOCK_ROWS):
                    s = b.slice(i, BLOCK_ROWS)
                    ids = s.column("_row").to_numpy()
                    yield _batch("block long, ids binary, x binary", [(int(ids[0]), ids.tobytes(), T.binned(_matrix(s, "x"), cuts).tobytes())])

        def vote(batches):
            for b in batches:
                for i in range(b.num_rows):
                    x = _array(b.column("x")[i], np.uint8, -1, features)
                    roots, feature, cell, left = (
                        _array(b.column(c)[i], t) for c, t in (("roots", np.int64), ("feature", np.int16), ("cell", np.uint8), ("left", np.int32))
                    )
                    shares = _array(b.column("shares")[i], np.float64, -1, classes)
                    pairs = np.repeat(np.arange(len(x)), len(roots))
                    leaves = T.route(feature, cell, left, x, pairs, np.tile(roots, len(x)))
                    votes = shares[left[leaves]].reshape(len(x), len(roots), classes).sum(axis=1)
                    yield _batch(voted, [(b.column("block")[i].as_py(), b.column("grp")[i].as_py(), bytes(b.column("ids")[i].as_buffer()), votes.tobytes())])

        def mean(key, table):
            order = np.argsort(table.column("grp").to_numpy(), kind="stable")
            ids = _array(table.column("ids")[0], np.int64)
            votes = sum(_array(table.column("votes")[int(i)], np.float64, -1, classes) for i in order)
            shares = votes / votes.sum(axis=1, keepdims=True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * classes, type=pa.int32()), pa.array(shares.ravel()))
            return pa.table({"_row": pa.array(ids), "_shares": lists})

        voted = "block long, grp int, ids binary, votes binary"
        x = vector_to_array(self.getOrDefault(self.featuresCol)).alias("x")
        blocks = rows.select("_row", x).mapInArrow(bin_rows, "block long, ids binary, x binary")
        # Every block meets every row of trees, in a join dealt by their number.
        blocks = blocks.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        votes = blocks.join(self.table, "grp").select("block", "grp", "ids", "x", "roots", "feature", "cell", "left", "shares").mapInArrow(vote, voted)
        scores = votes.groupBy("block").applyInArrow(mean, "_row long, _shares array<double>")
        out = rows.join(scores, "_row").withColumn(self.getProbabilityCol(), array_to_vector("_shares"))
        return out.drop("_row", "_shares")

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader(cls)


class _ForestWriter(MLWriter):
    def __init__(self, instance: ForestModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.instance.table.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        self.instance.table.write.mode("overwrite").parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls(spark.read.schema(GROUPS).parquet(f"{path}/trees"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
