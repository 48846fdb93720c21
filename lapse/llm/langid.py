"""Language identification by levels: family first, then language.

Texts become hashed counts of byte n-grams (1 to 3 bytes of the lower-cased
text), square-rooted and scaled to length one. Linear support vector machines
(squared hinge, one against one) pick the language family; within a family
one-against-one machines separate its languages. Where more than ``MAX_CLASSES``
families (or languages of one family) occur, those with similar profiles form
groups, and a level of machines among the groups comes before. So the number of
machines grows with the labels, not with their square.

Every set of machines is fitted in a task of its own, on a bounded sample of
labelled rows: of each language the ``per_language`` different texts (at most
``SAMPLE_ROWS`` of a set) that a hash draws first; copies of a text count once.
The ``MAX_LABELS`` labels with the most texts are learned, which bounds the sample
and what the driver gets: the labels' counts and the weights. Prediction reads
whole texts, in Arrow batches.

Defined cases: null text or text without a letter gives ``und`` with score 0;
null languages are not learned from; with a single learned language every
other text gets that language; with none every text gets ``und``; repeated
rows are predicted each, and a hot text does not outweigh others in the fit;
null ids are not held out; ties between languages go to the first by name, ties
between labels for a place among those learned too; texts of any length are
profiled in pieces; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import UNIT, held_out, unit_hash

DIMS = 1 << 12
SAMPLE_PER_LANGUAGE = 400
SAMPLE_ROWS = 8000  # of one set of machines: feature vectors of 131 MB at most
MAX_CLASSES = 32  # of one set, which has a machine per pair of classes
MAX_LABELS = 256  # learned in all: 72 MB of weights at most
CENTRE_ROWS, CENTRE_DIMS = 50, 64  # rows of a language, and dimensions, of its mean profile
UNKNOWN = "und"
RELABEL_SCORE = 0.9  # a label is corrected where another language is this sure
PIECE = 1 << 20

# Languages by family; a code not listed is its own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "mr", "ur", "ne", "pa", "gu"),
    "celtic": ("ga", "cy", "gd", "br"),
    "semitic": ("ar", "he"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], lang)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Hashed n-gram profile of the whole text, in bounded pieces."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    counts = np.zeros(DIMS)
    for at in range(0, len(raw), PIECE):
        b = raw[at : at + PIECE + 2].astype(np.uint32)
        m = min(PIECE, len(raw) - at)
        one, two = b[:m], (b[:-1] << 8 | b[1:])[:m]
        three = (b[:-2] << 16 | b[1:-1] << 8 | b[2:])[:m]
        for n, gram in enumerate((one, two, three)):
            slot = (gram + np.uint32(n * 0x51ED27)) * np.uint32(0x9E3779B1) >> np.uint32(20)
            counts += np.bincount(slot, minlength=DIMS)
    counts = np.sqrt(counts)
    return counts / max(np.linalg.norm(counts), 1e-12)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 150) -> np.ndarray:
    """Weights (bias last) of a linear machine, classes weighted evenly, by
    accelerated gradient descent on the squared hinge loss."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = v = np.zeros(x.shape[1])
    rate = 1.0 / (1.0 + 4.0 * c)  # rows have squared length 2 at most
    for t in range(rounds):
        slack = np.maximum(0.0, 1.0 - y * (x @ v.astype(x.dtype)))
        push = (weight * slack * y).astype(x.dtype) @ x
        new = v - rate * (v - 2.0 * c * push)
        v = new + t / (t + 3.0) * (new - w)
        w = new
    return w.astype(np.float32)


class Machines:
    """One-against-one machines over a set of classes."""

    def __init__(self, classes: list, weights: np.ndarray):
        self.classes, self.weights = classes, weights
        self.pairs = list(combinations(range(len(classes)), 2))

    @staticmethod
    def fit(x: np.ndarray, labels: np.ndarray) -> tuple[list, np.ndarray]:
        """Classes, and a row of weights per pair of them."""
        classes, rows = sorted(set(labels.tolist())), []
        for a, b in combinations(classes, 2):
            either = (labels == a) | (labels == b)
            rows.append(fit_svm(x[either], np.where(labels[either] == a, 1.0, -1.0)))
        return classes, np.array(rows, dtype=np.float32).reshape(len(rows), x.shape[1] + 1)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class number and score (0 to 1) of each row."""
        n = len(self.classes)
        if n == 1:
            return np.zeros(len(x), dtype=int), np.ones(len(x))
        margin = x @ self.weights[:, :-1].T + self.weights[:, -1]
        sure = 1.0 / (1.0 + np.exp(-4.0 * np.clip(margin, -50, 50)))
        total = np.zeros((len(x), n))
        for j, (a, b) in enumerate(self.pairs):
            total[:, a] += sure[:, j]
            total[:, b] += 1.0 - sure[:, j]
        best = total.argmax(axis=1)
        return best, total[np.arange(len(x)), best] / (n - 1)


def _groups(members: list[tuple]) -> list[list[tuple]]:
    """Members (mean profile, ...) in groups of ``MAX_CLASSES`` at most, halved
    along the direction in which the profiles differ most."""
    if len(members) <= MAX_CLASSES:
        return [members]
    x = np.array([m[0] for m in members])
    x = x - x.mean(axis=0)
    order = np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")
    halves = np.split(order, [len(order) // 2])
    return [g for half in halves for g in _groups([members[i] for i in sorted(half)])]


class Tree:
    """Levels of classes: ``nodes`` lists the children of each node, which are
    languages or numbers of nodes; ``root`` is one of either."""

    def __init__(self, centres: dict[str, np.ndarray | None]):
        self.nodes: list[list[str | int]] = []
        families: dict[str, list[tuple]] = {}
        for lang in sorted(centres):
            families.setdefault(family(lang), []).append((centres[lang], lang))
        self.root = self._join([self._join(families[f]) for f in sorted(families)])[1]

    def _join(self, members: list[tuple]) -> tuple:
        """One member (mean profile, child) over all of ``members``."""
        if len(members) > MAX_CLASSES:
            return self._join([self._join(g) for g in _groups(members)])
        if len(members) == 1:
            return members[0]
        self.nodes.append([child for _, child in members])
        known = [c for c, _ in members if c is not None]
        return np.mean(known, axis=0) if known else None, len(self.nodes) - 1

    def languages(self, child: str | int) -> list[str]:
        return [child] if isinstance(child, str) else [v for c in self.nodes[child] for v in self.languages(c)]


class Model:
    """Machines of every node of a tree; without a tree, all is unknown."""

    def __init__(self, tree: Tree | None, fitted: dict[int, tuple] | None = None):
        self.tree = tree
        self.machines = {n: Machines(*m) for n, m in (fitted or {}).items()}

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        langs, scores = np.full(len(x), UNKNOWN, dtype=object), np.zeros(len(x))

        def descend(child: str | int, rows: np.ndarray, sure: np.ndarray) -> None:
            if isinstance(child, str):
                langs[rows], scores[rows] = child, sure
                return
            if child not in self.machines:
                under = self.tree.languages(child)
                langs[rows], scores[rows] = under[0], sure / len(under)
                return
            chosen, score = self.machines[child].predict(x[rows])
            for j, c in enumerate(self.machines[child].classes):
                here = np.flatnonzero(chosen == j)
                if len(here):
                    descend(self.tree.nodes[child][c], rows[here], sure[here] * score[here])

        if self.tree is not None and len(x):
            descend(self.tree.root, np.arange(len(x)), np.ones(len(x)))
        return langs, scores


def _sample(known: DataFrame, wanted: pa.Table) -> DataFrame:
    """Different texts of ``known`` (lang, text, draw), those drawn first: as
    many for each row of ``wanted`` (lang, ..., rows, rate) as its ``rows``.
    ``rate`` is a draw below which there are enough, so only those are dealt."""
    table = F.broadcast(known.sparkSession.createDataFrame(wanted).withColumnRenamed("lang", "__lang"))
    drawn = known.join(table, (F.col("lang") == F.col("__lang")) & (F.col("draw") / F.lit(float(UNIT)) < F.col("rate"))).drop("__lang")
    keys = [c for c in wanted.column_names if c != "rate"]
    once = drawn.groupBy(*keys, "draw").agg(F.min("text").alias("text"))
    order = Window.partitionBy(*[k for k in keys if k != "rows"]).orderBy("draw", "text")
    return once.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= F.col("rows"))


def _enough(rows: int, texts: int) -> float:
    """A rate at which ``rows`` of ``texts`` are drawn, all but surely."""
    return min(1.0, (rows + 6 * math.sqrt(rows) + 20) / texts)


def mean_profiles(known: DataFrame, counts: dict[str, int]) -> dict[str, np.ndarray]:
    """A folded mean profile of each language, of about ``CENTRE_ROWS`` rows."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).reshape(CENTRE_DIMS, -1).sum(axis=1) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["lang", "x"])

    rates = [_enough(CENTRE_ROWS, n) for n in counts.values()]
    wanted = pa.table({"lang": list(counts), "rows": [CENTRE_ROWS] * len(counts), "rate": rates})
    folded = _sample(known, wanted).select("lang", "text").mapInArrow(fold, "lang string, x array<double>")
    # Rounded, since sums depend on arrival.
    means = folded.groupBy("lang").agg(F.array(*[F.round(F.avg(F.get("x", F.lit(i))), 6) for i in range(CENTRE_DIMS)]).alias("x"))
    found = {r["lang"]: np.array(r["x"]) for r in means.collect()}
    return {lang: found.get(lang, np.zeros(CENTRE_DIMS)) for lang in counts}


def fit(docs: DataFrame, learn: Column | None = None, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on bounded, hash-drawn samples of the labelled rows of ``docs``
    (text, lang) that ``learn`` admits. A task fits a node; only weights return."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = unit_hash(F.lit("sample"), F.xxhash64("text")).alias("draw")
    known = (known if learn is None else known.where(learn)).select("lang", "text", draw)
    texts = known.groupBy("lang", "draw").agg(F.lit(1).alias("one")).groupBy("lang").count()
    most = texts.orderBy(F.desc("count"), "lang").limit(MAX_LABELS)
    counts = {r["lang"]: r["count"] for r in most.collect()}
    if not counts:
        return Model(None)
    many = len(counts) > MAX_CLASSES
    tree = Tree(mean_profiles(known, counts) if many else dict.fromkeys(counts))
    paths = []
    for node, children in enumerate(tree.nodes):
        under = [tree.languages(c) for c in children]
        rows = max(1, min(per_language, SAMPLE_ROWS // sum(map(len, under))))
        paths += [(lang, node, c, rows, _enough(rows, counts[lang])) for c, langs in enumerate(under) for lang in langs]
    if not paths:
        return Model(tree)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).astype(np.float32).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], ["node", "child", "x"])

    def train(table: pa.Table) -> pa.Table:
        # In an order that does not depend on arrival.
        rows = sorted(zip(table.column("child").to_pylist(), table.column("x").to_pylist()))
        x = np.frombuffer(b"".join(b for _, b in rows), dtype=np.float32).reshape(len(rows), DIMS)
        fitted = pickle.dumps(Machines.fit(x, np.array([c for c, _ in rows])))
        return pa.table({"node": table.column("node").slice(0, 1), "fitted": pa.array([fitted], pa.binary())})

    wanted = pa.table(dict(zip(("lang", "node", "child", "rows", "rate"), zip(*paths))))
    profiles = _sample(known, wanted).select("node", "child", "text").mapInArrow(profile, "node long, child long, x binary")
    fitted = profiles.groupBy("node").applyInArrow(train, "node long, fitted binary").collect()
    return Model(tree, {r["node"]: pickle.loads(r["fitted"]) for r in fitted})


def predict(docs: DataFrame, model: Model, keep: list[str], lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs`` with the predicted language and score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            usable = [i for i, t in enumerate(texts) if t and has_letter(t)]
            langs, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            for at in range(0, len(usable), 256):
                some = usable[at : at + 256]
                langs[some], scores[some] = model.predict(np.array([features(texts[i]) for i in some]))
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(langs, pa.string()), pa.array(scores)], [*keep, lang, score])

    rows = docs.select(*keep, F.col("text").alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, `{lang}` string, `{score}` double")


def identify(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score; rows whose id's crc32 leaves 2
    modulo 4 are held out of the fit."""
    out = held_out(4)
    model = fit(docs, ~out, per_language)
    rows = docs.select(F.col("doc_id").cast("long"), out.alias("held_out"), F.col("text").cast("string"))
    return predict(rows, model, ["doc_id", "held_out"])


def lettered(docs: DataFrame) -> DataFrame:
    """The documents whose text holds a letter; all columns unchanged."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(t) and has_letter(t) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def settle_language(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, sure: float = RELABEL_SCORE) -> DataFrame:
    """The documents whose text holds a letter, so that a language can be told;
    the others go. A null ``lang`` becomes the predicted language; a label is
    replaced where another language is predicted with a score of at least
    ``sure``. A text is judged by a model that has learned from other texts only
    (two halves by a hash of the text), so a wrong label does not vouch for
    itself. All other columns are unchanged. Where no language could be learned,
    nothing is told and the letters alone decide."""
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    models = [fit(docs, ~held_out(4) & (half != side), per_language) for side in (0, 1)]
    learned = [m for m in models if m.tree is not None]
    if not learned:
        return lettered(docs)
    models = [m if m.tree is not None else learned[0] for m in models]
    judged = [predict(docs.where(half == side), m, docs.columns, "__lang_pred", "__lang_score") for side, m in enumerate(models)]
    known = judged[0].unionByName(judged[1])
    # A fitted model names a language for every lettered text.
    wrong = F.col("lang").isNull() | ((F.col("__lang_pred") != F.col("lang")) & (F.col("__lang_score") >= sure))
    settled = known.where(F.col("__lang_score") > 0).withColumn("lang", F.when(wrong, F.col("__lang_pred")).otherwise(F.col("lang")))
    return settled.select(*docs.columns)
