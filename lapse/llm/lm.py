"""Language-model scores: a hashed maximum-entropy model over word contexts.

A word belongs to a bucket (by hash); buckets are grouped into classes. The
model's probability of a word is the product of a softmax over classes, a
softmax over the class's buckets, and the word's smoothed share of its bucket.
Both softmaxes are maximum-entropy models with hashed features of the context:
the previous word, the two previous words, and the word before the previous
one (skip). Weights are trained by distributed gradient updates: the training
documents are split into as many parts as there are rounds; in a round every
task computes the gradient over its documents of that part in sparse batches,
the gradients are summed in Spark, and the weights move by a step scaled with
each feature's count. So every training document is used in exactly one round.

Beside the model, the base score is the add-one unigram score.

Scale: word counts are exact over all training documents, summed inside a task
first. Documents look up counts in a bounded table of the most frequent words
(``FREQUENT`` entries, broadcast); all other words are joined with the full
counts in Spark. Weights and gradients have a fixed size.

Words are identified by 64-bit hashes.

Defined cases: a null text counts as an empty one (one end token); with no
training documents every count is zero and the base score is 0; repeated rows
are counted and scored each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import LOWER, held_out
from lapse.llm.runs import column
from lapse.llm.words import grouped, mix, word_hashes_of
from lapse.operators.materialize import land

FREQUENT = 1 << 18
CLASSES = MEMBERS = 16  # 256 buckets: the top eight bits of a word's hash
CLASS_ROWS, MEMBER_ROWS = 1 << 12, 1 << 14
ROUNDS = 3
FEATURES = 3
SHRINK = 20.0
MAX_STEP = 1.0
GROUP_BYTES = 1 << 18  # bytes of text per numpy batch
COUNT_FLUSH = 1 << 21
BLOCK = 256  # weight rows per gradient message
START = np.uint64(0x5851F42D4C957F2D)
END = np.uint64(0x14057B7EF767814F)


def tokens_of(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of whole texts: the hashes of their lower-cased (A-Z) words,
    each text followed by the end, and the number of tokens of each text."""
    raw = ((t.as_py() or "").encode("utf-8", "replace").translate(LOWER) for t in texts)
    for group in grouped(raw, GROUP_BYTES):
        words, counts = word_hashes_of(group)
        ends = np.cumsum(counts + 1) - 1
        out = np.empty(len(words) + len(counts), dtype=np.uint64)
        is_word = np.ones(len(out), dtype=bool)
        is_word[ends] = False
        out[is_word], out[ends] = words, END
        yield out, counts + 1


def bucket_of(words: np.ndarray) -> np.ndarray:
    """The top eight bits of the word's hash."""
    return (words >> np.uint64(56)).astype(np.int64)


def contexts(words: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """One hash per token and feature; a text's first tokens see START."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[starts] = START
    skip = np.empty_like(words)
    skip[1:] = before[:-1]
    skip[starts] = START
    return [mix(before + np.uint64(1)), mix(skip * np.uint64(3) ^ before), mix(skip + np.uint64(2))]


class Table:
    """Open-addressing lookup of word hashes, all of a batch at once."""

    def __init__(self, words: np.ndarray, values: np.ndarray):
        size = 1 << max(4, (4 * len(words)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.used = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=bool)
        self.values, self.probes = np.zeros(size), 0
        left, place = np.arange(len(words)), (words & self.mask).astype(np.int64)
        while len(left):
            self.probes += 1
            free = left[~self.used[place[left]]]
            _, first = np.unique(place[free], return_index=True)
            won = free[first]
            self.keys[place[won]], self.values[place[won]], self.used[place[won]] = words[won], values[won], True
            left = np.setdiff1d(left, won, assume_unique=True)
            place[left] = (place[left] + 1) & (size - 1)

    def get(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value (0 if absent) and presence of each word."""
        place = (words & self.mask).astype(np.int64)
        found = self.used[place] & (self.keys[place] == words)
        value = np.where(found, self.values[place], 0.0)
        left = np.flatnonzero(self.used[place] & ~found)
        for _ in range(1, self.probes):
            if not len(left):
                break
            place[left] = (place[left] + 1) & int(self.mask)
            at = place[left]
            hit = self.used[at] & (self.keys[at] == words[left])
            found[left[hit]] = True
            value[left[hit]] = self.values[at[hit]]
            left = left[self.used[at] & ~hit]
        return value, found


class Weights:
    """Softmax weights; rows are hashed features, the last row is the bias."""

    def __init__(self, totals: np.ndarray):
        share = (totals.reshape(CLASSES, MEMBERS) + 0.5) / (totals.sum() + 0.5 * totals.size)
        self.class_share = share.sum(axis=1)
        self.member_share = share / self.class_share[:, None]
        self.class_rows = np.zeros((CLASS_ROWS, CLASSES), dtype=np.float32)
        self.member_rows = np.zeros((MEMBER_ROWS, MEMBERS), dtype=np.float32)

    def rows(self, features: list[np.ndarray], classes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        top = [(f & np.uint64(CLASS_ROWS - 1)).astype(np.uint16) for f in features]
        salt = mix(np.arange(CLASSES, dtype=np.uint64) + np.uint64(11))[classes]
        low = [((f + salt >> np.uint64(20)) & np.uint64(MEMBER_ROWS - 1)).astype(np.uint16) for f in features]
        return top, low

    def scores(self, words: np.ndarray, features: list[np.ndarray]):
        """Class and member numbers, rows, and both softmaxes' exponentials
        with their sums."""
        classes, members = np.divmod(bucket_of(words), MEMBERS)
        top, low = self.rows(features, classes)
        out = []
        for rows, weights, bias in (
            (top, self.class_rows, np.log(self.class_share).astype(np.float32)[None]),
            (low, self.member_rows, np.log(self.member_share).astype(np.float32)[classes]),
        ):
            z = weights[rows[0]]
            for r in rows[1:]:
                z += weights[r]
            z += bias
            # Weights are bounded by the rounds' steps, so nothing overflows.
            np.exp(z, out=z)
            out.append((z, z.sum(axis=1)))
        return classes, members, top, low, *out

    def log10(self, words: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
        """log10 probability of every word's bucket."""
        classes, members, _, _, (p, p_sum), (q, q_sum) = self.scores(words, features)
        at = np.arange(len(words))
        return np.log10((p[at, classes] / p_sum).astype(float) * (q[at, members] / q_sum))

    def step(self, top: np.ndarray, low: np.ndarray) -> None:
        """Move against summed gradients (last column: feature counts)."""
        for rows, gradient, share in (
            (self.class_rows, top, self.class_share),
            (self.member_rows, low, np.full(MEMBERS, 1.0 / MEMBERS)),
        ):
            curve = gradient[:, -1:] * (share * (1.0 - share))[None] + SHRINK
            rows -= np.clip(gradient[:, :-1] / (FEATURES * curve), -MAX_STEP, MAX_STEP).astype(np.float32)


def _add(target: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Sum the values (and a count in the last column) into their rows."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    where = ordered[first]
    target[where, :-1] += np.add.reduceat(values[order], first, axis=0)
    target[where, -1] += np.diff(np.append(first, len(rows)))


def gradient_batch(weights: Weights, words: np.ndarray, features: list[np.ndarray], top_sum: np.ndarray, low_sum: np.ndarray) -> None:
    classes, members, top, low, (p, p_sum), (q, q_sum) = weights.scores(words, features)
    p /= p_sum[:, None]
    q /= q_sum[:, None]
    at = np.arange(len(words))
    p[at, classes] -= 1.0
    q[at, members] -= 1.0
    for r in top:
        _add(top_sum, r, p)
    for r in low:
        _add(low_sum, r, q)


def word_counts(docs: DataFrame, learn: Column) -> DataFrame:
    """(word, n) over the tokens of the documents that ``learn`` admits."""

    def flush(parts: list) -> tuple[np.ndarray, np.ndarray]:
        words, where = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        return words, np.bincount(where, weights=np.concatenate([n for _, n in parts]), minlength=len(words)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held, size = [], 0
            for words, _ in tokens_of(batch.column(0)):
                held.append(words)
                size += len(words)
                if size > COUNT_FLUSH:
                    done.append(np.unique(np.concatenate(held), return_counts=True))
                    held, size = [], 0
            if held:
                done.append(np.unique(np.concatenate(held), return_counts=True))
            if sum(len(w) for w, _ in done) > COUNT_FLUSH:
                done = [flush(done)]
                if len(done[0][0]) > COUNT_FLUSH // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(done[0][0].view(np.int64)), pa.array(done[0][1])], ["word", "n"])
                    done = []
        if done:
            words, n = flush(done)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    rows = docs.where(learn).select(F.col("text").cast("string")).mapInArrow(run, "word long, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """At most ``limit`` most frequent words (sorted) with their counts, and
    the count from which words are among them."""
    steps = F.floor(F.log2("n") * 16)
    sizes = sorted(((r["step"], r["low"], r["size"]) for r in counts.groupBy(steps.alias("step")).agg(F.min("n").alias("low"), F.count("*").alias("size")).collect()), reverse=True)
    least, total = None, 0
    for _, low, size in sizes:
        if total + size > limit:
            break
        least, total = low, total + size
    if least is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0), sizes[0][1] + (1 << 62) if sizes else 1
    table = counts.where(F.col("n") >= least).toArrow()
    words, n = (table.column(c).to_numpy() for c in ("word", "n"))
    order = np.argsort(words.view(np.uint64))
    return words.view(np.uint64)[order], n[order].astype(float), least


def _blocks(top: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    both = np.concatenate([top, low]).astype(np.float32)
    ids = [i for i in range(0, len(both), BLOCK) if both[i : i + BLOCK].any()]
    blobs = [both[i : i + BLOCK].tobytes() for i in ids]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["block", "sums"])


def train_round(part: DataFrame, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Summed gradients over the texts of ``part``."""

    def gradients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, low = np.zeros((CLASS_ROWS, CLASSES + 1)), np.zeros((MEMBER_ROWS, MEMBERS + 1))
        for batch in batches:
            for words, sizes in tokens_of(batch.column(0)):
                gradient_batch(weights, words, contexts(words, np.cumsum(sizes) - sizes), top, low)
        yield _blocks(top, low)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(blob.as_py(), dtype=np.float32)
                sums[block] = sums.get(block, 0) + values.astype(float)
        blobs = [v.astype(np.float32).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(blobs, pa.binary())], ["block", "sums"])

    schema = "block long, sums binary"
    # Summed as a stream: a task holds one block's sum, whatever the number of messages.
    found = part.select(F.col("text").cast("string")).mapInArrow(gradients, schema).repartition("block").mapInArrow(add, schema)
    both = np.zeros((CLASS_ROWS + MEMBER_ROWS, CLASSES + 1))
    for r in found.collect():
        both[r["block"] : r["block"] + BLOCK] += np.frombuffer(r["sums"], dtype=np.float32).reshape(-1, CLASSES + 1)
    return both[:CLASS_ROWS], both[CLASS_ROWS:]


def train(docs: DataFrame, learn: Column, totals: np.ndarray, rounds: int = ROUNDS) -> Weights:
    if rounds * FEATURES * MAX_STEP > 80:
        raise ValueError("too many rounds for single precision exponentials")
    weights = Weights(totals)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    for r in range(rounds):
        weights.step(*train_round(docs.where(learn & (part == r)), weights))
    return weights


def score_documents(docs: DataFrame, divisor: int = 7, frequent: int = FREQUENT, rounds: int = ROUNDS) -> DataFrame:
    """Base and model score of every document; rows whose id's crc32 leaves 2
    modulo ``divisor`` are held out of counts and training."""
    out = held_out(divisor)
    counts = land(word_counts(docs, ~out), "lm-counts")
    n_all, n_words = (v or 0 for v in counts.agg(F.sum("n"), F.count("*")).first())
    bucket = F.pmod(F.shiftrightunsigned("word", 56), F.lit(CLASSES * MEMBERS))
    totals, kinds = np.zeros(CLASSES * MEMBERS), np.zeros(CLASSES * MEMBERS)
    for r in counts.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        totals[r["bucket"]], kinds[r["bucket"]] = r["n"], r["v"]
    weights = train(docs, ~out, totals, rounds)
    known, known_n, least = frequent_words(counts, frequent)
    shared = docs.sparkSession.sparkContext.broadcast((known, np.log10(known_n + 1.0)))
    bucket_size = np.log10(totals + kinds + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)
        for batch in batches:
            results: list[list] = [[], [], [], [], [], []]
            for words, sizes in tokens_of(batch.column("text")):
                starts = np.cumsum(sizes) - sizes
                model = weights.log10(words, contexts(words, starts)) - bucket_size[bucket_of(words)]
                gain, found = table.get(words)
                for list_, values in zip(results, (sizes, np.add.reduceat(found.astype(np.int64), starts), np.add.reduceat(gain, starts), np.add.reduceat(model, starts))):
                    list_.extend(values.tolist())
                # The other words of each text, once with their number.
                rare = np.flatnonzero(~found)
                text = np.searchsorted(starts, rare, side="right") - 1
                order = np.lexsort((words[rare], text))
                text, rare = text[order], words[rare][order]
                first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (rare[1:] != rare[:-1]))) if len(rare) else rare.astype(int)
                times = np.diff(np.append(first, len(rare)))
                cuts = np.searchsorted(text[first], np.arange(1, len(sizes)))
                results[4] += np.split(rare[first].view(np.int64), cuts)
                results[5] += np.split(times, cuts)
            kinds_ = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["n_tokens", "n_found", "gain", "model", "rare", "times"]
            arrays = [pa.array(v, k) for v, k in zip(results, kinds_)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *arrays], ["row", "doc_id", "held_out", *names])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), out.alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_found long, gain double, model double, rare array<long>, times array<long>"
    scored = land(rows.mapInArrow(run, schema), "lm-rows")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    looked_up = rare.join(counts.where(F.col("n") < least), "word")
    extra = looked_up.groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("more_gain")
    )
    gain = F.col("gain") + F.coalesce("more_gain", F.lit(0.0))
    return (
        scored.drop("rare", "times")
        .join(extra, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_found") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
            F.lit(n_all).cast("long").alias("train_tokens"),
            (gain - F.col("n_tokens") * F.lit(math.log10(n_all + n_words + 1))).alias("base_score"),
            (gain + F.col("model")).alias("score"),
        )
    )
