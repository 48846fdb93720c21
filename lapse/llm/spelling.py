"""Spelling variants: words one edit apart, found with blocked Gram matrices.

A word is a vector of letter counts. One inserted or deleted letter moves it
by squared distance 1, one replaced letter by 2. Words are blocked by length
and by their letters' counts in a few classes: one edit leads to the same
block, to one with a letter moved between two classes, or to an adjacent
length with one letter more in one class. For each pair of such blocks a NumPy
product of the count matrices gives all squared distances; pairs at most two
apart are kept and their edits verified on the letters.

Scale: texts are reduced to counts per word in the tasks. The number of
classes follows the counted vocabulary, so blocks keep their size as it grows
and the pairs compared grow about linearly. A block larger than a part is dealt
over several, and every part of it meets every part of its neighbours in a
task of its own. Pairs never leave their task: it returns each word's number
of near words and the best of them.

Defined cases: a null text has no words; a null id counts as empty text;
repeated rows count each; ties between near words of equal count go to the
smaller in code-point order; words and texts may have any length; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import LOWER
from lapse.llm.words import PIECE
from lapse.operators.materialize import join_small, land, release

MIN_LENGTH, MIN_COUNT, FORM_RATIO = 5, 3, 2
SLIP = 97  # one (document, word) of so many loses a letter
HELD_WORDS = 200_000
PART_WORDS, PART_LETTERS = 2048, 1 << 21
BLOCK_WORDS = 500
MAX_CLASSES = 12
MAX_ROUNDS = 64

# U+00C0 to U+00FF are two bytes each, the first of them C3.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
BREAK = re.compile(rb"[\x00-@\[-`{-\x7f]")


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Parts of about ``size`` bytes, cut at a byte that is in no run."""
    at = 0
    while at < len(text):
        found = BREAK.search(text, at + size) if at + size < len(text) else None
        stop = found.end() if found else len(text)
        yield text[at:stop]
        at = stop


def slipped(word: bytes, crc: int) -> bytes:
    """The word, less one letter where the hash says so."""
    if crc % SLIP:
        return word
    letters = word.decode("utf-8")
    at = crc % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode("utf-8")


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n) over all texts, words of at least ``min_length`` letters."""

    def summed(total: Counter) -> pa.RecordBatch:
        words = [w for w in total if len(w) - w.count(b"\xc3") >= min_length]
        out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([total[w] for w in words], pa.int64())], ["word", "n"])
        total.clear()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for key, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                seed = zlib.crc32(f"{key}:".encode())
                for part in pieces(cell.as_py() or b""):
                    for word, n in Counter(RUN.findall(part.translate(LOWER))).items():
                        total[slipped(word, zlib.crc32(word, seed))] += n
                    if len(total) > HELD_WORDS:
                        yield summed(total)
        yield summed(total)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("binary"))
    found = rows.mapInArrow(run, "word binary, n long")
    return found.groupBy(F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))


def n_classes(n_words: int, block_words: int = BLOCK_WORDS) -> int:
    """Letter classes that keep blocks near ``block_words``: some dozen lengths
    occur, and every class divides a block by about three."""
    return max(1, min(MAX_CLASSES, 1 + math.ceil(math.log(max(1.0, n_words / (12 * block_words)), 3))))


def counts_matrix(words: list[bytes], letters: np.ndarray) -> np.ndarray:
    """Rows of letter counts; ``letters`` maps a code point to its column."""
    width = int(letters.max()) + 1
    lengths = np.array([len(w) for w in words])
    rows = np.repeat(np.arange(len(words)), lengths)
    columns = letters[np.frombuffer(b"".join(words), dtype=np.uint8)]
    # Squares of float32 counts are exact up to lengths of 2,048.
    kind = np.float32 if lengths.max(initial=0) < 2048 else np.float64
    return np.bincount(rows * width + columns, minlength=len(words) * width).reshape(len(words), width).astype(kind)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of two letter matrices of one width that differ in one place."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows where ``long`` is ``short`` with one letter more."""
    head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= short.shape[1]


def near_pairs(home: list[bytes], visitors: list[bytes], own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (home, visitor) of words one edit apart. Home words have one
    length, visitors that or one less (words as one byte a letter); ``own``
    marks visitors of the same block, which meet larger words only."""
    used = np.unique(np.frombuffer(b"".join(home + visitors), dtype=np.uint8))
    letters = np.zeros(256, dtype=np.int64)
    letters[used] = np.arange(len(used))
    length = len(home[0])
    x, y = counts_matrix(home, letters), counts_matrix(visitors, letters)
    x2, y2 = (x * x).sum(axis=1), (y * y).sum(axis=1)
    spelled = np.frombuffer(b"".join(home), dtype=np.uint8).reshape(len(home), length)
    lengths = np.array([len(w) for w in visitors])
    where = np.append(0, np.cumsum(lengths))
    letters_of = np.frombuffer(b"".join(visitors), dtype=np.uint8)
    out = []
    step = max(1, (1 << 20) // max(1, len(visitors)))
    pairs_step = max(1, (1 << 22) // length)
    for at in range(0, len(home), step):
        distance = x2[at : at + step, None] + y2[None] - 2 * (x[at : at + step] @ y.T)
        h, v = np.nonzero((distance > 0) & (distance <= 2))
        h += at
        for some in range(0, len(h), pairs_step):
            hs, vs = h[some : some + pairs_step], v[some : some + pairs_step]
            same = lengths[vs] == length
            near = np.zeros(len(hs), dtype=bool)
            for which, width, test in ((same, length, one_replaced), (~same, length - 1, lambda a, b: one_inserted(b, a))):
                if which.any():
                    other = letters_of[where[vs[which]][:, None] + np.arange(width)]
                    near[which] = test(spelled[hs[which]], other)
            near &= ~own[vs] | np.array([home[i] < visitors[j] for i, j in zip(hs.tolist(), vs.tolist())], dtype=bool)
            out.append((hs[near], vs[near]))
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _best_rows(words: list[bytes], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[bytes, int, int, bytes]]:
    """(word, near words, count and word of the best) for pairs (a, b)."""
    if not len(a):
        return []
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    sizes = np.diff(np.append(first, len(a)))
    return [(words[a[i]], int(m), int(n[b[i]]), words[b[i]]) for i, m in zip(first.tolist(), sizes.tolist())]


def _dealt(vocabulary: DataFrame, classes: int) -> DataFrame:
    """(length, key, home, own, code, n): every word at home in its block, and
    as a visitor in the blocks that one edit can lead to, once a pair."""

    def visits(codes: list[bytes], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(c) for c in codes])
        rows = np.repeat(np.arange(len(codes)), lengths)
        of = np.frombuffer(b"".join(codes), dtype=np.uint8) % classes
        counts = np.bincount(rows * classes + of, minlength=len(codes) * classes).reshape(len(codes), classes)
        everyone = np.arange(len(codes))

        def rows_of(which, to, more, home, own):
            length = lengths[which] + more
            for kind in (np.uint8, np.uint32):  # counts of a block of short words fit a byte
                some = np.flatnonzero((length < 256) == (kind == np.uint8))
                if not len(some):
                    continue
                raw = np.ascontiguousarray(to[some], dtype=kind)
                offsets = np.arange(len(some) + 1, dtype=np.int32) * (raw.dtype.itemsize * classes)
                columns = [
                    pa.array(length[some].astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]),
                    pa.array(np.full(len(some), home)), pa.array(np.full(len(some), own)),
                    pa.array([codes[i] for i in which[some].tolist()], pa.binary()), pa.array(n[which[some]]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["length", "key", "home", "own", "code", "n"])

        unit = np.eye(classes, dtype=np.int64)
        yield from rows_of(everyone, counts, 0, True, True)
        yield from rows_of(everyone, counts, 0, False, True)
        for j in range(classes):
            yield from rows_of(everyone, counts + unit[j], 1, False, False)
            for i in range(j + 1, classes):
                some = np.flatnonzero(counts[:, i])
                yield from rows_of(some, counts[some] + unit[j] - unit[i], 0, False, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from visits(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False))

    rows = vocabulary.select(F.encode("word", "ISO-8859-1"), "n")
    return rows.mapInArrow(run, "length int, key binary, home boolean, own boolean, code binary, n long")


GROUP = ["length", "key", "p", "q"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of a stream sorted by ``GROUP``."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        changed = np.zeros(batch.num_rows, dtype=bool)
        for name in GROUP:
            values = batch.column(name)
            changed[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
        first = tuple(batch.column(name)[0].as_py() for name in GROUP)
        changed[0] = last is not None and first != last
        edges = [0, *np.flatnonzero(changed).tolist()]
        for begin, end in zip(edges, [*edges[1:], batch.num_rows]):
            if changed[begin]:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(begin, end - begin))
        last = tuple(batch.column(name)[batch.num_rows - 1].as_py() for name in GROUP)
    if held:
        yield pa.concat_tables(held)


def near_words(vocabulary: DataFrame, classes: int | None = None) -> DataFrame:
    """(word, n_near, near_n, near) of the words of a landed (word, n) that
    have near ones: how many, and the most frequent of them."""
    classes = classes or n_classes(vocabulary.count())
    rows = _dealt(vocabulary, classes)
    part = F.greatest(F.lit(1), F.least(F.lit(PART_WORDS), (PART_LETTERS / F.col("length")).cast("int")))
    sizes = rows.groupBy("length", "key").agg(*[F.count_if(c).alias(k) for c, k in ((F.col("home"), "h"), (~F.col("home"), "v"))])
    sizes = sizes.where("h > 0").select("length", "key", *[F.ceil(F.col(c) / part).cast("int").alias(c) for c in ("h", "v")])
    sizes = land(sizes, "spelling-blocks")
    dealt = join_small(rows, sizes, ["length", "key"], "inner")
    number = F.xxhash64("code")
    own_part = lambda at, n: F.array(F.pmod(number, F.col(n)).cast("int")) if at else F.sequence(F.lit(0), F.col(n) - 1)
    dealt = dealt.withColumn("p", F.explode(F.when(F.col("home"), own_part(True, "h")).otherwise(own_part(False, "h"))))
    dealt = dealt.withColumn("q", F.explode(F.when(F.col("home"), own_part(False, "v")).otherwise(own_part(True, "v"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in _groups(batches):
            at_home = group.column("home").to_numpy()
            home, visitors = group.filter(at_home), group.filter(~at_home)
            if home.num_rows and visitors.num_rows:
                mine, others = home.column("code").to_pylist(), visitors.column("code").to_pylist()
                a, b = near_pairs(mine, others, visitors.column("own").to_numpy())
                b += len(mine)
                n = np.concatenate([home.column("n").to_numpy(), visitors.column("n").to_numpy()])
                # Words of the block are there twice, at home and as visitors.
                words = mine + others
                out += _best_rows(words, n, np.concatenate([a, b]), np.concatenate([b, a]))
            if len(out) > HELD_WORDS:
                yield emitted(out)
        yield emitted(out)

    def emitted(out: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.binary()))]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, ["code", "n_near", "near_n", "near"])

    dealt = dealt.select(*GROUP, "home", "own", "code", "n").repartition(*[F.col(c) for c in GROUP]).sortWithinPartitions(*GROUP)
    found = dealt.mapInArrow(run, "code binary, n_near long, near_n long, near binary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = found.groupBy("code").agg(F.sum("n_near").alias("n_near"), best)
    letters = lambda c: F.decode(c, "ISO-8859-1")
    return near.select(letters("code").alias("word"), "n_near", (-F.col("best.less")).alias("near_n"), letters("best.near").alias("near"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of a landed (word, form) without
    cycles, its length halved every round."""
    state = links.select("word", F.col("form").alias("root"))
    rounds: list[DataFrame] = []
    for _ in range(MAX_ROUNDS):
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        state = land(
            state.join(onward, "root", "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        release(*rounds)
        rounds = [state]
        if state.where("moved").isEmpty():
            return state.select("word", "root")
    raise RuntimeError("forms lead in a circle")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, form_ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    vocabulary = land(word_counts(docs, min_length).where(F.col("n") >= min_count), "spelling-words")
    known = vocabulary.join(near_words(vocabulary), "word", "left")
    has_form = F.col("near_n") >= form_ratio * F.col("n")
    named = land(
        known.select(
            "word",
            F.when(has_form, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(named.where("form is not null").select("word", "form"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
