"""Phrase collocations by prefix-free parsing.

Texts are cut into pieces at punctuation and pieces into words. A piece is
parsed into chunks: a chunk begins with the piece and at every trigger word
(its hash is 0 modulo ``TRIGGER``) and runs on over the first ``max_words - 1``
words of the next chunk. Distinct chunks with their frequencies are the
dictionary of the parse. n-grams are counted inside dictionary chunks only,
weighted by the chunk's frequency; an n-gram belongs to the chunk in whose own
words it starts, so those in the overlap count once.

A phrase is scored by its weakest cut: a * a / (l * r) for its count a and the
counts l and r of the two parts.

Scale: chunks, then phrases, are summed in the tasks before they are dealt
out, so a passage or a word pair in a third of all documents sends a few rows
per task. Counts go level by level: a phrase is counted only where the phrases
one word shorter in it are frequent enough by a bit table of at most 16 MB, which
is exact (bits that coincide only let more phrases through to the count). The
best of a language are cut by a window whose limit works in the tasks first.

Defined cases: a null text is empty; a null language is ``und``; repeated rows
count each; ids are not read; ties go by count, then by phrase; texts of any
length are parsed in blocks of about a megabyte (a chunk ends there); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import LOWER
from lapse.llm.words import PIECE, grouped, spans, window_hashes, word_hashes
from lapse.operators.materialize import land, release

MAX_WORDS, MIN_COUNT, TOP = 3, 10, 2000
COVERED_SHARE = 50  # percent of a phrase's places that lie in one longer phrase
SCORE_UNIT = 1_000_000
TRIGGER = 8
UNKNOWN = "und"
HELD_ROWS = 400_000
HELD_BYTES = 64 << 20
MAX_BITS = 1 << 27

# The bytes that end a piece, and those between words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
# A-Z to a-z, ends to a line feed, blanks to a space.
TABLE = bytes(10 if b in ENDS else 32 if b in BLANKS else LOWER[b] for b in range(256))
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[10, 32]] = True


def normalised(text: bytes) -> bytes:
    """The text in lower case, words of a piece one space apart, pieces ended
    by line feeds."""
    raw = np.frombuffer(text.translate(TABLE), dtype=np.uint8)
    blank = raw == 32
    blank[1:] &= blank[:-1].copy()
    blank[:1] = False
    return raw[~blank].tobytes()


def blocks(raw: bytes, size: int = PIECE, ahead: int = MAX_WORDS - 1) -> Iterator[tuple[bytes, int]]:
    """(bytes, own): parts of a normalised text of about ``size`` bytes, cut
    between words, each with the next ``ahead`` words of an unfinished piece;
    words that start before ``own`` are the part's own."""
    at = 0
    while at < len(raw):
        stop = _word_end(raw, min(len(raw), at + size))
        end = stop
        for _ in range(ahead):
            if end < len(raw) and raw[end] == 32:
                end = _word_end(raw, end + 1)
        yield raw[at:end], stop - at
        at = stop


def _word_end(raw: bytes, at: int) -> int:
    """The first separator from ``at`` on, or the end."""
    found = [x for x in (raw.find(b" ", at), raw.find(b"\n", at)) if x >= 0]
    return min(found, default=len(raw))


def chunk_places(raw: bytes, own: int, max_words: int = MAX_WORDS, trigger: int = TRIGGER) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Where chunks start and end, the number of overlapping words at each
    one's end, and the number of own words."""
    array = np.frombuffer(raw, dtype=np.uint8)
    start, end = spans(array, SEPARATORS)
    n_own = int(np.searchsorted(start, own))
    if not n_own:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, 0
    piece = np.searchsorted(np.flatnonzero(array == 10), start)
    begins = word_hashes(raw, SEPARATORS)[:n_own] % np.uint64(trigger) == 0
    begins[0] = True
    begins[1:] |= piece[1:n_own] != piece[: n_own - 1]
    first = np.flatnonzero(begins)
    after = np.append(first[1:], n_own)
    stop = np.minimum(after + max_words - 1, np.searchsorted(piece, piece[first], "right"))
    return start[first], end[stop - 1], stop - after, n_own


def chunks(raw: bytes, own: int, max_words: int = MAX_WORDS, trigger: int = TRIGGER) -> tuple[list[bytes], list[int], int]:
    """Chunks, the number of overlapping words at each one's end, and the
    number of own words."""
    start, end, tails, n_own = chunk_places(raw, own, max_words, trigger)
    order, slices = cut(raw, start, end, max_words)
    back = np.argsort(order)
    return slices.take(pa.array(back)).to_pylist(), tails.tolist(), n_own


def cut(raw: bytes, start: np.ndarray, end: np.ndarray, apart: int) -> tuple[np.ndarray, pa.Array]:
    """The slices of ``raw`` from each start to its end as a column, and the
    slice in each of its rows. A slice may run into the next ones, but ends
    before the one ``apart`` places on: every ``apart``-th ones are the values
    of a column whose memory is ``raw``, with the gaps between them."""
    data, rows, parts = pa.py_buffer(raw), [], []
    for p in range(min(apart, len(start))):
        s = start[p::apart]
        at = np.empty(2 * len(s), dtype=np.int32)
        at[::2], at[1::2] = s, end[p::apart]
        column = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), data])
        parts.append(column.take(pa.array(np.arange(0, len(at), 2))))
        rows.append(np.arange(p, len(start), apart))
    return np.concatenate(rows or [np.zeros(0, dtype=np.int64)]), pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


class Sums:
    """Counts of keys (``names``; the first column is the language's code)
    summed in a task. They are columns all along: no row becomes a Python
    object."""

    def __init__(self, names: list[str]):
        self.names, self.codes, self.parts = names, {}, []
        self.rows = self.bytes = 0  # since the last sum

    def code(self, lang: str) -> int:
        return self.codes.setdefault(lang, len(self.codes))

    def add(self, codes: np.ndarray, *columns) -> None:
        part = pa.table([pa.array(codes, pa.int32()), *columns], names=["lang", *self.names, "n"])
        self.parts.append(part)
        self.rows += part.num_rows
        self.bytes += part.nbytes

    def _summed(self) -> pa.Table:
        table = pa.concat_tables(self.parts).group_by(["lang", *self.names], use_threads=False).aggregate([("n", "sum")])
        self.rows = self.bytes = 0
        return table.rename_columns({"n_sum": "n"}).select(["lang", *self.names, "n"])

    def _batches(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        langs = pa.array(list(self.codes), pa.string())
        for batch in table.to_batches():
            yield pa.RecordBatch.from_arrays([langs.take(batch.column(0)), *batch.columns[1:]], names=batch.schema.names)

    def full(self) -> Iterator[pa.RecordBatch]:
        """The sums, if they have become many; else they are held on."""
        if self.rows > HELD_ROWS or self.bytes > HELD_BYTES:
            table = self._summed()
            many = table.num_rows > HELD_ROWS or table.nbytes > HELD_BYTES
            self.parts = [] if many else [table]
            yield from self._batches(table) if many else ()

    def rest(self) -> Iterator[pa.RecordBatch]:
        """All rows (lang, *names, n); a key may have several in a task."""
        yield from self._batches(self._summed()) if self.parts else ()
        self.parts = []


def parse(docs: DataFrame, max_words: int = MAX_WORDS, trigger: int = TRIGGER) -> DataFrame:
    """The dictionary: lang, chunk, tail (overlapping words at its end), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sums(["chunk", "tail"])
        for batch in batches:
            texts: dict[str, list] = defaultdict(list)
            for i, lang in enumerate(batch.column(0).to_pylist()):
                texts[lang].append(batch.column(1)[i])
            for lang, cells in texts.items():
                for some in grouped(c.as_py() or b"" for c in cells):
                    for raw, own in blocks(normalised(b"\n".join(some)), ahead=max_words - 1):
                        start, end, tails, _ = chunk_places(raw, own, max_words, trigger)
                        order, slices = cut(raw, start, end, max_words)
                        one = np.ones(len(order), dtype=np.int64)
                        held.add(one * held.code(lang), slices, pa.array(tails[order], pa.int32()), pa.array(one))
                        yield from held.full()
        yield from held.rest()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary"))
    found = rows.mapInArrow(run, "lang string, chunk binary, tail int, n long")
    return found.groupBy("lang", "chunk", "tail").agg(F.sum("n").alias("n"))


def lines_of(column: pa.Array, size: int = PIECE) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """The values (bytes) of a column in parts of about ``size`` bytes: which
    rows, their bytes with a line feed after each value, and each one's end.
    Cut from the column's own memory; no row becomes a Python object."""
    lines = pc.binary_join_element_wise(column.cast(pa.large_binary()), *(pa.scalar(x, pa.large_binary()) for x in (b"", b"\n")))
    if not len(lines):
        return
    at = np.frombuffer(lines.buffers()[1], dtype=np.int64)[lines.offset : lines.offset + len(lines) + 1]
    raw = np.frombuffer(lines.buffers()[2], dtype=np.uint8)
    first = 0
    while first < len(lines):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield slice(first, last), raw[at[first] : at[last]], at[first + 1 : last + 1] - at[first]
        first = last


class Words:
    """The words of many chunks, each with a line feed after it: places,
    hashes, chunk of each. ``ends``: where the chunks end."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray, tails: np.ndarray | int):
        self.raw = raw.tobytes()
        self.start, self.end = spans(raw, SEPARATORS)
        self.chunk = np.searchsorted(ends, self.start, "right")
        last = np.searchsorted(self.chunk, np.arange(len(ends)), "right")
        self.own = np.arange(len(self.start)) < (last - tails)[self.chunk]

    def joined(self, size: int) -> np.ndarray:
        """Whether ``size`` words from each one lie in one chunk."""
        out = np.zeros(len(self.chunk), dtype=bool)
        out[: len(out) - size + 1] = self.chunk[: len(out) - size + 1] == self.chunk[size - 1 :]
        return out

    def hashes(self, size: int) -> np.ndarray:
        """A hash of the ``size`` words from each one that has as many after it."""
        words = word_hashes(self.raw, SEPARATORS)
        return window_hashes(words, np.arange(max(0, len(words) - size + 1)), size)

    def phrases(self, size: int, which: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """The ``size`` words from each of those marked, as a column, and the
        word each of its rows starts at."""
        at = np.flatnonzero(which)
        order, found = cut(self.raw, self.start[at], self.end[at + size - 1], size)
        return at[order], found


def _phrases(dictionary: DataFrame, size: int, table=None) -> DataFrame:
    """(lang, phrase, n) of all phrases of ``size`` words; beside single words
    the empty phrase holds their number. With ``table`` (a broadcast bit table)
    only those in which both phrases of one word less have their bit."""

    def count_in(held: Sums, words: Words, codes: np.ndarray, n: np.ndarray) -> None:
        which = words.own & words.joined(size)
        if size == 1:
            total = np.zeros(codes.max() + 1, dtype=np.int64)
            np.add.at(total, codes, n * np.bincount(words.chunk[words.own], minlength=len(n)))
            held.add(np.arange(len(total)), pa.array([b""] * len(total), pa.binary()), pa.array(total))
        if table is not None:
            bits = np.frombuffer(table.value, dtype=np.uint8)
            slot = words.hashes(size - 1) & np.uint64(8 * len(bits) - 1)
            frequent = bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 == 1
            both = np.zeros(len(which), dtype=bool)
            both[: max(0, len(frequent) - 1)] = frequent[:-1] & frequent[1:]
            which &= both
        at, found = words.phrases(size, which)
        chunk = words.chunk[at]
        held.add(codes[chunk], found, pa.array(n[chunk]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sums(["phrase"])
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            codes = np.array([held.code(x) for x in langs.dictionary.to_pylist()])[langs.indices.to_numpy()]
            tails, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            for rows, raw, ends in lines_of(batch.column(1)):
                count_in(held, Words(raw, ends, tails[rows]), codes[rows], n[rows])
                yield from held.full()
        yield from held.rest()

    found = dictionary.select("lang", "chunk", "tail", "n").mapInArrow(run, "lang string, phrase binary, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def bit_table(frequent: DataFrame, size: int, max_bits: int | None = None) -> bytes:
    """Bits at the hashes of frequent phrases of ``size`` words: 16 a phrase,
    at most ``max_bits`` (``MAX_BITS``) in all."""
    n_bits = max(1 << 10, min(max_bits or MAX_BITS, 1 << (16 * frequent.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, raw, ends in lines_of(batch.column(0)):
                words = Words(raw, ends, 0)
                hashes = words.hashes(size)
                slot = (hashes[words.joined(size)[: len(hashes)]] & np.uint64(n_bits - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slot // 64), pa.array(slot % 64)], ["word", "bit"])

    words = frequent.select("phrase").mapInArrow(run, "word long, bit long")
    words = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, cast(bit as int)))").alias("bits")).toArrow()
    table = np.zeros(n_bits // 64, dtype="<i8")
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.tobytes()


def counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, n) of all phrases of 1 to ``max_words`` words that occur
    ``min_count`` times, landed; the empty phrase holds the number of words."""
    dictionary = land(parse(docs, max_words), "phrase-dictionary")
    enough, table, levels = (F.col("n") >= min_count) | (F.length("phrase") == 0), None, []
    for size in range(1, max_words + 1):
        levels.append(land(_phrases(dictionary, size, table).where(enough), "phrase-counts"))
        if size < max_words:
            table = docs.sparkSession.sparkContext.broadcast(bit_table(levels[-1].where(F.length("phrase") > 0), size))
    release(dictionary)
    return reduce(DataFrame.unionByName, levels)


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, covered_share: int = COVERED_SHARE
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, its count a, the
    counts l and r of its weakest cut, the language's words n, and the score."""
    every = counts(docs, max_words, min_count).select("lang", F.col("phrase").cast("string").alias("phrase"), "n")
    totals = every.where("phrase = ''").select("lang", F.col("n").alias("total"))
    words = F.split("phrase", " ")
    known = every.where("phrase != ''")
    found = land(known.where(F.size(words) > 1).select("lang", "phrase", F.col("n").alias("a"), words.alias("words")), "phrase-found")
    inner = found.where(F.size("words") > 2).withColumn("m", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("m")), " ").alias("phrase"), "a")
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = found.join(longest, ["lang", "phrase"], "left")
    left = left.where(F.coalesce(100 * F.col("longer") < covered_share * F.col("a"), F.lit(True)))
    cut = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cut = cut.withColumn("head", F.array_join(F.slice("words", F.lit(1), F.col("k")), " "))
    cut = cut.withColumn("rest", F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " "))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumns({c: wide(c) for c in ("a", "l", "r")})
    score = F.expr(f"((a * a) * cast({SCORE_UNIT} as decimal(7,0))) div (l * r)").cast("long")
    weakest = cut.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    flat = weakest.select("lang", "phrase", *[F.col(f"cut.{c}").cast("long").alias(c) for c in ("score", "a", "l", "r")])
    best = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
