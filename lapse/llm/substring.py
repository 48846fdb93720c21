"""Removal of repeated word passages, found through difference-cover anchors.

A passage of ``width`` words occurring twice shares an aligned anchor: with
the positions of a difference cover modulo ``period`` as anchors, any two
occurrences have anchors at the same offset, at most ``period - 1`` words in.
So only windows of ``width - period + 1`` words at cover positions are hashed
and dealt out; what they have in common is then extended: every full window
around a repeated anchor is hashed (128 bits) and dealt out once more, and
windows occurring twice have their words removed.

Scale: rows of a hash meet in one task as a sorted stream of which only the
open run is held. Before the shuffle every task reduces a hash it has several
times to one witness, so a passage shared by a third of all documents sends
one row per batch. The text moves twice: to its repeated anchors, and (only
where it has such) to its repeated windows.

``digests`` removes every occurrence of a repeated window; ``keep_one`` is for
corpora and leaves the first one in (by document id, then place): the words of
a window's first occurrence stay, and other occurrences go.

Defined cases: a null text has no words and stays null; texts shorter than
the window stay; repeated rows are repeated passages of each other (for
``keep_one``, rows equal in id and text are one document); null ids come last;
texts may have any length; documents without removals keep their text as it
was; an empty table gives an empty result; other columns come back unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.llm.runs import column, run_edges
from lapse.llm.words import WORD_BASE, mix, window_hashes, word_hashes
from lapse.operators.materialize import land

WIDTH = 35
# A perfect difference cover, every residue modulo 21 being a
# difference of two of the five.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
SECOND_BASE = 0xD6E8FEB86659FD93
REPEATED, DEALT = 1, 2  # flags: already seen twice; takes part by its hash
LAST_ID = (1 << 63) - 1
HELD_ROWS = 4096
PART_ROWS = 1 << 19


def anchor_starts(n_words: int, width: int) -> np.ndarray:
    """Cover positions of a document at which a whole anchor fits."""
    if n_words < width:
        return np.zeros(0, dtype=np.int64)
    starts = np.arange(n_words - (width - PERIOD + 1) + 1)
    return starts[np.isin(starts % PERIOD, COVER)]


def window_starts(anchors: np.ndarray, n_words: int, width: int) -> np.ndarray:
    """Starts of the full windows that hold one of the anchors."""
    edge = np.zeros(n_words + 2, dtype=np.int64)
    lo = np.maximum(0, anchors - (PERIOD - 1))
    hi = np.minimum(anchors, n_words - width)
    fits = hi >= lo
    np.add.at(edge, lo[fits], 1)
    np.add.at(edge, hi[fits] + 1, -1)
    return np.flatnonzero(np.cumsum(edge)[: max(0, n_words - width + 1)] > 0)


def _deal(hashes: np.ndarray, second: np.ndarray, key: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Rows (slot, second, key, place): one witness of each hash goes by the
    hash, its further occurrences in this batch are settled and go anywhere."""
    order = np.lexsort((second, hashes))
    hashes, second, key, at = hashes[order], second[order], key[order], at[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (second[1:] != second[:-1])
    runs = np.flatnonzero(first)
    length = np.diff(np.append(runs, len(hashes)))
    flags = np.where(np.repeat(length > 1, length), REPEATED, 0) + np.where(first, DEALT, 0)
    slot = np.where(first, hashes, mix(key.view(np.uint64) + at.astype(np.uint64)))
    return [slot.view(np.int64), second.view(np.int64), key, at.astype(np.int64) * 4 + flags]


def _dealt(found: Iterator[tuple]) -> Iterator[list[np.ndarray]]:
    """``_deal`` over the documents' hashes, in parts of bounded size."""
    parts, n = [], 0
    for part in found:
        parts.append(part)
        n += len(part[0])
        if n >= PART_ROWS:
            yield _deal(*[np.concatenate(x) for x in zip(*parts)])
            parts, n = [], 0
    if n:
        yield _deal(*[np.concatenate(x) for x in zip(*parts)])


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(row, places): the places whose hash occurs at least twice."""

    def settle(values: list[np.ndarray], open_key: tuple | None) -> tuple[np.ndarray, tuple | None]:
        changed = np.ones(len(values[0]), dtype=bool)
        changed[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values[:-2]])
        runs = np.flatnonzero(changed)
        dealt = (values[-1] & DEALT) > 0
        known = (values[-1] & REPEATED) > 0
        n = np.add.reduceat(dealt.astype(np.int64), runs)
        seen = (n > 1) | (np.add.reduceat((dealt & known).astype(np.int64), runs) > 0)
        if open_key is not None and tuple(v[0] for v in values[:-2]) == open_key:
            seen[0] |= n[0] > 0
        last = tuple(v[-1] for v in values[:-2]) if seen[-1] else None
        return known | (dealt & np.repeat(seen, np.diff(np.append(runs, len(changed))))), last

    def kept(values: list[np.ndarray], which: np.ndarray) -> pa.RecordBatch:
        row, place = values[-2][which], (values[-1][which] >> 2).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(row), pa.array(place)], ["row", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        open_key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [column(batch, c) for c in (*keys, "row", "place")]
            if held is not None:
                values = [np.concatenate([h, v]) for h, v in zip(held, values)]
            changed = np.logical_or.reduce([v[1:] != v[:-1] for v in values[:-2]])
            cut = int(np.flatnonzero(changed)[-1]) + 1 if changed.any() else 0
            # Hold the last run only while it may still be a single occurrence.
            if len(values[0]) - cut > HELD_ROWS:
                cut = len(values[0])
            held = [v[cut:] for v in values]
            if cut:
                which, open_key = settle([v[:cut] for v in values], open_key)
                yield kept([v[:cut] for v in values], which)
        if held is not None and len(held[0]):
            yield kept(held, settle(held, open_key)[0])

    dealt = rows.repartition(keys[0]).sortWithinPartitions(*keys)
    found = dealt.select(*keys, "row", "place").mapInArrow(run, "row long, place int")
    return found.groupBy("row").agg(F.collect_list("place").alias("places"))


def _anchor_rows(docs: DataFrame, width: int) -> DataFrame:
    """(slot, row, place) of all anchors; ``row`` is a hash of id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = column(batch, "row")

            def found(batch=batch, keys=keys):
                for i, text in enumerate(batch.column("raw")):
                    words = word_hashes(text.as_py() or b"")
                    starts = anchor_starts(len(words), width)
                    hashes = window_hashes(words, starts, width - PERIOD + 1)
                    yield hashes, np.zeros(len(hashes), dtype=np.uint64), np.full(len(starts), keys[i]), starts

            for slot, _, row, place in _dealt(found()):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (slot, row, place)], ["slot", "row", "place"])

    raw = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.col("text").cast("binary").alias("raw"))
    return raw.mapInArrow(run, "slot long, row long, place long")


def _window_rows(touched: DataFrame, width: int) -> DataFrame:
    """(slot, second, row, place) of all full windows around repeated anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = column(batch, "row")

            def found(batch=batch, keys=keys):
                for i, (text, places) in enumerate(zip(batch.column("raw"), batch.column("places"))):
                    words = word_hashes(text.as_py() or b"")
                    starts = window_starts(np.unique(places.values.to_numpy()), len(words), width)
                    hashes = [window_hashes(words, starts, width, base) for base in (WORD_BASE, SECOND_BASE)]
                    yield *hashes, np.full(len(starts), keys[i]), starts

            for dealt in _dealt(found()):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in dealt], ["slot", "second", "row", "place"])

    return touched.mapInArrow(run, "slot long, second long, row long, place long")


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with ``__starts``: starts of their repeated windows, null
    where they have no repeated anchor."""
    if width < PERIOD + 1:
        raise ValueError(f"a window needs more than {PERIOD} words")
    anchors = _repeated(_anchor_rows(docs, width), ["slot"])
    anchors = land(anchors.select(F.col("row").alias("__key"), F.col("places").alias("__anchors")), "substring-anchors")
    key = F.xxhash64(docs["doc_id"], docs["text"])
    touched = docs.join(anchors, key == F.col("__key")).drop("__key").withColumn("__row", F.monotonically_increasing_id())
    touched = land(touched, "substring-touched")
    raw = touched.select(F.col("__row").alias("row"), F.col("text").cast("binary").alias("raw"), F.col("__anchors").alias("places"))
    windows = _repeated(_window_rows(raw, width), ["slot", "second"])
    windows = land(windows.select(F.col("row").alias("__at"), F.col("places").alias("__starts")), "substring-windows")
    found = touched.drop("__anchors").join(windows, F.col("__row") == F.col("__at"), "left").drop("__at", "__row")
    clean = docs.join(anchors.select("__key"), key == F.col("__key"), "left_anti")
    return found.unionByName(clean.withColumn("__starts", F.lit(None).cast("array<int>")))


def _ordered_windows(touched: DataFrame, width: int) -> DataFrame:
    """As ``_window_rows``, with the document id: the witness of a window is
    the first of its occurrences in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = column(batch, "id"), column(batch, "row")
            order, parts, n = np.lexsort((keys, ids)), [], 0
            for i in order.tolist():
                words = word_hashes(batch.column("raw")[i].as_py() or b"")
                starts = window_starts(np.unique(batch.column("places")[i].values.to_numpy()), len(words), width)
                hashes = [window_hashes(words, starts, width, base) for base in (WORD_BASE, SECOND_BASE)]
                parts.append((*hashes, np.full(len(starts), ids[i]), np.full(len(starts), keys[i]), starts))
                n += len(starts)
                if n >= PART_ROWS:
                    yield dealt(parts)
                    parts, n = [], 0
            if n:
                yield dealt(parts)

    def dealt(parts: list[tuple]) -> pa.RecordBatch:
        first, second, ids, keys, at = (np.concatenate(x) for x in zip(*parts))
        found = _deal(first, second, np.arange(len(first)), at)
        number = found[2]
        columns = [found[0], found[1], ids[number], keys[number], found[3]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["slot", "second", "id", "row", "place"])

    return touched.mapInArrow(run, "slot long, second long, id long, row long, place long")


def _later(rows: DataFrame) -> DataFrame:
    """(row, later, firsts): of windows that occur twice, the places of all
    occurrences but the first, and of the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, waiting = None, None  # the last run, and its first place while it is single
        for batch in batches:
            if not batch.num_rows:
                continue
            slot, second, row, place = (column(batch, c) for c in ("slot", "second", "row", "place"))
            dealt, known = (place & DEALT) > 0, (place & REPEATED) > 0
            at = np.flatnonzero(dealt)
            key = np.stack([slot[at], second[at]], axis=1)
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = (key[1:] != key[:-1]).any(axis=1)
            if len(at):
                fresh[0] = open_key is None or tuple(key[0]) != open_key
            # The first of a run is one if another follows or its batch had more.
            follows = np.append(~fresh[1:], False) if len(at) else fresh
            first, later = at[fresh & (follows | known[at])], np.append(np.flatnonzero(~dealt), at[~fresh])
            if waiting is not None and len(at):
                if not fresh[0]:
                    yield marked(np.array([waiting[0]]), np.array([waiting[1]]), True)
                waiting = None
            yield marked(row[first], place[first], True)
            yield marked(row[later], place[later], False)
            if len(at):
                open_key = tuple(key[-1])
                if fresh[-1] and not known[at[-1]]:
                    waiting = (row[at[-1]], place[at[-1]])

    def marked(row: np.ndarray, place: np.ndarray, first: bool) -> pa.RecordBatch:
        columns = [pa.array(row), pa.array((place >> 2).astype(np.int32)), pa.array(np.full(len(row), first))]
        return pa.RecordBatch.from_arrays(columns, ["row", "place", "first"])

    dealt = rows.repartition("slot").sortWithinPartitions("slot", "second", "id", "row", "place")
    found = dealt.mapInArrow(run, "row long, place int, first boolean")
    lists = [F.collect_list(F.when(F.col("first") == which, F.col("place"))).alias(name) for name, which in (("later", False), ("firsts", True))]
    return found.groupBy("row").agg(*lists)


def kept_words(raw: bytes, starts: np.ndarray | None, width: int) -> tuple[int, list[bytes]]:
    """Number of words, and the words outside the windows."""
    words = raw.split()
    if starts is None or not len(starts):
        return len(words), words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.unique(starts)
    edge[at] += 1
    edge[at + width] -= 1
    kept = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
    return len(words), [words[i] for i in kept.tolist()]


def digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, shas = [], [], []
            for raw, starts in zip(batch.column("raw"), batch.column("starts")):
                n, kept = kept_words(raw.as_py() or b"", starts.values.to_numpy() if starts.is_valid else None, width)
                counts.append(n)
                removed.append(n - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas)],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    marked = repeated_windows(docs.select("doc_id", "text"), width)
    rows = marked.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("raw"), F.col("__starts").alias("starts"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, all columns, with repeated passages cut from ``text``
    (kept words joined by one space) and ``n_chars``, if there, renewed."""

    @F.pandas_udf(T.StringType())
    def cut(raw, starts):
        return raw.combine(starts, lambda r, s: b" ".join(kept_words(bytes(r), s, width)[1]).decode("utf-8", "replace"))

    marked = repeated_windows(docs, width)
    same, changed = marked.where("__starts is null"), marked.where("__starts is not null")
    text = cut(F.col("text").cast("binary"), F.col("__starts"))
    changed = changed.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return same.unionByName(changed).select(*docs.columns)


def covered(n_words: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which words lie in a window from one of the starts."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    at = np.unique(starts)
    edge[at] += 1
    edge[at + width] -= 1
    return np.cumsum(edge)[:-1] > 0


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, all columns, with passages cut from ``text`` that also
    stand earlier in the table (kept words joined by one space) and ``n_chars``,
    if there, renewed."""
    if width < PERIOD + 1:
        raise ValueError(f"a window needs more than {PERIOD} words")
    anchors = _repeated(_anchor_rows(docs, width), ["slot"])
    anchors = land(anchors.select(F.col("row").alias("__key"), F.col("places").alias("__anchors")), "substring-anchors")
    key = F.xxhash64(docs["doc_id"], docs["text"])
    raw, order = F.col("text").cast("binary").alias("raw"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id")
    touched = docs.join(anchors, key == F.col("__key")).select(order, F.col("__key").alias("row"), raw, F.col("__anchors").alias("places"))
    # Rows equal in id and text meet in one task, one of them stands for all.
    touched = touched.groupBy("id", "row").agg(F.any_value("raw").alias("raw"), F.any_value("places").alias("places"))
    found = land(_later(_ordered_windows(touched, width)).where(F.size("later") > 0), "substring-later")
    found = found.select(F.col("row").alias("__at"), F.col("later").alias("__later"), F.col("firsts").alias("__firsts"))

    @F.pandas_udf(T.StringType())
    def cut(raw, later, firsts):
        def left(text, gone, kept):
            words = bytes(text).split()
            stays = ~covered(len(words), gone, width) | covered(len(words), kept, width)
            return b" ".join([words[i] for i in np.flatnonzero(stays).tolist()]).decode("utf-8", "replace")

        return pd.Series([left(*cells) for cells in zip(raw, later, firsts)], dtype=object)

    changed = docs.join(found, key == F.col("__at"))
    changed = changed.withColumn("text", cut(F.col("text").cast("binary"), F.col("__later"), F.col("__firsts")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    same = docs.join(found.select("__at"), key == F.col("__at"), "left_anti")
    return same.select(*docs.columns).unionByName(changed.select(*docs.columns))
