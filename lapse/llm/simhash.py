"""SimHash near-duplicates through a byte-position inverted index.

Fingerprints of 64 bits that differ in at most four bits share at least four
of their eight bytes at the same position. The index therefore lists every
distinct fingerprint under combinations of positional bytes chosen so that
any four shared positions contain an indexed combination. In a posting list
the shared positional bytes of each pair are counted, pairs reaching the
guaranteed minimum are kept, and their bit distance is verified. Only
spanning links of a posting list leave its task, never all its pairs.

Posting lists longer than ``cap`` go another exact way: two fingerprints lie
within the distance exactly if some value lies within half of it of both, so
each such fingerprint is listed under all values near it and linked with the
smallest one listed there; that is linear in the number of fingerprints.

Groups of equal fingerprints (copies) are reduced to one row first.

Defined cases: a null text counts as an empty one; texts without words have
fingerprint zero and are linked like any others; repeated rows share a group;
null ids are passed over when the smallest id is taken (null if there is no
other); an empty table gives an empty result; other columns are ignored by
``near_duplicates`` and returned unchanged by ``keep_first``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import LOWER
from lapse.llm.components import components
from lapse.llm.runs import run_edges, whole_runs
from lapse.operators.materialize import land

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Posting lists up to this length are compared pair by pair inside a task.
LIST_CAP = 1024
# Beyond this many fingerprints the index uses four bytes a key, not three.
THREE_BYTE_LIMIT = 1 << 28
PIECE = 1 << 20
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def _word_lists(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The text's words in bounded lists, each beginning with the last
    ``overlap`` words of the one before."""
    words: list[bytes] = []
    at = 0
    while at < len(text):
        stop = at + PIECE
        if stop < len(text):
            gap = re.compile(rb"[\x20\x09-\x0D]").search(text, stop)
            stop = gap.start() if gap else len(text)
        new = WORDS.findall(text, at, stop)
        at = stop
        if new:
            words = words[-overlap:] + new if overlap else new
            yield words


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """SimHash over the lower-cased (A-Z) text's word shingles."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    digest = xxhash.xxh64_intdigest
    words: list[bytes] = []
    for words in _word_lists((text or "").encode("utf-8", "replace").translate(LOWER), width - 1):
        if len(words) < width:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())]
        n += len(hashes)
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if not n and words:
        return digest(b" ".join(words), SEED)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width) for t in batch.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def index_positions(key_bytes: int) -> list[tuple[int, ...]]:
    """Combinations of byte positions such that any four positions hold one."""
    if key_bytes == 4:
        return list(combinations(range(8), 4))
    # Turan's system: parts of 3, 3 and 2; triples inside a part, or two of a
    # part and one of the next.
    part = [0, 0, 0, 1, 1, 1, 2, 2]

    def chosen(c: tuple[int, ...]) -> bool:
        n = [sum(part[i] == p for i in c) for p in range(3)]
        return 3 in n or any(n[p] == 2 and n[(p + 1) % 3] == 1 for p in range(3))

    return [c for c in combinations(range(8), 3) if chosen(c)]


def _keys(fp: Column, key_bytes: int) -> Column:
    byte = [F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255)) for i in range(8)]
    out = []
    for n, positions in enumerate(index_positions(key_bytes)):
        key = F.lit(n).cast("long")
        for p in positions:
            key = F.shiftleft(key, 8).bitwiseOR(byte[p])
        out.append(key)
    return F.explode(F.array(*out))


def _spanning(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each value to the smallest one it is connected with."""
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def list_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among fingerprints with equal keys (sorted by key)."""
    edges = run_edges(keys)
    length = np.repeat(np.diff(edges), np.diff(edges))
    rest = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(keys)) - 1  # list members after this one
    bits = fps.view(np.uint64)
    left, right = [], []
    active = np.flatnonzero(length > 1)
    step = 1
    while True:
        active = active[rest[active] >= step]
        if not len(active):
            break
        differ = bits[active] ^ bits[active + step]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        kept = np.flatnonzero(shared >= 8 - max_bits)
        kept = kept[np.bitwise_count(differ[kept]) <= max_bits]
        left.append(active[kept])
        right.append(active[kept] + step)
        step += 1
    if not left:
        return fps[:0], fps[:0]
    return _spanning(fps, np.concatenate(left), np.concatenate(right))


def _list_links(keyed: DataFrame, max_bits: int, cap: int) -> DataFrame:
    """Links (a, b) from the posting lists; rows of long lists as (fp, null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps, long in whole_runs(batches, "key", "fp", cap):
            hot = np.unique(fps[long])
            a, b = list_links(keys[~long], fps[~long], max_bits)
            if len(a) or len(hot):
                ends = pa.concat_arrays([pa.array(b), pa.nulls(len(hot), pa.int64())])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, hot])), ends], ["a", "b"])

    dealt = keyed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long")


def near_values(max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of up to half of ``max_bits`` bits (rounded up), and which of
    them have at most half rounded down."""
    masks, near = [], []
    for n in range((max_bits + 1) // 2 + 1):
        for c in combinations(range(64), n):
            masks.append(sum(1 << i for i in c))
            near.append(n <= max_bits // 2)
    return np.array(masks, dtype=np.uint64), np.array(near)


def long_list_links(hot: DataFrame, max_bits: int) -> DataFrame:
    """Exact links among the fingerprints ``fp`` of long posting lists."""
    masks, near = near_values(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 64):
                part = fps[at : at + 64]
                middle = (part.view(np.uint64)[:, None] ^ masks).view(np.int64).ravel()
                flags = np.broadcast_to(near, (len(part), len(masks))).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(middle), pa.array(flags), pa.array(np.repeat(part, len(masks)))], ["middle", "near", "fp"])

    listed = hot.select("fp").mapInArrow(run, "middle long, near boolean, fp long")
    lowest = listed.groupBy("middle").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("low"), F.count("*").alias("n"))
    return listed.join(lowest.where("n > 1"), "middle").where("fp != low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, cap: int = LIST_CAP, key_bytes: int | None = None) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct
    fingerprints ``fp`` within ``max_bits`` bits."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the byte index covers distances of 0 to 4 bits")
    key_bytes = key_bytes or (3 if fps.count() <= THREE_BYTE_LIMIT else 4)
    keyed = fps.select(_keys(F.col("fp"), key_bytes).alias("key"), "fp")
    found = land(_list_links(keyed, max_bits, cap), "simhash-links")
    links = found.where("b is not null").distinct()
    hot = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    if hot.limit(1).count():
        # A long list's fingerprints also meet those of short lists there.
        links = links.union(long_list_links(hot, max_bits))
    return links


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, cap: int = LIST_CAP) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) for every row of ``docs``."""
    rows = land(fingerprints(docs, width), "simhash-rows")
    fps = land(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(link_fingerprints(fps.select("fp"), max_bits, cap))
    named = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = land(named.join(ids, "root").select("fp", "component_id", "root"), "simhash-components")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def keep_first(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest
    id, then text hash, then hash of the whole row; rows repeated as a whole
    stay once."""
    groups = near_duplicates(docs, width, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash")
    first = groups.groupBy("root").agg(F.min(order).alias("first"))
    first = first.select(F.col("first.doc_id").alias("__kept_id"), F.col("first.text_hash").alias("__kept_hash"))
    row, keys = F.xxhash64(*[docs[c] for c in docs.columns]), ["__kept_id", "__kept_hash"]
    repeated = bool(groups.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count())
    if repeated:
        # Rows with equal id and text: narrow rows tell which one stays.
        rows = docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(docs["text"]).alias("hash"), row.alias("row"))
        least = rows.groupBy("id", "hash").agg(F.min("row").alias("__kept_row"))
        first = first.join(least, F.col("__kept_id").eqNullSafe(F.col("id")) & (F.col("__kept_hash") == F.col("hash"))).drop("id", "hash")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__kept_id")) & (F.xxhash64(docs["text"]) == F.col("__kept_hash"))
    kept = docs.join(first, same & (row == F.col("__kept_row")) if repeated else same)
    if repeated:
        # What is left of them is equal; copies are combined before the shuffle.
        kept = kept.dropDuplicates(keys)
    return kept.select(*[docs[c] for c in docs.columns])
