"""Removal of repeated byte passages by deep-shallow suffix sorting.

A byte is removed from a document if a string of ``width`` bytes that covers it
also starts in a document with a smaller id. Only suffixes that can be such are
sorted: every window of ``width`` bytes is named by the smallest hash of the
``ANCHOR``-byte strings in it, neighbouring windows of one name form a context,
and contexts whose name occurs only once are out. Equal windows have equal
names, so the suffixes of a name are sorted together: a multikey quicksort on
eight bytes at a time orders them to a shallow depth, and blind tries order the
groups that share more. Neighbours with a common prefix of ``width`` bytes are
one string, and the smallest document that holds it is known.

Scale: equal texts are folded into one before all else. Names go through one
shuffle of narrow rows, from which a task sends one witness of a name that it
holds several times; equal contexts are folded in the tasks too. A task sorts
the contexts of whole names. A name with very many different contexts (a short
common passage between different neighbours) is sorted in parts, whose distinct
windows are then merged by their 128-bit hash. Texts are read in blocks, so a
long one needs memory for itself and its marks only.

Defined cases: a null text is empty; a null id counts as larger than all
others; documents with equal ids are not smaller than one another, so copies
under one id both stay; texts shorter than the window stay; cutting may leave
parts of a UTF-8 character, so kept bytes are binary; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.runs import column, run_edges
from lapse.llm.words import BYTE_BASE, mix, powers
from lapse.operators.materialize import join_small, land, release

WIDTH, ANCHOR = 50, 24
SHALLOW = 32  # bytes that the multikey quicksort orders
CONTEXT = 32  # windows of one context at most
BLOCK = 1 << 18
PART_ROWS = 1 << 19
CHUNK_ROWS = 1 << 14
HELD_ROWS = 4096
HOT_CONTEXTS = 4096
LAST_ID = (1 << 63) - 1
CODEC = "zstd"  # of landed texts and contexts, which are long
REPEATED, DEALT = 1, 2  # flags of an anchor: seen twice already; a witness


# Deep-shallow sorting


def multikey_sort(raw: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``depth`` bytes (a multiple of 8)
    and the common prefix of each with the one before: a multikey quicksort
    whose characters are eight bytes, all groups of a level at once."""
    n = len(starts)
    order, common = np.arange(n), np.full(n, depth, dtype=np.int64)
    common[:1] = 0
    group = np.zeros(n, dtype=np.int64)
    for level in range(0, depth, 8):
        # Only suffixes equal to a neighbour so far take part.
        tied = np.zeros(n, dtype=bool)
        tied[1:] = group[1:] == group[:-1]
        tied[:-1] |= tied[1:].copy()
        active = np.flatnonzero(tied)
        if not len(active):
            break
        cells = raw[(starts[order[active]] + level)[:, None] + np.arange(8)]
        key = np.ascontiguousarray(cells).view(">u8").ravel().astype(np.uint64)
        sort = np.lexsort((key, group[active]))
        order[active], key = order[active][sort], key[sort]
        same = np.zeros(len(active), dtype=bool)
        same[1:] = group[active][1:] == group[active][:-1]
        split = same.copy()
        split[1:] &= key[1:] != key[:-1]
        split &= same
        differ = np.zeros(len(active), dtype=np.uint64)
        differ[1:] = key[1:] ^ key[:-1]
        equal = sum((differ < np.uint64(1 << bits)).astype(np.int64) for bits in (56, 48, 40, 32, 24, 16, 8))
        common[active[split]] = level + equal[split]
        fresh = np.zeros(n, dtype=bool)
        fresh[active[split]] = True
        fresh[1:] |= group[1:] != group[:-1]
        group = np.cumsum(fresh)
    return order, common


class Node:
    """An inner node of a blind trie: the byte it branches on, no more."""

    __slots__ = ("depth", "kids")

    def __init__(self, depth: int, kids: dict):
        self.depth, self.kids = depth, kids


def blind_trie_order(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of strings of equal length, and common prefixes as above. A
    string goes down the trie by branching bytes alone, meets some leaf, and
    one comparison with that leaf tells where it branches off."""
    width = len(strings[0])
    root: Node | list[int] = [0]
    for i in range(1, len(strings)):
        s, at = strings[i], root
        while type(at) is Node:
            at = at.kids.get(s[at.depth]) or next(iter(at.kids.values()))
        other = strings[at[0]]
        if s == other:
            at.append(i)
            continue
        differ = int.from_bytes(s, "big") ^ int.from_bytes(other, "big")
        depth = width - (differ.bit_length() + 7) // 8
        parent, at = None, root
        while type(at) is Node and at.depth < depth:
            parent, at = at, at.kids[s[at.depth]]
        if type(at) is Node and at.depth == depth:
            at.kids[s[depth]] = [i]
            continue
        new = Node(depth, {other[depth]: at, s[depth]: [i]})
        if parent is None:
            root = new
        else:
            parent.kids[s[parent.depth]] = new
    order, common, work = [], [], [(root, 0)]
    while work:
        at, shared = work.pop()
        if type(at) is Node:
            first, *others = sorted(at.kids)
            work += [(at.kids[b], at.depth) for b in reversed(others)]
            work.append((at.kids[first], shared))
        else:
            order += at
            common += [shared] + [width] * (len(at) - 1)
    return order, common


def deep_shallow(raw: bytes, starts: np.ndarray, width: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by their first ``width`` bytes (all
    must fit) and each one's common prefix with the one before."""
    array = np.frombuffer(raw, dtype=np.uint8)
    depth = min(shallow, width) // 8 * 8
    order, common = multikey_sort(array, starts, depth)
    # Groups that the shallow sort left tied.
    edges = np.flatnonzero(np.append(common < depth, True)) if depth else np.array([0, len(starts)])
    if len(edges) and edges[0]:
        edges = np.append(0, edges)
    sizes = np.diff(edges)
    for begin, size in zip(edges[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        members = order[begin : begin + size]
        deep, shared = blind_trie_order([raw[s : s + width] for s in starts[members].tolist()])
        order[begin : begin + size] = members[deep]
        common[begin + 1 : begin + size] = shared[1:]
    return order, common


# Anchors


def smallest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by doubling."""
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    more = width - size
    return np.minimum(out[: len(out) - more], out[more:]) if more else out


def context_starts(raw: np.ndarray, ends: np.ndarray, width: int, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first window, windows) of the contexts of segments that lie end
    to end in ``raw``."""
    none = np.zeros(0, dtype=np.int64)
    if len(raw) < width:
        return none.view(np.uint64), none, none
    up, down = powers(BYTE_BASE, len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    grams = mix((total[anchor:] - total[:-anchor]) * down[: len(raw) - anchor + 1])
    name = smallest_in_windows(grams, width - anchor + 1)
    # Windows that cross the end of a segment are none.
    inside = np.ones(len(name), dtype=bool)
    cross = np.zeros(len(raw) + 1, dtype=np.int32)
    np.add.at(cross, np.maximum(ends - width + 1, 0), 1)
    np.add.at(cross, ends, -1)
    inside = np.cumsum(cross)[: len(name)] == 0
    at = np.flatnonzero(inside)
    if not len(at):
        return none.view(np.uint64), none, none
    name = name[at]
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (name[1:] != name[:-1]) | (at[1:] != at[:-1] + 1)
    runs = np.flatnonzero(fresh)
    length = np.diff(np.append(runs, len(at)))
    # Long runs (periodic text) in parts of bounded size.
    parts = -(-length // CONTEXT)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(runs, parts) + nth * CONTEXT
    windows = np.minimum(CONTEXT, np.repeat(length, parts) - nth * CONTEXT)
    return name[first], at[first], windows


def _segments(texts: Iterator[tuple[int, bytes]], width: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (bytes, segment ends, numbers of their texts, places in those);
    a long text comes in several segments, which share width - 1 bytes."""
    held, size = [], 0
    for number, text in texts:
        for at in range(0, max(1, len(text) - width + 1), BLOCK):
            part = text[at : at + BLOCK + width - 1]
            held.append((part, number, at))
            size += len(part)
            if size >= BLOCK:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    parts, numbers, at = zip(*held)
    return b"".join(parts), np.cumsum([len(p) for p in parts]), np.array(numbers), np.array(at)


def _witnesses(parts: list[tuple]) -> list[np.ndarray]:
    """Anchors (name, salt, row, place with flags): one witness of each name
    goes by the name, its others in this part are settled and go by a salt."""
    name, row, place = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(name, kind="stable")
    name, row, place = name[order], row[order], place[order]
    edges = run_edges(name)
    length = np.diff(edges)
    first = np.zeros(len(name), dtype=bool)
    first[edges[:-1]] = True
    flags = np.where(np.repeat(length > 1, length), REPEATED, 0) + np.where(first, DEALT, 0)
    salt = np.where(first, 0, 1 + (place & 1023))
    return [name.view(np.int64), salt.astype(np.int32), row, place * 4 + flags]


def _anchor_rows(texts: DataFrame, width: int) -> DataFrame:
    """(name, salt, row, place) of all contexts; a place holds the first
    window, the number of windows and flags."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitted(parts):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _witnesses(parts)], ["name", "salt", "row", "place"])

        for batch in batches:
            rows, parts, n = column(batch, "row"), [], 0
            cells = ((i, cell.as_py()) for i, cell in enumerate(batch.column("raw")))
            for raw, ends, numbers, places in _segments(cells, width):
                name, first, windows = context_starts(np.frombuffer(raw, dtype=np.uint8), ends, width)
                segment = np.searchsorted(ends, first, "right")
                inside = first - np.append(0, ends)[segment]
                parts.append((name, rows[numbers[segment]], (places[segment] + inside) * CONTEXT + windows - 1))
                n += len(name)
                if n >= PART_ROWS:
                    yield emitted(parts)
                    parts, n = [], 0
            if n:
                yield emitted(parts)

    return texts.select("row", "raw").mapInArrow(run, "name long, salt int, row long, place long")


def _repeated(anchors: DataFrame) -> DataFrame:
    """(row, name, place) of anchors whose name occurs at least twice."""

    def settle(name, place, open_name):
        edges = run_edges(name)
        dealt = (place & DEALT) > 0
        known = (place & REPEATED) > 0
        n = np.add.reduceat(dealt.astype(np.int64), edges[:-1])
        seen = (n > 1) | (np.add.reduceat((dealt & known).astype(np.int64), edges[:-1]) > 0)
        if open_name is not None and name[0] == open_name:
            seen[0] = True
        return known | (dealt & np.repeat(seen, np.diff(edges))), name[-1] if seen[-1] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, open_name = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [column(batch, c) for c in ("name", "salt", "row", "place")]
            if held is not None:
                values = [np.concatenate(x) for x in zip(held, values)]
            cut = int(run_edges(values[0])[-2])
            # The last run is held only while it may still be a single one.
            cut = len(values[0]) if len(values[0]) - cut > HELD_ROWS else cut
            held = [v[cut:] for v in values]
            if cut:
                yield kept([v[:cut] for v in values], open_name)
                open_name = settle(values[0][:cut], values[3][:cut], open_name)[1]
        if held is not None and len(held[0]):
            yield kept(held, open_name)

    def kept(values, open_name):
        name, _, row, place = values
        which = settle(name, place, open_name)[0]
        return pa.RecordBatch.from_arrays([pa.array(x[which]) for x in (row, name, place >> 2)], ["row", "name", "place"])

    dealt = anchors.repartition("name", "salt").sortWithinPartitions("name")
    return dealt.mapInArrow(run, "row long, name long, place long")


def _contexts(touched: DataFrame, width: int) -> DataFrame:
    """(name, content, row, id, place, context): the repeated contexts of
    texts; of equal contexts in a batch, the bytes come with one only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            rows: list[tuple] = []
            for i, marks in enumerate(batch.column("marks")):
                raw = batch.column("raw")[i].as_py()
                row, first = (batch.column(c)[i].as_py() for c in ("row", "id"))
                cells = marks.values
                for name, place in zip(cells.field("name").to_pylist(), cells.field("place").to_pylist()):
                    at, more = divmod(place, CONTEXT)
                    context = raw[at : at + more + width]
                    content = xxhash.xxh64_intdigest(context) - (1 << 63)
                    known = (name, content) in seen
                    seen.add((name, content))
                    rows.append((name, content, row, first, at, None if known else context))
                if len(rows) >= CHUNK_ROWS:
                    yield emitted(rows)
            yield emitted(rows)

    def emitted(rows):
        kinds = [pa.int64()] * 5 + [pa.binary()]
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, ["name", "content", "row", "id", "place", "context"])

    schema = "name long, content long, row long, id long, place long, context binary"
    return touched.select("row", "id", "raw", "marks").mapInArrow(run, schema)


# Sorting the suffixes of whole names


def _chunks(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups of a sorted stream, of about ``CHUNK_ROWS``."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < CHUNK_ROWS:
            continue
        differ = np.zeros(held.num_rows, dtype=bool)
        for name in by:
            values = held.column(name).to_numpy()
            differ[1:] |= values[1:] != values[:-1]
        cut = int(np.flatnonzero(differ)[-1]) if differ.any() else 0
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


def sorted_windows(contexts: list[bytes], low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context, window, smallest id, first): every window of the contexts in
    suffix order, with the smallest ``low`` of the contexts that hold the same
    string; ``first`` marks one window of each string."""
    windows = np.array([len(c) - width + 1 for c in contexts])
    owner = np.repeat(np.arange(len(contexts)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = np.cumsum([0, *[len(c) for c in contexts[:-1]]])
    order, common = deep_shallow(b"".join(contexts), begin[owner] + inside, width)
    first = common < width
    first[:1] = True
    runs = np.flatnonzero(first)
    smallest = np.minimum.reduceat(low[owner[order]], runs)
    return owner[order], inside[order], np.repeat(smallest, np.diff(np.append(runs, len(order)))), first


def _spans_of(owner, inside, smallest, high) -> tuple[np.ndarray, list[np.ndarray]]:
    """Contexts with windows that some document must lose, and (begin, end,
    low, offsets) of those windows in runs."""
    back = np.lexsort((inside, owner))
    owner, inside, smallest = owner[back], inside[back], smallest[back]
    lost = smallest < high[owner]
    owner, inside, smallest = owner[lost], inside[lost], smallest[lost]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1) | (smallest[1:] != smallest[:-1])
    runs = np.flatnonzero(fresh)
    ends = np.append(runs[1:], len(owner)) - 1
    context = owner[runs]
    edges = run_edges(context)
    if not len(runs):
        return context, [context, context, context, np.zeros(1, dtype=np.int64)]
    return context[edges[:-1]], [inside[runs], inside[ends], smallest[runs], edges]


SPANS = "array<struct<begin:int,end:int,low:long>>"


def _lost_windows(groups: DataFrame, width: int) -> DataFrame:
    """(name, content, spans): windows of a context that also start in a text
    of a smaller id than the largest that holds the context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, ["name"]):
            contexts = table.column("context").to_pylist()
            low, high = (table.column(c).to_numpy() for c in ("low", "high"))
            which, (begin, end, least, edges) = _spans_of(*sorted_windows(contexts, low, width)[:3], high)
            parts = [pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(least.astype(np.int64))]
            spans = pa.ListArray.from_arrays(edges.astype(np.int32), pa.StructArray.from_arrays(parts, ["begin", "end", "low"]))
            taken = table.select(["name", "content"]).take(which)
            columns = [taken.column(c).combine_chunks() for c in ("name", "content")]
            yield pa.RecordBatch.from_arrays([*columns, spans], ["name", "content", "spans"])

    dealt = groups.select("name", "content", "low", "high", "context").repartition("name").sortWithinPartitions("name", "content")
    return dealt.mapInArrow(run, f"name long, content long, spans {SPANS}")


def _lost_windows_in_parts(groups: DataFrame, width: int) -> DataFrame:
    """The same for names of many contexts (with their number, ``contexts``):
    parts are sorted, their distinct windows merged by hash."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, ["name", "part"]):
            contexts = table.column("context").to_pylist()
            owner, inside, smallest, first = sorted_windows(contexts, table.column("low").to_numpy(), width)
            cells = zip(owner[first].tolist(), inside[first].tolist())
            hashes = [xxhash.xxh128_digest(contexts[c][i : i + width]) for c, i in cells]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), pa.array(smallest[first])], ["window", "least"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contexts = batch.column("context").to_pylist()
            n = np.array([len(c) - width + 1 for c in contexts], dtype=np.int64)
            rows = np.repeat(np.arange(len(contexts)), n)
            inside = np.concatenate([np.arange(k) for k in n]) if len(n) else n
            hashes = [xxhash.xxh128_digest(contexts[c][i : i + width]) for c, i in zip(rows.tolist(), inside.tolist())]
            columns = [batch.column(c).take(pa.array(rows)) for c in ("name", "content", "high")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(inside.astype(np.int32)), pa.array(hashes, pa.binary())], ["name", "content", "high", "at", "window"]
            )

    parts = F.ceil(F.col("contexts") / HOT_CONTEXTS)
    dealt = groups.withColumn("part", F.pmod("content", parts)).select("name", "part", "low", "context")
    dealt = dealt.repartition("name", "part").sortWithinPartitions("name", "part")
    least = dealt.mapInArrow(distinct, "window binary, least long").groupBy("window").agg(F.min("least").alias("least"))
    every = groups.select("name", "content", "high", "context").mapInArrow(windows, "name long, content long, high long, at int, window binary")
    lost = every.join(least, "window").where("least < high")
    spans = F.collect_list(F.struct(F.col("at").alias("begin"), F.col("at").alias("end"), F.col("least").alias("low")))
    return lost.groupBy("name", "content").agg(spans.alias("spans"))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Landed (key, key2, id, raw, row): every text once, with the smallest id
    and a number that is small and so packs well."""
    rows = _keyed(docs).groupBy("key", "key2").agg(F.min("id").alias("id"), F.any_value("raw").alias("raw"))
    return land(rows.withColumn("row", F.monotonically_increasing_id()), "suffix-texts", CODEC)


def _keyed(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), "doc_id", raw.alias("raw"))
    return rows.withColumns({"key": F.xxhash64("raw"), "key2": F.xxhash64(F.lit(1), "raw")})


def repeated_spans(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """Landed (row, spans): of texts as from ``distinct_texts``, the ranges of
    bytes to remove (begin, end), unsorted and overlapping."""
    if width < ANCHOR + 1:
        raise ValueError(f"a window needs more than {ANCHOR} bytes")
    marks = F.collect_list(F.struct("name", "place")).alias("marks")
    anchors = land(_repeated(_anchor_rows(texts, width)).groupBy("row").agg(marks), "suffix-anchors")
    contexts = land(_contexts(texts.join(anchors, "row"), width), "suffix-contexts", CODEC)
    release(anchors)
    groups = contexts.groupBy("name", "content").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.max("context").alias("context")
    )
    groups = land(groups, "suffix-groups", CODEC)
    sizes = groups.groupBy("name").agg(F.count("*").alias("contexts"), F.min("low").alias("least"), F.max("high").alias("most"))
    # Names within one text (or one id) take nothing away.
    sizes = land(sizes.where("least < most").select("name", "contexts"), "suffix-names")
    live = groups.join(sizes, "name")
    lost = _lost_windows(live.where(F.col("contexts") <= HOT_CONTEXTS), width)
    hot = land(sizes.where(F.col("contexts") > HOT_CONTEXTS), "suffix-hot")
    if not hot.isEmpty():
        lost = lost.unionByName(_lost_windows_in_parts(join_small(groups, hot, "name", "inner"), width))
    lost = land(lost, "suffix-lost")
    release(groups, sizes, hot)
    own = contexts.select("name", "content", "row", "id", "place").join(lost, ["name", "content"])
    ranges = F.transform(
        F.filter("spans", lambda s: s["low"] < F.col("id")),
        lambda s: F.struct((F.col("place") + s["begin"]).alias("begin"), (F.col("place") + s["end"] + width).alias("end")),
    )
    own = own.select("row", ranges.alias("ranges")).where(F.size("ranges") > 0)
    spans = land(own.groupBy("row").agg(F.flatten(F.collect_list("ranges")).alias("spans")), "suffix-spans")
    release(contexts, lost)
    return spans


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges as maximal runs, in order."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    fresh = np.ones(len(begin), dtype=bool)
    fresh[1:] = begin[1:] > end[:-1]
    return begin[fresh], end[np.append(np.flatnonzero(fresh)[1:], len(begin)) - 1]


def _cut(raw: bytes, spans) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Removed runs (begin, end) and the bytes kept."""
    none = np.zeros(0, dtype=np.int64)
    cells = spans.values if spans.is_valid else None
    begin, end = (none, none) if cells is None else (cells.field(c).to_numpy() for c in ("begin", "end"))
    begin, end = merged(begin, end)
    kept = [raw[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)])]
    return begin, end, b"".join(kept)


def cut_documents(docs: DataFrame, width: int = WIDTH, texts: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (begin, end) and,
    with ``texts``, the bytes kept, for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, spans in enumerate(batch.column("spans")):
                raw = batch.column("raw")[i].as_py()
                begin, end, kept = _cut(raw, spans)
                runs = [{"begin": a, "end": b} for a, b in zip(begin.tolist(), end.tolist())]
                rows.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), runs, kept if texts else b""))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.binary()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            names = ["key", "key2", "id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), *columns], names)

    once = distinct_texts(docs)
    marked = once.join(repeated_spans(once, width), "row", "left").select("key", "key2", "id", "raw", "spans")
    schema = (
        "key long, key2 long, id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<begin:long,end:long>>, kept binary"
    )
    found = land(marked.mapInArrow(run, schema).withColumnRenamed("id", "first"), "suffix-cut")
    every = _keyed(docs).select("doc_id", "id", "key", "key2").join(found, ["key", "key2"])
    # A copy of a text in a smaller document goes as a whole.
    copy = (F.col("id") > F.col("first")) & (F.col("n_bytes") >= width)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    return every.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.col("spans")).alias("spans"),
        *([F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if texts else []),
    )
