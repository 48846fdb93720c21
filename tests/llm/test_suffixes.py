"""Deep-shallow suffix sorting and the removal built on it."""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pytest
from helpers import AWKWARD, SMALL, docs, passage
from hypothesis import given, settings
from hypothesis import strategies as st

from lapse.llm import queries, suffixes
from lapse.sources.tables import read_table


def common_prefix(a: bytes, b: bytes) -> int:
    return len(os.path.commonprefix([a, b]))


def check_sorted(raw: bytes, width: int, shallow: int):
    starts = np.arange(len(raw) - width + 1)
    order, common = suffixes.deep_shallow(raw, starts, width, shallow)
    strings = [raw[i : i + width] for i in starts[order].tolist()]
    assert sorted(order.tolist()) == starts.tolist() and strings == sorted(strings)
    assert common.tolist() == [0, *(common_prefix(a, b) for a, b in zip(strings, strings[1:]))]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=60, max_size=400) | st.text("ab", min_size=60, max_size=400).map(str.encode), st.sampled_from([0, 8, 16, 32]))
def test_suffixes_in_order_with_common_prefixes(raw, shallow):
    check_sorted(raw, 50, shallow)


def test_long_repeats_reach_the_tries():
    check_sorted(b"abracadabra" * 40 + b"x" * 90 + b"abracadabra" * 40, 50, 16)
    check_sorted(b"\x00\xff" * 100 + b"\x00" * 80, 50, 8)


def removed_brute(table, width=50):
    first: dict[bytes, int] = {}
    ids = [suffixes.LAST_ID if i is None else i for i, _ in table]
    raws = [(t or "").encode() for _, t in table]
    for i, raw in zip(ids, raws):
        for s in range(len(raw) - width + 1):
            w = raw[s : s + width]
            first[w] = min(first.get(w, i), i)
    out = []
    for (doc_id, _), i, raw in zip(table, ids, raws):
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for s in range(len(raw) - width + 1):
            if first[raw[s : s + width]] < i:
                gone[s : s + width] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        n_spans = int((np.diff(gone.astype(int)) == -1).sum())
        out.append((doc_id, len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


DIGEST = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def rows(df):
    return sorted((tuple(r[c] for c in DIGEST) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    table = [(r["doc_id"], r["text"]) for r in read_table(spark, SMALL, "documents").collect()]
    expected = removed_brute(table)
    assert sum(r[2] > 0 for r in expected) > 10
    assert rows(queries.op12_suffixes(spark, SMALL)) == expected


def awkward():
    shared = passage(30, 5)
    table = [(r[0], r[1]) for r in AWKWARD]
    table += [(20, shared), (21, "Ä" + shared + "é"), (19, shared[10:70]), (22, shared[:49]), (23, shared[:50]), (21, "x" + shared)]
    table += [(None, shared), (None, "other " + shared), (24, "ab" * 400), (25, "ba" * 300), (26, "é" * 60), (27, "x" + "é" * 60), (28, "a" * 5000)]
    return table


def spread(spark, table):
    return docs(spark, [(i, t, None, None) for i, t in table])


def test_awkward_rows(spark):
    table = awkward()
    assert rows(suffixes.cut_documents(spread(spark, table))) == removed_brute(table)
    assert suffixes.cut_documents(docs(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [1, 3])
def test_names_of_many_contexts_and_small_parts(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(suffixes, "CHUNK_ROWS", 5)
    monkeypatch.setattr(suffixes, "PART_ROWS", 20)
    monkeypatch.setattr(suffixes, "HELD_ROWS", 2)
    monkeypatch.setattr(suffixes, "BLOCK", 64)
    draw = np.random.default_rng(hot)
    line = "the line of thirty characters. "
    near = passage(25, 3)
    table = [(i, passage(8, 100 + i) + line + passage(8, 200 + i)) for i in range(25)]
    table += [(100 + i, near[: (k := int(draw.integers(1, 150)))] + "#" + near[k:]) for i in range(25)] + awkward()[-8:]
    assert rows(suffixes.cut_documents(spread(spark, table))) == removed_brute(table)


def test_kept_bytes_and_spans(spark):
    shared = passage(20, 5)
    found = {r["doc_id"]: r for r in suffixes.cut_documents(spread(spark, [(1, shared), (2, f"a {shared} b {shared} c"), (3, shared)])).collect()}
    assert bytes(found[1]["kept"]).decode() == shared and not found[1]["spans"]
    assert bytes(found[2]["kept"]).decode() == "a  b  c"
    assert [(s["begin"], s["end"]) for s in found[2]["spans"]] == [(2, 2 + len(shared)), (5 + len(shared), 5 + 2 * len(shared))]
    assert bytes(found[3]["kept"]) == b"" and [tuple(s) for s in found[3]["spans"]] == [(0, len(shared))]


def test_very_long_texts(spark):
    # Periodic, and longer than many blocks.
    table = [(1, "z" * 40 + passage(30, 1)), (2, passage(60_000, 2) + passage(30, 1)), (3, "ab" * 300_000)]
    found = {r["doc_id"]: r for r in suffixes.cut_documents(spread(spark, table)).collect()}
    assert found[2]["n_removed"] == len(passage(30, 1)) and found[2]["n_spans"] == 1
    assert found[1]["n_removed"] == found[3]["n_removed"] == 0
