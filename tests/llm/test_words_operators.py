"""Spelling variants and collocations against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import ASCII_LOWER, AWKWARD, SMALL, docs, passage

import pyarrow as pa

from lapse.llm import collocations, spelling
from lapse.operators.materialize import land
from lapse.sources.tables import read_table


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# Spelling variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def spelling_brute(table, min_length=5, min_count=3):
    n = Counter()
    for doc_id, text in table:
        for run in RUN.findall(text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}
    gaps = defaultdict(set)  # words by what is left without one letter
    for w in n:
        for i in range(len(w)):
            gaps[w[:i] + w[i + 1 :], i].add(w)
            gaps[w[:i] + w[i + 1 :], None].add(w)
    near = {}
    for w in n:
        found = set().union(*(gaps[w[:i] + w[i + 1 :], i] for i in range(len(w)))) | gaps.get((w, None), set())
        found |= {w[:i] + w[i + 1 :] for i in range(len(w))} & set(n)
        near[w] = found - {w}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n), key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_match_brute_force(spark):
    table = read_table(spark, SMALL, "documents")
    pairs = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    expected = spelling_brute(pairs)
    assert sum(r[1] is not None for r in expected) > 20
    assert rows(spelling.variants(table), *COLUMNS) == expected


@pytest.mark.parametrize("classes", [1, 2, 5])
def test_near_words_for_any_number_of_classes(spark, monkeypatch, classes):
    draw = np.random.default_rng(classes)
    words = {"".join(draw.choice(list("abcé÷"), size=draw.integers(5, 9))) for _ in range(400)}
    words |= {"a" * 254, "a" * 255, "a" * 256, "a" * 255 + "b", "b" * 3000, "b" * 2999 + "c"}
    n = {w: int(draw.integers(3, 9)) for w in sorted(words)}
    monkeypatch.setattr(spelling, "PART_WORDS", 7)  # parts on both sides
    vocabulary = land(spark.createDataFrame(sorted(n.items()), "word string, n long"), "test-words")
    got = {r["word"]: (r["n_near"], r["near"]) for r in spelling.near_words(vocabulary, classes).collect()}
    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]
    expected = {}
    for w in n:
        found = [x for x in n if one_edit(w, x)]
        if found:
            expected[w] = (len(found), min(found, key=lambda x: (-n[x], x)))
    assert got == expected


def test_variants_of_awkward_rows(spark, monkeypatch):
    table = [*AWKWARD, *[(i, "hello helo hell÷ HELLO hellö Hello", "en", "a") for i in range(20, 23)], (None, "hello word", None, None)]
    long = "wörter " * 200_000 + "x" * 2_500_000 + " wörter"
    table += [(50, long, "de", "a"), (51, "wörtern wörtern wörtern", "de", "a")]
    expected = spelling_brute([(r[0], r[1]) for r in table])
    assert rows(spelling.variants(docs(spark, table)), *COLUMNS) == expected
    assert spelling.variants(docs(spark, [])).count() == 0
    monkeypatch.setattr(spelling, "HELD_WORDS", 2)
    assert rows(spelling.variants(docs(spark, table[:-2])), *COLUMNS) == spelling_brute([(r[0], r[1]) for r in table[:-2]])


def test_long_chains_of_forms_reach_their_root(spark):
    chain = land(spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)], "word string, form string"), "test-chain")
    assert {r["root"] for r in spelling.roots(chain).collect()} == {"w37"}


# Collocations


def collocations_brute(table, max_words=3, min_count=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in table:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(ASCII_LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, " ".join(w[i : i + m])) for m in range(1, max_words + 1) for i in range(len(w) - m + 1))
    found = {k: c for k, c in f.items() if " " in k[1] and c >= min_count}
    longest = Counter()
    for (lang, phrase), c in found.items():
        w = phrase.split(" ")
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                key = (lang, " ".join(w[i : i + m]))
                longest[key] = max(longest[key], c)
    out = defaultdict(list)
    for (lang, phrase), a in found.items():
        if 100 * longest[lang, phrase] >= 50 * a and longest[lang, phrase]:
            continue
        w = phrase.split(" ")
        cuts = []
        for k in range(1, len(w)):
            l, r = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out[lang].append((-score, -a, phrase.encode(), l, r))
    return sorted(
        (
            (lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
            for lang, rows_ in out.items()
            for i, (s, a, p, l, r) in enumerate(sorted(rows_)[:top])
        ),
        key=repr,
    )


PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def test_collocations_match_brute_force(spark):
    table = read_table(spark, SMALL, "documents")
    pairs = [(r["lang"], r["text"]) for r in table.collect()]
    expected = collocations_brute(pairs)
    assert len(expected) > 50 and any(r[2].count(" ") == 2 for r in expected)
    assert rows(collocations.collocations(table), *PHRASE) == expected
    few = collocations_brute(pairs, max_words=5, min_count=3, top=30)
    assert rows(collocations.collocations(table, max_words=5, min_count=3, top=30), *PHRASE) == few


def test_chunks_hold_each_ngram_once():
    draw = np.random.default_rng(3)
    text = " ".join(draw.choice(["aa", "b", "ccc", "d.", "e ,", "\tf", "g\n"], size=4000)).encode()
    raw = collocations.normalised(text)
    pieces = [p.split() for p in raw.split(b"\n")]
    for trigger, size in ((1, 64), (3, 100), (50, 1 << 20)):
        for m in (1, 2, 3):
            expected = Counter(b" ".join(w[i : i + m]) for w in pieces for i in range(len(w) - m + 1))
            found = Counter()
            for part, own in collocations.blocks(raw, size):
                slices, tails, _ = collocations.chunks(part, own, 3, trigger)
                for chunk, tail in zip(slices, tails):
                    w = chunk.split(b" ")
                    found.update(b" ".join(w[i : i + m]) for i in range(min(len(w) - tail, len(w) - m + 1)))
            assert found == expected


def test_collocations_of_awkward_rows(spark, monkeypatch):
    table = [*AWKWARD, *[(i, "New York, new  york\tcity; NEW york city\x0bis", None, "a") for i in range(20, 32)]]
    table += [(None, "new york " * 300_000, "xx", None), (60, "a b c " * 10 + passage(3000, 9) * 2, "en", "a")]
    expected = collocations_brute([(r[2], r[1]) for r in table])
    assert rows(collocations.collocations(docs(spark, table)), *PHRASE) == expected
    monkeypatch.setattr(collocations, "HELD_ROWS", 3)
    monkeypatch.setattr(collocations, "MAX_BITS", 8 * 8)  # bits coincide
    assert rows(collocations.collocations(docs(spark, table[:-2])), *PHRASE) == collocations_brute([(r[2], r[1]) for r in table[:-2]])
    assert collocations.collocations(docs(spark, [])).count() == 0


def test_chunks_are_split_from_the_column_itself():
    """Parts of a column (also a slice of one) hold each value with a line feed
    and its end, however long the values are."""
    values = [b"one two", b"", b"x" * 50, b"last one", b"y"]
    for column, expected in ((pa.array(values, pa.binary()), values), (pa.array(values, pa.binary())[1:4], values[1:4]), (pa.array([], pa.binary()), [])):
        for size in (1, 12, 1000):
            got, rows = [], []
            for which, raw, ends in collocations.lines_of(column, size):
                assert len(raw) <= size or which.stop - which.start == 1
                starts = [0, *ends[:-1].tolist()]
                got += [raw[a:b].tobytes() for a, b in zip(starts, ends.tolist())]
                rows += range(which.start, which.stop)
            assert got == [v + b"\n" for v in expected] and rows == list(range(len(expected)))


def test_phrases_of_several_languages_in_one_batch(spark):
    """Languages mixed row by row, copies of a chunk weighted."""
    table = [(i, f"red sun{i % 3} up. red sun{i % 3} up", ("en", "de", None)[i % 3], "a") for i in range(60)]
    assert rows(collocations.collocations(docs(spark, table)), *PHRASE) == collocations_brute([(r[2], r[1]) for r in table])


def test_phrases_are_counted_as_columns():
    """Slices that overlap are cut from the bytes themselves and summed in a
    task without a Python object each."""
    raw = b"a bb c\ndd e\n"
    words = collocations.Words(np.frombuffer(raw, dtype=np.uint8), np.array([6, 11]), np.array([0, 0]))
    for size in (1, 2, 3):
        at, found = words.phrases(size, words.joined(size))
        expected = [b" ".join(c[i : i + size]) for c in ([b"a", b"bb", b"c"], [b"dd", b"e"]) for i in range(len(c) - size + 1)]
        assert isinstance(found, pa.Array)
        assert [x for _, x in sorted(zip(at.tolist(), found.to_pylist()))] == expected
    held = collocations.Sums(["phrase"])
    for lang in ("xx", "yy", "xx"):
        held.add(np.array([held.code(lang)] * 3), pa.array([b"a", b"b", b"a"], pa.binary()), pa.array([1, 2, 3]))
    assert list(held.full()) == []
    got = {(r["lang"], r["phrase"]): r["n"] for batch in held.rest() for r in batch.to_pylist()}
    assert got == {("xx", b"a"): 8, ("xx", b"b"): 4, ("yy", b"a"): 4, ("yy", b"b"): 2}
    assert list(held.rest()) == []


def test_sums_are_sent_on_when_many(monkeypatch):
    monkeypatch.setattr(collocations, "HELD_ROWS", 5)
    held, got = collocations.Sums(["phrase"]), Counter()
    for i in range(20):
        held.add(np.array([held.code("xx")] * 2), pa.array([str(i % 9).encode(), b"z"], pa.binary()), pa.array([1, 1]))
        for batch in held.full():
            assert batch.num_rows > 5
            got.update({r["phrase"]: r["n"] for r in batch.to_pylist()})
        assert held.rows <= 5
    for batch in held.rest():
        got.update({r["phrase"]: r["n"] for r in batch.to_pylist()})
    assert got == Counter({b"z": 20, **{str(i).encode(): 3 if i < 2 else 2 for i in range(9)}})
