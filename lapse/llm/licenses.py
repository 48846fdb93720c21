"""Licence scans with a positional rare-token index.

Licence notices are kept as templates of words. Every template is indexed by
its words of highest inverse document frequency, the frequencies being counted
over all documents. A text's occurrences of indexed words propose alignments
(template, place of its first word); alignments that several indexed words
agree on, by relative position, are kept, and their mandatory key phrases are
verified word by word, in order, each at most ``KEY_SHIFT`` words from its
place after the one before (the first: from its aligned place). The share of a
template's words found in place is the score, places moving with the phrases.

A few plain phrases (the base) are found exactly wherever they stand.

Scale: two scans without any shuffle but for the document frequencies of the
template words, which are summed inside a task first.

Defined cases: a null text counts as an empty one; texts without words have
no labels (empty strings) and score 0; documents with a base phrase but no
verified template score ``BASE_SCORE``; repeated rows are scanned each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import LOWER
from lapse.llm.words import word_hashes

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_SCORE = 0.5

# Label, notice, mandatory key phrases (standing in the notice).
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license version 2",)),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license"
        " as published by the free software foundation",
        ("gnu general public license", "free software foundation"),
    ),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        ("source and binary forms", "following conditions are met"),
    ),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc0", "released under the creative commons cc0 public domain dedication", ("creative commons cc0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("proprietary", "all rights reserved no part may be reproduced without written permission", ("no part may be reproduced",)),
)

RARE_WORDS = 3  # words by which a template is indexed
AGREEING = 2  # indexed words that must agree on an alignment
KEY_SHIFT = 3  # words by which a key phrase may stand nearer or farther

# Bytes that separate words: all but digits, lower-case letters and non-ASCII.
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def words_of(phrase: str) -> np.ndarray:
    return word_hashes(phrase.encode(), SEPARATORS)


def sequence_places(ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts at which the ids of ``phrase`` stand consecutively."""
    n = len(ids) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    hit = ids[:n] == phrase[0]
    for i in range(1, len(phrase)):
        hit &= ids[i : i + n] == phrase[i]
    return np.flatnonzero(hit)


class Scanner:
    """Vocabulary, templates and (once document frequencies are known) index."""

    def __init__(self, templates=TEMPLATES, base=None):
        base = BASE if base is None else base
        phrases = [t for _, t, _ in templates] + [k for _, _, keys in templates for k in keys] + list(base)
        self.vocabulary = np.unique(np.concatenate([words_of(p) for p in phrases]))
        self.base = [(label, self.ids(words_of(p))) for p, label in base.items()]
        self.templates = [(label, self.ids(words_of(t)), [self.ids(words_of(k)) for k in keys]) for label, t, keys in templates]
        self.postings: dict[int, list[tuple[int, int]]] = {}

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of word hashes, -1 for other words."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def read(self, text: str | None) -> np.ndarray:
        return self.ids(word_hashes((text or "").encode("utf-8", "replace").translate(LOWER), SEPARATORS))

    def index(self, frequency: np.ndarray, documents: int) -> None:
        """List every template under its words of highest IDF."""
        idf = np.log((documents + 1) / (frequency + 1))
        self.postings = {}
        for t, (_, words, _) in enumerate(self.templates):
            distinct = sorted(set(words.tolist()), key=lambda w: (-idf[w], w))[:RARE_WORDS]
            for o, w in enumerate(words.tolist()):
                if w in distinct:
                    self.postings.setdefault(w, []).append((t, o))
        self.indexed = np.array(sorted(self.postings), dtype=np.int64)

    def alignments(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(template, start) that enough indexed words agree on."""
        votes: Counter[tuple[int, int]] = Counter()
        for p in np.flatnonzero(np.isin(ids, self.indexed)).tolist():
            votes.update((t, p - o) for t, o in self.postings[int(ids[p])])
        near = range(-KEY_SHIFT, KEY_SHIFT + 1)
        return [(t, start) for t, start in votes if sum(votes[t, start + d] for d in near) >= AGREEING]

    def in_place(self, ids: np.ndarray, t: int, start: int) -> int:
        """Most words of the template in place over all ways to find its key
        phrases in order from ``start``; -1 if there is none."""
        _, words, keys = self.templates[t]

        def here(lo: int, hi: int, start: int) -> np.ndarray:
            place = start + np.arange(lo, hi)
            inside = (place >= 0) & (place < len(ids))
            return inside & (ids[np.where(inside, place, 0)] == words[lo:hi])

        def best(n: int, after: int, start: int) -> int:
            if n == len(keys):
                return int(here(after, len(words), start).sum())
            key, most = keys[n], -1
            for at in sequence_places(words, key).tolist():
                for moved in range(start - KEY_SHIFT, start + KEY_SHIFT + 1):
                    if at < after or moved + at < max(0, start + after) or not np.array_equal(ids[moved + at : moved + at + len(key)], key):
                        continue
                    rest = best(n + 1, at + len(key), moved)
                    if rest >= 0:
                        # Words between two phrases follow the one up to some place, then lead to the other.
                        follow, lead = here(after, at, start if n else moved), here(after, at, moved)
                        between = lead.sum() + max(0, np.cumsum(follow.astype(int) - lead).max(initial=0))
                        most = max(most, int(between) + len(key) + rest)
            return most

        return best(0, 0, start)

    def verified(self, ids: np.ndarray) -> list[tuple[str, float]]:
        """(label, share of template words in place) of verified templates."""
        out = []
        for t, start in self.alignments(ids):
            label, words, _ = self.templates[t]
            found = self.in_place(ids, t, start)
            if found >= 0:
                out.append((label, found / len(words)))
        return out

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base labels, labels, score."""
        ids = self.read(text)
        if not (ids >= 0).any():
            return len(ids), 0, None, None, "", "", 0.0
        found = [(label, sequence_places(ids, phrase)) for label, phrase in self.base]
        places = np.concatenate([p for _, p in found])
        base = {label for label, p in found if len(p)}
        method = self.verified(ids)
        score = max([s for _, s in method], default=BASE_SCORE if base else 0.0)
        ends = (int(places.min()), int(places.max())) if len(places) else (None, None)
        labels = base | {label for label, _ in method}
        return len(ids), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score


def document_frequencies(docs: DataFrame, scanner: Scanner) -> tuple[np.ndarray, int]:
    """In how many documents each vocabulary word occurs, and their number."""
    size = len(scanner.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, n = np.zeros(size + 1, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                count[np.unique(scanner.read(text.as_py()))] += 1  # -1 counts in the last place
            n += batch.num_rows
        count[size] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(count)], ["word", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "word long, n long")
    total = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return np.array([total.get(i, 0) for i in range(size)]), total.get(size, 0)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, base=None) -> DataFrame:
    """Base places, labels and score of every document."""
    scanner = Scanner(templates, base)
    scanner.index(*document_frequencies(docs, scanner))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, *scanner.scan(text.as_py())) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
