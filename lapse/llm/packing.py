"""Packing documents into token sequences of bounded length.

Documents are tokenized and cut into pieces of the sequence length and one
remainder. Packing works on the histogram of piece lengths: lengths are placed
longest first, each time into the packs that are shortest so far, or evenly
into as few new packs as hold them, updating counts of packing patterns rather than single packs. Patterns then go back to
the pieces by rank: the n-th piece of a length takes the n-th place that the
patterns hold for this length.

Scale: token ids stay inside the tokenizing task, which returns a narrow row
per piece. The histogram has at most as many entries as the sequence length.
The places grow with the patterns, not with the pieces; they are broadcast
where there are at most ``MAX_PLACES``. Ranks come from counts per (length,
bucket), so a length that a third of all pieces share is split. Long texts are
encoded in parts of about a megabyte, cut where no token can cross.

Defined cases: a null text counts as an empty one (one piece holding the end
id); a string that the tokenizer file adds as a token (such as an end mark) gets
that token's id, as the tokenizer gives it; repeated rows are packed each; null
ids are ordinary ids; ties go by id, start and ids; texts may have any length;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import process_cache
from lapse.operators.materialize import land

SEQUENCE = 1024
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BUCKET_ROWS = 20_000
MAX_PLACES = 100_000
PART = 1 << 20  # letters encoded at once
CACHE_UNITS = 400_000
LONG_UNIT = 400


def _byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        letters[chr(256 + n)] = b
    return letters


def _merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Vocabulary as byte strings by rank, if its merges are in id order and
    it cuts texts by the byte-level pattern; else None."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer")
    if not plain or model.get("type") != "BPE":
        return None
    letters, special = _byte_letters(), {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"]["".join(m)] for m in merges]
    return ranks if ids == sorted(ids) and len(set(ids)) == len(ids) else None


class Encoder:
    """Token ids (little-endian 32-bit) of texts, as the tokenizer file says.

    Added tokens of the file are found first, as the tokenizer does. A
    byte-level tokenizer never joins text across a space that follows
    anything and precedes a non-space, so texts are cut there and the ids of
    the pieces are cached. Vocabularies whose merges are in id order are
    encoded by rank, which gives the same ids faster; all others, very
    long pieces, and texts with added tokens that reach beyond themselves, by
    the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.ranked = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ranks = _merge_ranks(spec)
        tokens = spec.get("added_tokens", [])
        self.added = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in tokens}
        self.plain = not any(t.get(k) for t in tokens for k in ("lstrip", "rstrip", "single_word", "normalized"))
        # Longer tokens first where one begins another.
        mark = "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True))
        self.marks = re.compile(f"({mark})") if mark else None
        if ranks:
            import public_tokenizers
            import tiktoken

            self.ranked = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, text: str) -> bytes:
        if self.ranked is not None and len(text) <= LONG_UNIT:
            ids = self.ranked.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _units(self, text: str) -> list[str]:
        """Pieces of the text at safe spaces; all but the first lack theirs."""
        units = text.split(" ")
        if "" not in units and not any(map(str.isspace, {u[0] for u in units})):
            return units
        out = units[:1]
        for u in units[1:]:
            if not u or u[0].isspace():
                out[-1] += " " + u
            else:
                out.append(u)
        return out

    def _parts(self, text: str) -> Iterator[str]:
        """The text in parts of about ``PART`` letters, cut at safe spaces."""
        at = 0
        while len(text) - at > 2 * PART:
            cut = text.find(" ", at + PART)
            while 0 <= cut and (cut + 1 == len(text) or text[cut + 1].isspace()):
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def encode(self, text: str) -> bytes:
        if self.ranked is None or (not self.plain and self.marks and self.marks.search(text)):
            return self._ids(text)
        out = []
        for n, between in enumerate(self.marks.split(text) if self.marks else [text]):
            if n % 2:
                out.append(self.added[between])
            elif between:
                out += map(self._encoded, self._parts(between))
        return b"".join(out)

    def _encoded(self, text: str) -> bytes:
        cache, out = self.cache, []
        if len(cache) > CACHE_UNITS:
            cache.clear()
        first, *units = self._units(text)
        out.append(self._ids(first))
        for u in units:
            ids = cache.get(u)
            if ids is None:
                ids = self._ids(" " + u)
                if len(u) <= 64:
                    cache[u] = ids
            out.append(ids)
        return b"".join(out)


def encoder(path: str | None) -> Encoder:
    """The worker's encoder for a tokenizer file (None: the public default)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    cache = process_cache()
    if ("encoder", path) not in cache:
        cache["encoder", path] = Encoder(path)
    return cache["encoder", path]


def pieces(docs: DataFrame, path: str | None = None, length: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode: Callable[[str], bytes] = encoder(path).encode
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, length):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            arrays = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (count, lengths): lengths longest first, each into the
    shortest packs so far. Pieces that fit nowhere share new packs: as few
    packs as hold them, dealt evenly."""
    open_packs: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            shortest = min(open_packs, default=size)
            if shortest + length > size:
                packs = -(-left // (size // length))
                each, more = divmod(left, packs)
                for count, n in ((more, each + 1), (packs - more, each)):
                    if count:
                        open_packs[n * length].append((count, (length,) * n))
                break
            count, pattern = open_packs[shortest].pop()
            taken = min(left, count)
            if count > taken:
                open_packs[shortest].append((count - taken, pattern))
            if not open_packs[shortest]:
                del open_packs[shortest]
            open_packs[shortest + length].append((taken, (*pattern, length)))
            left -= taken
    return [p for total in sorted(open_packs) for p in open_packs[total]]


def places(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of each place."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            out.append((length, used[length], used[length] + count, sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return out


def _ranked(rows: DataFrame, buckets: int) -> DataFrame:
    """Rank of every piece among those of its length, from 0."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    counts = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = rows.withColumn("number", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("number"))


def pack(docs: DataFrame, path: str | None = None, length: int = SEQUENCE) -> DataFrame:
    """All pieces with their sequence and offset."""
    spark = docs.sparkSession
    cut = land(pieces(docs, path, length), "pack-pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    place_rows = places(pack_histogram(histogram, length))
    schema = "at_length long, first long, last long, sequence long, offset long"
    table = spark.createDataFrame(place_rows, schema)
    if len(place_rows) <= MAX_PLACES:
        table = F.broadcast(table)
    ranked = _ranked(cut, max(1, -(-sum(histogram.values()) // BUCKET_ROWS)))
    inside = (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    return ranked.join(table, inside).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        "offset",
    )
