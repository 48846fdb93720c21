"""Mixing, packing, sharding and vector searches."""

from __future__ import annotations

import functools
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from helpers import AWKWARD, SMALL, docs, passage, words
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lapse.llm import ann, mixing, packing, queries, sharding, topk, vectors
from lapse.operators.materialize import land


def plan_text(df):
    return df._jdf.queryExecution().toString()


# --- mixing ----------------------------------------------------------------------


def hot_rows(n=600):
    """One source holds most rows; sizes vary."""
    return [(i, passage(3 + i % 40, i), "en", "big" if i % 3 else f"s{i % 4}") for i in range(n)]


def test_mixture_reaches_the_entropy(spark):
    df = docs(spark, hot_rows())
    got = mixing.mix_blocks(df, block_tokens=2000).collect()
    weight = {r.source: r.weight for r in got}
    assert abs(sum(weight.values()) - 1) < 1e-9
    entropy = -sum(x * math.log(x) for x in weight.values()) / math.log(len(weight))
    assert abs(entropy - mixing.ENTROPY_SHARE) < 1e-5
    tokens = {}
    for r in df.collect():
        tokens[r.source] = tokens.get(r.source, 0) + len(words(r.text))
    total = sum(tokens.values())
    norm = sum((t / total) ** got[0].exponent for t in tokens.values())
    for s, x in weight.items():
        assert abs(x - (tokens[s] / total) ** got[0].exponent / norm) < 1e-9
    # Each source gives its budget, but for less than a document.
    budget = max(t / weight[s] for s, t in tokens.items())
    used = Counter()
    for r in got:
        used[r.source] += r.n_tokens
    assert all(0 <= used[s] - budget * x < 45 for s, x in weight.items())
    # Whole passes come before the last one; every document is in the first.
    assert len([r for r in got if r["pass"] == 0]) == 600
    for s in weight:
        places = sorted((r.source_start, r.n_tokens) for r in got if r.source == s)
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
    # Blocks hold the sources in proportion.
    blocks = defaultdict(Counter)
    for r in got:
        blocks[r.block][r.source] += r.n_tokens
    assert abs(blocks[1]["big"] - 2000 * weight["big"]) < 90


def test_mixture_repetition_limit_wins(spark):
    rows = [(i, passage(20, i), "en", "big" if i < 400 else "tiny") for i in range(404)]
    got = mixing.mix_blocks(docs(spark, rows), entropy_share=1.0, max_repeats=3.0).collect()
    assert max(r.passes for r in got) <= 3.001
    assert Counter(r.source for r in got)["tiny"] == 12


def test_mixture_budget_below_the_corpus(spark):
    rows = [(i, passage(20, i), "en", "a" if i % 4 else "b") for i in range(400)]
    got = mixing.mix_blocks(docs(spark, rows), budget=2000.0).collect()
    assert 2000 <= sum(r.n_tokens for r in got) <= 2040


def test_mixture_awkward_cases(spark):
    df = docs(spark)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    got = Counter(map(repr, out.collect()))
    assert set(got) == set(map(repr, df.collect()))
    assert all(n >= m for n, m in ((got[k], c) for k, c in Counter(map(repr, df.collect())).items()))
    blocks = mixing.mix_blocks(df)
    assert blocks.count() == sum(got.values())
    assert "Python" not in plan_text(blocks) and "Arrow" not in plan_text(blocks)
    assert mixing.mix_documents(docs(spark, [])).collect() == []
    assert mixing.mix_blocks(docs(spark, [])).collect() == []
    wordless = mixing.mix_documents(docs(spark, [(1, "", "en", "a"), (2, None, "en", None)]))
    assert wordless.count() == 2


# --- packing -----------------------------------------------------------------------


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
@settings(max_examples=60, deadline=None)
def test_patterns_place_every_length_once(histogram):
    patterns = packing.pack_histogram(histogram, 64)
    placed = Counter()
    for count, lengths in patterns:
        assert count > 0 and sum(lengths) <= 64
        for n in lengths:
            placed[n] += count
    assert placed == Counter(histogram)
    ranks = defaultdict(list)
    for length, first, last, _, _ in packing.places(patterns):
        ranks[length].append((first, last))
    for length, spans in ranks.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == histogram[length]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def padding_of(histogram, size):
    sequences = sum(count for count, _ in packing.pack_histogram(histogram, size))
    return 1 - sum(n * k for n, k in histogram.items()) / (size * sequences)


def test_pieces_of_a_hot_length_share_new_packs():
    assert packing.pack_histogram({300: 3001}, 1024) == [(2, (300, 300)), (999, (300, 300, 300))]
    even = {n: 10 for n in range(1, 1025)}
    assert padding_of({**even, 300: 5120}, 1024) < 0.06
    assert padding_of({n: 10 for n in range(250, 1025)} | {300: 4000}, 1024) < 0.25


@functools.cache
def plain_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def plain_ids(text):
    return plain_tokenizer().encode(text, add_special_tokens=False).ids


END = "<|endoftext|>"
PARTS = st.lists(st.sampled_from(["ab", " ", "'s", "\n", "1", "é", " 漢", "\x1c", "x  y", END, END, "<|", "endoftext|>"]), max_size=14)


@given(st.text(st.sampled_from("ab 's\n\t1.é  漢\x1c"), max_size=60) | st.text(max_size=40) | PARTS.map("".join))
@example(f"{END}a {END} b{END}")
@example(f" {END}{END} ")
@settings(max_examples=300, deadline=None)
def test_encoder_gives_the_tokenizers_ids(text):
    got = np.frombuffer(packing.encoder(None).encode(text), dtype="<u4").tolist()
    assert got == plain_ids(text)


def test_encoder_of_long_texts_in_parts(monkeypatch):
    text = f"some words  and\n more, {END} it's 12 é " * 300 + "x" * 3000 + "  y " * 50
    monkeypatch.setattr(packing, "PART", 97)
    assert np.frombuffer(packing.encoder(None).encode(text), dtype="<u4").tolist() == plain_ids(text)


def test_places_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = docs(spark)
    expected = sorted(map(tuple, packing.pack(rows).collect()), key=repr)
    monkeypatch.setattr(packing, "MAX_PLACES", 0)
    assert sorted(map(tuple, packing.pack(rows).collect()), key=repr) == expected


def test_packing_round_trip(spark):
    for df in (docs(spark), spark.read.parquet(f"{SMALL}/documents.parquet")):
        expected = Counter()
        texts = defaultdict(list)
        for r in df.collect():
            ids = np.array([*plain_ids(r.text or ""), 0], dtype="<u4")
            texts[r.doc_id].append(ids)
            expected[r.doc_id, len(ids)] += len(ids)
        got, sequences = Counter(), defaultdict(list)
        for r in packing.pack(df).collect():
            crcs = {zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for ids in texts[r.doc_id] if len(ids) == r.doc_tokens}
            assert r.ids_crc32 in crcs and 1 <= r.length <= 1024
            got[r.doc_id, r.doc_tokens] += r.length
            sequences[r.sequence_id].append((r.offset, r.length))
        assert got == expected
        assert sorted(sequences) == list(range(len(sequences)))
        for parts in sequences.values():
            parts.sort()
            assert parts[0][0] == 0 and sum(n for _, n in parts) <= 1024
            assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    padding = 1 - sum(expected.values()) / (1024 * len(sequences))
    assert padding < 0.03
    assert packing.pack(docs(spark, [])).collect() == []


# --- sharding -----------------------------------------------------------------------


def check_shards(df, n_shards):
    got = sharding.shard_documents(df, n_shards).collect()
    rows = df.collect()
    sizes = Counter(r.shard for r in got)
    per = [sizes[s] for s in range(n_shards)]
    assert sum(per) == len(rows) and max(per) - min(per) <= 1 and set(sizes) <= set(range(n_shards))
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    groups = defaultdict(Counter)
    for r in got:
        groups[r.text_crc32][r.shard] += 1
    return groups, len(rows)


def test_shards_keep_groups_together(spark):
    rows = [(i, passage(5, i // 3), "en", "a") for i in range(600)] + [(i, passage(6, i), "en", "a") for i in range(600, 1000)]
    groups, _ = check_shards(docs(spark, rows), 16)
    cut = sum(len(s) > 1 for s in groups.values())
    assert cut <= 32


@pytest.mark.parametrize("copies", [2, 3])
def test_groups_stay_together_when_every_text_has_copies(spark, copies):
    rows = [(i, passage(5, i // copies), "en", "a") for i in range(960)]
    groups, _ = check_shards(docs(spark, rows), 16)
    # All places are taken, so moves are exchanges; a tenth may stay cut.
    assert sum(len(s) > 1 for s in groups.values()) <= len(groups) / 10


def test_groups_larger_than_a_shard_take_few():
    placed, left = sharding.place_large([(1, 25), (2, 11)], [10] * 5)
    shards = Counter(link for link, *_ in placed)
    assert shards == {1: 3, 2: 2} and sum(left) == 14
    for link in shards:
        spans = sorted((low, high) for x, _, low, high in placed if x == link)
        assert spans[0][0] == 0 and spans[-1][1] == sharding.UNIT and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def cut_links(labels):
    """Links (pairs of a group) between shards, from (link, shard) rows."""
    groups = defaultdict(Counter)
    for link, shard in labels:
        groups[link][shard] += 1
    return sum((sum(c.values()) ** 2 - sum(n * n for n in c.values())) // 2 for c in groups.values())


def brute_propagation(labels, room, rounds=16):
    """Document by document: each moves to the shard that most of its group
    has, into a free place or by exchange with a document that wants its own."""
    shard, members = dict(enumerate(s for _, s in labels)), defaultdict(list)
    for i, (link, _) in enumerate(labels):
        members[link].append(i)
    load = Counter(shard.values())
    for _ in range(rounds):
        waiting, moved = defaultdict(list), 0
        for link, group in sorted(members.items()):
            have = Counter(shard[i] for i in group)
            to = max(have, key=lambda s: (have[s], -s))
            for i in group:
                if shard[i] == to:
                    continue
                if load[to] < room[to]:
                    load[shard[i]] -= 1
                    load[to] += 1
                    shard[i] = to
                    moved += 1
                elif waiting[to, shard[i]]:
                    j = waiting[to, shard[i]].pop()
                    shard[i], shard[j] = to, shard[i]
                    moved += 2
                else:
                    waiting[shard[i], to].append(i)
        if not moved:
            break
    return cut_links([(link, shard[i]) for i, (link, _) in enumerate(labels)])


@pytest.mark.parametrize("alone", [0, 400], ids=["all-linked", "half-linked"])
@pytest.mark.parametrize("copies", [2, 4, 9])
def test_propagation_moves_documents_and_cuts_fewer_links(spark, alone, copies):
    n, shards = 2160, 8
    quota = sharding.quotas(n + alone * 6, shards)
    rows = [(i, f"t{i // copies}") for i in range(n)]
    base = spark.createDataFrame(rows, "doc_id long, text string")
    base = base.select("doc_id", F.lit(1).cast("long").alias("size"), F.lit(0).cast("long").alias("crc"), F.xxhash64("text").alias("link"))
    groups = base.groupBy("link").agg(F.count("*").alias("members"))
    first, room = sharding._starts(base, groups, quota)
    first = land(first, "test-labels")
    before = [(r.link, r.shard) for r in first.collect()]
    labels, history = sharding.propagate(first, room)
    after = [(r.link, r.shard) for r in labels.collect()]
    cuts = [c for c, _ in history]
    assert cuts[0] == cut_links(before) and sum(m for _, m in history) > n / 4
    assert all(a >= b for a, b in zip(cuts, cuts[1:])) and cuts[1] < cuts[0]
    # Where every place is taken, a tenth of the first cut may stay.
    assert cut_links(after) <= max(1.1 * brute_propagation(before, room), 0.1 * cuts[0])
    loads = Counter(s for _, s in after)
    assert all(loads[s] <= q + 4 * math.sqrt(q) for s, q in enumerate(quota))


def test_admitted_moves_keep_the_quotas():
    draw = np.random.default_rng(4)
    for _ in range(20):
        loads = draw.integers(50, 150, 6).tolist()
        room = [x + int(draw.integers(-10, 20)) for x in loads]
        matrix = draw.integers(0, 30, (6, 6)) * (1 - np.eye(6, dtype=int))
        flow = np.array(sharding.admitted(matrix.tolist(), loads, room)) * matrix
        after = np.array(loads) + flow.sum(axis=0) - flow.sum(axis=1)
        assert (flow >= 0).all() and (flow <= matrix).all()
        assert all(a <= max(r, n) + 0.6 for a, r, n in zip(after, room, loads))
    swaps = [[0, 40, 0], [30, 0, 0], [0, 0, 0]]
    assert np.allclose(np.array(sharding.admitted(swaps, [100, 100, 100], [100, 100, 100])) * swaps, [[0, 30, 0], [30, 0, 0], [0, 0, 0]], atol=0.6)


def test_hot_group_takes_few_shards(spark):
    rows = [(i, "same text" if i % 3 == 0 else passage(5, i), "en", "a") for i in range(900)]
    groups, n = check_shards(docs(spark, rows), 16)
    hot = groups[zlib.crc32(b"same text")]
    assert sum(hot.values()) == 300 and len(hot) <= math.ceil(300 / (n / 16)) + 2


def test_sharding_awkward_cases(spark):
    check_shards(docs(spark), 16)
    check_shards(docs(spark), 3)
    out = sharding.shard_documents(docs(spark, []))
    assert out.collect() == []
    plan = plan_text(sharding.shard_documents(docs(spark)))
    assert "Python" not in plan and "Arrow" not in plan


# --- vector searches -------------------------------------------------------------------


def vector_table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, score string, block string")


def random_vectors(n, dims=16, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, dims))
    v = (centres[draw.integers(0, 5, n)] + 0.3 * draw.normal(size=(n, dims))).astype(np.float32)
    v[n // 2 : n // 2 + n // 4] = v[0]  # many equal vectors
    return [(i, v[i].tolist()) for i in range(n)]


BAD = [(1000, None), (1050, [1.0, None] * 8), (1100, [float("nan")] * 16), (1150, [float("inf")] * 16), (None, [1.0] * 16)]


def brute_topk(rows, k, every):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    q = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in ok]
    out = []
    for i, a in q:
        if i % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in q if j != i and len(a) == len(b))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def repeated_vectors():
    """Rows with an exact copy, an id with two vectors, a copied query."""
    rows = random_vectors(300) + BAD + [(1200, [0.0] * 16), (1201, [1.5, 2.5]), (1250, [-1.0, 0.01]), (1300, []), (7, random_vectors(8)[7][1])]
    return rows + [rows[3], rows[50], rows[50], (100, random_vectors(8)[2][1])]


@pytest.mark.parametrize("chunk", [vectors.CHUNK_BYTES, 1000])
def test_topk_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(vectors, "CHUNK_BYTES", chunk)
    rows = repeated_vectors()
    df = vector_table(spark, rows).repartition(3)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute_topk(rows, 5, 50)


def test_topk_sql_has_the_same_reading_of_repeated_rows(spark, tmp_path):
    rows = [(i, v) for i, v in repeated_vectors() if v]
    vector_table(spark, rows).select("vec_id", "embedding").write.parquet(str(tmp_path / "embeddings"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings/*.parquet')")
    sql = con.sql(queries.ORACLE_SQL["op2_topk"]).fetchall()
    assert sorted(sql) == brute_topk(rows, 5, 50)


def test_block_search_prunes_without_loss():
    draw = np.random.default_rng(5)
    rows = topk.quantise(draw.normal(size=(500, 48)) * np.linspace(2, 0.01, 48))
    asked = topk.quantise(draw.normal(size=(20, 48)) * np.linspace(2, 0.01, 48))
    ids, query_ids = np.arange(500), np.arange(20)
    got = topk.block_top(ids, rows, query_ids, asked, 5)
    exact = topk._exact_top(ids, rows, query_ids, asked, 5)
    assert all((a == b).all() for a, b in zip(got, exact))
    # From a bound that the k-th best reaches, nothing better is lost.
    floor = exact[2].reshape(20, 5)[:, -1].astype(float)
    bounded = topk.block_top(ids, rows, query_ids, asked, 5, floor)
    assert all((a == b).all() for a, b in zip(bounded, exact))
    assert len(topk.block_top(ids, rows, query_ids, asked, 5, floor + 1)[0]) < 100
    assert len(topk.block_top(ids, rows * 1e12, query_ids, asked * 1e12, 5)[0]) == 100


def test_best_rows_merge_in_any_order():
    draw = np.random.default_rng(2)
    query, ids, score = draw.integers(0, 9, 3000), draw.integers(0, 40, 3000), draw.integers(-20, 20, 3000)
    score[:5] = np.iinfo(np.int64).min
    best = vectors.Best(10, 4, int)
    for part in np.array_split(draw.permutation(3000), 23):
        best.offer(query[part], ids[part], score[part])
    numbers = np.arange(10) + 100
    got = sorted(zip(*(c.tolist() for c in best.rows(numbers, np.arange(10)))))
    expected = [(q, q + 100, int(i), int(s)) for q in range(10) for s, i in sorted((-int(s), int(i)) for s, i in zip(score[query == q], ids[query == q]))[:4] for s in [-s]]
    assert got == sorted(expected)


def test_topk_fewer_candidates_and_empty(spark):
    assert topk.top_k(vector_table(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    got = topk.top_k(vector_table(spark, [(0, [1.0, 1.0]), (1, [2.0, 1.0])]), F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 3 * 65536)]


def brute_nearest(rows, k, every):
    ok = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v]
    ok = [(i, v) for i, v in ok if np.isfinite(v).all() and v.any()]
    out = defaultdict(list)
    for i, a in ok:
        if i % every == 0:
            out[i].append(sorted((float(np.sqrt(((a - b) ** 2).sum())), j) for j, b in ok if j != i and len(a) == len(b))[:k])
    return out


@pytest.mark.parametrize("factor", [1.0, ann.FACTOR])
def test_nearest_against_brute_force(spark, monkeypatch, factor):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 400)
    rows = random_vectors(1500, seed=2) + [(i + 10_000, v) for i, v in BAD if i is not None] + [(9_000, [0.0] * 16), (9_100, [3.0, 4.0])]
    rows += [rows[100], rows[3], (300, rows[7][1])]  # a copied query, a copied row, an id with two vectors
    expected = brute_nearest(rows, 10, 100)
    got = defaultdict(list)
    for r in ann.nearest(vector_table(spark, rows).repartition(3), F.col("vec_id") % 100 == 0, factor=factor).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q, lists in expected.items():
        mine = sorted(got.get(q, []))
        assert [m[0] for m in mine] == sorted(n + 1 for best in lists for n in range(len(best)))
        if factor == 1.0:
            assert sorted((m[2], m[1]) for m in mine) == sorted(x for best in lists for x in best)
        if len(lists) == 1:
            assert [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
            reach = lists[0][-1][0] + 1e-9 if lists[0] else 0.0
            hits += sum(m[2] <= reach for m in mine)
            total += len(lists[0])
    assert set(got) <= set(expected) and hits >= 0.9 * total


def test_tree_holds_every_row_once():
    v = np.random.default_rng(1).normal(size=(700, 8))
    order, nodes = ann.build_tree(v, leaf=16)
    assert sorted(order.tolist()) == list(range(700))
    inner = nodes[nodes[:, 3] >= 0]
    assert len(inner) and (nodes[nodes[:, 3] < 0][:, 1] - nodes[nodes[:, 3] < 0][:, 0]).max() <= 16
    assert ann.build_tree(v[:0])[1].shape == (1, 5)


def test_nearest_empty(spark):
    assert ann.nearest(vector_table(spark, []), F.col("vec_id") % 100 == 0).collect() == []
    assert len(AWKWARD) == docs(spark).count()
