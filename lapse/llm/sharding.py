"""Sharding by balanced label propagation (DataFrame operations only).

Documents that share a link key (by default: equal texts) are linked; a
document's label is its shard, at first one drawn by a hash. Every round counts
the labels within each link group, and members wish to move to the label that
most of their neighbours have. Wishes are summed into a matrix (from shard, to
shard), and of each cell the share is admitted that keeps the quotas: what
leaves a shard frees as many places as may come in, so documents also swap
places where all quotas are full. Which of them move is drawn by a hash.
Neighbourhoods are kept as one histogram per group, so no pairs of documents
are ever formed. Groups larger than a shard fill as few shards as their quotas
allow from the start and stay there. When nothing moves any more, documents over
a shard's quota and documents without neighbours fill the shards to exactly even
row counts.

Scale: the text is read once and reduced to a narrow landed table; rounds
join labels and histograms on the link key (a hot group is split by AQE's
skew join, its histogram is pre-aggregated before the shuffle); quotas are 16
numbers and the matrix 256; positions come from per-bucket counts, never from
one global sort.

Defined cases: a null text has size 1 and is linked with other null texts;
texts may have any length; repeated rows are rows of their own; null ids are
ordinary ids; ties between labels go by a hash of group, label and round; an
empty table gives an empty result; columns other than ``doc_id`` and ``text``
are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import UNIT, text_or_empty, unit_hash
from lapse.operators.materialize import land, release

N_SHARDS = 16
MAX_ROUNDS = 16
BUCKET_ROWS = 20_000
# Members of a group larger than this part of a shard are drawn one by one.
SMALL_SHARE = 16


def quotas(n_rows: int, n_shards: int) -> list[int]:
    """Row quota per shard: equal but for a remainder of one row each."""
    return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]


def _literal(values: list) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _at(values: list, index: str) -> Column:
    return F.get(_literal(values), F.col(index).cast("int"))


def place_large(groups: list[tuple[int, int]], quota: list[int]) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """(link, shard, draws from, draws below) of groups (link, members), and the
    room left: the largest first, whole where a shard has room for it, else
    over the emptiest shards."""
    left, out = list(quota), []
    for link, members in sorted(groups, key=lambda g: (-g[1], g[0])):
        done = 0
        while done < members:
            shard = max(range(len(left)), key=lambda s: (left[s], -s))
            taken = min(members - done, left[shard])
            out.append((link, shard, UNIT * done // members, UNIT * (done + taken) // members))
            left[shard] -= taken
            done += taken
    return out, left


def _starts(base: DataFrame, groups: DataFrame, quota: list[int]) -> tuple[DataFrame, list[int]]:
    """The linked rows with their first shard (``fixed`` where it is final) and
    the places that the groups larger than a shard leave."""
    spark, n_shards = base.sparkSession, len(quota)
    large = F.col("members") > max(quota)
    # Fewer than there are shards.
    placed, left = place_large([(r["link"], r["members"]) for r in groups.where(large).collect()], quota)
    columns = [pa.array(c, k) for c, k in zip(zip(*placed) if placed else [[]] * 4, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))]
    pieces = spark.createDataFrame(pa.table(columns, names=["link", "fixed", "low", "high"]))
    total = max(1, sum(left))
    ends = [UNIT * sum(left[: s + 1]) // total for s in range(n_shards - 1)]
    draw = unit_hash("doc_id", "link", F.lit(-1))
    drawn = sum(((F.col("draw") >= e).cast("int") for e in ends), F.lit(0))
    rows = base.join(groups, "link").withColumn("draw", draw)
    within = (F.col("draw") >= F.col("low")) & (F.col("draw") < F.col("high"))
    rows = rows.join(F.broadcast(pieces), "link", "left").where(F.coalesce(within, F.lit(True)))
    shard = F.coalesce("fixed", drawn).cast("int").alias("shard")
    return rows.select("doc_id", "size", "crc", "link", "members", shard, F.col("fixed").isNotNull().alias("fixed")), left


def _wishes(labels: DataFrame, room: list[int], number: int) -> DataFrame:
    """(link, hist, to): members of each group by shard, and the shard that
    most of them have, among those with places."""
    hist = labels.where("not fixed").groupBy("link").agg(
        F.array(*[F.sum((F.col("shard") == s).cast("long")) for s in range(len(room))]).alias("hist")
    )
    ranked = F.transform(
        "hist",
        lambda h, i: F.when(
            F.get(_literal(room), i) > 0,
            F.struct(h.alias("h"), F.xxhash64("link", i, F.lit(number)).alias("tie"), i.cast("int").alias("shard")),
        ),
    )
    return hist.withColumn("to", F.array_max(ranked)["shard"])


def _matrix(wishes: DataFrame, n_shards: int) -> tuple[list[list[int]], list[int], int]:
    """Documents that wish to move from shard to shard, those on each shard,
    and the number of links cut."""
    own = [F.sum(F.get("hist", F.lit(s))).alias(f"s{s}") for s in range(n_shards)]
    all_ = F.aggregate("hist", F.lit(0).cast("long"), lambda a, x: a + x)
    inner = F.aggregate("hist", F.lit(0).cast("long"), lambda a, x: a + x * x)
    matrix, loads, cut = [[0] * n_shards for _ in range(n_shards)], [0] * n_shards, 0
    for r in wishes.groupBy("to").agg(*own, F.sum(((all_ * all_ - inner) / 2).cast("long")).alias("cut")).collect():
        cut += r["cut"]
        for s in range(n_shards):
            loads[s] += r[f"s{s}"]
            if r["to"] is not None and r["to"] != s:
                matrix[s][r["to"]] += r[f"s{s}"]
    return matrix, loads, cut


def admitted(matrix: list[list[int]], loads: list[int], room: list[int], rounds: int = 1000) -> list[list[float]]:
    """Of each cell (from, to) the share that may move: all at first; where more
    would come into a shard than its places and what leaves it allow, all that
    comes in is scaled down, until every shard keeps its quota."""
    n = len(room)
    flow = [[float(x) for x in row] for row in matrix]
    for _ in range(rounds):
        over = False
        for t in range(n):
            into = sum(flow[s][t] for s in range(n))
            limit = max(0.0, room[t] - loads[t] + sum(flow[t]))
            if into > limit + 0.5:
                over = True
                for s in range(n):
                    flow[s][t] *= limit / into
        if not over:
            break
    return [[f / w if w else 0.0 for f, w in zip(flows, row)] for flows, row in zip(flow, matrix)]


def _moved(labels: DataFrame, wishes: DataFrame, shares: list[list[float]], limit: int, number: int) -> DataFrame:
    """Labels after the admitted moves."""
    n_shards = len(shares)
    share = F.get(F.array(*[F.lit(x) for row in shares for x in row]), F.col("shard") * n_shards + F.col("to"))
    # A small group's members decide alike, those of a large one each by itself.
    one = F.when(F.col("members") * SMALL_SHARE > limit, F.col("doc_id"))
    draw = unit_hash("link", one, F.lit(number)) / F.lit(float(UNIT))
    go = F.coalesce(~F.col("fixed") & (F.col("shard") != F.col("to")) & (draw < share), F.lit(False))
    return labels.join(wishes.select("link", "to"), "link", "left").select(
        "doc_id", "size", "crc", "link", "members",
        F.when(go, F.col("to")).otherwise(F.col("shard")).alias("shard"),
        "fixed",
    )


def propagate(labels: DataFrame, room: list[int], max_rounds: int = MAX_ROUNDS) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Landed labels after propagation under ``room`` places a shard, and for
    each round the links cut before it and the documents it may move."""
    history: list[tuple[int, int]] = []
    for number in range(max_rounds):
        wishes = land(_wishes(labels, room, number), "shard-wishes")
        matrix, loads, cut = _matrix(wishes, len(room))
        shares = admitted(matrix, loads, room)
        moving = round(sum(w * f for row, part in zip(matrix, shares) for w, f in zip(row, part)))
        history.append((cut, moving))
        if not moving:
            release(wishes)
            break
        before, labels = labels, land(_moved(labels, wishes, shares, max(room), number), "shard-labels")
        release(before, wishes)
    return labels, history


def _positions(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Gapless positions from 0 within ``keys``, members of a link adjacent.

    Buckets of link keys (a large group is dealt over several) are counted,
    the counts cumulated, and rows numbered inside their bucket only.
    """
    parts = F.ceil(F.col("members") / BUCKET_ROWS)
    df = df.withColumn("bucket", F.pmod("link", F.lit(buckets))).withColumn(
        "part", F.when(parts > 1, F.pmod(F.xxhash64("doc_id", "link"), parts)).otherwise(F.lit(0))
    )
    inner = [*keys, "bucket", "part"]
    counts = df.groupBy(*inner).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*keys).orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*inner, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    number = F.row_number().over(Window.partitionBy(*inner).orderBy("link", "doc_id", "crc", "size")) - 1
    numbered = df.withColumn("number", number)
    return numbered.join(offsets, inner).withColumn("position", F.col("offset") + F.col("number"))


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, link: Column | None = None, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Assign every document to a shard; row counts differ by at most one.

    ``link`` is an expression over ``docs``; rows with equal values are linked
    (default: equal texts). Returns doc_id, size, text_crc32, shard, slot.
    """
    raw = F.encode(text_or_empty(), "UTF-8")
    base = land(
        docs.select(
            "doc_id",
            (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("crc"),
            (F.xxhash64("text") if link is None else F.xxhash64(link)).alias("link"),
        ),
        "shard-base",
    )
    n_rows = base.count()
    quota = quotas(n_rows, n_shards)
    buckets = max(16, math.ceil(n_rows / n_shards / BUCKET_ROWS))
    groups = land(base.groupBy("link").agg(F.count("*").alias("members")).where("members > 1"), "shard-groups")
    first, room = _starts(base, groups, quota)
    labels, _ = propagate(land(first, "shard-labels"), room, max_rounds)
    counted = {r["shard"]: r["count"] for r in labels.groupBy("shard").count().collect()}
    loads = [counted.get(s, 0) for s in range(n_shards)]
    kept = [min(n, q) for n, q in zip(loads, quota)]
    placed = land(_positions(labels, ["shard"], buckets).select("doc_id", "size", "crc", "link", "members", "shard", "position"), "shard-placed")
    staying = F.col("position") < _at(quota, "shard")
    # Documents over quota and those without neighbours fill what is left.
    alone = base.join(labels.select("link").distinct(), "link", "left_anti")
    pool = placed.where(~staying).select("doc_id", "size", "crc", "link", "members").unionByName(alone.withColumn("members", F.lit(1).cast("long")))
    pool = _positions(pool.withColumn("all", F.lit(0)), ["all"], buckets * n_shards)
    start, starts = 0, []
    for q, n in zip(quota, kept):
        starts.append(start)
        start += q - n
    nth = sum(((F.col("position") >= a).cast("int") for a, q, n in zip(starts, quota, kept) if q > n), F.lit(0))
    open_shards = [s for s in range(n_shards) if quota[s] > kept[s]] or [0]
    pool = pool.withColumn("shard", F.get(_literal(open_shards), nth - 1).cast("int"))
    out = ["doc_id", "size", F.col("crc").alias("text_crc32"), "shard"]
    settled = placed.where(staying).select(*out, F.col("position").cast("long").alias("slot"))
    filled = pool.select(*out, (_at(kept, "shard") + F.col("position") - _at(starts, "shard")).cast("long").alias("slot"))
    return settled.unionByName(filled)
