"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm import ann, collocations, langid, licenses, lm, mixing, packing, sharding, simhash, spelling, substring, suffixes, topk
from lapse.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature mixture of all documents by source."""
    return mixing.mix_blocks(read_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of even row counts, equal texts together."""
    out = sharding.shard_documents(read_table(spark, sf_dir, "documents"))
    return out.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 5 best inner products for every 50th vector."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in every document after removal of repeated passages."""
    return substring.digests(read_table(spark, sf_dir, "documents"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 approximate nearest neighbours for every 100th vector."""
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens packed into sequences of at most 1024."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, labels and score of every document."""
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and maximum-entropy scores of every document."""
    return lm.score_documents(read_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op12_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left in every document without passages of smaller documents."""
    return suffixes.cut_documents(read_table(spark, sf_dir, "documents"), texts=False).drop("spans")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of 2 to 3 words of each language."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_topk, op3_substring, op4_ann, op5_packing,
        op6_licenses, op7_langid, op8_lm, op9_simhash, op10_sharding,
        op11_spelling, op12_suffixes, op13_collocations,
    )
}

# Exact in SQL: integer scores of a brute-force search, all windows of all
# documents grouped by their words, all phrases counted.
ORACLE_SQL: dict[str, str] = {
    "op3_substring": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), windows AS (
            SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
            FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
        ), repeated AS (
            SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1
        ), covered AS (
            SELECT DISTINCT r, i + j AS p FROM (SELECT r, i, unnest(range(0, 35)) AS j FROM repeated)
        ), placed AS (
            SELECT r, p, w[p] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d)
        ), kept AS (
            SELECT r, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n
            FROM placed ANTI JOIN covered USING (r, p) GROUP BY r
        )
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(words, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)
    """,
    "op2_topk": """
        WITH q AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.r, a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
            FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE a.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_suffixes": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
        ), windows AS (
            SELECT r, doc_id, i, md5(substr(x, (2 * i + 1)::BIGINT, 100)) AS h
            FROM (SELECT r, doc_id, x, unnest(range(0, (len(x) / 2)::BIGINT - 49)) AS i FROM d WHERE len(x) >= 100)
        ), lost AS (
            SELECT r, i FROM (
                SELECT r, i, coalesce(doc_id, 9223372036854775807) AS id,
                       min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY h) AS least
                FROM windows)
            WHERE least < id
        ), ends AS (
            SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50, TRUE) AS fresh FROM lost
        ), spans AS (
            SELECT r, min(i) AS begin, max(i) + 50 AS stop
            FROM (SELECT r, i, sum(fresh::INT) OVER (PARTITION BY r ORDER BY i) AS nth FROM ends) GROUP BY r, nth
        ), gaps AS (
            SELECT r, coalesce(lag(stop) OVER (PARTITION BY r ORDER BY begin), 0) AS a, begin AS b FROM spans
            UNION ALL
            SELECT d.r, coalesce(max(stop), 0), any_value((len(x) / 2)::BIGINT) FROM d LEFT JOIN spans USING (r) GROUP BY d.r
        ), kept AS (
            SELECT r, string_agg(substr(x, (2 * a + 1)::BIGINT, (2 * (b - a))::BIGINT), '' ORDER BY a) AS k
            FROM gaps JOIN d USING (r) GROUP BY r
        ), n AS (
            SELECT r, count(*) AS n_spans, sum(stop - begin) AS n_removed FROM spans GROUP BY r
        )
        SELECT doc_id, (len(x) / 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
               coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
        FROM d JOIN kept USING (r) LEFT JOIN n USING (r)
    """,
    "op13_collocations": r"""
        WITH p AS (
            SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
            FROM (
                SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array(
                           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents)
        ), grams AS (
            SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
            FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
                  FROM p CROSS JOIN (VALUES (1), (2), (3)) AS sizes (m) WHERE len(w) >= m)
        ), f AS (
            SELECT lang, m, phrase, count(*) AS n FROM grams GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(n) AS n FROM f WHERE m = 1 GROUP BY lang
        ), found AS (
            SELECT lang, m, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND n >= 10
        ), longest AS (
            SELECT lang, phrase, max(a) AS a
            FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM found WHERE m = 3)
            GROUP BY ALL
        ), kept AS (
            SELECT c.* FROM found c LEFT JOIN longest s USING (lang, phrase)
            WHERE s.a IS NULL OR 100 * s.a < 50 * c.a
        ), cuts AS (
            SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
            FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, x.n AS l, y.n AS r, k,
                   (1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n) AS score
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head
                        JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
        ), weakest AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored)
            WHERE nth = 1
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM weakest
        )
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
               totals.n::BIGINT AS n, score::BIGINT AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
