"""The corpus pipeline, stage by stage, and the registered queries."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as pipeline
import duckdb
import pytest
from helpers import AWKWARD, SMALL, docs, passage
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lapse.llm import queries


def write_and_read(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages_over_awkward_documents(spark, tmp_path):
    df = write_and_read(spark, docs(spark), tmp_path / "in")
    columns, counts = df.columns, []
    for name, stage in pipeline.STAGES:
        df = write_and_read(spark, stage(spark, df, SMALL), tmp_path / name)
        counts.append(df.count())
        if name != "packing":
            assert df.columns == columns
    assert counts[0] == len(AWKWARD) - 4
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] >= counts[2]


def test_repeated_passages_stay_once(spark):
    passage_ = passage(60, 77)
    rows = [(i, f"start{i} {passage_} end{i}", "en", "a") for i in range(1, 6)]
    kept = {r.doc_id: r.text for r in pipeline.repeats(spark, docs(spark, rows), SMALL).collect()}
    assert kept[1] == rows[0][1] and all(kept[i] == f"start{i} end{i}" for i in range(2, 6))


def test_planted_wrong_labels_are_corrected(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").where("lang is not null and length(text) > 500")
    truth = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    english = sorted(i for i, v in truth.items() if v == "en")[:3]
    wrong = F.when(F.col("doc_id") == english[0], "fr").when(F.col("doc_id") == english[1], None).otherwise(F.col("lang"))
    got = {r.doc_id: r.lang for r in pipeline.language(spark, table.withColumn("lang", wrong), SMALL).collect()}
    assert got[english[0]] == got[english[1]] == "en"
    assert sum(got[i] == v for i, v in truth.items()) >= 0.98 * len(truth)


def test_stages_over_an_empty_table(spark, tmp_path):
    df = write_and_read(spark, docs(spark, []), tmp_path / "in")
    for name, stage in pipeline.STAGES:
        df = write_and_read(spark, stage(spark, df, SMALL), tmp_path / name)
        assert df.count() == 0


def test_run_equals_its_stages(spark, tmp_path):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in pipeline.STAGES:
        df = write_and_read(spark, stage(spark, df, SMALL), tmp_path / name)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(tuple(r[c] for c in key) for r in df.collect()) == Counter(tuple(r[c] for c in key) for r in pipeline.run(spark, SMALL).collect())


def test_unlabelled_documents_stay(spark, tmp_path):
    null, und = ([(*r[:2], lang, r[3]) for r in AWKWARD] for lang in (None, "und"))
    for rows in (null, und):
        kept = pipeline.language(spark, docs(spark, rows), SMALL)
        assert kept.columns == docs(spark).columns
        assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r[0]) for r in AWKWARD if r[0] not in (1, 2, 3, 11))
    docs(spark, null).write.parquet(str(tmp_path / "documents.parquet"))
    packed = {r.doc_id for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert {None, 4, 8, 9, 10} <= packed and not packed & {1, 2, 3, 11}


def test_registered(spark):
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    expected = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SMALL).select(*expected.columns).collect()
    assert sorted(map(tuple, got)) == sorted(expected.fetchall())
