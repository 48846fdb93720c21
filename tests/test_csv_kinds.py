"""Kinds of raw text cells: one short test a cell, however many columns."""

from lapse.sources import csv as raw_csv


def test_kinds_of_many_columns(spark):
    cells = {"null": [None, "nan"], "boolean": ["TRUE", None], "integer": ["-3", "12"], "double": ["1", "2.5"], "text": ["x", "1"]}
    names = [f"{kind}_{i}" for i in range(12) for kind in cells]
    df = spark.createDataFrame([tuple(cells[n.split("_")[0]][r] for n in names) for r in (0, 1)], ", ".join(f"{n} string" for n in names))
    kinds = raw_csv.column_kinds(df)
    got = {r.column_name: (r.kind, r.n_null, r.n_rows) for r in kinds.collect()}
    assert got == {n: (n.split("_")[0], sum(v in (None, "nan") for v in cells[n.split("_")[0]]), 2) for n in names}
    # Once one aggregate per column and kind, with the tests written out in each.
    assert kinds._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") <= 4


def test_columns_of_an_empty_file(spark):
    kinds = raw_csv.column_kinds(spark.createDataFrame([], "a string, `b c` string"))
    assert sorted(map(tuple, kinds.collect())) == [("a", "null", 0, 0), ("b c", "null", 0, 0)]
