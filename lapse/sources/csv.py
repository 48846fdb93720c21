"""CSV exports in the engine's raw layout: one file per table and split.

Layout under a root folder::

    Train Data/train_users.csv, train_users_properties.csv, train_users_purchases.csv,
               train_users_transaction_attempts.csv, train_users_quizzes.csv
    Test Data/ test_users.csv, ... , test_users_generations.csv
    train_users_generations.csv/train_users_generations.csv

Every file starts with an unnamed index column, which is dropped. Cells are
read as text, the missing-value tokens below become null, and each column
is then converted (a bad value becomes null, never an error). Splits become a ``split`` column: train and test files of a table
are read as one DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.functions.numeric import to_number
from lapse.sources.fixtures import ChurnInputs

# Text read as missing (the common CSV missing-value tokens).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

S, D, B = "string", "double", "boolean"
RAW_SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "users": [("user_id", S), ("churn_status", S)],
    "props": [("user_id", S), ("subscription_start_date", S), ("subscription_plan", S), ("country_code", S)],
    "purchases": [
        ("user_id", S), ("transaction_id", S), ("purchase_amount_dollars", D), ("purchase_type", S),
        ("purchase_time", S),
    ],
    "tx": [
        ("transaction_id", S), ("digital_wallet", S), ("is_3d_secure", B), ("is_prepaid", B), ("is_virtual", B),
        ("is_business", B), ("cvc_check", S), ("amount_in_usd", D), ("billing_address_country", S),
        ("card_country", S), ("card_brand", S), ("card_funding", S), ("bank_name", S), ("failure_code", S),
    ],
    "generations": [
        ("generation_id", S), ("user_id", S), ("created_at", S), ("status", S), ("generation_type", S),
        ("credit_cost", S), ("duration", S),
    ],
    "quizzes": [
        ("user_id", S), ("source", S), ("team_size", S), ("experience", S), ("usage_plan", S),
        ("frustration", S), ("first_feature", S), ("role", S),
    ],
}

# Tables whose cells are free text and may hold line breaks.
FREE_TEXT = ("quizzes",)

FILES = {
    "users": "users.csv",
    "props": "users_properties.csv",
    "purchases": "users_purchases.csv",
    "tx": "users_transaction_attempts.csv",
    "quizzes": "users_quizzes.csv",
    "generations": "users_generations.csv",
}


def _typed(c: str, dtype: str) -> F.Column:
    col = F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c))
    if dtype == B:
        low = F.lower(col)
        return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False)).alias(c)
    if dtype == "long":
        return col.try_cast("long").alias(c)
    return (col if dtype == S else to_number(col)).alias(c)


# Kinds of cells, by rank: a column has the highest kind of its cells, but one
# that mixes truth values with numbers is text.
KINDS = ("null", "boolean", "integer", "double", "text")
KIND_TYPES = {"null": S, "boolean": B, "integer": "long", "double": D, "text": S}


def _raw_cells(spark: SparkSession, path: str, table: str, multi_line: bool | None = None) -> DataFrame:
    """A raw file as text, without its index column."""
    multi_line = table in FREE_TEXT if multi_line is None else multi_line
    raw = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line).csv(path)
    return raw.select(*raw.columns[1:])


def _kind_code(cell: F.Column) -> F.Column:
    """The rank of a cell's kind in ``KINDS``. The kinds exclude each other, so
    each test is made once a cell and only where the cheaper ones fail."""
    code = F.when(cell.isNull() | cell.isin(*NULL_TOKENS), 0).when(F.lower(cell).isin("true", "false"), 1)
    return code.when(cell.rlike(r"^[+-]?\d{1,18}$"), 2).when(to_number(cell).isNotNull(), 3).otherwise(4)


def merged_kind() -> F.Column:
    """The kind of a column from its counts of cells; counts of parts merge by
    summing, in any order."""
    has = {k: F.col(k) > 0 for k in KINDS[1:]}
    mixed = has["boolean"] & (has["integer"] | has["double"])
    kind = F.when(has["text"] | mixed, "text")
    for k in ("double", "integer", "boolean"):
        kind = kind.when(has[k], k)
    return kind.otherwise("null")


def column_kinds(raw: DataFrame) -> DataFrame:
    """column_name, kind, n_null, n_rows of every column of raw text cells.

    Cells become rows on the way into the tasks' partial counts: the code that
    tests a cell stays short, however many columns there are (as one aggregate
    per column and kind it outgrows what the JVM compiles).
    """
    cells = raw.unpivot([], raw.columns, "column_name", "cell").select("column_name", _kind_code(F.col("cell")).alias("_kind"))
    # A row that counts for nothing stands for each column of an empty file.
    names = raw.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in raw.columns])).alias("column_name"))
    counted = cells.unionByName(names.withColumn("_kind", F.lit(-1))).groupBy("column_name").agg(
        F.count_if(F.col("_kind") >= 0).alias("n_rows"),
        F.count_if(F.col("_kind") == 0).alias("n_null"),
        *[F.count_if(F.col("_kind") == k).alias(kind) for k, kind in enumerate(KINDS) if k],
    )
    return counted.select("column_name", merged_kind().alias("kind"), "n_null", "n_rows")


def csv_types(spark: SparkSession, root: str) -> DataFrame:
    """Inferred type and missing cells of every column of every raw file."""
    parts = []
    for table in FILES:
        for split in ("train", "test"):
            kinds = column_kinds(_raw_cells(spark, raw_path(root, split, table), table))
            parts.append(kinds.select(F.lit(table).alias("table_name"), F.lit(split).alias("split"), *kinds.columns))
    return reduce(DataFrame.unionByName, parts)


def read_raw_csv(spark: SparkSession, path: str, table: str, multi_line: bool | None = None, infer: bool = False) -> DataFrame:
    """One raw CSV file as a typed DataFrame (index column dropped).

    Columns outside the table's schema stay text; with ``infer`` they get the
    type of their cells (a pass over the file).

    Cells may be quoted, with doubled quotes inside. ``multi_line`` admits line
    breaks in quoted cells, at the price that a file is read by one task; by
    default it is on for the tables in ``FREE_TEXT`` only.
    """
    raw = _raw_cells(spark, path, table, multi_line)
    data_cols = raw.columns
    wanted = [(c, t) for c, t in RAW_SCHEMAS[table] if c in data_cols]
    extra = [c for c in data_cols if c not in dict(wanted)]
    if infer and extra:
        kinds = {r["column_name"]: KIND_TYPES[r["kind"]] for r in column_kinds(raw.select(*extra)).collect()}
        return raw.select(*[_typed(c, t) for c, t in wanted], *[_typed(c, kinds[c]) for c in extra])
    return raw.select(*[_typed(c, t) for c, t in wanted], *extra)


def raw_path(root: str, split: str, table: str) -> str:
    """Where a table's file (or folder of part files) lies."""
    if table == "generations" and split == "train":
        return f"{root.rstrip('/')}/train_users_generations.csv/train_users_generations.csv"
    folder = "Train Data" if split == "train" else "Test Data"
    return f"{root.rstrip('/')}/{folder}/{split}_{FILES[table]}"


def load_raw_dir(spark: SparkSession, root: str) -> ChurnInputs:
    """The six inputs from the raw CSV layout, both splits in one frame each."""
    out = {}
    for table in FILES:
        parts = []
        for split in ("train", "test"):
            parts.append(read_raw_csv(spark, raw_path(root, split, table), table).withColumn("split", F.lit(split)))
        out[table] = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return ChurnInputs(**out)


def write_raw_dir(inputs: ChurnInputs, root: str) -> None:
    """Write the six inputs in the raw layout (folders of part files), with an
    index column first, nulls as empty cells and quotes doubled."""
    for table in FILES:
        df: DataFrame = getattr(inputs, table)
        columns = [F.col(c).cast("string").alias(c) for c, _ in RAW_SCHEMAS[table]]
        for split in ("train", "test"):
            rows = df.where(F.col("split") == split).select(F.monotonically_increasing_id().alias("index"), *columns)
            rows.write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue="").csv(raw_path(root, split, table))
