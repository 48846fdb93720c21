"""Model inputs: label codes, category codes, out-of-fold target encoding of
the country, stratified CV folds and the class balance they depend on.

All encodings are fitted on the train split only and applied to both.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.operators.materialize import join_small, land
from lapse.operators.positions import row_positions
from lapse.operators.rank import value_positions
from lapse.operators.spine import USER_KEY

# Engine defaults and the categorical columns it encodes.
SEED = 42
MAX_FOLDS = 3
MAX_TE_FOLDS = 5
MISSING = "missing"
CAT_FEATURES = (
    "country_code", "tx_card_brand", "tx_card_funding", "quiz_source", "quiz_experience",
    "quiz_frustration", "quiz_first_feature", "quiz_role", "quiz_usage_plan",
)
# Most classes a label may have: each gets its own columns.
MAX_CLASSES = 100
# Values of a column that an indexer may hold; more are coded by a join.
MAX_CATEGORIES = 100_000
DROPPED = ("subscription_plan",)
NON_FEATURES = ("user_id", "churn_status", "target", "split")


def clean_categoricals(df: DataFrame, cols: tuple[str, ...] = CAT_FEATURES) -> DataFrame:
    """Categoricals as text, null -> 'missing'."""
    present = set(df.columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in cols if c in present})


def class_names(features: DataFrame, label: str = "churn_status") -> tuple[str, ...]:
    """The labels that occur in train, in code (alphabetical) order."""
    found = features.where((F.col("split") == "train") & F.col(label).isNotNull()).select(label).distinct()
    names = tuple(sorted(r[0] for r in found.limit(MAX_CLASSES + 1).collect()))
    if len(names) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return names


def label_index(features: DataFrame, label: str = "churn_status") -> DataFrame:
    """Train users with ``target`` = code of the label in alphabetical order.

    The indexer's fit reads the distinct labels (one per class).
    """
    train = features.where(F.col("split") == "train")
    model = StringIndexer(inputCol=label, outputCol="_t", stringOrderType="alphabetAsc").fit(train)
    return model.transform(train).withColumn("target", F.col("_t").cast("int")).drop("_t")


def fit_categories(cleaned: DataFrame, cols: tuple[str, ...] = CAT_FEATURES) -> StringIndexerModel:
    """An indexer over the sorted train values of each categorical."""
    present = set(cleaned.columns)
    cols = [c for c in cols if c in present]
    indexer = StringIndexer(inputCols=cols, outputCols=[f"_code_{c}" for c in cols], stringOrderType="alphabetAsc", handleInvalid="keep")
    return indexer.fit(cleaned.where(F.col("split") == "train"))


def category_sizes(cleaned: DataFrame, cols: list[str]) -> dict[str, int]:
    """The exact number of train values of each categorical, one column after
    the other counted from its distinct values (no row is expanded)."""
    train = cleaned.where(F.col("split") == "train")
    return {c: train.select(c).distinct().count() for c in cols}


def category_codes(features: DataFrame, cols: tuple[str, ...] = CAT_FEATURES) -> DataFrame:
    """Replace each categorical by its code among the sorted train values.

    A value never seen in train gets code 0. Columns of up to
    ``MAX_CATEGORIES`` train values share an indexer, whose dictionaries the
    driver holds; any other (free text, say) gets its codes from a table of the
    values' positions in order, joined.
    """
    df = clean_categoricals(features, cols)
    present = set(df.columns)
    cols = tuple(c for c in cols if c in present)
    # An estimate settles which columns are far from the bound; the others are counted.
    train = df.where(F.col("split") == "train")
    about = train.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    unsure = [c for c in cols if about[c] * 2 > MAX_CATEGORIES]
    counted = category_sizes(df, unsure)
    wide = [c for c in unsure if counted[c] > MAX_CATEGORIES]
    narrow = tuple(c for c in cols if c not in wide)
    if narrow:
        model = fit_categories(df, narrow)
        df = model.transform(df)
        codes = {c: F.when(F.col(f"_code_{c}") >= len(x), F.lit(0)).otherwise(F.col(f"_code_{c}").cast("int")) for c, x in zip(narrow, model.labelsArray)}
        df = df.withColumns(codes).drop(*[f"_code_{c}" for c in narrow])
    order = df.columns
    for c in wide:
        table = value_positions(train.select(c), c, out="_position")
        df = df.join(table, c, "left").withColumn(c, F.coalesce("_position", F.lit(0))).drop("_position")
    return df.select(*order)


def encoding_folds(labelled: DataFrame, seed: int, n_folds: int) -> DataFrame:
    """``labelled`` with ``_fold``, landed: dealt round-robin in md5 order."""
    placed = row_positions(labelled, "user_id", seed, out="_pos")
    return land(placed.withColumn("_fold", ((F.col("_pos") - 1) % n_folds).cast("int")).drop("_pos"), "encoding-folds")


def encoding_shares(labelled: DataFrame, col: str) -> tuple[DataFrame, list[float]]:
    """(col, <col>_te_cls<k>...): class shares per category over all train
    rows, and the overall shares."""
    sizes = {r["target"]: r["n"] for r in labelled.groupBy("target").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_classes, n_train = max(sizes, default=-1) + 1, sum(sizes.values())
    shares = [F.try_divide(F.sum((F.col("target") == k).cast("double")), F.count(F.lit(1))).alias(f"{col}_te_cls{k}") for k in range(n_classes)]
    return labelled.groupBy(col).agg(*shares), [sizes.get(k, 0) / max(1, n_train) for k in range(n_classes)]


def target_encoding(
    labelled: DataFrame,
    test: DataFrame,
    col: str = "country_code",
    seed: int = SEED,
    max_folds: int = MAX_TE_FOLDS,
) -> DataFrame:
    """Out-of-fold class shares per category (``<col>_te_cls<k>``) for train
    rows, and full-train shares for test rows; fallback = the global share.

    Train rows are dealt into K = max(2, min(5, n_train)) folds in md5 order of
    the user id, so folds differ by one row at most. For a row in fold f the share is computed over train rows
    of the same category outside fold f, by subtracting the (category, f)
    totals from the category totals -- one aggregation for all folds. The
    totals tables have one row per (category, fold).
    """
    # Class sizes of the train set (one small job): classes, folds, fallback.
    sizes = {r["target"]: r["n"] for r in labelled.groupBy("target").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_classes, n_train = max(sizes, default=-1) + 1, sum(sizes.values())
    ys = [(F.col("target") == k).cast("double") for k in range(n_classes)]
    n_folds = max(2, min(max_folds, n_train))
    overall = [F.lit(sizes.get(k, 0) / max(1, n_train)) for k in range(n_classes)]
    tr = encoding_folds(labelled.select(*USER_KEY, col, "target"), seed, n_folds)
    cf = tr.groupBy(col, "_fold").agg(F.count(F.lit(1)).alias("_n_cf"), *[F.sum(y).alias(f"_s_cf{k}") for k, y in enumerate(ys)])
    by_c = Window.partitionBy(col)
    everything = Window.partitionBy()
    # cf is one row per (category, fold): windows over it stay small, and once
    # landed and counted it is broadcast while small.
    cf = cf.select(
        col, "_fold", "_n_cf", *[f"_s_cf{k}" for k in range(n_classes)],
        F.sum("_n_cf").over(by_c).alias("_n_c"),
        *[F.sum(f"_s_cf{k}").over(by_c).alias(f"_s_c{k}") for k in range(n_classes)],
    )
    cf = land(cf, "encoding-totals")
    # Fold and category totals roll up from the (category, fold) table, so the
    # train rows are read once for it and once for the final lookup.
    folds = cf.groupBy("_fold").agg(
        F.sum("_n_cf").alias("_n_f"), *[F.sum(f"_s_cf{k}").alias(f"_s_f{k}") for k in range(n_classes)]
    )
    folds = folds.select(
        "_fold", "_n_f", *[f"_s_f{k}" for k in range(n_classes)],
        F.sum("_n_f").over(everything).alias("_n_all"),
        *[F.sum(f"_s_f{k}").over(everything).alias(f"_s_all{k}") for k in range(n_classes)],
    )
    out_fold = F.col("_n_c") - F.col("_n_cf")
    # Rows whose category lies in one fold only fall back to the other folds'
    # share, and to the overall share if all rows lie in one fold.
    train_enc = join_small(tr, cf, [col, "_fold"]).join(F.broadcast(folds), "_fold", "left").select(
        *USER_KEY, col,
        *[
            F.coalesce(
                F.try_divide(F.col(f"_s_c{k}") - F.col(f"_s_cf{k}"), out_fold),
                F.try_divide(F.col(f"_s_all{k}") - F.col(f"_s_f{k}"), F.col("_n_all") - F.col("_n_f")),
                overall[k],
            ).alias(f"{col}_te_cls{k}")
            for k in range(n_classes)
        ],
    )
    full = cf.groupBy(col).agg(F.sum("_n_cf").alias("_n"), *[F.sum(f"_s_cf{k}").alias(f"_s{k}") for k in range(n_classes)])
    test_enc = join_small(test.select(*USER_KEY, col), land(full, "encoding-full"), col).select(
        *USER_KEY, col,
        *[F.coalesce(F.try_divide(F.col(f"_s{k}"), F.col("_n")), overall[k]).alias(f"{col}_te_cls{k}") for k in range(n_classes)],
    )
    return train_enc.unionByName(test_enc)


def class_balance(labelled: DataFrame, max_folds: int = MAX_FOLDS) -> DataFrame:
    """Users per class, their share, and n_folds = min(max_folds, smallest class).

    Fewer than 2 users in some class fails the job (no CV possible).
    """
    counts = labelled.groupBy("churn_status", "target").agg(F.count(F.lit(1)).alias("n_users"))
    everything = Window.partitionBy()
    n_folds = F.least(F.lit(max_folds), F.min("n_users").over(everything)).cast("int")
    return counts.select(
        "churn_status", "target", "n_users",
        (F.col("n_users") / F.sum("n_users").over(everything)).alias("share"),
        F.when(n_folds < 2, F.raise_error(F.lit("need at least 2 users in every class for CV"))).otherwise(n_folds).alias("n_folds"),
    )


def stratified_folds(labelled: DataFrame, seed: int = SEED, max_folds: int = MAX_FOLDS) -> DataFrame:
    """Train users with ``fold`` in [0, n_folds): inside each class, users in
    md5-key order are dealt round-robin, so per class fold sizes differ by at
    most one."""
    k = n_folds_of(labelled, max_folds)
    pos = row_positions(labelled.select(*USER_KEY, "target"), "user_id", seed, by=["target"], out="_pos")
    return pos.select(*USER_KEY, "target", ((F.col("_pos") - 1) % k).cast("int").alias("fold"))


def n_folds_of(labelled: DataFrame, max_folds: int = MAX_FOLDS) -> int:
    """min(max_folds, smallest class) -- one small job; fails below 2."""
    return int(class_balance(labelled, max_folds).agg(F.min("n_folds")).first()[0])


def model_frame(features: DataFrame, clusters: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """Encoded model table for both splits: category codes, target encoding,
    ``target`` for train users (null for test), plan column dropped."""
    coded = category_codes(features).drop(*DROPPED)
    key = list(USER_KEY)
    if clusters is not None:
        coded = coded.join(clusters, key, "left")
    cleaned = clean_categoricals(features.select(*key, "churn_status", "country_code"))
    labelled = label_index(cleaned)
    te = target_encoding(labelled, cleaned.where(F.col("split") != "train"), seed=seed).drop("country_code")
    return coded.join(labelled.select(*key, "target"), key, "left").join(te, key, "left")
