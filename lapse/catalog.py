"""Registry of the engine's queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the fixture views, so its
work grows with the data. Doubles are rounded to 6 places in the
registered form only (the library functions return full precision), to
compare with the oracle independent of summation order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.operators.keys import require_unique
from lapse.operators.materialize import land, landing_root
from lapse.operators.rank import with_percent_rank
from lapse.operators.spine import USER_KEY, attach
from lapse.plans import activity as act
from lapse.plans import assemble, bundle, encode, model, quality, report
from lapse.plans import onboarding, payments as pay, properties as props
from lapse.plans import purchases as purch
from lapse.sources import csv as raw_csv
from lapse.sources import sinks
from lapse.sources.fixtures import generations_of, load_inputs
from lapse.sources.tables import read_table
from lapse.streaming import activity as stream
from lapse.streaming.activity import activity_incremental


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    cols = {f.name: F.round(f.name, places) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(cols) if cols else df


Query = Callable[[SparkSession, str], DataFrame]


def _q(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(load_inputs(spark, sf_dir)))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _cards(i) -> DataFrame:
    return pay.card_table(pay.classify_attempts(i.tx, i.purchases))


def _attrib(i) -> DataFrame:
    """Attributed failures through the landed card table, as in the full
    payment features: attempts are read and classified once."""
    return pay.failures_from_cards(_cards(i))


# Activity sub-queries: each computes the slot sums that its features need.
ACTIVITY_GROUPS = {
    "gen_status_counts": ["gen_total", "gen_completed", "gen_failed", "gen_nsfw", "gen_canceled"],
    "gen_credits": ["gen_total_credits", "gen_avg_credits", "gen_video_count", "gen_image_count",
                    "gen_video_ratio", "gen_avg_duration", "gen_avg_hour"],
    "gen_distinct_days_types": ["gen_active_days", "gen_unique_types", "gen_intensity"],
    "gen_first48h": ["gen_day01_count", "credits_day01", "day01_ratio", "day01_credits_ratio", "burst_flag"],
    "gen_weekly": ["gen_week1_count", "credits_week1", "gen_week2_count", "credits_week2", "gen_trend",
                   "credits_trend", "deceleration_flag"],
    "gen_daily_bits": act.DAY_BITS,
    "gen_streak_quit": ["first_quit_day", "max_active_streak", "week1_active_days", "week2_active_days",
                        "is_short_life", "is_one_day_user"],
    "gen_recency": ["days_since_last_gen", "days_since_first_gen"],
}


def _act(cols: list[str]) -> Query:
    return _q(lambda i: act.activity_table(i.generations, i.users, columns=tuple(cols)))


def _countries(i) -> DataFrame:
    return require_unique(i.props, "properties").select(*USER_KEY, "country_code")


def _cat_frame(i) -> DataFrame:
    """Users with the categorical model inputs (country, card, quiz answers)."""
    cards = pay.risk_from_cards(_cards(i)).select(*USER_KEY, "tx_card_brand", "tx_card_funding")
    blocks = [_countries(i), cards, onboarding.quiz_table(i.quizzes)]
    fills = {**pay.payment_fills(), **onboarding.quiz_fills()}
    merged = assemble.merge_features(require_unique(i.users, "users"), blocks)
    keep = ["tx_card_brand", "tx_card_funding", *onboarding.QUIZ_COLUMNS]
    # Landed: the category counts, the dictionaries and the coding read it.
    return land(merged.select(*i.users.columns, "country_code", *[fills[c].alias(c) for c in keep]), "categoricals")


def _country_frame(i) -> DataFrame:
    """(user, split, label, cleaned country), landed: the label indexer, the
    target encoding's branches and the report branches all read it."""
    return land(encode.clean_categoricals(i.users.join(_countries(i), list(USER_KEY), "left")), "country-frame")


def _te(i) -> DataFrame:
    frame = _country_frame(i)
    return encode.target_encoding(encode.label_index(frame), frame.where(F.col("split") != "train"))


def _prior(i) -> DataFrame:
    """Weighted country-prior scores, decided, with the train targets."""
    frame = _country_frame(i)
    lab = encode.label_index(frame)
    te = encode.target_encoding(lab, frame.where(F.col("split") != "train"))
    decided = report.decide(report.prior_scores(te, encode.class_names(frame)))
    # Landed: every report aggregates these scores in several branches.
    return land(decided.join(lab.select(*USER_KEY, "target"), list(USER_KEY), "left"), "prior-scores")


def _prior_train(i) -> DataFrame:
    return _prior(i).where(F.col("split") == "train")


def _prior_test(i) -> DataFrame:
    return _prior(i).where(F.col("split") != "train")


def _submission(i) -> DataFrame:
    """The submission of the test users, written by the CSV sink and read back."""
    path = f"{landing_root(i.users.sparkSession)}/submission-{uuid.uuid4().hex}"
    sinks.write_submission(_prior_test(i), path)
    return i.users.sparkSession.read.option("header", True).schema("user_id long, churn_status string").csv(path)


def _submission_detailed(i) -> DataFrame:
    path = f"{landing_root(i.users.sparkSession)}/submission-detailed-{uuid.uuid4().hex}"
    decided = _prior_test(i)
    sinks.write_submission_detailed(decided, path)
    schema = report.submission_detailed(decided).schema
    return i.users.sparkSession.read.option("header", True).schema(schema).csv(path)


_RAW: dict[tuple[str, str], object] = {}


def _csv(table: str) -> Query:
    """A view written in the raw CSV layout and read back (written once per
    application and input folder)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _RAW:
            root = f"{landing_root(spark)}/raw-csv-{uuid.uuid4().hex}"
            raw_csv.write_raw_dir(load_inputs(spark, sf_dir), root)
            _RAW[key] = raw_csv.load_raw_dir(spark, root)
        return rounded(getattr(_RAW[key], table))

    return run


_PREPARED: dict[tuple[str, str], model.ModelData] = {}
_FITTED: dict[tuple[str, str], tuple[model.Forests, DataFrame, DataFrame]] = {}
_SAVED: dict[tuple[str, str], str] = {}


def forget() -> None:
    """Drop what is kept per process, so that the next query fits anew."""
    for kept in (_RAW, _PREPARED, _FITTED, _SAVED):
        kept.clear()


def _prepared(spark: SparkSession, sf_dir: str) -> model.ModelData:
    """Features, clusters, encodings and folds of these inputs, prepared once
    per process (features and clusters are landed tables)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PREPARED:
        i = load_inputs(spark, sf_dir)
        # The feature table feeds the scaler, k-means, both indexers, the
        # target encoding and the model matrix: land it once.
        feats = land(assemble.user_features(i), "user-features")
        _PREPARED[key] = model.prepare_model_data(feats, i.users)
    return _PREPARED[key]


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[model.Forests, DataFrame, DataFrame]:
    """The fold forests and their scores (landed), fitted once per process."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        data = _prepared(spark, sf_dir)
        forests = model.fit_forests(data.frame, data.folds, data.class_names)
        _FITTED[key] = (forests, *model.score_forests(forests))
    return _FITTED[key]


def _forest_for(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Forest CV outputs (landed tables)."""
    return _fitted(spark, sf_dir)[1:]


def _saved_model(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the saved pipeline, written once per process."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SAVED:
        path = f"{landing_root(spark)}/model-{uuid.uuid4().hex}"
        bundle.save(bundle.bundle(_prepared(spark, sf_dir), _fitted(spark, sf_dir)[0].models), path)
        _SAVED[key] = path
    return _SAVED[key]


def _scored_from_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test users scored by the pipeline as loaded from its folder."""
    loaded = bundle.load(_saved_model(spark, sf_dir))
    features = _prepared(spark, sf_dir).features
    return rounded(bundle.score(loaded, features.where(F.col("split") != "train"), ("user_id",)))


def _saved_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test users whose scores from the saved pipeline are those of the fitted
    forests: all, by class, by probabilities."""
    loaded = _scored_from_saved(spark, sf_dir)
    fitted = _tested(report.submission_detailed)(spark, sf_dir)
    probs = report.prob_columns(fitted)
    both = loaded.join(fitted.select("user_id", *[F.col(c).alias(f"_{c}") for c in (*probs, "predicted_class")]), "user_id", "full_outer")
    near = [F.abs(F.col(c) - F.col(f"_{c}")) < 1e-6 for c in probs]
    return both.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.count_if(F.col("predicted_class") == F.col("_predicted_class")).alias("n_same_class"),
        F.count_if(reduce(lambda a, b: a & b, near)).alias("n_same_probabilities"),
    )


def _encoding_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold quality with encodings fitted on all train users (default)
    and inside the folds, and what the first gains over the second."""
    data = _prepared(spark, sf_dir)
    inside = model.foldwise_oof(data.features, data.folds, data.class_names)
    rows = [
        report.macro_f1(report.decide(scored)).select(F.lit(name).alias("encodings"), "macro_f1", "accuracy", "n_users")
        for name, scored in (("all train users", _forest_for(spark, sf_dir)[0]), ("inside the folds", inside))
    ]
    both = land(rows[0].unionByName(rows[1]), "encoding-report")
    sign = F.when(F.col("encodings") == "inside the folds", -1.0).otherwise(1.0)
    gain = both.agg(*[F.sum(F.col(c) * sign).alias(c) for c in ("macro_f1", "accuracy")], F.max("n_users").alias("n_users"))
    return rounded(both.unionByName(gain.select(F.lit("difference").alias("encodings"), "macro_f1", "accuracy", "n_users")))


def _model(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(_prepared(spark, sf_dir)))

    return run


def _oof(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(report.decide(_forest_for(spark, sf_dir)[0])))

    return run


def _tested(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(report.decide(_forest_for(spark, sf_dir)[1])))

    return run


def _whole(scored: DataFrame) -> list:
    """Checks every scored row must pass, as counts."""
    total = sum((F.col(c) for c in report.prob_columns(scored)), F.lit(0.0))
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.abs(total - 1) < 1e-6).alias("n_sum_to_one"),
        F.count_if(F.col("confidence") == F.greatest(*report.prob_columns(scored))).alias("n_confidence_is_max"),
    ]


def _oof_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every train user scored once, in the fold it was dealt."""
    oof = report.decide(_forest_for(spark, sf_dir)[0])
    folds = _prepared(spark, sf_dir).folds.select(*USER_KEY, F.col("fold").alias("_dealt"))
    joined = oof.join(folds, list(USER_KEY))
    per_user = joined.withColumn("_one", F.lit(1)).groupBy(*USER_KEY).agg(
        *[F.sum("_one").alias("_n"), *[F.first(c).alias(c) for c in ("fold", "_dealt", "confidence", *report.prob_columns(oof))]]
    )
    once = F.count_if((F.col("fold") == F.col("_dealt")) & (F.col("_n") == 1)).alias("n_once_in_fold")
    return per_user.agg(*_whole(oof), once)


def _cluster_coverage(data: model.ModelData) -> DataFrame:
    """Every user has one cluster id, below the number of clusters."""
    c = data.clusters
    return c.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if((F.col("cluster_id") >= 0) & (F.col("cluster_id") < model.MAX_CLUSTERS)).alias("n_valid"),
    )


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    data = _prepared(spark, sf_dir)
    landed = assemble.land_inputs(i)
    stages = assemble.build_tables(landed, purch.purchase_types(landed["purchase-types"]))
    return quality.stage_shapes({**stages, "features": data.features, "encoded": data.frame})


def _three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity features after the events arrived in three parts, the state
    compacted after each, with the last batch replayed."""
    i = load_inputs(spark, sf_dir)
    events = read_table(spark, sf_dir, "events")
    state = stream.new_state(spark)
    arrivals = f"{state}-arrivals"
    for part in range(3):
        new = events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part)
        new.write.mode("append").parquet(arrivals)
        version = stream.advance(spark, arrivals, events.schema, state, view=generations_of)
    stream.land_batch(generations_of(new), version.last_batch, state)
    stream.compact(spark, state)
    table = act.activity_from_slots(stream.merged_slots(spark, state), i.users)
    return rounded(attach(i.users.select(*USER_KEY), table))


def _csv_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{landing_root(spark)}/raw-csv-{uuid.uuid4().hex}"
    raw_csv.write_raw_dir(load_inputs(spark, sf_dir), root)
    return raw_csv.csv_types(spark, root)


def _amount_ranks(i) -> DataFrame:
    """Percent ranks within the split of a number and of a number that a large
    part of the rows share."""
    value = i.purchases.select(*USER_KEY, "transaction_id", "purchase_amount_dollars")
    # A third of the amounts become one.
    first = F.conv(F.substring(F.md5(F.col("transaction_id").cast("string")), 1, 6), 16, 10).cast("long")
    hot = F.when(first % 3 == 0, F.lit(1.0)).otherwise(F.floor("purchase_amount_dollars").cast("double"))
    rows = land(value.withColumn("common_amount", hot), "amounts")
    ranked = with_percent_rank(rows, "purchase_amount_dollars", ["split"], out="amount_rank")
    ranked = with_percent_rank(ranked, "common_amount", ["split"], out="common_rank")
    return ranked.select(*USER_KEY, "transaction_id", "amount_rank", "common_rank")


def _activity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity features through the incremental (streaming) path."""
    i = load_inputs(spark, sf_dir)
    events = read_table(spark, sf_dir, "events")
    table = activity_incremental(spark, f"{sf_dir.rstrip('/')}/events.parquet", i.users, events.schema, view=generations_of)
    return rounded(attach(i.users.select(*USER_KEY), table))


QUERIES: dict[str, Query] = {
    "purchase_summary": _q(lambda i: purch.purchase_summary(i.purchases)),
    "purchase_type_counts": _q(lambda i: purch.purchase_type_counts(i.purchases)),
    "purchase_span": _q(lambda i: purch.purchase_span(i.purchases)),
    "purchases_features": _q(lambda i: purch.purchase_features(i.purchases, i.users)),
    "country_frequency": _q(lambda i: props.country_frequency(i.props)),
    "subscription_calendar": _q(lambda i: props.subscription_calendar(i.props)),
    "subscription_date_rank": _q(lambda i: props.subscription_date_rank(i.props)),
    "properties_features": _q(lambda i: props.properties_features(i.props)),
    "quiz_features": _q(lambda i: onboarding.quiz_features(i.quizzes, i.users)),
    "tx_success": _q(lambda i: pay.tx_success(i.tx, i.purchases)),
    "tx_failed": _q(lambda i: pay.tx_failed(i.tx, i.purchases)),
    "card_risk": _q(lambda i: pay.card_risk(pay.tx_success(i.tx, i.purchases))),
    "country_mismatch": _q(lambda i: pay.country_mismatch(pay.tx_success(i.tx, i.purchases))),
    "card_mode": _q(lambda i: pay.card_mode(pay.tx_success(i.tx, i.purchases))),
    "fingerprint_users": _q(lambda i: pay.fingerprint_user_counts(pay.tx_success(i.tx, i.purchases))),
    "failure_attribution": _q(
        lambda i: _attrib(i).select(*USER_KEY, "tx_fail_count_weighted", "tx_fail_count_raw")
    ),
    "failure_by_code": _q(lambda i: _attrib(i).select(*USER_KEY, *[f"fail_{c}" for c in pay.FAILURE_CODES])),
    "payments_features": _q(lambda i: pay.payment_features(i.tx, i.purchases, i.users)),
    **{name: _act(cols) for name, cols in ACTIVITY_GROUPS.items()},
    "activity_features": _q(lambda i: act.activity_features(i.generations, i.users)),
    "activity_features_incremental": _activity_stream,
    "activity_three_batches": _three_batches,
    "gen_streaks_calendar": _q(lambda i: act.streaks_calendar(i.generations, i.users)),
    "stage_report": _q(quality.stage_report),
    "load_report": _q(quality.load_report),
    "amount_ranks": _q(_amount_ranks),
    "csv_types": _csv_types,
    "align_splits": _q(lambda i: purch.purchase_types_by_split(i.purchases)),
    "user_features": _q(assemble.user_features),
    "interactions": _q(
        lambda i: assemble.add_interactions(assemble.merged_features(i)).select(
            *USER_KEY, *assemble.INTERACTIONS
        )
    ),
    "label_index": _q(lambda i: encode.label_index(i.users).select(*USER_KEY, "churn_status", "target")),
    "category_codes": _q(
        lambda i: encode.category_codes(_cat_frame(i)).select(*USER_KEY, *encode.CAT_FEATURES)
    ),
    "target_encoding": _q(_te),
    "stratified_folds": _q(lambda i: encode.stratified_folds(encode.label_index(i.users))),
    "class_balance": _q(lambda i: encode.class_balance(encode.label_index(i.users))),
    "confusion_matrix": _q(lambda i: report.confusion_matrix(_prior_train(i))),
    "classification_report": _q(lambda i: report.classification_report(_prior_train(i))),
    "macro_f1": _q(lambda i: report.macro_f1(_prior_train(i))),
    "prediction_distribution": _q(lambda i: report.prediction_distribution(_prior_test(i))),
    "mean_probabilities": _q(lambda i: report.mean_probabilities(_prior_test(i))),
    "churn_share": _q(lambda i: report.churn_share(_prior_test(i))),
    "top_confident_users": _q(lambda i: report.top_confident(_prior_test(i))),
    "top_users_display": _q(lambda i: report.display_top(report.top_confident(_prior_test(i)))),
    "submission": _q(_submission),
    "submission_detailed": _q(_submission_detailed),
    **{f"csv_{table}": _csv(table) for table in raw_csv.FILES},
    "stage_shapes": _shapes,
    "feature_preview": _model(lambda d: model.feature_preview(d.frame)),
    "scaled_features": _model(lambda d: model.scaled_features(d.features)),
    "class_weights": _model(lambda d: model.class_weights(encode.label_index(d.features))),
    "cluster_sizes": _model(lambda d: model.cluster_sizes(d.features, d.clusters)),
    "cluster_coverage": _model(_cluster_coverage),
    "oof_predictions": _oof(lambda d: d),
    "oof_coverage": _oof_coverage,
    "forest_confusion": _oof(report.confusion_matrix),
    "forest_macro_f1": _oof(report.macro_f1),
    "test_predictions": _tested(report.submission_detailed),
    "scored_from_saved": _scored_from_saved,
    "saved_agreement": _saved_agreement,
    "encoding_report": _encoding_report,
    "test_coverage": _tested(lambda d: d.agg(*_whole(d))),
    "forest_distribution": _tested(report.prediction_distribution),
    "clip_log": _q(
        lambda i: assemble.user_features(i).select(
            *USER_KEY, *assemble.CLIP_RULES, *[f"{c}_log" for c in assemble.LOG_COLUMNS]
        )
    ),
}
