"""Hand-made cases the fixture views do not contain (FIXTURES.md), and
brute-force checks of the custom operators on small random inputs."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lapse.functions.time import day_number
from lapse.operators.positions import row_positions
from lapse.operators.rank import value_positions, with_percent_rank
from lapse.operators.sequence import bits_array, first_quit_day, longest_run
from lapse.plans import activity, encode, onboarding, payments, purchases

USERS = "user_id bigint, churn_status string, split string"
PURCH = "split string, transaction_id bigint, user_id bigint, purchase_amount_dollars double, purchase_type string, purchase_time string"
TX = (
    "transaction_id bigint, split string, card_brand string, card_country string, card_funding string, "
    "bank_name string, billing_address_country string, is_prepaid boolean, is_virtual boolean, "
    "is_business boolean, is_3d_secure boolean, digital_wallet string, cvc_check string, "
    "amount_in_usd double, failure_code string"
)
GEN = (
    "split string, generation_id bigint, user_id bigint, created_at string, status string, generation_type string, "
    "credit_cost string, duration string"
)
QUIZ = (
    "split string, user_id bigint, source string, team_size string, experience string, usage_plan string, "
    "frustration string, first_feature string, role string"
)


def users(spark, rows=None):
    rows = rows or [(1, "not_churned", "train"), (2, "vol_churn", "train"), (3, "invol_churn", "train")]
    return spark.createDataFrame(rows, USERS)


def tx_row(tid, split="train", brand="visa", country="US", funding="credit", code=None, wallet=None, cvc="pass"):
    return (tid, split, brand, country, funding, "B", country, False, False, False, False, wallet, cvc, 10.0, code)


def test_null_keys_never_match(spark):
    p = spark.createDataFrame(
        [("train", None, 1, 5.0, "Credits Package", "2024-01-01 10:00:00"), ("train", 10, None, 7.0, "Credits Package", "2024-01-01 10:00:00")],
        PURCH,
    )
    t = spark.createDataFrame([tx_row(None), tx_row(10)], TX)
    att = {r.transaction_id: r for r in payments.classify_attempts(t, p).collect()}
    # The null id never matches; tx 10 was paid, though by nobody known.
    assert not att[None].is_success and att[10].is_success and att[10].user_id is None
    assert all(r.tx_success_count == 0 for r in payments.payment_features(t, p, users(spark)).collect())
    feats = purchases.purchase_features(p, users(spark)).where("user_id = 1").first()
    assert feats.total_purchases == 0 and feats.has_purchases == 1 and feats.total_spend == 5.0


def test_mode_all_null_and_tie(spark):
    p = spark.createDataFrame(
        [("train", t, 1 if t < 5 else 2, 1.0, "Credits Package", "2024-01-01 10:00:00") for t in range(1, 9)], PURCH
    )
    brands = {1: "b", 2: "a", 3: "a", 4: "b", 5: None, 6: None, 7: None, 8: None}
    t = spark.createDataFrame([tx_row(k, brand=v) for k, v in brands.items()], TX)
    out = {r.user_id: r.tx_card_brand for r in payments.payment_features(t, p, users(spark)).collect()}
    assert out == {1: "a", 2: "unknown", 3: "unknown"}


def test_day_number_wraps_at_new_year(spark):
    df = spark.createDataFrame([("2023-12-31 23:00:00",), ("2024-01-01 01:00:00",), ("garbage",)], "s string")
    r = df.select(day_number("s").alias("d"), day_number("s", calendar=True).alias("c")).collect()
    assert r[0].d == pytest.approx(12 * 31 + 31 + 23 / 24) and r[1].d == pytest.approx(31 + 1 + 1 / 24)
    assert r[1].d < r[0].d  # parity: the year is ignored
    assert r[1].c - r[0].c == pytest.approx(2 / 24)  # calendar mode: true elapsed days
    assert r[2].d is None and r[2].c is None


def test_unparseable_event_time_is_counted_not_fatal(spark):
    g = spark.createDataFrame(
        [("train", 1, 1, "2024-01-01 10:00:00", "completed", "video", "3", None), ("train", 2, 1, "garbage", "failed", None, "n/a", "x")],
        GEN,
    )
    r = activity.activity_features(g, users(spark)).where("user_id = 1").first()
    assert r.gen_total == 2 and r.gen_failed == 1 and r.gen_total_credits == 3.0
    assert r.gen_week1_count == 1 and r.gen_active_days == 2 and r.active_day_0 == 1


def test_no_payments_at_all_gives_fixed_schema_of_zeros(spark):
    p = spark.createDataFrame([], PURCH)
    t = spark.createDataFrame([], TX)
    out = payments.payment_features(t, p, users(spark))
    assert out.columns == ["split", "user_id", *payments.PAYMENT_COLUMNS]
    rows = out.collect()
    assert len(rows) == 3 and all(r.tx_success_count == 0 and r.tx_failure_rate == 0 for r in rows)
    assert all(r.tx_card_brand == "unknown" for r in rows)


def test_unseen_category_gets_code_zero_and_te_falls_back(spark):
    rows = [(1, "not_churned", "train", "DE"), (2, "vol_churn", "train", "AT"), (3, "invol_churn", "train", "DE"),
            (4, "not_churned", "train", "AT"), (5, "vol_churn", "test", "XX")]
    df = spark.createDataFrame(rows, USERS + ", country_code string")
    coded = {r.user_id: r.country_code for r in encode.category_codes(df, ("country_code",)).collect()}
    assert coded == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0}
    lab = encode.label_index(df)
    te = {r.user_id: r for r in encode.target_encoding(lab, df.where("split = 'test'")).collect()}
    # unseen test country -> global train share of each class
    assert te[5].country_code_te_cls1 == pytest.approx(0.5) and te[5].country_code_te_cls0 == pytest.approx(0.25)
    assert sum(te[1][f"country_code_te_cls{k}"] for k in range(3)) == pytest.approx(1.0)


def test_single_user_class_fails_fold_guard(spark):
    lab = encode.label_index(users(spark))
    with pytest.raises(Exception, match="at least 2 users"):
        encode.class_balance(lab).collect()


def test_duplicate_quiz_row_fails(spark):
    q = spark.createDataFrame([("train", 1, "a", "3", None, "x", None, None, None), ("train", 1, "b", "4", None, "x", None, None, None)], QUIZ)
    with pytest.raises(Exception, match="duplicate user_id in quizzes"):
        onboarding.quiz_features(q, users(spark)).collect()


def test_purchase_types_come_from_the_data(spark):
    p = spark.createDataFrame(
        [("train", 1, 1, 5.0, "Gift Card", "2024-01-01 10:00:00"), ("test", 2, 1, 7.0, "Top Up", None), ("test", 3, 1, 7.0, None, None)], PURCH
    )
    r = purchases.purchase_features(p, users(spark)).where("user_id = 1").first()
    assert (r.total_purchases, r.ptype_gift_card, r.ptype_top_up, r.n_purchase_types) == (1, 1, 0, 1)
    aligned = {r.split: r for r in purchases.purchase_types_by_split(p).collect()}
    assert (aligned["train"].ptype_gift_card, aligned["train"].ptype_top_up) == (1, 0)
    assert (aligned["test"].ptype_gift_card, aligned["test"].ptype_top_up) == (0, 1)
    many = spark.createDataFrame([("train", k, 1, 1.0, f"type {k}", None) for k in range(250)], PURCH)
    r = purchases.purchase_features(many, users(spark)).where("user_id = 1").first()
    assert r.n_purchase_types == 250 and all(r[f"ptype_type_{k}"] == 1 for k in range(250))


def test_an_id_in_both_splits_names_two_users(spark):
    u = users(spark, [(1, "not_churned", "train"), (1, "vol_churn", "test")])
    p = spark.createDataFrame([("train", 10, 1, 5.0, "Credits Package", "2024-01-01 10:00:00")], PURCH)
    t = spark.createDataFrame([tx_row(10), tx_row(10, split="test", code="card_declined")], TX)
    g = spark.createDataFrame([("test", 1, 1, "2024-01-01 10:00:00", "completed", "video", "3", None)], GEN)
    bought = {r.split: r.total_purchases for r in purchases.purchase_features(p, u).collect()}
    assert bought == {"train": 1, "test": 0}
    paid = {r.split: (r.tx_success_count, r.tx_fail_count_raw) for r in payments.payment_features(t, p, u).collect()}
    assert paid == {"train": (1, 0), "test": (0, 0)}
    made = {r.split: r.gen_total for r in activity.activity_features(g, u).collect()}
    assert made == {"train": 0, "test": 1}


def test_success_of_an_unknown_buyer_is_no_failure(spark):
    p = spark.createDataFrame(
        [("train", 10, 1, 5.0, "Credits Package", None), ("train", 11, 999, 5.0, "Credits Package", None)], PURCH
    )
    t = spark.createDataFrame([tx_row(10), tx_row(11), tx_row(12, code="card_declined")], TX)
    r = payments.payment_features(t, p, users(spark)).where("user_id = 1").first()
    # The failed attempt is shared between user 1 and the unknown buyer.
    assert (r.tx_success_count, r.tx_fail_count_raw, r.tx_fail_count_weighted) == (1, 1, 0.5)


def test_text_that_is_no_number(spark):
    from lapse.functions.numeric import to_number

    texts = ["1.5", " 2 ", "nan", "NaN", "1d", "2.5F", "inf", "-Infinity", "1e3", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(to_number("t")).collect()]
    assert got == [1.5, 2.0, None, None, None, None, float("inf"), float("-inf"), 1000.0, None, None, None]
    g = spark.createDataFrame([("train", 1, 1, "2024-01-01 10:00:00", "completed", "video", "nan", "1d"),
                               ("train", 2, 1, "2024-01-01 11:00:00", "completed", "video", "3", "nan")], GEN)
    r = activity.activity_features(g, users(spark)).where("user_id = 1").first()
    assert r.gen_total_credits == 3.0 and r.gen_avg_duration == 0.0


def test_fixed_layout_and_patterns_cut_the_same_parts(spark):
    from lapse.functions.time import date_text, datetime_parts, hour_of

    texts = ["2024-01-31 23:59:58", "2024-01-31 23:59:58.123", "2024-1-5 3:04:05", "2024-01-05T10:00:00", "2024-01-05", " 2024-01-05 10:00:00",
             "x2024-01-05 10:11", "2024-01-05 10:11", "12024-01-05 10:11:12", "2024-01-05  10:11:12", "2024- 1-05 10:11:12", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    import re

    for r in df.select("t", day_number("t").alias("d"), hour_of("t").alias("h"), date_text("t").alias("day"), datetime_parts("t")["second"].alias("s")).collect():
        t = r.t or ""
        m = re.search(r"(\d+)-(\d+)-(\d+)\s+(\d+):(\d+)", t)
        assert r.d == (None if not m else int(m[2]) * 31 + int(m[3]) + int(m[4]) / 24.0), t
        assert r.h == (None if not m else float(m[4])), t
        m = re.search(r"(\d+-\d+-\d+)", t)
        assert r.day == (m[1] if m else None), t
        m = re.search(r"(\d+)-(\d+)-(\d+)\s+(\d+):(\d+):(\d+)", t)
        assert r.s == (float(m[6]) if m else None), t


def test_duplicate_user_fails(spark):
    from lapse.operators.keys import require_unique

    u = users(spark, [(1, "not_churned", "train"), (1, "not_churned", "train")])
    with pytest.raises(Exception, match="duplicate user_id in users"):
        require_unique(u, "users").collect()


@pytest.mark.parametrize("names", [("not_churned", "vol_churn"), ("a", "b", "not_churned", "z")])
def test_any_number_of_classes(spark, names):
    from lapse.plans import report

    rows = [(i, names[i % len(names)], "train" if i < 40 else "test", "ABC"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, USERS + ", country_code string")
    assert encode.class_names(df) == names
    lab = encode.label_index(df)
    te = encode.target_encoding(lab, df.where("split = 'test'"))
    decided = report.decide(report.prior_scores(te, names))
    assert report.prob_columns(decided) == tuple(f"prob_{n}" for n in names)
    for r in decided.collect():
        assert r.predicted_class == names[r.prediction]
        assert sum(r[f"prob_{n}"] for n in names) == pytest.approx(1.0)


def test_target_encoding_with_all_rows_in_one_fold_or_none(spark):
    one = spark.createDataFrame([(1, "a", "train", "DE"), (2, "b", "test", "DE")], USERS + ", country_code string")
    lab = encode.label_index(one)
    rows = encode.target_encoding(lab, one.where("split = 'test'")).collect()
    assert len(rows) == 2 and all(r.country_code_te_cls0 == 1.0 for r in rows)
    none = lab.where("false")
    assert [r.user_id for r in encode.target_encoding(none, one.where("split = 'test'")).collect()] == [2]


@pytest.mark.parametrize("kind", ["text", "number", "hot"])
def test_rank_of_any_ordered_column(spark, kind):
    rnd = random.Random(9)
    draw = {
        "text": lambda: f"2024-0{rnd.randint(1, 3)}-1{rnd.randint(0, 9)} 1{rnd.randint(0, 9)}:{rnd.randint(10, 59)}",
        "number": lambda: rnd.choice([rnd.uniform(-50, 50), float(rnd.randint(-9, 9))]),
        "hot": lambda: 7 if rnd.random() < 0.4 else rnd.randint(-100, 100),
    }[kind]
    df = spark.createDataFrame([(i, i % 3, draw()) for i in range(400)], ["id", "g", "v"])
    pdf = df.toPandas().set_index("id")
    for ranges in (None, 1, 7, 50):
        got = {r.id: r.r for r in with_percent_rank(df, "v", out="r", ranges=ranges).collect()}
        assert got == pytest.approx(pdf["v"].rank(pct=True).to_dict())
    got = {r.id: r.r for r in with_percent_rank(df, "v", ["g"], out="r", ranges=5).collect()}
    assert got == pytest.approx(pdf.groupby("g")["v"].rank(pct=True).to_dict())
    positions = {r.v: r.position for r in value_positions(df, "v", ranges=9).collect()}
    assert positions == {v: n for n, v in enumerate(sorted(set(pdf["v"])))}


def test_category_codes_beyond_the_dictionary_bound(spark, monkeypatch):
    rows = [("train", i, f"c{i % 50:02}", "x") for i in range(200)] + [("test", 1, "c07", "x"), ("test", 2, "new", None)]
    df = spark.createDataFrame(rows, "split string, user_id long, country_code string, quiz_role string")
    cols = ("country_code", "quiz_role")
    expected = sorted(map(tuple, encode.category_codes(df, cols).select("split", "user_id", *cols).collect()))
    for limit in (10, 0):
        monkeypatch.setattr(encode, "MAX_CATEGORIES", limit)
        got = encode.category_codes(df, cols)
        assert sorted(map(tuple, got.select("split", "user_id", *cols).collect())) == expected
        assert [f.dataType.simpleString() for f in got.schema if f.name in cols] == ["int", "int"]


def test_target_encoding_folds_differ_by_one_row_at_most(spark):
    df = spark.createDataFrame([("train", i, i % 3) for i in range(523)], "split string, user_id long, target int")
    sizes = [r["count"] for r in encode.encoding_folds(df, 42, 5).groupBy("_fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    from lapse.sources.csv import read_raw_csv

    path = tmp_path / "train_users_quizzes.csv"
    path.write_text(',user_id,source,team_size,experience,usage_plan,frustration,first_feature,role\n'
                    '0,u1,"He said ""hi"", ok",3,,,"two\nlines",,\n1,u2,ads,1d,,,,,\n')
    rows = {r.user_id: r for r in read_raw_csv(spark, str(path), "quizzes").collect()}
    assert set(rows) == {"u1", "u2"}
    assert rows["u1"].source == 'He said "hi", ok' and rows["u1"].team_size == "3" and rows["u1"].frustration == "two\nlines"


def test_private_folders_are_refused_on_a_cluster(spark, monkeypatch):
    from lapse import session

    monkeypatch.setattr(session, "_is_local", lambda spark: False)
    for folder in ("file:/tmp/x", "/tmp/x", "file:///var/tmp/x"):
        with pytest.raises(RuntimeError, match="local to each machine"):
            session._checked(spark, folder)
    for folder in ("hdfs:///tmp/x", "file:///mnt/shared/x", "s3a://b/x"):
        assert session._checked(spark, folder) == folder


def test_percent_rank_matches_pandas(spark):
    rnd = random.Random(7)
    vals = [rnd.choice([None, *[f"2024-0{rnd.randint(1, 3)}-1{rnd.randint(0, 2)} 0{rnd.randint(0, 3)}" for _ in range(3)]])
            for _ in range(300)]
    pdf = pd.DataFrame({"id": range(300), "g": [i % 2 for i in range(300)], "v": vals})
    expect = pdf.groupby("g")["v"].rank(pct=True)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None))
    got = with_percent_rank(df, "v", ["g"], out="r").toPandas().set_index("id").sort_index()["r"]
    for i in range(300):
        if pd.isna(expect[i]):
            assert pd.isna(got[i])
        else:
            assert got[i] == pytest.approx(expect[i])


def test_row_positions_give_balanced_folds(spark):
    df = spark.createDataFrame([(i, i % 3 if i % 5 else 0) for i in range(1, 400)], "user_id long, target int")
    pos = row_positions(df, "user_id", 42, by=["target"], out="p").toPandas()
    for _, g in pos.groupby("target"):
        assert sorted(g.p) == list(range(1, len(g) + 1))
        sizes = ((g.p - 1) % 3).value_counts()
        assert sizes.max() - sizes.min() <= 1


def _quit(bits):
    first = bits.index(1) if 1 in bits else 0
    rest = bits[first:]
    return first + rest.index(0) if 0 in rest else len(bits)


def _streak(bits):
    best = cur = 0
    for b in bits:
        cur = cur + 1 if b else 0
        best = max(best, cur)
    return best


def test_sequence_features_match_brute_force(spark):
    rnd = random.Random(3)
    rows = [tuple(rnd.randint(0, 1) for _ in range(14)) for _ in range(200)] + [(0,) * 14, (1,) * 14]
    cols = [f"b{i}" for i in range(14)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in cols))
    bits = bits_array(cols)
    got = df.select(first_quit_day(bits, 14).alias("q"), longest_run(bits).alias("s")).collect()
    for row, g in zip(rows, got):
        assert g.q == _quit(list(row)) and g.s == _streak(list(row))


def test_attribution_matches_direct_expansion(spark):
    rnd = random.Random(11)
    succ = [(f"fp{rnd.randint(0, 6)}", rnd.randint(1, 8)) for _ in range(40)]
    fail = [(f"fp{rnd.randint(0, 9)}", rnd.choice(["card_declined", None, "expired_card"])) for _ in range(80)]
    s = spark.createDataFrame([("train", f, u) for f, u in succ], "split string, fingerprint string, user_id long")
    f = spark.createDataFrame([("train", fp, c) for fp, c in fail], "split string, fingerprint string, failure_code string")
    from lapse.operators.attribution import attribute_failures

    got = {r.user_id: r for r in attribute_failures(s, f, ["split"], ("card_declined",)).collect()}
    users_of = {}
    for fp, u in set(succ):
        users_of.setdefault(fp, set()).add(u)
    w, raw, dec = {}, {}, {}
    for fp, code in fail:
        for u in users_of.get(fp, ()):
            w[u] = w.get(u, 0) + 1 / len(users_of[fp])
            raw[u] = raw.get(u, 0) + 1
            dec[u] = dec.get(u, 0) + (1 / len(users_of[fp]) if code == "card_declined" else 0)
    assert set(got) == set(w)
    for u in w:
        assert got[u].tx_fail_count_weighted == pytest.approx(w[u])
        assert got[u].tx_fail_count_raw == raw[u]
        assert got[u].fail_card_declined == pytest.approx(dec[u])


def test_csv_layout_and_null_tokens(spark, tmp_path):
    from lapse.sources.csv import load_raw_dir

    files = {
        "users.csv": ",user_id,churn_status\n0,u1,vol_churn\n",
        "users_properties.csv": ",user_id,subscription_start_date,subscription_plan,country_code\n0,u1,2024-01-02 03:04:05,pro,NA\n",
        "users_purchases.csv": ",user_id,transaction_id,purchase_amount_dollars,purchase_type,purchase_time\n0,u1,t1,9.5,Credits Package,2024-01-02 03:04:05\n",
        "users_transaction_attempts.csv": ",transaction_id,digital_wallet,is_3d_secure,is_prepaid,is_virtual,is_business,cvc_check,amount_in_usd,billing_address_country,card_country,card_brand,card_funding,bank_name,failure_code\n0,t1,none,True,,False,False,pass,9.5,US,US,visa,credit,B,\n1,t2,None,False,False,False,False,N/A,oops,US,US,visa,credit,B,card_declined\n",
        "users_quizzes.csv": ",user_id,source,team_size,experience,usage_plan,frustration,first_feature,role\n0,u1,ads,n/a,,,,,\n",
        "users_generations.csv": ",generation_id,user_id,created_at,status,generation_type,credit_cost,duration\n0,g1,u1,2024-01-02 03:04:05,completed,video,5,\n",
    }
    for split, folder in (("train", "Train Data"), ("test", "Test Data")):
        (tmp_path / folder).mkdir()
        for name, text in files.items():
            if split == "train" and name == "users_generations.csv":
                d = tmp_path / "train_users_generations.csv"
                d.mkdir()
                (d / "train_users_generations.csv").write_text(text)
            else:
                (tmp_path / folder / f"{split}_{name}").write_text(text)
    inputs = load_raw_dir(spark, str(tmp_path))
    props = inputs.props.first()
    assert props.country_code is None  # 'NA' is a missing-value token
    tx = inputs.tx.where("split = 'train'").orderBy("transaction_id").collect()
    assert tx[0].digital_wallet == "none" and tx[1].digital_wallet is None
    assert tx[0].is_3d_secure is True and tx[0].is_prepaid is None and tx[1].amount_in_usd is None
    assert inputs.users.count() == 2 and set(inputs.users.columns) == {"user_id", "churn_status", "split"}


def test_submission_sinks_round_trip(spark, tmp_path):
    from lapse.plans import report
    from lapse.sources.sinks import write_submission, write_submission_detailed

    scored = spark.createDataFrame(
        [(1, 0.2, 0.5, 0.3), (2, 0.6, 0.2, 0.2)], "user_id long, prob_invol_churn double, prob_not_churned double, prob_vol_churn double"
    )
    decided = report.decide(scored)
    write_submission(decided, str(tmp_path / "sub"))
    write_submission_detailed(decided, str(tmp_path / "det"))
    sub = {r.user_id: r.churn_status for r in spark.read.option("header", True).csv(str(tmp_path / "sub")).collect()}
    assert sub == {"1": "not_churned", "2": "invol_churn"}
    det = spark.read.option("header", True).csv(str(tmp_path / "det"))
    assert det.columns == ["user_id", "predicted_class", *report.prob_columns(scored), "confidence"]


def generations(spark, ids, users_of=lambda k: 1 + k % 2):
    rows = [("train", k, users_of(k), f"2024-01-0{1 + k % 5} 1{k % 3}:00:00", "completed", "video" if k % 2 else None, str(k), None) for k in ids]
    return spark.createDataFrame(rows, GEN)


def by_user(df):
    return {r.user_id: r.asDict() for r in df.collect()}


def test_stream_batches_merge_and_replay_idempotently(spark, tmp_path):
    from lapse.streaming import activity as stream

    state, every = str(tmp_path / "state"), users(spark)
    g = generations(spark, range(40))
    assert stream.compact(spark, state) == stream.Version(0, {}, -1) and stream.merged_slots(spark, state) is None
    assert stream.land_batch(g.where("generation_id < 20"), 0, state)
    assert stream.compact(spark, state).number == 1
    late = g.where("generation_id >= 20")
    assert stream.land_batch(late, 1, state)
    assert stream.land_batch(late, 1, state)  # replayed before it was merged
    version = stream.compact(spark, state)
    assert version.number == 2 and version.last_batch == 1
    assert not stream.land_batch(late, 1, state)  # replayed after it
    assert stream.compact(spark, state) == version
    want = by_user(activity.activity_table(g, every, materialize=False))
    assert by_user(activity.activity_from_slots(stream.merged_slots(spark, state), every)) == want


def test_compaction_rewrites_touched_buckets_and_removes_old_versions(spark, tmp_path):
    from lapse.streaming import activity as stream

    state = str(tmp_path / "state")
    spread = generations(spark, range(300), users_of=lambda k: k % 60)
    stream.land_batch(spread, 0, state)
    first = stream.compact(spark, state)
    assert len(first.holders) > 8 and set(first.holders.values()) == {1}
    one = generations(spark, range(300, 310), users_of=lambda k: 7)
    stream.land_batch(one, 1, state)
    # A compaction that died before its version was whole leaves no trace.
    (tmp_path / "state" / "versions" / "version=2").mkdir()
    second = stream.compact(spark, state)
    assert sorted(second.holders.values()) == [1] * (len(first.holders) - 1) + [2]
    assert sorted(p.name for p in (tmp_path / "state" / "versions").iterdir()) == ["version=2"]
    assert not list((tmp_path / "state" / "deltas").glob("batch=*"))
    held = {(p.parent.name, p.name) for p in (tmp_path / "state" / "slots").glob("version=*/bucket=*")}
    assert held == {(f"version={v}", f"bucket={b}") for b, v in second.holders.items()}
    every = spark.createDataFrame([(k, None, "train") for k in range(60)], USERS)
    want = by_user(activity.activity_table(spread.unionByName(one), every, materialize=False))
    assert by_user(activity.activity_from_slots(stream.merged_slots(spark, state), every)) == want


def test_state_advances_by_new_files_only(spark, tmp_path):
    from lapse.streaming import activity as stream

    state, arrivals = str(tmp_path / "state"), str(tmp_path / "arrivals")
    for n, ids in enumerate((range(10), range(10, 25), range(25, 40))):
        generations(spark, ids).write.mode("append").parquet(arrivals)
        version = stream.advance(spark, arrivals, generations(spark, [0]).schema, state)
        assert version.number == n + 1
    assert stream.advance(spark, arrivals, generations(spark, [0]).schema, state) == version
    want = by_user(activity.activity_table(generations(spark, range(40)), users(spark), materialize=False))
    assert by_user(activity.activity_from_slots(stream.merged_slots(spark, state), users(spark))) == want


def test_runs_over_the_whole_calendar(spark):
    import datetime

    rnd = random.Random(3)
    day0 = datetime.date(2023, 12, 20)
    days = {u: sorted({rnd.randint(0, 90) for _ in range(rnd.randint(1, 60))}) for u in range(20)}
    rows = [("train", 1, u, f"{day0 + datetime.timedelta(d)} 0{k}:30:00", "completed", None, None, None) for u, ds in days.items() for d in ds for k in range(2)]
    rows += [("train", 1, 0, "no date", "completed", None, None, None), ("train", 1, 99, None, "completed", None, None, None)]
    every = spark.createDataFrame([(k, None, "train") for k in [*range(20), 99]], USERS)
    got = by_user(activity.streaks_calendar(spark.createDataFrame(rows, GEN), every))
    assert sorted(got) == list(range(20))
    for u, ds in days.items():
        runs = [[ds[0]]]
        for a, b in zip(ds, ds[1:]):
            runs[-1].append(b) if b == a + 1 else runs.append([b])
        r = got[u]
        assert (r["active_days"], r["longest_run"], r["current_run"], r["n_breaks"]) == (len(ds), max(map(len, runs)), len(runs[-1]), len(runs) - 1)


def test_kinds_of_csv_columns(spark, tmp_path):
    from lapse.sources import csv as raw_csv

    path = tmp_path / "train_users.csv"
    cells = {
        "user_id": ["u1", "u2", "3"], "churn_status": ["nan", "", "NA"], "whole": ["1", "-20", "n/a"], "part": ["1", "2.5", "1e3"],
        "truth": ["True", "false", ""], "mixed": ["true", "1", ""], "far": ["9" * 25, "1", "2"], "suffixed": ["1d", "2", "3"],
    }
    path.write_text("\n".join(",".join(r) for r in [["", *cells], *[[str(i), *(c[i] for c in cells.values())] for i in range(3)]]) + "\n")
    kinds = {r.column_name: (r.kind, r.n_null, r.n_rows) for r in raw_csv.column_kinds(raw_csv._raw_cells(spark, str(path), "users")).collect()}
    assert kinds == {
        "user_id": ("text", 0, 3), "churn_status": ("null", 3, 3), "whole": ("integer", 1, 3), "part": ("double", 0, 3),
        "truth": ("boolean", 1, 3), "mixed": ("text", 1, 3), "far": ("double", 0, 3), "suffixed": ("text", 0, 3),
    }
    plain = raw_csv.read_raw_csv(spark, str(path), "users")
    assert dict(plain.dtypes)["whole"] == "string"
    typed = raw_csv.read_raw_csv(spark, str(path), "users", infer=True)
    assert dict(typed.dtypes) == {
        "user_id": "string", "churn_status": "string", "whole": "bigint", "part": "double", "truth": "boolean", "mixed": "string",
        "far": "double", "suffixed": "string",
    }
    assert [r.whole for r in typed.collect()] == [1, -20, None] and [r.truth for r in typed.collect()] == [True, False, None]


def test_incremental_runs_in_one_session_do_not_share_state(spark, tmp_path):
    from lapse.plans.activity import activity_table
    from lapse.streaming.activity import activity_incremental

    def events(offset):
        rows = [("train", k, 1 + k % 3, f"2024-01-0{1 + k % 4} 0{k % 9}:00:00", "completed", "image", str(k + offset), None)
                for k in range(30 + offset)]
        return spark.createDataFrame(rows, GEN)

    for offset in (0, 7):
        g = events(offset)
        path = str(tmp_path / f"events{offset}")
        g.repartition(3).write.parquet(path)
        got = {r.user_id: r.asDict() for r in activity_incremental(spark, path, users(spark), g.schema).collect()}
        want = {r.user_id: r.asDict() for r in activity_table(g, users(spark), materialize=False).collect()}
        assert got == want


def test_clusters_are_fitted_over_blocks_of_rows(spark, monkeypatch):
    """No iteration decodes cached rows again: every restart gets the landed
    matrix, not persisted, and keeps it in blocks itself."""
    from pyspark.ml.clustering import KMeans

    from lapse.plans import model

    kinds = []

    class Watched(KMeans):
        def fit(self, dataset):
            kinds.append((self.getSolver(), dataset.is_cached, dataset.storageLevel.useMemory))
            return super().fit(dataset)

    monkeypatch.setattr(model, "KMeans", Watched)
    rows = [("train" if i % 4 else "test", i, *[float((i * (j + 3)) % 11) for j in range(len(model.CLUSTER_FEATURES))]) for i in range(40)]
    schema = "split string, user_id long, " + ", ".join(f"{c} double" for c in model.CLUSTER_FEATURES)
    found = model.cluster_ids(spark.createDataFrame(rows, schema), restarts=2).collect()
    assert kinds == [("block", False, False)] * 2
    assert len(found) == 40 and all(0 <= r.cluster_id < model.MAX_CLUSTERS for r in found)
