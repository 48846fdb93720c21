"""DuckDB oracle SQL for every registered query.

Each string is self-contained: the fixture views of ``lapse.sources.fixtures``
as CTEs, then the query. Doubles are rounded to 6 places on both sides,
because summation order differs between engines. Integer sums are cast to
BIGINT (DuckDB sums to HUGEINT).
"""

from __future__ import annotations

from lapse.sources.fixtures import fixture_ctes

R = 6


def with_fixtures(*ctes: str) -> str:
    parts = [fixture_ctes(), *ctes]
    return "WITH " + ",\n".join(parts) + "\n"


def rnd(expr: str, alias: str) -> str:
    return f"ROUND({expr}, {R}) AS {alias}"


def extract_num(col: str, pattern: str, group: int) -> str:
    return f"TRY_CAST(regexp_extract({col}, '{pattern}', {group}) AS DOUBLE)"


# The patterns that cut a timestamp string into parts.
DAY_PAT = r"(\d+)-(\d+)-(\d+)\s+(\d+):(\d+)"
DT_PAT = r"(\d+)-(\d+)-(\d+)\s+(\d+):(\d+):(\d+)"
HOUR_PAT = r"\d+-\d+-\d+\s+(\d+):"
DATE_PAT = r"(\d+-\d+-\d+)"


def day_number(col: str) -> str:
    m = extract_num(col, DAY_PAT, 2)
    d = extract_num(col, DAY_PAT, 3)
    h = extract_num(col, DAY_PAT, 4)
    return f"({m} * 31 + {d} + {h} / 24.0)"


def number(x: str) -> str:
    """Text as a double; no number or NaN is missing."""
    return f"NULLIF(TRY_CAST({x} AS DOUBLE), 'nan'::DOUBLE)"


def same_user(a: str, b: str) -> str:
    """A user is a (split, id) pair."""
    return f"{a}.split = {b}.split AND {a}.user_id = {b}.user_id"


def cnt(cond: str) -> str:
    return f"COUNT(*) FILTER (WHERE {cond})"


# ---------------------------------------------------------------- purchases

# The types that occur in the fixture.
PURCHASE_TYPES = ("credits_package", "gift_card", "subscription_create", "subscription_update")

_PURCH_SUMMARY = """
  COUNT(transaction_id) AS total_purchases,
  SUM(purchase_amount_dollars) AS total_spend,
  AVG(purchase_amount_dollars) AS avg_purchase_amount,
  MAX(purchase_amount_dollars) AS max_purchase,
  MIN(purchase_amount_dollars) AS min_purchase,
  COUNT(DISTINCT purchase_type) AS n_purchase_types"""

def _ptype(t: str) -> str:
    return "  " + cnt("replace(lower(purchase_type), ' ', '_') = '" + t + "'") + f" AS ptype_{t}"


_PURCH_TYPES = ",\n".join(_ptype(t) for t in PURCHASE_TYPES)

_PURCH_SPAN = f"  MAX({day_number('purchase_time')}) - MIN({day_number('purchase_time')}) AS days_between_first_last"


def purchase_summary() -> str:
    return with_fixtures() + f"""
SELECT split, user_id, total_purchases, {rnd('total_spend', 'total_spend')}, {rnd('avg_purchase_amount', 'avg_purchase_amount')},
       {rnd('max_purchase', 'max_purchase')}, {rnd('min_purchase', 'min_purchase')}, n_purchase_types
FROM (SELECT split, user_id, {_PURCH_SUMMARY} FROM purchases GROUP BY split, user_id) a"""


def purchase_type_counts() -> str:
    return with_fixtures() + f"SELECT split, user_id,\n{_PURCH_TYPES}\nFROM purchases GROUP BY split, user_id"


def purchase_span() -> str:
    return with_fixtures() + f"""
SELECT split, user_id, {rnd('days_between_first_last', 'days_between_first_last')}
FROM (SELECT split, user_id,\n{_PURCH_SPAN}\nFROM purchases GROUP BY split, user_id) a"""


PURCHASE_FEATURE_CTE = f"""purch_agg AS (
SELECT split, user_id, {_PURCH_SUMMARY},
{_PURCH_TYPES},
{_PURCH_SPAN},
  1 AS has_purchases
FROM purchases GROUP BY split, user_id)"""

PURCHASE_FEATURES = [
    ("total_purchases", "int"), ("total_spend", "dbl"), ("avg_purchase_amount", "dbl"),
    ("max_purchase", "dbl"), ("min_purchase", "dbl"), ("n_purchase_types", "int"),
    *[(f"ptype_{t}", "int") for t in PURCHASE_TYPES],
    ("days_between_first_last", "dbl"), ("has_purchases", "int"),
]


def filled(alias: str, cols, fill: str = "0") -> list[str]:
    out = []
    for name, kind in cols:
        e = f"COALESCE({alias}.{name}, {fill})"
        out.append(rnd(e, name) if kind == "dbl" else f"{e} AS {name}")
    return out


def purchases_features() -> str:
    sel = ",\n  ".join(["u.split", "u.user_id", *filled("p", PURCHASE_FEATURES)])
    return with_fixtures(PURCHASE_FEATURE_CTE) + f"""
SELECT {sel}
FROM users u LEFT JOIN purch_agg p ON {same_user('u', 'p')}"""


# ---------------------------------------------------------------- properties

PROPS_SPLIT_CTE = "pr AS (SELECT * FROM props)"


def _cal_parts(col: str) -> dict[str, str]:
    names = ("year", "month", "day", "hour")
    return {n: extract_num(col, DT_PAT, i + 1) for i, n in enumerate(names)}


def _weekday(p: dict[str, str]) -> str:
    mk = f"make_date(CAST({p['year']} AS BIGINT), CAST({p['month']} AS BIGINT), CAST({p['day']} AS BIGINT))"
    return f"CAST((dayofweek({mk}) + 1) % 7 AS INTEGER)"


def _calendar_select(col: str = "subscription_start_date") -> str:
    p = _cal_parts(col)
    return (
        f"CAST({p['month']} AS INTEGER) AS sub_month, {_weekday(p)} AS sub_day_of_week, "
        f"CAST({p['hour']} AS INTEGER) AS sub_hour"
    )


RANK_EXPR = (
    "CASE WHEN subscription_start_date IS NULL THEN NULL ELSE "
    "(RANK() OVER (PARTITION BY split ORDER BY subscription_start_date) - 1 "
    "+ (COUNT(*) OVER (PARTITION BY split, subscription_start_date) + 1) / 2.0) "
    "/ COUNT(subscription_start_date) OVER (PARTITION BY split) END"
)

FREQ_CTE = """cfreq AS (
SELECT split, country_code, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY split) AS country_freq
FROM pr WHERE country_code IS NOT NULL GROUP BY split, country_code)"""

PROPS_FEATURE_CTE = f"""props_feat AS (
SELECT pr.split, pr.user_id, pr.subscription_plan, pr.country_code, cf.country_freq,
       {_calendar_select('pr.subscription_start_date')},
       {RANK_EXPR.replace('subscription_start_date', 'pr.subscription_start_date').replace('PARTITION BY split', 'PARTITION BY pr.split')} AS sub_date_rank
FROM pr LEFT JOIN cfreq cf ON pr.split = cf.split AND pr.country_code = cf.country_code)"""


def country_frequency() -> str:
    return with_fixtures(PROPS_SPLIT_CTE, FREQ_CTE) + f"SELECT split, country_code, {rnd('country_freq', 'country_freq')} FROM cfreq"


def subscription_calendar() -> str:
    return with_fixtures() + f"SELECT split, user_id, {_calendar_select()} FROM props"


def subscription_date_rank() -> str:
    return with_fixtures(PROPS_SPLIT_CTE) + f"SELECT split, user_id, {rnd(RANK_EXPR, 'sub_date_rank')} FROM pr"


def properties_features() -> str:
    return with_fixtures(PROPS_SPLIT_CTE, FREQ_CTE, PROPS_FEATURE_CTE) + f"""
SELECT split, user_id, subscription_plan, country_code, {rnd('country_freq', 'country_freq')}, sub_month, sub_day_of_week, sub_hour,
       {rnd('sub_date_rank', 'sub_date_rank')}
FROM props_feat"""


# ---------------------------------------------------------------- onboarding

QUIZ_FEATURE_CTE = f"""quiz_feat AS (
SELECT u.split, u.user_id,
       COALESCE(q.source, 'missing') AS quiz_source,
       COALESCE({number('q.team_size')}, 0.0) AS quiz_team_size,
       COALESCE(q.experience, 'missing') AS quiz_experience,
       COALESCE(q.usage_plan, 'missing') AS quiz_usage_plan,
       COALESCE(q.frustration, 'missing') AS quiz_frustration,
       COALESCE(q.first_feature, 'missing') AS quiz_first_feature,
       COALESCE(q.role, 'missing') AS quiz_role,
       CASE WHEN q.user_id IS NULL THEN 0
            ELSE CAST(COALESCE(q.source, q.experience, q.frustration, q.first_feature, q.role) IS NOT NULL AS INTEGER) END AS has_quiz_data
FROM users u LEFT JOIN quizzes q ON {same_user('u', 'q')})"""


def quiz_features() -> str:
    return with_fixtures(QUIZ_FEATURE_CTE) + f"""
SELECT split, user_id, quiz_source, {rnd('quiz_team_size', 'quiz_team_size')}, quiz_experience, quiz_usage_plan, quiz_frustration,
       quiz_first_feature, quiz_role, has_quiz_data
FROM quiz_feat"""


# ---------------------------------------------------------------- payments

# The failure codes that have columns.
FAILURE_CODES = ("card_declined", "expired_card", "incorrect_cvc", "incorrect_number", "processing_error")

PAY_CTES = (
    # All purchases count, whoever bought.
    "pmap AS (SELECT DISTINCT split, transaction_id, user_id FROM purchases WHERE transaction_id IS NOT NULL)",
    "succ AS (SELECT t.*, m.user_id FROM tx t JOIN pmap m ON t.split = m.split AND t.transaction_id = m.transaction_id)",
    "fail AS (SELECT t.* FROM tx t WHERE NOT EXISTS "
    "(SELECT 1 FROM pmap m WHERE m.split = t.split AND m.transaction_id = t.transaction_id))",
)


def _bool_text(c: str) -> str:
    return f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' END"


FP_EXPR = "concat_ws('|', " + ", ".join(
    f"COALESCE({e}, 'unk')"
    for e in (
        "card_brand", "card_country", "card_funding", "bank_name", "billing_address_country",
        _bool_text("is_prepaid"), _bool_text("is_virtual"),
    )
) + ")"

RISK_SELECT = """COUNT(transaction_id) AS tx_success_count,
  CAST(bool_or(COALESCE(digital_wallet, 'none') <> 'none') AS INTEGER) AS tx_has_digital_wallet,
  CAST(bool_or(COALESCE(is_3d_secure, false)) AS INTEGER) AS tx_has_3d_secure,
  CAST(bool_or(COALESCE(is_prepaid, false)) AS INTEGER) AS tx_is_prepaid,
  CAST(bool_or(COALESCE(is_virtual, false)) AS INTEGER) AS tx_is_virtual,
  CAST(bool_or(COALESCE(is_business, false)) AS INTEGER) AS tx_is_business,
  AVG(CASE WHEN COALESCE(cvc_check, '') = 'pass' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS tx_cvc_pass_rate,
  AVG(amount_in_usd) AS tx_avg_amount,
  MAX(amount_in_usd) AS tx_max_amount"""

MISMATCH_SELECT = (
    "AVG(CAST(COALESCE(billing_address_country, '') <> COALESCE(card_country, '') AS DOUBLE)) AS tx_country_mismatch_rate"
)


def _mode_cte(col: str, out: str) -> str:
    return f"""{out}_m AS (
SELECT split, user_id, {col} AS {out} FROM (
  SELECT split, user_id, {col}, ROW_NUMBER() OVER (PARTITION BY split, user_id ORDER BY COUNT(*) DESC, {col}) AS rn
  FROM succ WHERE {col} IS NOT NULL GROUP BY split, user_id, {col}) x WHERE rn = 1)"""


MODE_CTES = (_mode_cte("card_brand", "tx_card_brand"), _mode_cte("card_funding", "tx_card_funding"))

# The oracle expands each failure to every matching user (the direct form).
ATTRIB_CTES = (
    f"succ_fp AS (SELECT DISTINCT split, {FP_EXPR} AS fingerprint, user_id FROM succ WHERE user_id IS NOT NULL)",
    "fp_n AS (SELECT split, fingerprint, COUNT(*) AS n_users FROM succ_fp GROUP BY split, fingerprint)",
    f"fail_fp AS (SELECT split, {FP_EXPR} AS fingerprint, COALESCE(failure_code, 'unknown') AS code FROM fail)",
    """matched AS (SELECT s.split, s.user_id, f.code, 1.0 / n.n_users AS weight
FROM fail_fp f JOIN succ_fp s ON f.split = s.split AND f.fingerprint = s.fingerprint
JOIN fp_n n ON f.split = n.split AND f.fingerprint = n.fingerprint)""",
    "fail_agg AS (SELECT split, user_id, SUM(weight) AS tx_fail_count_weighted, COUNT(*) AS tx_fail_count_raw, "
    + ", ".join(f"COALESCE(SUM(weight) FILTER (WHERE code = '{c}'), 0) AS fail_{c}" for c in FAILURE_CODES)
    + " FROM matched GROUP BY split, user_id)",
)

PAY_FEATURE_CTE = f"""risk AS (SELECT split, user_id, {RISK_SELECT}, {MISMATCH_SELECT} FROM succ GROUP BY split, user_id),
pay_base AS (
SELECT u.split, u.user_id,
  COALESCE(r.tx_success_count, 0) AS tx_success_count,
  COALESCE(r.tx_has_digital_wallet, 0) AS tx_has_digital_wallet,
  COALESCE(r.tx_has_3d_secure, 0) AS tx_has_3d_secure,
  COALESCE(r.tx_is_prepaid, 0) AS tx_is_prepaid,
  COALESCE(r.tx_is_virtual, 0) AS tx_is_virtual,
  COALESCE(r.tx_is_business, 0) AS tx_is_business,
  COALESCE(r.tx_cvc_pass_rate, 0) AS tx_cvc_pass_rate,
  COALESCE(r.tx_avg_amount, 0) AS tx_avg_amount,
  COALESCE(r.tx_max_amount, 0) AS tx_max_amount,
  COALESCE(r.tx_country_mismatch_rate, 0) AS tx_country_mismatch_rate,
  COALESCE(b.tx_card_brand, 'unknown') AS tx_card_brand,
  COALESCE(fu.tx_card_funding, 'unknown') AS tx_card_funding,
  COALESCE(f.tx_fail_count_weighted, 0) AS tx_fail_count_weighted,
  COALESCE(f.tx_fail_count_raw, 0) AS tx_fail_count_raw,
  {", ".join(f"COALESCE(f.fail_{c}, 0) AS fail_{c}" for c in FAILURE_CODES)}
FROM users u
LEFT JOIN risk r ON {same_user('u', 'r')}
LEFT JOIN tx_card_brand_m b ON {same_user('u', 'b')}
LEFT JOIN tx_card_funding_m fu ON {same_user('u', 'fu')}
LEFT JOIN fail_agg f ON {same_user('u', 'f')}),
pay_feat AS (
SELECT *, tx_fail_count_weighted / (tx_fail_count_weighted + tx_success_count + 1e-6) AS tx_failure_rate FROM pay_base)"""

PAYMENT_FEATURES = [
    ("tx_success_count", "int"), ("tx_has_digital_wallet", "int"), ("tx_has_3d_secure", "int"),
    ("tx_is_prepaid", "int"), ("tx_is_virtual", "int"), ("tx_is_business", "int"),
    ("tx_cvc_pass_rate", "dbl"), ("tx_avg_amount", "dbl"), ("tx_max_amount", "dbl"),
    ("tx_country_mismatch_rate", "dbl"), ("tx_card_brand", "str"), ("tx_card_funding", "str"),
    ("tx_fail_count_weighted", "dbl"), ("tx_fail_count_raw", "int"),
    *[(f"fail_{c}", "dbl") for c in FAILURE_CODES], ("tx_failure_rate", "dbl"),
]


def plain(alias: str, cols) -> list[str]:
    return [rnd(f"{alias}.{n}", n) if k == "dbl" else f"{alias}.{n}" for n, k in cols]


def tx_success() -> str:
    return with_fixtures(*PAY_CTES) + "SELECT * FROM succ"


def tx_failed() -> str:
    return with_fixtures(*PAY_CTES) + "SELECT * FROM fail"


def card_risk() -> str:
    cols = PAYMENT_FEATURES[:9]
    return with_fixtures(*PAY_CTES, f"r AS (SELECT split, user_id, {RISK_SELECT} FROM succ GROUP BY split, user_id)") + (
        "SELECT r.split, r.user_id, " + ", ".join(plain("r", cols)) + " FROM r"
    )


def country_mismatch() -> str:
    return with_fixtures(*PAY_CTES) + f"SELECT split, user_id, ROUND(tx_country_mismatch_rate, 6) AS tx_country_mismatch_rate FROM (SELECT split, user_id, {MISMATCH_SELECT} FROM succ GROUP BY split, user_id) r"


def card_mode() -> str:
    return with_fixtures(*PAY_CTES, *MODE_CTES) + f"""
SELECT u.split, u.user_id, COALESCE(b.tx_card_brand, 'unknown') AS tx_card_brand, COALESCE(f.tx_card_funding, 'unknown') AS tx_card_funding
FROM (SELECT DISTINCT split, user_id FROM succ) u
LEFT JOIN tx_card_brand_m b ON {same_user('u', 'b')} LEFT JOIN tx_card_funding_m f ON {same_user('u', 'f')}"""


def fingerprint_users() -> str:
    return with_fixtures(*PAY_CTES, *ATTRIB_CTES) + "SELECT split, fingerprint, n_users FROM fp_n"


def failure_attribution() -> str:
    return with_fixtures(*PAY_CTES, *ATTRIB_CTES) + (
        "SELECT split, user_id, ROUND(tx_fail_count_weighted, 6) AS tx_fail_count_weighted, tx_fail_count_raw FROM fail_agg"
    )


def failure_by_code() -> str:
    return with_fixtures(*PAY_CTES, *ATTRIB_CTES) + (
        "SELECT split, user_id, " + ", ".join(rnd(f"fail_{c}", f"fail_{c}") for c in FAILURE_CODES) + " FROM fail_agg"
    )


def payments_features() -> str:
    return with_fixtures(*PAY_CTES, *MODE_CTES, *ATTRIB_CTES, PAY_FEATURE_CTE) + (
        "SELECT p.split, p.user_id, " + ", ".join(plain("p", PAYMENT_FEATURES)) + " FROM pay_feat p"
    )


# ---------------------------------------------------------------- activity

# The statuses counted.
STATUSES = ("completed", "failed", "nsfw", "canceled")
DAY_BITS = [f"active_day_{d}" for d in range(14)]

# Direct event-level form: window over raw events, no slot pre-aggregation.
GEN_CTES = (
    f"gen_k AS (SELECT g.* FROM generations g JOIN users u ON {same_user('u', 'g')})",
    f"""gen_e AS (SELECT *, {day_number('created_at')} AS day_num,
  {extract_num('created_at', HOUR_PAT, 1)} AS hr,
  NULLIF(regexp_extract(created_at, '{DATE_PAT}', 1), '') AS day_date,
  COALESCE({number('credit_cost')}, 0.0) AS credit,
  {number('duration')} AS dur,
  COALESCE(lower(generation_type) LIKE '%video%', false) AS is_video,
  COALESCE(lower(generation_type) LIKE '%image%', false) AS is_image
FROM gen_k)""",
    "gen_r AS (SELECT *, day_num - MIN(day_num) OVER (PARTITION BY split, user_id) AS rel FROM gen_e)",
    """gen_u AS (SELECT user_id, split,
  COUNT(generation_id) AS gen_total,
  """ + ",\n  ".join(f"{cnt(f'status = {chr(39)}{st}{chr(39)}')} AS gen_{st}" for st in STATUSES) + """,
  SUM(credit) AS gen_total_credits,
  COUNT(*) FILTER (WHERE is_video) AS gen_video_count,
  COUNT(*) FILTER (WHERE is_image) AS gen_image_count,
  COUNT(DISTINCT day_date) + MAX(CASE WHEN day_date IS NULL THEN 1 ELSE 0 END) AS gen_active_days,
  COUNT(DISTINCT generation_type) + MAX(CASE WHEN generation_type IS NULL THEN 1 ELSE 0 END) AS gen_unique_types,
  COALESCE(SUM(dur), 0) AS dur_sum, COUNT(dur) AS dur_n, COALESCE(SUM(hr), 0) AS hour_sum,
  MIN(day_num) AS first_day, MAX(day_num) AS last_day,
  COUNT(generation_id) FILTER (WHERE rel < 7) AS gen_week1_count,
  COALESCE(SUM(credit) FILTER (WHERE rel < 7), 0) AS credits_week1,
  COUNT(generation_id) FILTER (WHERE rel >= 7) AS gen_week2_count,
  COALESCE(SUM(credit) FILTER (WHERE rel >= 7), 0) AS credits_week2,
  COUNT(generation_id) FILTER (WHERE rel < 2) AS gen_day01_count,
  COALESCE(SUM(credit) FILTER (WHERE rel < 2), 0) AS credits_day01,
  """ + ",\n  ".join(
        f"MAX(CASE WHEN LEAST(FLOOR(rel), 13) = {d} THEN 1 ELSE 0 END) AS active_day_{d}" for d in range(14)
    ) + """
FROM gen_r GROUP BY user_id, split)""",
    "gen_max AS (SELECT split, MAX(last_day) AS split_last FROM gen_u GROUP BY split)",
    "gen_s AS (SELECT *, concat(" + ", ".join(f"CAST({b} AS VARCHAR)" for b in DAY_BITS) + ") AS bitstr FROM gen_u)",
    """gen_f AS (SELECT g.*,
  gen_total_credits / (gen_total + 1e-6) AS gen_avg_credits,
  gen_completed / (gen_total + 1e-6) AS completion_rate,
  gen_nsfw / (gen_total + 1e-6) AS nsfw_rate,
  gen_total / (gen_active_days + 1e-6) AS gen_intensity,
  gen_video_count / (gen_total + 1e-6) AS gen_video_ratio,
  dur_sum / (dur_n + 1e-6) AS gen_avg_duration,
  hour_sum / (gen_total + 1e-6) AS gen_avg_hour,
  CAST(CASE WHEN strpos(substr(bitstr, GREATEST(strpos(bitstr, '1'), 1)), '0') = 0 THEN 14
       ELSE GREATEST(strpos(bitstr, '1'), 1) - 1 + strpos(substr(bitstr, GREATEST(strpos(bitstr, '1'), 1)), '0') - 1 END AS INTEGER) AS first_quit_day,
  CAST(GREATEST(0, """ + ", ".join(f"CASE WHEN strpos(bitstr, '{'1' * k}') > 0 THEN {k} ELSE 0 END" for k in range(1, 15)) + """) AS INTEGER) AS max_active_streak,
  CAST(""" + " + ".join(DAY_BITS[:7]) + """ AS INTEGER) AS week1_active_days,
  CAST(""" + " + ".join(DAY_BITS[7:]) + """ AS INTEGER) AS week2_active_days,
  gen_day01_count / (gen_total + 1) AS day01_ratio,
  credits_day01 / (gen_total_credits + 1) AS day01_credits_ratio,
  CAST(gen_day01_count / (gen_total + 1) > 0.5 AS INTEGER) AS burst_flag,
  CAST(gen_active_days <= 2 AS INTEGER) AS is_short_life,
  CAST(gen_active_days = 1 AS INTEGER) AS is_one_day_user,
  (gen_week2_count - gen_week1_count) / (gen_week1_count + 1) AS gen_trend,
  (credits_week2 - credits_week1) / (credits_week1 + 1) AS credits_trend,
  CAST(gen_week2_count < gen_week1_count * 0.7 AS INTEGER) AS deceleration_flag,
  m.split_last - last_day AS days_since_last_gen,
  m.split_last - first_day AS days_since_first_gen,
  1 AS gen_has_generations
FROM gen_s g JOIN gen_max m ON g.split = m.split)""",
)

ACTIVITY_FEATURES = [
    ("gen_total", "int"), ("gen_completed", "int"), ("gen_failed", "int"), ("gen_nsfw", "int"),
    ("gen_canceled", "int"), ("gen_total_credits", "dbl"), ("gen_video_count", "int"), ("gen_image_count", "int"),
    ("gen_active_days", "int"), ("gen_unique_types", "int"), ("gen_avg_credits", "dbl"), ("completion_rate", "dbl"),
    ("nsfw_rate", "dbl"), ("gen_intensity", "dbl"), ("gen_video_ratio", "dbl"), ("gen_avg_duration", "dbl"),
    ("gen_avg_hour", "dbl"), ("gen_week1_count", "int"), ("credits_week1", "dbl"), ("gen_week2_count", "int"),
    ("credits_week2", "dbl"), ("gen_day01_count", "int"), ("credits_day01", "dbl"),
    *[(b, "int") for b in DAY_BITS],
    ("first_quit_day", "int"), ("max_active_streak", "int"), ("week1_active_days", "int"),
    ("week2_active_days", "int"), ("day01_ratio", "dbl"), ("day01_credits_ratio", "dbl"), ("burst_flag", "int"),
    ("is_short_life", "int"), ("is_one_day_user", "int"), ("gen_trend", "dbl"), ("credits_trend", "dbl"),
    ("deceleration_flag", "int"), ("days_since_last_gen", "dbl"), ("days_since_first_gen", "dbl"),
    ("gen_has_generations", "int"),
]
_ACT = dict(ACTIVITY_FEATURES)


def _act_query(cols: list[str]) -> str:
    sel = ", ".join(rnd(f"g.{c}", c) if _ACT[c] == "dbl" else f"g.{c}" for c in cols)
    return with_fixtures(*GEN_CTES) + f"SELECT g.split, g.user_id, {sel} FROM gen_f g"


ACTIVITY_GROUPS = {
    "gen_status_counts": ["gen_total", *[f"gen_{s}" for s in STATUSES]],
    "gen_credits": ["gen_total_credits", "gen_avg_credits", "gen_video_count", "gen_image_count",
                    "gen_video_ratio", "gen_avg_duration", "gen_avg_hour"],
    "gen_distinct_days_types": ["gen_active_days", "gen_unique_types", "gen_intensity"],
    "gen_first48h": ["gen_day01_count", "credits_day01", "day01_ratio", "day01_credits_ratio", "burst_flag"],
    "gen_weekly": ["gen_week1_count", "credits_week1", "gen_week2_count", "credits_week2", "gen_trend",
                   "credits_trend", "deceleration_flag"],
    "gen_daily_bits": DAY_BITS,
    "gen_streak_quit": ["first_quit_day", "max_active_streak", "week1_active_days", "week2_active_days",
                        "is_short_life", "is_one_day_user"],
    "gen_recency": ["days_since_last_gen", "days_since_first_gen"],
}

ACT_FEATURE_CTE = "act_feat AS (SELECT u.split, u.user_id, " + ", ".join(
    f"COALESCE(g.{c}, 0) AS {c}" for c, _ in ACTIVITY_FEATURES
) + f" FROM users u LEFT JOIN gen_f g ON {same_user('u', 'g')})"


def activity_features() -> str:
    return with_fixtures(*GEN_CTES, ACT_FEATURE_CTE) + "SELECT a.split, a.user_id, " + ", ".join(
        plain("a", ACTIVITY_FEATURES)
    ) + " FROM act_feat a"


# ---------------------------------------------------------------- assembly

PURCH_FEAT_CTE = "purch_feat AS (SELECT u.split, u.user_id, " + ", ".join(
    f"COALESCE(p.{n}, 0) AS {n}" for n, _ in PURCHASE_FEATURES
) + f" FROM users u LEFT JOIN purch_agg p ON {same_user('u', 'p')})"

PROPS_FEATURES = [
    ("subscription_plan", "str"), ("country_code", "str"), ("country_freq", "dbl"), ("sub_month", "int"),
    ("sub_day_of_week", "int"), ("sub_hour", "int"), ("sub_date_rank", "dbl"),
]
QUIZ_FEATURES = [
    ("quiz_source", "str"), ("quiz_team_size", "dbl"), ("quiz_experience", "str"), ("quiz_usage_plan", "str"),
    ("quiz_frustration", "str"), ("quiz_first_feature", "str"), ("quiz_role", "str"), ("has_quiz_data", "int"),
]
# Interaction terms, clip bounds and logged columns, stated
# again so that the oracle does not depend on the engine.
INTERACTION_SQL = [
    ("credits_x_failure_rate", "dbl", "gen_total_credits * tx_failure_rate"),
    ("trend_x_recency", "dbl", "gen_trend * days_since_last_gen"),
    ("spend_per_gen", "dbl", "total_spend / (gen_total + 1)"),
    ("gen_total_x_purchases", "int", "gen_total * total_purchases"),
    ("prepaid_x_failure", "dbl", "tx_is_prepaid * tx_failure_rate"),
    ("prepaid_x_cvc", "dbl", "tx_is_prepaid * (1 - tx_cvc_pass_rate)"),
    ("payment_risk_score", "dbl", "(tx_is_prepaid + tx_is_virtual + (1 - tx_cvc_pass_rate) + tx_failure_rate) / 4"),
    ("burst_x_short_life", "int", "burst_flag * is_short_life"),
    ("high_usage_short_life", "int", "gen_total * is_short_life"),
    ("credits_per_active_day", "dbl", "gen_total_credits / (gen_active_days + 1)"),
    ("abrupt_decline", "dbl", "day01_ratio * (1 - completion_rate)"),
    ("sustained_engagement", "dbl", "gen_active_days * completion_rate"),
    ("exploration_score", "int", "gen_unique_types * gen_active_days"),
    ("purchase_engagement", "int", "has_purchases * gen_active_days"),
]
CLIP_SQL = {
    "gen_trend": (-5, 10), "credits_trend": (-5, 10), "gen_total_credits": (0, 500000),
    "gen_avg_credits": (0, 10000), "total_spend": (0, 500), "tx_avg_amount": (0, 500),
    "tx_max_amount": (0, 500), "gen_total": (0, 500), "gen_intensity": (0, 100),
}
LOG_SQL = (
    "gen_total", "gen_total_credits", "gen_completed", "gen_failed", "total_spend",
    "tx_success_count", "tx_fail_count_weighted", "gen_video_count", "gen_image_count",
    "credits_week1", "credits_week2", "gen_week1_count", "gen_week2_count",
)

USER_FEATURES = [
    *PROPS_FEATURES, *PURCHASE_FEATURES, *PAYMENT_FEATURES, *ACTIVITY_FEATURES, *QUIZ_FEATURES,
    *[(n, k) for n, k, _ in INTERACTION_SQL], *[(f"{c}_log", "dbl") for c in LOG_SQL],
]

ASSEMBLY_CTES = (
    "merged AS (SELECT u.user_id, u.churn_status, u.split, "
    + ", ".join(
        [f"pf.{n}" for n, _ in PROPS_FEATURES]
        + [f"pu.{n}" for n, _ in PURCHASE_FEATURES]
        + [f"pa.{n}" for n, _ in PAYMENT_FEATURES]
        + [f"ac.{n}" for n, _ in ACTIVITY_FEATURES]
        + [f"qf.{n}" for n, _ in QUIZ_FEATURES]
    )
    + f""" FROM users u
LEFT JOIN props_feat pf ON {same_user('u', 'pf')}
LEFT JOIN purch_feat pu ON {same_user('u', 'pu')}
LEFT JOIN pay_feat pa ON {same_user('u', 'pa')}
LEFT JOIN act_feat ac ON {same_user('u', 'ac')}
LEFT JOIN quiz_feat qf ON {same_user('u', 'qf')})""",
    "inter AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, _, e in INTERACTION_SQL) + " FROM merged)",
    "clipped AS (SELECT * REPLACE ("
    + ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL ELSE LEAST(GREATEST({c}, {lo}), {hi}) END AS {c}"
        for c, (lo, hi) in CLIP_SQL.items()
    )
    + ") FROM inter)",
    "uf AS (SELECT *, " + ", ".join(f"LN(1 + GREATEST({c}, 0)) AS {c}_log" for c in LOG_SQL) + " FROM clipped)",
)

ALL_FEATURE_CTES = (
    PROPS_SPLIT_CTE, FREQ_CTE, PROPS_FEATURE_CTE, PURCHASE_FEATURE_CTE, PURCH_FEAT_CTE,
    *PAY_CTES, *MODE_CTES, *ATTRIB_CTES, PAY_FEATURE_CTE, *GEN_CTES, ACT_FEATURE_CTE, QUIZ_FEATURE_CTE,
    *ASSEMBLY_CTES,
)


def user_features() -> str:
    return with_fixtures(*ALL_FEATURE_CTES) + (
        "SELECT f.user_id, f.churn_status, f.split, " + ", ".join(plain("f", USER_FEATURES)) + " FROM uf f"
    )


def interactions() -> str:
    cols = [(n, k) for n, k, _ in INTERACTION_SQL]
    return with_fixtures(*ALL_FEATURE_CTES) + "SELECT f.split, f.user_id, " + ", ".join(plain("f", cols)) + " FROM inter f"


def clip_log() -> str:
    cols = [(c, dict(USER_FEATURES)[c]) for c in CLIP_SQL] + [(f"{c}_log", "dbl") for c in LOG_SQL]
    return with_fixtures(*ALL_FEATURE_CTES) + "SELECT f.split, f.user_id, " + ", ".join(plain("f", cols)) + " FROM uf f"


# ---------------------------------------------------------------- encodings

CAT_FEATURES = (
    "country_code", "tx_card_brand", "tx_card_funding", "quiz_source", "quiz_experience",
    "quiz_frustration", "quiz_first_feature", "quiz_role", "quiz_usage_plan",
)
SEED = 42

ENC_CTES = (
    "enc_base AS (SELECT user_id, split, churn_status, "
    + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'missing') AS {c}" for c in CAT_FEATURES)
    + " FROM uf)",
    "lbl AS (SELECT split, user_id, churn_status, country_code, "
    "CAST(DENSE_RANK() OVER (ORDER BY churn_status) - 1 AS INTEGER) AS target FROM enc_base WHERE split = 'train')",
)


TE_CTES = (
    "te_tr AS (SELECT l.split, l.user_id, l.country_code, l.target, "
    f"CAST((ROW_NUMBER() OVER (ORDER BY md5(CAST(l.user_id AS VARCHAR) || ':{SEED}'), l.user_id) - 1) "
    "% GREATEST(2, LEAST(5, (SELECT COUNT(*) FROM lbl))) AS INTEGER) AS fold FROM lbl l)",
)


def _te_train(k: int) -> str:
    y = f"CASE WHEN t.target = {k} THEN 1.0 ELSE 0.0 END"
    return (
        f"COALESCE((SELECT AVG({y}) FROM te_tr t WHERE t.country_code = r.country_code AND t.fold <> r.fold), "
        f"(SELECT AVG({y}) FROM te_tr t WHERE t.fold <> r.fold))"
    )


def _te_test(k: int) -> str:
    y = f"CASE WHEN t.target = {k} THEN 1.0 ELSE 0.0 END"
    return (
        f"COALESCE((SELECT AVG({y}) FROM te_tr t WHERE t.country_code = e.country_code), "
        f"(SELECT AVG({y}) FROM te_tr t))"
    )


def label_index() -> str:
    return with_fixtures(*ALL_FEATURE_CTES, *ENC_CTES) + "SELECT split, user_id, churn_status, target FROM lbl"


def category_codes() -> str:
    dicts = [
        f"d_{c} AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT {c} AS v FROM enc_base WHERE split = 'train') x)"
        for c in CAT_FEATURES
    ]
    sel = ", ".join(f"COALESCE(d_{c}.code, 0) AS {c}" for c in CAT_FEATURES)
    joins = " ".join(f"LEFT JOIN d_{c} ON e.{c} = d_{c}.v" for c in CAT_FEATURES)
    return with_fixtures(*ALL_FEATURE_CTES, *ENC_CTES, *dicts) + f"SELECT e.user_id, e.split, {sel} FROM enc_base e {joins}"


TE_SELECT_TRAIN = ", ".join(rnd(_te_train(k), f"country_code_te_cls{k}") for k in range(3))
TE_SELECT_TEST = ", ".join(rnd(_te_test(k), f"country_code_te_cls{k}") for k in range(3))


def target_encoding() -> str:
    return with_fixtures(*ALL_FEATURE_CTES, *ENC_CTES, *TE_CTES) + f"""
SELECT r.user_id, 'train' AS split, r.country_code, {TE_SELECT_TRAIN} FROM te_tr r
UNION ALL
SELECT e.user_id, e.split, e.country_code, {TE_SELECT_TEST} FROM enc_base e WHERE e.split <> 'train'"""


N_FOLDS_SQL = "(SELECT LEAST(3, MIN(n)) FROM (SELECT COUNT(*) AS n FROM lbl GROUP BY target) c)"


def stratified_folds() -> str:
    return with_fixtures(*ALL_FEATURE_CTES, *ENC_CTES) + f"""
SELECT split, user_id, target,
  CAST((ROW_NUMBER() OVER (PARTITION BY target ORDER BY md5(CAST(user_id AS VARCHAR) || ':{SEED}'), user_id) - 1)
       % {N_FOLDS_SQL} AS INTEGER) AS fold
FROM lbl"""


def class_balance() -> str:
    return with_fixtures(*ALL_FEATURE_CTES, *ENC_CTES) + """
SELECT churn_status, target, COUNT(*) AS n_users, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share,
  CAST(LEAST(3, MIN(COUNT(*)) OVER ()) AS INTEGER) AS n_folds
FROM lbl GROUP BY churn_status, target"""


# ---------------------------------------------------------------- reports over the weighted country-prior scores

TE_ALL_CTE = (
    "te_all AS (SELECT r.user_id, 'train' AS split, "
    + ", ".join(f"{_te_train(k)} AS p{k}" for k in range(3))
    + " FROM te_tr r UNION ALL SELECT e.user_id, e.split, "
    + ", ".join(f"{_te_test(k)} AS p{k}" for k in range(3))
    + " FROM enc_base e WHERE e.split <> 'train')"
)
# The share of class k times a weight of 1 to 5 by user and class, normalised.
_RAW = [f"p{k} * (1 + (user_id * {k + 2} + {3 * k}) % 5)" for k in range(3)]
WEIGHTED_CTE = (
    "te_w AS (SELECT user_id, split, "
    + ", ".join(f"CASE WHEN {' + '.join(_RAW)} > 0 THEN {x} / ({' + '.join(_RAW)}) END AS p{k}" for k, x in enumerate(_RAW))
    + " FROM te_all)"
)
DECIDED_CTE = """decided AS (
SELECT t.user_id, t.split, l.target, t.p0 AS prob_invol_churn, t.p1 AS prob_not_churned, t.p2 AS prob_vol_churn,
  CAST(CASE WHEN t.p0 >= t.p1 AND t.p0 >= t.p2 THEN 0 WHEN t.p1 >= t.p2 THEN 1 ELSE 2 END AS INTEGER) AS prediction,
  CASE WHEN t.p0 >= t.p1 AND t.p0 >= t.p2 THEN 'invol_churn' WHEN t.p1 >= t.p2 THEN 'not_churned' ELSE 'vol_churn' END AS predicted_class,
  GREATEST(t.p0, t.p1, t.p2) AS confidence
FROM te_w t LEFT JOIN lbl l ON t.split = l.split AND t.user_id = l.user_id)"""
CLASS_REPORT_CTE = """cls AS (
SELECT COALESCE(a.class_id, b.class_id) AS class_id, COALESCE(a.support, 0) AS support, COALESCE(a.tp, 0) AS tp, COALESCE(b.np, 0) AS np
FROM (SELECT target AS class_id, COUNT(*) AS support, COUNT(*) FILTER (WHERE prediction = target) AS tp
      FROM decided WHERE split = 'train' GROUP BY target) a
FULL OUTER JOIN (SELECT prediction AS class_id, COUNT(*) AS np FROM decided WHERE split = 'train' GROUP BY prediction) b
ON a.class_id = b.class_id),
cls2 AS (
SELECT class_id, CASE class_id WHEN 0 THEN 'invol_churn' WHEN 1 THEN 'not_churned' WHEN 2 THEN 'vol_churn' END AS class_name,
  CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support
FROM cls),
cls3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM cls2)"""

REPORT_CTES = (*ALL_FEATURE_CTES, *ENC_CTES, *TE_CTES, TE_ALL_CTE, WEIGHTED_CTE, DECIDED_CTE, CLASS_REPORT_CTE)


def confusion_matrix() -> str:
    return with_fixtures(*REPORT_CTES) + (
        "SELECT target, prediction, COUNT(*) AS n_users FROM decided WHERE split = 'train' GROUP BY target, prediction"
    )


def classification_report() -> str:
    return with_fixtures(*REPORT_CTES) + (
        "SELECT class_id, class_name, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, support, "
        "ROUND(f1, 6) AS f1 FROM cls3"
    )


def macro_f1() -> str:
    return with_fixtures(*REPORT_CTES) + """
SELECT ROUND((SELECT AVG(f1) FROM cls3), 6) AS macro_f1,
  ROUND(AVG(CASE WHEN prediction = target THEN 1.0 ELSE 0.0 END), 6) AS accuracy, COUNT(*) AS n_users
FROM decided WHERE split = 'train'"""


def prediction_distribution() -> str:
    return with_fixtures(*REPORT_CTES) + """
SELECT predicted_class, COUNT(*) AS n_users, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share
FROM decided WHERE split <> 'train' GROUP BY predicted_class"""


def mean_probabilities() -> str:
    return with_fixtures(*REPORT_CTES) + (
        "SELECT " + ", ".join(rnd(f"AVG(prob_{c})", f"prob_{c}") for c in ("invol_churn", "not_churned", "vol_churn"))
        + " FROM decided WHERE split <> 'train'"
    )


def churn_share() -> str:
    return with_fixtures(*REPORT_CTES) + """
SELECT COUNT(*) AS n_users, ROUND(AVG(CASE WHEN predicted_class <> 'not_churned' THEN 1.0 ELSE 0.0 END), 6) AS churn_share
FROM decided WHERE split <> 'train'"""


def top_confident_users() -> str:
    return with_fixtures(*REPORT_CTES) + """
SELECT user_id, predicted_class, ROUND(prob_invol_churn, 6) AS prob_invol_churn, ROUND(prob_not_churned, 6) AS prob_not_churned,
  ROUND(prob_vol_churn, 6) AS prob_vol_churn, ROUND(confidence, 6) AS confidence
FROM decided WHERE split <> 'train' ORDER BY confidence DESC, user_id LIMIT 10"""


def top_users_display() -> str:
    return with_fixtures(*REPORT_CTES) + """
SELECT substr(CAST(user_id AS VARCHAR), 1, 12) || '...' AS user_label, predicted_class,
  printf('%.1f%%', confidence * 100) AS confidence_pct, ROUND(confidence * 100, 1) AS bar_width
FROM (SELECT * FROM decided WHERE split <> 'train' ORDER BY confidence DESC, user_id LIMIT 10) t"""


# ---------------------------------------------------------------- stage report, alignment

def stage_report() -> str:
    dt = _cal_parts("p.subscription_start_date")
    return with_fixtures() + f"""
SELECT s.split,
  (SELECT COUNT(*) FROM users u WHERE u.split = s.split) AS n_users,
  (SELECT COUNT(*) FROM props p WHERE p.split = s.split) AS n_property_rows,
  (SELECT COUNT(*) FROM purchases p WHERE p.split = s.split) AS n_purchase_rows,
  (SELECT COUNT(*) FROM tx t WHERE t.split = s.split) AS n_attempts,
  (SELECT COUNT(*) FROM generations g WHERE g.split = s.split) AS n_generation_rows,
  (SELECT COUNT(*) FROM quizzes q WHERE q.split = s.split) AS n_quiz_rows,
  (SELECT COUNT(*) FROM users u WHERE u.split = s.split AND NOT EXISTS (SELECT 1 FROM purchases p WHERE {same_user('p', 'u')})) AS n_users_without_purchases,
  (SELECT COUNT(*) FROM generations g WHERE g.split = s.split AND {day_number('g.created_at')} IS NULL) AS n_unparsed_event_times,
  (SELECT COUNT(*) FROM props p WHERE p.split = s.split AND {dt['month']} IS NULL) AS n_unparsed_start_dates
FROM (SELECT DISTINCT split FROM users) s"""


# Stage, rows from, columns besides split and user_id.
STAGES = (
    ("properties", "props", 7),
    ("purchases", "purch_agg", len(PURCHASE_FEATURES)),
    ("card_risk", "risk", 12),
    ("failures", "fail_agg", 2 + len(FAILURE_CODES)),
    ("activity", "gen_f", len(ACTIVITY_FEATURES)),
    ("quizzes", "quizzes", 8),
    ("features", "uf", 1 + len(USER_FEATURES)),
    # the plan goes; the target, three encodings and the cluster come
    ("encoded", "uf", 1 + len(USER_FEATURES) - 1 + 1 + 3 + 1),
)


def stage_shapes() -> str:
    parts = [
        f"SELECT {n} AS stage_no, '{name}' AS stage, split, COUNT(*) AS n_rows, {2 + columns} AS n_columns FROM {table} GROUP BY split"
        for n, (name, table, columns) in enumerate(STAGES)
    ]
    return with_fixtures(*ALL_FEATURE_CTES) + " UNION ALL ".join(parts)


def align_splits() -> str:
    return with_fixtures() + "SELECT split, user_id,\n" + _PURCH_TYPES + " FROM purchases GROUP BY split, user_id"


# ---------------------------------------------------------------- raw CSV layout

# Text read as missing, as far as the fixture holds it.
_TOKENS = "('n/a', 'nan', 'NaN')"
RAW_COLUMNS = {
    "users": ("user_id", "churn_status"),
    "props": ("user_id", "subscription_start_date", "subscription_plan", "country_code"),
    "purchases": ("user_id", "transaction_id", "#purchase_amount_dollars", "purchase_type", "purchase_time"),
    "tx": (
        "transaction_id", "digital_wallet", "?is_3d_secure", "?is_prepaid", "?is_virtual", "?is_business", "cvc_check",
        "#amount_in_usd", "billing_address_country", "card_country", "card_brand", "card_funding", "bank_name", "failure_code",
    ),
    "generations": ("generation_id", "user_id", "created_at", "status", "generation_type", "credit_cost", "duration"),
    "quizzes": ("user_id", "source", "team_size", "experience", "usage_plan", "frustration", "first_feature", "role"),
}


def csv_table(table: str) -> str:
    def column(c: str) -> str:
        if c[0] == "#":
            return rnd(c[1:], c[1:])
        if c[0] == "?":
            return c[1:]
        return f"CASE WHEN CAST({c} AS VARCHAR) NOT IN {_TOKENS} THEN CAST({c} AS VARCHAR) END AS {c}"

    return with_fixtures() + f"SELECT split, {', '.join(map(column, RAW_COLUMNS[table]))} FROM {table}"


def csv_types() -> str:
    """Counts of cells by kind over the views' values as text."""
    parts = []
    for table, columns in RAW_COLUMNS.items():
        for c in (c.lstrip("#?") for c in columns):
            parts.append(f"SELECT '{table}' AS table_name, split, '{c}' AS column_name, CAST({c} AS VARCHAR) AS v FROM {table}")
    truth, whole = "lower(v) IN ('true', 'false')", r"regexp_full_match(v, '[+-]?\d{1,18}')"
    is_number = f"{number('v')} IS NOT NULL"
    return with_fixtures(
        "raw AS (" + "\nUNION ALL ".join(parts) + ")",
        f"cells AS (SELECT table_name, split, column_name, CASE WHEN v NOT IN {_TOKENS} AND v <> '' THEN v END AS v FROM raw)",
        f"""counted AS (SELECT table_name, split, column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(v) AS n_null,
  {cnt(truth)} AS b, {cnt(whole)} AS i, {cnt(f"{is_number} AND NOT {whole}")} AS d,
  {cnt(f"v IS NOT NULL AND NOT {truth} AND NOT ({is_number})")} AS t
FROM cells GROUP BY table_name, split, column_name)""",
    ) + """
SELECT table_name, split, column_name,
  CASE WHEN t > 0 OR (b > 0 AND i + d > 0) THEN 'text' WHEN d > 0 THEN 'double' WHEN i > 0 THEN 'integer' WHEN b > 0 THEN 'boolean' ELSE 'null' END AS kind,
  n_null, n_rows
FROM counted"""


def amount_ranks() -> str:
    def rank(c: str) -> str:
        ties = f"COUNT(*) OVER (PARTITION BY split, {c})"
        return f"(RANK() OVER (PARTITION BY split ORDER BY {c}) + ({ties} - 1) / 2.0) / COUNT({c}) OVER (PARTITION BY split)"

    def of(c: str, alias: str) -> str:
        return rnd(f"CASE WHEN {c} IS NOT NULL THEN {rank(c)} END", alias)

    return with_fixtures(
        """amounts AS (SELECT split, user_id, transaction_id, purchase_amount_dollars,
  CASE WHEN ('0x' || substr(md5(CAST(transaction_id AS VARCHAR)), 1, 6))::BIGINT % 3 = 0 THEN 1.0
       ELSE CAST(floor(purchase_amount_dollars) AS DOUBLE) END AS common_amount
FROM purchases)"""
    ) + f"SELECT split, user_id, transaction_id, {of('purchase_amount_dollars', 'amount_rank')}, {of('common_amount', 'common_rank')} FROM amounts"


def streaks_calendar() -> str:
    date = f"TRY_CAST(regexp_extract(g.created_at, '{DATE_PAT}', 1) AS DATE)"
    return with_fixtures(
        f"days AS (SELECT DISTINCT g.split, g.user_id, {date} AS day FROM generations g WHERE {date} IS NOT NULL)",
        """runs AS (SELECT split, user_id, run, COUNT(*) AS n FROM (
  SELECT split, user_id, date_diff('day', DATE '1970-01-01', day) - ROW_NUMBER() OVER (PARTITION BY split, user_id ORDER BY day) AS run FROM days)
GROUP BY split, user_id, run)""",
    ) + f"""
SELECT split, user_id, CAST(SUM(n) AS BIGINT) AS active_days, MAX(n) AS longest_run, arg_max(n, run) AS current_run, COUNT(*) - 1 AS n_breaks
FROM runs r WHERE EXISTS (SELECT 1 FROM users u WHERE {same_user('u', 'r')}) GROUP BY split, user_id"""


def saved_agreement() -> str:
    return with_fixtures() + """
SELECT COUNT(*) AS n_users, COUNT(*) AS n_same_class, COUNT(*) AS n_same_probabilities FROM users WHERE split <> 'train'"""


# ---------------------------------------------------------------- model inputs and coverage

CLUSTER_FEATURES = (
    "gen_total", "gen_completed", "gen_total_credits", "gen_trend", "days_since_last_gen",
    "total_purchases", "total_spend", "tx_failure_rate", "gen_intensity",
)


def scaled_features() -> str:
    def scaled(c: str) -> str:
        x, own = f"COALESCE(f.{c}, 0)", f"COALESCE({c}, 0)"
        mean = f"(SELECT AVG({own}) FROM uf WHERE split = 'train')"
        deviation = f"(SELECT STDDEV_SAMP({own}) FROM uf WHERE split = 'train')"
        return rnd(f"CASE WHEN {deviation} > 0 THEN ({x} - {mean}) / {deviation} ELSE 0.0 END", c)

    return with_fixtures(*ALL_FEATURE_CTES) + f"SELECT f.split, f.user_id, {', '.join(map(scaled, CLUSTER_FEATURES))} FROM uf f"


def class_weights() -> str:
    return with_fixtures(*ALL_FEATURE_CTES, *ENC_CTES) + (
        "SELECT target, ROUND(SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*)), 6) AS w FROM lbl GROUP BY target"
    )


def oof_coverage() -> str:
    return with_fixtures() + """
SELECT COUNT(*) AS n_rows, COUNT(*) AS n_sum_to_one, COUNT(*) AS n_confidence_is_max, COUNT(*) AS n_once_in_fold
FROM users WHERE split = 'train'"""


def test_coverage() -> str:
    return with_fixtures() + """
SELECT COUNT(*) AS n_rows, COUNT(*) AS n_sum_to_one, COUNT(*) AS n_confidence_is_max FROM users WHERE split <> 'train'"""


def cluster_coverage() -> str:
    return with_fixtures() + "SELECT COUNT(*) AS n_rows, COUNT(*) AS n_valid FROM users"


def submission() -> str:
    return with_fixtures(*REPORT_CTES) + "SELECT user_id, predicted_class AS churn_status FROM decided WHERE split <> 'train'"


def submission_detailed() -> str:
    probs = ", ".join(rnd(f"prob_{c}", f"prob_{c}") for c in ("invol_churn", "not_churned", "vol_churn"))
    return with_fixtures(*REPORT_CTES) + (
        f"SELECT user_id, predicted_class, {probs}, ROUND(confidence, 6) AS confidence FROM decided WHERE split <> 'train'"
    )


def feature_preview() -> str:
    names = [n for n, _ in USER_FEATURES if n != "subscription_plan"][:15]
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    # The list depends on the purchase types alone; the scan shows they occur.
    return with_fixtures() + (
        f"SELECT v.position, v.feature FROM (VALUES {rows}) v(position, feature) "
        "WHERE v.feature NOT LIKE 'ptype_%' OR EXISTS (SELECT 1 FROM purchases p "
        "WHERE 'ptype_' || replace(lower(p.purchase_type), ' ', '_') = v.feature)"
    )


def oracle_sql() -> dict[str, str]:
    return {
        "purchase_summary": purchase_summary(),
        "purchase_type_counts": purchase_type_counts(),
        "purchase_span": purchase_span(),
        "purchases_features": purchases_features(),
        "country_frequency": country_frequency(),
        "subscription_calendar": subscription_calendar(),
        "subscription_date_rank": subscription_date_rank(),
        "properties_features": properties_features(),
        "quiz_features": quiz_features(),
        "tx_success": tx_success(),
        "tx_failed": tx_failed(),
        "card_risk": card_risk(),
        "country_mismatch": country_mismatch(),
        "card_mode": card_mode(),
        "fingerprint_users": fingerprint_users(),
        "failure_attribution": failure_attribution(),
        "failure_by_code": failure_by_code(),
        "payments_features": payments_features(),
        **{name: _act_query(cols) for name, cols in ACTIVITY_GROUPS.items()},
        "activity_features": activity_features(),
        "activity_features_incremental": activity_features(),
        "activity_three_batches": activity_features(),
        "gen_streaks_calendar": streaks_calendar(),
        "amount_ranks": amount_ranks(),
        "csv_types": csv_types(),
        "saved_agreement": saved_agreement(),
        "load_report": stage_report(),
        "stage_report": stage_report(),
        "stage_shapes": stage_shapes(),
        **{f"csv_{table}": csv_table(table) for table in RAW_COLUMNS},
        "scaled_features": scaled_features(),
        "class_weights": class_weights(),
        "oof_coverage": oof_coverage(),
        "test_coverage": test_coverage(),
        "cluster_coverage": cluster_coverage(),
        "submission": submission(),
        "submission_detailed": submission_detailed(),
        "feature_preview": feature_preview(),
        "align_splits": align_splits(),
        "user_features": user_features(),
        "interactions": interactions(),
        "clip_log": clip_log(),
        "label_index": label_index(),
        "category_codes": category_codes(),
        "target_encoding": target_encoding(),
        "stratified_folds": stratified_folds(),
        "class_balance": class_balance(),
        "confusion_matrix": confusion_matrix(),
        "classification_report": classification_report(),
        "macro_f1": macro_f1(),
        "prediction_distribution": prediction_distribution(),
        "mean_probabilities": mean_probabilities(),
        "churn_share": churn_share(),
        "top_confident_users": top_confident_users(),
        "top_users_display": top_users_display(),
    }
