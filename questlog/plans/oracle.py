"""Independent DuckDB SQL for every registered query (the correctness
oracle). Tables ``events`` and ``customer`` are the driver's views.

Rounded ratios are computed with exact integer arithmetic
(``(2P + Q) // (2Q)``, half away from zero), which is what the Spark side
gets from exact decimal division; a double quotient would round binary
ties differently.
"""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
PLAYER = f"CAST(user_id * 10 + {K} % 10 AS BIGINT)"

ME = f"""me AS (
  SELECT
    event_id,
    {PLAYER} AS user_id,
    {PLAYER} AS user_pseudo_id,
    CAST(ts AS DATE) AS event_date,
    ts AS event_ts,
    CASE event_type WHEN 'view' THEN 'session_start' WHEN 'click' THEN 'level_complete'
      WHEN 'error' THEN 'level_fail' WHEN 'purchase' THEN 'iap_purchase'
      WHEN 'signup' THEN 'ad_reward_claim' END AS event_name,
    CASE WHEN event_type IN ('click', 'error') THEN CAST(event_id % 20 + 1 AS BIGINT) END AS level_id,
    CASE event_type WHEN 'click' THEN 'Win' WHEN 'error' THEN 'Fail' END AS win_loss_status,
    CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) END AS gold_earned,
    CASE WHEN event_type = 'signup' THEN CAST(50 AS BIGINT) END AS gold_reward,
    CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS revenue,
    CASE WHEN event_type = 'signup' THEN CAST(value AS DECIMAL(18,2)) END AS ad_revenue,
    CASE WHEN event_type = 'purchase' THEN 'pack_' || CAST({K} % 3 AS VARCHAR) END AS pack,
    CASE WHEN event_type = 'signup' THEN 'place_' || CAST({K} % 4 AS VARCHAR) END AS placement,
    CASE WHEN event_type = 'view' THEN value END AS duration
  FROM events
)"""

UA = """ua AS (
  SELECT p.user_id, p.install_date, c.c_mktsegment AS source,
    CASE WHEN c.c_mktsegment <> 'BUILDING' THEN 'CMP_' || CAST(c.c_nationkey % 6 + 100 AS VARCHAR) END AS campaign_id,
    CASE WHEN c.c_mktsegment = 'BUILDING' THEN CAST(0 AS DECIMAL(18,2))
         ELSE CAST(abs(c.c_acctbal) / 5000 AS DECIMAL(18,2)) END AS cpi,
    'Tier ' || CAST(c.c_nationkey % 3 + 1 AS VARCHAR) AS tier
  FROM (SELECT user_id, min(event_date) AS install_date FROM me WHERE user_id IS NOT NULL GROUP BY 1) p
  JOIN customer c ON p.user_id = c.c_custkey
)"""

IAP = "iap AS (SELECT user_id, event_ts AS timestamp, revenue AS price, pack FROM me WHERE event_name = 'iap_purchase')"
ADS = (
    "ads AS (SELECT user_id, event_ts AS timestamp, ad_revenue AS revenue, placement "
    "FROM me WHERE event_name = 'ad_reward_claim')"
)
# facts limited to users of the acquisition table (all tiers chosen)
EVF = "evf AS (SELECT * FROM me WHERE user_id IN (SELECT user_id FROM ua))"
IAPF = "iapf AS (SELECT * FROM iap WHERE user_id IN (SELECT user_id FROM ua))"
ADSF = "adsf AS (SELECT * FROM ads WHERE user_id IN (SELECT user_id FROM ua))"
USERS = """users AS (
  SELECT ua.*, COALESCE(r.iap_rev, 0) AS iap_rev, COALESCE(r.ads_rev, 0) AS ads_rev,
         COALESCE(r.iap_rev, 0) + COALESCE(r.ads_rev, 0) AS total_revenue
  FROM ua LEFT JOIN (
    SELECT user_id, SUM(iap) AS iap_rev, SUM(ad) AS ads_rev FROM (
      SELECT user_id, price AS iap, CAST(0 AS DECIMAL(18,2)) AS ad FROM iap
      UNION ALL SELECT user_id, CAST(0 AS DECIMAL(18,2)), revenue FROM ads) f
    WHERE user_id IS NOT NULL GROUP BY 1) r USING (user_id)
)"""
# every user's distinct days, numbered from the user's first one
USER_DAYS = """user_days AS (
  SELECT user_pseudo_id AS u, event_date AS d, first_value(event_date) OVER first_day AS first_d,
    event_date - first_value(event_date) OVER first_day AS n
  FROM (SELECT user_pseudo_id, event_date FROM me GROUP BY ALL)
  WINDOW first_day AS (PARTITION BY user_pseudo_id ORDER BY event_date NULLS LAST))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def ratio(num: str, den: str, n: int, ns: int = 0, ds: int = 0) -> str:
    """round(num / den, n) half away from zero, NULL when den is 0 / NULL."""
    p = f"(CAST(({num}) * {10**ns} AS HUGEINT) * {10 ** (ds + n)})"
    q = f"(CAST(({den}) * {10**ds} AS HUGEINT) * {10**ns})"
    return (
        f"(CASE WHEN {q} = 0 THEN NULL ELSE "
        f"CAST(sign({p}) * ((2 * abs({p}) + {q}) // (2 * {q})) AS DOUBLE) / {10**n} END)"
    )


def money(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,2)), 2) AS DOUBLE)"


def _retention_rate(d: str, n: int) -> str:
    return f"CASE WHEN last_date - cohort_date >= {n} THEN {ratio(d, 'cohort_size', 4)} END"


ORACLE: dict[str, str] = {}

def _active_on(n: int) -> str:
    return f"count(*) FILTER (n = {n} AND u IS NOT NULL)"


ORACLE["retention_d1_d3_d7"] = with_(ME, USER_DAYS) + f"""
SELECT first_d AS cohort_date, count(DISTINCT u) AS cohort_size,
  {_active_on(1)} AS d1_retention, {_active_on(3)} AS d3_retention, {_active_on(7)} AS d7_retention
FROM user_days GROUP BY first_d"""

ORACLE["retention_rate_d1_d7_d30"] = with_(
    ME,
    USER_DAYS,
    f"""base AS (SELECT first_d AS cohort_date, count(DISTINCT u) AS cohort_size,
      {_active_on(1)} AS d1, {_active_on(7)} AS d7, {_active_on(30)} AS d30 FROM user_days GROUP BY first_d)""",
    "last AS (SELECT max(event_date) AS last_date FROM me)",
) + f"""
SELECT cohort_date, cohort_size,
  {_retention_rate('d1', 1)} AS d1_retention_rate,
  {_retention_rate('d7', 7)} AS d7_retention_rate,
  {_retention_rate('d30', 30)} AS d30_retention_rate
FROM base, last"""

ORACLE["retention_matrix"] = with_(
    ME,
    USER_DAYS,
    "cells AS (SELECT first_d AS cohort_date, CAST(n AS INTEGER) AS day_n, count(u) AS users FROM user_days WHERE d IS NOT NULL GROUP BY 1, 2)",
) + f"""
SELECT cohort_date, day_n, users,
  {ratio('users', 'first_value(users) OVER (PARTITION BY cohort_date ORDER BY day_n)', 4)} AS rate
FROM cells"""

ORACLE["economy_by_level"] = with_(ME) + f"""
SELECT level_id,
  COUNT(DISTINCT user_id) AS players_reached,
  CAST(SUM(gold_earned) AS BIGINT) AS total_gold_source,
  {ratio('SUM(gold_earned)', 'COUNT(gold_earned)', 0)} AS avg_gold_per_level,
  {ratio('SUM(gold_earned)', 'COUNT(DISTINCT user_id)', 0)} AS gold_per_user
FROM me WHERE event_name = 'level_complete' AND level_id IS NOT NULL
GROUP BY 1 ORDER BY 1"""

_SRC = (
    "CASE WHEN event_name = 'level_complete' THEN COALESCE(gold_earned, 0) ELSE 0 END"
    " + CASE WHEN event_name = 'ad_reward_claim' THEN COALESCE(gold_reward, 0) ELSE 0 END"
)
_SNK = "CASE WHEN event_name = 'level_fail' THEN 10 ELSE 0 END"

ORACLE["economy_flow"] = with_(ME) + f"""
SELECT event_date, gold_source, gold_sink, gold_source - gold_sink AS net_flow FROM (
  SELECT event_date, CAST(SUM({_SRC}) AS BIGINT) AS gold_source, CAST(SUM({_SNK}) AS BIGINT) AS gold_sink
  FROM me WHERE event_name IN ('level_complete', 'ad_reward_claim', 'level_fail') GROUP BY 1) t
ORDER BY 1"""

ORACLE["wallet_balance"] = with_(ME) + f"""
SELECT user_id, event_id, CAST(({_SRC}) - ({_SNK}) AS BIGINT) AS delta,
  CAST(SUM(({_SRC}) - ({_SNK})) OVER (PARTITION BY user_id ORDER BY event_ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS balance
FROM me"""

_SESSION_DAYS = "sd AS (SELECT DISTINCT user_pseudo_id, event_date FROM me WHERE event_name = 'session_start')"

ORACLE["dau_sessions"] = with_(ME) + """
SELECT event_date AS date, COUNT(DISTINCT user_pseudo_id) AS dau
FROM me WHERE event_name = 'session_start' GROUP BY 1 ORDER BY 1 DESC"""

ORACLE["mau_sessions"] = with_(ME) + """
SELECT CAST(date_trunc('month', event_date) AS DATE) AS month_start, COUNT(DISTINCT user_pseudo_id) AS mau
FROM me WHERE event_name = 'session_start' GROUP BY 1 ORDER BY 1 DESC"""

ORACLE["engagement_stickiness"] = with_(
    ME,
    """d AS (SELECT event_date AS date, COUNT(DISTINCT user_pseudo_id) AS dau
          FROM me WHERE event_name = 'session_start' GROUP BY 1)""",
    """m AS (SELECT CAST(date_trunc('month', event_date) AS DATE) AS month_start, COUNT(DISTINCT user_pseudo_id) AS mau
          FROM me WHERE event_name = 'session_start' GROUP BY 1)""",
) + f"""
SELECT d.date, d.dau, m.mau, {ratio('d.dau * 100', 'm.mau', 2)} AS stickiness_percent
FROM d LEFT JOIN m ON CAST(date_trunc('month', d.date) AS DATE) = m.month_start ORDER BY 1 DESC"""

_OUTCOMES = """SELECT level_id, COUNT(*) AS total_attempts,
  COUNT(*) FILTER (WHERE win_loss_status = 'Win') AS wins,
  COUNT(*) FILTER (WHERE win_loss_status = 'Fail') AS fails
FROM me WHERE event_name IN ('level_complete', 'level_fail') AND level_id IS NOT NULL GROUP BY 1"""

ORACLE["difficulty_curve"] = with_(ME, f"o AS ({_OUTCOMES})") + f"""
SELECT level_id, total_attempts, wins, fails,
  {ratio('wins', 'total_attempts', 2)} AS win_rate,
  {ratio('fails', 'total_attempts', 2)} AS fail_rate
FROM o ORDER BY 1"""

ORACLE["pinch_points"] = with_(ME, f"o AS ({_OUTCOMES})") + f"""
SELECT level_id, total_attempts, wins, fails, {ratio('wins', 'total_attempts', 4)} AS win_rate
FROM o WHERE wins < 0.48 * total_attempts AND total_attempts >= 0 ORDER BY win_rate, level_id"""

ORACLE["monetization_daily"] = with_(
    ME,
    # one row a user and day first, then one row a day
    """user_day AS (SELECT event_date, user_id, bool_or(event_name = 'iap_purchase') AS paid, SUM(revenue) AS spent FROM me GROUP BY ALL)""",
    """day AS (SELECT event_date, count(user_id) AS dau, count(user_id) FILTER (paid) AS paying_users, SUM(spent) AS total_revenue
      FROM user_day GROUP BY event_date)""",
) + f"""
SELECT event_date, dau, paying_users, {money('COALESCE(total_revenue, 0)')} AS total_revenue,
  {ratio('total_revenue', 'dau', 3, ns=2)} AS arpu,
  {ratio('total_revenue', 'paying_users', 3, ns=2)} AS arppu,
  {ratio('paying_users', 'dau', 4)} AS conversion_rate
FROM day"""

ORACLE["user_ltv"] = with_(ME) + f"""
SELECT user_id, {money('SUM(revenue)')} AS total_ltv FROM me WHERE event_name = 'iap_purchase' GROUP BY 1"""

ORACLE["installs_window"] = with_(ME, UA) + f"""
SELECT user_id, source, {money('cpi')} AS cpi, install_date FROM ua
WHERE CAST(install_date AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'"""

ORACLE["ua_roas"] = with_(
    ME,
    UA,
    "r AS (SELECT user_id, SUM(revenue) AS total_ltv FROM me WHERE event_name = 'iap_purchase' GROUP BY 1)",
    """m AS (SELECT user_id, source, cpi FROM ua
          WHERE CAST(install_date AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30')""",
    """j AS (SELECT m.source, COUNT(DISTINCT m.user_id) AS installs, SUM(m.cpi) AS spend,
            SUM(COALESCE(r.total_ltv, 0)) AS rev, COUNT(m.cpi) AS n_cpi, COUNT(*) AS n
          FROM m LEFT JOIN r ON m.user_id = r.user_id GROUP BY 1)""",
) + f"""
SELECT source, installs, {money('spend')} AS total_spend, {money('rev')} AS total_revenue,
  {ratio('spend', 'n_cpi', 2, ns=2)} AS avg_cpi, {ratio('rev', 'n', 2, ns=2)} AS arpu,
  {ratio('rev * 100', 'spend', 2, ns=2, ds=2)} AS roas_percentage
FROM j ORDER BY roas_percentage DESC NULLS LAST, source"""

ORACLE["user_revenue"] = with_(ME, UA, IAP, ADS, USERS) + f"""
SELECT user_id, install_date, source, campaign_id, tier,
  {money('cpi')} AS cpi, {money('iap_rev')} AS iap_rev, {money('ads_rev')} AS ads_rev,
  {money('total_revenue')} AS total_revenue
FROM users"""

ORACLE["tiers"] = with_(ME, UA) + "SELECT DISTINCT tier FROM ua WHERE tier IS NOT NULL ORDER BY 1"

ORACLE["tier_filtered_events"] = with_(ME, UA) + """
SELECT event_id, user_id, event_name FROM me
WHERE user_id IN (SELECT user_id FROM ua WHERE user_id IS NOT NULL AND tier IN ('Tier 1', 'Tier 3'))"""

ORACLE["reporting_period"] = with_(ME, UA) + """
SELECT min(CAST(install_date AS DATE)) AS period_start, max(CAST(install_date AS DATE)) AS period_end FROM ua"""

ORACLE["dau_any_event"] = with_(ME, UA, EVF) + """
SELECT event_date, COUNT(DISTINCT user_id) AS dau FROM evf WHERE event_date IS NOT NULL GROUP BY 1 ORDER BY 1"""

ORACLE["headline_kpis"] = with_(
    ME,
    UA,
    IAP,
    ADS,
    USERS,
    EVF,
    ADSF,
    "d AS (SELECT event_date, COUNT(DISTINCT user_id) AS dau FROM evf WHERE event_date IS NOT NULL GROUP BY 1)",
    """k AS (SELECT
      (SELECT avg(dau) FROM d) AS avg_dau,
      (SELECT SUM(total_revenue) FROM users) AS rev,
      (SELECT COUNT(*) FROM users) AS n_users,
      (SELECT SUM(CAST(duration AS DECIMAL(28,2))) FROM evf) AS dur,
      (SELECT COUNT(duration) FROM evf) AS n_dur,
      (SELECT COUNT(*) FROM adsf) AS n_ads)""",
) + f"""
SELECT CAST(trunc(avg_dau) AS INTEGER) AS avg_dau,
  {money('COALESCE(rev, 0)')} AS total_revenue,
  CASE WHEN n_users > 0 THEN {ratio('rev', 'n_users', 4, ns=2)} ELSE 0.0 END AS arpu,
  {ratio('dur', 'n_dur * 60', 4, ns=2)} AS avg_session_minutes,
  {ratio('n_ads', 'n_users', 4)} AS ads_views_per_user
FROM k"""

ORACLE["tier_distribution"] = with_(ME, UA, IAP, ADS, USERS) + """
SELECT tier, COUNT(*) AS users FROM users WHERE tier IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1"""

_MAXLVL = "ml AS (SELECT user_id, max(level_id) AS max_level FROM evf WHERE user_id IS NOT NULL GROUP BY 1)"

ORACLE["user_max_level"] = with_(ME, UA, EVF, _MAXLVL) + "SELECT user_id, max_level FROM ml"

ORACLE["level_funnel"] = with_(
    ME,
    UA,
    EVF,
    _MAXLVL,
    """f AS (SELECT lvl AS level, (SELECT COUNT(*) FROM ml WHERE max_level >= lvl) AS users
          FROM range(1, 21) t(lvl))""",
) + f"""
SELECT CAST(level AS INTEGER) AS level, 'Lvl ' || CAST(level AS VARCHAR) AS level_label, users,
  {ratio('users * 100', 'lag(users) OVER (ORDER BY level)', 2)} AS pct_previous
FROM f ORDER BY level"""

ORACLE["churn_levels"] = with_(ME, UA, EVF, _MAXLVL) + """
SELECT max_level AS level_id, COUNT(*) AS churned_users FROM ml WHERE max_level IS NOT NULL
GROUP BY 1 ORDER BY 1 LIMIT 10"""

ORACLE["level_outcomes"] = with_(ME, UA, EVF) + """
SELECT level_id,
  COUNT(*) FILTER (WHERE event_name = 'level_complete') AS level_complete,
  COUNT(*) FILTER (WHERE event_name = 'level_fail') AS level_fail
FROM evf WHERE level_id IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 20"""

ORACLE["payer_kpis"] = with_(
    ME,
    UA,
    IAP,
    ADS,
    USERS,
    """k AS (SELECT COUNT(*) FILTER (WHERE iap_rev > 0) AS paying_users, COUNT(*) AS n,
            SUM(CASE WHEN iap_rev > 0 THEN iap_rev END) AS payer_rev, SUM(cpi) AS cpi, COUNT(cpi) AS n_cpi,
            SUM(ads_rev) AS ads, SUM(total_revenue) AS total FROM users)""",
) + f"""
SELECT paying_users, {ratio('paying_users', 'n', 4)} AS payer_share,
  {ratio('payer_rev', 'paying_users', 4, ns=2)} AS arppu,
  {ratio('cpi', 'n_cpi', 4, ns=2)} AS avg_cpi,
  {ratio('ads', 'total', 4, ns=2, ds=2)} AS ads_revenue_share
FROM k"""

_DAYDIFF = (
    "CAST(floor((epoch_us(f.timestamp) - epoch_us(CAST(u.install_date AS TIMESTAMP))) / 86400000000.0) AS INTEGER)"
)

ORACLE["iap_day_diff"] = with_(ME, UA, IAP, IAPF) + f"""
SELECT f.user_id, u.tier, {_DAYDIFF} AS day_diff, {money('f.price')} AS price
FROM iapf f JOIN ua u ON f.user_id = u.user_id"""

_TIER_DAY = f"""td AS (
  SELECT u.tier, {_DAYDIFF} AS day_diff, SUM(f.rev) AS rev
  FROM (SELECT user_id, timestamp, price AS rev FROM iapf UNION ALL SELECT user_id, timestamp, revenue FROM adsf) f
  JOIN ua u ON f.user_id = u.user_id
  WHERE u.tier IS NOT NULL GROUP BY 1, 2)"""

ORACLE["revenue_by_tier_day"] = with_(ME, UA, IAP, ADS, IAPF, ADSF, _TIER_DAY) + f"""
SELECT tier, day_diff, {money('rev')} AS rev FROM td WHERE day_diff IS NOT NULL"""

ORACLE["ltv_curve"] = with_(
    ME,
    UA,
    IAP,
    ADS,
    IAPF,
    ADSF,
    _TIER_DAY,
    """ts AS (SELECT tier, COUNT(*) AS n_users, SUM(cpi) AS cpi, COUNT(cpi) AS n_cpi FROM ua
           WHERE tier IS NOT NULL GROUP BY 1)""",
    """c AS (SELECT ts.tier, d.day_diff, ts.n_users, ts.cpi, ts.n_cpi, COALESCE(td.rev, 0) AS rev,
            SUM(COALESCE(td.rev, 0)) OVER (PARTITION BY ts.tier ORDER BY d.day_diff
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
          FROM ts CROSS JOIN (SELECT CAST(range AS INTEGER) AS day_diff FROM range(0, 31)) d
          LEFT JOIN td ON td.tier = ts.tier AND td.day_diff = d.day_diff)""",
) + f"""
SELECT tier, day_diff, {money('rev')} AS rev, {money('cum')} AS cumulative_rev,
  {ratio('cum', 'n_users', 4, ns=2)} AS ltv, {ratio('cpi', 'n_cpi', 4, ns=2)} AS avg_cpi
FROM c ORDER BY tier, day_diff"""

ORACLE["revenue_by_pack"] = with_(ME, UA, IAP, IAPF) + f"""
SELECT pack, {money('SUM(price)')} AS revenue FROM iapf WHERE pack IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1"""

ORACLE["revenue_by_placement"] = with_(ME, UA, ADS, ADSF) + f"""
SELECT placement, {money('SUM(revenue)')} AS revenue FROM adsf WHERE placement IS NOT NULL GROUP BY 1 ORDER BY 1"""

ORACLE["raw_events_flatten"] = with_(ME) + f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_date, event_name, level_id, win_loss_status,
  gold_earned, {money('revenue')} AS revenue, gold_reward, placement, pack AS product_id
FROM me"""

_PARAM_ROWS = [
    ("level_id", "CAST(level_id AS BIGINT)", "NULL", "NULL"),
    ("status", "NULL", "NULL", "win_loss_status"),
    ("gold_earned", "gold_earned", "NULL", "NULL"),
    ("gold_reward", "gold_reward", "NULL", "NULL"),
    ("price", "NULL", "CAST(revenue AS DOUBLE)", "NULL"),
    ("ad_revenue", "NULL", "CAST(ad_revenue AS DOUBLE)", "NULL"),
    ("product_id", "NULL", "NULL", "pack"),
    ("placement", "NULL", "NULL", "placement"),
    ("duration", "NULL", "duration", "NULL"),
]
_PARAM_SOURCE = {
    "level_id": "level_id",
    "status": "win_loss_status",
    "gold_earned": "gold_earned",
    "gold_reward": "gold_reward",
    "price": "revenue",
    "ad_revenue": "ad_revenue",
    "product_id": "pack",
    "placement": "placement",
    "duration": "duration",
}

ORACLE["params_exploded"] = with_(ME) + "\nUNION ALL\n".join(
    f"""SELECT event_id, '{key}' AS key, CAST({i} AS BIGINT) AS int_value, CAST({f} AS DOUBLE) AS float_value,
  CAST(NULL AS DOUBLE) AS double_value, CAST({s} AS VARCHAR) AS string_value
FROM me WHERE {_PARAM_SOURCE[key]} IS NOT NULL"""
    for key, i, f, s in _PARAM_ROWS
)

ORACLE["events_since"] = with_(ME) + """
SELECT event_id, strftime(event_date, '%Y%m%d') AS event_date FROM me
WHERE strftime(event_date, '%Y%m%d') >= '20240115'"""

ORACLE["stream_dau_exact"] = ORACLE["dau_sessions"]

ORACLE["stream_economy_daily"] = with_(ME) + """
SELECT CAST(event_ts AS DATE) AS date, CAST(SUM(revenue) AS DOUBLE) AS revenue,
  CAST(SUM(COALESCE(gold_earned, 0) + COALESCE(gold_reward, 0)) AS BIGINT) AS gold_source,
  CAST(SUM(CASE WHEN event_name = 'level_fail' THEN 10 ELSE 0 END) AS BIGINT) AS gold_sink
FROM me GROUP BY 1"""

ORACLE["flat_events_csv"] = with_(ME) + f"""
SELECT event_date, event_name, CAST(user_id AS VARCHAR) AS user_id, level_id, win_loss_status, gold_earned,
  {money('revenue')} AS revenue, pack AS product_id
FROM me"""

ORACLE["acquisition_csv"] = with_(ME, UA) + f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, install_date, source, campaign_id, {money('cpi')} AS cpi, tier FROM ua"""

ORACLE["raw_log_files"] = with_(ME) + f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, event_date, event_name, level_id, win_loss_status, gold_earned,
  {money('revenue')} AS revenue, gold_reward, placement, pack AS product_id
FROM me"""

ORACLE["param_lookup"] = with_(ME) + """
SELECT event_id, CAST(level_id AS BIGINT) AS level_id, CAST(revenue AS DOUBLE) AS price,
  win_loss_status AS status, CAST(NULL AS VARCHAR) AS missing
FROM me"""

ORACLE["params_roundtrip"] = with_(ME) + f"""
SELECT event_id, level_id, win_loss_status, gold_earned, gold_reward, {money('revenue')} AS revenue,
  {money('ad_revenue')} AS ad_revenue, pack, placement, duration
FROM me"""

ORACLE["stream_level_outcomes_daily"] = with_(ME) + """
SELECT CAST(event_ts AS DATE) AS date, level_id, COUNT(*) AS attempts,
  COUNT(*) FILTER (WHERE win_loss_status = 'Win') AS wins
FROM me WHERE event_name IN ('level_complete', 'level_fail') AND level_id IS NOT NULL GROUP BY 1, 2"""


# ---- whole results beside the reports' first rows -------------------------------

ORACLE["churn_levels_all"] = ORACLE["churn_levels"].replace("LIMIT 10", "")
ORACLE["level_outcomes_all"] = ORACLE["level_outcomes"].replace("LIMIT 20", "")
ORACLE["level_funnel_all"] = ORACLE["level_funnel"].replace(
    "FROM range(1, 21) t(lvl)", "FROM range(1, (SELECT max(max_level) + 1 FROM ml)) t(lvl)"
)
ORACLE["ltv_curve_all_days"] = ORACLE["ltv_curve"].replace(
    "CROSS JOIN (SELECT CAST(range AS INTEGER) AS day_diff FROM range(0, 31)) d",
    """JOIN (SELECT tier, CAST(unnest(range(0, last + 1)) AS INTEGER) AS day_diff
            FROM (SELECT tier, greatest(coalesce(max(day_diff), 0), 0) AS last FROM td GROUP BY 1)) d ON d.tier = ts.tier""",
)
ORACLE["ltv_revenue_outside"] = with_(ME, UA, IAP, ADS, IAPF, ADSF, _TIER_DAY) + f"""
SELECT tier, {money('coalesce(SUM(rev) FILTER (day_diff < 0), 0)')} AS before_install,
  {money('coalesce(SUM(rev) FILTER (day_diff > 30), 0)')} AS after_last_day
FROM td WHERE day_diff IS NOT NULL GROUP BY 1"""
ORACLE["economy_flow_by_level"] = with_(ME) + f"""
SELECT event_date, level_id, gold_source, gold_sink, gold_source - gold_sink AS net_flow FROM (
  SELECT event_date, level_id, CAST(SUM({_SRC}) AS BIGINT) AS gold_source, CAST(SUM({_SNK}) AS BIGINT) AS gold_sink
  FROM me WHERE event_name IN ('level_complete', 'ad_reward_claim', 'level_fail') GROUP BY 1, 2) t"""
ORACLE["revenue_by_user"] = with_(ME) + f"""
SELECT user_id, {money('SUM(revenue)')} AS revenue FROM me
WHERE event_name = 'iap_purchase' AND user_id IS NOT NULL GROUP BY 1"""

# ---- runs that start from files ---------------------------------------------------

ORACLE["iap_csv"] = with_(ME, IAP) + f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, timestamp, {money('price')} AS price, pack FROM iap"""
ORACLE["ads_csv"] = with_(ME, ADS) + f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, timestamp, {money('revenue')} AS revenue, placement FROM ads"""
ORACLE["log_user_revenue"] = ORACLE["files_user_revenue"] = ORACLE["user_revenue"].replace(
    "SELECT user_id, install_date, source", "SELECT CAST(user_id AS VARCHAR) AS user_id, install_date, source"
)
ORACLE["files_revenue_by_tier_day"] = ORACLE["revenue_by_tier_day"]
ORACLE["log_headline_kpis"] = ORACLE["headline_kpis"]
ORACLE["log_ltv_curve"] = ORACLE["ltv_curve"]
ORACLE["log_wallet_balance"] = ORACLE["wallet_balance"].replace(
    "SELECT user_id, event_id,", "SELECT CAST(user_id AS VARCHAR) AS user_id, event_ts,"
)
ORACLE["log_quarantine"] = """
SELECT 'events' AS side, count(*) AS n FROM events
UNION ALL SELECT 'quarantine', 5 * count(*) FILTER (event_id % 100 = 0) FROM events"""
ORACLE["nested_structs"] = with_(ME) + """
SELECT event_id, CAST(c_nationkey AS VARCHAR) AS country, c_name AS city, c_mktsegment AS os,
  CASE WHEN c_custkey IS NOT NULL THEN 'mobile' END AS device_category
FROM me LEFT JOIN customer ON user_id = c_custkey"""
ORACLE["mart_replaced_day"] = ORACLE["economy_flow"]
ORACLE["views_sql"] = with_(ME, UA) + """
SELECT ua.source, event_name, count(*) AS events, count(DISTINCT me.user_id) AS users
FROM me JOIN ua ON me.user_id = ua.user_id GROUP BY 1, 2"""
ORACLE["stream_pinch_alert"] = with_(ME) + """
SELECT event_date AS date, level_id, COUNT(*) AS attempts, COUNT(*) FILTER (win_loss_status = 'Win') AS wins
FROM me WHERE event_name IN ('level_complete', 'level_fail') AND level_id IS NOT NULL
GROUP BY 1, 2 HAVING wins < 0.48 * attempts"""
ORACLE["stream_dau_approx"] = with_(ME) + """
SELECT DISTINCT event_date AS date, TRUE AS within_bound FROM me WHERE event_name = 'session_start'"""

# ---- what is kept up to date -------------------------------------------------------

ORACLE["bitmap_dau"] = ORACLE["dau_sessions"]
ORACLE["bitmap_mau"] = ORACLE["mau_sessions"]
ORACLE["bitmap_stickiness"] = ORACLE["engagement_stickiness"]
ORACLE["bitmap_dau_any_event"] = ORACLE["dau_any_event"]
ORACLE["bitmap_rolling_users"] = with_(ME, _SESSION_DAYS, "span AS (SELECT unnest(range(min(event_date), max(event_date) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM sd)") + """
SELECT CAST(d AS DATE) AS date, count(DISTINCT user_pseudo_id) AS users
FROM span JOIN sd ON event_date BETWEEN CAST(d AS DATE) - 6 AND CAST(d AS DATE) GROUP BY 1"""
ORACLE["sketch_active_users"] = with_(ME, _SESSION_DAYS) + """
SELECT DISTINCT 'day' AS span, event_date AS period, TRUE AS within_bound FROM sd
UNION ALL SELECT DISTINCT 'month', CAST(date_trunc('month', event_date) AS DATE), TRUE FROM sd"""
ORACLE["words_retention"] = ORACLE["retention_d1_d3_d7"]
ORACLE["words_retention_rates"] = ORACLE["retention_rate_d1_d7_d30"]
ORACLE["words_retention_matrix"] = ORACLE["retention_matrix"]
ORACLE["states_difficulty"] = ORACLE["difficulty_curve"]
ORACLE["states_monetization"] = ORACLE["monetization_daily"]
ORACLE["states_economy_flow"] = ORACLE["economy_flow"]
ORACLE["states_economy_flow_by_level"] = ORACLE["economy_flow_by_level"]
ORACLE["ingested_events"] = ORACLE["raw_events_flatten"]
ORACLE["stream_wallet_balance"] = ORACLE["log_wallet_balance"]
# four arrivals by day, every 10th event an arrival late and every 50th two; two days of delay
ORACLE["stream_late_rows"] = with_(
    ME,
    "bounds AS (SELECT min(event_date) AS lo, (max(event_date) - min(event_date) + 1 + 3) // 4 AS span, max(event_date) AS hi FROM me)",
    """arrived AS (SELECT event_date, least((event_date - lo) // span
        + CASE WHEN event_id % 50 = 0 THEN 2 WHEN event_id % 10 = 0 THEN 1 ELSE 0 END, 3) AS arrival FROM me, bounds)""",
    "tops AS (SELECT arrival, max(event_date) AS top FROM arrived GROUP BY 1)",
    """marks AS (SELECT arrival, max(top) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 2 AS mark
        FROM tops)""",
    "judged AS (SELECT event_date, coalesce(event_date + 1 <= mark, FALSE) AS late FROM arrived JOIN marks USING (arrival))",
) + """
SELECT event_date AS date, count(*) FILTER (NOT late) AS on_time, count(*) FILTER (late) AS late,
  CASE WHEN event_date + 1 <= (SELECT hi FROM bounds) - 2 AND count(*) FILTER (NOT late) > 0 THEN count(*) FILTER (NOT late) END AS emitted
FROM judged GROUP BY 1"""

# ---- the reports as SQL functions ----------------------------------------------------

ORACLE["sql_retention"] = ORACLE["retention_d1_d3_d7"]
ORACLE["sql_economy"] = ORACLE["economy_by_level"]
ORACLE["sql_engagement"] = ORACLE["engagement_stickiness"]
ORACLE["sql_difficulty"] = ORACLE["difficulty_curve"]
ORACLE["sql_monetization"] = ORACLE["monetization_daily"]
ORACLE["sql_ua_roas"] = ORACLE["ua_roas"]

# ---- tables bucketed by user -----------------------------------------------------------

ORACLE["bucketed_ua_roas"] = ORACLE["ua_roas"]
ORACLE["bucketed_user_revenue"] = ORACLE["user_revenue"]
ORACLE["bucketed_revenue_by_tier_day"] = ORACLE["revenue_by_tier_day"]

# ---- parameters that drift -------------------------------------------------------------

_KINDS = {"level_id": "CASE WHEN event_id % 2 = 0 THEN 'STRING' ELSE 'BIGINT' END", "gold_earned": "'BIGINT'", "gold_reward": "'BIGINT'",
          "price": "'NUMBER'", "ad_revenue": "'NUMBER'", "duration": "'NUMBER'"}
ORACLE["param_inventory"] = with_(ME) + "SELECT key, type, count(*) AS events, key <> 'clan' AS known FROM (\n" + "\nUNION ALL ".join(
    f"SELECT '{key}' AS key, {_KINDS.get(key, chr(39) + 'STRING' + chr(39))} AS type FROM me WHERE {column} IS NOT NULL" for key, column in _PARAM_SOURCE.items()
) + "\nUNION ALL SELECT 'clan', 'STRING' FROM me WHERE event_id % 3 = 0) GROUP BY ALL"
ORACLE["drifting_params"] = with_(ME) + """
SELECT event_id, level_id, CASE WHEN event_id % 3 = 0 THEN 'c' || event_id % 5 END AS clan, gold_earned, win_loss_status AS status FROM me"""
ORACLE["tier_filtered_untagged"] = ORACLE["tier_filtered_events"]
