"""Oracle SQL: each registered job restated in plain SQL for DuckDB over the driver tables.

Only the driver's base tables exist on the oracle side, so every text inlines the domain
views as CTEs.  The SQL follows the reference's own formulation (join first, then group),
not the Spark plan, so the two sides are independent.  Integer results are cast to BIGINT
because DuckDB sums and counts in HUGEINT.
"""

from __future__ import annotations

# ---------------------------------------------------------------- domain views (CTEs)

ACTIVITY = r"""
activity AS (
  SELECT event_id, user_id AS account_key, ts AS activity_ts, CAST(ts AS DATE) AS activity_date,
    CASE CAST(event_id % 8 AS INTEGER)
      WHEN 0 THEN 'customer-' || lpad(CAST(user_id AS VARCHAR), 9, '0')
      WHEN 1 THEN '"CUSTOMER ' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '" '
      WHEN 2 THEN '' WHEN 3 THEN ' none '
      WHEN 4 THEN 'pizza ' || CAST(user_id AS VARCHAR) || '.com'
      WHEN 5 THEN 'customer 00000 shop'
      WHEN 6 THEN 'custmer ' || lpad(CAST(user_id AS VARCHAR), 9, '0')
      ELSE '-' END AS keywords,
    event_id % 7 AS heading_id, event_id % 25 AS directory_id, event_id % 3 AS referer_id,
    CAST(event_id % 5 AS INTEGER) AS click_type_id, event_type,
    CASE WHEN event_type = 'view' THEN value ELSE CAST(0 AS DOUBLE) END AS impression_weight,
    CASE WHEN event_type = 'click' THEN value ELSE CAST(0 AS DOUBLE) END AS click_weight,
    event_id % 2 = 1 AS is_mobile,
    's' || CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id
  FROM events)"""

ACCOUNT = r"""
account AS (
  SELECT c_custkey AS account_key, 'A' || CAST(c_custkey AS VARCHAR) AS account_id,
         replace(c_name, '#', ' ') AS account_name, c_nationkey AS location_key
  FROM customer)"""

AWKWARD_ACCOUNT = r"""
account AS (
  SELECT c_custkey AS account_key, 'A' || CAST(c_custkey AS VARCHAR) AS account_id, c_nationkey AS location_key,
    CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CASE CAST(c_custkey % 8 AS INTEGER)
      WHEN 0 THEN '  ' || replace(c_name, '#', ' ') || ' '
      WHEN 1 THEN 'the "' || replace(c_name, '#', ' ') || '", best'
      WHEN 2 THEN replace(c_name, '#', ' ') || chr(9) || replace(c_name, '#', ' ')
      WHEN 3 THEN replace(c_name, '#', ' ') || chr(13) || chr(10) || '2nd line'
      WHEN 4 THEN '' WHEN 5 THEN 'c:\new\' || replace(c_name, '#', ' ')
      ELSE replace(c_name, '#', ' ') END END AS account_name
  FROM customer)"""

LOCATION = r"""
location AS (
  SELECT n_nationkey AS location_key, n_name AS location_city, 'Z' || CAST(n_regionkey AS VARCHAR) AS location_zip_code
  FROM nation WHERE n_nationkey <> 3)"""

CLICK_TYPE = r"""
click_type AS (
  SELECT * FROM (VALUES (1, 'contact_submit'), (2, 'free_call'), (3, 'banner_view'), (4, 'share_confirm'))
    AS t(click_type_id, name))"""

BRIDGE = r"""
account_bridge AS (
  SELECT 'P' || CAST(c_nationkey AS VARCHAR) AS parent_account_id,
         CASE WHEN c_custkey % 373 = 0 THEN 'X' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END AS child_account_id,
         CASE WHEN c_custkey % 419 = 0 THEN 'K' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END AS child_account_key
  FROM customer)"""

PHONE_LEAD = r"""
phone_lead AS (
  SELECT o_orderkey AS phone_lead_id, o_custkey AS account_key,
         o_orderdate + to_seconds(o_orderkey % 86400) AS created_datetime
  FROM orders)"""

PHONE_REPORT = r"""
phone_report AS (
  SELECT o_orderkey AS phone_lead_id,
         CAST(CAST(o_orderdate + to_seconds(o_orderkey % 86400) AS DATE) AS VARCHAR) AS phone_lead_date,
         strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%H:%M:%S') AS phone_lead_time,
         CAST(o_custkey AS VARCHAR) AS merchant_id, 'A' || CAST(o_custkey AS VARCHAR) AS cust_account_id,
         o_orderpriority AS zone, CAST(o_orderkey % 600 AS VARCHAR) AS duration, o_orderstatus AS answer_status
  FROM orders WHERE NOT (o_totalprice > 497000))"""

ONLINE_REPORT = r"""
online_report AS (
  SELECT a.event_id, CAST(a.activity_date AS VARCHAR) AS date_day, CAST(a.account_key AS VARCHAR) AS merchant_id,
         'A' || CAST(a.account_key AS VARCHAR) AS cust_account_id,
         CASE WHEN a.event_type IN ('view', 'error') THEN '1' ELSE '0' END AS impressions,
         coalesce(c.name, 'other') AS click_type_name,
         CASE WHEN a.event_type IN ('click', 'error') THEN '1' ELSE '0' END AS clicks,
         CASE WHEN a.event_id % 17 = 0 THEN '' WHEN a.event_id % 19 = 0 THEN 'Tablet'
              WHEN a.is_mobile THEN 'Mobile' ELSE 'Desktop' END AS platform,
         a.keywords AS keyword
  FROM activity a LEFT JOIN click_type c ON a.click_type_id = c.click_type_id
  WHERE a.click_type_id <> 3 AND NOT (a.impression_weight + a.click_weight > 300))"""

ACTIVITY_LINES = r"""
activity_lines AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN 'x,y,' || CAST(account_key AS VARCHAR)
    ELSE '"' || CAST(event_id AS VARCHAR) || '",s,"'
      || CASE WHEN event_id % 89 = 0 THEN 'bad' ELSE CAST(account_key AS VARCHAR) END
      || '","' || CAST(activity_date AS VARCHAR) || '","' || CAST(event_id % 7 AS VARCHAR)
      || '","' || CAST(event_id % 25 AS VARCHAR) || '",r,"' || CAST(event_id % 3 AS VARCHAR) || '",a,b,c,d,'
      || CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE CAST(event_id % 10 AS VARCHAR) END
      || ',' || CAST(event_id % 4 AS VARCHAR) || ',e,"' || CAST(event_id % 2 AS VARCHAR) || '",f,"' || event_type || '"'
    END AS line
  FROM activity)"""

ACCOUNT_LINES = r"""
account_lines AS (
  SELECT c_custkey AS record_id,
    CASE WHEN c_custkey % 13 = 0 THEN CAST(c_custkey AS VARCHAR) || ';' || c_mktsegment
    ELSE CASE CAST(c_custkey % 8 AS INTEGER) WHEN 6 THEN '"' || CAST(c_custkey AS VARCHAR) || '"'
                                 WHEN 7 THEN 'k' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END
      || ';' || c_mktsegment || ';A' || CAST(c_custkey AS VARCHAR) || ';' || c_name || ';'
      || CASE CAST(c_custkey % 8 AS INTEGER) WHEN 0 THEN 'MERCHANT' WHEN 1 THEN '"MERCHANT"' WHEN 2 THEN ''
              WHEN 3 THEN '""' WHEN 4 THEN ' client ' WHEN 5 THEN 'AGENCY' WHEN 6 THEN 'CLIENT' ELSE 'MERCHANT' END
    END AS line
  FROM customer)"""

EXTRACT_LINES = r"""
extract_parts AS (
  SELECT event_id, account_key,
    CASE WHEN event_id % 103 = 0 THEN 'key' || CAST(account_key AS VARCHAR)
         WHEN event_id % 5 = 0 THEN '"' || CAST(account_key AS VARCHAR) || '"' ELSE CAST(account_key AS VARCHAR) END
    || ';m;m;m;m;' || CASE WHEN event_id % 107 = 0 THEN '' ELSE CAST(directory_id AS VARCHAR) END || ';m;m;m;m;m;m;' AS head,
    CASE WHEN event_id % 211 = 0 THEN '3e30' WHEN event_id % 223 = 0 THEN '9000000000000000000'
         WHEN event_id % 227 = 0 THEN '0.25000000000001' WHEN event_id % 11 = 0 THEN 'n/a'
         ELSE CAST(impression_weight AS VARCHAR) END || ';'
    || CASE WHEN event_id % 229 = 0 THEN '-3e30' WHEN event_id % 13 = 0 THEN '' ELSE CAST(click_weight AS VARCHAR) END AS own
  FROM activity),
extract_lines AS (
  SELECT event_id AS record_id, CASE WHEN event_id % 101 = 0 THEN CAST(account_key AS VARCHAR) || ';m;m' ELSE head || own END AS line
  FROM extract_parts
  UNION ALL SELECT event_id, head || unnest(['1e60;-1.5e308', '-1e60;1.5e308']) FROM extract_parts WHERE event_id % 53 = 4
  UNION ALL SELECT event_id, head || unnest(['-1e60;7e40', '1e60;']) FROM extract_parts
            WHERE event_id % 59 = 6 AND event_id % 53 <> 4)"""


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views)


# ---------------------------------------------------------------- reusable SQL expressions

def clean(x: str) -> str:
    """Drop double quotes, strip characters <= U+0020 at both ends."""
    return rf"""regexp_replace(replace({x}, '"', ''), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"""


def norm_term(x: str) -> str:
    cut = (f"CASE WHEN suffix({x}, '.ca') THEN left({x}, length({x}) - 3) "
           f"WHEN suffix({x}, '.com') THEN left({x}, length({x}) - 4) ELSE {x} END")
    return f"upper(replace(replace(replace({cut}, '-', ''), ' ', ''), '''', ''))"


def norm_name(x: str) -> str:
    return f"upper(replace(replace(replace({x}, '-', ''), ' ', ''), '''', ''))"


def match(t: str, n: str) -> str:
    """t, n: normalised term and name."""
    return (f"coalesce(contains({n}, {t}) OR (length({t}) >= 10 AND contains({n}, left({t}, length({t}) // 2)))"
            f" OR levenshtein({t}, {n}) <= length({t}) // 3, false)")


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


# ---------------------------------------------------------------- job oracles

HEADING_DIRECTORY_PROFILE = with_views(ACTIVITY, ACCOUNT) + f""",
joined AS (
  SELECT a.heading_id, a.directory_id, {clean('a.keywords')} AS term, {clean('c.account_name')} AS name
  FROM activity a JOIN account c ON a.account_key = c.account_key),
normalised AS (SELECT *, {norm_term('term')} AS t, {norm_name('name')} AS n FROM joined)
SELECT heading_id, directory_id,
  {big('count(*)')} AS queries_total,
  {big(f"count_if({match('t', 'n')})")} AS queries_by_name,
  {big("count_if(term = '')")} AS queries_empty,
  {big("count_if(upper(term) = 'NONE')")} AS queries_none
FROM normalised GROUP BY heading_id, directory_id"""

MERCHANT_PROFILE = with_views(ACTIVITY, ACCOUNT) + f""",
per_day AS (
  SELECT c.account_key, {clean('c.account_id')} AS account_id, {clean('c.account_name')} AS account_name,
         a.activity_date, min({clean('a.keywords')}) AS term
  FROM account c JOIN activity a ON c.account_key = a.account_key
  GROUP BY 1, 2, 3, 4),
normalised AS (SELECT *, {norm_term('term')} AS t, {norm_name('account_name')} AS n FROM per_day)
SELECT account_key, account_id, account_name,
  {big('count(*)')} AS queries_total,
  {big(f"count_if({match('t', 'n')})")} AS queries_by_name,
  {big("count_if(term = '')")} AS queries_empty,
  {big("count_if(upper(term) = 'NONE')")} AS queries_none
FROM normalised GROUP BY account_key, account_id, account_name"""

NON_NAME_SHARE = with_views(ACTIVITY, ACCOUNT, LOCATION) + r""",
searched AS (
  SELECT account_key, count(*) AS searches,
         count(*) FILTER (WHERE upper(replace(replace(keywords, '-', ''), ' ', ''))
                                <> upper(replace(replace(account_name, chr(39), ''), ' ', ''))) AS other_searches
  FROM activity JOIN account USING (account_key) JOIN location USING (location_key)
  WHERE activity_ts >= TIMESTAMP '2024-01-11 00:00:00' GROUP BY account_key),
described AS (
  SELECT account_key, account_id, account_name, location_city, location_zip_code,
         row_number() OVER (PARTITION BY account_key ORDER BY account_id NULLS LAST, account_name NULLS LAST,
                            location_city NULLS LAST, location_zip_code NULLS LAST) AS nth
  FROM account JOIN location USING (location_key))
SELECT s.account_key, d.account_id, d.account_name, d.location_city, d.location_zip_code,
       CAST(s.searches AS BIGINT) AS total_count, CAST(nullif(s.other_searches, 0) AS BIGINT) AS per_category_count,
       CAST(nullif(s.other_searches, 0) AS DOUBLE) / CAST(s.searches AS DOUBLE) AS category_proportion
FROM searched s JOIN described d ON d.account_key = s.account_key AND d.nth = 1"""

NAME_MATCH_FLAGS = with_views(ACTIVITY, ACCOUNT) + f""",
pairs AS (
  SELECT DISTINCT {clean('a.keywords')} AS term, {clean('c.account_name')} AS name
  FROM activity a JOIN account c ON a.account_key = c.account_key),
nm AS (SELECT term, name, {norm_term('term')} AS t, {norm_name('name')} AS n FROM pairs)
SELECT term, name, t, n,
  coalesce(contains(n, t), false) AS by_contains,
  coalesce(length(t) >= 10 AND contains(n, left(t, length(t) // 2)), false) AS by_half_prefix,
  coalesce(levenshtein(t, n) <= length(t) // 3, false) AS by_edit_distance,
  {match('t', 'n')} AS matched
FROM nm"""

EDIT_DISTANCE_PROFILE = with_views(ACTIVITY, ACCOUNT) + f""",
pairs AS (
  SELECT DISTINCT a.account_key, {clean('a.keywords')} AS term, {clean('c.account_name')} AS name
  FROM activity a JOIN account c ON a.account_key = c.account_key)
SELECT account_key, CAST(levenshtein({norm_term('term')}, {norm_name('name')}) AS INTEGER) AS edit_distance,
       {big('count(*)')} AS pairs
FROM pairs GROUP BY 1, 2"""


ORACLES: dict[str, str] = {
    "heading_directory_profile": HEADING_DIRECTORY_PROFILE,
    "merchant_profile": MERCHANT_PROFILE,
    "non_name_share": NON_NAME_SHARE,
    "name_match_flags": NAME_MATCH_FLAGS,
    "edit_distance_profile": EDIT_DISTANCE_PROFILE,
}


# ---------------------------------------------------------------- ingest oracles

def java_trim(x: str) -> str:
    return rf"""regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"""


ACTIVITY_FIELDS = with_views(ACTIVITY, ACTIVITY_LINES) + f""",
parsed AS (SELECT event_id, string_split(line, ',') AS p FROM activity_lines),
f AS (
  SELECT event_id, len(p) AS n_fields,
    TRY_CAST({clean('p[3]')} AS BIGINT) AS account_key, {clean('p[4]')} AS date_text,
    TRY_CAST({clean('p[5]')} AS BIGINT) AS heading_id, TRY_CAST({clean('p[6]')} AS BIGINT) AS directory_id,
    TRY_CAST({clean('p[8]')} AS BIGINT) AS referer_id,
    coalesce(TRY_CAST({clean('p[13]')} AS DOUBLE), CAST(0 AS DOUBLE)) AS impression_weight,
    coalesce(TRY_CAST({clean('p[14]')} AS DOUBLE), CAST(0 AS DOUBLE)) AS click_weight,
    TRY_CAST({clean('p[16]')} AS BIGINT) AS mobile_number, {clean('p[18]')} AS keywords
  FROM parsed),
tagged AS (
  SELECT *, CASE WHEN n_fields < 18 THEN 'short_row'
                 WHEN account_key IS NULL OR heading_id IS NULL OR directory_id IS NULL OR referer_id IS NULL
                      OR mobile_number IS NULL THEN 'bad_number' END AS reason
  FROM f)"""

ACTIVITY_INGEST = ACTIVITY_FIELDS + """
SELECT event_id, account_key, keywords, date_text, heading_id, directory_id, referer_id,
       impression_weight, click_weight, mobile_number = 1 AS is_mobile
FROM tagged WHERE reason IS NULL"""

ACTIVITY_REJECTS = ACTIVITY_FIELDS + """
SELECT event_id, reason FROM tagged WHERE reason IS NOT NULL"""

ACCOUNT_FIELDS = with_views(ACCOUNT_LINES) + f""",
parsed AS (SELECT record_id, string_split(line, ';') AS p FROM account_lines),
f AS (
  SELECT record_id, len(p) AS n_fields, TRY_CAST({clean('p[1]')} AS BIGINT) AS account_key,
         p[3] AS account_id, p[4] AS account_name, replace(upper({java_trim('p[5]')}), '"', '') AS vertical
  FROM parsed),
tagged AS (
  SELECT *, CASE WHEN n_fields < 5 THEN 'short_row' WHEN account_key IS NULL THEN 'bad_number'
                 WHEN vertical NOT IN ('MERCHANT', '', 'CLIENT') THEN 'other_vertical' END AS reason
  FROM f)"""

ACCOUNT_INGEST = ACCOUNT_FIELDS + """
SELECT record_id, account_key, account_id, account_name, vertical FROM tagged WHERE reason IS NULL"""

ACCOUNT_REJECTS = ACCOUNT_FIELDS + """
SELECT record_id, reason FROM tagged WHERE reason IS NOT NULL"""


EXTRACT_FIELDS = with_views(ACTIVITY, ACCOUNT, EXTRACT_LINES) + f""",
parsed AS (SELECT record_id, string_split(line, ';') AS p FROM extract_lines),
f AS (
  SELECT record_id, len(p) AS n_fields, TRY_CAST({clean('p[1]')} AS BIGINT) AS account_key,
         TRY_CAST({clean('p[6]')} AS BIGINT) AS directory_id, {clean('p[13]')} AS impressions, {clean('p[14]')} AS clicks
  FROM parsed)"""

# Amounts below 1e24 are summed by their decimal digits.  The others are counted per size, those of opposite
# signs against each other; the largest size that is left decides, since the sizes lie far apart.
MONTHLY_TOTALS = EXTRACT_FIELDS + """,
placed AS (
  SELECT c.account_id, u.account_key, u.directory_id, u.measure, u.txt,
         coalesce(CASE WHEN isfinite(TRY_CAST(u.txt AS DOUBLE)) THEN TRY_CAST(u.txt AS DOUBLE) END, CAST(0 AS DOUBLE)) AS x
  FROM (SELECT *, unnest(['imp', 'clk']) AS measure, unnest([impressions, clicks]) AS txt FROM f
        WHERE n_fields >= 14 AND account_key IS NOT NULL AND directory_id IS NOT NULL) u
  JOIN account c ON c.account_key = u.account_key),
near AS (
  SELECT account_id, account_key, directory_id, measure,
         floor(sum(CASE WHEN abs(x) < 1e24 THEN coalesce(TRY_CAST(txt AS DECIMAL(38,12)), 0) ELSE 0 END)
               + CAST(0.5 AS DECIMAL(2,1))) AS total
  FROM placed GROUP BY ALL),
sizes AS (
  SELECT account_id, account_key, directory_id, measure, abs(x) AS size, sum(sign(x)) AS net
  FROM placed WHERE abs(x) >= 1e24 GROUP BY ALL HAVING sum(sign(x)) <> 0),
far AS (
  SELECT account_id, account_key, directory_id, measure, arg_max(sign(net), size) AS side FROM sizes GROUP BY ALL),
both_ AS (
  SELECT n.account_id, n.account_key, n.directory_id, n.measure,
         CASE WHEN f.side > 0 OR (f.side IS NULL AND n.total >= 9223372036854775807) THEN 9223372036854775807
              WHEN f.side < 0 OR (f.side IS NULL AND n.total <= -9223372036854775807) THEN -9223372036854775807 - 1
              ELSE CAST(n.total AS BIGINT) END AS total
  FROM near n LEFT JOIN far f ON f.account_id = n.account_id AND f.account_key = n.account_key
                             AND f.directory_id = n.directory_id AND f.measure = n.measure)
SELECT account_id, account_key, directory_id, CAST(max(total) FILTER (WHERE measure = 'imp') AS BIGINT) AS impressions,
       CAST(max(total) FILTER (WHERE measure = 'clk') AS BIGINT) AS clicks
FROM both_ GROUP BY 1, 2, 3"""

EXTRACT_REJECTS = EXTRACT_FIELDS + """
SELECT record_id, CASE WHEN n_fields < 14 THEN 'short_row' ELSE 'bad_number' END AS reason
FROM f WHERE n_fields < 14 OR account_key IS NULL OR directory_id IS NULL"""

ORACLES.update({
    "activity_ingest": ACTIVITY_INGEST,
    "activity_rejects": ACTIVITY_REJECTS,
    "account_ingest": ACCOUNT_INGEST,
    "account_rejects": ACCOUNT_REJECTS,
    "monthly_totals": MONTHLY_TOTALS,
    "totals_report_write": MONTHLY_TOTALS,
    "extract_rejects": EXTRACT_REJECTS,
})


# ---------------------------------------------------------------- partitioned dataset oracles

CHANNEL_SQL = "CASE WHEN is_mobile THEN 'mobile' ELSE 'online' END"

ACTIVITY_DAY_RANGE = with_views(ACTIVITY) + f"""
SELECT activity_date, {CHANNEL_SQL} AS channel, {big('count(*)')} AS n
FROM activity
WHERE activity_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
GROUP BY 1, 2"""

MISSING_DAYS = with_views(ACTIVITY) + f""",
calendar AS (
  SELECT CAST(d AS DATE) AS activity_date, ch AS channel
  FROM range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY) AS r(d), (VALUES ('online'), ('mobile')) AS c(ch))
SELECT activity_date, channel FROM calendar k
WHERE NOT EXISTS (SELECT 1 FROM activity a WHERE a.activity_date = k.activity_date AND {CHANNEL_SQL} = k.channel)"""

ORACLES.update({
    "activity_day_range": ACTIVITY_DAY_RANGE,
    "missing_days": MISSING_DAYS,
})


# ---------------------------------------------------------------- lead check oracles

# The click-type names that count as leads, stated here on their own.
LEAD_NAMES_SQL = """(
  'appointment_submit', 'contact_submit', 'directions-confirm', 'email-confirm', 'free_call', 'free_call_mp', 'howtodetail',
  'newsletter_submit', 'printdirection', 'quote_submit', 'reserve_online', 'reservenow-ot', 'save_share_facebook',
  'save_share_foursquare', 'save_share_other', 'save_share_tripadvisor', 'save_share_twitter', 'saveshare_email-confirm',
  'saveshareemail-confirm', 'share_confirm', 'sms-confirm')"""

KEYS = """
keys AS (SELECT DISTINCT parent_account_id, TRY_CAST(child_account_key AS BIGINT) AS child_key
         FROM account_bridge WHERE TRY_CAST(child_account_key AS BIGINT) IS NOT NULL AND parent_account_id IS NOT NULL)"""

IDS = """
ids AS (SELECT DISTINCT parent_account_id, CAST(TRY_CAST(child_account_id AS BIGINT) AS VARCHAR) AS child_id
        FROM account_bridge WHERE TRY_CAST(child_account_id AS BIGINT) IS NOT NULL AND parent_account_id IS NOT NULL)"""


def ts_between(ts: str, begin: str, end: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S') BETWEEN '{begin} 00:00:00' AND '{end} 23:59:59'"


ONLINE_COND = (ts_between("a.activity_ts", "2024-01-05", "2024-01-20")
               + f" AND (a.click_type_id IN (SELECT click_type_id FROM click_type WHERE name IN {LEAD_NAMES_SQL})"
               + " OR a.click_type_id = 0)")
PHONE_COND = ts_between("p.created_datetime", "1996-01-01", "1996-12-31")
ONLINE_REPORT_COND = "TRY_CAST(r.date_day AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
PHONE_REPORT_COND = "TRY_CAST(r.phone_lead_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"

CHILD_ACCOUNTS = with_views(BRIDGE) + """
SELECT DISTINCT parent_account_id, 'child_account_id' AS field, TRY_CAST(child_account_id AS BIGINT) AS child
FROM account_bridge WHERE TRY_CAST(child_account_id AS BIGINT) IS NOT NULL AND parent_account_id IS NOT NULL
UNION
SELECT DISTINCT parent_account_id, 'child_account_key' AS field, TRY_CAST(child_account_key AS BIGINT) AS child
FROM account_bridge WHERE TRY_CAST(child_account_key AS BIGINT) IS NOT NULL AND parent_account_id IS NOT NULL"""

ONLINE_LEADS = with_views(ACTIVITY, CLICK_TYPE, BRIDGE, KEYS) + f"""
SELECT k.parent_account_id, a.event_id AS raw_activity_account_key, a.account_key, a.session_id,
       a.activity_ts AS activity_date
FROM activity a JOIN keys k ON a.account_key = k.child_key
WHERE {ONLINE_COND}"""

PHONE_LEADS = with_views(PHONE_LEAD, BRIDGE, KEYS) + f"""
SELECT k.parent_account_id, p.phone_lead_id, p.account_key, p.created_datetime
FROM phone_lead p JOIN keys k ON p.account_key = k.child_key
WHERE {PHONE_COND}"""

ONLINE_REPORT_ROWS = with_views(ACTIVITY, CLICK_TYPE, ONLINE_REPORT, BRIDGE, IDS) + f"""
SELECT r.event_id, TRY_CAST(r.date_day AS DATE) AS date_day, r.merchant_id, r.cust_account_id,
       coalesce(TRY_CAST(r.impressions AS BIGINT), 0) AS impressions, r.click_type_name,
       coalesce(TRY_CAST(r.clicks AS BIGINT), 0) AS clicks, r.platform, r.keyword, i.parent_account_id
FROM online_report r JOIN ids i ON r.merchant_id = i.child_id
WHERE {ONLINE_REPORT_COND}"""

PHONE_REPORT_ROWS = with_views(PHONE_REPORT, BRIDGE, IDS) + f"""
SELECT r.phone_lead_id, TRY_CAST(r.phone_lead_date AS DATE) AS phone_lead_date, r.phone_lead_time, r.merchant_id,
       r.cust_account_id, r.zone, coalesce(TRY_CAST(r.duration AS INTEGER), 0) AS duration, r.answer_status,
       i.parent_account_id
FROM phone_report r JOIN ids i ON r.merchant_id = i.child_id
WHERE {PHONE_REPORT_COND}"""

RECONCILIATION_VIEWS = [ACTIVITY, CLICK_TYPE, PHONE_LEAD, PHONE_REPORT, ONLINE_REPORT, BRIDGE, KEYS, IDS, f"""
parents AS (SELECT DISTINCT parent_account_id FROM account_bridge WHERE parent_account_id IS NOT NULL),
online_src AS (SELECT k.parent_account_id, count(*) AS n FROM activity a JOIN keys k ON a.account_key = k.child_key
               WHERE {ONLINE_COND} GROUP BY 1),
online_rep AS (SELECT i.parent_account_id, count(*) AS n FROM online_report r JOIN ids i ON r.merchant_id = i.child_id
               WHERE {ONLINE_REPORT_COND} GROUP BY 1),
phone_src AS (SELECT k.parent_account_id, count(*) AS n FROM phone_lead p JOIN keys k ON p.account_key = k.child_key
              WHERE {PHONE_COND} GROUP BY 1),
phone_rep AS (SELECT i.parent_account_id, count(*) AS n FROM phone_report r JOIN ids i ON r.merchant_id = i.child_id
              WHERE {PHONE_REPORT_COND} GROUP BY 1),
reconciliation AS (
  SELECT p.parent_account_id, 'online' AS kind, CAST(coalesce(s.n, 0) AS BIGINT) AS source_count,
         CAST(coalesce(r.n, 0) AS BIGINT) AS report_count, coalesce(s.n, 0) = coalesce(r.n, 0) AS ok
  FROM parents p LEFT JOIN online_src s ON p.parent_account_id = s.parent_account_id
                 LEFT JOIN online_rep r ON p.parent_account_id = r.parent_account_id
  UNION ALL
  SELECT p.parent_account_id, 'phone', CAST(coalesce(s.n, 0) AS BIGINT), CAST(coalesce(r.n, 0) AS BIGINT),
         coalesce(s.n, 0) = coalesce(r.n, 0)
  FROM parents p LEFT JOIN phone_src s ON p.parent_account_id = s.parent_account_id
                 LEFT JOIN phone_rep r ON p.parent_account_id = r.parent_account_id)"""]

LEAD_RECONCILIATION = with_views(*RECONCILIATION_VIEWS) + """
SELECT * FROM reconciliation"""


def _violations(row_filter: str) -> str:
    return f""",
typed AS (
  SELECT event_id, TRY_CAST(date_day AS DATE) AS date_day, merchant_id, click_type_name,
         coalesce(TRY_CAST(impressions AS BIGINT), 0) AS i, coalesce(TRY_CAST(clicks AS BIGINT), 0) AS c,
         coalesce(platform, '') AS platform
  FROM online_report WHERE {row_filter}),
flags AS (SELECT t.*, EXISTS (SELECT 1 FROM ids WHERE ids.child_id = t.merchant_id) AS expected FROM typed t)
SELECT event_id, date_day, merchant_id, 'empty_platform' AS rule, platform AS value FROM flags WHERE platform = ''
UNION ALL
SELECT event_id, date_day, merchant_id, 'unknown_platform', platform FROM flags
WHERE platform <> '' AND upper(platform) NOT IN ('DESKTOP', 'MOBILE')
UNION ALL
SELECT event_id, date_day, merchant_id, 'not_a_lead', click_type_name FROM flags
WHERE click_type_name IS NULL OR click_type_name NOT IN {LEAD_NAMES_SQL}
UNION ALL
SELECT event_id, date_day, merchant_id, 'clicks_xor_impressions',
       'clicks=' || CAST(c AS VARCHAR) || ', impressions=' || CAST(i AS VARCHAR) FROM flags
WHERE NOT (c * i = 0 AND c + i > 0)
UNION ALL
SELECT event_id, date_day, merchant_id, 'date_out_of_range', CAST(date_day AS VARCHAR) FROM flags
WHERE date_day IS NULL OR date_day NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
UNION ALL
SELECT event_id, date_day, merchant_id, 'merchant_not_expected', merchant_id FROM flags WHERE NOT expected"""


REPORT_VIOLATIONS = with_views(ACTIVITY, CLICK_TYPE, ONLINE_REPORT, BRIDGE, IDS) + _violations("true")

REPORT_VIOLATIONS_RECONCILED = with_views(*RECONCILIATION_VIEWS) + _violations(
    "merchant_id IN (SELECT child_id FROM ids WHERE parent_account_id IN ("
    "SELECT parent_account_id FROM reconciliation GROUP BY 1 HAVING bool_and(ok)))")

ORACLES.update({
    "child_accounts": CHILD_ACCOUNTS,
    "online_leads": ONLINE_LEADS,
    "phone_leads": PHONE_LEADS,
    "online_report": ONLINE_REPORT_ROWS,
    "phone_report": PHONE_REPORT_ROWS,
    "lead_reconciliation": LEAD_RECONCILIATION,
    "report_violations": REPORT_VIOLATIONS,
    "report_violations_reconciled": REPORT_VIOLATIONS_RECONCILED,
})


# ---------------------------------------------------------------- audits and written reports

DATE_COMPONENT_AUDIT = with_views(ACTIVITY) + f""",
parts AS (
  SELECT 'YY' AS component, CAST(year(activity_ts) AS INTEGER) AS value FROM activity UNION ALL
  SELECT 'MM', CAST(month(activity_ts) AS INTEGER) FROM activity UNION ALL
  SELECT 'DD', CAST(day(activity_ts) AS INTEGER) FROM activity UNION ALL
  SELECT 'hh', CAST(hour(activity_ts) AS INTEGER) FROM activity UNION ALL
  SELECT 'mm', CAST(minute(activity_ts) AS INTEGER) FROM activity UNION ALL
  SELECT 'ss', CAST(second(activity_ts) AS INTEGER) FROM activity),
allowed AS (SELECT * FROM (VALUES ('MM', 1, 12), ('DD', 1, 31), ('hh', 1, 24), ('mm', 1, 60), ('ss', 1, 60))
            AS t(component, low, high))
SELECT p.component, p.value, {big('count(*)')} AS n,
  CASE WHEN p.component = 'YY' THEN NULL WHEN p.value IS NULL THEN 'no value'
       WHEN p.value < any_value(a.low) OR p.value > any_value(a.high)
       THEN p.component || '=' || CAST(p.value AS VARCHAR) || ', allowed ' || CAST(any_value(a.low) AS VARCHAR)
            || '-' || CAST(any_value(a.high) AS VARCHAR) END AS message
FROM parts p LEFT JOIN allowed a ON a.component = p.component GROUP BY 1, 2"""

DATE_TEXT_AUDIT = ACTIVITY_FIELDS + """,
texts AS (SELECT date_text, count(*) AS n FROM tagged WHERE reason IS NULL GROUP BY 1),
checked AS (
  SELECT date_text, n, coalesce(regexp_full_match(date_text, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
                                AND try_strptime(date_text, '%Y-%m-%d') IS NOT NULL, false) AS is_valid
  FROM texts)
SELECT date_text, CAST(n AS BIGINT) AS n, is_valid,
       CASE WHEN is_valid THEN CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE) END AS day
FROM checked"""

ORACLES.update({
    "date_component_audit": DATE_COMPONENT_AUDIT,
    "date_text_audit": DATE_TEXT_AUDIT,
    "report_write": HEADING_DIRECTORY_PROFILE,
    "share_report_write": NON_NAME_SHARE,
})


# ---------------------------------------------------------------- merchant profile variants

MERCHANT_PROFILE_ALL_ROWS = with_views(ACTIVITY, ACCOUNT) + f""",
rows AS (
  SELECT c.account_key, {clean('c.account_id')} AS account_id, {clean('c.account_name')} AS account_name,
         {clean('a.keywords')} AS term
  FROM account c JOIN activity a ON c.account_key = a.account_key),
normalised AS (SELECT *, {norm_term('term')} AS t, {norm_name('account_name')} AS n FROM rows)
SELECT account_key, account_id, account_name,
  {big('count(*)')} AS queries_total,
  {big(f"count_if({match('t', 'n')})")} AS queries_by_name,
  {big("count_if(term = '')")} AS queries_empty,
  {big("count_if(upper(term) = 'NONE')")} AS queries_none
FROM normalised GROUP BY account_key, account_id, account_name"""

MERCHANT_PROFILE_CLICKS = MERCHANT_PROFILE.replace(
    "FROM account c JOIN activity a ON c.account_key = a.account_key\n",
    "FROM account c JOIN activity a ON c.account_key = a.account_key\n  WHERE a.click_weight > 0\n")
assert MERCHANT_PROFILE_CLICKS != MERCHANT_PROFILE

ORACLES.update({
    "merchant_profile_all_rows": MERCHANT_PROFILE_ALL_ROWS,
    "merchant_profile_clicks": MERCHANT_PROFILE_CLICKS,
})


# ---------------------------------------------------------------- incremental ingest

STREAM_INGEST = ACTIVITY_FIELDS + f"""
SELECT a.activity_date, {CHANNEL_SQL} AS channel, {big('count(*)')} AS n
FROM tagged t JOIN activity a ON a.event_id = t.event_id
WHERE t.reason IS NULL
GROUP BY 1, 2"""

ORACLES.update({"stream_ingest": STREAM_INGEST})


# ---------------------------------------------------------------- report variants

NON_NAME_SHARE_TOP10 = NON_NAME_SHARE + """
ORDER BY d.account_name, s.account_key LIMIT 10"""

HEADING_DIRECTORY_PROFILE_STRICT = HEADING_DIRECTORY_PROFILE.replace(
    f"count_if({match('t', 'n')})", f"count_if(length(t) > 0 AND {match('t', 'n')})")
assert HEADING_DIRECTORY_PROFILE_STRICT != HEADING_DIRECTORY_PROFILE

ORACLES.update({
    "non_name_share_top10": NON_NAME_SHARE_TOP10,
    "heading_directory_profile_strict": HEADING_DIRECTORY_PROFILE_STRICT,
})


# ---------------------------------------------------------------- exports, quoted lines, one parent, written reports

def _with(view: str, other: str, sql: str) -> str:
    if view not in sql:
        raise ValueError("the view is not part of the query")
    return sql.replace(view, other)


ACTIVITY_SAMPLE = with_views(ACTIVITY) + """
SELECT * FROM activity WHERE left(md5('1|' || CAST(event_id AS VARCHAR)), 8) < '00418937'"""

ACTIVITY_DAY_RANGE_ONLINE = with_views(ACTIVITY) + f"""
SELECT activity_date, 'online' AS channel, {big('count(*)')} AS n FROM activity
WHERE activity_date BETWEEN DATE '2024-01-09' AND DATE '2024-01-11' AND NOT is_mobile GROUP BY 1"""

ACTIVITY_REEXPORT = with_views(ACTIVITY) + f""",
corrected AS (SELECT * FROM activity WHERE NOT (is_mobile AND activity_date = DATE '2024-01-05')),
snapshots AS (
  SELECT activity_date, {CHANNEL_SQL} AS channel, 'full' AS snapshot FROM corrected
  UNION ALL
  SELECT activity_date, {CHANNEL_SQL}, 'sample' FROM corrected
  WHERE left(md5('1|' || CAST(event_id AS VARCHAR)), 8) < '028f5c29')
SELECT activity_date, channel, snapshot, {big('count(*)')} AS n FROM snapshots GROUP BY 1, 2, 3"""

QUOTED_LINES = r"""
quoted_lines AS (
  SELECT event_id, CASE WHEN event_id % 50 = 1 THEN replace(line, '",f,"', '",f,"a,b ')
    WHEN event_id % 61 = 2 THEN line || ',x"'
    WHEN event_id % 1009 = 3 THEN line || repeat(',"q,r"', 10000) ELSE line END AS line
  FROM activity_lines)"""

# a section between quotes with an odd number of quotes after it keeps its commas
ACTIVITY_QUOTED = with_views(ACTIVITY, ACTIVITY_LINES, QUOTED_LINES) + f""",
sections AS (SELECT event_id, string_split(line, '"') AS s FROM quoted_lines),
marked AS (
  SELECT event_id, array_to_string([CASE WHEN (len(s) - i) % 2 = 1 THEN replace(s[i], ',', chr(10)) ELSE s[i] END
                                    FOR i IN range(1, len(s) + 1)], '"') AS line FROM sections),
parsed AS (SELECT event_id, [replace(x, chr(10), ',') FOR x IN string_split(line, ',')] AS p FROM marked),
f AS (
  SELECT event_id, len(p) AS n_fields, TRY_CAST({clean('p[3]')} AS BIGINT) AS account_key, {clean('p[18]')} AS keywords,
         {clean('p[4]')} AS date_text, TRY_CAST({clean('p[5]')} AS BIGINT) AS heading_id,
         TRY_CAST({clean('p[6]')} AS BIGINT) AS directory_id, TRY_CAST({clean('p[8]')} AS BIGINT) AS referer_id,
         TRY_CAST({clean('p[16]')} AS BIGINT) AS mobile_number
  FROM parsed)
SELECT event_id, account_key, keywords, date_text, heading_id,
       CASE WHEN n_fields < 18 THEN 'short_row'
            WHEN account_key IS NULL OR heading_id IS NULL OR directory_id IS NULL OR referer_id IS NULL
                 OR mobile_number IS NULL THEN 'bad_number' END AS reason
FROM f"""

ORACLES.update({
    "activity_sample": ACTIVITY_SAMPLE,
    "activity_day_range_online": ACTIVITY_DAY_RANGE_ONLINE,
    "activity_reexport": ACTIVITY_REEXPORT,
    "activity_quoted": ACTIVITY_QUOTED,
    "account_export": ACCOUNT_INGEST,
    "child_accounts_one_parent": f"SELECT * FROM ({CHILD_ACCOUNTS}) WHERE parent_account_id = 'P7'",
    "lead_reconciliation_one_parent": LEAD_RECONCILIATION + " WHERE parent_account_id = 'P7'",
    "share_report_write": _with(ACCOUNT, AWKWARD_ACCOUNT, NON_NAME_SHARE),
    "merchant_report_write": _with(ACCOUNT, AWKWARD_ACCOUNT, MERCHANT_PROFILE),
})

# ---------------------------------------------------------------- other physical forms of the same jobs

ORACLES.update({
    "heading_directory_profile_bucketed": ORACLES["heading_directory_profile"],
    "non_name_share_bucketed": ORACLES["non_name_share"],
    "activity_ingest_compressed": f"SELECT * EXCLUDE (event_id) FROM ({ACTIVITY_INGEST})",
})
