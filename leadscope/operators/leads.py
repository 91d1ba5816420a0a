"""Lead reports against their sources: children of parent accounts, source and report rows
in a day range, count reconciliation and per-record rule checks.

The child list stays a DataFrame (semi / inner joins), never literal IN lists on the
driver; all parents are handled in one job (``parents=None``) or any subset of them.
Counts are taken per account key first – a partial aggregate that collapses hot keys
before any shuffle – and only then joined with the (parent, child) pairs and summed.
Day ranges are typed and half-open on timestamps: ``begin 00:00 <= ts < end + 1 day``,
which also keeps fractional seconds of the last second of the last day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadscope.functions.dates import date_argument
from leadscope.functions.numeric import to_long
from leadscope.operators.bloom import possible
from leadscope.operators.skew import DEFAULT_HOT_ROWS, salted_join
from leadscope.plans.sizing import (DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast,
                                    fits_broadcast, measured)

# Click-type names that count as leads (21 distinct names).
LEAD_CLICK_TYPES = (
    "appointment_submit", "contact_submit", "email-confirm", "newsletter_submit", "quote_submit",
    "reserve_online", "reservenow-ot", "directions-confirm", "printdirection", "free_call", "free_call_mp",
    "saveshare_email-confirm", "sms-confirm", "howtodetail", "share_confirm", "save_share_twitter",
    "save_share_facebook", "save_share_tripadvisor", "save_share_foursquare", "save_share_other",
    "saveshareemail-confirm",
)
# Click type id of activity without a click type; accepted report platforms.
NO_CLICK_TYPE = 0
PLATFORMS = ("DESKTOP", "MOBILE")

Parents = Iterable[str] | DataFrame | None


# ---------------------------------------------------------------- children

def _parents_arg(parents: Parents) -> tuple[str, ...] | DataFrame | None:
    """One parent id, several (any iterable, read once here) or a DataFrame of them."""
    if parents is None or isinstance(parents, DataFrame):
        return parents
    if isinstance(parents, str):
        return (parents,)
    return tuple(parents)


def _for_parents(bridge: DataFrame, parents: Parents) -> DataFrame:
    """Bridge rows of the selected parents; a NULL parent id names no parent."""
    parents = _parents_arg(parents)
    named = bridge.filter(F.col("parent_account_id").isNotNull())
    if parents is None:
        return named
    if isinstance(parents, DataFrame):
        return named.join(parents.select("parent_account_id").distinct(), "parent_account_id", "left_semi")
    return named.filter(F.col("parent_account_id").isin(*parents))


def child_accounts(bridge: DataFrame, parents: Parents = None) -> DataFrame:
    """(parent_account_id, field, child): numeric child ids and keys; text that is not a
    number is skipped, each field on its own."""
    b = _for_parents(bridge, parents)
    pairs = F.array(
        F.struct(F.lit("child_account_id").alias("field"), to_long("child_account_id").alias("child")),
        F.struct(F.lit("child_account_key").alias("field"), to_long("child_account_key").alias("child")))
    numeric = F.filter(pairs, lambda x: x["child"].isNotNull())
    return b.select("parent_account_id", F.inline(numeric)).distinct()


def child_keys(bridge: DataFrame, parents: Parents = None) -> DataFrame:
    b = _for_parents(bridge, parents)
    return (b.select("parent_account_id", to_long("child_account_key").alias("child_key"))
            .filter(F.col("child_key").isNotNull()).distinct())


def child_ids(bridge: DataFrame, parents: Parents = None) -> DataFrame:
    """Child ids as text, the form in which reports name merchants."""
    b = _for_parents(bridge, parents)
    return (b.select("parent_account_id", to_long("child_account_id").cast("string").alias("child_id"))
            .filter(F.col("child_id").isNotNull()).distinct())


def parent_list(bridge: DataFrame, parents: Parents = None) -> DataFrame:
    return _for_parents(bridge, parents).select("parent_account_id").distinct()


# ---------------------------------------------------------------- ranges

def ts_in_days(ts: Column, begin: str | dt.date, end: str | dt.date) -> Column:
    lo, hi = date_argument(begin), date_argument(end) + dt.timedelta(days=1)
    return (ts >= F.lit(lo.isoformat()).cast("timestamp_ntz")) & (ts < F.lit(hi.isoformat()).cast("timestamp_ntz"))


def date_in_days(day: Column, begin: str | dt.date, end: str | dt.date) -> Column:
    return (day >= F.lit(date_argument(begin))) & (day <= F.lit(date_argument(end)))


# ---------------------------------------------------------------- sources

def lead_click_type_ids(click_type: DataFrame) -> DataFrame:
    """Ids of the lead click types, broadcast after a size check: the id is a
    low-cardinality key, so a shuffle join on it would concentrate the activity."""
    ids = click_type.filter(F.col("name").isin(*LEAD_CLICK_TYPES)).select("click_type_id").distinct()
    return bounded_broadcast(ids)


def online_source(activity: DataFrame, click_type: DataFrame, begin, end) -> DataFrame:
    """Activity in the range whose click type is a lead (IN-subquery) or empty."""
    lead = F.col("click_type_id").isin(lead_click_type_ids(click_type)) | (F.col("click_type_id") == NO_CLICK_TYPE)
    return activity.filter(ts_in_days(F.col("activity_ts"), begin, end) & lead)


def phone_source(phone_lead: DataFrame, begin, end) -> DataFrame:
    return phone_lead.filter(ts_in_days(F.col("created_datetime"), begin, end))


def of_children(rows: DataFrame, key: str, children: DataFrame, child: str,
                broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``rows`` joined with the (parent_account_id, ``child``) pairs on ``key`` = ``child``.

    The pairs are broadcast within the checked bound.  Beyond it a Bloom filter of the children takes the
    other rows out before the shuffle join, whose hot keys AQE splits."""
    n, size = measured(children)
    if n <= broadcast_rows and size <= DEFAULT_MAX_BROADCAST_BYTES:
        children = F.broadcast(children)
    else:
        rows = possible(rows, key, children, child, n)
    return rows.join(children, rows[key] == children[child])


def online_leads(activity: DataFrame, click_type: DataFrame, bridge: DataFrame, begin, end,
                 parents: Parents = None, broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Source rows of the children."""
    src = online_source(activity, click_type, begin, end)
    return (of_children(src, "account_key", child_keys(bridge, parents), "child_key", broadcast_rows)
            .select("parent_account_id", F.col("event_id").alias("raw_activity_account_key"), "account_key",
                    "session_id", F.col("activity_ts").alias("activity_date")))


def phone_leads(phone_lead: DataFrame, bridge: DataFrame, begin, end, parents: Parents = None,
                broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    src = phone_source(phone_lead, begin, end)
    return (of_children(src, "account_key", child_keys(bridge, parents), "child_key", broadcast_rows)
            .select("parent_account_id", *phone_lead.columns))


# ---------------------------------------------------------------- reports

def typed_online_report(report: DataFrame) -> DataFrame:
    """Report columns typed as read by the check: counters as BIGINT (NULL -> 0)."""
    return report.withColumns({
        "date_day": F.col("date_day").try_cast("date"),
        "impressions": F.coalesce(to_long("impressions"), F.lit(0).cast("bigint")),
        "clicks": F.coalesce(to_long("clicks"), F.lit(0).cast("bigint")),
    })


def typed_phone_report(report: DataFrame) -> DataFrame:
    return report.withColumns({
        "phone_lead_date": F.col("phone_lead_date").try_cast("date"),
        "duration": F.coalesce(F.col("duration").try_cast("int"), F.lit(0)),
    })


def _report_rows(typed: DataFrame, day_col: str, bridge: DataFrame, begin, end, parents: Parents,
                 broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    rows = typed.filter(date_in_days(F.col(day_col), begin, end))
    return of_children(rows, "merchant_id", child_ids(bridge, parents), "child_id", broadcast_rows).drop("child_id")


def online_report(report: DataFrame, bridge: DataFrame, begin, end, parents: Parents = None,
                  broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    return _report_rows(typed_online_report(report), "date_day", bridge, begin, end, parents, broadcast_rows)


def phone_report(report: DataFrame, bridge: DataFrame, begin, end, parents: Parents = None,
                 broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    return _report_rows(typed_phone_report(report), "phone_lead_date", bridge, begin, end, parents, broadcast_rows)


# ---------------------------------------------------------------- reconciliation

# The four counted inputs: kind of lead and side.
_COUNTED = (("online", "source"), ("online", "report"), ("phone", "source"), ("phone", "report"))


def lead_reconciliation(activity: DataFrame, click_type: DataFrame, phone_lead: DataFrame,
                        online_report_table: DataFrame, phone_report_table: DataFrame, bridge: DataFrame,
                        begin, end, phone_begin=None, phone_end=None, parents: Parents = None) -> DataFrame:
    """Per parent and kind (online, phone): records in the source, records in the report,
    and whether the two agree.  The phone range defaults to the online one.

    One pass: the four filtered inputs are tagged, counted per (kind, side, child) – a partial aggregate
    that collapses hot children – joined once with the children and summed per parent."""
    parents = _parents_arg(parents)
    phone_begin = begin if phone_begin is None else phone_begin
    phone_end = end if phone_end is None else phone_end
    online_rep = typed_online_report(online_report_table).filter(date_in_days(F.col("date_day"), begin, end))
    phone_rep = typed_phone_report(phone_report_table).filter(
        date_in_days(F.col("phone_lead_date"), phone_begin, phone_end))
    inputs = ((online_source(activity, click_type, begin, end), "account_key"), (online_rep, "merchant_id"),
              (phone_source(phone_lead, phone_begin, phone_end), "account_key"), (phone_rep, "merchant_id"))
    tagged = [rows.select(F.lit(kind).alias("kind"), F.lit(side).alias("side"), F.col(key).cast("string").alias("child"))
              for (kind, side), (rows, key) in zip(_COUNTED, inputs)]
    counted = (reduce(DataFrame.unionByName, tagged).groupBy("kind", "side", "child")
               .agg(F.count(F.lit(1)).alias("n")))
    # sources name a child by its key, reports by its id; parents without a usable child keep their row
    named = F.array(*[F.struct(F.lit(side).alias("side"), to_long(col).cast("string").alias("child"))
                      for side, col in (("source", "child_account_key"), ("report", "child_account_id"))])
    children = _for_parents(bridge, parents).select("parent_account_id", F.inline(named)).distinct()
    sums = [F.coalesce(F.sum(F.when((F.col("kind") == kind) & (F.col("side") == side), F.col("n"))),
                       F.lit(0).cast("bigint")).alias(f"{kind}_{side}") for kind, side in _COUNTED]
    per_parent = children.join(counted, ["side", "child"], "left").groupBy("parent_account_id").agg(*sums)
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}_source").alias("source_count"),
                               F.col(f"{kind}_report").alias("report_count")) for kind in ("online", "phone")])
    return (per_parent.select("parent_account_id", F.inline(kinds))
            .withColumn("ok", F.col("source_count") == F.col("report_count")))


# ---------------------------------------------------------------- record checks

def report_violations(report: DataFrame, bridge: DataFrame, begin, end, parents: Parents = None,
                      reconciliation: DataFrame | None = None, broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """One row per (online report record, broken rule): rule name and offending value.

    Rules: empty_platform, unknown_platform (not Desktop/Mobile), not_a_lead (click type
    not among the lead names, case-sensitive), clicks_xor_impressions (not exactly one of
    them > 0), date_out_of_range, merchant_not_expected (not a child of the parents).
    With ``reconciliation`` given, only records of children of parents whose online and phone counts
    both agree are checked; such a merchant is a child, so ``merchant_not_expected`` cannot occur there.

    One lookup (child, expected) is joined once; beyond the broadcast bound hot merchants are salted.
    """
    rows = typed_online_report(report)
    ids = child_ids(bridge, _parents_arg(parents))
    if reconciliation is not None:
        agreed = (reconciliation.groupBy("parent_account_id").agg(F.bool_and("ok").alias("all_ok"))
                  .filter("all_ok").select("parent_account_id"))
        ids = ids.join(agreed, "parent_account_id", "left_semi")
    expected = ids.select(F.col("child_id").alias("merchant_id")).distinct().withColumn("expected", F.lit(True))
    how = "left" if reconciliation is None else "inner"
    # the children of some parents are a subset of the children of all: one check covers both
    if fits_broadcast(child_ids(bridge).select("child_id"), broadcast_rows):
        rows = rows.join(F.broadcast(expected), "merchant_id", how)
    else:
        rows = salted_join(rows, expected, "merchant_id", how, hot_rows)
    platform = F.coalesce(F.col("platform"), F.lit(""))
    c, i = F.col("clicks"), F.col("impressions")
    rules = [
        ("empty_platform", platform == "", platform),
        ("unknown_platform", (platform != "") & ~F.upper(platform).isin(*PLATFORMS), platform),
        ("not_a_lead", ~F.coalesce(F.col("click_type_name").isin(*LEAD_CLICK_TYPES), F.lit(False)),
         F.col("click_type_name")),
        # "c * i = 0 and c + i > 0" written without arithmetic, which could overflow BIGINT
        ("clicks_xor_impressions", ~(((c == 0) & (i > 0)) | ((i == 0) & (c > 0))),
         F.concat(F.lit("clicks="), c.cast("string"), F.lit(", impressions="), i.cast("string"))),
        ("date_out_of_range", ~F.coalesce(date_in_days(F.col("date_day"), begin, end), F.lit(False)),
         F.col("date_day").cast("string")),
        ("merchant_not_expected", F.col("expected").isNull(), F.col("merchant_id")),
    ]
    # every rule as (hit, rule, value); the hits are kept by a higher-order filter and turned into
    # rows by one generator (cheaper than a conditional array that is compacted and exploded)
    checks = F.array(*[F.struct(cond.alias("hit"), F.lit(name).alias("rule"), value.cast("string").alias("value"))
                       for name, cond, value in rules])
    return (rows.select("event_id", "date_day", "merchant_id", F.inline(F.filter(checks, lambda x: x["hit"])))
            .drop("hit"))
