"""Domain views over the driver's tables, built with the DataFrame API.

The driver ships TPC-H-like tables; the jobs need search activity, accounts, locations,
lead sources and lead reports.  Each function here maps driver tables onto one domain
table.  Columns are computed, never filtered by id, so every view grows with the data.
The oracle SQL in ``plans.oracle`` states the same mapping independently in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search activity: one row per event, with search terms in eight shapes."""
    ev = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    uid9 = F.lpad(_s(uid), 9, "0")
    shape = (eid % 8).cast("int")
    keywords = (F.when(shape == 0, F.concat(F.lit("customer-"), uid9))
                .when(shape == 1, F.concat(F.lit('"CUSTOMER '), uid9, F.lit('" ')))
                .when(shape == 2, F.lit(""))
                .when(shape == 3, F.lit(" none "))
                .when(shape == 4, F.concat(F.lit("pizza "), _s(uid), F.lit(".com")))
                .when(shape == 5, F.lit("customer 00000 shop"))
                .when(shape == 6, F.concat(F.lit("custmer "), uid9))
                .otherwise(F.lit("-")))
    is_view = F.col("event_type") == "view"
    is_click = F.col("event_type") == "click"
    return ev.select(
        eid.alias("event_id"),
        uid.alias("account_key"),
        F.col("ts").alias("activity_ts"),
        F.col("ts").cast("date").alias("activity_date"),
        keywords.alias("keywords"),
        (eid % 7).alias("heading_id"),
        (eid % 25).alias("directory_id"),
        (eid % 3).alias("referer_id"),
        (eid % 5).cast("int").alias("click_type_id"),
        F.col("event_type"),
        F.when(is_view, F.col("value")).otherwise(F.lit(0.0)).alias("impression_weight"),
        F.when(is_click, F.col("value")).otherwise(F.lit(0.0)).alias("click_weight"),
        (eid % 2 == 1).alias("is_mobile"),
        F.concat(F.lit("s"), _s(uid), F.lit("-"), _s(F.col("ts").cast("date"))).alias("session_id"),
    )


def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("account_key"),
        F.concat(F.lit("A"), _s(F.col("c_custkey"))).alias("account_id"),
        F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")).alias("account_name"),
        F.col("c_nationkey").alias("location_key"),
    )


def awkward_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts whose names hold what text files find hard: outer blanks, quotes, tabs, line breaks,
    backslashes, nothing, or NULL."""
    key, name = F.col("account_key"), F.col("account_name")
    shape = (key % 8).cast("int")
    names = (F.when(key % 31 == 0, F.lit(None).cast("string"))
             .when(shape == 0, F.concat(F.lit("  "), name, F.lit(" ")))
             .when(shape == 1, F.concat(F.lit('the "'), name, F.lit('", best')))
             .when(shape == 2, F.concat(name, F.lit("\t"), name))
             .when(shape == 3, F.concat(name, F.lit("\r\n"), F.lit("2nd line")))
             .when(shape == 4, F.lit(""))
             .when(shape == 5, F.concat(F.lit("c:\\new\\"), name))
             .otherwise(name))
    return account(spark, sf_dir).withColumn("account_name", names)


def quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw activity lines with a quoted comma, an unpaired quote, or ten thousand quoted fields more."""
    eid, line = F.col("event_id"), F.col("line")
    comma = F.replace(line, F.lit('",f,"'), F.lit('",f,"a,b '))
    return activity_lines(spark, sf_dir).select(
        eid, F.when(eid % 50 == 1, comma).when(eid % 61 == 2, F.concat(line, F.lit(',x"')))
        .when(eid % 1009 == 3, F.concat(line, F.repeat(F.lit(',"q,r"'), 10_000))).otherwise(line).alias("line"))


def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations; nation 3 has none, so its accounts drop out of inner joins."""
    n = table(spark, sf_dir, "nation")
    return n.filter(F.col("n_nationkey") != 3).select(
        F.col("n_nationkey").alias("location_key"),
        F.col("n_name").alias("location_city"),
        F.concat(F.lit("Z"), _s(F.col("n_regionkey"))).alias("location_zip_code"),
    )


def click_type(spark: SparkSession) -> DataFrame:
    """The click-type dimension: a fixed four-row table (id 0 means 'no click type').

    Built as an inline VALUES relation so Catalyst knows its exact size (a local list turned
    into an RDD has no statistics and would make every join with it a shuffle)."""
    return spark.sql("SELECT * FROM VALUES (1, 'contact_submit'), (2, 'free_call'), (3, 'banner_view'), "
                     "(4, 'share_confirm') AS t(click_type_id, name)")


def account_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent -> child accounts; the source columns are text, some of it not numeric."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("P"), _s(F.col("c_nationkey"))).alias("parent_account_id"),
        F.when(key % 373 == 0, F.concat(F.lit("X"), _s(key))).otherwise(_s(key)).alias("child_account_id"),
        F.when(key % 419 == 0, F.concat(F.lit("K"), _s(key))).otherwise(_s(key)).alias("child_account_key"),
    )


def _phone_created(o: DataFrame) -> Column:
    return F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate"))


def _clock(ts: Column) -> Column:
    """HH:mm:ss of a TIMESTAMP_NTZ without going through the session time zone (date_format
    would, and wall-clock times inside a daylight-saving gap would shift)."""
    two = [F.lpad(_s(part(ts)), 2, "0") for part in (F.hour, F.minute, F.second)]
    return F.concat_ws(":", *two)


def phone_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phone lead source records (one per order)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("phone_lead_id"),
        F.col("o_custkey").alias("account_key"),
        _phone_created(o).alias("created_datetime"),
    )


def phone_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered phone report; the most expensive orders (over 497,000) are missing."""
    o = table(spark, sf_dir, "orders")
    created = _phone_created(o)
    missing = F.col("o_totalprice") > 497000
    return o.filter(~missing).select(
        F.col("o_orderkey").alias("phone_lead_id"),
        _s(created.cast("date")).alias("phone_lead_date"),
        _clock(created).alias("phone_lead_time"),
        _s(F.col("o_custkey")).alias("merchant_id"),
        F.concat(F.lit("A"), _s(F.col("o_custkey"))).alias("cust_account_id"),
        F.col("o_orderpriority").alias("zone"),
        _s(F.col("o_orderkey") % 600).alias("duration"),
        F.col("o_orderstatus").alias("answer_status"),
    )


def online_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered online report: activity rows with a lead or empty click type; records
    weighing over 300 are missing; platforms and counters partly malformed."""
    a = activity(spark, sf_dir)
    ct = F.broadcast(click_type(spark))  # four constant rows; low-cardinality key: never a shuffle join
    eid = F.col("event_id")
    platform = (F.when(eid % 17 == 0, F.lit("")).when(eid % 19 == 0, F.lit("Tablet"))
                .when(F.col("is_mobile"), F.lit("Mobile")).otherwise(F.lit("Desktop")))
    et = F.col("event_type")
    lost = (F.col("impression_weight") + F.col("click_weight")) > 300
    return (a.filter((F.col("click_type_id") != 3) & ~lost)
            .join(ct, "click_type_id", "left")
            .select(
                eid.alias("event_id"),
                _s(F.col("activity_date")).alias("date_day"),
                _s(F.col("account_key")).alias("merchant_id"),
                F.concat(F.lit("A"), _s(F.col("account_key"))).alias("cust_account_id"),
                _s(F.when(et.isin("view", "error"), 1).otherwise(0)).alias("impressions"),
                F.coalesce(F.col("name"), F.lit("other")).alias("click_type_name"),
                _s(F.when(et.isin("click", "error"), 1).otherwise(0)).alias("clicks"),
                platform.alias("platform"),
                F.col("keywords").alias("keyword"),
            ))


def _activity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw comma-separated activity export lines (18 fields; some short, some with a bad key),
    with the event id and the name of the daily export each belongs to."""
    from leadscope.sources.exports import CHANNEL_FILE_PREFIXES

    a = activity(spark, sf_dir)
    eid = F.col("event_id")
    key = F.when(eid % 89 == 0, F.lit("bad")).otherwise(_s(F.col("account_key")))
    imp = F.when(eid % 11 == 0, F.lit("n/a")).otherwise(_s(eid % 10))
    full = F.concat(
        F.lit('"'), _s(eid), F.lit('",s,"'), key, F.lit('","'), _s(F.col("activity_date")),
        F.lit('","'), _s(eid % 7), F.lit('","'), _s(eid % 25), F.lit('",r,"'), _s(eid % 3),
        F.lit('",a,b,c,d,'), imp, F.lit(","), _s(eid % 4), F.lit(',e,"'), _s(eid % 2),
        F.lit('",f,"'), F.col("event_type"), F.lit('"'))
    short = F.concat(F.lit("x,y,"), _s(F.col("account_key")))
    export = F.concat(F.when(F.col("is_mobile"), F.lit(CHANNEL_FILE_PREFIXES["mobile"]))
                      .otherwise(F.lit(CHANNEL_FILE_PREFIXES["online"])), _s(F.col("activity_date")))
    return a.select(eid.alias("event_id"), F.when(eid % 97 == 0, short).otherwise(full).alias("line"),
                    export.alias("export"))


def activity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw comma-separated activity export lines with their event id."""
    return _activity_lines(spark, sf_dir).select("event_id", "line")


def activity_export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw activity lines with the name of the daily export they belong to
    (``deduped-<day>`` online, ``API_DTA_D_<day>`` mobile)."""
    return _activity_lines(spark, sf_dir).select("export", "line")


def account_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw semicolon-separated account export lines with every vertical shape."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    shape = (key % 8).cast("int")
    key_text = (F.when(shape == 6, F.concat(F.lit('"'), _s(key), F.lit('"')))
                .when(shape == 7, F.concat(F.lit("k"), _s(key))).otherwise(_s(key)))
    vertical = (F.when(shape == 0, F.lit("MERCHANT")).when(shape == 1, F.lit('"MERCHANT"'))
                .when(shape == 2, F.lit("")).when(shape == 3, F.lit('""'))
                .when(shape == 4, F.lit(" client ")).when(shape == 5, F.lit("AGENCY"))
                .when(shape == 6, F.lit("CLIENT")).otherwise(F.lit("MERCHANT")))
    full = F.concat(key_text, F.lit(";"), F.col("c_mktsegment"), F.lit(";A"), _s(key), F.lit(";"),
                    F.col("c_name"), F.lit(";"), vertical)
    short = F.concat(_s(key), F.lit(";"), F.col("c_mktsegment"))
    return c.select(key.alias("record_id"), F.when(key % 13 == 0, short).otherwise(full).alias("line"))


def extract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw semicolon-separated monthly extract lines: key, directory, impressions, clicks as text; some
    lines are short or without a usable key, some amounts lie beyond BIGINT or have many decimals, and some
    records have two lines more whose huge amounts cancel each other, or leave one that does not."""
    a = activity(spark, sf_dir)
    eid = F.col("event_id")
    key_text = (F.when(eid % 103 == 0, F.concat(F.lit("key"), _s(F.col("account_key"))))
                .when(eid % 5 == 0, F.concat(F.lit('"'), _s(F.col("account_key")), F.lit('"')))
                .otherwise(_s(F.col("account_key"))))
    directory = F.when(eid % 107 == 0, F.lit("")).otherwise(_s(F.col("directory_id")))
    imp = (F.when(eid % 211 == 0, F.lit("3e30")).when(eid % 223 == 0, F.lit("9000000000000000000"))
           .when(eid % 227 == 0, F.lit("0.25000000000001")).when(eid % 11 == 0, F.lit("n/a"))
           .otherwise(_s(F.col("impression_weight"))))
    clk = (F.when(eid % 229 == 0, F.lit("-3e30")).when(eid % 13 == 0, F.lit(""))
           .otherwise(_s(F.col("click_weight"))))

    def full(impressions: Column, clicks: Column) -> Column:
        return F.concat(key_text, F.lit(";m;m;m;m;"), directory, F.lit(";m;m;m;m;m;m;"), impressions, F.lit(";"), clicks)

    short = F.concat(_s(F.col("account_key")), F.lit(";m;m"))
    line = F.when(eid % 101 == 0, short).otherwise(full(imp, clk))
    lines = (F.when(eid % 53 == 4, F.array(line, full(F.lit("1e60"), F.lit("-1.5e308")), full(F.lit("-1e60"), F.lit("1.5e308"))))
             .when(eid % 59 == 6, F.array(full(F.lit("-1e60"), F.lit("7e40")), line, full(F.lit("1e60"), F.lit(""))))
             .otherwise(F.array(line)))
    return a.select(eid.alias("record_id"), F.explode(lines).alias("line"))
