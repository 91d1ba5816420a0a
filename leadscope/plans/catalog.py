"""The job catalogue: every job bound to the fixture views of one driver data directory.

Each entry takes (spark, sf_dir) and returns the job's DataFrame without running it – apart
from the size checks of broadcast candidates (small aggregate jobs over lookup sides) –
except jobs whose subject is a write (the partitioned export, the report files): those
write below the shared checkpoint folder and return the read-back DataFrame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadscope.operators import audit, leads, matching, profiles, share, totals
from leadscope.plans import fixtures as fx
from leadscope.session import shared_path
from leadscope.sources import bucketed, dataset, exports, sinks

Job = Callable[[SparkSession, str], DataFrame]


def heading_directory_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.heading_directory_profile(fx.activity(spark, sf_dir), fx.account(spark, sf_dir))


def merchant_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.merchant_profile(fx.activity(spark, sf_dir), fx.account(spark, sf_dir))


def merchant_profile_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant counting every search instead of one per day."""
    return profiles.merchant_profile(fx.activity(spark, sf_dir), fx.account(spark, sf_dir), per_date=False)


def merchant_profile_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant restricted to searches with a positive click weight."""
    return profiles.merchant_profile(fx.activity(spark, sf_dir), fx.account(spark, sf_dir), clicks_only=True)


def non_name_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share.non_name_share(fx.activity(spark, sf_dir), fx.account(spark, sf_dir), fx.location(spark, sf_dir),
                                since="2024-01-10")


def non_name_share_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share report's first ten merchants by name (a top-k report: the limit is the feature)."""
    return share.non_name_share(fx.activity(spark, sf_dir), fx.account(spark, sf_dir), fx.location(spark, sf_dir),
                                since="2024-01-10", limit=10)


def heading_directory_profile_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with the strict match: an empty normalised term matches no name."""
    return profiles.heading_directory_profile(fx.activity(spark, sf_dir), fx.account(spark, sf_dir), strict=True)


def name_match_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.name_match_flags(fx.activity(spark, sf_dir), fx.account(spark, sf_dir))


def edit_distance_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.edit_distance_profile(fx.activity(spark, sf_dir), fx.account(spark, sf_dir))


def activity_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.good(exports.parse_activity_lines(fx.activity_lines(spark, sf_dir)))


def activity_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.rejects(exports.parse_activity_lines(fx.activity_lines(spark, sf_dir)), "event_id")


def account_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.good(exports.parse_account_lines(fx.account_lines(spark, sf_dir)))


def account_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.rejects(exports.parse_account_lines(fx.account_lines(spark, sf_dir)), "record_id")


def monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    extract = exports.good(exports.parse_extract_lines(fx.extract_lines(spark, sf_dir)))
    return totals.monthly_totals(extract, fx.account(spark, sf_dir))


def activity_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0.1 % sample without replacement, seed 1, drawn by the row's identity."""
    return fx.activity(spark, sf_dir).where(dataset.drawn(["event_id"], 0.001, 1))


def _exported_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export the activity (full and 0.1 % sample snapshots) as the partitioned dataset
    below the shared checkpoint folder and read it back."""
    return dataset.read_activity_dataset(spark, _export(spark, sf_dir))


def _export(spark: SparkSession, sf_dir: str) -> str:
    return dataset.export_activity(fx.activity(spark, sf_dir), shared_path(spark, "activity"), identity=["event_id"])


def activity_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = _exported_activity(spark, sf_dir)
    return dataset.rows_per_day(dataset.day_range(ds, "2024-01-01", "2024-01-31", channels=dataset.CHANNELS))


def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = dataset.present_days(spark, _export(spark, sf_dir))
    return dataset.missing_days(present, dataset.expected_days(spark, "2024-01-01", "2024-01-31"))


def activity_day_range_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few days of one channel."""
    ds = _exported_activity(spark, sf_dir)
    return dataset.rows_per_day(dataset.day_range(ds, "2024-01-09", "2024-01-11", channels="online"))


def activity_reexport(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export, then a corrected one over the same days without a mobile day and with a smaller sample;
    rows per day, channel and snapshot of what is left."""
    activity = fx.activity(spark, sf_dir)
    path = shared_path(spark, "activity")
    days = ("2024-01-01", "2024-01-31", dataset.CHANNELS)
    dataset.export_activity(activity, path, sample_fraction=0.2, identity=["event_id"], covered=days)
    emptied = (F.col("activity_date") == F.lit("2024-01-05").cast("date")) & F.col("is_mobile")
    dataset.export_activity(activity.where(~emptied), path, sample_fraction=0.01, identity=["event_id"], covered=days)
    return (dataset.read_activity_dataset(spark, path).groupBy("activity_date", "channel", "snapshot")
            .agg(F.count(F.lit(1)).alias("n")))


def account_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables exported; the accounts read back."""
    accounts = exports.good(exports.parse_account_lines(fx.account_lines(spark, sf_dir)))
    _, path = dataset.export_everything(fx.activity(spark, sf_dir), accounts, shared_path(spark, "everything"),
                                        identity=["event_id"])
    return dataset.register_accounts_view(spark, path)


def extract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.rejects(exports.parse_extract_lines(fx.extract_lines(spark, sf_dir)), "record_id")


def activity_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with quoted commas, unpaired quotes and thousands of quoted fields, split outside quotes."""
    parsed = exports.parse_activity_lines(fx.quoted_lines(spark, sf_dir), quoted=True)
    return parsed.select("event_id", "account_key", "keywords", "date_text", "heading_id",
                         F.col("reject_reason").alias("reason"))


# Day ranges of the lead check: the online fixture covers January 2024, the phone one 1995-2001.
ONLINE_RANGE = ("2024-01-05", "2024-01-20")
PHONE_RANGE = ("1996-01-01", "1996-12-31")


def child_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.child_accounts(fx.account_bridge(spark, sf_dir))


def child_accounts_one_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.child_accounts(fx.account_bridge(spark, sf_dir), parents="P7")


def online_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.online_leads(fx.activity(spark, sf_dir), fx.click_type(spark), fx.account_bridge(spark, sf_dir),
                              *ONLINE_RANGE)


def phone_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.phone_leads(fx.phone_lead(spark, sf_dir), fx.account_bridge(spark, sf_dir), *PHONE_RANGE)


def online_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.online_report(fx.online_report(spark, sf_dir), fx.account_bridge(spark, sf_dir), *ONLINE_RANGE)


def phone_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.phone_report(fx.phone_report(spark, sf_dir), fx.account_bridge(spark, sf_dir), *PHONE_RANGE)


def lead_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.lead_reconciliation(
        fx.activity(spark, sf_dir), fx.click_type(spark), fx.phone_lead(spark, sf_dir),
        fx.online_report(spark, sf_dir), fx.phone_report(spark, sf_dir), fx.account_bridge(spark, sf_dir),
        *ONLINE_RANGE, *PHONE_RANGE)


def lead_reconciliation_one_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.lead_reconciliation(
        fx.activity(spark, sf_dir), fx.click_type(spark), fx.phone_lead(spark, sf_dir),
        fx.online_report(spark, sf_dir), fx.phone_report(spark, sf_dir), fx.account_bridge(spark, sf_dir),
        *ONLINE_RANGE, *PHONE_RANGE, parents="P7")


def report_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.report_violations(fx.online_report(spark, sf_dir), fx.account_bridge(spark, sf_dir), *ONLINE_RANGE)


def report_violations_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.report_violations(fx.online_report(spark, sf_dir), fx.account_bridge(spark, sf_dir), *ONLINE_RANGE,
                                   reconciliation=lead_reconciliation(spark, sf_dir))


def date_component_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.date_component_audit(fx.activity(spark, sf_dir), "activity_ts")


def date_text_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = exports.good(exports.parse_activity_lines(fx.activity_lines(spark, sf_dir)))
    return audit.date_text_audit(parsed, "date_text")


def report_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship profile written as a tab-separated report folder and read back."""
    df = heading_directory_profile(spark, sf_dir)
    path = sinks.write_tsv(df, shared_path(spark, "reports", "heading_directory"))
    return sinks.read_tsv(spark, path, df.schema)


def share_report_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The non-name share of awkwardly named accounts, written as comma files with a header and read back."""
    df = share.non_name_share(fx.activity(spark, sf_dir), fx.awkward_account(spark, sf_dir), fx.location(spark, sf_dir),
                              since="2024-01-10")
    path = sinks.write_csv_with_header(df, shared_path(spark, "reports", "non_name_share"))
    return sinks.read_csv_with_header(spark, path, df.schema)


def merchant_report_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merchant profile of awkwardly named accounts, written tab-separated and read back."""
    df = profiles.merchant_profile(fx.activity(spark, sf_dir), fx.awkward_account(spark, sf_dir))
    path = sinks.write_tsv(df, shared_path(spark, "reports", "merchant"))
    return sinks.read_tsv(spark, path, df.schema)


def totals_report_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly totals written tab-separated and read back."""
    df = monthly_totals(spark, sf_dir)
    path = sinks.write_tsv(df, shared_path(spark, "reports", "totals"))
    return sinks.read_tsv(spark, path, df.schema)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental ingest over raw export files written from the driver tables (one
    folder per channel and day, named like the exports): an availableNow stream converts
    them into the partitioned dataset; rows per day and channel are read back."""
    from leadscope.streaming import start_activity_ingest

    root = shared_path(spark, "stream")
    fx.activity_export_lines(spark, sf_dir).write.partitionBy("export").text(f"{root}/source")
    start_activity_ingest(spark, f"{root}/source", f"{root}/dataset", f"{root}/rejects",
                          f"{root}/checkpoints").await_all()
    return dataset.rows_per_day(dataset.read_activity_dataset(spark, f"{root}/dataset"))


def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The activity and the accounts as a bucketed pair, named by a second registration as a later session would."""
    path, name = shared_path(spark, "bucketed"), "t" + uuid.uuid4().hex
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed.write_pair(fx.activity(spark, sf_dir), fx.account(spark, sf_dir), path, f"{name}_written", buckets=buckets)
    return bucketed.register_pair(spark, path, name)


def heading_directory_profile_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship over bucketed tables: neither side is shuffled for the join."""
    activity, account = _bucketed(spark, sf_dir)
    return profiles.heading_directory_profile(activity, account, on=("account_key", bucketed.SALT))


def non_name_share_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity, account = _bucketed(spark, sf_dir)
    return share.non_name_share(activity, account, fx.location(spark, sf_dir), since="2024-01-10",
                                on=("account_key", bucketed.SALT))


def activity_ingest_compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The activity lines from gzip files, each decompressed by one task and parsed by many."""
    path = shared_path(spark, "compressed")
    fx.activity_lines(spark, sf_dir).select("line").write.option("compression", "gzip").text(path)
    parsed = exports.parse_activity_lines(exports.read_lines(spark, path, whole_bytes=0))
    return exports.good(parsed).drop("source_file")


JOBS: dict[str, Job] = {
    "heading_directory_profile": heading_directory_profile,  # J7 (flagship)
    "merchant_profile": merchant_profile,  # J8
    "merchant_profile_all_rows": merchant_profile_all_rows,  # J8, G4
    "merchant_profile_clicks": merchant_profile_clicks,  # J8, F11
    "non_name_share": non_name_share,  # J10
    "non_name_share_top10": non_name_share_top10,  # J10, O2
    "heading_directory_profile_strict": heading_directory_profile_strict,  # J7, strict match
    "name_match_flags": name_match_flags,  # J16
    "edit_distance_profile": edit_distance_profile,  # J17
    "activity_ingest": activity_ingest,  # J1
    "activity_rejects": activity_rejects,  # J2
    "account_ingest": account_ingest,  # J3
    "account_rejects": account_rejects,  # J3 rejects
    "monthly_totals": monthly_totals,  # J9
    "activity_sample": activity_sample,  # J6
    "activity_day_range": activity_day_range,  # J4
    "missing_days": missing_days,  # J5
    "stream_ingest": stream_ingest,  # S1 + K1, incremental
    "child_accounts": child_accounts,  # J11
    "online_leads": online_leads,  # J12
    "phone_leads": phone_leads,  # J12
    "online_report": online_report,  # J13
    "phone_report": phone_report,  # J13
    "lead_reconciliation": lead_reconciliation,  # J14
    "report_violations": report_violations,  # J15
    "report_violations_reconciled": report_violations_reconciled,  # J15, D5
    "date_component_audit": date_component_audit,  # J18
    "date_text_audit": date_text_audit,  # J18 (X6)
    "report_write": report_write,  # J19, K4
    "share_report_write": share_report_write,  # J19, K5
    "merchant_report_write": merchant_report_write,  # J8, K4
    "totals_report_write": totals_report_write,  # J9, K4
    "extract_rejects": extract_rejects,  # J9 rejects
    "activity_quoted": activity_quoted,  # S1, quoted fields
    "activity_day_range_online": activity_day_range_online,  # J4, S7
    "activity_reexport": activity_reexport,  # J1, K1, K3
    "account_export": account_export,  # K2, K3, S4
    "child_accounts_one_parent": child_accounts_one_parent,  # J11, F10
    "lead_reconciliation_one_parent": lead_reconciliation_one_parent,  # J14, F8
    "heading_directory_profile_bucketed": heading_directory_profile_bucketed,  # J7, N1 without a shuffle
    "non_name_share_bucketed": non_name_share_bucketed,  # J10, N3 without a shuffle
    "activity_ingest_compressed": activity_ingest_compressed,  # J1, S1 from unsplittable files
}

FLAGSHIP = "heading_directory_profile"
