"""The activity dataset: one Parquet dataset partitioned by channel, snapshot and day.

This replaces one file and one table per channel × day × fullness.  A day range of one
channel is a partition filter (only the matching folders are listed and read), and a
missing day is a row of an anti join, not an exception.

By default writing does not shuffle: each task writes the days it holds, sorted by the
partition columns so one file is open at a time, and ``max_records_per_file`` bounds file
size.  That suits exports whose input files are per day and channel.  When every input
split mixes many days, ``files_per_day`` clusters rows first: a shuffle on (channel,
snapshot, day, bucket) with a deterministic bucket from a row hash, so each day gets that
many files (and a hot day is spread over that many tasks) and a retried task sends every
row to the same place.
An export replaces whole days: it covers the (channel, day) pairs that its rows hold, and those of a
range it names.  Its files are staged under a name of their own (the innermost partition ``export``) and
become visible together, when one manifest file beside the dataset is written last: a line per (channel,
snapshot, day) it covers with the rows and files there, zero rows for those it empties.  Readers take each
partition from the latest manifest line about it, so none sees an export in part, and an export that is
killed changes nothing.  The rows to write are evaluated once; counts come from the footers of the staged files.
Superseded files stay until the folder is tidied (``superseded`` lists them).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadscope.functions.dates import date_argument

PARTITION_COLUMNS = ("channel", "snapshot", "activity_date")
# The two channels and the two snapshot kinds.
CHANNELS = ("online", "mobile")
SNAPSHOTS = ("full", "sample")

EXPORT = "export"
_MANIFEST_SCHEMA = ("version long, export string, schema string, channel string, snapshot string, activity_date date, "
                    "rows long, files long")
# Characters that Spark writes as %XX in the folder names of partitions, and its name for NULL.
_ESCAPED = {chr(c) for c in range(1, 32)} | set('"#%\'*/:=?\\{}[]^\x7f')
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def with_partition_columns(activity: DataFrame, snapshot: str = "full") -> DataFrame:
    """Adds channel (from ``is_mobile`` unless present), snapshot and activity_date."""
    df = activity
    if "channel" not in df.columns:
        df = df.withColumn("channel", F.when(F.col("is_mobile"), F.lit("mobile")).otherwise(F.lit("online")))
    if "activity_date" not in df.columns:
        df = df.withColumn("activity_date", F.col("activity_ts").cast("date"))
    return df.withColumn("snapshot", F.lit(snapshot))


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}-manifest"


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """Every line of the dataset's manifest; None where there is none (a streamed dataset)."""
    try:
        return spark.read.schema(_MANIFEST_SCHEMA).json(manifest_path(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _current(lines: DataFrame) -> DataFrame:
    """The latest line about each partition: channel, snapshot, activity_date, export, rows, files."""
    latest = F.max_by(F.struct(EXPORT, "rows", "files"), F.struct("version", EXPORT)).alias("last")
    return (lines.where("schema is null").groupBy(*PARTITION_COLUMNS).agg(latest)
            .select(*PARTITION_COLUMNS, "last.*"))


def _folder(path: str, names: tuple[str, ...], part: Row) -> str:
    def value(x: object) -> str:
        text = _NULL_FOLDER if x is None or x == "" else str(x)
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)
    return "/".join([path.rstrip("/"), *(f"{n}={value(part[n])}" for n in names), f"{EXPORT}={part[EXPORT]}"])


def _read(spark: SparkSession, path: str, names: tuple[str, ...]) -> DataFrame:
    lines = manifest(spark, path)
    if lines is None:
        return spark.read.option("basePath", path).parquet(path)
    newest = lines.where("schema is not null").orderBy(F.desc("version"), F.desc(EXPORT)).first()
    schema = StructType.fromJson(json.loads(newest["schema"]))
    parts = _current(lines).where("rows > 0").collect()               # one small row per partition
    if not parts:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(StructType([*schema.fields]).add(EXPORT, "string")).option("basePath", path)
            .parquet(*[_folder(path, names, p) for p in parts]).select(*schema.names))


def _publish(df: DataFrame, path: str, names: tuple[str, ...], max_records_per_file: int,
             emptied: DataFrame | None = None, both_snapshots: bool = False) -> str:
    """Stage the rows of ``df`` as one export and make them visible.  ``names``: its partition columns;
    ``emptied``: further (activity_date, channel) pairs that the export speaks for."""
    spark, export = df.sparkSession, "e" + uuid.uuid4().hex
    seen = Observation()
    watched = df.observe(seen, F.collect_set(F.struct(*names, F.lit(export).alias(EXPORT))).alias("parts"))
    placed = watched.withColumn(EXPORT, F.lit(export))
    ((placed.sortWithinPartitions(*names) if names else placed)
     .write.mode("append").option("maxRecordsPerFile", max_records_per_file).partitionBy(*names, EXPORT).parquet(path))
    parts = seen.get["parts"] or []                                   # partitions with rows
    none = [F.lit(None).cast(t).alias(n) for n, t in zip(PARTITION_COLUMNS, ("string", "string", "date")) if n not in names]
    schema = StructType([*df.schema.fields])
    if parts:
        staged = (spark.read.schema(StructType([*df.schema.fields]).add(EXPORT, "string")).option("basePath", path)
                  .parquet(*[_folder(path, names, p) for p in parts]))
        counts = (staged.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("_metadata.file_path").alias("files"))
                  .select(*names, *none, "rows", "files").select(*PARTITION_COLUMNS, "rows", "files"))
    else:
        # an empty table that is not partitioned replaces the one before; an empty dataset names no partition
        counts = spark.createDataFrame([] if names else [(None, None, None, 0, 0)],
                                       "channel string, snapshot string, activity_date date, rows long, files long")
    if both_snapshots:
        pairs = counts.select("activity_date", "channel")
        pairs = (pairs if emptied is None else pairs.union(emptied.select("activity_date", "channel"))).distinct()
        spoken = pairs.select("channel", F.explode(F.array(*[F.lit(s) for s in SNAPSHOTS])).alias("snapshot"), "activity_date")
        empty = spoken.select(*PARTITION_COLUMNS, F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("files"))
        counts = counts.union(empty).groupBy(*PARTITION_COLUMNS).agg(F.sum("rows").alias("rows"), F.sum("files").alias("files"))
    earlier = manifest(spark, path)
    version = 1 + ((earlier.agg(F.max("version")).first()[0] if earlier is not None else 0) or 0)
    head = spark.range(1).select(F.lit(schema.json()).alias("schema"), *[F.lit(None).alias(c) for c in (*PARTITION_COLUMNS, "rows", "files")])
    lines = counts.withColumn("schema", F.lit(None).cast("string")).unionByName(head)
    # one file, so that it appears as a whole
    (lines.withColumn("version", F.lit(version)).withColumn(EXPORT, F.lit(export)).repartition(1)
     .write.mode("append").json(manifest_path(path)))
    return path


Covered = tuple[str | dt.date, str | dt.date, tuple[str, ...]]


def _clustered(df: DataFrame, files_per_day: int | None, hash_columns: list[str]) -> DataFrame:
    if not files_per_day:
        return df
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in hash_columns]), F.lit(files_per_day))
    return df.repartition(*[F.col(c) for c in PARTITION_COLUMNS], bucket)


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """(channel, snapshot, activity_date, export) of staged partitions that no reader takes any more."""
    lines = manifest(spark, path)
    if lines is None:
        raise ValueError(f"{path} has no manifest")
    live = _current(lines).select(*PARTITION_COLUMNS, EXPORT)
    old = lines.where("schema is null and rows > 0").select(*PARTITION_COLUMNS, EXPORT)
    return old.exceptAll(live)


def write_activity_dataset(activity: DataFrame, path: str, snapshot: str = "full",
                           max_records_per_file: int = 5_000_000, files_per_day: int | None = None) -> str:
    """Write ``activity`` as one snapshot of the dataset (only the days it holds are replaced)."""
    df = _clustered(with_partition_columns(activity, snapshot), files_per_day, activity.columns)
    return _publish(df, path, PARTITION_COLUMNS, max_records_per_file)


def drawn(identity: list[str], fraction: float, seed: int) -> Column:
    """Whether a row is in the sample of ``fraction``: the md5 of the seed and the row's identity, as a
    number below 2**32.  Any layout and any engine draw the same rows; equal identities go together."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity])
    return F.left(F.md5(F.encode(text, "UTF-8")), F.lit(8)) < F.lit(f"{round(fraction * (1 << 32)):08x}"[:8]) \
        if fraction < 1 else F.lit(True)


def export_activity(activity: DataFrame, path: str, sample_fraction: float | None = 0.001, seed: int = 1,
                    max_records_per_file: int = 5_000_000, files_per_day: int | None = None,
                    identity: list[str] | None = None, covered: Covered | None = None) -> str:
    """Full snapshot and (optionally) a sampled snapshot of the same activity, in one pass.

    Each row is written to ``snapshot=full`` and, when ``drawn`` by its ``identity`` columns (default:
    all columns), also to ``snapshot=sample``: one scan and one write job instead of two.
    ``covered`` = (first day, last day, channels) names days that the export speaks for even where it
    has no row."""
    df = with_partition_columns(activity, "full").drop("snapshot")
    snapshots = F.array(F.lit("full"))
    if sample_fraction:
        snapshots = F.when(drawn(identity or activity.columns, sample_fraction, seed),
                           F.array(F.lit("full"), F.lit("sample"))).otherwise(snapshots)
    both = df.withColumn("snapshot", F.explode(snapshots))
    emptied = None if covered is None else expected_days(activity.sparkSession, *covered)
    return _publish(_clustered(both, files_per_day, activity.columns), path, PARTITION_COLUMNS, max_records_per_file,
                    emptied, both_snapshots=True)


def write_accounts(account: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> str:
    """The account table as Parquet; every export replaces it as a whole, for readers at one moment."""
    return _publish(account, path, (), max_records_per_file)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ())


def register_accounts_view(spark: SparkSession, path: str, name: str = "account") -> DataFrame:
    df = read_accounts(spark, path)
    df.createOrReplaceTempView(name)
    return df


def export_everything(activity: DataFrame, account: DataFrame, root: str, **options) -> tuple[str, str]:
    """Both tables below ``root``: the partitioned activity (both snapshots) and the accounts."""
    return export_activity(activity, f"{root}/activity", **options), write_accounts(account, f"{root}/account")


def read_activity_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The published rows; a dataset without a manifest (a streamed one) is read as it lies."""
    return _read(spark, path, PARTITION_COLUMNS)


def register_activity_view(spark: SparkSession, path: str, name: str = "activity") -> DataFrame:
    """The dataset as a temporary view for SQL users; day, channel and snapshot predicates in
    the SQL still become partition filters."""
    df = read_activity_dataset(spark, path)
    df.createOrReplaceTempView(name)
    return df


def day_range(dataset: DataFrame, start: str | dt.date, end: str | dt.date,
              channels: str | tuple[str, ...] | None = None, snapshot: str = "full") -> DataFrame:
    """Rows of ``[start, end]`` (inclusive days) of the given channel(s) and snapshot.

    All three conditions are on partition columns, so they become PartitionFilters."""
    lo, hi = date_argument(start), date_argument(end)
    cond = (F.col("activity_date") >= F.lit(lo)) & (F.col("activity_date") <= F.lit(hi)) & \
           (F.col("snapshot") == F.lit(snapshot))
    if channels is not None:
        chans = (channels,) if isinstance(channels, str) else tuple(channels)
        cond = cond & F.col("channel").isin(*chans)
    return dataset.filter(cond)


def rows_per_day(dataset: DataFrame) -> DataFrame:
    return dataset.groupBy("activity_date", "channel").agg(F.count(F.lit(1)).alias("n"))


def expected_days(spark: SparkSession, start: str | dt.date, end: str | dt.date,
                  channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Every (day, channel) of the calendar range: generated with sequence + explode."""
    lo, hi = date_argument(start), date_argument(end)
    if lo > hi:
        raise ValueError(f"calendar range ends before it starts: {lo} > {hi}")
    days = F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 1 DAY"))
    return (spark.range(1)
            .select(F.explode(days).alias("activity_date"))
            .select("activity_date", F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel")))


def present_days(spark: SparkSession, path: str, snapshot: str = "full") -> DataFrame:
    """(activity_date, channel) of the days that have rows, from the manifest: no folder is listed and no row
    read.  Without a manifest (a streamed dataset) from the partition columns."""
    lines = manifest(spark, path)
    if lines is None:
        held = read_activity_dataset(spark, path).where(F.col("snapshot") == snapshot)
        return held.select("activity_date", "channel").distinct()
    found = _current(lines).where((F.col("rows") > 0) & (F.col("snapshot") == snapshot)).collect()   # days x channels
    return spark.createDataFrame([(r["activity_date"], r["channel"]) for r in found], "activity_date date, channel string")


def missing_days(present: DataFrame, expected: DataFrame) -> DataFrame:
    """(day, channel) pairs of ``expected`` that have no row in ``present``."""
    have = present.select("activity_date", "channel").distinct()
    return expected.join(have, ["activity_date", "channel"], "left_anti")
