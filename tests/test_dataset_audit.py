"""Partitioned dataset (pruning, missing days) and the date audits."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from leadscope.functions.dates import component_violation, is_date_text
from leadscope.operators import audit
from leadscope.plans import fixtures as fx
from leadscope.sources import dataset
from tests.conftest import SF001, as_parquet


def test_dataset_round_trip_prunes_partitions(spark, scratch):
    act = fx.activity(spark, SF001)
    path = dataset.export_activity(act, os.path.join(scratch, "activity"), sample_fraction=0.5)
    ds = dataset.read_activity_dataset(spark, path)
    assert {r.snapshot for r in ds.select("snapshot").distinct().collect()} == {"full", "sample"}
    rng = dataset.day_range(ds, "2024-01-10", "2024-01-12", channels="online")
    plan = rng._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "activity_date" in plan and "channel" in plan
    want = act.filter((F.col("activity_date") >= dt.date(2024, 1, 10)) & (F.col("activity_date") <= dt.date(2024, 1, 12))
                      & ~F.col("is_mobile")).count()
    assert rng.count() == want
    # re-export (a retried job) leaves the same rows
    dataset.write_activity_dataset(act, path, "full")
    assert dataset.day_range(dataset.read_activity_dataset(spark, path), "2024-01-01", "2024-01-31").count() == act.count()


def test_clustered_export_bounds_files_per_day(spark, scratch):
    import glob

    act = fx.activity(spark, SF001).repartition(4)   # every split holds every day
    path = dataset.write_activity_dataset(act, os.path.join(scratch, "clustered"), files_per_day=2)
    day_dirs = glob.glob(os.path.join(path, "channel=*", "snapshot=full", "activity_date=*"))
    assert day_dirs and all(len(glob.glob(os.path.join(d, "*.parquet"))) <= 2 for d in day_dirs)
    assert dataset.read_activity_dataset(spark, path).count() == act.count()


def test_missing_days_anti_join(spark, scratch):
    act = fx.activity(spark, SF001)
    gap = act.filter(~((F.col("activity_date") == dt.date(2024, 1, 7)) & F.col("is_mobile")))
    path = dataset.write_activity_dataset(gap, os.path.join(scratch, "gap"))
    ds = dataset.read_activity_dataset(spark, path)
    missing = dataset.missing_days(dataset.day_range(ds, "2024-01-01", "2024-01-30"),
                                   dataset.expected_days(spark, "2024-01-01", "2024-01-30"))
    got = {(r.activity_date, r.channel) for r in missing.collect()}
    assert (dt.date(2024, 1, 7), "mobile") in got
    assert (dt.date(2024, 1, 7), "online") not in got


def test_reexport_leaves_nothing_behind(spark, scratch):
    act = fx.activity(spark, SF001)
    path = os.path.join(scratch, "again")
    days = ("2024-01-01", "2024-01-31", dataset.CHANNELS)
    dataset.export_activity(act, path, sample_fraction=0.5, identity=["event_id"], covered=days)
    less = act.filter(~((F.col("activity_date") == dt.date(2024, 1, 7)) & F.col("is_mobile")))
    dataset.export_activity(less, path, sample_fraction=0.02, identity=["event_id"], covered=days)
    ds = dataset.read_activity_dataset(spark, path)
    keys = ["event_id"]
    assert sorted(r[0] for r in ds.where("snapshot = 'full'").select(*keys).collect()) == sorted(
        r[0] for r in less.select(*keys).collect())
    assert sorted(r[0] for r in ds.where("snapshot = 'sample'").select(*keys).collect()) == sorted(
        r[0] for r in less.where(dataset.drawn(keys, 0.02, 1)).select(*keys).collect())
    present = {(r.activity_date, r.channel) for r in dataset.present_days(spark, path).collect()}
    assert present == {(r.activity_date, r.channel) for r in ds.select("activity_date", "channel").distinct().collect()}
    # an export of one day leaves the other days alone
    one = act.where("activity_date = '2024-01-07'")
    dataset.export_activity(one, path, sample_fraction=None)
    assert dataset.read_activity_dataset(spark, path).where("snapshot = 'full'").count() == act.count()


def test_sample_does_not_depend_on_the_layout(spark):
    act = fx.activity(spark, SF001)
    draw = lambda df, seed=1: sorted(r[0] for r in df.where(dataset.drawn(["event_id"], 0.1, seed)).select("event_id").collect())
    assert draw(act) == draw(act.repartition(7)) == draw(act.orderBy(F.desc("event_id"))) != draw(act, 2)
    assert 0.05 * act.count() < len(draw(act)) < 0.15 * act.count()


def test_accounts_round_trip(spark, scratch):
    acc = fx.account(spark, SF001)
    _, path = dataset.export_everything(fx.activity(spark, SF001), acc, os.path.join(scratch, "all"), sample_fraction=None)
    dataset.register_accounts_view(spark, path, "accounts_again")
    assert sorted(map(tuple, spark.sql("SELECT * FROM accounts_again").collect())) == sorted(map(tuple, acc.collect()))
    dataset.write_accounts(acc.limit(3), path)             # an export replaces the table
    assert dataset.read_accounts(spark, path).count() == 3


COMPONENT_CASES = (
    [(v, "MM", True) for v in range(1, 13)] + [(v, "MM", False) for v in list(range(-10, 1)) + list(range(13, 34))]
    + [(v, "DD", True) for v in range(1, 32)] + [(v, "DD", False) for v in list(range(-10, 1)) + list(range(32, 46))]
    + [(v, "hh", True) for v in range(1, 25)] + [(v, "hh", False) for v in list(range(-10, 1)) + list(range(25, 46))]
    + [(v, "mm", True) for v in range(1, 61)] + [(v, "mm", False) for v in list(range(-10, 1)) + list(range(61, 91))]
    + [(v, "ss", True) for v in range(1, 61)] + [(v, "ss", False) for v in list(range(-10, 1)) + list(range(61, 91))]
    + [(v, "YY", True) for v in (-2147483648, 0, 2014, 2147483647)]
    + [(12, "random stuff", False), (1, "M", False), (5, " MM ", True), (5, "MMM", True)]
)


def test_component_ranges_table(spark, scratch):
    df = as_parquet(spark, COMPONENT_CASES, "value int, component string, valid boolean", scratch)
    out = df.select("value", "component", "valid", component_violation(F.col("value"), F.col("component")).alias("m"))
    bad = [(r.value, r.component) for r in out.collect() if r.valid != (r.m is None)]
    assert not bad, bad
    msg = out.filter((F.col("component") == "ss") & (F.col("value") == 0)).first().m
    assert msg == "ss=0, allowed 1-60"


def test_date_texts(spark, scratch):
    rows = [("2014-02-28", True), ("2014-02-31", False), ("2014-2-3", False), ("2014-02-03\n", False),
            ("x2014-02-03", False), ("2016-02-29", True), ("", False), (None, False)]
    df = as_parquet(spark, rows, "t string, ok boolean", scratch)
    got = [(r.t, r.ok, r.g) for r in df.select("t", "ok", is_date_text("t").alias("g")).collect()]
    assert all(a == b for _, a, b in got), got


def test_component_audit_flags_zero_hours(spark):
    got = {(r.component, r.value): r.message for r in audit.date_component_audit(fx.activity(spark, SF001)).collect()}
    assert got[("YY", 2024)] is None
    assert got[("hh", 0)] == "hh=0, allowed 1-24"
    assert got[("MM", 1)] is None


def test_sample_repeats_with_its_seed(spark):
    from leadscope.plans import catalog

    a = sorted(r.event_id for r in catalog.JOBS["activity_sample"](spark, "/root/testdata/sf0.1").collect())
    b = sorted(r.event_id for r in catalog.JOBS["activity_sample"](spark, "/root/testdata/sf0.1").collect())
    assert a == b and 40 <= len(a) <= 200   # 0.1 % of 100,000 rows, same rows for the same seed


def test_one_pass_export_sample_is_repeatable(spark, scratch):
    act = fx.activity(spark, "/root/testdata/sf0.01")
    sampled = []
    for name in ("first", "again"):
        path = dataset.export_activity(act, os.path.join(scratch, name), sample_fraction=0.05, seed=1)
        ds = dataset.read_activity_dataset(spark, path)
        assert ds.filter(F.col("snapshot") == "full").count() == act.count()
        sampled.append(sorted(r.event_id for r in ds.filter(F.col("snapshot") == "sample").select("event_id").collect()))
    assert sampled[0] == sampled[1]
    assert 300 <= len(sampled[0]) <= 700   # 5 % of 10,000 rows


def test_registered_view_prunes_partitions(spark, scratch):
    path = dataset.write_activity_dataset(fx.activity(spark, SF001), os.path.join(scratch, "view"))
    dataset.register_activity_view(spark, path, "activity_view_test")
    q = spark.sql("SELECT count(*) AS n FROM activity_view_test "
                  "WHERE activity_date BETWEEN DATE'2024-01-10' AND DATE'2024-01-12' AND channel = 'online'")
    assert "PartitionFilters: [isnotnull(activity_date" in q._jdf.queryExecution().executedPlan().toString()
    assert q.first().n == dataset.day_range(dataset.read_activity_dataset(spark, path),
                                            "2024-01-10", "2024-01-12", "online").count()


def test_reversed_calendar_range_is_refused(spark):
    import pytest

    with pytest.raises(ValueError):
        dataset.expected_days(spark, "2024-01-31", "2024-01-01")


def test_missing_component_value_is_flagged(spark, scratch):
    df = as_parquet(spark, [(None, "hh"), (None, "YY"), (5, "hh")], "value int, component string", scratch)
    got = [r.m for r in df.select(component_violation(F.col("value"), F.col("component")).alias("m")).collect()]
    assert got == ["no value", None, None]


def test_unknown_component_wins_over_missing_value(spark, scratch):
    df = as_parquet(spark, [(None, "hx")], "value int, component string", scratch)
    assert df.select(component_violation(F.col("value"), F.col("component")).alias("m")).first().m == \
        "no rule for component hx"


def test_input_is_evaluated_once(spark, scratch):
    """A source that counts its rows: an export of both snapshots reads it one time."""
    rows = spark.sparkContext.accumulator(0)
    act = fx.activity(spark, SF001)

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    counted = act.mapInArrow(count, act.schema)
    path = dataset.export_activity(counted, os.path.join(scratch, "once"), sample_fraction=0.5, identity=["event_id"],
                                   covered=("2024-01-01", "2024-01-31", dataset.CHANNELS))
    assert rows.value == act.count()
    assert dataset.read_activity_dataset(spark, path).where("snapshot = 'full'").count() == rows.value


def test_a_killed_export_changes_nothing(spark, scratch, monkeypatch):
    act = fx.activity(spark, SF001)
    path = dataset.export_activity(act.where("event_id % 2 = 0"), os.path.join(scratch, "killed"), sample_fraction=None)
    before = sorted(r[0] for r in dataset.read_activity_dataset(spark, path).select("event_id").collect())
    reader = dataset.read_activity_dataset(spark, path)
    failing = act.withColumn("keywords", F.when(F.col("event_id") % 50 == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("keywords")))
    with pytest.raises(Exception, match="lost"):
        dataset.export_activity(failing, path, sample_fraction=None)
    # staged in full, killed before the manifest
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        def stop(*_):
            raise KeyboardInterrupt
        m.setattr(dataset, "manifest", stop)
        dataset.export_activity(act, path, sample_fraction=None)
    assert sorted(r[0] for r in dataset.read_activity_dataset(spark, path).select("event_id").collect()) == before
    dataset.export_activity(act, path, sample_fraction=None)
    assert dataset.read_activity_dataset(spark, path).count() == act.count()
    assert sorted(r[0] for r in reader.select("event_id").collect()) == before       # a reader keeps what it saw
    assert dataset.superseded(spark, path).count() > 0


def test_manifest_counts_rows_and_files(spark, scratch):
    act = fx.activity(spark, SF001).repartition(3)
    path = dataset.write_activity_dataset(act, os.path.join(scratch, "counted"), max_records_per_file=4)
    lines = dataset._current(dataset.manifest(spark, path))
    want = {(r.channel, r.activity_date): r.n for r in dataset.rows_per_day(dataset.read_activity_dataset(spark, path)).collect()}
    assert {(r.channel, r.activity_date): r.rows for r in lines.collect()} == want
    assert all(r.files >= -(-r.rows // 4) for r in lines.collect())


def test_empty_exports_and_unusual_partitions(spark, scratch):
    act = fx.activity(spark, SF001)
    path = dataset.export_activity(act.limit(0), os.path.join(scratch, "empty"), sample_fraction=None)
    assert dataset.read_activity_dataset(spark, path).count() == 0 == dataset.present_days(spark, path).count()
    odd = act.withColumn("channel", F.when(F.col("event_id") % 3 == 0, F.lit("a/b=c %d:é'")).when(
        F.col("event_id") % 3 == 1, F.lit(None).cast("string")).otherwise(F.lit("online")))
    dataset.export_activity(odd, path, sample_fraction=None)
    back = dataset.read_activity_dataset(spark, path)
    assert back.select("event_id", "channel").exceptAll(odd.select("event_id", "channel")).isEmpty()
    assert back.count() == act.count()


def test_account_readers_follow_the_manifest(spark, scratch):
    acc = fx.account(spark, SF001)
    path = dataset.write_accounts(acc, os.path.join(scratch, "acc"))
    held = dataset.read_accounts(spark, path)
    dataset.write_accounts(acc.limit(3), path)
    assert held.count() == acc.count() and dataset.read_accounts(spark, path).count() == 3
    dataset.write_accounts(acc.limit(0), path)
    assert dataset.read_accounts(spark, path).count() == 0
