"""Bucketed pairs: joins without a shuffle, hot keys over many buckets, registration in another session."""

import uuid

import pytest
from pyspark.sql import functions as F

from leadscope.operators import profiles, share
from leadscope.plans import fixtures as fx
from leadscope.sources import bucketed
from tests.conftest import SF01
from tests.test_scale import NoBroadcast

ON = ("account_key", bucketed.SALT)


def _name():
    return "t" + uuid.uuid4().hex


def _hot_activity(spark):
    act = fx.activity(spark, SF01)
    return act.withColumn("account_key", F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("account_key")).cast("long"))


def _below_join(plan: str) -> str:
    """The part of an initial physical plan below its first sort-merge join."""
    return plan[plan.index("SortMergeJoin"):]


def test_join_shuffles_neither_side_and_rows_are_equal(spark, scratch):
    act, acc = _hot_activity(spark), fx.account(spark, SF01)
    rows, accounts = bucketed.write_pair(act, acc, f"{scratch}/pair", _name(), buckets=8, hot_rows=400)
    want = sorted(map(str, profiles.heading_directory_profile(act, acc).collect()))
    with NoBroadcast(spark):
        df = profiles.heading_directory_profile(rows, accounts, on=ON)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, df.collect())) == want
    assert "Exchange" not in _below_join(plan) and plan.count("Bucketed: true") == 2
    assert plan.count("Exchange hashpartitioning") == 1                        # the counters per heading and directory


def test_share_over_the_pair(spark, scratch):
    act, acc, loc = _hot_activity(spark), fx.account(spark, SF01), fx.location(spark, SF01)
    rows, accounts = bucketed.write_pair(act, acc, f"{scratch}/pair", _name(), buckets=8, hot_rows=400)
    want = share.non_name_share(act, acc, loc, since="2024-01-10").collect()
    with NoBroadcast(spark):
        df = share.non_name_share(rows, accounts, loc, since="2024-01-10", on=ON)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.collect() == want
    # between the scan of the activity and the join with the names lies no exchange
    scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan" in line and "keywords" in line)
    join = max(i for i, line in enumerate(plan.splitlines()[:scan]) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in plan.splitlines()[join:scan])
    assert plan.count("Bucketed: true") >= 2


def test_hot_key_lies_in_many_buckets(spark, scratch):
    act, acc = _hot_activity(spark), fx.account(spark, SF01)
    rows, accounts = bucketed.write_pair(act, acc, f"{scratch}/pair", _name(), buckets=16, hot_rows=200)
    total = act.where("account_key = 7").count()
    files = (rows.where("account_key = 7").groupBy(F.col("_metadata.file_path")).count()).collect()
    assert sum(r["count"] for r in files) == total > 3_000
    assert len(files) >= 8 and max(r["count"] for r in files) < total / 3
    assert rows.select(*act.columns).exceptAll(act).isEmpty() and rows.count() == act.count()
    assert accounts.where("_salt = 0").drop("_salt").exceptAll(acc).isEmpty()
    assert accounts.where("_salt = 0").count() == acc.count() < accounts.count()


def test_registration_outlives_the_session(spark, scratch):
    path = f"{scratch}/it's a pair"
    act, acc = fx.activity(spark, SF01), fx.account(spark, SF01)
    first = bucketed.write_pair(act, acc, path, _name(), buckets=4)
    name = _name()
    for table in ("activity", "account"):
        assert not spark.catalog.tableExists(f"{name}_{table}")
    rows, accounts = bucketed.register_pair(spark.newSession(), path, name)
    assert rows.schema == first[0].schema and rows.count() == act.count() and accounts.count() == acc.count()
    with NoBroadcast(spark):
        plan = spark.sql(f"SELECT count(*) FROM {name}_activity a JOIN {name}_account c USING (account_key, _salt)"
                         )._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_cases(spark, scratch):
    activity, account = "account_key long, keywords string", "account_key long, account_name string"
    rows = [(None, "a"), (None, None), (1, "a"), (1, "a"), (2, "")]
    names = [(1, "x"), (1, "x"), (None, "n"), (3, None)]
    got, lookup = bucketed.write_pair(spark.createDataFrame(rows, activity), spark.createDataFrame(names, account),
                                      f"{scratch}/a", _name(), buckets=2)
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got.drop("_salt").collect()), key=key) == sorted(rows, key=key)
    assert sorted(map(tuple, lookup.drop("_salt").collect()), key=key) == sorted(names, key=key)
    assert got.join(lookup, list(ON)).count() == 4
    empty = bucketed.write_pair(spark.createDataFrame([], activity), spark.createDataFrame([], account),
                                f"{scratch}/b", _name(), buckets=2)
    assert empty[0].join(empty[1], list(ON)).count() == 0
    with pytest.raises(ValueError):
        bucketed.write_pair(spark.createDataFrame([], activity + ", _salt int"), spark.createDataFrame([], account),
                            f"{scratch}/c", _name())
    with pytest.raises(ValueError):
        bucketed.write_pair(spark.createDataFrame([], "account_key int"), spark.createDataFrame([], account),
                            f"{scratch}/d", _name())
