"""Plan properties and the driver contract."""

import pytest

import __spark_entry__ as entry
from leadscope.plans import catalog
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_contract_keys():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(catalog.JOBS) <= set(q) and set(catalog.JOBS) <= set(o)      # every job has an oracle


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["heading_id", "directory_id", "queries_total", "queries_by_name", "queries_empty",
                          "queries_none"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.JOBS))
def test_no_python_in_plans(spark, name):
    plan = _plan(catalog.JOBS[name](spark, SF001))
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in plan, (name, marker)


def test_online_source_uses_existence_join(spark):
    plan = _plan(catalog.JOBS["online_leads"](spark, SF001))
    assert "ExistenceJoin" in plan
    # the typed day range reaches the Parquet scan of the activity
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan and "LessThan(ts,2024-01-21T00:00)" in plan


def test_dataset_read_prunes_partitions(spark):
    plan = _plan(catalog.JOBS["activity_day_range"](spark, SF001))
    assert "PartitionFilters: [isnotnull(activity_date" in plan


def test_time_range_reaches_the_scan(spark):
    plan = _plan(catalog.JOBS["non_name_share"](spark, SF001))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_column_pruning_on_flagship(spark):
    """Only the two event columns the profile needs are read (not ts, value, props...)."""
    plan = _plan(catalog.JOBS["heading_directory_profile"](spark, SF001))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan


def test_flagship_broadcast_shape_shuffles_only_counters(spark):
    """Accounts within the bound: broadcast join, the only shuffle carries (heading, directory) partials."""
    plan = _plan(catalog.JOBS["heading_directory_profile"](spark, SF001))
    assert "BroadcastHashJoin" in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "heading_id" in shuffles[0] and "directory_id" in shuffles[0]


def test_partial_aggregate_before_shuffle_join(spark):
    """Accounts beyond the bound: distinct (key, heading, directory, term) are counted before the join."""
    from leadscope.operators import profiles
    from leadscope.plans import fixtures as fx

    df = profiles.heading_directory_profile(fx.activity(spark, SF001), fx.account(spark, SF001), broadcast_rows=0)
    plan = _plan(df)
    assert plan.count("HashAggregate") >= 4   # partial + final before the join, partial + final after


@pytest.mark.parametrize("sf", [SF001])
def test_oracle_gate(spark, sf):
    from tests.oracle_harness import compare, duck

    con = duck(sf)
    bad = []
    for name in catalog.JOBS:
        r = compare(spark, name, sf, con)
        if not r["ok"]:
            bad.append(r)
    assert not bad, bad


@pytest.mark.parametrize("name", ["activity_ingest", "account_rejects", "monthly_totals"])
def test_lines_are_split_once(spark, name):
    """The reject filter stays above the parse: each line is split exactly once."""
    plan = _plan(catalog.JOBS[name](spark, SF001))
    assert plan.count("split(") == 1, plan


def test_oracle_gate_under_other_session_settings(spark):
    """Results must not depend on the session: AQE off, no automatic broadcast, few shuffle
    partitions, ANSI off and a time zone with daylight saving (sf0.01 has a wall-clock time
    in a DST gap)."""
    from tests.conftest import SF01
    from tests.oracle_harness import compare, duck

    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "3",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.session.timeZone": "America/Toronto",
            "spark.sql.ansi.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        con = duck(SF01)
        bad = [r for r in (compare(spark, n, SF01, con) for n in catalog.JOBS) if not r["ok"]]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert not bad, bad


def test_top10_is_a_top_k(spark):
    plan = _plan(catalog.JOBS["non_name_share_top10"](spark, SF001))
    assert "TakeOrderedAndProject" in plan


def test_shared_folder_required_on_a_cluster():
    from leadscope.session import is_local_master

    assert is_local_master("local[8]") and is_local_master("local")
    assert not is_local_master("spark://host:7077") and not is_local_master("yarn") and not is_local_master(None)


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _RemoteSession:
    """Stands in for a session without a SparkContext (as over Spark Connect)."""

    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


def test_checkpoint_folder_fallback_rules():
    from leadscope.session import ensure_checkpoint_dir

    shared = _RemoteSession({"spark.checkpoint.dir": "hdfs://nn/shared/ckpt", "spark.master": "yarn"})
    assert ensure_checkpoint_dir(shared) == "hdfs://nn/shared/ckpt"
    local = _RemoteSession({"spark.master": "local[2]"})
    first = ensure_checkpoint_dir(local)
    assert first == ensure_checkpoint_dir(local)          # one private folder per session
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_RemoteSession({"spark.master": "yarn"}))


def test_reconciliation_is_one_pass(spark):
    """Each large source is scanned once and the bridge once; far fewer exchanges than one count per side."""
    plan = _plan(catalog.JOBS["lead_reconciliation"](spark, SF001))
    assert plan.count("FileScan parquet") <= 6 and plan.count("Exchange hashpartitioning") <= 6, plan


def test_missing_days_reads_no_row(spark):
    plan = _plan(catalog.JOBS["missing_days"](spark, SF001))
    assert "FileScan" not in plan
