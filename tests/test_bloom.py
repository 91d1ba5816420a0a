"""The Bloom filter in front of joins with long child lists."""

from pyspark.sql import functions as F

from leadscope.operators import bloom, leads
from leadscope.plans import fixtures as fx
from tests.conftest import SF01
from tests.test_scale import NoBroadcast


def test_keeps_every_key_and_few_others(spark):
    for kind in ("long", "string"):
        keys = spark.range(0, 40_000, 2).select(F.col("id").cast(kind).alias("child"))
        rows = spark.range(200_000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 3).alias("x"))
        got = bloom.possible(rows, "k", keys, "child", 20_000)
        assert got.columns == ["k", "x"]
        assert got.where("k < 40000 and k % 2 = 0").count() == 20_000
        assert got.count() - 20_000 < 0.01 * 180_000


def test_measured_and_expected_pass_rates_agree(spark):
    keys = spark.range(8_000).select(F.col("id").alias("child"))
    rows = spark.range(1_000_000, 1_200_000).select(F.col("id").alias("k"))
    for per_block in (64, 160):
        blocks = 8_000 // per_block
        expected = bloom.pass_rate(8_000, blocks)
        words = bloom.key_filter(keys, "child", blocks)
        met = bloom._block(rows["k"], blocks) == words["_block"]
        for i in range(bloom.WORDS):
            met = met & (F.getbit(words[f"_w{i}"], bloom._bit(rows["k"], i)) == 1)
        share = rows.join(words, met, "left_semi").count() / 200_000
        assert abs(share - expected) < 0.25 * expected + 0.002


def test_cases(spark):
    rows = spark.createDataFrame([(None, 1), (1, 2), (1, 2), (2, 3)], "k long, _block int")
    keys = spark.createDataFrame([(1,), (None,), (1,)], "child long")
    assert sorted(map(tuple, bloom.possible(rows, "k", keys, "child", 3).where("k = 1").collect())) == [(1, 2), (1, 2)]
    assert bloom.possible(rows, "k", keys, "child", 3).where("k is null").isEmpty()
    assert bloom.possible(rows, "k", keys.limit(0), "child", 0).isEmpty()
    huge = 64 * bloom.MOST_BLOCKS * 10                                    # nearly every key would pass
    assert bloom.possible(rows, "k", keys, "child", huge) is rows


def test_child_joins_beyond_the_bound(spark):
    """The same rows, with the other rows taken out in front of the shuffle."""
    bridge, one = fx.account_bridge(spark, SF01), ["P7"]
    jobs = {
        "online": lambda n: leads.online_leads(fx.activity(spark, SF01), fx.click_type(spark), bridge, "2024-01-05",
                                               "2024-01-20", one, broadcast_rows=n),
        "phone": lambda n: leads.phone_leads(fx.phone_lead(spark, SF01), bridge, "1996-01-01", "1996-12-31", one, n),
        "report": lambda n: leads.online_report(fx.online_report(spark, SF01), bridge, "2024-01-05", "2024-01-20", one, n),
        "calls": lambda n: leads.phone_report(fx.phone_report(spark, SF01), bridge, "1996-01-01", "1996-12-31", one, n),
    }
    for name, job in jobs.items():
        want = sorted(map(str, job(1_000_000).collect()))
        with NoBroadcast(spark):
            df = job(0)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(str, df.collect())) == want and want, name
        join = plan[plan.index("SortMergeJoin"):]
        shuffle, tested = join.index("Exchange hashpartitioning"), join.index("LeftSemi")
        assert shuffle < tested and "_block" in join and "getbit" in join, name     # the test lies below the shuffle


def test_fewer_rows_are_shuffled(spark):
    source = leads.phone_source(fx.phone_lead(spark, SF01), "1996-01-01", "1996-12-31")
    keys = leads.child_keys(fx.account_bridge(spark, SF01), ["P7"])
    n = keys.count()
    left = bloom.possible(source, "account_key", keys, "child_key", n).count()
    joined = source.join(keys.select("child_key").distinct(), source["account_key"] == keys["child_key"], "left_semi").count()
    assert joined <= left <= joined + 0.02 * source.count() + 5 and left < source.count() / 2
