"""Exact totals over the whole range of DOUBLE, against whole-number arithmetic."""

import random
from fractions import Fraction
from math import floor

from pyspark.sql import functions as F

from leadscope.operators import totals
from tests.conftest import as_parquet

EXT = "account_key bigint, directory_id bigint, impressions string, clicks string"
ACC = "account_key bigint, account_id string"
TOP = (1 << 63) - 1


def exact(texts):
    """Numbers below 2**24 with at most six decimals by their decimal text, the exact doubles of all others."""
    total = Fraction(0)
    for t in texts:
        try:
            x = float(t)
        except ValueError:
            continue
        if x == x and abs(x) != float("inf"):
            ordinary = abs(x) < 2 ** 24 and round(x * 1e6) / 1e6 == x
            total += Fraction(round(x * 1e6), 10 ** 6) if ordinary else Fraction(x)
    return max(-TOP - 1, min(TOP, floor(total + Fraction(1, 2))))


def totals_of(spark, rows, scratch, copies=1):
    ext = as_parquet(spark, rows, EXT, scratch)
    keys = sorted({r[0] for r in rows})
    acc = as_parquet(spark, [(k, f"A{k}") for k in keys for _ in range(copies)], ACC, scratch)
    found = []
    for part in (ext, ext.repartition(7), ext.orderBy("impressions"), ext.orderBy(F.desc("clicks"))):
        found.append({(r.account_key, r.directory_id): (r.impressions, r.clicks)
                      for r in totals.monthly_totals(part, acc).collect()})
    assert all(f == found[0] for f in found)
    return found[0]


def wanted(rows, copies=1):
    groups = {}
    for k, d, i, c in rows:
        groups.setdefault((k, d), ([], []))
        groups[k, d][0].extend([i] * copies)
        groups[k, d][1].extend([c] * copies)
    return {g: (exact(i), exact(c)) for g, (i, c) in groups.items()}


def test_cancelling_amounts_in_any_order(spark, scratch):
    rows = [(1, 1, x, y) for x, y in [("1e60", "1e308"), ("1e24", "1e308"), ("-1e60", "-1e308")]]       # 1e24, 1e308 left
    rows += [(2, 1, x, y) for x, y in [("1e60", "1.7e308"), ("-1e60", "-1.7e308"), ("7.5", "-0.25")]]
    rows += [(3, 1, x, y) for x, y in [("-1e60", "1e24"), ("1e60", "-1e24"), ("-1e24", "1000000000000000000")]]
    rows += [(4, 1, x, y) for x, y in [("1e24", "-1e24"), ("-999999999999999999999999", "1e23"), ("0.5", "9e23")]]
    rows += [(5, 1, x, y) for x, y in [("1e25", "-1.6e36"), ("-1e25", "1.6e36"), ("1e36", "-2"), ("-1e36", "0.5")]]
    got = totals_of(spark, rows, scratch)
    assert got == wanted(rows)
    assert got[1, 1] == (TOP, TOP) and got[2, 1] == (8, 0) and got[3, 1] == (-TOP - 1, 10 ** 18) and got[5, 1] == (0, -1)


def test_against_fractions(spark, scratch):
    rng, rows = random.Random(5), []
    for group in range(40):
        held = []
        for _ in range(rng.randint(1, 8)):
            size = rng.choice([rng.uniform(-300, 308), rng.uniform(-5, 9), rng.uniform(20, 40), 24, 24.0001])
            text = rng.choice([repr(rng.uniform(1, 9) * 10 ** min(size, 307)), str(rng.randint(-10 ** 6, 10 ** 6) / 100), "n/a",
                               str(rng.randint(0, 1 << 62)), repr(2.0 ** rng.randint(70, 1023)), "NaN", "-Infinity"])
            held.append(text)
        held += ["-" + t for t in rng.sample(held, rng.randint(0, len(held))) if not t.startswith("-")]
        rng.shuffle(held)
        rows += [(group % 9, group, t, rng.choice(held)) for t in held]
    assert totals_of(spark, rows, scratch) == wanted(rows)
    assert totals_of(spark, rows, scratch, copies=3) == wanted(rows, 3)


def test_many_huge_amounts_carry(spark, scratch):
    rows = [(1, 1, repr(2.0 ** 1023), repr(2.0 ** 80 + 2.0 ** 28)) for _ in range(300)]
    rows += [(1, 1, "-" + repr(2.0 ** 1023), "-" + repr(2.0 ** 80)) for _ in range(300)]
    got = totals_of(spark, rows, scratch)
    assert got == wanted(rows) and got[1, 1][0] == 0 < got[1, 1][1] < TOP


def test_ordinary_rows_stay_one_row(spark, scratch):
    from leadscope.functions.numeric import with_entries
    rows = [(k, k / 100, -k * 1.5) for k in range(1000)]
    table = as_parquet(spark, rows, "k bigint, x double, y double", scratch)
    assert with_entries(table, "x", "y").count() == 1000
    assert with_entries(table.withColumn("y", F.lit(1e60)), "x", "y").where("slot > 0").count() > 2000
