import hashlib

import numpy as np
import pytest

from leadscope.llm import op05_sharding as op

NAMES = [f"s{i}" for i in range(7)]


def plain_table(names, size):
    """Whole preference lists, then turns."""
    number = lambda t: int.from_bytes(hashlib.md5(t.encode()).digest()[:8], "big")
    prefers = [[(number("offset " + n) + i * (number("skip " + n) % (size - 1) + 1)) % size for i in range(size)] for n in names]
    owner, at = [None] * size, [0] * len(names)
    while None in owner:
        for k in range(len(names)):
            while at[k] < size and owner[prefers[k][at[k]]] is not None:
                at[k] += 1
            if at[k] < size:
                owner[prefers[k][at[k]]] = k
    return owner


def test_table_against_whole_preference_lists():
    for size in (7, 101, 1009):
        table = op.lookup_table(NAMES, size)
        assert table.tolist() == plain_table(NAMES, size)
        assert np.ptp(np.bincount(table, minlength=7)) <= 1


def test_weights_and_departures():
    table = op.lookup_table(NAMES, 10_007, {"s1": 3})
    share = np.bincount(table, minlength=7)
    assert share[1] > 2.9 * share[0] and share.sum() == 10_007
    before, after = op.lookup_table(NAMES, 10_007), op.lookup_table(NAMES[:-1], 10_007)
    stayed = before != 6
    assert (after[stayed] != before[stayed]).mean() < 0.25


def test_placement(frame, spark):
    rows = [(i, f"k{i % 50}", "old") for i in range(300)] + [(900, None, "x"), (901, "", None), (902, "é" * 5000, "y")]
    out = op.place(frame(rows, "doc_id long, key string, shard string"), "key", NAMES, 1009)
    owner = plain_table(NAMES, 1009)
    assert out.columns == ["doc_id", "key", "slot", "shard"]
    for r in out.collect():
        slot = 0 if r["key"] is None else int(hashlib.md5(r["key"].encode()).hexdigest()[:15], 16) % 1009
        assert (r["slot"], r["shard"]) == (slot, NAMES[owner[slot]])
    assert out.count() == 303
    assert op.place(spark.createDataFrame([], "key long"), "key", NAMES, 1009).collect() == []


def test_refused():
    for names, size in (([], 7), (["a", "a"], 7), (["a"], 8), (NAMES, 5)):
        with pytest.raises(ValueError):
            op.lookup_table(names, size)
