import numpy as np
import pytest
import xxhash

from leadscope.llm import op08_simhash as op

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text, width=3):
    words = ("" if text is None else text).encode().lower().split()
    if not words:
        return 0
    shingles = [words[i:i + width] for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, width, bits):
    fps = [brute_fingerprint(t, width) for _, t in rows]
    comp = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= bits:
                    comp[i] = comp[j] = min(comp[i], comp[j])
    smallest = {c: min(rows[i][0] for i in range(len(rows)) if comp[i] == c) for c in set(comp)}
    return sorted((rows[i][0], f"{fps[i]:016x}", smallest[comp[i]]) for i in range(len(rows)))


def result(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()))


@pytest.mark.parametrize("bits", [0, 1, 2, 4])
def test_against_all_pairs(frame, prose, bits):
    texts = prose(5, docs=30, words=200)
    texts += [texts[4] + " end", None, "", " \n\t", "one", "One", "one two", "É é A", texts[2]]
    rows = [(i + 100, t) for i, t in enumerate(texts)]
    assert result(op.near_duplicates(frame(rows, SCHEMA), 3, bits)) == brute(rows, 3, bits)


def test_links_lose_nothing(spark):
    """Random fingerprints around a few centres: the components equal those of all pairs."""
    rng = np.random.default_rng(1)
    values = set()
    for centre in rng.integers(0, 1 << 63, 20, dtype=np.uint64).tolist():
        for _ in range(40):
            x = centre
            for bit in rng.integers(0, 64, rng.integers(0, 5)):
                x ^= 1 << int(bit)
            values.add(x)
    values = np.array(sorted(values), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    got = {(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in op.links(df, 2).collect()}
    up = {int(v): int(v) for v in values}

    def top(x, up):
        while up[x] != x:
            x = up[x]
        return x

    def parts(pairs):
        up = {int(v): int(v) for v in values}
        for a, b in pairs:
            x, y = top(a, up), top(b, up)
            up[max(x, y)] = min(x, y)
        return [top(int(v), up) for v in values]

    pairs = [(int(values[i]), int(values[j])) for i in range(len(values))
             for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1:]) <= 2) + i + 1]
    assert all((a ^ b).bit_count() <= 2 for a, b in got)
    assert parts(got) == parts(pairs)


def test_large_runs_match_short_runs():
    rng = np.random.default_rng(2)
    ring = op.Ring(2)
    base = 0x0123456789ABCDEF
    fp = np.unique(np.array([base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(22, 64, (300, 2))], np.uint64))
    zero = np.zeros(len(fp), np.int64)

    def parts(a, b):
        up = {int(v): int(v) for v in fp}
        def top(x):
            while up[x] != x:
                x = up[x]
            return x
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = top(x), top(y)
            up[max(x, y)] = min(x, y)
        return [top(int(v)) for v in fp]
    mask = np.uint64(ring.chain(0)[ring.exact - 1])
    assert len(set((fp & mask).tolist())) == 1
    small = op.link_block(zero, zero, fp, ring)
    large = op.link_block(zero, zero, fp, ring, large=10)
    assert parts(*small) == parts(*large)


def test_long_text_in_blocks():
    text = " ".join(f"w{i % 97}" for i in range(5000))
    assert op.fingerprint(text, 3, block=100) == op.fingerprint(text) == brute_fingerprint(text)


def test_cases(spark, frame):
    assert result(op.near_duplicates(spark.createDataFrame([], SCHEMA))) == []
    rows = frame([(None, "a b c"), (7, "a b c"), (7, "a b c"), (None, "alone here now then")], SCHEMA)
    got = sorted(((r["doc_id"], r["component_id"]) for r in op.near_duplicates(rows).collect()), key=str)
    assert got == [(7, 7), (7, 7), (None, 7), (None, None)]


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_hot_keys_against_all_pairs(frame, prose, bits):
    """With every key of over three fingerprints hot, the components stay those of all pairs."""
    texts = prose(6, docs=12, words=150)
    texts += [t + " " + " ".join(["and", "so", "on"][:n]) for t in texts[:6] for n in (1, 2, 3)] + [None, "", "one two"]
    rows = [(i, t) for i, t in enumerate(texts)]
    assert result(op.near_duplicates(frame(rows, SCHEMA), 3, bits, hot_rows=3)) == brute(rows, 3, bits)


def test_a_hot_group_is_spread(spark):
    """A third of all fingerprints around one value: one component, and no centre has a large group."""
    rng = np.random.default_rng(3)
    centre, values = 0x0F1E2D3C4B5A6978, set()
    while len(values) < 1500:
        values.add(centre ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    others = [int(v) for v in rng.integers(0, 1 << 63, 3000)]
    signed = [v - (1 << 64) if v >> 63 else v for v in [*values, *others]]
    df = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4)
    pairs = op.links(df, 2, hot_rows=200)
    assert pairs.where("bit_count(a ^ b) > 2").count() == 0
    roots = op.connected_components(pairs).collect()
    group = {r["root"] for r in roots if (r["node"] & (1 << 64) - 1) in values}
    assert len(group) == 1 and sum((r["node"] & (1 << 64) - 1) in values for r in roots) == len(values)
    stars = op.centre_links(df, 2).groupBy("a", "b").count().groupBy("a").count()
    assert stars.agg({"count": "max"}).first()[0] <= 64 * 63 // 2 + 64
