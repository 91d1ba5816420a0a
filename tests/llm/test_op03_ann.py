import numpy as np

from leadscope.llm import op03_ann as op
from leadscope.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, score string"
ASKED = "vec_id % 10 = 0"


def brute(rows, k):
    """Exact neighbours of every usable query in double precision."""
    fine = {}
    sizes = [len(v) for _, v, *_ in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    dims = max(sorted(set(sizes)), key=sizes.count) if sizes else 0
    for i, v, *_ in rows:
        if i is not None and v is not None and len(v) == dims and None not in v and np.isfinite(v).all() and any(v):
            fine[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in fine:
        if q % 10 == 0:
            near = sorted((float(np.sqrt(((fine[i] - fine[q]) ** 2).sum())), i) for i in fine if i != q)
            out[q] = near[:k]
    return out


def by_query(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def clusters(seed, n=600, dims=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    return [(i, (centres[i % 8] + 0.3 * rng.normal(size=dims)).astype(np.float32).tolist(), None) for i in range(n)]


def test_recall_and_exact_scores(frame):
    rows = clusters(1)
    got, want = by_query(op.neighbours(frame(rows, SCHEMA), ASKED)), brute(rows, 10)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    vectors = {i: np.array(v) for i, v, _ in rows}
    for q, near in got.items():
        assert near == sorted(near)
        for score, i in near:
            assert i != q and abs(score - np.linalg.norm(vectors[i] - vectors[q])) < 1e-12


def test_all_lists_without_early_stops_is_exact(frame):
    rows = clusters(2, n=300)
    got = by_query(op.neighbours(frame(rows, SCHEMA), ASKED, target=1.0, eps=1e9, chunk=7, batch=3))
    want = brute(rows, 10)
    lists = {q: [i for _, i in v] for q, v in got.items()}
    close = sum(lists[q] == [i for _, i in want[q]] for q in want)
    assert close >= 0.9 * len(want)


def test_scan_rejects_only_worse(frame):
    rng = np.random.default_rng(3)
    points, queries = rng.normal(size=(500, 32)), rng.normal(size=(20, 32))
    row, col, score = op.scan(queries, np.full(20, -1), points, np.arange(500), 10, 2.1, 8, op.rotation(32))
    full = np.sqrt(((queries[:, None] - points[None]) ** 2).sum(-1))
    want = np.argsort(full, axis=1)[:, :10]
    hits = sum(len(set(col[row == q].tolist()) & set(want[q].tolist())) for q in range(20))
    assert hits >= 190 and np.allclose(score, full[row, col])


def test_copies_and_ties(frame):
    """A third of all rows in one point: ties go to the smaller ids, over all chunks of the list."""
    rows = clusters(4, n=200) + [(i, [1.0] * 12, None) for i in range(200, 300)]
    got = by_query(op.neighbours(frame(rows, SCHEMA), ASKED, chunk=9, batch=4))
    for q in range(200, 300, 10):
        assert got[q] == [(0.0, i) for i in range(200, 212) if i != q][:10]


def test_cases(spark, frame):
    assert op.neighbours(spark.createDataFrame([], SCHEMA), ASKED).collect() == []
    rows = [(0, [1.0, 0.0], "a"), (10, [0.0, 1.0], None), (3, [1.0, 1.0], None), (3, [1.0, 1.0], None), (20, None, None),
            (30, [0.0, 0.0], None), (40, [float("nan"), 1.0], None), (50, [None, 1.0], None), (60, [1.0], None),
            (None, [1.0, 0.5], None), (7, [float("inf"), 1.0], None), (0, [1.0, 0.0], "a")]
    got = by_query(op.neighbours(frame(rows, SCHEMA), ASKED))
    want = brute(rows, 10)
    assert got.keys() == {0, 10} == want.keys()
    for q in want:
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]]) and [i for _, i in got[q]] == [i for _, i in want[q]]


def test_recall_on_the_table(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    got = by_query(op.neighbours(vectors, ASKED))
    want = brute(rows, 10)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def hot(seed, copies, others, dims=48, noise=0.0):
    """``copies`` rows of one long vector (with ``noise``), then ``others`` near it."""
    rng = np.random.default_rng(seed)
    centre = 3 * rng.normal(size=dims)
    points = np.concatenate([centre + noise * rng.normal(size=(copies, dims)), centre + 0.2 * rng.normal(size=(others, dims))])
    return points.astype(np.float32).astype(float)


def test_scan_keeps_copies_over_many_blocks():
    """More copies than k among the first points, and one more copy behind: rounding rejects none."""
    turn = op.rotation(48)
    for seed in range(20):
        for noise in (0.0, 1e-7):
            points = hot(seed, 60, 300, noise=noise)
            ids, asked = np.arange(360), np.arange(0, 60, 7)
            for eps in (2.1, float("inf")):
                row, col, score = op.scan(points[asked], asked, points, ids, 10, eps, 16, turn)
                assert np.bincount(row, minlength=len(asked)).tolist() == [10] * len(asked)
                for i, q in enumerate(asked):
                    away = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
                    want = [j for j in np.lexsort((ids, away)) if j != q][:10]
                    if noise == 0.0 or eps == float("inf"):
                        assert col[row == i].tolist() == want
                    assert col[row == i].max() < 60


def test_scan_counts_a_repeated_id_once():
    points = np.concatenate([np.ones((30, 32)), hot(1, 0, 40, dims=32)])
    ids = np.concatenate([np.full(30, 5), np.arange(100, 140)])
    row, col, score = op.scan(np.ones((1, 32)), np.array([-1]), points, ids, 10, float("inf"), 8, op.rotation(32))
    away = np.sqrt(((points - 1) ** 2).sum(axis=1))
    assert ids[col].tolist() == [5, *ids[30:][np.argsort(away[30:], kind="stable")][:9].tolist()]


def test_hot_copies_of_several_blocks(frame):
    """A third of the rows in one point of 48 dimensions, other vectors in the same and in other lists."""
    rng = np.random.default_rng(6)
    points = np.concatenate([hot(6, 150, 100), 3 * rng.normal(size=(200, 48))]).astype(np.float32)
    rows = [(i, v.tolist(), None) for i, v in enumerate(points)]
    got = by_query(op.neighbours(frame(rows, SCHEMA), ASKED))
    for q in range(0, 150, 10):
        assert got[q] == [(0.0, i) for i in range(12) if i != q][:10]
