import hashlib
import random
import re

import pytest

from leadscope.llm import op04_decontaminate as op

DOCS = "doc_id long, text string, item_id string"
ITEMS = "item_id long, text string"


def words(text):
    raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw)


def brute(docs, items, width, slack=0):
    out = []
    for doc_id, text, *_ in docs:
        w, hit, names = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            for s in range(max(1, len(iw) - width + 1)) if iw else []:
                win = iw[s:s + width]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        names |= {str(item_id)} if item_id is not None else set()
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), sha, bool(hit)))
    return sorted(out, key=str)


def cases(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "Été", "x1", "ñu", "b", "c-d", "e", "f", "g", "h", "rare"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.randint(1, 12))) for i in range(8)] + [(90, None), (91, "!!"), (None, say(6)), (92, "the the the the")]
    docs = [(i, say(rng.randint(0, 80)), "z") for i in range(30)]
    for i in range(0, 30, 3):
        docs[i] = (i, docs[i][1] + ". " + (rng.choice(items)[1] or "").upper(), None)
    docs += [(100, None, "a"), (101, "", "a"), (102, "...", None), (None, items[0][1], "a"), (103, items[1][1], "a"),
             (103, items[1][1], "a"), (104, "the " * 500, "a"), (105, "abc", "a"), (105, items[2][1], "b")]
    return docs, items


@pytest.mark.parametrize("width,seed", [(10, 1), (4, 2), (1, 3), (2, 4), (3, 5)])
def test_against_every_window(frame, width, seed):
    docs, items = cases(seed)
    got = op.decontaminate(frame(docs, DOCS), frame(items, ITEMS), width).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, width)


def test_proximity(frame):
    docs = [(1, "alpha beta gamma delta"), (2, "alpha x beta gamma delta"), (3, "alpha beta y z gamma delta"),
            (4, "delta gamma beta alpha"), (5, "beta gamma")]
    items = frame([(1, "alpha beta gamma delta")], ITEMS)
    docs = frame(docs, "doc_id long, text string")
    found = {}
    for slack in (0, 1, 2):
        _, matches, _ = op.find_matches(docs, items, 10, slack)
        found[slack] = {r["doc"] for r in matches.select("doc").distinct().collect()}
    assert found == {0: {1}, 1: {1, 2}, 2: {1, 2, 3}}


def test_shuffled_lookups_without_broadcast(frame, spark, monkeypatch):
    monkeypatch.setattr(op, "bounded_broadcast", lambda df: df)
    docs, items = cases(6)
    got = op.decontaminate(frame(docs, DOCS), frame(items, ITEMS), 5).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, 5)


def test_empty_tables_and_clean(frame, spark):
    docs, items = cases(7)
    none = spark.createDataFrame([], ITEMS)
    got = op.decontaminate(frame(docs, DOCS), none).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, [], 10)
    assert op.decontaminate(spark.createDataFrame([], DOCS), frame(items, ITEMS)).collect() == []
    kept = op.clean(frame(docs, DOCS), frame(items, ITEMS))
    hit = {d[0] for d in brute(docs, items, 10) if d[5]}
    assert kept.columns == ["doc_id", "text", "item_id"]
    left = sorted((tuple(r) for r in kept.collect()), key=str)
    assert left == sorted((d for d in docs if not brute([d], items, 10)[0][5]), key=str) and hit


def test_native(frame):
    docs, items = cases(8)
    plan = op.decontaminate(frame(docs, DOCS), frame(items, ITEMS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
