import random
import re

import pytest

from leadscope.llm import op07_license as op

DOCS = "doc_id long, text string, license_id string"
TEMPLATES = "license_id string, text string"


def words(text):
    raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw)


def shingles(w):
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs, templates, least=0.8):
    """Exact containment of every template in every window of its length."""
    out = set()
    for doc_id, text in {(d[0], d[1]) for d in docs}:
        w = words(text)
        for name, template in templates:
            if name is None or template is None or len(w) < 5:
                continue
            t = words(template)
            step, want, hits = max(1, len(t) // 4), shingles(t), []
            for j in range((len(w) - 5) // step + 1):
                held = len(want & shingles(w[j * step:j * step + len(t) + step])) / len(want)
                if held >= least:
                    hits.append((held, j * step))
            if hits:
                out.add((doc_id, name, max(h for h, _ in hits), min(p for _, p in hits), len(hits)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["the", "License", "under", "été"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    docs = []
    for i in range(40):
        text = say(rng.randint(0, 150))
        for _ in range(rng.randint(0, 2)):
            t = words(rng.choice(op.TEMPLATES)[1])
            for _ in range(rng.randint(0, 3)):                     # edits
                t[rng.randrange(len(t))] = rng.choice(vocab)
            text += ".\n" + " ".join(t).title() + "; " + say(rng.randint(0, 40))
        docs.append((i, text, "x"))
    return docs + [(100, None, None), (101, "", None), (102, "one two", None), (103, op.TEMPLATES[0][1], "a"),
                   (103, op.TEMPLATES[0][1], "b"), (None, op.TEMPLATES[4][1], "c"), (104, op.TEMPLATES[1][1] * 1500, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_exact_containment(frame, seed):
    docs = corpus(seed)
    templates = op.TEMPLATES + [(None, "a b c d e f"), ("nothing", None), ("twin", op.TEMPLATES[0][1])]
    got = op.scan(frame(docs, DOCS), frame(templates, TEMPLATES))
    assert got.columns == ["doc_id", "license_id", "containment", "first_word", "n_windows"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, templates)


def test_bands_reach_the_promise():
    for length in (5, 8, 20, 100):
        for rows in (1, 2, 3):
            n = op.band_count(length, length - 4, rows, 0.8, 0.9999)
            window = length + op.stride_of(length) - 4
            held = -(-8 * (length - 4) // 10)
            jaccard = held / (window + length - 4 - held)
            assert 1 - (1 - jaccard ** rows) ** n >= 0.9999


def test_cases(spark, frame):
    templates = op.default_templates(spark)
    assert op.scan(spark.createDataFrame([], DOCS), templates).collect() == []
    assert op.scan(frame(corpus(3), DOCS), spark.createDataFrame([], TEMPLATES)).collect() == []
    with pytest.raises(ValueError):
        op.scan(frame(corpus(3), DOCS), frame([("short", "only four words here")], TEMPLATES))


def test_each_notice_is_told_from_its_relatives(spark, frame):
    """Every built-in template is found in its own text and only where its words are."""
    said = [(i, f"Some words before it. {text} And so it goes on.", None) for i, (_, text) in enumerate(op.TEMPLATES)]
    found = {}
    for r in op.scan(frame(said, DOCS), op.default_templates(spark)).collect():
        found.setdefault(op.TEMPLATES[r["doc_id"]][0], set()).add(r["license_id"])
    assert all(name in found[name] for name, _ in op.TEMPLATES)
    assert found["spdx-gpl-2.0-only"] == {"spdx-gpl-2.0-only"} and found["mpl-2.0"] == {"mpl-2.0"}
    assert found["cc-by-4.0"] == {"cc-by-4.0"} and found["cc-by-nc-sa-4.0"] == {"cc-by-nc-sa-4.0"}
    assert found["lgpl"] == {"lgpl"} and "gpl-3.0-version" not in found["gpl-2.0-version"] | found["lgpl-2.1-version"]
    lines = ["/* SPDX-License-Identifier: LGPL-2.1-or-later */", "Distributed under the MIT License.", "(CC BY-SA 4.0)"]
    got = {(r["doc_id"], r["license_id"]) for r in op.scan(frame([(i, t, None) for i, t in enumerate(lines)], DOCS),
                                                           op.default_templates(spark)).collect()}
    assert got == {(0, "spdx-lgpl-2.1-or-later"), (1, "mit-line-distributed"), (2, "cc-by-sa-4.0-line")}


def test_native(frame, spark):
    plan = op.scan(frame(corpus(4), DOCS), op.default_templates(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
