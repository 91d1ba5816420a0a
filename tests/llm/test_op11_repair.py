"""Repair against a plain program that carries whole audits, and small cases by hand."""

import hashlib
import heapq
import itertools
import random
import zlib

from pyspark.sql import functions as F

from leadscope.llm import op11_repair as op
from leadscope.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
WS = " \t\n\x0b\x0c\r"


def sha(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(WS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else
                   "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def follows(said, initial):
    return {"": "su", "s": "u", "u": "a", "a": "u"}[said].find(initial) >= 0 if initial else False


def cheapest(rows):
    """(cost, audit, lines) by a queue ordered by cost and audit, with whole strings."""
    marks = faults(rows)
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, last, lines = heapq.heappop(queue)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, list(lines)
        new = "a" if last == "u" else "u"
        full = {"u": "user", "a": "assistant"}[new]
        heapq.heappush(queue, (cost + 2, audit + "I", i, new, (*lines, f"{full}:")))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(queue, (cost + 3, audit + "D", i + 1, last, lines))
        if marks[i] in ("blank", "duplicate"):
            continue
        more = marks[i] == "truncated"
        heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, new, (*lines, f"{full}:{text}")))
        if follows(last, role[:1]):
            heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))


def summary(rows):
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    marks = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, lines = cheapest(rows)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("blank"), marks.count("duplicate"),
            marks.count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
            cost, audit, sha(lines))


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def invented(seed, n, most=12):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for k in range(rng.randint(1, most)):
            rows.append((conv, rng.choice([k, k, k, rng.randint(0, 9), None]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(["a.", "b?", "c!", "no end", " ", "", None, "é. ", "x.\x0b", "long " * 9 + "."])))
    return rows


def results(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_against_plain_program(spark, frame):
    rows = invented(3, 400)
    got = results(op.audits(frame(rows, SCHEMA)))
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn, role, text))
    assert got == {c: summary(r) for c, r in want.items()}
    assert any(v[6].count("I") and v[6].count("D") and v[6].count("R") for v in got.values())


def test_query_on_conversations(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = results(queries.conversation_repair(spark, sf))
    assert got == {c: summary(r) for c, r in damaged(rows).items()} and len(got) > 50


def test_damage_keeps_every_conversation(spark, frame):
    rows = [(c, t, "user", "a.") for c in [*range(300), None] for t in (0, None)] + [(5, None, None, None)] * 2
    got = results(op.audits(op.damage(frame(rows, SCHEMA)), "present"))
    want = damaged(rows)
    assert got == {c: summary(r) for c, r in want.items()}
    gone = [c for c, r in want.items() if not r]
    assert gone and all(got[c] == (0, 0, 0, 0, 0, 0, "", sha([])) for c in gone)


def test_repaired_rows_give_the_digest(spark, frame):
    rows = invented(8, 200)
    table = frame(rows, SCHEMA)
    reports = results(op.audits(table))
    lines = {}
    for r in sorted(op.repaired(table).collect(), key=lambda r: (r["conv_id"], r["place"])):
        lines.setdefault(r["conv_id"], []).append(r)
    for conv, report in reports.items():
        found = lines.get(conv, [])
        assert sha([f"{r['role']}:{r['text']}" for r in found]) == report[-1]
        assert [r["place"] for r in found] == list(range(len(found)))
        assert "".join(r["edit"][0] for r in found) == report[6].replace("D", "")
        initials = "".join(r["role"][0] for r in found)
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2)
    assert op.repaired(frame([], SCHEMA)).count() == 0


def run(rows, **tree):
    talk = op.Conversation(op.AuditTree(**tree), trim_at=64)
    for row in rows:
        talk.add(*row)
    return talk


def test_colliding_hashes_change_nothing():
    for seed in range(60):
        rng = random.Random(seed)
        rows = [(k, rng.choice(["user", "assistant", "system"]), f"{rng.randint(0, 30)}{rng.choice('.x')}") for k in range(40)]
        want = summary(rows)
        assert run(rows).result() == want
        assert run(rows, modulus=1).result() == want and run(rows, modulus=5).result() == want


def test_long_conversation_keeps_a_small_tree():
    rng = random.Random(1)
    rows = [(k, rng.choice(["user", "assistant"]), f"{k}.") for k in range(20_000)]
    talk = run(rows)
    assert len(talk.tree) < 2_000 and talk.result()[5:7] == cheapest(rows)[:2]


def test_ties_take_the_least_audit():
    # user, user: insert an assistant between and after (KIKI), or rerole the second (KR), or delete one and insert
    assert run([(0, "user", "a."), (1, "user", "b.")]).result()[5:7] == (2, "KR")
    assert run([(0, "user", "a.")]).result()[5:7] == (2, "KI")
    assert run([(0, "assistant", "a.")]).result()[5:7] == (2, "IK")
    assert run([(0, "system", "a.")]).result()[5:7] == (3, "D")
    assert run([]).result()[5:7] == (0, "")


def test_tree_order_is_string_order():
    rng = random.Random(4)
    for modulus in ((1 << 61) - 1, 3, 1):
        tree, texts = op.AuditTree(modulus=modulus), {0: ""}
        for _ in range(400):
            at = rng.choice(list(texts))
            letter = rng.choice("DIKR")
            if texts[at] + letter not in texts.values():       # audits of one text are one node
                texts[tree.add(at, letter)] = texts[at] + letter
        nodes = list(texts)
        for _ in range(2000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert tree.less(a, b) == (texts[a] < texts[b])
        some = rng.sample(nodes, 20)
        moved = tree.trim(some)
        assert [tree.text(n) for n in moved] == [texts[n] for n in some]


def test_empty_table_and_other_columns(spark, frame):
    assert op.audits(frame([], SCHEMA)).collect() == []
    assert op.audits(op.damage(frame([], SCHEMA)), "present").collect() == []
    rows = invented(5, 30)
    plain = results(op.audits(op.damage(frame(rows, SCHEMA)), "present"))
    extra = frame(rows, SCHEMA)
    for name in ("kind", "copy", "present", "row", "cost", "audit", "place"):
        extra = extra.withColumn(name, F.lit("x"))
    assert results(op.audits(op.damage(extra), "present")) == plain


def test_very_long_text_and_repeated_rows(spark, frame):
    rows = [(1, 0, "user", "wörd " * 400_000 + ".")] * 3 + [(1, 1, "assistant", "b.")]
    got = results(op.audits(frame(rows, SCHEMA)))
    assert got[1] == summary([r[1:] for r in rows]) and got[1][2] == 2
