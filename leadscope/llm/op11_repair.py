"""Conversation structure repair by a dynamic program over persistent audits.

A conversation's rows, in order, are edited until their role initials read ``(s?(ua)+)?``: Keep costs 0,
Rerole to user or assistant 2, Delete 3 (required for blank and duplicate rows), Insert of an empty user or
assistant row 2, and a truncated row that is not deleted 1 more.  The audit is the string of the edits'
initials; of the cheapest edits the one with the ASCII-least audit is taken.

The program keeps the best edits for each of four states (nothing yet, after s, after u, after a).  Their
audits share prefixes: a node holds one letter, its ancestors 1, 2, 4, ... steps up and a rolling hash of
the letters from the root.  Equal costs are told apart by a search for the longest common prefix over those
hashes; the prefix found is then verified letter by letter up to the shared node, so a collision of hashes
changes nothing.  An audit that costs over ``_BRIDGE`` more than another can no longer win and goes, and
letters that all states share leave the tree.

Spark deals rows by conversation, sorts them and streams them: a task holds one row's text at a time,
beside one letter and one 16-byte row digest per row of the conversation at hand (an audit is one text cell
and a SHA-256 is sequential, so a conversation cannot be dealt over tasks).

Defined cases: NULL ids form one conversation, returned with a NULL id; NULL turns come first; rows with one
turn are ordered by role and text; NULL role and text read as one space; an empty table gives no rows; a
conversation without rows has zeros, an empty audit and nothing repaired.  Other columns of the input are
ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.llm.common import partitions, written

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: From each state any continuation of any other state costs at most this much more: one row inserted, and
#: a kept system row deleted instead.
_BRIDGE = INSERT + DELETE
_ORDER = ["conv_id", "turn", "role", "text"]        # Spark sorts NULLs first


class AuditTree:
    """Audits as nodes of one tree; node 0 is the empty audit."""

    def __init__(self, base: int = 1_000_003, modulus: int = (1 << 61) - 1) -> None:
        self.base, self.modulus = base, modulus
        self.settled: list[str] = []
        self._clear()

    def _clear(self) -> None:
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def __len__(self) -> int:
        return len(self.letter)

    def add(self, node: int, letter: str) -> int:
        """The audit of ``node`` with one more letter."""
        up, at = [node], node
        while len(up) <= len(self.up[at]):
            at = self.up[at][len(up) - 1]
            up.append(at)
        self.up.append(up)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.base + ord(letter)) % self.modulus)
        return len(self.letter) - 1

    def ancestor(self, node: int, depth: int) -> int:
        """The node's prefix of ``depth`` letters."""
        steps, k = self.depth[node] - depth, 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def _difference(self, a: int, b: int) -> tuple[int, int] | None:
        """The highest nodes with different letters on two paths of one length."""
        found = None
        while a != b:
            if self.letter[a] != self.letter[b]:
                found = a, b
            a, b = self.up[a][0], self.up[b][0]
        return found

    def less(self, a: int, b: int) -> bool:
        """Whether the audit of ``a`` is before that of ``b`` in ASCII order."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] == self.hash[y]:
            found = self._difference(x, y)
            if found is None:
                return self.depth[a] < self.depth[b]
        else:
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            found = self._difference(self.up[x][0], self.up[y][0]) or (x, y)
        return self.letter[found[0]] < self.letter[found[1]]

    def _path(self, node: int, top: int) -> list[int]:
        out = []
        while node != top:
            out.append(node)
            node = self.up[node][0]
        return out[::-1]

    def text(self, node: int) -> str:
        return "".join(self.settled) + "".join(self.letter[n] for n in self._path(node, 0))

    def trim(self, nodes: list[int]) -> list[int]:
        """Drops what no audit of ``nodes`` uses and settles what all of them share; the nodes' new numbers."""
        depth = min(self.depth[n] for n in nodes)
        level = {self.ancestor(n, depth) for n in nodes}
        while len(level) > 1:
            level = {self.up[n][0] for n in level}
        top = level.pop()
        self.settled.append("".join(self.letter[n] for n in self._path(top, 0)))
        live = sorted({n for node in nodes for n in self._path(node, top)})       # parents before children
        letters, parents = {n: self.letter[n] for n in live}, {n: self.up[n][0] for n in live}
        self._clear()
        number = {top: 0}
        for n in live:
            number[n] = self.add(number[parents[n]], letters[n])
        return [number[n] for n in nodes]


class Conversation:
    """Counts, cheapest edits and digest of one conversation, fed with its rows in order."""

    def __init__(self, tree: AuditTree | None = None, trim_at: int = 1 << 14) -> None:
        self.tree, self.trim_at = tree or AuditTree(), trim_at
        self.tips = {NONE: (0, 0, hashlib.sha256())}          # state -> cost, audit, digest of the repaired rows
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.initial = None

    def _best(self, offers: list[tuple]) -> tuple:
        best = offers[0]
        for offer in offers[1:]:
            if offer[0] < best[0] or offer[0] == best[0] and self.tree.less(offer[1], best[1]):
                best = offer
        return best

    @staticmethod
    def _with(state: int, digest, role: str, text: str):
        out = digest.copy()
        out.update(("\n" if state != NONE else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        return out

    def _insert(self) -> None:
        """Lets each state also be reached by inserting a row; two inserts reach after-a from nothing."""
        tips = self.tips
        for goal, sources, role in ((USER, (NONE, SYSTEM, ASSISTANT), "user"), (ASSISTANT, (USER,), "assistant")):
            offers = [(*tips[goal][:2], None)] if goal in tips else []
            most = offers[0][0] if offers else None
            for s in sources:
                if s in tips and (most is None or tips[s][0] + INSERT <= most):
                    offers.append((tips[s][0] + INSERT, self.tree.add(tips[s][1], "I"), s))
            if offers:
                cost, node, source = self._best(offers)
                if source is not None:
                    tips[goal] = cost, node, self._with(source, tips[source][2], role, "")

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        bare = text.rstrip(SPACE)
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        gone = more = 0
        if not bare:
            self.blank, gone = self.blank + 1, 1
        elif key in self.seen:
            self.duplicate, gone = self.duplicate + 1, 1
        elif bare[-1] not in ".!?":
            self.truncated, more = self.truncated + 1, TRUNCATED
        self.seen.add(key)

        self._insert()
        offers: dict[int, list] = {}
        for state, (cost, node, _) in self.tips.items():
            offers.setdefault(state, []).append((cost + DELETE, self.tree.add(node, "D"), state, None))
            if gone:
                continue
            goal, said = (ASSISTANT, "assistant") if state == USER else (USER, "user")
            if initial == said[0]:
                offers.setdefault(goal, []).append((cost + KEEP + more, self.tree.add(node, "K"), state, role))
            else:
                offers.setdefault(goal, []).append((cost + REROLE + more, self.tree.add(node, "R"), state, said))
                if initial == "s" and state == NONE:
                    offers.setdefault(SYSTEM, []).append((cost + KEEP + more, self.tree.add(node, "K"), state, role))
        chosen = {goal: self._best(found) for goal, found in offers.items()}
        least = min(c[0] for c in chosen.values())
        self.tips = {goal: (cost, node, self.tips[source][2] if said is None
                            else self._with(source, self.tips[source][2], said, text))
                     for goal, (cost, node, source, said) in chosen.items() if cost <= least + _BRIDGE}
        if len(self.tree) > self.trim_at:
            nodes = self.tree.trim([t[1] for t in self.tips.values()])
            self.trim_at = max(self.trim_at, 2 * len(self.tree))
            self.tips = {s: (t[0], n, t[2]) for (s, t), n in zip(self.tips.items(), nodes)}

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        self._insert()
        cost, node, digest = self._best([self.tips[s] for s in (NONE, ASSISTANT) if s in self.tips])
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, self.tree.text(node),
                digest.hexdigest())


def damage(rows: DataFrame, kinds: int = 20) -> DataFrame:
    """The rows with faults planted by crc32 of ``conv_id:turn`` modulo ``kinds``: 0 drops a row, 1 empties its
    text, 2 takes out ``.!?``, 3 repeats it, 4 makes it the user's.  A dropped row stays as a row with a false
    ``present``, which names its conversation and nothing else.  NULLs read as one space."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.encode(F.concat(name("conv_id"), F.lit(":"), name("turn")), "UTF-8")), F.lit(kinds))
    drawn = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), name("role").alias("role"),
                        name("text").alias("text"), kind.alias("kind"))
    gone = F.col("kind") == 0
    text = (F.when(gone, F.lit(None)).when(F.col("kind") == 1, F.lit(""))
            .when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    role = F.when(gone, F.lit(None)).when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1))
    return (drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), (~gone).alias("present"),
                         F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy"))


def _rows(rows: DataFrame, present: str | None) -> DataFrame:
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role"), said("text"),
                       (F.col(present) if present else F.lit(True)).alias("present"))


def _stream(batches: Iterator[pa.RecordBatch], size: int = 1024) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, size).columns))


def audits(rows: DataFrame, present: str | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): its faults, the cost and audit of its
    repair and the SHA-256 of the repaired ``role:text`` lines.  Rows whose ``present`` column is false only
    name their conversation."""
    fields = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out))
            arrays = ([pa.array(columns[0], kind)] + [pa.array(c, pa.int64()) for c in columns[1:7]]
                      + [pa.array(c, pa.string()) for c in columns[7:]])
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *fields, "audit", "repaired_sha256"])

        kind, current, talk = None, None, None
        for batch in batches:
            kind = batch.column(0).type
            for conv, turn, role, text, here in _stream(iter([batch])):
                if talk is None or conv != current:
                    if talk is not None:
                        out.append((current, *talk.result()))
                    if len(out) >= 4096:
                        yield packed()
                        out.clear()
                    current, talk = conv, Conversation()
                if here:
                    talk.add(turn, role, text)
        if talk is not None:
            out.append((current, *talk.result()))
            yield packed()

    schema = ", ".join([f"conv_id {rows.schema['conv_id'].dataType.simpleString()}", *(f"{f} long" for f in fields),
                        "audit string", "repaired_sha256 string"])
    dealt = _rows(rows, present).repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions(*_ORDER)
    return dealt.mapInArrow(run, schema)


def repaired(rows: DataFrame, present: str | None = None) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (Keep, Rerole or Insert), turn (NULL where
    inserted), role, text.  Each conversation's audit goes ahead of its rows through one more sort."""
    plain = written(_rows(rows, present), "repair-rows")
    head = written(audits(plain, "present").select("conv_id", "audit"), "repair-audits")
    none = F.lit(None)
    both = (plain.withColumn("row", F.lit(1)).unionByName(head.select(
        "conv_id", none.cast("long").alias("turn"), F.col("audit").alias("role"), none.cast("string").alias("text"),
        F.lit(True).alias("present"), F.lit(0).alias("row"))))
    dealt = both.repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "row", *_ORDER[1:]).select("conv_id", "turn", "role", "text", "present", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kind = None

        def packed() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              names=["conv_id", "place", "edit", "turn", "role", "text"])

        edits, current, last, place = iter(""), None, "", 0

        def emit(edit: str, turn: int | None, role: str | None, text: str) -> None:
            nonlocal last, place
            role = role if role is not None else "assistant" if last == "u" else "user"
            out.append((current, place, edit, turn, role, text))
            last, place = role[:1], place + 1

        def next_edit() -> str:
            for letter in edits:
                if letter != "I":
                    return letter
                emit("Insert", None, None, "")
            return ""

        for batch in batches:
            kind = batch.column(0).type
            for conv, turn, role, text, here, row in _stream(iter([batch])):
                if row == 0:
                    next_edit()                                    # what the last conversation still inserts
                    edits, current, last, place = iter(role), conv, "", 0
                elif here:
                    letter = next_edit()
                    if letter in ("K", "R"):
                        emit({"K": "Keep", "R": "Rerole"}[letter], turn, role if letter == "K" else None, text)
                if len(out) >= 1024:
                    yield packed()
                    out.clear()
        next_edit()
        if out:
            yield packed()

    kind = rows.schema["conv_id"].dataType.simpleString()
    return dealt.mapInArrow(run, f"conv_id {kind}, place long, edit string, turn long, role string, text string")
