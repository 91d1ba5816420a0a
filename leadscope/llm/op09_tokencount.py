"""Token counts of a byte-level byte-pair vocabulary by compiled transducers.

Two deterministic transducers, both annotated with what a transition emits:

* the splitter reads one symbol per character (its class, plus whether white space or a contraction
  follows) and emits the starts of words.  It has eight states, so the text of a batch is cut into equal
  chunks, each chunk's map from every start state to its end state is computed, and the maps are composed
  by a parallel prefix scan: then every chunk knows its start state and emits on its own;
* the counter reads the bytes of a word and emits token counts.  After a prefix, its state holds the
  vocabulary prefixes still open at the end, each with the token before it and the count there; a
  transition closes the one token that may follow its predecessor (``MergeRules``) and emits by how much
  the count of the prefix grows.  States are compiled when first reached and shared by all words of a
  worker; all words of a batch advance together.  A long word is cut into chunks, whose maps from start
  states to end states and counts are composed by the same prefix scan.

Defined cases: NULL and empty texts have 0 bytes and 0 tokens; a special string inside a text is one
token and splits the text around it, as the library does by default; repeated rows stay rows.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.llm.merges import MergeRules

# symbols of the splitter
END, LETTER, NUMBER, OTHER, QUOTE_1, QUOTE_2, SPACE_LAST, SPACE_MORE, WHITE_LAST, SPECIAL, SKIP = range(11)
# states of the splitter
(FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_WHITE, PREFIXED, ONE_LEFT, TWO_LEFT) = range(8)
STATES, SYMBOLS = 8, 11


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a word) by state and symbol.

    A word is a contraction, or an optional space with a run of letters, of numbers or of other
    characters, or white space: a run gives up its last character when something follows, and that
    character is the space of the next word or a word of its own.
    """
    to, emit = np.zeros((STATES, SYMBOLS), np.uint8), np.ones((STATES, SYMBOLS), np.uint8)
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER, QUOTE_1: ONE_LEFT, QUOTE_2: TWO_LEFT,
           SPACE_LAST: PREFIXED, SPACE_MORE: IN_WHITE, WHITE_LAST: FRESH, SPECIAL: FRESH, SKIP: FRESH, END: FRESH}
    for symbol, state in run.items():
        to[:, symbol] = state
    emit[:, END] = emit[:, SKIP] = 0
    for state, symbols in ((IN_LETTERS, [LETTER]), (IN_NUMBERS, [NUMBER]), (IN_OTHER, [OTHER, QUOTE_1, QUOTE_2]),
                           (PREFIXED, [LETTER, NUMBER, OTHER, QUOTE_1, QUOTE_2]), (IN_WHITE, [SPACE_MORE])):
        emit[state, symbols] = 0
    for state in (IN_OTHER, PREFIXED):
        to[state, [QUOTE_1, QUOTE_2]] = IN_OTHER
    to[TWO_LEFT, LETTER], to[ONE_LEFT, LETTER] = ONE_LEFT, FRESH
    emit[[ONE_LEFT, TWO_LEFT], LETTER] = 0
    return to, emit


NEXT, EMITS = _splitter()

_KIND = None


def _kinds() -> np.ndarray:
    """Per character: 0 other, 1 letter, 2 number, 3 white space."""
    global _KIND
    if _KIND is None:
        everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        _KIND = np.zeros(0x110000, np.uint8)
        for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
            for m in regex.finditer(pattern, everything):
                first, last = ord(m[0][0]), ord(m[0][-1])
                _KIND[first:last + 1] = kind
        _KIND[0xD800:0xE000] = 0
    return _KIND


def symbols_of(points: np.ndarray, ends: np.ndarray, special: list[tuple[int, int]]) -> np.ndarray:
    """Splitter symbols of the characters; ``ends`` marks separators, ``special`` the special strings."""
    kind = _kinds()[points]
    out = np.array([OTHER, LETTER, NUMBER, SPACE_MORE], np.uint8)[kind]
    stop = np.zeros(len(points) + 3, bool)
    stop[ends] = True
    stop[len(points):] = True
    for a, b in special:
        stop[a:b] = True
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    white = np.concatenate([kind == 3, np.zeros(3, bool)]) | stop       # or the end of what is split
    last = (kind == 3) & ~white[1:len(points) + 1]
    out[last] = WHITE_LAST
    out[last & (points == 32)] = SPACE_LAST
    quote = np.flatnonzero(points == 39)
    if len(quote):
        a, b = padded[quote + 1], padded[quote + 2]
        free = ~stop[quote + 1]
        one = free & np.isin(a, [ord(c) for c in "stmd"])
        pair = a.astype(np.int64) << 32 | b
        two = free & ~stop[quote + 2] & np.isin(pair, [ord(x) << 32 | ord(y) for x, y in ("re", "ve", "ll")])
        out[quote[one]] = QUOTE_1
        out[quote[two]] = QUOTE_2
    out[ends] = END
    for a, b in special:
        out[a:b] = SKIP
        out[a] = SPECIAL
    return out


def compose(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan of state maps: row i maps a start state to the state after chunks 0..i."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


def word_starts(symbols: np.ndarray, chunk: int = 4096) -> np.ndarray:
    """Places where words start, chunk by chunk, from composed chunk maps."""
    lanes = -(-len(symbols) // chunk)
    grid = np.full(lanes * chunk, END, np.uint8)
    grid[:len(symbols)] = symbols
    grid = np.ascontiguousarray(grid.reshape(lanes, chunk).T)            # one row per step
    flat, emits = NEXT.ravel(), EMITS.ravel().astype(bool)
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (lanes, 1))
    for row in grid:
        maps = flat[maps * np.uint8(SYMBOLS) + row[:, None]]
    state = np.concatenate([[FRESH], compose(maps)[:-1, FRESH]]).astype(np.uint8)
    starts = np.zeros((chunk, lanes), bool)
    for k, row in enumerate(grid):
        at = state * np.uint8(SYMBOLS) + row
        starts[k], state = emits[at], flat[at]
    return np.flatnonzero(starts.T.ravel()[:len(symbols)])


class Transitions:
    """Open-addressed table from (state, byte) to (next state, emitted count); grows as it fills."""

    STEP = 0x9E3779B97F4A7C15

    def __init__(self, bits: int = 16) -> None:
        self.bits, self.used = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(self.STEP)) >> np.uint64(64 - self.bits)).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 where there is none."""
        at = self._home(keys)
        out = self.values[at]
        other = np.flatnonzero(self.keys[at] != keys)
        at, mask = at[other], (1 << self.bits) - 1
        while len(other):
            seen = self.keys[at]
            out[other] = np.where(seen == keys[other], self.values[at], -1)
            more = (seen != keys[other]) & (seen >= 0)
            other, at = other[more], (at[more] + 1) & mask
        return out

    def put(self, key: int, value: int) -> None:
        if self.used * 3 > len(self.keys):
            old_keys, old_values = self.keys[self.keys >= 0], self.values[self.keys >= 0]
            self.__init__(self.bits + 1)
            for k, v in zip(old_keys.tolist(), old_values.tolist()):
                self._insert(k, v)
        self._insert(key, value)

    def _insert(self, key: int, value: int) -> None:
        at, mask = (key * self.STEP & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits), (1 << self.bits) - 1
        while self.keys[at] >= 0:
            at = (at + 1) & mask
        self.keys[at], self.values[at] = key, value
        self.used += 1


def _by_size(sizes: np.ndarray) -> np.ndarray:
    """Order of falling sizes (radix sort up to 65,535, which is nearly every word)."""
    if len(sizes) and int(sizes.max()) > 0xFFFF:
        return np.argsort(-sizes, kind="stable")
    return np.argsort(0xFFFF - sizes.astype(np.uint16), kind="stable")


class Counter:
    """The counting transducer, compiled as its transitions are first used."""

    #: states kept before the tables start anew (they are a cache; counts do not depend on it)
    MOST = 300_000
    #: bytes of a word that is cut, of its chunks, of what is read in front of a chunk to guess its state, and of
    #: a stretch after which the cache of states may start anew
    LONG, CHUNK, WARM, STRETCH = 4_096, 1_024, 128, 1 << 20
    ROUNDS = 24

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        n = max(tokens.values()) + 1
        rank, left, right = (np.full(n, -1, np.int64) for _ in range(3))
        pairs = {}
        for k, (a, b) in enumerate(merges):
            whole = tokens[a + b]
            pairs[(tokens[a], tokens[b])] = k
            if rank[whole] < 0:
                rank[whole], left[whole], right[whole] = k, tokens[a], tokens[b]
        self.rules = MergeRules(rank, left, right, pairs)
        self.children: list[dict[int, int]] = [{}]           # a trie of the tokens
        self.token: list[int] = [-1]
        for raw, i in tokens.items():
            if len(raw) > 1 and rank[i] < 0:                 # no merge makes it: it never appears
                continue
            node = 0
            for byte in raw:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = self.children[node][byte]
            self.token[node] = i
        self._reset()

    def _reset(self) -> None:
        #: open prefixes by start, packed: (trie node, token before the start or -1, count there minus count now)
        self.states: list[bytes] = [array("i", (0, -1, 0)).tobytes()]
        self.number = {self.states[0]: 0}
        self.table = Transitions()

    def _compile(self, state: int, byte: int) -> None:
        open_, token, grown = [], -1, 0
        flat = iter(memoryview(self.states[state]).cast("i"))
        for node, before, count in zip(flat, flat, flat):
            node = self.children[node].get(byte)
            if node is None:
                continue
            if token < 0 <= self.token[node] and (before < 0 or self.rules.adjacent_one(before, self.token[node])):
                token, grown = self.token[node], count + 1
            if self.children[node]:
                open_.append((node, before, count))
        key = array("i", [x for node, before, count in open_ for x in (node, before, count - grown)])
        key.extend((0, token, 0))
        key = key.tobytes()
        target = self._number_of(key)
        if not -128 <= grown < 128:
            raise OverflowError("a transition that changes the count by over 127")
        self.table.put(state << 8 | byte, target << 8 | grown + 128)

    def _number_of(self, key: bytes) -> int:
        target = self.number.get(key)
        if target is None:
            target = self.number[key] = len(self.states)
            self.states.append(key)
        return target

    def _values(self, keys: np.ndarray) -> np.ndarray:
        out = self.table.get(keys)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            for key in np.unique(keys[missing]).tolist():
                self._compile(key >> 8, key & 255)
            out[missing] = self.table.get(keys[missing])
        return out

    def _advance(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, state: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """(state after, tokens emitted) for every range of ``data`` from its start state; all advance together."""
        order = _by_size(sizes)
        place, state = starts[order], state[order]
        out = np.zeros(len(order), np.int64)
        longest = int(sizes.max(initial=0))
        longer = len(order) - np.cumsum(np.bincount(sizes, minlength=longest + 1)[:longest])     # ranges over k bytes
        for k, live in enumerate(longer.tolist()):
            value = self._values(state[:live] << 8 | data[place[:live] + k])
            out[:live] += (value & 255) - 128
            state[:live] = value >> 8
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], out[back]

    def count(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of every word data[start : start + size]."""
        if len(self.states) > self.MOST:
            self._reset()
        long = sizes > self.LONG
        out = np.zeros(len(starts), np.int64)
        out[~long] = self._advance(data, starts[~long], sizes[~long], np.zeros(int((~long).sum()), np.int64))[1]
        todo = np.flatnonzero(long)
        starts, left, state = starts.copy(), sizes.copy(), np.zeros(len(starts), np.int64)
        while len(todo):                                              # a stretch of every long word at a time
            size = np.minimum(left[todo], self.STRETCH)
            ends, counts = self._count_long(data, starts[todo], size, state[todo])
            out[todo] += counts
            starts[todo] += size
            left[todo] -= size
            state[todo] = ends
            todo = todo[left[todo] > 0]
            if len(todo) and len(self.states) > self.MOST:
                kept = [self.states[i] for i in state[todo].tolist()]
                self._reset()
                state[todo] = [self._number_of(key) for key in kept]
        return out

    def _count_long(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, entry: np.ndarray
                    ) -> tuple[np.ndarray, np.ndarray]:
        """(state after, tokens emitted) for long ranges, from composed maps of their chunks.

        A chunk's map is kept for the states that it can start in as far as known: at first the state that the
        bytes in front of it lead to, then every state in which the chunk before it ends.  When nothing new
        comes up, the maps are closed under composition and a prefix scan gives each chunk's start state.  Words
        that do not settle in ``ROUNDS`` rounds are followed from their start.
        """
        lanes = -(-sizes // self.CHUNK)
        word = np.repeat(np.arange(len(starts)), lanes)
        head = np.cumsum(lanes) - lanes                               # the first chunk of each word
        offset = (np.arange(len(word)) - head[word]) * self.CHUNK
        begin, size = starts[word] + offset, np.minimum(self.CHUNK, sizes[word] - offset)
        follows = np.zeros(len(word) + 1, bool)                       # chunk i goes on from chunk i - 1
        follows[:-1] = offset > 0
        warm = np.minimum(offset, self.WARM)
        guess = self._advance(data, begin - warm, warm, np.where(offset > 0, 0, entry[word]))[0]
        starts_of = [[s] for s in guess.tolist()]                     # per chunk: start states, and what they give
        ends_of, counts_of = ([[-1] for _ in word] for _ in range(2))
        place = [{s: 0} for s in guess.tolist()]
        todo = [(i, 0) for i in range(len(word))]
        rounds = 0
        while todo:
            at = np.array([i for i, _ in todo])
            first = np.array([starts_of[i][j] for i, j in todo], np.int64)
            ends, counts = self._advance(data, begin[at], size[at], first)
            new = []
            for (i, j), end, n in zip(todo, ends.tolist(), counts.tolist()):
                ends_of[i][j], counts_of[i][j] = end, n
                if follows[i + 1] and end not in place[i + 1]:
                    place[i + 1][end] = len(starts_of[i + 1])
                    new.append((i + 1, len(starts_of[i + 1])))
                    for held, value in ((starts_of, end), (ends_of, -1), (counts_of, 0)):
                        held[i + 1].append(value)
            todo, rounds = new, rounds + 1
            if rounds >= self.ROUNDS:                                 # only what the true start states reach
                todo = self._fronts(head, follows, place, ends_of)
        width = max(map(len, starts_of))
        maps, emitted = np.zeros((len(word), width), np.int64), np.zeros((len(word), width), np.int64)
        for i, (ends, counts) in enumerate(zip(ends_of, counts_of)):
            emitted[i, :len(counts)] = counts
            if follows[i + 1]:                                        # else: the next range's entry, its first state
                maps[i, :len(ends)] = [place[i + 1].get(e, 0) for e in ends]
        taken = np.concatenate([[0], compose(maps)[:-1, 0]])
        last = head + lanes - 1
        return (np.array([ends_of[i][taken[i]] for i in last.tolist()], np.int64),
                np.bincount(word, weights=emitted[np.arange(len(word)), taken], minlength=len(starts)).astype(np.int64))

    @staticmethod
    def _fronts(head: np.ndarray, follows: np.ndarray, place: list[dict[int, int]], ends_of: list[list[int]]
                ) -> list[tuple[int, int]]:
        """Per word, the first (chunk, start) on its path that has not run."""
        out = []
        for i in head.tolist():
            j = 0
            while ends_of[i][j] >= 0 and follows[i + 1]:
                i, j = i + 1, place[i + 1][ends_of[i][j]]
            if ends_of[i][j] < 0:
                out.append((i, j))
        return out


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 characters for
    themselves, all other bytes in order from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class Tokenizer:
    """A byte-level byte-pair tokenizer file as transducers."""

    def __init__(self, definition: str) -> None:
        spec = json.loads(definition)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and not spec["normalizer"] and not model.get("ignore_merges")
                 and not model.get("dropout"))
        if not plain:
            raise ValueError("not a plain byte-level byte-pair tokenizer")
        added = spec.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special strings that take in their surroundings are not supported")
        letters = _byte_letters()
        raw = lambda text: bytes(letters[c] for c in text)
        special = {t["content"] for t in added}
        tokens = {raw(t): i for t, i in model["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.counter = Counter(tokens, [(raw(a), raw(b)) for a, b in merges])
        self.special = re.compile("|".join(re.escape(t) for t in sorted(special, key=len, reverse=True))) if special else None

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of tokens of each text."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        special = []
        if self.special is not None:
            for i, text in enumerate(texts):
                special += [(int(ends[i]) - len(text) - 1 + m.start(), int(ends[i]) - len(text) - 1 + m.end())
                            for m in self.special.finditer(text)]
        symbols = symbols_of(points, ends - 1, special)
        starts = word_starts(symbols)
        # from characters to bytes
        wide = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        first = np.concatenate([[0], np.cumsum(wide)])
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        stop = np.flatnonzero((symbols == END) | (symbols == SPECIAL) | (symbols == SKIP))
        bound = np.append(starts[1:], len(points))
        after = np.searchsorted(stop, starts, side="right")
        bound = np.minimum(bound, np.append(stop, len(points))[after])
        begin, size = first[starts], first[bound] - first[starts]
        count = np.ones(len(starts), np.int64)
        ordinary = symbols[starts] != SPECIAL
        if ordinary.any():
            count[ordinary] = self.counter.count(data, begin[ordinary], size[ordinary])
        return np.bincount(np.searchsorted(ends, starts, side="right"), weights=count, minlength=len(texts)).astype(np.int64)


#: A space between two characters that are not white space always starts a word.
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


def parts(texts: list[str | None], chars: int) -> Iterator[tuple[int, str]]:
    """(row, part): texts in parts of about ``chars`` characters, cut where a word starts anyway."""
    for row, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            cut = _SAFE_CUT.search(text, at + chars) if len(text) - at > chars else None
            end = cut.start() if cut else len(text)
            yield row, text[at:end]
            at = end


_LOADED: dict[str, Tokenizer] = {}


def _tokenizer(definition: str) -> Tokenizer:
    if definition not in _LOADED:
        _LOADED.clear()
        _LOADED[definition] = Tokenizer(definition)
    return _LOADED[definition]


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text", group_chars: int = 1 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.  The tokenizer file (bounded by its
    vocabulary) is read by the driver and travels with the tasks."""
    definition = docs.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(definition.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens = np.zeros(len(texts), np.int64)
            rows, held, size = [], [], 0
            for row, part in parts(texts, group_chars):
                if held and size + len(part) > group_chars:
                    np.add.at(tokens, rows, tokenizer.counts(held))
                    rows, held, size = [], [], 0
                rows.append(row)
                held.append(part)
                size += len(part)
            if held:
                np.add.at(tokens, rows, tokenizer.counts(held))
            n_bytes = [0 if t is None else len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
