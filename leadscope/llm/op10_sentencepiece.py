"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct words (a word starts at a space mark) form one text.  Its suffixes, each up to the end
of its word, are sorted by as many characters as the longest piece has, in letters that pack as many
characters of the text's own alphabet as 64 bits hold; every piece is looked up by binary search, and its
range of suffixes gives all its occurrences: edges (start, piece).  The edges are sorted by the position they end
at and relaxed in that order: the edge that reaches a position is the one whose piece may follow the
piece that ends at the edge's start (``MergeRules.adjacent``).  In a byte-pair model exactly one edge
does, and following the edges back from a word's end gives the model's encoding.

Defined cases: NULL text gives NULL ids and counts 0 tokens; empty text has no tokens; characters without
a piece become byte pieces; a text that holds U+2581 itself decodes with a space there, as in the
library.  Repeated rows stay rows.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.llm.common import frugal
from leadscope.llm.merges import MergeRules, merge_down

MARK = "▁"
LONG_WORD = 4096


class Vocabulary:
    """Pieces of a byte-pair model with byte fallback, read from the model file."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = lib.get_piece_size()
        self.size, self.text, self.byte_id, self.value = n, {}, {}, [b""] * n
        scored = []
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.value[i] = bytes([int(piece[1:-1], 16)])
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.text[piece] = i
                self.value[i] = piece.replace(MARK, " ").encode()
                if len(piece) > 1:
                    scored.append((-lib.get_score(i), i, piece))
        if any(MARK in p.lstrip(MARK) for p in self.text):
            raise ValueError("pieces that span words are not supported")
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        # characters that only occur inside pieces get ids of their own, above the vocabulary
        inner = sorted({c for p in self.text for c in p} - set(self.text))
        self.atom = {c: n + k for k, c in enumerate(inner)}
        ids = {**self.text, **self.atom}
        total = n + len(inner) + 1
        self.other = total - 1                        # any character of no piece
        rank = np.full(total, -1, np.int64)
        pairs, made = {}, {}
        for k, (_, i, piece) in enumerate(sorted(scored)):
            rank[i], made[k] = k, i
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[(a, b)] = k
        left, right = np.full(total, -1, np.int64), np.full(total, -1, np.int64)
        usable = np.ones(total, bool)
        for _, i, piece in scored:
            tokens, last = merge_down([ids[c] for c in piece], pairs, made)
            usable[i] = tokens == [i]
            if usable[i]:
                left[i], right[i] = last
        self.rules, self.usable = MergeRules(rank, left, right, pairs), usable
        self.longest = max(map(len, self.text))
        self._match_tables(ids)

    def _match_tables(self, ids: dict[str, int]) -> None:
        chars = sorted({c for p in ids for c in p})
        if len(chars) > (1 << 16) - 2:
            raise ValueError("over 65,534 characters in pieces")
        self.code = np.full(0x110000, len(chars) + 1, np.uint16)
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.codes = len(chars) + 2
        pieces = [p for p in sorted(ids, key=lambda p: (-len(p), p)) if self.usable[ids[p]]]   # long edges first
        self.piece_ids = np.array([ids[p] for p in pieces], np.int32)
        self.piece_len = np.array([len(p) for p in pieces], np.int32)
        self.piece_codes = np.zeros((self.longest, len(pieces)), np.uint16)
        for row, p in enumerate(pieces):
            self.piece_codes[:len(p), row] = self.code[[ord(c) for c in p]]

    def encode_long(self, word: str) -> list[int]:
        """One very long word, position by position."""
        ids, ends, starts = {**self.text, **self.atom}, [-1] * (len(word) + 1), [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            for size in range(min(self.longest, end), 0, -1):
                piece = ids.get(word[end - size:end], self.other if size == 1 else None)
                if piece is None or not self.usable[piece]:
                    continue
                if end == size or self.rules.adjacent_one(ends[end - size], piece):
                    ends[end], starts[end] = piece, end - size
                    break
        out, at = [], len(word)
        while at:
            piece = ends[at]
            out.append(word[at - 1] if piece >= self.size else piece)
            at = starts[at]
        flat: list[int] = []
        for x in reversed(out):
            flat += [x] if isinstance(x, int) else [self.byte_id[b] for b in x.encode("utf-8", "surrogatepass")]
        return flat


def _bisect(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of wanted[i] in the sorted part values[low[i]:high[i]], all at once."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        value = values[np.minimum(middle, len(values) - 1)]
        up = open_ & ((value <= wanted) if right else (value < wanted))
        low, high = np.where(up, middle + 1, low), np.where(open_ & ~up, middle, high)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _packed(codes: np.ndarray, per: int, bits: int) -> np.ndarray:
    """Per place the next ``per`` codes in one letter, the first in the highest bits."""
    out = np.zeros(len(codes) - per + 1, np.uint64)
    for k in range(per):
        out <<= np.uint64(bits)
        out |= codes[k:len(out) + k]
    return out


def occurrences(text: np.ndarray, left: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(start, piece row) of every occurrence of every piece in the coded text, longer pieces first.
    ``left``: the characters from each place to the end of its word; the places between words have none."""
    found = np.bincount(text, minlength=vocabulary.codes) > 0
    found[0] = True
    own = (np.cumsum(found) - 1).astype(np.uint64)          # the text's own alphabet, in order; 0 ends a word
    bits = max(1, int(own[-1]).bit_length())
    per = min(64 // bits, vocabulary.longest)               # characters in a letter
    levels = -(-vocabulary.longest // per)
    kept = np.uint64((1 << per * bits) - 1) ^ np.array([(1 << bits * (per - k)) - 1 for k in range(per + 1)], np.uint64)
    n = len(text)
    first = _packed(np.concatenate([own[text], np.zeros(per - 1, np.uint64)]), per, bits)
    first &= kept[np.minimum(left, per)]

    def letter(k: int, places: np.ndarray) -> np.ndarray:
        if k == 0:
            return first[places]
        return np.where(left[places] > k * per, first[np.minimum(places + k * per, n - 1)], np.uint64(0))

    order = np.argsort(first)                               # the suffix array, to the longest piece's depth
    ranked = first[order]
    if levels > 1:                                          # only full letters that occur again need more
        same = ranked[1:] == ranked[:-1]
        tied = np.zeros(n, bool)
        tied[1:] = same
        tied[:-1] |= same
        tied = np.flatnonzero(tied & (left[order] >= per))
        places = order[tied]
        order[tied] = places[np.lexsort([letter(k, places) for k in range(levels - 1, -1, -1)])]

    rows = np.flatnonzero(found[vocabulary.piece_codes].all(axis=0))      # pieces of the text's characters
    size = vocabulary.piece_len[rows]
    codes = np.zeros((levels * per, len(rows)), np.uint64)
    codes[:vocabulary.longest] = own[vocabulary.piece_codes[:, rows]]
    low, high = np.zeros(len(rows), np.int64), np.full(len(rows), n, np.int64)
    for k in range(levels):
        used = np.flatnonzero((size > k * per) & (low < high))
        if not len(used):
            break
        least = np.zeros(len(used), np.uint64)
        for c in codes[k * per:(k + 1) * per]:
            least = least << np.uint64(bits) | c[used]
        most = least | (kept[per] ^ kept[np.minimum(size[used] - k * per, per)])
        if k == 0:
            low[used], high[used] = np.searchsorted(ranked, least), np.searchsorted(ranked, most, "right")
        else:
            ranked = letter(k, order)
            low[used], high[used] = (_bisect(ranked, low[used], high[used], least, False),
                                     _bisect(ranked, low[used], high[used], most, True))
    count = np.maximum(high - low, 0)
    return order[_spread(low, count)], np.repeat(rows, count)


def _by_end(end: np.ndarray) -> np.ndarray:
    """Stable order by position (radix sort, sixteen bits a pass)."""
    order = np.argsort((end & 0xFFFF).astype(np.uint16), kind="stable")
    top = end >> 16
    return order[np.argsort(top[order].astype(np.uint16), kind="stable")] if top.any() else order


def encode_words(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and the number of ids of each (not empty) word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    points = np.frombuffer("\0".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    coded = vocabulary.code[points]
    coded[starts[1:] - 1] = 0
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes + 1)[:len(points)]
    offset = (np.arange(len(points)) - starts[owner]).astype(np.int32)
    left = sizes[owner].astype(np.int32) - offset
    start, row = occurrences(coded, left, vocabulary)
    size = vocabulary.piece_len[row]
    known = np.zeros(len(points), bool)                     # a piece of one character starts here
    known[start[size == 1]] = True
    lone = np.flatnonzero(~known & (left > 0))
    start = np.concatenate([start, lone]).astype(np.int32)
    size = np.concatenate([size, np.ones(len(lone), np.int32)])
    piece = np.concatenate([vocabulary.piece_ids[row], np.full(len(lone), vocabulary.other, np.int32)])
    end = offset[start] + size
    order = _by_end(end)
    start, size, piece, end = start[order], size[order], piece[order], end[order]

    last = np.full(len(points) + 1, -1, np.int32)           # piece that ends before this place
    back = np.zeros(len(points) + 1, np.int32)
    if len(end):
        fresh = np.concatenate([[True], (end[1:] != end[:-1]) | (size[1:] != size[:-1])])
        cuts = np.append(np.flatnonzero(fresh), len(end)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            goal = start[a:b] + size[a]
            edge = np.flatnonzero(last[goal] < 0)           # longer edges may have reached it
            if not len(edge):
                continue
            if int(end[a]) > int(size[a]):
                edge = edge[vocabulary.rules.adjacent(last[start[a:b][edge]], piece[a:b][edge])]
            last[goal[edge]], back[goal[edge]] = piece[a:b][edge], size[a]

    closes = np.zeros(len(points), bool)                    # an id of the encoding ends here
    at, live = starts + sizes, np.arange(len(words))
    while len(live):
        at_live = at[live]
        closes[at_live - 1] = True
        at[live] = at_live = at_live - back[at_live]
        live = live[at_live > starts[live]]
    place = np.flatnonzero(closes)
    owner, ids = owner[place], last[place + 1]
    counts = np.bincount(owner, minlength=len(words))
    lone = np.flatnonzero(ids >= vocabulary.size)
    if len(lone):                                           # byte pieces in place of the character
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in points[place[lone]].tolist()]
        times = np.ones(len(ids), np.int64)
        times[lone] = [len(r) for r in raw]
        counts = np.bincount(np.repeat(owner, times), minlength=len(words))
        wide = np.repeat(ids, times)
        wide[np.repeat(ids >= vocabulary.size, times)] = [vocabulary.byte_id[b] for r in raw for b in r]
        ids = wide
    return ids, counts


def _units(texts: list[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, str]]:
    """(row, marked text); a long text comes in several parts, each starting at a space mark."""
    for row, text in enumerate(texts):
        if not text:
            continue
        marked = MARK + text.replace(" ", MARK)
        at = 0
        while at < len(marked):
            end = min(len(marked), at + chars)
            while end < len(marked) and (marked[end] != MARK or marked[end - 1] == MARK):
                cut = marked.find(MARK, end + 1)
                end = len(marked) if cut < 0 else cut
            yield row, marked[at:end]
            at = end


_WORD = re.compile(f"{MARK}+[^{MARK}]*")


def _words(text: str) -> list[str]:
    """The words of a marked text, each without its first mark."""
    return text[1:].split(MARK) if MARK + MARK not in text else [w[1:] for w in _WORD.findall(text)]


def _encode_group(units: list[tuple[int, str]], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, ids, number of ids) per unit."""
    words = [_words(text) for _, text in units]
    per_unit = np.fromiter(map(len, words), np.int64, len(words))
    number: defaultdict[str, int] = defaultdict(itertools.count().__next__)
    uses = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(per_unit.sum()))
    del words
    distinct = [MARK + w for w in number]
    short = [w for w in distinct if len(w) <= LONG_WORD]
    ids, counts = encode_words(short, vocabulary) if short else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    if len(short) < len(distinct):
        extra = [(k, np.array(vocabulary.encode_long(w), np.int32)) for k, w in enumerate(distinct) if len(w) > LONG_WORD]
        full = np.zeros(len(distinct), np.int64)
        is_short = np.array([len(w) <= LONG_WORD for w in distinct])
        full[is_short] = counts
        starts = np.zeros(len(distinct), np.int64)
        starts[is_short] = np.cumsum(counts) - counts
        at = len(ids)
        for k, piece in extra:
            full[k], starts[k] = len(piece), at
            at += len(piece)
        ids, counts = np.concatenate([ids, *(p for _, p in extra)]), full
    else:
        starts = np.cumsum(counts) - counts
    out = ids[_spread(starts[uses], counts[uses])]
    unit = np.repeat(np.arange(len(units)), per_unit)
    return (np.array([r for r, _ in units]), out,
            np.bincount(unit, weights=counts[uses], minlength=len(units)).astype(np.int64))


def encode_texts(texts: list[str | None], vocabulary: Vocabulary, chars: int = 512 << 10
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and the number of ids of each."""
    rows, ids, counts, held, size = [], [], [], [], 0

    def flush() -> None:
        for out, part in zip((rows, ids, counts), _encode_group(held, vocabulary)):
            out.append(part)

    for unit in _units(texts):
        held.append(unit)
        size += len(unit[1])
        if size >= chars:
            flush()
            held, size = [], 0
    if held:
        flush()
    if not rows:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    per_row = np.bincount(np.concatenate(rows), weights=np.concatenate(counts), minlength=len(texts)).astype(np.int64)
    return np.concatenate(ids).astype(np.int32), per_row


def decode_ids(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of an encoding; bytes that are no UTF-8 become U+FFFD."""
    raw = b"".join(map(vocabulary.value.__getitem__, ids))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_LOADED: dict[bytes, Vocabulary] = {}


def _vocabulary(model: bytes) -> Vocabulary:
    if model not in _LOADED:
        _LOADED.clear()
        _LOADED[model] = Vocabulary(model)
    return _LOADED[model]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           chars: int = 512 << 10) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip for every row; the model (a vocabulary of bounded size, read by
    the driver) travels with the tasks.  round_trip: decoding gives the text back (its U+2581 as spaces);
    NULL for a NULL text."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first in range(0, len(texts), 1000):
                part = texts[first:first + 1000]
                ids, counts = encode_texts(part, vocabulary, chars)
                ends = np.concatenate([[0], np.cumsum(counts)])
                same = [None if t is None else decode_ids(ids[a:b].tolist(), vocabulary) == t.replace(MARK, " ")
                        for t, a, b in zip(part, ends, ends[1:])]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()),
                                                 mask=pa.array([t is None for t in part]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(counts, pa.int64()), lists, pa.array(same, pa.bool_())],
                    names=["doc_id", "n_tokens", "ids", "round_trip"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        frugal(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text from encodings; NULL ids give NULL text.  An unknown id is an error."""
    model = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model.value)
        for batch in batches:
            texts = [None if ids is None else decode_ids(ids, vocabulary) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"doc_id {encoded.schema[id_col].dataType.simpleString()}, text string")
