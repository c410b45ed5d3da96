"""Encoding into word pieces and decoding, by a max-plus scan over chunks.

The best segmentation of a text is the one whose pieces' scores have the largest
sum; of several, the one whose last piece is longest, then the one before it, and so
on. A document is cut into chunks at fixed places. The state at a cut is how many
characters the piece that straddles it reaches beyond it. A chunk turns into a
matrix: the best score from each state at its start to each state at its end, and
in which order states at its start are preferred when they tie.

Two scans over a document follow, each in three steps (:func:`_scanned`): elements
are combined within fixed blocks of chunks, a prefix over blocks gives the state
before each block, and each block works out the states of its chunks.

1. Forward, matrices combine by max-plus products, which is associative. The scan
   gives the best score of every state at every cut. With it, a chunk knows which
   state at its start belongs to each state at its end: a map.
2. Backward, maps combine by composition. The scan gives the state at every cut.

With both its states known each chunk is traced back on its own. Texts of one chunk
are traced whole, with the same result.

No piece has a space after another character, so the start of a word is never
inside a piece. A chunk that has such a place needs only what stands before the
first and after the last of them for its matrix: the part between adds the same
to every entry. Between such places words are segmented one by one; distinct
words of a batch are segmented side by side, once.

Scores are those of the model file as whole numbers. The vocabulary file here was
made by byte-pair merges, whose scores are negative ranks; what is computed is
the segmentation of largest score over that vocabulary, not the merges. The
lattice search (best of n) of the installed library agrees when it reads the file
as a unigram model. Characters without a piece become byte pieces, so decoding is
exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import raw_texts, slices, stored

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of a chunk.
CHUNK = 1 << 14

_NONE = -(1 << 60)
#: Chunks of a block of the scans.
BLOCK = 64
#: Units longer than this are segmented one by one.
_WIDE = 48
#: So many units are segmented side by side.
_ABREAST = 1 << 12
#: Bytes of text whose distinct units are segmented once.
_TEXT = 4 << 20


class Vocabulary:
    """The pieces of a model file, with a space for the file's space mark."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes_of = [b""] * len(ids)
        self.byte_ids = [0] * 256
        self.pieces: dict[str, tuple[int, int]] = {}
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace("▁", " ")
                self.pieces[text] = (round(model.get_score(i)), i)
                self.bytes_of[i] = text.encode()
        self.longest = max(map(len, self.pieces))
        known = {c for piece in self.pieces for c in piece} - {" "}
        if not all(c in self.pieces for c in known | {" "}):
            raise ValueError("every character of the pieces has to be a piece")
        if any(" " in piece.lstrip(" ") for piece in self.pieces):
            raise ValueError("a piece has a space after another character")
        self.known = known
        self._trie()

    def _trie(self) -> None:
        """Nodes in rows laid over each other: ``targets[base + letter]`` is a child if its parent agrees."""
        numbers: dict[str, int] = {}
        children: list[dict[int, int]] = [{}]
        parents, pieces = [-1], [(0, 0, -1)]
        for piece, (score, number) in self.pieces.items():
            node = 0
            for c in piece:
                letter = numbers.setdefault(c, len(numbers) + 1)
                if letter not in children[node]:
                    children[node][letter] = len(parents)
                    parents.append(node)
                    pieces.append((0, 0, -1))
                    children.append({})
                node = children[node][letter]
            pieces[node] = len(piece), score, number
        #: Numbers of letters by code point; 0 for characters without a piece.
        self.letters = np.zeros(0x110000, np.int32)
        self.letters[[ord(c) for c in numbers]] = list(numbers.values())
        self.parents = np.array(parents, np.int32)
        self.bases = np.zeros(len(parents), np.int32)
        # the fullest rows first, each where all its places are free; rows of one letter fill what is left
        order = sorted((k for k, row in enumerate(children) if row), key=lambda k: -len(children[k]))
        rows = [np.array(list(children[k])) for k in order]
        several = sum(len(row) > 1 for row in rows)
        used, window, base, before = np.zeros(2 * (len(parents) + len(numbers)), bool), 512, 0, 0
        for node, row in zip(order[:several], rows):
            if len(row) != before:
                base, before = 0, len(row)
            while True:
                if base + window + len(numbers) >= len(used):
                    used = np.append(used, np.zeros_like(used))
                taken = np.logical_or.reduce([used[base + letter : base + letter + window] for letter in row.tolist()])
                if not taken.all():
                    break
                base += window  # full for this row; those as long start here too
            self.bases[node] = base + taken.argmin()
            used[self.bases[node] + row] = True
        free = np.flatnonzero(~used[len(numbers) :])[: len(order) - several] + len(numbers)
        self.bases[order[several:]] = free - np.array([row[0] for row in rows[several:]], np.int64)
        self.targets = np.zeros(len(used), np.int32)
        for node, row in zip(order, rows):
            self.targets[self.bases[node] + row] = list(children[node].values())
        # a score and, below it, the length of the piece: of equal scores the longer piece is larger
        self.shift = self.longest.bit_length()
        lengths, scores, self.node_id = (np.array(x, np.int64) for x in zip(*pieces))
        self.node_worth = np.where(self.node_id >= 0, (scores << self.shift) + lengths, _NONE)

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Children of trie nodes by letter; 0 where there is none."""
        found = self.targets[self.bases[nodes] + letters]
        return np.where(self.parents[found] == nodes, found, 0)

    def spelt(self, char: str) -> list[int]:
        """Byte pieces of a character without a piece."""
        return [self.byte_ids[b] for b in char.encode()]

    def safe(self, before: str, after: str) -> bool:
        """Whether no piece can hold both neighbours of a place."""
        if after == " ":
            return before != " "
        return after not in self.known or (before != " " and before not in self.known)


@lru_cache(2)
def _vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a Python worker, kept from task to task."""
    return Vocabulary(path)


def segment(vocabulary: Vocabulary, text: str, stop: int | None = None) -> tuple[list[int], list[int], list[int]]:
    """(best score up to each place, length of the last piece, its id); no piece begins at ``stop`` or later.

    Of equal scores the longer last piece wins.
    """
    n = len(text)
    best, length, number = [0] + [_NONE] * n, [0] * (n + 1), [-1] * (n + 1)
    for i in range(n if stop is None else min(n, stop)):
        if best[i] == _NONE:
            continue
        for j in range(i + 1, min(n, i + vocabulary.longest) + 1):
            found = vocabulary.pieces.get(text[i:j])
            if found and best[i] + found[0] > best[j]:
                best[j], length[j], number[j] = best[i] + found[0], j - i, found[1]
    return best, length, number


def _trace(vocabulary: Vocabulary, text: str, stop: int | None = None) -> list[int]:
    """Ids of the best segmentation of a text whose characters all have pieces."""
    _, length, number = segment(vocabulary, text, stop)
    ids, at = [], len(text)
    while at:
        ids.append(number[at])
        at -= length[at]
    return ids[::-1]


def _side_by_side(vocabulary: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all units in a row, number of each unit's ids); all characters have pieces."""
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    width, lanes = int(sizes.max()), len(units)
    # a row for each place, a column for each unit; behind a unit 0, which leads nowhere
    grid = np.zeros((width + 1, lanes), np.int32)
    codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
    grid.T[np.arange(width + 1) < sizes[:, None]] = vocabulary.letters[codes]
    letters = grid.ravel()
    # nodes[n - 1]: where the n letters from each place lead
    nodes = np.zeros((min(vocabulary.longest, width), width, lanes), np.int32)
    at = np.flatnonzero(letters)
    node = np.zeros(len(at), np.int32)
    for n, reached in enumerate(nodes):
        node = vocabulary.step(node, letters[at + n * lanes])
        alive = np.flatnonzero(node)
        at, node = at[alive], node[alive]
        reached.reshape(-1)[at] = node
    # best score up to each place, with the length of the last piece in its low bits
    low = (1 << vocabulary.shift) - 1
    best = np.full((width + 1, lanes), _NONE)
    reach = np.zeros((width + 1, lanes), np.int64)
    for end in range(1, width + 1):
        for n in range(1, min(len(nodes), end) + 1):
            np.maximum(best[end], reach[end - n] + vocabulary.node_worth[nodes[n - 1, end - n]], out=best[end])
        reach[end] = best[end] & ~low
    lane, end = np.arange(lanes), sizes
    taken = []
    while len(lane):
        size = best[end, lane] & low
        end = end - size
        taken.append((lane, vocabulary.node_id[nodes[size - 1, end, lane]]))
        going = end > 0
        lane, end = lane[going], end[going]
    owners, ids = (np.concatenate(x) for x in zip(*taken))
    counts = np.bincount(owners, minlength=lanes)
    rank = np.concatenate([np.full(len(x), k) for k, (x, _) in enumerate(taken)])
    flat = np.empty(len(ids), np.int64)
    flat[np.cumsum(counts)[owners] - 1 - rank] = ids
    return flat, counts


def _units(vocabulary: Vocabulary, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct units, which of them are single characters without a piece, units in a row, first unit of each text and the end)."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    bounds = np.cumsum([0, *map(len, texts)])
    unknown, space = vocabulary.letters[codes] == 0, codes == ord(" ")
    begins = unknown.copy()
    begins[1:] |= unknown[:-1] | (space[1:] & ~space[:-1])
    begins[bounds[bounds < len(codes)]] = True
    places = np.flatnonzero(begins)
    raw = joined.encode()
    at = places
    if len(raw) > len(codes):
        at = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)[places]
    offsets = np.append(at, len(raw)).astype(np.int64)
    units = pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
    sequence = units.indices.to_numpy()
    single = np.zeros(len(units.dictionary), bool)
    single[sequence] = unknown[places]
    return units.dictionary.to_pylist(), single, sequence, np.searchsorted(places, bounds)


def _encoded(vocabulary: Vocabulary, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, where each text's begin, and the end); texts begin and end at safe places."""
    units, single, sequence, firsts = _units(vocabulary, texts)
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    wide = sizes > _WIDE
    plain = np.flatnonzero(~single & ~wide)
    plain = plain[np.argsort(sizes[plain], kind="stable")]  # units of like size waste no room
    counts, start = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
    flats, order = [np.zeros(0, np.int64)], [plain]
    for at in range(0, len(plain), _ABREAST):
        some = plain[at : at + _ABREAST]
        flat, counts[some] = _side_by_side(vocabulary, [units[k] for k in some.tolist()])
        flats.append(flat)
    for k in np.flatnonzero(single | wide).tolist():
        ids = vocabulary.spelt(units[k]) if single[k] else _trace(vocabulary, units[k])
        counts[k] = len(ids)
        flats.append(np.array(ids, np.int64))
        order.append(np.array([k]))
    order = np.concatenate(order)
    start[order] = np.cumsum(counts[order]) - counts[order]
    n = counts[sequence]
    ends = np.cumsum(n)
    pool = np.concatenate(flats).astype(np.int32)
    ids = pool[np.repeat(start[sequence] - (ends - n), n) + np.arange(n.sum())]
    return ids, np.append(0, ends)[firsts]


def encode_units(vocabulary: Vocabulary, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text; texts begin and end at safe places."""
    ids, bounds = _encoded(vocabulary, texts)
    return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _bounds(vocabulary: Vocabulary, before: str, text: str, size: int) -> tuple[int, int] | None:
    """First and last safe place of a chunk of ``size`` characters that ``text`` holds with what follows."""
    places = range(size + 1)

    def safe(p: int) -> bool:
        return (p == 0 and not before) or p == len(text) or vocabulary.safe(text[p - 1] if p else before, text[p])

    first = next((p for p in places if safe(p)), None)
    return None if first is None else (first, next(p for p in reversed(places) if safe(p)))


@dataclass
class Element:
    """A max-plus matrix, and the order in which tied states at its start are preferred (larger first).

    Where every path runs through one place the matrix is a sum of a column ``head``
    and a row ``after``, kept as such; else ``after`` is the matrix and ``head`` None.
    """

    head: np.ndarray | None
    after: np.ndarray
    order: np.ndarray

    def to_bytes(self) -> bytes:
        parts = [self.after, self.order] if self.head is None else [self.head, self.after, self.order]
        return bytes([self.head is not None]) + b"".join(p.astype("<i8").tobytes() for p in parts)

    @staticmethod
    def from_bytes(raw: bytes) -> Element:
        numbers = np.frombuffer(raw, "<i8", offset=1)
        if raw[0]:
            return Element(*numbers.reshape(3, -1))
        side = int((len(numbers) // 2) ** 0.5)
        return Element(None, *numbers.reshape(2, side, side))


def _held(scores: np.ndarray) -> np.ndarray:
    return np.where(scores > _NONE // 2, scores, _NONE)


def advance(reach: np.ndarray, element: Element) -> np.ndarray:
    """Best scores (last axis: states) behind a chunk from those before it."""
    if element.head is None:
        return _held((reach[..., :, None] + element.after).max(axis=-2))
    return _held((reach + element.head).max(axis=-1)[..., None] + element.after)


def product(a: Element, b: Element) -> Element:
    """The max-plus product, associative; a product has no order of states."""
    if a.head is not None:
        head, after = a.head, advance(a.after, b)
    elif b.head is not None:
        head, after = _held((a.after + b.head).max(axis=1)), b.after
    else:
        head, after = None, advance(a.after, b)
    return Element(head, after, np.zeros_like(after))


def entries(reach: np.ndarray, element: Element) -> np.ndarray:
    """The state at a chunk's start for each state at its end."""
    head = element.after if element.head is None else np.repeat(element.head[:, None], len(reach), axis=1)
    order = element.order if element.head is None else element.order[:, None]
    total = reach[:, None] + head
    return np.where(total == total.max(axis=0), order, -1).argmax(axis=0)


def _preferred(paths: list[tuple | None]) -> np.ndarray:
    """Rank of each path by the lengths of its pieces, the last one first; -1 for none.

    A piece that began before the chunk is longer than any that ends where it does.
    """
    known = sorted((p + (float("inf"),), k) for k, p in enumerate(paths) if p is not None)
    ranks = np.full(len(paths), -1)
    for rank, (_, k) in enumerate(known):
        ranks[k] = rank
    return ranks


def _lengths(length: list[int], end: int) -> tuple[int, ...]:
    """Lengths of the pieces of a segmentation, the last one first."""
    found = []
    while end:
        found.append(length[end])
        end -= length[end]
    return tuple(found)


def transfer(vocabulary: Vocabulary, before: str, text: str, size: int) -> Element:
    """The max-plus matrix of a chunk, up to a constant; states are characters beyond a cut."""
    states = vocabulary.longest
    found = _bounds(vocabulary, before, text, size)

    def outgoing(at: int) -> tuple[np.ndarray, list[int]]:
        best, length, _ = segment(vocabulary, text[at:], size - at) if at < size else ([0], [0], [])
        scores = np.array(best[size - at :][:states])
        return np.concatenate([scores, np.full(states - len(scores), _NONE)]), length

    if found is None:
        matrix = np.full((states, states), _NONE)
        paths: list[list] = [[None] * states for _ in range(states)]
        for k in range(min(states, size + 1)):
            matrix[k], length = outgoing(k)
            for e in np.flatnonzero(matrix[k] > _NONE // 2).tolist():
                paths[e][k] = _lengths(length, size - k + e)
        return Element(None, _held(matrix), np.stack([_preferred(p) for p in paths], axis=1))
    first, last = found
    head, into = np.full(states, _NONE), [None] * states
    for k in range(min(states, first + 1)):
        best, length, _ = segment(vocabulary, text[k:first])
        if best[-1] > _NONE // 2:
            head[k], into[k] = best[-1], _lengths(length, first - k)
    return Element(head, _held(outgoing(last)[0]), _preferred(into))


def trace(vocabulary: Vocabulary, before: str, text: str, size: int, entry: int, leave: int) -> tuple[list[int], str, list[int]]:
    """Ids before the first safe place, the text between safe places, ids after the last."""
    found = _bounds(vocabulary, before, text, size)
    if found is None:
        return _trace(vocabulary, text[entry : size + leave], size - entry), "", []
    first, last = found
    tail = _trace(vocabulary, text[last : size + leave], size - last) if last < size else []
    return _trace(vocabulary, text[entry:first]), text[first:last], tail


def _start(states: int) -> np.ndarray:
    """Scores before a document: no piece reaches into it."""
    return np.array([0] + [_NONE] * (states - 1))


def _levelled(reach: np.ndarray) -> np.ndarray:
    """A constant does not change the path; without it sums stay small."""
    return _held(np.where(reach > _NONE // 2, reach - reach.max(), _NONE))


def scan(elements: list[Element]) -> list[int]:
    """The state at each cut, the first and last included, of the best path through all chunks."""
    reach, maps = _start(len(elements[0].order)), []
    for e in elements:
        maps.append(entries(reach, e))
        reach = _levelled(advance(reach, e))
    states = [0]
    for m in reversed(maps):
        states.append(int(m[states[-1]]))
    return states[::-1]


def decode_ids(vocabulary: Vocabulary, ids) -> str:
    """The text of a list of ids: the inverse of the encoding."""
    return b"".join(map(vocabulary.bytes_of.__getitem__, ids)).decode(errors="replace")[1:]


_CHUNKS = "row long, chunk int, before string, text string, size int"


def _cut_chunks(chunk: int, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 1 << 20):
            rows = []
            for row, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                text = " " + raw.decode()
                for k, at in enumerate(range(0, len(text), chunk)):
                    size = min(chunk, len(text) - at)
                    rows.append((row, k, text[max(at - 1, 0) : at], text[at : at + size + reach - 1], size))
            types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32()]
            for a in range(0, len(rows), 256):
                columns = [pa.array(c, t) for c, t in zip(zip(*rows[a : a + 256]), types)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "chunk", "before", "text", "size"])

    return run


def _matrices(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for batch in slices(batches, 3, 4 << 20):
            chunks = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))
            cells = [transfer(vocabulary, *x).to_bytes() for x in chunks]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells, pa.binary())], ["row", "chunk", "item"])

    return run


class _Forward:
    """Scores of states as they advance through matrices; each chunk's map is left behind."""

    load, join, last_first = staticmethod(Element.from_bytes), staticmethod(product), False

    def __init__(self, states: int):
        self.first = _start(states).astype("<i8").tobytes()

    @staticmethod
    def through(state: bytes, element: Element) -> tuple[bytes, bytes]:
        """(state behind the element, what is left behind)."""
        reach = np.frombuffer(state, "<i8")
        after = _levelled(advance(reach, element)).astype("<i8").tobytes()
        return after, entries(reach, element).astype("<i8").tobytes()


class _Backward:
    """The state at each cut, from the end; each chunk's two states are left behind."""

    last_first, first = True, np.zeros(1, "<i8").tobytes()

    @staticmethod
    def load(raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, "<i8")

    @staticmethod
    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return b[a]

    @staticmethod
    def through(state: bytes, entry_of: np.ndarray) -> tuple[bytes, bytes]:
        leave = np.frombuffer(state, "<i8")
        entry = entry_of[leave]
        return entry.astype("<i8").tobytes(), np.concatenate([entry, leave]).astype("<i8").tobytes()


_ITEM = "row long, chunk int, item binary"


def _scanned(items: DataFrame, kind) -> DataFrame:
    """(row, chunk, item): what ``kind`` leaves behind at each chunk as it runs through a document.

    Three steps: blocks of ``BLOCK`` chunks are combined; the state before each block is
    worked out over a document's blocks; then the states within each block.
    """
    turned = -1 if kind.last_first else 1

    def ordered(table: pa.Table, place: str) -> list[tuple[int, bytes]]:
        return sorted(zip(table[place].to_pylist(), table["item"].to_pylist()), key=lambda x: turned * x[0])

    def table_of(row: int, places: list[int], cells: list[bytes], place: str) -> pa.Table:
        columns = [pa.array([row] * len(cells), pa.int64()), pa.array(places, pa.int32()), pa.array(cells, pa.binary())]
        return pa.Table.from_arrays(columns, ["row", place, "item"])

    def combined(key: tuple, table: pa.Table) -> pa.Table:
        found = None
        for _, raw in ordered(table, "chunk"):
            element = kind.load(raw)
            found = element if found is None else kind.join(found, element)
        cell = found.to_bytes() if isinstance(found, Element) else found.astype("<i8").tobytes()
        return table_of(key[0].as_py(), [key[1].as_py()], [cell], "block")

    def before_blocks(key: tuple, table: pa.Table) -> pa.Table:
        state, places, cells = kind.first, [], []
        for block, raw in ordered(table, "block"):
            places.append(block)
            cells.append(state)
            state = kind.through(state, kind.load(raw))[0]
        return table_of(key[0].as_py(), places, cells, "block")

    def within(key: tuple, table: pa.Table, before: pa.Table) -> pa.Table:
        state, places, cells = before["item"][0].as_py(), [], []
        for chunk, raw in ordered(table, "chunk"):
            state, left = kind.through(state, kind.load(raw))
            places.append(chunk)
            cells.append(left)
        return table_of(key[0].as_py(), places, cells, "chunk")

    keys = ["row", "block"]
    items = items.withColumn("block", F.expr(f"chunk div {BLOCK}").cast("int"))
    blocks = items.groupBy(*keys).applyInArrow(combined, "row long, block int, item binary")
    starts = blocks.groupBy("row").applyInArrow(before_blocks, "row long, block int, item binary")
    return items.groupBy(*keys).cogroup(starts.groupBy(*keys)).applyInArrow(within, _ITEM)


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = np.array([np.frombuffer(c, "<i8") for c in batch.column(2).to_pylist()], np.int32).reshape(-1, 2)
        arrays = [batch.column(0), batch.column(1), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
        yield pa.RecordBatch.from_arrays(arrays, ["row", "chunk", "entry", "leave"])


def _traces(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for batch in slices(batches, 3, _TEXT):
            parts = [trace(vocabulary, *x) for x in zip(*(batch.column(k).to_pylist() for k in range(2, 7)))]
            middles = encode_units(vocabulary, [m for _, m, _ in parts])
            ids = [np.concatenate([np.array(a, np.int32), m, np.array(b, np.int32)]) for (a, _, b), m in zip(parts, middles)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(ids)], ["row", "chunk", "ids"])

    return run


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    values = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))


def _digest(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    return hashlib.md5(decode_ids(vocabulary, ids.tolist()).encode()).hexdigest()


def _short(model: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for batch in slices(batches, 1, _TEXT):
            texts = [" " + raw.decode() if raw else "" for raw in raw_texts(batch.column(1))]
            ids = encode_units(vocabulary, texts)
            marks = pa.array([_digest(vocabulary, x) for x in ids] if digest else [None] * len(ids), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids), marks], ["doc", "ids", "text_md5"])

    return run


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: str = MODEL,
    chunk: int = CHUNK,
    digest: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id and ids (array of int).

    With ``digest`` also text_md5: the MD5 of the text that the ids decode to.

    A space is put before a text, as the model asks; NULL and empty texts have no
    ids. A literal space mark in a text is spelt in bytes. Texts of one chunk are
    encoded where they are; longer ones are dealt out by chunk, with the same ids
    whatever the chunk, and no task holds more of a document than a block of matrices,
    one small state for each block, or its result. Rows that repeat
    are each encoded. An empty table gives an empty result. Only the two named
    columns are read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    short = rows.where(F.coalesce(F.length("text"), F.lit(0)) < chunk)
    short = short.mapInArrow(_short(model, digest), "doc long, ids array<int>, text_md5 string")
    reach = _vocabulary(model).longest
    if chunk < reach:
        raise ValueError(f"a chunk needs at least {reach} characters")
    long = rows.where(F.length("text") >= chunk).withColumn("row", F.monotonically_increasing_id())
    long = stored(long)
    chunks = stored(long.select("row", "text").mapInArrow(_cut_chunks(chunk, reach), _CHUNKS).repartition("row", "chunk"))
    matrices = stored(chunks.mapInArrow(_matrices(model), _ITEM))
    maps = stored(_scanned(matrices, _Forward(reach)))
    states = _scanned(maps, _Backward()).mapInArrow(_states, "row long, chunk int, entry int, leave int")
    traced = chunks.join(states, ["row", "chunk"]).mapInArrow(_traces(model), "row long, chunk int, ids array<int>")
    whole = traced.groupBy("row").agg(F.flatten(F.sort_array(F.collect_list(F.struct("chunk", "ids")))["ids"]).alias("ids"))
    encoded = long.select("row", "doc").join(whole, "row").select("doc", "ids")
    if digest:
        encoded = decode(encoded, text_col="text", model=model).select("doc", "ids", F.md5("text").alias("text_md5"))
        return short.union(encoded).withColumnRenamed("doc", id_col)
    return short.drop("text_md5").union(encoded).withColumnRenamed("doc", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``encoded`` with the decoded text in ``text_col``; NULL and empty lists give the empty text."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = _vocabulary(model)
        for series in batches:
            yield series.map(lambda ids: decode_ids(vocabulary, () if ids is None else ids.tolist()))

    return encoded.withColumn(text_col, text(F.col(ids_col)))
