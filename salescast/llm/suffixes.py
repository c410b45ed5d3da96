"""Removal of byte strings that an earlier document has, by a depth-limited radix sort.

The suffixes of all documents are ordered through ``WIDTH`` bytes only, digit by digit
and the most significant digit first; after each pass, groups that lie in one document
leave. What is left at the end are exactly the windows that repeat across documents.

The digits of a window are chosen so that neighbours share them:

1. The first digit is its landmark: of the grams of ``GRAM`` bytes in the window, the
   one with the smallest hash, the leftmost of equals. It depends on the window's bytes
   alone, so equal windows have equal landmarks at equal places. Windows in a row with
   one landmark form a stretch, about 18 windows, and travel as one row. This pass is
   dealt to shards by ranges of the landmark, which as the smallest of many hashes is
   mostly small: the ranges are quantiles.
2. The second digit is the whole stretch. Of equal stretches all but those of the
   smallest document are covered. Only where a landmark has several different
   stretches does the smallest document of each send its windows on.
3. The third digit is what stands next to the landmark: windows that reach far to its
   right go by the bytes there, the others by those to its left. A stretch travels as
   these two halves with its bytes, dealt to shards by that digit.
4. Windows of the halves that are left are ordered by all their bytes, eight at a time.
   Of equal windows all but those of the smallest document are covered.

What a task can settle in its own batch of texts it settles there: of equal stretches
or windows only the smallest document's travels, so a text or passage with very many
copies arrives as one row from each batch. A shard is worked on in ranges of its first
digit and its windows in runs of groups, so memory does not follow the shard's size.

Stretches are compared by 64-bit hashes beside their landmark's, windows by their bytes.
Results return by document and content, not by place: whoever reads the text again
finds the places by computing the same stretches. Very long texts are worked on in
parts that overlap by a window; a stretch that a border cuts differs from its copies
elsewhere and is settled by its windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import raw_texts, slices

WIDTH = 50
GRAM = 16
#: Bytes of text whose stretches are settled among each other before they travel.
BATCH = 4 << 20
#: Bytes of text that are hashed at once, and of the parts of a long text.
PART = 1 << 19
#: Rows of a shard, and windows of its halves, that are looked at together.
SLICE = 1 << 17

_U = np.uint64
_EIGHT = -(-WIDTH // 8)
#: What is kept of a first digit: 40 bits. It only brings rows together, so two in one are no harm.
_COARSE = _U(0xFFFFFFFFFF000000)
#: A window has so many bytes beside its landmark, and at least half of them on one side.
_BESIDE = WIDTH - GRAM
_SIDE = _BESIDE // 2
#: Bytes of a half of a stretch, in whole numbers of eight bytes.
_HALF = -(-(WIDTH + _SIDE) // 8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _steps(size: int) -> list[int]:
    """Where words of eight bytes begin that together are the next ``size`` bytes."""
    return [*range(0, size - 8, 8), size - 8]


def _chained(*words: np.ndarray) -> np.ndarray:
    """One hash for each place, over words side by side."""
    found = _mix(words[0])
    for w in words[1:]:
        found = _mix(found * _U(0x9E3779B97F4A7C15) + w)
    return found


class Stretches:
    """The stretches of a batch of texts, each from window ``low`` to window ``high``.

    ``texts`` are (row, bytes); ``rows`` says whose a stretch is. ``low`` and ``high``
    are places in ``data``, where text ``k`` begins at ``begin[k]``.
    """

    def __init__(self, texts: list[tuple[int, bytes]]):
        sizes = np.array([len(t) for _, t in texts], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        raw = b"".join(t for _, t in texts)
        self.data = np.frombuffer(raw, np.uint8)
        counts = np.maximum(sizes - WIDTH + 1, 0)
        text = np.repeat(np.arange(len(texts)), counts)
        starts = self.begin[text] + np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        if not len(starts):
            self.text = self.rows = self.low = self.high = self.place = np.zeros(0, np.int64)
            self.landmark = self.content = np.zeros(0, _U)
            return
        self.eight = eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        gram = _chained(*(eight[k : len(eight) - GRAM + 8 + k] for k in _steps(GRAM)))
        # hash above, place below: the smallest is the leftmost of the smallest hashes
        key = gram & _U(0xFFFFFFFF00000000) | np.arange(len(gram), dtype=_U)
        reach, span = WIDTH - GRAM + 1, 1
        while 2 * span <= reach:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if span < reach:
            key = np.minimum(key[: span - reach], key[reach - span :])
        place = (key[starts] & _U(0xFFFFFFFF)).astype(np.int64)
        head = np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])]
        first = np.flatnonzero(head)
        last = np.r_[first[1:], len(head)] - 1
        self.text, self.low, self.high = text[first], starts[first], starts[last]
        self.rows = np.array([r for r, _ in texts], np.int64)[self.text]
        self.place = place[first]
        self.landmark = gram[self.place] & _COARSE
        view, code = memoryview(raw), xxhash.xxh3_64_intdigest
        bounds = zip(self.low.tolist(), (self.high + WIDTH).tolist())
        self.content = np.fromiter((code(view[a:b]) for a, b in bounds), _U, len(first))

    def windows(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, stretches) of all windows of some stretches."""
        counts = (self.high - self.low + 1)[some]
        owner = np.repeat(some, counts)
        return self.low[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts), owner

    def halves(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(digits, stretches): bytes beside the landmark (as a hash), windows, bytes, content.

        The windows are their number, the first one's place and, above these, how far
        before the landmark the bytes begin. Bytes outside the half are zero.
        """
        place, eight, found, owners = self.place, self.eight, [], []
        for right in (True, False):
            split = place[some] - _SIDE
            low = np.maximum(self.low[some], split) if right else self.low[some]
            high = self.high[some] if right else np.minimum(self.high[some], split - 1)
            owner, low, high = some[low <= high], low[low <= high], high[low <= high]
            before = _SIDE if right else _BESIDE
            base = place[owner] - before
            near = place[owner] - (0 if right else _SIDE)
            words = [eight[near + k] for k in _steps(GRAM + _SIDE)]
            at = base[:, None] + np.arange(8 * _HALF)
            inside = (at >= low[:, None]) & (at < high[:, None] + WIDTH)
            body = np.where(inside, self.data[np.clip(at, 0, len(self.data) - 1)], 0).astype(np.uint8)
            counts = (before << 16 | (low - base) << 8 | (high - low + 1)).astype(_U)
            key = _chained(np.full(len(owner), right, _U), *words) & _COARSE
            found.append(np.column_stack([key, counts, body.view(">u8").astype(_U), self.content[owner]]))
            owners.append(owner)
        return np.concatenate(found), np.concatenate(owners)


def _parts(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, bytes]], list[int]]]:
    """((row, text) pairs of about ``PART`` bytes, where each begins in its row); parts of a long text overlap by a window."""
    held, begins, total = [], [], 0
    for row, raw in enumerate(texts):
        for at in range(0, max(len(raw) - WIDTH + 1, 1), PART):
            part = raw[at : at + PART + WIDTH - 1]
            if held and total + len(part) > PART:
                yield held, begins
                held, begins, total = [], [], 0
            held.append((row, part))
            begins.append(at)
            total += len(part)
    if held:
        yield held, begins


def radix(digits: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, group of each row) of the rows whose digits all agree with a row of another document.

    One pass for each column; groups of one document leave after each. Rows of a group
    are neighbours.
    """
    alive, group = np.arange(len(docs)), np.zeros(len(docs), np.int64)
    for column in digits.T:
        order = np.lexsort((column[alive], group))
        alive, group = alive[order], group[order]
        key = column[alive]
        head = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])]
        first = np.flatnonzero(head)
        group = np.cumsum(head) - 1
        here = docs[alive]
        stay = (np.minimum.reduceat(here, first) < np.maximum.reduceat(here, first))[group] if len(here) else head[:0]
        alive, group = alive[stay], group[stay]
        if not len(alive):
            break
    return alive, group


def _owners(digits: np.ndarray, docs: np.ndarray, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the smallest document among those that agree in the first ``keys`` digits, rows of the others).

    Rows that repeat are left out.
    """
    order = np.lexsort((*digits.T[keys:], docs, *digits.T[keys - 1 :: -1]))
    digits, docs = digits[order], docs[order]
    other = digits[1:] != digits[:-1]
    head = np.r_[True, other[:, :keys].any(axis=1)][: len(docs)]
    new = np.r_[True, other.any(axis=1) | (docs[1:] != docs[:-1])][: len(docs)]
    owner = docs[head][np.cumsum(head) - 1]
    return order[new & (docs == owner)], order[new & (docs > owner)]


#: Settled rows that go to one shard.
_SETTLED = 1 << 12
_DEALT = "shard int, settled boolean, digits binary, docs binary"
_DEALT_SCHEMA = pa.schema([("shard", pa.int32()), ("settled", pa.bool_()), ("digits", pa.binary()), ("docs", pa.binary())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _packed(numbers: np.ndarray, columns: int) -> bytes:
    """Compressed, with all first bytes of the first ``columns`` columns, then all second ones, and so on before the rest."""
    planes = np.ascontiguousarray(numbers[:, :columns]).view(np.uint8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes + numbers[:, columns:].tobytes())


def _unpacked(packed: list[bytes], columns: int, width: int) -> np.ndarray:
    tool, found = zstandard.ZstdDecompressor(), []
    for raw in map(tool.decompress, packed):
        n = len(raw) // (8 * width)
        planes = np.frombuffer(raw, np.uint8, 8 * columns * n).reshape(8 * columns, n).T
        rest = np.frombuffer(raw, _U, offset=8 * columns * n).reshape(n, width - columns)
        found.append(np.column_stack([np.ascontiguousarray(planes).view(_U), rest]))
    return np.concatenate(found)


def _even(shards: int) -> np.ndarray:
    """First digits at which the shards after the first begin, where digits are hashes."""
    return np.array([(k << 64) // shards for k in range(1, shards)], _U)


def _quantiles(shards: int) -> np.ndarray:
    """As :func:`_even` where digits are landmarks.

    With hashes from 0 to 1 and n grams in a window, a share of (1 - x)^n (1 + (n - 1) x / 2)
    of the landmarks is above x. Found once, on the driver: tasks have to agree to the last bit.
    """
    n, above = WIDTH - GRAM + 1, 1 - np.arange(1, shards) / shards
    low, high = np.zeros(shards - 1), np.ones(shards - 1)
    for _ in range(60):
        x = (low + high) / 2
        beyond = (1 - x) ** n * (1 + (n - 1) * x / 2) > above
        low, high = np.where(beyond, x, low), np.where(beyond, high, x)
    return (low * 2.0**64).astype(_U)


def _dealt(digits: np.ndarray, docs: np.ndarray, keys: int, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of a batch by shard, in order of the first digit: what is open goes by ranges of it, what is settled anywhere."""
    shards = len(begins) + 1
    open_, settled = _owners(digits, docs, keys)
    at = np.searchsorted(begins, digits[open_, 0], "right")
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
    groups = [(int(at[a]), False, open_[a:b]) for a, b in zip(first, np.append(first[1:], len(at)))]
    for a in range(0, len(settled), _SETTLED):
        some = settled[a : a + _SETTLED]
        spread = _mix(docs[some[:1]].view(_U) + digits[some[:1], 0])
        groups.append((int(spread[0] % _U(shards)), True, some))
    if groups:
        pairs = [(docs[some, None].view(_U), digits[some]) for _, _, some in groups]
        columns = [(_packed(d, 1), _packed(x, 2)) for d, x in pairs]
        yield _rows([(k, done, x, d) for (k, done, _), (d, x) in zip(groups, columns)], _DEALT_SCHEMA)


#: Compressed digits and documents of some rows.
_Pack = tuple[pa.Buffer, pa.Buffer]


def _packs(table: pa.Table) -> tuple[list[_Pack], list[_Pack]]:
    """(open, settled) rows of a shard."""
    found = [], []
    for done, digits, docs in zip(table["settled"], table["digits"], table["docs"]):
        found[done.as_py()].append((digits.as_buffer(), docs.as_buffer()))
    return found


def _arrays(packs: list[_Pack], columns: int) -> tuple[np.ndarray, np.ndarray]:
    """(digits, documents)."""
    return _unpacked([x for x, _ in packs], 2, columns), _unpacked([d for _, d in packs], 1, 1)[:, 0].view(np.int64)


def _ranges(packs: list[_Pack], columns: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(digits, documents) of open rows, one range of the first digit after another, of about ``SLICE`` rows each.

    Rows that agree in the first digit come together, however many they are.
    """
    parts = -(-sum(zstandard.frame_content_size(d) for _, d in packs) // (8 * SLICE))
    if parts < 2:
        if packs:
            yield _arrays(packs, columns)
        return
    some = np.sort(np.concatenate([_unpacked([x], 2, columns)[::8, 0] for x, _ in packs]))
    edges = np.unique(some[np.arange(1, parts) * len(some) // parts])
    for k in range(len(edges) + 1):
        found = []
        for pack in packs:
            digits, docs = _arrays([pack], columns)
            place = np.r_[0, np.searchsorted(digits[:, 0], edges), len(docs)]
            if place[k] < place[k + 1]:
                found.append((digits[place[k] : place[k + 1]].copy(), docs[place[k] : place[k + 1]].copy()))
        if found:
            digits, docs = map(np.concatenate, zip(*found))
            del found
            yield digits, docs


#: ``mask`` has a bit for each window that is covered, by its distance from the landmark.
_MARK = "doc long, content long, mask long"
_MARKS = "array<struct<content: bigint, mask: bigint>>"
#: All windows of a stretch; none yet.
_COVERED, _ASKED = -1, 0


def _marked(parts: list[tuple]) -> pa.Table:
    docs, contents, masks = (np.concatenate(x) for x in zip(*parts))
    columns = [pa.array(docs), pa.array(contents.view(np.int64)), pa.array(masks)]
    return pa.Table.from_arrays(columns, ["doc", "content", "mask"])


def _first_digits(begins: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, BATCH):
            docs, digits, owners = batch.column(0).to_numpy(), [], []
            for texts, _ in _parts([raw or b"" for raw in raw_texts(batch.column(1))]):
                found = Stretches(texts)
                digits.append(np.stack([found.landmark, found.content], axis=1))
                owners.append(docs[found.rows])
            if digits:
                yield from _dealt(np.concatenate(digits), np.concatenate(owners), 2, begins)

    return run


def _stretch_marks(table: pa.Table) -> pa.Table:
    """Covered stretches, and those whose windows have to be looked at."""
    parts, (open_, settled) = [], _packs(table)
    for pack in settled:
        digits, docs = _arrays([pack], 2)
        parts.append((docs, digits[:, 1], np.full(len(docs), _COVERED)))
    for digits, docs in _ranges(open_, 2):
        alive, group = radix(digits[:, :1], docs)
        here, content = docs[alive], digits[alive, 1]
        order = np.lexsort((here, content, group))
        here, group, content = here[order], group[order], content[order]
        head = np.r_[True, (group[1:] != group[:-1]) | (content[1:] != content[:-1])][: len(group)]
        owner = here[head][np.cumsum(head) - 1]
        several = np.bincount(group[head], minlength=1) > 1
        asked = head & several[group]
        for some, mask in ((here > owner, _COVERED), (asked, _ASKED)):
            parts.append((here[some], content[some], np.full(some.sum(), mask)))
    return _marked(parts)


def _masks(found: Stretches, lists: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """(whether its row has marks for it, all of them joined) for each stretch."""
    rows = np.concatenate([pc.list_parent_indices(x).to_numpy() for x in lists])
    contents, masks = (np.concatenate([x.flatten().field(c).to_numpy() for x in lists]) for c in ("content", "mask"))
    if not len(rows) or not len(found.rows):
        return np.zeros(len(found.rows), bool), np.zeros(len(found.rows), np.int64)
    contents = contents.view(_U)
    names = np.unique(contents)
    pairs = rows * len(names) + np.searchsorted(names, contents)
    order = np.argsort(pairs)
    pairs, masks = pairs[order], masks[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    pairs, masks = pairs[first], np.bitwise_or.reduceat(masks, first)
    name = np.minimum(np.searchsorted(names, found.content), len(names) - 1)
    mine = found.rows * len(names) + name
    at = np.minimum(np.searchsorted(pairs, mine), len(pairs) - 1)
    hit = (names[name] == found.content) & (pairs[at] == mine)
    return hit, np.where(hit, masks[at], 0)


def _copied(column: pa.Array) -> pa.Array:
    """The column without what its offsets leave out."""
    return pa.concat_arrays([column])


def _last_digits(begins: np.ndarray):
    """Texts with marks to the halves of the stretches that are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, BATCH):
            docs, marks, digits, owners = batch.column(0).to_numpy(), _copied(batch.column(2)), [], []
            for texts, _ in _parts([raw or b"" for raw in raw_texts(batch.column(1))]):
                found = Stretches(texts)
                hit, masks = _masks(found, [marks])
                some = np.flatnonzero(hit & (masks == _ASKED))
                if len(some):
                    halves, owner = found.halves(some)
                    digits.append(halves)
                    owners.append(docs[found.rows[owner]])
            if digits:
                yield from _dealt(np.concatenate(digits), np.concatenate(owners), 2 + _HALF, begins)

    return run


def _opened(halves: np.ndarray, begin: int = 0, end: int = 8 * _HALF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(half, first byte, bit of the mask) of each window of the halves whose first byte is in a range."""
    before, first, count = (((halves[:, 1] >> _U(k)) & _U(255)).astype(np.int64) for k in (16, 8, 0))
    low, high = np.maximum(first, begin), np.minimum(first + count, end)
    count = np.maximum(high - low, 0)
    half = np.repeat(np.arange(len(halves)), count)
    at = low[half] + np.arange(len(half)) - np.repeat(np.cumsum(count) - count, count)
    return half, at, np.left_shift(1, before[half] - at)


def _joined(bits: np.ndarray, half: np.ndarray, halves: int) -> np.ndarray:
    """Masks of so many halves from the bits of windows."""
    masks = np.zeros(halves, np.int64)
    np.bitwise_or.at(masks, half, bits)
    return masks


def _repeated(halves: np.ndarray, docs: np.ndarray, group: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Masks of the windows, first byte in a range, that a smaller document of the group has."""
    half, at, bits = _opened(halves, begin, end)
    body = np.ascontiguousarray(halves[:, 2:-1].astype(">u8")).view(np.uint8).reshape(len(halves), 8 * _HALF)
    padded = np.zeros((len(half), 8 * _EIGHT), np.uint8)
    padded[:, :WIDTH] = np.lib.stride_tricks.sliding_window_view(body, WIDTH, axis=1)[half, at]
    columns = np.column_stack([group[half].astype(_U), at.astype(_U), padded.view(">u8").astype(_U)])
    rows, group = radix(columns, docs[half])
    here = docs[half[rows]]
    head = np.r_[True, group[1:] != group[:-1]][: len(group)]
    low = here if not len(here) else np.minimum.reduceat(here, np.flatnonzero(head))[np.cumsum(head) - 1]
    gone = rows[here > low]
    return _joined(bits[gone], half[gone], len(halves))


def _window_marks(table: pa.Table) -> pa.Table:
    """Covered windows, as masks of their stretches."""
    parts, (open_, settled) = [], _packs(table)
    for pack in settled:
        halves, docs = _arrays([pack], 3 + _HALF)
        half, _, bits = _opened(halves)
        parts.append((docs, halves[:, -1], _joined(bits, half, len(halves))))
    for halves, docs in _ranges(open_, 3 + _HALF):
        alive, group = radix(halves[:, :1], docs)
        halves, docs = halves[alive], docs[alive]
        masks, ends = np.zeros(len(docs), np.int64), np.cumsum(halves[:, 1] & _U(255)).astype(np.int64)
        # runs of groups with about SLICE windows; in a group of very many, one first byte at a time
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
        run = np.r_[0, ends][first] // SLICE
        cuts = [*first[np.r_[True, run[1:] != run[:-1]][: len(run)]].tolist(), len(docs)]
        for a, b in zip(cuts, cuts[1:]):
            small = ends[b - 1] - ends[a] < 2 * SLICE
            for begin in range(0, 1 if small else 8 * _HALF - WIDTH + 1):
                masks[a:b] |= _repeated(halves[a:b], docs[a:b], group[a:b], begin, 8 * _HALF if small else begin + 1)
        some = masks != 0
        parts.append((docs[some], halves[some, -1], masks[some]))
    return _marked(parts)


def _gone(raws: list[bytes], lists: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end) of the maximal runs of covered bytes."""
    base = np.cumsum([0, *(len(r) + 1 for r in raws)])  # a byte between rows that nothing covers
    steps = np.zeros(base[-1] + 1, np.int32)
    for texts, begins in _parts(raws):
        found = Stretches(texts)
        _, masks = _masks(found, lists)
        shift = base[[r for r, _ in texts]] + np.array(begins, np.int64) - found.begin
        whole = masks == _COVERED
        places, owner = found.windows(np.flatnonzero(~whole & (masks != 0)))
        some = masks[owner] >> (found.place[owner] - places) & 1 > 0
        places, owner = places[some], owner[some]
        low = np.r_[found.low[whole] + shift[found.text[whole]], places + shift[found.text[owner]]]
        high = np.r_[found.high[whole] + shift[found.text[whole]], places + shift[found.text[owner]]] + WIDTH
        np.add.at(steps, low, 1)
        np.add.at(steps, high, -1)
    edges = np.diff((np.cumsum(steps) > 0).astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    row = np.searchsorted(base, begin, "right") - 1
    return row, begin - base[row], end - base[row]


def _rest(id_col: str):
    numbers = [(name, pa.int64()) for name in (id_col, "n_bytes", "n_removed", "n_spans")]
    schema = pa.schema([*numbers, ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, BATCH):
            raws, lists = [r or b"" for r in raw_texts(batch.column(1))], [_copied(batch.column(k)) for k in (2, 3)]
            # texts without marks need no second look
            row, begin, end = _gone([r if n else b"" for r, n in zip(raws, pc.list_value_length(lists[0]).to_pylist())], lists)
            bounds = np.searchsorted(row, np.arange(len(raws) + 1)).tolist()
            rows = []
            for k, (doc, raw) in enumerate(zip(batch.column(0).to_pylist(), raws)):
                a, b = bounds[k], bounds[k + 1]
                kept = raw
                if a < b:
                    kept = b"".join(raw[x:y] for x, y in zip([0, *end[a:b].tolist()], [*begin[a:b].tolist(), len(raw)]))
                rows.append((doc, len(raw), len(raw) - len(kept), b - a, hashlib.sha256(kept).hexdigest(), kept))
            yield _rows(rows, schema)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary).

    A byte goes if a string of ``WIDTH`` bytes that covers it also starts in a document
    with a smaller id; ``n_spans`` counts the maximal runs that go. Strings are judged on
    the input and do not cross documents. What is kept need not be valid UTF-8. NULL and
    empty texts have no bytes, texts below ``WIDTH`` stay whole. Rows with a NULL id
    neither lose bytes nor take any from others. Rows that share an id are one document
    of several texts, and not smaller than each other. An empty table gives an empty
    result. Only the two named columns are read.
    """
    shards = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").cast("binary").alias("text"))
    named = rows.where("doc IS NOT NULL")
    dealt = named.mapInArrow(_first_digits(_quantiles(shards)), _DEALT)
    marks = dealt.groupBy("shard").applyInArrow(_stretch_marks, _MARK)
    marks = marks.groupBy("doc").agg(F.collect_list(F.struct("content", "mask")).alias("marks"))
    texts = named.join(marks, "doc", "left")
    asked = texts.where("marks IS NOT NULL").select("doc", "text", "marks")
    dealt = asked.mapInArrow(_last_digits(_even(shards)), _DEALT)
    seen = dealt.groupBy("shard").applyInArrow(_window_marks, _MARK)
    windows = seen.groupBy("doc").agg(F.collect_list(F.struct("content", "mask")).alias("windows"))
    joined = texts.join(windows, "doc", "left").select("doc", "text", "marks", "windows")
    none = F.array().cast(_MARKS)
    nameless = rows.where("doc IS NULL").select("*", none.alias("marks"), none.alias("windows"))
    lists = joined.union(nameless).select("doc", "text", F.coalesce("marks", none), F.coalesce("windows", none))
    columns = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return lists.mapInArrow(_rest(id_col), columns)
