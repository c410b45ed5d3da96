"""Removal of passages that an earlier document has, found by recompression.

Words become 64-bit names. A round of recompression first replaces runs of one
symbol by a symbol for the run, then every pair of neighbours whose first symbol
falls into the left half of the alphabet and whose second into the right half
(by a bit of their names). A new symbol's name is a hash of what it replaces, so
every task in the cluster gives equal runs and pairs the same name, and equal
stretches of words get the same interior symbols wherever they stand.

Which symbols are interior is kept exactly: each carries the span of words that
decided it. A span that lies in a window decides the same symbol in every
document that has the window. Each window of 50 words picks as its anchor,
among the symbols of the highest level whose span it contains, the one whose span
has the smallest hash (at level 0 every word qualifies, so there always is one). Equal
windows pick equal anchors.

Consecutive windows with one anchor form a stretch. Stretches, one per dozens of
words, are what is shuffled:

1. Anchors that occur in one document only are dropped.
2. Stretches with the same anchor and the same words are one class. Members of a
   class beyond its smallest document are covered entirely.
3. Where an anchor has several classes, the smallest document of each class
   emits its windows one by one; a window is covered if a smaller document has
   it too.

Equality of stretches and windows is decided by 128-bit hashes of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import byte_words, raw_texts, slices, stored

WINDOW = 50
#: Rounds of recompression; the spans of three rounds are about 11 words on average.
ROUNDS = 3

_FAR = 1 << 40
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of a 64-bit name."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _join(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return _mix(_mix(a + _U(salt)) * _U(0x9E3779B97F4A7C15) + b)


class Level:
    """Symbols of one level: names, documents, and the spans ``low`` to ``high`` of words that decide them."""

    def __init__(self, names, docs, low, high):
        self.names, self.docs, self.low, self.high = names, docs, low, high


def _merged(level: Level, head: np.ndarray, names: np.ndarray) -> Level:
    """The symbols that begin at ``head``; each is decided by its parts and both neighbours."""
    first = np.flatnonzero(head)
    last = np.r_[first[1:], len(head)] - 1
    docs = level.docs[first]
    before, after = np.maximum(first - 1, 0), np.minimum(last + 1, len(head) - 1)
    edge_low = (first == 0) | (level.docs[before] != docs)
    edge_high = (last == len(head) - 1) | (level.docs[after] != docs)
    # at the edge of a document the neighbour is missing: no window decides the symbol
    low = np.where(edge_low, -_FAR, np.minimum(level.low[before], level.low[first]))
    high = np.where(edge_high, _FAR, np.maximum(level.high[after], level.high[last]))
    return Level(names, docs, low, high)


def _runs(level: Level) -> Level:
    same = (level.names[1:] == level.names[:-1]) & (level.docs[1:] == level.docs[:-1])
    head = np.r_[True, ~same]
    first = np.flatnonzero(head)
    length = np.diff(np.r_[first, len(head)])
    names = level.names[first]
    return _merged(level, head, np.where(length > 1, _join(names, length.astype(_U), 1), names))


def _pairs(level: Level, turn: int) -> Level:
    right = (_mix(level.names + _U(turn)) & _U(1)).astype(bool)
    joined = ~right[:-1] & right[1:] & (level.docs[1:] == level.docs[:-1])
    head = np.r_[True, ~joined]
    first = np.flatnonzero(head)
    names = level.names[first]
    paired = np.diff(np.r_[first, len(head)]) > 1
    names[paired] = _join(names[paired], level.names[first[paired] + 1], 2 + turn)
    return _merged(level, head, names)


def recompress(names: np.ndarray, docs: np.ndarray, rounds: int = ROUNDS) -> list[Level]:
    """The levels of a batch of documents, words first."""
    at = np.arange(len(names), dtype=np.int64)
    levels = [Level(names, docs, at, at + 1)]
    for turn in range(rounds):
        levels.append(_pairs(_runs(levels[-1]), turn))
    return levels


_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))


class Spans:
    """Hashes of spans of words by differences of one running sum."""

    def __init__(self, names: np.ndarray):
        n = len(names) + 1
        self.sums = np.concatenate([[_U(0)], np.cumsum(names * np.cumprod(np.full(n - 1, _BASE)))])
        self.back = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, _INVERSE)]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return _mix((self.sums[high] - self.sums[low]) * self.back[low] + (high - low).astype(_U))


def _smallest(low: np.ndarray, high: np.ndarray, names: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """For each window: index of the smallest name whose span it contains, or -1."""
    if not len(names):
        return np.full(len(starts), -1)
    first = np.searchsorted(low, starts, "left")
    after = np.searchsorted(high, starts + width, "right")
    # rank by name, then by place: the minimum of a range as a table of powers of two
    order = np.lexsort((np.arange(len(names)), names))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    size = after - first
    result = np.full(len(starts), -1, np.int64)
    table, power = rank, 0
    while True:
        here = (size >= 1 << power) & (size < 2 << power)
        if here.any():
            a, b = first[here], after[here] - (1 << power)
            result[here] = order[np.minimum(table[a], table[b])]
        if not (size >= 2 << power).any():
            return result
        table = np.minimum(table[: len(table) - (1 << power)], table[1 << power :])
        power += 1


def anchors(levels: list[Level], starts: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(name, identity) of each window's anchor; identities differ between occurrences.

    An anchor is named by all words of its span, so it is as rare as they are.
    """
    span_name = Spans(levels[0].names)
    names = np.zeros(len(starts), _U)
    identity = np.full(len(starts), -1, np.int64)
    open_ = np.arange(len(starts))
    for number in range(len(levels) - 1, -1, -1):
        if not len(open_):
            break
        level = levels[number]
        usable = np.flatnonzero((level.low >= 0) & (level.high < _FAR))
        low, high = level.low[usable], level.high[usable]
        of_spans = span_name(low, high)
        found = _smallest(low, high, of_spans, starts[open_], width)
        hit = found >= 0
        names[open_[hit]] = of_spans[found[hit]]
        identity[open_[hit]] = usable[found[hit]] * len(levels) + number
        open_ = open_[~hit]
    return names, identity


def _word_names(batch: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words of a batch, and the first word of each document (and the end)."""
    tokens = [byte_words(raw) for raw in batch]
    bounds = np.cumsum([0, *map(len, tokens)])
    names = np.fromiter((xxhash.xxh3_64_intdigest(w) for t in tokens for w in t), _U, bounds[-1])
    return names, bounds


def _window_starts(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the batch where a window fits into its document, and the documents."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    docs = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts)
    return bounds[docs] + inside, docs


_STRETCH = "doc long, body long, lows array<int>, span int, anchor long, content long"
_SEEN = "doc long, body long, places array<int>, w1 long, w2 long"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}


def _record(schema: str, columns: list) -> pa.RecordBatch:
    fields = [part.split() for part in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, _TYPES[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _lists(values: np.ndarray, group: np.ndarray) -> pa.ListArray:
    """Values by group number, in their order, as one list for each group."""
    order = np.argsort(group, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(group))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values[order].astype(np.int32)))


def _stretches(width: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 4 << 20):
            texts = raw_texts(batch.column(2))
            names, bounds = _word_names(texts)
            starts, docs = _window_starts(bounds, width)
            if not len(starts):
                continue
            levels = recompress(names, np.repeat(np.arange(len(texts)), np.diff(bounds)), rounds)
            anchor, identity = anchors(levels, starts, width)
            head = np.r_[True, (identity[1:] != identity[:-1]) | (docs[1:] != docs[:-1])]
            first = np.flatnonzero(head)
            last = np.r_[first[1:], len(head)] - 1
            view = memoryview(names.tobytes())
            spans = zip((8 * starts[first]).tolist(), (8 * (starts[last] + width)).tolist())
            content = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in spans), _U, len(first))
            # equal stretches of one document, as a run of one word has them, are one row
            keys = _join(content, docs[first].astype(_U), 7)
            _, one, group = np.unique(keys, return_index=True, return_inverse=True)
            lows = _lists(starts[first] - bounds[docs[first]], group)
            first, last, content = first[one], last[one], content[one]
            ids, bodies = (batch.column(k).to_numpy()[docs[first]] for k in (0, 1))
            yield _record(_STRETCH, [ids, bodies, lows, last - first, anchor[first].view(np.int64), content.view(np.int64)])

    return run


def _windows(width: int):
    """Texts with lists of stretches to the windows in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 4 << 20):
            for doc, body, raw, spans in zip(*(c.to_pylist() for c in batch.columns)):
                names, _ = _word_names([raw])
                view = memoryview(names.tobytes())
                places: dict[bytes, list[int]] = {}
                for p in sorted({p for s in spans for low in s["lows"] for p in range(low, low + s["span"] + 1)}):
                    places.setdefault(xxhash.xxh3_128_digest(view[8 * p : 8 * (p + width)]), []).append(p)
                halves = np.frombuffer(b"".join(places), np.int64).reshape(-1, 2)
                n = len(places)
                yield _record(_SEEN, [[doc] * n, [body] * n, list(places.values()), halves[:, 0], halves[:, 1]])

    return run


def _rest(width: int, id_col: str):
    numbers = [(name, pa.int64()) for name in (id_col, "n_words", "n_removed")]
    schema = pa.schema([*numbers, ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows = []
            for doc, raw, spans in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), batch.column(2).to_pylist()):
                tokens = byte_words(raw)
                steps = np.zeros(len(tokens) + 1, np.int64)
                for span in spans or ():
                    for low in span["lows"]:
                        steps[low] += 1
                        steps[low + span["span"] + width] -= 1
                gone = np.cumsum(steps)[:-1] > 0
                kept = b" ".join(w for w, g in zip(tokens, gone.tolist()) if not g) if spans else b" ".join(tokens)
                rows.append((doc, len(tokens), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, body, text); ``body`` tells rows that share an id apart."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("body"), text.alias("text"))


def _covered(rows: DataFrame, width: int, rounds: int) -> DataFrame:
    """(doc, body, lows, span): from each of ``lows``, that window and the next ``span`` also start in a smaller document."""
    rows = rows.where("doc IS NOT NULL")
    found = stored(rows.mapInArrow(_stretches(width, rounds), _STRETCH))
    shared = found.groupBy("anchor").agg(F.min("doc").alias("d0"), F.max("doc").alias("d1")).where("d0 < d1")
    found = found.join(shared.select("anchor"), "anchor", "left_semi")
    key = ["anchor", "content"]
    classes = found.groupBy(*key).agg(F.min("doc").alias("owner"))
    owned = stored(found.join(classes, key))
    whole = owned.where("owner < doc").select("doc", "body", "lows", "span")
    alone = owned.where("owner = doc")
    several = alone.groupBy("anchor").agg(F.min("content").alias("c0"), F.max("content").alias("c1")).where("c0 < c1")
    asked = alone.join(several.select("anchor"), "anchor", "left_semi")
    asked = asked.groupBy("doc", "body").agg(F.collect_list(F.struct("lows", "span")).alias("spans"))
    texts = rows.join(asked, ["doc", "body"]).select("doc", "body", F.col("text").cast("binary").alias("raw"), "spans")
    seen = stored(texts.mapInArrow(_windows(width), _SEEN))
    first = seen.groupBy("w1", "w2").agg(F.min("doc").alias("d0"), F.max("doc").alias("d1")).where("d0 < d1")
    single = seen.join(first, ["w1", "w2"]).where("d0 < doc")
    return whole.union(single.select("doc", "body", "places", F.lit(0)))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, rounds: int = ROUNDS
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256, kept_text.

    A word goes if a window of ``width`` words that covers it also starts in a
    document with a smaller id. Windows are judged on the input. NULL and empty
    texts have no words. Texts shorter than a window stay whole. Rows with a NULL
    id neither lose words nor take any from others. Rows that share an id are not
    smaller than each other; each is judged by its own text. An empty table gives
    an empty result. Only the two named columns are read.
    """
    rows = _rows(docs, id_col, text_col)
    spans = _covered(rows, width, rounds).groupBy("doc", "body").agg(F.collect_list(F.struct("lows", "span")).alias("spans"))
    joined = rows.join(spans, ["doc", "body"], "left").select("doc", "text", "spans")
    columns = f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return joined.mapInArrow(_rest(width, id_col), columns)
