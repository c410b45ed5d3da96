"""Near-duplicate groups by SimHash and meet-in-the-middle ball hashing.

Two fingerprints within radius 3 meet half way. Half of an odd radius is not
whole, and balls of radius 2 have 2081 members, so the odd flip is absorbed by
masking: the 64 bits fall into three blocks, and under each mask one block is
blanked. Of three flips at least one falls into some block; with that block
blanked at most two are left, and the balls of radius 1 around both meet. Every
distinct fingerprint so emits 131 variants, whatever its neighbours are. The
shuffle is on the variant; fingerprints that share one are verified by their
true distance and leave a spanning forest instead of all pairs, which keeps
every connection.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm.components import components
from salescast.llm.text import byte_words, cut, raw_texts, row_key, slices, unpacked, whole_row

SEED = 42
SHINGLE = 3
RADIUS = 3
#: First bit and width of the blocks that are masked in turn.
BLOCKS = ((0, 21), (21, 21), (42, 22))
_STEP = 1 << 16


def fingerprint(raw: bytes | None, width: int = SHINGLE) -> int:
    """SimHash of the shingles of words; a text without words has 0."""
    tokens = byte_words(raw.lower()) if raw else []
    if not tokens:
        return 0
    shingles = [b" ".join(tokens)] if len(tokens) < width else map(b" ".join, zip(*(tokens[k:] for k in range(width))))
    codes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(codes), _STEP):
        part = codes[at : at + _STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(codes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    key: Column | None = None,
) -> DataFrame:
    """(id, fp) of each row, and ``key`` if one is given; ``fp`` is the fingerprint as a signed long."""
    schema = pa.schema([(id_col, pa.int64()), ("fp", pa.int64()), *[("key", pa.string())][: key is not None]])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            codes = np.array([fingerprint(raw, width) for raw in raw_texts(batch.column(1))], np.uint64)
            columns = [batch.column(0), pa.array(codes.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(
        F.col(id_col).cast("long").alias(id_col),
        F.col(text_col).cast("string").alias("text"),
        *([] if key is None else [key.alias("key")]),
    )
    return rows.mapInArrow(signed, f"`{id_col}` long, fp long" + ("" if key is None else ", key string"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def variants(fp: Column) -> Column:
    """Array of the variants of a fingerprint: for each mask the ball of radius 1."""
    pairs = []
    for number, (first, width) in enumerate(BLOCKS):
        block = ((1 << width) - 1) << first
        keep, tag = _signed(~block & ((1 << 64) - 1)), (number + 1) << first
        flips = [0, *(1 << bit for bit in range(64) if not block >> bit & 1)]
        pairs += [fp.bitwiseAND(F.lit(keep)).bitwiseXOR(F.lit(_signed(tag ^ flip))) for flip in flips]
    return F.array(*pairs)


def _distance(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ other)


def _forest(group: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links within the radius that connect what any links connect: a spanning forest."""
    rest = np.unique(group)
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            near = _distance(rest, one) <= radius
            found, rest = rest[near], rest[~near]
            yield from ((one, other) for other in found)
            front.extend(found)


def _link(radius: int):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def emit(a, b):
        arrays = [pa.array(np.asarray(x, np.uint64).view(np.int64)) for x in (a, b)]
        return pa.RecordBatch.from_arrays(arrays, schema=out)

    def groups(keys: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], len(keys)]
        pairs = starts[ends - starts == 2]
        a, b = codes[pairs], codes[pairs + 1]
        near = (_distance(a, b) <= radius) & (a != b)
        if near.any():
            yield emit(a[near], b[near])
        large = np.flatnonzero(ends - starts > 2)
        links = [link for g in large for link in _forest(codes[starts[g] : ends[g]], radius)]
        if links:
            yield emit(*zip(*links))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of their key; a group may span batches."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            codes = batch.column(1).to_numpy().view(np.uint64)
            held.append((keys, codes))
            if keys[0] == keys[-1] and held[0][0][0] == keys[0]:
                continue  # still one group
            keys, codes = (np.concatenate(x) for x in zip(*held))
            last = np.searchsorted(keys, keys[-1])
            yield from groups(keys[:last], codes[:last])
            held = [(keys[last:], codes[last:])]
        if held:
            yield from groups(*(np.concatenate(x) for x in zip(*held)))

    return run


def links(codes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) among the distinct ``fp`` that keep every connection within the radius."""
    if radius > RADIUS:
        raise ValueError(f"the masks cover radii up to {RADIUS}")
    dealt = codes.select("fp").select(F.explode(variants(F.col("fp"))).alias("key"), "fp")
    dealt = dealt.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_link(radius), "a long, b long")


def _rooted(codes: DataFrame, first: str, radius: int) -> DataFrame:
    """(fp, first, root) of the distinct ``fp``; a fingerprint without links is its own root."""
    roots = components(links(codes, radius))
    return codes.join(roots, codes["fp"] == roots["node"], "left").select(
        "fp", first, F.coalesce("root", "fp").alias("root")
    )


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    A-Z are lower-cased, nothing else. NULL and empty texts have fingerprint zero
    and are linked like any other, so they form one group. ``component_id`` is the
    smallest id reachable over links, NULL only if no member has an id. Rows that
    repeat an id each get their row. An empty table gives an empty result. Only
    the two named columns are read.
    """
    marked = cut(fingerprints(docs, id_col, text_col))
    codes = cut(marked.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    rooted = _rooted(codes, "first_id", radius)
    smallest = rooted.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(smallest, rooted["root"] == smallest["r"]).select(F.col("fp").alias("code"), "component_id")
    return marked.join(labels, marked["fp"] == labels["code"]).select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: one row of each group.

    It is the row with the smallest id, without an id only if no row of the group
    has one; of several the smallest digest of the text decides. Rows are matched
    by id and text, so an id used again elsewhere is no matter. NULL and empty texts
    are near each other. An empty table gives an empty result. Other columns may have
    any names.
    """
    key = row_key(F.col(text_col), F.col(id_col))
    marked = fingerprints(docs, id_col, text_col, key=key)
    first = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "key")
    codes = cut(marked.groupBy("fp").agg(F.min(first).alias("first")))
    kept = _rooted(codes, "first", RADIUS).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.key").alias("_kept_key"))
    rows = docs.select(whole_row(docs), key.alias("_row_key"))
    rows = rows.join(kept, F.col("_row_key") == F.col("_kept_key"), "left_semi")
    return unpacked(rows.dropDuplicates(["_row_key"]), docs)
