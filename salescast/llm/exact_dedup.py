"""Exact deduplication with radix tries as owners of texts.

Rows are keyed by the length and a content hash of the normalised text. Map
tasks insert the full byte strings into a radix trie whose terminal nodes hold
the smallest document identifier and a count, and so collapse copies before
the shuffle. The shuffle deals by (length, hash); each reducer reads its
partition in that order and inserts again, so equality is always decided by
all bytes and never by a hash.

A trie above its memory budget spills its largest subtree: in a map task the
subtree's terminals leave as partial owners, which the reducer merges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import normalised, raw_texts, slices, unpacked, whole_row

#: Bytes of text that one trie may hold before it spills a subtree.
TRIE_BYTES = 64 << 20


def normal_bytes(raw: bytes | None) -> bytes:
    """The normalised text in UTF-8, as :func:`salescast.llm.text.normalised`."""
    if not raw:
        return b""
    parts = raw.split()
    if not parts:
        return b" "
    text = b" ".join(parts)
    if raw[:1].isspace():
        text = b" " + text
    return text + b" " if raw[-1:].isspace() else text


class _Node:
    __slots__ = ("children", "count", "edge", "owner")

    def __init__(self, edge: bytes, owner=None, count: int = 0):
        self.edge, self.owner, self.count, self.children = edge, owner, count, {}


class RadixTrie:
    """A compressed trie from byte strings to (smallest identifier, rows)."""

    def __init__(self):
        self.root = _Node(b"")
        self.sizes: dict[int, int] = {}

    @property
    def size(self) -> int:
        return sum(self.sizes.values())

    def insert(self, key: bytes, owner, count: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                self.sizes[key[0]] = self.sizes.get(key[0], 0) + len(key) - at
                node, at = child, len(key)
                break
            edge = child.edge
            if key.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            same = _common(edge, key, at)
            middle = _Node(edge[:same])
            child.edge = edge[same:]
            middle.children[edge[same]] = child
            node.children[key[at]] = middle
            node, at = middle, at + same
        if node.count == 0 or node.owner is None or (owner is not None and owner < node.owner):
            node.owner = owner
        node.count += count

    def spill(self) -> Iterator[tuple[bytes, object, int]]:
        """Take out the largest subtree below the root; its terminals."""
        first = max(self.sizes, key=self.sizes.get)
        del self.sizes[first]
        yield from _terminals(self.root.children.pop(first), b"")

    def drain(self) -> Iterator[tuple[bytes, object, int]]:
        """All terminals; the trie is empty afterwards."""
        root, self.root, self.sizes = self.root, _Node(b""), {}
        yield from _terminals(root, b"")


def _common(edge: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``edge`` and ``key[at:]``, by halving."""
    low, high = 0, min(len(edge), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if edge[low:middle] == key[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _terminals(node: _Node, prefix: bytes) -> Iterator[tuple[bytes, object, int]]:
    stack = [(node, prefix)]
    while stack:
        node, prefix = stack.pop()
        key = prefix + node.edge
        if node.count:
            yield key, node.owner, node.count
        stack.extend((child, key) for child in node.children.values())


_PARTIAL = pa.schema(
    [("length", pa.int64()), ("hash", pa.int64()), ("text", pa.binary()), ("owner", pa.int64()), ("rows", pa.int64())]
)
_OWNER = pa.schema([("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _partials(terminals) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for text, owner, count in terminals:
        rows.append((len(text), xxhash.xxh3_64_intdigest(text) - (1 << 63), text, owner, count))
        size += len(text)
        if size > 4 << 20:
            yield _batch(rows, _PARTIAL)
            rows, size = [], 0
    if rows:
        yield _batch(rows, _PARTIAL)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map side: documents to partial owners."""
    trie = RadixTrie()
    for batch in slices(batches, 1):
        for owner, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
            trie.insert(normal_bytes(raw), owner, 1)
        while trie.size > TRIE_BYTES:
            yield from _partials(trie.spill())
    yield from _partials(trie.drain())


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side, in the order of (length, hash): partial owners to owners."""
    trie, bucket, done = RadixTrie(), None, []
    for batch in slices(batches, 2):
        for length, code, text, owner, count in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != (length, code):
                done += [(hashlib.sha256(t).hexdigest(), o, n) for t, o, n in trie.drain() if n > 1]
                bucket = (length, code)
            trie.insert(text, owner, count)
        if done:
            yield _batch(done, _OWNER)
            done = []
    done = [(hashlib.sha256(t).hexdigest(), o, n) for t, o, n in trie.drain() if n > 1]
    if done:
        yield _batch(done, _OWNER)


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text that more than one row has: text_sha256, keep_id, group_size."""
    rows = docs.select(F.col(id_col).cast("long").alias("owner"), F.col(text_col).cast("string").alias("text"))
    partial = rows.mapInArrow(_collapse, "length long, hash long, text binary, owner long, rows long")
    dealt = partial.repartition("length", "hash").sortWithinPartitions("length", "hash")
    return dealt.mapInArrow(_own, "text_sha256 string, keep_id long, group_size long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space has become one
    space. NULL counts as the empty text. Of equal texts the row with the
    smallest id stays; a NULL id stays only if no row of its group has an id.
    Rows that repeat both id and text are each reported; all of them carry the
    verdict of their id, and :func:`deduplicate` leaves one. An empty table gives
    an empty result. Other columns are never read, so their names cannot clash.
    """
    signed = docs.select(
        F.col(id_col).cast("long").alias(id_col),
        F.sha2(normalised(F.col(text_col).cast("string")), 256).alias("text_sha256"),
    )
    joined = signed.join(owners(docs, id_col, text_col), "text_sha256", "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col(id_col)).otherwise(F.col("keep_id"))
    return joined.select(
        id_col,
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col(id_col).eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns, one row of each text.

    NULL and empty texts are one text. The smallest id stays, a row without an id only
    where no row of the text has one; of rows that repeat id and text any one stays. An
    empty table gives an empty result. Other columns may have any names.
    """
    kept = exact_groups(docs.select(id_col, text_col), id_col, text_col)
    kept = kept.where("kept").select(F.col(id_col).alias("_keep_id"), F.col("text_sha256").alias("_keep_sha")).distinct()
    sha = F.sha2(normalised(F.col(text_col).cast("string")), 256)
    rows = docs.select(whole_row(docs), F.col(id_col).cast("long").alias("_row_id"), sha.alias("_row_sha"))
    same = F.col("_row_id").eqNullSafe(F.col("_keep_id")) & (F.col("_row_sha") == F.col("_keep_sha"))
    return unpacked(rows.join(kept, same, "left_semi").dropDuplicates(["_row_id", "_row_sha"]), docs)
