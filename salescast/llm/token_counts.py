"""Token counts of the sections of a document.

A document is encoded once, as a whole. The tokens' byte lengths give their
offsets, and sections are joined with them by interval: with sorted bounds both
ends of a section are found by binary search. Two rules allocate the tokens that
cross a boundary. ``n_tokens`` gives a token to every section that holds its
first byte, so sections that partition a text add up to its tokens. ``share``
splits a token by bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import raw_texts, slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pattern that cuts a text into pieces for this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_FIELDS = [
    ("section", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("n_tokens", pa.int64()),
    ("share", pa.float64()), ("n_crossing", pa.int64()), ("doc_tokens", pa.int64()),
]


class Encoder:
    """A byte-level BPE encoder that knows the byte length of every token."""

    def __init__(self, vocabulary: str, pattern: str):
        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def bounds(self, text: str) -> np.ndarray:
        """Byte offsets of the tokens, with the end of the text."""
        ids = np.asarray(self.encoding.encode_to_numpy(text, disallowed_special=()))
        return np.concatenate([[0], np.cumsum(self.lengths[ids])])


def line_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each line; a line holds its line feed. At least one line."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    if not len(ends) or ends[-1] != len(raw):
        ends = np.append(ends, len(raw))
    return np.concatenate([[0], ends[:-1]]), ends


def allocate(bounds: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens that begin inside, share by bytes, tokens that reach over an end) of each section."""
    first = np.searchsorted(bounds[:-1], low, "left")
    after = np.searchsorted(bounds[:-1], high, "left")
    places = np.arange(len(bounds), dtype=float)
    share = np.interp(high, bounds, places) - np.interp(low, bounds, places)
    inside = np.maximum(np.searchsorted(bounds[1:], high, "right") - first, 0)
    touched = after - (np.searchsorted(bounds[1:], low, "right"))
    return after - first, share, np.where(high > low, touched - inside, 0)


def _count(vocabulary: str, pattern: str, id_field: pa.Field, given: bool):
    schema = pa.schema([id_field, *_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, pattern)
        for batch in slices(batches, 1):
            parts = []
            sections = batch.column(2).to_pylist() if given else [None] * batch.num_rows
            for row, (raw, spans) in enumerate(zip(raw_texts(batch.column(1)), sections)):
                raw = raw or b""
                leads = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
                chars = np.concatenate([[0], leads])  # characters that begin before each byte
                bounds = encoder.bounds(raw.decode())
                if given:
                    at = np.append(np.flatnonzero(np.diff(chars)), len(raw))  # first byte of each character
                    spans = sorted(spans or (), key=lambda s: s["section"])
                    number = np.array([s["section"] for s in spans], np.int64)
                    start, end = (np.clip([s[k] for s in spans], 0, len(at) - 1).astype(np.int64) for k in ("start", "end"))
                    end = np.maximum(start, end)
                    low, high = at[start], at[end]
                else:
                    low, high = line_bounds(raw)
                    number, start, end = np.arange(len(low)), chars[low], chars[high]
                n, share, crossing = allocate(bounds, low, high)
                total = np.full(len(low), len(bounds) - 1)
                parts.append((np.full(len(low), row), number, start, end, n, share, crossing, total))
            if not parts:
                continue
            rows, *columns = (np.concatenate(c) for c in zip(*parts))
            arrays = [batch.column(0).take(pa.array(rows.astype(np.int64)))]
            arrays += [pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, list(schema)[1:])]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def token_counts(
    docs: DataFrame,
    sections: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """One row per section: id, section, start, end, n_tokens, share, n_crossing, doc_tokens.

    ``sections`` has the id and ``section``, ``start``, ``end`` in characters, end
    excluded; they may overlap or leave gaps, and are clipped to the text. Without
    it every line is a section. ``n_tokens`` counts tokens whose first byte is in
    the section, ``share`` adds up tokens by their part of bytes in it,
    ``n_crossing`` counts tokens that lie in the section and outside of it too,
    ``doc_tokens`` is the count of the whole text. NULL and empty texts are one
    line without tokens; a document that ``sections`` does not name gives no row
    there. Rows that repeat an id are each counted. An empty table gives an empty
    result. Only the named columns are read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    if sections is not None:
        spans = F.collect_list(F.struct("section", "start", "end")).alias("spans")
        spans = sections.groupBy(F.col(id_col).cast("long").alias("_of")).agg(spans)
        rows = rows.join(spans, rows[id_col].eqNullSafe(spans["_of"])).select(id_col, "text", "spans")
    columns = f"`{id_col}` long, section int, start long, end long, n_tokens long, share double, n_crossing long, doc_tokens long"
    return rows.mapInArrow(_count(vocabulary, pattern, pa.field(id_col, pa.int64()), sections is not None), columns)
