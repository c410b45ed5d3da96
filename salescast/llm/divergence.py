"""How far the sources of a language diverge in their words, by Arrow's compute functions.

Inside ``mapInArrow`` a batch of texts is lower-cased (``ascii_lower``), cut at
everything that is no letter (``split_pattern_regex``), dictionary-encoded and counted
with a hash ``group_by``: by language, source and term, and how many documents have
the term. Counts of a task are merged as they grow and leave it once, so a frequent
term travels as one row from each task.

Spark merges these partial counts into one row for each kept term of a language, with
its counts by source, dealt into shards by the hash of the term. A shard meets its
language's totals (replicated by shard, never broadcast by hint) and computes what its
terms add to the divergence of each pair of sources, and its own leading terms of each
source. Sums and ranks over shards follow.

All numbers are whole. Shares are billionths; see :func:`share`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.text import slices, stored

#: What stands between terms, as a pattern.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A language keeps the terms of at least so many of its documents.
LEAST_DOCS = 10
#: Ranks of terms that are reported.
TOP = 10
#: Kept terms of a language in one shard, about.
SHARD_TERMS = 4096

#: Partial counts of a task are merged when there are so many rows of them.
_MERGE_ROWS = 1 << 19
_KEYS = ["lang", "source", "term"]
_COUNTS = pa.schema([*((k, pa.large_string()) for k in _KEYS), ("n", pa.int64()), ("docs", pa.int64())])


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of a batch of (lang, source, text)."""
    # a copy first: ascii_lower misreads a slice that was cast
    lang, source, text = (pc.fill_null(pa.concat_arrays([batch.column(k)]).cast(pa.large_string()), "") for k in range(3))
    groups = pa.table({"lang": lang, "source": source}).append_column("row", pa.array(np.arange(len(batch))))
    pieces = pc.split_pattern_regex(pc.ascii_lower(text), BETWEEN)
    rows, terms = pc.list_parent_indices(pieces), pc.list_flatten(pieces)
    some = pc.not_equal(terms, "")
    if not some.true_count:
        return _COUNTS.empty_table()
    # a term is a number of the dictionary while it is counted
    coded = terms.filter(some).dictionary_encode()
    cells = pa.table({"row": rows.filter(some).cast(pa.int64()), "code": coded.indices.cast(pa.int64())})
    cells = cells.group_by(["row", "code"]).aggregate([([], "count_all")])
    at = cells["row"].combine_chunks()
    cells = pa.table(
        {
            "lang": groups["lang"].take(at).combine_chunks().dictionary_encode(),
            "source": groups["source"].take(at).combine_chunks().dictionary_encode(),
            "code": cells["code"],
            "n": cells["count_all"],
        }
    )
    found = cells.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ("n", "count")])
    plain = [found[c].combine_chunks().cast(pa.large_string()) for c in ("lang", "source")]
    names = coded.dictionary.take(found["code"].combine_chunks())
    return pa.table([*plain, names, found["n_sum"], found["n_count"]], names=[*_KEYS, "n", "docs"])


def _merged(parts: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(parts).group_by(_KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return found.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select([*_KEYS, "n", "docs"])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task. Merged as they come; a very large vocabulary leaves in several parts."""
    schema = pa.schema([*((k, pa.string()) for k in _KEYS), ("n", pa.int64()), ("docs", pa.int64())])
    parts, rows = [], 0
    for batch in slices(batches, 2, 8 << 20):
        parts.append(_counted(batch))
        rows += parts[-1].num_rows
        if rows > _MERGE_ROWS:
            parts = [_merged(parts)]
            rows = parts[0].num_rows
            if rows > _MERGE_ROWS // 2:
                yield from parts[0].cast(schema).to_batches(1 << 16)
                parts, rows = [], 0
    if parts:
        yield from _merged(parts).cast(schema).to_batches(1 << 16)


def share(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact: digits to the base 1000 one by one."""
    whole = total + 2 * kept
    left, result = counts.astype(np.int64) + 2, np.zeros(counts.shape, np.int64)
    for _ in range(3):
        left = left * 1000
        result = result * 1000 + left // whole
        left = left % whole
    return result + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


_SHARE = "lang string, source string, part string, item string, value long"


def _shard(key: tuple, terms: pa.Table, totals: pa.Table) -> pa.Table:
    """What the terms of one shard add: (source, part, item, value)."""
    lang, kept = key[0].as_py(), totals["kept"][0].as_py()
    sources, sums = totals["source"].to_pylist(), totals["total"].to_pylist()
    place = {s: k for k, s in enumerate(sources)}
    names = terms["term"].to_pylist()
    counts = np.zeros((len(sources), len(names)), np.int64)
    cells = terms["cells"].combine_chunks()
    if len(names):
        flat = pc.list_flatten(cells)
        rows = [place[s] for s in flat.field("source").to_pylist()]
        counts[rows, pc.list_parent_indices(cells).to_numpy()] = flat.field("n").to_numpy()
    shares = np.array([share(c, n, kept) for c, n in zip(counts, sums)]).reshape(counts.shape) if names else counts
    whole = share(counts.sum(axis=0), sum(sums), kept) if names else counts[:0].reshape(-1)
    rows = []
    for k, source in enumerate(sources):
        values = apart(shares, shares[k]).sum(axis=1) if names else np.zeros(len(sources), np.int64)
        rows += [(lang, source, "pair", s, int(v)) for j, (s, v) in enumerate(zip(sources, values)) if j != k]
        value = apart(shares[k], whole) if names else whole
        hits = np.flatnonzero((counts[k] > 0) & (shares[k] > whole)) if names else []
        leading = sorted((-int(value[i]), names[i].encode(), i) for i in hits)[:TOP]
        rows += [(lang, source, "term", names[i], -v) for v, _, i in leading]
    schema = pa.schema([*((c, pa.string()) for c in ("lang", "source", "part", "item")), ("value", pa.int64())])
    return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, term, docs, cells): each term of a language, the number of its documents, and
    ``cells`` with its count by source. NULL is as empty in all three columns."""
    named = [F.col(f"`{c}`").cast("string").alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    partial = docs.select(*named).mapInArrow(_partial, "lang string, source string, term string, n long, docs long")
    dealt = partial.repartition("lang", "term")  # both aggregates below keep to it
    cells = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    cell = F.collect_list(F.struct("source", "n")).alias("cells")
    return cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), cell)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): the divergence of each pair of sources of a
    language (``pair``), and the terms that set a source apart from its language (``term``).

    A language keeps the terms that at least ``LEAST_DOCS`` of its documents have. NULL
    text, language and source are as empty; a source without terms has its row in every
    pair of its language. A language with one source has no pairs, one without kept terms
    only pairs of value 0. Ties are ranked by item in the order of its bytes. Repeated
    rows count each. An empty table gives an empty result; other columns are not read.
    """
    kept = stored(term_counts(docs, text_col, lang_col, source_col).where(F.col("docs") >= LEAST_DOCS))
    name = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    groups = docs.select(*name).distinct()
    sums = kept.select("lang", F.explode("cells").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    numbers = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = groups.join(sums, ["lang", "source"], "left").join(numbers, "lang", "left").na.fill(0, ["total", "kept"])
    totals = stored(totals.withColumn("shards", F.expr(f"kept div {SHARD_TERMS} + 1")))
    spread = totals.select("lang", "source", "total", "kept", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    shards = totals.select("lang", "shards").distinct()
    dealt = kept.join(shards, "lang").select("lang", F.expr("pmod(xxhash64(term), shards)").alias("shard"), "term", "cells")
    keys = ["lang", "shard"]
    parts = dealt.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(_shard, _SHARE)
    values = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.col("item"))
    ranked = values.withColumn("rank", F.row_number().over(order))
    return ranked.where(f"part = 'pair' OR rank <= {TOP}")
