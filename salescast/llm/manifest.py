"""A Merkle manifest of a dataset as content-addressed records, and proofs by descent.

Every row is a leaf. The leaves of a tree, in their order, are hashed in runs of
``RUN`` neighbours until one node is left. A record maps a digest to the ``WIDTH``
nodes ``STEPS`` levels below it, so the levels of a tree are stored in few tables,
and equal subtrees (copies of rows) share a record. The roots of all trees are the
leaves of one more tree, whose root names the dataset.

Proofs are found from the root. A request is the rank of a leaf; its digits to the
base ``WIDTH`` say which child is taken at each record. What is asked of one record
is one row, so the root is looked up once and not by every leaf. A step joins these
rows with the records on the digest, collects the nodes that are passed by, and hands
every child its path so far. The path runs from the root down and is reversed at the
end.

Ranks come from a range partitioning by tree and order, with the source row as last
tie: a rank is the number of rows of the tree in earlier partitions and the place in
the own partition. Only these counts, a row for each partition and tree, are summed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.text import stored

#: Neighbours that are hashed into one node.
RUN = 2
#: Levels of a record, and so the nodes at its lower end.
STEPS = 6
WIDTH = RUN**STEPS

_PATH = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))]))


def field(value: Column) -> Column:
    """``-`` for NULL, else the count of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: SHA-256, lower-case hex, over its fields one after the other."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _hashed(nodes: list[str]) -> list[str]:
    """The next level: one node for each run."""
    return [hashlib.sha256("".join(nodes[i : i + RUN]).encode()).hexdigest() for i in range(0, len(nodes), RUN)]


def _levels(nodes: list[str], full: bool) -> list[list[str]]:
    """Levels of a record, the lowest first: ``STEPS`` further ones, or until one node remains."""
    levels = [nodes]
    while len(levels) <= STEPS if full else len(levels[-1]) > 1:
        levels.append(_hashed(levels[-1]))
    return levels


def _segment(levels: list[list[str]], place: int) -> list[dict]:
    """What is passed by on the way down to ``place``: (own place in the run, the others)."""
    passed = []
    for height in range(len(levels) - 2, -1, -1):
        at = place // RUN**height
        first = at - at % RUN
        run = levels[height][first : first + RUN]
        passed.append({"at": at - first, "others": run[: at - first] + run[at - first + 1 :]})
    return passed


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``rank`` in its ``tree`` by ``order`` and ``n``, the rows of the tree.

    NULL comes first. Of rows that agree in ``order`` any may be first, but the
    result is written, so it stays as it is. A tree may hold all rows: no task gets
    more than a part of the range. The table is read again while it is split, so it
    should be a stored one.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order, "_tie"]
    tied = nodes.withColumn("_tie", F.monotonically_increasing_id())
    # sorted partitions are numbered in order, so the id holds partition and place
    dealt = tied.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = stored(dealt.withColumn("_at", F.monotonically_increasing_id()).drop("_tie"))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    runs = stored(placed.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_here")))
    before = Window.partitionBy("tree").orderBy("_part")
    runs = runs.select(
        "tree",
        "_part",
        (F.sum("_here").over(before) - F.col("_here") - F.col("_first")).alias("_shift"),
        F.sum("_here").over(Window.partitionBy("tree")).alias("n"),
    )
    joined = placed.join(runs, ["tree", "_part"]).withColumn("rank", F.col("_at") + F.col("_shift"))
    return joined.drop("_at", "_part", "_shift")


class Manifest(NamedTuple):
    """``heights``: tables of records (tree, n, block, full, digest, children), leaves first;
    ``tops``: tree, height and digest of each tree's root."""

    heights: list[DataFrame]
    tops: DataFrame


_RECORD = "tree string, n long, block long, full boolean, digest string, children array<string>"


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        full = [n > WIDTH for n in columns["n"].to_pylist()]
        digests = [_levels(c, f)[-1][0] for c, f in zip(columns["children"].to_pylist(), full)]
        given = [columns[c] for c in ("tree", "n", "block")]
        arrays = [*given, pa.array(full, pa.bool_()), pa.array(digests, pa.string()), columns["children"]]
        yield pa.RecordBatch.from_arrays(arrays, ["tree", "n", "block", "full", "digest", "children"])


def build(nodes: DataFrame) -> Manifest:
    """The records of all trees over (tree, n, rank, digest).

    A task gets ``WIDTH`` nodes at a time, whatever the size of a tree. One table is
    written for each ``STEPS`` levels. A tree of one leaf has that leaf as its root.
    No nodes give empty tables.
    """
    heights, tops = [], []
    while True:
        run = F.sort_array(F.collect_list(F.struct("rank", "digest")))["digest"].alias("children")
        blocks = nodes.groupBy("tree", "n", F.expr(f"rank div {WIDTH}").alias("block")).agg(run)
        records = stored(blocks.mapInArrow(_folded, _RECORD))
        tops.append(records.where("NOT full").select("tree", F.lit(len(heights)).alias("height"), "digest"))
        heights.append(records)
        nodes = records.where("full").select("tree", F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"), F.col("block").alias("rank"), "digest")
        if nodes.isEmpty():
            break
    found = tops[0]
    for more in tops[1:]:
        found = found.union(more)
    return Manifest(heights, found)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (frontier, record, asked) to one row for each place asked for."""
    for batch in batches:
        for start in range(0, len(batch), 16):
            some = batch.slice(start, 16)
            columns = dict(zip(some.schema.names, some.columns))
            parents, asked = pc.list_parent_indices(columns["asked"]), pc.list_flatten(columns["asked"])
            if not len(asked):
                continue
            levels = [_levels(c, f) for c, f in zip(columns["children"].to_pylist(), columns["full"].to_pylist())]
            above = columns["path"].to_pylist()
            paths, digests = [], []
            wanted = list(zip(parents.to_pylist(), [rank % WIDTH for rank in asked.field("rank").to_pylist()]))
            there = pa.array([place < len(levels[row][0]) for row, place in wanted])
            for row, place in (w for w, ok in zip(wanted, there.to_pylist()) if ok):
                paths.append(above[row] + _segment(levels[row], place))
                digests.append(levels[row][0][place])
            parents, asked = parents.filter(there), asked.filter(there)
            arrays = [columns["tree"].take(parents), columns["roots"].take(parents), asked.field("rank")]
            arrays += [pa.array(digests, pa.string()), pa.array(paths, _PATH), asked.field("payload")]
            yield pa.RecordBatch.from_arrays(arrays, ["tree", "roots", "rank", "digest", "path", "payload"])


def descend(manifest: Manifest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """(tree, roots, rank, digest, path, payload) of each requested leaf.

    ``starts`` has (tree, roots, path): what is known at the root of each tree;
    ``requests`` has (tree, rank, payload). ``path`` runs from the root down; an entry
    has ``at``, the own place in its run, and ``others``, the digests passed by.
    Requests for ranks or trees that are not there find nothing; repeated ones are
    each answered.
    """
    block = F.expr(f"rank div {WIDTH}").alias("block")
    wanted = [requests.groupBy("tree", block).agg(F.collect_list(F.struct("rank", "payload")).alias("asked"))]
    for _ in manifest.heights[1:]:
        up = wanted[-1].select("tree", F.col("block").alias("rank"), F.lit(0).alias("payload"))
        wanted.append(up.groupBy("tree", block).agg(F.collect_list(F.struct("rank", "payload")).alias("asked")))
    frontier = None
    for height in reversed(range(len(manifest.heights))):
        tops = manifest.tops.where(F.col("height") == height).join(starts, "tree")
        here = tops.select("tree", F.lit(0).cast("long").alias("block"), "digest", F.lit(False).alias("full"), "roots", "path")
        if frontier is not None:
            below = frontier.select("tree", F.col("rank").alias("block"), "digest", F.lit(True).alias("full"), "roots", "path")
            here = here.union(below)
        records = manifest.heights[height].select("digest", "full", "children").dropDuplicates(["digest", "full"])
        asked = here.join(wanted[height], ["tree", "block"]).join(records, ["digest", "full"])
        kind = wanted[height].schema["asked"].dataType.elementType["payload"].dataType.simpleString()
        paths = "array<struct<at: int, others: array<string>>>"
        out = f"tree string, roots array<string>, rank long, digest string, path {paths}, payload {kind}"
        frontier = asked.mapInArrow(_walked, out)
    return frontier


def proofs(leaves: DataFrame) -> DataFrame:
    """One row per row of ``leaves``: its columns, ``subroot``, ``root`` and ``path``.

    ``leaves`` has (tree, leaf) and, as ``order``, what leaves ascend by; rows that
    agree in both stand in the order of their digests. Trees ascend by their name.
    ``path`` runs from the leaf up to the root: each entry has ``at``, the own place
    in its run, and ``others``, the rest of the run from left to right. An empty
    table gives an empty result.
    """
    empty = F.array().cast("array<struct<at: int, others: array<string>>>")
    nodes = stored(ranked(stored(leaves), ["order", "leaf"]))
    trees = build(nodes.select("tree", "n", "rank", F.col("leaf").alias("digest")))
    crown = trees.tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("digest").alias("subroot"))
    crown = stored(ranked(stored(crown), ["name"]))
    over = build(crown.select("tree", "n", "rank", F.col("subroot").alias("digest")))
    start = over.tops.select("tree", F.array("digest").alias("roots"), empty.alias("path"))
    found = descend(over, start, crown.select("tree", "rank", F.struct("name").alias("payload")))
    starts = stored(found.select(F.col("payload.name").alias("tree"), F.concat("roots", F.array("digest")).alias("roots"), "path"))
    asked = nodes.select("tree", "rank", F.struct(*[F.col(f"`{c}`") for c in leaves.columns]).alias("payload"))
    found = descend(trees, starts, asked)
    return found.select(
        *[F.col("payload")[c].alias(c) for c in leaves.columns],
        F.col("roots")[1].alias("subroot"),
        F.col("roots")[0].alias("root"),
        F.reverse("path").alias("path"),
    )


def proof_digest(path: Column) -> Column:
    """SHA-256 over all siblings of a path, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda p: p["others"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""

    def up(node: Column, step: Column) -> Column:
        left, right = F.slice(step["others"], 1, step["at"]), F.slice(step["others"], step["at"] + 1, RUN)
        return F.sha2(F.concat(F.array_join(left, ""), node, F.array_join(right, "")), 256)

    return F.aggregate(path, leaf, up)


def audit(docs: DataFrame, altered: Column, id_col: str = "doc_id", tree_col: str = "lang", count_col: str = "n_chars") -> DataFrame:
    """Every row's proof, and whether it still holds where ``altered`` rows have a count raised by one.

    Columns: id, leaf, subroot, root, proof_sha256, folded_root, verified. A leaf
    covers id, source, tree, count and text. NULL is a value of its own in every
    column; rows of NULL trees form the first tree, rows with a NULL id come first in
    theirs, and a NULL count stays as it is. Repeated rows are leaves of their own.
    Empty texts count as such, long ones are hashed where they are read. Only the
    named columns and ``source`` and ``text`` are read.
    """
    tree, number = F.col(tree_col).cast("string"), F.col(count_col).cast("decimal(20,0)")
    values = [F.col(id_col), F.col("source"), F.col(tree_col), F.col(count_col), F.col("text")]
    raised = [*values[:3], number + 1, values[4]]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("+"), tree), F.lit("")).alias("tree"),
        F.col(id_col).alias("order"),
        leaf_digest(*values).alias("leaf"),
        F.when(altered & number.isNotNull(), leaf_digest(*raised)).alias("other"),
    )
    found = proofs(leaves).withColumn("folded_root", folded(F.coalesce("other", "leaf"), F.col("path")))
    return found.select(
        F.col("order").alias(id_col),
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
