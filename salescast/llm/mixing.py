"""Mixing sources to target weights by systematic sampling.

Sources have weights and share ``share`` times the total size in their
proportion; no target exceeds ``max_repeat`` times its source's size, and what is
cut off goes to the others by weight. Within a source a document's expected
number of copies is target / size of the source. The prefix sums of these
expectations, shifted by one random offset per source, cross integers; each
crossing takes the document once.

The order of the prefix sums is fixed by (size class, digest of the identifier,
size, identifier), so the sample is spread over small and large documents and
reruns agree. Positions are counted in two levels: documents per block, then
within a block. A block is a slice of one size class of one source by digest, so
a source with most of the rows is many blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.text import SPACE, cut, row_key, unpacked, whole_row

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2.0
#: Hexadecimal digits of the digest that number the slices of a size class.
SLICE_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words; the gaps between them are counted as one split."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACE}|{SPACE}$", "")
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, SPACE))).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT
) -> DataFrame:
    """source, source_size and target of each source of a (source, size) table.

    Only sums go to the driver: each round caps the sources whose share is above
    their limit and shares the rest out among the others, until none is above.
    The ranking by name is one task over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = cut(
        per_source.select(
            "source",
            "source_size",
            F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double").alias("w"),
            (max_repeat * F.col("source_size")).alias("most"),
        )
    )
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0
    while True:
        # `most <= w * rate` only ever becomes true for more sources: the rate grows
        full = F.col("most") <= F.col("w") * rate
        spent, open_weight = table.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("w")))
        ).first()
        if not open_weight:
            break
        new_rate = max(rate, (total - spent) / open_weight)
        if new_rate == rate:
            break
        rate = new_rate
    target = F.when(F.col("most") <= F.col("w") * rate, F.col("most")).otherwise(F.col("w") * rate)
    return table.select("source", "source_size", F.round(target, 6).alias("target"))


def _offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) for each source."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(16**8)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    max_repeat: float = MAX_REPEAT,
    seed: str = "mix-",
) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, copies, taken.

    ``taken`` is the number of words the mix takes of the document, repeats
    counted. NULL texts and texts without a word have size 0. NULL is a source of
    its own and the last by name. A source without words has target 0 and gives
    nothing. Rows that repeat an id are placed one after the other. An empty
    table gives an empty result. Only the three named columns are read.
    """
    return _copies(docs, id_col, text_col, source_col, weights, share, max_repeat, seed).select(
        F.col("_id").alias(id_col), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def _copies(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    source_col: str,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    max_repeat: float = MAX_REPEAT,
    seed: str = "mix-",
    key: Column | None = None,
) -> DataFrame:
    """The rows of :func:`mix` with what they were reckoned from, and ``key`` if one is given."""
    named = [] if key is None else ["key"]
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("digest"),
        *([] if key is None else [key.alias("key")]),
    )
    rows = cut(
        rows.withColumns(
            {"size_class": F.length(F.bin("size")), "slice": F.substring("digest", 1, SLICE_DIGITS)}
        )
    )
    block = ["source", "size_class", "slice"]
    before = Window.partitionBy("source").orderBy("size_class", "slice").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*block).agg(F.count("*").alias("n")).select(
        *block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    targets = source_targets(rows.select("source", "size"), weights, share, max_repeat)
    b, t = blocks.toDF("b_source", "b_class", "b_slice", "start"), targets.toDF("t_source", "source_size", "target")
    placed = rows.join(
        b,
        rows["source"].eqNullSafe(b["b_source"]) & (rows["size_class"] == b["b_class"]) & (rows["slice"] == b["b_slice"]),
    ).withColumn("k", F.col("start") + F.row_number().over(Window.partitionBy(*block).orderBy("digest", "size", "_id", *named)))
    joined = placed.join(t, placed["source"].eqNullSafe(t["t_source"]))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shift = _offset(F.col("source"), seed)
    copies = F.floor(shift + F.col("k") * each) - F.floor(shift + (F.col("k") - 1) * each)
    return joined.withColumn("copies", copies.cast("long"))


def take_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as the mix takes it.

    Rows are matched by id, text and source. Rows that agree in all three share
    their copies out: they differ by one at most, as the mix has it.
    """
    key = row_key(F.col(text_col), F.col(id_col), F.col(source_col))
    copies = _copies(docs, id_col, text_col, source_col, key=key, **options)
    copies = copies.groupBy(F.col("key").alias("_mix_key")).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    rows = docs.select(whole_row(docs), key.alias("_row_key"))
    joined = rows.join(copies.where("_copies > 0"), F.col("_row_key") == F.col("_mix_key"))
    place = F.row_number().over(Window.partitionBy("_mix_key").orderBy(F.lit(0)))
    joined = joined.withColumn("_place", place).withColumn(
        "_times", F.expr("CAST(_copies DIV _rows AS INT) + CAST(_place <= _copies % _rows AS INT)")
    )
    taken = joined.where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return unpacked(taken, docs)
