"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and of common words is compared
with the reference of its language by Jensen-Shannon distance (base 2, so 0 to
1). A reference is the mean histogram of a language's documents that pass the base
rules, blended with the mean over all languages as if ``PRIOR`` more documents had
that one: a language of few documents is measured against the whole, one of many
against itself, with no switch between. Equal texts of one language weigh once.
Documents without a language, or whose language has no such document, are compared
with the mean over all. A document fails when a distance, or the
mean of both, is above its limit. Short documents are guarded: below
``min_chars`` characters the character distance does not count, below
``min_words`` words the word distance does not, and without both the mean does
not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import SPACE, cut, row_key, unpacked, whole_row, words

# Frequent function words of English, German, French and Spanish.
COMMON_WORDS = sorted(
    {
        *"the of and to in is was that for it with as".split(),
        *"der die und den von zu das mit ist nicht".split(),
        *"de la le et les des un une que est".split(),
        *"el en y los se del las por con no".split(),
    }
)

CHAR_DISTANCE = 0.25
WORD_DISTANCE = 0.6
MEAN_DISTANCE = 0.19
MIN_CHARS = 100
MIN_WORDS = 50
WINDOW = 8
#: Documents of the overall mean that every language is given.
PRIOR = 10
#: Shares are averaged as whole parts of this, so sums do not depend on their order.
_PARTS = 10**12

#: Classes of characters, taken out of a text one after the other.
_CLASSES = [
    ("lower", r"\p{Ll}+"),
    ("upper", r"\p{Lu}+"),
    ("space", SPACE),
    ("symbol", r"[#*$%&|<>]+"),
    ("digit", r"\p{Nd}+"),
]


def repeated_words(tokens: str, width: int = WINDOW) -> Column:
    """Words of the array column inside windows of ``width`` words found twice or more.

    Windows are compared by 64-bit hashes within one document. Only documents
    with a hash in common sort their windows. ``transform(array(x), ...)[0]``
    binds a value once for a lambda.
    """
    window = ", ".join(f"{tokens}[i + {k}]" for k in range(width))
    hashes = f"transform(sequence(0, size({tokens}) - {width}), i -> xxhash64({window}))"
    starts = (
        "transform(filter(s, (e, j) -> (j > 0 AND s[j - 1].h = e.h) OR (j < size(s) - 1 AND s[j + 1].h = e.h)), e -> e.i)"
    )
    step = f"struct(a.n + least({width}, x - a.q) AS n, x AS q)"
    covered = f"aggregate(p, struct(0L AS n, -{width} AS q), (a, x) -> {step}, a -> a.n)"
    of_starts = f"transform(array(sort_array({starts})), p -> {covered})[0]"
    of_sorted = f"transform(array(sort_array(transform(h, (x, i) -> struct(x AS h, i AS i)))), s -> {of_starts})[0]"
    of_hashes = f"CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE {of_sorted} END"
    return F.expr(f"CASE WHEN size({tokens}) < {width} THEN 0L ELSE transform(array({hashes}), h -> {of_hashes})[0] END")


def measures(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None) -> DataFrame:
    """Counts and histograms of each document, without its text."""
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    df = docs.select(
        F.col(id_col).alias("_id"), lang.alias("_lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")
    )
    df = df.withColumn("n_chars", F.char_length("t").cast("long")).withColumn("t0", F.col("t"))
    for k, (name, pattern) in enumerate(_CLASSES):
        df = df.withColumn(f"t{k + 1}", F.regexp_replace(f"t{k}", pattern, ""))
        df = df.withColumn(name, (F.char_length(f"t{k}") - F.char_length(f"t{k + 1}")).cast("long"))
    rest = F.char_length(f"t{len(_CLASSES)}").cast("long")
    df = df.select(
        "_id", "_lang", "t", "n_chars", (F.col("n_chars") - F.col("space")).alias("word_chars"),
        F.col("symbol").alias("n_symbols"),
        F.array(*[name for name, _ in _CLASSES], rest).alias("char_counts"),
        F.unhex(F.md5("t")).alias("digest"), words(F.col("t")).alias("w"),
    )
    df = df.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    forms = [form for word in COMMON_WORDS for form in (word, word.title(), word.upper())]
    common = F.filter("w", lambda w: w.isin(forms))
    df = df.withColumn("c", F.concat(F.lit(" "), F.lower(F.array_join(common, "  ")), F.lit(" ")))

    def count(word: str) -> Column:
        without = F.replace("c", F.lit(f" {word} "), F.lit(""))
        return ((F.length("c") - F.length(without)) / (len(word) + 2)).cast("long")

    return df.select(
        "_id", "_lang", "digest", "n_chars", F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words("w").alias("n_repeat_words"),
        "char_counts", F.array(*map(count, COMMON_WORDS)).alias("word_counts"),
    )


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def references(passed: DataFrame) -> DataFrame:
    """Per language, and NULL too, the number of texts and the sums of their histograms.

    Equal texts of one language are one; their rows meet in pre-aggregated form. Sums
    are of whole numbers, so they are the same however the rows are dealt.
    """
    texts = passed.groupBy("_lang", "digest").agg(*[F.any_value(name).alias(name) for name in ("chars", "words")])

    def sums(name: str, n: int) -> Column:
        parts = [F.round(F.col(name)[i] * _PARTS).cast("decimal(13,0)") for i in range(n)]
        return F.array(*[F.sum(part).cast("decimal(38,0)") for part in parts]).alias(f"sum_{name}")

    return texts.groupBy(F.col("_lang").alias("_ref")).agg(
        F.count(F.lit(1)).alias("n_texts"), sums("chars", len(_CLASSES) + 1), sums("words", len(COMMON_WORDS) + 1)
    )


def _blend(name: str, overall: list[float | None], prior: int) -> Column:
    """The reference of a row's language: its own sums and ``prior`` times the overall mean."""
    whole = F.array(*[F.lit(x).cast("double") for x in overall])
    own = F.zip_with(
        f"sum_{name}", whole, lambda s, mean: (s.cast("double") / _PARTS + prior * mean) / (F.col("n_texts") + prior)
    )
    return F.coalesce(own, whole)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    char_distance: float = CHAR_DISTANCE,
    word_distance: float = WORD_DISTANCE,
    mean_distance: float = MEAN_DISTANCE,
    min_chars: int = MIN_CHARS,
    min_words: int = MIN_WORDS,
    prior: int = PRIOR,
) -> DataFrame:
    """One row per row of ``docs``: counts, distances, base_failed and kept.

    NULL text has no words and fails the base rules, as the empty text does. A
    NULL language is compared with the mean of all languages. Rows that repeat
    each get their row, and weigh once in the reference. An empty table gives an
    empty result. Only the three named columns are read, so other columns cannot clash.
    """
    m = measures(docs, id_col, text_col, lang_col)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    other = F.col("n_words") - F.aggregate("word_counts", F.lit(0).cast("long"), lambda s, x: s + x)
    m = cut(
        m.select(
            "*",
            failed.alias("base_failed"),
            _shares(F.col("char_counts"), F.col("n_chars")).alias("chars"),
            _shares(F.concat("word_counts", F.array(other)), F.col("n_words")).alias("words"),
        ).drop("char_counts", "word_counts")
    )
    by_lang = cut(references(m.where(~F.col("base_failed"))))
    # one row, as long as the histograms are; NULL shares if nothing passed
    total = by_lang.agg(
        F.sum("n_texts").cast("double").alias("n"),
        *[F.sum(F.col("sum_chars")[i]) for i in range(len(_CLASSES) + 1)],
        *[F.sum(F.col("sum_words")[i]) for i in range(len(COMMON_WORDS) + 1)],
    ).first()
    overall = [None if x is None else float(x) / _PARTS / total["n"] for x in total[1:]]
    all_chars, all_words = overall[: len(_CLASSES) + 1], overall[len(_CLASSES) + 1 :]
    # NULL joins nothing, so rows without a language get the overall mean
    joined = m.join(by_lang, m["_lang"] == by_lang["_ref"], "left")
    chars = F.when(F.col("n_chars") >= min_chars, _distance(F.col("chars"), _blend("chars", all_chars, prior)))
    tokens = F.when(F.col("n_words") >= min_words, _distance(F.col("words"), _blend("words", all_words, prior)))
    scored = joined.withColumns({"char_distance": chars, "word_distance": tokens})
    fits = (F.coalesce("char_distance", F.lit(0.0)) <= char_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= word_distance
    )
    both = (F.col("char_distance") + F.col("word_distance")) / 2
    fits = fits & (F.coalesce(both, F.lit(0.0)) <= mean_distance)
    return scored.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & fits).alias("kept"), "char_distance", "word_distance",
    )


def filter_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang"
) -> DataFrame:
    """The rows that the rules keep, with all their columns.

    Each row has its own verdict: rows are matched by id, text and language, and
    what agrees in all three has the same. NULL and empty texts go; an empty table
    stays empty; columns of any other name come out as they were.
    """
    named = [id_col, lang_col] if lang_col else [id_col]
    key = row_key(F.col(text_col), *map(F.col, named)).alias("_row_key")
    read = [text_col, lang_col] if lang_col else [text_col]
    verdict = quality_rules(docs.select(key, *read), "_row_key", text_col, lang_col)
    kept = verdict.where("kept").select(F.col("_row_key").alias("_kept_key")).distinct()
    rows = docs.select(whole_row(docs), key)
    return unpacked(rows.join(kept, F.col("_row_key") == F.col("_kept_key"), "left_semi"), docs)
