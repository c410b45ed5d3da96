"""Queries that apply the operators to the driver's tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm import chat, divergence, exact_dedup, language, manifest, mixing, pieces, quality, simhash, substring, suffixes, token_counts, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(_fold(5) != 0))
    return language.predict(docs, model).select("doc_id", (_fold(5) == 0).alias("held_out"), "lang_pred", "score")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def _fold(n: int):
    """Remainder of the checksum of doc_id; rows without an id fall into the fold of the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(n))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    known = labels.select("doc_id", "toxic").where("toxic IS NOT NULL")
    model = toxicity.fit(toxicity.sample(docs.select("doc_id", "text"), known, keep=_fold(4) != 2))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (_fold(4) == 2).alias("held_out"), "score", "predicted", "n_hits")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


OP4_SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text,
         sha256(coalesce(CAST(length(role) AS VARCHAR), 'null') || ':' || coalesce(role, '')
                || CASE WHEN text IS NULL THEN '-' ELSE '+' END || coalesce(text, '')) AS digest
  FROM conversations
), c AS (
  SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS l,
         string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10)
                    || replace(coalesce(text, ''), '<|', '< |') || chr(10), '' ORDER BY turn NULLS FIRST, digest) AS chat
  FROM t GROUP BY conv_id
), e AS (
  SELECT l, min(conv_id) AS conv_id, count(*) AS n_copies, min(chat) AS chat FROM c GROUP BY l
)
SELECT conv_id, CAST(len(l) AS BIGINT) AS n_turns, n_copies, chat FROM e
WHERE NOT EXISTS (SELECT 1 FROM e o WHERE o.l[1] = e.l[1] AND len(o.l) > len(e.l) AND o.l[1:len(e.l)] = e.l)
"""


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w,
         2.0::DOUBLE * source_size AS most
  FROM s
), c AS (
  SELECT *, sum(most) OVER o - most AS spent, sum(w) OVER () - sum(w) OVER o + w AS open_weight,
         (SELECT 1.5::DOUBLE * sum(source_size) FROM s) AS total
  FROM w WINDOW o AS (ORDER BY most / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), r AS (
  SELECT arg_min((total - spent) / open_weight, most / w) AS rate FROM c WHERE (total - spent) / open_weight < most / w
), t AS (
  SELECT source, source_size, round(CASE WHEN most <= w * rate THEN most ELSE w * rate END, 6) AS target
  FROM c, r
), p AS (
  SELECT d.*, source_size, target, target / source_size AS each,
         row_number() OVER (PARTITION BY d.source ORDER BY length(bin(size)), digest[1:3], digest, size, doc_id) AS k,
         CAST(CAST('0x' || md5('mix-' || coalesce(d.source, 'null'))[1:8] AS BIGINT) AS DOUBLE) / 4294967296.0 AS shift
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), n AS (
  SELECT *, CAST(floor(shift + k * each) - floor(shift + (k - 1) * each) AS BIGINT) AS copies FROM p
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM n
"""


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, w, unnest(range(len(w) - 49)) AS i FROM d
), h AS (
  SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 50], ' ')) AS h FROM p
), c AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS m FROM h) WHERE m < doc_id
), g AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM c
), n AS (
  SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS k FROM d
), kept AS (
  SELECT doc_id, string_agg(t, ' ' ORDER BY k) AS t, count(*) AS n FROM n ANTI JOIN g USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, decoded again; ``text_md5`` is of the decoded text."""
    encoded = pieces.encode(_table(spark, sf_dir, "documents"), digest=True)
    return encoded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "text_md5")

def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), p AS (
  SELECT doc_id, h, unnest(range(len(h) // 2 - 49)) AS i FROM d
), w AS (
  SELECT doc_id, i, md5_number(h[2 * i + 1:2 * i + 100]) AS w FROM p
), c AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS m FROM w) WHERE m < doc_id
), s AS (
  SELECT doc_id, i, i > max(i + 50) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM c
), r AS (
  SELECT doc_id, i, sum(CASE WHEN coalesce(gap, TRUE) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s
), g AS (
  SELECT doc_id, run, min(i) AS low, max(i) + 50 AS high FROM r GROUP BY doc_id, run
), k AS (
  SELECT doc_id, run, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY run) AS low, low AS high FROM g
  UNION ALL
  SELECT doc_id, max(run) + 1, max(high), NULL FROM g GROUP BY doc_id
), t AS (
  SELECT doc_id, string_agg(substr(h, 2 * low + 1, 2 * (coalesce(high, len(h) // 2) - low)), '' ORDER BY run) AS t, count(*) - 1 AS n
  FROM k JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST((len(h) - len(coalesce(t, h))) // 2 AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(t, h))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), t AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), g AS (
  SELECT DISTINCT lang, source FROM d
), n AS (
  SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term
), c AS (
  SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN n USING (lang, source, term)
), p AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p
  FROM c WINDOW w AS (PARTITION BY lang, source)
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) WINDOW w AS (PARTITION BY lang)
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), v AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM v
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r
WHERE part = 'pair' OR rank <= 10
"""


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return manifest.audit(_table(spark, sf_dir, "documents"), altered)


#: DuckDB has no checksum function: CRC-32 by its bitwise rule over the digits of doc_id, byte by byte.
OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, source, n_chars, text, CAST(doc_id AS VARCHAR) AS digits FROM documents
), crc AS (
  SELECT doc_id, digits, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM (SELECT DISTINCT doc_id, digits FROM d WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, digits, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END
  FROM (
    SELECT *, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(digits[k // 8 + 1]) AS BIGINT)) ELSE c END AS x FROM crc
    WHERE k < 8 * length(digits)
  )
), f AS (
  SELECT doc_id FROM crc WHERE k = 8 * length(digits) AND xor(c, CAST(4294967295 AS BIGINT)) % 7 = 0
), e AS (
  SELECT d.doc_id, lang, f.doc_id IS NOT NULL AND n_chars IS NOT NULL AS altered,
         coalesce(strlen(digits) || ':' || digits, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         CAST(n_chars AS VARCHAR) AS n0, CAST(n_chars + 1 AS VARCHAR) AS n1,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM d LEFT JOIN f ON d.doc_id = f.doc_id
), l AS (
  SELECT doc_id, lang, altered, sha256(head || coalesce(strlen(n0) || ':' || n0, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(n1) || ':' || n1, '-') || tail) AS other
  FROM e
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM l
), low AS (
  SELECT lang, 0 AS height, list(leaf ORDER BY rank) AS nodes FROM r GROUP BY lang
  UNION ALL
  SELECT lang, height + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM low WHERE len(nodes) > 1
), sub AS (
  SELECT lang, nodes[1] AS subroot, height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank FROM low WHERE len(nodes) = 1
), high AS (
  SELECT 0 AS height, list(subroot ORDER BY rank) AS nodes FROM sub
  UNION ALL
  SELECT height + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM high WHERE len(nodes) > 1
), step AS (
  SELECT r.lang, r.rank, low.height AS k, r.rank >> low.height AS place, nodes[xor(r.rank >> low.height, 1) + 1] AS sibling
  FROM r JOIN low ON r.lang IS NOT DISTINCT FROM low.lang WHERE len(nodes) > 1
  UNION ALL
  SELECT r.lang, r.rank, sub.height + high.height, sub.rank >> high.height, nodes[xor(sub.rank >> high.height, 1) + 1]
  FROM r JOIN sub ON r.lang IS NOT DISTINCT FROM sub.lang, high WHERE len(nodes) > 1
), path AS (
  SELECT lang, rank, list(struct_pack(place := place, sibling := sibling) ORDER BY k) AS path FROM step GROUP BY lang, rank
), t AS (
  SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM high WHERE len(nodes) = 1) AS root, coalesce(path, []) AS path,
         CASE WHEN altered THEN other ELSE leaf END AS start, row_number() OVER () AS id
  FROM r JOIN sub ON r.lang IS NOT DISTINCT FROM sub.lang
  LEFT JOIN path ON r.lang IS NOT DISTINCT FROM path.lang AND r.rank = path.rank
), fold AS (
  SELECT id, 0 AS k, start AS node, path FROM t
  UNION ALL
  SELECT id, k + 1, CASE WHEN path[k + 1].place % 2 = 0 THEN sha256(node || coalesce(path[k + 1].sibling, ''))
                         ELSE sha256(coalesce(path[k + 1].sibling, '') || node) END, path
  FROM fold WHERE k < len(path)
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(t.path, lambda p: coalesce(p.sibling, '')), '')) AS proof_sha256,
       node AS folded_root, node = root AS verified
FROM t JOIN fold USING (id) WHERE k = len(fold.path)
"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_token_counts, op2_toxicity, op3_simhash, op4_chat, op5_language, op6_exact_dedup, op7_mix, op8_quality, op9_substring_dedup, op10_sentencepiece, op11_suffix_dedup, op12_divergence, op13_manifest)}


def oracles() -> dict[str, str]:
    return {"op4_chat": OP4_SQL, "op6_exact_dedup": OP6_SQL, "op7_mix": OP7_SQL, "op9_substring_dedup": OP9_SQL, "op11_suffix_dedup": OP11_SQL, "op12_divergence": OP12_SQL, "op13_manifest": OP13_SQL}
