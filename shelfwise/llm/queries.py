"""The registered queries of this package, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import collocations, conversation_repair, decontamination, license_scan, ngram_join, quality, suffix_tree
from .common import is_in_fold, table
from .fingerprints import fingerprints
from .mixing import mix_plan
from .near_dup import near_duplicates
from .token_counts import ranked_scores, token_counts
from .token_store import store_tokens
from .warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_mix_sources(spark, sf_dir):
    return mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op1_mix_sources"] = r"""
WITH base AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents
), ranked AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS s, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM base GROUP BY source
), capped AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         2.0::DOUBLE * s AS cap FROM ranked
), levels AS (
  SELECT *, cap / w AS ratio, (1.5::DOUBLE * sum(s) OVER ()
    - coalesce(sum(cap) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, place
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE)) AS level
  FROM capped
), goal AS (
  SELECT source, CAST(s AS BIGINT) AS source_size, least(cap, coalesce(w * (
    SELECT level FROM levels WHERE ratio > level ORDER BY ratio, place LIMIT 1), cap)) AS target FROM levels
), plan AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM goal
), tied AS (
  SELECT source, key, size, count(*) AS copies FROM base GROUP BY ALL
), running AS (
  SELECT *, coalesce(sum(size * copies) OVER (PARTITION BY source ORDER BY key
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM tied
)
SELECT b.doc_id, b.size, p.source_size, p.target, CAST(p.epochs * b.size + greatest(0, least(r.size,
         floor((p.budget - p.epochs * p.source_size - r.start) / r.copies))) AS BIGINT) AS taken
FROM base b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source
JOIN running r ON r.source IS NOT DISTINCT FROM b.source AND r.key = b.key
"""


def quality_model(spark, sf_dir, docs=None):
    """The classifier, learnt from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    return quality.train(docs, table(spark, sf_dir, "labels"), ~is_in_fold("doc_id", 5, 0))


@query
def op4_quality_gam(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", is_in_fold("doc_id", 5, 0).alias("held_out"),
                         quality.score(quality_model(spark, sf_dir), "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op7_minhash_near_dup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op9_decontaminate(spark, sf_dir):
    return decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_token_store(spark, sf_dir):
    return store_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_suffix_tree_scores(spark, sf_dir):
    held_out = is_in_fold("doc_id", 7, 2)
    return suffix_tree.score(table(spark, sf_dir, "documents"), ~held_out).select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_warc_archives(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op3_warc_archives"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op6_paragraph_sketches(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op10_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("blocks")


@query
def op5_trie_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), ranked_scores(public_tokenizers.path("piece_bpe_32k.model")))


ORACLE["op7_minhash_near_dup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w
), u AS (
  SELECT doc_id, unnest(sh) AS g FROM s
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN s p ON p.doc_id = x JOIN s q ON q.doc_id = y WHERE 100 * n >= 80 * (len(p.sh) + len(q.sh) - n)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.y FROM reach r JOIN both_ways l ON r.b = l.x
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(b) AS component_id, s.doc_id = min(b) AS kept
FROM s JOIN reach ON a = s.doc_id GROUP BY s.doc_id, sh
"""


@query
def op13_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(rows), rows)


@query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), doc_id="doc_id")


ORACLE["op12_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), totals AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
), grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (
    SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k))
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, cut, array_to_string(string_split(c.phrase, ' ')[1:cut], ' ') AS head,
         array_to_string(string_split(c.phrase, ' ')[cut + 1:c.k], ' ') AS tail
  FROM f c, (SELECT unnest([1, 2, 3]) AS cut) WHERE c.k > cut
), scored AS (
  SELECT x.lang, x.phrase, x.a, h.f AS l, t.f AS r, CAST(2000000::HUGEINT * x.a // (h.f + t.f) AS BIGINT) AS score, cut
  FROM cuts x JOIN f h ON h.lang = x.lang AND h.phrase = x.head JOIN f t ON t.lang = x.lang AND t.phrase = x.tail
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), parts AS (
  SELECT lang, f AS longer, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase FROM (
    SELECT *, unnest(range(1, k - m + 2)) AS i FROM f, (SELECT unnest([2, 3]) AS m) WHERE k > m)
), kept AS (
  SELECT b.* FROM best b LEFT JOIN (SELECT lang, phrase, max(longer) AS longer FROM parts GROUP BY ALL) q USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query
def op11_ngram_join(spark, sf_dir):
    return ngram_join.ngram_groups(table(spark, sf_dir, "documents"), words=5, percent=80)


# The same groups in SQL, with shingles of five words.
ORACLE["op11_ngram_join"] = ORACLE["op7_minhash_near_dup"].replace("len(ws) < 2 THEN ws", "len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]").replace(
    "range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]", "range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')").replace(
    ", s.doc_id = min(b) AS kept", "")
