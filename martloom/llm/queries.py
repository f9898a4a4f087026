"""Each operator applied to its whole table, and the SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import bpe, centroids, codes, exact_dedup, licenses, ngrams, packing, pages, pieces, quality, simhash, toxicity, warc
from martloom.storage import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM t WINDOW same AS (PARTITION BY body)
"""

def op2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two distances behind the verdict are left out: their last digits depend on the order of sums."""
    return quality.assessed(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS x FROM w, unnest(range(1, len(ws) - 3)) AS t(i)),
often AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM often) GROUP BY 1),
base AS (
  SELECT doc_id, lang, length(body) AS chars, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n, 0) AS n_repeat_words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    [length(regexp_replace(body, '[^a-z]', '', 'g')), length(regexp_replace(body, '[^A-Z]', '', 'g')),
     length(regexp_replace(body, '[^0-9]', '', 'g')), length(regexp_replace(body, '[^\x20\x09-\x0D]', '', 'g')),
     length(regexp_replace(body, '[^.,;:!?''"()\-]', '', 'g')), length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')),
     length(regexp_replace(body, '[^@\[\]\\\^_`{}~/+=]', '', 'g'))] AS known
  FROM w LEFT JOIN repeated USING (doc_id)),
spoken AS (SELECT lang, lower(unnest(ws)) AS word FROM w WHERE lang IS NOT NULL),
said AS (SELECT lang, word, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang) AS every FROM spoken GROUP BY 1, 2),
common AS (SELECT lang, word, n, every FROM said
           WHERE n >= 0.005 * every AND every >= 0.001 * (SELECT count(*) FROM spoken)),
word_ref AS (SELECT lang, word, n AS q FROM common UNION ALL SELECT lang, NULL, any_value(every) - sum(n) FROM common GROUP BY 1),
mine AS (SELECT doc_id, w.lang, c.word, count(*) AS p FROM (SELECT doc_id, lang, lower(unnest(ws)) AS word FROM w) w
         LEFT JOIN common c ON c.lang = w.lang AND c.word = w.word GROUP BY 1, 2, 3),
class_ref AS (SELECT lang, k, sum(c) AS q FROM (SELECT lang, unnest(list_append(known, chars - list_sum(known))) AS c, unnest(range(8)) AS k FROM base)
              WHERE lang IN (SELECT lang FROM common) GROUP BY 1, 2),
pairs AS (
  SELECT base.doc_id, 'word' AS kind, coalesce(p, 0) AS p, q FROM base JOIN word_ref r USING (lang)
    LEFT JOIN mine m ON m.doc_id = base.doc_id AND m.word IS NOT DISTINCT FROM r.word WHERE n_words >= 60
  UNION ALL
  SELECT doc_id, 'class', c, q FROM (SELECT doc_id, lang, unnest(list_append(known, chars - list_sum(known))) AS c, unnest(range(8)) AS k
    FROM base WHERE chars >= 200) JOIN class_ref USING (lang, k)),
shares AS (SELECT doc_id, kind, p / sum(p) OVER d AS a, q / sum(q) OVER d AS b FROM pairs WINDOW d AS (PARTITION BY doc_id, kind)),
far AS (
  SELECT DISTINCT doc_id FROM (
    SELECT doc_id, kind, sqrt(greatest(sum(CASE WHEN a > 0 THEN a * log2(a / ((a + b) / 2)) ELSE 0 END
      + CASE WHEN b > 0 THEN b * log2(b / ((a + b) / 2)) ELSE 0 END) / 2, 0)) AS distance FROM shares GROUP BY 1, 2)
  WHERE distance > CASE kind WHEN 'word' THEN 0.33 ELSE 0.34 END)
SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND doc_id NOT IN (SELECT doc_id FROM far) AS kept
FROM base
"""


def op3_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), new_path(spark, "warc_archives"))


OP3_SQL = r"""
WITH t AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT page_id, body, strlen(body) AS n, min(page_id) OVER (PARTITION BY body) AS first FROM t)
SELECT page_id, n AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM g
"""


def op4_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op5_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licensed(table(spark, sf_dir, "documents"))


def op6_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.scored(table(spark, sf_dir, "documents"), order=3)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.predictions(docs, model)


def op9_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(table(spark, sf_dir, "pages"))


def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op11_distinct_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op12_active_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed(table(spark, sf_dir, "embeddings"))


def op13_sharded_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_divergence": op2_divergence,
    "op3_warc_chain": op3_warc_chain,
    "op4_swap_packing": op4_swap_packing,
    "op5_license_join": op5_license_join,
    "op6_backoff_lm": op6_backoff_lm,
    "op7_simhash": op7_simhash,
    "op8_nnpu_toxicity": op8_nnpu_toxicity,
    "op9_host_paths": op9_host_paths,
    "op10_prefix_bpe": op10_prefix_bpe,
    "op11_distinct_chunks": op11_distinct_chunks,
    "op12_active_codes": op12_active_codes,
    "op13_sharded_kmeans": op13_sharded_kmeans,
}

ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op2_divergence": OP2_SQL,
    "op3_warc_chain": OP3_SQL,
}
