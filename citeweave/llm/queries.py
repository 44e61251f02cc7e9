"""The operators over the whole tables, as queries, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokens
from .collocations import collocations
from .decontaminate import contamination
from .licences import find_notices
from .mixing import count_tokens, mixture
from .near_dups import near_duplicates
from .quality import quality_cascade
from .scoring import score_documents
from .sharding import shard_table
from .style_tree import extract
from .tables import read
from .token_files import count_tokens_in_files, list_blocks, write_token_files
from .training_order import materialise_order, read_back
from .warc import captures_of, read_captures, write_archive

QUERIES, ORACLES = {}, {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _, _ = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), "contaminated")


ORACLES["op1_winnowing"] = r"""
WITH cut AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), item_id, text FROM benchmark
), words AS (
  SELECT side, r, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM cut
), sizes AS (
  SELECT DISTINCT least(len(w), 13) AS n FROM words WHERE side = 'b' AND len(w) > 0
), item_windows AS (
  SELECT DISTINCT id AS item_id, n, array_to_string(w[i:i + n - 1], ' ') AS window_text
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words JOIN sizes ON n = least(len(w), 13) WHERE side = 'b')
), doc_windows AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS window_text
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE side = 'd' AND len(w) >= n)
), hits AS (
  SELECT r, n, i, item_id FROM doc_windows JOIN item_windows USING (n, window_text)
), places AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM hits) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT id AS doc_id, len(w)::BIGINT AS n_words,
  coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN places USING (r) LEFT JOIN items USING (r) WHERE side = 'd'
"""


@query
def op2_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    used, _, _ = mixture(read(spark, sf_dir, "documents"))
    return count_tokens(used, F.col("doc_id"), F.col("copies")).select("doc_id", "source", "n_tokens", "copies")


@query
def op3_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("kept"))
    return found.select("doc_id", F.col("n_shingles").cast("long"), "component_id", kept.alias("kept"))


@query
def op4_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table(read(spark, sf_dir, "documents"), 40)


@query
def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return quality_cascade(docs, profile=True).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("rejected_by").isNull()).alias("kept"),
    )


ORACLES["op5_quality_cascade"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM docs
), runs AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, run) AS times
  FROM (
    SELECT r, i, array_to_string(w[i:i + 4], ' ') AS run
    FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
  )
), repeated AS (
  SELECT r, count(DISTINCT place) AS n
  FROM (SELECT r, unnest(range(i, i + 5)) AS place FROM runs WHERE times > 1) GROUP BY r
), figures AS (
  SELECT doc_id,
    len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(lines) AS n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS large,
    length(regexp_replace(text, '[^a-z]', '', 'g')) AS small
  FROM words LEFT JOIN repeated USING (r)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_symbols > n_words
    OR large > small
    OR (n_dup_lines >= 6 AND 10 * n_dup_lines > 3 * n_lines)) AS kept
FROM judged
"""


@query
def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = materialise_order(read(spark, sf_dir, "documents"))
    rows = order.sequences.select("slot", "shard", "place", "first_doc_id", "n_docs", "n_tokens")
    # A row per sequence on both sides: never a broadcast, however short the list of files behind one looks.
    return rows.join(read_back(order).hint("merge"), "slot")


@query
def op7_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    archive = write_archive(pages)
    records = read_captures(archive, captures_of(archive, pages))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op7_capture_index"] = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), shared AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS smallest FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> smallest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> smallest THEN smallest END AS refers_to
FROM shared
"""


@query
def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = write_token_files(read(spark, sf_dir, "documents"))
    blocks = list_blocks(spark, folder, manifest.select("file").distinct())
    counted = count_tokens_in_files(folder, blocks)
    return counted.join(manifest, ["file", "nth"]).select("doc_id", "nth", "start", "n_tokens")


@query
def op9_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents")).drop("_row")


@query
def op10_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(read(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op11_de_bruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


ORACLES["op11_de_bruijn"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), runs AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, range(1, 6) AS sizes(size) WHERE len(w) >= size)
), counted AS (
  SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1
), inside AS (
  SELECT DISTINCT lang, inner_phrase, size, a FROM (
    SELECT lang, size, a, unnest([array_to_string(w[1:size - 1], ' '), array_to_string(w[2:size], ' ')]) AS inner_phrase FROM candidates)
), kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.inner_phrase = c.phrase AND i.size = c.size + 1 AND i.a >= c.a)
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:size], ' ') AS q
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, t.n,
    ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = p JOIN counted y ON y.lang = c.lang AND y.phrase = q
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score FROM ranked WHERE rank <= 2000
"""


@query
def op12_run_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(read(spark, sf_dir, "documents"))


@query
def op13_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return find_notices(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
