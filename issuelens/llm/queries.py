"""Registered queries of this folder (``REGISTRY``: name -> (query, DuckDB SQL or None))."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from issuelens.llm import decontaminate, html_text, jaccard, lines, packing, passages, periodic, quality, search, sharding, token_counts, token_store, toxicity
from issuelens.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside windows of ten benchmark words, and the items found."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op2_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 24 by the hash tree, and with a 25th."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document packed into sequences of 4096 ids."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text by the byte-level vocabulary."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to a store in doc_id order, and what the store gives back."""
    return token_store.read_store(token_store.write_store(table(spark, sf_dir, "documents")))


def op6_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every text and the verdict of the repetition rules."""
    q = quality.quality(table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by the lexicon learned from the labelled rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_dom_graph_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by the content marginals of its DOM nodes."""
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train_on(pages))


def op9_seed_extend_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that windows of smaller documents cover are cut."""
    p = passages.dedup_passages(table(spark, sf_dir, "documents"))
    return p.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates and its text's number of links."""
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_of", "n_links")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, a tenth of the texts with a repeating tail, and what is left without the repetitions."""
    docs = table(spark, sf_dir, "documents")
    found = periodic.periodic_runs(docs.withColumn("text", periodic.planted(F.col("doc_id"), F.col("text"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    exponent = F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent.alias("exponent_milli"),
                        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


def op12_levelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that three or more documents hold stay in the greatest of them only."""
    d = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_signature_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT item_id, list_slice(w, i, i + 9) AS g, least(len(w), 10) AS m
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), m AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT doc_id, m, i, list_slice(w, i, i + m - 1) AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, m WHERE len(w) >= m)
), hit AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# n-grams of 5 to 10 words; the part of a text's characters that may lie in repeated ones is 25 - n hundredths.
_OP6_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), word AS MATERIALIZED (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
gram AS (  -- n-grams of 5 to 10 words from each place; null where the text ends before
  SELECT doc_id, p, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS g5,
         ' ' || lead(x, 5) OVER o AS x6, ' ' || lead(x, 6) OVER o AS x7, ' ' || lead(x, 7) OVER o AS x8,
         ' ' || lead(x, 8) OVER o AS x9, ' ' || lead(x, 9) OVER o AS x10
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), first AS MATERIALIZED (  -- a longer n-gram repeats only where its first five words do
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g5) AS k FROM gram WHERE g5 IS NOT NULL) WHERE k > 1
), win AS (
  SELECT doc_id, p AS i, n, CASE n WHEN 5 THEN g5 WHEN 6 THEN g5 || x6 WHEN 7 THEN g5 || x6 || x7 WHEN 8 THEN g5 || x6 || x7 || x8
                                   WHEN 9 THEN g5 || x6 || x7 || x8 || x9 ELSE g5 || x6 || x7 || x8 || x9 || x10 END AS g
  FROM first, range(5, 11) AS r(n)
),
twice AS MATERIALIZED (SELECT doc_id, n, i FROM (SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, g) AS k FROM win WHERE g IS NOT NULL) WHERE k > 1),
pos AS (SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS p FROM twice),
chars AS (SELECT doc_id, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS c FROM d),
each AS (
  SELECT doc_id, n, count(*) AS words, 100 * sum(length(x)) > (25 - n) * any_value(c) AS over
  FROM pos JOIN word USING (doc_id, p) JOIN chars USING (doc_id) GROUP BY doc_id, n
), rep AS MATERIALIZED (
  SELECT doc_id, max(words) FILTER (WHERE n = 5) AS n, bool_or(over) AS over FROM each GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, sum(chars) AS chars FROM (
    SELECT doc_id, chars, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS r FROM (
      SELECT doc_id, k, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars FROM (
        SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM d)))
  WHERE r > 1 AND chars > 0 GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(rep.over, false) AS over, coalesce(lines.chars, 0) AS line_chars
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)
), v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT over AND line_chars <= 0.3 * word_chars AND n_symbols <= 0.1 * n_words AS kept
FROM v
"""

_OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM win) WHERE first < doc_id
), lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS k
  FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# Brute force: all texts that share a five-word n-gram are compared, and classes grow from the links.
_OP10_SQL = r"""
WITH RECURSIVE t AS (
  SELECT coalesce(text, '') AS t, min(doc_id) AS id FROM documents GROUP BY 1
), w AS (SELECT id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM t),
g AS (
  SELECT DISTINCT id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
links AS (
  SELECT a, b FROM (SELECT x.id AS a, y.id AS b, count(*) AS k FROM g x JOIN g y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2) p
  JOIN n na ON na.id = a JOIN n nb ON nb.id = b WHERE 9 * k >= 4 * (na.n + nb.n)
), reach(id, c) AS (
  SELECT id, id FROM t UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id
), cls AS (SELECT id, min(c) AS class_id FROM reach GROUP BY id),
deg AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, cls.class_id, t.id AS copy_of, coalesce(deg.n_links, 0)::BIGINT AS n_links
FROM documents d JOIN t ON t.t = coalesce(d.text, '') JOIN cls ON cls.id = t.id LEFT JOIN deg ON deg.id = t.id
"""

_OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k
  FROM documents
), l AS (
  SELECT doc_id, k, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM d
), hot AS (
  SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE last > doc_id)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE last IS NULL OR last = doc_id), '')) AS kept_sha256
FROM l LEFT JOIN hot USING (key) GROUP BY doc_id
"""

_OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), q AS (
  SELECT item_id, t, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY 1, 2
), g AS (SELECT count(*) AS docs, sum(len(w)) AS total FROM d WHERE len(w) > 0),
tf AS (
  SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d) SEMI JOIN q USING (t) GROUP BY 1, 2, 3
), weight AS (
  SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), g
), s AS (
  SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n::HUGEINT * docs) // total))))::BIGINT AS score
  FROM tf JOIN weight USING (t) JOIN q USING (t), g GROUP BY 1, 2
), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""

REGISTRY = {
    "op1_decontaminate": (op1_decontaminate, _OP1_SQL),
    "op2_hash_tree_shards": (op2_hash_tree_shards, None),
    "op3_pattern_packing": (op3_pattern_packing, None),
    "op4_token_counts": (op4_token_counts, None),
    "op5_token_store": (op5_token_store, None),
    "op6_repetition_quality": (op6_repetition_quality, _OP6_SQL),
    "op7_lexicon_toxicity": (op7_lexicon_toxicity, None),
    "op8_dom_graph_text": (op8_dom_graph_text, None),
    "op9_seed_extend_dedup": (op9_seed_extend_dedup, _OP9_SQL),
    "op10_ngram_jaccard_join": (op10_ngram_jaccard_join, _OP10_SQL),
    "op11_periodic_runs": (op11_periodic_runs, None),
    "op12_levelled_lines": (op12_levelled_lines, _OP12_SQL),
    "op13_signature_search": (op13_signature_search, _OP13_SQL),
}
