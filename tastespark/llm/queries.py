"""Registered queries of the subpackage: each applies one operator, with production
parameters, to its whole table.  ``ORACLES`` holds DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastespark.io import table
from tastespark.llm import ann, bpe, chat, decontaminate, lines, mixing, neardup, ngram_join, periodic, pii, quality, warc, whitening
from tastespark.llm.common import documents

#: File of the tokenizer that the production run uses.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixing: size, its source's size and target, and words taken, per document."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC: every page written as a record and looked up by its url through the capture index's directory."""
    pages = table(spark, sf_dir, "pages")
    return warc.lookup(warc.write_archives(pages), pages, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest neighbours: for every vector whose id is divisible by 50, the 5 nearest found among all."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of a label: links, component and whether it is kept, per vector."""
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaccard join on 5-word shingles at 0.8: size of the set and component, per document."""
    return ngram_join.jaccard_components(documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data: counts and digest of the base spans, and all spans, per document."""
    found = pii.find_spans(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "spans")
    base = pii.strict(F.col("spans"))
    return found.select("doc_id", *[pii.count_kind(base, k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.span_text(base).cast("binary"), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup: lines, lines removed, and the remaining text's digest and length, per document."""
    clean = lines.dedup_lines(documents(spark, sf_dir))
    return clean.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text")).alias("clean_md5"),
                        F.length("text").cast("bigint").alias("clean_chars"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat formatting: body without quotations, the turn replied to (its own for none), thread and depth, per message."""
    formatted = chat.format_chat(table(spark, sf_dir, "conversations"))
    return formatted.drop("text").withColumn("reply_to", F.coalesce("reply_to", "turn"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality: classifier evidence, site prior, posterior and decision, per document."""
    return quality.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE: token count and digests of ids and decoded text, per document."""
    return bpe.encode_documents(documents(spark, sf_dir), TOKENIZER)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs: their number, the longest, and digests of all runs and of the collapsed text, per document."""
    return periodic.run_digests(periodic.with_planted_repeats(documents(spark, sf_dir)))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitening: every vector on the 16 leading components of the distinct vectors, and its exact deviation."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decontamination: words, words hit by benchmark windows, and the items found, per document."""
    found = decontaminate.scan(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("item_ids"), ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_warc": op2_warc,
    "op3_nearest": op3_nearest,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_pii": op6_pii,
    "op7_line_dedup": op7_line_dedup,
    "op8_chat": op8_chat,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_decontaminate": op13_decontaminate,
}

ORACLES: dict[str, str] = {}

# the same mix, stated over sorted documents: the running total of sizes in hash order
ORACLES["op1_mix_sources"] = """
WITH units AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(concat_ws('|', 'mix-1', COALESCE(doc_id::VARCHAR, 'null'), md5(COALESCE(text, '')))), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM units GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][pos % 3 + 1]::BIGINT AS w FROM sources),
running AS (
  SELECT *, sum(s) OVER o AS cs, sum(w) OVER o AS cw, sum(s) OVER () AS t, sum(w) OVER () AS tw
  FROM weighted WINDOW o AS (ORDER BY s * 10 // w, pos ROWS UNBOUNDED PRECEDING)),
marked AS (SELECT *, 3 * s::HUGEINT * (tw - cw + w) < w * (t - 3 * (cs - s)) AS capped FROM running),
level AS (
  SELECT (max(t) - 3 * COALESCE(sum(s) FILTER (capped), 0))::DOUBLE / (sum(w) FILTER (NOT capped))::DOUBLE AS l FROM marked),
targets AS (
  SELECT source, s, CASE WHEN capped THEN 3.0::DOUBLE * s ELSE least(w * l, 3.0::DOUBLE * s) END AS target FROM marked, level),
budgets AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END::BIGINT AS q FROM targets),
cells AS (SELECT source, h, sum(size) AS size FROM units GROUP BY source, h),
ordered AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING) - size AS before FROM cells),
extra AS (
  SELECT o.source, o.h FROM ordered o JOIN budgets b ON o.source IS NOT DISTINCT FROM b.source
  WHERE o.before + o.size / 2.0 <= b.target - b.q * b.s AND b.target > b.q * b.s)
SELECT u.doc_id, u.size, b.s AS source_size, b.target, u.size * (b.q + (e.h IS NOT NULL)::BIGINT) AS taken,
  u.source, b.q + (e.h IS NOT NULL)::BIGINT AS repeats
FROM units u JOIN budgets b ON u.source IS NOT DISTINCT FROM b.source
LEFT JOIN extra e ON u.source IS NOT DISTINCT FROM e.source AND u.h = e.h
"""

ORACLES["op7_line_dedup"] = """
WITH l AS (
  SELECT doc_id, text, i, string_split(text, chr(10))[i + 1] AS line
  FROM documents, LATERAL (SELECT unnest(range(len(string_split(text, chr(10))))) AS i)),
full_lines AS (
  SELECT doc_id, text, i, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM l
  WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
windows AS (
  SELECT doc_id, i AS a, lead(i, 1) OVER w AS b, lead(i, 2) OVER w AS c,
    t || chr(10) || lead(t, 1) OVER w || chr(10) || lead(t, 2) OVER w AS key
  FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, a) AS n FROM windows WHERE c IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([a, b, c]) AS i FROM ranked WHERE n > 1),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
    COALESCE(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS clean
  FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, COALESCE(n_lines, 0) AS n_lines, COALESCE(n_removed, 0) AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN md5(clean) END AS clean_md5, CASE WHEN d.text IS NOT NULL THEN length(clean) END AS clean_chars
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

ORACLES["op8_chat"] = r"""
WITH RECURSIVE messages AS (
  SELECT DISTINCT conv_id AS conv, turn, text FROM conversations WHERE text IS NOT NULL),
numbered AS (
  SELECT conv, turn, text, i, string_split_regex(text, '\r?\n')[i] AS line, string_split_regex(text, '\r?\n')[i + 1] AS next_line
  FROM messages, LATERAL (SELECT unnest(range(1, len(string_split_regex(text, '\r?\n')) + 1)) AS i)),
parsed AS (
  SELECT conv, turn, text, i, line,
    length(regexp_replace(regexp_extract(line, '^([ \t]*>)*'), '[^>]', '', 'g')) AS level,
    regexp_matches(line, '(?i)\bwrote:[ \t]*$')
      AND COALESCE(length(regexp_replace(regexp_extract(next_line, '^([ \t]*>)*'), '[^>]', '', 'g')), 0) > 0 AS attribution,
    trim(regexp_replace(lower(regexp_replace(line, '^([ \t]*>)*', '')), '[ \t\x0B\f\r]+', ' ', 'g')) AS norm
  FROM numbered),
runs AS (
  SELECT *, sum((norm = '' OR COALESCE(before, -1) <> level)::INT) OVER (PARTITION BY conv, turn, text ORDER BY i) AS run
  FROM (SELECT *, lag(level) OVER (PARTITION BY conv, turn, text ORDER BY i) AS before FROM parsed)),
quoted AS (SELECT * FROM runs WHERE level > 0 AND norm <> '' AND conv IS NOT NULL AND turn IS NOT NULL),
quotes AS (
  SELECT conv, turn, text, level, string_agg(norm, ' ' ORDER BY i) AS piece FROM quoted GROUP BY conv, turn, text, level, run
  UNION ALL SELECT conv, turn, text, level, norm FROM quoted),
own AS (
  SELECT conv, turn, text, i, norm, sum((norm = '')::INT) OVER (PARTITION BY conv, turn, text ORDER BY i) AS run
  FROM parsed WHERE level = 0 AND NOT attribution AND conv IS NOT NULL AND turn IS NOT NULL),
units AS (
  SELECT conv, turn, string_agg(norm, ' ' ORDER BY i) AS piece FROM own WHERE norm <> '' GROUP BY conv, turn, text
  UNION SELECT conv, turn, string_agg(norm, ' ' ORDER BY i) FROM own WHERE norm <> '' GROUP BY conv, turn, text, run
  UNION SELECT conv, turn, norm FROM own WHERE norm <> ''),
linked AS (
  SELECT q.conv, q.turn, q.text, q.level, length(q.piece) AS weight,
    (SELECT max(u.turn) FROM units u WHERE u.conv = q.conv AND u.piece = q.piece AND u.turn < q.turn) AS source
  FROM quotes q),
votes AS (
  SELECT conv, turn, text, level, source, sum(weight) AS weight FROM linked WHERE source IS NOT NULL GROUP BY ALL),
reply AS (
  SELECT conv, turn, text, source AS reply_to FROM votes
  QUALIFY row_number() OVER (PARTITION BY conv, turn, text ORDER BY level, weight DESC, source DESC) = 1),
parents AS (SELECT conv, turn, max(reply_to) AS up FROM reply GROUP BY conv, turn),
chain AS (
  SELECT conv, turn, up AS thread, 1::BIGINT AS depth FROM parents
  UNION ALL SELECT c.conv, c.turn, p.up, c.depth + 1 FROM chain c JOIN parents p ON p.conv = c.conv AND p.turn = c.thread),
roots AS (SELECT conv, turn, min(thread) AS thread, max(depth) AS depth FROM chain GROUP BY conv, turn),
bodies AS (
  SELECT conv, turn, text, regexp_replace(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (level = 0 AND NOT attribution), ''), '^\s+|\s+$', '', 'g') AS clean,
    count(*) FILTER (level > 0) AS n_quotes, max(level) AS max_level FROM parsed GROUP BY conv, turn, text)
SELECT m.conv_id, m.turn, m.role, CASE WHEN COALESCE(b.n_quotes, 0) > 0 THEN b.clean ELSE m.text END AS body,
  COALESCE(b.n_quotes, 0) AS n_quotes, COALESCE(b.max_level, 0)::BIGINT AS max_level, COALESCE(r.reply_to, m.turn) AS reply_to,
  COALESCE(t.thread, m.turn) AS thread, COALESCE(t.depth, 0) AS depth
FROM conversations m
LEFT JOIN bodies b ON b.conv IS NOT DISTINCT FROM m.conv_id AND b.turn IS NOT DISTINCT FROM m.turn AND b.text = m.text
LEFT JOIN reply r ON r.conv = m.conv_id AND r.turn = m.turn AND r.text = m.text
LEFT JOIN roots t ON r.reply_to IS NOT NULL AND t.conv = m.conv_id AND t.turn = m.turn
"""

# the windows as joined words, equal ones joined; rows are numbered, since ids may repeat
ORACLES["op13_decontaminate"] = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(words[i:i + m - 1], ' ') AS key
  FROM (SELECT item_id, words, least(10, len(words)) AS m, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM items WHERE len(words) > 0)),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
grams AS (
  SELECT rid, m, i, array_to_string(words[i:i + m - 1], ' ') AS key
  FROM (SELECT rid, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(words) >= m)),
found AS (SELECT DISTINCT g.rid, g.m, g.i, w.item_id FROM grams g JOIN windows w ON g.m = w.m AND g.key = w.key),
hits AS (SELECT rid, count(DISTINCT i) AS n FROM (SELECT rid, unnest(range(i, i + m)) AS i FROM found) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, len(d.words) AS n_words, COALESCE(h.n, 0) AS n_hit, COALESCE(x.n, 0) AS n_items,
  sha256(COALESCE(x.ids, '')) AS items_sha256, COALESCE(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON d.rid = h.rid LEFT JOIN named x ON d.rid = x.rid
"""
