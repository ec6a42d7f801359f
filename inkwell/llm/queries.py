"""Queries of this subpackage over the tables of a folder, for the driver, and SQL for those that have it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import encode_corpus, mixture, neighbours, residue, shared_spans, split_items, standing_lines, token_budget
from inkwell.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    cut = split_items.archive_pieces(table(spark, d, "corpus"), table(spark, d, "chunks"))
    return cut.where("size(pieces) > 1").select("item_kind", "item_id", "pos")


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    cut = split_items.archive_pieces(table(spark, d, "corpus"), table(spark, d, "chunks"))
    return cut.selectExpr("item_kind", "item_id", "pos", "posexplode(pieces) AS (piece_no, piece)").selectExpr("item_kind", "item_id", "pos", "piece_no", "piece.start AS piece_start", "piece.end AS piece_end", "piece.text AS text")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.shared_spans(table(spark, d, "chunks"))


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.shared_shares(table(spark, d, "chunks"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return standing_lines.standing_places(table(spark, d, "blocks"))


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    return standing_lines.without_standing_lines(table(spark, d, "blocks"))


def p4_budget(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.chunk_budget(table(spark, d, "chunks"), table(spark, d, "journals"))


def p4_update(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.chunk_deltas(table(spark, d, "chunks"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.neighbour_pairs(neighbours.neighbours(table(spark, d, "vectors")))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus.encode_corpus(table(spark, d, "documents"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return mixture.mix_report(mixture.mix(table(spark, d, "documents"), targets), targets)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.classify(table(spark, d, "documents"), True)


def p8_clean(spark: SparkSession, d: str) -> DataFrame:
    return residue.classify(table(spark, d, "documents"), False, keep=("source", "title", "text"))


def p8_validation(spark: SparkSession, d: str) -> DataFrame:
    return residue.validation(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_pieces, p2_found, p2_shares, p3_found, p3_clean, p4_budget, p4_update, p5_found, p6_ids, p7_mix, p7_shares, p8_found, p8_clean, p8_validation)}


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p2_found": P2_FOUND, "p2_shares": P2_SHARES, "p3_found": P3_FOUND, "p3_clean": P3_CLEAN, "p5_found": P5_FOUND}


P1_FOUND = r"""
WITH a AS (SELECT article_id, full_text_paragraphs AS p, row_number() OVER (PARTITION BY article_id ORDER BY ingested_at DESC NULLS LAST) AS n
           FROM corpus WHERE article_id IS NOT NULL),
     b AS (SELECT article_id, unnest(p) AS x, unnest(range(len(p))) AS i FROM a WHERE n = 1),
     c AS (SELECT chunk_id, text, row_number() OVER (PARTITION BY chunk_id ORDER BY ingested_at DESC NULLS LAST) AS n
           FROM chunks WHERE chunk_id IS NOT NULL)
SELECT 'paragraph' AS item_kind, article_id AS item_id, CAST(i AS INTEGER) AS pos FROM b WHERE length(x.text) > 1200
UNION ALL
SELECT 'chunk', chunk_id, CAST(0 AS INTEGER) FROM c WHERE n = 1 AND length(text) > 1200
"""

P3_FOUND = r"""
WITH b AS (SELECT DISTINCT journal, year, issue, page, block_id, text FROM blocks),
     l AS (SELECT journal, year, issue, page, block_id, unnest(s) AS line, unnest(range(len(s))) AS line_no
           FROM (SELECT *, string_split_regex(text, '\r\n|\n') AS s FROM b WHERE text IS NOT NULL)),
     k AS (SELECT *, regexp_replace(lower(upper(trim(regexp_replace(line, '[ \t\x{00A0}\x{2009}]+', ' ', 'g'), ' '))), '[0-9]+', '0', 'g') AS key FROM l),
     n AS (SELECT journal, count(*) AS pages FROM (SELECT DISTINCT journal, year, issue, page FROM blocks) GROUP BY journal),
     s AS (SELECT k.journal, k.key, count(DISTINCT (k.year, k.issue, k.page)) AS c, any_value(n.pages) AS pages
           FROM k JOIN n ON k.journal = n.journal WHERE k.key <> '' GROUP BY k.journal, k.key)
SELECT DISTINCT k.journal, k.year, k.issue, k.page, k.block_id, CAST(k.line_no AS INTEGER) AS line_no
FROM k JOIN s ON k.journal = s.journal AND k.key = s.key WHERE s.c >= 3 AND s.c >= 0.05 * s.pages
"""

P3_CLEAN = f"""
WITH f AS ({P3_FOUND}),
     g AS (SELECT journal, year, issue, page, block_id, list(line_no) AS gone FROM f GROUP BY ALL),
     t AS (SELECT journal, year, issue, page, block_id, text,
                  row_number() OVER (PARTITION BY journal, year, issue, page, block_id ORDER BY extracted_at DESC NULLS LAST, text DESC NULLS LAST) AS n FROM blocks),
     s AS (SELECT t.*, coalesce(g.gone, []) AS gone, string_split_regex(t.text, '\\r\\n|\\n') AS lines, regexp_extract_all(t.text, '\\r\\n|\\n') AS breaks
           FROM t LEFT JOIN g ON t.journal IS NOT DISTINCT FROM g.journal AND t.year IS NOT DISTINCT FROM g.year AND t.issue IS NOT DISTINCT FROM g.issue AND t.page = g.page AND t.block_id = g.block_id
           WHERE t.n = 1),
     k AS (SELECT *, coalesce(array_to_string(list_transform(list_filter(range(len(lines)), lambda i: NOT list_contains(gone, i)), lambda i: lines[i + 1] || coalesce(breaks[i + 1], '')), ''), '') AS kept FROM s)
SELECT journal, year, issue, page, block_id,
       CASE WHEN len(gone) = 0 THEN text WHEN list_contains(gone, len(lines) - 1) THEN regexp_replace(kept, '\\r?\\n\\z', '') ELSE kept END AS text,
       CAST(len(gone) AS INTEGER) AS n_removed
FROM k
"""

P2_FOUND = """
WITH c AS (SELECT chunk_id, text FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY ingested_at DESC NULLS LAST) AS n FROM chunks WHERE chunk_id IS NOT NULL) WHERE n = 1),
     w AS (SELECT chunk_id, i, substring(text, i + 1, 200) AS s FROM (SELECT chunk_id, text, unnest(range(length(text) - 199)) AS i FROM c WHERE length(text) >= 200)),
     k AS (SELECT s FROM w GROUP BY s HAVING min(chunk_id) <> max(chunk_id)),
     h AS (SELECT chunk_id, i, lag(i) OVER (PARTITION BY chunk_id ORDER BY i) AS p FROM w SEMI JOIN k USING (s)),
     r AS (SELECT chunk_id, i, sum(CASE WHEN p IS NULL OR i > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY chunk_id ORDER BY i) AS run FROM h)
SELECT chunk_id, CAST(min(i) AS INTEGER) AS span_start, CAST(max(i) + 200 AS INTEGER) AS span_end FROM r GROUP BY chunk_id, run
"""

P2_SHARES = f"""
WITH f AS ({P2_FOUND}),
     g AS (SELECT chunk_id, sum(span_end - span_start) AS n FROM f GROUP BY chunk_id),
     t AS (SELECT chunk_id, coalesce(length(text), 0) AS n_chars FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY ingested_at DESC NULLS LAST) AS n FROM chunks WHERE chunk_id IS NOT NULL) WHERE n = 1)
SELECT chunk_id, CAST(n_chars AS INTEGER) AS n_chars, CAST(coalesce(g.n, 0) AS BIGINT) AS n_shared, coalesce(coalesce(g.n, 0) / nullif(n_chars, 0), 0.0) AS share FROM t LEFT JOIN g USING (chunk_id)
"""

#: Exact; on tables of a few thousand vectors the operator's candidates hold all that matter.
P5_FOUND = """
WITH v AS (SELECT chunk_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM (
         SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY embedded_at DESC NULLS LAST) AS n FROM vectors WHERE chunk_id IS NOT NULL AND len(embedding) = 64
         AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0) WHERE n = 1),
     u AS (SELECT chunk_id, e, sqrt(list_dot_product(e, e)) AS l FROM v),
     r AS (SELECT a.chunk_id AS x, b.chunk_id AS y, row_number() OVER (PARTITION BY a.chunk_id ORDER BY round(list_dot_product(a.e, b.e) / (a.l * b.l), 9) DESC, b.chunk_id) AS n FROM u a JOIN u b ON a.chunk_id <> b.chunk_id)
SELECT DISTINCT least(x, y) AS chunk_a, greatest(x, y) AS chunk_b FROM r WHERE n <= 5
"""
