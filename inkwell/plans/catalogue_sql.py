"""The queries of the catalogue as SQL for another engine, over the same tables.

Pieces that several queries share are common table expressions, put together by with_.
"""

from __future__ import annotations

from inkwell.functions.fonts import STYLE_WORDS
from inkwell.functions.labels import ROMAN

WS = r"[\t\n\x0B\f\r \x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NWS = WS.replace("[", "[^", 1)
W = r"[\p{L}\p{M}\p{N}_]"
CAPS = "A-ZÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ"
SIZE = "round_even(font_size * 2, 0) / 2"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def clean(x: str) -> str:
    return strip(rf"regexp_replace(regexp_replace({x}, '[\x00-\x1f\x7f]', ' ', 'g'), '{WS}+', ' ', 'g')")


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> '')"


def family(x: str) -> str:
    return rf"regexp_replace(regexp_replace(coalesce({x}, ''), '^[A-Z]{{6}}\+', ''), '(?i)[-,](?:[0-9]+pt)?(?:{'|'.join(STYLE_WORDS)})+.*$', '')"


def roman(n: str) -> str:
    def digit(place: int, one: str, five: str, ten: str) -> str:
        forms = ["", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten]
        return f"[{', '.join(repr(x) for x in forms)}][1 + ({n} // {place}) % 10]"

    return f"(repeat('M', CAST({n} // 1000 AS INTEGER)) || {digit(100, 'C', 'D', 'M')} || {digit(10, 'X', 'L', 'C')} || {digit(1, 'I', 'V', 'X')})"


def match_key(x: str) -> str:
    return strip(f"regexp_replace(lower({strip(x)}), '^(?:recenze:|k výuce:|upoutávka na knihu:|zaujalo nás:|biozvěst:)', '')")


def shingles(x: str) -> str:
    return f"list_transform(range(1, greatest(length({x}) - 13, 1)), lambda i: substring({x}, i, 15))"


def same_title(a: str, b: str) -> str:
    """Of match keys."""
    return f"({a} <> '' AND {b} <> '' AND (contains({a}, {b}) OR contains({b}, {a}) OR list_has_any({shingles(a)}, {shingles(b)})))"


def roman_values() -> str:
    """(label, v) of the roman labels, the largest symbols taken first."""
    q = "SELECT label, upper(label) AS r, 0 AS v FROM (SELECT DISTINCT label FROM lab WHERE NOT regexp_matches(label, '^[0-9]+$'))"
    for symbol, value in ROMAN:
        taken = f"length(regexp_extract(r, '^(?:{symbol})*'))"
        q = f"SELECT label, substring(r, 1 + {taken}) AS r, v + {value} * ({taken} // {len(symbol)}) AS v FROM ({q})"
    return q


ISSUE = "journal, year, issue"
ON = "USING (journal, year, issue)"

CTE = {
    "b": "SELECT DISTINCT journal, year, issue, page, block_id, type, text, font, font_size, bbox[1] AS x0, bbox[2] AS y0, bbox[3] AS x1, bbox[4] AS y1 FROM blocks",
    "a": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY ingested_at DESC) AS rn FROM corpus) WHERE rn = 1",
    "c": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY ingested_at DESC NULLS LAST, chunk_type DESC NULLS LAST, chunk_index DESC NULLS LAST, title DESC NULLS LAST, author DESC NULLS LAST, page_start DESC NULLS LAST, page_end DESC NULLS LAST, lang DESC NULLS LAST, text DESC NULLS LAST, embedding_text DESC NULLS LAST) AS rn FROM chunks) WHERE rn = 1",
    "stats": f"""SELECT journal, year, issue, CASE WHEN max(n) > 0 THEN arg_max(family, k) ELSE '' END AS body_family,
        CASE WHEN max(n) > 0 THEN coalesce(nullif(arg_max(size, k), 0.0), 10.0) ELSE 10.0 END AS body_size
        FROM (SELECT *, (n, -page, -block_id) AS k FROM (
            SELECT journal, year, issue, family, size, sum(n) AS n, arg_min(page, (page, block_id)) FILTER (n > 0) AS page, arg_min(block_id, (page, block_id)) FILTER (n > 0) AS block_id
            FROM (SELECT journal, year, issue, page, block_id, {family('font')} AS family, {SIZE} AS size, coalesce(length({strip('text')}), 0) AS n FROM b)
            GROUP BY ALL) WHERE n > 0) GROUP BY ALL""",
    "lab": f"""SELECT journal, year, issue, page, arg_min(label, block_id) AS label FROM (
        SELECT journal, year, issue, page, block_id, list_filter({words('text')}, lambda w: NOT contains(w, '/') AND regexp_matches(w, '^([0-9]{{1,4}}|[IVXLCDMivxlcdm]{{1,10}})$'))[1] AS label
        FROM b WHERE font_size < 10 AND y0 >= 0 AND len({words('text')}) <= 1) WHERE label IS NOT NULL GROUP BY ALL""",
    "rv": roman_values(),
    "runs": """SELECT journal, year, issue, run, any_value(scheme) AS scheme, any_value(page - value) AS "offset", min(value) AS value_min, max(value) AS value_max FROM (
        SELECT *, sum(new) OVER (PARTITION BY journal, year, issue ORDER BY page) AS run FROM (
            SELECT *, CASE WHEN page - value = lag(page - value) OVER w AND scheme = lag(scheme) OVER w THEN 0 ELSE 1 END AS new FROM (
                SELECT journal, year, issue, page, 'arabic' AS scheme, CAST(label AS INTEGER) AS value FROM lab WHERE regexp_matches(label, '^[0-9]+$')
                UNION ALL SELECT journal, year, issue, page, 'roman', v FROM lab JOIN rv USING (label))
            WINDOW w AS (PARTITION BY journal, year, issue ORDER BY page))) GROUP BY journal, year, issue, run""",
    "last": "SELECT journal, year, issue, max(page) AS last_page FROM b GROUP BY ALL",
    "ext": """SELECT journal, year, issue, run, scheme, "offset", value_min - greatest(0, least(5, before - taken, value_min - 1)) AS value_min, value_max + greatest(0, least(5, after, last_page - last)) AS value_max FROM (
        SELECT *, CASE WHEN prev IS NULL THEN 0 ELSE least(5, before) END AS taken FROM (
            SELECT *, lag(last) OVER w AS prev, first - coalesce(lag(last) OVER w, 0) - 1 AS before, coalesce(lead(first) OVER w - 1, last_page) - last AS after
            FROM (SELECT *, value_min + "offset" AS first, value_max + "offset" AS last FROM runs JOIN last """ + ON + """)
            WINDOW w AS (PARTITION BY journal, year, issue ORDER BY first, run)))""",
    "map": f"""SELECT journal, year, issue, label, arg_max(page, (run, page)) AS page FROM (SELECT journal, year, issue, run, CASE WHEN scheme = 'arabic' THEN CAST(v AS VARCHAR) ELSE {roman('v')} END AS label, CAST(v + "offset" AS INTEGER) AS page
        FROM (SELECT *, unnest(range(value_min, value_max + 1)) AS v FROM ext)) GROUP BY ALL""",
    "toc": "SELECT DISTINCT journal, year, issue, CAST(regexp_extract(article_id, '([0-9]+)$', 1) AS INTEGER) AS toc_pos, printed_page_start AS printed_page, title, author FROM corpus WHERE title IS NOT NULL",
    "tl": "SELECT *, CAST(CAST(printed_page AS INTEGER) AS VARCHAR) AS label FROM toc",
    "res": "SELECT journal, year, issue, toc_pos, printed_page, title, author, page AS pdf_page_start FROM tl JOIN map USING (journal, year, issue, label)",
    "rng": """SELECT e.*, coalesce(g.next - 1, last.last_page) AS pdf_page_end FROM (
        SELECT *, row_number() OVER (PARTITION BY journal, year, issue, group_no ORDER BY toc_pos) - 1 AS in_group FROM (
            SELECT *, dense_rank() OVER (PARTITION BY journal, year, issue ORDER BY pdf_page_start) - 1 AS group_no FROM res)) e
        JOIN (SELECT journal, year, issue, pdf_page_start, lead(pdf_page_start) OVER (PARTITION BY journal, year, issue ORDER BY pdf_page_start) AS next FROM (SELECT DISTINCT journal, year, issue, pdf_page_start FROM res)) g
        USING (journal, year, issue, pdf_page_start) JOIN last """ + ON,
    "pg": "SELECT journal, year, issue, group_no, pdf_page_start AS start, unnest(range(pdf_page_start, pdf_page_end + 1)) AS page FROM (SELECT DISTINCT journal, year, issue, group_no, pdf_page_start, pdf_page_end FROM rng)",
    "ord": """SELECT *, row_number() OVER (PARTITION BY journal, year, issue, page ORDER BY xr IS NULL, column_no NULLS FIRST, y0 NULLS FIRST, block_id) - 1 AS reading_pos FROM (
        SELECT *, sum(jump) OVER (PARTITION BY journal, year, issue, page ORDER BY xr NULLS FIRST) AS column_no FROM (
            SELECT *, CASE WHEN xr - lag(xr) OVER (PARTITION BY journal, year, issue, page ORDER BY xr NULLS FIRST) > 40 THEN 1 ELSE 0 END AS jump FROM (SELECT *, round_even(x0, 0) AS xr FROM src)))""",
    "v": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY embedded_at DESC) AS rn FROM vectors WHERE len(embedding) = 64) WHERE rn = 1",
    "ve": """SELECT chunk_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM v WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0""",
    "qs": "SELECT journal AS query_id, arg_min(chunk_id, chunk_id) AS chunk_id FROM c JOIN v USING (chunk_id) GROUP BY journal",
    "hits": """SELECT query_id, CAST(rank AS INTEGER) AS rank, chunk_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM (
        SELECT query_id, a.chunk_id, round(1 - list_dot_product(a.e, q.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(q.e, q.e))), 9) + 0.0 AS distance
        FROM ve a CROSS JOIN (SELECT query_id, e FROM qs JOIN ve USING (chunk_id)) q)) WHERE rank <= 10""",
    "es": "SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings",
}
_NEEDS = {"ve": ["v"], "qs": ["c", "v"], "hits": ["c", "v", "ve", "qs"], "stats": ["b"], "lab": ["b"], "runs": ["b", "lab", "rv"], "last": ["b"], "ext": ["b", "lab", "rv", "runs", "last"], "map": ["b", "lab", "rv", "runs", "last", "ext"], "tl": ["toc"], "res": ["b", "lab", "rv", "runs", "last", "ext", "map", "toc", "tl"],
          "rng": ["b", "lab", "rv", "runs", "last", "ext", "map", "toc", "tl", "res"], "pg": ["b", "lab", "rv", "runs", "last", "ext", "map", "toc", "tl", "res", "rng"]}


def with_(*names: str, **more: str) -> str:
    """WITH of the named expressions and all they need, then of those given."""
    order: list[str] = []
    for n in names:
        order += [x for x in [*_NEEDS.get(n, []), n] if x not in order]
    every = {n: CTE[n] for n in order} | more
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in every.items()) + " "


NUMBER = r"-?[0-9]+[.,]?[0-9]*"
T = strip("coalesce(text, '')")
TOK = words("t")
LABEL = rf"""(t <> '' AND (regexp_matches(t, '(?i)^([0-9.,]+\s*(mm|cm|km|μm|µm|nm|m)\s*)+$') OR regexp_matches(t, '^\[[^\[\]]{{1,6}}\]$')
    OR len(list_filter(w, lambda x: NOT regexp_matches(x, '^{NUMBER}\.?$'))) = 0
    OR len(list_filter(w, lambda x: NOT (regexp_matches(x, '^{NUMBER}([–-]{NUMBER})?$') OR lower(x) IN ('do', 'nad', 'pod', 'až')))) = 0
    OR len(list_filter(w, lambda x: length(regexp_replace(x, '\.+$', '')) <> 1)) = 0))"""
CAPTION = rf"(length(t) > 20 AND regexp_matches(t, '^[0-9]+(?:\s*(?:a|až|,|-|–)\s*[0-9]+)*\s+[{CAPS}]'))"
LINES = f"SELECT *, {T} AS t, {words(T)} AS w, contains(lower(coalesce(font, '')), 'bold') AS bold, regexp_replace(coalesce(font, ''), '^[A-Z]{{6}}\\+', '') AS plain FROM b"
ABSOLUTE = f"""CASE WHEN starts_with(plain, 'Serifa') THEN CASE WHEN font_size >= 18 AND bold THEN 'title' WHEN font_size >= 12 AND font_size <= 18 AND bold THEN 'heading' WHEN font_size >= 11.5 AND font_size <= 12.5 AND NOT bold THEN 'other' ELSE 'body' END
    WHEN starts_with(plain, 'Grota') THEN CASE WHEN font_size = 7 THEN 'other' WHEN {LABEL} THEN 'annotation' ELSE 'caption' END ELSE 'body' END"""
RATIO = "coalesce(font_size / body_size, 1.0)"
RELATIVE = f"""CASE WHEN same AND {RATIO} >= 1.7 THEN 'title' WHEN same AND {RATIO} >= 1.18 AND {RATIO} <= 1.7 THEN 'heading' WHEN same AND bold AND {RATIO} >= 0.95 AND {RATIO} <= 1.18 THEN 'heading'
    WHEN NOT same AND {RATIO} >= 2.2 THEN 'title' WHEN same THEN 'body' WHEN {LABEL} THEN 'annotation' ELSE 'caption' END"""
COS = "list_dot_product(a.e, q.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(q.e, q.e)))"
TOPK = f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, chunk_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM (
    SELECT q.vec_id AS query_id, CAST(a.vec_id AS VARCHAR) AS chunk_id, round(1 - {COS}, 9) + 0.0 AS distance FROM es a CROSS JOIN (SELECT * FROM es WHERE vec_id %% 100 = 0) q WHERE true %s)) WHERE rank <= %d"""
PAGES = "CASE WHEN page_start = page_end THEN 'PDF p. ' || page_start ELSE 'PDF pp. ' || page_start || '-' || page_end END"
JUNK = f"(coalesce(font_size < 10 AND height > 0 AND (y0 >= 0 OR y1 <= 0.08 * height) AND len({words('text')}) <= 1, false) OR coalesce(regexp_matches(text, '^{WS}*\\p{{Nd}}+{WS}*$') AND x1 - x0 < 15 AND y1 - y0 < 15, false))"
AUTHOR = "coalesce(nullif(author, ''), 'unknown')"
LAB_TITLE = "concat_ws('-', nullif(journal, ''), nullif(year, ''), nullif(issue, ''))"

#: k: the pairs of styles that are at least two fifths as frequent as the most frequent.
TWO_STYLES = """, pairs AS (SELECT journal, year, issue, 'Serifa' AS family, CASE WHEN toc_pos % 3 = 0 THEN 8.0 ELSE 9.0 END::DOUBLE AS size, CASE WHEN toc_pos % 3 = 0 THEN 8.0 ELSE 9.0 END::DOUBLE AS text_size FROM toc WHERE printed_page IS NOT NULL
    UNION ALL SELECT journal, year, issue, 'Okraj', 30.0, 14.0 FROM toc WHERE toc_pos % 5 = 0),
    k AS (SELECT journal, year, issue, family, size, text_size FROM (SELECT *, max(n) OVER (PARTITION BY journal, year, issue) AS best FROM (SELECT *, count(*) AS n FROM pairs GROUP BY ALL)) WHERE n >= 0.4 * best) """

BOUNDARY_CUTS = f"""SELECT journal, year, issue, group_no, page, coalesce(arg_min(y0, reading_pos) FILTER (by_author), arg_min(y0, reading_pos) FILTER (by_title)) AS split_y FROM (
        SELECT f.*, o.y0, o.reading_pos, coalesce(o.type = 'other' AND {same_title('f.ka', 'o.k')}, false) AS by_author, coalesce(o.type IN ('title', 'heading') AND {same_title('f.kt', 'o.k')}, false) AS by_title
        FROM (SELECT journal, year, issue, group_no, pdf_page_start AS page, {match_key('title')} AS kt, {match_key("coalesce(author, '')")} AS ka FROM rng WHERE in_group = 0 AND group_no > 0) f
        LEFT JOIN (SELECT *, {match_key('text')} AS k FROM ord WHERE type IN ('other', 'title', 'heading')) o USING (journal, year, issue, page)) GROUP BY ALL"""

SQL: dict[str, str] = {
    "clean_text": f"SELECT doc_id, md5({clean('text')}) AS cleaned FROM documents",
    "word_breaks": with_("b") + rf"""SELECT journal, count(*) FILTER (regexp_matches(left(text, 30), '{W}{WS}*$') AND regexp_matches(substring(text, 31), '^{WS}*\p{{Ll}}')) AS n, count(*) AS n_blocks
        FROM b WHERE length(text) > 30 GROUP BY journal""",
    "font_styles": with_("b") + f"SELECT {family('font')} AS family, {SIZE} AS size, contains(lower(coalesce(font, '')), 'bold') AS bold, count(*) AS n FROM b GROUP BY ALL",
    "figure_labels": with_("b") + f"SELECT journal, count(*) FILTER ({LABEL}) AS n_labels, count(*) FILTER ({CAPTION}) AS n_captions FROM ({LINES}) GROUP BY journal",
    "roman_round_trip": with_("b") + f"SELECT n, {roman('n')} AS roman, n AS value FROM (SELECT DISTINCT page AS n FROM b)",
    "canonical_labels": with_("a") + "SELECT article_id, CAST(CAST(printed_page_start AS INTEGER) AS VARCHAR) AS label, printed_page_start AS first_page FROM a",
    "sentence_counts": rf"SELECT doc_id, 1 + len(regexp_extract_all(regexp_replace(text, '([.!?]){WS}+([{CAPS}])', '\1' || chr(1) || '\2', 'g'), chr(1))) AS n_sentences FROM documents WHERE text IS NOT NULL",
    "title_matches": with_("b", "toc") + f"""SELECT h.journal, h.year, h.issue, h.page, h.block_id, t.toc_pos FROM (SELECT *, {match_key('text')} AS k FROM b WHERE type IN ('title', 'heading')) h
        JOIN (SELECT *, {match_key('title')} AS m FROM toc) t {ON} WHERE {same_title('t.m', 'h.k')}""",
    "token_totals": with_("c") + "SELECT journal, sum(CAST(round_even(coalesce(length(text), 0) / 2.3, 0) AS BIGINT)) AS est_tokens, sum(CAST(round_even(coalesce(length(embedding_text), 0) / 2.3, 0) AS BIGINT)) AS est_embedding_tokens FROM c GROUP BY journal",
    "document_stats": with_("stats") + "SELECT * FROM stats",
    "classify_absolute": with_("b") + f"SELECT journal, type, CASE WHEN k = 'body' AND {CAPTION} THEN 'caption' ELSE k END AS new_type, count(*) AS n FROM (SELECT *, {ABSOLUTE} AS k FROM ({LINES})) GROUP BY ALL",
    "classify_adaptive": with_("b", "stats") + f"SELECT journal, type, CASE WHEN k = 'body' AND {CAPTION} THEN 'caption' ELSE k END AS new_type, count(*) AS n FROM (SELECT *, {RELATIVE} AS k FROM (SELECT *, {family('font')} = body_family AS same FROM ({LINES}) JOIN stats {ON})) GROUP BY ALL",
    "style_histogram": with_("b") + f"""SELECT *, round(chars / sum(chars) OVER (PARTITION BY journal, year, issue), 6) AS share FROM (
        SELECT journal, year, issue, {family('font')} AS family, {SIZE} AS size, contains(lower(coalesce(font, '')), 'bold') AS bold, sum(length({T})) AS chars FROM b WHERE length({T}) > 0 GROUP BY ALL)""",
    "dominant_font": with_("b") + """SELECT journal, year, issue, page, arg_max_null(font, (n, -pos)) AS font, arg_min(size, pos) AS size FROM (
        SELECT journal, year, issue, page, font, coalesce(sum(length(text)), 0) AS n, min(block_id) AS pos, arg_min(font_size, block_id) AS size FROM b GROUP BY ALL) GROUP BY ALL""",
    "footer_candidates": with_("b") + f"""SELECT journal, CAST(place AS INTEGER) AS place, line, n_pages FROM (
        SELECT *, row_number() OVER (PARTITION BY journal ORDER BY n_pages DESC, line) AS place FROM (SELECT journal, {strip('text')} AS line, count(DISTINCT (year, issue, page)) AS n_pages
            FROM (SELECT *, max(y1) OVER (PARTITION BY journal, year, issue, page) AS height FROM b) WHERE {strip('text')} <> '' AND (y0 >= 0.9 * height OR y1 <= 0.1 * height) AND font_size < 12 AND len({words('text')}) <= 6 GROUP BY ALL))
        JOIN (SELECT journal, count(DISTINCT (year, issue, page)) AS pages FROM b GROUP BY ALL) USING (journal) WHERE place <= 20 AND n_pages >= 3 AND n_pages >= pages * 0.1""",
    "style_samples": with_("b") + f"""SELECT journal, year, issue, family, size, bold, CAST(no AS INTEGER) AS no, CASE WHEN length(t) > 60 THEN left(t, 60) || '...' ELSE t END AS text FROM (
        SELECT *, row_number() OVER (PARTITION BY journal, year, issue, family, size, bold ORDER BY page, block_id) AS no FROM (
            SELECT journal, year, issue, page, block_id, {family('font')} AS family, {SIZE} AS size, contains(lower(coalesce(font, '')), 'bold') AS bold, {T} AS t FROM b WHERE length({T}) > 0)) WHERE no <= 3""",
    "issues_in_order": "SELECT journal, year, issue, CAST(row_number() OVER (PARTITION BY journal, year ORDER BY TRY_CAST(issue AS INTEGER) NULLS LAST, issue) AS INTEGER) AS place FROM (SELECT DISTINCT journal, year, issue FROM blocks)",
    "flagged_share": with_("a", "c") + f"""SELECT count(*) AS articles, count(*) FILTER (len(quality_flags) > 0) AS flagged, count(*) FILTER (full_text IS NULL OR NOT regexp_matches(full_text, '{NWS}')) AS empty, CAST(coalesce(sum(n), 0) AS BIGINT) AS chunks,
        CAST(coalesce(sum(n) FILTER (len(quality_flags) > 0), 0) AS BIGINT) AS flagged_chunks, round(100 * coalesce(sum(n) FILTER (len(quality_flags) > 0), 0) / sum(n), 4) AS percent FROM a LEFT JOIN (SELECT article_id, count(*) AS n FROM c GROUP BY ALL) USING (article_id)""",
    "numbered_pages": with_("b") + f"""SELECT *, CASE WHEN with_number >= 0.4 * pages THEN 'position' ELSE 'keyword' END AS advice FROM (SELECT journal, count(*) AS pages, count(*) FILTER (bare) AS with_number FROM (
        SELECT journal, year, issue, page, bool_or(coalesce(regexp_matches(text, '^{WS}*[0-9]{{1,4}}{WS}*$'), false)) AS bare FROM b GROUP BY ALL) GROUP BY journal)""",
    "suggested_rules": with_("stats") + "SELECT journal, year, issue, body_family AS family, body_size AS body, round(body_size * 1.7, 1) AS title_from, round(body_size * 1.18, 1) AS heading_from, round(body_size * 1.05, 1) AS subheading_from, round(body_size * 3.0, 1) AS cover_from FROM stats",
    "junk_blocks": with_("b") + f"""SELECT journal, count(*) FILTER (coalesce(font_size < 10 AND (y0 >= 0 OR y1 <= 80) AND len({words('text')}) <= 1, false)
        OR coalesce(regexp_matches(text, '^{WS}*\\p{{Nd}}+{WS}*$') AND x1 - x0 < 15 AND y1 - y0 < 15, false)) AS n_junk, count(*) AS n FROM b GROUP BY journal""",
    "marked_blocks": with_("b") + f"""SELECT journal, count(*) FILTER (coalesce(font_size < 10 AND (y0 >= 0 OR y1 <= 80) AND len({words('text')}) <= 1, false)
        OR coalesce(regexp_matches(text, '^{WS}*\\p{{Nd}}+{WS}*$') AND x1 - x0 < 15 AND y1 - y0 < 15, false) OR coalesce(contains(text, '.example') AND contains(text, '1'), false)) AS n_junk,
        count(*) FILTER (coalesce(regexp_matches(text, '(?i)^[a-z]+ [a-z]+ '), false) OR {ABSOLUTE} = 'body') AS n_body FROM ({LINES}) GROUP BY journal""",
    "page_labels": with_("lab") + "SELECT journal, year, issue, page, upper(label) AS label FROM lab",
    "page_labels_keyword": with_("b") + f"""SELECT journal, year, issue, page, arg_min(label, block_id) AS label FROM (SELECT journal, year, issue, page, block_id, upper(list_filter({words('text')}, lambda w: NOT contains(w, '/') AND regexp_matches(w, '^([0-9]{{1,4}}|[IVXLCDMivxlcdm]{{1,10}})$'))[1]) AS label
        FROM b WHERE font_size < 10 AND contains(lower(text), '.example')) WHERE label IS NOT NULL GROUP BY ALL""",
    "page_runs": with_("runs") + "SELECT * FROM runs",
    "extended_runs": with_("ext") + "SELECT * FROM ext",
    "label_to_page": with_("map") + "SELECT * FROM map",
    "unlabelled_pages": with_("map") + "SELECT DISTINCT journal, year, issue, page FROM b ANTI JOIN map USING (journal, year, issue, page)",
    "lone_runs": with_("runs") + "SELECT *, n_lone > greatest(2, n_runs * 0.2) AS suspicious FROM (SELECT journal, year, issue, count(*) AS n_runs, count(*) FILTER (value_min = value_max) AS n_lone FROM runs GROUP BY ALL)",
    "toc_pages": with_("toc") + "SELECT journal, year, issue, 3 AS page, n FROM (SELECT journal, year, issue, count(*) AS n FROM toc WHERE printed_page IS NOT NULL GROUP BY ALL) WHERE n >= 5",
    "toc_style_pairs": with_("toc") + "SELECT journal, year, issue, 'Serifa' AS family, 9.0::DOUBLE AS size, 'Serifa' AS text_family, 9.0::DOUBLE AS text_size, count(*) AS n FROM toc WHERE printed_page IS NOT NULL GROUP BY ALL",
    "toc_entries": with_("toc") + f"""SELECT journal, year, issue, row_number() OVER (PARTITION BY journal, year, issue ORDER BY toc_pos, part) - 1 AS toc_pos, printed_page, title, author FROM (
        SELECT journal, year, issue, toc_pos, printed_page, regexp_replace({strip('part_title')}, '^[ ,;]+|[ ,;]+$', '', 'g') AS title, nullif(regexp_replace({clean('author')}, '^[ ,;]+|[ ,;]+$', '', 'g'), '') AS author, part
        FROM (SELECT *, unnest(string_split({clean('title')}, ';')) AS part_title, generate_subscripts(string_split({clean('title')}, ';'), 1) AS part FROM toc)) WHERE title <> ''""",
    "two_style_pairs": with_("toc") + TWO_STYLES + "SELECT journal, year, issue, family, size, text_size FROM k",
    "two_style_pages": with_("toc") + """SELECT journal, year, issue, CAST(page AS INTEGER) AS page, n FROM (SELECT *, max(n) OVER (PARTITION BY journal, year, issue) AS best FROM (
        SELECT journal, year, issue, page, count(*) AS n FROM (SELECT journal, year, issue, 3 + toc_pos % 2 AS page FROM toc WHERE printed_page IS NOT NULL UNION ALL SELECT journal, year, issue, 5 FROM toc WHERE toc_pos % 5 = 0) GROUP BY ALL)) WHERE best >= 5 AND n >= greatest(5, best * 0.4)""",
    "two_style_entries": with_("toc") + TWO_STYLES + f"""SELECT journal, year, issue, CAST(row_number() OVER (PARTITION BY journal, year, issue ORDER BY page, toc_pos, part) - 1 AS INTEGER) AS toc_pos, printed_page, title, author FROM (
        SELECT journal, year, issue, page, toc_pos, printed_page, regexp_replace({strip('part_title')}, '^[ ,;]+|[ ,;]+$', '', 'g') AS title, nullif(regexp_replace({clean('author')}, '^[ ,;]+|[ ,;]+$', '', 'g'), '') AS author, part
        FROM (SELECT *, unnest(string_split({clean('title')}, ';')) AS part_title, generate_subscripts(string_split({clean('title')}, ';'), 1) AS part FROM (
            SELECT journal, year, issue, 3 + toc_pos % 2 AS page, toc_pos, printed_page, title, author FROM toc JOIN k {ON} WHERE family = 'Serifa' AND size = CASE WHEN toc_pos % 3 = 0 THEN 8.0 ELSE 9.0 END
            UNION ALL SELECT journal, year, issue, 5, toc_pos, '7', 'NEWS', NULL FROM toc JOIN k {ON} WHERE family = 'Okraj' AND toc_pos % 5 = 0))) WHERE title <> ''""",
    "question_hits": with_("hits") + "SELECT * FROM hits",
    "hits_by_article": with_("c", "hits") + "SELECT query_id, article_id, count(*) AS n_hits, min(distance) AS best, count(*) >= 3 AS promoted FROM hits JOIN c USING (chunk_id) GROUP BY ALL",
    "resolved_entries": with_("res") + "SELECT * FROM res",
    "unresolved_entries": with_("map", "toc", "tl") + "SELECT * FROM tl ANTI JOIN map USING (journal, year, issue, label)",
    "nearby_labels": with_("map", "toc", "tl") + "SELECT t.journal, t.year, t.issue, t.toc_pos, t.printed_page, CAST(t.delta AS INTEGER) AS delta, map.page FROM (SELECT *, CAST(CAST(label AS INTEGER) + delta AS VARCHAR) AS near FROM (SELECT *, unnest(range(-3, 4)) AS delta FROM tl)) t JOIN map ON map.journal = t.journal AND map.year = t.year AND map.issue = t.issue AND map.label = t.near WHERE CAST(t.label AS INTEGER) + t.delta > 0",
    "other_families": with_("b", "stats") + f"""SELECT journal, year, issue, CAST(place AS INTEGER) AS place, family, chars FROM (SELECT *, row_number() OVER (PARTITION BY journal, year, issue ORDER BY chars DESC, family) AS place FROM (
        SELECT journal, year, issue, {family('font')} AS family, sum(length({T})) AS chars FROM b WHERE length({T}) > 0 GROUP BY ALL) JOIN stats {ON} WHERE family <> body_family) WHERE place <= 3""",
    "contact_blocks": with_("b") + "SELECT journal, year, issue, page, block_id FROM b WHERE contains(lower(text), '.example')",
    "truncated_texts": with_("c") + "SELECT count(*) AS n, count(*) FILTER (length(embedding_text) > 1500) AS n_truncated, coalesce((SELECT string_agg(chunk_id, ',' ORDER BY chunk_id) FROM (SELECT chunk_id FROM c WHERE length(embedding_text) > 1500 ORDER BY chunk_id LIMIT 5)), '') AS ids FROM c",
    "article_ranges": with_("rng") + "SELECT journal, year, issue, toc_pos, group_no, in_group, pdf_page_start, pdf_page_end FROM rng",
    "blocks_in_ranges": with_("pg") + "SELECT journal, year, issue, group_no, count(*) AS n_blocks FROM b JOIN pg USING (journal, year, issue, page) GROUP BY ALL",
    "boundary_cuts": with_("rng", src=f"SELECT * FROM b JOIN (SELECT journal, year, issue, max(y1) AS height FROM b GROUP BY ALL) {ON} WHERE NOT {JUNK}", ord=CTE["ord"]) + BOUNDARY_CUTS,
    "reading_order": f"WITH src AS ({CTE['b']}), ord AS ({CTE['ord']}) SELECT journal, year, issue, page, block_id, column_no, reading_pos FROM ord",
    "cover_filter": with_("a") + "SELECT article_id, len(CASE WHEN coalesce(total_pdf_pages, 0) = 0 THEN full_text_paragraphs ELSE list_filter(full_text_paragraphs, lambda p: p.page > 2 AND p.page <= total_pdf_pages - 2) END) AS n_kept, len(full_text_paragraphs) AS n_all FROM a",
    "embedding_texts": with_("c") + f"SELECT chunk_id, md5('Magazine: ' || journal_name || chr(10) || 'Year: ' || coalesce(year, '') || chr(10) || 'Issue: ' || coalesce(issue, '') || chr(10) || 'Article: ' || coalesce(title, '') || chr(10) || 'Authors: ' || {AUTHOR} || chr(10) || 'Text: ' || coalesce(text, '')) AS header_md5 FROM c JOIN journals USING (journal)",
    "body_and_captions": with_("c") + "SELECT journal, chunk_type, count(*) AS n, sum(length(text)) AS chars FROM c WHERE chunk_type IN ('body', 'caption') GROUP BY ALL",
    "index_metadata": with_("c") + "SELECT chunk_id, chunk_type, chunk_index, journal, TRY_CAST(nullif(issue, '') AS INTEGER) AS issue, TRY_CAST(nullif(year, '') AS INTEGER) AS year, article_id, coalesce(title, '') AS title, coalesce(author, '') AS author, page_start, page_end FROM c",
    "pending_chunks": with_("c") + "SELECT chunk_id, journal FROM c ANTI JOIN vectors USING (chunk_id)",
    "upserted_chunks": with_("c") + """, n AS (SELECT chunk_id, article_id, text FROM c WHERE TRY_CAST(year AS INTEGER) < 2000), o AS (SELECT chunk_id, arg_min(article_id, (ingested_at, text)) AS article_id, arg_min(text, (ingested_at, text)) AS text FROM chunks GROUP BY chunk_id)
        SELECT chunk_id, article_id, md5(text) AS text_md5 FROM n UNION ALL SELECT chunk_id, article_id, md5(text) FROM o ANTI JOIN n USING (chunk_id)""",
    "misaligned_ids": "SELECT DISTINCT chunk_id, 'chunks' AS side FROM chunks ANTI JOIN vectors USING (chunk_id) UNION ALL SELECT DISTINCT chunk_id, 'vectors' FROM vectors ANTI JOIN chunks USING (chunk_id)",
    "vector_topk": with_("es") + TOPK % ("", 10),
    "indexed_topk": with_("es") + TOPK % ("", 10),
    "indexed_topk_filtered": with_("es") + TOPK % ("AND a.label = 3", 5),
    "vector_topk_filtered": with_("es") + TOPK % ("AND a.label = 3", 5),
    "merged_page_spans": with_("c") + """SELECT article_id, min(page_start) AS lo, max(page_end) AS hi FROM (SELECT *, sum(CASE WHEN before IS NULL OR page_start > before + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY article_id ORDER BY page_start, page_end, chunk_id ROWS UNBOUNDED PRECEDING) AS span FROM (
        SELECT *, max(page_end) OVER (PARTITION BY article_id ORDER BY page_start, page_end, chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM c WHERE chunk_type = 'body')) GROUP BY article_id, span""",
    "caption_windows": with_("c") + """SELECT chunk_id, greatest(l[1], l[1 + len(l) // 2] - 1) AS lo, least(l[-1], l[1 + len(l) // 2] + 1) AS hi FROM (SELECT k.chunk_id, list_sort(list(o.chunk_index) FILTER (o.chunk_index IS NOT NULL)) AS l
        FROM (SELECT * FROM c WHERE chunk_type = 'caption') k LEFT JOIN (SELECT * FROM c WHERE chunk_type = 'body') o ON o.article_id = k.article_id AND o.page_start <= k.page_end AND o.page_end >= k.page_start GROUP BY k.chunk_id)""",
    "citations": with_("c") + f"SELECT chunk_id, coalesce(title, '') || ' (' || journal_name || ' ' || coalesce(year, '') || '/' || coalesce(issue, '') || ', ' || {PAGES} || '), authors: ' || {AUTHOR} AS citation FROM c JOIN journals USING (journal)",
    "quality_flag_counts": with_("a") + "SELECT flag, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM a), 4) AS percent FROM (SELECT unnest(quality_flags) AS flag FROM a) GROUP BY flag",
    "flags_by_issue": with_("a") + f"SELECT issue_label, flag, count(*) AS n FROM (SELECT {LAB_TITLE} AS issue_label, unnest(quality_flags) AS flag FROM a) GROUP BY CUBE (issue_label, flag) HAVING count(*) > 0",
    "flagged_unique_titles": with_("a") + "SELECT title, article_id, array_to_string(quality_flags, ',') AS flags, length(full_text) AS n_chars FROM (SELECT *, count(*) OVER (PARTITION BY title) AS n FROM a WHERE len(quality_flags) > 0) WHERE n = 1",
    "issue_health": with_("a") + f"SELECT {LAB_TITLE} AS issue_label, count(*) AS articles, count(*) FILTER (len(quality_flags) > 0) AS flagged, count(*) FILTER (full_text IS NULL OR NOT regexp_matches(full_text, '{NWS}')) AS empty FROM a GROUP BY 1",
    "length_histogram": with_("c") + "SELECT chunk_type, CAST(least(length(text) // 200 * 200, 3000) AS INTEGER) AS bucket, count(*) AS n FROM c WHERE text IS NOT NULL GROUP BY ALL",
    "chunk_length_stats": with_("c") + "SELECT chunk_type, count(*) AS n, min(length(text)) AS least, max(length(text)) AS most, round(avg(length(text)), 4) AS mean, CAST(median(length(text)) AS DOUBLE) AS middle FROM c WHERE text IS NOT NULL GROUP BY ALL",
    "duplicate_ids": "SELECT chunk_id, count(*) AS n FROM chunks GROUP BY chunk_id HAVING count(*) > 1",
    "chunks_per_year": with_("c") + f"SELECT journal, year, count(*) AS n, count(*) FILTER (text IS NULL OR NOT regexp_matches(text, '{NWS}')) AS n_blank FROM c GROUP BY ALL",
    "hit_rate_at_k": with_("es") + "SELECT count(*) AS n, count(*) FILTER (found) AS found, round(avg(CAST(found AS DOUBLE)), 6) AS rate FROM (SELECT t.query_id, bool_or(contains(CAST(h.label AS VARCHAR), CAST(o.label AS VARCHAR))) AS found FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place FROM (" + TOPK % ("", 6) + ") WHERE chunk_id <> CAST(query_id AS VARCHAR)) t JOIN es h ON CAST(h.vec_id AS VARCHAR) = t.chunk_id JOIN es o ON o.vec_id = t.query_id WHERE place <= 5 GROUP BY t.query_id)",
    "article_sample": with_("a") + "SELECT article_id, title FROM a ORDER BY md5(article_id || '/7'), article_id LIMIT 20",
    "common_titles": with_("a") + "SELECT title, n FROM (SELECT title, count(*) AS n, min(article_id) AS met FROM a WHERE title IS NOT NULL GROUP BY title ORDER BY n DESC, met LIMIT 20)",
    "event_windows": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
}
