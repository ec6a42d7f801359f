"""SQL of the queries that fold over ordered lists: glued texts, merged frames, packed chunks."""

from __future__ import annotations

from inkwell.plans.catalogue_sql import AUTHOR, BOUNDARY_CUTS, CAPS, CTE, JUNK, NWS, ON, W, WS, match_key, same_title, strip, with_, words

BREAK = f"({W}){WS}*-{WS}*$"


def breaks(before: str, after: str) -> str:
    return rf"(regexp_matches({before}, '{BREAK}') AND regexp_matches({after}, '^{WS}*\p{{Ll}}'))"


def unbroken(text: str) -> str:
    return rf"regexp_replace({text}, '{BREAK}', '\1')"


def glue(parts: str) -> str:
    """Of a list of texts."""
    full = f"list_filter(list_transform({parts}, lambda x: {strip('x')}), lambda x: x IS NOT NULL AND x <> '')"
    return f"list_reduce({full}, lambda a, p: CASE WHEN a = '' THEN p WHEN {breaks('a', 'p')} THEN {unbroken('a')} || p ELSE a || ' ' || p END, '')"


def blank(text: str) -> str:
    return f"({text} IS NULL OR NOT regexp_matches({text}, '{NWS}'))"


PAGE = "journal, year, issue, page"

GLUED_PAGES = with_("b") + f"SELECT {PAGE}, md5({glue('l')}) AS glued FROM (SELECT {PAGE}, list(text ORDER BY block_id) AS l FROM b GROUP BY ALL)"

_GROUPS = f"""list_reduce(l, lambda a, x: CASE
    WHEN {blank('x.text')} THEN {{'groups': list_append(a.groups, CASE WHEN a.g >= 0 THEN a.g END), 'size': a.size, 'g': a.g}}
    WHEN coalesce(abs(x.size - a.size) <= 3.0, false) THEN {{'groups': list_append(a.groups, a.g), 'size': a.size, 'g': a.g}}
    ELSE {{'groups': list_append(a.groups, a.g + 1), 'size': x.size, 'g': a.g + 1}} END, {{'groups': []::INTEGER[], 'size': NULL::DOUBLE, 'g': -1}}).groups"""
STYLE_GROUPS = with_("b") + f"""SELECT {PAGE}, CAST(unnest(range(len(g))) AS INTEGER) AS line, unnest(g) AS style_group FROM (
    SELECT {PAGE}, {_GROUPS} AS g FROM (SELECT {PAGE}, list({{'text': text, 'size': font_size}} ORDER BY block_id) AS l FROM b GROUP BY ALL))"""

_ENTRY = "STRUCT(kind VARCHAR, text VARCHAR, size DOUBLE, fonts STRUCT(font VARCHAR, n BIGINT)[], x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE)"
_OWN = "CAST({'kind': %s, 'text': f.text, 'size': f.size, 'fonts': [{'font': f.font, 'n': length(f.text)}], 'x0': f.x0, 'y0': f.y0, 'x1': f.x1, 'y1': f.y1} AS " + _ENTRY + ")"
_CLOSED = "CASE WHEN a.op IS NULL THEN a.done ELSE list_append(a.done, a.op) END"
_BOTH = f"CAST({{'kind': a.op.kind, 'text': {glue('[a.op.text, f.text]')}, 'size': a.op.size, 'fonts': list_append(a.op.fonts, {{'font': f.font, 'n': length(f.text)}}), 'x0': a.op.x0, 'y0': a.op.y0, 'x1': greatest(a.op.x1, f.x1), 'y1': f.y1}} AS {_ENTRY})"
_MERGED = f"""list_reduce(l, lambda a, f: CASE
    WHEN {blank('f.text')} THEN {{'done': list_append({_CLOSED}, {_OWN % "'image'"}), 'op': NULL::{_ENTRY}}}
    WHEN coalesce(abs(a.op.x0 - f.x0) <= 4 AND abs(a.op.x1 - f.x1) <= 12 AND f.y0 - a.op.y1 <= 6 AND abs(a.op.size - f.size) <= 3, false) THEN {{'done': a.done, 'op': {_BOTH}}}
    ELSE {{'done': {_CLOSED}, 'op': {_OWN % "'text'"}}} END, {{'done': []::{_ENTRY}[], 'op': NULL::{_ENTRY}}})"""
MERGED_FRAMES = with_("b") + f"""SELECT {PAGE}, block_id, {strip('e.text')} AS text,
        (SELECT font FROM (SELECT font, sum(coalesce(n, 0)) AS n, min(i) AS i FROM (SELECT unnest(e.fonts, recursive := true), generate_subscripts(e.fonts, 1) AS i) GROUP BY font) ORDER BY n DESC, i LIMIT 1) AS font,
        round(e.size, 2) AS font_size, round(e.x0, 1) AS x0, round(e.y0, 1) AS y0, round(e.x1, 1) AS x1, round(e.y1, 1) AS y1
    FROM (SELECT {PAGE}, CAST(unnest(range(len(es))) AS INTEGER) AS block_id, unnest(es) AS e FROM (
        SELECT {PAGE}, {_CLOSED} AS es FROM (SELECT {PAGE}, {_MERGED} AS a FROM (
            SELECT {PAGE}, list({{'text': text, 'font': font, 'size': font_size, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} ORDER BY block_id) AS l FROM b GROUP BY ALL)))) WHERE e.kind = 'text'"""


def paragraphs(parts: str, keys: str, order: str) -> str:
    """(keys, para, page, text) of parts (keys, order, page, text): cut words made whole."""
    return f"""SELECT {keys}, para, arg_min(page, ({order})) AS page, list_reduce(list(text ORDER BY {order}), lambda a, t: {unbroken('a')} || t, '') AS text FROM (
        SELECT *, sum(new) OVER (PARTITION BY {keys} ORDER BY {order}) AS para FROM (
            SELECT *, CASE WHEN coalesce({breaks('prev', 'text')}, false) THEN 0 ELSE 1 END AS new FROM (
                SELECT *, lag(text) OVER (PARTITION BY {keys} ORDER BY {order}) AS prev FROM (SELECT * EXCLUDE (text), {strip('text')} AS text FROM ({parts}) WHERE NOT {blank('text')})))) GROUP BY {keys}, para"""


MERGED_PARAGRAPHS = with_("b") + f"""SELECT journal, year, issue, CAST(count(*) AS INTEGER) AS n, md5(string_agg(text, chr(10) || chr(10) ORDER BY para)) AS text_md5
    FROM ({paragraphs("SELECT * FROM b WHERE type = 'body'", 'journal, year, issue', 'page, block_id')}) GROUP BY ALL"""

# --- chunks ---------------------------------------------------------------------------


def cut(text: str, limit: int = 1200) -> str:
    """The list of pieces of a text."""
    sentences = rf"string_split(regexp_replace({text}, '([.!?]){WS}+([{CAPS}])', '\1' || chr(1) || '\2', 'g'), chr(1))"
    steps = f"flatten(list_transform({sentences}, lambda s: CASE WHEN length(s) > {limit} THEN list_concat([{{'k': 'f', 't': ''}}], list_transform({words('s')}, lambda w: {{'k': 'w', 't': w}})) ELSE [{{'k': 's', 't': s}}] END))"
    flushed = f"CASE WHEN a.cur = '' THEN a.parts ELSE list_append(a.parts, {strip('a.cur')}) END"
    full = f"a.cur <> '' AND length(a.cur) + length(x.t) + (CASE WHEN x.k = 'w' THEN 1 ELSE 0 END) > {limit}"
    fold = f"""list_reduce({steps}, lambda a, x: CASE
        WHEN x.k = 'f' THEN {{'parts': {flushed}, 'cur': ''}}
        WHEN {full} THEN {{'parts': {flushed}, 'cur': x.t}}
        WHEN x.k = 'w' THEN {{'parts': a.parts, 'cur': CASE WHEN a.cur = '' THEN x.t ELSE a.cur || ' ' || x.t END}}
        ELSE {{'parts': a.parts, 'cur': {strip("a.cur || ' ' || x.t")}}} END, {{'parts': []::VARCHAR[], 'cur': ''}})"""
    return f"CASE WHEN length({text}) <= {limit} THEN [{text}] ELSE list_transform([{fold}], lambda a: {flushed})[1] END"


LONG_PARAGRAPHS_CUT = with_("a") + f"""SELECT article_id, pos, CAST(unnest(range(len(l))) AS INTEGER) AS piece_no, unnest(l) AS piece FROM (SELECT article_id, pos, {cut('t')} AS l FROM (
    SELECT article_id, CAST(unnest(range(len(full_text_paragraphs))) AS INTEGER) AS pos, unnest(full_text_paragraphs).text AS t FROM a) WHERE length(t) > 1200)"""

#: Chunks by recursion: the row after a chunk begins at the first part of its overlap.
ARTICLE_CHUNKS = f"""WITH RECURSIVE {with_('a').removeprefix('WITH ').rstrip()},
    k AS (SELECT article_id, kind, CASE WHEN coalesce(total_pdf_pages, 0) = 0 THEN p ELSE list_filter(p, lambda x: x.page > 2 AND x.page <= total_pdf_pages - 2) END AS p FROM (
        SELECT article_id, total_pdf_pages, unnest(['body', 'caption']) AS kind, unnest([coalesce(full_text_paragraphs, []), coalesce(captions_paragraphs, [])]) AS p FROM a WHERE NOT {blank('full_text')})),
    e AS (SELECT article_id, kind, i, page, {cut('pt')} AS l FROM (SELECT article_id, kind, unnest(range(len(p))) AS i, unnest(p).page AS page, unnest(p).text AS pt FROM k) WHERE pt IS NOT NULL),
    s AS (SELECT article_id, kind, page, t, row_number() OVER w AS n, sum(length(t) + 2) OVER w AS upto, sum(length(t)) OVER w AS bare
          FROM (SELECT article_id, kind, i, page, unnest(range(len(l))) AS j, unnest(l) AS t FROM e) WINDOW w AS (PARTITION BY article_id, kind ORDER BY i, j)),
    -- a chunk begins at part `lo` (overlap included), whose new parts begin at `own`; it ends before the first part that is too much
    c AS (SELECT article_id, kind, 0 AS no, CAST(1 AS BIGINT) AS lo, CAST(1 AS BIGINT) AS own, CAST(0 AS HUGEINT) AS held, z.hi FROM (SELECT DISTINCT article_id, kind FROM s) q, LATERAL (
            SELECT coalesce(min(s.n), 1000000000) AS hi FROM s WHERE s.article_id = q.article_id AND s.kind = q.kind AND s.n > 1 AND s.upto > 1200) z
          UNION ALL
          SELECT y.article_id, y.kind, y.no + 1, y.lo2, y.hi, y.held2, z.hi FROM (
              SELECT c.article_id, c.kind, c.no, c.hi, o.lo2, o.held2, (SELECT s.upto FROM s WHERE s.article_id = c.article_id AND s.kind = c.kind AND s.n = c.hi - 1) AS before
              FROM c, LATERAL (SELECT coalesce(min(s.n), c.hi) AS lo2, coalesce(max(b.bare - s.bare + length(s.t)), 0) AS held2 FROM s
                               JOIN s b ON b.article_id = s.article_id AND b.kind = s.kind AND b.n = c.hi - 1
                               WHERE s.article_id = c.article_id AND s.kind = c.kind AND s.n >= c.lo AND s.n < c.hi AND b.bare - s.bare + length(s.t) <= 150) o
              WHERE c.hi < 1000000000) y,
              LATERAL (SELECT coalesce(min(s.n), 1000000000) AS hi FROM s WHERE s.article_id = y.article_id AND s.kind = y.kind AND s.n > y.hi AND y.held2 + s.upto - y.before > 1200) z),
    g AS (SELECT c.article_id, c.kind, c.no, min(s.page) AS page_start, max(s.page) AS page_end, string_agg(s.t, chr(10) || chr(10) ORDER BY s.n) AS text
          FROM c JOIN s ON s.article_id = c.article_id AND s.kind = c.kind AND s.n >= c.lo AND s.n < c.hi GROUP BY ALL),
    m AS (SELECT *, lead(no) OVER w IS NULL AND no > 0 AND length(text) < 200 AS short, lead(text) OVER w AS nt, lead(page_end) OVER w AS np, lead(no, 2) OVER w IS NULL AND length(lead(text) OVER w) < 200 AS takes
          FROM g WINDOW w AS (PARTITION BY article_id, kind ORDER BY no)),
    f AS (SELECT article_id, kind, no, page_start, CASE WHEN coalesce(takes, false) THEN np ELSE page_end END AS page_end, CASE WHEN coalesce(takes, false) THEN text || chr(10) || chr(10) || nt ELSE text END AS text FROM m WHERE NOT short)
SELECT article_id || CASE WHEN kind = 'body' THEN '-chunk-' ELSE '-caption-' END || no AS chunk_id, kind AS chunk_type, no AS chunk_index, journal, year, issue, article_id, title, author, f.page_start, f.page_end, f.text,
    'Magazine: ' || coalesce(journal, '') || chr(10) || 'Year: ' || coalesce(year, '') || chr(10) || 'Issue: ' || coalesce(issue, '') || chr(10) || 'Article: ' || coalesce(title, '') || chr(10) || 'Authors: ' || {AUTHOR} || chr(10) || 'Text: ' || f.text AS embedding_text
FROM f JOIN a USING (article_id)"""

# --- articles -----------------------------------------------------------------------------

_SRC = f"SELECT * FROM b JOIN (SELECT journal, year, issue, max(y1) AS height FROM b GROUP BY ALL) {ON} WHERE NOT {JUNK}"
_COMMON = "list_max(list_filter(range(0, length(m) + 1), lambda n: len(list_filter(range(1, length(m) - n + 2), lambda i: contains(k, substring(m, i, n)))) > 0))"
_G = "journal, year, issue, group_no"
_ASSIGNED = dict(src=_SRC, ord=CTE["ord"], cuts=BOUNDARY_CUTS, asg=f"""
        SELECT * EXCLUDE (group_no, start, split_y), CASE WHEN page = start AND group_no > 0 AND y1 <= split_y THEN group_no - 1 ELSE group_no END AS group_no
        FROM ord JOIN pg USING (journal, year, issue, page) LEFT JOIN (SELECT journal, year, issue, page, split_y FROM cuts) USING (journal, year, issue, page)""")
GROUP_OVERVIEW = with_("rng", "pg", **_ASSIGNED) + f"""SELECT g.*, coalesce(n_blocks, 0) AS n_blocks, coalesce(n_headings, 0) AS n_headings, split_y FROM (
        SELECT {_G}, min(pdf_page_start) AS pdf_page_start, max(pdf_page_end) AS pdf_page_end, count(*) AS n_entries, string_agg(title, ' | ' ORDER BY in_group) AS titles FROM rng GROUP BY ALL) g
    LEFT JOIN (SELECT {_G}, count(*) AS n_blocks, count(*) FILTER (type IN ('title', 'heading')) AS n_headings FROM asg GROUP BY ALL) USING ({_G}) LEFT JOIN (SELECT {_G}, split_y FROM cuts) USING ({_G})"""
_ARTICLES = with_("rng", "pg", **_ASSIGNED,
    mine=f"SELECT *, row_number() OVER (PARTITION BY {_G} ORDER BY page, reading_pos) - 1 AS group_pos FROM asg",
    ent=f"""SELECT {_G}, in_group, title, author, {match_key('title')} AS m, count(*) OVER (PARTITION BY {_G}) AS n, coalesce(u, false) AS unsure
        FROM rng LEFT JOIN (SELECT {_G}, true AS u FROM cuts WHERE split_y IS NULL) USING ({_G})""",
    hd=f"SELECT {_G}, group_pos, {match_key('text')} AS k FROM mine WHERE type IN ('title', 'heading')",
    pairs=f"SELECT {_G}, in_group, list({{'i': group_pos, 's': {_COMMON}}} ORDER BY group_pos) AS c FROM ent JOIN hd USING ({_G}) WHERE n > 1 AND {same_title('m', 'k')} GROUP BY ALL",
    folded=f"""SELECT {_G}, ins, CASE WHEN len(hs) = len(ins) THEN hs ELSE list_reduce(cs, lambda a, e: list_transform(
            [list_filter(coalesce(e.c, []), lambda x: x.i >= a.pos)[1]], lambda f: CASE WHEN f.i > a.pos OR f.s > a.score THEN {{'places': list_append(a.places, f.i), 'pos': f.i, 'score': f.s}}
            ELSE {{'places': list_append(a.places, NULL), 'pos': a.pos, 'score': a.score}} END)[1],
            {{'places': []::BIGINT[], 'pos': CAST(0 AS BIGINT), 'score': CAST(-1 AS BIGINT)}}).places END AS ps
        FROM (SELECT {_G}, list(in_group ORDER BY in_group) AS ins, list({{'c': c}} ORDER BY in_group) AS cs FROM ent LEFT JOIN pairs USING ({_G}, in_group) WHERE n > 1 GROUP BY ALL)
        LEFT JOIN (SELECT {_G}, list(group_pos ORDER BY group_pos) AS hs FROM hd GROUP BY ALL) USING ({_G})""",
    placed=f"""SELECT e.*, place, coalesce(z, 0) AS z, count(place) OVER g AS n_own, count(place) OVER (g ORDER BY in_group ROWS UNBOUNDED PRECEDING) AS run,
            first(place IGNORE NULLS) OVER (g ORDER BY in_group ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
        FROM ent e JOIN (SELECT {_G}, unnest(ins) AS in_group, unnest(ps) AS place FROM folded) USING ({_G}, in_group) LEFT JOIN (SELECT {_G}, count(*) AS z FROM mine GROUP BY ALL) USING ({_G})
        WINDOW g AS (PARTITION BY {_G})""",
    lost=f"SELECT DISTINCT {_G}, run, true AS lost FROM placed WHERE place IS NULL AND run > 0",
    shared=f"""SELECT {_G}, in_group, title, author, CASE WHEN run = 1 THEN 0 ELSE place END AS lo, coalesce(nxt, z) AS hi, concat_ws(',', CASE WHEN run = 1 AND unsure THEN 'boundary_page_unverified' END, CASE WHEN lost THEN 'absorbed_unmatched_siblings' END) AS flags
            FROM placed LEFT JOIN lost USING ({_G}, run) WHERE place IS NOT NULL
        UNION ALL SELECT {_G}, in_group, title, author, 0, 0, 'heading_not_found_empty' FROM placed WHERE place IS NULL AND n_own > 0
        UNION ALL SELECT {_G}, 0, string_agg(title, '; ' ORDER BY in_group), arg_min(author, in_group) FILTER (author <> ''), 0, max(z), concat_ws(',', 'merged_fallback', CASE WHEN bool_or(unsure) THEN 'boundary_page_unverified' END) FROM placed WHERE n_own = 0 GROUP BY {_G}
        UNION ALL SELECT {_G}, in_group, title, author, 0, NULL, CASE WHEN unsure THEN 'boundary_page_unverified' ELSE '' END FROM ent WHERE n = 1""",
    art=f"""SELECT *, concat_ws('-', nullif(journal, ''), nullif(year, ''), nullif(issue, ''), row_number() OVER (PARTITION BY journal, year, issue ORDER BY group_no, in_group) - 1) AS article_id
        FROM shared JOIN (SELECT {_G}, min(pdf_page_start) AS pdf_page_start, max(pdf_page_end) AS pdf_page_end FROM rng GROUP BY ALL) USING ({_G})""",
    held=f"""SELECT *, row_number() OVER (PARTITION BY article_id, page ORDER BY xr IS NULL, col NULLS FIRST, y0 NULLS FIRST, group_pos) AS article_pos FROM (
        SELECT *, sum(jump) OVER (PARTITION BY article_id, page ORDER BY xr NULLS FIRST) AS col FROM (
            SELECT *, CASE WHEN xr - lag(xr) OVER (PARTITION BY article_id, page ORDER BY xr NULLS FIRST) > 40 THEN 1 ELSE 0 END AS jump FROM (
                SELECT article_id, page, type, text, y0, group_pos, round_even(x0, 0) AS xr FROM mine JOIN (SELECT {_G}, article_id, lo, hi FROM art) USING ({_G}) WHERE group_pos >= lo AND (hi IS NULL OR group_pos < hi))))""",
    body=paragraphs("SELECT * FROM held WHERE type IN ('title', 'heading', 'other', 'body')", "article_id", "page, article_pos"),
    caps=paragraphs("SELECT * FROM held WHERE type = 'caption'", "article_id", "page, article_pos"))
ASSEMBLED_ARTICLES = _ARTICLES + """SELECT article_id, journal, year, issue, title, author, pdf_page_start, pdf_page_end, flags, CAST(coalesce(np, 0) AS INTEGER) AS n_paragraphs, CAST(coalesce(nc, 0) AS INTEGER) AS n_chars, CAST(coalesce(kc, 0) AS INTEGER) AS n_caption_chars
    FROM art LEFT JOIN (SELECT article_id, count(*) AS np, sum(length(text) + 2) - 2 AS nc FROM body GROUP BY ALL) USING (article_id) LEFT JOIN (SELECT article_id, sum(length(text) + 2) - 2 AS kc FROM caps GROUP BY ALL) USING (article_id)"""

# --- context and prompts ------------------------------------------------------------------

_BREAK = "chr(10) || chr(10)"
_BY = "query_id, article_id"
_CONTEXT = dict(
    h="SELECT hits.query_id, hits.rank, hits.distance, c.* FROM hits JOIN c USING (chunk_id)",
    heads=f"SELECT {_BY}, count(*) AS n_hits, min(distance) AS best, min(rank) AS first_rank, arg_min({{'journal': journal, 'year': year, 'issue': issue, 'title': title, 'author': author}}, rank) AS m FROM h GROUP BY ALL",
    few=f"SELECT h.* FROM h JOIN heads USING ({_BY}) WHERE n_hits < 3",
    body="SELECT * FROM c WHERE chunk_type = 'body'",
    cap=f"""SELECT * EXCLUDE (l), greatest(l[1], l[1 + len(l) // 2] - 1) AS lo, least(l[-1], l[1 + len(l) // 2] + 1) AS hi FROM (
        SELECT k.query_id, k.article_id, k.rank, k.distance, k.page_start, k.page_end, k.text, list_sort(list(o.chunk_index) FILTER (o.chunk_index IS NOT NULL)) AS l FROM (SELECT * FROM few WHERE chunk_type = 'caption') k
        LEFT JOIN body o ON o.article_id = k.article_id AND o.page_start <= k.page_end AND o.page_end >= k.page_start GROUP BY ALL)""",
    spans=f"SELECT {_BY}, chunk_index - 1 AS lo, chunk_index + 1 AS hi, distance FROM few WHERE chunk_type <> 'caption' UNION ALL SELECT {_BY}, lo, hi, distance FROM cap WHERE lo IS NOT NULL",
    wins=f"""SELECT {_BY}, min(lo) AS lo, max(hi) AS hi, min(distance) AS dist FROM (SELECT *, sum(CASE WHEN prev IS NULL OR lo > prev + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY {_BY} ORDER BY lo, hi, distance ROWS UNBOUNDED PRECEDING) AS span FROM (
        SELECT *, max(hi) OVER (PARTITION BY {_BY} ORDER BY lo, hi, distance ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM spans)) GROUP BY {_BY}, span""",
    parts=f"""SELECT w.query_id, w.article_id, w.lo, w.hi, w.dist, 0 AS k, o.chunk_index AS i, o.text, o.page_start, o.page_end FROM wins w JOIN body o ON o.article_id = w.article_id AND o.chunk_index BETWEEN w.lo AND w.hi
        UNION ALL SELECT w.query_id, w.article_id, w.lo, w.hi, w.dist, 1, k.rank, k.text, k.page_start, k.page_end FROM cap k JOIN wins w USING ({_BY}) WHERE w.lo <= k.lo AND k.hi <= w.hi
        UNION ALL SELECT {_BY}, rank, -1, distance, 1, rank, text, page_start, page_end FROM cap WHERE lo IS NULL""",
    every=f"""SELECT query_id, 'window' AS mode, n_hits, m, ps, pe, concat_ws({_BREAK}, bt, CASE WHEN ct IS NOT NULL THEN 'Figure captions:' || {_BREAK} || ct END) AS text, dist AS best_distance, first_rank, lo AS win FROM (
            SELECT {_BY}, lo, hi, dist, min(page_start) AS ps, max(page_end) AS pe, string_agg(text, {_BREAK} ORDER BY i) FILTER (k = 0) AS bt, string_agg(text, {_BREAK} ORDER BY i) FILTER (k = 1) AS ct FROM parts GROUP BY ALL) JOIN heads USING ({_BY})
        UNION ALL SELECT query_id, 'full_article', n_hits, m, pdf_page_start, pdf_page_end, coalesce(full_text, '') || CASE WHEN coalesce(captions_text, '') <> '' THEN {_BREAK} || 'Figure captions:' || {_BREAK} || captions_text ELSE '' END, best, first_rank, -1
        FROM heads JOIN a USING (article_id) WHERE n_hits >= 3""",
    ctx="""SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY best_distance, first_rank, win) - 1 AS INTEGER) AS block_no, mode, n_hits,
        coalesce(m.title, '') || ' (' || coalesce(m.journal, '') || ' ' || coalesce(m.year, '') || '/' || coalesce(m.issue, '') || ', ' || CASE WHEN ps = pe THEN 'PDF p. ' || ps ELSE 'PDF pp. ' || ps || '-' || pe END || '), authors: ' || coalesce(nullif(m.author, ''), 'unknown') AS citation, text, best_distance FROM every""")
CONTEXT_BLOCKS = with_("a", "hits", **_CONTEXT) + "SELECT * FROM ctx"
PROMPTS = with_("a", "hits", **_CONTEXT) + f""", q AS (SELECT query_id, text AS question FROM qs JOIN c USING (chunk_id)),
    s AS (SELECT query_id, string_agg('--- Source ' || (block_no + 1) || ' [' || CASE WHEN mode = 'full_article' THEN 'FULL ARTICLE' ELSE 'excerpt' END || '] ---' || chr(10) || citation || {_BREAK} || text, {_BREAK} ORDER BY block_no) AS context, count(*) AS n FROM ctx GROUP BY ALL),
    p AS (SELECT query_id, coalesce(context || {_BREAK} || '---' || {_BREAK} || 'Question: ' || question, 'Question: ' || question || {_BREAK} || 'Context: (retrieval found no relevant excerpts)') AS prompt, coalesce(n, 0) AS n_sources FROM q LEFT JOIN s USING (query_id))
SELECT query_id, prompt, n_sources, CAST(round_even(length(prompt) / 2.3, 0) AS BIGINT) AS est_tokens FROM p"""

# --- hashed vectors -------------------------------------------------------------------------


def hashed(rows: str, key: str, text: str) -> str:
    """(key, bucket, x) of the hashed vectors of texts, single precision, without zeros."""
    return f"""SELECT {key}, bucket, CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS x FROM (SELECT {key}, bucket, CAST(count(*) AS DOUBLE) AS c FROM (
        SELECT {key}, CAST('0x' || substring(md5(w), 1, 8) AS BIGINT) % 64 AS bucket FROM (SELECT {key}, unnest({words(f'lower({text})')}) AS w FROM {rows})) GROUP BY ALL)"""


HASH_EMBEDDINGS = f"SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, round(x, 6) AS value FROM ({hashed('documents', 'doc_id', 'text')})"

_COSINE = "list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e)))"
SIMILARITY_SEPARATION = with_("es") + f""", d AS (SELECT CAST(vec_id AS VARCHAR) AS id, label, md5(CAST(vec_id AS VARCHAR) || '/42') AS h FROM es),
    same AS (SELECT 'same' AS kind, id AS a, b FROM (SELECT *, lead(id) OVER (PARTITION BY label ORDER BY h, id) AS b FROM d) WHERE b IS NOT NULL ORDER BY h, id LIMIT 2000),
    diff AS (SELECT 'different' AS kind, id AS a, b FROM (SELECT *, lead(id) OVER (ORDER BY h, id) AS b, lead(label) OVER (ORDER BY h, id) AS bl FROM (SELECT * FROM d ORDER BY h, id LIMIT 4000)) WHERE bl <> label ORDER BY h, id LIMIT 2000),
    s AS (SELECT kind, {_COSINE} AS s FROM (SELECT * FROM same UNION ALL SELECT * FROM diff) p JOIN es x ON CAST(x.vec_id AS VARCHAR) = p.a JOIN es y ON CAST(y.vec_id AS VARCHAR) = p.b)
SELECT kind, count(*) AS n, round(avg(s), 6) AS mean, round(median(s), 6) AS middle, round(stddev_pop(s), 6) AS sd, round(min(s), 6) AS least, round(max(s), 6) AS most,
    round(avg(CASE WHEN s > (SELECT median(s) FROM s WHERE kind = 'different') THEN 1.0 ELSE 0.0 END), 6) AS above FROM s GROUP BY kind"""

MODEL_COMPARISON = with_("c") + f""", q AS (SELECT journal AS query_id, min(title) AS question FROM c WHERE title IS NOT NULL GROUP BY journal),
    cv AS ({hashed('c', 'chunk_id', 'embedding_text')}), qv AS ({hashed('q', 'query_id', 'question')}),
    dist AS (SELECT query_id, chunk_id, round(1 - coalesce(s, 0) / (cl * ql), 9) + 0.0 AS distance FROM (SELECT chunk_id, sqrt(sum(x * x)) AS cl FROM cv GROUP BY ALL) CROSS JOIN (SELECT query_id, sqrt(sum(x * x)) AS ql FROM qv GROUP BY ALL)
             LEFT JOIN (SELECT query_id, chunk_id, sum(cv.x * qv.x) AS s FROM cv JOIN qv USING (bucket) GROUP BY ALL) USING (query_id, chunk_id)),
    top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM dist) WHERE rank <= 5),
    f AS (SELECT q.query_id, coalesce(bool_or(contains(lower(c.title), lower(q.question))), false) AS found FROM q LEFT JOIN top USING (query_id) LEFT JOIN c USING (chunk_id) GROUP BY q.query_id)
SELECT 'hash' AS model, count(*) AS n, count(*) FILTER (found) AS found, round(avg(CAST(found AS DOUBLE)), 6) AS rate FROM f"""

SQL: dict[str, str] = {
    "glued_pages": GLUED_PAGES, "style_groups": STYLE_GROUPS, "merged_frames": MERGED_FRAMES, "merged_paragraphs": MERGED_PARAGRAPHS, "long_paragraphs_cut": LONG_PARAGRAPHS_CUT, "article_chunks": ARTICLE_CHUNKS,
    "assembled_articles": ASSEMBLED_ARTICLES, "group_overview": GROUP_OVERVIEW, "context_blocks": CONTEXT_BLOCKS, "prompts": PROMPTS, "hash_embeddings": HASH_EMBEDDINGS, "similarity_separation": SIMILARITY_SEPARATION, "model_comparison": MODEL_COMPARISON}
