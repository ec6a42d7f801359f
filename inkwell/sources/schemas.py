"""Schemas of what is read and written, never inferred."""

PARAGRAPHS = "ARRAY<STRUCT<page: INT, text: STRING>>"
#: One row per span; a picture is a row of its raw_block with kind 'image' and no text. raw_block counts within a page.
SPANS = "journal STRING, year STRING, issue STRING, page INT, raw_block INT, kind STRING, line INT, pos INT, text STRING, font STRING, size DOUBLE, color INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE"
BLOCKS = "journal STRING, year STRING, issue STRING, page INT, block_id INT, type STRING, text STRING, font STRING, font_size DOUBLE, bbox ARRAY<DOUBLE>"
TOC = "journal STRING, year STRING, issue STRING, toc_pos INT, printed_page STRING, title STRING, author STRING"
#: Printed labels and the pages they lead to.
LABELS = "journal STRING, year STRING, issue STRING, label STRING, page INT"
ARTICLES = (
    "article_id STRING, journal STRING, year STRING, issue STRING, title STRING, author STRING, printed_page_start STRING, pdf_page_start INT, pdf_page_end INT, total_pdf_pages INT, "
    f"quality_flags ARRAY<STRING>, original_titles ARRAY<STRING>, absorbed_titles ARRAY<STRING>, full_text STRING, full_text_paragraphs {PARAGRAPHS}, captions_text STRING, captions_paragraphs {PARAGRAPHS}"
)
CHUNKS = "chunk_id STRING, chunk_type STRING, chunk_index INT, journal STRING, year STRING, issue STRING, article_id STRING, title STRING, author STRING, page_start INT, page_end INT, text STRING, embedding_text STRING"
VECTORS = "chunk_id STRING, embedding ARRAY<FLOAT>"
#: As a run keeps them: of which text, by which model.
KEPT_VECTORS = "chunk_id STRING, embedding ARRAY<FLOAT>, text_hash STRING, model STRING, dim INT"
