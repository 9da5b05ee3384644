"""DuckDB SQL for the queries of plans/queries.py.

BASE is a chain of named tables, from conversations as books to key ideas; each query takes what it needs of it.
"""

from __future__ import annotations

from ..functions.text import FRONT_MATTER
from ..sources.books import SAMPLES

STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x)


BASE = f"""
p AS (SELECT conv_id AS book_id, CAST(turn AS INTEGER) AS page_num, coalesce(text, '') AS text FROM conversations),
meta AS (
  SELECT book_id, CASE WHEN book_id % 3 <> 0 THEN 'Book ' || book_id ELSE '' END AS title,
         CASE WHEN book_id % 2 <> 0 THEN 'Author ' || book_id ELSE '' END AS author,
         '/books/vol-' || book_id || '.pdf' AS source_path, CAST(count(*) AS INTEGER) AS total_pages,
         CASE WHEN book_id % 5 <> 0 THEN 'press' ELSE '' END AS producer, 'writer' AS creator
  FROM p GROUP BY book_id
),
toc AS (SELECT book_id, page_num AS toc_idx, 1 + page_num % 3 AS level, {strip("left(text, 20)")} AS title, page_num AS page FROM p),
n0 AS (SELECT book_id, page_num, regexp_replace({strip("text")}, '\\n{{3,}}', chr(10) || chr(10), 'g') AS text FROM p),
n1 AS (SELECT *, coalesce(max(CASE WHEN text <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY page_num DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS more FROM n0),
n2 AS (SELECT book_id, page_num, more, text AS full_page, CASE WHEN more AND right(text, 1) = '-' THEN left(text, length(text) - 1) ELSE text END AS text FROM n1),
n3 AS (SELECT book_id, page_num, text, CASE WHEN more AND full_page <> '' THEN chr(10) || chr(10) ELSE '' END AS glue FROM n2),
np AS (SELECT *, CAST(sum(length(text) + length(glue)) OVER (PARTITION BY book_id ORDER BY page_num) AS BIGINT) AS end_char FROM n3),
pos AS (SELECT book_id, page_num, end_char - length(text) - length(glue) AS start_char, end_char FROM np),
full_text AS (SELECT book_id, string_agg(text || glue, '' ORDER BY page_num) AS full_text, max(end_char) AS size FROM np GROUP BY book_id),
t0 AS (SELECT toc.*, CAST(pos.start_char AS BIGINT) AS pos, size FROM toc JOIN pos ON toc.book_id = pos.book_id AND toc.page = pos.page_num JOIN full_text ON full_text.book_id = toc.book_id),
t1 AS (SELECT a.book_id, a.toc_idx, min(b.toc_idx) AS term FROM t0 a LEFT JOIN t0 b ON a.book_id = b.book_id AND b.toc_idx > a.toc_idx AND b.level <= a.level GROUP BY ALL),
t2 AS (SELECT t0.*, t1.term, coalesce(e.pos, t0.size) AS until FROM t0 JOIN t1 USING (book_id, toc_idx) LEFT JOIN t0 e ON e.book_id = t0.book_id AND e.toc_idx = t1.term),
anc AS (
  SELECT i.book_id, i.toc_idx, j.toc_idx AS anc_idx, j.title AS anc_title, j.pos AS anc_pos, j.until AS anc_until, j.level AS anc_level
  FROM t2 i JOIN t2 j ON i.book_id = j.book_id AND (j.toc_idx = i.toc_idx OR (j.toc_idx < i.toc_idx AND j.level < i.level AND (j.term IS NULL OR i.toc_idx < j.term)))
),
tree AS (
  SELECT t2.book_id, toc_idx, level, title, page, term, s.start_char, s.end_char, s.parent_idx, s.depth, s.path, s.chapter_title, s.chapter_idx, s.parent_title,
         coalesce(lead(level) OVER w <= level, true) AS is_leaf,
         CAST(sum(CASE WHEN level = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY t2.book_id ORDER BY toc_idx) AS INTEGER) AS chapter_number
  FROM t2 JOIN (
    SELECT book_id, toc_idx, max(anc_pos) AS start_char, min(anc_until) AS end_char, max(anc_idx) FILTER (anc_idx < toc_idx) AS parent_idx,
           count(*) - 1 AS depth, string_agg(anc_title, ' > ' ORDER BY anc_idx) FILTER (anc_title <> '') AS path,
           arg_min(anc_title, anc_idx) AS chapter_title, min(anc_idx) AS chapter_idx, arg_min(anc_level, anc_idx) AS root_level,
           CASE WHEN count(*) > 2 THEN arg_max(anc_title, anc_idx) FILTER (anc_idx < toc_idx) END AS parent_title
    FROM anc GROUP BY book_id, toc_idx
  ) s USING (book_id, toc_idx) WHERE root_level = 1
  WINDOW w AS (PARTITION BY t2.book_id ORDER BY toc_idx)
),
leaf AS (
  SELECT book_id, chapter_number, toc_idx, CASE WHEN level = 1 THEN '' ELSE title END AS title, CASE WHEN level = 1 THEN 2 ELSE level END AS level,
         coalesce(path, '') AS hierarchy_path, chapter_title, parent_title, page, start_char, end_char,
         substring(full_text, start_char + 1, greatest(end_char - start_char, 0)) AS content
  FROM tree JOIN full_text USING (book_id) WHERE is_leaf
),
eligible AS (SELECT * FROM leaf WHERE length({strip("content")}) >= 100),
sec AS (
  SELECT book_id, chapter_number, CAST(row_number() OVER (PARTITION BY book_id, chapter_number ORDER BY toc_idx) AS INTEGER) AS section_number,
         title, level, CASE WHEN depth > 1 THEN parent_idx END AS parent_idx, toc_idx, 'toc' AS detection_method
  FROM tree WHERE level > 1
),
chap AS (SELECT book_id, chapter_number, title, level, 'toc' AS detection_method FROM tree WHERE level = 1),
"""


def rule(source: str, keys: str) -> str:
    """Tables r (pieces) and split (kept paragraphs) of a table with keys and content."""
    return f"""
b0 AS (SELECT {keys}, content, string_split_regex(content, '\\n\\n+') AS parts, regexp_extract_all(content, '\\n\\n+') AS seps FROM {source}),
b1 AS (SELECT {keys}, content, k, parts[k] AS part,
         CAST(list_sum(list_transform(parts[1 : k - 1], lambda x: length(x))) AS BIGINT) AS a, CAST(list_sum(list_transform(seps[1 : k - 1], lambda x: length(x))) AS BIGINT) AS b
       FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM b0)),
b2 AS (SELECT {keys}, content, k, {strip("part")} AS paragraph,
         coalesce(a, 0) + coalesce(b, 0) + length(part) - length(regexp_replace(part, '^\\s+', '')) AS place FROM b1),
b3 AS (SELECT {keys}, k, paragraph, place FROM b2 WHERE length(paragraph) >= 50),
split AS (
  SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY k) - 1 AS INTEGER) AS paragraph_index, paragraph,
         CAST(place AS INTEGER) AS para_start, CAST(place + length(paragraph) AS INTEGER) AS para_end FROM b3
  UNION ALL
  SELECT {keys}, 0, content, 0, CAST(length(content) AS INTEGER) FROM b0 WHERE NOT EXISTS (SELECT 1 FROM b3 WHERE {" AND ".join(f"b3.{k} = b0.{k}" for k in keys.split(", "))})
)"""


#: Chapters with their pages, and counts of what a delete leaves of each book.
CHAPTER = """book_id, chapter_number, title, level, detection_method, start_page, end_page FROM (SELECT t.book_id, t.chapter_number, t.title, t.level, 'toc' AS detection_method, t.page AS start_page,
  CAST(coalesce(lead(t.page) OVER (PARTITION BY t.book_id ORDER BY t.toc_idx), q.last_page) AS INTEGER) AS end_page
  FROM tree t JOIN (SELECT book_id, max(page_num) AS last_page FROM p GROUP BY book_id) q ON q.book_id = t.book_id WHERE t.level = 1)"""
LEFT = """CAST((SELECT count(*) FROM chap c WHERE c.book_id = m.book_id AND m.book_id <> 5) AS BIGINT) AS chapters,
  CAST((SELECT count(*) FROM sec c WHERE c.book_id = m.book_id AND m.book_id <> 5 AND NOT (m.book_id = 7 AND c.section_number = 2)) AS BIGINT) AS sections,
  CAST((SELECT count(*) FROM left_ c WHERE c.book_id = m.book_id) AS BIGINT) AS paragraph_chunks, CAST((SELECT count(*) FROM left_ c WHERE c.book_id = m.book_id) AS BIGINT) AS key_ideas,
  CAST((SELECT count(*) FROM chap c WHERE c.book_id = m.book_id AND m.book_id <> 5) AS BIGINT) AS processing_progress"""


CHUNKS = (
    BASE
    + rule("eligible", "book_id, toc_idx")
    + """,
chunks AS (
  SELECT l.book_id, l.chapter_number, l.chapter_title, l.toc_idx, l.title, l.level, l.hierarchy_path, l.page, s.paragraph_index AS section_paragraph_index, s.para_start, s.para_end, s.paragraph,
         CAST(row_number() OVER (PARTITION BY l.book_id, l.chapter_number ORDER BY l.toc_idx, s.paragraph_index) - 1 AS INTEGER) AS chapter_paragraph_index,
         CAST(row_number() OVER (PARTITION BY l.book_id ORDER BY l.chapter_number, l.toc_idx, s.paragraph_index) - 1 AS INTEGER) AS book_paragraph_index
  FROM eligible l JOIN split s USING (book_id, toc_idx)
),"""
    + f"""
ideas AS (
  SELECT *, concept <> '' AND row_number() OVER (PARTITION BY book_id, concept ORDER BY chapter_number, toc_idx, section_paragraph_index) > 1 AS is_dup
  FROM (SELECT *, CASE WHEN length({strip("paragraph")}) >= 50 THEN regexp_extract(paragraph, '([A-Z][a-z]+)', 1) END AS concept FROM chunks)
),
kept AS (SELECT * FROM ideas WHERE NOT coalesce(is_dup, false)),
saved AS (SELECT * FROM kept WHERE concept IS NOT NULL)
"""
)

DOCS = f"""
di AS (
  SELECT CAST(regexp_extract(source, '(\\d+)', 1) AS BIGINT) AS book_id, doc_id AS chunk_id,
         CASE WHEN length({strip("coalesce(text, '')")}) >= 50 THEN regexp_extract(text, '([A-Z][a-z]+)', 1) END AS concept
  FROM documents
)"""

STATE = """
ev AS (
  SELECT user_id AS book_id, CAST(event_id % 4 AS INTEGER) AS unit_id, event_id AS seq, 'e' || event_id AS error,
         CASE event_type WHEN 'click' THEN 'processing' WHEN 'signup' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'pending' END AS status
  FROM events
),
state AS (
  SELECT book_id, unit_id, arg_max(status, seq) AS status, count(*) FILTER (status = 'processing') AS attempt_count,
         max(seq) FILTER (status = 'processing') AS last_attempt_seq, max(seq) FILTER (status = 'completed') AS completed_seq,
         arg_max(error, seq) FILTER (status = 'failed') AS error_message
  FROM ev GROUP BY book_id, unit_id
)"""

MARKER = f"""
m AS (
  SELECT doc_id, coalesce(text, '') AS t, CASE doc_id % 4 WHEN 0 THEN substring(text, 101, 30) WHEN 1 THEN replace(substring(text, 101, 30), ' ', '  ')
         WHEN 2 THEN 'no such marker' ELSE '' END AS k FROM documents
),
f AS (SELECT doc_id, t, k, regexp_replace(t, '\\s+', ' ', 'g') AS flat, {strip("regexp_replace(k, '\\s+', ' ', 'g')")} AS fk FROM m)
"""


def base(select: str) -> str:
    return "WITH " + BASE.rstrip().rstrip(",") + select


def chunked(select: str) -> str:
    return "WITH " + CHUNKS + select


def oracle_sql() -> dict[str, str]:
    fronts = ["Cover", " copyright page", "Uncovered", "About the Author", "Chapter 1", "INTRODUCTION to it", "A Preface", "Dedication", "Contents", "The contents"]
    listed = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    found = {
        "page_lookup": base(" SELECT * FROM p WHERE book_id = 3 AND page_num = 1"),
        "page_scan": base(" SELECT * FROM p"),
        "page_count": base(" SELECT book_id, CAST(count(*) AS INTEGER) AS total_pages FROM p GROUP BY book_id"),
        "book_metadata": base(" SELECT * FROM meta"),
        "toc_normalize": base(" SELECT * FROM toc"),
        "full_text_raw": base(" SELECT book_id, string_agg(text, chr(10) ORDER BY page_num) AS full_text FROM p GROUP BY book_id"),
        "full_text_normalized": base(" SELECT book_id, full_text FROM full_text"),
        "page_positions": base(" SELECT book_id, page_num, CAST(e - length(text) - 1 AS BIGINT) AS start_char, CAST(e AS BIGINT) AS end_char FROM (SELECT *, sum(length(text) + 1) OVER (PARTITION BY book_id ORDER BY page_num) AS e FROM p)"),
        "page_positions_aligned": base(" SELECT book_id, page_num, CAST(start_char AS BIGINT) AS start_char, end_char FROM pos"),
        "sample_lookup": f"WITH s AS (SELECT {listed(SAMPLES)} AS x) SELECT n_nationkey - 7 AS index, x[((n_nationkey - 7) % 6 + 6) % 6 + 1] AS text FROM nation, s",
        "truncate_text": "SELECT doc_id, CASE WHEN length(text) > 10000 THEN left(text, 8000) || chr(10) || chr(10) || '[... truncated ...]' || chr(10) || chr(10) || right(text, 2000) ELSE coalesce(text, '') END AS text, CAST(greatest(coalesce(length(text), 0) - 10000, 0) AS BIGINT) AS dropped_chars FROM documents",
        "marker_position": f"WITH {MARKER} SELECT doc_id, CAST(CASE WHEN coalesce(length(k), 0) = 0 THEN 0 WHEN instr(t, k) > 0 THEN instr(t, k) - 1 WHEN instr(flat, fk) > 0 OR fk = '' THEN CASE WHEN fk = '' OR length(flat) = 0 THEN 0 ELSE floor(CAST(instr(flat, fk) - 1 AS DOUBLE) / length(flat) * length(t)) END ELSE 0 END AS INTEGER) AS position FROM f",
        "chunk_preview": "SELECT doc_id, replace(left(coalesce(text, ''), 200), chr(10), ' ') || CASE WHEN length(text) > 200 THEN '...' ELSE '' END AS preview FROM documents",
        "hierarchy_path_simple": "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand || ' > ' || p_type ELSE p_brand END AS path FROM part",
        "front_matter_filter": f"SELECT * FROM (SELECT n_nationkey, {listed(fronts)}[n_nationkey % 10 + 1] AS title FROM nation) WHERE NOT ({' OR '.join(f"starts_with(lower(trim(title)), '{x}')" for x in FRONT_MATTER)})",
        "toc_char_positions": base(" SELECT book_id, toc_idx, level, title, page, pos FROM t0"),
        "toc_char_positions_reference": base(", rp AS (SELECT book_id, page_num, sum(length(text) + 1) OVER (PARTITION BY book_id ORDER BY page_num) AS e, length(text) + 1 AS l FROM p), le AS (SELECT book_id, max(e) AS last_end FROM rp GROUP BY book_id), st AS (SELECT book_id, toc_idx, level, title, page + CASE WHEN toc_idx % 5 = 4 THEN 100 ELSE 0 END AS page FROM toc) SELECT st.*, CAST(coalesce(e - l, last_end) AS BIGINT) AS pos FROM st LEFT JOIN rp ON st.book_id = rp.book_id AND st.page = rp.page_num JOIN le ON le.book_id = st.book_id"),
        "chapter_spans": base(" SELECT book_id, chapter_number, title, toc_idx, start_char, end_char, 'toc' AS detection_method FROM tree WHERE level = 1"),
        "section_spans": base(" SELECT book_id, chapter_number, toc_idx, level, title, parent_idx, start_char, end_char, greatest(end_char - start_char, 0) AS n_chars FROM tree WHERE level > 1"),
        "section_parents": base(" SELECT book_id, toc_idx, parent_idx, parent_title FROM tree WHERE level > 1"),
        "section_counts": base(" SELECT book_id, chapter_number, count(*) FILTER (level > 1) AS n_sections FROM tree GROUP BY ALL"),
        "leaf_sections": base(" SELECT * EXCLUDE content FROM leaf"),
        "section_contents": base(" SELECT book_id, toc_idx, content FROM leaf"),
        "eligible_sections": base(" SELECT book_id, toc_idx, hierarchy_path, length(content) AS n_chars FROM eligible"),
        "limited_run": base(" SELECT book_id, chapter_number, toc_idx, CAST(c AS INTEGER) AS chapter_rank, CAST(s AS INTEGER) AS section_rank FROM (SELECT *, dense_rank() OVER (PARTITION BY book_id ORDER BY chapter_number) AS c, row_number() OVER (PARTITION BY book_id, chapter_number ORDER BY toc_idx) AS s FROM leaf) WHERE c = 2 AND s = 1"),
        "chapter_page_ranges": base(" SELECT book_id, chapter_number, title, page AS start_page, coalesce(lead(page) OVER (PARTITION BY book_id ORDER BY toc_idx), last_page) AS end_page FROM tree JOIN (SELECT book_id, max(page_num) AS last_page FROM p GROUP BY book_id) USING (book_id) WHERE level = 1"),
        "structure_tree": base(", r AS (SELECT *, row_number() OVER (PARTITION BY book_id, parent_idx ORDER BY toc_idx) AS k, count(*) OVER (PARTITION BY book_id, parent_idx) AS n, CASE depth WHEN 0 THEN 10 WHEN 1 THEN 5 ELSE 3 END AS most FROM tree) SELECT book_id, toc_idx, CAST(depth AS INTEGER) AS depth, repeat('  ', CAST(depth AS INTEGER)) || left(title, 40) AS line, CAST(CASE WHEN k = most AND n > most THEN n - most ELSE 0 END AS BIGINT) AS more FROM r WHERE k <= most"),
        "books_without_toc": base(" SELECT book_id, 'no outline' AS error FROM meta WHERE book_id % 4 = 0"),
        "paragraphs_rule_split": "WITH src AS (SELECT doc_id, replace(coalesce(text, ''), chr(10), chr(10) || chr(10)) AS content FROM documents), " + rule("src", "doc_id") + " SELECT * FROM split",
        "paragraphs_split": base(", long AS (SELECT * FROM eligible), " + rule("long", "book_id, toc_idx") + f" SELECT book_id, toc_idx, 'rule' AS method, paragraph_index, paragraph, para_start, para_end FROM split UNION ALL SELECT book_id, toc_idx, 'whole', 0, content, 0, CAST(length(content) AS INTEGER) FROM leaf WHERE content <> '' AND length({strip('content')}) < 100"),
        "paragraphs_split_model": base(
            f""", lg AS (SELECT *, CASE WHEN length(content) > 10000 THEN left(content, 8000) || chr(10) || chr(10) || '[... truncated ...]' || chr(10) || chr(10) || right(content, 2000) ELSE content END AS ask
  FROM leaf WHERE length({strip("content")}) >= 100), unsaid AS (SELECT * FROM lg WHERE length(ask) % 7 = 0), {rule("unsaid", "book_id, toc_idx")}
SELECT book_id, toc_idx, 'rule' AS method, paragraph_index, paragraph FROM split
UNION ALL SELECT book_id, toc_idx, 'llm', i, CASE i WHEN 0 THEN left(ask, length(ask) // 2) ELSE substring(ask, length(ask) // 2 + 1) END FROM (SELECT *, CAST(unnest([0, 1]) AS INTEGER) AS i FROM lg WHERE length(ask) % 7 <> 0)
UNION ALL SELECT book_id, toc_idx, 'whole', 0, content FROM leaf WHERE content <> '' AND length({strip("content")}) < 100"""
        ),
        "paragraphs_split_aligned": base(
            f""", lg AS (SELECT *, least(length(content), 10000 + length('[... truncated ...]') + 4) // 2 AS half FROM leaf WHERE length({strip("content")}) >= 100),
 cuts AS (SELECT *, half + length(substring(content, half + 1)) - length(regexp_replace(substring(content, half + 1), '^\\s+', '')) AS cut FROM lg)
SELECT book_id, toc_idx, 'llm' AS method, i AS paragraph_index, CASE i WHEN 0 THEN left(content, cut) ELSE substring(content, cut + 1) END AS paragraph, CAST(CASE i WHEN 0 THEN 0 ELSE cut END AS INTEGER) AS para_start,
  CAST(CASE i WHEN 0 THEN cut ELSE length(content) END AS INTEGER) AS para_end, TRUE AS position_exact FROM (SELECT *, CAST(unnest([0, 1]) AS INTEGER) AS i FROM cuts)
UNION ALL SELECT book_id, toc_idx, 'whole', 0, content, 0, CAST(length(content) AS INTEGER), TRUE FROM leaf WHERE content <> '' AND length({strip("content")}) < 100"""
        ),
        "chunks_greedy_merge": "WITH RECURSIVE " + BASE + f"""
g0 AS (SELECT book_id, list_filter(list_transform(string_split(full_text, chr(10) || chr(10)), lambda x: {strip("x")}), lambda x: x <> '') AS b FROM full_text),
g AS (
  SELECT book_id, b, 0 AS k, '' AS buf, CAST(NULL AS VARCHAR) AS chunk FROM g0
  UNION ALL
  SELECT book_id, b, k + 1, CASE WHEN length(joined) >= 1500 THEN '' ELSE joined END, CASE WHEN length(joined) >= 1500 OR (k + 1 = len(b) AND length(joined) >= 100) THEN joined END
  FROM (SELECT *, CASE WHEN buf = '' THEN b[k + 1] ELSE buf || chr(10) || chr(10) || b[k + 1] END AS joined FROM g WHERE k < len(b))
)
SELECT book_id, CAST(row_number() OVER w - 1 AS INTEGER) AS paragraph_index, chunk, CAST(sum(length(chunk)) OVER w - length(chunk) AS INTEGER) AS para_start, CAST(sum(length(chunk)) OVER w AS INTEGER) AS para_end
FROM g WHERE chunk IS NOT NULL WINDOW w AS (PARTITION BY book_id ORDER BY k)""",
        "sentence_chunks": f"""WITH RECURSIVE s0 AS (SELECT doc_id, list_filter(string_split(regexp_replace({strip("coalesce(text, '')")}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS b FROM documents),
s AS (
  SELECT doc_id, b, 0 AS k, '' AS buf, 0 AS n, CAST(NULL AS VARCHAR) AS chunk FROM s0
  UNION ALL
  SELECT doc_id, b, k + 1, CASE WHEN k = len(b) THEN '' WHEN ends OR n = 0 THEN b[k + 1] ELSE buf || ' ' || b[k + 1] END, CASE WHEN ends THEN 1 ELSE n + 1 END, CASE WHEN ends OR k = len(b) THEN buf END
  FROM (SELECT *, k < len(b) AND n > 0 AND length(buf) >= 150 AND (n >= 5 OR length(buf) + 1 + length(b[k + 1]) > 1000) AS ends FROM s WHERE k <= len(b) AND len(b) > 0)
)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS paragraph_index, chunk FROM s WHERE chunk IS NOT NULL""",
        "chunks_build": chunked(" SELECT book_id, chapter_number, toc_idx, hierarchy_path, section_paragraph_index, chapter_paragraph_index, book_paragraph_index, paragraph, 'rule' AS method FROM chunks"),
        "chunk_quality": chunked(", o AS (SELECT *, greatest(coalesce(lag(para_end) OVER (PARTITION BY book_id, toc_idx ORDER BY section_paragraph_index) - para_start, 0), 0) AS over_ FROM chunks) SELECT o.book_id, o.toc_idx, count(*) AS n_chunks, count(*) FILTER (length(paragraph) NOT BETWEEN 100 AND 1200) AS n_off_band, CAST(sum(length(paragraph)) AS BIGINT) AS chunk_chars, CAST(sum(over_) AS BIGINT) AS overlap_chars, any_value(length(content)) AS section_chars, round(CAST(sum(length(paragraph)) AS DOUBLE) / any_value(length(content)), 6) AS coverage FROM o JOIN leaf USING (book_id, toc_idx) GROUP BY o.book_id, o.toc_idx"),
        "concept_extract": f"WITH {DOCS} SELECT * FROM di",
        "json_parse": "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'c' || doc_id END AS concept, CAST(CASE doc_id % 5 WHEN 3 THEN 0 WHEN 4 THEN 2 END AS INTEGER) AS n_paragraphs, CAST(CASE doc_id % 5 WHEN 3 THEN 0 WHEN 4 THEN 1 END AS INTEGER) AS n_pairs FROM documents",
        "dedup_within_book": f"WITH {DOCS} SELECT book_id, chunk_id, concept FROM (SELECT *, row_number() OVER (PARTITION BY book_id, concept ORDER BY chunk_id) AS k FROM di) WHERE coalesce(concept, '') = '' OR k = 1",
        "dedup_global": f"WITH {DOCS} SELECT book_id, chunk_id, concept FROM (SELECT *, row_number() OVER (PARTITION BY concept ORDER BY book_id, chunk_id) AS k FROM di) WHERE coalesce(concept, '') = '' OR k = 1",
        "dedup_against_store": f"WITH {DOCS} SELECT book_id, chunk_id, concept FROM di a WHERE chunk_id % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM di b WHERE b.chunk_id % 3 = 0 AND b.concept <> '' AND b.book_id = a.book_id AND b.concept = a.concept)",
        "duplicates_skipped": f"WITH {DOCS} SELECT book_id, chunk_id, concept FROM (SELECT *, row_number() OVER (PARTITION BY book_id, concept ORDER BY chunk_id) AS k FROM di) WHERE concept <> '' AND k > 1",
        "near_dup_cosine": "SELECT * FROM (SELECT a.vec_id AS vec_a, b.vec_id AS vec_b, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id) WHERE cosine >= 0.4",
        "idea_groups": """WITH RECURSIVE e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  WHERE round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) >= 0.4),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT g AS idea_group_id, 'idea ' || g AS canonical_idea_text, count(*) AS members FROM (SELECT x, min(y) AS g FROM r GROUP BY x) GROUP BY g""",
        "idea_groups_index": """WITH RECURSIVE x AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  UNION ALL SELECT vec_id + 1000000, list_transform(CAST(embedding AS DOUBLE[]), lambda v, i: v * (1 + 0.3 * ((i - 1 + vec_id) % 3 - 1))) FROM embeddings),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM x a JOIN x b ON a.vec_id <> b.vec_id WHERE round(list_cosine_similarity(a.v, b.v), 6) >= 0.9),
r AS (SELECT vec_id AS x, vec_id AS y FROM x UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT g AS idea_group_id, 'idea ' || g AS canonical_idea_text, count(*) AS members FROM (SELECT x, min(y) AS g FROM r GROUP BY x) GROUP BY g""",
        "stored_idea_groups": chunked(" SELECT concept AS canonical_idea_text, count(*) AS members FROM saved GROUP BY concept"),
        "books_build": base(" SELECT book_id AS id, CASE WHEN title = '' THEN 'vol-' || book_id ELSE title END AS title, CASE WHEN author = '' THEN 'Unknown' ELSE author END AS author, source_path FROM meta"),
        "book_exists": base(" SELECT book_id AS id, CASE WHEN title = '' THEN 'vol-' || book_id ELSE title END AS title, book_id % 2 = 0 AS already_stored FROM meta"),
        "chapters_build": base(" SELECT * FROM chap"),
        "sections_build": base(" SELECT * FROM sec"),
        "section_title_map": base(" SELECT book_id, chapter_number, title, max(section_number) AS section_number FROM sec GROUP BY ALL"),
        "section_next_number": base(" SELECT c.book_id, c.chapter_number, coalesce(max(section_number), 0) + 1 AS next_number FROM chap c LEFT JOIN sec s USING (book_id, chapter_number) GROUP BY ALL"),
        "section_get_or_create": base(", have AS (SELECT book_id, chapter_number, title, min(section_number) AS n FROM sec GROUP BY ALL), top AS (SELECT book_id, chapter_number, max(section_number) AS top FROM sec GROUP BY ALL), ask AS (SELECT DISTINCT book_id, chapter_number, title FROM (SELECT book_id, chapter_number, title FROM sec UNION ALL SELECT book_id, chapter_number, 'new ' || title FROM sec)), j AS (SELECT ask.*, n, top, row_number() OVER (PARTITION BY ask.book_id, ask.chapter_number, n IS NULL ORDER BY ask.title) AS k FROM ask LEFT JOIN have USING (book_id, chapter_number, title) LEFT JOIN top USING (book_id, chapter_number)) SELECT book_id, chapter_number, title, CAST(coalesce(n, coalesce(top, 0) + k) AS INTEGER) AS section_number, n IS NULL AS is_new FROM j"),
        "parent_section_lookup": base(", tm AS (SELECT book_id, chapter_number, title AS parent_title, max(section_number) AS parent_number FROM sec WHERE title <> '' GROUP BY ALL) SELECT book_id, chapter_number, toc_idx, parent_title, parent_number FROM tree LEFT JOIN tm USING (book_id, chapter_number, parent_title) WHERE level > 1"),
        "chunks_persisted": chunked(" SELECT book_id, chapter_number, toc_idx, page AS page_number, book_paragraph_index AS paragraph_index, chapter_paragraph_index, paragraph AS body_text FROM saved"),
        "key_ideas_build": chunked(" SELECT book_id, chapter_number, toc_idx, hierarchy_path, concept AS core_idea_text FROM saved"),
        "book_by_id": base(" SELECT book_id AS id, CASE WHEN title = '' THEN 'vol-' || book_id ELSE title END AS title, CASE WHEN author = '' THEN 'Unknown' ELSE author END AS author, source_path FROM meta WHERE book_id = 5"),
        "book_by_title": base(" SELECT book_id AS id, title, CASE WHEN author = '' THEN 'Unknown' ELSE author END AS author, source_path FROM meta WHERE title = 'Book 7'"),
        "chunks_by_book": chunked(" SELECT book_id, page AS page_number, toc_idx, book_paragraph_index AS paragraph_index, paragraph AS body_text FROM saved WHERE book_id = 5"),
        "ideas_by_book": chunked(" SELECT book_id, toc_idx, concept AS core_idea_text FROM saved WHERE book_id = 5"),
        "chapters_by_book": base(f" SELECT {CHAPTER} WHERE book_id = 5"),
        "chapter_by_id": base(f" SELECT {CHAPTER} WHERE book_id = 5 AND chapter_number = 2"),
        "chunks_by_chapter": chunked(" SELECT book_id, chapter_paragraph_index, paragraph AS body_text FROM saved WHERE book_id = 5 AND chapter_number = 1"),
        "sections_by_chapter": base(" SELECT book_id, chapter_number, section_number, title FROM sec WHERE book_id = 5 AND chapter_number = 1"),
        "section_by_id": base(" SELECT book_id, section_number, title, level FROM sec WHERE book_id = 5 AND chapter_number = 1 AND section_number = 2"),
        "chunks_by_section": chunked(" SELECT book_id, chapter_paragraph_index, paragraph AS body_text FROM saved WHERE book_id = 5 AND toc_idx IN (SELECT toc_idx FROM sec WHERE book_id = 5 AND chapter_number = 1 AND section_number = 2)"),
        "stored_chunks": chunked(" SELECT s.book_id, s.page AS page_number, s.book_paragraph_index AS paragraph_index, s.chapter_paragraph_index, length(s.paragraph) AS n_chars, CASE WHEN meta.title = '' THEN 'vol-' || s.book_id ELSE meta.title END AS book_title, s.chapter_number, c.title AS chapter_title, sec.section_number, sec.title AS section_title, s.concept AS core_idea_text FROM saved s JOIN meta USING (book_id) JOIN chap c ON c.book_id = s.book_id AND c.chapter_number = s.chapter_number LEFT JOIN sec ON sec.book_id = s.book_id AND sec.toc_idx = s.toc_idx"),
        "stored_chapters": base(f" SELECT c.*, 'completed' AS status, CAST(1 AS INTEGER) AS attempt_count, 'chapter' AS processing_unit FROM (SELECT {CHAPTER}) c"),
        "stored_after_delete": chunked(f", cut AS (SELECT book_id, toc_idx FROM sec WHERE book_id = 7 AND section_number = 2), left_ AS (SELECT book_id FROM saved WHERE book_id <> 5 AND NOT EXISTS (SELECT 1 FROM cut WHERE cut.book_id = saved.book_id AND cut.toc_idx = saved.toc_idx)) SELECT m.book_id, {LEFT} FROM meta m"),
        "resumed_run": chunked(" SELECT book_id, book_paragraph_index AS paragraph_index, concept AS core_idea_text FROM saved"),
        "delete_chapters_by_book": base(" SELECT * FROM chap WHERE book_id % 10 <> 0"),
        "delete_sections_by_chapter": base(" SELECT count(*) AS deleted FROM sec WHERE book_id = 5 AND chapter_number = 1"),
        "progress_transition": f"WITH {STATE} SELECT * FROM state",
        "progress_init": base(" SELECT book_id, chapter_number AS unit_id, 'pending' AS status, CAST(0 AS INTEGER) AS attempt_count, 'chapter' AS processing_unit FROM chap WHERE book_id % 2 <> 0"),
        "pending_chapters": base(f", {STATE} SELECT chap.* FROM chap WHERE EXISTS (SELECT 1 FROM state s WHERE s.book_id = chap.book_id AND s.unit_id = chap.chapter_number AND s.status = 'pending')"),
        "chapters_remaining": base(f", {STATE} SELECT chap.* FROM chap WHERE NOT EXISTS (SELECT 1 FROM state s WHERE s.book_id = chap.book_id AND s.unit_id = chap.chapter_number AND s.status = 'completed')"),
        "progress_stats": f"WITH {STATE} SELECT book_id, count(*) AS total, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'processing') AS processing, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, CAST(count(*) FILTER (status = 'completed') AS DOUBLE) / count(*) * 100 AS completion_rate FROM state GROUP BY book_id",
        "progress_reset_stuck": f"WITH {STATE} SELECT book_id, unit_id, CASE WHEN status = 'processing' THEN 'pending' ELSE status END AS status, status = 'processing' AS was_reset FROM state",
        "book_processed": f"WITH {STATE} SELECT book_id, count(*) = count(*) FILTER (status = 'completed') AS processed FROM state GROUP BY book_id",
        "run_stats": chunked(", c AS (SELECT book_id, count(*) FILTER (level = 1) AS total_chapters FROM tree GROUP BY book_id), l AS (SELECT book_id, count(*) AS total_sections FROM leaf GROUP BY book_id), i AS (SELECT book_id, count(*) AS total_paragraphs, count(concept) AS extracted_ideas, count(*) FILTER (concept IS NOT NULL AND NOT is_dup) AS total_ideas, count(*) FILTER (concept <> '' AND NOT is_dup) AS named_ideas, count(*) FILTER (is_dup) AS duplicates FROM ideas GROUP BY book_id) SELECT book_id, total_chapters, total_chapters AS completed_chapters, CAST(0 AS BIGINT) AS failed_chapters, coalesce(total_sections, 0) AS total_sections, coalesce(total_paragraphs, 0) AS total_paragraphs, coalesce(extracted_ideas, 0) AS extracted_ideas, coalesce(total_ideas, 0) AS total_ideas, coalesce(named_ideas, 0) AS named_ideas, coalesce(duplicates, 0) AS duplicates FROM c LEFT JOIN l USING (book_id) LEFT JOIN i USING (book_id)"),
        "run_summary": chunked(", c AS (SELECT book_id, count(*) FILTER (level = 1) AS total_chapters FROM tree GROUP BY book_id), l AS (SELECT book_id, count(*) AS total_sections FROM leaf GROUP BY book_id), i AS (SELECT book_id, count(*) AS total_paragraphs, count(concept) AS extracted_ideas, count(*) FILTER (concept IS NOT NULL AND NOT is_dup) AS total_ideas, count(*) FILTER (concept <> '' AND NOT is_dup) AS named_ideas, count(*) FILTER (is_dup) AS duplicates FROM ideas GROUP BY book_id), z AS (SELECT book_id, total_chapters, total_chapters AS completed_chapters, CAST(0 AS BIGINT) AS failed_chapters, coalesce(total_sections, 0) AS total_sections, coalesce(total_paragraphs, 0) AS total_paragraphs, coalesce(extracted_ideas, 0) AS extracted_ideas, coalesce(total_ideas, 0) AS total_ideas, coalesce(named_ideas, 0) AS named_ideas, coalesce(duplicates, 0) AS duplicates FROM c LEFT JOIN l USING (book_id) LEFT JOIN i USING (book_id)) SELECT book_id, 'method: toc' || chr(10) || 'chapters: ' || total_chapters || chr(10) || 'sections: ' || total_sections || chr(10) || 'completed: ' || completed_chapters || chr(10) || 'failed: ' || failed_chapters || chr(10) || 'paragraphs: ' || total_paragraphs || chr(10) || 'ideas: ' || total_ideas || chr(10) || 'duplicates skipped: ' || duplicates AS summary FROM z"),
        "concept_counts": chunked(" SELECT book_id, count(DISTINCT chapter_number) AS n_chapters, count(*) AS n_paragraphs, count(*) FILTER (concept <> '') AS n_concepts FROM ideas GROUP BY book_id"),
        "inspection_report": chunked(f", {STATE}, s AS (SELECT book_id, count(*) AS units, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'processing') AS processing, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed FROM state GROUP BY book_id), c AS (SELECT book_id, count(*) AS n, min(page) AS p, max(page) AS q, min(toc_idx) AS a, max(toc_idx) AS b FROM saved GROUP BY book_id) SELECT coalesce(s.book_id, c.book_id) AS book_id, coalesce(units, 0) AS units, coalesce(pending, 0) AS pending, coalesce(processing, 0) AS processing, coalesce(completed, 0) AS completed, coalesce(failed, 0) AS failed, coalesce(round(CAST(completed AS DOUBLE) / units * 100, 4), 0) AS completion, coalesce(n, 0) AS n_chunks, p AS first_page, q AS last_page, a AS first_place, b AS last_place, coalesce(n, 0) AS n_ideas FROM s FULL JOIN c ON s.book_id = c.book_id"),
        "result_tree_json": chunked(
            """, pj AS (
  SELECT *, '{"index":' || section_paragraph_index || ',"text":' || to_json(paragraph) || ',"text_length":' || length(paragraph) || CASE WHEN concept IS NULL THEN '' ELSE ',"concept":' || to_json(concept) END || '}' AS j FROM ideas
),
sj AS (
  SELECT book_id, chapter_number, chapter_title, toc_idx, '{"toc_idx":' || toc_idx || ',"title":' || to_json(title) || ',"level":' || level || ',"hierarchy_path":' || to_json(hierarchy_path)
         || ',"paragraph_count":' || count(*) || ',"paragraphs":[' || string_agg(j, ',' ORDER BY section_paragraph_index) || ']}' AS j
  FROM pj GROUP BY book_id, chapter_number, chapter_title, toc_idx, title, level, hierarchy_path
)
SELECT book_id, chapter_number, '{"chapter_number":' || chapter_number || ',"title":' || to_json(chapter_title) || ',"section_count":' || count(*) || ',"sections":[' || string_agg(j, ',' ORDER BY toc_idx) || ']}' AS result
FROM sj GROUP BY book_id, chapter_number, chapter_title"""
        ),
        "section_forward_fill": base(", f AS (SELECT book_id, page_num, CASE page_num % 3 WHEN 1 THEN left(text, 12) WHEN 2 THEN 'NULL' END AS title FROM p) SELECT *, last_value(CASE WHEN lower(title) <> 'null' THEN title END IGNORE NULLS) OVER (PARTITION BY book_id ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM f"),
        "table_run_filter": """WITH l AS (SELECT doc_id, unnest(range(0, len(x))) AS line_no, x FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
s AS (SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CASE WHEN line_no % 7 < 3 THEN '| ' || x[line_no + 1] || ' |' ELSE x[line_no + 1] END AS line FROM l),
r AS (SELECT *, regexp_matches(line, '(\\|.*\\||\\t.*\\t|\\S {2,}\\S+ {2,}\\S)') AS tl FROM s),
q AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - row_number() OVER (PARTITION BY doc_id, tl ORDER BY line_no) AS run FROM r),
z AS (SELECT *, count(*) OVER (PARTITION BY doc_id, tl, run) AS n FROM q)
SELECT doc_id, line_no, line FROM z WHERE NOT tl OR n < 3""",
        "table_run_filter_whole": """WITH l AS (SELECT doc_id, unnest(range(0, len(x))) AS line_no, x FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
s AS (SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CASE WHEN line_no % 7 < 3 THEN '| ' || x[line_no + 1] || ' |' ELSE x[line_no + 1] END AS line FROM l),
r AS (SELECT *, regexp_matches(line, '(\\|.*\\||\\t.*\\t|\\S {2,}\\S+ {2,}\\S)') AS tl FROM s),
q AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - row_number() OVER (PARTITION BY doc_id, tl ORDER BY line_no) AS run FROM r),
z AS (SELECT *, count(*) OVER (PARTITION BY doc_id, tl, run) AS n FROM q)
SELECT doc_id, line_no, line FROM z WHERE NOT tl OR n < 3""",
        "heading_chapters": "SELECT * FROM (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'Chapter ' WHEN 1 THEN 'part ' ELSE 'Chapters ' END || p_size AS line FROM part) WHERE line LIKE 'Chapter %' OR line LIKE 'part %'",
    }
    return found
