"""DuckDB SQL for the queries that SQL can express."""

OP1 = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, text, {WORDS} AS w FROM documents),
s0 AS (SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sh AS (SELECT doc_id, s, count(*) AS c FROM s0 GROUP BY ALL),
n AS (SELECT doc_id, sum(c) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.c, b.c)) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e0 AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE CAST(k AS DOUBLE) / CAST(a.n + b.n - k AS DOUBLE) >= 0.8
  UNION SELECT a.doc_id, b.doc_id FROM d a JOIN d b ON a.text = b.text AND a.doc_id < b.doc_id
),
e AS (SELECT x, y FROM e0 UNION SELECT y, x FROM e0),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT x AS doc_id, min(y) AS class_id, count(*) AS class_size, x = min(y) AS kept FROM r GROUP BY x
"""

OP9 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT d.doc_id, d.w, s.size, unnest(range(1, len(w) - s.size + 2)) AS i FROM d, sizes s WHERE len(w) >= s.size)
),
h AS (SELECT DISTINCT doc_id, i, size, item_id FROM dw JOIN bw USING (size, win)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP10 = """
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines,
         list_transform(string_split(text, chr(10)), lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT)) AS h
  FROM documents WHERE text IS NOT NULL
),
e AS (
  SELECT doc_id, text, lines, list_filter(range(0, len(lines)), lambda i: i = len(lines) - 1
         OR (i > 0 AND ((h[i] * 31 + h[i + 1]) % 65521) % 3 = 0)) AS ends
  FROM l
),
c AS (
  SELECT doc_id, j, CASE WHEN j = 1 THEN 0 ELSE ends[j - 1] + 1 END AS f, ends[j] AS t, lines
  FROM (SELECT *, unnest(range(1, len(ends) + 1)) AS j FROM e)
),
k AS (SELECT doc_id, j, t - f + 1 AS n, array_to_string(lines[f + 1 : t + 1], chr(10)) AS chunk FROM c),
r AS (
  SELECT *, n >= 2 AND length(chunk) >= 40
         AND row_number() OVER (PARTITION BY n >= 2 AND length(chunk) >= 40, chunk ORDER BY doc_id, j) > 1 AS gone
  FROM k
),
g AS (
  SELECT doc_id, sum(n) AS n_lines, sum(CASE WHEN gone THEN n ELSE 0 END) AS n_removed, count(*) FILTER (gone) AS n_chunks,
         coalesce(string_agg(chunk, chr(10) ORDER BY j) FILTER (NOT gone), '') AS text
  FROM r GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_chunks, 0) AS BIGINT) AS n_chunks, CAST(length(g.text) AS BIGINT) AS n_chars, md5(g.text) AS text_md5
FROM documents d LEFT JOIN g USING (doc_id)
"""

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
s AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({WORDS}) AS t FROM benchmark),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), s),
im AS (SELECT r, doc_id, t, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(w) * nn) // ll)) AS impact FROM tf JOIN d USING (r), s),
sc AS (SELECT item_id, r, doc_id, CAST(sum(weight * impact) AS BIGINT) AS score FROM q JOIN wt USING (t) JOIN im USING (t) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM sc WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50
"""


def op11(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Each round of the codebooks is a table of its own."""
    floor_mean = "CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
    steps = "".join(
        f"""a{i} AS MATERIALIZED (SELECT r, p, e, dist FROM (
  SELECT r, p, e, dist, row_number() OVER (PARTITION BY r, p ORDER BY dist, e) AS nth FROM (
    SELECT r, p, e, sum((x.v - c.v) * (x.v - c.v)) AS dist FROM x JOIN c{i} c USING (p, j) GROUP BY r, p, e)) WHERE nth = 1),
"""
        + (
            f"""c{i + 1} AS MATERIALIZED (SELECT p, e, j, coalesce(n.v, o.v) AS v FROM c{i} o LEFT JOIN (
  SELECT p, e, j, {floor_mean} AS v FROM (SELECT p, e, j, v AS x FROM a{i} JOIN x USING (r, p)) GROUP BY p, e, j) n USING (p, e, j)),
"""
            if i < rounds
            else ""
        )
        for i in range(rounds + 1)
    )
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
x AS MATERIALIZED (SELECT r, i // (n // {parts}) AS p, i % (n // {parts}) AS j, q[i + 1] AS v FROM (SELECT r, q, len(q) AS n, unnest(range(0, len(q))) AS i FROM v)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, v FROM x WHERE r <= {entries}),
{steps}f AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM v JOIN f USING (r) GROUP BY label),
b AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM v JOIN f USING (r) JOIN l ON v.label IS NOT DISTINCT FROM l.label, b
"""


def op7() -> str:
    """The templates and phrases come from the operator's own lists."""
    from .license_scan import PHRASES, TEMPLATES

    rows = lambda pairs: ", ".join(f"({i}, '{text}', '{label}')" for i, (text, label) in enumerate(pairs))
    return f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(0, len(w))) AS pos FROM d),
phrases(pid, phrase, label) AS (VALUES {rows(PHRASES)}),
ph AS (SELECT phrase, label, string_split(phrase, ' ') AS q FROM phrases),
templates(tid, notice, label) AS (VALUES {rows(TEMPLATES)}),
t AS (SELECT tid, label, string_split(notice, ' ') AS q FROM templates),
tg AS (SELECT tid, i AS tpos, q[i + 1] AS a, q[i + 2] AS b, q[i + 3] AS c FROM (SELECT *, unnest(range(0, len(q) - 2)) AS i FROM t)),
w3 AS (SELECT doc_id, pos, w, w[pos + 1] AS a, w[pos + 2] AS b, w[pos + 3] AS c FROM p),
hb AS (SELECT doc_id, pos, label FROM w3 JOIN ph ON w3.a = q[1] AND w[pos + 1 : pos + len(q)] = q),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word FROM hb GROUP BY doc_id),
v AS (SELECT DISTINCT doc_id, tid, pos, tpos, pos - tpos AS diag FROM w3 JOIN tg USING (a, b, c)),
dg AS (SELECT doc_id, tid, diag, min(pos) AS f, max(pos) AS l FROM v GROUP BY ALL),
nw AS (SELECT *, CASE WHEN diag - lag(diag) OVER (PARTITION BY doc_id, tid ORDER BY diag) <= 2 THEN 0 ELSE 1 END AS fresh FROM dg),
sp AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, tid ORDER BY diag ROWS UNBOUNDED PRECEDING) AS span FROM nw),
ends AS (SELECT doc_id, tid, span, min(f) AS f, max(l) + 2 AS l FROM sp GROUP BY ALL),
cv AS (SELECT doc_id, tid, span, count(DISTINCT x) AS n FROM (SELECT doc_id, tid, span, unnest(range(tpos, tpos + 3)) AS x FROM sp JOIN v USING (doc_id, tid, diag)) GROUP BY ALL),
m AS (SELECT doc_id, label, round(CAST(n AS DOUBLE) / len(q), 6) AS cover, l - f + 1 <= len(q) * 1.5 AS tight FROM cv JOIN ends USING (doc_id, tid, span) JOIN t USING (tid)),
best AS (SELECT doc_id, max(cover) AS best FROM m GROUP BY doc_id),
lb AS (SELECT DISTINCT doc_id, label, 1 AS base FROM hb UNION SELECT DISTINCT doc_id, label, 0 FROM m WHERE cover >= 0.75 AND tight),
bl AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM lb WHERE base = 1 GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM lb GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN al USING (doc_id)
"""


def op6(rounds: int = 12) -> str:
    """The rules come from the operator's own list; each round of propagation is a table of its own."""
    from .url_filter import RULES

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = lambda url: f"translate(regexp_extract(regexp_extract({url}, '(?s)^.*?://(.*)$', 1), '^([^/?#]*)', 1), '{upper}', '{lower}')"
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    ranks = "".join(
        f"""r{i} AS (SELECT kind, host, sum(rank) AS rank FROM (
  SELECT s.kind, s.dst AS host, r.rank * s.w * 0.85 AS rank FROM r{i - 1} r JOIN steps s ON r.kind = s.kind AND r.host = s.src UNION ALL SELECT * FROM r0) GROUP BY kind, host),
"""
        for i in range(1, rounds + 1)
    )
    return f"""
WITH rules(rh, rp, rv) AS (VALUES {rules}),
p AS (SELECT row_number() OVER () AS n, page_id, html, {host("coalesce(url, '')")} AS host,
             regexp_extract(regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1), '^[^/?#]*([^?#]*)', 1) AS path FROM pages),
f AS (SELECT n, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv FROM p, rules
      WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY n),
j AS (SELECT p.*, rule, rv FROM p LEFT JOIN f USING (n)),
l0 AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?i)href\\s*=\\s*["'']?\\s*((?:https?:)?//[^"''\\s>]+)', 1)) AS u FROM j),
l1 AS (SELECT src, {host("regexp_replace(u, '^//', 'http://')")} AS dst FROM l0),
link AS (SELECT src, dst, count(*) AS n FROM l1 WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY ALL),
hosts AS (SELECT host FROM j WHERE host <> '' UNION SELECT dst FROM link),
parts AS (SELECT DISTINCT array_to_string(x[i:], '.') AS a, array_to_string(x[i + 1:], '.') AS b
          FROM (SELECT x, unnest(range(1, len(x))) AS i FROM (SELECT string_split(host, '.') AS x FROM hosts)) WHERE len(x) - i >= 2),
edges AS (SELECT src, dst, sum(n) AS n FROM (SELECT * FROM link UNION ALL SELECT a, b, 1 FROM parts UNION ALL SELECT b, a, 1 FROM parts) GROUP BY ALL),
steps AS (
  SELECT 'trust' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS w FROM edges
  UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM edges
),
seeds AS (SELECT host, avg(CASE WHEN rv = 'allow' THEN 1.0 ELSE 0.0 END) AS t, avg(CASE WHEN rv = 'block' THEN 1.0 ELSE 0.0 END) AS d FROM j WHERE host <> '' GROUP BY host),
r0 AS (SELECT 'trust' AS kind, host, t * (1 - 0.85::DOUBLE) AS rank FROM seeds WHERE t > 0 UNION ALL SELECT 'distrust', host, d * (1 - 0.85::DOUBLE) FROM seeds WHERE d > 0),
{ranks}sc AS (SELECT host, round(coalesce(sum(rank) FILTER (kind = 'trust'), 0.0), 9) AS trust, round(coalesce(sum(rank) FILTER (kind = 'distrust'), 0.0), 9) AS distrust FROM r{rounds} GROUP BY host)
SELECT page_id, j.host, path, rule, coalesce(rv, CASE WHEN distrust > trust AND distrust > 0.01 THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0.0)::DOUBLE AS trust, coalesce(distrust, 0.0)::DOUBLE AS distrust
FROM j LEFT JOIN sc ON j.host = sc.host
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filter": op6(), "op1_topk": OP1, "op4_near_dedup": OP4, "op7_license_scan": op7(), "op9_decontaminate": OP9, "op10_line_dedup": OP10, "op11_vector_codes": op11(), "op12_lexical": OP12}
