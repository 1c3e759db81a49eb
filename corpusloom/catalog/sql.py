"""Shared parts of the check SQL: the fixtures, restated over the base tables."""

EXAMPLES = """ex AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS instruction, '' AS input, text AS output,
         source AS category, lang AS type, source || '.jsonl' AS source_file, n_chars
  FROM documents)"""

# A verdict belongs to a text and is made from its lowest doc_id.
JUDGED = EXAMPLES + """,
rep AS (SELECT text, min(doc_id) AS d, min(n_chars) AS n FROM documents GROUP BY text),
marks AS (
  SELECT text AS output, 2 + (d * 7 + n) % 4 AS a, 2 + (d * 3 + n * 5) % 4 AS b,
         2 + (d * 11 + n * 3) % 4 AS c, 2 + (d + n * 7) % 4 AS q
  FROM rep WHERE d % 17 <> 0),
judged AS (
  SELECT ex.*, coalesce(a, 0)::DOUBLE AS completeness, coalesce(b, 0)::DOUBLE AS alignment,
         coalesce(c, 0)::DOUBLE AS best_practices, coalesce(q, 0)::DOUBLE AS code_quality,
         coalesce(round_even((a + b + c + q) / 4.0, 2), 0)::DOUBLE AS avg_score,
         CASE WHEN least(a, b, c, q) >= 3 AND (a + b + c + q) / 4.0 >= 3.5 THEN 'accept' ELSE 'reject' END AS verdict,
         CASE WHEN a IS NULL THEN 'Judge error after 4 attempts' ELSE 'fits {well}' END AS reason
  FROM ex LEFT JOIN marks USING (output))"""

GRID = """kinds AS (SELECT event_type AS variation, row_number() OVER (ORDER BY event_type) - 1 AS v
  FROM (SELECT DISTINCT event_type FROM events)),
cats AS (SELECT DISTINCT source AS category FROM documents),
grid AS (
  SELECT category, 7000::BIGINT AS max_tokens, k AS ordinal,
         'Describe ' || category || ' part ' || k AS prompt, 'Generic' AS domain
  FROM cats, range(8) AS r(k)
  UNION ALL
  SELECT category, 7000::BIGINT, 8 + n_nationkey * (SELECT count(*) FROM kinds) + v,
         'Write on case ' || n_nationkey || ' for a ' || n_name || ' firm {variation} ' || n_nationkey
         || ' with Obj_' || n_regionkey || '__c. ' || variation || ' {ok}', n_name
  FROM cats, nation, kinds)"""

COMPONENT = """comp AS (
  SELECT doc_id, text, split_part(text, chr(10), 1) AS instruction,
    'class A {' || chr(10) AS top,
    '    @track name = ''x'';' || chr(10) || '    @track items = [];' || chr(10) AS tracked,
    '    name = ''x'';' || chr(10) || '    @track items = [];' || chr(10) AS untracked,
    '    isLoading = false;' || chr(10) AS field,
    CASE doc_id % 4
      WHEN 1 THEN '    get isLoading() { return true; }' || chr(10)
      WHEN 2 THEN '<!-- a.html -->' || chr(10) || '<!-- b-c.html -->' || chr(10)
      WHEN 3 THEN '/* a.css */' || chr(10) || '```css' || chr(10) || ':host {}' || chr(10) || '```' || chr(10)
      ELSE '' END AS extra,
    '}' || chr(10) || text AS rest
  FROM documents)"""

SECTIONS = """sec AS (
  SELECT page_id, url AS instruction, html,
    CASE WHEN page_id % 7 = 0 THEN 'const a = 1;'
         WHEN page_id % 5 = 0 THEN 'describe(''c-page-card-' || page_id || 'x'', () => { it(''a'', f); });'
         ELSE 'export default class Page' || page_id || ' {}' END AS js,
    CASE WHEN page_id % 3 = 1 THEN ':host {}' ELSE '' END AS css,
    CASE WHEN page_id % 7 = 0 THEN 'MyComponent'
         WHEN page_id % 5 = 0 THEN 'PageCard' || page_id || 'X'
         ELSE 'Page' || page_id END AS name,
    CASE WHEN page_id % 7 = 0 OR page_id % 5 = 0 THEN 'GraphqlComponent' ELSE 'Page' || page_id END AS strict_name
  FROM pages),
built AS (
  SELECT *, lower(name[1]) || name[2:] AS file,
    '<!-- ' || lower(name[1]) || name[2:] || '.html -->' || chr(10) || html || chr(10) || chr(10)
    || '// ' || lower(name[1]) || name[2:] || '.js' || chr(10) || js
    || CASE WHEN css <> '' THEN chr(10) || chr(10) || '/* ' || lower(name[1]) || name[2:] || '.css */' || chr(10) || css
       ELSE '' END AS output,
    '<!-- ' || lower(strict_name[1]) || strict_name[2:] || '.html -->' || chr(10) || html || chr(10) || chr(10)
    || '// ' || lower(strict_name[1]) || strict_name[2:] || '.js' || chr(10) || js
    || CASE WHEN css <> '' THEN chr(10) || chr(10) || '/* ' || lower(strict_name[1]) || strict_name[2:] || '.css */' || chr(10)
              || '```css' || chr(10) || css || chr(10) || '```'
       ELSE '' END AS strict_output
  FROM sec)"""
