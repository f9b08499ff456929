"""DuckDB SQL for the operators that SQL can express."""

_WHITE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

LINE_DEDUP = f"""
WITH lists AS (
  SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT row_no, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no FROM lists
), keyed AS (
  SELECT *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, coalesce(k.doc_id <> r.last_doc, false) AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_no
"""

SOURCE_MIX = """
WITH sizes AS (
  SELECT source, CAST(sum(greatest(length(coalesce(text, '')), 1)) AS BIGINT) AS size FROM documents GROUP BY source
), weights AS (
  SELECT *, CAST(floor(sqrt(CAST(size AS DOUBLE)) * 1000) AS BIGINT) AS weight FROM sizes
), rates AS (
  SELECT source, weight * CAST((SELECT sum(size) FROM weights) AS DOUBLE)
    / (CAST((SELECT sum(weight) FROM weights) AS DOUBLE) * size) AS rate
  FROM weights
), steps AS (
  SELECT source, rate, CAST(greatest(ceil(rate / 16.0), 1) AS INTEGER) AS steps FROM rates
), up_to AS (
  SELECT source, k, sum(exp(-rate / steps) * pow(rate / steps, k) / gamma(k + 1.0))
    OVER (PARTITION BY source ORDER BY k) AS up_to
  FROM steps, (SELECT unnest(range(0, 81)) AS k)
), held AS (
  SELECT *, row_number() OVER () AS row_no, count(*) OVER (PARTITION BY doc_id) AS holders,
         '{' || concat_ws(',', '"doc_id":' || doc_id, '"text":' || to_json(text), '"lang":' || to_json(lang),
                          '"source":' || to_json(source), '"n_chars":' || n_chars) || '}' AS contents
  FROM documents
), named AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND holders = 1 THEN CAST(doc_id AS VARCHAR)
                 ELSE md5(contents) || '/' || row_number() OVER (PARTITION BY contents) END AS id
  FROM held
), draws AS (
  SELECT d.doc_id, d.source, d.text, d.row_no, d.id, unnest(range(1, s.steps + 1)) AS step
  FROM named d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
), drawn AS (
  SELECT *, CAST('0x' || substr(md5('0:copies:' || step || ':' || id), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM draws
), counted AS (
  SELECT any_value(d.doc_id) AS doc_id, any_value(d.id) AS id, any_value(d.source) AS source, any_value(d.text) AS text,
         CAST(count(*) FILTER (p.up_to <= d.u) AS INTEGER) AS copies
  FROM drawn d JOIN up_to p ON d.source IS NOT DISTINCT FROM p.source GROUP BY d.row_no
), copied AS (
  SELECT doc_id, id, source, text, CAST(unnest(range(1, copies + 1)) AS INTEGER) AS copy FROM counted
)
SELECT doc_id, source, copy, md5('0:place:' || id || ':' || copy) AS place, text FROM copied
"""

FILL_IN_MIDDLE = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), drawn AS (
  SELECT *, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (n + 1) AS a,
         CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (n + 1) AS b,
         CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS moves,
         CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS turns
  FROM texts
), formed AS (
  SELECT doc_id, text, n, least(a, b) AS p, greatest(a, b) - least(a, b) AS m,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR moves >= 90
              THEN 'plain' WHEN turns < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, substr(text, 1, p) AS prefix, substr(text, p + 1, m) AS middle, substr(text, p + m + 1) AS suffix FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN m END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def licence_scan(notices: dict[str, str]) -> str:
    """Every grid window that holds 0.8 of a template's shingles, found without MinHash.

    The rule in words: words stand between white space, punctuation and comment signs and hold a letter or a
    digit; a template of fewer than five words is one shingle of all its words.
    """
    rows = ", ".join(f"""('{name}', '{text.replace("'", "''")}')""" for name, text in sorted(notices.items()))
    gap = r"""(?:[\x20\x09-\x0D".,:;()!?*#%]|//+|--+)+"""

    def words(column: str) -> str:
        low = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return rf"list_filter(string_split_regex({low}, '{gap}'), lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]'))"

    def shingles(width: str) -> str:
        return f"[array_to_string(words[i:i + {width} - 1], ' ') FOR i IN range(1, len(words) - {width} + 2)]"

    return f"""
WITH templates AS (
  SELECT licence, width, {shingles('width')} AS shingles
  FROM (SELECT licence, words, least(len(words), 5) AS width
        FROM (SELECT licence, {words('notice')} AS words FROM (VALUES {rows}) AS n(licence, notice)))
), wanted AS (
  SELECT licence, width, len(shingles) AS span, len(list_distinct(shingles)) AS n,
         unnest(list_distinct(shingles)) AS shingle
  FROM templates
), texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, {words('text')} AS words FROM documents
), lists AS (
  SELECT row_no, doc_id, width, {shingles('width')} AS shingles
  FROM texts, (SELECT DISTINCT width FROM templates) WHERE len(words) >= width
), have AS (
  SELECT row_no, doc_id, width, unnest(shingles) AS shingle, generate_subscripts(shingles, 1) - 1 AS place FROM lists
), hits AS (
  SELECT h.row_no, h.doc_id, h.place, w.licence, w.span, w.n, w.shingle
  FROM have h JOIN wanted w ON h.shingle = w.shingle AND h.width = w.width
), windows AS (
  SELECT row_no, doc_id, licence, n, shingle, span * (place // span - k) AS first
  FROM hits, (SELECT unnest([0, 1]) AS k) WHERE place // span - k >= 0
), shares AS (
  SELECT row_no, doc_id, licence, first, count(DISTINCT shingle) / any_value(n) AS containment
  FROM windows GROUP BY row_no, doc_id, licence, first
)
SELECT any_value(doc_id) AS doc_id, licence, min(first) AS first_word, count(*) AS windows,
       max(containment) AS containment
FROM shares WHERE containment >= 0.8 GROUP BY row_no, licence
"""
