"""DuckDB twins of the ``opN_`` queries that SQL can express on whole tables."""

from __future__ import annotations

from quarry.llm.quality import RULES

ORACLE: dict[str, str] = {}

ORACLE["op6_all_repeats"] = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
placed AS (
  SELECT doc_id, i, line, SUM(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS start,
         trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS norm
  FROM lines
),
units AS (
  SELECT doc_id, start, length(line) AS length, norm, length(norm) - length(replace(norm, ' ', '')) + 1 AS n_words,
         ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS unit,
         MIN(doc_id) OVER (PARTITION BY norm) AS first_doc_id,
         ROW_NUMBER() OVER (PARTITION BY doc_id, norm ORDER BY i) AS nth
  FROM placed WHERE norm <> ''
),
repeats AS (
  SELECT *, unit - ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY unit) AS run
  FROM units WHERE doc_id <> first_doc_id OR nth > 1
)
SELECT doc_id, CAST(unit AS BIGINT) AS unit, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(n_words AS BIGINT) AS n_words, first_doc_id
FROM (SELECT *, SUM(n_words) OVER (PARTITION BY doc_id, run) AS run_words FROM repeats)
"""


# Words with their places, units as nested stretches of them, and diagonals joined word by word.
ORACLE["op6_substring_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, l, line, SUM(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY l) - length(line) - 1 AS line_start
  FROM (SELECT doc_id, generate_subscripts(ls, 1) AS l, unnest(ls) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
),
tokens AS (
  SELECT doc_id, l, line_start, generate_subscripts(ts, 1) AS k, unnest(ts) AS token
  FROM (SELECT *, regexp_extract_all(line, '\s*\S+') AS ts FROM lines)
),
words AS (
  SELECT doc_id, l, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY l, k) - 1 AS i, lower(ltrim(token)) AS w,
         CAST(line_start + SUM(length(token)) OVER (PARTITION BY doc_id, l ORDER BY k) AS BIGINT) AS stop, length(ltrim(token)) AS len
  FROM tokens
),
marked AS (
  SELECT *, CASE WHEN right(w, 1) IN ('.', '!', '?', ',', ';', ':') THEN 1 ELSE 0 END AS mark,
         CASE WHEN LEAD(l) OVER (PARTITION BY doc_id ORDER BY i) IS DISTINCT FROM l THEN 1 ELSE 0 END AS last
  FROM words
),
ways AS (  -- clauses that end pos line breaks, and those that go on
  SELECT *, unnest([0, 1]) AS wraps, unnest([greatest(mark, last), mark]) AS ends FROM marked
),
clauses AS (SELECT *, SUM(ends) OVER (PARTITION BY doc_id, wraps ORDER BY i) - ends AS c FROM ways),
cut AS (
  SELECT *, CASE WHEN ends = 1 OR (len % 8 = 0 AND COUNT(*) OVER (PARTITION BY doc_id, wraps, c) > 24) THEN 1 ELSE 0 END AS stops FROM clauses
),
pieces AS (SELECT *, SUM(stops) OVER (PARTITION BY doc_id, wraps ORDER BY i) - stops AS u FROM cut),
small AS (
  SELECT doc_id, wraps, MIN(l) AS l, MAX(l) AS l2, MIN(i) AS pos, COUNT(*) AS n, string_agg(w, ' ' ORDER BY i) AS norm
  FROM pieces GROUP BY doc_id, wraps, u HAVING COUNT(*) >= 4
),
units AS (
  SELECT doc_id, pos, n, norm FROM small WHERE wraps = 0 OR l < l2
  UNION ALL
  SELECT doc_id, MIN(i), COUNT(*), string_agg(w, ' ' ORDER BY i) FROM words
  WHERE (doc_id, l) NOT IN (SELECT (doc_id, l) FROM small WHERE wraps = 0) GROUP BY doc_id, l HAVING COUNT(*) >= 4
),
ranked AS (
  SELECT *, FIRST_VALUE(doc_id) OVER e AS a_doc, FIRST_VALUE(pos) OVER e AS a_at FROM units WINDOW e AS (PARTITION BY norm ORDER BY doc_id, pos)
),
seeds AS (SELECT *, a_at - pos AS off FROM ranked WHERE doc_id <> a_doc OR pos <> a_at),
diagonals AS (SELECT DISTINCT doc_id, a_doc, off FROM seeds),
met AS (
  SELECT d.*, b.i, b.i - ROW_NUMBER() OVER (PARTITION BY d.doc_id, d.a_doc, d.off ORDER BY b.i) AS stretch
  FROM diagonals d JOIN words b ON b.doc_id = d.doc_id JOIN words a ON a.doc_id = d.a_doc AND a.i = b.i + d.off AND a.w = b.w
),
stretches AS (SELECT doc_id, a_doc, off, MIN(i) AS s, MAX(i) + 1 AS e FROM met GROUP BY doc_id, a_doc, off, stretch HAVING COUNT(*) >= 20),
runs AS (
  SELECT DISTINCT r.doc_id, r.a_doc, r.s, r.e FROM stretches r JOIN seeds x
    ON x.doc_id = r.doc_id AND x.a_doc = r.a_doc AND x.off = r.off AND x.pos >= r.s AND x.pos + x.n <= r.e
),
ordered AS (
  SELECT *, greatest(s, coalesce(MAX(e) OVER (PARTITION BY doc_id ORDER BY s, e DESC, a_doc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lo
  FROM runs
)
SELECT o.doc_id, ROW_NUMBER() OVER (PARTITION BY o.doc_id ORDER BY lo) - 1 AS unit, f.stop - f.len AS start,
       t.stop - f.stop + f.len AS length, CAST(e - lo AS BIGINT) AS n_words, a_doc AS first_doc_id
FROM ordered o JOIN words f ON f.doc_id = o.doc_id AND f.i = lo JOIN words t ON t.doc_id = o.doc_id AND t.i = e - 1
WHERE lo < e
"""


_SHOW = "'<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)"


def _render(turns: str) -> str:
    return f"coalesce(array_to_string(list_transform({turns}, lambda t: {_SHOW}), ''), '')"


def _mask(turns: str) -> str:
    """Spans of the assistant's texts as 'start:length;...'."""
    before = f"coalesce(list_sum(list_transform({turns}[1:i - 1], lambda t: length({_SHOW}))), 0)"
    return (f"coalesce(array_to_string(list_transform(list_filter(range(1, len({turns}) + 1), "
            f"lambda i: {turns}[i].role = 'assistant'), "
            f"lambda i: CAST(CAST({before} + length({turns}[i].role) + 5 AS BIGINT) AS VARCHAR) || ':' "
            f"|| CAST(length({turns}[i].text) + 8 AS VARCHAR)), ';'), '')")


ORACLE["op8_preference"] = f"""
WITH clean AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn, role, text) AS turns,
         coalesce(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS spoken
  FROM clean GROUP BY conv_id
),
ranked AS (
  SELECT conv_id, turns[1] AS opening, COUNT(*) OVER (PARTITION BY turns[1]) AS n,
         FIRST_VALUE(conv_id) OVER (PARTITION BY turns[1] ORDER BY spoken DESC, conv_id) AS chosen_id
  FROM convs
),
pairs AS (
  SELECT chosen_id, CASE WHEN n > 1 THEN conv_id END AS rejected_id FROM ranked WHERE n = 1 OR conv_id <> chosen_id
),
sides AS (
  SELECT p.chosen_id, p.rejected_id, c.turns AS c, r.turns AS r
  FROM pairs p JOIN convs c ON c.conv_id = p.chosen_id LEFT JOIN convs r ON r.conv_id = p.rejected_id
),
cut AS (
  SELECT *, CASE WHEN r IS NULL
    THEN coalesce(list_max(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant')) - 1, len(c))
    ELSE coalesce(list_min(list_filter(range(1, len(c) + 1), lambda i: r[i] IS DISTINCT FROM c[i])) - 1, len(c)) END AS n
  FROM sides
),
parts AS (SELECT chosen_id, rejected_id, n, c[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r, r IS NULL AS alone FROM cut)
SELECT chosen_id, rejected_id,
       CASE WHEN alone THEN 'single' WHEN len(c) = 0 AND len(r) = 0 THEN 'same' ELSE 'pair' END AS kind,
       CAST(n AS INTEGER) AS n_prompt_turns, {_render('p')} AS prompt, {_render('c')} AS chosen,
       CASE WHEN NOT alone THEN {_render('r')} END AS rejected, {_mask('c')} AS chosen_mask,
       CASE WHEN NOT alone THEN {_mask('r')} END AS rejected_mask
FROM parts
"""

_RISK, _DELTA = 0.02, 0.05
_GRID = ", ".join(f"('{r}', {i}, CAST({c} AS DOUBLE))" for r, (_, cuts) in RULES.items() for i, c in enumerate(cuts))
_SIGNALS = {
    "symbols": "n_symbols / n_words", "word_length": "word_chars / n_words", "dup_lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words", "shouting": "n_upper / word_chars", "marks": "n_marks / n_words"}
_LONG = "\n  UNION ALL ".join(
    f"SELECT doc_id, lang, base_failed, '{r}' AS rule, CASE WHEN n_words > 0 THEN {e} END AS signal FROM counts"
    for r, e in _SIGNALS.items())

ORACLE["op10_quality_rules"] = rf"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM docs WHERE len(w) >= 8),
grams AS (SELECT doc_id, i, w[i:i + 7] AS g FROM windows),
twice AS (SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING COUNT(*) > 1),
inside AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM grams JOIN twice USING (doc_id, g)),
repeated AS (SELECT doc_id, COUNT(*) AS n FROM inside GROUP BY doc_id),
counts AS (
  SELECT d.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^!?]', '', 'g')) AS n_marks,
         len(w) < 20 OR 100 * coalesce(r.n, 0) > 30 * len(w) AS base_failed
  FROM docs d LEFT JOIN repeated r ON r.doc_id = d.doc_id
),
signals AS ({_LONG}),
marks AS (SELECT doc_id, MIN(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
held AS (SELECT s.lang, s.rule, s.signal, m.good FROM signals s JOIN marks m USING (doc_id) WHERE NOT base_failed),
grid AS (SELECT * FROM (VALUES {_GRID}) g(rule, place, cutoff)),
tests AS (
  SELECT lang, rule, place, cutoff, COUNT(*) FILTER (WHERE good) AS n, COUNT(*) FILTER (WHERE NOT good) AS b,
         COUNT(*) FILTER (WHERE good AND signal > cutoff) AS k, COUNT(*) FILTER (WHERE NOT good AND signal > cutoff) AS kb
  FROM held JOIN grid USING (rule) GROUP BY lang, rule, place, cutoff
),
levels AS (
  SELECT *, CASE WHEN n = 0 OR k >= n * p THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
           exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p)))) END AS tail,
         (SELECT COUNT(*) FROM (SELECT DISTINCT lang FROM held)) AS strata
  FROM (SELECT *, CAST({_RISK} AS DOUBLE) / {len(RULES)} AS p FROM tests)
),
passed AS (
  SELECT *, BOOL_AND(tail <= CAST({_DELTA} AS DOUBLE) / {len(RULES)} / strata) OVER (PARTITION BY lang, rule ORDER BY place) AS ok FROM levels
),
chosen AS (
  SELECT lang, rule, cutoff, kb, ROW_NUMBER() OVER (PARTITION BY lang, rule
           ORDER BY (CASE WHEN b > 0 THEN kb / b ELSE 0 END) - k / n DESC, place) AS rn
  FROM passed WHERE ok
),
rejected AS (
  SELECT DISTINCT s.doc_id FROM signals s JOIN chosen c
    ON c.lang IS NOT DISTINCT FROM s.lang AND c.rule = s.rule AND c.rn = 1 AND c.kb > 0 AND s.signal > c.cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept, lang AS stratum
FROM counts
"""

_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_FLAGS = r"""
  CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'sound' END"""

# The cheapest edits row by row: per conversation and state the least (cost, audit), with the
# lines kept so far; edits of one row are tried with 0 to 3 inserted turns before it.
ORACLE["op12_conversation_repair"] = f"""
WITH RECURSIVE
tab AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: {_CRC_STEP})) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
),
drawn AS (
  SELECT keyed.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS draw
  FROM keyed, tab
),
hurt AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN draw = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM drawn WHERE draw <> 0
),
placed AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
         ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM hurt
),
faulty AS (
  SELECT *, {_FLAGS} AS fault, left(role, 1) AS c,
         LAG(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p
  FROM placed
),
counts AS (
  SELECT conv_id, coalesce(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) AS n,
         COUNT(*) FILTER (WHERE fault = 'blank') AS blank, COUNT(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         COUNT(*) FILTER (WHERE fault = 'truncated') AS truncated,
         COUNT(*) FILTER (WHERE i > 1 AND p || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
),
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM counts
  UNION ALL
  SELECT conv_id, i, s, cost, audit, lines FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id, s ORDER BY cost, audit) AS best FROM (
      WITH padded AS (
        SELECT conv_id, i, s, cost, audit, lines FROM ways
        UNION ALL
        SELECT conv_id, i, CASE WHEN s = 2 THEN 3 ELSE 2 END, cost + 2, audit || 'I',
               list_append(lines, CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END) FROM ways
        UNION ALL
        SELECT conv_id, i, CASE WHEN s = 2 THEN 2 ELSE 3 END, cost + 4, audit || 'II',
               list_concat(lines, CASE WHEN s = 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END) FROM ways
      ),
      todo AS (
        SELECT w.conv_id, w.i + 1 AS i, w.s, w.cost, w.audit, w.lines, r.role, r.text, r.c,
               r.fault IN ('blank', 'duplicate') AS dead, CASE WHEN r.fault = 'truncated' THEN 1 ELSE 0 END AS extra
        FROM padded w JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
      )
      SELECT conv_id, i, s, cost + 3 AS cost, audit || 'D' AS audit, lines FROM todo
      UNION ALL
      SELECT conv_id, i, CASE c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, cost + extra, audit || 'K', list_append(lines, role || ':' || text)
      FROM todo WHERE NOT dead AND ((c = 's' AND s = 0) OR (c = 'u' AND s <> 2) OR (c = 'a' AND s = 2))
      UNION ALL
      SELECT conv_id, i, CASE WHEN s = 2 THEN 3 ELSE 2 END, cost + 2 + extra, audit || 'R',
             list_append(lines, CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END || text) FROM todo WHERE NOT dead
    )
  ) WHERE best = 1
),
ended AS (
  SELECT w.conv_id, w.cost + CASE s WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END AS cost,
         audit || CASE s WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
         list_concat(lines, CASE s WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END) AS lines
  FROM ways w JOIN counts n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = n.n
),
chosen AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS best FROM ended)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN chosen b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.best = 1
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"

ORACLE["op11_lexical_search"] = f"""
WITH docs AS (SELECT ROW_NUMBER() OVER () AS d, doc_id, {_WORDS} AS w FROM documents),
lengths AS (SELECT d, doc_id, len(w) AS n FROM docs WHERE len(w) > 0),
corpus AS (SELECT COUNT(*) AS big_n, SUM(n) AS big_l FROM lengths),
asked AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
tfs AS (
  SELECT d, term, COUNT(*) AS tf FROM (SELECT d, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY d, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * MAX(big_n) + 2 AS DOUBLE) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
  FROM tfs, corpus GROUP BY term
),
scored AS (
  SELECT item_id, l.d, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term)
  JOIN (SELECT d, doc_id, 100 - 50 + CAST((50 * n * big_n) // big_l AS BIGINT) AS m FROM lengths, corpus) l ON l.d = tfs.d
  GROUP BY item_id, l.d, doc_id
),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
