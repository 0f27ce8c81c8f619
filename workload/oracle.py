"""DuckDB SQL for the registered queries.

Base views are repeated as common table expressions, written independently of
the DataFrame code; only the fixed word lists are shared.
"""

from __future__ import annotations

from qlens.functions import fixed_values as fv
from workload.views import PHRASES, RESPONSE_SHAPES


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- base views --------------------------------------------------------------

EV = f"""ev AS (
  SELECT *, CASE WHEN event_type = 'signup' AND k = 3 THEN NULL
    ELSE CASE event_type {' '.join(f"WHEN {lit(t)} THEN {lit(p)}" for t, p in PHRASES.items())} END
         || ' ' || CAST(k AS VARCHAR) END AS question
  FROM (SELECT *, CAST(regexp_replace(props, '[^0-9]', '', 'g') AS INT) AS k FROM events))"""
CHATS = "chattings AS (SELECT event_id AS chatting_pk, question AS input_text, ts AS created_at FROM ev)"
CATS = "admin_categories AS (SELECT * FROM (VALUES {}) t(category_id, category_name))".format(
    ", ".join(f"({i}, {lit(n)})" for i, n in enumerate(fv.CATEGORY_NAMES, start=1))
)
KW = """admin_chat_keywords AS (
  SELECT query_text, keyword, category_id, COUNT(*) AS query_count, created_at,
         CASE WHEN created_at < TIMESTAMP '2024-01-15 00:00:00' THEN TIMESTAMP '2024-02-01 01:00:00'
              ELSE TIMESTAMP '2024-02-02 01:00:00' END AS batch_created_at
  FROM (
    SELECT question AS query_text,
      CASE WHEN value < 40.0 THEN split_part(question, ' ', 1)
           ELSE split_part(question, ' ', 1) || ' ' || split_part(question, ' ', 2) END AS keyword,
      CAST(CASE WHEN k = 98 THEN NULL WHEN k = 97 THEN 12
           WHEN k = 96 THEN CASE WHEN user_id < 50 THEN 11 END
           WHEN k BETWEEN 70 AND 79 OR value < 15.0 THEN 11
           ELSE 1 + user_id % 10 END AS INT) AS category_id,
      CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_at
    FROM ev
    WHERE (value >= 2.0 AND k >= 5 AND NOT (event_type = 'error' AND ts >= TIMESTAMP '2024-01-20 00:00:00'))
       OR question IS NULL)
  GROUP BY query_text, keyword, category_id, created_at)"""
TEXTS = """texts AS (
  SELECT 'c' || conv_id || '-' || turn AS id, text FROM conversations
  UNION ALL SELECT 'd' || doc_id, text FROM documents
  UNION ALL SELECT 'e' || event_id, question FROM ev)"""

MONTH = "created_at BETWEEN '2024-01-01 00:00:00' AND '2024-01-31 23:59:59'"
WEEK = "created_at BETWEEN '2024-01-05 00:00:00' AND '2024-01-11 23:59:59'"
NOTHING = "created_at BETWEEN '2025-06-11 00:00:00' AND '2025-06-19 23:59:59'"
FACT_ORDER = "created_at NULLS FIRST, category_id NULLS FIRST, keyword NULLS FIRST, query_count NULLS FIRST"


def with_(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


CK = with_(EV, CHATS, KW)


# --- classification summary --------------------------------------------------


def summary_ctes(period: str = MONTH) -> str:
    """``picked``: per question its earliest row and its category; ``summary`` adds the category's name."""
    return f"""picked AS (
  SELECT query_text,
         first(struct_pack(created_at, keyword, query_count) ORDER BY {FACT_ORDER}) AS earliest,
         first(category_id ORDER BY created_at, category_id) FILTER (WHERE category_id <> 11) AS real_category,
         bool_and(category_id IS NOT DISTINCT FROM 11) AS only_default
  FROM admin_chat_keywords WHERE {period} AND query_text IS NOT NULL GROUP BY query_text),
summary AS (
  SELECT category_name, query_text, earliest.keyword, earliest.created_at, earliest.query_count
  FROM picked LEFT JOIN admin_categories
    ON category_id = if(only_default, 11, real_category))"""


# The row of NULL questions, which the summary leaves out.
NULL_QUESTION = f""" UNION ALL SELECT NULL, {{}} FROM (
  SELECT first(struct_pack(created_at, keyword, query_count) ORDER BY {FACT_ORDER}) AS f
  FROM admin_chat_keywords WHERE {MONTH} AND query_text IS NULL HAVING COUNT(*) > 0)"""


# --- gaps --------------------------------------------------------------------

# Which facts count as proof that a question (on a day) is done.
CLASSIFIED = {
    "first_day": "SELECT query_text, CAST(earliest.created_at AS DATE) AS dt FROM picked",
    "per_day": f"SELECT DISTINCT query_text, CAST(created_at AS DATE) AS dt FROM admin_chat_keywords WHERE {MONTH}",
    "ever": f"SELECT DISTINCT query_text FROM admin_chat_keywords WHERE {MONTH}",
    "since": "SELECT DISTINCT query_text, CAST(created_at AS DATE) AS dt FROM admin_chat_keywords "
    f"WHERE CAST(batch_created_at AS DATE) >= DATE '2024-02-02' AND {MONTH}",
    "union": "SELECT query_text, CAST(created_at AS DATE) AS dt FROM summary UNION "
    "SELECT query_text, CAST(created_at AS DATE) FROM admin_chat_keywords WHERE batch_created_at >= '2024-02-02'",
}


def gap_ctes(mode: str) -> str:
    """``gaps``: the messages of the period for which no proof exists."""
    needs = summary_ctes() + ",\n" if mode in ("first_day", "union") else ""
    same_day = "" if mode == "ever" else "AND proof.dt = CAST(asked.created_at AS DATE)"
    return f"""{needs}proof AS ({CLASSIFIED[mode]}),
gaps AS (
  SELECT CAST(created_at AS DATE) AS missing_date, input_text, created_at FROM chattings asked
  WHERE asked.{MONTH} AND NOT EXISTS (FROM proof WHERE proof.query_text = asked.input_text {same_day}))"""


WORK = "SELECT missing_date, input_text, COUNT(*) AS missing_count FROM gaps GROUP BY missing_date, input_text"


def gap_sql(mode: str, select: str) -> str:
    return with_(EV, CHATS, KW, CATS, gap_ctes(mode)) + select


COVERAGE = f"""{summary_ctes()},
spine AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS date),
totals AS (
  SELECT CAST(created_at AS DATE) AS date, COUNT(DISTINCT input_text) AS unique_questions, COUNT(*) AS total_messages
  FROM chattings WHERE {MONTH} GROUP BY 1),
processed AS (SELECT CAST(created_at AS DATE) AS date, COUNT(DISTINCT query_text) AS processed_questions FROM summary GROUP BY 1),
pairs AS (SELECT DISTINCT input_text, CAST(created_at AS DATE) AS date FROM chattings WHERE {MONTH}),
missing AS (
  SELECT date, COUNT(*) AS missing_questions
  FROM pairs LEFT JOIN (SELECT DISTINCT query_text FROM summary) s ON pairs.input_text = s.query_text
  WHERE s.query_text IS NULL GROUP BY date),
coverage AS (
  SELECT date, COALESCE(unique_questions, 0) AS unique_questions, COALESCE(total_messages, 0) AS total_messages,
         COALESCE(processed_questions, 0) AS processed_questions, COALESCE(missing_questions, 0) AS missing_questions
  FROM spine LEFT JOIN totals USING (date) LEFT JOIN processed USING (date) LEFT JOIN missing USING (date))"""


# --- report ------------------------------------------------------------------


def report_ctes(period: str = MONTH, name: str = "report") -> str:
    """Most frequent real category of a pair, then the first row carrying it."""
    return f"""{name}_src AS (
  SELECT CAST(k.created_at AS DATE) AS date, k.*, t.category_name
  FROM admin_chat_keywords k LEFT JOIN admin_categories t ON t.category_id = k.category_id
  WHERE k.{period} AND k.query_text IS NOT NULL),
{name}_votes AS (
  SELECT date, query_text, category_name,
         ROW_NUMBER() OVER (PARTITION BY date, query_text ORDER BY COUNT(*) DESC, category_name) AS rn
  FROM {name}_src WHERE category_name IS NOT NULL AND category_name <> '기타' GROUP BY date, query_text, category_name),
{name}_unknown AS (SELECT DISTINCT date, query_text FROM {name}_src WHERE category_name IS NULL),
{name}_choice AS (
  SELECT p.date, p.query_text,
         CASE WHEN v.category_name IS NOT NULL THEN v.category_name
              WHEN u.query_text IS NOT NULL THEN NULL ELSE '기타' END AS category_name
  FROM (SELECT DISTINCT date, query_text FROM {name}_src) p
  LEFT JOIN {name}_votes v ON p.date = v.date AND p.query_text = v.query_text AND v.rn = 1
  LEFT JOIN {name}_unknown u ON p.date = u.date AND p.query_text = u.query_text),
{name} AS (
  SELECT date, query_text, category_name, query_count, keyword, created_at FROM (
    SELECT s.date, s.query_text, s.category_name, s.query_count, s.keyword, s.created_at,
           ROW_NUMBER() OVER (PARTITION BY s.date, s.query_text ORDER BY s.created_at, s.category_id NULLS FIRST,
                              s.keyword, s.query_count) AS rn
    FROM {name}_src s JOIN {name}_choice c
      ON s.date = c.date AND s.query_text = c.query_text AND s.category_name IS NOT DISTINCT FROM c.category_name)
  WHERE rn = 1)"""


REPORT = with_(EV, KW, CATS, report_ctes())
OVERVIEW = """SELECT '2024-01-01 ~ 2024-01-31' AS period, COUNT(*) AS total_records,
  COUNT(DISTINCT query_text) AS unique_questions, COUNT(DISTINCT keyword) AS unique_keywords,
  CAST(COALESCE(SUM(query_count), 0) AS BIGINT) AS total_query_count FROM report"""


# --- text functions ----------------------------------------------------------

BLANK_CLASS = r"\t\n\v\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{BLANK_CLASS}]+|[{BLANK_CLASS}]+$', '', 'g')"


def listed(words) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


def first_rule_category(t: str) -> str:
    """First rule, in order, whose word occurs in the lower-cased text."""
    words, cats = listed(fv.CATEGORY_RULES), listed(fv.CATEGORY_RULES.values())
    hit = f"list_position(list_transform({words}, lambda w: contains(lower({t}), w)), true)"
    return f"CASE WHEN {t} IS NULL THEN NULL ELSE COALESCE({cats}[{hit}], '기타') END"


def first_word(t: str, stop) -> str:
    words = f"list_filter(regexp_split_to_array({t}, '[{BLANK_CLASS}]+'), lambda w: length(w) >= 2 AND NOT list_contains({listed(stop)}, w))"
    return f"COALESCE({words}[1][1:20], {strip(f'{t}[1:10]')})"


def telling_word(t: str) -> str:
    return first_word(t, fv.KEYWORD_STOP_WORDS)


def longest_rule_word(t: str) -> str:
    """Longest contained rule word; the earliest rule among equals."""
    found = f"list_filter({listed(fv.CATEGORY_RULES)}, lambda w: contains({t}, w))"
    return f"list_filter({found}, lambda w: length(w) = list_max(list_transform({found}, lambda u: length(u))))[1]"


def rule_keyword(t: str) -> str:
    return f"CASE WHEN {t} IS NOT NULL THEN COALESCE({longest_rule_word(t)}, {telling_word(t)}) END"


def simple_keyword(t: str) -> str:
    topic = f"list_filter({listed(fv.TOPIC_WORDS)}, lambda w: contains(lower({t}), w))[1]"
    return f"CASE WHEN {t} IS NOT NULL THEN COALESCE({topic}, {first_word(t, fv.SIMPLE_STOP_WORDS)}) END"


def clean_keyword(k: str, t: str, word: str) -> str:
    cut = f"CASE WHEN {word} = '' THEN '기타' ELSE {word}[1:50] END"
    bare = f"trim({strip(k)}, {lit(fv.KEYWORD_PUNCTUATION)})"
    return f"""CASE WHEN length({k}) > 100 THEN {cut}
      WHEN length({k}) > 50 AND {strip(k)} = {strip(t)} THEN {cut}
      WHEN length({k}) < 2 THEN '기타'
      WHEN regexp_full_match({k}, '[\\p{{Nd}}{fv.OTHER_DIGITS}]+') THEN '기타'
      WHEN length({bare}) < 2 THEN '기타' ELSE {bare} END"""


def cap_keyword(k: str, t: str) -> str:
    return f"CASE WHEN length({k}) > 100 THEN CASE WHEN length({t}) > 95 THEN {t}[1:95] || '...' ELSE {t} END ELSE {k} END"


def backfill_keyword(k: str, t: str) -> str:
    simple = simple_keyword(t)
    return f"CASE WHEN {strip(k)} IN ('', '기타') THEN CASE WHEN {simple} = '' THEN '기타' ELSE {simple} END ELSE {k} END"


CANDIDATES = f"""candidates AS (
  SELECT id, text, kind, CASE kind WHEN 0 THEN text WHEN 1 THEN ' (' || {strip('text')} || ')! '
    WHEN 2 THEN CAST(length(text) AS VARCHAR) WHEN 3 THEN '기타' WHEN 4 THEN '  ' WHEN 5 THEN '.'
    WHEN 6 THEN text || text || text || text ELSE repeat('a', 150) END AS keyword
  FROM texts, (SELECT CAST(unnest(range(0, 8)) AS INT) AS kind))"""
TX = with_(EV, TEXTS)
CAND = with_(EV, TEXTS, CANDIDATES)

# Chat texts repeat; the word rules run once per distinct question.
RULED = f"""asked AS (
  SELECT CAST(created_at AS DATE) AS created_at, input_text, COUNT(*) AS total_count
  FROM chattings WHERE {MONTH} GROUP BY 1, 2),
ruled AS (
  SELECT input_text, {rule_keyword('input_text')} AS keyword, {first_rule_category('input_text')} AS category_name
  FROM (SELECT DISTINCT input_text FROM chattings))"""
FACTS = f"""facts AS (
  SELECT a.input_text AS query_text,
         {backfill_keyword(cap_keyword('r.keyword', 'a.input_text'), 'a.input_text')} AS keyword,
         c.category_id, a.total_count AS query_count, CAST(a.created_at AS TIMESTAMP) AS created_at,
         TIMESTAMP '2024-02-03 01:00:00' AS batch_created_at, r.category_name
  FROM asked a JOIN ruled r ON a.input_text = r.input_text JOIN admin_categories c ON c.category_name = r.category_name)"""

# --- classifier answers ------------------------------------------------------

FALSY = "'(null|false|\\[\\]|\\{\\}|-?0+(\\.0+)?([eE][-+]?[0-9]+)?)'"
PARSED = f"""responses AS (
  SELECT event_id AS chatting_pk, question AS input_text, CAST(ts AS DATE) AS created_at,
         replace({listed(RESPONSE_SHAPES)}[user_id % {len(RESPONSE_SHAPES)} + 1], '<q>', COALESCE(question, '')) AS response
  FROM ev),
args AS (
  SELECT *, CASE WHEN json_valid(response) THEN json_extract(response, '$.result.message.toolCalls[0].function.arguments') END AS a
  FROM responses),
args2 AS (
  SELECT * EXCLUDE (a), CASE WHEN json_type(a) = 'VARCHAR'
      THEN CASE WHEN json_valid(json_extract_string(a, '$')) THEN CAST(json_extract_string(a, '$') AS JSON) END
      ELSE a END AS a
  FROM args),
items AS (
  SELECT chatting_pk, input_text, generate_subscripts(l, 1) AS pos, unnest(l) AS item
  FROM (SELECT *, CASE WHEN json_type(a, '$.keywords_with_categories') = 'ARRAY'
                       THEN json_extract(a, '$.keywords_with_categories[*]') ELSE [] END AS l FROM args2)),
typed AS (
  SELECT *, json_type(item, '$.keyword') AS kt, COALESCE({strip("json_extract_string(item, '$.keyword')")}, '') AS kw,
         json_type(item, '$.categories') AS ct,
         CASE WHEN json_type(item, '$.categories') = 'ARRAY' THEN json_extract(item, '$.categories[*]') ELSE [] END AS cl
  FROM items WHERE json_type(item) = 'OBJECT'),
judged AS (
  SELECT *, COALESCE(kt <> 'VARCHAR', false) OR (kw <> '' AND
      len(list_filter(cl, lambda c: json_type(c) <> 'VARCHAR' AND NOT regexp_full_match(CAST(c AS VARCHAR), {FALSY}))) > 0) AS broken,
    CASE WHEN ct = 'VARCHAR' THEN [json_extract_string(item, '$.categories')]
         ELSE list_transform(list_filter(cl, lambda c: json_type(c) = 'VARCHAR'), lambda c: json_extract_string(c, '$')) END AS raw_names
  FROM typed),
usable AS (
  SELECT chatting_pk, input_text, pos,
    {clean_keyword('kw', 'input_text', 'word')} AS keyword,
    list_filter(list_transform(raw_names, lambda n: {strip('n')}), lambda n: n <> '') AS names
  FROM (SELECT *, {telling_word('input_text')} AS word FROM judged WHERE kw <> '')
  WHERE input_text IS NOT NULL AND chatting_pk NOT IN (SELECT chatting_pk FROM judged WHERE broken)),
good AS (
  SELECT chatting_pk, CAST(ROW_NUMBER() OVER (PARTITION BY chatting_pk ORDER BY pos) - 1 AS INT) AS item_pos, keyword,
         CASE WHEN len(names) = 0 THEN ['기타'] ELSE names END AS names
  FROM usable),
ruled AS (
  SELECT input_text, {rule_keyword('input_text')} AS keyword, {first_rule_category('input_text')} AS category_name
  FROM (SELECT DISTINCT input_text FROM responses)),
parsed AS (
  SELECT chatting_pk, item_pos, keyword, CAST(generate_subscripts(names, 1) - 1 AS INT) AS category_pos, unnest(names) AS category_name
  FROM good
  UNION ALL
  SELECT r.chatting_pk, 0, f.keyword, 0, f.category_name
  FROM responses r JOIN ruled f ON r.input_text = f.input_text
  WHERE r.chatting_pk NOT IN (SELECT chatting_pk FROM good)),
exploded AS (
  SELECT p.chatting_pk, r.input_text, r.created_at, CAST(1 AS BIGINT) AS total_count,
         {backfill_keyword(cap_keyword('p.keyword', 'r.input_text'), 'r.input_text')} AS keyword, p.category_name
  FROM parsed p JOIN responses r ON p.chatting_pk = r.chatting_pk WHERE {strip('p.keyword')} <> '')"""
RESP = with_(EV, CATS, PARSED)
RESOLVED = """resolved AS (
  SELECT e.*, c.category_id FROM exploded e
  JOIN (SELECT category_name AS n, MAX(category_id) AS category_id FROM admin_categories WHERE category_id <> 0 GROUP BY 1) c
    ON trim(e.category_name) = c.n)"""

LOGS = """logs AS (
  SELECT CASE WHEN k = 99 THEN '  File ' || k ELSE
    strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN k BETWEEN 20 AND 25 THEN ' - classifier - ' ELSE ' - nightly_run - ' END
    || CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END || ' - '
    || CASE WHEN k < 20 THEN 'API 호출 성공' WHEN k < 30 THEN 'API 호출 실패: timeout'
            WHEN event_type = 'error' AND k < 60 THEN '❌ 청크 ' || k || ' 처리 실패'
            WHEN k < 60 THEN '🎉 배치 ' || k || ' 처리 완료 - 끝'
            ELSE '처리 중 - ' || COALESCE(question, '') END END AS value
  FROM ev),
parsed_logs AS (
  SELECT CASE WHEN p[1] <> '' THEN CAST(p[1] AS TIMESTAMP) END AS logged_at, CASE WHEN p[1] <> '' THEN p[2] END AS logger,
         CASE WHEN p[1] <> '' THEN p[3] END AS level, CASE WHEN p[1] <> '' THEN p[4] ELSE value END AS message
  FROM (SELECT value, [regexp_extract(value, re, 1), regexp_extract(value, re, 2), regexp_extract(value, re, 3),
                       regexp_extract(value, re, 4)] AS p
        FROM logs, (SELECT '^([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}) - (.*?) - ([A-Z]+) - ((?s:.*))$' AS re)))"""

LEDGER = f"""good AS (SELECT * FROM admin_chat_keywords WHERE query_text IS NOT NULL AND keyword IS NOT NULL
  AND length(keyword) <= 100 AND category_id IS NOT NULL AND query_count IS NOT NULL AND created_at IS NOT NULL),
bad AS (SELECT * FROM admin_chat_keywords WHERE query_text IS NULL OR keyword IS NULL OR length(keyword) > 100 OR category_id IS NULL),
asked AS (SELECT DISTINCT input_text, CAST(created_at AS DATE) AS d FROM chattings WHERE {MONTH}),
ledger AS (
  SELECT date, total_rows, processed, skipped, rejected,
         CASE WHEN rejected > 0 AND processed = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CASE WHEN rejected > 0 AND processed = 0 THEN 'no row could be stored' END AS error
  FROM (
    SELECT s.date, (SELECT COUNT(*) FROM asked a WHERE a.d = s.date) AS total_rows,
      (SELECT COUNT(*) FROM asked a JOIN good g ON a.input_text = g.query_text AND a.d = CAST(g.created_at AS DATE) WHERE a.d = s.date) AS processed,
      (SELECT COUNT(*) FROM asked a LEFT JOIN (SELECT DISTINCT query_text, CAST(created_at AS DATE) AS d FROM good) g
         ON a.input_text = g.query_text AND a.d = g.d WHERE a.d = s.date AND g.query_text IS NULL) AS skipped,
      (SELECT COUNT(*) FROM bad b WHERE CAST(b.created_at AS DATE) = s.date) AS rejected
    FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS date) s))"""

COMPLETE = f"""basic AS (SELECT * EXCLUDE (category_name) FROM facts),
after_basic AS (SELECT * FROM admin_chat_keywords UNION ALL SELECT * FROM basic),
missing_ever AS (
  SELECT COUNT(*) AS n FROM asked a LEFT JOIN (SELECT DISTINCT query_text FROM after_basic WHERE {MONTH}) t
    ON a.input_text = t.query_text WHERE t.query_text IS NULL),
first_days AS (SELECT query_text, CAST(MIN(created_at) AS DATE) AS dt FROM after_basic WHERE {MONTH} GROUP BY query_text),
work AS (
  SELECT a.* FROM asked a LEFT JOIN first_days f ON a.input_text = f.query_text AND a.created_at = f.dt
  WHERE f.query_text IS NULL AND (SELECT n FROM missing_ever) > 0),
repaired AS (
  SELECT f.* EXCLUDE (category_name) FROM facts f JOIN work w
    ON f.query_text = w.input_text AND CAST(f.created_at AS DATE) = w.created_at),
after_repair AS (SELECT * FROM after_basic UNION ALL SELECT * FROM repaired),
remaining AS (
  SELECT COUNT(a.input_text) AS n FROM asked a
  LEFT JOIN (SELECT DISTINCT query_text, CAST(created_at AS DATE) AS dt FROM after_repair WHERE {MONTH}) t
    ON a.input_text = t.query_text AND a.created_at = t.dt WHERE t.query_text IS NULL),
c AS (
  SELECT (SELECT COUNT(*) FROM asked) AS basic_questions, (SELECT COUNT(*) FROM basic) AS basic_rows,
    (SELECT COUNT(*) FROM asked a LEFT JOIN (SELECT DISTINCT query_text, CAST(created_at AS DATE) AS dt FROM basic) t
       ON a.input_text = t.query_text AND a.created_at = t.dt WHERE t.query_text IS NULL) AS basic_skipped,
    (SELECT n FROM missing_ever) AS missing_found,
    (SELECT COUNT(*) FROM work) AS missing_questions, (SELECT COUNT(*) FROM repaired) AS missing_rows,
    (SELECT COUNT(*) FROM work a LEFT JOIN (SELECT DISTINCT query_text, CAST(created_at AS DATE) AS dt FROM repaired) t
       ON a.input_text = t.query_text AND a.created_at = t.dt WHERE t.query_text IS NULL) AS missing_skipped,
    (SELECT n FROM remaining) AS remaining_missing)"""


def per_day(table: str, extra: str = "") -> str:
    return (
        f"SELECT CAST(created_at AS DATE) AS date, COUNT(DISTINCT query_text) AS unique_queries, "
        f"COUNT(*) AS total_records FROM {table} WHERE {MONTH} {extra} GROUP BY 1 ORDER BY 1"
    )


ORACLE: dict[str, str] = {
    "scan_chats": with_(EV, CHATS) + "SELECT * FROM chattings",
    "scan_keywords": with_(EV, KW) + "SELECT * FROM admin_chat_keywords",
    "period_filter": with_(EV, CHATS) + f"SELECT * FROM chattings WHERE {WEEK}",
    "period_shortcuts": with_(EV, CHATS)
    + """, days AS (SELECT DISTINCT CAST(created_at AS DATE) AS r FROM chattings)
SELECT r AS ref_date, 'today' AS shortcut, r AS start_date, r AS end_date FROM days
UNION ALL SELECT r, 'yesterday', r - 1, r - 1 FROM days
UNION ALL SELECT r, 'this-week', r - CAST(isodow(r) - 1 AS INT), r - CAST(isodow(r) - 1 AS INT) + 6 FROM days
UNION ALL SELECT r, 'last-week', r - CAST(isodow(r) - 1 AS INT) - 7, r - CAST(isodow(r) - 1 AS INT) - 1 FROM days
UNION ALL SELECT r, 'this-month', make_date(year(r), month(r), 1), last_day(r) FROM days
UNION ALL SELECT r, 'last-month', CAST(make_date(year(r), month(r), 1) - INTERVAL 1 MONTH AS DATE),
  make_date(year(r), month(r), 1) - 1 FROM days""",
    "day_spine": with_(EV, CHATS)
    + """SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT MIN(CAST(created_at AS DATE)) AS lo, MAX(CAST(created_at AS DATE)) AS hi FROM chattings)""",
    "loaded_on": with_(EV, KW)
    + "SELECT * FROM admin_chat_keywords WHERE CAST(batch_created_at AS DATE) = DATE '2024-02-02'",
    "classified_rows": with_(EV, KW, CATS)
    + f"""SELECT t.category_name, c.query_text, c.keyword, c.created_at, c.query_count
FROM admin_chat_keywords c LEFT JOIN admin_categories t ON t.category_id = c.category_id WHERE c.{MONTH}""",
    "log_lines": with_(EV, LOGS) + "SELECT * FROM parsed_logs",
    "log_counts": with_(EV, LOGS)
    + """SELECT CAST(logged_at AS DATE) AS date, level, COUNT(*) AS lines,
  COUNT(*) FILTER (regexp_matches(message, '🎉.*완료')) AS finished,
  COUNT(*) FILTER (regexp_matches(message, '❌.*실패')) AS failed,
  COUNT(*) FILTER (contains(message, 'API 호출 성공')) AS api_success,
  COUNT(*) FILTER (contains(message, 'API 호출 실패')) AS api_failure
FROM parsed_logs GROUP BY 1, 2""",
    "unique_questions": with_(EV, CHATS)
    + f""", counted AS (
  SELECT input_text, created_at, ROW_NUMBER() OVER (PARTITION BY input_text ORDER BY created_at DESC) AS rn,
         COUNT(*) OVER (PARTITION BY input_text) AS total_count
  FROM chattings WHERE {MONTH})
SELECT input_text, total_count, CAST(created_at AS DATE) AS created_at FROM counted WHERE rn = 1
ORDER BY total_count DESC, created_at, input_text""",
    "unique_questions_per_day": with_(EV, CHATS)
    + f""", counted AS (
  SELECT input_text, CAST(created_at AS DATE) AS d,
         ROW_NUMBER() OVER (PARTITION BY CAST(created_at AS DATE), input_text ORDER BY created_at DESC) AS rn,
         COUNT(*) OVER (PARTITION BY CAST(created_at AS DATE), input_text) AS total_count
  FROM chattings WHERE {MONTH})
SELECT input_text, total_count, d AS created_at FROM counted WHERE rn = 1""",
    "repeat_count_window": with_(EV, CHATS)
    + "SELECT *, COUNT(*) OVER (PARTITION BY input_text) AS total_count FROM chattings",
    "latest_per_question": with_(EV, CHATS)
    + """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY input_text
  ORDER BY created_at DESC, chatting_pk DESC) AS rn FROM chattings) WHERE rn = 1""",
    "distinct_questions": with_(EV, CHATS)
    + f"SELECT DISTINCT input_text, CAST(created_at AS DATE) AS date FROM chattings WHERE {MONTH} ORDER BY date, input_text",
    "existing_keys": with_(EV, KW)
    + f"""SELECT DISTINCT query_text || '|' || CAST(CAST(created_at AS DATE) AS VARCHAR) AS unique_key
FROM admin_chat_keywords WHERE {MONTH}""",
    "skip_existing": CK
    + f""", asked AS (SELECT input_text, COUNT(*) AS total_count, CAST(created_at AS DATE) AS created_at
  FROM chattings WHERE {MONTH} GROUP BY input_text, CAST(created_at AS DATE))
SELECT * FROM asked WHERE COALESCE(input_text || '|' || CAST(created_at AS VARCHAR), '') NOT IN (
  SELECT query_text || '|' || CAST(CAST(created_at AS DATE) AS VARCHAR) FROM admin_chat_keywords
  WHERE {MONTH} AND query_text IS NOT NULL)""",
    "resume_offset": with_(EV, CHATS)
    + f"""SELECT input_text, COUNT(*) AS total_count, CAST(MAX(created_at) AS DATE) AS created_at
FROM chattings WHERE {MONTH} GROUP BY input_text
ORDER BY total_count DESC, created_at, input_text NULLS FIRST OFFSET 100""",
    "first_occurrence": with_(EV, KW, CATS, summary_ctes())
    + "SELECT query_text, earliest.created_at, earliest.query_count FROM picked"
    + NULL_QUESTION.format("f.created_at, f.query_count"),
    "earliest_keyword": with_(EV, KW, CATS, summary_ctes())
    + "SELECT query_text, earliest.keyword FROM picked"
    + NULL_QUESTION.format("f.keyword"),
    "earliest_category": with_(EV, KW, CATS, summary_ctes())
    + f"""SELECT query_text, first(category_id ORDER BY created_at, category_id) AS category_id
FROM admin_chat_keywords WHERE {MONTH} AND category_id <> 11 GROUP BY query_text""",
    "all_default_flag": with_(EV, KW)
    + f"""SELECT query_text, SUM(CASE WHEN category_id = 11 THEN 1 ELSE 0 END) = COUNT(*) AS all_default
FROM admin_chat_keywords WHERE {MONTH} GROUP BY query_text""",
    "classify_summary": with_(EV, KW, CATS, summary_ctes()) + "SELECT * FROM summary",
    "classify_summary_week": with_(EV, KW, CATS, summary_ctes(WEEK)) + "SELECT * FROM summary",
    "category_lookup": with_(EV, KW, CATS)
    + "SELECT k.*, c.category_name FROM admin_chat_keywords k LEFT JOIN admin_categories c ON k.category_id = c.category_id",
    "missing_first_day": gap_sql("first_day", "SELECT DISTINCT input_text, missing_date FROM gaps"),
    "missing_per_day": gap_sql("per_day", "SELECT DISTINCT input_text, missing_date FROM gaps"),
    "missing_ever": gap_sql("ever", "SELECT DISTINCT input_text, missing_date FROM gaps"),
    "missing_loaded_since": gap_sql("since", "SELECT DISTINCT input_text, missing_date FROM gaps"),
    "missing_work": gap_sql("first_day", WORK + " ORDER BY missing_date"),
    "missing_work_limit": gap_sql("per_day", WORK + " ORDER BY missing_date, input_text NULLS FIRST LIMIT 106"),
    "missing_detail": gap_sql(
        "first_day",
        "SELECT missing_date, input_text, COUNT(*) AS missing_count, MIN(created_at) AS first_seen FROM gaps GROUP BY 1, 2 "
        "ORDER BY missing_date, missing_count DESC",
    ),
    "missing_status": gap_sql(
        "first_day",
        f"SELECT missing_date, CAST(SUM(missing_count) AS BIGINT) AS missing_total FROM ({WORK}) GROUP BY 1 ORDER BY 1",
    ),
    "missing_pairs_per_day": gap_sql(
        "per_day", f"SELECT missing_date, COUNT(*) AS total_missing_count FROM ({WORK}) GROUP BY 1 ORDER BY 1"
    ),
    "verify_remaining": gap_sql(
        "per_day",
        "SELECT missing_date, COUNT(DISTINCT input_text) AS remaining_missing_count FROM gaps GROUP BY 1 ORDER BY 1",
    ),
    "verify_verdict": gap_sql(
        "per_day",
        "SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS remaining_missing_count, COALESCE(SUM(n), 0) = 0 AS verification_success "
        "FROM (SELECT missing_date, COUNT(DISTINCT input_text) AS n FROM gaps GROUP BY 1)",
    ),
    "final_missing": gap_sql("since", "SELECT COUNT(DISTINCT input_text) AS final_missing_count FROM gaps"),
    "union_classified": with_(EV, KW, CATS, summary_ctes()) + CLASSIFIED["union"],
    "final_missing_union": gap_sql("union", "SELECT COUNT(DISTINCT input_text) AS final_missing_count FROM gaps"),
    "coverage_by_day": with_(EV, CHATS, KW, CATS, COVERAGE) + "SELECT * FROM coverage ORDER BY date",
    "coverage_totals": with_(EV, CHATS, KW, CATS, COVERAGE)
    + """SELECT *, CASE WHEN total_unique_questions > 0
    THEN round_even(CAST(total_processed_questions AS DOUBLE) / total_unique_questions * 100, 1) ELSE 0.0 END AS processing_rate
FROM (SELECT CAST(SUM(unique_questions) AS BIGINT) AS total_unique_questions,
             (SELECT COUNT(DISTINCT query_text) FROM summary) AS total_processed_questions,
             CAST(SUM(missing_questions) AS BIGINT) AS total_missing_questions FROM coverage)""",
    "load_verdict": CK
    + f""", a AS (
  SELECT
    (SELECT CAST(SUM(n) AS BIGINT) FROM (SELECT COUNT(DISTINCT input_text) AS n FROM chattings WHERE {MONTH}
       GROUP BY CAST(created_at AS DATE))) AS total_questions,
    (SELECT CAST(SUM(n) AS BIGINT) FROM (SELECT COUNT(DISTINCT query_text) AS n FROM admin_chat_keywords WHERE {MONTH}
       GROUP BY CAST(created_at AS DATE))) AS processed_questions,
    (SELECT CAST(SUM(n) AS BIGINT) FROM (SELECT COUNT(DISTINCT query_text) AS n FROM admin_chat_keywords
       WHERE {MONTH} AND CAST(batch_created_at AS DATE) = DATE '2024-02-02' GROUP BY CAST(created_at AS DATE))) AS loaded_questions,
    (SELECT CAST(SUM(n) AS BIGINT) FROM (SELECT COUNT(DISTINCT c.input_text) AS n FROM chattings c
       LEFT JOIN ({CLASSIFIED['per_day']}) t ON c.input_text = t.query_text AND CAST(c.created_at AS DATE) = t.dt
       WHERE t.query_text IS NULL AND c.{MONTH} GROUP BY CAST(c.created_at AS DATE))) AS missing_questions)
SELECT *, round_even(CAST(processed_questions AS DOUBLE) / total_questions * 100, 1) AS processing_rate,
  CASE WHEN missing_questions > 0 THEN 'missing' WHEN loaded_questions > 0 THEN 'loaded' ELSE 'nothing_loaded' END AS verdict
FROM a""",
    "report_rows": REPORT + "SELECT * FROM report",
    "report_overview": REPORT + OVERVIEW,
    "report_overview_sheet": REPORT
    + f""", o AS ({OVERVIEW})
SELECT '조회기간' AS item, period AS value FROM o UNION ALL SELECT '총 레코드 수', CAST(total_records AS VARCHAR) FROM o
UNION ALL SELECT '고유 질문 수', CAST(unique_questions AS VARCHAR) FROM o
UNION ALL SELECT '고유 키워드 수', CAST(unique_keywords AS VARCHAR) FROM o
UNION ALL SELECT '총 질문 횟수', CAST(total_query_count AS VARCHAR) FROM o""",
    "report_by_category": REPORT
    + """SELECT category_name, COUNT(query_text) AS record_count, CAST(SUM(query_count) AS BIGINT) AS total_queries,
  COUNT(DISTINCT keyword) AS unique_keywords FROM report GROUP BY 1 ORDER BY 2 DESC, 1""",
    "report_by_day": REPORT
    + """SELECT date, COUNT(query_text) AS record_count, COUNT(DISTINCT query_text) AS unique_questions,
  CAST(SUM(query_count) AS BIGINT) AS total_queries, COUNT(DISTINCT keyword) AS unique_keywords FROM report GROUP BY 1 ORDER BY 1""",
    "report_top_keywords": REPORT
    + """SELECT keyword, COUNT(query_text) AS record_count, CAST(SUM(query_count) AS BIGINT) AS total_queries
FROM report WHERE keyword IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "report_top_questions": REPORT
    + """, firsts AS (
  SELECT query_text, query_count, ROW_NUMBER() OVER (PARTITION BY query_text ORDER BY date) AS rn FROM report),
used AS (SELECT query_text, keyword, MIN(date) AS d FROM report WHERE keyword IS NOT NULL GROUP BY 1, 2),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_text ORDER BY d, keyword) AS rn FROM used)
SELECT f.query_text, f.query_count, COALESCE(k.keywords, '') AS keywords FROM firsts f
LEFT JOIN (SELECT query_text, string_agg(keyword, ', ' ORDER BY rn) AS keywords FROM ranked WHERE rn <= 3 GROUP BY 1) k
  ON f.query_text = k.query_text
WHERE f.rn = 1 ORDER BY f.query_count DESC, f.query_text LIMIT 10""",
    "report_placeholder": with_(EV, KW, CATS, report_ctes(), report_ctes(NOTHING, "later"))
    + """SELECT query_text, keyword, category_name, query_count, created_at, 'full' AS sheet FROM report
UNION ALL SELECT '데이터 없음', '', '', 0, TIMESTAMP '2024-01-01', 'full' WHERE (SELECT COUNT(*) FROM report) = 0
UNION ALL SELECT query_text, keyword, category_name, query_count, created_at, 'empty' FROM later
UNION ALL SELECT '데이터 없음', '', '', 0, TIMESTAMP '2025-06-11', 'empty' WHERE (SELECT COUNT(*) FROM later) = 0""",
    "report_ellipsis": TX + "SELECT id, CASE WHEN length(text) > 100 THEN text[1:100] || '...' ELSE text END AS shown FROM texts",
    "daily_totals": with_(EV, CHATS)
    + f"""SELECT CAST(created_at AS DATE) AS date, COUNT(DISTINCT input_text) AS unique_questions, COUNT(*) AS total_messages
FROM chattings WHERE {MONTH} GROUP BY 1 ORDER BY 1""",
    "keyword_daily": with_(EV, KW) + per_day("admin_chat_keywords"),
    "keyword_daily_loaded": with_(EV, KW)
    + per_day("admin_chat_keywords", "AND CAST(batch_created_at AS DATE) = DATE '2024-02-02'"),
    "keyword_volume": with_(EV, KW)
    + f"""SELECT CAST(created_at AS DATE) AS date, COUNT(DISTINCT query_text) AS unique_queries,
  CAST(SUM(query_count) AS BIGINT) AS total_count FROM admin_chat_keywords WHERE {MONTH} GROUP BY 1 ORDER BY 1""",
    "daily_reconciliation": with_(EV, CHATS, KW, CATS, summary_ctes())
    + f""", src AS (SELECT CAST(created_at AS DATE) AS date, COUNT(DISTINCT input_text) AS s FROM chattings WHERE {MONTH} GROUP BY 1),
daily AS (SELECT CAST(created_at AS DATE) AS date, COUNT(query_text) AS r, CAST(SUM(query_count) AS BIGINT) AS t FROM summary GROUP BY 1),
uniq AS (SELECT CAST(created_at AS DATE) AS date, COUNT(DISTINCT query_text) AS u FROM summary GROUP BY 1),
merged AS (SELECT * FROM daily JOIN uniq USING (date))
SELECT date, COALESCE(s, 0) AS source_questions, COALESCE(u, 0) AS classified_questions, COALESCE(r, 0) AS classified_records,
  COALESCE(t, 0) AS classified_total, COALESCE(s, 0) - COALESCE(u, 0) AS difference
FROM src FULL JOIN merged USING (date) ORDER BY date""",
    "result_diff": with_(EV, CHATS, KW)
    + f""", per_day_work AS (WITH {gap_ctes('per_day')} {WORK}), ever_work AS (WITH {gap_ctes('ever')} {WORK})
SELECT *, 'left' AS side FROM (SELECT * FROM per_day_work EXCEPT ALL SELECT * FROM ever_work)
UNION ALL SELECT *, 'right' FROM (SELECT * FROM ever_work EXCEPT ALL SELECT * FROM per_day_work)""",
    "run_ledger": with_(EV, CHATS, KW, LEDGER) + "SELECT * FROM ledger ORDER BY date",
    "run_totals": with_(EV, CHATS, KW, LEDGER)
    + """SELECT *, CASE WHEN failed_dates = '' THEN 'SUCCESS' WHEN days = 1 THEN 'FAILED' ELSE 'PARTIAL_SUCCESS' END AS status
FROM (SELECT COUNT(*) AS days, CAST(SUM(total_rows) AS BIGINT) AS total_rows, CAST(SUM(processed) AS BIGINT) AS processed_count,
        CAST(SUM(skipped) AS BIGINT) AS skipped_count,
        COALESCE(string_agg(CAST(date AS VARCHAR), ', ' ORDER BY date) FILTER (status = 'FAILED'), '') AS failed_dates
      FROM ledger)""",
    "complete_run": with_(EV, CHATS, KW, CATS, RULED, FACTS, COMPLETE)
    + """SELECT *, basic_rows + missing_rows AS total_rows_written, remaining_missing = 0 AS verification_success FROM c""",
    "reject_split": with_(EV, KW)
    + """SELECT *, CASE WHEN query_text IS NULL THEN 'query_text is null' WHEN keyword IS NULL THEN 'keyword is null'
  WHEN length(keyword) > 100 THEN 'keyword too long' WHEN category_id IS NULL THEN 'category_id is null' END AS reject_reason
FROM admin_chat_keywords""",
    "reject_counts": with_(EV, KW)
    + """SELECT CASE WHEN query_text IS NULL THEN 'query_text is null' WHEN keyword IS NULL THEN 'keyword is null'
  WHEN length(keyword) > 100 THEN 'keyword too long' WHEN category_id IS NULL THEN 'category_id is null' ELSE 'stored' END AS outcome,
  COUNT(*) AS rows FROM admin_chat_keywords GROUP BY 1""",
    "rule_category": TX + f"SELECT id, {first_rule_category('text')} AS category_name FROM texts",
    "rule_keyword": TX + f"SELECT id, {rule_keyword('text')} AS keyword FROM texts",
    "first_meaningful_word": TX
    + f"SELECT id, CASE WHEN text IS NOT NULL THEN {telling_word('text')} END AS word FROM texts",
    "simple_keyword": TX + f"SELECT id, {simple_keyword('text')} AS keyword FROM texts",
    "fallback_classify": TX
    + f"SELECT id, {rule_keyword('text')} AS keyword, {first_rule_category('text')} AS category_name FROM texts WHERE text IS NOT NULL",
    "clean_keyword": with_(EV, TEXTS, CANDIDATES)
    + f"""SELECT id, kind, {clean_keyword('keyword', 'text', 'word')} AS keyword
FROM (SELECT c.*, w.word FROM candidates c JOIN (SELECT id, {telling_word('text')} AS word FROM texts) w ON c.id = w.id)""",
    "cap_keyword": CAND + f"SELECT id, kind, {cap_keyword('keyword', 'text')} AS keyword FROM candidates",
    "truncate_keyword": CAND
    + """SELECT id, kind, CASE WHEN length(keyword) > 100 THEN keyword[1:97] || '...' ELSE keyword END AS keyword,
  CASE WHEN length(keyword) > 100 THEN keyword[1:98] || '...' ELSE keyword END AS legacy_keyword FROM candidates""",
    "backfill_keyword": CAND + f"SELECT id, kind, {backfill_keyword('keyword', 'text')} AS keyword FROM candidates",
    "normalize_categories": TX
    + f""", named AS (SELECT id, CASE WHEN text IS NULL THEN ['기타'] ELSE
    list_filter(list_transform(regexp_split_to_array(text, '[,\\n]'), lambda n: {strip('n')}), lambda n: n <> '') END AS names FROM texts),
filled AS (SELECT id, CASE WHEN len(names) = 0 THEN ['기타'] ELSE names END AS names FROM named)
SELECT id, CAST(generate_subscripts(names, 1) - 1 AS INT) AS pos, unnest(names) AS category_name FROM filled""",
    "normalize_day": with_(EV)
    + """, mixed AS (SELECT event_id, ts, CASE WHEN k < 20 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN k < 40 THEN strftime(ts, '%Y-%m-%d')
    WHEN k < 60 THEN strftime(ts, '%Y-%-m-%-d') WHEN k < 70 THEN strftime(ts, '%Y/%m/%d %H:%M') WHEN k < 80 THEN '2024-2-30'
    WHEN k < 90 THEN strftime(ts, '%Y%m%d%H%M%S') END AS x FROM ev)
SELECT event_id, CASE WHEN length(x) >= 10 AND length(x[1:10]) - length(replace(x[1:10], '-', '')) = 2 THEN x[1:10]
    WHEN try_strptime(x, '%Y-%m-%d') IS NOT NULL AND contains(x, '-') THEN strftime(try_strptime(x, '%Y-%m-%d'), '%Y-%m-%d')
    ELSE x[1:10] END AS day, strftime(ts, '%Y-%m-%d') AS ts_day FROM mixed""",
    "duration_format": with_(EV)
    + """, spans AS (SELECT user_id, CAST(ts AS DATE) AS date,
    CAST(floor((epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1000000.0) AS BIGINT) AS s FROM ev GROUP BY 1, 2)
SELECT user_id, date, (s // 60) || '분 ' || (s % 60) || '초' AS minutes_seconds,
  CASE WHEN s >= 3600 THEN (s // 3600) || '시간 ' || (s % 3600 // 60) || '분 ' || (s % 60) || '초'
       WHEN s >= 60 THEN (s // 60) || '분 ' || (s % 60) || '초' ELSE s || '초' END AS hours_minutes_seconds FROM spans""",
    "validation_counts": with_(EV)
    + f""", docs AS (SELECT regexp_extract(text, '[^ \\n]+@[^ \\n]+') AS email, text, n_chars FROM documents),
labelled AS (SELECT *, '2024-' || k || '-' || (user_id % 40) AS label,
  CASE WHEN k < 50 THEN true ELSE false END AS good FROM ev)
SELECT 'email' AS rule, COUNT(*) AS rows_checked,
  COUNT(*) FILTER (NOT COALESCE(regexp_matches(email, {lit(fv.EMAIL_PATTERN)}), false)) AS violations, 'documents' AS source FROM docs
UNION ALL SELECT 'text', COUNT(*), COUNT(*) FILTER (COALESCE({strip('text')}, '') = ''), 'documents' FROM docs
UNION ALL SELECT 'size', COUNT(*), COUNT(*) FILTER (NOT COALESCE(n_chars > 0, false)), 'documents' FROM docs
UNION ALL SELECT 'day', COUNT(*), COUNT(*) FILTER (try_strptime(label, '%Y-%m-%d') IS NULL), 'events' FROM labelled
UNION ALL SELECT 'question', COUNT(*), COUNT(*) FILTER (COALESCE({strip('question')}, '') = ''), 'events' FROM labelled
UNION ALL SELECT 'count', COUNT(*), COUNT(*) FILTER (k <= 0), 'events' FROM labelled
UNION ALL SELECT 'names', COUNT(*), COUNT(*) FILTER (event_type IS NULL OR question IS NULL), 'events' FROM labelled
UNION ALL SELECT 'structure', COUNT(*), COUNT(*) FILTER (NOT good), 'events' FROM labelled""",
    "parse_responses": RESP + "SELECT * FROM parsed",
    "explode_classification": RESP + "SELECT chatting_pk, input_text, created_at, total_count, keyword, category_name FROM exploded",
    "category_resolve": with_(EV, CATS, PARSED, RESOLVED) + "SELECT * FROM resolved",
    "category_distribution": with_(EV, CATS, PARSED, RESOLVED)
    + "SELECT category_name, COUNT(*) AS row_count FROM resolved GROUP BY 1 ORDER BY 2 DESC, 1",
    "classify_questions": with_(EV, CHATS, CATS, RULED, FACTS) + "SELECT * FROM facts",
    "skipped_questions": with_(EV, CHATS, KW, LEDGER)
    + f""", counted AS (SELECT input_text, COUNT(*) AS total_count, CAST(created_at AS DATE) AS created_at
  FROM chattings WHERE {MONTH} GROUP BY 1, 3)
SELECT c.* FROM counted c LEFT JOIN (SELECT DISTINCT query_text, CAST(created_at AS DATE) AS d FROM good) g
  ON c.input_text = g.query_text AND c.created_at = g.d WHERE g.query_text IS NULL""",
    "classify_with_caller": with_(EV, CHATS, CATS, RULED)
    + """SELECT a.input_text AS query_text, CASE WHEN a.input_text LIKE '오류%' THEN r.keyword ELSE split_part(a.input_text, ' ', -2) END AS keyword,
  c.category_id, a.total_count AS query_count, CAST(a.created_at AS TIMESTAMP) AS created_at,
  TIMESTAMP '2024-02-03 01:00:00' AS batch_created_at, c.category_name
FROM asked a JOIN ruled r ON a.input_text = r.input_text
JOIN admin_categories c ON (a.input_text LIKE '오류%' AND c.category_name = r.category_name)
  OR (a.input_text NOT LIKE '오류%' AND c.category_name IN ('학생 생활', '기타'))""",
}


# --- the report as printed: a line of titles and values for each row of each sheet ---------


def printed(sheet: str, query: str, *values: str) -> str:
    name, titles = fv.SHEET_TITLES[sheet]
    cells = ", ".join(f"{lit(t + '=')} || COALESCE(CAST({v} AS VARCHAR), '')" for t, v in zip(titles, values))
    return f"SELECT {lit(name)} AS sheet, concat_ws(' | ', {cells}) AS line FROM ({ORACLE[query]})"


_SHORT = "CASE WHEN length(query_text) > 100 THEN query_text[1:100] || '...' ELSE query_text END"
ORACLE["report_titled_sheets"] = " UNION ALL ".join(
    [
        printed("main", "report_rows", "query_text", "keyword", "category_name", "query_count", "created_at"),
        printed("by_category", "report_by_category", "category_name", "record_count", "total_queries", "unique_keywords"),
        printed("by_day", "report_by_day", "date", "record_count", "unique_questions", "total_queries", "unique_keywords"),
        printed("top_keywords", "report_top_keywords", "keyword", "record_count", "total_queries"),
        printed("top_questions", "report_top_questions", _SHORT, "query_count", "keywords"),
        printed("overview", "report_overview_sheet", "item", "value"),
    ]
)
