"""Independent DuckDB SQL for the registered queries (the correctness oracle).

The fixtures are re-derived here from the driver's tables in plain SQL; the text
functions only need what the fixture data contains (the named references found in
whole pages, titles and answers at sf0.001-0.1, ASCII whitespace), which keeps the oracle
independent of the Spark expressions it checks.
"""

from __future__ import annotations

from quizlake import constants as K
from quizlake.plans.fixtures import MALFORMED

DUP = 1 << 52
RUN_TS = "2024-01-01T00:00:00+00:00"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dec(x: str) -> str:
    """Reference decoding for the forms present in the fixture data: ``&quot;``,
    ``&copy;``, ``&middot;`` and ``&amp;``, plus the semicolon-less legacy forms of
    ``quot`` / ``amp`` (pages and titles hold ``&amp`` without ``;``). ``&amp`` goes last, in one
    regex pass, so nothing is decoded twice."""
    return (f"regexp_replace(replace(replace(regexp_replace({x}, '&quot;?', '\"', 'g'), '&copy;', '©'), "
            f"'&middot;', '·'), '&amp;?', '&', 'g')")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def norm(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({strip(dec(x))}), '\\.$', ''), '\\s+$', '')"


def diff(x: str) -> str:
    return f"CASE ({x}) % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END"


def jlist(x: str) -> str:
    return f"('[' || array_to_string(list_transform({x}, lambda e: CAST(to_json(e) AS VARCHAR)), ', ') || ']')"


ATTEMPTS = f"""attempts AS (
  SELECT CAST(event_id AS VARCHAR) AS question_id, event_id AS ordinal,
    CASE WHEN event_id % 89 <> 3 THEN event_type END AS category,
    CASE WHEN event_id % 5 = 0 THEN 'boolean' ELSE 'multiple' END AS type,
    CASE WHEN event_id % 83 = 5 THEN 'expert' ELSE {diff('user_id')} END AS difficulty,
    CASE WHEN event_id % 97 <> 7 THEN 'model_' || CAST(user_id % 2 AS VARCHAR) END AS model,
    {lit(K.PROMPT_VERSION)} AS prompt_version, CAST(0 AS BIGINT) AS temperature, CAST(50 AS BIGINT) AS max_tokens,
    'Question ' || CAST(event_id AS VARCHAR) AS question_clean,
    'Answer ' || CAST(k % 4 AS VARCHAR) AS correct_answer_clean,
    CASE WHEN k % 10 = 0 THEN NULL WHEN k % 3 = 0 THEN 'Answer ' || CAST(k % 4 AS VARCHAR)
         ELSE 'Answer ' || CAST((k + 1) % 4 AS VARCHAR) END AS ai_answer,
    CASE WHEN k % 10 = 0 OR event_id % 73 = 9 THEN NULL ELSE k % 3 = 0 END AS ai_correct,
    value AS response_time,
    CASE WHEN event_id % 79 = 11 THEN NULL WHEN k % 10 = 0 THEN 'error' ELSE 'success' END AS status,
    CASE WHEN k % 20 = 0 THEN 'Timeout: timeout' END AS error
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e)"""

FILTERED = """filtered AS (SELECT * FROM attempts WHERE model IS NOT NULL
  AND difficulty IN ('easy', 'medium', 'hard') AND category IS NOT NULL)"""
OK = "ok AS (SELECT * FROM filtered WHERE status = 'success')"

ATTEMPTS_BIG = f"""attempts_big AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS question_id, l_returnflag AS category,
    l_linestatus AS type, {diff('l_linenumber')} AS difficulty,
    'model_' || CAST(l_suppkey % 2 AS VARCHAR) AS model,
    CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_suppkey % 3 = 0 END AS ai_correct,
    l_quantity AS response_time,
    CASE WHEN l_partkey % 10 = 0 THEN 'error' ELSE 'success' END AS status,
    CASE WHEN l_partkey % 20 = 0 THEN 'Timeout: timeout' END AS error
  FROM lineitem)"""

BRONZE = f"""nparts AS (SELECT count(*) AS n FROM part),
bbase AS (
  SELECT p.page_id AS ordinal, 'cat_' || CAST(p.page_id % 7 AS VARCHAR) AS category,
    CASE WHEN p.page_id % 5 = 0 THEN 'boolean' ELSE 'multiple' END AS type,
    {diff('p.page_id')} AS difficulty,
    CASE WHEN p.page_id % 31 = 3 THEN '  ' ELSE p.html END AS question,
    CASE WHEN p.page_id % 29 = 7 THEN '' ELSE coalesce(a.p_name || ' &amp; ' || a.p_brand, '') END AS correct_answer,
    coalesce(b.p_name || ' &amp; co', '') AS inc1, coalesce(c.p_name, '') AS inc2,
    p.page_id % 7 AS cat_no
  FROM pages p CROSS JOIN nparts
  LEFT JOIN part a ON a.p_partkey = p.page_id % nparts.n
  LEFT JOIN part b ON b.p_partkey = (p.page_id * 7 + 1) % nparts.n
  LEFT JOIN part c ON c.p_partkey = (p.page_id * 13 + 2) % nparts.n),
bronze0 AS (
  SELECT ordinal, category, type, difficulty, question, correct_answer,
    CASE WHEN ordinal % 17 = 5 THEN 'garbage'
         WHEN ordinal % 17 = 9 THEN '(' || chr(39) || inc1 || chr(39) || ',)'
         WHEN ordinal % 17 = 13 THEN '[' || chr(39) || inc1 || chr(39) || ', None]'
         WHEN ordinal % 10 = 7 THEN '[' || chr(39) || inc1 || '\\xa0' || chr(39) || ', u' || chr(39) || '\\u00e9 ' || inc2 || chr(39) || ']'
         WHEN ordinal % 10 = 3 THEN '[' || chr(39) || inc1 || chr(39) || ', ' || chr(39) || inc2 || chr(39) || ']'
         ELSE '["' || inc1 || '", "' || inc2 || '"]' END AS incorrect_answers,
    'fixture' AS source, CAST(cat_no AS VARCHAR) AS category_id, '{RUN_TS}' AS fetched_at
  FROM bbase),
bronze AS (
  SELECT * FROM bronze0
  UNION ALL
  SELECT ordinal + {DUP}, category, type, {diff('ordinal + 1')}, question, correct_answer, incorrect_answers,
    'fixture-copy', category_id, '2024-01-02T00:00:00+00:00' FROM bronze0),
bq AS (
  SELECT *, sha256('[' || CAST(to_json(category) AS VARCHAR) || ', ' || CAST(to_json(question) AS VARCHAR) || ', '
      || CAST(to_json(correct_answer) AS VARCHAR) || ', ' || CAST(to_json(incorrect_answers) AS VARCHAR) || ']') AS question_id
  FROM bronze),
items0 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY ordinal) AS rn FROM bq) WHERE rn = 1)"""


# the literal lists of the fixture: single quotes, a no-break space (stripped at the end of an
# element) and an accented letter written as escapes, one u prefix
LITERAL_AS_JSON = "replace(replace(replace(incorrect_answers, '\\xa0', ''), ', u' || chr(39), ', ' || chr(39)), chr(39), '\"')"
LIST_ERROR = f"""CASE (ordinal % {DUP}) % 17 WHEN 5 THEN {lit(K.MSG_LIST_INVALID)} WHEN 9 THEN {lit(K.MSG_LIST_EMPTY)}
      WHEN 13 THEN {lit(K.MSG_LIST_BAD_ELEMENT)} END"""


def clean_cte(src: str, name: str) -> str:
    return f"""{name}_p AS (
  SELECT *, {strip(dec('question'))} AS question_clean, {strip(dec('correct_answer'))} AS correct_answer_clean,
    CASE WHEN json_valid(incorrect_answers) THEN 'json'
         WHEN json_valid({LITERAL_AS_JSON}) THEN 'literal' ELSE 'invalid' END AS list_dialect,
    {LIST_ERROR} AS list_error
  FROM {src}),
{name}_l AS (
  SELECT *,
    CASE WHEN question_clean = '' OR correct_answer_clean = '' THEN {lit('ValueError: ' + K.MSG_EMPTY_ITEM)}
         WHEN list_error IS NOT NULL THEN 'ValueError: ' || list_error END AS item_error,
    list_transform(CASE list_dialect WHEN 'json' THEN from_json(incorrect_answers, '["VARCHAR"]')
                                     WHEN 'literal' THEN from_json({LITERAL_AS_JSON}, '["VARCHAR"]') END,
                   lambda e: {strip(dec('e'))}) AS answers
  FROM {name}_p),
{name} AS (
  SELECT *,
    CASE WHEN item_error IS NULL THEN {jlist('answers')} END AS incorrect_answers_clean,
    CASE WHEN item_error IS NULL AND question_clean <> '' AND correct_answer_clean <> '' AND list_dialect = 'literal'
         THEN {lit(K.MSG_LITERAL_WARNING)} END AS cleaning_warning,
    CASE WHEN item_error IS NULL THEN list_transform(list_sort(list_transform(list_concat([correct_answer_clean], answers),
         lambda c, i: {{'k': sha256(question_id || ':' || CAST(i - 1 AS VARCHAR)), 'c': c}})), lambda s: s.c) END AS choice_list
  FROM {name}_l)"""


ITEMS = clean_cte("items0", "items")
RAW_ITEMS = clean_cte("bq", "raw_items")

PROMPT = (f"{lit(K.PROMPT_HEADER)} || question_clean || {lit(K.PROMPT_CHOICES_HEADER)} || "
          f"array_to_string(list_transform(choice_list, lambda c: {lit(K.PROMPT_CHOICE_BULLET)} || c), chr(10)) || "
          f"{lit(K.PROMPT_FOOTER)}")


def responses_cte(src: str = "items") -> str:
    good = ("CAST(to_json({'choices': [{'message': {'content': content}, 'finish_reason': 'stop'}]}) AS VARCHAR)"
            " || ' trailing'")
    malformed = " ".join(f"WHEN {i} THEN {good if t is None else lit(t)}" for i, t in enumerate(MALFORMED))
    return f"""responses AS (
  SELECT 'fixture-model' AS model, question_id,
    CASE WHEN b = 1 THEN NULL
         WHEN b = 2 THEN CASE (ordinal // 11) % 8 {malformed} END
         ELSE CAST(to_json({{'choices': [{{'message': {{'content': content}},
                              'finish_reason': CASE WHEN b = 4 THEN 'length' ELSE 'stop' END}}]}}) AS VARCHAR) END AS payload,
    CAST(ordinal % 7 AS DOUBLE) / 4 AS response_time,
    CASE WHEN b = 1 THEN 'Timeout: timeout' END AS transport_error
  FROM (SELECT *, ordinal % 11 AS b,
          CASE ordinal % 11 WHEN 3 THEN '   ' WHEN 5 THEN '  ' || upper(correct_answer_clean) || '. '
               WHEN 6 THEN 'I do not know' WHEN 7 THEN 'It is ' || correct_answer_clean || '.'
               WHEN 8 THEN correct_answer ELSE correct_answer_clean END AS content
        FROM {src}) s
  WHERE b <> 0)"""


def graded_cte(src: str = "items", name: str = "graded") -> str:
    blank = "regexp_matches(content, '^\\s*$')"
    return f"""{name}_r AS (
  SELECT i.*, r.payload, r.response_time AS rt, r.transport_error, (r.question_id IS NOT NULL) AS has_row,
    coalesce(json_valid(r.payload), false) AS vj
  FROM {src} i LEFT JOIN (SELECT * FROM responses WHERE model = 'fixture-model') r USING (question_id)),
{name}_x AS (
  SELECT *,
    CASE WHEN vj THEN json_extract(payload, '$.choices') END AS ch,
    CASE WHEN vj THEN json_array_length(payload, '$.choices') END AS nch,
    CASE WHEN vj THEN json_extract(payload, '$.choices[0].message') END AS msg,
    CASE WHEN vj THEN json_type(payload, '$.choices[0].message.content') END AS ctype,
    CASE WHEN vj AND json_type(payload, '$.choices[0].message.content') = 'VARCHAR'
         THEN json_extract_string(payload, '$.choices[0].message.content') END AS content,
    CASE WHEN vj THEN json_extract_string(payload, '$.choices[0].finish_reason') END AS fr
  FROM {name}_r),
{name}_e AS (
  SELECT *, CASE
    WHEN item_error IS NOT NULL THEN item_error
    WHEN NOT has_row THEN 'RequestException: no recorded response'
    WHEN transport_error IS NOT NULL THEN transport_error
    WHEN NOT vj THEN 'JSONDecodeError: reply is not valid JSON'
    WHEN json_type(payload) <> 'OBJECT' THEN {lit('ValueError: ' + K.MSG_UNEXPECTED_JSON)}
    WHEN ch IS NULL THEN 'KeyError: ''choices'''
    WHEN nch = 0 THEN 'IndexError: list index out of range'
    WHEN msg IS NULL THEN 'KeyError: ''message'''
    WHEN ctype IS NULL THEN 'KeyError: ''content'''
    WHEN content IS NULL OR {blank} THEN {lit('ValueError: ' + K.MSG_EMPTY_REPLY)}
    WHEN fr = 'length' THEN {lit('ValueError: ' + K.MSG_TRUNCATED)}
  END AS error
  FROM {name}_x),
{name} AS (
  SELECT *, CASE WHEN error IS NULL THEN 'success' ELSE 'error' END AS status,
    CASE WHEN item_error IS NULL AND has_row AND transport_error IS NULL AND vj AND content IS NOT NULL AND NOT {blank}
         THEN content END AS ai_answer,
    CASE WHEN error IS NULL THEN {norm('content')} = {norm('correct_answer_clean')} END AS ai_correct,
    CASE WHEN item_error IS NULL AND has_row THEN rt END AS response_time,
    'fixture-model' AS model, CAST(0 AS BIGINT) AS temperature, CAST(50 AS BIGINT) AS max_tokens,
    {lit(K.PROMPT_VERSION)} AS prompt_version
  FROM {name}_e)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ITEMS_ALL = (BRONZE, ITEMS)
GRADED_ALL = (BRONZE, ITEMS, responses_cte(), graded_cte())

GOLD_AGG = """count(*) AS total_questions,
  CAST(sum(CASE WHEN ai_correct THEN 1 ELSE 0 END) AS BIGINT) AS correct_answers,
  round(100.0 * CAST(sum(CASE WHEN ai_correct THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 2) AS accuracy_pct,
  round(avg(response_time), 3) AS avg_response_time_sec"""

REPORT_AGG = """count(*) AS questions,
  CAST(coalesce(sum(CAST(ai_correct AS INTEGER)), 0) AS BIGINT) AS bonnes_reponses,
  avg(CAST(ai_correct AS DOUBLE)) AS "precision",
  round(avg(response_time) + 1e-9, 6) AS latence_moyenne,
  round(quantile_cont(response_time, 0.5), 6) AS latence_mediane,
  avg(CAST(ai_correct AS DOUBLE)) * 100 AS precision_pct"""

REP = (ATTEMPTS, FILTERED, OK)

RC = "CASE (page_no * 7 + cat_no) % 23 WHEN 5 THEN 5 WHEN 11 THEN 4 WHEN 17 THEN 1 WHEN 20 THEN NULL ELSE 0 END"
# loose policy: a category ends at its first page that is neither accepted nor retried
PAGES = f"""pg AS (SELECT *, ordinal // 70 AS page_no FROM bbase),
pgrc AS (SELECT cat_no, page_no, {RC} AS response_code FROM (SELECT DISTINCT cat_no, page_no FROM pg)),
fs AS (SELECT cat_no, min(page_no) AS stop FROM pgrc
       WHERE response_code IS NULL OR response_code NOT IN (0, 5) GROUP BY cat_no)"""
INGESTED = f"""ingested AS (
  SELECT cat_no * 8796093022208 + page_no * 64 + pos AS ordinal, category, type, difficulty, question, correct_answer,
    '[' || CAST(to_json(inc1) AS VARCHAR) || ', ' || CAST(to_json(inc2) AS VARCHAR) || ']' AS incorrect_answers,
    'recorded-api' AS source, CAST(cat_no AS VARCHAR) AS category_id, '{RUN_TS}' AS fetched_at
  FROM (SELECT *, row_number() OVER (PARTITION BY cat_no, page_no ORDER BY ordinal) - 1 AS pos FROM pg)
  LEFT JOIN fs USING (cat_no)
  WHERE {RC} = 0 AND (stop IS NULL OR page_no < stop))"""


# the earlier run's items: the first half in file order
HALF = """(SELECT question_id FROM (SELECT question_id, row_number() OVER (ORDER BY ordinal) AS rn, count(*) OVER () AS n
          FROM items) WHERE rn <= n // 2)"""

# offline echo scorer: each sendable item is answered with its first (keyed-shuffled) choice
ECHOED = f"""SELECT question_id,
        CASE WHEN item_error IS NULL THEN 'success' ELSE 'error' END AS status,
        CASE WHEN item_error IS NULL THEN {norm('choice_list[1]')} = {norm('correct_answer_clean')} END AS ai_correct,
        item_error AS error FROM items"""

# recorded attempts: the rate-limited pages, how many attempts they are refused, and the silent first ones
RETRIES = """rp AS (SELECT DISTINCT cat_no, ordinal // 70 AS page_no FROM bbase),
rw AS (SELECT *, (page_no + cat_no) % 3 = 1 AS limited,
    CASE WHEN (page_no + cat_no) % 3 = 1 THEN 1 + (page_no * 2 + cat_no) % 5 ELSE 0 END AS waits,
    (page_no * 7 + cat_no) % 23 AS h FROM rp),
rl AS (SELECT *, CASE WHEN limited THEN 0 WHEN h = 11 THEN 4 WHEN h = 20 THEN NULL ELSE 0 END AS rc, NOT limited AND h IN (11, 20) AS ends
  FROM rw),
-- a page behind the end of its category is asked until the round in which that end is known (the first)
re AS (SELECT cat_no, min(page_no) AS stop FROM rl WHERE ends GROUP BY cat_no),
rs AS (SELECT rl.*, stop, CASE WHEN page_no > stop THEN 1 ELSE least(waits + 1, 4) END AS attempts FROM rl LEFT JOIN re USING (cat_no)),
rf AS (SELECT *, attempts <= waits AS refused FROM rs)"""
RETRY_INGESTED = f"""ingested AS (
  SELECT cat_no * 8796093022208 + page_no * 64 + pos AS ordinal, category, type, difficulty, question, correct_answer,
    '[' || CAST(to_json(inc1) AS VARCHAR) || ', ' || CAST(to_json(inc2) AS VARCHAR) || ']' AS incorrect_answers,
    'recorded-api' AS source, CAST(cat_no AS VARCHAR) AS category_id, '{RUN_TS}' AS fetched_at
  FROM (SELECT *, ordinal // 70 AS page_no, row_number() OVER (PARTITION BY cat_no, ordinal // 70 ORDER BY ordinal) - 1 AS pos FROM bbase)
  JOIN rf USING (cat_no, page_no) WHERE NOT refused AND rc = 0 AND (stop IS NULL OR page_no < stop))"""

ORACLE = {
    # ---------------------------------------------------------------- gold
    "gold_accuracy_overall": w(ATTEMPTS) + f"SELECT {GOLD_AGG} FROM attempts WHERE status = 'success'",
    "gold_accuracy_by_category": w(ATTEMPTS) + f"""SELECT category, difficulty, {GOLD_AGG}
        FROM attempts WHERE status = 'success' GROUP BY category, difficulty ORDER BY category, difficulty""",
    "gold_accuracy_by_difficulty": w(ATTEMPTS) + f"""SELECT difficulty, {GOLD_AGG}
        FROM attempts WHERE status = 'success' GROUP BY difficulty ORDER BY difficulty""",
    "gold_error_rate": w(ATTEMPTS) + """SELECT category, count(*) AS total_questions,
        CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS technical_errors,
        round(100.0 * CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 2) AS error_rate_pct
        FROM attempts GROUP BY category ORDER BY error_rate_pct DESC""",
    "gold_hardest_questions": w(ATTEMPTS) + """SELECT question_id, category, difficulty, question_clean,
        correct_answer_clean, ai_answer, count(*) AS total_attempts,
        CAST(sum(CASE WHEN ai_correct THEN 1 ELSE 0 END) AS BIGINT) AS correct_attempts,
        round(100.0 * CAST(sum(CASE WHEN ai_correct THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 2) AS accuracy_pct
        FROM attempts WHERE status = 'success'
        GROUP BY question_id, category, difficulty, question_clean, correct_answer_clean, ai_answer
        HAVING sum(CASE WHEN ai_correct THEN 1 ELSE 0 END) < count(*) ORDER BY accuracy_pct, category""",
    "gold_hardest_items": w(ATTEMPTS) + """SELECT model, question_id, category, difficulty, count(*) AS total_attempts,
        CAST(sum(CASE WHEN ai_correct THEN 1 ELSE 0 END) AS BIGINT) AS correct_attempts,
        round(100.0 * CAST(sum(CASE WHEN ai_correct THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 2) AS accuracy_pct
        FROM attempts WHERE status = 'success' GROUP BY model, question_id, category, difficulty
        HAVING sum(CASE WHEN ai_correct THEN 1 ELSE 0 END) < count(*)""",
    "gold_accuracy_by_category_big": w(ATTEMPTS_BIG) + f"""SELECT category, difficulty, {GOLD_AGG}
        FROM attempts_big WHERE status = 'success' GROUP BY category, difficulty""",
    "gold_error_rate_big": w(ATTEMPTS_BIG) + """SELECT category, count(*) AS total_questions,
        CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS technical_errors,
        round(100.0 * CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 2) AS error_rate_pct
        FROM attempts_big GROUP BY category""",
    "gold_on_silver": w(*GRADED_ALL) + f"""SELECT difficulty, {GOLD_AGG}
        FROM graded WHERE status = 'success' GROUP BY difficulty""",
    # ---------------------------------------------------------------- report
    "report_by_difficulty": w(*REP) + f"SELECT difficulty, {REPORT_AGG} FROM ok GROUP BY difficulty",
    "report_by_type": w(*REP) + f"SELECT type, {REPORT_AGG} FROM ok GROUP BY type",
    "report_by_category": w(*REP) + f"SELECT category, {REPORT_AGG} FROM ok GROUP BY category",
    "report_by_category_difficulty": w(*REP) + f"SELECT category, difficulty, {REPORT_AGG} FROM ok GROUP BY category, difficulty",
    "report_by_model": w(*REP) + """SELECT model, count(*) AS questions,
        CAST(coalesce(sum(CAST(ai_correct AS INTEGER)), 0) AS BIGINT) AS bonnes_reponses,
        avg(CAST(ai_correct AS DOUBLE)) * 100 AS precision_pct, round(avg(response_time) + 1e-9, 6) AS latence_moyenne,
        round(quantile_cont(response_time, 0.5), 6) AS latence_mediane FROM ok GROUP BY model""",
    "report_grouping_sets": w(*REP) + """SELECT CASE grouping(difficulty, type, category, model)
          WHEN 15 THEN 'all' WHEN 7 THEN 'difficulty' WHEN 11 THEN 'type' WHEN 13 THEN 'category'
          WHEN 5 THEN 'category_difficulty' WHEN 14 THEN 'model' END AS level,
        difficulty, type, category, model, count(*) AS questions,
        CAST(coalesce(sum(CAST(ai_correct AS INTEGER)), 0) AS BIGINT) AS bonnes_reponses,
        avg(CAST(ai_correct AS DOUBLE)) * 100 AS precision_pct, round(avg(response_time) + 1e-9, 6) AS latence_moyenne,
        round(quantile_cont(response_time, 0.5), 6) AS latence_mediane
        FROM ok GROUP BY GROUPING SETS ((), (difficulty), (type), (category), (category, difficulty), (model))""",
    "report_kpis": w(ATTEMPTS, FILTERED) + """SELECT count(*) AS questions,
        count(*) FILTER (WHERE status = 'success') AS successes,
        CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) / count(*) * 100 AS success_rate_pct,
        avg(CASE WHEN status = 'success' THEN CAST(CAST(ai_correct AS INTEGER) AS DOUBLE) END) * 100 AS accuracy_pct,
        round(avg(CASE WHEN status = 'success' THEN response_time END) + 1e-9, 6) AS latency_mean,
        round(quantile_cont(response_time, 0.5) FILTER (WHERE status = 'success'), 6) AS latency_median,
        round(quantile_cont(response_time, 0.95) FILTER (WHERE status = 'success'), 6) AS latency_p95
        FROM filtered""",
    "report_kpis_big": w(ATTEMPTS_BIG) + """, fb AS (SELECT * FROM attempts_big WHERE model IS NOT NULL
          AND difficulty IN ('easy', 'medium', 'hard') AND category IS NOT NULL)
        SELECT count(*) AS questions,
        count(*) FILTER (WHERE status = 'success') AS successes,
        CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) / count(*) * 100 AS success_rate_pct,
        avg(CASE WHEN status = 'success' THEN CAST(CAST(ai_correct AS INTEGER) AS DOUBLE) END) * 100 AS accuracy_pct,
        round(avg(CASE WHEN status = 'success' THEN response_time END) + 1e-9, 6) AS latency_mean,
        round(quantile_cont(response_time, 0.5) FILTER (WHERE status = 'success'), 6) AS latency_median,
        round(quantile_cont(response_time, 0.95) FILTER (WHERE status = 'success'), 6) AS latency_p95
        FROM fb""",
    "report_by_model_big": w(ATTEMPTS_BIG) + """SELECT model, count(*) AS questions,
        CAST(coalesce(sum(CAST(ai_correct AS INTEGER)), 0) AS BIGINT) AS bonnes_reponses,
        avg(CAST(ai_correct AS DOUBLE)) * 100 AS precision_pct, round(avg(response_time) + 1e-9, 6) AS latence_moyenne,
        round(quantile_cont(response_time, 0.5), 6) AS latence_mediane
        FROM attempts_big WHERE status = 'success' AND model IS NOT NULL
          AND difficulty IN ('easy', 'medium', 'hard') AND category IS NOT NULL GROUP BY model""",
    "latency_quantiles": w(*REP) + """SELECT model, round(quantile_cont(response_time, 0.5), 6) AS p50,
        round(quantile_cont(response_time, 0.9), 6) AS p90, round(quantile_cont(response_time, 0.95), 6) AS p95,
        round(quantile_cont(response_time, 0.99), 6) AS p99 FROM ok GROUP BY model""",
    "execution_quality": w(ATTEMPTS, FILTERED) + """SELECT count(*) FILTER (WHERE status = 'success') AS successes,
        count(*) FILTER (WHERE status IS DISTINCT FROM 'success') AS failures,
        count(*) FILTER (WHERE status = 'success' AND NOT coalesce(ai_correct, false)) AS wrong_answers FROM filtered""",
    "error_summary": w(ATTEMPTS, FILTERED) + f"""SELECT model, coalesce(error, {lit(K.ERROR_FILL_LABEL)}) AS error,
        count(*) AS occurrences FROM filtered WHERE status IS DISTINCT FROM 'success' GROUP BY 1, 2""",
    "pivot_category_difficulty": w(*REP) + """SELECT category,
        avg(CASE WHEN difficulty = 'easy' THEN CAST(CAST(ai_correct AS INTEGER) AS DOUBLE) END) * 100 AS easy,
        avg(CASE WHEN difficulty = 'medium' THEN CAST(CAST(ai_correct AS INTEGER) AS DOUBLE) END) * 100 AS medium,
        avg(CASE WHEN difficulty = 'hard' THEN CAST(CAST(ai_correct AS INTEGER) AS DOUBLE) END) * 100 AS hard
        FROM ok GROUP BY category""",
    "latency_histogram": w(*REP) + """, b AS (SELECT min(response_time) AS lo, max(response_time) AS hi FROM ok),
        h AS (SELECT difficulty, lo, (hi - lo) / 40 AS width,
                CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((response_time - lo) / ((hi - lo) / 40)), 39) END AS INTEGER) AS bin
              FROM ok CROSS JOIN b WHERE response_time IS NOT NULL)
        SELECT difficulty, bin, count(*) AS questions, round(any_value(lo) + bin * any_value(width), 6) AS bin_start,
          round(any_value(lo) + (bin + 1) * any_value(width), 6) AS bin_end FROM h GROUP BY difficulty, bin""",
    "speed_accuracy": w(*REP) + """SELECT 'category' AS level, category AS name, round(avg(response_time) + 1e-9, 6) AS latence_moyenne,
          avg(CAST(ai_correct AS DOUBLE)) * 100 AS precision_pct, count(*) AS questions FROM ok GROUP BY category
        UNION ALL
        SELECT 'model', model, round(avg(response_time) + 1e-9, 6), avg(CAST(ai_correct AS DOUBLE)) * 100, count(*) FROM ok GROUP BY model""",
    "filter_options": w(ATTEMPTS) + """SELECT 'model' AS filter, model AS value, CAST(NULL AS BIGINT) AS position
          FROM (SELECT DISTINCT model FROM attempts WHERE model IS NOT NULL)
        UNION ALL SELECT 'category', category, NULL FROM (SELECT DISTINCT category FROM attempts WHERE category IS NOT NULL)
        UNION ALL SELECT 'difficulty', difficulty,
          CASE difficulty WHEN 'easy' THEN 0 WHEN 'medium' THEN 1 WHEN 'hard' THEN 2 END
          FROM (SELECT DISTINCT difficulty FROM attempts WHERE difficulty IN ('easy', 'medium', 'hard'))""",
    "report_filter": w(ATTEMPTS) + """SELECT question_id, model, difficulty, category, status FROM attempts
        WHERE model IN ('model_1') AND difficulty IN ('medium', 'hard') AND category IN ('click', 'view', 'purchase')""",
    "wrong_answers": w(*REP) + """SELECT question_id, model, category, difficulty, ai_answer, correct_answer_clean, ai_correct
        FROM ok WHERE NOT coalesce(ai_correct, false)""",
    "detail_listing": w(*REP) + """SELECT model, category, difficulty, question_clean, ai_answer, correct_answer_clean,
        ai_correct, response_time FROM ok ORDER BY response_time DESC NULLS LAST""",
    "detail_listing_top": w(*REP) + """SELECT model, category, difficulty, question_clean, ai_answer, correct_answer_clean,
        ai_correct, response_time FROM ok ORDER BY response_time DESC NULLS LAST, model NULLS LAST, category NULLS LAST,
        difficulty NULLS LAST, question_clean NULLS LAST, ai_answer NULLS LAST, correct_answer_clean NULLS LAST,
        ai_correct NULLS LAST LIMIT 250""",
    "coerce_latency": w(ATTEMPTS) + """SELECT question_id,
        CASE WHEN ordinal % 13 > 4 THEN response_time WHEN ordinal % 13 = 4 THEN 1250.0 END AS response_time,
        ai_correct FROM attempts""",
    "attempt_label": w(ATTEMPTS) + """SELECT model, question_id,
        CASE WHEN status = 'error' THEN 'ERREUR' WHEN ai_correct THEN 'OK' ELSE 'FAUX' END AS label,
        coalesce(error, ai_answer) AS detail FROM attempts""",
    # ---------------------------------------------------------------- clean
    "question_id": w(BRONZE) + "SELECT ordinal, question_id FROM bq",
    "dedupe_items": w(BRONZE) + "SELECT ordinal, question_id, difficulty, source FROM items0",
    "duplicate_count": w(BRONZE) + """SELECT count(*) - count(DISTINCT question_id) AS duplicates, count(*) AS rows,
        count(DISTINCT question_id) AS distinct_items FROM bq""",
    "limit_items": w(*ITEMS_ALL) + "SELECT ordinal, question_id FROM items ORDER BY ordinal LIMIT 100",
    "html_decode": "SELECT page_id, " + dec("html") + " AS text FROM pages",
    "normalize_answer": w(BRONZE) + f"SELECT ordinal, {norm('correct_answer')} AS answer_key, {norm('question')} AS question_key FROM bronze0",
    "parse_distractors": w(BRONZE, clean_cte("(SELECT *, '' AS question_id FROM bronze0)", "pd")) + f"""SELECT ordinal, list_dialect,
        CASE WHEN list_dialect <> 'invalid' THEN CAST(len(answers) AS BIGINT) END AS n_answers,
        CASE WHEN list_dialect <> 'invalid' THEN {jlist('answers')} END AS answers_json,
        list_error,
        CASE WHEN list_dialect = 'literal' THEN {lit(K.MSG_LITERAL_WARNING)} END AS list_warning FROM pd""",
    "clean_items": w(*ITEMS_ALL) + """SELECT ordinal, question_id, question_clean, correct_answer_clean,
        incorrect_answers_clean, cleaning_warning, list_dialect, item_error FROM items""",
    "build_choices": w(*ITEMS_ALL) + f"SELECT ordinal, question_id, {jlist('choice_list')} AS choices FROM items",
    "build_prompt": w(*ITEMS_ALL) + f"SELECT ordinal, {PROMPT} AS prompt FROM items",
    "csv_roundtrip": w(BRONZE) + """SELECT ordinal, category, type, difficulty, question, correct_answer, incorrect_answers,
        source, category_id, fetched_at FROM bronze""",
    "bronze_defaults": w(BRONZE) + """SELECT ordinal, '' AS category, '' AS type, '' AS difficulty,
        sha256('[' || CAST(to_json('') AS VARCHAR) || ', ' || CAST(to_json(question) AS VARCHAR) || ', '
          || CAST(to_json(correct_answer) AS VARCHAR) || ', ' || CAST(to_json(incorrect_answers) AS VARCHAR) || ']') AS question_id
        FROM bronze""",
    # ---------------------------------------------------------------- grade
    "extract_reply": w(*ITEMS_ALL, responses_cte()) + """SELECT question_id, coalesce(json_valid(payload), false) AS valid_json,
        CAST(CASE WHEN json_valid(payload) THEN coalesce(json_array_length(payload, '$.choices'), 0) ELSE 0 END AS BIGINT) AS n_choices,
        CASE WHEN json_valid(payload) AND json_type(payload, '$.choices[0].message.content') = 'VARCHAR'
             THEN json_extract_string(payload, '$.choices[0].message.content') END AS content,
        CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.choices[0].finish_reason') END AS finish_reason
        FROM responses""",
    "grade_responses": w(*GRADED_ALL) + """SELECT ordinal, question_id, status, error, ai_answer, ai_correct, response_time,
        cleaning_warning FROM graded""",
    # offline echo scorer: each sendable item is answered with its first (keyed-shuffled) choice
    "score_batch": w(*ITEMS_ALL) + ECHOED,
    "iso_timestamps": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN epoch_us(ts) % 1000000 <> 0 THEN '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') ELSE '' END
        || '+00:00' AS fetched_at FROM events""",
    "silver_roundtrip": w(*GRADED_ALL) + """SELECT ordinal, question_id, model, status, error, ai_answer, ai_correct,
        response_time, temperature, max_tokens, prompt_version FROM graded""",
    "stg_attempts": w(ATTEMPTS) + """SELECT question_id, model, category, type, difficulty, status, error, ai_answer,
        ai_correct, response_time, prompt_version FROM attempts""",
    "gold_views": w(ATTEMPTS) + f"""SELECT g.*, r.error_rate_pct FROM
        (SELECT category, difficulty, {GOLD_AGG} FROM attempts WHERE status = 'success' GROUP BY category, difficulty) g
        LEFT JOIN (SELECT category, round(100.0 * CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 2)
          AS error_rate_pct FROM attempts GROUP BY category) r ON g.category IS NOT DISTINCT FROM r.category""",
    "report_on_silver": w(*REP) + f"""SELECT category, difficulty, {REPORT_AGG} FROM ok WHERE model = 'model_1'
        GROUP BY category, difficulty""",
    "detail_export": w(*REP) + """SELECT model, category, difficulty, question_clean, ai_answer, correct_answer_clean,
        ai_correct, response_time FROM ok WHERE NOT coalesce(ai_correct, false)""",
    "stream_incremental": w(*GRADED_ALL) + """SELECT ordinal, question_id, model, status, error, ai_answer, ai_correct,
        response_time, temperature, max_tokens, prompt_version FROM graded""",
    # ---------------------------------------------------------------- resume
    "checkpoint_compat": w(ATTEMPTS) + """, saved AS (
          SELECT 'mixed' AS saved, model, true AS same FROM attempts
          UNION ALL SELECT 'one model', model, true FROM attempts WHERE model = 'model_1'
          UNION ALL SELECT 'null parameter', model, ordinal % 50 <> 1 FROM attempts WHERE model = 'model_1'),
        total AS (SELECT saved, count(*) AS rows FROM saved GROUP BY saved),
        per AS (SELECT saved, model, count(*) FILTER (WHERE same) AS matching_rows FROM saved
                WHERE model IS NOT NULL GROUP BY saved, model)
        SELECT saved, model, rows, matching_rows, rows - matching_rows AS incompatible_rows,
          matching_rows = rows AS compatible FROM per JOIN total USING (saved)""",
    "resume_pending": w(*ITEMS_ALL) + """SELECT ordinal, question_id FROM items
        WHERE question_id NOT IN """ + HALF,
    "resume_bucketed": w(*ITEMS_ALL) + """SELECT ordinal, question_id FROM items
        WHERE question_id NOT IN """ + HALF,
    "gold_materialised": w(ATTEMPTS) + f"""SELECT category, difficulty, {GOLD_AGG}
        FROM attempts WHERE status = 'success' GROUP BY category, difficulty""",
    "gold_materialised_errors": w(ATTEMPTS) + """SELECT category, count(*) AS total_questions,
        CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS technical_errors,
        round(100.0 * CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 2) AS error_rate_pct
        FROM attempts GROUP BY category""",
    "latency_sketch": w(*REP) + """SELECT model, true AS within_error,
        count(*) FILTER (WHERE response_time IS NOT NULL AND NOT isnan(response_time)) AS rows FROM ok GROUP BY model""",
    "stream_dedupe": w(BRONZE) + "SELECT question_id, category, correct_answer FROM items0",
    "resume_retry": w(*GRADED_ALL) + """SELECT ordinal, question_id FROM items WHERE question_id NOT IN (
        SELECT question_id FROM graded WHERE status = 'success'
          AND question_id IN """ + HALF + ")",
    "resume_kept": w(*GRADED_ALL) + "SELECT ordinal, question_id, difficulty, status FROM graded WHERE item_error IS NULL",
    "resume_merge": w(*GRADED_ALL) + "SELECT ordinal, question_id, status, ai_correct FROM graded",
    "run_summary": w(*GRADED_ALL) + """SELECT count(*) AS processed, count(*) FILTER (WHERE status = 'success') AS valid,
        count(*) FILTER (WHERE status <> 'success') AS errors,
        count(*) FILTER (WHERE status = 'success' AND coalesce(ai_correct, false)) AS correct,
        count(*) FILTER (WHERE status = 'success' AND NOT coalesce(ai_correct, false)) AS wrong,
        round(100.0 * CAST(count(*) FILTER (WHERE status = 'success' AND coalesce(ai_correct, false)) AS DOUBLE)
          / count(*) FILTER (WHERE status = 'success'), 2) AS accuracy_pct,
        round(avg(response_time) FILTER (WHERE status = 'success') + 1e-9, 6) AS mean_time,
        round(quantile_cont(response_time, 0.5) FILTER (WHERE status = 'success'), 6) AS median_time FROM graded""",
    "resume_rounds": w(*ITEMS_ALL) + ECHOED,
    # ---------------------------------------------------------------- ingest
    "ingest_payload": w(BRONZE, PAGES, INGESTED) + "SELECT * FROM ingested",
    "ingest_categories": w(BRONZE) + "SELECT DISTINCT cat_no AS id, category AS name FROM bbase",
    "ingest_counts": w(BRONZE) + "SELECT cat_no AS category_id, count(*) AS total_question_count FROM bbase GROUP BY cat_no",
    "page_plan": """WITH c AS (SELECT l_returnflag AS category, count(*) AS total FROM lineitem GROUP BY 1),
        p AS (SELECT category, total, unnest(generate_series(0, (total - 1) // 50)) AS page FROM c WHERE total > 0)
        SELECT category, total, page, least(50, total - page * 50) AS amount FROM p""",
    "payload_disposition": w(BRONZE, PAGES) + """SELECT p.cat_no AS category_id, p.page_no, CAST(p.response_code AS INTEGER) AS response_code,
          CASE p.response_code WHEN 0 THEN 'accept' WHEN 5 THEN 'retry' ELSE 'fail' END AS strict_action,
          CASE WHEN p.page_no > fs.stop THEN 'skipped' WHEN p.response_code = 0 THEN 'accept'
               WHEN p.response_code = 5 THEN 'retry' ELSE 'stop' END AS loose_action
        FROM pgrc p LEFT JOIN fs USING (cat_no)""",
    "bronze_completeness": w(BRONZE, PAGES, INGESTED) + """, d AS (SELECT CAST(cat_no AS VARCHAR) AS category_id,
          count(*) AS declared FROM bbase GROUP BY 1),
        c AS (SELECT category_id, count(*) AS collected FROM ingested GROUP BY 1)
        SELECT coalesce(d.category_id, c.category_id) AS category_id, coalesce(declared, 0) AS declared,
          coalesce(collected, 0) AS collected, coalesce(declared, 0) - coalesce(collected, 0) AS missing
        FROM d FULL OUTER JOIN c ON d.category_id = c.category_id""",
    "retry_pages": w(BRONZE, RETRIES) + """SELECT cat_no AS category_id, page_no, CAST(attempts AS BIGINT) AS attempts,
          CASE WHEN refused AND attempts = 1 AND (page_no + 3 * cat_no) % 4 = 0 THEN NULL WHEN refused THEN 5 ELSE CAST(rc AS INTEGER) END AS response_code,
          CASE WHEN page_no > stop THEN 'skipped' WHEN refused THEN 'gave_up' WHEN ends THEN 'stop' ELSE 'accept' END AS action FROM rf""",
    "retry_ingest": w(BRONZE, RETRIES, RETRY_INGESTED) + "SELECT * FROM ingested",
    "retry_completeness": w(BRONZE, RETRIES, RETRY_INGESTED) + """, d AS (SELECT CAST(cat_no AS VARCHAR) AS category_id,
          count(*) AS declared FROM bbase GROUP BY 1),
        c AS (SELECT category_id, count(*) AS collected FROM ingested GROUP BY 1)
        SELECT coalesce(d.category_id, c.category_id) AS category_id, coalesce(declared, 0) AS declared,
          coalesce(collected, 0) AS collected, coalesce(declared, 0) - coalesce(collected, 0) AS missing
        FROM d FULL OUTER JOIN c ON d.category_id = c.category_id""",
}
