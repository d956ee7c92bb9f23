"""SQL counterparts of the registered queries, for a side-by-side check.

Written independently of the DataFrame code: the two share word lists, fixture
lists and limits, not logic. Dialect: DuckDB.
"""

from __future__ import annotations

import re

from jobsignals.fixed_values import (
    AI_MODEL_WORDS, BOOL_FEATURES, COMBO_FLAGS, COMPETITORS, FLAG_GROUPS, PAY_BAND_WORDS, PAY_FROM,
    PAY_PLUS, PAY_RANGE, PAY_SINGLE, ROLE_FALLBACK, ROLE_TERMS, ROLES, SALARY_TERMS, SKILLS,
    TRAIN_PERCENT,
)
from jobsignals.plans.derived import (
    BLOCK, EXTRAS, FORUM, PAY, PLACES, STACKS, STOP_WORDS, TITLES,
)


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


def _pick(values) -> str:
    return f"({_list(values)})[(k % {len(values)}) + 1]"


def _any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted(w)})" for w in words) + ")"


def _word(column: str, words) -> str:
    return f"regexp_matches({column}, {quoted(chr(92) + 'b(' + '|'.join(map(re.escape, words)) + ')' + chr(92) + 'b')})"


POSTINGS = f"""
fx0 AS (
  SELECT o_orderkey AS k, 'u' || o_custkey AS usr,
         strftime(o_orderdate, '%Y-%m-01') AS thread_date,
         concat_ws(' | ', 'Company ' || (o_custkey % 97), {_pick(TITLES)}, {_pick(PLACES)},
                   {_pick(PAY)}, {_pick(STACKS)}, {_pick(EXTRAS)}) AS body
  FROM (SELECT *, o_orderkey AS k FROM orders)),
fx1 AS (
  SELECT k, usr, thread_date,
         CASE WHEN k % 50 = 7 THEN '> quoted reply about ' || body
              WHEN k % 41 = 3 THEN 'Short' ELSE body END AS raw_text
  FROM fx0),
fx AS (
  SELECT CAST(k AS VARCHAR) AS id, * FROM fx1
  UNION ALL SELECT CAST(k AS VARCHAR), * FROM fx1 WHERE k % 30 = 0
  UNION ALL SELECT 'd' || k, * FROM fx1 WHERE k % 25 = 0)"""

KEPT = POSTINGS + """,
u1 AS (
  SELECT id, CAST(thread_date AS DATE) AS date, raw_text FROM fx
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY thread_date, raw_text) = 1),
u2 AS (
  SELECT * FROM u1
  QUALIFY row_number() OVER (PARTITION BY strftime(date, '%Y-%m'), raw_text ORDER BY id) = 1),
kept AS (
  SELECT *, lower(trim(raw_text)) AS low FROM u2
  WHERE length(raw_text) >= 50 AND NOT starts_with(trim(raw_text), '>'))"""

_RANGE, _FROM, _PLUS, _ONE = PAY_RANGE, PAY_FROM, PAY_PLUS, PAY_SINGLE


def _num(pattern: str, group: int = 1) -> str:
    return (f"TRY_CAST(replace(regexp_extract(t, {quoted(pattern)}, {group}), 'k', '000')"
            " AS BIGINT)")


SALARY = KEPT + f""",
s0 AS (SELECT *, replace(low, ',', '') AS t FROM kept),
s1 AS (
  SELECT *, {_num(_RANGE)} AS lo, {_num(_RANGE, 2)} AS hi,
         CASE WHEN regexp_matches(t, {quoted(_FROM)}) THEN {_num(_FROM)} ELSE {_num(_PLUS)} END
           AS st,
         {_num(_ONE)} AS one
  FROM s0),
s2 AS (
  SELECT *, CASE WHEN lo < 1000 AND hi > 1000 THEN lo * 1000 ELSE lo END AS lo2,
         CASE WHEN lo <> 0 AND hi <> 0 THEN 'range' WHEN st <> 0 THEN 'starting_at'
              WHEN one <> 0 THEN 'single' ELSE 'none' END AS pay_tier,
         CASE WHEN st <> 0 THEN st ELSE one END AS flat
  FROM s1),
s3 AS (
  SELECT *, CASE WHEN pay_tier = 'range' THEN lo2 WHEN pay_tier <> 'none' THEN flat END AS a,
         CASE WHEN pay_tier = 'range' THEN hi WHEN pay_tier <> 'none' THEN flat END AS b
  FROM s2),
s4 AS (
  SELECT *, CASE WHEN a < 200 THEN a * 2000 ELSE a END AS salary_min,
         CASE WHEN a < 200 THEN b * 2000 ELSE b END AS salary_max
  FROM s3),
pay AS (
  SELECT *, NULLIF((salary_min + salary_max) // 2, 0) AS salary_avg,
         CASE WHEN salary_min IS NULL THEN NULL
              WHEN contains(t, '£') OR contains(t, 'gbp') THEN 'GBP'
              WHEN contains(t, '€') OR contains(t, 'eur') THEN 'EUR' ELSE 'USD' END AS currency
  FROM s4)"""

_ROLE = ("CASE " + " ".join(f"WHEN {_any('low', words)} THEN {quoted(role)}"
                            for role, words in ROLES.items()) + " ELSE 'General' END")
_SKILLS = ("list_sort([x FOR x IN [" + ", ".join(
    f"CASE WHEN {_word('low', words)} THEN {quoted(skill)} END"
    for skill, words in SKILLS.items()) + "] IF x IS NOT NULL])")
_FLAG_SQL = {name: _any("low", words)
             for group in FLAG_GROUPS.values() for name, words in group.items()}
_FLAGS = ", ".join(f"{expr} AS {name}" for name, expr in _FLAG_SQL.items())

STRUCTURED = SALARY + f""",
p0 AS (
  SELECT *, {_SKILLS} AS stack, {_ROLE} AS job_category, contains(low, 'remote') AS is_remote,
         CASE WHEN contains(raw_text, '|') AND length(trim(split_part(raw_text, '|', 1))) < 50
              THEN trim(split_part(raw_text, '|', 1)) END AS company_name,
         CASE WHEN contains(raw_text, '|') THEN trim(split_part(raw_text, '|', 2)) END
           AS role_title,
         TRY_CAST(regexp_extract(low, '(\\d+)\\+?\\s*years?', 1) AS BIGINT) AS years_experience,
         {_FLAGS}
  FROM pay),
post AS (
  SELECT *, list_contains(stack, 'Python') AND {_any('low', AI_MODEL_WORDS)} AS tech_combo_ai,
         list_contains(stack, 'Rust') AND is_crypto AS tech_combo_blockchain
  FROM p0)"""

CLEAN = STRUCTURED + """,
c0 AS (
  SELECT * REPLACE (CASE WHEN salary_avg BETWEEN 2000 AND 15000 THEN salary_avg * 12
                         ELSE salary_avg END AS salary_avg,
                    CASE WHEN years_experience > 30 THEN 30 ELSE years_experience END
                      AS years_experience)
  FROM post),
clean AS (
  SELECT *, strftime(date, '%Y-%m') AS month FROM c0
  WHERE salary_avg IS NULL OR (salary_avg >= 15000 AND salary_avg <= 500000)),
tech AS (SELECT * FROM (SELECT id, date, month, salary_avg, unnest(stack) AS tech FROM clean)),
paid AS (SELECT * FROM tech WHERE salary_avg IS NOT NULL),
top AS (SELECT tech, count(*) AS n_posts FROM paid GROUP BY tech
        ORDER BY n_posts DESC, tech LIMIT 10)"""

_STRUCTURED_COLUMNS = (
    "id, date, raw_text, company_name, role_title, salary_min, salary_max, salary_avg, currency,"
    " is_remote, array_to_string(stack, ',') AS tech_stack, job_category, is_senior, is_junior,"
    " is_manager, years_experience, is_tier_1_city, is_europe, is_global_remote, is_yc,"
    " is_funded, is_crypto, has_equity, offers_visa, tech_combo_ai, tech_combo_blockchain")
_PROFILE_COLUMNS = [c.strip() for c in re.sub(
    r"array_to_string\(stack, ','\) AS ", "", _STRUCTURED_COLUMNS).split(",")]


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _summary(source: str, column: str, label: str) -> str:
    return f"""SELECT '{label}' AS "column", count({column}) AS count,
      round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS std,
      min({column}) AS min, quantile_cont({column}, 0.25) AS q25,
      quantile_cont({column}, 0.5) AS q50, quantile_cont({column}, 0.75) AS q75,
      max({column}) AS max FROM {source}"""


def _histogram(column: str, source: str, low: int, high: int, bins: int) -> str:
    return f"""SELECT CASE WHEN {column} < {low} THEN 0 WHEN {column} >= {high} THEN {bins + 1}
      ELSE CAST(floor({bins} * ({column} - {low})::DOUBLE / ({high} - {low})) AS BIGINT) + 1 END
      AS bin, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1"""


_PREVALENCE = " UNION ALL ".join(
    f"SELECT '{group}' AS feature_group, '{flag}' AS feature, count(*) FILTER ({flag}) AS n,"
    f" count(*) FILTER ({flag})::DOUBLE / count(*)::DOUBLE * 100 AS percentage FROM clean"
    for group, flags in [*((g, list(f)) for g, f in FLAG_GROUPS.items()), *COMBO_FLAGS.items()]
    for flag in flags)
_NON_NULL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS non_null,"
    f" count(*) - count({c}) AS nulls FROM structured" for c in _PROFILE_COLUMNS)
_LISTING = ("array_to_string([x FOR x IN [" + ", ".join(
    f"CASE WHEN {f} THEN '{f}' END" for f in [*_FLAG_SQL, *COMBO_FLAGS["Interactions"]])
    + "] IF x IS NOT NULL], ',')")
_TECH_COLUMNS = ", ".join(
    f"CAST(list_contains(stack, {quoted(t)}) AS INTEGER) AS "
    f"\"tech_{t.lower().replace(' ', '_').replace('.', '')}\""
    for t in SKILLS)
_BOOLS = ", ".join(f"CAST({b} AS INTEGER) AS {b}" for b in BOOL_FEATURES)
_BANDS = ", ".join(f"CAST({_word('lower(raw_text)', [w])} AS INTEGER) AS is_{w}"
                   for w in PAY_BAND_WORDS)



def _terms(token: str, k: int) -> str:
    """Words of all documents and their k most frequent terms."""
    stop = ", ".join(map(quoted, STOP_WORDS))
    return f"""docs AS (
          SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pM\\pN_]+') AS tokens
          FROM documents),
        words AS (
          SELECT * FROM (SELECT doc_id, unnest(tokens) AS term FROM docs)
          WHERE regexp_full_match(term, '{token}') AND term NOT IN ({stop})),
        total AS (SELECT count(*) AS n_docs FROM docs),
        top AS (
          SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df, n_docs,
                 ln((n_docs + 1)::DOUBLE / (count(DISTINCT doc_id) + 1)) + 1 AS idf
          FROM words, total GROUP BY term, n_docs ORDER BY tf DESC, term LIMIT {k})"""


def _hex_number(text: str, digits: int) -> str:
    return "(" + " + ".join(
        f"{16 ** (digits - 1 - i)} * (strpos('0123456789abcdef', substr({text}, {i + 1}, 1)) - 1)"
        for i in range(digits)) + ")"


TREND = """SELECT month, tech, tech_count, total_jobs,
  tech_count::DOUBLE / total_jobs::DOUBLE * 100 AS percentage
FROM (SELECT month, tech, count(id) AS tech_count FROM tech GROUP BY month, tech)
JOIN (SELECT month, count(id) AS total_jobs FROM clean GROUP BY month) USING (month)"""

MONTHS = """months AS (
  SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders),
threads AS (
  SELECT strftime(day, 't%Y%m') AS id,
         'Ask HN: Who is hiring? (' || strftime(day, '%B %Y') || ')' AS title,
         strftime(day, '%Y-%m-%d') AS thread_date, day FROM months)"""

COMMENTS = POSTINGS + f""",
blocks AS (SELECT DISTINCT strftime(CAST(thread_date AS DATE), 't%Y%m') AS page_key,
                  k // {BLOCK} AS block, thread_date FROM fx),
page AS (SELECT page_key, thread_date, count(*) OVER (PARTITION BY page_key) AS n_pages,
                row_number() OVER (PARTITION BY page_key ORDER BY block) - 1 AS page_no
         FROM blocks),
extra AS (SELECT *, page_key || '-' || page_no AS page FROM page),
comments AS (
  SELECT id, thread_date, raw_text, usr AS "user" FROM fx
  UNION ALL SELECT 'e-' || page, thread_date, '', 'e' FROM extra
  UNION ALL SELECT 'u-' || page, thread_date, 'no user', 'unknown' FROM extra
  UNION ALL SELECT 'p-' || page, thread_date, 'one' || chr(10) || 'two & three', 'p' FROM extra)"""
_COMMENT = f"SELECT id, thread_date, raw_text, \"user\", '{FORUM}/item?id=' || id AS url FROM comments"

REPORT = """cells AS (SELECT CAST(quality AS VARCHAR) AS a, CAST(toxic AS VARCHAR) AS p FROM labels),
classes AS (SELECT DISTINCT label FROM (SELECT a AS label FROM cells UNION ALL SELECT p FROM cells)),
sums AS (
  SELECT label, (SELECT count(*) FROM cells WHERE a = label) AS support,
         (SELECT count(*) FROM cells WHERE p = label) AS predicted,
         (SELECT count(*) FROM cells WHERE a = label AND p = label) AS hits FROM classes),
report AS (
  SELECT label, coalesce(hits::DOUBLE / NULLIF(predicted, 0), 0) AS precision,
         coalesce(hits::DOUBLE / NULLIF(support, 0), 0) AS recall,
         hits * 2::DOUBLE / (support + predicted) AS f1, support, hits FROM sums)"""

_AVERAGES = ", ".join(
    [f"round(avg({c}), 6) AS macro_{c}" for c in ("precision", "recall", "f1")]
    + [f"round(sum({c} * support) / sum(support), 6) AS weighted_{c}"
       for c in ("precision", "recall", "f1")])

CHECKS = {
    "sanitize_posts": _with(KEPT, "SELECT id, date, raw_text FROM kept"),
    "dedupe_documents_text": """SELECT doc_id, lang, n_chars FROM documents
        QUALIFY row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) = 1""",
    "long_documents": """SELECT doc_id, length(text) AS chars FROM documents
        WHERE length(text) >= 50
          AND NOT regexp_matches(text, '^[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\pZ]*>')""",
    "row_audit": _with(KEPT, """
        SELECT 0 AS step_no, 'input' AS step, count(*) AS n_rows FROM fx
        UNION ALL SELECT 1, 'id_dedupe', count(*) FROM u1
        UNION ALL SELECT 2, 'text_dedupe', count(*) FROM u2
        UNION ALL SELECT 3, 'length_filter', count(*) FROM u2 WHERE length(raw_text) >= 50
        UNION ALL SELECT 4, 'quote_filter', count(*) FROM kept"""),
    "sample_head": _with(KEPT, "SELECT id, date FROM kept ORDER BY id LIMIT 100"),
    "structured_posts": _with(STRUCTURED, f"SELECT {_STRUCTURED_COLUMNS} FROM post"),
    **{f"salary_{tier}": _with(SALARY, f"SELECT id, salary_min, salary_max, currency FROM pay"
                                       f" WHERE pay_tier = '{tier}'")
       for tier in ("range", "starting_at", "single")},
    "salary_waterfall": _with(
        SALARY, "SELECT id, salary_min, salary_max, salary_avg, currency, pay_tier FROM pay"),
    "skills": _with(STRUCTURED, "SELECT id, array_to_string(stack, ',') AS skills,"
                                " len(stack) AS n FROM post"),
    "role_category": _with(STRUCTURED, "SELECT id, job_category FROM post"),
    "company_and_title": _with(STRUCTURED, "SELECT id, company_name, role_title FROM post"),
    "experience_flags": _with(STRUCTURED, "SELECT id, is_senior, is_junior, is_manager,"
                                          " years_experience, is_remote FROM post"),
    "location_flags": _with(STRUCTURED, "SELECT id, is_tier_1_city, is_europe, is_global_remote"
                                        " FROM post"),
    "stage_flags": _with(STRUCTURED, "SELECT id, is_yc, is_funded, is_crypto FROM post"),
    "comp_flags": _with(STRUCTURED, "SELECT id, has_equity, offers_visa FROM post"),
    "combo_flags": _with(STRUCTURED, "SELECT id, tech_combo_ai, tech_combo_blockchain FROM post"),
    "document_signals": f"""SELECT doc_id, {_ROLE} AS job_category, {_FLAGS}
        FROM (SELECT doc_id, lower(text) AS low FROM documents)""",
    "salary_cleaned": _with(CLEAN, "SELECT id, salary_avg, years_experience FROM clean"),
    "cleaning_audit": _with(CLEAN, """
        SELECT count(*) AS n_rows,
          (SELECT count(*) FROM post WHERE salary_avg BETWEEN 2000 AND 15000) AS monthly_fixed,
          count(*) FILTER (c0.salary_avg < 15000) AS dropped_low,
          count(*) FILTER (c0.salary_avg > 500000) AS dropped_high,
          (SELECT count(*) FROM clean JOIN post USING (id)
           WHERE post.years_experience > 30) AS years_capped FROM c0"""),
    "numeric_summary": _with(CLEAN, " UNION ALL ".join([
        _summary("post", "salary_avg", "salary_avg"),
        _summary("clean", "salary_avg", "salary_clean"),
        _summary("clean", "years_experience", "years_experience")])),
    "feature_prevalence": _with(CLEAN, _PREVALENCE),
    "value_counts_nulls": _with(STRUCTURED, "SELECT currency, count(*) AS n FROM post"
                                            " GROUP BY currency"),
    "event_value_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "currency_top": _with(STRUCTURED, """SELECT currency, count(*) AS n FROM post
        WHERE currency IS NOT NULL GROUP BY currency ORDER BY n DESC, currency LIMIT 5"""),
    "top_tech_vocabulary": _with(STRUCTURED, """SELECT tech, count(*) AS n
        FROM (SELECT unnest(stack) AS tech FROM post) GROUP BY tech ORDER BY n DESC, tech
        LIMIT 50"""),
    "years_histogram": _with(CLEAN, """SELECT years_experience, count(*) AS n FROM clean
        WHERE years_experience IS NOT NULL GROUP BY years_experience"""),
    "salary_histogram": _with(CLEAN, _histogram("salary_avg", "clean", 0, 500000, 25)),
    "dataset_profile": _with(
        STRUCTURED + f", structured AS (SELECT {_STRUCTURED_COLUMNS} FROM post)", _NON_NULL),
    "sample_flag_listing": _with(STRUCTURED, f"""
        SELECT id, role_title, salary_avg, substr(raw_text, 1, 200) AS excerpt,
               {_LISTING} AS flags
        FROM post ORDER BY md5(id || '|42'), id LIMIT 5"""),
    "post_date_range": _with(POSTINGS, """SELECT min(thread_date) AS first_date,
        max(thread_date) AS last_date FROM fx"""),
    "tech_trend": _with(CLEAN, TREND),
    "tech_trend_joined": _with(CLEAN, TREND),
    "tech_trend_competitors": _with(
        CLEAN, f"{TREND} WHERE tech IN ({', '.join(map(quoted, COMPETITORS))})"),
    "remote_share": _with(CLEAN, """SELECT month, is_remote, count(*) AS count,
        count(*)::DOUBLE / (sum(count(*)) OVER (PARTITION BY month))::DOUBLE * 100 AS percentage
        FROM clean GROUP BY month, is_remote"""),
    "top_tech": _with(CLEAN, "SELECT tech, n_posts FROM top"),
    "top_tech_posts": _with(CLEAN, """SELECT id, tech, salary_avg FROM paid
        WHERE tech IN (SELECT tech FROM top)"""),
    "median_salary_by_tech": _with(CLEAN, """
        SELECT tech, n_posts, median(salary_avg) AS median_salary
        FROM paid JOIN top USING (tech) GROUP BY tech, n_posts"""),
    "box_stats_by_tech": _with(CLEAN + """,
        q AS (SELECT tech, quantile_cont(salary_avg, 0.25) AS q1, median(salary_avg) AS q2,
                     quantile_cont(salary_avg, 0.75) AS q3 FROM paid GROUP BY tech)""", """
        SELECT tech, n_posts, min(salary_avg) AS min_salary,
          min(salary_avg) FILTER (salary_avg >= q1 - (q3 - q1) * 1.5) AS lower_whisker,
          q1, q2 AS median_salary, q3,
          max(salary_avg) FILTER (salary_avg <= q3 + (q3 - q1) * 1.5) AS upper_whisker,
          max(salary_avg) AS max_salary
        FROM paid JOIN top USING (tech) JOIN q USING (tech) GROUP BY tech, n_posts, q1, q2, q3"""),
    "threads_pending": _with(MONTHS, f"""
        SELECT id, title, thread_date, '{FORUM}/item?id=' || id AS url FROM threads
        WHERE thread_date >= '1996-01-01' AND month(day) % 6 <> 0"""),
    "known_ids": _with(POSTINGS, """SELECT DISTINCT id FROM (
        SELECT id FROM fx UNION ALL SELECT CAST(doc_id AS VARCHAR) FROM documents)"""),
    "title_to_month": _with(MONTHS, """
        SELECT id, title, strftime(strptime(regexp_extract(title, '\\((.*)\\)', 1), '%B %Y'),
                                   '%Y-%m-%d') AS thread_date FROM threads
        UNION ALL SELECT id || 'w', replace(title, 'is hiring', 'wants to be hired'), NULL
        FROM threads"""),
    "parse_comment_pages": _with(COMMENTS, _COMMENT),
    "parse_thread_pages": _with(MONTHS, f"""
        SELECT id, title, thread_date, '{FORUM}/item?id=' || id AS url FROM threads"""),
    "page_navigation": _with(COMMENTS, """
        SELECT page_key, page_no, page_no + 1 < n_pages AS has_more,
          CASE WHEN page_no + 1 < n_pages THEN 'item?id=' || page_key || '&p=' || (page_no + 2) END
            AS next_href FROM page"""),
    "foreign_page_comments": """SELECT count(*) AS n FROM pages
        WHERE regexp_matches(html, '<tr [^>]*class="[^"]*athing comtr')""",
    "incremental_ingest": _with(COMMENTS, _COMMENT.replace("SELECT", "SELECT DISTINCT", 1)),
    "compacted_comments": _with(COMMENTS, _COMMENT.replace("SELECT", "SELECT DISTINCT", 1)),
    **{name: _with(COMMENTS, _COMMENT.replace("SELECT", "SELECT DISTINCT", 1) + """
        WHERE thread_date >= '1996-01-01'""") for name in ("batch_ingest",
                                                            "batch_ingest_pages_from_one")},
    "paybanding_flags": _with(KEPT, f"SELECT id, {_BANDS} FROM kept"),
    "tech_multihot": _with(STRUCTURED, f"SELECT id, {_TECH_COLUMNS} FROM post"),
    "ml_features": _with(STRUCTURED, f"""
        SELECT id, round(ln(1 + salary_avg), 6) AS log_salary, {_TECH_COLUMNS}, {_BOOLS},
               coalesce(years_experience, -1) AS years_experience, {_BANDS}
        FROM post WHERE salary_avg > 10000 AND salary_avg < 500000 AND currency = 'USD'"""),
    "tfidf_top_terms": _with(_terms("[a-z][a-z]+", SALARY_TERMS), """SELECT term, tf, df, n_docs,
        round(idf, 6) AS idf FROM top"""),
    **{name: _with(_terms(token, k) + """,
        cells AS (SELECT doc_id, term, count(*) * idf AS w FROM words JOIN top USING (term)
                  GROUP BY doc_id, term, idf)""", """
        SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight
        FROM cells""")
       for name, token, k in (("tfidf_weights", "[a-z][a-z]+", SALARY_TERMS),
                              ("tfidf_weights_roles", "[\\pL\\pM\\pN_]{2,}", ROLE_TERMS))},
    "train_split": _with(STRUCTURED, f"""SELECT id, {_hex_number("md5(id)", 4)} % 100
        < {TRAIN_PERCENT} AS in_training FROM post"""),
    "category_one_hot": _with(STRUCTURED, "SELECT id, " + ", ".join(
        f"(job_category = {quoted(c)})::INTEGER AS \"is_{c}\"" for c in (*ROLES, ROLE_FALLBACK))
        + " FROM post"),
    "row_audit_undated": _with(KEPT, """
        SELECT 0 AS step_no, 'input' AS step, count(*) AS n_rows FROM fx
        UNION ALL SELECT 1, 'id_dedupe', count(*) FROM u1
        UNION ALL SELECT 2, 'text_dedupe', count(*) FROM u1
        UNION ALL SELECT 3, 'length_filter', count(*) FROM u1 WHERE length(raw_text) >= 50
        UNION ALL SELECT 4, 'quote_filter', count(*) FROM u1
          WHERE length(raw_text) >= 50 AND NOT starts_with(trim(raw_text), '>')"""),
    "stored_months": _with(STRUCTURED, """SELECT strftime(date, '%Y-%m') AS month,
        count(*) AS n, min(date) AS first_date, max(salary_avg) AS top_salary FROM post
        GROUP BY 1"""),
    "stored_threads": _with(MONTHS, f"""
        SELECT id, title, thread_date, '{FORUM}/item?id=' || id AS url FROM threads"""),
    "merged_raw": _with(COMMENTS, _COMMENT.replace("SELECT id", """SELECT DISTINCT
        substr(thread_date, 1, 7) AS month, id""", 1)),
    "two_streams_ingest": _with(COMMENTS, _COMMENT.replace("SELECT", "SELECT DISTINCT", 1)),
    "label_confusion": """SELECT CAST(quality AS VARCHAR) AS actual,
        count(*) FILTER (toxic = 0) AS "0", count(*) FILTER (toxic = 1) AS "1"
        FROM labels GROUP BY quality""",
    "label_report": _with(REPORT, """SELECT label, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1, 6) AS f1, support, hits FROM report"""),
    "label_report_averages": _with(REPORT, f"""
        SELECT round(sum(hits) / sum(support), 6) AS accuracy, {_AVERAGES},
               CAST(sum(support) AS BIGINT) AS support FROM report"""),
    "pay_spread_metrics": _with(STRUCTURED, """SELECT count(*) AS n_rows,
        round(avg(abs(salary_max - salary_min)), 4) AS mae,
        round(1 - avg((salary_max - salary_min)::DOUBLE * (salary_max - salary_min))
                / var_pop(salary_max), 4) AS r2
        FROM post WHERE salary_max IS NOT NULL"""),
}
