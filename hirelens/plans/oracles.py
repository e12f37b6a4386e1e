"""The same queries as SQL for DuckDB, for comparison on the same tables."""

from __future__ import annotations

from hirelens import fixed_values as V
from hirelens.functions.skills import fuzzy_choices
from hirelens.plans.queries import ALERT_WORDS
from hirelens.sources import bridge

# --- shared parts ------------------------------------------------------------------------------


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_MID = "(salary_min + salary_max) / 2"
_VIEWS = {
    **{name: bridge.oracle(name) for name in bridge.VIEWS},
    "prepared": f"""
        SELECT * REPLACE (coalesce(seniority, '{V.DEFAULT_SENIORITY}') AS seniority,
            coalesce(company, '{V.DEFAULT_COMPANY}') AS company,
            coalesce(location, '{V.DEFAULT_LOCATION}') AS location), {_MID} AS salary_mid
        FROM jobs""",
    "full_jobs": """
        SELECT j.*, lower(source) || ' role ' || job_id AS title,
            'https://example.com/jobs/' || job_id AS url, coalesce(s.skills, []) AS skills
        FROM jobs j LEFT JOIN (
            SELECT job_id, list_sort(list(skill)) AS skills FROM job_skills GROUP BY job_id) s USING (job_id)""",
    "full_prepared": f"""
        SELECT * REPLACE (coalesce(seniority, '{V.DEFAULT_SENIORITY}') AS seniority,
            coalesce(company, '{V.DEFAULT_COMPANY}') AS company,
            coalesce(location, '{V.DEFAULT_LOCATION}') AS location), array_to_string(skills, ', ') AS skill_text
        FROM full_jobs""",
    "main_slice": f"""
        SELECT * FROM prepared WHERE salary_mid IS NOT NULL AND coalesce(salary_currency, '{V.UNKNOWN_CURRENCY}') = (
            SELECT coalesce(salary_currency, '{V.UNKNOWN_CURRENCY}') AS c FROM prepared WHERE salary_mid IS NOT NULL
            GROUP BY c ORDER BY count(*) DESC, c LIMIT 1)""",
    "run_days": """
        SELECT CAST(ts AS DATE) AS day, CAST(date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS BIGINT) AS run_id,
            min(ts) AS started_at, max(ts) AS finished_at, count(*) AS fetched,
            count(*) FILTER (event_type = 'signup') AS new, count(*) FILTER (event_type = 'error') AS invalid
        FROM events GROUP BY ALL""",
    "run_table": """
        SELECT run_id, started_at, CASE WHEN dayofweek(day) <> 0 THEN finished_at END AS finished_at,
            CASE WHEN dayofweek(day) = 0 THEN 'running' WHEN invalid <= new THEN 'success'
                WHEN fetched > 0 THEN 'partial' ELSE 'failed' END AS status,
            CASE WHEN dayofweek(day) <> 0 THEN fetched ELSE 0 END AS records_fetched,
            CASE WHEN dayofweek(day) <> 0 THEN new ELSE 0 END AS records_new,
            CASE WHEN dayofweek(day) <> 0 THEN invalid ELSE 0 END AS records_invalid,
            CASE WHEN dayofweek(day) <> 0 AND invalid > new THEN 'more errors; than new' END AS errors
        FROM run_days""",
    "runs": "SELECT run_id, max(first_seen) AS snapshot_date FROM jobs GROUP BY run_id",
    "skill_snaps": """
        SELECT r.run_id, r.snapshot_date, s.skill, CAST(sum(s.n) AS BIGINT) AS job_count
        FROM runs r JOIN (SELECT run_id, skill, count(*) AS n FROM job_skills JOIN jobs USING (job_id) GROUP BY ALL) s
            ON s.run_id <= r.run_id GROUP BY ALL""",
    "market_snaps": f"""
        SELECT r.run_id, r.snapshot_date, count(*) AS total_jobs,
            CAST(count(*) FILTER (j.remote) AS BIGINT) AS remote_jobs, avg({_MID}) AS avg_salary
        FROM runs r JOIN jobs j ON j.run_id <= r.run_id GROUP BY ALL""",
    "trend": """
        SELECT run_id, skill, job_count, total_jobs, job_count * 100.0 / total_jobs AS share
        FROM skill_snaps JOIN market_snaps USING (run_id)""",
}
_NEEDS = {
    "prepared": ["jobs"],
    "full_jobs": ["jobs", "job_skills"],
    "full_prepared": ["full_jobs"],
    "main_slice": ["prepared"],
    "run_table": ["run_days"],
    "runs": ["jobs"],
    "skill_snaps": ["runs", "job_skills", "jobs"],
    "market_snaps": ["runs", "jobs"],
    "trend": ["skill_snaps", "market_snaps"],
}


def _with(views: str, sql: str, **more: str) -> str:
    """Prefix a statement with the views it reads, then with its own."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        add(name)
    parts = [f"{n} AS ({_VIEWS[n]})" for n in ordered] + [f"{n} AS ({s})" for n, s in more.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + sql


# --- cleaning expressions ------------------------------------------------------------------------


def _norm(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"


def _location(c: str) -> str:
    """Location rules over a normalised text."""
    commas = f"regexp_replace({c}, '\\s*,\\s*', ', ', 'g')"
    bare = f"nullif(regexp_replace({commas}, '^[ ,;.\\-]+|[ ,;.\\-]+$', '', 'g'), '')"
    core = "regexp_replace(w, '^[()\\[\\]]+|[()\\[\\]]+$', '', 'g')"
    acronyms = ", ".join(_q(a) for a in V.LOCATION_ACRONYMS)
    word = (
        f"CASE WHEN upper({core}) = lower({core}) THEN w "
        f"WHEN {core} = upper({core}) AND (length({core}) <= 3 OR {core} IN ({acronyms})) THEN w "
        f"WHEN {core} = upper({core}) OR {core} = lower({core}) "
        f"THEN replace(w, {core}, upper(left({core}, 1)) || lower(substr({core}, 2))) ELSE w END"
    )
    return f"array_to_string(list_transform(string_split({bare}, ' '), lambda w: {word}), ' ')"


def _date(c: str) -> str:
    """Date rules over a normalised text."""
    return (
        f"CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}($|[T ])') THEN try_cast(left({c}, 10) AS DATE) "
        f"ELSE CAST(coalesce(try_strptime({c}, '%B %d, %Y'), try_strptime({c}, '%b %d, %Y'), "
        f"try_strptime({c}, '%d %B %Y'), try_strptime({c}, '%d %b %Y'), try_strptime({c}, '%d/%m/%Y'), "
        f"try_strptime({c}, '%m/%d/%Y')) AS DATE) END"
    )


def _cut(c: str, n: int) -> str:
    return f"CASE WHEN length({c}) > {n} THEN rtrim(left({c}, {n - 1})) || '…' ELSE {c} END"


_CLEANED = f"""
    SELECT *, left(sha256(lower(source) || '|' || lower(title) || '|' || coalesce(lower(company), '') || '|' ||
        coalesce(lower(location), '') || '|' || coalesce(lower(url), '')), 16) AS job_id FROM (
      SELECT ordinal, coalesce({_norm('source')}, '{V.UNKNOWN_SOURCE}') AS source,
        {_cut(_norm('title'), V.MAX_TITLE_CHARS)} AS title, {_norm('company')} AS company,
        {_location(_norm('location'))} AS location, {_date(_norm('posted'))} AS posted_date,
        CASE WHEN regexp_matches({_norm('url')}, '(?i)^https?://') THEN {_norm('url')} END AS url,
        {_norm('description')} AS description
      FROM raw_postings) WHERE title IS NOT NULL"""
_UNIQUE = "SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ordinal) = 1"

# --- enrichment expressions ------------------------------------------------------------------------

_SEP = r"\s*(?:-|–|—|to)\s*"
_P1 = rf"([$€£])\s?({V.AMOUNT})\s?([kK])?{_SEP}(?:[$€£]\s?)?({V.AMOUNT})\s?([kK])?"
_P2 = rf"(?i)(\d{{2,3}})\s?([kK])?{_SEP}(\d{{2,3}})\s?([kK])\b\s*(USD|EUR|GBP|CAD|AUD)?"
_P3 = rf"([$€£])\s?({V.AMOUNT})\s?([kK])?"


def _salary(c: str) -> str:
    """Rows of {c}'s table with low, high, currency; all its texts hold one offer at most."""

    def num(group: str, k: str) -> str:
        value = f"CAST(replace({group}, ',', '') AS DOUBLE)"
        return f"CASE WHEN {k} <> '' THEN {value} * 1000 ELSE {value} END"

    def ok(lo: str, hi: str) -> str:
        return f"({lo} BETWEEN {V.MIN_SALARY} AND {V.MAX_SALARY} AND {hi} BETWEEN {V.MIN_SALARY} AND {V.MAX_SALARY})"

    def parts(pattern: str, names: str) -> str:
        return f"regexp_extract({c}, {_q(pattern)}, [{', '.join(_q(n) for n in names.split())}])"

    symbol = "CASE {0}.cur WHEN '$' THEN 'USD' WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' END"
    return f"""
      SELECT * EXCLUDE (p1, p2, p3, a1, b1, a2, b2, a3),
        CASE WHEN {ok('a1', 'b1')} THEN least(a1, b1) WHEN {ok('a2', 'b2')} THEN least(a2, b2)
          WHEN {ok('a3', 'a3')} THEN a3 END AS low,
        CASE WHEN {ok('a1', 'b1')} THEN greatest(a1, b1) WHEN {ok('a2', 'b2')} THEN greatest(a2, b2)
          WHEN {ok('a3', 'a3')} THEN a3 END AS high,
        CASE WHEN {ok('a1', 'b1')} THEN {symbol.format('p1')} WHEN {ok('a2', 'b2')} THEN nullif(upper(p2.code), '')
          WHEN {ok('a3', 'a3')} THEN {symbol.format('p3')} END AS currency
      FROM (SELECT *,
          CASE WHEN p1.cur <> '' THEN (CASE WHEN p1.hik <> '' AND p1.lok = '' AND {num('p1.lo', 'p1.lok')} < 1000
            THEN {num('p1.lo', 'p1.lok')} * 1000 ELSE {num('p1.lo', 'p1.lok')} END) END AS a1,
          CASE WHEN p1.cur <> '' THEN {num('p1.hi', 'p1.hik')} END AS b1,
          CASE WHEN p2.hik <> '' THEN {num('p2.lo', 'p2.hik')} END AS a2,
          CASE WHEN p2.hik <> '' THEN {num('p2.hi', 'p2.hik')} END AS b2,
          CASE WHEN p3.cur <> '' THEN {num('p3.lo', 'p3.lok')} END AS a3
        FROM (SELECT *, {parts(_P1, 'cur lo lok hi hik')} AS p1, {parts(_P2, 'lo lok hi hik code')} AS p2,
            {parts(_P3, 'cur lo lok')} AS p3 FROM {{source}}))"""


def _re2(pattern: str) -> str:
    """The pattern without the JVM's Unicode flag."""
    return pattern.replace("(?iU)", "(?i)")


def _remote(c: str) -> str:
    kept = f"regexp_replace({c}, {_q(_re2(V.REMOTE_NEGATIVE))}, ' ', 'g')"
    return f"regexp_matches({kept}, {_q(_re2(V.REMOTE_POSITIVE))})"


def _scope() -> str:
    return (
        "coalesce(title, '') || chr(10) || coalesce(location, '') || chr(10) || "
        f"left(coalesce(description, ''), {V.REMOTE_SCOPE_CHARS})"
    )


def _seniority(c: str) -> str:
    rules = " ".join(f"WHEN regexp_matches({c}, {_q(_re2(p))}) THEN '{name}'" for name, p in V.SENIORITY_RULES)
    return f"CASE {rules} END"


def _escape(word: str) -> str:
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in word)


def _skill_flag(names: list[str], c: str) -> str:
    choices = []
    for name in names:
        words = r"\s+".join(_escape(w) for w in name.split())
        if name in V.CASE_SENSITIVE_NAMES:
            choices.append(f"{words}|{words.upper()}")
        else:
            choices.append(f"(?i:{words})")
    pattern = rf"(^|[^A-Za-z0-9_+#.])(?:{'|'.join(choices)})($|[^A-Za-z0-9_+#.]|\.($|[^A-Za-z0-9]))"
    return f"regexp_matches({c}, {_q(pattern)})"


def _exact_skills(c: str) -> str:
    items = ", ".join(
        f"CASE WHEN {_skill_flag([skill, *more], c)} THEN {_q(skill)} END" for skill, more in V.TAXONOMY.items()
    )
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


_TEXT = "coalesce(title, '') || chr(10) || coalesce(description, '')"
_CHOICES = "SELECT * FROM (VALUES {}) t(rank, name, skill)".format(
    ", ".join(
        f"({i}, {_q(name)}, {_q(list(V.TAXONOMY)[at])})" for i, (name, at) in enumerate(fuzzy_choices(V.TAXONOMY).items())
    )
)


def _tokens(c: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({c}), '[a-z][a-z0-9]{{5,}}'))"


# Longest common subsequence: one list per letter of the token.
_LCS = """list_last(list_reduce(
    list_prepend(list_transform(range(0, length(name) + 1), lambda z: CAST(0 AS BIGINT)),
        list_transform(range(1, length(token) + 1), lambda i: [CAST(unicode(token[i]) AS BIGINT)])),
    lambda prev, letter: list_reduce(
        list_prepend([CAST(0 AS BIGINT)], list_transform(range(1, length(name) + 1),
            lambda j: [CASE WHEN unicode(name[j]) = letter[1] THEN prev[j] + 1 ELSE -1 END, prev[j + 1]])),
        lambda row, cell: list_append(row,
            CASE WHEN cell[1] > 0 THEN cell[1] ELSE greatest(list_last(row), cell[2]) END))))"""
_FUZZY = f"""
    SELECT token, name, skill, ratio FROM (
      SELECT token, rank, name, skill, 200.0 * {_LCS} / (length(token) + length(name)) AS ratio
      FROM tokens JOIN choices ON 100 * levenshtein(token, name) <= {100 - V.FUZZY_THRESHOLD} * (length(token) + length(name))
      WHERE token NOT IN (SELECT name FROM choices))
    WHERE ratio >= {V.FUZZY_THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY token ORDER BY ratio DESC, rank) = 1"""
_SKILL_ORDER = "[{}]".format(", ".join(_q(s) for s in V.TAXONOMY))


def _enriched(fuzzy: bool, source: str = "uniq") -> dict[str, str]:
    views = {"cleaned": _CLEANED, "uniq": _UNIQUE}
    exact = _exact_skills(_TEXT)
    if fuzzy:
        views["choices"] = _CHOICES
        views["words"] = f"SELECT job_id, unnest({_tokens(_TEXT)}) AS token FROM uniq"
        views["tokens"] = "SELECT DISTINCT token FROM words"
        views["near"] = _FUZZY
        views["extra"] = "SELECT job_id, list(DISTINCT skill) AS more FROM words JOIN near USING (token) GROUP BY job_id"
        views["tagged"] = f"""
            SELECT u.*, list_filter({_SKILL_ORDER}, lambda s: list_contains({exact}, s)
                OR coalesce(list_contains(more, s), false)) AS skills FROM uniq u LEFT JOIN extra USING (job_id)"""
        views["tagged"] = f"""
            SELECT * EXCLUDE (exact, more), list_filter({_SKILL_ORDER}, lambda s: list_contains(exact, s)
                OR coalesce(list_contains(more, s), false)) AS skills
            FROM (SELECT u.*, more, {exact} AS exact FROM uniq u LEFT JOIN extra USING (job_id))"""
    else:
        views["tagged"] = f"SELECT *, {exact} AS skills FROM {source}"
    views["rich"] = f"""
        SELECT *, {_remote(_scope())} AS remote, {_seniority('title')} AS seniority
        FROM ({_salary(_TEXT).replace('{source}', 'tagged')})"""
    return views


_GAZETTEER_LOCATION = "nullif(regexp_extract(left({t}, {n}), 'NATION_\\d+'), '')"

# --- alerts ----------------------------------------------------------------------------------------


def _alert_text() -> str:
    return (
        "lower(coalesce(title, '') || ' ' || coalesce(company, '') || ' ' || coalesce(location, '') || ' ' || "
        "array_to_string(skills, ' ') || ' ' || ' ' || CASE WHEN remote THEN 'remote' ELSE '' END)"
    )


_MATCH = " OR ".join(f"contains({_alert_text()}, {_q(w)})" for w in ALERT_WORDS)
_THOUSANDS = "CAST(CAST(round_even({} / 1000, 0) AS BIGINT) AS VARCHAR) || 'k'"
_LO, _HI = _THOUSANDS.format("salary_min"), _THOUSANDS.format("salary_max")
_SALARY_TEXT = (
    "CASE WHEN salary_min IS NULL OR salary_max IS NULL THEN '' "
    f"ELSE trim(coalesce(salary_currency, '') || ' ' || {{}}) END"
)
_RANGE_TEXT = _SALARY_TEXT.format(f"{_LO} || '–' || {_HI}")
_OFFER_TEXT = _SALARY_TEXT.format(f"CASE WHEN salary_min = salary_max THEN {_LO} ELSE {_LO} || '-' || {_HI} END")


def _alerts(min_new: int = 5) -> dict[str, str]:
    return {
        "matched": f"SELECT * FROM full_jobs WHERE {_MATCH}",
        "gate": f"""
            SELECT run_id, total_new, matching FROM (SELECT run_id, count(*) AS total_new FROM full_jobs GROUP BY 1)
            JOIN (SELECT run_id, count(*) AS matching FROM matched GROUP BY 1) USING (run_id)
            WHERE total_new >= {min_new}""",
        "ranked": f"""
            SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ordinal) AS position,
              concat_ws(' · ', company, location, CASE WHEN remote THEN 'Remote' END, nullif({_OFFER_TEXT}, '')) AS meta,
              concat_ws(' · ', company, CASE WHEN remote THEN 'Remote' ELSE location END,
                nullif({_OFFER_TEXT}, '')) AS brief
            FROM matched JOIN gate USING (run_id)""",
    }


# --- HTML --------------------------------------------------------------------------------------------


def _plain(c: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = f"replace({c}, {_q(name)}, {_q(char)})"
    return c


_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
_HOST = "regexp_extract(url, '://([^/]*)', 1)"
_HEADING = f"trim(regexp_replace({_plain('''regexp_extract(html, '<h1>([^<]*)</h1>', 1)''')}, '\\s+', ' ', 'g'))"
_CARDS = f"""
    SELECT page_id * 1000000 AS ordinal, '{V.LISTING_SOURCE}' AS source, {_HEADING} AS title,
      nullif({_plain("regexp_extract(html, '<li><a [^>]*>([^<]*)</a></li>', 1)")}, '') AS company,
      nullif(trim(regexp_replace({_plain('''regexp_extract(html, '<div class="ad">([^<]*)</div>', 1)''')},
        '\\s+', ' ', 'g')), '') AS location,
      {_ORIGIN} || list_last(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), 'href="([^"]*)"', 1)) AS url
    FROM pages"""

# --- comments ------------------------------------------------------------------------------------------

_HEADER = "string_split(split_part(description, '<p>', 1), ' | ')"
_POSTED_COMMENTS = f"""
    SELECT ordinal, '{V.COMMENT_SOURCE}' AS source, {_HEADER}[2] AS title, {_HEADER}[1] AS company,
      {_HEADER}[3] AS location, posted, '{V.COMMENT_URL_PREFIX}' || CAST(ordinal AS VARCHAR) AS url,
      replace(replace(description, '<p>', chr(10)), '&amp;', '&') AS description
    FROM raw_postings"""
_THREADS = """
    SELECT conv_id AS ordinal, CAST(conv_id AS VARCHAR) AS "objectID", 'Ask HN: Who is hiring?' AS title
    FROM conversations WHERE turn = 0 AND conv_id % 2 = 0 ORDER BY conv_id LIMIT 25"""
_REPLIES = """
    SELECT conv_id || '-' || turn AS "objectID",
      CASE WHEN turn = 1 THEN CAST(conv_id AS VARCHAR) ELSE conv_id || '-' || (turn - 1) END AS parent_id,
      text AS comment_text FROM conversations WHERE turn > 0"""

_RECORD_RULES = """
    SELECT ordinal, title, salary_text, ordinal % 31 = 0 AS no_remote, ordinal % 37 = 0 AS no_time FROM (
      SELECT ordinal, title, CASE WHEN ordinal % 5 = 0 THEN posted ELSE CAST(ordinal % 9 - 3 AS VARCHAR) END AS salary_text
      FROM raw_postings)"""
_VIOLATIONS = """list_filter([
    CASE WHEN trim(title) = '' THEN 'title_blank' END,
    CASE WHEN no_remote THEN 'remote_missing' END,
    CASE WHEN salary_text IS NOT NULL AND try_cast(salary_text AS DOUBLE) IS NULL THEN 'salary_min_not_number' END,
    CASE WHEN no_time THEN 'scraped_at_missing' END], lambda x: x IS NOT NULL)"""

_FOLD = """
    SELECT job_id, arg_min(title, place) AS title, arg_min(salary_min, place) AS salary_min,
      arg_min(run_id, place) AS run_id, CAST(arg_min(seen_on, place) AS VARCHAR) AS first_seen,
      CAST(arg_max(seen_on, place) AS VARCHAR) AS last_seen
    FROM (SELECT *, row(run_id, ordinal) AS place FROM {}) GROUP BY job_id"""
# In the newest run only the first sighting of a job counts.
_STEPPED = """
    SELECT * FROM observations WHERE run_id < (SELECT max(run_id) FROM observations)
    UNION ALL (SELECT * FROM observations WHERE run_id = (SELECT max(run_id) FROM observations)
      QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ordinal) = 1)"""

_UNICODE_SPACE = r"[\s\x0b\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_DOC_TEXT = f"nullif(trim(regexp_replace(regexp_replace(text, '{V.ZERO_WIDTH}', '', 'g'), '{_UNICODE_SPACE}+', ' ', 'g')), '')"
_DOC_TEXT = _DOC_TEXT.replace(
    V.ZERO_WIDTH, r"[\x{200b}\x{200c}\x{200d}\x{2060}\x{feff}]"
)


def oracles() -> dict[str, str]:
    out: dict[str, str] = {}

    # --- market analytics ---
    out["top_skills"] = _with(
        "job_skills", "SELECT skill, count(*) AS jobs FROM job_skills GROUP BY skill ORDER BY jobs DESC, skill LIMIT 15"
    )
    out["skill_rows"] = _with("jobs job_skills", "SELECT job_id, source, skill FROM jobs JOIN job_skills USING (job_id)")
    out["skill_list_from_text"] = _with(
        "full_jobs",
        "SELECT job_id, CAST(len(skills) AS BIGINT) AS n, array_to_string(skills, '|') AS skills FROM full_jobs",
    )
    for name, column in (("top_companies", "company"), ("top_locations", "location")):
        out[name] = _with(
            "prepared",
            f"SELECT {column}, count(*) AS jobs FROM prepared GROUP BY {column} ORDER BY jobs DESC, {column} LIMIT 10",
        )
    out["work_mode"] = _with(
        "prepared",
        f"SELECT CASE WHEN remote THEN '{V.REMOTE_LABEL}' ELSE '{V.ONSITE_LABEL}' END AS mode, count(*) AS jobs "
        "FROM prepared GROUP BY mode",
    )
    out["jobs_by_seniority"] = _with("prepared", "SELECT seniority, count(*) AS jobs FROM prepared GROUP BY seniority")
    out["weekly_postings"] = _with(
        "prepared",
        """SELECT CAST(CAST(week AS DATE) AS VARCHAR) AS week, coalesce(n, 0) AS jobs FROM
           (SELECT unnest(generate_series(min(w), max(w), INTERVAL 7 DAY)) AS week FROM weeks)
           LEFT JOIN (SELECT w AS week, n FROM weeks) USING (week)""",
        weeks="""SELECT date_trunc('week', posted_date) + INTERVAL 6 DAY AS w, count(*) AS n FROM prepared
                 WHERE posted_date IS NOT NULL GROUP BY w""",
    )
    out["kpis"] = _with(
        "prepared run_table",
        """SELECT total_jobs, new_today, round(share, 4) AS remote_share, round(mid, 4) AS median_salary,
           CAST(CAST(round_even(share, 0) AS BIGINT) AS VARCHAR) || '%' AS remote_text,
           '$' || format('{:,}', CAST(round_even(mid / 1000, 0) AS BIGINT)) || 'k' AS median_text,
           strftime((SELECT max(finished_at) FROM run_table), '%d %b %Y, %H:%M UTC') AS update_text
           FROM (SELECT count(*) AS total_jobs,
             count(*) FILTER (first_seen >= (SELECT max(first_seen) FROM prepared)) AS new_today,
             avg(CAST(remote AS INT)) * 100 AS share, median(salary_mid) AS mid FROM prepared)""",
    )
    out["currency_freq"] = _with(
        "prepared",
        f"SELECT coalesce(salary_currency, '{V.UNKNOWN_CURRENCY}') AS currency, count(*) AS jobs FROM prepared "
        "WHERE salary_mid IS NOT NULL GROUP BY currency",
    )
    out["salary_hist"] = _with(
        "main_slice",
        """SELECT bin, round(lo + (bin - 1) * (hi - lo) / 30, 4) AS from_salary,
           round(lo + bin * (hi - lo) / 30, 4) AS to_salary, count(*) AS jobs FROM
           (SELECT lo, hi, CAST(least(floor((salary_mid - lo) / (hi - lo) * 30) + 1, 30) AS BIGINT) AS bin
            FROM main_slice, (SELECT min(salary_mid) AS lo, max(salary_mid) AS hi FROM main_slice)) GROUP BY bin, lo, hi""",
    )
    out["salary_box"] = _with(
        "main_slice",
        """SELECT seniority, round(q[1], 4) AS q1, round(q[2], 4) AS median, round(q[3], 4) AS q3,
           round(min(salary_mid) FILTER (inside), 4) AS low_whisker, round(max(salary_mid) FILTER (inside), 4) AS high_whisker,
           count(*) FILTER (NOT inside) AS outliers, count(*) AS jobs FROM
           (SELECT *, salary_mid BETWEEN q[1] - 1.5 * (q[3] - q[1]) AND q[3] + 1.5 * (q[3] - q[1]) AS inside
            FROM main_slice JOIN quartiles USING (seniority)) GROUP BY seniority, q""",
        quartiles="SELECT seniority, quantile_cont(salary_mid, [0.25, 0.5, 0.75]) AS q FROM main_slice GROUP BY seniority",
    )
    out["salary_by_skill"] = _with(
        "main_slice job_skills",
        """SELECT skill, round(median(salary_mid), 4) AS median_salary, count(*) AS jobs
           FROM main_slice JOIN job_skills USING (job_id) GROUP BY skill HAVING count(*) >= 5
           ORDER BY median(salary_mid) DESC, skill LIMIT 15""",
    )
    cooccurrence = {
        "top": "SELECT skill FROM job_skills GROUP BY skill ORDER BY count(*) DESC, skill LIMIT 12",
        "kept": "SELECT job_id, skill FROM job_skills JOIN top USING (skill)",
        "pairs": """SELECT a.skill AS skill_a, b.skill AS skill_b, count(*) AS n FROM kept a
                    JOIN kept b ON a.job_id = b.job_id AND a.skill <> b.skill GROUP BY ALL""",
        "grid": """SELECT skill_a, skill_b, CASE WHEN skill_a <> skill_b THEN coalesce(n, 0) END AS jobs FROM
                   (SELECT a.skill AS skill_a, b.skill AS skill_b FROM top a, top b) LEFT JOIN pairs USING (skill_a, skill_b)""",
    }
    out["skill_cooccurrence"] = _with("job_skills", "SELECT * FROM grid", **cooccurrence)
    out["skill_cooccurrence_matrix"] = _with(
        "job_skills",
        "SELECT skill_a AS skill, {} FROM (SELECT *, row_number() OVER (PARTITION BY skill_a ORDER BY skill_b) AS i "
        "FROM grid) GROUP BY skill_a".format(
            ", ".join(f"max(jobs) FILTER (i = {i}) AS with_{i:02d}" for i in range(1, 13))
        ),
        **cooccurrence,
    )
    out["filter_jobs"] = _with(
        "full_prepared",
        f"""SELECT job_id, source, seniority, CAST(posted_date AS VARCHAR) AS posted_date, skill_text AS skills
            FROM full_prepared WHERE source IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
            AND seniority IN ('1-URGENT', '2-HIGH', '{V.DEFAULT_SENIORITY}') AND NOT remote
            AND list_has_any(skills, ['Brand#13', 'Brand#22', 'Brand#55'])
            AND (posted_date IS NULL OR posted_date BETWEEN DATE '1996-01-01' AND DATE '1999-06-30')""",
    )
    out["search_jobs"] = _with(
        "full_prepared",
        """SELECT job_id, title, company, location FROM full_prepared
           WHERE contains(lower(title || ' ' || company || ' ' || location || ' ' || skill_text), 'nation_1 brand#2')""",
    )
    out["search_jobs_indexed"] = out["search_jobs"]
    out["filter_domains"] = _with(
        "prepared job_skills",
        """SELECT DISTINCT 'source' AS domain, source AS option FROM prepared
           UNION ALL SELECT DISTINCT 'seniority', seniority FROM prepared
           UNION ALL SELECT DISTINCT 'skill', skill FROM job_skills
           UNION ALL SELECT 'posted_from', CAST(min(posted_date) AS VARCHAR) FROM prepared
           UNION ALL SELECT 'posted_to', CAST(max(posted_date) AS VARCHAR) FROM prepared""",
    )
    out["explorer"] = out["csv_export"] = _with(
        "full_prepared",
        f"""SELECT title, company, location, remote, seniority, {_RANGE_TEXT} AS salary, skill_text AS skills,
            CAST(posted_date AS VARCHAR) AS posted, source, url FROM full_prepared""",
    )
    # An empty text and a null are the same in CSV.
    out["csv_export"] = out["explorer"].replace(f"{_RANGE_TEXT} AS salary, skill_text AS skills",
                                                f"nullif({_RANGE_TEXT}, '') AS salary, nullif(skill_text, '') AS skills")
    out["any_from_source"] = _with(
        "jobs", "SELECT coalesce(max(CAST(source = 'BUILDING' AS INT)), 0) = 1 AS present FROM jobs"
    )

    # --- incremental tables ---
    out["jobs_upsert"] = _with("observations", _FOLD.format("observations"))
    out["jobs_upsert_step"] = _with("observations", _FOLD.format("stepped"), stepped=_STEPPED)
    out["new_jobs_per_run"] = _with(
        "observations",
        """SELECT run_id, count(*) AS records, count(*) FILTER (run_id = first) AS new,
           count(*) FILTER (run_id <> first) AS known
           FROM (SELECT DISTINCT job_id, run_id, min(run_id) OVER (PARTITION BY job_id) AS first FROM observations)
           GROUP BY run_id""",
    )
    out["newest_run_records"] = _with(
        "observations",
        """SELECT job_id, CASE WHEN first < run_id THEN 'known' ELSE 'new' END AS kind, title FROM
           (SELECT *, min(run_id) OVER (PARTITION BY job_id) AS first, max(run_id) OVER () AS newest FROM observations)
           WHERE run_id = newest QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ordinal) = 1""",
    )
    out["newest_run_indexed"] = out["newest_run_records"]
    out["skill_snapshots"] = _with(
        "skill_snaps", "SELECT run_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, skill, job_count FROM skill_snaps"
    )
    out["market_snapshots"] = _with(
        "market_snaps",
        "SELECT * REPLACE (CAST(snapshot_date AS VARCHAR) AS snapshot_date, round(avg_salary, 4) AS avg_salary) FROM market_snaps",
    )
    out["market_by_currency"] = _with(
        "jobs",
        f"SELECT salary_currency, count({_MID}) AS paid_jobs, round(avg({_MID}), 4) AS avg_salary FROM jobs GROUP BY 1",
    )
    out["skill_trend"] = _with("trend", "SELECT * REPLACE (round(share, 4) AS share) FROM trend")
    leaders = "SELECT run_id, skill, share FROM trend WHERE run_id = (SELECT max(run_id) FROM trend) ORDER BY share DESC, skill LIMIT 6"
    out["latest_run_top"] = _with(
        "trend", "SELECT run_id, skill, round(share, 4) AS share FROM leaders", leaders=leaders
    )
    out["trend_of_leaders"] = _with(
        "trend",
        "SELECT run_id, skill, round(share, 4) AS share FROM trend WHERE skill IN (SELECT skill FROM leaders)",
        leaders=leaders,
    )
    out["has_trend"] = _with("runs", "SELECT count(*) AS runs, count(*) >= 2 AS shown FROM runs")
    out["run_log"] = _with(
        "run_table",
        """SELECT run_id, status, records_fetched, records_new, records_invalid, errors,
           epoch_us(finished_at) - epoch_us(started_at) AS duration_us,
           CASE WHEN records_fetched > 0 OR errors IS NULL THEN 'ok' ELSE 'failed' END AS outcome FROM run_table""",
    )
    out["new_by_status"] = _with("run_table", "SELECT run_id, status, records_new FROM run_table")

    # --- cleaning ---
    out["normalize_text"] = _with(
        "raw_postings",
        "SELECT ordinal, {} FROM raw_postings".format(
            ", ".join(f"{_norm(c)} AS {c}" for c in ("title", "company", "description"))
        ),
    )
    out["normalize_documents"] = (
        f"SELECT doc_id, length(t) AS n, md5(t) AS digest FROM (SELECT doc_id, {_DOC_TEXT} AS t FROM documents)"
    )
    out["normalize_location"] = _with(
        "raw_postings", f"SELECT ordinal, {_location(_norm('location'))} AS location FROM raw_postings"
    )
    out["normalize_url"] = _with(
        "raw_postings",
        f"SELECT ordinal, CASE WHEN regexp_matches(url, '(?i)^https?://') THEN {_norm('url')} END AS url FROM raw_postings",
    )
    out["parse_dates"] = _with(
        "raw_postings", f"SELECT ordinal, posted, CAST({_date(_norm('posted'))} AS VARCHAR) AS posted_date FROM raw_postings"
    )
    out["truncate_titles"] = f"SELECT doc_id, {_cut('t', 60)} AS title FROM (SELECT doc_id, {_DOC_TEXT} AS t FROM documents)"
    cleaned = {"cleaned": _CLEANED, "uniq": _UNIQUE}
    out["job_ids"] = _with("raw_postings", "SELECT ordinal, job_id FROM cleaned", cleaned=_CLEANED)
    out["clean_dedup"] = _with(
        "raw_postings", "SELECT * REPLACE (CAST(posted_date AS VARCHAR) AS posted_date) FROM uniq", **cleaned
    )
    records = {"records": _RECORD_RULES}
    out["dq_violations"] = _with(
        "raw_postings",
        f"""SELECT ordinal, CASE WHEN len(v) = 0 THEN trim(title) ELSE title END AS title,
            CASE WHEN len(v) > 0 OR n > 0 THEN n END AS salary_min, array_to_string(v, ',') AS violations
            FROM (SELECT *, {_VIOLATIONS} AS v, try_cast(salary_text AS DOUBLE) AS n FROM records)""",
        **records,
    )
    out["dq_counts"] = _with(
        "raw_postings",
        f"SELECT rule, count(*) AS records FROM (SELECT unnest({_VIOLATIONS}) AS rule FROM records) GROUP BY rule",
        **records,
    )
    out["source_union"] = _with(
        "raw_postings",
        """SELECT source, count(*) AS records, count(location) AS located FROM
           (SELECT source, location FROM cards WHERE title <> '' UNION ALL SELECT source, location FROM feed
            UNION ALL SELECT source, location FROM raw_postings) GROUP BY source""",
        cards=_CARDS,
        feed=_POSTED_COMMENTS,
    )

    out["collect_sources"] = _with(
        "raw_postings",
        f"""SELECT 'rows' AS kind, '{V.COMMENT_SOURCE}' AS source, count(*) FILTER (ordinal % 9 <> 0) AS n FROM raw_postings
            UNION ALL SELECT 'parsed', '{V.COMMENT_SOURCE}', count(*) FILTER (ordinal % 9 <> 0) FROM raw_postings
            UNION ALL SELECT 'comments', '{V.COMMENT_SOURCE}', count(*) FROM raw_postings
            UNION ALL SELECT 'error', '{V.COMMENT_SOURCE}', count(*) FILTER (ordinal % 50 = 0) FROM raw_postings
            UNION ALL SELECT 'rows', 'src2', count(*) FILTER (source = 'src2') FROM raw_postings
            UNION ALL SELECT 'rows', '{V.LISTING_SOURCE}', count(*) FROM ({_CARDS}) WHERE title <> ''
            UNION ALL VALUES ('error', 'broken', 1), ('error', 'nowhere', 1)""",
    )

    # --- enrichment ---
    out["salary_extract"] = _with(
        "raw_postings",
        "SELECT ordinal, low, high, currency FROM ({})".format(_salary("description").replace("{source}", "raw_postings")),
    )
    out["remote_flag"] = _with("raw_postings", f"SELECT ordinal, {_remote(_scope())} AS remote FROM raw_postings")
    out["seniority"] = _with("raw_postings", f"SELECT ordinal, {_seniority('title')} AS seniority FROM raw_postings")
    out["skill_tags"] = _with(
        "raw_postings", f"SELECT ordinal, array_to_string({_exact_skills(_TEXT)}, '|') AS skills FROM raw_postings"
    )
    out["fuzzy_vocab"] = _with(
        "raw_postings",
        "SELECT * REPLACE (round(ratio, 4) AS ratio) FROM near",
        texts="""SELECT description AS t FROM raw_postings UNION ALL SELECT text FROM documents
                 UNION ALL SELECT text FROM conversations UNION ALL SELECT text FROM benchmark""",
        tokens=f"SELECT DISTINCT unnest({_tokens('t')}) AS token FROM texts",
        choices=_CHOICES,
        near=_FUZZY,
    )
    out["fuzzy_large_names"] = f"""
        WITH names AS (SELECT c_name AS name FROM customer UNION SELECT p_name FROM part),
        places AS (SELECT c_name AS n, CAST(o_orderkey % 17 + 1 AS INTEGER) AS i, o_orderkey % 4 AS kind
                   FROM orders JOIN customer ON o_custkey = c_custkey),
        tokens AS (SELECT DISTINCT substr(n, 1, i - 1) || CASE kind WHEN 0 THEN substr(n, i + 1)
            WHEN 1 THEN substr(n, i, 1) || substr(n, i) WHEN 2 THEN substr(n, i + 1, 1) || substr(n, i, 1) || substr(n, i + 2)
            ELSE 'x' || substr(n, i + 1) END AS token FROM places),
        pairs AS (SELECT token, name, levenshtein(token, name) AS d, length(token) - length(name) AS gap
                  FROM tokens, names WHERE abs(length(token) - length(name)) <= 2 AND levenshtein(token, name) <= 2),
        cut AS (SELECT *, list_transform(range(1, length(token) + 1), lambda k: substr(token, 1, k - 1) || substr(token, k + 1)) AS a,
                list_transform(range(1, length(name) + 1), lambda k: substr(name, 1, k - 1) || substr(name, k + 1)) AS b FROM pairs),
        rated AS (SELECT token, name, 100.0 * (length(token) + length(name) - CASE WHEN d = abs(gap) THEN d WHEN d = 1 THEN 2
                  WHEN gap = 0 AND list_has_any(a, b) THEN 2 ELSE 99 END) / (length(token) + length(name)) AS ratio FROM cut)
        SELECT token, name, round(ratio, 4) AS ratio FROM rated WHERE ratio >= {V.FUZZY_THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY token ORDER BY ratio DESC, name) = 1"""
    rich = _enriched(True)
    out["enriched"] = _with(
        "raw_postings",
        """SELECT job_id, title, seniority, remote, low AS salary_min, high AS salary_max, currency AS salary_currency,
           array_to_string(skills, '|') AS skills FROM rich""",
        **rich,
    )
    out["process_batch"] = _with(
        "raw_postings",
        """SELECT job_id, title, company, location, remote, low AS salary_min, high AS salary_max,
           CAST(posted_date AS VARCHAR) AS posted_date, CAST(len(skills) AS BIGINT) AS n_skills FROM rich""",
        **rich,
    )
    out["run_counters"] = _with(
        "raw_postings",
        """SELECT 'fetched' AS counter, count(*) AS n FROM raw_postings UNION ALL SELECT 'unique', count(*) FROM rich
           UNION ALL SELECT 'with_skills', count(*) FILTER (len(skills) > 0) FROM rich UNION ALL SELECT 'valid', count(*) FROM rich
           UNION ALL SELECT 'invalid', 0 UNION ALL SELECT 'new', count(*) FILTER (source <> 'src1') FROM rich""",
        **rich,
    )
    text = f"left({_TEXT}, {V.ENTITY_SCOPE_CHARS})"
    out["entity_fill"] = _with(
        "raw_postings",
        f"""SELECT ordinal, job_id,
            CASE WHEN ordinal % 3 <> 0 THEN company ELSE nullif(regexp_extract({text}, 'Customer#\\d+'), '') END AS company,
            coalesce(location, nullif(regexp_extract({text}, 'NATION_\\d+'), '')) AS location FROM uniq""",
        **cleaned,
    )

    # --- HTML and comments ---
    out["html_text"] = _with(
        "raw_postings",
        "SELECT ordinal, replace(replace(description, '<p>', chr(10)), '&amp;', '&') AS text FROM raw_postings",
    )
    out["page_headings"] = f"""
        SELECT page_id, CAST(0 AS BIGINT) AS seq, 'h1' AS tag, {_HEADING} AS text FROM pages WHERE contains(html, '<h1>')"""
    out["page_elements"] = """
        SELECT regexp_extract(e, '<([a-z0-9]+)', 1) AS tag, count(*) AS elements,
          count(*) FILTER (contains(e, ' class="')) AS with_class, count(*) FILTER (contains(e, ' href="')) AS with_href
        FROM (SELECT unnest(regexp_extract_all(html, '<[a-z][^>]*>')) AS e FROM pages) GROUP BY tag"""
    out["page_cards"] = f"SELECT * FROM ({_CARDS}) WHERE title <> ''"
    out["page_files"] = f"""
        SELECT ordinal, title, company, location, 'https://landed.example' || regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1) AS url
        FROM ({_CARDS}) WHERE title <> ''"""
    day = "strftime(DATE '2024-01-01' + CAST(ordinal // 1000000 % 60 AS INTEGER), '%Y-%m-%d')"
    out["card_dates"] = f"""
        SELECT ordinal, title, CASE ordinal // 1000000 % 4 WHEN 0 THEN {day} WHEN 1 THEN {day} WHEN 2 THEN 'on ' || {day} END AS posted
        FROM ({_CARDS}) WHERE title <> ''"""
    shown = "['é', 'é', 'é', '©', '½', '&nosuch;', '😀', '<b>', '≂̸']"
    out["html_entities"] = _with(
        "raw_postings", f"SELECT ordinal, 'a ' || {shown}[CAST(ordinal % 9 AS INTEGER) + 1] || ' & ' || company AS text FROM raw_postings")
    out["page_links"] = f"""
        SELECT page_id, CAST(unnest(range(0, len(l))) AS BIGINT) AS seq, {_ORIGIN} || unnest(l) AS link
        FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)"""
    path = "regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1)"
    out["url_allowed"] = f"""
        SELECT page_id, url, CASE WHEN starts_with({_HOST}, 'm.') THEN true
          WHEN starts_with({path}, '/en/1') THEN true WHEN starts_with({path}, '/en') THEN false
          WHEN starts_with({path}, '/de/2') THEN false ELSE true END AS allowed FROM pages"""
    out["url_allowed_many_rules"] = """
        WITH p AS (SELECT page_id, 'https://rules.example/' || array_to_string(string_split(url, '/')[-2:], '/') AS url FROM pages),
        r AS (SELECT o_orderkey AS ord, ['/en/', '/de/', '/fr/', '/es/'][o_custkey % 4 + 1] || (o_orderkey % 1000) AS prefix,
              o_orderkey % 3 = 0 AS allow FROM orders)
        SELECT page_id, url, coalesce(arg_min(allow, ord), true) AS allowed
        FROM p LEFT JOIN r ON starts_with(substr(url, 22), prefix) GROUP BY page_id, url"""
    out["header_split"] = _with(
        "raw_postings",
        f"SELECT ordinal, {_HEADER}[1] AS company, {_HEADER}[2] AS title, {_HEADER}[3] AS location FROM raw_postings",
    )
    out["comment_postings"] = _with("raw_postings", f"SELECT * FROM ({_POSTED_COMMENTS})")
    out["hiring_threads"] = _THREADS
    out["top_level_comments"] = _with(
        "",
        """SELECT r."objectID", parent_id, title AS thread_title, md5(comment_text) AS digest
           FROM replies r JOIN threads t ON r.parent_id = t."objectID" """,
        threads=_THREADS,
        replies=_REPLIES,
    )
    out["comment_hits"] = _with(
        "",
        """SELECT "objectID", parent_id, CAST(NULL AS VARCHAR) AS created_at, length(comment_text) AS n FROM replies""",
        replies=_REPLIES,
    )
    out["json_values"] = """
        SELECT event_type, CAST(sum(coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0)) AS BIGINT) AS total
        FROM events GROUP BY event_type"""

    # --- alerts ---
    out["alert_matches"] = _with("full_jobs", "SELECT run_id, job_id FROM matched", **_alerts())
    out["alert_gate"] = _with("full_jobs", "SELECT run_id, total_new, matching FROM gate", **_alerts())
    out["alert_digest"] = _with(
        "full_jobs",
        f"""SELECT run_id, position, job_id, title, url, meta, brief, array_to_string(skills[1:{V.DIGEST_SKILLS}], '|') AS skills,
            total_new, matching, greatest(matching - {V.DIGEST_ITEMS}, 0) AS more
            FROM ranked WHERE position <= {V.DIGEST_ITEMS}""",
        **_alerts(),
    )
    out["alert_messages"] = _with(
        "full_jobs",
        f"""SELECT run_id, left(total_new || ' new job(s), ' || matching || ' match your keywords' || chr(10) ||
            string_agg('• ' || title || ' - ' || brief, chr(10) ORDER BY position), {V.MESSAGE_CHARS}) AS message
            FROM ranked WHERE position <= {V.MESSAGE_ITEMS} GROUP BY run_id, total_new, matching""",
        **_alerts(1),
    )

    # --- sinks and streams ---
    plain = _enriched(False)
    out["csv_append"] = _with(
        "raw_postings",
        """SELECT job_id, source, title, nullif(array_to_string(skills, '; '), '') AS skills,
           CAST(posted_date AS VARCHAR) AS posted_date, CASE WHEN remote THEN 'True' ELSE 'False' END AS remote, '2026-01-01T00:00:00+00:00' AS scraped_at FROM rich""",
        **plain,
    )
    run_of = "CASE WHEN source = 'src1' THEN 1 ELSE 2 END"
    out["store_jobs"] = _with(
        "raw_postings",
        f"""SELECT job_id, CAST({run_of} AS BIGINT) AS run_id, source, '2026-01-0' || {run_of} AS first_seen,
            '2026-01-02' AS last_seen FROM uniq""",
        **cleaned,
    )
    day_of = "'2026-01-0' || CASE source WHEN 'src1' THEN {} WHEN 'src2' THEN {} ELSE {} END"
    out["store_base_delta"] = _with(
        "raw_postings",
        f"""SELECT job_id, CAST(CASE source WHEN 'src1' THEN 1 WHEN 'src2' THEN 2 ELSE 3 END AS BIGINT) AS run_id, source, title,
            {day_of.format(1, 2, 3)} AS first_seen, {day_of.format(4, 5, 3)} AS last_seen FROM uniq""",
        **cleaned,
    )
    out["store_snapshots"] = _with(
        "raw_postings",
        f"""SELECT CAST(r AS BIGINT) AS run_id, skill, count(*) AS job_count
            FROM (SELECT {run_of} AS first_run, unnest(skills) AS skill FROM tagged), (VALUES (1), (2)) t(r)
            WHERE first_run <= r GROUP BY r, skill""",
        **plain,
    )
    out["stream_weekly"] = """
        SELECT CAST(CAST(week AS DATE) AS VARCHAR) AS week, count(*) AS jobs FROM
        (SELECT date_trunc('week', ts) + INTERVAL 6 DAY AS week FROM events)
        WHERE week + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY week"""
    out["stream_weekly_filled"] = """
        WITH e AS (SELECT * FROM events WHERE week(ts) % 3 <> 0), w AS (SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS week FROM e),
        r AS (SELECT CAST(unnest(generate_series((SELECT min(week) FROM w), (SELECT max(week) FROM w), INTERVAL 7 DAY)) AS DATE) AS week)
        SELECT CAST(r.week AS VARCHAR) AS week, (SELECT count(*) FROM w WHERE w.week = r.week) AS jobs FROM r
        WHERE r.week + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM e)"""
    out["stream_dedup"] = "SELECT DISTINCT user_id, event_type FROM events"
    out["stream_ingest"] = _with(
        "raw_postings",
        """SELECT job_id, title, remote, low AS salary_min, array_to_string(skills, '|') AS skills,
           '2026-01-01' AS last_seen FROM rich""",
        **rich,
    )
    words = " OR ".join(f"contains(t, {_q(w)})" for w in V.ALERT_KEYWORDS)
    out["stream_alerts"] = _with(
        "raw_postings",
        f"""SELECT ordinal, job_id, title FROM (SELECT *, lower(title || ' ' || coalesce(company, '') || ' ' ||
            coalesce(location, '') || ' ' || array_to_string(skills, ' ') || ' ' || coalesce(description, '') || ' ' ||
            CASE WHEN remote THEN 'remote' ELSE '' END) AS t FROM rich) WHERE {words}""",
        **_enriched(False, "cleaned"),
    )
    text = """lower(title || ' ' || coalesce(company, '') || ' ' || coalesce(location, '') || ' ' ||
        array_to_string(skills, ' ') || ' ' || coalesce(description, '') || ' ' || CASE WHEN remote THEN 'remote' ELSE '' END)"""
    match = " OR ".join(f"contains({text}, {_q(w)})" for w in V.ALERT_KEYWORDS)
    out["stream_run_alerts"] = _with(
        "raw_postings",
        f"""SELECT job_id, title, total_new, count(*) OVER () AS matching
            FROM (SELECT *, count(*) OVER () AS total_new FROM rich) WHERE ({match}) AND total_new >= {V.MIN_NEW_RECORDS}""",
        **rich,
    )
    out["stream_run_log"] = _with(
        "raw_postings",
        """SELECT 'success' AS status, (SELECT count(*) FROM raw_postings) AS records_fetched, count(*) AS records_new,
           CAST(0 AS BIGINT) AS records_invalid FROM uniq""",
        **cleaned,
    )
    out["store_market"] = _with(
        "raw_postings",
        f"""SELECT CAST(r AS BIGINT) AS run_id, count(*) AS total_jobs, count(*) FILTER (remote) AS remote_jobs,
            count((low + high) / 2) AS paid_jobs
            FROM (SELECT *, {run_of} AS first_run FROM rich), (VALUES (1), (2)) t(r) WHERE first_run <= r GROUP BY r""",
        **plain,
    )
    out["store_gap"] = _with(
        "raw_postings", "SELECT CAST(2 AS BIGINT) AS run_id, count(*) AS total_jobs FROM uniq", **cleaned)
    out["store_stream_after_batch"] = _with(
        "raw_postings", "SELECT job_id, title, source, source = 'src1' AS in_first FROM uniq", **cleaned)
    out["alerts_stored"] = _with(
        "raw_postings",
        f"""SELECT CAST(run AS BIGINT) AS run_id, job_id, title, total_new, count(*) OVER (PARTITION BY run) AS matching
            FROM (SELECT *, {run_of} AS run, count(*) OVER (PARTITION BY {run_of}) AS total_new FROM rich)
            WHERE ({match}) AND total_new >= {V.MIN_NEW_RECORDS}""",
        **plain,
    )
    out["stream_metrics"] = (
        "SELECT count(*) AS records, count(*) FILTER (event_type = 'error') AS invalid FROM events"
    )
    out["stream_listener_metrics"] = """
        SELECT user_id % 2 AS half, event_id % 60 AS part, count(*) AS records, count(*) FILTER (event_type = 'error') AS errors
        FROM events GROUP BY ALL"""
    return out
