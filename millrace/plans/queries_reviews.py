"""Queries over diffs, replies and findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import expressions as ex
from millrace.operators import review as rv
from millrace.plans.registry import Registry
from millrace.plans.views import Tables

SCOPE = """CASE WHEN list_has_any(string_split(filename, '/'), ['reviews', 'reports']) THEN 'generated-artifact-directory'
WHEN NOT suffix(filename, '.py') THEN 'non-python-file'
WHEN starts_with(split_part(filename, '/', -1), 'test_') THEN 'test-file' END"""
NAME = "concat(replace(filename, '/', '_'), '.diff')"
# All lines with hunk and counters; the counters follow the definition of a unified diff
LINES = r"""raw AS (SELECT diff_id, unnest(string_split(patch, chr(10))) AS raw,
generate_subscripts(string_split(patch, chr(10)), 1) AS pos FROM v_reviews),
mk AS (SELECT *, raw LIKE '@@ -%' AS header, sum(CASE WHEN raw LIKE '@@ -%' THEN 1 ELSE 0 END)
OVER (PARTITION BY diff_id ORDER BY pos) AS hunk FROM raw),
st AS (SELECT *, max(CASE WHEN header THEN CAST(regexp_extract(raw, '-(\d+)', 1) AS BIGINT) END)
OVER (PARTITION BY diff_id, hunk) AS os, max(CASE WHEN header THEN CAST(regexp_extract(raw, '\+(\d+)', 1) AS BIGINT) END)
OVER (PARTITION BY diff_id, hunk) AS ns FROM mk),
kept AS (SELECT *, left(raw, 1) AS prefix FROM st WHERE hunk > 0 AND NOT header AND raw <> '' AND NOT raw LIKE '+++%'
AND NOT raw LIKE '---%'),
lines AS (SELECT diff_id, CAST(hunk AS BIGINT) AS hunk, pos, prefix, substr(raw, 2) AS text, CAST(CASE prefix WHEN '-' THEN os - 1 +
count(*) FILTER (WHERE prefix <> '+') OVER w ELSE ns - 1 + count(*) FILTER (WHERE prefix <> '-') OVER w END AS BIGINT) AS line
FROM kept WINDOW w AS (PARTITION BY diff_id, hunk ORDER BY pos))"""
SEVERITY = """CASE WHEN category = 'security' AND regexp_matches(lower(description),
'token|password|secret|credential|api key|hardcoded') THEN 'Critical' WHEN category = 'bugs' AND regexp_matches(
lower(description), 'division by zero|null pointer|crash|exception|index out of range') THEN 'Critical'
WHEN category IN ('security', 'bugs') THEN 'Warning' ELSE 'Suggestion' END"""
CONFIDENCE = """CASE WHEN regexp_matches(lower(description),
'password|token|secret|credential|api key|hardcoded|division by zero|eval|sql injection') THEN 'High'
WHEN category = 'quality' THEN 'Low' ELSE 'Medium' END"""
# Phrases of remarks that do not count
PHRASES = [
    "no issues found",
    "no quality issues found",
    "no security issues found",
    "no bugs found",
    "hardcoded environment variable",
    "missing a docstring",
    "code is empty",
    "file not opened in append mode",
    "can be improved",
    "better readability",
    "maintainability",
]
INVALID = f"regexp_matches(lower(description), '{'|'.join(PHRASES)}')"
SECRET_CASES = [("password", "Hardcoded password"), ("token", "Hardcoded API token"), ("secret", "Hardcoded secret"),
                ("api_key", "Hardcoded API key")]
SECRETS = "secrets AS (" + " UNION ALL ".join(
    f"""SELECT diff_id, pos, {i} AS rule, 'security' AS category, 'Critical' AS severity, '{d}' AS description,
    'Move secret to environment variables or a secrets manager.' AS recommendation, pos AS line, 'Medium' AS confidence
    FROM raw WHERE raw LIKE '+%' AND regexp_matches(lower(raw), '{w}\\s*=\\s*[''"].+[''"]')"""
    for i, (w, d) in enumerate(SECRET_CASES)
) + ")"
# Replies with usable JSON hold one security finding; the quality remark is vague
PARSED = f"""parsed AS (SELECT diff_id, filename, 0 AS position, 'security' AS category, 'Hardcoded password' AS description,
'No recommendation provided.' AS recommendation, CAST(replace(regexp_extract(raw_response, '"line":"[0-9]+"'), '"line":', '')
.replace('"', '') AS INT) AS line FROM v_reviews WHERE raw_response LIKE '%{{%')"""
EVIDENCE = """merged AS (SELECT diff_id, line, string_agg(text, chr(10) ORDER BY pos) AS t FROM lines GROUP BY diff_id, line),
judged AS (SELECT f.*, m.t, lower(trim(description)) AS s, lower(trim(m.t)) AS n, EXISTS (SELECT 1 FROM lines l
WHERE l.diff_id = f.diff_id AND l.line BETWEEN f.line - 2 AND f.line + 2 AND (lower(l.text) LIKE '%try:%'
OR lower(l.text) LIKE '%except%')) AS guarded FROM v_feedback f LEFT JOIN merged m ON m.diff_id = f.diff_id AND m.line = f.line),
verdict AS (SELECT diff_id, line, category, description, CASE WHEN t IS NULL OR t = '' OR line <= 0 OR regexp_matches(s,
'missing docstring|code can be improved|code could be improved|readability issue|maintainability concern|best practice|consider using|could be better|should be improved')
THEN 'No evidence found' WHEN
regexp_matches(s, 'password|passwd|passphrase|token|api_key|api key|secret|credential') AND regexp_matches(n,
'password|passwd|token|secret|credential|api_key|api key') AND regexp_matches(n, '=\\s*[''"].+[''"]') THEN NULL
WHEN regexp_matches(s, 'hardcoded|token|password|secret|credential') AND regexp_matches(n,
'(password|token|secret|credential)\\s*=\\s*[''"].+[''"]') THEN NULL
WHEN s LIKE '%api key%' AND regexp_matches(lower(t), '(api[_ ]?key)\\s*=\\s*[''"].+[''"]') THEN NULL
WHEN s LIKE '%eval%' AND n LIKE '%eval(%' THEN NULL
WHEN regexp_matches(s, 'division by zero|divide by zero') AND (regexp_matches(n, '(/|//|%)\\s*0\\b')
OR regexp_matches(n, '\\(\\s*[^,]+,\\s*0\\s*\\)')) THEN NULL
WHEN s LIKE '%sql injection%' AND regexp_matches(n, 'select|insert|update|delete|where|from|execute\\(')
AND (contains(n, 'f"') OR contains(n, 'f''') OR contains(n, ' + ') OR contains(n, 'format(') OR contains(n, '{'))
THEN NULL
WHEN regexp_matches(s, 'exception handling|try/except|try except') AND regexp_matches(lower(t),
'\\b(open|requests\\.[a-z_]+|client\\.get|subprocess\\.[a-z_]+|json\\.loads|pickle\\.load|yaml\\.load|execute\\()')
AND NOT guarded THEN NULL
WHEN regexp_matches(s, 'function name|parameter|variable name|too short') AND regexp_matches(t,
'def\\s+[a-z]{1,2}\\(') THEN NULL
ELSE 'No evidence found' END AS reason FROM judged)""".replace("\\\\", "\\")
IN_SCOPE = f"""scoped AS (SELECT diff_id, {NAME} AS filename FROM v_reviews WHERE patch <> '' AND {SCOPE} IS NULL)"""
REPORT = f"""{LINES}, {SECRETS.replace(chr(92) * 2, chr(92))}, {PARSED}, {IN_SCOPE},
allf AS (SELECT p.diff_id, 0 AS source, position, category, {SEVERITY} AS severity, description, recommendation,
line, s.filename, {CONFIDENCE} AS confidence FROM parsed p JOIN scoped s ON p.diff_id = s.diff_id
UNION ALL SELECT c.diff_id, 1, (pos - 1) * 4 + rule, category, severity, description, recommendation, line, s.filename,
confidence FROM secrets c JOIN scoped s ON c.diff_id = s.diff_id),
report AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY filename, line, lower(description)
ORDER BY diff_id, source, position) AS rn FROM allf) WHERE rn = 1)"""


def pulls(t: Tables) -> DataFrame:
    """Webhook payloads: every diff is the first file of its event; a second file has no patch."""
    action = F.when(F.col("diff_id") % 4 == 0, "opened").when(F.col("diff_id") % 4 == 1, "synchronize").otherwise("closed")
    login = F.concat(F.lit("user"), F.col("diff_id") % 50)
    payload = F.struct(
        action.alias("action"),
        F.struct(F.col("diff_id").alias("number"), F.struct(login.alias("login")).alias("user")).alias("pull_request"),
        F.struct(F.concat(F.lit("org/"), F.element_at(F.split("filename", "/"), 1)).alias("full_name")).alias("repository"),
    )
    files = F.array(
        F.struct("filename", F.lit("modified").alias("status"), "patch"),
        F.struct(F.lit("docs/logo.png").alias("filename"), F.lit("added").alias("status"), F.lit(None).cast("string").alias("patch")),
    )
    return t.reviews.select("diff_id", F.to_json(payload).alias("payload"), F.to_json(files).alias("files"))


PULLS = """pulls AS (SELECT diff_id, CASE diff_id % 4 WHEN 0 THEN 'opened' ELSE 'synchronize' END AS action,
concat('user', diff_id % 50) AS login, diff_id AS number, 'org' AS owner, split_part(filename, '/', 1) AS repo,
filename, patch FROM v_reviews WHERE diff_id % 4 < 2)"""


def two_files(t: Tables) -> DataFrame:
    """Events that bring two patches: their own and the next event's."""
    own = t.reviews.select("diff_id", F.lit("a.py").alias("filename"), "patch")
    return own.unionByName(t.reviews.select((F.col("diff_id") - 1).alias("diff_id"), F.lit("b.py").alias("filename"), "patch"))


def register(r: Registry) -> None:
    r.add("pr_scope", "P17", lambda t: rv.pr_scope(t.reviews.select("diff_id", "filename")),
          f"SELECT diff_id, filename, {SCOPE} AS scope_reason FROM v_reviews")
    r.add("diff_scope", "P18",
          lambda t: rv.diff_scope(rv.patch_name(t.reviews.select("diff_id", "filename"))),
          f"""SELECT diff_id, filename, d AS diff_name, r AS scope_reason, r IS NULL AND suffix(d, '.py.diff') AS reviewable
          FROM (SELECT *, CASE WHEN d LIKE '%reviews\\_%' ESCAPE '\\' THEN 'generated-artifact-diff'
          WHEN suffix(d, '.py.diff') AND contains(d, 'test_') THEN 'test-file' END AS r
          FROM (SELECT diff_id, filename, {NAME} AS d FROM v_reviews))""")
    r.add("patch_name", "P20", lambda t: rv.patch_name(t.reviews.select("diff_id", "filename")),
          f"SELECT diff_id, filename, {NAME} AS diff_name FROM v_reviews")
    r.add("pr_events", "P19", lambda t: rv.pr_events(pulls(t)).drop("payload", "files"),
          f"WITH {PULLS} SELECT diff_id, action, login, number, owner, repo FROM pulls")
    r.add("changed_files", "R10", lambda t: rv.changed_files(rv.pr_events(pulls(t)).select("diff_id", "files")),
          f"""WITH {PULLS} SELECT diff_id, filename, 'modified' AS status, patch FROM pulls
          UNION ALL SELECT diff_id, 'docs/logo.png', 'added', '' FROM pulls""")
    r.add("review_inputs", "P17,P18,P19,P20",
          lambda t: rv.review_inputs(rv.changed_files(rv.pr_events(pulls(t)).select("diff_id", "files"))).select("diff_id", "diff_name"),
          f"WITH {PULLS} SELECT diff_id, {NAME} AS diff_name FROM pulls WHERE patch <> '' AND {SCOPE} IS NULL")
    r.add("diff_lines", "R1", lambda t: rv.diff_lines(t.reviews).selectExpr("diff_id", "hunk", "pos + 1 AS pos", "line", "prefix", "text"),
          f"WITH {LINES} SELECT diff_id, hunk, pos, line, prefix, text FROM lines")
    secrets_sql = SECRETS.replace("\\\\", "\\")
    r.add("scan_secrets", "R2", lambda t: rv.scan_secrets(t.reviews).drop("pos"),
          f"WITH {LINES}, {secrets_sql} SELECT * EXCLUDE (pos) FROM secrets")
    r.add("scan_secrets_numbered", "R2",
          lambda t: rv.scan_secrets(t.reviews, number=True).select("diff_id", "line", "new_line", "description"),
          f"""WITH {LINES}, {secrets_sql} SELECT s.diff_id, s.line, l.line AS new_line, description FROM secrets s
          LEFT JOIN lines l ON l.diff_id = s.diff_id AND l.pos = s.pos""")
    r.add("scan_secrets_files", "R2", lambda t: rv.scan_secrets(two_files(t), number=True).select("diff_id", "filename", "line", "new_line", "description"),
          f"""WITH {LINES}, {secrets_sql}, found AS (SELECT s.diff_id, s.line, l.line AS new_line, description FROM secrets s
          LEFT JOIN lines l ON l.diff_id = s.diff_id AND l.pos = s.pos)
          SELECT diff_id, 'a.py' AS filename, line, new_line, description FROM found
          UNION ALL SELECT diff_id - 1, 'b.py', line, new_line, description FROM found""")
    r.add("normalize_reviews", "R3,F7,F8",
          lambda t: rv.normalize_reviews(t.reviews).select(
              "diff_id", F.size("bugs").alias("bugs"), F.size("security").alias("security"), F.size("quality").alias("quality"),
              F.get("security", F.lit(0))["line"].alias("line")),
          f"""WITH {PARSED} SELECT r.diff_id, 0 AS bugs, CASE WHEN p.line IS NULL THEN 0 ELSE 1 END AS security,
          CASE WHEN p.line IS NULL THEN 0 ELSE 1 END AS quality, CAST(p.line AS VARCHAR) AS line
          FROM v_reviews r LEFT JOIN parsed p ON p.diff_id = r.diff_id""")
    r.add("json_substring", "F8",
          lambda t: t.reviews.select("diff_id", ex.json_substring(F.col("raw_response")).alias("json")),
          r"""SELECT diff_id, CASE WHEN raw_response LIKE '%{%' THEN regexp_extract(raw_response, '(?s)\{.*\}') ELSE '{}' END
          AS json FROM v_reviews""")
    r.add("parse_findings", "R4,R5", lambda t: rv.parse_findings(t.reviews),
          f"WITH {PARSED} SELECT *, {SEVERITY} AS severity, {CONFIDENCE} AS confidence FROM parsed")
    r.add("rejected_findings", "R4",
          lambda t: rv.rejected_findings(t.reviews.withColumn(
              "raw_response", F.replace("raw_response", F.lit('"line":"'), F.lit('"line":"L')))).select(
              "diff_id", "description", "line_text", "reason"),
          f"WITH {PARSED} SELECT diff_id, description, concat('L', line) AS line_text, 'bad line' AS reason FROM parsed")
    r.add("valid_findings", "R5", lambda t: rv.valid_findings(t.feedback),
          f"SELECT * FROM v_feedback WHERE NOT {INVALID}")
    r.add("classify_severity", "R6", lambda t: rv.classify_severity(t.feedback), f"SELECT *, {SEVERITY} AS severity FROM v_feedback")
    r.add("classify_confidence", "R7", lambda t: rv.classify_confidence(t.feedback),
          f"SELECT *, {CONFIDENCE} AS confidence FROM v_feedback")
    r.add("evidence", "R8", lambda t: rv.evidence(t.feedback, t.reviews),
          f"WITH {LINES}, {EVIDENCE} SELECT * FROM verdict")
    r.add("review_report", "R9", lambda t: rv.review_report(t.reviews), f"WITH {REPORT} SELECT * FROM report")
    r.add("review_report_validated", "R8,R9", lambda t: rv.review_report(t.reviews, True).select("diff_id", "source", "line", "filename", "description"),
          f"""WITH {REPORT.replace("allf AS", '''ok AS (SELECT p.diff_id FROM parsed p JOIN lines l ON l.diff_id = p.diff_id
          AND l.line = p.line WHERE regexp_matches(lower(l.text), '(password|passwd|token|secret|credential|api_key|api key)')
          AND regexp_matches(lower(l.text), '=\\s*[''"].+[''"]')), allf AS''').replace("JOIN scoped s ON p.diff_id = s.diff_id",
          "JOIN scoped s ON p.diff_id = s.diff_id WHERE p.diff_id IN (SELECT diff_id FROM ok)")}
          SELECT diff_id, source, line, filename, description FROM report""")
    r.add("dedup_findings", "W7",
          lambda t: rv.dedup_findings(t.feedback.withColumn("filename", F.col("category")), ["diff_id"]),
          """SELECT * EXCLUDE (rn) FROM (SELECT *, category AS filename, row_number() OVER (PARTITION BY category, line,
          lower(description) ORDER BY diff_id) AS rn FROM v_feedback) WHERE rn = 1""")
    r.add("finding_counts", "A21", lambda t: rv.finding_counts(rv.review_report(t.reviews)),
          f"WITH {REPORT} " + " UNION ALL ".join(
              f"SELECT '{g}' AS grouping, {c} AS key, count(*) AS findings FROM report GROUP BY {c}"
              for g, c in [("severity", "severity"), ("category", "category"), ("file", "filename")]))
    classified = f"(SELECT *, {SEVERITY} AS severity, {CONFIDENCE} AS confidence FROM v_feedback)"
    r.add("finding_metrics", "A22", lambda t: rv.finding_metrics(rv.classify_confidence(rv.classify_severity(t.feedback))),
          f"""SELECT count(*) AS total_findings, count(*) FILTER (WHERE severity = 'Critical') AS critical_count,
          count(*) FILTER (WHERE severity = 'Warning') AS warning_count,
          count(*) FILTER (WHERE severity = 'Suggestion') AS suggestion_count,
          count(*) FILTER (WHERE confidence = 'High') AS high_confidence FROM {classified}""")
    r.add("report_summary", "A23", lambda t: rv.report_summary(t.feedback.withColumn("filename", F.col("line").cast("string"))),
          """SELECT count(DISTINCT line) AS files_reviewed, count(*) FILTER (WHERE category = 'bugs') AS bugs,
          count(*) FILTER (WHERE category = 'security') AS security, count(*) FILTER (WHERE category = 'quality') AS quality
          FROM v_feedback""")
    r.add("finding_texts", "F10",
          lambda t: rv.finding_texts(rv.parse_findings(t.reviews)).select("diff_id", "report_line", "pull_line", "comment"),
          f"""WITH {PARSED} SELECT diff_id, concat('- [Critical] [High Confidence] ', filename, ' ', description, ' (Line ', line, ')')
          AS report_line, concat('- **Critical** (High) ', description) AS pull_line, concat('File: ', filename, chr(10),
          repeat(' ', 12), 'Line: ', line, chr(10), chr(10), repeat(' ', 12), '[Critical] [High Confidence]', chr(10), chr(10),
          repeat(' ', 12), description, chr(10), chr(10), repeat(' ', 12), 'Recommendation:', chr(10), repeat(' ', 12),
          recommendation) AS comment FROM parsed""")
    r.add("pull_urls", "F9",
          lambda t: t.events.select("event_id", *ex.url_parts(F.format_string(
              "https://code.example.org/org%d/%s/pull/%d/files?w=1", "user_id", "event_type", "event_id"))),
          """SELECT event_id, concat('org', user_id) AS owner, event_type AS repo, CAST(event_id AS VARCHAR) AS number
          FROM events""")
