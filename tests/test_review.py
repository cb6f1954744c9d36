import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import review as rv

PATCH = "\n".join([
    "diff --git a/x b/x", "--- a/x", "+++ b/x", "+before any hunk", "@@ -10,4 +20,5 @@ def f():", " import os", "-old = 1", "+new = 1", "",
    "+++ not counted", "odd line", "\\ No newline", "-gone", "@@ -40 +50 @@", "+tail"])


def test_pr_scope(frame):
    want = {
        "app/a.py": None, "reviews/a.py": "generated-artifact-directory", "x/reports/y/a.py": "generated-artifact-directory",
        "app/a.md": "non-python-file", "app/.py": "non-python-file", "app/test_a.py": "test-file", "app/a_test_.py": None, "test_dir/a.py": None}
    got = {r[0]: r[1] for r in rv.pr_scope(frame([(k,) for k in want], "filename string")).collect()}
    assert got == want


def test_diff_scope(frame):
    want = {
        "reviews/a.py.diff": (None, True), "a.diff.diff": ("generated-artifact-diff", False), "reviews_a.py.diff": ("generated-artifact-diff", False),
        "a_test_b.py.diff": ("test-file", False), "a.md.diff": (None, False), "a.py": ("not-a-diff", False), "test_a.md.diff": (None, False)}
    got = {r[0]: (r[1], r[2]) for r in rv.diff_scope(frame([(k,) for k in want], "diff_name string")).collect()}
    assert got == want


def test_diff_line_numbers(frame):
    got = [(r["hunk"], r["line"], r["prefix"], r["text"]) for r in rv.diff_lines(frame([(1, PATCH), (2, ""), (3, None)], "diff_id int, patch string")).orderBy("pos").collect()]
    assert got == [
        (1, 20, " ", "import os"), (1, 11, "-", "old = 1"), (1, 21, "+", "new = 1"), (1, 22, "", "odd line"), (1, 23, "", "\\ No newline"),
        (1, 14, "-", "gone"), (2, 50, "+", "tail")]


def test_diff_lines_with_other_line_ends(frame):
    df = frame([(1, "@@ -1 +1 @@\r\n+a\r\n b\r")], "diff_id int, patch string")
    assert [(r["line"], r["text"]) for r in rv.diff_lines(df).orderBy("pos").collect()] == [(1, "a"), (2, "b")]


def test_secrets(frame):
    patch = '@@ -1 +5 @@\n+PASSWORD = "a" # token="b"\n password = "c"\n+++ secret = \'x\'\n+api_key="" \n+Api_Key = \'k\''
    got = rv.scan_secrets(frame([(1, patch)], "diff_id int, patch string"), number=True).orderBy("line", "rule").collect()
    assert [(r["line"], r["description"], r["new_line"]) for r in got] == [
        (2, "Hardcoded password", 5), (2, "Hardcoded API token", 5), (4, "Hardcoded secret", None), (6, "Hardcoded API key", 8)]
    assert {(r["category"], r["severity"], r["confidence"]) for r in got} == {("security", "Critical", "Medium")}
    assert rv.scan_secrets(frame([(1, patch)], "diff_id int, patch string")).count() == 4


REPLIES = [
    ("fenced", '```json\n{"bugs":[{"description":"Division by zero in f","line":3}],"quality":[{"message":"x","line_number":"7","recommendation":"do"}]}\n``` bye'),
    ("order", '{"quality":[{"description":"q"}],"security":[{"description":"SQL injection"}],"bugs":[{"description":"b","line":"bad"}]}'),
    ("list", "[]"), ("empty", "{}"), ("broken", "{ nope }"), ("text", "no json"), ("vague", '{"bugs":[{"description":"No Bugs Found"},{"description":"CAN BE IMPROVED"}]}')]


def test_parse_findings(frame):
    df = frame([(n, "f", t) for n, t in REPLIES], "diff_id string, filename string, raw_response string")
    got = [(r["diff_id"], r["position"], r["category"], r["severity"], r["confidence"], r["line"], r["recommendation"]) for r in rv.parse_findings(df).orderBy("diff_id", "position").collect()]
    assert got == [
        ("fenced", 0, "bugs", "Critical", "High", 3, rv.NO_ADVICE), ("fenced", 1, "quality", "Suggestion", "Low", 7, "do"),
        ("order", 1, "security", "Warning", "High", 0, rv.NO_ADVICE), ("order", 2, "quality", "Suggestion", "Low", 0, rv.NO_ADVICE)]
    assert [(r["diff_id"], r["line_text"], r["reason"]) for r in rv.rejected_findings(df).collect()] == [("order", "bad", "bad line")]


EVIDENCE = [
    # description, line text, confirmed
    ("Hardcoded password", '+password = "x"', True),
    ("Passphrase leaked", "+my_token = 'x'", True),
    ("Hardcoded value", '+user_secret = "x"', True),
    ("Hardcoded value", '+user = "x"', False),
    ("API key in code", '+API KEY = "x"', True),
    ("use of EVAL", "+  Eval(q)", True),
    ("Divide by zero", "+a %0", True),
    ("Division by zero", "+div(a, 0 )", True),
    ("Division by zero", "+a / 05", False),
    ("SQL injection", '+q = f"select {x}"', True),
    ("SQL injection", '+q = "select 1"', False),
    ("Missing exception handling", "+x = open(p)", True),
    ("Missing exception handling", "+x = reopened(p)", False),
    ("Function name too short", "+def ab(x):", True),
    ("Function name too short", "+def abc(x):", False),
    ("Consider using password store", '+password = "x"', False),
    ("  ", '+password = "x"', False),
]


@pytest.mark.parametrize("near,guarded", [("", False), (" try:", True), (" except E:", True)])
def test_evidence_rules(frame, near, guarded):
    diffs = [(i, f"@@ -1 +1 @@\n{near or ' pass'}\n pass\n{text}\n pass") for i, (_, text, _) in enumerate(EVIDENCE)]
    found = [(i, said, 3) for i, (said, _, _) in enumerate(EVIDENCE)]
    got = rv.evidence(frame(found, "diff_id int, description string, line int"), frame(diffs, "diff_id int, patch string"))
    verdicts = {r["diff_id"]: r["reason"] is None for r in got.collect()}
    want = {i: ok and not (guarded and "exception" in said) for i, (said, _, ok) in enumerate(EVIDENCE)}
    assert verdicts == want


def test_evidence_needs_the_line(frame):
    diffs = frame([(1, '@@ -1 +1 @@\n+\n+password = "x"\n@@ -9 +2 @@\n+more')], "diff_id int, patch string")
    lines = [(1, "Hardcoded password", n) for n in (-1, 0, 1, 2, 7)]
    got = rv.evidence(frame(lines, "diff_id int, description string, line int"), diffs)
    assert {r["line"]: r["reason"] for r in got.collect()} == {-1: rv.NO_EVIDENCE, 0: rv.NO_EVIDENCE, 1: rv.NO_EVIDENCE, 2: None, 7: rv.NO_EVIDENCE}
    texts = {r["line"]: r["line_text"] for r in rv.line_texts(diffs).collect()}
    assert texts == {1: "", 2: 'password = "x"\nmore'}


def test_dedup_ignores_case_and_keeps_the_first(frame):
    df = frame([(1, "f", 3, "Bad"), (2, "f", 3, "bad"), (3, "f", 4, "bad"), (4, "g", 3, "bad")], "o int, filename string, line int, description string")
    assert sorted(r["o"] for r in rv.dedup_findings(df, ["o"]).collect()) == [1, 3, 4]


def test_report_and_counts(frame):
    reply = json.dumps({"security": [{"description": "Hardcoded password", "line": 4}], "bugs": [{"description": "Crash", "line": 99}]})
    patch = '@@ -1 +4 @@\n+password = "x"'
    rows = [(1, "app/a.py", patch, reply), (2, "app/a.py", patch, reply), (3, "app/a.md", patch, reply), (4, "app/b.py", "", reply), (5, "reviews/c.py", patch, reply)]
    df = frame(rows, "diff_id int, filename string, patch string, raw_response string")
    report = rv.review_report(df)
    assert sorted((r["diff_id"], r["source"], r["line"], r["description"]) for r in report.collect()) == [
        (1, 0, 4, "Hardcoded password"), (1, 0, 99, "Crash"), (1, 1, 2, "Hardcoded password")]
    assert rv.review_report(df, validate_evidence=True).count() == 2
    counts = {(r["grouping"], r["key"]): r["findings"] for r in rv.finding_counts(report).collect()}
    assert counts == {("severity", "Critical"): 3, ("category", "security"): 2, ("category", "bugs"): 1, ("file", "app_a.py.diff"): 3}
    assert rv.finding_metrics(report).first().asDict() == {"total_findings": 3, "critical_count": 3, "warning_count": 0, "suggestion_count": 0, "high_confidence": 1}
    assert rv.report_summary(report).first().asDict() == {"files_reviewed": 1, "bugs": 1, "security": 2, "quality": 0}


def test_events_and_files(frame):
    def payload(action, name="own/rep"):
        return json.dumps({"action": action, "pull_request": {"number": 5, "user": {"login": "u"}}, "repository": {"full_name": name}})

    files = json.dumps([{"filename": "a.py", "status": "added", "patch": "p"}, {"filename": "b.png", "status": "added"}])
    df = frame([(1, payload("opened"), files), (2, payload("closed"), files), (3, "junk", files)], "diff_id int, payload string, files string")
    got = rv.pr_events(df).collect()
    assert [(r["diff_id"], r["action"], r["login"], r["number"], r["owner"], r["repo"]) for r in got] == [(1, "opened", "u", 5, "own", "rep")]
    assert [(r["filename"], r["patch"]) for r in rv.changed_files(rv.pr_events(df).select("diff_id", "files")).collect()] == [("a.py", "p"), ("b.png", "")]


def test_texts(frame):
    df = frame([("High", "Critical", "f.py", "d", 3, "r")], "confidence string, severity string, filename string, description string, line int, recommendation string")
    row = rv.finding_texts(df).first()
    assert row["report_line"] == "- [Critical] [High Confidence] f.py d (Line 3)"
    assert row["pull_line"] == "- **Critical** (High) d"
    assert row["comment"].split() == "File: f.py Line: 3 [Critical] [High Confidence] d Recommendation: r".split()


def test_files_of_one_event_are_numbered_apart(frame):
    patch = lambda start, *lines: "\n".join([f"@@ -{start},2 +{start},2 @@", *[f"+{x}" for x in lines]])
    diffs = frame([(1, "a.py", patch(1, "x = 1", "y = eval(q)")), (1, "b.py", patch(50, "z = 2", "w = 3"))], "diff_id int, filename string, patch string")
    got = sorted((r["filename"], r["line"], r["text"]) for r in rv.diff_lines(diffs).collect())
    assert got == [("a.py", 1, "x = 1"), ("a.py", 2, "y = eval(q)"), ("b.py", 50, "z = 2"), ("b.py", 51, "w = 3")]
    found = frame([(1, "a.py", "uses eval on input", 2), (1, "b.py", "uses eval on input", 51)], "diff_id int, filename string, description string, line int")
    assert {r["filename"]: r["reason"] is None for r in rv.evidence(found, diffs).collect()} == {"a.py": True, "b.py": False}


def test_tasks_have_bounded_patches(spark, monkeypatch):
    monkeypatch.setattr(rv, "PATCH_BYTES", 100)
    diffs = spark.range(300).selectExpr("id AS diff_id", "'@@ -1 +1 @@\\n+token = \"a\"' AS patch")
    held = diffs.selectExpr("sum(octet_length(patch))").first()[0]
    for lines in (rv.diff_lines(diffs), rv.scan_secrets(diffs, number=True)):
        assert lines.count() == 300 and lines.rdd.getNumPartitions() == -(-held // 100)
