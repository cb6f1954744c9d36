"""The queries of this subpackage that SQL can express, for another engine."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    byte = "list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))"
    data = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}), lambda a, b: {byte}), CAST(4294967295 AS BIGINT))"


OP12 = f"""WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
md5(coalesce(role, '')) || md5(coalesce(text, '')) AS item, length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(item ORDER BY place) AS items, list(chars ORDER BY place) AS chars, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own GROUP BY conv_id),
made AS (SELECT c.conv_id, list_concat(coalesce(b.items, [])[1:c.h], c.items[c.h + 1:]) AS items,
list_concat(coalesce(b.chars, [])[1:c.h], c.chars[c.h + 1:]) AS chars FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
steps AS (SELECT *, unnest(range(0, len(items) + 1)) AS d FROM made),
node AS (SELECT items[1:d] AS path, min(conv_id) AS conv_id, d AS depth, count(*) AS n_convs, coalesce(max(CASE WHEN d > 0 THEN chars[d] END), 0) AS chars,
coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(items) = d), '') AS ends FROM steps GROUP BY items[1:d], d),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY path[1:depth - 1]),
above AS (SELECT *, unnest(range(0, depth + 1)) AS k FROM (SELECT node.*, coalesce(n, 0) AS n_children FROM node LEFT JOIN kids USING (path))),
total AS (SELECT path[1:k] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved FROM above GROUP BY path[1:k])
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0) AS n_children, n_leaves,
CAST(saved AS BIGINT) AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN total ON total.path = node.path LEFT JOIN kids ON kids.path = node.path
LEFT JOIN node parent ON node.depth > 0 AND parent.path = node.path[1:node.depth - 1]"""


def _edit(cost: str, letter: str, line: str, rest: str) -> str:
    """A way to the end: its cost, its audit and the repaired lines, each line with a line feed before it."""
    return f"struct_pack(c := {cost} + {rest}.c, a := '{letter}' || {rest}.a, r := {line} || {rest}.r)"


def _closed(states: dict[int, str]) -> list[str]:
    """The least way from each state where roles may be inserted first."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    after_user = f"least({states[2]}, {_edit('3', 'I', assistant, states[3])})"
    after_assistant = f"least({states[3]}, {_edit('3', 'I', user, states[2])})"
    return [*[f"least({states[q]}, {_edit('3', 'I', user, after_user)})" for q in (0, 1)], after_user, after_assistant]


_STEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_FILL = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_FAR = "struct_pack(c := CAST(1000000000 AS BIGINT), a := '', r := '')"


def _row(q: int) -> str:
    """The least way from state q that begins with an edit of the row."""
    line = "chr(10) || role || ':' || text"
    role, to = _FILL[q]
    kept = " ".join(f"WHEN initial = {i} THEN {_edit('extra', 'K', line, f's{_STEP[q, i]}')}" for i in range(3) if (q, i) in _STEP)
    rerole = _edit("3 + extra", "R", f"chr(10) || '{role}:' || text", f"s{to}")
    return f"least({_edit('4', 'D', chr(39) * 2, f's{q}')}, CASE WHEN gone THEN {_FAR} ELSE least(CASE {kept} ELSE {_FAR} END, {rerole}) END)"


_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
_SPACE = r"[\x20\x09-\x0D]"
_WAY = lambda c: f"struct_pack(c := CAST({c} AS BIGINT), a := '', r := '')"
_LAST = _closed({0: _WAY(0), 1: _WAY(1000000000), 2: _WAY(1000000000), 3: _WAY(0)})

OP13 = rf"""WITH RECURSIVE hurt AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(_KEY)} % 20 AS harm FROM conversations),
kept AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role, CASE WHEN harm = 1 THEN '' WHEN harm = 2
THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy FROM hurt WHERE harm <> 0),
placed AS (SELECT *, row_number() OVER w AS at, lag(left(role, 1)) OVER w AS before, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again
FROM kept WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN again > 1 THEN 2
WHEN NOT regexp_matches(text, '[.!?]{_SPACE}*\z') THEN 3 ELSE 0 END AS fault FROM placed),
facts AS (SELECT *, fault IN (1, 2) AS gone, CASE WHEN fault = 3 THEN 3 ELSE 0 END AS extra, CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS initial FROM judged),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank,
count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated,
count(*) FILTER (WHERE before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM facts GROUP BY conv_id),
ways AS (SELECT conv_id, n AS i, {", ".join(f"{e} AS s{q}" for q, e in enumerate(_LAST))} FROM counted
UNION ALL SELECT conv_id, i - 1, {", ".join(f"{e} AS s{q}" for q, e in enumerate(_closed({q: f"b{q}" for q in range(4)})))}
FROM (SELECT ways.conv_id, ways.i, {", ".join(f"{_row(q)} AS b{q}" for q in range(4))} FROM ways JOIN facts ON facts.conv_id IS NOT DISTINCT FROM ways.conv_id AND facts.at = ways.i)),
best AS (SELECT conv_id, s0.c AS cost, s0.a AS audit, s0.r AS lines FROM ways WHERE i = 0)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(substr(lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM e.conv_id"""

ORACLE = {"op12_prefix_trie": OP12, "op13_structure_repair": OP13}
