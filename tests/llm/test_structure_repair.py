import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from millrace.llm import structure_repair as repair
from millrace.llm.queries import op13_structure_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
GRAMMAR = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, audit, repaired lines) by comparing whole audits; rows are (fault, role, text)."""
    best = {}

    def settle(i, q, ways):
        ways = [w for w in ways if w]
        if ways and (new := min(ways, key=lambda w: (w[0], w[1]))) and ((i, q) not in best or new[:2] < best[i, q][:2]):
            best[i, q] = new

    def then(cost, letter, line, rest):
        return rest and (rest[0] + cost, letter + rest[1], line + rest[2])

    for i in range(len(rows), -1, -1):
        for _ in range(6):
            for q in ("", "s", "u", "a"):
                ways = [(0, "", [])] if i == len(rows) and q in ("", "a") else []
                for role in ("user", "assistant"):
                    if to := GRAMMAR.get((q, role[0])):
                        ways.append(then(3, "I", [f"{role}:"], best.get((i, to))))
                        if i < len(rows) and rows[i][0] not in ("blank", "duplicate"):
                            ways.append(then(3 + 3 * (rows[i][0] == "truncated"), "R", [f"{role}:{rows[i][2]}"], best.get((i + 1, to))))
                if i < len(rows):
                    fault, role, text = rows[i]
                    ways.append(then(4, "D", [], best.get((i + 1, q))))
                    if fault not in ("blank", "duplicate") and (to := GRAMMAR.get((q, role[:1]))):
                        ways.append(then(3 * (fault == "truncated"), "K", [f"{role}:{text}"], best.get((i + 1, to))))
                settle(i, q, ways)
    return best[0, ""]


def brute(rows):
    after, ids = {}, {r[0] for r in rows}
    for c, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        harm = zlib.crc32(key.encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        after.setdefault(c, []).extend([(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1))
    out = []
    for c in ids:
        own = sorted(after.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged = set(), []
        for _, role, text in own:
            last = text.rstrip(SPACE)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((fault, role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(judged)
        found = [sum(f == name for f, _, _ in judged) for name in ("blank", "duplicate", "truncated")]
        out.append((c, gaps, *found, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made_up(seed, ids, most):
    rng = random.Random(seed)
    texts = ["Well. ", "no end", "", " \t", "What?!", "é", "Yes.\n", None, "A!\x0b\x0c", "..."]
    roles = ["user", "assistant", "system", "tool", None, "", "u2", "sage"]
    return [(c, rng.choice([None, *range(8)]), rng.choices(roles, [8, 8, 3, 1, 1, 1, 1, 1])[0], rng.choice([*texts, f"t{rng.randrange(30)}."])) for c in ids for _ in range(rng.randint(1, most))]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op13(spark, sf):
    table = pq.read_table(f"/root/testdata/{sf}/conversations.parquet")
    rows = list(zip(*[table[c].to_pylist() for c in ("conv_id", "turn", "role", "text")]))
    assert result(op13_structure_repair(spark, f"/root/testdata/{sf}")) == brute(rows)


def test_random_conversations(spark, frame):
    rows = made_up(3, [*range(-5, 120), None], 14)
    table = frame(rows, SCHEMA).selectExpr("*", "1 AS at", "role AS fault", "'x' AS own", "turn AS block")
    assert result(repair.repair_report(table)) == brute(rows)


def test_conversations_of_many_blocks(spark, frame, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 3)
    monkeypatch.setattr(repair, "BATCH_ROWS", 10)
    rows = made_up(4, [*range(40), None], 25)
    assert result(repair.repair_report(frame(rows, SCHEMA))) == brute(rows)


def test_empty_and_lost(spark, frame):
    assert result(repair.repair_report(frame([], SCHEMA))) == []
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert result(repair.repair_report(frame([(lost, 0, "user", "Hi.")], SCHEMA))) == [(lost, 0, 0, 0, 0, 0, 0, "", repair.EMPTY)]


def test_paths_equal_plain_ones():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randint(0, 12)
        rows = [(rng.choice(["", "", "blank", "duplicate", "truncated"]), rng.choice("ssuuaax"), str(i)) for i in range(n)]
        fault = np.array([repair.FAULTS.get(f, 0) for f, _, _ in rows], np.int64)
        initial = np.array(["suax".index(r) for _, r, _ in rows], np.int64)
        found = repair.least_paths(np.array([0]), np.array([n]), fault, initial, repair.final_costs()[None], np.array([True]))
        audit = "".join(map(chr, found["letter"][: found["size"][0]]))
        assert (found["cost"][0], audit) == cheapest(rows)[:2]
