import hashlib
import math
import random
import zlib

import pyarrow.parquet as pq
import pytest

from millrace.llm import prefix_trie, turns
from millrace.llm.queries import op12_prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The contract in plain loops over (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:])
    members = {}
    for c, v in made.items():
        for d in range(len(v) + 1):
            members.setdefault(v[:d], []).append(c)
    kids, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, own_members in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(own_members) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(made[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    assert df.columns[:8] == COLUMNS
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op12(spark, sf):
    table = pq.read_table(f"/root/testdata/{sf}/conversations.parquet")
    assert result(op12_prefix_trie(spark, f"/root/testdata/{sf}")) == brute(list(zip(*[table[c].to_pylist() for c in ("conv_id", "turn", "role", "text")])))


def test_random_conversations(spark, frame):
    rng = random.Random(5)
    ids = [*range(0, 30), *range(100, 130), 205, 206, 399, -3, -100]
    rows = [(c, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "bé", "", None])) for c in ids for _ in range(rng.randint(1, 7))]
    rows += rows[:9] + [(None, 1, "user", "lost")]
    rows += [(100, t, "user", f"long {t}") for t in range(10, 90)]
    table = frame(rows, SCHEMA).selectExpr("*", "turn AS at", "role AS id", "1 AS parent", "text AS key")
    # Equal turns are ordered by role and text, as the brute force sorts them.
    assert result(prefix_trie.conversation_trie(table)) == brute(rows)


def test_blocks_of_long_conversations(spark, frame, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    rows = [(c, t, "user", f"{t}" if t < 11 else f"{c} {t}") for c in (100, 101, 102) for t in range(40)]
    assert result(prefix_trie.conversation_trie(frame(rows, SCHEMA))) == brute(rows)


def test_empty(spark, frame):
    assert result(prefix_trie.conversation_trie(frame([], SCHEMA))) == []
    assert result(prefix_trie.conversation_trie(frame([(None, 0, "user", "x")], SCHEMA))) == []


def test_subtree_totals_of_any_tree(spark, frame):
    rng = random.Random(9)
    parent = [None] + [rng.choice([max(0, i - 1), rng.randrange(i)]) for i in range(1, 300)]
    depth = [0] * 300
    for i in range(1, 300):
        depth[i] = depth[parent[i]] + rng.choice([1, 1, 3])
    total = [i * i for i in range(300)]
    for i in range(299, 0, -1):
        total[parent[i]] += total[i]
    tree = frame([(i, parent[i], depth[i], i * i) for i in range(300)], "id bigint, parent bigint, depth bigint, w bigint")
    assert sorted(map(tuple, prefix_trie.subtree_totals(tree, ["w"]).collect())) == list(enumerate(total))


def test_digest_of_many_pieces(spark, frame, monkeypatch):
    monkeypatch.setattr(turns, "PIECE_CHARS", 50)
    rows = [("hot", [n], f"{n}") for n in range(3000)] + [("cold", [5], ""), ("cold", [2], "é")]
    got = dict(map(tuple, turns.joined_sha256(frame(rows, "key string, order array<bigint>, piece string").repartition(3), ",").collect()))
    assert got == {"hot": hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest(), "cold": hashlib.sha256("é,".encode()).hexdigest()}
