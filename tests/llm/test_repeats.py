import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from millrace.llm import repeats
from millrace.llm.queries import op1_repeats

SF = "/root/testdata/sf0.001"


def brute(rows, length):
    datas = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + length] for d in datas for i in range(len(d) - length + 1))
    out = []
    for (i, _), d in zip(rows, datas):
        gone = np.zeros(len(d) + 1, bool)
        for at in range(len(d) - length + 1):
            if seen[d[at : at + length]] > 1:
                gone[at : at + length] = True
        rest = bytes(b for b, g in zip(d, gone) if not g)
        out.append((i, len(d), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def test_op1(spark):
    table = pq.read_table(f"{SF}/documents.parquet")
    found = op1_repeats(spark, SF).collect()
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in found if "\ufffd" not in r.kept_text)
    got = sorted((tuple(r)[:5] for r in found), key=repr)
    assert got == brute(list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist())), 400) and sum(r[2] for r in got) > 1000


def odd_rows():
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop éü\n") for _ in range(n))
    passage = word(900)
    rows = [(i, word(rng.randint(0, 700)) + passage[rng.randint(0, 300) : rng.randint(500, 900)] + word(rng.randint(0, 500))) for i in range(30)]
    rows += [(50, None), (51, ""), (52, "x" * 3000), (53, "x" * 401), (54, "ab" * 900), (55, passage[:400]), (56, passage[:399]), (57, "y" * 400), (57, "line of text\n" * 60)]
    rows += [(60 + i, passage[: 300 + i] + chr(97 + i) + passage[300 + i :]) for i in range(12)]
    return rows + [(None, rows[0][1]), (70, "é漢" * 500)]


def test_odd_rows(spark, frame):
    rows = odd_rows()
    docs = frame([(i, t, 1, "s") for i, t in rows], "doc_id bigint, text string, shard int, kept string")
    got = repeats.without_repeats(docs.repartition(4)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows, 400)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)
    assert repeats.removal_digest(docs.limit(0)).count() == 0


def test_planted_passages_go_and_clean_texts_stay(spark, frame):
    rng = random.Random(15)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n))
    passages = [words(90) for _ in range(5)]
    planted = [(i, f"{words(40)} {passages[i % 5]} {words(60)}") for i in range(40)]
    clean = [(100 + i, words(rng.randint(1, 300))) for i in range(40)]
    got = {r.doc_id: r for r in repeats.removal_digest(frame(planted + clean, "doc_id bigint, text string").repartition(5)).collect()}
    assert all(not any(p in got[i].kept_text for p in passages) and got[i].n_removed >= 400 for i, _ in planted)
    assert all(got[i].kept_text == t and got[i].n_removed == 0 for i, t in clean)


def test_texts_of_several_megabytes(spark, frame):
    rng = random.Random(16)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_300_000))
    rows = [(1, long), (2, long[700_000:700_500] + "z" * 100), (3, "short")]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in repeats.removal_digest(frame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (1_300_000, 500, 1), 2: (600, 500, 1), 3: (5, 0, 0)}


def test_texts_are_shuffled_once(spark):
    plan = spark._sc._jvm.PythonSQLUtils.explainString(op1_repeats(spark, SF)._jdf.queryExecution(), "formatted")
    moved = [node for node in plan.split("\n\n") if re.match(r"\(\d+\) (Exchange|Sort)\b", node.strip())]
    assert moved and not any("texts" in node for node in moved)


def test_blocks_cover_every_place():
    texts = [t or "" for _, t in odd_rows()]
    shard = repeats.Shard(pa.array(texts), 400)
    low, high, _, _ = shard.blocks()
    got = sorted(p for a, b in zip(low, high) for p in range(a, b + 1))
    assert got == [p for a, b in zip(shard.offsets[:-1], shard.offsets[1:]) for p in range(a, b - 399)]


def test_anchors_depend_on_what_is_around():
    rng = random.Random(4)
    text = "".join(rng.choice("abc d") for _ in range(2000))
    alone = repeats.Shard(pa.array([text]), 400)
    other = repeats.Shard(pa.array(["z" * 77, "q" * 501 + text + "w" * 99, ""]), 400)
    a, b = set(alone.anchors().tolist()), {p - 578 for p in other.anchors().tolist()}
    inner = range(120, 2000 - 128)
    assert {p for p in a if p in inner} == {p for p in b if p in inner}


def test_short_lengths_are_refused():
    with pytest.raises(ValueError):
        repeats.spacing(20)
