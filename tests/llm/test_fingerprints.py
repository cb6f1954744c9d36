import hashlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from millrace.llm import fingerprints as fp
from millrace.llm.queries import op2_fingerprints

SF = "/root/testdata/sf0.001"


def edits(rows):
    """(doc_id, text) to the wanted (doc_id, n_chars, sha256, near text pairs)."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for at, (i, t) in enumerate(rows):
        follow = rows[(at + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 3] + follow[: len(t) // 3]
        out.append((i, t, follow, edited))
    return out


def check(got, rows):
    want = edits(rows)
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, _, e in want), key=key)
    by = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in got}
    for i, t, follow, edited in want:
        r = by[i, len(t), hashlib.sha256(edited.encode()).hexdigest()]
        a, b, c = fp.order_minhash([t]), fp.order_minhash([edited]), fp.order_minhash([follow])
        assert r.fingerprint == fp.as_text(a)[0] and r.edited_fingerprint == fp.as_text(b)[0]
        assert r.near_edited == ((a == b).mean() if bool(t) == bool(edited) else 0)
        assert r.near_next == ((a == c).mean() if bool(t) == bool(follow) else 0)


def test_op2(spark):
    table = pq.read_table(f"{SF}/documents.parquet")
    check(op2_fingerprints(spark, SF).collect(), list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist())))


@pytest.mark.parametrize("rows", [
    [], [(5, "alone in the world of words")], [(5, None)], [(None, "a"), (None, "bc" * 40), (None, None)],
    [(1, None), (2, ""), (9, "é漢🙂" * 30), (9, "é漢🙂" * 30), (9, "other text"), (4, "ab" * 20000), (-3, "x"), (None, "a b c d")],
])
def test_odd_rows(spark, frame, rows):
    docs = frame([(i, t, True, 3) for i, t in rows], "doc_id bigint, text string, follows boolean, place int")
    check(fp.fingerprint_with_edits(docs.repartition(3)).collect(), rows)
    assert {r.fingerprint for r in fp.fingerprint(docs.withColumnRenamed("place", "fingerprint")).collect()} == {fp.as_text(fp.order_minhash([t or ""]))[0] for _, t in rows}


def plain(text, k, picks, hashes):
    points = [ord(c) for c in text]
    if not points:
        return [0] * hashes
    grams = [tuple(points[i : i + k]) for i in range(max(1, len(points) - k + 1))]
    steps, seen, items = fp.powers(k), Counter(), []
    with np.errstate(over="ignore"):
        for g in grams:
            total = np.zeros(1, np.uint64)
            for j, c in enumerate(g):
                total += np.uint64(c + 1) * steps[j]
            items.append(fp.mix(fp.mix(total) + np.uint64(seen[g]) * fp.FACTORS[-1])[0])
            seen[g] += 1
        out = []
        for j in range(hashes):
            rank = [(int((x ^ fp.FLIPS[j]) * fp.FACTORS[j]), i) for i, x in enumerate(items)]
            chosen = sorted(i for _, i in sorted(rank)[:picks])
            total = np.zeros(1, np.uint64)
            for n, i in enumerate(chosen):
                total += items[i] * fp.FACTORS[n + 1000]
            out.append(int(fp.mix(total)[0]) >> 32)
    return out


def test_against_a_plain_loop():
    texts = ["", "a", "abc", "abcdefgh", "the cat the cat the cat the cat", "x" * 100, "some longer text " * 20, "é漢🙂 " * 9]
    assert fp.order_minhash(texts).tolist() == [plain(t, fp.K, fp.PICKS, fp.HASHES) for t in texts]


def test_order_and_edits_matter():
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(300))
    swapped = text[len(text) // 2 :] + text[: len(text) // 2]
    near = text[:500] + "XX" + text[500:]
    a, b, c = fp.order_minhash([text, swapped, near])
    assert (a == c).mean() > 0.8 > (a == b).mean() + 0.2
