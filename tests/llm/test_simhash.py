import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from millrace.llm import simhash
from millrace.llm.queries import op11_simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """All pairs of fingerprints compared, groups by their least known id."""
    prints = np.array([plain_print(t) for _, t in rows], np.uint64)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= 2):
            parent[root(i + 1 + int(j))] = root(i)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[root(n)] = min(least.get(root(n), i), i)
    return sorted(((i, f"{int(prints[n]):016x}", least.get(root(n))) for n, (i, _) in enumerate(rows)), key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op11(spark, sf):
    table = pq.read_table(f"/root/testdata/{sf}/documents.parquet")
    assert result(op11_simhash(spark, f"/root/testdata/{sf}")) == brute(list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist())))


def test_edge_cases(spark, frame, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 50)
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(4000))
    rows = [(9, None), (8, ""), (7, " \t\n\x0b\x0c\r"), (6, "One"), (5, "one two"), (4, "ONE TWO\tthree four"), (3, "one two three  four"), (2, long), (1, long + " w1"), (None, long), (None, "nobody else has this"), (4, "ONE TWO\tthree four"), (10, "É é"), (11, "é É"), (12, "x" * 500 + " y")]
    table = frame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS print", "2 AS component_id", "3 AS node", "4 AS a")
    assert result(simhash.simhash_groups(table)) == brute(rows)
    assert result(simhash.simhash_groups(table.limit(0))) == []


def balls(seed, n, flips):
    """Fingerprints near a few centres, many of them close to each other."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)] + [0, (1 << 64) - 1]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return np.array(sorted(out), np.uint64)


def close(left, right):
    return {(i, j) for i in range(len(left)) for j in np.flatnonzero(np.bitwise_count(left[i] ^ right) <= 2).tolist()}


@pytest.mark.parametrize("front", [5, 1 << 18])
def test_pairs_of_one_trie_and_of_two(monkeypatch, front):
    monkeypatch.setattr(simhash, "FRONT", front)
    for seed in range(4):
        prints = balls(seed, 300, 4)
        found = [(min(p), max(p)) for x, y in simhash.trie_pairs(prints, prints, 0) for p in zip(x.tolist(), y.tolist())]
        assert len(found) == len(set(found)) and set(found) == {(i, j) for i, j in close(prints, prints) if i < j}
        half = np.uint64(1) << np.uint64(63)
        low, high = prints[prints < half], prints[prints >= half]
        found = [p for x, y in simhash.trie_pairs(low, high, 1) for p in zip(x.tolist(), y.tolist())]
        assert len(found) == len(set(found)) and set(found) == close(low, high)


@pytest.mark.parametrize("most", [20])
def test_cells_of_any_size_give_the_same_groups(spark, frame, most):
    prints = balls(7, 120, 5)
    table = frame([(int(p),) for p in prints.view(np.int64)], "print bigint")
    placed = simhash.cells(table, most)
    assert placed.groupBy("depth", "cell").count().selectExpr("max(count)").first()[0] <= most
    found = {frozenset((r.a, r.b)) for r in simhash.links(table, most=most).collect()}
    signed = prints.view(np.int64).tolist()
    true = {frozenset((signed[i], signed[j])) for i, j in close(prints, prints) if i < j}
    assert found <= true
    parent = {p: p for p in signed}

    def groups(pairs):
        up = dict(parent)

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in map(tuple, pairs):
            up[root(a)] = root(b)
        by = {}
        for p in signed:
            by.setdefault(root(p), set()).add(p)
        return sorted(map(sorted, by.values()))

    assert groups(found) == groups(true)


def test_links_do_not_grow_with_the_square_of_a_ball(spark, frame):
    centre = 0x0123456789ABCDEF
    prints = sorted({centre, *[centre ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)]})
    table = frame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print bigint")
    assert simhash.links(table).count() == len(prints) - 1
