import functools
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from millrace.llm import components as stars, near_dup
from millrace.llm.components import components
from millrace.llm.queries import op3_near_duplicates
from millrace.session import settle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """All links by full comparison of documents that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    by = {}
    for n, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(n)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    seen = set()
    for own in by.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                if (a, b) not in seen and root(a) != root(b):
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                        parent[root(b)] = root(a)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[root(n)] = min(least.get(root(n), i), i)
    return sorted((i, len(sets[n]), least[root(n)], i == least[root(n)]) for n, (i, _) in enumerate(rows))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op3(spark, sf):
    table = pq.read_table(f"/root/testdata/{sf}/documents.parquet")
    got = sorted(map(tuple, op3_near_duplicates(spark, f"/root/testdata/{sf}").collect()))
    assert got == brute(list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist())))


def test_chains_and_odd_rows(spark, frame):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(100 + i, " ".join(base[i : i + 60])) for i in range(0, 60, 3)]  # a chain: neighbours are alike, ends are not
    rows += [(i, " ".join([*base[:50], *[f"u{i}x{j}" for j in range(50)]])) for i in range(30)]  # a common half without links
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "Two words"), (304, "two  WORDS"), (305, "two"), (306, "ÀB c d e f"), (307, "àb c d e f"), (308, "x " * 5000), (309, "x " * 9000)]
    rng.shuffle(rows)
    docs = frame([(i, t, 1, "z") for i, t in rows], "doc_id bigint, text string, component_id int, node string")
    got = near_dup.near_duplicates(docs.repartition(4))
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_repeated_and_null_ids(spark, frame):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (9, "A b c d e f"), (None, "a b c d e f"), (None, None)]
    got = sorted(map(tuple, near_dup.near_duplicates(frame(rows, "doc_id bigint, text string")).collect()), key=repr)
    assert got == sorted([(7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False), (None, 2, 7, True), (None, 0, None, True)], key=repr)


def test_components(spark, frame):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(500, 500), (300, 301), (301, 300)]
    edges += [(5000 + rng.randrange(300), 5000 + rng.randrange(300)) for _ in range(200)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    rng.shuffle(edges)
    got = sorted(map(tuple, components(frame(edges, "a bigint, b bigint")).collect()))
    assert got == sorted((x, root(x)) for x in parent)
    assert components(frame([], "a bigint, b bigint")).count() == 0


def test_components_start_one_write_a_round(spark, frame, monkeypatch):
    written, started = [], "components of a path"
    monkeypatch.setattr(stars, "settle", lambda df, name: written.append(name) or settle(df, name))
    spark.sparkContext.setJobGroup(started, started)
    try:
        labels = components(frame([(n, n + 1) for n in range(64)], "a bigint, b bigint"))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(started))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.component for r in labels.collect()} == {0} and labels.count() == 65
    assert len(written) <= 8 and jobs <= 60, (written, jobs)


def test_shingle_sets_count():
    texts = ["", None, "a", "a b c d e", "a b c d e f a b c d e f", "é\x0bé é\x0cé é"]
    assert [len(s) for s in near_dup.shingle_sets(pa.array(texts))] == [len(shingles(t)) for t in texts]
    assert near_dup.match_threshold() == 30


def test_blocks_of_long_lists(spark, frame, monkeypatch):
    # Every list goes to the last comparison, in blocks of a few nodes; look-alikes are below the limit, near copies above.
    for name, value in (("BLOCK", 7), ("ROWS_AT_ONCE", 16), ("PAIRS_AT_ONCE", 50)):
        monkeypatch.setattr(near_dup, name, value)
    monkeypatch.setattr(near_dup, "linked", functools.partial(near_dup.linked, stars=0))
    rng = random.Random(12)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]

    def edited(share):
        return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in base)

    rows = [(i, edited(rng.choice([0.005, 0.03, 0.06]))) for i in range(80)]
    made = []
    compared = near_dup.compared
    monkeypatch.setattr(near_dup, "compared", lambda *a: made.append((out := compared(*a)).count()) or out)
    got = sorted(map(tuple, near_dup.near_duplicates(frame(rows, "doc_id bigint, text string")).collect()))
    want = brute(rows)
    assert got == want and 3 < len({r[2] for r in want}) < 80
    sets = list({frozenset(shingles(t)) for _, t in rows})
    links = sum(100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(sets) for b in sets[i + 1 :])
    assert links <= made[0] <= 1.5 * links + 20
