import random
from operator import eq

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from millrace.llm import components, line_dedup as ld
from millrace.llm.queries import op7_line_dedup

SF = "/root/testdata/sf0.001"


def shingle_set(line):
    return {line[i : i + 10] for i in range(max(1, len(line) - 9))}


def brute(rows):
    """(doc_id, n_lines, removed) by comparing all distinct lines that share a shingle."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0))
    lines, by, parent = {}, {}, {}
    for n in order:
        for line in (rows[n][1] or "").split("\n"):
            if line.strip(" "):
                lines.setdefault(line, shingle_set(line))
    for line, s in lines.items():
        parent[line] = line
        for x in s:
            by.setdefault(x, []).append(line)

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    seen = set()
    for own in by.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    x, y = lines[a], lines[b]
                    if min(len(x), len(y)) * 100 >= 75 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                        parent[root(b)] = root(a)
    taken, out = set(), {}
    for n in order:
        i, text = rows[n]
        own = (text or "").split("\n") if text is not None else []
        gone = []
        for at, line in enumerate(own):
            if line.strip(" "):
                if root(line) in taken:
                    gone.append(at)
                taken.add(root(line))
        out[n] = (i, len(own), len(gone), gone)
    return [out[n] for n in range(len(rows))]


def test_op7(spark):
    table = pq.read_table(f"{SF}/documents.parquet")
    got = sorted(map(tuple, op7_line_dedup(spark, SF).collect()))
    want = sorted(brute(list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))))
    assert got == want and sum(r[2] for r in got) > 100


def test_fuzzy_and_odd_rows(spark, frame):
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(200))
    near = [base[:k] + "#" + base[k + 1 :] for k in range(5, 195, 10)]
    half = [base[:100] + "".join(rng.choice("stuvw ") for _ in range(100)) for _ in range(30)]
    rows = [(1, f"{base}\nshort\n\nshort\n \n"), (2, "\n".join(near)), (3, "\n".join(half)), (4, None), (5, ""), (6, "é漢🙂" * 30000 + "\nshort"), (7, "only short lines\nshort"), (None, f"{base}\nown words of a row without an id")]
    docs = frame([(i, t, "n", 5) for i, t in rows], "doc_id bigint, text string, node string, at int")
    got = {r.doc_id: tuple(r) for r in ld.removed_lines(docs.repartition(3)).collect()}
    assert got == {r[0]: r for r in brute(rows)}
    kept = {r.doc_id: (r.text, r.node, r["at"]) for r in ld.without_repeated_lines(docs).collect()}
    assert 2 not in kept and kept[1][0] == f"{base}\nshort\n\n \n" and kept[7] == ("only short lines", "n", 5)
    assert kept[4][0] is None and kept[5][0] == "" and kept[None][0] == "own words of a row without an id"
    assert ld.removed_lines(docs.limit(0)).count() == 0 and ld.without_repeated_lines(docs.limit(0)).count() == 0


def test_repeated_rows_are_one_document(spark, frame):
    docs = frame([(1, "a line to keep here"), (1, "a line to keep here"), (2, "a line to keep here\nmore")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.removed) for r in ld.removed_lines(docs).collect()) == [(1, []), (1, []), (2, [0])]


def test_long_lines_of_few_shingles(spark, frame):
    units = ["-", "=", "*", "Be ", "+--", "| ", "_ _", "ab", "#", "~"]
    rows = [(2 * n + k, (u * 151)[: 150 + k]) for n, u in enumerate(units) for k in (0, 1)]
    got = sorted((r.doc_id, r.removed) for r in ld.removed_lines(frame(rows, "doc_id bigint, text string")).collect())
    assert got == [(i, [0] if i % 2 else []) for i, _ in rows]


def test_candidates_miss_few_pairs_at_the_limit(spark):
    # Lines of different characters: `same` common shingles, then `own` of each line.
    cases = [(9, 1, 2), (18, 3, 3), (36, 6, 6), (72, 12, 12), (105, 17, 18), (12, 1, 2), (20, 2, 3), (40, 5, 5), (80, 10, 10), (112, 14, 14)]
    pairs, rng, rows = 4000, random.Random(7), []
    for c, (same, *own) in enumerate(cases):
        for k in range(pairs):
            head = "".join(chr(rng.randrange(0x4E00, 0x9E00)) for _ in range(same + 9))
            rows += [((c * pairs + k) * 2 + side, head + "".join(chr(rng.randrange(0xAC00, 0xD700)) for _ in range(n))) for side, n in enumerate(own)]
    lines = spark.createDataFrame(pd.DataFrame(rows, columns=["n", "line"])).selectExpr("struct(n AS x, 0L AS y) AS node", "line").repartition(8)
    found = {r.node.x: r.coords for r in ld.signatures(lines, ld.SHINGLE, ld.ROWS * ld.BANDS).collect()}
    least = ld.least_matches(ld.ROWS * ld.BANDS, ld.PERCENT / 100)

    def caught(x, y):
        equal = list(map(eq, x, y))
        return sum(equal) >= least and any(all(equal[b : b + ld.ROWS]) for b in range(0, len(equal), ld.ROWS))

    missed = [sum(not caught(found[n], found[n + 1]) for n in range(2 * c * pairs, 2 * (c + 1) * pairs, 2)) / pairs for c in range(len(cases))]
    print("missed by union size:", [(sum(x), round(x[0] / sum(x), 2), m) for x, m in zip(cases, missed)])
    assert max(missed) < 0.01


def test_pairs_grow_with_the_group_not_its_square(spark, monkeypatch):
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    made = []

    def counted(df, name="settled", settle=ld.settle):
        out = settle(df, name)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(ld, "settle", counted)
    monkeypatch.setattr(components, "settle", counted)
    sizes = []
    for n in (100, 200, 400):
        made.clear()
        head = text(60)
        rows = [(i, head + text(40)) for i in range(n)]
        kept = ld.removed_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert kept.where("n_removed > 0").count() == 0
        by_name = {name: max(c for m, c in made if m == name) for name, _ in made}
        sizes.append((by_name["links"], max(c for name, c in by_name.items() if name not in ("lists", "mixed", "sides")), max(by_name[m] for m in ("lists", "mixed", "sides"))))
    assert all(links == 0 and most <= 2 * n and listed <= ld.BANDS * n for (links, most, listed), n in zip(sizes, (100, 200, 400))), sizes


def test_a_large_group_is_not_compared_pair_by_pair(spark, monkeypatch):
    rng = random.Random(31)
    base = [rng.choice("abcdefghijklmnop") for _ in range(300)]
    made = []

    def counted(df, name="settled", settle=ld.settle):
        out = settle(df, name)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(ld, "settle", counted)

    def variant(edits):
        other = list(base)
        for _ in range(edits):
            other[rng.randrange(300)] = rng.choice("uvwxyz")
        return "".join(other)

    rows = [(i, variant(2 + i % 3)) for i in range(240)]
    got = ld.removed_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r.doc_id, r.removed) for r in got.collect()) == [(r[0], r[3]) for r in brute(rows)]
    assert sum(made) <= 15 * len(rows), made


def test_pairs_that_fail_the_maps_are_not_similar(spark):
    rng = random.Random(21)
    rows = []
    for i in range(300):
        base = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(5, 400)))
        edits = rng.randint(0, 12)
        other = list(base)
        for _ in range(edits):
            other[rng.randrange(len(other))] = rng.choice("xyz")
        rows.append((i, base, "".join(other)))
    pairs = spark.createDataFrame(rows, "i bigint, x string, y string")
    fact = lambda c: ld.line_facts(pairs.selectExpr("i AS node", f"{c} AS line"), ld.SHINGLE)
    side = lambda c: fact(c).select(F.col("node").alias(f"{c}_node"), *[F.col(n).alias(f"{c}_{n}") for n in fact(c).columns if n != "node"])
    both = side("x").join(side("y"), F.col("x_node") == F.col("y_node"))
    passed = {r[0] for r in both.where(ld._may_be_similar("x_", "y_", 75)).select("x_node").collect()}
    similar = {i for i, x, y in rows if 100 * len(shingle_set(x) & shingle_set(y)) >= 75 * len(shingle_set(x) | shingle_set(y))}
    assert similar <= passed and len(passed) < 1.5 * len(similar)


def test_only_built_in_operations_on_the_path(spark):
    plan = op7_line_dedup(spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExternalRDD"))


def test_coordinates_differ_by_no_more_than_the_shingles_do(spark):
    rng, rows = random.Random(41), []
    for k in range(300):
        head = "".join(chr(rng.randrange(0x4E00, 0x9E00)) for _ in range(rng.randint(12, 60)))
        rows += [(2 * k + side, head + chr(0xAC00 + side)) for side in (0, 1)]  # one shingle of its own each
    lines = spark.createDataFrame(rows, "n bigint, line string").selectExpr("struct(n AS x, 0L AS y) AS node", "line")
    found = {r.node.x: r.coords for r in ld.signatures(lines, ld.SHINGLE, ld.ROWS * ld.BANDS).collect()}
    assert max(sum(x != y for x, y in zip(found[2 * k], found[2 * k + 1])) for k in range(300)) <= 2


def test_pairs_at_the_limit_are_removed(spark):
    rng, rows, pairs = random.Random(43), [], 1500
    for same, *own in [(9, 1, 2), (36, 6, 6), (105, 17, 18)]:
        for _ in range(pairs):
            head = "".join(chr(rng.randrange(0x4E00, 0x9E00)) for _ in range(same + 9))
            rows += [(len(rows) + side, head + "".join(chr(rng.randrange(0xAC00, 0xD700)) for _ in range(n))) for side, n in enumerate(own)]
    gone = ld.removed_lines(spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "text"])).repartition(8)).where("n_removed = 1")
    by_case = dict(gone.groupBy(F.expr(f"CAST(doc_id / {2 * pairs} AS INT)").alias("k")).count().collect())
    print("removed of", pairs, by_case)
    assert all(0.99 * pairs <= by_case[k] <= pairs for k in range(3))


def test_the_pair_of_a_list_of_two_is_compared_once(spark, monkeypatch):
    rng, rows, made = random.Random(47), [], []
    text = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    for k in range(60):
        head = text(150)
        rows += [(2 * k + side, head + text(60)) for side in (0, 1)]  # alike, yet not similar

    def counted(df, name="settled", settle=ld.settle):
        out = settle(df, name)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(ld, "settle", counted)
    monkeypatch.setattr(components, "settle", counted)
    assert ld.removed_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).where("n_removed > 0").count() == 0
    assert max(n for name, n in made if name == "lists") > 60 and sum(n for name, n in made if name == "mixed") == 0
    assert len(made) <= 20, made
