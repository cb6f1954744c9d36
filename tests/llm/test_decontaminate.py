import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq

from millrace.llm import decontaminate as dc
from millrace.llm.queries import op6_decontamination

ITEM = "Anna bought 12 apples for 3.50 dollars each and gave Ben five of them. How much money has Anna left in her purse today?"
CHANGED = "Maria bought 40 apples for 7,25 euros each and gave Otto nine of them. How much money has Maria left in her purse today?"
MIXED = "Maria bought 40 apples for 7,25 euros each and gave Otto nine of them. How much money has Peter left in her purse today?"


def plain_tokens(text):
    """(lower-case token, type) by a regular expression."""
    out = []
    for m in re.finditer(r"[0-9]+(?:[.,][0-9]+)*|[A-Za-z\u0080-\U0010ffff]+", text or ""):
        word = m[0]
        low = "".join(c.lower() if c < "\x7f" or "À" <= c <= "Þ" else c for c in word)
        kind = "" if word == low else ("name" if low[0] != word[0] else "")
        if low[0].isascii() and low[0].isdigit() or low in dc.NUMBERS.split():
            kind = "number"
        elif out and out[-1][1] == "number" and low in dc.UNITS.split():
            kind = "unit"
        out.append((low, kind))
    return out


def conflicts(pairs):
    """Of (place, x, y) at one alignment the departing pairs of names and units, and of numbers."""
    pairs = {(p, x, y) for p, x, y in pairs}
    votes = Counter((x, y) for _, x, y in pairs)
    names, numbers = set(), set()
    for (x, y), n in votes.items():
        if x[1] == "number":
            numbers |= {(x, y)} if max(v for (o, _), v in votes.items() if o == x) > n else set()
        else:
            of = [sum(v for k, v in votes.items() if k[side] == (x, y)[side] and k[0][1] != "number") for side in (0, 1)]
            names |= {(x, y)} if n * 2 <= max(of) else set()
    return names, numbers


def brute(docs, items):
    """The rule of ``leaks`` in plain loops; numbers of equal votes are not told apart here, so tests avoid them."""
    found = []
    for item, item_text in items:
        a = plain_tokens(item_text)
        if len(a) < dc.LEAST_TOKENS:
            continue
        width = min(dc.WINDOW, len(a))
        total = len(a) - width + 1
        cut = lambda t, names: t[0] if not t[1] or (t[1] == "name" and not names) else f"<{t[1]}>"
        views, worded = {}, {}
        for names in (True, False):
            templates = [tuple(cut(t, names) for t in a[i : i + width]) for i in range(total)]
            often = Counter(templates)
            for i, t in enumerate(templates):
                if often[t] <= dc.REPEATS and len({w for w in t if w[0] != "<"}) >= dc.least_plain(width):
                    views.setdefault((names, t), []).append(i)
                elif not names:
                    worded.setdefault(tuple(w for w, _ in a[i : i + width]), []).append(i)
        for doc, text in docs:
            b, lines, counted = plain_tokens(text), {}, []
            for j in range(len(b) - width + 1):
                counted += [(i, True) for i in worded.get(tuple(w for w, _ in b[j : j + width]), [])]
                for names in (True, False):
                    for i in views.get((names, tuple(cut(t, names) for t in b[j : j + width])), []):
                        slots = [(i + k, a[i + k], b[j + k]) for k in range(width) if cut(a[i + k], names)[0] == "<"]
                        lines.setdefault(j - i, []).append((i, slots))
            for hits in lines.values():
                names, numbers = conflicts([s for _, slots in hits for s in slots])
                judged = {}
                for i, slots in hits:
                    equal = all(x[0] == y[0] for _, x, y in slots)
                    kept = equal or not any((x, y) in names for _, x, y in slots)
                    sound = kept and (equal or not any((x, y) in numbers for _, x, y in slots))
                    judged.setdefault(i, []).append((equal, kept, sound))
                odd = sum(not any(k for _, k, _ in v) for v in judged.values()) / len(judged)
                for i, v in judged.items():
                    if odd <= dc.CONFLICTS and any(s for _, _, s in v):
                        counted.append((i, all(e for e, _, s in v if s)))
                    elif odd > dc.CONFLICTS and any(e for e, _, _ in v):
                        counted.append((i, True))
            covered = {i for i, _ in counted}
            if covered and len(covered) >= total * dc.SHARE:
                found.append((doc, item, len(covered), total, all(e for _, e in counted)))
    return sorted(found)


def test_op6(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (pq.read_table(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = sorted(map(tuple, op6_decontamination(spark, sf).collect()))
    assert got and got == brute(list(zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist())), list(zip(items["item_id"].to_pylist(), items["text"].to_pylist())))


def test_every_planted_passage_is_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = (pq.read_table(f"{sf}/{t}.parquet").to_pydict() for t in ("documents", "benchmark"))
    want = {(d, i) for d, t in zip(docs["doc_id"], docs["text"]) for i, x in zip(items["item_id"], items["text"]) if x in t}
    got = {(r.doc_id, r.item_id) for r in op6_decontamination(spark, sf).collect()}
    assert want <= got and {d for d, _ in got} == {d for d, _ in want}


def test_templates(spark, frame):
    docs = [(1, f"Before it. {ITEM} After it."), (2, CHANGED), (3, MIXED), (4, ITEM.lower()), (5, "Nothing of it here, " * 30), (6, None), (7, ""), (8, "x" * 300_000 + " " + CHANGED), (8, CHANGED), (9, "see the short one here")]
    items = [(10, ITEM), (11, None), (12, "a b"), (13, "the short one here"), (13, "the short one here")]
    got = dc.leaks(frame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, hash int"), frame(items, "item_id bigint, text string"))
    rows = {(r.doc_id, r.item_id): r.same_values for r in got.collect()}
    assert rows == {(1, 10): True, (2, 10): False, (4, 10): True, (8, 10): False, (9, 13): True} | ({(3, 10): False} if (3, 10) in rows else {})
    assert (3, 10) not in rows
    left = dc.without_leaks(frame([(i, t, "k") for i, t in [*docs, (None, ITEM)]], "doc_id bigint, text string, __leaks string"), frame(items, "item_id bigint, text string"))
    assert sorted((r.doc_id is None, r.doc_id) for r in left.collect() if r.doc_id) == [(False, i) for i in (3, 5, 6, 7)] and left.count() == 5
    for a, b in ((docs[:0], items), (docs, items[:0])):
        assert dc.leaks(frame(a, "doc_id bigint, text string"), frame(b, "item_id bigint, text string")).count() == 0


def test_values_that_coincide_or_part(spark, frame):
    rest = ["w" + chr(97 + n // 8) + chr(97 + n % 8) for n in range(60)]
    met = "Anna has 4 red marbles in a box and Ben has 6 blue marbles in a bag. how many marbles are there in total?"
    twice = "a basket holds 3 apples and 3 pears on the table. how many pieces of fruit are in the basket now?"
    items = [(1, met), (2, twice), (3, " ".join(["Anna lives here and", *rest[:30], "then Anna goes away again", *rest[30:]]))]
    docs = [
        (1, met.replace("Anna", "Maria").replace("Ben", "Otto").replace("4", "5").replace("6", "5")),
        (2, twice.replace("3 apples", "4 apples").replace("3 pears", "5 pears")),
        (3, items[2][1].replace("then Anna", "then Maria")),
        (4, items[2][1].replace("then Anna", "then Maria").replace("Anna", "Otto")),
        (5, met.replace("Anna", "Maria").replace("Ben", "Maria")),
    ]
    got = dc.leaks(frame(docs, "doc_id bigint, text string"), frame(items, "item_id bigint, text string")).collect()
    found = {(r.doc_id, r.item_id): (r.n_windows - r.n_matched, r.same_values) for r in got}
    # The two places of Anna that part ways cost windows (one at the very start, eight inside), not the alignment.
    # Of one number that became two, one goes on as its partner; windows with the other do not count.
    assert 0 < found[2, 2][0] <= 8 and not found.pop((2, 2))[1]
    assert found == {(1, 1): (0, False), (3, 3): (8, True), (4, 3): (9, True)}


def test_changed_items_against_plain_loops(spark, frame):
    rng = random.Random(6)
    names, units = ["Anna", "Ben", "Carl", "Dora", "Emil"], ["km", "kg", "hours", "dollars"]
    words = ["has", "buys", "sells", "gives", "red", "blue", "old", "boxes", "apples", "and", "to", "for", "each", "day", "then", "with", "more"]

    def question():
        pick = lambda: rng.choices([rng.choice(words), rng.choice(names), str(rng.randint(1, 9)), f"{rng.randint(1, 9)} {rng.choice(units)}"], [6, 1, 1, 1])[0]
        return " ".join(pick() for _ in range(rng.randint(3, 40)))

    def changed(text):
        swap = {n: rng.choice(names) for n in names} | {u: rng.choice(units) for u in units} | {str(n): str(rng.randint(1, 99)) for n in range(10)}
        return " ".join(swap.get(w, w) if rng.random() < 0.95 else rng.choice(words) for w in text.split())

    items = [(i, question()) for i in range(60)] + [(100, "1 2 3 4 5 6 7 8 9 10 11 12"), (101, "a 1 b 2 " * 12), (102, ITEM)]
    docs = [(i, f"{question()} {changed(t)} {question()}") for i, t in items] + [(1000 + i, t.lower()) for i, t in items] + [(2000, "10 20 30 40 " * 30), (2001, "prices 1 2 3 4 5 6 7 8 9 10 11 12 end"), (2002, "a 3 b 4 " * 20)]
    got = {(r.doc_id, r.item_id): tuple(r) for r in dc.leaks(frame(docs, "doc_id bigint, text string"), frame(items, "item_id bigint, text string")).collect()}
    want = {(r[0], r[1]): r for r in brute(docs, items)}
    # Ties between numbers are broken by hash; there the share may differ by the windows of one value.
    assert len(want) > 60 and (2000, 100) not in got and (2001, 100) in got and (2002, 101) not in got
    same = sum(got.get(k) == v for k, v in want.items())
    assert same >= 0.9 * len(want) and len(set(got) ^ set(want)) <= 0.05 * len(want)


def test_recall_of_other_values(spark, frame):
    rng = random.Random(8)
    people = ["Anna", "Ben", "Carl", "Dora", "Emil", "Fay", "Gus", "Hana", "Ivo", "Jana"]
    things = ["apples", "pencils", "tickets", "stones", "cards", "cups", "shells", "coins"]

    def problem():
        p, q = rng.sample(people, 2)
        t, n = rng.choice(things), [rng.randint(2, 90) for _ in range(4)]
        forms = [
            (f"{{0}} has {{2}} {t} in a drawer and {{1}} brings {{3}} more of them from school. {{0}} then gives away {{4}} {t} to a friend. How many {t} are left for {{0}} and {{1}} together?"),
            (f"A shop sells {t} for {{2}} dollars each. {{0}} buys {{3}} of them on the first day and {{1}} buys {{4}} on the second day. What do both of them pay in the end?"),
            (f"If {{0}} walks {{2}} km every morning for {{3}} days while {{1}} rides {{4}} km in the same time, who of the two has come farther and by how much?"),
        ]
        return rng.choice(forms), (p, q, *n[:3])

    items, docs = [], []
    for i in range(300):
        form, values = problem()
        items.append((i, form.format(*values)))
        docs.append((i, "Some text before. " + form.format(*rng.sample(people, 2), *[rng.randint(2, 90) for _ in range(3)]) + " Some text after."))
    got = {(r.doc_id, r.item_id) for r in dc.leaks(frame(docs, "doc_id bigint, text string"), frame(items, "item_id bigint, text string")).collect()}
    recall = sum((i, i) in got for i in range(300)) / 300
    print("recall of re-parameterised items:", recall)
    assert recall >= 0.9


def test_rows_of_repeated_templates_are_linear(spark, frame, monkeypatch):
    made = []
    monkeypatch.setattr(dc, "settle", lambda df, name, settle=dc.settle: (out := settle(df, name), made.append((name, out.count())))[0])
    for n in (400, 800):
        for unit in ("{} ", "page {} of the {} parts and "):
            made.clear()
            text = lambda k: " ".join(unit.format(i, i + 1) for i in range(k))
            dc.leaks(frame([(1, text(n))], "doc_id bigint, text string"), frame([(1, text(n // 8))], "item_id bigint, text string")).count()
            tokens = n * (unit.count(" ") or 1)
            assert all(rows <= (dc.REPEATS + 2) * tokens for _, rows in made), (n, unit, made)


def test_tokens_against_a_pattern():
    texts = ["", None, "Élan vital École 5kg, 1,000.5 m. 3. 4,", "TWO Km Two km", "a.1.b,2,3", "×Ünï ÷", "7", "end 9.", "5 M x"]
    hashes, kinds, owner = dc.tokens(pa.array(texts))
    for n, text in enumerate(texts):
        want = plain_tokens(text)
        assert [["", "number", "unit", "name"][k] for k in kinds[owner == n]] == [k for _, k in want], text
        assert hashes[owner == n].tolist() == [dc._known(w)[0] for w, _ in want], text
