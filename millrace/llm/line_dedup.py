"""Fuzzy line de-duplication in DataFrame operations only: shingle signatures, bands, exact Jaccard, components."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.expressions import any_of
from millrace.llm.components import components, linked
from millrace.session import settle

SHINGLE = 10
PERCENT = 75
ROWS = 2
BANDS = 7
#: 64-bit words of the maps that keep hopeless pairs from being rows; a power of two.
WORDS = 16
#: Lists of more lines than this are compared with several leaders, as often as said, before all their pairs are.
LONG = 16
ROUNDS = 1
#: Leaders that every list is compared with before.
STARS = 1
#: Chance that a pair at the limit agrees in fewer coordinates than are asked for before it is compared.
MISS = 5e-4


def least_matches(coordinates: int, p: float) -> int:
    """The greatest number of equal coordinates that a pair reaches but for a chance of MISS, each equal with chance ``p``."""
    total = 0.0
    for k in range(coordinates + 1):
        total += math.comb(coordinates, k) * p**k * (1 - p) ** (coordinates - k)
        if total > MISS:
            return k
    return coordinates


def _shingle_bytes(line: Column) -> Column:
    """The line with four bytes per character, so that any shingle is reached by its place, however long the line."""
    return F.encode(line, "UTF-32")


def _places(line: Column, shingle: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.length(line) - shingle, F.lit(0)))


def _shingle_set(line: Column, shingle: int) -> Column:
    """64-bit hashes of a line's distinct shingles; a line shorter than one is its only shingle."""
    places = _places(line, shingle)

    def hashes(data: Column) -> Column:
        return F.transform(places, lambda at: F.xxhash64(F.substring(data, at * 4 + 1, F.lit(4 * shingle))))

    return F.array_distinct(_bound(_shingle_bytes(line), hashes))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, not anew for each element of a lambda inside."""
    return F.transform(F.array(value), use)[0]


def line_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text_key, at, line, node): every line with a visible character; node is 128 bits of the line's hash."""
    text = F.col("text").cast("string")
    lines = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    node = F.struct(F.xxhash64("line").alias("x"), F.xxhash64(F.lit(1), "line").alias("y"))
    return lines.where(F.length(F.trim("line")) > 0).withColumn("node", node)


def signatures(lines: DataFrame, shingle: int, count: int) -> DataFrame:
    """(node, coords): for each distinct line ``count`` MinHash coordinates by one permutation.

    The upper half of a shingle's hash deals it to one coordinate, which is the least hash it gets, or null if it gets none. Shingles are rows
    that are hashed and folded to minima before the shuffle, every shingle of every line. Two lines differ in no more
    coordinates than they have shingles that are not in both, so lines of few shingles are found more surely than by
    independent coordinates.
    """
    wide = lines.select("node.x", "node.y", "line", _shingle_bytes(F.col("line")).alias("data"))  # below the explode: once per line
    shingles = wide.select("x", "y", "data", F.explode(_places(F.col("line"), shingle)).alias("at"))
    hashed = shingles.select("x", "y", F.xxhash64(F.substring("data", F.col("at") * 4 + 1, F.lit(4 * shingle))).alias("h"))
    hashed = hashed.withColumn("bin", F.expr(f"CAST(shiftrightunsigned(shiftrightunsigned(h, 32) * {count}L, 32) AS INT)"))
    least = hashed.groupBy("x", "y").agg(*[F.expr(f"min(h) FILTER (WHERE bin = {j})").alias(f"m{j}") for j in range(count)])
    return least.select(F.struct("x", "y").alias("node"), F.array(*[f"m{j}" for j in range(count)]).alias("coords"))


def _similar(pairs: DataFrame, x: Column, y: Column, percent: int) -> DataFrame:
    """(a, b) of ``pairs`` whose sets x and y are similar. As rows of a generator the sets are worked out once, not for every time they are named."""
    sets = pairs.select("a", "b", F.inline(F.array(F.struct(x.alias("x"), y.alias("y")))))
    common = F.size(F.array_intersect("x", "y")).cast("bigint")
    return sets.where(common * (100 + percent) >= percent * (F.size("x") + F.size("y"))).select("a", "b")


def line_facts(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, n, bits): how many distinct shingles a line has, and a map of WORDS * 64 bits of which each shingle flips its own."""
    sets = texts.select("node", F.explode(_shingle_set(F.col("line"), shingle)).alias("h"))
    flips = sets.select("node", F.expr(f"CAST(shiftrightunsigned(h, 6) & {WORDS - 1} AS INT)").alias("word"), F.expr("shiftleft(1L, CAST(h & 63 AS INT))").alias("bit"))
    words = flips.groupBy("node").agg(F.count("*").alias("n"), *[F.expr(f"bit_xor(bit) FILTER (WHERE word = {j})").alias(f"b{j}") for j in range(WORDS)])
    return words.select("node", "n", F.array(*[F.coalesce(f"b{j}", F.lit(0).cast("bigint")) for j in range(WORDS)]).alias("bits"))  # one column, as plans name it at every step


def _may_be_similar(x: str, y: str, percent: int) -> Column:
    """Of the facts of two lines: sizes that fit, and maps that differ in no more bits than the sets may differ in shingles.

    What both sets have flips the same bits of both maps, so every bit in which they differ stands for a shingle that only
    one set has, and no similar pair fails.
    """
    size = {s: F.col(f"{s}n") for s in (x, y)}
    sizes = (size[x] * 100 >= size[y] * percent) & (size[y] * 100 >= size[x] * percent)
    apart = reduce(add, [F.bit_count(F.get(f"{x}bits", F.lit(j)).bitwiseXOR(F.get(f"{y}bits", F.lit(j)))) for j in range(WORDS)])
    return sizes & (apart * (100 + percent) <= (size[x] + size[y]) * (100 - percent))


def line_components(lines: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, count: int = BANDS) -> DataFrame:
    """(node, component) of the distinct lines that have a near-duplicate among the others.

    Lines that agree in all ``rows`` coordinates of one of ``count`` bands share a list, if one of them is not null. A list is
    compared with a leader (see ``linked``), and what then still stands in it beside another component is joined to that,
    under conditions on the coordinates, the sizes and bit maps of the shingles, which no similar pair fails; only pairs that
    fulfil them are rows, and those are compared exactly. Long lists are joined to some leaders first, as many as the root of their
    length: most of a large group is one component then, and pairs within it are not compared. Within this function a line is known by a number, and lists hold 8 bits of
    each coordinate: what agrees by chance is compared and dropped.
    """
    coordinates = rows * count
    byte = lambda j: F.coalesce(F.shiftright(F.col("coords")[j], 16).bitwiseAND(255), F.lit(0))
    packed = [reduce(add, [F.shiftleft(byte(j), 8 * (j - at)) for j in range(at, min(at + 7, coordinates))]) for at in range(0, coordinates, 7)]
    bands = [[F.col("coords")[b * rows + r] for r in range(rows)] for b in range(count)]
    keys = [F.when(any_of([c.isNotNull() for c in band]), F.xxhash64(F.lit(b), *band)) for b, band in enumerate(bands)]
    found = signatures(lines, shingle, coordinates)
    names = [f"s{i}" for i in range(len(packed))]
    signed = settle(found.select(F.monotonically_increasing_id().alias("n"), "node", F.array(*keys).alias("keys"), *[c.alias(s) for c, s in zip(packed, names)]), "signed")
    posted = signed.select(F.col("n").alias("node"), F.explode("keys").alias("key"), *names).where("key IS NOT NULL")
    shared = settle(posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "shared")
    lists = settle(posted.join(shared, "key").select("node", "key", *names), "lists")
    named = signed.select("n", "node.x", "node.y")
    wanted = named.join(lists.select(F.col("node").alias("n")).distinct(), "n", "left_semi")
    texts = lines.select("node.x", "node.y", "line").join(wanted, ["x", "y"]).groupBy("n").agg(F.first("line").alias("line"))
    texts = settle(texts.withColumnRenamed("n", "node"), "lines")
    sides = settle(lists.join(line_facts(texts, shingle), "node"), "sides")
    side = lambda name: texts.select(F.col("node").alias(name), F.col("line").alias(f"{name}_line"))
    least = least_matches(coordinates, percent / 100)

    def near(x: str, y: str) -> Column:
        """Few bytes of the coordinates differ, which their eighth bits count, and the facts allow it."""
        low, high = (F.lit(int(f"{byte:02x}" * 7, 16)) for byte in (0x7F, 0x80))
        apart = [F.col(f"{x}{s}").bitwiseXOR(F.col(f"{y}{s}")) for s in names]
        differ = reduce(add, [F.bit_count((v.bitwiseAND(low) + low).bitwiseOR(v).bitwiseAND(high)) for v in apart])
        return (differ <= coordinates - least) & _may_be_similar(x, y, percent)

    def confirm(pairs: DataFrame) -> DataFrame:
        both = settle(pairs, "pairs").join(side("a"), "a").join(side("b"), "b")
        x, y = (_shingle_set(F.col(f"{s}_line"), shingle) for s in "ab")
        return _similar(both, x, y, percent)

    def rest(mixed: DataFrame) -> DataFrame:
        named = lambda rows, s: rows.select("key", *[F.col(c).alias(f"{s}_{c}") for c in mixed.columns if c != "key"])
        apart = (F.col("x_component") != F.col("y_component")) & near("x_", "y_")
        found = lambda both: settle(confirm(both.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()), "found")

        def unsettled(rows: DataFrame) -> DataFrame:
            """Lists with several components, and how many lines they have."""
            return rows.groupBy("key").agg(F.count("*").alias("listed"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key", "listed")

        now, links = mixed, []
        for turn in range(ROUNDS):
            rows = now.join(unsettled(now).where(F.col("listed") > LONG), "key")
            order = F.xxhash64(F.lit("leaders"), F.lit(turn), "node")
            slot = F.pmod(F.xxhash64(F.lit("slot"), F.lit(turn), "node"), F.ceil(F.sqrt("listed")))
            heads = rows.groupBy("key", slot.alias("slot")).agg(F.min(F.struct(order.alias("order"), "node")).alias("top")).select("key", F.col("top.node").alias("node"))
            links.append(found(named(rows, "x").join(named(rows.join(heads, ["key", "node"], "left_semi"), "y"), "key").where(apart)))
            of = now.select("node", "component").distinct()
            ends = links[-1].join(of.toDF("a", "a_component"), "a").join(of.toDF("b", "b_component"), "b")
            merged = settle(components(ends.select(F.col("a_component").alias("a"), F.col("b_component").alias("b")), ROUNDS), "merged").toDF("component", "merged")
            now = now.join(merged, "component", "left").withColumn("component", F.coalesce("merged", "component")).select(*mixed.columns)
        now = now.join(unsettled(now), "key", "left_semi")
        links.append(found(named(now, "x").join(named(now, "y"), "key").where((F.col("x_node") < F.col("y_node")) & apart)))
        return reduce(DataFrame.unionByName, links)

    labels = linked(sides, ["key"], near, confirm, rest, STARS)
    again = lambda c: named.select(F.col("n").alias(c), F.struct("x", "y").alias(f"{c}_hash"))
    both = labels.join(again("node"), "node").join(again("component"), "component")
    return both.select(F.col("node_hash").alias("node"), F.col("component_hash").alias("component"))


def removed_occurrences(docs: DataFrame, id_col: str = "doc_id", **settings: int) -> DataFrame:
    """(doc_id, text_key, at) of every line that goes: all occurrences of a component but one.

    A component joins lines whose sets of ``shingle`` characters have a Jaccard similarity of ``percent`` hundredths,
    directly or through others; equal lines are one. Its least occurrence stays: by doc_id (nulls last), then text,
    then place. A pair just at the limit is missed with a chance of 0.4 %, one at 0.8 with 0.08 %.
    """
    lines = line_rows(docs, id_col)
    labels = line_components(lines, **settings)
    labels = labels.select("node.x", "node.y", F.col("component.x").alias("cx"), F.col("component.y").alias("cy"))
    joined = lines.select("doc_id", "text_key", "at", "node.x", "node.y").join(labels, ["x", "y"], "left")
    occurrences = settle(joined.select("doc_id", "text_key", "at", F.coalesce("cx", "x").alias("cx"), F.coalesce("cy", "y").alias("cy")), "occurrences")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key", "at")
    several = occurrences.groupBy("cx", "cy").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select("cx", "cy", "first")
    return occurrences.join(several, ["cx", "cy"]).where(F.col("first") != order).select("doc_id", "text_key", "at")


def removed_lines(docs: DataFrame, **settings: int) -> DataFrame:
    """doc_id, n_lines, n_removed and removed (numbers of the lines to go, from 0) of every document.

    Lines are what line feeds separate; those without a visible character always stay. A null or empty text has no
    line to lose. Rows that repeat an id and text are one document and get the same answer each.
    """
    text = F.col("text").cast("string")
    gone = removed_occurrences(docs, **settings).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("at")).alias("lines"))
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "lines")
    rows = docs.select("doc_id", F.xxhash64(text).alias("__own"), F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("bigint").alias("n_lines"))
    rows = rows.withColumn("n_lines", F.when(F.col("n_lines") < 0, 0).otherwise(F.col("n_lines")))
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left")
    removed = F.coalesce("lines", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(removed).cast("bigint").alias("n_removed"), removed.alias("removed"))


def without_repeated_lines(docs: DataFrame, **settings: int) -> DataFrame:
    """``docs`` with the removed lines cut from ``text``; a document that loses its last visible line goes.

    Documents that had no visible line before stay as they are. All other columns are kept.
    """
    text = F.col("text").cast("string")
    gone = removed_occurrences(docs, **settings).groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("__lines"))
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__lines")
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__key")), "left")
    keep = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__lines"))
    rest = _bound(F.split(text, "\n"), lambda lines: F.array_join(F.transform(keep(lines), lambda at: lines[at]), "\n"))
    cleaned = joined.withColumn("__rest", F.when(F.col("__lines").isNull(), text).otherwise(rest))
    cleaned = cleaned.where(F.col("__lines").isNull() | (F.length(F.trim(F.translate("__rest", "\n", " "))) > 0))
    return cleaned.withColumn("text", F.col("__rest")).select(*[F.col(f"`{c}`") for c in docs.columns])
