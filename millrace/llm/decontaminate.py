"""Benchmark decontamination: texts become templates with typed placeholders, template windows are joined by hash, and
what stands in the slots must map consistently, so questions with other numbers, names or units are found as well."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.texts import BYTE_WORDS, LOWER, mix, slices, span_hashes, spans, utf8, window_hashes
from millrace.session import settle

WINDOW = 8
#: Items with fewer tokens are too common to tell anything and match nothing.
LEAST_TOKENS = 4
SHARE = 0.5
#: An alignment is another question if more than this share of its windows has a name or unit that changes partners.
CONFLICTS = 0.25
#: A template that stands in more windows of one item than this tells little; these windows are matched by their words.
REPEATS = 4
FILTER_BITS = 24

# Units of measure and number words, as they are written after A-Z is lower-cased.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms t ton tons tonne tonnes"
    " oz ounce ounces lb lbs pound pounds ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour"
    " hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur gbp percent degree degrees c f k w kw v a"
    " hz khz mhz ghz b kb mb gb tb n j kj cal kcal pa kpa mph kmh meter meters metre metres kilometer kilometers centimeter centimeters"
)
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen"
    " twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half quarter third dozen"
)

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True
POINT = np.zeros(256, bool)
POINT[[ord("."), ord(",")]] = True
PLAIN, NUMBER, UNIT, NAME = range(4)
TYPES = BYTE_WORDS[:4]
VIEWS = BYTE_WORDS[4:7]
LITERAL = 2

WINDOWS = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("view", pa.int32()), ("at", pa.int32()), ("slots", pa.list_(pa.int64())), ("n_windows", pa.int32())])
WINDOW_KIND = "id bigint, hash bigint, view int, at int, slots array<bigint>, n_windows int"


def _known(words: str) -> np.ndarray:
    data, offsets = utf8(pa.array(words.split()))
    return np.sort(span_hashes(data, offsets[:-1], offsets[1:]))


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


UNIT_HASHES, NUMBER_HASHES = _known(UNITS), _known(NUMBERS)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Literal hash, type and text of every token.

    Tokens are runs of letters (any byte above ASCII counts as one) or of digits with points and commas between
    digits. A-Z and the capitals of Latin-1 are lower-cased for the hash. Numbers and number words are NUMBER, a unit
    right after one is UNIT, any other capitalised word is NAME, wherever it stands in a sentence.
    """
    data, offsets = utf8(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.int64)
    digit, letter = DIGIT[data], LETTER[data]
    inner = POINT[data]
    inner[1:] &= digit[:-1]
    inner[:-1] &= digit[1:]
    inner[np.concatenate([offsets[offsets < len(data)], offsets[offsets > 0] - 1])] = False  # both sides in one text
    digit |= inner
    lower = LOWER[data]
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    lower[latin] += 0x20
    word_begin, word_end = spans(letter, offsets)
    digit_begin, digit_end = spans(digit, offsets)
    begins, ends = np.concatenate([word_begin, digit_begin]), np.concatenate([word_end, digit_end])
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], ends[order]
    hashes = span_hashes(lower, begins, ends)
    owner = np.searchsorted(offsets, begins, "right") - 1
    capital = (data[begins] >= ord("A")) & (data[begins] <= ord("Z"))
    latin = np.append(latin, False)
    capital |= latin[np.minimum(begins + 1, len(data))] & (ends > begins + 1)
    kind = np.where(capital, NAME, PLAIN).astype(np.int8)
    kind[digit[begins] | _among(hashes, NUMBER_HASHES)] = NUMBER
    after = np.zeros(len(kind), bool)
    after[1:] = (kind[:-1] == NUMBER) & (owner[1:] == owner[:-1])
    kind[after & (kind != NUMBER) & _among(hashes, UNIT_HASHES)] = UNIT
    return hashes, kind, owner


def least_plain(width: int) -> int:
    """Different plain words that a template window must have; one with fewer is matched by all its words and values."""
    return max(2, width * 3 // 8)


def _telling(template: np.ndarray, plain: np.ndarray, owner: np.ndarray, at: np.ndarray, hashed: np.ndarray, width: int) -> np.ndarray:
    """Whether a window has plain words enough and its template does not stand too often in its text."""
    order = np.lexsort((np.arange(len(template)), template, owner))
    before = np.full(len(template), -1)
    same = (template[order][1:] == template[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    before[order[1:][same]] = order[:-1][same]
    different = sum(plain[at + k] & (before[at + k] < at) for k in range(width))
    _, which, often = np.unique(np.stack([owner[at], hashed.view(np.int64)]), axis=1, return_inverse=True, return_counts=True)
    return (different >= least_plain(width)) & (often[which.ravel()] <= REPEATS)


def windows(texts: pa.Array, widths: list[int], bits: np.ndarray | None, whole: bool) -> tuple[np.ndarray, ...]:
    """Windows as (text, hash, view, place, slot values, slots per window, windows of the text).

    A slot value is 59 bits of a hash of the literal, 2 bits of type and 3 bits of its place in the window.
    There are three views of a text: with all placeholders; with names left as lower-cased words, which finds copies
    whose case was changed; and LITERAL, all words and values as they stand, without slots. ``whole`` (for items) gives a
    text shorter than the window one window of its own length and takes no other widths, and puts the literal view only
    in place of windows whose templates tell too little; without it every width and view is tried. ``bits`` keeps only
    windows that the filter has.
    """
    hashes, kind, owner = tokens(texts)
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
    first = np.cumsum(counts) - counts
    values = mix(hashes ^ TYPES[kind])
    found = []
    for width in widths:
        dull = None
        for view in range(3):
            typed = (kind, np.where(kind == NAME, PLAIN, kind), np.full_like(kind, PLAIN))[view]
            template = np.where(typed == PLAIN, hashes, TYPES[typed])
            hashed, at = window_hashes(template, owner, width)
            hashed = mix(hashed ^ VIEWS[view] + np.uint64(width))
            keep = np.ones(len(at), bool)
            if whole:
                keep = counts[owner[at]] == width if width < WINDOW else keep
                if len(at):
                    keep = keep & (dull if view == LITERAL else (telling := _telling(template, typed == PLAIN, owner, at, hashed, width)))
                    dull = ~telling
            if bits is not None:
                keep = keep & in_filter(hashed, bits)
            hashed, at = hashed[keep], at[keep]
            inside = typed[at[:, None] + np.arange(width)] != PLAIN if len(at) else np.zeros((0, width), bool)
            places = (at[:, None] + np.arange(width))[inside]
            within = np.broadcast_to(np.arange(width), inside.shape)[inside]
            slots = values[places] & ~np.uint64(31) | (kind[places].astype(np.uint64) << np.uint64(3)) | within.astype(np.uint64)
            found.append((owner[at], hashed, np.full(len(at), view), at - first[owner[at]], slots, inside.sum(1), np.maximum(counts[owner[at]] - WINDOW + 1, 1)))
    return tuple(np.concatenate(x) for x in zip(*found))


def in_filter(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    out = np.ones(len(hashes), bool)
    for place in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        out &= ((bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
    return out


def _window_rows(rows: DataFrame, widths: list[int], shared=None, whole: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else shared.value
        for part in slices(batches):
            text, hashed, view, at, slots, n_slots, n = windows(part["text"], widths, bits, whole)
            lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n_slots))).astype(np.int32), pa.array(slots.view(np.int64)))
            ids = part["id"].take(pa.array(text.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(hashed.view(np.int64)), pa.array(view.astype(np.int32)), pa.array(at.astype(np.int32)), lists, pa.array(n.astype(np.int32))], schema=WINDOWS)

    return rows.mapInArrow(run, WINDOW_KIND)


def window_filter(items: DataFrame) -> np.ndarray:
    """A bit map of fixed size of all item windows; what it lets through by chance is dropped by the join."""
    low = F.col("hash").bitwiseAND((1 << FILTER_BITS) - 1)
    high = F.shiftrightunsigned("hash", 32).bitwiseAND((1 << FILTER_BITS) - 1)
    places = items.select(F.explode(F.array(low, high)).alias("place"))
    one = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("bits")).collect()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in words:
        bits[r["word"]] = r["bits"]
    return bits.view(np.uint64)


def _value(slot: Column) -> Column:
    """A slot's type and literal, without its place."""
    return F.shiftright(slot, 3)


def _conflicts(hits: DataFrame) -> DataFrame:
    """(doc_id, item_id, shift, bad_names, bad_numbers): alignments with the pairs of values that depart from their partners.

    Names and units keep their partner both ways, at more than half of the places of each. A number of the item has one
    partner, the value at most of its places (of equals the least); different numbers may become the same.
    """
    kind = lambda p: _value(p["slots"]).bitwiseAND(3)
    line = ["doc_id", "item_id", "shift"]
    slots = hits.select(*line, "at", F.explode(F.arrays_zip("slots", "doc_slots")).alias("p"))
    place = F.col("at") + F.col("p.slots").bitwiseAND(7)
    pairs = slots.select(*line, place.alias("place"), (kind(F.col("p")) == NUMBER).alias("number"), _value(F.col("p.slots")).alias("x"), _value(F.col("p.doc_slots")).alias("y")).distinct()
    votes = pairs.groupBy(*line, "number", "x", "y").agg(F.count("*").alias("n"))
    of = lambda side: F.sum("n").over(Window.partitionBy(*line, "number", side))
    rank = F.struct("n", -F.col("y"))
    best = F.max(rank).over(Window.partitionBy(*line, "number", "x"))
    judged = votes.select("*", of("x").alias("of_x"), of("y").alias("of_y"), (best == rank).alias("first"))
    odd_name = ~F.col("number") & ((F.col("n") * 2 <= F.col("of_x")) | (F.col("n") * 2 <= F.col("of_y")))
    odd_number = F.col("number") & ~F.col("first")
    pair = F.struct("x", "y")
    bad = judged.where(odd_name | odd_number).groupBy(*line)
    return bad.agg(F.collect_set(F.when(odd_name, pair)).alias("bad_names"), F.collect_set(F.when(odd_number, pair)).alias("bad_numbers"))


def leaks(docs: DataFrame, items: DataFrame, share: float = SHARE, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, n_matched, n_windows, same_values.

    A document holds an item if windows of WINDOW tokens that match cover ``share`` of the item's windows. Template
    windows count along alignments (document place minus item place): a name or unit must keep its partner, the value
    that stands for it at more than half of its places, and the other way round; equal numbers must become equal
    numbers. Windows with a value that departs from this do not count, and if those with such a name or unit are over
    CONFLICTS of an alignment's, it is another question. Windows whose values are all equal always count. Windows with
    fewer than ``least_plain`` plain words (lists of numbers, say), or whose template stands over REPEATS times in the
    item, match only where all their words and values stand unchanged, at any place. So an item meets a document's window
    at most REPEATS times by its template, and a document's literal window once however often it is repeated.
    same_values tells that all counted windows are unchanged. Items of LEAST_TOKENS to WINDOW - 1 tokens have one window,
    shorter ones and nulls none. Document windows are matched
    with a filter of fixed size before anything is shuffled, so text that no item resembles goes no further. Null and
    empty texts hold nothing; rows that repeat an id count as one document, and so do all rows without an id.
    """
    sc = docs.sparkSession.sparkContext
    short = list(range(LEAST_TOKENS, WINDOW))
    item_rows = items.select(F.col(item_col).cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    known = settle(_window_rows(item_rows, [*short, WINDOW], whole=True), "items")
    shared = sc.broadcast(window_filter(known))
    doc_rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    # Which short widths any item has is one number per width.
    used = {r["width"] for r in item_widths(item_rows).collect()}
    seen = settle(_window_rows(doc_rows, [w for w in short if w in used] + [WINDOW], shared), "seen")
    seen = seen.select(F.col("id").alias("doc_id"), "hash", "view", F.col("at").alias("doc_at"), F.col("slots").alias("doc_slots"))
    known = known.select(F.col("id").alias("item_id"), "hash", "view", "at", "slots", "n_windows")
    named, worded = F.col("view") != LITERAL, F.col("view") == LITERAL
    words = seen.where(worded).select("doc_id", "hash").distinct().join(known.where(worded), "hash").select("doc_id", "item_id", "n_windows", "at", F.lit(True).alias("equal"))
    hits = seen.where(named).drop("view").join(known.where(named).drop("view"), "hash")
    hits = hits.where(F.size("slots") == F.size("doc_slots")).withColumn("shift", F.col("doc_at") - F.col("at"))
    hits = settle(hits.select("doc_id", "item_id", "shift", "at", "slots", "doc_slots", "n_windows"), "hits")
    bad = _conflicts(hits).select(F.col("doc_id").alias("__doc"), F.col("item_id").alias("__item"), F.col("shift").alias("__shift"), "bad_names", "bad_numbers")
    same_line = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col("item_id").eqNullSafe(F.col("__item")) & (F.col("shift") == F.col("__shift"))
    judged = hits.join(bad, same_line, "left")

    def free_of(pairs: str) -> Column:
        changing = F.exists(F.arrays_zip("slots", "doc_slots"), lambda p: F.array_contains(pairs, F.struct(_value(p["slots"]).alias("x"), _value(p["doc_slots"]).alias("y"))))
        return F.col("equal") | F.col(pairs).isNull() | ~changing

    judged = judged.withColumn("equal", F.col("slots") == F.col("doc_slots")).withColumns({"kept": free_of("bad_names"), "numbers": free_of("bad_numbers")})
    judged = judged.withColumn("sound", F.col("kept") & F.col("numbers"))
    line = ["doc_id", "item_id", "shift"]
    placed = judged.groupBy(*line, "at").agg(F.max("equal").alias("exact"), F.max("kept").alias("kept"), F.max("sound").alias("sound"), F.min(F.when(F.col("sound"), F.col("equal"))).alias("equal"), F.max("n_windows").alias("n_windows"))
    taken = lambda which: F.collect_list(F.when(F.col(which), F.struct("at", F.col("equal") if which == "sound" else F.lit(True).alias("equal"))))
    lines = placed.groupBy(*line).agg(F.avg((~F.col("kept")).cast("int")).alias("conflicts"), taken("sound").alias("sound"), taken("exact").alias("exact"), F.max("n_windows").alias("n_windows"))
    places = F.when(F.col("conflicts") <= CONFLICTS, F.col("sound")).otherwise(F.col("exact"))
    sound = lines.select("doc_id", "item_id", "n_windows", F.inline(places)).unionByName(words)
    found = sound.groupBy("doc_id", "item_id").agg(F.count_distinct("at").cast("bigint").alias("n_matched"), F.max("n_windows").cast("bigint").alias("n_windows"), F.min("equal").alias("same_values"))
    return found.where(F.col("n_matched") >= F.col("n_windows") * F.lit(share))


def item_widths(items: DataFrame) -> DataFrame:
    """The token counts below WINDOW that items have; at most WINDOW rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            _, _, owner = tokens(part["text"])
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(np.bincount(owner, minlength=part.num_rows) if len(owner) else np.zeros(part.num_rows), WINDOW).astype(np.int32))], names=["width"])

    return items.mapInArrow(run, "width int").distinct()


def without_leaks(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` without the documents that hold an item; rows without an id cannot be told apart and are kept."""
    held = settle(leaks(docs, items, share).select(F.col("doc_id").alias("__leak")).where("__leak IS NOT NULL").distinct(), "leaks")
    return docs.join(held, docs["doc_id"].cast("bigint") == held["__leak"], "left_anti")
