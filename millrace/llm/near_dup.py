"""Near-duplicate documents: an inverted join over MinHash coordinates, exact confirmation, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.components import linked
from millrace.llm.texts import LOWER, SEPARATOR, mix, plain_docs, slices, span_hashes, spans, utf8, window_hashes
from millrace.session import settle

WORDS = 5
PERCENT = 75
COORDINATES = 64
MISS = 1e-6
#: Bits of the sketches that keep hopeless pairs out of the last comparison.
BITS = 4096
#: Nodes in a block of a long list, and rows and pairs that are compared at once.
BLOCK = 2048
ROWS_AT_ONCE = 4096
PAIRS_AT_ONCE = 20_000

_RNG = np.random.default_rng(31337)
FLIPS = _RNG.integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2)
FACTORS = _RNG.integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.string()), ("signature", pa.list_(pa.int32()))])


def match_threshold(coordinates: int = COORDINATES, p: float = PERCENT / 100, miss: float = MISS) -> int:
    """The greatest number of equal coordinates that a pair reaches but for a chance of ``miss``, if each is equal with
    the chance ``p``."""
    if not 0 < p < 1:
        return coordinates if p >= 1 else 1
    total = 0.0
    for k in range(coordinates + 1):
        ways = math.lgamma(coordinates + 1) - math.lgamma(k + 1) - math.lgamma(coordinates - k + 1)
        total += math.exp(ways + k * math.log(p) + (coordinates - k) * math.log(1 - p))
        if total > miss:
            return max(1, k)
    return coordinates


def shingle_sets(texts: pa.Array, width: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct runs of ``width`` words (A-Z lower-cased); a shorter text is one
    run, a text without words or a null has none."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    begins, ends = spans(~SEPARATOR[data], offsets)
    words = span_hashes(data, begins, ends)
    owner = np.searchsorted(offsets, begins, "right") - 1
    # Empty texts share an offset with the next one; the last of equal offsets is the text that holds the word.
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    hashes, at = window_hashes(words, owner, width)
    bounds = np.searchsorted(at, np.append(first, len(words)))
    out = []
    for d, n in enumerate(counts):
        if n >= width:
            out.append(np.unique(hashes[bounds[d] : bounds[d + 1]]))
        elif n:
            whole, _ = window_hashes(words[first[d] : first[d] + n], np.zeros(n, np.int64), int(n))
            out.append(mix(whole + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """MinHash coordinates of non-empty sets, 32 bits each."""
    flat = np.concatenate(sets)
    sizes = np.array([len(s) for s in sets])
    first = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), coordinates), np.int32)
    for j in range(coordinates):
        least = np.minimum.reduceat((flat ^ FLIPS[j]) * FACTORS[j], first)
        out[:, j] = (mix(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def sign(docs: DataFrame, width: int = WORDS, coordinates: int = COORDINATES) -> DataFrame:
    """Rows (doc_id, n_shingles, set_key, signature); set_key names the set, 128 bits; the last two null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(part["text"], width)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list[str | None] = [None] * len(sets)
            rows: list[np.ndarray | None] = [None] * len(sets)
            if full:
                found = signatures([sets[i] for i in full], coordinates)
                for i, row in zip(full, found):
                    s = sets[i]
                    keys[i], rows[i] = f"{int(s.sum(dtype=np.uint64)):016x}{int(mix(s).sum(dtype=np.uint64)):016x}{len(s):x}", row
            yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "n_shingles": [len(s) for s in sets], "set_key": keys, "signature": rows}, schema=SIGNED)

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key string, signature array<int>")


def prefixes(reps: DataFrame, threshold: int) -> DataFrame:
    """Postings (node, at, value) of each node's prefix.

    All coordinate-value pairs are posted and counted. A pair of nodes can only match where a value has two nodes or
    more, so nodes with fewer than ``threshold`` such values are skipped. Of the others, with n shared values each, the
    n - threshold + 1 rarest are enough: two nodes with ``threshold`` matches have one of them in common. Values that
    very many nodes share come last in that order and are left out wherever rarer ones do.
    """
    posted = reps.select("node", F.posexplode("signature").alias("at", "value"))
    lists = posted.groupBy("at", "value").agg(F.count("*").alias("n")).where("n > 1")
    shared = posted.join(lists, ["at", "value"]).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "at", "value"))).alias("own"))
    chosen = shared.where(F.size("own") >= threshold).select("node", F.explode(F.slice("own", 1, F.size("own") - threshold + 1)).alias("p"))
    return chosen.select("node", "p.at", "p.value")


def matched(pairs: DataFrame, reps: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in ``threshold`` coordinates at least."""
    side = lambda name: reps.select(F.col("node").alias(name), F.col("signature").alias(f"{name}_signature"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    equal = F.aggregate(F.zip_with("a_signature", "b_signature", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return both.where(equal >= threshold).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the similarity. Each pair is one row with both texts."""
    side = lambda name: texts.select(F.col("node").alias(name), F.col("text").alias(f"{name}_text"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "b_text"):
            left: dict[int, np.ndarray] = {}
            ids = part["a"].to_pylist()
            fresh = list({i: row for row, i in enumerate(ids)}.values())
            for row in fresh:
                left[ids[row]] = shingle_sets(part["a_text"].slice(row, 1), width)[0]
            keep = []
            for i, b in zip(ids, shingle_sets(part["b_text"], width)):
                a = left[i]
                common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum()) if len(a) else 0
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield part.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "a_text", "b_text").mapInArrow(check, "a bigint, b bigint")


def facts_of(texts: DataFrame, reps: DataFrame, lists: DataFrame, width: int) -> DataFrame:
    """(node, facts): for each node that is left the bits in which lists it is, its signature, its size and its parity sketch.

    The sketch has BITS bits; each shingle flips the one of its hash. Two sketches differ in at most as many bits as the
    sets differ in shingles, so a pair whose sketches are too far apart is certainly not similar.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for s, signature, lists_in in zip(shingle_sets(part["text"], width), part["signature"], part["lists_in"]):
                flips = np.bincount((mix(s) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
                mask = np.zeros(len(signature.values), np.uint8)
                mask[lists_in.values.to_numpy()] = 1
                size = np.array([len(s)], np.int64)
                rows.append(b"".join([np.packbits(flips.astype(np.uint8)).tobytes(), size.tobytes(), signature.values.to_numpy().tobytes(), np.packbits(mask).tobytes()]))
            yield pa.RecordBatch.from_arrays([part["node"], pa.array(rows, pa.binary())], names=["node", "facts"])

    inside = lists.groupBy("node").agg(F.collect_set("at").alias("lists_in"))
    return texts.join(inside, "node").join(reps, "node").select("node", "text", "signature", "lists_in").mapInArrow(run, "node bigint, facts binary")


def _pairs_in(begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of rows of each run, about PAIRS_AT_ONCE at a time."""
    stop = np.repeat(begin + size, size)
    row = np.arange(int(begin[0]), int(begin[0] + size.sum())) if len(begin) else np.zeros(0, np.int64)
    after = stop - row - 1
    done = 0
    while done < len(row):
        to = max(done + 1, done + int(np.searchsorted(np.cumsum(after[done:]), PAIRS_AT_ONCE, "right")))
        count = after[done:to]
        x = np.repeat(row[done:to], count)
        yield x, x + 1 + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        done = to


def compared(mixed: DataFrame, facts: DataFrame, threshold: int, coordinates: int, percent: int) -> DataFrame:
    """(a, b): pairs of nodes of different components in the lists of ``mixed`` whose signatures and sketches allow a link.

    Long lists are split: nodes are dealt to blocks of about BLOCK and each pair of blocks is one small group, so no task
    holds a list. Collisions are counted on the signatures, a pair is taken in the first of its common lists only, with
    ``threshold`` equal coordinates at least, and only if its sizes and parity sketches can reach the similarity.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, ["at", "value", "low", "high"]):
            at, component, node, block = (rows[c].to_numpy() for c in ("at", "component", "node", "block"))
            facts = np.frombuffer(b"".join(rows["facts"].to_pylist()), np.uint8).reshape(rows.num_rows, -1)
            bits, rest = facts[:, : BITS // 8].copy().view(np.uint64), facts[:, BITS // 8 :]
            size, signature = rest[:, :8].copy().view(np.int64)[:, 0], rest[:, 8 : 8 + 4 * coordinates].copy().view(np.int32)
            inside = np.unpackbits(rest[:, 8 + 4 * coordinates :], axis=1, count=coordinates) == 1
            edge = np.append(True, _changes(rows, ["at", "value", "low", "high"]))
            begin = np.flatnonzero(edge)
            cross = rows["low"].to_numpy() != rows["high"].to_numpy()
            for x, y in _pairs_in(begin, np.diff(np.append(begin, rows.num_rows))):
                fit = (component[x] != component[y]) & (~cross[x] | (block[x] != block[y]))
                fit &= 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
                x, y = x[fit], y[fit]
                equal = signature[x] == signature[y]
                common = equal & inside[x] & inside[y]
                fit = (equal.sum(1) >= threshold) & (common.argmax(1) == at[x])
                x, y = x[fit], y[fit]
                # Of similar sets, at most this share of both sizes together differs.
                apart = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64)
                fit = apart * (100 + percent) <= (100 - percent) * (size[x] + size[y])
                one, other = node[x[fit]], node[y[fit]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, other)), pa.array(np.maximum(one, other))], names=["a", "b"])

    sizes = mixed.groupBy("at", "value").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = mixed.join(sizes, ["at", "value"]).withColumn("block", F.pmod(F.xxhash64("node", "at"), "blocks").cast("int"))
    dealt = dealt.select("at", "value", "node", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).join(facts, "node")
    keys = ["at", "value", "low", "high"]
    grouped = dealt.select(*keys, "block", "node", "component", "facts").repartition(*keys).sortWithinPartitions(*keys, "node")
    return grouped.mapInArrow(run, "a bigint, b bigint").distinct()


def _changes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Whether each row but the first has other ``keys`` than the one before."""
    return np.any([(v := rows[c].to_numpy())[1:] != v[:-1] for c in keys], axis=0)


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows in order of ``keys``, some whole groups at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            held.append(batch.slice(at, ROWS_AT_ONCE))
            size += held[-1].num_rows
            if size >= ROWS_AT_ONCE:
                table = pa.Table.from_batches(held).combine_chunks()
                ends = np.flatnonzero(_changes(table, keys))
                cut = int(ends[-1]) + 1 if len(ends) else 0
                if cut:
                    yield table.slice(0, cut).combine_chunks()
                held, size = table.slice(cut).to_batches(), table.num_rows - cut
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def near_duplicates(docs: DataFrame, width: int = WORDS, percent: int = PERCENT, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``, over whole texts.

    Two documents are linked if their sets of word runs have a Jaccard similarity of ``percent`` hundredths at least;
    candidates come from MinHash coordinates (a pair at the limit is missed with a chance below 1e-6), links are
    confirmed on full sets. component_id is the least doc_id that can be reached; kept marks it. Equal sets are one node,
    so copies cost one row each. Null or wordless texts are linked with nothing. Rows that repeat an id
    are each judged by their own text; rows without an id have a null component and are kept.
    """
    rows = plain_docs(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    signed = settle(sign(rows, width, coordinates), "signed")
    known = signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    nodes = known.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    reps = settle(known.groupBy("set_key").agg(F.min_by("signature", "doc_id").alias("signature"), F.min("doc_id").alias("node")).select("node", "signature"), "reps")
    threshold = match_threshold(coordinates, percent / 100)
    lists = settle(prefixes(reps, threshold), "postings")
    wanted = lists.select("node").distinct()
    texts = settle(rows.join(wanted, rows["doc_id"] == wanted["node"]).select("node", "text"), "texts")

    def rest(mixed: DataFrame) -> DataFrame:
        facts = settle(facts_of(texts, reps, mixed, width), "facts")
        return confirmed(compared(mixed, facts, threshold, coordinates, percent), texts, width, percent)

    labels = linked(lists, ["at", "value"], lambda x, y: F.lit(True), lambda pairs: confirmed(matched(pairs, reps, threshold), texts, width, percent), rest)
    at = nodes.join(labels, "node", "left").select("set_key", F.coalesce("component", "node").alias("set_component"))
    joined = signed.join(at, "set_key", "left")
    component = F.coalesce("set_component", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
