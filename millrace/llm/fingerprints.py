"""Document fingerprints by order MinHash: minimal occurrence-numbered k-mers, kept in text order, hashed as tuples."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from millrace.llm.texts import mix, plain_docs, powers, slices

K = 8
PICKS = 2
HASHES = 32
#: Candidates per text and hash expected below the first bound; texts with too few are searched whole.
EXPECTED = 12

_RNG = np.random.default_rng(977)
FLIPS = _RNG.integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2)
FACTORS = _RNG.integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHORT_SLICE = 1 << 22
POSITION_BITS = np.uint64(22)

RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def points_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row and where each begins."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return data, np.concatenate(([0], np.cumsum(sizes)))


def kmers(points: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every k-mer, in text order; a text shorter than k is one k-mer, an empty one has none."""
    steps, n = powers(k), len(points)
    sizes = np.diff(offsets)
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(len(sizes)), counts)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[owner]
    total = np.zeros(len(at), np.uint64)
    left = offsets[owner + 1] - at
    whole = bool((left >= k).all())
    for j in range(k):
        value = (points[np.minimum(at + j, n - 1)] + np.uint64(1)) * steps[j]
        total += value if whole else np.where(left > j, value, np.uint64(0))
    return mix(total), owner


def occurrences(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each k-mer, how often it has come before in its text."""
    n = len(hashes)
    keyed = hashes ^ mix(owner.astype(np.uint64))
    if n <= SHORT_SLICE:
        ordered = np.sort((keyed >> POSITION_BITS << POSITION_BITS) | np.arange(n, dtype=np.uint64))
        order = (ordered & np.uint64(SHORT_SLICE - 1)).astype(np.int64)
        ordered >>= POSITION_BITS
    else:
        order = np.argsort(keyed, kind="stable")
        ordered = keyed[order]
    own = owner[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]) | (own[1:] != own[:-1])
    starts = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    out = np.empty(n, np.uint64)
    out[order] = (np.arange(n) - starts).astype(np.uint64)
    return out


def order_minhash(texts: list[str], k: int = K, picks: int = PICKS, hashes: int = HASHES) -> np.ndarray:
    """One row of ``hashes`` 32-bit values per text: for each hash function the ``picks`` least occurrence-numbered
    k-mers, put back in text order and hashed together. A row depends on its own text alone. Empty texts give zeros."""
    points, offsets = points_of(texts)
    base, owner = kmers(points, offsets, k)
    out = np.zeros((len(texts), hashes), np.uint32)
    if not len(base):
        return out
    items = mix(base + occurrences(base, owner) * FACTORS[-1])
    sizes = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(sizes) - sizes
    share = np.minimum(1.0, EXPECTED / np.maximum(sizes, 1))
    bound = np.where(share >= 1.0, np.uint64(2**64 - 1), (share * 2.0**64 * (1 - 1e-9)).astype(np.uint64))
    limit = bound[owner]
    need = np.minimum(sizes, picks)
    for j in range(hashes):
        rank = (items ^ FLIPS[j]) * FACTORS[j]
        found = np.flatnonzero(rank <= limit)
        short = np.flatnonzero(np.bincount(owner[found], minlength=len(texts)) < need)
        if len(short):
            every = np.concatenate([np.arange(first[t], first[t] + sizes[t]) for t in short])
            found = np.concatenate([found[~np.isin(owner[found], short)], every])
        found = found[np.lexsort((found, rank[found], owner[found]))]
        own = owner[found]
        n = np.bincount(own, minlength=len(texts))
        place = np.arange(len(found)) - np.repeat(np.cumsum(n) - n, n)
        chosen = np.sort(found[place < picks])
        own = owner[chosen]
        m = np.bincount(own, minlength=len(texts))
        within = np.arange(len(chosen)) - np.repeat(np.cumsum(m) - m, m)
        total = np.zeros(len(texts), np.uint64)
        np.add.at(total, own, items[chosen] * FACTORS[within + 1000])
        out[:, j] = np.where(m > 0, (mix(total) >> np.uint64(32)), np.uint64(0)).astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """Share of equal coordinates; an empty text is like an empty text and unlike any other."""
    both = (a_sizes == 0) == (b_sizes == 0)
    return np.where(both, (a == b).mean(1), 0.0)


def as_text(prints: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in prints]


def places_by_id(docs: DataFrame, places: int) -> list[int]:
    """Ids that cut the table into up to ``places`` runs of about equal counts; each is the greatest of its run."""
    cuts = [i / places for i in range(1, places + 1)]
    found = docs.select(F.percentile_approx("doc_id", cuts, 10_000).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in descending id order within partitions, each run followed by a copy of the row that comes after it.

    The id that ends a run is known from the cuts, so it goes to its own run and, flagged, to the one above; the first
    row of all follows the last. Ids are cut by value: rows of one id stay together, ordered by text, nulls last.
    """
    places = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = np.array(places_by_id(docs, places), np.int64)
    after = np.roll(np.arange(len(cuts)), -1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            values = ids.fill_null(cuts[0] if len(cuts) else 0).to_numpy()
            run = np.searchsorted(cuts, values) if len(cuts) else np.zeros(len(values), np.int64)
            ends = np.flatnonzero(known & (cuts[run] == values)) if len(cuts) else np.zeros(0, np.int64)
            take = pa.array(np.concatenate([np.arange(len(values)), ends]))
            columns = [pa.array(np.concatenate([run, after[run[ends]]]), pa.int32()), pa.array(np.arange(len(take)) >= len(values))]
            yield pa.RecordBatch.from_arrays([*columns, ids.take(take), batch["text"].take(take)], names=["place", "follows", "doc_id", "text"])

    placed = docs.mapInArrow(place, "place int, follows boolean, doc_id bigint, text string")
    return placed.repartitionById(max(len(cuts), 1), "place").sortWithinPartitions("follows", F.desc_nulls_last("doc_id"), "text")


def compare(k: int, picks: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, ""
        for part in slices(batches, size=1 << 20, rows=500):
            begin = part["text"][0].as_py() or ""
            if held is None:
                first = begin
            else:
                yield measure(held, begin)
            held = part
        if held is not None:  # the last row is a copy of the next one; without known ids there is one run, which wraps
            yield measure(held, first)

    def measure(part: pa.RecordBatch, coming: str) -> pa.RecordBatch:
        own = part.filter(pc.invert(part["follows"]))
        n = own.num_rows
        if n == 0:
            return pa.RecordBatch.from_pylist([], schema=RESULT)
        texts = [t or "" for t in part["text"].to_pylist()]
        following = [*texts[1:], coming]
        texts, following = texts[:n], following[:n]
        edited = [t[: len(t) - len(t) // 3] + f[: len(t) // 3] for t, f in zip(texts, following)]
        prints = order_minhash([*texts, following[-1], *edited], k, picks, hashes)
        sizes = np.array([len(t) for t in [*texts, following[-1], *edited]])
        mine, after, changed = prints[:n], prints[1 : n + 1], prints[n + 1 :]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": own["doc_id"],
                "n_chars": sizes[:n],
                "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                "fingerprint": as_text(mine),
                "edited_fingerprint": as_text(changed),
                "near_edited": likeness(mine, changed, sizes[:n], sizes[n + 1 :]),
                "near_next": likeness(mine, after, sizes[:n], sizes[1 : n + 1]),
            },
            schema=RESULT,
        )

    return run


def fingerprint(docs: DataFrame, k: int = K, picks: int = PICKS, hashes: int = HASHES) -> DataFrame:
    """``docs`` with ``fingerprint``: hex of the order MinHash of each whole text, without a shuffle.

    Null and empty texts get zeros; texts shorter than k count as one k-mer; an own column fingerprint is replaced.
    """
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "fingerprint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, size=1 << 20, rows=500):
            prints = as_text(order_minhash([t or "" for t in part["text"].to_pylist()], k, picks, hashes))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(prints, pa.string())], names=[*part.schema.names, "fingerprint"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, fingerprint string")


def fingerprint_with_edits(docs: DataFrame, k: int = K, picks: int = PICKS, hashes: int = HASHES) -> DataFrame:
    """Fingerprints each whole text and its edited text, whose last third comes from the next document's beginning.

    The next document is the one after it in descending id order (rows of one id by text, null ids last; after the
    last row the first). One shuffle of the texts; partitions are streamed in order, so no more than a slice is held.
    Null texts are empty: they are like other empty texts (1) and unlike all others (0). Repeated rows each get a row.
    """
    rows = plain_docs(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    kinds = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(rows).mapInArrow(compare(k, picks, hashes), kinds)
