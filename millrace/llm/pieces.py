"""SentencePiece encoding and decoding; giant documents are encoded in chunks by a max-plus scan.

A text's pieces are the best path through the lattice of all pieces. For a unigram model a step weighs the piece's score.
For a merge (BPE) model a step from one piece to the next weighs 0 if the merges would leave just these two apart,
and minus infinity otherwise; the path of finite weight is unique and is what the merges give. Either way the pieces that
can hold the last character before a cut are the states of that cut, a chunk is a matrix from the states of its first
cut to those of its last, matrices are combined associatively, and each chunk then traces its own part of the path.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.texts import slices
from millrace.session import settle

CHUNK = 65_536
SPACE = "▁"
CACHE_PAIRS = 1_000_000
NEVER = -np.inf

ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("same_text", pa.bool_())])
ENCODED_KIND = "doc_id bigint, ids array<int>, same_text boolean"


class Pieces:
    """A model file, checked to be one whose pieces never hold a blank after another character, and its lattice."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        norm = proto.normalizer_spec
        self.unigram = proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.UNIGRAM
        self.vocabulary = {p.piece: p.score for p in proto.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces and norm.escape_whitespaces
        known = self.unigram or proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        if not plain or not known or any(SPACE in p.lstrip(SPACE) for p in self.vocabulary) or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("chunks need a unigram or BPE model without normalisation, user symbols, or blanks inside pieces")
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        norm.add_dummy_prefix = False
        self.raw = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.longest = max(map(len, self.vocabulary))
        self.unknown = min(self.vocabulary.values()) - 10.0
        self.pairs: dict[tuple[str, str], bool] = {}
        if not self.unigram:  # pieces that the merges never leave whole are no steps
            names = list(self.vocabulary)
            self.vocabulary = {p: self.vocabulary[p] for p, ids in zip(names, self.raw.encode(names, num_threads=1)) if len(ids) == 1}

    def ids(self, text: str) -> list[int]:
        return self.raw.encode(text, num_threads=1) if text else []

    def is_piece(self, text: str) -> bool:
        return len(text) == 1 or text in self.vocabulary

    def step(self, before: str, piece: str) -> float:
        """Weight of ``piece`` after ``before``, which is empty at the start of a text."""
        if self.unigram:
            return self.vocabulary.get(piece, self.unknown)
        if not before or (piece[0] == SPACE and before[-1] != SPACE):
            return 0.0
        key = (before, piece)
        if key not in self.pairs:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.ids(before + piece) == self.ids(before) + self.ids(piece)
        return 0.0 if self.pairs[key] else NEVER

    def states(self, text: str, cut: int) -> list[tuple[int, int]]:
        """Spans of all pieces that hold the character before ``cut``; the one empty span where the text begins."""
        if cut == 0:
            return [(0, 0)]
        spans = [(s, e) for s in range(max(0, cut - self.longest), cut) for e in range(cut, min(len(text), s + self.longest) + 1)]
        return [(s, e) for s, e in spans if self.is_piece(text[s:e])]

    def spread(self, text: str, starts: list[tuple[int, int]], end: int, stop: int) -> tuple[dict, dict]:
        """Best weights from each of ``starts`` to every piece that ends before ``end`` or crosses it.

        Returns (reached, back): weights by span, one per start, and for each span the best span before it by start.
        Only pieces that begin before ``stop`` are entered.
        """
        reached: dict[tuple[int, int], np.ndarray] = {}
        back: dict[tuple[int, int], list] = {}
        ending: dict[int, list[tuple[int, int]]] = {}
        for i, span in enumerate(starts):
            reached[span] = np.where(np.arange(len(starts)) == i, 0.0, NEVER)
            back[span] = [None] * len(starts)
            ending.setdefault(span[1], []).append(span)
        at = min(ending)
        while at < stop:
            for span in ending.get(at, ()):
                weights, before = reached[span], text[span[0] : span[1]]
                for to in range(at + 1, min(end, at + self.longest) + 1):
                    piece = text[at:to]
                    if not self.is_piece(piece) or (step := self.step(before, piece)) == NEVER:
                        continue
                    new, total = (at, to), weights + step
                    if new not in reached:
                        reached[new], back[new] = np.full(len(starts), NEVER), [None] * len(starts)
                        ending.setdefault(to, []).append(new)
                    for i in np.flatnonzero(total > reached[new]):
                        reached[new][i], back[new][i] = total[i], span
            at += 1
        return reached, back

    def breaks(self, text: str, begin: int, end: int) -> tuple[int, int] | None:
        """First and last place strictly inside where a blank follows another character, so that no piece crosses it."""
        found = [p for p in (self._next_break(text, begin, end), self._last_break(text, begin, end)) if p]
        return (found[0], found[1]) if len(found) == 2 else None

    def _next_break(self, text: str, begin: int, end: int) -> int | None:
        at = begin
        while 0 <= (at := text.find(SPACE, at + 1, end)):
            if text[at - 1] != SPACE:
                return at
        return None

    def _last_break(self, text: str, begin: int, end: int) -> int | None:
        at = end
        while (at := text.rfind(SPACE, begin + 1, at)) >= 0:
            if text[at - 1] != SPACE:
                return at
        return None

    def transfer(self, text: str, begin: int, end: int) -> np.ndarray:
        """Matrix of best weights from the states of ``begin`` to those of ``end``; what lies between the first and the
        last break is the same for all paths and weighs nothing."""
        starts, ends = self.states(text, begin), self.states(text, end)
        inside = self.breaks(text, begin, end)
        if inside is None:
            reached, _ = self.spread(text, starts, len(text), end)
            return np.array([reached.get(s, np.full(len(starts), NEVER)) for s in ends]).T.reshape(len(starts), len(ends))
        left, _ = self.spread(text, starts, inside[0], inside[0])
        rows = np.max([w for (_, e), w in left.items() if e == inside[0]] or [np.full(len(starts), NEVER)], axis=0)
        right, _ = self.spread(text, [(inside[1], inside[1])], len(text), end)
        return rows[:, None] + np.array([right.get(s, [NEVER])[0] for s in ends])[None, :]

    def trace(self, text: str, begin: int, end: int, start: int, goal: int) -> list[int]:
        """Ids of the pieces after state ``start`` of ``begin`` up to and with state ``goal`` of ``end``."""
        first, last = self.states(text, begin)[start], self.states(text, end)[goal]
        inside = self.breaks(text, begin, end)
        if inside is None:
            return self._walk(text, first, last, len(text), end)
        left = self._walk(text, first, inside[0], inside[0], inside[0])
        return left + self.ids(text[inside[0] : inside[1]]) + self._walk(text, (inside[1], inside[1]), last, len(text), end)

    def _walk(self, text: str, first: tuple[int, int], last, end: int, stop: int) -> list[int]:
        reached, back = self.spread(text, [first], end, stop)
        span = last if isinstance(last, tuple) else max((s for s in reached if s[1] == last), key=lambda s: reached[s][0])
        path = []
        while span != first:
            path.append(span)
            span = back[span][0]
        return [i for s, e in reversed(path) for i in self.ids(text[s:e])]


@functools.cache
def load(path: str) -> Pieces:
    return Pieces(path)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """All prefixes of the product, by doubling: each round combines every prefix with the one a power of two before."""
    out, step = list(matrices), 1
    while step < len(out):
        out = [times(out[i - step], m) if i >= step else m for i, m in enumerate(out)]
        step *= 2
    return out


def best_states(matrices: list[np.ndarray]) -> list[int]:
    """State at the end of each chunk on the best path: the last one from the whole product, those before by going back."""
    forward = scan(matrices)
    states = [int(forward[-1][0].argmax())]
    for i in range(len(matrices) - 1, 0, -1):
        states.append(int((forward[i - 1][0] + matrices[i][:, states[-1]]).argmax()))
    return states[::-1]


CHUNKS = pa.schema([("key", pa.string()), ("seq", pa.int32()), ("begin", pa.int32()), ("end", pa.int32()), ("window", pa.string())])
CHUNK_KIND = "key string, seq int, begin int, end int, window string"
STATES = pa.schema([("key", pa.string()), ("seq", pa.int32()), ("start", pa.int32()), ("goal", pa.int32())])


def _cut(size: int, around: int):
    """Windows of normalised texts: chunks of ``size`` characters with ``around`` more on either side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = SPACE + batch["text"][row].as_py().replace(" ", SPACE)
                for seq, at in enumerate(range(0, len(text), size)):
                    left, to = max(0, at - around), min(at + size, len(text))
                    one = {"key": batch["key"][row].as_py(), "seq": seq, "begin": at - left, "end": to - left, "window": text[left : to + around]}
                    yield pa.RecordBatch.from_pylist([one], schema=CHUNKS)

    return run


def _transfer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            found = [pieces.transfer(r["window"], r["begin"], r["end"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["key"], batch["seq"], pa.array([len(m) for m in found], pa.int32()), pa.array([m.ravel() for m in found], pa.list_(pa.float64()))], names=["key", "seq", "n", "matrix"])

    return run


def _choose(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
    states = best_states([np.array(r["matrix"]).reshape(r["n"], -1) for r in rows])
    return pa.Table.from_pylist([{"key": r["key"], "seq": r["seq"], "start": a, "goal": b} for r, a, b in zip(rows, [0, *states], states)], schema=STATES)


def _trace(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            ids = [pieces.trace(r["window"], r["begin"], r["end"], r["start"], r["goal"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["key"], batch["seq"], pa.array(ids, pa.list_(pa.int32()))], names=["key", "seq", "ids"])

    return run


def _encoded(model, ids: pa.Array, texts: list[str], parts: list[list[int]], own: pa.Array) -> pa.RecordBatch:
    """Decodes ``parts`` and tells whether the texts come back; a blank's own sign stands for a blank."""
    back = model.decode(parts, num_threads=1) if parts else []
    same = [b == t or b == t.replace(SPACE, " ") for b, t in zip(back, texts)]
    return pa.RecordBatch.from_arrays([ids, own, pa.array(same, pa.bool_())], schema=ENCODED)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path).whole
        for part in slices(batches, size=1 << 20, rows=500):
            texts = [t or "" for t in part["text"].to_pylist()]
            parts = model.encode(texts, num_threads=1)
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
            flat = np.fromiter(chain.from_iterable(parts), np.int32, int(offsets[-1]))
            yield _encoded(model, part["doc_id"], texts, parts, pa.ListArray.from_arrays(offsets, flat))

    return run


def _check(path: str):
    """Adds the comparison to ids that came by chunks, one document at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path).whole
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                yield _encoded(model, part["doc_id"], part["text"].to_pylist(), part["ids"].to_pylist(), part["ids"])

    return run


def encode(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, ids and same_text of each row: the ids that the library gives the whole text, without begin and end, and
    whether decoding them gives the text again.

    Texts of up to ``chunk`` characters are encoded where they are read. Longer ones are cut into chunks that any task
    may take: each becomes a matrix, a document's matrices (only these, not its text) meet to choose the state at every
    cut, and the chunks are traced apart. Null and empty texts have no ids (empty list); repeated rows and ids are
    encoded row by row; extra columns do not matter. A text that holds the blank's own sign decodes to a blank there.
    """
    spark = docs.sparkSession
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    around = load(path).longest
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    plain = rows.where(~giant).mapInArrow(_encode(path), ENCODED_KIND)
    giants = settle(rows.where(giant).withColumn("key", F.expr("uuid()")), "giants")
    chunks = settle(giants.select("key", "text").mapInArrow(_cut(chunk, around), CHUNK_KIND), "chunks")
    matrices = chunks.repartition(places, "key", "seq").mapInArrow(_transfer(path), "key string, seq int, n int, matrix array<double>")
    states = matrices.groupBy("key").applyInArrow(_choose, "key string, seq int, start int, goal int")
    traced = chunks.join(states, ["key", "seq"]).mapInArrow(_trace(path), "key string, seq int, ids array<int>")
    joined = traced.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("seq", "ids"))).alias("parts"))
    joined = joined.select("key", F.flatten("parts.ids").alias("ids"))
    long = giants.join(joined, "key").select("doc_id", "text", "ids").mapInArrow(_check(path), ENCODED_KIND)
    return plain.unionByName(long)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path).whole
        for batch in batches:
            texts = [model.decode(i.as_py() or []) for i in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, text string")
