"""Language identification: word log frequencies first, character n-grams for words that were not seen."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.texts import mix, powers, slices
from millrace.session import settle

SAMPLE_DOCS = 2_000
WORDS_PER_LANGUAGE = 20_000
LONGEST_GRAM = 5
BACKOFF = math.log(0.4)
SMOOTH = 0.5
CACHE_WORDS = 200_000
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


class Model:
    """Log frequencies per language of whole words and of n-grams of 1 to LONGEST_GRAM characters."""

    def __init__(self, counts: dict[str, Counter]) -> None:
        self.languages = sorted(counts)
        grams = [{lang: Counter() for lang in self.languages} for _ in range(LONGEST_GRAM)]
        for lang in self.languages:
            for word, n in counts[lang].items():
                padded = f" {word} "
                for width in range(1, LONGEST_GRAM + 1):
                    for at in range(len(padded) - width + 1):
                        grams[width - 1][lang][padded[at : at + width]] += n
        self.words, self.word_scores, _ = self._table(counts)
        #: For each width, the hashes of its n-grams, their scores, and the scores where no width is known.
        self.grams = []
        for width, (keys, scores, none) in enumerate(map(self._table, grams), 1):
            points, first = code_points(list(keys), "")
            self.grams.append((gram_hashes(points, width)[first[:-1]] if keys else np.zeros(0, np.uint64), scores + BACKOFF * (LONGEST_GRAM - width)))
            if width == 1:
                self.none = none + BACKOFF * LONGEST_GRAM

    def _table(self, counts: dict[str, Counter]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
        """Place of each key, its smoothed log frequencies, and those of a key that no language has."""
        keys = {k: i for i, k in enumerate(sorted(set().union(*counts.values())))} if counts else {}
        seen = np.zeros((len(keys), len(self.languages)))
        for j, lang in enumerate(self.languages):
            for k, n in counts[lang].items():
                seen[keys[k], j] = n
        norm = np.log(seen.sum(0) + SMOOTH * (len(keys) + 1))
        return keys, (np.log(seen + SMOOTH) - norm).astype(np.float32), math.log(SMOOTH) - norm

    def index(self) -> list[tuple[pd.Index, np.ndarray]]:
        return [(pd.Index(hashes), scores) for hashes, scores in self.grams]


def code_points(words: list[str], around: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row, each between ``around``, and where each begins (one more than words)."""
    text = "".join(f"{around}{w}{around}" for w in words)
    sizes = np.array([len(w) for w in words], np.int64) + 2 * len(around)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), np.concatenate(([0], np.cumsum(sizes)))


def gram_hashes(points: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` code points from each place on; the last places wrap and are not to be used."""
    steps = powers(width)
    total = np.zeros(len(points), np.uint64)
    for k in range(width):
        total += np.roll(points, -k) * steps[k]
    return mix(total)


def unseen(words: list[str], index: list[tuple[pd.Index, np.ndarray]], none: np.ndarray) -> np.ndarray:
    """For each word, the mean over its places of the longest known n-gram there, one backoff weight per shortening."""
    points, first = code_points(words, " ")
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(points))
    scores = np.tile(none, (len(points), 1))
    open_at = np.arange(len(points))
    for width in range(len(index), 0, -1):
        fits = open_at[left[open_at] >= width]
        keys, table = index[width - 1]
        rows = keys.get_indexer(gram_hashes(points, width)[fits])
        scores[fits[rows >= 0]] = table[rows[rows >= 0]]
        open_at = np.setdiff1d(open_at, fits[rows >= 0], assume_unique=True)
    return np.add.reduceat(scores, first[:-1]) / np.diff(first)[:, None]


class Scorer:
    """Scores texts with a model; unseen words are scored once per batch of texts and kept, up to CACHE_WORDS."""

    def __init__(self, model: Model) -> None:
        self.model, self.index = model, model.index()
        self.rows, self.table = dict(model.words), model.word_scores

    def learn(self, words: list[str]) -> None:
        if new := list({w for w in words if w not in self.rows}):
            if len(self.rows) > len(self.model.words) + CACHE_WORDS:
                self.rows, self.table = dict(self.model.words), self.model.word_scores
                new = list({w for w in words if w not in self.rows})
            self.rows.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.table = np.concatenate([self.table, unseen(new, self.index, self.model.none).astype(np.float32)])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [WORD.findall((t or "").lower()) for t in texts]
        lettered = [any(c.isalpha() for w in words for c in w) for words in found]
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        flat = [w for words in found for w in words]
        self.learn(flat)
        sizes = np.array([len(words) for words in found])
        running = np.zeros((len(flat) + 1, len(self.model.languages)))
        np.cumsum(self.table[[self.rows[w] for w in flat]], axis=0, dtype=np.float64, out=running[1:]) if flat else None
        ends = np.cumsum(sizes)
        total = running[ends] - running[ends - sizes]
        best = total.argmax(1)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        return [(self.model.languages[b], float(s)) if ok else (UNKNOWN, 0.0) for b, s, ok in zip(best, share, lettered)]


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS, words_per_language: int = WORDS_PER_LANGUAGE) -> Model:
    """A model of the rows of ``docs`` whose language and text are not null.

    It learns from about ``sample_docs`` whole documents of each language, those with the least hashes of id and text
    (all where there are fewer), and keeps the ``words_per_language`` most frequent words of each, ties by the word.
    Both bounds fix the model's size whatever the corpus. Ids only pick the sample. Without labelled rows the model
    has no language and calls every text unknown.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({})
    space = 1 << 30
    bound = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(space, space * sample_docs // n))])[F.col("lang")]
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(space)) < bound).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            counts: dict[str, Counter] = {}
            for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist()):
                counts.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            flat = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            yield pa.RecordBatch.from_pydict({"lang": [x[0] for x in flat], "word": [x[1] for x in flat], "n": pa.array([x[2] for x in flat], pa.int64())}, schema=COUNTS)

    counted = sample.mapInArrow(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    kept: dict[str, Counter] = {lang: Counter() for lang in sizes}
    for r in settle(counted.withColumn("rank", rank).where(F.col("rank") <= words_per_language), "words").collect():
        kept[r["lang"]][r["word"]] = r["n"]
    return Model(kept)


COUNTS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the likelihood that the predicted language holds.

    One pass without a shuffle; the text is the only input. Null texts and texts without a letter get ``und`` and 0.
    Columns of ``docs`` named lang_pred or score are replaced. Texts are scored whole, however long, and repeated rows
    get equal answers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    base = docs.select(*[F.col(f"`{c}`") for c in kept])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part in slices(batches, text_col):
            found = scorer.predict(part[text_col].to_pylist())
            columns = [*part.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(predict, f"{fields}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0. A null id is trained on."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Fits on the documents that are not held out and predicts every document: doc_id, held_out, lang_pred, score."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").alias("label"), held_out().alias("held_out"))
    model = fit(rows.where("NOT held_out"), "label")
    return identify(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
