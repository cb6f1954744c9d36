import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm.queries import queries
from test_decontaminate import brute as leaks
from test_line_dedup import brute as repeated
from test_near_dup import brute as near

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.settle(stage(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_plain_versions(stages):
    (_, docs, spoken), (_, _, unrepeated), (_, _, single), (_, _, clean), (_, _, encoded) = stages
    assert sorted(texts(spoken)) == sorted(texts(docs))  # every text has letters
    gone = {i: set(lines) for i, _, _, lines in repeated(texts(spoken))}
    want = {i: "\n".join(x for at, x in enumerate(t.split("\n")) if at not in gone[i]) for i, t in texts(spoken)}
    assert dict(texts(unrepeated)) == {i: t for i, t in want.items() if t.strip("\n ") or not gone[i]}
    assert all(r.n_chars == len(r.text) for r in unrepeated.collect())
    assert {i for i, _ in texts(single)} == {i for i, _, _, kept in near(texts(unrepeated)) if kept}
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    found = {d for d, *_ in leaks(texts(single), list(zip(items["item_id"], items["text"])))}
    assert found and {i for i, _ in texts(clean)} == {i for i, _ in texts(single)} - found
    assert {r.doc_id for r in encoded.collect()} == {i for i, _ in texts(clean)} and all(r.same_text for r in encoded.collect())


def test_columns_are_kept(stages):
    assert all(after.columns == docs.columns for _, docs, after in stages[:-1])


def test_registered(spark):
    assert set(queries()) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))


def test_empty_and_odd_documents(spark, frame):
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, lang_pred string"
    docs = frame([(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (3, "12", "en", "s", 2, "x"), (4, "a b c d e f g", None, "s", 13, "x"), (4, "a b c d e f g", "en", "s", 13, "x"), (None, "own words in here", "en", None, 1, "x")], kind)
    for rows, want in ((docs, {4, None}), (docs.limit(0), set())):
        for name, stage in corpus_pipeline.STAGES:
            rows = corpus_pipeline.settle(stage(spark, rows, SF), name)
        assert {r.doc_id for r in rows.collect()} == want


def test_rows_without_an_id_of_their_own(spark, frame):
    text = " ".join(f"word{i}" for i in range(60))
    item = pq.read_table(f"{SF}/benchmark.parquet")["text"][0].as_py()
    kind = "doc_id bigint, text string"
    docs = frame([(None, text), (None, text), (7, text), (None, "something else altogether here"), (3, "twice " + text[:200]), (3, "another text of the same id, long enough"), (None, item), (4, item), (4, "clean words")], kind)
    single = corpus_pipeline.settle(corpus_pipeline.without_near_duplicates(spark, docs, SF), "single")
    assert sorted(texts(single), key=repr) == sorted([(7, text), (None, "something else altogether here"), (3, "twice " + text[:200]), (3, "another text of the same id, long enough"), (4, "clean words"), *[r for r in texts(single) if r[1] == item]], key=repr)
    assert sum(t == item for _, t in texts(single)) == 1
    clean = corpus_pipeline.without_leaks(spark, docs, SF)
    assert not any(t == item for _, t in texts(clean)) and clean.count() == 7 and clean.columns == docs.columns
