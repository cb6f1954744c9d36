import random
import zlib

import pyarrow.parquet as pq
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import language, sharding, tokens
from millrace.llm.queries import op4_token_counts, op9_language, op10_shards

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a\n\n b  c\t  d e"), (5, "x<|endoftext|>y <|endoftext|><|endoftext|>"), (5, "x<|endoftext|>y"),
    (6, "It's we'll I'D 123 4.5 ²½ äöü 漢字かな 🙂🙂 \x00\x1c\x1f\x85﻿"), (7, "word " * 20000), (8, "z" * 30000), (None, "null id"),
]


def jump(key, shards):
    b, j, key = -1, 0, key & (2**64 - 1)
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_shard(spark, frame):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(random.Random(5).getrandbits(63) for _ in range(300))]
    for shards in (1, 2, 8, 9, 100, 5000):
        rows = frame([(k,) for k in keys], "k bigint").withColumn("s", sharding.jump_shard(_col("k"), shards)).collect()
        assert [(r.k, r.s) for r in rows] == [(k, jump(k, shards)) for k in keys]


def _col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def check_shards(rows, texts):
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        assert r.shard == jump(r.doc_id or 0, 8) and r.grown_shard == jump(r.doc_id or 0, 9)
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted(((i is None, i or 0), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r["size"], r.text_crc32) for r in rows) == want


def test_op10(spark):
    table = pq.read_table(f"{SF}/documents.parquet")
    check_shards(op10_shards(spark, SF).collect(), list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist())))


def test_shards_odd_rows(spark, frame):
    rows = [(i, t, 7, 8) for i, t in ODD + ODD[:3]]
    check_shards(sharding.shard_documents(frame(rows, "doc_id bigint, text string, slot int, size int").repartition(3)).collect(), [r[:2] for r in rows])
    assert sharding.shard_documents(frame([], "doc_id bigint, text string")).count() == 0


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_op4(spark):
    table = pq.read_table(f"{SF}/documents.parquet")
    texts = table["text"].to_pylist()
    want = sorted((i, len(t.encode()), n, n > 512) for i, t, n in zip(table["doc_id"].to_pylist(), texts, library(texts)))
    assert sorted(map(tuple, op4_token_counts(spark, SF).collect())) == want


def test_token_counts_odd_rows(spark, frame):
    got = tokens.count_tokens(frame([(i, t, 1) for i, t in ODD], "doc_id bigint, text string, n int").repartition(2), PATH).collect()
    want = [(i, len((t or "").encode()), n) for (i, t), n in zip(ODD, library([t for _, t in ODD]))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert tokens.count_tokens(frame([], "doc_id bigint, text string"), PATH).count() == 0


def test_pretokens_agree_with_the_library():
    find = tokens.regex.compile(tokens.PATTERN).findall
    tokenizer = Tokenizer.from_file(PATH)
    pool = [*" \t\n\r\x0b\x0c\x1c\x85  　'stredvmla19_.-é٣Ⅷ²漢🙂́‍﻿", "'s", "'re", "  "]
    for seed in range(3000):
        rng = random.Random(seed)
        text = "".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))
        assert find(text) == [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)], repr(text)


def test_unsupported_tokenizer(tmp_path):
    with pytest.raises(ValueError):
        tokens.load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


def test_op9_held_out_accuracy(spark):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet")
    truth = dict(zip(table["doc_id"].to_pylist(), table["lang"].to_pylist()))
    rows = op9_language(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id for r in rows} == set(truth) and len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    own = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(own) / len(own) > 0.98


def test_language_odd_rows(spark, frame):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "12 34 ²", None), (5, "thes", None), (5, "thes", None), (None, "le chat", None), (6, "", "fr")]
    docs = frame([(*r, "x", 1.0) for r in rows], "doc_id bigint, text string, lang string, lang_pred string, score double")
    model = language.fit(docs)
    got = [(r.doc_id, r.lang_pred) for r in language.identify(docs, model).collect()]
    assert got == [(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "en"), (5, "en"), (None, "fr"), (6, "und")]
    assert {r.lang_pred for r in language.identify_held_out(docs.where("lang IS NULL")).collect()} == {"und"}
    assert language.identify_held_out(docs.limit(0)).count() == 0


def test_backoff_against_a_plain_loop():
    from collections import Counter

    counts = {"a": Counter({"abcde": 3, "été": 1}), "b": Counter({"xyz": 3, "abx": 2})}
    model = language.Model(counts)
    plain = []
    for width in range(1, 6):
        grams = {lang: Counter() for lang in counts}
        for lang, c in counts.items():
            for word, n in c.items():
                for at in range(len(word) + 3 - width):
                    grams[lang][f" {word} "[at : at + width]] += n
        plain.append(model._table(grams))
    for word in ["abcd", "qq", "é", "abxyzabcde", "漢"]:
        padded, total = f" {word} ", 0
        for at in range(len(padded)):
            for width in range(min(5, len(padded) - at), 0, -1):
                if padded[at : at + width] in plain[width - 1][0]:
                    total += plain[width - 1][1][plain[width - 1][0][padded[at : at + width]]] + language.BACKOFF * (5 - width)
                    break
            else:
                total += plain[0][2] + language.BACKOFF * 5
        assert language.unseen([word], model.index(), model.none)[0] == pytest.approx(total / len(padded), abs=1e-5)


def test_only_hot_pre_tokens_go_to_several_places(spark, frame, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_DOCS", 100)
    rng = random.Random(3)
    rows = [(i, " ".join(["the"] + [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(5)])) for i in range(4000)]
    docs = frame(rows, "doc_id bigint, text string").repartition(16)
    kind = "place int, block bigint, pre array<string>, n_docs array<int>, doc_at array<smallint>, n array<int>, ids array<bigint>, sizes array<bigint>"
    seen = {}
    for r in docs.mapInArrow(tokens.frequencies([], 8), kind).where("pre IS NOT NULL").select("place", "pre").collect():
        for word in r.pre:
            seen.setdefault(word, set()).add(r.place)
    assert len(seen) > 500 and len(seen.pop("the")) > 4 and all(len(places) == 1 for places in seen.values())
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    assert {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs, PATH).collect()} == dict(zip([i for i, _ in rows], library([t for _, t in rows])))
