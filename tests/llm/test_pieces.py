import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from millrace.llm import pieces as sp
from millrace.llm.queries import op5_pieces

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")


def chunked(model, text, size):
    """Encodes as the operator does, without Spark."""
    norm = sp.SPACE + text.replace(" ", sp.SPACE)
    cuts = [*range(0, len(norm), size), len(norm)]
    windows = []
    for a, b in zip(cuts, cuts[1:]):
        left = max(0, a - model.longest)
        windows.append((norm[left : b + model.longest], a - left, b - left))
    states = sp.best_states([model.transfer(*w) for w in windows])
    return [i for w, a, b in zip(windows, [0, *states], states) for i in model.trace(*w, a, b)]


def some_text(rng, n):
    kinds = ["abcdefghij lmnopqrstuvwxyz", "e t a o  ", "aeiou", "        ", "0123456789.,", "éüñ漢字🙂 ", "\n\t x", "ABC def", "thereing on"]
    return "".join(rng.choice(rng.choice(kinds)) if rng.random() < 0.5 else rng.choice([" the", "ing", "ation", "   ", "pre", "aaaa", "    "]) for _ in range(n))


def test_chunks_give_the_library_ids():
    model = sp.load(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for seed in range(150):
        rng = random.Random(seed)
        text = some_text(rng, rng.randint(1, 150))
        for size in (17, 40, 93):
            assert chunked(model, text, size) == library.encode(text), (seed, size, text)
    for text in (" " * 300, "a" * 500, "x y" * 100, "internationalization" * 30, "漢" * 100, "=" * 333):
        assert chunked(model, text, 33) == library.encode(text), text


def test_op5(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    table = pq.read_table(f"{SF}/documents.parquet")
    want = {i: library.encode(t) for i, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist())}
    rows = op5_pieces(spark, SF).collect()
    assert len(rows) == len(want) and {r.doc_id: r.ids for r in rows} == want and all(r.same_text for r in rows)


def test_giants_and_odd_rows(spark, frame):
    rng = random.Random(5)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [(1, None), (2, ""), (3, " "), (4, "a  b   c \n"), (5, some_text(rng, 4000)), (5, some_text(rng, 4000)), (6, "nospace" * 2000), (7, "▁ x ▁"), (None, "é" * 5000), (8, "one two " * 30000)]
    docs = frame([(i, t, 1, "k") for i, t in texts], "doc_id bigint, text string, seq int, key string")
    encoded = sp.encode(docs.repartition(3), PATH, chunk=1000)
    got = sorted(((r.doc_id or 0, r.ids) for r in encoded.collect()), key=repr)
    assert got == sorted(((i or 0, library.encode(t or "")) for i, t in texts), key=repr)
    assert all(r.same_text for r in encoded.collect())
    back = sorted(((r.doc_id or 0, r.text) for r in sp.decode(encoded, PATH).collect()), key=repr)
    assert back == sorted(((i or 0, (t or "").replace("▁", " ")) for i, t in texts), key=repr)
    assert sp.encode(docs.limit(0), PATH).count() == 0


def test_unigram_model_by_the_same_scan(tmp_path):
    proto = pb.ModelProto()
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    proto.normalizer_spec.name, proto.normalizer_spec.remove_extra_whitespaces = "identity", False
    kinds = pb.ModelProto.SentencePiece
    proto.pieces.add(piece="<unk>", score=0, type=kinds.UNKNOWN)
    for n, piece in enumerate(["▁", "a", "b", "c", "ab", "bc", "abc", "ca", "▁a", "▁ab", "cabc", "aa"]):
        proto.pieces.add(piece=piece, score=-1.0 - 0.37 * n - 0.011 * n * n, type=kinds.NORMAL)
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    model = sp.Pieces(str(path))
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    for seed in range(100):
        rng = random.Random(seed)
        text = "".join(rng.choice("aabbcc ") for _ in range(120))
        assert chunked(model, text, 11) == library.encode(text), text


def test_scan_is_associative():
    rng = np.random.default_rng(1)
    sizes = [1, 3, 2, 4, 3, 1]
    ms = [rng.integers(-9, 0, (a, b)).astype(float) for a, b in zip(sizes, sizes[1:])]
    left = ms[0]
    for got, m in zip(sp.scan(ms), [None, *ms[1:]]):
        left = left if m is None else sp.times(left, m)
        assert (got == left).all()


def test_other_models_are_refused(tmp_path):
    proto = pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        sp.Pieces(str(tmp_path / "m"))
