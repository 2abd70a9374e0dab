"""Encoding and decoding against the sentencepiece library."""
import random

import numpy as np
import pytest

from ripplet.llm import pieces
from ripplet.llm.queries import piece_model_path
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(pieces.PieceModel.load(piece_model_path()))


def same(codec, library, texts):
    for t, raw in zip(texts, codec.encode_batch(texts)):
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        assert np.frombuffer(raw, "<u4").tolist() == ids, t
        assert codec.decode(np.array(ids, np.uint32)) == library.decode(ids), t


def test_edges(codec, library):
    same(codec, library, [None, "", " ", "  a", "a  b ", "▁a ▁", "a" * 5000, " " * 3001, "ab" * 999, "tttthhhheeee" * 50, "日本\U0001F600", "a\r\nb\x00", "<s> </s>", "⁇", "-=" * 700])


def test_random_texts(codec, library):
    rng = random.Random(1)
    some = "ab  \n\t▁éßthe ing日本\U0001F600\x00=-_<s>#  0123aaaa"
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2ff), rng.randint(0x300, 0xd7ff), rng.randint(0xe000, 0x1ffff)])) for _ in range(rng.randint(0, 40))) for _ in range(1000)]
    same(codec, library, texts)


def test_decoding_any_ids(codec, library):
    rng = random.Random(2)
    for _ in range(5000):
        ids = [rng.choice([rng.randint(0, 32), rng.randint(3, 258), rng.randint(259, 31999), 28705, 259]) for _ in range(rng.randint(0, 8))]
        assert codec.decode(np.array(ids, np.uint32)) == library.decode(ids)


def test_the_table(spark, library):
    docs = read_table(spark, SF_SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = pieces.encode_decode(docs, piece_model_path()).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == library.decode(ids)


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "a", "x"), (2, "a", "x"), (2, "a", "x")], "doc_id long, text string, ids string")
    out = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in pieces.encode_decode(df, piece_model_path()).collect())
    assert out == [("1", [1, 2], ""), ("2", [1, 264, 2], "a"), ("2", [1, 264, 2], "a"), ("None", [1, 264, 2], "a")]
    assert pieces.encode_decode(df.limit(0), piece_model_path()).count() == 0
