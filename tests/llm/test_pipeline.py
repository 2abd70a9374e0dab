"""The pipeline's stages against brute force on their own inputs, and the edges."""
import numpy as np
import pytest

import corpus_pipeline
from ripplet.llm import lines, simhash, toxicity
from ripplet.llm.queries import piece_model_path
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL
from tests.llm.test_decontam import brute as windows
from tests.llm.test_lines import brute as removed
from tests.llm.test_simhash import brute as groups

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def outputs(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_order(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "sentencepiece"]
    for name in ("toxicity", "line_dedup", "simhash", "decontamination"):
        assert outputs[name].columns == outputs["input"].columns


def test_toxicity_stage(spark, outputs):
    docs = outputs["input"]
    scored = toxicity.score_documents(docs, read_table(spark, SF_SMALL, "labels")).collect()
    assert rows(outputs["toxicity"]) == {r.doc_id: r.text for r in scored if r.toxicity.score < 0.5}


def test_line_stage(outputs):
    before, after = rows(outputs["toxicity"]), rows(outputs["line_dedup"])
    gone = removed(sorted(before.items()))
    want = {}
    for d, t in before.items():
        kept = [x for n, x in enumerate(t.split("\n")) if (d, n) not in gone]
        if len(kept) == len(t.split("\n")) or "".join(kept).strip():
            want[d] = "\n".join(kept)
    assert sum(after.get(d) == t for d, t in want.items()) >= 0.99 * len(want) and len(after) <= len(want) * 1.01
    assert all(r.n_chars == len(r.text) for r in outputs["line_dedup"].collect())


def test_simhash_stage(outputs):
    before = rows(outputs["line_dedup"])
    assert rows(outputs["simhash"]) == {d: before[d] for d, _, c in groups(sorted(before.items())) if d == c}


def test_decontamination_stage(spark, outputs):
    before = rows(outputs["simhash"])
    items = [tuple(r) for r in read_table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    assert rows(outputs["decontamination"]) == {d: before[d] for d, _, n, _ in windows(sorted(before.items()), items, 10) if n == 0}


def test_encoding_stage(outputs):
    import hashlib
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    texts = rows(outputs["decontamination"])
    out = outputs["sentencepiece"].collect()
    assert {r.doc_id for r in out} == set(texts)
    for r in out:
        ids = lib.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_edges(spark):
    data = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "some plain words here", "en", "s", 21), (3, "some plain words here", "en", "s", 21),
            (None, "no id at all", None, None, None), (4, "long " * 40_000, "en", "s", 200_000), (5, "some plain words here", "en", "s", 21)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for part in (data, []):
        docs = spark.createDataFrame(part, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL), "test-edge")
            assert docs.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        left = sorted(str(r.doc_id) for r in docs.collect())
        assert left == (sorted(["1", "3", "4", "None"]) if part else [])
        assert corpus_pipeline.encode(spark, docs, SF_SMALL).count() == len(left)
    assert lines.dedup_lines(docs).count() == 0 and simhash.simhash_dedup(docs).count() == 0
