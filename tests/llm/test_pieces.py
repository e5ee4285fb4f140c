"""Operator 2 against the sentencepiece library."""
import hashlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece as spm
from llm_data import WORDS, awkward, documents, fresh, repeated

from intake_spark.llm.piece_codec import PieceBpe, _decimals, encode_documents
from intake_spark.llm.textbytes import blocks

MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib():
    return spm.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return PieceBpe(MODEL)


def block_ids(codec, texts):
    ids, decoded = [], []
    for _, _, d, o in blocks(pa.array(texts)):
        i, io, t, to = codec.encode_block(d, o)
        ids += [i[a:b].tolist() for a, b in zip(io, io[1:])]
        decoded += [t[a:b].tobytes().decode() for a, b in zip(to, to[1:])]
    return ids, decoded


def test_ids_and_text_equal_the_library(codec, lib):
    rnd = fresh()
    letters = "ab cde  \n\t.,;:'\"()019éèßü▁中文😀ñ—“”{}<>/=+-_" + "".join(WORDS)
    texts = [t or "" for _, t in awkward(rnd)]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 200))) for _ in range(600)]
    texts += ["".join(rnd.choice(codec.pieces[259:]) for _ in range(rnd.randint(1, 30))) for _ in range(600)]
    texts += [" " * 3000, "=-" * 400, "<s> <unk> <0x0A> </s>", "▁▁ ▁", "  lead", "trail  "]
    ids, decoded = block_ids(codec, texts)
    want = lib.encode(texts)
    assert ids == want
    assert decoded == lib.decode(want)


def test_decode_any_ids(codec, lib):
    rnd = fresh(3)
    for _ in range(500):
        ids = [rnd.randrange(32000) if rnd.random() < .5 else rnd.randrange(3, 259) for _ in range(rnd.randint(0, 12))]
        assert codec.decode(ids) == lib.decode(ids)


def test_small_table_bound_changes_nothing(lib):
    small = PieceBpe(MODEL)
    small.table._max = 50
    texts = [t or "" for _, t in awkward(fresh(5))]
    assert block_ids(small, texts)[0] == lib.encode(texts)


def test_other_models_are_refused(tmp_path):
    bad = tmp_path / "x.model"
    bad.write_bytes(b"")
    with pytest.raises(ValueError):
        PieceBpe(str(bad))


def test_decimals():
    flat, ends = _decimals(np.array([0, 9, 10, 99, 100, 31999]))
    assert flat.tobytes() == b"0,9,10,99,100,31999," and ends.tolist() == [0, 2, 4, 7, 10, 14, 20]


def test_documents(spark, lib):
    rows = repeated(awkward(fresh()))
    got = encode_documents(documents(spark, rows), MODEL, with_ids=True, with_text=True, keep=["row"]).collect()
    assert len(got) == len(rows)
    want = sorted((d is not None, d or 0, lib.encode(t or "")) for d, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, list(r.ids)) for r in got) == want
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded == lib.decode(list(r.ids))
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert encode_documents(documents(spark, []), MODEL).count() == 0


def test_long_texts_without_spaces_take_time_in_proportion():
    import time
    enc = PieceBpe(P.path("piece_bpe_32k.model"))
    took = []
    for n in (20_000, 160_000):
        t = time.perf_counter()
        ids = enc.encode_segment("ab" * n)
        took.append(time.perf_counter() - t)
        assert sum(len(enc.pieces[i]) for i in ids) == 2 * n
    assert took[1] < 20 * took[0] + 0.5
