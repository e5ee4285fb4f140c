"""Operator 4: round trip against the tokenizers library, and the hash index."""
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from llm_data import awkward, documents, fresh, repeated
from tokenizers import Tokenizer

from intake_spark.llm import id_store as S
from intake_spark.session import scratch_path

FILE = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(FILE)


def test_encoder_equals_the_library(lib):
    rnd = fresh(2)
    alphabet = "ab  \t\n'sdtmrevl019éß中😀²ⅷ  \x85_-.!\"" + "it's we're I'll 'twas don't"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80))) for _ in range(4000)]
    texts += ["it's", "'s", " 's", "''s", "x'll'y", "end '", "'re", "a  'd b", "<|endoftext|> in <|endoftext|>text", "   ", "a \n b"]
    enc = S.ByteBpe(FILE)
    for lo, hi, d, o in S.blocks(pa.array(texts), 1 << 12):
        ids, n = enc.encode(d, o)
        got = np.split(ids, np.cumsum(n)[:-1])
        for t, g in zip(texts[lo:hi], got):
            assert g.tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_other_tokenizers_go_to_the_library():
    path = P.path("word_bpe_49k.json")
    lib, texts = Tokenizer.from_file(path), ["Hello  World", "", "x"]
    for _, _, d, o in S.blocks(pa.array(texts)):
        ids, n = S.ByteBpe(path).encode(d, o)
        assert ids.tolist() == sum((lib.encode(t, add_special_tokens=False).ids for t in texts), [])


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70_000])
def test_perfect_hash_is_minimal_and_knows_strangers(n):
    h = S.mix(np.arange(n, dtype=np.uint64))
    p = S.PerfectHash.build(h)
    assert sorted(p.slots(h).tolist()) == list(range(n))
    b = S.Bucket(S.pack_bucket(h, np.arange(n, dtype=np.int32), np.arange(n) * 2, np.ones(n, np.int64)))
    ok, shard, row, _ = b.find(h)
    assert ok.all() and shard.tolist() == list(range(n)) and (row == np.arange(n) * 2).all()
    if n:
        assert not b.find(S.mix(np.arange(10**9, 10**9 + 1000, dtype=np.uint64)))[0].any()


def test_equal_keys_are_refused():
    with pytest.raises(ValueError):
        S.PerfectHash.build(np.array([5, 5], np.uint64))


def want(lib, rows, end=0):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_store_round_trip(spark, lib):
    rows = awkward(fresh())
    for case in (rows, repeated(rows), [(None, "a"), (1, "b")], [(1, None)], []):
        got = S.store_digest(documents(spark, case), scratch_path(spark, "t4"), FILE)
        assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want(lib, case)


def test_many_shards_and_lookup_by_key(spark, lib):
    rows = awkward(fresh())
    path = scratch_path(spark, "t4")
    S.write_store(documents(spark, rows), path, FILE, shard_bytes=2000)
    found = S.lookup(spark.createDataFrame([(8,), (0,), (999,), (None,), (8,)], "key long"), path)
    got = {r.key: r for r in S.read_documents(found, path, "<u2", with_ids=True).collect()}
    assert set(got) == {0, 8} and len({r.shard for r in found.collect()}) == 2
    for k, r in got.items():
        assert list(r.ids) == lib.encode(dict(rows)[k], add_special_tokens=False).ids + [0]
