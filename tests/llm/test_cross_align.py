"""Cross-tokenizer alignment against both libraries and a plain version."""
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import sentencepiece as spm
from conftest import SF
from llm_data import awkward, documents, fresh, repeated
from tokenizers import Tokenizer

import __spark_entry__ as E
from intake_spark.llm import cross_align, sorted_parts
from intake_spark.llm.textbytes import blocks

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["▁ a piece's space", "a ▁b", "<|endoftext|> is text", "x<|endoftext|>", " leading", "  two", "\n\nlines\n", "\x01\x7f",
       "naïve café — “x”", "中文字符 と かな", "ﷺ 𝔘𝔫𝔦", "<0x41>A", "tab\tand  runs     of", "é", " ", "<s> </s> <unk>"]


def plain(rows):
    """The contract, token by token."""
    a_lib, b_lib = Tokenizer.from_file(A), spm.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    bytes_of = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in bytes_of]
    byte = {chr(b): b for b in bytes_of} | {chr(256 + i): b for i, b in enumerate(rest)}
    docs, count = [], Counter()
    for doc, text in rows:
        got = None
        if text:
            a = a_lib.encode(" " + text, add_special_tokens=False).ids
            b = b_lib.encode(text)
            ta = [bytes(byte[c] for c in a_lib.id_to_token(i)) for i in a]
            tb = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
                  for i, p in zip(b, (b_lib.id_to_piece(i) for i in b))]
            want = (" " + text).encode()
            if b"".join(ta) == want == b"".join(tb):
                got = a, b, np.cumsum([len(x) for x in ta]).tolist(), np.cumsum([len(x) for x in tb]).tolist()
        links = []
        if got:
            a, b, ea, eb = got
            j = 0
            for i in range(len(a)):
                start = ea[i - 1] if i else 0
                while eb[j] <= start:
                    j += 1
                k = j
                while k < len(b) and (eb[k - 1] if k else 0) < ea[i]:
                    links.append((a[i], b[k]))
                    k += 1
            count.update(links)
        docs.append((doc, got, links))
    highest = defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for doc, got, links in docs:
        if not got:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, ea, eb = got
        groups, pa, pb = [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            qa, qb = ea.index(e, pa) + 1, eb.index(e, pb) + 1
            groups.append(",".join(map(str, a[pa:qa])) + "|" + ",".join(map(str, b[pb:qb])))
            pa, pb = qa, qb
        out.append((doc, len(a), len(b), len(groups), len(links), sum(count[x] == highest[x[1]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_awkward_texts(spark, monkeypatch):
    rows = repeated(awkward(fresh())) + [(100 + i, t) for i, t in enumerate(ODD)]
    docs = documents(spark, rows)
    want = plain(rows)
    assert result(cross_align.digest(docs, A, B)) == want
    # one partition, small blocks, parts and held pairs
    monkeypatch.setattr(cross_align, "BLOCK", 2000)
    monkeypatch.setattr(cross_align, "HELD_PAIRS", 50)
    assert result(cross_align.digest(docs.repartition(1), A, B)) == want
    assert cross_align.digest(docs.limit(0), A, B).count() == 0


def test_a_full_table_of_encodings_is_emptied_between_blocks(monkeypatch):
    # many distinct words in one worker: the table of the byte tokenizer is emptied
    monkeypatch.setattr(cross_align, "HELD_SEGMENTS", 40)
    cross_align.byte_tokenizer.cache_clear()
    cross_align.piece_tokenizer.cache_clear()
    a_lib, b_lib = Tokenizer.from_file(A), spm.SentencePieceProcessor(model_file=B)
    try:
        for i in range(30):
            texts = [f"w{i}q{j} und{j * i} x" for j in range(20)]
            for *_, data, off in blocks(pa.array(texts)):
                a, _, b, _ = cross_align.encode_block(data, off, A, B)
                assert a.tolist() == [x for t in texts for x in a_lib.encode(" " + t, add_special_tokens=False).ids]
                assert b.tolist() == [x for t in texts for x in b_lib.encode(t)]
    finally:
        cross_align.byte_tokenizer.cache_clear()
        cross_align.piece_tokenizer.cache_clear()


def test_query_over_whole_documents(spark):
    sf = SF["0.001"]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(E.queries()["op13_cross_align"](spark, sf)) == plain(rows)


def test_only_irregular_groups_enter_the_pair_rows(spark):
    docs = spark.createDataFrame([(i, "the house and the tree") for i in range(30)], "doc_id long, text string")
    encoded = cross_align.encode_both(docs, A, B)
    rows = cross_align.count_links(encoded, cross_align.pair_of(A, B)).collect()
    assert rows and all(r.b == -1 and r.n % 30 == 0 for r in rows)


def test_groups_text(spark):
    docs = spark.createDataFrame([(1, "tokenizers align"), (2, None)], "doc_id long, text string")
    got = {r.id: r for r in cross_align.cross_align(docs, A, B, with_groups=True).collect()}
    assert hashlib.sha256(got[1].groups.encode()).hexdigest() == got[1].groups_sha256
    assert got[1].groups.count(";") + 1 == got[1].n_groups and got[2].groups == got[2].groups_sha256 == ""


def test_sorted_parts_with_a_small_cache(spark, monkeypatch):
    rows = spark.range(5000).selectExpr("id * 3 as key", "id as value")
    parts = sorted_parts.write(rows.repartition(4), "test-parts", part_rows=300)
    assert len(parts.names) > 10
    monkeypatch.setattr(sorted_parts, "CACHE_BYTES", 10_000)
    keys = np.arange(-5, 15_100, dtype=np.int64)
    want = np.where((keys >= 0) & (keys < 15_000) & (keys % 3 == 0), keys // 3, -7)
    assert (parts.find(keys, -7) == want).all()
    assert (sorted_parts.write(rows.limit(0), "none").find(keys, 9) == 9).all()
