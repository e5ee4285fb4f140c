"""The pipeline's stages, and the entry with and without this package."""
import re
import shutil
import subprocess
import sys
from pathlib import Path

import public_tokenizers as P
import sentencepiece as spm
from conftest import SF
from llm_data import awkward, documents, fresh, repeated

import __spark_entry__ as E
import corpus_pipeline as C
from intake_spark.llm.files import stored

ROOT = Path(__file__).resolve().parents[2]
NAMES = ["language_id", "near_dedup", "substring_dedup", "decontamination", "piece_encoding"]


def test_stages_each_work_on_what_the_last_left(spark):
    assert [n for n, _ in C.STAGES] == NAMES
    sf = SF["0.001"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in C.STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.8 * counts[0]
    left = {r.doc_id: r.text for r in docs.collect()}
    lib = spm.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = C.run(spark, sf).collect()
    assert {r.doc_id: list(r.ids) for r in got} == {d: lib.encode(t or "") for d, t in left.items()}


def test_awkward_rows_and_empty_tables(spark, tmp_path):
    for i, rows in enumerate((repeated(awkward(fresh())), [])):
        sf = str(tmp_path / f"in{i}")
        documents(spark, rows).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, None), (2, "word")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        out = C.run(spark, sf)
        assert out.columns[:3] == ["doc_id", "lang", "source"]
        assert out.count() <= len(rows)


def test_every_operator_is_registered():
    names = set(E.queries())
    assert "pipeline" in names
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert set(E.oracle_sql()) <= names


def test_entry_works_without_this_package(tmp_path):
    shutil.copytree(ROOT / "intake_spark", tmp_path / "intake_spark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"],
                          cwd=tmp_path, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin", "HOME": "/tmp"})
    assert said.stdout.split()[-1] == "False", said.stderr
