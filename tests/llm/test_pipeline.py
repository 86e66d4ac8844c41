"""The pipeline's stages, one after the other, and the registered queries on small tables."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from subvent.llm import queries
from test_texts import brute_classes, brute_repeats


@pytest.fixture(scope="module")
def documents(small):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{small}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    """The rows that each stage returned."""
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        columns = docs.columns
        found = stage(spark, docs, small)
        assert name == "packing" or found.columns == columns
        found.write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs
    return out


def test_names():
    assert list(contract.queries())[-1] == "pipeline"
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.REGISTERED}


def test_language_keeps_what_has_letters(stages, documents):
    kept = {r["doc_id"] for r in stages["language"].collect()}
    assert kept == {i for i, t, _ in documents if t and any(c.isalpha() for c in t)}


def test_quality_keeps_the_good(stages, small):
    labels = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{small}/labels.parquet'").fetchall()
    kept = {r["doc_id"] for r in stages["quality"].collect()}
    good = [i for i, q, toxic in labels if q == 1 and not toxic]
    bad = [i for i, q, _ in labels if q == 0]
    assert all(i in kept for i in good)
    assert sum(i in kept for i in bad) <= 0.3 * len(bad)


def test_one_of_each_class_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["quality"].collect()]
    assert {r["doc_id"] for r in stages["near_duplicates"].collect()} == {c for _, c, _, _ in brute_classes(rows)}


def test_passages_go(stages):
    before = {r["doc_id"]: r for r in stages["near_duplicates"].collect()}
    expected = {i: (removed, kept) for i, _, removed, kept in brute_repeats(sorted((i, r["text"]) for i, r in before.items()), 20)}
    after = stages["repeated_passages"].collect()
    assert len(after) == len(before)
    for r in after:
        removed, kept = expected[r["doc_id"]]
        assert r["text"] == (kept if removed else before[r["doc_id"]]["text"])
        assert r["n_chars"] == len(r["text"])
        assert (r["lang"], r["source"]) == (before[r["doc_id"]]["lang"], before[r["doc_id"]]["source"])


def test_all_ids_are_packed(stages):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    sizes = {}
    for r in stages["packing"].collect():
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
    texts = {r["doc_id"]: r["text"] for r in stages["repeated_passages"].collect()}
    assert sizes == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}


def test_run(spark, small, stages):
    order = ["sequence_id", "offset"]
    whole = [tuple(r) for r in corpus_pipeline.run(spark, small).orderBy(*order).collect()]
    assert whole == [tuple(r) for r in stages["packing"].orderBy(*order).collect()]


def test_op1(spark, small, documents):
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    found = {r["doc_id"]: r for r in queries.op1_token_files(spark, small).collect()}
    start = 0
    for i, t, _ in documents:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
        start += len(ids)


def test_op2(spark, medium):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{medium}/documents.parquet'").fetchall())
    found = [r for r in queries.op2_output_codes(spark, medium).collect() if r["held_out"]]
    assert len(found) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in langs)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in found]) > 0.99


def test_op5_recall(spark, medium):
    ids, vectors = zip(*duckdb.sql(f"SELECT vec_id, embedding FROM '{medium}/embeddings.parquet' ORDER BY vec_id").fetchall(), strict=True)
    ids, vectors = np.asarray(ids), np.asarray(vectors, np.float64)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    found = {(r["query_id"], r["vec_id"]) for r in queries.op5_prefix_forest(spark, medium).collect()}
    hits = []
    for q in np.flatnonzero(ids % 50 == 0):
        near = vectors @ vectors[q]
        near[q] = -9
        hits += [(ids[q], ids[k]) in found for k in np.argsort(-near)[:5]]
    assert np.mean(hits) >= 0.9


def test_op6(spark, small, documents):
    found = {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in queries.op6_count_min(spark, small).collect()}
    expected = brute_repeats([(i, t) for i, t, _ in documents], 20)
    assert found == {(i, n, removed, hashlib.sha256(kept.encode()).hexdigest()) for i, n, removed, kept in expected}


def test_op7(spark, small, documents):
    found = [tuple(r) for r in queries.op7_chosen_path(spark, small).select("doc_id", "class_id", "n_links", "n_copies").collect()]
    assert sorted(found, key=repr) == brute_classes([(i, t) for i, t, _ in documents])


def test_without_the_folder(tmp_path):
    """The other queries import where neither this folder nor the pipeline is there."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(contract.__file__))
    shutil.copytree(f"{root}/subvent", tmp_path / "subvent", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 30 and not any(k.startswith('op') or k == 'pipeline' for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
