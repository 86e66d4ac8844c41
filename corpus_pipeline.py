"""From raw documents to packed training sequences: language, quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but the last return the
columns of documents. ``run`` writes each stage's rows as Parquet into the shared folder and reads them for the next.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subvent.llm import chosen_path, langid, packing, quality, substring
from subvent.sources.staging import drop_paths, new_path, written_paths


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: What the stage called last has staged on its way, by application.
_left: dict[str, list[str]] = {}


def _cleared(stage: Stage) -> Stage:
    """``stage``, deleting first what the one before it has staged: its rows are written by the time the next is called."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = spark.sparkContext.applicationId
        drop_paths(spark, _left.pop(key, []))
        before = set(written_paths(spark))
        found = stage(spark, docs, sf_dir)
        _left[key] = [p for p in written_paths(spark) if p not in before]
        return found

    return run


@_cleared
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a known language: those with a letter that some language's codeword is nearest to.

    The classifiers are learned from the documents with a ``lang`` that are not held out. Ambiguous documents stay: a short
    clean one is often so.
    """
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs, model)
    return found.filter(F.col("lang_pred") != langid.UNKNOWN).select("doc.*")


@_cleared
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are more likely good than bad, by their text, source and language, and not toxic by their words."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    classifier, harm = quality.fit_classifier(docs, labels), quality.fit_words(docs, labels)
    found = quality.posterior(docs, classifier, host=F.col("source"), path=F.col("lang"), harm=harm)
    return found.filter("keep").select("doc.*")


@_cleared
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each class of near duplicates."""
    return chosen_path.jaccard_classes(docs).filter("keep").select("doc.*")


@_cleared
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the words of 20-word windows that also start earlier; other texts stay as they were. ``n_chars`` follows."""
    found = substring.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("doc.text"))
    changed = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return found.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


@_cleared
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 ids along the curve, a row per piece of a document."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.piece_checksums(packing.pack(docs, path, length=1024, end_id=0, added_tokens=True))


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: SQL cannot express the classifiers and the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the last one's rows, of which alone a table is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done: list[str] = []
    for name, stage in STAGES:
        path = new_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        drop_paths(spark, done)
        done = [path]
    drop_paths(spark, _left.pop(spark.sparkContext.applicationId, []))
    return docs
