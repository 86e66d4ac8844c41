"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit, a binary classifier over hashed byte n-grams learns, from the texts of all
languages with a 1 and of all with a 0, the log odds of either. A text's log odds are decoded to the codeword with
the smallest loss, each bit weighted by how well it separates; a text that two codewords fit nearly as well is ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subvent.llm.common import SMALL_SLICE, field, forget_kept, shared, slices, strings

#: Lengths of the n-grams in bytes, and hashed features of each length.
GRAMS, FEATURE_BITS = (2, 3, 4), 14
#: All splits of the languages into two up to so many languages, random codes of RANDOM_BITS bits beyond.
MOST_EXHAUSTIVE, RANDOM_BITS = 5, 48
#: Added to the count of every feature.
SMOOTHING = 0.5
#: An n-gram's log odds are less than independent evidence; a text's sum is divided by this times its square root of n-grams.
TEMPER = 1.0
#: The score below which a text is ambiguous: the share of the nearest codeword against the second.
AMBIGUOUS = 0.6
UNKNOWN = "und"


def code_words(languages: int) -> np.ndarray:
    """A row of +1 and -1 per language, all different; no column has the same sign for all."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= MOST_EXHAUSTIVE:
        splits = range(1, 1 << (languages - 1))  # the first language is always 0: a split and its opposite are the same
        return np.asarray([[1.0 if s << 1 >> k & 1 else -1.0 for s in splits] for k in range(languages)])
    bits = max(RANDOM_BITS, 4 * (languages - 1).bit_length())
    best, far = None, -1
    for seed in range(64):  # of some random codes the one whose nearest words are farthest apart
        words = np.random.default_rng(seed).choice([-1.0, 1.0], (languages, bits))
        apart = (bits - words @ words.T) / 2
        least = (apart + np.eye(languages) * bits).min()
        if least > far and (np.abs(words.sum(axis=0)) < languages).all():
            best, far = words, least
    return best


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, and a weight per feature and bit."""

    languages: tuple[str, ...]
    words: np.ndarray
    weights: np.ndarray
    bit_weights: np.ndarray


def _grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of n-gram: its feature, and the number of n-grams of each text. Case, digits and signs do not count."""
    low = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " ")
    words = low.cast(pa.large_binary()).to_pylist()
    data = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8).astype(np.uint32)  # a space on both sides of each
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    for order, n in enumerate(GRAMS):
        code = np.zeros(max(0, len(data) - n + 1), np.uint32)
        for k in range(n):
            code = code << np.uint32(8) | data[k : len(data) - n + 1 + k]
        with np.errstate(over="ignore"):
            code = (code ^ code >> np.uint32(15)) * np.uint32(0x9E3779B1)
        feature = (code >> np.uint32(32 - FEATURE_BITS)).astype(np.int32) + (order << FEATURE_BITS)
        inside = np.ones(len(feature), bool)  # not across two texts
        for k in range(1, n):
            at = ends[:-1] - k
            inside[at[(at >= 0) & (at < len(inside))]] = False
        yield feature[inside], np.maximum(lengths - n + 1, 0)


def has_letter(texts: pa.Array) -> np.ndarray:
    return np.asarray(pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False), bool)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows whose ``text`` and ``lang`` are there.

    Features are counted in each task and summed by language and feature; only these sums, at most languages times
    len(GRAMS) * 2^FEATURE_BITS, reach the driver. No rows give a model without languages, which finds every text unknown.
    """
    size = len(GRAMS) << FEATURE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = strings(batch, "text")
            for i, j in slices(texts, SMALL_SLICE):
                coded = batch.column("lang").slice(i, j - i).dictionary_encode()
                codes, names = np.asarray(coded.indices), coded.dictionary.to_pylist()
                for feature, counts in _grams(texts.slice(i, j - i)):
                    joint = np.bincount(np.repeat(codes, counts).astype(np.int64) * size + feature, minlength=len(names) * size)
                    for name, row in zip(names, joint.reshape(-1, size), strict=True):
                        total[name] = total[name] + row if name in total else row
        for name, row in total.items():
            some = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(row[some])], ["lang", "feature", "n"])

    known = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    sums = known.mapInArrow(count, "lang string, feature bigint, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    found = sums.toArrow().to_pandas()
    languages = tuple(sorted(found["lang"].unique()))
    counts = np.zeros((len(languages), size))
    counts[np.searchsorted(languages, found["lang"]) if languages else [], found["feature"].to_numpy(np.int64)] = found["n"]
    return _learned(languages, counts)


def _learned(languages: tuple[str, ...], counts: np.ndarray) -> Model:
    words = code_words(len(languages))
    if len(languages) < 2:
        return Model(languages, words, np.zeros((counts.shape[1], words.shape[1] if len(words) else 1), np.float32), np.ones(1))
    share = np.zeros_like(counts)
    for order in range(len(GRAMS)):
        part = slice(order << FEATURE_BITS, (order + 1) << FEATURE_BITS)
        some = counts[:, part] + SMOOTHING
        share[:, part] = some / some.sum(axis=1, keepdims=True)
    weights, separation = [], []
    for bit in words.T:  # each side is the mean of its languages, so that large ones do not outweigh small ones
        one, zero = share[bit > 0].mean(axis=0), share[bit < 0].mean(axis=0)
        odds = np.log(one / zero)
        weights.append(odds)
        separation.append(float(((one - zero) * odds).sum()))
    bit_weights = np.asarray(separation)
    return Model(languages, words, np.asarray(weights, np.float32).T.copy(), bit_weights / bit_weights.sum())


def _decode(model: Model, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword of each row of log odds by weighted logistic loss, its score, and the margin to the second."""
    loss = np.logaddexp(0, -odds[:, None, :] * model.words[None]) @ model.bit_weights
    order = np.argsort(loss, axis=1, kind="stable")
    near = np.take_along_axis(loss, order, 1)
    likely = np.exp(-(loss - near[:, :1]))
    score = 1 / likely.sum(axis=1)
    against = 1 / (1 + np.exp(-(near[:, 1] - near[:, 0]))) if loss.shape[1] > 1 else np.ones(len(loss))
    return order[:, 0], score, against


def _odds(model: Model, texts: pa.Array) -> np.ndarray:
    """Tempered log odds of each text and bit."""
    out = np.zeros((len(texts), model.weights.shape[1]))
    total = np.zeros(len(texts))
    for feature, counts in _grams(texts):
        some = np.flatnonzero(counts)
        if not len(some):
            continue
        at = (np.cumsum(counts) - counts)[some]
        for bit in range(out.shape[1]):
            out[some, bit] += np.add.reduceat(model.weights[:, bit][feature], at)
        total += counts
    return out / (TEMPER * np.sqrt(np.maximum(total, 1)))[:, None]


def scores(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score from 0 to 1 and ambiguity of each text (NULL as empty)."""
    letters = has_letter(texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    nearest, score, against = _decode(model, _odds(model, texts))
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(nearest, letters, strict=True)]
    return names, np.where(letters, score, 0.0), ~letters | (against < AMBIGUOUS)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Per row: ``doc`` (a struct of the row, as it was), ``lang_pred``, ``score``, ``ambiguous``.

    ``lang_pred`` is a learned language, or `und` (score 0, ambiguous) for a NULL text, one without a letter, or if none was
    learned. Only the text decides. The row is kept in a struct, so its columns may have any names. No row moves.
    """
    spark = docs.sparkSession
    held = shared(spark, model)  # languages times features, whatever the corpus
    wrapped = docs.select(F.struct("*").alias("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        own = held()
        for batch in batches:
            texts = field(batch.column("doc"), text)
            for i, j in slices(texts, SMALL_SLICE):
                names, score, unsure = scores(own, texts.slice(i, j - i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(i, j - i), pa.array(names, pa.string()), pa.array(score), pa.array(unsure)],
                    ["doc", "lang_pred", "score", "ambiguous"],
                )

    out = [("doc", wrapped.schema["doc"].dataType), ("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType())]
    return wrapped.mapInArrow(run, T.StructType([T.StructField(*x) for x in out]))


def held_out(id_col: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, modulo 4, is 2. A NULL id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2
