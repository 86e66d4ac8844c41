"""Quality by hierarchical empirical Bayes: evidence of a document's text and what is known of its site.

A logistic classifier over shapes of text gives each document a likelihood ratio of good against bad. Sums of the
expected good documents of each path and host are shrunk towards the host and towards the corpus: a path with few
documents takes its host's share of good ones, a host with few that of all. How strongly is itself estimated, from how
much hosts, and paths within hosts, differ beyond chance. A document's probability is the share of the others of its
site, updated by its own likelihood ratio, which so counts once.

Harm is told by words: those that labelled documents show to be surely commoner in harmful ones than in others.
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

from subvent.llm.common import SMALL_SLICE, field, forget_kept, shared, slices, staged, strings
from subvent.llm.substring import window_starts, word_hashes

#: Labelled documents that the classifier is fitted on, at most: those whose ids hash lowest, whatever the input's size.
TRAIN_ROWS = 20_000
#: Strength of the classifier's prior, steps of its fit, and bound of a document's log likelihood ratio.
RIDGE, STEPS, MOST_EVIDENCE = 1e-4, 30, 8.0
#: Documents good with at least this probability are kept.
KEEP = 0.5
#: Documents harmful with at least this probability are not kept; a word counts for what its log ratio is beyond so many standard errors.
HARMFUL, SURE = 0.5, 3.0
#: Bounds of the strength of a prior, in documents.
WEAKEST, STRONGEST = 1.0, 1e6

#: Classes of bytes, each a set of characters; all other bytes, of letters beyond ASCII, are the last class.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\v\f", "\n", ".", ",;:", "!?", "|", "'\"()-", "#$%&*@^~+=<>_/\\[]{}`")
N_CLASSES = len(CLASSES) + 1
N_FEATURES = N_CLASSES * N_CLASSES + 5
#: A text of so many bytes has half the weight of a long one as evidence.
HALF_BYTES = 32


def _class_table() -> np.ndarray:
    table = np.full(256, N_CLASSES - 1, np.int64)
    for k, chars in enumerate(CLASSES):
        table[[ord(c) for c in chars]] = k
    return table


_CLASS = _class_table()


def features(texts: pa.Array) -> np.ndarray:
    """A row per text: square roots of the shares of pairs of neighbouring classes; the shares of words that repeat the one
    before, and of runs of 3 words that occurred before in the text; word length, length, and 1."""
    raw = texts.cast(pa.large_binary()).to_pylist()
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    row = np.repeat(np.arange(len(texts)), lengths)
    kind = _CLASS[data]
    inside = row[1:] == row[:-1]
    pair = (row[:-1] * N_CLASSES + kind[:-1]) * N_CLASSES + kind[1:]
    counts = np.bincount(pair[inside], minlength=len(texts) * N_CLASSES**2).reshape(len(texts), -1)
    spaces = np.bincount(row[(kind == 3) | (kind == 4)], minlength=len(texts)) + 1
    out = np.empty((len(texts), N_FEATURES))
    out[:, :-5] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    out[:, -5], out[:, -4] = _repetition(texts)
    out[:, -3] = np.log1p(lengths / spaces)
    out[:, -2] = np.log1p(lengths) / 10
    out[:, -1] = 1
    return out


def _repetition(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words, _, n = word_hashes(texts)
    row = np.repeat(np.arange(len(n)), n)
    again = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    same = np.bincount(row[1:][again], minlength=len(n)) / np.maximum(n, 1)
    starts = window_starts(n, 3)
    if not len(starts):
        return same, np.zeros(len(n))
    with np.errstate(over="ignore"):
        runs = words * np.uint64(0x9E3779B97F4A7C15)
        runs = (runs[:-2] * np.uint64(3) + runs[1:-1]) * np.uint64(5) + runs[2:]
        key = np.sort((runs[starts] ^ row[starts].astype(np.uint64) << np.uint64(44)) & ~np.uint64(0xFFFFF) | row[starts].astype(np.uint64))
    old = (key[1:] == key[:-1]).nonzero()[0] + 1
    seen = np.bincount((key[old] & np.uint64(0xFFFFF)).astype(np.int64), minlength=len(n))
    return same, seen / np.maximum(n - 2, 1)


@dataclass(frozen=True)
class Classifier:
    """Weights over ``features`` and the log odds of good among the rows it was fitted on."""

    weights: np.ndarray
    base: float

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Log likelihood ratio of good against bad; the shorter the text, the nearer to 0."""
        n = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        found = np.clip(features(texts) @ self.weights - self.base, -MOST_EVIDENCE, MOST_EVIDENCE)
        return found * n / (n + HALF_BYTES)


def fit_classifier(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", rows: int = TRAIN_ROWS) -> Classifier:
    """Logistic regression on at most ``rows`` labelled documents, chosen by a hash of their ids.

    A document with several labels counts with their mean; those with a NULL id, text or label are left out. Without
    labels of both kinds there is no evidence: all likelihood ratios are 1.
    """
    found = _labelled(docs, labels, text, id_col, label, rows).withColumnRenamed("mean", "good")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for batch in batches:
            texts = strings(batch, "text")
            for i, j in slices(texts, SMALL_SLICE):
                x = features(texts.slice(i, j - i)).astype(np.float32)
                ends = np.arange(0, x.size + 1, N_FEATURES, dtype=np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), batch.column("good").slice(i, j - i), lists], ["id", "good", "x"])

    kind = found.schema["id"].dataType.simpleString()
    rows_found = found.mapInArrow(run, f"id {kind}, good double, x array<float>").toArrow()
    if not len(rows_found):
        return Classifier(np.zeros(N_FEATURES), 0.0)
    order = rows_found.sort_by([("id", "ascending")]).combine_chunks()  # sums in the same order in every run
    x = np.asarray(order.column("x").combine_chunks().flatten(), np.float64).reshape(-1, N_FEATURES)
    return _fitted(x, order.column("good").to_numpy())


def _labelled(docs: DataFrame, labels: DataFrame, text: str, id_col: str, label: str, rows: int) -> DataFrame:
    """``id``, ``text`` and the ``mean`` of the labels of at most ``rows`` labelled documents."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("mean")).filter("id IS NOT NULL AND mean IS NOT NULL")
    known = known.groupBy("id").agg(F.avg("mean").alias("mean")).orderBy(F.xxhash64("id"), "id").limit(rows)
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).filter("text IS NOT NULL").join(F.broadcast(known), "id")


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of letters in lower case, empty ones included, and the text of each."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\pL]+")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.repeat(np.arange(len(texts)), counts)


@dataclass(frozen=True)
class WordEvidence:
    """Words of harmful documents, their log likelihood ratios less ``SURE`` standard errors, and the log odds of harm."""

    words: tuple[str, ...]
    weights: np.ndarray
    base: float

    def probability(self, texts: pa.Array) -> np.ndarray:
        """Of harm, by the distinct known words of each text; 0 for a text that has none, whatever the share of harmful ones."""
        if not self.words:
            return np.zeros(len(texts))
        flat, row = _words(texts)
        at = pc.index_in(flat, value_set=pa.array(self.words, pa.large_string()))
        known = at.is_valid().to_numpy(zero_copy_only=False)
        pairs = np.unique(row[known] * len(self.words) + at.drop_null().to_numpy())
        odds = self.base + np.bincount(pairs // len(self.words), self.weights[pairs % len(self.words)], minlength=len(texts))
        some = np.bincount(row[known], minlength=len(texts)) > 0
        return np.where(some, 1 / (1 + np.exp(-np.clip(odds, -30, 30))), 0.0)


def fit_words(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic", rows: int = TRAIN_ROWS) -> WordEvidence:
    """Words that tell harm, from at most ``rows`` labelled documents, chosen as by :func:`fit_classifier`.

    Equal texts count once, as harmful if half of their labels or more say so. Without documents of both kinds no word tells anything.
    """
    found = staged(_labelled(docs, labels, text, id_col, label, rows).groupBy("text").agg((F.avg("mean") >= 0.5).alias("bad")), "harm_texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, bad = strings(batch, "text"), batch.column("bad")
            for i, j in slices(texts, SMALL_SLICE):
                flat, row = _words(texts.slice(i, j - i))
                coded = flat.dictionary_encode()
                size = max(1, len(coded.dictionary))
                pairs = np.unique(row * size + np.asarray(coded.indices))
                words = coded.dictionary.take(pa.array(pairs % size))
                yield pa.RecordBatch.from_arrays([words.cast(pa.string()), bad.slice(i, j - i).take(pa.array(pairs // size))], ["word", "bad"])

    n, n_bad = found.agg(F.count("*"), F.count_if("bad")).first()
    if not 0 < n_bad < n:
        return WordEvidence((), np.zeros(0), 0.0)
    n_good = n - n_bad
    counts = found.mapInArrow(run, "word string, bad boolean").filter("word != ''").groupBy("word").agg(F.count_if("bad").alias("a"), F.count_if(~F.col("bad")).alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    ratio = F.log(a / (n_bad + 1)) - F.log(b / (n_good + 1)) - SURE * F.sqrt(1 / a + 1 / b)
    told = counts.select("word", ratio.alias("weight")).filter("weight > 0").orderBy("word").collect()  # of the sample's words
    return WordEvidence(tuple(r["word"] for r in told), np.array([r["weight"] for r in told]), float(np.log(n_bad / n_good)))


def _fitted(x: np.ndarray, good: np.ndarray) -> Classifier:
    share = float(good.mean())
    if not 0 < share < 1:
        return Classifier(np.zeros(x.shape[1]), 0.0)
    base = float(np.log(share / (1 - share)))
    w = np.zeros(x.shape[1])
    w[-1] = base
    ridge = RIDGE * len(x) * np.ones(x.shape[1])
    ridge[-1] = 0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (good - p) - ridge * w
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return Classifier(w, base)


def strength(groups: DataFrame, n: str, good: str, prior: Column) -> float:
    """Documents that a prior counts for, by moments: what shares of groups differ beyond what chance alone gives.

    ``prior`` is the share that a group is shrunk towards. With x = share - prior, E x^2 = p (1 - p) (1 / n + (1 - 1 / n) / (s + 1))
    for a strength s; solved from the sums over all groups, weighted by their documents.
    """
    p = prior
    size, x = F.col(n).cast("double"), F.col(good) / F.col(n) - p
    spread = p * (1 - p)
    row = groups.agg(F.sum(size * x * x).alias("seen"), F.sum(spread).alias("chance"), F.sum((size - 1) * spread).alias("more")).first()
    seen, chance, more = row["seen"], row["chance"], row["more"]
    if not seen or not more or seen <= chance:
        return STRONGEST if more else WEAKEST
    return float(min(STRONGEST, max(WEAKEST, more / (seen - chance) - 1)))


def posterior(
    docs: DataFrame,
    classifier: Classifier,
    host: Column,
    path: Column,
    text: str = "text",
    keep: float = KEEP,
    harm: WordEvidence | None = None,
) -> DataFrame:
    """Per row: ``doc`` (a struct of the row, as it was), ``evidence``, ``host_good``, ``path_good``, ``p_good``, ``p_harm``, ``keep``.

    Shares of host and path are those of their other rows: a row's own evidence is in ``p_good`` once. A path or host of one row takes
    the share above it, and a table of one row that of the labels. ``keep`` asks for ``p_good`` of ``keep`` and ``p_harm`` below ``HARMFUL``;
    without ``harm``, ``p_harm`` is 0.

    ``host`` and ``path`` are expressions over ``docs``; a path belongs to its host. NULL is a host, or a path of a host, like any
    other. A NULL or empty text is no evidence: its probability is its path's. Rows with the same id count each. The row
    is kept in a struct, so its columns may have any names. An empty table gives no rows.

    Sites are grouped sums, combined before the shuffle, whatever a host's share of all rows. Documents meet their site's row
    in a join whose right side is one row per site; if it is too large to be broadcast, Spark splits a large site's rows.
    """
    spark = docs.sparkSession
    held = shared(spark, (classifier, harm or WordEvidence((), np.zeros(0), 0.0)))
    site = [host.cast("string").alias("host"), path.cast("string").alias("path")]
    wrapped = docs.select(F.struct("*").alias("doc"), *site)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        own, words = held()
        for batch in batches:
            texts = field(batch.column("doc"), text) if "doc" in batch.schema.names else strings(batch, "_text")
            for i, j in slices(texts, SMALL_SLICE):
                some, part = texts.slice(i, j - i), batch.slice(i, j - i)
                found = {"evidence": pa.array(own.evidence(some))}
                if "doc" in part.schema.names:
                    found["p_harm"] = pa.array(words.probability(some))
                names = [c for c in part.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays([*map(part.column, names), *found.values()], [*names, *found])

    sites = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path")] + [T.StructField("evidence", T.DoubleType())])
    whole = T.StructType([T.StructField("doc", wrapped.schema["doc"].dataType), *sites.fields, T.StructField("p_harm", T.DoubleType())])
    chance = F.lit(1.0) / (1.0 + F.exp(-(F.col("evidence") + F.lit(classifier.base))))
    own = F.round(chance, 9).cast("decimal(28,9)")  # a decimal: sums do not depend on the order of rows
    seen = docs.select(F.col(text).alias("_text"), *site).mapInArrow(run, sites)
    paths = staged(seen.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(own).cast("double").alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum(F.col("good").cast("decimal(28,9)")).cast("double").alias("hgood"))
    total = hosts.agg(F.sum("hn"), F.sum(F.col("hgood").cast("decimal(28,9)"))).first()
    n, good = (total[0], float(total[1])) if total[0] else (0, 0.0)
    overall = min(1 - 1e-6, max(1e-6, good / n)) if n else 0.5
    of_host = strength(hosts, "hn", "hgood", F.lit(overall))
    named = hosts.select(F.col("host").alias("of"), "hn", "hgood")
    shrunk = (F.col("hgood") + of_host * overall) / (F.col("hn") + of_host)
    paths = staged(paths.join(named, F.col("host").eqNullSafe(F.col("of"))).drop("of").withColumn("prior", shrunk), "paths")
    of_path = strength(paths, "n", "good", F.col("prior"))
    priors = paths.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "good", "hn", "hgood")
    inside = lambda share: F.least(F.greatest(share, F.lit(1e-6)), F.lit(1 - 1e-6))
    mine = own.cast("double")
    others = inside((F.lit(good) - mine) / (n - 1)) if n > 1 else F.lit(float(1 / (1 + np.exp(-classifier.base))))
    host_good = inside((F.col("hgood") - mine + of_host * others) / (F.col("hn") - 1 + of_host))
    path_good = inside((F.col("good") - mine + of_path * F.col("host_good")) / (F.col("n") - 1 + of_path))
    odds = F.log(F.col("path_good") / (1 - F.col("path_good"))) + F.col("evidence")
    kept = (F.col("p_good") >= keep) & (F.col("p_harm") < HARMFUL)
    return (
        wrapped.mapInArrow(run, whole)
        .join(priors, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")), "left")
        .withColumn("host_good", host_good)
        .withColumn("path_good", path_good)
        .withColumn("p_good", 1.0 / (1.0 + F.exp(-odds)))
        .select("doc", "evidence", "host_good", "path_good", "p_good", "p_harm", kept.alias("keep"))
    )
