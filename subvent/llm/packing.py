"""Packing documents into training sequences in the order of a space-filling curve.

Each document's ids are hashed into a short count vector, projected to a few dimensions by a fixed random matrix, and
placed on a Hilbert curve. Documents are range-sorted by that key, so neighbours along the curve, which use the same
words, share sequences. The sequences are cut from the one long row of ids in that order: all are full but for the
end, whose rest is cut into sequences of the powers of two that sum to it, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subvent.llm.common import binaries, chunked, column, slices, staged, strings, units_of

#: Dimensions of the hashed vector, of its projection, and bits of the key for each of the latter.
HASHED, DIMENSIONS, KEY_BITS = 64, 3, 16


def hilbert_key(points: np.ndarray, bits: int = KEY_BITS) -> np.ndarray:
    """Place of each point (unsigned integers of ``bits`` bits, one row each) along the Hilbert curve.

    Skilling, "Programming the Hilbert curve", 2004: undo the rotations from the highest bit down, then Gray decode.
    """
    x = [points[:, i].astype(np.int64).copy() for i in range(points.shape[1])]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(len(x)):
            inverted = (x[i] >> b & 1) == 1
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ flip) >> b & 1)
    return key


def curve_keys(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hilbert key of each document, from its ids; documents with the same ids have the same key."""
    every = np.arange(int(ids.max(initial=0)) + 1, dtype=np.uint64)
    place = (every * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(58)).astype(np.int64)[ids]
    place += np.repeat(np.arange(len(counts)) * HASHED, counts)
    vectors = np.sqrt(np.bincount(place, minlength=len(counts) * HASHED).reshape(-1, HASHED))
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors / np.where(norms == 0, 1, norms)
    matrix, _ = np.linalg.qr(np.random.default_rng(8).standard_normal((HASHED, DIMENSIONS)))
    spread = np.clip((np.round(vectors @ matrix, 9) + 1) / 2, 0, 1)
    return hilbert_key(np.minimum(spread * (1 << KEY_BITS), (1 << KEY_BITS) - 1).astype(np.int64))


def sequence_starts(total: int, length: int) -> np.ndarray:
    """Where the sequences after the last full one start, in ascending order, and the end: powers of two, largest first."""
    at, out = total - total % length, []
    rest = total % length
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append(at)
        at, rest = at + size, rest - size
    return np.asarray([*out, total], np.int64)


def cut(starts: np.ndarray, counts: np.ndarray, total: int, length: int) -> tuple[np.ndarray, ...]:
    """Pieces of documents that lie at ``starts`` in the long row: document, start, end, sequence, offset there."""
    full = total // length
    tail = sequence_starts(total, length)

    def sequence(at: np.ndarray) -> np.ndarray:
        return np.where(at < full * length, at // length, full + np.searchsorted(tail, at, side="right") - 1)

    def begin(k: np.ndarray) -> np.ndarray:
        return np.where(k <= full, k * length, tail[np.clip(k - full, 0, len(tail) - 1)])

    some = np.flatnonzero(counts)
    first, last = sequence(starts[some]), sequence(starts[some] + counts[some] - 1)
    pieces = last - first + 1
    doc = np.repeat(some, pieces)
    number = np.repeat(first - (np.cumsum(pieces) - pieces), pieces) + np.arange(pieces.sum())
    a = np.maximum(starts[doc], begin(number))
    b = np.minimum(starts[doc] + counts[doc], begin(number + 1))
    return doc, a - starts[doc], b - starts[doc], number, a - begin(number)


def pack(
    docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int | None = 0, text: str = "text", id_col: str = "doc_id",
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids`` (binary, little-endian
    unsigned 32-bit).

    A NULL text counts as empty and has its ``end_id`` alone; without an ``end_id`` it has no piece. Rows that share an
    id, a text or both are packed each; ties on the curve go by id and row. An empty table has no pieces. Texts never
    move: their ids are written once in chunks, and only keys and places are sorted, so equal documents, however many,
    load no task. With ``added_tokens`` the file's added tokens are found in texts, as by the tokenizers library.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(tokenizer, added_tokens)
        for batch in batches:
            texts = strings(batch, "text")
            for i, j in slices(texts):
                ids, counts = units.ids(texts.slice(i, j - i))
                keys = curve_keys(ids, counts)
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    counts = counts + 1
                data = binaries(ids.astype("<u4", copy=False), np.concatenate([[0], np.cumsum(counts)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(keys), pa.array(counts), data], ["doc_id", "key", "n", "ids"]
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    table = chunked(rows.mapInArrow(encode, "doc_id bigint, key bigint, n bigint, ids binary"), "packed")

    def run_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            ends = before + np.cumsum(np.asarray(batch.column("n")))
            starts = ends - np.asarray(batch.column("n"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_part", "_chunk", "_row", "n")), pa.array(starts)], ["_part", "_chunk", "_row", "n", "start"])
            before = int(ends[-1]) if len(ends) else before

    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    curve = staged(
        table.select("_chunk", "_row", "key", "doc_id", "n")
        .repartitionByRange(parts, "key", "doc_id", "_row")
        .sortWithinPartitions("key", "doc_id", "_row")
        .withColumn("_part", F.spark_partition_id())
        .mapInArrow(run_on, "_part int, _chunk bigint, _row bigint, n bigint, start bigint"),
        "curve",
    )
    totals = curve.groupBy("_part").agg(F.sum("n").alias("_n"))  # a row per partition
    total = totals.agg(F.sum("_n")).first()[0] or 0
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    places = curve.join(F.broadcast(base), "_part").select("_chunk", "_row", (F.col("start") + F.col("_base")).alias("start"))

    def pieces(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, at = column(left, "_row").to_numpy(), column(right, "_row").to_numpy()
        order = np.argsort(at)
        starts = column(right, "start").to_numpy()[order[np.searchsorted(at, rows, sorter=order)]] if len(rows) else np.zeros(0, np.int64)
        counts, data = column(left, "n").to_numpy(), column(left, "ids")
        doc, a, b, number, offset = cut(starts, counts, total, length)
        ids = [data[int(d)].as_buffer().to_pybytes()[4 * x : 4 * y] for d, x, y in zip(doc, a, b, strict=True)]
        return pa.table(
            {
                "doc_id": column(left, "doc_id").take(pa.array(doc)), "start": a, "length": b - a, "doc_tokens": counts[doc],
                "sequence_id": number, "offset": offset, "ids": pa.array(ids, pa.binary()),
            }
        )

    return (
        table.groupBy("_chunk")
        .cogroup(places.groupBy("_chunk"))
        .applyInArrow(
            pieces, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
        )
    )


def piece_checksums(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of ``ids``."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def padding(pieces: DataFrame, length: int = 1024) -> DataFrame:
    """One row: ``sequences``, ``tokens``, ``padded`` (what sequences lack to ``length``, none at a power of two)."""
    size = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return size.agg(
        F.count("*").alias("sequences"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(power, 0).otherwise(length - F.col("n"))), F.lit(0)).alias("padded"),
    )
