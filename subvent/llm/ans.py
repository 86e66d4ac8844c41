"""Token ids in files of interleaved range asymmetric numeral systems (rANS).

One static frequency table, counted over the whole corpus, is shared by all blocks. A block holds the ids of whole
documents and is coded on its own by ``lanes`` interleaved states, so that numpy works on all lanes at once. It carries
checkpoints (the states and the place in its words after every so many steps) from which parts of it can be decoded
in parallel, and checksums of its words and of its ids.

Format, in a folder: ``table`` (parquet: id, frequency of 2^SCALE_BITS), ``blocks/file=N`` (parquet, a row per block, in
ascending order of document). Blocks of file N come before those of file N + 1.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subvent.llm.common import slices, staged, strings, units_of

#: Frequencies of the table sum to this power of two.
SCALE_BITS = 20
#: States are kept in [2^31, 2^63); a word of 32 bits moves out or in.
LOW, WORD_BITS = 1 << 31, 32
LANES = 1024
#: A block is closed at this many ids; one longer document makes a longer block.
BLOCK_IDS = 1 << 18
#: Steps (of one id per lane) between checkpoints.
CHECKPOINT_STEPS = 128


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2^SCALE_BITS, near to ``counts``; the commonest id takes what is left."""
    total = 1 << SCALE_BITS
    if len(counts) >= total:
        raise ValueError(f"a vocabulary of {len(counts)} ids needs a larger scale than 2^{SCALE_BITS}")
    share = counts.astype(np.float64) / max(1, counts.sum())
    freq = 1 + np.floor(share * (total - len(counts))).astype(np.int64)
    freq[int(counts.argmax())] += total - freq.sum()
    return freq


class Coder:
    """Encoder and decoder with one frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.int32), freq.astype(np.int64))

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> dict:
        """Words and checkpoints of one block; id k is coded by lane k mod ``lanes`` in step k div ``lanes``."""
        lanes = max(1, min(lanes, len(ids)))
        steps = -(-len(ids) // lanes)
        freq, before = self.freq[ids], self.before[ids]
        most = freq << np.uint64(63 - SCALE_BITS)
        state = np.full(lanes, LOW, np.uint64)
        words, moved, marks = [], 0, []
        scale, word = np.uint64(SCALE_BITS), np.uint64(WORD_BITS)
        for step in range(steps - 1, -1, -1):  # the decoder goes the other way
            part = slice(step * lanes, min(len(ids), (step + 1) * lanes))
            now = state[: part.stop - part.start]
            full = now >= most[part]
            out = now[full]
            if len(out):
                words.append((out & np.uint64(0xFFFFFFFF)).astype("<u4")[::-1])
                moved += len(out)
                now[full] = out >> word
            f = freq[part]
            quotient = now // f
            now[:] = (quotient << scale) + (now - quotient * f) + before[part]
            if step % every == 0:
                marks.append((step, moved, state.copy()))
        marks.reverse()
        data = np.concatenate(words)[::-1].astype("<u4").tobytes() if words else b""
        return {
            "n_ids": len(ids),
            "lanes": lanes,
            "words": data,
            "mark_steps": [m[0] for m in marks],
            "mark_words": [moved - m[1] for m in marks],
            "mark_states": b"".join(m[2].astype("<u8").tobytes() for m in marks),
            "words_crc32": zlib.crc32(data),
            "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()),
        }

    def decode_part(self, block: dict, mark: int) -> np.ndarray:
        """The ids from one checkpoint to the next (or the end): parts need nothing of one another."""
        lanes, n, steps = block["lanes"], block["n_ids"], block["mark_steps"]
        words = np.frombuffer(block["words"], "<u4")
        state = np.frombuffer(block["mark_states"], "<u8")[mark * lanes : (mark + 1) * lanes].copy()
        at = block["mark_words"][mark]
        first = steps[mark]
        last = steps[mark + 1] if mark + 1 < len(steps) else -(-n // lanes)
        out = np.empty(min(n, last * lanes) - first * lanes, np.int32)
        low, mask, scale, word = np.uint64(LOW), np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(WORD_BITS)
        for step in range(first, last):
            part = slice((step - first) * lanes, min(len(out), (step - first + 1) * lanes))
            now = state[: part.stop - part.start]
            slot = now & mask
            ids = self.symbol[slot]
            out[part] = ids
            now[:] = self.freq[ids] * (now >> scale) + slot - self.before[ids]
            short = now < low
            n_short = int(np.count_nonzero(short))
            if n_short:
                now[short] = (now[short] << word) | words[at : at + n_short]
                at += n_short
        return out

    def decode(self, block: dict) -> np.ndarray:
        """All ids of a block, checked against both checksums."""
        if zlib.crc32(block["words"]) != block["words_crc32"]:
            raise ValueError("a block's words do not match their checksum")
        parts = [self.decode_part(block, k) for k in range(len(block["mark_steps"]))]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != block["ids_crc32"]:
            raise ValueError("a block's ids do not match their checksum")
        return ids


_BLOCK = (
    "n_ids bigint, lanes int, words binary, mark_steps array<int>, mark_words array<bigint>, mark_states binary, "
    "words_crc32 bigint, ids_crc32 bigint"
)
_PLACE = "block int, start_in_file bigint, doc_ids array<bigint>, lengths array<bigint>"


def _raw_type(vocabulary: int) -> str:
    """The type of uncoded ids."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _raw_blocks(
    docs: DataFrame, tokenizer: str, end_id: int | None, text: str, id_col: str, block_ids: int, vocabulary: int, added_tokens: bool
) -> DataFrame:
    """Documents in ascending order, encoded and gathered into blocks of uncoded ids. A file's last row, of block -1, has how
    often each id occurs in the file (64-bit) and nothing else."""
    spark = docs.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = (
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("file", F.spark_partition_id())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(tokenizer, added_tokens)
        block, start, file = 0, 0, 0
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        size = 0
        total = np.zeros(vocabulary, np.int64)
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())

        def row(*values: object) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, kinds, strict=True)],
                ["file", "block", "start_in_file", "doc_ids", "lengths", "ids", "id_counts"],
            )

        def close() -> pa.RecordBatch:
            nonlocal block, start, doc_ids, lengths, held, size, total
            ids = np.concatenate(held)
            total += np.bincount(ids, minlength=vocabulary)  # refuses an id beyond the vocabulary
            out = row(file, block, start, doc_ids, lengths, ids.astype(_raw_type(vocabulary)).tobytes(), None)
            block, start = block + 1, start + size
            doc_ids, lengths, held, size = [], [], [], 0
            return out

        for batch in batches:
            texts, names = strings(batch, "text"), batch.column("doc_id").to_pylist()
            if len(names):
                file = batch.column("file")[0].as_py()
            for i, j in slices(texts):
                ids, counts = units.ids(texts.slice(i, j - i))
                ends = np.cumsum(counts)
                if end_id is not None:
                    ids = np.insert(ids, ends, end_id)
                    counts = counts + 1
                    ends = np.cumsum(counts)
                done = 0
                while done < j - i:
                    begin = int(ends[done - 1]) if done else 0
                    upto = min(j - i, max(done + 1, int(np.searchsorted(ends, begin + block_ids - size, side="right"))))
                    held.append(ids[begin : ends[upto - 1]])
                    doc_ids += names[i + done : i + upto]
                    lengths += counts[done:upto].tolist()
                    size += int(ends[upto - 1]) - begin
                    done = upto
                    if size >= 0.9 * block_ids:
                        yield close()
        if doc_ids:
            yield close()
        if block:
            yield row(file, -1, start, [], [], None, total.astype("<i8").tobytes())

    return ordered.mapInArrow(run, f"file int, {_PLACE}, ids binary, id_counts binary")


def _id_counts(raw: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all files; at most ``vocabulary`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for data in batch.column("id_counts"):
                total += np.frombuffer(data.as_buffer(), "<i8")
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    counted = raw.filter("block < 0").select("id_counts").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(vocabulary, np.int64)
    for row in counted:
        out[row["id"]] = row["n"]
    return out


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = None,
    vocabulary: int = 1 << 16,
    text: str = "text",
    id_col: str = "doc_id",
    block_ids: int = BLOCK_IDS,
    lanes: int = LANES,
    added_tokens: bool = False,
) -> None:
    """Encode every whole text with a tokenizers file and write the ids into the new folder ``path``.

    Documents are in ascending order of ``id_col`` (NULL first); rows that share an id follow the order of their texts. A
    NULL text counts as empty; ``end_id`` is appended to each document. All ids lie below ``vocabulary``. With
    ``added_tokens`` the file's added tokens are found in texts, as by the tokenizers library. The texts are
    shuffled once; no group is collected: blocks close at ``block_ids``. An empty table gives an empty ``blocks``.
    """
    spark = docs.sparkSession
    raw = staged(_raw_blocks(docs, tokenizer, end_id, text, id_col, block_ids, vocabulary, added_tokens), "token_blocks")
    freq = scaled_frequencies(_id_counts(raw, vocabulary))
    table = spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq)], "id int, frequency bigint")
    table.coalesce(1).write.parquet(f"{path}/table")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for row in batch.to_pylist():
                block = coder.encode(np.frombuffer(row.pop("ids"), _raw_type(vocabulary)).astype(np.int64), lanes)
                yield pa.RecordBatch.from_pylist([row | block], schema=schema)

    kinds = {"lanes": pa.int32(), "block": pa.int32(), "file": pa.int32(), "words": pa.binary(), "mark_states": pa.binary()}
    kinds |= {"mark_steps": pa.list_(pa.int32()), **dict.fromkeys(("mark_words", "doc_ids", "lengths"), pa.list_(pa.int64()))}
    names = [x.split()[0] for x in f"file int, {_PLACE}, {_BLOCK}".split(", ")]
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in names])
    (
        raw.filter("block >= 0")
        .drop("id_counts")
        .mapInArrow(run, f"file int, {_PLACE}, {_BLOCK}")
        .sortWithinPartitions("file", "block")
        .write.partitionBy("file")
        .option("compression", "none")
        .parquet(f"{path}/blocks")
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the folder: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (binary,
    little-endian unsigned 32-bit integers). Blocks are decoded on their own, in any number of tasks."""
    table = spark.read.schema("id int, frequency bigint").parquet(f"{path}/table")
    blocks = spark.read.schema(f"{_PLACE}, {_BLOCK}, file int").parquet(f"{path}/blocks")
    freq = np.zeros(table.count(), np.int64)
    for row in table.collect():
        freq[row["id"]] = row["frequency"]
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))  # a row per file
    base = files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for row in batch.to_pylist():
                raw = coder.decode(row).astype("<u4").tobytes()
                ends = np.cumsum([0, *row["lengths"]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends[:-1] + row["base"] + row["start_in_file"]),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array([raw[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.join(F.broadcast(base), "file").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
