"""Substring deduplication: windows of words that also start earlier lose their words.

1. Sketch. Documents lie in chunks. Each chunk counts its windows in a count-min sketch of a few rows of cells, kept sparse
   (the cells that are not 0, sorted) and cut into segments. Segments of all chunks are merged by adding their cells.
   A cell is never below the count of any of its windows, so a window with a cell of 1 occurs once, for certain.
2. Exact pass. The merged segments send each chunk one bit per cell it had sent: at least two, or not. Only windows
   whose cells all say two go on, as 128-bit hashes with their place, one per chunk, and are grouped exactly.
3. Each chunk hears which of its windows start earlier in another chunk, adds those that start earlier in itself, and
   removes the words they cover.

The number of segments grows with the corpus, and nothing else does: no sketch is broadcast, collected, or of a size that
fills up. Texts are read three times and never shuffled. A window that a third of all documents share is one entry of
each chunk.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subvent.llm.common import chunked, column, field, forget_kept, slices

#: Words of a window; rows of the sketch.
WINDOW, DEPTH = 20, 2
#: Windows that a segment is made for, and its cells: 16 for each of them.
SEGMENT_WINDOWS, CELL_BITS = 4 << 20, 26
#: Characters of text for each window, at least; only sizes the sketch.
CHARS_PER_WINDOW = 4
#: A step between cells that does not fit in 16 bits is sent as several; this value adds itself and names no cell.
FAR = 65535

_MULTIPLIERS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))  # odd: a product with them loses nothing


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both halves of the 128-bit hash of every word, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in words]), "<u8").reshape(-1, 2)
    codes = np.asarray(coded.indices)
    empty = next((k for k, w in enumerate(words) if not w), None)
    counts = np.diff(offsets)
    if empty is not None:  # at either end of a text
        real = codes != empty
        counts = np.diff(np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]])
        codes = codes[real]
    return hashes[codes, 0], hashes[codes, 1], counts


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``; different values stay different."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _rolled(words: np.ndarray, size: int, multiplier: np.uint64) -> np.ndarray:
    """Hash of each run of ``size`` words, put together from runs of powers of two."""
    n = len(words) - size + 1
    run, power, length = words, multiplier, 1
    out, done = None, 0
    rest = size
    while rest:
        if rest & 1:
            out = run[:n].copy() if out is None else out * power + run[done : done + n]
            done += length
        rest >>= 1
        if rest:
            run = run[:-length] * power + run[length:]
            power, length = power * power, 2 * length
    return _mixed(out)


def window_starts(counts: np.ndarray, size: int) -> np.ndarray:
    """Places of the first words of all windows that lie inside one document."""
    ends = np.cumsum(counts)
    n = np.maximum(counts - size + 1, 0)
    return np.repeat(ends - counts - (np.cumsum(n) - n), n) + np.arange(n.sum())


def window_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of all windows of all ``texts``, in order, and the number of words of each text."""
    found = []
    with np.errstate(over="ignore"):
        for i, j in slices(texts):
            first, second, counts = word_hashes(texts.slice(i, j - i))
            starts = window_starts(counts, size)
            if len(starts):
                found.append((_rolled(first, size, _MULTIPLIERS[0])[starts], _rolled(second, size, _MULTIPLIERS[1])[starts], counts))
            else:
                found.append((np.zeros(0, np.uint64), np.zeros(0, np.uint64), counts))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _cells(hashes: np.ndarray, row: int, segments: int) -> np.ndarray:
    """Each window's cell in one row of the sketch: segment above CELL_BITS, cell of the segment below."""
    with np.errstate(over="ignore"):
        mixed = _mixed(hashes + np.uint64(row + 1) * np.uint64(0x9E3779B97F4A7C15))
    segment = ((mixed >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    return (segment << np.uint64(CELL_BITS) | mixed & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)


def _steps(cells: np.ndarray) -> bytes:
    """Sorted cells of a segment as 16-bit steps."""
    steps = np.diff(cells, prepend=0)
    far = steps // FAR
    if not far.any():
        return steps.astype("<u2").tobytes()
    out = np.full(len(steps) + int(far.sum()), FAR, "<u2")
    out[np.cumsum(far + 1) - 1] = steps % FAR
    return out.tobytes()


def _from_steps(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, "<u2").astype(np.int64)
    return np.cumsum(steps)[steps != FAR]


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _from_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _segments_of(keys: np.ndarray, shift: int, segments: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange(segments + 1, dtype=np.int64) << shift)


class _Chunk:
    """The documents of a chunk in order: by id (NULL first), then as they were read."""

    def __init__(self, table: pa.Table, text: str, id_col: str, size: int):
        forget_kept()
        doc = column(table, "doc")
        ids = pc.struct_field(doc, [id_col]).cast(pa.int64())
        known = np.asarray(pc.fill_null(ids, np.iinfo(np.int64).min))
        self.order = np.lexsort((column(table, "_row").to_numpy(), known))
        self.ids = known[self.order]
        self.texts = field(doc, text).take(pa.array(self.order))
        self.first, self.second, self.counts = window_hashes(self.texts, size)
        self.windows = np.maximum(self.counts - size + 1, 0)

    def distinct(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the windows at ``some`` (ascending): the first of each equal set, and for each window its set's number."""
        a, b = self.first[some], self.second[some]
        order = np.argsort(a, kind="stable")
        same = a[order][1:] == a[order][:-1]
        if (same & (b[order][1:] != b[order][:-1])).any():
            order = np.lexsort((b, a))
            same = a[order][1:] == a[order][:-1]
        new = np.concatenate([[True], ~(same & (b[order][1:] == b[order][:-1]))]) if len(some) else np.zeros(0, bool)
        number = np.empty(len(some), np.int64)
        number[order] = np.cumsum(new) - 1
        return some[order[new]], number


def remove_repeats(
    docs: DataFrame, size: int = WINDOW, text: str = "text", id_col: str = "doc_id", depth: int = DEPTH, segments: int | None = None
) -> DataFrame:
    """Per document: ``doc`` (a struct of its row, as it was), ``n_words``, ``n_removed``, ``kept`` (the words left, with one space between).

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A word goes if a window of ``size`` words over it also starts earlier: in a document
    with a smaller id, or earlier in the same document; windows are those of the input. A NULL text has no words, a text
    shorter than a window loses none. Rows with the same id are documents of their own, in the order in which they are
    read; a NULL id comes first. The row is kept in a struct, so its columns may have any names. An empty table gives
    no rows.
    """
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    segments = segments or max(1, math.ceil(chars / CHARS_PER_WINDOW / SEGMENT_WINDOWS))
    table = chunked(docs.select(F.struct("*").alias("doc")), "words")
    groups = table.groupBy("_chunk")

    def sketch(part: pa.Table) -> pa.Table:
        chunk, rows = _Chunk(part, text, id_col, size), []
        name = column(part, "_chunk")[0].as_py()
        for row in range(depth):
            keys, counts = np.unique(_cells(chunk.first, row, segments), return_counts=True)
            at = _segments_of(keys, CELL_BITS, segments)
            for k in range(segments):
                if at[k] < at[k + 1]:
                    own = slice(at[k], at[k + 1])
                    rows.append((row * segments + k, name, own.stop - own.start, _steps(keys[own] - (k << CELL_BITS)), _bits(counts[own] > 1)))
        return _table(rows, ("_segment", "_chunk", "n", "cells", "many"))

    def merge(part: pa.Table) -> pa.Table:
        counts = np.zeros(1 << CELL_BITS, np.uint8)  # up to 2: more is the same
        sent, many, n = column(part, "cells"), column(part, "many"), column(part, "n").to_pylist()
        for cells, more, k in zip(sent, many, n, strict=True):
            at = _from_steps(cells.as_buffer())
            counts[at] = np.minimum(counts[at] + 1 + _from_bits(more.as_buffer(), k), 2)
        bits = [_bits(counts[_from_steps(cells.as_buffer())] > 1) for cells in sent]
        return pa.table({"_segment": column(part, "_segment"), "_chunk": column(part, "_chunk"), "n": column(part, "n"), "many": pa.array(bits, pa.binary())})

    def repeated(part: pa.Table, heard: pa.Table) -> pa.Table:
        chunk, rows = _Chunk(part, text, id_col, size), []
        if not len(chunk.first):
            return _table(rows, ("_segment", "_chunk", "n", "first", "second", "place", "id"))
        name = column(part, "_chunk")[0].as_py()
        flags = {s: _from_bits(b.as_buffer(), n) for s, b, n in zip(column(heard, "_segment").to_pylist(), column(heard, "many"), column(heard, "n").to_pylist(), strict=True)}
        maybe = np.ones(len(chunk.first), bool)
        for row in range(depth):
            keys, which = np.unique(_cells(chunk.first, row, segments), return_inverse=True)
            own = [flags[row * segments + k] for k in range(segments) if row * segments + k in flags]
            maybe &= np.concatenate(own)[which]
        some, _ = chunk.distinct(np.flatnonzero(maybe))
        ids = np.repeat(chunk.ids, chunk.windows)
        segment = (((chunk.first[some] >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((some, segment))
        some, segment = some[order], segment[order]
        at = np.searchsorted(segment, np.arange(segments + 1))
        for k in range(segments):
            if at[k] < at[k + 1]:
                own = some[at[k] : at[k + 1]]
                rows.append((k, name, len(own), chunk.first[own].tobytes(), chunk.second[own].tobytes(), own.astype("<u4").tobytes(), ids[own].tobytes()))
        return _table(rows, ("_segment", "_chunk", "n", "first", "second", "place", "id"))

    def earlier(part: pa.Table) -> pa.Table:
        n = column(part, "n").to_numpy()
        joined = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in column(part, c)])
        first, second, place, ids = joined("first", "<u8"), joined("second", "<u8"), joined("place", "<u4"), joined("id", "<i8")
        chunk = np.repeat(column(part, "_chunk").to_numpy(), n)
        order = np.lexsort((chunk, ids, second, first))
        a, b = first[order], second[order]
        later = np.zeros(len(order), bool)  # not the first of its set
        later[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        ends = np.cumsum(n)
        places = [place[i:j][later[i:j]].tobytes() for i, j in zip(ends - n, ends, strict=True)]
        return pa.table({"_chunk": column(part, "_chunk"), "places": pa.array(places, pa.binary())})

    kind = table.schema["doc"].dataType

    def remove(part: pa.Table, heard: pa.Table) -> pa.Table:
        chunk = _Chunk(part, text, id_col, size)
        every = np.arange(len(chunk.first))
        first, number = chunk.distinct(every)
        gone = np.ones(len(every), bool)
        gone[first] = False
        for places in column(heard, "places") if len(heard) else []:
            known = np.zeros(len(first), bool)
            known[number[np.frombuffer(places.as_buffer(), "<u4")]] = True
            gone |= known[number]
        change = np.zeros(int(chunk.counts.sum()) + 1, np.int32)
        starts = window_starts(chunk.counts, size)[gone]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + size, -1)
        keep = np.cumsum(change[:-1]) == 0
        ends = np.cumsum(chunk.counts)
        kept, removed = [], []
        for words, i, j in zip(chunk.texts, ends - chunk.counts, ends, strict=True):
            some = keep[i:j]
            words = words.as_buffer().to_pybytes().split()
            removed.append(len(words) - int(np.count_nonzero(some)))
            kept.append((b" ".join(words) if not removed[-1] else b" ".join(compress(words, some.tolist()))).decode())
        doc = column(part, "doc").take(pa.array(chunk.order))
        return pa.table({"doc": doc, "n_words": chunk.counts, "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    sent = groups.applyInArrow(sketch, "_segment bigint, _chunk bigint, n bigint, cells binary, many binary")
    merged = sent.groupBy("_segment").applyInArrow(merge, "_segment bigint, _chunk bigint, n bigint, many binary")
    exact = groups.cogroup(merged.groupBy("_chunk")).applyInArrow(
        repeated, "_segment bigint, _chunk bigint, n bigint, first binary, second binary, place binary, id binary"
    )
    found = exact.groupBy("_segment").applyInArrow(earlier, "_chunk bigint, places binary")
    out = T.StructType(
        [T.StructField("doc", kind), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    )
    return groups.cogroup(found.groupBy("_chunk")).applyInArrow(remove, out)


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    numbers = ("_segment", "_chunk", "n")
    return pa.table({c: pa.array(v, pa.int64() if c in numbers else pa.binary()) for c, v in zip(names, columns, strict=True)})
