"""Helpers of the operators in this folder: chunked tables, ragged arrays, and ids of whole texts."""

from __future__ import annotations

import codecs
import json
import pickle
import re
import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subvent.sources.staging import named_table, new_path

#: Rows of one chunk of a chunked table, a power of two.
CHUNK_ROWS = 4096
#: Bytes of text that a task works on at once; a longer text is worked on alone and whole.
SLICE_BYTES = 4 << 20
#: The same for work with many numbers per byte.
SMALL_SLICE = 1 << 20
#: Parts of an array that are gathered at once.
GATHERED = 1 << 16
#: Parts of pieces whose ids a worker remembers, about; some tens of MB.
PARTS_KEPT = 200_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as zstd parquet into the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunked(df: DataFrame, name: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """Write ``df`` with columns ``_row`` (a number of its own) and ``_chunk`` as a table bucketed by chunk, without a shuffle.

    A chunk is ``rows`` consecutive rows of one scan task, or what is left of them. As the table is bucketed, grouping
    or cogrouping it by ``_chunk`` moves none of its rows, only those of the other table.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    buckets = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shift = rows.bit_length() - 1
    table, path = f"{name}_{uuid.uuid4().hex}", new_path(spark, name)
    (
        df.withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_chunk", F.shiftright("_row", shift))
        .write.format("parquet")
        .option("path", path)
        .option("compression", "zstd")
        .bucketBy(buckets, "_chunk")
        .sortBy("_chunk")
        .saveAsTable(table)
    )
    named_table(path, table)
    return spark.table(table)


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """A broadcast ``value`` of bounded size, as a function that tasks call for it.

    A plain broadcast names the classes of what it holds, which a worker without this package does not know; here they travel along.
    """
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    """A column as one array."""
    found = table.column(name)
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def strings(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    """A text column as one array with 64-bit offsets, NULL as empty."""
    found = table.column(name).cast(pa.large_string())
    found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
    if isinstance(found, pa.ChunkedArray):
        found = pa.concat_arrays(found.chunks) if found.num_chunks else pa.array([], pa.large_string())
    return pc.fill_null(found, "")


def field(structs: pa.Array, name: str) -> pa.Array:
    """A text field of structs as one array with 64-bit offsets, NULL as empty."""
    return pc.fill_null(pc.struct_field(structs, [name]).cast(pa.large_string()), "")


def listed(texts: pa.Array) -> list[str]:
    """The ``texts`` (no NULL) as Python strings, made at once and not value by value."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, at least one row each."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    i = 0
    while i < len(texts):
        before = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield i, j
        i = j


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The parts of ``pool`` that start at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, pool.dtype)
    done, shift = 0, starts - (ends - lengths)
    for k in range(0, len(ends), GATHERED):  # some at a time, as their places take several times the room of what is gathered
        some = slice(k, k + GATHERED)
        upto = int(ends[some][-1])
        out[done:upto] = pool[np.repeat(shift[some], lengths[some]) + np.arange(done, upto)]
        done = upto
    return out


def kept_in_worker(key: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a Python worker and kept for its later tasks."""
    place = sys.modules.setdefault("_subvent_worker", types.ModuleType("_subvent_worker"))
    if not hasattr(place, key):
        setattr(place, key, make())
    return getattr(place, key)


def forget_kept() -> None:
    """Give back what tasks of other operators have kept in this Python worker, and freed Arrow memory."""
    sys.modules.pop("_subvent_worker", None)
    pa.default_memory_pool().release_unused()


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``data`` cut at ``ends`` (from 0 on, in its elements) into binary values, without a copy."""
    places = (data.itemsize * ends).astype(np.int64)
    if len(places) and places[-1] >= 1 << 31:
        raw = data.tobytes()
        return pa.array([raw[a:b] for a, b in zip(places[:-1], places[1:], strict=True)], pa.binary())
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data)])


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    shown = set(plain)
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


_OTHER, _LETTER, _DIGIT, _WHITE, _ODD = range(5)


def _byte_kinds() -> np.ndarray:
    """What a byte is in texts of letters up to U+023F, ASCII digits, signs and white space; anything else is odd."""
    kinds = np.full(256, _ODD, np.uint8)
    kinds[0x20:0x7F] = _OTHER
    for kind, some in ((_LETTER, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), (_DIGIT, b"0123456789"), (_WHITE, b" \t\n\r")):
        kinds[list(some)] = kind
    kinds[0x80:0xC0] = kinds[0xC3:0xC9] = _LETTER
    return kinds


_KINDS = _byte_kinds()
#: In that range but no letters (U+00D7, U+00F7), or more than one letter in lower case (U+0130).
_NO_LETTERS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``texts`` (64-bit offsets, no NULL) in one array, and where each text starts in it and the last ends."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def _odd_texts(texts: pa.Array) -> np.ndarray:
    """Which ``texts`` hold a character that ``_byte_kinds`` does not tell."""
    data, ends = _bytes_of(texts)
    odd = _KINDS[data] == _ODD
    for lead in {a for a, _ in _NO_LETTERS}:
        at = np.flatnonzero(data == lead)
        odd[at[np.isin(data[at + 1], [b for a, b in _NO_LETTERS if a == lead])]] = True
    out = np.zeros(len(texts), bool)
    out[np.searchsorted(ends, np.flatnonzero(odd), side="right") - 1] = True
    return out


def _runs(texts: pa.Array, spaced: bool) -> tuple[pa.Array, np.ndarray]:
    """Runs of letters, of digits and of signs in ``texts`` without odd characters, and the place of each text's first run and the end.

    No match of the split patterns goes across their ends: an apostrophe is not cut from letters after it. With ``spaced``
    a space joins the run after it, and other white space makes runs of its own, less the last character where it stands
    before another run; without, white space is dropped and ASCII letters are put in lower case.
    """
    data, ends = _bytes_of(texts)
    kinds = _KINDS[data]
    start = np.empty(len(data), bool)
    start[:1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=start[1:])
    mark = np.flatnonzero(data[:-1] == ord("'"))
    start[mark[kinds[mark + 1] == _LETTER] + 1] = False
    firsts = ends[:-1][np.diff(ends) > 0]
    if spaced:
        white = kinds == _WHITE
        follows = white[:-1] & ~white[1:]
        follows[firsts[1:] - 1] = False
        after = np.flatnonzero(follows) + 1  # a run after white space of its text
        start[after - 1] = True
        start[after[data[after - 1] == ord(" ")]] = False
        start[firsts] = True
    else:
        start[firsts] = True
        keep = kinds != _WHITE
        data, start = _LOWER[data[keep]], start[keep]
        ends = np.concatenate([[0], np.cumsum(keep)])[ends]
    at = np.append(np.flatnonzero(start), len(data))
    runs = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data)))
    return runs, np.searchsorted(at, ends)


class Units:
    """Ids of whole texts, encoding each distinct piece between spaces once.

    ``encode`` takes a list of pieces and returns the ids of each. With ``spaced`` a piece keeps the space before it, as
    byte-level vocabularies do; it then cuts only before a space with a character other than white space on one of its
    sides, where no match of their split pattern can go across. Without, white space is taken to separate and vanish.
    When more than ``room`` pieces are remembered, the half that most slices have held stays; the others are encoded
    anew when they come again. A text that holds one of ``apart`` is not cut; ``whole`` encodes it.

    With ``finer`` a text without odd characters is cut into runs of letters, digits and signs instead, of which fewer are
    distinct; ``encode`` then has to follow one of the two known split patterns, and to put letters in lower case without ``spaced``.
    """

    def __init__(
        self, encode: Callable[[list[str]], list[Sequence[int]]], spaced: bool, room: int = 400_000,
        apart: Sequence[str] = (), whole: Callable[[str], Sequence[int]] | None = None, finer: bool = False,
    ):
        self.encode, self.spaced, self.room, self.finer = encode, spaced, room, finer
        self.apart, self.whole = tuple(apart), whole
        self.known = pa.array([], pa.large_string())
        self.starts, self.lengths, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.used = np.zeros(0, np.int32)  # slices that held the piece, of late

    def _forget(self) -> None:
        """Keep the half of ``room`` that most slices have held, of equal ones the newest."""
        stay = np.sort(np.argsort(self.used, kind="stable")[len(self.used) - self.room // 2 :])
        self.pool = gather(self.pool, self.starts[stay], self.lengths[stay])
        self.known, self.lengths, self.used = self.known.take(pa.array(stay)), self.lengths[stay], self.used[stay] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _look_up(self, pieces: pa.Array) -> np.ndarray:
        """The entry of each of the distinct ``pieces``."""
        found = pc.index_in(pieces, value_set=self.known)
        entries = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        if found.null_count:
            new = pieces.filter(found.is_null())
            coded = self.encode(listed(new))
            lengths = np.fromiter(map(len, coded), np.int64, len(coded))
            ids = np.fromiter(chain.from_iterable(coded), np.int32, int(lengths.sum()))
            entries[entries < 0] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, new])
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.pool = np.concatenate([self.pool, ids])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int32)])
        self.used[entries] += 1
        return entries

    def _split(self, texts: pa.Array) -> pa.Array:
        if not self.spaced:
            return pc.ascii_split_whitespace(texts)
        if pc.any(pc.match_substring_regex(texts, f"{_SPACE} {_SPACE}")).as_py():
            cut = re.compile(r" (?=\S)")
            return pa.array([cut.split(x) for x in texts.to_pylist()], pa.large_list(pa.large_string()))
        return pc.split_pattern(texts, " ")

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` (no NULL) as one array, and how many each text has."""
        held = np.zeros(len(texts), bool)
        for content in self.apart:
            held |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        odd = _odd_texts(texts) & ~held if self.finer else ~held
        ways = [(held, self._whole_ids), (odd, self._cut_ids), (~(held | odd), self._run_ids)]
        for rows, way in ways:
            if rows.all():
                return way(texts)
        lengths, starts, found, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [], 0
        for rows, way in ways:
            if rows.any():
                ids, counts = way(texts.filter(pa.array(rows)))
                lengths[rows], starts[rows] = counts, total + np.cumsum(counts) - counts
                found.append(ids)
                total += len(ids)
        return gather(np.concatenate(found), starts, lengths), lengths

    def _whole_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.asarray(self.whole(t), np.int32) for t in texts.to_pylist()]
        return np.concatenate([np.zeros(0, np.int32), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def _run_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.room:
            self._forget()
        runs, offsets = _runs(texts, self.spaced)
        coded = runs.dictionary_encode()
        return self._ids_at(self._look_up(coded.dictionary)[np.asarray(coded.indices)], offsets)

    def _ids_at(self, entries: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``entries`` and how many there are from each of ``offsets`` to the next."""
        lengths = self.lengths[entries]
        before = np.concatenate([[0], np.cumsum(lengths)])
        return gather(self.pool, self.starts[entries], lengths), np.diff(before[offsets])

    def _cut_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.room:
            self._forget()
        lists = self._split(texts)
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        coded = flat.dictionary_encode()
        if self.spaced:
            first = flat.take(pa.array(offsets[:-1])).dictionary_encode()
            space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
            entries = self._look_up(pc.binary_join_element_wise(nothing, coded.dictionary, space))[np.asarray(coded.indices)]
            entries[offsets[:-1]] = self._look_up(first.dictionary)[np.asarray(first.indices)]
        else:
            entries = self._look_up(coded.dictionary)[np.asarray(coded.indices)]
        return self._ids_at(entries, offsets)


def _latin(piece: str) -> bool:
    """Only characters below U+0250: normal forms, letters and lower case are the same in every Unicode version."""
    return piece.isascii() or max(piece) < "ɐ"


def library_units(path: str, added_tokens: bool = False) -> Units:
    """Pieces encoded by the tokenizers library and the vocabulary file at ``path``.

    With ``added_tokens`` the contents of the file's added tokens become their ids, as in the library's own call: a text that
    holds one takes that call whole. Without, they are text like any other.

    For Latin pieces the two known kinds of file are split here and each part goes to the library's model, which gives
    the same ids as a call of the whole tokenizer at a quarter of the cost; all else takes that call.
    """
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not added_tokens
    tokenize, shown = tokenizer.model.tokenize, "".join(byte_characters())
    with open(path, encoding="utf-8") as file:
        plan = json.load(file)
    parts_known: dict[str, list[int]] = {}  # of this slice's pieces and those before; beyond half of PARTS_KEPT they are the earlier ones
    parts_before: dict[str, list[int]] = {}
    spaced = plan["normalizer"] is None  # one letter run, after a space or not, is one match of either pattern

    def part(text: str) -> list[int]:
        return [t.id for t in tokenize(codecs.charmap_decode(text.encode(), "strict", shown)[0])]

    split, lower = None, False
    cutter, normal = plan["pre_tokenizer"] or {}, plan["normalizer"]
    if normal is None and cutter == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
        import public_tokenizers

        split = regex.compile(public_tokenizers.PATTERN).findall
    elif normal and cutter.get("type") == "Sequence":
        kinds = [n["type"] for n in normal.get("normalizers", [])]
        cuts = cutter["pretokenizers"]
        if kinds == ["NFC", "Replace", "Lowercase"] and len(cuts) == 2 and cuts[0].get("invert") and cuts[0]["behavior"] == "Removed":
            split, lower = regex.compile(cuts[0]["pattern"]["Regex"]).findall, True

    def encode(pieces: list[str]) -> list[list[int]]:
        nonlocal parts_known, parts_before
        out: list[list[int] | None] = []
        if len(parts_known) > PARTS_KEPT // 2:
            parts_known, parts_before = {}, parts_known
        known, earlier = parts_known.get, parts_before.get

        def ids_of(text: str) -> list[int]:
            found = parts_known[text] = earlier(text) or part(text)
            return found

        for p in pieces:
            if split is None or not (p.isascii() or _latin(p)):
                out.append(None)
                continue
            low = p.lower() if lower else p
            # a piece that is one part is remembered as a piece
            if low.isalpha() or (spaced and low[:1] == " " and low[1:].isalpha()):
                out.append(known(low) or earlier(low) or part(low))
                continue
            parts = split(low)
            if len(parts) == 1:
                out.append(known(low := parts[0]) or earlier(low) or part(low))
            else:
                found = []
                for x in parts:
                    found += known(x) or ids_of(x)
                out.append(found)
        rest = [k for k, x in enumerate(out) if x is None]
        for k in range(0, len(rest), 1024):
            some = rest[k : k + 1024]
            for at, e in zip(some, tokenizer.encode_batch([pieces[i] for i in some], add_special_tokens=False), strict=True):
                out[at] = e.ids
        return out

    if not added_tokens:
        return Units(encode, spaced=spaced, finer=split is not None)
    # a token that is sought in the normalised text may be in any text
    apart = ["" if t["normalized"] else t["content"] for t in plan["added_tokens"]]
    whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    return Units(encode, spaced=spaced, apart=apart, whole=whole, finer=split is not None)


def units_of(path: str, added_tokens: bool = False) -> Units:
    """The ``library_units`` of this Python worker."""
    return kept_in_worker(f"units:{path}:{added_tokens}", lambda: library_units(path, added_tokens))
