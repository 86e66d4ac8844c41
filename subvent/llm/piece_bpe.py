"""Byte-level BPE through sentencepiece: a model written directly from a rank file.

Every token of the vocabulary becomes a piece, its bytes written as the printable characters that stand for them, with
the negative rank as its score. sentencepiece joins the neighbours whose joined piece scores highest, the leftmost
first: the order of the ranks. There is no normalisation, no dummy prefix and no escape of spaces.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from subvent.llm.common import Units, byte_characters, gather, kept_in_worker, slices, strings

#: Field numbers and values of the model file's format (fixed values).
PIECE, TEXT, SCORE, KIND = 1, 1, 2, 3
TRAINER, MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 2, 3, 4, 40, 41, 42, 43
NORMALIZER, NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 3, 1, 3, 4, 5
NORMAL, UNKNOWN, BPE = 1, 2, 2
#: Ids that are decoded at once.
IDS_AT_ONCE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, which must be 0, 1, 2 and so on."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError(f"{path}: the ranks must be 0 to {len(ranks) - 1}, each once")
    return ranks


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a byte-level vocabulary; the id of a token is its rank, the unknown piece comes last."""
    chars = byte_characters()
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        text = "".join([chars[b] for b in token]).encode()
        score = _varint(SCORE << 3 | 5) + struct.pack("<f", -float(rank))
        out.append(_bytes(PIECE, _bytes(TEXT, text) + score + _number(KIND, NORMAL)))
    out.append(_bytes(PIECE, _bytes(TEXT, b"<unk>") + _varint(SCORE << 3 | 5) + struct.pack("<f", 0.0) + _number(KIND, UNKNOWN)))
    trainer = b"".join(
        _number(field, n)
        for field, n in (
            (MODEL_TYPE, BPE), (VOCAB_SIZE, len(ranks) + 1), (UNK_ID, len(ranks)), (BOS_ID, -1), (EOS_ID, -1), (PAD_ID, -1),
        )
    )
    normalizer = _bytes(NAME, b"identity") + b"".join(_number(f, 0) for f in (DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES))
    return b"".join(out) + _bytes(TRAINER, trainer) + _bytes(NORMALIZER, normalizer)


class PieceBpe:
    """Encoder and decoder of one rank file; ``pattern`` cuts a text into the parts that are encoded separately."""

    def __init__(self, path: str, pattern: str):
        import regex
        from sentencepiece import SentencePieceProcessor

        self.ranks = read_ranks(path)
        self.model = SentencePieceProcessor(model_proto=model_bytes(self.ranks))
        self.split = regex.compile(pattern).findall
        self.chars = byte_characters()
        tokens = sorted(self.ranks, key=self.ranks.get)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.units = Units(self._pieces, spaced=True)

    def _pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece: a part that is a token itself is taken whole, the others are merged."""
        parts = [self.split(p) for p in pieces]
        ids: dict[str, list[int]] = {}
        rest = []
        for part in {x for xs in parts for x in xs}:
            data = part.encode()
            rank = self.ranks.get(data)
            if rank is None:
                rest.append((part, "".join([self.chars[b] for b in data])))
            else:
                ids[part] = [rank]
        found = self.model.encode([text for _, text in rest], num_threads=1) if rest else []
        ids.update(zip((part for part, _ in rest), found, strict=True))
        return [ids[xs[0]] if len(xs) == 1 else [i for x in xs for i in ids[x]] for xs in parts]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        return self.units.ids(texts)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ``ids``, one after the other, and how many each id has."""
        lengths = self.lengths[ids]
        return gather(self.bytes, self.starts[ids], lengths), lengths


def _bpe(path: str, pattern: str) -> PieceBpe:
    return kept_in_worker(f"piece_bpe:{path}:{pattern}", lambda: PieceBpe(path, pattern))


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and the text's ids as an array ``ids``.

    A NULL text counts as empty and has no ids. Repeated rows each give their row; other columns are not carried, so
    none can clash. Narrow: no row moves.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path, pattern)
        for batch in batches:
            texts = strings(batch, text)
            for i, j in slices(texts):
                ids, counts = bpe.encode(texts.slice(i, j - i))
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col).slice(i, j - i), pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))], [id_col, "ids"]
                )

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def _decoded(bpe: PieceBpe, batch: pa.RecordBatch, ids: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[bytes]]]:
    """Some rows of the batch at a time, with the ids and the decoded bytes of each."""
    counts = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(counts)
    i = 0
    while i < len(counts):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + IDS_AT_ONCE, side="right")))
        part = batch.slice(i, j - i)
        flat = np.asarray(part.column(ids).flatten(), dtype=np.int32)
        data, lengths = bpe.decode(flat)
        cuts = np.concatenate([[0], np.cumsum(counts[i:j])])
        at = np.concatenate([[0], np.cumsum(lengths)])[cuts]
        text = data.tobytes()
        yield part, [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        i = j


def decode_ids(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``ids`` and the bytes that the ids stand for, as ``decoded``; NULL ids give empty bytes."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path, pattern)
        for batch in batches:
            for part, _, text in _decoded(bpe, batch, ids):
                yield pa.RecordBatch.from_arrays([part.column(id_col), part.column(ids), pa.array(text, pa.binary())], [id_col, ids, "decoded"])

    return encoded.select(id_col, ids).mapInArrow(run, f"`{id_col}` {kind}, `{ids}` array<int>, decoded binary")


def round_trip_digests(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """Per row of ``encode_texts``: ``n_tokens``, ``ids_sha256`` and, of the bytes that these ids decode to, ``decoded_sha256``."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path, pattern)
        for batch in batches:
            for part, of_row, text in _decoded(bpe, batch, ids):
                of_ids = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in of_row]
                of_text = [hashlib.sha256(x).hexdigest() for x in text]
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), pa.array([len(x) for x in of_row], pa.int64()), pa.array(of_ids), pa.array(of_text)],
                    [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return encoded.select(id_col, ids).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
