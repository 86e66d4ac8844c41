"""Units, piece BPE, token files, length histogram and packing against the libraries they stand for."""

import base64
import hashlib
import os
import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from subvent.llm import ans, common, lengths, packing, piece_bpe
from subvent.sources.staging import new_path

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
MULTI, RANKS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.tiktoken")

TEXTS = [
    "", " ", "   ", "a", "The cat's hat. It'll rain\n\nsoon", "  leading and trailing  ", "tab\tand\rreturn \n x", "a\n b", "a  b", "a   b", "a \n b\n  c",
    "x y   z", "ÀÉÎ õü ß İstanbul ŒUVRE", "é combining ́ mark", "Ελλάδα ΣΟΦΟΣ", "日本語 テキスト", "𝔘𝔫𝔦 👍🏽 emoji", "<|endoftext|> x <|startoftext|>",
    "12345 6 7.89", "don't WON'T i'm", "\x1c \x1d \x1e\x1f", "\x85   　 end", "a" * 3000, "ab " * 2000, "!!!???...", "word " * 3 + "\n" * 4 + " " * 5 + "tail", "\x00 nul \x00",
]


def tokenizer(path):
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def split_up(ids, counts):
    ends = np.cumsum(counts)
    return [ids[a:b].tolist() for a, b in zip(ends - counts, ends, strict=True)]


def encoding(path):
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(path, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def multi():
    return piece_bpe.PieceBpe(MULTI, P.PATTERN)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS)] + [(3, "a", "x", 0), (None, "no id", "x", 0), (99, None, "x", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, file string, n int").repartition(3)


def test_latin_characters_need_no_normal_form():
    assert unicodedata.is_normalized("NFC", "".join(map(chr, range(0x250))))


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_units_are_the_library(path):
    units, whole = common.library_units(path), tokenizer(path)
    assert split_up(*units.ids(pa.array(TEXTS, pa.large_string()))) == [whole.encode(t, add_special_tokens=False).ids for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é'sß.,!1 \n\t\r  　\x1c\x85日Σİ")), max_size=4))
def test_units_on_mixed_spaces(texts):
    for path, cache in ((WORD, "w"), (BYTE, "b")):
        units = common.kept_in_worker(f"test{cache}", lambda path=path: common.library_units(path))
        whole = common.kept_in_worker(f"whole{cache}", lambda path=path: tokenizer(path))
        found = split_up(*units.ids(pa.array(texts, pa.large_string())))
        assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting_changes_nothing():
    units = common.library_units(BYTE)
    units.room = 1
    texts = pa.array(["one two", "two three"], pa.large_string())
    assert all((a == b).all() for a, b in zip(units.ids(texts), units.ids(texts), strict=True))


def test_piece_model_is_tiktoken(multi):
    whole = encoding(MULTI)
    rng = random.Random(1)
    noise = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x400, 0x460), rng.randrange(0x4E00, 0x4F00), 10, 32])) for _ in range(300)) for _ in range(40)]
    texts = TEXTS + noise
    ids, counts = multi.encode(pa.array(texts, pa.large_string()))
    assert split_up(ids, counts) == [whole.encode_ordinary(t) for t in texts]
    data, _ = multi.decode(ids)
    assert data.tobytes() == "".join(texts).encode()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_piece_round_trip(texts):
    bpe = common.kept_in_worker("test_multi", lambda: piece_bpe.PieceBpe(MULTI, P.PATTERN))
    whole = common.kept_in_worker("test_tiktoken", lambda: encoding(MULTI))
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, counts = bpe.encode(pa.array(texts, pa.large_string()))
    assert split_up(ids, counts) == [whole.encode_ordinary(t) for t in texts]
    assert bpe.decode(ids)[0].tobytes() == "".join(texts).encode()


def test_piece_digests(table):
    encoded = piece_bpe.encode_texts(table, MULTI, P.PATTERN)
    found = {r["doc_id"]: r for r in piece_bpe.round_trip_digests(encoded, MULTI, P.PATTERN).collect()}
    whole = encoding(MULTI)
    for i, t in [*enumerate(TEXTS), (None, "no id"), (99, "")]:
        ids = whole.encode_ordinary(t)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    decoded = piece_bpe.decode_ids(encoded, MULTI, P.PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in decoded) == sorted([t.encode() for t in TEXTS] + [b"a", b"no id", b""])


def test_ranks_must_be_whole(tmp_path):
    bad = tmp_path / "ranks"
    bad.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="ranks"):
        piece_bpe.read_ranks(str(bad))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=400), st.integers(1, 20), st.integers(1, 7))
def test_coder_round_trip(ids, lanes, every):
    ids = np.asarray(ids, np.int64)
    coder = ans.Coder(ans.scaled_frequencies(np.bincount(ids, minlength=50)))
    block = coder.encode(ids, lanes, every)
    assert coder.decode(block).tolist() == ids.tolist()
    parts = [coder.decode_part(block, k) for k in reversed(range(len(block["mark_steps"])))]  # in any order
    assert [i for p in reversed(parts) for i in p] == ids.tolist()


def test_coder_is_near_the_entropy_and_sees_damage():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.geometric(0.01, 200_000), 900)
    counts = np.bincount(ids, minlength=1000)
    coder = ans.Coder(ans.scaled_frequencies(counts))
    block = coder.encode(ids, 256)
    share = counts[counts > 0] / len(ids)
    entropy = -(share * np.log2(share)).sum() * len(ids) / 8
    assert len(block["words"]) < 1.01 * entropy
    damaged = block | {"words": block["words"][:-1] + bytes([block["words"][-1] ^ 1])}
    with pytest.raises(ValueError, match="checksum"):
        coder.decode(damaged)
    with pytest.raises(ValueError, match="ids"):
        coder.decode(block | {"ids_crc32": 0})


def test_scale_must_hold_the_vocabulary():
    with pytest.raises(ValueError, match="scale"):
        ans.scaled_frequencies(np.zeros(1 << 20))
    assert ans.scaled_frequencies(np.zeros(7)).sum() == 1 << 20


def test_token_files(spark, table):
    path = new_path(spark, "test_files")
    ans.write_token_files(table, path, WORD, end_id=1, vocabulary=49408, block_ids=700, lanes=16)
    found = sorted(ans.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    whole = tokenizer(WORD)
    rows = sorted([*enumerate(TEXTS), (3, "a"), (None, "no id"), (99, "")], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    ids = [[*whole.encode(t, add_special_tokens=False).ids, 1] for _, t in rows]
    assert [r["doc_id"] for r in found] == [r[0] for r in rows]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in found] == ids
    assert [r["start"] for r in found] == [0, *np.cumsum([len(x) for x in ids])[:-1]]
    assert [r["n_tokens"] for r in found] == [len(x) for x in ids]
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.count() > 3 and blocks.filter("size(mark_steps) = 0").count() == 0


def test_token_files_of_nothing(spark, table):
    path = new_path(spark, "test_files")
    ans.write_token_files(table.filter("false"), path, WORD, end_id=1, vocabulary=49408)
    assert ans.read_token_files(spark, path).collect() == []


def test_histogram(table):
    whole = encoding(RANKS)
    sizes = np.asarray([len(whole.encode_ordinary(t)) for t in [*TEXTS, "a", "no id", ""]])
    limits = lengths.context_limits(lengths.length_histogram(lengths.encoded_lengths(table, RANKS, P.PATTERN))).cache()
    rows = {r["n_tokens"]: r for r in limits.collect()}
    assert sorted(rows) == sorted(set(sizes.tolist()))
    for n, r in rows.items():
        assert (r["docs"], r["docs_within"], r["docs_longer"]) == ((sizes == n).sum(), (sizes <= n).sum(), (sizes > n).sum())
        assert (r["tokens_longer"], r["tokens_total"], r["tokens_truncated"]) == (sizes[sizes > n].sum(), sizes.sum(), np.minimum(sizes, n).sum())
    for limit in (0, 1, 2, 7, 500, 2500, 10**6):
        assert lengths.at_limit(limits, limit) == {"docs_within": (sizes <= limit).sum(), "tokens_truncated": np.minimum(sizes, limit).sum()}
    ranked = np.sort(sizes)
    for share in (0.01, 0.5, 0.9, 1.0):
        assert lengths.quantile(limits, share) == ranked[int(np.ceil(share * len(ranked))) - 1]


def test_histogram_of_nothing(spark, table):
    limits = lengths.context_limits(lengths.length_histogram(lengths.encoded_lengths(table.filter("false"), RANKS, P.PATTERN)))
    assert limits.collect() == []
    assert lengths.at_limit(limits, 5) == {"docs_within": 0, "tokens_truncated": 0}
    assert lengths.quantile(limits, 0.5) is None
    unknown = spark.createDataFrame([(None,), (4,)], "n_tokens bigint")
    assert {r["n_tokens"]: r["docs"] for r in lengths.length_histogram(unknown).collect()} == {0: 1, 4: 1}


def test_hilbert_neighbours():
    axis = np.arange(8)
    grid = np.stack([a.ravel() for a in np.meshgrid(axis, axis, axis)], axis=1)
    key = packing.hilbert_key(grid, 3)
    assert sorted(key) == list(range(512))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=30), st.sampled_from([1, 4, 8, 16]))
def test_cut(counts, length):
    counts = np.asarray(counts, np.int64)
    starts, total = np.cumsum(counts) - counts, int(counts.sum())
    doc, a, b, number, offset = packing.cut(starts, counts, total, length)
    assert (b > a).all() and (np.bincount(doc, b - a, len(counts)) == counts).all()
    size = np.bincount(number, b - a).astype(int) if total else np.zeros(0, int)
    rest = size[size != length]
    assert ((rest & (rest - 1)) == 0).all() and (size > 0).all() and len(size) <= total // length + max(1, length).bit_length()
    order = np.lexsort((offset, number))
    seen = np.zeros(len(size), int)
    for k in order:
        assert offset[k] == seen[number[k]]
        seen[number[k]] += b[k] - a[k]


def check_pieces(pieces, rows, end):
    whole = tokenizer(BYTE)
    left = {}
    for i, t in rows:
        left.setdefault(i, []).append([*whole.encode(t, add_special_tokens=False).ids, *end])
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        by_doc.setdefault(p["doc_id"], []).append(p)
    for i, texts in left.items():
        parts = by_doc.pop(i, [])
        assert sum(p["length"] for p in parts) == sum(map(len, texts))
        if len(texts) == 1 and texts[0]:
            assert [x for p in parts for x in np.frombuffer(p["ids"], "<u4")] == texts[0]
            assert {p["doc_tokens"] for p in parts} == {len(texts[0])}
            assert [p["start"] for p in parts] == [0, *np.cumsum([p["length"] for p in parts])[:-1]]
    assert not by_doc
    fill = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == fill.get(p["sequence_id"], 0)
        fill[p["sequence_id"]] = p["offset"] + p["length"]
    assert sorted(fill) == list(range(len(fill)))


def test_packing(table):
    rows = [*enumerate(TEXTS), (3, "a"), (None, "no id"), (99, "")]
    packed = packing.pack(table, BYTE, length=64, end_id=0).cache()
    check_pieces(packed.collect(), rows, [0])
    assert packing.padding(packed, 64).first()["padded"] == 0
    sums = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.piece_checksums(packed).collect() if r["doc_id"] == 5}
    assert sums == {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in packed.collect() if r["doc_id"] == 5}
    check_pieces(packing.pack(table, BYTE, length=64, end_id=None).collect(), rows, [])
    assert packing.pack(table.filter("false"), BYTE).collect() == []


def test_equal_documents_lie_together(spark):
    rows = [(i, ["some words of one kind here", "andere Woerter einer zweiten Art"][i % 2]) for i in range(40)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), BYTE, length=16).collect()
    order = [p["doc_id"] % 2 for p in sorted(packed, key=lambda p: (p["sequence_id"], p["offset"]))]
    assert np.count_nonzero(np.diff(order)) == 1


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_added_tokens_are_found_as_by_the_library(path):
    whole = Tokenizer.from_file(path)
    texts = [*TEXTS, "one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|><|endoftext|>b  c", "x <|ENDOFTEXT|> <|startoftext|>é", "plain", "<|endoftext|"]
    for some in (texts, texts[::-1], texts[-6:-4], texts[:2]):
        found = split_up(*common.library_units(path, added_tokens=True).ids(pa.array(some, pa.large_string())))
        assert found == [whole.encode(t, add_special_tokens=False).ids for t in some]


def test_queries_find_added_tokens(spark, tmp_path):
    """The registered queries against an unchanged tokenizer, and the documents after one that holds an added token."""
    import corpus_pipeline
    from subvent.llm import queries

    texts = ["one two", "one <|endoftext|> two", "<|startoftext|> three", "", "four <|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    whole, start = Tokenizer.from_file(WORD), 0
    found = {r["doc_id"]: r for r in queries.op1_token_files(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        ids = [*whole.encode(t, add_special_tokens=False).ids, 1]
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
        start += len(ids)
    whole = Tokenizer.from_file(BYTE)
    sizes = {i: len(whole.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    for pieces in (queries.op8_curve_packing(spark, str(tmp_path)), corpus_pipeline.packed(spark, docs, str(tmp_path))):
        assert {r["doc_id"]: r["doc_tokens"] for r in pieces.collect()} == sizes


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_parts_are_remembered_across_slices(monkeypatch, path):
    monkeypatch.setattr(common, "PARTS_KEPT", 20)
    units, whole = common.library_units(path), tokenizer(path)
    for some in (TEXTS[:9], TEXTS[9:], TEXTS[::-1], ["", " "]):
        found = split_up(*units.ids(pa.array(some, pa.large_string())))
        assert found == [whole.encode(t, add_special_tokens=False).ids for t in some]


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abS'tsrevlméÉßǅİ×÷½¿\u0301\u024f\u0250Σ 1²,.<|> \n\t\r\x0b\x00\xa0 "), max_size=14), max_size=6))
def test_runs_are_cut_as_the_library_does(path, texts):
    units = common.kept_in_worker(f"runs{path}", lambda: common.library_units(path, added_tokens=True))
    whole = common.kept_in_worker(f"runs_whole{path}", lambda: tokenizer(path))
    found = split_up(*units.ids(pa.array(["", *texts, "x"], pa.large_string()).slice(1)))
    assert found == [whole.encode(t, add_special_tokens=False).ids for t in [*texts, "x"]]


def test_signs_and_capitals_make_no_new_pieces():
    seen = []
    units = common.library_units(WORD)
    encode, units.encode = units.encode, lambda pieces: seen.extend(pieces) or encode(pieces)
    units.ids(pa.array(["word Word, word. (WORD) don't", "word", " word;"], pa.large_string()))
    assert sorted(seen) == sorted(["word", ",", ".", "(", ")", "don", "'t", ";"])


def test_common_pieces_stay_when_others_are_forgotten():
    seen = []
    units = common.library_units(BYTE)
    units.room = 40
    encode, units.encode = units.encode, lambda pieces: seen.extend(pieces) or encode(pieces)
    whole = tokenizer(BYTE)
    for k in range(30):
        texts = [f"one two {''.join(chr(97 + (k * 7 + i) % 26) for i in range(n))}" for n in range(3, 12)]
        assert split_up(*units.ids(pa.array(texts, pa.large_string()))) == [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(units.known) <= units.room + 12
    assert seen.count("one") == seen.count(" two") == 1


def test_ids_are_counted_as_they_are_made(table):
    raw = ans._raw_blocks(table, WORD, 1, "text", "doc_id", 64, 49408, True).collect()
    blocks, ends = [r for r in raw if r["block"] >= 0], [r for r in raw if r["block"] < 0]
    assert len(ends) == len({r["file"] for r in blocks}) and all(r["ids"] is None for r in ends)
    found = sum(np.frombuffer(r["id_counts"], "<i8") for r in ends)
    ids = np.concatenate([np.frombuffer(r["ids"], ans._raw_type(49408)) for r in blocks])
    assert (found == np.bincount(ids, minlength=49408)).all() and found[1] == table.count()


def test_ids_beyond_the_vocabulary_are_refused(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    with pytest.raises(Exception, match="broadcast"):
        ans.write_token_files(docs, f"{tmp_path}/few", WORD, end_id=1, vocabulary=300)


def test_binaries_are_cut_without_a_copy():
    data = np.arange(6, dtype="<u4")
    found = common.binaries(data, np.asarray([0, 2, 2, 6]))
    assert [np.frombuffer(x.as_py(), "<u4").tolist() for x in found] == [[0, 1], [], [2, 3, 4, 5]]
    assert len(common.binaries(data[:0], np.asarray([0]))) == 0


@pytest.mark.parametrize("room", [1, 3, 1 << 16])
def test_gathering_in_parts(monkeypatch, room):
    monkeypatch.setattr(common, "GATHERED", room)
    pool, starts, lengths = np.arange(50), np.asarray([7, 0, 40, 3, 3, 20, 9]), np.asarray([3, 0, 5, 1, 1, 10, 0])
    found = common.gather(pool, starts, lengths)
    assert found.tolist() == [x for a, n in zip(starts, lengths, strict=True) for x in range(a, a + n)]
    assert len(common.gather(pool, starts[:0], lengths[:0])) == 0
