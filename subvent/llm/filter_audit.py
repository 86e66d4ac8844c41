"""How filters interact: what each would remove alone, together and in every order.

1. One pass of a byte transducer over each text. A table gives every byte its class (white space, capital, symbol, first byte of
   a code point); the class alone sets the state, inside a word or outside, so a block of bytes is driven through the table at
   once. The steps into and out of a word are its span.
2. Spans go into an open hash table, all of a block in rounds: a span takes the free slot that its hash names, or compares itself
   with the span that holds it, hash, length and then every byte, and moves on only if they differ. What takes a slot is a
   distinct word.
3. Documents become a set of failed filters; those sets are counted per part, and every order of the filters is answered from the
   counts.

Texts never move: the pass leaves a row of numbers and a 128-bit hash per document. A text that a third of all documents share
is one row per task and part before anything is compared.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subvent.llm.common import SMALL_SLICE, forget_kept, slices, strings

#: Bits of a byte's class.
WHITE, CAPITAL, SYMBOL, FIRST = 1, 2, 4, 8
#: Bytes whose classes these are (fixed values of the filters).
WHITE_BYTES, CAPITAL_BYTES, SYMBOL_BYTES = b" \t\n\v\f\r", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: An id after all others, for documents without one.
LAST = 2**63 - 1

FACTS = "doc_id bigint, part string, words bigint, distinct_words bigint, capitals bigint, code_points bigint, symbols bigint, bytes bigint, text_hash binary"


def class_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for chars, bit in ((WHITE_BYTES, WHITE), (CAPITAL_BYTES, CAPITAL), (SYMBOL_BYTES, SYMBOL)):
        table[list(chars)] |= bit
    table[[b for b in range(256) if b & 0xC0 != 0x80]] |= FIRST
    return table


_CLASSES = class_table()
_FACTOR = 0x9E3779B97F4A7C15  # odd, so its powers have inverses
_INVERSE = pow(_FACTOR, -1, 1 << 64)


class _Powers:
    """Powers of the hash's factor and of its inverse, as many as the longest block has asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                for name, factor in (("up", _FACTOR), ("down", _INVERSE)):
                    steps = np.full(n, factor, np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """A hash of the bytes of each span, wherever it stands."""
    up, down = powers.of(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        return _mixed((sums[ends] - sums[starts]) * down[starts])


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray, at_once: int = 1 << 20) -> np.ndarray:
    """Whether the spans at ``a`` and ``b``, at least a byte long, hold the same bytes."""
    out = np.empty(len(a), bool)
    ends = np.cumsum(lengths)
    i = 0
    while i < len(a):
        before = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + at_once, side="right")))
        n = lengths[i:j]
        first = ends[i:j] - n - before
        place = np.arange(int(ends[j - 1] - before))
        differs = data[place + np.repeat(a[i:j] - first, n)] != data[place + np.repeat(b[i:j] - first, n)]
        out[i:j] = ~np.logical_or.reduceat(differs, first)
        i = j
    return out


def distinct_spans(data: np.ndarray, owner: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True for one span of each different content of each owner."""
    n, lengths = len(starts), ends - starts
    bits = max(4, (2 * n).bit_length())
    with np.errstate(over="ignore"):
        keys = _mixed(hashes + _mixed(owner.astype(np.uint64) + np.uint64(1)))
    slots = (keys >> np.uint64(64 - bits)).astype(np.int64)
    table = np.full(1 << bits, -1, np.int64)
    new = np.zeros(n, bool)
    waiting = np.arange(n)
    while len(waiting):
        at = slots[waiting]
        free = table[at] < 0
        table[at[free]] = waiting[free]
        held = table[at]
        new[waiting[held == waiting]] = True
        other = held != waiting
        mine, held = waiting[other], held[other]
        equal = (keys[mine] == keys[held]) & (owner[mine] == owner[held]) & (lengths[mine] == lengths[held])
        some = np.flatnonzero(equal)
        equal[some] = _same_bytes(data, starts[mine[some]], starts[held[some]], lengths[mine[some]])
        waiting = mine[~equal]
        slots[waiting] = (slots[waiting] + 1) & ((1 << bits) - 1)
    return new


def transduce(texts: pa.Array, powers: _Powers | None = None) -> dict[str, np.ndarray]:
    """Counts of words, distinct words, capitals, code points, symbols and bytes of each text (no NULL)."""
    rows = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + rows + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    cuts = offsets - offsets[0]
    classes = _CLASSES[data]

    def count(bit: int) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(classes & bit), cuts))

    inside = (classes & WHITE) == 0
    before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    before[1:], after[:-1] = inside, inside  # the state before each byte and at it, by place; texts begin and end outside
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after[cuts] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    owner = np.searchsorted(cuts, starts, side="right") - 1
    hashes = span_hashes(data, starts, ends, powers or _Powers())
    new = distinct_spans(data, owner, starts, ends, hashes)
    return {
        "words": np.bincount(owner, minlength=rows),
        "distinct_words": np.bincount(owner[new], minlength=rows),
        "capitals": count(CAPITAL),
        "code_points": count(FIRST),
        "symbols": count(SYMBOL),
        "bytes": np.diff(cuts),
    }


def document_facts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per document: its id, ``part`` (NULL as the empty string), the transducer's counts, and ``text_hash`` (128 bits).

    A NULL text is an empty one. Other columns are not read. Texts are taken whole, about a MB at a time; a longer one is taken
    alone, and takes some 60 times its size in the task. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        powers = _Powers()
        for batch in batches:
            texts = strings(batch, "text")
            for i, j in slices(texts, SMALL_SLICE):
                some = texts.slice(i, j - i)
                counts = transduce(some, powers)
                digests = [xxhash.xxh3_128_digest(x.as_buffer()) for x in some]
                columns = [batch.column("doc_id").slice(i, j - i), batch.column("part").slice(i, j - i)]
                columns += [pa.array(x.astype(np.int64)) for x in counts.values()]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.binary())], ["doc_id", "part", *counts, "text_hash"])

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text")
    )
    return rows.mapInArrow(run, FACTS)


def contract_filters() -> dict[str, Column]:
    """The filters that look at one document, by letter: true where it fails."""
    return {
        "A": F.col("words") < 100,
        "B": 100 * F.col("distinct_words") < 80 * F.col("words"),
        "C": 100 * F.col("capitals") > 10 * F.col("code_points"),
        "D": F.col("symbols") > 0,
    }


def failure_counts(facts: DataFrame, labels: DataFrame, filters: Mapping[str, Column], repeats: str = "E") -> tuple[DataFrame, str]:
    """Documents per ``part``, ``fails`` (a bit per filter, the first filter lowest), ``good`` and ``toxic``; and the letters.

    The last filter, ``repeats``, fails a document whose text any smaller id has; a NULL id is after all others, and rows with one
    id are no smaller than each other. ``labels`` may hold an id more than once: it is good (toxic) if any row says so.
    """
    letters = "".join(filters) + repeats
    bits = sum((F.when(failing, 1 << k).otherwise(0) for k, failing in enumerate(filters.values())), F.lit(0))
    labelled = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    rows = facts.select("doc_id", "part", "text_hash", "bytes", bits.alias("own"))
    # rows without an id have no label: they are spread by text instead of meeting under NULL
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text_hash")).otherwise(F.lit(0))
    labelled = labelled.withColumn("_spread", F.lit(0).cast("bigint"))
    rows = rows.withColumn("_spread", spread.cast("bigint"))
    rows = rows.join(labelled, (rows["doc_id"] == labelled["_id"]) & (rows["_spread"] == labelled["_spread"]), "left").select(
        F.coalesce("doc_id", F.lit(LAST)).alias("id"), "part", "text_hash", "bytes", "own",
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )
    text, kind = ["text_hash", "bytes"], ["part", "own", "good", "toxic"]
    by_id = rows.groupBy(*text, *kind, "id").agg(F.count("*").alias("n"))
    by_kind = by_id.groupBy(*text, *kind).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("least"))
    first = F.min("least.id").over(Window.partitionBy(*text))
    firsts = F.when(F.col("least.id") == first, F.col("least.n")).otherwise(0)
    repeated = 1 << len(filters)
    both = by_kind.withColumn("firsts", firsts).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("own").alias("fails"), F.col("firsts").alias("n")),
            F.struct((F.col("own") + repeated).alias("fails"), (F.col("n") - F.col("firsts")).alias("n")),
        )),
    )
    return both.filter("n > 0").groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n")), letters


def every_order(counts: DataFrame, letters: str) -> DataFrame:
    """Per part, order of the filters and step, zeros included: what stays, goes, was gone already, and each filter's share.

    ``counts`` holds a row per part, set of failed filters and labels, so each part costs at most 2^filters x 4 rows here.
    """
    bit = {c: 1 << k for k, c in enumerate(letters)}
    steps = []
    for order in permutations(letters):
        before = 0
        for number, letter in enumerate(order, 1):
            steps.append({"filter_order": "".join(order), "step": number, "own": bit[letter], "before": before})
            before |= bit[letter]
    # one constant of the plan: as expressions, the steps of five filters take Spark half a minute to plan
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, own int, before int>>")
    rows = counts.select("*", F.inline(table))
    fails, gone = (F.col("fails").bitwiseAND(F.col(c)) != 0 for c in ("own", "before"))
    here = fails & ~gone
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    found = rows.groupBy("part", "filter_order", "step", "own").agg(
        total(~fails & ~gone).alias("kept"),
        total(here).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("fails") == F.col("own")).alias("unique_fails"),
        total(here & (F.col("good") == 1)).alias("good_lost"),
        total(here & (F.col("toxic") == 1)).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "own"))
    return found.withColumn("shapley", shapley).drop("own")
