"""Near duplicates by fast similarity sketching, bands, and a check of every link on whole sets.

1. Sketch (Dahlgaard, Knudsen and Thorup, 2017). A set has a coordinate per bin. In a round every element is hashed to one bin and a
   value there; a bin that no earlier round has filled keeps the least value. After as many rounds as bins, round t + b puts every
   element into bin b, so that every coordinate fills. Equal coordinates are as frequent as the sets are similar, with the
   concentration of sampling without replacement, at about one hash per element and round instead of one per coordinate.
2. Bands. Documents with equal sets are one representative. Representatives that agree on a band of coordinates share a bucket.
3. Hubs. Each bucket has a hub, the member that shares most buckets with others, and every member is compared with it on the whole
   sets. In a family of near copies the hub is what they are copies of, so one comparison each joins most of them.
4. The rest. Where members that are not the hub are still apart, they are compared by their rarest shingles: of two linked
   sets the first shared shingle, in an order by frequency, stands so far in front that what follows in both can still make up
   the overlap. Only such pairs of different groups are formed, each with a member of the shingle's lesser groups, and checked.

No pair is formed inside a group that is linked already, and no bucket is gathered in a task. Links are lost only if no band
agrees: at similarity 0.85 a pair is missed with chance 3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subvent.llm.chosen_path import _identity, components, shingle_sets
from subvent.llm.common import SMALL_SLICE, chunked, column, forget_kept, slices, staged, strings
from subvent.plans.lookup import attach

#: Words of a shingle; a link in hundredths; bands of a sketch and coordinates of a band.
WORDS, PERCENT, BANDS, WIDTH = 5, 85, 32, 6
#: Rows of a chunk, a power of two, and texts that are sketched at once.
CHUNK, AT_ONCE = 1024, 2048
_EMPTY = np.uint64(1 << 32)  # above any value


def _hashed(elements: np.ndarray, number: int) -> np.ndarray:
    """The hash function of a round: the bin from its upper half, the value its lower half."""
    with np.errstate(over="ignore"):
        h = (elements ^ np.uint64(0x9E3779B97F4A7C15 * (number + 1) % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
        return h ^ (h >> np.uint64(29))


def fast_sketches(hashes: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """A value of 32 bits per bin for each set of 64-bit ``hashes``; 0 for an empty set."""
    out = np.full((len(counts), bins), _EMPTY, np.uint64)
    out[counts == 0] = 0
    open_rows = np.flatnonzero(counts)
    elements, sizes = hashes, counts[open_rows]
    low = np.uint64(0xFFFFFFFF)
    for number in range(bins):
        if not len(open_rows):
            break
        h = _hashed(elements, number)
        at = np.repeat(np.arange(len(open_rows)) * bins, sizes) + (((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
        now = np.full(len(open_rows) * bins, _EMPTY, np.uint64)
        np.minimum.at(now, at, h & low)
        before = out[open_rows]
        out[open_rows] = after = np.where(before == _EMPTY, now.reshape(-1, bins), before)
        unfilled = (after == _EMPTY).any(axis=1)
        if not unfilled.all():
            elements, open_rows, sizes = elements[np.repeat(unfilled, sizes)], open_rows[unfilled], sizes[unfilled]
    if len(open_rows):
        starts = np.cumsum(sizes) - sizes
        for b in range(bins):
            value = np.minimum.reduceat(_hashed(elements, bins + b) & low, starts)
            held = out[open_rows, b]
            out[open_rows, b] = np.where(held == _EMPTY, value, held)
    return out


def band_keys(sketches: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key per band of each sketch."""
    parts = sketches.reshape(len(sketches), bands, -1)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), parts.shape[:2])
        for k in range(parts.shape[2]):
            key = (key ^ parts[:, :, k]) * np.uint64(0xD6E8FEB86659FD93)
            key = key ^ (key >> np.uint64(31))
    return key.view(np.int64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def _sketched(table: DataFrame, words: int, bands: int, width: int) -> DataFrame:
    """``row``, ``id``, the identity ``a``, ``b``, ``n`` of the set, and ``keys``, of the documents of a chunked table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for batch in batches:
            texts = pc.ascii_lower(strings(batch, "text"))
            for i, j in slices(texts, SMALL_SLICE):
                for k in range(i, j, AT_ONCE):
                    n = min(j - k, AT_ONCE)
                    hashes, counts = shingle_sets(texts.slice(k, n), words)
                    a, b = _identity(hashes, counts)
                    keys = band_keys(fast_sketches(hashes, counts, bands * width), bands)
                    columns = [batch.column("_row").slice(k, n), batch.column("id").slice(k, n), pa.array(a), pa.array(b)]
                    columns += [pa.array(counts.astype(np.int64)), _lists(keys.ravel(), np.full(n, bands))]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "id", "a", "b", "n", "keys"])

    return table.select("_row", "id", "text").mapInArrow(run, "row bigint, id bigint, a bigint, b bigint, n bigint, keys array<bigint>")


def _shingled(table: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``rep`` and its sorted ``shingles`` for the rows ``rep`` of ``wanted``; texts stay where they are."""

    def cut(part: pa.Table, heard: pa.Table) -> pa.Table:
        row, rep = column(part, "_row").to_numpy(), column(heard, "rep").to_numpy() if len(heard) else np.zeros(0, np.int64)
        order = np.argsort(row)
        at = order[np.searchsorted(row, rep, sorter=order)] if len(rep) else rep
        hashes, counts = shingle_sets(pc.ascii_lower(strings(part.take(pa.array(at)), "text")), words)
        return pa.table([pa.array(rep), _lists(hashes.view(np.int64), counts)], ["rep", "shingles"])

    heard = wanted.select("rep", F.shiftright("rep", CHUNK.bit_length() - 1).alias("_chunk"))
    chunks = table.select("_chunk", "_row", "text").groupBy("_chunk")
    return chunks.cogroup(heard.groupBy("_chunk")).applyInArrow(cut, "rep bigint, shingles array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (u, v) whose whole sets are similar enough. A set that many pairs ask for goes to as many tasks."""
    for side in ("v", "u"):
        asked = staged(pairs.groupBy(side).agg(F.count("*").alias("_rows")), "asked")
        values = asked.join(sets.select(F.col("rep").alias(side), F.col("shingles").alias(f"_{side}")), side)
        pairs = attach(pairs, values, [side], "_rows", broadcast_rows=0)
    both = F.size(F.array_intersect("_u", "_v"))
    return pairs.filter(100 * both >= percent * (F.size("_u") + F.size("_v") - both)).select("u", "v")


def _hub_pairs(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``buckets`` (key, rep, size) with the ``hub`` of each, and the distinct pairs (u, v) of a member and its hub."""
    shared = buckets.groupBy("rep").agg(F.sum("size").alias("shared"))
    hubs = buckets.join(shared, "rep").groupBy("key").agg(F.max(F.struct("shared", (-F.col("rep")).alias("rep"))).alias("most"))
    found = staged(buckets.select("key", "rep").join(hubs.select("key", (-F.col("most.rep")).alias("hub")), "key"), "hubs")
    return found, staged(found.filter("rep <> hub").select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct(), "hub_pairs")


def _apart(found: DataFrame, labels: DataFrame) -> DataFrame:
    """``rep`` and ``label`` of members, but for hubs, of buckets whose members other than the hub are not all in one group."""
    members = found.filter("rep <> hub").join(labels, "rep", "left").select("key", "rep", F.coalesce("label", "rep").alias("label"))
    mixed = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    return members.join(mixed, "key", "left_semi").select("rep", "label").distinct()


def _rare_pairs(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of different groups whose first shared shingle leaves room for the overlap of a link.

    Shingles of a set are in order of frequency, then value. With the first shared one at places i and j of sets of m and n, at most
    1 + min(m - i, n - j) are shared, and a link needs percent / (100 + percent) of m + n. One of a pair is not of the
    group that most holders of the shingle are in.
    """
    held = apart.join(sets, "rep").select("rep", "label", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = held.groupBy("shingle").agg(F.count("*").alias("often"))
    ranked = (
        held.join(often, "shingle")
        .groupBy("rep", "label", "n")
        .agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("ranked"))
        # a partner has at least this share of the shingles, so no first shared one stands further back
        .select("rep", "label", "n", F.posexplode(F.expr(f"slice(ranked, 1, n - cast(ceil({percent} * n / 100) as int) + 1)")).alias("place", "at"))
        .filter("at.often > 1")
        .select("rep", "label", "n", (F.col("place") + 1).alias("place"), F.col("at.shingle").alias("shingle"))
    )
    ranked = staged(ranked, "ranked")
    sizes = ranked.groupBy("shingle", "label").agg(F.count("*").alias("held"))
    most = sizes.groupBy("shingle").agg(F.max(F.struct("held", "label")).alias("most"), F.count("*").alias("groups")).filter("groups > 1")
    ranked = staged(ranked.join(most.select("shingle", F.col("most.label").alias("most")), "shingle"), "ranked")
    u = ranked.filter("label <> most").select("shingle", *[F.col(c).alias(f"{c}_u") for c in ("rep", "label", "n", "place")])
    v = ranked.select("shingle", "most", *[F.col(c).alias(f"{c}_v") for c in ("rep", "label", "n", "place")])
    room = f"(1 + least(n_u - place_u, n_v - place_v)) * {100 + percent} >= {percent} * (n_u + n_v)"
    pairs = u.join(v, "shingle").filter(f"label_u <> label_v AND (label_v = most OR rep_u < rep_v) AND {room}")
    return staged(pairs.select(F.least("rep_u", "rep_v").alias("u"), F.greatest("rep_u", "rep_v").alias("v")).distinct(), "rare_pairs")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS, bands: int = BANDS, width: int = WIDTH
) -> DataFrame:
    """Per document ``id_col``, ``n_shingles``, ``component_id`` (the smallest id that links lead to) and ``kept``.

    A-Z are lower-cased and words are cut at white space. A document's set holds its distinct runs of ``words`` words; a shorter
    text is one run as a whole. Two documents are linked if the intersection of their sets is at least ``percent`` hundredths of the
    union. A NULL text, or one without words, is linked to nothing. Rows with one id are documents of their own; a NULL id is not smaller than
    any, and such a document alone has a NULL component. ``kept`` tells the documents whose id is their component's. Other columns are
    not read. An empty table gives no rows.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"))
    table = chunked(source, "sketch_texts", CHUNK)
    sketched = staged(_sketched(table, words, bands, width), "fast_sketches")
    with_words = sketched.filter("n > 0")
    sets = with_words.groupBy("a", "b", "n").agg(F.min("row").alias("rep"), F.min("id").alias("least"), F.count("*").alias("copies"))
    sets = staged(sets, "distinct_sets")
    reps = with_words.select(F.col("row").alias("rep"), "keys").join(sets.select("rep"), "rep", "left_semi")
    entries = staged(reps.select("rep", F.explode("keys").alias("key")), "bands")
    shared = entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = staged(entries.join(shared, "key"), "buckets")
    shingles = staged(_shingled(table, buckets.select("rep").distinct(), words), "shingles")
    found, pairs = _hub_pairs(buckets)
    links = staged(_confirmed(pairs, shingles, percent), "hub_links")
    labels = components(links).select(F.col("node").alias("rep"), "label")
    apart = staged(_apart(found, labels), "apart")
    more = staged(_confirmed(_rare_pairs(apart, shingles, percent), shingles, percent), "rare_links")
    if more.take(1):
        labels = components(links.unionByName(more)).select(F.col("node").alias("rep"), "label")
    grouped = staged(sets.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "grouped")
    heads = staged(grouped.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("_rows")), "heads")
    known = staged(attach(grouped, heads, ["label"], "_rows").select("a", "b", "n", "component_id", F.col("copies").alias("_rows")), "known")
    rows = sketched.select("id", "a", "b", "n")
    joined = attach(rows.filter("n > 0"), known, ["a", "b", "n"], "_rows").unionByName(
        rows.filter("n = 0").withColumn("component_id", F.col("id"))
    )
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
