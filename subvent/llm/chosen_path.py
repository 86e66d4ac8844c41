"""Jaccard join of word n-grams by chosen paths.

1. Every document becomes its set of shingles and a sketch of it: one token (the smallest hash under a function) in each
   of many places. Documents with equal sets are one representative.
2. A run splits all representatives recursively. A node draws places at random, 1 / similarity of them on average, and
   representatives that hold the same token there go to the same child. Similar sets share a whole path with a chance
   that dissimilar ones lose exponentially. A node of few representatives is compared by brute force, on sketches. As
   many runs are made as the target recall asks for at the depth that nodes reach; after the first few, nodes of what is
   linked already are left out.
3. Candidates found are linked into groups, and inside a group all pairs are compared exactly, on the shingles, in tiles of
   bounded size. Links are counted and joined to classes; pairs are never written.

Paths, groups and tiles are spread by hash. A node or group of any size is one key only in sums; what is gathered for a
comparison is bounded: LEAF representatives of a node, TILE of a group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subvent.llm.common import chunked, column, forget_kept, slices, staged, strings
from subvent.llm.substring import _MULTIPLIERS, _mixed, _rolled, window_starts, word_hashes
from subvent.sources.staging import drop_paths, written_paths

#: Words of a shingle, similarity of a link, tokens of a sketch.
WORDS, SIMILARITY, PLACES = 5, 0.8, 64
#: A pair at the least similarity is found with this chance. Runs are made for nodes that are split DEPTH times before they
#: are small, and further ones where nodes were split more often.
RECALL, DEPTH = 0.999, 3
#: Runs before groups are put together for the others.
FIRST_RUNS = 3
#: Representatives of a node that is compared by brute force, and most levels of splits. A larger node that kept the
#: similarity's share of its parent's members, or is left at the last level, becomes candidates whole: all its pairs
#: are compared exactly, and no split would part them.
LEAF, LEVELS = 256, 8
#: Standard deviations by which a sketch may fall short of the similarity.
SLACK = 4.0
#: Representatives and shingles of a block of a group, about; a tile compares two blocks. Shingles and rows that a task takes at once.
TILE, TILE_SHINGLES, TASK_SHINGLES, TASK_ROWS = 1024, 1 << 20, 2 << 20, 16384


def runs_for(recall: float, depth: int, places: int | None = None, similarity: float = SIMILARITY) -> int:
    """Runs after which a pair at the least similarity has met with chance ``recall``.

    Its number of common children is about Poisson with mean 1, so it meets after d splits with chance
    s(d) = 1 - exp(-s(d - 1)), s(0) = 1. With ``places`` the mean is that of k equal tokens in a sketch of so many, and
    the chance is averaged over the k that such a pair has.
    """
    if places is None:
        shares, means = np.ones(1), np.ones(1)
    else:
        equal = np.arange(max(1, _least_equal(similarity, places)), places + 1)
        shares = np.asarray([math.comb(places, k) * similarity**k * (1 - similarity) ** (places - k) for k in equal.tolist()])
        shares, means = shares / shares.sum(), equal / (similarity * places)
    meet = np.ones(len(means))
    for _ in range(depth):
        meet = 1 - np.exp(-means * meet)
    runs = 1
    while shares @ (1 - meet) ** runs > 1 - recall:
        runs += 1
    return runs


def _least_equal(similarity: float, places: int) -> int:
    """Equal tokens of two sketches from which on their sets are compared."""
    return math.floor(places * similarity - SLACK * math.sqrt(places * similarity * (1 - similarity)))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and how many each has.

    A text of fewer words has one shingle of all its words; one without words has none.
    """
    found, counts = [], []
    with np.errstate(over="ignore"):
        for i, j in slices(texts):
            part = texts.slice(i, j - i)
            first, _, n = word_hashes(part)
            starts = window_starts(n, words)
            hashes = _rolled(first, words, _MULTIPLIERS[0])[starts] if len(starts) else np.zeros(0, np.uint64)
            rows = np.repeat(np.arange(len(n)), np.maximum(n - words + 1, 0))
            short = np.flatnonzero((n > 0) & (n < words))
            if len(short):
                whole = [xxhash.xxh3_64_intdigest(b" ".join(part[int(k)].as_buffer().to_pybytes().split())) for k in short]
                hashes, rows = np.concatenate([hashes, np.asarray(whole, np.uint64)]), np.concatenate([rows, short])
            order = np.lexsort((hashes, rows))
            hashes, rows = hashes[order], rows[order]
            new = np.ones(len(rows), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
            found.append(hashes[new])
            counts.append(np.bincount(rows[new], minlength=len(n)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(counts)


def sketches(hashes: np.ndarray, counts: np.ndarray, places: int = PLACES) -> np.ndarray:
    """One token per place of each set; 0 for an empty set."""
    some = np.flatnonzero(counts)
    out = np.zeros((len(counts), places), np.uint32)
    if not len(some):
        return out
    at = (np.cumsum(counts) - counts)[some]
    odd = np.random.default_rng(7).integers(0, 2**32, (places, 2), dtype=np.uint32) | np.uint32(1)
    step = 1 << 16  # stays in the processor's cache
    low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    with np.errstate(over="ignore"):
        for k in range(places):
            mixed = np.empty_like(low)
            for i in range(0, len(low), step):
                x = low[i : i + step] * odd[k, 0]
                x ^= x >> np.uint32(15)
                x *= odd[k, 1]
                x ^= x >> np.uint32(13)
                mixed[i : i + step] = x
            out[some, k] = np.minimum.reduceat(mixed, at)
    return out


def _identity(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that equal sets share, whatever their order."""
    out = []
    with np.errstate(over="ignore"):
        for salt in (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(hashes + salt), dtype=np.uint64)])
            ends = np.cumsum(counts)
            out.append((sums[ends] - sums[ends - counts]).view(np.int64))
    return out[0], out[1]


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected to, for each end of ``links``.

    Alternating large and small stars (Kiveris et al., 2014): each round links the larger neighbours of a node to its
    smallest one, until nothing changes; each round is written to the shared folder.
    """
    pair = lambda df, a, b: df.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    edges = staged(pair(links, u, v), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return staged(edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots), "labels")


def _stars(alike: np.ndarray) -> np.ndarray:
    """For each of m groups of n members: the first member that each is connected to, by the links of ``alike`` (m, n, n)."""
    n = alike.shape[1]
    linked = alike | np.eye(n, dtype=bool)
    label = np.broadcast_to(np.arange(n), alike.shape[:2]).copy()
    while True:
        now = np.where(linked, label[:, None, :], n).min(axis=2)
        if (now == label).all():
            return label
        label = now


def _compare_leaves(places: int, least: int):
    """Links inside the leaves of a task, as stars of what is connected there."""

    def run(part: pa.Table) -> pa.Table:
        leaf, rep = column(part, "leaf").to_numpy(), column(part, "rep").to_numpy()
        tokens = np.asarray(column(part, "sketch").flatten()).reshape(-1, places)
        order = np.lexsort((rep, leaf))
        leaf, rep, tokens = leaf[order], rep[order], tokens[order]
        starts = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
        sizes = np.diff([*starts, len(leaf)])
        a, b = [], []
        for n in np.unique(sizes[sizes > 1]):
            own = starts[sizes == n]
            at_once = max(1, (4 << 20) // (int(n) * int(n) * places))
            for i in range(0, len(own), at_once):
                rows = own[i : i + at_once, None] + np.arange(n)
                some = tokens[rows]
                equal = (some[:, :, None, :] == some[:, None, :, :]).sum(axis=3)
                label = _stars(equal >= least)
                other = label != np.arange(n)
                a.append(rep[rows[other]])
                b.append(rep[np.take_along_axis(rows, label, 1)[other]])
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"u": join(a), "v": join(b)})

    return run


def _overlaps(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    order = np.argsort(hashes, kind="stable")
    values, owner = hashes[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    many = np.bincount(number) > 1 if len(number) else np.zeros(0, bool)
    shared = many[number] if len(number) else np.zeros(0, bool)
    owner, number = owner[shared], (np.cumsum(many) - 1)[number[shared]] if len(number) else number
    out = np.zeros((n, n), np.float32)
    total = int(number[-1]) + 1 if len(number) else 0
    for low in range(0, total, 4096):
        i, j = np.searchsorted(number, [low, low + 4096])
        dense = np.zeros((n, min(4096, total - low)), np.float32)
        dense[owner[i:j], number[i:j] - low] = 1
        out += dense @ dense.T
    return out


def _compare_tiles(similarity: float):
    """Per representative of a tile: ``v``, one it is connected to there, and ``n``, its links that this tile counts."""

    def run(part: pa.Table) -> pa.Table:
        names = ("tile", "rep", "side")
        tile, rep, side = (column(part, c).to_numpy() for c in names)
        sets = column(part, "shingles")
        order = np.lexsort((rep, tile))
        out: list[list[np.ndarray]] = [[], [], []]
        cuts = np.flatnonzero(tile[order][1:] != tile[order][:-1]) + 1
        for own in np.split(order, cuts):
            if len(own) < 2:
                continue
            hashes = [np.frombuffer(sets[int(k)].as_buffer(), "<u8") for k in own]
            counts = np.asarray([len(h) for h in hashes])
            common = _overlaps(np.concatenate(hashes), counts)
            alike = common >= similarity * (counts[:, None] + counts[None, :] - common) - 1e-6
            np.fill_diagonal(alike, False)
            half = side[own]
            if (half > 0).any():  # two blocks: pairs inside a block are those of its own tile
                alike &= half[:, None] != half[None, :]
            label = _stars(alike[None])[0]
            some = alike.any(axis=1)
            out[0].append(rep[own][some])
            out[1].append(rep[own][label[some]])
            out[2].append(alike.sum(axis=1)[some])
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        return pa.table({"u": join(out[0]), "v": join(out[1]), "n": join(out[2])})

    return run


def _candidates(reps: DataFrame, similarity: float, places: int, recall: float, depth: int) -> DataFrame:
    """Links ``u``, ``v`` between representatives that some run found alike on their sketches.

    After the first few runs, what they have linked is put together into groups. All pairs of a group will be compared
    anyway, so the other runs leave out nodes that lie in one group, and settle those that do but for a few members: a large
    group of near copies, which no split makes small, is split in the first runs only. Nodes of what is not yet linked may be split more than ``depth`` times; then
    runs are added, for the representatives that were in such nodes alone, until there are as many as that depth asks for: all
    others have met whom they are like at fewer splits.
    """
    needed = lambda splits: runs_for(recall, max(depth, splits), places, similarity)
    least = _least_equal(similarity, places)
    runs = needed(depth)
    first = min(FIRST_RUNS, runs)
    found, splits, deep = _some_runs(reps.withColumn("label", F.col("rep")), range(first), similarity, places, least, depth)
    if first == runs and needed(splits) == runs:
        return found
    labels = components(found).select(F.col("node").alias("rep"), "label")
    grouped = staged(reps.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "grouped")
    done = first
    if done < runs:
        links, more, others = _some_runs(grouped, range(done, runs), similarity, places, least, depth, grouped=True)
        found, done, splits, deep = found.unionByName(links), runs, max(splits, more), deep.unionByName(others)
    while done < needed(splits):
        grouped = staged(grouped.join(deep.distinct(), "rep", "left_semi"), "grouped")
        runs = needed(splits)
        links, more, deep = _some_runs(grouped, range(done, runs), similarity, places, least, depth, grouped=True)
        found, done, splits = found.unionByName(links), runs, max(splits, more)
    return found


def _mostly_one_group(large: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the ``large`` nodes that are split on, and of the others, if any, ``leaf`` and ``rep``, to be compared by brute force.

    Pairs inside a group need no comparison. A node that one group fills but for a few is settled at once, in leaves of a block of
    the group and all the others: about twice its rows in all, where splits would carry the group along for the others' sake.
    """
    own = large.groupBy("node", "label").agg(F.count("*").alias("_own"), F.first("n").alias("n"))
    main = own.groupBy("node").agg(F.max(F.struct("_own", "label")).alias("_main"), F.first("n").alias("n"))
    others = F.col("n") - F.col("_main._own")
    main = main.filter(others <= LEAF // 2).select(
        "node", F.col("_main.label").alias("_main"), F.ceil(F.col("_main._own") / (LEAF - others)).cast("int").alias("_blocks")
    )
    main = staged(main, "main_groups")  # a row per node
    if not main.take(1):
        return large, None
    block = F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int")
    blocks = F.when(F.col("label") == F.col("_main"), F.array(block)).otherwise(F.sequence(F.lit(0), F.col("_blocks") - 1))
    rows = large.join(main, "node").select("node", "rep", F.explode(blocks).alias("block"))
    return large.join(main, "node", "left_anti"), staged(rows.select(F.xxhash64("node", "block").alias("leaf"), "rep"), "blocks")


def _some_runs(
    reps: DataFrame, runs: range, similarity: float, places: int, least: int, depth: int, grouped: bool = False
) -> tuple[DataFrame, int, DataFrame]:
    """Links that these runs find between representatives of different ``label``, how often a node was split at most, and the
    representatives (``rep``) in nodes that come of more than ``depth`` splits. With ``grouped``, ``label`` is a group found before.

    What a level leaves to compare or link is read from written tables by scans alone, so no plan holds joins or sums per level:
    the driver keeps all stages and tasks of a plan until it ends.
    """
    spark = reps.sparkSession
    share = 1 / (similarity * places)
    drawn = lambda node, i: F.pmod(F.xxhash64(node, i), F.lit(1 << 30)) < int(share * (1 << 30))
    every = F.sequence(F.lit(0), F.lit(places - 1))
    roots = spark.range(runs.start, runs.stop).select(F.xxhash64("id").alias("node"))
    paths = roots.select("node", F.explode(every).alias("i")).filter(drawn(F.col("node"), F.col("i"))).collect()
    if not paths:
        return spark.createDataFrame([], "u bigint, v bigint"), 0, spark.createDataFrame([], "rep bigint")
    first = F.explode(F.array(*[F.struct(F.lit(r["node"]).alias("node"), F.lit(r["i"]).alias("i")) for r in paths]))
    child = lambda df: df.select("rep", "label", F.xxhash64("node", "i", F.get("sketch", "i")).alias("node"), "parent")
    start = reps.select("rep", "label", "sketch", F.lit(None).cast("bigint").alias("parent"), first.alias("x"))
    level = child(start.select("rep", "label", "sketch", "parent", "x.*"))
    leaves, links, blocks, deep = None, None, None, spark.createDataFrame([], "rep bigint")
    for number in range(LEVELS):
        level, path = staged(level, "paths"), written_paths(spark)[-1]
        sizes = level.groupBy("node").agg(
            F.count("*").alias("n"), F.min("label").alias("_low"), F.max("label").alias("_high"), F.max("parent").alias("_parent"),
            F.min("rep").alias("_first"),
        )
        # the share of its parent's members that a child keeps is about how similar they are
        alike = F.lit(True) if number == LEVELS - 1 else F.col("n") >= similarity * F.col("_parent")
        sizes = sizes.filter("_low < _high").select("node", "n", F.when((F.col("n") > LEAF) & alike, F.col("_first")).alias("first"))
        level = staged(level.drop("parent").join(sizes, "node"), "nodes")
        drop_paths(spark, [path])  # what goes on is in the nodes
        if number == depth:  # what is deeper was here
            deep = level.select("rep")
        small = level.filter(F.col("n") <= LEAF).select("node", "rep")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = level.filter(F.col("n") > LEAF)
        if not large.take(1):
            break
        large, mixed = _mostly_one_group(large) if grouped else (large, None)
        stars = large.filter("rep <> first").select(F.col("rep").alias("u"), F.col("first").alias("v"))
        if mixed is not None:
            blocks = mixed if blocks is None else blocks.unionByName(mixed)
            stars = staged(stars, "stars")
        links = stars if links is None else links.unionByName(stars)
        if number == LEVELS - 1:
            break
        rest = large.filter("first IS NULL").select("rep", "node", F.col("n").alias("parent"))
        if not rest.take(1):
            break
        sampled = F.explode(F.filter(every, lambda i: drawn(F.col("node"), i))).alias("i")
        level = child(rest.join(reps, "rep").select("rep", "label", "sketch", "node", "parent", sampled))
    sets = leaves.groupBy("node").agg(F.sort_array(F.collect_list("rep")).alias("reps")).select("reps").distinct()
    sets = staged(sets.select(F.monotonically_increasing_id().alias("leaf"), "reps"), "leaves")
    rows = sets.agg(F.sum(F.size("reps"))).first()[0] or 0
    spread = sets.select("leaf", F.explode("reps").alias("rep"))
    if blocks is not None:
        rows, spread = rows + blocks.count(), spread.unionByName(blocks)
    tasks = max(1, math.ceil(rows / TASK_ROWS))
    spread = spread.join(reps.select("rep", "sketch"), "rep")
    spread = spread.withColumn("_task", F.pmod(F.xxhash64("leaf"), F.lit(tasks)))
    found = spread.groupBy("_task").applyInArrow(_compare_leaves(places, least), "u bigint, v bigint")
    return staged((found if links is None else found.unionByName(links)).distinct(), "candidates"), number + 1, deep


def jaccard_classes(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    words: int = WORDS,
    text: str = "text",
    id_col: str = "doc_id",
    places: int = PLACES,
    recall: float = RECALL,
    depth: int = DEPTH,
) -> DataFrame:
    """Per document: ``doc`` (a struct of its row), ``class_id`` (the smallest id of its class), ``n_links``, ``n_copies``, ``keep``.

    Documents are linked if the Jaccard similarity of their sets of ``words``-word shingles is at least ``similarity``; a class
    is what links connect. ``n_links`` counts the other distinct sets it is linked to, ``n_copies`` the documents with its own
    set, itself among them. One document of each class has ``keep``: the smallest id, then the first read. Words are cut at
    white space, unchanged; a text of fewer than ``words`` words has one shingle of them all. A NULL text or one without
    words is a class of its own, linked to nothing. A NULL id sorts after all others. Rows with the same id are documents
    of their own. An empty table gives no rows. Equal sets are joined for certain, pairs at ``similarity`` with chance
    ``recall``, more similar ones nearly for certain; every link is checked exactly.
    """
    table = chunked(docs.select(F.struct("*").alias("doc")), "join_texts")
    fields = [F.col(f"doc.`{id_col}`").cast("bigint").alias("id"), F.col(f"doc.`{text}`").alias("text")]

    def sketch(batches):
        forget_kept()
        for batch in batches:
            texts = strings(batch, "text")
            for i, j in slices(texts):
                hashes, counts = shingle_sets(texts.slice(i, j - i), words)
                a, b = _identity(hashes, counts)
                tokens = sketches(hashes, counts, places).view(np.int32)
                ends = np.arange(0, tokens.size + 1, places, dtype=np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(tokens.ravel()))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), part.column("id"), pa.array(a), pa.array(b), pa.array(counts.astype(np.int64)), lists],
                    ["_row", "id", "a", "b", "n", "sketch"],
                )

    sketched = staged(
        table.select("_row", *fields).mapInArrow(sketch, "_row bigint, id bigint, a bigint, b bigint, n bigint, sketch array<int>"), "sketches"
    )
    with_words = sketched.filter("n > 0")
    sets = with_words.groupBy("a", "b", "n").agg(F.min("_row").alias("rep"), F.count("*").alias("n_copies"))
    sets = staged(sets, "sets")
    reps = staged(
        with_words.select(F.col("_row").alias("rep"), "sketch").join(sets.select("rep"), "rep", "left_semi"), "representatives"
    )
    groups = components(_candidates(reps, similarity, places, recall, depth))
    sized = groups.join(sets.select(F.col("rep").alias("node"), F.col("n").alias("_n")), "node")
    sizes = sized.groupBy("label").agg(F.greatest(F.count("*") / TILE, F.sum("_n") / TILE_SHINGLES).alias("_size"))
    members = groups.join(sizes, "label").select(
        F.col("node").alias("rep"), "label", F.ceil("_size").cast("int").alias("blocks"), F.shiftright("node", 12).alias("_chunk")
    )

    def cut(part: pa.Table, heard: pa.Table) -> pa.Table:
        row, asked = column(part, "_row").to_numpy(), column(heard, "rep").to_numpy() if len(heard) else np.zeros(0, np.int64)
        order = np.argsort(row)
        at = order[np.searchsorted(row, asked, sorter=order)] if len(asked) else asked
        texts = strings(part, "text").take(pa.array(at))
        hashes, counts = shingle_sets(texts, words)
        ends = 8 * np.cumsum(np.concatenate([[0], counts]))
        raw = hashes.astype("<u8").tobytes()
        data = pa.array([raw[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
        kept = [column(heard, c) if len(heard) else pa.array([], t) for c, t in (("rep", pa.int64()), ("label", pa.int64()), ("blocks", pa.int32()))]
        return pa.table([*kept, data], ["rep", "label", "blocks", "shingles"])

    shingled = staged(
        table.select("_chunk", "_row", fields[1])
        .groupBy("_chunk")
        .cogroup(members.groupBy("_chunk"))
        .applyInArrow(cut, "rep bigint, label bigint, blocks int, shingles binary"),
        "shingles",
    )
    # a member of block i goes to the tiles (i, j) and (j, i) for all j; tiles of small groups share a task
    total = shingled.agg(F.sum(F.length("shingles") / 8)).first()[0] or 0
    tasks = max(1, math.ceil(total / TASK_SHINGLES))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    low, high = F.least("block", "other"), F.greatest("block", "other")
    tiles = (
        shingled.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "rep", "shingles", F.xxhash64("label", low, high).alias("tile"), (F.col("block") > F.col("other")).cast("int").alias("side"),
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("label"), F.lit(tasks))).otherwise(F.xxhash64("label", low, high)).alias("_task"),
        )
    )
    linked = staged(tiles.groupBy("_task").applyInArrow(_compare_tiles(similarity), "u bigint, v bigint, n bigint"), "linked")
    labels = components(linked)
    links = linked.groupBy("u").agg(F.sum("n").alias("n_links"))
    classes = (
        sets.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .join(links.withColumnRenamed("u", "rep"), "rep", "left")
        .select("a", "b", "n", F.coalesce("label", "rep").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    )
    rows = staged(
        sketched.select("_row", "id", "a", "b", "n")
        .join(classes, ["a", "b", "n"], "left")
        .select("_row", "id", F.coalesce("label", "_row").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies")),
        "rows",
    )
    unknown = F.coalesce("id", F.lit(2**63 - 1))
    heads = rows.groupBy("label").agg(F.min("id").alias("class_id"), F.min(F.struct(unknown, "_row")).alias("head"))
    found = rows.join(heads, "label").select(
        "_row", F.shiftright("_row", 12).alias("_chunk"), "class_id", "n_links", "n_copies", (F.col("head._row") == F.col("_row")).alias("keep")
    )
    names = ("class_id", "n_links", "n_copies", "keep")

    def attach(part: pa.Table, heard: pa.Table) -> pa.Table:
        row, at = column(part, "_row").to_numpy(), column(heard, "_row").to_numpy()
        order = np.argsort(at)
        heard = heard.take(pa.array(order[np.searchsorted(at, row, sorter=order)]))
        return pa.table([column(part, "doc"), *(column(heard, c) for c in names)], ["doc", *names])

    kinds = [table.schema["doc"].dataType, T.LongType(), T.LongType(), T.LongType(), T.BooleanType()]
    out = T.StructType([T.StructField(*x) for x in zip(("doc", *names), kinds, strict=True)])
    return table.groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInArrow(attach, out)


def membership(joined: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``jaccard_classes`` by ``id_col`` alone, without texts."""
    return joined.select(F.col(f"doc.`{id_col}`"), "class_id", "n_links", "n_copies")

