"""Exact token counts: a histogram of encoded lengths whose suffix sums answer every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subvent.llm.common import Units, kept_in_worker, slices, strings
from subvent.llm.piece_bpe import read_ranks

#: Lengths of one block share their leading bits; sums go over blocks first, so no task gets all lengths.
BLOCK_BITS = 10


def rank_units(path: str, pattern: str) -> Units:
    """Pieces encoded by the tiktoken library and the rank file at ``path``, kept in the Python worker."""

    def make() -> Units:
        import tiktoken

        encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
        return Units(lambda pieces: [encoding.encode_ordinary(p) for p in pieces], spaced=True)

    return kept_in_worker(f"ranks:{path}:{pattern}", make)


def encoded_lengths(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """One row ``n_tokens`` per document; NULL text counts as empty, length 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = rank_units(path, pattern)
        for batch in batches:
            texts = strings(batch, text)
            for i, j in slices(texts):
                yield pa.RecordBatch.from_arrays([pa.array(units.ids(texts.slice(i, j - i))[1])], ["n_tokens"])

    return docs.select(text).mapInArrow(run, "n_tokens bigint")


def length_histogram(lengths: DataFrame, n_tokens: str = "n_tokens") -> DataFrame:
    """``n_tokens`` and ``docs``, one row per length that occurs; partial sums before the shuffle. NULL lengths count as 0."""
    length = F.coalesce(F.col(n_tokens), F.lit(0)).cast("bigint").alias("n_tokens")
    return lengths.select(length).groupBy("n_tokens").agg(F.count("*").alias("docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """For each length L of a ``length_histogram``, taken as a context limit:

    ``docs`` of just this length, ``docs_longer`` and ``tokens_longer`` (documents over the limit and all their
    tokens), ``docs_within``, ``tokens_total`` (all tokens of all documents), ``tokens_truncated`` (tokens kept when
    every document is cut at L), and ``share_within`` (the L is a quantile for every share up to this one).

    ``at_limit`` answers any other limit. An empty histogram gives no rows.
    """
    rows = histogram.select(
        F.shiftright("n_tokens", BLOCK_BITS).alias("_block"), "n_tokens", "docs", (F.col("n_tokens") * F.col("docs")).alias("_tokens")
    )
    blocks = rows.groupBy("_block").agg(F.sum("docs").alias("_docs"), F.sum("_tokens").alias("_sum"))
    later = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(later), F.lit(0)).alias("_docs_after"),
        F.coalesce(F.sum("_sum").over(later), F.lit(0)).alias("_tokens_after"),
        F.sum("_docs").over(every).alias("_docs_all"),
        F.sum("_sum").over(every).alias("tokens_total"),
    )
    inside = Window.partitionBy("_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer = F.coalesce(F.sum("docs").over(inside), F.lit(0)) + F.col("_docs_after")
    tokens = F.coalesce(F.sum("_tokens").over(inside), F.lit(0)) + F.col("_tokens_after")
    return (
        rows.join(blocks, "_block")
        .select("n_tokens", "docs", longer.alias("docs_longer"), tokens.alias("tokens_longer"), "_docs_all", "tokens_total")
        .withColumn("docs_within", F.col("_docs_all") - F.col("docs_longer"))
        .withColumn("tokens_truncated", F.col("tokens_total") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer"))
        .withColumn("share_within", F.col("docs_within") / F.col("_docs_all"))
        .drop("_docs_all")
    )


def at_limit(limits: DataFrame, limit: int) -> dict[str, int]:
    """``docs_within`` and ``tokens_truncated`` at any ``limit``, read from the next smaller length of ``context_limits``."""
    total = limits.agg(F.max(F.struct("n_tokens", "docs_within", "tokens_total"))).first()[0]
    if total is None:
        return {"docs_within": 0, "tokens_truncated": 0}
    row = limits.filter(F.col("n_tokens") <= limit).agg(F.max(F.struct("n_tokens", "docs_within", "docs_longer", "tokens_longer"))).first()[0]
    if row is None:
        return {"docs_within": 0, "tokens_truncated": limit * total["docs_within"]}
    return {"docs_within": row["docs_within"], "tokens_truncated": total["tokens_total"] - row["tokens_longer"] + limit * row["docs_longer"]}


def quantile(limits: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of the documents do not exceed; exact. None for no documents."""
    return limits.filter(F.col("share_within") >= share).agg(F.min("n_tokens")).first()[0]
