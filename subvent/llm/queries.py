"""The registered queries of this folder and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subvent.llm import (
    ans,
    chosen_path,
    conversation_repair,
    fast_sketch,
    filter_audit,
    langid,
    lengths,
    packing,
    piece_bpe,
    prefix_forest,
    quality,
    substring,
    topk,
)
from subvent.sources.staging import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token_files")
    ans.write_token_files(
        _table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1, vocabulary=49408, added_tokens=True
    )
    return ans.read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs, model)
    return found.select(
        F.col("doc.doc_id"), langid.held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op4_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels")
    classifier, harm = quality.fit_classifier(docs, labels), quality.fit_words(docs, labels)
    found = quality.posterior(docs, classifier, host=F.col("source"), path=F.col("lang"), harm=harm)
    return found.select("doc.doc_id", "evidence", "host_good", "path_good", "p_good", "p_harm", "keep")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5, scale=256)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    index = prefix_forest.build_index(vectors, k=5)
    return prefix_forest.search(index, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op6_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.membership(chosen_path.jaccard_classes(_table(spark, sf_dir, "documents")))


def op8_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(_table(spark, sf_dir, "documents"), path, length=1024, end_id=0, added_tokens=True)
    return packing.piece_checksums(pieces)


def op9_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = piece_bpe.encode_texts(_table(spark, sf_dir, "documents"), path, pattern)
    return piece_bpe.round_trip_digests(encoded, path, pattern)


def op10_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = lengths.encoded_lengths(_table(spark, sf_dir, "documents"), path, pattern)
    return lengths.context_limits(lengths.length_histogram(encoded))


def op11_byte_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = filter_audit.document_facts(_table(spark, sf_dir, "documents"))
    counts = filter_audit.failure_counts(facts, _table(spark, sf_dir, "labels"), filter_audit.contract_filters())
    return filter_audit.every_order(*counts)


OP11_SQL = """
WITH d AS (
  SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS t,
    list_filter(string_split_regex(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT d.part, COALESCE(l.good, false) AS good, COALESCE(l.toxic, false) AS toxic,
    (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN COALESCE(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), min(d.doc_id) OVER (PARTITION BY t) IS NOT NULL) THEN 16 ELSE 0 END) AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, s AS step, bits[s] AS own, COALESCE(list_sum(bits[:s - 1]), 0) AS before FROM orders, range(1, 6) r(s)
), g AS (
  SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL
), r AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
    CAST(sum(CASE WHEN fails & (own | before) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN fails & own <> 0 AND fails & before <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN fails = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN fails & own <> 0 AND fails & before = 0 AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN fails & own <> 0 AND fails & before = 0 AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM g, (SELECT filter_order, step, own, CAST(before AS INTEGER) AS before FROM steps) s GROUP BY ALL
)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""


def op12_path_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(_table(spark, sf_dir, "conversations"))
    return conversation_repair.reports(conversation_repair.repair(damaged, texts=False))


def op13_fast_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fast_sketch.near_duplicates(_table(spark, sf_dir, "documents"))


REGISTERED = {
    f.__name__: f
    for f in (
        op1_token_files, op2_output_codes, op3_top_k, op4_site_bayes, op5_prefix_forest, op6_count_min, op7_chosen_path, op8_curve_packing,
        op9_piece_bpe, op10_length_histogram, op11_byte_transducer, op12_path_ranking, op13_fast_sketch,
    )
}
SQL = {"op3_top_k": OP3_SQL, "op11_byte_transducer": OP11_SQL}
