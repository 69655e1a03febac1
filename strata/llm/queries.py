"""The contract's queries over the training-data operators: thin digests of what the operators return."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import langid
from strata.llm.alignment import align
from strata.llm.decontaminate import decontaminate, items_digest
from strata.llm.exact_dedup import exact_duplicates, normalised
from strata.llm.line_dedup import deduplicate_lines
from strata.llm.packing import pack
from strata.llm.pii import counted, find_pii, listed
from strata.llm.prefix_trie import conversation_trie
from strata.llm.quality_classifier import score_quality
from strata.llm.quality_rules import judge, trusted_ids
from strata.llm.sharding import shard_documents
from strata.llm.simhash import near_duplicates
from strata.llm.url_filter import judge_urls
from strata.sources.tables import read_table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, trusted_ids(read_table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), id="doc_id")
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), keep=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *(counted(F.col("base_spans"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")),
                        F.sha2(listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(langid.fold(F.col("doc_id")) == langid.HELD_OUT, F.lit(False))
    named = langid.identify(docs, langid.fit_centroids(docs.where(~held_out)), keep=["doc_id"])
    return named.select("doc_id", held_out.alias("held_out"), F.col("nearest").alias("lang_pred"), "score", "rejected")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate_lines(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    kept = F.coalesce("kept_text", F.lit(""))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        items_digest(F.col("items")).alias("items_sha256"), "contaminated")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(normalised("text").cast("binary"), 256).alias("text_sha256")
    return exact_duplicates(read_table(spark, sf_dir, "documents"), keep=["doc_id", digest]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(read_table(spark, sf_dir, "documents"), a, b, keep=["doc_id"])[0]


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_packing, op3_simhash_near_dedup, op4_url_filters, op5_pii,
                                 op6_quality_classifier, op7_language_id, op8_line_dedup, op9_benchmark_decontamination,
                                 op10_sharding, op11_conversation_prefix_trie, op12_exact_dedup,
                                 op13_tokenizer_alignment, pipeline)}
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: CRC-32 of an ASCII string, bit by bit.
CRC32 = ("xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({}, ''), lambda c: ascii(c)::BIGINT)), "
         "lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))")

ORACLE = {
    "op8_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
        keyed AS (SELECT *, trim({LOWERED.format('line')}, {BLANKS}) AS key FROM lines),
        repeated AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
                     GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        marked AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.last AS dropped FROM keyed k LEFT JOIN repeated r USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op11_conversation_prefix_trie": f"""
        WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
                     FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {CRC32.format("conv_id::VARCHAR")} % 6 AS h, max(p) AS n
                  FROM own GROUP BY conv_id),
        rebuilt AS (
            SELECT c.conv_id, o.p AS d, role, text FROM convs c JOIN own o ON o.conv_id = c.base AND o.p <= c.h
            UNION ALL
            SELECT c.conv_id, o.p - c.h + least(c.h, coalesce(b.n, 0)), role, text
            FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.p > c.h LEFT JOIN convs b ON b.conv_id = c.base),
        parts AS (
            SELECT conv_id, d, list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d) AS seq,
                   length(text) AS chars FROM rebuilt
            UNION ALL SELECT conv_id, 0, []::VARCHAR[], 0 FROM convs),
        nodes AS (SELECT seq, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars
                  FROM parts GROUP BY seq),
        children AS (SELECT seq[1:depth - 1] AS seq, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (seq)),
        sums AS (SELECT seq[1:up] AS seq, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
                 FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted) GROUP BY 1),
        ends AS (SELECT seq, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
                 FROM (SELECT conv_id, max_by(seq, d) AS seq FROM parts GROUP BY conv_id) GROUP BY seq)
        SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves::BIGINT AS n_leaves,
               saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM counted c JOIN sums USING (seq) LEFT JOIN ends USING (seq)
             LEFT JOIN nodes p ON c.depth > 0 AND p.seq = c.seq[1:c.depth - 1]""",
    "op12_exact_dedup": f"""
        WITH hashed AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                               sha256(translate(coalesce(text, ''), {BLANKS}, '')) AS hash FROM documents),
        first AS (SELECT *, first_value(doc_id) OVER (PARTITION BY hash ORDER BY chars DESC, doc_id) AS keep_id FROM hashed)
        SELECT doc_id, keep_id, count(*) OVER (PARTITION BY hash) AS group_size, doc_id = keep_id AS kept, hash AS text_sha256
        FROM first""",
}
