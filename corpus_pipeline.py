"""A corpus through five of the training-data operators, each stage written as Parquet and read by the next.

Stages (each takes (spark, docs, sf_dir); all but the last return the columns of documents):

1. quality rules: documents that the base rules or the n-gram ratio reject go;
2. line dedup: repeated lines go from the texts, ``n_chars`` follows the new text;
3. SimHash near-dedup: of each group the document with the smallest id stays (of equal ids, one text);
4. benchmark decontamination: contaminated documents go;
5. packing: the documents' pieces, as ``op2_packing`` returns them.

Defined results: null texts count as empty, so the base rules reject them in stage 1. Stage 2 keeps a null text null.
Rows with a null id are judged like others and stay in stage 3, which can't name a smallest id for them. Rows that repeat
an id are judged each by its own text: stage 3 keeps one row of each group of linked fingerprints, so different texts
under one id stay. Extra columns pass through all stages but the last. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.llm.decontaminate import decontaminate
from strata.llm.line_dedup import deduplicate_lines
from strata.llm.packing import pack
from strata.llm.quality_rules import judge, trusted_ids
from strata.llm.simhash import near_duplicates
from strata.sources.tables import read_table

#: Holds a document's columns but the text where an operator adds columns of its own.
ROW = "__document"


def _parted(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias(ROW))


def _whole(docs: DataFrame, parted: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` again, with some new values."""
    own = {c: new.get(c, F.col("text") if c == "text" else F.col(f"{ROW}.`{c}`")) for c in docs.columns}
    return parted.select(*(value.cast(docs.schema[c].dataType).alias(c) for c, value in own.items()))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _whole(docs, judge(_parted(docs), trusted_ids(read_table(spark, sf_dir, "labels"))).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = deduplicate_lines(_parted(docs), keep=[ROW])
    length = F.when(F.col("n_dropped") > 0, F.length("kept_text")).otherwise(F.col(f"{ROW}.n_chars"))
    return _whole(docs, found, text=F.col("kept_text"), n_chars=length)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    alike = F.xxhash64("text").alias("alike")  # rows of one id with equal texts
    found = near_duplicates(docs, keep=[alike]).where("doc_id IS NOT NULL")
    first = found.groupBy("group").agg(F.min(F.struct("doc_id", "alike")).alias("first")).select(
        F.col("first.doc_id").alias("__first"), F.col("first.alike").alias("__alike"))
    kept = docs.withColumn("__text", F.xxhash64("text")).join(first, (F.col("doc_id") == F.col("__first")) & (F.col("__text") == F.col("__alike")), "left_semi")
    nth = F.row_number().over(Window.partitionBy("doc_id", "__text").orderBy("text"))
    one = kept.withColumn("__nth", nth).where("__nth = 1").drop("__nth", "__text")
    return one.unionByName(docs.where("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate(_parted(docs), read_table(spark, sf_dir, "benchmark"), keep=["text", ROW])
    return _whole(docs, found.where("NOT contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("packing", packing)]

#: The n-gram ratio, the fingerprints and the tokenizer have no SQL: the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
