"""Exact duplicates by progressive refinement: rows are grouped by the length of their normalised text, then by a hash
of its beginning, then by a hash of the whole; whole texts are read for rows only that still share a group.

The normalised text, its length and the hash of its beginning are written once, as columns of one table: the first two
steps read the narrow columns alone. Only DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

#: Code points of the normalised text that the second step hashes.
HEAD = 64
#: Texts of so many bytes and more share one class in the first step, so its table has a row per smaller length at most.
LONG = 1 << 16
BLANK = "[ \\t-\\r]"


def normalised(text: str | Column) -> Column:
    """The text without any character of `[\\x20\\x09-\\x0D]`; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANK, "")


def sharing(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The values of ``keys`` that two rows or more have."""
    return rows.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")


def exact_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text",
                     keep: Sequence[str | Column] | None = None) -> DataFrame:
    """Every row of ``docs`` (the ``keep`` columns, default all) with ``keep_id``, ``group_size`` and ``kept``.

    Rows form a group when their :func:`normalised` texts are identical. Of a group the row with the most code points in
    its text as given stays, then the one with the smallest id (a null id comes after all others), then the first read:
    exactly one row of each group is ``kept``, also where ids repeat, and ``keep_id`` is its id (null where all the
    group's ids are null). Null texts count as empty; empty texts and those of white space alone are equal. A text is
    hashed whole, however long. An empty table gives no rows. Input columns named like the result's are left out;
    ``keep`` may hold expressions over ``docs``. Groups are equal lengths and SHA-256.
    """
    added = ["keep_id", "group_size", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if isinstance(c, Column) or c not in added]
    named = [F.col(f"`{c}`") if isinstance(c, str) else c for c in keep]
    plain = docs.select(F.struct(*named, F.lit(None).cast("int").alias("__")).alias("own"), F.col(f"`{id}`").alias("id"),
                        F.length(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("chars"),
                        normalised(F.col(f"`{text}`")).alias("normal"))
    table = staged(plain.select("*", F.octet_length("normal").alias("length"), F.xxhash64(F.left("normal", F.lit(HEAD))).alias("head"),
                                F.monotonically_increasing_id().alias("row")), "texts")
    sized = table.withColumn("class", F.least("length", F.lit(LONG)))
    lengths = F.broadcast(sharing(sized, ["class"]))  # LONG + 1 numbers at most
    by_length = sized.join(lengths, "class", "left_semi")
    heads = sharing(by_length, ["length", "head"])
    by_head = staged(by_length.select("row", "length", "head").join(heads, ["length", "head"], "left_semi").select("row"), "shared")
    whole = staged(by_length.select("row", "id", "chars", "length", "normal").join(by_head, "row", "left_semi")
                   .select("row", "id", "chars", "length", F.sha2(F.col("normal").cast("binary"), 256).alias("hash")), "hashed")
    first = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("unnamed"), "id", "row"))
    groups = whole.groupBy("length", "hash").agg(F.count("*").alias("n"), first.alias("first")).where("n > 1")
    verdicts = whole.join(groups, ["length", "hash"]).select("row", "n", F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row"))
    judged = table.select("own", "id", "row").join(verdicts, "row", "left")
    alone = F.col("n").isNull()
    return judged.select("own.*", F.when(alone, F.col("id")).otherwise(F.col("first_id")).alias("keep_id"),
                         F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                         (alone | (F.col("row") == F.col("first_row"))).alias("kept")).drop("__")
