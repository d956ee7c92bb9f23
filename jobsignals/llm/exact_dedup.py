"""Exact duplicates by content-defined chunk recipes. DataFrame functions only.

Every normalised text is cut where its content says so. Chunks are brought together once, each
distinct chunk once per task, to make sure that a 64-bit chunk hash names one chunk text; where it
does not, the chunks concerned are named by SHA-256 instead. From then on a document is its ordered
list of identifiers, some bytes per kilobyte of text, and only these lists are grouped and joined.

Defined cases: a null text is the empty text, whose recipe is the empty list. Rows are counted as
given, repeated ones included. A null doc_id is smaller than any number: it is keep_id only where
every row of the group lacks one. Extra columns are carried through `deduplicate` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import ascii_lower, save, whole_text

#: A chunk ends at the first sentence or line end after the least length, else at the most.
LEAST, MOST = 512, 8192


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """Consecutive pieces that together are the text."""
    rule = rf"(?s).{{{least},{most - 1}}}?[\n.!?]|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(rule), F.lit(0))


def clashing_hashes(parts: DataFrame) -> list[int]:
    """Hashes that more than one distinct chunk text has (n²/2^65 are expected, so none)."""
    distinct = (parts.select(F.explode("parts").alias("part"))
                .groupBy(F.xxhash64("part").alias("hash"), "part").agg(F.lit(1).alias("one")))
    rows = distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    return [r.hash for r in rows.collect()]


def identifier(part: Column, clashing: list[int]) -> Column:
    plain = F.xxhash64(part).cast("string")
    if not clashing:
        return plain
    return F.when(F.xxhash64(part).isin(clashing), F.sha2(part, 256)).otherwise(plain)


def recipes(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """doc_id, text_sha256 and recipe of every row, saved."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       ascii_lower(whole_text()).alias("text"))
    clashing = clashing_hashes(text.select(chunks(F.col("text"), least, most).alias("parts")))
    parts = chunks(F.col("text"), least, most)
    recipe = (F.transform(parts, lambda p: F.xxhash64(p)) if not clashing
              else F.transform(parts, lambda p: identifier(p, clashing)))
    return save(text.select("doc_id", F.sha2("text", 256).alias("text_sha256"),
                            recipe.alias("recipe")), "recipes")


def exact_groups(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chunks."""
    rows = recipes(docs, least, most)
    # Saved, so that the join below has plain shuffles and a hot recipe can be split.
    groups = save(rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"),
                                             F.count("*").alias("group_size")), "groups")
    return rows.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        F.size("recipe").cast("long").alias("n_chunks"))


def deduplicate(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """The rows of docs that stay, all columns; of repeated rows of a kept id, one."""
    rows = recipes(docs, least, most)
    stay = rows.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "text_sha256")).alias("row")).select(
        F.col("row.doc_id").alias("keep_id"), F.col("row.text_sha256").alias("keep_sha"))
    keyed = docs.select(F.struct("*").alias("row"),
                        F.col("doc_id").cast("long").alias("keep_id"),
                        F.sha2(ascii_lower(whole_text()), 256).alias("keep_sha"))
    same = keyed["keep_id"].eqNullSafe(stay["keep_id"]) & (keyed["keep_sha"] == stay["keep_sha"])
    return (keyed.join(stay, same, "left_semi")
            .dropDuplicates(["keep_id", "keep_sha"]).select("row.*"))
