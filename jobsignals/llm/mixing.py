"""Temperature mixing of sources. DataFrame functions only.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources
alike) and 1 (as they come), normalised. The exponent is bisected, five halvings a job, until the
weights have a target entropy, or until no source is repeated more often than a limit. Weights
times the token budget are then realised by source as blocks: whole permutations of its documents,
and a last one cut where the budget is used up. Without a budget it is the least under which every
source has at least one whole block, so that no document is left out.

A permutation is the order of md5(seed:block:doc_id). Its running token count is taken in buckets
of neighbouring hashes, then over the buckets, so the documents of a source that holds a third of
all never gather in one task.

Tokens are words. Defined cases: a null text has none; a null source is the source ''. A source
without tokens has weight 0 and one block. Rows given twice are mixed each. An empty table gives
no rows. Extra columns are carried through `mixed` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignals.llm.common import WORD, save, whole_text

#: No source is repeated more often than this, against one pass over the largest.
MAX_REPEATS = 2.0
SEED = 17
#: Each job looks at the inner ends of so many sections; so many jobs settle 40 bits.
SECTIONS, JOBS = 32, 8
BUCKET_DOCS = 200


def token_rows(docs: DataFrame) -> DataFrame:
    """no_id, id, th, copy, doc_id, source, n_tokens: the documents without their texts."""
    rows = docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(whole_text()).alias("th"), F.col("doc_id").cast("long").alias("doc_id"),
        whole_text("source").alias("source"),
        F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("n_tokens"))
    again = Window.partitionBy("no_id", "id", "th").orderBy("source")
    return rows.withColumn("copy", F.row_number().over(again))


def source_tokens(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"),
                                      F.count("*").alias("n_docs"))


def bisect_exponent(sources: DataFrame, target_entropy: float | None,
                    max_repeats: float | None, budget: int | None) -> float:
    """The least exponent that keeps to max_repeats, or the one with the entropy (in bits)."""
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give target_entropy or max_repeats")
    most = sources.agg(F.max("tokens").alias("most")).first().most
    if not most:
        return 1.0
    ratio = sources.where("tokens > 0").select((F.col("tokens") / F.lit(most)).alias("r"))
    low, high = 0.0, 1.0
    for _ in range(JOBS):
        width = (high - low) / SECTIONS
        ends = [low + width * k for k in range(1, SECTIONS)]
        power = F.pow("r", F.col("exponent"))
        found = (ratio.withColumn("exponent", F.explode(F.array(*map(F.lit, ends))))
                 .groupBy("exponent").agg(
                     F.sum(power).alias("z"), F.sum(power * F.log2("r")).alias("m"),
                     F.max(F.pow("r", F.col("exponent") - 1)).alias("repeats")).collect())
        for r in sorted(found, key=lambda r: r.exponent):
            if target_entropy is not None:
                enough = entropy(r.exponent, r.z, r.m) <= target_entropy
            else:
                scale = 1.0 if budget is None else budget / (r.z * most)
                enough = r.repeats * scale <= max_repeats
            if enough:
                high = r.exponent
                break
            low = r.exponent
    return high


def entropy(exponent: float, z: float, m: float) -> float:
    """Bits of the weights r^a / z, with m the sum of r^a log2 r."""
    return math.log2(z) - exponent * m / z


def source_budgets(sources: DataFrame, exponent: float, budget: int | None) -> DataFrame:
    """source, weight, n_docs, whole blocks, tokens of the cut block."""
    top = sources.agg(F.max("tokens").alias("most")).first().most or 1
    r = F.col("tokens") / F.lit(top)
    z = sources.agg(F.sum(F.when(F.col("tokens") > 0, F.pow(r, F.lit(exponent)))).alias("z")
                    ).first().z or 1.0
    share = F.pow(r, F.lit(exponent)) / F.lit(z)
    tokens = (F.pow(r, F.lit(exponent - 1)) * F.col("tokens") if budget is None
              else share * F.lit(budget))
    rows = sources.withColumn("weight", F.when(F.col("tokens") > 0, share).otherwise(0.0))
    rows = rows.withColumn("budget", F.when(F.col("tokens") > 0, F.round(tokens)).otherwise(0)
                           .cast("long"))
    return rows.select(
        "source", "weight", "n_docs",
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(1).alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest"))


def permutations(rows: DataFrame, budgets: DataFrame, seed: int) -> DataFrame:
    """Every document of every block, with the tokens that come before it in the block."""
    # Which of two rows given twice comes first does not matter; their order is still total.
    order: list[Column | str] = ["order", "doc_id", "th", "copy"]
    spread = (rows.join(budgets, "source")
              .withColumn("block", F.explode(F.sequence(
                  F.lit(0).cast("long"), "whole")))
              .where("block < whole OR rest > 0")
              .withColumn("order", F.md5(F.concat_ws(
                  ":", F.lit(seed), "block", F.coalesce(F.col("doc_id").cast("string"),
                                                        F.lit("")))))
              .withColumn("bucket", F.floor(
                  F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
                  * F.ceil(F.col("n_docs") / BUCKET_DOCS))))
    sizes = spread.groupBy("source", "block", "bucket").agg(F.sum("n_tokens").alias("size"))
    before = Window.partitionBy("source", "block").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = sizes.select("source", "block", "bucket",
                         F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "block", "bucket").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    placed = (spread.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
              .join(bases, ["source", "block", "bucket"])
              .withColumn("start", F.col("base") + F.col("inner")))
    return placed.where("block < whole OR start < rest")


def blocks_of(docs: DataFrame, target_entropy: float | None = None,
              max_repeats: float | None = MAX_REPEATS, budget: int | None = None,
              seed: int = SEED) -> DataFrame:
    if target_entropy is not None:
        max_repeats = None
    rows = save(token_rows(docs), "tokens")
    sources = save(source_tokens(rows), "sources")
    exponent = bisect_exponent(sources, target_entropy, max_repeats, budget)
    return permutations(rows, source_budgets(sources, exponent, budget), seed)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document and block: doc_id, source, block, start, n_tokens, weight."""
    return blocks_of(docs, **options).select(
        "doc_id", "source", "block", "start", "n_tokens", F.round("weight", 6).alias("weight"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as the blocks hold it, all columns."""
    times = (blocks_of(docs, **options).groupBy("no_id", "id", "th", "copy")
             .agg(F.count("*").alias("times"))
             .groupBy("no_id", "id", "th")
             .agg(F.map_from_entries(F.collect_list(F.struct("copy", "times"))).alias("times")))
    keyed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(whole_text()).alias("th"), whole_text("source").alias("of_source"))
    again = Window.partitionBy("no_id", "id", "th").orderBy("of_source")
    return (keyed.join(times, ["no_id", "id", "th"])
            .withColumn("times", F.try_element_at("times", F.row_number().over(again)))
            .where("times > 0")
            .withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
            .select("row.*"))
