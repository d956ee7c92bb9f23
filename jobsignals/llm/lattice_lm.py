"""Language-model scores: the probability of a text over all its subword segmentations.

A text is its words and one end. A word's probability sums over every way to spell it with pieces
of an existing vocabulary (log-space forward recursion), so a text's is the product over its
words and the end. Piece weights start from the vocabulary's ranking and are fitted to the
training documents' word counts by two rounds of expectation-maximisation, add-0.1 smoothed.

All this runs on distinct words, counted where they lie and combined by word. Documents are then
scored in one pass: words above a count are looked up in a shared table of at most `SHARED_WORDS`
rows, the rarer ones are joined by word and summed by document.

Defined cases: a null text is empty: its only token is the end. A null doc_id counts as the text
'' (held out). Repeated rows are scored each. Without training documents all counts are 0 and
pieces keep the weights they start with. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import batches, doc_rows, save, strings, word_lists
from jobsignals.llm.lattice import Lattice, Pieces, by_length, default_vocabulary

ADD = 0.1
ROUNDS = 2
#: Rows of the table that every worker holds, and the longest word in it.
SHARED_WORDS, SHARED_BYTES = 200_000, 64
FOLDS = 10
LN10 = math.log(10)


@cache
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def with_fold(docs: DataFrame) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS
    return doc_rows(docs).withColumn("held_out", fold == 0)


def word_counts(rows: DataFrame) -> DataFrame:
    """word and its count c in the training documents, for every word of any document."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            train = ~b.column("held_out").to_numpy(zero_copy_only=False)
            for start, stop in batches(b.column("text"), 24 << 20):
                coded, offsets = word_lists(pc.ascii_lower(b.column("text").slice(
                    start, stop - start)))
                weight = np.repeat(train[start:stop].astype(np.float64), np.diff(offsets))
                n = np.bincount(np.asarray(coded.indices), weight, minlength=len(coded.dictionary))
                for k in range(0, len(n), 50_000):
                    yield pa.RecordBatch.from_arrays(
                        [coded.dictionary.slice(k, 50_000).cast(pa.string()),
                         pa.array(n[k:k + 50_000].astype(np.int64))], ["word", "n"])

    return (rows.select("held_out", "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("c")))


def smoothed(counts: np.ndarray, ends: float, used: np.ndarray) -> tuple[np.ndarray, float]:
    """Natural log weights of the pieces and of the end."""
    total = counts.sum() + ends + ADD * (len(used) + 1)
    logs = np.full(len(counts), -np.inf)
    logs[used] = np.log((counts[used] + ADD) / total)
    return logs, math.log((ends + ADD) / total)


def fit_pieces(words: DataFrame, n_ends: int, path: str, rounds: int = ROUNDS
               ) -> tuple[np.ndarray, float]:
    """Weights after some rounds of expectation-maximisation over the training words."""
    pieces = pieces_of(path)
    scale = max(1, n_ends)
    logs, end = smoothed(pieces.start * scale / pieces.start.sum(), n_ends, pieces.used)
    spark = words.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(logs)

        def expect(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = pieces_of(path)
            out = np.zeros(known.size)
            for b in parts:
                c = b.column("c").to_numpy(zero_copy_only=False).astype(np.float64)
                for at, some in by_length(strings(b.column("word"))):
                    Lattice(known, some).expected(shared.value, c[at], out)
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], ["piece", "n"])

        found = (words.where("c > 0").mapInArrow(expect, "piece long, n double")
                 .groupBy("piece").agg(F.sum("n").alias("n")).collect())  # vocabulary at most
        counts = np.zeros(pieces.size)
        for r in found:
            counts[r.piece] = r.n
        logs, end = smoothed(counts, n_ends, pieces.used)
    return logs, end


def scored_words(words: DataFrame, logs: np.ndarray, path: str) -> DataFrame:
    """word, c and the log10 of the word's marginal probability."""
    shared = words.sparkSession.sparkContext.broadcast(logs)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces_of(path)
        for b in parts:
            score = np.zeros(len(b))
            for at, some in by_length(strings(b.column("word"))):
                score[at] = Lattice(known, some).forward(shared.value)[-1] / LN10
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), pa.array(score)],
                                             ["word", "c", "score"])

    return words.mapInArrow(run, "word string, c long, score double")


def frequent(words: DataFrame) -> DataFrame:
    """The words above a count, chosen so that they are SHARED_WORDS at most."""
    short = words.where(f"c > 0 AND octet_length(word) <= {SHARED_BYTES}")
    level = F.floor(F.log2("c")).cast("int")
    sizes = {r.level: r.n for r in short.groupBy(level.alias("level")).agg(
        F.count("*").alias("n")).collect()}  # 64 rows at most
    least, n = 64, 0
    while least > 0 and n + sizes.get(least - 1, 0) <= SHARED_WORDS:
        least -= 1
        n += sizes.get(least, 0)
    return short.where(F.col("c") >= 2 ** min(least, 62))


def score_texts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, counts, base_score and score."""
    path = vocabulary or default_vocabulary()
    rows = with_fold(docs)
    words = save(word_counts(rows), "words")
    n_train = rows.where("NOT held_out").count()
    sums = words.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    total = (sums.n or 0) + n_train
    distinct = sums.v + (n_train > 0)
    logs, end = fit_pieces(words, n_train, path)
    scored = save(scored_words(words, logs, path), "scored")
    scale = total + ADD * (distinct + 1)
    end_base = math.log10((n_train + ADD) / scale)
    common = frequent(scored).collect()
    table = pa.array([r.word for r in common], pa.large_string())
    c = np.array([r.c for r in common], np.float64)
    score = np.array([r.score for r in common], np.float64)
    shared = docs.sparkSession.sparkContext.broadcast((table, np.log10((c + ADD) / scale), score))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base_of, score_of = shared.value
        base_of, score_of = np.append(base_of, 0.0), np.append(score_of, 0.0)
        names = ["doc_id", "th", "held_out", "word", "n", "n_tokens", "n_known", "base", "score"]
        for b in parts:
            for start, stop in batches(b.column("text"), 24 << 20):
                coded, offsets = word_lists(pc.ascii_lower(b.column("text").slice(
                    start, stop - start)))
                place = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1)
                code = np.asarray(coded.indices).astype(np.int64)
                at = place.to_numpy(zero_copy_only=False)[code] if len(code) else code
                size = np.diff(offsets)
                row = np.repeat(np.arange(stop - start), size)
                sums = [np.bincount(row, w, minlength=stop - start)
                        for w in (base_of[at], score_of[at], (at >= 0).astype(np.float64))]
                head = b.slice(start, stop - start)
                empty = pa.nulls(stop - start, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [head.column("doc_id"), head.column("th"), head.column("held_out"), empty,
                     pa.array(np.ones(stop - start, np.int64)), pa.array(size + 1),
                     pa.array(sums[2].astype(np.int64) + (n_train > 0)),
                     pa.array(sums[0] + end_base), pa.array(sums[1] + end / LN10)], names)
                rare = at < 0
                pair, n = np.unique(row[rare] * max(1, len(coded.dictionary)) + code[rare],
                                    return_counts=True)
                for k in range(0, len(pair), 50_000):
                    some, m = pair[k:k + 50_000], n[k:k + 50_000]
                    where = pa.array(some // len(coded.dictionary))
                    zero = np.zeros(len(some), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [head.column("doc_id").take(where), head.column("th").take(where),
                         head.column("held_out").take(where),
                         coded.dictionary.take(pa.array(some % len(coded.dictionary))).cast(
                             pa.string()),
                         pa.array(m.astype(np.int64)), pa.array(zero), pa.array(zero),
                         pa.array(zero.astype(np.float64)), pa.array(zero.astype(np.float64))],
                        names)

    parts = save(rows.mapInArrow(
        run, "doc_id long, th long, held_out boolean, word string, n long, n_tokens long, "
             "n_known long, base double, score double"), "parts")
    whole = parts.where("word IS NULL").select(
        "doc_id", "th", "held_out", F.lit(1).cast("long").alias("copies"), "n_tokens", "n_known",
        "base", "score")
    of_word = scored.select("word", "c", F.col("score").alias("word_score"))
    rest = (parts.where("word IS NOT NULL").join(of_word, "word").select(
        "doc_id", "th", "held_out", F.lit(0).cast("long").alias("copies"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * F.log10((F.col("c") + ADD) / F.lit(scale))).alias("base"),
        (F.col("n") * F.col("word_score")).alias("score")))
    # Rows given twice fall together here and are told apart again by their number.
    m = F.col("copies")
    return (whole.union(rest).groupBy("doc_id", "th", "held_out").agg(
        *(F.sum(k).alias(k) for k in ("copies", "n_tokens", "n_known", "base", "score")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), m)))
        .select("doc_id", "held_out", (F.col("n_tokens") / m).cast("long").alias("n_tokens"),
                (F.col("n_known") / m).cast("long").alias("n_known"),
                F.lit(total).cast("long").alias("train_tokens"),
                (F.col("base") / m).alias("base_score"), (F.col("score") / m).alias("score")))
