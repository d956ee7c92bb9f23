"""Best-fit packing with patterns of lengths fitted by non-negative least squares.

Documents are tokenised where they lie; only lengths are gathered, as a histogram of at most
`max_tokens` counts. On it the driver plans: length classes, patterns of two or three classes that
fill a sequence, repeat counts fitted to the class histogram by non-negative least squares and
rounded down, then the documents left over by best fit, longest first, also into the gaps the
patterns leave. The plan says how many documents of a length go where; its size depends on
`max_tokens` alone. Documents are ranked within their length, in buckets so that a frequent length
does not gather in one task, and take the place of their rank.

Defined cases: a null text is empty: one sequence id 1. Repeated rows are packed each. Only
documents longer than `max_tokens` are cut. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsignals.llm.common import doc_rows, save
from jobsignals.llm.tokens import default_tokenizer, token_batches, word_tokens

MAX_TOKENS = 4096
CLASSES = 64
#: Largest patterns tried; the plan with the fewest sequences is taken.
PATTERN_DOCS = (3, 2)
#: Documents of one length ranked together.
BUCKET_ROWS = 100


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str | None = None) -> DataFrame:
    """doc_id, th, piece, start, length, ids_crc32 of every piece of every document."""
    path = tokenizer or default_tokenizer()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_tokens(path)
        for b in parts:
            rows, out = [], []
            for row, ids in token_batches(b.column("text"), coder):
                for piece, start in enumerate(range(0, len(ids), max_tokens)):
                    cut = ids[start:start + max_tokens]
                    rows.append(row)
                    out.append((piece, start, len(cut), zlib.crc32(cut.astype("<u4").tobytes())))
            at = pa.array(rows, pa.int64())
            values = [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)]
            values[0] = values[0].cast(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at), b.column("th").take(at), *values],
                ["doc_id", "th", "piece", "start", "length", "ids_crc32"])

    return doc_rows(docs).mapInArrow(
        run, "doc_id long, th long, piece int, start long, length long, ids_crc32 long")


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active set method of Lawson and Hanson."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * a.shape[0]):
        gain = np.where(free, -np.inf, a.T @ (b - a @ x))
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[at] = s
                break
            low = s <= 0
            step = np.min(x[at][low] / (x[at][low] - s[low]))
            x[at] += step * (s - x[at])
            free[at[x[at] <= 1e-12]] = False
            x[~free] = 0
    return x


def full_patterns(classes: int, most: int) -> list[tuple[int, ...]]:
    """Descending lists of up to `most` classes that add up to `classes`."""
    def grow(left: int, top: int, room: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif room:
            for c in range(min(left, top), (left - 1) // room, -1):
                for rest in grow(left - c, c, room - 1):
                    yield (c, *rest)
    return list(grow(classes, classes, most))


@dataclass
class Plan:
    """Kinds of sequences: the lengths in it and how many there are of it."""

    max_tokens: int
    kinds: list[tuple[list[int], int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.kinds)

    def places(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length: rank at which a run of places begins, its first sequence, its offset."""
        runs: dict[int, list[tuple[int, int, int]]] = {}
        base = 0
        for lengths, n in self.kinds:
            offset = 0
            for length in lengths:
                runs.setdefault(length, []).append((n, base, offset))
                offset += length
            base += n
        out = {}
        for length, found in runs.items():
            n, first, offset = np.array(found, np.int64).T
            out[length] = (np.cumsum(n) - n, first, offset)
        return out


def plan_patterns(histogram: dict[int, int], max_tokens: int = MAX_TOKENS,
                  classes: int = CLASSES, most: int = PATTERN_DOCS[0]) -> Plan:
    """Patterns by least squares, then the rest by best fit, longest first."""
    classes = min(classes, max_tokens)
    left = np.zeros(max_tokens + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    # Upper ends of the classes; a pattern of classes always fits.
    width = max_tokens // classes
    kind = np.minimum(-(-np.arange(max_tokens + 1) // width), classes)
    patterns = full_patterns(classes, most)
    matrix = np.zeros((classes, len(patterns)))
    for j, pattern in enumerate(patterns):
        for c in pattern:
            matrix[c - 1, j] += 1
    counts = np.bincount(kind, weights=left, minlength=classes + 1)[1:]
    weight = np.sqrt(np.arange(1, classes + 1))  # a missed long document costs more room
    repeats = np.floor(nnls(matrix * weight[:, None], counts * weight) + 1e-6).astype(np.int64)

    bins: list[tuple[list[int], int, int]] = []  # lengths, free, how many

    def largest(low: int, high: int) -> int:
        found = np.flatnonzero(left[low:high + 1])
        return low + int(found[-1]) if len(found) else 0

    order = sorted(np.flatnonzero(repeats), key=lambda j: patterns[j], reverse=True)
    for j in order:
        need = int(repeats[j])
        while need:
            room, chosen = max_tokens, []
            for i, c in enumerate(patterns[j]):
                last = i == len(patterns[j]) - 1
                spare = left.copy() if chosen else left
                for length in chosen:
                    spare[length] -= 1
                low, high = (c - 1) * width + 1, room if last else min(room, c * width)
                found = np.flatnonzero(spare[low:high + 1] > 0)
                if not len(found):
                    chosen = []
                    break
                chosen.append(low + int(found[-1]))
                room -= chosen[-1]
            if not chosen:
                break
            times = min([need, *(int(left[x]) // chosen.count(x) for x in set(chosen))])
            for x in chosen:
                left[x] -= times
            bins.append((chosen, room, times))
            need -= times

    plan = Plan(max_tokens)
    open_bins: dict[int, list[tuple[tuple, int]]] = {}
    for chosen, room, times in bins:
        open_bins.setdefault(room, []).append((tuple(chosen), times))
    frees = np.zeros(max_tokens + 1, bool)
    frees[list(open_bins)] = True
    for length in range(max_tokens, 0, -1):
        n = int(left[length])
        while n:
            found = np.flatnonzero(frees[length:])
            if not len(found):
                each = max_tokens // length
                for per, times in ((each, n // each), (n % each, 1)):
                    if per and times:
                        free = max_tokens - per * length
                        open_bins.setdefault(free, []).append(((length,) * per, times))
                        frees[free] = True
                n = 0
                break
            free = length + int(found[0])
            content, times = open_bins[free].pop()
            used = min(times, n)
            if used < times:
                open_bins[free].append((content, times - used))
            frees[free] = bool(open_bins[free])
            open_bins.setdefault(free - length, []).append(((*content, length), used))
            frees[free - length] = True
            n -= used
    for free in sorted(open_bins):
        plan.kinds += [(list(content), times) for content, times in open_bins[free]]
    return plan


def best_plan(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> Plan:
    return min((plan_patterns(histogram, max_tokens, most=k) for k in PATTERN_DOCS),
               key=lambda plan: plan.sequences)


def ranked(parts: DataFrame, histogram: DataFrame) -> DataFrame:
    """Pieces with their rank (from 0) among those of the same length."""
    buckets = histogram.select(
        F.col("length").alias("of_length"),
        F.ceil(F.col("n") / BUCKET_ROWS).cast("long").alias("n_buckets"))
    # At most max_tokens rows, one for each length.
    rows = (parts.join(F.broadcast(buckets), F.col("length") == F.col("of_length"))
            .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "th", "piece"), "n_buckets")))
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("size"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("length").alias("of_length"), F.col("bucket").alias("of_bucket"),
                         F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "th", "piece")
    return (rows.drop("of_length").withColumn("row", F.row_number().over(within) - 1)
            .join(bases, (F.col("length") == F.col("of_length"))
                  & (F.col("bucket") == F.col("of_bucket")))
            .withColumn("rank", F.col("base") + F.col("row")))


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    parts = save(pieces(docs, max_tokens, tokenizer), "pieces")
    histogram = parts.groupBy("length").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in histogram.collect()}  # at most max_tokens rows
    places = best_plan(counts, max_tokens).places() if counts else {}
    spark = docs.sparkSession
    small = spark.createDataFrame([(k, v) for k, v in counts.items()], "length long, n long")
    shared = spark.sparkContext.broadcast(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                begin, first, place = shared.value[int(x)]
                k = np.searchsorted(begin, rank[at], "right") - 1
                sequence[at], offset[at] = first[k] + rank[at] - begin[k], place[k]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    rows = ranked(parts, small).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, "
                                "ids_crc32 long, sequence_id long, offset long")
