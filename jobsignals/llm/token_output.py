"""Packed token ids as tables of binary matrices: ids, segment lengths, position resets.

Every task tokenises its rows and packs them block by block: a block is closed when it holds about
`BLOCK_TOKENS` ids, so memory is bounded and nothing is shuffled. Within a block, documents go
longest first into the open sequence with the least room that still holds them; the room is found
in a segment tree over capacities. Documents longer than a sequence are cut into whole sequences
and a rest, losing nothing. A written row is one sequence: its ids (little-endian, two bytes where
the vocabulary allows), cumulative segment lengths (from 0, int32), positions (restarting at 0
with each segment, int32) and the document, piece and start of every segment.

Defined cases: a null text is empty: one segment with only the end id. Repeated rows are written
each. An empty table writes no rows. Sequences are padded by the reader, not in the file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from jobsignals.llm.common import doc_rows
from jobsignals.llm.tokens import default_tokenizer, token_batches, word_tokens
from jobsignals.session import until_exit

MAX_TOKENS = 4096
BLOCK_TOKENS = 2 << 20
#: Sequences of a task are numbered from here on.
TASK_SEQUENCES = 1 << 36

SCHEMA = ("sequence_id long, n_tokens int, ids binary, cu_seqlens binary, positions binary, "
          "doc_id array<long>, piece array<int>, start array<long>")


class Capacities:
    """A segment tree over capacities 0 to `most`: finds the least one in use that is enough."""

    def __init__(self, most: int):
        self.size = 1
        while self.size <= most:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, bin_: int) -> None:
        self.bins[capacity].append(bin_)
        k = capacity + self.size
        while k:
            self.count[k] += 1
            k //= 2

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, bin) with the least capacity of at least `least`, removed; None if none."""
        k = least + self.size
        if not self.count[k]:
            # Up to the first right neighbour in use, then down its left side.
            while k > 1 and (k % 2 or not self.count[k + 1]):
                k //= 2
            if k <= 1:
                return None
            k += 1
            while k < self.size:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        capacity = k - self.size
        while k:
            self.count[k] -= 1
            k //= 2
        return capacity, self.bins[capacity].pop()


def best_fit_decreasing(lengths: list[int], most: int) -> list[list[int]]:
    """Places of the lengths by sequence, in order of placement."""
    tree, out = Capacities(most), []
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = tree.take(lengths[i])
        if found is None:
            found = most, len(out)
            out.append([])
        room, bin_ = found
        out[bin_].append(i)
        tree.add(room - lengths[i], bin_)
    return out


def id_bytes(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def packed(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str | None = None
           ) -> DataFrame:
    """One row per packed sequence, as SCHEMA says."""
    path = tokenizer or default_tokenizer()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = word_tokens(path)
        kind = id_bytes(coder.whole.get_vocab_size())
        number = TaskContext.get().partitionId() * TASK_SEQUENCES
        names = [c.split()[0] for c in SCHEMA.split(", ")]

        def close(found: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            plan = best_fit_decreasing([len(x[3]) for x in found], max_tokens)
            for k in range(0, len(plan), 64):
                rows = []
                for places in plan[k:k + 64]:
                    size = [len(found[i][3]) for i in places]
                    rows.append((
                        number, sum(size),
                        np.concatenate([found[i][3] for i in places]).astype(kind).tobytes(),
                        np.cumsum([0, *size]).astype("<i4").tobytes(),
                        np.concatenate([np.arange(n) for n in size]).astype("<i4").tobytes(),
                        *([found[i][j] for i in places] for j in range(3))))
                    number += 1
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(),
                         pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        found, n = [], 0
        for b in parts:
            doc = b.column("doc_id").to_pylist()
            for row, ids in token_batches(b.column("text"), coder):
                for piece, start in enumerate(range(0, len(ids), max_tokens)):
                    found.append((doc[row], piece, start, ids[start:start + max_tokens]))
                n += len(ids)
                if n >= BLOCK_TOKENS:
                    yield from close(found)
                    found, n = [], 0
        if found:
            yield from close(found)

    return doc_rows(docs).select("doc_id", "text").mapInArrow(run, SCHEMA)


def write_packed(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS,
                 tokenizer: str | None = None) -> None:
    """Write the packed sequences as Parquet; zstd finds the repeated positions."""
    (packed(docs, max_tokens, tokenizer).write.option("compression", "zstd")
     .option("parquet.block.size", 16 << 20).parquet(path))


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def matrix(rows: list, max_tokens: int = MAX_TOKENS, pad: int = 0, kind: str = "<u2"
           ) -> np.ndarray:
    """Some read rows as one matrix of ids."""
    out = np.full((len(rows), max_tokens), pad, np.int64)
    for i, r in enumerate(rows):
        out[i, :r.n_tokens] = np.frombuffer(r.ids, kind)
    return out


def segments(sequences: DataFrame) -> DataFrame:
    """One row per segment of read sequences, decoded: what was written, document by document."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                 "resets"]
        for b in parts:
            out = []
            for seq, n, raw, cu, position, *whose in zip(*(c.to_pylist() for c in b.columns)):
                ids = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
                cu, position = np.frombuffer(cu, "<i4"), np.frombuffer(position, "<i4")
                for i, (doc, piece, start) in enumerate(zip(*whose)):
                    a, z = int(cu[i]), int(cu[i + 1])
                    out.append((doc, piece, start, z - a, zlib.crc32(ids[a:z].tobytes()), seq, a,
                                bool((position[a:z] == np.arange(z - a)).all())))
            columns = list(zip(*out)) if out else [[]] * len(names)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return sequences.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 "
                                     "long, sequence_id long, offset long, resets boolean")


def packed_report(docs: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The packed sequences written and read back, one row per segment."""
    spark = docs.sparkSession
    path = until_exit(spark, "packed")
    write_packed(docs, path, max_tokens)
    return segments(read_packed(spark, path))
