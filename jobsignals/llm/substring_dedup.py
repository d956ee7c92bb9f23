"""Repeated passages: a count-min sketch rules windows out, the rest is grouped exactly.

A window is `width` consecutive words of one document. Its key in the sketch is its anchor: the
least hash among the 8-word runs inside it. Windows with equal words have equal anchors at
different places, so a window that occurs twice has an anchor counted twice, and neighbouring
windows mostly share one anchor, which makes the sketch about fourteen times smaller than one of
all windows. Sketches of partitions are kept sparse, merged block by block, and only overestimate.

Windows whose anchor is estimated as repeated are then counted exactly. Every task first combines
its own: per anchor the distinct window hashes, each once or more than once. So a passage that a
third of all documents share costs one row per task. Anchors and hashes found repeated go back to
the documents' runs of windows through a join that Spark can split, and to the documents by id.
Two windows count as equal if the 64-bit hashes of their anchors and of all their words agree.

Defined cases: a null text has no words. A row given twice repeats itself: both lose all words
covered. Rows with the same or no doc_id but different texts are told apart. Documents shorter
than a window are never changed. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import (
    U64, batches, doc_rows, mix, same_row, sliding, window_hashes, word_hashes,
)

WIDTH = 35
ANCHOR = 8
#: Cells of a block of the sketch; blocks are merged one by one.
BLOCK = 1 << 16
DEPTH = 2
#: Cells per row of the sketch: twice the expected anchors, in these bounds. The upper one keeps
#: the merged bitmaps at 64 MB; beyond it more windows are grouped exactly, and none is lost.
LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 28
#: A task combines what it has found after so many windows.
FLUSH_WINDOWS = 2_000_000


def sketch_cells(docs: DataFrame, width: int) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = size / 6 * 2 / (width - ANCHOR + 2)
    cells = LEAST_CELLS
    while cells < min(2 * expected, MOST_CELLS):
        cells *= 2
    return cells


def anchors(h: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[tuple]:
    """(row, hashes of 8-word runs, their least per window) of each text with a window."""
    runs = window_hashes(h, ANCHOR)
    for row in range(len(offsets) - 1):
        a, b = offsets[row], offsets[row + 1]
        if b - a >= width:
            mine = runs[a:b - ANCHOR + 1]
            yield row, mine, sliding(np.minimum, mine, width - ANCHOR + 1)


def chosen(runs: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs that are the least of some window, once for each place."""
    span = width - ANCHOR + 1
    reach = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    return runs[sliding(np.maximum, reach, span) == runs]


def cells_of(anchor: np.ndarray, row: int, cells: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(anchor + U64(0x9E3779B97F4A7C15) * U64(row + 1)) & U64(cells - 1)


def text_batches(parts: Iterator[pa.RecordBatch], width: int):
    """(batch, first row, word hashes, text offsets), some megabytes of text at a time."""
    for b in parts:
        text = b.column("text")
        for start, stop in batches(text):
            h, offsets = word_hashes(text.slice(start, stop - start))
            yield b, start, h, offsets


def sketch(docs: DataFrame, width: int, cells: int) -> list[np.ndarray]:
    """For each row of the sketch a bitmap of the cells counted twice or more."""
    per_row = cells // BLOCK

    def partial(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        anchor = np.concatenate(found)
        for row in range(DEPTH):
            cell, n = np.unique(cells_of(anchor, row, cells), return_counts=True)
            cuts = np.searchsorted(cell, np.arange(per_row + 1, dtype=np.uint64) * U64(BLOCK))
            low, twice = (cell & U64(BLOCK - 1)).astype("<u2"), n > 1
            used = np.flatnonzero(np.diff(cuts))
            for some in np.array_split(used, max(1, len(used) // 1000)):
                spans = [slice(cuts[k], cuts[k + 1]) for k in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some + row * per_row, pa.int64()),
                     pa.array([low[s].tobytes() for s in spans], pa.binary()),
                     pa.array([low[s][twice[s]].tobytes() for s in spans], pa.binary())],
                    ["block", "once", "twice"])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for _, _, h, offsets in text_batches(parts, width):
            for _, runs, least in anchors(h, offsets, width):
                found.append(chosen(runs, least, width))
                n += len(found[-1])
            if n > FLUSH_WINDOWS:
                yield from partial(found)
                found, n = [], 0
        if n:
            yield from partial(found)

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by block, so one block is held at a time.
        def done(block: int, seen: np.ndarray) -> pa.RecordBatch:
            bits = np.packbits(seen > 1, bitorder="little")
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([bits.tobytes()], pa.binary())],
                ["block", "bits"])

        now, seen = None, None
        for b in parts:
            for block, once, twice in zip(*(c.to_pylist() for c in b.columns)):
                if block != now:
                    if now is not None:
                        yield done(now, seen)
                    now, seen = block, np.zeros(BLOCK, np.uint8)
                for cell in (once, twice):
                    at = np.frombuffer(cell, "<u2")
                    seen[at] = np.minimum(seen[at] + 1, 2)
        if now is not None:
            yield done(now, seen)

    blocks = (docs.select("text").mapInArrow(count, "block long, once binary, twice binary")
              .repartition("block").sortWithinPartitions("block")
              .mapInArrow(merge, "block long, bits binary"))
    bitmaps = [np.zeros(cells // 8, np.uint8) for _ in range(DEPTH)]
    for r in blocks.toLocalIterator():
        row, k = divmod(r.block, per_row)
        bitmaps[row][k * BLOCK // 8:(k + 1) * BLOCK // 8] = np.frombuffer(r.bits, np.uint8)
    return bitmaps


def maybe_repeated(anchor: np.ndarray, bitmaps: list[np.ndarray]) -> np.ndarray:
    keep = np.ones(len(anchor), bool)
    for row, bits in enumerate(bitmaps):
        cell = cells_of(anchor, row, 8 * len(bits))
        keep &= (bits[(cell >> U64(3)).astype(np.int64)]
                 >> (cell & U64(7)).astype(np.uint8)) & 1 == 1
    return keep


def candidate_runs(parts: Iterator[pa.RecordBatch], width: int, bitmaps: list[np.ndarray]):
    """(batch, row, first window, anchor, window hashes) of runs that the sketch leaves."""
    for b, first, h, offsets in text_batches(parts, width):
        whole = window_hashes(h, width)
        for row, _, least in anchors(h, offsets, width):
            # One look-up for each run of windows with the same anchor.
            begin = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            end = np.append(begin[1:], len(least))
            keep = maybe_repeated(least[begin], bitmaps)
            mine = whole[offsets[row]:offsets[row] + len(least)]
            for i, j in zip(begin[keep], end[keep]):
                yield b, first + row, int(i), least[i], mine[i:j]


def repeated_windows(docs: DataFrame, width: int, shared) -> DataFrame:
    """anchor and the sorted hashes of its windows that occur twice or more."""
    def combined(anchor: list, hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        size = np.fromiter(map(len, hashes), np.int64, len(hashes))
        keys = np.repeat(np.array(anchor, np.uint64), size)
        flat = np.concatenate(hashes)
        order = np.lexsort((flat, keys))
        keys, flat = keys[order], flat[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (flat[1:] != flat[:-1])])
        at = np.flatnonzero(new)
        many = np.diff(np.append(at, len(flat))) > 1
        keys, flat = keys[at], flat[at]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        cuts = np.append(begin, len(keys))
        for some in np.array_split(np.arange(len(begin)), max(1, len(begin) // 5000)):
            spans = [slice(cuts[k], cuts[k + 1]) for k in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[begin[some]].view(np.int64)),
                 pa.array([flat[s][~many[s]].tobytes() for s in spans], pa.binary()),
                 pa.array([flat[s][many[s]].tobytes() for s in spans], pa.binary())],
                ["anchor", "once", "twice"])

    def combine(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, hashes, n = [], [], 0
        for _, _, _, a, h in candidate_runs(parts, width, shared.value):
            anchor.append(a)
            hashes.append(h)
            n += len(h)
            if n > FLUSH_WINDOWS:
                yield from combined(anchor, hashes)
                anchor, hashes, n = [], [], 0
        if n:
            yield from combined(anchor, hashes)

    def exact(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by anchor. Of one anchor, its distinct hashes are held.
        def repeats(seen: list[np.ndarray], many: list[np.ndarray]) -> bytes:
            flat = np.sort(np.concatenate(seen)) if seen else np.zeros(0, np.uint64)
            again = flat[1:][flat[1:] == flat[:-1]]
            return np.unique(np.concatenate([again, *many])).tobytes()

        now, seen, many, keys, found, held = None, [], [], [], [], 0
        for b in parts:
            for a, once, twice in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                      b.column(2).to_pylist()):
                if a != now:
                    if now is not None and (r := repeats(seen, many)):
                        keys.append(now)
                        found.append(r)
                    now, seen, many, held = a, [], [], 0
                o, t = np.frombuffer(once, np.uint64), np.frombuffer(twice, np.uint64)
                seen += [o, t]
                many.append(t)
                held += len(o) + len(t)
                if held > FLUSH_WINDOWS:
                    # Fold: each distinct hash once, those met again apart.
                    again = np.frombuffer(repeats(seen, many), np.uint64)
                    seen, many = [np.unique(np.concatenate(seen))], [again]
                    held = 0
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(found, pa.binary())],
                    ["anchor", "hashes"])
                keys, found = [], []
        if now is not None and (r := repeats(seen, many)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([r], pa.binary())], ["anchor", "hashes"])

    return (docs.select("text").mapInArrow(combine, "anchor long, once binary, twice binary")
            .repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(exact, "anchor long, hashes binary"))


def repeated_starts(docs: DataFrame, width: int, shared) -> DataFrame:
    """doc_id, th and the starts of repeated windows: first window and a bit for each of a run."""
    def runs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def out() -> pa.RecordBatch:
            at = pa.array([r[0] for r in rows], pa.int64())
            return pa.RecordBatch.from_arrays(
                [now.column("doc_id").take(at), now.column("th").take(at),
                 pa.array([r[1] for r in rows], pa.int64()),
                 pa.array(np.array([r[2] for r in rows], np.uint64).view(np.int64)),
                 pa.array([r[3] for r in rows], pa.binary())],
                ["doc_id", "th", "first", "anchor", "windows"])

        for b, row, first, anchor, h in candidate_runs(parts, width, shared.value):
            if rows and (b is not now or len(rows) >= 20_000):
                yield out()
                rows = []
            now = b
            rows.append((row, first, anchor, h.tobytes()))
        if rows:
            yield out()

    def marks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            keep, bits = [], []
            for i, (mine, known) in enumerate(zip(b.column("windows").to_pylist(),
                                                  b.column("hashes").to_pylist())):
                mine, known = np.frombuffer(mine, np.uint64), np.frombuffer(known, np.uint64)
                at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                hit = known[at] == mine
                if hit.any():
                    keep.append(i)
                    bits.append(np.packbits(hit, bitorder="little").tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(at) for c in ("doc_id", "th", "first")),
                 pa.array(bits, pa.binary())], ["doc_id", "th", "first", "bits"])

    mine = docs.mapInArrow(runs, "doc_id long, th long, first long, anchor long, windows binary")
    known = repeated_windows(docs, width, shared)
    return (mine.join(known, "anchor").select("doc_id", "th", "first", "windows", "hashes")
            .mapInArrow(marks, "doc_id long, th long, first long, bits binary"))


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed and the kept text (words joined by one space) of every row."""
    rows = doc_rows(docs)
    shared = docs.sparkSession.sparkContext.broadcast(
        sketch(rows, width, sketch_cells(rows, width)))
    starts = repeated_starts(rows, width, shared).groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("first", "bits")).alias("runs"))  # bounded by the text itself

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            out = []
            for data, runs in zip(b.column("text").cast(pa.binary()).to_pylist(),
                                  b.column("runs").to_pylist()):
                words = data.split()
                gone = np.zeros(len(words) + 1, np.int64)
                for r in runs or ():
                    bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
                    at = np.flatnonzero(bits) + r["first"]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + width, -1)
                covered = np.cumsum(gone)[:-1] > 0
                if runs:
                    kept = [w for w, c in zip(words, covered.tolist()) if not c]
                else:
                    kept = words
                out.append((len(words), len(words) - len(kept), b" ".join(kept)))
            n, removed, text = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(text, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"])

    # Every row meets one list of runs at most: starts are grouped by the same key.
    joined = rows.join(starts, same_row(rows, starts), "left").select(
        rows["doc_id"], rows["text"], "runs")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")


def substring_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    return remove_repeats(docs, width).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
