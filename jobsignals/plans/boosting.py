"""Boosted regression trees in chunks of rounds that survive a lost driver or executor.

Margins start at the labels' mean. Each round fits one regression tree (`trees.py`) to the
residuals of the margins, on a seeded share of the rows (`subsample`) and a seeded share of the
feature columns drawn anew for every tree (`colsample`: the only columns that tree may split
on), and adds its prediction to every row's margin: the first at full weight, as Spark's own
boosted trees do, the others times `rate`. Rounds run in chunks: at the end of a chunk the
blocks of rows with their margins, the chunk's trees and their column lists are written below
`state`, then a marker. A run that finds markers continues after the last marked chunk, from the
stored margins. Residuals enter the trees as whole numbers of a fixed step, so their sums, and
with them the trees, do not depend on the order of rows, and every draw is seeded by its round:
a killed fit, resumed, ends with the same trees as one that ran through.

Rows that one task can hold go through a whole chunk of rounds in it; more rows take a Spark job
a level. Both give the same trees. Only the newest two chunks keep their rows; trees stay. The
driver holds all trees while predicting: rounds x 2^depth nodes at most, whatever the rows.
"""

from __future__ import annotations

import json
import math
import pickle
import sys
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.plans import trees as tr
from jobsignals.session import delete, enable_checkpoints

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 25
KEEP_ROWS = 2
#: Rounds of a job-a-level fit between two times that the margins are stored.
CUT_EVERY = 5
#: Bits of a residual; with at most 2^27 rows their sums stay below 2^62.
BITS = 34


@dataclass
class Booster:
    """What a fit leaves in `state`: the base margin, the rate, the bins and chunks of trees."""

    state: str
    base: float
    rate: float
    rounds: int
    chunk: int

    def trees(self, spark: SparkSession, k: int) -> list:
        """(columns, tree) of chunk k, in round order."""
        folder = f"{self.state}/chunk-{k:05d}"
        columns = json.loads(tr.get(spark, f"{folder}/columns")["columns"])
        found = tr.get(spark, f"{folder}/tree-*")
        return [(c, tr.Tree.load(found[f"tree-{i}"])) for i, c in enumerate(columns)]

    def all_trees(self, spark: SparkSession) -> list:
        return [x for k in range(math.ceil(self.rounds / self.chunk))
                for x in self.trees(spark, k)]

    def importances(self, spark: SparkSession, width: int) -> np.ndarray:
        """Each tree's importances (they sum to 1) put back on the full columns, summed over
        the trees and scaled to sum to 1, as Spark's boosted trees report them."""
        total = np.zeros(width)
        for cols, tree in self.all_trees(spark):
            total[cols] += tree.featureImportances.toArray()
        return total / total.sum() if total.sum() else total

    def copy_to(self, spark: SparkSession, path: str) -> "Booster":
        """The same booster with its trees below `path`."""
        tr.put(spark, f"{path}/bins", tr.get(spark, f"{self.state}/bins")["bins"])
        for k in range(math.ceil(self.rounds / self.chunk)):
            _put_trees(spark, f"{path}/chunk-{k:05d}", self.trees(spark, k))
        return Booster(path, self.base, self.rate, self.rounds, self.chunk)

    def predict(self, df: DataFrame, features: str, out: str, scratch: str) -> DataFrame:
        """df with `out`, the summed margin of all trees."""
        spark = df.sparkSession
        df.withColumns({"_row": F.monotonically_increasing_id(), "_y": F.lit(0.0)}).write.parquet(
            f"{scratch}/rows")
        rows = spark.read.parquet(f"{scratch}/rows")
        whole = tr.get(spark, f"{self.state}/bins")["bins"]
        dumps = spark.sparkContext.broadcast(pickle.dumps(
            [(c, t.dump()) for c, t in self.all_trees(spark)]))
        base, rate = self.base, self.rate

        def margins(batches):
            bins = tr.Bins.load(whole)
            mine = [(c, tr.Tree.load(d)) for c, d in pickle.loads(dumps.value)]
            for batch in batches:
                for part in tr.unpacked(batch, bins):
                    part.margin += base
                    for t, (cols, tree) in enumerate(mine):
                        add(part, cols, tree, t, rate)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part.row), pa.array(part.margin)], ["_row", out])

        plain = spark.read.schema(tr.ROWS.replace("features", f"`{features}`", 1)).parquet(
            f"{scratch}/rows").withColumnRenamed(features, "features")
        plain.mapInArrow(margins, f"_row long, `{out}` double").write.parquet(
            f"{scratch}/margins")
        return rows.join(spark.read.parquet(f"{scratch}/margins"), "_row").drop("_row", "_y")


def _put_trees(spark: SparkSession, folder: str, trees: list) -> None:
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: tr.put(spark, f"{folder}/tree-{i}", trees[i][1].dump()),
                      range(len(trees))))
    tr.put(spark, f"{folder}/columns", json.dumps([c for c, _ in trees]).encode())


def add(part: tr.Part, cols: list, tree: tr.Tree, t: int, rate: float, node=None) -> None:
    """Add the tree's prediction to the part's margins; round 0 weighs 1."""
    if node is None:
        node = np.zeros(len(part.row), np.int32)
    node = tr.descend(part.dense, tree, node, cols)
    part.margin += (rate if t else 1.0) * tree.values()[node]


@dataclass
class Plan:
    """What decides the trees, besides the rows."""

    base: float
    scale: float
    width: int
    depth: int
    rate: float
    subsample: float
    keep: int
    seed: int

    def columns(self, t: int) -> list[int]:
        return sorted(np.random.default_rng([self.seed, t]).choice(
            self.width, self.keep, replace=False).tolist())

    def picked(self, row: np.ndarray, t: int) -> np.ndarray:
        draw = tr.mix(tr.mix(row) ^ tr.mix(self.seed * (1 << 32) + t)) >> tr.U(44)
        return draw < int(self.subsample * (1 << 20))


class Round:
    """A part as round t sees it: picked rows, kept columns, residuals as whole numbers."""

    def __init__(self, part: tr.Part, plan: Plan, t: int, cols: list):
        self.part, self.cols, self.width = part, cols, len(cols)
        self.picked = plan.picked(part.row, t)
        limit = float(1 << BITS + 1)
        self.q = np.clip(np.rint((part.y - part.margin) * plan.scale), -limit, limit)
        place = np.full(plan.width, -1, np.int64)
        place[cols] = np.arange(self.width)
        at = place[part.cols]
        keep = np.flatnonzero((at >= 0) & self.picked[part.at])
        self.at = part.at[keep]
        self.cell = at[keep] * tr.BINS + part.bins[keep]
        self.own = self.q[self.at]
        self.node = np.zeros(len(part.row), np.int32)

    def total(self) -> np.ndarray:
        return np.array([self.picked.sum(), self.q[self.picked].astype(np.int64).sum()], np.int64)

    def cells(self, tree: tr.Tree, front: np.ndarray):
        self.node = tr.descend(self.part.dense, tree, self.node, self.cols)
        slot = tr.slots_of(tree, front)[self.node][self.at]
        live = np.flatnonzero(slot >= 0)
        if len(live) < len(slot) // 2:  # rows in leaves are not met again
            self.at, self.cell, self.own = self.at[live], self.cell[live], self.own[live]
            slot, live = slot[live], slice(None)
        each = self.width * tr.BINS
        return tr.summed(slot[live] * each + self.cell[live], [None, self.own[live]],
                         len(front) * each)


def _root(total: np.ndarray, plan: Plan, t: int) -> tr.Tree:
    tree = tr.Tree(plan.keep, total, plan.seed + t)
    tree.scale = plan.scale
    return tree


def _near(parts: list, bins: tr.Bins, plan: Plan, first: int, last: int) -> list:
    """Rounds first..last-1 over parts at hand; their margins move on."""
    out = []
    for t in range(first, last):
        cols = plan.columns(t)
        rounds = [Round(p, plan, t, cols) for p in parts]
        tree = _root(sum(r.total() for r in rounds), plan, t)
        zero = bins.zero[cols]

        def level(trees, fronts):
            found = tr.added([r.cells(trees[0], fronts[0]) for r in rounds])
            return [tr.splits(*found, trees[0].stats[fronts[0]], zero, 0, 1)]

        tr.grow([tree], level, plan.depth, True)
        for r in rounds:
            add(r.part, cols, tree, t, plan.rate, r.node)
        out.append((cols, tree))
    return out


def _far(blocks: DataFrame, bins: tr.Bins, plan: Plan, t: int, pending: list) -> tuple:
    """Round t by a job a level; `pending` trees are not yet in the blocks' margins."""
    cols = plan.columns(t)
    earlier = pickle.dumps([(i, c, x.dump()) for i, c, x in pending])

    def seen(part):
        for i, c, dump in pickle.loads(earlier):
            add(part, c, tr.Tree.load(dump), i, plan.rate)
        return Round(part, plan, t, cols)

    tree = _root(tr.sums(blocks, bins, lambda part: seen(part).total()), plan, t)
    level = tr.far(blocks, bins, lambda part, i, tree, front: seen(part).cells(tree, front),
                   [bins.zero[cols]], 0, 1)
    tr.grow([tree], level, plan.depth, True)
    return cols, tree


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where))


def _marked(spark: SparkSession, state: str) -> int:
    """Number of chunks whose marker stands (they stand in order)."""
    k = 0
    while _exists(spark, f"{state}/chunk-{k:05d}/_DONE/_SUCCESS"):
        k += 1
    return k


def _start(data: DataFrame, features: str, label: str, state: str) -> None:
    """Bins, facts and blocks of all rows, with the margins at the base."""
    spark = data.sparkSession
    rows = tr.store(data, features, label, f"{state}/rows-plain")
    bins = tr.fit_bins(rows)
    base = float(rows.agg(F.avg("_y")).first()[0] or 0.0)
    spread = float(rows.agg(F.max(F.abs(F.col("_y") - base))).first()[0] or 0.0)
    bits = BITS - max(0, math.ceil(math.log2(max(1, bins.rows))) - 27)
    scale = 2.0 ** (bits - math.ceil(math.log2(2 * spread))) if spread else 1.0

    def based(batches):
        use = tr.Bins.load(whole)
        for part in tr.parts(tr.payloads(batches), use):
            part.margin += base
            yield tr.payload([part.packed()], kind=[-1])

    whole = bins.dump()
    tr.blocks_of(rows, bins).mapInArrow(based, "kind int, payload binary").write.mode(
        "overwrite").parquet(f"{state}/rows-start")
    delete(spark, f"{state}/rows-plain")
    tr.put(spark, f"{state}/bins", whole)
    tr.put(spark, f"{state}/facts", json.dumps({"base": base, "scale": scale}).encode())


def fit(data: DataFrame, features: str, label: str, state: str, *, rounds: int = 1000,
        depth: int = 8, rate: float = 0.03, subsample: float = 0.7, colsample: float = 0.7,
        seed: int = 42, chunk: int = CHUNK, stop_after: int | None = None) -> Booster:
    """Fit, or continue the fit whose chunks stand in `state`. With `stop_after`, stop after
    so many chunks of this run (as a kill would), for tests."""
    spark = data.sparkSession
    enable_checkpoints(spark)
    done = _marked(spark, state)
    if done == 0:
        _start(data, features, label, state)
    bins = tr.Bins.load(tr.get(spark, f"{state}/bins")["bins"])
    facts = json.loads(tr.get(spark, f"{state}/facts")["facts"])
    plan = Plan(facts["base"], facts["scale"], bins.width, depth, rate, subsample,
                max(1, math.ceil(colsample * bins.width)), seed)
    for k in range(done, math.ceil(rounds / chunk)):
        folder = f"{state}/chunk-{k:05d}"
        first, last = k * chunk, min(rounds, (k + 1) * chunk)
        before = f"{state}/rows-start" if k == 0 else f"{state}/chunk-{k - 1:05d}/rows"
        run = _chunk_near if tr.near(bins) else _chunk_far
        trees = run(spark, before, folder, bins, plan, first, last)
        _put_trees(spark, folder, trees)
        spark.createDataFrame([(k,)], "chunk int").coalesce(1).write.mode("overwrite").json(
            f"{folder}/_DONE")
        if k >= KEEP_ROWS:
            delete(spark, f"{state}/chunk-{k - KEEP_ROWS:05d}/rows")
        if stop_after is not None and k + 1 - done >= stop_after:
            break
    return Booster(state, plan.base, rate, rounds, chunk)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("kind int, payload binary").parquet(path)


def _chunk_near(spark, before, folder, bins, plan, first, last) -> list:
    """A chunk of rounds in one task, which writes its trees beside the rows."""
    whole = bins.dump()

    def run(batches):
        use = tr.Bins.load(whole)
        parts = list(tr.parts(tr.payloads(batches), use))
        if parts:
            for t, (cols, tree) in enumerate(_near(parts, use, plan, first, last), first):
                yield tr.payload([pickle.dumps((cols, tree.dump()))], kind=[t])
        for part in parts:
            yield tr.payload([part.packed()], kind=[-1])

    (_blocks(spark, before).where("kind < 0").coalesce(1)
     .mapInArrow(run, "kind int, payload binary").write.mode("overwrite")
     .parquet(f"{folder}/rows"))
    found = _blocks(spark, f"{folder}/rows").where("kind >= 0").orderBy("kind").collect()
    return [(c, tr.Tree.load(d)) for c, d in (pickle.loads(bytes(r.payload)) for r in found)]


def _chunk_far(spark, before, folder, bins, plan, first, last) -> list:
    """A chunk of rounds by a job a level; margins are stored every few rounds."""
    trees, pending, at = [], [], before
    for t in range(first, last):
        cols, tree = _far(_blocks(spark, at).where("kind < 0"), bins, plan, t, pending)
        trees.append((cols, tree))
        pending.append((t, cols, tree))
        if (t + 1) % CUT_EVERY == 0 or t + 1 == last:
            to = f"{folder}/rows" if t + 1 == last else f"{folder}/cut-{t}"
            _moved(_blocks(spark, at).where("kind < 0"), bins, plan, pending).write.mode(
                "overwrite").parquet(to)
            if at != before:
                delete(spark, at)
            at, pending = to, []
    return trees


def _moved(blocks: DataFrame, bins: tr.Bins, plan: Plan, pending: list) -> DataFrame:
    """The blocks with the pending trees in their margins."""
    whole, new = bins.dump(), pickle.dumps([(i, c, x.dump()) for i, c, x in pending])

    def move(batches):
        mine = [(i, c, tr.Tree.load(d)) for i, c, d in pickle.loads(new)]
        for part in tr.parts(tr.payloads(batches), tr.Bins.load(whole)):
            for i, cols, tree in mine:
                add(part, cols, tree, i, plan.rate)
            yield tr.payload([part.packed()], kind=[-1])

    return blocks.mapInArrow(move, "kind int, payload binary")
