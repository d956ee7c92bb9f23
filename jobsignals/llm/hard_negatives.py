"""Hard negatives for anchors, scored by an exact integer GEMM in a residue number system.

Vectors are quantised to integers (floor(256 x)). An integer inner product is computed exactly
without 64-bit multiplies: the component matrices are reduced modulo several small primes, each
product of residue matrices is a float32 GEMM whose every partial sum stays below 2^24 (so
float32 holds it exactly), and the signed scores are rebuilt from their residues by Chinese
remaindering (Garner's mixed radix, symmetric digits). The primes are as many as the observed
largest possible score needs.

Anchors (the stated query set) meet all rows in blocks: rows are dealt to row blocks, anchors to
anchor blocks, and every (row block, anchor block) pair is one co-grouped task, so that no task
holds more than `ROW_BLOCK` rows and `ANCHOR_BLOCK` anchors. Each task keeps only a windowed
selection (its local first 5 positives, or first 3 negatives per positive); global ranks come from
merging those few rows. Positives need all blocks first, so negatives are a second pass that
scores the blocks again.

Defined cases: rows with a null vec_id, label or vector, any null or non-finite component, a
component with |floor(256 x)| >= 2^20 or more than 2^15 components take no part. Of valid rows
sharing a vec_id, the least by (label, quantised vector) stands for it. Shorter vectors count as
padded with zeros. Ties go to the smaller vec_id. An anchor with fewer positives or negatives
than asked gets all it has; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from jobsignals.llm.common import save, ship

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies within these percentages of its positive's.
LOW, HIGH = 50, 95
SCALE = 256
MOST_COMPONENT, MOST_DIMS = 1 << 20, 1 << 15
#: Rows and anchors that one task scores against each other; anchors go in slices of SLICE.
ROW_BLOCK, ANCHOR_BLOCK, SLICE = 1 << 13, 1 << 10, 256
#: Components summed in one float32 GEMM.
CHUNK = 64
EXACT = 1 << 24

OUT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
       "negative_score long")
PICKED = "anchor_id long, vec_id long, score long, slot long"


def primes_for(bound: int, chunk: int = CHUNK) -> list[int]:
    """Largest primes p with chunk * (p-1)^2 < 2^24, as many as a product above 2 * bound needs."""
    top = math.isqrt((EXACT - 1) // chunk) + 1
    out, product, p = [], 1, top
    while product <= 2 * bound + 1:
        if p < 3:
            raise ValueError("too few primes for these scores")
        if all(p % d for d in range(2, math.isqrt(p) + 1)):
            out.append(p)
            product *= p
        p -= 1
    return out


def rns_scores(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """Exact a @ b.T of int64 matrices, by float32 GEMMs modulo the primes and Garner's CRT."""
    x = m = None
    for p in primes:
        ra, rb = np.mod(a, p), np.mod(b, p)
        r = np.zeros((len(a), len(b)), np.int64)
        for s in range(0, a.shape[1], CHUNK):
            part = ra[:, s:s + CHUNK].astype(np.float32) @ rb[:, s:s + CHUNK].T.astype(np.float32)
            r = (r + part.astype(np.int64)) % p
        if x is None:
            x, m = np.where(r > p // 2, r - p, r), p
            continue
        t = ((r - x) % p) * pow(m % p, -1, p) % p
        t = np.where(t > p // 2, t - p, t)
        w = m % (1 << 64)
        with np.errstate(over="ignore"):  # wraps modulo 2^64, and the sum is exact
            x = x + t * np.int64(w - (1 << 64) if w >= 1 << 63 else w)
        m *= p
    return x


def vectors(embeddings: DataFrame) -> DataFrame:
    """Valid rows, one per vec_id: vec_id, label (after relabelling), q (quantised components)."""
    x = F.col("embedding")
    ok = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
          & (F.size(x) <= MOST_DIMS)
          & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e)
                     & (F.abs(e.cast("double") * SCALE) < MOST_COMPONENT)))
    label = F.col("label").cast("long")
    rows = embeddings.where(ok).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
        .alias("label"),
        F.transform(x, lambda e: F.floor(e.cast("double") * SCALE).cast("long")).alias("q"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select(
        "vec_id", "r.label", "r.q")


def _frame(rows: pd.DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = rows.sort_values("vec_id", kind="stable")
    q = np.zeros((len(rows), dims), np.int64)
    for i, v in enumerate(rows["q"]):
        q[i, :len(v)] = v
    return rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), q


def _first(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor index, row index) of each anchor's first k allowed rows: higher score, then
    smaller index (rows are in vec_id order)."""
    ai, bi = np.nonzero(allowed)
    if not len(ai):
        return ai, bi
    order = np.lexsort((bi, -score[ai, bi], ai))
    ai, bi = ai[order], bi[order]
    start = np.r_[0, np.flatnonzero(np.diff(ai)) + 1]
    rank = np.arange(len(ai)) - np.repeat(start, np.diff(np.r_[start, len(ai)]))
    keep = rank < k
    return ai[keep], bi[keep]


def block_picks(rows: pd.DataFrame, anchors: pd.DataFrame, dims: int, primes: list[int],
                positives: pd.DataFrame | None) -> pd.DataFrame:
    """Local picks of one (row block, anchor block): positives (slot -1) or, given the anchors'
    positives, the first negatives of each (slot = the positive's vec_id)."""
    types = {"anchor_id": "int64", "vec_id": "int64", "score": "int64", "slot": "int64"}
    empty = pd.DataFrame({c: [] for c in types}).astype(types)
    if rows.empty or anchors.empty:
        return empty
    ids, labels, q = _frame(rows, dims)
    aids, alabels, aq = _frame(anchors, dims)
    out = []
    for s in range(0, len(aids), SLICE):
        sa, sl = aids[s:s + SLICE], alabels[s:s + SLICE]
        score = rns_scores(aq[s:s + SLICE], q, primes)
        other = ids[None, :] != sa[:, None]
        if positives is None:
            ai, bi = _first(score, other & (labels[None, :] == sl[:, None]), POSITIVES)
            out.append(pd.DataFrame({"anchor_id": sa[ai], "vec_id": ids[bi],
                                     "score": score[ai, bi], "slot": np.full(len(ai), -1)}))
            continue
        unlike = other & (labels[None, :] != sl[:, None])
        mine = positives[positives["anchor_id"].isin(sa)]
        where = {a: i for i, a in enumerate(sa)}
        for (a, pid), ps in zip(zip(mine["anchor_id"], mine["positive_id"]),
                                mine["positive_score"]):
            i = where[a]
            fit = unlike[i] & (LOW * ps <= 100 * score[i]) & (100 * score[i] <= HIGH * ps)
            _, bi = _first(score[i:i + 1], fit[None, :], NEGATIVES)
            out.append(pd.DataFrame({"anchor_id": np.full(len(bi), a), "vec_id": ids[bi],
                                     "score": score[i, bi], "slot": np.full(len(bi), pid)}))
    return pd.concat([empty, *out]).astype(types)


def mine(embeddings: DataFrame, row_block: int = ROW_BLOCK,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = save(vectors(embeddings), "embedding-rows")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("dims"),
                     F.max(F.array_max(F.transform("q", lambda e: F.abs(e)))).alias("most"),
                     F.count(F.when(F.col("vec_id") % ANCHOR_EVERY == 0, 1)).alias("anchors")
                     ).first()
    if not facts.n or not facts.anchors:
        return spark.createDataFrame([], OUT)
    dims = max(1, facts.dims)
    primes = primes_for(dims * int(facts.most) ** 2)
    n_rows = max(1, -(-facts.n // row_block))
    n_anchors = max(1, -(-facts.anchors // anchor_block))
    dealt = rows.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(n_rows)).cast("int").alias("rb"),
                        F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))).alias("ab"))
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)

    def picks(positives: DataFrame | None) -> DataFrame:
        a = anchors
        if positives is not None:
            a = a.join(positives.groupBy("anchor_id").agg(F.collect_list(F.struct(
                "positive_id", "positive_score")).alias("pos")),
                a["vec_id"] == F.col("anchor_id"))
        # new names, so that the two sides of the co-group share no column of `rows`
        a = a.select(*(F.col(c).alias(c) for c in a.columns),
                     F.pmod(F.xxhash64("vec_id"), F.lit(n_anchors)).cast("int").alias("ab"),
                     F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("rb"))

        second = positives is not None  # the task must not hold the frame itself

        def task(r: pd.DataFrame, an: pd.DataFrame) -> pd.DataFrame:
            pos = None
            if second:
                pos = pd.DataFrame(
                    [(v, p["positive_id"], p["positive_score"])
                     for v, ps in zip(an["vec_id"], an["pos"]) for p in ps],
                    columns=["anchor_id", "positive_id", "positive_score"])
            return block_picks(r, an, dims, primes, pos)

        return (dealt.groupBy("rb", "ab").cogroup(a.groupBy("rb", "ab"))
                .applyInPandas(task, PICKED))

    first = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    positives = save(picks(None).withColumn("r", F.row_number().over(first))
                     .where(F.col("r") <= POSITIVES)
                     .select("anchor_id", F.col("vec_id").alias("positive_id"),
                             F.col("score").alias("positive_score")), "positives")
    per = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    negatives = (picks(positives).withColumn("rank", F.row_number().over(per))
                 .where(F.col("rank") <= NEGATIVES))
    return negatives.join(positives, (negatives["anchor_id"] == positives["anchor_id"])
                          & (negatives["slot"] == positives["positive_id"])).select(
        negatives["anchor_id"], "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
