"""Near duplicates: an inverted join of MinHash coordinates, confirmed on the shingle sets.

Documents with equal shingle sets form a class and are represented once. Each class is posted
under every (coordinate, value) pair of its signature. Postings that only one class has cannot
collide. A pair with `MATCHES` equal coordinates of `COORDINATES` must meet in the rarest
`COORDINATES - MATCHES + 1` of either, so only these postings, the prefix, are merged; frequent
ones are skipped. Collisions are then counted on both whole signatures, and pairs above the match
threshold are confirmed on both full sets.

A posting list is not expanded into pairs. Round by round, each list links its members with one
hub, first with the member that has the fewest shingles of its own; where the links hold, the list
falls into components, and only members of different components still need a comparison. Before each round,
every member's shingles that also occur in another component are counted: no overlap with a member
of another component is larger, so members with too few leave the list. What the hubs leave is
compared pair by pair, so no link between components is lost, while a list of copies costs one
comparison a member, and texts that merely share a passage cost none.

A pair at similarity 0.75 has 48 equal coordinates of 64 on average; it has fewer than 30 with a
probability below one in a million.

Defined cases: null and wordless texts have the empty set, link with nothing, and stand alone. Rows
given twice are in one class. A null doc_id never becomes component_id unless the whole component
lacks ids (then it is null). Extra columns are carried through `deduplicate` untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import (
    U64, batches, doc_rows, mix, same_row, save, window_hashes, word_hashes,
)
from jobsignals.llm.components import extend

SHINGLE = 5
PERCENT = 75
COORDINATES, MATCHES = 64, 30
PREFIX = COORDINATES - MATCHES + 1
#: Hubs are tried as long as one comparison in so many gives a link, for so many rounds at most.
FRUITLESS, HUB_ROUNDS = 10, 12
#: 64-bit words of the bitmaps that rule pairs out before their sets are compared.
BITMAP = 16


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the empty set without words."""
    for start, stop in batches(texts):
        h, offsets = word_hashes(pc.ascii_lower(texts.slice(start, stop - start)))
        whole = window_hashes(h, SHINGLE)
        for a, b in zip(offsets[:-1], offsets[1:]):
            n = int(b - a)
            if n >= SHINGLE:
                yield np.unique(whole[a:b - SHINGLE + 1])
            elif n:
                yield mix(window_hashes(h[a:b], n) + U64(n))
            else:
                yield h[:0]


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    i = np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64)
    r = mix(i * U64(0x9E3779B97F4A7C15))
    return r[:COORDINATES] | U64(1), r[COORDINATES:]


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The upper half of the least value of each coordinate's hash."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1024):
        part = shingles[start:start + 1024, None] * a + b
        np.minimum(low, part.min(axis=0), out=low)
    return (low >> U64(32)).astype("<u4")


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """The set hashed to bits: two sets differ in at least as many shingles as bits."""
    at = mix(shingles) % U64(64 * BITMAP)
    words = np.zeros(BITMAP, np.uint64)
    np.bitwise_or.at(words, (at >> U64(6)).astype(np.int64), U64(1) << (at & U64(63)))
    return words.view(np.int64)


def signed(rows: DataFrame) -> DataFrame:
    """doc_id, th, n_shingles, node (name of the shingle set; null if empty) and postings."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = multipliers()
        high = np.arange(COORDINATES, dtype=np.int64) << 32
        for batch in parts:
            size, node, sig = [], [], []
            for s in shingle_sets(batch.column("text")):
                size.append(len(s))
                node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                            if len(s) else None)
                sig.append(signature(s, a, b).astype(np.int64) | high if len(s)
                           else np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, sig)]).astype(np.int32)
            flat = np.concatenate(sig) if sig else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(size, pa.int64()),
                 pa.array(node, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["doc_id", "th", "n_shingles", "node", "keys"])

    return rows.mapInArrow(run, "doc_id long, th long, n_shingles long, node binary, "
                                "keys array<long>")


def classes(rows: DataFrame) -> DataFrame:
    """One row per distinct shingle set: its size, signature and a row that has it."""
    return rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("row"),
        F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")).select(
        "node", "row.doc_id", "row.th", "n_shingles", "keys")


def prefix_postings(reps: DataFrame) -> DataFrame:
    """(key, node, n_shingles) of the rarest coordinates that other classes share."""
    postings = reps.select("node", "n_shingles", F.explode("keys").alias("key"))
    # Saved, so that a key many classes share is a plain shuffle that Spark can split.
    shared = save(postings.groupBy("key").agg(F.count("*").alias("df")).where("df > 1"), "keys")
    mine = postings.join(shared, "key").groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"),
        F.sort_array(F.collect_list(F.struct("df", "key"))).alias("found"))  # 64 at most
    alone = F.lit(COORDINATES) - F.size("found")
    return mine.where(alone < PREFIX).select(
        "node", "n_shingles",
        F.explode(F.slice("found", F.lit(1), F.lit(PREFIX) - alone)).alias("p")).select(
        F.col("p.key").alias("key"), "node", "n_shingles")


def needed_sets(rows: DataFrame, reps: DataFrame, postings: DataFrame) -> DataFrame:
    """(node, shingles, keys, bits) of the classes that have a prefix."""
    wanted = reps.join(postings.select("node").distinct(), "node", "left_semi")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            sets = list(shingle_sets(b.column("text")))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                 b.column("keys"), pa.array([bitmap(x) for x in sets], pa.list_(pa.int64()))],
                ["node", "shingles", "keys", "bits"])

    found = rows.join(wanted, same_row(rows, wanted)).select("node", rows["text"], "keys")
    return found.mapInArrow(run, "node binary, shingles array<long>, keys array<long>, "
                                 "bits array<long>").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with enough equal coordinates whose full sets are similar enough."""
    side_a = sets.select(F.col("node").alias("a"), F.col("keys").alias("ka"))
    side_b = sets.select(F.col("node").alias("b"), F.col("keys").alias("kb"))
    near = (pairs.join(side_a, "a").join(side_b, "b")
            .where(F.size(F.array_intersect("ka", "kb")) >= MATCHES).select("a", "b"))
    set_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    set_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            keep = []
            for i, (x, y) in enumerate(zip(b.column("sa"), b.column("sb"))):
                x, y = np.asarray(x.values), np.asarray(y.values)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= PERCENT * (len(x) + len(y) - both):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("a").take(at), b.column("b").take(at)], ["a", "b"])

    full = near.join(set_a, "a").join(set_b, "b").select("a", "b", "sa", "sb")
    return full.mapInArrow(run, "a binary, b binary")


def with_labels(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return postings.withColumn("label", F.col("node"))
    return postings.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def fits(small: str, large: str) -> Column:
    """Sets whose sizes alone allow the similarity."""
    return ((100 * F.least(small, large)) >= (PERCENT * F.greatest(small, large)))


def open_lists(postings: DataFrame, labels: DataFrame | None, sets: DataFrame) -> DataFrame:
    """Postings, with labels, of what may still be linked with another component.

    `shared` is how many shingles of the member occur in other components of any list. With
    the limit of 75 %, A and B are similar enough if 7 |A and B| >= 3 (|A| + |B|).
    """
    every = with_labels(postings, labels)
    several = save(every.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.min("n_shingles").alias("least_size")).where("low != high")
        .select("key", "least_size"), "keys")
    rows = save(every.join(several, "key"), "lists")
    nodes = rows.select("node", "label").distinct()
    each = sets.join(nodes, "node").select("node", "label", F.explode("shingles").alias("shingle"))
    common = save(each.groupBy("shingle").agg(
        F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
        .select("shingle"), "shared")
    shared = each.join(common, "shingle").groupBy("node").agg(F.count("*").alias("shared"))
    partner = F.greatest(F.col("n_shingles") * PERCENT / 100, "least_size")
    return save(rows.join(shared, "node").where(enough("shared", "n_shingles", partner)), "open")


def enough(overlap, size_a, size_b) -> Column:
    overlap, size_a, size_b = (F.col(x) if isinstance(x, str) else x
                               for x in (overlap, size_a, size_b))
    return (100 + PERCENT) * overlap >= PERCENT * (size_a + size_b)


def hub_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """Every member with the hub of its list: the first in an order that all lists share."""
    order = [1 - F.col("shared") / F.col("n_shingles")] if turn == 0 else []
    order = F.struct(*order, F.xxhash64("node", F.lit(turn)).alias("h"))
    hub = save(lists.groupBy("key").agg(
        F.min(F.struct(order.alias("order"), "node", "label", "n_shingles", "shared"))
        .alias("hub")), "hubs")
    return (lists.join(hub, "key").where("label != hub.label")
            .where(fits("n_shingles", "hub.n_shingles"))
            .where(enough(F.least("shared", "hub.shared"), "n_shingles", "hub.n_shingles"))
            .select(F.least("node", "hub.node").alias("a"),
                    F.greatest("node", "hub.node").alias("b")).distinct())


def other_pairs(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of one list that are still in different components, each pair once.

    Members of a list's largest component are compared with the members of its others only, and a
    pair that several lists share is made by the one with the least key. Pairs whose bitmaps
    differ in more places than similar sets can are never made.
    """
    largest = save(lists.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "label"))["label"].alias("main")), "largest")
    of_node = lists.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("at"))
    lists = save(lists.join(sets.select("node", "bits"), "node").join(of_node, "node")
                 .join(largest, "key"), "members")
    left = lists.where("label != main").select(
        "key", "main", F.col("node").alias("a"), F.col("label").alias("la"),
        F.col("n_shingles").alias("na"), F.col("shared").alias("sa"),
        F.col("bits").alias("bits_a"), F.col("at").alias("at_a"))
    right = lists.select("key", F.col("node").alias("b"), F.col("label").alias("lb"),
                         F.col("n_shingles").alias("nb"), F.col("shared").alias("sb"),
                         F.col("bits").alias("bits_b"), F.col("at").alias("at_b"))
    differ = sum((F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i]))
                  for i in range(BITMAP)), F.lit(0))
    return (left.join(right, "key").where("la != lb AND (lb = main OR a < b)")
            .where(fits("na", "nb")).where(enough(F.least("sa", "sb"), "na", "nb"))
            .where((100 + PERCENT) * differ <= (100 - PERCENT) * (F.col("na") + F.col("nb")))
            .where(F.col("key") == F.array_intersect("at_a", "at_b")[0])
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, th, n_shingles, component_id and component (null if empty) of every row."""
    rows = doc_rows(docs)
    sigs = save(signed(rows), "signatures")
    reps = save(classes(sigs), "classes")
    postings = save(prefix_postings(reps), "postings")
    sets = save(needed_sets(rows, reps, postings), "sets")
    labels, turn, hubs = None, 0, True
    while not (lists := open_lists(postings, labels, sets)).isEmpty():
        pairs = save(hub_pairs(lists, turn) if hubs else other_pairs(lists, sets), "pairs")
        links = save(confirmed(pairs, sets), "links")
        labels = extend(labels, links)
        if not hubs:
            break
        turn += 1
        n = pairs.count()
        hubs = turn < HUB_ROUNDS and n > 0 and FRUITLESS * links.count() >= n
    named = with_labels(reps.select("node", "doc_id"), labels)
    smallest = save(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "smallest")
    of_class = named.join(smallest, "label").select("node", "label", "component_id")
    linked = sigs.join(of_class, "node", "left")
    return linked.select(
        sigs["doc_id"], "th", "n_shingles",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"), F.col("label").alias("component"))


def near_report(docs: DataFrame) -> DataFrame:
    return near_groups(docs).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the smallest doc_id, and all without words."""
    groups = save(near_groups(docs), "components")
    first = groups.where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("row")
    ).select("row.doc_id", "row.th")
    stay = first.union(groups.where("component IS NULL").select("doc_id", "th")).distinct()
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"))
    joined = keyed.join(stay, same_row(keyed, stay), "left_semi")
    return joined.dropDuplicates(["doc_id", "th"]).select("row.*")
