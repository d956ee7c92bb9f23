"""Prefix trie of conversations, built as a burst trie over Spark.

Every conversation is a sequence of turns (role, text). A turn gets a 128-bit id, and a prefix of
d turns a 128-bit key chained from its parent's key and its d-th turn id, so that equal prefixes,
and only these, share a key. Identical conversations are collapsed first (count, least id).

Trie heads partition the conversations into containers: all conversations that begin with a head.
The root is the first head. A container holding more than `CONTAINER_TURNS` turns of more than one
distinct conversation bursts: its conversations move to child containers keyed by their next turn
id, one level deeper, in a Spark job per level; a conversation that ends at the burst head stays
behind as a terminal container. When no container is oversized, each is sorted in one task and
swept into nodes with a stack (counts, least id, children, leaves and saved tokens of every
subtree). The nodes above the containers, those that burst, are summed from the containers'
heads. The d-turn members of a node are hashed in conv_id order by one streaming pass over rows
sorted by (node, conv_id): SHA-256 is sequential, so a hot node is one task, but in bounded memory.

Defined cases: turns are ordered by turn (null first), then role and text, so that ties are
defined. A null role or text is empty. Rows with a null conv_id take no part. A conversation
whose rebuilt turns are none is a member of the root alone and ends there. Repeated rows are
turns each. An empty table gives no nodes, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignals.llm.common import WORD, save, ship

#: A container this many turns large, of more than one distinct conversation, bursts.
CONTAINER_TURNS = 1 << 17
#: Conversations are rebuilt from the one whose id is this multiple below theirs ...
GROUP = 20
#: ... taking at most HEADS - 1 of its first turns.
HEADS = 4
ROOT = bytes(16)
#: Stands for "none" in binary columns of the sweep (keys are 16 bytes), as Arrow cannot take
#: a column of None alone.
NONE = b""

NODE_SCHEMA = ("kind string, key binary, parent_key binary, depth long, n_convs long, "
               "conv_id long, n_children long, n_leaves long, saved_tokens long, "
               "child binary, words long, path binary")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (0, 1, ... in turn order), tid (128-bit turn id), words of its text."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    tid = F.unhex(F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"),
                                              F.col("role"), F.col("text")), 256), 1, 32))
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("pos"),
                       tid.alias("tid"),
                       F.size(F.regexp_extract_all("text", F.lit(WORD), 0)).cast("long")
                       .alias("words"))


def heads(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, tids and words of every rebuilt conversation, in turn order (maybe empty).

    Conversation c takes the first h turns of conversation c - c % GROUP, then its own turns
    after its first h, h = crc32(decimal c) % HEADS.
    """
    turns = save(turn_rows(conversations), "conversation-turns")
    ids = turns.select("conv_id").distinct().select(
        F.col("conv_id").alias("c"), heads(F.col("conv_id")).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % GROUP).alias("b"))
    own = (turns.where(F.col("pos") >= heads(F.col("conv_id")))
           .select(F.col("conv_id").alias("c"), F.lit(1).alias("part"), "pos", "tid", "words"))
    first = turns.where(F.col("pos") < HEADS - 1)
    borrowed = (ids.join(first, (first["conv_id"] == ids["b"]) & (first["pos"] < ids["h"]))
                .select("c", F.lit(0).alias("part"), "pos", "tid", "words"))
    grouped = own.unionByName(borrowed).groupBy("c").agg(
        F.array_sort(F.collect_list(F.struct("part", "pos", "tid", "words"))).alias("t"))
    t = F.col("t")
    return ids.join(grouped, "c", "left").select(
        F.col("c").alias("conv_id"),
        F.coalesce(F.transform(t, lambda x: x["tid"]), F.array().cast("array<binary>"))
        .alias("tids"),
        F.coalesce(F.transform(t, lambda x: x["words"]), F.array().cast("array<long>"))
        .alias("words"))


def _chain(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        keys = []
        for tids in p["tids"]:
            key, out = ROOT, [ROOT]
            for tid in tids:
                key = hashlib.blake2b(key + tid, digest_size=16).digest()
                out.append(key)
            keys.append(out)
        yield pd.DataFrame({"conv_id": p["conv_id"], "pk": keys, "words": p["words"]})


def prefix_keys(conversations: DataFrame) -> DataFrame:
    """conv_id, pk (keys of its prefixes of 0, 1, ... L turns), words, L."""
    ship(conversations.sparkSession)
    seqs = rebuilt(conversations).mapInPandas(
        _chain, "conv_id long, pk array<binary>, words array<long>")
    return save(seqs.withColumn("L", F.size("words")), "conversation-keys")


def _close(node: list, stack: list, out: list) -> None:
    depth, key, parent, n, least, children, leaves, saved, words = node
    saved += (n - 1) * words
    leaves = leaves if children else 1
    out.append(("node", key, parent, depth, n, least, children, leaves, saved, NONE, words, NONE))
    if stack:
        up = stack[-1]
        up[3] += n
        up[4] = min(up[4], least)
        up[6] += leaves
        up[7] += saved
    node[3:9] = [n, least, children, leaves, saved, words]


def _sweep(frame: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one container, and its share of the nodes above it."""
    k = int(frame["hd"].iloc[0])
    rows = sorted(zip(frame["pk"], frame["words"], frame["mult"], frame["least"]),
                  key=lambda r: list(r[0][k:]))
    path, words = list(rows[0][0][:k + 1]), list(rows[0][1])
    out: list = []
    if bool(frame["terminal"].iloc[0]):  # one conversation that ends at a burst node
        pk, _, mult, least = rows[0]
        for j in range(k + 1):
            out.append(("part", path[j], path[j - 1] if j else NONE, j, int(mult), int(least), 0,
                        0, 0, path[j + 1] if j < k else NONE, int(words[j - 1]) if j else 0,
                        b"".join(path[:j + 1])))
    else:
        stack: list = []
        previous = None
        head = None
        for pk, ws, mult, least in rows:
            length = len(pk) - 1
            if previous is None:
                shared = k - 1
            else:
                shared = k
                top = min(length, len(previous) - 1)
                while shared < top and pk[shared + 1] == previous[shared + 1]:
                    shared += 1
            while stack and stack[-1][0] > shared:
                node = stack.pop()
                _close(node, stack, out)
                if node[0] == k:
                    head = node
            for d in range(shared + 1, length + 1):
                if stack:
                    stack[-1][5] += 1
                stack.append([d, pk[d], pk[d - 1] if d else NONE, 0, 1 << 62, 0, 0, 0,
                              int(ws[d - 1]) if d else 0])
            stack[-1][3] += int(mult)
            stack[-1][4] = min(stack[-1][4], int(least))
            previous = pk
        while stack:
            node = stack.pop()
            _close(node, stack, out)
            if node[0] == k:
                head = node
        _, _, _, n, least, _, leaves, saved, _ = head
        for j in range(k):
            out.append(("part", path[j], path[j - 1] if j else NONE, j, n, least, 0, leaves,
                        saved, path[j + 1], int(words[j - 1]) if j else 0,
                        b"".join(path[:j + 1])))
    return pd.DataFrame(out, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def containers(seqs: DataFrame, most_turns: int) -> DataFrame:
    """Distinct conversations with hd, the depth of their container's head, and terminal."""
    level = 0
    seqs = seqs.withColumn("hd", F.lit(0)).withColumn("terminal", F.lit(False))
    while True:
        live = seqs.where(~F.col("terminal") & (F.col("hd") == level))
        big = (live.groupBy(F.element_at("pk", F.col("hd") + 1).alias("head"))
               .agg(F.sum(F.col("L") + 1).alias("turns"), F.count("*").alias("n"))
               .where((F.col("turns") > most_turns) & (F.col("n") > 1))
               .select("head", F.lit(True).alias("burst")))
        if big.isEmpty():
            return seqs
        head = F.element_at("pk", F.col("hd") + 1)
        joined = seqs.join(big, (head == big["head"]) & (seqs["hd"] == level)
                           & ~seqs["terminal"], "left")
        burst = F.coalesce(F.col("burst"), F.lit(False))
        seqs = save(joined.select(
            "key", "pk", "words", "mult", "least", "L",
            F.when(burst & (F.col("L") > F.col("hd")), F.col("hd") + 1).otherwise(F.col("hd"))
            .alias("hd"),
            (F.col("terminal") | (burst & (F.col("L") == F.col("hd")))).alias("terminal")),
            "conversation-containers")
        level += 1


def _ends(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, SHA-256 of its conv_ids) over rows sorted by key, then conv_id; streaming."""
    key, digest, first = None, None, True
    for p in parts:
        out_keys, out_hashes = [], []
        for k, c in zip(p["key"], p["conv_id"]):
            if k != key:
                if key is not None:
                    out_keys.append(key)
                    out_hashes.append(digest.hexdigest())
                key, digest, first = k, hashlib.sha256(), True
            digest.update((str(c) if first else "," + str(c)).encode())
            first = False
        if out_keys:  # Arrow cannot type an empty column of objects
            yield pd.DataFrame({"key": out_keys, "ends_sha256": out_hashes})
    if key is not None:
        yield pd.DataFrame({"key": [key], "ends_sha256": [digest.hexdigest()]})


def trie(conversations: DataFrame, most_turns: int = CONTAINER_TURNS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, key (its 16-byte prefix key)."""
    seqs = prefix_keys(conversations)
    distinct = seqs.groupBy(F.element_at("pk", -1).alias("key")).agg(
        F.first("pk").alias("pk"), F.first("words").alias("words"),
        F.count("*").alias("mult"), F.min("conv_id").alias("least"), F.first("L").alias("L"))
    placed = containers(distinct, most_turns)
    swept = placed.groupBy(F.element_at("pk", F.col("hd") + 1).alias("head"), "terminal"
                           ).applyInPandas(_sweep, NODE_SCHEMA)
    none = {c: F.when(F.length(c) > 0, F.col(c)) for c in ("parent_key", "child")}
    swept = save(swept.withColumns(none), "conversation-nodes")
    below = swept.where(F.col("kind") == "node").drop("kind", "child", "path")
    parts = swept.where(F.col("kind") == "part")
    above = parts.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.count_distinct("child").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.first("words").alias("words"),
        F.first("path").alias("path"))
    keys = F.transform(F.sequence(F.lit(0), (F.length("path") / 16).cast("int") - 1),
                       lambda i: F.substring("path", (i * 16 + 1).cast("int"), 16))
    own = above.select(F.explode(keys).alias("key"),
                       ((F.col("n_convs") - 1) * F.col("words")).alias("own"))
    inner = own.groupBy("key").agg(F.sum("own").alias("inner"))
    above = above.join(inner, "key").select(
        "key", "parent_key", "depth", "n_convs", "conv_id", "n_children", "n_leaves",
        (F.col("saved_tokens") + F.col("inner")).alias("saved_tokens"), "words")
    nodes = save(below.unionByName(above), "conversation-all-nodes")
    ends = (seqs.select(F.element_at("pk", -1).alias("key"), "conv_id")
            .repartition("key").sortWithinPartitions("key", "conv_id")
            .mapInPandas(_ends, "key binary, ends_sha256 string"))
    parents = nodes.select(F.col("key").alias("parent_key"),
                           F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return (nodes.join(ends, "key", "left").join(parents, "parent_key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "key"))


def trie_report(conversations: DataFrame, most_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The contract's columns: one row per node."""
    return trie(conversations, most_turns).drop("key")
