"""Conversation trie against a plain Python trie built from every conversation."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from jobsignals.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"
R = random.Random(3)


def plain_trie(rows):
    """The contract, read literally: one tuple per node."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t, role or "", text or ""))
    ordered = {c: [(r, x) for _, r, x in sorted(v, key=lambda z: (z[0] is not None,
                                                                  z[0] or 0, z[1], z[2]))]
               for c, v in turns.items()}
    seqs = {}
    for c in ordered:
        h = zlib.crc32(str(c).encode()) % 4
        base = ordered.get(c - c % 20, [])
        seqs[c] = base[:h] + ordered[c][h:]
    nodes = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    children = defaultdict(set)
    for p in nodes:
        if p:
            children[p[:-1]].add(p)
    words = re.compile(r"[^\x20\x09-\x0D]+")

    sums = {}
    for p in sorted(nodes, key=len, reverse=True):  # children before their parents
        own = (len(nodes[p]) - 1) * (len(words.findall(p[-1][1])) if p else 0)
        leaves = 0 if children[p] else 1
        for q in children[p]:
            own, leaves = own + sums[q][0], leaves + sums[q][1]
        sums[p] = own, leaves

    out = set()
    for p, members in nodes.items():
        saved, leaves = sums[p]
        ends = sorted(c for c in members if len(seqs[c]) == len(p))
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members),
                 len(children[p]), leaves, saved,
                 hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def fixture():
    roles, texts = ["user", "assistant", None], ["hi there", "how are you", "fine", "", None,
                                                 "a b c d", "x  y\tz"]
    rows = []
    for c in range(0, 130):
        n = R.randrange(0, 7)
        for t in range(n):
            rows.append((c, t if R.random() > .1 else None, R.choice(roles), R.choice(texts)))
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(3)]  # hot copies
    rows += [(300, 1, "b", "tie"), (300, 1, "a", "tie"), (300, 1, "a", "tie"), (None, 0, "u", "x"),
             (301, None, None, None), (41, 0, "user", "hi there")]
    return rows


@pytest.mark.parametrize("most", [conversation_trie.CONTAINER_TURNS, 12, 2])
def test_trie_equals_plain(spark, most):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).select(
        "*", F.lit(1).alias("key"), F.lit("x").alias("pk"), F.lit(2).alias("hd"))
    got = {tuple(r) for r in conversation_trie.trie_report(df, most).collect()}
    assert len(got) == conversation_trie.trie_report(df, most).count()
    assert got == plain_trie(rows)


def test_empty_and_turnless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_trie.trie_report(empty).count() == 0
    # conversation 3 has one turn, h = crc32("3") % 4 = 3 and 0 has none below it: no turns
    rows = [(3, 0, "user", "hello")]
    got = {tuple(r) for r in conversation_trie.trie_report(
        spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain_trie(rows)


def test_long_conversation(spark):
    rows = [(7, t, "user", "w " * (t % 50)) for t in range(3000)]
    got = {tuple(r) for r in conversation_trie.trie_report(
        spark.createDataFrame(rows, SCHEMA), 500).collect()}
    assert got == plain_trie(rows)
