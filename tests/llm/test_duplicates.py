"""Exact, near and passage duplicates against plain Python over all rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import documents, lower, near_components, without_repeats
from jobsignals.llm import components, exact_dedup, near_dedup, substring_dedup

R = random.Random(5)
VOCABULARY = ["w%d" % i for i in range(400)]


def prose(n):
    return " ".join(R.choices(VOCABULARY, k=n))


def edited(text, n):
    w = text.split()
    for _ in range(n):
        w[R.randrange(len(w))] = R.choice(VOCABULARY)
    return " ".join(w)


BASE, SHARED = prose(220), prose(60)
ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "a b c d"),
       (906, "a b c e"), (None, "a b c d"), (None, None), (903, "one"), (903, "other text here")]
NEAR = ([(i, edited(BASE, R.randrange(1, 14))) for i in range(60)]
        + [(100 + i, prose(R.randrange(5, 150))) for i in range(60)]
        + [(200 + i, prose(30) + " " + SHARED + " " + prose(30)) for i in range(30)]
        + [(300 + i, BASE.upper() if i % 2 else BASE) for i in range(20)] + ODD)
PASSAGES = ([(i, prose(40) + "\n" + SHARED + "\n" + prose(R.randrange(50))) for i in range(30)]
            + [(50 + i, prose(R.randrange(200))) for i in range(40)]
            + [(100, "x y z " * 40), (101, SHARED), (102, SHARED[:-1]), (103, prose(4000))]
            + [(104, BASE), (105, BASE)] + ODD)


def extra(df):
    names = ("row", "th", "node", "label", "key", "recipe", "keep_id", "component", "text_sha256")
    return df.select("*", *(F.lit("x").alias(n) for n in names))


def test_near_groups_equal_all_pairs(spark):
    got = near_dedup.near_report(extra(documents(spark, NEAR)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()
                   ) == near_components(NEAR)
    for r in got.collect():
        assert r.kept == (r.doc_id == r.component_id)


def test_near_groups_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = near_dedup.near_report(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_components(rows)


def test_near_dedup_keeps_one_row_of_each(spark):
    got = near_dedup.deduplicate(extra(documents(spark, NEAR)))
    assert got.columns == extra(documents(spark, NEAR)).columns
    kept = Counter(r.doc_id for r in got.collect())
    least = {c for (_, n, c), _ in near_components(NEAR).items() if n}
    assert {d for d in kept if d is not None and d < 900} == {c for c in least if c < 900}
    assert all(kept[i] == 0 for i in range(300, 320))
    assert kept[900] == kept[901] == kept[902] == 1 and kept[904] == 0 and kept[903] == 2
    assert kept[None] == 1  # the empty text without an id; "a b c d" stays as 905


def test_near_dedup_of_nothing(spark):
    none = documents(spark, NEAR).where("false")
    assert near_dedup.near_report(none).isEmpty() and near_dedup.deduplicate(none).isEmpty()


def test_lists_that_hubs_do_not_settle(spark):
    # Chains: each text is close to its neighbours only.
    text, rows = prose(100).split(), []
    for i in range(12):
        rows.append((i, " ".join(text)))
        at = 6 * i
        text[at:at + 3] = R.choices(VOCABULARY, k=3)
    got = near_dedup.near_report(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_components(rows)


def test_a_pair_of_several_lists_is_made_once(spark):
    # Members 0 to 19 are linked already; 20 to 25 are not. All share the same three lists.
    sets = spark.createDataFrame([(i, [0] * near_dedup.BITMAP) for i in range(26)],
                                 "node int, bits array<long>")
    lists = spark.createDataFrame(
        [(k, i, 0 if i < 20 else i, 100, 100) for k in (7, 8, 9) for i in range(26)],
        "key long, node int, label int, n_shingles int, shared int")
    got = near_dedup.other_pairs(lists, sets)
    assert Counter((r.a, r.b) for r in got.collect()) == Counter(
        (a, b) for a in range(26) for b in range(20, 26) if a < b)
    joined = got._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")
    # No pair leaves the join twice, so none is removed behind it.
    assert len(joined) == 2 and "Aggregate" not in joined[0]


def test_bitmaps_never_differ_more_than_the_sets():
    rng = np.random.default_rng(4)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (rng.choice(pool, rng.integers(1, 380), replace=False) for _ in range(2))
        bits = [near_dedup.bitmap(x).view(np.uint8) for x in (a, b)]
        assert np.unpackbits(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


def test_signatures_estimate_similarity():
    a, b = near_dedup.multipliers()
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    equal = [(near_dedup.signature(pool[:875], a, b) == near_dedup.signature(pool[125:], a, b)).sum()]
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        equal.append((near_dedup.signature(pool[:875], a, b)
                      == near_dedup.signature(pool[125:], a, b)).sum())
    assert 46 < np.mean(equal) < 50 and min(equal) >= near_dedup.MATCHES


def test_components_of_paths_and_stars(spark):
    edges = [(f"{i * 7919 % 1009:04d}", f"{(i + 1) * 7919 % 1009:04d}") for i in range(60)]
    edges += [("hub", f"leaf{i}") for i in range(50)]
    got = components.contract(spark.createDataFrame(edges, "a string, b string"))
    labels = {r.node: r.label for r in got.collect()}
    assert len(labels) == 61 + 51 and len(set(labels.values())) == 2
    more = components.extend(got, spark.createDataFrame([("hub", edges[0][0]), ("new", "leaf1")],
                                                        "a string, b string"))
    labels = {r.node: r.label for r in more.collect()}
    assert len(labels) == 113 and len(set(labels.values())) == 1


@pytest.mark.parametrize("width", [35, 12])
def test_passages_equal_plain_removal(spark, width):
    got = substring_dedup.substring_report(extra(documents(spark, PASSAGES)), width).collect()
    assert Counter(map(tuple, got)) == without_repeats(PASSAGES, width)


def test_passages_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = substring_dedup.substring_report(docs).collect()
    assert Counter(map(tuple, got)) == without_repeats(rows, 35)


def test_a_full_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "LEAST_CELLS", 1 << 16)
    monkeypatch.setattr(substring_dedup, "MOST_CELLS", 1 << 16)
    monkeypatch.setattr(substring_dedup, "FLUSH_WINDOWS", 50)
    got = substring_dedup.substring_report(documents(spark, PASSAGES)).collect()
    assert Counter(map(tuple, got)) == without_repeats(PASSAGES, 35)


def test_passages_of_nothing(spark):
    assert substring_dedup.substring_report(documents(spark, PASSAGES).where("false")).isEmpty()


EXACT = [(1, "Same Text."), (5, "same text."), (3, "SAME TEXT."), (2, "same  text."),
         (4, "ÄB"), (6, "äb"), (7, "x" * 30_000), (8, "X" * 30_000), (9, "x" * 29_999)] + ODD


def test_exact_groups(spark):
    groups = {}
    for d, t in EXACT:
        groups.setdefault(lower(t), []).append(d)
    want = Counter()
    for d, t in EXACT:
        mine = groups[lower(t)]
        keep = max((x for x in mine if x is not None), default=None)
        want[(d, keep, len(mine), d == keep)] += 1
    got = exact_dedup.exact_groups(extra(documents(spark, EXACT)))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == want


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    got = exact_dedup.deduplicate(extra(documents(spark, EXACT))).collect()
    assert Counter(lower(r.text) for r in got) == Counter({lower(t) for _, t in EXACT})
    assert {r.doc_id for r in got if lower(r.text) == "same text."} == {5}
    assert exact_dedup.deduplicate(documents(spark, EXACT).where("false")).isEmpty()


def test_clashing_chunk_hashes_are_told_apart(spark):
    one = spark.createDataFrame([("a",), ("b",)], "part string")
    h = one.select(F.xxhash64("part")).first()[0]
    ids = one.select(exact_dedup.identifier(F.col("part"), [h])).collect()
    assert len(ids[0][0]) == 64 and len(ids[1][0]) < 64
    parts = one.select(F.array("part", "part", F.lit("c")).alias("parts"))
    assert exact_dedup.clashing_hashes(parts) == []


def test_chunks_are_the_text(spark):
    texts = ["", "a", "ab. " * 900, "y" * 20_000, "é\n" * 3000]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", exact_dedup.chunks(F.col("text")).alias("parts")).collect()
    for r in rows:
        assert "".join(r.parts) == r.text and all(0 < len(p) <= 8192 for p in r.parts)
    # An insertion at the front leaves later chunks alone.
    body = " ".join(prose(9) + "." for _ in range(400))
    a, b = (spark.createDataFrame([(t,)], "text string").select(
        exact_dedup.chunks(F.col("text"))).first()[0] for t in (body, "New. " + body))
    assert len(set(a) & set(b)) > len(a) // 2
