"""Hard negatives against brute force, exact residue GEMM, and the byte-level classifier."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import documents
from jobsignals.llm import hard_negatives as hn
from jobsignals.llm import quality_cnn as qc

R = random.Random(11)
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_negatives(rows):
    valid = {}
    for v, e, lab in rows:
        if v is None or lab is None or e is None or len(e) > hn.MOST_DIMS:
            continue
        if any(x is None or not math.isfinite(x) or abs(x * 256) >= hn.MOST_COMPONENT for x in e):
            continue
        lab = (lab + 1) % 10 if v % 7 == 0 else lab
        q = [math.floor(float(np.float32(x)) * 256) for x in e]
        valid[v] = min(valid.get(v, (lab, q)), (lab, q))
    out = set()
    for a, (al, aq) in valid.items():
        if a % 50:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(aq, q)), v, lab)
                         for v, (lab, q) in valid.items() if v != a))
        pos = [(v, -s) for s, v, lab in scored if lab == al][:5]
        for p, ps in pos:
            neg = [(v, -s) for s, v, lab in scored
                   if lab != al and 50 * ps <= 100 * -s <= 95 * ps][:3]
            for rank, (n, ns) in enumerate(neg, 1):
                out.add((a, p, rank, n, ps, ns))
    return out


def fixture():
    base = [R.uniform(-.5, .5) for _ in range(16)]
    rows = []
    for v in range(400):
        e = [x + R.uniform(-.3, .3) for x in base] if v % 3 else [R.uniform(-.5, .5)
                                                                   for _ in range(16)]
        rows.append((v, e, R.randrange(4)))
    rows += [(1000 + i, base, i % 2) for i in range(30)]  # a hot vector: ties by vec_id
    rows += [(500, None, 1), (501, base, None), (None, base, 1), (502, base[:8], 2),
             (503, [float("nan")] + base[1:], 1), (504, [None] + base[1:], 1),
             (505, [5000.0] + base[1:], 1), (100, base, 3), (100, base, 0)]
    return rows


@pytest.mark.parametrize("blocks", [(hn.ROW_BLOCK, hn.ANCHOR_BLOCK), (37, 2)])
def test_negatives_equal_brute_force(spark, blocks):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("rb"),
                                                    F.lit(2).alias("ab"))
    got = [tuple(r) for r in hn.mine(df, *blocks).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_negatives(rows)


def test_empty_tables(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.mine(spark.createDataFrame([(1, [0.1], 1)], SCHEMA)).count() == 0


def test_residue_gemm_is_exact():
    r = np.random.default_rng(1)
    for dims, most in [(64, 256), (300, 1 << 19), (3, 1)]:
        a = r.integers(-most, most + 1, (7, dims))
        b = r.integers(-most, most + 1, (9, dims))
        primes = hn.primes_for(dims * most * most)
        got = hn.rns_scores(a, b, primes)
        want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
        assert got.tolist() == want


def test_chunks_cover_the_whole_text(monkeypatch):
    w = qc.init()
    ids = qc.codes(bytes(R.randrange(256) for _ in range(5000)))
    whole = np.maximum(qc.responses(w, ids).max(0), 0)
    monkeypatch.setattr(qc, "CHUNK", 97)
    assert np.allclose(qc.features(w, qc.tables(w), ids), whole, atol=1e-4)


def test_gradients_match_differences():
    w = qc.init(2)
    ids = qc.codes(b"some text with symbols ### $$$ and words")
    g, loss = qc.gradients(w, ids, 1.0, 1.3)
    for k in ("v", "b", "c", "K"):
        flat = w[k].reshape(-1)
        i = int(np.argmax(np.abs(g[k].reshape(-1))))
        old = flat[i]
        flat[i] = old + 1e-6
        up = qc.gradients(w, ids, 1.0, 1.3)[1]
        flat[i] = old
        assert abs((up - loss) / 1e-6 - g[k].reshape(-1)[i]) < 1e-3


def test_classifier_learns_and_scores_every_row(spark):
    clean = "the quick brown fox jumps over the lazy dog and keeps running far away"
    rows, labels = [], []
    for i in range(600):
        good = i % 3 != 0
        text = " ".join(R.sample(clean.split(), 10)) if good else "".join(
            R.choice("#$%&*<>|") for _ in range(R.randrange(5, 60)))
        rows.append((i, text))
        labels.append((i, int(good), 0))
    rows += [(900, None), (901, ""), (902, "x" * 300_000), (902, "repeated")]
    docs = documents(spark, rows).select("*", F.lit(1).alias("score"), F.lit(1).alias("held_out"))
    lab = spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0)],
                                "doc_id long, quality int, toxic int")
    got = qc.classify(docs, lab).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in got)
    truth = dict((d, q) for d, q, _ in labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 3 == 1)
                        for r in got if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > .95
