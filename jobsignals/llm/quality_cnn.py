"""Quality classifier: a byte-level convolutional network, written in numpy.

A text is its UTF-8 bytes. Every byte is embedded (`DIM` numbers), `FILTERS` learned filters of
`WIDTH` bytes slide over the whole text, a ReLU follows, and each filter's largest response over
the document (max-pool) is one feature; a logistic layer combines the features into one
probability. Long texts are read in overlapping chunks of `CHUNK` bytes (overlap WIDTH - 1), so
that every window of the whole document is seen once and memory stays bounded; the max over the
chunks equals the max over the document.

Training uses labelled documents outside the held-out fold (crc32(doc_id as text) % 3 == 1 is
held out). The network is fitted by Adam on a sample of those rows, chosen by a hash of doc_id
up to about `TRAIN_BYTES` of text (a documented bound; whole texts, never prefixes), with class
weights so that both labels count alike. Scoring runs on executors over every document with the
few thousand weights broadcast.

Defined cases: a null text is empty, and an empty text is one window of padding, so it gets a
score too. A null doc_id counts as the text '' for the fold. Labels with a null doc_id or quality
are ignored; a document with several labels learns their mean. Repeated rows are scored each.
Without labelled training rows the network keeps its seeded start. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import ship, whole_text

FOLDS, HELD_OUT = 3, 1
DIM, WIDTH, FILTERS = 8, 5, 32
PAD = 256
CHUNK = 1 << 16
#: Most bytes of text, and most rows, that the training sample holds (about; drawn by hash).
TRAIN_BYTES, TRAIN_ROWS = 16 << 20, 100_000
EPOCHS, BATCH, RATE, SEED = 4, 32, 0.01, 13


def init(seed: int = SEED) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    return {"E": r.normal(0, 0.5, (PAD + 1, DIM)),
            "K": r.normal(0, 1 / np.sqrt(WIDTH * DIM), (WIDTH, DIM, FILTERS)),
            "b": np.zeros(FILTERS), "v": r.normal(0, 0.1, FILTERS), "c": np.zeros(1)}


def codes(text: bytes) -> np.ndarray:
    ids = np.frombuffer(text, np.uint8).astype(np.uint16)
    if len(ids) < WIDTH:
        ids = np.concatenate([ids, np.full(WIDTH - len(ids), PAD, np.uint16)])
    return ids


def responses(w: dict, ids: np.ndarray) -> np.ndarray:
    """ReLU responses of every filter at every window of ids: (windows, FILTERS)."""
    x = w["E"][ids]
    n = len(ids) - WIDTH + 1
    h = np.broadcast_to(w["b"], (n, FILTERS)).copy()
    for j in range(WIDTH):
        h += x[j:j + n] @ w["K"][j]
    return np.maximum(h, 0)


def tables(w: dict) -> np.ndarray:
    """E @ K[j] for every offset j: a filter's response is then WIDTH lookups and adds."""
    return np.stack([w["E"] @ w["K"][j] for j in range(WIDTH)]).astype(np.float32)


def features(w: dict, t: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Each filter's largest response over the whole text, chunk by overlapping chunk
    (ReLU and max commute, so the ReLU comes after the max)."""
    best = np.full(FILTERS, -np.inf, np.float32)
    for s in range(0, max(1, len(ids) - WIDTH + 1), CHUNK):
        part = ids[s:s + CHUNK + WIDTH - 1]
        n = len(part) - WIDTH + 1
        h = t[0][part[:n]].copy()
        for j in range(1, WIDTH):
            h += t[j][part[j:j + n]]
        best = np.maximum(best, h.max(0))
    return np.maximum(best.astype(np.float64) + w["b"], 0)


def probability(w: dict, t: np.ndarray, ids: np.ndarray) -> float:
    z = float(features(w, t, ids) @ w["v"] + w["c"][0])
    return 1 / (1 + np.exp(-z)) if z >= 0 else np.exp(z) / (1 + np.exp(z))


def gradients(w: dict, ids: np.ndarray, y: float, weight: float) -> tuple[dict, float]:
    """Gradients of the weighted log loss of one text; only the max-pooled windows carry them."""
    ids = ids.astype(np.intp)
    x = w["E"][ids]
    h = responses(w, ids)
    at = h.argmax(0)
    f = h[at, np.arange(FILTERS)]
    z = float(f @ w["v"] + w["c"][0])
    p = 1 / (1 + np.exp(-z)) if z >= 0 else np.exp(z) / (1 + np.exp(z))
    dz = (p - y) * weight
    g = {k: np.zeros_like(v) for k, v in w.items()}
    g["v"] += dz * f
    g["c"] += dz
    df = dz * w["v"] * (f > 0)
    g["b"] += df
    for j in range(WIDTH):
        xj = x[at + j]  # (FILTERS, DIM): the byte each filter saw at its offset j
        g["K"][j] += xj.T * df
        np.add.at(g["E"], ids[at + j], w["K"][j].T * df[:, None])
    loss = -weight * (y * np.log(max(p, 1e-12)) + (1 - y) * np.log(max(1 - p, 1e-12)))
    return g, loss


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS,
        seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam over mini-batches; class weights make both labels count alike."""
    w = init(seed)
    if not len(texts):
        return w
    ids = [codes(t) for t in texts]
    y = np.asarray(labels, np.float64)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    weight = np.where(y >= 0.5, 0.5 / share, 0.5 / (1 - share))
    w["c"][:] = 0.0
    m = {k: np.zeros_like(v) for k, v in w.items()}
    s = {k: np.zeros_like(v) for k, v in w.items()}
    r = np.random.default_rng(seed)
    step = 0
    for _ in range(epochs):
        order = r.permutation(len(ids))
        for start in range(0, len(order), BATCH):
            batch = order[start:start + BATCH]
            total = {k: np.zeros_like(v) for k, v in w.items()}
            for i in batch:
                g, _ = gradients(w, ids[i], y[i], weight[i])
                for k in total:
                    total[k] += g[k]
            step += 1
            for k in w:
                g = total[k] / len(batch)
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                w[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step))
                                                             + 1e-8)
    return w


def folded(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       whole_text().alias("text"), (fold == HELD_OUT).alias("held_out"))


def training_rows(rows: DataFrame, labels: DataFrame, most_bytes: int = TRAIN_BYTES,
                  most_rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, y) of labelled rows outside the held-out fold, drawn by a hash of doc_id to about
    most_bytes of text and most_rows rows. Only lengths move until the draw; then only the
    drawn texts do."""
    y = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
         .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
         .agg(F.avg(F.col("quality").cast("double")).alias("y")))
    train = rows.where(~F.col("held_out"))
    sizes = train.select("doc_id", F.octet_length("text").alias("n")).join(y, "doc_id")
    total = sizes.agg(F.sum("n").alias("n"), F.count("*").alias("rows")).first()
    share = min(1.0, most_bytes / max(total.n or 0, 1), most_rows / max(total.rows, 1))
    pick = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20))
    return train.where(pick).join(y.where(pick), "doc_id").select("text", "y")


def score(rows: DataFrame, w: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = rows.sparkSession.sparkContext.broadcast(w)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        t = tables(weights)
        for b in parts:
            texts = b.column("text").cast(pa.large_binary())
            p = np.array([probability(weights, t, codes(texts[i].as_py()))
                          for i in range(len(texts))], np.float64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(p),
                 pa.array((p >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, most_bytes: int = TRAIN_BYTES,
             most_rows: int = TRAIN_ROWS) -> DataFrame:
    """Fit on the sampled training rows, then score every document."""
    rows = folded(docs)
    sample = training_rows(rows, labels, most_bytes, most_rows).collect()  # bounded draw
    w = fit([r.text.encode() for r in sample], np.array([r.y for r in sample]))
    return score(rows, w)
