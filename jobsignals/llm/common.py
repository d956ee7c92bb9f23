"""Helpers shared by the operators: saved tables, words, word hashes, windows."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.session import until_exit

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
U64 = np.uint64


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once an application, so that none needs it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    file = Path(tempfile.mkdtemp(prefix="package-")) / "jobsignals.zip"
    with zipfile.ZipFile(file, "w") as out:
        for source in sorted((root / "jobsignals").rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(str(file))  # the driver serves it
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives executors.

    The files go when the application ends.
    """
    spark = df.sparkSession
    path = until_exit(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def doc_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): th tells apart different texts that share an id, or have none."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(whole_text()).alias("th"), whole_text().alias("text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["th"] == right["th"])


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the result."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_lists(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of a batch as dictionary codes, and where each text's words begin (n + 1 offsets)."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    words = lists.flatten()
    real = pc.not_equal(words, "")
    ends = np.asarray(lists.offsets, dtype=np.int64)
    ends = ends - ends[0]
    kept = np.zeros(len(words) + 1, np.int64)
    np.cumsum(real.to_numpy(zero_copy_only=False), out=kept[1:])
    return pc.dictionary_encode(words.filter(real)), kept[ends]


def strings(values: pa.Array) -> list:
    """As to_pylist(), but several times as fast."""
    return values.to_numpy(zero_copy_only=False).tolist()


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words."""
    from xxhash import xxh3_64_intdigest as digest

    return np.fromiter(map(digest, strings(words.cast(pa.large_binary()))), np.uint64,
                       len(words))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a batch, and the offsets of the texts."""
    coded, offsets = word_lists(texts)
    if not len(coded):
        return np.zeros(0, np.uint64), offsets
    return hash_words(coded.dictionary)[np.asarray(coded.indices)], offsets


def window_hashes(h: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Polynomial hash of every run of `width` word hashes, built by doubling."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, part, size, out, done = U64(base), h, 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            if width & size:
                take = part[done:done + n]
                out = take if out is None else out * power + take
                done += size
            if size * 2 > width:
                return mix(out)
            part = part[:len(part) - size] * power + part[size:]
            power = power * power
            size *= 2


def sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """op (np.minimum or np.maximum) over every run of `width` values."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    part, size = x, 1
    while size * 2 <= width:
        part = op(part[:len(part) - size], part[size:])
        size *= 2
    return op(part[:n], part[width - size:width - size + n])


def batches(texts: pa.Array, most_bytes: int = 8 << 20) -> list[tuple[int, int]]:
    """Row ranges of a batch with about so many bytes of text each, one row at least."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    cuts, start = [], 0
    while start < len(texts):
        base = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, base + most_bytes, "right")))
        cuts.append((start, stop))
        start = stop
    return cuts
