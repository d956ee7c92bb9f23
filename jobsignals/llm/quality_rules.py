"""Host-level quality rules: document rules, failure rates by host, verdicts joined back.

Each document is measured once. Its failures are counted by host (`source`), combined before they
move. A beta prior is fitted to the hosts' rates by moments, and each rate is drawn towards it by
as much as the host is small. The verdict on a host then decides about its documents: those of a
trusted host fail by the ordinary limits of the rules, those of a doubtful host by strict ones, and
a condemned host (four of five documents fail for certain) loses all.

Defined cases: a null text has no words. A null source is a host of its own. An empty table gives
no rows. Repeated rows are measured and counted each. Other columns are left out of the report
and carried through `keep_good` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import save, ship

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Percent limits of the rules: ordinary, and strict for documents of doubtful hosts.
LIMITS = {
    "symbols": (10, 5),      # n_symbols against n_words
    "lines": (50, 30),       # n_dup_lines against n_lines
    "capitals": (60, 40),    # n_capitals against word_chars
    "shouts": (30, 15),      # n_exclaims against n_words
    "repeats": (45, 25),     # n_repeat_words against n_words
}
DOUBTFUL, CONDEMNED = 0.4, 0.8

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_capitals", "n_exclaims"]


def repeat_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[str, int] = {}
    for w in words:
        index.setdefault(w, len(index))
    codes = np.fromiter(map(index.__getitem__, words), np.int64, n)
    k = len(index)
    pairs = codes[:-1] * k + codes[1:]
    if k >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    triples = pairs[:-1] * k + codes[2:]
    order = np.sort(triples)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    place = np.minimum(np.searchsorted(twice, triples), len(twice) - 1)
    hit = twice[place] == triples
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:shift + n - 2] |= hit
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return (len(words), len(b"".join(words).decode()), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words), len(lines),
            len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
            text.count("!"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, th and the measures of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            values = [measure(t.as_py()) for t in b.column("text")]
            columns = list(zip(*values)) if values else [[]] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("source"), b.column("th"),
                 *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "source", "th", *MEASURES])

    schema = "doc_id long, source string, th long, " + ", ".join(f"{m} long" for m in MEASURES)
    return rows.mapInArrow(run, schema)


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def rules_failed(strict: bool) -> Column:
    """How many of the rules a document fails."""
    over = {"symbols": ("n_symbols", "n_words"), "lines": ("n_dup_lines", "n_lines"),
            "capitals": ("n_capitals", "word_chars"), "shouts": ("n_exclaims", "n_words"),
            "repeats": ("n_repeat_words", "n_words")}
    return sum((F.when(100 * F.col(a) > LIMITS[rule][strict] * F.col(b), 1).otherwise(0)
                for rule, (a, b) in over.items()), F.lit(0)).cast("long")


def beta_prior(mean: float | None, variance: float | None) -> tuple[float, float]:
    """Prior counts of failing and passing documents, by moments of the hosts' rates.

    Equal rates, or a single host, tell nothing about the spread: one document in all then.
    """
    if mean is None or not 0 < mean < 1:
        mean = 0.5 if mean is None else min(max(mean, 0.001), 0.999)
    spread = variance or 0.0
    strength = mean * (1 - mean) / spread - 1 if spread > 0 else 1.0
    strength = min(max(strength, 1.0), 1000.0)
    return mean * strength, (1 - mean) * strength


def host_verdicts(rows: DataFrame) -> DataFrame:
    """source, n_docs, n_failed, host_rate (shrunk) and verdict of every host."""
    hosts = rows.groupBy("source").agg(
        F.count("*").alias("n_docs"),
        F.sum(F.when(base_failed() | (rules_failed(False) > 0), 1).otherwise(0)).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    a, b = beta_prior(moments.m, moments.v)
    shrunk = (F.col("n_failed") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
    verdict = (F.when(F.col("host_rate") >= CONDEMNED, "condemned")
               .when(F.col("host_rate") >= DOUBTFUL, "doubtful").otherwise("trusted"))
    return hosts.withColumn("host_rate", shrunk).withColumn("verdict", verdict)


def judged(rows: DataFrame) -> DataFrame:
    """Measured rows with their host's rate and verdict, base_failed and kept."""
    # Saved, so that its measured size decides how it is joined, and a hot host can be split.
    hosts = save(host_verdicts(rows).select(
        F.col("source").alias("host"), "host_rate", "verdict"), "hosts")
    failed = F.when(F.col("verdict") == "doubtful", rules_failed(True)).otherwise(
        rules_failed(False))
    return (rows.join(hosts, F.col("source").eqNullSafe(F.col("host")))
            .withColumn("base_failed", base_failed())
            .withColumn("n_rules_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("verdict") != "condemned")
                        & (F.col("n_rules_failed") == 0)))


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document: measures, base_failed, kept, the host's rate and verdict."""
    return judged(save(measured(docs), "measured")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_rules_failed", F.round("host_rate", 6).alias("host_rate"),
        "verdict")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, all columns."""
    good = judged(save(measured(docs), "measured")).where("kept").select(
        F.col("doc_id").alias("good_id"), F.col("th").alias("good_th"),
        F.col("source").alias("good_source")).distinct()
    keyed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"),
        F.col("source").cast("string").alias("host"))
    same = (keyed["key"].eqNullSafe(good["good_id"]) & (keyed["th"] == good["good_th"])
            & keyed["host"].eqNullSafe(good["good_source"]))
    return keyed.join(good, same, "left_semi").select("row.*")
