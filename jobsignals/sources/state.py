"""Thread list, processed set and known ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.fixed_values import THREADS_FROM
from jobsignals.operators.dedupe import distinct_ids
from jobsignals.schemas import PROCESSED, THREADS
from jobsignals.sources.ledger import numbered, remove
from jobsignals.sources.tables import read_typed


def _json_or_empty(spark: SparkSession, path: str, schema, multi_line: bool) -> DataFrame:
    try:
        return spark.read.schema(schema).option("multiLine", multi_line).json(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_threads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Thread list from JSON lines or a one-line array; no file, no rows."""
    return _json_or_empty(spark, path, THREADS, multi_line)


def write_threads(threads: DataFrame, path: str) -> None:
    threads.write.mode("overwrite").json(path)


#: Runs logged before the processed set is rewritten as one snapshot.
COMPACT_EVERY = 8


def _parts(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Committed snapshot numbers and committed log numbers of a processed store."""
    snaps = [n for n, ok in numbered(spark, path, "snap-") if ok]
    logs = [n for n, ok in numbered(spark, f"{path}/log", "") if ok]
    return snaps, logs


def read_processed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Ids of processed threads; missing or unreadable state means none.

    `path` is a JSON file or folder of objects {"processed_threads": [...]}, or a store that
    `mark_processed` keeps: the newest committed snapshot and the committed runs logged after
    it. Parts that a crash left without their commit marker are not read.
    """
    snaps, logs = _parts(spark, path)
    if not snaps and not logs:
        rows = _json_or_empty(spark, path, PROCESSED, multi_line)
        return rows.select(F.explode("processed_threads").alias("id")).distinct()
    base = snaps[-1] if snaps else 0
    files = ([f"{path}/snap-{base:08d}"] if snaps else []) + [
        f"{path}/log/{n:08d}" for n in logs if n > base]
    rows = spark.read.schema(PROCESSED).json(files)
    return rows.select(F.explode("processed_threads").alias("id")).distinct()


def mark_processed(ids: DataFrame, path: str) -> None:
    """Add ids to the processed store. Call after the data is committed.

    A run logs its ids as one object, numbered after the last log. Once COMPACT_EVERY runs are
    logged after the newest snapshot, all ids are rewritten as one object (the format of a
    single processed set), committed as the next snapshot; only then are the logs it covers
    and older snapshots removed. So the store holds a snapshot and a few logs however many runs
    there are, and a crash at any point loses or doubles nothing.
    """
    spark = ids.sparkSession
    seen = [m for m, _ in numbered(spark, f"{path}/log", "") + numbered(spark, path, "snap-")]
    n = max(seen, default=0) + 1  # after every log and snapshot, committed or not
    (ids.agg(F.array_sort(F.collect_set(F.col("id").cast("string"))).alias("processed_threads"))
     .coalesce(1).write.json(f"{path}/log/{n:08d}"))
    snaps, logs = _parts(spark, path)
    base = snaps[-1] if snaps else 0
    if len([m for m in logs if m > base]) < COMPACT_EVERY:
        return
    top = logs[-1]
    (read_processed(spark, path).agg(F.array_sort(F.collect_set("id")).alias("processed_threads"))
     .coalesce(1).write.json(f"{path}/snap-{top:08d}"))
    for m, _ in numbered(spark, f"{path}/log", ""):
        if m <= top:
            remove(spark, f"{path}/log/{m:08d}")
    for m, _ in numbered(spark, path, "snap-"):
        if m < top:
            remove(spark, f"{path}/snap-{m:08d}")


def pending_threads(threads: DataFrame, processed: DataFrame, since: str = THREADS_FROM,
                    reopen_newest: bool = False) -> DataFrame:
    """Threads from `since` on that are not in the processed set.

    With `reopen_newest`, threads of the newest month stay pending, as their
    pages may still grow.
    """
    recent = threads.filter(F.col("thread_date") >= since)
    pending = recent.join(processed.select("id"), "id", "left_anti")
    if reopen_newest:
        newest = recent.agg(F.max("thread_date").alias("thread_date"))
        pending = pending.unionByName(
            recent.join(F.broadcast(newest), "thread_date", "left_semi")
            .select(*pending.columns)).dropDuplicates(["id"])
    return pending


def known_ids(spark: SparkSession, parquet: Sequence[str] = (),
              csv: Sequence[str] = ()) -> DataFrame:
    """Distinct ids over parquet and CSV files; only the id column is read.

    Each file keeps its own type of id until it is cast; one that is no parquet is
    left out with a warning.
    """
    frames = [read_typed(spark, path, ["id"]).select("id") for path in parquet]
    if csv:
        frames.append(spark.read.option("header", True).csv(list(csv))
                      .select(F.col("id").cast("string")))
    if not frames:
        return spark.createDataFrame([], "id string")
    every = frames[0]
    for more in frames[1:]:
        every = every.unionByName(more)
    return distinct_ids(every)
